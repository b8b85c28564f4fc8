"""The training-data operators on small tables: brute force, round trips, and the cases their docstrings define."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from sluice.llm import (boosting, components, decontaminate, fingerprint, language, linededup, mixing, pii, setjoin,
                        sharding, toxicity, urlfilter)
from sluice.llm.tables import table

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, component_id string, shard int"
WORDS = "the of and red blue green stone river cloud tree bird house light dark wind rain snow fire".split()


def _texts(n=60, seed=5):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        if i % 3 and out:  # near copies: some words of an earlier text changed
            words = rng.choice(out).split(" ")
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(WORDS) + str(rng.randint(0, 9))
            out.append(" ".join(words))
        else:
            out.append(" ".join(rng.choice(WORDS) + str(rng.randint(0, 30)) for _ in range(rng.randint(1, 120))))
    return out


@pytest.fixture(scope="module")
def odd_rows():
    """Nulls, empty and blank texts, repeated rows, one long text, columns with clashing names."""
    texts = [None, "", " \n\t", "One", "one", *_texts(), "Línea única\nÉTÉ\n", "long word " * 20_000 + "end"]
    rows = [(i, t, None if i % 7 == 0 else "en", None if i % 5 == 0 else f"s{i % 3}", None, "x", "y", 1)
            for i, t in enumerate(texts)]
    return [*rows, rows[9], rows[9], (None, "a text without an id", "en", "s1", 1, "x", "y", 1)]


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def _components(rows, size, p, q):
    sets = {}
    for d, t in rows:
        if d is not None:
            w = (t or "").encode().lower().split()
            sets[d] = {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and q * both >= p * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


@pytest.mark.parametrize(("size", "p", "q"), [(3, 90, 100), (5, 80, 100), (1, 50, 100)])
def test_setjoin_is_exact(odd, odd_rows, size, p, q):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in setjoin.similar(odd, size, p, q).collect()}
    assert got.pop(None)[1] is None
    assert got == _components([r[:2] for r in odd_rows], size, p, q)


def test_setjoin_keeps_one_of_each(odd, odd_rows, empty):
    kept = setjoin.one_of_each(odd, 5, 80, 100)
    assert kept.columns == odd.columns
    want = _components([r[:2] for r in odd_rows], 5, 80, 100)
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(
        d for d, (_, c) in want.items() if d == c)
    assert setjoin.similar(empty, 3, 90, 100).count() == 0


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(1000, i) for i in range(400, 500)]
    up = {x: x for e in links for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        up[y] = x
    got = {r.node: r.label for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got.get(x, x) == find(x) for x in up)


def _windows(text, size=13):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
    return words, {tuple(words[i:i + min(size, len(words))]) for i in range(len(words) - min(size, len(words)) + 1)} \
        if words else set()


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 200])
def test_decontamination(spark, odd, odd_rows, empty, block_bytes):
    texts = [r[1] for r in odd_rows]
    items = [("a", texts[5]), ("b", " ".join((texts[8] or "").split()[3:20])), ("c", "ONE!"), ("d", None), ("e", ""),
             ("f", "été"), ("g", texts[5]), ("h", "nothing here " * 9)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = sorted((tuple(r) for r in decontaminate.find_hits(odd, bench, block_bytes=block_bytes).collect()), key=str)
    want = []
    for d, t, *_ in odd_rows:
        words, _ = _windows(t)
        hit, found = set(), set()
        for name, item in items:
            for w in _windows(item)[1]:
                for i in range(len(words) - len(w) + 1):
                    if tuple(words[i:i + len(w)]) == w:
                        hit |= set(range(i, i + len(w)))
                        found.add(name)
        want.append((d, len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                     bool(hit) and 20 * len(hit) >= len(words)))
    assert got == sorted(want, key=str)
    clean = decontaminate.clean(odd, bench, block_bytes=block_bytes)
    assert clean.columns == odd.columns and clean.count() == sum(not w[-1] for w in want)
    assert decontaminate.find_hits(empty, bench).count() == 0
    assert decontaminate.find_hits(odd, bench.limit(0)).where("n_hit > 0").count() == 0


def test_fingerprints(odd, odd_rows, empty):
    rows = sorted({(r[0], r[1] or "") for r in odd_rows if r[0] is not None}, key=lambda r: -r[0])
    rows.append((None, odd_rows[-1][1]))
    got = {r.doc_id: r for r in fingerprint.fingerprints(odd).collect()}
    by_text = {}

    def near(a, b):
        a, b = set(a.split("\n")), set(b.split("\n"))
        return len(a & b) / len(a | b)

    for (d, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(near(text, edited)) and r.near_next == pytest.approx(near(text, after))
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        assert by_text.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint
    assert fingerprint.fingerprints(odd).count() == len(odd_rows)
    assert fingerprint.fingerprints(empty).count() == 0


def test_sketches_grow_until_all_is_recovered(spark):
    rng = random.Random(4)
    rows = [(i, [rng.getrandbits(60) for _ in range(i)], [rng.getrandbits(60) for _ in range(i // 2)])
            for i in (0, 1, 5, 40, 300)]
    pairs = spark.createDataFrame(rows, "id long, left array<long>, right array<long>")
    assert {r.id: (r.only_left, r.only_right) for r in fingerprint.recovered(pairs).collect()} == {
        i: (len(a), len(b)) for i, a, b in rows}


def test_shards(odd, odd_rows, empty):
    rows = odd.withColumn("bytes", F.octet_length("text")).drop("shard")
    got = sharding.shard(rows, ["lang", "source", "bytes"], [F.crc32("text"), F.col("doc_id")], shards=7).collect()
    assert len(got) == len(odd_rows)
    slots = [sorted(r.slot for r in got if r.shard == s) for s in range(7)]
    assert all(x == list(range(len(x))) for x in slots) and max(map(len, slots)) - min(map(len, slots)) <= 1
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.hilbert for r in order] == sorted(r.hilbert for r in got)
    assert sharding.shard(empty.drop("shard"), ["lang"], [F.col("doc_id")]).count() == 0


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 2)])
def test_curve_visits_neighbours(spark, dims, bits):
    grid = spark.range(1 << dims * bits)
    axes = [(F.shiftright("id", bits * j).bitwiseAND((1 << bits) - 1)).cast("int").alias(f"c{j}") for j in range(dims)]
    cells = grid.select(*axes)
    walk = sorted((r[-1], r[:-1]) for r in cells.select("*", sharding.hilbert_index(
        [F.col(f"c{j}") for j in range(dims)], bits)).collect())
    assert [h for h, _ in walk] == list(range(1 << dims * bits))
    assert all(sum(abs(x - y) for x, y in zip(a, b, strict=True)) == 1 for (_, a), (_, b) in zip(walk, walk[1:]))


def test_mixing(spark, odd, empty):
    rows = odd.select("doc_id", "source", mixing.word_count(F.col("text")).alias("words"))
    plan = {r.source: r for r in mixing.plan(rows, max_repeats=2.0).collect()}
    drawn = mixing.draw(rows, mixing.plan(rows, max_repeats=2.0)).collect()
    assert {r.doc_id for r in drawn} == {r.doc_id for r in rows.collect()}  # none is left out
    for source, p in plan.items():
        words = sum(r.words for r in drawn if r.source == source)
        assert p.words <= p.quota <= 2 * p.words and words <= p.quota
    assert mixing.mixed(odd, max_repeats=2.0).columns == odd.columns
    assert mixing.mixed(odd, max_repeats=2.0).count() == len(drawn)
    assert mixing.mixed(empty).count() == 0
    sources = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 100)], "source string, words long")
    p = np.array([1000, 10, 100]) / 1110
    a = mixing.exponent(sources, max_repeats=None, entropy=0.9)
    w = p ** a / (p ** a).sum()
    assert -(w * np.log(w)).sum() == pytest.approx(0.9 * np.log(3), abs=1e-6)


def test_line_dedup(spark, odd, odd_rows, empty):
    assert linededup.align([1, 2, 3, 4, 5], [9, 2, 3, 4, 8, 5]) == [(1, 1), (2, 2), (3, 3), (4, 5)]
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randint(0, 9) for _ in range(rng.randint(0, 12))] for _ in range(2))
        found = linededup.align(a, b)
        assert all(a[i] == b[j] for i, j in found)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(found, found[1:]))
    passage = "\n".join(" ".join(WORDS[i:i + 6]) for i in range(0, 12, 3))
    docs = [(1, "a first line\n" + passage + "\nlast"), (2, "other\n\n" + passage + "\nend of two"), (3, passage.upper()),
            (4, "other\nshort"), (5, None), (6, "")] + [(i, f"own {i}\n" + passage) for i in range(10, 30)]
    kept = {r.doc_id: r for r in linededup.deduplicated(
        spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert kept[1].text == docs[0][1] and kept[2].text == "other\n\nend of two" and kept[3].text == ""
    assert (kept[4].text, kept[5].text, kept[6].text) == ("other\nshort", None, "")
    assert all(kept[i].text == f"own {i}" and kept[i].n_deleted == 4 for i in range(10, 30))
    assert linededup.deduplicated(odd).count() == len(odd_rows)
    assert linededup.deduplicated(empty).count() == 0


def _all_pairs(docs, min_words):
    """Text left of each document when each is aligned with all of smaller key."""
    lines = {k: [x for x in (t or "").split("\n") if x] for k, t in docs}
    out = {}
    for k, own in lines.items():
        gone = set()
        for early in (x for x in lines if x < k):
            gone |= set(linededup.common_blocks([x.lower() for x in lines[early]], [x.lower() for x in own],
                                                [len(x.split()) for x in own], min_words))
        out[k] = "\n".join(x for i, x in enumerate(own) if i not in gone)
    return out


def test_line_dedup_of_frequent_lines_is_that_of_all_pairs(spark):
    menu = ["home and news", "our contact page", "terms of use", "all rights reserved"]
    docs = [(i, f"alone {i}\n{x}") for i, x in enumerate(menu)]
    docs += [(i, f"own {i}\n" + "\n".join(menu) + f"\nend {i}") for i in range(10, 30)]
    kept = {r.doc_id: r.text for r in linededup.deduplicated(
        spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert kept[10] == docs[4][1] and all(kept[i] == f"own {i}\nend {i}" for i in range(11, 30))
    rng = random.Random(9)
    some = ["a b c", "d e", "f", " ", "g h i j k", "l m n", "o p q r s t u v w x y"]
    docs = [(i, "\n".join(rng.choice(some) + rng.choice(["", "", "", f" {i}"]) for _ in range(rng.randint(0, 14))))
            for i in range(120)]
    for rare in (1, 8):
        kept = {r.doc_id: r.text for r in linededup.deduplicated(
            spark.createDataFrame(docs, "doc_id long, text string").repartition(3), rare, 6).collect()}
        assert kept == _all_pairs(docs, 6)


def _base(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_pii(odd, odd_rows, empty):
    rng = random.Random(3)
    for _ in range(20_000):
        t = "".join(rng.choice("a.@1 2-+()4é") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(t) == _base(t)
    rows = pii.find(odd, pii.fit(pii.training_rows(odd))).collect()
    assert len(rows) == len(odd_rows) and pii.find(empty, {}).count() == 0
    assert pii.redact("call +1 222 or a@b.c", [("phone", 5, 11), ("email", 15, 20)]) == "call <phone> or <email>"


def test_models_on_held_out_rows(spark, odd, empty):
    docs = table(spark, SF01, "documents")
    found = language.predict(docs, language.fit(language.training_rows(docs))).join(docs.select("doc_id", "lang"), "doc_id")
    assert found.where("held_out and lang_pred <> lang").count() <= 0.02 * found.where("held_out").count()
    odd_found = language.predict(odd, language.fit(language.training_rows(docs))).collect()
    assert {r.lang_pred for r in odd_found if r.doc_id in (0, 1, 2)} == {"und"}
    assert all(0 <= r.score <= 1 for r in odd_found)
    assert language.predict(odd, None).where("lang_pred <> 'und'").count() == 0
    labels = table(spark, SF01, "labels")
    scored = toxicity.predict(docs, *toxicity.train(docs, labels)).join(labels, "doc_id").where("held_out")
    assert scored.where("toxic = 0 and predicted = 1").count() == 0
    assert scored.where("toxic = 1 and predicted = 1").count() >= 0.5 * scored.where("toxic = 1").count()
    assert toxicity.predict(odd, *toxicity.train(odd, labels.limit(0))).where("score > 0").count() == 0
    assert language.training_rows(empty) == [] and toxicity.predict(empty, None).count() == 0


def test_pairs_of_terms():
    """Neither term alone tells the label: their product does."""
    rng = np.random.default_rng(0)
    rows = []
    for _ in range(2000):
        a, b = rng.random(2) < 0.5
        terms = [1] * int(a) + [2] * int(b) + list(rng.integers(10, 60, 5))
        rows.append((int(a and b), np.unique(np.array(terms, dtype=np.uint64))))
    model = toxicity.fit(rows, 0.25)
    margin = {}
    for name, terms in (("a", [1]), ("b", [2]), ("ab", [1, 2])):
        at = np.searchsorted(model["terms"], np.array(terms, dtype=np.uint64))
        margin[name] = toxicity._margin(model["bias"], model["weights"], np.zeros(len(at), int), at, 1)[0][0]
    assert margin["ab"] > 0 > max(margin["a"], margin["b"])


def test_trees_and_urls(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    forest = boosting.fit(x[:2000], y[:2000])
    assert ((boosting.predict(forest, x[2000:]) > 0.5) == y[2000:]).mean() > 0.95
    cases = {"http://A.Example.org/es/1?x": ("block", "example.org/es/"), "https://example.org/en/12": ("block", "example.org/en/1"),
             "http://example.org": (None, None), "http://x.org/": ("allow", "org/"), "http://forg/": (None, None),
             "http://q.com/fr/?": ("allow", "com/fr/"), "no scheme": (None, None), None: (None, None)}
    for url, (verdict, rule) in cases.items():
        assert urlfilter.decide(*urlfilter.split_url(url), urlfilter.RULES) == (rule, verdict)
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(cases)], "page_id long, url string, host string")
    for model in (urlfilter.fit([]), urlfilter.fit(urlfilter.training_rows(pages, urlfilter.RULES))):
        got = urlfilter.judge(pages, urlfilter.RULES, model).collect()
        assert len(got) == len(cases) and all(r.verdict in ("allow", "block") for r in got)
    assert urlfilter.judge(pages.limit(0), urlfilter.RULES, urlfilter.fit([])).count() == 0


def test_url_shares_count_the_whole_table(spark):
    rules = (("block", "b.net/"), ("allow", "a.net/"), ("block", "rare.com/x/"))
    urls = [f"http://h{i}.a.net/{i}" for i in range(600)] + ["http://copy.a.net/"] * 3000 + ["http://rare.com/x/1"]
    urls += [f"http://h{i}.b.net/{i}" for i in range(40)] + ["http://rare.com/y", "http://none.info/", "localhost", None]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3)
    shares = {r.two: r for r in urlfilter.suffix_shares(pages, rules).collect()}
    n, bad = 3641, 41
    share = (bad + 0.5) / (n + 1)
    assert shares["rare.com"].share_two == pytest.approx((1 + 10 * share) / 11)
    assert shares["b.net"].share_two == pytest.approx((40 + 10 * share) / 50)
    assert shares["b.net"].share_one == pytest.approx((40 + 10 * share) / 3650)
    assert shares["none.info"].share_two == share and not shares["none.info"].often and shares["a.net"].often
    rows = urlfilter.training_rows(pages, rules, sample=20)
    assert len({r[0] for r in rows}) == 20 and sum(r[1] == "block" for r in rows) == 10
    assert {(r[1], r[4]) for r in rows} == {("allow", 601), ("block", 41)}
    got = urlfilter.judge(pages, rules, urlfilter.fit(urlfilter.training_rows(pages, rules))).collect()
    assert sorted(r.page_id for r in got) == list(range(len(urls)))
    assert all(0 <= r.risk <= 1 for r in got)


def test_pii_is_searched_where_a_generator_can_match(spark):
    texts = ["mail john {at} example {dot} com", "mail john [at] example.com", "no trigger here"]
    assert [bool(pii.candidates(t)) for t in texts] == [True, True, False]
    assert [bool(pii._TRIGGER.search(t)) for t in texts] == [True, True, False]
    forest = boosting.fit(np.zeros((0, 0)), np.zeros(0))._replace(start=5.0)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_added for r in pii.find(docs, {"email": (forest, 0.5)}).collect()}
    assert got == {0: 1, 1: 1, 2: 0}


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 20])
def test_benchmark_items_without_an_id_are_searched(spark, block_bytes):
    items = [(None, "red blue green stone"), (None, "river cloud tree"), ("a", "bird house light")]
    docs = [(1, "red blue green stone and river cloud tree"), (2, "a bird house light, river cloud tree"), (3, "wind")]
    got = {r.doc_id: r for r in decontaminate.find_hits(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id string, text string"), block_bytes=block_bytes).collect()}
    assert [(got[i].n_hit, got[i].n_items, got[i].contaminated) for i in (1, 2, 3)] == [
        (7, 1, True), (6, 2, True), (0, 0, False)]
    assert [got[i].items_sha256 for i in (1, 2)] == [hashlib.sha256(x).hexdigest() for x in (b"", b"a")]
