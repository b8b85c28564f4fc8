"""Spelling variants, Merkle manifest and SimHash balls against plain Python, and the cases their docstrings define."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from sluice.llm import merkle, simhash, spelling

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, word string, leaf string, fp long, "
        "root string, place long, block long, n long, tree long")
EXTRA = ("w", "x", 1, "r", 2, 3, 4, 5)


def _rows():
    rng = random.Random(3)
    stems = ["station", "river", "garden", "window", "Straße", "niñoles", "colour", "centre", "stream", "étagère"]
    texts = [None, "", " \n\t", "One", "one", "x" * 3000 + " " + "y" * 3000]
    for _ in range(150):
        words = []
        for _ in range(rng.randint(1, 60)):
            w = rng.choice(stems)
            if rng.random() < 0.4:
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", "e", "ß", w[at] * 2, "t"]) + w[at + 1:]
            words.append(w.upper() if rng.random() < 0.1 else w)
        texts.append(rng.choice([" ", "-", "\n"]).join(words))
    texts.append("long Word station " * 20_000 + "end")
    for i in range(40):  # near copies
        words = texts[10 + i].split(" ")
        words[rng.randrange(len(words))] = "other"
        texts.append(" ".join(words))
    rows = [(i, t, "en" if i % 4 else None, None if i % 9 == 0 else f"s{i % 7}" if i % 3 else "hot",
             len(t) if t and i % 5 else None, *EXTRA) for i, t in enumerate(texts)]
    return [*rows, rows[8], rows[8], (None, "a station without an id", "en", "hot", 1, *EXTRA),
            (500, "", None, "", 0, *EXTRA)]


@pytest.fixture(scope="module")
def rows():
    return _rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def _lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


# --- spelling variants ---------------------------------------------------------------------------------------

def _is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _variants(rows, dropped, least_length, least_count):
    n = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = _lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % dropped == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= least_length and k >= least_count}
    near = {w: [o for o in n if o != w and _is_near(w, o)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


@pytest.mark.parametrize(("dropped", "least_length", "least_count", "blocks"), [
    (97, 5, 3, {}), (7, 5, 2, {"groups": 4, "bucket_rows": 300, "tile": 5}), (3, 2, 1, {"groups": 3, "tile": 90})])
def test_variants_are_exact(docs, rows, dropped, least_length, least_count, blocks):
    got = spelling.variants(docs, dropped, least_length, least_count, **blocks).collect()
    want = _variants(rows, dropped, least_length, least_count)
    assert len(got) == len(want) > 30
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want
    assert any(r.form and r.form != r.root for r in got) or dropped == 97


def test_variants_of_nothing(empty):
    assert spelling.variants(empty).collect() == []


def test_runs_are_whole_across_pieces(monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 4)
    text = "Garden éTAGère ab cdefghij×k 12 end"
    assert [w for part in spelling.runs_of(text.encode()) for w in part] == re.findall("[a-zÀ-ÿ]+", _lower(text))


def test_small_and_large_blocks_agree(monkeypatch, docs, rows):
    monkeypatch.setattr(spelling, "STACKED", 1)
    words = list(_variants(rows, 7, 4, 1))
    group = spelling.np.arange(spelling.LETTERS) % 3
    one = spelling.np.zeros(len(words), dtype=int)
    for stacked in (1, 4096):
        monkeypatch.setattr(spelling, "STACKED", stacked)
        pairs = set()
        for choice in range(3):
            a, b = spelling.near_pairs(words, one, one + choice, one, group, 3)
            pairs |= {frozenset((words[x], words[y])) for x, y in zip(a, b, strict=True)}
        assert pairs == {frozenset((x, y)) for x in words for y in words if x < y and _is_near(x, y)}


# --- Merkle manifest -----------------------------------------------------------------------------------------

def _h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(row):
    return _h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in
                      (row[0], row[3], row[2], row[4], row[1])))


def _tree(nodes, fanout):
    """(siblings before and after, level by level) of each node, and the root."""
    paths, own = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(own):
            first = at - at % fanout
            paths[i].append(("".join(nodes[first:at]), "".join(nodes[at + 1:first + fanout])))
            own[i] = at // fanout
        nodes = [_h("".join(nodes[k:k + fanout])) for k in range(0, len(nodes), fanout)]
    return paths, nodes[0]


def _manifest(rows, fanout):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[3], []).append(row)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    inner = {}
    for s in sources:
        own = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
        inner[s] = (own, *_tree([_leaf(r) for r in own], fanout))
    outer, root = _tree([inner[s][2] for s in sources], fanout)
    out = []
    for s, above in zip(sources, outer, strict=True):
        for row, path in zip(inner[s][0], inner[s][1], strict=True):
            path = path + above
            tampered = row[0] is not None and row[1] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            node = _leaf((row[0], _lower(row[1]), *row[2:])) if tampered else _leaf(row)
            for lower, higher in path:
                node = _h(lower + node + higher)
            out.append((row[0], _leaf(row), inner[s][2], root, _h("".join(a + b for a, b in path)), node, node == root))
    return sorted(out, key=str)


def _proved(df, **kw):
    picked = F.crc32(F.col("doc_id").cast("string")) % merkle.TAMPERED == 0
    return sorted((tuple(r) for r in merkle.manifest(df, merkle.lowered(F.col("text"), picked), **kw).collect()), key=str)


@pytest.mark.parametrize(("fanout", "levels"), [(16, 3), (2, 1), (3, 2), (16, 0)])
def test_manifest_equals_plain_trees(docs, rows, fanout, levels):
    got = _proved(docs, fanout=fanout, block_levels=levels)
    assert got == _manifest(rows, fanout)
    assert {r[-1] for r in got} == {True, False}


def test_manifest_of_few_rows(spark, empty, rows):
    assert _proved(empty) == []
    one = spark.createDataFrame(rows[:1], DOCS)
    assert _proved(one) == _manifest(rows[:1], 16)
    assert _proved(one)[0][4] == _h("")


# --- SimHash -------------------------------------------------------------------------------------------------

def _fingerprint(text, size):
    words = (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split()
    shingles = [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize(("size", "radius"), [(3, 2), (1, 4), (3, 0)])
def test_simhash_is_exact(spark, rows, size, radius):
    rows = [(r[0], r[1] and r[1][:4000], *r[2:]) for r in rows][:120]
    want = [(r[0], _fingerprint(r[1], size)) for r in rows]
    label = list(range(len(rows)))
    for i, (_, x) in enumerate(want):
        for j, (_, y) in enumerate(want[:i]):
            if (x ^ y).bit_count() <= radius and label[i] != label[j]:
                label = [label[j] if k == label[i] else k for k in label]
    least = {}
    for (d, _), k in zip(want, label, strict=True):
        if d is not None:
            least[k] = min(d, least.get(k, d))
    got = simhash.near_duplicates(spark.createDataFrame(rows, DOCS).repartition(3), size, radius).collect()
    assert sorted(map(str, ((r.doc_id, r.fingerprint, r.component_id) for r in got))) == sorted(
        map(str, ((d, f"{x:016x}", least.get(k)) for (d, x), k in zip(want, label, strict=True))))


def test_simhash_links_two_bits_through_the_middle(spark):
    fps = [0, 1, 3, 7, 1 << 63, (1 << 63) | 6, 0b11111 << 40, 0b11001 << 40]
    fps = [x - (1 << 64) if x >> 63 else x for x in fps]
    pairs = simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long"), 2).collect()
    up = {x: x for x in fps}

    def find(x):
        return x if up[x] == x else find(up[x])

    for a, b in pairs:
        assert ((a ^ b) & (1 << 64) - 1).bit_count() <= 2
        up[find(a)] = find(b)
    assert len({find(x) for x in fps}) == 2
    with pytest.raises(ValueError, match="even"):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 3)


def test_simhash_pieces_and_edges(spark, empty, rows, monkeypatch):
    assert simhash.near_duplicates(empty, 3, 2).collect() == []
    text = rows[-5][1].encode()
    whole = simhash.fingerprint(text, 3)
    monkeypatch.setattr(simhash, "PIECE", 7)
    assert simhash.fingerprint(text, 3) == whole
    assert simhash.fingerprint(None, 3) == simhash.fingerprint(b" \n", 3) == 0
    assert simhash.fingerprint(b"A b", 3) == simhash.fingerprint(b"a B", 3) != 0
