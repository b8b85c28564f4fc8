"""The personal-data classifier: look-alikes, forms that the base rules miss, thresholds, overlaps, odd rows."""

import random

import numpy as np
import pytest

from conftest import SF01
from sluice.llm import pii
from sluice.llm.tables import table


@pytest.fixture(scope="module")
def rows(spark):
    # the larger table: personal data is rare in the small ones
    return pii.training_rows(table(spark, "/root/testdata/sf0.1", "documents"))


@pytest.fixture(scope="module")
def model(rows):
    return pii.fit(rows)


LOOK_ALIKES = ["we sold 5@3 each", "git@host ran ok", "version 1.2.3.4567", "999.999.999.999", "section 1-2-3-4 of 10",
               "room 1:2:3:4", "on 2024-05-06 we met", "since 1990-1995", "id 12345678 is free", "pi is 3.14159265358",
               "pages 10 20 30 40", "release 10.300.2.1 is out"]


@pytest.mark.parametrize("text", LOOK_ALIKES)
def test_look_alikes_are_left_alone(model, text):
    assert set(model) == set(pii.KINDS)
    assert pii.all_spans(text, model) == ([], [])


def _planted(rng):
    """(text, kind or None, span) with forms that the base rules miss, and look-alikes, in plain sentences."""
    word = lambda: rng.choice("river stone garden cloud letter table morning".split())
    digits = lambda n: "".join(str(rng.randint(0, 9)) for _ in range(n))
    name = f"{word()}.{word()}{rng.randint(1, 99)}"
    quad = [rng.randint(1, 255) for _ in range(4)]
    forms = [("email", f"{name} [at] {word()}.com"), ("email", f"{name}(at){word()}(dot)org"),
             ("email", f"{name} (at) {word()} [dot] net"), ("phone", f"({digits(3)}) {digits(3)}-{digits(4)}"),
             ("phone", f"555 {digits(3)} {digits(4)}"), ("phone", f"555-{digits(3)}-{digits(4)}"),
             ("ip", " . ".join(map(str, quad))), ("ip", ". ".join(map(str, quad))),
             (None, f"{rng.randint(1, 99)}@{rng.randint(1, 99)}"), (None, f"{word()}@{word()}"),
             (None, f"{rng.randint(1, 12)}.{rng.randint(0, 20)}.{rng.randint(0, 20)}.{rng.randint(1000, 9999)}"),
             (None, ":".join(str(rng.randint(1, 30)) for _ in range(4))), (None, f"{rng.randint(1950, 2029)}-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}"),
             (None, ".".join(str(rng.randint(256, 999)) for _ in range(4)))]
    kind, span = rng.choice(forms)
    before = f"the {word()} and the {word()} "
    return before + span + f" by the {word()}", kind, (len(before), len(before) + len(span))


def test_planted_forms_are_found(model):
    rng = random.Random(8)
    right = wrong = missed = 0
    for _ in range(1500):
        text, kind, (start, end) = _planted(rng)
        base, spans = pii.all_spans(text, model)
        added = [s for s in spans if s not in base]
        good = [s for s in added if s[0] == kind and s[1] < end and start < s[2]]
        right += bool(good)
        wrong += len(added) - len(good)
        missed += kind is not None and not base and not good
    assert right / (right + wrong) >= 0.9, (right, wrong, missed)
    assert right / (right + missed) >= 0.75, (right, wrong, missed)


def test_sample_is_bounded_for_each_kind(spark, rows):
    docs = table(spark, SF01, "documents")
    few = pii.training_rows(docs, sample=20, per_group=7)
    for kind in pii.KINDS:
        groups = [(e.label, e.settled) for _, e in few if e.kind == kind]
        assert groups and max(groups.count(g) for g in set(groups)) <= 7
        for half in (False, True):
            assert {e.label for h, e in rows if e.kind == kind and h == half} == {False, True}


def test_threshold_is_the_least_that_is_precise():
    rng = np.random.default_rng(3)
    for _ in range(300):
        score, label = rng.integers(0, 12, 25) / 11, rng.integers(0, 2, 25)
        fine = [s for s in set(score) if s > 0.5 and label[score >= s].mean() >= 0.7]
        found = pii.threshold(score, label, 0.7)
        assert (found is None) == (not fine)
        if fine:
            assert found >= 0.5 and (score >= found).tolist() == (score >= min(fine)).tolist()


def test_kinds_without_both_labels_accept_nothing(rows):
    only = [(half, e) for half, e in rows if e.label or e.kind != "email"]
    assert "email" not in pii.fit(only) and pii.fit([]) == {}
    assert pii.all_spans("bob [at] host [dot] com", pii.fit(only))[1] == []


def test_overlaps_ties_and_odd_rows(spark, model):
    texts = [None, "", "call 555 123 4567 or 555 123 4567", "call 555 123 4567 or 555 123 4567", "+12 345 678 901 and a@b.co"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in pii.find(docs, model, with_text=True).collect()}
    assert (got[0].spans, got[0].n_added, got[0].redacted) == ("", 0, "") == (got[1].spans, got[1].n_added, got[1].redacted)
    assert got[2].spans == got[3].spans == "phone:5:17,phone:21:33"
    assert got[4].n_added == 0 and got[4].redacted == "<phone> and <email>"
    spans = pii.all_spans("1.2.3.4 and 4111 1111 1111 1111 and 10 . 9 . 8 . 7", model)[1]
    assert all(a[2] <= b[1] or a in pii.base_spans("") for a, b in zip(spans, spans[1:]))


def test_the_model_is_learned_from_all_documents(spark, monkeypatch):
    """What the dataset's blocks give is what all examples at hand give; more texts than any bound change the counts."""
    from sluice.llm import boosting
    rng = random.Random(5)
    texts = [_planted(rng)[0] + f" mail w{i}@h{i % 7}.com or +1 555 {i:03} 4567" for i in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    seen = {}
    fit_frame = boosting.fit_frame

    def counted(rows, **options):
        seen.update({r["group"]: r["count"] for r in rows.groupBy("group").count().collect()})
        return fit_frame(rows, **options)

    monkeypatch.setattr(boosting, "fit_frame", counted)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 300)
    found, rows = pii.learn(docs), pii.training_rows(docs)
    want = pii.fit(rows)
    assert set(found) == set(want) and len(want) >= 2
    assert seen == {k: sum(half for half, e in rows if e.kind == k) for k in seen} and set(want) <= set(seen)
    for kind, (forest, least) in want.items():
        assert all(np.allclose(a, b) for a, b in zip(forest, found[kind][0])) and abs(least - found[kind][1]) < 1e-9
    # one kind and label beyond the bound of 3,000 that the sample had
    many = spark.range(900).selectExpr("id AS doc_id", "concat('mail me', id, '@host', id % 9, '.com now') AS text")
    assert sum(e.kind == "email" and e.label and not e.settled for _, e in pii.training_rows(many)) > 3000


def test_cuts_are_exact_quantiles(spark):
    from sluice.llm import boosting
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.integers(0, 9, 700), rng.normal(size=700), np.zeros(700)])
    rows = spark.createDataFrame([("a", v.tolist()) for v in x], "group string, features array<double>").repartition(3)
    cuts = boosting.cuts_of(rows)["a"]
    places = np.linspace(0, 1, boosting.BINS + 1)[1:-1]
    for j, got in enumerate(cuts):
        assert got.tolist() == np.unique(np.quantile(x[:, j], places, method="inverted_cdf")).tolist()


def test_no_documents_give_no_model(spark):
    assert pii.learn(spark.createDataFrame([], "doc_id long, text string")) == {}
    assert pii.learn(spark.createDataFrame([(None, None), (1, "")], "doc_id long, text string")) == {}
