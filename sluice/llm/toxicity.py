"""Toxicity scores from a factorization machine over hashed terms.

A text is the set of its words' 64-bit hashes. The score is the logistic of
``w0 + sum w_i + sum_{i<j} <v_i, v_j>`` over its terms: the second sum learns pairs, such as an insult next
to a group's name, that no sum of single weights can. It is computed as half of ``|sum v|^2 - sum |v|^2``.

The machine is fitted by AdaGrad, classes weighing the same, on at most ``per_class`` labelled rows of each class (the least by hash of
the id among the training folds; this is the documented bound), over the terms whose presence in them is linked with the
label; its intercept is then moved towards the classes' true shares. The model (terms of the bounded sample)
is broadcast; every row is scored over its whole text without a shuffle.

Defined results: empty and null texts get the prior's score; without labelled rows of both classes every
score is the share of toxic rows among the labelled ones, or 0. A row labelled twice counts as toxic if any
label says so; null labels and null ids are not learned from. Repeated rows are scored each; other columns
are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import tokens as tk
from sluice.llm.language import held_out
from sluice.llm.tables import table

PER_CLASS = 3000
FACTORS = 4
MIN_ROWS = 3
EPOCHS = 150
RATE = 0.3
PENALTY = 1e-4


def terms(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct words of each row."""
    return tk.shingles_of(tk.words_of(raw, offs, tk.IS_ALNUM), 1)


def _association(present: np.ndarray, positive: np.ndarray, rows: int, share: float) -> np.ndarray:
    """Log-likelihood ratio of each term's presence against the label."""
    def part(seen, of, rate):
        expected = np.maximum(of * rate, 1e-12)
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-12) / expected), 0.0)

    absent = rows - present
    gone = rows * share - positive
    return 2 * (part(positive, present, share) + part(present - positive, present, 1 - share)
                + part(gone, absent, share) + part(absent - gone, absent, 1 - share))


def fit(rows: list[tuple[int, np.ndarray]], prior: float, seed: int = 7) -> dict | None:
    """Model from (label, term hashes) rows; ``prior``: the share of label 1 among all labelled rows.

    Terms enter if their association with the label is beyond what the most extreme of as many unrelated
    terms would show (the universal threshold 2 ln(terms)); else the many rare terms would be learned by
    heart."""
    labels = np.array([label for label, _ in rows], dtype=np.float64)
    if not len(labels) or labels.min() == labels.max():
        return None
    owner, _ = tk.spread(np.array([len(t) for _, t in rows]))
    known, term = np.unique(np.concatenate([t for _, t in rows]), return_inverse=True)
    present = np.bincount(term, minlength=len(known)).astype(np.float64)
    positive = np.bincount(term, labels[owner], len(known))
    tried = present >= MIN_ROWS
    strong = tried & (_association(present, positive, len(rows), labels.mean())
                      >= 2 * np.log(max(2, tried.sum())))
    place = np.cumsum(strong) - 1
    keep = strong[term]
    row, term, known = owner[keep], place[term[keep]], known[strong]

    rng = np.random.default_rng(seed)
    weights = np.concatenate([np.zeros((len(known), 1)), rng.normal(0, 0.05, (len(known), FACTORS))], axis=1)
    balance = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())) / len(rows)
    squares, bias, bias_square = np.full_like(weights, 1e-8), 0.0, 1e-8
    for _ in range(EPOCHS):
        margin, total = _margin(bias, weights, row, term, len(rows))
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels) * balance
        own = weights[term]
        slope = np.concatenate([np.ones((len(row), 1)), total[row][:, 1:] - own[:, 1:]], axis=1) * error[row][:, None]
        grad = np.stack([np.bincount(term, slope[:, j], len(known)) for j in range(FACTORS + 1)], axis=1)
        grad += PENALTY * weights
        squares += grad ** 2
        weights -= RATE * grad / np.sqrt(squares)
        bias_square += error.sum() ** 2
        bias -= RATE * error.sum() / np.sqrt(bias_square)
    bias += 0.5 * np.log(prior / (1 - prior))  # half way from equal classes to the true shares
    return {"terms": known, "weights": weights, "bias": float(bias)}


def _margin(bias: float, weights: np.ndarray, row: np.ndarray, term: np.ndarray,
            rows: int) -> tuple[np.ndarray, np.ndarray]:
    own = weights[term]
    total = np.stack([np.bincount(row, own[:, j], rows) for j in range(weights.shape[1])], axis=1)
    pairs = np.bincount(row, (own[:, 1:] ** 2).sum(axis=1), rows)
    return bias + total[:, 0] + 0.5 * ((total[:, 1:] ** 2).sum(axis=1) - pairs), total


def scores(model: dict, raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    row, hashed = terms(raw, offs)
    rows, known = len(offs) - 1, model["terms"]
    at = np.minimum(np.searchsorted(known, hashed), max(0, len(known) - 1))
    have = known[at] == hashed if len(known) else np.zeros(len(hashed), dtype=bool)
    margin, _ = _margin(model["bias"], model["weights"], row[have], at[have], rows)
    return 1 / (1 + np.exp(-np.clip(margin, -700, 700)))


def train(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[dict | None, float]:
    """The fitted model (None without both classes) and the share of toxic rows among the labelled ones."""
    marked = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()
                           & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    counts = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    if not counts.get(0) or not counts.get(1):
        return None, prior
    order = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = [marked.where(F.col("toxic") == label).orderBy(order, "doc_id").limit(per_class) for label in (0, 1)]

    def features(batches):
        for batch in batches:
            hashed = []
            for _, _, raw, offs in tk.text_slices(batch.column("text")):
                row, found = terms(raw, offs)
                cuts = np.searchsorted(row, np.arange(len(offs)))
                hashed += [found[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"),
                                              pa.array(hashed, pa.binary())], names=["doc_id", "toxic", "terms"])

    # at most 2 x per_class ids: a proven bound for the broadcast
    sample = documents.select("doc_id", "text").join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = sample.mapInArrow(features, f"doc_id {kind}, toxic int, terms binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["terms"])))
    return fit([(r["toxic"], np.frombuffer(bytes(r["terms"]), dtype=np.uint64)) for r in rows], prior), prior


def predict(documents: DataFrame, model: dict | None, prior: float = 0.0) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of ``documents`` (doc_id, text)."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def score(batches):
        got = shared.value
        for batch in batches:
            parts = [np.zeros(0)]
            for _, _, raw, offs in tk.text_slices(batch.column("text")):
                parts.append(np.full(len(offs) - 1, prior) if got is None else scores(got, raw, offs))
            value = np.concatenate(parts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(value, pa.float64()),
                 pa.array((value >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return predict(documents, *train(documents, table(spark, sf_dir, "labels")))
