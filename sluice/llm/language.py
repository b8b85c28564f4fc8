"""Language identification with a blended-spectrum string kernel.

A text is the set of its byte n-grams of 1 to ``SPECTRUM`` bytes (A-Z lower-cased, hashed into ``SLOTS``
slots); the kernel of two texts is the cosine of their presence vectors. A Nystroem map over ``landmarks``
texts makes kernel ridge regression linear, one regression of each language against the rest. Scoring is
two matrix products for each batch of rows: presence by landmarks, then kernels by weights.

The model is fitted on at most ``per_language`` labelled rows of each language (chosen by hash of the id
among all labelled training rows; this is the documented bound) and is broadcast: landmarks x SLOTS floats,
whatever the size of the input. Every row is scored, over its whole text, without a shuffle.

Defined results: a null text and a text without a letter are ``und`` with score 0; without any labelled row
every text is. ``score`` is the winning regression's output moved from [-1, 1] to [0, 1]. A null doc_id is
never learned from and is not held out. Repeated rows are scored each; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm import tokens as tk
from sluice.llm.tables import map_batches, table

SPECTRUM = 3
SLOTS = 1 << 13
ROWS = 512
PER_LANGUAGE = 500
LANDMARKS = 128
RIDGE = 1e-3
#: In a filter, texts below this resemble no language; short texts in a known language score above.
LEAST_SCORE = 0.25

_FACTORS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))
_IS_LETTER = np.zeros(256, dtype=bool)
_IS_LETTER[ord("a"):ord("z") + 1] = True


def held_out(doc_id: Column) -> Column:
    """The fold that no model learns from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def presence(raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """float32 matrix of rows by slots: 1 where the row has an n-gram of the slot."""
    rows = len(offs) - 1
    out = np.zeros(rows * SLOTS, dtype=np.float32)
    low = tk.LOWER[raw].astype(np.uint32)
    base = np.repeat(np.arange(rows, dtype=np.int64) * SLOTS, np.diff(offs))
    left = np.repeat(offs[1:], np.diff(offs)) - np.arange(len(raw))  # bytes from here to the row's end
    code = np.zeros(len(raw), dtype=np.uint32)
    for n in range(SPECTRUM):
        if n >= len(raw):
            break
        code = code[:len(raw) - n] * np.uint32(257) + low[n:] + np.uint32(1)
        slot = (code * _FACTORS[n % 3]) >> np.uint32(32 - (SLOTS.bit_length() - 1))
        within = left[:len(slot)] > n
        out[base[:len(slot)][within] + slot[within]] = 1
    return out.reshape(rows, SLOTS)


def has_letter(raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    low = tk.LOWER[raw]
    count = np.concatenate([[0], np.cumsum(_IS_LETTER[low])])
    found = count[offs[1:]] > count[offs[:-1]]
    for row in np.flatnonzero(~found & (np.diff(offs) > 0)):
        found[row] = any(c.isalpha() for c in raw[offs[row]:offs[row + 1]].tobytes().decode("utf-8", "replace"))
    return found


def _unit(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.maximum(np.sqrt(matrix.sum(axis=1, keepdims=True)), 1)  # entries are 0 or 1


def _matrix(texts: list[str]) -> np.ndarray:
    parts = [_unit(presence(raw, offs)) for _, _, raw, offs in
             tk.text_slices(pa.array(texts, pa.string()), max_rows=ROWS)]
    return np.concatenate(parts) if parts else np.zeros((0, SLOTS), dtype=np.float32)


def fit(rows: list[tuple[str, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> dict | None:
    """Model from (lang, text) rows; the first rows of each language serve as landmarks."""
    langs = sorted({lang for lang, _ in rows})
    if not langs:
        return None
    share = max(1, landmarks // len(langs))
    chosen = [i for lang in langs for i in [j for j, r in enumerate(rows) if r[0] == lang][:share]]
    x = _matrix([text for _, text in rows])
    base = x[chosen]
    values, vectors = np.linalg.eigh((base @ base.T).astype(np.float64))
    keep = values > 1e-6 * values[-1]
    root = vectors[:, keep] / np.sqrt(values[keep])            # K_mm ** -1/2
    phi = np.hstack([(x @ base.T) @ root, np.ones((len(rows), 1))])
    target = np.array([[1.0 if lang == own else -1.0 for lang in langs] for own, _ in rows])
    weight = np.array([len(rows) / (len(langs) * sum(r[0] == own for r in rows)) for own, _ in rows])
    penalty = ridge * len(rows) * np.eye(phi.shape[1])
    penalty[-1, -1] = 0
    solved = np.linalg.lstsq(phi.T @ (phi * weight[:, None]) + penalty, phi.T @ (target * weight[:, None]),
                             rcond=None)[0]
    return {"langs": langs, "landmarks": np.ascontiguousarray(base.T), "bias": solved[-1],
            "weights": (root @ solved[:-1]).astype(np.float32)}


def training_rows(documents: DataFrame, per_language: int = PER_LANGUAGE) -> list[tuple[str, str]]:
    """At most ``per_language`` (lang, text) rows of each language, the least by hash of the id."""
    spark = documents.sparkSession
    pool = documents.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull()
                           & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id")))
    counts = pool.groupBy("lang").count()
    # a hash threshold, with room, keeps the sort for the exact bound to a few rows of each language
    span = float(1 << 40)
    cut = counts.select("lang", F.least(F.lit(span), F.lit(1.5 * per_language * span) / F.col("count")
                                        + F.lit(20 * span) / F.col("count")).alias("cut"))
    cuts = {r["lang"]: r["cut"] for r in cut.collect()}
    if not cuts:
        return []
    limits = spark.createDataFrame(list(cuts.items()), "lang string, cut double")
    place = Window.partitionBy("lang").orderBy("order", "doc_id", "text")
    near = (pool.select("lang", "text", "doc_id", F.xxhash64(F.col("doc_id").cast("string")).alias("order"))
            .join(F.broadcast(limits), "lang").where(F.pmod("order", F.lit(1 << 40)) < F.col("cut"))
            .withColumn("order", F.pmod("order", F.lit(1 << 40))))
    rows = near.withColumn("n", F.row_number().over(place)).where(F.col("n") <= per_language)
    return [(r["lang"], r["text"]) for r in rows.orderBy("lang", "n").select("lang", "text").collect()]


def classify(model: dict | None, texts: pa.Array) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    langs, scores = [], []
    for _, _, raw, offs in tk.text_slices(texts, max_rows=ROWS):
        if model is None:
            langs += ["und"] * (len(offs) - 1)
            scores += [0.0] * (len(offs) - 1)
            continue
        kernel = _unit(presence(raw, offs)) @ model["landmarks"]
        out = kernel @ model["weights"] + model["bias"]
        best = out.argmax(axis=1)
        top = np.clip((out[np.arange(len(out)), best] + 1) / 2, 0, 1)
        for which, value, letters in zip(best, top, has_letter(raw, offs), strict=True):
            langs.append(model["langs"][which] if letters else "und")
            scores.append(float(value) if letters else 0.0)
    return langs, scores


def identified(documents: DataFrame, model: dict | None, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``documents``, all columns, whose text has a language: not ``und``, and a score of
    ``least`` or more."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def keep(batches):
        for batch in batches:
            langs, scores = classify(shared.value, batch.column("text"))
            yield batch.filter(pa.array([lang != "und" and score >= least
                                         for lang, score in zip(langs, scores, strict=True)], pa.bool_()))

    return map_batches(documents, keep, documents.schema)


def predict(documents: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row of ``documents`` (doc_id, text)."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def score(batches):
        for batch in batches:
            langs, scores = classify(shared.value, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()),
                 pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return map_batches(rows, score, f"doc_id {id_type}, held_out boolean, lang_pred string, score double")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return predict(documents, fit(training_rows(documents)))
