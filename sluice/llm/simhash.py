"""Near duplicates by SimHash fingerprints, found by meet-in-the-middle ball hashing.

A text's fingerprint has 64 bits: bit i is 1 if it is set in over half of the XXH64 values (UTF-8, seed 42) of
the text's shingles, repeats included. Documents link when their fingerprints differ in at most ``radius`` bits
(an even number).

Every distinct fingerprint emits all variants within ``radius / 2`` flipped bits, itself included. The rows are
shuffled on the variants. Two fingerprints that link have a variant in the middle between them, so they meet;
those that meet at one variant are at most ``radius`` apart. Within a variant, the pairs of the least fingerprint
with each other one connect the same fingerprints as all pairs do; they are deduplicated over the variants,
verified by their differing bits, and joined to components.

Bounds. Equal fingerprints are one row before anything is emitted, so copies of a text, however many, emit once,
and a variant is met by at most as many fingerprints as its ball holds (65 for radius 2). Nothing is collected:
pairs and labels stay tables in the shared folder. Texts are tokenised in pieces of ``PIECE`` bytes.

Defined results. A-Z are lower-cased; words are runs of bytes other than 0x20 and 0x09-0x0D. A text of fewer words
than a shingle has its whole sequence as its one shingle. A null, empty or blank text has the fingerprint zero,
which links like any other. Repeated rows are each returned. Rows without an id are returned with the least id of
their component (null if no row of it has one). Columns besides doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.components import components
from sluice.llm.tables import staged, table

BITS = 64
SEED = 42
PIECE = 1 << 20
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SPACE = b" \t\n\x0b\x0c\r"


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text cut after blanks, about every ``PIECE`` bytes."""
    start = 0
    while start < len(text):
        stop = start + PIECE
        if stop < len(text):
            found = [at for at in (text.find(bytes([b]), stop) for b in _SPACE) if at >= 0]
            stop = min(found) + 1 if found else len(text)
        yield text[start:stop]
        start = stop


def shingle_hashes(text: bytes, size: int) -> Iterator[np.ndarray]:
    """The hashes of the text's shingles, in pieces."""
    held: list[bytes] = []  # the words that later shingles begin with
    short = True
    for piece in _pieces(text):
        words = held + piece.translate(_LOWER).split()
        if len(words) >= size:
            ends = np.cumsum([len(w) + 1 for w in words])
            joined, firsts = b" ".join(words), [0, *ends.tolist()]
            lasts = (ends - 1).tolist()[size - 1:]
            yield np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(firsts, lasts)),
                              dtype=np.uint64, count=len(lasts))
            short = False
        held = words[max(0, len(words) - size + 1):] if size > 1 else []
    if short and held:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(held), SEED)], dtype=np.uint64)


def fingerprint(text: bytes | None, size: int) -> int:
    """The fingerprint as a signed 64-bit number."""
    ones, n = np.zeros(BITS, dtype=np.int64), 0
    for hashes in shingle_hashes(text or b"", size):
        for first in range(0, len(hashes), 4096):
            part = hashes[first:first + 4096].astype("<u8")
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
                axis=0, dtype=np.int64)
        n += len(hashes)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(documents: DataFrame, size: int) -> DataFrame:
    """doc_id and fp (long) of each row of ``documents`` (doc_id, text)."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            text = batch.column("text").cast(pa.large_binary())
            found = [fingerprint(v.as_buffer().to_pybytes() if v.is_valid else None, size) for v in text]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.int64())],
                                             names=["doc_id", "fp"])

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


def ball(radius: int) -> list[int]:
    """The masks of at most ``radius`` bits, as signed numbers."""
    masks = (sum(1 << b for b in some) for n in range(radius + 1) for some in combinations(range(BITS), n))
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """Pairs (a, b) of the fingerprints ``fp`` that connect all those within ``radius`` bits."""
    if radius % 2:
        raise ValueError("the radius must be even: each side goes half the way")
    variants = distinct.select("fp", F.explode(F.array(*map(F.lit, ball(radius // 2)))).alias("mask")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
    met = variants.select("fp", F.min("fp").over(Window.partitionBy("variant")).alias("least"))
    pairs = met.where("fp <> least").select(F.col("least").alias("a"), F.col("fp").alias("b")).distinct()
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_duplicates(documents: DataFrame, size: int, radius: int) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id (the least id that links reach) of each row
    of ``documents`` (doc_id, text)."""
    marked = staged(fingerprints(documents, size), "fingerprints")
    classes = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "fingerprint-classes")
    labels = components(links(classes.select("fp"), radius))
    named = (classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
             .select("fp", "least_id", F.coalesce("label", "fp").alias("label")))
    least = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
    # written, so that the join below reads it as it is: a fingerprint that a third of the rows have is split there
    named = staged(named.join(least, "label").select("fp", "component_id"), "fingerprint-components")
    return marked.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op13_simhash_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=3, radius=2)
