"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of ``window`` consecutive words of each benchmark item (an item of fewer words is
one window). For each pattern length a shift table over blocks of two words says how far a window may jump
without missing an occurrence; where the shift is zero, the patterns that share the window's suffix block
and prefix block are its bucket, and a direct comparison of the words confirms an occurrence. Many cursors,
one for each stretch of ``CHUNK`` window ends, advance together as numpy arrays.

The benchmark is cut into blocks of about ``BLOCK_BYTES`` of text (a longer item is a block of its own). An index
keeps the block's text and, for each of its words and windows, a few numbers, no copies of words: about 16 bytes for
each byte of text, so at most about ``16 * BLOCK_BYTES`` in the driver and in a task. The documents' texts are read in
place, once for each block, and never shuffled; the hits of a block are written before the next one is built, and its
index is released. Only ids, word counts and hits are shuffled, to merge what several blocks found.

Defined results: a null or wordless text has no words, no hits and is clean; a null or wordless item has no
window; items of equal text each count; the items without an id are searched, count as one in n_items and not
in items_sha256; a repeated row gives a row for each repetition; an empty benchmark
or document table gives no hits or no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import tokens as tk
from sluice.llm.tables import fresh, map_batches, staged, table

WINDOW = 13
BLOCK_BYTES = 4 << 20
CHUNK = 512

_U = np.uint64
_SCAN = "doc_id {id}, text_key bigint, n_words bigint, spans array<int>, items array<string>"
_RESULT = ("doc_id {id}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
           "contaminated boolean")


def _pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return tk.mix(left * _U(0x9E3779B97F4A7C15) + right)


def build_index(items: list[tuple[str | None, str]], window: int = WINDOW) -> dict[str, Any]:
    """The block's text and words and, for each pattern length, a shift table and buckets. A pattern is the place of
    its first word in the block's text; equal windows are one pattern with several owners."""
    texts = pa.array([text for _, text in items], type=pa.large_string())
    lower, start, end, hashes, count, item = [], [], [], [], [], []
    offset = 0
    for first, _, raw, offs in tk.text_slices(texts):
        words = tk.words_of(raw, offs, tk.IS_ALNUM)
        lower.append(tk.LOWER[raw].tobytes())
        start.append(words.start + offset)
        end.append(words.end + offset)
        hashes.append(words.hash)
        count.append(words.count)
        item.append(first + np.arange(len(words.count)))
        offset += len(raw)
    if not items:
        return {"groups": [], "items": [], "lower": b"", "start": np.zeros(0, np.int64), "end": np.zeros(0, np.int64)}
    text, start, end, hashes = b"".join(lower), np.concatenate(start), np.concatenate(end), np.concatenate(hashes)
    count, item = np.concatenate(count), np.concatenate(item)
    begin = np.cumsum(count) - count

    def words_at(at: int, size: int) -> list[bytes]:
        return [text[start[k]:end[k]] for k in range(at, at + size)]

    groups = []
    sizes = np.minimum(count, window)
    for size in map(int, np.unique(sizes[sizes > 0])):
        rows = np.flatnonzero(sizes == size)
        which, place = tk.spread(count[rows] - size + 1)
        first = begin[rows][which] + place
        owner = item[rows][which]
        whole = tk.sequence_hashes(hashes, first, first + size)
        order = np.lexsort((first, whole))
        first, owner, whole = first[order], owner[order], whole[order]
        same = np.zeros(len(first), dtype=bool)  # the same window as the one before
        for k in np.flatnonzero(whole[1:] == whole[:-1]) + 1:
            same[k] = words_at(first[k], size) == words_at(first[k - 1], size)
        head = np.flatnonzero(~same)
        cuts = np.append(head, len(first))
        patterns = first[head]
        keys = _bucket_key(hashes, patterns, size)
        by_key = np.argsort(keys, kind="stable")
        block = min(2, size)
        bits = max(12, math.ceil(math.log2(8 * len(hashes))))
        shift = np.full(1 << bits, size - block + 1, dtype=np.uint8 if size < 256 else np.int32)
        for last in range(block - 1, size):
            slots = _pair_hash(hashes[patterns + last - block + 1], hashes[patterns + last]) >> _U(64 - bits)
            np.minimum.at(shift, slots.astype(np.int64), shift.dtype.type(size - 1 - last))
        lengths = np.diff(cuts)[by_key]
        groups.append({"size": size, "block": block, "bits": bits, "shift": shift, "keys": keys[by_key],
                       "first": patterns[by_key].astype(np.int32 if len(hashes) < 1 << 31 else np.int64),
                       "owned": np.append(0, np.cumsum(lengths)),
                       "owners": owner[np.repeat(cuts[:-1][by_key], lengths) + tk.spread(lengths)[1]].astype(np.int32)})
    small = np.int32 if len(text) < 1 << 31 else np.int64
    return {"groups": groups, "items": [name for name, _ in items], "lower": text, "hash": hashes,
            "start": start.astype(small), "end": end.astype(small)}


def _bucket_key(hashes: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Suffix block and prefix block of the windows that begin at ``first``."""
    block, end = min(2, size), first + size
    return _pair_hash(_pair_hash(hashes[end - block], hashes[end - 1]), _pair_hash(hashes[first], hashes[first + block - 1]))


def _zero_shifts(group: dict[str, Any], words: tk.Words) -> np.ndarray:
    """Ends of the windows at which the shift table allows no jump."""
    size, block, hashes = group["size"], group["block"], words.hash
    slot = np.zeros(len(hashes), dtype=np.int64)
    slot[block - 1:] = _pair_hash(hashes[:len(hashes) - block + 1], hashes[block - 1:]) >> _U(64 - group["bits"])
    shift = group["shift"]
    ends = np.maximum(words.count - size + 1, 0)
    stretch, place = tk.spread(-(-ends // CHUNK))
    cursor = words.first[stretch] + size - 1 + place * CHUNK
    stop = np.minimum(cursor + CHUNK, words.first[stretch] + words.count[stretch])
    out = []
    while len(cursor):
        jump = shift[slot[cursor]]
        out.append(cursor[jump == 0])
        cursor = cursor + np.maximum(jump, 1)
        keep = cursor < stop
        cursor, stop = cursor[keep], stop[keep]
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def _occurrences(index: dict[str, Any], group: dict[str, Any], words: tk.Words, lower: bytes) -> Iterator[tuple[int, int]]:
    """(first word, pattern) of every occurrence."""
    size, text, start, end = group["size"], index["lower"], index["start"], index["end"]
    ends = _zero_shifts(group, words)
    for part in np.array_split(ends, max(1, len(ends) // 100_000)):
        begin = part - (size - 1)
        keys = _bucket_key(words.hash, begin, size)
        low = np.searchsorted(group["keys"], keys, side="left")
        at, place = tk.spread(np.searchsorted(group["keys"], keys, side="right") - low)
        pattern = low[at] + place
        same = np.ones(len(at), dtype=bool)
        for i in range(size):  # the words' hashes before the words themselves
            same[same] = index["hash"][group["first"][pattern[same]] + i] == words.hash[begin[at[same]] + i]
        for own, which in zip(begin[at[same]].tolist(), pattern[same].tolist(), strict=True):
            other = int(group["first"][which])
            if all(lower[words.start[own + i]:words.end[own + i]] == text[start[other + i]:end[other + i]]
                   for i in range(size)):
                yield own, which


def _scan(index: dict[str, Any], raw: np.ndarray, offs: np.ndarray) -> Iterator[tuple[int, list[int], set[int]]]:
    """Words, spans (first word, words, ...) and items hit of each row."""
    words = tk.words_of(raw, offs, tk.IS_ALNUM)
    lower = tk.LOWER[raw].tobytes()
    spans: dict[int, list[int]] = {}
    items: dict[int, set[int]] = {}
    for group in index["groups"]:
        for begin, which in _occurrences(index, group, words, lower):
            row = int(np.searchsorted(words.first, begin, side="right")) - 1
            spans.setdefault(row, []).extend((begin - int(words.first[row]), group["size"]))
            items.setdefault(row, set()).update(group["owners"][group["owned"][which]:group["owned"][which + 1]].tolist())
    for row, count in enumerate(words.count):
        yield int(count), spans.get(row, []), items.get(row, set())


def _verdict(n_words: int, spans: list[int], items: list[str | None]) -> tuple[int, int, int, str, bool]:
    hit, reached = 0, 0
    for begin, size in sorted(zip(spans[::2], spans[1::2], strict=True)):
        hit += max(0, begin + size - max(begin, reached))
        reached = max(reached, begin + size)
    named = sorted(item for item in items if item is not None)
    digest = hashlib.sha256(",".join(named).encode()).hexdigest()
    return n_words, hit, len(named) + (len(named) < len(items)), digest, hit > 0 and 20 * hit >= n_words


def find_hits(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
              block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of each row of ``documents``
    (doc_id, text) against ``benchmark`` (item_id, text)."""
    id_type = documents.schema["doc_id"].dataType.simpleString()
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where(
        "text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    which = F.pmod(F.xxhash64("item_id", F.when(F.col("item_id").isNull(), F.col("text"))), F.lit(blocks))
    docs = documents.select("doc_id", "text").withColumn("text_key", F.xxhash64("text"))

    def result(names: list[Any], found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) if found else [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
        return pa.RecordBatch.from_arrays(
            [names, *(pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True))],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    def searched(block: int) -> DataFrame:
        """Every row in the first block's scan, and in the others those with hits."""
        rows = items.where(which == block).collect()  # about ``block_bytes`` of text
        index = documents.sparkSession.sparkContext.broadcast(
            build_index(sorted(((r.item_id, r.text) for r in rows), key=lambda x: (x[0] or "", x[1])), window))

        def scan(batches):
            for batch in batches:
                n_words, spans, hits = [], [], []
                for _, _, raw, offs in tk.text_slices(batch.column("text")):
                    for n, found, hit in _scan(index.value, raw, offs):
                        n_words.append(n)
                        spans.append(found)
                        hits.append([index.value["items"][i] for i in sorted(hit)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("text_key"), pa.array(n_words, pa.int64()),
                     pa.array(spans, pa.list_(pa.int32())), pa.array(hits, pa.list_(pa.string()))],
                    names=["doc_id", "text_key", "n_words", "spans", "items"])

        found = map_batches(docs, scan, _SCAN.format(id=id_type)).withColumn("rows", F.lit(int(block == 0)))
        found = staged(found if block == 0 else found.where(F.size("spans") > 0), f"hits-{block}")
        index.destroy()
        return found

    merged = reduce(DataFrame.unionByName, [searched(block) for block in range(blocks)])
    merged = merged.groupBy("doc_id", "text_key", "n_words").agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"),
        F.sum("rows").alias("rows"))
    # equal rows were added up once for each repetition: spans may repeat, items are told apart
    merged = merged.withColumn("items", F.array_distinct("items")).withColumn(
        "row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))).drop("row", "rows", "text_key")

    def verdicts(batches):
        for batch in batches:
            yield result(batch.column("doc_id"), [
                _verdict(n, spans, items) for n, spans, items in
                zip(batch.column("n_words").to_pylist(), batch.column("spans").to_pylist(),
                    batch.column("items").to_pylist(), strict=True)])

    return map_batches(merged, verdicts, _RESULT.format(id=id_type))


def clean(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``documents``, all columns, that are not contaminated. Rows of one id and text go together."""
    verdicts = find_hits(documents.withColumn("doc_id", F.struct("doc_id", F.xxhash64("text").alias("key"))),
                         benchmark, window, block_bytes)
    bad = staged(verdicts.where("contaminated").select("doc_id.*").distinct(), "contaminated")
    id_, key = fresh(documents, "id", "key")
    bad = bad.select(F.col("doc_id").alias(id_), F.col("key").alias(key))
    return documents.join(bad, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(key)), "left_anti")


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(13, len(w)) AS k FROM bw WHERE len(w) > 0),
pats AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS p
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM sized)),
sizes AS (SELECT DISTINCT k FROM pats),
wins AS (
  SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS p
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, sizes WHERE len(w) >= k)),
hits AS (SELECT wins.doc_id, wins.i, wins.k, pats.item_id FROM wins JOIN pats USING (k, p)),
covered AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS pos FROM (SELECT DISTINCT doc_id, i, k FROM hits)) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""
