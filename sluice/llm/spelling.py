"""Groups of spelling variants: words one edit apart, found by blocked Gram matrices of letter counts.

Words are the maximal runs of letters A-Z, a-z and U+00C0-U+00FF of the texts, with A-Z lower-cased. Those of at
least ``LEAST_LENGTH`` code points and ``LEAST_COUNT`` occurrences over all documents form the vocabulary. Two words
are near if they differ by exactly one inserted, deleted or replaced code point; their letter counts then have a
squared distance of 1 or 2 and their lengths differ in at most one.

Blocks. The letters are dealt into ``GROUPS`` groups of like frequency (counted over the whole vocabulary). One edit
touches the counts of at most two groups, so near words agree in the counts of some ``GROUPS - 2`` groups; each word
enters one block for every such choice. A block is sorted by length, and NumPy products of the letter-count matrices
of each length with its own and the next one give the Gram matrix, from it the squared distances. Pairs at most 2
apart are compared code point by code point. A pair that several blocks hold is counted in the first choice only.
Small blocks of like size are multiplied together as one stack.

Bounds. A task holds about ``BUCKET_ROWS`` words; a block of more than ``TILE`` words is cut into tiles, one task for
each pair of tiles, so no block, however large, is one task's. Products are made in strips of ``STRIP`` values. A task
that counts words keeps at most ``FLUSH`` of them before it sends them on. The driver gets the vocabulary's letter
counts (the pattern has 116 letters) and row counts. Each task sends one row for each word it found near words of.

Defined results. Null and empty texts have no words. Repeated rows count each. A null id counts as the empty string
in ``<doc_id>:<run>``. An empty table has no words. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.tables import staged, table
from sluice.llm.tokens import mix

LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A run whose crc32 with its document's id this divides loses one code point.
DROPPED = 97
#: A word's form has at least so many times its count.
FORM_RATIO = 2
GROUPS = 5
BUCKET_ROWS, TILE, STRIP, FLUSH, PIECE = 50_000, 4096, 1 << 22, 500_000, 1 << 20
#: Blocks of up to so many words are multiplied in stacks.
STACKED = 64
LETTERS = 256
_RUN = re.compile("[a-zÀ-ÿ]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_U = np.uint64


def runs_of(text: bytes) -> Iterator[list[str]]:
    """The lower-cased runs of a text, in pieces that no run crosses."""
    lowered = text.translate(_LOWER).decode("utf-8", "replace")
    at = 0
    while at < len(lowered):
        stop = at + PIECE
        if stop < len(lowered) and (rest := _RUN.match(lowered, stop)):
            stop = rest.end()
        yield _RUN.findall(lowered, at, stop)
        at = stop


def count_words(documents: DataFrame, dropped: int = DROPPED, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(word, n): the words of all documents with their occurrences, summed over all rows."""

    def run(batches):
        total: Counter[str] = Counter()

        def sent():
            out = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())],
                                             names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary())):
                if not text.is_valid:
                    continue
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                own: Counter[str] = Counter()
                for runs in runs_of(text.as_buffer().to_pybytes()):
                    own.update(runs)
                for word, n in own.items():
                    if len(word) < least_length:
                        continue  # it may lose a code point, never gain one
                    h = zlib.crc32(word.encode(), start)
                    if h % dropped == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < least_length:
                            continue
                    total[word] += n
                if len(total) >= FLUSH:
                    yield sent()
        yield sent()

    return (documents.select("doc_id", "text").mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


class Coded:
    """Words as code points laid end to end."""

    def __init__(self, words: list[str]):
        self.points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        self.length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        self.start = np.cumsum(self.length) - self.length
        self.word = np.repeat(np.arange(len(words)), self.length)

    def digests(self, group: np.ndarray, groups: int) -> np.ndarray:
        """For every group of letters a digest of the counts of its letters in each word."""
        value = mix(self.points.astype(_U) + _U(1))
        running = np.zeros((groups, len(self.points) + 1), dtype=_U)
        for g in range(groups):
            np.cumsum(np.where(group[self.points] == g, value, _U(0)), out=running[g, 1:])
        return running[:, self.start + self.length] - running[:, self.start]

    def counts(self, column: np.ndarray, columns: int, kind) -> np.ndarray:
        """The matrix of letter counts, a row for each word."""
        cell = self.word * columns + column[self.points]
        return np.bincount(cell, minlength=len(self.length) * columns).reshape(-1, columns).astype(kind)

    def one_edit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs of words (the first not longer than the second) differ by one edit."""
        out = np.zeros(len(a), dtype=bool)
        for n in np.unique(self.length[a]):
            of = np.flatnonzero(self.length[a] == n)
            for first in range(0, len(of), max(1, STRIP // int(n))):
                at = of[first:first + max(1, STRIP // int(n))]
                x = self.points[self.start[a[at]][:, None] + np.arange(n)]
                y_at = self.start[b[at]][:, None] + np.arange(n)
                same = x == self.points[y_at]
                longer = self.length[b[at]] - n
                head = np.cumprod(same, axis=1, dtype=np.int64).sum(axis=1)
                shifted = x == self.points[y_at + longer[:, None]]
                tail = np.cumprod(shifted[:, ::-1], axis=1, dtype=np.int64).sum(axis=1)
                out[at] = np.where(longer == 0, (~same).sum(axis=1) == 1, (longer == 1) & (head + tail >= n))
        return out


def _stacked(blocks: list[np.ndarray], counts: np.ndarray, length: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidate pairs within small blocks: Gram matrices of blocks of like size, many at a time."""
    sizes = np.array([len(x) for x in blocks])
    width = 2
    while width <= STACKED:
        of = np.flatnonzero((sizes > width // 2) & (sizes <= width))
        step = max(1, STRIP // (width * max(width, counts.shape[1])))
        for first in range(0, len(of), step):
            some = [blocks[k] for k in of[first:first + step]]
            at = np.full((len(some), width), -1)
            n = sizes[of[first:first + step]]
            at[np.arange(width) < n[:, None]] = np.concatenate(some)
            x = counts[at]
            norm = np.einsum("bij,bij->bi", x, x)
            apart = norm[:, :, None] + norm[:, None, :] - 2 * np.matmul(x, x.transpose(0, 2, 1))
            size = np.where(at >= 0, length[at], -9)
            grown = size[:, None, :] - size[:, :, None]  # the second word's length less the first's
            real = (at >= 0)[:, None, :] & (at >= 0)[:, :, None]
            tied = (grown == 0) & (np.arange(width)[:, None] < np.arange(width))
            k, i, j = np.nonzero((apart <= 2) & real & (tied | (grown == 1)))
            yield at[k, i], at[k, j]
        width *= 2


def _adjacent(block: np.ndarray, counts: np.ndarray, length: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidate pairs within a large block: the Gram matrices of each length with itself and the next."""
    block = block[np.argsort(length[block], kind="stable")]
    own = length[block]
    for n in np.unique(own):
        x, y = block[own == n], block[(own == n) | (own == n + 1)]
        wide, norm = counts[y].T, np.einsum("ij,ij->i", counts[y], counts[y])
        step = max(1, STRIP // len(y))
        for first in range(0, len(x), step):
            part = counts[x[first:first + step]]
            apart = norm + np.einsum("ij,ij->i", part, part)[:, None] - 2 * (part @ wide)
            # words of length n come first in y: each pair of them once
            later = np.arange(len(y)) > np.arange(first, first + len(part))[:, None]
            i, j = np.nonzero((apart <= 2) & later)
            yield x[first + i], y[j]


def near_pairs(words: list[str], block: np.ndarray, choice: np.ndarray, side: np.ndarray, group: np.ndarray,
               groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows (a, b) of near words that share a block, for blocks of rows with one value of ``block``; rows of
    different ``side`` meet, and those of side 0 meet one another. ``choice``: which groups of letters the block's
    words agree in; a pair that agrees in an earlier choice too is left to that one."""
    coded = Coded(words)
    used, column = np.unique(coded.points, return_inverse=True)
    columns = np.zeros(int(used.max(initial=0)) + 1, dtype=np.int64)
    columns[used] = np.arange(len(used))
    kind = np.float32 if coded.length.max(initial=0) < 2000 else np.float64  # squares stay exact
    counts = coded.counts(columns, max(1, len(used)), kind)
    order = np.argsort(block, kind="stable")
    cuts = np.flatnonzero(np.diff(block[order])) + 1
    blocks = [x for x in np.split(order, cuts) if len(x) > 1]
    large = [x for x in blocks if len(x) > STACKED]
    found = [*_stacked([x for x in blocks if len(x) <= STACKED], counts, coded.length),
             *(pair for x in large for pair in _adjacent(x, counts, coded.length))]
    a, b = (np.concatenate([p[k] for p in found]) if found else np.zeros(0, dtype=np.int64) for k in (0, 1))
    keep = (side[a] == 0) | (side[a] != side[b])
    a, b = a[keep], b[keep]
    equal = coded.digests(group, groups)
    equal = equal[:, a] == equal[:, b]
    first = np.full(len(a), -1)
    for number, chosen in enumerate(combinations(range(groups), groups - 2)):
        first = np.where((first < 0) & equal[list(chosen)].all(axis=0), number, first)
    keep = first == choice[a]
    a, b = a[keep], b[keep]
    keep = coded.one_edit(a, b)
    return a[keep], b[keep]


def _best(a: np.ndarray, b: np.ndarray, words: list[str], n: np.ndarray) -> pa.Table:
    """For each word of the pairs: how many near words it has, and the best of them."""
    own, other = np.concatenate([a, b]), np.concatenate([b, a])
    by_word: dict[str, list] = {}
    for x, y in zip(own.tolist(), other.tolist(), strict=True):
        seen = by_word.setdefault(words[x], [0, None])
        seen[0] += 1
        best = (-int(n[y]), words[y])
        if seen[1] is None or best < seen[1]:
            seen[1] = best
    return pa.table({"word": pa.array(by_word.keys(), pa.string()),
                     "n_near": pa.array([k for k, _ in by_word.values()], pa.int64()),
                     "form_n": pa.array([-best[0] for _, best in by_word.values()], pa.int64()),
                     "form": pa.array([best[1] for _, best in by_word.values()], pa.string())})


def letter_groups(vocabulary: DataFrame, groups: int) -> np.ndarray:
    """The group of each letter: the most frequent first, each into the group that has least so far."""
    letters = (vocabulary.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''")
               .groupBy("letter").count().collect())
    group, held = np.zeros(LETTERS, dtype=np.int64), [0] * groups
    for row in sorted(letters, key=lambda r: (-r["count"], r["letter"])):
        least = held.index(min(held))
        group[ord(row["letter"])] = least
        held[least] += row["count"]
    return group


def near_words(vocabulary: DataFrame, groups: int = GROUPS, bucket_rows: int = BUCKET_ROWS, tile: int = TILE) -> DataFrame:
    """(word, n_near, form_n, form) of each word of the vocabulary (word, n) that has near words."""
    group = letter_groups(vocabulary, groups)
    choices = list(combinations(range(groups), groups - 2))
    buckets = max(1, -(-vocabulary.count() * len(choices) // bucket_rows))

    def deal(batches):
        for batch in batches:
            words = batch.column("word").to_pylist()
            digest = Coded(words).digests(group, groups)
            for number, chosen in enumerate(choices):
                key = np.full(len(words), number + 1, dtype=_U)
                for g in chosen:
                    key = mix(key * _U(0x9E3779B97F4A7C15) + digest[g])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("word"), batch.column("n"), pa.array(np.full(len(words), number), pa.int32()),
                     pa.array(key.view(np.int64))], names=["word", "n", "choice", "block"])

    dealt = vocabulary.mapInArrow(deal, "word string, n long, choice int, block long")
    large = staged(dealt.groupBy("block").count().where(F.col("count") > tile).select(
        "block", F.ceil(F.col("count") / tile).cast("int").alias("tiles")), "spelling-large-blocks")
    one = dealt.join(large, "block", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int")
    met = (one.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
           .select("word", "n", "choice", F.xxhash64("block", F.least("own", "other"), F.greatest("own", "other")).alias("block"),
                   F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"))
           .withColumn("bucket", F.pmod("block", F.lit(buckets)).cast("int")))

    def compare(rows: pa.Table) -> pa.Table:
        words, n = rows.column("word").to_pylist(), rows.column("n").to_numpy()
        block, choice, side = (rows.column(c).to_numpy() for c in ("block", "choice", "side"))
        return _best(*near_pairs(words, block, choice, side, group, groups), words, n)

    found = met.groupBy("bucket").applyInArrow(compare, "word string, n_near long, form_n long, form string")
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                      F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best"))
            .select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of each word with a form (word, form): the last word that forms lead to. Each round doubles
    the steps taken; a form's count at least doubles, so a handful of rounds do."""
    led = staged(forms.select("word", F.col("form").alias("root")), "spelling-roots-0")
    step = 0
    while True:
        on = led.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step += 1
        moved = staged(led.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                           F.col("further").isNotNull().alias("moved")),
                       f"spelling-roots-{step}")
        led = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return led


def variants(documents: DataFrame, dropped: int = DROPPED, least_length: int = LEAST_LENGTH,
             least_count: int = LEAST_COUNT, **blocks) -> DataFrame:
    """word, form, root, n, n_near and form_n of each word of the vocabulary of ``documents`` (doc_id, text)."""
    counted = count_words(documents, dropped, least_length)
    vocabulary = staged(counted.where(F.col("n") >= least_count), "spelling-vocabulary")
    near = near_words(vocabulary, **blocks)
    has_form = F.col("best_n") >= FORM_RATIO * F.col("n")
    found = staged(vocabulary.join(near.withColumnsRenamed({"form": "best", "form_n": "best_n"}), "word", "left").select(
        "word", F.when(has_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("best_n")).alias("form_n")), "spelling-forms")
    led = roots(found.where("form is not null"))
    return found.join(led, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near",
                                                  "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


#: The same in DuckDB: crc32 by its table, near words by joins of their one-point deletions.
ORACLE = f"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[a-zÀ-ÿ]+')) AS run FROM documents)
  GROUP BY doc_id, run),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_transform(range(octet_length(b)), lambda i:
           CAST('0x' || substr(hex(b), 2 * i + 1, 2) AS BIGINT)),
         lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295)) AS h
  FROM (SELECT run, n, encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run) AS b FROM runs WHERE length(run) >= {LEAST_LENGTH}),
       crc_table),
vocabulary AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % {DROPPED} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                   ELSE run END AS word FROM hashed)
  WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
cut AS (
  SELECT word, place, substr(word, 1, place - 1) || substr(word, place + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS place FROM vocabulary)),
near AS (
  SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.rest = b.rest AND a.place = b.place AND a.word <> b.word
  UNION SELECT cut.word, v.word FROM cut JOIN vocabulary v ON v.word = cut.rest
  UNION SELECT v.word, cut.word FROM cut JOIN vocabulary v ON v.word = cut.rest),
best AS (
  SELECT near.word, count(*) AS n_near, min(struct_pack(less := -v.n, form := v.word)) AS best
  FROM near JOIN vocabulary v ON v.word = near.other GROUP BY near.word),
forms AS (
  SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near,
         CASE WHEN -b.best.less >= {FORM_RATIO} * v.n THEN b.best.form END AS form,
         CASE WHEN -b.best.less >= {FORM_RATIO} * v.n THEN -b.best.less END AS form_n
  FROM vocabulary v LEFT JOIN best b ON b.word = v.word),
led AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT led.word, forms.form FROM led JOIN forms ON forms.word = led.root WHERE forms.form IS NOT NULL)
SELECT f.word, f.form, l.root, f.n, f.n_near, f.form_n
FROM forms f JOIN led l ON l.word = f.word JOIN forms last ON last.word = l.root AND last.form IS NULL
"""
