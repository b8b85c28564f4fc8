"""Line deduplication by pairwise alignment.

A run is a stretch of lines that follow each other and reach ``MIN_WORDS`` words, without a line that it could
spare at its end (or at its start). A block that two documents share holds such runs, and they cover it; so only
documents that share a run are compared. A run that at most ``RARE`` documents hold pairs each of them with all
earlier ones. One that more hold pairs each with the first of them (and its n-th occurrence in a document with
the first that has n); where that leaves lines of the run in a document, this document is paired with the next
``RARE`` holders, and where lines are left still, with all earlier ones. Pairs that are left out could delete
nothing more: the result is that of all pairs. The first two steps pair each document with a fixed number of others.
In the last one documents are reduced to the lines that another of them holds, with one mark for each gap; those of
equal reduced lists are a class, and each pair of classes is aligned once, whatever the number of their documents.
So the work grows with the documents, and with the square only of the different reduced lists that share a run which
the first ``RARE`` + 1 holders do not align.

Each pair is aligned by patience diff: lines that occur once in both, in their longest common order, are anchors,
equal neighbours extend them, and the stretches between are aligned in the same way. Aligned blocks (lines that
follow each other in both) of ``MIN_WORDS`` words or more are deleted from the later document, the one with the
greater doc_id.

Lines are compared without regard to A-Z case; empty lines are not compared and stay. All pairs see the
original texts, so the result does not depend on any order. Only line hashes travel; texts are shuffled once,
to meet the deletions.

Defined results: null and empty texts have no lines and come back as they are. The document of an id with
several rows is the one with the least text hash; its repetitions lose the same lines, other rows with that id
none. Rows without an id lose nothing. Other columns are not read, and pass through ``deduplicated``.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sluice.llm import tokens as tk
from sluice.llm.tables import fresh, staged, table

RARE = 8
MIN_WORDS = 10

_IS_LINE = np.ones(256, dtype=bool)
_IS_LINE[0x0A] = False


def line_hashes(documents: DataFrame) -> DataFrame:
    """doc_id, text_key and, for each line that is not empty, its hash and words."""
    def run(batches):
        for batch in batches:
            hashes, counts = [], []
            for _, _, raw, offs in tk.text_slices(batch.column("text")):
                lines = tk.words_of(raw, offs, _IS_LINE)
                words = tk.words_of(raw, offs, tk.IS_SPACED)
                held = np.searchsorted(words.start, lines.end) - np.searchsorted(words.start, lines.start)
                for first, count in zip(lines.first, lines.count, strict=True):
                    hashes.append(lines.hash[first:first + count].view(np.int64))
                    counts.append(held[first:first + count].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(hashes, pa.list_(pa.int64())),
                 pa.array(counts, pa.list_(pa.int32()))], names=["doc_id", "text_key", "lines", "words"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(
        run, f"doc_id {kind}, text_key long, lines array<long>, words array<int>")


def align(early: list[int], late: list[int]) -> list[tuple[int, int]]:
    """Pairs of places of equal lines, ascending in both: patience diff."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(early), 0, len(late))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and early[a] == late[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and early[b - 1] == late[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        once: dict[int, int] = {}
        for i in range(a, b):
            once[early[i]] = -1 if early[i] in once else i
        seen: dict[int, int] = {}
        for j in range(c, d):
            if once.get(late[j], -1) >= 0:
                seen[late[j]] = -1 if late[j] in seen else j
        both = sorted((j, once[line]) for line, j in seen.items() if j >= 0)
        tails: list[int] = []
        piles: list[tuple[int, int, int]] = []  # place in late, place in early, pile to the left's top
        tops: list[int] = []
        for j, i in both:
            at = bisect.bisect_left(tails, i)
            piles.append((j, i, tops[at - 1] if at else -1))
            tails[at:at + 1] = [i]
            tops[at:at + 1] = [len(piles) - 1]
        chain, k = [], tops[-1] if tops else -1
        while k >= 0:
            chain.append((piles[k][1], piles[k][0]))
            k = piles[k][2]
        chain.reverse()
        out += chain
        if chain:
            edges = [(a - 1, c - 1), *chain, (b, d)]
            todo += [(i + 1, m, j + 1, n) for (i, j), (m, n) in zip(edges[:-1], edges[1:], strict=True)]
    return sorted(out)


def common_blocks(early: list[int], late: list[int], words: list[int], min_words: int = MIN_WORDS) -> list[int]:
    """Places of the lines of ``late`` to delete; ``words``: of each of its lines."""
    gone: list[int] = []
    block: list[int] = []
    last = (-2, -2)
    for i, j in [*align(early, late), (-9, -9)]:
        if (i, j) != (last[0] + 1, last[1] + 1):
            if sum(words[k] for k in block) >= min_words:
                gone += block
            block = []
        block.append(j)
        last = (i, j)
    return gone


def runs_of(held: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The runs of each doc: hash, which of its occurrences in the doc, place of the first line, and lines."""
    def run(batches):
        for batch in batches:
            lists = batch.column("lines")
            size = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            lines = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            words = np.concatenate([[0], np.cumsum(batch.column("words").flatten().to_numpy(zero_copy_only=False),
                                                   dtype=np.int64)])
            stop = np.cumsum(size)
            doc = np.repeat(np.arange(len(size)), size)
            at = np.arange(len(lines))
            ends = np.searchsorted(words, words[:-1] + min_words, side="left")
            starts = np.searchsorted(words, words[1:] - min_words, side="right") - 1
            down, up = ends <= stop[doc], starts >= (stop - size)[doc]
            spans = np.unique(np.concatenate([np.stack([at[down], ends[down]], 1), np.stack([starts[up], at[up] + 1], 1)]),
                              axis=0)
            first, end = spans[:, 0], spans[:, 1]
            hashed = tk.sequence_hashes(lines, first, end)
            of = doc[first]
            order = np.lexsort((first, hashed, of))
            first, end, hashed, of = first[order], end[order], hashed[order], of[order]
            fresh = np.ones(len(of), dtype=bool)
            fresh[1:] = (of[1:] != of[:-1]) | (hashed[1:] != hashed[:-1])
            begin = np.flatnonzero(fresh)
            nth = np.arange(len(of)) - np.repeat(begin, np.diff(np.append(begin, len(of)))) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(pa.array(of)), pa.array(hashed.view(np.int64)), pa.array(nth.astype(np.int32)),
                 pa.array((first - (stop - size)[of]).astype(np.int32)), pa.array((end - first).astype(np.int32))],
                names=["doc", "run", "nth", "at", "size"])

    kind = held.schema["doc"].dataType.simpleString()
    return held.select("doc", "lines", "words").mapInArrow(run, f"doc {kind}, run long, nth int, at int, size int")


def deletions(hashed: DataFrame, rare: int = RARE, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text_key and the places (among the lines that are not empty) that go."""
    held = (hashed.where("doc_id is not null and size(lines) > 0").groupBy("doc_id")
            .agg(F.min_by(F.struct("text_key", "lines", "words"), "text_key").alias("d")).select("doc_id", "d.*"))
    held = staged(held.select(F.col("doc_id").alias("doc"), "text_key", "lines", "words"), "documents")
    runs = runs_of(held, min_words)
    known = (runs.groupBy("run").agg(F.count_if(F.col("nth") == 1).alias("n"), F.min("doc").alias("first"))
             .where("n > 1"))
    shared = staged(runs.join(known, "run"), "shared")
    often = shared.where(F.col("n") > rare)
    again = often.where("nth > 1")
    again = again.join(again.groupBy("run", "nth").agg(F.min("doc").alias("nth_first")), ["run", "nth"])
    few = (shared.where((F.col("n") <= rare) & (F.col("nth") == 1))
           .groupBy("run").agg(F.array_sort(F.collect_list("doc")).alias("docs"))  # at most ``rare``
           .select("docs", F.posexplode("docs").alias("at", "late")).where("at > 0")
           .select(F.explode(F.slice("docs", 1, F.col("at"))).alias("early"), "late"))
    pairs = (often.select(F.col("first").alias("early"), F.col("doc").alias("late"))
             .unionByName(again.select(F.col("nth_first").alias("early"), F.col("doc").alias("late")))
             .where("early < late").unionByName(few).distinct())

    def compare(batches):
        for batch in batches:
            found = [common_blocks(early, late, words, min_words) for early, late, words in
                     zip(*(batch.column(c).to_pylist() for c in ("early_lines", "lines", "words")), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("late"), batch.column("text_key"),
                                              pa.array(found, pa.list_(pa.int32()))],
                                             names=["doc", "text_key", "gone"])

    kind = held.schema["doc"].dataType.simpleString()

    def places(pairs: DataFrame) -> DataFrame:
        rows = (pairs.join(held.select(F.col("doc").alias("early"), F.col("lines").alias("early_lines")), "early")
                .join(held.withColumnRenamed("doc", "late"), "late")
                .select("late", "text_key", "early_lines", "lines", "words"))
        return (rows.mapInArrow(compare, f"doc {kind}, text_key long, gone array<int>").where("size(gone) > 0")
                .select("doc", "text_key", F.explode("gone").alias("place")).distinct())

    def by_document(found: DataFrame) -> DataFrame:
        return found.groupBy("doc", "text_key").agg(F.collect_set("place").alias("gone"))

    def unfinished(spans: DataFrame, found: DataFrame) -> DataFrame:
        gone = by_document(found).select("doc", "gone")
        return spans.join(gone, "doc", "left").where(F.col("gone").isNull() | (F.size(F.array_except(
            F.sequence(F.col("at"), F.col("at") + F.col("size") - 1), F.col("gone"))) > 0)).drop("gone")

    def with_earlier(spans: DataFrame, holders: DataFrame) -> DataFrame:
        return (spans.select("run", F.col("doc").alias("late")).distinct()
                .join(holders.select("run", F.col("doc").alias("early")), "run").where("early < late")
                .select("early", "late").distinct())

    holders = often.where("nth = 1")
    place = F.row_number().over(Window.partitionBy("run").orderBy("doc"))
    nearest = holders.select("run", "doc", place.alias("k")).where(F.col("k") <= rare + 1).where("k > 1")
    found = staged(places(pairs), "found")
    left = staged(unfinished(often.where(F.col("first") < F.col("doc")).select("run", "doc", "at", "size"), found), "left")
    found = staged(found.unionByName(places(with_earlier(left, nearest))), "found-next")
    left = staged(unfinished(left, found).select("run", "doc").distinct(), "left-last")
    last = class_places(left, staged(holders.join(left.select("run").distinct(), "run").select("run", "doc"), "holders-last"),
                        held, min_words)
    return by_document(found.unionByName(last)).withColumnRenamed("doc", "doc_id")


#: A stretch of lines that no other document holds, in the earlier and the later document: equal to nothing.
_GAP, _LATE_GAP = "gap", "late gap"


def classes(docs: DataFrame, held: DataFrame) -> DataFrame:
    """doc, class, line, words and at (places) of the lines of ``docs`` (doc) that two of them hold. A stretch of other
    lines is one line, null. Documents of one class have equal lists of lines, so patience diff aligns them alike."""
    own = held.join(docs, "doc")
    shared = staged(own.select("doc", F.explode("lines").alias("line")).distinct().groupBy("line").count()
                    .where("count > 1").select("line"), "lines-shared")
    each = own.select("doc", F.posexplode(F.arrays_zip("lines", "words")).alias("at", "x")).select(
        "doc", "at", F.col("x.lines").alias("line"), F.col("x.words").alias("words"))
    marked = (each.join(shared.withColumn("is_shared", F.lit(True)), "line", "left")
              .groupBy("doc").agg(F.array_sort(F.collect_list(F.struct(
                  "at", F.when(F.col("is_shared"), F.col("line")).alias("line"), "words"))).alias("list")))  # a text's lines
    kind = held.schema["doc"].dataType.simpleString()

    def reduce(batches):
        for batch in batches:
            lines, words, at = [], [], []
            for rows in batch.column("list").to_pylist():
                keep = [r for k, r in enumerate(rows) if r["line"] is not None or not k or rows[k - 1]["line"] is not None]
                lines.append([r["line"] for r in keep])
                words.append([r["words"] if r["line"] is not None else 0 for r in keep])
                at.append([r["at"] for r in keep])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(lines, pa.list_(pa.int64())), pa.array(words, pa.list_(pa.int32())),
                 pa.array(at, pa.list_(pa.int32()))], names=["doc", "line", "words", "at"])

    reduced = marked.mapInArrow(reduce, f"doc {kind}, line array<long>, words array<int>, at array<int>")
    return reduced.withColumn("class", F.xxhash64(F.size("line"), F.transform("line", lambda x: F.coalesce(x, F.lit(0))),
                                                  F.transform("line", lambda x: x.isNull())))


def class_pairs(left: DataFrame, holders: DataFrame, of: DataFrame) -> DataFrame:
    """(early, late, from_doc): classes to align, and the first document of the early one."""
    named = of.select("doc", "class")
    first = holders.join(named, "doc").groupBy("run", "class").agg(F.min("doc").alias("from_doc"))
    # the first document of a class, whichever run it is met at
    first = first.join(named.groupBy("class").agg(F.min("doc").alias("class_first")), "class").select(
        "run", F.col("class").alias("early"), F.col("class_first").alias("from_doc"))
    late = left.join(named, "doc").groupBy("run", "class").agg(F.max("doc").alias("to_doc"))
    return (first.join(late.withColumnRenamed("class", "late"), "run").where("from_doc < to_doc")
            .select("early", "late", "from_doc").distinct())


def class_places(left: DataFrame, holders: DataFrame, held: DataFrame, min_words: int) -> DataFrame:
    """doc, text_key and places that go when the documents of ``left`` (run, doc) are aligned with all earlier
    holders of their runs: each pair of classes once, however many documents they have."""
    of = staged(classes(holders.select("doc").distinct(), held), "classes")
    model = of.groupBy("class").agg(F.min_by(F.struct("line", "words"), "doc").alias("m")).select("class", "m.*")
    model = staged(model, "class-lists")
    pairs = (class_pairs(left, holders, of)
             .join(model.select(F.col("class").alias("early"), F.col("line").alias("early_line")), "early")
             .join(model.withColumnRenamed("class", "late"), "late"))
    kind = held.schema["doc"].dataType.simpleString()

    def compare(batches):
        for batch in batches:
            gone = []
            for early, late, words in zip(*(batch.column(c).to_pylist() for c in ("early_line", "line", "words")), strict=True):
                gone.append(common_blocks([_GAP if x is None else x for x in early],
                                          [_LATE_GAP if x is None else x for x in late], words, min_words))
            yield pa.RecordBatch.from_arrays([batch.column("late"), batch.column("from_doc"), pa.array(gone, pa.list_(pa.int32()))],
                                             names=["class", "from_doc", "gone"])

    goes = (pairs.mapInArrow(compare, f"class long, from_doc {kind}, gone array<int>")
            .select("class", "from_doc", F.explode("gone").alias("k")).groupBy("class", "k").agg(F.min("from_doc").alias("from_doc"))
            .groupBy("class").agg(F.collect_list(F.struct("k", "from_doc")).alias("goes")))  # at most a text's lines
    late = of.join(left.select("doc").distinct(), "doc", "left_semi").join(goes, "class")
    return (late.join(held.select("doc", "text_key"), "doc")
            .select("doc", "text_key", "at", F.explode("goes").alias("g")).where(F.col("g.from_doc") < F.col("doc"))
            .select("doc", "text_key", F.element_at("at", F.col("g.k") + 1).alias("place")).distinct())


def deduplicated(documents: DataFrame, rare: int = RARE, min_words: int = MIN_WORDS) -> DataFrame:
    """``documents`` with text cut, and n_lines and n_deleted added (lines that are not empty)."""
    id_, key, gone_at = fresh(documents, "id", "key", "gone")
    gone = staged(deletions(line_hashes(documents), rare, min_words), "deletions").select(
        F.col("doc_id").alias(id_), F.col("text_key").alias(key), F.col("gone").alias(gone_at))
    rows = documents.join(gone, (F.col("doc_id") == F.col(id_)) & (F.xxhash64("text") == F.col(key)), "left")

    columns = [c for c in documents.columns if c not in ("n_lines", "n_deleted")]

    def cut(batches):
        for batch in batches:
            texts, n_lines, n_deleted = [], [], []
            for text, gone_ in zip(batch.column("text"), batch.column(gone_at).to_pylist(), strict=True):
                text = text.as_py()
                lines = (text or "").split("\n")
                n_lines.append(sum(1 for x in lines if x))
                n_deleted.append(len(gone_ or ()))
                if gone_:
                    gone_, place, left = set(gone_), -1, []
                    for x in lines:
                        place += bool(x)
                        if not x or place not in gone_:
                            left.append(x)
                    text = "\n".join(left)
                texts.append(text)
            kept = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(n_lines, pa.int64()), pa.array(n_deleted, pa.int64())],
                                             names=[*columns, "n_lines", "n_deleted"])

    schema = StructType([*(documents.schema[c] for c in columns), StructField("n_lines", LongType()),
                         StructField("n_deleted", LongType())])
    return rows.select(*columns, gone_at).mapInArrow(cut, schema)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return kept.select("doc_id", "n_lines", "n_deleted", F.length(text).cast("long").alias("kept_chars"),
                       F.sha2(text, 256).alias("kept_sha256"))
