"""Fingerprints by invertible Bloom lookup sketches of paragraphs.

A text is the set of its paragraphs' (lines') 64-bit digests. The sketch has three rows of ``WIDTH`` cells;
each digest is added to one cell of each row, as a count, the xor of digests and the xor of their checks. Two
sketches subtract cell by cell, which leaves the paragraphs that only one of the versions has; peeling takes
the cells that hold one digest, adds it to its side's list and subtracts it from its other cells, until all
are empty. If that fails, the pair is tried again with a larger sketch: digests are dealt to more and more
blocks of cells, with new hash functions each time, until every block is recovered. The likeness is the
Jaccard similarity that follows from the recovered digests: shared paragraphs over all paragraphs.

Only SQL functions are used. Texts are shuffled once, to meet their place in the order of ids; what the
document before needs of a text travels on as that much text and the digests.

Defined results: a null text is empty; the empty text has one empty paragraph. Rows equal in id and text
count as one in the order and get the same result each; rows with one id and several texts are ordered by
text hash; rows without an id come last. A single document is followed by itself. Paragraphs that repeat
count once. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.tables import partitions, staged, table

#: Cells of each of the three rows, a power of two.
WIDTH = 8
ROWS = ("a", "b", "c")
#: Rounds of peeling; what takes more counts as a failure and is tried larger.
ROUNDS = 10
#: Digests for each block of a larger sketch, at most, on its first try.
LOAD = 5


def _held(df: DataFrame) -> DataFrame:
    """``df`` with its columns computed here, once: the optimizer does not inline them into lambdas below."""
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("_row")).select("_row.*")


def digests(text: Column) -> Column:
    return F.array_distinct(F.transform(F.split(text, "\n"), lambda x: F.xxhash64(x)))


def members(keys: Column, salt: Column) -> Column:
    """Digests with their check and their cell in each row."""
    return F.transform(keys, lambda p: F.struct(p.alias("k"), F.xxhash64(p, F.lit("check")).alias("x"),
                                                *_places(p, salt)))


def _places(p: Column, salt: Column) -> list[Column]:
    """The cell of a digest in each row: three parts of one hash."""
    hashed = F.xxhash64(p, salt)
    bits = WIDTH.bit_length() - 1
    return [F.shiftright(hashed, 20 * j).bitwiseAND((1 << bits) - 1).cast("int").alias(name)
            for j, name in enumerate(ROWS)]


def cells(held: Column) -> Column:
    """The sketch of ``members``."""
    def row(name):
        def cell(i):
            def add(acc, m):
                return F.when(m[name] == i, _cell(
                    acc["n"] + 1, acc["k"].bitwiseXOR(m["k"]), acc["x"].bitwiseXOR(m["x"]))).otherwise(acc)
            return F.aggregate(held, _cell(F.lit(0), F.lit(0).cast("long"), F.lit(0).cast("long")), add)
        return F.transform(F.sequence(F.lit(0), F.lit(WIDTH - 1)), cell)

    return F.concat(*map(row, ROWS))


def _cell(n: Column, k: Column, x: Column) -> Column:
    return F.struct(n.cast("int").alias("n"), k.alias("k"), x.alias("x"))


def subtracted(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: _cell(
        a["n"] - b["n"], a["k"].bitwiseXOR(b["k"]), a["x"].bitwiseXOR(b["x"])))


def peeled(difference: Column, salt: Column) -> Column:
    """struct(ok, only_left, only_right): whether all was recovered, and the digests of either side."""
    def step(acc, _):
        def strip(j, name):
            def cell_of(cell, i):
                def take(c, p):
                    return F.when(p[name] == i, _cell(
                        c["n"] - p["n"], c["k"].bitwiseXOR(p["k"]), c["x"].bitwiseXOR(p["x"]))).otherwise(c)
                return F.aggregate(acc["pure"], cell, take)
            return F.transform(F.slice(acc["cells"], j * WIDTH + 1, WIDTH), cell_of)

        def found(sign):
            return F.transform(F.filter(acc["pure"], lambda p: p["n"] == sign), lambda p: p["k"])

        return F.struct(F.when(F.size(acc["pure"]) == 0, acc["cells"]).otherwise(
            F.concat(*(strip(j, name) for j, name in enumerate(ROWS)))).alias("cells"),
            F.concat(acc["left"], found(1)).alias("left"), F.concat(acc["right"], found(-1)).alias("right"),
            acc["pure"].alias("pure"))

    def pure(acc):
        single = F.filter(acc["cells"], lambda c: (F.abs(c["n"]) == 1)
                          & (F.xxhash64(c["k"], F.lit("check")) == c["x"]))
        return F.struct(acc["cells"].alias("cells"), acc["left"].alias("left"), acc["right"].alias("right"),
                        F.transform(F.array_distinct(single), lambda c: F.struct(
                            c["n"].alias("n"), c["k"].alias("k"), c["x"].alias("x"), *_places(c["k"], salt))).alias("pure"))

    none = F.array().cast("array<bigint>")
    start = pure({"cells": difference, "left": none, "right": none})
    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, lambda acc, r: pure(step(acc, r)), lambda acc: F.struct(
        F.forall(acc["cells"], lambda c: (c["n"] == 0) & (c["k"] == 0) & (c["x"] == 0)).alias("ok"),
        acc["left"].alias("only_left"), acc["right"].alias("only_right")))
    return done


def recovered(pairs: DataFrame) -> DataFrame:
    """id, only_left and only_right (counts) of ``pairs`` (id, left, right: distinct digests), by sketches
    that grow until every pair is recovered."""
    first = _held(pairs.select("id", "left", "right", members(F.col("left"), F.lit(0)).alias("l"),
                               members(F.col("right"), F.lit(0)).alias("r")))
    first = _held(first.select("id", "left", "right", subtracted(cells(F.col("l")), cells(F.col("r"))).alias("d")))
    tried = staged(_held(first.select("id", "left", "right", peeled(F.col("d"), F.lit(0)).alias("p"))).select(
        "id", F.col("p.ok").alias("ok"), F.size("p.only_left").alias("only_left"),
        F.size("p.only_right").alias("only_right"),
        *(F.when(~F.col("p.ok"), F.col(c)).alias(c) for c in ("left", "right"))), "sketches")
    done, left = tried.where("ok").select("id", "only_left", "only_right"), tried.where("not ok")
    attempt = 1
    while not left.isEmpty():
        size = F.size("left") + F.size("right")
        blocks = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(size / LOAD, F.lit(1.0)))) + (attempt - 1)).cast("long")

        def dealt(side: str) -> Column:
            return F.transform(F.col(side), lambda p: F.struct(
                F.pmod(F.xxhash64(p, F.lit("block"), F.lit(attempt)), blocks).alias("block"), p.alias("p"),
                F.lit(side == "left").alias("is_left")))

        rows = left.select("id", F.explode(F.concat(dealt("left"), dealt("right"))).alias("e")).select("id", "e.*")
        # a block's digests are few whatever the text's length, so groups are bounded
        grouped = rows.groupBy("id", "block").agg(
            F.collect_list(F.when(F.col("is_left"), F.col("p"))).alias("lk"),
            F.collect_list(F.when(~F.col("is_left"), F.col("p"))).alias("rk"))
        salt = F.lit(attempt)
        held = _held(grouped.select("id", members(F.col("lk"), salt).alias("l"), members(F.col("rk"), salt).alias("r")))
        diff = _held(held.select("id", subtracted(cells(F.col("l")), cells(F.col("r"))).alias("d")))
        peels = _held(diff.select("id", peeled(F.col("d"), salt).alias("p"))).groupBy("id").agg(
            F.min("p.ok").alias("ok"), F.sum(F.size("p.only_left")).cast("int").alias("only_left"),
            F.sum(F.size("p.only_right")).cast("int").alias("only_right"))
        peels = staged(peels, "blocks")
        done = done.unionByName(peels.where("ok").select("id", "only_left", "only_right"))
        left = staged(left.select("id", "left", "right").join(peels.where("not ok").select("id"), "id"), "again")
        attempt += 1
    return done


def followers(documents: DataFrame) -> DataFrame:
    """before_id, before_key, before_chars of every distinct (doc_id, text_key): the document that precedes it
    in the order of descending ids (the last precedes the first)."""
    spark = documents.sparkSession
    keys = [F.col("doc_id").desc_nulls_last(), F.col("text_key").asc()]
    rows = documents.select("doc_id", "text_key", "n_chars").distinct()
    rows = (rows.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys)
            .withColumn("at", F.monotonically_increasing_id()))
    rows = staged(rows, "order").withColumn("part", F.shiftright("at", 33))
    own = F.struct("doc_id", "text_key", "n_chars")
    over = Window.partitionBy("part").orderBy("at")
    # the last row of each partition, for the first row of the next: one row for each partition
    ends = rows.groupBy("part").agg(F.max_by(own, "at").alias("end"))
    ring = Window.orderBy("part")
    before = ends.select("part", F.coalesce(F.lag("end").over(ring), F.last("end").over(
        ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("end"))
    return (rows.withColumn("lag", F.lag(own).over(over)).join(F.broadcast(before), "part")
            .withColumn("b", F.coalesce("lag", "end"))
            .select("doc_id", "text_key", F.col("b.doc_id").alias("before_id"), F.col("b.text_key").alias("before_key"),
                    F.col("b.n_chars").alias("before_chars")))



def edits(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256 and the digests own, edited and next of each row."""
    text = F.coalesce("text", F.lit(""))
    docs = documents.select("doc_id", text.alias("text"), F.xxhash64(text).alias("text_key"))
    chars = F.length("text").cast("long")
    order = followers(docs.withColumn("n_chars", chars))

    def keyed(df: DataFrame, row: str, text_key: str, prefix: str) -> DataFrame:
        """With the three columns that tell rows apart, nulls among the ids included."""
        return df.withColumns({f"{prefix}0": F.coalesce(row, F.lit(0)), f"{prefix}1": F.col(row).isNull(),
                               f"{prefix}2": F.col(text_key)})

    def same(left: str, right: str) -> Column:
        return ((F.col(f"{left}0") == F.col(f"{right}0")) & (F.col(f"{left}1") == F.col(f"{right}1"))
                & (F.col(f"{left}2") == F.col(f"{right}2")))

    docs = keyed(docs, "doc_id", "text_key", "d").select("text", "d0", "d1", "d2")
    order = keyed(keyed(order, "doc_id", "text_key", "o"), "before_id", "before_key", "b").select(
        "o0", "o1", "o2", "b0", "b1", "b2", "before_chars")
    # the same columns by the same keys on both ways: one exchange of the texts serves both joins, and the
    # heads are dealt once for the distinct and the join
    give = (docs.join(order, same("d", "o"))
            .select("b0", "b1", "b2", F.substring("text", F.lit(1), F.floor(F.col("before_chars") / 2).cast("int")).alias("head"),
                    digests(F.col("text")).alias("next")).dropDuplicates(["b0", "b1", "b2"]))
    kind = documents.schema["doc_id"].dataType
    rows = docs.join(give, same("d", "b")).withColumn("doc_id", F.when(~F.col("d1"), F.col("d0")).cast(kind))
    kept = F.col("n_chars") - F.floor(F.col("n_chars") / 2)
    rows = rows.withColumn("n_chars", chars).select("doc_id", "n_chars", digests(F.col("text")).alias("own"), "next",
                       F.concat(F.substring("text", F.lit(1), kept.cast("int")), "head").alias("edited_text"))
    return rows.select("doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "own", "next",
                       digests(F.col("edited_text")).alias("edited"))


def serialised(sketch: Column) -> Column:
    """Count, digests' xor and the checks' xor of each cell, as hexadecimal text."""
    return F.array_join(F.transform(sketch, lambda c: F.concat(
        F.lpad(F.hex(c["n"].cast("long")), 4, "0"), F.lpad(F.hex(c["k"]), 16, "0"),
        F.lpad(F.hex(c["x"].bitwiseAND((1 << 32) - 1)), 8, "0"))), "")


def fingerprints(documents: DataFrame) -> DataFrame:
    rows = staged(edits(documents).withColumn("id", F.monotonically_increasing_id()), "edits")
    pairs = rows.select(F.explode(F.array(
        F.struct((F.col("id") * 2).alias("id"), F.col("own").alias("left"), F.col("edited").alias("right")),
        F.struct((F.col("id") * 2 + 1).alias("id"), F.col("own").alias("left"), F.col("next").alias("right")))
        ).alias("p")).select("p.*")
    only = recovered(pairs)

    def near(kind: int, name: str) -> DataFrame:
        return only.where(F.pmod("id", F.lit(2)) == kind).select(
            F.floor(F.col("id") / 2).alias("id"), F.struct("only_left", "only_right").alias(name))

    both = rows.join(near(0, "e"), "id").join(near(1, "x"), "id")

    def likeness(c: str) -> Column:
        size = F.size("own")
        return ((size - F.col(f"{c}.only_left")) / (size + F.col(f"{c}.only_right"))).cast("double")

    held = _held(both.select("doc_id", "n_chars", "edited_sha256", likeness("e").alias("near_edited"),
                             likeness("x").alias("near_next"), members(F.col("own"), F.lit(0)).alias("m"),
                             members(F.col("edited"), F.lit(0)).alias("em")))
    return held.select("doc_id", "n_chars", "edited_sha256", serialised(cells(F.col("m"))).alias("fingerprint"),
                       serialised(cells(F.col("em"))).alias("edited_fingerprint"), "near_edited", "near_next")


def op5_iblt_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
