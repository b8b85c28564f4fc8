"""Shards for multidimensional file pruning: rows along a Hilbert curve, cut into runs.

Each dimension is quantised to ``bits`` bits: numbers by the quantiles of all rows, other types by hash (so
that equal values keep together and no dictionary grows with the data). The cells' Hilbert indexes come from
a table of the curve's orientations, built here by rule. Rows are range-partitioned and sorted by (index,
crc32 of the text, id), so a cell that holds a third of the rows still spreads over many tasks, and equal
texts lie together. Ranks are the rows' places plus the row counts of the partitions before (one number for
each partition); run s of n takes the ranks from ceil(s * rows / n) on: the law is ``rows``.

Defined results: nulls of any dimension are cell 0; a null text has size 16 and checksum 0; rows that are
equal in everything share their places in any order; an empty table has no rows; columns besides the
dimensions, text and id pass through untouched, but for those named hilbert, shard or slot, which the result's
own columns replace.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from sluice.llm.tables import fresh, partitions, staged, table

SHARDS = 40
BITS = 5
#: Columns of the result; those of the input with these names are replaced.
OWN = ("hilbert", "shard", "slot")


def curve_steps(dims: int) -> tuple[list[int], list[int]]:
    """For state * 2**dims + cell: the cell's place along the curve, and the state within that cell.

    A state is the corner where the curve enters and the axis along which it leaves; cells follow the
    reflected Gray code, turned to the state."""
    side, full = 1 << dims, (1 << dims) - 1

    def rotate(x: int, by: int) -> int:
        by %= dims
        return (x << by | x >> (dims - by)) & full

    def gray(i: int) -> int:
        return i ^ i >> 1

    def axis(i: int) -> int:
        return ((i ^ (i + 1)).bit_length() - 1) % dims  # trailing ones

    place = {gray(i): i for i in range(side)}
    found, steps = {(0, 0): 0}, []
    for corner, along in (queue := [(0, 0)]):
        for cell in range(side):
            i = place[rotate(cell ^ corner, dims - along - 1)]
            entry = 0 if i == 0 else gray(2 * ((i - 1) // 2))
            turn = 0 if i == 0 else axis(i - 1) if i % 2 == 0 else axis(i)
            state = (corner ^ rotate(entry, along + 1), (along + turn + 1) % dims)
            if state not in found:
                found[state] = len(found)
                queue.append(state)
            steps.append((i, found[state]))
    return [i for i, _ in steps], [s for _, s in steps]


def hilbert_index(coordinates: list[Column], bits: int = BITS) -> Column:
    """Place along the curve of a cell given by integer coordinates below 2**bits."""
    dims = len(coordinates)
    places, states = (F.array(*map(F.lit, x)) for x in curve_steps(dims))

    def step(acc: Column, level: Column) -> Column:
        cell = F.lit(0)
        for j, c in enumerate(coordinates):
            cell = cell + F.call_function("shiftright", c, level).bitwiseAND(1) * (1 << j)
        at = acc["state"] * (1 << dims) + cell
        return F.struct((acc["index"] * (1 << dims) + F.get(places, at)).cast("long").alias("index"),
                        F.get(states, at).cast("int").alias("state"))

    levels = F.array(*map(F.lit, range(bits - 1, -1, -1)))
    return F.aggregate(levels, F.struct(F.lit(0).cast("long").alias("index"), F.lit(0).cast("int").alias("state")),
                       step, lambda acc: acc["index"])


def coordinates(df: DataFrame, dimensions: list[str], bits: int = BITS) -> list[Column]:
    numeric = [c for c in dimensions if isinstance(df.schema[c].dataType, NumericType)]
    cuts = {}
    if numeric:
        shares = [i / (1 << bits) for i in range(1, 1 << bits)]
        row = df.agg(*(F.percentile_approx(F.col(c).cast("double"), shares, 10_000).alias(f"q{i}")
                       for i, c in enumerate(numeric))).first()
        cuts = {c: sorted(set(row[i] or [])) for i, c in enumerate(numeric)}
    out = []
    for c in dimensions:
        if c in cuts:
            above = [F.when(F.col(c).cast("double") > cut, 1).otherwise(0) for cut in cuts[c]]
            out.append(sum(above, F.lit(0)).cast("int"))
        else:
            out.append(F.when(F.col(c).isNull(), 0).otherwise(F.pmod(F.xxhash64(c), F.lit(1 << bits))).cast("int"))
    return out


def shard(df: DataFrame, dimensions: list[str], order: list[Column], shards: int = SHARDS,
          bits: int = BITS) -> DataFrame:
    """``df`` with hilbert, shard and slot: equal runs of rows by (hilbert, *order)."""
    spark = df.sparkSession
    row, part, rows, before, rank, *keys = fresh(df, "row", "part", "rows", "before", "rank",
                                                 *(f"order{i}" for i in range(len(order))))
    # one projection: the dimensions and the order may name columns that the result replaces
    placed = df.select(*(c for c in df.columns if c.lower() not in OWN),
                       hilbert_index(coordinates(df, dimensions, bits), bits).alias("hilbert"),
                       *(c.alias(k) for c, k in zip(order, keys, strict=True)))
    placed = (placed.repartitionByRange(partitions(spark), "hilbert", *keys).sortWithinPartitions("hilbert", *keys)
              .drop(*keys).withColumn(row, F.monotonically_increasing_id()))
    placed = staged(placed, "runs")
    own = F.shiftright(row, 33)
    counts = placed.groupBy(own.alias(part)).agg(F.count("*").alias(rows))
    earlier = counts.select(part, (F.sum(rows).over(Window.orderBy(part)) - F.col(rows)).alias(before))
    total = F.lit(placed.count())
    # one row for each partition: a proven bound for the broadcast
    place = F.col(before) + F.col(row).bitwiseAND((1 << 33) - 1)
    ranked = placed.withColumn(part, own).join(F.broadcast(earlier), part).withColumn(rank, place)
    ranked = ranked.withColumn("shard", F.call_function("div", F.col(rank) * shards, total).cast("int"))
    first = F.call_function("div", F.col("shard").cast("long") * total + (shards - 1), F.lit(shards).cast("long"))
    return ranked.withColumn("slot", F.col(rank) - first).drop(part, row, before, rank)


def write_shards(sharded: DataFrame, path: str, rows_a_file: int = 1_000_000) -> None:
    """One directory for each shard, rows in curve order, in files of about ``rows_a_file`` consecutive rows, so that
    a file's value ranges are narrow and a shard, however large, is many tasks."""
    files = max(1, -(-sharded.count() // rows_a_file))
    (sharded.repartitionByRange(files, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard")
     .mode("errorifexists").parquet(path))


def op7_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"))
    placed = shard(documents, ["lang", "source", "size"], [F.col("text_crc32"), F.col("doc_id")])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "hilbert")
