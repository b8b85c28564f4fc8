"""Reading the tables and keeping intermediate results where every executor sees them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import scratch_dir, track_staged

#: Bits of a membership filter (8 MB), whatever the number of keys.
FILTER_BITS = 1 << 26
#: Bytes of rows in an Arrow batch. Spark's own bound is 10,000 rows, so batches of long texts or sets were whole
#: partitions: a task holds a batch several times, in the JVM's direct memory and in Python, and both keep what they
#: took once.
BATCH_BYTES = 4 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read again: lineage is cut, and a lost executor
    costs no recomputation of what came before. Inside a ``staging_scope`` it goes when the block ends."""
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{name}")
    df.write.parquet(path)
    track_staged(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that no column of ``df`` has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def map_batches(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` in batches of about ``BATCH_BYTES``, unless the session sets a bound of its own. The
    session's setting is made here and stays, as Spark reads it when the rows are asked for."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH_CONF, None) is None:
        conf.set(_BATCH_CONF, str(BATCH_BYTES))
    return df.mapInArrow(function, schema)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def split_by(df: DataFrame, column: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``df`` as (rows whose ``column`` may be among the one column of ``keys``, rows where it is not).

    The keys are a bitmap of fixed size, so its broadcast (at most 2,048 rows of 4 KB) does not grow with them;
    more keys only let more rows pass to the join that must follow."""
    kind = df.schema[column].dataType
    bucket, bits, held = fresh(df, "bucket", "bits", "held")
    value = F.pmod(F.xxhash64(F.col(keys.columns[0]).cast(kind)), F.lit(FILTER_BITS)) + 1
    parts = (keys.select(value.alias("v")).groupBy(F.bitmap_bucket_number("v").alias(bucket))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias(bits)))
    own = F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)) + 1
    at = F.bitmap_bit_position(own)
    byte = F.conv(F.hex(F.substring(bits, F.call_function("div", at, F.lit(8).cast("long")).cast("int") + 1, F.lit(1))),
                  16, 10).cast("int")
    marked = (df.withColumn(bucket, F.bitmap_bucket_number(own)).join(F.broadcast(parts), bucket, "left")
              .withColumn(held, F.coalesce(F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(1) == 1,
                                           F.lit(False))))
    return tuple(marked.where(F.col(held) == side).select(df.columns) for side in (True, False))
