"""Ledger-shaped views over the driver's Parquet tables (FIXTURES.md §2).

They give the reports realistic input whose size grows with the scale
factor: one job per order, one task per line item, one manifest row per
part, one progress sample per event.  Every column is derived with built-in
functions; the views are lazy and Catalyst prunes what a report does not use.
Timestamps stay TIMESTAMP_NTZ so nothing depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.functions.states import now_literal
from sluice.session import FIXTURE_NOW, table_path


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _secs(n) -> F.Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), n.cast("decimal(18,6)"))


def _s(c) -> F.Column:
    return c.cast("string")


def jobs_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    return o.select(
        F.lpad(_s(F.col("o_orderkey")), 8, "0").alias("id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("created"),
        F.concat(
            F.lit('{"connection":{"host":"h","port":3306},"target":{"database":"db","table":"t'),
            _s(F.col("o_custkey") % 7), F.lit('"}}'),
        ).alias("spec"),
    )


def tasks_view(spark: SparkSession, sf_dir: str, now: str = FIXTURE_NOW) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    nowc = now_literal(now)
    k5 = F.col("l_orderkey") % 5
    rf = F.col("l_returnflag")
    qty = F.col("l_quantity").cast("int")
    price = F.floor(F.col("l_extendedprice")).cast("bigint")
    result = (
        F.when(k5 == 0, F.lit("success"))
        .when(k5 == 1, F.when(rf == "R", F.lit("cancelled")).when(rf == "A", F.lit("error"))
              .otherwise(F.lit("success")))
        .when(k5 == 2, F.lit(None).cast("string"))
        .when(rf == "A", F.lit("success"))
        .when(rf == "R", F.lit("error"))
    )
    q1 = li.select(
        F.concat_ws("-", F.lpad(_s(F.col("l_orderkey")), 8, "0"), _s(F.col("l_linenumber")),
                    _s(F.col("l_partkey")), _s(F.col("l_suppkey")), _s(price)).alias("id"),
        F.lpad(_s(F.col("l_orderkey")), 8, "0").alias("job_id"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("created"),
        result.alias("result"),
        price.alias("bytes_total"),
        F.concat(F.lit("part/"), _s(F.col("l_partkey")), F.lit(".csv")).alias("file_key"),
        F.concat(F.lit("e"), _s((F.col("l_partkey") + F.when(F.col("l_partkey") % 3 == 0, 1).otherwise(0)) % 50)).alias("md5"),
        F.concat(F.lit('{"scheme":"file","key_name":"part/'), _s(F.col("l_partkey")),
                 F.lit('.csv","row_count":'), _s(qty),
                 F.when(rf == "R", F.lit(',"error":"bad row"')).otherwise(F.lit("")), F.lit("}")).alias("data"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_linestatus", "l_quantity", "l_extendedprice", "l_discount",
    )
    leased = F.col("result").isNotNull() | ((k5 != 2) & (F.col("l_linestatus") == "O"))
    q2 = q1.withColumn("execution_id", F.when(leased, F.lit("x")))
    has_lease = F.col("execution_id").isNotNull()
    q3 = q2.withColumns({
        "last_contact": F.when(has_lease, nowc - _secs(qty * 5)),
        "started": F.when(has_lease, nowc - _secs(qty * 5 + F.col("l_linenumber") * 60)),
    })

    def iso(c):
        return F.replace(_s(F.col(c)), F.lit(" "), F.lit("T"))

    return q3.select(
        "id", "created", "data", "result", "execution_id",
        F.when(F.col("started").isNotNull(),
               F.concat(F.lit('[{"name":"download","start":"'), iso("started"),
                        F.lit('","stop":"'), iso("last_contact"), F.lit('"}]'))).alias("steps"),
        "job_id", "file_key", "bytes_total",
        F.when(has_lease, F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("bigint")).alias("bytes_downloaded"),
        F.when(has_lease, F.col("l_partkey")).alias("download_rate"),
        "md5", "started", "last_contact",
        F.lit(1).cast("bigint").alias("update_count"),
        F.when(F.col("result").isNotNull(), F.col("created") + F.expr("INTERVAL 1 DAY")).alias("finished"),
    )


def manifest_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    return p.select(
        F.lit("file").alias("scheme"),
        F.lit(None).cast("string").alias("bucket"),
        F.concat(F.lit("part/"), _s(F.col("p_partkey")), F.lit(".csv")).alias("name"),
        F.when(F.col("p_size") % 10 != 0, F.concat(F.lit("e"), _s(F.col("p_partkey") % 50))).alias("etag"),
        F.floor(F.col("p_retailprice")).cast("bigint").alias("size"),
    )


def samples_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative bytes per task in sample order; ``bytes_total`` is the
    task's final cumulative count (so the last sample is 'complete')."""
    ev = _read(spark, sf_dir, "events").select(
        F.col("user_id").alias("task_id"), F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp_ntz").alias("ts"), F.floor(F.col("value")).cast("bigint").alias("_inc"))
    # windows on the renamed key, so rate / stall windows over ``task_id``
    # reuse this partitioning and ordering (no second shuffle)
    by_task = Window.partitionBy("task_id")
    running = by_task.orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ev.select(
        "task_id", "seq", "ts",
        F.sum("_inc").over(running).cast("bigint").alias("bytes_downloaded"),
        F.sum("_inc").over(by_task).cast("bigint").alias("bytes_total"),
    )


# ---------------------------------------------------------------------------
# The same views as DuckDB SQL, for the oracle (FIXTURES.md §2).
# ---------------------------------------------------------------------------

ORACLE_NOW = "CAST('2005-01-01 00:00:00' AS TIMESTAMP)"

ORACLE_VIEWS = {
    "jobs": """
SELECT lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS id,
       CAST(o_orderdate AS TIMESTAMP) AS created,
       concat('{"connection":{"host":"h","port":3306},"target":{"database":"db","table":"t',
              CAST(o_custkey % 7 AS VARCHAR), '"}}') AS spec
FROM orders""",
    "tasks": """
SELECT id, created, data, result, execution_id,
       CASE WHEN started IS NOT NULL THEN
         concat('[{"name":"download","start":"', replace(CAST(started AS VARCHAR), ' ', 'T'),
                '","stop":"', replace(CAST(last_contact AS VARCHAR), ' ', 'T'), '"}]') END AS steps,
       job_id, file_key, bytes_total,
       CASE WHEN execution_id IS NOT NULL
            THEN CAST(floor(l_extendedprice * (1 - l_discount)) AS BIGINT) END AS bytes_downloaded,
       CASE WHEN execution_id IS NOT NULL THEN l_partkey END AS download_rate,
       md5, started, last_contact, CAST(1 AS BIGINT) AS update_count,
       CASE WHEN result IS NOT NULL THEN created + INTERVAL 1 DAY END AS finished
FROM (
  SELECT *,
    CASE WHEN execution_id IS NOT NULL THEN CAST('2005-01-01 00:00:00' AS TIMESTAMP)
         - (CAST(l_quantity AS INT) * 5) * INTERVAL 1 SECOND END AS last_contact,
    CASE WHEN execution_id IS NOT NULL THEN CAST('2005-01-01 00:00:00' AS TIMESTAMP)
         - (CAST(l_quantity AS INT) * 5 + l_linenumber * 60) * INTERVAL 1 SECOND END AS started
  FROM (
    SELECT *, CASE WHEN result IS NOT NULL OR (l_orderkey % 5 <> 2 AND l_linestatus = 'O')
                   THEN 'x' END AS execution_id
    FROM (
      SELECT concat(lpad(CAST(l_orderkey AS VARCHAR), 8, '0'), '-', CAST(l_linenumber AS VARCHAR), '-',
                    CAST(l_partkey AS VARCHAR), '-', CAST(l_suppkey AS VARCHAR), '-',
                    CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR)) AS id,
             lpad(CAST(l_orderkey AS VARCHAR), 8, '0') AS job_id,
             CAST(l_shipdate AS TIMESTAMP) AS created,
             CASE WHEN l_orderkey % 5 = 0 THEN 'success'
                  WHEN l_orderkey % 5 = 1 THEN CASE l_returnflag WHEN 'R' THEN 'cancelled'
                                               WHEN 'A' THEN 'error' ELSE 'success' END
                  WHEN l_orderkey % 5 = 2 THEN NULL
                  WHEN l_returnflag = 'A' THEN 'success'
                  WHEN l_returnflag = 'R' THEN 'error' END AS result,
             CAST(floor(l_extendedprice) AS BIGINT) AS bytes_total,
             concat('part/', CAST(l_partkey AS VARCHAR), '.csv') AS file_key,
             concat('e', CAST((l_partkey + CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE 0 END) % 50 AS VARCHAR)) AS md5,
             concat('{"scheme":"file","key_name":"part/', CAST(l_partkey AS VARCHAR),
                    '.csv","row_count":', CAST(CAST(l_quantity AS INT) AS VARCHAR),
                    CASE WHEN l_returnflag = 'R' THEN ',"error":"bad row"' ELSE '' END, '}') AS data,
             l_orderkey, l_linenumber, l_partkey, l_linestatus, l_quantity, l_extendedprice, l_discount
      FROM lineitem) q1) q2) q3""",
    "manifest": """
SELECT 'file' AS scheme, CAST(NULL AS VARCHAR) AS bucket,
       concat('part/', CAST(p_partkey AS VARCHAR), '.csv') AS name,
       CASE WHEN p_size % 10 <> 0 THEN concat('e', CAST(p_partkey % 50 AS VARCHAR)) END AS etag,
       CAST(floor(p_retailprice) AS BIGINT) AS size
FROM part""",
    "samples": """
SELECT user_id AS task_id, event_id AS seq, ts,
       CAST(sum(CAST(floor(value) AS BIGINT))
            OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS bytes_downloaded,
       CAST(sum(CAST(floor(value) AS BIGINT)) OVER (PARTITION BY user_id) AS BIGINT) AS bytes_total
FROM events""",
}


def oracle_with(*names: str) -> str:
    """``WITH`` prefix defining the named ledger views for an oracle query."""
    parts = [f"{n} AS ({ORACLE_VIEWS[n]}\n)" for n in names]
    return "WITH " + ",\n".join(parts) + "\n"
