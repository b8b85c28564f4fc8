"""Round-trip queries: a driver table is written as delimited text into the
shared scratch folder, loaded back with the operator under test, and the
loaded table is returned.  Oracle: the source table under the same
transformation.  Work grows with the table (whole tables, every row)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.load import load_files, read_target
from sluice.session import local_path, scratch_dir, table_path
from sluice.sources.delimited import (TextOptions, cut_file, name_part_files, replace_files, truncate_file,
                                      write_delimited)
from sluice.sources.listing import list_files
from sluice.spec import LoadSpec, SourceSpec, TargetSpec


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _spec(spark, df: DataFrame, opts: TextOptions, keys=(), method="error", schema: str | None = None,
          script: str | None = None) -> LoadSpec:
    return LoadSpec(SourceSpec(paths=()),
                    TargetSpec(path=scratch_dir(spark, "target"), schema=schema or df.schema.simpleString(),
                               key_columns=tuple(keys)),
                    opts, duplicate_key_method=method, script=script)


def _round_trip(spark, df: DataFrame, opts: TextOptions, key: str | None, files: int, **write_kw) -> DataFrame:
    d = scratch_dir(spark, "files")
    src = df.withColumn("_k", F.expr(key)) if key else df
    write_delimited(src, d, opts, columns=df.columns, file_key="_k" if key else None, files=files,
                    header_lines=opts.ignore_lines, **write_kw)
    spec = _spec(spark, df, opts)
    load_files(spark, spec, [d])
    return read_target(spark, spec)


def load_tsv(spark, sf_dir):
    part = _table(spark, sf_dir, "part")
    return _round_trip(spark, part, TextOptions(), *_spread(part, "p_partkey"))


def load_csv_enclosed(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return _round_trip(spark, docs, TextOptions(fields_terminated=",", fields_enclosed='"'), *_spread(docs, "doc_id"))


def load_multiline(spark, sf_dir):
    """Cells that hold raw newlines and quotes, in files that many tasks share."""
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", F.replace("text", F.lit("e "), F.lit('e\n"')).alias("text"), "lang")
    cell = F.concat(F.lit('"'), F.replace(F.replace("text", F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('""')), F.lit('"'))
    null = F.lit("\\N")
    d = scratch_dir(spark, "files")
    docs.select(F.concat_ws(",", "doc_id", F.coalesce(cell, null), F.coalesce("lang", null)).alias("value")).write.text(d)
    spec = _spec(spark, docs, TextOptions(fields_terminated=",", fields_enclosed='"', escaped_terminators=True))
    load_files(spark, spec, [d])
    return read_target(spark, spec)


def _spread(df: DataFrame, key: str, rows: int = 20_000) -> tuple[str, int]:
    """(key expression, number) of the files to write: more rows make more files."""
    n = max(4, -(-df.count() // rows))
    return f"{key} % {n}", n


def load_gzip(spark, sf_dir):
    cust = _table(spark, sf_dir, "customer")
    return _round_trip(spark, cust, TextOptions(), *_spread(cust, "c_custkey"), compression="gzip")


def load_skip_lines(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    return _round_trip(spark, orders, TextOptions(ignore_lines=3), *_spread(orders, "o_orderkey"), order_by=["o_orderkey"])


def load_line_prefix(spark, sf_dir):
    sup = _table(spark, sf_dir, "supplier")
    d = scratch_dir(spark, "files")
    # files carry two junk lines without the prefix; the loader needs no skip
    write_delimited(sup, d, TextOptions(lines_starting="xxx"), header_lines=2, files=4)
    spec = _spec(spark, sup, TextOptions(lines_starting="xxx"))
    load_files(spark, spec, [d])
    return read_target(spark, spec)


def load_multi_sep(spark, sf_dir):
    ev = _table(spark, sf_dir, "events")
    return _round_trip(spark, ev, TextOptions(fields_terminated="||", lines_terminated=";;"), *_spread(ev, "event_id"))


def load_columns(spark, sf_dir):
    li = _table(spark, sf_dir, "lineitem").select("l_quantity", "l_orderkey", "l_linenumber")
    d = scratch_dir(spark, "files")
    key, n = _spread(li, "l_orderkey")
    write_delimited(li.withColumn("_k", F.expr(key)), d, TextOptions(),
                    columns=["l_quantity", "l_orderkey", "l_linenumber"], file_key="_k", files=n)
    opts = TextOptions(columns=("l_quantity", "l_orderkey", "l_linenumber"), file_id_column="file_id")
    spec = _spec(spark, li, opts, schema="l_orderkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_tax DOUBLE, "
                                         "file_id DECIMAL(20,0)")
    load_files(spark, spec, [d])
    t = read_target(spark, spec)
    return t.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", F.col("file_id").isNotNull().alias("has_file_id"))


# --- duplicate keys --------------------------------------------------------------

_ORDER_COLS = ["o_orderkey", "o_custkey", "o_totalprice"]


def _dup_fixture(spark, sf_dir, base_filter: str, files: dict[str, DataFrame], method: str,
                 spread: bool = False):
    orders = _table(spark, sf_dir, "orders").select(*_ORDER_COLS)
    spec = _spec(spark, orders, TextOptions(), keys=["o_orderkey"], method=method)
    base = orders.where(base_filter).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    base.write.parquet(spec.target.path)
    d = scratch_dir(spark, "files")
    if spread:  # several files of each name, in the names' order
        key, n = _spread(orders, "o_orderkey")
        parts = [df.withColumn("_k", F.concat(F.lit(f"{k}-"), F.expr(key).cast("string"))) for k, df in files.items()]
    else:
        n, parts = 1, [df.withColumn("_k", F.lit(k)) for k, df in files.items()]
    allrows = parts[0]
    for p in parts[1:]:
        allrows = allrows.unionByName(p)
    write_delimited(allrows, d, TextOptions(), columns=_ORDER_COLS, file_key="_k", files=n * len(files),
                    order_by=["o_orderkey"], stable_names=True)
    out = load_files(spark, spec, [d])
    return spec, out


def load_dup_ignore(spark, sf_dir):
    o = _table(spark, sf_dir, "orders").select(*_ORDER_COLS)
    spec, _ = _dup_fixture(spark, sf_dir, "o_orderkey % 5 = 0", {
        "a": o, "b": o.where("o_orderkey % 3 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)}, "ignore", spread=True)
    return read_target(spark, spec)


def load_dup_replace(spark, sf_dir):
    o = _table(spark, sf_dir, "orders").select(*_ORDER_COLS)
    spec, _ = _dup_fixture(spark, sf_dir, "o_orderkey % 5 = 0", {
        "a": o, "b": o.where("o_orderkey % 3 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)}, "replace", spread=True)
    return read_target(spark, spec)


def _error_files(o):
    return {"a": o.where("o_orderkey % 3 = 1"), "b": o.where("o_orderkey % 3 = 2"),
            "c": o.where("o_orderkey % 3 = 0").unionByName(o.where("o_orderkey % 21 = 0"))}


def load_dup_error(spark, sf_dir):
    o = _table(spark, sf_dir, "orders").select(*_ORDER_COLS)
    spec, _ = _dup_fixture(spark, sf_dir, "o_orderkey % 5 = 0 AND o_orderkey % 3 = 1", _error_files(o), "error")
    return read_target(spark, spec)


def load_verdicts(spark, sf_dir):
    o = _table(spark, sf_dir, "orders").select(*_ORDER_COLS)
    _, out = _dup_fixture(spark, sf_dir, "o_orderkey % 5 = 0 AND o_orderkey % 3 = 1", _error_files(o), "error")
    return out.verdicts.select(F.regexp_extract("name", r"key=([^/]+)/", 1).alias("file"),
                               "status", "error", "row_count")


def _as_text(o: DataFrame, bad: str | None = None) -> DataFrame:
    """The orders with the price as text; where ``bad`` holds it is no number."""
    price = F.col("o_totalprice").cast("string")
    return o.withColumn("o_totalprice", F.when(F.expr(bad), F.lit("oops")).otherwise(price) if bad else price)


def load_error_isolated(spark, sf_dir):
    """A file with a bad value takes no key from the clean file after it; of two clean files that share
    keys the first loads."""
    o = _table(spark, sf_dir, "orders").select(*_ORDER_COLS)
    first = o.where("o_orderkey % 3 = 1")
    _, out = _dup_fixture(spark, sf_dir, "false", {
        "a": _as_text(first, "o_orderkey % 7 = 0"), "b": _as_text(first),
        "c": _as_text(o.where("o_orderkey % 3 = 2").unionByName(first)),
        "d": _as_text(o.where("o_orderkey % 3 = 2"))}, "error")
    return out.verdicts.select(F.regexp_extract("name", r"key=([^/]+)/", 1).alias("file"), "status",
                               F.regexp_extract("error", "^[A-Z][a-z]+ [a-z]+", 0).alias("error"), "row_count")


def load_error_reload(spark, sf_dir):
    """K2 / K5: a reload that fails keeps its old rows, so a file that brings their keys fails too."""
    o = _table(spark, sf_dir, "orders").select(*_ORDER_COLS)
    opts = TextOptions(columns=tuple(_ORDER_COLS), file_id_column="file_id")
    spec = _spec(spark, o, opts, keys=["o_orderkey"], schema=o.schema.simpleString()[:-1] + ",file_id:decimal(20,0)>")
    d = scratch_dir(spark, "files")

    def put(files):
        for name, rows in files.items():
            write_delimited(rows.withColumn("_k", F.lit(name)), f"{d}-{name}", TextOptions(), columns=_ORDER_COLS,
                            file_key="_k", files=1, order_by=["o_orderkey"], stable_names=True)
            replace_files(spark, f"{d}-{name}", d)
        load_files(spark, spec, [f"{d}/key={name}" for name in files])

    third = [o.where(f"o_orderkey % 3 = {k}") for k in range(3)]
    put({"a": _as_text(third[1]), "b": _as_text(third[2])})
    put({"a": _as_text(third[1], "o_orderkey % 7 = 0"),
         "b": _as_text(third[2].unionByName(third[1].where("o_orderkey % 5 = 0"))), "c": _as_text(third[0])})
    return read_target(spark, spec).drop("file_id")


# --- per-file reload ----------------------------------------------------------------

def reload_changed_file(spark, sf_dir, buckets: int | None = None):
    cust = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    d = scratch_dir(spark, "files")
    opts = TextOptions(columns=("c_custkey", "c_name", "c_nationkey", "c_acctbal"), file_id_column="file_id")
    write_delimited(cust.withColumn("_k", F.col("c_nationkey")), d, TextOptions(), columns=cust.columns,
                    file_key="_k", files=25, order_by=["c_custkey"], stable_names=True)
    spec = _spec(spark, cust, opts, schema=cust.schema.simpleString()[:-1] + ",file_id:decimal(20,0)>")
    if buckets:
        from dataclasses import replace
        spec = replace(spec, target=replace(spec.target, file_id_buckets=buckets))
    load_files(spark, spec, [d])
    # producer rewrites nations 0-4 and empties nation 5
    changed = cust.where("c_nationkey < 5").withColumn("c_acctbal", F.col("c_acctbal") + 1000)
    d2 = scratch_dir(spark, "files-v2")
    write_delimited(changed.withColumn("_k", F.col("c_nationkey")), d2, TextOptions(), columns=cust.columns,
                    file_key="_k", files=5, order_by=["c_custkey"], stable_names=True)
    replace_files(spark, d2, d)
    truncate_file(spark, f"{d}/key=5/data.txt")
    load_files(spark, spec, [f"{d}/key={k}" for k in range(6)])
    return read_target(spark, spec).drop("file_id")


def reload_bucketed(spark, sf_dir):
    """K5 on a target bucketed by file id (8 buckets for 25 files)."""
    return reload_changed_file(spark, sf_dir, buckets=8)


# --- listing -----------------------------------------------------------------------

def _tree(spark, sf_dir) -> str:
    cust = _table(spark, sf_dir, "customer")
    root = scratch_dir(spark, "tree")
    write_delimited(cust.withColumn("_k", F.col("c_nationkey")), root, TextOptions(), columns=cust.columns,
                    file_key="_k", files=25, stable_names=True)
    write_delimited(cust.withColumn("_k", F.col("c_mktsegment")), root + "/deep", TextOptions(),
                    columns=cust.columns, file_key="_k", files=5, stable_names=True)
    return root


def _listed(spark, root: str, pattern: str, label: str) -> DataFrame:
    base = local_path(root).rstrip("/") + "/"
    m = list_files(spark, [base + pattern])
    return m.select(F.lit(label).alias("pattern"), F.expr(f"substring(name, {len(base) + 1})").alias("name"), "size")


def list_flat(spark, sf_dir):
    root = _tree(spark, sf_dir)
    return _listed(spark, root, "*/data.txt", "flat").unionByName(_listed(spark, root, "*", "top")).drop("size")


def list_recursive(spark, sf_dir):
    root = _tree(spark, sf_dir)
    return _listed(spark, root, "**/data.txt", "recursive").unionByName(
        _listed(spark, root, "deep/**", "deep")).drop("size")


def dry_run(spark, sf_dir):
    """What a load job would read — through the job API, nothing loaded."""
    from sluice.operators.job import run_load_job
    cust = _table(spark, sf_dir, "customer")
    root = scratch_dir(spark, "dry")
    write_delimited(cust.withColumn("_k", F.col("c_mktsegment")), root, TextOptions(), columns=cust.columns,
                    file_key="_k", files=5, stable_names=True)
    base = local_path(root).rstrip("/") + "/"
    spec = _spec(spark, cust, TextOptions())
    spec = LoadSpec(SourceSpec(paths=(base + "key=*/data.txt",)), spec.target, spec.options)
    plan = run_load_job(spark, spec, scratch_dir(spark, "dry-ledger"), dry_run=True)
    return plan.select(F.expr(f"substring(name, {len(base) + 1})").alias("name"))


_TEXT_COLS = ["c_custkey", "c_name", "c_mktsegment"]


def list_hidden(spark, sf_dir):
    """Names that start with ``_`` or ``.`` and empty files are listed, with their sizes."""
    cust = _table(spark, sf_dir, "customer")
    root = scratch_dir(spark, "tree")
    for stem, part in (("data", "c_nationkey < 9"), ("_data", "c_nationkey BETWEEN 9 AND 15"), (".data", "c_nationkey > 15")):
        d = f"{root}/{stem}"
        write_delimited(cust.where(part).withColumn("_k", F.col("c_nationkey")), d, TextOptions(), columns=_TEXT_COLS,
                        file_key="_k", files=9)
        name_part_files(spark, d, stem)
    truncate_file(spark, f"{root}/data/key=0/data.txt")
    base = local_path(root).rstrip("/") + "/"
    return list_files(spark, [base + "**"]).select(F.expr(f"substring(name, {len(base) + 1})").alias("name"), "size")


def _gzip_tree(spark, sf_dir):
    """A job's spec for gzip files by nation, some with hidden names; the file of nation 3 broke off."""
    cust = _table(spark, sf_dir, "customer").select(*_TEXT_COLS, "c_nationkey")
    root = scratch_dir(spark, "gz")
    for stem, part in (("data", "c_nationkey < 20"), ("_data", "c_nationkey >= 20")):
        d = f"{root}/{stem}"
        write_delimited(cust.where(part).withColumn("_k", F.col("c_nationkey")), d, TextOptions(), columns=cust.columns,
                        file_key="_k", files=20, compression="gzip")
        name_part_files(spark, d, stem)
    cut_file(spark, f"{root}/data/key=3/data.txt.gz", 40)
    spec = _spec(spark, cust, TextOptions())
    return LoadSpec(SourceSpec(paths=(local_path(root) + "/**.gz",)), spec.target, spec.options)


def load_corrupt_gzip(spark, sf_dir):
    """A gzip that cannot be unpacked fails alone, whatever its place in the job."""
    from sluice.operators.job import run_load_job
    spec = _gzip_tree(spark, sf_dir)
    run_load_job(spark, spec, scratch_dir(spark, "ledger"))
    return read_target(spark, spec)


def gzip_verdicts(spark, sf_dir):
    from sluice.operators.job import run_load_job
    out = run_load_job(spark, _gzip_tree(spark, sf_dir), scratch_dir(spark, "ledger"))
    return out.verdicts.select(F.regexp_extract("name", r"key=([^/]+)/", 1).cast("int").alias("nation"), "status",
                               F.regexp_extract("error", "^[a-z]+ gzip", 0).alias("error"), "row_count")


def _by_nation(spark, cust, root, name="data"):
    write_delimited(cust.withColumn("_k", F.col("c_nationkey")), f"{root}-new", TextOptions(), columns=cust.columns,
                    file_key="_k", files=25, order_by=["c_custkey"], stable_names=True)
    replace_files(spark, f"{root}-new", root)


def sync_same_content(spark, sf_dir):
    """Files uploaded again are known by their content; only the changed one is loaded."""
    from sluice.operators.job import sync
    cust = _table(spark, sf_dir, "customer").select(*_TEXT_COLS, "c_nationkey")
    root, ledger = scratch_dir(spark, "uploads"), scratch_dir(spark, "ledger")
    opts = TextOptions(columns=tuple(cust.columns), file_id_column="file_id")
    spec = _spec(spark, cust, opts, schema=cust.schema.simpleString()[:-1] + ",file_id:decimal(20,0)>")
    spec = LoadSpec(SourceSpec(paths=(local_path(root) + "/**",), fingerprint="etag"), spec.target, opts)
    _by_nation(spark, cust, root)
    first = sync(spark, spec, ledger)
    changed = F.when(F.col("c_nationkey") == 4, F.upper("c_name")).otherwise(F.col("c_name"))
    _by_nation(spark, cust.withColumn("c_name", changed), root)
    again = sync(spark, spec, ledger)
    counts = spark.createDataFrame([(1, first.submitted, first.ignored), (2, again.submitted, again.ignored)],
                                   "run INT, submitted BIGINT, ignored BIGINT")
    return read_target(spark, spec).select("c_custkey", "c_name").crossJoin(counts.where("run = 2").drop("run"))


def retry_loads(spark, sf_dir):
    """The failed file is mended and retried; its rows are loaded and its task succeeds."""
    from sluice.operators.job import retry_job, run_load_job
    from sluice.operators.ledger import read_ledger
    cust = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name")
    root, ledger = scratch_dir(spark, "files"), scratch_dir(spark, "ledger")
    spec = _spec(spark, cust, TextOptions())
    spec = LoadSpec(SourceSpec(paths=(local_path(root) + "/**",)), spec.target, spec.options)
    bad = F.when(F.col("c_nationkey") == 3, F.lit("oops")).otherwise(F.col("c_custkey").cast("string"))
    _by_nation(spark, cust.withColumn("c_custkey", bad), root)
    run_load_job(spark, spec, ledger)
    _by_nation(spark, cust, root)
    retry_job(spark, spec, ledger)
    _, tasks = read_ledger(spark, ledger)
    left = tasks.where("result <> 'success'").agg(F.count("*").alias("failed"))
    return read_target(spark, spec).crossJoin(left)


def list_patterns(spark, sf_dir):
    """Overlapping patterns list a file once, or as often as they match."""
    root = _tree(spark, sf_dir)
    base = local_path(root).rstrip("/") + "/"
    patterns = [base + "deep/**", base + "**/data.txt", base + "key=1*/*"]
    return reduce(DataFrame.unionByName, (
        list_files(spark, patterns, keep_duplicates=keep).groupBy(F.expr(f"substring(name, {len(base) + 1})").alias("name"))
        .agg(F.count("*").alias("times")).withColumn("kept", F.lit(keep)) for keep in (False, True)))


def load_text_options(spark, sf_dir):
    """Separators and columns as typed on a command line."""
    typed = TextOptions.from_text(fields_terminated="\\u0001", lines_terminated="\\x02\\n", columns="c_name , c_custkey")
    cust = _table(spark, sf_dir, "customer").select("c_name", "c_custkey", "c_nationkey")
    d = scratch_dir(spark, "files")
    key, n = _spread(cust, "c_custkey")
    write_delimited(cust.withColumn("_k", F.expr(key)), d, typed, columns=["c_name", "c_custkey"], file_key="_k", files=n)
    spec = _spec(spark, cust, typed)
    load_files(spark, spec, [d])
    return read_target(spark, spec)


def job_cycle(spark, sf_dir):
    """The ledger after a job with one bad file."""
    from sluice.functions.fields import task_data
    from sluice.operators.job import run_load_job
    from sluice.operators.ledger import read_ledger
    cust = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name")
    root, ledger = scratch_dir(spark, "files"), scratch_dir(spark, "ledger")
    bad = F.when(F.col("c_nationkey") == 3, F.lit("oops")).otherwise(F.col("c_custkey").cast("string"))
    _by_nation(spark, cust.withColumn("c_custkey", bad), root)
    spec = _spec(spark, cust, TextOptions())
    spec = LoadSpec(SourceSpec(paths=(local_path(root) + "/**",)), spec.target, spec.options)
    run_load_job(spark, spec, ledger)
    jobs, tasks = read_ledger(spark, ledger)
    d = task_data("data")
    return tasks.join(jobs.select(F.col("id").alias("job_id")), "job_id").select(
        F.regexp_extract(d["key_name"], r"key=([^/]+)/", 1).cast("int").alias("nation"), "result", "update_count",
        d["row_count"].alias("row_count"), F.regexp_extract(d["error"], "^[A-Z][a-z]+", 0).alias("error"), "bytes_total",
        F.get_json_object("steps", "$[0].name").alias("step"),
        (F.get_json_object("steps", "$[0].start") <= F.get_json_object("steps", "$[0].stop")).alias("in_order"))


def stored_versions(spark, sf_dir):
    """L1 over a stored ledger: tasks, then those cancelled, then those retried, of which half are
    cancelled; all appended to the buckets of their ids."""
    from sluice.functions.states import STATE_COLUMNS, now_literal, task_state
    from sluice.operators.ledger import append_versions, bulk_finish, read_ledger, retry_errors
    from sluice.plans.fixtures import tasks_view
    from sluice.session import FIXTURE_NOW
    ledger = scratch_dir(spark, "ledger")
    tasks = tasks_view(spark, sf_dir).withColumnRenamed("file_key", "file_id")
    append_versions(tasks, ledger)
    append_versions(bulk_finish(tasks, FIXTURE_NOW), ledger)
    append_versions(retry_errors(tasks, FIXTURE_NOW), ledger)
    append_versions(bulk_finish(read_ledger(spark, ledger)[1], FIXTURE_NOW, F.col("bytes_total") % 2 == 0), ledger)
    _, now_tasks = read_ledger(spark, ledger, ["update_count", *STATE_COLUMNS])
    return now_tasks.select("id", "update_count", "result", task_state(now_literal(FIXTURE_NOW)).alias("state"))


# --- script --------------------------------------------------------------------------

def load_script(spark, sf_dir):
    cust = _table(spark, sf_dir, "customer")
    d = scratch_dir(spark, "files")
    key, n = _spread(cust, "c_custkey")
    write_delimited(cust.withColumn("_k", F.expr(key)), d, TextOptions(), columns=cust.columns,
                    file_key="_k", files=n, compression="gzip")
    spec = _spec(spark, cust, TextOptions(), script="tr a-z A-Z")
    load_files(spark, spec, [d])
    return read_target(spark, spec)


# --- streaming -----------------------------------------------------------------------

def sync_stream(spark, sf_dir):
    from sluice.streaming.sync import run_sync_stream
    cust = _table(spark, sf_dir, "customer")
    landing = scratch_dir(spark, "landing")
    staging = scratch_dir(spark, "staging")
    ckpt = scratch_dir(spark, "sync-ckpt")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cust.schema.fields)
    spec = _spec(spark, cust, TextOptions(columns=tuple(cust.columns), file_id_column="fid"),
                 schema=schema + ", fid DECIMAL(20,0)")
    keyed = cust.withColumn("_k", F.col("c_nationkey"))
    write_delimited(keyed.where("c_nationkey < 13"), staging + "/1", TextOptions(), columns=cust.columns,
                    file_key="_k", files=13, stable_names=True)
    replace_files(spark, staging + "/1", landing)
    run_sync_stream(spark, spec, landing, ckpt)
    write_delimited(keyed.where("c_nationkey >= 13"), staging + "/2", TextOptions(), columns=cust.columns,
                    file_key="_k", files=12, stable_names=True)
    replace_files(spark, staging + "/2", landing)
    run_sync_stream(spark, spec, landing, ckpt)
    return read_target(spark, spec).select(cust.columns)


def watch_stream(spark, sf_dir):
    """A watch over two runs: between them files of five nations are written anew, those of twelve come in."""
    from sluice.streaming.watch import run_watch
    cust = _table(spark, sf_dir, "customer")
    landing, staging, ledger, ckpt = (scratch_dir(spark, f"watch-{x}") for x in ("landing", "staging", "ledger", "ckpt"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cust.schema.fields)
    spec = LoadSpec(SourceSpec(paths=(landing + "/**",)),
                    TargetSpec(path=scratch_dir(spark, "target"), schema=schema + ", fid DECIMAL(20,0)"),
                    TextOptions(columns=tuple(cust.columns), file_id_column="fid"))
    keyed = cust.withColumn("_k", F.col("c_nationkey"))
    anew = keyed.where("c_nationkey < 5").withColumn("c_acctbal", F.col("c_acctbal") + 1000)
    for n, part in enumerate((keyed.where("c_nationkey < 13"), anew.unionByName(keyed.where("c_nationkey >= 13")))):
        write_delimited(part, f"{staging}/{n}", TextOptions(), columns=cust.columns, file_key="_k", files=13,
                        stable_names=True)
        replace_files(spark, f"{staging}/{n}", landing)
        run_watch(spark, spec, ledger, ckpt)
    return read_target(spark, spec).select(cust.columns)


def heartbeat_stream(spark, sf_dir):
    from sluice.plans.fixtures import tasks_view
    from sluice.session import FIXTURE_NOW
    from sluice.streaming.heartbeat import run_heartbeat_stream
    schema = "task_id STRING, ts TIMESTAMP_NTZ, finished BOOLEAN"
    t = tasks_view(spark, sf_dir).where(F.col("execution_id").isNotNull() & F.col("last_contact").isNotNull())
    beats = t.select(F.col("id").alias("task_id"), F.col("last_contact").alias("ts"),
                     F.col("finished").isNotNull().alias("finished"))
    src, lost, ckpt = (scratch_dir(spark, f"heartbeat-{x}") for x in ("beats", "lost", "ckpt"))
    # every task beats a minute earlier first; then the latest beats, the last of which is the clock's
    beats.select("task_id", (F.col("ts") - F.expr("INTERVAL 60 SECONDS")).alias("ts"), F.lit(False).alias("finished")) \
        .write.parquet(src + "/1")
    clock = spark.createDataFrame([("clock", FIXTURE_NOW)], "task_id STRING, ts STRING").select(
        "task_id", (F.col("ts").cast("timestamp_ntz") + F.expr("INTERVAL 1 SECOND")).alias("ts"), F.lit(False).alias("finished"))
    beats.unionByName(clock).write.parquet(src + "/2")
    return run_heartbeat_stream(spark, src + "/*", schema, lost, ckpt)
