"""Mended operators: line dedup of repeated lines, clashing column names, the pipeline's stages, the benchmark's index."""

import pickle
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF01
from sluice.llm import decontaminate, language, linededup, mixing, setjoin, sharding
from sluice.llm.tables import BATCH_BYTES, split_by, table


# --- line dedup ----------------------------------------------------------------------------------------------

def _patience(early, late):
    """Places of equal lines by patience diff, the plain way."""
    if not early or not late:
        return []
    if early[0] == late[0]:
        return [(0, 0)] + [(i + 1, j + 1) for i, j in _patience(early[1:], late[1:])]
    if early[-1] == late[-1]:
        return [*_patience(early[:-1], late[:-1]), (len(early) - 1, len(late) - 1)]
    both = [(early.index(x), j) for j, x in enumerate(late) if early.count(x) == late.count(x) == 1]
    best = []  # longest ascending chain ending at each
    for k, (i, _) in enumerate(both):
        below = [best[m] for m in range(k) if both[m][0] < i]
        best.append(max(below, key=len, default=[]) + [both[k]])
    chain = max(best, key=len, default=[])
    out, edges = list(chain), [(-1, -1), *chain, (len(early), len(late))]
    for (a, c), (b, d) in zip(edges, edges[1:]) if chain else ():
        out += [(a + 1 + i, c + 1 + j) for i, j in _patience(early[a + 1:b], late[c + 1:d])]
    return sorted(out)


def _kept(docs, min_words):
    lines = {k: [x for x in t.split("\n") if x] for k, t in docs}
    out = {}
    for k, own in lines.items():
        gone = set()
        for early in (x for x in lines if x < k):
            block, last = [], None
            for i, j in [*_patience([x.lower() for x in lines[early]], [x.lower() for x in own]), (-9, -9)]:
                if last != (i - 1, j - 1):
                    gone |= set(block) if sum(len(own[x].split()) for x in block) >= min_words else set()
                    block = []
                block.append(j)
                last = (i, j)
        out[k] = "\n".join(x for i, x in enumerate(own) if i not in gone)
    return out


def _frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(3)


def test_repeated_lines_equal_all_pairs(spark):
    rng = random.Random(4)
    line, other = "one two three four five six", "seven eight nine ten eleven"
    docs = [(i, "\n".join(rng.choice([line, line, other, f"own {i} {k}", "short"]) for k in range(rng.randint(1, 7))))
            for i in range(90)]
    for rare in (1, 3):
        got = {r.doc_id: r.text for r in linededup.deduplicated(_frame(spark, docs), rare, 6).collect()}
        assert got == _kept(docs, 6)


@pytest.mark.parametrize("n", [100, 400])
def test_repeated_lines_are_aligned_by_class(spark, n):
    """A line twice in each document has no anchor: all pairs, but one class."""
    line = "the same line of more than ten words stands twice in here"
    docs = [(i, f"a{i}\n{line}\nb{i}\nc{i}\n{line}\nd{i}") for i in range(n)]
    held = linededup.line_hashes(_frame(spark, docs)).withColumnRenamed("doc_id", "doc")
    of = linededup.classes(held.select("doc"), held)
    assert of.count() == n and of.select("class").distinct().count() == 1
    run = of.select("doc").withColumn("run", F.lit(1))
    assert linededup.class_pairs(run, run, of).count() == 1
    assert linededup.deduplicated(_frame(spark, docs)).agg(F.sum("n_deleted")).first()[0] == 0


# --- column names --------------------------------------------------------------------------------------------

CLASHING = ("hilbert", "shard", "slot", "_bucket", "bucket", "bits", "held", "_n", "n", "place", "text_", "draws", "rows",
            "row", "part", "before", "rank", "size", "id", "key", "gone", "_id", "_key", "order0")


@pytest.fixture(scope="module")
def named(spark):
    docs = table(spark, SF01, "documents").where("doc_id < 300")
    extra = spark.createDataFrame([(None, None, "en", "src1", 3), (7, "", "en", None, 0), (7, "", "en", None, 0)], docs.schema)
    docs = docs.unionByName(extra)
    return docs.select("*", *(F.concat(F.lit(f"{c}:"), F.col("doc_id")).alias(c) for c in CLASHING)).repartition(4)


def _same(df, docs):
    """Every row of ``df`` keeps its own columns."""
    assert df.columns == docs.columns
    odd = [F.coalesce(F.col(c) != F.concat(F.lit(f"{c}:"), F.col("doc_id")), F.lit(False)) for c in CLASHING]
    assert df.where(F.greatest(*(o.cast("int") for o in odd)) == 1).count() == 0
    return df


def test_operators_leave_clashing_columns_alone(spark, named):
    some = split_by(named, "doc_id", named.where("doc_id % 3 = 0").select("doc_id"))
    assert sum(_same(x, named).count() for x in some) == named.count()
    assert _same(mixing.mixed(named, max_repeats=2.0), named).count() >= named.count()
    assert _same(setjoin.one_of_each(named, 5, 80, 100), named).count() > 0
    assert _same(decontaminate.clean(named, table(spark, SF01, "benchmark")), named).count() > 0
    lines = linededup.deduplicated(named)
    _same(lines.drop("n_lines", "n_deleted"), named)
    placed = sharding.shard(named, ["lang", "source", "n_chars"], [F.col("doc_id")], shards=7)
    assert placed.columns == [c for c in named.columns if c not in sharding.OWN] + ["hilbert", "shard", "slot"]
    assert placed.where("bits <> concat('bits:', doc_id)").count() == 0
    sizes = [r["count"] for r in placed.groupBy("shard").count().collect()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1 and sum(sizes) == named.count()


def test_written_shards_are_cut(spark, named, scratch):
    placed = sharding.shard(named.drop(*CLASHING), ["lang", "n_chars"], [F.col("doc_id")], shards=3)
    path = scratch("shards")
    sharding.write_shards(placed, path, rows_a_file=40)
    back = spark.read.parquet(path)
    assert back.count() == named.count() and back.select("shard").distinct().count() == 3
    files = back.groupBy(F.input_file_name().alias("f"), "shard").agg(F.count("*").alias("n"), F.min("slot").alias("a"), F.max("slot").alias("b"))
    assert files.count() > 6 and files.where("b - a + 1 <> n").count() == 0


# --- pipeline ------------------------------------------------------------------------------------------------

def test_every_stage_keeps_columns_and_clean_rows(spark, named):
    docs = named
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF01).persist()
        if name != "sharding":
            _same(docs, before)
            ids = docs.select("doc_id").distinct()
            assert ids.join(before.select("doc_id").distinct(), "doc_id", "left_anti").count() == 0
            assert ids.count() > 0.6 * before.select("doc_id").distinct().count()
    assert docs.columns == [c for c in named.columns if c not in sharding.OWN] + ["hilbert", "shard", "slot"]
    assert docs.groupBy("shard").count().agg(F.max("count") - F.min("count")).first()[0] <= 1
    empty = named.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF01).count() == 0


# --- the benchmark's index -----------------------------------------------------------------------------------

def test_index_is_bounded_by_its_text():
    rng = random.Random(2)
    items = [(str(k), " ".join(f"w{rng.randint(0, 9999)}" for _ in range(120))) for k in range(2000)]
    text = sum(len(t) for _, t in items)
    index = decontaminate.build_index([*items, items[0], ("again", items[0][1])])
    assert len(pickle.dumps(index, 5)) < 16 * text
    big = next(g for g in index["groups"] if g["size"] == 13)
    assert sorted(big["owners"][big["owned"][0]:big["owned"][1]].tolist()) and len(big["first"]) == 2000 * 108


# --- memory of a task ----------------------------------------------------------------------------------------

def test_batches_of_long_texts_are_bounded_by_bytes(spark):
    def seen(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["rows"])

    docs = spark.range(0, 60, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab cd "), 50_000).alias("text"))
    language.identified(docs, None)  # as any stage of the pipeline that runs Python
    rows = [r.rows for r in docs.mapInArrow(seen, "rows long").collect()]
    assert sum(rows) == 60 and max(rows) * 300_000 <= BATCH_BYTES + 300_000


def test_frequent_shingles_are_counted_over_batches(spark):
    docs = spark.range(0, 60, 1, 1).select(F.col("id").alias("doc_id"), F.concat(
        F.lit("one two three "), F.repeat(F.concat(F.col("id"), F.lit(" ")), 150_000)).alias("text"))
    found = setjoin.describe(docs, 3)
    assert sorted(r.doc_id for r in found.collect()) == list(range(60))
    (often,) = [r.often for r in found.where("often is not null").collect()]
    assert [x.held for x in often] == [60]


def test_mixing_shuffles_only_texts_that_are_not_drawn_once(spark, scratch):
    path = scratch("mix")
    rows = [(k, f"word{k} " * 3, "big", "x") for k in range(40)] + [(k, f"few{k} " * 2, None, "x") for k in range(40, 50)]
    rows += [(3, "word3 " * 3, "big", "y"), (None, "no id", "big", "x"), (None, None, "big", "x"), (50, None, None, "x")]
    spark.createDataFrame(rows, "doc_id long, text string, source string, own string").write.parquet(path)
    docs = spark.read.parquet(path)
    mixed = mixing.mixed(docs, max_repeats=2.0)
    found = {tuple(r): r["count"] for r in mixed.groupBy("doc_id", "text", "source", "own").count().collect()}
    assert {k[:4] for k in found} == set(rows) and max(found.values()) == 2 and len(rows) < sum(found.values()) < 2 * len(rows)
    assert all(n == 1 for (*_, source, _, _), n in found.items() if source == "big")
    plan = mixed._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "LeftAnti" in plan
