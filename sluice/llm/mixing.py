"""Mixing of sources to target weights by temperature.

With p the sources' shares of all words, the weights are p ** a, normalised. The exponent a is bisected over
[0, 1]: at 1 sources keep their shares, at 0 all weigh the same. It is the one that meets ``entropy`` (a
share of ln(sources)), or the least that repeats no source more than ``max_repeats`` times, whichever flattens
less. The budget in words is ``budget``, or by default what passes the source that is repeated least exactly
once, so that no document is left out.

The weights are realised by block permutations: a source of weight w gets w * budget words, in passes over
all its documents, each pass in a new order (md5 of seed, pass and id); the last pass ends with the last
document that fits. A draw's begin is the words drawn from its source before it, so ``begin / words of the
source's budget`` interleaves all sources evenly: ``block`` cuts that line into ``blocks`` equal parts.

Running sums are taken in buckets of about ``BUCKET_ROWS`` documents by the leading digits of md5 and then
over the buckets' sums, so a source that holds a third of all rows spreads over many tasks. Each step of the
bisection is one small aggregate of the table of sources, which stays in Spark.

Defined results: a null source is a source of its own. Null and empty texts have no words and are drawn with
every full pass; a source without any word is passed once. Rows of equal id and source keep their own draws.
Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.tables import fresh, split_by, staged, table

MAX_REPEATS = 4.0
BLOCKS = 64
BUCKET_ROWS = 4096
SEED = "mix"
STEPS = 30


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def exponent(sources: DataFrame, max_repeats: float | None = MAX_REPEATS, entropy: float | None = None,
             budget: float | None = None) -> float:
    """The exponent for ``sources`` (words > 0)."""
    known = sources.agg(F.sum("words"), F.count("*"), F.max("words"), F.min("words")).first()
    total, count, most, least = known
    if not count or count == 1:
        return 1.0

    def flattest(fits) -> float:
        """The least exponent that ``fits``; 1 if none does."""
        low, high = 0.0, 1.0
        if fits(low):
            return low
        for _ in range(STEPS):
            middle = (low + high) / 2
            low, high = (low, middle) if fits(middle) else (middle, high)
        return high

    share = F.col("words") / F.lit(float(total))

    def sums(a: float) -> tuple[float, float]:
        row = sources.agg(F.sum(F.pow(share, F.lit(a))), F.sum(F.pow(share, F.lit(a)) * F.log(share))).first()
        return row[0], row[1]

    def repeats(a: float) -> bool:
        if budget is None:  # the largest source passes once
            return (most / least) ** (1 - a) <= max_repeats
        return (least / total) ** a / sums(a)[0] * budget <= max_repeats * least

    def flat_enough(a: float) -> bool:
        z, moment = sums(a)
        return math.log(z) - a * moment / z <= entropy * math.log(count)

    limits = [0.0]
    if entropy is not None:
        limits.append(flattest(flat_enough))
    if max_repeats is not None:
        limits.append(flattest(repeats))
    return math.ceil(max(limits) * 1e9) / 1e9 if entropy or max_repeats else 1.0


def plan(rows: DataFrame, max_repeats: float | None = MAX_REPEATS, entropy: float | None = None,
         budget: float | None = None) -> DataFrame:
    """source, docs, words, weight and quota (words to draw) of each source of ``rows`` (source, words)."""
    sources = staged(rows.groupBy("source").agg(F.count("*").alias("docs"), F.sum("words").alias("words")), "sources")
    full = sources.where("words > 0")
    a = exponent(full, max_repeats, entropy, budget)
    total, most = full.agg(F.sum("words"), F.max("words")).first()
    raw = F.when(F.col("words") > 0, F.pow(F.col("words") / F.lit(float(total or 1)), F.lit(a))).otherwise(0.0)
    z = full.agg(F.sum(raw)).first()[0] or 1.0
    weight = raw / F.lit(float(z))
    if budget is None:
        quota = F.pow(F.lit(float(most or 1)) / F.col("words"), F.lit(1 - a)) * F.col("words")
    else:
        quota = weight * F.lit(float(budget))
    return sources.withColumn("weight", weight).withColumn(
        "quota", F.when(F.col("words") > 0, F.floor(quota)).otherwise(0).cast("long"))


def draw(rows: DataFrame, planned: DataFrame, blocks: int = BLOCKS, seed: str = SEED) -> DataFrame:
    """The draws of ``rows`` (doc_id, source, words and any others): pass, begin and block are added."""
    largest = planned.agg(F.max("docs")).first()[0] or 1
    digits = max(1, math.ceil(math.log(max(1, largest / BUCKET_ROWS), 16)))
    quota = planned.select(F.col("source").alias("_source"), F.col("words").alias("_words"), F.col("quota").alias("_quota"))
    passes = F.when(F.col("_words") > 0, F.ceil(F.col("_quota") / F.col("_words"))).otherwise(1).cast("int")
    drawn = (rows.join(quota, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
             .withColumn("pass", F.explode(F.sequence(F.lit(0), F.greatest(passes, F.lit(1)) - 1)))
             .withColumn("_key", F.md5(F.concat_ws(":", F.lit(seed), F.col("pass"), F.col("doc_id").cast("string"))))
             .withColumn("_bucket", F.substring("_key", 1, digits)))
    drawn = staged(drawn, "passes")
    sums = drawn.groupBy("source", "pass", "_bucket").agg(F.sum("words").alias("_sum"))
    over = Window.partitionBy("source", "pass").orderBy("_bucket")
    offset = sums.select(F.col("source").alias("_s"), F.col("pass").alias("_p"), F.col("_bucket").alias("_b"),
                         (F.sum("_sum").over(over) - F.col("_sum")).alias("_before"))
    within = Window.partitionBy("source", "pass", "_bucket").orderBy("_key", "doc_id", "words").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    placed = (drawn.withColumn("_upto", F.sum("words").over(within))
              .join(offset, F.col("source").eqNullSafe(F.col("_s")) & (F.col("pass") == F.col("_p"))
                    & (F.col("_bucket") == F.col("_b")))
              .withColumn("_end", F.col("pass") * F.col("_words") + F.col("_before") + F.col("_upto")))
    whole = (F.col("pass") + 1) * F.col("_words") <= F.col("_quota")
    kept = placed.where(whole | (F.col("_end") <= F.col("_quota")) | (F.col("_words") == 0))
    begin = F.col("_end") - F.col("words")
    block = F.least(F.floor(begin * blocks / F.greatest(F.col("_quota"), F.lit(1))), F.lit(blocks - 1))
    return kept.withColumn("begin", begin).withColumn("block", block.cast("int")).drop(
        "_words", "_quota", "_key", "_bucket", "_upto", "_s", "_p", "_b", "_before", "_end")


def mixed(documents: DataFrame, max_repeats: float | None = MAX_REPEATS, entropy: float | None = None,
          budget: float | None = None) -> DataFrame:
    """``documents``, all columns, each row as often as it is drawn. Rows of one id, source and text are taken
    as repetitions of one."""
    key = F.xxhash64("text")
    rows = staged(documents.select("doc_id", "source", key.alias("_text"), word_count(F.col("text")).alias("words")),
                  "words")
    drawn = draw(rows, plan(rows, max_repeats, entropy, budget))
    given = drawn.groupBy("doc_id", "source", "_text").agg(F.count("*").alias("_draws"))
    times = given.toDF("_i", "_s", "_t", "_draws").join(
        rows.groupBy("doc_id", "source", "_text").agg(F.count("*").alias("_rows")),
        F.col("doc_id").eqNullSafe(F.col("_i")) & F.col("source").eqNullSafe(F.col("_s")) & (F.col("_text") == F.col("_t")),
        "right").select("doc_id", "source", "_text", F.coalesce("_draws", F.lit(0)).alias("_draws"), "_rows")
    # most rows are drawn once: only the texts of the others are shuffled.
    # repeated rows share their draws: each as many as all can have, the first ones one more
    times = staged(times.where("_draws <> _rows"), "draws")
    text, own, i, src, t, draws, held, place, n = fresh(
        documents, "text_", "own", "i", "s", "t", "draws", "rows", "place", "n")
    keyed = documents.withColumn(text, key).withColumn(own, F.xxhash64("doc_id", "source", text))
    others, once = split_by(keyed, own, times.select(F.xxhash64("doc_id", "source", "_text").alias("key")))
    times = times.toDF(i, src, t, draws, held)
    same = F.col("doc_id").eqNullSafe(F.col(i)) & F.col("source").eqNullSafe(F.col(src)) & (F.col(text) == F.col(t))
    once = once.unionByName(others.join(times, same, "left_anti")).select(*documents.columns)
    joined = others.join(times, same)
    nth = F.when(F.col(held) == 1, 1).otherwise(F.row_number().over(Window.partitionBy(i, src, t).orderBy(held)))
    count = F.floor(F.col(draws) / F.col(held)) + F.when(F.col(place) <= F.col(draws) % F.col(held), 1).otherwise(0)
    other = (joined.withColumn(place, nth).withColumn(n, count.cast("int")).where(F.col(n) > 0)
            .withColumn(n, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*documents.columns))
    return once.unionByName(other)


def op2_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staged(table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("words")),
                  "words")
    return draw(rows, plan(rows)).select("doc_id", "source", "words", "pass", "begin", "block")


ORACLE = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) AS words FROM documents),
src AS (SELECT source, count(*) AS docs, CAST(sum(words) AS DOUBLE) AS words FROM docs GROUP BY source),
ends AS (SELECT max(words) AS most, min(words) AS least, count(*) AS n FROM src WHERE words > 0),
halving AS (
  SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
  UNION ALL
  SELECT step + 1,
         CASE WHEN pow(most / least, 1 - (low + high) / 2) <= 4.0 THEN low ELSE (low + high) / 2 END,
         CASE WHEN pow(most / least, 1 - (low + high) / 2) <= 4.0 THEN (low + high) / 2 ELSE high END
  FROM halving, ends WHERE step < 30),
temper AS (
  SELECT CASE WHEN n <= 1 THEN 1.0 WHEN most / least <= 4.0 THEN 0.0 ELSE ceil(high * 1e9) / 1e9 END AS a, most
  FROM halving, ends WHERE step = 30),
quotas AS (
  SELECT source, docs, words, CASE WHEN words > 0 THEN floor(pow(most / words, 1 - a) * words) ELSE 0 END AS quota
  FROM src, temper),
passes AS (
  SELECT source, words AS all_words, quota,
         unnest(range(0, CAST(CASE WHEN words > 0 THEN greatest(ceil(quota / words), 1) ELSE 1 END AS BIGINT))) AS pass
  FROM quotas),
placed AS (
  SELECT doc_id, d.source, d.words, p.pass, all_words, quota,
         p.pass * all_words + sum(d.words) OVER (PARTITION BY d.source, p.pass
           ORDER BY md5('mix:' || p.pass || ':' || doc_id), doc_id, d.words
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM docs d JOIN passes p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, source, CAST(words AS BIGINT) AS words, CAST(pass AS INTEGER) AS pass,
       CAST(upto - words AS BIGINT) AS begin,
       CAST(least(floor((upto - words) * 64 / greatest(quota, 1)), 63) AS INTEGER) AS block
FROM placed WHERE (pass + 1) * all_words <= quota OR upto <= quota OR all_words = 0
"""
