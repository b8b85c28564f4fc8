"""A corpus pipeline of five of the operators in ``sluice.llm``.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns documents with the
columns of ``documents``; the last adds hilbert, shard and slot (input columns of these names are replaced there).
``run`` writes each stage's result to the shared folder and reads it again.

Defined results, as the operators state them: language ID drops null, empty and letterless texts, and those scored
below its threshold; of rows with one id and text the n-gram join keeps one, of a group of near copies the least id
(ties by the row's text), and rows without an id stay; rows of one id and text are contaminated together; mixing
returns each document at least once and repeats whole rows; equal rows share their shards' places in any order.
An empty table gives an empty table at every stage. Other columns, whatever their names, pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import decontaminate, language, mixing, setjoin, sharding
from sluice.llm.tables import fresh, staged, table

#: Words of a shingle, and the similarity (p / q) from which documents are near duplicates.
NEAR = (5, 80, 100)
#: No source is repeated more often than this. The mixing query's 4.0 suits a corpus that is read once; here the
#: near copies have just been removed, and a source passed four times would bring each of its documents back three
#: times. 1.25 flattens the sources' shares as far as a quarter more words of the smallest source allow.
MAX_REPEATS = 1.25


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.identified(docs, language.fit(language.training_rows(docs)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return setjoin.one_of_each(docs, *NEAR).select(docs.columns)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, max_repeats=MAX_REPEATS)


def shard_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    (size,) = fresh(docs, "bytes")
    rows = docs.withColumn(size, (F.octet_length(text) + 16).cast("long"))
    return sharding.shard(rows, ["lang", "source", size], [F.crc32(text), F.col("doc_id")]).drop(size)


STAGES = [("language ID", identify_language), ("n-gram Jaccard join", drop_near_duplicates),
          ("benchmark decontamination", decontaminate_benchmark), ("mixing sources to target weights", mix_sources),
          ("sharding", shard_documents)]

#: The first stage's trained classifier has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
