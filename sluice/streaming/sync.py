"""T1 as a stream: load new files of a landing directory as they arrive.

``readStream`` over the text source with ``_metadata`` → ``foreachBatch``
parses the micro-batch's lines with the same decoding as the batch reader and
loads them with the file verdict / duplicate-key / file-id rules.  With
``trigger(availableNow=True)`` it is an incremental batch job; the checkpoint
(in the shared checkpoint folder) remembers which files were done.  A batch
that was written but not yet marked done runs again after a crash; its files
then replace their own rows, which is why a file-id column is required.

The file source does not re-read a file whose content changed under the same
name; for changed files use the batch ``sync``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.load import load_files
from sluice.sources.delimited import lines_from_stream, parse_lines
from sluice.sources.paths import decode_file_path
from sluice.session import scratch_dir
from sluice.spec import LoadSpec


def start_sync_stream(spark: SparkSession, spec: LoadSpec, landing_dir: str, checkpoint: str | None = None,
                      available_now: bool = True, max_files_per_trigger: int = 1000,
                      name_glob: str | None = None):
    """Start the stream; returns the ``StreamingQuery``."""
    if spec.options.ignore_lines or spec.options.escaped_terminators:
        raise ValueError("skip-lines / escaped terminators need whole files: use the batch sync")
    if not spec.options.file_id_column:
        raise ValueError("a repeated batch must replace its own rows: set options.file_id_column")
    reader = (spark.readStream.format("text").option("lineSep", spec.options.lines_terminated)
              .option("recursiveFileLookup", "true"))
    if name_glob:  # file-name pattern, e.g. "*.tsv.gz"
        reader = reader.option("pathGlobFilter", name_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(landing_dir).select(
        "value", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"))

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        s = batch.sparkSession
        parsed = parse_lines(lines_from_stream(batch, spec.options), spec.target.struct, spec.options)
        # the micro-batch's files (at most maxFilesPerTrigger names)
        paths = [r[0] for r in batch.select(decode_file_path(F.col("_path"))).distinct().collect()]
        if paths:
            load_files(s, spec, paths, rows=parsed)

    w = lines.writeStream.foreachBatch(load_batch).option(
        "checkpointLocation", checkpoint or scratch_dir(spark, "sync-stream"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def run_sync_stream(spark: SparkSession, spec: LoadSpec, landing_dir: str, checkpoint: str,
                    name_glob: str | None = None) -> None:
    """One incremental run (availableNow) to completion."""
    q = start_sync_stream(spark, spec, landing_dir, checkpoint, available_now=True, name_glob=name_glob)
    q.awaitTermination()
