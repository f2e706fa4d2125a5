"""Incremental bronze ingest with Structured Streaming.

New files landing in a folder are picked up by a file stream, and each micro-batch
is loaded with the same lineage numbering as the batch path. Files are only read
whole, so every micro-batch holds complete files and record numbers need no state
across batches. The sink is :func:`effdated.sources.catalog.write_bronze`, which
overwrites the partitions of the files in the batch, so a batch replayed after a
failure rewrites the same partitions (idempotent, exactly-once effect). The stream
checkpoint lives in the session's checkpoint dir (a shared folder on a cluster).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from effdated.session import ensure_checkpoint_dir
from effdated.sources import catalog
from effdated.sources.csv import NA_TOKENS, OVERFLOW, _recorded, _split_table


def start_csv_ingest(spark: SparkSession, landing: str, table: str, names: Sequence[str],
                     sep: str = ",", skiprows: int = 0, checkpoint: str | None = None,
                     available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the ingest stream; ``available_now`` processes what is there and stops."""
    internal = [f"_c{i}" for i in range(len(names))]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in internal]
                          + [T.StructField(OVERFLOW, T.StringType())])
    reader = (spark.readStream.schema(schema).option("header", "false").option("sep", sep)
              .option("mode", "PERMISSIVE"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(landing)
    # the stream exposes _metadata like the batch reader; pass it through as columns
    stream = stream.select("*", F.col("_metadata.file_path").alias("_mp"),
                           F.col("_metadata.file_block_start").alias("_mb"))
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{catalog.normalise_table_name(table)}"

    def load(batch: DataFrame, _epoch: int) -> None:
        b = batch.withColumnRenamed("_mp", "_file").withColumnRenamed("_mb", "_blk")
        numbered = _bronze_batch_from_columns(b, names, skiprows)
        catalog.write_bronze(spark, numbered, table)

    w = stream.writeStream.foreachBatch(load).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def _bronze_batch_from_columns(b: DataFrame, names: Sequence[str], skip: int) -> DataFrame:
    """Record numbers for a micro-batch whose file / split columns are already present."""
    internal = [f"_c{i}" for i in range(len(names))]
    # number first, so that an over-long line of the preamble counts; then number the rows left anew
    ided = b.withColumn("_mid", F.monotonically_increasing_id())
    records = _recorded(ided, _split_table(ided, "_mid", "_off", "_m0"))
    kept = records.filter((F.col("_record") > skip + 1) & F.col(OVERFLOW).isNull()).withColumn("_good", F.monotonically_increasing_id())
    good = (kept.join(F.broadcast(_split_table(kept, "_good", "_off2", "_g0")), ["_file", "_blk"])
            .withColumn("_record", (F.col("_off2") + F.col("_good") - F.col("_g0") + skip + 2).cast("long")))
    stem = F.regexp_replace(F.element_at(F.split("_file", "/"), -1), r"\.[^.]+$", "")
    return good.select(
        *[F.when(F.col(i).isin(NA_TOKENS) | F.col(i).isNull(), F.lit(None).cast("string"))
          .otherwise(F.col(i)).alias(c) for i, c in zip(internal, names)],
        F.concat(stem, F.lit(":row:"), F.col("_record").cast("string")).alias("Source"),
        F.col("_record").alias("record_no"),
        F.element_at(F.split("_file", "/"), -1).alias("source_file"),
        F.substring(F.sha2(F.col("_file"), 256), 1, 16).alias("source_id"))


__all__ = ["start_csv_ingest"]
