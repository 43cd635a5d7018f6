"""Micro-batches over arriving utterances: bounded batches, a ledger, resume after failure.

The file source hands over at most so many files per batch and remembers what it handed over in the checkpoint, which
must lie in a shared folder. A batch is written under its number, so one that runs again replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

Plan = Callable[[DataFrame], DataFrame]
LEDGER = "batch_id bigint, dataset string, stem string, mode string, status string, updated_at timestamp"


def batches(stems: DataFrame, size: int) -> DataFrame:
    """Stems in order with the number of their slice of ``size`` within their data set."""
    w = Window.partitionBy("dataset").orderBy("stem")
    return stems.withColumn("batch", F.floor((F.row_number().over(w) - 1) / size).cast("int"))


def with_mode(stems: DataFrame) -> DataFrame:
    """Complete records go by their own tokens, others fall back to recognition."""
    return stems.withColumn("mode", F.when(F.col("complete"), "ctc_ready").otherwise("nvrasr_fallback"))


def schedule(stems: DataFrame, size: int) -> DataFrame:
    """Units of work (mode, dataset, batch, stems, first_stem, last_stem): each data set's stems of a mode in slices of ``size``."""
    w = Window.partitionBy("dataset", "mode").orderBy("stem")
    sliced = stems.withColumn("batch", F.floor((F.row_number().over(w) - 1) / size).cast("int"))
    return sliced.groupBy("mode", "dataset", "batch").agg(F.count(F.lit(1)).alias("stems"), F.min("stem").alias("first_stem"), F.max("stem").alias("last_stem"))


def unit_states(units: DataFrame, ledger: DataFrame) -> DataFrame:
    """``units`` with the stems ``done`` and ``failed`` so far, by their last line of the ledger, and whether one is ``finished``."""
    last = ledger.groupBy("dataset", "stem").agg(F.max_by(F.struct("mode", "status"), F.struct("updated_at", "batch_id")).alias("s")).select("dataset", "stem", "s.mode", "s.status")
    u, s = units.alias("u"), last.alias("s")
    within = (F.col("u.dataset") == F.col("s.dataset")) & (F.col("u.mode") == F.col("s.mode")) & F.col("s.stem").between(F.col("u.first_stem"), F.col("u.last_stem"))
    sums = u.join(s, within, "left").groupBy("u.mode", "u.dataset", "u.batch", "u.stems").agg(F.count_if(F.col("s.status") == "ok").alias("done"), F.count_if(F.col("s.status") == "error").alias("failed"))
    return sums.withColumn("finished", F.col("done") == F.col("stems"))


def pending(stems: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """Stems not yet done; those that failed are tried again."""
    if ledger is None:
        return stems
    return stems.join(ledger.where("status = 'ok'").select("dataset", "stem").distinct(), ["dataset", "stem"], "left_anti")


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(LEDGER).parquet(f"{path}/*")
    except AnalysisException:
        return None


def dataset_states(ledger: DataFrame, stems: DataFrame) -> DataFrame:
    """(dataset, wanted, done, failed, complete): a data set is complete once all its stems are done and none failed last."""
    last = ledger.groupBy("dataset", "stem").agg(F.max_by("status", F.struct("updated_at", "batch_id")).alias("status"))
    both = stems.select("dataset", "stem").distinct().join(last, ["dataset", "stem"], "left")
    sums = both.groupBy("dataset").agg(F.count(F.lit(1)).alias("wanted"), F.count_if(F.col("status") == "ok").alias("done"), F.count_if(F.col("status") == "error").alias("failed"))
    return sums.withColumn("complete", F.col("done") == F.col("wanted"))


def run_available(spark: SparkSession, source: str, schema: str, plan: Plan, output: str, ledger: str, checkpoint: str, files_per_batch: int = 32) -> StreamingQuery:
    """Process all files that have arrived, a bounded number at a time, and stop; returns the ended query.

    ``plan`` maps rows (dataset, stem, ...) to rows that keep both and may set ``error``. Utterances of a batch for
    which nothing comes back, or an error, are in the ledger as ``error``, never left out in silence. Started again
    with the same checkpoint it goes on where it stopped.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)

    def handle(batch: DataFrame, batch_id: int) -> None:
        place = f"{output}/batch={batch_id}"
        plan(batch).write.mode("overwrite").parquet(place)
        made = batch.sparkSession.read.parquet(place)
        failed = F.col("error").isNotNull() if "error" in made.columns else F.lit(False)
        states = made.groupBy("dataset", "stem").agg(F.max(failed.cast("int")).alias("bad"))
        status = F.when(F.coalesce("bad", F.lit(1)) == 0, "ok").otherwise("error")
        mode = F.col("mode") if "mode" in batch.columns else F.lit(None).cast("string")
        every = batch.select("dataset", "stem", mode.alias("mode")).distinct().join(states, ["dataset", "stem"], "left")
        lines = every.select(F.lit(batch_id).cast("bigint").alias("batch_id"), "dataset", "stem", "mode", status.alias("status"), F.current_timestamp().alias("updated_at"))
        lines.write.mode("overwrite").parquet(f"{ledger}/batch={batch_id}")

    query = rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def event_windows(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and mean values per user and window for a stream of events, rows later than ``late`` left out. An extension
    of our own: the batches above know no event time."""
    timed = events.withWatermark("ts", late)
    return timed.groupBy(F.window("ts", width).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean")).select("user_id", F.col("w.start").alias("start"), "n", "mean")
