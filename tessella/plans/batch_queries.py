"""Queries over batches, modes and data sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.plans import pipeline
from tessella.plans.record_queries import _COMPLETE, a10_completeness
from tessella.queries import query
from tessella.session import shared_dir, table
from tessella.streaming import microbatch as mb

_STATES = f"{_COMPLETE}, st AS (SELECT own.dataset, own.stem, own.n = 6 AS complete FROM own JOIN audl USING (dataset, stem))"


@query(f"WITH {_STATES}, b AS (SELECT dataset, CAST(floor((row_number() OVER (PARTITION BY dataset ORDER BY stem) - 1) / 20) AS INTEGER) AS batch FROM st) SELECT dataset, batch, count(*) AS stems FROM b GROUP BY 1, 2")
def l1_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Slices of twenty stems of each data set."""
    return mb.batches(a10_completeness(spark, sf), 20).groupBy("dataset", "batch").agg(F.count(F.lit(1)).alias("stems"))


@query(f"WITH {_STATES} SELECT dataset, CASE WHEN complete THEN 'ctc_ready' ELSE 'nvrasr_fallback' END AS mode, count(*) AS stems FROM st GROUP BY 1, 2")
def l4_modes(spark: SparkSession, sf: str) -> DataFrame:
    """Stems by the way they are to be processed."""
    return mb.with_mode(a10_completeness(spark, sf)).groupBy("dataset", "mode").agg(F.count(F.lit(1)).alias("stems"))


@query("SELECT b.name, b.ctc_dir FROM batch_all b WHERE b.name NOT IN (SELECT name FROM batch_missing_v3 WHERE name IS NOT NULL)")
def l6_not_pending(spark: SparkSession, sf: str) -> DataFrame:
    """Data sets with nothing left to fill in."""
    todo = table(spark, sf, "batch_missing_v3").where("name is not null").select("name").distinct()
    return table(spark, sf, "batch_all").join(todo, "name", "left_anti").select("name", "ctc_dir")


@query("SELECT name, audio_dir FROM batch_all WHERE starts_with(name, 'VK') AND name <> 'VKmoge'")
def l7_selected(spark: SparkSession, sf: str) -> DataFrame:
    """Data sets chosen by name."""
    sets = table(spark, sf, "batch_all")
    return pipeline.selected(sets.where(F.col("name").startswith("VK")), exclude=["VKmoge"]).select("name", "audio_dir")


def _run(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """All utterances, and the ledger of one run over them in which those without sample rate fail."""
    work = shared_dir(spark, "stream")
    rows = table(spark, sf, "utterance").groupBy("dataset", "stem").agg(F.max("mode").alias("mode"), F.max("sample_rate").alias("sample_rate"))
    rows.repartition(6, "dataset", "stem").write.parquet(f"{work}/in")
    plan = lambda df: df.withColumn("error", F.when(F.col("sample_rate").isNull(), "no sample rate"))
    mb.run_available(spark, f"{work}/in", "dataset string, stem string, mode string, sample_rate int", plan, f"{work}/out", f"{work}/ledger", f"{work}/checkpoint", 2)
    return rows, mb.read_ledger(spark, f"{work}/ledger")


_RUN = "u AS (SELECT dataset, stem, max(mode) AS mode, max(sample_rate) AS rate FROM utterance GROUP BY 1, 2)"


@query(f"WITH {_RUN} SELECT dataset, count(*) AS wanted, count(rate) AS done, count(*) - count(rate) AS failed, count(*) = count(rate) AS complete FROM u GROUP BY 1")
def l2_streamed(spark: SparkSession, sf: str) -> DataFrame:
    """Every utterance taken through the micro-batches of a stream, and the ledger's state of each data set."""
    rows, ledger = _run(spark, sf)
    return mb.dataset_states(ledger, rows).select("dataset", "wanted", "done", "failed", "complete")


@query(
    f"WITH {_RUN}, b AS (SELECT *, CAST(floor((row_number() OVER (PARTITION BY dataset, mode ORDER BY stem) - 1) / 25) AS INTEGER) AS batch FROM u WHERE mode IS NOT NULL) "
    "SELECT mode, dataset, batch, count(*) AS stems, count(rate) AS done, count(*) - count(rate) AS failed, count(*) = count(rate) AS finished FROM b GROUP BY 1, 2, 3"
)
def l3_scheduled(spark: SparkSession, sf: str) -> DataFrame:
    """Units of work by mode, data set and batch, and what a run over them has done."""
    rows, ledger = _run(spark, sf)
    return mb.unit_states(mb.schedule(rows.where("mode is not null"), 25), ledger)


@query(f"WITH {_RUN} SELECT dataset, stem FROM u WHERE rate IS NULL")
def l6_pending(spark: SparkSession, sf: str) -> DataFrame:
    """Utterances that are taken up again after a run: those that failed."""
    return mb.pending(*_run(spark, sf)).select("dataset", "stem")
