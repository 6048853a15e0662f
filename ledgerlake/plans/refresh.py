"""The warehouse refresh: three Gold tables from their facts, incrementally, watermark last."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.contracts import AGG_CHURN, AGG_FRAUD, AGG_RISK, CDC_CONTROL, Contract
from ledgerlake.operators import gold, incremental, quality
from ledgerlake.operators.operations import SMALL_FILES, maintain
from ledgerlake.sources.publish import publish_table, recover
from ledgerlake.sources.sinks import LOAD_STATS, exists, load_unlogged, log_load


@dataclass(frozen=True)
class GoldJob:
    source: str  # key in the control table
    fact: str  # path of the fact table
    contract: Contract
    agg: Callable[..., DataFrame]
    dq: Callable[[DataFrame], DataFrame]
    bucket: Callable[[Column], Column]
    arrival: str | None = None  # column that tells when a row came in; null: rows come in order of event time
    by_files: bool = False  # new rows are those of files that no run has processed, whatever their instants


def fraud_job(path: str, arrival: str | None = None) -> GoldJob:
    return GoldJob("fraud_scores", path, AGG_FRAUD, gold.gold_fraud_hourly, quality.dq_fraud, incremental.hour_bucket, arrival)


def risk_job(path: str, arrival: str | None = None) -> GoldJob:
    return GoldJob("credit_risk", path, AGG_RISK, gold.gold_risk_daily, quality.dq_credit, incremental.day_bucket, arrival)


def churn_job(path: str, arrival: str | None = None) -> GoldJob:
    return GoldJob("churn_scores", path, AGG_CHURN, gold.gold_churn_weekly, quality.dq_churn, incremental.week_bucket, arrival)


def control_table(spark: SparkSession, path: str) -> DataFrame:
    recover(spark, path)
    return spark.read.schema(CDC_CONTROL).parquet(path) if exists(spark, path) else spark.createDataFrame([], CDC_CONTROL)


def _ledger(root: str, job: GoldJob) -> str:
    return f"{root}/processed_files/{job.source}"


def _refresh(spark: SparkSession, job: GoldJob, control: DataFrame, root: str, now: datetime):
    """(progress row, load statistics, files read), or nothing to do."""
    fact, files = spark.read.parquet(job.fact), []
    at = job.arrival or "event_time"
    if job.by_files:
        files = incremental.new_files(spark, job.fact, _ledger(root, job))
        if not files:
            return None, None, files
        new = incremental.rows_of_files(spark, job.fact, files)
    else:
        wm = incremental.get_watermark(control, job.source)
        new = incremental.new_rows(fact, wm, at)
    progress = incremental.batch_progress(new, job.source, at).collect()  # no row or one
    if not progress:
        return None, None, files
    quality.gate(job.dq(new))
    if job.by_files:
        refreshed = job.agg(incremental.reopened_rows(fact, new, job.bucket), batch_ts=now)
    else:
        refreshed = incremental.refresh_gold(fact, wm, lambda df: job.agg(df, batch_ts=now), job.bucket, arrival=job.arrival)
    ordered = refreshed.select(*job.contract.columns)
    stats = load_unlogged(ordered, root, job.contract.name, job.contract, list(job.contract.primary_key), loaded_at=now)
    return progress[0], stats, files


def warehouse_refresh(spark: SparkSession, jobs: list[GoldJob], root: str, now: datetime, least_files: int = SMALL_FILES
                      ) -> DataFrame:
    """Refresh every Gold table, advance the watermarks of those that were written, then maintain the tables.

    The three refreshes are independent and run side by side; their lines go to the load log together. A run that
    fails before the watermarks move leaves them where they were, so the next run repeats the work with
    the same result. Maintenance comes last and only joins small files of refreshed tables.
    """
    root = root.rstrip("/")
    control_path = f"{root}/cdc_control"
    control = control_table(spark, control_path)
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        done = list(pool.map(lambda j: _refresh(spark, j, control, root, now), jobs))
    progress = [p for p, _, _ in done if p is not None]
    loads = [s for _, s, _ in done if s is not None]
    empty = spark.createDataFrame([], f"{LOAD_STATS}, duration_seconds double")
    stats = incremental.union_all(empty, *loads)
    if progress:
        log_load(stats.coalesce(1), f"{root}/load_log")
        update = spark.createDataFrame(progress, "table_name string, __ts timestamp, __n bigint")
        publish_table(incremental.advance_with(control, update, now), control_path)
        for job, (moved, _, files) in zip(jobs, done):
            if files:
                incremental.commit_files(spark, _ledger(root, job), files, now.strftime("%Y%m%d%H%M%S%f"))
            if moved is not None:
                maintain(spark, f"{root}/{job.contract.name}", least_files=least_files)
    return stats.drop("duration_seconds").orderBy("table")
