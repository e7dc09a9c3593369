"""Progress, timing and admission: aggregates and windows over records of workers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Seconds after which a worker counts as stale, hours after which a record is old, smoothing of the time left.
STALE_SECONDS, OLD_HOURS, SMOOTHING, HISTORY = 1800, 96, 0.3, 10
MIB = 1024 * 1024


def is_completed(status: Column, done: Column, assigned: Column, percent: Column) -> Column:
    return F.coalesce(status == "completed", F.lit(False)) | F.coalesce((assigned > 0) & (done >= assigned), F.lit(False)) | F.coalesce(percent >= 100, F.lit(False))


def latest(events: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The last state of each worker: max_by keeps one row a key in each task before the shuffle."""
    best = F.max_by(F.struct(*columns), F.struct(*order)).alias("last")
    return events.groupBy(key).agg(best).select(key, "last.*")


def aggregated(records: DataFrame, elapsed: float | None = None, total: int | None = None) -> DataFrame:
    """One row over worker records: sums, percent, throughput, seconds left, active workers."""
    done = is_completed(F.col("status"), F.col("completed_sources"), F.col("total_sources"), F.col("progress_percent"))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    sums = records.agg(
        F.lit(total).cast("long").alias("given") if total else zero("total_sources").alias("given"), zero("completed_sources").alias("completed_sources"), zero("failed_sources").alias("failed_sources"),
        F.count_if(~done).alias("active_processes"), zero("errors").alias("errors"), zero("warnings").alias("warnings"), F.coalesce(F.sum("memory_footprint_mb"), F.lit(0.0)).alias("memory_mb"),
    )
    rate = F.col("completed_sources") / F.lit(elapsed) if elapsed else F.lit(0.0)
    left = F.col("given") - F.col("completed_sources") - F.col("failed_sources")
    return sums.select(
        F.col("given").alias("total_sources"), "completed_sources", "failed_sources", F.when(F.col("given") > 0, F.col("completed_sources") * 100.0 / F.col("given")).otherwise(0.0).alias("progress_percent"),
        rate.alias("throughput"), F.when(rate > 0, F.greatest(left, F.lit(0)) / rate).alias("eta_seconds"), "active_processes", "errors", "warnings", "memory_mb",
    )


def completion(records: DataFrame) -> DataFrame:
    done = is_completed(F.col("status"), F.col("completed_sources"), F.col("total_sources"), F.col("progress_percent"))
    out = records.agg(F.count(F.lit(1)).alias("total_processes"), F.count_if(done).alias("completed_processes"), F.coalesce(F.sum("total_sources"), F.lit(0)).alias("total_sources"), F.coalesce(F.sum("completed_sources"), F.lit(0)).alias("completed_sources"))
    return out.withColumn("completion_percent", F.when(F.col("total_processes") > 0, F.col("completed_processes") * 100.0 / F.col("total_processes")).otherwise(0.0)).withColumn("is_fully_completed", (F.col("total_processes") > 0) & (F.col("completed_processes") == F.col("total_processes")))


def stale(records: DataFrame, now: Column, seconds: int = STALE_SECONDS) -> DataFrame:
    return records.where(now - F.col("last_update") > seconds)


def fresh(records: DataFrame, now: Column, hours: int = OLD_HOURS) -> DataFrame:
    """Records that are not old yet."""
    return records.where(now - F.col("last_update") <= hours * 3600)


def step_statistics(steps: DataFrame) -> DataFrame:
    """step, n, total, mean, least, greatest, share of all time in percent. steps: step, seconds."""
    by = steps.groupBy("step").agg(F.count(F.lit(1)).alias("n"), F.sum("seconds").alias("total"), F.avg("seconds").alias("mean"), F.min("seconds").alias("least"), F.max("seconds").alias("greatest"))
    return by.withColumn("percent", F.coalesce(F.col("total") * 100.0 / F.sum("total").over(Window.partitionBy()), F.lit(0.0)))  # a row a step


def bottlenecks(statistics: DataFrame, percent: float = 20.0) -> DataFrame:
    return statistics.where(F.col("percent") >= percent)


def peak(samples: DataFrame, key: str, second: str, value: str, window: int = 30) -> DataFrame:
    """samples with the greatest value of the worker's last `window` seconds."""
    return samples.withColumn("peak", F.max(value).over(Window.partitionBy(key).orderBy(second).rangeBetween(-window, 0)))


def moving(samples: DataFrame, key: str, order: Sequence[str], value: str, rows: int = 10) -> DataFrame:
    """samples with the mean of the worker's last `rows` values."""
    return samples.withColumn("moving_mean", F.avg(value).over(Window.partitionBy(key).orderBy(*order).rowsBetween(1 - rows, 0)))


def above_baseline(samples: DataFrame, key: str, order: Sequence[str], value: str, rows: int = 5) -> DataFrame:
    """samples with the greatest of the last `rows` values, less the first value of all."""
    by = Window.partitionBy(key).orderBy(*order)
    return samples.withColumn("above", F.max(value).over(by.rowsBetween(1 - rows, 0)) - F.first(value).over(by.rowsBetween(Window.unboundedPreceding, 0)))


def smoothed(samples: DataFrame, key: str, order: Sequence[str], value: str, alpha: float = SMOOTHING) -> DataFrame:
    """Each worker's samples with the exponentially smoothed value; the first is taken as it is.

    The recurrence is a fold over a worker's samples, of which a job has one for each finished batch.
    """
    row = F.sort_array(F.collect_list(F.struct(*order, F.col(value).alias("v"))))
    step = lambda acc, x: F.concat(acc, F.array(F.when(F.size(acc) == 0, x["v"]).otherwise(F.lit(alpha) * x["v"] + F.lit(1 - alpha) * F.get(acc, F.size(acc) - 1))))
    folded = samples.groupBy(key).agg(row.alias("s")).withColumn("e", F.aggregate("s", F.array().cast("array<double>"), step))
    return folded.select(key, F.explode(F.arrays_zip("s", "e")).alias("z")).select(key, *[F.col(f"z.s.{c}").alias(c) for c in order], F.col("z.s.v").alias(value), F.col("z.e").alias("smoothed"))


def raw_eta(done: Column, total: Column, elapsed: Column) -> Column:
    """Seconds left at the mean rate so far; null before the first batch."""
    return F.when((done > 0) & (elapsed > 0), (total - done) / (done / elapsed))


def remaining_memory(total_mb: Column, main_mb: Column, margin: Column | float, peak_mb: Column, active: Column) -> Column:
    """Megabytes left for workers, 0 at least: total less 1.2 of the driver's, the margin, and the peak of each active worker."""
    share = margin if isinstance(margin, Column) else F.lit(margin)
    return F.greatest(F.lit(0.0), total_mb - main_mb * 1.2 - total_mb * share - F.coalesce(peak_mb, F.lit(0.0)) * active)


def spawn_decision(active: Column, cpu_limit: Column, initial: Column, calibrated: Column, left_mb: Column, peak_mb: Column, cpu_percent: Column) -> Column:
    """Why a worker may start, or what it waits for."""
    return (
        F.when(active >= cpu_limit, "cpu_limit").when(active < initial, "initial").when(~calibrated | peak_mb.isNull(), "calibration")
        .when(left_mb < peak_mb, "memory").when(cpu_percent > 90, "cpu_busy").otherwise("spawn")
    )


def batch_size(total: Column, configured: Column) -> Column:
    return F.when(configured > 0, configured).when(total < 1_000_000, 12_500).otherwise(100_000)


def workers(max_workers: Column, cpus: Column) -> Column:
    return F.least(max_workers, cpus - 1)


def worker_memory(batch: Column, resolution: Column, channels: Column, file_mb: Column) -> Column:
    """Megabytes that a worker is expected to take."""
    return batch * resolution * resolution * channels * 4 * 2.5 / MIB + F.coalesce(file_mb, F.lit(500.0))


def output_gib(sources: Column, channels: Column, resolution: Column, data_type: Column) -> Column:
    return sources.cast("double") * channels * resolution * resolution * F.when(data_type == "float32", 4).otherwise(1) / float(1 << 30)


def clock(seconds: Column) -> Column:
    """HH:MM:SS, or -- where there is no time."""
    s = F.floor(seconds).cast("long")
    text = F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60)))
    return F.when(seconds.isNull() | (seconds < 0), "--").otherwise(text)


def scaling(runs: DataFrame) -> DataFrame:
    """runs (workers, seconds) with speed-up and efficiency against the run of fewest workers of 1, if there is one."""
    one = runs.where("workers = 1").agg(F.min("seconds").alias("one"))
    return runs.crossJoin(one).select("workers", "seconds", (F.col("one") / F.col("seconds")).alias("speedup"), (F.col("one") / F.col("seconds") / F.col("workers")).alias("efficiency"))


def tool_summary(runs: DataFrame) -> DataFrame:
    """runs (scenario, tool, sources, seconds) with sources a second and the speed-up against the scenario's slowest tool."""
    return runs.withColumn("rate", F.col("sources") / F.col("seconds")).withColumn("speedup", F.max("seconds").over(Window.partitionBy("scenario")) / F.col("seconds"))
