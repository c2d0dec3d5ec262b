"""Job-log analytics: the log as data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .latest import n_latest
from .scans import before


def queue_composition(jobs: DataFrame) -> DataFrame:
    """Pending and running jobs per kind."""
    count = lambda s: F.count_if(F.col("status") == s).alias(s)
    return jobs.groupBy("kind").agg(count("pending"), count("running"), F.count("*").alias("total"))


def throughput(jobs: DataFrame, now: Column, minutes: tuple[int, ...] = (5, 15, 60)) -> DataFrame:
    """Jobs finished in the last minutes by outcome, jobs a minute, and the minutes that the pending ones will take, in one pass."""
    age = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("finished_at").cast("timestamp"))) / 6e7
    cols = [F.count_if((F.col("status") == s) & (age >= 0) & (age <= m)).alias(f"{s}_{m}") for m in minutes for s in ("done", "failed")]
    out = jobs.agg(F.count_if(F.col("status") == "pending").alias("pending"), *cols)
    m = minutes[-1]
    rate = (F.col(f"done_{m}") + F.col(f"failed_{m}")) / float(m)
    return out.withColumn("per_minute", F.round(rate, 4)).withColumn("eta_minutes", F.round(F.try_divide(F.col("pending").cast("double"), rate), 2))


def oldest_pending_age(jobs: DataFrame, now: Column) -> DataFrame:
    oldest = F.min(F.when(F.col("status") == "pending", F.unix_micros(F.col("created_at").cast("timestamp"))))
    return jobs.agg(((F.unix_micros(now.cast("timestamp")) - oldest) / 1e6).alias("age_sec"))


def slot_adherence(fires: DataFrame, jobs: DataFrame, now: Column, grace_minutes: int, bucket_seconds: int = 3600) -> DataFrame:
    """State of each slot fire (rows slot, kind, fire): jobs of its kind in [fire, min(now, fire + grace + 2 h)) make it on_plan; without
    any it is due within the grace and missed after it. A fire that is given several times is one row, which counts its jobs as often.

    Jobs and both ends of each window lie on one time line of the kind, cut into buckets of time; a fire's jobs are the difference of two running
    counts, so no job meets a fire, however many share a window."""
    micros, minute = lambda c: F.unix_micros(c.cast("timestamp")), 60_000_000
    f = fires.groupBy("slot", "kind", "fire").agg(F.count("*").alias("copies")).withColumns({"t": micros(F.col("fire")), "now": micros(now)})
    until = F.least("now", F.col("t") + (grace_minutes + 120) * minute)
    ends = F.array(F.struct(F.col("t").alias("at"), F.lit(-1).alias("sign")), F.struct(until.alias("at"), F.lit(1).alias("sign")))
    line = jobs.select("kind", micros(F.col("created_at")).alias("at"), F.lit(1).alias("job"))
    line = line.unionByName(f.where(F.col("t") < until).select("slot", "kind", "fire", F.explode(ends).alias("e")).select("slot", "kind", "fire", "e.*", F.lit(0).alias("job")), allowMissingColumns=True)
    line = line.withColumn("block", F.floor(F.col("at") / (bucket_seconds * 1_000_000)))
    early = before(line.groupBy("kind", "block").agg(F.sum("job").alias("job")), ["kind"], {"job": "sum"}).withColumnRenamed("job", "early")
    w = Window.partitionBy("kind", "block").orderBy("at", "job").rowsBetween(Window.unboundedPreceding, 0)  # an end comes before the jobs of its time
    counted = line.withColumn("jobs", F.sum("job").over(w)).where("sign is not null").join(early, ["kind", "block"])
    counted = counted.select("slot", "kind", "fire", F.lit(0).cast("long").alias("copies"), (F.col("sign") * (F.col("jobs") + F.coalesce("early", F.lit(0)))).alias("jobs"))
    n = f.select("slot", "kind", "fire", "copies", F.lit(0).cast("long").alias("jobs")).unionByName(counted).groupBy("slot", "kind", "fire").agg((F.sum("copies") * F.sum("jobs")).alias("jobs"))
    state = F.when(F.col("jobs") > 0, "on_plan").when(micros(now) < micros(F.col("fire")) + grace_minutes * minute, "due").otherwise("missed")
    return n.select("slot", "kind", "fire", "jobs", state.alias("state"))


def job_list(jobs: DataFrame, status: str, limit: int) -> DataFrame:
    """Newest jobs of a status per kind."""
    return n_latest(jobs.where(F.col("status") == status), ["kind"], [F.desc("created_at"), F.desc("id")], limit)
