"""Catalog, queue and cache operations over plain tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import dicts


def at_least(column: Column, least: str, levels: list[str] = dicts.SEVERITIES) -> Column:
    return column.isin(*levels[levels.index(least) :])


def findings_filter(findings: DataFrame, severity: str = "low", kind: str | None = None) -> DataFrame:
    out = findings.where(at_least(F.col("severity"), severity))
    return out.where(F.col("type") == kind) if kind else out


def findings_stats(findings: DataFrame) -> DataFrame:
    """Totals by severity, by type, by confidence and over all, in one pass of grouping sets."""
    keys = ["severity", "type", "confidence"]
    g = findings.groupingSets([["severity"], ["type"], ["confidence"], []], *keys).agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    which = F.when(F.col("g") == 3, "severity").when(F.col("g") == 5, "type").when(F.col("g") == 6, "confidence").otherwise("total")
    return g.select(which.alias("by"), F.coalesce(*keys, F.lit("all")).alias("value"), "n")


def queue_position(jobs: DataFrame) -> DataFrame:
    """1 + number of jobs of the type queued strictly earlier."""
    return jobs.where("status = 'queued'").select("id", "job_type", F.rank().over(W.partitionBy("job_type").orderBy("created_at")).alias("position"))


def job_counts(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("job_type", "status").agg(F.count("*").alias("n"))


def requeue(jobs: DataFrame, most: int = 3) -> DataFrame:
    """Running jobs after a restart: failed once they had ``most`` attempts, else queued with one more."""
    running = F.col("status") == "running"
    return jobs.select(
        "id", F.when(running & (F.col("attempts") >= most), "failed").when(running, "queued").otherwise(F.col("status")).alias("status"),
        F.when(running & (F.col("attempts") < most), F.col("attempts") + 1).otherwise(F.col("attempts")).alias("attempts"),
    )


def claim(jobs: DataFrame, n: int = 1) -> DataFrame:
    """The oldest ``n`` queued jobs of each type."""
    r = F.row_number().over(W.partitionBy("job_type").orderBy("created_at", "id"))
    return jobs.where("status = 'queued'").withColumn("r", r).where(F.col("r") <= n).select("id", "job_type")


def stranded(codebases: DataFrame, jobs: DataFrame, now: Column) -> DataFrame:
    """Graphs being built past their deadline without an active job."""
    active = jobs.where("status IN ('queued', 'running')").select("codebase")
    return codebases.where((F.col("status") == "generating") & (F.col("deadline") < now)).join(active, "codebase", "left_anti").select("codebase")


def evict(servers: DataFrame, deficit: int) -> DataFrame:
    """The longest unused servers whose sizes add up to the deficit.

    The running sum is over the pool of one host, a short list.
    """
    before = F.coalesce(F.sum("size").over(W.partitionBy("host").orderBy("last_touch", "id").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return servers.withColumn("before", before).where(F.col("before") < deficit).select("host", "id", "size")


def cold(codebases: DataFrame, before: Column) -> DataFrame:
    return codebases.where((F.col("status") == "running") & (F.col("last_accessed") < before)).select("codebase")


def upsert(old: DataFrame, new: DataFrame, key: str, keep: list[str]) -> DataFrame:
    """New rows win by key; the columns ``keep`` stay as they were."""
    kept = old.select(key, *(F.col(c).alias(f"old_{c}") for c in keep))
    merged = new.join(kept, key, "left")
    merged = merged.select(key, *((F.coalesce(f"old_{c}", c).alias(c) if c in keep else F.col(c)) for c in new.columns if c != key))
    return old.join(new.select(key), key, "left_anti").select(merged.columns).unionByName(merged)


def cache_live(cache: DataFrame, now: Column, ttl_seconds: int = 300, most: int = 262_144) -> DataFrame:
    fresh = F.col("created_at") > now - F.make_dt_interval(secs=F.lit(ttl_seconds))
    return cache.where(fresh & (F.length("output") <= most))


def create_or_get(existing: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Wanted rows with whether they are new."""
    return wanted.dropDuplicates(keys).join(existing.select(*keys, F.lit(True).alias("there")), keys, "left").select(*keys, F.when(F.col("there"), "unchanged").otherwise("created").alias("outcome"))


def next_status(status: Column, action: str) -> Column:
    """State after cancel or retry; null where the action is not allowed."""
    if action == "cancel":
        return F.when(status.isin("queued", "building", "loading"), "cancelled")
    if action == "retry":
        return F.when(status.isin("failed", "cancelled"), "queued")
    raise ValueError(f"unknown action {action}")


def merged_metadata(old: Column, new: Column) -> Column:
    """Shallow merge of two maps of text; new keys win."""
    return F.map_concat(F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(new), k)), new)


def findings_top(findings: DataFrame, n: int, textual: bool = False) -> DataFrame:
    """The first ``n`` findings, most severe first; ``textual`` orders by the word instead of its rank."""
    rank = F.col("severity") if textual else F.array_position(F.array(*map(F.lit, dicts.SEVERITIES)), F.col("severity"))
    return findings.orderBy(rank.desc(), "id").limit(n)


def versions_by_owner(versions: DataFrame, projects: DataFrame, owner: str) -> DataFrame:
    """Versions of an owner's projects, newest first within each project."""
    mine = projects.where(F.col("owner") == owner).select("project")
    newest = F.row_number().over(W.partitionBy("project").orderBy(F.desc("created_at"), "version"))
    return versions.join(mine, "project").select("project", "version", newest.alias("place"))


def touched(codebases: DataFrame, asked: DataFrame, now: Column, every_seconds: int = 60) -> DataFrame:
    """Codebases with last_accessed set to now for those asked for, but only if the old time is unknown or over ``every_seconds`` ago."""
    hit = asked.select("codebase", F.lit(True).alias("asked")).distinct()
    due = F.col("last_accessed").isNull() | (F.col("last_accessed") < now - F.make_dt_interval(secs=F.lit(every_seconds)))
    return codebases.join(hit, "codebase", "left").withColumn("last_accessed", F.when(F.col("asked") & due, now).otherwise(F.col("last_accessed"))).drop("asked")


def cache_expired(cache: DataFrame, now: Column, ttl_seconds: int = 300) -> DataFrame:
    return cache.where(F.col("created_at") < now - F.make_dt_interval(secs=F.lit(ttl_seconds)))


def delete_cascade(table: DataFrame, gone: DataFrame, key: str = "codebase") -> DataFrame:
    return table.join(gone.select(key), key, "left_anti")


def save_findings(findings: DataFrame, path: str) -> None:
    """Append findings to a store of Parquet files, a folder for each codebase."""
    findings.write.mode("append").partitionBy("codebase").parquet(path)


def confidence_histogram(findings: DataFrame) -> DataFrame:
    return findings.groupBy("confidence").agg(F.count("*").alias("n"))
