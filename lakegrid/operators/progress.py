"""Progress of operations: latest status per scene, dates ready to merge, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import signature

FINAL = {"done": "done", "skipped_no_lakes": "skipped", "failed": "failed"}


def latest_status(events: DataFrame) -> DataFrame:
    """The last status of each scene, by event order."""
    return events.groupBy("scene_id").agg(F.max_by("status", "event_id").alias("status"), F.max("ts").alias("ts"))


def status_counts(latest: DataFrame) -> DataFrame:
    return latest.groupBy("status").agg(F.count("*").alias("n"))


def coverage_by_region(links: DataFrame, latest: DataFrame) -> DataFrame:
    """Distinct scenes discovered, processed and failed per region."""
    d = links.join(latest, "scene_id", "left")
    n = lambda c, name: F.countDistinct(F.when(c, F.col("scene_id"))).alias(name)
    return d.groupBy("state_id").agg(F.countDistinct("scene_id").alias("discovered"), n(F.col("status").isin("done", "skipped_no_lakes"), "processed"), n(F.col("status") == "failed", "failed"))


def plan_overview(plan_scenes: DataFrame, latest: DataFrame) -> DataFrame:
    """Scenes of each plan by status; publishing counts as running."""
    d = plan_scenes.join(latest, "scene_id", "left")
    n = lambda *s: F.count_if(F.col("status").isin(*s)).alias(s[0])
    return d.groupBy("plan_id").agg(F.count("*").alias("scenes"), n("done"), n("failed"), n("queued"), n("retry"), n("running", "publishing"), F.count_if(F.col("status").isNull()).alias("unregistered"))


def latest_merge(runs: DataFrame) -> DataFrame:
    """The newest merge of each state and date."""
    return runs.groupBy("state_id", "day").agg(F.max_by(F.struct("id", "state", "signature"), "id").alias("r")).select("state_id", "day", "r.*")


def recent_merges(runs: DataFrame, n: int = 10) -> DataFrame:
    return runs.orderBy(F.desc("id")).limit(n)


def scene_history(events: DataFrame) -> DataFrame:
    """Each scene's events in order, as one array."""
    return events.groupBy("scene_id").agg(F.array_sort(F.collect_list(F.struct("event_id", "ts", "status"))).alias("history"))


def list_scenes(latest: DataFrame, status: str) -> DataFrame:
    return latest.filter(F.col("status") == status).orderBy("ts", "scene_id")


def scenes_without_plan(latest: DataFrame, plan_scenes: DataFrame) -> DataFrame:
    return latest.join(plan_scenes, "scene_id", "left_anti")


def state_scenes(plan_scenes: DataFrame, touching: DataFrame) -> DataFrame:
    """(state_id, scene_id) of the state's plans and of scenes that touch it."""
    return plan_scenes.select("state_id", "scene_id").union(touching.select("state_id", "scene_id")).distinct()


def date_readiness(scenes: DataFrame, days: DataFrame, runs: DataFrame) -> DataFrame:
    """State of each (state_id, day) of the plans: from the outcomes of scenes that start (UTC) the day before to the day after, and the newest merge.

    scenes (state_id, scene_id, status, day); days (state_id, day); runs as latest_merge gives.
    """
    outcome = F.when(F.col("status") == "done", "done").when(F.col("status") == "skipped_no_lakes", "skipped").when(F.col("status") == "failed", "failed").otherwise("open")
    near = scenes.filter("day is not null").withColumn("outcome", outcome).withColumn("day", F.explode(F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda k: F.date_add("day", k))))
    g = near.groupBy("state_id", "day").agg(F.count("*").alias("scenes"), F.count_if(F.col("outcome") == "open").alias("open"), F.count_if(F.col("outcome") == "done").alias("done"), signature("scene_id", "outcome").alias("signature"))
    d = days.join(g, ["state_id", "day"], "left").join(latest_merge(runs).select("state_id", "day", F.col("state").alias("last"), F.col("signature").alias("last_signature")), ["state_id", "day"], "left").na.fill(0, ["scenes", "open", "done"])
    same = F.coalesce(F.col("signature") == F.col("last_signature"), F.lit(False))
    last = F.coalesce("last", F.lit(""))
    state = F.when(last == "merging", "merging").when(F.col("scenes") == 0, "no scenes").when(F.col("open") > 0, "waiting").when(same & (last == "merged"), "merged").when(same & last.isin("failed", "interrupted"), "failed").when(F.col("done") == 0, "nothing to merge").when(last == "merged", "changed").otherwise("ready")
    return d.select("state_id", "day", state.alias("state"), "scenes", "open", "done", "signature")


STATES = ("no scenes", "waiting", "merged", "failed", "nothing to merge", "changed", "ready", "merging")


def date_tally(readiness: DataFrame) -> DataFrame:
    """Dates of each state by readiness."""
    return readiness.groupBy("state_id").agg(*(F.count_if(F.col("state") == s).alias(s.replace(" ", "_")) for s in STATES))


def progress_report(readiness: DataFrame) -> DataFrame:
    """Dates of each state as sorted lists by readiness."""
    days = lambda s: F.array_join(F.array_sort(F.collect_set(F.when(F.col("state") == s, F.col("day").cast("string")))), ";").alias(s.replace(" ", "_"))
    return readiness.groupBy("state_id").agg(*(days(s) for s in ("waiting", "ready", "changed", "failed", "merged")))


def missing_hint(items: DataFrame) -> DataFrame:
    """First and last sensing day that a state still waits for."""
    return items.filter("status = 'waiting'").groupBy("state_id").agg(F.min("day").alias("first_missing"), F.max("day").alias("last_missing"), F.count("*").alias("missing"))


def run_counts(status: DataFrame) -> DataFrame:
    """Lakes of each merge by status, and how many missing scenes are planned or not."""
    n = lambda s: F.count_if(F.col("day_status") == s).alias(s)
    return status.groupBy("date_solar").agg(*(n(s) for s in ("complete", "partial", "waiting", "unavailable")), F.sum(F.when(F.col("missing_scenes") == "", 0).otherwise(F.size(F.split("missing_scenes", ";")))).cast("long").alias("missing_scenes"))


def attention_report(overview: DataFrame, latest: DataFrame, plan_scenes: DataFrame) -> DataFrame:
    """Rules that ask for a look: plans whose scenes all failed, plans with unregistered scenes, open scenes in no plan. One row (rule, subject, n) each."""
    emptied = overview.filter("scenes > 0 and failed = scenes").select(F.lit("all scenes failed").alias("rule"), F.col("plan_id").cast("string").alias("subject"), F.col("scenes").alias("n"))
    unknown = overview.filter("unregistered > 0").select(F.lit("unregistered scenes").alias("rule"), F.col("plan_id").cast("string").alias("subject"), F.col("unregistered").alias("n"))
    loose = scenes_without_plan(latest.filter("status in ('queued', 'running', 'retry')"), plan_scenes).groupBy("status").agg(F.count("*").alias("n")).select(F.lit("open without plan").alias("rule"), F.col("status").alias("subject"), "n")
    return emptied.union(unknown).union(loose)
