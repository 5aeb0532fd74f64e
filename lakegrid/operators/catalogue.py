"""Catalogue, planning and completeness: scenes, their versions, and which lakes and dates they serve."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import solar_date, timeliness_rank
from .polygons import containing, meeting

DONE, WAITING = ("done", "skipped_no_lakes"), ("queued", "running", "retry", "publishing")


def catalogue_records(pages: DataFrame) -> DataFrame:
    """Scene rows of landed catalogue pages (column value: array of records): name without its suffix, satellite from the name, size 0 and online by default."""
    r = pages.select(F.explode("value").alias("r"))
    name = F.regexp_replace("r.Name", r"\.SEN3$", "")
    return r.select(F.col("r.Id").alias("scene_id"), name.alias("name"), F.substring(name, 1, 3).alias("satellite"), F.to_timestamp("r.ContentDate.Start").alias("start"), F.to_timestamp("r.ContentDate.End").alias("end"), F.coalesce("r.ContentLength", F.lit(0)).alias("size_bytes"), F.coalesce("r.Online", F.lit(True)).alias("online"), F.col("r.GeoFootprint").alias("footprint"))


def filter_catalogue(scenes: DataFrame, start, end, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Scenes from the first day to the end of the last whose box meets the given one, by start."""
    out = scenes.filter((F.col("start") >= start) & (F.col("start") < F.date_add(F.lit(end), 1)))
    if box:
        w, s, e, n = box
        out = out.filter((F.col("xmin") <= e) & (F.col("xmax") >= w) & (F.col("ymin") <= n) & (F.col("ymax") >= s))
    return out.orderBy("start", "scene_id")


def first_scenes(scenes: DataFrame, n: int) -> DataFrame:
    """The first n by start and id, before any other filter; 0 for all."""
    return scenes.orderBy("start", "scene_id").limit(n) if n else scenes


def register_scenes(listed: DataFrame) -> DataFrame:
    """One row per scene id over all plans: the record of its first plan."""
    w = Window.partitionBy("scene_id").orderBy("plan_created", "plan_id")
    return listed.withColumn("nth", F.row_number().over(w)).filter("nth = 1").drop("nth")


def rank_versions(versions: DataFrame, *acquisition: str) -> DataFrame:
    """Preference 1, 2, ... among an acquisition's versions: timeliness NT, ST, NR, others, then newest created, then id."""
    w = Window.partitionBy(*acquisition).orderBy(timeliness_rank(F.col("timeliness")), F.desc("created"), "scene_id")
    return versions.withColumn("preference", F.row_number().over(w))


def acquisition_status(versions: DataFrame, *acquisition: str) -> DataFrame:
    """done if any version is, else waiting if any is waiting or unknown, else failed; and the scene used, the best of the done ones."""
    done, wait = F.col("status").isin(*DONE), F.coalesce(F.col("status").isin(*WAITING), F.lit(True))
    ranked = rank_versions(versions, *acquisition)
    g = ranked.groupBy(*acquisition).agg(F.bool_or(F.coalesce(done, F.lit(False))).alias("any_done"), F.bool_or(wait).alias("any_wait"), F.min_by("scene_id", F.when(done, F.col("preference"))).alias("used"), F.min_by("scene_id", "preference").alias("first"), F.count("*").alias("versions"))
    state = F.when(F.col("any_done"), "done").when(F.col("any_wait"), "waiting").otherwise("failed")
    return g.select(*acquisition, state.alias("status"), F.when(F.col("any_done"), F.col("used")).alias("used"), "first", "versions")


def lakes_in_mask(lakes: DataFrame, lake_edges: DataFrame, mask_edges: DataFrame | None = None) -> DataFrame:
    """Lakes that touch a mask (edges of its polygons, key mask_id); all of them without one (the world)."""
    return lakes if mask_edges is None else lakes.join(meeting(lake_edges, mask_edges, "hylak_id", "mask_id"), "hylak_id", "left_semi")


def state_scope(lakes: DataFrame, touching: DataFrame, state_id: int) -> DataFrame:
    """Lakes that touch one state; none is an error. touching (hylak_id, state_id)."""
    out = lakes.join(touching.filter(F.col("state_id") == state_id), "hylak_id", "left_semi")
    if out.isEmpty():
        raise ValueError(f"no lake touches state {state_id}")
    return out


def plan_scenes(touching: DataFrame, pairs: DataFrame, in_region: DataFrame | None = None) -> DataFrame:
    """(state_id, scene_no, candidate_lakes) to process for each region: scenes that touch any lake that touches it, and how many of these.

    touching (hylak_id, state_id) and pairs (scene_no, hylak_id) come from polygons that meet. With
    in_region (scene_no, state_id) the rule is ``state``: scenes must touch the region too.
    """
    out = touching.join(pairs, "hylak_id")
    if in_region is not None:
        out = out.join(in_region, ["scene_no", "state_id"], "left_semi")
    return out.groupBy("state_id", "scene_no").agg(F.countDistinct("hylak_id").alias("candidate_lakes"))


def scene_regions(assigned: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per scene the sorted states that all lakes it hits are assigned to (none: empty), and how many lakes."""
    own = pairs.join(assigned.select("hylak_id", F.coalesce(F.col("state_id").cast("string"), F.lit("")).alias("state")), "hylak_id")
    return own.groupBy("scene_no").agg(F.array_join(F.array_sort(F.collect_set("state")), ";").alias("states"), F.countDistinct("hylak_id").alias("n_lakes"))


def assign_state(lakes: DataFrame, region_edges: DataFrame) -> DataFrame:
    """The state whose polygon holds a lake's pour point (cx, cy): matched, unmatched (none, or no place on Earth) or ambiguous (several, left blank)."""
    points = lakes.filter(F.col("cx").between(-180, 180) & F.col("cy").between(-90, 90)).select("hylak_id", "cx", "cy")
    hits = containing(points, region_edges, "state_id", "cx", "cy").groupBy("hylak_id").agg(F.count("*").alias("n"), F.min("state_id").alias("state_id"))
    return lakes.select("hylak_id").join(hits, "hylak_id", "left").select("hylak_id", F.when(F.col("n") == 1, F.col("state_id")).alias("state_id"), F.when(F.col("n") == 1, "matched").when(F.col("n") > 1, "ambiguous").otherwise("unmatched").alias("match_status"))


def touching_states(lakes: DataFrame, touching: DataFrame, regions: DataFrame) -> DataFrame:
    """Sorted names and ids of the states a lake touches, joined by '; '; empty for none. touching (hylak_id, state_id)."""
    named = touching.join(regions.select("state_id", "state_name"), "state_id")
    joined = named.groupBy("hylak_id").agg(F.array_join(F.array_sort(F.collect_set("state_name")), "; ").alias("states"), F.array_join(F.array_sort(F.collect_set("state_id")).cast("array<string>"), "; ").alias("state_ids"))
    return lakes.select("hylak_id").join(joined, "hylak_id", "left").na.fill("", ["states", "state_ids"])


def lake_owner(pairs: DataFrame, plan_scenes_: DataFrame, touching: DataFrame, matched: DataFrame, scene_home: DataFrame) -> DataFrame:
    """The region a lake is filed under, and why: the earliest plan that lists one of its scenes and whose state it touches, else its pour point's state if matched, else the home state of its earliest scene.

    pairs (hylak_id, scene_id); plan_scenes_ (plan_id, created, state_id, scene_id); touching (hylak_id, state_id); matched (hylak_id, state_id); scene_home (scene_id, created, state_id).
    """
    first = pairs.join(plan_scenes_, "scene_id").join(touching, ["hylak_id", "state_id"], "left_semi").groupBy("hylak_id").agg(F.min(F.struct("created", "plan_id", "state_id")).alias("a"))
    home = pairs.join(scene_home, "scene_id").groupBy("hylak_id").agg(F.min(F.struct("created", "scene_id", "state_id")).alias("c"))
    all_ = pairs.select("hylak_id").distinct().join(first, "hylak_id", "left").join(matched.select("hylak_id", F.col("state_id").alias("b")), "hylak_id", "left").join(home, "hylak_id", "left")
    basis = F.when(F.col("a").isNotNull(), "plan").when(F.col("b").isNotNull(), "pour point").otherwise("first scene")
    return all_.select("hylak_id", F.coalesce("a.state_id", "b", "c.state_id").alias("state_id"), basis.alias("basis"))


def checklist(cover: DataFrame, day: Column | None = None) -> DataFrame:
    """(hylak_id, date_solar, acquisition...) of the acquisitions that touch a lake, by the solar date at the lake. cover: hylak_id, lon, start and the acquisition's columns."""
    out = cover.withColumn("date_solar", solar_date(F.col("start"), F.col("lon")))
    return out if day is None else out.filter(F.col("date_solar") == day)


def lake_day_status(items: DataFrame) -> DataFrame:
    """Per lake and date: waiting if an acquisition is, unavailable if none was used, partial if one failed or lacks bins, else complete; with the scenes as sorted texts.

    items: hylak_id, date_solar, status, used, name, satellite, utc_date, has_bins (false: the used scene's bins are missing).
    """
    ok = F.col("status") == "done"
    bad = (F.col("status") == "failed") | (ok & ~F.coalesce("has_bins", F.lit(True)))
    text = lambda c, keep: F.array_join(F.array_sort(F.collect_set(F.when(keep, F.col(c).cast("string")))), ";")
    g = items.groupBy("hylak_id", "date_solar").agg(F.bool_or(F.col("status") == "waiting").alias("w"), F.count_if(ok).alias("scenes_used"), F.bool_or(bad).alias("f"), text("used", ok).alias("scene_ids"), text("satellite", ok).alias("satellites"), text("name", bad).alias("failed_scenes"), text("name", F.col("status") == "waiting").alias("missing_scenes"), F.coalesce(F.bool_and(F.when(ok, F.col("utc_date") == F.col("date_solar"))), F.lit(False)).alias("same_day"))
    status = F.when(F.col("w"), "waiting").when(F.col("scenes_used") == 0, "unavailable").when(F.col("f"), "partial").otherwise("complete")
    return g.select("hylak_id", "date_solar", status.alias("day_status"), "scenes_used", "scene_ids", "satellites", "failed_scenes", "missing_scenes", (F.col("same_day") & status.isin("partial", "complete")).alias("nasa_eligible"))


def missing_scenes(items: DataFrame) -> DataFrame:
    """Acquisitions that hold lakes back, with their state or 'not planned', and how many lakes."""
    return items.filter("status = 'waiting'").groupBy("acq").agg(F.min(F.coalesce("ledger_status", F.lit("not planned"))).alias("ledger_status"), F.countDistinct("hylak_id").alias("lakes"))


def capped_plan_warning(plans: DataFrame, plan_scenes_: DataFrame, used: DataFrame) -> DataFrame:
    """Plans made with a cap on scenes that list any of the used scenes."""
    return plans.filter("max_scenes > 0").join(plan_scenes_.join(used, "scene_id", "left_semi"), "plan_id", "left_semi")
