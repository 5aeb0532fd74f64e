"""Incremental maintenance as Structured Streaming: late and repeated records, running maxima, dates that change."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.names import solar_time
from ..operators.progress import FINAL
from ..sources.tables import stored


def register_scenes(records: DataFrame, delay: str = "3 days") -> DataFrame:
    """The first record of each scene id; repeats within the delay are dropped, and state older than it is forgotten."""
    return records.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["scene_id"])


def daily_max(scene_bins: DataFrame, delay: str = "3 days") -> DataFrame:
    """Running largest scene mean and number of scenes per lake, bin and solar day. scene_bins: start, lon, hylak_id, bin, ci_cyano_mean; one row per scene and bin."""
    s = scene_bins.withColumn("solar", solar_time(F.col("start"), F.col("lon")).cast("timestamp")).withWatermark("solar", delay)
    return s.groupBy(F.window("solar", "1 day").alias("day"), "hylak_id", "bin").agg(F.max("ci_cyano_mean").alias("ci_cyano"), F.count("ci_cyano_mean").alias("scenes_valid"))


def status_counts(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Status events of each hour."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay).groupBy(F.window("ts", "1 hour").alias("w"), "status").agg(F.count("*").alias("n")).select(F.col("w.start").alias("hour"), "status", "n")


def maintain(events: DataFrame, checkpoint: str, touched: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Calls touched(batch of the latest status per scene, batch id) for what has arrived; a batch that is run again must give the same result."""

    def each(batch: DataFrame, number: int) -> None:
        latest = batch.groupBy("scene_id").agg(F.max_by(F.struct("status", "ts"), "event_id").alias("s"), F.max("event_id").alias("event_id")).select("scene_id", "event_id", "s.*")
        touched(latest, number)

    return events.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: What a key of the readiness stream keeps, and what it sends when something arrives.
KEPT = "scenes string, last_id long, last string, last_signature string"
READINESS = "state_id int, day date, state string, scenes long, open long, done long, signature string"


def _ready(key, batches, kept):
    """The readiness of one (state_id, day) from its latest outcomes and its newest merge, after what has arrived."""
    text, last_id, last, last_signature = kept.get if kept.exists else ("{}", -1, "", None)
    known = json.loads(text)
    for batch in batches:
        for e in batch.itertuples():
            if e.kind == "merge":
                if e.event_id > last_id:
                    last_id, last, last_signature = int(e.event_id), e.status, e.signature
            elif e.event_id > known.get(str(e.scene_id), (-1,))[0]:
                known[str(e.scene_id)] = (int(e.event_id), FINAL.get(e.status, "open"))
    kept.update((json.dumps(known), last_id, last, last_signature))
    outcomes = [o for _, o in known.values()]
    waiting, done = outcomes.count("open"), outcomes.count("done")
    text = "|".join(sorted(f"{s}={o}" for s, (_, o) in known.items()))
    signature = hashlib.sha256(text.encode()).hexdigest()[:16] if known else None
    same = signature is not None and signature == last_signature
    if last == "merging" or not known:
        state = last if last == "merging" else "no scenes"
    elif waiting:
        state = "waiting"
    elif same and last in ("merged", "failed", "interrupted"):
        state = "merged" if last == "merged" else "failed"
    else:
        state = "nothing to merge" if not done else "changed" if last == "merged" else "ready"
    yield pd.DataFrame({"state_id": [key[0]], "day": [key[1]], "state": [state], "scenes": [len(known)], "open": [waiting], "done": [done], "signature": [signature]})


def readiness(events: DataFrame) -> DataFrame:
    """A row of readiness for every (state_id, day) that events touch, in update mode; others are neither read nor computed.

    events: kind ('status' or 'merge'), state_id, day, scene_id, event_id, status, signature. A
    scene's status counts for the day before its own to the day after; a merge for its own. State is kept
    by (state_id, day): the latest outcome of its scenes and its newest merge. Of events that
    arrive late or twice, those with an older event_id change nothing.
    """
    around = F.when(F.col("kind") == "merge", F.array("day")).otherwise(F.array(F.date_sub("day", 1), F.col("day"), F.date_add("day", 1)))
    near = events.withColumn("day", F.explode(around)).select("kind", "state_id", "day", "scene_id", "event_id", "status", "signature")
    return near.groupBy("state_id", "day").applyInPandasWithState(_ready, READINESS, KEPT, "update", "NoTimeout")


def remerge_stream(events: DataFrame, folder: str, merge: Callable[[DataFrame], DataFrame], publish: Callable[[DataFrame, DataFrame], object]) -> StreamingQuery:
    """Merges dates as soon as they are ready, and again when a late or changed scene gives them another signature.

    The readiness of what arrives starts the merge: dates that are ready or changed go to
    merge(dates: state_id, day, signature), whose rows go to publish(rows, dates). What was
    merged is written below folder/runs, one folder a batch, for the stream to read as
    merge events; a batch that is run again gives the same rows and runs.
    """

    def each(batch: DataFrame, number: int) -> None:
        due = stored(batch.filter(F.col("state").isin("ready", "changed")).select("state_id", "day", "signature"))
        if due.isEmpty():
            return
        publish(merge(due), due)
        done = due.select(F.lit("merge").alias("kind"), "state_id", "day", F.lit(0).cast("long").alias("scene_id"), F.lit(number).cast("long").alias("event_id"), F.lit("merged").alias("status"), "signature")
        done.write.mode("overwrite").parquet(f"{folder}/runs/batch={number}")

    return readiness(events).writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()


#: Columns of the events of readiness and remerge_stream, as files hold them.
EVENTS = "kind string, state_id int, day date, scene_id long, event_id long, status string, signature string"


def status_and_merges(spark: SparkSession, statuses: str, folder: str) -> DataFrame:
    """The events of remerge_stream: statuses that land below statuses, and the runs that it writes itself below folder."""
    read = lambda at: spark.readStream.schema(EVENTS).parquet(at)
    return read(statuses).unionByName(read(f"{folder}/runs/*"))


def remerge(changed: DataFrame, master: DataFrame, merge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The batch form: master with every date of changed (date_solar) whose signature differs from the merged one (merged) merged again, whole, so that a reprocessed scene can lower a value too."""
    from ..sources.tables import replace_date

    dates = changed.filter(~F.col("signature").eqNullSafe(F.col("merged"))).select("date_solar").distinct()
    return replace_date(master, merge(dates))
