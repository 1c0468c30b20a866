"""Latest rows as of a time, and the point-in-time join of labels with feature history."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import snapshot_id
from tidemark.operators.sizing import restrict_to_ids
from tidemark.schemas import FEATURES, VERSION
from tidemark.sources.tables import scan_history

SLOT_DAYS = 30


def latest_asof(history: DataFrame, as_of: datetime, version: str = VERSION) -> DataFrame:
    """The newest row of each entity not later than `as_of`.

    Spark keeps one row per entity and task before the shuffle (WindowGroupLimit), so long
    histories of single entities do not pile up in one task.
    """
    known = scan_history(history, version, until=as_of)
    newest = Window.partitionBy("entity_id").orderBy(F.desc("event_time"))
    return known.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") == 1).drop("_rank")


def latest_for_ids(history: DataFrame, ids: DataFrame, as_of: datetime, version: str = VERSION) -> DataFrame:
    """`latest_asof` for the ids of a one-column frame `entity_id`; unknown ids give no row."""
    wanted = ids.select(F.col(ids.columns[0]).alias("entity_id"))
    (found,) = restrict_to_ids(wanted, "entity_id", history)
    newest = latest_asof(found, as_of, version).select("entity_id", *FEATURES)
    return newest.join(wanted, "entity_id", "left_semi")


def _slot(time: str, days: int) -> Column:
    return F.expr(f"unix_date(to_date({time})) div {days}").alias("_slot")


def pit_join(
    labels: DataFrame,
    history: DataFrame,
    version: str = VERSION,
    columns: list[str] | None = None,
    slot_days: int = SLOT_DAYS,
) -> DataFrame:
    """Each label row with the newest history row of its entity not later than `label_time`.

    Labels without an earlier history row are kept with NULLs. `columns` are taken from the
    history (the features by default) and `feature_time` tells when the matched row was made; of
    several rows of one entity and time the one with the largest values counts.

    A scan in two levels, the same plan at every size. Time is cut into fixed slots of `slot_days`.
    History is gathered once by entity and slot, as an array in order of time; a slot that labels ask
    for has an entry even if it has no history. A prefix pass over the entries, one small row per
    entity and slot, carries the last row of earlier slots on. A label then meets its slot's entry, and
    takes the last row of the array up to its own time, or else the carried one. Labels are neither
    sorted against each other nor gathered, so Spark may split a busy entity's labels over tasks; its
    history is gathered for one slot at a time.

    Nothing runs before the result is asked for: that history later than the newest label stays out
    is a subquery, which also prunes the folders of stored history.
    """
    columns = columns or FEATURES
    # labels that can match nothing, however many share a NULL, stay out of the shuffle
    keyed = F.col("entity_id").isNotNull() & F.col("label_time").isNotNull()
    types = {"feature_time": history.schema["event_time"].dataType, **{c: history.schema[c].dataType for c in columns}}
    unmatched = labels.where(~keyed).select("*", *[F.lit(None).cast(t).alias(c) for c, t in types.items()])
    asked = labels.where(keyed).select("*", _slot("label_time", slot_days))

    newest = asked.agg(F.max("label_time").alias("newest"))
    known = scan_history(history, version).where(F.col("event_time") <= newest.scalar())
    if "snapshot_id" in history.columns:
        known = known.where(F.col("snapshot_id") <= newest.select(snapshot_id("newest")).scalar())
    row = F.struct(F.col("event_time").alias("feature_time"), *columns).alias("_row")
    rows = known.select("entity_id", _slot("event_time", slot_days), row)
    entries = (
        rows.unionByName(asked.select("entity_id", "_slot"), allowMissingColumns=True)
        # said here, so that both uses of the entries have the same plan and share its shuffle
        .where(F.col("entity_id").isNotNull() & F.col("_slot").isNotNull())
        .groupBy("entity_id", "_slot")
        .agg(F.sort_array(F.collect_list("_row")).alias("_rows"))
    )
    earlier = Window.partitionBy("entity_id").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    ends = entries.select("entity_id", "_slot", F.try_element_at("_rows", F.lit(-1)).alias("_end"))
    carried = ends.select("entity_id", "_slot", F.last("_end", ignorenulls=True).over(earlier).alias("_carried"))

    both = asked.join(entries.join(carried, ["entity_id", "_slot"]), ["entity_id", "_slot"])
    up_to = F.filter("_rows", lambda r: r["feature_time"] <= F.col("label_time"))
    matched = both.withColumn("_match", F.coalesce(F.try_element_at(up_to, F.lit(-1)), F.col("_carried")))
    return matched.select(*labels.columns, "_match.*").unionByName(unmatched)
