"""From edit histories and logs to the placement report."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placelens.functions.dates import epoch_seconds
from placelens.functions.urls import strip_query
from placelens.operators.attribution import slot_report, slot_traffic
from placelens.operators.lookups import lookup_fallback, resolve_rooms
from placelens.operators.versions import (
    drop_tombstones,
    explode_list,
    started_on,
    union_histories,
    version_intervals,
)
from placelens.session import written

# The kinds of entry each history contributes.
PAGE_SOURCETYPES = ("news", "topic", "live", "video")
VIDEO_SOURCETYPES = ("video", "live")

# The columns of a slot and of the report.
SLOT_COLUMNS = [
    "modifydate", "createuser", "typename", "newstype", "title", "idx", "pagenum",
    "real_starttime", "real_endtime", "content", "url",
]
REPORT_COLUMNS = [
    "modifydate", "real_starttime", "real_endtime", "idx", "pagenum", "content", "typename",
    "uv_active", "pv_active", "uv_show", "pv_show",
]


def slot_versions(histories: list[DataFrame]) -> DataFrame:
    """Versions in force per listed type. Intervals come first, within each source; then deletes go."""
    versions = version_intervals(union_histories(*histories), ["source", "id"])
    return explode_list(drop_tombstones(versions))


def slot_table(
    histories: list[DataFrame], types: DataFrame, rooms: DataFrame, day: str | None = None, dedup: bool = False
) -> DataFrame:
    """Slots with type name, content key and interval in epoch seconds; with `day`, those starting then.

    `types` holds `typeid, typename`, `rooms` holds `roomkey, flvurl`.
    """
    versions = slot_versions(histories)
    if day is not None:
        versions = started_on(versions, day)
    named = lookup_fallback(versions, types, "typeid", "typename", dedup=dedup)
    keyed = resolve_rooms(named.withColumn("content", strip_query(F.col("content"))), rooms, dedup=dedup)
    typed = {name: epoch_seconds(name) for name in ("real_starttime", "real_endtime")}
    typed |= {name: F.col(name).cast("string") for name in ("idx", "pagenum")}
    return keyed.withColumns(typed).select(*SLOT_COLUMNS)


def day_span(day: str) -> tuple[int, int]:
    start = int(dt.datetime.strptime(day, "%Y%m%d").replace(tzinfo=dt.timezone.utc).timestamp())
    return start, start + 86_399


def attribution_report(
    histories: list[DataFrame],
    types: DataFrame,
    rooms: DataFrame,
    clicks: DataFrame,
    views: DataFrame,
    day: str | None = None,
    dedup: bool = False,
    right_open: bool = False,
) -> DataFrame:
    """PV and UV of clicks and impressions for every slot.

    The slot table is needed for the join and for the report, so it is written once.
    """
    slots = written(slot_table(histories, types, rooms, day, dedup), "slots")
    span = day_span(day) if day else None
    traffic = slot_traffic(slots, {"active": clicks, "show": views}, span=span, right_open=right_open)
    return slot_report(slots, traffic).select(*REPORT_COLUMNS)
