"""Log rows attributed to the interval they fell in, and the traffic of each interval."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placelens.operators.joins import BROADCAST_BYTES, match_keys, measurable, row_bytes, sized

SLOT_KEYS = ["typename", "idx", "pagenum", "content"]
INTERVAL = ["real_starttime", "real_endtime"]
SLICES = 32

# Parts of time that may be chosen, the versions of one key that a part should hold, and how often a slot may repeat on average.
MORE_SLICES = (128, 512, 2048, 8192)
VERSIONS_A_PART = 64
REPEATS = 4


def _part(second: Column, low: int, high: int, slices: int) -> Column:
    inside = F.least(F.greatest(second, F.lit(low)), F.lit(high))
    return F.floor((inside - low) / ((high - low) // slices + 1)).cast("int")


def _measured(
    live: DataFrame, keys: list[str], start: str, end: str, span: tuple[int, int] | None, slices: int | None
) -> tuple[int, int, int, int]:
    """First and last second, number of parts, and bytes of the slots once they are cut.

    Two aggregates, one row each. Without a given number, busy keys ask for more parts than `SLICES`, and get as
    many as keep the slots from repeating more than `REPEATS` times on average (or no more than `SLICES` would).
    """
    per_key = live.groupBy(*keys).agg(F.count("*").alias("n"), F.min(start).alias("low"), F.max(start).alias("high"))
    most, low, high = per_key.agg(F.max("n"), F.min("low"), F.max("high")).first()
    if most is None:
        return 0, 0, slices or SLICES, 0
    low, high = span or (low, high)
    wanted = -(-most // VERSIONS_A_PART)
    choices = [slices] if slices else [SLICES, *(number for number in MORE_SLICES if number < 4 * wanted)]
    repeats = [
        (_part(F.col(end), low, high, number) - _part(F.col(start), low, high, number) + 1).cast("bigint") for number in choices
    ]
    size = row_bytes(live)
    sums = live.agg(F.count("*"), *(F.sum(n) for n in repeats), *(F.sum(n * size) for n in repeats)).first()
    count, copies, sizes = sums[0], sums[1 : 1 + len(choices)], sums[1 + len(choices) :]
    chosen = max(i for i in range(len(choices)) if i == 0 or copies[i] <= max(REPEATS * count, copies[0]))
    return low, high, choices[chosen], sizes[chosen]


def interval_join(
    slots: DataFrame,
    log: DataFrame,
    keys: list[str] = SLOT_KEYS,
    at: str = "dateline",
    start: str = "real_starttime",
    end: str = "real_endtime",
    span: tuple[int, int] | None = None,
    slices: int | None = None,
    right_open: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Inner join of slots and log rows on equal `keys` and `start <= at <= end` (whole seconds).

    Time is cut into `slices` equal parts over `span`, by default from the first to the last slot start;
    whatever lies outside belongs to the first or last part. A slot is repeated once per part it touches,
    at most `slices` times however long it lasts, and the part joins the keys: a log row meets only the
    slots of its own part, and a busy slot is spread over all parts. Without a number, `slices` follows from the
    versions of the busiest key. Neither span nor number ever changes the result; the span should cover the log.
    `right_open` excludes the end.

    The slots are measured before the join, so pass a table rather than a long computation.
    """
    log = log.where(F.col(at).isNotNull())
    live = slots.where(F.col(start) <= F.col(end)).dropna(subset=keys)
    low, high, slices, size = _measured(live, keys, start, end, span, slices)

    def part(second: Column) -> Column:
        return _part(second, low, high, slices)

    first, last = part(F.col(start)), part(F.col(end))
    fits = measurable(live) and size <= broadcast_bytes
    pieces = live.withColumn("_part", F.explode(F.sequence(first, last)))
    in_time = (F.col(at) >= F.col(start)) & (F.col(at) < F.col(end) if right_open else F.col(at) <= F.col(end))
    joined = match_keys(log.withColumn("_part", part(F.col(at))), sized(pieces, fits), [*keys, "_part"])
    return joined.where(in_time).drop("_part")


def pv_uv(rows: DataFrame, keys: list[str], visitor: str, pv: str, uv: str) -> DataFrame:
    """Page views and unique visitors per key.

    The distinct count is planned as partial aggregates on (keys, visitor) and then on keys, so neither
    a busy key nor a busy visitor ends up in one task.
    """
    return rows.groupBy(*keys).agg(F.count(visitor).alias(pv), F.countDistinct(visitor).alias(uv))


def visitor_views(
    slots: DataFrame,
    logs: dict[str, DataFrame],
    keys: list[str] = SLOT_KEYS,
    span: tuple[int, int] | None = None,
    right_open: bool = False,
) -> DataFrame:
    """keys, interval, log, visitor, views: how often each visitor came to each distinct slot interval, for all logs in one pass.

    `logs` maps a name to rows with `keys`, `visitor` and `dateline`. The logs are stacked and joined once. Copies of a slot
    are counted before the join and multiply its page views after it, as joining every copy would.
    """
    stacked = None
    for name in logs:
        part = logs[name].select(*keys, "visitor", "dateline", F.lit(name).alias("log"))
        stacked = part if stacked is None else stacked.unionByName(part)
    distinct = slots.groupBy(*keys, *INTERVAL).agg(F.count("*").alias("copies"))
    attributed = interval_join(distinct, stacked, keys, span=span, right_open=right_open)
    return attributed.groupBy(*keys, *INTERVAL, "log", "visitor").agg(F.sum("copies").alias("views"))


def traffic(per_visitor: DataFrame, names: list[str], keys: list[str] = SLOT_KEYS) -> DataFrame:
    """PV and UV of every slot interval from rows as of `visitor_views`, each visitor once; a metric without rows is NULL."""
    metrics = []
    for name in names:
        mine = F.col("log") == name
        metrics.append(F.sum(F.when(mine, F.col("views"))).alias(f"pv_{name}"))
        metrics.append(F.nullif(F.count(F.when(mine, F.col("visitor"))), F.lit(0)).alias(f"uv_{name}"))
    return per_visitor.groupBy(*keys, *INTERVAL).agg(*metrics)


def slot_traffic(
    slots: DataFrame,
    logs: dict[str, DataFrame],
    keys: list[str] = SLOT_KEYS,
    span: tuple[int, int] | None = None,
    right_open: bool = False,
) -> DataFrame:
    """PV and UV of every distinct slot interval, for all logs in one pass; `logs` maps a suffix such as `active` to a log."""
    return traffic(visitor_views(slots, logs, keys, span, right_open), list(logs), keys)


def slot_report(slots: DataFrame, traffic: DataFrame, keys: list[str] = SLOT_KEYS) -> DataFrame:
    """Every slot row with its traffic; slots without traffic keep NULL metrics."""
    return slots.join(traffic, [*keys, *INTERVAL], "left")
