"""Mixing sources to target weights by entropy balancing, with DataFrame functions only.

Every document gets a rate between 0 and `limit` copies. Among all rates that meet the token target of each source,
those of largest entropy (relative to half the limit) are wanted. The dual of that problem is convex, with one
unknown `tilt` for each source: the odds of a document's rate are tilted exponentially by tilt * size, so
rate = limit / (1 + exp(-tilt * size / mean size)). Newton steps, each one distributed aggregation over the counts of
(source, size), solve it; steps that leave the bracket of the root are replaced by its middle.

Rates become whole copies by ordered rounding: each document gets the whole part of its rate, and the documents of a
source that come first by (hash - fractional part) get one copy more until the target is reached. Further
passes fill what is left, down to `FILL` of the target, with smaller documents. Sums are over integers and decimals, so reruns agree exactly.

A source is described by its tilt and its cuts alone, so copies are decided row by row without a join on documents.
No task holds a source: sizes are counted before they are shuffled, and cuts are searched in buckets. Documents that agree in id, text and
source would all be first in line or last, so they are numbered, in chunks of a task's rows, and each draws for itself.

Defined results: a null text has size 0 and takes nothing; a null source is a source of its own, the last; documents that
agree in id, text and source are interchangeable, and their number decides how many copies they get together; a table without words takes nothing; an empty table gives no rows;
other columns are not looked at, whatever their names.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from placelens.llm.common import BUCKET_ROWS, bucket_count, group_key, measured_join, running_total, stored, word_count
from placelens.operators.joins import fits_broadcast, sized

WEIGHTS = (3, 1, 2)
SHARE = 1.5
LIMIT = 2
STEPS = 60
STEPS_A_JOB = 5
CLOSE = 1e-5
FILL = 5e-4


def targets(totals: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """Add `target` to `totals`, one row per source: key (of `group_key`), source_size.

    Sources by code point, null last, take the weights in turn. A source never gets more than `limit` times its size; what
    it leaves is shared among the others by weight. With the sources in order of limit by weight, the ones that reach it
    come first, so one running sum finds the level of the rest.
    """
    place = F.row_number().over(Window.orderBy(F.col("key") == "", "key")) - 1
    turn = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    weighted = totals.withColumn("weight", turn).withColumn("most", limit * F.col("source_size"))
    most_each = F.col("most") / F.col("weight")
    order = Window.orderBy(most_each, "key")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum("most").over(before), F.lit(0))
    levels = weighted.withColumn("level", left / F.sum("weight").over(after))
    # The first source that its share of what is left does not lift to its limit sets the level of all that follow.
    common = F.min(F.when(most_each >= F.col("level"), F.struct(most_each, F.col("key"), F.col("level")))).over(whole)
    reached = F.least(F.col("weight") * common["level"], F.col("most").cast("double"))
    return levels.withColumn("target", F.coalesce(reached, F.col("most").cast("double"))).select(*totals.columns, "target")


def _rate(limit: int) -> Column:
    """Rounded, so that equal inputs give equal copies whatever the last bits of a sum were."""
    exact = limit / (1 + F.exp(-F.col("tilt") * F.col("size") / F.col("mean")))
    return F.round(F.when(F.col("tilt").isNull(), F.lit(float(limit))).otherwise(exact), 9)


STATE = ["source_size", "target", "mean", "tilt", "low", "high", "gap"]


def _log_odds(part: str, whole: Column) -> Column:
    return F.log(F.try_divide(F.col(part), whole - F.col(part)))


def _newton_step(counts: DataFrame, state: DataFrame, limit: int) -> DataFrame:
    """One step for every source that is not there yet: an aggregation of `counts`.

    The step solves for the log-odds of the reached share, in which the constraint is nearly straight.
    """
    near = counts.join(state, "key").withColumn("rate", _rate(limit))
    words = F.col("n") * F.col("size")
    slope = words * F.col("size") / F.col("mean") * F.col("rate") * (1 - F.col("rate") / limit)
    sums = near.groupBy("key").agg(
        F.sum(words.cast("decimal(20,0)") * F.col("rate").cast("decimal(12,9)")).cast("double").alias("got"),
        F.sum(slope.cast("decimal(38,9)")).cast("double").alias("slope"),
        *(F.first(name).alias(name) for name in STATE),
    )
    most = limit * F.col("source_size")
    aims = sums.select(
        "key", "source_size", "target", "mean", "tilt", "low", "high",
        (F.col("got") - F.col("target")).alias("gap"),
        (_log_odds("got", most) - _log_odds("target", most)).alias("odds"),
        (F.col("slope") * (F.try_divide(F.lit(1.0), "got") + F.try_divide(F.lit(1.0), most - F.col("got")))).alias("bent"),
    )
    steps = aims.select(
        "key", "source_size", "target", "mean", "tilt", "gap",
        F.when(F.col("gap") < 0, F.col("tilt")).otherwise(F.col("low")).alias("low"),
        F.when(F.col("gap") > 0, F.col("tilt")).otherwise(F.col("high")).alias("high"),
        F.coalesce(F.try_divide("odds", F.when(F.col("bent") > 0, F.col("bent"))), F.signum("gap")).alias("step"),
        (4 * F.abs("tilt") + 4).alias("reach"),
        (F.col("tilt").isNull() | (F.abs("gap") <= F.col("target") * CLOSE)).alias("there"),
    )
    held = steps.withColumn("to", F.col("tilt") - F.least(F.greatest("step", -F.col("reach")), F.col("reach")))
    inside = (F.col("low").isNull() | (F.col("to") > F.col("low"))) & (F.col("high").isNull() | (F.col("to") < F.col("high")))
    moved = F.when(inside, F.col("to")).otherwise((F.col("low") + F.col("high")) / 2)
    return held.select(
        "key", "source_size", "target", "mean",
        F.when(F.col("there"), F.col("tilt")).otherwise(F.round(moved, 12)).alias("tilt"),
        "low", "high",
        F.when(F.col("there"), F.lit(0.0)).otherwise(F.col("gap")).alias("gap"),
    )


def tilts(counts: DataFrame, goals: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Solve the dual: one row per source with its tilt, null where the target is the limit itself (or nothing).

    `counts`: key, size, n. The state, a row for each source, is stored every few steps, which also cuts the lineage.
    """
    small = fits_broadcast(goals)
    open_ = (F.col("target") > 0) & (F.col("target") < limit * F.col("source_size"))
    state = goals.select(
        "key", "source_size", "target",
        F.greatest(F.col("source_size") / F.col("documents"), F.lit(1e-9)).alias("mean"),
        F.when(open_, F.lit(0.0)).alias("tilt"),
        F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"),
        F.lit(0.0).alias("gap"),
    )
    for _ in range(STEPS // STEPS_A_JOB):
        for _ in range(STEPS_A_JOB):
            state = _newton_step(counts, sized(state, small), limit)
        state = stored(state, "tilt")
        if state.where("gap <> 0").isEmpty():
            break
    return state.select("key", "source_size", "target", "mean", "tilt")


def sized_rows(docs: DataFrame, id_col: str, source_col: str, text_col: str, seed: int, *more: str) -> DataFrame:
    """Per row: id, tag (the id as text), key (of its source), size, and `draw`, a uniform number in [0, 1) that hangs on id and text."""
    return docs.select(
        F.col(id_col).alias("id"),
        group_key(F.col(id_col)).alias("tag"),
        group_key(F.col(source_col)).alias("key"),
        word_count(F.col(text_col)).alias("size"),
        _uniform(F.lit(seed), F.col(id_col), F.col(text_col)).alias("draw"),
        *more,
    )


def _uniform(*columns: Column) -> Column:
    return F.shiftright(F.xxhash64(*columns), 11) / F.lit(float(2**53)) + 0.5


SAME = ["key", "size", "draw", "tag"]


def repeats(rows: DataFrame) -> DataFrame:
    """What repeated rows share, once each; stored. `rows` as of `sized_rows`."""
    return stored(rows.groupBy(*SAME).count().where("count > 1").select(*SAME), "repeated")


def numbered(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """`rows` with a `draw` of its own for each of those that `repeats` found: the first keeps its draw, the others' hang on their number.

    Only they are shuffled. A chunk is at most `BUCKET_ROWS` neighbouring rows of a task, so copies without number are many groups.
    """
    if repeated.isEmpty():
        return rows
    once = measured_join(rows, repeated, SAME, "left_anti")
    again = measured_join(rows, repeated, SAME, "left_semi").withColumn("_at", F.monotonically_increasing_id())
    chunks = stored(again, "repeated-rows").withColumn("_chunk", F.floor(F.col("_at") / BUCKET_ROWS)).withColumn("_one", F.lit(1).cast("bigint"))
    counted = running_total(chunks, SAME, "_chunk", [F.col("_at")], "_one", "_number")
    own = F.when(F.col("_number") == 0, F.col("draw")).otherwise(_uniform(F.col("draw"), F.col("_number")))
    return once.unionByName(counted.withColumn("draw", own).select(rows.columns))


def _decided(rows: DataFrame, plan: DataFrame, limit: int) -> DataFrame:
    """`rows` with what their source's plan decides for them.

    rate; base: its whole part; turn: the place in line for one more copy; copies: with the copy more that one of the cuts gives.
    """
    rated = rows.join(plan, "key").withColumn("rate", _rate(limit))
    based = rated.withColumn("base", F.least(F.floor("rate"), F.lit(limit)).cast("bigint"))
    lined = based.withColumn("turn", F.round(F.col("draw") - (F.col("rate") - F.col("base")), 12))
    extra = F.exists(
        "cuts", lambda cut: (F.col("size") <= cut["room"]) & (F.struct("turn", "size") <= F.struct(cut["turn"], cut["size"]))
    )
    return lined.withColumn(
        "copies", F.least(F.col("base") + F.coalesce(extra, F.lit(False)).cast("bigint"), F.lit(limit).cast("bigint"))
    )


def _side(plan: DataFrame) -> DataFrame:
    """The plan as a side to join, measured with its cuts as text: the rows of a busy source stay where they are."""
    return sized(plan, fits_broadcast(plan.withColumn("cuts", F.to_json("cuts"))))


def _next_cuts(rows: DataFrame, plan: DataFrame, limit: int, buckets: int) -> DataFrame:
    """The rows that get one copy more in this pass, as a cut for each source: key, room, last (turn, size)."""
    decided = _decided(rows, plan, limit)
    taken = decided.groupBy("key").agg(
        F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("goal")
    )
    room = F.floor(F.col("goal") - F.col("taken") + 0.5).cast("bigint")
    left = taken.withColumn("room", room).where(F.col("room") > FILL * F.col("goal")).select("key", "room")
    waiting = (
        decided.where((F.col("copies") == F.col("base")) & (F.col("base") < limit) & (F.col("size") > 0))
        .select("key", "size", "turn")
        .join(left, "key")
        .where(F.col("size") <= F.col("room"))
        .withColumn("bucket", F.floor((F.col("turn") + 1) * buckets / 2))
    )
    lined = running_total(waiting, ["key"], "bucket", [F.col("turn"), F.col("size")], "size", "before")
    place = F.struct("turn", "size")
    late = F.col("before") + F.col("size") > F.col("room")
    # Rows that agree in turn and size go in or stay out together, so a cut ends before the first that does not fit.
    first_late = lined.where(late).groupBy("key").agg(F.min(place).alias("stop"))
    return (
        lined.where(~late)
        .join(first_late, "key", "left")
        .where(F.col("stop").isNull() | (place < F.col("stop")))
        .groupBy("key")
        .agg(F.max("room").alias("room"), F.max(place).alias("last"))
    )


def plan_copies(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """One row per source: key, source_size, target, mean, tilt, cuts. `rows` as of `sized_rows`, stored."""
    counts = stored(rows.groupBy("key", "size").agg(F.count("*").alias("n")), "sizes")
    totals = counts.groupBy("key").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("documents")
    )
    goals = stored(targets(totals, weights, share, limit), "targets")
    no_cuts = F.array().cast("array<struct<room:bigint,turn:double,size:bigint>>")
    plan = stored(tilts(counts, goals, limit).withColumn("cuts", no_cuts), "plan")
    buckets = bucket_count(rows.count())
    while True:  # every pass leaves less room; it ends when nothing fits any more, or little room is left
        cuts = stored(_next_cuts(rows, _side(plan), limit, buckets), "cuts")
        if cuts.isEmpty():
            return plan
        added = F.array(F.struct("room", F.col("last.turn").alias("turn"), F.col("last.size").alias("size")))
        longer = F.when(F.col("room").isNull(), F.col("cuts")).otherwise(F.concat("cuts", added))
        plan = stored(plan.join(cuts, "key", "left").withColumn("cuts", longer).select(plan.columns), "plan")


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: int = 11, **goal
) -> DataFrame:
    """One row per document: id, size, source_size, target, rate, copies, taken (words the mix takes of it)."""
    rows = stored(sized_rows(docs, id_col, source_col, text_col, seed), "mix-rows")
    rows = numbered(rows, repeats(rows))
    plan = plan_copies(rows, **goal)
    decided = _decided(rows, _side(plan), goal.get("limit", LIMIT))
    return decided.select(
        "id", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed_rows(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: int = 11, **goal
) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it; rows without words stay out."""
    alone = stored(sized_rows(docs, id_col, source_col, text_col, seed), "mix-rows")
    repeated = repeats(alone)
    plan = plan_copies(numbered(alone, repeated), **goal)
    whole = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"))
    rows = numbered(sized_rows(whole, f"row.{id_col}", f"row.{source_col}", f"row.{text_col}", seed, "row"), repeated)
    decided = _decided(rows, _side(plan), goal.get("limit", LIMIT)).where("size > 0")
    return decided.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("row.*")
