"""Mixing sources to target weights by weighted fair queueing.

Documents of a source are shuffled by a hash. A document's virtual finish time
is the source's cumulative size up to and including it, divided by the source's
target. Documents of all sources are ordered by finish time and taken until the
total budget (the size of the whole table) is used up. A source whose target
exceeds its size is queued again, up to `max_repeats` times.

Targets share the budget by weight; a target stops at `max_repeats` times its
source's size and the excess is reshared by weight until none is above. That
fixed point is min(max_repeats * size, level * weight) with one common level,
which sorting the sources by max_repeats * size / weight gives directly.

Both running sums (per source, and over finish times) go in two levels: sums
per fine hash or time range, a running sum over that small table, then a window
inside one range. So a source with any share of the rows is spread over many
tasks, and the small tables have at most sources x SLOTS and
max_repeats x SLOTS x 2 rows.

Defined results: null text has size 0; documents of size 0 take 0 words; the
null source is a source and comes last; repeated rows are documents of their
own; an empty table gives an empty result. The shuffle's hash is that of id and
text, so documents without an id, or that share one, spread as well; ties are
equal rows, of which each counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyferry.llm.common import split_words, stored, text_or_empty

SLOT_DIGITS = 3  # hex digits of the shuffle hash that name its range
SLOTS = 16**SLOT_DIGITS  # ranges of the shuffle hash, and of one unit of finish time
TIME_RANGES = 4  # finish times beyond this unit share the last range


def source_targets(sized: DataFrame, weights: tuple[float, ...], max_repeats: int) -> DataFrame:
    """source, queue (its place, from 1), source_size, target: one row per source, by water filling."""
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # Windows over the table of sources, one row each.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("queue") - 1) % len(weights) + 1)
    ranked = by_source.withColumn("queue", place).withColumn("weight", weight)
    cap = F.col("source_size") * max_repeats
    upto = Window.orderBy(cap / F.col("weight"), "queue")
    whole = Window.partitionBy()
    leveled = ranked.select(
        "source", "queue", "source_size", "weight", cap.alias("cap"),
        F.sum("source_size").over(whole).alias("total"),
        (F.sum(cap).over(upto) - cap).alias("capped_before"),
        (F.sum("weight").over(whole) - F.sum("weight").over(upto) + F.col("weight")).alias("weight_left"),
    )
    # The level if this source were the first that keeps below its cap; the
    # first source for which that holds gives the true one.
    level = (F.col("total") - F.col("capped_before")) / F.col("weight_left")
    reached = F.when(level * F.col("weight") <= F.col("cap"),
                     F.struct((F.col("cap") / F.col("weight")).alias("bound"), "queue", level.alias("level")))
    return leveled.withColumn("reached", reached).withColumn("level", F.min("reached").over(whole)["level"]).select(
        "source", "queue", "source_size",
        F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target"),
    )


def mix(documents: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_repeats: int = 3,
        with_row: bool = False) -> DataFrame:
    """doc_id, size, source_size, target, taken; `with_row` adds the input row as struct `kept_row`."""
    place = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(text_or_empty(F.col("text")))))
    row = [F.struct("*").alias("kept_row")] if with_row else []
    slot = F.conv(F.substring("place", 1, SLOT_DIGITS), 16, 10).cast("int")
    sized = stored(
        documents.select("doc_id", "source", F.size(split_words(F.col("text"))).cast("long").alias("size"),
                         place.alias("place"), F.xxhash64(text_or_empty(F.col("text"))).alias("text_hash"), *row).withColumn("slot", slot),
        "mix-sizes")
    targets = stored(source_targets(sized, weights, max_repeats), "mix-targets")
    queued = sized.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s", "source")

    # Cumulative size in a source: sums before the hash range, then a window inside it.
    before = F.sum("in_slot").over(Window.partitionBy("queue").orderBy("slot")) - F.col("in_slot")
    starts = queued.groupBy("queue", "slot").agg(F.sum("size").alias("in_slot")).select("queue", "slot", before.alias("before"))
    inside = Window.partitionBy("queue", "slot").orderBy("place", "doc_id", "text_hash", "size")
    queued = (
        queued.withColumn("inside", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("twin", F.row_number().over(inside))
        .join(starts, ["queue", "slot"])
        .withColumn("served", F.col("before") + F.col("inside"))
        .drop("before", "inside", "place", "text_hash")
    )

    # Every queueing of a document has a finish time; times fall into ranges.
    finish = (F.col("turn") * F.col("source_size") + F.col("served")) / F.col("target")
    time_range = F.least(F.floor(F.col("finish") * SLOTS), F.lit(TIME_RANGES * SLOTS)).cast("int")
    copies = (
        queued.where((F.col("size") > 0) & (F.col("target") > 0))
        .select("queue", "slot", "twin", "size", "served", "source_size", "target",
                F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))).alias("turn"))
        .withColumn("finish", finish)
        .withColumn("range", time_range)
    )
    # One row: the whole budget; and the range (of at most TIME_RANGES * SLOTS + 1) in which it ends.
    budget = targets.agg(F.sum("source_size")).first()[0] or 0
    timeline = copies.groupBy("range").agg(F.sum("size").alias("in_range")).withColumn(
        "upto", F.sum("in_range").over(Window.orderBy("range")))
    last = timeline.where(F.col("upto") > budget).orderBy("range").select(
        "range", (F.lit(budget) - F.col("upto") + F.col("in_range")).alias("left")).first()
    position = F.struct("finish", "queue", "slot", "twin", "turn")
    if last is None:
        taken_turn = F.lit(True)
    else:
        run = F.sum("size").over(Window.partitionBy("range").orderBy("finish", "queue", "slot", "twin", "turn")
                                 .rowsBetween(Window.unboundedPreceding, 0))
        edge = copies.where(F.col("range") == last["range"]).withColumn("run", run).where(F.col("run") <= last["left"])
        # The last queueing that fits: one row.
        cut = edge.agg(F.max(position).alias("cut")).first()["cut"]
        taken_turn = F.col("range") < last["range"]
        if cut is not None:
            end = F.struct(*[F.lit(v).cast(t) for v, t in zip(cut, ("double", "int", "int", "int", "int"))])
            taken_turn = taken_turn | ((F.col("range") == last["range"]) & (position <= end))

    taken = F.lit(0).cast("long")
    for turn in range(max_repeats):
        own_finish = (F.lit(turn) * F.col("source_size") + F.col("served")) / F.col("target")
        queued = queued.withColumn("turn", F.lit(turn)).withColumn(
            "finish", F.when((F.col("size") > 0) & (F.col("target") > 0), own_finish)).withColumn("range", time_range)
        queued = queued.withColumn(f"taken_{turn}", F.when(F.col("finish").isNotNull() & taken_turn, F.col("size")).otherwise(F.lit(0)))
        taken = taken + F.col(f"taken_{turn}")
    return queued.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"),
                         *(["kept_row"] if with_row else []))
