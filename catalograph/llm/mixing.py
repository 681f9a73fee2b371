"""Mix sources to target weights by weighted fair queueing (DataFrame operations only).

Every source is a queue of its documents in shuffled order. A document's virtual
finish time is the words of its source up to and including it, divided by the
source's target; a second round of the same documents follows the first. All
queues are merged by finish time and cut off at the total budget, so that every
source stops near its target.

Running sums never gather a source in one task: the shuffle key's first hex digits
part each source into cells, and sums per cell give offsets. Rows that share key and
size (copies of an id, rows without one) are counted before any shuffle, per lane: a
lane is a part of such a group, of which there are as many as shuffle partitions. Only
these counts are summed one after the other within a cell; the rows themselves are
numbered within their lane. One id, or none, may so hold a third of all rows. The
cut-off is found by two rounds of sums over equal steps of finish time, and exactly
inside the last step.

Windows over sources (:func:`targets`) hold one row per distinct source in one task;
offsets, one row per source and cell, are joined by shuffles, never broadcast.

Defined cases: a null text (or size) has size 0; texts of any length are one document;
the null source is a source, after all others; null ids share one key; an empty
document is in the mix once and takes no words; repeated rows are separate documents
with tied keys, whose order does not change the result; an empty table gives an empty
result; other columns are carried in the struct ``doc``, so that no name clashes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalograph.llm.common import partitions, words, written

CELL_DIGITS = 3  # 4,096 cells a source
STEPS = 4096  # equal steps of finish time, twice


@dataclass(frozen=True)
class Mix:
    """``weights`` go to the sources by code point, over and over; the budget is
    ``budget`` times all words; no document is taken more than ``rounds`` times."""

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    budget: float = 1.5
    rounds: int = 2


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def targets(sizes: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Target words of each source: ``(source, source_size, target)``.

    ``sizes`` has ``source`` and ``source_size``, one row per source. Shares go by
    weight; a target stops at ``rounds`` times the source's size and the rest is
    shared again by weight, until none is above. That is one water level: the
    sources that fill first, in order of cap over weight, get their caps, the
    others get weight times level.
    """
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weights = F.array(*[F.lit(float(w)) for w in mix.weights])
    weighed = (
        sizes.withColumn("n", number)
        .withColumn("w", F.element_at(weights, ((F.col("n") - 1) % len(mix.weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * float(mix.rounds))
        .withColumn("fill", F.col("cap") / F.col("w"))
    )
    by_fill = Window.orderBy("fill", "n")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (
        weighed.withColumn("all_size", F.sum("source_size").over(whole))
        .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("w_left", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("all_size") * mix.budget - F.col("capped")) / F.col("w_left"))
        # The level is right at the first source that does not fill.
        .withColumn("open", F.col("level") < F.col("fill"))
        .withColumn("found", F.min(F.when(F.col("open"), F.struct("fill", "n", "level"))).over(whole)["level"])
    )
    target = F.least("cap", F.coalesce(F.col("found") * F.col("w"), F.col("cap")))
    return levels.select("source", "source_size", target.alias("target"))


def _any_lane(docs: DataFrame) -> Column:
    """A row's lane by its place in the input: equal rows are spread too, but only a stored result keeps it."""
    return F.monotonically_increasing_id() % partitions(docs.sparkSession)


def _lane_by_content(docs: DataFrame) -> Column:
    """A row's lane by what it holds, the same each time: rows equal in all columns share a lane."""
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    return F.pmod(F.xxhash64(*hashed), F.lit(partitions(docs.sparkSession)))


def _sized(docs: DataFrame, size: Column, source: Column, key: Column, lane: Column, carry: bool) -> DataFrame:
    """``source``, ``queue`` (its name, never null), ``size``, ``key`` (the shuffled order), ``cell`` and
    ``lane`` of every row; with ``carry`` all its columns as the struct ``doc``."""
    doc = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")] if carry else []
    key = F.md5(F.coalesce(key.cast("string"), F.lit("null")))
    rows = docs.select(*doc, source.cast("string").alias("source"), F.coalesce(size, F.lit(0)).cast("long").alias("size"), key.alias("key"), lane.alias("lane"))
    queue = F.coalesce(F.concat(F.lit("s"), "source"), F.lit(""))
    return rows.withColumn("queue", queue).withColumn("cell", F.substring("key", 1, CELL_DIGITS))


def _starts(sized: DataFrame, mix: Mix) -> DataFrame:
    """``start``, the words of the source before the first row of each group of rows that share key, size
    and lane, with the source's size and target."""
    group = ["queue", "cell", "key", "size", "lane"]
    groups = written(sized.groupBy(*group).agg(F.count("*").alias("n")), "mix-groups")
    held = F.col("size") * F.col("n")
    sums = written(groups.groupBy("queue", "cell").agg(F.sum(held).alias("cell_size")), "mix-cells")
    name = F.when(F.col("queue") != "", F.col("queue").substr(F.lit(2), F.length("queue"))).alias("source")
    wanted = targets(sums.groupBy(name).agg(F.sum("cell_size").alias("source_size")), mix)
    wanted = wanted.select(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("queue"), "source_size", "target")
    earlier = Window.partitionBy("queue").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("queue", "cell", F.coalesce(F.sum("cell_size").over(earlier), F.lit(0)).alias("offset"))
    offsets = offsets.join(wanted.hint("merge"), "queue")
    in_cell = Window.partitionBy("queue", "cell").orderBy("key", "size", "lane").rowsBetween(Window.unboundedPreceding, 0)
    start = F.col("offset") + F.sum(held).over(in_cell) - held
    placed = groups.join(offsets.hint("merge"), ["queue", "cell"])
    return written(placed.select("queue", "key", "size", "lane", start.alias("start"), "source_size", "target"), "mix-starts")


def _queue(sized: DataFrame, starts: DataFrame) -> DataFrame:
    """``sized`` with ``source_size``, ``target`` and ``before``: words of the source up to and including the row."""
    group = ["queue", "key", "size", "lane"]
    # Rows of a group are alike to the queue, so any order numbers them.
    number = F.row_number().over(Window.partitionBy(*group).orderBy("lane"))
    joined = sized.withColumn("number", number).join(starts.hint("merge"), group)
    return joined.withColumn("before", F.col("start") + F.col("number") * F.col("size")).drop("queue", "lane", "cell", "number", "start")


def copies(queue: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per document and round, with its virtual finish time ``finish``."""
    turn = F.explode(F.sequence(F.lit(0), F.when(F.col("size") > 0, mix.rounds - 1).otherwise(0))).alias("round")
    done = F.col("before") + F.col("round") * F.col("source_size")
    return queue.select("*", turn).withColumn("finish", F.coalesce(F.try_divide(done, F.col("target")), F.lit(0.0)))


def _order() -> Column:
    return F.struct("finish", F.coalesce(F.col("source"), F.lit("")).alias("source"), F.col("source").isNull().alias("no_source"), "key", "size", "round")


def cut_off(entries: DataFrame, budget: float) -> tuple | None:
    """The place in the merged queue of the last entry within ``budget`` words; None if there is none."""
    top = entries.agg(F.max("finish")).first()[0]
    if top is None:
        return None
    low, width, spent = 0.0, max(top, 1e-300) / STEPS, 0
    here, earlier = F.lit(True), F.lit(False)
    for _ in range(2):
        number = F.floor((F.col("finish") - low) / width).cast("long")
        sums = entries.where(here).groupBy(number.alias("step")).agg(F.sum("size").alias("words"))
        sums = sums.withColumn("upto", F.sum("words").over(Window.orderBy("step")) + spent)
        over = F.struct("step", (F.col("upto") - F.col("words")).alias("spent"))
        first = sums.where(F.col("upto") > budget).agg(F.min(over).alias("x")).first()[0]
        if first is None:  # all of it fits
            return entries.where(here | earlier).agg(F.max(_order())).first()[0]
        earlier = earlier | (here & (number < first["step"]))
        here = here & (number == first["step"])
        spent = first["spent"]
        low, width = low + first["step"] * width, width / STEPS
    inside = entries.where(here).select(_order().alias("at"), "size")
    running = F.sum("size").over(Window.orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    fits = inside.withColumn("upto", running + spent).where(F.col("upto") <= budget)
    last = fits.agg(F.max("at")).first()[0]
    if last is None:  # the cut-off lies at the end of an earlier step
        last = entries.where(earlier).agg(F.max(_order())).first()[0]
    return last


def _within(queue: DataFrame, mix: Mix) -> Column:
    """The condition under which a copy is within the budget; ``queue`` is written."""
    total = queue.agg(F.sum("size")).first()[0] or 0
    last = cut_off(copies(queue, mix), mix.budget * total)
    if last is None:
        return F.lit(False)
    return _order() <= F.struct(*[F.lit(last[f]).alias(f) for f in ("finish", "source", "no_source", "key", "size", "round")])


def mix_plan(docs: DataFrame, size: Column, source: Column, key: Column, mix: Mix = Mix()) -> DataFrame:
    """``doc``, ``source``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` words of every
    row of ``docs``, all of whose columns are written on the way: give it few."""
    sized = written(_sized(docs, size, source, key, _any_lane(docs), True), "mix-sized")
    queue = written(_queue(sized, _starts(sized, mix)), "mix-queue")
    within = _within(queue, mix)
    number = F.lit(0)
    for k in range(mix.rounds):
        done = F.col("before") + k * F.col("source_size")
        finish = F.coalesce(F.try_divide(done, F.col("target")), F.lit(0.0))
        queue = queue.withColumn("finish", finish).withColumn("round", F.lit(k)).withColumn(f"in{k}", within)
        number = number + F.when(F.col(f"in{k}") & (F.lit(k == 0) | (F.col("size") > 0)), 1).otherwise(0)
    out = queue.withColumn("copies", number.cast("int"))
    return out.select("doc", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def mixed(docs: DataFrame, size: Column, source: Column, key: Column, mix: Mix = Mix()) -> DataFrame:
    """The mix itself: the columns of ``docs``, a row per copy taken, range-sorted by finish time.

    The cut-off is found without the documents, which then go through the queue once. Lanes go by content,
    as both passes must agree on them: rows equal in all columns are numbered in one task.
    """
    lane = _lane_by_content(docs)
    sized = written(_sized(docs, size, source, key, lane, False), "mix-sized")
    starts = _starts(sized, mix)
    within = _within(written(_queue(sized, starts), "mix-queue"), mix)
    entries = copies(_queue(_sized(docs, size, source, key, lane, True), starts), mix).where(within)
    return entries.orderBy("finish", "source", "key", "round").select("doc.*")
