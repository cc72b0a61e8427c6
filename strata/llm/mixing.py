"""Mixing sources to target weights with Pfair scheduling.

Each source is a task whose weight is its share of the stream, in parts of
``PERIOD``: block q of a source with c parts is released at slot
floor(q * PERIOD / c) and due before slot ceil((q + 1) * PERIOD / c). Taking
in each slot the released block with the earliest deadline meets every
deadline, so that at any point of the stream each source is less than one
block away from its share. As the weights are multiples of 1/``PERIOD``, the
schedule repeats after ``PERIOD`` slots; one period is computed by a fold over
its slots, and all blocks take their slots from it.

The stream ends when every source has been read in full at least once:
nothing is left out, and sources that are smaller than their share begin
again (``epoch``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import bound, fresh, materialized

PERIOD = 1000        # slots of a period: weights are multiples of 1/1000
BLOCK = 32           # rows of a block
SMOOTHING = 0.7      # default weights: the source's row count to this power
MAX_SOURCES = 100_000  # the schedule is broadcast: a number per slot and source


def _targets(sizes: DataFrame, weights: dict[str, float] | None) -> DataFrame:
    """``sizes`` (source, n) with ``want``, the target weight before scaling, as a whole number.
    Without ``weights``: the smoothed size. Sources that ``weights`` lacks have weight 0."""
    if weights is None:
        want = F.pow(F.col("n").cast("double"), F.lit(SMOOTHING)) * 1000
    else:
        given = [x for k, v in sorted(weights.items()) for x in (F.lit("=" + k), F.lit(v * 1e9))]
        want = F.element_at(F.create_map(*given), F.col("source")) if given else F.lit(0.0)
    return sizes.withColumn("want", F.coalesce(F.round(want).cast("long"), F.lit(0)))


def _parts(targets: DataFrame, period: int) -> DataFrame:
    """``targets`` with ``parts``: at least one each, ``period`` in all, by largest remainder."""
    everything = Window.partitionBy()
    extra = F.lit(period) - F.count(F.lit(1)).over(everything)
    whole = F.greatest(F.lit(1), F.sum("want").over(everything))
    exact = extra * F.col("want") / whole
    rated = targets.withColumn("low", F.floor(exact)).withColumn("rest", exact - F.floor(exact)).withColumn("extra", extra)
    left = F.col("extra") - F.sum("low").over(everything)
    place = F.row_number().over(everything.orderBy(F.desc("rest"), "source"))
    return rated.withColumn("parts", (1 + F.col("low") + F.when(place <= left, 1).otherwise(0)).cast("long"))


def _release(q: Column, parts: Column, period: int) -> Column:
    return F.floor(q * period / parts)


def _deadline(q: Column, parts: Column, period: int) -> Column:
    return F.ceil((q + 1) * period / parts)


def schedule(parts: DataFrame, period: int) -> DataFrame:
    """(source, parts, slots): the slots that each source gets in one period.

    One fold over the slots of a period; its state is the number of blocks
    that each source has had so far, and the sources in order of their slots.
    """
    tasks = parts.agg(F.sort_array(F.collect_list(F.struct("source", "parts"))).alias("tasks")).filter(F.size("tasks") > 0)

    def step(state: Column, slot: Column) -> Column:
        def offer(i: Column) -> Column:
            had, own = F.get(state["had"], i), F.get(F.col("tasks"), i)["parts"]
            return F.when(_release(had, own, period) <= slot, F.struct(_deadline(had, own, period).alias("due"), i.alias("i")))

        def take(choice: Column) -> Column:
            had = F.transform(state["had"], lambda n, i: n + F.when(i == choice, 1).otherwise(0))
            return F.struct(had.alias("had"), F.concat(state["taken"], F.array(choice)).alias("taken"))

        return bound(F.array_min(F.transform(F.sequence(F.lit(0), F.size("tasks") - 1), offer))["i"], take)

    start = F.struct(F.transform(F.col("tasks"), lambda t: F.lit(0).cast("long")).alias("had"),
                     F.array().cast("array<int>").alias("taken"))
    taken = F.aggregate(F.sequence(F.lit(0), F.lit(period - 1)), start, step, lambda s: s["taken"])
    slots = tasks.select("tasks", F.posexplode(taken).alias("slot", "i")).select(
        F.get("tasks", F.col("i")).alias("task"), "slot")
    return slots.groupBy("task").agg(F.sort_array(F.collect_list("slot")).alias("slots")).select(
        "task.source", "task.parts", "slots")


def ranked(rows: DataFrame, source_col: str, key: list[str], rank_col: str) -> DataFrame:
    """``rows`` with their rank (from 0) among the rows of their source (never null), in the order of
    a digest of ``key``: a fixed shuffle. Hash parts of a source are ranked
    independently and offset by the counts of the parts before them."""
    digest, part, begins = (fresh(n, rows.columns) for n in ("digest", "part", "begins"))
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])
    placed = rows.withColumn(digest, F.md5(text)).withColumn(part, F.substring(digest, 1, 3))
    counts = placed.groupBy(source_col, part).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(source_col).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col(source_col).alias("_source"), F.col(part).alias("_part"),
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(begins))
    inside = F.row_number().over(Window.partitionBy(source_col, part).orderBy(digest, *key)) - 1
    numbered = placed.withColumn(rank_col, inside.cast("long"))
    # the keys by which the rows are already dealt: they are not shuffled again
    same = (F.col(source_col) == F.col("_source")) & (F.col(part) == F.col("_part"))
    joined = numbered.join(offsets, same)
    return joined.withColumn(rank_col, F.col(rank_col) + F.col(begins)).drop(digest, part, begins, "_source", "_part")


def _stream(sizes: DataFrame, weights: dict[str, float] | None, block: int, period: int, until: str) -> DataFrame:
    """(source, parts, slots, blocks, uses): a row per source; ``uses`` counts its blocks in the whole stream."""
    planned = schedule(_parts(_targets(sizes, weights), period), period)
    table = sizes.join(planned, "source").withColumn("blocks", F.ceil(F.col("n") / block))

    def slot(q: Column) -> Column:
        return F.floor(q / F.col("parts")) * period + F.get("slots", (q % F.col("parts")).cast("int"))

    if until == "all":      # until every source has had its last block
        length = F.max(slot(F.col("blocks") - 1) + 1)
    elif until == "first":  # until a source would have to begin again
        length = F.min(slot(F.col("blocks")))
    else:
        raise ValueError(f"until={until!r}: 'all' or 'first'")
    table = table.withColumn("length", length.over(Window.partitionBy()))
    in_last = F.size(F.filter("slots", lambda s: s < F.col("length") % period))
    return table.withColumn("uses", F.floor(F.col("length") / period) * F.col("parts") + in_last).select(
        F.col("source").alias("_source"), "parts", "slots", "blocks", "uses")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, source_col: str = "source",
        key: tuple[str, ...] = ("doc_id",), block: int = BLOCK, period: int = PERIOD, until: str = "all") -> DataFrame:
    """``docs`` as one stream mixed to target weights, with the columns epoch, block, rank, release, deadline
    and slot; the stream's order is (slot, rank).

    ``weights``: source -> weight, scaled to 1 and rounded to 1/``period``, at least 1/``period`` each;
    sources it lacks get that minimum. By default a source's weight is its row count to
    the power ``SMOOTHING``. Each source is shuffled by a digest of ``key`` and cut into blocks of
    ``block`` rows (its last one may be shorter). ``until="all"``: the stream ends with the first full
    reading of the last source, and sources that are done earlier begin
    again, so every row occurs, small sources' rows several times.
    ``until="first"``: it ends before any row would occur twice; rows that
    the weights have not reached by then are not part of it.

    Null sources are one source. Rows with equal keys are ranked next to each other. An empty
    table gives an empty result. Columns of ``docs`` that are named like a result give way to it.
    The schedule, a row per source with ``period`` numbers in all, is broadcast: ``MAX_SOURCES`` sources at most.
    """
    made = ("epoch", "block", "rank", "release", "deadline", "slot")
    keys = [f"key{i}" for i in range(len(key))]
    rows = docs.select(  # apart from the row's own columns, so that no names clash
        F.struct(*[F.col(c) for c in docs.columns]).alias("doc"), *[F.col(c).alias(k) for c, k in zip(key, keys)],
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("source"))
    sizes = materialized(rows.groupBy("source").agg(F.count(F.lit(1)).alias("n")), "source_sizes")
    sources = sizes.count()
    if sources > MAX_SOURCES:
        raise ValueError(f"{sources} sources; the schedule of {MAX_SOURCES} at most is sent to the tasks")
    period = max(period, 2 * sources)
    stream = _stream(sizes, weights, block, period, until)
    placed = ranked(rows, "source", keys, "rank").withColumn("block", F.floor(F.col("rank") / block))
    placed = placed.join(F.broadcast(stream), F.col("source") == F.col("_source")).filter(F.col("block") < F.col("uses"))
    last = F.floor((F.col("uses") - 1 - F.col("block")) / F.col("blocks"))
    placed = placed.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    q = F.col("block") + F.col("epoch") * F.col("blocks")
    slot = F.floor(q / F.col("parts")) * period + F.get("slots", (q % F.col("parts")).cast("int"))
    own = [F.col("doc").getField(c).alias(c) for c in docs.columns if c.lower() not in made]
    return placed.withColumns({"release": _release(q, F.col("parts"), period), "slot": slot,
                               "deadline": _deadline(q, F.col("parts"), period)}).select(*own, *made)


def in_stream_order(mixed: DataFrame) -> DataFrame:
    """A mixed stream laid out in its order: each partition, and each file written from it, is one stretch."""
    return mixed.repartitionByRange("slot", "rank").sortWithinPartitions("slot", "rank")
