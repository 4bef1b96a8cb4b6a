"""Mixing sources to target weights by Pfair scheduling.

A source's documents, in an order fixed by a hash, are cut into blocks of equally many characters. Block k of a source
with weight w is released at slot floor(k / w) and due at slot ceil((k + 1) / w); every slot takes the released block
that is due first. At any slot a source is then less than one block away from its share. With weights rounded to
whole blocks per period the schedule repeats every period, so one period is planned on the driver, from the weights
alone, and any block's slot follows by arithmetic: nothing is scheduled block by block at run time.

Sources run in epochs until every document of every source has been placed, so none is dropped and the shares hold to
the end; the smaller a source is against its weight, the more often it repeats.
"""

from __future__ import annotations

import heapq
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportloom.llm.storage import stored

PERIOD = 4096  # slots; weights are rounded to multiples of 1 / period
SLOTS_PER_SOURCE = 16  # the period grows with the number of sources beyond PERIOD / SLOTS_PER_SOURCE
BLOCK_CHARS = 1 << 16
SHARDS = 4096  # hash ranges of a source that are ordered and summed on their own


class Plan(NamedTuple):
    """One period: per source the slots it is served in, ascending."""

    period: int
    slots: dict[str, list[int]]


def quotas(weights: dict[str, float], period: int = PERIOD) -> tuple[int, dict[str, int]]:
    """(period, blocks per period of each source): largest remainders, at least one block each."""
    if not weights:
        return period, {}
    if min(weights.values()) <= 0:
        raise ValueError("weights must be positive")
    while period < SLOTS_PER_SOURCE * len(weights):
        period *= 2
    total = sum(weights.values())
    exact = {s: w / total * period for s, w in weights.items()}
    whole = {s: max(1, int(x)) for s, x in exact.items()}
    left = period - sum(whole.values())
    order = sorted(weights, key=lambda s: (whole[s] - exact[s], s))
    while left > 0:
        for s in order[:left]:
            whole[s] += 1
        left = period - sum(whole.values())
    while left < 0:  # sources lifted to one block take it from those furthest above their share
        most = max((s for s in order if whole[s] > 1), key=lambda s: (whole[s] - exact[s], s))
        whole[most] -= 1
        left += 1
    return period, whole


def plan(weights: dict[str, float], period: int = PERIOD) -> Plan:
    """Earliest deadline first over one period, ties by source name."""
    period, blocks = quotas(weights, period)
    slots: dict[str, list[int]] = {s: [] for s in blocks}
    waiting = [(0, s) for s in sorted(blocks)]  # (release, source) of each source's next block
    ready: list[tuple[int, str]] = []  # (deadline, source)
    heapq.heapify(waiting)
    for slot in range(period if blocks else 0):
        while waiting and waiting[0][0] <= slot:
            _, s = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(len(slots[s]) + 1) * period // blocks[s]), s))
        _, s = heapq.heappop(ready)
        slots[s].append(slot)
        if len(slots[s]) < blocks[s]:
            heapq.heappush(waiting, (len(slots[s]) * period // blocks[s], s))
    return Plan(period, slots)


def tempered(sizes: dict[str, int], exponent: float) -> dict[str, float]:
    """Weights by size to the power of ``exponent``: 1 keeps the given shares, 0 makes all sources equal."""
    return {s: max(n, 1) ** exponent for s, n in sizes.items()}


def _named(source: Column) -> Column:
    """A key that tells NULL from every name."""
    return F.when(source.isNull(), "").otherwise(F.concat(F.lit("="), source.cast("string")))


def _characters(text: Column) -> Column:
    return F.coalesce(F.length(text), F.lit(0)).cast("long")


def source_sizes(docs: DataFrame, source: str = "source", text: str = "text") -> dict[str | None, int]:
    """Characters of each source: one number per source on the driver, as many as a mixture has weights."""
    rows = docs.groupBy(F.col(source).cast("string").alias("s")).agg(F.sum(_characters(F.col(text))).alias("n")).collect()
    return {r.s: r.n for r in rows}


def _placed(docs: DataFrame, weights: dict[str | None, float], key: str, source: str, text: str, block_chars: int,
            *kept: Column) -> DataFrame:
    """The key and source of each repetition of a row, _mix_block, _mix_epoch, _mix_slot, _mix_at (characters of its
    source before it) and the columns ``kept``; no other columns, so no name can clash."""
    spark = docs.sparkSession
    period, slots = plan({"" if s is None else f"={s}": w for s, w in weights.items()})
    key_hash = F.xxhash64(F.col(key), F.col(text))
    keyed = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), _named(F.col(source)).alias("_mix_source"), key_hash.alias("_mix_hash"),
                        _characters(F.col(text)).alias("_mix_chars"), F.pmod(key_hash, F.lit(SHARDS)).alias("_mix_shard"), *kept)
    shards = keyed.groupBy("_mix_source", "_mix_shard").agg(F.sum("_mix_chars").alias("n"))
    earlier = Window.partitionBy("_mix_source").orderBy("_mix_shard")
    offsets = stored(shards.select("_mix_source", "_mix_shard", (F.sum("n").over(earlier) - F.col("n")).alias("_mix_before"), "n"), "mix-offsets")
    totals = offsets.groupBy("_mix_source").agg(F.sum("n").alias("chars"))
    served = spark.createDataFrame([(s, own) for s, own in slots.items()], "_mix_source string, _mix_slots array<int>")
    # Bounded: the slots of one period, and a row per source.
    known = totals.join(F.broadcast(served), "_mix_source").select(
        "_mix_source", "_mix_slots", F.greatest(F.ceil(F.col("chars") / block_chars), F.lit(1)).cast("long").alias("_mix_blocks"))
    last = F.col("_mix_blocks") - 1
    ends = known.withColumn("end", _slot(last, period) + 1).agg(F.max("end")).first()[0] or 0
    turns = F.size("_mix_slots") * F.lit(ends // period) + F.size(F.filter("_mix_slots", lambda s: s < ends % period))
    known = stored(known.withColumn("_mix_turns", turns.cast("long")), "mix-sources")
    within = Window.partitionBy("_mix_source", "_mix_shard").orderBy("_mix_hash", "key")
    summed = keyed.withColumn("_mix_in", F.sum("_mix_chars").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_mix_chars"))
    at = (F.col("_mix_before") + F.col("_mix_in")).alias("_mix_at")
    set_out = summed.join(offsets.drop("n"), ["_mix_source", "_mix_shard"]).select("*", at)
    blocked = set_out.join(F.broadcast(known), "_mix_source").withColumn(
        "_mix_block", F.least(F.floor(F.col("_mix_at") / block_chars), last).cast("long"))
    epochs = F.sequence(F.lit(0), F.floor((F.col("_mix_turns") - 1 - F.col("_mix_block")) / F.col("_mix_blocks")).cast("long"))
    repeated = blocked.withColumn("_mix_epoch", F.explode(epochs))
    turn = F.col("_mix_epoch") * F.col("_mix_blocks") + F.col("_mix_block")
    return repeated.withColumn("_mix_slot", _slot(turn, period))


def _slot(turn: Column, period: int) -> Column:
    """The slot of a source's block number ``turn``, counted from 0 through all epochs."""
    quota = F.size("_mix_slots")
    return F.floor(turn / quota).cast("long") * period + F.element_at("_mix_slots", (turn % quota).cast("int") + 1)


def schedule(docs: DataFrame, weights: dict[str | None, float], key: str = "doc_id", source: str = "source",
             text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(key, source, slot, epoch, block, offset), a row for each time a document is placed; the mix is the order by slot,
    offset and key.

    ``weights`` must name every source of ``docs`` (NULL is a source), any scale. A document belongs to the block in
    which its first character lies, so longer ones reach into the next; NULL and empty texts take up no room but are
    placed. Repeated rows are placed each. Without rows the result is empty. Other columns are ignored; only numbers
    are shuffled.
    """
    return _placed(docs, _checked(docs, weights, source), key, source, text, block_chars).select(
        F.col("key").alias(key), F.col("source").alias(source), F.col("_mix_slot").alias("slot"), F.col("_mix_epoch").cast("long").alias("epoch"),
        F.col("_mix_block").alias("block"), F.col("_mix_at").alias("offset"))


def mixed(docs: DataFrame, weights: dict[str | None, float], key: str = "doc_id", source: str = "source", text: str = "text",
          block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` in the order of the mix, rows repeated as ``schedule`` says, columns unchanged, whatever their names.
    Partitions hold ranges of slots, so files written from it are in order; ``storage.file_places`` finds it again."""
    own = {c: f"_doc_{i}" for i, c in enumerate(docs.columns)}  # names that none of the schedule's can be
    placed = _placed(docs.toDF(*own.values()), _checked(docs, weights, source), own[key], own[source], own[text], block_chars, *map(F.col, own.values()))
    in_order = placed.repartitionByRange("_mix_slot", "_mix_at").sortWithinPartitions("_mix_slot", "_mix_at", "key")
    return in_order.select(*[F.col(name).alias(c) for c, name in own.items()])


def _checked(docs: DataFrame, weights: dict[str | None, float], source: str) -> dict[str | None, float]:
    found = {r.s for r in docs.select(F.col(source).cast("string").alias("s")).distinct().collect()}  # one value per source
    if found - set(weights):
        raise ValueError(f"sources without a weight: {sorted(map(str, found - set(weights)))[:10]}")
    return {s: w for s, w in weights.items() if s in found}
