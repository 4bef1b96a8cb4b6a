"""SimHash near-duplicates with pigeonring filtering.

A document's fingerprint takes a bit if more than half of its word shingles' hashes have it. Equal fingerprints form a
class first, so copies cost one row. Distinct fingerprints are cut into a ring of ``max_bits + 1`` segments: if two
differ in at most ``max_bits`` bits, then from some segment on, every chain of l consecutive segments differs in at
most ``l * max_bits / segments`` bits (rounded down). The first two segments of such a chain form the join key, with
the flips its budget allows put on one side; the budgets of the longer chains prune the candidates before the full
Hamming distance is checked, and a pair is kept only where its first valid chain starts, so no pair appears twice.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from reportloom.llm.components import components
from reportloom.llm.storage import Batches, batches_of, mapped, rows_of, stored

BITS = 64
SEED = 42
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: bytes | None, shingle: int) -> int:
    """Fingerprint of a UTF-8 text: A-Z lowered, words between ASCII white space, hashes by XXH64 with seed 42.

    A text with fewer words than a shingle has its whole word sequence as one shingle; no words give 0.
    """
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - size + 1]
    ends = ends[size - 1:]
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), HASHES_AT_ONCE):
        spans = map(slice, starts[at:at + HASHES_AT_ONCE].tolist(), ends[at:at + HASHES_AT_ONCE].tolist())
        hashes = np.array(list(map(xxh64_intdigest, map(joined.__getitem__, spans), repeat(SEED))), "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(starts), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """(key, fp): one row per document, fp the 64 bits as a signed long. NULL and empty texts have fp 0."""
    schema = pa.schema([("key", pa.int64()), ("fp", pa.int64())])

    def work(batches: Batches) -> Batches:
        rows = ((k, (f := fingerprint(t, shingle)) - (f >> 63 << 64)) for k, t in rows_of(batches, "key", "text"))
        return batches_of(rows, schema)

    picked = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return mapped(picked, work, "key long, fp long")


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment of the ring."""
    count = max_bits + 1
    borders = [round(BITS * i / count) for i in range(count + 1)]
    return [(low, high - low) for low, high in zip(borders, borders[1:], strict=False)]


def _bits(column: Column, segment: tuple[int, int]) -> Column:
    low, width = segment
    if width == BITS:
        return column
    return F.shiftrightunsigned(column, low).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _chains_hold(gaps: list[Column], start: int, max_bits: int) -> Column:
    """Whether all chains from ``start`` keep within their proportional budgets."""
    total, holds, count = F.lit(0), F.lit(True), len(gaps)
    for length in range(1, count + 1):
        total = total + gaps[(start + length - 1) % count]
        holds = holds & (total <= length * max_bits // count)
    return holds


def _flipped(start: int, x: Column, y: Column, width: int) -> Column:
    """Probe keys: the chain's own bits, and its second segment with each unset bit set."""
    masks = F.array(*[F.lit(e).cast("long") for e in [0] + [1 << b for b in range(width)]])
    return F.transform(F.filter(masks, lambda e: y.bitwiseAND(e) == 0), lambda e: F.struct(
        F.lit(start).alias("start"), x.alias("x"), y.bitwiseOR(e).alias("y"), (e != 0).alias("flipped")))


def linked_fingerprints(distinct: DataFrame, max_bits: int = 4) -> DataFrame:
    """(a, b): all pairs of distinct fingerprints (column fp) that differ in 1 to ``max_bits`` bits, each once."""
    ring = _segments(max_bits)
    if max_bits == 0:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("false")
    fp, keys, probes = F.col("fp"), [], []
    for i, first in enumerate(ring):
        second = ring[(i + 1) % len(ring)]
        keys.append(F.struct(F.lit(i).alias("start"), _bits(fp, first).alias("x"), _bits(fp, second).alias("y")))
        probes.append(_flipped(i, _bits(fp, first), _bits(fp, second), second[1] if 2 * max_bits // len(ring) else 0))
    index = distinct.select(fp.alias("b"), F.explode(F.array(*keys)).alias("k")).select("b", "k.*")
    probe = distinct.select(fp.alias("a"), F.explode(F.concat(*probes)).alias("k")).select("a", "k.*")
    gap = F.col("a").bitwiseXOR(F.col("b"))
    gaps = [F.bit_count(gap.bitwiseAND(F.lit(_signed(((1 << w) - 1) << low)).cast("long"))) for low, w in ring]
    first = F.lit(len(ring))
    for i in reversed(range(len(ring))):
        first = F.when(_chains_hold(gaps, i, max_bits), i).otherwise(first)
    met = probe.join(index, ["start", "x", "y"]).where(F.col("flipped") | (F.col("a") < F.col("b")))
    return met.where((first == F.col("start")) & (F.bit_count(gap) <= max_bits)).select("a", "b")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4,
                    max_bits: int = 4) -> DataFrame:
    """(key, fingerprint, component_id), one row per row of ``docs``.

    fingerprint: 16 hex digits. component_id: smallest key reachable over links of at most ``max_bits`` bits, itself
    included. NULL and empty texts share fingerprint 0, linked like any other. A row whose key is NULL gets the
    smallest key of its component, NULL if there is none. Rows repeated whole stay repeated. Other columns are ignored.
    """
    own = stored(fingerprints(docs, key, text, shingle), "fingerprints")
    return own.join(_components_of(own, max_bits), "fp").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _components_of(own: DataFrame, max_bits: int) -> DataFrame:
    """(fp, component_id, root) of every distinct fingerprint of (key, fp); root, one fingerprint of the component, tells
    apart components with the same smallest key."""
    classes = stored(own.groupBy("fp").agg(F.min("key").alias("head")), "classes")
    roots = stored(components(linked_fingerprints(classes.select("fp"), max_bits)), "components")
    least = (roots.join(classes, roots.node == classes.fp).groupBy("root").agg(F.min("head").alias("component_id")))
    linked = stored(roots.join(least, "root").select(F.col("node").alias("fp"), "component_id", "root"), "linked")
    return stored(classes.join(linked, "fp", "left").select(
        "fp", F.coalesce("component_id", "head").alias("component_id"), F.coalesce("root", "fp").alias("root")), "class-components")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one row of each component, the one with the smallest key; columns unchanged, whatever their names.

    Of several rows of a component with that key, the one that sorts first by text stays; a key with different texts can
    stay once in each of several components. Rows without a key stay only where their component has none with one, and
    then the first by text.
    """
    own = stored(fingerprints(docs, key, text, shingle), "fingerprints")
    found = _components_of(own, max_bits)
    again = stored(own.where("key IS NOT NULL").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "repeated")
    dropped = stored(own.join(found, "fp").where(F.col("key") != F.col("component_id")).select("key").distinct(), "dropped")
    names = {c: f"_doc_{i}" for i, c in enumerate(docs.columns)}  # so that none can be one of the operator's
    given = [F.col(name).alias(c) for c, name in names.items()]
    rows = docs.toDF(*names.values()).withColumn("key", F.col(names[key]).cast("long"))
    known = rows.where("key IS NOT NULL")
    single = known.join(again, "key", "left_anti").join(dropped, "key", "left_anti").select(*given)
    double = known.join(again, "key", "left_semi").unionByName(rows.where("key IS NULL")).select("key", F.struct(*given).alias("row"))
    return single.unionByName(_first_of_component(double, found, text, shingle))


def _first_of_component(rows: DataFrame, found: DataFrame, text: str, shingle: int) -> DataFrame:
    """The first row of each component whose smallest key is the row's own, by partial aggregates, so that a row repeated
    very often is never gathered. ``rows``: (key, row)."""
    def prints(texts: pa.Array) -> pa.Array:
        return pa.array([(f := fingerprint(t, shingle)) - (f >> 63 << 64)
                         for (t,) in rows_of(iter([pa.RecordBatch.from_arrays([texts], ["text"])]), "text")], pa.int64())

    own_text = F.col("row")[text]
    order = F.struct(own_text.isNull(), own_text, F.to_json("row"))  # JSON, as some types have no order
    own = rows.select("key", "row", order.alias("place"), F.arrow_udf(prints, "long")(own_text).alias("fp"))
    least = own.groupBy("key", "fp").agg(F.min_by("row", "place").alias("row"), F.min("place").alias("place"))
    met = least.join(found, "fp").where(F.col("key").eqNullSafe(F.col("component_id")))
    return met.groupBy("root").agg(F.min_by("row", "place").alias("row")).select("row.*")
