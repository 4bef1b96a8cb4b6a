"""Near-duplicate vectors by randomly rotated binary codes with stored correction factors.

A unit vector is rotated at random; its code is the signs of the result, and the inner product of vector and code
vector is stored with it. For another vector, rotated the same way and rounded at random to four bits, the inner
product with the code vector over that factor estimates the cosine without bias, by bit operations alone. The
estimate's error is bounded with a confidence set by ``DEVIATIONS``: pairs whose upper bound misses the threshold are
done, all others are recomputed exactly in double precision.

Pairs meet in hash tables keyed by signs of random projections. The number of bits per key follows from the number of
vectors (about ``BUCKET`` vectors a bucket), the number of tables from the recall wanted for a pair right at the
threshold. A pair counts in the first table where it meets, so links can be counted without writing pairs: a bucket
yields counts and a spanning forest. Buckets beyond ``BLOCK`` vectors are cut into blocks and all pairs of blocks meet
in groups of their own. Equal vectors form a class first and count with their number.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportloom.llm.components import components
from reportloom.llm.storage import Batches, mapped, stored

SEED = 20_240_501
PLANES = 4
DEVIATIONS = 4.0
RECALL = 0.999
BUCKET = 32
BLOCK = 1024
ROWS_AT_ONCE = 4096


@functools.cache
def rotation(size: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every process."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, size]).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


@functools.cache
def projections(size: int, count: int) -> np.ndarray:
    return np.random.default_rng([SEED, size, count]).standard_normal((size, count))


def table_plan(vectors: int, threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """Bits per key and number of tables: a pair right at ``threshold`` meets with probability ``recall`` at least."""
    bits = min(62, max(1, math.ceil(math.log2(max(vectors, 2) / BUCKET))))
    meets = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meets))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision, safe for very large and very small numbers."""
    rows = vectors.astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    padded = np.zeros((len(bits), -(-bits.shape[1] // 64) * 64), bool)
    padded[:, :bits.shape[1]] = bits
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


def encoded(units: np.ndarray) -> tuple[np.ndarray, ...]:
    """Code words, correction factor, bit planes of the rounded rotated vector, its lowest value, step and sum."""
    size = units.shape[1]
    turned = units @ rotation(size).T
    codes = packed(turned >= 0)
    factor = np.abs(turned).sum(axis=1) / math.sqrt(size)
    low = turned.min(axis=1)
    step = np.maximum((turned.max(axis=1) - low) / (2 ** PLANES - 1), 1e-12)
    drawn = np.random.default_rng([SEED, size, 1]).random(size)
    levels = np.floor((turned - low[:, None]) / step[:, None] + drawn).clip(0, 2 ** PLANES - 1).astype(np.int64)
    planes = np.stack([packed((levels >> j & 1).astype(bool)) for j in range(PLANES)], axis=1)
    return codes, factor, planes, low, step, low * size + step * levels.sum(axis=1)


def upper_bounds(left: tuple[np.ndarray, ...], right: tuple[np.ndarray, ...], size: int) -> np.ndarray:
    """Upper confidence bounds of all cosines between rows of ``left`` (by their codes) and ``right`` (rounded)."""
    codes, factor = left[0], left[1][:, None]
    _, _, planes, low, step, total = right
    hits = np.zeros((len(codes), len(planes)))
    for j in range(PLANES):
        for w in range(codes.shape[1]):
            hits += np.bitwise_count(codes[:, None, w] & planes[None, :, j, w]).astype(np.float64) * 2 ** j
    set_bits = np.bitwise_count(codes).sum(axis=1)[:, None]
    estimate = (2 * (low * set_bits + step * hits) - total) / math.sqrt(size) / factor
    spread = np.sqrt(np.maximum(1 - factor ** 2, 0) / max(size - 1, 1)) / factor + step / 2 / factor
    return estimate + DEVIATIONS * spread


def _vectors(column: pa.Array) -> np.ndarray:
    """Vectors of one length held as bytes of doubles."""
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), -1)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, size, raw): raw the doubles of the vector as bytes; NULL for vectors that link with nothing."""
    schema = pa.schema([("key", pa.int64()), ("size", pa.int32()), ("raw", pa.binary())])

    def work(batches: Batches) -> Batches:
        for batch in batches:
            raw, sizes = [], []
            for values in batch.column("vector").to_pylist():
                row = np.array(values, np.float64) if values and None not in values else np.zeros(0)
                good = len(row) and np.isfinite(row).all() and row.any()
                raw.append((row + 0.0).astype("<f8").tobytes() if good else None)  # + 0.0: one zero only
                sizes.append(len(row))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(sizes, pa.int32()), pa.array(raw, pa.binary())], schema=schema)

    picked = vectors.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    return mapped(picked, work, "key long, size int, raw binary")


def _keyed(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    """The classes with the keys of all tables, as bytes of 64-bit numbers."""
    schema = pa.schema([("class", pa.int64()), ("size", pa.int32()), ("raw", pa.binary()), ("n", pa.int64()), ("keys", pa.binary())])
    powers = (1 << np.arange(bits, dtype=np.int64))

    def work(batches: Batches) -> Batches:
        for batch in batches:
            keys: list = [None] * batch.num_rows
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                signs = unit(_vectors(batch.column("raw").take(pa.array(rows)))) @ projections(int(size), bits * tables) >= 0
                numbers = signs.reshape(len(rows), tables, bits) @ powers
                for at, own in zip(rows, numbers.astype("<i8"), strict=True):
                    keys[at] = own.tobytes()
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("class", "size", "raw", "n")), pa.array(keys, pa.binary())], schema=schema)

    return mapped(classes.select("class", "size", "raw", "n"), work, "class long, size int, raw binary, n long, keys binary")


def _placed(keyed: DataFrame, tables: int) -> DataFrame:
    """A row per class and table (column spot); rows of large buckets once per pair of blocks (p <= q) they are in."""
    word = F.substring(F.col("keys"), F.col("t") * 8 + 1, F.lit(8))
    spread = keyed.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(tables - 1)))).withColumn("spot", F.xxhash64("size", "t", word))
    crowded = stored(spread.groupBy("t", "spot").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > BLOCK)
                     .select(F.col("t").alias("ct"), F.col("spot").alias("cspot"), F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")), "crowded")
    met = spread.join(crowded, (F.col("t") == F.col("ct")) & (F.col("spot") == F.col("cspot")), "left")
    blocks = F.coalesce("blocks", F.lit(1))
    block = F.pmod(F.xxhash64("class"), blocks).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), blocks - 1), lambda o: F.struct(F.least(block, o).alias("p"), F.greatest(block, o).alias("q")))
    return met.select("class", "size", "raw", "n", "keys", "t", "spot", block.alias("block"), F.explode(pairs).alias("pq")).select("*", "pq.p", "pq.q").drop("pq")


def _runs(batches: Batches, names: list[str]) -> Iterator[pa.Table]:
    """The rows of one group after the other, from batches sorted by the group's columns."""
    held: list[pa.Table] = []
    mark = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        marks = np.stack([batch.column(n).to_numpy().astype(np.int64) for n in names], axis=1)
        cuts = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1).tolist(), len(marks)]
        for first, last in zip(cuts, cuts[1:], strict=False):
            if held and tuple(marks[first]) != mark:
                yield pa.concat_tables(held)
                held = []
            mark = tuple(marks[first])
            held.append(table.slice(first, last - first))
    if held:
        yield pa.concat_tables(held)


def _forest(linked: np.ndarray) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest of the graph with the given links (row numbers a, b)."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    for a, b in linked:
        ra, rb = root(int(a)), root(int(b))
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
            yield int(a), int(b)


def links_of(group: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (a, b) of the pairs of a group that link and that no earlier table brings together."""
    size = group["size"][0].as_py()
    units = unit(_vectors(group["raw"].combine_chunks()))
    keys = np.frombuffer(b"".join(group["keys"].to_pylist()), "<i8").reshape(len(group), -1)[:, :group["t"][0].as_py()]
    block, p, q = group["block"].to_numpy(), group["p"][0].as_py(), group["q"][0].as_py()
    left, right = np.flatnonzero(block == p), np.flatnonzero(block == q)
    codes = encoded(units)
    found = upper_bounds(tuple(c[left] for c in codes), tuple(c[right] for c in codes), size) >= threshold
    if p == q:
        found = np.triu(found, 1)
    a, b = np.nonzero(found)
    a, b = left[a], right[b]
    keep = [np.zeros(0, bool)]
    for at in range(0, len(a), ROWS_AT_ONCE):
        x, y = a[at:at + ROWS_AT_ONCE], b[at:at + ROWS_AT_ONCE]
        keep.append(((units[x] * units[y]).sum(axis=1) >= threshold) & ~(keys[x] == keys[y]).any(axis=1))
    keep = np.concatenate(keep)
    return a[keep], b[keep]


def _bucket_links(placed: DataFrame, threshold: float) -> DataFrame:
    """(a, b, links): links of class a (b NULL), and edges (a, b) of a forest of each bucket (links NULL)."""
    group = ["t", "spot", "p", "q"]
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])

    def work(batches: Batches) -> Batches:
        for rows in _runs(batches, group):
            if len(rows) < 2:
                continue
            a, b = links_of(rows, threshold)
            if not len(a):
                continue
            names, n = rows["class"].to_numpy(), rows["n"].to_numpy()
            counts = np.zeros(len(rows), np.int64)
            np.add.at(counts, a, n[b])
            np.add.at(counts, b, n[a])
            some = np.flatnonzero(counts)
            edges = [(int(names[x]), int(names[y]), None) for x, y in _forest(np.stack([a, b], axis=1))]
            out = [*((int(names[x]), None, int(counts[x])) for x in some), *edges]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=schema)

    dealt = placed.repartition(*group).sortWithinPartitions(*group)
    return mapped(dealt, work, "a long, b long, links long")


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """(key, n_links, component_id, kept), one row per row of ``vectors``.

    n_links: other vectors with a cosine of at least ``threshold``. component_id: smallest key reachable by links,
    itself included; kept: that key is the row's own. Vectors that are NULL, empty, zero, or hold NULL or non-finite
    numbers link with nothing, nor do vectors of different lengths. Equal vectors, repeated rows included, link with
    each other. A NULL key counts as a vector; its component_id is the smallest key of the others, else NULL, and it
    is kept only if that is NULL. Other columns are ignored.
    """
    rows = stored(usable(vectors, key, vector), "vectors")
    grouped = rows.where("raw IS NOT NULL").groupBy("raw").agg(F.min("key").alias("head"), F.count(F.lit(1)).alias("n"), F.first("size").alias("size"))
    classes = stored(grouped.withColumn("class", F.monotonically_increasing_id()), "vector-classes")
    bits, tables = table_plan(classes.count(), threshold)
    placed = _placed(stored(_keyed(classes, bits, tables), "vector-keys"), tables)
    links = stored(_bucket_links(placed, threshold), "vector-links")
    counts = links.where("b IS NULL").groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    roots = components(links.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "class")
    rooted = stored(classes.select("class", "raw", "head", "n").join(counts, "class", "left").join(roots, "class", "left")
                    .withColumn("root", F.coalesce("root", "class")), "vector-roots")
    least = rooted.groupBy("root").agg(F.min("head").alias("component_id"))
    named = stored(rooted.join(least, "root").select("raw", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"),
                   "vector-components")
    found = rows.where("raw IS NOT NULL").join(named, "raw").select("key", "n_links", "component_id")
    alone = rows.where("raw IS NULL").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    return found.unionByName(alone).select(
        F.col("key").alias(key), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))
