"""Exact top-k similarity join of two vector tables, block pairs pruned by the triangle inequality.

A corpus of more than one block is partitioned by its nearest pivots, and the cells are cut into rings by the distance
to their pivot. A ring is known by its pivot, its least and largest distance and its longest vector; from these follows
a bound of how near any of its vectors can be to a query. Every query first searches the rings that look best until
they hold k vectors; its k-th best score then rules out the rings whose bound is worse, and it searches the others.
Nothing is left out that could be among the k best, whatever the data: without structure in it, all rings are searched.

Neighbouring rings are bundled, so a query is sent once to all it searches there; bundles and rings of many rows are split
by hash, and so are the queries of a bundle, so every search is one bounded group. No pair leaves a task except the k best
of each query there that reach its border; these are merged over groups of blocks first, then per query.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportloom.session import fresh_folder

BLOCK_ROWS, BLOCK_BYTES = 50_000, 64 * 1024 * 1024  # largest block of either side
BUNDLES, LEAST_ASKED = 8, 2_000  # bundles a corpus of few rows is cut into, and queries a task gets at least
QUERY_ROWS = 2_048  # queries searched at once in a task
MERGED_BLOCKS = 64  # corpus blocks whose results for a query are merged first
CELLS = 2_000_000  # scores held at once in a task
PIVOTS, RINGS = 256, 64  # at most; their product bounds what the driver and the tasks know of the corpus
PIVOTS_A_BLOCK, RINGS_A_BLOCK = 4, 2
SLACK = 1e-9  # relative; far above the rounding errors of the bounds
DIGITS = 6  # of the scores given out; ranks use the full ones, ties go to the smaller id


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if not len(column):
        return np.empty((0, 0))
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    sizes = np.unique(column.value_lengths().to_numpy(zero_copy_only=False))
    if len(sizes) > 1:
        raise ValueError(f"vectors of different lengths: {sizes.tolist()}")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy()


def _keep_best(q: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int, largest: bool):
    order = np.lexsort((ids, -score if largest else score, q))
    q, ids, score = q[order], ids[order], score[order]
    starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
    within = np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)]))
    return q[within < k], ids[within < k], score[within < k]


def _candidates(queries: np.ndarray, part: np.ndarray, k: int, largest: bool, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query row, vector row) that can be among the k best and cost no more than the query's limit, by a fast
    score and a bound of its error. Distances are taken from the middle of the vectors: the error grows with lengths."""
    if not largest:
        middle = part.mean(0)
        queries, part = queries - middle, part - middle
    q_size, size = (queries**2).sum(1), (part**2).sum(1)
    error = 8 * (queries.shape[1] + 4) * np.finfo(float).eps
    gain = (queries if largest else 2.0 * queries) @ part.T  # with the vector's size and error: the most it can be
    gain += (error if largest else error - 1.0) * size
    least = -error * q_size - limit if largest else (1.0 - error) * q_size - limit
    free = np.flatnonzero(np.isinf(limit))
    if len(free) and len(part) > k:
        sure = (gain if len(free) == len(gain) else gain[free]) - 2.0 * error * size
        least[free] = np.partition(sure, len(part) - k, axis=1)[:, len(part) - k] - 2.0 * error * q_size[free]
    flat = np.flatnonzero(~(gain < least[:, None]).ravel())  # much faster than over two dimensions
    return flat // len(part), flat % len(part)


def _scores(queries: np.ndarray, part: np.ndarray, row: np.ndarray, col: np.ndarray, largest: bool) -> np.ndarray:
    """Scores of single pairs, the same for equal vectors wherever they stand; distances from differences."""
    out, step = np.empty(len(row)), max(1, CELLS // max(1, queries.shape[1]))
    for lo in range(0, len(row), step):
        a, b = queries[row[lo:lo + step]], part[col[lo:lo + step]]
        out[lo:lo + step] = (a * b).sum(1) if largest else ((a - b) ** 2).sum(1)
    return out


def _best_in_rings(queries: np.ndarray, wanted: np.ndarray, limit: np.ndarray, rings: list[tuple[np.ndarray, np.ndarray]],
                   k: int, largest: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best ids per query row among the (vectors, ids) of its wanted rings, worked off in slices of bounded size.

    ``limit`` is the cost no pair may exceed; the k-th best score found so far lowers it from slice to slice.
    """
    kept = []
    for lo in range(0, len(queries), QUERY_ROWS):
        block, asked, reach = queries[lo:lo + QUERY_ROWS], wanted[lo:lo + QUERY_ROWS], limit[lo:lo + QUERY_ROWS].copy()
        best = (np.empty(0, np.int64), rings[0][1][:0], np.empty(0))
        for number, (vectors, ids) in enumerate(rings):
            rows = np.flatnonzero(asked[:, number])
            mine, step = block if len(rows) == len(block) else block[rows], max(1, CELLS // max(1, len(rows)))
            for at in range(0, len(vectors) if len(rows) else 0, step):
                part = vectors[at:at + step]
                row, col = _candidates(mine, part, k, largest, reach[rows])
                if not len(row):
                    continue
                found = (rows[row], ids[at + col], _scores(mine, part, row, col, largest))
                best = _keep_best(*(np.concatenate(pair) for pair in zip(best, found)), k, largest)
                full = np.flatnonzero(np.bincount(best[0], minlength=len(block)) >= k)
                border = best[2][np.searchsorted(best[0], full, "right") - 1]
                reach[full] = np.minimum(reach[full], -border if largest else border)
        kept.append((best[0] + lo, *best[1:]))
    return tuple(np.concatenate(parts) for parts in zip(*kept))


def _finite(vector: str) -> Column:
    number = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    return F.col(vector).isNotNull() & F.forall(vector, number)


def _side(df: DataFrame, id_: str, vector: str, out: str) -> DataFrame:
    """Ids and finite vectors, written once: a side that an encoder makes is made once."""
    picked = df.select(F.col(id_).alias(f"{out}_id"), F.col(vector).alias(f"{out}_vec"))
    folder = fresh_folder(df.sparkSession, "vectors")
    picked.filter(F.col(f"{out}_id").isNotNull() & _finite(f"{out}_vec")).write.parquet(folder)
    return df.sparkSession.read.schema(picked.schema).parquet(folder)


def top_k(queries: DataFrame, corpus: DataFrame, k: int = 5, *, query_id: str = "query_id",
          corpus_id: str = "corpus_id", query_vector: str = "embedding", corpus_vector: str = "embedding",
          normalized: bool = True, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, corpus_id, score, rank) of the k nearest corpus rows per query.

    Inner product, largest first, on normalised vectors; squared distance, smallest
    first, otherwise. Fewer than k corpus rows give fewer results, equal scores go to the smaller id. Rows without an id or a
    vector, or with a NULL or non-finite number in it, take no part; all others must have one dimension.
    """
    left, right = _side(queries, query_id, query_vector, "q"), _side(corpus, corpus_id, corpus_vector, "c")
    longest = right.agg(F.max(F.size("c_vec"))).first()[0] or 1
    most = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * longest)))
    rows = min(block_rows, most)
    better = F.col("score").desc() if normalized else F.col("score").asc()

    def best(found: DataFrame, *group: str) -> DataFrame:
        ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(better, "c_id")))
        return ranked.filter(F.col("rank") <= k).drop("rank")

    grouped, rings = _grouped(right, rows)
    bundles = _bundles(rings, most)

    def searched(pairs: DataFrame) -> DataFrame:
        return best(_by_groups(pairs, grouped, rings, bundles, most, k, normalized), "q_id", "merged").drop("merged")

    if len(rings.rings) <= 1:
        found = searched(left.select("q_id", "q_vec", F.lit(None).cast("double").alias("border"), F.lit(0).alias("group"), F.unhex(F.lit("80")).alias("wanted")))
    else:
        first = best(_written(searched(_reached(left, rings, k, normalized, None, bundles)), "first-found"), "q_id")
        border = (F.min if normalized else F.max)("score")
        known = first.groupBy("q_id").agg(F.when(F.count(F.lit(1)) >= k, border).alias("border"))
        rest = _reached(left.join(known, "q_id", "left"), rings, k, normalized, "border", bundles)
        found = first.unionByName(searched(rest))
    return best(found, "q_id").withColumn("rank", F.row_number().over(Window.partitionBy("q_id").orderBy(better, "c_id"))).select(
        F.col("q_id").alias(query_id), F.col("c_id").alias(corpus_id), F.round("score", DIGITS).alias("score"), "rank"
    )


class Ring(NamedTuple):
    """What is known of the vectors of a ring: its pivot, their number, distances to the pivot, and largest length."""

    pivot: int
    rows: int
    near: float
    far: float
    long: float


class Rings(NamedTuple):
    pivots: np.ndarray
    rings: list[Ring]


def _written(df: DataFrame, name: str) -> DataFrame:
    folder = fresh_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _mapped(df: DataFrame, more: list[tuple[str, pa.DataType, T.DataType]], work: Callable[[pa.RecordBatch], Iterator[tuple]]) -> DataFrame:
    """Adds columns; ``work`` yields (rows to keep, their values) for a batch, in parts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kept, *columns in work(batch):
                taken = pa.Table.from_batches([batch]).take(pa.array(kept, pa.int64()))
                for (name, kind, _), values in zip(more, columns):
                    taken = taken.append_column(name, pa.array(values, kind))
                yield from taken.to_batches()

    schema = T.StructType([*df.schema.fields, *[T.StructField(name, kind) for name, _, kind in more]])
    return df.mapInArrow(run, schema)


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """From differences, so that they are right far from the origin, too."""
    if vectors.shape[1] != pivots.shape[1]:
        raise ValueError(f"queries have {vectors.shape[1]} dimensions, the corpus {pivots.shape[1]}")
    out, step = np.empty((len(vectors), len(pivots))), max(1, CELLS // max(1, vectors.shape[1]))
    for j, pivot in enumerate(pivots):
        for lo in range(0, len(vectors), step):
            out[lo:lo + step, j] = np.sqrt(((vectors[lo:lo + step] - pivot) ** 2).sum(1))
    return out


def _grouped(corpus: DataFrame, rows: int) -> tuple[DataFrame, Rings]:
    """The corpus with the number of each row's ring (group), and what is known of the rings.

    Pivots are the vectors first by a hash of their id; a corpus of one block is one ring without a pivot.
    """
    count = corpus.count()
    if count <= rows:
        return corpus.withColumn("group", F.lit(0)), Rings(np.empty((0, 0)), [Ring(0, count, 0.0, 0.0, 0.0)] if count else [])
    wanted = min(PIVOTS, PIVOTS_A_BLOCK * -(-count // rows))
    drawn = corpus.orderBy(F.xxhash64("c_id"), "c_id").limit(wanted).select("c_vec").collect()  # PIVOTS vectors at most
    if len({len(r.c_vec) for r in drawn}) > 1:
        raise ValueError(f"vectors of different lengths: {sorted({len(r.c_vec) for r in drawn})}")
    pivots = np.unique(np.array([r.c_vec for r in drawn], np.float64), axis=0)

    def nearest(batch: pa.RecordBatch) -> Iterator[tuple]:
        vectors = _matrix(batch.column("c_vec"))
        step = max(1, CELLS // len(pivots))
        for lo in range(0, len(vectors), step):
            part = vectors[lo:lo + step]
            apart = _distances(part, pivots)
            cell = apart.argmin(1)
            yield np.arange(lo, lo + len(part)), cell, apart[np.arange(len(part)), cell], np.sqrt((part**2).sum(1))

    doubles = [(name, pa.float64(), T.DoubleType()) for name in ("apart", "long")]
    placed = _written(_mapped(corpus, [("cell", pa.int32(), T.IntegerType()), *doubles], nearest), "cells")
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("apart").alias("low"), F.max("apart").alias("high"))
    wide = F.least(F.lit(RINGS), F.greatest(F.lit(1), F.ceil(F.col("n") * RINGS_A_BLOCK / rows))).cast("int")
    known = F.broadcast(cells.select("cell", "low", wide.alias("rings"), ((F.col("high") - F.col("low")) / wide).alias("width")))  # a row per pivot
    ring = F.when(F.col("width") > 0, F.least(F.floor((F.col("apart") - F.col("low")) / F.col("width")), F.col("rings") - 1)).otherwise(0).cast("int")
    ringed = placed.join(known, "cell").withColumn("ring", ring)
    met = ringed.groupBy("cell", "ring").agg(F.count(F.lit(1)).alias("n"), F.min("apart").alias("near"), F.max("apart").alias("far"), F.max("long").alias("long"))
    found = sorted(map(tuple, met.collect()))  # PIVOTS * RINGS rows at most
    numbers = corpus.sparkSession.createDataFrame([(c, r, i) for i, (c, r, *_) in enumerate(found)], "cell int, ring int, group int")
    grouped = ringed.join(F.broadcast(numbers), ["cell", "ring"]).select("c_id", "c_vec", "group")
    return _written(grouped, "rings"), Rings(pivots, [Ring(c, *rest) for c, _, *rest in found])


def _bounds(queries: np.ndarray, rings: Rings, largest: bool) -> np.ndarray:
    """The least cost (squared distance, or negated product) any vector of each ring can have for each query."""
    apart = _distances(queries, rings.pivots)
    which = np.array([r.pivot for r in rings.rings])
    near, far, long = (np.array([getattr(r, name) for r in rings.rings]) for name in ("near", "far", "long"))
    apart = apart[:, which]
    least = np.maximum(0.0, np.maximum(apart - far, near - apart) - SLACK * (apart + far))
    if not largest:
        return least**2
    size = np.sqrt((queries**2).sum(1))[:, None]
    by_pivot = (queries @ rings.pivots.T)[:, which] + size * far
    by_distance = (size**2 + long**2 - least**2) / 2
    # q.x is q.p + q.(x - p), and (|q|^2 + |x|^2 - |q - x|^2) / 2.
    lengths = np.sqrt((rings.pivots**2).sum(1))[which]
    return -(np.minimum(by_pivot, by_distance) + SLACK * (size**2 + long**2 + size * (lengths + far)))


def _bundles(rings: Rings, most: int) -> list[tuple[int, int]]:
    """Neighbouring rings (first, one behind the last) that are searched in one task, so that a query goes there once:
    an eighth of the corpus, ``most`` vectors at most unless one ring has more."""
    wide = min(most, -(-sum(r.rows for r in rings.rings) // BUNDLES))
    bundles, held = [], 0
    for number, ring in enumerate(rings.rings):
        if bundles and held + ring.rows <= wide:
            bundles[-1], held = (bundles[-1][0], number + 1), held + ring.rows
        else:
            bundles.append((number, number + 1))
            held = ring.rows
    return bundles


def _reached(queries: DataFrame, rings: Rings, k: int, largest: bool, border: str | None,
             bundles: list[tuple[int, int]] | None = None) -> DataFrame:
    """(q_id, q_vec, border, group, wanted): the bundles of rings (of one each if not given) a query goes to, and a bit per
    ring it searches there. Without ``border`` these are the rings that look best, until they hold k vectors; with it all
    others that may hold a vector as good as the query's border, all if it has none."""
    sizes = np.array([r.rows for r in rings.rings])
    bundles = bundles or [(i, i + 1) for i in range(len(sizes))]

    def work(batch: pa.RecordBatch) -> Iterator[tuple]:
        vectors = _matrix(batch.column("q_vec"))
        held = batch.column(border).to_numpy(zero_copy_only=False).astype(np.float64) if border else None
        step = max(1, CELLS // len(sizes))
        for lo in range(0, len(vectors), step):
            part = vectors[lo:lo + step]
            cost = _bounds(part, rings, largest)
            order = np.argsort(cost, axis=1, kind="stable")
            before = np.cumsum(sizes[order], axis=1) - sizes[order]
            first = np.empty_like(cost, dtype=bool)
            np.put_along_axis(first, order, before < k, axis=1)
            wanted = first
            if held is not None:
                limit = held[lo:lo + step]
                limit = np.where(np.isnan(limit), np.inf, -limit if largest else limit)
                wanted = ~first & (cost <= limit[:, None] + SLACK * np.abs(np.where(np.isinf(limit), 0.0, limit))[:, None])
            for number, (start, end) in enumerate(bundles):
                row = np.flatnonzero(wanted[:, start:end].any(1))
                if len(row):
                    bits = np.packbits(wanted[row, start:end], axis=1)
                    yield row + lo, np.full(len(row), number, np.int32), [b.tobytes() for b in bits]

    asked = queries if border else queries.withColumn("border", F.lit(None).cast("double"))
    found = _mapped(asked, [("group", pa.int32(), T.IntegerType()), ("wanted", pa.binary(), T.BinaryType())], work)
    return _written(found.select("q_id", "q_vec", F.col(border or "border").alias("border"), "group", "wanted"), "reached")


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _by_groups(pairs: DataFrame, corpus: DataFrame, rings: Rings, bundles: list[tuple[int, int]], most: int, k: int,
               largest: bool) -> DataFrame:
    """(q_id, c_id, score, merged): the k best of every query in each block of the bundles it is paired with."""
    asked = {r["group"]: r["n"] for r in pairs.groupBy("group").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per bundle
    cuts = {}
    for group, n in asked.items():
        if group < len(bundles):
            start, end = bundles[group]
            few = min(most, max(LEAST_ASKED, -(-n // BUNDLES)))
            cuts[group] = -(-n // few), -(-sum(r.rows for r in rings.rings[start:end]) // most)
    by_bundle = [(g, g, 0, *cut) for g, cut in cuts.items()]
    by_ring = [(i, g, i - bundles[g][0], *cut) for g, cut in cuts.items() for i in range(*bundles[g])]

    def cut(df: DataFrame, known: list[tuple], id_: str, mine: str, other: str) -> DataFrame:
        names = ["bundle", "place", "q_blocks", "c_blocks"]
        if len(known) == 1:
            met = df.where(F.col("group") == known[0][0]).withColumns({n: F.lit(v) for n, v in zip(names, known[0][1:])})
        else:
            table = df.sparkSession.createDataFrame(known, ", ".join(f"{n} int" for n in ["group", *names]))
            met = df.join(F.broadcast(table), "group")  # a row per ring
        return met.withColumn(mine, F.pmod(F.xxhash64(id_), F.col(f"{mine}s")).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1))).drop("group", "q_blocks", "c_blocks")

    schema = T.StructType([
        T.StructField("q_id", pairs.schema["q_id"].dataType), T.StructField("c_id", corpus.schema["c_id"].dataType),
        T.StructField("score", T.DoubleType()), T.StructField("merged", T.IntegerType()),
    ])
    arrow = _arrow_schema(schema)

    def search(q: pa.Table, c: pa.Table) -> pa.Table:
        if not q.num_rows or not c.num_rows:
            return arrow.empty_table()
        queries, vectors, ids, place = _matrix(q["q_vec"]), _matrix(c["c_vec"]), _ids(c["c_id"]), c["place"].to_numpy()
        if queries.shape[1] != vectors.shape[1]:
            raise ValueError(f"queries have {queries.shape[1]} dimensions, the corpus {vectors.shape[1]}")
        limit = q["border"].to_numpy().astype(np.float64)
        limit = np.where(np.isnan(limit), np.inf, -limit if largest else limit)
        bits = np.frombuffer(b"".join(q["wanted"].to_pylist()), np.uint8).reshape(len(queries), -1)
        order = np.argsort(place, kind="stable")
        places, starts = np.unique(place[order], return_index=True)
        cells = [(vectors[rows], ids[rows]) for rows in np.split(order, starts[1:])]
        row, ids, score = _best_in_rings(queries, np.unpackbits(bits, axis=1)[:, places].astype(bool), limit, cells, k, largest)
        merged = np.full(len(row), (c["bundle"][0].as_py() * 31 + c["c_block"][0].as_py()) // MERGED_BLOCKS, np.int32)
        columns = [pa.array(_ids(q["q_id"])[row], arrow.field(0).type), pa.array(ids, arrow.field(1).type), pa.array(score), pa.array(merged)]
        return pa.Table.from_arrays(columns, schema=arrow)

    keys = ["bundle", "q_block", "c_block"]
    return cut(pairs, by_bundle, "q_id", "q_block", "c_block").groupBy(*keys).cogroup(
        cut(corpus, by_ring, "c_id", "c_block", "q_block").groupBy(*keys)).applyInArrow(search, schema)
