"""Seeded splits with exact sizes and dense row numbers, without a global sort.

Rows are ordered by ``md5(seed:key)``. A histogram over the hash's first digits
tells which few buckets hold the borders; only those buckets are ranked. The
split itself is then a comparison with the border values in each row. Rows whose key
is NULL or repeated get a number of their own behind it, so they spread like all others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportloom.session import fresh_folder

HEX_DIGITS = 4  # 65,536 buckets: the histogram stays small, a bucket holds n/65,536 rows
MOST_DIGITS = 5  # about a million histogram rows, the most that are summed in one task and broadcast
LOW_BITS = 33  # of Spark's increasing ids: the row within its partition


def written(df: DataFrame, name: str) -> DataFrame:
    folder = fresh_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def with_row_id(df: DataFrame, *, out: str = "row_id") -> DataFrame:
    """The rows, written once, with a unique number each: it stays the same however often they are read."""
    return written(df.withColumn(out, F.monotonically_increasing_id()), "rows")


def with_row_number(df: DataFrame, *, out: str = "row_number") -> DataFrame:
    """Rows numbered from 0 in the order they are read in; no sort, partitions are shifted by those before."""
    rows = with_row_id(df, out="__id")
    part = F.shiftright("__id", LOW_BITS)
    sizes = rows.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("n"))
    # One row per partition of the input.
    before = F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    shifted = rows.withColumn("__part", part).join(F.broadcast(sizes.select("__part", before.alias("__before"))), "__part")
    within = F.col("__id").bitwiseAND(F.lit((1 << LOW_BITS) - 1))
    return shifted.withColumn(out, F.col("__before") + within).drop("__id", "__part", "__before")


def with_own_key(df: DataFrame, *, key: str, keys: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows with a text ``__key`` that no other row has, and a table of these keys alone.

    It is ``key`` itself, or, where that is NULL or repeated, with a row number; only then are the rows written.
    ``keys`` may give the key column as a table of its own.
    """
    counted = (df if keys is None else keys).groupBy(F.col(key).alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
    shared = counted.filter((F.col("__n") > 1) | F.col("__k").isNull()).drop("__n")
    plain = F.col(key).cast("string")
    if shared.isEmpty():
        return df.withColumn("__key", plain), (df if keys is None else keys).select(plain.alias("__key"))
    shared = written(shared, "shared-keys")
    rows = with_row_id(df, out="__id").join(shared.withColumn("__shared", F.lit(True)), F.col(key).eqNullSafe(F.col("__k")), "left")
    numbered = F.concat(F.coalesce(plain, F.lit("")), F.lit("#"), F.col("__id"))
    own = rows.withColumn("__key", F.when(F.col("__shared"), numbered).otherwise(plain)).drop("__id", "__k", "__shared")
    return own, own.select("__key")


def order_hash(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def _histogram(df: DataFrame, key: str, seed: int, digits: int) -> DataFrame:
    """(bucket, rows, upto, total): at most ``16 ** digits`` rows, so one task may sum them up."""
    if not 1 <= digits <= MOST_DIGITS:
        raise ValueError(f"digits must lie in 1..{MOST_DIGITS}")
    counts = df.groupBy(F.substring(order_hash(F.col(key), seed), 1, digits).alias("__bucket")).agg(
        F.count("*").alias("rows")
    )
    running = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return counts.select(
        "__bucket", "rows", F.sum("rows").over(running).alias("upto"), F.sum("rows").over(everything).alias("total")
    )


def assign_by_rank(df: DataFrame, sizes: Sequence[tuple[str, Column]], *, key: str, rest: str,
                   seed: int = 42, out: str = "split", digits: int = HEX_DIGITS,
                   keys: DataFrame | None = None) -> DataFrame:
    """Label rows in hash order: the first ``sizes[0]`` rows, the next ``sizes[1]``, ..., then ``rest``.

    A size is an expression over the row count ``total``. Sizes are exact whatever the keys are;
    rows of one key may come apart. ``keys`` may give the key column of ``df`` as a table of its
    own, which is cheaper to read twice.
    """
    columns = df.columns
    df, keys = with_own_key(df, key=key, keys=keys)
    key = "__key"
    totals = _histogram(keys, key, seed, digits)
    borders = []
    upto = F.lit(0).cast("bigint")
    for label, size in sizes:
        upto = upto + size.cast("bigint")
        borders.append(F.struct(F.lit(label).alias("label"), upto.alias("target")))
    holding = (
        totals.select("__bucket", "rows", "upto", F.explode(F.array(*borders)).alias("b"))
        .filter((F.col("b.target") > F.col("upto") - F.col("rows")) & (F.col("b.target") <= F.col("upto")))
        .select("__bucket", F.col("b.label").alias("label"), (F.col("b.target") - F.col("upto") + F.col("rows")).alias("rank"))
    )
    hashed = keys.select(order_hash(F.col(key), seed).alias("h"), F.col(key).alias("k"))
    # ``holding`` has one row per border, hence the broadcast.
    near = hashed.withColumn("__bucket", F.substring("h", 1, digits)).join(
        F.broadcast(holding), "__bucket"
    )
    place = F.row_number().over(Window.partitionBy("label").orderBy("h", "k"))
    cuts = near.withColumn("upto", place).filter(F.col("upto") >= F.col("rank"))
    here = F.struct(order_hash(F.col(key), seed).alias("h"), F.col(key).alias("k"))
    cut_of = {label: F.min(F.when(F.col("label") == label, F.struct("h", "k"))).alias(label) for label, _ in sizes}
    cut = cuts.agg(*cut_of.values()).select(F.struct(*cut_of)).scalar()
    assigned = F.lit(rest)
    for label, _ in reversed(sizes):
        assigned = F.when(F.coalesce(here <= cut[label], F.lit(False)), label).otherwise(assigned)
    return df.withColumn(out, assigned).select(*[F.col(f"`{c}`") for c in columns if c != out], out)


def three_way_split(df: DataFrame, *, key: str, first: float = 0.2, second: float = 0.4, seed: int = 42,
                    labels: tuple[str, str, str] = ("simple", "medium", "cot"), out: str = "split",
                    keys: DataFrame | None = None) -> DataFrame:
    """``first`` of all rows, ``second`` of the remaining ones, then the rest; counts round half to even."""
    if not (0.0 < first < 1.0 and 0.0 < second < 1.0 and first + second < 1.0):
        raise ValueError("fractions must lie in (0, 1) and sum to less than 1")
    total = F.col("total")
    n_first = F.rint(total * F.lit(first))
    n_second = F.rint((total - n_first) * F.lit(second))
    return assign_by_rank(df, [(labels[0], n_first), (labels[1], n_second)], key=key, rest=labels[2], seed=seed, out=out,
                          keys=keys)


def train_eval_split(df: DataFrame, *, key: str, test_size: float = 0.1, seed: int = 42, enabled: bool = True,
                     out: str = "split", keys: DataFrame | None = None) -> DataFrame:
    """``eval`` gets ceil(n * test_size) rows, ``train`` the others; disabled: all ``train``."""
    if not enabled:
        return df.withColumn(out, F.lit("train"))
    if not 0.0 < test_size < 1.0:
        raise ValueError("test_size must lie in (0, 1)")
    return assign_by_rank(
        df, [("eval", F.ceil(F.col("total") * F.lit(test_size)))], key=key, rest="train", seed=seed, out=out,
        keys=keys,
    )


def number_rows(df: DataFrame, *, key: str, seed: int = 42, out: str = "orig_index",
                digits: int = HEX_DIGITS, keys: DataFrame | None = None) -> DataFrame:
    """Dense numbers from 0 in hash order.

    Every bucket is ranked by itself and shifted by the rows before it. A bucket holds about
    n / 16**digits rows, which sort in one task. Rows with a NULL or repeated key count like all others.
    """
    df, keys = with_own_key(df, key=key, keys=keys)
    key = "__key"
    shifts = _histogram(keys, key, seed, digits).select("__bucket", (F.col("upto") - F.col("rows")).alias("__before"))
    hashed = df.withColumn("__h", order_hash(F.col(key), seed)).withColumn("__bucket", F.substring("__h", 1, digits))
    ranked = hashed.withColumn(
        "__n", F.row_number().over(Window.partitionBy("__bucket").orderBy("__h", F.col(key))) - 1
    )
    # at most 16 ** digits rows
    joined = ranked.join(F.broadcast(shifts), "__bucket")
    return joined.withColumn(out, F.col("__before") + F.col("__n")).drop("__h", "__n", "__before", "__bucket", "__key")


def split_sizes(df: DataFrame, *, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(F.count("*").alias("n"))
