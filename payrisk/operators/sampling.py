"""Train/test splits and class-preserving samples.

The stable forms decide row by row from a hash of the row's key: no shuffle, no sort,
and the same answer after a retry, a repartition or in another engine.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payrisk.functions.numeric import HASH_SPACE, row_hash32, stable_hash32
from payrisk.operators.prefix_sums import running_totals
from payrisk.schema import SPLIT_SEED, TRAIN_FRACTION
from payrisk.session import current_workspace

DIGIT_BITS = 16
SKETCH_SIZE = 8192
BRACKET = 0.002  # share of the rows on either side of the cut; the sketch is off by 0.0007

# Samples draw on another hash than splits, or every sampled row would be a training row.
SAMPLE_SALT = "sample:"


def _hash(df: DataFrame, key: str | None, salt: str = "") -> Column:
    return stable_hash32(F.col(key), salt) if key else row_hash32(df.columns, salt)


def head_transactions(df: DataFrame, n: int) -> DataFrame:
    """The first n rows a scan returns; each task stops after n rows of its own."""
    return df.limit(n)


def with_split(
    df: DataFrame, key: str | None = None, train_fraction: float = TRAIN_FRACTION
) -> DataFrame:
    """Add ``split`` = train or test, fixed by the key (or by the whole row without one)."""
    cut = math.ceil(train_fraction * HASH_SPACE)
    return df.withColumn("split", F.when(_hash(df, key) < cut, "train").otherwise("test"))


def split_by_key(
    df: DataFrame, key: str | None = None, train_fraction: float = TRAIN_FRACTION
) -> tuple[DataFrame, DataFrame]:
    marked = with_split(df, key, train_fraction)
    return (
        marked.filter(F.col("split") == "train").drop("split"),
        marked.filter(F.col("split") == "test").drop("split"),
    )


def split_random(
    df: DataFrame, train_fraction: float = TRAIN_FRACTION, seed: int = SPLIT_SEED
) -> tuple[DataFrame, DataFrame]:
    """Spark's own split. It sorts every partition and depends on the partitioning."""
    train, test = df.randomSplit([train_fraction, 1 - train_fraction], seed=seed)
    return train, test


def downsample_keep_fraud(df: DataFrame, fraction: float, key: str | None = None) -> DataFrame:
    """All predicted frauds and the given fraction of the others, by hash threshold: a filter.

    Rows without a prediction are in no class and in no sample, whatever its size.
    """
    cut = math.ceil(fraction * HASH_SPACE)
    safe = F.col("prediction") == 0
    return df.filter((F.col("prediction") == 1) | (safe & (_hash(df, key, SAMPLE_SALT) < cut)))


def downsample_exact(
    df: DataFrame,
    limit: int | None = None,
    key: str | None = None,
    fraction: float | None = None,
) -> DataFrame:
    """All predicted frauds and as many others as make ``limit`` rows, or exactly the given
    fraction of the others (rounded down).

    The others kept are the first in one order: hash of the key, then hash of the row. A
    mergeable quantile sketch of the first hash brackets the place where the quota runs out;
    one more pass counts the rows below the bracket and those at each place inside it, and the
    answer is a filter on that place. Should the sketch have missed (it is random), 16-bit
    slices of the order are counted instead, as often as needed. Only copies of one row share a
    place; they are counted, not listed. Two passes read the table before the answer's own, so
    give it a stored one. Rows without a prediction are in no sample.
    """
    fraud, safe = F.col("prediction") == 1, F.col("prediction") == 0
    order = [_hash(df, key, SAMPLE_SALT), F.xxhash64(*df.columns)]

    first = df.filter(fraud | safe).agg(
        F.count_if(fraud).alias("frauds"),
        F.count_if(safe).alias("others"),
        F.kll_sketch_agg_bigint(F.when(safe, order[0]), F.lit(SKETCH_SIZE)).alias("sketch"),
    )
    first = current_workspace(df.sparkSession).stored(first, "sketch")
    frauds, others = first.select("frauds", "others").first()
    need = math.floor(fraction * others) if fraction is not None else limit - frauds
    if need >= others:
        return df.filter(fraud | safe)
    if need <= 0:
        return df.filter(fraud)
    return _from_bracket(df, first, order, need, others) or _from_slices(df, order, need)


def _from_bracket(
    df: DataFrame, sketch: DataFrame, order: list[Column], need: int, others: int
) -> DataFrame | None:
    """The sample by one exact pass inside the sketch's bracket; None if the cut is outside."""
    fraud, safe = F.col("prediction") == 1, F.col("prediction") == 0
    shares = [min(max(need / others + side * BRACKET, 0.0), 1.0) for side in (-1, 1)]
    low, high = sketch.select(
        *[F.kll_sketch_get_quantile_bigint("sketch", F.lit(share)) for share in shares]
    ).first()
    low, high = (-1 if shares[0] == 0 else low), (HASH_SPACE if shares[1] == 1 else high)
    inside = order[0] > low
    places = df.filter(safe & (order[0] <= high)).groupBy(
        F.when(inside, order[0]).alias("first"), F.when(inside, order[1]).alias("second")
    ).agg(F.count("*").alias("n"))
    places = current_workspace(df.sparkSession).stored(places, "places")
    below = places.filter("first IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    need -= below
    if need < 0:
        return None
    if need == 0:
        return df.filter(fraud | (safe & (order[0] <= low)))
    running = running_totals(places.filter("first IS NOT NULL"), ["n"], ["first", "second"])
    hit = running.filter(F.col("n_before") < need).orderBy(F.desc("first"), F.desc("second")).first()
    if hit is None or hit["n_before"] + hit["n"] < need:
        return None
    ahead = (order[0] < hit["first"]) | ((order[0] == hit["first"]) & (order[1] < hit["second"]))
    at = safe & (order[0] == hit["first"]) & (order[1] == hit["second"])
    take = need - hit["n_before"]
    if take == hit["n"]:
        return df.filter(fraud | (safe & ahead) | at)
    return df.filter(fraud | (safe & ahead)).unionByName(_first_copies(df.filter(at), take))


def _from_slices(df: DataFrame, order: list[Column], need: int) -> DataFrame:
    """The sample by counting 16-bit slices of the order until the quota runs out between two."""
    fraud, safe = F.col("prediction") == 1, F.col("prediction") == 0
    digits = [_digit(order[0], shift) for shift in (16, 0)]
    digits += [_digit(order[1], shift) for shift in (48, 32, 16, 0)]
    decided, edge = F.lit(False), safe
    for digit in digits:
        per_slice = df.filter(edge).groupBy(digit.alias("slice")).agg(F.count("*").alias("n"))
        slice_no, in_slice, before = _slice_at(per_slice, need)
        decided = decided | (edge & (digit < slice_no))
        edge = edge & (digit == slice_no)
        need -= before
        if in_slice == need:
            return df.filter(fraud | decided | edge)
    return df.filter(fraud | decided).unionByName(_first_copies(df.filter(edge), need))


def _digit(value: Column, shift: int) -> Column:
    return F.shiftrightunsigned(value, shift).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))


def _slice_at(per_slice: DataFrame, need: int) -> tuple[int, int, int]:
    """(slice, rows in it, rows before it) where the running count reaches ``need``.

    At most 2^16 slices reach the window, whatever the size of the table.
    """
    running = per_slice.withColumn("upto", F.sum("n").over(Window.orderBy("slice")))
    hit = running.filter(F.col("upto") >= need).orderBy("slice").first()
    return hit["slice"], hit["n"], hit["upto"] - hit["n"]


def _first_copies(df: DataFrame, need: int) -> DataFrame:
    """Exactly ``need`` of the rows, which are copies of one row but for a clash of hashes."""
    columns = df.columns
    copies = df.groupBy(*columns).agg(F.count("*").alias("__copies"))
    before = F.sum("__copies").over(Window.orderBy(*columns)) - F.col("__copies")
    take = F.least(F.col("__copies"), F.lit(need).cast("bigint") - before)
    ranked = copies.withColumn("__take", take).filter(F.col("__take") > 0)
    return ranked.select(*columns, F.explode(F.sequence(F.lit(1), F.col("__take")))).select(*columns)
