"""N:1 lookup joins that stay balanced when a few keys carry a large share of the rows.

The reference resolves every reference with one point lookup; here that is a join of a large
fact table (references) with an index that is unique on the key (blob uri). Catalyst plans a
sort-merge join, AQE turns it into a broadcast join when the index side is measured small, and
AQE's skew handling splits oversized shuffle partitions of the fact side.

Hot keys leave that join: their index rows, one for each key, are broadcast to the fact rows
that name them, which are then not shuffled at all; the rest is joined as before, and an
index bucketed by the key stays where it is. Hot keys come from a mergeable heavy-hitter sketch over
the facts, which another pass (the job's status pass) can fill on the way. The sketch returns
at most ``HOT_KEYS`` keys, and surely every key with more than 1/``HOT_KEYS`` of the rows: that bounds both
the broadcast and what a key outside it can hold. Which keys are hot never changes the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Keys returned by the sketch, and keys it tracks: a key with more than 3.5 / TRACKED_KEYS of the rows is
#: never lost, and no more than HOT_KEYS keys can have more than 1 / HOT_KEYS of them.
HOT_KEYS, TRACKED_KEYS = 4096, 16_384


def hot_key_sketch(key: str) -> Column:
    """Aggregate: the most frequent keys with their estimated row counts, most frequent first."""
    return F.expr(f"approx_top_k({key}, {HOT_KEYS}, {TRACKED_KEYS})")


def hot_keys_of(sketch: list, skew_rows: int, scale: float = 1.0) -> list:
    """The keys of a sketch that hold at least ``skew_rows`` rows, where it saw one row in ``scale``."""
    return [item for item, n in sketch or [] if item is not None and n * scale >= skew_rows]


def find_hot_keys(facts: DataFrame, key: str, skew_rows: int, presampled: float = 1.0) -> list:
    """Keys estimated to hold at least ``skew_rows`` rows, most frequent first, in one aggregation.

    ``presampled`` is the share of the rows that ``facts`` holds (e.g. from ``sources.sample_input_files``).
    """
    if skew_rows <= 0 or not 0 < presampled <= 1:
        raise ValueError("skew_rows must be positive and presampled within (0, 1]")
    return hot_keys_of(facts.agg(hot_key_sketch(key).alias("top")).first()["top"], skew_rows, 1 / presampled)


def lookup_join(facts: DataFrame, index: DataFrame, key: str, how: str = "inner",
                skew_rows: int | None = None, hot_keys: list | None = None) -> DataFrame:
    """Join ``facts`` with ``index`` (unique on ``key``) using ``how`` in inner/left/left_anti/left_semi.

    Hot keys are given, or found with ``skew_rows`` (one more pass over the facts); without any this is
    the plain join. More than ``HOT_KEYS`` given keys are an error.
    """
    if how not in ("inner", "left", "left_outer", "left_anti", "left_semi"):
        raise ValueError(f"unsupported lookup join type {how!r}")
    if hot_keys is None and skew_rows is not None:
        hot_keys = find_hot_keys(facts, key, skew_rows)
    hot_keys = [k for k in dict.fromkeys(hot_keys or []) if k is not None]
    if not hot_keys:
        return facts.join(index, key, how)
    if len(hot_keys) > HOT_KEYS:
        raise ValueError(f"{len(hot_keys)} hot keys exceed the bound of the broadcast, {HOT_KEYS}")
    schema = StructType([StructField(key, facts.schema[key].dataType, False)])
    keys = F.broadcast(facts.sparkSession.createDataFrame([(k,) for k in hot_keys], schema))
    hot_index = index.join(keys, key, "left_semi")  # at most one row for each hot key
    hot = facts.join(keys, key, "left_semi").join(F.broadcast(hot_index), key, how)
    cold = facts.join(keys, key, "left_anti").join(index, key, how)
    return hot.unionByName(cold)


def unique_rows(index: DataFrame, key: str) -> DataFrame:
    """``index`` with a check inside the plan that ``key`` is unique: a repeat fails the run.

    One aggregation by the key, which the join that follows needs the rows dealt by anyway (and
    which a table bucketed by the key needs no shuffle for). Rows with a null key are left out.
    """
    others = [c for c in index.columns if c != key]
    # Rows with a null key match nothing, so they are no repeats of each other.
    counted = index.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), *[F.any_value(c).alias(c) for c in others])
    repeated = F.raise_error(F.concat(F.lit(f"{key} is not unique in the index: "), F.col(key).cast("string")))
    return counted.filter(F.when(F.col("_rows") > 1, repeated.cast("boolean")).otherwise(F.lit(True))) \
        .select(*index.columns)


def assert_unique(index: DataFrame, key: str, show: int = 5) -> DataFrame:
    """Fail if ``key`` is not unique in ``index`` (a lookup index must return at most one row).

    One partial+final aggregation; at most ``show`` offending keys reach the driver. Returns
    ``index`` unchanged so it can sit inside a chain. Nothing is de-duplicated silently.
    """
    dupes = (index.where(F.col(key).isNotNull()).groupBy(key).count().filter(F.col("count") > 1)
             .limit(show).collect())
    if dupes:
        sample = ", ".join(f"{r[0]!r} x{r[1]}" for r in dupes)
        raise ValueError(f"{key} is not unique in the index: {sample}")
    return index
