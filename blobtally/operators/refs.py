"""From raw object rows to resolved blob references.

Pipeline (all narrow until the lookup join):
raw bytes -> valid_objects (FLT1/2) -> decode_objects (PRJ2) -> explode_refs (GEN1, FLT3)
-> resolve_refs (J1, FLT4) / unresolved_refs (J1b); counters (AGG6/7); sampling (SMP1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from blobtally.functions.columns import bytes_to_long, decode_utf8
from blobtally.operators.joins import lookup_join


def valid_objects(raw: DataFrame) -> DataFrame:
    """Keep raw rows whose uri and size cells are present and non-empty."""
    return raw.filter(F.col("uri").isNotNull() & (F.length("uri") > 0)
                      & F.col("size").isNotNull() & (F.length("size") > 0))


def decode_objects(raw: DataFrame) -> DataFrame:
    """Bytes -> (object_key STRING, uri STRING, size BIGINT)."""
    return raw.select(decode_utf8("row_key").alias("object_key"),
                      decode_utf8("uri").alias("uri"),
                      bytes_to_long("size").alias("size"))


def explode_refs(objects: DataFrame, numbered: bool = False) -> DataFrame:
    """One row per (object, uri token); drop empty tokens and zero sizes.

    Tokens are not trimmed, and negative sizes pass, as in the original job. ``numbered`` adds ``ref_no``,
    the token's place in its object's list from 0, which tells the references of an object apart.
    """
    tokens = F.split("uri", ",")
    token = [F.posexplode(tokens).alias("ref_no", "uri")] if numbered else [F.explode(tokens).alias("uri")]
    return objects.select("object_key", *token, "size").filter((F.col("uri") != "") & (F.col("size") != 0))


def object_refs(raw: DataFrame, numbered: bool = False) -> DataFrame:
    """Raw object rows -> references, the whole narrow front of the aggregate job."""
    return explode_refs(decode_objects(valid_objects(raw)), numbered)


def mark_sample(refs: DataFrame, fraction: float, digest: Column | None = None) -> DataFrame:
    """SMP1: add ``kept``, a sample of single references (object, place in its list, uri) by their hash.

    Any fraction, without a shuffle; the mark depends on the reference alone, so the status and the
    meta of a run keep the same ones, and so does a retried task. References must be ``numbered``.
    ``digest`` replaces the hash by a uniform lower-case hex string (e.g. an md5), for other
    engines to reproduce.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be within [0, 1]")
    if fraction == 1.0:
        return refs.withColumn("kept", F.lit(True))
    if digest is not None:
        kept = digest < F.lit(f"{int(fraction * 16 ** 32):032x}")
    else:
        kept = F.shiftrightunsigned(F.xxhash64("object_key", "ref_no", "uri"), 1) < F.lit(int(fraction * (1 << 63)))
    return refs.withColumn("kept", kept)


def resolve_refs(refs: DataFrame, blob_index: DataFrame, skew_rows: int | None = None,
                 hot_keys: list | None = None) -> DataFrame:
    """References that resolve in the blob index, with their blob's file, id, start and length.

    Hot uris (``hot_keys``, or found with ``skew_rows``) are split off the shuffle join.
    """
    out = lookup_join(refs, blob_index.select("uri", "file_id", "blob_id", "start", "length"),
                      "uri", "inner", skew_rows=skew_rows, hot_keys=hot_keys)
    return out.select("object_key", "uri", "size", "file_id", "blob_id", "start", "length")


def unresolved_refs(refs: DataFrame, blob_index: DataFrame, skew_rows: int | None = None,
                    hot_keys: list | None = None) -> DataFrame:
    """References whose uri is not in the blob index."""
    return lookup_join(refs, blob_index.select("uri"), "uri", "left_anti", skew_rows=skew_rows,
                       hot_keys=hot_keys).select("object_key", "uri", "size")


def refs_per_uri(refs: DataFrame, archived: Column | None = None) -> DataFrame:
    """Pre-aggregate references per uri: n_refs and, if ``archived`` is given, n_live.

    References with a mark ``kept`` (``mark_sample``) are thinned here, before the map-side count: n_live
    counts the kept ones, and n_kept (archived ones included) is added; n_refs still counts all.

    Partial aggregation runs map-side, so a uri referenced by a third of all objects leaves each
    map task as a single row: hot keys are collapsed before any shuffle or join.
    """
    aggs = [F.count(F.lit(1)).alias("n_refs")]
    kept = F.col("kept") if "kept" in refs.columns else F.lit(True)
    if "kept" in refs.columns:
        aggs.append(F.count_if(kept).alias("n_kept"))
    if archived is not None:
        aggs.append(F.count_if(kept & ~archived).alias("n_live"))
    return refs.groupBy("uri").agg(*aggs)


def refs_beside_index(refs: DataFrame, blob_index: DataFrame, archived: Column, sampled: Column | None = None) -> DataFrame:
    """Every referenced uri once: n_refs, n_live (and n_kept, see ``refs_per_uri``) beside its index row's file_id, length
    and ``sampled`` (a predicate over the index row), which are null where the uri is not in the index.

    References and index rows are one bag, aggregated by uri: a task holds one map of its uris, where a join of two
    aggregates holds two maps and two sorts. A uri that the index holds twice fails the run, referenced or
    not; index rows with a null uri are left out.
    """
    kept = F.col("kept") if "kept" in refs.columns else F.lit(True)
    absent = F.lit(None)
    asked = refs.select("uri", F.lit(1).alias("_ref"), kept.alias("_kept"), (kept & ~archived).alias("_live"),
                        absent.cast("bigint").alias("file_id"), absent.cast("bigint").alias("length"), absent.cast("boolean").alias("sampled"))
    held = blob_index.where(F.col("uri").isNotNull()).select(
        "uri", F.lit(0).alias("_ref"), F.lit(False).alias("_kept"), F.lit(False).alias("_live"), "file_id", "length",
        (F.lit(True) if sampled is None else sampled).alias("sampled"))
    counts = [F.count_if(F.col("_ref") == 1).alias("n_refs"), F.count_if("_live").alias("n_live"), F.count_if(F.col("_ref") == 0).alias("_rows")]
    if "kept" in refs.columns:
        counts.append(F.count_if("_kept").alias("n_kept"))
    totals = asked.unionByName(held).groupBy("uri").agg(*counts, *[F.max(c).alias(c) for c in ("file_id", "length", "sampled")])
    repeated = F.raise_error(F.concat(F.lit("uri is not unique in the index: "), F.col("uri")))
    return totals.filter(F.when(F.col("_rows") > 1, repeated.cast("boolean")).otherwise(F.col("n_refs") > 0)).drop("_rows")


def lookup_counters(refs: DataFrame, blob_index: DataFrame) -> DataFrame:
    """One row: how many references resolve (hits) and how many do not (misses)."""
    per_uri = refs_per_uri(refs)
    keys = blob_index.select("uri", F.lit(True).alias("hit"))
    joined = per_uri.join(keys, "uri", "left")
    return joined.agg(
        F.coalesce(F.sum(F.when(F.col("hit"), F.col("n_refs"))), F.lit(0)).cast("bigint").alias("hits"),
        F.coalesce(F.sum(F.when(F.col("hit").isNull(), F.col("n_refs"))), F.lit(0)).cast("bigint")
        .alias("misses"))


def ref_count(refs: DataFrame, blob_index: DataFrame) -> DataFrame:
    """One row: the number of resolved references."""
    return lookup_counters(refs, blob_index).select(F.col("hits").alias("ref_count"))


def observe_lookups(joined: DataFrame, name: str = "lookups",
                    weight: str | None = None) -> tuple[DataFrame, Observation]:
    """Attach hit/miss counters to a left-joined frame (``file_id`` null = miss).

    Counts arrive with the first action over the returned frame and are exact once, unlike
    accumulators that may count again when a stage is recomputed.
    """
    obs = Observation(name)
    w = F.col(weight) if weight else F.lit(1)
    hit = F.col("file_id").isNotNull()
    observed = joined.observe(obs,
                              F.coalesce(F.sum(F.when(hit, w)), F.lit(0)).alias("hits"),
                              F.coalesce(F.sum(F.when(~hit, w)), F.lit(0)).alias("misses"))
    return observed, obs


def sample_refs(df: DataFrame, fraction: float = 1.0, seed: int | None = None,
                key: Column | None = None, modulus: int = 100) -> DataFrame:
    """Sample references without replacement.

    Without ``key``: Bernoulli sampling (``DataFrame.sample``). With an integer ``key``
    expression: the reproducible keyed form ``pmod(key, modulus) < fraction * modulus``, which
    keeps or drops all rows of one key together.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be within [0, 1]")
    if fraction >= 1.0:
        return df
    if key is None:
        return df.sample(False, fraction, seed)
    keep = round(fraction * modulus)
    if abs(fraction * modulus - keep) > 1e-9 * modulus:
        raise ValueError(f"sample fraction {fraction} is no multiple of 1/{modulus}; give another modulus")
    return df.filter(F.pmod(key, F.lit(modulus)) < keep)


def blob_sample_filter(fraction: float, file_id: str = "file_id", blob_id: str = "blob_id") -> Column:
    """Reproducible per-blob sample predicate: keeps a blob iff its hash falls in ``fraction``.

    Hashing (file_id, blob_id) makes the sample uniform whatever the file layout, and every
    reference to one blob is kept or dropped together, in the status and the meta alike.
    The hash is compared as a 63-bit integer, so any fraction is honoured.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be within [0, 1]")
    if fraction == 1.0:
        return F.lit(True)
    return F.shiftrightunsigned(F.xxhash64(F.col(file_id), F.col(blob_id)), 1) < F.lit(int(fraction * (1 << 63)))


def blob_sample_key(file_id: str = "file_id", start: str = "start") -> Column:
    """Integer key of a blob for keyed sampling: file id plus start in KiB."""
    return F.col(file_id) + F.call_function("div", F.col(start), F.lit(1024))


def nest_refs(resolved: DataFrame) -> DataFrame:
    """Flat resolved reference -> (object_key, size, blob_info STRUCT<file_id, blob_id, start, length>)."""
    return resolved.select("object_key", "size",
                           F.struct("file_id", "blob_id", "start", "length").alias("blob_info"))


def flatten_refs(nested: DataFrame, *carry: str) -> DataFrame:
    """Nested object info -> flat columns, with the columns ``carry``."""
    return nested.select("object_key", "size", *carry, "blob_info.*")
