"""Sharding by balanced label propagation.

Linked documents should share a shard, and shards must be even. Documents start on a hashed
shard. In each round a document looks at how many of its neighbours each shard holds and wants
the best one; moves are granted, largest gain first, up to the room that a shard's quota leaves.
Links come as groups (members of a group are neighbours of each other), so a round counts by
(group, shard) and never lists pairs. What the rounds decide stands: at the end only the rows by which
a shard exceeds its even size leave it, first those without a neighbour, then those whose group is
mostly elsewhere.

Start, moves and order follow from a hash of the row's content, so they are the same however the table
is stored; equal rows alone are told apart by their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blobtally.llm.common import materialise, small_side

N_SHARDS, ROUNDS, SLACK_PERCENT = 40, 8, 5
#: Packs that want a shard, and rows of a shard, are put in order in so many buckets of a hash; a bucket of
#: rows is ranked in pieces of about _PIECE_ROWS by the row's hash.
_BUCKETS, _PIECE_ROWS = 64, 20_000


def _before(df: DataFrame, by: list[str], order: list[str | Column], inside: list[str | Column], size: str) -> DataFrame:
    """Add ``ahead``: the sum of ``size`` over the rows of the same ``by`` that come before in the order
    (``order``, then ``inside``). Sums over the distinct ``order`` run first, so no task sorts a whole ``by``."""
    sums = df.groupBy(*by, *order).agg(F.sum(size).alias("_n"))
    outer = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    starts = materialise(sums.withColumn("_start", F.coalesce(F.sum("_n").over(outer), F.lit(0))).drop("_n"), "shard_starts")
    within = Window.partitionBy(*by, *order).orderBy(*inside).rowsBetween(Window.unboundedPreceding, -1)
    out = df.withColumn("_inside", F.coalesce(F.sum(size).over(within), F.lit(0)))
    return out.join(small_side(starts, starts.count()), [*by, *order]) \
        .withColumn("ahead", F.col("_start") + F.col("_inside")).drop("_start", "_inside")


def _wishes(rows: DataFrame) -> DataFrame:
    """(grp, shard, here, size, there, want) of every pack of linked rows: the shard that holds most of the
    group is wanted. Equally good shards go by a hash, so no shard is preferred."""
    counts = rows.where(F.col("grp").isNotNull()).groupBy("grp", "shard").agg(F.count(F.lit(1)).alias("here"))
    best = counts.groupBy("grp").agg(F.max(F.struct("here", F.xxhash64("grp", "shard").alias("tie"), "shard")).alias("b"), F.sum("here").alias("size"))
    best = best.where(F.col("size") > 1).select("grp", "size", F.col("b.here").alias("there"), F.col("b.shard").alias("want"))
    return counts.join(best, "grp")


def _round(rows: DataFrame, quota: int) -> DataFrame | None:
    """One round over ``rows(id, who, grp, shard)``; same columns, or None if nothing moves.

    A shard's quota is for the rows that are where they want to be: others make room for them, as rows
    without a neighbour, or whose group has most of its members elsewhere, lose nothing by it.
    """
    packs = materialise(_wishes(rows), "shard_wishes")
    at_home = packs.where(F.col("shard") == F.col("want")).groupBy("want").agg(F.sum("here").alias("settled"))  # one row a shard
    # The gain of a move is the share of a row's neighbours that it joins beyond those it leaves.
    gain = (F.col("there") - F.col("here") + 1) / (F.col("size") - 1)
    wish = packs.where(F.col("shard") != F.col("want")).withColumn("gain", gain) \
        .withColumn("rung", F.floor(-2 * F.log2("gain"))).withColumn("bucket", F.pmod(F.xxhash64("grp"), F.lit(_BUCKETS)))
    # Movers of one group and shard are alike, so grants go to whole such packs; a pack that the
    # quota cuts moves in part, by a hash of its rows. Larger gains (by steps) go first.
    ahead = _before(wish, ["want"], ["rung", "bucket"], [F.desc("gain"), F.col("grp"), F.col("shard")], "here")
    grants = ahead.join(F.broadcast(at_home), "want") \
        .withColumn("granted", F.least("here", F.lit(quota) - F.col("settled") - F.col("ahead"))) \
        .where("granted > 0").select("grp", "shard", "want", (F.col("granted") / F.col("here")).alias("part"))
    grants = materialise(grants, "shard_grants")
    n = grants.count()
    if not n:
        return None
    chance = F.pmod(F.xxhash64("who", F.lit("move")), F.lit(1_000_003)) / F.lit(1_000_003.0)
    return rows.join(small_side(grants, n), ["grp", "shard"], "left") \
        .select("id", "who", "grp", F.when(chance < F.col("part"), F.col("want")).otherwise(F.col("shard")).cast("int").alias("shard"))


def propagate(rows: DataFrame, n_shards: int = N_SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Labels (id, who, grp, shard) after the rounds: the rows that are where they want to be stay within
    each shard's quota, but for packs that are granted in part by a hash."""
    quota = -(-rows.count() // n_shards) * (100 + SLACK_PERCENT) // 100 + 1
    labels = rows.select("id", "who", "grp", F.pmod(F.xxhash64("who"), F.lit(n_shards)).cast("int").alias("shard"))
    for _ in range(rounds):
        moved = _round(labels, quota)
        if moved is None:
            break
        labels = materialise(moved, "shard_labels")
    return labels


def balanced_shards(rows: DataFrame, n_shards: int = N_SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Shard for ``rows(id long, who long, grp)``; adds shard (int) and slot (long, gapless from 0).

    ``id`` tells the rows apart, ``who`` is a hash of a row's content; rows of a null ``grp`` have no
    neighbour. Counts of the shards are at most one apart.
    """
    labels = materialise(propagate(rows, n_shards, rounds), "shard_propagated")
    sizes = {r["shard"]: r["n"] for r in labels.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    size = [sizes.get(s, 0) for s in range(n_shards)]
    total = sum(size)
    # The larger shards get the one row more that not all can have.
    more = set(sorted(range(n_shards), key=lambda s: (-size[s], s))[:total % n_shards])
    even = [total // n_shards + (s in more) for s in range(n_shards)]
    leave = [max(0, size[s] - even[s]) for s in range(n_shards)]
    lack = [max(0, even[s] - size[s]) for s in range(n_shards)]
    # Order in a shard: who has no neighbours, who wants to be elsewhere, then groups side by side.
    packs = _wishes(labels).select("grp", "shard", F.when(F.col("shard") == F.col("want"), 2).otherwise(1).alias("tie"))
    key = labels.join(packs, ["grp", "shard"], "left").withColumn("linked", F.coalesce("tie", F.lit(0)))
    key = key.withColumn("g", F.when(F.col("linked") > 0, F.xxhash64("grp")).otherwise(F.col("who"))) \
        .withColumn("h", F.xxhash64("who", F.lit("order"))).withColumn("bucket", F.pmod("g", F.lit(_BUCKETS))).withColumn("one", F.lit(1))
    key = materialise(key.drop("tie"), "shard_keys")
    cuts = key.groupBy("shard", "linked", "bucket").agg(F.ceil(F.count(F.lit(1)) / _PIECE_ROWS).cast("long").alias("cuts"))
    # A group that fills pieces is cut by its rows; smaller ones stay in one.
    fine = key.join(F.broadcast(cuts), ["shard", "linked", "bucket"])
    big = key.groupBy("shard", "grp").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > _PIECE_ROWS) \
        .select("shard", "grp", F.lit(True).alias("big"))
    fine = fine.join(big, ["shard", "grp"], "left") \
        .withColumn("piece", F.pmod(F.when(F.col("big"), F.col("h")).otherwise(F.xxhash64("g", F.lit("piece"))), F.col("cuts")))
    ranked = _before(fine, ["shard"], ["linked", "bucket", "piece"], ["g", "h", "id"], "one").withColumnRenamed("ahead", "rank")

    def of(values: list[int], index: Column) -> Column:
        return F.get(F.array(*[F.lit(v).cast("long") for v in values]), index.cast("int"))

    def before(values: list[int]) -> list[int]:
        return [sum(values[:i]) for i in range(len(values))]

    # Who leaves is numbered over all shards, and these numbers are dealt to the shards that lack rows.
    number = of(before(leave), F.col("shard")) + F.col("rank")
    goes = F.col("rank") < of(leave, F.col("shard"))
    takers = [s for s in range(n_shards) if lack[s]] or [0]
    first = before([lack[s] for s in takers])
    taker = F.size(F.filter(F.array(*[F.lit(v).cast("long") for v in first]), lambda v: v <= number)) - 1
    slot = F.when(goes, number - of(first, taker) + of([size[s] for s in takers], taker)).otherwise(F.col("rank") - of(leave, F.col("shard")))
    return ranked.select("id", "grp", slot.cast("long").alias("slot"),
                         F.when(goes, of(takers, taker)).otherwise(F.col("shard")).cast("int").alias("to")).withColumnRenamed("to", "shard")


def shard_documents(docs: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """Shards 0 to n-1 for documents, with counts at most one apart; equal texts are neighbours.

    Returns doc_id, size (UTF-8 bytes of the text plus 16), text_crc32, law ('rows'), shard,
    slot, grown_shard (null: another shard count moves rows between all shards). Null text: size
    16, CRC 0, no neighbour. Equal rows are told apart by nothing, and each gets a slot of its
    own. An empty table gives an empty result.
    """
    data = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"),
                       F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
                       F.when(F.col("text").isNotNull(), F.md5("text")).alias("grp"))
    data = data.select(F.struct("doc_id", (F.col("size") + 16).alias("size"), "text_crc32").alias("row"), "grp",
                       F.xxhash64("doc_id", "grp").alias("who"), F.monotonically_increasing_id().alias("id"))
    data = materialise(data, "shard_rows")
    # The number of a row is unique, and stable once it is written.
    joined = data.drop("grp").join(balanced_shards(data.select("id", "who", "grp"), n_shards), "id")
    return joined.select("row.doc_id", "row.size", "row.text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
