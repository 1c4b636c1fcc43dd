"""Mixing sources by temperature, with DataFrame functions only.

Every source has a share p of the corpus' words; its weight is p^a / sum p^a. The exponent a is
bisected on 0..1 (uniform to natural) until the weights have the target entropy, and then
lowered no further than a limit on repetition allows. The weights are realised as a budgeted
sequence: each source goes through whole permutations of its documents and part of a last one,
and every block of the sequence gets the weights' share of each source.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blobtally.llm.common import materialise, small_side, words

#: Entropy of the weights, as a share of the way from that of the natural shares to the uniform.
TARGET_FLATTENING = 0.5
#: No source is gone through more often than this.
MAX_REPEATS = 4.0
N_BLOCKS = 100
#: Rows aimed at in a bucket of a permutation; prefix sums run inside buckets and over them.
BUCKET_ROWS = 4_000
_STEPS, _POINTS = 10, 15  # each step halves the interval four times


def solve_exponent(sources: DataFrame, target_flattening: float = TARGET_FLATTENING,
                   max_repeats: float = MAX_REPEATS, budget: float | None = None) -> float:
    """The exponent for ``sources(source, size)``, by bisection on aggregates of that table.

    Each pass evaluates the 15 points of four halvings in one aggregation; only those sums come
    to the driver. Entropy falls as the exponent grows, and so does the largest repetition.
    """
    total, n = sources.agg(F.sum("size"), F.count(F.lit(1))).first()
    if not n or not total:
        return 1.0
    budget = float(total) if budget is None else float(budget)
    p = F.col("size") / F.lit(float(total))

    def at(points: list[float]) -> list[tuple[float, float]]:
        sums = []
        for i, a in enumerate(points):
            w = F.pow(p, F.lit(a))
            sums += [F.sum(w).alias(f"z{i}"), F.sum(w * F.log(p)).alias(f"s{i}"),
                     F.max(w / F.col("size")).alias(f"m{i}")]
        row = sources.where(F.col("size") > 0).agg(*sums).first()
        return [(math.log(row[f"z{i}"]) - a * row[f"s{i}"] / row[f"z{i}"], row[f"m{i}"] / row[f"z{i}"] * budget)
                for i, a in enumerate(points)]

    (flat, _), (natural, least) = at([0.0, 1.0])
    if least > max_repeats * (1 + 1e-9):  # equal use of all is the least there is
        raise ValueError(f"a budget of {budget:.0f} words repeats {total} words more than {max_repeats} times")
    target = natural + target_flattening * (flat - natural)
    lo, hi = 0.0, 1.0
    for _ in range(_STEPS):
        points = [lo + (hi - lo) * i / (_POINTS + 1) for i in range(1, _POINTS + 1)]
        # The largest exponent that is flat enough, unless a source would be repeated too often.
        ok = [h >= target and r <= max_repeats or r > max_repeats for h, r in at(points)]
        k = next((i for i, good in enumerate(ok) if not good), _POINTS)
        lo, hi = (points[k - 1] if k else lo), (points[k] if k < _POINTS else hi)
    return (lo + hi) / 2


def mixture(docs: DataFrame, target_flattening: float = TARGET_FLATTENING, max_repeats: float = MAX_REPEATS,
            budget: float | None = None, n_blocks: int = N_BLOCKS, seed: int = 0,
            carry: list[str] | None = None) -> DataFrame:
    """The realised sequence: one row for each time a document is used.

    Returns the columns ``carry`` (all by default) with n_tokens (words), epoch, block and
    place (rank key inside the block), all long. ``budget`` is in words, that of the corpus by
    default; a document is used if its first word falls within its source's part.

    Null source: a source of its own. Null, empty or wordless text: no words, so it is used
    once in each full permutation and once in the first, wherever it falls. Rows that are equal
    in every column each count. An empty table gives an empty result.
    """
    carry = docs.columns if carry is None else carry

    def ordered(df: DataFrame) -> DataFrame:
        # A permutation is the order of a hash of document, pass and seed; the low bits tell equal rows apart.
        mixed = F.xxhash64("who", "epoch", F.lit(seed))
        tie = F.xxhash64("nth", "epoch").bitwiseAND(F.lit((1 << 16) - 1))
        return df.withColumn("order", F.shiftleft(F.shiftrightunsigned(mixed, 17), 16).bitwiseOR(tie))

    rows = docs.select(F.struct(*[docs[c] for c in carry]).alias("row"), docs["source"].alias("source"),
                       F.size(words(docs["text"])).cast("long").alias("n_tokens"),
                       F.xxhash64(docs["doc_id"], docs["text"]).alias("who"), F.monotonically_increasing_id().alias("nth"))
    base = materialise(rows.drop("row"), "mixing_sizes")  # all that is dealt and sorted below
    sources = base.groupBy("source").agg(F.sum("n_tokens").alias("size"), F.count(F.lit(1)).alias("rows"))
    sources = materialise(sources, "mixing_sources")
    n_sources = sources.count()
    total = sources.agg(F.sum("size")).first()[0] or 0
    budget = float(total) if budget is None else float(budget)
    exponent = solve_exponent(sources, target_flattening, max_repeats, budget)

    weight = F.when(F.col("size") > 0, F.pow(F.col("size") / F.lit(float(total or 1)), F.lit(exponent))).otherwise(0.0)
    z = sources.select(F.sum(weight)).first()[0] or 1.0
    plan = sources.select(
        F.col("source").alias("of"), "size", (weight / F.lit(z) * F.lit(budget)).alias("part"),
        F.greatest(F.lit(1), F.ceil(F.col("rows") / BUCKET_ROWS)).cast("long").alias("buckets"))
    plan = plan.withColumn("epochs", F.when(F.col("size") > 0, F.ceil(F.col("part") / F.col("size"))).otherwise(1).cast("long"))
    plan = materialise(plan, "mixing_plan")

    def uses(df: DataFrame) -> DataFrame:
        planned = df.join(small_side(plan, n_sources), F.col("source").eqNullSafe(F.col("of"))).drop("of")
        return ordered(planned.withColumn("epoch", F.explode(
            F.sequence(F.lit(0).cast("long"), F.greatest(F.col("epochs") - 1, F.lit(0))))))

    # Words ahead of a use: those of the buckets before its own, and those inside its bucket. The bucket is
    # the top of the order, so what is ahead grows with the order.
    used = uses(base).withColumn("bucket", F.floor((F.shiftrightunsigned("order", 32) / F.lit(float(1 << 31))) * F.col("buckets")).cast("long"))
    sums = used.groupBy("source", "epoch", "bucket").agg(F.sum("n_tokens").alias("words"))
    before = Window.partitionBy("source", "epoch").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("start", F.coalesce(F.sum("words").over(before), F.lit(0))) \
        .select(F.col("source").alias("of"), F.col("epoch").alias("in_epoch"), F.col("bucket").alias("in_bucket"), "start")
    starts = materialise(starts, "mixing_buckets")
    inside = Window.partitionBy("source", "epoch", "bucket").orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    placed = used.withColumn("ahead", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    placed = placed.join(small_side(starts, starts.count()),
                         F.col("source").eqNullSafe(F.col("of")) & (F.col("epoch") == F.col("in_epoch"))
                         & (F.col("bucket") == F.col("in_bucket")))
    first = F.col("epoch") * F.col("size") + F.col("start") + F.col("ahead")
    placed = placed.withColumn("first", first).where((F.col("part") > 0) & (F.col("first") < F.col("part")))
    block = F.least(F.floor(F.col("first") / F.col("part") * n_blocks), F.lit(n_blocks - 1)).cast("long")
    # Where each block of a pass begins and the pass ends, in the order: at most n_blocks entries for a source
    # and pass. With them every document finds its own places where it lies, and no text is dealt.
    edges = placed.groupBy("source", "epoch", block.alias("block")).agg(F.min("order").alias("from"), F.max("order").alias("to"))
    edges = edges.groupBy(F.col("source").alias("of"), F.col("epoch").alias("in_epoch")).agg(
        F.sort_array(F.collect_list(F.struct("from", "block"))).alias("edges"), F.max("to").alias("end"))
    edges = materialise(edges, "mixing_edges")
    out = uses(rows).join(small_side(edges, edges.count() * (n_blocks // 8 + 1)),
                          F.col("source").eqNullSafe(F.col("of")) & (F.col("epoch") == F.col("in_epoch")), "left")
    wordless = (F.col("n_tokens") == 0) & (F.col("epoch") == 0)
    out = out.where((F.col("order") <= F.col("end")) | wordless)
    passed = F.filter("edges", lambda e: e["from"] <= F.col("order"))
    at = F.when(F.col("edges").isNull(), F.pmod("order", F.lit(n_blocks))) \
        .otherwise(F.coalesce(F.get(passed, F.size(passed) - 1)["block"], F.get("edges", F.lit(0))["block"]))
    return out.select(*[F.col("row")[c].alias(c) for c in carry if c not in ("n_tokens", "epoch", "block", "place")],
                      "n_tokens", "epoch", at.cast("long").alias("block"), F.col("order").alias("place"))


def mix(docs: DataFrame) -> DataFrame:
    """The documents of the mixture, a row for each use, with the columns of ``docs``."""
    held = docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", "source", "text")
    out = mixture(held, carry=["doc"])
    return out.select(*[F.col("doc")[c].alias(c) for c in docs.columns])
