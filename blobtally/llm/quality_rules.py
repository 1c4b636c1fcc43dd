"""Quality rules by distribution divergence, with DataFrame functions only.

A document's character classes and its most common short words are two histograms, the latter also
with all common words in one bin. Each is compared with the reference of the document's language, which is the mean over all documents of
that language (so one long document weighs no more than another), by the Jensen-Shannon distance
(base 2, so 0 to 1). Base rules on length and repetition come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blobtally.llm.common import WORD, materialise, small_side, spaced, spaced_words, with_values

#: Common words have at most this many code points; a language's reference holds so many of them.
SHORT, N_COMMON = 4, 24
#: Largest distances of a kept document.
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE, MAX_COVERAGE_DISTANCE = 0.30, 0.42, 0.28
#: Below these lengths a histogram is too thin to be compared, and its test is passed.
MIN_CLASS_CHARS, MIN_COMMON_WORDS = 200, 50
#: A language with fewer words than this in the whole corpus is compared with all languages together.
MIN_REFERENCE_WORDS = 2000
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

SYMBOLS = r"[#*$%&|<>]"
UPPER, DIGIT, PUNCT = r"[A-Z]", r"[0-9]", r"[.,;:!?'\"()\-]"
OPERATOR, CONTROL, FOREIGN = r"[{}\[\]=/@_~^+`\\]", r"[\x00-\x08\x0E-\x1F\x7F]", r"[\x80-\x{10FFFF}]"
#: Classes of characters: white space, those above, symbols, and the lower-case letters a to z.
N_CLASSES = 9
#: Runs of these are left out before the other classes are counted.
_PLAIN = r"[a-z\x20\x09-\x0D]+"


def _distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms given as arrays of counts."""
    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)

    def term(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    def divergence(v: Column) -> Column:
        both = F.zip_with(v["p"], v["q"], lambda x, y: F.struct(
            (x / v["n"]).alias("x"), (y / v["m"]).alias("y")))
        parts = F.transform(both, lambda z: term(z["x"], (z["x"] + z["y"]) / 2) + term(z["y"], (z["x"] + z["y"]) / 2))
        return F.sqrt(F.greatest(total(parts) / 2, F.lit(0.0)))

    one = F.array(F.struct(p.alias("p"), q.alias("q"), total(p).alias("n"), total(q).alias("m")))
    return F.when((total(p) > 0) & (total(q) > 0), F.get(F.transform(one, divergence), F.lit(0)))


def _word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n): how often each short word occurs in a language; one row with null for all others."""
    every = docs.select("lang", F.explode(spaced_words(spaced(F.coalesce("text", F.lit(""))))).alias("word"))
    return every.select("lang", F.when(F.length("word") <= SHORT, F.col("word")).alias("word")) \
        .groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))


def _common_words(counts: DataFrame) -> DataFrame:
    """(lang, common array<string>): the most frequent short words of languages with text enough, ties by the word."""
    thick = counts.where(F.col("lang").isNotNull()).groupBy("lang").agg(F.sum("n").alias("words")) \
        .where(F.col("words") >= MIN_REFERENCE_WORDS).select("lang")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = counts.where(F.col("word").isNotNull()).join(thick, "lang") \
        .withColumn("place", F.row_number().over(order)).where(F.col("place") <= N_COMMON)
    return top.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "word"))),
                                               lambda x: x["word"]).alias("common"))


def _of_all_languages(counts: DataFrame) -> tuple[list[str], list[float] | None]:
    """The most frequent short words of the whole corpus, and their counts with that of all other words."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    top = counts.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(N_COMMON).collect()
    seen = [float(r["n"]) for r in top]
    return [r["word"] for r in top], [*seen, total - sum(seen)] if total >= MIN_REFERENCE_WORDS else None


def base_columns(df: DataFrame) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words for the column ``text``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = with_values(df, __n=spaced(text), __odd=F.regexp_replace(text, F.lit(_PLAIN), F.lit("")))
    df = with_values(df, __w=spaced_words(F.col("__n")),
                     __l=F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)),
                     __space=F.length("__n") - F.length(F.replace("__n", F.lit(" "), F.lit(""))),
                     n_symbols=F.regexp_count("__odd", F.lit(SYMBOLS)).cast("long"))
    n = F.size("__w")
    take = n - 2
    three = F.arrays_zip(F.slice("__w", F.lit(1), take), F.slice("__w", F.lit(2), take),
                         F.slice("__w", F.lit(3), take), F.sequence(F.lit(0), n - 3))
    df = with_values(df, __t=F.when(n >= 3, F.sort_array(three)))

    def same(x: Column, y: Column) -> Column:
        return (x["0"] == y["0"]) & (x["1"] == y["1"]) & (x["2"] == y["2"])

    again = F.filter("__t", lambda x, i: same(x, F.get("__t", i + 1)) | same(x, F.get("__t", i - 1)))
    at = F.transform(again, lambda x: F.array(x["3"], x["3"] + 1, x["3"] + 2))
    return df.select(
        "*", n.cast("long").alias("n_words"),
        (F.length(text) - F.col("__space")).cast("long").alias("word_chars"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.size(F.array_distinct(F.flatten(at))), F.lit(0)).cast("long").alias("n_repeat_words"),
    ).drop("__l", "__t", "__n")


def _histograms(df: DataFrame) -> DataFrame:
    """Add __classes (counts of N_CLASSES) and __seen (a count for each common word, then the rest)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    classes = [F.col("__space"), *[F.regexp_count("__odd", F.lit(c)) for c in (UPPER, DIGIT, PUNCT, OPERATOR, CONTROL, FOREIGN)],
               F.col("n_symbols")]
    df = with_values(df, __c=F.array(*[c.cast("double") for c in classes]),
                     __s=F.filter("__w", lambda w: F.length(w) <= SHORT))
    seen = F.transform("__common", lambda c: (F.size("__s") - F.size(F.array_remove("__s", c))).cast("double"))
    df = with_values(df, __k=F.coalesce(seen, F.array().cast("array<double>")))

    def total(a):
        return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)

    return df.select("*", F.concat("__c", F.array(F.greatest(F.length(text) - total("__c"), F.lit(0.0)))).alias("__classes"),
                     F.concat("__k", F.array(F.col("n_words") - total("__k"))).alias("__seen")) \
        .drop("__w", "__odd", "__space", "__c", "__s", "__k")


def _sum_shares(column: str, n: int) -> Column:
    """Sum of the histograms, each scaled to one; those too thin to be compared count with zero."""
    size = F.aggregate(column, F.lit(0.0), lambda s, x: s + x)
    return F.array(*[F.sum(F.when(size > 0, F.coalesce(F.get(column, F.lit(i)), F.lit(0.0)) / size).otherwise(0.0)) for i in range(n)])


def _coverage(seen: str) -> Column:
    """The word histogram in two bins: common words, and the rest."""
    rest = F.element_at(seen, -1)
    return F.array(F.aggregate(seen, F.lit(0.0), lambda s, x: s + x) - rest, rest)


def quality_rules(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Score every document; returns its columns ``carry`` (all by default) and the verdict.

    Added: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), class_distance,
    word_distance, coverage_distance (double, null if not compared: too few characters or words), base_failed,
    kept (boolean). Coverage is the word histogram in two bins, common words and the rest: a text
    without any common word differs from every reference there. ``docs`` needs
    ``text`` and ``lang``; a carried column with an added column's name is replaced.

    Null or empty text: zero counts, base_failed. Null lang, and a language with too few words: characters
    are compared with the mean over all documents, words with the most common ones of the whole
    corpus. Ties among common words go by the word.
    Repeated rows are scored each on their own. An empty table gives an empty result.
    """
    carry = docs.columns if carry is None else carry
    base = docs.select(F.struct(*[docs[c] for c in carry]).alias("__row"), docs["text"], docs["lang"])
    counts = materialise(_word_counts(base), "word_counts")
    common = materialise(_common_words(counts), "common_words")
    every_word, every_seen = _of_all_languages(counts)
    counted = base.join(small_side(common.withColumnRenamed("common", "__common"), common.count()), "lang", "left") \
        .withColumn("__common", F.coalesce("__common", F.array(*[F.lit(w) for w in every_word]).cast("array<string>")))
    counted = _histograms(base_columns(counted)).drop("text", "__common")
    scored = materialise(counted, "quality_profile")

    size = F.aggregate("__classes", F.lit(0.0), lambda s, x: s + x)
    thick = scored.select("lang", "n_words", F.when(size >= MIN_CLASS_CHARS, F.col("__classes")).alias("__classes"),
                          F.size("__seen").alias("width"), F.when(F.col("n_words") >= MIN_COMMON_WORDS, F.concat(
                              F.slice("__seen", F.lit(1), F.size("__seen") - 1), F.array_repeat(F.lit(0.0), N_COMMON + 1 - F.size("__seen")),
                              F.slice("__seen", F.lit(-1), F.lit(1)))).alias("__seen"))
    per = thick.groupBy("lang").agg(F.sum("n_words").alias("n"), F.max("width").alias("width"),
                                    _sum_shares("__classes", N_CLASSES).alias("ref_classes"), _sum_shares("__seen", N_COMMON + 1).alias("ref_seen"))
    every = thick.agg(_sum_shares("__classes", N_CLASSES))
    # One row for each language that has text enough; __seen of a language has one width.
    ref = per.where(F.col("lang").isNotNull() & (F.col("n") >= MIN_REFERENCE_WORDS)).select(
        "lang", "ref_classes", F.concat(F.slice("ref_seen", F.lit(1), F.col("width") - 1),
                                        F.slice("ref_seen", F.lit(-1), F.lit(1))).alias("ref_seen"))
    ref = materialise(ref, "quality_reference")
    whole = every.first()[0]
    out = scored.join(small_side(ref, ref.count()), "lang", "left")
    of_all = F.array(*[F.lit(float(x or 0)) for x in whole])
    out = out.withColumn("ref_seen", F.coalesce("ref_seen", F.array(*[F.lit(x) for x in every_seen]))) if every_seen else out
    chars = F.aggregate("__classes", F.lit(0.0), lambda s, x: s + x)
    out = with_values(
        out,
        class_distance=F.when(chars >= MIN_CLASS_CHARS, _distance(F.col("__classes"), F.coalesce("ref_classes", of_all))),
        word_distance=F.when(F.col("n_words") >= MIN_COMMON_WORDS, _distance(F.col("__seen"), F.col("ref_seen"))),
        coverage_distance=F.when(F.col("n_words") >= MIN_COMMON_WORDS, _distance(_coverage("__seen"), _coverage("ref_seen"))),
        base_failed=(F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    kept = ~F.col("base_failed") & (F.coalesce("class_distance", F.lit(0.0)) <= MAX_CLASS_DISTANCE) \
        & (F.coalesce("word_distance", F.lit(0.0)) <= MAX_WORD_DISTANCE) \
        & (F.coalesce("coverage_distance", F.lit(0.0)) <= MAX_COVERAGE_DISTANCE)
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "class_distance", "word_distance", "coverage_distance", "base_failed"]
    return out.select(*[F.col("__row")[c].alias(c) for c in carry if c not in [*added, "kept"]],
                      *added, kept.alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with the columns they came with. Null and empty texts go; an empty
    table gives an empty result."""
    held = docs.select(F.struct(*docs.columns).alias("doc"), "text", "lang")
    kept = quality_rules(held, carry=["doc"]).where("kept")
    return kept.select(*[F.col("doc")[c].alias(c) for c in docs.columns])
