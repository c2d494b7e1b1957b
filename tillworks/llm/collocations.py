"""Phrase collocations by top-order marginalisation.

Every word of a piece of text opens a window of the longest phrase length, whose columns are the word and its leads,
padded with null where the piece ends. Only these windows are counted. A phrase of k words occurs exactly where a
window begins with it, so one ROLLUP over the window columns sums the counts of all shorter phrases, down to single
words and to all words of a language, without an n-gram explosion for each length.

Before they are counted, windows are padded from the first pair of neighbours on that is certainly too rare for a
phrase: pairs are counted by hash bucket, and the buckets that reach the least count make a bit table of fixed size,
which goes to all tasks. A bucket counts at least its own pairs, so no phrase of the least count is lost, and every
part of a frequent phrase is frequent. Where data fill all buckets nothing is padded early and the windows are counted
as they are, with the same result.

Defined results: a null text has no words, a null language is ``und``; rows are counted as they come, also repeated
ones and rows without id; an empty table gives no phrases; texts are read whole, however long, and a piece of a
million words is as many windows; ties are ordered by the phrase's bytes; columns other than text and language are
ignored. Counts are exact; scores are exact below 10 ** 17 words per language, where products reach 38 digits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

LONGEST = 5
LEAST = 100
TOP = 2000
#: A phrase goes if a longer one occurs at least this many hundredths as often.
COVERED = 100
SCALE = 1000
#: The table of pair buckets has 2 ** 25 bits, 4 MB. More pad more windows where a corpus fills the buckets.
BUCKET_BITS = 25
#: The table is put together from runs of 2 ** 10 numbers.
RUN_BITS = 10
#: Parts in which a language's phrases are ranked before its best ones meet.
RANK_PARTS = 64

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Characters that end a piece.
_ENDS = ".,;:!?\n\u000b\u000c\r"


def pieces(documents: DataFrame) -> DataFrame:
    """(lang, words): one row per piece of text that has words, with A-Z in small letters."""
    small = F.translate("text", _CAPITALS + _ENDS + "\t", _CAPITALS.lower() + "\n" * len(_ENDS) + " ")
    rows = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.explode(F.split(small, "\n")).alias("piece"))
    words = F.filter(F.split("piece", " "), lambda w: w != "")
    return rows.select("lang", words.alias("words")).filter(F.size("words") > 0)


def _leads(words: DataFrame, length: int) -> DataFrame:
    """(lang, w0, w1, ...): each word of a piece and its leads, null beyond the end of the piece."""
    shifted = [F.col("words"), *(F.slice("words", k + 1, F.size("words")) for k in range(1, length))]
    rows = words.select("lang", F.inline(F.arrays_zip(*(s.alias(f"w{k}") for k, s in enumerate(shifted)))))
    return rows.toDF("lang", *(f"w{k}" for k in range(length)))


def _bucket(lang: str, first: str, second: str, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(lang, first, second), 64 - bits)


def frequent_buckets(words: DataFrame, least: int, bits: int) -> DataFrame:
    """One row, one array of 64-bit numbers: bit b is set if bucket b counts ``least`` pairs of neighbours.

    Its size is fixed by ``bits``, whatever the data.
    """
    pairs = _leads(words, 2).filter(F.col("w1").isNotNull())
    counts = pairs.groupBy(_bucket("lang", "w0", "w1", bits).alias("bucket")).agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bucket").bitwiseAND(F.lit(63)).cast("int"))
    cells = counts.groupBy(F.shiftright("bucket", 6).alias("cell")).agg(F.bit_or(bit).alias("bits"))
    spark = words.sparkSession
    all_cells = spark.range(1 << (bits - 6)).select(F.col("id").alias("cell"), F.lit(0).cast("long").alias("bits"))
    whole = cells.unionAll(all_cells).groupBy("cell").agg(F.bit_or("bits").alias("bits"))
    # In two steps, so that the long order is that of runs.
    runs = whole.groupBy(F.shiftright("cell", RUN_BITS).alias("run")).agg(_in_order("cell", "bits").alias("bits"))
    return runs.agg(F.flatten(_in_order("run", "bits")).alias("table"))


def _in_order(place: str, value: str) -> Column:
    """The values of a group as an array in the order of their places."""
    return F.transform(F.array_sort(F.collect_list(F.struct(place, value))), lambda c: c[value])


def windows(words: DataFrame, longest: int, least: int, bits: int) -> DataFrame:
    """(lang, w0, w1, ..., n): each window and how often it occurs, padded from the first rare pair on."""
    table = written(frequent_buckets(words, least, bits), "pair-buckets").scalar()

    def frequent(first: str, second: str) -> Column:
        bucket = _bucket("lang", first, second, bits)
        cell = F.get(table, F.shiftright(bucket, 6).cast("int"))
        return F.call_function("shiftright", cell, bucket.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1

    rows = _leads(words, longest)
    for k in range(1, longest):
        # A padded column makes its pair null, and so pads the rest.
        known = F.col(f"w{k - 1}").isNotNull() & F.col(f"w{k}").isNotNull()
        rows = rows.withColumn(f"w{k}", F.when(known & frequent(f"w{k - 1}", f"w{k}"), F.col(f"w{k}")))
    return rows.groupBy("lang", *(f"w{k}" for k in range(longest))).agg(F.count("*").alias("n"))


def phrases(documents: DataFrame, longest: int = LONGEST, least: int = LEAST, bits: int = BUCKET_BITS) -> DataFrame:
    """(lang, phrase, a): the exact count of every phrase of 1 to ``longest`` words that occurs ``least`` times.

    The row whose phrase is null counts all words of its language.
    """
    columns = [f"w{k}" for k in range(longest)]
    counted = windows(pieces(documents), longest, least, bits)
    summed = counted.rollup("lang", *columns).agg(F.sum("n").alias("a"), F.grouping_id().alias("summed_over"))
    size = F.lit(longest) - F.call_function("bit_count", F.col("summed_over"))
    last = F.get(F.array(*columns), size - 1)
    # A null language is the sum over all, a null last word an occurrence that is shorter than the phrase.
    whole = F.col("lang").isNotNull() & ((size == 0) | (last.isNotNull() & (F.col("a") >= least)))
    return summed.filter(whole).select("lang", F.when(size > 0, F.concat_ws(" ", *columns)).alias("phrase"), "a")


def _part(start: Column | int, length: Column) -> Column:
    return F.array_join(F.slice("words", start, length), " ")


def collocations(
    documents: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    covered: int = COVERED,
    top: int = TOP,
    bits: int = BUCKET_BITS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language whose weakest cut binds most.

    A candidate occurs a times, ``least`` at least, and has 2 to ``longest`` words. A cut leaves a first part that
    occurs l times and a rest that occurs r times; of n words its score is floor(1000 a n / (l r)). The lowest-scoring
    cut counts, of equal ones that nearest the beginning. Candidates inside a longer one that occurs ``covered``
    hundredths as often are left out; as a longer phrase is never more frequent, those a word longer decide.
    """
    counts = written(phrases(documents, longest, least, bits), "phrases")
    totals = counts.filter("phrase IS NULL").select("lang", F.col("a").alias("n"))
    known = counts.filter("phrase IS NOT NULL")
    candidates = known.withColumn("words", F.split("phrase", " ")).filter(F.size("words") > 1)

    size = F.size("words")
    cuts = candidates.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    parts = cuts.select(
        "lang", "phrase", "a", "k", _part(1, F.col("k")).alias("first"), _part(F.col("k") + 1, size - F.col("k")).alias("rest")
    )
    first = known.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    rest = known.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    cut = parts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"]).join(totals, "lang")

    exact = lambda c: F.col(c).cast("decimal(19,0)")
    above = exact("a") * exact("n") * F.lit(SCALE).cast("decimal(4,0)")
    score = F.call_function("div", above, exact("l") * exact("r"))
    scored = cut.withColumn("score", score).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r", "n")).alias("cut")
    )
    longer = candidates.filter(size > 2)
    inside = F.explode(F.array(_part(1, size - 1), _part(2, size - 1)))
    above_it = longer.select("lang", inside.alias("phrase"), F.col("a").alias("of_longer")).groupBy("lang", "phrase").agg(
        F.max("of_longer").alias("of_longer")
    )
    kept = scored.join(above_it, ["lang", "phrase"], "left").filter(
        F.col("of_longer").isNull() | (F.lit(100).cast("decimal(3,0)") * exact("of_longer") < F.lit(covered).cast("decimal(9,0)") * exact("a"))
    )
    best = [F.desc("score"), F.desc("a"), "phrase"]
    rows = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.n", "cut.score")
    # Two steps, so that no task ranks all phrases of a language.
    parted = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    few = parted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))).filter(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
