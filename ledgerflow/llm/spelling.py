"""Spelling variants: words one inserted, deleted or replaced letter apart, by rotations of marked words."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerflow.llm.common import written

# Letters of a run, as a class of a regular expression.
LETTERS = "[A-Za-z\\u00C0-\\u00FF]"
MIN_LENGTH = 7
MIN_COUNT = 2
# A form is so many times as frequent as its variant.
FORM_FACTOR = 10
# Words whose rotations one task makes.
WORDS_PER_TASK = 20_000
# Ends every word inside its rotations; no letter.
END = "$"


def vocabulary(
    docs: DataFrame,
    text: str = "text",
    spelt: Callable[[Column], Column] = F.lower,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """(word, n): the words of all whole texts, each as ``spelt`` gives it for its run of letters.

    ``spelt`` may read other columns of ``docs``, whatever their names, and
    never lengthens a run. A null text has no words, repeated rows count each,
    a text is read whole however long; an empty table has no words.
    Counts are combined before the shuffle, so a frequent word is no hot key.
    """
    # A run of so many letters is a maximal run: matches are greedy and begin at its first letter.
    runs = F.regexp_extract_all(F.col(f"`{text}`").cast("string"), F.lit(f"{LETTERS}{{{min_length},}}"), F.lit(0))
    name = "run"
    while name in (c.lower() for c in docs.columns):
        name += "_"
    words = docs.select("*", F.explode(runs).alias(name)).select(spelt(F.col(name)).alias("word"))
    counts = words.where(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= min_count)


def _ranges(word: Column) -> Column:
    """The prefix ranges of a word's rotations: (range, whole, indel).

    The rotation that begins behind letter i and ends with it, without that
    last letter, is a range all words share that differ there only. A word
    with that letter missing has the range itself as a rotation (``whole``).
    Of a run of one letter only the first is taken out (``indel``), so that a
    pair of words meets once.
    """

    def letter(at: Column) -> Column:
        return F.substring(word, at, F.lit(1))

    def edited(at: Column) -> Column:
        behind = F.substring(word, at + 1, F.length(word))
        return F.struct(
            F.concat(behind, F.lit(END), F.substring(word, F.lit(1), at - 1)).alias("range"),
            F.lit(False).alias("whole"),
            ((at == 1) | (letter(at) != letter(at - 1))).alias("indel"),
        )

    def rotated(at: Column) -> Column:
        behind = F.substring(word, at + 1, F.length(word))
        return F.struct(
            F.concat(behind, F.lit(END), F.substring(word, F.lit(1), at)).alias("range"),
            F.lit(True).alias("whole"),
            F.lit(False).alias("indel"),
        )

    places = F.sequence(F.lit(0), F.length(word))
    return F.concat(F.transform(F.slice(places, F.lit(2), F.length(word)), edited), F.transform(places, rotated))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, near_n, near): how many words are one edit away, and the most frequent of them.

    Rotations are sorted within their ranges, each range is scanned once: it
    holds a word for each letter of the alphabet at most, and every member
    learns the number of the others and the first of them in order, without
    any pair being made. A pair differs at one place, hence meets in one range.
    """
    ranked = F.struct((-F.col("n")).alias("less"), F.col("word").alias("word"))
    entries = words.where("word is not null").select(F.inline(_ranges(F.col("word"))), ranked.alias("rank"))
    whole, indel = F.col("whole"), F.col("indel")
    scan = Window.partitionBy("range").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first, second = (F.nth_value(F.when(~whole, F.col("rank")), i, True).over(scan) for i in (1, 2))
    scanned = entries.select(
        "rank",
        "whole",
        "indel",
        F.count(F.lit(1)).over(scan).alias("members"),
        F.count_if(~whole).over(scan).alias("edited"),
        F.count_if(indel).over(scan).alias("indels"),
        first.alias("first"),
        second.alias("second"),
        F.first(F.when(indel, F.col("rank")), True).over(scan).alias("longer"),
        F.first(F.when(whole, F.col("rank")), True).over(scan).alias("shorter"),
    ).where("members > 1")
    other = F.when(F.col("first") == F.col("rank"), F.col("second")).otherwise(F.col("first"))
    shorter = F.when(indel, F.col("shorter"))
    found = scanned.select(
        F.col("rank.word").alias("word"),
        F.when(whole, F.col("indels")).otherwise(F.col("edited") - 1 + shorter.isNotNull().cast("long")).alias("near"),
        F.when(whole, F.col("longer")).otherwise(F.least(other, shorter)).alias("best"),
    )
    return (
        found.where("near > 0")
        .groupBy("word")
        .agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
        .select("word", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.word").alias("near"))
    )


def variants(words: DataFrame, factor: int = FORM_FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a vocabulary (word, n) of distinct words.

    A word's form is its most frequent near word (of ties the least in order
    of code points), if that is ``factor`` times as frequent; its root is the
    last word on the way from form to form. Null words are left out; the empty
    word is one; words may be of any length and any letters but ``END``;
    further columns are not read. An empty vocabulary gives no row.
    """
    words = written(words.where("word is not null").select("word", "n"), "vocabulary")
    formed = F.col("near_n") >= factor * F.col("n")
    # Dealt out anew: a task makes some twenty rotations of each of its words.
    spread = words.repartition(1 + words.count() // WORDS_PER_TASK)
    found = words.join(near_words(spread), "word", "left").select(
        "word",
        F.when(formed, F.col("near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("near_n")).alias("form_n"),
    )
    found = written(found, "forms")
    return found.join(roots(found), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form: pointers doubled until every one is at an end.

    Each step multiplies the count, so a chain of forms has at most
    log(largest n) links and the rounds are the logarithm of that.
    """
    hops = written(forms.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = hops.select(F.col("word").alias("root"), F.col("root").alias("next"))
        hops = written(
            hops.join(onward, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "roots",
        )
        if hops.where("moved").isEmpty():
            return hops.select("word", "root")
        hops = hops.select("word", "root")
