"""License scan with column functions only: MinHash bands over windows, exact shingle containment."""

from __future__ import annotations

from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerflow.llm.common import written

SHINGLE_WORDS = 5
# Shingles of a window, and how far apart windows begin: every shingle lies in two windows.
WINDOW_SHINGLES = 4
WINDOW_STEP = 2
# A template that stands in a text meets none of its windows in any band with this probability at most;
# as many bands are made as the worst of the templates needs.
MAX_MISS = 1e-6
# Bands of one row each that are tried for it, and those that any template of four shingles or more needs: its window
# and the text's have three of five shingles in common at least, (2/5)**16 < MAX_MISS.
MOST_BANDS = 512
LEAST_BANDS = 16
MIN_CONTAINMENT = 0.8
# Templates are broadcast; this bounds their words.
MAX_TEMPLATE_WORDS = 20_000

# Notices by which texts name their license.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "either version 3 of the License, or (at your option) any later version.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without"
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
        " Software, and to permit persons to whom the Software is furnished to do so, subject to the following"
        " conditions: The above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS"
        " OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE"
        " AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR"
        " OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION"
        " WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies. THE"
        " SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING"
        " ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,"
        " DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR"
        " PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN"
        " CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def words(text: Column) -> Column:
    """Lower-case words of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def shingles(tokens: Column) -> Column:
    """The distinct shingles of a word array, as strings; fewer words than a shingle have none.

    ``tokens`` must be a plain column: an expression would be worked out for every shingle.
    """
    count = F.size(tokens) - SHINGLE_WORDS + 1
    starts = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, SHINGLE_WORDS), " ")))


def _hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _shingle_hashes(size: int) -> list[Column]:
    """Hashes of the shingles of the window that begins at word ``i`` of ``h``; NULL beyond the text."""
    at = [F.get("h", F.col("i") + F.lit(k)) for k in range(size + SHINGLE_WORDS - 1)]
    return [
        F.when(at[k].isNotNull() & at[k + SHINGLE_WORDS - 1].isNotNull(), F.xxhash64(*at[k : k + SHINGLE_WORDS])).alias(f"s{k}")
        for k in range(size)
    ]


def _least(size: int) -> Column:
    """The least hash of a window's shingles in its band, whose number seeds the hash function."""
    own = [F.when(F.col(f"s{k}").isNotNull(), F.xxhash64(f"s{k}", "band")) for k in range(size)]
    return F.least(*own) if size > 1 else own[0]


def bands(windows: DataFrame, keep: list[str], size: int, count: int) -> DataFrame:
    """The kept columns and ``value``: for each band the least hash of the window's shingles.

    ``windows`` has the word hashes ``h`` of a text and a window's start ``i``.
    Values of different bands do not meet. The generators keep the shingles and
    the band as plain columns: a window is hashed once for each shingle and
    band, in compiled code.
    """
    cut = windows.select(*keep, F.inline(F.array(F.struct(*_shingle_hashes(size)))))
    seeded = cut.select("*", F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("band"))
    return seeded.select(*keep, _least(size).alias("value"))


def _template_windows(spark: SparkSession, templates: tuple[tuple[str, str], ...]) -> list[tuple[int, DataFrame]]:
    """(shingles, windows) of the templates: all windows of a template, or the whole of one that is shorter."""
    rows = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(templates)], "template int, body string")
    rows = rows.select("template", _hashes(F.col("body")).alias("h")).withColumn("n", F.size("h") - SHINGLE_WORDS + 1)
    starts = F.explode(F.sequence(F.lit(0), F.col("n") - WINDOW_SHINGLES)).alias("i")
    short = [(t, rows.where(F.col("n") == t).withColumn("i", F.lit(0))) for t in range(1, WINDOW_SHINGLES)]
    return [*short, (WINDOW_SHINGLES, rows.where(F.col("n") >= WINDOW_SHINGLES).select("*", starts))]


def band_count(spark: SparkSession, templates: tuple[tuple[str, str], ...], max_miss: float = MAX_MISS) -> int:
    """How many bands every template needs to be met with probability 1 - ``max_miss`` wherever it stands.

    A template's own least hash m in a band is known. Foreign shingles hash
    evenly, so the f of them that share the window all lie above with
    probability (1 - m)**f: two or one for a template of two or three shingles,
    three for one of a single shingle, which lies in two windows that share one
    of the five shingles around it.
    The products over the bands are taken for each template, and the count is
    where the last of them falls below ``max_miss``.
    """
    parts = []
    for size, windows in _template_windows(spark, templates)[: WINDOW_SHINGLES - 1]:
        cut = windows.select("template", F.inline(F.array(F.struct(*_shingle_hashes(size)))))
        tried = cut.select("*", F.explode(F.sequence(F.lit(0), F.lit(MOST_BANDS - 1))).alias("band"))
        least = _least(size).cast("double") / F.lit(2.0**64) + 0.5
        above = 1 - least
        if size == 1:
            miss = 1 - 2 * F.pow(above, F.lit(3)) + F.pow(above, F.lit(5))
        else:
            miss = 1 - F.pow(above, F.lit(WINDOW_SHINGLES - size))
        parts.append(tried.select("template", "band", F.log(F.greatest(miss, F.lit(1e-300))).alias("miss")))
    upto = Window.partitionBy("template").orderBy("band")
    summed = reduce(DataFrame.union, parts).withColumn("miss", F.sum("miss").over(upto))
    needed = summed.groupBy("template").agg(F.min(F.when(F.col("miss") <= log(max_miss), F.col("band") + 1)).alias("bands"))
    row = needed.agg(F.max(F.coalesce("bands", F.lit(MOST_BANDS))).alias("bands")).first()
    return max(LEAST_BANDS, row["bands"] or 0)


def template_bands(spark: SparkSession, templates: tuple[tuple[str, str], ...], count: int) -> DataFrame:
    """(value, template): the bands of every window of every template."""
    parts = [bands(windows, ["template"], size, count) for size, windows in _template_windows(spark, templates)]
    return reduce(DataFrame.union, parts).distinct()


def candidates(docs: DataFrame, key: str, text: str, templates: tuple[tuple[str, str], ...]) -> DataFrame:
    """(``mark``, ``template``): texts, by a hash of key and text, and the templates that a band of theirs meets."""
    spark = docs.sparkSession
    count = band_count(spark, templates)
    hashed = docs.select(F.xxhash64(key, text).alias("mark"), _hashes(F.col(text)).alias("h")).where(F.size("h") >= SHINGLE_WORDS)
    starts = F.sequence(F.lit(WINDOW_STEP - WINDOW_SHINGLES), F.size("h") - SHINGLE_WORDS, F.lit(WINDOW_STEP))
    windows = hashed.select("mark", "h", F.explode(starts).alias("i"))
    met = bands(windows, ["mark"], WINDOW_SHINGLES, count).join(F.broadcast(template_bands(spark, templates, count)), "value")
    return met.select("mark", "template").distinct()


def licenses(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    min_containment: float = MIN_CONTAINMENT,
) -> DataFrame:
    """One row per row: ``key``, ``n_candidates``, ``licenses`` (names, sorted) and ``containment`` of the best template.

    Every text is cut into windows of ``WINDOW_SHINGLES`` shingles that overlap
    by half. A window and a template's window with an equal band value make the
    text a candidate for the template; ``band_count`` bands make that all but
    certain. The candidate matches if the text holds at least ``min_containment`` of the
    template's shingles, compared as strings. Only candidates (a hash of key
    and text, and template numbers) are joined back, and a hash met by chance
    fails the comparison.

    Templates (at least five words each) are broadcast, which their bounded
    number of words allows. Null and empty texts have no license; null and
    repeated keys are rows like others; texts are read whole, other columns are
    not read and may have any name; an empty table gives no row.
    """
    spark = docs.sparkSession
    if sum(len(t.split()) for _, t in templates) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {MAX_TEMPLATE_WORDS} words")
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("body"), F.xxhash64(key, text).alias("mark"))
    found = candidates(docs, key, text, templates)
    found = written(found.groupBy("mark").agg(F.collect_set("template").alias("candidates")), "licenses")
    names = F.array(*[F.lit(name) for name, _ in templates])
    parts = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(templates)], "template int, notice string")
    parts = parts.select("template", F.explode(F.array(words(F.col("notice")))).alias("words"))
    parts = parts.select("template", shingles(F.col("words")).alias("wanted"))
    # Generators keep words and shingles as plain columns, which are made once for a text.
    held = (
        rows.join(found, "mark")
        .select("mark", "candidates", F.explode(F.array(words(F.col("body")))).alias("words"))
        .select("mark", "candidates", F.explode(F.array(shingles(F.col("words")))).alias("own"))
        .select("mark", "own", F.explode("candidates").alias("template"))
        .join(F.broadcast(parts), "template")
        .select("mark", "template", (F.size(F.array_intersect("wanted", "own")) / F.size("wanted")).alias("share"))
        .groupBy("mark")
        .agg(
            F.count_distinct("template").alias("n"),
            F.max("share").alias("share"),
            F.collect_set(F.when(F.col("share") >= min_containment, F.get(names, F.col("template")))).alias("names"),
        )
    )
    return rows.select("key", "mark").join(held, "mark", "left").select(
        F.col("key").alias(key),
        F.coalesce("n", F.lit(0)).alias("n_candidates"),
        F.coalesce(F.array_sort("names"), F.array().cast("array<string>")).alias("licenses"),
        F.coalesce("share", F.lit(0.0)).alias("containment"),
    )
