"""What a chain of filters removes in every order, from one count for each combination of failures."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

FILTERS = "ABCDE"
ORDERS = tuple("".join(p) for p in permutations(FILTERS))
# The limits of the filters.
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITALS_PERCENT = 3
SIGNS = "[#$%&*|]"
BLANKS = "[\\x20\\x09-\\x0D]+"


def bit(name: str) -> int:
    """The bit of a filter in a mask of failures."""
    return 1 << FILTERS.index(name)


def own_failures(text: Column) -> Column:
    """The mask of the filters A to D, which a text fails by itself."""
    words = F.filter(F.split(text, BLANKS), lambda w: w != "")
    capitals = F.octet_length(text) - F.octet_length(F.regexp_replace(text, "[A-Z]+", ""))
    fails = {
        "A": F.size(words) < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * F.size(words),
        "C": 100 * capitals > MAX_CAPITALS_PERCENT * F.length(text),
        "D": text.rlike(SIGNS),
    }
    return sum((F.when(failed, bit(name)).otherwise(0) for name, failed in fails.items()), F.lit(0))


def mask_cells(docs: DataFrame, labels: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """(part, mask, docs, good, toxic): documents by part and combination of failed filters.

    A document fails E when a smaller key has its text. Copies are counted by
    text, part and label before they meet, so a group of copies is a few rows
    however large: those that hold the group's smallest key pass, all others fail.
    """
    content = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{key}`").alias("key"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.sha2(content, 256).alias("text_sha"),
        own_failures(content).alias("mask"),
    )
    judged = (
        labels.where(F.col(f"`{key}`").isNotNull())
        .groupBy(F.col(f"`{key}`").alias("key"))
        .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    )
    known = ["part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")]
    # Rows without key have no label and no smaller key: they stay out of the join.
    free = rows.where("key is null").groupBy("part", "mask").agg(F.count("*").alias("docs"))
    # By key first, which the join has dealt out already; then by text, combined before the shuffle.
    by_key = (
        rows.where("key is not null").join(judged, "key", "left").groupBy("key", "text_sha", *known).agg(F.count("*").alias("n"))
    )
    copies = by_key.groupBy("text_sha", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("key").alias("least"), F.min_by("n", "key").alias("n_least")
    )
    least = copies.groupBy("text_sha").agg(F.min("least").alias("first"))
    passing = F.when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(0)
    both = copies.join(least, "text_sha").select(
        "part",
        "good",
        "toxic",
        F.inline(
            F.array(
                F.struct(F.col("mask"), passing.cast("long").alias("docs")),
                F.struct(F.col("mask").bitwiseOR(bit("E")).alias("mask"), (F.col("n") - passing).cast("long").alias("docs")),
            )
        ),
    )
    none = F.lit(False)
    return (
        both.where("docs > 0")
        .unionByName(free.select("part", "mask", "docs", none.alias("good"), none.alias("toxic")))
        .groupBy("part", "mask")
        .agg(
            F.sum("docs").alias("docs"),
            F.sum(F.when(F.col("good"), F.col("docs")).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("toxic"), F.col("docs")).otherwise(0)).alias("toxic"),
        )
    )


# Figures of a step.
FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
STEPS = "array<struct<filter_order:string,filter:string,step:int," + ",".join(f"{f}:bigint" for f in FIGURES) + ">>"


def order_array() -> Column:
    """All orders as one constant, which travels with the plan: (name, steps) with each step's letter and bit."""
    return F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                F.array(
                    *[
                        F.struct(F.lit(i).alias("step"), F.lit(c).alias("filter"), F.lit(bit(c)).alias("bit"))
                        for i, c in enumerate(name, 1)
                    ]
                ).alias("steps"),
            )
            for name in ORDERS
        ]
    )


def _folded(order: Column) -> Column:
    """A mask cell folded along one order: what each filter does to it, knowing whether it is gone by then."""

    def along(state: Column, step: Column) -> Column:
        gone, fails = state["gone"], F.col("mask").bitwiseAND(step["bit"]) != 0

        def weight(condition: Column, size: str = "docs") -> Column:
            return F.when(condition, F.col(size)).otherwise(0)

        figures = {
            "kept": weight(~fails & ~gone),
            "removed": weight(fails & ~gone),
            "redundant": weight(fails & gone),
            "unique_fails": weight(F.col("mask") == step["bit"]),
            "good_lost": weight(fails & ~gone, "good"),
            "toxic_lost": weight(fails & ~gone, "toxic"),
        }
        made = F.struct(order["name"], step["filter"], step["step"], *[figures[f] for f in FIGURES])
        return F.struct(
            (gone | fails).alias("gone"), F.concat(state["done"], F.array(made).cast(STEPS)).alias("done")
        )

    start = F.struct(F.lit(False).alias("gone"), F.array().cast(STEPS).alias("done"))
    return F.aggregate(order["steps"], start, along, lambda state: state["done"])


def audit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """(part, filter_order, step, figures, shapley): every step of all 120 orders of the filters, per part.

    A filter fails a document by itself: A under 200 words, B under 50 %
    distinct words, C more than 3 % capitals, D a sign of ``SIGNS``, E a smaller
    key with the same text. Orders are not run over documents: a document is
    one of 32 masks, each mask cell is folded along the constant array of
    orders into 600 weighted structs, and those of a part are summed.

    Null text is empty; null part is the empty string; rows without key have
    no label and pass E; rows that repeat key and text pass or fail E alike.
    A text is judged whole, however long; columns besides the named ones are
    not read; no documents give no rows. Repeated labels of a key count if any is 1.
    """
    cells = mask_cells(docs, labels, key, text, part)
    folded = F.flatten(F.transform(order_array(), _folded))
    sums = (
        cells.select("part", F.inline(folded))
        .groupBy("part", "filter_order", "filter", "step")
        .agg(*[F.sum(f).alias(f) for f in FIGURES])
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "filter"))
    return sums.withColumn("shapley", shapley).drop("filter")


def oracle_sql() -> str:
    """The audit of ``documents`` and ``labels`` by plain SQL: every order applied to every mask cell."""
    letters = ", ".join(f"('{c}', {bit(c)})" for c in FILTERS)
    each = " join ".join(
        f"letters l{i}" + (f" on l{i}.f not in ({', '.join(f'l{j}.f' for j in range(1, i))})" if i > 1 else "")
        for i in range(1, len(FILTERS) + 1)
    )
    name = " || ".join(f"l{i}.f" for i in range(1, len(FILTERS) + 1))
    return f"""
with texts as (select doc_id, coalesce(lang, '') part, coalesce(text, '') t from documents),
worded as (select *, regexp_extract_all(t, '{BLANKS.replace('[', '[^')}') words,
                  min(doc_id) over (partition by t) first from texts),
masks as (select doc_id, part,
    case when len(words) < {MIN_WORDS} then {bit("A")} else 0 end
  + case when 100 * list_unique(words) < {MIN_DISTINCT_PERCENT} * len(words) then {bit("B")} else 0 end
  + case when 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > {MAX_CAPITALS_PERCENT} * length(t) then {bit("C")} else 0 end
  + case when regexp_matches(t, '{SIGNS}') then {bit("D")} else 0 end
  + case when doc_id > first then {bit("E")} else 0 end mask from worded),
judged as (select doc_id, max((quality = 1)::int) good, max((toxic = 1)::int) toxic from labels group by doc_id),
cells as (select part, mask, count(*) docs, sum(coalesce(good, 0)) good, sum(coalesce(toxic, 0)) toxic
          from masks left join judged using (doc_id) group by part, mask),
letters(f, b) as (values {letters}),
orders as (select {name} filter_order from {each}),
steps as (select filter_order, step::int step, f, b,
                 coalesce(sum(b) over (partition by filter_order order by step rows between unbounded preceding and 1 preceding), 0)::int before
          from orders, range(1, {len(FILTERS) + 1}) s(step), letters where f = substr(filter_order, step, 1)),
sums as (select part, filter_order, step, f,
    sum(case when mask & (before | b) = 0 then docs else 0 end)::bigint kept,
    sum(case when mask & before = 0 and mask & b <> 0 then docs else 0 end)::bigint removed,
    sum(case when mask & before <> 0 and mask & b <> 0 then docs else 0 end)::bigint redundant,
    sum(case when mask = b then docs else 0 end)::bigint unique_fails,
    sum(case when mask & before = 0 and mask & b <> 0 then good else 0 end)::bigint good_lost,
    sum(case when mask & before = 0 and mask & b <> 0 then toxic else 0 end)::bigint toxic_lost
  from cells, steps group by all)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) over (partition by part, f))::bigint shapley from sums
"""
