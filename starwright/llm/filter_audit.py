"""How five filters of a corpus interact: every order of them, from coalition values.

The removal game of a part (a language, say) gives each of the 32 coalitions of
filters the number of documents that fail at least one of them. Its Hart and
Mas-Colell potential is 0 for no filter, and otherwise

    P(S) = (v(S) + sum of P(S without i) over the filters i in S) / |S|,

and a filter's Shapley value is P(all) - P(all without it). The recursion runs
over |S|! P(S), which are whole numbers, and what all 120 orders sum to is 120
Shapley values. What an order's step removes is a difference of two coalitions.
So the documents are only counted, by part and by the set of filters they fail;
all else is arithmetic on 32 numbers a part.

Defined cases: null text is empty. A document is a copy if a row with a smaller
id has the same text; rows without an id are no copies and make none, and
neither do rows that share both id and text. A null part and an empty one are
one part. Several labels of an id count as set if one is. An empty table has no
parts and gives no rows. Further columns are ignored, whatever they are called.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starwright.storage import written

#: The filters; each is a bit of a set, A the lowest.
FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
COPY = 1 << FILTERS.index("E")
LEAST_WORDS = 200
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COUNTS = ("n", "good", "toxic")


def failures(text: Column) -> Column:
    """The set of filters A to D that a text fails on its own."""
    words = F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")
    counts = F.struct(F.size(words).alias("n"), F.size(F.array_distinct(words)).alias("distinct"))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    # The words are counted once, as the one element of an array that a function maps.
    of_words = F.transform(
        F.array(counts),
        lambda c: F.when(c["n"] < LEAST_WORDS, 1).otherwise(0) + F.when(100 * c["distinct"] < 50 * c["n"], 2).otherwise(0),
    )[0]
    return (
        of_words
        + F.when(100 * capitals > 3 * F.length(text), 4).otherwise(0)
        + F.when(text.rlike("[#$%&*|]"), 8).otherwise(0)
    )


def cells(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """Documents by part and set of failed filters: (part, failed, n, good, toxic).

    Copies are known by two 64-bit hashes of the text. The first id of a text
    is a minimum that folds groups of copies before the shuffle; a document
    then looks itself up by text and id together, so that a group of copies
    spreads over all tasks.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        failures(text).alias("failed"),
        F.xxhash64(text).alias("h1"),
        F.xxhash64(F.lit(1), text).alias("h2"),
    )
    rows = written(rows.groupBy("id", "part", "failed", "h1", "h2").agg(F.count(F.lit(1)).alias("n")), "filtered")
    firsts = rows.groupBy("h1", "h2").agg(F.min("id").alias("id")).where("id IS NOT NULL").withColumn("_first", F.lit(True))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id"))
    marks = marks.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    known = rows.where("id IS NOT NULL").join(written(firsts, "first-copies"), ["id", "h1", "h2"], "left")
    known = known.join(written(marks, "marks"), "id", "left")
    copy = F.when(F.col("_first").isNull(), COPY).otherwise(0)
    known = known.select("part", (F.col("failed") + copy).alias("failed"), "n", "good", "toxic")
    nameless = rows.where("id IS NULL").select("part", "failed", "n", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    marked = [F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")]
    return known.unionByName(nameless).groupBy("part", "failed").agg(*marked, F.sum("n").alias("n"))


def coalitions(counted: DataFrame) -> DataFrame:
    """One row per part: ``total`` and, for each count, an array of its value by coalition."""
    totals = counted.groupBy("part").agg(F.sum("n").alias("total"))
    # A document is in the value of each coalition that it fails a filter of.
    hit = F.expr(f"filter(sequence(0, {ALL}), s -> (s & failed) != 0)")
    values = counted.select("part", *COUNTS, F.explode(hit).alias("coalition")).groupBy("part", "coalition")
    values = values.agg(*[F.sum(c).alias(c) for c in COUNTS])
    by_coalition = F.map_from_entries(F.collect_list(F.struct("coalition", F.struct(*COUNTS))))
    found = values.groupBy("part").agg(by_coalition.alias("_found"))
    every = F.sequence(F.lit(0), F.lit(ALL))
    joined = totals.join(found, "part", "left")
    value = lambda c: F.transform(every, lambda s: F.coalesce(F.try_element_at("_found", s)[c], F.lit(0).cast("long")))
    return joined.select("part", "total", *[value(c).alias(c) for c in COUNTS])


def potential(value: str = "n") -> Column:
    """|S|! P(S) of every coalition S, from an array of coalition values.

    Coalitions come in the order of their bits, so those with a filter less
    are there already.
    """
    before = F.array(*[F.lit(factorial(max(k - 1, 0))) for k in range(len(FILTERS) + 1)])

    def step(done, s):
        own = before[F.bit_count(s)] * F.col(value)[s]
        without = [
            F.when(s.bitwiseAND(1 << i) != 0, done[s.bitwiseXOR(F.lit(1 << i))]).otherwise(0) for i in range(len(FILTERS))
        ]
        return F.concat(done, F.array((own + sum(without, F.lit(0))).cast("long")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ALL)), F.array(F.lit(0).cast("long")), step)


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """Every part, order of the filters and step: what the step keeps, removes and costs.

    ``shapley`` is the step's filter's removals summed over all orders.
    """
    games = coalitions(cells(docs, labels, part)).withColumn("potential", potential())
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = games.select("*", F.explode(orders).alias("filter_order"))
    steps = steps.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    steps = steps.withColumn("bit", F.expr("shiftleft(1, ascii(substring(filter_order, step, 1)) - ascii('A'))"))
    steps = steps.withColumn(
        "before",
        F.expr("aggregate(slice(sequence(1, 5), 1, step - 1), 0, (s, k) -> s + shiftleft(1, ascii(substring(filter_order, k, 1)) - ascii('A')))"),
    ).withColumn("after", F.col("before") + F.col("bit"))
    at = lambda values, coalition: F.col(values)[F.col(coalition)]
    removed = lambda values: at(values, "after") - at(values, "before")
    others = F.lit(ALL) - F.col("bit")
    return steps.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - at("n", "after")).alias("kept"),
        removed("n").alias("removed"),
        (at("n", "bit") - removed("n")).alias("redundant"),
        (F.col("n")[ALL] - F.col("n")[others]).alias("unique_fails"),
        removed("good").alias("good_lost"),
        removed("toxic").alias("toxic_lost"),
        (F.col("potential")[ALL] - len(FILTERS) * F.col("potential")[others]).alias("shapley"),
    )
