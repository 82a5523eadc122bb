"""Benchmark decontamination by a positional inverted index, in DataFrame operations only.

``index`` stores a posting (document, position, term) for every corpus token
that is a term of the benchmark, and one row without a term for each document.
``occurrences`` takes each benchmark window's ``RAREST`` rarest terms, shifts
their posting lists by the terms' offsets in the item and intersects them: what
is left are (document, item, shift) alignments that have all of these terms of
some window. Each alignment's other terms are then looked up in the postings,
and runs of ``WINDOW`` matches are hits.

No list of documents is ever gathered: hot terms are split by the shuffles on
(document, position), and what is broadcast is bounded in rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starwright.storage import written

from .common import bounded

#: Consecutive item words that make a window; a shorter item is one window.
WINDOW = 13
#: Lists that are intersected for each window, the rarest term's first.
RAREST = 4
#: Classes of documents that a broadcast filter tells apart.
BUCKETS = 1 << 18
#: Benchmark vocabularies up to this size are joined by broadcast, larger ones by shuffle.
BROADCAST_TERMS = 1 << 18
#: What separates words; capitals are letters here, and are lowered word by word.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lowered(word: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    ascii_only = F.octet_length(word) == F.char_length(word)
    return F.when(ascii_only, F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def _split(rows: DataFrame, text: str = "text") -> DataFrame:
    """Add the array ``words`` (capitals kept, an empty one at an end possible) and ``n_words``."""
    rows = rows.withColumn("words", F.split(F.coalesce(text, F.lit("")), SEPARATORS))
    ends = (F.element_at("words", 1) == "").cast("int") + (F.element_at("words", -1) == "").cast("int")
    # One empty word is the first and the last.
    return rows.withColumn("n_words", F.greatest(F.size("words") - ends, F.lit(0)).cast("long"))


def items(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(ik, item_id, n, ipos, word) of every word of every distinct (id, text) row with words."""
    rows = benchmark.select(F.col(item).alias("item_id"), F.col(text).alias("text")).distinct()
    rows = _split(rows.withColumn("ik", F.xxhash64("item_id", "text")))
    words = rows.select("ik", "item_id", F.col("n_words").alias("n"), F.posexplode("words").alias("ipos", "word"))
    return words.where("word != ''").withColumn("word", _lowered(F.col("word")))


def index(docs: DataFrame, vocabulary: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Store the postings of the vocabulary's terms: (id, h, n_words, pos, term).

    ``vocabulary`` has (word, term), each word once. ``h`` tells apart rows that
    share an id. The row at a document's first position is kept with a null
    term if that word is none, so every input row is present; a document
    without words has one row with a null term.
    """
    rows = docs.select(F.col(doc).alias("id"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    rows = _split(rows).select("id", "h", "n_words", F.posexplode("words").alias("pos", "raw"))
    vocabulary = vocabulary.withColumnRenamed("word", "known")
    found = rows.withColumn("word", _lowered(F.col("raw")))
    found = found.join(bounded(vocabulary, BROADCAST_TERMS), F.col("word") == F.col("known"), "left")
    found = found.where(F.col("term").isNotNull() | (F.col("pos") == 0))
    return written(found.select("id", "h", "n_words", "pos", "term"), "postings")


def _rarest(placed: DataFrame, counts: DataFrame) -> DataFrame:
    """(ik, w, seeds) of each window: its rarest terms as an array of (df, ipos, term), the rarest first.

    Windows with a term that no document has are left out.
    """
    width = F.least(F.col("n"), F.lit(WINDOW))
    first = F.greatest(F.col("ipos") - width + 1, F.col("from"))
    last = F.least(F.col("ipos"), F.col("from") + F.col("n") - width)
    placed = placed.withColumn("from", F.min("ipos").over(Window.partitionBy("ik")))
    members = placed.withColumn("w", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    members = members.join(counts, "term", "left")
    best = members.groupBy("ik", "w").agg(
        F.sort_array(F.collect_list(F.struct("df", "ipos", "term"))).alias("by"),
        F.count("df").alias("present"),
        F.count("*").alias("all"),
    )
    return best.where("present = all").select("ik", "w", F.slice("by", 1, RAREST).alias("seeds"))


def occurrences(postings: DataFrame, placed: DataFrame) -> DataFrame:
    """Document words inside occurrences of item windows: distinct (id, h, pos, item_id).

    ``placed`` has (ik, item_id, n, ipos, term) for every word of every item.
    """
    lists = postings.where(F.col("term").isNotNull()).select("id", "h", "pos", "term")
    counts = lists.groupBy("term").agg(F.count("*").alias("df"))
    windows = written(_rarest(placed, counts), "windows")
    seeds = windows.select("ik", F.explode("seeds").alias("s")).select("ik", "s.ipos", "s.term").distinct()
    at = lists.join(bounded(written(seeds, "seeds"), BROADCAST_TERMS), "term").select(
        "id", "h", "ik", (F.col("pos") - F.col("ipos")).alias("shift"), "ipos"
    )
    # The offset-adjusted lists meet; most alignments have one term and no window of one.
    least = windows.groupBy("ik").agg(F.min(F.size("seeds")).alias("least"))
    both = at.groupBy("id", "h", "ik", "shift").agg(F.collect_set("ipos").alias("has"))
    both = both.join(bounded(written(least, "least"), BROADCAST_TERMS), "ik").where(F.size("has") >= F.col("least"))
    needed = windows.select("ik", F.col("seeds.ipos").alias("needed"))
    aligned = both.join(bounded(needed, BROADCAST_TERMS), "ik")
    aligned = aligned.where(F.size(F.array_except("needed", "has")) == 0)
    aligned = written(aligned.select("id", "h", "ik", "shift").distinct(), "alignments")

    wanted = aligned.join(bounded(placed, BROADCAST_TERMS), "ik")
    wanted = wanted.select("id", "h", "ik", "item_id", "n", "shift", "ipos", "term", (F.col("shift") + F.col("ipos")).alias("pos"))
    # Postings of other documents drop out before the shuffle: at most BUCKETS hashes of hashes are broadcast.
    bucket = F.pmod(F.col("h"), F.lit(BUCKETS)).cast("int")
    near = lists.withColumn("bucket", bucket).join(F.broadcast(aligned.select(bucket.alias("bucket")).distinct()), "bucket", "left_semi")
    near = near.select(F.col("id").alias("_id"), F.col("h").alias("_h"), F.col("pos").alias("_pos"), F.col("term").alias("_term"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")) & (F.col("pos") == F.col("_pos")) & (F.col("term") == F.col("_term"))
    matched = wanted.join(near, same, "left_semi")
    run = Window.partitionBy("id", "h", "ik", "shift")
    matched = matched.withColumn("run", F.col("ipos") - F.row_number().over(run.orderBy("ipos")))
    matched = matched.withColumn("long", F.count("*").over(run.partitionBy("id", "h", "ik", "shift", "run")))
    return matched.where(F.col("long") >= F.least(F.col("n"), F.lit(WINDOW))).select("id", "h", "pos", "item_id").distinct()


def near(postings: DataFrame, pairs: DataFrame, within: int) -> DataFrame:
    """Proximity matches: (id, h, a, b, pos_a, pos_b) where two terms lie at most ``within`` words apart.

    ``pairs`` has (a, b). Lists meet in blocks of ``within`` positions and the
    blocks beside, so no two lists are crossed.
    """
    lists = postings.where(F.col("term").isNotNull()).withColumn("block", F.floor(F.col("pos") / max(within, 1)))
    left = lists.join(pairs, F.col("term") == F.col("a")).select("id", "h", "a", "b", F.col("pos").alias("pos_a"), "block")
    right = lists.select(F.col("id").alias("_id"), F.col("h").alias("_h"), F.col("term").alias("_b"), F.col("pos").alias("pos_b"), F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1)).alias("_block"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")) & (F.col("b") == F.col("_b")) & (F.col("block") == F.col("_block"))
    met = left.join(right, same & (F.abs(F.col("pos_a") - F.col("pos_b")) <= within))
    return met.where((F.col("a") != F.col("b")) | (F.col("pos_a") != F.col("pos_b"))).select("id", "h", "a", "b", "pos_a", "pos_b").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """(doc_id, h, n_words, n_hit, n_items, items_sha256, contaminated) for every input row.

    A row is contaminated if it has hit words and they are a twentieth of its
    words or more. Null texts have no words; rows that are repeated get the
    same values; null item ids count as no item. An empty benchmark hits nothing.
    """
    words = written(items(benchmark, item, text), "item-words")
    vocabulary = written(words.select("word").distinct().withColumn("term", F.monotonically_increasing_id()), "terms")
    placed = written(words.join(vocabulary, "word").drop("word"), "item-terms")
    postings = index(docs, vocabulary, doc, text)
    hits = written(occurrences(postings, placed), "hits")
    n_hit = hits.select("id", "h", "pos").distinct().groupBy("id", "h").agg(F.count("*").alias("n_hit"))
    found = hits.select("id", "h", F.col("item_id").cast("string").alias("item")).where("item IS NOT NULL").distinct()
    found = found.groupBy("id", "h").agg(F.sort_array(F.collect_list("item")).alias("items"))
    both = n_hit.join(found, n_hit["id"].eqNullSafe(found["id"]) & (n_hit["h"] == found["h"]), "left")
    both = both.select(n_hit["id"].alias("_id"), n_hit["h"].alias("_h"), "n_hit", "items")
    base = postings.where("pos = 0").select("id", "h", "n_words")
    out = base.join(both, F.col("id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left")
    hit = F.coalesce("n_hit", F.lit(0))
    return out.select(
        F.col("id").alias("doc_id"),
        "h",
        "n_words",
        hit.cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated"),
    )
