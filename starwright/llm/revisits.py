"""Resolving not-modified revisit records of web captures.

A revisit (a 304 answer) has no payload of its own; it stands for the latest
earlier full response of the same canonical URL, if its validators agree with
that response. Its permitted headers then replace the response's.

The as-of join deals each URL's captures into time buckets, so a URL that holds
a third of all captures is many groups: the last response of each bucket is
carried to later buckets over bucket rows only, and captures are ordered within
their bucket. Payloads never move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Header fields that a 304 answer may update (RFC 9110, 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
#: Captures of one URL that lie in so many time units share a bucket.
BUCKET = 4096


def canonical_url(url: Column) -> Column:
    """Without scheme, fragment, tracking parameters (utm_*, ref), "www." and a last slash; host in lower case."""
    bare = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    bare = F.regexp_replace(bare, r"([?&])((utm_[A-Za-z]*|ref)=[^&]*&)*((utm_[A-Za-z]*|ref)=[^&]*)?", "$1")
    bare = F.regexp_replace(bare, r"[?&]+$", "")
    host = F.regexp_extract(bare, r"^[^/?]*", 0)
    rest = F.regexp_replace(F.regexp_replace(bare, r"^[^/?]*", ""), "/$", "")
    return F.concat(F.regexp_replace(F.lower(host), r"^www\.", ""), rest)


def resolve(captures: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """One row for each revisit: (capture_id, url_key, refers_to, state, headers).

    ``captures`` has (capture_id, url, ts long, revisit boolean, headers
    map<string,string> with lower-case names). ``state`` is "resolved", or why
    not: "no response", "no validator", "mismatch". An entity tag decides if the
    revisit has one (weak comparison), else last-modified. Equal times: responses
    come first, and among them the largest id is the latest. Rows without url
    or time are never referred to and have no response. Headers of unresolved
    revisits are their own.
    """
    rows = captures.select("capture_id", canonical_url(F.col("url")).alias("url_key"), "ts", "revisit", "headers")
    rows = rows.withColumn("bucket", F.floor(F.col("ts") / bucket))
    full = F.struct("ts", "capture_id", "headers")
    sortable = F.struct("ts", "capture_id")
    usable = ~F.col("revisit") & F.col("url_key").isNotNull() & F.col("ts").isNotNull()
    last = rows.where(usable).groupBy("url_key", "bucket").agg(F.max_by(full, sortable).alias("last"))
    before = Window.partitionBy("url_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = rows.where("url_key IS NOT NULL AND ts IS NOT NULL").select("url_key", "bucket").distinct()
    carried = buckets.join(last, ["url_key", "bucket"], "left")
    carried = carried.withColumn("carried", F.last("last", ignorenulls=True).over(before)).drop("last")
    within = Window.partitionBy("url_key", "bucket").orderBy("ts", "revisit", "capture_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("own", F.last(F.when(usable, full), ignorenulls=True).over(within)).where("revisit")
    rows = rows.join(carried, ["url_key", "bucket"], "left")
    placed = F.col("url_key").isNotNull() & F.col("ts").isNotNull()
    rows = rows.withColumn("at", F.when(placed, F.coalesce("own", "carried")))
    mine, theirs = F.col("headers"), F.col("at.headers")
    tag = lambda h: F.regexp_replace(h["etag"], "^W/", "")
    by_tag, by_date = mine["etag"].isNotNull(), mine["last-modified"].isNotNull()
    agrees = F.when(by_tag, tag(mine) == tag(theirs)).otherwise(mine["last-modified"] == theirs["last-modified"])
    state = (
        F.when(F.col("at").isNull(), "no response")
        .when(~(by_tag | by_date), "no validator")
        .when(F.coalesce(agrees, F.lit(False)), "resolved")
        .otherwise("mismatch")
    )
    update = F.map_filter(mine, lambda k, _: k.isin(*PERMITTED))
    kept = F.map_filter(theirs, lambda k, _: ~F.array_contains(F.map_keys(update), k))
    return rows.withColumn("state", state).select(
        "capture_id",
        "url_key",
        F.when(F.col("state") == "resolved", F.col("at.capture_id")).alias("refers_to"),
        "state",
        F.when(F.col("state") == "resolved", F.map_concat(kept, update)).otherwise(mine).alias("headers"),
    )


def captures_of(pages: DataFrame) -> DataFrame:
    """Captures that Spark derives from pages: of each page a full response, and a later revisit.

    Validators are the page's digest and a date; some revisits carry none, only
    the date, or one that is out of date.
    """
    id_, text = F.col("page_id"), F.coalesce("html", F.lit(""))
    date = F.concat(F.lit("day "), (id_ % 28).cast("string"))
    tag = F.md5(text.cast("binary"))
    pairs = lambda *x: F.map_filter(F.create_map(*x), lambda _, v: v.isNotNull())
    response = pages.select(
        (2 * id_).alias("capture_id"),
        "url",
        (10 * id_).alias("ts"),
        F.lit(False).alias("revisit"),
        pairs(
            F.lit("etag"), tag, F.lit("last-modified"), date, F.lit("date"), (10 * id_).cast("string"),
            F.lit("content-length"), F.octet_length(text).cast("string"), F.lit("content-type"), F.lit("text/html"),
        ).alias("headers"),
    )
    later = 10 * id_ + 5 + (id_ * 37 % 1000) * 10
    kind = id_ % 8
    revisit = pages.select(
        (2 * id_ + 1).alias("capture_id"),
        "url",
        later.alias("ts"),
        F.lit(True).alias("revisit"),
        pairs(
            F.lit("etag"), F.when(kind < 4, tag).when(kind == 4, F.concat(F.lit("W/"), tag)).when(kind == 5, F.lit("old")),
            F.lit("last-modified"), F.when(kind == 6, date), F.lit("date"), later.cast("string"),
            F.lit("content-length"), F.lit("0"), F.lit("cache-control"), F.lit("max-age=60"),
        ).alias("headers"),
    )
    return response.unionByName(revisit)
