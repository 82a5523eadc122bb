"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starwright.storage import scratch_dir

from . import (
    bpe, decontamination, embedding_dedup, filter_audit, jaccard_join, language_id, licenses, line_dedup, lm_scoring, merkle, quality, revisits,
    token_files,
)
from .common import fold, prepare, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    """Register a query under its own name; the session is prepared for it."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(prepare(spark), folder)

    QUERIES[function.__name__] = run
    return function


@query
def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 5) == 1
    scored = lm_scoring.score(docs, docs.where(~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", fold(F.col("doc_id"), 5) == 0)
    model = language_id.fit(docs.where("NOT held_out"))
    predicted = language_id.predict(docs.select("doc_id", "text", "held_out"), model)
    return predicted.select("doc_id", "held_out", "lang_pred", "score", "bits_per_byte")


@query
def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as flat token files, which are then scanned without an index."""
    docs = table(spark, folder, "documents").select("text")
    path = scratch_dir(spark, "token-files")
    token_files.write(bpe.encode(docs, width=2, special=False), path, bpe.END_OF_TEXT)
    counted = token_files.count(spark, path, bpe.END_OF_TEXT)
    return counted.withColumn("file", F.regexp_extract("file", "[^/]*$", 0))


@query
def op4_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    resolved = revisits.resolve(revisits.captures_of(pages))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return resolved.withColumn("headers", F.array_join(lines, "\n"))


SQL["op4_warc_revisits"] = r"""
WITH b AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(url, '#.*$', ''),
    '^[A-Za-z][A-Za-z0-9+.-]*://', ''),
    '([?&])((utm_[A-Za-z]*|ref)=[^&]*&)*((utm_[A-Za-z]*|ref)=[^&]*)?', '\1', 'g'), '[?&]+$', '') AS bare
  FROM pages
), c AS (
  SELECT *, regexp_replace(lower(regexp_extract(bare, '^[^/?]*')), '^www\.', '')
    || regexp_replace(regexp_replace(bare, '^[^/?]*', ''), '/$', '') AS url_key,
    md5(coalesce(html, '')) AS tag, 'day ' || (page_id % 28) AS day, strlen(coalesce(html, '')) AS size
  FROM b
), v AS (
  SELECT 2 * page_id + 1 AS capture_id, url_key, 10 * page_id + 5 + (page_id * 37 % 1000) * 10 AS ts,
    CASE WHEN page_id % 8 < 4 THEN tag WHEN page_id % 8 = 4 THEN 'W/' || tag WHEN page_id % 8 = 5 THEN 'old' END AS etag,
    CASE WHEN page_id % 8 = 6 THEN day END AS modified
  FROM c
), r AS (
  SELECT 2 * page_id AS capture_id, url_key, 10 * page_id AS ts, tag, day, size FROM c
), j AS (
  SELECT v.*, r.capture_id AS response, r.tag, r.day, r.size,
    CASE WHEN r.capture_id IS NULL THEN 'no response'
      WHEN v.etag IS NULL AND v.modified IS NULL THEN 'no validator'
      WHEN v.etag IS NOT NULL AND regexp_replace(v.etag, '^W/', '') = r.tag THEN 'resolved'
      WHEN v.etag IS NULL AND v.modified = r.day THEN 'resolved' ELSE 'mismatch' END AS state
  FROM v ASOF LEFT JOIN r ON v.url_key = r.url_key AND v.ts >= r.ts
)
SELECT capture_id, url_key, CASE WHEN state = 'resolved' THEN response END AS refers_to, state,
  CASE WHEN state = 'resolved' THEN
    'cache-control: max-age=60' || chr(10) || 'content-length: ' || size || chr(10) || 'content-type: text/html' || chr(10)
    || 'date: ' || ts || chr(10) || 'etag: ' || coalesce(etag, tag) || chr(10) || 'last-modified: ' || day
  ELSE 'cache-control: max-age=60' || chr(10) || 'content-length: 0' || chr(10) || 'date: ' || ts
    || coalesce(chr(10) || 'etag: ' || etag, '') || coalesce(chr(10) || 'last-modified: ' || modified, '') END AS headers
FROM j
"""


@query
def op5_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.duplicates(table(spark, folder, "embeddings"))


@query
def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontamination.contamination(docs, benchmark).drop("h")


SQL["op6_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
), w AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[i + 1 : i + n], ' ') AS gram FROM (
    SELECT item_id, ws, least(13, len(ws)) AS n, unnest(range(0, greatest(len(ws) - 12, 1))) AS i
    FROM b WHERE len(ws) > 0)
), g AS (
  SELECT doc_id, n, i, array_to_string(ws[i + 1 : i + n], ' ') AS gram FROM (
    SELECT doc_id, ws, n, unnest(range(0, greatest(len(ws) - n + 1, 0))) AS i
    FROM d, (SELECT DISTINCT n FROM w))
), o AS (
  SELECT doc_id, item_id, n, i FROM g JOIN w USING (n, gram)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM o) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM o) GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@query
def op7_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.duplicates(table(spark, folder, "documents"))


SQL["op7_ngram_jaccard"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i + 1 : i + 5], ' ') AS gram
  FROM (SELECT doc_id, ws, unnest(range(0, greatest(len(ws) - 4, 1))) AS i FROM d WHERE len(ws) > 0)
), c AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS same FROM s x JOIN s y USING (gram)
  WHERE x.doc_id <> y.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM p JOIN c ca ON ca.doc_id = a JOIN c cb ON cb.doc_id = b
  WHERE 100 * same >= 80 * (ca.n + cb.n - same)
), r(a, b) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM d LEFT JOIN c USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) USING (doc_id)
"""


@query
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").where(fold(F.col("doc_id"), 4) != 2)
    model = quality.fit(quality.labelled_sample(docs, labels, "quality"))
    scored = quality.score(docs, model)
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= quality.GOOD).cast("int").alias("predicted"),
    )


@query
def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def _license_sql() -> str:
    quoted = ", ".join(f"('{name}', '{text.replace(chr(39), chr(39) * 2)}')" for name, text in licenses.TEMPLATES.items())
    return rf"""
WITH t(license_id, text) AS (VALUES {quoted}),
u AS (
  SELECT doc_id, 0 AS unit, text FROM documents
  UNION ALL
  SELECT doc_id, unit, line FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS unit
    FROM documents WHERE contains(text, chr(10)))
), w AS (
  SELECT doc_id, unit, regexp_extract_all({_LOWERED}, '[a-z0-9]+') AS ws FROM u
), b AS (
  SELECT DISTINCT doc_id, unit, ws[i] || ' ' || ws[i + 1] AS gram
  FROM (SELECT doc_id, unit, ws, unnest(range(1, len(ws))) AS i FROM w)
), tb AS (
  SELECT DISTINCT license_id, ws[i] || ' ' || ws[i + 1] AS gram
  FROM (SELECT license_id, ws, unnest(range(1, len(ws))) AS i
    FROM (SELECT license_id, regexp_extract_all({_LOWERED}, '[a-z0-9]+') AS ws FROM t))
), m AS (
  SELECT doc_id, unit, license_id, 2 * count(*) / (any_value(n) + any_value(k)) AS dice
  FROM b JOIN tb USING (gram)
  JOIN (SELECT doc_id, unit, count(*) AS n FROM b GROUP BY ALL) USING (doc_id, unit)
  JOIN (SELECT license_id, count(*) AS k FROM tb GROUP BY ALL) USING (license_id)
  GROUP BY doc_id, unit, license_id
)
SELECT doc_id, license_id, max(dice) AS dice, count(*) AS n_units, min(unit) AS first_line
FROM m WHERE dice >= {licenses.LEAST_DICE} GROUP BY doc_id, license_id
"""


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL["op9_license_scan"] = _license_sql()


@query
def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = bpe.round_trip(docs)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    proved = merkle.manifest(docs, tampered, F.replace("text", F.lit("\n"), F.lit("")))
    return proved.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", "verified"
    )


# crc32 reads the digits of an id one by one (c xor digit, then eight shifts for each); its last bit decides.
_CRC32 = """list_reduce(
    list_prepend(4294967295::BIGINT, flatten([[ord(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR x IN string_split(doc_id::VARCHAR, '')])),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"""


def _merkle_sql() -> str:
    value = lambda x: f"coalesce(strlen({x}::VARCHAR) || ':' || {x}::VARCHAR, '-')"
    head = " || ".join(value(c) for c in ("doc_id", "source", "lang", "n_chars"))
    forged = f"sha256({head} || {value("replace(text, chr(10), '')")})"
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, sha256({head} || {value("text")}) AS leaf,
    CASE WHEN {_CRC32} & 1 = 1 THEN {forged} END AS forged
  FROM documents
), g AS (
  SELECT *, dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n
  FROM d
), a(h, tree, pos, n, digest) AS (
  SELECT 0, tree, pos, n, leaf FROM g
  UNION ALL
  SELECT h + 1, tree, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM a WHERE n > 1 GROUP BY h, tree, pos // 3, n
), s AS (
  SELECT tree, h AS top, digest AS subroot FROM a WHERE n = 1
), b(h, tree, pos, n, digest) AS (
  SELECT 0, -1::BIGINT, tree, (SELECT count(*) FROM s), subroot FROM s
  UNION ALL
  SELECT h + 1, tree, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM b WHERE n > 1 GROUP BY h, tree, pos // 3, n
), node AS (
  SELECT x.h, x.tree, x.pos, coalesce(string_agg(y.digest, '' ORDER BY y.pos) FILTER (y.pos < x.pos), '') AS l,
    coalesce(string_agg(y.digest, '' ORDER BY y.pos) FILTER (y.pos > x.pos), '') AS r
  FROM (FROM a UNION ALL FROM b) x JOIN (FROM a UNION ALL FROM b) y
    ON x.h = y.h AND x.tree = y.tree AND x.pos // 3 = y.pos // 3
  WHERE x.n > 1 GROUP BY x.h, x.tree, x.pos
), p(id, h, tree, pos, proof, folded) AS (
  SELECT g, 0, CASE WHEN n = 1 THEN -1 ELSE tree END, CASE WHEN n = 1 THEN tree ELSE pos END, ''::VARCHAR, coalesce(forged, leaf) FROM g
  UNION ALL
  SELECT id, CASE WHEN p.h + 1 = s.top THEN 0 ELSE p.h + 1 END, CASE WHEN p.h + 1 = s.top THEN -1 ELSE p.tree END,
    CASE WHEN p.h + 1 = s.top THEN p.tree ELSE p.pos // 3 END, proof || l || r, sha256(l || folded || r)
  FROM p JOIN node USING (h, tree, pos) LEFT JOIN s ON s.tree = p.tree
), e AS (
  SELECT id, proof, folded FROM p ANTI JOIN node USING (h, tree, pos)
)
SELECT id.doc_id AS doc_id, id.leaf AS leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = digest AS verified
FROM e JOIN s ON s.tree = e.id.tree CROSS JOIN (SELECT digest FROM b WHERE n = 1)
"""


SQL["op11_merkle_manifest"] = _merkle_sql()


@query
def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


SQL["op12_filter_audit"] = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
  FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM t
), m AS (
  SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id
), d AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, list_filter([
    CASE WHEN len(ws) < 200 THEN 'A' END,
    CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' END,
    CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 3 * length(text) THEN 'C' END,
    CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END,
    CASE WHEN doc_id > first THEN 'E' END], lambda x: x IS NOT NULL) AS fails
  FROM w LEFT JOIN m USING (doc_id)
), c AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM d GROUP BY ALL
), f AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter
), o(filter_order) AS (
  SELECT '' UNION ALL SELECT filter_order || letter FROM o, f WHERE NOT contains(filter_order, letter)
), k AS (
  SELECT filter_order, unnest(range(1, 6)) AS step FROM o WHERE length(filter_order) = 5
), x AS (
  SELECT part, n, good, toxic, filter_order, step, list_contains(fails, filter_order[step]) AS bad, len(fails) AS n_fails,
    list_has_any(fails, string_split(filter_order[1 : step - 1], '')) AS gone
  FROM c, k
), r AS (
  SELECT part, filter_order, CAST(step AS INT) AS step, coalesce(sum(n) FILTER (NOT gone AND NOT bad), 0) AS kept,
    coalesce(sum(n) FILTER (NOT gone AND bad), 0) AS removed, coalesce(sum(n) FILTER (gone AND bad), 0) AS redundant,
    coalesce(sum(n) FILTER (bad AND n_fails = 1), 0) AS unique_fails,
    coalesce(sum(good) FILTER (NOT gone AND bad), 0) AS good_lost, coalesce(sum(toxic) FILTER (NOT gone AND bad), 0) AS toxic_lost
  FROM x GROUP BY ALL
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, filter_order[step]) AS BIGINT) AS shapley
FROM r
"""


@query
def op13_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    kept = line_dedup.dedup(docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL["op13_line_dedup"] = r"""
WITH l AS (
  SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i
  FROM (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), m AS (
  SELECT key, max(doc_id) AS owner FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), x AS (
  SELECT r, doc_id, i, line, coalesce(doc_id <> owner, false) AS gone FROM k LEFT JOIN m USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM x GROUP BY r, doc_id
"""
