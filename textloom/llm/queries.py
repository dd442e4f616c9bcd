"""Registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import (
    bpe, decontam, htmltext, jaccard, merkle, pii, quality, repair, simhash, toxicity, urlfilter, warc, wordpiece,
)
from textloom.llm.words import bounded_batches
from textloom.sources.scratch import materialise

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

RULES = [
    urlfilter.Rule.parse("block", "net/"),
    urlfilter.Rule.parse("allow", "example.net/en/"),
    urlfilter.Rule.parse("block", "example.com/de/"),
    urlfilter.Rule.parse("allow", "org/fr/"),
]


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf}/documents.parquet")


def pages(spark: SparkSession, sf: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf}/pages.parquet")


@query
def op1_bpe_roundtrip(spark, sf):
    """Ids of every document and the text decoded from them, as digests."""
    coder = bpe.Bpe.load(public_tokenizers.path("word_bpe_49k.json"))
    return bpe.roundtrip_digests(documents(spark, sf), coder)


@query
def op3_url_filter(spark, sf):
    """The rule and verdict of every page's URL."""
    return urlfilter.filter_urls(pages(spark, sf), RULES)


@query
def op9_line_quality(spark, sf):
    """Counts and verdict of every document."""
    return quality.judge(documents(spark, sf))


@query
def op10_toxicity(spark, sf):
    """Expected severity of every document, from a model of the labelled ones."""
    docs, labels = documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")
    return toxicity.score(docs, toxicity.fit(docs, labels))


@query
def op2_warc_bundles(spark, sf):
    """Pages written to bundles, and the records read back from them."""
    bundles = materialise(warc.write_bundles(pages(spark, sf)), "warc")
    return warc.read_bundles(bundles, payloads=False).drop("url", "payload")


@query
def op8_wordpiece_counts(spark, sf):
    """Length of every document in greedy word pieces."""
    coder = bpe.Bpe.load(public_tokenizers.path("word_bpe_49k.json"))
    return wordpiece.count_tokens(documents(spark, sf), wordpiece.from_bpe(coder))


@query
def op5_template_decontamination(spark, sf):
    """Benchmark windows found in every document."""
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    windows = materialise(decontam.benchmark_windows(items), "benchmark")
    return decontam.decontaminate(documents(spark, sf), windows)


@query
def op6_personal_data(spark, sf):
    """Spans of personal data in every document."""
    docs = documents(spark, sf)
    return pii.find(docs, pii.fit(docs))


@query
def op7_main_text(spark, sf):
    """The article of every page."""
    return htmltext.extract(pages(spark, sf), htmltext.fit())


@query
def op4_ngram_jaccard(spark, sf):
    """The component and number of links of every document in the exact join of 3-word shingles at 0.9."""
    joined = jaccard.join_components(documents(spark, sf), size=3, num=90, den=100, counted=True, chunk_rows=2048)
    return joined.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        "n_links",
    )


@query
def op11_merkle_manifest(spark, sf):
    """Every document's proof in the manifest of all documents, and the root that a third tampered gives."""
    id, text = F.col("doc_id"), F.col("text")
    tampered = F.crc32(id.cast("string")) % 3 == 0
    lowered = F.when(tampered, F.translate(text, ascii_uppercase, ascii_lowercase)).otherwise(text)
    leaves = merkle.leaf_rows(
        documents(spark, sf), ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id",
        claims={"text": lowered},
    )
    return merkle.audit(merkle.build(leaves)).withColumnRenamed("id", "doc_id")


@query
def op12_conversation_repair(spark, sf):
    """Faults, cheapest edits and repaired turns of every conversation, after damage by a checksum."""
    bounded_batches(spark)
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    found = repair.report(repair.damage(turns), turns.select(F.col("conv_id").alias("conv")))
    return found.withColumnRenamed("conv", "conv_id")


@query
def op13_simhash_near_dedup(spark, sf):
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(documents(spark, sf))
    return found.select(
        F.col("id").alias("doc_id"),
        simhash.hexadecimal().alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


_REST = "substr(url, strpos(url, '://') + 3)"
ORACLES["op3_url_filter"] = f"""WITH parts AS (
  SELECT page_id,
         CASE WHEN strpos(url, '://') > 0 THEN lower(regexp_extract({_REST}, '^[^/?#]*')) ELSE '' END AS host,
         CASE WHEN strpos(url, '://') > 0 THEN regexp_extract({_REST}, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
rules AS (SELECT * FROM (VALUES
  ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/'))
  AS r(verdict, rhost, rpath)),
fits AS (
  SELECT p.page_id, r.rhost || r.rpath AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rhost || r.rpath) DESC) AS k
  FROM parts p JOIN rules r
    ON (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON f.page_id = p.page_id AND f.k = 1"""

ORACLES["op2_warc_bundles"] = """WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS payload_digest,
         octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM firsts"""

_WHITE = r"[\x20\x09-\x0D]"
_LINE = rf"regexp_replace(line, '^{_WHITE}+|{_WHITE}+$', '', 'g')"
ORACLES["op9_line_quality"] = rf"""WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM texts)),
windows AS (
  SELECT doc_id, i, [w, lead(w, 1) OVER k, lead(w, 2) OVER k, lead(w, 3) OVER k, lead(w, 4) OVER k] AS win,
         lead(i, 4) OVER k AS last
  FROM words WINDOW k AS (PARTITION BY doc_id ORDER BY i)),
twice AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows WHERE last IS NOT NULL)
  WHERE n > 1),
covered AS (
  SELECT doc_id, sum(least(5, coalesce(next - i, 5)))::BIGINT AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM twice) GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n_words, sum(length(w))::BIGINT AS word_chars FROM words GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts),
bare AS (SELECT doc_id, line, {_LINE} AS b FROM lines),
judged AS (
  SELECT doc_id, line, b, length(regexp_replace(b, '{_WHITE}', '', 'g')) AS chars,
         (seps >= {quality.MIN_SEPARATORS} AND ws <= {quality.MAX_ITEM_WORDS} * (seps + 1))
         OR regexp_matches(b, '{quality.LINK}')
         OR {quality.MAX_PHRASE_WORDS} * len(regexp_extract_all(b, '{quality.BOILERPLATE}')) >= ws
         OR (ws <= {quality.SHORT_LINE_WORDS} AND NOT regexp_matches(b, '{quality.CLOSED.replace("'", "''")}'))
         OR 100 * (length(b) - length(regexp_replace(b, '[#*$%&|<>]', '', 'g')))
            > {quality.MAX_SYMBOL_PERCENT} * length(b) AS failing
  FROM (SELECT *, len(regexp_extract_all(b, '[^\x20\x09-\x0D]+')) AS ws,
               len(regexp_extract_all(b, '{quality.SEPARATOR}')) AS seps FROM bare WHERE b <> '')),
kept_lines AS (
  SELECT doc_id, sum(CASE WHEN failing THEN chars ELSE 0 END)::BIGINT AS lost,
         (count(*) - count(DISTINCT line))::BIGINT AS n_dup_lines
  FROM judged GROUP BY doc_id),
measured AS (
  SELECT t.doc_id, coalesce(c.n_words, 0)::BIGINT AS n_words, coalesce(c.word_chars, 0)::BIGINT AS word_chars,
         (length(t.text) - length(regexp_replace(t.text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(k.n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(r.n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(k.lost, 0) AS lost
  FROM texts t LEFT JOIN counts c USING (doc_id) LEFT JOIN covered r USING (doc_id)
  LEFT JOIN kept_lines k USING (doc_id)),
based AS (
  SELECT *, n_words < {quality.MIN_WORDS}
            OR 100 * n_repeat_words > {quality.MAX_REPEATED_PERCENT} * n_words AS base_failed
  FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * lost <= {quality.MAX_LOST_PERCENT} * word_chars AS kept
FROM based"""


_CRC32 = """xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                           lambda x, z: xor(x >> 1, (x & 1) * 3988292384))))"""
_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def _leaf(text: str) -> str:
    values = [text if c == "text" else f"{c}::VARCHAR" for c in _COLUMNS]
    parts = [f"coalesce(octet_length(encode({v}))::VARCHAR || ':' || {v}, '-')" for v in values]
    return f"sha256({' || '.join(parts)})"


_LOWERED = f"CASE WHEN {_CRC32} % 3 = 0 THEN translate(text, '{ascii_uppercase}', '{ascii_lowercase}') ELSE text END"


def _grown(name: str, start: str) -> str:
    return f"""{name} AS (
  {start}
  UNION ALL
  SELECT tree, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos))
  FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 8, n)"""


def _folded(name: str, nodes: str, start: str) -> str:
    """Siblings and the digest of a changed leaf, level by level."""
    return f"""{name} AS (
  {start}
  UNION ALL
  SELECT f.doc_id, f.tree, f.level + 1, f.pos // 8, (f.n + 7) // 8,
         f.proof || coalesce(string_agg(CASE WHEN v.pos <> f.pos THEN v.digest END, '' ORDER BY v.pos), ''),
         sha256(string_agg(CASE WHEN v.pos = f.pos THEN f.digest ELSE v.digest END, '' ORDER BY v.pos))
  FROM {name} f JOIN {nodes} v ON v.tree IS NOT DISTINCT FROM f.tree AND v.level = f.level AND v.pos // 8 = f.pos // 8
  WHERE f.n > 1 GROUP BY f.doc_id, f.tree, f.level, f.pos, f.n, f.proof, f.digest)"""


ORACLES["op11_merkle_manifest"] = f"""WITH RECURSIVE leaves AS (
  SELECT doc_id, lang AS tree, {_leaf("text")} AS leaf, {_leaf(f"({_LOWERED})")} AS claimed FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS n FROM leaves),
{_grown("nodes", "SELECT tree, 0 AS level, pos, n, leaf AS digest FROM placed")},
subroots AS (
  SELECT tree AS lang, digest AS subroot, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos,
         count(*) OVER () AS n FROM nodes WHERE n = 1),
{_grown("crown", "SELECT 0 AS tree, 0 AS level, pos, n, subroot AS digest FROM subroots")},
{_folded("inside", "nodes", "SELECT doc_id, tree, 0 AS level, pos, n, '' AS proof, claimed AS digest FROM placed")},
{_folded("above", "crown", """SELECT i.doc_id, 0 AS tree, 0 AS level, s.pos, s.n, i.proof, i.digest
  FROM inside i JOIN subroots s ON s.lang IS NOT DISTINCT FROM i.tree WHERE i.n = 1""")}
SELECT p.doc_id, p.leaf, s.subroot, c.digest AS root, sha256(a.proof) AS proof_sha256,
       a.digest AS folded_root, a.digest = c.digest AS verified
FROM placed p JOIN above a ON a.doc_id = p.doc_id AND a.n = 1 JOIN crown c ON c.n = 1
JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.tree"""

# All pairs that share a shingle; components as all that links reach.
ORACLES["op4_ngram_jaccard"] = r"""WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS ws FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) END) AS shingle
  FROM texts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y FROM shared JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
  WHERE 100 * common >= 90 * (s.n + t.n - common)),
reached AS (
  SELECT doc_id AS x, doc_id AS y FROM texts
  UNION
  SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y)
SELECT t.doc_id, coalesce(s.n, 0) AS n_shingles, min(r.y) AS component_id,
       (SELECT count(*) FROM links l WHERE l.x = t.doc_id) AS n_links
FROM texts t LEFT JOIN sizes s ON s.doc_id = t.doc_id JOIN reached r ON r.x = t.doc_id
GROUP BY t.doc_id, s.n"""
