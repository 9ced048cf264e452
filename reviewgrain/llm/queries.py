"""One query per operator over the given tables, the SQL some agree with, and their registry."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewgrain.llm import byte_bpe, decontaminate, hard_negatives, html_text, language_id, licenses, line_dedup, multiset_hash, packing, quality, simhash, url_filter, whitening
from reviewgrain.llm.shared import importable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

VOCABULARY = "byte_bpe_50k.tiktoken"


#: The rules that every page is judged by: verdict, host, path.
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def query(name: str, sql: str | None = None):
    def add(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op8_byte_level_bpe")
def byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids and their decoded bytes, as digests."""
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    both = byte_bpe.round_trip(table(spark, sf_dir, "documents"), path, pattern)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op10_simhash_near_duplicates")
def simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the smallest document it is linked to."""
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal("fingerprint").alias("fingerprint"), "component_id")


@query("op6_language_id")
def language_identification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, from profiles of the documents that are not held out."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language_id.held_out("doc_id"))
    profiles = language_id.learn(docs.where("NOT held_out"))
    return language_id.predict(docs, profiles, keep=["doc_id", "held_out"])


@query("op9_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's rule statistics and whether it is kept."""
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality.STATISTICS, "base_failed", "kept", "anomaly")


URL_SQL = r"""
WITH split AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '(?s)^[^/?#]*(/[^?#]*)?', 1) AS path
  FROM split
), rules(verdict, rhost, rpath) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fits AS (
  SELECT page_id, host, path, rhost || rpath AS rule, verdict FROM parts JOIN rules
    ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
), best AS (
  SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM fits GROUP BY page_id, host, path
)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN best b ON p.page_id = b.page_id AND p.host = b.host AND p.path = b.path
"""


@query("op7_url_filter", URL_SQL)
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, deciding rule and verdict."""
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.rule_table(spark, URL_RULES))


@query("op2_benchmark_decontamination")
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that it contains, also with other values."""
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.col("n_tokens").cast("long").alias("n_tokens"), "coverage", "n_alignments")


@query("op3_line_dedup")
def line_deduplication(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without later copies of repeated runs of lines."""
    out = line_dedup.without_later_copies(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_deleted_lines", "text")


@query("op1_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.fit(pages)).select("page_id", "url", "text", "n_chars", "n_blocks", "n_kept")


def _licence_form(column: str) -> str:
    """The canonical form in DuckDB's SQL."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    out = f"lower({column})"
    for pattern in (licenses.COPYRIGHT_LINE, licenses.RIGHTS_LINE):
        out = f"regexp_replace({out}, {quoted(pattern)}, '', 'g')"
    for pattern, spelling in licenses.EQUIVALENT:
        out = f"regexp_replace({out}, {quoted(pattern)}, {quoted(spelling.replace('$1', chr(92) + '1'))}, 'g')"
    return f"trim(regexp_replace({out}, {quoted(licenses.OTHER)}, ' ', 'g'))"


def _licence_sql() -> str:
    known = ", ".join("('" + name + "', '" + text.replace("'", "''") + "')" for name, text in licenses.KNOWN)
    return f"""
WITH known AS (
  SELECT {_licence_form("text")} AS form, min(licence) AS licence FROM (VALUES {known}) AS k(licence, text) GROUP BY 1
), blocks AS (
  SELECT doc_id, text, string_split_regex(text, '\\n[ \\t\\r]*\\n') AS b FROM documents WHERE text IS NOT NULL
), each_block AS (
  SELECT doc_id, unnest(b) AS block, generate_subscripts(b, 1) - 1 AS place, len(b) AS n FROM blocks
), block_lines AS (
  SELECT doc_id, place, string_split(block, chr(10)) AS l FROM each_block
), offsets AS (
  SELECT doc_id, l, place, sum(len(l)) OVER (PARTITION BY doc_id ORDER BY place) - len(l) AS before FROM block_lines
), each_line AS (
  SELECT doc_id, unnest(l) AS line, before + generate_subscripts(l, 1) - 1 AS place, len(l) AS n FROM offsets
), units AS (
  SELECT doc_id, 'document' AS unit, 0 AS place, text AS piece FROM blocks
  UNION ALL SELECT doc_id, 'block', place, block FROM each_block WHERE n > 1
  UNION ALL SELECT doc_id, 'line', place, line FROM each_line WHERE n > 1
), forms AS (
  SELECT doc_id, unit, place, {_licence_form("piece")} AS form FROM units WHERE regexp_matches(piece, '(?i)[a-z]')
)
SELECT doc_id, unit, CAST(place AS BIGINT) AS place, licence FROM forms JOIN known USING (form) WHERE form <> ''
"""


@query("op4_license_scan", _licence_sql())
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, block or line that is a known licence text."""
    return licenses.find(table(spark, sf_dir, "documents"), licenses.catalogue(spark))


@query("op5_packed_token_ids")
def packed_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every packed row: its segments, and digests of its ids and positions."""
    rows = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    digests = {"ids_sha256": F.sha2("ids", 256), "positions_sha256": F.sha2("positions", 256)}
    return rows.withColumns(digests).drop("ids", "positions")


@query("op11_document_fingerprints")
def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, and that of its text with the second half taken from the next document."""
    return multiset_hash.edited(table(spark, sf_dir, "documents"))


@query("op12_embedding_whitening")
def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's whitened coordinates on the eight leading components; deviation is NULL where it doesn't fit a long."""
    rows, _ = whitening.whitened(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


@query("op13_hard_negatives")
def hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every positive of the vectors whose id is divisible by 100; ids divisible by 7 have the next label."""
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)
    return found.withColumns({c: F.col(c).cast("long") for c in ("anchor_id", "positive_id", "negative_id")})
