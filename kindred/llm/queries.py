"""The queries opN_<name>: each applies an operator to its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, html, lm, packing, quality, secrets, simhash, substrings, toxicity, urls
from .common import scratch, table


def tokenizer_file(name: str) -> str:
    """Where the box keeps its public tokenizers; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes: the labels with the page's id, good if of quality and not toxic."""
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), good.alias("good"))
    return urls.url_filter(table(spark, sf_dir, "pages"), outcomes)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By a ledger that begins with this run, so that what it returns rests on no earlier one."""
    docs = table(spark, sf_dir, "documents")
    found = secrets.findings(docs, secrets.update_ledger(docs, scratch(spark, "ledger")))
    base = F.filter("found", lambda s: s["place"] < len(secrets.BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, secrets.BASE), F.sha2(secrets.listing(base), 256).alias("base_sha256"), secrets.listing(F.col("found")).alias("spans"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).withColumn("sentences", F.to_json("sentences"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scores(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenized(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "part_bins", "part_bound")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (op1_url_filter, op2_secret_scan, op3_toxicity, op4_substring_dedup, op5_html_extraction, op6_lm_scoring, op7_decontamination, op8_simhash, op9_packing, op10_quality_rules)
}


def _secrets_sql() -> str:
    """op2 in DuckDB: matches and the gaps between them give the spans."""
    parts = []
    for place, r in enumerate(secrets.RULES):
        p = r.pattern.replace("'", "''")
        parts.append(
            f"SELECT doc_id, text, {place} AS place, '{r.kind}' AS kind, {r.least} AS least, regexp_extract_all(text, '{p}', 0) AS m, "
            f"regexp_extract_all(text, '{p}', {r.group}) AS g, string_split_regex(text, '{p}') AS gaps FROM d WHERE regexp_matches(text, '{p}')"
        )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
hits AS ({" UNION ALL ".join(parts)}),
each AS (
  SELECT doc_id, place, kind, least, g[i] AS grp, length(m[i]) AS size,
    list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS a
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM hits)),
spans AS (SELECT doc_id, place, kind, CAST(a AS BIGINT) AS a, CAST(a + size AS BIGINT) AS b FROM each WHERE length(grp) >= least),
listed AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    coalesce(string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, place) FILTER (place < 3), '') AS base,
    string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, place) AS spans
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN listed USING (doc_id)"""


def _words_sql(table_: str, id_: str, pattern: str, text: str = "coalesce(text, '')") -> str:
    """A row of its own for each row of a table: rid, id, w (the words, from 1 on)."""
    return f"SELECT row_number() OVER () AS rid, {id_} AS id, regexp_extract_all({text}, '{pattern}') AS w FROM {table_}"


def _substrings_sql() -> str:
    """op4 in DuckDB: every window as text, the first start of each."""
    n = substrings.WINDOW
    return f"""
WITH d AS ({_words_sql("documents", f"coalesce(doc_id, {substrings.LAST})", WHITE_WORDS)}),
wins AS (SELECT rid, id, i, array_to_string(w[i:i + {n - 1}], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - {n - 2})) AS i FROM d WHERE len(w) >= {n})),
firsts AS (SELECT g, min((id, i)) AS f FROM wins GROUP BY g),
gone AS (SELECT DISTINCT rid, i + k AS pos FROM (SELECT rid, i, unnest(range({n})) AS k FROM wins JOIN firsts USING (g) WHERE (id, i) > f)),
words AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
kept AS (SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS t FROM words ANTI JOIN gone USING (rid, pos) GROUP BY rid)
SELECT nullif(id, {substrings.LAST}) AS doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)"""


def _decontamination_sql() -> str:
    """op7 in DuckDB: every window of the sizes that items have, as text."""
    n = decontaminate.WINDOW
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH d AS ({_words_sql("documents", "doc_id", ALNUM_WORDS, lower)}),
b AS (SELECT *, least(len(w), {n}) AS n FROM ({_words_sql("benchmark", "CAST(item_id AS VARCHAR)", ALNUM_WORDS, lower)}) WHERE len(w) > 0),
tests AS (SELECT DISTINCT id AS item, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
sizes AS (SELECT DISTINCT n FROM tests),
wins AS (SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM d JOIN sizes ON len(w) >= n)),
hits AS (SELECT rid, i, n, item FROM wins JOIN tests USING (n, g)),
words AS (SELECT rid, count(DISTINCT i + k) AS n_hit FROM (SELECT rid, i, unnest(range(n)) AS k FROM hits) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, item FROM hits WHERE item IS NOT NULL) GROUP BY rid)
SELECT id AS doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)"""


#: The contract's words.
WHITE_WORDS = "[^\\x20\\x09-\\x0D]+"
ALNUM_WORDS = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

ORACLES = {"op2_secret_scan": _secrets_sql(), "op4_substring_dedup": _substrings_sql(), "op7_decontamination": _decontamination_sql()}
