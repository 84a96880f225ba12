"""Named queries over the entity fixture, and independent SQL for each that SQL can express."""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import similarity as sim
from .functions import text
from .functions.constants import ADDR_STOP, DOMAIN, FAMILIES, HANDLE, LEGAL_FORMS, NAME_STOP, STREET
from .operators import blocking, decisions, early, features, matching, validation
from .plans import resolution, universe
from .sources import entities as src
from .sources.scratch import new_path, written

STEPS = [0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
COUNTRY_STEPS = {"India": [0.52, 0.54, 0.56, 0.575], "US": [0.625, 0.65, 0.675, 0.7], "France": [0.6, 0.625, 0.65]}
CONFIGS = [(a, b) for a in STEPS[1:5] for b in STEPS[1:5]]


def _ents(spark: SparkSession, d: str) -> DataFrame:
    return src.fixture(spark, d)


def _parts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Entities, true links, S1 and scored top candidates."""
    e = _ents(spark, d)
    return e, src.fixture_links(e), e.where("entity_id LIKE 'S1-%'"), features.exact(resolution.candidates(e))


def _silver(spark: SparkSession, d: str) -> DataFrame:
    return text.silver(_ents(spark, d))


def _keys(spark: SparkSession, d: str) -> DataFrame:
    return blocking.keys(written(_silver(spark, d), "silver"))


def _sides(spark: SparkSession, d: str) -> DataFrame:
    return resolution.candidates(_ents(spark, d))


def _links(q: DataFrame) -> DataFrame:
    return decisions.exclusive(decisions.above(q, 0.5, 0.6))


QUERIES = {}
ORACLES = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _quoted(words: list[str]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def _case(value, default: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(s1, '{p}') THEN {value(p, c)}" for p, c in LEGAL_FORMS) + f" ELSE {default} END"


_SILVER = f"""{src.FIXTURE},
n0 AS (SELECT *, regexp_replace(regexp_replace(strip_accents(lower(trim(business_name))), '{HANDLE}', ' ', 'gi'), '{DOMAIN}', ' ', 'gi') AS s1,
  trim(regexp_replace(regexp_replace(strip_accents(lower(trim(coalesce(business_address, '')))), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS a0 FROM ents),
n1 AS (SELECT entity_id, left(entity_id, 2) AS src, country, truth_s1, business_address IS NOT NULL AS has_addr,
  regexp_matches(business_name || ' ' || coalesce(business_address, ''), '[\\x{{0900}}-\\x{{097F}}]') AS translit,
  {_case(lambda p, c: f"'{c}'", "''")} AS legal,
  trim(regexp_replace(regexp_replace(translate({_case(lambda p, c: f"regexp_replace(s1, '{p}', ' ', 'g')", "s1")}, 'कमल', 'kml'), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS brand,
  list_aggregate(list_transform(string_split(a0, ' '), lambda w: coalesce(MAP {{{", ".join(f"'{k}': '{v}'" for k, v in STREET.items())}}}[w], w)), 'string_agg', ' ') AS addr FROM n0),
n2 AS (SELECT *, regexp_extract_all(addr, '\\b\\d+\\b') AS nn FROM n1),
n3 AS (SELECT *, coalesce(list_filter(nn, lambda x: length(x) IN (5, 6))[1], '') AS zip FROM n2),
silver AS (SELECT * EXCLUDE (nn), list_sort(list_distinct(list_filter(nn, lambda x: x <> zip AND length(x) <= 5))) AS nums,
  list_filter(string_split(addr, ' '), lambda x: length(x) >= 3 AND NOT regexp_full_match(x, '\\d+')) AS words FROM n3)"""

_KEYS = f"""{_SILVER},
k0 AS (SELECT *, list_filter(string_split(brand, ' '), lambda x: length(x) >= 3 AND x NOT IN {_quoted(NAME_STOP)}) AS t,
  list_filter(string_split(brand, ' '), lambda x: length(x) = 2 AND x NOT IN {_quoted(NAME_STOP)}) AS h, list_filter(words, lambda x: x NOT IN {_quoted(ADDR_STOP)}) AS w FROM silver),
k1 AS (SELECT *, t[1][1:1] || regexp_replace(t[1][2:], '[aeiouy]', '', 'g') AS raw FROM k0),
k2 AS (SELECT *, list_aggregate(list_transform(range(1, length(raw) + 1), lambda i: CASE WHEN i > 1 AND raw[i] = raw[i - 1] THEN '' ELSE raw[i] END), 'string_agg', '')[1:6] AS sk FROM k1),
keys AS (
  SELECT entity_id, src, country, 'tok' AS family, unnest(t) AS key FROM k2
  UNION ALL SELECT entity_id, src, country, 'bi', unnest(list_transform(range(1, len(t)), lambda i: t[i] || '_' || t[i + 1])) FROM k2
  UNION ALL SELECT entity_id, src, country, 'pref4', t[1][1:4] FROM k2 WHERE length(t[1]) >= 4
  UNION ALL SELECT entity_id, src, country, 'addr_tok', unnest(list_filter(w[1:4], lambda x: length(x) >= 4)) FROM k2
  UNION ALL SELECT entity_id, src, country, 'addr_pair', least(w[i], w[j]) || '|' || greatest(w[i], w[j]) FROM k2, range(1, 5) a(i), range(1, 5) b(j) WHERE i < j AND j <= len(w)
  UNION ALL SELECT entity_id, src, country, 'zip_num', unnest(list_transform(nums[1:3], lambda x: zip || '|' || x)) FROM k2 WHERE zip <> ''
  UNION ALL SELECT entity_id, src, country, 'sn_w', nums[i] || '|' || w[j] FROM k2, range(1, 3) a(i), range(1, 5) b(j) WHERE i <= len(nums) AND j <= len(w)
  UNION ALL SELECT entity_id, src, country, 'zip_w', unnest(list_transform(w[1:3], lambda x: zip || '|' || x)) FROM k2 WHERE zip <> ''
  UNION ALL SELECT entity_id, src, country, 'st_zip', h[1] || '|' || zip FROM k2 WHERE zip <> '' AND len(h) > 0
  UNION ALL SELECT entity_id, src, country, 'st_sn', unnest(list_transform(nums[1:2], lambda x: h[1] || '|' || x)) FROM k2 WHERE len(h) > 0
  UNION ALL SELECT entity_id, src, country, 'bn_sn', unnest(list_transform(nums[1:2], lambda x: t[1] || '|' || x)) FROM k2 WHERE len(t) > 0
  UNION ALL SELECT entity_id, src, country, 'bn_zip', t[1] || '|' || zip FROM k2 WHERE zip <> '' AND len(t) > 0
  UNION ALL SELECT entity_id, src, country, 'skel', sk FROM k2 WHERE length(t[1]) >= 4 AND length(raw) >= 3 AND length(sk) >= 3)"""

_PAIRS = f"""{_KEYS},
rare AS (SELECT country, family, key FROM keys WHERE src <> 'S1' GROUP BY ALL HAVING count(*) <= 50),
pairs AS (SELECT DISTINCT a.entity_id AS sid, b.entity_id AS cid, family FROM keys a JOIN keys b USING (country, family, key) JOIN rare USING (country, family, key) WHERE a.src = 'S1' AND b.src <> 'S1'),
links AS (SELECT truth_s1 AS s1id, entity_id AS cid FROM ents WHERE truth_s1 IS NOT NULL),
s1 AS (SELECT * FROM silver WHERE src = 'S1')"""

_RANKED = f"""{_PAIRS},
j0 AS (SELECT sid, cid, s.country, c.src AS c_src, s.brand AS sb, c.brand AS cb, string_split(s.brand, ' ') AS st, string_split(c.brand, ' ') AS ct, s.words AS sw, c.words AS cw, s.nums AS sn, c.nums AS cn,
  s.zip AS sz, c.zip AS cz, s.legal AS sl, c.legal AS cl, s.has_addr AS sh, c.has_addr AS ch, s.addr AS sa, c.addr AS ca, s.translit OR c.translit AS translit FROM (SELECT DISTINCT sid, cid FROM pairs) JOIN silver s ON sid = s.entity_id JOIN silver c ON cid = c.entity_id),
j1 AS (SELECT *, len(list_distinct(list_intersect(st, ct))) AS ib, len(list_distinct(list_concat(st, ct))) AS ub, len(list_distinct(list_intersect(sw, cw))) AS iw, len(list_distinct(list_concat(sw, cw))) AS uw, CAST(list_has_any(sn, cn) AS INT) AS nm FROM j0),
j2 AS (SELECT *, 10 * ib + 5 * iw + CASE WHEN sz <> '' AND sz = cz THEN 20 ELSE 0 END + 10 * nm AS rank_score, round(0.6 * (ib / greatest(ub, 1)) + 0.2 * (iw / greatest(uw, 1)) + 0.2 * nm, 6) AS p,
  CAST(len(sn) > 0 AND len(cn) > 0 AND nm = 0 AS INT) AS num_conflict FROM j1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY rank_score DESC, cid) AS rank FROM j2 QUALIFY rank <= 12)"""

_F05 = "CASE WHEN npred = 0 AND ntrue = 0 THEN 1.0 WHEN npred = 0 OR ntrue = 0 THEN 0.0 ELSE 1.25 * tp / (0.25 * ntrue + npred) END"


def _scored(name: str, rows: str) -> str:
    """CTEs that count rows (sid, cid) against the links, for every S1."""
    return f"""{name} AS (SELECT entity_id AS sid, country, coalesce(npred, 0) AS npred, coalesce(tp, 0) AS tp, coalesce(ntrue, 0) AS ntrue FROM s1
  LEFT JOIN (SELECT sid, count(*) AS npred, count(l.cid) AS tp FROM {rows} x LEFT JOIN links l ON l.s1id = x.sid AND l.cid = x.cid GROUP BY sid) ON sid = entity_id
  LEFT JOIN (SELECT s1id, count(*) AS ntrue FROM links GROUP BY s1id) ON s1id = entity_id)"""


_WON = f"""{_RANKED},
kept AS (SELECT * FROM ranked WHERE p >= CASE WHEN cid LIKE 'S3-%' THEN 0.6 ELSE 0.5 END),
won AS (SELECT * FROM kept QUALIFY row_number() OVER (PARTITION BY cid ORDER BY p DESC, sid) = 1),
{_scored("counts", "won")}"""


def _with(cte: str, select: str) -> str:
    return f"WITH {cte}{'' if select.startswith(',') else chr(10)}{select}"


@query(_with(src.FIXTURE, "SELECT country, count(*) AS n FROM ents GROUP BY country"))
def country_counts(spark, d):
    return src.country_counts(_ents(spark, d))


@query(_with(src.FIXTURE, "SELECT truth_s1 AS source1_entity_id, string_agg(entity_id, ',' ORDER BY entity_id) AS matched_entity_ids FROM ents WHERE truth_s1 IS NOT NULL GROUP BY truth_s1"))
def gt_lists(spark, d):
    e = src.fixture_links(_ents(spark, d))
    return e.groupBy(F.col("s1id").alias("source1_entity_id")).agg(F.array_join(F.array_sort(F.collect_list("cid")), ",").alias("matched_entity_ids"))


@query(_with(src.FIXTURE, "SELECT truth_s1 AS s1id, entity_id AS cid FROM ents WHERE truth_s1 IS NOT NULL"))
def gt_links(spark, d):
    return src.links(gt_lists(spark, d))


@query(_with(src.FIXTURE, "SELECT count(*) AS links, count(DISTINCT entity_id) AS distinct_cids, count(*) - count(DISTINCT entity_id) AS duplicates FROM ents WHERE truth_s1 IS NOT NULL"))
def inv_exclusivity(spark, d):
    return src.fixture_links(_ents(spark, d)).agg(F.count("*").alias("links"), F.countDistinct("cid").alias("distinct_cids"), (F.count("*") - F.countDistinct("cid")).alias("duplicates"))


@query(_with(src.FIXTURE, "SELECT avg(CAST(a.country = b.country AS INT)) AS same_country FROM ents a JOIN ents b ON a.truth_s1 = b.entity_id"))
def inv_same_country(spark, d):
    e = _ents(spark, d)
    a, b = e.select(F.col("truth_s1").alias("s"), F.col("country").alias("a")), e.select("entity_id", F.col("country").alias("b"))
    return a.join(b, F.col("s") == F.col("entity_id")).agg(F.avg((F.col("a") == F.col("b")).cast("int")).alias("same_country"))


@query(_with(src.FIXTURE, "SELECT src, n, count(*) AS s1_count FROM (SELECT DISTINCT truth_s1, left(entity_id, 2) AS src, count(*) OVER (PARTITION BY truth_s1, left(entity_id, 2)) AS n FROM ents WHERE truth_s1 IS NOT NULL) GROUP BY src, n"))
def inv_source_cardinality(spark, d):
    w = Window.partitionBy("s1id", "src")
    one = src.fixture_links(_ents(spark, d)).withColumn("src", F.substring("cid", 1, 2)).withColumn("n", F.count("*").over(w)).select("s1id", "src", "n").distinct()
    return one.groupBy("src", "n").agg(F.count("*").alias("s1_count"))


@query(_with(src.FIXTURE, "SELECT round((SELECT count(*) FROM ents WHERE entity_id NOT LIKE 'S1-%' AND truth_s1 IS NULL) / (SELECT count(*) FROM ents WHERE entity_id NOT LIKE 'S1-%'), 6) AS distractor_rate"))
def inv_distractor_rate(spark, d):
    return _ents(spark, d).where("entity_id NOT LIKE 'S1-%'").agg(F.round(F.count_if(F.col("truth_s1").isNull()) / F.count("*"), 6).alias("distractor_rate"))


@query(_with(src.FIXTURE, "SELECT country, count(*) AS n, CAST(count_if(regexp_matches(business_name || ' ' || coalesce(business_address, ''), '[\\x{0900}-\\x{097F}]')) AS BIGINT) AS devanagari, CAST(count_if(regexp_matches(business_name || ' ' || coalesce(business_address, ''), '[^\\x00-\\x7F]')) AS BIGINT) AS non_ascii, round(100.0 * count_if(business_address IS NULL) / count(*), 4) AS no_address_pct FROM ents GROUP BY country"))
def script_counts(spark, d):
    t = F.concat_ws(" ", "business_name", "business_address")
    return _ents(spark, d).groupBy("country").agg(F.count("*").alias("n"), F.count_if(t.rlike("[\\x{0900}-\\x{097F}]")).alias("devanagari"), F.count_if(t.rlike("[^\\x00-\\x7F]")).alias("non_ascii"), F.round(100.0 * F.count_if(F.col("business_address").isNull()) / F.count("*"), 4).alias("no_address_pct"))


def _bucket_sql(x: str) -> str:
    """CRC-32 of an ASCII text, bit by bit, modulo 1000."""
    letters = f"list_transform(string_split({x}, ''), lambda c: CAST(unicode(c) AS BIGINT))"
    bits = "list_reduce(list_concat([xor(c, y)], range(8)), lambda r, i: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END)"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {letters}), lambda c, y: {bits}), 4294967295) % 1000"


@query(_with(src.FIXTURE, f""", b AS (SELECT *, {_bucket_sql("entity_id")} < 250 AS inside FROM ents), own AS (SELECT entity_id FROM b WHERE inside AND entity_id LIKE 'S1-%')
SELECT entity_id, business_name, business_address, country, truth_s1 FROM b WHERE inside OR truth_s1 IN (SELECT entity_id FROM own)"""))
def train_sample(spark, d):
    e = _ents(spark, d)
    return src.train_sample(e, src.fixture_links(e), 250)


@query(_with(_SILVER, "SELECT entity_id, brand, legal FROM silver"))
def silver_names(spark, d):
    return _silver(spark, d).select("entity_id", "brand", "legal")


@query(_with(_SILVER, "SELECT entity_id, addr, has_addr, zip, array_to_string(nums, ',') AS nums, array_to_string(words, ',') AS words FROM silver"))
def silver_addresses(spark, d):
    return _silver(spark, d).select("entity_id", "addr", "has_addr", "zip", F.array_join("nums", ",").alias("nums"), F.array_join("words", ",").alias("words"))


def _family(family: str):
    def run(spark, d):
        return _keys(spark, d).where(F.col("family") == family).select("entity_id", "key")

    run.__name__ = f"key_{family}"
    return query(_with(_KEYS, f"SELECT entity_id, key FROM keys WHERE family = '{family}'"))(run)


for _name in FAMILIES:
    _family(_name)


@query(_with(_PAIRS, "SELECT DISTINCT sid, cid FROM pairs"))
def blocked_pairs(spark, d):
    return blocking.blocked_pairs(_keys(spark, d)).select("sid", "cid").distinct()


@query(_with(_KEYS, "SELECT country, family, key, entity_id FROM keys WHERE src <> 'S1' AND family = 'tok' QUALIFY row_number() OVER (PARTITION BY country, family, key ORDER BY entity_id) <= 60"))
def truncated_postings(spark, d):
    return blocking.truncated_postings(_keys(spark, d).where("family = 'tok'")).select("country", "family", "key", "entity_id")


@query(_with(_KEYS, r""", t AS (SELECT entity_id, src, country, regexp_replace(brand, '\s+', '_', 'g') AS t FROM silver),
grams AS (SELECT DISTINCT country, 'char34' AS family, substr(t, CAST(i AS INT), n) AS key, entity_id, src FROM (SELECT *, unnest(range(1, length(t) + 1)) AS i FROM t), (SELECT unnest([3, 4]) AS n) WHERE i + n - 1 <= length(t)),
every AS (SELECT country, family, key, entity_id FROM keys WHERE src <> 'S1' UNION ALL SELECT country, family, key, entity_id FROM grams WHERE src <> 'S1' AND NOT starts_with(key, '__') AND NOT ends_with(key, '__'))
SELECT country, family, key, entity_id FROM every WHERE family IN ('tok', 'pref4', 'char34', 'addr_tok', 'zip_num') QUALIFY row_number() OVER (PARTITION BY country, family, key ORDER BY entity_id) <= 60"""))
def truncated_postings_families(spark, d):
    s = written(_silver(spark, d), "silver")
    every = blocking.keys(s).where(F.col("family").isin("tok", "pref4", "addr_tok", "zip_num")).unionByName(blocking.gram_keys(s))
    return blocking.truncated_postings(every).select("country", "family", "key", "entity_id")


@query(_with(_RANKED, "SELECT sid, cid, CAST(rank_score AS INT) AS rank_score, CAST(rank AS INT) AS rank, p FROM ranked"))
def ranked_candidates(spark, d):
    return _sides(spark, d).select("sid", "cid", F.col("rank_score").cast("int").alias("rank_score"), "rank", "p")


@query()
def ranked_candidates_similar(spark, d):
    q = resolution.candidates(_ents(spark, d), similar=True)
    return q.select("sid", "cid", F.round("rank_score", 6).alias("rank_score"), "rank", F.round("n_tset", 6).alias("n_tset"), F.round("a_tset", 6).alias("a_tset"))


@query(_with(_RANKED, """SELECT round(sum(h) / sum(n), 6) AS pair_recall, round(avg(CAST(h = n AS INT)), 6) AS entity_recall, any_value(m.mean_cands) AS mean_cands, any_value(m.median_cands) AS median_cands, any_value(m.p95_cands) AS p95_cands
FROM (SELECT s1id, count(*) AS n, count(r.cid) AS h FROM links LEFT JOIN ranked r ON r.sid = s1id AND r.cid = links.cid GROUP BY s1id),
 (SELECT round(avg(c), 6) AS mean_cands, quantile_cont(CAST(c AS DOUBLE), 0.5) AS median_cands, round(quantile_cont(CAST(c AS DOUBLE), 0.95), 6) AS p95_cands FROM (SELECT coalesce(c, 0) AS c FROM s1 LEFT JOIN (SELECT sid, count(*) AS c FROM ranked GROUP BY sid) ON sid = entity_id)) m"""))
def blocking_quality(spark, d):
    e, links, s1, q = _parts(spark, d)
    return blocking.blocking_quality(q, links, s1)


_ORDER = "[" + ", ".join(f"'{f}'" for f in FAMILIES) + "]"


@query(_with(_PAIRS, f"""SELECT family, coalesce(direct, 0) AS direct, coalesce(new, 0) AS new, CAST(sum(coalesce(new, 0)) OVER (ORDER BY f) AS BIGINT) AS cumulative FROM (SELECT unnest({_ORDER}) AS family, unnest(range(1, 14)) AS f)
LEFT JOIN (SELECT family, count(*) AS direct FROM pairs JOIN links ON s1id = sid AND links.cid = pairs.cid GROUP BY family) USING (family)
LEFT JOIN (SELECT f, count(*) AS new FROM (SELECT sid, pairs.cid, min(list_position({_ORDER}, family)) AS f FROM pairs JOIN links ON s1id = sid AND links.cid = pairs.cid GROUP BY ALL) GROUP BY f) USING (f)"""))
def marginal_recall(spark, d):
    return blocking.marginal_recall(blocking.blocked_pairs(_keys(spark, d)), src.fixture_links(_ents(spark, d)))


@query(_with(_RANKED, "SELECT CAST(k AS INT) AS k, count(*) FILTER (rank <= k) AS kept FROM ranked JOIN links ON s1id = sid AND links.cid = ranked.cid, (SELECT unnest([3, 5, 7, 8, 10, 12, 15]) AS k) GROUP BY k"))
def topk_retention(spark, d):
    e, links, _, q = _parts(spark, d)
    return blocking.retention(q, links)


@query(_with(_RANKED, "SELECT country, count(*) AS s1, CAST(sum(coalesce(c, 0)) AS BIGINT) AS pairs, round(avg(coalesce(c, 0)), 6) AS mean_cands, CAST(count_if(c IS NULL) AS BIGINT) AS without FROM s1 LEFT JOIN (SELECT sid, count(*) AS c FROM ranked GROUP BY sid) ON sid = entity_id GROUP BY country"))
def country_stats(spark, d):
    e, _, s1, q = _parts(spark, d)
    return blocking.country_stats(q, s1)


def _lcs_sql(a: str, b: str) -> str:
    """Rows of the table of longest common subsequences, one for each letter of a. Letters go as lists of one code."""
    start = f"[list_transform(range(length({b}) + 1), lambda k: CAST(0 AS INT))]"
    letters = f"list_transform(string_split({a}, ''), lambda c: [unicode(c)])"
    cells = f"list_concat([[0]], list_transform(range(1, length({b}) + 1), lambda j: [r[j + 1], r[j], CAST(unicode({b}[j]) = x[1] AS INT)]))"
    row = f"list_reduce({cells}, lambda t, u: list_append(t, CASE WHEN u[3] = 1 THEN u[2] + 1 ELSE greatest(u[1], t[-1]) END))"
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE list_reduce(list_concat({start}, {letters}), lambda r, x: {row})[-1] END"


def _ratio_sql(a: str, b: str) -> str:
    return f"CASE WHEN {a} = '' AND {b} = '' THEN 100.0 ELSE round(CAST(200 AS DOUBLE) * ({_lcs_sql(a, b)}) / (length({a}) + length({b})), 6) END"


@query(_with(_RANKED, f""", o AS (SELECT DISTINCT sb, cb, array_to_string(list_sort(st), ' ') AS ss, array_to_string(list_sort(ct), ' ') AS cs FROM ranked),
q AS (SELECT sb, cb, {_ratio_sql("sb", "cb")} AS ratio, {_ratio_sql("ss", "cs")} AS token_sort FROM o) SELECT sid, cid, CAST(ratio AS DOUBLE) AS ratio, CAST(token_sort AS DOUBLE) AS token_sort FROM ranked JOIN q USING (sb, cb)"""))
def sim_ratios(spark, d):
    q = _sides(spark, d)
    return q.select("sid", "cid", F.round(sim.sim_ratio("s_brand", "c_brand"), 6).alias("ratio"), F.round(sim.sim_token_sort("s_brand", "c_brand"), 6).alias("token_sort"))


def _tset_sql(name: str, pairs: str) -> str:
    """CTEs that end in name (a, b, v): the token-set ratio of distinct pairs. What both have leads both texts, so
    only the rests are compared letter by letter."""
    words = lambda x: f"list_sort(list_distinct(list_filter(string_split({x}, ' '), lambda w: w <> '')))"
    i, gap = "length(wi)", "CASE WHEN wi <> '' THEN 1 ELSE 0 END"
    one, two = f"({i} + {gap} + length(wl))", f"({i} + {gap} + length(wr))"
    return f"""{name}1 AS (SELECT a, b, {words("a")} AS wx, {words("b")} AS wy FROM (SELECT DISTINCT a, b FROM ({pairs}))),
{name}2 AS (SELECT *, array_to_string(list_sort(list_intersect(wx, wy)), ' ') AS wi, array_to_string(list_filter(wx, lambda w: NOT list_contains(wy, w)), ' ') AS wl, array_to_string(list_filter(wy, lambda w: NOT list_contains(wx, w)), ' ') AS wr FROM {name}1),
{name} AS (SELECT a, b, CASE WHEN len(wx) = 0 OR len(wy) = 0 THEN CAST(0 AS DOUBLE) WHEN wi <> '' AND (wl = '' OR wr = '') THEN 100.0
  ELSE greatest(CAST(200 AS DOUBLE) * ({i} + {gap} + ({_lcs_sql("wl", "wr")})) / ({one} + {two}), CASE WHEN wi <> '' THEN greatest(CAST(200 AS DOUBLE) * {i} / ({i} + {one}), CAST(200 AS DOUBLE) * {i} / ({i} + {two})) ELSE 0 END) END AS v FROM {name}2)"""


def _tsort_sql(name: str, pairs: str) -> str:
    """CTEs that end in name (a, b, v): the token-sort ratio of distinct pairs."""
    words = lambda x: f"array_to_string(list_sort(list_filter(string_split({x}, ' '), lambda w: w <> '')), ' ')"
    return f"""{name}1 AS (SELECT a, b, {words("a")} AS wx, {words("b")} AS wy FROM (SELECT DISTINCT a, b FROM ({pairs}))),
{name} AS (SELECT a, b, {_ratio_sql("wx", "wy")} AS v FROM {name}1)"""


_SIMILAR = f"""{_RANKED}, {_tset_sql("bn", "SELECT sb AS a, cb AS b FROM j0")}, {_tset_sql("ba", "SELECT sa AS a, ca AS b FROM j0 WHERE sh AND ch")},
c0 AS (SELECT j1.*, bn.v AS n, CASE WHEN sh AND ch THEN ba.v ELSE 0 END AS a FROM j1 JOIN bn ON bn.a = sb AND bn.b = cb LEFT JOIN ba ON ba.a = sa AND ba.b = ca),
c1 AS (SELECT *, greatest(n, a) + CASE WHEN n >= 50 AND a >= 40 THEN 20 ELSE 0 END + CASE WHEN (sz <> '' AND sz = cz) OR nm = 1 THEN 10 ELSE 0 END AS score FROM c0)"""
ORACLES["ranked_candidates_similar"] = _with(_SIMILAR, "SELECT sid, cid, round(score, 6) AS rank_score, CAST(row_number() OVER (PARTITION BY sid ORDER BY score DESC, cid) AS INT) AS rank, round(n, 6) AS n_tset, round(a, 6) AS a_tset FROM c1 QUALIFY rank <= 12")

_SIMS = f"""{_RANKED}, {_tset_sql("nt", "SELECT sb AS a, cb AS b FROM ranked")}, {_tset_sql("adt", "SELECT sa AS a, ca AS b FROM ranked WHERE sh AND ch")}, {_tsort_sql("ts", "SELECT sb AS a, cb AS b FROM ranked")},
sims0 AS (SELECT r.*, nt.v / 100 AS n_tset, CASE WHEN sh AND ch THEN adt.v / 100 ELSE 0 END AS a_tset, ts.v / 100 AS n_tsort FROM ranked r JOIN nt ON nt.a = sb AND nt.b = cb JOIN ts ON ts.a = sb AND ts.b = cb LEFT JOIN adt ON adt.a = sa AND adt.b = ca),
sims AS (SELECT *, CAST(0.6 AS DOUBLE) * n_tset + CAST(0.4 AS DOUBLE) * a_tset AS comb FROM sims0)"""

_GATED = f"""{_SIMS},
gated AS (SELECT *, CASE WHEN num_conflict = 1 AND a_tset < 0.6 AND n_tset < 0.85 THEN 1 WHEN sz <> '' AND cz <> '' AND sz <> cz AND a_tset < 0.5 AND n_tset < 0.85 THEN 2
  WHEN sl <> '' AND cl <> '' AND sl <> cl AND NOT (sl = 'pvtltd' AND cl IN ('ltd', 'inc', 'corp')) AND a_tset < 0.7 AND n_tset < 0.85 THEN 3
  WHEN NOT (sh AND ch) AND n_tset < 0.8 THEN 4 WHEN NOT translit AND n_tset < 0.35 AND a_tset < 0.9 THEN 5 WHEN p < 0.5 THEN 6 ELSE 0 END AS gate FROM sims)"""


@query(_with(_SIMS, """SELECT sid, cid, round(n_tset, 6) AS n_tset, round(a_tset, 6) AS a_tset, round(n_tsort, 6) AS n_tsort, round(greatest(n_tset, a_tset), 6) AS max_sim, round(comb, 6) AS comb_sim, CAST(n_tset >= 0.6 AND a_tset >= 0.5 AS INT) AS dual_high,
 CAST(num_conflict = 1 AND n_tsort < 0.8 AS INT) AS strict_num_conflict, CAST((len(sn) > 0) <> (len(cn) > 0) AS INT) AS num_missing_one_side, CAST(NOT sh AS INT) AS s1_addr_missing, CAST(NOT ch AS INT) AS c_addr_missing FROM sims"""))
def pair_features_sets(spark, d):
    q = features.flags(features.exact(features.similarities(_sides(spark, d))))
    sims = [F.round(c, 6).alias(c) for c in ("n_tset", "a_tset", "n_tsort", "max_sim", "comb_sim")]
    return q.select("sid", "cid", *sims, "dual_high", "strict_num_conflict", "num_missing_one_side", "s1_addr_missing", "c_addr_missing")


@query()
def sim_scores(spark, d):
    q = _sides(spark, d)
    return q.select("sid", "cid", *(f("s_brand", "c_brand").alias(n) for n, f in (("ratio", sim.sim_ratio), ("partial", sim.sim_partial), ("token_sort", sim.sim_token_sort), ("token_set", sim.sim_token_set), ("w_ratio", sim.sim_w))))


@query(_with(_RANKED, """SELECT sid, cid, round(len(list_intersect(sn, cn)) / greatest(len(sn), len(cn), 1), 6) AS num_overlap, nm AS num_match, num_conflict, CAST(sz <> '' AND sz = cz AS INT) AS zip_match, CAST(sz <> '' AND cz <> '' AND sz <> cz AS INT) AS zip_conflict,
CAST(NOT (sh AND ch) AS INT) AS addr_missing, CAST(sl <> '' AND sl = cl AS INT) AS legal_match, CAST(sl <> '' AND cl <> '' AND sl <> cl AND NOT (sl = 'pvtltd' AND cl IN ('ltd', 'inc', 'corp')) AS INT) AS legal_conflict,
CAST(sb <> '' AND sb = cb AS INT) AS name_exact, round(least(length(sb), length(cb)) / 30, 6) AS brand_len, round(least(len(st), len(ct)) / 5, 6) AS word_cnt, CAST(translit AS INT) AS has_translit FROM ranked"""))
def pair_features_exact(spark, d):
    q = features.exact(_sides(spark, d))
    return q.select("sid", "cid", *(F.round(c, 6).alias(c) if c in ("num_overlap", "brand_len", "word_cnt") else c for c in features.EXACT))


@query()
def pair_features(spark, d):
    return features.vector(_sides(spark, d))


@query()
def pair_features_v0(spark, d):
    return early.features_v0(_sides(spark, d), early.raw_text(_ents(spark, d)))


@query(_with(_RANKED, """SELECT sid, cid, CAST(row_number() OVER (PARTITION BY sid ORDER BY p DESC, cid) - 1 AS INT) AS rank_comb, CAST(row_number() OVER (PARTITION BY sid, c_src ORDER BY p DESC, cid) - 1 AS INT) AS rank_within_src,
round(max(p) OVER (PARTITION BY sid) - p, 6) AS gap_comb, round((p - avg(p) OVER (PARTITION BY sid)) / (stddev_pop(p) OVER (PARTITION BY sid) + 1e-5), 3) AS z_comb, count(*) OVER (PARTITION BY sid) AS n_cands,
CAST(count_if(c_src = 'S2') OVER (PARTITION BY sid) AS BIGINT) AS n_s2, CAST(count_if(c_src = 'S3') OVER (PARTITION BY sid) AS BIGINT) AS n_s3 FROM ranked"""))
def group_context(spark, d):
    q = features.group_context(_sides(spark, d), "p", "p")
    return q.select("sid", "cid", "rank_comb", "rank_within_src", F.round("gap_comb", 6).alias("gap_comb"), F.round("z_comb", 3).alias("z_comb"), "n_cands", "n_s2", "n_s3")


_OTHERS = f"""{_RANKED},
o AS (SELECT a.sid, a.cid, a.cb AS x1, b.cb AS x2, a.c_src <> b.c_src AS other FROM ranked a JOIN ranked b ON a.sid = b.sid AND a.cid <> b.cid),
{_tset_sql("ot", "SELECT x1 AS a, x2 AS b FROM o WHERE other")}, {_tsort_sql("os", "SELECT x1 AS a, x2 AS b FROM o")}"""


@query(_with(_OTHERS, """SELECT r.sid, r.cid, round(coalesce(m, 0), 6) AS agree_max_other, round(coalesce(a, 0), 6) AS agree_mean_other, coalesce(n, 0) AS count_sim_gt_90 FROM ranked r LEFT JOIN
 (SELECT sid, cid, max(CASE WHEN other THEN near END) AS m, avg(CASE WHEN other THEN near END) AS a, count(*) FILTER (alike) AS n FROM (SELECT o.*, CASE WHEN x1 = '' OR x2 = '' THEN 0 ELSE ot.v / 100 END AS near, os.v >= 90 AS alike FROM o JOIN os ON os.a = x1 AND os.b = x2 LEFT JOIN ot ON ot.a = x1 AND ot.b = x2) GROUP BY sid, cid) g USING (sid, cid)"""))
def agreement(spark, d):
    return features.agreement(_sides(spark, d)).select("sid", "cid", F.round("agree_max_other", 6).alias("agree_max_other"), F.round("agree_mean_other", 6).alias("agree_mean_other"), "count_sim_gt_90")


@query(_with(_RANKED, """, r AS (SELECT *, row_number() OVER w AS r, count(*) OVER (PARTITION BY cid) AS n, max(p) OVER (PARTITION BY cid) AS best, lead(p) OVER w AS nxt FROM ranked WINDOW w AS (PARTITION BY cid ORDER BY p DESC, sid))
SELECT sid, cid, n AS cand_s1_count, CAST(r = 1 AS INT) AS is_mutual_best, round(CASE WHEN n = 1 THEN 1.0 WHEN r = 1 THEN p - nxt ELSE p - best END, 6) AS gap_to_second_s1 FROM r"""))
def reverse_context(spark, d):
    return features.reverse_context(_sides(spark, d), "p").select("sid", "cid", "cand_s1_count", "is_mutual_best", F.round("gap_to_second_s1", 6).alias("gap_to_second_s1"))


@query(_with(_GATED, "SELECT sid, cid, gate FROM gated"))
def precision_gate(spark, d):
    q = features.exact(features.similarities(_sides(spark, d)))
    return q.select("sid", "cid", decisions.precision_gate(0.5).alias("gate"))


@query(_with(_SIMS, "SELECT sid, cid FROM sims WHERE NOT (num_conflict = 1 AND n_tsort < 0.8)"))
def number_veto(spark, d):
    return decisions.number_veto(features.exact(features.similarities(_sides(spark, d)))).select("sid", "cid")


@query(_with(_RANKED, "SELECT sid, cid, p FROM ranked WHERE p >= 0.4 QUALIFY row_number() OVER (PARTITION BY sid, left(cid, 2) ORDER BY p DESC, cid) <= 3"))
def cap_per_source(spark, d):
    return decisions.cap_per_source(_sides(spark, d).where("p >= 0.4")).select("sid", "cid", "p")


@query(_with(_WON, "SELECT sid, cid, p FROM won"))
def exclusive_matches(spark, d):
    return _links(_sides(spark, d)).select("sid", "cid", "p")


@query(_with(_RANKED, "SELECT sid, cid FROM ranked WHERE p >= CASE WHEN country = 'US' THEN CASE WHEN cid LIKE 'S3-%' THEN 0.7 ELSE 0.6 END ELSE 0.5 END"))
def country_thresholds(spark, d):
    table = spark.createDataFrame([("US", 0.6, 0.7), (None, 0.5, 0.5)], "country string, th_s2 double, th_s3 double")
    return decisions.above_table(_sides(spark, d), table).select("sid", "cid")


@query(_with(_RANKED, "SELECT sid, cid FROM ranked WHERE p >= 0.5 + CASE WHEN country IN ('US', 'India') THEN 0 ELSE 0.05 END"))
def unseen_offset(spark, d):
    return decisions.above(_sides(spark, d), 0.5, 0.5, ("US", "India"), 0.05).select("sid", "cid")


@query(_with(_WON, f"SELECT round(avg({_F05}), 6) AS macro_f05 FROM counts"))
def macro_f05(spark, d):
    e, links, s1, q = _parts(spark, d)
    return decisions.macro_f05(decisions.per_s1(_links(q), links, s1))


@query(_with(_WON, f"""SELECT CASE WHEN grouping(country) = 1 THEN '*' ELSE country END AS country, CASE WHEN grouping(k) = 1 THEN -1 ELSE k END AS k, count(*) AS n, round(avg(f), 6) AS f05, round(avg(mp), 6) AS mean_precision, round(avg(mr), 6) AS mean_recall,
 round(sum(tp) / greatest(sum(npred), 1), 6) AS precision, round(sum(tp) / greatest(sum(ntrue), 1), 6) AS recall, round(avg(npred), 6) AS mean_preds, round(avg(CASE WHEN ntrue = 0 THEN CAST(npred = 0 AS INT) END), 6) AS singleton_accuracy
FROM (SELECT *, {_F05} AS f, CASE WHEN npred > 0 THEN tp / npred WHEN ntrue = 0 THEN 1.0 ELSE 0.0 END AS mp, CASE WHEN ntrue > 0 THEN tp / ntrue ELSE 1.0 END AS mr, least(ntrue, 6) AS k FROM counts) GROUP BY GROUPING SETS ((), (country), (k))"""))
def metric_breakdown(spark, d):
    e, links, s1, q = _parts(spark, d)
    return decisions.breakdown(decisions.per_s1(_links(q), links, s1))


@query(_with(_WON, f""", srcs AS (SELECT unnest(['S2', 'S3']) AS k),
a AS (SELECT left(x.cid, 2) AS k, x.sid, count(*) AS npred, count(l.cid) AS tp FROM won x LEFT JOIN links l ON l.s1id = x.sid AND l.cid = x.cid GROUP BY ALL),
b AS (SELECT left(cid, 2) AS k, s1id AS sid, count(*) AS ntrue FROM links GROUP BY ALL),
z AS (SELECT srcs.k, coalesce(npred, 0) AS npred, coalesce(tp, 0) AS tp, coalesce(ntrue, 0) AS ntrue FROM srcs CROSS JOIN s1 LEFT JOIN a ON a.k = srcs.k AND a.sid = s1.entity_id LEFT JOIN b ON b.k = srcs.k AND b.sid = s1.entity_id)
SELECT k AS src, round(avg({_F05}), 6) AS macro_f05 FROM z GROUP BY k"""))
def source_f05(spark, d):
    e, links, s1, q = _parts(spark, d)
    won = _links(q).persist()
    return decisions.source_f05(won, links, s1, "S2").unionByName(decisions.source_f05(won, links, s1, "S3"))


def _grid_sql(cols: str, grid: str, condition: str) -> str:
    return _with(
        _RANKED,
        f""", y AS (SELECT r.*, l.cid IS NOT NULL AS y FROM ranked r LEFT JOIN links l ON s1id = sid AND l.cid = r.cid), grid AS ({grid}),
per AS (SELECT {cols}, sid, count(*) AS npred, count_if(y) AS tp FROM y, grid WHERE {condition} GROUP BY ALL), tr AS (SELECT s1id, count(*) AS ntrue FROM links GROUP BY s1id)
SELECT {cols}, round(avg({_F05}), 6) AS macro_f05 FROM (SELECT {", ".join("g." + c.strip() for c in cols.split(","))}, coalesce(npred, 0) AS npred, coalesce(tp, 0) AS tp, coalesce(ntrue, 0) AS ntrue
 FROM grid g CROSS JOIN s1 LEFT JOIN per ON {" AND ".join(f"per.{c.strip()} = g.{c.strip()}" for c in cols.split(","))} AND per.sid = s1.entity_id LEFT JOIN tr ON tr.s1id = s1.entity_id) GROUP BY ALL""",
    )


_STEP_LIST = "[" + ", ".join(f"CAST({t} AS DOUBLE)" for t in STEPS) + "]"


@query(_grid_sql("threshold", f"SELECT unnest({_STEP_LIST}) AS threshold", "p >= threshold"))
def threshold_grid(spark, d):
    e, links, s1, q = _parts(spark, d)
    return decisions.threshold_grid(q, links, s1, STEPS)


@query(_grid_sql("th_s2, th_s3", f"SELECT * FROM (SELECT unnest({_STEP_LIST}) AS th_s2), (SELECT unnest({_STEP_LIST}) AS th_s3)", "p >= CASE WHEN cid LIKE 'S3-%' THEN th_s3 ELSE th_s2 END").replace("FROM ranked r LEFT JOIN links", "FROM (SELECT * FROM ranked QUALIFY row_number() OVER (PARTITION BY cid ORDER BY p DESC, sid) = 1) r LEFT JOIN links"))
def source_grid(spark, d):
    e, links, s1, q = _parts(spark, d)
    return decisions.source_grid(decisions.exclusive(q), links, s1, STEPS)


_FINE_LIST = "[" + ", ".join(f"CAST({t} AS DOUBLE)" for t in decisions.GRID) + "]"


@query(_grid_sql("threshold", f"SELECT unnest({_FINE_LIST}) AS threshold", "p >= threshold"))
def threshold_grid_fine(spark, d):
    e, links, s1, q = _parts(spark, d)
    return decisions.threshold_grid(q, links, s1, decisions.GRID)


@query(_grid_sql("th_s2, th_s3", f"SELECT * FROM (SELECT unnest({_FINE_LIST}) AS th_s2), (SELECT unnest({_FINE_LIST}) AS th_s3)", "p >= CASE WHEN cid LIKE 'S3-%' THEN th_s3 ELSE th_s2 END").replace("FROM ranked r LEFT JOIN links", "FROM (SELECT * FROM ranked QUALIFY row_number() OVER (PARTITION BY cid ORDER BY p DESC, sid) = 1) r LEFT JOIN links"))
def source_grid_fine(spark, d):
    e, links, s1, q = _parts(spark, d)
    return decisions.source_grid(decisions.exclusive(q), links, s1, decisions.GRID)


def _spread_sql(ps: str) -> str:
    """P(0), P(1), ... true ones among independent ps."""
    step = "lambda d, q: list_transform(range(1, len(d) + 2), lambda i: coalesce(d[i], 0) * (1 - q[1]) + CASE WHEN i > 1 THEN d[i - 1] * q[1] ELSE 0 END)"
    return f"list_reduce(list_concat([[CAST(1 AS DOUBLE)]], list_transform({ps}, lambda q: [CAST(q AS DOUBLE)])), {step})"


_EXPECTED = f"""ps AS (SELECT sid, list(p ORDER BY p DESC) AS ps FROM ranked GROUP BY sid),
hk AS (SELECT sid, k, {_spread_sql("ps[1:k]")} AS h, {_spread_sql("ps[k + 1:]")} AS t FROM ps, unnest(range(1, len(ps) + 1)) u(k)),
vk AS (SELECT sid, k, list_sum(list_transform(range(1, len(h) + 1), lambda i: list_sum(list_transform(range(1, len(t) + 1), lambda j: h[i] * t[j] * 1.25 * (i - 1) / (0.25 * k + (i - 1) + (j - 1)))))) AS v FROM hk
  UNION ALL SELECT sid, 0, list_aggregate(list_transform(ps, lambda q: CAST(1 - q AS DOUBLE)), 'product') FROM ps),
best_k AS (SELECT sid, CAST(k AS INT) AS k FROM vk QUALIFY row_number() OVER (PARTITION BY sid ORDER BY round(v, 9) DESC, k) = 1)"""


@query(_with(_RANKED, f", {_EXPECTED} SELECT sid, k FROM best_k"))
def expected_f05_topk(spark, d):
    q = _sides(spark, d).groupBy("sid").agg(F.reverse(F.array_sort(F.collect_list("p"))).alias("ps"))
    return q.select("sid", decisions.expected_f05_k(F.col("ps"), by_kept=True).alias("k"))


def _ablations_sql() -> str:
    ctes, rows = [], []
    for excl, veto, cap in product((0, 1), repeat=3):
        q = "SELECT * FROM gated WHERE gate = 0" + veto * " AND NOT (num_conflict = 1 AND n_tsort < 0.8)"
        q = q + excl * " QUALIFY row_number() OVER (PARTITION BY cid ORDER BY comb DESC, sid) = 1"
        q = f"SELECT * FROM ({q}) QUALIFY row_number() OVER (PARTITION BY sid, left(cid, 2) ORDER BY comb DESC, cid) <= 3" if cap else q
        name = f"a{excl}{veto}{cap}"
        ctes.append(_scored(name, f"({q})"))
        rows.append(f"SELECT {excl} AS excl, {veto} AS veto, {cap} AS cap, round(avg({_F05}), 6) AS macro_f05 FROM {name}")
    return _with(_GATED, ", " + ", ".join(ctes) + " " + " UNION ALL ".join(rows))


@query(_ablations_sql())
def ablations(spark, d):
    e, links, s1, q = _parts(spark, d)
    return decisions.ablations(written(features.similarities(q), "ablated"), links, s1, 0.5, "comb_sim")


@query(_with(_RANKED, """, grid AS (SELECT * FROM (SELECT unnest([0.4, 0.5, 0.6, 0.7]::DOUBLE[]) AS th_s2), (SELECT unnest([0.4, 0.5, 0.6, 0.7]::DOUBLE[]) AS th_s3)),
won AS (SELECT th_s2, th_s3, sid, cid FROM ranked, grid WHERE p >= CASE WHEN cid LIKE 'S3-%' THEN th_s3 ELSE th_s2 END QUALIFY row_number() OVER (PARTITION BY th_s2, th_s3, cid ORDER BY p DESC, sid) = 1),
a AS (SELECT th_s2, th_s3, count(*) AS l, count(DISTINCT sid) AS w FROM won GROUP BY ALL), t AS (SELECT count(*) AS n FROM s1)
SELECT th_s2, th_s3, round(coalesce(l, 0) / n, 6) AS links_per_s1, round(1 - coalesce(w, 0) / n, 6) AS empty_rate, round(2 * abs(1 - coalesce(w, 0) / n - 0.08) + 0.1 * abs(coalesce(l, 0) / n - 3.1), 6) AS distance FROM grid LEFT JOIN a USING (th_s2, th_s3), t"""))
def threshold_sweep(spark, d):
    e, _, s1, q = _parts(spark, d)
    return decisions.threshold_sweep(q, s1, CONFIGS, 0.08, 3.1)


@query(_with(_RANKED, """, grid AS (SELECT * FROM (SELECT unnest([0.52, 0.54, 0.56, 0.575]::DOUBLE[]) AS th_india), (SELECT unnest([0.625, 0.65, 0.675, 0.7]::DOUBLE[]) AS th_us), (SELECT unnest([0.6, 0.625, 0.65]::DOUBLE[]) AS th_france), (SELECT unnest([0.0, 0.02, 0.03]::DOUBLE[]) AS d_s3)),
r AS (SELECT sid, cid, p, e.country AS c FROM ranked JOIN ents e ON e.entity_id = sid),
won AS (SELECT grid.*, c, sid FROM r, grid WHERE p >= CASE c WHEN 'India' THEN th_india WHEN 'US' THEN th_us ELSE th_france END + CASE WHEN cid LIKE 'S3-%' THEN d_s3 ELSE 0 END
  QUALIFY row_number() OVER (PARTITION BY th_india, th_us, th_france, d_s3, cid ORDER BY p DESC, sid) = 1),
n AS (SELECT country AS c, count(*) AS n FROM ents WHERE entity_id LIKE 'S1-%' GROUP BY country),
a AS (SELECT th_india, th_us, th_france, d_s3, n.c, any_value(n) AS n, count(won.sid) / any_value(n) AS l, 1 - count(DISTINCT won.sid) / any_value(n) AS e FROM grid CROSS JOIN n LEFT JOIN won USING (th_india, th_us, th_france, d_s3, c) GROUP BY ALL),
b AS (SELECT th_india, th_us, th_france, d_s3, max(l) FILTER (c = 'India') AS li, max(l) FILTER (c = 'US') AS lu, max(l) FILTER (c = 'France') AS lf, max(e) FILTER (c = 'India') AS ei, max(e) FILTER (c = 'US') AS eu, max(e) FILTER (c = 'France') AS ef FROM a GROUP BY ALL)
SELECT th_india, th_us, th_france, d_s3, round(li, 6) AS links_india, round(lu, 6) AS links_us, round(lf, 6) AS links_france, round(ei, 6) AS empty_india, round(eu, 6) AS empty_us, round(ef, 6) AS empty_france,
 round(2 * (abs(ei - 0.0559) + abs(eu - 0.0558) + abs(ef - 0.056)) + 0.1 * (abs(li - 3.4645) + abs(lu - 3.4591)), 6) AS distance FROM b"""))
def threshold_sweep_countries(spark, d):
    e, _, s1, q = _parts(spark, d)
    return decisions.country_sweep(decisions.exclusive(q), s1, COUNTRY_STEPS, [0.0, 0.02, 0.03], {"India": 0.0559, "US": 0.0558, "France": 0.056}, {"India": 3.4645, "US": 3.4591})


@query(_with(_RANKED, "SELECT CAST(b AS INT) AS bin, count(p) AS n FROM (SELECT unnest(range(20)) AS b) LEFT JOIN ranked ON least(floor(p * 20), 19) = b GROUP BY b"))
def prob_histogram(spark, d):
    return decisions.histogram(_sides(spark, d))


@query(_with(_WON, "SELECT country, round(avg(npred), 6) AS links_per_s1, round(avg(CAST(npred = 0 AS INT)), 6) AS empty_rate FROM counts GROUP BY country"))
def prediction_stats(spark, d):
    e, _, s1, q = _parts(spark, d)
    return decisions.prediction_stats(_links(q), s1)


@query(_with(_WON, "SELECT entity_id AS source1_entity_id, coalesce(string_agg(cid, ',' ORDER BY p DESC, cid), '') AS matched_entity_ids FROM s1 LEFT JOIN won ON sid = entity_id GROUP BY entity_id"))
def match_lists(spark, d):
    e, _, s1, q = _parts(spark, d)
    return src.match_lists(s1, _links(q))


@query(_with(src.FIXTURE, """, g AS (SELECT truth_s1 AS s1, string_agg(entity_id, ',' ORDER BY entity_id) AS ids FROM ents WHERE truth_s1 IS NOT NULL GROUP BY truth_s1),
l AS (SELECT * FROM g UNION ALL SELECT * FROM (VALUES ('S1-00000001', 'S1-00000002,S2-x,S2-x,Z9'), ('S1-99999999', ''))),
r AS (SELECT s1, list_filter(string_split(ids, ','), lambda v: v <> '') AS x FROM l), e AS (SELECT s1, unnest(x) AS id FROM r),
own AS (SELECT entity_id FROM ents WHERE entity_id LIKE 'S1-%'), pool AS (SELECT entity_id FROM ents WHERE entity_id NOT LIKE 'S1-%'),
found AS (SELECT 'duplicate_s1' AS rule, s1 AS id FROM l GROUP BY s1 HAVING count(*) > 1
  UNION ALL SELECT 'repeated_id', s1 FROM r WHERE len(x) <> len(list_distinct(x))
  UNION ALL SELECT 'self_match', id FROM e WHERE id LIKE 'S1-%'
  UNION ALL SELECT 'bad_prefix', id FROM e WHERE NOT regexp_matches(id, '^S[123]-')
  UNION ALL SELECT 'missing_s1', entity_id FROM own WHERE entity_id NOT IN (SELECT s1 FROM l)
  UNION ALL SELECT 'extra_s1', s1 FROM l WHERE s1 NOT IN (SELECT entity_id FROM own)
  UNION ALL SELECT 'rows', s1 FROM l
  UNION ALL SELECT 'empty_rows', s1 FROM r WHERE len(x) = 0
  UNION ALL SELECT 'unknown_id', id FROM e WHERE regexp_matches(id, '^S[23]-') AND id NOT IN (SELECT entity_id FROM pool)
  UNION ALL SELECT 'not_candidates', r.s1 FROM r LEFT JOIN g ON g.s1 = r.s1 WHERE len(list_filter(r.x, lambda v: NOT list_contains(string_split(coalesce(g.ids, ''), ','), v))) > 0),
rules AS (SELECT * FROM (VALUES ('duplicate_s1', 'error'), ('repeated_id', 'error'), ('self_match', 'error'), ('bad_prefix', 'error'), ('missing_s1', 'error'), ('extra_s1', 'error'), ('rows', 'info'), ('empty_rows', 'info'), ('unknown_id', 'error'), ('not_candidates', 'warning')) v(rule, severity))
SELECT rule, severity, count(id) AS n, coalesce(array_to_string(list_sort(list(DISTINCT id) FILTER (id IS NOT NULL))[1:5], ','), '') AS examples FROM rules LEFT JOIN found USING (rule) GROUP BY rule, severity"""))
def validate_rules(spark, d):
    e = _ents(spark, d)
    s1, pool = e.where("entity_id LIKE 'S1-%'"), e.where("entity_id NOT LIKE 'S1-%'")
    lists = gt_lists(spark, d).toDF("s1", "ids")
    broken = lists.unionByName(spark.createDataFrame([("S1-00000001", "S1-00000002,S2-x,S2-x,Z9"), ("S1-99999999", "")], "s1 string, ids string"))
    return validation.validate(broken, s1, pool, lists)


def _trained(spark, d):
    e = _ents(spark, d)
    return written(matching.labelled(features.vector(resolution.candidates(e)), src.fixture_links(e)), "training")


def _out_of_fold(spark, d):
    return written(matching.out_of_fold(_trained(spark, d)).drop("x"), "out-of-fold")


@query()
def gbt_oof(spark, d):
    return matching.out_of_fold(_trained(spark, d)).select("sid", "cid", "fold", "label", F.col("raw").alias("p"))


@query()
def isotonic(spark, d):
    scored = _out_of_fold(spark, d)
    return matching.calibrated(matching.calibrate(scored), scored).select("sid", "cid", "raw", "p")


@query()
def loco(spark, d):
    e = _ents(spark, d)
    return resolution.leave_country_out(_trained(spark, d), src.fixture_links(e), e.where("entity_id LIKE 'S1-%'"))


@query(_with(src.FIXTURE, "SELECT CAST(row_number() OVER (ORDER BY entity_id) AS INT) AS place, entity_id FROM ents WHERE entity_id LIKE 'S1-%'"))
def ordered_s1(spark, d):
    """S1 in the order of their file."""
    path = new_path(spark, "s1")
    s1 = _ents(spark, d).where("entity_id LIKE 'S1-%'").select("entity_id", "business_name", "business_address", "country").orderBy("entity_id")
    s1.coalesce(1).write.option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(path)
    rows = src.in_order(spark, path)
    return rows.select(F.row_number().over(Window.orderBy("place")).alias("place"), "entity_id")  # numbers are for the comparison only


@query(_with(src.FIXTURE, "SELECT entity_id, business_name, business_address, country FROM ents WHERE country = 'France' ORDER BY entity_id LIMIT 50"))
def country_listing(spark, d):
    return src.listing(_ents(spark, d), "France").select("entity_id", "business_name", "business_address", "country")


@query(_with(src.FIXTURE, "SELECT CASE WHEN entity_id LIKE 'S1-%' THEN 's1' ELSE 'pool' END AS part, entity_id FROM ents WHERE country = 'India'"))
def country_parts(spark, d):
    s1, pool = src.of_country(_ents(spark, d), "India")
    return s1.select(F.lit("s1").alias("part"), "entity_id").unionByName(pool.select(F.lit("pool").alias("part"), "entity_id"))


@query(_with(_RANKED, """, x AS (SELECT sid, cid FROM ranked UNION ALL SELECT * FROM (VALUES ('S1-none', 'S2-none')))
SELECT 'sid' AS side, sid AS id FROM x WHERE sid NOT IN (SELECT entity_id FROM ents) UNION SELECT 'cid', cid FROM x WHERE cid NOT IN (SELECT entity_id FROM ents)"""))
def unknown_ids(spark, d):
    """Ends of pairs that no entity has; one such pair is planted."""
    e = _ents(spark, d)
    return src.unknown_ids(resolution.candidates(e).select("sid", "cid").unionByName(spark.createDataFrame([("S1-none", "S2-none")], "sid string, cid string")), e)


@query(_with(_RANKED, "SELECT CAST(coalesce(min(k) FILTER (kept >= 0.995 * total), 15) AS INT) AS k FROM (SELECT k, count(*) FILTER (rank <= k) AS kept, count(*) AS total FROM ranked JOIN links ON s1id = sid AND links.cid = ranked.cid, (SELECT unnest([3, 5, 7, 8, 10, 12, 15]) AS k) GROUP BY k)"))
def least_k(spark, d):
    e, links, _, q = _parts(spark, d)
    return blocking.least_k(q, links)


_V0 = f"""{src.FIXTURE},
v0 AS (SELECT entity_id, left(entity_id, 2) AS src, country, trim(regexp_replace(regexp_replace(regexp_replace(strip_accents(lower(trim(business_name))), '{HANDLE}', ' ', 'gi'), '{DOMAIN.replace("|biz|info", "")}', ' ', 'gi'), '\\s+', ' ', 'g')) AS name,
  trim(regexp_replace(strip_accents(lower(trim(coalesce(business_address, '')))), '\\s+', ' ', 'g')) AS addr FROM ents),
v1 AS (SELECT *, list_filter(string_split_regex(regexp_replace(name, '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '\\s+'), lambda w: w <> '') AS nw, list_filter(string_split_regex(regexp_replace(addr, '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '\\s+'), lambda w: w <> '') AS aw, regexp_extract_all(addr, '\\b\\d+\\b') AS nums FROM v0),
v2 AS (SELECT *, coalesce(list_filter(nums, lambda x: length(x) IN (5, 6))[1], '') AS zip FROM v1),
raw AS (SELECT *, list_filter(nw, lambda x: length(x) >= 3 AND x NOT IN {_quoted(NAME_STOP)}) AS t, list_filter(nw, lambda x: length(x) = 2 AND x NOT IN {_quoted(NAME_STOP)}) AS h,
  list_filter(nums, lambda x: x <> zip AND length(x) <= 5) AS sn, list_filter(aw, lambda x: length(x) >= 3 AND NOT regexp_full_match(x, '\\d+') AND x NOT IN {_quoted(ADDR_STOP)}) AS w FROM v2)"""


@query(_with(_V0, """SELECT entity_id, 'tok' AS family, unnest(t) AS key FROM raw
  UNION ALL SELECT entity_id, 'bi', unnest(list_transform(range(1, len(t)), lambda i: t[i] || '_' || t[i + 1])) FROM raw
  UNION ALL SELECT entity_id, 'pref4', t[1][1:4] FROM raw WHERE length(t[1]) >= 4
  UNION ALL SELECT entity_id, 'addr_tok', unnest(list_filter(w[1:4], lambda x: length(x) >= 4)) FROM raw
  UNION ALL SELECT entity_id, 'zip_num', unnest(list_transform(sn[1:3], lambda x: zip || '|' || x)) FROM raw WHERE zip <> ''
  UNION ALL SELECT entity_id, 'sn_w', sn[i] || '|' || w[j] FROM raw, range(1, 3) a(i), range(1, 5) b(j) WHERE i <= len(sn) AND j <= len(w)
  UNION ALL SELECT entity_id, 'zip_w', unnest(list_transform(w[1:3], lambda x: zip || '|' || x)) FROM raw WHERE zip <> ''
  UNION ALL SELECT entity_id, 'addr_pair', least(w[i], w[j]) || '|' || greatest(w[i], w[j]) FROM raw, range(1, 5) a(i), range(1, 5) b(j) WHERE i < j AND j <= len(w)
  UNION ALL SELECT entity_id, 'st_zip', h[1] || '|' || zip FROM raw WHERE zip <> '' AND len(h) > 0
  UNION ALL SELECT entity_id, 'st_sn', unnest(list_transform(sn[1:2], lambda x: h[1] || '|' || x)) FROM raw WHERE len(h) > 0"""))
def keys_v0(spark, d):
    return early.keys_v0(early.raw_text(_ents(spark, d))).select("entity_id", "family", "key")


@query(_with(_V0, "SELECT entity_id, name, addr, zip, array_to_string(t, ',') AS tokens, array_to_string(h, ',') AS short, array_to_string(sn, ',') AS street_nums, array_to_string(w, ',') AS words FROM raw"))
def raw_texts(spark, d):
    r = early.raw_text(_ents(spark, d))
    return r.select("entity_id", "name", "addr", "zip", *(F.array_join(c, ",").alias(c) for c in ("tokens", "short", "street_nums", "words")))


_RAW = f"""{_RANKED},
lower_ AS (SELECT entity_id, lower(business_name) AS n, lower(coalesce(business_address, '')) AS a FROM ents),
rp AS (SELECT r.sid, r.cid, r.p, s.n AS rsn, c.n AS rcn, s.a AS rsa, c.a AS rca FROM ranked r JOIN lower_ s ON s.entity_id = sid JOIN lower_ c ON c.entity_id = cid WHERE p >= 0.4),
{_tset_sql("rn", "SELECT rsn AS a, rcn AS b FROM rp")}, {_tset_sql("ra", "SELECT rsa AS a, rca AS b FROM rp WHERE rsa <> '' AND rca <> ''")},
rs AS (SELECT rp.*, CAST(0.6 AS DOUBLE) * rn.v + CAST(0.4 AS DOUBLE) * CASE WHEN rsa <> '' AND rca <> '' THEN ra.v ELSE 0 END AS sc FROM rp JOIN rn ON rn.a = rsn AND rn.b = rcn LEFT JOIN ra ON ra.a = rsa AND ra.b = rca)"""


def _raw_scored(spark, d):
    e = _ents(spark, d)
    return early.raw_score(early.with_raw(resolution.candidates(e).where("p >= 0.4").select("sid", "cid", "p"), e))


@query(_with(_RAW, "SELECT sid, cid, round(sc, 6) AS sc FROM rs"))
def raw_scores(spark, d):
    return _raw_scored(spark, d).select("sid", "cid", F.round("sc", 6).alias("sc"))


@query(_with(_RAW, "SELECT sid, cid FROM rs QUALIFY row_number() OVER (PARTITION BY cid ORDER BY sc DESC, sid) = 1"))
def exclusive_raw(spark, d):
    """Owners by raw-text score."""
    return decisions.exclusive(_raw_scored(spark, d), "sc").select("sid", "cid")


@query(_with(_RAW, f""", {_tsort_sql("rt", "SELECT rsn AS a, rcn AS b FROM rs")},
nums AS (SELECT rs.*, rt.v AS tsort, count(*) OVER (PARTITION BY sid) >= 4 AS many, list_distinct(list_transform(list_filter(regexp_extract_all(rsa, '\\b\\d+\\b'), lambda x: length(x) <= 5), lambda x: CAST(x AS INT))) AS x, list_distinct(list_transform(list_filter(regexp_extract_all(rca, '\\b\\d+\\b'), lambda x: length(x) <= 5), lambda x: CAST(x AS INT))) AS y FROM rs JOIN rt ON rt.a = rsn AND rt.b = rcn),
left_ AS (SELECT * FROM nums WHERE NOT (many AND len(x) > 0 AND len(y) > 0 AND NOT list_has_any(x, y) AND tsort < 80))
SELECT sid, cid FROM left_ QUALIFY NOT many OR row_number() OVER (PARTITION BY sid, left(cid, 2) ORDER BY sc DESC, cid) <= 3"""))
def pruned_matches(spark, d):
    """Long match lists without number conflicts, three of each source."""
    return early.pruned(_raw_scored(spark, d)).select("sid", "cid")


_OWNED = "FROM (SELECT * FROM ranked QUALIFY row_number() OVER (PARTITION BY cid ORDER BY p DESC, sid) = 1) r LEFT JOIN links"
GATED_STEPS, EXCLUSIVE_STEPS, DENSE_STEPS = [0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.78, 0.8, 0.82], [0.45, 0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8], [0.65, 0.7, 0.72, 0.75]


def _steps_sql(steps: list[float]) -> str:
    return "SELECT unnest([" + ", ".join(f"CAST({t} AS DOUBLE)" for t in steps) + "]) AS threshold"


@query(_grid_sql("threshold", _steps_sql(GATED_STEPS), "p >= threshold").replace(_RANKED, _GATED).replace("FROM ranked r LEFT JOIN links", "FROM (SELECT * FROM gated WHERE gate IN (0, 6)) r LEFT JOIN links"))
def threshold_grid_gated(spark, d):
    """The first generation's grid: pairs pass the other gates and the threshold."""
    e, links, s1, q = _parts(spark, d)
    q = features.similarities(q)
    return decisions.threshold_grid(q.where(decisions.precision_gate(0.0) == 0), links, s1, GATED_STEPS)


@query(_grid_sql("threshold", _steps_sql(EXCLUSIVE_STEPS), "p >= threshold").replace("FROM ranked r LEFT JOIN links", _OWNED))
def threshold_grid_exclusive(spark, d):
    e, links, s1, q = _parts(spark, d)
    return decisions.threshold_grid(decisions.exclusive(q), links, s1, EXCLUSIVE_STEPS)


@query(_grid_sql("threshold", _steps_sql(DENSE_STEPS), "p >= threshold").replace("FROM ranked r LEFT JOIN links", _OWNED))
def density_thresholds(spark, d):
    """Drawn false candidates, left out again before scoring, change nothing."""
    e, links, s1, q = _parts(spark, d)
    dense = decisions.exclusive(decisions.with_distractors(q, s1)).where("cid NOT LIKE 'DISTRACT-%'")
    return decisions.threshold_grid(dense, links, s1, DENSE_STEPS)


@query(ORACLES["source_grid_fine"] + " ORDER BY macro_f05 DESC, th_s2, th_s3 LIMIT 10")
def best_thresholds(spark, d):
    """The ten best cells of the grid, the chosen one first."""
    return source_grid_fine(spark, d).orderBy(F.desc("macro_f05"), "th_s2", "th_s3").limit(10)


@query(_with(_RANKED, """SELECT r.sid, r.cid, CAST(row_number() OVER w AS INT) AS place, count(l.cid) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp FROM ranked r LEFT JOIN links l ON l.s1id = r.sid AND l.cid = r.cid
WINDOW w AS (PARTITION BY r.sid ORDER BY p DESC, r.cid)"""))
def cumulative_tp(spark, d):
    e, links, _, q = _parts(spark, d)
    return decisions.cumulative_tp(q, links)


def _strategies_sql() -> str:
    ctes, rows, n = [], [], 0
    own = "SELECT * FROM ranked QUALIFY row_number() OVER (PARTITION BY cid ORDER BY p DESC, sid) = 1"
    cells = [(1, "global", t, t) for t in (0.55, 0.6, 0.65, 0.7, 0.75)] + [(2, "by_source", a, b) for a in (0.6, 0.65, 0.7) for b in (0.6, 0.65, 0.7)]
    for o, name, a, b in cells:
        n += 1
        ctes.append(_scored(f"c{n}", f"(SELECT * FROM ({own}) WHERE p >= CASE WHEN cid LIKE 'S3-%' THEN {b} ELSE {a} END)"))
        rows.append(f"SELECT {o} AS o, '{name}' AS strategy, CAST({a} AS DOUBLE) AS th_s2, CAST({b} AS DOUBLE) AS th_s3, round(avg({_F05}), 6) AS macro_f05 FROM c{n}")
    top = "(SELECT r.* FROM (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY p DESC, cid) AS place FROM ranked) r JOIN best_k USING (sid) WHERE place <= k QUALIFY row_number() OVER (PARTITION BY cid ORDER BY p DESC, sid) = 1)"
    ctes.append(_scored("top_", top))
    rows.append(f"SELECT 3, 'expected_f05', NULL, NULL, round(avg({_F05}), 6) FROM top_")
    return _with(_RANKED, f", {_EXPECTED}, " + ", ".join(ctes) + ", s AS (" + " UNION ALL ".join(rows) + ") SELECT strategy, th_s2, th_s3, macro_f05, row_number() OVER (ORDER BY macro_f05 DESC, o, th_s2, th_s3) = 1 AS best FROM s")


@query(_strategies_sql())
def strategies(spark, d):
    e, links, s1, q = _parts(spark, d)
    return decisions.strategies(q, links, s1)


@query(_with(_RANKED, """SELECT r.sid, r.cid, r.country, l.cid IS NOT NULL AS label, CAST(nm AS DOUBLE) AS num_match, CAST(num_conflict AS DOUBLE) AS num_conflict, CAST(sz <> '' AND sz = cz AS DOUBLE) AS zip_match
FROM ranked r LEFT JOIN links l ON l.s1id = r.sid AND l.cid = r.cid WHERE r.country IN ('India', 'US')"""))
def universe_pairs(spark, d):
    """Built features on Parquet, resumed once, scanned for two countries with their labels."""
    e, path = _ents(spark, d), new_path(spark, "universe")
    universe.build(e.where("country <> 'India'"), path, similar=False)
    universe.build(e, path, similar=False)
    pairs = universe.scan(spark, path, ["India", "US"])
    return universe.labelled(pairs, src.fixture_links(e)).select("sid", "cid", "country", "label", "num_match", "num_conflict", "zip_match")


@query(_with(_RANKED, "SELECT sid, cid, country, CAST(cid LIKE 'S3-%' AS TINYINT) AS is_s3, p FROM ranked WHERE p >= 0.3"))
def score_cache(spark, d):
    return universe.cache(_sides(spark, d), new_path(spark, "cache"))


@query(_with(_RANKED, """, t AS (SELECT * FROM (VALUES ('US', 0.6, 0.7), ('France', 0.55, 0.6)) v(country, a, b)), goal AS (SELECT * FROM (VALUES ('US', 3.4591, 0.0558), ('India', 3.4645, 0.0559)) v(country, l, e)),
kept AS (SELECT r.* FROM ranked r LEFT JOIN t USING (country) WHERE p >= 0.3 AND p >= CASE WHEN cid LIKE 'S3-%' THEN coalesce(b, 0.5) ELSE coalesce(a, 0.5) END QUALIFY row_number() OVER (PARTITION BY cid ORDER BY p DESC, sid) = 1),
f AS (SELECT country, round(avg(coalesce(c, 0)), 6) AS links_per_s1, round(avg(CAST(c IS NULL AS INT)), 6) AS empty_rate FROM s1 LEFT JOIN (SELECT sid, count(*) AS c FROM kept GROUP BY sid) ON sid = entity_id GROUP BY country)
SELECT f.country, links_per_s1, empty_rate, round(abs(links_per_s1 - CAST(l AS DOUBLE)), 6) AS links_off, round(abs(empty_rate - CAST(e AS DOUBLE)), 6) AS empty_off FROM f LEFT JOIN goal ON goal.country = f.country"""))
def cache_figures(spark, d):
    e = _ents(spark, d)
    cached = universe.cache(resolution.candidates(e), new_path(spark, "cache"))
    table = universe.thresholds(spark, {None: (0.5, 0.5), "US": (0.6, 0.7), "France": (0.55, 0.6)})
    targets = spark.createDataFrame([("US", 3.4591, 0.0558), ("India", 3.4645, 0.0559)], "country string, links_per_s1 double, empty_rate double")
    return decisions.cache_figures(cached, e.where("entity_id LIKE 'S1-%'"), table, targets)


@query(_with(_RANKED, "SELECT entity_id AS source1_entity_id, coalesce(string_agg(cid, ',' ORDER BY p DESC, cid), '') AS candidate_entity_ids FROM s1 LEFT JOIN ranked ON sid = entity_id GROUP BY entity_id"))
def candidate_lists(spark, d):
    e, _, s1, q = _parts(spark, d)
    return src.match_lists(s1, q, "candidate_entity_ids")
