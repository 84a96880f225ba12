"""Candidate generation: an inverted index is an equi-join on (country, family, key)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import ADDR_STOP, FAMILIES, MAX_POSTINGS, NAME_STOP, TOP_K
from ..functions.similarity import sim_token_set
from ..functions.text import char_grams, skeleton

def _join(*parts: Column) -> Column:
    return F.concat_ws("|", *parts)


def _pairs(words: Column) -> Column:
    n = F.size(words)
    index = F.when(n > 1, F.sequence(F.lit(0), n - 2)).otherwise(F.array().cast("array<int>"))
    return F.flatten(F.transform(index, lambda i: F.transform(F.slice(words, i + 2, n), lambda w: _join(F.least(F.get(words, i), w), F.greatest(F.get(words, i), w)))))


def keys(silver: DataFrame) -> DataFrame:
    """entity_id, src, country, family, key: all emissions of the thirteen families, repeats included."""
    stop = lambda words, w: ~w.isin(*words)
    df = silver.withColumns(
        {
            "T": F.filter(F.split("brand", " "), lambda w: (F.length(w) >= 3) & stop(NAME_STOP, w)),
            "H": F.filter(F.split("brand", " "), lambda w: (F.length(w) == 2) & stop(NAME_STOP, w)),
            "W": F.filter("words", lambda w: stop(ADDR_STOP, w)),
        }
    )
    t, h, w, n, z = (F.col(c) for c in ("T", "H", "W", "nums", "zip"))
    t0, h0, none = F.get(t, F.lit(0)), F.get(h, F.lit(0)), F.array().cast("array<string>")
    some = lambda ok, xs: F.when(ok, xs).otherwise(none)
    has_z = z != ""
    cross = lambda xs, ys: F.flatten(F.transform(xs, lambda x: F.transform(ys, lambda y: _join(x, y))))
    with_z = lambda xs: some(has_z, F.transform(xs, lambda x: _join(z, x)))
    of = {
        "tok": t,
        "bi": F.transform(F.filter(F.arrays_zip(t.alias("a"), F.slice(t, 2, F.greatest(F.size(t), F.lit(1))).alias("b")), lambda x: x["b"].isNotNull()), lambda x: F.concat(x["a"], F.lit("_"), x["b"])),
        "pref4": some(F.length(t0) >= 4, F.array(F.substring(t0, 1, 4))),
        "addr_tok": F.filter(F.slice(w, 1, 4), lambda x: F.length(x) >= 4),
        "addr_pair": _pairs(F.slice(w, 1, 4)),
        "zip_num": with_z(F.slice(n, 1, 3)),
        "sn_w": cross(F.slice(n, 1, 2), F.slice(w, 1, 4)),
        "zip_w": with_z(F.slice(w, 1, 3)),
        "st_zip": some(has_z & h0.isNotNull(), F.array(_join(h0, z))),
        "st_sn": some(h0.isNotNull(), F.transform(F.slice(n, 1, 2), lambda x: _join(h0, x))),
        "bn_sn": some(t0.isNotNull(), F.transform(F.slice(n, 1, 2), lambda x: _join(t0, x))),
        "bn_zip": some(has_z & t0.isNotNull(), F.array(_join(t0, z))),
        "skel": F.filter(F.array(skeleton(t0)), lambda x: x.isNotNull()),
    }
    rows = F.concat(*(tagged(f, of[f]) for f in FAMILIES))
    return df.select("entity_id", "src", "country", F.explode(rows).alias("r")).select("entity_id", "src", "country", "r.family", "r.key")


def gram_keys(silver: DataFrame) -> DataFrame:
    """Like keys(): the family of character 3- and 4-grams of the brand, all of them."""
    return silver.select("entity_id", "src", "country", F.lit("char34").alias("family"), F.explode(char_grams(F.col("brand"))).alias("key"))


def tagged(family: str, values: Column) -> Column:
    return F.transform(values, lambda k: F.struct(F.lit(family).alias("family"), k.alias("key")))


def postings(pool_keys: DataFrame, most: int = MAX_POSTINGS) -> DataFrame:
    """country, family, key, cid of the keys that the pool holds at most `most` times, repeats counted. The cap is
    the method's own: over-frequent keys link nothing. It bounds every join group on the pool's side."""
    rare = pool_keys.groupBy("country", "family", "key").agg(F.count("*").alias("n")).where(F.col("n") <= most).drop("n")
    return pool_keys.join(rare, ["country", "family", "key"]).select("country", "family", "key", F.col("entity_id").alias("cid"))


def probe(asked_keys: DataFrame, held: DataFrame) -> DataFrame:
    """sid, cid, family: pairs of the asked S1 with postings."""
    asked = asked_keys.select("country", "family", "key", F.col("entity_id").alias("sid"))
    return asked.join(held, ["country", "family", "key"]).select("sid", "cid", "family").distinct()


def blocked_pairs(all_keys: DataFrame, most: int = MAX_POSTINGS) -> DataFrame:
    """sid, cid, family: pairs of S1 and pool that share a key which postings() keeps. A null country links nothing."""
    return probe(all_keys.where("src = 'S1'"), postings(all_keys.where("src <> 'S1'"), most))


def truncated_postings(all_keys: DataFrame, most: int = 60) -> DataFrame:
    """The variant that keeps each key's first postings in order of id, and excludes none."""
    first = Window.partitionBy("country", "family", "key").orderBy("entity_id")
    return all_keys.where("src <> 'S1'").withColumn("r", F.row_number().over(first)).where(F.col("r") <= most).drop("r")


def with_sides(pairs: DataFrame, silver: DataFrame) -> DataFrame:
    """Pairs with the fields of both sides, as s_* and c_*."""
    cols = [c for c in silver.columns if c not in ("entity_id", "src", "country")]
    s = silver.where("src = 'S1'").select(F.col("entity_id").alias("sid"), "country", *(F.col(c).alias(f"s_{c}") for c in cols))
    c = silver.where("src <> 'S1'").select(F.col("entity_id").alias("cid"), F.col("src").alias("c_src"), *(F.col(x).alias(f"c_{x}") for x in cols))
    return pairs.join(s, "sid").join(c, "cid")


def overlap_score(p: DataFrame) -> DataFrame:
    """An integer rank from shared words and numbers alone, and a score of 0 to 1: no function leaves the JVM."""
    share = lambda a, b: F.size(F.array_intersect(a, b))
    sb, cb = F.split("s_brand", " "), F.split("c_brand", " ")
    whole = F.greatest(F.size(F.array_union(sb, cb)), F.lit(1))
    rank = 10 * share(sb, cb) + 5 * share(F.col("s_words"), F.col("c_words")) + F.when((F.col("s_zip") != "") & (F.col("s_zip") == F.col("c_zip")), 20).otherwise(0) + F.when(F.arrays_overlap("s_nums", "c_nums"), 10).otherwise(0)
    jac = share(sb, cb) / whole
    addr = share(F.col("s_words"), F.col("c_words")) / F.greatest(F.size(F.array_union("s_words", "c_words")), F.lit(1))
    num = F.when(F.arrays_overlap("s_nums", "c_nums"), 1.0).otherwise(0.0)
    return p.withColumns({"rank_score": rank, "p": F.round(0.6 * jac + 0.2 * addr + 0.2 * num, 6)})


def composite_score(p: DataFrame) -> DataFrame:
    """The rank score from token-set similarities, 0 to 100, with bonuses for agreement."""
    p = p.withColumns({"n_tset": sim_token_set("s_brand", "c_brand"), "a_tset": F.when(F.col("s_has_addr") & F.col("c_has_addr"), sim_token_set("s_addr", "c_addr")).otherwise(0.0)})
    both = F.when((F.col("n_tset") >= 50) & (F.col("a_tset") >= 40), 20).otherwise(0)
    anchor = F.when(((F.col("s_zip") != "") & (F.col("s_zip") == F.col("c_zip"))) | F.arrays_overlap("s_nums", "c_nums"), 10).otherwise(0)
    return p.withColumn("rank_score", F.greatest("n_tset", "a_tset", F.floor(0.6 * F.col("n_tset") + 0.4 * F.col("a_tset")).cast("double")) + both + anchor)


def top_k(scored: DataFrame, k: int = TOP_K) -> DataFrame:
    best = Window.partitionBy("sid").orderBy(F.desc("rank_score"), "cid")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def blocking_quality(cands: DataFrame, links: DataFrame, s1: DataFrame) -> DataFrame:
    """Pair recall, share of S1 with all their links, and candidates for each S1."""
    hit = links.join(cands.select(F.col("sid").alias("s1id"), "cid", F.lit(1).alias("hit")), ["s1id", "cid"], "left")
    per = hit.groupBy("s1id").agg(F.count("*").alias("n"), F.count("hit").alias("h"))
    sizes = s1.select(F.col("entity_id").alias("s1id")).join(cands.groupBy(F.col("sid").alias("s1id")).agg(F.count("*").alias("c")), "s1id", "left").select(F.coalesce("c", F.lit(0)).alias("c"))
    a = per.agg(F.round(F.sum("h") / F.sum("n"), 6).alias("pair_recall"), F.round(F.avg((F.col("h") == F.col("n")).cast("int")), 6).alias("entity_recall"))
    b = sizes.agg(F.round(F.avg("c"), 6).alias("mean_cands"), F.percentile("c", F.lit(0.5)).alias("median_cands"), F.round(F.percentile("c", F.lit(0.95)), 6).alias("p95_cands"))
    return a.crossJoin(b)  # two rows of figures


def marginal_recall(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """For each family in order: links it finds, links no earlier one finds, and the running sum."""
    order = F.array(*map(F.lit, FAMILIES))
    hits = pairs.join(links, (pairs["sid"] == links["s1id"]) & (pairs["cid"] == links["cid"])).select("sid", pairs["cid"], F.array_position(order, F.col("family")).cast("int").alias("f"))
    direct = hits.groupBy("f").agg(F.count("*").alias("direct"))
    new = hits.groupBy("sid", "cid").agg(F.min("f").alias("f")).groupBy("f").agg(F.count("*").alias("new"))
    base = hits.sparkSession.createDataFrame([(k + 1, f) for k, f in enumerate(FAMILIES)], "f int, family string")
    out = base.join(direct, "f", "left").join(new, "f", "left").na.fill(0)
    return out.withColumn("cumulative", F.sum("new").over(Window.partitionBy(F.lit(1)).orderBy("f"))).drop("f")  # thirteen rows


def retention(ranked: DataFrame, links: DataFrame) -> DataFrame:
    """Links kept by the first k candidates, for each k of the curve."""
    hits = ranked.join(links.select(F.col("s1id").alias("sid"), "cid"), ["sid", "cid"])
    ks = (3, 5, 7, 8, 10, 12, 15)
    one = hits.agg(*(F.count_if(F.col("rank") <= k).alias(str(k)) for k in ks))
    return one.select(F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col(str(k)).alias("kept")) for k in ks))).alias("r")).select("r.k", "r.kept")


def least_k(ranked: DataFrame, links: DataFrame, share: float = 0.995, default: int = 15) -> DataFrame:
    """k: the least of the curve that keeps so large a share of the links that any candidate has; else default."""
    total = ranked.join(links.select(F.col("s1id").alias("sid"), "cid"), ["sid", "cid"]).agg(F.count("*").alias("total"))
    return retention(ranked, links).crossJoin(total).agg(F.coalesce(F.min(F.when(F.col("kept") >= share * F.col("total"), F.col("k"))), F.lit(default)).alias("k"))


def country_stats(cands: DataFrame, s1: DataFrame) -> DataFrame:
    n = cands.groupBy("sid").agg(F.count("*").alias("c"))
    each = s1.select(F.col("entity_id").alias("sid"), "country").join(n, "sid", "left").na.fill(0, ["c"])
    return each.groupBy("country").agg(F.count("*").alias("s1"), F.sum("c").alias("pairs"), F.round(F.avg("c"), 6).alias("mean_cands"), F.count_if(F.col("c") == 0).alias("without"))
