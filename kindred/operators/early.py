"""The first generations' path: keys and features from raw normalised text, owners by raw-text scores, and the
pruning of long match lists. Kept as operators of their own beside the main path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..functions import text
from ..functions.constants import ADDR_STOP, NAME_STOP
from .blocking import tagged

#: An S1 with at least so many matches is pruned.
MANY = 4


def raw_text(entities: DataFrame) -> DataFrame:
    """entity_id, src, country, name, addr (normalised, with domains cut from names), tokens, short (words of
    two letters), nums (all numbers of the address, in order), zip, street_nums (in order, repeats stay), words.
    A null name or address is the empty text; stop words and words under three letters are no tokens."""
    spaced = lambda c: F.filter(F.split(F.regexp_replace(c, "[^\\p{L}\\p{N}_\\s]", " "), "\\s+"), lambda w: w != "")
    df = entities.select("entity_id", F.substring("entity_id", 1, 2).alias("src"), "country", text.normalize_text(F.col("business_name"), domains=True, business=False).alias("name"), text.normalize_text(F.col("business_address")).alias("addr"))
    df = df.withColumns({"__n": spaced(F.col("name")), "__a": spaced(F.col("addr")), "nums": F.regexp_extract_all("addr", F.lit("(?U)\\b\\d+\\b"), F.lit(0))})
    df = df.withColumn("zip", F.coalesce(F.get(F.filter("nums", lambda n: F.length(n).isin(5, 6)), 0), F.lit("")))
    return df.select(
        "entity_id", "src", "country", "name", "addr",
        F.filter("__n", lambda w: (F.length(w) >= 3) & ~w.isin(*NAME_STOP)).alias("tokens"), F.filter("__n", lambda w: (F.length(w) == 2) & ~w.isin(*NAME_STOP)).alias("short"),
        "nums", "zip", F.filter("nums", lambda n: (n != F.col("zip")) & (F.length(n) <= 5)).alias("street_nums"),
        F.filter("__a", lambda w: (F.length(w) >= 3) & ~w.rlike("^\\p{Nd}+$") & ~w.isin(*ADDR_STOP)).alias("words"),
    )


def keys_v0(raw: DataFrame) -> DataFrame:
    """entity_id, src, country, family, key of the ten first families; repeats stay. They go through
    blocking.blocked_pairs() like the others."""
    t, h, w, n, z = (F.col(c) for c in ("tokens", "short", "words", "street_nums", "zip"))
    none = F.array().cast("array<string>")
    some = lambda ok, xs: F.when(ok, xs).otherwise(none)
    join = lambda *xs: F.concat_ws("|", *xs)
    first = F.slice(w, 1, 4)
    index = F.when(F.size(first) > 1, F.sequence(F.lit(0), F.size(first) - 2)).otherwise(F.array().cast("array<int>"))
    pairs = F.flatten(F.transform(index, lambda i: F.transform(F.slice(first, i + 2, F.size(first)), lambda x: join(F.least(F.get(first, i), x), F.greatest(F.get(first, i), x)))))
    adjacent = F.when(F.size(t) > 1, F.transform(F.sequence(F.lit(1), F.size(t) - 1), lambda i: F.concat(F.get(t, i - 1), F.lit("_"), F.get(t, i)))).otherwise(none)
    h0 = F.get(h, F.lit(0))
    of = {
        "tok": t,
        "bi": adjacent,
        "pref4": some(F.length(F.get(t, F.lit(0))) >= 4, F.array(F.substring(F.get(t, F.lit(0)), 1, 4))),
        "addr_tok": F.filter(first, lambda x: F.length(x) >= 4),
        "zip_num": some(z != "", F.transform(F.slice(n, 1, 3), lambda x: join(z, x))),
        "sn_w": F.flatten(F.transform(F.slice(n, 1, 2), lambda x: F.transform(first, lambda y: join(x, y)))),
        "zip_w": some(z != "", F.transform(F.slice(w, 1, 3), lambda x: join(z, x))),
        "addr_pair": pairs,
        "st_zip": some((z != "") & h0.isNotNull(), F.array(join(h0, z))),
        "st_sn": some(h0.isNotNull(), F.transform(F.slice(n, 1, 2), lambda x: join(h0, x))),
    }
    rows = F.concat(*(tagged(f, v) for f, v in of.items()))
    return raw.select("entity_id", "src", "country", F.explode(rows).alias("r")).select("entity_id", "src", "country", "r.family", "r.key")


def with_raw(pairs: DataFrame, entities: DataFrame) -> DataFrame:
    """pairs (sid, cid, ...) with both sides' lower-cased raw texts; null ones are empty."""
    lower = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    side = lambda key, p: entities.select(F.col("entity_id").alias(key), lower("business_name").alias(f"{p}_raw_name"), lower("business_address").alias(f"{p}_raw_addr"))
    return pairs.join(side("sid", "s"), "sid").join(side("cid", "c"), "cid")


def raw_score(p: DataFrame, col: str = "sc") -> DataFrame:
    """0.6 of the names' and 0.4 of the addresses' token-set similarity on raw text, 0 to 100; an empty address on
    either side adds nothing."""
    both = (F.col("s_raw_addr") != "") & (F.col("c_raw_addr") != "")
    addr = F.when(both, sim.sim_token_set(F.when(both, F.col("s_raw_addr")), F.when(both, F.col("c_raw_addr")))).otherwise(0.0)
    return p.withColumn(col, 0.6 * sim.sim_token_set("s_raw_name", "c_raw_name") + 0.4 * addr)


def raw_number_conflict() -> Column:
    """Both addresses have numbers of at most five digits, leading zeros aside, none in common, and the names
    are not alike (token sort under 80)."""
    a, b = text.extract_nums(F.col("s_raw_addr")), text.extract_nums(F.col("c_raw_addr"))
    return (F.size(a) > 0) & (F.size(b) > 0) & ~F.arrays_overlap(a, b) & (sim.sim_token_sort("s_raw_name", "c_raw_name") < 80)


def pruned(p: DataFrame, most: int = 3, many: int = MANY) -> DataFrame:
    """p (with raw texts and sc): of S1 with at least `many` matches, those without a number conflict, and of them
    the best `most` of each source by sc, then cid. Other S1 keep all."""
    n = F.count("*").over(Window.partitionBy("sid"))
    q = p.withColumn("__kd_many", n >= many)
    q = q.where(~(F.col("__kd_many") & raw_number_conflict()))
    place = F.row_number().over(Window.partitionBy("sid", F.substring("cid", 1, 2)).orderBy(F.desc("sc"), "cid"))
    return q.withColumn("__kd_place", place).where(~F.col("__kd_many") | (F.col("__kd_place") <= most)).drop("__kd_many", "__kd_place")


def features_v0(pairs: DataFrame, raw: DataFrame) -> DataFrame:
    """sid, cid and the nineteen first features of pairs, on raw normalised text: nine similarities, their best,
    mix and both-high flag, shared numbers, equal zips, the names' difference in length, and the source."""
    # Names and order of the nineteen.
    names = ["n_ratio", "n_partial", "n_tsort", "n_tset", "n_wratio", "a_ratio", "a_partial", "a_tsort", "a_tset"]
    cols = ("name", "addr", "nums", "zip")
    side = lambda key, p: raw.select(F.col("entity_id").alias(key), *(F.col(c).alias(f"{p}_{c}") for c in cols))
    q = pairs.select("sid", "cid").join(side("sid", "s"), "sid").join(side("cid", "c"), "cid")
    both = (F.col("s_addr") != "") & (F.col("c_addr") != "")
    q = q.withColumns({"__n": sim.sim_all("s_name", "c_name"), "__a": sim.sim_all(F.when(both, F.col("s_addr")), F.when(both, F.col("c_addr")))})
    of = ["ratio", "partial", "token_sort", "token_set", "w_ratio"]
    q = q.withColumns({k: F.col("__n")[x] / 100 for k, x in zip(names[:5], of)} | {k: F.when(both, F.col("__a")[x] / 100).otherwise(0.0) for k, x in zip(names[5:], of)})
    s, c = F.array_distinct("s_nums"), F.array_distinct("c_nums")
    two, common = (F.size(s) > 0) & (F.size(c) > 0), F.size(F.array_intersect(s, c))
    flag = lambda x: F.coalesce(x, F.lit(False)).cast("int")
    return q.select(
        "sid", "cid", *names, F.greatest("n_tset", "a_tset").alias("max_sim"), (0.6 * F.col("n_tset") + 0.4 * F.col("a_tset")).alias("comb_sim"),
        flag((F.col("n_tset") >= 0.6) & (F.col("a_tset") >= 0.5)).alias("dual_high"), F.when(two, common / F.greatest(F.size(s), F.size(c))).otherwise(0.0).alias("num_overlap_ratio"),
        flag(two & (F.array_sort(s) == F.array_sort(c))).alias("exact_num_match"), flag(two & (common > 0)).alias("num_match"), flag((F.col("s_zip") != "") & (F.col("s_zip") == F.col("c_zip"))).alias("zip_match"),
        (F.abs(F.length("s_name") - F.length("c_name")) / F.greatest(F.length("s_name"), F.length("c_name"), F.lit(1))).alias("len_diff_ratio"),
        flag(F.col("cid").startswith("S2-")).alias("is_s2"), flag(F.col("cid").startswith("S3-")).alias("is_s3"),
    )
