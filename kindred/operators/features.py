"""Pair, group and reverse-context features over blocked pairs with the fields of both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as sim

# The names of the 43 features and their order.
SIMILARITIES = ["n_ratio", "n_partial", "n_tsort", "n_tset", "n_wratio", "a_ratio", "a_partial", "a_tsort", "a_tset"]
EXACT = ["num_overlap", "num_match", "num_conflict", "zip_match", "zip_conflict", "addr_missing", "legal_match", "legal_conflict", "name_exact", "brand_len", "word_cnt", "has_translit"]
BASE = [*SIMILARITIES, "max_sim", "comb_sim", "dual_high", *EXACT]
CONTEXT = ["strict_num_conflict", "num_missing_one_side", "rank_comb", "rank_name", "gap_comb", "gap_name", "z_comb", "n_cands", "n_s2", "n_s3", "rank_within_src", "agree_max_other", "agree_mean_other", "count_sim_gt_90", "cand_s1_count", "is_mutual_best", "gap_to_second_s1", "s1_addr_missing", "c_addr_missing"]
FEATURES = [*BASE, *CONTEXT]


def similarities(p: DataFrame) -> DataFrame:
    two = F.col("s_has_addr") & F.col("c_has_addr")
    short = {"ratio": "ratio", "partial": "partial", "token_sort": "tsort", "token_set": "tset", "w_ratio": "wratio"}
    pick = lambda side, names: {f"{side}_{short[k]}": F.col(f"__{side}")[k] / 100 for k in names}
    name, addr = pick("n", short), {k: F.when(two, v).otherwise(0.0) for k, v in pick("a", list(short)[:4]).items()}
    p = p.withColumns({"__n": sim.sim_all("s_brand", "c_brand"), "__a": sim.sim_all(F.when(two, F.col("s_addr")), F.when(two, F.col("c_addr")))})
    return p.withColumns(name | addr).drop("__n", "__a").withColumns(
        {
            "max_sim": F.greatest("n_tset", "a_tset"),
            "comb_sim": 0.6 * F.col("n_tset") + 0.4 * F.col("a_tset"),
            "dual_high": ((F.col("n_tset") >= 0.6) & (F.col("a_tset") >= 0.5)).cast("int"),
        }
    )


def exact(p: DataFrame) -> DataFrame:
    """The features that need no string similarity."""
    s, c = (lambda x: F.col(f"s_{x}")), (lambda x: F.col(f"c_{x}"))
    flag = lambda x: x.cast("int")
    both = lambda x: (s(x) != "") & (c(x) != "")
    two_nums = (F.size(s("nums")) > 0) & (F.size(c("nums")) > 0)
    allowed = (s("legal") == "pvtltd") & c("legal").isin("ltd", "inc", "corp")
    words = lambda x: F.when(x == "", 0).otherwise(F.size(F.split(x, " ")))
    return p.withColumns(
        {
            "num_overlap": F.size(F.array_intersect(s("nums"), c("nums"))) / F.greatest(F.size(s("nums")), F.size(c("nums")), F.lit(1)),
            "num_match": flag(F.arrays_overlap(s("nums"), c("nums"))),
            "num_conflict": flag(two_nums & ~F.arrays_overlap(s("nums"), c("nums"))),
            "zip_match": flag(both("zip") & (s("zip") == c("zip"))),
            "zip_conflict": flag(both("zip") & (s("zip") != c("zip"))),
            "addr_missing": flag(~s("has_addr") | ~c("has_addr")),
            "legal_match": flag(both("legal") & (s("legal") == c("legal"))),
            "legal_conflict": flag(both("legal") & (s("legal") != c("legal")) & ~allowed),
            "name_exact": flag(both("brand") & (s("brand") == c("brand"))),
            "brand_len": F.least(F.length(s("brand")), F.length(c("brand"))) / 30,
            "word_cnt": F.least(words(s("brand")), words(c("brand"))) / 5,
            "has_translit": flag(s("is_translit") | c("is_translit")),
        }
    )


def group_context(p: DataFrame, comb: str = "comb_sim", name: str = "n_tsort") -> DataFrame:
    """Ranks, gaps, z-score and counts of a candidate among its S1's. Ties by cid."""
    sid, src = Window.partitionBy("sid"), Window.partitionBy("sid", "c_src")
    place = lambda w, x: F.row_number().over(w.orderBy(F.desc(x), "cid")) - 1
    return p.withColumns(
        {
            "rank_comb": place(sid, comb), "rank_name": place(sid, name), "rank_within_src": place(src, comb),
            "gap_comb": F.max(comb).over(sid) - F.col(comb), "gap_name": F.max(name).over(sid) - F.col(name),
            "z_comb": (F.col(comb) - F.avg(comb).over(sid)) / (F.stddev_pop(comb).over(sid) + 1e-5),
            "n_cands": F.count("*").over(sid), "n_s2": F.count_if(F.col("c_src") == "S2").over(sid), "n_s3": F.count_if(F.col("c_src") == "S3").over(sid),
        }
    )


def agreement(p: DataFrame) -> DataFrame:
    """sid, cid, agree_max_other, agree_mean_other, count_sim_gt_90: a candidate against the others of its S1,
    at most k squared rows each, for k candidates. Both similarities are the same either way round, so each two
    candidates are compared once."""
    a = p.select("sid", "cid", "c_src", "c_brand")
    b = p.select("sid", F.col("cid").alias("o_cid"), F.col("c_src").alias("o_src"), F.col("c_brand").alias("o_brand"))
    pairs = a.join(b, "sid").where("cid < o_cid")
    near = F.when((F.col("c_brand") == "") | (F.col("o_brand") == ""), 0.0).otherwise(sim.sim_token_set("c_brand", "o_brand") / 100)
    pairs = pairs.withColumns({"near": near, "alike": sim.sim_token_sort("c_brand", "o_brand") >= 90, "other": F.col("c_src") != F.col("o_src")})
    pairs = pairs.select("sid", F.explode(F.array("cid", "o_cid")).alias("cid"), "near", "alike", "other")
    got = pairs.groupBy("sid", "cid").agg(F.max(F.when(F.col("other"), F.col("near"))).alias("m"), F.avg(F.when(F.col("other"), F.col("near"))).alias("a"), F.count_if("alike").alias("n"))
    return p.select("sid", "cid").join(got, ["sid", "cid"], "left").select("sid", "cid", F.coalesce("m", F.lit(0.0)).alias("agree_max_other"), F.coalesce("a", F.lit(0.0)).alias("agree_mean_other"), F.coalesce("n", F.lit(0)).alias("count_sim_gt_90"))


def reverse_context(p: DataFrame, score: str = "comb_sim") -> DataFrame:
    """How many S1 claim the candidate, whether this is the best claim, and the gap to the next. Ties by sid."""
    cid = Window.partitionBy("cid")
    order = cid.orderBy(F.desc(score), "sid")
    best, n = F.max(score).over(cid), F.count("*").over(cid)
    p = p.withColumns({"__kd_place": F.row_number().over(order), "__kd_next": F.nth_value(score, 2).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    return p.withColumns(
        {
            "cand_s1_count": n,
            "is_mutual_best": (F.col("__kd_place") == 1).cast("int"),
            "gap_to_second_s1": F.when(n == 1, F.lit(1.0)).when(F.col("__kd_place") == 1, F.col(score) - F.col("__kd_next")).otherwise(F.col(score) - best),
        }
    ).drop("__kd_place", "__kd_next")


def flags(p: DataFrame) -> DataFrame:
    """What sides lack, and conflicts of numbers where names are not alike."""
    return p.withColumns(
        {
            "strict_num_conflict": ((F.col("num_conflict") == 1) & (F.col("n_tsort") < 0.8)).cast("int"),
            "num_missing_one_side": ((F.size("s_nums") > 0) != (F.size("c_nums") > 0)).cast("int"),
            "s1_addr_missing": (~F.col("s_has_addr")).cast("int"), "c_addr_missing": (~F.col("c_has_addr")).cast("int"),
        }
    )


def vector(p: DataFrame) -> DataFrame:
    """sid, cid, c_src, country and the 43 features in their fixed order."""
    p = flags(reverse_context(group_context(exact(similarities(p)))))
    return p.join(agreement(p), ["sid", "cid"]).select("sid", "cid", "c_src", "country", *(F.col(f).cast("double").alias(f) for f in FEATURES))

