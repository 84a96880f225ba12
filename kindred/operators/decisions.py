"""Gates, thresholds, exclusivity, caps and metrics over scored pairs (sid, cid, p)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a table of thresholds up to which it is broadcast.
MOST_BROADCAST = 100_000
#: Thresholds of each source that a matcher's are chosen from: 0.30 to 0.95 by 0.025.
GRID = [round(0.3 + 0.025 * k, 3) for k in range(27)]


def precision_gate(threshold: float) -> Column:
    """The first rule that rejects a pair, 1 to 6, or 0. Needs the features and p. The figures are fixed values."""
    n, a = F.col("n_tset"), F.col("a_tset")
    allowed = (F.col("s_legal") == "pvtltd") & F.col("c_legal").isin("ltd", "inc", "corp")
    legal = (F.col("s_legal") != "") & (F.col("c_legal") != "") & (F.col("s_legal") != F.col("c_legal")) & ~allowed
    rules = [
        (F.col("num_conflict") == 1) & (a < 0.60) & (n < 0.85),
        (F.col("zip_conflict") == 1) & (a < 0.50) & (n < 0.85),
        legal & (a < 0.70) & (n < 0.85),
        (F.col("addr_missing") == 1) & (n < 0.80),
        (F.col("has_translit") == 0) & (n < 0.35) & (a < 0.90),
        F.col("p") < threshold,
    ]
    return F.coalesce(*(F.when(r, k + 1) for k, r in enumerate(rules)), F.lit(0))


def number_veto(p: DataFrame) -> DataFrame:
    """Pairs without those whose numbers disagree and whose names are not alike."""
    return p.where(~((F.col("num_conflict") == 1) & (F.col("n_tsort") < 0.8)))


def above(p: DataFrame, th_s2: float, th_s3: float, seen: tuple[str, ...] = (), offset: float = 0.0) -> DataFrame:
    """Thresholds by source, raised for countries that training did not see."""
    th = F.when(F.col("cid").startswith("S3-"), th_s3).otherwise(th_s2)
    if offset:
        th = th + F.when(F.col("country").isin(*seen), 0.0).otherwise(offset)
    return p.where(F.col("p") >= th)


def above_table(p: DataFrame, table: DataFrame) -> DataFrame:
    """Thresholds (country, th_s2, th_s3) by country, one row each; the row with a null country is for all others,
    null ones included. A pair with neither has no threshold and goes. The table is broadcast if it is small."""
    t = table.where("country IS NOT NULL")
    t = F.broadcast(t) if t.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else t
    rest = table.where("country IS NULL").agg(F.first("th_s2").alias("d2"), F.first("th_s3").alias("d3"))  # one row, of nulls if there is none
    q = p.join(t, "country", "left").crossJoin(F.broadcast(rest))
    th = F.when(F.col("cid").startswith("S3-"), F.coalesce("th_s3", "d3")).otherwise(F.coalesce("th_s2", "d2"))
    return q.where(F.col("p") >= th).select(*p.columns)


def exclusive(p: DataFrame, score: str = "p") -> DataFrame:
    """Each candidate goes to its best claim; ties to the smaller sid. Filter by threshold before: all
    claims of a candidate share its threshold. Null scores lose to all others; an empty table gives none."""
    best = Window.partitionBy("cid").orderBy(F.desc_nulls_last(score), "sid")
    return p.withColumn("__kd_place", F.row_number().over(best)).where("__kd_place = 1").drop("__kd_place")


def cap_per_source(p: DataFrame, most: int = 3, score: str = "p") -> DataFrame:
    """The best `most` candidates of each source for each S1, by score, then cid; null scores last."""
    best = Window.partitionBy("sid", F.substring("cid", 1, 2)).orderBy(F.desc_nulls_last(score), "cid")
    return p.withColumn("__kd_place", F.row_number().over(best)).where(F.col("__kd_place") <= most).drop("__kd_place")


def per_s1(pred: DataFrame, links: DataFrame, s1: DataFrame) -> DataFrame:
    """sid, country, npred, ntrue, tp of every S1; blocking misses count through ntrue."""
    got = pred.select("sid", "cid").join(links.select(F.col("s1id").alias("sid"), "cid", F.lit(1).alias("y")), ["sid", "cid"], "left")
    a = got.groupBy("sid").agg(F.count("*").alias("npred"), F.count("y").alias("tp"))
    b = links.groupBy(F.col("s1id").alias("sid")).agg(F.count("*").alias("ntrue"))
    return s1.select(F.col("entity_id").alias("sid"), "country").join(a, "sid", "left").join(b, "sid", "left").na.fill(0, ["npred", "tp", "ntrue"])


def f05(tp: Column, npred: Column, ntrue: Column) -> Column:
    """1.25PR / (0.25P + R) = 1.25 tp / (0.25 ntrue + npred); both empty 1, one empty 0."""
    return F.when((npred == 0) & (ntrue == 0), 1.0).when((npred == 0) | (ntrue == 0), 0.0).otherwise(1.25 * tp / (0.25 * ntrue + npred))


def macro_f05(counts: DataFrame) -> DataFrame:
    """One row; null if counts has none."""
    return counts.agg(F.round(F.avg(f05(F.col("tp"), F.col("npred"), F.col("ntrue"))), 6).alias("macro_f05"))


def f05_by_country(counts: DataFrame, name: str) -> DataFrame:
    return counts.groupBy("country").agg(F.round(F.avg(f05(F.col("tp"), F.col("npred"), F.col("ntrue"))), 6).alias(name))


def breakdown(counts: DataFrame) -> DataFrame:
    """For all (country *, k -1), by country (k -1) and by number of true links (k 0 to 6, 6 for more): S1, macro
    F0.5, mean precision and recall (both 1 where nothing is true or predicted; 0 and 1 where nothing is true;
    both 0 where nothing is predicted), micro precision and recall, mean predictions, and singleton accuracy,
    the share without predictions among S1 without true links. A null country is a country like any other."""
    tp, npred, ntrue = F.col("tp"), F.col("npred"), F.col("ntrue")
    p = F.when(npred > 0, tp / npred).when(ntrue == 0, 1.0).otherwise(0.0)
    r = F.when(ntrue > 0, tp / ntrue).otherwise(1.0)
    c = counts.withColumns({"f": f05(tp, npred, ntrue), "mp": p, "mr": r, "k": F.least(ntrue, F.lit(6)).cast("long")})
    got = c.groupingSets([[], [F.col("country")], [F.col("k")]], F.col("country"), F.col("k")).agg(
        F.grouping("country").alias("all_c"), F.grouping("k").alias("all_k"), F.count("*").alias("n"), F.round(F.avg("f"), 6).alias("f05"),
        F.round(F.avg("mp"), 6).alias("mean_precision"), F.round(F.avg("mr"), 6).alias("mean_recall"),
        F.round(F.sum("tp") / F.greatest(F.sum("npred"), F.lit(1)), 6).alias("precision"), F.round(F.sum("tp") / F.greatest(F.sum("ntrue"), F.lit(1)), 6).alias("recall"),
        F.round(F.avg("npred"), 6).alias("mean_preds"), F.round(F.avg(F.when(ntrue == 0, (npred == 0).cast("int"))), 6).alias("singleton_accuracy"),
    )
    named = {"country": F.when(F.col("all_c") == 1, "*").otherwise(F.col("country")), "k": F.when(F.col("all_k") == 1, -1).otherwise(F.col("k"))}
    return got.withColumns(named).drop("all_c", "all_k")


def source_f05(pred: DataFrame, links: DataFrame, s1: DataFrame, src: str) -> DataFrame:
    own = lambda d: d.where(F.col("cid").startswith(f"{src}-"))
    return macro_f05(per_s1(own(pred), own(links), s1)).select(F.lit(src).alias("src"), "macro_f05")


def threshold_grid(p: DataFrame, links: DataFrame, s1: DataFrame, steps: list[float]) -> DataFrame:
    """threshold, macro F0.5 of all pairs from it on."""
    y = p.join(links.select(F.col("s1id").alias("sid"), "cid", F.lit(1).alias("y")), ["sid", "cid"], "left")
    grid = p.sparkSession.createDataFrame([(t,) for t in steps], "threshold double")
    per = y.crossJoin(F.broadcast(grid)).where("p >= threshold").groupBy("threshold", "sid").agg(F.count("*").alias("npred"), F.count("y").alias("tp"))
    return _grid(per, grid, links, s1, ["threshold"])


def source_grid(p: DataFrame, links: DataFrame, s1: DataFrame, steps: list[float]) -> DataFrame:
    """th_s2, th_s3, macro F0.5 of exclusive pairs, all combinations of steps."""
    y = p.select("sid", "cid", "p").join(links.select(F.col("s1id").alias("sid"), "cid", F.lit(1).alias("y")), ["sid", "cid"], "left")
    # a pair counts from a step down: pairs are counted by S1, source and highest step that they reach, and only
    # those few counts meet the grid
    order = sorted(set(steps))
    high = F.size(F.filter(F.array(*map(F.lit, order)), lambda t: F.col("p") >= t))
    by_step = y.select("sid", F.col("cid").startswith("S3-").alias("s3"), high.alias("step"), "y").where("step > 0").groupBy("sid", "s3", "step").agg(F.count("*").alias("npred"), F.count("y").alias("tp"))
    x = F.array_sort(F.collect_list(F.struct("s3", "step", "npred", "tp"))).alias("x")  # two sources by as many steps
    true = links.groupBy(F.col("s1id").alias("sid")).agg(F.count("*").alias("ntrue"))
    counts = by_step.groupBy("sid").agg(x).join(true, "sid", "left").na.fill(0, ["ntrue"])
    alike = counts.groupBy("x", "ntrue").agg(F.count("*").alias("m"))  # S1 whose counts are the same meet the grid once
    total = lambda inside, name: F.aggregate(F.transform(inside, lambda c: c[name]), F.lit(0).cast("long"), lambda s, v: s + v).alias(name)

    def from_step(k: Column, s3: bool) -> Column:
        inside = F.filter("x", lambda c: (c["s3"] == s3) & (c["step"] >= k))
        return F.struct(F.get(F.array(*map(F.lit, order)), k - 1).alias("th"), total(inside, "npred"), total(inside, "tp"))

    each = lambda s3: F.transform(F.sequence(F.lit(1), F.lit(len(order))), lambda k: from_step(k, s3))
    two = alike.select("ntrue", "m", F.explode(each(False)).alias("a"), each(True).alias("b"))
    cells = two.select("ntrue", "m", "a", F.explode("b").alias("b")).select(F.col("a.th").alias("th_s2"), F.col("b.th").alias("th_s3"), (F.col("a.npred") + F.col("b.npred")).alias("npred"), (F.col("a.tp") + F.col("b.tp")).alias("tp"), "ntrue", "m")
    grid = p.sparkSession.createDataFrame([(a, b) for a in order for b in order], "th_s2 double, th_s3 double")
    return _cells(cells.where("npred > 0"), grid, links, s1, ["th_s2", "th_s3"])


def best_cell(grid: DataFrame) -> tuple[float, float]:
    """The first best (th_s2, th_s3) of a source grid."""
    r = grid.orderBy(F.desc("macro_f05"), "th_s2", "th_s3").first()
    return r.th_s2, r.th_s3


def _grid(per: DataFrame, grid: DataFrame, links: DataFrame, s1: DataFrame, by: list[str]) -> DataFrame:
    """S1 without predictions score 1 if they have no link, else 0, so only those with some are counted for
    each cell; the rest comes from two totals."""
    true = links.groupBy(F.col("s1id").alias("sid")).agg(F.count("*").alias("ntrue"))
    some = per.join(true, "sid", "left").na.fill(0, ["ntrue"]).withColumn("m", F.lit(1))
    return _cells(some, grid, links, s1, by)


def _cells(some: DataFrame, grid: DataFrame, links: DataFrame, s1: DataFrame, by: list[str]) -> DataFrame:
    """some: npred, tp and ntrue of m S1 in a cell."""
    true = links.select(F.col("s1id").alias("sid")).distinct().withColumn("ntrue", F.lit(1))
    cell = some.groupBy(*by).agg(F.sum(F.col("m") * f05(F.col("tp"), F.col("npred"), F.col("ntrue"))).alias("f"), F.sum(F.when(F.col("ntrue") == 0, F.col("m")).otherwise(0)).alias("wrong"))
    total = s1.select(F.col("entity_id").alias("sid")).join(true, "sid", "left").agg(F.count("*").alias("n"), F.count_if(F.col("ntrue").isNull()).alias("alone"))
    out = grid.join(cell, by, "left").na.fill(0).crossJoin(F.broadcast(total))
    return out.select(*by, F.round((F.col("f") + F.col("alone") - F.col("wrong")) / F.col("n"), 6).alias("macro_f05"))


def ablations(p: DataFrame, links: DataFrame, s1: DataFrame, th: float, score: str = "p") -> DataFrame:
    """Macro F0.5 with and without exclusivity, number veto and cap: eight rows. p has the features and the
    scores. The gate and the veto come first, so a vetoed claim takes no candidate from its rightful owner; then
    owners are chosen, by score, and then the cap is applied. Of the pairs that pass the gate, the flags of all
    eight are found in one pass, and S1 are counted once."""
    q = p.where(precision_gate(th) == 0).withColumn("veto", (F.col("num_conflict") == 1) & (F.col("n_tsort") < 0.8))
    y = links.select(F.col("s1id").alias("sid"), "cid", F.lit(1).alias("y"))
    q = q.select("sid", "cid", "veto", F.col(score).alias("__kd_score")).join(y, ["sid", "cid"], "left")
    src = F.substring("cid", 1, 2)
    both = []
    for veto in (0, 1):
        kept = q.where("not veto") if veto else q
        owner = F.row_number().over(Window.partitionBy("cid").orderBy(F.desc("__kd_score"), "sid")) == 1
        kept = kept.withColumn("owns", owner)
        for excl in (0, 1):
            won = kept.where("owns") if excl else kept
            place = F.row_number().over(Window.partitionBy("sid", src).orderBy(F.desc("__kd_score"), "cid"))
            both.append(won.withColumn("place", place).select("sid", "place", "y", F.lit(excl).alias("excl"), F.lit(veto).alias("veto")))
    some = reduce(DataFrame.unionByName, both)
    cap = F.explode(F.when(F.col("place") <= 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("cap")
    per = some.select("sid", "y", "excl", "veto", cap).groupBy("excl", "veto", "cap", "sid").agg(F.count("*").alias("npred"), F.count("y").alias("tp"))
    grid = p.sparkSession.createDataFrame([(a, b, c) for a in (0, 1) for b in (0, 1) for c in (0, 1)], "excl int, veto int, cap int")
    return _grid(per, grid, links, s1, ["excl", "veto", "cap"])


def cumulative_tp(p: DataFrame, links: DataFrame) -> DataFrame:
    """sid, cid, place, tp: an S1's candidates by p, then cid, and the true ones among the first so many."""
    y = p.select("sid", "cid", "p").join(links.select(F.col("s1id").alias("sid"), "cid", F.lit(1).alias("y")), ["sid", "cid"], "left")
    order = Window.partitionBy("sid").orderBy(F.desc("p"), "cid")
    return y.select("sid", "cid", F.row_number().over(order).alias("place"), F.count("y").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("tp"))


def top_by_expectation(p: DataFrame, by_kept: bool = True) -> DataFrame:
    """Of each S1, the candidates that expected_f05_k() keeps, by p, then cid."""
    order = Window.partitionBy("sid").orderBy(F.desc("p"), "cid")
    k = p.groupBy("sid").agg(F.reverse(F.array_sort(F.collect_list("p"))).alias("ps")).select("sid", expected_f05_k(F.col("ps"), by_kept).alias("__kd_k"))
    return p.withColumn("__kd_place", F.row_number().over(order)).join(k, "sid").where("__kd_place <= __kd_k").drop("__kd_place", "__kd_k")


def strategies(p: DataFrame, links: DataFrame, s1: DataFrame, steps: list[float] = [0.55, 0.6, 0.65, 0.7, 0.75], by_source: list[float] = [0.6, 0.65, 0.7]) -> DataFrame:
    """strategy, th_s2, th_s3, macro_f05, best: one threshold, one for each source, and the expected-F0.5 top k,
    all with one owner for each candidate. best marks the first of the best, in that order."""
    won = exclusive(p)
    one = threshold_grid(won, links, s1, steps).select(F.lit(1).alias("o"), F.lit("global").alias("strategy"), F.col("threshold").alias("th_s2"), F.col("threshold").alias("th_s3"), "macro_f05")
    two = source_grid(won, links, s1, by_source).select(F.lit(2).alias("o"), F.lit("by_source").alias("strategy"), "th_s2", "th_s3", "macro_f05")
    top = macro_f05(per_s1(exclusive(top_by_expectation(p)), links, s1))
    three = top.select(F.lit(3).alias("o"), F.lit("expected_f05").alias("strategy"), F.lit(None).cast("double").alias("th_s2"), F.lit(None).cast("double").alias("th_s3"), "macro_f05")
    every = one.unionByName(two).unionByName(three)
    first = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("macro_f05"), "o", "th_s2", "th_s3"))  # fifteen rows
    return every.withColumn("best", first == 1).drop("o")


def with_distractors(p: DataFrame, s1: DataFrame, seed: int = 42) -> DataFrame:
    """sid, cid, p with two or three drawn false candidates more for each S1, as a denser pool would have; their
    p is Beta(0.5, 25), a ratio of gamma draws. Their ids begin with DISTRACT-."""
    drawn = s1.select(F.col("entity_id").alias("sid"), F.explode(F.sequence(F.lit(1), F.when(F.rand(seed) < 0.5, 2).otherwise(3))).alias("k"))
    small, large = F.pow(F.randn(seed + 1), 2) / 2, reduce(lambda a, b: a + b, [-F.log(1 - F.rand(seed + 2 + k)) for k in range(25)])
    return p.select("sid", "cid", "p").unionByName(drawn.select("sid", F.concat_ws("-", F.lit("DISTRACT"), "sid", "k").alias("cid"), (small / (small + large)).alias("p")))


def cache_figures(p: DataFrame, s1: DataFrame, table: DataFrame, targets: DataFrame) -> DataFrame:
    """By country, of links by a table of thresholds (see above_table) with one owner for each candidate: links per
    S1, empty rate, and their distance from targets (country, links_per_s1, empty_rate; null without one)."""
    got = prediction_stats(exclusive(above_table(p, table)), s1)
    t = targets.select(F.col("country").alias("t_country"), F.col("links_per_s1").alias("t_links"), F.col("empty_rate").alias("t_empty"))
    off = got.join(t, got["country"].eqNullSafe(t["t_country"]), "left")
    return off.select("country", "links_per_s1", "empty_rate", F.round(F.abs(F.col("links_per_s1") - F.col("t_links")), 6).alias("links_off"), F.round(F.abs(F.col("empty_rate") - F.col("t_empty")), 6).alias("empty_off"))


def expected_f05_k(probs: Column, by_kept: bool = False) -> Column:
    """How many of the candidates, p descending, to keep for the best expected F0.5 (to nine decimals; of equal
    ones the fewest). The number of true ones
    among the rest is Poisson-binomial; its expectation is exact, where one could also draw samples. by_kept: the weight of a quarter goes to the number kept and not
    to the number true, which keeps more."""
    n = F.size(probs)
    one = F.array(F.lit(1.0))

    def spread(ps: Column) -> Column:
        """P(0), P(1), ... true ones among ps."""
        return F.aggregate(ps, one, lambda d, q: F.zip_with(F.concat(d, F.array(F.lit(0.0))), F.concat(F.array(F.lit(0.0)), d), lambda a, b: a * (1 - q) + b * q))

    def value(k: Column) -> Column:
        head, tail = spread(F.slice(probs, 1, k)), spread(F.slice(probs, k + 1, F.greatest(n - k, F.lit(0))))
        cells = F.flatten(F.transform(head, lambda a, i: F.transform(tail, lambda b, j: a * b * 1.25 * i / ((0.25 * k + i + j) if by_kept else (0.25 * (i + j) + k)))))
        return F.aggregate(cells, F.lit(0.0), lambda s, x: s + x)

    none = F.aggregate(probs, F.lit(1.0), lambda s, q: s * (1 - q))
    scores = F.concat(F.array(F.struct(F.round(none, 9).alias("v"), F.lit(0).alias("k"))), F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda k: F.struct(F.round(value(k), 9).alias("v"), (-k).alias("k")))).otherwise(F.array().cast("array<struct<v:double,k:int>>")))
    return -F.array_max(scores)["k"]


def threshold_sweep(p: DataFrame, s1: DataFrame, configs: list[tuple[float, float]], empty_target: float, links_target: float) -> DataFrame:
    """Distance of each configuration's empty rate and links per S1 from their targets, nearest first."""
    grid = p.sparkSession.createDataFrame(configs, "th_s2 double, th_s3 double")
    kept = p.crossJoin(F.broadcast(grid)).where(F.col("p") >= F.when(F.col("cid").startswith("S3-"), F.col("th_s3")).otherwise(F.col("th_s2")))
    best = Window.partitionBy("th_s2", "th_s3", "cid").orderBy(F.desc("p"), "sid")
    won = kept.withColumn("__r", F.row_number().over(best)).where("__r = 1").groupBy("th_s2", "th_s3").agg(F.count("*").alias("links"), F.countDistinct("sid").alias("with_links"))
    out = grid.join(won, ["th_s2", "th_s3"], "left").na.fill(0).crossJoin(F.broadcast(s1.agg(F.count("*").alias("n"))))
    dist = 2 * F.abs(1 - F.col("with_links") / F.col("n") - empty_target) + 0.1 * F.abs(F.col("links") / F.col("n") - links_target)
    return out.select("th_s2", "th_s3", F.round(F.col("links") / F.col("n"), 6).alias("links_per_s1"), F.round(1 - F.col("with_links") / F.col("n"), 6).alias("empty_rate"), F.round(dist, 6).alias("distance"))


def country_sweep(p: DataFrame, s1: DataFrame, steps: dict[str, list[float]], deltas: list[float], empty: dict[str, float], links: dict[str, float]) -> DataFrame:
    """Of exclusive pairs, all combinations of a threshold for each country and a rise for S3: links per S1 and
    empty rate by country, and their distance from the targets, nearest first. Counts are taken by country,
    threshold and rise, and then combined."""
    cells = p.sparkSession.createDataFrame([(c, t, x) for c, own in steps.items() for t in own for x in deltas], "country string, th double, d_s3 double")
    kept = p.select("sid", "cid", "country", "p").join(F.broadcast(cells), "country").where(F.col("p") >= F.col("th") + F.when(F.col("cid").startswith("S3-"), F.col("d_s3")).otherwise(0.0))
    won = kept.groupBy("country", "th", "d_s3").agg(F.count("*").alias("l"), F.countDistinct("sid").alias("w"))
    all_ = cells.join(won, ["country", "th", "d_s3"], "left").na.fill(0, ["l", "w"]).join(F.broadcast(s1.groupBy("country").agg(F.count("*").alias("n"))), "country", "left").na.fill(1, ["n"])
    one = lambda c: all_.where(F.col("country") == c).select("d_s3", F.col("th").alias(f"th_{c.lower()}"), (F.col("l") / F.col("n")).alias(f"links_{c.lower()}"), (1 - F.col("w") / F.col("n")).alias(f"empty_{c.lower()}"))
    out = reduce(lambda a, b: a.join(F.broadcast(b), "d_s3"), map(one, steps))
    off = lambda kind, targets: reduce(lambda a, b: a + b, [F.abs(F.col(f"{kind}_{c.lower()}") - t) for c, t in targets.items()])
    figures = [F.round(x, 6).alias(x) for x in out.columns if x.startswith(("links_", "empty_"))]
    ths = [x for x in out.columns if x.startswith("th_")]
    return out.select(*ths, "d_s3", *figures, F.round(2 * off("empty", empty) + 0.1 * off("links", links), 6).alias("distance")).orderBy("distance", *ths, "d_s3")


def histogram(p: DataFrame, bins: int = 20) -> DataFrame:
    """Counts of p on [0, 1], the right edge closed, empty bins included."""
    own = p.groupBy(F.least(F.floor(F.col("p") * bins), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    return p.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).join(own, "bin", "left").na.fill(0)


def prediction_stats(pred: DataFrame, s1: DataFrame) -> DataFrame:
    n = pred.groupBy("sid").agg(F.count("*").alias("c"))
    each = s1.select(F.col("entity_id").alias("sid"), "country").join(n, "sid", "left").na.fill(0, ["c"])
    return each.groupBy("country").agg(F.round(F.avg("c"), 6).alias("links_per_s1"), F.round(F.avg((F.col("c") == 0).cast("int")), 6).alias("empty_rate"))
