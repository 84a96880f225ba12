"""The whole linkage as one plan, and its command line.

python -m kindred.plans.resolution --s1 F --pool F [F ...] --out DIR [--truth F] [--learn DIR | --model DIR] [--th-s2 X] [--th-s3 X] [--unseen-offset X --seen C ...]

--learn fits the matcher on the given truth, saves it, and writes the links of out-of-fold scores; --model
links by a saved matcher, its thresholds and its countries. Without either, p is the fixed overlap score."""

from __future__ import annotations

import argparse
from typing import NamedTuple

from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import silver
from ..operators import blocking, decisions, matching
from ..operators.features import FEATURES, exact, vector
from ..sources import entities as src
from ..sources.scratch import written


def candidates(entities: DataFrame, k: int = blocking.TOP_K, similar: bool = False) -> DataFrame:
    """Ranked candidates of every S1, with both sides' fields, rank_score, rank and p. One path for training
    and prediction, so features never differ between them. The normalised fields, which five branches of the
    plan read, are written once."""
    s = written(silver(entities), "silver")
    pairs = blocking.blocked_pairs(blocking.keys(s)).select("sid", "cid").distinct()
    scored = blocking.overlap_score(blocking.with_sides(pairs, s))
    return blocking.top_k(blocking.composite_score(scored) if similar else scored, k)


def resolve(entities: DataFrame, th_s2: float = 0.5, th_s3: float = 0.5, seen: tuple[str, ...] = (), offset: float = 0.0, similar: bool = False) -> DataFrame:
    """sid, cid, p of the links: threshold first, then one owner for each candidate."""
    return decisions.exclusive(decisions.above(exact(candidates(entities, similar=similar)), th_s2, th_s3, seen, offset))


class Learned(NamedTuple):
    """Five fold models, the calibration of their out-of-fold scores, the thresholds chosen on those, and
    the countries seen."""

    models: list[GBTClassificationModel]
    isotonic: IsotonicRegressionModel
    th_s2: float
    th_s3: float
    countries: tuple[str, ...]


def learn(entities: DataFrame, links: DataFrame, **how) -> tuple[Learned, DataFrame]:
    """The matcher, and the training pairs with their calibrated out-of-fold p. Thresholds are the first best
    cell of the grid, by macro F0.5 over all S1; links that blocking misses count."""
    s1 = entities.where(F.col("entity_id").startswith("S1-"))
    data = written(matching.labelled(vector(candidates(entities, similar=True)), links), "training")
    return learn_from(data, links, s1, **how)


def learn_from(data: DataFrame, links: DataFrame, s1: DataFrame, **how) -> tuple[Learned, DataFrame]:
    """learn() from labelled vectors; p has sid, cid, country, label, raw and p."""
    models = matching.fold_models(data, **how)
    scored = written(matching.held_out(models, data).select("sid", "cid", "country", "label", "raw"), "out-of-fold")
    isotonic = matching.calibrate(scored)
    p = matching.calibrated(isotonic, scored)
    best = decisions.best_cell(decisions.source_grid(decisions.exclusive(p), links, s1, decisions.GRID))
    countries = tuple(r[0] for r in data.select("country").distinct().orderBy("country").collect())
    return Learned(models, isotonic, *best, countries), p


def leave_country_out(data: DataFrame, links: DataFrame, s1: DataFrame, **how) -> DataFrame:
    """sid, cid, country, raw, p, won of every pair, scored by a model of the other countries and calibrated
    and decided as the matcher of all would be; loco_f05 and oof_f05 of its country, the latter by
    out-of-fold scores. Blocking keeps a candidate's claims in one country, so owners can be chosen among
    all held-out pairs at once."""
    m, seen = learn_from(data, links, s1, **how)
    p = written(matching.calibrated(m.isotonic, matching.leave_country_out(data, **how)).select("sid", "cid", "country", "raw", "p"), "left-out")
    won = decided(p, m)
    figure = lambda q, name: decisions.f05_by_country(decisions.per_s1(q, links, s1), name)
    out = p.join(won.select("sid", "cid", F.lit(True).alias("won")), ["sid", "cid"], "left").na.fill(False, ["won"])
    return out.join(F.broadcast(figure(won, "loco_f05")), "country").join(F.broadcast(figure(decided(seen, m), "oof_f05")), "country")


def resolve_learned(entities: DataFrame, m: Learned, th_s2: float | None = None, th_s3: float | None = None, seen: tuple[str, ...] | None = None, offset: float = 0.0) -> DataFrame:
    """sid, cid, country, p of the links by the mean of the fold models, calibrated."""
    p = matching.calibrated(m.isotonic, matching.averaged(m.models, matching.assembled(vector(candidates(entities, similar=True)))))
    return decided(p, m, th_s2, th_s3, seen, offset)


def decided(p: DataFrame, m: Learned, th_s2: float | None = None, th_s3: float | None = None, seen: tuple[str, ...] | None = None, offset: float = 0.0) -> DataFrame:
    """Links of scored pairs by the matcher's thresholds and countries, where no others are given."""
    two, three = m.th_s2 if th_s2 is None else th_s2, m.th_s3 if th_s3 is None else th_s3
    return decisions.exclusive(decisions.above(p, two, three, m.countries if seen is None else seen, offset)).select("sid", "cid", "country", "p")


def save(m: Learned, path: str, spark: SparkSession) -> None:
    for k, model in enumerate(m.models):
        model.write().overwrite().save(f"{path}/fold{k}")
    m.isotonic.write().overwrite().save(f"{path}/isotonic")
    row = (len(m.models), m.th_s2, m.th_s3, list(m.countries), FEATURES, blocking.TOP_K)
    decision = spark.createDataFrame([row], DECISION)
    decision.coalesce(1).write.mode("overwrite").json(f"{path}/decision")


DECISION = "folds int, th_s2 double, th_s3 double, countries array<string>, features array<string>, top_k int"


def load(spark: SparkSession, path: str) -> Learned:
    d = spark.read.schema(DECISION).json(f"{path}/decision").first()
    if d.features != FEATURES or d.top_k != blocking.TOP_K:
        raise ValueError(f"{path}: the model's features or candidates are not those of this version; learn again")
    models = [GBTClassificationModel.load(f"{path}/fold{k}") for k in range(d.folds)]
    return Learned(models, IsotonicRegressionModel.load(f"{path}/isotonic"), d.th_s2, d.th_s3, tuple(d.countries))


def main() -> None:
    a = argparse.ArgumentParser(description=__doc__)
    a.add_argument("--s1", required=True)
    a.add_argument("--pool", nargs="+", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--truth")
    a.add_argument("--learn", metavar="DIR")
    a.add_argument("--model", metavar="DIR")
    a.add_argument("--th-s2", type=float)
    a.add_argument("--th-s3", type=float)
    a.add_argument("--unseen-offset", type=float, default=0.0)
    a.add_argument("--seen", nargs="*")
    o = a.parse_args()
    if o.learn and (o.model or not o.truth):
        a.error("--learn needs --truth, and no --model")
    spark = SparkSession.builder.appName("kindred").getOrCreate()
    s1 = src.read_tsv(spark, o.s1)
    everyone = s1
    for path in o.pool:
        everyone = everyone.unionByName(src.read_tsv(spark, path))
    given = (o.th_s2, o.th_s3, None if o.seen is None else tuple(o.seen), o.unseen_offset)
    if o.learn:
        m, p = learn(everyone, src.links(src.read_tsv(spark, o.truth, src.TRUTH)))
        save(m, o.learn, spark)
        print(f"th_s2 {m.th_s2} th_s3 {m.th_s3} countries {', '.join(m.countries)}", *(f"{f} {x:.4f}" for f, x in matching.importances(m.models[0])), sep="\n")
        links = decided(p, m, *given)
    elif o.model:
        links = resolve_learned(everyone, load(spark, o.model), *given)
    else:
        links = resolve(everyone, 0.5 if o.th_s2 is None else o.th_s2, 0.5 if o.th_s3 is None else o.th_s3, tuple(o.seen or ()), o.unseen_offset, similar=True)
    src.write_lists(s1, links, f"{o.out}/matching_results", "matched_entity_ids")
    if o.truth:
        counts = decisions.per_s1(links, src.links(src.read_tsv(spark, o.truth, src.TRUTH)), s1)
        decisions.breakdown(counts).show(100, False)


if __name__ == "__main__":
    main()
