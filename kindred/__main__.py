"""Command line.

python -m kindred link       see kindred.plans.resolution
python -m kindred build      features of all countries as Parquet, with resume
python -m kindred train      fit fold models, calibration and thresholds on built features
python -m kindred predict    score built features, write matching_results and candidate_pairs
python -m kindred evaluate   blocking quality, metrics, ablations and strategies of a labelled sample
python -m kindred tune       a score cache, and its figures by thresholds for each country
python -m kindred sweep      all configurations of thresholds by country, nearest to the targets first
python -m kindred report     the last runs of a log
python -m kindred validate   all findings about outputs; exit code 1 if one is an error"""

from __future__ import annotations

import argparse
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import bucket
from .operators import blocking, decisions, matching, validation
from .operators.features import exact, similarities
from .plans import resolution, universe
from .sources import entities as src
from .sources import outputs


def _inputs(spark: SparkSession, o) -> tuple[DataFrame, DataFrame]:
    """S1 in order, and everyone."""
    s1 = src.in_order(spark, o.s1)
    everyone = s1.drop("place")
    for path in o.pool:
        everyone = everyone.unionByName(src.read_tsv(spark, path))
    return s1, everyone


def _log(spark: SparkSession, o, phase: str, **figures) -> None:
    if o.log:
        src.log_json(spark, o.log, run_at=time.strftime("%Y-%m-%d %H:%M:%S"), phase=phase, **figures)


def build(spark: SparkSession, o) -> int:
    _, everyone = _inputs(spark, o)
    universe.build(everyone, o.work, o.top_k, resume=not o.rebuild).drop("features").show(100, False)
    return 0


def train(spark: SparkSession, o) -> int:
    s1, _ = _inputs(spark, o)
    links = src.links(src.read_tsv(spark, o.truth, src.TRUTH))
    own = s1.where(F.col("country").isin(*o.countries)) if o.countries else s1
    ids = own.select(F.col("entity_id").alias("s1id"))
    links = links.join(ids, "s1id", "left_semi")
    pairs = universe.labelled(universe.scan(spark, o.work, o.countries), links)
    data = matching.assembled(pairs.withColumns({"label": F.col("label").cast("double"), "fold": bucket(F.col("sid")) % 5}))
    how = matching.PRESETS[o.preset] | {k: v for k, v in (("rounds", o.rounds), ("depth", o.depth), ("step", o.step)) if v is not None}
    m, p = resolution.learn_from(data, links, own, share=o.train_share, **how)
    resolution.save(m, o.model, spark)
    if o.save_oof:
        p.select("sid", "cid", "country", "label", "raw", "p").write.mode("overwrite").parquet(o.save_oof)
    f05 = decisions.macro_f05(decisions.per_s1(resolution.decided(p, m), links, own)).first()[0]
    gains = matching.importances(m.models[0])
    print(f"th_s2 {m.th_s2} th_s3 {m.th_s3} macro F0.5 {f05}", *(f"{f} {x:.4f}" for f, x in gains), sep="\n")
    _log(spark, o, "train", th_s2=m.th_s2, th_s3=m.th_s3, macro_f05=f05, countries=list(m.countries))
    if o.loco:
        resolution.leave_country_out(data, links, own, share=o.train_share, **how).groupBy("country").agg(F.first("oof_f05").alias("oof_f05"), F.first("loco_f05").alias("loco_f05")).show()
    return 0


def predict(spark: SparkSession, o) -> int:
    s1, _ = _inputs(spark, o)
    m = resolution.load(spark, o.model)
    p = universe.score(universe.scan(spark, o.work), m)
    p = universe.cache(p, f"{o.work}/scored", 0.0)
    links = resolution.decided(p, m, o.th_s2, o.th_s3, None, o.unseen_offset)
    outputs.write_results(s1, links, p, o.out, o.tag)
    stats = decisions.prediction_stats(links, s1)
    stats.show()
    decisions.histogram(p).show()
    _log(spark, o, "predict", tag=o.tag, stats=[r.asDict() for r in stats.collect()])
    return 0


def evaluate(spark: SparkSession, o) -> int:
    _, everyone = _inputs(spark, o)
    links = src.links(src.read_tsv(spark, o.truth, src.TRUTH))
    some = src.train_sample(everyone, links, o.sample)
    s1 = some.where(F.col("entity_id").startswith("S1-"))
    links = links.join(s1.select(F.col("entity_id").alias("s1id")), "s1id", "left_semi")
    p = exact(similarities(resolution.candidates(some, similar=True)))
    p = resolution.written(p, "evaluated")
    blocking.blocking_quality(p, links, s1).show()
    blocking.country_stats(p, s1).show()
    decisions.breakdown(decisions.per_s1(decisions.exclusive(decisions.above(p, o.threshold, o.threshold)), links, s1)).show(100, False)
    decisions.ablations(p, links, s1, o.threshold, "comb_sim").show()
    decisions.strategies(p, links, s1).show(100, False)
    return 0


def tune(spark: SparkSession, o) -> int:
    s1, _ = _inputs(spark, o)
    p = universe.score(universe.scan(spark, o.work), resolution.load(spark, o.model)) if o.build_cache else None
    cached = universe.cache(p, o.cache) if o.build_cache else spark.read.parquet(o.cache)
    table = universe.thresholds(spark, {None: (o.threshold, o.threshold + o.s3_delta)} | {c: (float(t), float(t) + o.s3_delta) for c, t in (x.split("=") for x in o.th)})
    targets = spark.createDataFrame([(c, *map(float, v.split(","))) for c, v in (x.split("=") for x in o.target)], "country string, links_per_s1 double, empty_rate double")
    decisions.cache_figures(cached, s1, table, targets).show()
    if o.out:
        outputs.write_results(s1, universe.links_of(cached, table), cached, o.out, o.tag)
    return 0


def sweep(spark: SparkSession, o) -> int:
    s1, _ = _inputs(spark, o)
    steps = {c: [float(x) for x in v.split(",")] for c, v in (x.split("=") for x in o.steps)}
    empty, links = ({c: float(v.split(",")[k]) for c, v in (x.split("=") for x in o.target) if len(v.split(",")) > k} for k in (1, 0))
    cached = spark.read.parquet(o.cache)
    decisions.country_sweep(decisions.exclusive(cached), s1, steps, o.deltas, empty, links).limit(10).show(10, False)
    return 0


def report(spark: SparkSession, o) -> int:
    print(outputs.report(spark.read.json(o.log), {"train": 3, "predict": 4}))
    return 0


def validate(spark: SparkSession, o) -> int:
    required = src.read_tsv(spark, o.s1)
    pool = None
    if o.check_ids:
        for path in o.pool or ():
            part = src.read_tsv(spark, path)
            pool = part if pool is None else pool.unionByName(part)
    found = validation.validate_files(spark, o.matching, o.candidate, required, pool).collect()
    for r in found:
        if r.n or r.severity == "info":
            print(f"{r.severity}\t{r.file}\t{r.rule}\t{r.n}\t{r.examples}")
    return int(any(r.severity == "error" and r.n for r in found))


def main(argv: list[str] | None = None) -> int:
    argv = sys.argv[1:] if argv is None else argv
    if argv[:1] == ["link"]:
        sys.argv = [sys.argv[0], *argv[1:]]
        resolution.main()
        return 0
    a = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = a.add_subparsers(dest="command", required=True)
    for run in (build, train, predict, evaluate, tune, sweep, report, validate):
        b = sub.add_parser(run.__name__)
        b.set_defaults(run=run)
        b.add_argument("--log")
        if run is not report:
            b.add_argument("--s1", required=True)
            b.add_argument("--pool", nargs="+", default=[])
        if run in (build, train, predict, tune):
            b.add_argument("--work", required=run is not tune)
        if run in (train, predict, tune):
            b.add_argument("--model", required=run is not tune)
        if run in (train, evaluate):
            b.add_argument("--truth", required=True)
        if run in (predict, tune):
            b.add_argument("--out", required=run is predict)
            b.add_argument("--tag", default="")
        if run in (tune, sweep):
            b.add_argument("--cache", required=True)
            b.add_argument("--target", nargs="+", default=[], metavar="COUNTRY=LINKS,EMPTY")
        if run in (evaluate, tune):
            b.add_argument("--threshold", type=float, default=0.6)
        if run is build:
            b.add_argument("--top-k", type=int, default=blocking.TOP_K)
            b.add_argument("--rebuild", action="store_true")
        if run is train:
            b.add_argument("--countries", nargs="+")
            b.add_argument("--preset", choices=sorted(matching.PRESETS), default="v3")
            b.add_argument("--rounds", type=int)
            b.add_argument("--depth", type=int)
            b.add_argument("--step", type=float)
            b.add_argument("--train-share", type=float, default=0.25)
            b.add_argument("--loco", action="store_true")
            b.add_argument("--save-oof")
        if run is predict:
            b.add_argument("--th-s2", type=float)
            b.add_argument("--th-s3", type=float)
            b.add_argument("--unseen-offset", type=float, default=0.0)
        if run is evaluate:
            b.add_argument("--sample", type=int, default=1000, help="thousandths of S1")
        if run is tune:
            b.add_argument("--build-cache", action="store_true")
            b.add_argument("--th", nargs="+", default=[], metavar="COUNTRY=THRESHOLD")
            b.add_argument("--s3-delta", type=float, default=0.0)
        if run is sweep:
            b.add_argument("--steps", nargs="+", required=True, metavar="COUNTRY=T,T,...")
            b.add_argument("--deltas", nargs="+", type=float, default=[0.0, 0.02, 0.03])
        if run is validate:
            b.add_argument("--matching", required=True)
            b.add_argument("--candidate")
            b.add_argument("--check-ids", action="store_true")
    o = a.parse_args(argv)
    return o.run(SparkSession.builder.appName("kindred").getOrCreate(), o)


if __name__ == "__main__":
    sys.exit(main())
