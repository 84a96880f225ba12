"""The learned matcher, from files to links: fold models, calibration, thresholds, saved and read again."""

import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred import queries
from kindred.operators import decisions, matching
from kindred.plans import resolution
from kindred.sources import entities as src

SF = "/root/testdata/sf0.001"
HEAD = ["entity_id", "business_name", "business_address", "country"]


def write_tsv(path, head, rows):
    path.write_text("\n".join("\t".join("" if x is None else x for x in r) for r in [head, *rows]) + "\n", encoding="utf-8")


def run(monkeypatch, *args):
    monkeypatch.setattr(sys, "argv", ["resolution", *map(str, args)])
    resolution.main()


def test_learn_and_link(spark, tmp_path, monkeypatch, capsys):
    """Fitted on the entities of some parts, a saved matcher links others: mean of its models, calibrated, its own thresholds."""
    e = src.fixture(spark, SF)
    k = F.substring("entity_id", 4, 8).cast("long") % 50000000 % 40000000
    truth = src.fixture_links(e)
    for part, own in (("train", k % 2 == 0), ("test", k % 2 == 1)):
        rows = e.where(own).select(*HEAD).collect()
        write_tsv(tmp_path / f"{part}1.tsv", HEAD, [r for r in rows if r[0].startswith("S1-")])
        write_tsv(tmp_path / f"{part}2.tsv", HEAD, [r for r in rows if not r[0].startswith("S1-")])
    lists = truth.groupBy("s1id").agg(F.array_join(F.collect_list("cid"), ",")).collect()
    write_tsv(tmp_path / "truth.tsv", ["source1_entity_id", "matched_entity_ids"], lists)
    files = lambda part: ("--s1", tmp_path / f"{part}1.tsv", "--pool", tmp_path / f"{part}2.tsv")
    train = src.read_tsv(spark, str(tmp_path / "train1.tsv"))
    known = {r[0] for r in train.select("entity_id").collect()}
    write_tsv(tmp_path / "own.tsv", ["source1_entity_id", "matched_entity_ids"], [r for r in lists if r[0] in known])
    with pytest.raises(SystemExit):
        run(monkeypatch, *files("train"), "--out", tmp_path / "x", "--learn", tmp_path / "m")
    monkeypatch.setattr(matching.fit, "__defaults__", (3, 3))  # as in production but for the trees
    run(monkeypatch, *files("train"), "--out", tmp_path / "a", "--learn", tmp_path / "m", "--truth", tmp_path / "own.tsv")
    assert "th_s2" in capsys.readouterr().out
    run(monkeypatch, *files("test"), "--out", tmp_path / "b", "--model", tmp_path / "m")
    everyone = src.read_tsv(spark, str(tmp_path / "test1.tsv")).unionByName(src.read_tsv(spark, str(tmp_path / "test2.tsv")))
    m = resolution.load(spark, str(tmp_path / "m"))
    assert len(m.models) == 5 and m.th_s2 in decisions.GRID and m.th_s3 in decisions.GRID and m.countries == ("France", "India", "US")
    data = matching.assembled(resolution.vector(resolution.candidates(everyone, similar=True))).cache()
    each = [{(r.sid, r.cid): r.raw for r in matching.score(x, data).select("sid", "cid", "raw").collect()} for x in m.models]
    best = {}
    for sid, cid in each[0]:
        p = float(np.interp(np.mean([x[sid, cid] for x in each]), m.isotonic.boundaries, m.isotonic.predictions))
        if p >= (m.th_s3 if cid.startswith("S3-") else m.th_s2):
            best[cid] = min(best.get(cid, (0.0, "")), (-p, sid))
    got = src.links(src.read_tsv(spark, str(tmp_path / "b" / "matching_results"), src.TRUTH)).collect()
    assert {(r.s1id, r.cid) for r in got} == {(sid, cid) for cid, (_, sid) in best.items()} and got
    assert src.read_tsv(spark, str(tmp_path / "b" / "matching_results"), src.TRUTH).count() == everyone.where("entity_id LIKE 'S1-%'").count()


def test_fold_average(spark):
    """The mean of the models' scores, the out-of-fold score of each fold's own model."""
    e = src.fixture(spark, SF)
    data = matching.labelled(resolution.vector(resolution.candidates(e)), src.fixture_links(e)).cache()
    models = matching.fold_models(data, rounds=1, depth=2)
    each = [{(r.sid, r.cid): r.raw for r in matching.score(m, data).select("sid", "cid", "raw").collect()} for m in models]
    for r in matching.averaged(models, data).select("sid", "cid", "raw").collect():
        assert r.raw == pytest.approx(sum(x[r.sid, r.cid] for x in each) / 5)
    for r in matching.held_out(models, data).select("sid", "cid", "fold", "raw").collect():
        assert r.raw == pytest.approx(each[r.fold][r.sid, r.cid])
    top = matching.importances(models[0])
    assert len(top) == 15 and top == sorted(top, key=lambda x: -x[1])


def test_registered_as_in_production(spark, monkeypatch):
    """The queries fit the operator's trees, and calibrate scores that no pair's own model gave."""
    fits = []

    def fit(data, rounds=20, depth=5, plain=matching.fit):
        fits.append((rounds, depth, {r[0] for r in data.select("fold").distinct().collect()}, {r[0] for r in data.select("country").distinct().collect()}))
        return plain(data, 2, 2)

    monkeypatch.setattr(matching, "fit", fit)
    p = {(r.sid, r.cid): r.p for r in queries.gbt_oof(spark, SF).collect()}
    assert [f[:3] for f in fits] == [(20, 5, set(range(5)) - {k}) for k in range(5)]
    raw = {(r.sid, r.cid): r.raw for r in queries.isotonic(spark, SF).collect()}
    assert raw == pytest.approx(p) and len(fits) == 10
    rows = queries.loco(spark, SF).collect()
    assert {r[:2] for r in fits} == {(20, 5)}
    assert sorted(c for _, _, _, cs in fits[15:] for c in {"France", "India", "US"} - cs) == ["France", "India", "US"]
    e = src.fixture(spark, SF)
    links, true = {}, {}
    for s, c in src.fixture_links(e).collect():
        true.setdefault(s, set()).add(c)
    for r in rows:
        if r.won:
            links.setdefault(r.sid, set()).add(r.cid)
    owners = [r.cid for r in rows if r.won]
    assert len(owners) == len(set(owners)) and len(rows) == len(p)
    figures = {(r.country, r.loco_f05) for r in rows}
    scores = {}
    for r in e.where("entity_id LIKE 'S1-%' AND country IS NOT NULL").collect():  # S1 without a country have no pairs, so no rows
        got, want = links.get(r.entity_id, set()), true.get(r.entity_id, set())
        f = float(got == want) if not got or not want else 1.25 * len(got & want) / (0.25 * len(want) + len(got))
        scores.setdefault(r.country, []).append(f)
    assert dict(figures) == pytest.approx({c: sum(x) / len(x) for c, x in scores.items()}, abs=1e-6)
