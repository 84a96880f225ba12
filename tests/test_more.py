"""Similarities of many pairs, tables of thresholds, ablations, folds, the universe, outputs and the command line."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kindred import __main__ as cli
from kindred.functions import similarity as sim
from kindred.functions import text
from kindred.operators import blocking, decisions, early, features, matching, validation
from kindred.plans import resolution, universe
from kindred.sources import entities as src
from kindred.sources import outputs

SF = "/root/testdata/sf0.001"
HEAD = ["entity_id", "business_name", "business_address", "country"]


def write_tsv(path, head, rows):
    path.write_text("\n".join("\t".join("" if x is None else x for x in r) for r in [head, *rows]) + "\n", encoding="utf-8")


def test_many_equal_one(monkeypatch):
    """All five, in chunks of any size, equal those of one pair, for empty, equally long and over 64 letters too."""
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcé\U0001f600") for _ in range(rng.randint(1, 7)))
    line = lambda n: " ".join(word() for _ in range(rng.randint(0, n)))
    a = [line(4) for _ in range(400)] + ["", "", "abc", "x" * 70, "x y" * 40, line(40), "a" * 64, "ab" * 32]
    b = [line(4) for _ in range(400)] + ["", "q", "cab", "x" * 80, "y x" * 20, line(40), "a" * 64, "ba" * 32]
    for chunk, lanes in ((1 << 12, 1 << 15), (7, 50)):
        monkeypatch.setattr(sim, "CHUNK", chunk)
        monkeypatch.setattr(sim, "LANES", lanes)
        got = sim.scores_many(a, b)
        for name, f in (("ratio", sim.ratio), ("partial", sim.partial_ratio), ("token_sort", sim.token_sort_ratio), ("token_set", sim.token_set_ratio), ("w_ratio", sim.w_ratio)):
            assert got[name].tolist() == pytest.approx([f(x, y) for x, y in zip(a, b)])
    assert all(len(v) == 0 for v in sim.scores_many([], []).values())


PAIRS = "sid string, cid string, country string, p double"


def test_above_table(spark):
    """Without a default row, with many countries, and with no table at all."""
    p = spark.createDataFrame([("a", "S2-1", "US", 0.9), ("a", "S3-1", "US", 0.6), ("b", "S2-2", "X", 0.9), ("c", "S2-3", None, 0.9)], PAIRS)
    kept = lambda rows: {r.cid for r in decisions.above_table(p, spark.createDataFrame(rows, "country string, th_s2 double, th_s3 double")).collect()}
    assert kept([("US", 0.5, 0.7)]) == {"S2-1"} and kept([("US", 0.5, 0.5), (None, 0.95, 0.5)]) == {"S2-1", "S3-1"}
    assert kept([(None, 0.5, 0.65)]) == {"S2-1", "S2-2", "S2-3"} and kept([]) == set()
    many = [(f"c{k}", 0.5, 0.5) for k in range(1500)]
    q = spark.createDataFrame([(f"s{k}", f"S2-{k}", f"c{k}", 0.6) for k in range(1500)], PAIRS)
    assert decisions.above_table(q, spark.createDataFrame(many, "country string, th_s2 double, th_s3 double")).count() == 1500


def test_breakdown_of_null_country(spark):
    counts = spark.createDataFrame([("a", None, 0, 0, 0), ("b", "US", 2, 1, 1), ("c", None, 1, 0, 0), ("d", "US", 0, 3, 0)], "sid string, country string, npred long, ntrue long, tp long")
    got = {(r.country, r.k): r for r in decisions.breakdown(counts).collect()}
    assert set(got) == {("*", -1), (None, -1), ("US", -1), ("*", 0), ("*", 1), ("*", 3)} and got["*", -1].n == 4
    assert (got[None, -1].n, got[None, -1].singleton_accuracy, got["US", -1].singleton_accuracy) == (2, 0.5, None)
    assert (got["*", -1].mean_precision, got["*", -1].mean_recall) == (round((1 + 0.5) / 4, 6), round(3 / 4, 6))
    assert decisions.breakdown(counts.limit(0)).where("k >= 0").count() == 0


def test_ablations(spark):
    """A vetoed claim takes no candidate from its owner, and names that are alike are not vetoed."""
    cols = "sid string, cid string, p double, comb_sim double, n_tset double, a_tset double, n_tsort double, num_conflict int, zip_conflict int, addr_missing int, has_translit int, s_legal string, c_legal string"
    row = lambda s, c, score, conflict, tsort: (s, c, 0.9, score, 0.9, 0.9, tsort, conflict, 0, 0, 0, "", "")
    p = spark.createDataFrame([row("S1-1", "S2-1", 0.9, 1, 0.5), row("S1-2", "S2-1", 0.8, 0, 0.9), row("S1-3", "S2-2", 0.7, 1, 0.95)], cols)
    links = spark.createDataFrame([("S1-2", "S2-1"), ("S1-3", "S2-2")], "s1id string, cid string")
    s1 = spark.createDataFrame([(f"S1-{k}", "US") for k in (1, 2, 3)], "entity_id string, country string")
    got = {(r.excl, r.veto, r.cap): r.macro_f05 for r in decisions.ablations(p, links, s1, 0.5, "comb_sim").collect()}
    assert len(got) == 8 and got[1, 1, 0] == got[1, 1, 1] == got[0, 1, 0] == 1.0 and got[1, 0, 0] == round(1 / 3, 6) and got[0, 0, 0] == round(2 / 3, 6)


def test_expected_topk_weights(spark):
    d = spark.createDataFrame([([0.9, 0.5, 0.2],), ([],), ([0.01],)], "ps array<double>")
    plain = [r[0] for r in d.select(decisions.expected_f05_k(F.col("ps"))).collect()]
    kept = [r[0] for r in d.select(decisions.expected_f05_k(F.col("ps"), by_kept=True)).collect()]
    assert plain[1:] == kept[1:] == [0, 0] and kept[0] >= plain[0] >= 1


def test_agreement_by_force(spark):
    rows = [("s", f"S{2 + k % 2}-{k}", f"S{2 + k % 2}", b) for k, b in enumerate(["acme foods", "acme food", "foods acme", "", "other", "acme foods", "x"])]
    got = {r.cid: r for r in features.agreement(spark.createDataFrame(rows, "sid string, cid string, c_src string, c_brand string")).collect()}
    for _, cid, s, brand in rows:
        near = [0.0 if "" in (brand, b) else sim.token_set_ratio(brand, b) / 100 for _, c, o, b in rows if o != s]
        alike = sum(sim.token_sort_ratio(brand, b) >= 90 for _, c, _, b in rows if c != cid)
        assert got[cid].agree_max_other == pytest.approx(max(near)) and got[cid].agree_mean_other == pytest.approx(sum(near) / len(near)) and got[cid].count_sim_gt_90 == alike


def test_folds_and_splits(spark):
    data = spark.createDataFrame([(f"S1-{k:03d}", f"S2-{k}-{j}") for k in range(101) for j in range(k % 7)], "sid string, cid string")
    folds = matching.group_folds(data).collect()
    own = defaultdict(set)
    for r in folds:
        own[r.sid].add(r.fold)
    sizes = Counter(r.fold for r in folds)
    assert len(folds) == data.count() and all(len(x) == 1 for x in own.values()) and max(sizes.values()) - min(sizes.values()) <= 7 and set(sizes) == set(range(5))
    s1 = spark.createDataFrame([(f"S1-{k:03d}",) for k in range(100)], "entity_id string")
    a, b = matching.split(data, s1)
    assert a.agg(F.max("sid")).first()[0] == "S1-079" and b.agg(F.min("sid")).first()[0] == "S1-080" and a.count() + b.count() == data.count()
    assert 0 < matching.train_share(data, 0.25).count() < data.count() == matching.train_share(data, 1.0).count()


def test_universe_resumes(spark, tmp_path):
    e, path = src.fixture(spark, SF), str(tmp_path / "u")
    assert universe.build(e.limit(0), path, similar=False).count() == 0
    first = universe.build(e.where("country <> 'India'"), path, similar=False)
    assert {r.country for r in first.collect()} == {"US", "France"}
    us = lambda: sorted(str(f) for f in (tmp_path / "u" / "pairs" / "country=US").iterdir())
    files = us()
    every = universe.build(e, path, similar=False)
    assert Counter(r.country for r in every.collect()) == {"US": 1, "France": 1, "India": 1}
    assert files == us()  # left as they were
    assert universe.build(e, path, similar=False).count() == 3
    assert universe.build(e, path, top_k=5, similar=False).where("top_k = 5").count() == 3
    pairs = universe.scan(spark, path)
    assert pairs.groupBy("sid").count().agg(F.max("count")).first()[0] <= 5
    assert 0 < universe.scan(spark, path, share=0.5).count() < pairs.count()
    plan = universe.scan(spark, path, ["US"], 0.5).select("sid")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(country" in plan or "PartitionFilters: [(country" in plan


def test_command_line(spark, tmp_path, capsys):
    """build, train, predict, evaluate, tune, sweep, report and validate, from files to files."""
    e = src.fixture(spark, SF).where("country IS NOT NULL AND country <> 'France'")
    rows = e.select(*HEAD).orderBy(F.desc("entity_id")).collect()
    own = [r for r in rows if r[0].startswith("S1-")]
    write_tsv(tmp_path / "s1.tsv", HEAD, own)
    write_tsv(tmp_path / "pool.tsv", HEAD, [r for r in rows if not r[0].startswith("S1-")])
    lists = src.fixture_links(e).groupBy("s1id").agg(F.array_join(F.collect_list("cid"), ",")).collect()
    write_tsv(tmp_path / "truth.tsv", ["source1_entity_id", "matched_entity_ids"], lists)
    files = ["--s1", str(tmp_path / "s1.tsv"), "--pool", str(tmp_path / "pool.tsv")]
    at = lambda x: str(tmp_path / x)
    quick = ["--preset", "quick", "--rounds", "2", "--depth", "2", "--train-share", "1"]
    assert cli.main(["build", *files, "--work", at("work")]) == 0
    assert cli.main(["train", *files, "--work", at("work"), "--model", at("model"), "--truth", at("truth.tsv"), "--log", at("log"), "--save-oof", at("oof"), *quick]) == 0
    assert "macro F0.5" in capsys.readouterr().out and spark.read.parquet(at("oof")).count() == universe.scan(spark, at("work")).count()
    assert cli.main(["predict", *files, "--work", at("work"), "--model", at("model"), "--out", at("out"), "--tag", "a/b", "--log", at("log")]) == 0
    got = (tmp_path / "out" / "matching_results.tsv").read_text().splitlines()
    assert got[0] == "source1_entity_id\tmatched_entity_ids" and [x.split("\t")[0] for x in got[1:]] == [r[0] for r in own]  # in the order of the file
    assert (tmp_path / "out" / "matching_results_a_b.tsv").read_text().splitlines() == got
    m = resolution.load(spark, at("model"))
    mine = {(r.sid, r.cid) for r in resolution.decided(universe.score(universe.scan(spark, at("work")), m), m).collect()}
    assert {(s, c) for s, cs in (x.split("\t") for x in got[1:]) for c in cs.split(",") if c} == mine and mine
    check = ["validate", *files, "--matching", at("out/matching_results.tsv"), "--candidate", at("out/candidate_pairs.tsv")]
    assert cli.main([*check, "--check-ids"]) == 0
    bad = got[:1] + [got[1].split("\t")[0] + "\tS2-x,S2-x", "S1-none\t", "no tab", *got[3:]]
    (tmp_path / "bad.tsv").write_text("\n".join(bad) + "\n")
    capsys.readouterr()
    assert cli.main(["validate", *files, "--matching", at("bad.tsv"), "--check-ids"]) == 1
    said = {(x.split("\t")[0], x.split("\t")[2]) for x in capsys.readouterr().out.splitlines() if x.count("\t") == 4}
    assert {("error", "repeated_id"), ("error", "unknown_id"), ("error", "extra_s1"), ("error", "missing_s1"), ("error", "row_without_tab"), ("warning", "no_candidate_file")} <= said
    assert cli.main(["evaluate", *files, "--truth", at("truth.tsv")]) == 0
    assert cli.main(["tune", *files, "--work", at("work"), "--model", at("model"), "--build-cache", "--cache", at("cache"), "--th", "US=0.6", "--target", "US=3.4,0.05"]) == 0
    assert cli.main(["sweep", *files, "--cache", at("cache"), "--steps", "US=0.5,0.6", "India=0.5", "--target", "US=3.4,0.05", "India=3.4,0.05"]) == 0
    assert cli.main(["report", "--log", at("log")]) == 0
    assert "## predict" in capsys.readouterr().out


def test_validate_files(spark, tmp_path):
    """Missing, empty and undecodable files, and headers: commas are named as such, any other is wrong."""
    s1 = spark.createDataFrame([("S1-1",), ("S1-2",)], "entity_id string")
    rules = lambda path: {r.rule: r.n for r in validation.validate_files(spark, str(path), None, s1).where("n > 0 AND severity = 'error'").collect()}
    assert set(rules(tmp_path / "none.tsv")) == {"missing_file"}
    for name, data, want in (
        ("empty", b"", {"empty_file"}),
        ("comma", b"source1_entity_id,matched_entity_ids\nS1-1,S2-1\n", {"comma_header", "row_without_tab"}),
        ("wrong", b"id\tmatches\nS1-1\t\nS1-2\t\n", {"wrong_header"}),
        ("case", b" Source1_Entity_ID \tMATCHED_entity_ids\nS1-1\t\n\nS1-2\tS2-1\n", set()),
        ("latin", "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-é\nS1-2\t\n".encode("latin-1"), {"not_utf8"}),
    ):
        (tmp_path / name).write_bytes(data)
        assert set(rules(tmp_path / name)) == want, name


def test_outputs(spark, tmp_path):
    for name in ("train_source1.tsv", "source2.tsv"):
        (tmp_path / name).write_text("x")
    got = outputs.discover(spark, [str(tmp_path / "no"), str(tmp_path)])
    assert got == {"s1": str(tmp_path / "train_source1.tsv"), "s2": str(tmp_path / "source2.tsv")}
    with pytest.raises(FileNotFoundError):
        outputs.discover(spark, [str(tmp_path / "no")])
    zipped = outputs.package([got["s1"], got["s2"]], str(tmp_path / "a.zip"))
    import zipfile

    assert zipfile.ZipFile(zipped).namelist() == ["train_source1.tsv", "source2.tsv"]
    ranked = resolution.candidates(src.fixture(spark, SF))
    outputs.write_candidates(ranked, str(tmp_path / "c"))
    lists = spark.read.schema("sid string, cids string, country string").option("sep", "\t").csv(str(tmp_path / "c"))
    assert lists.select(F.explode(F.split("cids", ","))).count() == ranked.count() and {r[0] for r in lists.select("country").distinct().collect()} == {"US", "India", "France"}
    src.views(src.fixture(spark, SF), src.fixture_links(src.fixture(spark, SF)))
    assert spark.sql("SELECT count(*) FROM links JOIN s1 ON entity_id = s1id").first()[0] == src.fixture_links(src.fixture(spark, SF)).count()
    assert text.safe_name("US/é a-1") == "US___a_1"


def test_first_generation(spark):
    e = spark.createDataFrame([("S1-1", "Shop@LU Infra.biz of Acme.com", "07 7 Main Rd 560001 560001", "X"), ("S2-1", None, "nan", "X"), ("S2-2", "LU Infra Acme", "7 Main Plaza, 560001", "X")], ", ".join(f"{h} string" for h in HEAD))
    raw = {r.entity_id: r for r in early.raw_text(e).collect()}
    one = raw["S1-1"]
    assert (one.name, one.short, one.zip, one.street_nums, one.nums) == ("shop lu infra.biz of acme", ["lu", "of"], "560001", ["07", "7"], ["07", "7", "560001", "560001"])
    assert "infra" in one.tokens and "biz" in one.tokens and "shop" not in one.tokens and raw["S2-1"].addr == ""
    pairs = blocking.blocked_pairs(early.keys_v0(early.raw_text(e)))
    assert {"st_zip", "zip_w", "tok"} <= {r.family for r in pairs.where("cid = 'S2-2'").collect()}
    f = {r.cid: r for r in early.features_v0(spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S2-2")], "sid string, cid string"), early.raw_text(e)).collect()}
    assert f["S2-1"].a_tset == 0 and f["S2-2"].zip_match == 1 and f["S2-2"].num_match == 1 and f["S2-2"].exact_num_match == 0 and len(f["S2-2"]) == 21
    many = [("S1-1", f"S2-{k}", 0.9) for k in range(2, 8)]
    more = e.where("entity_id = 'S1-1'").unionByName(spark.createDataFrame([(f"S2-{k}", "LU Infra of Acme.com Shop", "9 Main Rd" if k == 3 else "7 Main Rd", "X") for k in range(2, 8)], e.schema))
    p = early.raw_score(early.with_raw(spark.createDataFrame(many, "sid string, cid string, p double"), more))
    assert {r.cid for r in early.pruned(p).collect()} <= {f"S2-{k}" for k in range(2, 8)} and early.pruned(p).count() == 3
    assert early.pruned(p.where("cid IN ('S2-2', 'S2-3')")).count() == 2
