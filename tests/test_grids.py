"""The reference's whole grids and truncated families; their rows are compared with SQL in test_oracles.py."""

from kindred import queries
from kindred.functions import similarity as sim
from kindred.operators import decisions, features

SF = "/root/testdata/sf0.001"


def test_whole_grids(spark):
    cells = queries.QUERIES["source_grid_fine"](spark, SF).collect()
    assert len(cells) == 27 * 27 and any((r.th_s2, r.th_s3) == (0.6, 0.575) for r in cells)
    assert queries.QUERIES["threshold_grid_fine"](spark, SF).count() == 27
    configs = queries.QUERIES["threshold_sweep_countries"](spark, SF).collect()
    assert len({(r.th_india, r.th_us, r.th_france, r.d_s3) for r in configs}) == len(configs) == 144
    assert [r.distance for r in configs] == sorted(r.distance for r in configs)


def test_truncated_families(spark):
    rows = queries.QUERIES["truncated_postings_families"](spark, SF).collect()
    held = {}
    for r in rows:
        held.setdefault((r.country, r.family, r.key), []).append(r.entity_id)
    assert {f for _, f, _ in held} == {"tok", "pref4", "char34", "addr_tok", "zip_num"}
    assert max(map(len, held.values())) == 60 and all(len(set(x)) == len(x) or f != "char34" for (_, f, _), x in held.items())
    assert {len(k) for _, f, k in held if f == "char34"} == {3, 4}


def largest(plan, metric="numOutputRows"):
    """Most rows that a node of an executed plan made."""
    name, metrics = plan.getClass().getSimpleName(), plan.metrics()
    own = metrics.apply(metric).value() if metrics.contains(metric) else 0
    inner = [plan.executedPlan()] if name == "AdaptiveSparkPlanExec" else [plan.plan()] if name.endswith("QueryStageExec") else []
    children = plan.children()
    return max([own, *(largest(x, metric) for x in inner + [children.apply(k) for k in range(children.size())])])


def test_grid_by_counts(spark):
    """S1 with the same counts meet the grid once; cells are those of the plain definition."""
    n, steps = 3000, [0.3, 0.5, 0.7, 0.9]
    kinds = [  # true links, and pairs with p, of a third each
        (["S2-a", "S3-a"], [("S2-a", 0.95), ("S3-a", 0.6), ("S3-b", 0.5)]),
        ([], [("S2-a", 0.4)]),
        (["S3-a", "S3-b"], [("S2-a", 0.2), ("S3-a", 0.3)]),
    ]
    s1 = [f"S1-{k}" for k in range(n)] + ["S1-alone", "S1-missed"]
    true = [(f"S1-{k}", f"{c}{k}") for k in range(n) for c in kinds[k % 3][0]] + [("S1-missed", "S2-x")]
    pairs = [(f"S1-{k}", f"{c}{k}", p) for k in range(n) for c, p in kinds[k % 3][1]]
    df = lambda rows, schema: spark.createDataFrame(rows, schema)
    got = decisions.source_grid(df(pairs, "sid string, cid string, p double"), df(true, "s1id string, cid string"), df([(x, "US") for x in s1], "entity_id string, country string"), steps)
    rows = got.collect()
    assert largest(got._jdf.queryExecution().executedPlan()) < 3 * n  # each S1 in each of its cells: 8 * n
    assert len(rows) == len(steps) ** 2
    for r in rows:
        f = 1.0  # of S1-alone; S1-missed scores 0
        for links, found in kinds:
            won = [c for c, p in found if p >= (r.th_s3 if c.startswith("S3") else r.th_s2)]
            hit = len(set(won) & set(links))
            f += n / 3 * (float(bool(won) == bool(links)) if not won or not links else 1.25 * hit / (0.25 * len(links) + len(won)))
        assert abs(r.macro_f05 - f / (n + 2)) < 1e-6, r


def test_agreement_once_for_two(spark):
    """Each two candidates of an S1 are compared once, and both have the result."""
    brands = ["acme park mill", "mill park acme", "acme", "", "park lake hill", "acme park"]
    rows = [(f"S1-{s}", f"S{2 + k % 2}-{s}{k}", f"S{2 + k % 2}", b) for s in range(40) for k, b in enumerate(brands[: 1 + s % 6])]
    got = features.agreement(spark.createDataFrame(rows, "sid string, cid string, c_src string, c_brand string"))
    found = {(r.sid, r.cid): r[2:] for r in got.collect()}
    twos = sum(n * (n - 1) // 2 for n in (1 + s % 6 for s in range(40)))
    assert largest(got._jdf.queryExecution().executedPlan(), "pythonNumRowsReceived") == twos
    assert set(found) == {r[:2] for r in rows}
    for sid, cid, src, brand in rows:
        rest = [r for r in rows if r[0] == sid and r[1] != cid]
        near = [sim.token_set_ratio(brand, r[3]) / 100 if brand and r[3] else 0.0 for r in rest if r[2] != src]
        alike = sum(sim.token_sort_ratio(brand, r[3]) >= 90 for r in rest)
        most, mean, n = found[sid, cid]
        assert abs(most - max(near, default=0.0)) < 1e-9 and abs(mean - (sum(near) / len(near) if near else 0.0)) < 1e-9 and n == alike
