"""Checks of output files against their sources: one row for each finding (rule, severity, n, examples)."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _found(rule: str, severity: str, ids: DataFrame) -> DataFrame:
    """How many, and the first five of the distinct ids in order: two bounded aggregates."""
    ids = ids.toDF("id")
    first = ids.distinct().orderBy("id").limit(5).agg(F.array_join(F.array_sort(F.collect_list("id")), ",").alias("examples"))
    return ids.agg(F.count("*").alias("n")).crossJoin(first).select(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), "n", "examples")


def validate(lists: DataFrame, required: DataFrame, pool: DataFrame | None = None, candidates: DataFrame | None = None) -> DataFrame:
    """lists (s1, ids: comma list); required and pool (entity_id); candidates like lists. Rules without a
    finding have n = 0."""
    split = lambda d: d.select("s1", F.filter(F.transform(F.split(F.coalesce("ids", F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "").alias("x"))
    rows, s1 = split(lists), required.select("entity_id")
    each = rows.select("s1", F.explode("x").alias("id"))
    out = [
        _found("duplicate_s1", "error", lists.groupBy("s1").agg(F.count("*").alias("n")).where("n > 1").select("s1")),
        _found("repeated_id", "error", rows.where(F.size("x") != F.size(F.array_distinct("x"))).select("s1")),
        _found("self_match", "error", each.where(F.col("id").startswith("S1-")).select("id")),
        _found("bad_prefix", "error", each.where(~F.col("id").rlike("^S[123]-")).select("id")),
        _found("missing_s1", "error", s1.join(lists, s1["entity_id"] == lists["s1"], "left_anti")),
        _found("extra_s1", "error", lists.join(s1, s1["entity_id"] == lists["s1"], "left_anti").select("s1")),
        _found("rows", "info", lists.select("s1")),
        _found("empty_rows", "info", rows.where(F.size("x") == 0).select("s1")),
    ]
    if pool is not None:
        known = pool.select(F.col("entity_id").alias("id"))
        out.append(_found("unknown_id", "error", each.where(F.col("id").rlike("^S[23]-")).join(known, "id", "left_anti").select("id")))
    if candidates is not None:
        c = split(candidates).withColumnRenamed("x", "y")
        both = rows.join(c, "s1", "left").where(F.size(F.array_except("x", F.coalesce("y", F.array().cast("array<string>")))) > 0)
        out.append(_found("not_candidates", "warning", both.select("s1")))
    return reduce(DataFrame.unionByName, out)


def validate_text(lines: DataFrame, header: list[str], first: str | None = None) -> DataFrame:
    """lines (value) of a file as text, and its first line, by default that of the only file: a header with
    commas in place of tabs, another header (cells trimmed, case aside), rows without a tab (blank ones aside)."""
    if first is None:
        got = lines.limit(1).first()
        first = got[0] if got else ""
    spark, want = lines.sparkSession, [x.lower() for x in header]
    cells = lambda sep: [x.strip().lower() for x in first.lstrip("\ufeff").split(sep)]
    comma = cells(",") == want
    one = lambda bad: spark.createDataFrame([(first,)] if bad else [], "value string")
    return reduce(
        DataFrame.unionByName,
        [
            _found("comma_header", "error", one(comma)),
            _found("wrong_header", "error", one(not comma and cells("\t") != want)),
            _found("row_without_tab", "error", lines.where((F.trim("value") != "") & ~F.col("value").contains("\t") & (F.col("value") != F.lit(first))).select("value")),
        ],
    )


MATCHING, CANDIDATE = ["source1_entity_id", "matched_entity_ids"], ["source1_entity_id", "candidate_entity_ids"]


def _note(spark: SparkSession, rule: str, severity: str, n: int, what: str) -> DataFrame:
    return spark.createDataFrame([(rule, severity, n, what)], "rule string, severity string, n long, examples string")


def _lists_of(spark: SparkSession, path: str, header: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """Findings about a file by itself, and its lists (s1, ids) if it can be read."""
    try:
        first = spark.read.text(path).limit(1).collect()
    except AnalysisException:
        return _note(spark, "missing_file", "error", 1, path), None
    except Exception as e:  # a file that Spark cannot open or decode is a finding, not a crash
        return _note(spark, "unreadable_file", "error", 1, f"{path}: {type(e).__name__}"), None
    if not first:
        return _note(spark, "empty_file", "error", 1, path), None
    lines = spark.read.text(path)
    fatal = {r.rule for r in validate_text(lines.limit(0), header, first[0][0]).where("n > 0").collect()}
    broken = lines.where(~F.is_valid_utf8("value"))
    found = validate_text(lines, header, first[0][0]).unionByName(_found("not_utf8", "error", broken.select(F.substring(F.make_valid_utf8("value"), 1, 40))))
    if fatal:  # cells cannot be told apart
        return found, None
    rows = lines.where((F.trim("value") != "") & F.col("value").contains("\t") & (F.col("value") != F.lit(first[0][0])))
    cell = F.split("value", "\t", 2)
    return found, rows.select(F.trim(F.get(cell, 0)).alias("s1"), F.get(cell, 1).alias("ids"))


def validate_files(spark: SparkSession, matching: str, candidate: str | None, required: DataFrame, pool: DataFrame | None = None) -> DataFrame:
    """All findings about an output: file (matching or candidate), rule, severity, n, examples. Without a
    candidate file, or a pool to look ids up in, a warning says so. The file is bad if an error has n > 0."""
    out, lists = [], {}
    for name, path, header in (("matching", matching, MATCHING), ("candidate", candidate, CANDIDATE)):
        if path is None:
            out.append(_note(spark, "no_candidate_file", "warning", 1, "").select(F.lit(name).alias("file"), "*"))
            continue
        found, lists[name] = _lists_of(spark, path, header)
        out.append(found.select(F.lit(name).alias("file"), "*"))
    for name, rows in lists.items():
        if rows is not None:
            among = lists.get("candidate") if name == "matching" else None
            out.append(validate(rows, required, pool, among).select(F.lit(name).alias("file"), "*"))
    if pool is None:
        out.append(_note(spark, "ids_not_checked", "warning", 1, "").select(F.lit("matching").alias("file"), "*"))
    return reduce(DataFrame.unionByName, out)
