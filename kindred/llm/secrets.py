"""Secret scans by an incremental blob ledger, in DataFrame operations alone.

A text is stored once, under the SHA-256 of its bytes, however many documents and versions hold it. The
ledger has one row for each blob and rule version that was ever scanned, clean ones included; a run scans
only pairs that are not in it, and findings are joined back to every document by its blob."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored


@dataclass(frozen=True)
class Rule:
    """version is to be raised with any change of the others. Of matches whose group is shorter than
    least code points, none is kept; group 0 is the match, which is the span in any case."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(either_case(x) for x in ("password", "passwd", "secret", "token", "api_?key"))
BASE = ("assign", "access", "hex")
RULES = (
    Rule("assign", 1, f"({_NAMES})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", 1, "AKIA[A-Z0-9]{12,}"),
    Rule("hex", 1, "[0-9a-f]{32,}"),
    Rule("pem", 1, "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", 1, "eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}"),
    Rule("vendor", 1, "(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})"),
)

LEDGER = "blob string, kind string, version int, spans array<struct<start: bigint, end: bigint>>"


def blob_of(text: Column) -> Column:
    """A null text is the empty one."""
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New rows of the ledger (see LEDGER): one for each pair of a blob of docs and a rule version that
    ledger lacks. spans: matches left to right, in code points, end exclusive; empty if clean."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    blobs = docs.select(blob_of(docs["text"]).alias("blob"), text.alias("text")).dropDuplicates(["blob"])
    every = F.array(*(F.lit(f"{r.kind}:{r.version}") for r in rules))
    if ledger is None:
        blobs = blobs.withColumn("todo", every)
    else:
        done = ledger.groupBy("blob").agg(F.collect_set(F.concat_ws(":", "kind", "version")).alias("done"))
        blobs = blobs.join(done, "blob", "left").withColumn("todo", F.array_except(every, F.coalesce("done", F.array().cast("array<string>")))).where("size(todo) > 0")

    def pieces(rule: Rule) -> Column:
        """Lengths of what stands before each match, of the match and of its group; null if none matches."""
        pattern, t = F.lit(rule.pattern), F.col("text")
        size = lambda xs: F.transform(xs, F.length)
        match, group = F.regexp_extract_all(t, pattern, F.lit(0)), F.regexp_extract_all(t, pattern, F.lit(rule.group))
        zipped = F.arrays_zip(size(F.split(t, rule.pattern, -1)).alias("gap"), size(match).alias("match"), size(group).alias("group"))
        return F.when(F.array_contains("todo", f"{rule.kind}:{rule.version}"), F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), F.lit(rule.least).alias("least"), F.when(t.rlike(rule.pattern), zipped).alias("pieces")))

    per_rule = blobs.select("blob", F.explode(F.array(*map(pieces, rules))).alias("r")).where("r is not null").select("blob", "r.*")
    each = per_rule.select("blob", "kind", "version", "least", F.posexplode_outer("pieces").alias("pos", "p")).select("blob", "kind", "version", "least", "pos", "p.gap", "p.match", "p.group")
    before = Window.partitionBy("blob", "kind", "version").orderBy("pos")
    start = F.sum("gap").over(before) + F.coalesce(F.sum("match").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = each.withColumn("start", start.cast("long"))
    span = F.when(F.col("group") >= F.col("least"), F.struct("start", (F.col("start") + F.col("match")).alias("end")))
    return placed.groupBy("blob", "kind", "version").agg(F.array_sort(F.collect_list(span)).alias("spans"))


def _exists(spark, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def update_ledger(docs: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the Parquet ledger at path lacks, append it, and return the ledger's rows of these rule
    versions. A run that is lost before its commit leaves the ledger as it was; a repeated run adds nothing."""
    spark = docs.sparkSession
    old = spark.read.schema(LEDGER).parquet(path) if _exists(spark, path) else None
    scan(docs, old, rules).write.mode("append").parquet(path)
    keys = [f"{r.kind}:{r.version}" for r in rules]
    return spark.read.schema(LEDGER).parquet(path).where(F.concat_ws(":", "kind", "version").isin(keys))


def _by_blob(ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """blob, found: its spans by these rules in these versions, with the rule's place in the list, in order of
    start, then of that. Rows of other versions or kinds, and repeated rows of a pair, count for nothing."""
    place = F.coalesce(*(F.when((F.col("kind") == r.kind) & (F.col("version") == r.version), F.lit(k)) for k, r in enumerate(rules)), F.lit(None).cast("int"))
    one = ledger.where("size(spans) > 0").withColumn("place", place).where("place is not null")
    listed = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.col("place").alias("place"), F.col("kind").alias("kind"), s["end"].alias("end")))
    return one.select(F.col("blob").alias("found_blob"), listed.alias("found")).groupBy("found_blob").agg(F.array_distinct(F.array_sort(F.flatten(F.collect_set("found")))).alias("found"))


def findings(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of docs: doc_id, blob, found (array of start, place, kind, end; empty if clean).
    Null and empty texts are one clean blob; a null doc_id stays; repeated rows get a row each; an empty
    table gives none. Other columns of docs are ignored."""
    paths = docs.select(docs["doc_id"].cast("long").alias("doc_id"), blob_of(docs["text"]).alias("blob"))
    found = _by_blob(ledger, rules)
    none = F.array().cast("array<struct<start:bigint,place:int,kind:string,end:bigint>>")
    return paths.join(found, paths["blob"] == found["found_blob"], "left").select("doc_id", "blob", F.coalesce("found", none).alias("found"))


def listing(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


#: Findings of up to so many bytes are broadcast; more are shuffled.
FOUND_BYTES = 32 << 20


def redact(docs: DataFrame, mark: str = "[SECRET]", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs with all their columns and rows; in text, each stretch that spans cover is replaced by mark.
    n_chars, if there, follows the text that changed. Whole texts are shuffled once, to be scanned once for each
    blob, and a second time only if findings are too many to broadcast. Null and empty texts, and all others without a finding,
    stay as they are; repeated rows stay; an empty table gives none."""
    ledger = stored(scan(docs, None, rules), "ledger")
    found = stored(_by_blob(ledger, rules), "found")
    size = found.agg(F.sum(128 + 64 * F.size("found"))).first()[0] or 0
    found = F.broadcast(found) if size <= FOUND_BYTES else found
    text = F.col("text").cast("string")
    # spans in order: what lies between the end so far and the next start stays, overlaps are one stretch
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("end"))
    step = lambda acc, s: F.struct(
        F.when(s["start"] < acc["end"], acc["out"]).otherwise(F.concat(acc["out"], F.substring(text, (acc["end"] + 1).cast("int"), (s["start"] - acc["end"]).cast("int")), F.lit(mark))).alias("out"),
        F.greatest(acc["end"], s["end"]).alias("end"),
    )
    whole = F.aggregate("found", start, step, lambda acc: F.concat(acc["out"], F.substring(text, (acc["end"] + 1).cast("int"), F.length(text))))
    rows = docs.withColumn("__kd_blob", blob_of(docs["text"]))
    out = rows.join(found, rows["__kd_blob"] == found["found_blob"], "left").withColumn("__kd_hit", F.col("found").isNotNull())
    out = out.withColumn("text", F.when(F.col("__kd_hit"), whole).otherwise(text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__kd_hit"), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
