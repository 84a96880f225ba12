"""Sources and sinks: TSV entities, ground truth, outputs; and entities derived from the table `part`."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.text import bucket, id_list

ENTITY = "entity_id string, business_name string, business_address string, country string"
TRUTH = "source1_entity_id string, matched_entity_ids string"


def read_tsv(spark: SparkSession, path: str, schema: str = ENTITY) -> DataFrame:
    """Tab-separated with a header, quotes taken as they are; an empty cell is null."""
    return spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", "").csv(path)


def in_order(spark: SparkSession, path: str, schema: str = ENTITY) -> DataFrame:
    """read_tsv() with place, which orders rows as the file has them: by file, then block, then row in the block."""
    df = read_tsv(spark, path, schema).select("*", F.col("_metadata.file_path").alias("__kd_f"), F.col("_metadata.file_block_start").alias("__kd_b"))
    return df.withColumn("place", F.struct("__kd_f", "__kd_b", F.monotonically_increasing_id().alias("row"))).drop("__kd_f", "__kd_b")


def of_country(entities: DataFrame, country: str) -> tuple[DataFrame, DataFrame]:
    """S1 and pool of one country."""
    own = entities.where(F.col("country") == country)
    return own.where(F.col("entity_id").startswith("S1-")), own.where(~F.col("entity_id").startswith("S1-"))


def views(entities: DataFrame, links_: DataFrame) -> None:
    """Temporary views s1, pool and links, for SQL."""
    entities.where(F.col("entity_id").startswith("S1-")).createOrReplaceTempView("s1")
    entities.where(~F.col("entity_id").startswith("S1-")).createOrReplaceTempView("pool")
    links_.createOrReplaceTempView("links")


def listing(entities: DataFrame, country: str, most: int = 50) -> DataFrame:
    """The first so many entities of a country, by id."""
    return entities.where(F.col("country") == country).orderBy("entity_id").limit(most)


def unknown_ids(pairs: DataFrame, entities: DataFrame) -> DataFrame:
    """side, id of the ends of pairs that no entity has: none, if the pairs are sound."""
    ends = pairs.select(F.explode(F.array(F.struct(F.lit("sid").alias("side"), F.col("sid").alias("id")), F.struct(F.lit("cid").alias("side"), F.col("cid").alias("id")))).alias("e")).select("e.*").distinct()
    return ends.join(entities.select(F.col("entity_id").alias("id")), "id", "left_anti")


def links(truth: DataFrame) -> DataFrame:
    """(s1id, cid), one row for each pair of the comma lists."""
    return truth.select(F.col("source1_entity_id").alias("s1id"), F.explode(id_list(F.col("matched_entity_ids"))).alias("cid"))


def country_counts(entities: DataFrame) -> DataFrame:
    return entities.groupBy("country").agg(F.count("*").alias("n"))


def train_sample(entities: DataFrame, links_: DataFrame, cut: int) -> DataFrame:
    """S1 of the first `cut` thousandths of hash buckets; pool rows that match one of them or are in those buckets."""
    inside = bucket(F.col("entity_id")) < cut
    s1 = entities.where(F.col("entity_id").startswith("S1-") & inside)
    pool = entities.where(~F.col("entity_id").startswith("S1-"))
    true = links_.join(s1, links_["s1id"] == s1["entity_id"], "left_semi").select(F.col("cid").alias("entity_id"))
    return s1.unionByName(pool.where(inside)).unionByName(pool.join(true, "entity_id", "left_semi")).dropDuplicates(["entity_id"])


def write_lists(s1: DataFrame, pairs: DataFrame, path: str, column: str) -> None:
    """One row for each S1, empty ones included, in the order of place where s1 has it (see in_order()), else of id;
    ids by p descending, then id."""
    out = match_lists(s1, pairs, column)
    if "place" in s1.columns:
        at = s1.select(F.col("entity_id").alias("source1_entity_id"), "place")
        out = out.join(at, "source1_entity_id").orderBy("place").drop("place")
    else:
        out = out.orderBy("source1_entity_id")
    out.write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(path)


def match_lists(s1: DataFrame, pairs: DataFrame, column: str = "matched_entity_ids") -> DataFrame:
    got = pairs.groupBy("sid").agg(F.array_sort(F.collect_list(F.struct((-F.col("p")).alias("q"), "cid"))).alias("x"))
    out = s1.select(F.col("entity_id").alias("source1_entity_id")).join(got, F.col("source1_entity_id") == F.col("sid"), "left")
    return out.select("source1_entity_id", F.coalesce(F.array_join(F.col("x.cid"), ","), F.lit("")).alias(column))


def log_json(spark: SparkSession, path: str, **figures) -> None:
    """Append one JSON line to a log of runs."""
    spark.createDataFrame([Row(**figures)]).write.mode("append").json(path)


#: Entities of three sources with variants, noise and distractors, from `part`, in portable SQL.
FIXTURE = """
base AS (
  SELECT p_partkey AS k, p_name,
    substr('karimotevasobrne', CAST(1 + 2*(p_partkey % 8) AS INT), 2)
      || substr('lonadusipefogtul', CAST(1 + 2*(CAST(floor(p_partkey/8.0) AS INT) % 8) AS INT), 2)
      || substr('rantekmolvisdorx', CAST(1 + 2*(CAST(floor(p_partkey/64.0) AS INT) % 8) AS INT), 2)
      || substr('yakezoluhibadomi', CAST(1 + 2*(CAST(floor(p_partkey/512.0) AS INT) % 8) AS INT), 2) AS w,
    substr('parkmilllakehillgladwoodfernrose', CAST(1 + 4*(p_partkey % 8) AS INT), 4)
      || substr('sideviewgateford', CAST(1 + 4*(CAST(floor(p_partkey/3.0) AS INT) % 4) AS INT), 4) AS road,
    CAST((p_partkey*7) % 900 + 1 AS STRING) AS num,
    CAST(10000 + (p_partkey*37) % 80000 AS STRING) AS zip,
    CASE p_partkey % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'India' ELSE 'France' END AS country,
    CASE p_partkey % 5 WHEN 0 THEN ' Pvt Ltd' WHEN 1 THEN ' LLC' WHEN 2 THEN ' Inc' WHEN 3 THEN ' SARL' ELSE '' END AS lf,
    CASE p_partkey % 5 WHEN 0 THEN ' Private Limited' WHEN 1 THEN ', LLC' WHEN 2 THEN ' Incorporated' WHEN 3 THEN ' sarl' ELSE '' END AS lf2
  FROM part),
ents AS (
  SELECT 'S1-' || lpad(CAST(k AS STRING), 8, '0') AS entity_id, p_name || ' ' || w || lf AS business_name,
         num || ' ' || road || ' St, ' || zip AS business_address, country, CAST(NULL AS STRING) AS truth_s1 FROM base
  UNION ALL
  SELECT 'S2-' || lpad(CAST(k AS STRING), 8, '0'), upper(w) || ' ' || p_name || lf2,
         CASE WHEN k % 30 = 7 THEN NULL ELSE num || ' ' || road || ' Street ' || zip END, country,
         'S1-' || lpad(CAST(k AS STRING), 8, '0') FROM base WHERE k % 18 <> 0
  UNION ALL
  SELECT 'S3-' || lpad(CAST(k AS STRING), 8, '0'), 'www.' || w || '.com ' || replace(p_name, 'e', 'é'),
         CASE WHEN k % 30 = 11 THEN NULL ELSE 'Near ' || road || ' Rd ' || num END, country,
         'S1-' || lpad(CAST(k AS STRING), 8, '0') FROM base WHERE k % 18 <> 0 AND k % 4 <> 2
  UNION ALL
  SELECT 'S3-' || lpad(CAST(50000000 + k AS STRING), 8, '0'), replace(w, 'a', '') || ' ' || p_name || lf,
         num || ' ' || road || ' Street', country,
         'S1-' || lpad(CAST(k AS STRING), 8, '0') FROM base WHERE k % 18 <> 0 AND k % 3 = 0
  UNION ALL
  SELECT 'S2-' || lpad(CAST(90000000 + k AS STRING), 8, '0'), p_name || ' ' || w || lf,
         CAST((k*7) % 900 + 451 AS STRING) || ' ' || road || ' St, ' || CAST(10000 + (k*41) % 80000 AS STRING), country,
         CAST(NULL AS STRING) FROM base WHERE k % 4 = 1
  UNION ALL
  SELECT 'S3-' || lpad(CAST(60000000 + k AS STRING), 8, '0'), 'कमल ' || w || ' ' || p_name || ' ab',
         num || ' ' || road || ' plaza St, ' || zip, country,
         'S1-' || lpad(CAST(k AS STRING), 8, '0') FROM base WHERE k % 18 <> 0 AND k % 7 = 3
  UNION ALL
  SELECT 'S2-' || lpad(CAST(95000000 + k AS STRING), 8, '0'), p_name || ' ' || w, num || ' ' || road, CAST(NULL AS STRING),
         CAST(NULL AS STRING) FROM base WHERE k % 97 = 5
  UNION ALL
  SELECT 'S1-' || lpad(CAST(96000000 + k AS STRING), 8, '0'), 'Lone ' || w || ' GmbH', CAST(NULL AS STRING), CAST(NULL AS STRING),
         CAST(NULL AS STRING) FROM base WHERE k % 97 = 7)"""


def fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.read.parquet(f"{sf_dir}/part.parquet").createOrReplaceTempView("part")
    return spark.sql(f"WITH {FIXTURE} SELECT * FROM ents")


def fixture_links(entities: DataFrame) -> DataFrame:
    return entities.where("truth_s1 IS NOT NULL").select(F.col("truth_s1").alias("s1id"), F.col("entity_id").alias("cid"))
