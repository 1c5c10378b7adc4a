"""The driver's tables in the shapes that the operators take, as DataFrames and as SQL for the checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import number

#: Hours from the epoch to the start of the events, the zero of their ages.
ZERO = 473352


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series user_id, entity event_type, order (ts, event_id), proxies value and k, age in hours."""
    age = F.unix_micros(F.col("ts").cast("timestamp")) / 3600e6 - ZERO
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", number(F.get_json_object("props", "$.k")).alias("k"), age.alias("age"))


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as sites: sample counts are their orders and their open orders, places come from their keys."""
    counts = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("site_id")).agg(F.count("*").alias("n_d18o"), F.count(F.when(F.col("o_orderstatus") == "O", 1)).alias("n_d13c"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("site_id"), F.col("c_name").alias("site_name"), (F.col("c_custkey") % 360 - 180).cast("double").alias("lon"), (F.col("c_custkey") % 180 / 2.0 - 45).alias("lat"))
    wkt = F.format_string("POINT(%.4f %.4f)", "lon", "lat")
    return c.join(counts, "site_id", "left").withColumn("wkt", F.when(F.col("site_id") % 3 == 0, F.concat(F.lit("  "), wkt)).otherwise(wkt))


EV = f"""ev AS (SELECT event_id, ts, user_id, event_type, value, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
  epoch_us(ts) / 3600e6 - {ZERO} AS age FROM events)"""
SITES = """counts AS (SELECT o_custkey, count(*) AS n_d18o, count(*) FILTER (WHERE o_orderstatus = 'O') AS n_d13c FROM orders GROUP BY 1),
places AS (SELECT c_custkey AS site_id, c_name AS site_name, (c_custkey % 360 - 180)::DOUBLE AS lon, c_custkey % 180 / 2.0 - 45 AS lat, n_d18o, n_d13c
  FROM customer LEFT JOIN counts ON c_custkey = o_custkey),
sites AS (SELECT *, CASE WHEN site_id % 3 = 0 THEN '  ' ELSE '' END || printf('POINT(%.4f %.4f)', lon, lat) AS wkt FROM places)"""
