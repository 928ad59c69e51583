"""Derived inputs of the registered queries: the same SELECT text runs in Spark and in DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)

VIEWS = {
    "events_m": """SELECT event_id, user_id,
  CASE WHEN event_id % 7 = 3 THEN NULL ELSE event_type END AS event_type,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS value
FROM {events}""",
    "orders_m": """SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderkey % 11 = 2 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 6 = 1 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
  CASE WHEN o_orderkey % 9 = 4 THEN NULL ELSE o_totalprice END AS o_totalprice
FROM {orders}""",
    "part_m": """SELECT p_partkey, p_name,
  CASE WHEN p_partkey % 13 = 5 THEN NULL ELSE p_brand END AS p_brand,
  CASE WHEN p_partkey % 8 = 1 THEN NULL ELSE p_type END AS p_type, p_size,
  CASE WHEN p_partkey % 5 = 2 THEN NULL ELSE p_retailprice END AS p_retailprice
FROM {part}""",
    "customer_geo": """SELECT c_custkey,
  CASE WHEN c_custkey % 4 = 1 THEN NULL ELSE r_name END AS r_name,
  CASE WHEN c_custkey % 10 = 3 THEN NULL ELSE n_name END AS n_name, c_acctbal
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "products": """SELECT k AS code,
 CASE k % 8 WHEN 0 THEN 'fruits and vegetables' WHEN 1 THEN 'cereals' WHEN 2 THEN 'meat' WHEN 3 THEN 'fish' WHEN 4 THEN 'dairy' WHEN 5 THEN 'beverages' WHEN 6 THEN 'composite foods' END AS grp,
 CASE k % 6 WHEN 0 THEN 'a' WHEN 1 THEN 'b' WHEN 2 THEN 'c' WHEN 3 THEN 'd' WHEN 4 THEN 'e' END AS grade,
 CASE WHEN k % 12 = 5 THEN NULL ELSE CAST(k * 7 % 56 - 15 AS DOUBLE) END AS fr_score,
 CASE WHEN k % 14 = 3 THEN NULL ELSE CAST(k * 7 % 56 - 15 + k % 3 - 1 AS DOUBLE) END AS uk_score,
 CASE WHEN k % 10 = 0 THEN NULL ELSE CAST(k * 41 % 1200 AS DOUBLE) END AS energy,
 CASE WHEN k % 17 = 2 THEN NULL WHEN k % 13 = 0 THEN 0e0 ELSE (k * 37 % 1000 - 5) / 10e0 END AS fat,
 CASE WHEN k % 4 = 0 THEN 0e0 ELSE (k * 53 % 800) / 10e0 END AS saturated_fat,
 CASE WHEN k % 15 = 0 THEN 0e0 ELSE (k * 71 % 1000) / 10e0 END AS carbohydrates,
 CASE WHEN k % 5 = 0 THEN 0e0 ELSE (k * 29 % 900) / 10e0 END AS sugars,
 CASE WHEN k % 9 = 1 THEN 0e0 WHEN k % 16 = 7 THEN NULL ELSE (k * 13 % 500) / 10e0 END AS proteins,
 CASE WHEN k % 19 = 4 THEN NULL WHEN k % 21 = 0 THEN 0e0 ELSE (k * 17 % 400) / 100e0 END AS sodium,
 CASE k % 3 WHEN 0 THEN (k * 17 % 400) / 100e0 * 2.5e0 WHEN 1 THEN NULL ELSE (k * 19 % 900) / 100e0 END AS salt
FROM (SELECT o_orderkey AS k FROM {orders}) t""",
    # Labels with spelling variants and rare members, from the free-text columns of `part`.
    "part_labels": """SELECT p_partkey,
  CASE WHEN p_partkey % 5 = 0 THEN upper(p_name) WHEN p_partkey % 7 = 0 THEN replace(p_name, ' ', '-') WHEN p_partkey % 3 = 1 THEN concat(p_name, 's') ELSE p_name END AS label,
  CASE WHEN p_partkey % 17 = 4 THEN 'unknown' WHEN p_partkey % 8 = 1 THEN NULL ELSE p_type END AS parent
FROM {part}""",
    # Case variants of a few clearly different labels.
    "type_spellings": """SELECT p_partkey, CASE WHEN p_partkey % 4 = 1 THEN lower(p_type) WHEN p_partkey % 9 = 2 THEN concat(p_type, '-') ELSE p_type END AS label
FROM {part}""",
    # Names whose words are swapped now and then.
    "swapped_names": """SELECT p_partkey, CASE WHEN p_partkey % 40 = 7 THEN concat(split_part(p_name, ' ', 2), ' ', split_part(p_name, ' ', 1)) WHEN p_partkey % 500 = 11 THEN 'zzzz' ELSE p_name END AS label
FROM {part}""",
    # A value that one other column determines in steps, beside one that has nothing to do with it.
    "part_steps": """SELECT p_partkey, CAST(p_partkey % 4 AS DOUBLE) * 25e0 AS tier, CAST(p_size AS DOUBLE) AS size,
  CASE WHEN p_partkey % 7 = 2 THEN NULL WHEN p_partkey % 4 = 0 THEN 10e0 WHEN p_partkey % 4 = 1 THEN 70e0 WHEN p_partkey % 4 = 2 THEN 20e0 ELSE 45e0 END AS step
FROM {part}""",
    # Three numeric features with gaps.
    "part_n": """SELECT p_partkey, CAST(p_size AS DOUBLE) AS size,
  CASE WHEN p_partkey % 5 = 2 THEN NULL ELSE p_retailprice END AS price,
  CASE WHEN p_partkey % 7 = 4 THEN NULL ELSE (p_partkey * 37 % 500) / 10e0 END AS weight
FROM {part}""",
    # The same features with a gappy label.
    "part_l": """SELECT p_partkey, CASE WHEN p_partkey % 8 = 1 THEN NULL ELSE p_type END AS p_type, CAST(p_size AS DOUBLE) AS size,
  CASE WHEN p_partkey % 5 = 2 THEN NULL ELSE p_retailprice END AS price,
  CASE WHEN p_partkey % 7 = 4 THEN NULL ELSE (p_partkey * 37 % 500) / 10e0 END AS weight
FROM {part}""",
    # 2-D points: account balances on one line per nation.
    "points": """SELECT c_custkey, c_acctbal AS x, c_nationkey * 1000e0 AS y FROM {customer}""",
    # Labels with a rule as prediction.
    "predicted": """SELECT event_id, event_type AS label, CASE WHEN event_id % 3 = 0 THEN 'click' WHEN event_id % 7 = 1 THEN 'other' ELSE event_type END AS prediction,
  value, value * 9e-1 + event_id % 5 AS guess FROM {events}""",
    # Two text fields of the orders, with gaps, as a combination to group.
    "order_labels": """SELECT o_orderkey, o_custkey % 3 AS a,
  CASE WHEN o_orderkey % 9 = 4 THEN NULL WHEN o_orderkey % 4 = 0 THEN lower(o_orderpriority) ELSE o_orderpriority END AS b,
  CASE WHEN o_orderkey % 11 = 2 THEN NULL ELSE o_orderstatus END AS c
FROM {orders}""",
    # Events with a unix time and a partly missing, partly wrong text time.
    "event_times": """SELECT event_id, event_id * 3600 + 1700000000 AS created_t,
  CASE WHEN event_id % 6 = 1 THEN NULL WHEN event_id % 10 = 7 THEN 'not a time' WHEN event_id % 15 = 2 THEN '2020-02-29T12:00:00Z' ELSE '2023-11-20T08:30:00Z' END AS created_datetime,
  value
FROM {events}""",
}

# Roles of the `products` view.
PRODUCT_ROLES = {
    "energy": "energy", "fat": "fat", "saturated_fat": "saturated_fat", "carbohydrates": "carbohydrates", "sugars": "sugars",
    "proteins": "proteins", "salt": "salt", "sodium": "sodium", "fr_score": "fr_score", "uk_score": "uk_score",
    "grade": "grade", "group": "grp",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived input over the parquet tables."""
    text = re.sub(r"\{(\w+)\}", lambda m: f"parquet.`{sf_dir}/{m.group(1)}.parquet`", VIEWS[name])
    return spark.sql(text)


def view_sql(name: str) -> str:
    """The same input for the SQL check, reading the tables by name."""
    return re.sub(r"\{(\w+)\}", lambda m: m.group(1), VIEWS[name])
