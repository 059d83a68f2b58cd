"""Postings seen through the given star-schema tables.

``postings`` reads only the tables that hold a requested column: with left
joins on unique keys, leaving a join out cannot change the other columns.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2001-09-01 06:00:00"

_FROM_CUSTOMER = {"title", "category", "company_name", "city", "region", "short_description"}
_FROM_NATION = {"city", "region"}
_FROM_REGION = {"region"}

POSTING_COLUMNS = [
    "id", "platform", "title", "company_name", "city", "region", "country", "is_remote", "job_type", "category",
    "salary_min", "salary_max", "salary_currency", "published_date", "scraped_date", "url", "short_description",
    "has_salary_info", "is_featured", "is_new",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def postings(spark: SparkSession, sf_dir: str, columns: Iterable[str] = POSTING_COLUMNS) -> DataFrame:
    wanted = list(columns)
    key = F.col("o_orderkey")
    df = table(spark, sf_dir, "orders")
    if _FROM_CUSTOMER & set(wanted):
        df = df.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    if _FROM_NATION & set(wanted):
        df = df.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    if _FROM_REGION & set(wanted):
        df = df.join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    price = F.col("o_totalprice")
    exprs = {
        "id": key.cast("string"),
        "platform": F.when(F.col("o_orderstatus") == "F", "site_a")
        .when(F.col("o_orderstatus") == "O", "site_b")
        .otherwise("site_c"),
        "title": F.concat(F.col("c_mktsegment"), F.lit(" role "), key.cast("string")),
        "company_name": F.col("c_name"),
        "city": F.when(key % 17 != 0, F.col("n_name")),
        "region": F.when(key % 5 != 0, F.col("r_name")),
        "country": F.lit("Georgia"),
        "is_remote": F.col("o_orderpriority") == "1-URGENT",
        "job_type": F.lower(F.substring("o_orderpriority", 3, 20)),
        "category": F.col("c_mktsegment"),
        "salary_min": F.when(key % 3 != 0, price.cast("decimal(10,2)")),
        "salary_max": F.when(key % 4 != 0, (price + 1000).cast("decimal(10,2)")),
        "salary_currency": F.when(key % 7 != 0, F.lit("GEL")),
        "published_date": F.col("o_orderdate"),
        "scraped_date": F.col("o_orderdate") + F.make_dt_interval((key % 45).cast("int")),
        "url": F.concat(F.lit("/announcement/"), key.cast("string"), F.lit("/x")),
        "short_description": F.concat(F.col("c_mktsegment"), F.lit(" "), F.col("c_name")),
        "has_salary_info": key % 3 != 0,
        "is_featured": key % 11 == 0,
        "is_new": key % 13 == 0,
    }
    return df.select(*[exprs[name].alias(name) for name in wanted])


# The same view in SQL, for checking results with another engine.
POSTINGS_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS id,
       CASE o_orderstatus WHEN 'F' THEN 'site_a' WHEN 'O' THEN 'site_b' ELSE 'site_c' END AS platform,
       c_mktsegment || ' role ' || CAST(o_orderkey AS VARCHAR) AS title,
       c_name AS company_name,
       CASE WHEN o_orderkey % 17 <> 0 THEN n_name END AS city,
       CASE WHEN o_orderkey % 5 <> 0 THEN r_name END AS region,
       'Georgia' AS country,
       o_orderpriority = '1-URGENT' AS is_remote,
       lower(substr(o_orderpriority, 3, 20)) AS job_type,
       c_mktsegment AS category,
       CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_totalprice AS DECIMAL(10,2)) END AS salary_min,
       CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_totalprice + 1000 AS DECIMAL(10,2)) END AS salary_max,
       CASE WHEN o_orderkey % 7 <> 0 THEN 'GEL' END AS salary_currency,
       o_orderdate AS published_date,
       o_orderdate + to_days(CAST(o_orderkey % 45 AS INTEGER)) AS scraped_date,
       '/announcement/' || CAST(o_orderkey AS VARCHAR) || '/x' AS url,
       c_mktsegment || ' ' || c_name AS short_description,
       o_orderkey % 3 <> 0 AS has_salary_info,
       o_orderkey % 11 = 0 AS is_featured,
       o_orderkey % 13 = 0 AS is_new
FROM orders
LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey
"""
