"""Tables: reading, listing, profiling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Standard SQL spellings of the type names.
_SQL_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
              "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def sql_type(kind: T.DataType) -> str:
    if isinstance(kind, T.ArrayType):
        return sql_type(kind.elementType) + "[]"
    name = kind.simpleString()
    return _SQL_NAMES.get(name, name.upper())


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Names in order: the stored tables of ``database``, or all tables and views in reach."""
    if database:
        found = spark.sql(f"SHOW TABLES IN {database}").where("NOT isTemporary")
    else:
        found = spark.sql("SHOW TABLES")
    return found.select(F.col("tableName").alias("table_name")).orderBy("table_name")


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per column: position, name, type, nullable, default, and the table's row count."""
    out = None
    for name, df in tables.items():
        fields = F.array(*[
            F.struct(
                F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                F.lit(sql_type(f.dataType)).alias("data_type"), F.lit("YES" if f.nullable else "NO").alias("nullable"),
                F.lit(f.metadata.get("CURRENT_DEFAULT")).cast("string").alias("column_default"),
            )
            for i, f in enumerate(df.schema.fields, 1)
        ])
        one = df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), F.explode(fields).alias("f"), "row_count"
        ).select("table_name", "f.*", "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def read_database_table(
    spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, partitions: int, **options: str
) -> DataFrame:
    """A table of an external database, read in parallel ranges of a numeric column."""
    return spark.read.jdbc(
        url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=partitions, properties=options
    )


def write_database_table(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    df.write.jdbc(url, table, mode=mode, properties=options)
