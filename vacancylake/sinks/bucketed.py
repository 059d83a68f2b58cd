"""Tables stored in buckets of their key, for upserts and joins that leave the stored rows where they are.

A bucketed table is a catalog table over a folder. Tables are written once and never in place: a new version goes to a new name
and folder, as with every stored table here. The catalog of a session without a metastore forgets the table; ``open_bucketed`` names it
again from the folder alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BUCKETS = 64


def _quoted(names: list[str]) -> str:
    return ", ".join(f"`{n}`" for n in names)


def write_bucketed(df: DataFrame, name: str, path: str, key: list[str], buckets: int = BUCKETS, dealt: bool = False) -> DataFrame:
    """Write ``df`` as table ``name`` under ``path``, one file per bucket, and return the table.

    ``dealt`` says that rows already lie by bucket, as what ``upsert_bucketed`` returns for a table of as many buckets does; then
    nothing is shuffled. It only decides the number of files: rows go to their buckets either way.
    """
    laid_out = df if dealt else df.repartition(buckets, *key)
    laid_out.write.mode("errorifexists").format("parquet").option("path", path).bucketBy(buckets, *key).saveAsTable(name)
    return df.sparkSession.table(name)


def open_bucketed(spark: SparkSession, name: str, path: str, key: list[str], buckets: int = BUCKETS) -> DataFrame:
    """The table ``name`` over the bucketed files that are already under ``path``."""
    if not spark.catalog.tableExists(name):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY ({_quoted(key)}) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def forget(spark: SparkSession, name: str) -> None:
    """Take the table out of the catalog; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
