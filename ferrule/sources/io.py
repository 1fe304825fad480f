"""Sources and sinks: CSV with an explicit schema, catalog tables, JDBC, Parquet, JSON rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ferrule.sources.scope import exists, table_path

__all__ = ["read_csv", "load_csv", "read_csv_tables", "read_table", "read_jdbc", "with_row_id",
           "to_json_rows", "write_json_rows", "materialize"]


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Header CSV with double-quoted fields (commas inside quotes allowed) and ISO dates.

    The schema is always explicit: no inference pass over the files, stable types.
    """
    return (spark.read.option("header", True).option("quote", '"').option("escape", '"')
            .option("dateFormat", "yyyy-MM-dd").option("mode", "FAILFAST").schema(schema).csv(path))


def load_csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a CSV that may hold bad lines: the typed rows, and a quarantine of the raw lines.

    A line is rejected as a whole if a value does not parse as its type or the number of fields is wrong; it never
    becomes a row of NULLs.  Both parts come from one read, whose result is stored (``rejects`` is the column
    ``line``), so a file is parsed once however often they are used.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    # every column nullable while it is read: a NOT NULL declaration would turn a missing value into a default
    fields = [StructField(f.name, f.dataType, True) for f in schema.fields]
    raw = (spark.read.option("header", header).option("quote", '"').option("escape", '"').option("dateFormat", "yyyy-MM-dd")
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line")
           .schema(StructType([*fields, StructField("_line", StringType(), True)])).csv(path))
    kept = materialize(raw)
    return kept.where("_line is null").drop("_line"), kept.where("_line is not null").select(F.col("_line").alias("line"))


def read_csv_tables(spark: SparkSession, folder: str, names: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """``{name: read_csv(f'{folder}/{name}.csv', SCHEMAS[name])}`` for the declared tables present, in any store.

    File readers make every column nullable, so the NOT NULL declarations are checked afterwards
    with ``ferrule.operators.quality.null_counts`` (one pass per table).
    """
    from ferrule.sources.schemas import SCHEMAS

    out = {}
    for n in (names or SCHEMAS):
        path = f"{folder.rstrip('/')}/{n}.csv"
        if names is not None or exists(spark, path):
            out[n] = read_csv(spark, path, SCHEMAS[n])
    return out


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, possibly catalog-qualified (``catalog.schema.table``)."""
    return spark.table(name)


def read_jdbc(spark: SparkSession, url: str, table: str, part_col: str | None = None,
              n: int | None = None, lower: int | None = None, upper: int | None = None,
              properties: dict | None = None) -> DataFrame:
    """External database table.  With ``part_col`` the read is split into ``n`` parallel range
    queries between ``lower`` and ``upper`` instead of a single connection.  Needs the JDBC
    driver jar on the classpath."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if part_col is not None:
        r = (r.option("partitionColumn", part_col).option("numPartitions", n or 8)
             .option("lowerBound", lower).option("upperBound", upper))
    return r.load()


def with_row_id(df: DataFrame, name: str = "id") -> DataFrame:
    """Surrogate id: unique and increasing within a partition, not dense (no shuffle, no sort)."""
    return df.withColumn(name, F.monotonically_increasing_id())


def to_json_rows(df: DataFrame, name: str = "json") -> DataFrame:
    """One JSON object per row, NULL fields kept as ``null`` (Spark drops them by default)."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias(name))


def write_json_rows(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Distributed JSON-lines sink; every executor writes its own part files."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def materialize(df: DataFrame, *partition_cols: str) -> DataFrame:
    """Materialise an intermediate that later steps read several times (a temp table).

    Written once as Parquet into the shared ``spark.checkpoint.dir`` and read back: the lineage is cut, the table
    survives executor loss, nothing stays cached, and later reads get column pruning and filter pushdown.  The table
    belongs to the enclosing ``Intermediates`` block and is deleted with it (``ferrule.sources.scope``).
    """
    spark = df.sparkSession
    path = table_path(spark, "table")
    (df.repartition(*partition_cols) if partition_cols else df).write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
