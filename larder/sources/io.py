"""Reading and writing tables, and the checks made while doing so."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.fixed import CONTRACTS, RAW_SCHEMAS


MALFORMED = "_malformed"  # the text of a CSV line that does not fit its schema
QUARANTINE = "n_copies BIGINT, record STRING, table_name STRING, rule STRING"


def raw_path(root: str, table: str) -> str:
    """Order lines arrive as one file per month in a folder, every other table as one file."""
    return f"{root}/order_items" if table == "order_items" else f"{root}/{table}.csv"


def read_raw(spark: SparkSession, root: str, table: str, malformed: str | None = None) -> DataFrame:
    """Scan a raw CSV table with its declared schema (no inference pass).

    Values that do not fit the schema are NULL. With ``malformed`` a column of that name holds the whole line where
    that happened, or where a line has too many or too few fields, and NULL elsewhere; all columns are then parsed.
    """
    schema, reader = RAW_SCHEMAS[table], spark.read.option("header", True)
    if malformed:
        schema = f"{schema}, {malformed} STRING"
        reader = reader.option("columnNameOfCorruptRecord", malformed).option("columnPruning", False)
    if table == "order_items":
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv*")
    return reader.schema(schema).csv(raw_path(root, table))


def read_all_raw(spark: SparkSession, root: str, malformed: str | None = None) -> dict[str, DataFrame]:
    return {table: read_raw(spark, root, table, malformed) for table in RAW_SCHEMAS}


def write_quarantine(rejects: DataFrame, path: str, table_name: str) -> None:
    """Keep the rejected rows of a table (columns first_failed_rule, n_copies) in a folder per table and rule.

    A row is kept as JSON text, a malformed line as it was read, so tables of any shape lie side by side. Writing a
    table again replaces all of its rows, those of rules that no longer reject any included, and no other table's.
    """
    fields = [c for c in rejects.columns if c not in ("first_failed_rule", "n_copies", MALFORMED)]
    record = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    if MALFORMED in rejects.columns:
        record = F.coalesce(F.col(MALFORMED), record)
    (rejects.select("n_copies", record.alias("record"), F.col("first_failed_rule").alias("rule"))
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("rule")
     .parquet(f"{path}/table_name={table_name}"))


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """All quarantined rows; conditions on table_name and rule choose the folders that are read."""
    return spark.read.schema(QUARANTINE).parquet(path)


def ingest_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per column of every table: table, column, type and the table's row count."""
    def profile(name: str, frame: DataFrame) -> DataFrame:
        columns = F.array(*[
            F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                     F.lit(f.dataType.simpleString()).alias("column_type"))
            for i, f in enumerate(frame.schema)])
        return (frame.agg(F.count(F.lit(1)).alias("n_rows"))
                .select(F.lit(name).alias("table_name"), F.inline(columns), "n_rows"))
    return union_all([profile(n, f) for n, f in tables.items()])


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def write_parquet(frame: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = frame.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_csv(frame: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Export a result as CSV part files with a header, written by the executors."""
    writer = frame.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path, header=True)


def write_and_verify(frame: DataFrame, path: str, name: str) -> DataFrame:
    """Write, reload and compare counts. The written count is observed during the write."""
    seen = Observation(f"rows of {name}")
    write_parquet(frame.observe(seen, F.count(F.lit(1)).alias("n")), path)
    written = F.lit(seen.get["n"]).cast("bigint")
    return (frame.sparkSession.read.parquet(path).agg(F.count(F.lit(1)).alias("reloaded"))
            .select(F.lit(name).alias("table_name"), written.alias("written"), "reloaded",
                    (written == F.col("reloaded")).alias("ok")))


def read_cases(spark: SparkSession, path: str, item_pattern: str = "M%") -> DataFrame:
    """Named cases of a truth file: its top-level text entries that look like item ids."""
    truth = spark.read.json(path, multiLine=True)
    names = [f.name for f in truth.schema if isinstance(f.dataType, T.StringType)]
    return (truth.select(*names).unpivot([], names, "case_name", "item_id")
            .filter(F.col("item_id").like(item_pattern)))


def require_columns(frame: DataFrame, required: list[str]) -> DataFrame:
    """Return the frame unchanged, or raise with the names it lacks."""
    missing = [c for c in required if c not in frame.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; present: {frame.columns}")
    return frame


def require_contract(frame: DataFrame, name: str) -> DataFrame:
    return require_columns(frame, CONTRACTS[name])


def row_minimums(tables: dict[str, DataFrame], minimums: dict[str, int]) -> DataFrame:
    """Row count of each table against the least number it should have."""
    return union_all([
        tables[name].agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(name).alias("table_name"), "n_rows", F.lit(least).cast("bigint").alias("minimum"),
                (F.col("n_rows") >= least).alias("passed"))
        for name, least in minimums.items()])
