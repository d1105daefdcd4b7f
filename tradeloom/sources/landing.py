"""Landing: a folder of CSV files as typed raw tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tradeloom.schemas import RAW_DDL, raw_schema

# Tables with free text that may hold line breaks inside quotes. Such files cannot
# be split, so large deliveries of them should come as many files in one folder.
FREE_TEXT_TABLES = {"order_reviews"}


def csv_paths(spark: SparkSession, folder: str) -> dict[str, str]:
    """Every `*.csv` entry of the folder by its name without the ending.

    An entry may itself be a folder of part files.
    """
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/*.csv")
    system = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found = system.globStatus(pattern) or []
    paths = [status.getPath() for status in found]
    return {path.getName().removesuffix(".csv"): path.toString() for path in paths}


# Holds the text of a row that does not fit the header.
MALFORMED = "_malformed"


def csv_rows(spark: SparkSession, path: str, name: str, mode: str) -> DataFrame:
    """All columns of a CSV table as text, named by the header of its files.

    Every part file must have the same header in the same order; another one is an
    error, since Spark assigns columns by position.
    """
    reader = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", name in FREE_TEXT_TABLES)
    )
    header = reader.csv(path).columns
    kept = [MALFORMED] if mode == "PERMISSIVE" else []
    schema = StructType([StructField(column, StringType()) for column in [*header, *kept]])
    return (
        reader.schema(schema)
        .option("enforceSchema", False)
        .option("columnPruning", False)
        .option("mode", mode)
        .option("columnNameOfCorruptRecord", MALFORMED)
        .csv(path)
    )


def fits(rows: DataFrame) -> Column:
    """Whether a row fits the header: nothing malformed is added to its first cell.

    Spark refuses to read the malformed text alone, so another column takes part.
    """
    first = F.col(f"`{rows.columns[0]}`")
    return F.concat_ws("", first, MALFORMED) == F.coalesce(first, F.lit(""))


def read_csv_table(
    spark: SparkSession, path: str, name: str, malformed: str = "fail"
) -> DataFrame:
    """One CSV table with all columns of the delivery.

    Declared columns get their declared types, the others stay text; a declared column
    that is missing is an error. Empty text is null, as in the raw layer. A row with
    too few or too many cells fails the read, or is left out with `malformed="skip"`,
    to be kept by `malformed_rows`.
    """
    text = csv_rows(spark, path, name, "FAILFAST" if malformed == "fail" else "PERMISSIVE")
    if malformed != "fail":
        text = text.where(fits(text)).drop(MALFORMED)
    kinds = {f.name: f.dataType for f in raw_schema(name).fields} if name in RAW_DDL else {}
    missing = [column for column in kinds if column not in text.columns]
    if missing:
        raise ValueError(f"{path} lacks declared columns {missing}")
    return text.select(
        *[
            F.nullif(F.col(f"`{column}`"), F.lit(""))
            .cast(kinds.get(column, StringType()))
            .alias(column)
            for column in text.columns
        ]
    )


def malformed_rows(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The rows of a CSV table that do not fit its header, as text, for the error layer."""
    rows = csv_rows(spark, path, name, "PERMISSIVE")
    return rows.where(~fits(rows)).select(
        F.lit(name).alias("TABLE_NAME"), F.col(MALFORMED).alias("RECORD")
    )


def table_name(stem: str, prefix: str, suffix: str) -> str:
    """The table name in a file name with a common prefix and suffix around it."""
    return stem.removeprefix(prefix).removesuffix(suffix)


def read_csv_folder(
    spark: SparkSession, folder: str, prefix: str = "", suffix: str = "", malformed: str = "fail"
) -> dict[str, Callable[[], DataFrame]]:
    """Openers for every CSV table of a folder, such as `shop_orders_dataset.csv`."""
    return {
        table_name(stem, prefix, suffix): partial(
            read_csv_table, spark, path, table_name(stem, prefix, suffix), malformed
        )
        for stem, path in csv_paths(spark, folder).items()
    }


def malformed_in_folder(
    spark: SparkSession, folder: str, prefix: str = "", suffix: str = ""
) -> dict[str, DataFrame]:
    """The malformed rows of every CSV table of a folder, by table name."""
    return {
        name: malformed_rows(spark, path, name)
        for stem, path in csv_paths(spark, folder).items()
        for name in [table_name(stem, prefix, suffix)]
    }
