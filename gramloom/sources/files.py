"""Methods in CSV, Parquet and text files.

Files carry no method id, so readers number the rows in the order of file path
and place in the file, whatever tasks read them.  The first thing to do with a large CSV file is `ingest`: quoted line breaks keep
Spark from splitting it, while the table it is copied to splits anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gramloom.functions.lexer import WHITESPACE_CHARACTERS
from gramloom.operators.corpus import tokenize_methods
from gramloom.plans.scratch import write_table

# Column names of the files.
PROCESSED_COLUMN = "Method Code No Comments"
EXTRACTED_COLUMNS = {
    "branch": "Branch Name",
    "commit_hash": "Commit Hash",
    "file_name": "File Name",
    "method_name": "Method Name",
    "method_code": "Method Code",
    "commit_link": "Commit Link",
}
REPOSITORY_COLUMNS = ("name", "defaultBranch", "mainLanguage")

FORMATS = ("csv", "parquet")

_FILE, _BLOCK, _ORDER = "_file", "_block", "_order"

_CSV = {"header": True, "quote": '"', "escape": '"'}
_CSV_READ = {**_CSV, "multiLine": True}
_CSV_WRITE = {**_CSV, "quoteAll": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A header CSV file whose quoted fields may hold line breaks; all columns are strings."""
    return spark.read.options(**_CSV_READ).csv(path)


def read_any(spark: SparkSession, path: str, file_format: str = "csv") -> DataFrame:
    """A CSV or Parquet source under its own column names."""
    _check_format(file_format)
    return read_csv(spark, path) if file_format == "csv" else spark.read.parquet(path)


def write_any(frame: DataFrame, path: str, file_format: str = "csv") -> None:
    _check_format(file_format)
    writer = frame.write.mode("overwrite")
    if file_format == "csv":
        writer.options(**_CSV_WRITE).csv(path)
    else:
        writer.parquet(path)


def _check_format(file_format: str) -> None:
    if file_format not in FORMATS:
        raise ValueError(f"unknown format {file_format!r}: give one of {FORMATS}")


def resolve_code_column(columns: list[str]) -> str:
    """`Method Code`, else `method_code`, else the first column with `code` in its name."""
    for name in ("Method Code", "method_code"):
        if name in columns:
            return name
    for name in columns:
        if "code" in name.lower():
            return name
    raise ValueError(f"no column with method code among {columns}")


def _with_place(frame: DataFrame) -> DataFrame:
    """Rows of a file source with the file and the block of it that they were read from."""
    return frame.select("*", F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.file_block_start").alias(_BLOCK))


def read_methods(spark: SparkSession, path: str, file_format: str = "csv") -> DataFrame:
    """`method_id, code` from any methods file."""
    frame = read_any(spark, path, file_format)
    code = resolve_code_column(frame.columns)
    return ingest(_with_place(frame).select(F.col(f"`{code}`").alias("code"), _FILE, _BLOCK))


def read_methods_csv(spark: SparkSession, path: str) -> DataFrame:
    """`method_id, code` from any methods CSV file."""
    return read_methods(spark, path)


def ingest(placed: DataFrame) -> DataFrame:
    """Copy placed rows to a splittable table and number them from 0.

    A task reads a block of a file in order, so a row's number is the rows of all
    blocks before its own, from one count per block, and its distance from
    the block's first row.  How files are cut into blocks and dealt to tasks does not matter.
    """
    table = write_table(placed.withColumn(_ORDER, F.monotonically_increasing_id()), "ingested")
    place = [_FILE, _BLOCK]
    blocks = table.groupBy(*place).agg(F.min(_ORDER).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*place, "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    number = F.col(_ORDER) - F.col("_first") + F.col("_before")
    values = [c for c in placed.columns if c not in place]
    return table.join(blocks, place).select(number.alias("method_id"), *values)


def read_processed(
    spark: SparkSession, path: str, code: str = PROCESSED_COLUMN, file_format: str = "csv"
) -> DataFrame:
    """Tokenised methods `method_id, tokens` from a processed file; nulls and empty ones dropped."""
    frame = read_any(spark, path, file_format)
    if code not in frame.columns:
        raise ValueError(f"missing column {code!r}")
    rows = _with_place(frame).select(F.col(f"`{code}`").alias("code"), _FILE, _BLOCK)
    return tokenize_methods(ingest(rows.na.drop(subset=["code"])))


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """`method_id, code` from a text file with one method per line; blank lines dropped."""
    trimmed = F.btrim("value", F.lit(WHITESPACE_CHARACTERS))
    rows = _with_place(spark.read.text(path)).select(trimmed.alias("code"), _FILE, _BLOCK)
    return ingest(rows.filter(F.length("code") > 0))


def read_text_methods(spark: SparkSession, path: str) -> DataFrame:
    """Tokenised methods `method_id, tokens` from a text file with one method per line."""
    return tokenize_methods(read_text_lines(spark, path))


def read_repositories(spark: SparkSession, path: str) -> DataFrame:
    """The repository list `name, defaultBranch, mainLanguage`."""
    return read_csv(spark, path).select(*REPOSITORY_COLUMNS)


def read_repository_list(spark: SparkSession, path: str) -> DataFrame:
    """The repository list with `listed`, each row's number in the list from 0."""
    rows = _with_place(read_csv(spark, path)).select(*REPOSITORY_COLUMNS, _FILE, _BLOCK)
    return ingest(rows).withColumnRenamed("method_id", "listed")


def write_processed(methods: DataFrame, path: str, file_format: str = "csv") -> None:
    """Cleaned methods with the one processed column."""
    write_any(methods.select(F.col("code").alias(PROCESSED_COLUMN)), path, file_format)


def write_extracted(methods: DataFrame, path: str, file_format: str = "csv") -> None:
    """Harvested methods under their published column names."""
    named = [F.col(column).alias(title) for column, title in EXTRACTED_COLUMNS.items()]
    write_any(methods.select(*named), path, file_format)
