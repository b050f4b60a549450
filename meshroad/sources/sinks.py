"""Writers and readers of the yearly output."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meshroad.plans.enrich import OUTPUT_SCHEMA
from meshroad.plans.validate import totals
from meshroad.sources.csv import file_columns, plain_path, read_csv_text


YEAR_FOLDER = r"file_year=(-?\d+)"
STATE_FOLDER = r"state=([^/]+)/"
YEAR_FILE = r"Cleaned_Data_(\d+)\.csv$"


def write_yearly(
    out: DataFrame, path: str, *, fmt: str = "parquet", max_records_per_file: int = 20_000_000, compact: bool = True
) -> None:
    """One folder `file_year=<year>` per crash year, below `state=<state>` if there is a state; the year stays in the rows too.

    Only the folders that get rows are replaced, so a rerun of one year or state leaves the others. Rows are first
    rebalanced by year, which joins small files and splits big years over several tasks; without `compact` they are
    written where they are, which saves the shuffle and may write a file for each task and year.
    """
    folders = [*(["state"] if "state" in out.columns else []), "file_year"]
    tagged = out.withColumn("file_year", F.col("Crash_Year"))
    if compact:
        tagged = tagged.hint("rebalance", *folders)
    writer = (tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders)
              .option("maxRecordsPerFile", max_records_per_file))
    if fmt == "csv":
        writer.options(header=True, escape='"').csv(path)
    else:
        writer.format(fmt).save(path)


def typed_output(rows: DataFrame) -> DataFrame:
    """Columns of the output with their types, from text; what does not fit is null. Other columns stay as they are."""
    return rows.withColumns({c: F.col(c).try_cast("double").try_cast(t) if t in ("int", "bigint") else F.col(c).try_cast(t)
                             for c, t in OUTPUT_SCHEMA.items() if c in rows.columns and dict(rows.dtypes)[c] != t})


def read_yearly(spark: SparkSession, path: str, schema=None, fmt: str = "parquet", merge_schema: bool = False) -> DataFrame:
    """All years with the folder's year as `file_year`; with parquet a filter on it prunes folders.

    CSV files are read each by its own header and typed. `merge_schema` is for parquet years with different columns.
    """
    if fmt == "csv":
        folders = _year_folders(spark, path)
        rows = read_csv_text(spark, [f"{d}/*" for d in folders], file_column="_file")
        rows = rows.withColumn("file_year", F.regexp_extract("_file", YEAR_FOLDER, 1).try_cast("int"))
        if any(re.search(STATE_FOLDER, f"{d}/") for d in folders):
            rows = rows.withColumn("state", _folder_value("_file", STATE_FOLDER))
        return typed_output(rows.drop("_file"))
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("mergeSchema", merge_schema).parquet(path)


def _year_folders(spark: SparkSession, path: str) -> list[str]:
    files = spark.read.option("recursiveFileLookup", True).text(path).inputFiles()
    return sorted({plain_path(f.rpartition("/")[0]) for f in files if re.search(YEAR_FOLDER, f)})


def _folder_value(file: str, pattern: str) -> Column:
    """What the folder of a file says: written with its odd characters escaped, and escaped again in the file's URI."""
    value = F.regexp_extract(file, pattern, 1)
    for _ in range(2):
        value = F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))
    return value


def read_yearly_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Files named `Cleaned_Data_<year>.csv`, each read by its own header and typed; other names are left out."""
    rows = read_csv_text(spark, _year_files(spark, folder), file_column="_file")
    return typed_output(rows.withColumn("file_year", F.regexp_extract("_file", YEAR_FILE, 1).try_cast("int")).drop("_file"))


def _year_files(spark: SparkSession, folder: str) -> list[str]:
    files = spark.read.option("pathGlobFilter", "Cleaned_Data_*.csv").text(folder).inputFiles()
    return [plain_path(f) for f in files if re.search(YEAR_FILE, f)]


def yearly_columns(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """`file_year`, `column`: what each year's own headers or footer hold.

    `fmt` is "parquet" or "csv" for folders of `write_yearly`, "files" for files `Cleaned_Data_<year>.csv`.
    """
    if fmt == "parquet":
        found = [(int(re.search(YEAR_FOLDER, d)[1]), c) for d in _year_folders(spark, path) for c in spark.read.parquet(d).columns]
        return spark.createDataFrame(sorted(set(found)), "file_year long, column string")
    files = file_columns(spark, _year_files(spark, path) if fmt == "files" else [f"{d}/*" for d in _year_folders(spark, path)])
    year = F.regexp_extract("file", YEAR_FILE if fmt == "files" else YEAR_FOLDER, 1).cast("long")
    return files.select(year.alias("file_year"), F.explode("names").alias("column")).distinct()


def write_validation(results: DataFrame, path: str) -> DataFrame:
    """Write the result rows and return the pass and fail totals."""
    results.select("status", "validation", "passed", "msg").write.mode("overwrite").options(header=True, escape='"').csv(path)
    return totals(results)


def read_validation(spark: SparkSession, path: str) -> DataFrame:
    """The written result rows, typed."""
    return read_csv_text(spark, f"{path}/*.csv").withColumn("passed", F.col("passed").try_cast("boolean"))
