"""CSV sources. Every column is read as text; typing is left to the cleaning step.

Quotes follow RFC 4180: a doubled quote inside a quoted field is one quote.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshroad.config import StateConfig
from meshroad.operators.clean import rename_columns
from meshroad.operators.joins import union_all
from meshroad.session import BROADCAST_BYTES, materialize

CSV_OPTIONS = {"escape": '"', "mode": "PERMISSIVE"}
# Upper bound of one row of the table of files (a path and a few numbers), in bytes.
FILE_ROW_BYTES = 1024


def read_csv_text(
    spark: SparkSession, path: str | Sequence[str], *, preamble_lines: int = 0, bad_lines: str = "null", multi_line: bool = False,
    file_column: str | None = None,
) -> DataFrame:
    """All columns as strings, header names trimmed, `preamble_lines` skipped before the header of each file.

    Preamble and header are skipped by their place in the file, so an equal line further down is data. Each file
    is read by its own header; columns that a file lacks are null there. A blank header name becomes `_c<place>`, a
    repeated one gets its place as a suffix. A short line has nulls at its end. A line with too many fields keeps
    the first ones (`bad_lines="null"`) or is dropped (`"drop"`).

    The number of jobs does not depend on the number of files: the headers come from one pass over the lines, and files of
    one header are read together. `multi_line` lets quoted fields hold line breaks. A file is then read by one task, and
    cannot have a preamble. `file_column` names a column for the path of each row's file.
    """
    if preamble_lines and multi_line:
        raise ValueError("a file with a preamble is read line by line, so its fields cannot hold line breaks")
    heads = headers(spark, path, preamble_lines)
    lines = _different(heads)
    if not lines:
        raise ValueError(f"no header in {path}")
    names_of = dict(zip(lines, _header_names(spark, lines)))
    groups = list(dict.fromkeys(names_of.values()))
    if preamble_lines:
        return _read_lines(spark, path, heads, names_of, groups, preamble_lines, bad_lines, file_column)
    files_of: dict[tuple[str, ...], list[str]] = {}
    for r in heads.select("file", "header").collect():  # paths, as in the listing that any reader keeps
        files_of.setdefault(names_of[r.header], []).append(r.file)
    parts = []
    for names in groups:
        schema, overflow = _text_schema(names)
        rows = spark.read.schema(schema).options(header=True, enforceSchema=True, multiLine=multi_line, **CSV_OPTIONS).csv(
            [plain_path(f) for f in sorted(files_of[names])])
        if file_column:
            rows = rows.select("*", F.col("_metadata.file_path").alias(file_column))
        if bad_lines == "drop":
            rows = rows.filter(F.col(f"`{overflow}`").isNull())
        parts.append(rows.drop(overflow))
    return union_all(parts)


def plain_path(uri: str) -> str:
    """A listed file's name as a path to read: a listing writes it as a URI, a reader takes it as a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def _different(heads: DataFrame) -> list[str]:
    """The different header lines, by their first file; each becomes a part of the plan."""
    found = heads.groupBy("header").agg(F.min("file").alias("file")).collect()
    return [r.header for r in sorted(found, key=lambda r: (r.file, r.header))]


def _read_lines(spark: SparkSession, path, heads: DataFrame, names_of: dict, groups: list, preamble_lines: int, bad_lines: str,
                file_column: str | None) -> DataFrame:
    """Lines behind the headers, each parsed by the header of its file, in one pass over all files."""
    numbered = spark.createDataFrame([(line, groups.index(names)) for line, names in names_of.items()], "header string, _group int")
    starts = heads.join(F.broadcast(numbered), "header").select(F.col("file").alias("_file"), "first", "_group")  # one row for each part of the plan
    small = heads.count() * FILE_ROW_BYTES <= BROADCAST_BYTES
    rows = _lines(spark, path).join(F.broadcast(starts) if small else starts.hint("shuffle_merge"), "_file").filter(
        ~F.col("_front") | (F.col("_line") > F.col("first") + preamble_lines)).filter("trim(value) <> ''")
    schemas = [_text_schema(names) for names in groups]
    rows = rows.select("_file", *[F.when(F.col("_group") == k, F.from_csv("value", schema, CSV_OPTIONS)).alias(f"r{k}") for k, (schema, _) in enumerate(schemas)])
    if bad_lines == "drop":
        for k, (_, overflow) in enumerate(schemas):
            rows = rows.filter(F.col(f"r{k}.`{overflow}`").isNull())
    columns: dict[str, list] = {}
    for k, names in enumerate(groups):
        for n in names:
            columns.setdefault(n, []).append(F.col("r{}.`{}`".format(k, n.replace("`", "``"))))
    out = [F.coalesce(*found).alias(n) for n, found in columns.items()]
    return rows.select(*out, *([F.col("_file").alias(file_column)] if file_column else []))


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """All lines with their file, whether they are in its first split, and a number that grows within each split.

    Every pass over the same files cuts them in the same way, so the numbers are the same in each.
    """
    return spark.read.option("recursiveFileLookup", True).text(path).select(  # folder names are no columns
        "value", F.col("_metadata.file_path").alias("_file"), (F.col("_metadata.file_block_start") == 0).alias("_front"),
        F.monotonically_increasing_id().alias("_line"))


def headers(spark: SparkSession, path: str | Sequence[str], preamble_lines: int = 0) -> DataFrame:
    """`file`, `first` (the number of its first line) and `header` (its header line) of each file that has one.

    A file's first line is a minimum over its first split, which combines within the tasks; with a preamble, a second pass
    takes the line that stands that far behind it.
    """
    front = _lines(spark, path).filter("_front")
    if not preamble_lines:
        first = front.groupBy(F.col("_file").alias("file")).agg(F.min(F.struct("_line", "value")).alias("h"))
        return materialize(first.select("file", F.col("h._line").alias("first"), F.col("h.value").alias("header")), "csv-headers")
    first = materialize(front.groupBy("_file").agg(F.min("_line").alias("first")), "csv-first-lines")
    small = first.count() * FILE_ROW_BYTES <= BROADCAST_BYTES
    found = front.join(F.broadcast(first) if small else first.hint("shuffle_merge"), "_file").filter(F.col("_line") == F.col("first") + preamble_lines)
    return materialize(found.select(F.col("_file").alias("file"), "first", F.col("value").alias("header")), "csv-headers")


def file_columns(spark: SparkSession, path: str | Sequence[str], preamble_lines: int = 0) -> DataFrame:
    """`file`, `names`: the header names of each file, in the order of the file; no other line is parsed."""
    heads = headers(spark, path, preamble_lines)
    lines = _different(heads)
    named = spark.createDataFrame([(line, list(names)) for line, names in zip(lines, _header_names(spark, lines))], "header string, names array<string>")
    return heads.join(named, "header").select("file", "names")


def csv_columns(spark: SparkSession, path: str, preamble_lines: int = 0) -> DataFrame:
    """Header names with their positions, the input of name matching; no data line is parsed.

    With several headers a name has its first position in any of them, in the order of the files.
    """
    placed = file_columns(spark, path, preamble_lines).select("file", F.posexplode("names").alias("position", "name"))
    return placed.groupBy("name").agg(F.min("position").alias("position"))


def _header_names(spark: SparkSession, lines: Sequence[str]) -> list[tuple[str, ...]]:
    """Column names of header lines, all parsed in one job."""
    if not lines:
        return []
    most = max(line.count(",") for line in lines) + 1
    schema = ", ".join(f"c{i} string" for i in range(most))
    rows = spark.createDataFrame(list(enumerate(lines)), "place int, line string").select("place", F.from_csv("line", schema, CSV_OPTIONS).alias("r")).collect()
    return [_names([r.r[i] for i in range(most)], lines[r.place]) for r in sorted(rows)]


def _names(values: Sequence[str | None], line: str) -> tuple[str, ...]:
    fields = [v.strip() if v is not None else "" for v in values[:line.count(",") + 1]]
    while len(fields) > max(1, _fields_in(line)) and not fields[-1]:  # commas inside quotes made room for more names than there are
        fields.pop()
    names: list[str] = []
    for i, name in enumerate(fields):
        name = name or f"_c{i}"
        names.append(name if name.lower() not in {x.lower() for x in names} else f"{name}_{i}")
    return tuple(names)


def _fields_in(line: str) -> int:
    """Commas outside quotes, and one."""
    return 1 + sum(part.count(",") for part in line.split('"')[::2])


def _text_schema(names: Sequence[str]) -> tuple[str, str]:
    """The schema of a header, and the name of its last column, which is filled only on lines with too many fields."""
    overflow = "_overflow"
    while overflow in {n.lower() for n in names}:
        overflow += "_"
    return ", ".join("`{}` string".format(n.replace("`", "``")) for n in [*names, overflow]), overflow


def read_crashes(spark: SparkSession, path: str | Sequence[str], state: StateConfig, multi_line: bool = False) -> DataFrame:
    raw = read_csv_text(spark, path, preamble_lines=state.preamble_lines, bad_lines=state.bad_lines, multi_line=multi_line)
    return rename_columns(raw, dict(state.incident_columns)).withColumn("state", F.lit(state.code))


def read_stations(spark: SparkSession, path: str | Sequence[str], state: StateConfig) -> DataFrame:
    wanted = list(state.station_columns.values())
    raw = read_csv_text(spark, path)
    return rename_columns(raw, {c: c for c in wanted}).withColumn("state", F.lit(state.code))
