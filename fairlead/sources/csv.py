"""CSV position reports to staging rows.

Columns are found by header name, so their order and any further columns do not matter.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairlead.functions.columns import ntz, utc_now
from fairlead.operators.keys import lookup
from fairlead.schemas import CSV_COLUMNS, MMSI_LENGTH, STAGING
from fairlead.session import stored

RAW_LINE = "raw_line"
# Any case of .csv, at any depth.
CSV_GLOB = "*.[cC][sS][vV]"
# Files may have so many different headers.
MOST_HEADERS = 200

# What the target types accept as text.
NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|nan|inf|infinity)\s*$"
DAY_FIRST = r"^\s*\d{4}-\d{1,2}-\d{1,2}([ T].*)?$"

NUMERIC = [c for c in CSV_COLUMNS.values() if c not in ("gps_timestamp", "mmsi", "nav_status")]


def header_columns(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Column names in the header of the first file."""
    return _options(spark, spark.read, path).option("header", True).csv(path).columns


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether the file system has a folder of that name; names alone do not tell."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return files.exists(place) and files.getFileStatus(place).isDirectory()


def _options(spark: SparkSession, reader, path: str | list[str]):
    """Quotes are doubled inside quoted fields; a folder is searched at any depth."""
    reader = reader.option("quote", '"').option("escape", '"')
    if isinstance(path, str) and is_folder(spark, path):
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", CSV_GLOB)
    return reader


def _all_text(columns: list[str]) -> T.StructType:
    missing = sorted(set(CSV_COLUMNS) - set(columns))
    if missing:
        raise ValueError(f"columns not in the header: {', '.join(missing)}")
    return T.StructType([T.StructField(c, T.StringType()) for c in [*columns, RAW_LINE]])


def configure(spark: SparkSession, reader, path: str | list[str], columns: list[str]):
    """A batch or stream reader that keeps every field as text and ragged lines as raw_line.

    Files are checked against the given header; one with another header fails the read
    instead of landing in the wrong columns.
    """
    return (
        _options(spark, reader, path)
        .schema(_all_text(columns))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RAW_LINE)
        # Pruned columns would hide that a line has too many or too few fields.
        .option("columnPruning", False)
    )


def read_raw(spark: SparkSession, path: str | list[str], mixed_headers: bool = False) -> DataFrame:
    """All lines of the file or folder as text columns under their staging names.

    With mixed_headers each file's own header says where its columns are.
    """
    if mixed_headers:
        lines = text_lines(_options(spark, spark.read, path).text(path))
        return parse_lines(lines, file_headers(lines))
    rows = configure(spark, spark.read, path, header_columns(spark, path)).csv(path)
    return rows.select(*CSV_COLUMNS, RAW_LINE).withColumnsRenamed(CSV_COLUMNS)


def text_lines(lines: DataFrame) -> DataFrame:
    """The lines of a text source, each with its file and where the block it was read in begins.

    `alone` is true for the blocks of a file but its last: a task has such a block to itself.
    """
    meta = "_metadata.file_"
    return lines.select(
        "value",
        F.col(f"{meta}path").alias("file"),
        F.col(f"{meta}block_start").alias("block"),
        (F.col(f"{meta}block_start") + F.col(f"{meta}block_length") < F.col(f"{meta}size")).alias("alone"),
    )


def file_headers(lines: DataFrame) -> DataFrame:
    """file and header, the first line of each file.

    A task passes on the first line of every file whose beginning it has. Where a block of a
    large file is all that a task has, it takes one batch of lines and stops.
    """
    schema = pa.schema([("file", pa.string()), ("header", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            coded = batch.column(1).dictionary_encode()
            order = coded.indices.to_pylist()
            for at in [0, *(i for i in range(1, len(order)) if order[i] != order[i - 1])] if order else []:
                name = batch.column(1)[at].as_py()
                if name != last and batch.column(2)[at].as_py() == 0:
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([batch.column(0)[at].as_py()], pa.string())], schema=schema)
                last = name
            if order and batch.column(3)[0].as_py():
                return

    return lines.select("value", "file", "block", "alone").mapInArrow(run, "file string, header string")


def parse_lines(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """Text columns under their staging names, from lines and the headers of their files.

    Every distinct header is a schema of its own; a line is parsed by that of its file. A header
    that lacks a column fails the read. Lines without anything but blanks are no records.
    """
    headers = stored(headers, "file-headers")
    kinds = [row["header"] for row in headers.select("header").distinct().orderBy("header").limit(MOST_HEADERS + 1).collect()]
    if len(kinds) > MOST_HEADERS:
        raise ValueError(f"more than {MOST_HEADERS} different headers")
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW_LINE, "columnPruning": "false"}
    fields = [*CSV_COLUMNS, RAW_LINE]
    rows = lines.filter(F.trim("value") != "")
    files = headers.select("file", F.col("header").alias("of_header"))
    rows = lookup(rows, files, "file", "inner", spread="value")
    # The header line itself begins the file's first block.
    rows = rows.filter(~((F.col("block") == 0) & (F.col("value") == F.col("of_header"))))
    record = F.lit(None)
    for kind in kinds:
        names = next(csv.reader([kind]))
        schema = ", ".join(f"`{n.replace('`', '``')}` STRING" for n in _unique([*names, RAW_LINE]))
        _all_text(names)
        parsed = F.from_csv(F.col("value"), schema, options)
        named = F.struct(*[parsed[c].alias(CSV_COLUMNS.get(c, c)) for c in fields])
        record = F.when(F.col("of_header") == kind, named).otherwise(record)
    if not kinds:
        empty = ", ".join(f"{CSV_COLUMNS.get(c, c)} STRING" for c in fields)
        return lines.sparkSession.createDataFrame([], empty)
    return rows.select(record.alias("record")).select("record.*")


def _unique(names: list[str]) -> list[str]:
    """The names, with the place added to those that are empty or were there before, like Spark's reader."""
    out, seen = [], set()
    for at, name in enumerate(names):
        name = name if name and name.lower() not in seen else f"{name or '_c'}{at}"
        seen.add(name.lower())
        out.append(name)
    return out


def _text(name: str) -> Column:
    """The field, NULL when empty."""
    field = F.col(name)
    return F.when(F.trim(field) != "", field)


def zoneless(text: Column, pattern: str) -> Column:
    """The time that a text states, whatever the session's zone; NULL if it does not fit.

    The text is read as UTC and turned back without a zone, so no hour is skipped or repeated
    by daylight saving. A pattern with a zone of its own gives the time in UTC.
    """
    if not re.search("[XxZzOV]", re.sub("'[^']*'", "", pattern)):
        text, pattern = F.concat(text, F.lit(" +00:00")), f"{pattern} XXX"
    micros = F.unix_micros(F.try_to_timestamp(text, F.lit(pattern)))
    seconds = (micros.cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return ntz(datetime(1970, 1, 1)) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def _timestamp(name: str, pattern: str | None) -> Column:
    if pattern:
        return zoneless(_text(name), pattern)
    return F.when(F.col(name).rlike(DAY_FIRST), F.trim(F.col(name)).try_cast("timestamp_ntz"))


def typed(rows: DataFrame, timestamp_format: str | None = None) -> DataFrame:
    """Staging types, and in `reason` the first fault of the line, if any."""
    values = {
        "gps_timestamp": _timestamp("gps_timestamp", timestamp_format),
        "mmsi": _text("mmsi"),
        "nav_status": _text("nav_status"),
        **{
            c: F.when(F.col(c).rlike(NUMBER), F.trim(F.col(c)).try_cast("double"))
            for c in NUMERIC
        },
    }
    faults = [(F.col(RAW_LINE).isNotNull(), "ragged line")]
    for name, value in values.items():
        if name not in ("mmsi", "nav_status"):
            faults.append((_text(name).isNotNull() & value.isNull(), f"{name} does not convert"))
    for name in ("gps_timestamp", "nav_status"):
        faults.append((_text(name).isNull(), f"{name} is missing"))
    faults.append((F.length(_text("mmsi")) > MMSI_LENGTH, "mmsi is too long"))
    reason = F.coalesce(*[F.when(fault, F.lit(text)) for fault, text in faults])
    described = F.coalesce(
        RAW_LINE, F.to_csv(F.struct(*[F.col(c) for c in CSV_COLUMNS.values()]))
    )
    return rows.select(
        *[value.alias(name) for name, value in values.items()],
        reason.alias("reason"),
        described.alias("line"),
    )


def read_typed(
    spark: SparkSession, path: str | list[str], timestamp_format: str | None = None, mixed_headers: bool = False
) -> DataFrame:
    """All lines of a CSV file, or of all CSV files in a folder, in staging types (see typed)."""
    return typed(read_raw(spark, path, mixed_headers), timestamp_format)


def ingest_csv(
    spark: SparkSession,
    path: str | list[str],
    mode: str = "strict",
    load_date: datetime | None = None,
    first_id: int = 1,
    timestamp_format: str | None = None,
    mixed_headers: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Staging rows and rejected lines of a CSV file, or of all CSV files in a folder.

    Strict mode fails on the first bad line. Lenient mode sets bad lines, and lines
    without mmsi, aside with a reason.
    """
    rows = read_typed(spark, path, timestamp_format, mixed_headers)
    rows = judged(rows.withColumn("position_id", F.monotonically_increasing_id() + first_id), mode, load_date or utc_now())
    return split_rejects(rows)


def judged(rows: DataFrame, mode: str, load_date: datetime) -> DataFrame:
    """The rows stamped with the load time; a reason is left where a row is to be set aside."""
    if mode not in ("strict", "lenient"):
        raise ValueError(f"mode must be strict or lenient, not {mode!r}")
    reason = F.col("reason")
    if mode == "strict":
        fail = F.raise_error(F.concat(reason, F.lit(": "), F.col("line"))).cast("boolean")
        rows = rows.filter(F.when(reason.isNotNull(), fail).otherwise(F.lit(True)))
    else:
        reason = F.coalesce(reason, F.when(F.col("mmsi").isNull(), F.lit("mmsi is missing")))
        rows = rows.withColumn("reason", reason)
    return rows.withColumn("load_date", ntz(load_date))


def split_rejects(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and (reason, line) of the others."""
    aside = F.col("reason").isNotNull()
    return rows.filter(~aside).select(*STAGING.fieldNames()), rows.filter(aside).select("reason", "line")
