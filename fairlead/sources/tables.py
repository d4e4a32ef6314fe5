"""The warehouse as Parquet folders.

    staging, rejects   one partition per attempt at a load: typed rows, and lines that do not convert
    refused            one partition per attempt: staging rows that cannot become positions
    ships, nav_statuses
    positions          partitions per update and day, sorted by ship and time
    limits, exports    one partition per run, closed and open voyages apart
    retracted          one partition per run: ids of closed voyages that are no longer stored
    states             one partition per run: what the next run has to know of each ship
    loads, updates, runs, compactions   logs, appended to only: what counts as stored

Parquet has no DELETE, and a job can die between two writes. So a load, update or run writes
partitions that no one else writes, and then its log entry, and readers take only what the logs
name. A load that is repeated is a new attempt with partitions of its own: until its entry is
logged the rows of the attempt before count, from then on its own; what it replaced is deleted
after that. Voyages that a later run found again, or exports that a later run rebuilt, are
skipped by the run numbers in the log, and closed voyages that a run took back by their ids.

Updates add a folder per day each. `compact` writes all of them into one, day by day.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairlead.operators.keys import BROADCAST_ROWS, Sized, lookup
from fairlead.schemas import LIMITS, NAV_STATUSES, POSITIONS, SHIPS, STAGING
from fairlead.session import local_rows, no_rows

_LOAD = [T.StructField("load_id", T.StringType())]
_RUN = [T.StructField("run_id", T.LongType())]
_POINT = T.StructType([T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())])
_NUMBERS = T.ArrayType(T.DoubleType())

SCHEMAS = {
    "staging": T.StructType(STAGING.fields + _LOAD),
    "rejects": T.StructType(
        [T.StructField("reason", T.StringType()), T.StructField("line", T.StringType())] + _LOAD
    ),
    "refused": T.StructType(
        [T.StructField("position_id", T.LongType()), T.StructField("reason", T.StringType())]
        + _LOAD
    ),
    "ships": SHIPS,
    "nav_statuses": NAV_STATUSES,
    "positions": T.StructType(
        POSITIONS.fields
        + _LOAD
        + [T.StructField("update_id", T.LongType()), T.StructField("gps_date", T.DateType())]
    ),
    "limits": T.StructType([T.StructField("id", T.LongType())] + LIMITS.fields + _RUN),
    "exports": T.StructType(
        [
            T.StructField("trajectory_id", T.LongType()),
            T.StructField("ship_id", T.LongType()),
            T.StructField("mmsi", T.StringType()),
            T.StructField("datetime_start", T.TimestampNTZType()),
            T.StructField("datetime_stop", T.TimestampNTZType()),
            T.StructField("is_open", T.BooleanType()),
            T.StructField("part", T.LongType()),
            T.StructField("coordinates", T.ArrayType(_POINT)),
            T.StructField("timestamps", T.ArrayType(T.TimestampNTZType())),
            T.StructField("speed_over_ground", _NUMBERS),
            T.StructField("course_over_ground", _NUMBERS),
            T.StructField("heading", _NUMBERS),
        ]
        + _RUN
    ),
    "loads": T.StructType(
        [
            T.StructField("load_date", T.TimestampNTZType()),
            T.StructField("rows", T.LongType()),
            T.StructField("max_id", T.LongType()),
            T.StructField("attempt", T.StringType()),
            T.StructField("entry", T.LongType()),
        ]
        + _LOAD
    ),
    "updates": T.StructType(
        [
            T.StructField("load_date", T.TimestampNTZType()),
            T.StructField("update_id", T.LongType()),
            T.StructField("attempt", T.StringType()),
        ]
        + _LOAD
    ),
    "compactions": T.StructType(
        [T.StructField("update_id", T.LongType()), T.StructField("upto", T.LongType())]
    ),
    "retracted": T.StructType([T.StructField("id", T.LongType())] + _RUN),
    "states": T.StructType(
        [
            T.StructField("ship_id", T.LongType()),
            T.StructField("last_time", T.TimestampNTZType()),
            T.StructField("last_position_id", T.LongType()),
            T.StructField("last_status_id", T.LongType()),
            T.StructField("open_start", T.TimestampNTZType()),
            T.StructField("open_position_id", T.LongType()),
            T.StructField("last_stop", T.TimestampNTZType()),
            T.StructField("bounded", T.BooleanType()),
        ]
        + _RUN
    ),
    "runs": T.StructType(
        [
            T.StructField("mode", T.StringType()),
            T.StructField("rules", T.StringType()),
            T.StructField("update_id", T.LongType()),
            T.StructField("ship_min", T.LongType()),
            T.StructField("ship_max", T.LongType()),
            T.StructField("last_id", T.LongType()),
            T.StructField("late", T.LongType()),
            T.StructField("taken_back", T.LongType()),
        ]
        + _RUN
    ),
}

FINDING = ("find", "find_export")
# The tables that one write of a load fills, each a partition by verdict.
VERDICTS = ("staging", "rejects")
# Spark numbers the rows of each task from a multiple of TASK_IDS; ids are reserved in blocks of
# so many tasks.
TASK_IDS = 1 << 33
BLOCK = 32 * TASK_IDS
# Parts a load's id from the name of a repeated attempt; no load id has it.
ATTEMPT = "~"
# Up to so many names from the logs are listed in a filter; more are joined.
NAMED = 1000
# For how many ships a file's Bloom filter is sized.
SHIPS_A_FILE = 100_000


def new_id(last: int) -> int:
    """Larger than the last id in the log, and not that of a job that died unlogged."""
    return max(time.time_ns() // 1000, last + 1)


@dataclass(frozen=True)
class Run:
    """A run's id, mode and ships, the rules it found voyages by, and how far it got.

    It has seen the updates up to update_id and given voyages the ids up to last_id. `late` of
    the reports new to it came at or before their ship's last stored stop; it took back as many
    stored voyages as `taken_back`.
    """

    run_id: int
    mode: str
    ship_range: tuple[int, int] | None
    rules: str
    update_id: int
    last_id: int
    late: int = 0
    taken_back: int = 0

    def replaces(self) -> Column:
        """Rows of earlier runs within this run's ships."""
        older = F.col("run_id") < self.run_id
        return older if self.ship_range is None else older & F.col("ship_id").between(*self.ship_range)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._held: dict | None = None

    @contextmanager
    def snapshot(self):
        """Within it, what the logs say is read once and stays as it was at its first reading."""
        outer, self._held = self._held, {} if self._held is None else self._held
        try:
            yield self
        finally:
            self._held = outer

    def _once(self, key: tuple | None, make: Callable):
        if self._held is None or key is None:
            return make()
        if key not in self._held:
            self._held[key] = make()
        return self._held[key]

    def _among(self, rows: DataFrame, column: str, key: tuple | None, names: DataFrame) -> DataFrame:
        """The rows whose column is one of the names (one column): by a list, or a join if they are many.

        Few names hold any share of the rows each, so rows are never dealt by name. A list also
        tells which partitions need not be read.
        """

        def listed() -> list | None:
            few = [row[0] for row in names.distinct().limit(NAMED + 1).collect()]
            return few if len(few) <= NAMED else None

        few = self._once(key, listed)
        if few is not None:
            return rows.filter(F.col(column).isin(few))
        named = names.distinct().toDF(column)
        return lookup(rows, named, column, "left_semi", rows.columns[0]).select(*rows.columns)

    def path(self, table: str) -> str:
        """Staging rows and rejected lines lie side by side, so that one write brings both."""
        return f"{self.root}/lines/verdict={table}" if table in VERDICTS else f"{self.root}/{table}"

    def read(self, table: str) -> DataFrame:
        """All stored rows; none when the table was never written."""
        schema = SCHEMAS[table]
        try:
            return self.spark.read.schema(schema).parquet(self.path(table))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return no_rows(self.spark, schema)

    def _log(self, table: str) -> DataFrame:
        """The entries of a log: few beside the rows they tell of, so one task reads them without a shuffle."""
        return self.read(table).coalesce(1)

    def append(self, table: str, rows: Sized) -> None:
        if rows.count:
            rows = rows.select(*SCHEMAS[table].fieldNames()).rows
            rows.write.mode("append").parquet(self.path(table))

    def replace_partitions(self, table: str, rows: DataFrame, by: list[str]) -> None:
        """Write partitions in place of those of the same names; others stay."""
        rows.select(*SCHEMAS[table].fieldNames()).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(*by).parquet(self.path(table))

    @staticmethod
    def check_load_id(load_id: str) -> None:
        if not re.fullmatch(r"[\w+-][\w.+-]*", load_id):
            raise ValueError(f"a load id has letters, digits and . + - _ only, not {load_id!r}")

    def replace_load(self, table: str, attempt: str, rows: DataFrame) -> None:
        """Write the one partition of an attempt at a load, also when rows are none."""
        self.check_load_id(attempt.split(ATTEMPT)[0])
        kept = [c for c in SCHEMAS[table].fieldNames() if c != "load_id"]
        rows.select(*kept).write.mode("overwrite").parquet(f"{self.path(table)}/load_id={attempt}")

    def write_lines(self, attempt: str, rows: DataFrame) -> tuple[int, int]:
        """Write an attempt's staging rows and rejected lines (with a reason) in one pass.

        Returns the number of staging rows and their largest id, as counted while writing.
        """
        self.check_load_id(attempt.split(ATTEMPT)[0])
        for table in VERDICTS:
            # What a dead attempt of that name may have left was never logged.
            self.remove(table, [f"load_id={attempt}"])
        good = F.col("reason").isNull()
        seen = Observation()
        written = rows.observe(
            seen, F.count(F.when(good, 1)).alias("rows"), F.max(F.when(good, F.col("position_id"))).alias("max_id")
        )
        staged = [c for c in SCHEMAS["staging"].fieldNames() if c != "load_id"]
        verdict = F.when(good, VERDICTS[0]).otherwise(VERDICTS[1]).alias("verdict")
        # What belongs to the other table only is left empty.
        columns = [F.when(good, F.col(c)).alias(c) for c in staged] + [F.when(~good, F.col(c)).alias(c) for c in ("reason", "line")]
        written = written.select(*columns, verdict, F.lit(attempt).alias("load_id"))
        written.write.mode("append").partitionBy("verdict", "load_id").parquet(f"{self.root}/lines")
        return seen.get["rows"] or 0, seen.get["max_id"] or 0

    def reserve_ids(self, tasks: int) -> Column:
        """The position ids of the rows of a frame that so many tasks read, its own for good.

        Ids come in blocks, and a block is taken by creating a file of its number, which the
        file system lets one creator do only; whoever finds it taken goes on to the next. So
        loads that run at the same time never share an id, and none has to wait.
        """
        files, path = self._files()
        number = (self.next_position_id() - 1 + BLOCK - 1) // BLOCK
        blocks = []
        while len(blocks) < -(-max(tasks, 1) * TASK_IDS // BLOCK):
            try:
                files.create(path(f"{self.root}/ids/{number:012d}"), False).close()
                blocks.append(number * BLOCK + 1)
            except Py4JJavaError as error:
                if "AlreadyExists" not in str(error.java_exception):
                    raise
            number += 1
        nth = F.monotonically_increasing_id()
        starts = F.array(*[F.lit(b).cast("bigint") for b in blocks])
        return F.element_at(starts, (F.floor(nth / BLOCK) + 1).cast("int")) + nth % BLOCK

    def log(self, table: str, entries: list[tuple]) -> None:
        """Append the entries as one file; nothing that was logged before is touched."""
        self._held = {} if self._held else self._held
        schema = SCHEMAS[table]
        columns = {field: list(values) for field, values in zip(schema.fieldNames(), zip(*entries))}
        rows = local_rows(self.spark, columns, schema).coalesce(1)
        rows.write.mode("append").parquet(self.path(table))

    def _files(self):
        """The tables' file system and the class of its paths."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        return path(self.root).getFileSystem(conf), path

    def remove(self, table: str, partitions: list[str]) -> None:
        files, path = self._files()
        for partition in partitions:
            files.delete(path(f"{self.path(table)}/{partition}"), True)

    # Loads

    def _current_loads(self) -> DataFrame:
        """The latest entry of each load in the log."""
        columns = [c for c in SCHEMAS["loads"].fieldNames() if c != "load_id"]
        latest = F.max_by(F.struct(*columns), "entry").alias("latest")
        return self._log("loads").groupBy("load_id").agg(latest).select("load_id", "latest.*")

    def loads(self) -> list:
        return self._current_loads().orderBy("load_date", "load_id").collect()

    def load(self, load_id: str):
        """The latest entry of a load, or None."""
        return self._once(("load", load_id), self._current_loads().filter(F.col("load_id") == load_id).first)

    def new_attempt(self, load_id: str) -> str:
        """The name of the partitions of a load: its id, or one of their own for a repeat."""
        self.check_load_id(load_id)
        return load_id if self.load(load_id) is None else f"{load_id}{ATTEMPT}{uuid.uuid4().hex[:12]}"

    def log_load(self, load_date: datetime, rows: int, max_id: int, attempt: str, load_id: str) -> None:
        last = self._log("loads").agg(F.max("entry")).first()[0]
        self.log("loads", [(load_date, rows, max_id, attempt, new_id(last or 0), load_id)])

    def next_position_id(self) -> int:
        return (self._log("loads").agg(F.max("max_id")).first()[0] or 0) + 1

    def attempts(self, names: DataFrame, table: str = "staging") -> DataFrame:
        """Rows of a table in the named attempts (a column `attempt`)."""
        rows = self.read(table).select(*SCHEMAS[table].fieldNames())
        return self._among(rows, "load_id", None, names.select("attempt"))

    def staging(self, load_ids: list[str] | None = None) -> DataFrame:
        """Staging rows of the logged loads, or of some of them."""
        current = self._current_loads()
        if load_ids is not None:
            current = current.filter(F.col("load_id").isin(load_ids))
        return self.attempts(current).withColumn("load_id", F.substring_index("load_id", ATTEMPT, 1))

    def pending_loads(self) -> list:
        """Logged loads whose latest attempt is not among the positions yet."""
        done = self._log("updates").select("attempt").distinct()
        return self._current_loads().join(done, "attempt", "left_anti").orderBy("load_date", "load_id").collect()

    def load_mark(self) -> datetime | None:
        return self._log("updates").agg(F.max("load_date")).first()[0]

    # Positions

    def _updates(self, after: int = 0) -> DataFrame:
        """Logged updates of attempts that are still the latest of their loads."""
        latest = self._current_loads().select("attempt")
        return self._log("updates").filter(F.col("update_id") > after).join(latest, "attempt", "left_semi")

    def _compaction(self) -> tuple[int, int]:
        """The folder of the last compaction and the update up to which it holds all rows."""

        def last() -> tuple[int, int]:
            row = self._log("compactions").orderBy(F.col("update_id").desc()).first()
            return (row["update_id"], row["upto"]) if row else (0, 0)

        return self._once(("compaction",), last)

    def _folders(self, after: int) -> list[str]:
        return self._once(("folders", after), lambda: self._find_folders(after))

    def _find_folders(self, after: int) -> list[str]:
        """The folders that hold the rows of updates after the given one; those the file system has.

        One per update since the last compaction, whatever the number of reports.
        """
        compact, upto = self._compaction()
        logged = self._log("updates").filter(F.col("update_id") > max(after, upto))
        names = [row[0] for row in logged.select("update_id").distinct().collect()]
        if after < upto:
            names.append(compact)
        files, path = self._files()
        found = [f"{self.path('positions')}/update_id={name}" for name in sorted(names)]
        return [folder for folder in found if files.exists(path(folder))]

    def _positions(self, after: int = 0) -> DataFrame:
        """All rows in the folders of the updates after the given one, latest attempts or not."""

        def rows() -> DataFrame:
            folders = self._folders(after)
            if not folders:
                return no_rows(self.spark, SCHEMAS["positions"])
            reader = self.spark.read.schema(SCHEMAS["positions"]).option("basePath", self.path("positions"))
            return reader.parquet(*folders)

        # The files in them stay the same, and are listed once in a snapshot.
        return self._once(("positions", after), rows)

    def positions(self, after: int = 0) -> DataFrame:
        """Positions of the logged updates, or of those after the given one."""
        rows = self._among(self._positions(after), "load_id", ("attempts", after), self._updates(after).select("attempt"))
        kept = [c for c in SCHEMAS["positions"].fieldNames() if c not in ("update_id", "load_id")]
        return rows.select(*kept, F.substring_index("load_id", ATTEMPT, 1).alias("load_id"))

    def withdrawn(self, since: int) -> DataFrame:
        """Positions that a run with that id may have read and that no longer count.

        They are those of attempts which a repeat logged since then has replaced.
        """
        replaced = self._log("loads").groupBy("load_id").agg(F.max("entry").alias("last"))
        replaced = replaced.filter(F.col("last") > since).select("load_id")
        gone = self._log("updates").join(replaced, "load_id", "left_semi")
        gone = gone.join(self._current_loads().select("attempt"), "attempt", "left_anti")
        return self._among(self._positions(), "load_id", ("withdrawn", since), gone.select("attempt"))

    def last_update(self) -> int:
        return self._once(("last_update",), lambda: self._log("updates").agg(F.max("update_id")).first()[0] or 0)

    def next_update(self) -> int:
        return new_id(max(self.last_update(), self._compaction()[0]))

    def log_update(self, loads: list, number: int) -> None:
        self.log("updates", [(load["load_date"], number, load["attempt"], load["load_id"]) for load in loads])

    def write_positions(self, rows: DataFrame, number: int) -> None:
        """A folder of the update's own, with one per day; each file sorted by ship and time.

        Rebalancing gives a large day several files instead of one task. Bloom filters tell a
        reader of one ship, or of a few, which row groups to skip.
        """
        rows = rows.withColumns(
            {"gps_date": F.col("gps_timestamp").cast("date"), "update_id": F.lit(number).cast("bigint")}
        )
        rows = rows.hint("rebalance", "gps_date")
        rows = rows.sortWithinPartitions("gps_date", "ship_id", "gps_timestamp")
        rows.select(*SCHEMAS["positions"].fieldNames()).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).option("parquet.bloom.filter.enabled#ship_id", "true").option(
            "parquet.bloom.filter.expected.ndv#ship_id", str(SHIPS_A_FILE)
        ).partitionBy("update_id", "gps_date").parquet(self.path("positions"))

    def compact(self) -> int | None:
        """Write the positions of all updates into one folder, day by day; its number.

        Rows of replaced attempts stay out, but for those a run has still to hear of. Readers
        go on with the old folders until the compaction is logged; remove_replaced deletes them.
        """
        upto = self.last_update()
        if not upto:
            return None
        finding = self._log("runs").filter(F.col("mode").isin(*FINDING)).agg(F.max("run_id")).first()[0]
        latest = self._among(self._positions(), "load_id", ("attempts", 0), self._updates().select("attempt"))
        kept = latest.unionByName(self.withdrawn(finding or 0))
        number = self.next_update()
        self.write_positions(kept.drop("update_id", "gps_date"), number)
        self.log("compactions", [(number, upto)])
        return number

    def remove_replaced(self) -> int:
        """Delete the folders of positions that no reader starts from any more; how many."""
        compact, upto = self._compaction()
        files, path = self._files()
        listed = files.globStatus(path(f"{self.path('positions')}/update_id=*")) or []
        names = [str(status.getPath().getName()) for status in listed]
        gone = [name for name in names if int(name.split("=")[1]) <= upto and name != f"update_id={compact}"]
        self.remove("positions", gone)
        return len(gone)

    # Runs

    def _runs(self, logged: DataFrame) -> list[Run]:
        rows = sorted(logged.collect(), key=lambda row: row["run_id"])
        return [
            Run(
                row["run_id"],
                row["mode"],
                None if row["ship_min"] is None else (row["ship_min"], row["ship_max"]),
                row["rules"],
                row["update_id"],
                row["last_id"],
                row["late"] or 0,
                row["taken_back"] or 0,
            )
            for row in rows
        ]

    def runs(self) -> list[Run]:
        return self._once(("run log",), lambda: self._runs(self._log("runs")))

    def last_run(self, finding: bool = False) -> Run | None:
        found = [run for run in self.runs() if not finding or run.mode in FINDING]
        return found[-1] if found else None

    def log_run(self, run: Run) -> None:
        low, high = run.ship_range or (None, None)
        entry = (run.mode, run.rules, run.update_id, low, high, run.last_id, run.late, run.taken_back, run.run_id)
        self.log("runs", [entry])

    def _stored(self, table: str) -> DataFrame:
        """Rows of the logged runs; their numbers are the partitions' names, so others are not read."""
        rows = self._among(self.read(table), "run_id", ("runs",), self._log("runs").select("run_id"))
        return rows.select(*SCHEMAS[table].fieldNames())

    def _replaced(self, modes: tuple[str, ...]) -> Column:
        """What the last run of these modes over all ships, and those over some since, replaced."""
        logged = [run for run in self.runs() if run.mode in modes]
        whole = max((run.run_id for run in logged if run.ship_range is None), default=0)
        gone = F.lit(False)
        for run in logged:
            if run.run_id >= whole:
                gone = gone | run.replaces()
        return gone

    def _kept(self, rows: DataFrame, key: str, unique: bool = False) -> DataFrame:
        """The rows of closed voyages that no run took back; unique: one row a voyage, so that no key is oversized."""
        taken_back = sum(run.taken_back for run in self.runs())
        if not taken_back:
            return rows
        gone = self._stored("retracted").select(F.col("id").alias(key))
        if unique and taken_back > BROADCAST_ROWS:
            return rows.join(gone, key, "left_anti").select(*rows.columns)
        return lookup(rows, Sized(gone, taken_back), key, "left_anti", "datetime_start").select(*rows.columns)

    def limits(self) -> DataFrame:
        """Closed voyages of all runs but those taken back, and the open ones no later run looked at again."""
        rows = self._stored("limits")
        still_open = rows.filter(F.col("is_open") & ~self._replaced(FINDING))
        return self._kept(rows.filter(~F.col("is_open")), "id", unique=True).unionByName(still_open)

    def exports(self) -> DataFrame:
        """Exported lines of the stored voyages, without those exported again later.

        An open voyage that a later run found again is no longer stored, and so its line
        does not count either.
        """
        lines = self._stored("exports").filter(~self._replaced(("export",)))
        still_open = self.limits().filter("is_open").select(F.col("id").alias("trajectory_id"))
        return self._kept(lines.filter(~F.col("is_open")), "trajectory_id").unionByName(
            lookup(
                lines.filter("is_open"), still_open, "trajectory_id", "left_semi", "datetime_start"
            ).select(*lines.columns)
        )
