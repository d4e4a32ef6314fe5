"""Session set-up and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: str = "8", app: str = "fairlead", **conf: str) -> SparkSession:
    """A local session for tests, the bench and the command line's --master local."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "localhost")
        .config("spark.driver.bindAddress", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach.

    The cluster names it in spark.checkpoint.dir. Only a local master, whose one process
    reads and writes every file, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="fairlead-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


# Paths made within each `scratch` block that is open, the innermost last.
_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession):
    """For a job whose result is written when it ends: its own scratch tables go with it."""
    _SCOPES.append([])
    try:
        yield
    finally:
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        for path in _SCOPES.pop():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)


def local_rows(spark: SparkSession, columns: dict[str, list], schema: StructType) -> DataFrame:
    """A few rows the driver holds, by column, without a job or a Python worker to bring them in."""
    return spark.createDataFrame(pa.table({c: pa.array(v, None if v else pa.null()) for c, v in columns.items()}), schema)


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    return local_rows(spark, {c: [] for c in schema.fieldNames()}, schema)


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows written to a table in the shared folder and read back.

    For frames that a plan needs more than once: later stages start from the files, which
    outlive any executor, instead of computing the frame again.
    """
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
