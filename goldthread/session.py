"""Session set-up, the shared work folder, and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}
_SCOPES: list[list[str]] = []


def build_session(app: str = "goldthread", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect (AQE with skew handling, UTC, no UI)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting (tests) gets a temporary folder; on a cluster a
    missing setting is an error, because a machine-local folder is lost with its machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="goldthread-")
    return _LOCAL_DIRS[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared work folder."""
    return f"{work_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage", **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and pins values that a recomputation could
    change (range boundaries, partition numbers). ``options`` are those of the writer.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.options(**options).parquet(path)
    for scope in _SCOPES:
        scope.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged = path
    return out


def release(spark: SparkSession, *staged: DataFrame | str) -> None:
    """Remove the folders of staged tables that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for one in staged:
        folder = jvm.org.apache.hadoop.fs.Path(one if isinstance(one, str) else one._staged)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def work_scope(spark: SparkSession) -> Iterator[None]:
    """Removes at its end every folder that ``stage`` wrote inside it; use or write the results before."""
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield
    finally:
        _SCOPES.remove(paths)
        release(spark, *paths)


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` in bytes (very large when unknown)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame, expansion: int = 1) -> bool:
    """True when the estimated size is within the session's automatic broadcast limit.

    ``expansion`` is how much larger the rows are in memory than in the files they come from.
    """
    limit = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if limit in ("-1", None):
        return False
    text = limit.lower().rstrip("b")
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(text[-1:], None)
    size = int(text[:-1]) * unit if unit else int(text)
    return plan_bytes(df) * expansion <= size
