"""Tables written to the folder that driver and executors share: they cut lineage and survive lost executors.

Tables are compressed well, as they are read a few times at most, and the shuffle files of the query that writes a table are removed when
it has been written: nothing can ask for them again.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only in local mode where the session names none (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="corvane-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


#: Folders made inside each scratch() that is open in this thread or task, the innermost last.
_open: ContextVar[tuple[list[str], ...]] = ContextVar("corvane_open", default=())


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables written inside when it ends; what is used afterwards must be written with keep=True."""
    own: list[str] = []
    token = _open.set((*_open.get(), own))
    try:
        yield
    finally:
        _open.reset(token)
        for path in own:
            _delete(spark, path)


def new_folder(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A new path below the shared folder, deleted when the scratch() around it or the driver ends."""
    path = f"{shared_dir(spark)}/corvane-{name}-{uuid.uuid4().hex}"
    within = _open.get()[: -1 if keep else None]
    if within:
        within[-1].append(path)
    else:
        atexit.register(_delete, spark, path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm, sc = spark.sparkContext._jvm, spark.sparkContext._jsc
        to = jvm.org.apache.hadoop.fs.Path(path)
        to.getFileSystem(sc.hadoopConfiguration()).delete(to, True)
    except Exception:  # noqa: BLE001  the session may be gone; the folder's owner cleans up then
        pass


#: Spark's settings that remove a query's shuffle files at its end.
_CLEANUP = ("spark.sql.shuffleDependency.fileCleanup.enabled", "spark.sql.classic.shuffleDependency.fileCleanup.enabled")


@contextlib.contextmanager
def _cleaned(spark: SparkSession) -> Iterator[None]:
    was = {k: spark.conf.get(k, None) for k in _CLEANUP}
    for k in _CLEANUP:
        spark.conf.set(k, "true")
    try:
        yield
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def materialise(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """df written to the shared folder and read again."""
    spark = df.sparkSession
    path = new_folder(spark, name, keep)
    with _cleaned(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
