"""Tables written to the folder that driver and executors share, in place of caches and lineage."""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where the session names none and runs on this machine alone (tests, a laptop) a local
    one is made and set; on a cluster executors would not share it, so there the call fails.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="millrace-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared one; Hadoop removes the folder when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(jpath)
    fs.deleteOnExit(jpath)
    return path


#: Bytes of an Arrow batch on its way to a Python worker; rows alone would let long texts fill its memory.
BATCH_BYTES = 1 << 20


@contextlib.contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Settings of the jobs begun inside, put back afterwards.

    Python workers get at most BATCH_BYTES at once (or one row), and a job's shuffle files go
    when it ends: what it wrote is in the shared folder, so nothing reads them again.
    """
    wanted = {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES), "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def staged(df: DataFrame, name: str, rows: int | None = None, per_file: int = 100_000) -> DataFrame:
    """Write a table into the shared folder and read it back: lineage ends here, lost executors re-read it.

    ``rows``: about how many there are at most, if that is known; a small table is then made by
    few tasks and kept in few files, whatever the number of shuffle partitions.
    """
    if rows is not None:
        df = df.coalesce(rows // per_file + 1)
    path = f"{fresh_dir(df.sparkSession, name)}/table"
    with staging(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_at = path
    if scopes := getattr(_open, "scopes", None):
        scopes[-1].append(out)
    return out


#: The scopes that a thread is in, the innermost last, each with the tables that were staged in it.
_open = threading.local()


@contextlib.contextmanager
def scratch() -> Iterator[None]:
    """Tables staged inside are removed at the end: for work whose result is written elsewhere by then."""
    scopes = _open.__dict__.setdefault("scopes", [])
    scopes.append([])
    try:
        yield
    finally:
        drop_staged(*scopes.pop())


def drop_staged(*tables: DataFrame) -> None:
    """Remove staged tables that nothing reads any more, before the driver ends."""
    for df in tables:
        remove(df.sparkSession, df.staged_at.rpartition("/")[0])


def remove(spark: SparkSession, path: str) -> None:
    """A folder, with all that is in it, and Hadoop's note to remove it when the driver ends."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(jpath, True)
    fs.cancelDeleteOnExit(jpath)


class Shelf:
    """Tables of one piece of work by name: what is whole is read back, not made again.

    With a path of its own it outlives the driver, and work that was cut short goes on after the
    last table that it finished; without one it lies in the shared folder. ``on_step`` is told
    of every step that is passed.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, *, on_step: Callable[[str], None] | None = None):
        self.spark, self.path, self.on_step = spark, path or fresh_dir(spark, "shelf"), on_step

    def has(self, name: str) -> bool:
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/_SUCCESS")
        return jpath.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(jpath)

    def table(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if not self.has(name):
            with scratch(), staging(self.spark):
                make().write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/{name}")
        self.passed(name)
        return self.spark.read.parquet(f"{self.path}/{name}")

    def passed(self, step: str) -> None:
        if self.on_step:
            self.on_step(step)

    def drop(self) -> None:
        remove(self.spark, self.path)
