"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# the folder that stored tables are gathered in, below Spark's own checkpoint folder
_FOLDER = "stored"

# the scope that owns what is stored now
_innermost: ContextVar[Scope | None] = ContextVar("innermost", default=None)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_folder(spark: SparkSession) -> str:
    """Spark's checkpoint folder, which ``spark.checkpoint.dir`` names.

    Naming a folder there says that all executors share it. One that only
    ``setCheckpointDir`` knows is refused on a cluster if it is a ``file:`` path. In local mode a
    temporary folder will do.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if named is None:
            if not _is_local(spark):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            named = tempfile.mkdtemp(prefix="playmetrics-")
        sc.setCheckpointDir(named)
    elif named is None and not _is_local(spark) and sc.getCheckpointDir().startswith("file:"):
        raise RuntimeError(
            f"{sc.getCheckpointDir()} is a local folder; name it in spark.checkpoint.dir if "
            "all executors share it"
        )
    return sc.getCheckpointDir()


def _write(df: DataFrame) -> tuple[DataFrame, str]:
    path = f"{shared_folder(df.sparkSession)}/{_FOLDER}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _remove(spark: SparkSession, path: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def store(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder, in a job of its own, and read it from there.

    A lost executor then costs a re-read, and values that depend on a partition's
    position cannot change between two reads. Parquet lets later steps read only the
    columns they use. The innermost open ``Scope`` owns the table; without one it stays until
    ``drop_stored``.
    """
    stored, path = _write(df)
    scope = _innermost.get()
    if scope is not None:
        scope.paths.append(path)
    return stored


class Scope:
    """Owns the tables stored while it is open, and removes them when told to.

    As a context it removes them at its end, also after an error; scopes may lie within one
    another. What is to outlive it is written by ``keep``, in full::

        with Scope(spark) as scope:
            result = scope.keep(analysis(tables))

    ``open`` and ``close`` serve a caller whose result is written elsewhere; ``drop`` comes
    when that has happened.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []
        self._token = None

    def open(self) -> Scope:
        self._outer = _innermost.get()
        self._token = _innermost.set(self)
        return self

    def close(self) -> None:
        """Own nothing more. What is owned already stays."""
        if self._token is not None:
            _innermost.reset(self._token)
            self._token = None

    def drop(self) -> int:
        """Remove the tables owned; how many there were. Results that read them cannot be computed
        afterwards."""
        dropped = len(self.paths)
        while self.paths:
            _remove(self.spark, self.paths.pop())
        return dropped

    def keep(self, df: DataFrame) -> DataFrame:
        """Store ``df`` for the scope around this one to own."""
        stored, path = _write(df)
        if self._outer is not None:
            self._outer.paths.append(path)
        return stored

    def feeds(self, df: DataFrame) -> bool:
        """Whether ``df`` reads any of the tables owned."""
        files = df.inputFiles()
        return any(f"{path.rstrip('/').rsplit('/', 1)[-1]}/" in file for path in self.paths for file in files)

    def __enter__(self) -> Scope:
        return self.open()

    def __exit__(self, *raised: object) -> None:
        self.close()
        self.drop()


def drop_stored(spark: SparkSession) -> bool:
    """Remove every table this application has stored; true if there was any.

    Results that were not written or collected yet cannot be computed afterwards.
    """
    folder = spark.sparkContext.getCheckpointDir()
    return folder is not None and _remove(spark, f"{folder}/{_FOLDER}")
