"""Tables written once and read by several outputs, and removed afterwards.

A staged table is Parquet in the shared checkpoint folder of the cluster: it cuts
the lineage, survives lost executors, and later reads still prune columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Hashable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def staging_folder(spark: SparkSession) -> str:
    """The shared folder. A cluster has to name one; one machine has its warehouse."""
    context = spark.sparkContext
    folder = spark.conf.get(SETTING, None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that the driver and all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staging"


def _place(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def remove(spark: SparkSession, path: str) -> None:
    files, target = _place(spark, path)
    files.delete(target, True)


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Remove the folder when the driver ends, unless it was removed before."""
    files, target = _place(spark, path)
    files.deleteOnExit(target)


def version(spark: SparkSession, path: str) -> tuple[int, int]:
    """Time of the last change and size in bytes of a file or folder."""
    files, target = _place(spark, path)
    return files.getFileStatus(target).getModificationTime(), files.getContentSummary(target).getLength()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{staging_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _written(df: DataFrame, path: str, **options: str) -> DataFrame:
    df.write.mode("errorifexists").options(**options).parquet(path)
    remove_at_exit(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Lists that note the paths staged while they are on top.
_noted: list[list[str]] = []


@contextmanager
def _noting(paths: list[str]) -> Iterator[None]:
    _noted.append(paths)
    try:
        yield
    finally:
        _noted.pop()


def stage(df: DataFrame, name: str) -> DataFrame:
    """df, written and read back; kept until the driver ends, or the staged run it is part of."""
    path = new_path(df.sparkSession, name)
    if _noted:
        _noted[-1].append(path)
    return _written(df, path)


class StagedRun:
    """Tables built once in a run, whatever the number of outputs that read them.

    Use it in a ``with`` statement that also writes the outputs: at its end the tables go.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []
        self.tables: dict[Hashable, DataFrame] = {}
        self.built = 0
        self._drops: list[str] = []

    def table(self, key: Hashable, build: Callable[[], DataFrame], name: str = "table") -> DataFrame:
        """The table of this key; built, written and noted when it is first asked for."""
        if key not in self.tables:
            path, parts = new_path(self.spark, name), []
            self.paths.append(path)
            with _noting(parts):
                self.tables[key] = _written(build(), path, compression="zstd")  # large ones: keys take half the space
            for part in parts:  # what was staged on the way has served its purpose
                remove(self.spark, part)
            self.built += 1
        return self.tables[key]

    def part(self, make: Callable[[], DataFrame]) -> DataFrame:
        """What make() gives; the tables that it stages go at the end of the run."""
        with _noting(self.paths):
            return make()

    def bucketed(self, df: DataFrame, keys: list[str], buckets: int, name: str) -> DataFrame:
        """df as a table bucketed by keys: joins and sums on them need no exchange."""
        path = new_path(self.spark, name)
        table = path.rsplit("/", 1)[1].replace("-", "_")
        writer = df.repartition(buckets, *keys).write.mode("errorifexists").format("parquet")
        self._drops.append(table)
        self.paths.append(path)
        writer.option("path", path).bucketBy(buckets, *keys).saveAsTable(table)
        remove_at_exit(self.spark, path)
        self.built += 1
        return self.spark.table(table)

    def close(self) -> None:
        for table in self._drops:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        for path in self.paths:
            remove(self.spark, path)
        self.tables, self.paths, self._drops = {}, [], []

    def __enter__(self) -> StagedRun:
        return self

    def __exit__(self, *_) -> None:
        self.close()
