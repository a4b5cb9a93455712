"""Session settings and the shared folder in which intermediate tables are cut."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
# Of written tables, which are read once or twice: texts take about half the space of the default.
COMPRESSION = "zstd"


def local_session(cores: int | str = "*", app: str = "rankflow", **conf) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    settings = {
        SHUFFLE_PARTITIONS: "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local session may fall back to a temporary folder of its own.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    context = spark.sparkContext
    if configured is None:
        configured = context.getCheckpointDir()
    if configured is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="rankflow-")
        context.setCheckpointDir(configured)
    elif context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, which the innermost open :func:`scratch` scope owns."""
    folder = f"rankflow-{uuid.uuid4().hex}"
    if _scopes.get():
        _scopes.get()[-1].folders.append(folder)
    return f"{shared_dir(spark).rstrip('/')}/{folder}/{name}"


def _folders_of(df: DataFrame) -> set[str]:
    """The scratch folders that ``df`` reads."""
    return {folder for file in df.inputFiles() for folder in re.findall(r"rankflow-[0-9a-f]{32}", file)}


class Scope:
    """The scratch tables that one piece of work writes."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folders, self._kept = spark, [], set()

    def result(self, df: DataFrame) -> DataFrame:
        """``df`` itself; the tables it reads outlive the scope."""
        self._kept |= _folders_of(df)
        return df

    def drop(self, *tables: DataFrame) -> None:
        """Deletes written tables that nothing will read any more, before the scope ends."""
        gone = set().union(*map(_folders_of, tables)) & set(self.folders)
        self.folders = [folder for folder in self.folders if folder not in gone]
        for folder in gone:
            _delete(self.spark, folder)
        # Shuffle files of the plans that wrote these tables go once the driver's JVM collects the plans.
        self.spark.sparkContext._jvm.System.gc()

    def close(self) -> list[str]:
        """Deletes all tables but those of results, whose folders are returned."""
        for folder in self.folders:
            if folder not in self._kept:
                _delete(self.spark, folder)
        return [folder for folder in self.folders if folder in self._kept]


_scopes: ContextVar[tuple[Scope, ...]] = ContextVar("scopes", default=())


@contextmanager
def scratch(spark: SparkSession):
    """Tables written inside are deleted at the end, on failure too, but for those that a ``result`` reads.

    What a nested scope leaves belongs to the scope around it.
    """
    scope = Scope(spark)
    token = _scopes.set((*_scopes.get(), scope))
    try:
        yield scope
    except BaseException:
        scope._kept.clear()
        raise
    finally:
        _scopes.reset(token)
        left = scope.close()
        if _scopes.get():
            _scopes.get()[-1].folders.extend(left)


def _delete(spark: SparkSession, folder: str) -> None:
    jvm, context = spark.sparkContext._jvm, spark.sparkContext._jsc
    target = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/{folder}")
    target.getFileSystem(context.hadoopConfiguration()).delete(target, True)


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]):
    """Plans executed inside have these settings; afterwards the former ones hold again."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def cut(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Preferred to a checkpoint for wide rows: columnar, compressed, and later reads prune
    columns and push filters down.
    """
    return cut_at(df, scratch_path(df.sparkSession, name), partition_by)


def cut_at(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    df.write.option("compression", COMPRESSION).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a table that :func:`scratch_path` placed, once nothing reads it any more."""
    folder = path.rstrip("/").rsplit("/", 2)[-2]
    if not folder.startswith("rankflow-"):
        raise ValueError(f"{path} is no scratch table")
    _delete(spark, folder)


def cut_bucketed(df: DataFrame, name: str, buckets: int, keys: list[str]) -> DataFrame:
    """Like :func:`cut`, bucketed by ``keys``: hash joins on them need no shuffle.

    ``df`` should already be partitioned by ``keys``, or every task writes to every bucket.
    The catalog entry goes once the table is resolved; the files stay in the shared folder.
    """
    spark = df.sparkSession
    table = f"rankflow_{name}_{uuid.uuid4().hex}"
    (
        df.write.bucketBy(buckets, *keys)
        .option("compression", COMPRESSION)
        .option("path", scratch_path(spark, name))
        .saveAsTable(table)
    )
    bucketed = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return bucketed
