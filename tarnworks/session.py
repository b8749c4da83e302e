"""Sessions, and tables written to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the bench; on a cluster the session comes from outside."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tarnworks")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL: dict[str, str] = {}
_MADE: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    Where that is unset, a local master gets a temporary folder of its own; a
    cluster gets an error, since a folder of the driver alone would not do.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="tarnworks-")
    return _LOCAL[context.applicationId]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used; :func:`clear_staged` knows it."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_staged(spark: SparkSession) -> int:
    """Delete what this driver has written under :func:`fresh_path` in the session's application, and say how many paths that were.

    For the end of a run: tables that read these files, results of queries too, cannot be used any more. Files of
    other drivers, and what the shared folder holds besides, stay.
    """
    paths, context = _MADE.pop(spark.sparkContext.applicationId, []), spark.sparkContext
    for path in paths:
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
    return len(paths)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with files that outlive any executor, and lets Spark plan
    what follows with the written sizes.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, rows: int, most: int | None = None) -> DataFrame:
    """``df`` dealt out to tasks of about ``rows`` rows, for steps whose rows cost far more than their bytes tell; ``most`` tasks at most."""
    tasks = max(1, -(-df.count() // rows))
    return df.repartition(min(tasks, most) if most else tasks)


def by_key(df: DataFrame) -> DataFrame:
    """A side of an equality join that grows with the input: its rows meet the others' in a shuffle and are not gathered by the driver for a broadcast."""
    return df.hint("merge")


def staged_by(df: DataFrame, key: str, label: str) -> DataFrame:
    """Like :func:`staged`, with the rows in buckets of ``key``, so that grouping them by it moves none of them.

    Every task writes a file for each bucket that it meets. The table's name goes at once; its files stay.
    """
    spark = df.sparkSession
    name, path = f"staged_{uuid.uuid4().hex}", fresh_path(spark, label)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table
