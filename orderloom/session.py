"""Session settings and the one place that decides where shared files go."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: SQL settings the pipelines assume. All are runtime settings, and all but the
#: time zone repeat Spark's defaults, so a plain cluster session works as well.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int = 8, app: str = "orderloom", memory: str = "12g") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for name, value in SQL_SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it.

    ``spark.checkpoint.dir`` wins. Only a local-mode session, where driver and
    executors are one process, may fall back to a folder of the session's warehouse.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/orderloom-stages"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def shared_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, for fits that read it many times.

    Losing an executor costs a re-read and not a rebuild of the joins above, and a
    reader that needs few columns reads few.
    """
    path = shared_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of a table, by Spark's estimate of its files, that one task gathers by key.
TASK_BYTES = 2 << 20
#: Spark's estimates from here on say that it knows nothing.
UNKNOWN_BYTES = 1 << 50


def estimated_bytes(df: DataFrame) -> int:
    """What Spark expects a table to hold; ``UNKNOWN_BYTES`` or more where it cannot tell."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def tasks_for(df: DataFrame, task_bytes: int = TASK_BYTES) -> int:
    """How many tasks gather a table by key: shuffle partitions, or more for a large one.

    With a fixed number of tasks, what one of them holds would grow with the table.
    """
    least, size = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), estimated_bytes(df)
    return least if size >= UNKNOWN_BYTES else max(least, -(-size // task_bytes))


def bucketed_table(df: DataFrame, key: str, label: str, buckets: int | None = None, distinct: bool = False) -> DataFrame:
    """``df`` as a table in the shared folder, bucketed and sorted by ``key``.

    What gathers or joins by the key reads it without an exchange. There are as many
    buckets as ``tasks_for`` says unless ``buckets`` does. With ``distinct`` one copy of each
    row is kept; copies meet in their bucket. The catalog gets an entry of a new name; ``forget_tables`` takes such entries, and the files, away.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    name = f"orderloom_{path.rsplit('/', 1)[1].replace('-', '_').replace('.', '_')}"
    n = buckets or tasks_for(df)
    placed = df.repartition(n, key)
    (placed.dropDuplicates() if distinct else placed).write.bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(name)
    _BUCKETED.append((name, path))
    return spark.table(name)


_BUCKETED: list[tuple[str, str]] = []


def forget_tables(spark: SparkSession) -> None:
    """Drop the bucketed tables of this process and delete their files."""
    while _BUCKETED:
        name, path = _BUCKETED.pop()
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
