"""Stage tables in the shared folder of the cluster.

A result that several later steps read is written once as parquet and read back.
That cuts its lineage, survives the loss of executors, and lets each reader prune
columns. The folder is the one the session names in ``spark.checkpoint.dir``.
"""

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_local_folders: dict[str, str] = {}
_run: contextvars.ContextVar[str | None] = contextvars.ContextVar("run", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``. A local session that names none gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_folders.setdefault(spark.sparkContext.applicationId, "") or _new_local_folder(spark)


def _new_local_folder(spark: SparkSession) -> str:
    folder = _local_folders[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="reviewsent-")
    return folder


@contextlib.contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """Stage tables made inside go to one folder, which is removed at the end.

    Results must be written or collected inside. Stage tables made outside of any run are
    left for the owner of the shared folder.
    """
    folder = f"{shared_folder(spark)}/reviewsent/run-{uuid.uuid4().hex}"
    token = _run.set(folder)
    try:
        yield folder
    finally:
        _run.reset(token)
        _delete(spark, folder)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path below the folder of the run, or else below the shared folder."""
    top = _run.get() or f"{shared_folder(spark)}/reviewsent/{spark.sparkContext.applicationId}"
    return f"{top}/{name}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the table read back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def passing_table(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """A stage table that is deleted at the end of the block; results that read it must be written inside."""
    spark = df.sparkSession
    path = new_path(spark, name)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _delete(spark, path)


@contextlib.contextmanager
def bucketed_table(df: DataFrame, name: str, column: str) -> Iterator[DataFrame]:
    """Write ``df`` to the shared folder in as many buckets of ``column`` as shuffles have partitions, and read it back.

    Nothing is shuffled for it: a task writes a file per bucket that it has rows of. Groups and joins on ``column`` read the
    buckets as they are. The table has a name in the session's catalog inside the block only; results that read
    it must be written there.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    table = f"{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").option("path", path).bucketBy(buckets, column).saveAsTable(table)
    try:
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # the files stay, as those of other stage tables


def bucket_in_turn(spark: SparkSession, number: Column) -> Column:
    """A value for each ``number`` that :func:`bucketed_table` puts in bucket ``number`` modulo buckets; their hashes
    would leave some buckets empty and others with several times their share."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    values, most = {}, 4 * buckets
    while len(values) < buckets:
        rows = spark.range(0, most, 1, 1).select(F.col("id").cast("int").alias("value"))
        found = rows.groupBy(F.pmod(F.hash("value"), F.lit(buckets)).alias("bucket")).agg(F.min("value").alias("value"))
        values, most = {r["bucket"]: r["value"] for r in found.collect()}, 4 * most  # a row per bucket
    listed = F.expr("array(" + ", ".join(str(values[b]) for b in range(buckets)) + ")")
    return F.get(listed, F.pmod(number, F.lit(buckets)))


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session, put back at the end. It holds for what is run inside."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)
