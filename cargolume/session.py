"""Session helpers: builder for local work, and the shared folder that cuts lineage."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores="8", shuffle_partitions="8", app="cargolume", memory="12g"):
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_local_folder = None


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; where it is unset, a fresh one in local mode only."""
    global _local_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share.")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _local_folder


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, label: str, spread=False) -> DataFrame:
    """Write once to the shared folder and read back.

    Unlike a cache the table survives lost executors, keeps column pruning, and fixes the rows for
    every later pass. `spread` evens out the files first: one shuffle that pays off for a table which
    is read many times, since it then uses every core and has no oversized split.
    """
    path = fresh_path(df.sparkSession, label)
    (df.hint("rebalance") if spread else df).write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept.stored_path = path
    if spread:  # the shuffle files of a large table are not kept beside it
        df.sparkSession.sparkContext._jvm.System.gc()
    return kept


def discard(*tables: DataFrame) -> None:
    """Removes stored tables, once all that was made from them is stored itself, and shuffle files that nothing refers to."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
        df.sparkSession.sparkContext._jvm.System.gc()


def literal_rows(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A small fixed table made in the JVM, without a Python worker."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.explode(F.array(*structs)).alias("x")).select("x.*")
