"""Shared pieces of the training-data operators: tables, scratch storage, code shipping."""

import atexit
import sys
import tempfile
import uuid
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARROW_ROWS, ARROW_BYTES = 1000, 8 << 20  # rows and bytes of an Arrow batch: long texts stay within a worker's memory


def ship(module: str) -> None:
    """Send a module's functions to Python workers by value, so that executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tune(spark: SparkSession) -> None:
    """Smaller Arrow batches, by rows and by bytes (session settings); never larger ones than the session has. A batch
    ends with the row that passes the bound, so that it holds one text more than ARROW_BYTES at most."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def arrow_column(kind: str):
    """Decorator: a function over Arrow arrays as one over columns; the UDF is made when there is a session. It is called
    nondeterministic so that Spark doesn't compute it a second time for a filter on its result."""

    def wrap(function):
        return lambda *columns: F.arrow_udf(function, kind).asNondeterministic()(*columns)

    return wrap


def utf8(column: str = "text"):
    """A text column as bytes; null reads as empty."""
    return F.coalesce(F.col(column).cast("string").cast("binary"), F.lit(b""))


def id_remainder(modulus: int, column: str = "doc_id"):
    """crc32 of the id as text, modulo `modulus`; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def hash_sample(df: DataFrame, key, most: int) -> DataFrame:
    """At most `most` rows, of different keys, those of the smallest hashes: however many copies a key has, it counts
    once. Rows are thinned by hash first, to about one and a half times as many, so that what tasks pass on for the
    final sort stays small however many tasks there are."""
    df = df.dropDuplicates([key])
    h = F.xxhash64(key)
    n = df.count()
    if n > 2 * most:
        df = df.where(F.pmod(h, F.lit(1 << 40)) < int(1.5 * most / n * (1 << 40)) + (1 << 20))
    return df.orderBy(F.pmod(h, F.lit(1 << 40)), key).limit(most)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a temporary one only where none is set and all runs on this machine."""
    jsc = spark.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isEmpty():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not jsc.isLocal():
            raise ValueError("spark.checkpoint.dir isn't set: name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(shared or tempfile.mkdtemp(prefix="kindred-checkpoint-"))
    return jsc.getCheckpointDir().get()


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """What a query run in here shuffles leaves the executors' disks as the query ends. Spark else keeps it until the
    driver's next garbage collection, which may not come before later queries have filled the disks."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    told = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if told is None else spark.conf.set(key, told)


class Scratch:
    """Intermediate tables, written as Parquet in the shared checkpoint folder: lineage ends there,
    a lost executor costs no recomputation, and other executors can read them. Removed at exit."""

    def __init__(self, spark: SparkSession, name: str):
        tune(spark)
        self.spark, self.base = spark, f"{checkpoint_dir(spark)}/kindred-{name}-{uuid.uuid4().hex}"
        atexit.register(self._leave)

    def _leave(self):
        try:
            drop_path(self.spark, self.base)
        except Exception:  # the session has ended: nothing can be removed any more
            pass

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        drop_path(self.spark, f"{self.base}/{name}")
