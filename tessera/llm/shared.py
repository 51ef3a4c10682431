"""Helpers of the training-data operators: shared scratch tables, salts and let-bindings."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITESPACE = " \t\n\x0b\x0c\r"

#: A table of so many rows is broadcast; beyond, its join is salted.
BROADCAST_ROWS = 100_000
SALTS = 16
MAX_LABELS = 4096

_fallback: list[str] = []
_written: list[tuple[SparkSession, str]] = []


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir where it is set.

    Unset: under the warehouse on a cluster, a temp folder only in local mode, where the
    driver is the one executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master.startswith("local") and not master.startswith("local-cluster"):
        if not _fallback:
            _fallback.append(tempfile.mkdtemp(prefix="tessera-"))
        return "file://" + _fallback[0]
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/tessera/{label}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def write_table(df: DataFrame, label: str) -> DataFrame:
    """Cuts lineage: writes the rows to the shared folder and reads them back.

    A lost executor then costs a re-read, not a recomputation, and two readers of the result
    don't compute it twice.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tessera_path = path
    return out


def drop_table(df: DataFrame) -> None:
    """Deletes a table of write_table() that nothing reads any more."""
    path = getattr(df, "_tessera_path", None)
    if path:
        drop_path(df.sparkSession, path)


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
                drop_path(spark, path)
        except Exception:
            return


def join_small(df: DataFrame, small: DataFrame, key: list[str], how: str) -> DataFrame:
    """A join with a written table of unique keys that is often small, without a hot key in one task.

    The table's rows are counted. Up to BROADCAST_ROWS, of some tens of bytes each, it is broadcast.
    Beyond, the large side is salted by its own columns and the table repeated for each salt, so
    that rows of one key meet it in SALTS tasks.
    """
    if small.count() <= BROADCAST_ROWS:
        return df.join(F.broadcast(small), key, how)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [*key, "_salt"], how).drop("_salt")


def let(value: Column, body) -> Column:
    """body(value) with value computed once: a lambda variable, not an inlined expression."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words [^\\x20\\x09-\\x0D]+ of a text; null and blank texts have none.

    Plain replacements and a split at one character need no pattern engine.
    """
    spaced = F.coalesce(text, F.lit(""))
    for c in WHITESPACE[1:]:
        spaced = F.replace(spaced, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(spaced, " "), "")


def by_slices(work, rows: int = 1000):
    """A function of one record batch as one of an iterator of them, a slice at a time.

    What Arrow's pool has freed goes back to the system after each batch, so a worker that is used
    again by later stages doesn't hold the peaks of earlier ones.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield work(batch.slice(at, rows))
            del batch
            pa.default_memory_pool().release_unused()

    return run


def release() -> None:
    """Gives back to the system what this process has freed, Arrow's pool and, where it can be asked to, the C library's."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def freeing(work):
    """A function of one table, or of two, that doesn't begin on what earlier stages left in the worker nor leave its own."""

    def one(table):
        release()
        out = work(table)
        release()
        return out

    def two(left, right):
        release()
        out = work(left, right)
        release()
        return out

    return two if work.__code__.co_argcount == 2 else one


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def even_labels(spark: SparkSession, count: int) -> list[int]:
    """One integer for each of so many shuffle partitions, such that a shuffle by them puts one in each.

    Spark deals integers by a hash, which would put five of fifty groups into one of fifty tasks. Beyond
    MAX_LABELS the numbers themselves do: few of that many tasks run at once anyway.
    """
    if count > MAX_LABELS:
        return list(range(count))
    found: dict[int, int] = {}
    span = max(1024, 16 * count)
    while len(found) < count:
        rows = spark.range(span).select(F.col("id").cast("int").alias("label"))
        rows = rows.groupBy(F.pmod(F.hash("label"), F.lit(count)).alias("slot")).agg(F.min("label").alias("label"))
        found = {r["slot"]: r["label"] for r in rows.collect()}  # MAX_LABELS rows at most
        span *= 4
    return [found[slot] for slot in sorted(found)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
