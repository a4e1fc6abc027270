"""What the operators of this subpackage share: sessions, scratch tables, Arrow plumbing."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of one batch that a Python function sees: whole texts, so both are kept low. A longer text is a batch.
BATCH_ROWS, BATCH_BYTES = 1024, 4_000_000
#: ASCII blanks: the only separators between words in the contracts of these operators.
BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

_own_dir: str | None = None
_scratch: list[str] = []


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package. The session's settings are left alone."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
    return spark


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Session settings (dots written as two underscores) for as long as something runs, then as they were."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset, a local master gets a temporary folder; on a cluster that is an error, since executors would write
    where nobody else can read.
    """
    global _own_dir
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="weftline-")
        atexit.register(shutil.rmtree, _own_dir, ignore_errors=True)
    return f"file://{_own_dir}"


def stored(df: DataFrame, label: str, partition_by: str | None = None, codec: str = "zstd", batch_rows: int = BATCH_ROWS, **options: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends here, and lost executors lose nothing.

    Shuffle files of the finished write are of no further use and are removed with it, and the Arrow batches that go to
    Python meanwhile are kept low. What a query returns unwritten runs under the caller's own settings instead, and is cut
    to low batches on the Python side only.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/weftline-{label}-{uuid.uuid4().hex}"
    _scratch.append(path)
    writer = df.write.options(compression=codec, **options)
    arrow = {"spark__sql__execution__arrow__maxRecordsPerBatch": str(batch_rows), "spark__sql__execution__arrow__maxBytesPerBatch": str(BATCH_BYTES)}
    with settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true", **arrow):
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(*tables: DataFrame | None, part: str | None = None) -> None:
    """Delete stored tables, or a partition folder of them, that nothing will read again."""
    for t in tables:
        if (path := getattr(t, "_scratch_path", None)) in _scratch:
            _delete(t.sparkSession, path, part)


def release(spark: SparkSession) -> None:
    """Delete all tables that were stored so far; call it once the results that read them are written."""
    for path in list(_scratch):
        _delete(spark, path)


def _delete(spark: SparkSession, path: str, part: str | None = None) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{path}/{part}" if part else path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    if not part:
        _scratch.remove(path)


def spread(df: DataFrame, rows: int, *columns: str | Column, per: int = 100_000) -> DataFrame:
    """df dealt by columns to as many partitions as so many rows need, up to the session's: small tables stay in few tasks."""
    return df.repartition(max(1, min(partitions(df.sparkSession), -(-rows // per))), *columns)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just id and text, under names of our own, so that further columns cannot clash; null text is empty."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def row_key(id_col: Column, text: Column) -> Column:
    """A digest of id and text (null text: empty): rows that share it are the same document."""
    return F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("-")), F.lit(":"), F.coalesce(text.cast("string"), F.lit(""))))


def carried(df: DataFrame, *columns: str) -> DataFrame:
    """The whole row as one column `_row` beside some of its columns: whatever a stage adds can't clash with the rest."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *columns)


def relax() -> None:
    """Give freed memory back to the system: workers live long, and what they keep counts against their executor."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def pieces_of(batch: pa.RecordBatch, rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in parts of at most so many rows and about so many bytes, in order; empty batches fall away."""
    at = 0
    while at < batch.num_rows:
        n = min(rows, batch.num_rows - at)
        while n > 1 and batch.slice(at, n).nbytes > size:
            n = -(-n // 2)
        # A copy: what a slice shares with the rest is not every Arrow function's concern.
        yield batch if n == batch.num_rows else batch.take(pa.array(range(at, at + n), pa.int64()))
        at += n


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], object]], schema: str, rows: int = BATCH_ROWS) -> DataFrame:
    """mapInArrow where make() gives, once per task, the function from a batch to columns (or to None).

    Batches are cut by pieces_of first. The function returns a list of arrays in the order of the schema.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for whole in batches:
            for batch in pieces_of(whole, rows):
                if (cols := work(batch)) is not None:
                    yield pa.RecordBatch.from_arrays([x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x) for x in cols], names=names)
                    del cols
        relax()

    names = [x.strip().split(" ")[0] for x in schema.split(",")]
    return df.mapInArrow(run, schema)
