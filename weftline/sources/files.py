"""Sources and sinks: line files (plain, gz, zst, zip), parallel files, scored documents, TSV, statistics."""

from __future__ import annotations

import gzip
import io
import tarfile
import zipfile
from collections.abc import Iterable, Iterator
from typing import IO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.operators.merge import zipped

ARCHIVES = (".zip", ".tar.gz", ".tgz")
DOCUMENT_SCHEMA = "lang array<string>, doc_scores array<double>, seg_langs array<string>, text string"


def resolve(location: str, mocked: dict[str, str] | None = None, lang: str | None = None) -> str:
    """A location to read: [LANG] filled in, and replaced where a test maps it elsewhere."""
    location = location.replace("[LANG]", lang) if lang else location
    return (mocked or {}).get(location, location)


def read_lines(spark: SparkSession, locations: str | list[str], path_in_archive: str | None = None) -> DataFrame:
    """(file, line_no, text) of one or many locations, ordered by path and line.

    Plain, gz and zst go through Spark's text source; a member of a zip or tar.gz is read on the executors, a file a task.
    """
    locations = [locations] if isinstance(locations, str) else locations
    zips = [x for x in locations if x.endswith(ARCHIVES)]
    rest = [x for x in locations if not x.endswith(ARCHIVES)]
    parts = []
    if rest:
        raw = spark.read.text(rest, wholetext=False).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"), F.col("value").alias("text"))
        # Lines are numbered within the splits of a file, then by the sizes of the splits before.
        split = Window.partitionBy("file", "b")
        sizes = raw.groupBy("file", "b").agg(F.count("*").alias("n"), F.min("i").alias("first"))
        sizes = sizes.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        numbered = raw.withColumn("k", F.row_number().over(split.orderBy("i")) - 1).join(sizes.drop("n", "first"), ["file", "b"])
        parts.append(numbered.select("file", (F.col("k") + F.col("before")).cast("long").alias("line_no"), "text"))
    if zips:
        parts.append(spark.read.format("binaryFile").load(zips).select("path", "content").mapInArrow(_members(path_in_archive), LINE_SCHEMA))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


LINE_SCHEMA = "file string, line_no long, text string"
#: What a batch of lines may hold, by either bound.
LINES_A_BATCH, CHARS_A_BATCH = 10_000, 4 << 20


def plain_lines(raw: IO[bytes]) -> Iterator[str]:
    """Lines ended by a line feed, a carriage return or both, as Spark's text source has it."""
    for line in io.TextIOWrapper(raw, encoding="utf-8", newline=None):
        yield line.removesuffix("\n")


def tar_lines(raw: IO[bytes], member: str | None) -> Iterator[str]:
    """Lines of one member, or the first file, of a gzipped tar that is read once from its beginning."""
    with tarfile.open(fileobj=gzip.GzipFile(fileobj=raw), mode="r:") as tar:
        for entry in tar:
            if entry.isfile() and member in (None, entry.name):
                yield from plain_lines(tar.extractfile(entry))
                return
    raise KeyError(f"no file {member!r} in the archive")


def _zip_lines(raw: IO[bytes], member: str | None) -> Iterator[str]:
    with zipfile.ZipFile(raw) as z, z.open(member or z.namelist()[0]) as inner:
        yield from plain_lines(inner)


def _members(member: str | None):
    """Lines of one member of each archive, a line at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at, own = 0, []
                for line in (_zip_lines if path.endswith(".zip") else tar_lines)(io.BytesIO(content), member):
                    own.append(line)
                    if len(own) == LINES_A_BATCH:
                        yield rows(path, at, own)
                        at, own = at + len(own), []
                if own:
                    yield rows(path, at, own)

    return run


def rows(path: str, at: int, lines: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([path] * len(lines)), pa.array(range(at, at + len(lines)), pa.int64()), pa.array(lines, pa.string())], names=["file", "line_no", "text"])


def read_parallel(spark: SparkSession, src: str, trg: str, scores: str | None = None, dataset: str = "") -> DataFrame:
    """(dataset, pos, src, trg, score) of line-aligned files; score is 1 without a score file. Raises on unequal lengths."""
    sides = {"src": src, "trg": trg} | ({"score": scores} if scores else {})
    out = zipped({k: read_lines(spark, x).select(F.col("line_no").alias("pos"), "text") for k, x in sides.items()})
    return out.select(F.lit(dataset).alias("dataset"), "pos", "src", "trg", (F.col("score").cast("double") if scores else F.lit(1.0)).alias("score"))


def read_documents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.schema(DOCUMENT_SCHEMA).json(paths)


def shuffled_paths(paths: Iterable[str], seed: int = 0) -> list[str]:
    """Shards in an order that depends on seed and name only."""
    import hashlib

    return sorted(paths, key=lambda p: (hashlib.md5(f"{seed}{p}".encode()).hexdigest(), p))


#: What marks a file as UTF-8 for programs that look for it.
BOM = "\ufeff"


def write_lines(df: DataFrame, path: str, column: str = "text", compression: str = "gzip", bom: bool = False, order: str | None = None) -> None:
    """Lines as text; with bom, one file whose first line begins with the mark, which is meant for samples: `order` sorts it."""
    if not bom:
        return df.select(column).write.text(path, compression=compression)
    one = df.coalesce(1).sortWithinPartitions(order) if order else df.coalesce(1)
    first = F.monotonically_increasing_id() == 0
    return one.select(F.when(first, F.concat(F.lit(BOM), F.col(column))).otherwise(F.col(column)).alias(column)).write.text(path, compression=compression)


def write_tsv(df: DataFrame, path: str, columns: tuple[str, ...] = ("src", "trg"), compression: str = "gzip") -> None:
    """Fields joined by tabs; tabs within a field become spaces."""
    df.select(F.concat_ws("\t", *(F.translate(c, "\t", " ") for c in columns)).alias("value")).write.text(path, compression=compression)


def write_sample(df: DataFrame, path: str, n: int = 1000, seed: int = 0) -> None:
    """A sample of n pairs for reading: source, target and a blank line, behind a UTF-8 mark."""
    from weftline.operators.sample import bounded

    some = bounded(df, n, seed, F.concat_ws("\t", "src", "trg"))
    write_lines(some.select(F.concat("src", F.lit("\n"), "trg", F.lit("\n")).alias("text")), path, compression="none", bom=True)


def write_stats(df: DataFrame, path: str) -> None:
    """Rows of statistics as JSON lines."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.text(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; an existing folder is left alone."""
    df.write.mode("ignore").csv(path, header=True)


def probe(df: DataFrame) -> tuple[bool, int]:
    """(is empty, rows)."""
    return df.isEmpty(), df.count()
