"""Lines of growing files as a stream: the checkpoint holds how far each file was read, so a restart goes on from there."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Bytes looked at together for the last end of a line, and read together by a task.
WINDOW = 1 << 20


class Stretch(InputPartition):
    """Whole lines of one file: from byte start to byte end."""

    def __init__(self, path: str, start: int, end: int) -> None:
        super().__init__((path, start, end))


def last_line_end(fs: pafs.FileSystem, path: str, start: int, size: int) -> int:
    """The byte behind the last line feed between start and size; start where there is none."""
    with fs.open_input_file(path) as f:
        high = size
        while high > start:
            low = max(start, high - WINDOW)
            at = f.read_at(high - low, low).rfind(b"\n")
            if at >= 0:
                return low + at + 1
            high = low
    return start


class TailReader(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.folder = options["path"]
        self.seen: dict[str, int] = {}

    def files(self) -> tuple[pafs.FileSystem, list[pafs.FileInfo]]:
        fs, root = pafs.FileSystem.from_uri(self.folder)
        found = fs.get_file_info(pafs.FileSelector(root, recursive=True))
        return fs, sorted((f for f in found if f.is_file and not f.base_name.startswith((".", "_"))), key=lambda f: f.path)

    def initialOffset(self) -> dict:  # noqa: N802
        return {"files": "{}"}

    def latestOffset(self) -> dict:  # noqa: N802
        """How far whole lines reach in each file; a file that is shorter than before was written anew and starts over."""
        fs, found = self.files()
        ends = {}
        for f in found:
            known = self.seen.get(f.path, 0)
            start = known if known <= f.size else 0
            ends[f.path] = last_line_end(fs, f.path, start, f.size)
        self.seen = ends
        return {"files": json.dumps(ends, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        before, after, out = json.loads(start["files"]), json.loads(end["files"]), []
        for path, stop in after.items():
            at = before.get(path, 0)
            if stop != at:
                out.append(Stretch(path, at if at < stop else 0, stop))
        return out

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        path, start, end = partition.value
        fs, _ = pafs.FileSystem.from_uri(self.folder)
        with fs.open_input_file(path) as f:
            at, rest, rest_at = start, b"", start
            while at < end:
                block = f.read_at(min(WINDOW, end - at), at)
                if not block:
                    raise OSError(f"{path} ended at byte {at} of {end}")
                at += len(block)
                whole = rest + block
                cut = whole.rfind(b"\n") + 1
                if cut:
                    yield _batch(path, rest_at, whole[:cut])
                    rest_at += cut
                rest = whole[cut:]

    def commit(self, end: dict) -> None:
        pass


def _batch(path: str, at: int, block: bytes) -> pa.RecordBatch:
    """(file, at, text): a line each; `at` is the byte where it begins, which orders a file's lines."""
    places, texts = [], []
    for line in block.split(b"\n")[:-1]:
        places.append(at)
        texts.append(line.removesuffix(b"\r").decode("utf-8", "replace"))
        at += len(line) + 1
    return pa.RecordBatch.from_arrays([pa.array([path] * len(texts)), pa.array(places, pa.int64()), pa.array(texts, pa.string())], names=["file", "at", "text"])


class TailLines(DataSource):
    """spark.readStream.format("tail_lines").load(folder): a URI or absolute path that driver and executors share."""

    @classmethod
    def name(cls) -> str:
        return "tail_lines"

    def schema(self) -> str:
        return "file string, at long, text string"

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return TailReader(self.options)


def tail(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of (file, at, text): the lines that files of a folder have and get. A line counts once it has ended."""
    spark.dataSource.register(TailLines)
    return spark.readStream.format("tail_lines").load(folder)
