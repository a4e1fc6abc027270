"""Lines of remote files, streamed on the executors: a location a task, in chunks that resume after a broken connection.

Bytes go through bounded buffers only: no file is landed, and a task that is run again reads its location anew.
"""

from __future__ import annotations

import gzip
import http.client
import io
import json
import time
import urllib.error
import urllib.request
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from weftline.sources import files

CHUNK = 8 * 1024
#: Bytes of a zip that one request asks for.
WINDOW = 1 << 20
#: Answers of a server that a further try may change; other refusals are final.
PASSING = (408, 425, 429)


class DownloadError(OSError):
    """All tries of a download failed."""


def is_remote(location: str) -> bool:
    return location.startswith(("http://", "https://"))


class Download(io.RawIOBase):
    """The bytes of a URL as a file to read on from. A broken connection is taken up where it stopped, `tries` times in all.

    A server that ignores the range asked for sends the file anew; what was read before is skipped.
    """

    def __init__(self, url: str, tries: int = 3, timeout: float = 10.0, wait: float = 60.0, start: int = 0, end: int | None = None) -> None:
        self.url, self.tries, self.timeout, self.wait, self.end = url, tries, timeout, wait, end
        self.at, self.failed, self.kind, self.response = start, 0, "", None

    def readable(self) -> bool:
        return True

    def connect(self) -> None:
        part = f"bytes={self.at}-{'' if self.end is None else self.end - 1}"
        ask = urllib.request.Request(self.url, headers={} if part == "bytes=0-" else {"Range": part})
        self.response = urllib.request.urlopen(ask, timeout=self.timeout)  # noqa: S310
        self.kind = self.response.headers.get("Content-Type", "")
        length, skip = self.response.headers.get("Content-Length"), self.at if self.response.status == 200 else 0
        if self.end is None and length is not None:
            self.end = int(length) + self.at - skip
        while skip:
            got = len(self.response.read(min(skip, CHUNK)))
            if not got:
                raise ConnectionError("the file ended before the place to go on from")
            skip -= got

    def readinto(self, buffer) -> int:
        while True:
            try:
                if self.end is not None and self.at >= self.end:
                    return 0
                if self.response is None:
                    self.connect()
                most = min(len(buffer), CHUNK) if self.end is None else min(len(buffer), CHUNK, self.end - self.at)
                data = self.response.read(most)
                if most and not data and self.end is not None:
                    raise ConnectionError(f"the connection ended at byte {self.at} of {self.end}")
                buffer[: len(data)] = data
                self.at += len(data)
                return len(data)
            except (OSError, http.client.HTTPException) as error:
                self.hang_up()
                self.failed += 1
                final = isinstance(error, urllib.error.HTTPError) and 400 <= error.code < 500 and error.code not in PASSING
                if final or self.failed >= self.tries:
                    raise DownloadError(f"{self.url}: {error}") from error
                time.sleep(self.wait)

    def hang_up(self) -> None:
        if self.response is not None:
            self.response.close()
        self.response = None

    def close(self) -> None:
        self.hang_up()
        super().close()


class Ranges(io.RawIOBase):
    """A URL as a file that can be sought in: each read is a request for its range, resumed like any download."""

    def __init__(self, url: str, **options) -> None:
        self.url, self.options, self.at, self.length = url, options, 0, size(url, **options)

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        self.at = offset + {io.SEEK_SET: 0, io.SEEK_CUR: self.at, io.SEEK_END: self.length}[whence]
        return self.at

    def tell(self) -> int:
        return self.at

    def readinto(self, buffer) -> int:
        most = min(len(buffer), self.length - self.at)
        if most <= 0:
            return 0
        with Download(self.url, **self.options, start=self.at, end=self.at + most) as d:
            data = io.BufferedReader(d, CHUNK).read(most)
        buffer[: len(data)] = data
        self.at += len(data)
        return len(data)


def size(location: str, timeout: float = 10.0, **_) -> int:
    """Bytes of a remote file as its server states them; raises where it doesn't."""
    with urllib.request.urlopen(urllib.request.Request(location, method="HEAD"), timeout=timeout) as r:  # noqa: S310
        length = r.headers.get("Content-Length")
    if length is None:
        raise DownloadError(f"{location}: no length given")
    return int(length)


def exists(spark: SparkSession, location: str, timeout: float = 10.0) -> bool:
    """Whether a location is there: a URL by its headers, any other path through Hadoop's file systems."""
    if is_remote(location):
        try:
            with urllib.request.urlopen(urllib.request.Request(location, method="HEAD"), timeout=timeout):  # noqa: S310
                return True
        except urllib.error.HTTPError as error:
            if error.code in (404, 410):
                return False
            raise
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def text_lines(location: str, member: str | None = None, **options) -> Iterator[str]:
    """Lines of a URL. What packs it is told by the end of its path or, where that says nothing, by its content type."""
    path = location.split("?")[0].split("#")[0]
    if path.endswith(".zip"):
        with zipfile.ZipFile(io.BufferedReader(Ranges(location, **options), WINDOW)) as z, z.open(member or z.namelist()[0]) as raw:
            yield from files.plain_lines(raw)
        return
    with Download(location, **options) as d:
        raw = io.BufferedReader(d, CHUNK)
        raw.peek(1)
        if path.endswith((".tar.gz", ".tgz")):
            yield from files.tar_lines(raw, member)
        elif path.endswith(".gz") or (d.kind in ("application/gzip", "application/x-gzip")):
            yield from files.plain_lines(gzip.GzipFile(fileobj=raw))
        elif path.endswith(".zst") or d.kind == "application/zstd":
            import zstandard

            yield from files.plain_lines(zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True))
        else:
            yield from files.plain_lines(raw)


class Location(InputPartition):
    def __init__(self, url: str) -> None:
        super().__init__(url)


class RemoteReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.urls, self.member = json.loads(options["urls"]), options.get("member")
        self.how = {k: t(options[k]) for k, t in (("tries", int), ("timeout", float), ("wait", float)) if k in options}

    def partitions(self) -> list[InputPartition]:
        return [Location(u) for u in self.urls]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        at, own, chars = 0, [], 0
        for line in text_lines(partition.value, self.member, **self.how):
            own.append(line)
            chars += len(line)
            if len(own) == files.LINES_A_BATCH or chars > files.CHARS_A_BATCH:
                yield files.rows(partition.value, at, own)
                at, own, chars = at + len(own), [], 0
        if own:
            yield files.rows(partition.value, at, own)


class RemoteLines(DataSource):
    """spark.read.format("remote_lines"): options urls (a JSON list), member, tries, timeout, wait."""

    @classmethod
    def name(cls) -> str:
        return "remote_lines"

    def schema(self) -> str:
        return files.LINE_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return RemoteReader(self.options)


def read(spark: SparkSession, locations: str | list[str], member: str | None = None, **options) -> DataFrame:
    """(file, line_no, text) of locations of any kind; URLs are streamed, all others go through files.read_lines."""
    locations = [locations] if isinstance(locations, str) else locations
    urls, rest = [x for x in locations if is_remote(x)], [x for x in locations if not is_remote(x)]
    parts = []
    if urls:
        spark.dataSource.register(RemoteLines)
        source = spark.read.format("remote_lines").option("urls", json.dumps(urls)).options(**options)
        parts.append((source.option("member", member) if member else source).load())
    if rest:
        parts.append(files.read_lines(spark, rest, member))
    return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0]
