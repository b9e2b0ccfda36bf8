"""A stream of messages from a log of files, by Spark's Python data source API: from the earliest on, so many a poll, or read by
executors over ranges of the files."""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition, SimpleDataSourceStreamReader

#: Messages of one poll, where the option `most` doesn't say.
MOST = 100


class MessageLog(DataSource):
    """Options: path, a folder on any file system that pyarrow knows; most, the messages of a poll at most; suffix of the files
    that count. Files are read in the order of their names, line by line; a new one must sort behind those before it and be
    there whole. Blank lines are no messages.

    Without more a poll is a micro-batch of at most `most` messages, which come by the driver. With the option span, a
    micro-batch takes all that is there, in ranges of so many bytes: each is a task on an executor, which polls its range
    `most` messages at a time. The driver handles names and sizes of files only."""

    @classmethod
    def name(cls) -> str:
        return "message_log"

    def schema(self) -> str:
        return "value string, file string, at long"

    def streamReader(self, schema) -> RangeReader:
        return RangeReader(self.options) if "span" in self.options else super().streamReader(schema)

    def simpleStreamReader(self, schema) -> MessageLogReader:
        return MessageLogReader(self.options)


class MessageLogReader(SimpleDataSourceStreamReader):
    """Offsets are a file's name and the byte behind the last message read; the earliest is the beginning of all."""

    def __init__(self, options: dict):
        if "path" not in options:
            raise ValueError("message_log needs the option path")
        self.files, self.path = fs.FileSystem.from_uri(options["path"]) if "://" in options["path"] else (fs.LocalFileSystem(), options["path"])
        self.most, self.suffix = int(options.get("most", MOST)), options.get("suffix", "")
        if self.most < 1:
            raise ValueError("most must be at least 1")

    def initialOffset(self) -> dict:
        return {"file": "", "at": 0}

    def _held(self, since: str) -> list[tuple[str, int]]:
        """(name, size) of the files from a name on, in order."""
        held = self.files.get_file_info(fs.FileSelector(self.path))
        return sorted((f.base_name, f.size) for f in held if f.type == fs.FileType.File and f.base_name >= since and f.base_name.endswith(self.suffix) and f.base_name[0] not in "._")

    def _messages(self, start: dict) -> Iterator[tuple[str, str, int]]:
        """(message, file, byte behind it) from an offset on."""
        for name, _ in self._held(start["file"]):
            with io.BufferedReader(self.files.open_input_file(f"{self.path}/{name}")) as held:
                at = start["at"] if name == start["file"] else 0
                held.seek(at)
                for line in iter(held.readline, b""):
                    at += len(line)
                    if text := line.rstrip(b"\r\n"):
                        yield text.decode("utf-8", "replace"), name, at

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows = []
        for row in self._messages(start):
            rows.append(row)
            if len(rows) == self.most:
                break
        return iter(rows), {"file": rows[-1][1], "at": rows[-1][2]} if rows else start

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        for row in self._messages(start):
            if (row[1], row[2]) > (end["file"], end["at"]):
                return
            yield row

    def commit(self, end: dict) -> None:
        """The stream's checkpoint holds what has been read."""


@dataclass
class Range(InputPartition):
    """Messages that begin at bytes from start on and before end."""

    file: str
    start: int
    end: int


class RangeReader(MessageLogReader, DataSourceStreamReader):
    """Offsets as MessageLogReader's, always at the end of a file."""

    def __init__(self, options: dict):
        super().__init__(options)
        self.span = int(options["span"])
        if self.span < 1:
            raise ValueError("span must be at least 1")

    def latestOffset(self) -> dict:
        held = self._held("")
        return {"file": held[-1][0], "at": held[-1][1]} if held else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Range]:
        out = []
        for name, size in self._held(start["file"]):
            if name > end["file"]:
                break
            first, last = start["at"] if name == start["file"] else 0, end["at"] if name == end["file"] else size
            out += [Range(name, at, min(last, at + self.span)) for at in range(first, last, self.span)]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        told = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int64()))], ["value", "file", "at"])
        with io.BufferedReader(self.files.open_input_file(f"{self.path}/{partition.file}"), 1 << 20) as held:
            at = partition.start
            if at:  # a line that began before the range is the range's before
                held.seek(at - 1)
                at += len(held.readline()) - 1
            while at < partition.end and (line := held.readline()):
                at += len(line)
                if text := line.rstrip(b"\r\n"):
                    rows.append((text.decode("utf-8", "replace"), partition.file, at))
                    if len(rows) == self.most:
                        yield told()
                        rows.clear()
        if rows:
            yield told()

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        raise NotImplementedError("ranges are read by partitions")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(MessageLog)
