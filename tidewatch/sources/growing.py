"""Follow files that a collector appends to: a streaming source of their lines.

Spark's file source takes whole files; a log that keeps growing needs an offset of
(file, byte position), which is what this Python stream data source keeps in the
query's checkpoint.  A batch's range ends behind a line break, so a line that is
still being written is held back until it is whole.  Files are known by a
fingerprint, the hash of their first line: one that rotation renames goes on at its
position, and a new one under the old name starts at 0, as a tailing agent's
position file has it.  (Files with the same first line are told apart by name.)

A batch takes all whole lines that are there; its ranges are cut into partitions of
bounded size, so a large backlog is read in parallel.  The driver reads only first
lines and the last line breaks.  A file that is removed is forgotten, and one that is
cut short under the same first line is not followed.  Files are
opened through Arrow's file systems (local, HDFS, S3, GCS), so the folder must be
visible to the executors.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidewatch.session import ship_package

FORMAT = "growing_lines"
#: Bytes a partition reads at most (and the rest of its last line).
PARTITION_BYTES = 64 << 20
_STEP = 1 << 16


class Range(InputPartition):
    """Lines that start at bytes ``begin`` to ``end`` of ``path``."""

    def __init__(self, path: str, begin: int, end: int):
        self.path, self.begin, self.end = path, begin, end


def _open(root: str):
    """(file system, folder inside it)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)


def _first_line(stream, size: int) -> bytes | None:
    """The first whole line, or None while there is none."""
    head = b""
    while len(head) < size:
        more = stream.read_at(min(_STEP, size - len(head)), len(head))
        if not more:
            break
        head += more
        if (k := head.find(b"\n")) >= 0:
            return head[:k]
    return None


def _last_break(stream, begin: int, end: int) -> int:
    """The place behind the last line break of bytes ``begin`` to ``end``, or ``begin``."""
    while end > begin:
        at = max(begin, end - _STEP)
        k = stream.read_at(end - at, at).rfind(b"\n")
        if k >= 0:
            return at + k + 1
        end = at
    return begin


def _next_break(stream, begin: int, size: int) -> int:
    """The place behind the first line break from ``begin`` on, or ``begin``."""
    at = begin
    while at < size:
        k = stream.read_at(min(_STEP, size - at), at).find(b"\n")
        if k >= 0:
            return at + k + 1
        at += _STEP
    return begin


class GrowingLinesReader(DataSourceStreamReader):
    """Offsets are ``{fingerprint: [path, position]}``."""

    def __init__(self, options: dict):
        self.root = options["path"].rstrip("/")
        self.suffix = options.get("suffix", "")
        self.partition_bytes = int(options.get("partitionBytes", PARTITION_BYTES))
        self._reached: dict = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """The place behind the last line break of every file."""
        out = {}
        for path, name, size in self._files():
            with self._fs.open_input_file(path) as stream:
                line = _first_line(stream, size)
                if line is None:
                    continue
                key = hashlib.sha256(line).hexdigest()
                if key in out:
                    key += f"@{name}"
                out[key] = [path, _last_break(stream, 0, size)]
        # a listing may miss a file that is just being renamed: it keeps its position
        for key, place in self._reached.items():
            out.setdefault(key, place)
        self._reached = dict(out)
        return out

    def _files(self) -> list[tuple[str, str, int]]:
        from pyarrow import fs

        self._fs, folder = _open(self.root)
        found = self._fs.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        files = [f for f in found if f.type == fs.FileType.File and f.base_name.endswith(self.suffix) and not f.base_name.startswith((".", "_"))]
        return [(f.path, f.base_name, f.size) for f in sorted(files, key=lambda f: f.base_name)]

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out: list[InputPartition] = []
        for key, (path, to) in end.items():
            at = start.get(key, [None, 0])[1]
            while at < to:
                out.append(Range(path, at, min(to, at + self.partition_bytes)))
                at += self.partition_bytes
        return out

    def read(self, partition: Range) -> Iterator[tuple]:
        """The lines that start inside the range.  A cut inside a line leaves it to
        the range that holds its first byte, which reads on to its end."""
        fs, _ = _open(self.root)
        with fs.open_input_file(partition.path) as stream:
            size = stream.size()
            at, rest = partition.begin, b""
            if at and stream.read_at(1, at - 1) != b"\n":
                at = _next_break(stream, at, size)
                if at >= partition.end:
                    return
            start = at
            while at < size:
                data = stream.read_at(min(_STEP, size - at), at)
                if not data:
                    return
                at += len(data)
                parts = (rest + data).split(b"\n")
                rest = parts.pop()
                for line in parts:
                    if start >= partition.end:
                        return
                    start += len(line) + 1
                    yield (line.removesuffix(b"\r").decode("utf-8", "replace"),)
                if start >= partition.end:
                    return

    def commit(self, end: dict) -> None:
        """Nothing to do: the position is the checkpoint's."""


class GrowingLines(DataSource):
    """``spark.readStream.format("growing_lines").load(folder)``: column ``value``.

    Options: ``suffix`` (of the names to follow), ``partitionBytes``.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return GrowingLinesReader(dict(self.options))


def growing_lines(spark: SparkSession, folder: str, **options) -> DataFrame:
    """A stream of the lines of all files in ``folder``, appended ones as they come."""
    ship_package(spark)
    spark.dataSource.register(GrowingLines)
    return spark.readStream.format(FORMAT).options(**{k: str(v) for k, v in options.items()}).load(folder)


def position(offset: str | dict) -> dict[str, int]:
    """Position per path of an offset, as a progress report shows it."""
    return {path: at for path, at in (json.loads(offset) if isinstance(offset, str) else offset).values()}
