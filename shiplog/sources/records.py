"""Records of enclosed-delimited files with their places: a splittable source.

A file is planned as byte ranges. A task reads the records that start in its
range: it looks for the first record end at or after the byte before the
range, and reads on past the range's end to finish its last record. So every
record is read once, whatever the range size, and its byte offset is known.
Record numbers need no sort: counts per range, summed up over the ranges
before, plus the position in the range.

A self-contained loader file starts with its control lines; its records start
after the line ``begindata``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiplog.functions.text import RECORD_END
from shiplog.operators.catalog import SPEC_FOOTER
from shiplog.session import freeze

SOURCE = "enclosed_records"
SPLIT_BYTES = 64 << 20
#: Bytes that a task reads at a time.
READ_BYTES = 4 << 20
SCHEMA = "file string, file_no int, split int, pos long, start long, record string"
_DATA_LINE = SPEC_FOOTER[-1]


def _source(end: bytes, data_line: bytes):
    """The data source class, made here so that it is shipped by value."""
    import os

    import pyarrow as pa
    from pyarrow import fs as pafs
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    class Range(InputPartition):
        def __init__(self, file: str, file_no: int, split: int, first: int, lo: int, hi: int):
            self.file, self.file_no, self.split, self.first, self.lo, self.hi = file, file_no, split, first, lo, hi

    def opened(uri: str):
        store, path = pafs.FileSystem.from_uri(uri) if ":" in uri.split("/")[0] else (pafs.LocalFileSystem(), uri)
        return store, path

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.path = options["path"]
            self.split_bytes = int(options.get("splitbytes", SPLIT_BYTES))
            self.self_contained = options.get("selfcontained", "false") == "true"

        def _files(self):
            store, path = opened(self.path)
            info = store.get_file_info(path)
            if info.type == pafs.FileType.File:
                return store, [info]
            if info.type == pafs.FileType.NotFound:
                raise FileNotFoundError(self.path)
            found = store.get_file_info(pafs.FileSelector(path))
            own = [i for i in found if i.type == pafs.FileType.File and not os.path.basename(i.path).startswith(("_", "."))]
            # part files by number: names of six digits sort before those of five
            number = lambda i: int("".join(c for c in i.base_name.split("-")[1] if c.isdigit()) or 0) if i.base_name.startswith("part-") else -1
            return store, sorted(own, key=lambda i: (number(i), i.path))

        def _first(self, store, path: str, size: int) -> int:
            """Where the records start: after the data line, in its own line."""
            if not self.self_contained:
                return 0
            head, line = b"\n", b"\n" + data_line + b"\n"
            with store.open_input_file(path) as f:
                while line not in head:
                    more = f.read(READ_BYTES)
                    if not more:
                        raise ValueError(f"{path}: no line {data_line.decode()}")
                    head += more
            return head.index(line) + len(line) - 1

        def partitions(self):
            store, files = self._files()
            out = []
            for number, info in enumerate(files):
                first = self._first(store, info.path, info.size)
                starts = list(range(first, info.size, self.split_bytes))
                out += [Range(info.path, number, k, first, lo, min(info.size, lo + self.split_bytes)) for k, lo in enumerate(starts)]
            return out or [Range("", 0, 0, 0, 0, 0)]

        def read(self, partition):
            if not partition.file:
                return
            store, _ = opened(self.path)
            with store.open_input_file(partition.file) as f:
                yield from self._records(f, partition)

        def _records(self, f, p):
            size = f.size()
            at = p.lo if p.lo == p.first else max(p.first, p.lo - len(end))
            f.seek(at)
            held, start, pos = b"", p.lo if p.lo == p.first else None, 0
            while True:
                block = f.read(READ_BYTES)
                held += block
                rows: list[tuple[int, bytes]] = []
                i = 0  # consumed bytes of what is held, which begins at `at`
                if start is None:
                    k = held.find(end)
                    if k < 0:
                        if not block:
                            return
                        keep = min(len(held), len(end) - 1)
                        at += len(held) - keep
                        held = held[len(held) - keep :]
                        if at >= p.hi:
                            return
                        continue
                    i = k + len(end)
                    start = at + i
                while start < p.hi:
                    k = held.find(end, i)
                    if k < 0:
                        break
                    rows.append((start, held[i:k]))
                    i = k + len(end)
                    start = at + i
                if not block and start < p.hi and i < len(held):  # no end after the last record
                    rows.append((start, held[i:]))
                    start = size
                held, at = held[i:], at + i
                if rows:
                    n = len(rows)
                    columns = [
                        pa.array([p.file] * n), pa.array([p.file_no] * n, pa.int32()), pa.array([p.split] * n, pa.int32()), pa.array(range(pos, pos + n), pa.int64()),
                        pa.array([s for s, _ in rows], pa.int64()), pa.array([r.decode("utf-8", "replace") for _, r in rows], pa.string()),
                    ]
                    pos += n
                    yield pa.RecordBatch.from_arrays(columns, ["file", "file_no", "split", "pos", "start", "record"])
                if not block or start >= p.hi:
                    return

    class Records(DataSource):
        @classmethod
        def name(cls):
            return SOURCE

        def schema(self):
            return SCHEMA

        def reader(self, schema):
            return Reader(self.options)

    return Records


def read_records(spark: SparkSession, path: str, self_contained: bool = False, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``DF(file, file_no, split, pos, start, record)`` of a file or a folder of
    part files: every record with its byte offset ``start``."""
    spark.dataSource.register(_source(RECORD_END.encode(), _DATA_LINE.encode()))
    reader = spark.read.format(SOURCE).option("path", path).option("splitBytes", str(split_bytes))
    return reader.option("selfContained", str(self_contained).lower()).load()


def numbered(records: DataFrame, name: str = "record_no") -> DataFrame:
    """``records`` (stored or cheap to read twice) with their number from 1 in
    file order. Only one row per byte range is ordered."""
    ranges = records.groupBy("file_no", "split").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("file_no", "split").rowsBetween(Window.unboundedPreceding, -1)
    ranges = freeze(ranges.select("file_no", "split", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")), "ranges")
    return records.join(ranges, ["file_no", "split"]).withColumn(name, F.col("_before") + F.col("pos") + 1).drop("_before")
