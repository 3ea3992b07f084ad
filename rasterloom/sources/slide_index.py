"""Binary tile index: a data source with a partition for each (level, filter), payloads, positions.

The file is little-endian: a version of 5 and an id of 32 characters, then the roots of the
hierarchical (at 37) and other (at 41) records. A record points to a list head of 8 bytes,
whose second number is the first page; a page has its count, the next page and entries of
16 bytes: image, offset, length, file. All numbers are unsigned.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: The versions that can be read, and bounds beyond which a file is taken for damaged.
VERSIONS = (b"01.01", b"01.02")
HEADER, MAX_PAGE_ENTRIES, MAX_PAGES = 45, 10_000_000, 100_000

SCHEMA = "level INT, filter INT, image_index BIGINT, offset BIGINT, length BIGINT, file_number BIGINT"


def _numbers(data: bytes, at: int, n: int, what: str) -> tuple[int, ...]:
    if at < 0 or at + 4 * n > len(data):
        raise ValueError(f"{what} at {at} lies outside the index of {len(data)} bytes")
    return struct.unpack_from(f"<{n}I", data, at)


def check_header(data: bytes, slide_id: str) -> int:
    """Root of the hierarchical records."""
    if data[:5] not in VERSIONS:
        raise ValueError(f"unsupported index version {data[:5]!r}")
    if data[5:37].decode("ascii", "replace") != slide_id:
        raise ValueError("the index belongs to another slide")
    return _numbers(data, 37, 1, "root")[0]


def flat_index(coordinates: list[int], counts: list[int]) -> int:
    """Mixed radix, the first dimension running fastest."""
    if len(coordinates) != len(counts) or any(not 0 <= c < n for c, n in zip(coordinates, counts, strict=True)):
        raise ValueError(f"coordinates {coordinates} do not fit {counts}")
    flat, stride = 0, 1
    for c, n in zip(coordinates, counts, strict=True):
        flat, stride = flat + c * stride, stride * n
    return flat


def flat_index_column(coordinates: Column, counts: Column) -> Column:
    """The same for array columns."""
    both = F.arrays_zip(coordinates.alias("c"), counts.alias("n"))
    start = F.struct(F.lit(0).cast("long").alias("flat"), F.lit(1).cast("long").alias("stride"))
    return F.aggregate(both, start, lambda a, x: F.struct((a["flat"] + x["c"] * a["stride"]).cast("long").alias("flat"), (a["stride"] * x["n"]).cast("long").alias("stride")), lambda a: a["flat"])


def entries(data: bytes, root: int, flat: int) -> Iterator[tuple[int, int, int, int]]:
    """Entries of a record's chain of pages; a chain that comes back to a page is an error."""
    head = _numbers(data, root + 4 * flat, 1, "record")[0]
    if not head:
        return
    page, seen = _numbers(data, head, 2, "list head")[1], set()
    while page:
        if page in seen or len(seen) >= MAX_PAGES:
            raise ValueError(f"the chain of pages comes back to {page}")
        seen.add(page)
        count, after = _numbers(data, page, 2, "page")
        if count > MAX_PAGE_ENTRIES:
            raise ValueError(f"a page of {count} entries")
        flat_numbers = _numbers(data, page + 8, 4 * count, "entries")
        yield from (flat_numbers[i : i + 4] for i in range(0, 4 * count, 4))
        page = after


def index_rows(data: bytes, slide_id: str, counts: list[int], defaults: list[int], zoom: int, filters: int) -> Iterator[tuple]:
    root = check_header(data, slide_id)
    for z in range(counts[zoom]):
        for f in range(counts[filters]):
            at = list(defaults)
            at[zoom], at[filters] = z, f
            for e in entries(data, root, flat_index(at, counts)):
                yield (z, f, *e)


@dataclass
class _Part(InputPartition):
    level: int
    filter: int


class SlideIndexReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.slide_id = options["path"], options["slideId"]
        self.counts, self.defaults = json.loads(options["counts"]), json.loads(options["defaults"])
        self.zoom, self.filters = int(options["zoomDimension"]), int(options["filterDimension"])

    def partitions(self):
        return [_Part(z, f) for z in range(self.counts[self.zoom]) for f in range(self.counts[self.filters])]

    def read(self, partition):
        with open(self.path, "rb") as f:  # a path that every executor sees
            data = f.read()
        at = list(self.defaults)
        at[self.zoom], at[self.filters] = partition.level, partition.filter
        for e in entries(data, check_header(data, self.slide_id), flat_index(at, self.counts)):
            yield (partition.level, partition.filter, *e)


class SlideIndexSource(DataSource):
    """spark.dataSource.register(SlideIndexSource); spark.read.format("slide_index").options(...).load(path)"""

    @classmethod
    def name(cls):
        return "slide_index"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return SlideIndexReader(self.options)


def scan_index_files(files: DataFrame, slide_id: str, counts: list[int], defaults: list[int], zoom: int, filters: int) -> DataFrame:
    """The same rows from (path, content), as spark.read.format("binaryFile") gives them from any store."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content in b["content"]:
                rows = list(index_rows(bytes(content), slide_id, counts, defaults, zoom, filters))
                yield pd.DataFrame(rows, columns=["level", "filter", "image_index", "offset", "length", "file_number"])

    return files.select("content").mapInPandas(run, SCHEMA)


#: Bytes of a data file that one task reads at most, beside the entries that begin in them.
RANGE = 64 << 20


def payloads(index: DataFrame, files: DataFrame) -> DataFrame:
    """index rows and their payload; files: (file_number, uri). An entry that leaves its file is an error.

    Entries are grouped by file and by range of its bytes; a task opens a file once and reads the
    entries' bytes alone, in their order, whatever the file's size.
    """
    schema = index.schema

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        uri, source = None, None
        for b in batches:
            out = []
            for at, length, name in zip(b["offset"].tolist(), b["length"].tolist(), b["uri"], strict=True):
                if name != uri:
                    store, path = fs.FileSystem.from_uri(name)
                    uri, source = name, store.open_input_file(path)
                if at < 0 or length < 0 or at + length > source.size():
                    raise ValueError(f"an entry of {length} bytes at {at} lies outside its data file {name}")
                out.append(source.read_at(length, at))
            yield b[[f.name for f in schema]].assign(payload=out)

    spark = index.sparkSession
    rows = index.join(F.broadcast(files.select("file_number", "uri")), "file_number")  # a slide has some dozen data files
    dealt = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file_number", F.floor(F.col("offset") / RANGE)).sortWithinPartitions("uri", "offset")
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return dealt.select(*index.columns, "uri").mapInPandas(read, f"{kind}, payload binary")


def stitch_positions(payload: bytes, compressed: bool, concat: int) -> list[tuple[int, int, int]]:
    """(camera, x, y) from records of 9 bytes: a flag, x and y; both are in units of 2^concat pixels."""
    data = zlib.decompress(payload) if compressed else payload
    if len(data) % 9:
        raise ValueError("positions are not whole records")
    out = []
    for k, (flag, x, y) in enumerate(struct.iter_unpack("<Bii", data)):
        if flag & ~1:
            raise ValueError(f"unknown flag {flag} in position {k}")
        out.append((k, x << concat, y << concat))
    return out


def positions(records: DataFrame) -> DataFrame:
    """(file, camera, x, y), a row for each record of (file, payload, compressed, concat)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):
                rows = stitch_positions(bytes(r.payload), bool(r.compressed), int(r.concat))
                yield pd.DataFrame([(r.file, *x) for x in rows], columns=["file", "camera", "x", "y"])

    return records.select("file", "payload", "compressed", "concat").mapInPandas(run, "file string, camera int, x long, y long")


def read_index(spark: SparkSession, path: str, slide_id: str, counts: list[int], defaults: list[int], zoom: int, filters: int) -> DataFrame:
    """Index files under a path, in any store that Spark reads."""
    return scan_index_files(spark.read.format("binaryFile").load(path), slide_id, counts, defaults, zoom, filters)
