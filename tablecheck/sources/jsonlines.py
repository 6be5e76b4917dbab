"""A source of its own: JSON lines, read in byte ranges, filtered while they are read.

Stands for any source Spark has no reader for (a search index, a service): it says how the
data falls into partitions, takes the filters it can answer and hands over Arrow batches.
``register(spark)``, then ``read_source(spark, "json_lines", path=..., schema=...)``.
"""

from __future__ import annotations

import operator
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.json as pajson
from pyspark.sql import SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

NAME = "json_lines"
#: Bytes of a partition, and bytes read and parsed at a time.
PARTITION_BYTES = 64 * 2**20
BLOCK_BYTES = 4 * 2**20

_COMPARE = {
    ds.EqualTo: operator.eq,
    ds.GreaterThan: operator.gt,
    ds.GreaterThanOrEqual: operator.ge,
    ds.LessThan: operator.lt,
    ds.LessThanOrEqual: operator.le,
}


def register(spark: SparkSession) -> None:
    """Make the source known to a session, and let Spark offer it filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(JsonLinesSource)


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI; ``s3a`` is another name of ``s3``."""
    if path.startswith("s3a:"):
        path = "s3" + path[3:]
    if path.startswith("file:") and not path.startswith("file://"):
        path = path.removeprefix("file:")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


@dataclass
class Part(ds.InputPartition):
    """The lines that begin at ``start`` or later and before ``end``."""

    path: str
    start: int
    end: int


class JsonLinesSource(ds.DataSource):
    """Options: ``path`` (a file or a folder of files), ``partitionBytes``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def reader(self, schema: StructType) -> ds.DataSourceReader:
        return JsonLinesReader(schema, dict(self.options))


def condition(filter: ds.Filter) -> pc.Expression | None:
    """A filter of one top-level column as an Arrow expression; None if it is another one."""
    if isinstance(filter, ds.Not):
        inner = condition(filter.child)
        if inner is None or not isinstance(filter.child, ds.In):
            return None if inner is None else ~inner
        # NULL is in no list and out of none
        return ~inner & pc.field(filter.child.attribute[0]).is_valid()
    column = getattr(filter, "attribute", ())
    if len(column) != 1:
        return None
    field = pc.field(column[0])
    if isinstance(filter, ds.IsNull):
        return field.is_null()
    if isinstance(filter, ds.IsNotNull):
        return field.is_valid()
    value = getattr(filter, "value", None)
    if isinstance(filter, ds.In):
        return field.isin(list(value)) if None not in value else None
    if isinstance(value, float) or value is None:
        return None  # NaN is the largest number to Spark and none to Arrow
    if isinstance(filter, ds.StringStartsWith):
        return pc.starts_with(field, value)
    compare = _COMPARE.get(type(filter))
    return compare(field, value) if compare else None


class JsonLinesReader(ds.DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        if "path" not in options:
            raise ValueError("the source needs a path")
        self.schema, self.path = schema, options["path"]
        self.size = int(options.get("partitionbytes", PARTITION_BYTES))
        self.filters: list[ds.Filter] = []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        for filter in filters:
            if condition(filter) is None:
                yield filter
            else:
                self.filters.append(filter)

    def partitions(self) -> Sequence[Part]:
        system, path = file_system(self.path)
        info = system.get_file_info(path)
        files = [info] if info.is_file else system.get_file_info(pafs.FileSelector(path))
        parts = []
        for file in sorted(files, key=lambda f: f.path):
            if file.is_file and not file.base_name.startswith(("_", ".")):
                starts = range(0, file.size, self.size)
                parts += [Part(file.path, s, min(s + self.size, file.size)) for s in starts]
        return parts

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(self.path)
        schema = to_arrow_schema(self.schema)
        wanted = [condition(f) for f in self.filters]
        # dates are texts in JSON, and read as such
        parsed = pa.schema([(f.name, pa.string() if pa.types.is_date(f.type) else f.type) for f in schema])
        options = pajson.ParseOptions(explicit_schema=parsed, unexpected_field_behavior="ignore")
        with system.open_input_file(partition.path) as file:
            for block in _blocks(file, partition.start, partition.end):
                table = pajson.read_json(pa.BufferReader(block), parse_options=options)
                table = table.select(schema.names).cast(schema)
                if wanted:
                    table = table.filter(reduce(operator.and_, wanted))
                yield from table.to_batches()


def _blocks(file: pa.NativeFile, start: int, end: int) -> Iterator[bytes]:
    """Whole lines that begin inside the range, some at a time; the last may end beyond it."""
    # a line that begins at ``start`` follows a line feed at ``start - 1``
    place = max(start - 1, 0)
    file.seek(place)
    held = b""
    if start:
        while True:
            piece = file.read(BLOCK_BYTES)
            if not piece:
                return
            cut = piece.find(b"\n")
            if cut >= 0:
                place, held = place + cut + 1, piece[cut + 1 :]
                break
            place += len(piece)
    # ``held`` begins at ``place``, the first byte of a line
    while place < end:
        if place + len(held) < end:
            piece = file.read(BLOCK_BYTES)
            cut = held.rfind(b"\n") + 1
            if not piece:
                cut = len(held)
            if held[:cut].strip():
                yield held[:cut]
            place, held = place + cut, held[cut:] + piece
            if not piece:
                return
            continue
        # the range ends inside ``held``: up to the end of the line that begins last in it
        cut = held.find(b"\n", end - place - 1)
        while cut < 0:
            piece = file.read(BLOCK_BYTES)
            if not piece:
                cut = len(held) - 1
                break
            before, held = len(held), held + piece
            cut = held.find(b"\n", max(before, end - place - 1))
        if held[: cut + 1].strip():
            yield held[: cut + 1]
        return
