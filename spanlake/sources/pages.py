"""A Spark data source over pages of JSON records: `spark.read.format("spanlake_pages")`, which reads the days and rows that a filter asks for.

A folder has a folder a day (day=2024-01-31) of text files, a page a line. A page is a list of records or an object with such a
list; records have any generation's spellings.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from datetime import UTC, date, datetime, timedelta

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from spanlake.operators.batches import numbered
from spanlake.sources.readers import FIELD_GROUPS, LISTS, OBSERVATION
from spanlake.sources.sink import place

FORMAT, TIME = "spanlake_pages", "start_time"
#: Rows that a reader hands over at once, and records of a page that is written.
READ_ROWS, PAGE_ROWS = 10_000, 50
STEP = timedelta(microseconds=1)
#: Columns that a page's records are read into; what else there is stays in the pages.
_READ = {c: kind if kind in ("string", "timestamp") else "string" for c, (kind, _) in OBSERVATION.items()}


def _moment(value: object) -> datetime | None:
    if not isinstance(value, str):
        return None
    try:
        at = datetime.fromisoformat(value)
    except ValueError:
        return None
    return at if at.tzinfo else at.replace(tzinfo=UTC)


def _cell(record: dict, column: str) -> object:
    """A column of a record: the first of its spellings that isn't null; objects and lists as JSON."""
    for spelling in OBSERVATION[column][1]:
        if (value := record.get(spelling)) is not None:
            if _READ[column] == "timestamp":
                return _moment(value)
            return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    return None


class PageFile(InputPartition):
    """A file of pages."""

    def __init__(self, file: str):
        super().__init__(file)
        self.file = file


class PageReader(DataSourceReader):
    """Reads pages, a partition a file, of the days that the time window touches."""

    def __init__(self, path: str, schema: StructType):
        self.path, self.schema, self.low, self.high, self.equal = path.rstrip("/"), to_arrow_schema(schema, prefers_large_types=False), None, None, {}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802  the name is given
        """Takes bounds of the start time, which prune days and rows, and equal texts. Times are whole microseconds, so a bound that is not included is the next one."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            value = getattr(f, "value", None)
            if column == TIME and isinstance(value, datetime) and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                value = value if value.tzinfo else value.replace(tzinfo=UTC)
                if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    low = value + STEP if isinstance(f, GreaterThan) else value
                    self.low = low if self.low is None else max(self.low, low)
                if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                    high = value - STEP if isinstance(f, LessThan) else value
                    self.high = high if self.high is None else min(self.high, high)
            elif isinstance(f, EqualTo) and isinstance(value, str) and _READ.get(column) == "string":
                self.equal[column] = value
            else:
                yield f

    def _wanted(self, day: date) -> bool:
        start = datetime(day.year, day.month, day.day, tzinfo=UTC)
        return (self.low is None or start + timedelta(days=1) > self.low) and (self.high is None or start <= self.high)

    def partitions(self) -> list[PageFile]:
        fs, base = place(self.path)
        out = []
        for folder in sorted(x.path for x in fs.get_file_info(pafs.FileSelector(base)) if x.base_name.startswith("day=")):
            if self._wanted(date.fromisoformat(folder.rpartition("=")[2])):
                out += [PageFile(x.path) for x in fs.get_file_info(pafs.FileSelector(folder)) if not x.base_name.startswith(("_", "."))]
        return out

    def read(self, partition: PageFile | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no day is wanted
            return
        fs, _ = place(self.path)
        held: list[dict] = []
        with fs.open_input_stream(partition.file) as source:
            for line in _lines(source):
                for record in _records(line):
                    row = {c: _cell(record, c) for c in self.schema.names}
                    at = row[TIME] if TIME in row else _cell(record, TIME)
                    if (self.low is not None or self.high is not None) and (at is None or self.low is not None and at < self.low or self.high is not None and at > self.high):
                        continue
                    if any((row[c] if c in row else _cell(record, c)) != v for c, v in self.equal.items()):
                        continue
                    held.append(row)
                if len(held) >= READ_ROWS:
                    yield pa.RecordBatch.from_pylist(held, self.schema)
                    held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, self.schema)


def _lines(source: pa.NativeFile, size: int = 1 << 20) -> Iterator[str]:
    rest = b""
    while block := source.read(size):
        *whole, rest = (rest + block).split(b"\n")
        for line in whole:
            yield line.decode()
    if rest:
        yield rest.decode()


def _records(line: str) -> list[dict]:
    """The records of a page: of a bare list or of the list it has under a known name; what is no object is dropped, as is a line that is no JSON."""
    try:
        page = json.loads(line)
    except ValueError:
        return []
    if isinstance(page, dict):
        page = next((page[k] for k in LISTS if isinstance(page.get(k), list)), [])
    return [x for x in page if isinstance(x, dict)] if isinstance(page, list) else []


class Pages(DataSource):
    """Options: path, and fields, groups of columns or columns, separated by commas (id and start_time always); all without it."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        asked = [x.strip() for x in self.options.get("fields", "").split(",") if x.strip()]
        if unknown := [x for x in asked if x not in FIELD_GROUPS and x not in _READ]:
            raise ValueError(f"no fields {', '.join(unknown)}; there are {', '.join([*FIELD_GROUPS, *_READ])}")
        wanted = {c for x in asked for c in FIELD_GROUPS.get(x, (x,))} | ({"id", TIME} if asked else set(_READ))
        return StructType([StructField(c, TimestampType() if _READ[c] == "timestamp" else StringType()) for c in _READ if c in wanted])

    def reader(self, schema: StructType) -> PageReader:
        return PageReader(self.options["path"], schema)


def register(spark: SparkSession) -> None:
    """Adds the source, and lets Spark hand filters to sources of this kind."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Pages)


def write_pages(records: DataFrame, path: str, order: str = "id", rows: int = PAGE_ROWS) -> None:
    """Writes observations as such pages: canonical columns, start_time among them, in pages of so many rows of a day."""
    at = F.concat(F.date_format(TIME, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    told = records.where(F.col(TIME).isNotNull()).select(F.to_date(TIME).alias("day"), F.col(order).alias("_order"), F.to_json(F.struct(*[at.alias("startTime") if c == TIME else F.col(c) for c in records.columns if c in OBSERVATION])).alias("record"))
    paged = numbered(told, "day", "_order").groupBy("day", F.floor(F.col("n") / rows).alias("page"))
    body = F.concat(F.lit('{"data":['), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "record"))), lambda x: x["record"]), ","), F.lit("]}"))
    paged.agg(body.alias("value")).select("day", "value").write.mode("overwrite").partitionBy("day").text(path)
