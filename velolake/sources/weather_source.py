"""S5 as a data source: landed weather days, range and fields taken by the
source itself.

The weather service is asked for a range of days and a list of fields.  What
it answered lies in one folder a day (``day=2024-01-20``), as JSON lines that
hold struct-of-arrays responses.  :class:`LandedWeather` reads such a folder
through Spark's data source API and takes the same request as options:
``from`` and ``to`` (days, both in), so folders outside of them are never
opened, and ``fields``, so no other array is turned into rows.  A day is a
partition.

The range is an option and not a filter pushed down by Spark: Spark 4.1 keeps
what a Python reader was told for the first plan of a DataFrame and uses it
for later plans as well, so a second, wider filter on the same DataFrame would
miss rows.  Filters on the DataFrame work; they are tested after the read.

Arrays of one response may differ in length: shorter ones are null at the end,
as in :func:`weather.explode_hourly`.  Hours whose time does not parse are
kept with a null time.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import DateType, DoubleType, StructField, StructType, TimestampNTZType

from velolake import schemas as S
from velolake.sources import weather as WX

FORMAT = "landed_weather"
ROWS = 8192  # of a batch
_DAY = re.compile(r"day=(\d{4}-\d{2}-\d{2})$")


def land_weather(weather: DataFrame, path: str) -> str:
    """Hourly weather as landed responses, one folder a day."""
    WX.to_daily_responses(weather).write.mode("append").partitionBy("day").json(path)
    return path


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and the path in it."""
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path.removeprefix("file:")


class Day(InputPartition):
    def __init__(self, day: dt.date, files: list[str]):
        super().__init__(None)
        self.day, self.files = day, files


class LandedWeather(DataSource):
    """``spark.read.format("landed_weather").options(fields="a,b",
**{"from": "2024-01-07", "to": "2024-01-20"}).load(path)``: ``day``, ``time``
and the fields (all by default) of the days (all by default)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def fields(self) -> list[str]:
        known = S.WEATHER_SOURCE_FIELDS[1:]
        asked = [f.strip() for f in self.options.get("fields", "").split(",") if f.strip()] or list(known)
        unknown = [f for f in asked if f not in known]
        if unknown:
            raise ValueError(f"Unknown weather fields: {unknown}")
        return asked

    def schema(self) -> StructType:
        return StructType(
            [StructField("day", DateType()), StructField("time", TimestampNTZType())] + [StructField(f, DoubleType()) for f in self.fields()]
        )

    def reader(self, schema: StructType) -> DataSourceReader:
        first, last = (self.options.get(k) for k in ("from", "to"))
        days = dt.date.fromisoformat(first) if first else dt.date.min, dt.date.fromisoformat(last) if last else dt.date.max
        return WeatherReader(self.options["path"], self.fields(), *days)


class WeatherReader(DataSourceReader):
    def __init__(self, path: str, fields: Sequence[str], first: dt.date, last: dt.date):
        self.path, self.fields, self.first, self.last = path.rstrip("/"), list(fields), first, last

    def partitions(self) -> Sequence[InputPartition]:
        """One a day within the range; only names are listed."""
        fs, root = opened(self.path)
        days = []
        for folder in fs.get_file_info(pafs.FileSelector(root)):
            found = _DAY.search(folder.path)
            if found and folder.type == pafs.FileType.Directory:
                day = dt.date.fromisoformat(found.group(1))
                if self.first <= day <= self.last:
                    names = [x.path for x in fs.get_file_info(pafs.FileSelector(folder.path)) if x.type == pafs.FileType.File and x.base_name[:1] not in "._"]
                    days.append(Day(day, sorted(names)))
        return sorted(days, key=lambda p: p.day) or [Day(dt.date.min, [])]

    def read(self, partition: Day) -> Iterator[pa.RecordBatch]:
        fs, _ = opened(self.path)
        names = ["day", "time", *self.fields]
        kinds = [pa.date32(), pa.timestamp("us")] + [pa.float64()] * len(self.fields)
        for name in partition.files:
            with fs.open_input_stream(name) as source:
                for line in source.read().decode("utf-8").splitlines():  # a day
                    hourly = (json.loads(line).get("hourly") or {}) if line.strip() else {}
                    times = [_time(x) for x in hourly.get("time") or []]
                    taken = [hourly.get(f) or [] for f in self.fields]
                    n = max([len(times), *map(len, taken)])
                    padded = [[partition.day] * n, times + [None] * (n - len(times)), *(list(x) + [None] * (n - len(x)) for x in taken)]
                    for at in range(0, n, ROWS):
                        yield pa.RecordBatch.from_arrays([pa.array(c[at : at + ROWS], k) for c, k in zip(padded, kinds)], names=names)


def _time(text: str | None) -> dt.datetime | None:
    try:
        return dt.datetime.fromisoformat(text).replace(tzinfo=None)
    except (TypeError, ValueError):
        return None


def read_landed_weather(spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None, fields: Sequence[str] = ()) -> DataFrame:
    """The source over ``path``, from day ``first`` to day ``last``."""
    spark.dataSource.register(LandedWeather)
    asked = {"fields": ",".join(fields), "from": first.isoformat() if first else "", "to": last.isoformat() if last else ""}
    return spark.read.format(FORMAT).options(**asked).load(path)
