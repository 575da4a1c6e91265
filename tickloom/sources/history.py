"""Daily history as a source with one partition for each symbol and month.

A fetch asks for one symbol and a range of days.  ``History`` asks that of stored files,
root/SYMBOL/historical_price/year/date.json with one record each; a subclass asks another store by its own ``fetch``.
Symbols and days are chosen by the universe and the bounds that ``read_history`` takes, not by pushed filters: Spark keeps
what one query pushed to a Python source with the relation, and another query of the same DataFrame would lose rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset
from pyarrow import fs
from pyspark.sql import Column, DataFrame, datasource as S
from pyspark.sql import functions as F

from ..staging import shared_path
from .readers import SCHEMAS

GROUP = "historical_price"
#: Records of one Arrow batch.
BATCH = 1000


@dataclass
class Months(S.InputPartition):
    """What one partition asks for: a symbol and its first and last day."""

    symbol: str
    first: dt.date
    last: dt.date


class History(S.DataSource):
    """Stored history files.  Options: root, universe (a Parquet table of share_code and ipo_date), since, until, span (months)."""

    @classmethod
    def name(cls) -> str:
        return "history"

    def schema(self) -> str:
        return "symbol string, trading_date date, asked_first date, asked_last date, path string, value string"

    def reader(self, schema) -> S.DataSourceReader:
        return HistoryReader(self)

    def fetch(self, symbol: str, first: dt.date, last: dt.date) -> Iterator[tuple[dt.date, str, str]]:
        """(day, place, text) of the records of a range; days without a file have none."""
        store, base = fs.FileSystem.from_uri(self.options["root"])
        for year in range(first.year, last.year + 1):
            folder = fs.FileSelector(f"{base}/{symbol}/{GROUP}/{year}", allow_not_found=True)
            for info in sorted(store.get_file_info(folder), key=lambda i: i.path):
                day = _day(info.base_name.removesuffix(".json"))
                if info.type == fs.FileType.File and day and first <= day <= last:
                    with store.open_input_stream(info.path) as file:
                        yield day, info.path, file.read().decode("utf-8-sig", "replace")


def _day(text: str) -> dt.date | None:
    try:
        return dt.date.fromisoformat(text)
    except ValueError:
        return None


class HistoryReader(S.DataSourceReader):
    def __init__(self, source: History):
        self.source = source

    def partitions(self) -> list[Months]:
        """The ranges of the universe's symbols, each of ``span`` calendar months, cut to the days that are asked for."""
        options = self.source.options
        span, last = int(options.get("span", 1)), dt.date.fromisoformat(options["until"])
        store, base = fs.FileSystem.from_uri(options["universe"])
        out = []
        for batch in pa.dataset.dataset(base, filesystem=store, format="parquet").to_batches(columns=["share_code", "ipo_date"]):
            for symbol, listed in zip(*(c.to_pylist() for c in batch.columns)):
                begin = max(listed, dt.date.fromisoformat(options.get("since", "0001-01-01")))
                while begin <= last:
                    month = begin.year * 12 + begin.month - 1
                    after = month - month % span + span  # spans begin at multiples of their length
                    end = dt.date(after // 12, after % 12 + 1, 1)
                    out.append(Months(symbol, begin, min(end - dt.timedelta(days=1), last)))
                    begin = end
        return out

    def read(self, part: Months | None) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        names = ["symbol", "trading_date", "asked_first", "asked_last", "path", "value"]
        kinds = [pa.string(), pa.date32(), pa.date32(), pa.date32(), pa.string(), pa.string()]

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for day, place, text in self.source.fetch(part.symbol, part.first, part.last) if part else ():
            rows.append((part.symbol, day, part.first, part.last, place, text))
            if len(rows) == BATCH:
                yield batch()
                rows = []
        if rows:
            yield batch()


def read_history(universe: DataFrame, root: str, until: str, since: str = "0001-01-01", span: int = 1, source: type[History] = History) -> DataFrame:
    """The daily records of the universe's symbols from their listing or ``since`` to ``until``, broken ones as broken_record.

    One partition for each symbol and month, or ``span`` months (1, 2, 3, 4, 6, 12 or a multiple of 12), so that a long
    universe has as many tasks as one wants.  Only these are listed and opened.  A symbol listed
    twice counts from its earliest day; one without a day, or listed after ``until``, has no records.  asked_first and
    asked_last are the days that the record's partition asked for.
    """
    if span < 1 or (12 % span and span % 12):
        raise ValueError("span must divide a year or be whole years")
    spark = universe.sparkSession
    listed = shared_path(spark, "universe")
    rows = universe.groupBy("share_code").agg(F.min(F.col("ipo_date").cast("date")).alias("ipo_date"))
    rows.filter("share_code is not null and ipo_date is not null").write.parquet(listed)
    spark.dataSource.register(source)
    found = spark.read.format(source.name()).options(root=root, universe=listed, since=since, until=until, span=str(span)).load()
    schema = SCHEMAS[GROUP] + ", broken_record string"
    record = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken_record"})
    keys = ["symbol", "trading_date", "asked_first", "asked_last", "path"]
    fields: list[Column] = [F.col("__r")[n].alias(n) for n in _names(schema) if n not in keys]
    return found.withColumn("__r", record).select(*keys, *fields)


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]
