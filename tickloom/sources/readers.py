"""Readers of the raw feed: root/{SYMBOL}/{group}/**/*.json, the universe, and partitioned tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as X
from ..operators.intake import only_symbols
from ..operators.normalize import DAILY_FIELDS
from ..params import KEYS
from .json_text import lenient_json, stretches

_LEVELS = "array<struct<price: string, volume: string>>"
_HEAD = "ts string, command string, symbol string, event_time string"
#: Raw schemas; numbers are read as text and cast later, so that a bad one is null and not a lost record.
SCHEMAS = {
    "historical_price": "date string, trading_date string, symbol string, " + ", ".join(f"{c} string" for c in DAILY_FIELDS),
    "updatelastprices": f"{_HEAD}, last_price string, last_volume string, deal_volume string, deal_value string, active_buy_volume string, active_sell_volume string, total_buy_sale_volume string",
    "updateorderbooks": f"{_HEAD}, total_bid_volume string, total_ask_volume string, bid_levels {_LEVELS}, ask_levels {_LEVELS}",
    "updatetrades": f"{_HEAD}, trade_id string, price string, volume string, side string, trading_date string",
    "updaterefprices": f"{_HEAD}, reference_price string, ceiling_price string, floor_price string, open_price string, high_price string, low_price string, market_status string, trading_date string",
    "updateforeignerstats": f"{_HEAD}, currentForeignRoom string, buy_volume string, sell_volume string, buy_value string, sell_value string",
}


def _glob(name: str) -> str:
    """A path pattern for a name in whatever case."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() and c.isascii() else c if c.isalnum() or c in "_-." else f"\\{c}" for c in name)


def feed_paths(root: str, group: str, symbols: str | None = None) -> list[str]:
    """Patterns of the folders of a group, for all symbols or the comma-separated ones: other folders are not listed."""
    wanted = sorted({s.strip().upper() for s in (symbols or "").split(",") if s.strip()})
    return [f"{root.rstrip('/')}/{_glob(s) if s else '*'}/{_glob(group)}" for s in wanted or [""]]


def _existing(reader: Callable[[list[str]], DataFrame], paths: list[str]) -> DataFrame | None:
    """What one reader finds at all patterns together; where some match no folder, at those that do; None if none does."""
    try:
        return reader(paths)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    if len(paths) == 1:
        return None
    # a symbol without a folder: its half is searched apart
    half = len(paths) // 2
    parts = [p for p in (_existing(reader, paths[:half]), _existing(reader, paths[half:])) if p is not None]
    return None if not parts else parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _located(df: DataFrame, group: str, symbols: str | None) -> DataFrame:
    """Adds path, mtime, place (block, row), symbol (from the folder) and file_date (from the file's name)."""
    path = F.col("_metadata.file_path")
    out = df.withColumns(
        {
            "path": path,
            "mtime": F.col("_metadata.file_modification_time"),
            # a record's place in its file: rows of a split come in order, and so do the splits
            "block": F.col("_metadata.file_block_start"),
            "row": F.monotonically_increasing_id(),
            "__dir": X.clean_symbol(F.regexp_extract(path, rf"/([^/]+)/(?i:{group})/", 1)),
            "file_date": F.regexp_extract(path, r"(\d{4}-\d{2}-\d{2})[^/]*$", 1),
        }
    )
    return only_symbols(out.drop("symbol").withColumnRenamed("__dir", "symbol"), symbols)


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    rest = schema.replace("symbol string, ", "", 1)
    return spark.createDataFrame([], f"{rest}, path string, mtime timestamp, block long, row long, symbol string, file_date string")


def read_lines(spark: SparkSession, root: str, group: str, symbols: str | None = None, broken: bool = True) -> DataFrame:
    """One object a line: split, scalable, blank lines skipped.

    Broken lines are kept as the text broken_record, for quarantine (see split_broken), or without ``broken`` left out.
    """
    schema, found = SCHEMAS[group], feed_paths(root, group, symbols)
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    if not broken:
        lines = _existing(lambda some: _located(reader.schema(schema).option("mode", "DROPMALFORMED").json(some), group, symbols), found)
        return _empty(spark, schema) if lines is None else lines
    schema += ", broken_record string"
    texts = _existing(lambda some: _located(reader.text(some), group, symbols), found)
    if texts is None:
        return _empty(spark, schema)
    names = [n.strip().split(" ")[0].rstrip(":") for n in SCHEMAS[group].replace(_LEVELS, "x").split(",")]
    record = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken_record"})
    place = [c for c in texts.columns if c != "value"]
    return texts.filter("trim(value) <> ''").withColumn("__r", record).select(*[F.col("__r")[n].alias(n) for n in (*names, "broken_record") if n != "symbol"], *place)


def split_broken(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good records, path and text of the broken ones) of what was read with ``broken``."""
    return records.filter("broken_record is null").drop("broken_record"), records.filter("broken_record is not null").select("path", "symbol", "broken_record")


def read_lenient(spark: SparkSession, root: str, group: str, symbols: str | None = None, broken: bool = True, whole: bool = True) -> DataFrame:
    """Files of any JSON shape, each read as one text, or without ``whole`` in as many splits as Spark makes of it.

    Broken stretches are kept as broken_record, for quarantine (see split_broken), or without ``broken`` left out.  A
    record's place is pos among its file's objects; in split files (block, row, pos), of the line that it begins in.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    found = _existing(lambda some: _located(reader.text(some, wholetext=whole), group, symbols), feed_paths(root, group, symbols))
    if found is None:
        return _empty(spark, "pos int, " + ("broken_record string, " if broken else "") + SCHEMAS[group])
    return lenient_json(found if whole else stretches(found), "value", SCHEMAS[group].replace("symbol string, ", "", 1), broken)


def read_objects(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """One JSON object a file, strictly: a file that is anything else fails the read.  Adds path."""
    text = spark.read.text(paths, wholetext=True).select(F.regexp_replace("value", "^\ufeff", "").alias("value"), F.col("_metadata.file_path").alias("path"))
    sound = F.regexp_like(F.trim(F.regexp_replace("value", r"\s+", " ")), F.lit(r"^\{.*\}$"))
    record = F.when(sound, F.from_json("value", schema, {"mode": "FAILFAST"})).otherwise(F.raise_error(F.concat(F.lit("expected a JSON object in "), F.col("path"))))
    return text.select(record.alias("r"), "path").select("r.*", "path")


def read_days(spark: SparkSession, path: str) -> DataFrame:
    """A table partitioned by symbol and day, the symbol as text whatever it looks like."""
    fields = [f for f in spark.read.parquet(path).schema if f.name not in KEYS]
    schema = T.StructType([*fields, T.StructField("symbol", T.StringType()), T.StructField("trading_date", T.DateType())])
    return spark.read.schema(schema).parquet(path)


def read_universe(spark: SparkSession, path: str) -> DataFrame:
    """share_code and ipo_date from JSON objects, in an array or not, or from lines ``code,date`` (# starts a comment)."""
    text = spark.read.text(path, wholetext=True).withColumn("is_json", F.ltrim(F.regexp_replace("value", "^\ufeff", "")).rlike(r"^[\[{]"))
    objects = lenient_json(text.filter("is_json").select("value"), "value", "share_code string, ipo_date string").select("share_code", "ipo_date")
    lines = text.filter("not is_json").select(F.explode(F.split("value", r"\r?\n")).alias("line")).select(F.split(F.trim("line"), r"\s*,\s*").alias("x"))
    lines = lines.filter((F.size("x") >= 2) & ~F.col("x")[0].startswith("#")).select(F.col("x")[0].alias("share_code"), F.col("x")[1].alias("ipo_date"))
    return objects.unionByName(lines).select(X.clean_symbol(F.col("share_code")).alias("share_code"), X.date_text(F.col("ipo_date")).alias("ipo_date")).filter("share_code <> 'UNKNOWN'")


def fetch_months(universe: DataFrame, until: str) -> DataFrame:
    """The month ranges (share_code, first, last) that a history fetch asks for, from the month of listing to ``until``."""
    end = F.lit(until).cast("date")
    months = F.sequence(F.trunc("ipo_date", "month"), F.trunc(end, "month"), F.expr("INTERVAL 1 MONTH"))
    rows = universe.filter(F.col("ipo_date") <= end).select("share_code", "ipo_date", F.explode(months).alias("m"))
    return rows.select("share_code", F.greatest("m", "ipo_date").alias("first"), F.least(F.last_day("m"), end).alias("last"))
