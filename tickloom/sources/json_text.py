"""JSON files of any shape: one object, an array, one object a line, or objects printed one after another."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.window import Window

from ..staging import written


#: Where a broken text is taken up again: a line that begins with an object or an array.
_NEXT = re.compile(r"\n(?=[\[{])")


@udtf(returnType="pos int, record string, broken string")
class SplitObjects:
    """One row for each JSON object of a text: its place among the text's objects and itself.

    A byte-order mark is skipped, arrays are opened, what is no object is left out.  Broken text is a row of its own, up
    to the next line that begins with an object or an array, where reading goes on.
    """

    def eval(self, text: str):
        decoder, at, place, text = json.JSONDecoder(), 0, 0, (text or "").lstrip("\ufeff")
        while at < len(text):
            if text[at] in " \t\r\n,":
                at += 1
                continue
            try:
                value, at = decoder.raw_decode(text, at)
            except ValueError:
                again = _NEXT.search(text, at)
                end = again.end() if again else len(text)
                yield None, None, text[at:end].rstrip()
                at = end
                continue
            for item in value if isinstance(value, list) else [value]:
                if isinstance(item, dict):
                    yield place, json.dumps(item), None
                    place += 1


def lenient_json(texts: DataFrame, text: str, schema: T.StructType | str, broken: bool = False) -> DataFrame:
    """The columns of ``texts`` but the text, with pos and the fields of each of its records.

    With ``broken`` what is no JSON comes as rows with its text as broken_record, for quarantine; else it is left out.
    """
    rest = [c for c in texts.columns if c != text]
    split = texts.lateralJoin(SplitObjects(F.col(text).outer()))
    if not broken:
        split = split.filter("broken is null")
    kept = [*rest, "pos", *(["broken_record"] if broken else [])]
    found = split.withColumnRenamed("broken", "broken_record").withColumn("__r", F.from_json("record", schema))
    return found.select(*kept, "__r.*")


def _running(lines: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` up to each line: a window inside each split, and the totals of the splits before it."""
    sums = lines.groupBy(*keys, "block").agg(F.sum(value).alias("__sum"))
    earlier = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(*keys, "block", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__carried"))
    here = Window.partitionBy(*keys, "block").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    return lines.join(carried, [*keys, "block"]).withColumn(name, F.sum(value).over(here) + F.col("__carried")).drop("__carried")


def stretches(lines: DataFrame, text: str = "value") -> DataFrame:
    """Whole records as texts, from lines of files of any JSON shape, wherever Spark splits the files.

    ``lines`` has path, block (its split's start) and row (rising inside a split).  A stretch begins at a line where no
    object is open and ends before the next such line; brackets and commas of the list around it are taken off.  Only
    braces outside strings count: JSON has no line break inside a string, so each line tells them by itself, and the
    open objects before it are a sum over lines and splits.  Where a file's braces don't match, every line that begins
    with an object or a list begins anew, so that what is broken ends there.  Comes with the place of its first line.
    """
    rest = [c for c in lines.columns if c not in (text, "path", "block", "row")]
    first = F.when(F.col("block") == 0, F.regexp_replace(text, "^\ufeff", "")).otherwise(F.col(text))
    outside = F.regexp_replace(F.regexp_replace(text, r"\\.", ""), r'"[^"]*("|$)', "")
    count = lambda sign: F.length("__outside") - F.length(F.replace("__outside", F.lit(sign)))
    marked = lines.withColumn(text, first).filter(F.trim(text) != "").withColumn("__outside", outside)
    marked = marked.withColumns({"__braces": count("{") - count("}"), "__lists": count("[") - count("]"), "__head": F.col(text).rlike(r"^[\[{]").cast("int")})
    # read once: the sums below take its narrow columns only
    marked = written(marked.drop("__outside"), "json-lines")
    uneven = marked.groupBy("path").agg((F.sum("__braces") != 0).cast("int").alias("__uneven"))
    parts = _running(marked.join(uneven, "path").withColumn("__head", F.col("__head") * F.col("__uneven")), ["path"], "__head", "__part")
    depth = _running(parts, ["path", "__part"], "__braces", "__depth")
    starts = depth.withColumn("__start", (F.col("__depth") - F.col("__braces") <= 0).cast("int"))
    numbered = _running(starts, ["path"], "__start", "__stretch")
    place = F.struct("block", "row", text)
    found = numbered.groupBy("path", "__stretch").agg(
        F.array_sort(F.collect_list(place)).alias("__lines"), F.sum("__lists").alias("__open"), *[F.first(c).alias(c) for c in rest]
    )
    joined = F.array_join(F.transform("__lines", lambda x: x[text]), "\n")
    bare = F.when(F.col("__open") > 0, F.regexp_replace("__text", r"^[\s,]*\[", "")).when(F.col("__open") < 0, F.regexp_replace("__text", r"\][\s,]*$", "")).otherwise(F.col("__text"))
    out = found.withColumn("__text", joined).withColumn(text, bare).filter(F.trim(F.translate(text, ",\t\n", "   ")) != "")
    return out.select(*rest, "path", F.col("__lines")[0]["block"].alias("block"), F.col("__lines")[0]["row"].alias("row"), text)
