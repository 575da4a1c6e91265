"""The corpus pipeline: documents in, packed training sequences out.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written and
read again as the next one's docs.  All but the last return the columns of ``documents``.

Defined results for odd rows are those of the operators: null and empty texts are scored, packed (their end token
alone) and never contaminated; texts without words are near copies of each other; null ids take part everywhere;
repeated rows are copies; columns beside the text are kept, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import decontaminate, lines, nearcopies, packing, quality
from tickloom.llm.queries import table, vocabulary
from tickloom.llm.shared import written

#: No SQL: a learned classifier, fingerprints and byte-pair ids decide; tests compare with brute force.
ORACLE_SQL = None


def _counted(docs: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like``, n_chars set to the text as it is now."""
    size = F.length("text").cast(like.schema["n_chars"].dataType) if "n_chars" in like.columns else None
    return docs.select(*[size.alias(c) if c == "n_chars" else F.col(c) for c in like.columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from this stage's own input, does not reject.

    Null and empty texts are scored like any other; repeated rows are each kept or rejected alike.
    """
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that repeat earlier ones; documents of which no line is left go.

    Texts without any line of words, null and empty ones among them, lose none and stay; of repeated rows one stays.
    """
    found = lines.dedup_lines(docs)
    left = found.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    return _counted(left, docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies (five-word shingles, similarity 0.8 or more) the row with the smallest id.

    Rows without an id come last; rows of one id whose texts are no near copies all stay; null and empty texts and
    those without words are one component.
    """
    return nearcopies.drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item; null and empty texts contain none."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens; a null or empty text is its end token alone."""
    return packing.pack(docs, vocabulary(), 1024)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
