"""Binary frames as a stream, through the decoders, to the feed's files: symbol, command, year and day.

One query takes the frames of all commands.  A batch opens its frames once and appends the records of each command as
lines headed by time of arrival, command and symbol; the names of its files hold its number, so a batch that is repeated
after a failure replaces what it wrote.  The feed's readers read the files back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import decode, sinks
from ..staging import written


def append_feed(frames: DataFrame, root: str, checkpoint: str, column: str = "frame", seconds: int | None = 5) -> StreamingQuery:
    """Appends the records of streaming ``frames``; without ``seconds`` it ends when all input is read.

    Records without a symbol go to UNKNOWN; frames without a known command leave nothing.
    """

    def batch(rows: DataFrame, number: int) -> None:
        opened = written(decode.open_frames(rows.select(F.col(column).alias("frame"))), "frames")
        for command in decode.FIELDS:
            found = decode.decode(opened, command)
            sinks.append_lines(found.drop("command"), root, command, number)

    writer = frames.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=f"{seconds} seconds") if seconds else writer.trigger(availableNow=True)).start()
