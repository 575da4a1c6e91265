"""Documents in units that ask about hashed keys, and key buckets that answer.

Operators that compare every word run of every document must not shuffle a row for each run with its place.  Here
documents are dealt once into units, by a hash of their id and text.  A unit's task works on whole texts with numpy, looks at
its own repetitions itself and sends only distinct keys, packed as binary arrays, to the bucket of each key.  A bucket
sees each key at most once from each unit and answers each unit with the part of its keys that matters.  The unit is
then visited again, together with the answers.  A key that a third of all rows share thus costs one entry per unit.

The exchange that deals the texts has one plan in every visit, so one query shuffles the texts once and reuses them.
Units and buckets are as many as shuffle partitions, so their ask rows are as many as the blocks of one shuffle.

Keys are 64-bit where what they find is compared again, and 128-bit (``KEY``) where they decide.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import partitions
from .textbytes import KEY, blocks

ASK = "bucket int, unit int, kind int, n long, keys binary, a binary, b binary, c binary"
ANSWER = "unit int, kind int, keys binary"
NO_ID = np.iinfo(np.int64).max


def bucket_count(docs: DataFrame) -> int:
    """Half as many buckets as shuffle partitions: a unit sends a row to each bucket, so their product must stay low."""
    return max(1, partitions(docs.sparkSession) // 2)


def deal(docs: DataFrame, key: str, text: str, keep: list[str] | None = None) -> DataFrame:
    """Documents as (unit, doc_id, order, text, kept columns).

    A unit is a range of the hash ``order``, so documents of equal or no ids, however many, spread over the units, and
    of two with equal ids that with the smaller hash lies in the earlier unit.
    """
    count = 2 * partitions(docs.sparkSession)
    order = F.xxhash64(F.col(key), F.col(text))
    rows = docs.select(
        F.shiftright(F.shiftrightunsigned(order, 33) * F.lit(count), 31).cast("int").alias("__unit"),
        F.col(key).cast("long").alias("__id"),
        order.alias("__order"),
        F.col(text).cast("string").alias("__text"),
        *[F.col(c) for c in keep or []],
    )
    return rows.repartition(partitions(docs.sparkSession), "__unit")


def in_order(table: pa.Table) -> pa.Table:
    """A unit's documents by id, null ids last, then by hash and text: the same order at every visit."""
    return table.combine_chunks().sort_by([("__id", "ascending"), ("__order", "ascending"), ("__text", "ascending")])


def ids_of(table: pa.Table) -> np.ndarray:
    return table.column("__id").combine_chunks().fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)


def text_blocks(table: pa.Table) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    return blocks(table.column("__text"))


def packed(unit: int, buckets: int, kind: int, keys: np.ndarray, *more: np.ndarray) -> list[dict]:
    """Ask rows: distinct keys with up to three arrays beside them, parted by bucket."""
    lead = keys["a"] if keys.dtype == KEY else keys
    bucket = ((lead >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    keys, more = keys[order], [x[order] for x in more]
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    rows = []
    for i in np.flatnonzero(np.diff(cuts)).tolist():
        a, b = cuts[i], cuts[i + 1]
        beside = [x[a:b].tobytes() for x in more] + [None] * (3 - len(more))
        rows.append(dict(zip("bucket unit kind n keys a b c".split(), (i, unit, kind, int(b - a), keys[a:b].tobytes(), *beside))))
    return rows


def ask_table(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(
        rows,
        pa.schema(
            [("bucket", pa.int32()), ("unit", pa.int32()), ("kind", pa.int32()), ("n", pa.int64())]
            + [(c, pa.binary()) for c in ("keys", "a", "b", "c")]
        ),
    )


def answer_table(units: np.ndarray, kind: int, values: list[bytes]) -> pa.Table:
    return pa.table(
        {"unit": pa.array(units, pa.int32()), "kind": pa.array([kind] * len(values), pa.int32()), "keys": pa.array(values, pa.binary())}
    )


class Asked:
    """What a bucket got of one kind, as arrays over all entries."""

    def __init__(self, table: pa.Table, kind: int, dtype=np.uint64):
        part = table.filter(pa.compute.equal(table.column("kind"), kind))
        self.units = part.column("unit").to_numpy()
        self.sizes = part.column("n").to_numpy()
        self.table = part
        self.keys = self.array("keys", dtype)
        self.unit = np.repeat(self.units, self.sizes)

    def array(self, name: str, dtype) -> np.ndarray:
        return np.frombuffer(b"".join(self.table.column(name).to_pylist()), dtype=dtype)

    def answers(self, kind: int, chosen: np.ndarray, values: np.ndarray) -> pa.Table:
        """To each unit the values of its chosen entries."""
        ends = np.cumsum(self.sizes)
        units, out = [], []
        for u, a, b in zip(self.units.tolist(), (ends - self.sizes).tolist(), ends.tolist()):
            if (mask := chosen[a:b]).any():
                units.append(u)
                out.append(values[a:b][mask].tobytes())
        return answer_table(np.array(units, dtype=np.int32), kind, out)


def sorting(keys: np.ndarray) -> np.ndarray:
    """The stable order of keys of 64 or 128 bits."""
    if keys.dtype != KEY:
        return np.argsort(keys, kind="stable")
    order = np.argsort(keys["a"], kind="stable")
    a, b = keys["a"][order], keys["b"][order]
    # one sort is enough unless two different keys agree in their first half
    return np.lexsort((keys["b"], keys["a"])) if ((a[1:] == a[:-1]) & (b[1:] < b[:-1])).any() else order


def starts(keys: np.ndarray) -> np.ndarray:
    """Which of sorted keys differ from the one before."""
    out = np.ones(len(keys), dtype=bool)
    out[1:] = keys[1:] != keys[:-1] if keys.dtype != KEY else (keys["a"][1:] != keys["a"][:-1]) | (keys["b"][1:] != keys["b"][:-1])
    return out


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and where each is first."""
    order = sorting(keys)
    at = order[starts(keys[order])]
    return keys[at], at


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which entries have a key that another entry has too."""
    order = sorting(keys)
    first = np.append(starts(keys[order]), True)
    out = np.zeros(len(keys), dtype=bool)
    out[order] = ~(first[:-1] & first[1:])
    return out


def not_first(keys: np.ndarray, *order: np.ndarray) -> np.ndarray:
    """Which entries have a key that an entry earlier in ``order`` (main order first) has too."""
    by = np.lexsort(order[::-1])
    by = by[sorting(keys[by])]
    out = np.zeros(len(keys), dtype=bool)
    out[by] = ~starts(keys[by])
    return out


def values_of(table: pa.Table, kind: int) -> list[bytes]:
    return table.filter(pa.compute.equal(table.column("kind"), kind)).column("keys").to_pylist()


def answered_rows(table: pa.Table, kind: int, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(values_of(table, kind)), dtype=dtype)


def answered(table: pa.Table, kind: int, dtype=np.uint64) -> np.ndarray:
    return distinct(answered_rows(table, kind, dtype))[0]


def contains(values: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which ``values`` are among the sorted ``found``."""
    lead, wanted = (found["a"], values["a"]) if found.dtype == KEY else (found, values)
    at = np.searchsorted(lead, wanted)
    out, open_ = np.zeros(len(values), dtype=bool), np.flatnonzero(at < len(found))
    # keys that agree in their first half stand next to each other
    while len(open_ := open_[lead[at[open_]] == wanted[open_]]):
        same = found[at[open_]] == values[open_]
        out[open_[same]] = True
        open_ = open_[~same]
        at[open_] += 1
        open_ = open_[at[open_] < len(found)]
    return out


def ask(dealt: DataFrame, answers: DataFrame | None, work: Callable, buckets: int) -> DataFrame:
    """Ask rows from every unit: ``work(unit, documents in order, answers or None, buckets)`` returns them."""

    def alone(table: pa.Table) -> pa.Table:
        return ask_table(work(table.column("__unit")[0].as_py(), in_order(table), None, buckets))

    def together(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return ask_table([])
        return ask_table(work(table.column("__unit")[0].as_py(), in_order(table), replies, buckets))

    if answers is None:
        return dealt.groupBy("__unit").applyInArrow(alone, ASK)
    return dealt.groupBy("__unit").cogroup(answers.groupBy("unit")).applyInArrow(together, ASK)


def answer(asks: DataFrame, work: Callable[[pa.Table], list[pa.Table]]) -> DataFrame:
    def reply(table: pa.Table) -> pa.Table:
        return pa.concat_tables(work(table.combine_chunks()))

    return asks.groupBy("bucket").applyInArrow(reply, ANSWER)


def finish(dealt: DataFrame, answers: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema) -> DataFrame:
    """The last visit: ``work(documents in order, answers)`` returns the result rows of a unit."""

    def visit(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            raise ValueError("answers for a unit without documents")
        return work(in_order(table), replies)

    return dealt.groupBy("__unit").cogroup(answers.groupBy("unit")).applyInArrow(visit, schema)
