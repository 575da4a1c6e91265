"""Token ids as flat binary files with 64-bit document offsets.

Layout of a folder: for each part ``ids-NNNNN.bin`` (unsigned little-endian ids, 16 or 32 bits wide as the
vocabulary needs), ``offsets-NNNNN.bin`` (signed 64-bit: the number of ids before each document, counted over all
parts, and one more for the end), ``keys-NNNNN.bin`` (64-bit document ids) and one ``manifest.json``.  Parts are
ranges of the document id in ascending order.

Documents are ordered by a range shuffle; every part is encoded and written by its own task, under a name of its own
attempt that is then renamed, so a task that runs again replaces its files.  Only one row for each part comes back;
their prefix sums are the parts' bases, which a second step adds to the parts' local offsets.

Parts are ranges of id and the text's first characters, so that an id on many rows spreads over parts.

Defined results: a null or empty text is its end token alone; documents with equal ids follow each other, ordered by
text; null ids come first and stay null; other columns are ignored; an empty table gives an empty folder.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import partitions
from .textbytes import blocks
from .tokens import BLOCK_BYTES, encoder

KINDS = ("ids", "offsets", "keys")
#: Characters of a text that may bound a part; the bounds are sampled to the driver.
BEGIN_CHARS = 64


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def _put(store: fs.FileSystem, path: str, chunks) -> None:
    """Write a file under a name of this attempt, then give it its own."""
    context = TaskContext.get()
    trial = f"{path}.{context.taskAttemptId() if context else 'driver'}.tmp"
    with store.open_output_stream(trial) as out:
        for x in chunks:
            out.write(x)
    store.move(trial, path)


def mapped(uri: str, dtype: np.dtype) -> np.ndarray:
    """A file as an array: memory-mapped where the file system is local, read otherwise."""
    store, path = _open(uri)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r") if store.get_file_info(path).size else np.zeros(0, dtype)
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read_buffer(), dtype=dtype)


def write(docs: DataFrame, folder: str, vocabulary: str, key: str = "doc_id", text: str = "text") -> dict:
    """Write all documents to ``folder``; returns the manifest."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        number = TaskContext.get().partitionId()
        store, path = _open(folder)
        store.create_dir(path)
        keys, nulls, lengths = [], 0, []

        def encoded():
            nonlocal nulls
            for batch in batches:
                column = batch.column(0)
                nulls += column.null_count
                keys.append(column.fill_null(0).to_numpy(zero_copy_only=False))
                for _, _, data, at in blocks(batch.column(1), BLOCK_BYTES):
                    ids, bounds = coder.block(data, at)
                    lengths.append(np.diff(bounds))
                    yield ids.tobytes()

        _put(store, f"{path}/ids-{number:05d}.bin", encoded())
        offsets = np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *lengths]))]).astype("<i8")
        _put(store, f"{path}/local-{number:05d}.bin", [offsets.tobytes()])
        _put(store, f"{path}/keys-{number:05d}.bin", [np.concatenate([np.zeros(0, "<i8"), *keys]).astype("<i8").tobytes()])
        yield pa.RecordBatch.from_pydict(
            {"part": [number], "docs": [len(offsets) - 1], "nulls": [nulls], "ids": [int(offsets[-1])], "width": [coder.width.itemsize]}
        )

    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("begin", F.substring("text", 1, BEGIN_CHARS))
    by_id = F.col("doc_id").asc_nulls_first()
    ranged = rows.repartitionByRange(partitions(spark), by_id, "begin").drop("begin").sortWithinPartitions(by_id, "text")
    found = ranged.mapInArrow(parts, "part long, docs long, nulls long, ids long, width long").collect()  # one row a part
    found.sort(key=lambda r: r["part"])
    total, entries = 0, []
    for r in found:
        if r["docs"]:
            entries.append({"part": r["part"], "docs": r["docs"], "null_keys": r["nulls"], "base": total, "ids": r["ids"]})
            total += r["ids"]
    manifest = {"id_bytes": found[0]["width"] if found else 2, "total_ids": total, "parts": entries}

    def rebase(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _open(folder)
        for batch in batches:
            for part, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                local = mapped(f"{folder}/local-{part:05d}.bin", np.dtype("<i8"))
                _put(store, f"{path}/offsets-{part:05d}.bin", [(local + base).astype("<i8").tobytes()])
        yield pa.RecordBatch.from_pydict({"done": pa.array([], pa.int32())})

    if entries:
        _of_parts(spark, entries).mapInArrow(rebase, "done int").collect()
    store, path = _open(folder)
    store.create_dir(path)
    _put(store, f"{path}/manifest.json", [json.dumps(manifest).encode()])
    return manifest


def _of_parts(spark: SparkSession, entries: list[dict]) -> DataFrame:
    rows = [(e["part"], e["base"], e["docs"], e["null_keys"]) for e in entries]
    tasks = min(len(rows), 4 * partitions(spark))
    return spark.createDataFrame(rows, "part int, base long, docs long, nulls long").repartition(tasks)


def read_manifest(folder: str) -> dict:
    store, path = _open(folder)
    with store.open_input_file(f"{path}/manifest.json") as f:
        return json.loads(f.read())


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    manifest = read_manifest(folder)
    width = np.dtype(f"<u{manifest['id_bytes']}")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, offsets, keys = (
                    mapped(f"{folder}/{kind}-{r['part']:05d}.bin", np.dtype(t)) for kind, t in zip(KINDS, (width, "<i8", "<i8"))
                )
                for lo in range(0, r["docs"], 4096):
                    at = np.asarray(offsets[lo : lo + 4097])
                    crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip((at[:-1] - r["base"]).tolist(), (at[1:] - r["base"]).tolist())]
                    n = len(crc)
                    missing = np.arange(lo, lo + n) < r["nulls"]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.asarray(keys[lo : lo + n]), mask=missing), pa.array(at[:-1]), pa.array(np.diff(at)), pa.array(np.array(crc, dtype=np.int64))],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    if not manifest["parts"]:
        return spark.createDataFrame([], schema)
    return _of_parts(spark, manifest["parts"]).mapInArrow(read, schema)
