"""Exact deduplication by Grace hashing: spill files by hash until a bucket fits a table."""

from __future__ import annotations

import hashlib
import os
import shutil
import struct
import tempfile
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.common import SPACE, large_batches, small_batches, unique_ids
from gleaner.stage import staged

# Bytes of distinct content that one table holds before its bucket is cut again.
TABLE_BYTES = 48 << 20
FANOUT = 16
_HEAD = "<qqqi"
_LAST_ID = (1 << 63) - 1
_LOCAL = (
    "doc_id long, text_sha256 string, first boolean, local_key long, copies long, content binary, salt long"
)


class ContentTable:
    """Open addressing with linear probing; equal hashes are settled by the complete content."""

    def __init__(self) -> None:
        self.slots = np.full(1024, -1, np.int64)
        self.hashes: list[int] = []
        self.content: list[bytes] = []
        self.best: list[tuple[int, int]] = []
        self.copies: list[int] = []
        self.bytes = 0

    def find(self, h: int, content: bytes) -> tuple[int, int]:
        """The entry with this content, or -1, and the slot where the search ended."""
        mask = len(self.slots) - 1
        at = h & mask
        while (entry := int(self.slots[at])) >= 0:
            if self.hashes[entry] == h and self.content[entry] == content:
                return entry, at
            at = (at + 1) & mask
        return -1, at

    def add(self, entry: int, best: tuple[int, int], copies: int) -> None:
        self.best[entry] = min(self.best[entry], best)
        self.copies[entry] += copies

    def insert(self, at: int, h: int, content: bytes, best: tuple[int, int], copies: int) -> int:
        self.slots[at] = entry = len(self.hashes)
        self.hashes.append(h)
        self.content.append(content)
        self.best.append(best)
        self.copies.append(copies)
        self.bytes += len(content) + 200
        if 2 * len(self.hashes) > len(self.slots):
            self._grow()
        return entry

    def _grow(self) -> None:
        self.slots = np.full(2 * len(self.slots), -1, np.int64)
        mask = len(self.slots) - 1
        for entry, h in enumerate(self.hashes):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry


def _hash(content: bytes, level: int) -> int:
    digest = hashlib.blake2b(content, digest_size=8, salt=level.to_bytes(4, "little")).digest()
    return int.from_bytes(digest, "little") >> 1


def _spilled(path: str) -> Iterator[tuple[int, int, int, bytes]]:
    with open(path, "rb", buffering=1 << 20) as file:
        while head := file.read(struct.calcsize(_HEAD)):
            key, doc_id, copies, size = struct.unpack(_HEAD, head)
            yield key, doc_id, copies, file.read(size)
    os.unlink(path)


def grace_groups(
    records: Iterable[tuple[int, int, int, bytes]],
    folder: str,
    table_bytes: int = TABLE_BYTES,
    level: int = 0,
) -> Iterator[tuple[array, array, ContentTable]]:
    """Group ``(key, doc_id, copies, content)`` by content, one bucket after the other.

    Yields, per bucket, the members' keys and entries, and the table, which has each entry's smallest
    ``(doc_id, key)``, sum of copies and content. Records whose content is in the table join it; once the table is full, new content
    goes to spill files by the hash of this level, and each file is a bucket of its own. A bucket of
    copies never fills a table, whatever their number, so the recursion ends. Members are numbers
    only: 16 bytes for each record of the bucket.
    """
    table, keys, entries, files = ContentTable(), array("q"), array("q"), {}
    try:
        for key, doc_id, copies, content in records:
            h = _hash(content, level)
            entry, at = table.find(h, content)
            if entry < 0 and (table.bytes < table_bytes or not table.hashes):
                entry = table.insert(at, h, content, (doc_id, key), copies)
            elif entry >= 0:
                table.add(entry, (doc_id, key), copies)
            if entry >= 0:
                keys.append(key)
                entries.append(entry)
            else:
                bucket = (h >> 40) % FANOUT
                if bucket not in files:
                    path = os.path.join(folder, f"{level}-{bucket}-{os.urandom(6).hex()}")
                    files[bucket] = open(path, "wb", buffering=1 << 18)  # noqa: SIM115
                files[bucket].write(struct.pack(_HEAD, key, doc_id, copies, len(content)))
                files[bucket].write(content)
    finally:
        for file in files.values():
            file.close()
    yield keys, entries, table
    del table, keys, entries
    for file in files.values():
        yield from grace_groups(_spilled(file.name), folder, table_bytes, level + 1)


def _in_folder(records: Iterable, table_bytes: int = TABLE_BYTES) -> Iterator:
    """Run Grace hashing in a scratch folder of the task, which is gone when the task ends."""
    folder = tempfile.mkdtemp(prefix="grace-")
    try:
        yield from grace_groups(records, folder, table_bytes)
    finally:
        shutil.rmtree(folder, ignore_errors=True)


def _rows(n: int, **columns: pa.Array) -> pa.RecordBatch:
    kinds = {
        "doc_id": pa.int64(),
        "text_sha256": pa.string(),
        "first": pa.bool_(),
        "local_key": pa.int64(),
        "copies": pa.int64(),
        "content": pa.binary(),
        "salt": pa.int64(),
    }
    arrays = [pa.array(columns[c], k) if c in columns else pa.nulls(n, k) for c, k in kinds.items()]
    return pa.RecordBatch.from_arrays(arrays, names=list(kinds))


def _local_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Group the documents of one task: a row per document, and a row with the content per group.

    A group is named by the number of the partition and a counter.
    """
    ids = array("q")

    def records():
        for batch in large_batches(batches, release=True):
            keys = batch.column("doc_id").to_pylist()
            for doc_id, content in zip(keys, batch.column("content"), strict=True):
                ids.append(doc_id)
                yield len(ids) - 1, doc_id, 1, content.as_buffer().to_pybytes()

    base = TaskContext.get().partitionId() << 40
    for keys, entries, table in _in_folder(records()):
        digests = [hashlib.sha256(c).hexdigest() for c in table.content]
        for at in range(0, len(keys), 4096):
            part, own = keys[at : at + 4096], entries[at : at + 4096]
            yield _rows(
                len(part),
                doc_id=[ids[k] for k in part],
                text_sha256=[digests[e] for e in own],
                first=[table.best[e][1] == k for k, e in zip(part, own, strict=True)],
                local_key=[base + e for e in own],
            )
        for at in range(0, len(table.content), 256):
            content = table.content[at : at + 256]
            yield _rows(
                len(content),
                doc_id=[b[0] for b in table.best[at : at + 256]],
                local_key=[base + e for e in range(at, at + len(content))],
                copies=table.copies[at : at + 256],
                content=content,
                salt=[_hash(c, 99) for c in content],
            )
        base += len(table.content)


def _global_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Group the distinct contents of all tasks; a row for each of a task's groups."""

    def records():
        for batch in large_batches(batches, release=True):
            columns = [batch.column(c).to_pylist() for c in ("local_key", "doc_id", "copies")]
            for *numbers, content in zip(*columns, batch.column("content"), strict=True):
                yield *numbers, content.as_buffer().to_pybytes()

    for keys, entries, table in _in_folder(records()):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys, pa.int64()),
                pa.array([table.best[e][0] for e in entries], pa.int64()),
                pa.array([table.best[e][1] for e in entries], pa.int64()),
                pa.array([table.copies[e] for e in entries], pa.int64()),
            ],
            names=["local_key", "keep_id", "keep_key", "group_size"],
        )


def exact_groups(docs: DataFrame) -> DataFrame:
    """Groups of equal texts: ``doc_id, keep_id, group_size, kept, text_sha256`` per row of ``docs``.

    Texts are equal when identical after each run of ASCII white space became one space; null is the
    empty text. The row with the smallest id stays; a null id counts as the largest. Of rows that
    share that id, one stays. No rows give no rows; other columns are ignored.

    Each task groups what it reads, so of any number of copies one content per task is shuffled.
    Those contents are grouped again by hash, and the small rows of the documents are joined to the
    result by the number of the task's group.
    """
    content = F.encode(F.coalesce(F.regexp_replace("text", SPACE, " "), F.lit("")), "utf-8")
    small_batches(docs.sparkSession)
    numbered = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST_ID)).alias("doc_id"), content.alias("content")
    )
    local = staged(numbered.mapInArrow(_local_groups, _LOCAL), "exact-local")
    distinct = local.filter("copies is not null").select("local_key", "doc_id", "copies", "content", "salt")
    groups = distinct.repartition("salt").mapInArrow(
        _global_groups, "local_key long, keep_id long, keep_key long, group_size long"
    )
    members = local.filter("copies is null").select("doc_id", "text_sha256", "first", "local_key")
    kept = F.col("first") & (F.col("local_key") == F.col("keep_key"))

    def public(name: str):
        return F.when(F.col(name) != _LAST_ID, F.col(name)).alias(name)

    return members.join(groups, "local_key").select(
        public("doc_id"), public("keep_id"), "group_size", kept.alias("kept"), "text_sha256"
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns. Where ids repeat, rows are matched by text as well."""
    keep = exact_groups(docs).filter("kept")
    if unique_ids(docs):
        return docs.join(keep.select("doc_id"), "doc_id", "left_semi").select(docs.columns)
    digest = F.sha2(F.encode(F.coalesce(F.regexp_replace("text", SPACE, " "), F.lit("")), "utf-8"), 256)
    keep = keep.select(F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_sha"))
    same = F.col("doc_id").eqNullSafe(F.col("_kept_id")) & (digest == F.col("_kept_sha"))
    number = Window.partitionBy("doc_id", digest).orderBy("text")
    matched = docs.join(keep, same, "left_semi").withColumn("_nth", F.row_number().over(number))
    return matched.filter("_nth = 1").select(docs.columns)
