"""Exact duplicates by Grace hashing: spill by hash until a bucket fits, then compare whole contents."""

from __future__ import annotations

import hashlib
import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbcount.llm.common import columns, record_of, release, schema_of, slices, whole
from curbcount.session import materialise

SPACES = b" \t\n\x0b\x0c\r"
BUCKET_BYTES = 48 << 20
FAN_OUT = 16
MAX_DEPTH = 6


class ContentTable:
    """Open addressing over whole contents: each distinct content has one slot and one owner.

    Slots come from the upper bits of the hash, since spill files share the lower ones.
    """

    def __init__(self, slots: int = 1 << 10):
        self._slots = np.full(slots, -1, np.int64)
        self.bodies: list[bytes] = []
        self.hashes: list[int] = []
        self.bytes = 0

    def _seek(self, body: bytes, key: int) -> tuple[int, int]:
        mask = len(self._slots) - 1
        slot = (key >> 24) & mask
        while (entry := int(self._slots[slot])) >= 0:
            if self.hashes[entry] == key and self.bodies[entry] == body:
                return slot, entry
            slot = (slot + 1) & mask
        return slot, -1

    def find(self, body: bytes, key: int) -> int:
        """The entry of the content, or -1."""
        return self._seek(body, key)[1]

    def place(self, body: bytes, key: int) -> tuple[int, bool]:
        """The entry of the content, and whether it is new."""
        slot, entry = self._seek(body, key)
        if entry >= 0:
            return entry, False
        entry = len(self.bodies)
        self._slots[slot] = entry
        self.bodies.append(body)
        self.hashes.append(key)
        self.bytes += len(body) + 128
        if 2 * len(self.bodies) > len(self._slots):
            self._grow()
        return entry, True

    def _grow(self) -> None:
        self._slots = np.full(2 * len(self._slots), -1, np.int64)
        mask = len(self._slots) - 1
        for entry, key in enumerate(self.hashes):
            slot = (key >> 24) & mask
            while self._slots[slot] >= 0:
                slot = (slot + 1) & mask
            self._slots[slot] = entry


def normalised(text: bytes) -> bytes:
    return text.translate(None, SPACES)


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to every row its hashes, its length and the first row of this task with the same content."""
    release()
    table, owners = ContentTable(), []
    for part in slices(batches, "text"):
        own, keys, sha, chars = [], [], [], []
        for row, text in zip(part["row"].to_pylist(), part["text"].to_pylist()):
            body = normalised((text or "").encode())
            key = xxhash.xxh3_64_intdigest(body)
            if table.bytes > BUCKET_BYTES:
                table, owners = ContentTable(), []
            entry, new = table.place(body, key)
            if new:
                owners.append(row)
            own.append(owners[entry])
            keys.append(key - (1 << 63))
            sha.append(hashlib.sha256(body).hexdigest())
            chars.append(len(text or ""))
        extra = [pa.array(own, pa.int64()), pa.array(keys, pa.int64()), pa.array(sha, pa.string()), pa.array(chars, pa.int64())]
        yield pa.record_batch([*part.columns, *extra], [*part.schema.names, "own", "key", "sha", "chars"])


def _read(path: Path) -> Iterator[tuple[int, int, bytes]]:
    with pa.OSFile(str(path)) as file:
        for batch in pa.ipc.open_stream(file):
            yield from zip(*(batch[c].to_pylist() for c in ("row", "key", "body")))


class _Spill:
    """Files of one level; records go to a file by four bits of their hash."""

    def __init__(self, folder: Path, depth: int):
        self.folder, self.depth = folder, depth
        self.pending: list[list] = [[] for _ in range(FAN_OUT)]
        self.held = 0
        self.writers: dict[int, tuple] = {}

    def add(self, record: tuple[int, int, bytes]) -> None:
        self.pending[(record[1] >> (4 * self.depth)) % FAN_OUT].append(record)
        self.held += len(record[2]) + 64
        if self.held > BUCKET_BYTES // 4:
            self.flush()

    def flush(self) -> None:
        for bucket, records in enumerate(self.pending):
            if records:
                row, key, body = zip(*records)
                batch = pa.record_batch([pa.array(row, pa.int64()), pa.array(key, pa.uint64()), pa.array(body, pa.large_binary())], ["row", "key", "body"])
                if bucket not in self.writers:
                    file = pa.OSFile(str(self.folder / f"{self.depth}-{bucket}"), "wb")
                    self.writers[bucket] = file, pa.ipc.new_stream(file, batch.schema)
                self.writers[bucket][1].write_batch(batch)
        self.pending, self.held = [[] for _ in range(FAN_OUT)], 0

    def close(self) -> list[Path]:
        self.flush()
        for file, writer in self.writers.values():
            writer.close()
            file.close()
        return [self.folder / f"{self.depth}-{bucket}" for bucket in self.writers]


def _classes(records: Iterator[tuple[int, int, bytes]], folder: Path, depth: int) -> Iterator[tuple[int, int]]:
    """(row, first row with equal content). Spills what no longer fits and goes on with each file.

    Copies of what the table holds never spill, so one content with very many copies needs no recursion.
    """
    table, owners, spill = ContentTable(), [], None
    for row, key, body in records:
        if spill is None and table.bytes > BUCKET_BYTES and depth < MAX_DEPTH:
            level = Path(tempfile.mkdtemp(dir=folder))
            spill = _Spill(level, depth)
        if spill is None:
            entry, new = table.place(body, key)
            if new:
                owners.append(row)
            yield row, owners[entry]
        else:
            known = table.find(body, key)
            if known < 0:
                spill.add((row, key, body))
            else:
                yield row, owners[known]
    del table
    if spill is not None:
        for path in spill.close():
            yield from _classes(_read(path), level, depth + 1)
            path.unlink()


def _grace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    folder = Path(tempfile.mkdtemp(prefix="grace-"))

    def records():
        for part in slices(batches, "text"):
            for row, key, text in zip(part["row"].to_pylist(), part["key"].to_pylist(), part["text"].to_pylist()):
                yield row, key + (1 << 63), normalised((text or "").encode())

    def batch(pairs):
        return pa.record_batch([pa.array(c, pa.int64()) for c in zip(*pairs)], ["own", "class"])

    try:
        pairs: list[tuple[int, int]] = []
        for pair in _classes(records(), folder, 0):
            pairs.append(pair)
            if len(pairs) == 1 << 16:
                yield batch(pairs)
                pairs = []
        if pairs:
            yield batch(pairs)
    finally:
        shutil.rmtree(folder, ignore_errors=True)


def _classed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows with their local first copy, local first copies with class, classes with the row that stays.

    The other columns travel inside ``record``, so their names never meet those used here.
    """
    numbered = record_of(docs, [text_col], text=text_col, id=id_col, row=F.monotonically_increasing_id())
    rows = materialise(numbered.mapInArrow(_local, schema_of(numbered, numbered.columns, "own bigint, key bigint, sha string, chars bigint")), "contents")
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    firsts = rows.where("own = row").select("row", "key", "text")
    classes = firsts.repartition(width, "key").mapInArrow(_grace, "own bigint, class bigint")
    # the copies within a task first, then the classes: no step gathers the rows of a large class
    best = F.min(F.struct((-F.col("chars")).alias("less"), F.col("id").isNull().alias("no_id"), "id", "row")).alias("best")
    local = rows.groupBy("own").agg(F.count(F.lit(1)).alias("n"), best)
    joined = materialise(local.join(classes, "own"), "classes")
    kept = joined.groupBy("class").agg(F.sum("n").alias("size"), F.min("best").alias("best"))
    return rows, joined.select("own", "class"), kept.select("class", "size", F.col("best.row").alias("keep_row"), F.col("best.id").alias("keep_id"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id, keep_id, group_size, kept, text_sha256 (of the text without white space).

    Texts are equal when identical after deleting every ``[\\x20\\x09-\\x0D]``; null counts as empty.
    The row with the most code points stays, then the smallest id (null last), then the row read
    first, so exactly one row of a group is kept even if ids repeat. An empty table gives no rows;
    columns other than these two are not read.
    """
    rows, classes, kept = _classed(columns(docs, id=id_col, text=text_col), "id", "text")
    return rows.join(classes.join(kept, "class"), "own").select(
        F.col("id").alias(id_col), "keep_id", F.col("size").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"), F.col("sha").alias("text_sha256"),
    )


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` does not keep: whole rows, all columns, any names."""
    rows, _, kept = _classed(docs, id_col, text_col)
    stays = rows.join(kept.select(F.col("keep_row").alias("row")), "row", "left_semi")
    return whole(stays, docs.columns, **{text_col: "text"})
