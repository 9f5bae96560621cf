"""Repeated passages: fixed blocks of every document are anchors, rolling windows look them up.

Documents are dealt into slices by a hash. A passage of ``window`` words holds a whole block of
``block = (window + 1) // 2`` words at a multiple of ``block`` in any document it stands in. So:

1. every slice sends the hashes of its rolling windows of ``block`` words, those at multiples of ``block``
   marked as anchors; a hash that is an anchor somewhere and stands in two slices is active;
2. hits are extended: every window of ``window`` words about an active hash is compared by 96 bits of a
   hash of its whole content, and the least document id of each content comes back;
3. words under a window whose content starts in a document with a smaller id are removed.

What is sent is sorted, distinct per slice and packed, so copies within a slice and frequent passages
cost one entry per slice, and no step sees pairs of documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbcount.llm.common import columns, named, pack, texts, unpack

WINDOW = 13
#: Mean bytes of text in a slice, and rolling windows that one task looks up at once.
SLICE_BYTES = 4 << 20
BUCKET_WINDOWS = 6 << 20

#: Bytes of text hashed at once, unless one text is longer.
STRETCH = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_NONE = np.iinfo(np.int64).max
_SENT = "slice bigint, bucket bigint, n bigint, first binary, second binary, third binary"
_BACK = "slice bigint, bucket bigint, round int, n bigint, mask binary, ids binary"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = [_mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(b)) for b in _BASES]
_powers: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64. Tables for ordinary stretches are kept."""
    size = STRETCH + 1
    if n > size or (base, size) not in _powers:
        size, both = max(n, size), []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        if n > STRETCH + 1:
            return both[0], both[1]
        _powers[base, size] = both[0], both[1]
    return _powers[base, size]


class Words:
    """The words of some texts: 64-bit hashes under two bases, and the text each belongs to."""

    def __init__(self, bodies: list[bytes]):
        parts, counts, at = [], [], 0
        while at < len(bodies):
            stop, held = at + 1, len(bodies[at]) + 1
            while stop < len(bodies) and held + len(bodies[stop]) < STRETCH:
                held += len(bodies[stop]) + 1
                stop += 1
            hashes, count = self._hashed(bodies[at:stop])
            parts.append(hashes)
            counts.append(count)
            at = stop
        self.hashes = [np.concatenate([np.zeros(0, np.uint64), *(p[k] for p in parts)]) for k in range(len(_BASES))]
        count = np.concatenate([np.zeros(0, np.int64), *counts])
        #: the first word of each text; one more than the texts
        self.first = np.concatenate([[0], np.cumsum(count)])
        self.doc = np.repeat(np.arange(len(bodies)), count)

    @staticmethod
    def _hashed(bodies: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
        """Word hashes under both bases, and the number of words of each text."""
        raw = np.frombuffer(b" ".join([*bodies, b""]), np.uint8)
        inside = np.concatenate([[False], ~_SPACE[raw]])
        starts = np.flatnonzero(inside[1:] & ~inside[:-1])
        ends = np.flatnonzero(inside[:-1] & ~inside[1:])
        hashes = []
        for byte, base in zip(_BYTE, _BASES):
            power, inverse = _power(base, len(raw))
            total = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(byte[raw] * power[: len(raw)])])
            hashes.append(_mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)))
        return hashes, np.diff(np.searchsorted(starts, np.cumsum([0, *(len(b) + 1 for b in bodies)])))

    def windows(self, size: int, which: int) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first word, hash) of every run of ``size`` words within a text."""
        h = self.hashes[which]
        n = len(h) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        rolled = np.zeros(n, np.uint64)
        for k in range(size):
            rolled = rolled * np.uint64(_BASES[1 - which]) + h[k : n + k]
        at = np.flatnonzero(self.doc[:n] == self.doc[size - 1 :])
        return at, _mix(rolled[at])


def _bucketed(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket (from the upper half) of every hash, and the edges of each bucket in a sorted array."""
    of = ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return of, np.searchsorted(of, np.arange(buckets + 1))


def _filled(edges: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The buckets that hold something: rows and steps are at most as many as hashes, however many buckets there are."""
    for bucket in np.flatnonzero(np.diff(edges)).tolist():
        yield bucket, slice(int(edges[bucket]), int(edges[bucket + 1]))


class Slice:
    """One group of documents, from which every step is computed again in the same order."""

    def __init__(self, ids: list[int | None], bodies: list[bytes], window: int, buckets: int):
        self.window, self.buckets, self.block = window, buckets, (window + 1) // 2
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, bodies[i]))
        self.ids = np.array([_NONE if ids[i] is None else ids[i] for i in order], np.int64)
        self.bodies = [bodies[i] for i in order]
        self.words = Words(self.bodies)
        self.at, self.rolling = self.words.windows(self.block, 0)
        # rows without an id neither lend nor lose words
        named = self.ids[self.words.doc[self.at]] != _NONE if len(self.at) else np.zeros(0, bool)
        self.at, self.rolling = self.at[named], self.rolling[named]
        self.key, self.place, self.count = np.unique(self.rolling, return_inverse=True, return_counts=True)
        self.anchor = np.zeros(len(self.key), bool)
        inner = self.at - self.words.first[self.words.doc[self.at]] if len(self.at) else self.at
        self.anchor[self.place[inner % self.block == 0]] = True
        self.edges = _bucketed(self.key, buckets)[1]

    def anchors(self, number: int) -> Iterator[tuple]:
        for bucket, own in _filled(self.edges):
            low = ((self.key[own] >> np.uint64(16)) & np.uint64(0xFFFF)).astype(">u2")
            high = ((self.key[own] >> np.uint64(32)).astype(np.uint32)).astype(">u4")
            yield number, bucket, len(low), pack(high), low.tobytes(), np.packbits(self.anchor[own]).tobytes()

    def extend(self, active: dict[int, bytes]) -> None:
        """Windows of full length that hold an active hash."""
        live = self.anchor & (self.count > 1)
        for bucket, mask in active.items():
            own = slice(self.edges[bucket], self.edges[bucket + 1])
            live[own] |= np.unpackbits(np.frombuffer(mask, np.uint8), count=own.stop - own.start).astype(bool)
        marked = np.zeros(len(self.words.doc) + 1, np.int64)
        marked[self.at[live[self.place]] + 1] = 1
        seen = np.cumsum(marked)
        at, one = self.words.windows(self.window, 0)
        two = self.words.windows(self.window, 1)[1] >> np.uint64(32)
        # an active hash may begin at any of the window's first places
        near = seen[np.minimum(at + self.window - self.block + 1, len(seen) - 1)] > seen[at]
        self.full_at, one, two = at[near], one[near], two[near]
        owner = self.ids[self.words.doc[self.full_at]] if len(self.full_at) else np.zeros(0, np.int64)
        order = np.lexsort((owner, two, one))
        one, two, owner = one[order], two[order], owner[order]
        new = np.ones(len(one), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        self.full_place = np.empty(len(one), np.int64)
        self.full_place[order] = np.cumsum(new) - 1
        self.full = one[new], two[new]
        self.least = owner[new]
        self.full_edges = _bucketed(self.full[0], self.buckets)[1]

    def full_windows(self, number: int) -> Iterator[tuple]:
        for bucket, own in _filled(self.full_edges):
            one, two = self.full[0][own].astype(">u8"), self.full[1][own].astype(">u4")
            yield number, bucket, len(one), pack(one), two.tobytes(), pack(self.least[own].astype(">i8"))

    def kept(self, smaller: dict[int, tuple[bytes, bytes]]) -> Iterator[tuple[int, np.ndarray]]:
        """(text number, which of its words stay)."""
        for bucket, (mask, ids) in smaller.items():
            own = slice(self.full_edges[bucket], self.full_edges[bucket + 1])
            hit = np.flatnonzero(np.unpackbits(np.frombuffer(mask, np.uint8), count=own.stop - own.start)) + own.start
            self.least[hit] = unpack(ids, len(hit), ">i8")
        repeated = self.full_at[self.least[self.full_place] < self.ids[self.words.doc[self.full_at]]] if len(self.full_at) else self.full_at
        change = np.zeros(len(self.words.doc) + 1, np.int64)
        np.add.at(change, repeated, 1)
        np.add.at(change, repeated + self.window, -1)
        stays = np.cumsum(change)[:-1] == 0
        for k in range(len(self.bodies)):
            yield k, stays[self.words.first[k] : self.words.first[k + 1]]


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema)


_SENT_TYPE = pa.schema([("slice", pa.int64()), ("bucket", pa.int64()), ("n", pa.int64()), ("first", pa.binary()), ("second", pa.binary()), ("third", pa.binary())])
_BACK_TYPE = pa.schema([("slice", pa.int64()), ("bucket", pa.int64()), ("round", pa.int32()), ("n", pa.int64()), ("mask", pa.binary()), ("ids", pa.binary())])


def _entries(group: pa.Table) -> tuple[list[dict], np.ndarray, np.ndarray]:
    rows = sorted(group.to_pylist(), key=lambda r: r["slice"])
    return rows, np.array([r["n"] for r in rows]), np.cumsum([0, *(r["n"] for r in rows)])


def _active(group: pa.Table) -> pa.Table:
    """Which hashes of a bucket are an anchor in one slice and stand in another one."""
    rows, sizes, ends = _entries(group)
    high = np.concatenate([unpack(r["first"], r["n"], ">u4") for r in rows]).astype(np.uint64)
    low = np.concatenate([np.frombuffer(r["second"], ">u2") for r in rows]).astype(np.uint64)
    anchor = np.concatenate([np.unpackbits(np.frombuffer(r["third"], np.uint8), count=r["n"]) for r in rows])
    key = high << np.uint64(16) | low
    order = np.argsort(key, kind="stable")
    key = key[order]
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    live = (np.diff(np.append(begin, len(key))) > 1) & (np.add.reduceat(anchor[order].astype(np.int64), begin) > 0)
    out = np.empty(len(key), bool)
    out[order] = np.repeat(live, np.diff(np.append(begin, len(key))))
    return _table([
        (r["slice"], r["bucket"], 1, r["n"], np.packbits(own).tobytes(), b"")
        for r, own in ((r, out[ends[k] : ends[k + 1]]) for k, r in enumerate(rows)) if own.any()
    ], _BACK_TYPE)


def _least(group: pa.Table) -> pa.Table:
    """For each slice's windows the least id of their content, where it is smaller than the slice's own."""
    rows, sizes, ends = _entries(group)
    one = np.concatenate([unpack(r["first"], r["n"], ">u8") for r in rows]).astype(np.uint64)
    two = np.concatenate([np.frombuffer(r["second"], ">u4") for r in rows]).astype(np.uint64)
    ids = np.concatenate([unpack(r["third"], r["n"], ">i8") for r in rows]).astype(np.int64)
    order = np.lexsort((two, one))
    a, b = one[order], two[order]
    begin = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    least = np.empty(len(ids), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(ids[order], begin), np.diff(np.append(begin, len(ids))))
    out = []
    for k, r in enumerate(rows):
        own = slice(ends[k], ends[k + 1])
        less = least[own] < ids[own]
        if less.any():
            out.append((r["slice"], r["bucket"], 2, r["n"], np.packbits(less).tobytes(), pack(least[own][less].astype(">i8"))))
    return _table(out, _BACK_TYPE)


def _answers(back: pa.Table) -> dict[int, dict[int, tuple[bytes, bytes]]]:
    found: dict[int, dict[int, tuple[bytes, bytes]]] = {1: {}, 2: {}}
    for r in back.to_pylist():
        found[r["round"]][r["bucket"]] = r["mask"], r["ids"]
    return found


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, keep_text: bool = True) -> DataFrame:
    """One row per row: id, n_words, n_removed, kept_sha256 and, if wanted, kept_text.

    Words are runs of characters other than ``[\\x20\\x09-\\x0D]``. A word goes if a window of ``window``
    words over it also starts in a document with a smaller id; windows are judged on the input. The first
    document that holds a passage keeps it, and so do repeats within one document. Ids are integers;
    rows that share an id do not take words from each other, rows without id neither lend nor lose
    words and are not dealt into slices. Null and empty texts have no words. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    given = columns(docs, id=named(id_col).cast("bigint"), text=text_col)
    size = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count, buckets = max(1, size // SLICE_BYTES), max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), size // (6 * BUCKET_WINDOWS))
    # by id and text, since rows that share an id need not meet: only a smaller id takes words
    parts = given.where("id IS NOT NULL").select("id", "text", F.pmod(F.xxhash64("id", "text"), F.lit(count)).alias("slice"))

    def own(group: pa.Table) -> Slice:
        return Slice(group["id"].to_pylist(), texts(group["text"]), window, buckets)

    def anchors(group: pa.Table) -> pa.Table:
        return _table(list(own(group).anchors(group["slice"][0].as_py())), _SENT_TYPE)

    def extended(group: pa.Table, back: pa.Table) -> pa.Table:
        if not group.num_rows:
            return _table([], _SENT_TYPE)
        mine = own(group)
        mine.extend({k: m for k, (m, _) in _answers(back)[1].items()})
        return _table(list(mine.full_windows(group["slice"][0].as_py())), _SENT_TYPE)

    names = ["id", "n_words", "n_removed", "kept_sha256", "kept_text"][: 4 + keep_text]
    kind = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())][: 4 + keep_text])

    def kept(group: pa.Table, back: pa.Table) -> pa.Table:
        if not group.num_rows:
            return _table([], kind)
        mine, found, rows = own(group), _answers(back), []
        mine.extend({k: m for k, (m, _) in found[1].items()})
        for k, stays in mine.kept(found[2]):
            words = mine.bodies[k].split()
            left = b" ".join(words if stays.all() else [w for w, s in zip(words, stays.tolist()) if s])
            rows.append((None if mine.ids[k] == _NONE else int(mine.ids[k]), len(words), int((~stays).sum()), hashlib.sha256(left).hexdigest(), left.decode())[: len(names)])
        return _table(rows, kind)

    by_slice = parts.groupBy("slice")
    sent = by_slice.applyInArrow(anchors, _SENT)
    first = sent.groupBy("bucket").applyInArrow(_active, _BACK)
    again = by_slice.cogroup(first.groupBy("slice")).applyInArrow(extended, _SENT)
    second = again.groupBy("bucket").applyInArrow(_least, _BACK)
    both = first.unionByName(second)
    fields = "id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + ", kept_text string" * keep_text
    judged = by_slice.cogroup(both.groupBy("slice")).applyInArrow(kept, fields)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in texts(batch["text"]):
                words = text.split()
                left = b" ".join(words)
                rows.append((None, len(words), 0, hashlib.sha256(left).hexdigest(), left.decode())[: len(names)])
            yield from _table(rows, kind).to_batches()

    # rows without id are in no slice, so very many of them fill none
    apart = given.where("id IS NULL").select("text").mapInArrow(whole, fields)
    return judged.unionByName(apart).withColumnRenamed("id", id_col)
