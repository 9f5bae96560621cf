"""Byte-level BPE as recursive SQL: each task runs DuckDB over its own words."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from typing import Generic, TypeVar

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbcount.llm.common import columns, kept, record_of, schema_of, slices

Value = TypeVar("Value")

SLICE_BYTES = 4 << 20
#: Encoded words, and pieces with what they decode to, that a worker knows in each of two generations.
KNOWN_WORDS, KNOWN_PIECES = 200_000, 300_000
#: Words of one merging query.
WORDS = 1 << 15
#: Rows of one decoding query.
DECODE_TOKENS = 1 << 19
#: Longer words are encoded in parts of so many bytes, which are then joined exactly.
PART_BYTES = 192

#: Token-position rows (``spot``: the word's number and the byte its token begins at) of words without
#: merges left are ``done``. Elsewhere the leftmost pair of the least rank in the word becomes one row.
#: ``pair`` is a row's id and the next one's, ``m`` the token they merge to.
_MERGE = """
WITH RECURSIVE state(spot, id, m, done) AS (
  SELECT spot, id, m, false
  FROM (SELECT spot, id, CASE WHEN lead(spot) OVER o >> 16 = spot >> 16 THEN id::BIGINT * 1048576 + lead(id) OVER o END AS pair
        FROM word_bytes WINDOW o AS (ORDER BY spot))
       LEFT JOIN merges USING (pair)
  UNION ALL
  SELECT spot, token, merges.m, best IS NULL
  FROM (
    SELECT spot, best, CASE WHEN pos = best & 65535 THEN (best >> 16)::INTEGER ELSE id END AS token,
           CASE WHEN best IS NOT NULL THEN token::BIGINT * 1048576 + CASE
             WHEN pos = best & 65535 THEN after_id
             WHEN next_pos = best & 65535 THEN best >> 16
             ELSE next_id END END AS pair
    FROM (
      SELECT spot, spot & 65535 AS pos, id, best,
             CASE WHEN next >> 16 = spot >> 16 THEN next_id END AS next_id,
             CASE WHEN next >> 16 = spot >> 16 THEN next & 65535 END AS next_pos,
             CASE WHEN after >> 16 = spot >> 16 THEN after_id END AS after_id,
             CASE WHEN last >> 16 = spot >> 16 THEN last & 65535 END AS last_pos
      FROM (SELECT spot, id, lead(spot) OVER o AS next, lead(id) OVER o AS next_id, lead(spot, 2) OVER o AS after,
                   lead(id, 2) OVER o AS after_id, lag(spot) OVER o AS last
            FROM state WHERE NOT done WINDOW o AS (ORDER BY spot))
           LEFT JOIN (SELECT spot >> 16 AS word, min((m::BIGINT << 16) | (spot & 65535)) AS best
                      FROM state WHERE NOT done AND m IS NOT NULL GROUP BY word) ON word = spot >> 16)
    WHERE best IS NULL OR last_pos IS NULL OR last_pos <> best & 65535) AS step
    LEFT JOIN merges USING (pair)
)
SELECT spot, id FROM state WHERE done ORDER BY spot"""

_DECODE = """
SELECT doc, string_agg(piece, '' ORDER BY pos) AS chars FROM encoded JOIN vocabulary USING (id) GROUP BY doc ORDER BY doc"""


class ByteBpe:
    """The rank file's vocabulary and merges as DuckDB tables, and the words already encoded."""

    def __init__(self, path: str, pattern: str, memory_mb: int = 192):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.words = regex.compile(pattern)
        #: Ids of words; ids of pieces, and what these decode to.
        self.known: Known[bytes] = Known(KNOWN_WORDS)
        self.pieces: Known[tuple[bytes, bytes]] = Known(KNOWN_PIECES)
        self._valid = np.zeros(max(self.ranks.values()) + 1, bool)
        self._valid[list(self.ranks.values())] = True
        self._byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        left, merged = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a << 20 | b)
                    merged.append(rank)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": f"{memory_mb}MB", "temp_directory": ""})
        self._table("merges", pa.table({"pair": pa.array(left, pa.int64()), "m": pa.array(merged, pa.int32())}))
        # a byte as the character of the same number, since the pieces need not be whole characters
        self._table("vocabulary", pa.table({"id": pa.array(list(self.ranks.values()), pa.int32()), "piece": [t.decode("latin-1") for t in self.ranks]}))

    def _table(self, name: str, table: pa.Table) -> None:
        self.db.register("given", table)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _ask(self, sql: str, name: str, table: pa.Table) -> pa.Table:
        self.db.register(name, table)
        try:
            return self.db.sql(sql).to_arrow_table()
        finally:
            self.db.unregister(name)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of every (non-empty) word as little-endian bytes, by the recursive query."""
        out: list[bytes] = []
        for at in range(0, len(words), WORDS):
            some = words[at : at + WORDS]
            size = np.array([len(w) for w in some])
            start = np.repeat(np.cumsum(size) - size, size)
            word = np.repeat(np.arange(len(some), dtype=np.int64), size)
            rows = pa.table({"spot": word << 16 | np.arange(len(start)) - start, "id": self._byte[np.frombuffer(b"".join(some), np.uint8)]})
            found = self._ask(_MERGE, "word_bytes", rows)
            ends = np.searchsorted(found["spot"].to_numpy() >> 16, np.arange(len(some) + 1)).tolist()
            ids = found["id"].to_numpy().astype("<u4").tobytes()
            out += [ids[4 * a : 4 * b] for a, b in zip(ends[:-1], ends[1:])]
        return out

    def _bytes_of(self, ids: list[int]) -> bytes:
        return b"".join(map(self._piece.__getitem__, ids))

    @property
    def _piece(self) -> dict[int, bytes]:
        if not hasattr(self, "_pieces"):
            self._pieces = {rank: token for token, rank in self.ranks.items()}
        return self._pieces

    def _join(self, encoded: list[bytes]) -> list[int]:
        """One long word from its encoded parts.

        A token sequence is the word's encoding if every two neighbours are the encoding of their bytes,
        so only the tokens about a seam are encoded again, in a growing stretch, until both its ends fit.
        """
        whole, *rest = (np.frombuffer(x, "<u4").tolist() for x in encoded)
        for right in rest:
            reach = 4
            while True:
                a, b = max(0, len(whole) - reach), min(len(right), reach)
                middle = np.frombuffer(self.merge([self._bytes_of(whole[a:] + right[:b])])[0], "<u4").tolist()
                ends = ([whole[a - 1], middle[0]] if a else None, [middle[-1], right[b]] if b < len(right) else None)
                pairs = [p for p in ends if p]
                if all(np.array(p, "<u4").tobytes() == q for p, q in zip(pairs, self.merge([self._bytes_of(p) for p in pairs]))):
                    whole = whole[:a] + middle + right[b:]
                    break
                reach *= 2
        return whole

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The words' ids as little-endian bytes. A word in the vocabulary is its own token."""
        out, new, long = {}, [], []
        for word in words:
            raw = word.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                out[word] = rank.to_bytes(4, "little")
            else:
                (long if len(raw) > PART_BYTES else new).append((word, raw))
        out.update(zip((word for word, _ in new), self.merge([raw for _, raw in new])))
        for word, raw in long:
            parts = self.merge([raw[i : i + PART_BYTES] for i in range(0, len(raw), PART_BYTES)])
            out[word] = np.array(self._join(parts), "<u4").tobytes()
        return [out[word] for word in words]

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of every text, four little-endian bytes each. Every match of the pattern is encoded apart.

        A space between two visible characters starts a match whatever stands before it, so texts are
        first cut there, and each distinct piece is matched and encoded once.
        """
        pieces, numbers, ends = cut(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()))
        return [bytes(x) for x in gathered(self.encode_pieces(pieces), numbers, ends)]

    def round_trip(self, texts: pa.Array) -> tuple[list[memoryview], list[memoryview]]:
        """Ids of every text, and what they decode to: the distinct pieces' ids are decoded and put together alike."""
        pieces, numbers, ends = cut(texts)
        pairs = self.pieces.all(pieces, self._there_and_back)
        return gathered([ids for ids, _ in pairs], numbers, ends), gathered([raw for _, raw in pairs], numbers, ends)

    def _there_and_back(self, pieces: list[str]) -> list[tuple[bytes, bytes]]:
        coded = self.encode_pieces(pieces)
        return list(zip(coded, self.decode(coded)))

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of every piece."""
        matches = [self.words.findall(p) for p in pieces]
        words = list({w for own in matches for w in own})
        coded = dict(zip(words, self.known.all(words, self.encode_words)))
        return [coded[own[0]] if len(own) == 1 else b"".join(map(coded.__getitem__, own)) for own in matches]

    def decode(self, ids: list[bytes] | list[np.ndarray]) -> list[bytes]:
        """The bytes of every id sequence, by ordered aggregation over its rows. Unknown ids are an error."""
        raw = [x if isinstance(x, bytes) else np.asarray(x, "<u4").tobytes() for x in ids]
        flat = np.frombuffer(b"".join(raw), "<u4")
        size = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        if len(flat) and (flat.max() >= len(self._valid) or not self._valid[flat].all()):
            raise ValueError("an id is not in the vocabulary")
        # long sequences in runs, which are whole bytes each
        runs = np.maximum(1, -(-size // DECODE_TOKENS))
        owner = np.repeat(np.arange(len(size)), runs)
        rank = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
        ends = np.cumsum(np.minimum(DECODE_TOKENS, size[owner] - rank * DECODE_TOKENS))
        out, at = [], 0
        while at < len(ends):
            begin = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, begin + DECODE_TOKENS, side="right")))
            out += self._decoded(flat[begin : int(ends[stop - 1])], np.diff(ends[at:stop], prepend=begin))
            at = stop
        if len(out) == len(raw):
            return out
        whole: list[list[bytes]] = [[] for _ in raw]
        for k, part in zip(owner.tolist(), out):
            whole[k].append(part)
        return [b"".join(own) for own in whole]

    def _decoded(self, flat: np.ndarray, size: np.ndarray) -> list[bytes]:
        doc = np.repeat(np.arange(len(size), dtype=np.int32), size)
        rows = pa.table({"doc": doc, "pos": np.arange(len(flat), dtype=np.int32), "id": flat.astype(np.int32)})
        found = self._ask(_DECODE, "encoded", rows)
        chars = [c.encode("latin-1") for c in found["chars"].to_pylist()]
        if len(chars) == len(size):
            return chars
        # sequences without ids have no rows
        out = [b""] * len(size)
        for k, c in zip(found["doc"].to_pylist(), chars):
            out[k] = c
        return out


class Known(Generic[Value]):
    """Results by text in two generations of at most ``size``: keys that come again outlive a change."""

    def __init__(self, size: int):
        self.size = size
        self.now: dict[str, Value] = {}
        self.older: dict[str, Value] = {}

    def all(self, keys: list[str], make: Callable[[list[str]], list[Value]]) -> list[Value]:
        """The results of all keys; those of unknown ones are made together."""
        found = list(map(self.now.get, keys))
        missing = [n for n, x in enumerate(found) if x is None]
        if not missing:
            return found
        if len(self.now) > self.size:
            self.now, self.older = {}, self.now
        new = []
        for n in missing:
            old = found[n] = self.older.get(keys[n])
            if old is None:
                new.append(n)
            else:
                self.now[keys[n]] = old
        if new:
            unknown = list(dict.fromkeys([keys[n] for n in new]))
            made = dict(zip(unknown, make(unknown)))
            self.now.update(made)
            for n in new:
                found[n] = made[keys[n]]
        return found


def cut(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct pieces, the numbers of all pieces in order, the end of every text among them). Null is empty.

    Texts are cut before single spaces between two characters that are no white space. Other parts stay
    with the part before them.
    """
    lists = pc.split_pattern(pc.fill_null(texts, ""), " ")
    flat = lists.flatten().dictionary_encode()
    code, words = flat.indices.to_numpy(), flat.dictionary.to_pylist()
    begin = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
    empty = pc.equal(pc.binary_length(flat.dictionary), 0)
    opens, closes = (
        pc.or_(empty, pc.utf8_is_space(pc.utf8_slice_codeunits(flat.dictionary, a, b))).to_numpy(zero_copy_only=False) for a, b in ((0, 1), (-1, None))
    )
    first = np.zeros(len(code) + 1, bool)
    first[begin[:-1]] = True
    first = first[:-1]
    held = np.zeros(len(code), bool)
    held[1:] = closes[code[:-1]] | opens[code[1:]]
    held &= ~first
    start = np.flatnonzero(~held)
    stop = np.append(start[1:], len(code))
    # a word as the first of a text, or after a space
    key = 2 * code[start].astype(np.int64) + first[start]
    alone = stop - start == 1
    used = np.zeros(2 * len(words), bool)
    used[key[alone]] = True
    number = np.cumsum(used)[key] - 1
    pieces = [words[k >> 1] if k & 1 else " " + words[k >> 1] for k in np.flatnonzero(used).tolist()]
    longer: dict[str, int] = {}
    for k in np.flatnonzero(~alone).tolist():
        text = " " * (not first[start[k]]) + " ".join([words[c] for c in code[start[k] : stop[k]].tolist()])
        number[k] = longer.setdefault(text, len(pieces) + len(longer))
    return [*pieces, *longer], number, np.searchsorted(start, begin[1:])


def gathered(values: list[bytes], numbers: np.ndarray, ends: np.ndarray) -> list[memoryview]:
    """The values of these numbers in a row, cut at the ends."""
    taken = pa.array(values, pa.large_binary()).take(pa.array(numbers))
    _, offsets, data = taken.buffers()
    at = np.frombuffer(offsets, np.int64)[: len(taken) + 1] if len(taken) else np.zeros(1, np.int64)
    places = at[np.concatenate([[0], ends])].tolist()
    whole = memoryview(data) if data is not None else memoryview(b"")
    return [whole[a:b] for a, b in zip(places[:-1], places[1:])]


def codec(path: str, pattern: str) -> ByteBpe:
    """The worker's own, with the words it knows."""
    return kept(("byte_bpe", path, pattern), lambda: ByteBpe(path, pattern))


def _coded(docs: DataFrame, path: str, pattern: str, text_col: str, keep_ids: bool) -> DataFrame:
    """record, n_tokens, ids_sha256, decoded_sha256 and, if kept, ids of every row."""
    frame = record_of(docs, [text_col], text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for part in slices(batches, "text", SLICE_BYTES):
            ids, raw = bpe.round_trip(part["text"])
            decoded = [hashlib.sha256(d).hexdigest() for d in raw]
            made = [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in ids]), pa.array(decoded, pa.string())]
            if keep_ids:
                ends = pa.array(np.cumsum([0, *(len(x) // 4 for x in ids)]), pa.int32())
                made.append(pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32))))
            yield pa.record_batch([part["record"], *made], ["record", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: 1 + len(made)])

    return frame.mapInArrow(run, schema_of(frame, "record", "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids))


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id, n_tokens, ids_sha256 (little-endian 32-bit ids), decoded_sha256.

    Null and empty texts have no tokens. Rows with equal or null ids stay apart; other columns are not read.
    """
    coded = _coded(columns(docs, id=id_col, text=text_col), path, pattern, "text", False)
    return coded.select(F.col("record.id").alias(id_col), "n_tokens", "ids_sha256", "decoded_sha256")


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
    """``docs`` without the text, with n_tokens, ids_sha256, decoded_sha256 (of what the ids decode to) and
    the ids as ``ids_col``; columns of these names are replaced."""
    made = ["n_tokens", "ids_sha256", "decoded_sha256"]
    others = [F.col("record").getField(c).alias(c) for c in docs.columns if c not in (text_col, ids_col, *made)]
    return _coded(docs, path, pattern, text_col, True).select(*others, *made, F.col("ids").alias(ids_col))


def decode(encoded: DataFrame, path: str, pattern: str, ids_col: str = "token_ids", text_col: str = "text") -> DataFrame:
    """The reverse of ``encode``: invalid UTF-8 becomes the replacement character; null ids give null."""
    frame = record_of(encoded, [ids_col], ids=ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch in batches:
            ids = batch["ids"].to_pylist()
            known = [np.array(x or [], "<u4").tobytes() for x in ids]
            raw = bpe.decode(known)
            yield pa.record_batch([batch["record"], pa.array([None if x is None else d.decode("utf-8", "replace") for x, d in zip(ids, raw)], pa.string())], ["record", "text"])

    decoded = frame.mapInArrow(run, schema_of(frame, "record", "text string"))
    return decoded.select(*[F.col("record").getField(c).alias(c) for c in encoded.columns if c not in (ids_col, text_col)], F.col("text").alias(text_col))
