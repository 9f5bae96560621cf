"""Benchmark passages in documents: one automaton over all windows, each text scanned once."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbcount.llm.common import LETTERS, columns, kept, record_of, schema_of, slices, whole
from curbcount.session import materialise

WINDOW = 13
#: Windows' bytes an automaton is built from; a larger benchmark is scanned for by several.
AUTOMATON_BYTES = 24 << 20
WINDOWS_AT_ONCE = 1 << 16
LEAST_SHARE = 20

_KEEP = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_NORMAL = bytes(b if b in _KEEP else 0x20 for b in bytes(range(256)).translate(bytes.maketrans(*(x.encode() for x in LETTERS))))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased A-Z; a word is a run of digits, letters a-z and everything beyond ASCII."""
    return (text or "").encode().translate(_NORMAL).split()


def windows_of(words: list[bytes], window: int = WINDOW) -> list[bytes]:
    if not words:
        return []
    return [b" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))]


def _blocks(items: DataFrame, window: int, limit: int) -> tuple[DataFrame, int]:
    """Pairs of window and item as a written table in blocks of about ``limit`` bytes, and their number.

    Windows are cut and freed of repetition by tasks. Pairs are dealt by a hash, so the items of a window that very
    many share are spread, too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, text in zip(batch["item"].to_pylist(), batch["text"].to_pylist()):
                found = list(dict.fromkeys(windows_of(words_of(text), window)))
                for at in range(0, len(found), WINDOWS_AT_ONCE):
                    some = [w.decode("latin-1") for w in found[at : at + WINDOWS_AT_ONCE]]
                    yield pa.record_batch([pa.array(some, pa.string()), pa.array([own] * len(some), pa.string())], ["body", "item"])

    named = columns(items, item=F.col("item").cast("string"), text="text")
    pairs = materialise(named.mapInArrow(run, "body string, item string").distinct(), "windows")
    size = pairs.agg(F.sum(F.octet_length("body") + F.coalesce(F.octet_length("item"), F.lit(0)) + 64)).first()[0] or 0
    return pairs, max(1, -(-size // limit))


def _block(pairs: DataFrame, number: int, count: int) -> list[tuple[str, list[str]]]:
    """Windows of one block with their items; bounded, so that it may pass through the driver."""
    own = pairs.where(F.pmod(F.xxhash64("body", "item"), F.lit(count)) == number)
    return [(r["body"], r["items"]) for r in own.groupBy("body").agg(F.collect_set("item").alias("items")).collect()]


def _automaton(name: str, block: list[tuple[str, list[str]]]) -> ahocorasick.Automaton | None:
    """The block's automaton; one per worker is kept."""
    if not block:
        return None

    def build() -> ahocorasick.Automaton:
        made = ahocorasick.Automaton()
        for text, owners in block:
            made.add_word(f" {text} ", (len(text) + 2, owners))
        made.make_automaton()
        return made

    return kept(("windows", name), build)


def hits(text: str | None, automaton: ahocorasick.Automaton | None) -> tuple[np.ndarray, list[tuple[int, int]], set[str]]:
    """Offsets of the words in the normalised text, hit word ranges (end exclusive), items found."""
    words = words_of(text)
    if automaton is None or not words:
        return np.zeros(len(words) + 1, np.int64), [], set()
    starts = np.cumsum([1, *(len(w) + 1 for w in words)])
    spans, items = [], set()
    for end, (size, owners) in automaton.iter(b" ".join([b"", *words, b""]).decode("latin-1")):
        first = int(np.searchsorted(starts, end - size + 2))
        last = int(np.searchsorted(starts, end + 1))
        spans.append((first, last))
        items.update(owners)
    return starts, merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [(a, b) for a, b in out]


def character_spans(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Hit word ranges as code point offsets of the original text, end exclusive."""
    raw = np.frombuffer(text.encode().translate(_NORMAL), np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(np.concatenate([[False], raw, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    place = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80)  # code points begun by then
    return [(int(place[starts[a]]) - 1, int(place[ends[b - 1] - 1])) for a, b in spans]


_SPAN = "struct<first:int,last:int,start:int,end:int>"
_SPANS = pa.list_(pa.struct([(n, pa.int32()) for n in ("first", "last", "start", "end")]))


def _scan(frame: DataFrame, block: list[tuple[str, list[str]]], carried: list[str], every: bool = True) -> DataFrame:
    """One pass over the texts with one block: n_words, spans, items, beside the columns that are carried. Only rows
    with hits unless ``every``."""
    shared, name = frame.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(name, shared.value)
        for part in slices(batches, "text"):
            words, spans, items, rows = [], [], [], []
            for i, text in enumerate(part["text"].to_pylist()):
                starts, own, found = hits(text, automaton)
                if every or own:
                    places = character_spans(text, own) if own else []
                    rows.append(i)
                    words.append(len(starts) - 1)
                    spans.append([{"first": a, "last": b, "start": x, "end": y} for (a, b), (x, y) in zip(own, places)])
                    items.append(list(found))
            made = [pa.array(words, pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))]
            stays = part.select(carried)
            stays = stays if every else stays.take(pa.array(rows, pa.int64()))
            yield pa.record_batch([*stays.columns, *made], [*carried, "n_words", "spans", "items"])

    return frame.mapInArrow(run, schema_of(frame, carried, f"n_words bigint, spans array<{_SPAN}>, items array<string>"))


def _together(found: DataFrame) -> DataFrame:
    """One row per row from what several blocks found in it; spans that meet become one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for own in batch["spans"].to_pylist():
                out: list[dict] = []
                for s in sorted(own, key=lambda s: (s["first"], s["last"])):
                    if out and s["first"] <= out[-1]["last"]:
                        out[-1] |= {k: max(s[k], out[-1][k]) for k in ("last", "end")}
                    else:
                        out.append(s)
                spans.append(out)
            yield pa.record_batch([batch["row"], batch["n_words"], pa.array(spans, _SPANS), batch["items"]], batch.schema.names)

    lists = found.groupBy("row").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")
    )
    return lists.mapInArrow(run, lists.schema)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, automaton_bytes: int = AUTOMATON_BYTES, keep_text: bool = True,
) -> DataFrame:
    """One row per row of ``docs``: what the benchmark's windows hit in it.

    Columns: ``record`` (struct of all columns but the text), ``text`` (if kept), n_words, spans (hit word ranges
    ``first`` to ``last`` and their code points ``start`` to ``end`` in the original text, ends exclusive), items, n_hit, n_items,
    items_sha256, contaminated (hits, and at least one word in twenty hit). A window is ``window`` consecutive words of an item,
    or a shorter item as a whole; items without words have none, items without id hit but are not counted. Null text has no
    words; rows with equal or null ids stay apart; without items nothing is hit; very long texts are scanned
    whole, like any other. Windows are cut in tasks. A benchmark beyond one automaton is dealt to several blocks: then the rows are
    numbered and written once, every block scans their texts, and what it finds is joined by number.
    """
    pairs, count = _blocks(columns(benchmark, item=item_col, text=item_text_col), window, automaton_bytes)
    if count == 1:
        frame = _scan(record_of(docs, [text_col], text=text_col), _block(pairs, 0, 1), ["record", "text"][: 1 + keep_text])
    else:
        rows = materialise(record_of(docs, [text_col], text=text_col, row=F.monotonically_increasing_id()), "scanned")
        found = [_scan(rows.select("row", "text"), _block(pairs, k, count), ["row"], k == 0) for k in range(count)]
        frame = (rows if keep_text else rows.drop("text")).join(_together(reduce(DataFrame.unionByName, found)), "row").drop("row")
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["last"] - s["first"])
    named = frame.withColumns({
        "n_hit": hit, "n_items": F.size("items").cast("bigint"), "items_sha256": F.sha2(F.concat_ws(",", F.array_sort("items")), 256),
    })
    return named.withColumn("contaminated", (F.col("n_hit") > 0) & (LEAST_SHARE * F.col("n_hit") >= F.col("n_words")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows the rule calls contaminated; whole rows, all columns, any names. Null and empty
    texts are never contaminated; an empty benchmark drops nothing."""
    found = find_contamination(docs, benchmark, text_col, **options).where("NOT contaminated")
    return whole(found, docs.columns, **{text_col: "text"})
