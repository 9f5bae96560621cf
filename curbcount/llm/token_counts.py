"""Token counts by a given tokenizer, without keeping the tokens."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from curbcount.llm.common import columns, slices

SLICE_BYTES = 1 << 20
LONG_TEXT = 1 << 15
LIMIT = 4096
COUNTS = "row_id string, n_bytes bigint, n_tokens bigint, over_limit boolean"


def _safe_parts(text: str, size: int) -> list[str]:
    """Cuts before a space that follows a visible character; a piece model of which no piece goes on
    over such a place (and which adds the leading space itself) finds the same tokens in the parts."""
    parts, at = [], 0
    while len(text) - at > size:
        cut = text.find(" ", at + size)
        while cut > 0 and text[cut - 1].isspace():
            cut = text.find(" ", cut + 1)
        if cut <= 0 or cut + 1 == len(text):
            break
        parts.append(text[at:cut])
        at = cut + 1
    return [*parts, text[at:]]


@lru_cache(maxsize=4)
def counter(path: str) -> Callable[[list[str]], list[int]]:
    """The counting function for a vocabulary file; loaded once per worker.

    ``.model``: sentencepiece, ``.json``: tokenizers. Neither adds begin or end tokens, truncates or pads.
    """
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return lambda batch: [len(e) for e in tokenizer.encode_batch_fast(batch, add_special_tokens=False)]

    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        proto.ParseFromString(file.read())
    rules = proto.normalizer_spec
    splits = (
        rules.name == "identity" and rules.add_dummy_prefix and not rules.remove_extra_whitespaces
        and not any("▁" in p.piece.lstrip("▁") or p.type == 4 for p in proto.pieces)
    )

    def count(batch: list[str]) -> list[int]:
        # the model writes a space as ▁, so that a text holding ▁ itself has other borders
        parts = [_safe_parts(t, LONG_TEXT) if splits and len(t) > LONG_TEXT and "▁" not in t else [t] for t in batch]
        sizes = np.array([len(ids) for ids in model.encode([p for own in parts for p in own], num_threads=1)] or [0])
        return np.add.reduceat(sizes, np.cumsum([0, *map(len, parts[:-1])])).tolist() if parts else []

    return count


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens).

    Null and empty texts have no bytes and no tokens. Ids may be null or repeat; rows stay apart. Other
    columns are not read. Only lengths leave the workers; batches hold about a megabyte of text, and a
    text beyond ``LONG_TEXT`` characters is encoded in parts where the model's pieces allow that.
    """
    narrow = columns(docs, row_id=id_col, text=text_col)
    schema = COUNTS.replace("row_id string", f"row_id {narrow.schema['row_id'].dataType.simpleString()}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(tokenizer)
        for part in slices(batches, "text", SLICE_BYTES):
            batch = [t or "" for t in part["text"].to_pylist()]
            n = np.array(counts(batch), np.int64)
            sizes = np.array([len(t.encode()) for t in batch], np.int64)
            yield pa.record_batch([part["row_id"], pa.array(sizes), pa.array(n), pa.array(n > limit)], ["row_id", "n_bytes", "n_tokens", "over_limit"])

    return narrow.mapInArrow(run, schema).withColumnRenamed("row_id", id_col)
