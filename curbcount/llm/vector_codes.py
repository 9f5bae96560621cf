"""Product codes of vectors: codebooks by rounds of exact assignment, all in integers.

A codebook holds a fixed number of entries, so codebooks, their sums and counts are the only things that
meet on the driver; the vectors are read by every round and stay where they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbcount.llm.common import columns, schema_of
from curbcount.llm.exact_gemm import exact_dot, floored
from curbcount.operators.lookup import lookup_join
from curbcount.session import materialise, scratch

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Cells of one distance matrix in a task.
CELLS = 1 << 21


def finite(vector: Column) -> Column:
    """No component is null, NaN or infinite (NaN sorts above infinity). Null vectors give null."""
    return F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))


def _whole(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of ``width`` integers; shorter vectors end in zeros."""
    values = floored(pc.list_flatten(vectors).to_numpy(zero_copy_only=False), SCALE, int((2.0**60 / max(width, 1)) ** 0.5))
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _parts(vectors: pa.Array, books: np.ndarray) -> Iterator[np.ndarray]:
    """Blocks of rows as (part, row, component)."""
    parts, entries, wide = books.shape
    rows = _whole(vectors, parts * wide)
    step = max(1, CELLS // (parts * entries))
    for at in range(0, len(rows), step):
        yield rows[at : at + step].reshape(-1, parts, wide).transpose(1, 0, 2)


def assign(block: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(part, row) nearest entry, the first of equals, and the squared distance to it."""
    inner = exact_dot(np.ascontiguousarray(block), np.ascontiguousarray(books.transpose(0, 2, 1)))
    # less the row's own square, which is the same for all entries
    apart = (books * books).sum(2)[:, None, :] - 2 * inner
    code = apart.argmin(2)
    return code, np.take_along_axis(apart, code[:, :, None], 2)[:, :, 0] + (block * block).sum(2)


def _seeds(kept: DataFrame, parts: int, entries: int) -> np.ndarray:
    """The first codebooks: the vectors of the least ids. A task hands on its own least ids only."""

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, longest = None, 0
        for batch in batches:
            if batch.num_rows:
                longest = max(longest, pc.max(pc.list_value_length(batch["v"])).as_py())
                rows = pa.Table.from_batches([batch.select(["id", "v"])])
                rows = rows if best is None else pa.concat_tables([best, rows])
                ids = pc.unique(rows["id"]).sort()[:entries]
                best = rows.filter(pc.is_in(rows["id"], ids))
                # of an id that stands in many rows one vector is enough: the least
                if best.num_rows > 4 * entries:
                    best = _one_each(best)
        if best is not None:
            for row in _one_each(best).to_batches():
                yield pa.record_batch([row["id"], row["v"], pa.array([longest] * row.num_rows, pa.int32())], ["id", "v", "longest"])

    with scratch(kept.sparkSession):
        # a few rows a task, read by two small jobs
        found = materialise(kept.select("id", "v").mapInArrow(least, "id bigint, v array<double>, longest int"), "seeds")
        longest = found.agg(F.max("longest")).first()[0] or 0
        first = found.groupBy("id").agg(F.min("v").alias("v")).orderBy(F.col("id").asc_nulls_last()).limit(entries).collect()
    wide = max(1, -(-longest // parts))
    rows = _whole(pa.array([r["v"] for r in first], pa.list_(pa.float64())), parts * wide)
    return rows.reshape(len(rows), parts, wide).transpose(1, 0, 2)


def _one_each(rows: pa.Table) -> pa.Table:
    """The least vector of every id; null ids are one id, the last."""
    best: dict = {}
    for i, v in zip(rows["id"].to_pylist(), rows["v"].to_pylist()):
        if i not in best or v < best[i]:
            best[i] = v
    return pa.table({"id": pa.array(list(best), pa.int64()), "v": pa.array(list(best.values()), pa.list_(pa.float64()))})


def _next(kept: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every entry becomes the floor of its parts' mean, unused ones stay. Tasks sum up first."""
    parts, entries, wide = books.shape
    names = [f"s{k}" for k in range(wide)]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, wide), np.int64)
        for batch in batches:
            for block in _parts(batch["v"], books):
                slot = (assign(block, books)[0] + np.arange(parts)[:, None] * entries).ravel()
                count += np.bincount(slot, minlength=parts * entries)
                np.add.at(total, slot, block.reshape(-1, wide))
        used = np.flatnonzero(count)
        yield pa.record_batch([pa.array(used.astype(np.int32)), pa.array(count[used]), *(pa.array(c) for c in total[used].T)], ["slot", "n", *names])

    part = kept.select("v").mapInArrow(sums, "slot int, n bigint, " + ", ".join(f"{s} bigint" for s in names))
    # wider than 64 bits: the parts of very many rows
    found = part.groupBy("slot").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ["n", *names]]).collect()
    out = books.reshape(-1, wide).copy()
    for row in found:
        out[row["slot"]] = [int(row[s]) // int(row["n"]) for s in names]
    return out.reshape(parts, entries, wide)


def compress(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """(coded, books): id, label, code (two hex digits a part), error of every kept row; the codebooks as
    integers (part, entry, component).

    Components become floor(256 x). Rows whose vector is null or has a null or non-finite component are left
    out; every other row is coded, repeated rows and null ids too, and counts in the means. Codebooks start
    from the ``entries`` least distinct ids (null is the last id, an id of several vectors starts with the
    least of them), from fewer if there are fewer. Equally near entries: the first. Vectors shorter than
    the longest, or a length no multiple of ``parts``, end in zeros. No kept rows: no codes, empty books. Components so large
    that squares might leave 64 bits raise OverflowError. Other columns are not read.
    """
    given = columns(rows, id=id_col, label=label_col, v=vector_col).where(finite(F.col("v")))
    given = given.withColumns({"id": F.col("id").cast("bigint"), "v": F.col("v").cast("array<double>")})
    books = _seeds(given, parts, entries)
    for _ in range(rounds if books.shape[1] else 0):
        books = _next(given, books)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and books.shape[1]:
                found = [assign(block, books) for block in _parts(batch["v"], books)]
                codes = np.concatenate([c for c, _ in found], 1).T.astype(np.uint8)
                error = np.concatenate([e for _, e in found], 1).sum(0)
                yield pa.record_batch([batch["label"], batch["id"], pa.array([c.tobytes().hex() for c in codes]), pa.array(error)], ["label", "id", "code", "error"])

    coded = given.select("label", "id", "v").mapInArrow(code, schema_of(given, "label", "id bigint, code string, error bigint"))
    return coded.select(F.col("id").alias(id_col), F.col("label").alias(label_col), "code", "error"), books


def books_sha256(books: np.ndarray) -> str:
    """Digest of all components in decimal, by part, entry and place."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_error(coded: DataFrame, label_col: str = "label") -> DataFrame:
    """``coded`` with label_error, the error summed over rows of an equal label (nulls are equal)."""
    keyed = coded.withColumns({"label_key": F.coalesce(F.col(label_col).cast("string"), F.lit("")), "no_label": F.col(label_col).isNull()})
    # one row a label, written so that its size is known before the join
    totals = materialise(keyed.groupBy("label_key", "no_label").agg(F.sum("error").alias("label_error")), "label-errors")
    return lookup_join(keyed, totals, ["label_key", "no_label"]).drop("label_key", "no_label")
