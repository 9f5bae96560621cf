"""What the text operators share: Arrow slices of bounded size, packed arrays, text of a column."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SLICE_BYTES = 8 << 20
LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LOWER = bytes.maketrans(LETTERS[0].encode(), LETTERS[1].encode())


_kept: dict = {}


def kept(owner: tuple, make: Callable[[], object]):
    """A worker's costly object, made once. A worker keeps those of one owner only: what an operator that
    ran here before has left is dropped, so a chain of operators needs no more memory than one of them."""
    if owner not in _kept:
        _kept.clear()
        _kept[owner] = make()
    return _kept[owner]


def release() -> None:
    """For operators without such an object: drops what others have left in this worker."""
    _kept.clear()


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows that hold at most ``limit`` bytes of the column, or one row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at, done = 0, 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(at, stop - at)
            at, done = stop, int(ends[stop - 1])


def texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of every value, null as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def pack(array: np.ndarray) -> bytes:
    """The array's bytes, most significant plane apart, compressed; sorted values shrink well."""
    planes = np.ascontiguousarray(array).view(np.uint8).reshape(len(array), -1).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), "zstd", asbytes=True) if len(array) else b""


def unpack(data: bytes, count: int, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    if not count:
        return np.zeros(0, kind)
    raw = pa.decompress(data, count * width, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, count).T).view(kind).ravel()


def named(column: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + column.replace("`", "``") + "`")


def columns(docs: DataFrame, **given: str | Column) -> DataFrame:
    """Only the given columns under new names, so that others of any name never meet the operator's own."""
    return docs.select(*[(named(c) if isinstance(c, str) else c).alias(n) for n, c in given.items()])


def record_of(docs: DataFrame, without: Iterable[str] = (), **more: str | Column) -> DataFrame:
    """``record``, a struct of all columns but those of ``without``, and further given columns."""
    out = set(without)
    held = [named(c) for c in docs.columns if c not in out] or [F.lit(None).cast("int").alias("nothing")]
    return docs.select(F.struct(*held).alias("record"), *[(named(c) if isinstance(c, str) else c).alias(n) for n, c in more.items()])


def whole(frame: DataFrame, names: Iterable[str], **others: str) -> DataFrame:
    """The rows of ``record`` again: columns of these names in this order, some of them from a column beside it."""
    return frame.select([(F.col(others[n]) if n in others else F.col("record").getField(n)).alias(n) for n in names])


def schema_of(frame: DataFrame, kept: str | Iterable[str], ddl: str) -> StructType:
    """The types of columns that stay (names in them may need quotes, so they are never written as text), then the DDL's."""
    names = [kept] if isinstance(kept, str) else kept
    return StructType([*(frame.schema[n] for n in names), *StructType.fromDDL(ddl).fields])


def documents(spark, folder: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def no_null_text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))
