"""Joining a large table with a lookup table whose size is checked, not assumed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from curbcount.session import materialise

BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 32
#: Facts of one key, or copies of one row, that a task takes before they are spread.
HOT_ROWS = 100_000
_SALT, _SALTS = "__salt", "__salts"
_ROW_OVERHEAD = 32


def table_bytes(df: DataFrame) -> int:
    """Upper estimate of the in-memory size, from one aggregate over the given columns."""
    width = F.lit(_ROW_OVERHEAD + 8 * len(df.columns)).cast("bigint")
    for field in df.schema.fields:
        if isinstance(field.dataType, (StringType, BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
    return df.agg(F.sum(width).alias("bytes")).first()["bytes"] or 0


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    return table_bytes(df) <= (BROADCAST_BYTES if limit is None else limit)


def lookup_join(
    facts: DataFrame, lookup: DataFrame, on: Sequence[str], limit: int | None = None
) -> DataFrame:
    """Inner join of ``facts`` with ``lookup``.

    Up to ``limit`` bytes the lookup is broadcast and the facts are not shuffled. Beyond it
    both sides are shuffled by key, and the rows of heavy keys are spread (:func:`salted_join`).
    The rows are the same either way; sums of doubles may differ in their last bits.
    """
    keys = list(on)
    if fits_broadcast(lookup, limit):
        return facts.join(F.broadcast(lookup), keys)
    return salted_join(facts, lookup, keys)


def salted_join(
    facts: DataFrame, lookup: DataFrame, on: Sequence[str], salts: int = SALTS, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Shuffled inner join that spreads the rows of heavy keys.

    Keys with more than ``hot_rows`` facts are counted first. Only their rows are salted, over as many
    tasks as their number asks for, and only their lookup rows are repeated. Equal rows of a heavy key
    travel as one row with a count and are spread again after the join. All other rows meet by key alone.
    A stream cannot be counted beforehand: there every row gets one of ``salts`` salts.
    """
    # The salt is a hash of the row, not a row counter or a random number: a task that runs
    # again after a lost executor must send each row to the same place.
    keys = list(on)
    if facts.isStreaming:
        salted = facts.withColumn(_SALT, F.pmod(F.xxhash64(*facts.columns), F.lit(salts)))
        return salted.join(_copies(lookup, F.lit(salts)), [*keys, _SALT]).drop(_SALT)
    counts = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > hot_rows)
    heavy = materialise(counts.select(*keys, F.ceil(F.col("__n") / F.lit(hot_rows)).cast("int").alias(_SALTS)), "heavy-keys")
    if heavy.isEmpty():
        return facts.join(lookup, keys)
    marked = facts.join(heavy, keys, "left")
    light = marked.filter(F.col(_SALTS).isNull()).drop(_SALTS).join(lookup, keys)
    rows = marked.filter(F.col(_SALTS).isNotNull()).groupBy(*facts.columns, _SALTS).agg(F.count(F.lit(1)).alias("__n"))
    salted = rows.withColumn(_SALT, F.pmod(F.xxhash64(*facts.columns), F.col(_SALTS).cast("bigint"))).drop(_SALTS)
    copies = _copies(lookup.join(heavy, keys), F.col(_SALTS)).drop(_SALTS)
    met = salted.join(copies, [*keys, _SALT]).drop(_SALT)
    # a count is taken apart in two steps, so that many copies of one row fill several tasks
    parts = met.withColumn("__part", F.explode(F.sequence(F.lit(0), F.floor((F.col("__n") - 1) / F.lit(hot_rows)))))
    size = F.least(F.lit(hot_rows).cast("bigint"), F.col("__n") - F.col("__part") * F.lit(hot_rows))
    spread = parts.hint("rebalance").withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), size)))
    return light.unionByName(spread.select(*light.columns))


def _copies(lookup: DataFrame, salts: Column) -> DataFrame:
    spread = F.sequence(F.lit(0).cast("bigint"), salts.cast("bigint") - 1)
    return lookup.withColumn(_SALT, F.explode(spread))
