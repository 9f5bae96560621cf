"""The additive model over all history of a series, however long, in bounded tasks.

The fit needs only sums over the observations once the places of the slope changes are known. So a series is cut into
blocks of time that any task can take: block summaries give span, spacing and the ranks of the slope changes, the
blocks that hold those ranks give their times, all blocks give Gram matrices and moments, and one small
solve per series ends it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from curbcount import schemas
from curbcount.operators import additive
from curbcount.operators.series import observations
from curbcount.session import materialise, new_path, scratch

#: A block has at most one observation a second.
BLOCK_SECONDS = 65_536
KEYS = schemas.SERIES_KEYS
_DAY = 86_400_000_000
_SUMMARY = (
    "block BIGINT, first BIGINT, last BIGINT, first_seen BIGINT, last_seen BIGINT, gap BIGINT, n DOUBLE, "
    "total DOUBLE, squares DOUBLE, least DOUBLE, greatest DOUBLE"
)
_PLAN = (
    "block BIGINT, start DOUBLE, length DOUBLE, scale DOUBLE, periods ARRAY<DOUBLE>, orders ARRAY<INT>, ranks ARRAY<BIGINT>, "
    "squares DOUBLE, n DOUBLE, level DOUBLE, first BIGINT, last BIGINT"
)
_PARTS = "size INT, gram ARRAY<DOUBLE>, moment ARRAY<DOUBLE>"


def _layout(points: DataFrame, ddl: str) -> StructType:
    return StructType([*(points.schema[k] for k in KEYS), *StructType.fromDDL(ddl).fields])


def _arrays(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, ...]:
    """Times in microseconds, and count, sum, sum of squares, least, greatest of a block's observations."""
    points = batch["points"][row].values
    times = points.field("ds").cast(pa.timestamp("us")).cast(pa.int64()).to_numpy(zero_copy_only=False)
    stats = [points.field(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in ("n", "sum_y", "sum_yy", "min_y", "max_y")]
    order = np.argsort(times, kind="stable")
    return (times[order], *(s[order] for s in stats))


def _keys(batch: pa.RecordBatch, rows: list[int]) -> list[pa.Array]:
    return [batch[k].take(pa.array(rows, pa.int64())) for k in KEYS]


def _named(columns: list, layout: StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    wanted = to_arrow_schema(layout)
    made = [c if isinstance(c, pa.Array) else pa.array(c, f.type, from_pandas=False) for c, f in zip(columns, wanted)]
    return pa.record_batch(made, wanted.names)


def _summarise(blocks: DataFrame) -> DataFrame:
    layout = _layout(blocks, _SUMMARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in range(batch.num_rows):
                times, n, total, squares, least, greatest = _arrays(batch, row)
                seen = n > 0
                own = times[seen]
                ends = (int(own[0]), int(own[-1])) if own.size else (None, None)
                gap = int(np.diff(own).min()) if own.size > 1 else None
                sums = [float(x[seen].sum()) for x in (n, total, squares)]
                out.append((batch["block"][row].as_py(), int(times[0]), int(times[-1]), *ends, gap, *sums, *((float(least[seen].min()), float(greatest[seen].max())) if own.size else (None, None))))
            if out:
                yield _named([*_keys(batch, list(range(batch.num_rows))), *map(list, zip(*out))], layout)

    return blocks.mapInArrow(run, layout)


def _planned(summary: DataFrame) -> DataFrame:
    """For every block what the whole series says: origin, length, scale, seasons, and the ranks that fall into it."""
    layout = _layout(summary, _PLAN)

    def run(key: tuple, blocks: pa.Table) -> pa.Table:
        blocks = blocks.sort_by("block")
        rows = [r for r in blocks.to_pylist() if r["n"]]
        first, last = blocks["first"][0].as_py(), blocks["last"][-1].as_py()
        if not rows:
            return pa.Table.from_batches([], schema=_named([[] for _ in layout], layout).schema)
        total, n = sum(r["total"] for r in rows), sum(r["n"] for r in rows)
        least, greatest = min(r["least"] for r in rows), max(r["greatest"] for r in rows)
        begin, end = rows[0]["first_seen"], rows[-1]["last_seen"]
        gaps = [r["gap"] for r in rows if r["gap"] is not None] + [b["first_seen"] - a["last_seen"] for a, b in zip(rows, rows[1:])]
        constant = least == greatest or begin == end
        waves = [] if constant else additive.seasons((end - begin) / _DAY, min(gaps) / _DAY)
        ranks = np.empty(0, np.int64) if constant else additive.knot_ranks(int(n))
        scale = max(abs(least), abs(greatest))
        out, before = [], 0
        for r in rows:
            own = ranks[(ranks >= before) & (ranks < before + r["n"])] - before
            before += int(r["n"])
            out.append((
                r["block"], begin / _DAY, (end - begin) / _DAY, scale, [p for p, _ in waves], [k for _, k in waves], own.tolist(),
                sum(x["squares"] for x in rows) if r is rows[0] else 0.0, n, total / n if constant else None, first, last,
            ))
        keys = [pa.array([k.as_py()] * len(out), k.type) for k in key]
        return pa.Table.from_batches([_named([*keys, *map(list, zip(*out))], layout)])

    return summary.groupBy(*KEYS).applyInArrow(run, layout)


def _knots(blocks: DataFrame, plan: DataFrame) -> DataFrame:
    """(series, knots): scaled times of the slope changes, at most as many as the model has."""
    layout = _layout(blocks, "t DOUBLE")
    wanted = blocks.join(plan.where(F.size("ranks") > 0).select(*KEYS, "block", "start", "length", "ranks"), [*KEYS, "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for row in range(batch.num_rows):
                times, n, *_ = _arrays(batch, row)
                own = additive.times_at(np.array(batch["ranks"][row].as_py()), times[n > 0], n[n > 0])
                found += (((own / _DAY) - batch["start"][row].as_py()) / batch["length"][row].as_py()).tolist()
                rows += [row] * len(own)
            if rows:
                yield _named([*_keys(batch, rows), found], layout)

    return wanted.mapInArrow(run, layout).groupBy(*KEYS).agg(F.array_sort(F.collect_list("t")).alias("knots"))


def _sums(blocks: DataFrame, plan: DataFrame) -> DataFrame:
    """Gram matrices and moments; the blocks of a series that one task has are added up there."""
    layout = _layout(blocks, _PARTS)
    wanted = blocks.join(plan.where("level IS NULL"), [*KEYS, "block"]).sortWithinPartitions(*KEYS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, gram, moment = None, 0.0, 0.0

        def done():
            return _named([*(pa.array([k.as_py()], k.type) for k in key), [len(moment)], [gram.ravel().tolist()], [moment.tolist()]], layout)

        for batch in batches:
            for row in range(batch.num_rows):
                own = [batch[k][row] for k in KEYS]
                if key is not None and [k.as_py() for k in own] != [k.as_py() for k in key]:
                    yield done()
                    gram, moment = 0.0, 0.0
                key = own
                times, n, total, *_ = _arrays(batch, row)
                seen = n > 0
                start, length, scale, knots, waves = _params(batch, row)
                g, m = additive.sums(times[seen] / _DAY, n[seen], total[seen] / scale, start, length, knots, waves)
                gram, moment = gram + g, moment + m
        if key is not None:
            yield done()

    return wanted.mapInArrow(run, layout)


def _params(rows, row: int):
    start, length, scale, knots, periods, orders = (rows[c][row].as_py() for c in ("start", "length", "scale", "knots", "periods", "orders"))
    return start, length, scale, np.array(knots or [], float), list(zip(periods, orders))


def _solved(parts: DataFrame, series: DataFrame, steps: int, step_seconds: int, layout: StructType) -> DataFrame:
    step = step_seconds * 1_000_000
    names = ["ds", "yhat", "min_history_ds", "max_history_ds"]

    def run(key: tuple, sums: pa.Table, plan: pa.Table) -> pa.Table:
        if not plan.num_rows:
            return pa.Table.from_batches([], schema=_named([[] for _ in layout], layout).schema)
        first, last, level = (plan[c][0].as_py() for c in ("first", "last", "level"))
        at = last + step * np.arange(1, steps + 1)
        if level is not None:
            values = np.full(steps, level)
        else:
            start, length, scale, knots, waves = _params(plan, 0)
            size = sums["size"][0].as_py()
            gram = np.sum([np.array(g) for g in sums["gram"].to_pylist()], axis=0).reshape(size, size)
            moment = np.sum([np.array(m) for m in sums["moment"].to_pylist()], axis=0)
            theta = additive.solve(gram, moment, plan["squares"][0].as_py() / scale**2, plan["n"][0].as_py(), knots.size)
            values = additive.fitted(theta, at / _DAY, start, length, knots, waves) * scale
        keys = [pa.array([k.as_py()] * steps, k.type) for k in key]
        times = [pa.array(x, pa.int64()).cast(pa.timestamp("us")) for x in (at, np.full(steps, first - step), np.full(steps, last))]
        return pa.Table.from_batches([_named([*keys, times[0], values.tolist(), times[1], times[2]], layout)])

    assert layout.names[len(KEYS) :] == names
    return parts.groupBy(*KEYS).cogroup(series.groupBy(*KEYS)).applyInArrow(run, layout)


def forecast_all(
    captures: DataFrame, steps: int = schemas.HORIZON_STEPS, step_seconds: int = schemas.STEP_SECONDS, block_seconds: int = BLOCK_SECONDS
) -> DataFrame:
    """The next steps of every series, fitted to all of its history: series, ds, yhat, min_history_ds, max_history_ds.

    The same values as a fit in one task, but for rounding. A task holds blocks of at most ``block_seconds`` observations, or
    the summaries of one series' blocks. Series without any volume give no row, constant ones their value.
    The result is a written table.
    """
    spark = captures.sparkSession
    path = new_path(spark, "long-fit")
    usable = captures.select(*KEYS, "Timestamp", "Vol").dropna(subset=[*KEYS, "Timestamp"])
    with scratch(spark):
        points = observations(usable)
        seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ds"))
        stats = F.struct("ds", "n", "sum_y", "sum_yy", "min_y", "max_y")
        # at most one observation a second, so a block's list is bounded
        blocks = points.withColumn("block", F.floor(seconds / F.lit(block_seconds))).groupBy(*KEYS, "block").agg(F.collect_list(stats).alias("points"))
        blocks = materialise(blocks, "blocks")
        plan = materialise(_planned(_summarise(blocks)), "block-plan")
        knots = materialise(_knots(blocks, plan), "knots")
        planned = plan.join(knots, KEYS, "left")
        parts = _sums(blocks, planned)
        # the one row of a series that has its sum of squares
        one = planned.groupBy(*KEYS).agg(
            F.max("squares").alias("squares"), *[F.first(c).alias(c) for c in ("start", "length", "scale", "periods", "orders", "knots", "n", "level", "first", "last")]
        )
        time = points.schema["ds"].dataType.simpleString()
        layout = _layout(points, f"ds {time}, yhat DOUBLE, min_history_ds {time}, max_history_ds {time}")
        _solved(parts, one, steps, step_seconds, layout).write.parquet(path)
    return spark.read.parquet(path)
