"""Hard negatives of anchors, mined from cover trees over norm-augmented candidates.

Every candidate gets one more component that brings all of a shelf to the same length, so an inner product
with an anchor is a cosine, and a ball of covering radius r about a node's centre is a cone: it bounds the
inner product of everything below the node from both sides. Shelves hold rows of all labels in bounded
number, one tree a label, and are built once. All anchors meet all shelves, in blocks.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbcount.llm.common import columns
from curbcount.llm.exact_gemm import exact_dot, floored
from curbcount.llm.vector_codes import SCALE, finite
from curbcount.session import materialise, new_path, scratch

POSITIVES, NEGATIVES = 5, 10
#: A negative's score in hundredths of the positive's.
LEAST, MOST = 30, 90
#: Vectors of a shelf as 64-bit integers; few rows are dealt to SPREAD shelves if each gets FEW rows.
SHELF_BYTES, SPREAD, FEW = 32 << 20, 64, 1024
#: Anchors of a block.
BLOCK = 4096
LEAF, FAN = 128, 24
#: Hits that wait to be merged into the best so far.
WAITING = 1 << 17


class CoverTree:
    """Nodes of the points of one label: centres a covering radius apart, from coarse to fine.

    A node's children are centred on its own centre and on points chosen farthest first, until every point
    lies within half the node's radius of one of them or the fan is full; so centres of a level are farther
    from each other than any point is from its own. Radii are measured, hence true at any fan.
    """

    def __init__(self, points: np.ndarray, rows: np.ndarray):
        self.centre, self.radius, self.below, self.rows = [], [], [], []
        self._grow(points, rows)

    def _grow(self, points: np.ndarray, rows: np.ndarray) -> None:
        waiting = [(rows, int(rows[0]), -1)]
        while waiting:
            rows, centre, above = waiting.pop()
            near = _apart(points[rows], points[centre])
            radius, at = float(near.max()), len(self.centre)
            self.centre.append(centre)
            self.radius.append(radius)
            self.below.append([])
            if above >= 0:
                self.below[above].append(at)
            if len(rows) <= LEAF or radius == 0:
                self.rows.append(rows)
                continue
            self.rows.append(rows[:0])
            owner, centres = np.zeros(len(rows), np.int64), [centre]
            while len(centres) < FAN and near.max() > radius / 2:
                far = int(rows[near.argmax()])
                apart = _apart(points[rows], points[far])
                owner[apart < near] = len(centres)
                near = np.minimum(near, apart)
                centres.append(far)
            waiting += [(rows[owner == k], c, at) for k, c in enumerate(centres)]


def _apart(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    gap = points - centre
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))


def _freeze(arrays: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def shelve(number: np.ndarray, ids: np.ndarray, labels: list[str], vectors: np.ndarray) -> bytes:
    """A shelf's rows and the trees of its labels, as bytes."""
    squares = (vectors * vectors).sum(1)
    length = float(max(1, squares.max()))
    points = np.column_stack([vectors.astype(np.float64), np.sqrt(length - squares)])
    names, label = np.unique(np.array(labels, object).astype(str), return_inverse=True)
    centre, radius, first, count, start, stop, order, roots = [], [], [], [], [], [], [], []
    for k in range(len(names)):
        tree = CoverTree(points, np.flatnonzero(label == k))
        base = len(centre)
        roots.append(base)
        centre += tree.centre
        radius += tree.radius
        for below, rows in zip(tree.below, tree.rows):
            # a node's children were numbered as they were taken from the stack, so they are listed
            first.append(len(order))
            count.append(len(below))
            order += [base + b for b in below]
            start.append(len(order))
            order += rows.tolist()
            stop.append(len(order))
    arrays = dict(number=number, ids=ids, vectors=vectors, names=names, roots=roots, centre=centre, radius=radius, first=first, count=count, start=start, stop=stop, order=order)
    return _freeze({k: np.asarray(v) for k, v in arrays.items()} | {"norm": np.array([length**0.5])})


class Best:
    """The k best hits of every (query, window): score descending, then id, then number."""

    def __init__(self, queries: int, windows: int, k: int):
        self.windows, self.k = windows, k
        self.edge = np.full((queries, windows), np.iinfo(np.int64).min)
        self.held = [np.zeros(0, np.int64)] * 4
        self.waiting: list[list[np.ndarray]] = []
        self.count = 0

    def add(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray, number: np.ndarray) -> None:
        self.waiting.append([key, score, ids, number])
        self.count += len(key)
        if self.count >= WAITING:
            self.merge()

    def merge(self) -> None:
        key, score, ids, number = (np.concatenate([h, *w]) for h, w in zip(self.held, zip(*self.waiting))) if self.waiting else self.held
        order = np.lexsort((number, ids, -score, key))
        key, score, ids, number = key[order], score[order], ids[order], number[order]
        rank = np.arange(len(key)) - np.searchsorted(key, key)
        stay = rank < self.k
        last = rank == self.k - 1
        self.edge.ravel()[key[last]] = score[last]
        self.held = [x[stay] for x in (key, score, ids, number)]
        self.waiting, self.count = [], 0


def search(
    shelf: dict[str, np.ndarray], best: Best, vectors: np.ndarray, labels: np.ndarray, number: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool
) -> None:
    """Adds the shelf's hits of all queries to ``best``: windows [low, high] of the score (query, window), rows
    of the query's own label but the query's own row, or of the other labels.

    Nodes wait in one queue, the best bound first, each with the queries that may still find something
    below it. A node outside all windows of a query, or below what it has already, is skipped for it. Leaves
    are scored exactly.
    """
    size = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
    norm = float(shelf["norm"][0])
    slack = 1e-7 * size * norm + 1.0
    centre, radius, order = shelf["centre"], shelf["radius"], shelf["order"]

    def bounds(nodes: np.ndarray, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) most and least inner product below the nodes."""
        inner = exact_dot(vectors[who], shelf["vectors"][centre[nodes]].T).astype(np.float64)
        reach = (size[who] * norm)[:, None]
        angle = np.arccos(np.clip(np.divide(inner, reach, out=np.zeros_like(inner), where=reach > 0), -1, 1))
        wide = 2 * np.arcsin(np.minimum(1.0, radius[nodes] * (1 + 1e-9) / (2 * norm)))[None, :]
        most = reach * np.cos(np.maximum(0.0, angle - wide)) + slack[who][:, None]
        return most, reach * np.cos(np.minimum(np.pi, angle + wide)) - slack[who][:, None]

    def alive(most: np.ndarray, least: np.ndarray, who: np.ndarray) -> np.ndarray:
        floor = np.maximum(low[who], best.edge[who])
        return ((most[:, None] >= floor) & (least[:, None] <= high[who]) & (low[who] <= high[who])).any(1)

    queue: list = []

    def push(nodes: np.ndarray, who: np.ndarray) -> None:
        most, least = bounds(nodes, who)
        top = np.minimum(most, high[who].max(1)[:, None].astype(np.float64))
        for k, node in enumerate(nodes.tolist()):
            left = alive(most[:, k], least[:, k], who)
            if left.any():
                heapq.heappush(queue, (-float(top[left, k].max()), node, who[left], most[left, k], least[left, k]))

    for name, root in zip(shelf["names"].tolist(), shelf["roots"].tolist()):
        who = np.flatnonzero((labels == name) == same)
        if len(who):
            push(np.array([root]), who)
    while queue:
        _, node, who, most, least = heapq.heappop(queue)
        who = who[alive(most, least, who)]
        if not len(who):
            continue
        if shelf["count"][node]:
            push(order[shelf["first"][node] :][: shelf["count"][node]], who)
            continue
        for at in range(int(shelf["start"][node]), int(shelf["stop"][node]), 8 * LEAF):
            rows = order[at : min(at + 8 * LEAF, int(shelf["stop"][node]))]
            score = exact_dot(vectors[who], shelf["vectors"][rows].T)
            apart = shelf["number"][rows][None, :] != number[who][:, None] if same else True
            for w in range(low.shape[1]):
                fits = (score >= np.maximum(low[who, w], best.edge[who, w])[:, None]) & (score <= high[who, w][:, None]) & apart
                q, r = np.nonzero(fits)
                if len(q):
                    best.add(who[q] * best.windows + w, score[q, r], shelf["ids"][rows[r]], shelf["number"][rows[r]])
        if best.count > 4 * best.windows * best.k * len(vectors):
            best.merge()


def _matrix(lists: pa.Array | pa.ChunkedArray) -> np.ndarray:
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return pc.list_flatten(lists).to_numpy(zero_copy_only=False).reshape(len(lists), -1)


_HIT = "row bigint, place int, score bigint, id bigint, number bigint"


def _meet(queries: DataFrame, shelves: DataFrame, count: int, blocks: int, k: int, same: bool) -> DataFrame:
    """The k best hits (row, place, score, id, number) of every query (row, label, v, low, high) on all shelves."""

    def run(key: tuple, asked: pa.Table, held: pa.Table) -> pa.Table:
        out = [pa.array([], t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())]
        if asked.num_rows and held.num_rows:
            vectors, low, high = (_matrix(asked[c]) for c in ("v", "low", "high"))
            number = asked["row"].to_numpy()
            best = Best(len(number), low.shape[1], k)
            for data in held["data"]:
                with np.load(io.BytesIO(data.as_py())) as shelf:
                    search(dict(shelf), best, vectors, np.array(asked["label"].to_pylist()), number, low, high, same)
            best.merge()
            at, score, ids, rows = best.held
            out = [pa.array(number[at // best.windows]), pa.array((at % best.windows).astype(np.int32)), pa.array(score), pa.array(ids), pa.array(rows)]
        return pa.table(out, ["row", "place", "score", "id", "number"])

    every = queries.withColumns({"block": F.pmod(F.xxhash64("row"), F.lit(blocks)), "shelf": F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(count - 1).cast("bigint")))})
    put = shelves.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    hits = every.groupBy("block", "shelf").cogroup(put.groupBy("block", "shelf")).applyInArrow(run, _HIT)
    order = Window.partitionBy("row", "place").orderBy(F.col("score").desc(), "id", "number")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    rows: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for every anchor and each of its
    first ``positives`` other rows of the same label, the first ``negatives`` rows of other labels whose score
    is ``least`` to ``most`` hundredths of the positive's.

    Scores are inner products of the components floor(256 x); higher ones come first, ties by the smaller id,
    then repeated rows in any order (their output is alike). ``anchor`` is a condition over ``rows``. Rows
    without id or label, or whose vector is null or has a null or non-finite component, take no part. A
    repeated row is another row: as an anchor it gives its rows once more, to its equal it is a positive. A
    negative positive score has no window. Vectors shorter than the longest end in zeros. Components
    so large that scores might leave 64 bits raise OverflowError. Labels are compared as text. No rows, no
    anchors or one label give an empty table. Other columns are not read. The result is a written table.
    """
    spark = rows.sparkSession
    path = new_path(spark, "hard-negatives")
    given = columns(rows, id=id_col, label=label_col, v=vector_col, anchor=anchor).where(F.col("id").isNotNull() & F.col("label").isNotNull() & finite(F.col("v")))
    cast = {"id": F.col("id").cast("bigint"), "label": F.col("label").cast("string"), "anchor": F.coalesce("anchor", F.lit(False)), "v": F.col("v").cast("array<double>")}

    with scratch(spark):
        # numbered once, so that a task that runs again deals its rows to the same shelves
        kept = materialise(given.withColumns(cast).withColumn("row", F.monotonically_increasing_id()), "candidates")
        total, asked, longest = kept.agg(F.count(F.lit(1)), F.count_if("anchor"), F.max(F.size("v"))).first()
        width = max(1, longest or 0)
        limit = int((2.0**60 / width) ** 0.5)
        count = max(1, -(-total * width * 8 // SHELF_BYTES), min(SPREAD, total // FEW))
        blocks = max(1, -(-asked // BLOCK))

        def whole(lists: pa.Table) -> np.ndarray:
            sizes, column = lists["v"].combine_chunks(), np.zeros((lists.num_rows, width), np.int64)
            values, each = floored(pc.list_flatten(sizes).to_numpy(zero_copy_only=False), SCALE, limit), pc.list_value_length(sizes).to_numpy(zero_copy_only=False)
            column[np.repeat(np.arange(len(each)), each), np.arange(len(values)) - np.repeat(np.cumsum(each) - each, each)] = values
            return column

        def build(key: tuple, group: pa.Table) -> pa.Table:
            data = shelve(group["row"].to_numpy(), group["id"].to_numpy(), group["label"].to_pylist(), whole(group))
            return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([data], pa.binary())], ["shelf", "data"])

        def widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    table = pa.Table.from_batches([batch])
                    ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * width)
                    yield pa.record_batch([batch["row"], batch["id"], batch["label"], pa.ListArray.from_arrays(ends, pa.array(whole(table).ravel()))], ["row", "id", "label", "v"])

        dealt = kept.select("row", "id", "label", "v", F.pmod(F.xxhash64("row"), F.lit(count)).alias("shelf"))
        shelves = materialise(dealt.groupBy("shelf").applyInArrow(build, "shelf bigint, data binary"), "shelves")
        anchors = materialise(kept.where("anchor").select("row", "id", "label", "v").mapInArrow(widen, "row bigint, id bigint, label string, v array<bigint>"), "anchors")

        ends = [F.array(F.lit(x).cast("bigint")) for x in (-(1 << 62), 1 << 62)]
        near = _meet(anchors.select("row", "label", "v", ends[0].alias("low"), ends[1].alias("high")), shelves, count, blocks, positives, True)
        # at most `positives` rows an anchor
        held = near.where("score >= 0").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("positive"))
        pairs = materialise(anchors.select("row", "id").join(held, "row"), "positives")
        windows = {
            "low": F.expr(f"transform(positive, p -> ({least} * p.score + 99) div 100)"),
            "high": F.expr(f"transform(positive, p -> ({most} * p.score) div 100)"),
        }
        # fewer positives than others have: windows that nothing fits
        full = {c: F.concat(e, F.array_repeat(F.lit(1 - k).cast("bigint"), F.lit(positives) - F.size("positive"))) for k, (c, e) in enumerate(windows.items())}
        queries = pairs.drop("id").join(anchors.drop("id"), "row").select("row", "label", "v", *[e.alias(c) for c, e in full.items()])
        far = _meet(queries, shelves, count, blocks, negatives, False)
        met = far.select("row", F.col("rank"), "place", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")).join(pairs, "row")
        positive = F.element_at("positive", F.col("place") + 1)
        met.select(
            F.col("id").alias("anchor_id"), positive["id"].alias("positive_id"), F.col("rank").cast("int").alias("rank"), "negative_id",
            positive["score"].alias("positive_score"), "negative_score",
        ).write.parquet(path)
    return spark.read.parquet(path)
