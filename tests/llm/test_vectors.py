import io
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbcount.llm import hard_negatives, vector_codes
from curbcount.llm.exact_gemm import exact_dot, floored, limb_bits, limbs

ROWS = "vec_id bigint, embedding array<float>, label int, `my col` string, `a.b` int, v int, id int"


def row(i, vector, label):
    return (i, vector, label, "x", 1, 2, 3)


def vectors(count, width=32, seed=1, groups=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(count, width)) / math.sqrt(width)
    if groups:
        x = x * 0.05 + rng.normal(size=(groups, width))[rng.integers(0, groups, count)] / math.sqrt(width)
    return x.astype(np.float32).tolist()


def edge_rows(width=32):
    bad = [None, [None] * width, [float("nan")] * width, [float("inf")] + [0.0] * (width - 1), [0.5] * (width - 1) + [None]]
    return [row(900 + k, b, 1) for k, b in enumerate(bad)]


def whole(rows):
    """(row, integers) of the rows that take part."""
    out = []
    for r in rows:
        if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1]):
            out.append((r, [math.floor(256 * x) for x in r[1]]))
    return out


# ---------------------------------------------------------------- exact products


@pytest.mark.parametrize("size", [1, 1 << 10, 1 << 27, 1 << 29])
def test_products_are_exact(size):
    rng = np.random.default_rng(size)
    a, b = rng.integers(-size, size + 1, (3, 7, 5)), rng.integers(-size, size + 1, (3, 5, 4))
    want = np.einsum("pij,pjk->pik", a.astype(object), b.astype(object))
    assert (exact_dot(a, b) == want).all()


def test_limbs_stay_exact_in_float64():
    bits = limb_bits(64)
    assert 64 * 4**bits <= 1 << 53
    values = np.array([-(1 << 40), -1, 0, 1, (1 << 40) + 12345])
    parts = limbs(values, bits)
    assert sum(p.astype(object) * 2 ** (bits * k) for k, p in enumerate(parts)).tolist() == values.tolist()


def test_products_beyond_64_bits_are_an_error():
    big = np.array([[1 << 40]])
    with pytest.raises(OverflowError):
        exact_dot(big, big)
    with pytest.raises(OverflowError):
        floored(np.array([1e30]), 256, 1 << 30)


# ---------------------------------------------------------------- 11 vector codes


def codes_by_hand(rows, parts=16, entries=64, rounds=2):
    kept = whole(rows)
    wide = -(-max(len(v) for _, v in kept) // parts)
    full = [v + [0] * (parts * wide - len(v)) for _, v in kept]
    pieces = [[tuple(v[p * wide : (p + 1) * wide]) for p in range(parts)] for v in full]
    ids = [r[0] for r, _ in kept]
    order = sorted(set(ids), key=lambda i: (i is None, i or 0))[:entries]
    first = [min((r[1], p) for (r, _), p in zip(kept, pieces) if r[0] == i)[1] for i in order]
    books = [[f[p] for f in first] for p in range(parts)]

    def near(piece, book):
        return min((sum((a - b) ** 2 for a, b in zip(piece, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for piece in pieces:
                own.setdefault(near(piece[p], books[p])[1], []).append(piece[p])
            books[p] = [tuple(sum(x) // len(own[e]) for x in zip(*own[e])) if e in own else c for e, c in enumerate(books[p])]
    coded = []
    for (r, _), piece in zip(kept, pieces):
        found = [near(piece[p], books[p]) for p in range(parts)]
        coded.append((r[0], "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), r[2]))
    errors = {}
    for _, _, error, label in coded:
        errors[label] = errors.get(label, 0) + error
    return sorted((str((i, c, e)), errors[label]) for i, c, e, label in coded), [x for book in books for c in book for x in c]


def codes(spark, rows):
    coded, books = vector_codes.compress(spark.createDataFrame(rows, ROWS).repartition(3))
    found = vector_codes.with_label_error(coded).collect()
    return sorted((str((r.vec_id, r.code, r.error)), r.label_error) for r in found), books.ravel().tolist()


def code_cases():
    plain = [row(i, v, i % 3) for i, v in enumerate(vectors(200))]
    hot = [row(i, plain[7][1], 1) for i in range(300, 400)]
    return {
        "plain": plain + edge_rows(),
        "few": plain[:5],
        "hot": plain + hot,
        "repeated": plain[:70] + plain[:70] + [row(3, plain[100][1], None), row(None, plain[101][1], None), row(None, plain[102][1], None)],
        "ties": [row(i, [0.25] * 32, None) for i in range(80)],
        "lengths": [row(1, [0.5, 1.0], 1), row(2, [], 1), row(3, [0.25] * 17, 2)],
        "large": [row(i, (np.float32(1000) * np.array(v, np.float32)).tolist(), 1) for i, v in enumerate(vectors(70, 16, 5))],
    }


@pytest.mark.parametrize("case", list(code_cases()))
def test_codes_equal_brute_force(spark, case):
    rows = code_cases()[case]
    assert codes(spark, rows) == codes_by_hand(rows)


def test_codes_of_nothing(spark):
    assert codes(spark, []) == ([], [])
    assert codes(spark, edge_rows()) == ([], [])


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="64 bits"):
        codes(spark, [row(1, [1e30] * 16, 1)])


# ---------------------------------------------------------------- 12 hard negatives


def mined_by_hand(rows):
    kept = [(r[0], r[2], v) for r, v in whole(rows) if r[0] is not None and r[2] is not None]
    width = max((len(v) for _, _, v in kept), default=0)
    out = []
    for k, (anchor, label, v) in enumerate(kept):
        if anchor % 100:
            continue
        score = [(-sum(a * b for a, b in zip(v, w)), i, n) for n, (i, _, w) in enumerate(kept)]
        same = sorted(s for s in score if kept[s[2]][1] == label and s[2] != k)[:5]
        other = sorted(s for s in score if kept[s[2]][1] != label)
        for minus, positive, _ in same:
            fits = [s for s in other if 30 * -minus <= 100 * -s[0] <= 90 * -minus][:10]
            out += [(anchor, positive, rank + 1, i, -minus, -s) for rank, (s, i, _) in enumerate(fits)]
    assert width or not out
    return sorted(out)


def mine(spark, rows):
    found = hard_negatives.mine(spark.createDataFrame(rows, ROWS).repartition(3), F.col("vec_id") % 100 == 0)
    return sorted(tuple(r) for r in found.collect())


def mine_cases():
    plain = [row(i, v, i % 4) for i, v in enumerate(vectors(900))]
    near = [row(i, v, i % 2) for i, v in enumerate(vectors(900, seed=2, groups=6))]
    return {
        "plain": plain + edge_rows() + [row(None, plain[0][1], 1), row(50, plain[0][1], None)],
        "grouped": near,
        "hot": plain[:300] + [row(1000 + i, plain[200][1], 0) for i in range(400)],
        "repeated": plain[:150] + plain[:150] + plain[:1],
        "zero": [row(i, [0.0] * 4, i % 2) for i in range(30)],
        "negative": [row(0, [1.0, 0.0], 1), row(1, [-1.0, 0.0], 1), row(2, [-0.5, 0.1], 2), row(3, [0.5, 0.0], 2)],
        "one label": [row(i, v, 1) for i, v in enumerate(vectors(20))],
        "lengths": [row(0, [1.0, 0.5], 1), row(1, [1.0], 1), row(2, [], 2), row(3, [0.5, 0.25, 9.0], 2)],
        "one row": plain[:1],
    }


@pytest.mark.parametrize("shelf_bytes", [32 << 20, 1 << 14])
@pytest.mark.parametrize("case", list(mine_cases()))
def test_negatives_equal_brute_force(spark, monkeypatch, case, shelf_bytes):
    monkeypatch.setattr(hard_negatives, "SHELF_BYTES", shelf_bytes)
    if shelf_bytes < 1 << 20:
        monkeypatch.setattr(hard_negatives, "BLOCK", 3)
    rows = mine_cases()[case]
    assert mine(spark, rows) == mined_by_hand(rows)


def test_negatives_of_nothing(spark):
    assert mine(spark, []) == [] and mine(spark, edge_rows()) == []


def test_nodes_cover_what_is_below_and_centres_stand_apart(monkeypatch):
    monkeypatch.setattr(hard_negatives, "LEAF", 8)
    points = np.array(vectors(600, 8, 3, groups=5), np.float64)
    tree = hard_negatives.CoverTree(points, np.arange(600))

    def below(node):
        return set(tree.rows[node].tolist()).union(*(below(b) for b in tree.below[node]))

    assert below(0) == set(range(600))
    for node, centre in enumerate(tree.centre):
        rows = sorted(below(node))
        gaps = np.linalg.norm(points[rows] - points[centre], axis=1)
        assert centre in rows and gaps.max() <= tree.radius[node] * (1 + 1e-9)
        centres = [tree.centre[b] for b in tree.below[node]]
        # farthest first: no two centres are nearer to each other than a point is to its own
        worst = max((tree.radius[b] for b in tree.below[node]), default=0)
        assert all(np.linalg.norm(points[a] - points[b]) >= worst * (1 - 1e-9) for k, a in enumerate(centres) for b in centres[:k])


def test_a_descent_skips_far_nodes(monkeypatch):
    """Rows in narrow groups: most are never scored."""
    x = np.floor(256 * np.array(vectors(6000, 16, 4, groups=40))).astype(np.int64)
    shelf = {k: v for k, v in np.load(io.BytesIO(hard_negatives.shelve(np.arange(6000), np.arange(6000), ["a"] * 6000, x))).items()}
    scored = []
    monkeypatch.setattr(hard_negatives, "exact_dot", lambda a, b: scored.append(a.shape[0] * b.shape[1]) or a @ b)
    best = hard_negatives.Best(1, 1, 5)
    ends = np.array([[-(1 << 62)]]), np.array([[1 << 62]])
    hard_negatives.search(shelf, best, x[:1], np.array(["a"]), np.array([0]), *ends, True)
    best.merge()
    want = sorted((-int(s), i) for i, s in enumerate(x @ x[0]) if i)[:5]
    assert [(-s, i) for s, i in zip(best.held[1].tolist(), best.held[2].tolist())] == want
    assert sum(scored) < 2500
