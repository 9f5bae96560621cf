"""Exact, near and substring duplicates against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from curbcount.llm import exact_dedup, simhash, substrings
from curbcount.llm.components import components
from tests.llm.conftest import PASSAGE, base_rows

SPACES = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def collected(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


# ---------------------------------------------------------------- exact


def brute_exact(rows):
    groups = defaultdict(list)
    for n, (i, t, *_) in enumerate(rows):
        groups[SPACES.sub("", t or "")].append((-len(t or ""), i is None, i, n))
    out = []
    for body, members in groups.items():
        best = min(members, key=lambda m: (m[0], m[1], m[2] if m[2] is not None else 0))
        sha = hashlib.sha256(body.encode()).hexdigest()
        out += [(i, best[2], len(members), sha) for _, _, i, _ in members]
    return sorted(out, key=repr)


def test_exact_groups_equal_brute_force(docs):
    rows = exact_dedup.exact_groups(docs).collect()
    assert sorted(((r[0], r[1], r[2], r[4]) for r in rows), key=repr) == brute_exact(base_rows())
    # one row of each group stays, even where a row is repeated
    assert sum(r.kept for r in rows) == len({r.text_sha256 for r in rows})


def test_exact_drop_keeps_whole_rows_and_columns(docs):
    left = exact_dedup.drop_exact(docs)
    assert left.columns == docs.columns
    bodies = [SPACES.sub("", r.text or "") for r in left.collect()]
    assert len(bodies) == len(set(bodies)) == len({SPACES.sub("", r[1] or "") for r in base_rows()})


def test_exact_empty(none):
    assert exact_dedup.exact_groups(none).count() == 0 and exact_dedup.drop_exact(none).columns == none.columns


def test_grace_spills_and_compares_contents(tmp_path, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BUCKET_BYTES", 4000)
    rng = random.Random(1)
    bodies = [str(rng.randrange(400)).encode() * 9 for _ in range(3000)] + [b"hot"] * 5000
    records = [(n, xxhash.xxh3_64_intdigest(b), b) for n, b in enumerate(bodies)]
    first, found = {}, dict(exact_dedup._classes(iter(records), tmp_path, 0))
    for n, b in enumerate(bodies):
        first.setdefault(b, n)
    assert len(found) == len(bodies) and all(found[n] == found[first[b]] for n, b in enumerate(bodies))
    assert len({found[n] for n in first.values()}) == len(first)
    assert not [p for p in tmp_path.rglob("*") if p.is_file()]


def test_equal_hashes_do_not_make_equal_contents():
    table = exact_dedup.ContentTable(slots=4)
    assert [table.place(b, 5) for b in (b"a", b"b", b"a", b"c", b"b")] == [(0, True), (1, True), (0, False), (2, True), (1, False)]


# ---------------------------------------------------------------- near


def brute_print(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    prints = [brute_print(t) for _, t, *_ in rows]
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if bin(prints[a] ^ prints[b]).count("1") <= 3:
                old, new = root[a], root[b]
                root = [new if r == old else r for r in root]
    least = defaultdict(list)
    for n, (i, *_) in enumerate(rows):
        least[root[n]].append(i)
    pick = {k: min((i for i in v if i is not None), default=None) for k, v in least.items()}
    return sorted(((r[0], f"{prints[n]:016x}", pick[root[n]]) for n, r in enumerate(rows)), key=repr)


def test_near_groups_equal_brute_force(docs):
    assert collected(simhash.near_groups(docs)) == brute_components(base_rows())


def test_near_drop_keeps_one_of_each(docs, none):
    left = simhash.drop_near(docs)
    assert left.columns == docs.columns
    assert left.count() == len({c for _, _, c in brute_components(base_rows())})
    assert simhash.near_groups(none).count() == 0 and simhash.drop_near(none).count() == 0


def test_fingerprints_of_long_texts_are_counted_in_parts(monkeypatch):
    text = " ".join(f"a{i % 41} B{i % 7}" for i in range(500))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_VOTES", 16)
    assert whole == simhash.fingerprint(text) == brute_print(text)


def test_links_with_fine_buckets(spark):
    rng = random.Random(2)
    prints = set()
    for _ in range(3):
        centre = rng.getrandbits(64)
        for _ in range(150):
            own = centre
            for _ in range(rng.randint(0, 5)):
                own ^= 1 << rng.randrange(64)
            prints.add(own)
    prints = [int(np.uint64(p).astype(np.int64)) for p in prints]
    frame = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    wanted = {(min(a, b), max(a, b)) for k, a in enumerate(prints) for b in prints[:k] if bin((a ^ b) & (2**64 - 1)).count("1") <= 3}
    for fine in (2048, 4):
        assert {tuple(r) for r in simhash.links(frame, fine).collect()} == wanted


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 200 + i) for i in range(20)] + [(7, 7), (300, 299), (299, 300)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(31)}, 100: 100, **{200 + i: 100 for i in range(20)}, 299: 299, 300: 299}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# ---------------------------------------------------------------- substrings


def brute_substrings(rows, window=13):
    words = [WORD.findall(t or "") for _, t, *_ in rows]
    least = {}
    for (i, *_), w in zip(rows, words):
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k : k + window])
                least[key] = min(i, least.get(key, i))
    out = []
    for (i, *_), w in zip(rows, words):
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and least[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        left = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(left.encode()).hexdigest(), left))
    return sorted(out, key=repr)


def test_substrings_equal_brute_force(docs, none):
    assert collected(substrings.remove_repeats(docs)) == brute_substrings(base_rows())
    assert substrings.remove_repeats(none).count() == 0


def test_substrings_over_many_slices(spark, monkeypatch):
    rng = random.Random(4)
    pool = [" ".join(str(rng.randrange(50)) for _ in range(rng.randrange(10, 40))) for _ in range(30)]
    rows = [(n, " ".join(rng.choice(pool) for _ in range(rng.randrange(1, 5))) if n % 3 else " ".join(str(rng.randrange(3)) for _ in range(60))) for n in range(150)]
    rows += [(5, PASSAGE), (9, PASSAGE), (9, PASSAGE)]
    monkeypatch.setattr(substrings, "SLICE_BYTES", 1500)
    for window in (13, 4):
        assert collected(substrings.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), window=window)) == brute_substrings(rows, window)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\té", max_size=30).map(str.encode), max_size=6))
def test_word_hashes_follow_the_words(bodies):
    words = substrings.Words(bodies)
    plain = [w for b in bodies for w in re.findall(rb"[^\x20\x09-\x0D]+", b)]
    assert len(plain) == len(words.hashes[0])
    by_hash = defaultdict(set)
    for w, h in zip(plain, words.hashes[0].tolist()):
        by_hash[h].add(w)
    assert all(len(v) == 1 for v in by_hash.values()) and len(by_hash) == len(set(plain))


def test_rows_sent_are_no_more_than_hashes_however_many_buckets():
    rng = random.Random(5)
    bodies = [" ".join(f"w{rng.randrange(400)}" for _ in range(300)).encode() for _ in range(20)]
    few, many = (substrings.Slice(list(range(20)), bodies, 13, buckets) for buckets in (4, 1_000_000))
    assert len(list(few.anchors(0))) == 4
    sent = list(many.anchors(0))
    assert len(sent) <= len(many.key) and sum(r[2] for r in sent) == len(many.key)
    many.extend({})
    assert len(list(many.full_windows(0))) <= len(many.full[0])


def test_rows_of_one_id_or_none_are_spread(spark):
    passage = " ".join(f"p{k}" for k in range(20))
    rows = [(7, f"{passage} tail {i}") for i in range(60)] + [(None, f"{passage}") for _ in range(60)] + [(8, f"head {passage}"), (3, passage)]
    found = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
    assert sorted({(r["doc_id"], r["n_removed"]) for r in found}, key=str) == [(3, 0), (7, 20), (8, 20), (None, 0)]
    assert len(found) == len(rows)
