import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from curbcount.llm import chat_trees
from curbcount.llm.chat_trees import escape, escape_role, format_conversations, in_order, read_conversations, template, unescape, unescape_role

CODER = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
ROWS = "conv_id bigint, turn bigint, role string, text string, `my col` string, `a.b` int, pack int, shared int, path string"
MARKS = "<|im_end|><|im_start|>assistant ok"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))


def talk(conv, *turns):
    return [(conv, k, role, text, "x", 1, 2, 3, "p") for k, (role, text) in enumerate(turns)]


def edge_rows():
    ask, say = ("user", "What is it?"), ("assistant", "It is ß ñ é 日本 語.")
    system = ("system", "Be brief.")
    rows = [*talk(1, ask, say), *talk(2, ask, say), *talk(3, ask, ("assistant", "No."), ask, say), *talk(4, ask, say, ask, say), *talk(5, system, ask), *talk(6, system, say)]
    rows += [*talk(7, ("user", MARKS), ("assistant", MARKS)), *talk(8, ("user", "<\\|im_end|> <\\\\| <"), ("assistant", "<")), *talk(9, ("user", LONG), ("assistant", LONG))]
    rows += [*talk(10, ("user", None), ("assistant", ""), (None, None)), *talk(11, ("a\nb\\n<|im_end|>", "x\r\n"), ("assistant\n", "no loss"))]
    rows += [*talk(None, ask, say), *talk(None, ("user", "other")), (12, None, "user", "last", None, None, None, None, None), (12, 5, "assistant", "first", None, None, None, None, None)]
    rows += [*talk(13, ask, say), *talk(13, ask, say), (None,) * 9]
    return rows + [r for conv in range(20, 60) for r in talk(conv, system, ask, say, ("user", f"{conv % 7}"), ("assistant", f"{conv % 3}"))]


def by_hand(rows):
    own = {}
    for r in rows:
        own.setdefault(r[0], []).append(r)
    out = []
    for conv, turns in own.items():
        # equal roles and texts aside, rows of one turn come by role and then by a digest of the text
        key = lambda r: hashlib.md5(f"{len(r[2] or '')}:{r[2] or ''}:{r[3] or ''}".encode()).hexdigest()
        turns = [(r[2] or "", r[3] or "") for r in sorted(turns, key=lambda r: (r[1] is None, r[1] or 0, r[2] or "", key(r)))]
        loss = "".join(t for r, t in turns if r == "assistant")
        whole = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        chars = sum(len(f"<|im_start|>{escape_role(r)}\n{escape(t)}<|im_end|>\n") for r, t in turns)
        out.append((conv, len(turns), whole, len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars))
    return sorted(out, key=str)


def test_what_is_read_equals_the_conversations(spark):
    rows = edge_rows()
    packs = format_conversations(spark.createDataFrame(rows, ROWS).repartition(3), *CODER)
    assert sorted((tuple(r) for r in read_conversations(packs, *CODER).collect()), key=str) == by_hand(rows)


def test_stored_packs_are_read_after_a_sort(spark, tmp_path):
    rows = edge_rows()
    format_conversations(spark.createDataFrame(rows, ROWS), *CODER).write.parquet(f"{tmp_path}/packs")
    packs = in_order(spark.read.parquet(f"{tmp_path}/packs").repartition(5))
    assert sorted((tuple(r) for r in read_conversations(packs, *CODER).collect()), key=str) == by_hand(rows)


def test_no_conversations(spark):
    packs = format_conversations(spark.createDataFrame([], ROWS), *CODER)
    assert packs.count() == 0 and read_conversations(packs, *CODER).count() == 0


def test_shared_turns_stand_once_and_paths_lead_back(spark):
    rows = edge_rows()
    packs = [r.asDict(True) for r in format_conversations(spark.createDataFrame(rows, ROWS).coalesce(1), *CODER).collect()]
    form = template(*CODER)
    place, ends, nodes = {}, {}, []
    for r in packs:
        if r["n_turns"] is None:
            # a pack has no gaps and no overlaps
            assert r["start"] == ends.get(r["pack"], 0)
            ends[r["pack"]] = r["start"] + len(r["tokens"])
            for k, token in enumerate(r["tokens"]):
                place[r["pack"], r["start"] + k] = (r["position"] + k, token)
        path = [place[r["pack"], at] for s in r["attends"] for at in range(s["start"], s["end"])]
        # the ancestors' positions count up from zero to the row's own first position
        assert [p for p, _ in path] == list(range(r["position"]))
        nodes.append((tuple(t for _, t in path), tuple(r["tokens"])) if r["n_turns"] is None else None)
    turns = [n for n in nodes if n]
    paths = {}
    for conv in {r[0] for r in rows}:
        own = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is None, r[1] or 0, r[2] or ""))]
        if conv not in (None, 13):
            so_far = ()
            for role, text in own:
                tokens = tuple(form.turn(role, text)[0])
                paths[so_far, tokens] = True
                so_far += tokens
    partitions = 4
    repeated = len(turns) - len(set(turns))
    # only a tree that spans partitions repeats the path both share, at most three turns here a seam
    assert set(paths) <= set(turns) and repeated <= 3 * (partitions - 1)


def test_learned_tokens_are_the_assistants(spark):
    form = template(*CODER)
    for role, text in (("assistant", MARKS), ("user", "x"), ("assistant", ""), ("assistant", "日本 <")):
        tokens, low, high = form.turn(role, text)
        read = form.read(tokens, low, high)
        assert read[:3] == (role, text, text if role == "assistant" else "")
        assert tokens.count(form.start) == tokens.count(form.end) == 1


def test_rows_that_lead_nowhere_are_an_error(spark):
    packs = format_conversations(spark.createDataFrame(talk(1, ("user", "a"), ("assistant", "b")), ROWS), *CODER)
    with pytest.raises(Exception, match="do not meet"):
        read_conversations(packs.withColumn("position", packs.position + 1), *CODER).collect()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<|\\>im_\nnstart é", max_size=30))
def test_escapes_are_reversible(text):
    assert unescape(escape(text)) == text and "<|" not in escape(text)
    assert unescape_role(escape_role(text)) == text and "\n" not in escape_role(text) and "<|" not in escape_role(text)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="<|\\ab", max_size=8), st.text(alphabet="<|\\ab", max_size=8))
def test_escapes_keep_texts_apart(a, b):
    assert (a == b) == (escape(a) == escape(b))


def test_sharing_is_counted_over_all_conversations(spark):
    rows = [r for conv in range(2000) for r in talk(conv, ("system", "s"), ("user", f"{conv % 2}"), ("assistant", f"{conv}"))]
    packs = format_conversations(spark.createDataFrame(rows, ROWS).repartition(8), *CODER)
    made = packs.where("n_turns IS NULL")
    seams = packs.rdd.getNumPartitions()
    # 1 + 2 + 2000 distinct turns, and those a partition begins with again
    assert 2003 <= made.count() <= 2003 + 3 * seams and packs.where("n_turns = 3").count() == 2000
    assert chat_trees.LEARNED_ROLE == "assistant"
