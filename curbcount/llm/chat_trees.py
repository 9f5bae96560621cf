"""Chat formatting as prefix trees: turns that conversations share from the start are emitted once.

Conversations are sorted by the path of their turns, which is the depth-first order of the tree, and walked
through in that order: what a conversation shares with the one before stands already, the rest is emitted.
Every emitted turn has the position ids of its place on the path and, as intervals of the pack, the
ancestors its tokens attend to. So a pack is trained on like all its conversations one by one.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbcount.llm.common import columns, kept, schema_of, slices
from curbcount.operators.lookup import lookup_join
from curbcount.session import materialise, new_path, scratch

START, END = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"

_MARK, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<(\\*)\\\|")


def escape(text: str) -> str:
    """No control string is left: one more backslash between ``<`` and ``|``, however many there are."""
    return _MARK.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role also ends with its line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Template:
    """Turns to tokens and back; control strings are tokens beyond the vocabulary, which text never gives."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.start, self.end = len(ranks), len(ranks) + 1
        self.coder = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={START: self.start, END: self.end})
        self.heads: dict[str, list[int]] = {}
        self.tail = [self.end, *self.coder.encode_ordinary("\n")]

    def turn(self, role: str, text: str) -> tuple[list[int], int, int]:
        """Tokens, and the stretch of them under the loss mask (empty but for the learned role)."""
        if role not in self.heads:
            if len(self.heads) > 1000:
                self.heads.clear()
            self.heads[role] = [self.start, *self.coder.encode_ordinary(escape_role(role) + "\n")]
        head, body = self.heads[role], self.coder.encode_ordinary(escape(text))
        learned = len(body) if role == LEARNED_ROLE else 0
        return head + body + self.tail, len(head), len(head) + learned

    def read(self, tokens: list[int], low: int, high: int) -> tuple[str, str, str, int]:
        """(role, text, text under the mask, code points of the formatted turn)."""
        whole = self.coder.decode_bytes(tokens).decode()
        if tokens[0] != self.start or not whole.endswith(END + "\n"):
            raise ValueError("not a turn of this template")
        role, _, text = whole[len(START) : -len(END) - 1].partition("\n")
        return unescape_role(role), unescape(text), unescape(self.coder.decode_bytes(tokens[low:high]).decode()), len(whole)


def template(path: str, pattern: str) -> Template:
    return kept(("chat", path, pattern), lambda: Template(path, pattern))


class Level(NamedTuple):
    """A turn on the current path: its content, where it ends in the pack and on the path, and the intervals
    of the path down to it, as (earlier ones, start, end)."""

    role: str
    text: str
    end: int
    position: int
    spans: tuple


def _join(spans: tuple | None, start: int, end: int) -> tuple:
    return (spans[0], spans[1], end) if spans and spans[2] == start else (spans, start, end)


def _listed(spans: tuple | None) -> list[dict]:
    out = []
    while spans:
        spans, start, end = spans
        out.append({"start": start, "end": end})
    return out[::-1]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_COLUMNS = (
    "pack bigint, start bigint, position bigint, tokens array<int>, loss_from int, loss_to int, "
    "attends array<struct<start:bigint,end:bigint>>, shared boolean, n_turns bigint"
)
_NAMES = ["conv", "pack", "start", "position", "tokens", "loss_from", "loss_to", "attends", "shared", "n_turns"]


def _ordered() -> list:
    return ["conv", F.col("turn").asc_nulls_last(), "role", "digest"]


def _paths(rows: DataFrame) -> DataFrame:
    """(conv, depth, digest, node): every turn's digest and the digest of the path down to it, no texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, depth, node = object(), 0, b""
        for batch in batches:
            depths, nodes = [], []
            for conv, digest in zip(batch["conv"].to_pylist(), batch["digest"].to_pylist()):
                if conv != last:
                    last, depth, node = conv, 0, b""
                node = hashlib.md5(node + digest.encode()).digest()
                depths.append(depth)
                nodes.append(node)
                depth += 1
            yield pa.record_batch([batch["conv"], pa.array(depths, pa.int64()), batch["digest"], pa.array(nodes, pa.binary())], ["conv", "depth", "digest", "node"])

    short = rows.select("conv", "turn", "role", "digest").repartition("conv").sortWithinPartitions(*_ordered())
    return short.select("conv", "digest").mapInArrow(run, schema_of(rows, "conv", "depth bigint, digest string, node binary"))


def _keys(rows: DataFrame) -> DataFrame:
    """(conv, shared, path) of conversations that share turns: how many from the start, and their digests in a row."""
    out = new_path(rows.sparkSession, "path-keys")
    with scratch(rows.sparkSession):
        paths = materialise(_paths(rows), "paths")
        # a node of two conversations; those above it are nodes of both, too
        nodes = materialise(paths.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("node"), "nodes")
        met = lookup_join(paths, nodes, ["node"])
        digests = F.sort_array(F.collect_list(F.struct("depth", F.substring("digest", 1, 16).alias("d"))))
        keys = met.groupBy("conv").agg(F.count(F.lit(1)).alias("shared"), F.array_join(F.transform(digests, lambda x: x["d"]), "").alias("path"))
        keys.write.parquet(out)
    return rows.sparkSession.read.schema(keys.schema).parquet(out)


def format_conversations(
    rows: DataFrame, path: str, pattern: str, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Packs of conversations as rows in depth-first order, one a distinct turn and one an end of a conversation.

    A turn: ``pack``, ``start`` (its first token's place in the pack), ``position`` (that token's position id, the
    next ones count on), ``tokens``, ``loss_from`` and ``loss_to`` (its tokens under the loss mask), ``attends``
    (intervals of the pack that hold its ancestors; within the turn a token sees those before it), ``shared``
    (more than one conversation has it). An end has no tokens, the conversation's id and ``n_turns``; its
    ``attends`` are the intervals of the whole conversation and ``position`` is its length.

    Turns are in order of ``turn`` (null last), ties by role and text; a repeated row is another turn. Null
    texts and roles are empty. Rows without a conversation id are one conversation. Turns are shared
    if all roles and texts down to them are equal. No rows give no rows; very long texts are one row. A tree
    that does not fit one partition of the sorted conversations goes on in another pack, which begins with the path
    both share. A conversation is never cut or held as a whole: its turns pass one by one. Rows of a pack
    stand together and in order, as ``read_conversations`` expects them. Other columns are not read.
    """
    empty = F.lit("")
    given = columns(rows, conv=conv_col, turn=turn_col, role=role_col, text=text_col)
    given = given.withColumns({"role": F.coalesce("role", empty), "text": F.coalesce("text", empty)})
    given = given.withColumn("digest", F.md5(F.concat_ws(":", F.length("role"), "role", "text")))
    keys = _keys(given)
    at = given.alias("g").join(keys.alias("k"), F.col("g.conv").eqNullSafe(F.col("k.conv")), "left")
    at = at.select("g.*", F.coalesce("shared", F.lit(0)).alias("shared"), F.coalesce("path", empty).alias("path"))
    walked = at.repartitionByRange("path", "conv").sortWithinPartitions("path", *_ordered())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form = template(path, pattern)
        context = TaskContext.get()
        pack = (context.partitionId() if context else 0) << 33
        stack: list[Level] = []
        tip: Level | None = None
        conv, depth, offset, begun, same = None, 0, 0, False, True
        out: list[tuple] = []

        def end() -> None:
            out.append((conv, pack, offset, tip.position, [], 0, 0, _listed(tip.spans), False, depth))

        def emitted() -> pa.RecordBatch:
            cells = list(zip(*out)) or [()] * len(_NAMES)
            kinds = [conv_type, pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.int32(), _SPANS, pa.bool_(), pa.int64()]
            made = pa.record_batch([pa.array(c, k) for c, k in zip(cells, kinds)], _NAMES)
            out.clear()
            return made

        conv_type = pa.null()
        for batch in batches:
            conv_type = batch["conv"].type
            for part in slices([batch], "text", 4 << 20):
                for row_conv, role, text, shared in zip(*(part[c].to_pylist() for c in ("conv", "role", "text", "shared"))):
                    if not begun or row_conv != conv:
                        if begun:
                            end()
                        conv, depth, begun, same, tip = row_conv, 0, True, True, None
                    level = stack[depth] if same and depth < min(len(stack), shared) else None
                    if level and level.role == role and level.text == text:
                        tip = level
                    else:
                        same = False
                        del stack[depth:]
                        if depth == 0:
                            pack, offset = pack + 1, 0
                        tokens, low, high = form.turn(role, text)
                        spans, position = (tip.spans, tip.position) if tip else (None, 0)
                        out.append((None, pack, offset, position, tokens, low, high, _listed(spans), depth < shared, None))
                        more = offset + len(tokens)
                        # beyond the shared turns nobody compares contents again
                        body = (role, text) if depth < shared else ("", "")
                        tip = Level(*body, more, position + len(tokens), _join(spans, offset, more))
                        offset = more
                        if depth < shared:
                            stack.append(tip)
                    depth += 1
                yield emitted()
        if begun:
            end()
            yield emitted()

    made = walked.select("conv", "role", "text", "shared").mapInArrow(run, schema_of(given, "conv", _COLUMNS))
    return made.withColumnRenamed("conv", conv_col)


def in_order(packs: DataFrame) -> DataFrame:
    """Stored packs as they were made: every pack in one partition, ends before the turn that follows them, the
    end of a conversation's own turns before ends that lead further back."""
    back = F.element_at("attends", -1)["end"]
    return packs.repartition("pack").sortWithinPartitions("pack", "start", F.col("n_turns").isNull(), back.desc())


class _Read(NamedTuple):
    """What has been read down to a turn: its end in the pack, its path's length, turns, digests and counts."""

    end: int
    position: int
    turns: int
    whole: object
    loss: object
    loss_chars: int
    chars: int


def read_conversations(packs: DataFrame, path: str, pattern: str, conv_col: str = "conv_id") -> DataFrame:
    """One row per conversation, read from the tokens, masks, positions and intervals of its pack: id, n_turns,
    turns_sha256 (role, line end, text, line end of every turn), loss_chars, loss_sha256 (texts under the
    mask), formatted_chars.

    ``packs`` is what ``format_conversations`` gives, the rows of a pack together and in order; if it was stored in
    between, ``in_order`` of it. Digests are carried down the path, so a shared turn is read once. Intervals or positions that
    do not lead back to a turn read before raise ValueError. No rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form = template(path, pattern)
        pack, stack, tip = None, [], None
        for batch in batches:
            found, ids = [], []
            names = ("pack", "start", "position", "tokens", "loss_from", "loss_to", "attends", "shared", "n_turns")
            for k, (own, start, position, tokens, low, high, spans, shared, n_turns) in enumerate(zip(*(batch[c].to_pylist() for c in names))):
                if own != pack:
                    pack, stack, tip = own, [], None
                tip = _back(stack, tip, spans, position)
                if n_turns is not None:
                    if n_turns != tip.turns:
                        raise ValueError("a conversation's intervals do not hold its turns")
                    ids.append(k)
                    found.append((tip.turns, tip.whole.hexdigest(), tip.loss_chars, tip.loss.hexdigest(), tip.chars))
                    continue
                role, text, learned, chars = form.read(tokens, low, high)
                whole, loss = tip.whole.copy(), tip.loss.copy()
                whole.update(f"{role}\n{text}\n".encode())
                loss.update(learned.encode())
                tip = _Read(start + len(tokens), position + len(tokens), tip.turns + 1, whole, loss, tip.loss_chars + len(learned), tip.chars + chars)
                if shared:
                    stack.append(tip)
            cells = list(zip(*found)) or [()] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.record_batch([batch["conv"].take(pa.array(ids, pa.int64())), *(pa.array(c, t) for c, t in zip(cells, kinds))], ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    given = packs.withColumnRenamed(conv_col, "conv")
    kinds = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return given.mapInArrow(run, schema_of(given, "conv", kinds)).withColumnRenamed("conv", conv_col)


def _back(stack: list[_Read], tip: _Read | None, spans: list[dict], position: int) -> _Read:
    """The state at the end of the intervals; deeper turns leave the stack."""
    if not spans:
        stack.clear()
        return _Read(0, 0, 0, hashlib.sha256(), hashlib.sha256(), 0, 0)
    end = spans[-1]["end"]
    while stack and stack[-1].end > end:
        stack.pop()
    found = tip if tip and tip.end == end else stack[-1] if stack else None
    if not found or found.end != end or found.position != position or sum(s["end"] - s["start"] for s in spans) != position:
        raise ValueError("intervals and position of a row do not meet a turn before it")
    return found
