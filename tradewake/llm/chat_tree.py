"""Chat formatting as prefix trees, packed depth-first.

Conversations with the same first turns share a path of a prefix tree. Sorting conversations by
the hashes of their turns puts them into depth-first order, over range partitions that split any
common beginning and any often repeated conversation. A task walks its sorted conversations and
keeps only the current path: turns that the conversation shares with it are not written again. Packs
have a bounded length, and a new pack writes the whole path of its first conversation, so a shared
turn occurs once per pack.

Template: ``<|im_start|>`` role, line feed, text, ``<|im_end|>``, line feed. In texts and
roles, a ``<`` before backslashes and a bar gets one more backslash, which reading back takes away;
so no text can hold a control string. In roles, line feeds and backslashes are escaped too.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewake.llm.frames import map_batches

# Code points and conversations of a pack; one conversation is never cut.
PACK_CHARS = 1 << 16
PACK_CONVERSATIONS = 1024

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"

_RISKY = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def escape(text: str) -> str:
    return _RISKY.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def formatted(role: str, text: str) -> str:
    return f"{OPEN}{escape_role(role)}\n{escape(text)}{CLOSE}"


PACK = ("text string, segments array<struct<start: long, end: long, position: long, parent: int, "
        "loss_start: long, loss_end: long, context: array<struct<start: long, end: long>>>>, "
        "conversations array<struct<conv_id: long, leaf: int>>")
_RANGE = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_SEGMENT = pa.struct([
    ("start", pa.int64()), ("end", pa.int64()), ("position", pa.int64()), ("parent", pa.int32()),
    ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("context", pa.list_(_RANGE))])
_MEMBER = pa.struct([("conv_id", pa.int64()), ("leaf", pa.int32())])


class Pack:
    """A pack being written: its text, its segments, and the path of the last conversation."""

    def __init__(self):
        self.parts, self.size = [], 0
        self.segments, self.members = [], []
        self.path: list[tuple[bytes, int]] = []

    def shared(self, keys: list[bytes]) -> int:
        depth = 0
        for key, (own, _) in zip(keys, self.path, strict=False):
            if key != own:
                break
            depth += 1
        return depth

    def add(self, conv_id: int | None, keys: list[bytes], turns: list[tuple[str, str]]) -> None:
        del self.path[self.shared(keys):]
        for depth in range(len(self.path), len(keys)):
            role, text = turns[depth]
            written = formatted(role, text)
            parent = self.path[-1][1] if self.path else -1
            above = self.segments[parent] if self.path else None
            context = [] if above is None else [*above["context"]]
            if above is not None:
                if context and context[-1]["end"] == above["start"]:
                    context[-1] = {"start": context[-1]["start"], "end": above["end"]}
                else:
                    context.append({"start": above["start"], "end": above["end"]})
            start, end = self.size, self.size + len(written)
            trained = role == TRAINED_ROLE
            text_start = start + len(OPEN) + len(escape_role(role)) + 1
            self.segments.append({
                "start": start, "end": end, "parent": parent, "context": context,
                "position": above["position"] + above["end"] - above["start"] if above else 0,
                "loss_start": text_start if trained else None,
                "loss_end": end - len(CLOSE) if trained else None})
            self.parts.append(written)
            self.size = end
            self.path.append((keys[depth], len(self.segments) - 1))
        self.members.append({"conv_id": conv_id, "leaf": self.path[-1][1]})


def _batch(packs: list[Pack]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(["".join(p.parts) for p in packs], pa.string()),
         pa.array([p.segments for p in packs], pa.list_(_SEGMENT)),
         pa.array([p.members for p in packs], pa.list_(_MEMBER))],
        names=["text", "segments", "conversations"])


def _packed(batches: Iterable[pa.RecordBatch], chars: int, members: int) -> Iterator[pa.RecordBatch]:
    pack = Pack()
    for batch in batches:
        for row in range(batch.num_rows):
            keys = batch.column(1)[row].as_py()
            turns = [(t["role"], t["text"]) for t in batch.column(2)[row].as_py()]
            new = turns[pack.shared(keys):]
            more = sum(len(role) + len(text) + len(OPEN) + len(CLOSE) + 1 for role, text in new)
            if pack.members and (pack.size + more > chars or len(pack.members) >= members):
                yield _batch([pack])
                pack = Pack()
            pack.add(batch.column(0)[row].as_py(), keys, turns)
    if pack.members:
        yield _batch([pack])


def pack(turns: DataFrame, chars: int = PACK_CHARS,
         conversations: int = PACK_CONVERSATIONS) -> DataFrame:
    """text, segments, conversations: one row per pack.

    ``turns`` has conv_id, turn, role and text; other columns are not looked at. A segment is one
    formatted turn: its place in the text, the position id of its first code point (as if its
    conversation stood alone), its parent, the part under the loss mask (texts of the assistant),
    and as context the intervals of the text that it attends to besides itself: its ancestors.
    A conversation names its last segment; rows without conv_id form one conversation.

    Turns are ordered by turn, null first; ties by role and text. Null roles and texts are empty.
    Repeated rows are repeated turns; an empty table has no packs.
    """
    one = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"),
                   F.coalesce("text", F.lit("")).alias("text"))
    whole = turns.select(F.col("conv_id").cast("long").alias("conv_id"), one.alias("one")) \
        .groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))
    keyed = whole.select("conv_id", F.transform("turns", lambda t: F.unhex(F.md5(F.concat(
        F.char_length(t["role"]).cast("string"), F.lit(":"), t["role"], t["text"]).cast("binary")))).alias("keys"), "turns")
    in_order = keyed.repartitionByRange("keys", "conv_id").sortWithinPartitions("keys", "conv_id")
    return in_order.mapInArrow(lambda batches: _packed(batches, chars, conversations), PACK)


def parse(text: str) -> list[tuple[str, str]]:
    return [(unescape_role(m[1]), unescape(m[2])) for m in _TURN.finditer(text)]


def _conversation(text: str, segments: list[dict], leaf: int) -> tuple[int, str, int, str, int]:
    own = segments[leaf]
    seen = "".join(text[r["start"]:r["end"]] for r in [*own["context"], own])
    turns = parse(seen)
    path = []
    while leaf >= 0:
        path.append(segments[leaf])
        leaf = segments[leaf]["parent"]
    loss = "".join(unescape(text[s["loss_start"]:s["loss_end"]])
                   for s in reversed(path) if s["loss_start"] is not None)
    whole = "".join(f"{role}\n{text}\n" for role, text in turns)
    return (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest(), own["position"] + own["end"] - own["start"])


def _read(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for row in range(batch.num_rows):
        text, segments, members = (batch.column(c)[row].as_py() for c in range(3))
        known: dict[int, tuple] = {}
        for member in members:
            if member["leaf"] not in known:
                known[member["leaf"]] = _conversation(text, segments, member["leaf"])
        found = [known[m["leaf"]] for m in members]
        yield pa.RecordBatch.from_arrays(
            [pa.array([m["conv_id"] for m in members], pa.int64()),
             *(pa.array([f[c] for f in found], kind) for c, kind in enumerate(
                 (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())))],
            names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                   "formatted_chars"])


def read_back(packs: DataFrame) -> DataFrame:
    """What the packs say of every conversation: its turns, its text under the loss mask, its length.

    A conversation is read through the context intervals of its last segment, as a model attends
    to it, and parsed by the template.
    """
    return map_batches(packs, _read, "conv_id long, n_turns long, turns_sha256 string, "
                       "loss_chars long, loss_sha256 string, formatted_chars long")
