"""Chat formatting over a prefix tree of conversations.

Template.  A turn of the assistant is `{text}</s>`; any other turn is
`[INST] {role}` + newline + `{text} [/INST]`.  Control strings (`<s>`, `</s>`, `[INST]`, `[/INST]`)
inside roles and texts get a backslash behind their bracket, and those that have some already one
more, so the escape is undone exactly; newlines in a role are escaped alike.

Method.  Conversations become paths of turn digests (`turns`) and are dealt by range on
(path, conversation): conversations that share initial turns lie side by side, in the depth-first
order of their prefix tree.  A task merges them as they come: a turn that continues the previous
conversation's path is not written again, so a packed sequence holds every node's tokens once,
depth-first.  Each node has its place in the sequence, its parent, and the intervals its tokens
attend to: its ancestors' tokens (neighbouring intervals joined) and its own.  Position ids go on
from the parent's.  Texts, marks and tails are encoded apart, so a node's tokens do not depend on
its neighbours and the loss mask ends where the assistant's text does.

Scale.  Texts are shuffled twice: by conversation, and packed (zstd) by range.  A tree that exceeds
`PACK_CHARS` or `PACK_CONVS` goes on in a further sequence that repeats the shared path once, so a
first turn or whole conversation that a third of all rows share fills many sequences on many
tasks.  A conversation is one unit of work and never cut.

Defined cases.  Null texts and roles count as empty; null turns come first; rows of one turn are
ordered by role, then text; repeated rows are turns like others; rows without a conversation id
form one conversation of null id; an empty table gives no rows.  Extra columns are not read."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_maker
from .turns import WIDTH, path_of, turn_digest

#: A packed sequence goes on in a further one after this many characters or conversations.
PACK_CHARS = 200_000
PACK_CONVS = 5_000
#: Characters that are encoded at once and then given out.
BATCH_CHARS = 1_000_000

ASSISTANT = "assistant"
OPEN, BREAK, CLOSE, END = "[INST] ", "\n", " [/INST]", "</s>"

CONTROL = re.compile(r"([<\[])(\\*)(/?(?:s>|INST\]))")
ESCAPED = re.compile(r"([<\[])\\(\\*)(/?(?:s>|INST\]))")

PACKS = ("tokens array<int>, positions array<int>, loss array<boolean>, node_start array<int>, node_end array<int>, "
         "node_parent array<int>, attends array<array<int>>, conv_ids array<long>, conv_nodes array<int>")
READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(text: str) -> str:
    return CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text)


def escape_role(role: str) -> str:
    r"""Also newlines, which end a role: `\` becomes `\\` and a newline `\n`."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\([\\n])", lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


def pieces(role: str, text: str) -> tuple[str, str, str]:
    """Head, text and tail of a formatted turn."""
    if role == ASSISTANT:
        return "", escape(text), END
    return OPEN + escape_role(role) + BREAK, escape(text), CLOSE


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns `(role, text)` of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        if formatted.startswith(OPEN, at):
            line = formatted.index(BREAK, at)
            close = formatted.index(CLOSE, line + 1)
            turns.append((unescape_role(formatted[at + len(OPEN):line]), unescape(formatted[line + 1:close])))
            at = close + len(CLOSE)
        else:
            close = formatted.index(END, at)
            turns.append((ASSISTANT, unescape(formatted[at:close])))
            at = close + len(END)
    return turns


@dataclass
class Pack:
    """A sequence being built: nodes `(parent, pieces, is loss)` in depth-first order, conversations `(id, node)`."""
    nodes: list[tuple[int, tuple[str, str, str], bool]] = field(default_factory=list)
    convs: list[tuple[int | None, int]] = field(default_factory=list)
    chars: int = 0
    path: str = ""
    stack: list[int] = field(default_factory=list)

    def shared(self, path: str) -> int:
        """Turns that `path` has in common with the last conversation's."""
        n = min(len(path), len(self.path)) // WIDTH
        for d in range(n):
            if path[d * WIDTH:(d + 1) * WIDTH] != self.path[d * WIDTH:(d + 1) * WIDTH]:
                return d
        return n

    def add(self, conv_id: int | None, path: str, turns: list[list[str]], same: int) -> None:
        del self.stack[same:]
        for role, text in turns[same:]:
            parts = pieces(role, text)
            self.nodes.append((self.stack[-1] if self.stack else -1, parts, role == ASSISTANT))
            self.stack.append(len(self.nodes) - 1)
            self.chars += sum(map(len, parts))
        self.path = path
        self.convs.append((conv_id, self.stack[-1]))


def merged(intervals: list[int], start: int, end: int) -> list[int]:
    """Flat intervals [s0, e0, s1, e1, ..] with [start, end) added behind them; neighbours are joined."""
    if intervals and intervals[-1] == start:
        return [*intervals[:-1], end]
    return [*intervals, start, end]


def packed_rows(packs: list[Pack], encode) -> dict[str, list]:
    """Columns of `PACKS`; `encode` gives the token ids of many strings."""
    strings = list(dict.fromkeys(p for pack in packs for _, parts, _ in pack.nodes for p in parts if p))
    ids = dict(zip(strings, encode(strings)))
    ids[""] = []
    out: dict[str, list] = {name.split(" ")[0]: [] for name in PACKS.split(", ")}
    for pack in packs:
        tokens, positions, loss = [], [], []
        starts, ends, attends, last_position = [], [], [], []
        for parent, parts, counts in pack.nodes:
            own = [ids[p] for p in parts]
            n, at = sum(map(len, own)), len(tokens)
            for k, piece in enumerate(own):
                tokens += piece
                loss += [counts and k == 1] * len(piece)
            first = last_position[parent] if parent >= 0 else 0
            positions.extend(range(first, first + n))
            last_position.append(first + n)
            starts.append(at)
            ends.append(at + n)
            attends.append(merged(attends[parent] if parent >= 0 else [], at, at + n))
        for name, value in zip(out, (tokens, positions, loss, starts, ends, [p for p, _, _ in pack.nodes], attends,
                                     [c for c, _ in pack.convs], [n for _, n in pack.convs])):
            out[name].append(value)
    return out


def _tokenizer(path: str, pattern: str):
    """A byte-level encoding from a file of `base64 rank` lines; no string is special."""
    import base64
    import tiktoken
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def format_conversations(conversations: DataFrame, vocabulary: str, pattern: str, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text", pack_chars: int = PACK_CHARS,
                         pack_convs: int = PACK_CONVS) -> DataFrame:
    """Packed sequences, one row each: token ids, position ids, loss mask, nodes with the intervals they
    attend to (flat start, end pairs), and each conversation's last node."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.select(F.col(conv_col).cast("long").alias("conv_id"),
                                F.struct(F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text")).alias("t"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    turns = whole.select("conv_id", path_of(F.transform("t", lambda t: turn_digest(t.role, t.text))).alias("path"),
                         F.transform("t", lambda t: F.array(t.role, t.text)).alias("turns"))

    as_batch = batch_maker(PACKS)

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            blobs = [press.compress(json.dumps(t, ensure_ascii=False).encode("utf-8", "surrogatepass")) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(blobs, pa.binary())], names=["conv_id", "path", "turns"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        loosen = zstandard.ZstdDecompressor()
        tok = _tokenizer(vocabulary, pattern)

        def encode(strings: list[str]) -> list[list[int]]:
            return [tok.encode_ordinary(s) for s in strings]

        done: list[Pack] = []
        now = Pack()
        for batch in batches:
            for conv_id, path, blob in zip(*(c.to_pylist() for c in batch.columns)):
                same = now.shared(path)
                if now.convs and (same == 0 or now.chars >= pack_chars or len(now.convs) >= pack_convs):
                    done.append(now)
                    now, same = Pack(), 0
                    if sum(p.chars for p in done) >= BATCH_CHARS or len(done) >= 2000:
                        yield as_batch(packed_rows(done, encode))
                        done = []
                now.add(conv_id, path, json.loads(loosen.decompress(blob).decode("utf-8", "surrogatepass")), same)
        if now.convs:
            done.append(now)
        if done:
            yield as_batch(packed_rows(done, encode))

    dealt = (turns.mapInArrow(squeeze, "conv_id long, path string, turns binary")
             .repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id"))
    return dealt.mapInArrow(pack, PACKS)


def read_back(packs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Every conversation read from the packed sequences: what its last node attends to, in the order of
    the position ids, is decoded, parsed and unescaped.  `conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars`."""
    as_batch = batch_maker(READ)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(vocabulary, pattern)
        names = [f.split(" ")[0] for f in PACKS.split(", ")]
        for batch in batches:
            for i in range(batch.num_rows):
                tokens, positions, loss = (batch.column(names.index(c))[i].values.to_numpy(zero_copy_only=False)
                                           for c in ("tokens", "positions", "loss"))
                attends, conv_ids, nodes = (batch.column(names.index(c))[i].as_py() for c in ("attends", "conv_ids", "conv_nodes"))
                seen: dict[int, tuple] = {}
                for node in dict.fromkeys(nodes):
                    flat = attends[node]
                    at = np.concatenate([np.arange(a, b) for a, b in zip(flat[::2], flat[1::2])])
                    if not np.array_equal(positions[at], np.arange(len(at))):
                        raise ValueError("position ids of a path are not consecutive")
                    formatted = tok.decode(tokens[at].tolist())
                    # every text under the mask by itself: their ends stand between them
                    edges = np.flatnonzero(np.diff(np.concatenate(([0], loss[at].astype(np.int8), [0]))))
                    learnt = "".join(unescape(tok.decode(tokens[at[a:b]].tolist()))
                                     for a, b in zip(edges[::2], edges[1::2]))
                    turns = parse(formatted)
                    digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode("utf-8", "surrogatepass")).hexdigest()
                    seen[node] = (len(turns), digest, len(learnt),
                                  hashlib.sha256(learnt.encode("utf-8", "surrogatepass")).hexdigest(), len(formatted))
                rows = [seen[n] for n in nodes]
                yield as_batch(dict(zip((f.split(" ")[0] for f in READ.split(", ")), (conv_ids, *zip(*rows)))))

    return packs.mapInArrow(run, READ)
