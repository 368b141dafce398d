"""Chat formatting in budgeted windows with a reversible template and a loss mask.

A conversation's turns, in order, are cut into windows of at most `budget` tokens. Prefix sums of the
turns' tokens, as they are written into the window, choose turn-aligned spans: a window holds the system turn (if the conversation opens with
one), up to `history` tokens of the turns before its span, then its span. Targets are the assistant texts
of the span; those repeated as history are masked. A single turn over the budget is a window of its own.

Template: `<|im|>role`, a line break, the text, `<|end|>`, a line break. Inside roles and texts each `<~` is
written `<~~` and each `<|` then `<~|`, in a role also each line break `<~n`; all of it undoes uniquely.

Defined cases: null text or role is empty; null turns come first; rows with equal turns follow each other by
role and text, all kept; a null conversation id is a conversation. An empty table gives an empty result.
Conversations are streamed through sorted partitions: memory is bounded by a window, not by a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, BREAK = "<|im|>", "<|end|>", "\n"
WINDOW_SCHEMA = "conv_id long, window int, text string, turns array<int>, new_from int, loss_spans array<array<int>>, n_tokens long"


def escape(text: str) -> str:
    """No `<|` is left, so no control string can stand inside."""
    return text.replace("<~", "<~~").replace("<|", "<~|")


def _head(role: str) -> str:
    return f"{OPEN}{escape(role).replace(BREAK, '<~n')}{BREAK}"


def unescape(text: str) -> str:
    out, at = [], 0
    while (i := text.find("<~", at)) >= 0:
        out.append(text[at : i + 1])
        out.append({"|": "|", "~": "~", "n": ""}[text[i + 2]])
        if text[i + 2] == "n":  # only in roles: a line break, without the `<`
            out[-2] = out[-2][:-1] + BREAK
        at = i + 3
    out.append(text[at:])
    return "".join(out)


@dataclass
class Turn:
    number: int
    role: str
    text: str
    tokens: int


@dataclass
class Conversation:
    """Turns of one conversation as they come; emits a window when its span is complete."""

    conv_id: int | None
    budget: int
    history: int
    system: Turn | None = None
    past: list[Turn] = field(default_factory=list)
    span: list[Turn] = field(default_factory=list)
    windows: int = 0

    def _before(self) -> list[Turn]:
        head = [self.system] if self.system else []
        return head + self.past

    def add(self, turn: Turn) -> Iterator[dict]:
        if self.span and sum(t.tokens for t in self._before()) + self._span_tokens + turn.tokens > self.budget:
            yield self.window()
        if self.past and not self.span and sum(t.tokens for t in self._before()) + turn.tokens > self.budget:
            while self.past and sum(t.tokens for t in self._before()) + turn.tokens > self.budget:
                self.past.pop(0)
        self.span.append(turn)
        self._span_tokens += turn.tokens

    def __post_init__(self) -> None:
        self._span_tokens = 0

    def window(self) -> dict:
        before = self._before()
        parts, spans, at = [], [], 0
        for k, t in enumerate([*before, *self.span]):
            head, body = _head(t.role), escape(t.text)
            if k >= len(before) and t.role == "assistant":
                spans.append([at + len(head), at + len(head) + len(body)])
            parts.append(f"{head}{body}{CLOSE}{BREAK}")
            at += len(parts[-1])
        out = {
            "conv_id": self.conv_id,
            "window": self.windows,
            "text": "".join(parts),
            "turns": [t.number for t in (*before, *self.span)],
            "new_from": len(before),
            "loss_spans": spans,
            "n_tokens": sum(t.tokens for t in before) + self._span_tokens,
        }
        self.windows += 1
        if self.system is None and self.windows == 1 and self.span[0].role == "system" and self.span[0].number == 0:
            self.system = self.span[0]
        kept, tokens = [], 0
        for t in reversed(self.past + self.span):
            if t is self.system or tokens + t.tokens > self.history:
                break
            kept.insert(0, t)
            tokens += t.tokens
        self.past, self.span, self._span_tokens = kept, [], 0
        return out


def format_windows(
    df: DataFrame, vocabulary: str, pattern: str, budget: int = 2048, history: int = 256, id_col: str = "conv_id", turn_col: str = "turn"
) -> DataFrame:
    """Windows of every conversation, as WINDOW_SCHEMA. `loss_spans`: code points of the escaped targets in `text`.

    `vocabulary`: path of a rank file on every machine, whose tokens are counted; `pattern`: its word pattern.
    """
    rows = df.select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoder(vocabulary, pattern)
        current: Conversation | None = None
        number = 0
        for pdf in batches:
            ids = [None if pd.isna(c) else int(c) for c in pdf["conv_id"]]
            counts = map(len, encode([f"{_head(r)}{escape(t)}{CLOSE}{BREAK}" for r, t in zip(pdf["role"], pdf["text"], strict=True)]))
            out = []
            for conv_id, role, text, n in zip(ids, pdf["role"], pdf["text"], counts, strict=True):
                if current is None or current.conv_id != conv_id:
                    if current is not None:
                        out.append(current.window())
                    current, number = Conversation(conv_id, budget, history), 0
                out.extend(current.add(Turn(number, role, text, n)))
                number += 1
            if out:
                yield _frame(out)
        if current is not None:
            yield _frame([current.window()])

    return ordered.mapInPandas(windows, WINDOW_SCHEMA)


def _frame(rows: list[dict]) -> pd.DataFrame:
    out = pd.DataFrame(rows)
    out["conv_id"] = out["conv_id"].astype("Int64")
    return out


_encoders: dict = {}


def _encoder(vocabulary: str, pattern: str):
    if vocabulary not in _encoders:
        import base64

        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoding = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        _encoders[vocabulary] = lambda texts: [encoding.encode_ordinary(t) for t in texts]
    return _encoders[vocabulary]


def read_back(text: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn in a formatted window; start and end bound its escaped text."""
    out, at = [], 0
    while at < len(text):
        if not text.startswith(OPEN, at):
            raise ValueError("not a formatted window")
        head = text.index(BREAK, at)
        role = text[at + len(OPEN) : head]
        end = text.index(CLOSE, head)
        out.append((unescape(role), unescape(text[head + 1 : end]), head + 1, end))
        at = end + len(CLOSE) + len(BREAK)
    return out


DIGEST_SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, windows long"


def digests(windows: DataFrame) -> DataFrame:
    """What the windows of each conversation hold, read back from their text: new turns and targets, once each."""
    ordered = windows.repartition("conv_id").sortWithinPartitions("conv_id", "window")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current = None
        for pdf in batches:
            out = []
            for conv_id, text, new_from, spans in zip(pdf["conv_id"], pdf["text"], pdf["new_from"], pdf["loss_spans"], strict=True):
                conv_id = None if pd.isna(conv_id) else int(conv_id)
                if current is None or current["conv_id"] != conv_id:
                    if current is not None:
                        out.append(_digest(current))
                    current = {"conv_id": conv_id, "n": 0, "all": hashlib.sha256(), "loss_chars": 0, "loss": hashlib.sha256(), "chars": 0, "windows": 0}
                for role, body, _, _ in read_back(text)[new_from:]:
                    current["n"] += 1
                    current["all"].update(f"{role}\n{body}\n".encode())
                for start, end in spans:
                    target = unescape(text[start:end])
                    current["loss_chars"] += len(target)
                    current["loss"].update(target.encode())
                current["chars"] += len(text)
                current["windows"] += 1
            if out:
                yield _digests(out)
        if current is not None:
            yield _digests([_digest(current)])

    return ordered.mapInPandas(read, DIGEST_SCHEMA)


def _digest(c: dict) -> tuple:
    return c["conv_id"], c["n"], c["all"].hexdigest(), c["loss_chars"], c["loss"].hexdigest(), c["chars"], c["windows"]


def _digests(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[c.strip().split()[0] for c in DIGEST_SCHEMA.split(",")])
    out["conv_id"] = out["conv_id"].astype("Int64")
    return out
