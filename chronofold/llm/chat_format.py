"""Chat formatting in budgeted, turn-aligned windows.

Rows are dealt by conversation and sorted by turn inside each partition; one streaming pass then holds
only the open window, however many turns a conversation has. Prefix sums of turn tokens choose the spans: a
window takes turns while they fit into the budget. Every window starts with the conversation's system turns
(those before the first other turn), then repeats the last turns of the window before, up to a limited history, then adds new turns. The loss mask
covers the texts of assistant turns that are new in the window; repeated ones are masked, so over all
windows each assistant text is under the loss once.

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts a backslash becomes two and ``<|``
becomes ``<\\|``; roles also escape line feeds. No control string can then occur inside a text, and
``unescape`` undoes it exactly.

Defined cases: null texts and roles are empty; null turns come first, ties of a turn are ordered by role and text,
repeated rows stay as turns of their own; null conversation ids form one conversation; a turn longer than the budget
fills a window alone (with system turns and no history); empty tables give no windows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TURN_OVERHEAD = 4
WINDOW_TOKENS, HISTORY_TOKENS = 1024, 128
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.S)
_PIECE = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|_")


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"<\\\||\\\\", lambda m: "\\" if m[0] == "\\\\" else "<|", text)


def _escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def _unescape_role(role: str) -> str:
    return re.sub(r"<\\\||\\\\|\\n", lambda m: {"\\\\": "\\", "\\n": "\n"}.get(m[0], "<|"), role)


def estimate_tokens(text: str) -> int:
    """Pieces of letters, digits and punctuation, long runs counted per 6 characters: a model-free budget measure."""
    return TURN_OVERHEAD + sum((len(m) + 5) // 6 for m in _PIECE.findall(text))


@dataclass
class Turn:
    role: str
    text: str
    tokens: int
    number: int


class Windower:
    """Turns of one conversation in, finished windows out."""

    def __init__(self, conv, budget: int, history: int):
        self.conv, self.budget, self.history = conv, budget, history
        self.system: list[Turn] = []
        self.system_tokens = 0
        self.open: list[Turn] = []
        self.before: list[Turn] = []
        self.used = 0
        self.windows = self.count = 0
        self.leading = True

    def add(self, role: str, text: str, tokens: int) -> Iterator[dict]:
        turn = Turn(role, text, tokens, self.count)
        self.count += 1
        if self.leading and role == "system":
            self.system.append(turn)
            self.system_tokens += tokens
            return
        self.leading = False
        if self.open and self.used + tokens > self.budget:
            yield self._close()
        if not self.open:
            self.used = self.system_tokens + tokens
            kept = []
            spent = 0
            for old in reversed(self.before):
                if spent + old.tokens > self.history or self.used + spent + old.tokens > self.budget:
                    break
                kept.append(old)
                spent += old.tokens
            self.before = kept[::-1]
            self.used += spent
        else:
            self.used += tokens
        self.open.append(turn)

    def _close(self) -> dict:
        parts: list[str] = []
        spans: list[tuple[int, int]] = []
        at = 0
        fresh_system = self.windows == 0
        turns = [(t, fresh_system) for t in self.system] + [(t, False) for t in self.before] + [(t, True) for t in self.open]
        for turn, new in turns:
            head, body = f"{START}{_escape_role(turn.role)}\n", escape(turn.text)
            if new and turn.role == "assistant":
                spans.append((at + len(head), at + len(head) + len(body)))
            parts.append(f"{head}{body}{END}\n")
            at += len(parts[-1])
        out = {
            "conv_id": self.conv, "window": self.windows, "text": "".join(parts), "n_repeated": sum(not new for _, new in turns),
            "n_system": len(self.system), "n_turns": len(turns), "tokens": self.used, "loss_spans": [{"start": a, "end": b} for a, b in spans],
        }
        # Only what the next window may repeat is kept.
        last, spent = [], 0
        for turn in reversed(self.before + self.open):
            spent += turn.tokens
            if spent > self.history:
                break
            last.append(turn)
        self.before = last[::-1]
        self.open, self.windows = [], self.windows + 1
        return out

    def finish(self) -> Iterator[dict]:
        if self.open or (self.system and not self.windows):
            if not self.open:
                self.used = self.system_tokens
            yield self._close()


WINDOWS = "conv_id {kind}, window long, text string, n_repeated int, n_system int, n_turns int, tokens long, loss_spans array<struct<start:int,end:int>>"


def _arrow(kind: pa.DataType) -> pa.Schema:
    return pa.schema([
        ("conv_id", kind), ("window", pa.int64()), ("text", pa.string()), ("n_repeated", pa.int32()), ("n_system", pa.int32()),
        ("n_turns", pa.int32()), ("tokens", pa.int64()), ("loss_spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ])


def _window_rows(budget: int, history: int, count_tokens):
    def run(batches):
        current, held, size, schema = None, [], 0, None
        for batch in batches:
            schema = schema or _arrow(batch.schema.field("conv_id").type)
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if current is None or conv != current.conv:
                    held += [] if current is None else current.finish()
                    current = Windower(conv, budget, history)
                for w in current.add(role or "", text or "", count_tokens(text or "")):
                    held.append(w)
                    size += len(w["text"])
                if size >= 4 << 20 or len(held) >= 4096:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)
                    held, size = [], 0
        if current is not None:
            yield pa.RecordBatch.from_pylist(held + list(current.finish()), schema=schema)

    return run


def format_windows(turns: DataFrame, budget: int = WINDOW_TOKENS, history: int = HISTORY_TOKENS, count_tokens=estimate_tokens) -> DataFrame:
    """One row per window: conv_id, window, text, n_repeated, n_system, n_turns, tokens, loss_spans (code points of text).

    Rows of a conversation are neighbours and in window order within their partition.
    """
    picked = turns.select("conv_id", "turn", "role", "text")
    ordered = picked.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    kind = picked.schema["conv_id"].dataType.simpleString()
    return ordered.mapInArrow(_window_rows(budget, history, count_tokens), WINDOWS.format(kind=kind))


def read_window(text: str, n_repeated: int, n_system: int, first: bool) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, end) of the turns that are new in a window; start and end are where the escaped text stands."""
    for i, m in enumerate(_TURN.finditer(text)):
        if first or i >= n_repeated:
            yield _unescape_role(m[1]), unescape(m[2]), m.start(2), m.end(2)


class _Read:
    """What one conversation's windows say, digested as they stream by."""

    def __init__(self, conv):
        self.conv, self.turns, self.loss = conv, hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.formatted = 0

    def window(self, w: dict) -> None:
        text = w["text"]
        self.formatted += len(text)
        for role, body, _, _ in read_window(text, w["n_repeated"], w["n_system"], w["window"] == 0):
            self.n += 1
            self.turns.update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
        for span in w["loss_spans"]:
            body = unescape(text[span["start"] : span["end"]])
            self.loss_chars += len(body)
            self.loss.update(body.encode("utf-8", "surrogatepass"))

    def row(self) -> dict:
        return {
            "conv_id": self.conv, "n_turns": self.n, "turns_sha256": self.turns.hexdigest(), "loss_chars": self.loss_chars,
            "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.formatted,
        }


def _read_back(batches):
    current, schema, held = None, None, []
    for batch in batches:
        schema = schema or pa.schema([
            ("conv_id", batch.schema.field("conv_id").type), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
        ])
        for w in batch.to_pylist():
            if current is None or w["conv_id"] != current.conv:
                held += [] if current is None else [current.row()]
                current = _Read(w["conv_id"])
            current.window(w)
        if len(held) >= 4096:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if current is not None:
        yield pa.RecordBatch.from_pylist([*held, current.row()], schema=schema)


def read_back(windows: DataFrame) -> DataFrame:
    """Digests per conversation, from the formatted text alone; windows must come in format_windows' order."""
    kind = windows.schema["conv_id"].dataType.simpleString()
    return windows.mapInArrow(
        _read_back, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
