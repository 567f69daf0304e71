"""Chat formatting with a loss mask that is aligned by character offsets.

A turn is rendered as ``<|im_start|>role<|im_sep|>text<|im_end|>`` and a line feed.
In roles and texts ``&`` becomes ``&amp;`` and ``<|`` becomes ``&lt;|``, so that no
control string can come from them; reading turns this back exactly. The rendered
conversation is encoded once, with the control strings as single tokens; the spans
of assistant texts are met with the sorted token spans by binary search. Since no
token reaches over a control string, the tokens met cover those texts and nothing
else.

Rows of a conversation are ordered by turn (null first), then role and text; nulls
in role and text are empty strings, rows with a null conversation id are one
conversation, repeated rows are turns like any other. A conversation whose rendered
text passes ``PART_CHARS`` is continued in a further part, cut between turns, where
encoding is the same; so a task holds one part at a time, whatever the
conversation's length. Other columns take no part, whatever their names. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
ASSISTANT = "assistant"
PART_CHARS = 1_000_000
TURN = re.compile(re.escape(START) + r"(.*?)" + re.escape(SEP) + r"(.*?)" + re.escape(END) + r"\n", re.DOTALL)
FORMATTED = "conv_id long, part int, n_turns long, formatted string, ids array<int>, starts array<int>, ends array<int>, loss array<boolean>"


def escape(text: str) -> str:
    return text.replace("&", "&amp;").replace("<|", "&lt;|")


def unescape(text: str) -> str:
    return text.replace("&lt;|", "<|").replace("&amp;", "&")


def render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray]:
    """The text of the turns (role, text), and the spans that the loss is taken over."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{SEP}", escape(text)
        if role == ASSISTANT and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        out.append(f"{head}{body}{END}\n")
        at += len(out[-1])
    return "".join(out), np.array(spans, np.int64).reshape(-1, 2)


def mask(starts: np.ndarray, ends: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Which tokens meet a span; both are sorted and do not overlap among themselves."""
    loss = np.zeros(len(starts) + 1, np.int64)
    np.add.at(loss, np.searchsorted(ends, spans[:, 0], "right"), 1)
    np.add.at(loss, np.searchsorted(starts, spans[:, 1], "left"), -1)
    return np.cumsum(loss)[:-1] > 0


def encoder(content: bytes):
    """The tokenizer with control strings as tokens and untrimmed offsets."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the threads here
    from tokenizers import AddedToken, Tokenizer, processors

    tokenizer = Tokenizer.from_str(content.decode())
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
    tokenizer.add_special_tokens([AddedToken(x, special=True, normalized=False) for x in (START, SEP, END)])
    return tokenizer


def format_chat(turns: DataFrame, tokenizer: bytes) -> DataFrame:
    """Parts of conversations (conv_id, part) with text, token ids, token spans and loss
    mask. Parts of a conversation follow each other in one partition. ``tokenizer`` is a
    tokenizer file's content, whose size bounds what is broadcast."""
    shared = turns.sparkSession.sparkContext.broadcast(tokenizer)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), text("role"), text("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoder(shared.value)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.bool_())]
        names = [c.split(" ")[0] for c in FORMATTED.split(", ")]

        def finish(parts: list) -> pa.RecordBatch:
            done = []
            rendered = [render(turns) for _, _, turns in parts]
            encoded = tokenizer.encode_batch([r[0] for r in rendered], add_special_tokens=False)
            for (conv, part, turns), (formatted, spans), found in zip(parts, rendered, encoded, strict=True):
                offsets = np.array(found.offsets, np.int32).reshape(-1, 2)
                loss = mask(offsets[:, 0], offsets[:, 1], spans)
                done.append((conv, part, len(turns), formatted, np.array(found.ids, np.int32), offsets[:, 0], offsets[:, 1], loss))
            return pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], kind) for k, kind in enumerate(kinds)], names)

        ready: list = []
        turns: list[tuple[str, str]] = []
        conv, part, chars, held, begun = None, 0, 0, 0, False
        for batch in batches:
            for at, _, role, text in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if begun and (at != conv or chars > PART_CHARS):
                    ready.append((conv, part, turns))
                    held += chars
                    part, turns, chars = (part + 1 if at == conv else 0), [], 0
                    if held > PART_CHARS:
                        yield finish(ready)
                        ready, held = [], 0
                conv, begun = at, True
                turns.append((role, text))
                chars += len(role) + len(text)
        if begun:
            yield finish([*ready, (conv, part, turns)])

    return rows.mapInArrow(build, FORMATTED)


def under(formatted: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray) -> str:
    """The rendered text that masked tokens cover, once."""
    a, b = starts[loss].astype(np.int64), ends[loss].astype(np.int64)
    if not len(a):
        return ""
    a = np.maximum(a, np.append(0, np.maximum.accumulate(b)[:-1]))  # tokens may share a character
    return "".join(formatted[i:j] for i, j in zip(a.tolist(), b.tolist(), strict=True) if i < j)


def read_back(formatted: DataFrame, in_order: bool = False) -> DataFrame:
    """One row per conversation, from the output of ``format_chat`` alone: n_turns,
    turns_sha256 over role, line feed, text, line feed of every turn; loss_chars and
    loss_sha256 of the unescaped text under the loss mask; formatted_chars. Digests run
    on over the parts of a conversation, which are brought together and ordered first;
    ``in_order`` says that they still lie as ``format_chat`` has left them."""
    if not in_order:
        formatted = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    out = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split(" ")[0] for c in out.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        done: list[tuple] = []
        now: dict | None = None

        def close() -> None:
            done.append((now["conv"], now["n"], now["turns"].hexdigest(), now["chars"], now["loss"].hexdigest(), now["length"]))

        for batch in batches:
            for k in range(batch.num_rows):
                conv, part, _, text, _, starts, ends, loss = (c[k] for c in batch.columns)
                if part.as_py() == 0:
                    if now:
                        close()
                    now = {"conv": conv.as_py(), "n": 0, "turns": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "length": 0}
                text = text.as_py()
                found = TURN.findall(text)
                for role, body in found:
                    now["turns"].update(f"{unescape(role)}\n{unescape(body)}\n".encode())
                spans = [np.asarray(x.values) for x in (starts, ends)]
                learnt = unescape(under(text, *spans, loss.values.to_numpy(zero_copy_only=False)))
                now["n"] += len(found)
                now["chars"] += len(learnt)
                now["loss"].update(learnt.encode())
                now["length"] += len(text)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate(kinds)], names)
                done.clear()
        if now:
            close()
            yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate(kinds)], names)

    return formatted.mapInArrow(read, out)
