"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, encoded once with offsets, and the sorted spans of its assistant texts are intersected with the
sorted token spans by binary search.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer
from tokenizers.processors import ByteLevel

from streamtab.llm.common import batches

# The template's marks: <s>[INST]role[/INST]text</s> for each turn.
OPEN, HEAD, BODY, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
# A mark with backslashes after its first character is text: one backslash is added to each, and taken off again.
_TEXT_MARK = re.compile(r"([<\[])(\\*)(/?(?:s>|INST\]))")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(/?(?:s>|INST\]))")
_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.S)

FORMATTED = "conv_id long, formatted string, input_ids array<int>, starts array<int>, ends array<int>, loss array<boolean>"


def escape(text: str) -> str:
    return _TEXT_MARK.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans, in code points, of its non-empty assistant texts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        before, body = f"{OPEN}{HEAD}{escape(role)}{BODY}", escape(text)
        parts += [before, body, CLOSE]
        at += len(before)
        if role == "assistant" and body:
            spans.append((at, at + len(body)))
        at += len(body) + len(CLOSE)
    return "".join(parts), spans


def turns_of(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


@lru_cache(maxsize=4)
def load_tokenizer(path: str) -> Tokenizer:
    """The tokenizer with the marks as tokens of their own, so that no token crosses one; offsets keep white space.

    The marks are the only control strings: the tokenizer's own special tokens, when a text spells them, are encoded as text.
    """
    tokenizer = Tokenizer.from_file(path)
    tokenizer.add_tokens([AddedToken(m, normalized=False, special=False) for m in (OPEN, HEAD, BODY, CLOSE)])
    tokenizer.encode_special_tokens = True
    tokenizer.post_processor = ByteLevel(trim_offsets=False)
    return tokenizer


def mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens overlap a span; spans and tokens are sorted, and an empty token overlaps nothing."""
    if not spans:
        return np.zeros(len(starts), bool)
    begin, stop = np.array(spans).T
    nearest = np.searchsorted(stop, starts, side="right")  # the first span that ends after the token's start
    inside = nearest < len(begin)
    return inside & (begin[np.minimum(nearest, len(begin) - 1)] < ends) & (ends > starts)


def loss_texts(formatted: str, starts: list[int], ends: list[int], loss: list[bool]) -> list[str]:
    """The text under each unbroken run of masked tokens, unescaped; tokens are sorted by both offsets."""
    edges = np.flatnonzero(np.diff(np.asarray(loss, np.int8), prepend=0, append=0))
    begin, stop = np.asarray(starts)[edges[::2]], np.asarray(ends)[edges[1::2] - 1]
    return [unescape(formatted[a:b]) for a, b in zip(begin.tolist(), stop.tolist())]


def conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): each conversation's (role, text) in order of turn; a conversation is the unit that is encoded.

    Null roles and texts are empty, null turns come first, and rows of one turn go by role, then text. Rows without a conversation
    id form one conversation with a null id. Repeated rows stay repeated.
    """
    one = F.struct(
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    return rows.groupBy(F.col(f"`{conv}`").alias("conv_id")).agg(F.sort_array(F.collect_list(one)).alias("turns"))


def format_conversations(turns: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(conv_id, formatted, input_ids, starts, ends, loss) of each conversation; offsets count code points of `formatted`.

    `loss` marks the tokens of assistant texts, and those only. Roles and texts that hold the template's marks are escaped and come
    back as they were from `turns_of` and `loss_texts`. `tokenizer` is the file of a byte-level BPE.
    """
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")

    def encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_tokenizer(path)
        for batch in batches(parts, rows=200, chars=1 << 22):
            out = {name: [] for name in ("conv_id", "formatted", "input_ids", "starts", "ends", "loss")}
            rendered = [render([(t["role"], t["text"]) for t in group]) for group in batch["turns"].to_pylist()]
            for conv, (formatted, spans) in zip(batch["conv_id"].to_pylist(), rendered):
                # One by one: a batch would be dealt over threads, each with memory of its own, on a core that the task has alone.
                encoding = encoder.encode(formatted, add_special_tokens=False)
                offsets = np.fromiter(chain.from_iterable(encoding.offsets), np.int32).reshape(-1, 2)
                out["conv_id"].append(conv)
                out["formatted"].append(formatted)
                out["input_ids"].append(encoding.ids)
                out["starts"].append(offsets[:, 0])
                out["ends"].append(offsets[:, 1])
                out["loss"].append(mask(offsets[:, 0], offsets[:, 1], spans))
            kinds = {"conv_id": pa.int64(), "formatted": pa.string(), "loss": pa.list_(pa.bool_())}
            yield pa.RecordBatch.from_pydict({k: pa.array(v, kinds.get(k, pa.list_(pa.int32()))) for k, v in out.items()})

    return turns.mapInArrow(encode, FORMATTED)


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader finds in formatted conversations: turns parsed from the text, and the text under the loss mask."""

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(parts, rows=200, chars=1 << 24):
            rows, cuts = [], batch["starts"].offsets.to_numpy()
            cuts = cuts - cuts[0]
            starts, ends = batch["starts"].flatten().to_numpy(), batch["ends"].flatten().to_numpy()
            loss = batch["loss"].flatten().to_numpy(zero_copy_only=False)
            for conv, formatted, a, b in zip(batch["conv_id"].to_pylist(), batch["formatted"].to_pylist(), cuts[:-1], cuts[1:]):
                turns = turns_of(formatted)
                whole = "".join(f"{role}\n{text}\n" for role, text in turns)
                under = "".join(loss_texts(formatted, starts[a:b], ends[a:b], loss[a:b]))
                rows.append((conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(under),
                             hashlib.sha256(under.encode()).hexdigest(), len(formatted), int(b - a), int(loss[a:b].sum())))
            names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "loss_tokens")
            kinds = {"turns_sha256": pa.string(), "loss_sha256": pa.string()}
            yield pa.RecordBatch.from_pydict({n: pa.array([r[i] for r in rows], kinds.get(n, pa.int64())) for i, n in enumerate(names)})

    return formatted.select("conv_id", "formatted", "starts", "ends", "loss").mapInArrow(
        read,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
        "n_tokens long, loss_tokens long",
    )
