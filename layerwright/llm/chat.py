"""Chat formatting with a loss mask that is exact to the character.

A conversation is rendered as a whole and encoded once. Tokens of a byte-level vocabulary are runs of the text's bytes
in order, so the running sum of their lengths gives all offsets at once. The spans of the assistant's texts and the
spans of the tokens are both sorted, so a binary search finds the tokens of every span. Control strings stand for
single tokens and are cut out before the text is split, so no token reaches over the border of a span.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.llm.byte_pairs import token_ids
from layerwright.llm.common import small_batches

START, BODY, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
# A batch ends after this much text, so its arrays stay small.
BATCH_CHARACTERS = 1 << 24
VOCABULARY = "byte_bpe_50k.tiktoken"
# An opening "<|" in a text gets a backslash between its two characters, one more than it has: after that no text
# holds a control string, and taking one away again restores it.
_OPENING = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + r"(.*?)" + re.escape(BODY) + r"(.*?)" + re.escape(END), re.DOTALL)
_coders: dict[tuple[bytes, str], tuple[tiktoken.Encoding, np.ndarray]] = {}


def escape(text: str) -> str:
    return _OPENING.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def coder(ranks: bytes, pattern: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoder of a rank file's content with the control strings as tokens above it, and every token's length in bytes."""
    known = (hashlib.sha256(ranks).digest(), pattern)
    if known not in _coders:
        lines = map(bytes.split, ranks.splitlines())
        tokens = {base64.b64decode(token): int(rank) for token, rank in lines}
        # One identifier stays free between the file's and the control strings', for the end of a text.
        first = max(tokens.values()) + 2
        control = {text: first + i for i, text in enumerate((START, BODY, END))}
        lengths = np.zeros(first + len(control), np.int64)
        for token, rank in [*tokens.items(), *((text.encode(), rank) for text, rank in control.items())]:
            lengths[rank] = len(token)
        made = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=tokens, special_tokens=control)
        _coders[known] = made, lengths
    return _coders[known]


def render(turns: list[tuple[str, str]], learn_from: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of the texts to learn from, in order."""
    parts, spans, length = [], [], 0
    for role, text in turns:
        head, body = START + escape(role) + BODY, escape(text)
        if role == learn_from:
            spans.append((length + len(head), length + len(head) + len(body)))
        parts += [head, body, END]
        length += len(head) + len(body) + len(END)
    return "".join(parts), spans


def loss_mask(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """1 for every token that lies in a span. ``offsets``: start and end of each token, sorted."""
    mask = np.zeros(len(offsets), np.int8)
    if not len(offsets) or not spans:
        return mask
    edges = np.array(spans)
    first = np.searchsorted(offsets[:, 0], edges[:, 0], "left")
    last = np.searchsorted(offsets[:, 1], edges[:, 1], "right")
    for a, b in zip(first, last):
        mask[a:b] = 1
    return mask


def character_offsets(text: str, lengths: np.ndarray) -> np.ndarray:
    """Start and end of each token in code points, from the tokens' lengths in bytes; what holds part of one holds all of it."""
    ends = np.cumsum(lengths)
    starts = ends - lengths
    if text.isascii() or not len(ends):
        return np.column_stack((starts, ends))
    leads = (np.frombuffer(text.encode("utf-8"), np.uint8) & 0xC0) != 0x80
    place = np.cumsum(leads) - 1
    return np.column_stack((place[starts], place[ends - 1] + 1))


def encode(
    turns: list[tuple[str, str]], made: tuple[tiktoken.Encoding, np.ndarray], learn_from: str = "assistant"
) -> dict:
    text, spans = render(turns, learn_from)
    encoding, lengths = made
    ids = token_ids(encoding, text)
    offsets = character_offsets(text, lengths[ids])
    return {
        "formatted": text,
        "token_ids": ids.astype(np.int32),
        "token_starts": offsets[:, 0].astype(np.int32),
        "token_ends": offsets[:, 1].astype(np.int32),
        "loss_mask": loss_mask(offsets, spans),
    }


def masked_text(formatted: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> str:
    """The text under the mask, unescaped run by run. Tokens of one character's bytes share its offsets."""
    inside = np.flatnonzero(mask)
    if not len(inside):
        return ""
    breaks = np.flatnonzero(np.diff(inside) > 1)
    firsts = inside[np.concatenate(([0], breaks + 1))]
    lasts = inside[np.concatenate((breaks, [len(inside) - 1]))]
    return "".join(unescape(formatted[starts[a] : ends[b]]) for a, b in zip(firsts, lasts))


def parse(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


FORMATTED_SCHEMA = (
    "conv_id long, formatted string, token_ids array<int>, token_starts array<int>, token_ends array<int>, "
    "loss_mask array<byte>"
)


_ARRAYS = {"token_ids": pa.int32(), "token_starts": pa.int32(), "token_ends": pa.int32(), "loss_mask": pa.int8()}


def _rows(made: list[dict]) -> pa.RecordBatch:
    """Encoded conversations as one batch: their arrays lie end to end."""
    ends = np.cumsum([0] + [len(row["token_ids"]) for row in made], dtype=np.int32)
    columns = {name: pa.array([row[name] for row in made], pa.string()) for name in ("conv_id", "formatted")}
    for name, kind in _ARRAYS.items():
        flat = pa.array(np.concatenate([row[name] for row in made]), kind)
        columns[name] = pa.ListArray.from_arrays(pa.array(ends), flat)
    return pa.RecordBatch.from_pydict(columns)


def _slices(column: pa.ListArray) -> Iterator[np.ndarray]:
    """The arrays of a list column, as views of its values."""
    ends, flat = column.offsets.to_numpy(), column.values.to_numpy()
    return (flat[a:b] for a, b in zip(ends, ends[1:]))


def format_chats(
    conversations: DataFrame, vocabulary: str | None = None, learn_from: str = "assistant", pattern: str | None = None
) -> DataFrame:
    """One row per conversation: conv_id, formatted, token_ids, token_starts, token_ends, loss_mask.

    Rows are ordered by turn, ties by role and text; a null turn comes first. Null texts and roles are empty. Rows
    with a null conv_id are one conversation. Other columns are not read; an empty table gives none. Conversations
    are sorted together and streamed: a task holds one conversation, which is one value of its result. The rank file
    ``vocabulary`` (by default the public one) is read by the driver and sent to the executors, ``pattern`` splits texts.
    """
    with open(vocabulary or vocabulary_path(), "rb") as file:
        ranks = conversations.sparkSession.sparkContext.broadcast(file.read())
    pattern = pattern or split_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made_coder, current, turns, made, held = coder(ranks.value, pattern), None, [], [], 0
        for batch in batches:
            for conv, role, text in zip(*[batch.column(name).to_pylist() for name in ("conv_id", "role", "body")]):
                if turns and conv != current:
                    made.append({"conv_id": current, **encode(turns, made_coder, learn_from)})
                    turns = []
                    held += len(made[-1]["formatted"])
                    if held > BATCH_CHARACTERS:
                        yield _rows(made)
                        made, held = [], 0
                current = conv
                turns.append((role, text))
            if made:
                yield _rows(made)
                made, held = [], 0
        if turns:
            yield _rows([{"conv_id": current, **encode(turns, made_coder, learn_from)}])

    small_batches(conversations.sparkSession)
    rows = conversations.select(
        F.col("conv_id").cast("long").cast("string").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("body"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "body")
    text_id = FORMATTED_SCHEMA.replace("conv_id long", "conv_id string")
    return ordered.select("conv_id", "role", "body").mapInArrow(run, text_id).withColumn("conv_id", F.col("conv_id").cast("long"))


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def chat_digests(formatted: DataFrame) -> DataFrame:
    """Read formatted conversations back: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            arrays = [_slices(batch.column(name)) for name in ("token_starts", "token_ends", "loss_mask")]
            for text, starts, ends, mask in zip(batch.column("formatted").to_pylist(), *arrays):
                turns = parse(text)
                learnt = masked_text(text, starts, ends, mask)
                digest = _sha("".join(f"{role}\n{body}\n" for role, body in turns))
                rows.append((len(turns), digest, len(learnt), _sha(learnt), len(text)))
            columns = zip(*rows) if rows else [[]] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            found = [pa.array(values, kind) for values, kind in zip(columns, kinds)]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *found], names)

    small_batches(formatted.sparkSession)
    schema = "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    texted = formatted.withColumn("conv_id", F.col("conv_id").cast("string"))
    return texted.mapInArrow(run, schema).withColumn("conv_id", F.col("conv_id").cast("long"))
