"""Byte-pair encoding of texts of any shape with a rank file."""

from __future__ import annotations

import re

import numpy as np
import regex
import tiktoken


def token_ids(encoding: tiktoken.Encoding, text: str) -> np.ndarray:
    """The identifiers of a text's tokens, the encoding's control strings among them.

    The encoder's own splitter gives up on runs of a million blanks and more; such a text is split here by the same
    pattern, without a limit, and its pieces are merged one by one. Both ways give the same identifiers.
    """
    try:
        return encoding.encode_to_numpy(text, allowed_special="all")
    except ValueError:
        return np.array(_piece_by_piece(encoding, text), np.uint32)


def _piece_by_piece(encoding: tiktoken.Encoding, text: str) -> list[int]:
    splitter, found = regex.compile(encoding._pat_str), []
    control = sorted(encoding.special_tokens_set)
    parts = re.split("(" + "|".join(map(re.escape, control)) + ")", text) if control else [text]
    for i, part in enumerate(parts):
        # Every second part is a control string.
        if i % 2:
            found.append(encoding.encode_single_token(part))
        else:
            for piece in splitter.finditer(part):
                found += encoding._encode_single_piece(piece.group())
    return found
