"""Byte-level BPE ids of whole texts, as the ``tokenizers`` library gives them for the same vocabulary file.

The vocabulary's letters are turned back into bytes, and the merging is left to ``tiktoken``, which is several times faster: the ids of its ranks
are the same because a merge of this vocabulary has the id of its rank. Special tokens in a text are told apart first. A run of
very many blanks is one word of the pattern but for its last blank; it goes to the encoder as such, as the pattern's
matcher would run out of stack on it.
"""

from __future__ import annotations

import base64
import json
from array import array
from functools import lru_cache

import numpy as np
import public_tokenizers
import regex

from salesloom.llm.bpe_trie import byte_letters

#: What the pattern's \s matches.
_BLANK = r"[\t-\r \x85\xa0  -     　]"
LONG_RUN = 10_000


def ranks_of(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ranks by token, and ids of special tokens, from a vocabulary of ``tokenizers`` (.json) or of ``tiktoken``."""
    if not path.endswith(".json"):
        with open(path, "rb") as f:
            return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, {}
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    byte = {c: b for b, c in enumerate(byte_letters())}
    special = {t["content"]: t["id"] for t in told["added_tokens"]}
    return {bytes(byte[c] for c in token): k for token, k in told["model"]["vocab"].items() if token not in special}, special


class ByteBpe:
    """Encoder of one vocabulary file."""

    def __init__(self, path: str):
        import tiktoken
        ranks, self.special = ranks_of(path)
        self.core = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.long_run = regex.compile(f"{_BLANK}{{{LONG_RUN},}}+")
        self.size = max([*ranks.values(), *self.special.values()]) + 1
        self.bytes = np.zeros(self.size, np.int64)
        for token, k in [*ranks.items(), *[(t.encode(), k) for t, k in self.special.items()]]:
            self.bytes[k] = len(token)

    def _ordinary(self, text: str) -> list[int]:
        if len(text) < LONG_RUN:
            return self.core.encode_ordinary(text)
        ids, at = [], 0
        for m in self.long_run.finditer(text):
            to = m.end() - (m.end() < len(text))  # the blank before a word belongs to the next piece
            ids += self.core.encode_ordinary(text[at: m.start()])
            ids += self.core._encode_single_piece(text[m.start(): to])
            at = to
        return ids + self.core.encode_ordinary(text[at:])

    def encode(self, text: str | None) -> array:
        """Ids of a text, no special tokens added; null counts as empty."""
        if not text:
            return array("I")
        if self.split_special is None or not any(s in text for s in self.special):
            return array("I", self._ordinary(text))
        ids = []
        for part in self.split_special.split(text):
            ids += [self.special[part]] if part in self.special else self._ordinary(part)
        return array("I", ids)


@lru_cache(maxsize=2)
def encoder(path: str) -> ByteBpe:
    return ByteBpe(path)
