"""BPE encoding and decoding: distinct words in a trie share the work of common prefixes.

For a prefix of a word, its last token and the state before that token fix the whole encoding: of the tokens that end the prefix, exactly
one stays as it is next to the last token before it. The trie of the distinct words is walked depth first, which is their sorted order,
with the states of the path on a stack: a word goes back to the node that it shares with the word before, and only its
own nodes get a state. The vocabulary is that of a ``tokenizers`` file of kind BPE with word ends.

Null texts encode as empty ones. Nothing is truncated or padded. Repeated rows are encoded alike.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from copy import copy
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from salesloom.llm import common as K

VOCABULARY = "word_bpe_49k.json"

#: Control characters that str.split() takes for blanks and the vocabulary's patterns don't.
_CONTROLS = "\x1c\x1d\x1e\x1f"
_BLANKS = regex.compile(r"[\t-\r \x85\xa0  -     　]+")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself if it is visible, else the next free one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class ChunkEncoder:
    """Encoder that splits texts the way a vocabulary file of this kind says and remembers the ids of recent chunks, pieces of text without blanks.

    At most about twice ``limit`` chunks are remembered, none of more than LONGEST characters, so their bytes are bounded too. Subclasses say how
    chunks are learned.
    """

    #: Marks that the pattern takes as a word of their own after letters.
    MARKS = frozenset(".,;:!?)")
    LONGEST = 48

    def __init__(self, told: dict, limit: int):
        self.limit = limit
        self.chunks: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.words = regex.compile(told["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.letters = dict(enumerate(byte_letters()))

    def words_of(self, chunk: str) -> list[str]:
        """Words of a piece of text without blanks, in byte letters."""
        if not chunk.isascii():
            chunk = unicodedata.normalize("NFC", chunk)
        low = "".join([c.lower() for c in chunk]) if "Σ" in chunk else chunk.lower()
        if low.isalpha():
            words = [low]
        elif low[-1] in self.MARKS and low[:-1].isalpha():
            words = [low[:-1], low[-1]]
        else:
            words = self.words.findall(low)
        if low.isascii() and low.isprintable():
            return words
        table = self.letters
        return [w.encode().decode("latin-1").translate(table) for w in words]

    def parts(self, text: str | None) -> list[list[str] | int]:
        """Runs of chunks between special tokens, and the ids of those."""
        if not text:
            return []
        cut = self.split_special.split(text) if any(s in text for s in self.special) else [text]
        return [self.special[p] if p in self.special else [c for c in _BLANKS.split(p) if c] if any(c in p for c in _CONTROLS) else p.split() for p in cut]


    def learn(self, chunks: list[str]) -> None:
        """Put the ids of new ``chunks`` into ``self.chunks``."""
        raise NotImplementedError

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        cut = [self.parts(t) for t in texts]
        asked: set[str] = set()
        for parts in cut:
            for p in parts:
                if type(p) is list:
                    asked.update(p)
        if len(self.chunks) > self.limit:
            self.chunks, self.before = {}, self.chunks  # what is asked for again comes back from there
        now, new = self.chunks, []
        for c in asked - now.keys():
            ids = self.before.get(c)
            if ids is None:
                new.append(c)
            else:
                now[c] = ids
        self.learn(new)
        ids_of = now.__getitem__
        out = [b"".join([b"".join(map(ids_of, p)) if type(p) is list else _packed([p]) for p in parts]) for parts in cut]
        for c in new:
            if len(c) > self.LONGEST:
                del now[c]
        return out


class TrieBpe(ChunkEncoder):
    """Encoder and decoder of one vocabulary file; about ``limit`` recent chunks are remembered."""

    def __init__(self, path: str, limit: int = 250_000):
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        super().__init__(told, limit)
        model = told["model"]
        self.end, self.vocab = model["end_of_word_suffix"], model["vocab"]
        self.rank = {tuple(pair): k for k, pair in enumerate(model["merges"])}
        self.text_of = {i: t for t, i in (self.vocab | self.special).items()}
        self.inner = {t: i for t, i in self.vocab.items() if not t.endswith(self.end)}
        self.final = {t.removesuffix(self.end): i for t, i in self.vocab.items() if t.endswith(self.end)}
        # longest token with these last two letters, within a word and at its end
        self.inner_reach, self.final_reach = ({t[-2:]: len(t) for t in sorted(d, key=len)} for d in (self.inner, self.final))
        self.size = {i: len(t) for d in (self.inner, self.final) for t, i in d.items()}
        self.fits: dict[int, bool] = {}

    def _symbols(self, text: str) -> list[str]:
        """First symbols of a token's text, whose last may end a word."""
        if text.endswith(self.end):
            body = text.removesuffix(self.end)
            return [*body[:-1], body[-1] + self.end]
        return list(text)

    def merge(self, symbols: list[str]) -> list[str]:
        """Plain merging, lowest rank first; used to learn which tokens stay as they are side by side."""
        while len(symbols) > 1:
            ranks = [self.rank.get(p, 1 << 60) for p in zip(symbols, symbols[1:])]
            least = min(ranks)
            if least == 1 << 60:
                break
            a, b = symbols[ranks.index(least)], symbols[ranks.index(least) + 1]
            out, k = [], 0
            while k < len(symbols):
                if k + 1 < len(symbols) and symbols[k] == a and symbols[k + 1] == b:
                    out.append(a + b)
                    k += 2
                else:
                    out.append(symbols[k])
                    k += 1
            symbols = out
        return symbols

    def _fit(self, last: int, token: int) -> bool:
        """Whether ``last`` and ``token`` side by side stay two tokens; ``last`` is -1 at the start of a word."""
        want = [self.text_of[i] for i in (last, token) if i >= 0]
        return self.merge([s for t in want for s in self._symbols(t)]) == want

    def _state(self, word: str, depth: int, lasts: list[int], tokens: dict[str, int], reach: dict[str, int]) -> int:
        """The last token of the prefix of ``depth`` letters, given those of the shorter prefixes."""
        fits = self.fits
        for begin in range(max(0, depth - reach.get(word[max(0, depth - 2): depth], 1)), depth):
            token = tokens.get(word[begin:depth])
            if token is not None:
                key = lasts[begin] << 20 | token
                ok = fits.get(key)
                if ok is None:
                    ok = fits[key] = self._fit(lasts[begin], token)
                if ok:
                    return token
        raise ValueError(f"no token ends {word[:depth]!r}")

    def encode_words(self, words: set[str]) -> dict[str, list[int]]:
        """Ids of distinct words (of byte letters), by one depth-first walk of their trie."""
        out: dict[str, list[int]] = {}
        size, state, inner, reach = self.size, self._state, self.inner, self.inner_reach
        lasts, before = [-1], ""  # last tokens of the path's prefixes; the path
        for word in sorted(words):
            n = len(word) - 1
            shared = 0
            for a, b in zip(before, word[:n]):
                if a != b:
                    break
                shared += 1
            del lasts[shared + 1:]
            for depth in range(shared + 1, n + 1):
                lasts.append(state(word, depth, lasts, inner, reach))
            before = word[:n]
            token = state(word, n + 1, lasts, self.final, self.final_reach)
            ids, at = [token], n + 1 - size[token]
            while at:
                ids.append(lasts[at])
                at -= size[lasts[at]]
            ids.reverse()
            out[word] = ids
        return out

    def learn(self, chunks: list[str]) -> None:
        if len(self.fits) > 2 * self.limit:
            self.fits.clear()
        new = {c: self.words_of(c) for c in chunks}
        ids = self.encode_words({w for ws in new.values() for w in ws})
        for c, ws in new.items():
            self.chunks[c] = _packed(ids[ws[0]] if len(ws) == 1 else [i for w in ws for i in ids[w]])

    def decode(self, ids: np.ndarray) -> str:
        """Texts of the tokens joined by a blank, as the vocabulary names no decoder; special tokens included, unknown ids left out."""
        text = self.text_of
        return " ".join([text[i] for i in ids.tolist() if i in text])


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> TrieBpe:
    return TrieBpe(path)


def fresh(encoder: ChunkEncoder) -> ChunkEncoder:
    """An encoder with a memory of its own beside what ``encoder`` read from its file, which a worker process keeps between tasks."""
    out = copy(encoder)
    out.chunks, out.before = {}, {}
    return out


def portions(texts: list, size: int = 4 << 20):
    """Runs of whole texts of about ``size`` characters."""
    run, held = [], 0
    for t in texts:
        run.append(t)
        held += len(t or "")
        if held > size:
            yield run
            run, held = [], 0
    if run:
        yield run


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded``, in place of columns of these names."""
    path = path or public_tokenizers.path(VOCABULARY)
    own = [f for f in docs.schema.fields if f.name not in ("ids", "decoded")]
    names = [f.name for f in own]

    def run(batches):
        bpe = fresh(_vocabulary(path))  # a worker process outlives the task and should not keep its memory
        for b in batches:
            ids = [x for part in portions(b["text"].to_pylist()) for x in bpe.encode_batch(part)]
            texts = [bpe.decode(np.frombuffer(x, "<u4")) for x in ids]
            yield pa.RecordBatch.from_arrays([*[b[n] for n in names], pa.array(ids, pa.binary()), pa.array(texts, pa.string())], [*names, "ids", "decoded"])

    return K.map_rows(docs, run, T.StructType([*own, *T.StructType.fromDDL("ids binary, decoded string").fields]))


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row."""
    path = path or public_tokenizers.path(VOCABULARY)
    K.small_batches(docs.sparkSession)

    def run(batches):
        bpe = fresh(_vocabulary(path))
        for b in batches:
            ids = [x for part in portions(b["text"].to_pylist()) for x in bpe.encode_batch(part)]
            yield pa.RecordBatch.from_arrays([
                b["doc_id"].cast(pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                pa.array([hashlib.sha256(bpe.decode(np.frombuffer(x, "<u4")).encode()).hexdigest() for x in ids], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
