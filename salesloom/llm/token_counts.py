"""Token counts by offset-mapped attribution: a document is encoded once, and its tokens go to sections by their character spans.

A token spans the characters that its bytes touch. Tokens and sections meet in an interval join on sorted offsets within the document.
Rules for a token that crosses a boundary: ``largest`` gives it to the section that holds most of its characters, the earlier one
if they hold as many; ``first`` to the section of its first character; ``split`` gives each section its share of the characters.
Tokens outside all sections count for section -1, which has a row only if there are any.

Null and empty texts have no rows unless sections are given for them. Sections of one document should not overlap; if they do, a token
goes to one of them by the rule. Repeated rows are counted each. Unlisted documents count under -1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm import common as K
from salesloom.llm.byte_bpe import ByteBpe, encoder

RANKS = "byte_bpe_50k.tiktoken"
RULES = ("largest", "first", "split")


def token_spans(text: str, code: ByteBpe) -> tuple[np.ndarray, np.ndarray]:
    """First character and last character + 1 of each token of the whole text."""
    end = np.cumsum(code.bytes[np.array(code.encode(text), np.int64)])
    start = np.r_[0, end[:-1]] if len(end) else end
    if text.isascii():
        return start, end
    chars = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80)
    return chars[start] - 1, chars[end - 1]


def line_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Lines with their line feeds."""
    size = np.array([len(x) + 1 for x in text.split("\n")], np.int64)
    end = np.cumsum(size)
    end[-1] -= 1
    start = end - np.r_[size[:-1], size[-1] - 1]
    return (start[:-1], end[:-1]) if size[-1] == 1 else (start, end)


def allocate(t_start: np.ndarray, t_end: np.ndarray, s_start: np.ndarray, s_end: np.ndarray, rule: str = "largest") -> np.ndarray:
    """Tokens of each section, sections sorted by start; the last number is for tokens outside."""
    many = len(s_start)
    out = np.zeros(many + 1)
    if not len(t_start):
        return out
    low = np.searchsorted(np.maximum.accumulate(s_end), t_start, "right") if many else np.zeros(len(t_start), np.int64)
    high = np.searchsorted(s_start, t_end, "left")
    best, share, rest = np.full(len(t_start), many), np.zeros(len(t_start), np.int64), (t_end - t_start).astype(float)
    for k in range(int(np.max(high - low, initial=0))):
        cross = np.flatnonzero(low + k < high)
        s = low[cross] + k
        held = np.minimum(t_end[cross], s_end[s]) - np.maximum(t_start[cross], s_start[s])
        if rule == "split":
            some = np.maximum(held, 0)
            np.add.at(out, s, some / (t_end - t_start)[cross])
            rest[cross] -= some
            continue
        better = held > share[cross] if rule == "largest" else (best[cross] == many) & (s_start[s] <= t_start[cross]) & (t_start[cross] < s_end[s])
        best[cross[better]], share[cross[better]] = s[better], held[better]
    if rule == "split":
        out[many] = (np.maximum(rest, 0) / (t_end - t_start)).sum()
        return out
    return out + np.bincount(best, minlength=many + 1)


def counts(docs: DataFrame, sections: DataFrame | None = None, rule: str = "largest", path: str | None = None) -> DataFrame:
    """doc_id, section, start, end, n_tokens of every section of every row.

    ``sections``: (doc_id, section, start, end) in characters; by default the lines of each text, numbered from 0.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    path = path or public_tokenizers.path(RANKS)
    K.small_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    if sections is not None:
        listed = sections.where("doc_id is not null and start is not null and end is not null").groupBy("doc_id").agg(
            F.array_sort(F.collect_list(F.struct(*[F.col(c).cast("long").alias(c) for c in ("start", "end", "section")]))).alias("sections"))
        rows = rows.join(listed, "doc_id", "left")

    def run(batches):
        code = encoder(path)
        for b in batches:
            given = b["sections"].to_pylist() if "sections" in b.schema.names else None
            columns: list[list[np.ndarray]] = [*[[np.zeros(0, np.int64)] for _ in range(3)], [np.zeros(0)]]
            row = [np.zeros(0, np.int64)]
            for i, text in enumerate(b["text"].to_pylist()):
                if given is None:
                    s, e = line_spans(text or "")
                    name = np.arange(len(s))
                else:
                    s, e, name = (np.array([x[c] for x in given[i] or ()], np.int64) for c in ("start", "end", "section"))
                n = allocate(*token_spans(text or "", code), s, e, rule)
                outside = n[-1] > 1e-9
                for c, v in zip(columns, (np.r_[name, -1], np.r_[s, 0], np.r_[e, len(text or "")], n)):
                    c.append(v[: len(v) if outside else -1])
                row.append(np.full(len(s) + outside, i))
            name, s, e, n = (np.concatenate(c) for c in columns)
            yield pa.RecordBatch.from_arrays([
                b["doc_id"].cast(pa.int64()).take(pa.array(np.concatenate(row))), pa.array(name), pa.array(s), pa.array(e),
                pa.array(n) if rule == "split" else pa.array(n.astype(np.int64))], ["doc_id", "section", "start", "end", "n_tokens"])

    return rows.mapInArrow(run, f"doc_id long, section long, start long, end long, n_tokens {'double' if rule == 'split' else 'long'}")
