"""Problem 9: splitting oversized texts at natural boundaries, with overlap.

A recursive hierarchy of separators: sections, paragraphs, sentences, words, characters.
A part that fits is taken whole, one that doesn't is split at the next finer separator;
parts are packed greedily into pieces, each of which begins with the end of the one before.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.bpe import PATTERN, RANKS, encoder, word_sizes

LIMIT, OVERLAP = 4_096, 128

#: Where a text may be cut, coarse to fine; the cut is at the end of the match.
LEVELS = (
    r"\n(?=#{1,6} )|\n\s*(?:-{3,}|={3,}|\*{3,})[^\S\n]*\n|\n[^\S\n]*\n[^\S\n]*\n\s*",  # headings, rules, wide gaps
    r"\n[^\S\n]*\r?\n\s*|</p>\s*",  # paragraphs
    r"[.!?…。！？][\"'»”)\]]*(?=\s)|\n",  # sentences and lines
    r"(?=\s)",  # words
)
#: Pre-tokens of more characters than this may be cut between any two of them.
_LONG = 64


class Measured:
    """A text with its tokens counted up to every place where it may be cut: the starts of pre-tokens and, in long ones,
    of every character (a token counts at the character it begins in)."""

    def __init__(self, text: str, find, size, encode, pieces):
        self.text, self.encode = text, encode
        starts: list[int] = []
        counts: list[int] = []
        for m in find(text):
            w, at = m.group(), m.start()
            if len(w) <= _LONG:
                starts.append(at)
                counts.append(size(w))
                continue
            begins = np.cumsum([0, *map(len, pieces(encode(w)))])[:-1]
            wide = np.cumsum([0, *(len(c.encode()) for c in w)])
            starts.extend(range(at, at + len(w)))
            counts.extend(np.histogram(begins, wide)[0].tolist())
        self.starts = starts
        self.upto = [0, *accumulate(counts)]
        self.total = self.upto[-1]
        self.starts.append(len(text))

    def tokens(self, lo: int, hi: int) -> int:
        """Tokens between two cutting places."""
        return self.upto[bisect_left(self.starts, hi)] - self.upto[bisect_left(self.starts, lo)]

    def snap(self, at: int) -> int:
        """The last cutting place not after a position."""
        return self.starts[bisect_right(self.starts, at) - 1]

    def reach(self, lo: int, most: int) -> int:
        """The farthest cutting place with at most so many tokens from lo on, but past lo."""
        k = bisect_left(self.starts, lo)
        return self.starts[max(k + 1, bisect_right(self.upto, self.upto[k] + most) - 1)]

    def back(self, hi: int, most: int, least: int) -> int:
        """The first cutting place before a word with at most so many tokens up to hi."""
        k = bisect_left(self.upto, self.upto[bisect_left(self.starts, hi)] - most)
        for s in self.starts[k:]:
            if s >= hi:
                break
            if self.text[s].isspace() or (s and self.text[s - 1].isspace()):
                return max(s, least)
        return max(self.starts[min(k, len(self.starts) - 1)], least) if self.starts[min(k, len(self.starts) - 1)] < hi else hi


def _parts(m: Measured, lo: int, hi: int, most: int, levels: list) -> Iterator[tuple[int, int]]:
    if m.tokens(lo, hi) <= most:
        yield lo, hi
        return
    if not levels:
        while lo < hi:
            end = min(hi, m.reach(lo, most))
            yield lo, end
            lo = end
        return
    at = lo
    for cut in [*(m.snap(x.end()) for x in levels[0].finditer(m.text, lo, hi)), hi]:
        if cut > at:
            yield from _parts(m, at, cut, most, levels[1:])
            at = cut


def split_text(text: str, limit: int, overlap: int, find, size, encode, levels: list, pieces) -> list[tuple[int, int, int]]:
    """(start, end, tokens) of the pieces of a text; a text within the limit is one piece."""
    m = Measured(text, find, size, encode, pieces)
    if m.total <= limit and len(encode(text)) <= limit:
        return [(0, len(text), m.total)]
    out: list[tuple[int, int, int]] = []
    start = end = 0

    def close(lo: int, hi: int) -> int:
        """Emit a piece; its count is taken from its own encoding, and cut back if too long."""
        n = len(encode(text[lo:hi]))
        while n > limit:
            hi = m.snap(hi - 1)
            n = len(encode(text[lo:hi]))
        out.append((lo, hi, n))
        return hi

    for lo, hi in _parts(m, 0, len(text), limit - overlap, levels):
        if end > start and m.tokens(start, hi) > limit:
            shut = close(start, end)
            start = m.back(shut, overlap, start + 1)
            while m.tokens(start, hi) > limit:  # left over from a piece that was cut back
                end = close(start, m.reach(start, limit))
                start = m.back(end, overlap, start + 1)
        end = hi
    while end > start:
        shut = close(start, end)
        if shut >= end:
            break
        start = m.back(shut, overlap, start + 1)
    return out


def split_oversized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, overlap: int = OVERLAP, ranks_path: str = RANKS) -> DataFrame:
    """(id, piece_no, start, end, tokens, piece) of the texts of more than `limit` tokens.

    Pieces cover the whole text in order, each of at most `limit` tokens by its own encoding; from
    the second on they begin with about `overlap` tokens of the one before, from a word on where
    there is one. start and end count code points. A token has at least one byte, so texts
    of at most `limit` bytes are skipped before any Python. Null, empty and short texts give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find, size = regex.compile(PATTERN).finditer, word_sizes(ranks_path).__getitem__
        encode, pieces = encoder(ranks_path).encode_ordinary, encoder(ranks_path).decode_tokens_bytes
        levels = [regex.compile(x) for x in LEVELS]
        for b in batches:
            cols: list[list] = [[] for _ in range(6)]
            for i, t in zip(b.column("id").to_pylist(), b.column("text").to_pylist(), strict=True):
                pieces = split_text(t, limit, overlap, find, size, encode, levels, pieces)
                if len(pieces) > 1:
                    for k, (lo, hi, n) in enumerate(pieces):
                        for c, v in zip(cols, (i, k, lo, hi, n, t[lo:hi]), strict=True):
                            c.append(v)
            kinds = (b.schema.field("id").type, pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.string())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["id", "piece_no", "start", "end", "tokens", "piece"])

    kind = dict(docs.dtypes)[id_col]
    large = docs.where(F.octet_length(text_col) > limit).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return large.mapInArrow(run, f"id {kind}, piece_no int, start long, end long, tokens int, piece string")
