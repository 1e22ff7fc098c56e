"""Problem 7: byte-level BPE of a whole corpus by a public vocabulary.

Texts are cut into pre-tokens once, in blocks of documents that number their distinct
pre-tokens. Each distinct pre-token of the corpus is encoded once, by a Spark higher-order
fold that merges the pair of lowest rank in its array of byte ids until none is left; the ranks
are a literal table. The ids then go back to the blocks that need them.
"""

from __future__ import annotations

import base64
import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.session import written

#: Vocabulary files; both hold the same vocabulary.
VOCAB = "/opt/tokenizers/byte_bpe_50k.json"
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value of the public vocabulary: how it cuts text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A block ends at this many documents, distinct pre-tokens or pre-tokens.
BLOCK_DOCS, BLOCK_WORDS, BLOCK_TOKENS = 2_000, 50_000, 2_000_000
#: Pre-tokens of more bytes than this are cut where no token reaches across, and folded by all places of a pair at once.
LONG = 48
#: Entries of the rank table below this are of the wanted pair.
_FOUND = 1 << 32


def _byte_chars() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary file: printable
    Latin-1 stands for itself, the other bytes, in order, for the characters from 256 on."""
    kept = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=2)
def vocabulary(path: str = VOCAB) -> tuple[bytes, dict[int, int], list[bytes]]:
    """(id of each byte, merged id by packed pair of ids, bytes of each id)."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    chars = _byte_chars()
    back = {c: b for b, c in chars.items()}
    ids = model["vocab"]
    merges: dict[int, int] = {}
    for m in model["merges"]:
        left, right = m.split(" ") if isinstance(m, str) else m
        merges[(ids[left] << 16) | ids[right]] = ids[left + right]
    pieces = [b""] * (max(ids.values()) + 1)
    for token, i in ids.items():
        if all(c in back for c in token):
            pieces[i] = bytes(back[c] for c in token)
    return bytes(ids[chars[b]] for b in range(256)), merges, pieces


@functools.lru_cache(maxsize=2)
def _rank_table(path: str) -> tuple[list[int], list[int]]:
    """The merges as a sparse table (base, slots): the entry of a pair stands at base[left] + right
    and holds left << 44 | merged << 12. Left ids with many partners are placed first, each
    at the first base where all its entries find free slots."""
    merges = vocabulary(path)[1]
    rows: dict[int, list[int]] = {}
    for pair in merges:
        rows.setdefault(pair >> 16, []).append(pair & 0xFFFF)
    ids = len(vocabulary(path)[2])
    free = np.ones(16 * ids, bool)
    base, start, span = np.zeros(ids, np.int64), 0, 2_048
    for left, rights in sorted(rows.items(), key=lambda x: (-len(x[1]), x[0])):
        at = np.array(sorted(rights))
        start += int(np.argmax(free[start:]))  # the slots before are full
        b = max(0, start - int(at[0]))
        while True:
            fits = free[b + at[0] : b + at[0] + span].copy()
            for a in at[1:]:
                fits &= free[b + a : b + a + span]
            if fits.any():
                b += int(np.argmax(fits))
                break
            b += span
        free[at + b] = False
        base[left] = b
    slots = np.full(int(np.flatnonzero(~free)[-1]) + 1, 65_535 << 44, np.int64)
    for pair, merged in merges.items():
        slots[base[pair >> 16] + (pair & 0xFFFF)] = ((pair >> 16) << 44) | (merged << 12)
    return base.tolist(), slots.tolist()


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), 0)


def fold_merges(word: Column, path: str = VOCAB) -> Column:
    """Token ids of a pre-token given as a string whose character codes are byte ids.

    One step of the fold replaces the leftmost pair of the lowest rank; merged ids are numbered
    in rank order, so the smallest merged id is that of the lowest rank.
    """
    base, slots = (F.from_json(F.lit(json.dumps(x, separators=(",", ":"))), "array<bigint>") for x in _rank_table(path))
    # bound once: every mention of a literal of this size would be planned and shipped anew
    both = lambda ranks: F.when(F.length(word) <= LONG, _fold(word, ranks)).otherwise(_fold_long(word, ranks))
    return _let(F.struct(base.alias("base"), slots.alias("slots")), both)


def _fold(word: Column, ranks: Column) -> Column:
    def step(parts: Column, _: Column) -> Column:
        # Of each pair: its merged id << 12 | its place. An entry of another left id keeps high bits
        # after the exclusive or, so it is never the least; beyond the last part there is null.
        rank = lambda x, i: F.get(ranks["slots"], F.get(ranks["base"], x) + F.get(parts, i + 1)).bitwiseXOR(F.shiftleft(x, 44)) + i

        def join(b: Column) -> Column:
            # transform and filter are far cheaper than slice and concat when interpreted
            at = b.bitwiseAND(4_095)
            put = F.transform(parts, lambda x, i: F.when(i == at, F.shiftright(b, 12)).when(i != at + 1, x))
            return F.filter(put, lambda x: x.isNotNull())

        return _let(F.array_min(F.transform(parts, rank)), lambda b: F.when(b < _FOUND, join(b)).otherwise(parts))

    first = F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.ascii(F.substring(word, i, F.lit(1))).cast("bigint"))
    return F.aggregate(F.sequence(F.lit(2), F.length(word)), first, step).cast("array<int>")


def _fold_long(word: Column, ranks: Column) -> Column:
    """The same merges for long pre-tokens: a step replaces all places of the pair of the lowest rank (pairs with a
    merged id have higher ranks than the pair itself, so none of them comes in between), and nothing is
    done once no pair is left. Of a run of one repeated id every other place is one."""

    def step(state: Column, _: Column) -> Column:
        parts = state["parts"]
        entry = lambda x, i: F.get(ranks["slots"], F.get(ranks["base"], x) + F.get(parts, i + 1)).bitwiseXOR(F.shiftleft(x, 44))

        def join(found: Column) -> Column:
            e, least = found["e"], found["least"]
            at = (F.array_position(e, least) - 1).cast("int")

            def put(run: Column) -> Column:
                alike, end = run["alike"], run["end"]
                begins = lambda i: (F.get(e, i) == least) & (~alike | ((i >= at) & (i < end) & ((i - at) % 2 == 0)))
                new = F.transform(parts, lambda x, i: F.when(begins(i), F.shiftright(least, 12)).when(~F.coalesce(begins(i - 1), F.lit(False)), x))
                return F.struct(F.filter(new, lambda x: x.isNotNull()).alias("parts"), F.lit(False).alias("done"))

            stop = F.array_position(F.transform(e, lambda x, i: (i > at) & (F.coalesce(x, F.lit(-1)) != least)), F.lit(True)) - 1
            return _let(F.struct((F.get(parts, at) == F.get(parts, at + 1)).alias("alike"), stop.cast("int").alias("end")), put)

        rest = F.struct(parts.alias("parts"), F.lit(True).alias("done"))
        pairs = lambda e: F.struct(e.alias("e"), F.array_min(e).alias("least"))
        merged = _let(_let(F.transform(parts, entry), pairs), lambda f: F.when(f["least"] < _FOUND, join(f)).otherwise(rest))
        return F.when(state["done"], state).otherwise(merged)

    first = F.transform(F.split(word, ""), lambda c: F.ascii(c).cast("bigint"))
    start = F.struct(first.alias("parts"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(2), F.length(word)), start, step, lambda s: s["parts"]).cast("array<int>")


@functools.lru_cache(maxsize=2)
def _neighbours(path: str) -> np.ndarray:
    """Whether two bytes (256, 256) stand next to each other in any token."""
    out = np.zeros((256, 256), bool)
    for piece in vocabulary(path)[2]:
        b = np.frombuffer(piece, np.uint8)
        out[b[:-1], b[1:]] = True
    return out


def cut_long(word: str, path: str = VOCAB) -> list[str]:
    """A pre-token cut between the characters where no token reaches across: the parts merge on their own."""
    b = np.frombuffer(word.encode(), np.uint8)
    cuts = np.flatnonzero(~_neighbours(path)[b[:-1], b[1:]] & ((b[1:] & 0xC0) != 0x80)) + 1
    edges = [0, *cuts.tolist(), len(b)]
    raw = b.tobytes()
    return [raw[x:y].decode() for x, y in zip(edges[:-1], edges[1:], strict=True)]


class _Numbers(dict):
    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


def _cut(pattern: str, byte_ids: bytes, path: str):
    """Blocks of documents as rows of two kinds: (block, doc_id, its pre-tokens' numbers in the
    block) and (block, pre-token, its number)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        from pyspark import TaskContext

        find = regex.compile(pattern).findall
        part, number, held = TaskContext.get().partitionId(), 0, 0
        docs: list[tuple[int, np.ndarray]] = []
        words = _Numbers()

        def flush():
            block = (part << 32) | number
            n, m = len(docs), len(words)
            small = m <= 65_536
            data = [d.astype(np.uint16 if small else np.uint32).tobytes() for _, d in docs]
            spelled = [w.encode().translate(byte_ids).decode("latin-1") for w in words]
            return pa.record_batch(
                [pa.array(np.full(n + m, block, np.int64)), pa.array([i for i, _ in docs] + [None] * m, pa.int64()), pa.array(data + [None] * m, pa.binary()),
                 pa.array([2 if small else 4] * n + [None] * m, pa.int32()), pa.array([None] * n + spelled, pa.string()), pa.array([None] * n + list(range(m)), pa.int32())],
                names=["block", "doc_id", "data", "width", "word", "number"],
            )

        for b in batches:
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                found = find(t) if t else []
                if found and len(max(found, key=len)) > LONG // 4:
                    found = [p for w in found for p in (cut_long(w, path) if len(w) > LONG // 4 and len(w.encode()) > LONG else (w,))]
                docs.append((i, np.array(list(map(words.__getitem__, found)), np.uint32)))
                held += len(found)
                if len(docs) >= BLOCK_DOCS or len(words) >= BLOCK_WORDS or held >= BLOCK_TOKENS:
                    yield flush()
                    docs, words, number, held = [], _Numbers(), number + 1, 0
        if docs:
            yield flush()

    return run


def _gather(docs: pa.Table, words: pa.Table) -> pa.Table:
    """Ids of the documents of a block from those of its pre-tokens."""
    names = ["doc_id", "ids"]
    if not docs.num_rows:
        return pa.table([pa.array([], pa.int64()), pa.array([], pa.list_(pa.int32()))], names=names)
    numbers = [np.frombuffer(x, np.uint16 if w == 2 else np.uint32) for x, w in zip(docs.column("data").to_pylist(), docs.column("width").to_pylist(), strict=True)]
    at = np.concatenate(numbers).astype(np.int64)
    if not len(at):
        return pa.table([docs.column("doc_id"), pa.array([[]] * docs.num_rows, pa.list_(pa.int32()))], names=names)
    words = words.combine_chunks()
    lists = words.column("ids").chunk(0)
    flat, ends = lists.flatten().to_numpy(), np.asarray(lists.offsets) - lists.offsets[0].as_py()
    place = np.empty(words.num_rows, np.int64)
    place[words.column("number").to_numpy()] = np.arange(words.num_rows)
    row = place[at]
    size = (ends[1:] - ends[:-1])[row].astype(np.int64)
    total = np.concatenate([[0], np.cumsum(size)])
    values = flat[np.repeat(ends[:-1][row] - total[:-1], size) + np.arange(total[-1])]
    offsets = total[np.concatenate([[0], np.cumsum([len(x) for x in numbers])])].astype(np.int32)
    return pa.table([docs.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))], names=names)


def encode_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCAB) -> DataFrame:
    """(doc_id, ids) of every row: token ids without special tokens, whose names in a text are
    ordinary text. A null and an empty text have an empty list. Repeated rows come out as
    often as they stand there."""
    byte_ids = vocabulary(path)[0]
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    cut = written(src.mapInArrow(_cut(PATTERN, byte_ids, path), "block long, doc_id long, data binary, width int, word string, number int"), "p7-blocks")
    used = cut.where("word IS NOT NULL").select("block", "word", "number")
    words = used.select("word").distinct()
    encoded = words.select("word", fold_merges(F.col("word"), path).alias("ids"))
    ids = used.join(encoded, "word").select(F.col("block").alias("home"), "number", "ids")
    blocks = cut.where("word IS NULL").select("block", "doc_id", "data", "width")
    return blocks.groupBy("block").cogroup(ids.groupBy("home")).applyInArrow(_gather, "doc_id long, ids array<int>")


def decode_ids(ids: Column, path: str = VOCAB) -> Column:
    """Text of a list of ids: the binary pieces joined. Unknown ids add nothing; null stays null."""
    pieces = F.from_json(F.lit(json.dumps([base64.b64encode(p).decode() for p in vocabulary(path)[2]])), "array<binary>")
    none = F.lit(b"").cast("binary")

    def joined(parts: Column, piece) -> Column:
        return F.aggregate(parts, none, lambda acc, x: F.concat(acc, F.coalesce(piece(x), none)))

    # pieces are joined to stretches and those to the text, as each step copies what it has so far
    stretch = 1_024
    starts = F.sequence(F.lit(0), F.greatest(F.size(ids) - 1, F.lit(0)), F.lit(stretch))
    whole = lambda p: joined(F.transform(starts, lambda s: joined(F.slice(ids, s + 1, F.lit(stretch)), lambda i: F.get(p, i))), lambda x: x)
    return F.when(ids.isNotNull(), F.decode(_let(pieces, whole), "UTF-8"))


@functools.lru_cache(maxsize=2)
def encoder(ranks_path: str = RANKS):
    """The public library's encoder over the rank file, for counting tokens in Python."""
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(f"ranks-{zlib.crc32(ranks_path.encode())}", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class WordSizes(dict):
    """Number of tokens of each pre-token, found when first asked for; starts anew at a million
    entries, so that memory stays bounded."""

    def __init__(self, ranks_path: str = RANKS):
        super().__init__()
        self.encode = encoder(ranks_path).encode_ordinary

    def __missing__(self, word: str) -> int:
        if len(self) >= 1_000_000:
            self.clear()
        self[word] = n = len(self.encode(word))
        return n


@functools.lru_cache(maxsize=2)
def word_sizes(ranks_path: str = RANKS) -> WordSizes:
    """One cache per Python worker."""
    return WordSizes(ranks_path)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), ranks_path: str = RANKS) -> DataFrame:
    """(id, *keep, tokens) of every row; null and empty texts have 0 tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find, size = regex.compile(PATTERN).findall, word_sizes(ranks_path).__getitem__
        for b in batches:
            n = [sum(map(size, find(t))) if t else 0 for t in b.column(text_col).to_pylist()]
            yield pa.record_batch([*(b.column(c) for c in (id_col, *keep)), pa.array(n, pa.int64())], names=[id_col, *keep, "tokens"])

    cols = docs.select(id_col, *keep)
    schema = ", ".join(f"`{c}` {t}" for c, t in cols.dtypes) + ", tokens long"
    return docs.select(id_col, *keep, text_col).mapInArrow(run, schema)


def session_vocab(spark: SparkSession) -> str:
    """Path of the vocabulary file: the session's loomline.vocab, else the default."""
    return spark.conf.get("loomline.vocab", VOCAB)
