"""Problem 4: the language of every document and of every stretch of it.

A bidirectional gated recurrent network reads the bytes of each sentence from both ends and labels
every position with language scores; it is trained here, in numpy, by backpropagation through time on
a bounded sample of labelled documents. The scores of positions are pooled to sentences, sentences to
segments by dynamic programming, and everything to document probabilities.
"""

from __future__ import annotations

import hashlib
import html
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.session import written

#: Bound of the training sample: documents per language, and bytes of a document.
SAMPLE_DOCS, SAMPLE_BYTES = 200, 8_192
#: Gain in pooled log probability that a further segment has to bring.
SEGMENT_COST = 8.0
#: Positions that count as one independent observation when a sentence is pooled.
OBSERVED = 6.0
#: A sentence of more bytes is read in chunks of this size, which share this many bytes with the next.
CHUNK, SHARED = 640, 64
_HIDDEN, _SPAN, _BATCH, _STEPS, _SMOOTH = 12, 48, 160, 240, 0.02
#: Sentences read side by side, and bytes of text that are labelled at once.
_SIDE, _BYTES = 4_096, 4 << 20

# Other names of the languages in labels.
ALIASES = {
    "eng": "en eng english", "fra": "fr fra fre french", "deu": "de deu ger german", "spa": "es spa spanish castilian",
    "ita": "it ita italian", "por": "pt por portuguese", "nld": "nl nld dut dutch flemish", "rus": "ru rus russian",
}

_CODE = re.compile(r"```.*?(?:```|\Z)|`[^`\n]*`", re.S)
_TAG = re.compile(r"<[^<>\n]{1,200}>")
_LINK = re.compile(r"\w+://\S+|\bwww\.\S+|\S+@\S+\.\w+")
_HIDDEN_CHARS = re.compile("[­​-‏⁠﻿]")
_ENDS = re.compile(r"[.!?…]+(?=\s|$)|\n")
#: Signs of one byte only separate words, digits and underscores become 0, bytes of longer characters are kept.
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 48 if chr(b).isdigit() or b == 95 else 32 for b in range(256))


def known_label(label: str | None, langs: list[str]) -> str | None:
    """The language of langs (as eng_Latn) that a label names, or None."""
    if not label:
        return None
    name = re.split(r"[-_\s]", label.strip().lower())[0]
    for lang in langs:
        if name in ALIASES.get(lang[:3], lang[:3]).split():
            return lang
    return None


def clean(text: str) -> str:
    """Lower-case text without code, markup, links and invisible characters, composed."""
    if "&" in text:
        text = html.unescape(text)
    if "`" in text:
        text = _CODE.sub("\n", text)
    if "<" in text:
        text = _TAG.sub("", text)
    if "://" in text or "www." in text or "@" in text:
        text = _LINK.sub(" ", text)
    if not text.isascii():
        text = unicodedata.normalize("NFC", _HIDDEN_CHARS.sub("", text))
    return text.lower()


# ---------------------------------------------------------------- the network


class ByteGRU:
    """Gated recurrent layers in both directions over bytes, with language scores at every position.

    Gates are piecewise linear (clipped to 0..1, the candidate to -1..1). The byte embedding is folded
    into the input weights of each gate: x is a table of bytes by hidden units, u acts on the state.
    """

    def __init__(self, langs: int, hidden: int = _HIDDEN, seed: int = 3):
        r = np.random.default_rng(seed)
        self.h, self.langs = hidden, langs
        f = np.float32
        start = {"z": 0.7, "r": 0.5, "n": 0.0}
        self.p = {
            **{f"x{g}{d}": (start[g] + r.standard_normal((256, hidden)) * 0.2).astype(f) for d in "fb" for g in "zrn"},
            **{f"u{g}{d}": (r.standard_normal((hidden, hidden)) * 0.5 / np.sqrt(hidden)).astype(f) for d in "fb" for g in "zrn"},
            **{f"w{d}": (r.standard_normal((hidden, langs)) / np.sqrt(hidden)).astype(f) for d in "fb"},
            "b": np.zeros(langs, f),
        }

    def _summed(self, d: str, flat: np.ndarray, first: np.ndarray, size: np.ndarray, way: int) -> np.ndarray:
        """Sum of the states at all positions of each sequence. Sequences come longest first, so
        those still running at a step stand at the front."""
        p, h, n = self.p, self.h, len(first)
        state, total = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        z, r, c, x = (np.empty((n, h), np.float32) for _ in range(4))
        running = n - np.searchsorted(size[::-1], np.arange(int(size[0])), side="right")
        for t, k in enumerate(running.tolist()):
            at = flat[first[:k] + way * t]
            s, zk, rk, ck, xk = state[:k], z[:k], r[:k], c[:k], x[:k]
            for gate, out, low in (("z", zk, 0.0), ("r", rk, 0.0), ("n", ck, -1.0)):
                np.matmul(rk if gate == "n" else s, p[f"u{gate}{d}"], out=out)
                out += np.take(p[f"x{gate}{d}"], at, 0, out=xk, mode="clip")
                np.clip(out, low, 1.0, out=out)
                if gate == "r":
                    rk *= s
            s -= ck
            s *= zk
            s += ck
            total[:k] += s
        return total

    def score(self, lines: list[bytes]) -> np.ndarray:
        """Scores (n, langs) of byte sequences, summed over their positions. The scores of a position are its
        log probabilities but for a term all languages have in common, so their sums compare alike."""
        flat = np.frombuffer(b"".join(lines), np.uint8).astype(np.intp)
        size = np.array([len(x) for x in lines], np.int64)
        first = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64) if len(lines) else size
        order = np.argsort(-size, kind="stable")
        out = np.zeros((len(lines), self.langs), np.float32)
        for lo in range(0, len(order), _SIDE):
            some = order[lo : lo + _SIDE]
            if not size[some[0]]:
                break
            f = self._summed("f", flat, first[some], size[some], 1)
            b = self._summed("b", flat, first[some] + size[some] - 1, size[some], -1)
            out[some] = f @ self.p["wf"] + b @ self.p["wb"] + size[some, None] * self.p["b"]
        return out

    def _states(self, d: str, bytes_: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        """(state before, z, r, candidate, state after) at each step of sequences of one length."""
        p, s, tape = self.p, np.zeros((bytes_.shape[1], self.h), np.float32), []
        for at in bytes_:
            z = np.clip(s @ p[f"uz{d}"] + p[f"xz{d}"][at], 0, 1)
            r = np.clip(s @ p[f"ur{d}"] + p[f"xr{d}"][at], 0, 1)
            c = np.clip((r * s) @ p[f"un{d}"] + p[f"xn{d}"][at], -1, 1)
            new = z * s + (1 - z) * c
            tape.append((s, z, r, c, new))
            s = new
        return tape

    def labels(self, bytes_: np.ndarray) -> tuple[np.ndarray, list, list]:
        """Log probabilities (T, B, langs) of every position of sequences (T, B), and the tapes of both layers."""
        tf, tb = self._states("f", bytes_), self._states("b", bytes_[::-1])
        hf, hb = np.stack([x[4] for x in tf]), np.stack([x[4] for x in tb[::-1]])
        logits = hf @ self.p["wf"] + hb @ self.p["wb"] + self.p["b"]
        logits -= logits.max(2, keepdims=True)
        return logits - np.log(np.exp(logits).sum(2, keepdims=True)), tf, tb

    def gradients(self, bytes_: np.ndarray, target: np.ndarray) -> tuple[float, dict]:
        """Mean loss over all positions of sequences (T, B) of the languages `target` (B), and its gradients by
        backpropagation through time, in both directions."""
        p, (steps, n) = self.p, bytes_.shape
        lp, tf, tb = self.labels(bytes_)
        dl = np.exp(lp)
        # a share of each label goes to the other languages, which bounds what one position can say
        wanted = np.full((n, self.langs), _SMOOTH / max(1, self.langs - 1), np.float32)
        wanted[np.arange(n), target] = 1 - _SMOOTH
        loss = -float((lp * wanted).sum(2).mean())
        dl -= wanted
        dl /= steps * n
        g = {"b": dl.sum((0, 1))}
        for d, tape, rows, down in (("f", tf, bytes_, dl), ("b", tb, bytes_[::-1], dl[::-1])):
            g[f"w{d}"] = np.tensordot(np.stack([x[4] for x in tape]), down, ((0, 1), (0, 1)))
            back = down @ p[f"w{d}"].T
            carry = np.zeros((n, self.h), np.float32)
            pre = np.empty((steps, n, 3 * self.h), np.float32)
            for k in "zrn":
                g[f"u{k}{d}"] = np.zeros_like(p[f"u{k}{d}"])
            for t in range(steps - 1, -1, -1):
                s, z, r, c, _ = tape[t]
                dh = carry + back[t]
                dn = dh * (1 - z) * (np.abs(c) < 1)
                dz = dh * (s - c) * ((z > 0) & (z < 1))
                drs = dn @ p[f"un{d}"].T
                dr = drs * s * ((r > 0) & (r < 1))
                np.concatenate([dz, dr, dn], 1, out=pre[t])
                g[f"uz{d}"] += s.T @ dz
                g[f"ur{d}"] += s.T @ dr
                g[f"un{d}"] += (r * s).T @ dn
                carry = dh * z + drs * r + dz @ p[f"uz{d}"].T + dr @ p[f"ur{d}"].T
            flat = rows.reshape(-1)
            order = np.argsort(flat, kind="stable")
            values, starts = np.unique(flat[order], return_index=True)
            table = np.zeros((256, 3 * self.h), np.float32)
            table[values] = np.add.reduceat(pre.reshape(-1, 3 * self.h)[order], starts, axis=0)
            for i, k in enumerate("zrn"):
                g[f"x{k}{d}"] = table[:, i * self.h : (i + 1) * self.h]
        return loss, g

    def fit(self, lines: list[bytes], langs: np.ndarray, steps: int = _STEPS, batch: int = _BATCH, span: int = _SPAN, rate: float = 0.02, seed: int = 5) -> list[float]:
        """Adam over random spans of the text of each language, all languages alike; the loss of each step.

        After a third of the steps, lines that the network gives another language than their label are left out: some labels are wrong."""
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        losses: list[float] = []
        texts = _joined(lines, langs, self.langs, span)
        for step in range(1, steps + 1):
            if step == steps // 3:
                sure = self.score(lines).argmax(1) == langs
                texts = _joined([x for x, ok in zip(lines, sure, strict=True) if ok], langs[sure], self.langs, span)
            known = [k for k, t in enumerate(texts) if len(t) >= span]
            if not known:
                break
            target = np.array(known)[np.arange(batch) % len(known)]
            at = [int(r.integers(0, len(texts[k]) - span + 1)) for k in target]
            rows = np.stack([texts[k][a : a + span] for k, a in zip(target, at, strict=True)], 1)
            loss, g = self.gradients(rows, target)
            losses.append(loss)
            lr = rate * min(1, step / 20) * (1 - 0.95 * step / steps)
            for k in self.p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v2[k] = 0.99 * v2[k] + 0.01 * g[k] * g[k]
                self.p[k] -= (lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return losses


def _joined(lines: list[bytes], langs: np.ndarray, count: int, span: int) -> list[np.ndarray]:
    return [np.frombuffer(b"".join(x for x, own in zip(lines, langs, strict=True) if own == k), np.uint8).astype(np.intp) for k in range(count)]


def sentences(text: str) -> list[bytes]:
    """The sentences of a text that have words, as the network reads them: words without digits or underscores
    (which are numbers, codes and names of files), between single blanks."""
    out = []
    for line in _ENDS.sub("\n", clean(text)).split("\n"):
        raw = line.encode().translate(_LETTERS)
        words = raw.split()
        if b"0" in raw:
            words = [w for w in words if b"0" not in w]
        if words and (raw.isascii() or any(map(str.isalpha, line))):
            out.append(b" " + b" ".join(words) + b" ")
    return out


def sample(docs: DataFrame, langs: list[str], sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> list:
    """(text, lang, doc_id) of at most sample_docs documents per language whose label is exactly one of langs, of at
    most sample_bytes bytes each: those with the least hash of their id. They are found by a bound on the hash
    that follows from the number of documents of each language, so no task sorts a language."""
    own = docs.where(F.col("lang").isin(langs) & (F.octet_length("text") <= sample_bytes))
    found = {r["lang"]: r["count"] for r in own.groupBy("lang").count().collect()}
    near = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    most = F.lit(0)
    for lang, n in sorted(found.items()):
        share = min(1.0, (1.3 * sample_docs + 40) / n)
        most = F.when(F.col("lang") == lang, F.lit(int(share * (1 << 30)))).otherwise(most)
    rows = own.where(near < most).select("text", "lang", "doc_id", near.alias("near")).collect()
    rows.sort(key=lambda r: (r.lang, r.near, r.doc_id))
    out, seen = [], dict.fromkeys(langs, 0)
    for r in rows:
        seen[r.lang] += 1
        if seen[r.lang] <= sample_docs:
            out.append(r)
    return out


_fitted: dict[str, ByteGRU] = {}


def train(docs: DataFrame, langs: list[str], sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> ByteGRU:
    """A network fitted on the sentences of sample(). The same sample is fitted once per process."""
    rows = sample(docs, langs, sample_docs, sample_bytes)
    key = hashlib.md5(repr((langs, [(r.lang, r.doc_id, r.text) for r in rows])).encode()).hexdigest()
    if key not in _fitted:
        net, lines, own = ByteGRU(len(langs)), [], []
        for r in rows:
            some = sentences(r.text)
            lines += some
            own += [langs.index(r.lang)] * len(some)
        if lines:
            net.fit(lines, np.array(own))
        _fitted.clear()
        _fitted[key] = net
    return _fitted[key]


# ---------------------------------------------------------------- pooling


def evidence(net: ByteGRU, lines: list[bytes]) -> np.ndarray:
    """Pooled log probabilities (n, langs) of sentences, that of the best language being 0. Long ones are read in
    chunks. Neighbouring positions repeat each other, so OBSERVED of them count as one."""
    parts, owner = [], []
    for i, x in enumerate(lines):
        for lo in range(0, max(1, len(x) - SHARED), CHUNK - SHARED) if len(x) > CHUNK else (0,):
            parts.append(x[lo : lo + CHUNK] if len(x) > CHUNK else x)
            owner.append(i)
    scored = net.score(parts)
    if len(parts) > len(lines):
        total = np.zeros((len(lines), net.langs), np.float32)
        np.add.at(total, owner, scored)
        scored = total
    return (scored - scored.max(1, keepdims=True)) / OBSERVED


def segments(scores: np.ndarray, cost: float = SEGMENT_COST) -> list[tuple[int, int, int]]:
    """(first sentence, end, language) of the best division of a document's sentences into segments of
    one language, each of at least two sentences where there are several."""
    n = len(scores)
    whole = scores.sum(0)
    top = int(whole.argmax())
    if n < 4 or float((scores.max(1) - scores[:, top]).sum()) <= cost:
        return [(0, n, top)]
    k = scores.shape[1]
    one, two = scores[0].astype(np.float64), np.full(k, -np.inf)
    came = np.zeros((n, 2, k), np.int16)  # for a first sentence the language before; else whether it continues one that is longer
    for s in range(1, n):
        best = np.argsort(-two)
        before = np.where(np.arange(k) == best[0], best[1], best[0])
        fresh = two[before] - cost
        longer = two >= one
        came[s, 0], came[s, 1] = before, longer
        one, two = fresh + scores[s], np.where(longer, two, one) + scores[s]
    lang = int(two.argmax())
    out, end, s, first = [], n, n - 1, False
    while s >= 0:
        if first or s == 0:
            out.append((s, end, lang))
            if s == 0:
                break
            end, lang, first = s, int(came[s, 0, lang]), False
        else:
            first = not came[s, 1, lang]
        s -= 1
    return out[::-1]


_nets: dict[str, ByteGRU] = {}


def labelled(weights: dict[str, np.ndarray], langs: int, key: str):
    """Arrow function: (doc_id, seg_no, lang number, words, confidence) of each segment of each document with words.
    The confidence is the pooled probability of the segment's language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _nets:
            net = ByteGRU(langs)
            net.p = weights
            _nets.clear()
            _nets[key] = net
        net = _nets[key]
        for b in batches:
            ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            at = 0
            while at < len(ids):
                lines: list[bytes] = []
                owner: list[int] = []
                held, start = 0, at
                while at < len(ids) and (held < _BYTES or at == start):
                    some = sentences(texts[at]) if texts[at] else []
                    lines += some
                    owner += [at] * len(some)
                    held += sum(map(len, some))
                    at += 1
                scores = evidence(net, lines)
                words = np.array([x.count(b" ") - 1 for x in lines], np.int64)
                edges = np.searchsorted(owner, np.arange(start, at + 1))
                out: list[tuple] = []
                for i, lo, hi in zip(range(start, at), edges[:-1], edges[1:], strict=True):
                    if lo == hi:
                        continue
                    for k, (s, e, lang) in enumerate(segments(scores[lo:hi])):
                        pooled = scores[lo + s : lo + e].sum(0).astype(np.float64)
                        n = max(1, int(words[lo + s : lo + e].sum()))
                        # words of a text aren't independent: their evidence counts with its root
                        out.append((ids[i], k, lang, n, float(1 / np.exp(np.minimum((pooled - pooled[lang]) / np.sqrt(n), 700)).sum())))
                cols = list(zip(*out, strict=True)) if out else [[]] * 5
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.float64())
                yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "seg_no", "l", "words", "confidence"])

    return run


def label_column(col: str, langs: list[str]):
    """known_label() as a column expression."""
    name = F.get(F.split(F.lower(F.trim(F.col(col))), r"[-_\s]"), 0)
    out = F.lit(None).cast("string")
    for lang in langs:
        out = F.when(name.isin(*ALIASES.get(lang[:3], lang[:3]).split()), F.lit(lang)).otherwise(out)
    return out


def segment_labels(docs: DataFrame, langs: list[str], net: ByteGRU) -> DataFrame:
    """(doc_id, label, several, seg_no, lang, words, confidence) of every segment of every document with
    words. label is the known language that the document's label names, or null."""
    key = hashlib.md5(b"".join(net.p[k].tobytes() for k in sorted(net.p))).hexdigest()
    inner = labelled(net.p, len(langs), key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            labels = dict(zip(b.column("doc_id").to_pylist(), b.column("label").to_pylist(), strict=True))
            for r in inner(iter([b])):
                ids = r.column("doc_id").to_pylist()
                many = {i for i, k in zip(ids, r.column("seg_no").to_pylist(), strict=True) if k}
                extra = [pa.array([labels[i] for i in ids], pa.string()), pa.array([i in many for i in ids], pa.bool_())]
                yield pa.record_batch([*r.columns, *extra], names=[*r.schema.names, "label", "several"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", label_column("lang", langs).alias("label"))
    out = src.mapInArrow(run, "doc_id long, seg_no int, l int, words long, confidence double, label string, several boolean")
    return out.withColumn("lang", F.get(F.array(*map(F.lit, langs)), F.col("l"))).drop("l")


def language_cases(docs: DataFrame, langs: list[str], net: ByteGRU | None = None) -> DataFrame:
    """(doc_id, seg_no, lang): all segments of the documents whose label is missing, unknown or of another
    language than the text, or whose text has several languages. Null, empty and wordless texts are no cases."""
    return segment_labels(docs, langs, net or train(docs, langs)).where("label IS NULL OR several OR label <> lang").select("doc_id", "seg_no", "lang")


def text_segments(docs: DataFrame, langs: list[str], net: ByteGRU | None = None) -> DataFrame:
    """(doc_id, seg_no, lang, words, confidence) of every segment of every document; a document without words (null,
    empty, or signs only) has one row with null seg_no, lang and confidence and no words."""
    net = net or train(docs, langs)
    found = written(segment_labels(docs, langs, net).select("doc_id", "seg_no", "lang", "words", "confidence"), "segments")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    none = ids.join(found.select("doc_id"), "doc_id", "left_anti")
    return found.unionByName(none.withColumn("words", F.lit(0).cast("long")), allowMissingColumns=True)


def document_languages(docs: DataFrame, langs: list[str], net: ByteGRU | None = None) -> DataFrame:
    """(doc_id, label, lang, confidence, segments): the language with most words of each document with words, with
    the word-weighted confidence of its segments times its share of the words. A document without words (null, empty, or
    signs only) has null language and confidence and no segments."""
    net = net or train(docs, langs)
    per = segment_labels(docs, langs, net).groupBy("doc_id", "label", "lang").agg(F.sum("words").alias("w"), F.sum(F.col("words") * F.col("confidence")).alias("c"), F.count(F.lit(1)).alias("n"))
    best = per.groupBy("doc_id", "label").agg(F.max(F.struct("w", "lang", "c")).alias("top"), F.sum("w").alias("all"), F.sum("n").alias("segments"))
    found = written(best.select("doc_id", "label", "top.lang", (F.col("top.c") / F.col("all")).alias("confidence"), "segments"), "documents")
    every = docs.select(F.col("doc_id").cast("long").alias("doc_id"), label_column("lang", langs).alias("label")).distinct()
    none = every.join(found.select("doc_id"), "doc_id", "left_anti").withColumn("segments", F.lit(0).cast("long"))
    return found.unionByName(none, allowMissingColumns=True)


def filter_counts(predicted: DataFrame, config: DataFrame) -> DataFrame:
    """Per label (null: unknown): documents, kept, lid_filtered (confidence below the threshold of the predicted
    language) and lid_mismatch (another language than the label). Documents without words are in documents only. config is a fixed table, one row per language."""
    limit = F.broadcast(config.groupBy("lang").agg(F.max("probability_threshold").alias("t")))
    low = F.col("confidence") < F.coalesce("t", F.lit(0.5))
    wrong = ~low & ~F.coalesce(F.col("label") == F.col("lang"), F.lit(False))
    return predicted.join(limit, "lang", "left").groupBy("label").agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(~low & ~wrong).alias("kept"), F.count_if(low).alias("lid_filtered"), F.count_if(wrong).alias("lid_mismatch"))
