"""Vector and interval functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def l2_normalize(a: Column) -> Column:
    """Unit vector; an all-zero vector stays as it is."""
    n = norm(a)
    return F.when(n > 0, F.transform(a, lambda x: x / n)).otherwise(F.transform(a, lambda x: x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def similarity(dist: Column) -> Column:
    """2 - squared distance of unit vectors (twice the cosine); no distance counts as 2."""
    return F.lit(2.0) - F.coalesce(F.nanvl(dist.cast("double"), F.lit(2.0)), F.lit(2.0))


def margin(sim: Column, avg_a: Column, avg_b: Column, kind: str = "ratio") -> Column:
    b = (avg_a + avg_b) / 2
    return {"ratio": F.try_divide(sim, b), "distance": sim - b, "absolute": sim}[kind]


def unsupervised_quality(mt: Column, src: Column, ref: Column | None = None) -> Column:
    return cosine(mt, src) + cosine(mt, ref) if ref is not None else cosine(mt, src)


def comparison_features(ref: Column, mt: Column, src: Column) -> Column:
    prod = lambda a, b: F.zip_with(a, b, lambda x, y: x * y)
    diff = lambda a, b: F.zip_with(a, b, lambda x, y: F.abs(x - y))
    return F.concat(ref, mt, prod(src, mt), prod(ref, mt), diff(mt, src), diff(mt, ref))


def overlap(s1: Column, e1: Column, f1: Column, s2: Column, e2: Column, f2: Column, method: str = "fraction") -> Column:
    """Overlap of two segments: its share of the longer one, or of their union; 0 where they are apart."""
    common = (F.least(e1, e2) - F.greatest(s1, s2)) / f1
    d1, d2 = (e1 - s1) / f1, (e2 - s2) / f2
    whole = F.greatest(d1, d2) if method == "fraction" else d1 + d2 - common
    return F.when(common <= 0, F.lit(0.0)).otherwise(F.try_divide(common, whole))


def duration(start: Column, end: Column, factor: Column) -> Column:
    return (end - start) / factor


def parse_segment(c: Column, factor: int | None = None) -> Column:
    """struct(kind, content, path, start, end, factor) of a side of a mined line: `path|start|end|factor`,
    `path|start|end` (which needs a given factor), `path start end ignored` (factor 16), else a text."""
    full = r"^([^|]*)\|([0-9]+)\|([0-9]+)\|([0-9]+)$"
    three = r"^([^|]*)\|([0-9]+)\|([0-9]+)$"
    blank = r"^([^ ]*) ([0-9]+) ([0-9]+) [^ ]*$"

    def audio(p: str, f: Column) -> Column:
        g = lambda i: F.regexp_extract(c, p, i)
        num = lambda i: F.try_to_number(g(i), F.lit("9" * 18)).cast("long")
        return F.struct(F.lit("audio").alias("kind"), F.lit(None).cast("string").alias("content"), g(1).alias("path"), num(2).alias("start"), num(3).alias("end"), f.alias("factor"))

    text = F.struct(F.lit("text").alias("kind"), c.alias("content"), F.lit(None).cast("string").alias("path"), F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("end"), F.lit(None).cast("long").alias("factor"))
    out = F.when(c.rlike(full), audio(full, F.try_to_number(F.regexp_extract(c, full, 4), F.lit("9" * 18)).cast("long")))
    if factor is not None:
        out = out.when(c.rlike(three), audio(three, F.lit(factor).cast("long")))
    return out.when(c.rlike(blank), audio(blank, F.lit(16).cast("long"))).otherwise(text)


def segment_text(s: Column, sep: str = "|") -> Column:
    """The text of a parsed segment, as parse_segment() reads it; null for plain text."""
    return F.when(s["kind"] == "audio", F.concat_ws(sep, s["path"], s["start"].cast("string"), s["end"].cast("string"), s["factor"].cast("string")))


def long_enough(score: Column, s: Column, threshold: float, seconds: float) -> Column:
    """Whether a segment's score and its duration in seconds (ticks are factor * 1000 a second) are above both limits."""
    return (score > threshold) & ((s["end"] - s["start"]) / (s["factor"] * 1000) > seconds)
