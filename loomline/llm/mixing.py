"""Problem 8: mixing sources to target weights by a low-discrepancy schedule.

The mixture is a row of slots, each of about the same number of tokens. Slot i draws its source by
mapping the i-th golden-ratio point through the cumulative shares, so every stretch of the
mixture has the sources in their shares. Each source's documents, shuffled anew on each
pass, are cut into blocks of a slot's size; the r-th slot of a source gets its r-th block.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.session import BROADCAST_ROWS, written

#: Tokens of a slot.
BLOCK_TOKENS = 8_192
#: Documents of a source, or slots, that are numbered by one task.
CHUNK = 5_000
_GOLDEN = (math.sqrt(5) - 1) / 2


def fill(weights: dict[str, float], most: dict[str, float], total: float) -> dict[str, float]:
    """Amount of each source: in proportion to the weights, none above its most; what a capped
    source lacks goes to the others in proportion, as far as they reach."""
    out = {s: 0.0 for s in weights}
    open_ = {s for s, w in weights.items() if w > 0 and most.get(s, 0) > 0}
    left = total
    while open_:
        scale = left / sum(weights[s] for s in open_)
        capped = {s for s in open_ if weights[s] * scale >= most[s]}
        if not capped:
            return out | {s: weights[s] * scale for s in open_}
        for s in capped:
            out[s] = most[s]
            left -= most[s]
        open_ -= capped
        if left <= 0:
            break
    return out


def running(df: DataFrame, keys: list[str], chunk: str, order: list[Column], amount: Column, name: str) -> DataFrame:
    """Exclusive running sum of an amount per key in the order of (chunk, order), made of sums
    within chunks and sums over chunks, so that no task sees all rows of a key."""
    inside = Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*keys, chunk).agg(F.sum(amount).alias("__a")).withColumn("__before", F.coalesce(F.sum("__a").over(over), F.lit(0))).drop("__a")
    return df.withColumn(name, F.coalesce(F.sum(amount).over(inside), F.lit(0))).join(sums, [*keys, chunk]).withColumn(name, F.col(name) + F.col("__before")).drop("__before")


def plan(sizes: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> list[dict]:
    """One entry per source of targets (a fixed table of at most BROADCAST_ROWS rows): its target and planned tokens.

    sizes: (source, tokens) rows. Of a source named twice the larger weight and cap count; a null
    or negative weight counts as 0, a null cap as 1. total_tokens: size of the mixture, by default the
    tokens of all documents of the sources with a weight. What a capped source can't give goes to the others.
    """
    have = sizes.groupBy("source").agg(F.sum("tokens").alias("available"), F.count(F.lit(1)).alias("docs"))
    want = targets.where("source IS NOT NULL").groupBy("source").agg(F.max("target_weight").alias("w"), F.max("max_repeats").alias("cap"))
    rows = want.join(have, "source", "left").limit(BROADCAST_ROWS + 1).collect()
    if len(rows) > BROADCAST_ROWS:
        raise ValueError("more target sources than can be planned at once")
    w = {r.source: max(0.0, r.w or 0.0) if r.w == r.w else 0.0 for r in rows}
    cap = {r.source: max(0, 1 if r.cap is None else r.cap) for r in rows}
    size = {r.source: r.available or 0 for r in rows}
    total = total_tokens if total_tokens is not None else sum(size[s] for s in w if w[s] > 0)
    amount = fill(w, {s: float(cap[s] * size[s]) for s in w}, float(total))
    whole = sum(w.values()) or 1.0
    return [
        {"source": r.source, "target_weight": r.w, "max_repeats": r.cap, "target_share": w[r.source] / whole, "available": size[r.source],
         "planned": amount[r.source], "passes": math.ceil(amount[r.source] / size[r.source] - 1e-12) if size[r.source] else 0}
        for r in sorted(rows, key=lambda r: r.source)
    ]


_PLAN = "source string, target_weight double, max_repeats int, target_share double, available long, planned double, passes int"


def mixture(sizes: DataFrame, planned: list[dict], block_tokens: int = BLOCK_TOKENS, seed: int = 17) -> DataFrame:
    """(slot, place, source, doc_id, pass, tokens): the documents of the mixture in order.

    sizes: (doc_id, source, tokens), one row per document; documents without tokens, without a
    source or of a source without a share don't come in. A document belongs to the block
    its first token falls into and, on a source's last pass, comes in if half of it does.
    """
    spark = sizes.sparkSession
    used = [p for p in planned if p["planned"] > 0]
    info = F.broadcast(spark.createDataFrame([tuple(p.values()) for p in used], _PLAN).select("source", "available", "planned", "passes"))
    docs = sizes.where("tokens > 0").select("doc_id", "source", F.col("tokens").cast("long").alias("tokens")).join(info, "source")
    docs = docs.withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)))
    docs = docs.withColumn("h", F.xxhash64("doc_id", "pass", F.lit(seed)))
    # chunks of the shuffled order: ranges of the hash, as many as keep each near CHUNK documents
    width = max(1, math.ceil(sum(p["docs"] for p in _counts(sizes, used)) / CHUNK))
    docs = docs.withColumn("chunk", F.pmod(F.shiftright("h", 40), F.lit(width)))
    placed = running(docs, ["source", "pass"], "chunk", [F.col("h"), F.col("doc_id")], F.col("tokens"), "at")
    placed = placed.withColumn("at", F.col("at") + F.col("pass") * F.col("available")).where(F.col("at") + F.col("tokens") / 2 <= F.col("planned"))
    placed = placed.withColumn("block", F.floor(F.col("at") / block_tokens))
    slots = schedule(spark, {p["source"]: p["planned"] for p in used}, block_tokens)
    total = sum(p["planned"] for p in used)
    beyond = F.lit(math.ceil(total / block_tokens) * 4 + 1_024) + F.col("block")
    return placed.join(slots, ["source", "block"], "left").select(
        F.coalesce("slot", beyond).alias("slot"), (F.col("at") - F.col("block") * block_tokens).alias("place"), "source", "doc_id", "pass", "tokens",
    )


def _counts(sizes: DataFrame, used: list[dict]) -> list[dict]:
    names = [p["source"] for p in used]
    n = sizes.where("tokens > 0").where(F.col("source").isin(names)).groupBy("source").count().collect() if names else []
    return [{"source": r[0], "docs": r[1]} for r in n]


def schedule(spark, amounts: dict[str, float], block_tokens: int) -> DataFrame:
    """(slot, source, block): which block of which source each slot holds, of as many slots as
    the amounts fill and a fourth more, so that late blocks of small sources find theirs."""
    total = sum(amounts.values())
    names, upto, acc = [], [], 0.0
    for s, a in sorted(amounts.items()):
        acc += a / total if total else 0.0
        names.append(s)
        upto.append(acc)
    count = math.ceil(total / block_tokens * 1.25) + 64 if total else 0
    source: Column = F.lit(names[-1] if names else None).cast("string")
    for s, u in list(zip(names, upto, strict=True))[-2::-1]:
        source = F.when(F.col("u") < u, F.lit(s)).otherwise(source)
    slots = spark.range(count).select(F.col("id").alias("slot"), F.pmod((F.col("id") + 0.5) * F.lit(_GOLDEN), F.lit(1.0)).alias("u"))
    slots = slots.select("slot", source.alias("source"), F.floor(F.col("slot") / CHUNK).alias("chunk"))
    return running(slots, ["source"], "chunk", [F.col("slot")], F.lit(1), "block").select("slot", "source", F.col("block").cast("long").alias("block"))


def mix(docs: DataFrame, targets: DataFrame, count_tokens, total_tokens: int | None = None, block_tokens: int = BLOCK_TOKENS) -> tuple[DataFrame, list[dict]]:
    """The mixture of docs (doc_id, source, text) and its plan; count_tokens as bpe.token_counts."""
    wanted = targets.select("source").where("source IS NOT NULL").distinct()
    few = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    own = docs.select("doc_id", "source", "text").join(F.broadcast(wanted) if few else wanted, "source", "left_semi")
    sizes = written(count_tokens(own, "doc_id", "text", keep=("source",)), "p8-sizes")
    planned = plan(sizes, targets, total_tokens)
    return mixture(sizes, planned, block_tokens), planned


def shares(mixed: DataFrame, planned: list[dict]) -> DataFrame:
    """Per source of the targets: target and actual share, tokens, documents, repeats (tokens by available tokens)."""
    spark = mixed.sparkSession
    got = mixed.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"), F.max(F.col("pass") + 1).alias("passes_used"))
    info = spark.createDataFrame([tuple(p.values()) for p in planned], _PLAN)
    tokens = F.coalesce("tokens", F.lit(0))
    out = info.join(F.broadcast(got), "source", "left").withColumn("tokens", tokens)
    # one row per target source, so the total is over a bounded table
    total = F.sum("tokens").over(Window.partitionBy())
    return out.select(
        "source", "target_weight", "max_repeats", "target_share", "available", "tokens", F.coalesce("rows", F.lit(0)).alias("documents"),
        F.coalesce(F.col("tokens") / F.nullif(total, F.lit(0)), F.lit(0.0)).alias("actual_share"),
        F.coalesce(F.col("tokens") / F.nullif(F.col("available"), F.lit(0)), F.lit(0.0)).alias("repeats"), F.coalesce("passes_used", F.lit(0)).alias("passes"),
    )
