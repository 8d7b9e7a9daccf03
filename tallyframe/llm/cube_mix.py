"""Mixing sources to target word counts by cube-method balanced sampling.

Every document of a source is wanted at the same rate: target over size. The
whole part of the rate is taken for sure; the fractional part is an inclusion
probability. The cube method's flight moves three undecided probabilities at a
time along the null space of the two balancing equations (documents, words)
until one of them is 0 or 1, so both totals stay what they were. It runs in
blocks of a source; the at most two undecided documents of each block meet in
the blocks of the next level, until one block is left for a source. There a
dozen documents of all sizes wait; with the two that the flight leaves they are the
landing, of which all roundings are tried for the closest totals.
"""

from __future__ import annotations

import random
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import map_rows, spaced_words, stored

_EDGE = 1e-9
LANDING = 12  # documents that the last flight leaves aside, so that the landing can come close
_KINDS = (
    "_source string, _null boolean, doc_id bigint, key bigint, size bigint, chance double, whole int, "
    "source_size bigint, target double"
)
_NAMES = [k.split()[0] for k in _KINDS.split(", ")]


def source_targets(
    sizes: list[tuple[str | None, int]], share: float, cap: float, weights: tuple[float, ...]
) -> dict[str | None, float]:
    """Words wanted of each source: share of all words by weight, none above cap times its size, the excess shared again."""
    order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {s: float(weights[i % len(weights)]) for i, (s, _) in enumerate(order)}
    size, targets, left = dict(order), {}, share * sum(n for _, n in order)
    open_ = [s for s, _ in order]
    while open_:
        total = sum(weight[s] for s in open_)
        above = [s for s in open_ if left * weight[s] / total > cap * size[s]]
        if not above:
            return targets | {s: left * weight[s] / total for s in open_}
        for s in above:
            targets[s] = cap * size[s]
        left -= sum(targets[s] for s in above)
        open_ = [s for s in open_ if s not in targets]
    return targets


def flight(sizes: list[int], chances: list[float], rng: random.Random) -> list[float]:
    """Probabilities moved to 0 or 1, all but two at most, with their sum and their size-weighted sum kept."""
    p, active, nxt = list(chances), [], 0
    while True:
        while len(active) < 3 and nxt < len(p):
            if _EDGE < p[nxt] < 1 - _EDGE:
                active.append(nxt)
            nxt += 1
        if len(active) == 3:
            a, b, c = (sizes[i] for i in active)
            move = [c - b, a - c, b - a] if a != b or b != c else [1, -1, 0]
        elif len(active) == 2 and sizes[active[0]] == sizes[active[1]]:
            move = [1, -1]
        else:
            return p
        up = min((1 - p[i]) / u if u > 0 else p[i] / -u for i, u in zip(active, move, strict=True) if u)
        down = min(p[i] / u if u > 0 else (1 - p[i]) / -u for i, u in zip(active, move, strict=True) if u)
        step = up if rng.random() * (up + down) < down else -down
        for i, u in zip(active, move, strict=True):
            p[i] += step * u
            if p[i] <= _EDGE:
                p[i] = 0.0
            elif p[i] >= 1 - _EDGE:
                p[i] = 1.0
        active = [i for i in active if 0.0 < p[i] < 1.0]


def landing(sizes: list[int], p: list[float]) -> list[float]:
    """The few probabilities left rounded so that the words, then the documents, stay closest; all ways are tried."""
    left = [i for i, x in enumerate(p) if 0.0 < x < 1.0]
    ways = (np.arange(1 << len(left))[:, None] >> np.arange(len(left))) & 1
    off = ways - np.array([p[i] for i in left])
    words, rows = np.abs(off @ np.array([sizes[i] for i in left], dtype=float)), np.abs(off.sum(1))
    best = ways[np.lexsort((rows.round(6), words.round(6)))[0]]
    for i, x in zip(left, best.tolist(), strict=True):
        p[i] = float(x)
    return p


def _key() -> Column:
    """What tells rows apart; rows that agree in it are repeated rows."""
    return F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))


def _sizes(docs: DataFrame) -> DataFrame:
    def work(ids: list, texts: list, sources: list, keys: list) -> dict[str, pa.Array]:
        return {
            "doc_id": pa.array(ids, pa.int64()),
            "source": pa.array(sources, pa.binary()).cast(pa.string()),
            "size": pa.array([len(spaced_words(t)) for t in texts], pa.int64()),
            "key": pa.array(keys, pa.int64()),
        }

    kinds = {"doc_id": "bigint", "text": "string", "source": "string", "key": "bigint"}
    rows = docs.select("doc_id", "text", "source", _key().alias("key"))
    return map_rows(rows, kinds, work, "doc_id bigint, source string, size bigint, key bigint")


def _decider(depth: int, last: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Flight, and on the last level landing, of one block; the random choices follow from its rows."""

    def decide(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["size", "key", "doc_id"], ascending=[False, True, True], kind="stable")
        sizes, seed = block["size"].tolist(), f"{depth}:{block['_source'].iloc[0]}:{block['key'].min()}"
        p, n = block["chance"].tolist(), len(sizes)
        aside = {k * n // LANDING for k in range(LANDING)} if last else set()  # all sizes, from the largest down
        fly = [i for i in range(n) if i not in aside]
        for i, x in zip(fly, flight([sizes[i] for i in fly], [p[i] for i in fly], random.Random(seed)), strict=True):
            p[i] = x
        return block[_NAMES].assign(chance=np.array(landing(sizes, p) if last else p, dtype=float))

    return decide


def mix_sources(
    docs: DataFrame,
    share: float = 1.5,
    cap: float = 2.0,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    block_rows: int = 2000,
) -> DataFrame:
    """doc_id, source, key, size, source_size, target, copies and taken (copies * size) per row of docs.

    Sources stand by code point, null last; the weights repeat over them.
    size: words between white space, 0 for null. Documents without a word are
    taken 0 times, and so is a source without words. key is a hash of id and
    text; random choices depend only on it and the source, so reruns agree.
    One row per source passes through the driver, no documents do.
    """
    spark = docs.sparkSession
    rows = stored(_sizes(docs), "sizes")
    totals = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count_if(F.col("size") > 0).alias("n")).collect()
    targets = source_targets([(r["source"], r["size"]) for r in totals], share, cap, weights)
    plan = spark.createDataFrame(
        [
            (r["source"] or "", r["source"] is None, r["size"], float(targets[r["source"]]), max(1, -(-r["n"] // block_rows)))
            for r in totals
        ],
        "_source string, _null boolean, source_size long, target double, blocks long",
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    named = rows.join(
        plan, (F.coalesce("source", F.lit("")) == F.col("_source")) & (F.col("source").isNull() == F.col("_null")), "left"
    ).withColumn("whole", F.when(F.col("size") > 0, F.floor(rate + _EDGE)).otherwise(0).cast("int"))
    level = named.withColumn("chance", F.when(F.col("size") > 0, F.greatest(rate - F.col("whole"), F.lit(0.0))).otherwise(0.0))
    sure = level.where(F.col("chance") <= _EDGE).select(*_NAMES)
    level = level.where(F.col("chance") > _EDGE).select(*_NAMES, "blocks")
    parts, depth, most = [sure], 0, max((-(-r["n"] // block_rows) for r in totals), default=0)
    while most:
        last = most == 1

        spread = F.pmod(F.xxhash64("key", F.lit(depth)), F.col("blocks"))
        done = stored(level.groupBy("_source", "_null", spread.alias("_block")).applyInPandas(_decider(depth, last), _KINDS), f"level{depth}")
        decided = F.col("chance").isin(0.0, 1.0)
        parts.append(done.where(decided))
        if last:
            break
        level = done.where(~decided)
        counts = level.groupBy("_source", "_null").agg(F.ceil(F.count("*") / block_rows).cast("long").alias("blocks"))
        most = max((r["blocks"] for r in counts.collect()), default=0)  # one row per source
        level = level.join(counts, ["_source", "_null"])
        depth += 1
    mixed = parts[0]
    for part in parts[1:]:
        mixed = mixed.unionByName(part)
    copies = (F.col("whole") + F.col("chance").cast("int")).cast("int")
    return mixed.select(
        "doc_id",
        F.when(~F.col("_null"), F.col("_source")).alias("source"),
        "key",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def apply_mix(docs: DataFrame, **settings) -> DataFrame:
    """docs(doc_id, text, lang, source, n_chars) that the mix takes, each with `copies`, how often it is to be read.

    Rows that repeat id, source and text become one row with the copies of all of them, so the words taken are
    those of the mix; of other columns that differ among them the smallest values stay. Null ids, sources and
    texts are values like others.
    """
    columns = ("doc_id", "text", "lang", "source", "n_chars")
    taken = (
        mix_sources(docs, **settings)
        .groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_from"), F.col("key").alias("_key"))
        .agg(F.sum("copies").cast("int").alias("copies"), F.count("*").alias("_rows"))
        .where(F.col("copies") > 0)
    )
    rows = docs.select(*columns, _key().alias("_of"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_from")) & (F.col("_of") == F.col("_key"))
    chosen = rows.join(taken, same)
    # Only rows that do repeat are gathered by id and text.
    alone = chosen.where(F.col("_rows") == 1).select(*columns, "copies")
    merged = (
        chosen.where(F.col("_rows") > 1)
        .groupBy("doc_id", "source", "_of", "copies")
        .agg(*(F.min(name).alias(name) for name in ("text", "lang", "n_chars")))
    )
    return alone.unionByName(merged.select(*columns, "copies"))
