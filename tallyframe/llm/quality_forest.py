"""Quality rules judged by an isolation forest over rule statistics.

One pass over the texts makes a small row of counts per document, stored as a
table. Trees of random splits are grown from it, each on `tree_rows` documents
drawn by hash (the subsampling that is part of the method); documents that few
splits isolate are anomalous. The rejecting score is calibrated on all rows
that carry a quality label.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import map_rows, spaced_words, stored

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_digits")
_SPACE = b" \t\n\r\x0b\x0c"
_INNER = bytes(range(0x80, 0xC0))  # UTF-8 bytes that begin no code point
_UPPER, _MARKS, _DIGITS = bytes(range(0x41, 0x5B)), b"!?", bytes(range(0x30, 0x3A))
_SYMBOLS = b"#*$%&|<>"


def repeated_words(words: list[bytes], size: int = 5) -> int:
    """Words inside windows of `size` words that stand twice or more in the list."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    seq = np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64)
    if len(ids) == len(words):
        return 0
    key = seq[:n].copy()
    for j in range(1, size):  # ranks stay below n after each step, so nothing overflows
        key = key * len(ids) + seq[j : j + n]
        if j < size - 1 and len(ids) > 2000:
            key = np.unique(key, return_inverse=True)[1]
    order = np.argsort(key, kind="stable")
    same = np.diff(key[order]) == 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + size, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def rule_counts(text: bytes | None) -> tuple[int, ...]:
    """COUNTS of one text; all zero for null."""
    if not text:
        return (0,) * len(COUNTS)
    words, seen, dup, lines = spaced_words(text), set(), 0, 0
    for line in text.split(b"\n"):
        if line.strip(_SPACE):
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    without = lambda chars: len(text) - len(text.translate(None, chars))
    return (
        len(words),
        len(text.translate(None, _SPACE + _INNER)),
        without(_SYMBOLS),
        dup,
        repeated_words(words),
        lines,
        without(_UPPER),
        without(_MARKS),
        without(_DIGITS),
    )


def rule_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and COUNTS per row of docs(doc_id, text)."""

    def work(ids: list, texts: list) -> dict[str, pa.Array]:
        columns = zip(*map(rule_counts, texts), strict=True) if texts else [[]] * len(COUNTS)
        return {"doc_id": pa.array(ids, pa.int64())} | {
            name: pa.array(values, pa.int64()) for name, values in zip(COUNTS, columns, strict=True)
        }

    schema = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS)
    return map_rows(docs, {"doc_id": "bigint", "text": "string"}, work, schema)


def _features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """How far each rule is broken, from 0 (not at all) to 1, one column per rule, so that long and short texts compare."""
    c = {k: v.astype(float) for k, v in counts.items()}
    words, chars, lines = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1), np.maximum(c["n_lines"], 1)
    mean = c["word_chars"] / words
    broken = [
        (c["n_symbols"] / words - 0.02) / 0.1,
        (c["n_upper"] / chars - 0.25) / 0.25,
        (c["n_marks"] / words - 0.1) / 0.3,
        (c["n_dup_lines"] / lines - 0.5) / 0.3,
        (c["n_repeat_words"] / words - 0.2) / 0.2,
        np.where(words >= 10, np.maximum(3 - mean, mean - 12) / 3, 0),
        (c["n_digits"] / chars - 0.3) / 0.3,
    ]
    return np.column_stack([np.clip(x, 0, 1) for x in broken])


def _unseen(n: np.ndarray | float) -> np.ndarray | float:
    """Mean path length of an unsuccessful search among n rows, which a leaf of n rows still stands for."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2 * (n - 1) / np.maximum(n, 1), n > 1)


def grow_forest(rows: np.ndarray, trees: int, tree_rows: int, seed: int) -> list[tuple[np.ndarray, ...]]:
    """Trees as arrays (feature or -1, split, left, right, path length); a split is uniform between a node's extremes."""
    rng, forest = np.random.default_rng(seed), []
    size = min(tree_rows, len(rows))
    limit = max(1, math.ceil(math.log2(max(2, size))))
    for _ in range(trees):
        feature, split, left, right, path = [], [], [], [], []
        todo = [(rows[rng.choice(len(rows), size, replace=False)], 0, None)]
        while todo:
            part, depth, parent = todo.pop()
            at = len(feature)
            if parent is not None:
                (left if parent[1] else right)[parent[0]] = at
            low, high = part.min(0), part.max(0)
            open_ = np.flatnonzero(high > low)
            leaf = depth >= limit or not len(open_)
            j = -1 if leaf else int(rng.choice(open_))
            s = 0.0 if leaf else float(rng.uniform(low[j], high[j]))
            feature.append(j)
            split.append(s)
            left.append(at)
            right.append(at)
            path.append(depth + float(_unseen(len(part))) if leaf else 0.0)
            if not leaf:
                below = part[:, j] <= s
                todo += [(part[below], depth + 1, (at, True)), (part[~below], depth + 1, (at, False))]
        forest.append(tuple(np.array(x) for x in (feature, split, left, right, path)))
    return forest


def forest_scores(rows: np.ndarray, forest: list[tuple[np.ndarray, ...]], tree_rows: int) -> np.ndarray:
    """2 to the power of minus the mean path length over the expected one: near 1 is anomalous."""
    total, each = np.zeros(len(rows)), np.arange(len(rows))
    for feature, split, left, right, path in forest:
        at = np.zeros(len(rows), int)
        while (inner := feature[at] >= 0).any():
            go = rows[each, np.maximum(feature[at], 0)] <= split[at]
            at = np.where(inner, np.where(go, left[at], right[at]), at)
        total += path[at]
    return 2.0 ** (-total / max(1, len(forest)) / float(max(1.0, _unseen(tree_rows))))


def judge_quality(
    docs: DataFrame,
    labels: DataFrame | None = None,
    trees: int = 100,
    tree_rows: int = 256,
    max_false: float = 0.005,
    default: float = 0.62,
    seed: int = 7,
) -> DataFrame:
    """doc_id, COUNTS, base_failed, score and kept per row of docs(doc_id, text).

    base_failed: fewer than 10 words, or more than 20 % of them in repeated
    5-word windows. kept: not base_failed, and score not above the threshold.
    The threshold is the one that rejects most rows with quality 0 while at
    most `max_false` of those with quality 1 go; `default` without both kinds.
    Null and empty texts have zero counts and fail. Repeated rows give repeated
    results, repeated labels count as often as they stand, null ids carry no
    label. trees * tree_rows rows are drawn for the trees, whatever the size.
    """
    stats = stored(rule_statistics(docs), "rules")
    sound = (F.col("n_words") >= 10) & (100 * F.col("n_repeat_words") <= 20 * F.col("n_words"))
    # The rows with the smallest hashes; all others are left out before the sort, so that tasks send few rows.
    place, wanted = F.xxhash64("doc_id", *COUNTS), trees * tree_rows
    share = min(1.0, 1.2 * wanted / max(1, stats.count()))
    near = stats.where(F.pmod(place, F.lit(1 << 30)) < int(share * (1 << 30)))
    drawn = near.orderBy(F.pmod(place, F.lit(1 << 30)), *COUNTS).limit(wanted).toPandas()
    if not len(drawn):
        return stats.select(
            "doc_id", *COUNTS, F.lit(True).alias("base_failed"), F.lit(0.0).alias("score"), F.lit(False).alias("kept")
        )
    forest = grow_forest(_features({c: drawn[c].to_numpy() for c in COUNTS}), trees, tree_rows, seed)
    size = min(tree_rows, len(drawn))
    model = docs.sparkSession.sparkContext.broadcast(forest)  # at most trees * 2 * tree_rows nodes

    def work(ids: list, *counts: list) -> dict[str, pa.Array]:
        arrays = {c: np.array(v, dtype=np.int64) for c, v in zip(COUNTS, counts, strict=True)}
        score = forest_scores(_features(arrays), model.value, size) if ids else np.zeros(0)
        return (
            {"doc_id": pa.array(ids, pa.int64())}
            | {c: pa.array(v, pa.int64()) for c, v in arrays.items()}
            | {"score": pa.array(score, pa.float64())}
        )

    schema = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", score double"
    scored = map_rows(stats, {"doc_id": "bigint"} | dict.fromkeys(COUNTS, "bigint"), work, schema)
    limit = default
    if labels is not None:
        marked = labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_quality"))
        bins = (  # at most 1,001 rows
            scored.where(sound)
            .join(marked, F.col("doc_id") == F.col("_id"))
            .groupBy(F.round(F.col("score") * 1000).cast("int").alias("bin"))
            .agg(F.count_if(F.col("_quality") == 1).alias("good"), F.count_if(F.col("_quality") == 0).alias("bad"))
            .collect()
        )
        limit = _threshold([(r["bin"], r["good"], r["bad"]) for r in bins], max_false, default)
    return scored.select(
        "doc_id",
        *COUNTS,
        (~sound).alias("base_failed"),
        "score",
        (sound & (F.round(F.col("score") * 1000) <= limit * 1000)).alias("kept"),
    )


def _threshold(bins: list[tuple[int, int, int]], max_false: float, default: float) -> float:
    good, bad = sum(b[1] for b in bins), sum(b[2] for b in bins)
    if not good or not bad:
        return default
    bins = sorted(bins, reverse=True)
    lost, limit, caught, best = 0, bins[0][0], 0, 0
    for (at, n_good, n_bad), below in zip(bins, [*bins[1:], (0, 0, 0)], strict=True):
        lost, caught = lost + n_good, caught + n_bad
        if lost > max_false * good:
            break
        if caught > best:  # half way to the next score that occurs
            best, limit = caught, (at + below[0]) // 2
    return limit / 1000
