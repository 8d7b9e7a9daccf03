"""Importance resampling towards a target: documents drawn by how much more likely the target's features are.

Features are the runs of one and two consecutive plain words; each falls into
one of 10,000 buckets by its CRC-32. CRCs are worked out for whole matrices:
the distinct features of a batch are grouped by their length in bytes, each
group is a two-dimensional uint8 array, and every column updates the CRCs of
all its rows at once; the buckets are then scattered back to the places of the
features.

Two passes read the texts: one counts buckets (a task adds up its own, at most
10,000 numbers leave it), one looks up the gains. Only the gains, one number
per bucket, pass through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import _bounded, plain_words, stored
from tallyframe.operators.running import running_row_number

BUCKETS = 10_000
_BATCH = 2 << 20  # bytes of text whose features are held at once


def _crc_table() -> np.ndarray:
    """CRC-32 of every single byte: eight shifts, each with the reversed polynomial where a one drops out."""
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(0xEDB88320), crc >> 1)
    return crc


_TABLE = _crc_table()


def crc_buckets(features: list[bytes], buckets: int = BUCKETS) -> np.ndarray:
    """The bucket of each feature: its unsigned CRC-32 modulo ``buckets``.

    Time is in proportion to the bytes plus the sum of the different lengths.
    """
    sizes = np.fromiter(map(len, features), np.int64, len(features))
    order = np.argsort(sizes, kind="stable")
    data = np.frombuffer(b"".join([features[i] for i in order.tolist()]), np.uint8)
    crcs = np.empty(len(features), np.uint32)
    row = byte = 0
    for size, rows in zip(*np.unique(sizes, return_counts=True), strict=True):
        matrix = data[byte : byte + size * rows].reshape(rows, size)
        crc = np.full(rows, 0xFFFFFFFF, np.uint32)
        for column in matrix.T:
            crc = _TABLE[(crc ^ column) & 0xFF] ^ (crc >> 8)
        crcs[order[row : row + rows]] = ~crc
        row, byte = row + rows, byte + size * rows
    return (crcs % np.uint32(buckets)).astype(np.int64)


def _features(texts: list[bytes | None], runs: int) -> tuple[list[bytes], np.ndarray, np.ndarray, list[int]]:
    """The distinct features of the texts, the number in that list of every feature, and features and words per text."""
    known: dict[bytes, int] = {}
    ids: list[int] = []
    counts, n_words = np.zeros(len(texts), np.int64), []
    for i, text in enumerate(texts):
        words = plain_words(text)
        n_words.append(len(words))
        for n in range(1, runs + 1):
            grams = words if n == 1 else map(b" ".join, zip(*[words[j:] for j in range(n)], strict=False))
            before = len(ids)
            ids += [known.setdefault(g, len(known)) for g in grams]
            counts[i] += len(ids) - before
    return list(known), np.array(ids, np.int64), counts, n_words


def _texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    for batch in batches:
        for part in _bounded(batch, _BATCH):
            yield part, part.column(column).cast(pa.binary()).to_pylist()


def bucket_counts(texts: DataFrame, runs: int = 2, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, part in _texts(batches, 0):
            distinct, ids, _, _ = _features(part, runs)
            total += np.bincount(crc_buckets(distinct, buckets)[ids], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    counted = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most `buckets` rows
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed share in the target over the share in the source), in doubles."""
    s, t, k = source.astype(np.float64), target.astype(np.float64), float(len(source))
    ratio = (t + 1.0) * (s.sum() + k) / ((s + 1.0) * (t.sum() + k))
    return np.floor(1000.0 * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, id_column: str = "doc_id", runs: int = 2) -> DataFrame:
    """(id, n_words, n_features, weight) of every row; weight is the floored mean of its features' gains, 0 without any."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _texts(batches, 1):
            distinct, ids, counts, n_words = _features(texts, runs)
            ends = np.cumsum(np.concatenate([[0], gains[crc_buckets(distinct, len(gains))][ids]]))
            places = np.cumsum(np.concatenate([[0], counts]))
            weights = (ends[places[1:]] - ends[places[:-1]]) // np.maximum(counts, 1)
            columns = [part.column(0), pa.array(n_words, pa.int64()), pa.array(counts), pa.array(weights)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "n_features", "weight"])

    kind = dict(docs.dtypes)[id_column]
    selected = docs.select(docs[id_column].alias("id"), docs["text"].cast("string").alias("text"))
    return selected.mapInArrow(work, f"id {kind}, n_words long, n_features long, weight long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    min_words: int = 20,
    salt: str = "7",
    id_column: str = "doc_id",
    runs: int = 2,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Draws ``percent`` % of the documents of at least ``min_words`` words, likelier the closer they are to ``target``.

    One row per document: its id, n_features, weight, score (weight plus Gumbel
    noise from the hash of ``salt`` and the id) and rank, 1 for the highest score;
    equal scores go by id, NULL last, rows equal in both share ranks in any
    order; documents that are not drawn have none. Only ``text`` and the id are
    read, so other columns cannot clash.

    A NULL or empty text has no features and weight 0. A NULL id is hashed as
    empty text. Without features in ``target`` the gains come from smoothing
    alone. An empty table gives no rows.

    Ranks come from a cut order, so no task sorts all drawn documents.
    """
    gains = bucket_gains(bucket_counts(docs, runs, buckets), bucket_counts(target, runs, buckets))
    name = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = stored(weigh(docs, gains, id_column, runs).withColumn("score", F.col("weight") + noise), "scored")
    able = F.col("n_words") >= min_words
    drawn = scored.where(able).count() * percent // 100
    # Documents that cannot be drawn are a group of their own; the numbers are cut off at the wanted share.
    keys = scored.withColumn("able", able).withColumn("down", -F.col("score")).withColumn("no_id", F.col("id").isNull())
    ranked = running_row_number(keys, ["able"], ["down", "no_id", "id"], "place")
    rank = F.when(F.col("able") & (F.col("place") <= F.lit(drawn)), F.col("place"))
    return ranked.select(F.col("id").alias(id_column), "n_features", "weight", "score", rank.alias("rank"))
