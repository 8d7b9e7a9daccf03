"""Helpers shared by the operators: the shared work folder, words, and Arrow rows.

Two kinds of words occur. *Spaced* words are runs without ASCII white space
(space and 0x09 to 0x0D). *Plain* words are runs of ASCII letters, digits and
everything beyond ASCII, after A-Z became a-z. Both are split on UTF-8 bytes:
no byte of a longer UTF-8 sequence is an ASCII byte, so nothing is torn apart.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)


def plain_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words of letters and digits; none for null."""
    return text.translate(_FOLD).split() if text else []


def spaced_words(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space; none for null."""
    return text.split() if text else []


def work_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which all executors share.

    Only where that setting is missing and the session is local (tests) is a
    temporary folder used; a cluster without it is an error.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table into the shared folder and reads it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_rows(
    df: DataFrame,
    columns: dict[str, str],
    work: Callable[..., dict[str, pa.Array]],
    schema: str,
    start: Callable | None = None,
    size: int = 8 << 20,
) -> DataFrame:
    """df through a function on Arrow batches; only the named columns are read, so other columns cannot clash.

    columns: name to Spark type. work gets one list per column (strings as
    UTF-8 bytes) and, if start is given, what start() made once per task. size:
    bytes of the rows that one call gets, or one row.
    """
    names = list(columns)
    binary = [columns[n] == "string" for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = [start()] if start else []
        for batch in batches:
            for part in _bounded(batch, size):
                lists = [
                    (c.cast(pa.binary()) if b and not pa.types.is_binary(c.type) else c).to_pylist()
                    for c, b in zip(part.columns, binary, strict=True)
                ]
                out = work(*state, *lists)
                yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    selected = df.select(*(df[n].cast(t).alias(n) for n, t in columns.items()))
    return selected.mapInArrow(run, schema)


def _bounded(batch: pa.RecordBatch, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about `size` bytes at most, so that batches of very long texts do not fill a worker's memory."""
    n, parts = batch.num_rows, max(1, -(-batch.nbytes // size))
    step = max(1, -(-n // parts))
    for i in range(0, n, step):
        yield batch.slice(i, step)


class WordHash:
    """64-bit hashes of words, kept in a dictionary of bounded size."""

    def __init__(self, seed: int = 0, limit: int = 200_000) -> None:
        self.seed, self.limit, self.known = seed, limit, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known, seed, digest = self.known, self.seed, xxhash.xxh3_64_intdigest
        if len(known) > self.limit:
            known.clear()
        out = [known.get(w) for w in words]
        if None in out:
            for i, h in enumerate(out):
                if h is None:
                    w = words[i]
                    out[i] = known[w] = digest(w, seed)
        return np.array(out, dtype=np.uint64)


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash for each run of k word hashes, in order."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    base, out = np.uint64(0x9E3779B97F4A7C15), np.zeros(n, np.uint64)
    for j in range(k):
        out = out * base + hashes[j : j + n]
    return mixed(out)


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64's last steps: spreads every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers above 0 and up to 1."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53
