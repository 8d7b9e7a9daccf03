"""Exact removal of repeated byte strings with suffix arrays, over texts of any total size.

All strings of ``length`` bytes that are equal have to meet in one shard. Each
string is filed under its *seed*: of all 64-byte strings in it the one with the
least hash. Equal strings have the same seed at the same place, and neighbouring
strings mostly share theirs, so a document falls into *pieces*: runs of starts
with one seed. A piece whose seed occurs once in the whole corpus cannot repeat
and goes no further. The others are sent once per different content, with the
number of their occurrences, to the shard of their seed. There ``induced`` sorts
all suffixes of the pieces, and neighbours that share ``length`` bytes are
counted; strings that occur twice or more come back as spans of their pieces.

A seed with very many different pieces (a line that a third of all documents
hold) is no task's burden: its pieces are cut in half by where the seed stands
in the string, which makes more bytes common to all strings of a half, and filed
anew under these. This is repeated until no key is hot; at the end of it a key is
the string itself, and equal contents are one row.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import _bounded, mixed, stored
from tallyframe.llm.induced import sorted_suffixes

SEED = 64  # bytes of a seed, a power of two
_SPAN = "array<struct<f:int,t:int>>"
_SEGMENT = 1 << 16  # bytes that are looked at together
_DIGEST = xxhash.xxh3_64_intdigest
_LOW = np.uint64(0xFFFFFFFF)


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _seeds(data: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """For each start of a string of ``length`` bytes the place of its seed, and the hashes of all places."""
    power, size = np.uint64(0x9E3779B97F4A7C15), 1
    hashes = mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * power)[data]
    while size < seed:
        hashes = hashes[:-size] * power + hashes[size:]
        power = np.multiply(power, power, dtype=np.uint64)
        size *= 2
    hashes = mixed(hashes)
    width = length - seed + 1
    # The least hash, and of equal ones the last place, in one number.
    least = (hashes & ~_LOW) | (_LOW - np.arange(len(hashes), dtype=np.uint64))
    size = 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[: len(least) - (width - size)], least[width - size :])
    return (_LOW - (least & _LOW)).astype(np.int64), hashes


Piece = tuple[int, int, int, int, bytes]  # first start, key, content hash, place of the seed after the first start, content


def pieces(texts: Iterable[bytes], length: int, seed: int = SEED) -> Iterator[tuple[int, list[Piece]]]:
    """The number and the pieces of each text; a long text comes in several lists, a short one in none.

    Texts are joined to blocks of about ``_SEGMENT`` bytes, longer ones cut with an overlap.
    """
    block: list[tuple[int, int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        for begin in range(0, max(len(text) - length + 1, 0), _SEGMENT):
            part = text[begin : begin + _SEGMENT + length - 1]
            block.append((i, begin, part))
            size += len(part)
            if size >= _SEGMENT:
                yield from _block_pieces(block, length, seed)
                block, size = [], 0
    yield from _block_pieces(block, length, seed)


def _block_pieces(block: list[tuple[int, int, bytes]], length: int, seed: int) -> Iterator[tuple[int, list[Piece]]]:
    if not block:
        return
    joined = b"".join([part for _, _, part in block])
    with np.errstate(over="ignore"):
        places, hashes = _seeds(np.frombuffer(joined, np.uint8), length, seed)
    ends = np.cumsum([len(part) for _, _, part in block])
    # A start is a text's own if its string ends in it; a piece is a run of such starts with one seed.
    border = np.zeros(len(places) + 1, np.int8)
    border[ends[:-1] - length + 1] += 1
    border[ends[:-1]] -= 1
    own = np.cumsum(border[:-1]) == 0
    change = np.append(True, (places[1:] != places[:-1]) | ~own[:-1]) & own
    firsts = np.flatnonzero(change)
    lasts = np.append(firsts[1:], len(places))
    after = np.searchsorted(ends, firsts, side="right")
    lasts = np.minimum(lasts, ends[after] - length + 1) + length - 1
    found = places[firsts]
    contents = [joined[x:y] for x, y in zip(firsts.tolist(), lasts.tolist(), strict=True)]
    hashed = np.array([_DIGEST(c) for c in contents], np.uint64).view(np.int64).tolist()
    keys, inside = hashes[found].view(np.int64).tolist(), (found - firsts).tolist()
    bounds = np.searchsorted(firsts, np.append(0, ends)).tolist()
    for (i, begin, part), x, y, end in zip(block, bounds[:-1], bounds[1:], ends.tolist(), strict=True):
        shift = begin - (end - len(part))
        starts = (firsts[x:y] + shift).tolist()
        yield i, list(zip(starts, keys[x:y], hashed[x:y], inside[x:y], contents[x:y], strict=True))


def _halves(content: bytes, place: int, low: int, high: int, length: int) -> Iterator[tuple[int, int, int, int, int, int, bytes]]:
    """A piece cut by how far the seed is behind the start: (start, low, high, key, content hash, place, content) of each part.

    All strings of a part have their seed between ``low`` and ``high`` (not
    included) bytes behind their start, so they share the bytes that the key hashes.
    """
    middle = (low + high) // 2
    last = place - (len(content) - length)  # how far the seed is behind the last start
    for a, b in ((low, middle), (middle, high)):
        most, least = min(place, b - 1), max(last, a)
        if most >= least:
            start = place - most
            part = content[start : place - least + length]
            core = content[place - a : place - (b - 1) + length]
            key = xxhash.xxh3_64_intdigest(core, seed=b)
            yield start, a, b, _signed(key), _signed(xxhash.xxh3_64_intdigest(part)), most, part


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        for part in _bounded(batch):
            yield part, [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]


def _with_owner(docs: DataFrame) -> DataFrame:
    return docs.withColumn("owner", F.xxhash64("text"))


def _occurrences(docs: DataFrame, length: int, seed: int) -> DataFrame:
    """(owner, key, ph, n): the pieces of each different text; texts that are equal within a batch are taken once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _texts(batches):
            rows: list[tuple[int, int, int, int]] = []
            times = Counter(zip(part.column("owner").to_pylist(), texts, strict=True))
            owners = list(times)
            for i, found in pieces([text for _, text in owners], length, seed):
                counted = Counter([(key, ph) for _, key, ph, _, _ in found])
                rows += [(owners[i][0], key, ph, n * times[owners[i]]) for (key, ph), n in counted.items()]
            columns = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["owner", "key", "ph", "n"])

    return _with_owner(docs.select("text")).mapInArrow(work, "owner long, key long, ph long, n long")


def _contents(docs: DataFrame, wanted: DataFrame, length: int, seed: int) -> DataFrame:
    """(key, ph, n, place, low, high, content) of the wanted pieces, each cut out of one text that holds it."""
    lists = stored(
        wanted.groupBy("owner").agg(F.collect_list(F.struct("key", "ph", "n")).alias("wanted")), "wanted"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _texts(batches):
            asked = [{(w["key"], w["ph"]): w["n"] for w in wanted} for wanted in part.column("wanted").to_pylist()]
            rows = []
            for i, found in pieces(texts, length, seed):
                for _, key, ph, place, content in found:
                    n = asked[i].pop((key, ph), None)
                    if n is not None:
                        rows.append((key, ph, n, place, 0, length - seed + 1, content))
            yield _piece_batch(rows)

    once = _with_owner(docs.select("text")).join(lists.select("owner"), "owner", "left_semi")
    once = once.groupBy("owner").agg(F.first("text").alias("text")).join(lists, "owner").select("text", "wanted")
    return once.mapInArrow(cut, _PIECE)


_PIECE = "key long, ph long, n long, place int, low int, high int, content binary"


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 3 + [pa.int32()] * 3 + [pa.binary()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * 7
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["key", "ph", "n", "place", "low", "high", "content"])


def _refined(hot: DataFrame, length: int) -> DataFrame:
    """The halves of hot pieces, with the piece they come from (up_key, up_ph) and where they begin in it (start)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ups = [], []
            for r in batch.to_pylist():
                for start, a, b, key, ph, place, part in _halves(r["content"], r["place"], r["low"], r["high"], length):
                    rows.append((key, ph, r["n"], place, a, b, part))
                    ups.append((r["key"], r["ph"], start))
            out = _piece_batch(rows)
            columns = list(zip(*ups, strict=True)) if ups else [()] * 3
            more = [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int32()), strict=True)]
            names = [*out.schema.names, "up_key", "up_ph", "start"]
            yield pa.RecordBatch.from_arrays([*out.columns, *more], names=names)

    return hot.mapInArrow(work, f"{_PIECE}, up_key long, up_ph long, start int")


def repeated_starts(contents: list[bytes], times: np.ndarray, length: int, memory: int = 64 << 20) -> list[np.ndarray]:
    """For each content the starts of strings of ``length`` bytes that occur twice or more, counting contents ``times``."""
    sizes = np.fromiter(map(len, contents), np.int64, len(contents))
    bases = np.cumsum(sizes + 1) - sizes - 1
    # Bytes are 2 and up (UTF-8 has none above 0xF4), 1 stands behind each content, 0 at the end.
    text = np.frombuffer(b"\x00".join([*contents, b""]), np.uint8)
    text = text + np.uint8(2) if text.max(initial=0) < 254 else text.astype(np.uint16) + np.uint16(2)
    text[bases + sizes] = 1
    text = np.append(text, text.dtype.type(0))
    marked = np.zeros(len(text), bool)
    held: list[np.ndarray] = []  # the run of equal strings that may go on in the next block
    for places, common in sorted_suffixes(text, 258, length, memory):
        heads = np.flatnonzero(common < length)
        if not len(heads):
            held.append(places)
            continue
        held.append(places[: heads[0]])
        _mark(marked, np.concatenate(held), np.zeros(1, np.int64), bases, times)
        last = heads[-1]
        _mark(marked, places[heads[0] : last], heads[:-1] - heads[0], bases, times)
        held = [places[last:]]
    _mark(marked, np.concatenate(held) if held else np.empty(0, np.int32), np.zeros(1, np.int64), bases, times)
    return [np.flatnonzero(marked[b : b + max(0, s - length + 1)]) for b, s in zip(bases.tolist(), sizes.tolist(), strict=True)]


def _mark(marked: np.ndarray, places: np.ndarray, heads: np.ndarray, bases: np.ndarray, times: np.ndarray) -> None:
    """Marks the places of runs (that begin at ``heads``) with two occurrences or more."""
    if not len(places):
        return
    piece = np.searchsorted(bases, places, side="right") - 1
    often = np.add.reduceat(times[np.minimum(piece, len(times) - 1)], heads) >= 2
    marked[places[np.repeat(often, np.diff(np.append(heads, len(places))))]] = True


def _spans(starts: np.ndarray) -> list[dict[str, int]]:
    """Runs of starts as from (included) and to (not included)."""
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > 1)
    firsts, lasts = starts[np.append(0, breaks + 1)], starts[np.append(breaks, len(starts) - 1)] + 1
    return [{"f": f, "t": t} for f, t in zip(firsts.tolist(), lasts.tolist(), strict=True)]


def _sort_shards(found: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """(key, ph, spans) of all pieces with a repeated string; pieces of a key are in one shard of about ``shard_bytes``."""
    size = found.agg(F.sum(F.length("content") + 1)).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        starts = repeated_starts(list(map(bytes, rows["content"])), rows["n"].to_numpy(np.int64), length)
        out = pd.DataFrame({"key": rows["key"], "ph": rows["ph"], "spans": [_spans(s) for s in starts]})
        return out[out["spans"].map(len) > 0]

    dealt = found.select("key", "ph", "n", "content", F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"))
    return dealt.groupBy("shard").applyInPandas(work, f"key long, ph long, spans {_SPAN}")


def _moved(spans: Column, by: str) -> Column:
    return F.transform(spans, lambda s: F.struct((s["f"] + F.col(by)).alias("f"), (s["t"] + F.col(by)).alias("t")))


def repeated_spans(docs: DataFrame, length: int = 200, seed: int = SEED, hot: int = 4_096, shard_bytes: int = 2 << 20) -> DataFrame:
    """(owner, found): the pieces of each text, by the hash of the text, in which strings repeat, and their starts.

    ``hot`` is the number of different pieces beyond which a key is refined.
    """
    every = stored(_occurrences(docs, length, seed), "occurrences")
    seeds = every.groupBy("key").agg(F.sum("n").alias("m")).where("m > 1").select("key")
    shared = stored(every.join(seeds, "key", "left_semi"), "shared")
    wanted = shared.groupBy("key", "ph").agg(F.sum("n").alias("n"), F.min("owner").alias("owner"))
    level = stored(_contents(docs, wanted, length, seed), "pieces")
    links, done = [], []
    while True:
        crowded = stored(level.groupBy("key").agg(F.count("*").alias("m")).where(F.col("m") > hot).select("key"), "hot")
        # Strings with one place for the seed are equal if their keys are; nothing is left to refine.
        if crowded.isEmpty() or level.where("high - low > 1").isEmpty():
            done.append(stored(_sort_shards(level, length, shard_bytes), "spans"))
            break
        done.append(stored(_sort_shards(level.join(crowded, "key", "left_anti"), length, shard_bytes), "spans"))
        parts = stored(_refined(level.join(crowded, "key", "left_semi"), length), "halves")
        links.append(parts.select("up_key", "up_ph", "key", "ph", "start"))
        same = parts.groupBy("key", "ph", "place", "low", "high")
        level = stored(same.agg(F.sum("n").alias("n"), F.first("content").alias("content")).select(*level.columns), "pieces")
    # From the finest halves up, spans of halves become spans of the pieces they were cut from.
    spans = done.pop()
    while links:
        up = links.pop().join(spans, ["key", "ph"])
        up = up.select(F.col("up_key").alias("key"), F.col("up_ph").alias("ph"), _moved(F.col("spans"), "start").alias("spans"))
        up = up.groupBy("key", "ph").agg(F.flatten(F.collect_list("spans")).alias("spans"))
        spans = up.unionByName(done.pop())
    listed = shared.join(spans, ["key", "ph"]).select("owner", F.struct("key", "ph", "spans").alias("piece")).distinct()
    return listed.groupBy("owner").agg(F.collect_list("piece").alias("found"))


def _covered(texts: list[bytes], hits: list[list[dict] | None], length: int, seed: int) -> list[list[tuple[int, int]]]:
    """For each text the runs of bytes that its repeated strings cover."""
    asked = [{(h["key"], h["ph"]): h["spans"] for h in listed or ()} for listed in hits]
    runs: list[list[tuple[int, int]]] = [[] for _ in texts]
    for i, found in pieces([t if a else b"" for t, a in zip(texts, asked, strict=True)], length, seed):
        mine = runs[i]
        spans = [(first + s["f"], first + s["t"] - 1 + length) for first, key, ph, _, _ in found for s in asked[i].get((key, ph), ())]
        for a, b in sorted(spans):
            if mine and a <= mine[-1][1]:
                mine[-1] = (mine[-1][0], max(b, mine[-1][1]))
            else:
                mine.append((a, b))
    return runs


def remove_repeats(docs: DataFrame, length: int = 200, id_column: str = "doc_id", **options: int) -> DataFrame:
    """What is left of each text without the bytes of strings of ``length`` bytes that also start somewhere else.

    One row per document: its id, n_bytes, n_removed, n_spans (removed runs) and
    kept_sha256 of the bytes that stay. Strings are judged on the texts as they
    came, the same document included, and may overlap; none crosses documents.
    Texts are UTF-8 bytes, so a character may be cut. NULL and empty texts have
    no bytes; a text below ``length`` bytes keeps all. Repeated rows are copies of
    each other, so they lose every byte if they are long enough. An empty table
    gives no rows. Only ``text`` and the id are read, so other columns cannot
    clash. Long texts are looked at in overlapping segments.
    """
    seed = options.get("seed", SEED)
    if not 1 < seed < length or seed & (seed - 1) or length > 254:
        raise ValueError("seed must be a power of two below length, and length at most 254")
    plain = docs.select(docs[id_column].alias("id"), docs["text"].cast("string").alias("text"))
    found = stored(repeated_spans(plain, length, **options), "found")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _texts(batches):
            sizes, removed, runs, digests = [], [], [], []
            for text, spans in zip(texts, _covered(texts, part.column("found").to_pylist(), length, seed), strict=True):
                sizes.append(len(text))
                removed.append(sum(b - a for a, b in spans))
                runs.append(len(spans))
                edges = [0, *[e for span in spans for e in span], len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                digests.append(hashlib.sha256(kept).hexdigest())
            columns = [part.column("id"), *[pa.array(c, pa.int64()) for c in (sizes, removed, runs)], pa.array(digests)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = dict(plain.dtypes)["id"]
    joined = _with_owner(plain).join(found, "owner", "left").select("id", "text", "found")
    out = joined.mapInArrow(cut, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.withColumnRenamed("id", id_column)
