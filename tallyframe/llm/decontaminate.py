"""Benchmark decontamination with a generalised suffix automaton of the test items.

The items' words become one automaton that recognises every run of item words.
Document words are streamed through it; after each word it knows the length of
the longest run of item words that ends there. Runs of at least `window` words
mark their words; an item shorter than that counts as a whole. Items are taken
in blocks of at most `block_words` words, each with an automaton and a pass of
its own, so that a task never holds more than one block.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import _FOLD, map_rows, plain_words, stored

_RUN = re.compile(rb"[^ ]+")


class ItemAutomaton:
    """Suffix automaton of several word sequences; states know which items hold their `window` last words."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int) -> None:
        self.window, self.ids = window, {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        owners: list[set[int]] = [set()]
        self.names = [name for name, _ in items]
        whole: dict[int, set[int]] = {}  # state of a short item to those items
        self.least = min([window, *(len(words) for _, words in items)])
        for k, (_, words) in enumerate(items):
            last = 0
            for w in words:
                last = self._extend(last, self.ids.setdefault(w, len(self.ids)), owners)
                owners[last].add(k)
            if len(words) < window:
                whole.setdefault(last, set()).add(k)
        order = sorted(range(1, len(self.link)), key=lambda s: -self.length[s])
        for s in order:  # an item that holds a run holds the run's endings
            if self.length[self.link[s]] >= window:
                owners[self.link[s]] |= owners[s]
        # For each state the runs it ends with: the items with its last `window` words, and short items.
        self.full = [owners[s] if s and self.length[s] >= window > self.length[self.link[s]] else None for s in range(len(self.link))]
        self.short = {s: (len(items[min(ks)][1]), ks) for s, ks in whole.items()}

    def _extend(self, last: int, c: int, owners: list[set[int]]) -> int:
        nxt, link, length = self.next, self.link, self.length

        def split(p: int, q: int) -> int:
            twin = len(nxt)
            nxt.append(dict(nxt[q]))
            link.append(link[q])
            length.append(length[p] + 1)
            owners.append(set())
            while p >= 0 and nxt[p].get(c) == q:
                nxt[p][c] = twin
                p = link[p]
            link[q] = twin
            return twin

        q = nxt[last].get(c)
        if q is not None:
            return q if length[q] == length[last] + 1 else split(last, q)
        new, p = len(nxt), last
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        owners.append(set())
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[new] = q if length[q] == length[p] + 1 else split(p, q)
        return new

    def matches(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Merged spans [start, end) of hit words, and the numbers of the items found."""
        known, least = self.ids, self.least
        if len(words) < least or not self.names:
            return [], set()
        codes = [known.get(w, -1) for w in words]
        there = np.array(codes) >= 0
        edges = np.flatnonzero(np.diff(np.concatenate(([False], there, [False])).astype(np.int8)))
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        nxt, link, length, window, full, short = self.next, self.link, self.length, self.window, self.full, self.short
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a < least:  # no whole window fits between unknown words
                continue
            s = size = 0
            for i in range(a, b):
                c = codes[i]
                while c not in nxt[s]:
                    s = link[s]
                    if s < 0:
                        break
                    size = length[s]
                if s < 0:
                    s = size = 0
                    continue
                s, size = nxt[s][c], size + 1
                start = -1
                if size >= window:
                    start, t = i + 1 - size, s
                    while full[t] is None:
                        t = link[t]
                    items |= full[t]
                if short:
                    t = s
                    while t > 0:
                        if t in short and short[t][0] <= size:
                            n, ks = short[t]
                            items |= ks
                            start = i + 1 - n if start < 0 else min(start, i + 1 - n)
                        t = link[t]
                if start >= 0:
                    while spans and spans[-1][1] >= start:
                        start = min(start, spans.pop()[0])
                    spans.append((start, i + 1))
        return spans, items


def item_blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items with an id and a word, partition by partition, in blocks of a bounded number of words."""
    block, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("words"))
    for row in rows.where("item is not null and words is not null").toLocalIterator():
        words = plain_words(row["words"].encode("utf-8", "surrogatepass"))
        if not words:
            continue
        if block and size + len(words) > block_words:
            yield block
            block, size = [], 0
        block.append((row["item"], words))
        size += len(words)
    if block:
        yield block


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def find_benchmark_words(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, block_words: int = 200_000
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest, starts, ends, items per row of docs.

    starts and ends give the hit spans in words, end exclusive, merged; longest
    is the largest of them. Null texts have no words. Items without an id or a
    word are left out; repeated items count once, by id. Repeated rows give
    repeated results; an empty benchmark hits nothing.
    """
    spark, result = docs.sparkSession, None
    kinds = {"doc_id": "bigint", "text": "string"}
    found_kinds = {"starts": "array<int>", "ends": "array<int>", "items": "array<string>"}
    blocks = item_blocks(benchmark, block_words)
    block, following = next(blocks, []), next(blocks, None)
    rows = docs.select("doc_id", "text")
    while True:
        model = spark.sparkContext.broadcast(ItemAutomaton(block, window))  # at most 2 * block_words states
        again, last = result is not None, following is None

        def work(ids: list, texts: list, *before: list, model=model, again=again, last=last) -> dict[str, pa.Array]:
            lists: list[tuple] = []
            for k, text in enumerate(texts):
                words = plain_words(text)
                spans, numbers = model.value.matches(words)
                items = {model.value.names[n] for n in numbers}
                if again:
                    spans = _merged(spans + list(zip(before[0][k], before[1][k], strict=True)))
                    items |= {x.decode() if isinstance(x, bytes) else x for x in before[2][k]}
                lists.append((len(words), spans, sorted(items)))
            out = {"doc_id": pa.array(ids, pa.int64())}
            if last:
                hits = [sum(b - a for a, b in spans) for _, spans, _ in lists]
                out |= {
                    "n_words": pa.array([n for n, _, _ in lists], pa.int64()),
                    "n_hit": pa.array(hits, pa.int64()),
                    "n_items": pa.array([len(items) for _, _, items in lists], pa.int64()),
                    "items_sha256": pa.array(
                        [hashlib.sha256(",".join(items).encode()).hexdigest() for _, _, items in lists], pa.string()
                    ),
                    "contaminated": pa.array([n > 0 for n in hits], pa.bool_()),
                    "longest": pa.array([max((b - a for a, b in s), default=0) for _, s, _ in lists], pa.int64()),
                }
            else:
                out["text"] = pa.array([t for t in texts], pa.binary()).cast(pa.string())
            return out | {
                "starts": pa.array([[a for a, _ in spans] for _, spans, _ in lists], pa.list_(pa.int32())),
                "ends": pa.array([[b for _, b in spans] for _, spans, _ in lists], pa.list_(pa.int32())),
                "items": pa.array([items for _, _, items in lists], pa.list_(pa.string())),
            }

        head = "n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, longest bigint"
        schema = f"doc_id bigint, {head if last else 'text string'}, " + ", ".join(f"{n} {t}" for n, t in found_kinds.items())
        result = map_rows(rows, kinds | (found_kinds if again else {}), work, schema)
        if last:
            return result
        rows = result = stored(result, "hits")
        block, following = following, next(blocks, None)


def remove_benchmark_spans(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.5, block_words: int = 200_000
) -> DataFrame:
    """docs(doc_id, text, lang, source, n_chars) without benchmark runs of `window` words or more.

    Such runs are cut out of the text, from the first to the last hit word; a
    document with more than `max_coverage` of its words hit, by items of all
    blocks together, goes as a whole. What a cut brings together is looked at
    again, with all blocks, until nothing is hit. Rows without a hit, null
    texts among them, stay as they are.
    """
    rows, done = docs.select("doc_id", "text", "lang", "source", "n_chars"), []
    while True:
        rows, several = _without_hits(rows, benchmark, window, None if done else max_coverage, block_words)
        if not several:
            return rows.drop("cut")
        rows = stored(rows, "cut")
        done.append(rows.where("not cut").drop("cut"))
        rows = rows.where("cut").drop("cut")
        if rows.isEmpty():
            return reduce(DataFrame.unionAll, done)


def _without_hits(
    rows: DataFrame, benchmark: DataFrame, window: int, max_coverage: float | None, block_words: int
) -> tuple[DataFrame, bool]:
    """rows without the hits of all blocks, with `cut` (whether a row had any), and whether there are several blocks.

    Rows with more than `max_coverage` of their words hit are left out, none if
    it is None. With a single block a row is cut until nothing is hit.
    """
    spark, again = rows.sparkSession, False
    kinds = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}
    found_kinds = {"starts": "array<int>", "ends": "array<int>"}
    blocks = item_blocks(benchmark, block_words)
    block, following = next(blocks, []), next(blocks, None)
    several = following is not None
    while True:
        model = spark.sparkContext.broadcast(ItemAutomaton(block, window))
        last = following is None

        def work(
            ids: list, texts: list, langs: list, sources: list, sizes: list, *before: list, model=model, again=again, last=last
        ) -> dict[str, pa.Array]:
            kept = []
            for k, row in enumerate(zip(ids, texts, langs, sources, sizes, strict=True)):
                text, n_chars = row[1], row[4]
                words = plain_words(text)
                spans, _ = model.value.matches(words)
                if again:
                    spans = _merged(spans + list(zip(before[0][k], before[1][k], strict=True)))
                cut = bool(spans)
                if last and cut:
                    if max_coverage is not None and sum(b - a for a, b in spans) > max_coverage * len(words):
                        continue
                    while spans:
                        text = cut_words(text, spans)
                        spans = [] if several else model.value.matches(plain_words(text))[0]
                    n_chars = len(text.decode("utf-8", "replace"))
                kept.append((row[0], text, row[2], row[3], n_chars, cut, [a for a, _ in spans], [b for _, b in spans]))
            ids, texts, langs, sources, sizes, cuts, starts, ends = zip(*kept, strict=True) if kept else [[]] * 8
            string = lambda x: pa.array(x, pa.binary()).cast(pa.string())
            out = {
                "doc_id": pa.array(ids, pa.int64()),
                "text": string(texts),
                "lang": string(langs),
                "source": string(sources),
                "n_chars": pa.array(sizes, pa.int64()),
            }
            if last:
                return out | {"cut": pa.array(cuts, pa.bool_())}
            return out | {
                "starts": pa.array(starts, pa.list_(pa.int32())),
                "ends": pa.array(ends, pa.list_(pa.int32())),
            }

        schema = ", ".join(f"{n} {t}" for n, t in (kinds | ({"cut": "boolean"} if last else found_kinds)).items())
        rows = map_rows(rows, kinds | (found_kinds if again else {}), work, schema)
        if last:
            return rows, several
        rows, again = stored(rows, "hits"), True
        block, following = following, next(blocks, None)


def cut_words(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """text without the words in spans [start, end) and what stands between them."""
    places = [m.span() for m in _RUN.finditer(text.translate(_FOLD))]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at : places[a][0]])
        at = places[b - 1][1]
    out.append(text[at:])
    return b"".join(out)
