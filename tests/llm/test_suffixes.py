"""Operator 12: induced sorting and the removal of repeated strings, against plain sorting and plain loops."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import suffix_dedup
from tallyframe.llm.induced import Queues, sorted_suffixes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("memory", [0, 60, 1 << 20])
def test_induced_sorting(memory):
    """With little memory the queues are read back from the scratch file."""
    rng = random.Random(memory)
    for _ in range(120):
        size = rng.choice([1, 2, 3, 10])
        text = [rng.randrange(1, size + 1) for _ in range(rng.randrange(0, 60))] * rng.choice([1, 1, 3])
        depth = rng.choice([3, 5, 20, 200])
        text = [*text, 0]
        blocks = list(sorted_suffixes(np.array(text, np.uint16), size + 1, depth, memory))
        places = np.concatenate([p for p, _ in blocks])[::-1].tolist()
        common = np.concatenate([c for _, c in blocks])[::-1].tolist()
        assert sorted(places) == list(range(len(text)))
        for a, b, c in zip(places, places[1:], common, strict=False):
            x, y = text[a:], text[b:]
            shared = next((i for i, (u, v) in enumerate(zip(x, y, strict=False)) if u != v), min(len(x), len(y)))
            assert x[:depth] <= y[:depth] and c == min(shared, depth)


def test_queues_keep_their_order_on_disk():
    queues = Queues(2, 100)
    for i in range(40):
        queues.push(i % 2, np.array([i, i], np.int32), np.array([1, i], np.uint8))
    assert queues.file is not None
    assert [p for block, _ in queues.pop(1) for p in block.tolist()] == [i for i in range(40) if i % 2 for _ in range(2)]
    queues.close()


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        runs = sum(g and not h for g, h in zip(gone, [False, *gone], strict=False))
        out.append((len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(rng):
    letters = "abcdefgh äö\U0001f600"
    draw = lambda n: "".join(rng.choice(letters) for _ in range(n))
    line, passage = draw(30), draw(90)
    texts = [None, "", "short", "x" * 300, "ab" * 90, "aä" * 40, draw(700)]
    texts += [draw(rng.randrange(40)) + line + draw(rng.randrange(60)) for _ in range(40)]
    texts += [draw(25) + passage[rng.randrange(40) :] + draw(rng.randrange(50)) for _ in range(12)]
    copy = draw(200)
    texts += [copy] * 6 + [copy[:100] + "-" + copy[101:], copy[50:] + copy[:60]]
    return texts


@pytest.mark.parametrize("options", [{}, {"hot": 3}, {"hot": 3, "shard_bytes": 500}])
def test_removal_equals_brute_force(spark, options):
    """A line that most documents hold is refined where ``hot`` is small; the result does not change."""
    texts = corpus(random.Random(8))
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for name in ("key", "ph", "owner", "n", "content", "found", "id", "spans"):
        docs = docs.withColumn(name, F.lit("clash"))
    got = suffix_dedup.remove_repeats(docs, length=40, seed=16, **options).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == brute(texts, 40)


@pytest.mark.parametrize("segment", [64, 700, 1 << 17])
def test_long_texts_in_segments(segment, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_SEGMENT", segment)
    rng = random.Random(4)
    base = "".join(rng.choice("abcd ") for _ in range(500))
    texts = [base, base[37:400] + "!", "?" * 10 + base[100:]]
    data = [t.encode() for t in texts]
    starts = Counter(d[i : i + 40] for d in data for i in range(len(d) - 39))
    found = [[] for _ in data]
    for i, rows in suffix_dedup.pieces(data, 40, 16):
        found[i] += [p for first, _, _, _, content in rows for p in range(first, first + len(content) - 39)]
    assert found == [list(range(len(d) - 39)) for d in data]
    contents = [c for _, rows in suffix_dedup.pieces(data, 40, 16) for *_, c in rows]
    marks = suffix_dedup.repeated_starts(contents, np.ones(len(contents), np.int64), 40)
    again = Counter(c[i : i + 40] for c, m in zip(contents, marks, strict=True) for i in m.tolist())
    assert again == Counter({k: n for k, n in starts.items() if n > 1})


def test_empty_table_and_repeated_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert suffix_dedup.remove_repeats(empty).collect() == []
    text = "".join(random.Random(1).choice("abcdef ") for _ in range(400))
    twice = spark.createDataFrame([(1, text, "en", "s", 400)] * 2 + [(None, text[:199], None, None, None)], SCHEMA)
    got = sorted((r["n_bytes"], r["n_removed"], r["n_spans"]) for r in suffix_dedup.remove_repeats(twice).collect())
    assert got == [(199, 0, 0), (400, 400, 1), (400, 400, 1)]
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(empty, length=50)
