"""Operators 11 and 13 against plain loops, and their edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import divergence, importance

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = ["alpha", "Beta", "gämma", "d3lta", "x", "naïve", "Ω", "word", "other", "more-less", "\U0001f600"]


def clashing(df):
    for name in ("id", "bucket", "n", "n_words", "n_features", "weight", "score", "rank", "able", "down", "no_id", "place", "term", "df", "item", "part", "value", "s", "p", "z"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    out = [
        (1, None, "en", "a", 0),
        (2, "", None, "b", 0),
        (3, " \n-- \x00 ", "en", None, 5),
        (4, "word " * 5_000, "en", "a", 25_000),
        (None, " ".join(WORDS * 3), "en", "a", 9),
        (6, "ÀB ab AB 12 a1b", "xx", "only", 9),
    ]
    out += [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randrange(60))), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "d", None]), 1) for i in range(10, 90)]
    return [*out, *[out[-1]] * 3, *[(i, out[-2][1], "en", "a", 1) for i in range(100, 140)]]


def features(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    return words, [w.encode() for w in words] + [f"{a} {b}".encode() for a, b in zip(words, words[1:], strict=False)]


def brute_resample(rows, target, percent=25, buckets=10_000):
    counts = [Counter(), Counter()]
    for which, texts in enumerate(([r[1] for r in rows], target)):
        for t in texts:
            counts[which].update(zlib.crc32(f) % buckets for f in features(t)[1])
    s, t = counts
    ns, nt = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (ns + buckets) / ((s[b] + 1.0) * (nt + buckets))))
    scored = []
    for r in rows:
        words, found = features(r[1])
        weight = sum(gain(zlib.crc32(f) % buckets) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append([r[0], len(found), weight, score, None, len(words) >= 20])
    able = sorted((r for r in scored if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[: len(able) * percent // 100], 1):
        r[4] = rank
    return scored


def test_crc_of_matrices():
    rng = random.Random(1)
    texts = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 2, 3, 7, 8, 500]))) for _ in range(300)]
    assert importance.crc_buckets(texts).tolist() == [zlib.crc32(t) % 10_000 for t in texts]
    assert importance.crc_buckets([]).tolist() == []


@pytest.mark.parametrize("percent", [25, 100, 0])
def test_resample(spark, rows, percent):
    target = ["Beta alpha beta", None, "", "word other x " * 4]
    docs = clashing(spark.createDataFrame(rows, SCHEMA).repartition(4))
    bench = clashing(spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string"))
    got = [tuple(r) for r in importance.resample(docs, bench, percent).collect()]
    expected = [tuple(r[:5]) for r in brute_resample(rows, target, percent)]
    key = lambda r: tuple((v is not None, v if v is not None else 0) for v in r)
    assert sorted(got, key=key) == sorted(expected, key=key)


def test_resample_empty_tables(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    none = spark.createDataFrame([], "item_id long, text string")
    assert importance.resample(docs.limit(0), none).collect() == []
    got = {tuple(r) for r in importance.resample(docs, none).collect()}
    assert got == {tuple(r[:5]) for r in brute_resample(rows, [])}


def brute_audit(rows, min_docs=3, top=200):
    total, df, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(dict)
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)
        groups[lang].setdefault(source, Counter()).update(terms)
        total[lang].update(terms)
        df[lang].update(set(terms))
    out = []
    for lang, by_source in groups.items():
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        share = lambda counts: {t: 1 + math.floor(Fraction(10**9 * (counts[t] + 1), sum(counts[k] for k in kept) + len(kept))) for t in kept}
        shares, whole = {s: share(c) for s, c in by_source.items()}, share(total[lang])
        gap = lambda p, q: (p - q) ** 2 // q
        for s, p in shares.items():
            pairs = [(o, sum(gap(p[t], q[t]) for t in kept)) for o, q in shares.items() if o != s]
            terms = [(t, gap(p[t], whole[t])) for t in kept if by_source[s][t] and p[t] > whole[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                found = found if part == "pair" else found[:top]
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("top", [200, 2])
def test_audit(spark, rows, top):
    docs = clashing(spark.createDataFrame(rows, SCHEMA).repartition(4))
    got = sorted(tuple(r) for r in divergence.audit_sources(docs, top_terms=top).collect())
    assert got == brute_audit(rows, top=top)


def test_audit_without_kept_terms_and_empty(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(r) for r in divergence.audit_sources(docs, min_docs=10_000).collect())
    assert got == brute_audit(rows, min_docs=10_000) and {r[4] for r in got} == {0}
    assert divergence.audit_sources(docs.limit(0)).collect() == []


def test_tree_equals_pairs_and_may_be_cut():
    """Corrections of a tree over many sources, whole and in pieces, against every pair of places of every row."""
    rng = random.Random(9)
    rows = []
    for _ in range(300):
        places = sorted(rng.sample(range(9), rng.randrange(1, 8)))
        rows.append(([*places], [rng.choice([3, 50, 900_000]) for _ in places], rng.randrange(1, 5)))
    rows.sort(key=lambda r: (r[0], r[1]))
    floors = [1 + s for s in range(9)]
    expected = Counter()
    gap = lambda p, q: (p - q) ** 2 // q
    for s, p, times in rows:
        for a, x in zip(s, p, strict=True):
            for b, y in zip(s, p, strict=True):
                if a != b:
                    u, v = floors[a], floors[b]
                    expected[a, b] += times * (gap(x, y) - gap(x, v) - gap(u, y) + gap(u, v))
    for step in (300, 7, 1):
        got = Counter()
        for i in range(0, len(rows), step):
            part = rows[i : i + step]
            out = divergence._tree_corrections(
                [np.array(r[0]) for r in part], [np.array(r[1]) for r in part], [np.array([floors[x] for x in r[0]]) for r in part], np.array([r[2] for r in part])
            )
            for r in out.itertuples():
                got[r.a, r.b] += r.fix
        assert got == expected
