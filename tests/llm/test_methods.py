"""Each operator against a brute-force version or a property of its method, on small data."""

from __future__ import annotations

import itertools
import math
import random
import re
import textwrap
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import (
    bag_minhash,
    cube_mix,
    decontaminate,
    html_blocks,
    katz,
    license_join,
    passages,
    pii,
    quality_forest,
    toxicity,
)
from tallyframe.llm.common import WordHash, map_rows, plain_words, rolling, stored
from tallyframe.llm.components import components
from tallyframe.llm.packed import narrow, pack, unpack


def frame(spark, texts, **more):
    rows = [(i, t, "en", f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


@pytest.fixture(scope="module")
def texts():
    """Random texts with near copies of every strength, shared passages and one big group."""
    rng = random.Random(5)
    vocabulary = [a + b for a in "bcdfgklmnprst" for b in ("a", "e", "ion", "ur", "ast", "ing", "om")]
    draw = lambda n: [rng.choice(vocabulary) + rng.choice(vocabulary) for _ in range(n)]
    out = [draw(rng.randrange(5, 160)) for _ in range(120)]
    base = draw(100)
    for i in range(90):
        copy = list(rng.choice(out[:40]) if i % 2 else base)
        for _ in range(rng.randrange(0, 6)):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        out.append(copy)
    passage = draw(60)
    out += [draw(30) + passage + draw(rng.randrange(40)) for _ in range(5)]
    out += [["the"] * n for n in (3, 8, 60, 70)]
    return [" ".join(t) for t in out]


def groups_of(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 480)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = groups_of(edges, {n for e in edges for n in e})
    assert got == {n: r for n, r in want.items() if n != r}


def test_pack_round_trip():
    rng = np.random.default_rng(1)
    arrays = [rng.integers(0, 2**63, 50).astype(np.uint64), narrow(np.arange(300)), np.array([], np.int64), rng.random(7), np.array([True, False])]
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(arrays, unpack(pack(*arrays)), strict=True))


def test_blocks_by_structure():
    page = (
        "<html><head><title>t</title><script>var a='</p><article>';</script></head><body><nav><ul><li>Menu</ul></nav>"
        "<header><h1>Site</h1></header><aside>side</aside><div class='cookie-notice'>We use <b>cookies</b></div><main>"
        "<h1>Title &amp; more</h1><p>First  <i>para</i>graph<br>line</p><div class=\"ad-box\"><p>buy</p></div><form><input>go</form>"
        "<p>Of.</p><!-- <p>no</p> --><section id='comments'><article class='comment'><p>Nice!</p></article></section></main>"
        "<footer>&copy; me</footer>"
    )
    assert html_blocks.main_blocks(page) == ["Title & more", "First paragraph line", "Of."]


def test_blocks_by_distribution():
    body = "".join(f"<p>{'Sentence with some length to it, and more of it. ' * 3}</p>" for _ in range(4))
    page = f"<div><a href=x>Home</a></div><div><a href=y>News</a></div>{body}<div></div><div><a href=z>Imprint and contact</a></div>"
    assert len(html_blocks.main_blocks(page)) == 4


def test_repeated_words_brute():
    rng = random.Random(3)
    for _ in range(300):
        words = [b"%d" % rng.randrange(rng.choice([2, 3, 50])) for _ in range(rng.randrange(0, 40))]
        windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        hit = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
        assert quality_forest.repeated_words(words) == len(hit)


def test_forest_isolates_junk(spark, texts):
    junk = [" ".join(w.upper() + "!!" for w in t.split()) for t in texts[:8]] + ["a$$$ " * 5 + "b%%% c&&& d### e*** f### g%%% h$$$"]
    docs = frame(spark, [t + "." for t in texts[:120] if len(t.split()) >= 12] + junk)
    n = docs.count()
    labels = spark.createDataFrame([(i, int(i < n - len(junk)), 0) for i in range(n)], "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in quality_forest.judge_quality(docs, labels).collect()}
    assert not any(out[i]["kept"] for i in range(n - len(junk), n))
    assert sum(not out[i]["kept"] for i in range(n - len(junk))) <= 2


def test_license_join_brute(spark):
    rng, lines = random.Random(4), list(license_join.TEMPLATES)
    words = sorted({w for t in lines for w in t.split()}) + ["x", "y", "of", "the"]
    docs = []
    for _ in range(150):
        part = rng.choice(lines).split()
        for _ in range(rng.randrange(3)):
            part[rng.randrange(len(part))] = rng.choice(words)
        docs.append("\n".join([" ".join(rng.choices(words, k=rng.randrange(1, 90))), "Über " + " ".join(part), "cc by\n\nall  rights, RESERVED"]))
    got = {r["doc_id"]: r for r in license_join.scan_licenses(frame(spark, docs)).collect()}
    sets = [set(plain_words(t.encode())) for t in lines]
    size = max(len(plain_words(t.encode())) for t in lines)
    for i, text in enumerate(docs):
        seq, hits, labels, blocks = plain_words(text.encode()), [0.0], {"cc-by", "reserved"}, 0
        if "general public license" in " ".join(w.decode() for w in seq):
            labels.add("gpl")
        for at in range(0, max(len(seq) - size, 1), size):
            block = set(seq[at : at + 2 * size])
            own = {k: s & block for k, s in enumerate(sets) if len(s & block) >= 0.85 * len(s) - 1e-9}
            rank = {k: (len(o) / len(sets[k]), len(sets[k]), -k) for k, o in own.items()}
            free = [k for k in own if not any(own[k] < own[o] or (own[k] == own[o] and rank[k] < rank[o]) for o in own)]
            hits += [rank[k][0] for k in free]
            labels |= {license_join.TEMPLATES[lines[k]] for k in free}
            blocks += bool(free)
        assert got[i]["score"] == pytest.approx(max(hits)) and got[i]["n_blocks"] == blocks
        assert got[i]["labels"] == ",".join(sorted(labels))


def test_license_notices_over_lines_and_side_by_side(spark):
    """A notice wrapped at any column, in the middle of a long text, and two licenses in one line."""
    mit = next(t for t, label in license_join.TEMPLATES.items() if label == "mit" and len(t) > 60)
    wrapped = [textwrap.fill(mit, width) for width in (20, 40, 70, 80)]
    other = " ".join(f"w{i}" for i in range(500))
    both = "Licensed under CC BY 4.0 and under the Apache License, Version 2.0"
    docs = [*wrapped, f"{other}\n{wrapped[2]}\n{other}", both, "Licensed under CC BY-SA 4.0", "", None, other]
    got = {r["doc_id"]: r for r in license_join.scan_licenses(frame(spark, docs)).collect()}
    for i in range(5):
        assert (got[i]["labels"], got[i]["score"]) == ("mit", 1.0)
    assert got[5]["labels"] == "apache-2.0,cc-by,cc-by-4.0"
    assert got[6]["labels"] == "cc-by,cc-by-sa-4.0"  # the words of cc-by-4.0 are all words of it
    assert all((got[i]["labels"], got[i]["score"], got[i]["n_blocks"]) == ("", 0.0, 0) for i in (7, 8, 9))


def brute_hits(words, items, window):
    hit, found = set(), set()
    for k, (_, own) in enumerate(items):
        n = min(window, len(own))
        runs = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)}
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in runs:
                hit |= set(range(i, i + n))
                found.add(k)
    return hit, found


def test_automaton_brute():
    rng = random.Random(1)
    for _ in range(800):
        size, window = rng.choice([2, 3, 6]), rng.choice([2, 3, 4])
        items = [(str(k), [b"%d" % rng.randrange(size) for _ in range(rng.randrange(1, 9))]) for k in range(rng.randrange(1, 5))]
        words = [b"%d" % rng.randrange(size + 1) for _ in range(rng.randrange(0, 30))]
        spans, found = decontaminate.ItemAutomaton(items, window).matches(words)
        assert ({i for a, b in spans for i in range(a, b)}, found) == brute_hits(words, items, window)


def test_benchmark_in_blocks_and_removal(spark, texts):
    items = spark.createDataFrame([(i, " ".join(t.split()[3:20])) for i, t in enumerate(texts[:12])], "item_id long, text string")
    docs = frame(spark, texts)
    one = decontaminate.find_benchmark_words(docs, items).drop("starts", "ends", "items")
    many = decontaminate.find_benchmark_words(docs, items, block_words=40).drop("starts", "ends", "items")
    assert sorted(one.collect()) == sorted(many.collect())
    left = decontaminate.remove_benchmark_spans(docs, items)
    assert not decontaminate.find_benchmark_words(left, items).where("contaminated").count()
    clean = {r["doc_id"] for r in one.where("not contaminated").collect()}
    assert clean <= {r["doc_id"] for r in left.collect()}


def test_removal_is_the_same_in_blocks(spark):
    number = itertools.count()
    own = lambda n: [f"w{next(number)}" for _ in range(n)]
    a, b, c = own(40), own(40), own(40)
    items = spark.createDataFrame([(f"i{k}", " ".join(x)) for k, x in enumerate((a, b, c, own(4)))], "item_id string, text string")
    p, q = own(50), own(50)
    docs = [
        own(20) + a[:15] + own(5) + b[:15],  # 15 + 15 of 55 words, more than half
        own(40) + a[:30] + own(30) + b[5:35] + own(30),  # 60 of 160 words
        p + a[:6] + b[:12] + a[6:12] + q,  # what a cut joins is hit by another block
        p + b[:6] + a[:12] + b[6:12] + q,
        p + c[:4] + b[:6] + a[:12] + b[6:12] + c[4:12] + q,
        own(30),
        [],
    ]
    rows = frame(spark, [" ".join(d) for d in docs] + [None])
    one = decontaminate.remove_benchmark_spans(rows, items)
    left = decontaminate.remove_benchmark_spans(rows, items, block_words=50)
    got = {r["doc_id"]: r["text"] for r in left.collect()}
    assert sorted(left.collect(), key=lambda r: r["doc_id"]) == sorted(one.collect(), key=lambda r: r["doc_id"])
    assert sorted(got) == [1, 2, 3, 4, 5, 6, 7]
    assert [got[i].split() for i in (2, 3, 4)] == [p + q] * 3
    assert decontaminate.find_benchmark_words(left, items).where("contaminated").count() == 0


def test_toxicity_held_out(spark):
    rng = random.Random(6)
    plain = [f"{a}{b}" for a in ("ba", "do", "ki", "lu", "me") for b in ("ran", "tos", "vil", "pum", "gar", "len")]
    bad = [f"zork{s}" for s in ("en", "an", "il", "os", "um", "et")] + ["idiot", "moron"]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 6 == 0
        words = rng.choices(plain, k=rng.randrange(10, 60)) + (rng.choices(bad, k=4) if toxic else [])
        rng.shuffle(words)
        rows.append(" ".join(words))
        labels.append((i, 1, int(toxic)))
    out = toxicity.score_toxicity(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out) and len(held) > 100
    assert sum(r["predicted"] == (r["doc_id"] % 6 == 0) for r in held) >= 0.97 * len(held)


def test_label_model_recovers_rates():
    rng = np.random.default_rng(8)
    n, prior = 40_000, 0.2
    y = rng.random(n) < prior
    hit, false = np.array([0.9, 0.7, 0.6, 0.5, 0.8, 0.8]), np.array([0.02, 0.05, 0.01, 0.03, 0.02, 0.02])
    votes = (rng.random((n, 6)) < np.where(y[:, None], hit, false)).astype(float)
    votes[:, 5] = votes[:, 4]  # a voter that copies another one
    model = toxicity.LabelModel(n, votes.T @ votes, prior)
    assert np.abs(model.on_toxic[:4] - hit[:4]).max() < 0.06 and model.weight[5] < 0.8
    assert ((model.posterior(votes) > 0.5) == y).mean() > 0.95


def test_passages_brute(spark, texts):
    out = {r["doc_id"]: r for r in passages.repeated_passages(frame(spark, texts)).collect()}
    hashes, own, runs = WordHash(), defaultdict(set), {}
    for i, t in enumerate(texts):
        runs[i] = rolling(hashes(plain_words(t.encode())), 50).tolist()
        for h in runs[i]:
            own[h].add(i)
    for i, run in runs.items():
        need = {w for p, h in enumerate(run) if len(own[h]) > 1 for w in range(p, p + 50)}
        have = {w for s in out[i]["spans"].split(",") if s for w in range(*map(int, s.split(":")))}
        if i < len(texts) - 4:
            assert need <= have, i
        else:  # of one word over and over as much repeats as the other text holds
            assert bool(need) == bool(have)
    alone = [i for i in range(120) if i >= 40]
    assert all(not out[i]["spans"] for i in alone if all(len(own[h]) == 1 for h in runs[i]))


def test_passages_around_other_text(spark):
    number = itertools.count()
    own = lambda n: [f"w{next(number)}" for _ in range(n)]
    docs = []
    for gap in (40, 60, 80, 100, 120):
        for other in (40, 120):
            p, q = own(60), own(60)
            docs += [own(9) + p + own(gap) + q + own(7), own(5) + p + own(other) + q + own(30)]
    p, q, r = own(500), own(500), own(60)
    docs += [p + own(300) + q, own(20) + p + own(290) + q]  # gaps of more than 200 words
    p, q = own(60), own(60)
    docs += [p + own(50) + r + own(50) + q, p + own(40) + q + own(40) + r]  # r stands inside the gap of one text only
    got = {row["doc_id"]: row["spans"] for row in passages.repeated_passages(frame(spark, [" ".join(d) for d in docs])).collect()}
    for i, words in enumerate(docs):  # words are used once: the runs that follow one another in both texts
        there = {w: j for j, w in enumerate(docs[i ^ 1])}
        runs: list[list[int]] = []
        for j, w in enumerate(words):
            if w in there:
                if runs and runs[-1][1] == j and there[w] == there[words[j - 1]] + 1:
                    runs[-1][1] = j + 1
                else:
                    runs.append([j, j + 1])
        assert got[i] == ",".join(f"{a}:{b}" for a, b in runs if b - a >= 50)


def test_passage_of_two_beside_a_line_of_many(spark):
    number = itertools.count()
    own = lambda n: [f"w{next(number)}" for _ in range(n)]
    passage = own(55)
    docs = [own(30 + i) + passage + own(20) for i in range(2)]
    docs += [own(10) + passage[:40] + own(25) for _ in range(300)]  # 40 words are too few for a passage
    order = list(range(len(docs)))
    random.Random(4).shuffle(order)
    out = {r["doc_id"]: r for r in passages.repeated_passages(frame(spark, [" ".join(docs[i]) for i in order])).collect()}
    for place, i in enumerate(order):
        row = out[place]
        assert (row["spans"], row["n_links"]) == ((f"{30 + i}:{85 + i}", 1) if i < 2 else ("", 0))
    assert len({out[order.index(i)]["class_id"] for i in range(2)}) == 1


def test_passages_of_two_whose_seeds_many_hold(spark):
    """Every seed of a passage of two stands in lines of many, which alone are no passages."""
    number = itertools.count()
    own = lambda n: [f"w{next(number)}" for _ in range(n)]
    first, second, line, tail = own(30), own(30), own(40), own(30)
    docs = [own(30 + i) + first + second + own(20) for i in range(2)]  # two lines side by side
    docs += [own(15 + i) + line + own(1) + tail + own(20) for i in range(2)]  # a line, a word of its own, seeds of two
    docs += [own(25 + i) + line[:34] + [w for i in range(0, 30, 5) for w in tail[i : i + 4] + own(1)] + own(9) for i in range(2)]
    docs += [own(10) + part + own(25) for part in (first, second, line) for _ in range(60)]
    docs += [own(7) + first + own(20) + second + own(5) for _ in range(20)]
    order = list(range(len(docs)))
    random.Random(4).shuffle(order)
    out = {r["doc_id"]: r for r in passages.repeated_passages(frame(spark, [" ".join(docs[i]) for i in order])).collect()}
    spans = {i: out[place]["spans"] for place, i in enumerate(order)}
    assert (spans[0], spans[1]) == ("30:90", "31:91")
    assert (spans[2], spans[3]) == ("15:86", "16:87")
    assert (spans[4], spans[5]) == ("25:88", "26:89")
    assert not any(spans[i] for i in range(6, len(docs)))


@pytest.mark.parametrize("block", [4096, 7])
def test_every_pair_of_a_frequent_seed(spark, monkeypatch, block):
    """Texts that share a line with 150 others: each passage beside it is found, and each text's class."""
    monkeypatch.setattr(passages, "_BLOCK", block)
    rng, number = random.Random(3), itertools.count()
    own = lambda n: [f"w{next(number)}" for _ in range(n)]
    line, docs, twin = own(20), [], []
    for i in range(40):
        beside = own(40)  # four of five words are equal, never six in a row
        other = [own(1)[0] if j % 5 == 4 else w for j, w in enumerate(beside)]
        for words in (beside, other):
            docs.append(own(rng.randrange(5, 60)) + line + words + own(rng.randrange(5, 60)))
            twin.append(i)
    docs += [own(10) + line + own(30) for _ in range(70)]
    order = list(range(len(docs)))
    rng.shuffle(order)
    out = {r["doc_id"]: r for r in passages.repeated_passages(frame(spark, [" ".join(docs[i]) for i in order])).collect()}
    rows = {i: out[place] for place, i in enumerate(order)}
    for i in range(80):
        assert (rows[i]["n_links"], rows[i]["n_passages"], rows[i]["class_id"]) == (1, 1, rows[i ^ 1]["class_id"]), i
    assert not any(rows[i]["n_links"] for i in range(80, len(docs)))


def test_every_place_and_link_of_frequent_seeds(spark):
    """A passage beside the second place of a line of many; and a passage of 30 texts links each with each."""
    number = itertools.count()
    own = lambda n: [f"w{next(number)}" for _ in range(n)]
    line, passage, beside = own(20), own(60), own(40)
    other = [own(1)[0] if j % 5 == 4 else w for j, w in enumerate(beside)]
    docs = [own(30) + line + own(70) + line + words + own(20) for words in (beside, other)]
    docs += [own(15) + passage + own(25) for _ in range(30)]
    docs += [own(10) + line + own(30) for _ in range(70)]
    docs += [own(25) + ["the"] * n + own(25) for n in range(150, 160)]  # of a run every place
    out = {r["doc_id"]: r for r in passages.repeated_passages(frame(spark, [" ".join(d) for d in docs])).collect()}
    assert [(out[i]["n_links"], out[i]["spans"]) for i in range(2)] == [(1, "120:179")] * 2
    assert all((out[i]["n_links"], out[i]["spans"]) == (29, "15:75") for i in range(2, 32))
    assert not any(out[i]["n_links"] for i in range(32, 102))
    assert all((out[i]["n_links"], out[i]["spans"]) == (9, f"25:{25 + i + 48}") for i in range(102, 112))


def test_many_alike_are_connected_once():
    """Pairs within a group that passages connect are not sent one by one."""
    rng = np.random.default_rng(5)
    one = rng.integers(1, 255, 128)
    alike = np.where(rng.random((600, 128)) < 0.06, rng.integers(1, 255, (600, 128)), one).astype(np.uint8)
    apart = rng.integers(1, 255, (300, 128)).astype(np.uint8)
    rows = np.concatenate([alike, apart])[rng.permutation(900)]
    for pairs in (passages.close_pairs(rows, None, 6, 50, 0.8), passages.close_pairs(rows[:450], rows[450:], 6, 50, 0.8)):
        assert 500 < len(pairs) < 2500


def test_recall_of_changed_passages(spark):
    """Of passages that keep 80 % of their words or more, nine in ten at least are found at every length and rate."""
    rng, number, docs, kinds = random.Random(8), itertools.count(), [], []
    own = lambda n: [f"w{next(number)}" for _ in range(n)]
    for n in (60, 100, 200):
        for rate in (0.05, 0.1, 0.15):
            for _ in range(40):
                passage = own(n)
                changed = set(rng.sample(range(n), round(rate * n)))
                other = [own(1)[0] if i in changed else w for i, w in enumerate(passage)]
                docs += [own(90) + passage + own(90), own(70) + other + own(120)]
                kinds.append((n, rate))
    out = {r["doc_id"]: r for r in passages.repeated_passages(frame(spark, [" ".join(d) for d in docs])).collect()}
    found = defaultdict(list)
    for i, kind in enumerate(kinds):
        found[kind].append(out[2 * i]["n_links"] == out[2 * i + 1]["n_links"] == 1)
    assert all(np.mean(hits) >= 0.9 for hits in found.values()), {kind: np.mean(hits) for kind, hits in found.items()}


def test_long_changed_ends(spark):
    """An end without a seed of its own is followed over the whole text, whatever its length."""
    own = lambda tag, n: [f"{tag}{i}" for i in range(n)]
    end = own("e", 203)
    other = [f"x{i}" if i % 6 == 5 else w for i, w in enumerate(end)]  # five of six words, never six in a row
    docs = [own("a", 20) + own("p", 30) + end + own("b", 40), own("c", 25) + own("p", 30) + other + own("d", 30)]
    out = {r["doc_id"]: r for r in passages.repeated_passages(frame(spark, [" ".join(d) for d in docs])).collect()}
    assert (out[0]["spans"], out[1]["spans"]) == ("20:253", "25:258")


def test_leftover_chains_hold_every_segment():
    rng = random.Random(6)
    for _ in range(50):
        segments = sorted({(rng.randrange(400), rng.randrange(400), 6) for _ in range(rng.randrange(1, 40))})
        got = passages.chains(segments, 0.25, 25)
        assert sorted(s for chain in got for s in chain) == segments
        assert all(a[0] + a[2] <= b[0] and a[1] + a[2] <= b[1] for chain in got for a, b in itertools.pairwise(chain))


def test_common_words_of_gaps():
    rng = np.random.default_rng(3)
    for n, m in ((0, 5), (5, 0), (9, 9), (30, 50), (300, 250)):
        x, y = rng.integers(0, 9, n).astype(np.uint16), rng.integers(0, 9, m).astype(np.uint16)
        best = [0] * (m + 1)
        for w in x:
            row = [0]
            for j in range(m):
                row.append(best[j] + 1 if y[j] == w else max(best[j + 1], row[j]))
            best = row
        assert passages._common(x, y) == best[m]


def test_chain_is_best():
    rng = random.Random(9)
    for _ in range(200):
        segments = sorted({(rng.randrange(40), rng.randrange(40), rng.randrange(2, 8)) for _ in range(rng.randrange(1, 7))})
        best = 0.0
        for n in range(1, len(segments) + 1):
            for chain in itertools.combinations(segments, n):
                steps = list(itertools.pairwise(chain))
                if all(a[0] + a[2] <= b[0] and a[1] + a[2] <= b[1] for a, b in steps):
                    gaps = sum(b[0] - a[0] - a[2] + b[1] - a[1] - a[2] for a, b in steps)
                    best = max(best, sum(s[2] for s in chain) - 0.25 * gaps)
        chain = passages.chains(segments, 0.25, 0)[0]
        gaps = sum(b[0] - a[0] - a[2] + b[1] - a[1] - a[2] for a, b in itertools.pairwise(chain))
        assert sum(s[2] for s in chain) - 0.25 * gaps == pytest.approx(best)


@pytest.mark.parametrize("hubs, block", [(3, 2000), (1, 7)])
def test_near_duplicates_brute(spark, texts, hubs, block):
    classes = bag_minhash.near_duplicate_classes(frame(spark, texts), hubs=hubs, block=block).collect()
    bags = {}
    for i, t in enumerate(texts):
        w = t.split()
        bags[i] = Counter(tuple(w[j : j + min(5, len(w))]) for j in range(max(1, len(w) - 4)))
    links = [
        (i, j)
        for i, j in itertools.combinations(bags, 2)
        if sum((bags[i] & bags[j]).values()) >= 0.8 * sum((bags[i] | bags[j]).values())
    ]
    assert {r["doc_id"]: r["class_id"] for r in classes} == groups_of(links, bags)
    kept = [r["class_id"] for r in classes if r["kept"]]
    assert len(kept) == len(set(kept)) == len({r["class_id"] for r in classes})


def test_signatures_take_small_slices(spark, monkeypatch):
    """A task signs few rows at once, whatever Spark hands it: its arrays are many times as large as the texts."""
    taken = []

    def seen(df, columns, work, schema, start=None, size=8 << 20):
        taken.append(size)
        return map_rows(df, columns, lambda *a: {"n": pa.array([len(a[1])] * len(a[1]), pa.int64())}, "n bigint", start, size)

    monkeypatch.setattr(bag_minhash, "map_rows", seen)
    docs = spark.range(4_000, numPartitions=1).selectExpr("id AS doc_id", "repeat('some words ', 300) AS text")
    most = bag_minhash._signed(docs, 5).agg(F.max("n")).first()[0]
    assert taken == [2 << 20] and most * 3_300 <= 2 << 20


def test_bag_minhash_unbiased():
    rng, off = random.Random(3), []
    for _ in range(80):
        items = [rng.getrandbits(64) for _ in range(60)]
        one = {u: rng.choice([0, 1, 1, 2, 3, 7, 20]) for u in items}
        two = {u: v if rng.random() < 0.6 else rng.choice([0, 1, 2, 5]) for u, v in one.items()}
        rows = [(k, u, v) for k, c in enumerate((one, two)) for u, v in c.items() if v]
        owner, elements, counts = (np.array(x) for x in zip(*rows, strict=True))
        a, b = bag_minhash.signatures(owner, elements.astype(np.uint64), counts, 2)
        true = sum(min(one[u], two[u]) for u in items) / sum(max(one[u], two[u]) for u in items)
        off.append((a == b).mean() - true)
    assert abs(np.mean(off)) < 0.025 and np.std(off) < 0.09


def test_katz_brute(spark, texts):
    docs = frame(spark, texts)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    out = {r["doc_id"]: r for r in katz.score_texts(docs, held, shard_chars=8000, frequent=0.01).collect()}
    tokens = {i: [*t.encode().split(), b"\n"] for i, t in enumerate(texts)}
    train = [ws for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    one, two, before = Counter(), Counter(), Counter()
    for ws in train:
        one.update(ws)
        two.update(zip([None, *ws[:-1]], ws))
        before.update([None, *ws[:-1]])
    total, types = sum(one.values()), len(one)
    of = lambda c: np.array([sum(v == r for v in c.values()) for r in range(1, katz.CLASSES + 2)], float)
    s1, s2 = katz.discounted(of(one)), katz.discounted(of(two))
    star = lambda r, s: s[r] if r <= katz.CLASSES else r - katz.SMALL
    unknown = sum(c - star(c, s1) for c in one.values()) / total
    lower = lambda w: star(one[w], s1) / total if one[w] else unknown
    after = defaultdict(list)
    for (h, w), c in two.items():
        after[h].append((w, c))

    def p(h, w):
        if not before[h]:
            return lower(w)
        if (h, w) in two:
            return star(two[h, w], s2) / before[h]
        free = 1 - sum(star(c, s2) for _, c in after[h]) / before[h]
        return free / (1 - sum(lower(v) for v, _ in after[h])) * lower(w)

    for i, ws in tokens.items():
        assert out[i]["n_known"] == sum(one[w] > 0 for w in ws) and out[i]["train_tokens"] == total
        assert out[i]["base_score"] == pytest.approx(sum(math.log10((one[w] + 1) / (total + types + 1)) for w in ws))
        assert out[i]["score"] == pytest.approx(sum(math.log10(p(h, w)) for h, w in zip([None, *ws[:-1]], ws)), rel=1e-5)
    for h in [None, *list(after)[:5]]:
        assert sum(p(h, w) for w in one) + p(h, b"?") == pytest.approx(1)


def test_katz_folds_letters(spark):
    """A-Z are a-z, other capitals stay; only ASCII white space cuts."""
    texts = ["The THE the\x0bThE", "ÄB äb Äb", "the\u00a0The\x1cx \u212a K k", None, "", "İ the", "QED ÄB"]
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    out = {r["doc_id"]: r for r in katz.score_texts(frame(spark, texts), held).collect()}
    fold = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", fold(t)), None] for i, t in enumerate(texts)}
    train = Counter(w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    total = sum(train.values())
    for i, ws in tokens.items():
        assert (out[i]["n_tokens"], out[i]["n_known"], out[i]["train_tokens"]) == (len(ws), sum(train[w] > 0 for w in ws), total)
        assert out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 7 == 2)
        assert out[i]["base_score"] == pytest.approx(sum(math.log10((train[w] + 1) / (total + len(train) + 1)) for w in ws), abs=1e-9)


def test_targets():
    got = cube_mix.source_targets([("b", 100), (None, 1000), ("a", 10)], 1.5, 2.0, (5, 2, 1))
    assert got["a"] == 20 and got["b"] == 200 and got[None] == pytest.approx(1665 - 220)
    assert cube_mix.source_targets([("a", 0)], 1.5, 2.0, (1,)) == {"a": 0.0}


@pytest.mark.parametrize("block_rows", [2000, 12])
def test_mix_is_balanced(spark, texts, block_rows):
    docs = frame(spark, texts)
    rows = cube_mix.mix_sources(docs, block_rows=block_rows).collect()
    again = cube_mix.mix_sources(docs.repartition(5), block_rows=block_rows).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in rows) == sorted((r["doc_id"], r["taken"]) for r in again)
    for source in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 0.02 * own[0]["target"] + 5
    assert all(r["taken"] <= 2 * r["size"] for r in rows)


def test_flight_keeps_totals():
    rng = random.Random(2)
    for _ in range(50):
        sizes, p = [rng.randrange(1, 50) for _ in range(30)], [rng.random() for _ in range(30)]
        q = cube_mix.flight(sizes, p, rng)
        assert sum(0 < x < 1 for x in q) <= 2
        assert sum(q) == pytest.approx(sum(p)) and sum(a * b for a, b in zip(sizes, q)) == pytest.approx(sum(a * b for a, b in zip(sizes, p)))


def test_disclosing_terms(spark):
    texts = [f"write to x{i % 2}@mail.org about zebra{i % 2} and the weather" for i in range(8)] + ["the weather and about to write"] * 40
    rows = pii.digest(pii.find_personal_data(frame(spark, texts))).collect()
    for r in rows:
        if r["doc_id"] < 8:
            assert r["spans"] == "email:9:20,term:27:33" and r["n_email"] == 1
        else:
            assert r["spans"] == ""
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(frame(spark, texts)).collect()}
    assert clean[1] == "write to [email] about zebra0 and the weather" and clean[20] == texts[20]


def test_disclosing_terms_anywhere(spark):
    """Other lines, far places, short words and every place of a word count; words that touch an entity are part of it."""
    far = "the weather and about to write\n" * 30
    texts = [f"qx is here\n{far}see x{i % 2}@mail.org\n\n{far}zebra{i % 2} and ZEBRA{i % 2}" if i % 2 == 0 else far + "1.2.3.4" for i in range(8)]
    texts += [far] * 40
    docs = frame(spark, texts)
    got = {r["doc_id"]: r for r in pii.digest(pii.find_personal_data(docs)).collect()}
    for i, text in enumerate(texts):
        told = [m.span() for m in re.finditer("qx|zebra0|ZEBRA0|is|here|see", text)] if i < 8 and i % 2 == 0 else []
        kinds = [(m.start(), "email", m.end()) for m in re.finditer(r"x0@mail\.org", text)] + [(a, "term", b) for a, b in told]
        kinds += [(m.start(), "ip", m.end()) for m in re.finditer(r"1\.2\.3\.4", text)]
        assert got[i]["spans"] == ",".join(f"{k}:{a}:{b}" for a, k, b in sorted(kinds))


def test_entities_brute(spark):
    import re

    kinds = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    valid = {
        "email": lambda v, d: True,
        "ip": lambda v, d: all(int(x) <= 255 for x in v.split(".")),
        "card": lambda v, d: 14 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0,
        "phone": lambda v, d: 10 <= len(d) <= 15,
    }
    rng, atoms = random.Random(7), ["a", ".b", "@", "@c.d", "1", "23", "255", "256", ".", " ", "-", "+", "+1 (", ")", "4111 1111 1111 1111", "é\U0001f600", "_e@f.g", "+4930123456"]
    texts = ["".join(rng.choices(atoms, k=rng.randrange(1, 14))) for _ in range(1500)]
    got = {r["doc_id"]: r["spans"] for r in pii.digest(pii.find_personal_data(frame(spark, texts), support=10**6)).collect()}
    for i, text in enumerate(texts):
        found = [(m.start(), k, m.end(), n) for k, (n, q) in enumerate(kinds.items()) for m in re.finditer(q, text) if valid[n](m[0], re.sub(r"\D", "", m[0]))]
        assert got[i] == ",".join(f"{n}:{a}:{b}" for a, _, b, n in sorted(found)), text


def test_stored_needs_a_shared_folder(spark):
    assert stored(spark.range(3), "three").count() == 3


def test_mix_of_repeated_rows(spark):
    """The stage reads as many words as the mix takes, also where rows repeat."""
    texts = [" ".join(f"w{j}" for j in range(3 + i % 4)) for i in range(40)]
    rows = [(i, t, "en", f"s{i % 2}", len(t)) for i, t in enumerate(texts)]
    rows += [rows[3]] * 7 + [rows[4]] * 6 + [(None, "a b c", "en", None, 5)] * 5 + [(3, texts[3], "en", "s0", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    mixed = cube_mix.mix_sources(docs).collect()
    out = cube_mix.apply_mix(docs).collect()
    taken, read = Counter(), Counter()
    for r in mixed:
        taken[r["doc_id"], r["source"]] += r["taken"]
    for r in out:
        read[r["doc_id"], r["source"]] += r["copies"] * len(r["text"].split())
    assert +taken == read and len(out) == len(read)


def test_places_of_many_matches(spark):
    """Matches beyond one run of the span builder, as plain patterns find them."""
    for n in (0, 1, 63, 64, 65, 130, 1000):
        text = " é ".join(f"u{i}@h{i % 7}.org" for i in range(n)) + " 10.0.0.1"
        got = spark.createDataFrame([(text,)], "t string").select(pii.entity_spans(F.col("t"))).collect()[0][0]
        mails = [(m.start(), m.end(), m.group()) for m in re.finditer(r"[a-z0-9]+@[a-z0-9]+\.org", text)]
        assert [(s["start"], s["end"], s["value"]) for s in got if s["rank"] == 0] == mails
        assert [s["value"] for s in got if s["rank"] == 1] == ["10.0.0.1"]
