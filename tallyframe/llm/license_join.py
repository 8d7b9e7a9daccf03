"""License scan: an exact set-similarity join of text blocks with license templates.

A text block is a window over the words of the whole text, wherever its lines
end. A template is found in a block if the block holds at least `containment`
of the template's distinct words; every template found counts, but for one
whose words there are all words of another one found in the block. The words of the
templates are ordered by their document frequency in the whole corpus, rarest
first. A match needs `need` common words, so one of them stands in the first
size - need + 1 of the template (prefix filter); the block must hold `need`
template words at all (length filter); and after the first common word both
sides must have enough left (positional filter). What passes is verified, so
no match is lost. Templates are a short fixed list and travel to the tasks; the
corpus is never shuffled.
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import map_rows, plain_words

# Phrases with the label of each.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Wordings of license notices with the label of each.
TEMPLATES = {
    "Licensed under CC BY 4.0": "cc-by-4.0",
    "Licensed under CC BY-SA 4.0": "cc-by-sa-4.0",
    "Licensed under CC BY-NC 4.0": "cc-by-nc-4.0",
    "This work is licensed under a Creative Commons Attribution 4.0 International License": "cc-by-4.0",
    "Licensed under the Apache License, Version 2.0": "apache-2.0",
    "This work is licensed under the GNU General Public License, version 2": "gpl-2.0",
    "This work is licensed under the GNU General Public License, version 3": "gpl-3.0",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation": "gpl",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files": "mit",
    "Released under the MIT License": "mit",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met": "bsd",
    "This Source Code Form is subject to the terms of the Mozilla Public License": "mpl",
    "All rights reserved. No part of this publication may be reproduced": "reserved",
}


def phrase_places(words: list[bytes], phrases: dict[str, str]) -> list[tuple[int, int, str]]:
    """(first word, last word, label) of every place where the words of a phrase stand in a row."""
    line, out = b" " + b" ".join(words) + b" ", []
    for phrase, label in phrases.items():
        sought = phrase.split()
        key = b" " + " ".join(sought).encode() + b" "
        at = line.find(key)
        while at >= 0:
            first = line.count(b" ", 0, at)
            out.append((first, first + len(sought) - 1, label))
            at = line.find(key, at + 1)
    return out


def text_blocks(words: list[bytes], size: int) -> list[list[bytes]]:
    """Windows of 2 * size words that overlap by size words, so each run of size + 1 words stands in one of them."""
    return [words[i : i + 2 * size] for i in range(0, max(len(words) - size, min(len(words), 1)), size)]


def _word_frequencies(docs: DataFrame, words: frozenset[bytes]) -> dict[bytes, int]:
    """Documents that hold each of the given words; one row per word comes back."""

    def work(texts: list) -> dict[str, pa.Array]:
        counts = Counter(w for t in texts if t for w in words.intersection(plain_words(t)))
        return {"word": pa.array(list(counts), pa.binary()), "n": pa.array(list(counts.values()), pa.int64())}

    found = map_rows(docs, {"text": "string"}, work, "word binary, n bigint")
    return {bytes(r["word"]): r["n"] for r in found.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    phrases: dict[str, str] | None = None,
    containment: float = 0.85,
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and n_blocks per row of docs.

    base_*: places of the phrases. labels: theirs and those of all templates
    found in a block; score: the largest containment among these, 0 without any;
    n_blocks: blocks with a match. Of two templates found by the same words the
    one with the larger containment counts, then the longer, then the first.
    Null and empty texts have no words and no labels; a long text is looked at
    whole. Repeated rows give repeated results, null ids pass through.
    """
    phrases = PHRASES if phrases is None else phrases
    sets = [(frozenset(plain_words(t.encode())), label) for t, label in (templates or TEMPLATES).items()]
    sets = [(s, label) for s, label in sets if s]
    known = frozenset().union(*(s for s, _ in sets))
    seen = _word_frequencies(docs, known)
    rank = {w: i for i, w in enumerate(sorted(known, key=lambda w: (seen.get(w, 0), w)))}
    size = max((len(plain_words(t.encode())) for t in (templates or TEMPLATES)), default=1) or 1
    ordered = [sorted(rank[w] for w in s) for s, _ in sets]
    needs = [max(1, math.ceil(containment * len(t) - 1e-9)) for t in ordered]
    least = min(needs, default=0)
    prefixes: dict[int, list[tuple[int, int]]] = {}
    for k, (t, need) in enumerate(zip(ordered, needs, strict=True)):
        for j, w in enumerate(t[: len(t) - need + 1]):
            prefixes.setdefault(w, []).append((k, j))
    model = docs.sparkSession.sparkContext.broadcast((rank, [frozenset(t) for t in ordered], needs, prefixes))

    def matches(block: list[bytes]) -> dict[int, float]:
        rank, sets_, needs, prefixes = model.value
        have = sorted(rank[w] for w in rank.keys() & set(block))
        if len(have) < least:  # length filter
            return {}
        tried, found = set(), {}
        for i, w in enumerate(have):
            for k, j in prefixes.get(w, ()):
                if k in tried:
                    continue
                tried.add(k)  # its first common word in the order: both rests decide
                if 1 + min(len(have) - i - 1, len(sets_[k]) - j - 1) >= needs[k]:
                    common = len(sets_[k].intersection(have))
                    if common >= needs[k]:
                        found[k] = common / len(sets_[k])
        if len(found) < 2:
            return found
        own = {k: sets_[k].intersection(have) for k in found}
        order = {k: (found[k], len(sets_[k]), -k) for k in found}
        covered = lambda k: any(own[k] < own[o] or (own[k] == own[o] and order[k] < order[o]) for o in found)
        return {k: share for k, share in found.items() if not covered(k)}

    names = [label for _, label in sets]
    rare = frozenset(w for w in known if rank[w] in prefixes)

    def work(ids: list, texts: list) -> dict[str, pa.Array]:
        rows = []
        for text in texts:
            words = plain_words(text)
            places = phrase_places(words, phrases)
            best: dict[str, float] = {}
            hit = 0
            if not rare.isdisjoint(words):  # a text without any prefix word has no candidate
                for block in text_blocks(words, size):
                    found = matches(block)
                    hit += bool(found)
                    for k, share in found.items():
                        best[names[k]] = max(share, best.get(names[k], 0.0))
            base = {label for _, _, label in places}
            rows.append(
                (
                    len(words),
                    len(places),
                    min((p[0] for p in places), default=None),
                    max((p[0] for p in places), default=None),
                    ",".join(sorted(base)),
                    ",".join(sorted(base | best.keys())),
                    max(best.values(), default=0.0),
                    hit,
                )
            )
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int64())
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
        names_ = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_blocks")
        return {"doc_id": pa.array(ids, pa.int64())} | {
            n: pa.array(c, k) for n, c, k in zip(names_, columns, kinds, strict=True)
        }

    return map_rows(
        docs,
        {"doc_id": "bigint", "text": "string"},
        work,
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
        "labels string, score double, n_blocks bigint",
    )
