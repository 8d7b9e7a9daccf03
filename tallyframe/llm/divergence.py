"""Audit of sources: how far the word use of each source is from the others of its language, exactly.

Every kept term of a language is a row of counts by source, mostly zero. The
divergence of two sources is a sum over all terms; with zero counts on both
sides every term gives the same, so only corrections for non-zero counts have
to be added. Rows travel as source-ordered lists of the non-zero places, equal
rows once with their number, and are inserted into a prefix tree (a
frequent-pattern tree, frequent sources first). A node stands for a source, its
value and all that stands above it; its multiplicity is the number of terms
below. For every node and each of its ancestors the correction of that pair of
sources is worked out once and multiplied.

Sorted rows make the tree implicit: a node is a run of rows with the same
beginning. Corrections add up, so a tree may be cut anywhere: rows are sorted
in ranges over the cluster and each batch of rows is a tree of its own. No term,
source or beginning is gathered in one task; only sums per pair of sources
leave one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import _bounded, stored

SCALE = 1_000_000_000
# Letters and everything beyond ASCII, A-Z as a-z, all else a gap.
_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
_EXACT = "decimal(38,0)"


def _term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, df): occurrences and documents of each term, added up per batch first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _bounded(batch):
                texts, langs, sources = (c.cast(pa.binary()).to_pylist() for c in part.columns)
                # A counter per group takes a whole text at once; a key of three parts would cost a step for each word.
                groups: dict[tuple[bytes, bytes], tuple[Counter, Counter]] = {}
                for text, *key in zip(texts, langs, sources, strict=True):
                    total, within = groups.setdefault(tuple(key), (Counter(), Counter()))
                    words = text.translate(_LETTERS).split()
                    total.update(words)
                    within.update(set(words))
                places = np.repeat(np.arange(len(groups)), [len(total) for total, _ in groups.values()])
                names = [pa.array([key[i] for key in groups], pa.binary()).cast(pa.string()).take(pa.array(places)) for i in range(2)]
                terms = pa.array([t for total, _ in groups.values() for t in total], pa.binary()).cast(pa.string())
                numbers = [
                    pa.array([n for total, _ in groups.values() for n in total.values()], pa.int64()),
                    pa.array([within[t] for total, within in groups.values() for t in total], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays([*names, terms, *numbers], names=["lang", "source", "term", "n", "df"])

    counted = docs.mapInArrow(count, "lang string, source string, term string, n long, df long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def _share(count: Column | str, total: Column | str) -> Column:
    """1 + floor(SCALE * (count + 1) / total) in whole numbers; ``total`` already holds the number of terms."""
    if isinstance(count, str):
        count = F.col(count)
    top = (count.cast(_EXACT) + 1) * F.lit(SCALE).cast("decimal(10,0)")
    return (F.expr("1L") + F.call_function("div", top, F.col(total) if isinstance(total, str) else total)).cast("long")


def _gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q): shares are at most SCALE + 1, so the square fits into a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def _tree_corrections(sources: list[np.ndarray], shares: list[np.ndarray], floors: list[np.ndarray], times: np.ndarray) -> pd.DataFrame:
    """Corrections (a, b, fix) of one tree, given its rows as arrays in sorted order.

    With f the gap and 0 the share of a count of zero, a term adds to the pair
    (a, b) f(a, 0) - f(0, 0) and f(0, b) - f(0, 0) for single places, and
    f(a, b) - f(a, 0) - f(0, b) + f(0, 0) where both are there. Single places
    need the other sources, not the tree; this is the part for both.
    """
    rows = len(times)
    sizes = np.fromiter(map(len, sources), np.int64, rows)
    deepest = int(sizes.max(initial=0))
    table = np.full((3, rows, deepest), -1, np.int64)
    inside = np.arange(deepest) < sizes[:, None]
    for level, parts in zip(table, (sources, shares, floors), strict=True):
        level[inside] = np.concatenate([np.asarray(p, np.int64) for p in parts]) if rows else []
    # A node of depth d begins at each row whose first d + 1 places differ from those of the row before.
    fresh = np.ones((rows, deepest), bool)
    same = (table[0, 1:] == table[0, :-1]) & (table[1, 1:] == table[1, :-1])
    fresh[1:] = ~np.logical_and.accumulate(same, axis=1)
    found = []
    for depth in range(1, deepest):
        begins = np.flatnonzero(fresh[:, depth] & inside[:, depth])
        if not len(begins):
            continue
        below = np.add.reduceat(np.where(inside[:, depth], times, 0), begins)
        a, p, p0 = table[:, begins, :depth]
        b, q, q0 = np.broadcast_to(table[:, begins, depth, None], (3, *a.shape))
        for x, y, u, u0, v, v0 in ((a, b, p, p0, q, q0), (b, a, q, q0, p, p0)):
            fix = _whole_gap(u, v) - _whole_gap(u, v0) - _whole_gap(u0, v) + _whole_gap(u0, v0)
            found.append(pd.DataFrame({"a": x.ravel(), "b": y.ravel(), "fix": (fix * below[:, None]).ravel()}))
    if not found:
        return pd.DataFrame({"a": [], "b": [], "fix": []}, dtype="int64")
    return pd.concat(found).groupby(["a", "b"], as_index=False).sum()


def _whole_gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _both(rows: DataFrame, partitions: int) -> DataFrame:
    """(lang, a, b, fix) summed over the trees of all batches of the sorted rows."""

    def correct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, part in batch.groupby("lang", sort=False):
                # A tree's table has rows times deepest places: few rows at a time where terms have very many sources.
                step = max(1, 2_000_000 // max(1, int(part["s"].map(len).max()) ** 2))
                for i in range(0, len(part), step):
                    cut = part.iloc[i : i + step]
                    out = _tree_corrections(list(cut["s"]), list(cut["p"]), list(cut["z"]), cut["times"].to_numpy())
                    out.insert(0, "lang", lang)
                    yield out

    # Sorted ranges, not hashes: rows with a common beginning meet, and a beginning that many rows share is cut.
    ordered = rows.repartitionByRange(partitions, "lang", "s", "p").sortWithinPartitions("lang", "s", "p")
    fixes = ordered.mapInPandas(correct, "lang string, a long, b long, fix long")
    return fixes.groupBy("lang", "a", "b").agg(F.sum(F.col("fix").cast(_EXACT)).alias("fix"))


def audit_sources(docs: DataFrame, min_docs: int = 3, top_terms: int = 200) -> DataFrame:
    """Ranked divergences of every (lang, source): from the other sources of its language, and of its terms from the language.

    Part ``pair`` has each other source of the language (``item``) with the sum
    over all kept terms (in ``min_docs`` documents of the language or more) of
    floor((p - q)^2 / q), p and q being smoothed shares in billionths; part
    ``term`` the ``top_terms`` terms that the source uses more than its language.
    Equal values rank by UTF-8 item. All arithmetic is in whole numbers.

    NULL text, lang and source count as empty; an empty text has no terms, but
    its group occurs. Repeated rows are documents of their own. A language
    without kept terms has only pairs of value 0; an empty table gives no rows.
    Only text, lang and source are read, so other columns cannot clash. The row
    of a term is as long as the number of sources that use it, and the result
    has a row for each pair of sources of a language.
    """
    plain = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    counts = stored(_term_counts(plain), "counts")
    groups = plain.select("lang", "source").distinct()
    terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.sum("df").alias("df")).where(F.col("df") >= min_docs)
    terms = stored(terms.select("lang", "term", "all_n"), "terms")
    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("all_n").alias("all_total"))
    kept = stored(counts.select("lang", "source", "term", "n").join(terms, ["lang", "term"]), "kept")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("used"))
    frequent_first = Window.partitionBy("lang").orderBy(F.coalesce("used", F.lit(0)).desc(), "source")
    whole = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").withColumn(
        "s", (F.row_number().over(frequent_first) - 1).cast("int")
    )
    v = F.coalesce("v", F.lit(0))
    whole = stored(
        whole.select(
            "lang",
            "source",
            "s",
            v.alias("v"),
            (F.coalesce("total", F.lit(0)) + v).alias("below"),
            (F.coalesce("all_total", F.lit(0)) + v).alias("all_below"),
        ).withColumn("z", F.when(F.col("v") > 0, _share(F.lit(0), "below"))),
        "sources",
    )
    places = kept.join(whole, ["lang", "source"]).withColumn("p", _share("n", "below"))

    # Terms of the group that stand out from the language.
    q = _share("all_n", "all_below")
    over = places.withColumn("q", q).where("p > q").select("lang", "source", F.col("term").alias("item"), _gap(F.col("p"), F.col("q")).alias("value"))
    first = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    over = over.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top_terms)

    # Pairs: what zero counts give, corrections for single places, corrections of the tree.
    entry = F.struct("s", "p", "z")
    rows = places.groupBy("lang", "term").agg(F.sort_array(F.collect_list(entry)).alias("row"))
    rows = rows.groupBy("lang", *[F.col(f"row.{c}").alias(c) for c in ("s", "p", "z")]).agg(F.count("*").alias("times"))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tree = _both(rows, partitions)
    levels = places.groupBy("lang", "s", "p").agg(F.count("*").alias("times"))
    a = whole.select("lang", F.col("source"), F.col("s").alias("a"), F.col("z").alias("az"), "v")
    b = whole.select("lang", F.col("source").alias("item"), F.col("s").alias("b"), F.col("z").alias("bz"))
    pairs = a.join(b, "lang").where("a <> b")
    az, bz, p = F.col("az"), F.col("bz"), F.col("p")
    zero = _gap(az, bz)
    mine = a.join(levels.withColumnRenamed("s", "a"), ["lang", "a"]).join(b, "lang").where("a <> b")
    mine = mine.select("lang", "a", "b", ((_gap(p, bz) - zero).cast(_EXACT) * F.col("times")).alias("fix"))
    theirs = b.join(levels.withColumnRenamed("s", "b"), ["lang", "b"]).join(a, "lang").where("a <> b")
    theirs = theirs.select("lang", "a", "b", ((_gap(az, p) - zero).cast(_EXACT) * F.col("times")).alias("fix"))
    single = mine.unionByName(theirs)
    fixes = single.unionByName(tree.select("lang", "a", "b", "fix")).groupBy("lang", "a", "b").agg(F.sum("fix").cast(_EXACT).alias("fix"))
    value = F.coalesce(zero.cast(_EXACT) * F.col("v"), F.lit(0)) + F.coalesce("fix", F.lit(0))
    summed = pairs.join(fixes, ["lang", "a", "b"], "left").select("lang", "source", "item", value.cast("long").alias("value"))
    paired = summed.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")))

    columns = ["lang", "source", F.lit("pair").alias("part"), "item", "value", F.col("rank").cast("int").alias("rank")]
    return paired.select(*columns).unionByName(over.select(*columns[:2], F.lit("term").alias("part"), *columns[3:]))
