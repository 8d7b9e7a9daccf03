"""Near duplicates by BagMinHash: weighted Jaccard similarity of multisets of word shingles.

A shingle that stands c times is a Poisson process on the weights 0 to c. The
weights are cut in dyadic intervals, each with a process of its own that all
texts share, and only points below c count, so the earliest point per register
is equal in two texts with the probability of their weighted Jaccard
similarity. Points come in order of time, and a process ends once it is later
than every register, so long texts need little more than a point per shingle.

Texts of equal multisets are one class from the start. Signatures are cut into
bands; in each bucket the texts that share most buckets with others serve as
hubs that all members are held against, which makes the work linear in the
bucket. What stays apart is then compared in blocks, by signature and by a
bound on the overlap. Only pairs whose exact multiset overlap reaches the
threshold are links.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import WordHash, _bounded, map_rows, mixed, plain_words, rolling, stored, uniform
from tallyframe.llm.components import components

REGISTERS, BANDS = 64, 16
_SLICE = 2 << 20  # bytes of rows that a task works on at once: its arrays are many times as large
_STEP, _LEVEL = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _steps(n: int, step: np.uint64) -> np.uint64:
    """n steps, modulo 2 ** 64."""
    return np.uint64(n * int(step) % 2**64)


def shingle_counts(words: list[bytes], hashes: WordHash, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles (hashes, ascending) and how often each stands; a shorter text is one shingle."""
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.unique(rolling(hashes(words), min(size, len(words))), return_counts=True)


def units(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The multiset as a set: the i-th occurrence of a shingle is an element of its own. Sorted."""
    extra = counts > 1
    if not extra.any():
        return shingles
    again, n = shingles[extra], counts[extra] - 1
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + 1
    return np.sort(np.concatenate([shingles, mixed(np.repeat(again, n) + nth.astype(np.uint64) * _LEVEL)]))


def signatures(owner: np.ndarray, shingles: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """Earliest points, one row of REGISTERS per owner 0..n-1; infinite for an owner without shingles."""
    registers = np.full(n * REGISTERS, np.inf)
    parts = []
    for level in range(int(counts.max(initial=0)).bit_length() + 1):  # [0,1), then [1,2), [2,4), ...
        low = 0 if level == 0 else 1 << (level - 1)
        there = counts > low
        if not there.any():
            break
        width = np.full(there.sum(), 1 if level == 0 else low, np.float64)
        share = np.minimum((counts[there] - low) / width, 1.0)
        parts.append((owner[there], mixed(shingles[there] + _steps(level + 1, _LEVEL)), width, share))
    if not parts:
        return registers.reshape(n, REGISTERS)
    who, seed, width, share = (np.concatenate(x) for x in zip(*parts, strict=True))
    time, i = np.zeros(len(who)), 0
    while len(who):
        time = time - np.log(uniform(mixed(seed + _steps(2 * i + 1, _STEP)))) / width
        latest = registers.reshape(n, REGISTERS).max(1)
        live = time <= latest[who]
        who, seed, width, share, time = who[live], seed[live], width[live], share[live], time[live]
        point = mixed(seed + _steps(2 * i + 2, _STEP))
        hit = uniform(point) <= share
        np.minimum.at(registers, (who * REGISTERS + (point & np.uint64(REGISTERS - 1)).astype(np.int64))[hit], time[hit])
        i += 1
    return registers.reshape(n, REGISTERS)


def _key() -> Column:
    """What tells rows apart; rows that agree in it and the id are repeated rows."""
    return F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))


def _signed(docs: DataFrame, size: int) -> DataFrame:
    """row, doc_id, key, n (units), same (hash of the multiset), bands and marks (one byte per register) per row of docs."""

    def work(hashes: WordHash, ids: list, texts: list, keys_: list) -> dict[str, pa.Array]:
        sets = [shingle_counts(plain_words(t), hashes, size) for t in texts]
        owner = np.repeat(np.arange(len(sets)), [len(s) for s, _ in sets])
        flat = [np.concatenate([x[k] for x in sets]) if sets else np.empty(0, int) for k in (0, 1)]
        bits = signatures(owner, flat[0].astype(np.uint64), flat[1], len(sets)).view(np.uint64)
        spread = mixed(bits)
        rows = REGISTERS // BANDS
        keys = np.zeros((len(sets), BANDS), np.uint64)
        for j in range(rows):
            keys = mixed(keys * _STEP + spread[:, j::rows])
        marks = (spread & np.uint64(255)).astype(np.uint8)
        full = [len(s) > 0 for s, _ in sets]
        return {
            "doc_id": pa.array(ids, pa.int64()),
            "key": pa.array(keys_, pa.int64()),
            "n": pa.array([int(c.sum()) for _, c in sets], pa.int64()),
            "same": pa.array(
                [xxhash.xxh3_128_digest(s.tobytes() + c.tobytes()) if f else None for (s, c), f in zip(sets, full, strict=True)],
                pa.binary(),
            ),
            "bands": pa.array([k.view(np.int64) if f else None for k, f in zip(keys, full, strict=True)], pa.list_(pa.int64())),
            "marks": pa.array([m.tobytes() if f else None for m, f in zip(marks, full, strict=True)], pa.binary()),
        }

    docs = docs.select("doc_id", "text", _key().alias("key"))
    kinds = {"doc_id": "bigint", "text": "string", "key": "bigint"}
    schema = "doc_id bigint, key bigint, n bigint, same binary, bands array<bigint>, marks binary"
    return map_rows(docs, kinds, work, schema, start=WordHash, size=_SLICE).withColumn("row", F.monotonically_increasing_id())


def _bags(texts: DataFrame, size: int) -> DataFrame:
    """row and its units as packed 32-bit numbers, for texts(row, text)."""

    def work(hashes: WordHash, rows: list, texts: list) -> dict[str, pa.Array]:
        packed = []
        for text in texts:
            bag = units(*shingle_counts(plain_words(text), hashes, size))
            packed.append(np.sort((bag >> np.uint64(32)).astype(np.uint32)).tobytes())
        return {"row": pa.array(rows, pa.int64()), "bag": pa.array(packed, pa.binary())}

    return map_rows(texts, {"row": "bigint", "text": "string"}, work, "row bigint, bag binary", start=WordHash, size=_SLICE)


def _overlap(a, b) -> float:
    """Weighted Jaccard similarity of two packed bags."""
    x, y = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
    both = np.sort(np.concatenate([x, y]), kind="stable")
    common = _pairs_of(both) if len(both) else 0
    return common / (len(x) + len(y) - common) if len(both) else 0.0


def _pairs_of(both: np.ndarray) -> int:
    """Elements that two sorted bags share; a value that one bag holds twice (a chance event of 32 bits) counts once."""
    return int((both[1:] == both[:-1]).sum())


def _verified(pairs: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    """Those of pairs(a, b) whose bags overlap enough."""

    def check(batches):
        for part in (p for batch in batches for p in _bounded(batch, _SLICE)):
            a, b, x, y = (c.to_pylist() for c in part.columns)
            ok = [_overlap(p, q) >= threshold - 1e-12 for p, q in zip(x, y, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v for v, k in zip(c, ok, strict=True) if k], pa.int64()) for c in (a, b)], names=["a", "b"]
            )

    one = bags.select(F.col("row").alias("a"), F.col("bag").alias("x"))
    two = bags.select(F.col("row").alias("b"), F.col("bag").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def _alike(pairs: DataFrame, marks: DataFrame, least: float) -> DataFrame:
    """Those of pairs(a, b) whose signatures agree in a share of `least` registers at least."""

    def check(batches):
        for batch in batches:
            a, b, x, y = batch.columns
            agree = _matrix(x) == _matrix(y)
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(agree.mean(1) >= least))

    one = marks.select(F.col("row").alias("a"), F.col("marks").alias("x"))
    two = marks.select(F.col("row").alias("b"), F.col("marks").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def _matrix(column) -> np.ndarray:
    values = column.to_pylist() if hasattr(column, "to_pylist") else list(column)
    return np.frombuffer(b"".join(values), np.uint8).reshape(len(values), REGISTERS)


def _shared_at_most(bags: list[np.ndarray], rows: np.ndarray, others: list[np.ndarray], other_rows: np.ndarray) -> np.ndarray:
    """For each bag the units that any other of the others holds too: no single overlap can be larger."""
    values, counts = np.unique(np.concatenate(others), return_counts=True)
    there = np.isin(rows, other_rows)
    out = np.zeros(len(bags), np.int64)
    for i, bag in enumerate(bags):
        at = np.minimum(np.searchsorted(values, bag), len(values) - 1)
        out[i] = ((values[at] == bag) & (counts[at] > there[i])).sum()
    return out


def _apart(least: float, threshold: float):
    """Links that join components within one block of a bucket.

    A pair is looked at if its signatures are alike, its bags could overlap
    enough (units that nobody else in the block holds cannot be shared), and
    no link found before has joined its components.
    """

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        left, right = block[block["side"] == 0], block[block["side"] == 1]
        links: list[tuple[int, int]] = []
        if len(left) and len(right):
            x, y = _matrix(left["marks"]), _matrix(right["marks"])
            xr, yr = left["row"].to_numpy(), right["row"].to_numpy()
            xb, yb = ([np.frombuffer(b, np.uint32) for b in side["bag"]] for side in (left, right))
            xn, yn = (np.array([len(b) for b in bags]) for bags in (xb, yb))
            xs, ys = _shared_at_most(xb, xr, yb, yr), _shared_at_most(yb, yr, xb, xr)
            names, code = np.unique(np.concatenate([left["comp"], right["comp"]]), return_inverse=True)
            xc, yc = code[: len(xr)], code[len(xr) :].copy()
            group = np.arange(len(names))  # components as joined so far
            for i in range(len(xr)):
                most = np.minimum(xs[i], ys)
                could = most >= (threshold - 1e-12) * (xn[i] + yn - most)
                agree = (y[could] == x[i]).mean(1)
                near = np.flatnonzero(could)[agree >= least]
                for j in near[np.argsort(-agree[agree >= least], kind="stable")]:
                    if group[xc[i]] != group[yc[j]] and _overlap(xb[i], yb[j]) >= threshold - 1e-12:
                        links.append((min(xr[i], yr[j]), max(xr[i], yr[j])))
                        group[group == group[yc[j]]] = group[xc[i]]
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return compare


def near_duplicate_classes(
    docs: DataFrame, size: int = 5, threshold: float = 0.8, least: float = 0.62, hubs: int = 3, block: int = 1000
) -> DataFrame:
    """row, doc_id, key, class_id, class_size and kept (one row of each class) per row of docs(doc_id, text).

    A class is a connected component of links, texts whose multisets of `size`
    words have a weighted Jaccard similarity of `threshold` at least; class_id
    is its smallest doc_id, and that row is kept (of rows that share the id,
    or have none, one). A text without words resembles nothing and is a class
    of its own. Shorter texts are one shingle. Repeated rows are copies.
    `least`: share of registers in which candidates must agree, more than three
    standard deviations below the threshold. `hubs`: members of a bucket that
    all others are compared with at once; `block`: rows of a bucket per task
    when what is still apart is compared.
    """
    signed = stored(_signed(docs.select("doc_id", "text"), size), "signed")
    # Tables of one row per group are written before rows join them: then Spark can split a large group.
    copies = stored(signed.where("same is not null").groupBy("same").agg(F.min("row").alias("rep")), "copies")
    member = signed.where("same is not null").select("row", "same").join(copies, "same").select("row", "rep")
    member = stored(member, "member")
    reps = stored(signed.join(member.where("row = rep").select("row"), "row").select("row", "bands", "marks"), "reps")
    marks = reps.select("row", "marks")
    keyed = reps.select("row", F.posexplode("bands").alias("band", "key"))
    shared = keyed.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    buckets = stored(keyed.join(shared, ["band", "key"]), "buckets")
    fame = buckets.groupBy("row").agg(F.sum("n").alias("fame"))
    ranked = buckets.join(fame, "row")
    rank = "row_number() over (partition by band, key order by fame desc, row)"
    centre = ranked.withColumn("place", F.expr(rank)).where(F.col("place") <= hubs)
    centre = centre.select("band", "key", F.col("row").alias("hub"))
    star = buckets.join(centre, ["band", "key"]).where("row <> hub")
    pairs = star.select(F.least("row", "hub").alias("a"), F.greatest("row", "hub").alias("b")).distinct()
    pairs = stored(_alike(pairs, marks, least), "pairs")
    # The texts behind the candidates, each read once.
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
    wanted = wanted.union(buckets.where(F.col("n") > hubs + 1).select("row")).distinct()
    wanted = signed.select("row", F.col("doc_id").alias("_id"), F.col("key").alias("_of")).join(wanted, "row")
    texts = docs.select(F.col("doc_id").cast("bigint"), "text", _key().alias("_key"))
    texts = texts.join(wanted, (F.col("_key") == F.col("_of")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    bags = stored(_bags(texts.select("row", "text"), size), "bags")
    if bags.count() > bags.select("row").distinct().count():  # repeated rows
        bags = bags.groupBy("row").agg(F.min("bag").alias("bag"))
    links = stored(_verified(pairs, bags, threshold), "links")
    roots = components(links)
    # Members of one bucket that no hub has brought together.
    comp = buckets.join(roots.withColumnRenamed("node", "row"), "row", "left").withColumn("comp", F.coalesce("root", "row"))
    comp = comp.where(F.col("n") > hubs + 1).select("band", "key", "row", "comp")
    by = comp.groupBy("band", "key", "comp").agg(F.count("*").alias("n_comp"))
    top = by.groupBy("band", "key").agg(
        F.max_by("comp", F.struct("n_comp", "comp")).alias("main"), F.count("*").alias("n_comps"), F.sum("n_comp").alias("n_all")
    )
    split = comp.join(top.where("n_comps > 1"), ["band", "key"]).join(marks, "row").join(bags, "row")
    slices = F.ceil(F.col("n_all") / block).cast("int")
    at = F.pmod(F.xxhash64("row"), slices).cast("int")
    every = F.explode(F.sequence(F.lit(0), slices - 1)).alias("other")
    left = split.where("comp <> main").select("band", "key", "row", "comp", "marks", "bag", F.lit(0).alias("side"), at.alias("i"), every)
    left = left.withColumnRenamed("other", "j")
    right = split.select("band", "key", "row", "comp", "marks", "bag", F.lit(1).alias("side"), at.alias("j"), every)
    right = right.withColumnRenamed("other", "i").select(*left.columns)
    blocks = left.unionByName(right).groupBy("band", "key", "i", "j")
    more = stored(blocks.applyInPandas(_apart(least, threshold), "a long, b long").distinct(), "more")
    if not more.isEmpty():
        roots = components(links.unionByName(more))
    final = member.join(roots.withColumnRenamed("node", "rep").withColumnRenamed("root", "top"), "rep", "left")
    final = final.select("row", F.coalesce("top", "rep").alias("class"))
    named = signed.select("row", "doc_id", "key").join(final, "row", "left").withColumn("class", F.coalesce("class", "row"))
    first = named.groupBy("class").agg(
        F.min("doc_id").alias("class_id"),
        F.count("*").alias("class_size"),
        F.min_by("row", F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("_kept"),
    )
    return named.join(stored(first, "classes"), "class").select(
        "row", "doc_id", "key", "class_id", "class_size", (F.col("row") == F.col("_kept")).alias("kept")
    )


def keep_one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """docs(doc_id, text, lang, source, n_chars) without the near duplicates that are not kept; repeated rows once."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    kept = near_duplicate_classes(docs, **settings).where("kept").select(F.col("doc_id").alias("_id"), F.col("key").alias("_of"))
    rows = docs.select(*columns, _key().alias("_key"))
    rows = rows.join(kept, (F.col("_key") == F.col("_of")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    return rows.dropDuplicates(["_key", "_id"]).select(*columns)
