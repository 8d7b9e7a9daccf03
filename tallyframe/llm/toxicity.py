"""Toxicity by weak supervision.

Voters are word lists, phrases, disguised spellings, and groups of words and
word beginnings mined from labelled rows. A generative label model estimates
each voter's accuracy from how voters agree over all training rows: given the
class, the covariance of two independent voters is the product of their
strengths, so strengths follow from the off-diagonal covariances, and pairs
that do not fit are taken as correlated, left out of the fit, and weighed down.
A linear classifier on words and word beginnings is then trained on the
model's posterior labels.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import map_rows, plain_words, stored

# Words and phrases that insult or threaten, one voter per list.
LEXICONS = {
    "wits": "idiot idiots idiotic stupid moron morons moronic dumb dumbass imbecile halfwit brainless cretin fool foolish",
    "worth": "worthless pathetic loser losers useless failure nobody parasite",
    "filth": "trash garbage scum disgusting filth filthy vermin vile repulsive pig swine",
    "mockery": "clown clowns joke laughable ridiculous freak weirdo creep coward liar",
    "curses": "bastard bitch asshole bullshit crap damn fuck fucking shit",
    "german": "idiot idioten dumm dummkopf trottel abschaum arschloch scheisse versager widerlich wertlos vollidiot",
    "french": "idiot idiote imbécile connard salaud merde ordure débile crétin minable abruti",
    "spanish": "idiota imbécil estúpido estúpida basura escoria mierda asqueroso patético payaso inútil",
}
PHRASES = {
    "hostile": ("shut up", "go to hell", "get lost", "i hate you", "you suck", "kill yourself", "drop dead", "hate you all"),
    "addressed": ("you idiot", "you moron", "you are stupid", "you are pathetic", "you loser", "you clown", "you scum"),
}
_LEET = bytes.maketrans(b"0134578@", b"oieastbo")
_MIXED = re.compile(rb"[a-z][0-9]|[0-9][a-z]")
_LENGTHS = range(3, 8)  # bytes of word beginnings
GROUPS = 8
VOTE_WORDS, FULL_WORDS = 200, 40

_LISTS = {w.encode(): i for i, words in enumerate(LEXICONS.values()) for w in words.split()}
_DISGUISED = len(LEXICONS)
_PHRASES = [(len(LEXICONS) + 1 + i, [b" " + p.encode() + b" " for p in ps]) for i, ps in enumerate(PHRASES.values())]
_FIRST_GROUP = len(LEXICONS) + 1 + len(PHRASES)
N_VOTERS = _FIRST_GROUP + GROUPS


def word_features(word: bytes) -> list[bytes]:
    """The word itself, and its beginnings where it goes on."""
    return [b"=" + word, *(b"^" + word[:n] for n in _LENGTHS if len(word) > n)]


class Reader:
    """Turns a text into votes and feature values; what a word gives is kept in a bounded dictionary.

    A voter votes if its words are one in VOTE_WORDS at least. A feature's
    value is the share of its words, 1 from one in FULL_WORDS on. So a few
    chance hits in a long text count for little.
    """

    def __init__(self, features: list[bytes], groups: dict[bytes, int], limit: int = 100_000) -> None:
        self.features = {f: i + N_VOTERS for i, f in enumerate(features)}
        self.groups, self.limit, self.known = groups, limit, {}

    def _of(self, word: bytes) -> tuple[int, ...]:
        out = {_LISTS[word]} if word in _LISTS else set()
        if _MIXED.search(word) and word.translate(_LEET) in _LISTS:
            out.add(_DISGUISED)
        for f in word_features(word):
            if f in self.features:
                out.add(self.features[f])
            if f in self.groups:
                out.add(_FIRST_GROUP + self.groups[f])
        return tuple(out)

    def __call__(self, text: bytes | None) -> dict[int, float]:
        """Values by number: 1 for each voter that votes, and those of the features."""
        known, words, hits = self.known, plain_words(text), Counter()
        if len(known) > self.limit:
            known.clear()
        for w, n in Counter(words).items():
            ids = known.get(w)
            if ids is None:
                ids = known[w] = self._of(w)
            for j in ids:
                hits[j] += n
        line = b" " + b" ".join(words) + b" "
        for voter, phrases in _PHRASES:
            if n := sum(line.count(p) for p in phrases):
                hits[voter] = n
        out = {}
        for j in sorted(hits):
            if j >= N_VOTERS:
                out[j] = min(1.0, FULL_WORDS * hits[j] / len(words))
            elif VOTE_WORDS * hits[j] >= len(words):
                out[j] = 1.0
        return out


def _mine(sample: DataFrame, n_features: int) -> tuple[list[bytes], dict[bytes, int]]:
    """Features that tell toxic from other labelled rows, and the group each clear sign of toxicity votes in."""

    def work(texts: list, toxic: list) -> dict[str, pa.Array]:
        by: tuple[Counter, Counter] = (Counter(), Counter())
        kept: dict[bytes, list[bytes]] = {}
        for text, label in zip(texts, toxic, strict=True):
            found: set[bytes] = set()
            for w in set(plain_words(text)):
                fs = kept.get(w)
                if fs is None:
                    fs = kept[w] = word_features(w)
                found.update(fs)
            by[label].update(found)
        names = list(by[0].keys() | by[1].keys())
        return {
            "feature": pa.array(names, pa.binary()),
            "good": pa.array([by[0][f] for f in names], pa.int64()),
            "bad": pa.array([by[1][f] for f in names], pa.int64()),
        }

    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    good, bad = sizes.get(0, 0), sizes.get(1, 0)
    if not good or not bad:
        return [], {}
    counts = map_rows(sample, {"text": "string", "toxic": "int"}, work, "feature binary, good bigint, bad bigint")
    share = F.col("bad") / bad - F.col("good") / good
    pooled = (F.col("bad") + F.col("good") + 1) / (good + bad + 2)
    rows = (  # at most n_features rows
        counts.groupBy("feature")
        .agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
        .where(F.col("good") + F.col("bad") >= max(3, 0.002 * (good + bad)))
        .withColumn("z", share / F.sqrt(pooled * (1 - pooled) * (1 / good + 1 / bad)))
        .orderBy(F.abs("z").desc(), "feature")
        .limit(n_features)
        .collect()
    )
    clear = [
        bytes(r["feature"])
        for r in rows
        if r["bad"] >= max(3, 0.01 * bad) and (r["bad"] + 0.5) / (bad + 1) >= 20 * (r["good"] + 0.5) / (good + 1)
    ]
    return [bytes(r["feature"]) for r in rows], {f: i % GROUPS for i, f in enumerate(clear)}


def _moments(docs: DataFrame, model, train) -> tuple[int, np.ndarray]:
    """Training rows, and over all of them the number in which each pair of voters votes."""

    def work(texts: list) -> dict[str, pa.Array]:
        votes = np.zeros((len(texts), N_VOTERS), np.int64)
        for i, text in enumerate(texts):
            for j in reader(text):
                if j < N_VOTERS:
                    votes[i, j] = 1
        pairs = votes.T @ votes
        j, k = np.nonzero(pairs)
        return {
            "j": pa.array(np.append(j, -1), pa.int32()),
            "k": pa.array(np.append(k, -1), pa.int32()),
            "n": pa.array(np.append(pairs[j, k], len(texts)), pa.int64()),
        }

    def reader(text: bytes | None) -> dict[int, float]:
        return model.value(text)

    sums = map_rows(docs.where(train), {"text": "string"}, work, "j int, k int, n bigint").groupBy("j", "k")
    n, pairs = 0, np.zeros((N_VOTERS, N_VOTERS))
    for r in sums.agg(F.sum("n").alias("n")).collect():  # at most a row for each pair of voters
        if r["j"] < 0:
            n = r["n"]
        else:
            pairs[r["j"], r["k"]] = r["n"]
    return n, pairs


class LabelModel:
    """Rates at which each voter votes on either class, and a weight that shrinks with the voter's correlations."""

    def __init__(self, n: int, pairs: np.ndarray, prior: float, bound: float = 0.1) -> None:
        n, m = max(1, n), len(pairs)
        mean = np.diag(pairs) / n
        cov = pairs / n - np.outer(mean, mean)
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
        use = ~np.eye(m, dtype=bool) & np.outer(mean > 0, mean > 0)
        strength = np.zeros(m)
        for _ in range(4):
            start = np.where(use, cov, 0)
            strength = np.sqrt(np.maximum(start.max(1, initial=0), 0))
            for _ in range(300):  # least squares, one voter after another
                for j in range(m):
                    others = use[j]
                    below = (strength[others] ** 2).sum()
                    strength[j] = (cov[j, others] * strength[others]).sum() / below if below > 1e-15 else 0.0
            rho = np.where(~np.eye(m, dtype=bool), (cov - np.outer(strength, strength)) / np.outer(sd, sd), 0)
            far = (np.abs(rho) > bound) & use
            for j in np.argsort(far.sum(1)):  # each voter keeps two partners at least
                while far[j].any() and (use[j] & ~far[j]).sum() < 2:
                    k = np.flatnonzero(far[j])[np.argmin(np.abs(rho[j][far[j]]))]
                    far[j, k] = far[k, j] = False
            if not far.any():
                break
            use &= ~far
        self.correlations = rho
        gap = np.clip(strength, 0, None) / np.sqrt(prior * (1 - prior))
        self.on_toxic = np.clip(mean + (1 - prior) * gap, 1e-4, 1 - 1e-4)
        self.on_clean = np.clip(mean - prior * gap, 1e-5, 1 - 1e-4)
        self.on_clean = np.minimum(self.on_clean, self.on_toxic)
        self.weight = np.where(mean > 0, 1 / (1 + np.abs(np.where(np.abs(rho) > bound, rho, 0)).sum(1)), 0)
        self.prior = prior

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        yes = self.weight * np.log(self.on_toxic / self.on_clean)
        no = self.weight * np.log((1 - self.on_toxic) / (1 - self.on_clean))
        z = np.log(self.prior / (1 - self.prior)) + votes @ yes + (1 - votes) @ no
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_linear(x: np.ndarray, q: np.ndarray, ridge: float = 1.0, steps: int = 12) -> np.ndarray:
    """Logistic regression on soft labels by Newton's method; the last weight is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * np.maximum(p * (1 - p), 1e-4)[:, None]).T @ x + np.diag(penalty), x.T @ (q - p) - penalty * w)
        w += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-4:
            break
    return w


def _cut(z: np.ndarray, toxic: np.ndarray) -> float:
    """The score between two neighbours that leaves fewest errors among labelled rows, in the middle of its gap."""
    order = np.argsort(z)
    z, toxic = z[order], toxic[order]
    below = np.concatenate(([0], np.cumsum(toxic)))  # toxic rows under the cut
    clean_above = (len(toxic) - toxic.sum()) - np.concatenate(([0], np.cumsum(1 - toxic)))
    errors = below + clean_above
    edges = np.concatenate(([z[0] - 1], (z[1:] + z[:-1]) / 2, [z[-1] + 1]))
    real = np.concatenate(([True], z[1:] > z[:-1], [True]))
    gaps = np.concatenate(([1.0], z[1:] - z[:-1], [1.0]))
    best = np.flatnonzero(real & (errors == errors[real].min()))
    return float(edges[best[np.argmax(gaps[best])]])


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = 10_000,
    n_features: int = 400,
    cut: float = 0.3,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, held_out, score and predicted, and the columns to keep, per row of docs(doc_id, text).

    Labels are learnt only from rows whose crc32 of the id as text is not 2
    modulo 4: at most `sample_rows` of them, drawn by hash, give the mined
    words, the class share, the classifier's rows (with posterior labels) and
    the place of the cut; the label model's statistics are taken over all
    training rows. Scores are shifted so that `cut` is where fewest labelled
    rows err. Null and empty texts get the score of a text without any sign.
    Rows without an id are not held out. Repeated rows give repeated results;
    without labels of both classes every score is 0.
    """
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    train = F.coalesce(remainder != 2, F.lit(True))
    marked = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where((remainder != 2) & F.col("toxic").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = stored(texts.join(F.broadcast(marked), "doc_id"), "sample")  # at most sample_rows ids
    features, groups = _mine(sample, n_features)
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(Reader(features, groups))
    held_out = F.coalesce(remainder == 2, F.lit(False)).alias("held_out")
    if not features:
        return docs.select("doc_id", held_out, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), *keep)

    def read(toxic: list, texts: list) -> dict[str, pa.Array]:
        found = [model.value(t) for t in texts]
        return {
            "toxic": pa.array(toxic, pa.int32()),
            "found": pa.array([list(f) for f in found], pa.list_(pa.int32())),
            "values": pa.array([list(f.values()) for f in found], pa.list_(pa.float64())),
        }

    kinds = "toxic int, found array<int>, values array<double>"
    rows = map_rows(sample, {"toxic": "int", "text": "string"}, read, kinds).collect()
    rows.sort(key=lambda r: (r["toxic"], r["found"], r["values"]))  # the order that tasks end in must not matter
    toxic, x = np.array([r["toxic"] for r in rows]), np.zeros((len(rows), N_VOTERS + len(features)))
    for i, r in enumerate(rows):
        x[i, r["found"]] = r["values"]
    label_model = LabelModel(*_moments(docs, model, train), prior=float(np.clip(toxic.mean(), 0.01, 0.5)))
    w = fit_linear(x, label_model.posterior(x[:, :N_VOTERS]))
    z = x @ w[:-1] + w[-1]
    shift = _cut(z, toxic) - np.log(cut / (1 - cut))
    linear = spark.sparkContext.broadcast(w)

    types = {c: dict(docs.dtypes)[c] for c in keep}

    def work(ids: list, texts: list, held: list, *kept: list) -> dict[str, pa.Array]:
        w = linear.value
        z = np.array([w[-1] + sum(w[j] * v for j, v in model.value(t).items()) for t in texts])
        score = 1 / (1 + np.exp(-np.clip(z - shift, -30, 30))) if len(z) else z
        return {
            "doc_id": pa.array(ids, pa.int64()),
            "held_out": pa.array(held, pa.bool_()),
            "score": pa.array(score, pa.float64()),
            "predicted": pa.array((score >= cut).astype(np.int32), pa.int32()),
        } | {
            c: pa.array(v, pa.binary()).cast(pa.string()) if types[c] == "string" else pa.array(v, pa.int64())
            for c, v in zip(keep, kept, strict=True)
        }

    return map_rows(
        docs.select("doc_id", "text", held_out, *(F.col(c).alias(f"_{c}") for c in keep)),
        {"doc_id": "bigint", "text": "string", "held_out": "boolean"} | {f"_{c}": types[c] for c in keep},
        work,
        ", ".join(["doc_id bigint, held_out boolean, score double, predicted int", *(f"{c} {types[c]}" for c in keep)]),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """docs(doc_id, text, lang, source, n_chars) without the rows that score_toxicity predicts as toxic."""
    return score_toxicity(docs, labels, keep=("text", "lang", "source", "n_chars"), **settings).where("predicted = 0").select(
        "doc_id", "text", "lang", "source", "n_chars"
    )
