"""Personal data by information-theoretic sanitisation, in DataFrame functions only.

Patterns find the protected entities. A word of a text with an entity, anywhere
in it, discloses the entity as far as the corpus ties the two together: the
pointwise mutual information of word and entity over documents, as a share of
the entity's own information. Words whose share reaches the threshold are spans
too, wherever they stand in such a text; `sanitise` replaces entities by their
kind and generalises or removes such words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import stored

KINDS = ("email", "ip", "card", "phone")

# What the patterns of the kinds match. Quantifiers are possessive and matches begin
# at the start of a run or where the last match ended, so that time stays linear on any text.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?+[0-9]){13,}+",
    "phone": r"\+[0-9](?:[ ().-]*+[0-9])++",
}
_NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9]{2}|[0-9][ -][0-9]", "phone": r"\+[0-9]"}
_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]++"
_SPANS = "array<struct<start:int,rank:int,end:int,value:string>>"


# Matches whose spans are built up together: an array is copied for each span added to it, so none gets longer than this.
_RUN = 64


def _places(text: Column, pattern: str, rank: int) -> Column:
    """Spans of all matches in code points: lengths of what lies between matches, and of matches, added up.

    Matches are taken in runs: first the length of every run, then the spans
    of each run from where it starts, so time hardly grows faster than the text.
    """
    between, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast(_SPANS)

    def add(acc: Column, pair: Column) -> Column:
        first = acc["at"] + pair["skip"]
        last = first + F.length(pair["match"])
        span = F.struct(first.alias("start"), F.lit(rank).alias("rank"), last.alias("end"), pair["match"].alias("value"))
        return F.struct(last.alias("at"), F.array_append(acc["out"], span).alias("out"))

    def start_after(acc: Column, run: Column) -> Column:
        length = F.aggregate(run, F.lit(0), lambda n, pair: n + pair["skip"] + F.length(pair["match"]))
        begun = F.struct(acc["at"].alias("at"), run.alias("run"))
        return F.struct((acc["at"] + length).alias("at"), F.array_append(acc["out"], begun).alias("out"))

    def spans(begun: Column) -> Column:
        return F.aggregate(begun["run"], F.struct(begun["at"].alias("at"), none.alias("out")), add, lambda acc: acc["out"])

    pairs = F.zip_with(
        matches, F.slice(between, 1, F.size(matches)), lambda m, b: F.struct(F.length(b).alias("skip"), m.alias("match"))
    )
    kind = "array<struct<skip:int,match:string>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<struct<at:int,run:{kind}>>").alias("out"))

    def in_runs(all_: Column) -> Column:
        last = F.floor((F.size(all_) - 1) / _RUN).cast("int")
        runs = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(all_, i * _RUN + 1, _RUN).cast(kind))
        begun = F.aggregate(runs, start, start_after, lambda acc: acc["out"])
        return F.when(F.size(all_) > 0, F.flatten(F.transform(begun, spans))).otherwise(none)

    # The pairs stand in an array of their own, so that they are worked out once and not for every run.
    return F.transform(F.array(pairs), in_runs)[0]


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda part: part.cast("double") <= 255)
    if kind == "card":
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def entity_spans(text: Column) -> Column:
    """All valid entities of a text as an array of (start, rank of the kind, end, value), sorted."""
    none = F.array().cast(_SPANS)

    def of(rank: int, kind: str) -> Column:
        valid = F.filter(_places(text, PATTERNS[kind], rank), lambda s: _valid(kind, s["value"]))
        return F.when(text.rlike(_NEEDS[kind]), valid).otherwise(none)

    found = [of(rank, kind) for rank, kind in enumerate(KINDS)]
    return F.array_sort(F.concat(*found))


def _joined(spans: Column) -> Column:
    kind = F.array(*(F.lit(k) for k in (*KINDS, "term")))
    parts = F.transform(
        spans, lambda s: F.concat_ws(":", kind[s["rank"]], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.concat_ws(",", parts)


def _named(found: DataFrame, support: int) -> DataFrame:
    """row, entity and n_entity, its documents, for entities of `support` documents at least; others can tell nothing."""
    each = found.where(F.size("base") > 0).select("row", F.explode("base").alias("e"))
    entity = F.concat_ws(":", F.col("e.rank").cast("string"), F.lower("e.value"))
    each = each.select("row", entity.alias("entity")).distinct()
    often = each.groupBy("entity").agg(F.count("*").alias("n_entity")).where(F.col("n_entity") >= support)
    return each.join(often, "entity")


def _words_around(found: DataFrame, named: DataFrame) -> DataFrame:
    """row and its words, (start, end, value), that overlap no entity, over the whole texts of the rows in named.

    Words and entities of a text are walked in the order of their starts, so
    time grows with their number and not with the product.
    """
    rows = found.join(named.select("row").distinct(), "row", "left_semi")
    words = rows.select("row", F.explode(_places(F.col("text"), _WORD, len(KINDS))).alias("s"))
    both = words.unionByName(rows.select("row", F.explode("base").alias("s"))).select(
        "row", "s.start", "s.end", "s.value", (F.col("s.rank") == len(KINDS)).alias("is_word")
    )
    order = Window.partitionBy("row").orderBy("start", "is_word")
    entity = lambda name: F.when(~F.col("is_word"), F.col(name))
    both = both.withColumn("_till", F.max(entity("end")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    both = both.withColumn("_next", F.min(entity("start")).over(order.rowsBetween(0, Window.unboundedFollowing)))
    free = (F.coalesce("_till", F.lit(0)) <= F.col("start")) & (F.col("_next").isNull() | (F.col("_next") >= F.col("end")))
    free = both.where(F.col("is_word") & free)
    return free.groupBy("row").agg(F.collect_list(F.struct("start", "end", "value")).alias("words"))


def disclosing_terms(words: DataFrame, named: DataFrame, texts: DataFrame, threshold: float, support: int) -> DataFrame:
    """(entity, term) whose share of the entity's information reaches the threshold, counted over all documents."""
    n = texts.count()
    all_ = texts.select(F.explode(F.array_distinct(F.split(F.lower("text"), r"[^0-9a-z\x{80}-\x{10FFFF}]++"))).alias("term"))
    frequency = all_.where(F.length("term") > 0).groupBy("term").agg(F.count("*").alias("n_term"))
    there = words.select("row", F.explode(F.array_distinct(F.transform("words", lambda w: F.lower(w["value"])))).alias("term"))
    pairs = there.join(named, "row").groupBy("entity", "n_entity", "term").agg(F.count("*").alias("n_both"))
    share = F.log(F.col("n_both") * n / (F.col("n_entity") * F.col("n_term"))) / F.log(F.lit(n) / F.col("n_entity"))
    return (
        pairs.where((F.col("n_both") >= support) & (F.col("n_entity") < n))
        .join(frequency, "term")
        .where(share >= threshold)
        .select("entity", "term")
    )


def find_personal_data(
    docs: DataFrame, threshold: float = 0.9, support: int = 3, keep: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, base and spans, arrays of (start, rank, end, value), and the columns to keep, per row of docs(doc_id, text).

    Ranks number KINDS, then terms; positions are code points, ends exclusive;
    spans holds the entities and the terms that disclose one and overlap none.
    A term counts if it stands with the entity in `support` documents, anywhere in
    their texts, and is a span wherever it stands in a text with that entity.
    Null and empty texts have no spans. Repeated rows count as documents of
    their own and give repeated results; null ids pass through.
    """
    # Every row's spans, and the text only where something must be looked at again.
    rows = docs.select("doc_id", F.col("text").cast("string").alias("_text"), *(F.col(c).alias(f"_keep_{c}") for c in keep))
    rows = rows.withColumn("base", entity_spans(F.coalesce("_text", F.lit(""))))
    has = F.size("base") > 0
    found = stored(
        rows.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "base",
            *([F.col("_text").alias("text")] if keep else [F.when(has, F.col("_text")).alias("text")]),
            *(f"_keep_{c}" for c in keep),
        ),
        "entities",
    )
    named = stored(_named(found, support), "named")
    words = stored(_words_around(found, named), "words")
    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    told = disclosing_terms(words, named, texts, threshold, support)
    told = told.join(named, "entity").groupBy("row").agg(F.collect_set("term").alias("told"))
    span = lambda w: F.struct(w["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), w["end"].alias("end"), w["value"].alias("value"))
    here = F.filter("words", lambda w: F.array_contains("told", F.lower(w["value"])))
    terms = words.join(told, "row").select("row", F.transform(here, span).alias("terms"))
    free = F.coalesce("terms", F.array().cast(_SPANS))
    return found.join(terms, "row", "left").select(
        "doc_id",
        "base",
        F.array_sort(F.concat("base", free)).alias("spans"),
        *(["text"] if keep else []),
        *(F.col(f"_keep_{c}").alias(c) for c in keep if c != "text"),
    )


def digest(found: DataFrame) -> DataFrame:
    """doc_id, counts per kind, base_sha256 and spans as text, of what find_personal_data returns."""
    count = lambda rank: F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("bigint")
    return found.select(
        "doc_id",
        *(count(rank).alias(f"n_{kind}") for rank, kind in enumerate(KINDS)),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["rank"] == len(KINDS))).cast("bigint").alias("n_term"),
    )


def sanitise(docs: DataFrame, threshold: float = 0.9, support: int = 3) -> DataFrame:
    """docs(doc_id, text, lang, source, n_chars) with entities as [kind]; disclosing terms lose their digits or go.

    A term with digits is generalised (each digit becomes 0), any other is
    removed as [term]. Where spans overlap the first one hides both. Texts
    without spans, null ones among them, stay as they are.
    """
    found = find_personal_data(docs, threshold, support, keep=("text", "lang", "source", "n_chars"))
    names = F.array(*(F.lit(f"[{k}]") for k in KINDS))

    def put(acc: Column, s: Column) -> Column:
        mark = F.when(s["rank"] < len(KINDS), names[s["rank"]]).when(
            s["value"].rlike("[0-9]"), F.regexp_replace(s["value"], "[0-9]", "0")
        )
        before = F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
        later = s["start"] >= acc["at"]
        out = F.when(later, F.concat(acc["out"], before, F.coalesce(mark, F.lit("[term]")))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate(
        "spans", start, put, lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text")))
    )
    changed = F.size("spans") > 0
    text = F.when(changed, clean).otherwise(F.col("text"))
    return found.select(
        "doc_id",
        text.alias("text"),
        "lang",
        "source",
        F.when(changed, F.length(text).cast("bigint")).otherwise(F.col("n_chars").cast("bigint")).alias("n_chars"),
    )
