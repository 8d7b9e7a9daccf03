"""Cuts of a sort order, so that one long order is walked by many tasks.

``sort_cuts`` takes rows of a table as borders, evenly spread over the order of
its rows. ``in_ranges`` numbers the piece every row falls into and moves each
piece to a task of its own. What a piece has to hand on to the next ones (a
sum, a count, a last value) is aggregated per piece, for the groups that a
border cuts only: at most two for each piece, however large the table or a
group is. ``operators.running`` and ``operators.asof`` are built on it.

Rows that are equal in the whole order stay in one piece.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PIECE_ROWS = 100_000  # a smaller piece is not worth a task
_SAMPLE = 100  # sampled rows per piece: pieces then differ by some tens of per cent
_SCALE = 2**53


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores in front as it takes to differ from all columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def all_equal(left: DataFrame, right: DataFrame, names: dict[str, str]) -> Column:
    """NULL equals NULL in every pair of columns."""
    return reduce(and_, [left[a].eqNullSafe(right[b]) for a, b in names.items()])


@dataclass(frozen=True)
class Cuts:
    """Border rows in ascending order, as a table with one array, and the number of pieces between them."""

    borders: DataFrame
    pieces: int


def sort_cuts(source: DataFrame, keys: Sequence[str], ranges: int | None = None, size: int | None = None) -> Cuts:
    """Borders of about equal pieces of ``source`` in the ascending order of ``keys`` (NULL first).

    ``ranges`` is the number of pieces; by default one for each shuffle
    partition, but none of less than ``PIECE_ROWS`` rows. Two small jobs run
    here: one counts the rows, one reads the keys of about a hundred rows per
    piece, chosen by the hash of their keys. Only these keys pass through the
    driver, so that every branch of a plan, and every rerun of a task, works
    with the same borders. They only decide how even the pieces are: ``source``
    may be any table with such keys, and ``size`` a number of rows that is known
    without counting. For a single piece nothing runs.
    """
    rows = source.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    spark = source.sparkSession
    n = size if size is not None else 0 if ranges == 1 else rows.count()
    pieces = ranges or max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), n // PIECE_ROWS))
    picked: list = []
    if pieces > 1:
        share = F.pmod(F.xxhash64(*rows.columns), F.lit(_SCALE)).cast("double") * F.lit(max(n, 1) / _SCALE)
        # A shuffle, not a coalesce, which would pull the whole source into the one task that sorts.
        sample = rows.where(share < F.lit(float(pieces * _SAMPLE))).repartition(1).sortWithinPartitions(*rows.columns).collect()
        places = sorted({len(sample) * i // pieces for i in range(1, pieces)})
        picked = [sample[p] for p in places if p < len(sample)]
    kind = T.StructType([T.StructField("b", T.ArrayType(rows.schema))])
    return Cuts(spark.createDataFrame([(picked,)], kind), len(picked) + 1)


@dataclass(frozen=True)
class Ranges:
    """Rows with the number of their piece; ``by`` may be empty."""

    rows: DataFrame
    cut: DataFrame  # the rows of groups that a border cuts
    piece: str
    count: int
    by: tuple[str, ...]

    def carry(self, *aggregates: Column) -> DataFrame:
        """One row for each piece and each group in it that some border cuts."""
        return self.cut.groupBy(*self.by, self.piece).agg(*aggregates)

    def over_pieces(self, backward: bool = False) -> Window:
        piece = F.col(self.piece)
        return Window.partitionBy(*self.by).orderBy(piece.desc() if backward else piece)

    def inside(self, *order: Column | str) -> Window:
        return Window.partitionBy(self.piece, *self.by).orderBy(*order)

    def spread(self, carried: DataFrame, *columns: str) -> DataFrame:
        """Every piece in a task of its own, with the carried columns beside the rows."""
        rows = self.rows.repartitionById(self.count, F.col(self.piece))
        if self.count == 1:  # nothing is handed on
            kinds = {f.name: f.dataType for f in carried.schema.fields}
            return rows.select("*", *[F.lit(None).cast(kinds[c]).alias(c) for c in columns])
        names = {k: free_name(rows, f"_c{i}") for i, k in enumerate((self.piece, *self.by))}
        small = carried.select(*[F.col(k).alias(n) for k, n in names.items()], *columns)
        return rows.join(F.broadcast(small), all_equal(rows, small, names), "left").drop(*names.values())


def in_ranges(df: DataFrame, by: Sequence[str], order: Sequence[str], cuts: Cuts | None = None, ranges: int | None = None) -> Ranges:
    """Cuts ``df`` along ``by`` and then ``order`` (ascending, NULL first).

    ``cuts`` comes from ``sort_cuts`` over the same keys, by default of ``df``
    itself and with ``ranges`` pieces.
    """
    keys = [*by, *order]
    cuts = cuts or sort_cuts(df, keys, ranges)
    borders = cuts.borders.scalar()
    piece, marks, place = (free_name(df, name) for name in ("_piece", "_borders", "_place"))

    def numbered(part: DataFrame) -> DataFrame:
        """Binary search: how many borders are not beyond the row."""
        if cuts.pieces == 1:
            return part.withColumn(piece, F.lit(0))
        out = part.withColumn(marks, borders).withColumn(place, F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]))
        out = out.withColumn(piece, F.lit(0))
        for bit in reversed(range((cuts.pieces - 1).bit_length())):
            ahead = F.col(piece) + F.lit(1 << bit)
            out = out.withColumn(piece, F.when(F.get(marks, ahead - 1) <= F.col(place), ahead).otherwise(F.col(piece)))
        return out.drop(marks, place)

    cut = df
    if by:
        # Only groups that hold a border reach over a piece's end.
        groups = cuts.borders.select(F.explode("b").alias("b"))
        groups = groups.select(*[F.col(f"b.k{i}").alias(f"_g{i}") for i in range(len(by))]).distinct()
        cut = df.join(F.broadcast(groups), all_equal(df, groups, {k: f"_g{i}" for i, k in enumerate(by)}), "left_semi")
    return Ranges(numbered(df), numbered(cut), piece, cuts.pieces, tuple(by))
