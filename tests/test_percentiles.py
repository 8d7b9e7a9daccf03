"""Exact percentiles, and rows numbered in file order."""

import random
from datetime import date
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.operators.percentiles import exact_percentiles
from tallyframe.plans.reporting import reporting_flags
from tallyframe.sources.tables import read_numbered

SHARES = {"least": 0.0, "quarter": 0.25, "half": 0.5, "most": 0.95, "top": 1.0}


@pytest.mark.parametrize("ranges", [None, 7])
def test_percentiles_equal_sorting(spark, ranges):
    """Half of the rows in one group, a third of them with one value; NULL keys are a group, NULL values do not count."""
    rng = random.Random(3)
    rows = []
    for i in range(3_000):
        key = "hot" if i % 2 else rng.choice([None, "a", "b", "one"])
        value = Decimal("7.50") if i % 3 == 0 else rng.choice([None, Decimal(rng.randrange(-10**9, 10**9)) / 100])
        rows.append((key, value))
    rows += [("none", None), ("single", Decimal(3))]
    df = spark.createDataFrame(rows, "k string, v decimal(18,2)").withColumn("size", F.lit("clash"))
    got = {r["k"]: [r[n] for n in SHARES] for r in exact_percentiles(df, ["k"], "v", SHARES, ranges).collect()}
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(float(v))
    assert set(got) == set(groups)
    for k, values in groups.items():
        assert got[k] == pytest.approx(np.quantile(values, list(SHARES.values())).tolist(), rel=1e-12)
    whole = exact_percentiles(df, [], "v", SHARES, ranges).first()
    assert list(whole) == pytest.approx(np.quantile(sum(groups.values(), []), list(SHARES.values())).tolist(), rel=1e-12)
    assert exact_percentiles(df.limit(0), ["k"], "v", SHARES, ranges).count() == 0


def test_numbered_parquet_files(spark, tmp_path):
    df = spark.range(1_000).select("id", F.lit("x").alias("_file_name"))
    for i in range(3):
        part = df.where(f"id >= {i * 300} AND id < {i * 300 + 300}").coalesce(1)
        part.sortWithinPartitions(F.col("id").desc()).write.option("parquet.block.size", 1024).parquet(str(tmp_path / f"part{i}"))
    paths = [str(tmp_path / f"part{i}") for i in (2, 0, 1)]
    rows = read_numbered(spark, paths, "line").collect()
    assert {r.id: r.line for r in rows} == {i * 300 + j: i * 300 + 300 - j for i in range(3) for j in range(300)}


def test_reporting_days_from_numbered_lines(spark, tmp_path):
    """A printed holiday list in three files, read in many splits; the year stands on the first line of its block."""
    lines = []
    for year in (2023, 2024, 2025):
        lines += [(str(year), "01-Jan", "New Year"), ("", "25-Dec", "Christmas"), ("", "26-Dec", "Boxing Day"), ("", "", "")]
    for i in range(3):
        text = "\n".join(",".join(line) for line in lines[i * 4 : i * 4 + 4])
        (tmp_path / f"holidays{i}.csv").write_text(text + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        numbered = read_numbered(
            spark, [str(tmp_path)], "line_no", "csv", "year string, date string, bank_holiday string", header="false", mode="PERMISSIVE"
        ).fillna("")
        got = sorted(numbered.collect(), key=lambda r: r.line_no)
        assert [(r.year, r.date, r.bank_holiday) for r in got] == lines and [r.line_no for r in got] == list(range(1, 13))
        new = spark.createDataFrame([("12/24/24", 5), ("12/25/24", 1), ("12/26/24", 2), ("12/27/24", 3), ("1/1/25", 4)], "date string, new_customers int")
        flags = {r.join_date: (r.bank_holiday, r.next_reporting_date) for r in reporting_flags(new, numbered).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert flags[date(2024, 12, 25)] == ("Christmas", date(2024, 12, 27))
    assert flags[date(2024, 12, 24)] == (None, date(2024, 12, 24))
    assert flags[date(2025, 1, 1)] == ("New Year", None)
