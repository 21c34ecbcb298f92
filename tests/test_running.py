"""Split numbering and frames equal plain windows, whatever the group sizes."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lapwise.operators.running import framed, row_numbers, running_totals


@pytest.fixture
def skewed(spark):
    """A third of the rows in one group, the rest in groups of a few; values repeat."""
    n = F.col("id")
    return spark.range(3000).select(
        F.when(n % 3 == 0, 0).otherwise(n % 97 + 1).alias("k"),
        (n * 7919 % 500).alias("v"),
        n.alias("i"),
    )


ORDER = [F.asc, "v"], [F.asc, "i"]


def order():
    return [make(name) for make, name in ORDER]


SPLITS = {
    "one": lambda: [F.floor(F.col("v") / 50)],
    "two": lambda: [F.floor(F.col("v") / 100), F.floor(F.col("v") / 10)],
    "three": lambda: [F.floor(F.col("v") / 200), F.floor(F.col("v") / 20), F.col("v")],
    "single_cell": lambda: [F.lit(0)],
}


@pytest.mark.parametrize("splits", SPLITS)
def test_totals_equal_plain_window(skewed, splits):
    w = Window.partitionBy("k").orderBy(*order()).rowsBetween(Window.unboundedPreceding, 0)
    totals = {"n": F.lit(1).cast("long"), "s": F.col("v")}
    plain = skewed.withColumns({name: F.sum(value).over(w) for name, value in totals.items()})
    split = running_totals(skewed, ["k"], order(), totals, SPLITS[splits]())
    assert split.columns == plain.columns
    assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()


def test_descending_order_with_negated_split(skewed):
    by = [F.desc("v"), F.asc("i")]
    plain = skewed.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(*by)).cast("long"))
    split = row_numbers(skewed, ["k"], by, "n", [F.floor(-F.col("v") / 60)])
    assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()


@pytest.mark.parametrize("block_rows", [5, 7, 64, 5000])
def test_frames_equal_plain_window(skewed, block_rows):
    w = Window.partitionBy("k").orderBy(*order()).rowsBetween(-5, -1)
    frames = {"mean": F.avg("v"), "seen": F.count("v")}
    plain = skewed.withColumns({name: agg.over(w) for name, agg in frames.items()})
    split = framed(
        skewed, ["k"], order(), 5, -1, frames, SPLITS["two"](), block_rows=block_rows
    )
    assert split.columns == plain.columns
    assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()


def test_frame_must_fit(skewed):
    with pytest.raises(ValueError):
        framed(skewed, ["k"], order(), 5, 1, {"m": F.avg("v")}, [F.col("v")])
    with pytest.raises(ValueError):
        framed(skewed, ["k"], order(), 50, 0, {"m": F.avg("v")}, [F.col("v")], block_rows=10)


def test_empty_input(skewed):
    none = skewed.filter("k < 0")
    assert row_numbers(none, ["k"], order(), "n", SPLITS["one"]()).isEmpty()
