"""Histograms counted in Spark: equal-width bins, empty bins kept.

With a given range or the data's own the last bin is closed. Automatic bins are half open: their edges are the
multiples of a step of 1, 2 or 5 times a power of ten, the smallest with which the data need no more
bins than allowed.
"""

from pyspark.sql import Column, DataFrame, functions as F

from reviewsent.schema import CLASSES


def bin_of(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Bin of a ``value`` within ``[low, high]``.

    Rounding of the quotient can put a value next to an edge into the neighbour bin, so
    the guess is compared with the edges themselves.
    """
    width = (high - low) / bins
    guess = F.least(F.floor((value - low) / width), F.lit(bins - 1).cast("long"))
    down = value < low + guess * width
    up = (value >= low + (guess + 1) * width) & (guess < bins - 1)
    return (guess - down.cast("int") + up.cast("int")).cast("int")


def _values(df: DataFrame, value: Column, by: str, classes: tuple[int, ...]) -> DataFrame:
    """Values of the listed classes; that bounds the rows per class and bin that are broadcast below."""
    return (df.where(F.col(by).isin(*classes)).select(by, value.cast("double").alias("_value"))
            .where(F.col("_value").isNotNull()))


def _grid(df: DataFrame, by: str, classes: tuple[int, ...], bins: int) -> DataFrame:
    cells = df.sparkSession.range(bins * len(classes))
    label = F.get(F.array(*[F.lit(c) for c in classes]), F.floor(F.col("id") / bins).cast("int"))
    return cells.select(label.alias(by), (F.col("id") % bins).cast("int").alias("bin"))


def _count_bins(binned: DataFrame, by: str, grid: DataFrame) -> DataFrame:
    counts = binned.groupBy(by, "bin").agg(F.count("*").alias("n"))
    # both sides have one row per class and bin
    return grid.join(F.broadcast(counts), [by, "bin"], "left").na.fill(0, ["n"])


def histogram(df: DataFrame, value: Column, low: float, high: float, bins: int = 50,
              by: str = "label", classes: tuple[int, ...] = CLASSES) -> DataFrame:
    """``(by, bin, bin_start, n)`` over a fixed range; nulls and values outside are dropped."""
    low, high = float(low), float(high)
    rows = _values(df, value, by, classes).where(F.col("_value").between(low, high))
    binned = rows.select(by, bin_of(F.col("_value"), F.lit(low), F.lit(high), bins).alias("bin"))
    counts = _count_bins(binned, by, _grid(df, by, classes, bins))
    return counts.select(by, "bin", (F.lit(low) + F.col("bin") * F.lit((high - low) / bins)).alias("bin_start"), "n")


def histogram_all(df: DataFrame, value: Column, low: float, high: float, bins: int = 50) -> DataFrame:
    """:func:`histogram` without classes."""
    one = df.select(F.lit(0).alias("_all"), value.alias("_value"))
    return histogram(one, F.col("_value"), low, high, bins, "_all", (0,)).drop("_all")


def histogram_own_range(df: DataFrame, value: Column, bins: int = 50,
                        by: str = "label", classes: tuple[int, ...] = CLASSES) -> DataFrame:
    """:func:`histogram` over each class's own minimum to maximum.

    If all values of a class are equal the range is half a unit to both sides of it.
    """
    rows = _values(df, value, by, classes)
    ranges = rows.groupBy(by).agg(F.min("_value").alias("_min"), F.max("_value").alias("_max"))
    flat = F.col("_min") == F.col("_max")
    ranges = F.broadcast(ranges.select(
        by, F.when(flat, F.col("_min") - 0.5).otherwise(F.col("_min")).alias("_low"),
        F.when(flat, F.col("_max") + 0.5).otherwise(F.col("_max")).alias("_high")))  # one row per class
    binned = rows.join(ranges, by).select(
        by, bin_of(F.col("_value"), F.col("_low"), F.col("_high"), bins).alias("bin"))
    counts = _count_bins(binned, by, _grid(df, by, classes, bins)).join(ranges, by)
    start = F.col("_low") + F.col("bin") * ((F.col("_high") - F.col("_low")) / bins)
    return counts.select(by, "bin", start.alias("bin_start"), "n")


def _edge(index: Column, layout: Column) -> Column:
    """Multiple of the step as one division or product of whole numbers, so that 3 steps of 0.1 are 0.3."""
    return index * layout["factor"] / layout["divisor"]


def _step_of(value: Column, layout: Column) -> Column:
    """``i`` with edge i <= value < edge i + 1, by the edges themselves: the quotient may be rounded."""
    guess = F.floor(value * layout["divisor"] / layout["factor"])
    down = value < _edge(guess, layout)
    up = value >= _edge(guess + 1, layout)
    return guess - down.cast("long") + up.cast("long")


def automatic_layout(rows: DataFrame, most: int, value: str = "_value") -> DataFrame:
    """One row: ``(factor, divisor, first, bins)`` of the smallest step that needs at most ``most`` bins, two or more.

    Equal values are one bin of width 1. No values, no row with bins.
    """
    if most < 2:  # values on both sides of zero never fit one bin between multiples of a step
        raise ValueError("at least two bins")
    low, high = F.col("_low"), F.col("_high")
    # the power of ten may be rounded, so its neighbours are tried as well
    power = F.floor(F.log10((high - low) / most)).cast("int")
    powers = F.when(high > low, F.sequence(power - 1, power + 2)).otherwise(F.array(F.lit(0)))
    ladder = F.flatten(F.transform(powers, lambda e: F.transform(F.array(F.lit(1.0), F.lit(2.0), F.lit(5.0)), lambda m: F.struct(
        (m * F.pow(F.lit(10.0), F.greatest(e, F.lit(0)))).alias("factor"), F.pow(F.lit(10.0), F.greatest(-e, F.lit(0))).alias("divisor")))))
    sized = F.transform(ladder, lambda s: F.struct(s["factor"].alias("factor"), s["divisor"].alias("divisor"),
                                                   _step_of(low, s).alias("first"), (_step_of(high, s) - _step_of(low, s) + 1).alias("bins")))
    ends = rows.agg(F.min(value).alias("_low"), F.max(value).alias("_high")).where(low.isNotNull())
    return ends.select(F.inline(F.slice(F.filter(sized, lambda s: s["bins"] <= most), 1, 1)))


def histogram_automatic(df: DataFrame, value: Column, most: int = 50, by: str = "label",
                        classes: tuple[int, ...] = CLASSES) -> DataFrame:
    """``(by, bin, bin_start, bin_end, n)`` with at most ``most`` bins, the same ones for all classes.

    Bins reach from the one of the smallest to that of the largest value. Null, NaN and infinite values are
    dropped; without any other value there is no row.
    """
    rows = _values(df, value, by, classes).where(F.abs("_value") < float("inf"))
    layout = automatic_layout(rows, most).select(F.struct("*")).scalar()  # one row
    binned = rows.select(by, (_step_of(F.col("_value"), layout) - layout["first"]).cast("int").alias("bin"))
    grid = _grid(df, by, classes, most).where(F.col("bin") < layout["bins"])
    counts = _count_bins(binned, by, grid)
    start = F.col("bin") + layout["first"]
    return counts.select(by, "bin", _edge(start, layout).alias("bin_start"), _edge(start + 1, layout).alias("bin_end"), "n")
