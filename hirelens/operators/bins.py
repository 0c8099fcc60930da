"""Value-in-interval assignment against a bins table (JON-8, MTH-7).

Fixed bin specs use a CASE (``functions.text.bin_label``). User-defined bins
come as a table (lo, hi, label) of any size; the assignment ``lo <= x < hi`` is
an equi-join on cells. Cells are grids of widths that are powers of 16: a bin
is dealt to the grid whose cells are at least as wide as it is, so it touches
two of them at most; a bin wider than a 64th of the range of all values is dealt
to the widest grid, of 64 to 1,024 cells over that range. A value has one cell
in each grid that holds bins.

A cell's bins are one array, so each value stays one row until its bins are
known, and a value in no bin is a row with nulls. The joins are by cell: a
small table of cells is broadcast, a large one is shuffled, where AQE splits
a cell that holds many values.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: cells of the widest grid over all values, at least
WIDEST_CELLS = 64
#: cells of the finest grid over all values, at most
FINEST_CELLS = 2.0 ** 50
GRID_STEP = 16.0


def bins_table(spark: SparkSession, spec) -> DataFrame:
    rows = [(float(lo), float(hi), label, i) for i, (lo, hi, label) in enumerate(spec)]
    return spark.createDataFrame(rows, "lo double, hi double, label string, bin_order int")


def _cell(x: Column, start: float, width: float) -> Column:
    return F.floor((x - F.lit(start)) / F.lit(width))


def assign_bins(df: DataFrame, col: str, bins: DataFrame, out: str = "bin") -> DataFrame:
    """``df`` and the columns of ``bins`` but lo and hi (label as ``out``), one
    row for each bin with lo <= value < hi; a value in no bin, null or NaN has
    one row with nulls. Bins may overlap and may be open (infinite) at an end;
    one with a null or NaN end, or lo >= hi, holds nothing. Infinite values are
    in bins whose end is infinite: -inf where lo is -inf, inf in none."""
    from hirelens.session import checked_broadcast, materialize
    extra = [c for c in bins.columns if c not in ("lo", "hi")]
    names = [out if c == "label" else c for c in extra]
    x = F.col(col).cast("double")
    least, most = df.agg(F.min(F.when(F.abs(x) < math.inf, x)), F.max(F.when(F.abs(x) < math.inf, x))).first()
    if least is None:
        least = most = 0.0
    # ends beyond the values are cut to them: no value is lost, and widths are finite
    real = bins.where("lo < hi AND NOT isnan(lo) AND NOT isnan(hi)") \
        .where((F.col("lo") <= most) & ((F.col("hi") > least) | (F.col("lo") == -math.inf))) \
        .withColumn("_from", F.greatest("lo", F.lit(least))).withColumn("_to", F.greatest("_from", F.least("hi", F.lit(most))))
    span = max(most / 2 - least / 2, 0.0) * 2 or 1.0
    span = min(span, 1.7e308)
    top, low = math.log(span / WIDEST_CELLS, GRID_STEP), math.log(span / FINEST_CELLS, GRID_STEP)
    width = F.greatest(F.col("_to") - F.col("_from"), F.lit(0.0))
    grid = F.when(width <= 0, math.ceil(low)).otherwise(F.ceil(F.log(width) / math.log(GRID_STEP)))
    grid = F.greatest(F.lit(math.ceil(low)), F.least(F.lit(math.floor(top)), grid)).cast("int")
    gridded = materialize(real.withColumn("_grid", grid), "bins")
    grids = sorted(r["_grid"] for r in gridded.select("_grid").distinct().collect())

    j = df
    kept = F.struct("lo", "hi", *extra)
    arrays = []
    for i, g in enumerate(grids):
        cell = GRID_STEP ** g
        cells = materialize(
            gridded.where(F.col("_grid") == g)
            .withColumn(f"_cell{i}", F.explode(F.sequence(_cell(F.col("_from"), least, cell), _cell(F.col("_to"), least, cell))))
            .groupBy(f"_cell{i}").agg(F.collect_list(kept).alias(f"_bins{i}")), "bin-cells")
        j = j.withColumn(f"_cell{i}", _cell(F.greatest(F.lit(least), F.least(F.lit(most), x)), least, cell)) \
            .join(checked_broadcast(cells), f"_cell{i}", "left").drop(f"_cell{i}")
        arrays.append(F.filter(f"_bins{i}", lambda b: (x >= b["lo"]) & (x < b["hi"]) & ~F.isnan(x)))
    if not arrays:
        return df.select("*", *[F.lit(None).cast(bins.schema[c].dataType).alias(n) for c, n in zip(extra, names)])
    empty = F.array().cast(arrays and gridded.select(F.array(kept).alias("a")).schema["a"].dataType)
    held = F.concat(*[F.coalesce(a, empty) for a in arrays])
    return j.select(*[F.col(c) for c in df.columns], F.explode_outer(held).alias("_bin")) \
        .select(*df.columns, *[F.col(f"_bin.{c}").alias(n) for c, n in zip(extra, names)])
