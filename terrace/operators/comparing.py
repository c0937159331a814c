"""Comparisons of methods and of zones with the raster."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..config import SQUARE_METRES_AN_ACRE, Grid


def share_errors(rows: DataFrame, truth: str, estimate: str) -> DataFrame:
    """Mean absolute error, root mean square error and correlation over class percentages, a row for each class."""
    e = F.col(estimate) - F.col(truth)
    return rows.agg(F.round(F.avg(F.abs(e)), 6).alias("mae"), F.round(F.sqrt(F.avg(e * e)), 6).alias("rmse"), F.round(F.corr(truth, estimate), 6).alias("correlation"))


def safe_percentage(truth: Column, estimate: Column) -> Column:
    """Error in percent of the truth; of a zero truth infinite where something was found, else 0."""
    share = F.try_divide(estimate - truth, truth) * 100
    return F.when(truth > 0, share).when(estimate > 0, F.lit(float("inf"))).otherwise(0.0)


def percentage_errors(rows: DataFrame, truth: str, estimate: str) -> DataFrame:
    """n_infinite, and mean and median of the finite percentage errors."""
    p = safe_percentage(F.col(truth), F.col(estimate))
    known = rows.where(F.col(truth).isNotNull() & F.col(estimate).isNotNull()).select(p.alias("p"))
    finite = F.when(F.col("p") < float("inf"), F.col("p"))
    return known.agg(F.count_if(F.col("p") == float("inf")).alias("n_infinite"), F.round(F.avg(finite), 6).alias("mean_pct"), F.round(F.median(finite), 6).alias("median_pct"))


def sample_statistics(rows: DataFrame, column: str = "CAL_ACREAGE") -> DataFrame:
    return rows.agg(F.round(F.sum(column), 4).alias("total"), F.round(F.avg(column), 6).alias("mean"), F.round(F.median(column), 6).alias("median"))


def below_pixels(rows: DataFrame, grid: Grid, truth: str, estimate: str, limits: tuple[float, ...] = (0.5, 1.0, 2.0)) -> DataFrame:
    """For each limit, in pixels: zones with less acreage, and their mean absolute error."""
    pixel = grid.pixel_area / SQUARE_METRES_AN_ACRE
    each = F.explode(F.array(*[F.lit(x) for x in limits]))
    small = rows.where(F.col(truth).isNotNull()).select(each.alias("pixels"), F.col(truth).alias("t"), F.abs(F.col(estimate) - F.col(truth)).alias("e")).where(F.col("t") < F.col("pixels") * pixel)
    return small.groupBy("pixels").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("e"), 6).alias("mae"))


def side_by_side(methods: dict[str, DataFrame], *columns: str) -> DataFrame:
    """Results of several methods by PARCEL_LID, columns marked by their method."""
    named = [rows.select("PARCEL_LID", *[F.col(c).alias(f"{name}_{c}") for c in columns]) for name, rows in methods.items()]
    return reduce(lambda a, b: a.join(b, "PARCEL_LID"), named)


def agreement(rows: DataFrame, names: list[str]) -> DataFrame:
    """Share of zones, in percent, for which two methods have the same majority: a row for each pair of methods."""
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    one = rows.agg(*[F.avg((F.col(f"{a}_majority_land_use") == F.col(f"{b}_majority_land_use")).cast("int")).alias(f"{a}_{b}") for a, b in pairs])
    each = F.array(*[F.struct(F.lit(a).alias("first"), F.lit(b).alias("second"), F.round(F.col(f"{a}_{b}") * 100, 6).alias("agreement")) for a, b in pairs])
    return one.select(F.explode(each).alias("p")).select("p.*")


def tradeoff(rows: DataFrame, names: list[str], baseline: str) -> DataFrame:
    """For each method its mean absolute error, the gain in percent over the baseline's, and whether it is the most accurate one."""
    known = rows.where(F.col("CAL_ACREAGE").isNotNull())
    one = known.agg(*[F.avg(F.abs(F.col(f"{m}_calculated_acres") - F.col("CAL_ACREAGE"))).alias(m) for m in names])
    each = F.array(*[F.struct(F.lit(m).alias("method"), F.round(m, 6).alias("mae"), F.round((1 - F.try_divide(F.col(m), F.col(baseline))) * 100, 6).alias("gain_pct"), (F.col(m) == F.least(*names)).alias("most_accurate")) for m in names])
    return one.select(F.explode(each).alias("m")).select("m.*")
