"""From forecasts to decisions: conformal intervals, newsvendor quantities, policy cost.

Quantiles of a series are read from counts per value and their running sum, so a
series is never gathered: a group holds its different values, not its rows.  Periods
without demand are counted, not generated.  Money stays decimal, sums are exact.
"""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.errors import BaselineForecastError
from shelfcast.operators import forecast as FC

ALPHA = Decimal("0.1")
COST = "decimal(38,6)"


def value_at_rank(values: DataFrame, keys: list[str], value: str, rank: Column, name: str) -> DataFrame:
    """Per ``keys``: the smallest ``value`` at or below which at least ``rank`` rows lie.

    ``values`` has a row per (keys, value) with its count ``n``; ``rank`` may use columns that are
    constant within the keys and ``total``, the summed count.  A rank beyond the total gives null.
    """
    order = Window.partitionBy(*keys).orderBy(value)
    everything = Window.partitionBy(*keys)
    ranked = values.withColumn("_below", F.sum("n").over(order)).withColumn("total", F.sum("n").over(everything))
    return ranked.groupBy(*keys).agg(F.min(F.when(F.col("_below") >= rank, F.col(value))).alias(name))


# ---------------------------------------------------------------- E1 split-conformal intervals


def conformal_radius(calibration: DataFrame, alpha: Decimal = ALPHA) -> DataFrame:
    """(series, radius): the ceil((n + 1)(1 - alpha))-th smallest absolute error; null where n is too small for alpha."""
    if not 0 < alpha < 1:
        raise BaselineForecastError(f"alpha must lie between 0 and 1, not {alpha}")
    counts = calibration.groupBy(*FC.SERIES, "absolute_error").agg(F.count(F.lit(1)).alias("n"))
    rank = F.ceil((F.col("total") + 1).cast("decimal(20,0)") * F.lit(1 - alpha))
    return value_at_rank(counts, FC.SERIES, "absolute_error", rank, "radius")


def conformal_intervals(panel: DataFrame, test_start: date, test_end: date, calibration_days: int = FC.HOLDOUT_DAYS,
                        alpha: Decimal = ALPHA, season: int = FC.SEASON_DAYS) -> DataFrame:
    """Seasonal-naive forecasts of the test days with a band of coverage 1 - alpha.

    The band's radius comes from the ``calibration_days`` before the test days, forecast by the same
    method from the days before them.  The lower bound stops at 0; a null radius leaves both bounds null.
    """
    start = test_start - timedelta(days=calibration_days)
    calibration = FC.seasonal_naive(panel, start, test_start - timedelta(days=1), season, guard=False)
    forecasts = FC.seasonal_naive(panel, test_start, test_end, season, guard=False)
    f, r = F.col("forecast_units"), F.col("radius")
    # a plain max or min skips nulls: greatest must not turn a null bound into 0
    banded = forecasts.join(conformal_radius(calibration, alpha), FC.SERIES, "left").select(
        *FC.SERIES, FC.DATE, "actual_units", "forecast_units", "radius",
        F.when(r.isNotNull(), F.greatest(F.lit(0.0), f - r)).alias("lower_units"), (f + r).alias("upper_units"))
    return banded.withColumn("covered", F.col("actual_units").between(F.col("lower_units"), F.col("upper_units")))


def coverage(intervals: DataFrame, alpha: Decimal = ALPHA) -> DataFrame:
    """One row: rows with a band, how many it covers, the share, the target, and the mean width."""
    return intervals.where("radius IS NOT NULL").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("covered").alias("covered_rows"),
        FC.exact_mean(F.col("upper_units") - F.col("lower_units")).alias("mean_width")).select(
        "rows", "covered_rows", F.try_divide(F.col("covered_rows").cast("double"), F.col("rows")).alias("coverage"),
        F.lit(float(1 - alpha)).alias("target_coverage"), "mean_width")


# ---------------------------------------------------------------- E2 newsvendor order quantities


def period_demand(demand: DataFrame, last: Column, days: Column, keys: list[str], period: int) -> tuple[DataFrame, Column]:
    """Demand summed over whole periods of ``period`` days that end with the day ``last``, of ``days`` days in all; a column with
    the number of such periods.  Days before the first whole period are left out."""
    whole = F.floor(days / period).cast("long")
    index = F.floor(F.datediff(last, F.col(FC.DATE)) / period)
    summed = demand.withColumn("_period", index).where(index < whole).groupBy(*keys, "_period").agg(F.sum(FC.TARGET).alias(FC.TARGET))
    return summed, whole


def demand_counts(demand: DataFrame, periods: Column, keys: list[str]) -> DataFrame:
    """(keys, units, n): periods per demand value out of ``periods``, those without a row counted as zero demand."""
    own = demand.groupBy(*keys, F.col(FC.TARGET).alias("units")).agg(F.count(F.lit(1)).alias("n"))
    idle = demand.groupBy(*keys).agg(F.count(F.lit(1)).alias("_sold")).select(*keys, F.lit(0.0).alias("units"), (periods - F.col("_sold")).alias("n"))
    return own.unionByName(idle).groupBy(*keys, "units").agg(F.sum("n").cast("long").alias("n")).where("n > 0")


def critical_quantity(counts: DataFrame, products: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, order_units): the smallest demand whose share of days reaches (price - cost) / price of the SKU.

    Compared as whole decimals, cumulated days x price >= days x (price - cost), so no ratio is
    rounded.  A SKU without product, price or cost, or with a price of 0 or less, has no quantity
    (null); a cost above the price orders the least demand seen.
    """
    priced = counts.join(products.select("sku_id", "unit_price", "unit_cost"), "sku_id", "left")
    usable = F.when(F.col("unit_price") > 0, F.col("unit_price"))
    order = Window.partitionBy(*keys).orderBy("units")
    ranked = priced.withColumn("_below", F.sum("n").over(order)).withColumn("_total", F.sum("n").over(Window.partitionBy(*keys)))
    enough = F.col("_below").cast("decimal(20,0)") * usable >= F.col("_total").cast("decimal(20,0)") * (usable - F.col("unit_cost"))
    return ranked.groupBy(*keys).agg(F.min(F.when(enough, F.col("units"))).alias("order_units"))


def newsvendor(gold: DataFrame, products: DataFrame, bounds: tuple[date, date], period: int = 1) -> DataFrame:
    """Order quantity of every series for ``period`` days, from its whole history, with the critical ratio."""
    days = F.lit((bounds[1] - bounds[0]).days + 1)
    demand, periods = period_demand(FC.daily_demand(gold), F.lit(bounds[1]), days, FC.SERIES, period)
    counts = demand_counts(demand, periods, FC.SERIES)
    ratio = F.when(F.col("unit_price") > 0, (F.col("unit_price") - F.col("unit_cost")).cast("double") / F.col("unit_price").cast("double"))
    return critical_quantity(counts, products, FC.SERIES).join(
        products.select("sku_id", ratio.alias("critical_ratio")), "sku_id", "left").select(*FC.SERIES, "critical_ratio", "order_units")


# ---------------------------------------------------------------- E3 policy cost over rolling origins


def rolling_cutoffs(bounds: tuple[date, date], folds: int = 3, horizon: int = FC.HOLDOUT_DAYS, season: int = FC.SEASON_DAYS) -> list[date]:
    """Last training day of each fold: the folds end with the calendar and follow each other without overlap."""
    cutoffs = [bounds[1] - timedelta(days=horizon * (folds - i)) for i in range(folds)]
    if folds <= 0 or (cutoffs[0] - bounds[0]).days + 1 < season:
        raise BaselineForecastError(f"{folds} folds of {horizon} days leave less than one season of {season} days to learn from")
    return cutoffs


def rolling_orders(gold: DataFrame, products: DataFrame, bounds: tuple[date, date], cutoffs: list[date],
                   horizon: int = FC.HOLDOUT_DAYS, season: int = FC.SEASON_DAYS, period: int = 1) -> DataFrame:
    """(series, first day, cutoff, demand, order per policy) of every ``period`` days of every fold, in one plan.

    An order is placed at the cutoff for each period of the horizon (the last may be shorter).  The lag of the seasonal policy has a closed form per cutoff, so all folds share one equi-join; a
    series that starts after a cutoff has no history there and orders 0.
    """
    panel, demand = FC.demand_panel(gold, bounds), FC.daily_demand(gold)
    folds = F.array(*[F.lit(c).cast("date") for c in cutoffs])
    d, c = F.col(FC.DATE), F.col("cutoff_date")
    tests = panel.where(d > F.lit(cutoffs[0])).withColumn("cutoff_date", F.explode(
        F.filter(folds, lambda x: (x < d) & (d <= F.date_add(x, horizon)))))
    steps = F.ceil(F.datediff(d, c) / F.lit(season)).cast("int")
    first = cutoffs[0] - timedelta(days=season - 1)
    history = panel.where(d >= F.lit(first)).select(*FC.SERIES, d.alias("_lag"), F.col(FC.TARGET).alias("seasonal_units"))
    seasonal = tests.withColumn("_lag", F.date_sub(d, steps * season)).join(history, [*FC.SERIES, "_lag"], "left")
    # demand values before each cutoff, per fold
    keys = [*FC.SERIES, "cutoff_date"]
    past = demand.withColumn("cutoff_date", F.explode(F.filter(folds, lambda x: d <= x)))
    summed, periods = period_demand(past, c, F.datediff(c, F.lit(bounds[0])) + 1, keys, period)
    planned = critical_quantity(demand_counts(summed, periods, keys), products, keys)
    orders = seasonal.groupBy(*keys, F.floor((F.datediff(d, c) - 1) / period).alias("_period")).agg(
        F.min(FC.DATE).alias(FC.DATE), F.sum(FC.TARGET).alias("demand_units"), F.sum(F.coalesce("seasonal_units", F.lit(0.0))).alias("seasonal_naive"))
    return orders.join(planned, keys, "left").withColumn("newsvendor", F.coalesce("order_units", F.lit(0.0))).drop("_period", "order_units")


def policy_cost(orders: DataFrame, products: DataFrame, policies: tuple[str, ...] = ("seasonal_naive", "newsvendor")) -> DataFrame:
    """(policy, cutoff): orders, lost margin of unmet demand, cost of unsold stock, and their sum.  Orders of
    a SKU without price or cost are counted in ``unpriced_orders`` and cost nothing."""
    # one order column per policy -> rows, at most a handful per order
    rows = orders.select("sku_id", "cutoff_date", "demand_units", F.explode(F.array(*[
        F.struct(F.lit(p).alias("policy"), F.col(p).alias("ordered")) for p in policies])).alias("_p")).select("*", "_p.*").drop("_p")
    # equal orders cost the same: counted before prices are joined
    equal = rows.groupBy("policy", "cutoff_date", "sku_id", "demand_units", "ordered").agg(F.count(F.lit(1)).alias("n"))
    priced = equal.join(products.select("sku_id", "unit_price", "unit_cost"), "sku_id", "left")
    unmet = F.greatest(F.col("demand_units") - F.col("ordered"), F.lit(0.0)).cast("decimal(16,2)")
    unsold = F.greatest(F.col("ordered") - F.col("demand_units"), F.lit(0.0)).cast("decimal(16,2)")
    n = F.col("n").cast("decimal(12,0)")
    known = F.col("unit_price").isNotNull() & F.col("unit_cost").isNotNull()
    under = F.when(known, (unmet * (F.col("unit_price") - F.col("unit_cost"))).cast("decimal(24,4)") * n)
    over = F.when(known, (unsold * F.col("unit_cost")).cast("decimal(24,4)") * n)
    return priced.groupBy("policy", "cutoff_date").agg(
        F.sum("n").cast("long").alias("orders"), F.sum(F.when(~known, F.col("n")).otherwise(0)).alias("unpriced_orders"),
        F.coalesce(F.sum(under), F.lit(0)).cast("double").alias("understock_cost"),
        F.coalesce(F.sum(over), F.lit(0)).cast("double").alias("overstock_cost")).withColumn(
        "total_cost", F.col("understock_cost") + F.col("overstock_cost"))
