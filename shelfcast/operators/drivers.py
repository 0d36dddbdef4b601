"""Demand-driver features: calendar, seasonality, trend, payday, promotions.

These are the deterministic formulas of the demand model, applied as column
expressions over sales/gold rows joined to their store, product and active
promotion.  Random noise is not part of them (multiplier 1).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values (must equal the model's):
# weekday demand multipliers, Monday = 0 ... Sunday = 6
WEEKDAY_MULTIPLIERS = [0.86, 0.90, 0.96, 1.05, 1.20, 1.34, 1.15]
# payday days of month and their lift
PAYDAY_DAYS = [1, 15, 30, 31]
PAYDAY_LIFT = 1.08
# linear trend per day since the first day, capped
TREND_PER_DAY = 0.00045
TREND_CAP = 0.18
# extra lift of a promotion with a feature display
DISPLAY_LIFT = 0.18
# expected demand never falls below this floor
DEMAND_FLOOR = 0.05
DAYS_PER_YEAR = 365


def weekday_multiplier(d: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in WEEKDAY_MULTIPLIERS]), F.weekday(d) + 1)


def annual_seasonality(d: Column, strength: Column, phase: Column) -> Column:
    """1 + strength * sin(2*pi*(day_of_year - phase) / 365)."""
    angle = F.lit(2 * math.pi) * ((F.dayofyear(d) - phase) / F.lit(float(DAYS_PER_YEAR)))
    return F.lit(1.0) + strength.cast("double") * F.sin(angle)


def trend_multiplier(day_offset: Column) -> Column:
    return F.lit(1.0) + F.least(day_offset * F.lit(TREND_PER_DAY), F.lit(TREND_CAP))


def payday_multiplier(d: Column) -> Column:
    return F.when(F.dayofmonth(d).isin(PAYDAY_DAYS), F.lit(PAYDAY_LIFT)).otherwise(F.lit(1.0))


def promotion_lift(discount: Column, elasticity: Column, display: Column) -> Column:
    """1 + (discount * elasticity + display lift); no promotion -> 1."""
    display_lift = F.when(display.cast("boolean"), F.lit(DISPLAY_LIFT)).otherwise(F.lit(0.0))
    lift = F.lit(1.0) + (discount.cast("double") * elasticity.cast("double") + display_lift)
    return F.when(discount.isNull(), F.lit(1.0)).otherwise(lift)


def calendar_features(dates: DataFrame, start_date: Column) -> DataFrame:
    """O1-O4 per date: weekday (Mon=0) and its multiplier, day of year / month,
    payday multiplier, day offset from ``start_date`` and the trend multiplier."""
    d = F.col("business_date")
    offset = F.datediff(d, start_date)
    return dates.select(
        d,
        F.weekday(d).alias("weekday"),
        weekday_multiplier(d).alias("weekday_multiplier"),
        F.dayofyear(d).alias("day_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        payday_multiplier(d).alias("payday_multiplier"),
        offset.alias("day_offset"),
        trend_multiplier(offset).alias("trend_multiplier"),
    )


def active_promotion(targets: DataFrame, promotions: DataFrame, how: str = "left") -> DataFrame:
    """Attach to each (store_id, sku_id, business_date) row the promotion
    active that day (start <= day <= end, inclusive); on overlap the lowest
    promotion_id wins (ids stand in for list order).

    Range join without pairs: each promotion expands to its own days (exact,
    within the targets' date range), one aggregate keeps the winner per (store, SKU, day), then a plain
    equi-join.  The work is the total promotion-days, not targets x promotions.
    """
    # an open-ended promotion is clipped to the days asked for (one row of bounds)
    bound = lambda agg: targets.select(agg("business_date")).scalar()
    first, last = F.greatest(F.col("start_date"), bound(F.min)), F.least(F.col("end_date"), bound(F.max))
    clipped = promotions.withColumn("_first", first).withColumn("_last", last)
    days = clipped.filter(F.col("_last") >= F.col("_first")).select(
        "store_id", "sku_id",
        F.explode(F.sequence("_first", "_last")).alias("business_date"),
        F.struct("promotion_id", "discount_pct", "feature_display").alias("_p"),
    )
    winner = days.groupBy("store_id", "sku_id", "business_date").agg(F.min("_p").alias("_p"))
    return targets.join(winner, ["store_id", "sku_id", "business_date"], how).withColumn("promotion_id", F.col("_p.promotion_id")).withColumn(
        "promo_discount_pct", F.col("_p.discount_pct")
    ).withColumn("promo_feature_display", F.col("_p.feature_display")).drop("_p")


def expected_demand(rows: DataFrame, stores: DataFrame, products: DataFrame, promotions: DataFrame,
                    start_date: Column) -> DataFrame:
    """O6 (+J5, J7): expected demand of each (store, SKU, day) row.

    base * store multiplier * weekday * seasonality * trend * payday * promotion
    lift, floored at 0.05.  Dimension joins are plain equi-joins; AQE turns them
    into broadcasts when the measured dimension side is small.  A row whose store or
    product is unknown stays, with a null demand (and a null lift without a product).
    """
    st = stores.select("store_id", F.col("demand_multiplier").cast("double").alias("store_multiplier"))
    pr = products.select(
        "sku_id",
        F.col("base_daily_demand").cast("double").alias("base_daily_demand"),
        "seasonality_strength", "seasonal_phase",
        F.col("price_elasticity").cast("double").alias("price_elasticity"),
    )
    with_promo = active_promotion(rows, promotions)
    joined = with_promo.join(st, "store_id", "left").join(pr, "sku_id", "left")
    d = F.col("business_date")
    lift = promotion_lift(F.col("promo_discount_pct"), F.col("price_elasticity"), F.col("promo_feature_display"))
    demand = (
        F.col("base_daily_demand")
        * F.col("store_multiplier")
        * weekday_multiplier(d)
        * annual_seasonality(d, F.col("seasonality_strength"), F.col("seasonal_phase"))
        * trend_multiplier(F.datediff(d, start_date))
        * payday_multiplier(d)
        * lift
    )
    return joined.select(
        "store_id", "sku_id", "business_date", "promotion_id",
        lift.alias("promotion_lift"),
        F.when(demand.isNotNull(), F.greatest(demand, F.lit(DEMAND_FLOOR))).alias("expected_demand"),
    )


def stockout_flags(rows: DataFrame) -> DataFrame:
    """observed = min(latent, on hand); stockout when latent exceeds on hand."""
    latent, on_hand = F.col("units"), F.col("inventory_on_hand")
    return rows.select(
        "transaction_id",
        latent.cast("long").alias("latent_units"),
        on_hand.cast("long").alias("inventory_on_hand"),
        F.least(latent, on_hand).cast("long").alias("observed_units"),
        (latent > on_hand).alias("is_stockout"),
    )


def revenue_lines(rows: DataFrame) -> DataFrame:
    """Effective price = round(price * (1 - discount), 2); gross = round(units *
    price, 2); net = round(units * effective price, 2) - decimal, half-up."""
    price = F.col("unit_price").cast("decimal(10,2)")
    discount = F.col("discount_pct").cast("decimal(5,2)")
    units = F.col("units").cast("decimal(10,0)")
    effective = F.round(price * (F.lit(1).cast("decimal(1,0)") - discount), 2).cast("decimal(10,2)")
    return rows.select(
        "transaction_id",
        F.col("units"),
        effective.alias("effective_unit_price"),
        F.round(units * price, 2).cast("decimal(12,2)").alias("gross_revenue"),
        F.round(units * effective, 2).cast("decimal(12,2)").alias("net_revenue"),
    )
