"""Relational constraints of the retail tables, checked as DataFrame aggregates.

Primary keys (unique, not null), NOT NULL columns, CHECK predicates and foreign
keys become violation counts; nothing is collected.  A CHECK passes when its
predicate is true or NULL, as in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.schemas import PRIMARY_KEYS, RETAIL_TABLE_SCHEMAS

Check = Callable[[], Column]

# CHECK predicates of each table (all must hold).
VALUE_CHECKS: dict[str, dict[str, Check]] = {
    "stores": {
        "square_feet_positive": lambda: F.col("square_feet") > 0,
        "demand_multiplier_positive": lambda: F.col("demand_multiplier") > 0,
    },
    "products": {
        "unit_cost_non_negative": lambda: F.col("unit_cost") >= 0,
        "unit_price_at_least_cost": lambda: F.col("unit_price") >= F.col("unit_cost"),
        "shelf_life_positive": lambda: F.col("shelf_life_days") > 0,
        "base_demand_positive": lambda: F.col("base_daily_demand") > 0,
        "seasonality_non_negative": lambda: F.col("seasonality_strength") >= 0,
        "seasonal_phase_in_year": lambda: F.col("seasonal_phase").between(0, 364),
        "elasticity_positive": lambda: F.col("price_elasticity") > 0,
    },
    "promotions": {
        "discount_in_range": lambda: (F.col("discount_pct") >= 0) & (F.col("discount_pct") < 1),
        "end_not_before_start": lambda: F.col("end_date") >= F.col("start_date"),
    },
    "sales_transactions": {
        "units_positive": lambda: F.col("units") > 0,
        "unit_price_non_negative": lambda: F.col("unit_price") >= 0,
        "discount_in_range": lambda: (F.col("discount_pct") >= 0) & (F.col("discount_pct") < 1),
        "gross_revenue_non_negative": lambda: F.col("gross_revenue") >= 0,
        "net_revenue_non_negative": lambda: F.col("net_revenue") >= 0,
        "inventory_non_negative": lambda: F.col("inventory_on_hand") >= 0,
    },
}

NULLABLE = {"sales_transactions": {"promotion_id"}}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS = [
    ("promotions", "sku_id", "products", "sku_id"),
    ("promotions", "store_id", "stores", "store_id"),
    ("sales_transactions", "store_id", "stores", "store_id"),
    ("sales_transactions", "sku_id", "products", "sku_id"),
    ("sales_transactions", "promotion_id", "promotions", "promotion_id"),
]


def _rows(table: str, named: list[tuple[str, Column]]) -> Column:
    return F.explode(F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(name).alias("check_name"),
                 F.coalesce(c.cast("long"), F.lit(0).cast("long")).alias("violations"))
        for name, c in named
    ]))


def row_checks(table: str, df: DataFrame) -> DataFrame:
    """NOT NULL and CHECK predicates of one table in a single aggregate."""
    nullable = NULLABLE.get(table, set())
    named = [(f"not_null:{f.name}", F.count_if(F.col(f.name).isNull()))
             for f in RETAIL_TABLE_SCHEMAS[table].fields if f.name not in nullable]
    named += [(f"check:{name}", F.count_if(~pred())) for name, pred in VALUE_CHECKS.get(table, {}).items()]
    aggs = [c.alias(f"_c{i}") for i, (_, c) in enumerate(named)]
    return df.agg(*aggs).select(
        _rows(table, [(name, F.col(f"_c{i}")) for i, (name, _) in enumerate(named)]).alias("r")
    ).select("r.*")


def primary_key_check(table: str, df: DataFrame) -> DataFrame:
    """Rows whose key is shared with another row (null keys are NOT NULL violations)."""
    pk = PRIMARY_KEYS[table]
    dup = df.filter(F.col(pk).isNotNull()).groupBy(pk).agg(F.count(F.lit(1)).alias("_c"))
    return dup.agg(F.sum(F.when(F.col("_c") > 1, F.col("_c"))).alias("_v")).select(
        _rows(table, [(f"primary_key:{pk}", F.col("_v"))]).alias("r")
    ).select("r.*")


def foreign_key_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per foreign key: child rows whose non-null reference has no parent."""
    out = None
    for child, ccol, parent, pcol in FOREIGN_KEYS:
        # distinct references with their row counts: a hot reference is one row in the join
        refs = (tables[child].filter(F.col(ccol).isNotNull()).groupBy(F.col(ccol).alias("_ref"))
                .agg(F.count(F.lit(1)).alias("_rows")))
        keys = tables[parent].select(F.col(pcol).alias("_ref"))
        orphans = refs.join(keys, "_ref", "left_anti")
        part = orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("violations")).select(
            F.lit(child).alias("child_table"), F.lit(ccol).alias("child_column"),
            F.lit(parent).alias("parent_table"), F.lit(pcol).alias("parent_column"),
            F.col("violations"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def constraint_report(tables: dict[str, DataFrame]) -> DataFrame:
    """D12-D15 for the four tables: (table_name, check_name, violations)."""
    parts = []
    for table, df in tables.items():
        parts.append(row_checks(table, df))
        parts.append(primary_key_check(table, df))
    fk = foreign_key_violations(tables).select(
        F.col("child_table").alias("table_name"),
        F.concat(F.lit("foreign_key:"), F.col("child_column"), F.lit("->"), F.col("parent_table")).alias("check_name"),
        F.col("violations"),
    )
    parts.append(fk)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def inventory_cap_violations(sales: DataFrame) -> DataFrame:
    """(store, SKU, day) whose units sold exceed the inventory on hand that day."""
    daily = sales.groupBy("store_id", "sku_id", "business_date").agg(
        F.sum("units").cast("long").alias("units_sold"),
        F.max("inventory_on_hand").cast("long").alias("inventory_on_hand"),
    )
    return daily.filter(F.col("units_sold") > F.col("inventory_on_hand"))
