"""Retail: raw feeds to cleaned tables to marts.

Optional columns are branches at planning time; a missing required column fails planning. Every
function takes ``as_of`` for the clock. Cleaning functions take ``order``, the columns that say
which of several rows with the same key came last.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions import dates, numbers, text
from tidemill.operators.joins import lookup_join, suffix_clashes
from tidemill.operators.rows import (
    SEQ,
    add_if_absent,
    drop_bookkeeping,
    drop_missing,
    existing,
    fill,
    keep_last,
    last_rule_wins,
    stamp,
)


def _latest(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Last row per key. Null keys would be dropped later anyway, so they are not shuffled at all."""
    return drop_bookkeeping(keep_last(df.filter(F.col(key).isNotNull()), [key], order), order)


def _require(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns {missing}")


def _dates(df: DataFrame, columns: Sequence[str], formats: Sequence[str]) -> DataFrame:
    """Bring the date columns to timestamps; those of a cleaned layer pass through."""
    found = [c for c in existing(df, columns) if not isinstance(df.schema[c].dataType, T.TimestampNTZType)]
    return df.withColumns({c: dates.timestamp_column(df, c, formats) for c in found})


def _number(df: DataFrame, column: str) -> Column:
    if isinstance(df.schema[column].dataType, T.NumericType):
        return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))
    return numbers.parse_number(F.col(column))


def clean_customers(df: DataFrame, order: Sequence[str] = (SEQ,), as_of: Any = None) -> DataFrame:
    """One row per customer with digits-only phone, title-case names, full name and contact flags."""
    _require(df, ["customer_id", "email", "phone", "first_name", "last_name"])
    latest = drop_missing(_latest(df, "customer_id", order), ["first_name", "last_name"])
    cleaned = fill(latest, {"email": ""}).withColumns(
        {
            "phone": text.digits_only(F.col("phone")),
            "first_name": text.title_case(F.col("first_name")),
            "last_name": text.title_case(F.col("last_name")),
        }
    )
    flagged = cleaned.withColumns(
        {
            "full_name": F.concat("first_name", F.lit(" "), "last_name"),
            "has_email": text.has_text(F.col("email")),
            "has_phone": text.has_text(F.col("phone")),
        }
    )
    return stamp(flagged, as_of)


def clean_orders(
    df: DataFrame, order: Sequence[str] = (SEQ,), as_of: Any = None, formats: Sequence[str] = ()
) -> DataFrame:
    """One row per order with parsed dates, total, processing days and status."""
    _require(df, ["order_id", "customer_id", "order_date"])
    cleaned = _dates(_latest(df, "order_id", order), ["order_date", "ship_date", "delivery_date"], formats)
    if "item_price" in cleaned.columns and "quantity" in cleaned.columns:
        cleaned = add_if_absent(cleaned, "order_total", F.col("item_price") * F.col("quantity"))
    cleaned = drop_missing(cleaned, ["customer_id", "order_date"])
    if "ship_date" in cleaned.columns:
        cleaned = cleaned.withColumn("processing_days", dates.elapsed_days(F.col("order_date"), F.col("ship_date")))
    reached = {"ship_date": "Shipped", "delivery_date": "Delivered"}
    rules = [(F.col(c).isNotNull(), reached[c]) for c in existing(cleaned, list(reached))]
    return stamp(add_if_absent(cleaned, "order_status", last_rule_wins("Unknown", rules)), as_of)


def clean_products(df: DataFrame, order: Sequence[str] = (SEQ,), as_of: Any = None) -> DataFrame:
    """One row per product with a trimmed name, numeric prices and margins."""
    _require(df, ["product_id"])
    cleaned = _latest(df, "product_id", order)
    if "product_name" in cleaned.columns:
        name = F.coalesce(text.strip(F.col("product_name")), F.lit("Unknown Product"))
        cleaned = cleaned.withColumn("product_name", name)
    prices = existing(cleaned, ["price", "cost", "msrp"])
    cleaned = cleaned.withColumns({c: _number(cleaned, c) for c in prices})
    cleaned = cleaned.withColumns({c: numbers.not_negative(F.col(c)) for c in prices})
    if "price" in prices and "cost" in prices:
        cleaned = cleaned.withColumn("margin", F.col("price") - F.col("cost"))
        percent = numbers.ratio(F.col("margin"), F.col("price"), when_zero=0.0) * 100
        cleaned = cleaned.withColumn("margin_percent", percent)
    return stamp(cleaned, as_of)


def clean_stores(
    df: DataFrame, order: Sequence[str] = (SEQ,), as_of: Any = None, formats: Sequence[str] = ()
) -> DataFrame:
    """One row per store with trimmed address, digits-only zip and phone, parsed dates, active flag."""
    _require(df, ["store_id"])
    cleaned = _latest(df, "store_id", order)
    fixes: dict[str, Column] = {c: text.strip(F.col(c)) for c in existing(cleaned, ["address", "city"])}
    fixes |= {c: F.upper(text.strip(F.col(c))) for c in existing(cleaned, ["state", "country"])}
    fixes |= {c: text.ascii_digits_only(F.col(c)) for c in existing(cleaned, ["zip_code"])}
    fixes |= {c: text.digits_only(F.col(c)) for c in existing(cleaned, ["phone"])}
    cleaned = _dates(cleaned.withColumns(fixes), ["opening_date", "closing_date"], formats)
    active = F.col("closing_date").isNull() if "closing_date" in cleaned.columns else F.lit(True)
    return stamp(cleaned.withColumn("is_active", active), as_of)


def stock_status(quantity: Column, fix_out_of_stock: bool = False) -> Column:
    """Stock level of a quantity; a null quantity counts as in stock.

    The default keeps the order of the original rules, in which "Low Stock" overrides "Out of Stock".
    """
    rules = [(quantity <= 0, "Out of Stock"), (quantity < 10, "Low Stock")]
    return last_rule_wins("In Stock", rules[::-1] if fix_out_of_stock else rules)


def enrich_inventory(
    inventory: DataFrame,
    products: DataFrame,
    stores: DataFrame,
    as_of: Any = None,
    fix_out_of_stock: bool = False,
    broadcast_limit: int | None = None,
) -> DataFrame:
    """Inventory with product and store attributes, values at cost and retail, and stock status."""
    enriched = inventory
    for key, lookup, wanted in (
        ("product_id", products, ["product_name", "category", "price", "cost"]),
        ("store_id", stores, ["store_name", "city", "state", "is_active"]),
    ):
        if key in enriched.columns and key in lookup.columns:
            columns = lookup.select(key, *existing(lookup, wanted))
            enriched = lookup_join(enriched, columns, key, broadcast_limit=broadcast_limit, sketch_from=inventory)
    if "quantity" in enriched.columns:
        for name, unit in (("inventory_value", "cost"), ("retail_value", "price")):
            if unit in enriched.columns:
                enriched = enriched.withColumn(name, F.col("quantity") * F.col(unit))
        enriched = enriched.withColumn("inventory_status", stock_status(F.col("quantity"), fix_out_of_stock))
    return stamp(enriched, as_of)


def _total(column: str) -> Column:
    """Sum that is 0 when there is nothing to add."""
    return F.coalesce(F.sum(column), F.lit(0)).alias(column)


def order_facts(orders: DataFrame, unique_orders: bool = False) -> DataFrame:
    """Per customer: number of orders, first and last date, spend.

    With ``unique_orders`` (cleaned orders have one row per order) a plain count takes the place of
    the distinct count, so one shuffle instead of two.
    """
    distinct_orders = F.count("order_id") if unique_orders else F.countDistinct("order_id")
    return (
        orders.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            distinct_orders.alias("order_count"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
            _total("order_total").alias("total_spend"),
        )
    )


def customer_segment(orders: Column, days: Column) -> Column:
    repeat = orders >= 2
    return (
        F.when(orders == 1, "New")
        .when(repeat & (days <= 90), "Loyal")
        .when(repeat & (days <= 180), "At Risk")
        .when(repeat & (days > 180), "Churned")
        .otherwise("Unknown")
    )


def customer_orders_mart(
    orders: DataFrame, customers: DataFrame, as_of: Any = None, unique_orders: bool = False
) -> DataFrame:
    """Customers with their order history, segment and average order value."""
    dated = _dates(orders, ["order_date"], ())
    days = dates.days_until_midnight_of(dates.instant(as_of), F.col("last_order_date"))
    facts = order_facts(dated, unique_orders).withColumn("days_since_last_order", days)
    mart = fill(customers.join(facts, "customer_id", "left"), {"order_count": 0, "total_spend": 0.0})
    average = F.coalesce(numbers.ratio(F.col("total_spend"), F.col("order_count"), when_zero=0.0), F.lit(0.0))
    return mart.withColumns(
        {
            "customer_segment": customer_segment(F.col("order_count"), F.col("days_since_last_order")),
            "average_order_value": average,
        }
    )


def stock_facts(inventory: DataFrame) -> DataFrame:
    """Per product: quantity, number of stores, value at cost and retail."""
    return (
        inventory.filter(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            _total("quantity").alias("total_quantity"),
            F.countDistinct("store_id").alias("store_count"),
            _total("inventory_value"),
            _total("retail_value"),
        )
    )


def product_inventory_mart(products: DataFrame, inventory: DataFrame, fix_out_of_stock: bool = False) -> DataFrame:
    """Products with their stock over all stores, potential profit and stock status."""
    stocked = products.join(stock_facts(inventory), "product_id", "left")
    mart = fill(stocked, {"store_count": 0, "inventory_value": 0.0, "retail_value": 0.0})
    quantity = F.coalesce(F.col("total_quantity"), F.lit(0)).cast("long")
    return mart.withColumn("total_quantity", quantity).withColumns(
        {
            "potential_profit": F.col("retail_value") - F.col("inventory_value"),
            "inventory_status": stock_status(F.col("total_quantity"), fix_out_of_stock),
        }
    )


def sales_by_store_mart(
    orders: DataFrame,
    products: DataFrame | None,
    stores: DataFrame,
    unique_orders: bool = False,
) -> DataFrame:
    """Sales per store and month with the store's attributes.

    Orders without a store column all count for store 1. ``products`` is not used. With
    ``unique_orders`` the only distinct count left is that of customers, which Spark computes without
    tripling the rows as it must for two of them.
    """
    dated = _dates(add_if_absent(orders, "store_id", F.lit(1)), ["order_date"], ())
    distinct_orders = F.count("order_id") if unique_orders else F.countDistinct("order_id")
    monthly = (
        drop_missing(dated, ["store_id", "order_date"])
        .groupBy("store_id", F.year("order_date").alias("year"), F.month("order_date").alias("month"))
        .agg(
            distinct_orders.alias("order_count"),
            F.countDistinct("customer_id").alias("customer_count"),
            _total("order_total").alias("total_sales"),
            F.avg("order_total").alias("avg_order_value"),
        )
    )
    # A store has one row per month by now, so no key of this join can be hot.
    left, right = suffix_clashes(monthly, stores, ["store_id"])
    return left.join(right, "store_id", "left")


def sales_growth(mart: DataFrame, value: str = "total_sales") -> DataFrame:
    """The store mart with the sales of the month before and of the same month a year before, and the growth over both.

    Neighbours are found by the calendar: where the month before has no row there is no growth, however near the last row
    is. Growth is (now - before) / before; null where either is null or the earlier sales are zero. The mart has one row
    per store and month, so a store's window is as long as its history in months. Its column ``value`` is named by the caller.
    """
    month = F.col("year") * 12 + F.col("month")
    by_store = Window.partitionBy("store_id").orderBy(month)
    earlier = {"month": 1, "year": 12}
    before = {k: F.first(value).over(by_store.rangeBetween(-n, -n)) for k, n in earlier.items()}
    known = mart.withColumns({f"previous_{k}_sales": c for k, c in before.items()})
    changes = {f"{k}_growth": numbers.ratio(F.col(value) - F.col(f"previous_{k}_sales"), F.col(f"previous_{k}_sales")) for k in earlier}
    return known.withColumns(changes)
