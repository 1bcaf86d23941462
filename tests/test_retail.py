import datetime as dt
import random

import pandas as pd
import pytest

from tidemill.plans import retail, sample

AS_OF = "2024-06-30 12:00:00"
NOW = dt.datetime(2024, 6, 30, 12)


def records(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_clean_customers(rows):
    raw = rows(
        [
            (1, "a@x", "+1 (2)", "old", "name", 1),
            (1, None, None, "o'neil", "mary-ann", 2),
            (2, "b@x", "n/a", "ann", None, 1),
            (None, "c@x", "1", "no", "key", 1),
        ],
        "customer_id int, email string, phone string, first_name string, last_name string, _seq int",
    )
    cleaned = retail.clean_customers(raw, as_of=AS_OF)
    assert "_seq" not in cleaned.columns
    assert records(cleaned, "customer_id", "email", "phone", "full_name", "has_email", "has_phone", "last_updated") == [
        (1, "", "", "O'Neil Mary-Ann", False, False, NOW)
    ]


def test_required_columns(rows):
    with pytest.raises(KeyError, match="email"):
        retail.clean_customers(rows([(1, 1)], "customer_id int, _seq int"))


def test_clean_orders(rows):
    raw = rows(
        [
            (1, 7, "2024-01-01 12:00:00", "2024-01-03 11:00:00", None, 2.5, 4, 1),
            (2, 7, "2024-01-05", "2024-01-01", "2024-01-09", 1.0, 1, 1),
            (3, 7, "bad", None, None, 1.0, 1, 1),
            (4, None, "2024-01-05", None, None, 1.0, 1, 1),
            (5, 8, "2024-01-05", "soon", None, None, 1, 1),
        ],
        "order_id int, customer_id int, order_date string, ship_date string, delivery_date string, item_price double, "
        "quantity int, _seq int",
    )
    assert records(retail.clean_orders(raw, as_of=AS_OF), "order_id", "order_total", "processing_days", "order_status") == [
        (1, 10.0, 1, "Shipped"), (2, 1.0, None, "Delivered"), (5, None, None, "Unknown"),
    ]


def test_clean_orders_keeps_given_total_and_status(rows):
    raw = rows(
        [(1, 7, "2024-01-01", 99.0, "Lost", 1)],
        "order_id int, customer_id int, order_date string, order_total double, order_status string, _seq int",
    )
    cleaned = retail.clean_orders(raw, as_of=AS_OF)
    assert records(cleaned, "order_total", "order_status") == [(99.0, "Lost")]
    assert "processing_days" not in cleaned.columns


def test_clean_products(rows):
    raw = rows(
        [
            (1, "\t Lamp \n", "10", "4", "12", 1), (2, None, "0", None, "x", 1), (3, "a", "-5", "1", "1", 1),
            (None, "b", "1", "1", "1", 1),
        ],
        "product_id int, product_name string, price string, cost string, msrp string, _seq int",
    )
    got = records(retail.clean_products(raw, as_of=AS_OF), "product_id", "product_name", "price", "cost", "margin_percent")
    assert got == [(1, "Lamp", 10.0, 4.0, 60.0), (2, "Unknown Product", 0.0, None, 0.0), (3, "a", None, 1.0, None)]


def test_clean_products_with_numeric_prices_and_few_columns(rows):
    raw = rows([(1, 3.0, 1), (2, float("nan"), 1)], "product_id int, price double, _seq int")
    cleaned = retail.clean_products(raw, as_of=AS_OF)
    assert records(cleaned, "product_id", "price") == [(1, 3.0), (2, None)]
    assert "margin" not in cleaned.columns


def test_clean_stores(rows):
    raw = rows(
        [
            (1, " 1 High St ", " ny ", "ZIP 00501-٣", " us", "(1) 2", "1990-01-01", None, 1),
            (2, None, None, None, None, None, "bad", "2020-01-01", 1),
        ],
        "store_id int, address string, state string, zip_code string, country string, phone string, opening_date string, "
        "closing_date string, _seq int",
    )
    got = records(
        retail.clean_stores(raw, as_of=AS_OF), "store_id", "address", "state", "zip_code", "country", "phone", "is_active"
    )
    assert got == [(1, "1 High St", "NY", "00501", "US", "12", True), (2, None, None, "", None, "", False)]


def test_stores_without_closing_dates_are_active(rows):
    assert records(retail.clean_stores(rows([(1, 1)], "store_id int, _seq int"), as_of=AS_OF), "is_active") == [(True,)]


def inventory_frames(rows):
    inventory = rows([(1, 1, 5), (1, 2, 0), (2, 1, 10), (9, 9, None)], "product_id int, store_id int, quantity int")
    products = rows(
        [(1, "Lamp", "home", 10.0, 4.0, "x"), (2, "Desk", "home", 20.0, None, "x"), (3, "Sofa", "home", 5.0, 1.0, "x")],
        "product_id int, product_name string, category string, price double, cost double, msrp string",
    )
    stores = rows([(1, "Main", "NYC", "NY", True), (2, "Side", "LA", "CA", False)],
                  "store_id int, store_name string, city string, state string, is_active boolean")
    return inventory, products, stores


@pytest.mark.parametrize("limit", [None, 0])
def test_enrich_inventory(rows, limit):
    enriched = retail.enrich_inventory(*inventory_frames(rows), as_of=AS_OF, broadcast_limit=limit)
    assert "msrp" not in enriched.columns
    got = records(enriched, "product_id", "store_id", "product_name", "city", "inventory_value", "retail_value", "inventory_status")
    assert got == [
        (1, 1, "Lamp", "NYC", 20.0, 50.0, "Low Stock"), (1, 2, "Lamp", "LA", 0.0, 0.0, "Low Stock"),
        (2, 1, "Desk", "NYC", None, 200.0, "In Stock"), (9, 9, None, None, None, None, "In Stock"),
    ]


def test_out_of_stock_only_when_asked_for(rows):
    enriched = retail.enrich_inventory(*inventory_frames(rows), as_of=AS_OF, fix_out_of_stock=True)
    assert [r[0] for r in records(enriched.filter("quantity = 0"), "inventory_status")] == ["Out of Stock"]


def test_product_inventory_mart(rows):
    inventory, products, stores = inventory_frames(rows)
    mart = retail.product_inventory_mart(products, retail.enrich_inventory(inventory, products, stores, as_of=AS_OF))
    got = records(mart, "product_id", "total_quantity", "store_count", "potential_profit", "inventory_status")
    assert got == [(1, 5, 2, 30.0, "Low Stock"), (2, 10, 1, 200.0, "In Stock"), (3, 0, 0, 0.0, "Low Stock")]


@pytest.mark.parametrize("unique", [True, False])
def test_customer_orders_mart(rows, unique):
    customers = rows([(i,) for i in range(1, 7)], "customer_id int")
    orders = rows(
        [
            (1, 1, "2024-06-01", 10.0), (2, 2, "2024-01-01", 10.0), (3, 2, "2024-06-01", 20.0),
            (4, 3, "2024-01-15", 1.0), (5, 3, "2024-03-15", None), (6, 4, "2023-01-01", 2.0), (7, 4, "2023-01-01", 3.0),
            (8, 5, "2024-01-01", None), (9, None, "2024-06-01", 5.0),
        ],
        "order_id int, customer_id int, order_date string, order_total double",
    )
    mart = retail.customer_orders_mart(orders, customers, AS_OF, unique_orders=unique)
    got = records(mart, "customer_id", "order_count", "total_spend", "days_since_last_order", "customer_segment", "average_order_value")
    assert got == [
        (1, 1, 10.0, 29, "New", 10.0), (2, 2, 30.0, 29, "Loyal", 15.0), (3, 2, 1.0, 107, "At Risk", 0.5),
        (4, 2, 5.0, 546, "Churned", 2.5), (5, 1, 0.0, 181, "New", 0.0), (6, 0, 0.0, None, "Unknown", 0.0),
    ]


@pytest.mark.parametrize("unique", [True, False])
def test_sales_by_store_mart(rows, unique):
    orders = rows(
        [(1, 1, 1, "2024-01-05", 10.0), (2, 1, 1, "2024-01-06", 20.0), (3, 2, 1, "2024-02-01", None), (4, 2, 2, "bad", 1.0)],
        "order_id int, customer_id int, store_id int, order_date string, order_total double",
    )
    stores = rows([(1, "Main")], "store_id int, store_name string")
    mart = retail.sales_by_store_mart(orders, None, stores, unique_orders=unique)
    columns = ("year", "month", "order_count", "customer_count", "total_sales", "avg_order_value", "store_name")
    assert records(mart, *columns) == [(2024, 1, 2, 1, 30.0, 15.0, "Main"), (2024, 2, 1, 1, 0.0, None, "Main")]
    one_store = retail.sales_by_store_mart(orders.drop("store_id"), None, stores, unique_orders=unique)
    assert {r[0] for r in records(one_store, "store_id")} == {1}


def test_customers_agree_with_pandas_on_random_data(spark, rows):
    dice = random.Random(3)
    data = [
        (
            dice.choice([None, *range(30)]), dice.choice([None, "a@x", ""]), dice.choice([None, "+1 (2)", "x"]),
            dice.choice([None, "o'neil", "ANN marie"]), dice.choice([None, "3rd", "de la cruz"]), i,
        )
        for i in range(300)
    ]
    raw = rows(data, "customer_id int, email string, phone string, first_name string, last_name string, _seq int")
    names = ["customer_id", "email", "phone", "first_name", "last_name"]
    frame = pd.DataFrame([d[:5] for d in data], columns=names).groupby("customer_id", as_index=False, dropna=True).nth(-1)
    frame = frame[frame.first_name.notna() & frame.last_name.notna()]
    expected = [
        (int(r.customer_id), r.email or "", "".join(filter(str.isdigit, r.phone or "")), f"{r.first_name} {r.last_name}".title())
        for r in frame.itertuples()
    ]
    got = records(retail.clean_customers(raw, as_of=AS_OF), "customer_id", "email", "phone", "full_name")
    assert got == sorted(expected, key=repr)


def test_sample_tables(spark):
    staged = sample.staging(sample.sample_raw(spark))
    assert records(staged.filter("id = 1"), "value_category", "date") == [("10.5-A", dt.datetime(2023, 1, 1))]
    got = records(sample.warehouse(staged), "category", "count", "min_value", "max_value", "latest_date")
    assert got[0] == ("A", 2, 10.5, 30.1, dt.datetime(2023, 1, 3))
    with pytest.raises(Exception, match="not a date"):
        sample.staging(spark.sql("SELECT 'x' AS date, 'a' AS category, 1.0 AS value")).collect()


def test_sample_models(spark):
    first = sample.first_model(spark)
    assert records(first, "id") == [(1,), (None,)]
    assert records(sample.second_model(first), "id") == [(1,)]
