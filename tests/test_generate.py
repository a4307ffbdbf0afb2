"""Generated bronze rows."""

from pyspark.sql import functions as F

from medallion.sources.generate import (
    ITEMS,
    STATE_CODES,
    generate_bronze,
    generate_customers,
    generate_orders,
)


def test_customers(spark):
    c = generate_customers(spark, 1000, seed=3)
    assert c.count() == 1000
    assert c.select(F.min("id"), F.max("id"), F.countDistinct("id")).first() == (0, 999, 1000)
    assert {r[0] for r in c.select("state_id").distinct().collect()} <= set(STATE_CODES)
    assert c.where("first_name IS NULL OR last_name IS NULL").count() == 0


def test_orders(spark):
    o = generate_orders(spark, 10000, 1000, seed=3)
    assert o.count() == 10000
    assert o.select(F.countDistinct("order_id")).first()[0] == 10000
    lo, hi = o.select(F.min("customer_id"), F.max("customer_id")).first()
    assert 0 <= lo and hi < 1000
    assert {r[0] for r in o.select("item_name").distinct().collect()} == set(ITEMS)


def test_deterministic(spark):
    a = generate_orders(spark, 500, 50, seed=1).drop("delivered_on", "datetime_order_placed")
    b = generate_orders(spark, 500, 50, seed=1).drop("delivered_on", "datetime_order_placed")
    assert a.exceptAll(b).count() == 0


def test_bronze_source(spark):
    customer, orders = generate_bronze(1000, 10000)(spark)
    assert customer.count() == 1000 and orders.count() == 10000


def test_state_codes():
    assert len(STATE_CODES) == len(set(STATE_CODES)) == 59
