"""Counts published for the two-batch fixture (cuts 1995-07-01 and
1996-01-01, sf0.001), reproduced with the operators."""

from pyspark.sql import functions as F

from medallion.functions.columns import with_surrogate_key
from medallion.operators.lookup import lookup_current
from medallion.operators.mart import sales_mart
from medallion.operators.publish import upsert
from medallion.operators.scd2 import scd2_changes, scd2_net_new
from medallion.plans.queries import Lake
from medallion.sources.testdata import NO_ORDERS, customer_batch, orders_batch
from tests.conftest import SF_SMALL

CUT1, CUT2 = "1995-07-01", "1996-01-01"


def ordering(spark, cut):
    """Customers with an order before the cut: those the counts are of."""
    return customer_batch(spark, SF_SMALL, cut).where(F.col("datetime_updated") > NO_ORDERS)


def _dim(spark, cuts):
    lake = Lake(spark, "fx", ("dim_customer",))
    table = lake.t("dim_customer")
    for i, cut in enumerate(cuts):
        src = with_surrogate_key(ordering(spark, cut))
        changes = scd2_changes(src, spark.table(table)).withColumn("partition", F.lit(f"r{i}"))
        upsert(spark, table, changes, ["customer_sur_id"])
    return spark.table(table)


def _rows_current(dim):
    return dim.count(), dim.where("current").count()


def test_batches_and_parts(spark):
    b1 = ordering(spark, CUT1)
    b2 = ordering(spark, CUT2)
    assert (b1.count(), b2.count()) == (82, 116)
    assert customer_batch(spark, SF_SMALL, CUT1).count() == 150  # all customers, with orders or not
    j = b2.alias("n").join(b1.alias("o"), "id", "left")
    assert j.where("o.first_name IS NULL").count() == 34  # new ids
    assert j.where("o.datetime_updated < n.datetime_updated").count() == 49  # changed
    assert j.where("o.datetime_updated = n.datetime_updated").count() == 33  # unchanged
    dim1 = _dim(spark, [CUT1])
    src2 = with_surrogate_key(b2)
    assert scd2_net_new(src2, dim1).count() == 67
    assert scd2_changes(src2, dim1).count() == 165


def test_dimension_states(spark):
    assert _rows_current(_dim(spark, [CUT1, CUT2])) == (165, 116)
    assert _rows_current(_dim(spark, [CUT1, CUT2, CUT2])) == (165, 116)
    assert _rows_current(_dim(spark, [CUT2, CUT1])) == (165, 165)
    assert _rows_current(_dim(spark, [CUT1, CUT2, CUT1])) == (165, 165)


def test_fact_and_mart(spark):
    orders = orders_batch(spark, SF_SMALL)  # all orders
    late = _dim(spark, [CUT2, CUT1])
    assert lookup_current(orders, late).count() == 2029  # orders fan out
    dim12 = _dim(spark, [CUT1, CUT2])
    mart = sales_mart(lookup_current(orders, dim12), dim12)
    assert mart.count() == 1464
    assert mart.where("state_id IS NULL").count() == 266
    assert mart.agg(F.sum("num_orders")).first()[0] == 1500
