"""Print the executed (final AQE) plans of the core operators.

    python tools/explain.py [sf_dir] [operator ...]

Operators: batch scd2 lookup lookup_shuffle mart upsert_pass unique latest
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from medallion.operators.checks import check_frame, unique
    from medallion.operators.latest import latest_partition
    from medallion.operators.lookup import lookup_current
    from medallion.operators.mart import sales_mart
    from medallion.operators.publish import replace_partition
    from medallion.operators.scd2 import scd2_changes
    from medallion.plans import queries as Q
    from medallion.session import build_session
    from medallion.sources.testdata import customer_batch, read_table

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    which = sys.argv[2:] or ["batch", "scd2", "lookup", "lookup_shuffle", "mart", "unique", "latest"]
    spark = build_session("local[8]")
    lake = Q.Lake(spark, "explain")
    dim = Q._dim_version(spark, sf, lake, [1, 2])
    orders = Q._orders(spark, sf, 2)
    frames = {
        "batch": lambda: customer_batch(spark, sf, Q.BATCH_CUTS[1]),
        "scd2": lambda: scd2_changes(Q._source(spark, sf, 2), dim.frame),
        "lookup": lambda: lookup_current(orders, dim.frame, broadcast=Q._lookup_fits(dim)),
        "lookup_shuffle": lambda: lookup_current(orders, dim.frame, broadcast=False),
        "mart": lambda: sales_mart(
            lookup_current(orders, dim.frame, broadcast=Q._lookup_fits(dim)), dim.frame,
            broadcast=Q._mart_fits(dim),
        ),
        "unique": lambda: check_frame(read_table(spark, sf, "documents"), [unique("text")], "documents"),
    }
    if "latest" in which:
        for i, b in enumerate((1, 2)):
            mart = sales_mart(lookup_current(Q._orders(spark, sf, b), dim.frame), dim.frame)
            replace_partition(spark, lake.t("sales_mart"), mart, Q.RUN_PARTITIONS[i])
        frames["latest"] = lambda: latest_partition(spark, lake.t("sales_mart"))
    for name in which:
        df = frames[name]()
        df.collect()  # run this DataFrame itself, so explain shows AQE's final plan
        print(f"\n######## {name}")
        df.explain("formatted")


if __name__ == "__main__":
    main()
