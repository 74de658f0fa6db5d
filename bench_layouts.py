"""Compare table layouts and join settings on replicated order data. Prints one JSON line.

Settings: BENCH_SF_DIR, BENCH_CPUS, BENCH_COPIES (replication of the orders and items, default 3).
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def timed(run, times=2):
    best = None
    for _ in range(times):
        start = time.perf_counter()
        run()
        spent = time.perf_counter() - start
        best = spent if best is None else min(best, spent)
    return round(best, 3)


def main():
    from pyspark.sql import functions as F

    from lakemart.operators import clean, sales, scale, upsert
    from lakemart.session import build_session, work_path
    from lakemart.sources import tables
    from lakemart.sources.adapters import RawEntities

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    copies = int(os.environ.get("BENCH_COPIES", "3"))
    spark = build_session("lakemart-layouts", master=f"local[{cpus}]", shuffle_partitions=int(cpus), **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    tables.create_database(spark, "layouts")
    raw = RawEntities(spark, folder)
    orders = clean.clean_orders(scale.replicate_orders(raw["orders"], copies))
    items = clean.clean_order_items(scale.replicate_items(raw["order_items"], copies))
    products = clean.clean_products(raw["products"], raw["category_translation"])
    reviews = clean.clean_reviews(raw["reviews"])

    def keep(df, name, **layout):
        tables.write_table(df, f"layouts.{name}", path=work_path(spark, name), **layout)
        return spark.table(f"layouts.{name}")

    out = {}
    o = keep(orders, "orders_plain")
    o_sorted = keep(orders, "orders_sorted", sort_by=["order_purchase_timestamp"])
    o_parts = keep(orders, "orders_parts", partition_by=["purchase_year_month"], sort_by=["order_purchase_timestamp"])
    i, p, r = keep(items, "items"), keep(products, "products"), keep(reviews, "reviews")

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    month = F.col("purchase_year_month") == "1998-03"
    stamp = F.col("order_purchase_timestamp").between("1998-03-01", "1998-03-31 23:59:59")
    out["month_unpartitioned"] = timed(lambda: noop(o.filter(month)))
    out["month_partitioned"] = timed(lambda: noop(o_parts.filter(month)))
    out["range_unsorted"] = timed(lambda: noop(o.filter(stamp)))
    out["range_sorted"] = timed(lambda: noop(o_sorted.filter(stamp)))

    def category(source=None):
        noop(sales.agg_category_performance(source if source is not None else o_parts, i, p, r))

    out["category_broadcast_products"] = timed(category)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    out["category_shuffle_products"] = timed(category)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    out["category_without_aqe"] = timed(category)
    spark.conf.set("spark.sql.adaptive.enabled", "true")

    months = upsert.affected_months(o_parts.filter(F.col("purchase_year_month") >= "2001-06"))
    out["refresh_full"] = timed(category)
    out["refresh_affected_months"] = timed(lambda: noop(
        upsert.refresh_months(sales.agg_category_performance, o_parts, i, p, r, months=months)))

    small, large = work_path(spark, "many-files"), work_path(spark, "few-files")
    i.repartition(200).write.parquet(small)
    tables.compact_folder(spark, small, large)
    out["scan_200_files"] = timed(lambda: noop(spark.read.parquet(small)))
    out["scan_compacted"] = timed(lambda: noop(spark.read.parquet(large)))
    print(json.dumps({"metric": "layouts", "unit": "sec", "copies": copies, "cases": out}))
    spark.sql("DROP DATABASE layouts CASCADE")
    spark.stop()


if __name__ == "__main__":
    main()
