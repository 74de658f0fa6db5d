"""Data-quality checks, reject split and reconciliation.

Every check returns rows of one result table. Row rules of a table are counted in one pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakemart.functions import on_or_after, ratio
from lakemart.operators.joins import missing_parents
from lakemart.operators.rules import all_hold, broken_rules
from lakemart.schemas import ORDER_STATUSES

#: Referential rules of the cleaned tables: child, parent, key.
REFERENCES = [
    ("orders", "customers", "customer_id"), ("order_items", "orders", "order_id"), ("order_items", "products", "product_id"),
    ("order_items", "sellers", "seller_id"), ("payments", "orders", "order_id"), ("reviews", "orders", "order_id"),
]


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _result(table: str | Column, rule: Column, rule_type: str) -> list[Column]:
    failed = F.col("rows_failed")
    return [
        (F.lit(table) if isinstance(table, str) else table).alias("table_name"), rule.alias("rule_name"), F.lit(rule_type).alias("rule_type"),
        F.col("rows_checked"), failed,
        (F.coalesce(ratio(failed, "rows_checked"), F.lit(0.0)) * 100).alias("failure_percentage"),
        F.when(failed == 0, "passed").otherwise("failed").alias("status"),
    ]


def check_rows(df: DataFrame, table: str, rules: dict[str, Column], rule_type: str) -> DataFrame:
    """Rows breaking each rule (null counts as broken), all rules in a single scan."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        F.array(*[
            F.struct(F.lit(name).alias("rule"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("rows_failed"))
            for name, ok in rules.items()]).alias("outcomes"),
    )
    return counts.select("rows_checked", F.inline("outcomes")).select(*_result(table, F.col("rule"), rule_type))


def check_unique(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Rows beyond the first of their key. Counting per key is reduced before the shuffle."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    counts = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_checked"),
                         F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("rows_failed"))
    return counts.select(*_result(table, F.lit("unique_" + "_".join(keys)), "uniqueness"))


def check_reference(child: DataFrame, parent: DataFrame, table: str, parent_table: str, key: str) -> DataFrame:
    """Child rows whose key is not in the parent; null keys are left to the not-null rules."""
    missing = missing_parents(child, parent, key).agg(F.coalesce(F.sum("child_rows"), F.lit(0)).alias("rows_failed"))
    checked = child.agg(F.count(key).alias("rows_checked"))
    both = missing.select("rows_failed", checked.scalar().alias("rows_checked"))
    return both.select(*_result(table, F.lit(f"{key}_in_{parent_table}"), "referential"))


def check_references(tables: dict[str, DataFrame], rules: list[tuple[str, str, str]]) -> DataFrame:
    """All referential rules (child, parent, key) from one aggregate.

    Every table is read once: its rows give a key for each rule they take part in, tagged with their
    role. Counted per key, with the map side's help, a key holds the child rows of every rule and
    whether a parent has it, so one shuffle serves all tables and rules. Null keys are left to the
    not-null rules.
    """
    families = list(dict.fromkeys((parent, key) for _, parent, key in rules))
    tagged = []
    for name, df in tables.items():
        roles = [(families.index((parent, key)), key, i) for i, (child, parent, key) in enumerate(rules) if child == name]
        roles += [(f, key, -1) for f, (parent, key) in enumerate(families) if parent == name]
        if roles:
            tags = [F.struct(F.lit(f).alias("family"), F.col(key).cast("string").alias("key"), F.lit(role).alias("role")) for f, key, role in roles]
            tagged.append(df.select(F.inline(F.array(*tags))).filter(F.col("key").isNotNull()))
    counts = [F.count_if(F.col("role") == i).alias(f"n{i}") for i in range(len(rules))]
    per_key = union_all(tagged).groupBy("family", "key").agg(F.max(F.col("role") == -1).alias("known"), *counts)
    zero = F.lit(0).cast("bigint")
    outcomes = per_key.agg(F.array(*[
        F.struct(F.lit(child).alias("table"), F.lit(f"{key}_in_{parent}").alias("rule"),
                 F.coalesce(F.sum(f"n{i}"), zero).alias("rows_checked"),
                 F.coalesce(F.sum(F.when(~F.col("known"), F.col(f"n{i}"))), zero).alias("rows_failed"))
        for i, (child, parent, key) in enumerate(rules)]).alias("outcomes"))
    return outcomes.select(F.inline("outcomes")).select(*_result(F.col("table"), F.col("rule"), "referential"))


def time_rules() -> dict[str, Column]:
    """Order of an order's steps; an unknown time breaks nothing."""
    return {
        "approved_after_purchase": on_or_after("order_approved_at", "order_purchase_timestamp"),
        "carrier_after_approval": on_or_after("order_delivered_carrier_date", "order_approved_at"),
        "delivered_after_carrier": on_or_after("order_delivered_customer_date", "order_delivered_carrier_date"),
        "delivered_after_purchase": on_or_after("order_delivered_customer_date", "order_purchase_timestamp"),
        "estimate_after_purchase": on_or_after("order_estimated_delivery_date", "order_purchase_timestamp"),
    }


def flag_time_violations(orders: DataFrame) -> DataFrame:
    """Orders with the names of broken time rules; nothing is removed."""
    return orders.withColumn("time_violations", broken_rules(time_rules())).withColumn(
        "has_time_violation", F.size("time_violations") > 0)


def status_rule() -> dict[str, Column]:
    return {"status_allowed": F.lower(F.trim("order_status")).isin(ORDER_STATUSES)}


def stamp(results: DataFrame, run_id: str, checked_at, details: str | None = None) -> DataFrame:
    """Add run columns before results are appended to the quality table."""
    return results.withColumns({
        "run_id": F.lit(run_id), "checked_at": F.lit(checked_at).cast("timestamp"),
        "details": F.lit(details).cast("string")})


RESULT_COLUMNS = ["run_id", "table_name", "rule_name", "rule_type", "checked_at", "rows_checked", "rows_failed",
                  "failure_percentage", "status", "details"]


def append_results(results: DataFrame, table: str) -> None:
    """Append stamped results to the quality table, creating it if needed."""
    results.select(*RESULT_COLUMNS).write.mode("append").saveAsTable(table)


def check_reject_rate(reconciled: DataFrame, max_percentage: float = 5.0) -> DataFrame:
    """Tables of :func:`reconcile` with their rejected share and whether it is acceptable."""
    percentage = F.coalesce(ratio("rejected_rows", "source_rows"), F.lit(0.0)) * 100
    return reconciled.select("table_name", "source_rows", "rejected_rows", percentage.alias("rejected_percentage"),
                             F.when(percentage <= max_percentage, "passed").otherwise("failed").alias("status"))


def split_rejects(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with ``_validation_errors`` naming the broken rules."""
    marked = df.withColumn("_validation_errors", broken_rules(rules))
    return (df.filter(all_hold(rules)), marked.filter(F.size("_validation_errors") > 0))


def reconcile(raw: DataFrame, rules: dict[str, Column], keys: list[str], table: str) -> DataFrame:
    """source = valid + rejected + duplicates, from one aggregate by key."""
    ok = F.coalesce(all_hold(rules), F.lit(False))
    per_key = raw.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("valid"))
    # Expressions in keys and rules see the raw columns, so both come from the same scan.
    totals = per_key.agg(
        F.sum("n").alias("source_rows"),
        F.count_if(F.col("valid") > 0).alias("target_rows"),
        F.sum(F.col("n") - F.col("valid")).alias("rejected_rows"),
        F.sum(F.greatest(F.col("valid") - 1, F.lit(0))).alias("duplicate_rows"),
    )
    balanced = F.col("source_rows") == F.col("target_rows") + F.col("rejected_rows") + F.col("duplicate_rows")
    return totals.select(F.lit(table).alias("table_name"), "*", balanced.alias("is_balanced"))


def reconcile_written(raw: DataFrame, rules, keys: list[str], table: str, written: DataFrame) -> DataFrame:
    """As :func:`reconcile`, with the target counted in the table that was written."""
    expected = reconcile(raw, rules, keys, table).withColumnRenamed("target_rows", "valid_rows")
    actual = written.agg(F.count(F.lit(1))).scalar()
    return expected.withColumn("target_rows", actual).withColumn(
        "is_balanced", F.col("is_balanced") & (F.col("target_rows") == F.col("valid_rows")))


def compare_totals(name: str, left: DataFrame, left_value: Column, right: DataFrame, right_value: Column) -> DataFrame:
    """One row: two totals as exact decimals, their difference and whether they agree."""
    total = "decimal(38,2)"
    pair = left.agg(F.coalesce(left_value.cast(total), F.lit(0).cast(total)).alias("left_value")).withColumn(
        "right_value", right.agg(F.coalesce(right_value.cast(total), F.lit(0).cast(total))).scalar())
    difference = F.col("left_value") - F.col("right_value")
    return pair.select(F.lit(name).alias("check_name"), "left_value", "right_value", difference.alias("difference"),
                       F.when(difference == 0, "passed").otherwise("failed").alias("status"))


def conservation(daily: DataFrame, marts: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Revenue and orders of every mart against the daily sales: none may lose or double an order.

    ``marts`` maps a name to (mart, revenue column, orders column). The rows of all marts are summed in
    one grouped pass; what is compared afterwards has a row per mart.
    """
    total = "decimal(38,2)"
    marts = {"daily": (daily, "total_revenue", "order_count"), **marts}
    rows = union_all([df.select(F.lit(name).alias("mart"), F.col(revenue).cast(total).alias("revenue"), F.col(orders).cast(total).alias("orders"))
                      for name, (df, revenue, orders) in marts.items()])
    sums = rows.groupBy("mart").agg(*[F.coalesce(F.sum(c).cast(total), F.lit(0).cast(total)).alias(c) for c in ("revenue", "orders")])
    every = Window.partitionBy(F.lit(0))
    expected = {c: F.max(F.when(F.col("mart") == "daily", F.col(c))).over(every) for c in ("revenue", "orders")}
    checks = F.explode(F.array(
        F.struct(F.concat("mart", F.lit("_revenue_equals_daily")).alias("check_name"), F.col("revenue").alias("left_value"),
                 F.coalesce("expected_revenue", F.lit(0).cast(total)).alias("right_value")),
        F.struct(F.concat("mart", F.lit("_orders_equal_daily")).alias("check_name"), F.col("orders").alias("left_value"),
                 F.coalesce("expected_orders", F.lit(0).cast(total)).alias("right_value"))))
    compared = sums.withColumns({f"expected_{c}": e for c, e in expected.items()}).filter("mart <> 'daily'").select(checks.alias("c")).select("c.*")
    difference = F.col("left_value") - F.col("right_value")
    return compared.select("*", difference.alias("difference"), F.when(difference == 0, "passed").otherwise("failed").alias("status"))


def reconcile_gold(daily: DataFrame, monthly: DataFrame, facts: DataFrame, fact_orders: DataFrame,
                   dim_customer: DataFrame, marts: dict[str, tuple[DataFrame, str, str]] | None = None) -> DataFrame:
    """Marts against the facts they come from, and ``marts`` against the daily sales (:func:`conservation`)."""
    with_items = fact_orders.filter(F.col("item_count") > 0)
    negative = F.sum(F.when(F.col("total_revenue") < 0, 1).otherwise(0))
    known_people = with_items.filter(F.col("customer_key").isNotNull())
    return union_all([
        compare_totals("daily_gross_equals_fact", daily, F.sum("gross_revenue"), facts, F.sum("item_price")),
        compare_totals("monthly_total_equals_daily", monthly, F.sum("total_revenue"), daily, F.sum("total_revenue")),
        compare_totals("daily_orders_equal_fact", daily, F.sum("order_count"), with_items, F.count(F.lit(1))),
        compare_totals("dimension_orders_equal_fact", dim_customer, F.sum("total_orders"), known_people, F.count(F.lit(1))),
        compare_totals("no_negative_revenue", daily, negative, daily.limit(0), F.count(F.lit(1))),
        *([conservation(daily, marts)] if marts else []),
    ])


def missing_dimension_keys(facts: DataFrame, dimension: DataFrame, key: str, dimension_key: str | None = None) -> DataFrame:
    """Fact keys without a dimension row."""
    return missing_parents(facts, dimension, key, dimension_key)
