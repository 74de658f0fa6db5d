"""Row rules per entity: name -> condition that must hold.

The cleaning functions filter by these and the reject split names the broken ones, so the
two cannot disagree. A null condition counts as broken.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lakemart.functions import parse_timestamp


#: The largest double that the money type holds.
LARGEST_AMOUNT = 9_999_999_999_999_998.0


def _present(*names: str) -> dict[str, Column]:
    return {f"{n}_present": F.col(n).isNotNull() for n in names}


def _amount(column: str, name: str) -> dict[str, Column]:
    """Not negative, and held by the money type (not-a-number is not). Compared as they come, so that the
    bounds reach the scan and no row is converted twice."""
    return {f"{name}_not_negative": F.col(column) >= 0, f"{name}_representable": F.col(column) <= LARGEST_AMOUNT}


def entity_rules(entity: str) -> dict[str, Column]:
    """Rules on the raw columns of one entity."""
    if entity == "customers":
        return _present("customer_id", "customer_unique_id")
    if entity == "orders":
        return {
            **_present("order_id", "customer_id"),
            "purchase_timestamp_valid": parse_timestamp("order_purchase_timestamp").isNotNull(),
        }
    if entity == "order_items":
        return {
            **_present("order_id", "order_item_id"),
            **_amount("price", "price"), **_amount("freight_value", "freight"),
        }
    if entity == "products":
        return _present("product_id")
    if entity == "sellers":
        return _present("seller_id")
    if entity == "payments":
        return {
            **_present("order_id"),
            **_amount("payment_value", "value"),
            "installments_not_negative": F.col("payment_installments") >= 0,
        }
    if entity == "reviews":
        return {**_present("review_id", "order_id"), "score_in_range": F.col("review_score").between(1, 5)}
    if entity == "geolocation":
        return {
            "latitude_in_range": F.col("geolocation_lat").between(-90, 90),
            "longitude_in_range": F.col("geolocation_lng").between(-180, 180),
        }
    if entity in ("category_translation", "transactions"):
        return {}
    raise KeyError(entity)


def all_hold(rules: dict[str, Column]) -> Column:
    return reduce(lambda a, b: a & b, rules.values())


def keep_valid(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Plain conjunction, so null checks and ranges reach the file scan."""
    return df.filter(all_hold(rules))


def broken_rules(rules: dict[str, Column]) -> Column:
    """Names of the rules a row breaks, as an array."""
    return F.array_compact(
        F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()])
    )
