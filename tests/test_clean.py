import datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Observation, functions as F

from lakemart import functions as fn
from lakemart.operators import clean, dedup, enrich
from lakemart.operators.quality import split_rejects
from lakemart.operators.rules import entity_rules
from lakemart.schemas import SCHEMAS


def frame(spark, entity, rows):
    names = SCHEMAS[entity].fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], SCHEMAS[entity])


def test_customers(spark):
    out = clean.clean_customers(frame(spark, "customers", [
        {"customer_id": "a", "customer_unique_id": "p", "customer_city": "  são  paulo ", "customer_state": " sp",
         "customer_zip_code_prefix": " 01000 "},
        {"customer_id": None, "customer_unique_id": "p"}, {"customer_id": "b", "customer_unique_id": None},
        {"customer_id": "a", "customer_unique_id": "q"},
    ])).collect()
    assert [tuple(r) for r in out] == [("a", "p", "01000", "São  Paulo", "SP")]


def order(i, **kw):
    return {"order_id": i, "customer_id": "c" + i, "order_status": " Delivered ",
            "order_purchase_timestamp": "2020-01-31 23:59:59", **kw}


def test_orders(spark):
    raw = frame(spark, "orders", [
        order("early", order_delivered_customer_date="2020-02-09 00:00:01", order_estimated_delivery_date="2020-02-10 00:00:00"),
        order("day", order_delivered_customer_date="2020-02-10 23:00:00", order_estimated_delivery_date="2020-02-10 00:00:00"),
        order("late", order_delivered_customer_date="2020-02-11 00:00:00", order_estimated_delivery_date="2020-02-10 23:59:59"),
        order("open", order_status="canceled"),
        order("bad", order_purchase_timestamp="31/01/2020"), order("nobody", customer_id=None),
        order("nostatus", order_status=None),
    ])
    rows = {r.order_id: r for r in clean.clean_orders(raw).collect()}
    assert set(rows) == {"early", "day", "late", "open", "nostatus"}
    assert [rows[k].delivery_delay_days for k in ("early", "day", "late", "open")] == [-1, 0, 1, None]
    assert [rows[k].is_late_delivery for k in ("early", "day", "late", "open")] == [False, False, True, False]
    assert rows["day"].delivery_duration_days == 10 and rows["open"].delivery_duration_days is None
    assert rows["open"].is_cancelled and not rows["open"].is_delivered
    assert rows["nostatus"].is_delivered is None and rows["nostatus"].is_cancelled is None
    assert rows["day"].purchase_year_month == "2020-01" and rows["day"].purchase_date == datetime.date(2020, 1, 31)


def test_items_keep_zero_and_drop_negative(spark):
    rows = [{"order_id": "o", "order_item_id": i, "price": p, "freight_value": f}
            for i, (p, f) in enumerate([(0.0, 0.0), (-0.01, 1.0), (1.0, -0.01), (None, 1.0), (1.0, None), (2.5, 0.25)])]
    out = {r.order_item_id: float(r.total_item_amount) for r in clean.clean_order_items(frame(spark, "order_items", rows)).collect()}
    assert out == {0: 0.0, 5: 2.75}


def test_products(spark):
    products = frame(spark, "products", [
        {"product_id": "1", "product_category_name": " Beleza ", "product_weight_g": 0.0, "product_length_cm": 2.0,
         "product_height_cm": 3.0, "product_width_cm": 4.0},
        {"product_id": "2", "product_category_name": "outro", "product_weight_g": -5.0, "product_length_cm": 2.0},
        {"product_id": "3"},
    ])
    names = frame(spark, "category_translation", [
        {"product_category_name": "BELEZA", "product_category_name_english": " health "},
        {"product_category_name": "beleza ", "product_category_name_english": "beauty"}])
    rows = {r.product_id: r for r in clean.clean_products(products, names).collect()}
    assert rows["1"].product_category_name_en == "beauty" and rows["1"].product_volume_cm3 == 24.0
    assert rows["1"].product_weight_g == 0.0
    assert rows["2"].product_category_name_en is None and rows["2"].has_category and rows["2"].product_weight_g is None
    assert rows["2"].product_volume_cm3 is None and not rows["3"].has_category
    bands = {r.product_id: r for r in enrich.with_product_bands(clean.clean_products(products, names)).collect()}
    assert bands["2"].product_category_name_en == "unknown" and bands["2"].product_weight_band == "unknown"
    assert bands["1"].has_complete_dimensions and not bands["3"].has_complete_dimensions


def test_reviews(spark):
    rows = [{"review_id": str(i), "order_id": "o", "review_score": s, "review_comment_message": m}
            for i, (s, m) in enumerate([(0, None), (1, "  "), (2, " x "), (3, ""), (5, None), (6, None), (None, None)])]
    out = {r.review_id: (r.review_score_category, r.review_comment_message, r.has_review_message)
           for r in clean.clean_reviews(frame(spark, "reviews", rows)).collect()}
    assert out == {"1": ("Negative", None, False), "2": ("Negative", "x", True), "3": ("Neutral", None, False),
                   "4": ("Positive", None, False)}


def test_payments(spark):
    rows = [{"order_id": "o", "payment_sequential": i, "payment_type": " VOUCHER ", "payment_value": v, "payment_installments": n}
            for i, (v, n) in enumerate([(0.0, 0), (-1.0, 1), (1.0, -1), (1.0, None), (2.0, 3)])]
    cleaned = clean.clean_payments(frame(spark, "payments", rows))
    assert {r.payment_sequential for r in cleaned.collect()} == {0, 4}
    summary = enrich.payment_summary(cleaned).first()
    assert (float(summary.payment_value), summary.payment_methods, summary.max_installments) == (2.0, 1, 3)
    assert summary.is_split_payment and summary.has_voucher


def test_geolocation_bounds_and_median(spark):
    rows = [{"geolocation_zip_code_prefix": "1", "geolocation_lat": lat, "geolocation_lng": lng, "geolocation_city": c,
             "geolocation_state": "sp"}
            for lat, lng, c in [(90.0, 180.0, "a"), (-90.0, -180.0, "a"), (90.1, 0.0, "a"), (0.0, 180.1, "a"),
                                (None, 0.0, "a"), (0.0, 1.0, "b"), (10.0, 2.0, "b")]]
    raw = frame(spark, "geolocation", rows)
    out = {r.city: r for r in clean.clean_geolocation(raw).collect()}
    assert out["A"].coordinate_count == 2 and out["A"].lat == 0.0 and out["B"].lat == 5.0
    one = enrich.geolocation_by_zip(raw).first()
    assert (one.latitude, one.longitude, one.city, one.coordinate_count) == (5.0, 1.5, "A", 4)


def test_transactions_latest_by_parsed_time(spark):
    rows = [("1", "ana", "x", 1.0, "2024-01-02 00:00:00"), ("1", "ana", "x", 2.0, "2024-01-10 00:00:00"),
            ("1", "ana", "x", 9.0, "not a date"), ("2", "bob", "y", 5.0, "2024-01-01 00:00:00"),
            ("2", "bob", "y", 7.0, "2024-01-01 00:00:00")]
    out = {r.id_transaction: (r.client_name, r.price) for r in
           clean.clean_transactions(spark.createDataFrame(rows, SCHEMAS["transactions"])).collect()}
    assert out == {"1": ("ANA", 2.0), "2": ("BOB", 7.0)}


def test_exact_duplicates_are_counted(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (2, "b"), (2, "b"), (2, "b")], "k int, v string")
    seen = Observation()
    assert dedup.drop_exact_duplicates(df, seen).count() == 3
    assert seen.get == {"source_rows": 6, "target_rows": 3, "duplicate_rows": 3}


def test_dedup_limits_each_map_task_before_the_shuffle(spark):
    df = spark.range(0, 100_000, 1, 4).select((F.col("id") % 3).alias("k"), "id")
    plan = dedup.dedup(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


keyed = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(-2, 2))), max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keyed)
def test_dedup_keys_unique_and_survivor_is_a_row(spark, rows):
    df = spark.createDataFrame(rows, "k int, v int")
    out = [tuple(r) for r in dedup.dedup(df, ["k"]).collect()]
    assert sorted(str(k) for k, _ in out) == sorted({str(k) for k, _ in rows})
    assert set(out) <= set(rows)


def test_dedup_of_some_columns_keeps_the_same_survivors(spark):
    rows = [(k % 5 if k % 7 else None, k % 3, k % 2 or None, f"t{k % 11}", k % 4) for k in range(80)]
    df = spark.createDataFrame(rows, "k int, a int, b int, text string, z int")
    for columns in (["k", "a"], ["a", "b"], ["k", "text"], ["z", "k"], ["k"], ["b"]):
        for order in (None, [F.col("b").desc_nulls_last()]):
            whole = dedup.dedup(df, ["k"], order).select(*columns)
            assert sorted(map(str, whole.collect())) == sorted(map(str, dedup.dedup(df, ["k"], order, columns).collect()))


def test_scores_are_those_of_the_reviews(spark):
    rows = [{"review_id": f"r{k % 6}", "order_id": f"o{k % 4}" if k % 9 else None, "review_score": k % 7,
             "review_comment_message": f"m{-k}"} for k in range(40)]
    raw = frame(spark, "reviews", rows)
    both = [df.select("order_id", "review_score").collect() for df in (clean.clean_reviews(raw), clean.clean_scores(raw))]
    assert both[0] and sorted(both[0]) == sorted(both[1])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from("ab")), st.integers(0, 2),
                          st.one_of(st.none(), st.floats(-2, 2))), max_size=12))
def test_source_is_valid_rejected_and_duplicates(spark, rows):
    raw = frame(spark, "order_items", [
        {"order_id": o, "order_item_id": i, "price": p, "freight_value": 1.0} for o, i, p in rows])
    valid, rejected = split_rejects(raw, entity_rules("order_items"))
    kept = clean.clean_order_items(raw).count()
    duplicates = valid.count() - valid.select("order_id", "order_item_id").distinct().count()
    assert len(rows) == kept + rejected.count() + duplicates


def test_columns(spark):
    row = spark.createDataFrame([("São Tomé", "", None, 1.0, 0.0)], "a string, b string, c string, x double, y double").select(
        fn.accents_removed("a"), fn.ratio("x", "y"), fn.ratio("x", F.lit(4)), fn.valid_zip(F.lit(" 0123 ")),
        fn.valid_zip(F.lit("12a")), fn.digest("a", "c"), (fn.row_hash("b") == fn.row_hash("c")),
        fn.region_of(F.lit("SP"), {"SP": "Southeast", "AM": "North"}), fn.region_of(F.lit("XX"), {"SP": "Southeast"}),
        (fn.row_hash("a", "b") == fn.row_hash(F.concat("a", "b"), F.lit("")))).first()
    assert tuple(row) == ("Sao Tome", None, 0.25, True, False, None, False, "Southeast", "Unknown", True)


@pytest.mark.parametrize("value, expected", [(1, "Negative"), (2, "Negative"), (3, "Neutral"), (4, "Positive")])
def test_score_category(spark, value, expected):
    assert spark.range(1).select(fn.score_category(F.lit(value))).first()[0] == expected


def test_amounts_up_to_the_money_type_are_kept(spark):
    from lakemart.operators import quality
    from lakemart.operators.rules import entity_rules
    values = [0.0, 5e15, 9_999_999_999_999_998.0, 1e16, float("nan"), float("inf"), -1.0]
    raw = frame(spark, "order_items", [{"order_id": str(i), "order_item_id": 1, "price": v, "freight_value": 0.0} for i, v in enumerate(values)])
    assert {int(r.order_id): float(r.price) for r in clean.clean_order_items(raw).collect()} == dict(enumerate(values[:3]))
    _, rejected = quality.split_rejects(raw, entity_rules("order_items"))
    named = {int(r.order_id): r._validation_errors for r in rejected.collect()}
    assert named == {**{i: ["price_representable"] for i in (3, 4, 5)}, 6: ["price_not_negative"]}


def test_accents_of_latin_1_and_extended_a(spark):
    words = {"São Tomé": "Sao Tome", "ÝŁódź Škoda ø": "YLodz Skoda o", "Straße Æ œ Þ": "Strasse AE oe TH", "e\u0301te\u0301": "ete",
             "ĞİŞ ığş ŕ ţ": "GIS igs r t", "plain 中": "plain 中", "": ""}
    df = spark.createDataFrame([(w,) for w in words], "w string")
    assert {r.w: r.plain for r in df.select("w", fn.accents_removed("w").alias("plain")).collect()} == words
