import random
from statistics import median

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.plans import coupon as K

COLUMNS = ("customer_id", "item_id", "quantity", "price_before_discount", "discount", "coupon_discount", "coupon_used", "dayofmonth", "dayofweek", "month")


def test_campaign_days(make):
    df = make("campaign_id int, start_date string, end_date string", (7, "2023-02-27", "2023-03-02"), (8, "2024-02-27", "2024-03-02"), (9, "2023-12-31", "2023-12-31"))
    df = df.withColumns({c: F.col(c).cast("timestamp") for c in ("start_date", "end_date")})
    out = K.campaign_days(df)
    assert out.columns == ["campaign_id", "campaign_duration"]
    assert {r[0]: r[1] for r in out.collect()} == {7: 3, 8: 4, 9: 0}


def test_unit_prices(make):
    df = make("selling_price double, quantity int, other_discount double, coupon_discount double", (84.0, 4, 6.0, 2.0), (9.0, 1, 0.0, 0.0), (55.0, 5, 12.5, 0.0))
    out = K.with_unit_prices(df).select("price_after_discount", "discount", "price_before_discount", "coupon_used")
    assert [tuple(r) for r in out.collect()] == [(21.0, 1.5, 19.5, 1), (9.0, 0.0, 9.0, 0), (11.0, 2.5, 8.5, 0)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    return [
        (rng.randint(1, 3), rng.choice([61, 62, 63, 64]), rng.randint(1, 6), rng.randint(4, 40) / 2, rng.randint(0, 8) / 4, rng.choice([0.0, 0.5, 2.5]), rng.randint(0, 1), rng.randint(1, 31), rng.randint(1, 7), rng.randint(1, 12))
        for _ in range(29)
    ]


@pytest.fixture
def transactions(make, rows):
    return make(
        "customer_id int, item_id int, quantity int, price_before_discount double, discount double, coupon_discount double, "
        "coupon_used int, dayofmonth int, dayofweek int, month int", *rows,
    )


def most_common(values):
    """The lowest of the values that occur most often."""
    return min(values, key=lambda v: (-values.count(v), v))


@pytest.mark.parametrize("hot_rows", [500_000, 0])
def test_customer_features(transactions, rows, hot_rows):
    found = {r["customer_id"]: r.asDict() for r in K.customer_features(transactions, hot_rows=hot_rows).collect()}
    assert found.keys() == {r[0] for r in rows}
    for customer, got in found.items():
        own = {c: [r[i] for r in rows if r[0] == customer] for i, c in enumerate(COLUMNS)}
        want = {"no_of_unique_items": len(set(own["item_id"])), "no_of_items": sum(own["item_id"]), "total_coupon_used": sum(own["coupon_used"])}
        for name, column in (("quantity", "quantity"), ("price", "price_before_discount"), ("discount", "discount"), ("coupon_discount", "coupon_discount")):
            q1, q3 = np.percentile(own[column], [25, 75])
            want |= {f"median_{name}": median(own[column]), f"q1_{name}": q1, f"q3_{name}": q3}
        want |= {f"mode_{c}": most_common(own[c]) for c in ("dayofmonth", "dayofweek", "month")}
        assert set(got) == {"customer_id", *("customer_" + n for n in want)}
        assert {n: got["customer_" + n] for n in want} == pytest.approx(want)


@pytest.mark.parametrize("hot_rows", [500_000, 0])
def test_coupon_features(make, transactions, rows, hot_rows):
    items = [(5, 61, "oak", "l", "tea"), (5, 62, "elm", "e", "tea"), (5, 63, "elm", "l", "rice"), (6, 64, "ash", "e", "soap"), (6, 61, "oak", "e", "soap")]
    frame = make("coupon_id int, item_id int, brand string, brand_type string, category string", *items)
    found = {r["coupon_id"]: r.asDict() for r in K.coupon_features(frame, transactions, hot_rows=hot_rows).collect()}
    for coupon, got in found.items():
        joined = [(i, dict(zip(COLUMNS, r))) for i in items if i[0] == coupon for r in rows if r[1] == i[1]]
        own = {c: [r[c] for _, r in joined] for c in COLUMNS}
        want = {
            "no_of_item": len({i[1] for i, _ in joined}), "no_of_customers": len(set(own["customer_id"])), "no_of_coupon_used": sum(own["coupon_used"]),
            "mode_brand": most_common([i[2] for i, _ in joined]), "mode_brand_type": most_common([i[3] for i, _ in joined]), "mode_category": most_common([i[4] for i, _ in joined]),
        }
        for name, column in (("quantity", "quantity"), ("price", "price_before_discount"), ("other_discount", "discount"), ("coupon_discount", "coupon_discount")):
            want["q1_" + name], want["q3_" + name] = np.percentile(own[column], [25, 75])
            if name != "quantity":
                want["median_" + name] = median(own[column])
        for name, value in want.items():
            assert got["coupon_" + name] == (pytest.approx(value) if not isinstance(value, str) else value), name


def test_item_without_transactions(make, transactions):
    items = make("coupon_id int, item_id int, brand string, brand_type string, category string", (9, 99, "a", "x", "c"))
    r = K.coupon_features(items, transactions).first()
    assert (r["coupon_no_of_item"], r["coupon_no_of_customers"], r["coupon_median_price"], r["coupon_no_of_coupon_used"]) == (1, 1, None, 0)
