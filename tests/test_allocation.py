"""Portfolio audit against known slacks and outputs."""

import pytest

from lakeloom.operators import allocation as A

# bought stocks of the 20-stock example: share, risk flag, region
BOUGHT = {
    "brewery": (0.3, 1, "LAC"), "highways": (0.01, 0, "LAC"), "cars": (0.14, 0, "EMEA"),
    "software": (0.06, 0, "NA"), "communication": (0.3, 0, "EMEA"), "analytics": (0.19, 0, "NA"),
}


def got(df, *cols):
    return [tuple(r) for r in (df.select(*cols) if cols else df).collect()]


def test_expected_return_and_lookups(make):
    stocks = make("name string, is_risky int, region string, industry string", ("a", 0, "EMEA", "IT"), ("b", 1, "LAC", "FINANCE"))
    regions = make("region string, region_index double", ("EMEA", 1.1), ("LAC", 1.5))
    industries = make("industry string, avg_return int", ("IT", 10), ("FINANCE", 30))
    out = A.model_table(stocks, regions, industries)
    assert out.columns == ["name", "region", "is_risky", "expected_return"]
    assert {r["name"]: r["expected_return"] for r in out.collect()} == {"a": pytest.approx(11.0), "b": pytest.approx(45.0)}


def solution(make):
    rows = [(n, f, 1, risky, region, 10.0) for n, (f, risky, region) in BOUGHT.items()] + [("treasury", 0.0, 0, 0, "NA", 5.0)]
    return make("name string, fraction double, buy int, is_risky int, region string, expected_return double", *rows)


def test_slack_signs(make):
    slack = {(r["constraint_name"], r["entity"]): r["slack"] for r in A.constraint_slack(solution(make)).collect()}
    assert slack[("tie_buy_and_fraction_lb", "highways")] == pytest.approx(0.29)
    assert slack[("tie_buy_and_fraction_ub", "brewery")] == pytest.approx(-0.29)
    assert slack[("tie_buy_and_fraction_lb", "treasury")] == 0
    assert slack[("max_number_stocks", "all")] == 2
    assert slack[("max_number_risky_sum", "all")] == 2
    assert slack[("max_fraction_risky", "all")] == pytest.approx(-0.05)
    assert slack[("min_fraction_per_region", "EMEA")] == pytest.approx(-0.24)
    assert slack[("min_number_per_region", "NA")] == 0
    assert slack[("invest_all", "all")] == pytest.approx(0, abs=1e-9)


def test_switched_off_constraints(make):
    off = A.Limits(max_number_risky="off", min_number_per_region="off")
    names = {r["constraint_name"] for r in A.constraint_slack(solution(make), off).collect()}
    assert "max_number_risky_sum" not in names and "min_number_per_region" not in names


def test_objective_and_penalty(make):
    limits = A.Limits(max_risky_stocks=0, max_number_risky="soft", min_stocks_per_region=3)
    r = A.objective(solution(make), limits, risky_weight=0.5, region_weight=0.1).first()
    assert r["expected_return"] == pytest.approx(10.0)
    assert r["penalty"] == pytest.approx(0.5 + 3 * 0.1) and r["objective"] == pytest.approx(10.0 - 0.8)
    assert A.objective(solution(make)).first()["penalty"] == 0


def test_feasible_two_stock_allocation(make):
    df = make(
        "name string, fraction double, buy int, is_risky int, region string, expected_return double",
        ("treasury", 0.9, 1, 0, "EU", 12.0), ("hardware", 0.1, 1, 0, "NA", 8.5),
    )
    limits = A.Limits(max_ratio_per_stock=1.0, min_ratio_per_region=0.1, min_stocks_per_region=1, min_ratio_per_stock=0.01)
    slack = A.region_slacks(df, limits).collect()
    assert all(r["min_fraction_per_region"] <= 1e-9 and r["min_number_per_region"] <= 0 for r in slack)


def test_merge_slacks(make):
    totals = A.totals_from_columns(
        make("invest_all double, max_number_risky_sum double, max_fraction_risky double, max_number_stocks double, off double",
             (5.551115123125783e-17, 1.0, 4.6, 2.0, None))
    )
    out = A.merge_slacks(
        make("name string, tie_buy_and_fraction_lb double", ("treasury", 1.0), ("cars", 2.11)),
        make("name string, tie_buy_and_fraction_ub double", ("treasury", 33.1), ("cars", -1.0)),
        make("region string, min_fraction_per_region double", ("EU", 0.3)),
        make("region string, min_number_per_region double", ("EU", 8.0)),
        totals,
    )
    assert out.columns == [
        "stock", "tie_buy_and_fraction_lb", "tie_buy_and_fraction_ub", "region", "min_fraction_per_region", "min_number_per_region",
        "constraint_name", "slack",
    ]
    n = None
    assert sorted(got(out), key=str) == sorted(
        [
            ("treasury", 1.0, 33.1, n, n, n, n, n), ("cars", 2.11, -1.0, n, n, n, n, n), (n, n, n, "EU", 0.3, 8.0, n, n),
            (n, n, n, n, n, n, "invest_all", 5.551115123125783e-17), (n, n, n, n, n, n, "max_number_risky_sum", 1.0),
            (n, n, n, n, n, n, "max_fraction_risky", 4.6), (n, n, n, n, n, n, "max_number_stocks", 2.0),
        ],
        key=str,
    )


def test_merge_slacks_without_region_numbers(make):
    one = lambda c: make(f"name string, {c} double", ("s", 0.0))
    out = A.merge_slacks(one("lb"), one("ub"), make("region string, f double", ("EU", 0.1)), None, make("constraint_name string, slack double", ("c", 1.0)))
    assert out.count() == 3 and "min_number_per_region" not in out.columns


def test_output_table(make):
    sol = make("name string, fraction double", ("cars", 0.145), ("oil", 0.0), ("bank", 0.125))
    model = make("name string, region string, is_risky int, expected_return double", ("cars", "NA", 0, 11.55), ("bank", "EMEA", 1, 5.5))
    stocks = make("name string, industry string", ("cars", "DURABLE GOODS"), ("bank", "FINANCIAL"))
    industries = make("industry string, avg_return int", ("DURABLE GOODS", 11), ("FINANCIAL", 5))
    regions = make("region string, region_index double", ("NA", 1.05), ("EMEA", 1.1))
    out = A.portfolio_output(sol, model, stocks, industries, regions)
    assert sorted(got(out)) == [
        ("bank", 12.0, 1, 5.5, "EMEA", 1.1, "FINANCIAL", 5), ("cars", 14.0, 0, 11.55, "NA", 1.05, "DURABLE GOODS", 11),
    ]
    assert sorted(got(A.describe_rows(out)))[0] == ("STOCK: bank REGION: EMEA RISKY: 1 PORTFOLIO: 12.0%",)
