import pytest

from lakeloom.operators import quality as Q
from lakeloom.operators import scaling as Z

CONFIG = {
    "steps": {"first": ["data.critical", "data.warning"]},
    "suites": {
        "data.critical": {
            "file": "one.csv",
            "expectations": [
                {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "A"}},
                {"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "B", "min_value": 0, "max_value": 100}},
            ],
        },
        "data.warning": {
            "file": "two.csv",
            "expectations": [
                {"expectation_type": "expect_table_row_count_to_be_between", "kwargs": {"min_value": 100, "max_value": 200}},
                {"expectation_type": "expect_column_values_to_not_be_in_set", "kwargs": {"column": "A", "value_set": [999, "some_random_str_value"]}},
            ],
        },
    },
}


def results(df, *checks, level="warning"):
    suite = Q.Suite("s", level, tuple(Q.Expectation(k, kw) for k, kw in checks))
    return [(r["success"], r["observed"], r["unexpected_count"]) for r in Q.validate(df, suite).collect()]


def test_suites_from_config(make):
    suites = Q.suites_from_config(CONFIG, "first")
    assert suites["data.critical"][0] == "one.csv" and suites["data.warning"][1].level == "warning"
    df = make("A int, B int", (1, 50), (2, 101))
    with pytest.raises(Q.CriticalQualityError, match="between"):
        Q.enforce(df, suites["data.critical"][1])
    assert [r["success"] for r in Q.enforce(df, suites["data.warning"][1])] == [False, True]


def test_unknown_arguments_are_refused():
    with pytest.raises(ValueError):
        Q.Expectation("column_sum_to_be_between", {"column": "a", "min": 1})
    with pytest.raises(ValueError):
        Q.Expectation("column_is_nice", {})
    with pytest.raises(ValueError):
        Q.Suite("s", "fatal", ())


def test_every_expectation(make):
    df = make("a int, s string, f double", (1, "x", 0.25), (2, "y", 0.75), (2, "y", None), (None, None, 0.0))
    assert results(
        df,
        ("column_values_to_not_be_null", {"column": "a"}),
        ("column_values_to_not_be_null", {"column": "a", "mostly": 0.75}),
        ("column_values_to_be_between", {"column": "a", "max_value": 1, "mostly": 0.3}),
        ("column_values_to_be_unique", {"column": "a"}),
        ("column_values_to_be_unique", {"column": "f"}),
        ("column_values_to_be_in_set", {"column": "s", "value_set": ["x"]}),
        ("column_values_to_not_be_in_set", {"column": "a", "value_set": [999, "text"]}),
        ("column_values_to_match_regex", {"column": "s", "regex": "^[xy]$"}),
        ("column_values_to_be_in_type_list", {"column": "f", "type_list": ["DOUBLE"]}),
        ("column_to_exist", {"column": "nope"}),
        ("table_columns_to_match_set", {"column_set": ["f", "a", "s"]}),
        ("table_row_count_to_be_between", {"min_value": 4, "max_value": 4}),
        ("column_distinct_values_to_equal_set", {"column": "s", "value_set": ["x", "y"]}),
        ("column_distinct_values_to_equal_set", {"column": "s", "value_set": ["x", "y", "z"]}),
        ("column_distinct_values_to_be_in_set", {"column": "s", "value_set": ["x", "y", "z"]}),
        ("column_unique_value_count_to_be_between", {"column": "a", "min_value": 2, "max_value": 2}),
        ("column_min_to_be_between", {"column": "a", "min_value": 1}),
        ("column_max_to_be_between", {"column": "a", "max_value": 1}),
        ("column_sum_to_be_between", {"column": "f", "min_value": 1, "max_value": 1}),
    ) == [
        (False, 4.0, 1), (True, 4.0, 1), (True, 3.0, 2), (False, 3.0, 2), (True, 3.0, 0), (False, 3.0, 2), (True, 3.0, 0),
        (True, 3.0, 0), (True, 1.0, None), (False, 0.0, None), (True, 1.0, None), (True, 4.0, None), (True, 2.0, 0), (False, 2.0, 0),
        (True, 3.0, 0), (True, 2.0, None), (True, 1.0, None), (False, 2.0, None), (True, 1.0, None),
    ]


def test_empty_table(make):
    df = make("a int")
    out = results(df, ("column_values_to_not_be_null", {"column": "a"}), ("column_min_to_be_between", {"column": "a", "min_value": 0}))
    assert out == [(True, 0.0, 0), (False, None, None)]


def test_custom_checks(make):
    assert Q.minimum_rows(0.3, 0.25) == 4
    df = make("r string, risky int, f double", ("EU", 0, 0.2), ("EU", 0, 0.1))
    assert [tuple(r) for r in Q.check_minimum_rows(df, 4).collect()] == [(2, 4, False)]
    assert [tuple(r) for r in Q.soft_warnings(df, "risky", "r").collect()] == [("no_risky_row", True), ("single_group", True)]
    assert [tuple(r) for r in Q.same_row_count(df, df).collect()] == [(2, 2, True)]
    assert [tuple(r) for r in Q.above_share(df, "f", 0.15, 2).collect()] == [(1, False)]
    with pytest.raises(Q.CriticalQualityError, match="EU"):
        Q.enforce_group_minimum(df.select("r").distinct(), "r")
    Q.enforce_group_minimum(df.select("r").limit(0), "r")
    with pytest.raises(Q.CriticalQualityError, match="not enough rows for the share limits; not enough rows for r: EU"):
        Q.enforce_size(df, 4, df.select("r").distinct(), "r")
    Q.enforce_size(df, 2, df.select("r").limit(0), "r")
    mixed = make("r string, risky int", ("EU", None), (None, 0))
    assert [r["warn"] for r in Q.soft_warnings(mixed, "risky", "r").collect()] == [False, False]
    assert [r["warn"] for r in Q.soft_warnings(mixed.limit(0), "risky", "r").collect()] == [True, False]


def test_zscore_and_minmax(make):
    df = make("A double, B double, C double", (1.0, 4.0, 7.0), (2.0, 5.0, 8.0), (3.0, 6.0, 9.0))
    out = Z.zscore(df, ["A", "B", "C"]).toPandas()
    assert out.mean().abs().max() < 1e-12 and (out.std() - 1).abs().max() < 1e-12
    assert Z.zscore(df, ["A"], population=True).toPandas()["A"].std(ddof=0) == pytest.approx(1)
    small = Z.minmax_scale(make("X double, Y double", (1.0, 3.0), (2.0, 4.0), (None, 4.0)), ["X", "Y"]).toPandas()
    assert small.min().tolist() == [0, 0] and small.max().tolist() == [1, 1] and small["X"].isna().sum() == 1


def test_preprocessor_roundtrip(spark, make, tmp_path):
    train = make("n double, c int, empty double", (0.0, 1, None), (10.0, 3, None), (None, None, None))
    fitted = Z.Preprocessor.fit(train, ["n", "empty"], ["c"])
    fitted.save(spark, str(tmp_path / "p"))
    loaded = Z.Preprocessor.load(spark, str(tmp_path / "p"))
    assert sorted(loaded.parameters) == sorted(fitted.parameters)
    new = make("n double, c int, empty double", (20.0, None, 1.0), (None, 2, 1.0))
    assert [tuple(r) for r in loaded.apply(new).collect()] == [(2.0, 2.0, None), (0.5, 2.0, None)]


def test_suites_share_one_pass(make):
    df = make("a int", (1,), (None,))
    suites = [Q.Suite(f"s.{lvl}", lvl, (Q.Expectation("column_values_to_not_be_null", {"column": "a"}),)) for lvl in ("critical", "warning")]
    out = Q.validate(df, *suites)
    assert [(r["suite"], r["success"]) for r in out.collect()] == [("s.critical", False), ("s.warning", False)]
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
