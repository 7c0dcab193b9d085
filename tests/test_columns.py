import pytest
from pyspark.sql import functions as F

from lakeloom.functions import scalars as fn
from lakeloom.functions.aggregates import distinct_with_nulls, lowest_mode, pearson, quantile
from lakeloom.operators import columns as C


def got(df, *cols):
    return [tuple(r) for r in (df.select(*cols) if cols else df).collect()]


def test_prefix_and_names(make):
    assert C.prefix_columns(make("A int, B int", (1, 2)), "prefix_", ["B"]).columns == ["prefix_A", "B"]
    df = make("`sepal length (cm)` double, Class string", (1.0, "a"))
    assert C.lower_names(C.two_word_names(df)).columns == ["sepal_length", "class"]


def test_column_name_rules(make):
    df = make("start_date string, customer_id int, price double", ("x", 1, 2.0))
    assert C.drop_columns_containing(df, "date", "id").columns == ["price"]
    assert C.keep_matching(df, "id|price").columns == ["customer_id", "price"]
    assert C.drop_matching(df, "^start").columns == ["customer_id", "price"]
    # the test is on parts of names: "id" also drops "identity" and "paid"
    assert C.drop_columns_containing(make("paid int, x int", (1, 2)), "id").columns == ["x"]


def test_label_encode_skips_missing(make):
    df = make("A int, B int", (1, 3), (2, None), (None, None), (2, 4))
    assert sorted(got(C.LabelEncoder.fit(df, ["A", "B"]).apply(df)), key=str) == sorted(
        [(0, 0), (1, None), (None, None), (1, 1)], key=str
    )


@pytest.mark.parametrize("column", ["n", "s"])
def test_label_encode_beyond_the_driver_limit(make, column):
    df = make("n int, s string", *[(i * 7 % 50 - 20, f"v{i * 7 % 50}") for i in range(50)], (None, None))
    few = C.LabelEncoder.fit(df, [column]).apply(df, "_c")
    many = C.LabelEncoder.fit(df, [column], limit=3).apply(df, "_c")
    assert sorted(got(few), key=str) == sorted(got(many), key=str)


def test_one_hot(make):
    df = make("occupation string, age int, education string", ("?", 20, "x"), ("clerk", 30, "y"), (None, 40, "z"))
    out = C.one_hot(df, exclude=["education"])
    assert out.columns == ["age", "occupation_?", "occupation_clerk", "education"]
    assert got(out) == [(20.0, 1.0, 0.0, "x"), (30.0, 0.0, 1.0, "y"), (40.0, 0.0, 0.0, "z")]
    vectors = C.one_hot(df, exclude=["education"], limit=1)
    assert vectors.columns == ["age", "occupation_onehot", "education"]
    assert {r["age"]: tuple(r["occupation_onehot"].toArray()) for r in vectors.collect()} == {20.0: (1.0, 0.0, 0.0), 30.0: (0.0, 1.0, 0.0), 40.0: (0.0, 0.0, 1.0)}
    wide = C.one_hot_vector(df, "occupation", "v").collect()
    assert sorted(tuple(r["v"].toArray()) for r in wide) == [(0.0, 1.0), (1.0, 0.0)]


def test_keyed_patch(make):
    df = make("k int, x double, s string", (1, 1.0, "a"), (2, 2.0, "b"))
    patches = make("k int, column string, value string", (2, "x", "9.5"), (2, "s", "z"), (1, "other", "q"))
    assert sorted(got(C.keyed_patch(df, patches, "k", ["x", "s"]))) == [(1, 1.0, "a"), (2, 9.5, "z")]


def test_cast_numeric_text(make):
    df = make("v string", ("1",), ("12.0",), ("10.2",), ("hello",))
    assert got(C.cast_numeric(df, "v")) == [
        ("1", 1, None, True), ("12.0", 12, None, True), ("10.2", None, 10.2, True), ("hello", None, None, False),
    ]


def test_cast_columns_bad_text_is_missing(make):
    assert got(C.cast_columns(make("a string", ("1.5",), ("x",)), ["a"], "double")) == [(1.5,), (None,)]


def test_fill_cases(make):
    from lakeloom.plans.shaping import fill_families

    schema = "marital_status string, family_size string, no_of_children string"

    def run(*rows):
        return got(fill_families(make(schema, *rows)), "relationship_status", "no_of_children")

    # a stated status is only renamed
    assert [s for s, _ in run(("Single", "7", "2"), (None, "8", "3"), ("Married", "6", "4"))] == ["Single", None, "In relationship"]
    # a missing one follows from the size of the family
    assert [s for s, _ in run((None, "2", None), ("Married", "5", "2"), (None, "1", None))] == ["In relationship", "In relationship", "Single"]
    # size - children = 1 looks at the size only, so "1+" children still count there
    assert [s for s, _ in run((None, "3+", None), (None, "2", "1+"), (None, "2", "0"), (None, "1", "0"))] == [None, "Single", "In relationship", "Single"]


def test_fill_children(make):
    together = F.col("s") == "In relationship"
    rules = [
        ("c", together & (F.col("f") == "2"), "0"),
        ("c", F.col("f") == "1", "0"),
        ("c", (F.col("s") == "Single") & (F.col("f") == "2"), "1"),
    ]
    df = make(
        "f string, s string, c string",
        ("2", "Single", None), ("4", "Single", "2"), ("1", "In relationship", None), ("2", None, None), ("5", None, None), ("2", "In relationship", None), ("1", None, "9"),
    )
    assert [r[2] for r in got(C.rule_fill(df, rules))] == ["1", "2", "0", None, None, "0", "9"]


def test_text_columns(make):
    df = make("title string, desc_1 string, desc_2 string", ("T", "A\n", "b"))
    out = C.combine_text(df, "desc", ";", "d")
    assert got(out.select(fn.remove_newlines_lower("d"))) == [("a;b",)]
    listed = C.explode_list(make("k string, page int", ("text1,text2", 0)), "k", ",", "keyword", "at")
    assert got(listed) == [(0, 0, "text1"), (0, 1, "text2")]
    with pytest.raises(KeyError):
        fn.template("{missing}")
    assert got(df.select(fn.template("x {a}!", a="title"))) == [("x T!",)]


def test_recodes(make):
    df = make("e string, c string, o string", ("preschool", "united-states", "?"), ("some-college", "x", "other-service"), ("doctorate", None, "clerk"))
    levels = {"preschool": "elementary", "some-college": "undergraduate", "doctorate": "graduate"}
    e = fn.recode("e", levels)
    o = fn.recode("o", {"?": "other", "other-service": "other"})
    out = df.select(e.alias("e"), fn.recode_else(fn.recode("c", {"united-states": "us"}), ["us"], "non-us").alias("c"), o.alias("o"))
    assert got(out) == [("elementary", "us", "other"), ("undergraduate", "non-us", "other"), ("graduate", "non-us", "clerk")]
    # "undergraduate" also contains "graduate"
    both = F.col("e").contains("graduate") & (F.col("o") == "other")
    assert got(out.select(fn.with_suffix_when("o", both, "-2"))) == [("other",), ("other-2",), ("clerk",)]


# --- semantics that differ between pandas and Spark -----------------------------------------------------


def test_division_by_zero_is_missing(make):
    assert got(make("a double, b int", (1.0, 0), (6.0, 3)).select(fn.safe_ratio("a", "b"))) == [(None,), (2.0,)]


def test_missing_counts_as_nonzero(make):
    assert got(make("a double", (0.0,), (5.0,), (None,)).select(fn.flag_nonzero("a"))) == [(0,), (1,), (1,)]


def test_distinct_counts_each_missing_value(make):
    assert got(make("a double", (1.0,), (None,), (None,)).agg(distinct_with_nulls("a"))) == [(3,)]


def test_mode_takes_the_lowest_of_ties(make):
    df = make("g int, a int", (1, 5), (1, 3), (1, None), (2, None))
    assert sorted(got(df.groupBy("g").agg(lowest_mode("a")))) == [(1, 3), (2, None)]


def test_quartiles_interpolate(make):
    df = make("a int", (1,), (2,), (3,), (4,))
    assert got(df.agg(quantile("a", 0.25), quantile("a", 0.75))) == [(1.75, 3.25)]


def test_correlation_of_a_constant_is_missing(make):
    df = make("a double, b double, c double", (1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0))
    assert got(df.agg(pearson("a", "b"), pearson("a", "c"))) == [(pytest.approx(1.0), None)]


def test_half_to_even_rounding(make):
    assert got(make("a double", (0.5,), (1.5,), (2.5,)).select(F.bround("a"))) == [(0.0,), (2.0,), (2.0,)]


def test_weekday_starts_on_monday(make):
    df = make("d string", ("2024-01-01",), ("2024-01-07",)).select(fn.weekday_monday0(F.col("d").cast("date")))
    assert got(df) == [(0,), (6,)]


def test_row_sum_of_missing_is_zero(make):
    assert got(C.with_row_sum(make("a double, b double", (None, None), (1.0, None)), ["a", "b"]), "sum") == [(0.0,), (1.0,)]


def test_nan_becomes_missing(make):
    assert got(C.nan_columns_to_null(make("a double", (float("nan"),), (1.0,)))) == [(None,), (1.0,)]


def test_plus_numbers(make):
    assert got(make("a string", ("1",), ("2+",), (None,), ("x",)).select(fn.plus_to_number("a"))) == [(1.0,), (2.0,), (None,), (None,)]


def test_message_times(make):
    df = make("a string", ("2024-01-02T03:04:05.250000Z",), ("2024-01-02T03:04:05Z",), ("2024-01-02T03:04:05.25Z",), ("nope",))
    out = [r[0] and r[0].microsecond for r in df.select(fn.parse_message_time("a")).collect()]
    assert out[0] == 250000 and out[1] == 0 and out[3] is None


def test_floor_multiple(make):
    df = make("a int", (9999,), (105,))
    assert got(df.select(fn.floor_multiple("a", 100))) == [(9900,), (100,)]
    assert got(df.select(fn.floor_multiple("a", 10))) == [(9990,), (100,)]
    with pytest.raises(ZeroDivisionError):
        fn.floor_multiple("a", 0)


def test_match_probability(make):
    df = make("a int, b int", (1, 1), (1, 2), (1, 5)).select(F.round(fn.match_probability("a", "b"), 6))
    assert got(df) == [(0.85,), (0.6,), (0.0,)]


def test_losses(make):
    df = make("a double, b double", (1.0, 3.0), (None, 1.0))
    assert got(df.select(fn.row_l1(["a", "b"], [F.lit(0.0), F.lit(1.0)]))) == [(3.0,), (None,)]
    arrays = make("x array<double>, y array<double>", ([1.0, 2.0], [0.0, 5.0]))
    assert got(arrays.select(fn.array_l1("x", "y"))) == [(4.0,)]


def test_slices(make):
    df = make("a array<string>", (list("abcde"),), ([],))
    assert got(df.select(fn.slices("a", 2))) == [([["a", "b"], ["c", "d"], ["e"]],), ([],)]


def test_hash_does_not_depend_on_partitions(spark):
    one = spark.range(1000).select("id", fn.stable_hash("id", seed=3).alias("h"))
    many = spark.range(1000).repartition(7).select("id", fn.stable_hash("id", seed=3).alias("h"))
    assert one.exceptAll(many).count() == 0
    mean = one.agg(F.avg(F.col("h") / float(fn.HASH_RANGE))).first()[0]
    assert 0.45 < mean < 0.55
