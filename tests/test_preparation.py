from lakeloom.plans import preparation as P


def got(df, *cols):
    return [tuple(r) for r in (df.select(*cols) if cols else df).collect()]


def test_census(make):
    df = make(
        "education string, native_country string, workclass string, occupation string, age int, fnlwgt int",
        (" Preschool ", "United-States", "Never-worked", "?", 20, 1),
        ("Some-college", "Poland", "Without-pay", "Other-service", 30, 2),
        ("Doctorate", "?", "?", "Clerk", 40, 3),
        ("HS-grad", "x", "Private", None, 50, 4),
    )
    assert got(P.prepare_census(df)) == [
        ("elementary", "us", "undefined", "other", 20),
        ("undergraduate", "non-us", "undefined", "other-2", 30),
        ("graduate", "non-us", "undefined", "clerk", 40),
    ]


def test_products(make):
    products = make("product_id int, product_category string, title string, desc_1 string, desc_2 string", (1, "c", "T", "A", "B\n"), (2, "c", "U", "x", None))
    keywords = make("product_id int, keywords string", (1, "Key1a,KEY1b"))
    out = P.product_table(products, keywords)
    assert out.columns == ["product_id", "product_category", "title", "product_description", "keywords"]
    assert sorted(got(out)) == [("1", "c", "T", "a;b", "key1a,key1b"), ("2", "c", "U", "x", None)]
