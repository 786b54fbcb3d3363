from shiplog.operators.ordering import number_key, order_by_number, union_with_precedence


def test_natural_order(spark):
    names = ["pre-10.sh", "pre-9.sh", "pre-1.5.sh", "pre-a.sh", "dir-2/pre-3.sh"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    out = [r["name"] for r in order_by_number(df, "name").orderBy("ord").collect()]
    # non-numeric counts as 0; a dash in a folder does not matter
    assert out == ["pre-a.sh", "pre-1.5.sh", "dir-2/pre-3.sh", "pre-9.sh", "pre-10.sh"]


def test_precedence_union(spark):
    g = spark.createDataFrame([("pre-2.sh",), ("pre-1.sh",)], "name string")
    loc = spark.createDataFrame([("pre-0.sh",)], "name string")
    out = [(r["layer"], r["name"]) for r in union_with_precedence(g, loc, "name").orderBy("ord").collect()]
    assert out == [(0, "pre-1.sh"), (0, "pre-2.sh"), (1, "pre-0.sh")]
    same = union_with_precedence(g, loc, "name", same_location=True)
    assert [r["layer"] for r in same.collect()] == [1]


def test_number_key_values(spark):
    df = spark.createDataFrame([("x-007",), ("x",)], "s string")
    got = [float(r[0]) for r in df.select(number_key("s")).collect()]
    assert got == [7.0, 0.0]


def test_sort_list(spark):
    from shiplog.operators.ordering import sort_list

    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "x int, y string")
    got = [tuple(r) for r in df.orderBy(*sort_list("x desc, y")).collect()]
    assert got == [(2, "c"), (1, "a"), (1, "b")]
