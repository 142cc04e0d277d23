from hammerline.operators import spelling


def test_one_spelling_over_tables(spark):
    """The least spelling stands in every table that shares the key; nulls, other columns, their order and repeated rows stay."""
    codes = spark.createDataFrame([(1, "ab", "X"), (2, "AB", "x"), (3, None, "y"), (4, "cd", None), (4, "cd", None)], "SellerId int, SellerCode string, more string")
    groups = spark.createDataFrame([("Ab", 7), ("CD", 8), ("", 9)], "SellerCode string, n int")
    got = spelling.unify({"dim_seller": codes, "dim_seller_group": groups, "other": groups},
                         {"SellerCode": ("dim_seller", "dim_seller_group")})
    assert got["dim_seller"].columns == codes.columns
    assert sorted(map(tuple, got["dim_seller"].collect()), key=str) == sorted(
        [(1, "AB", "X"), (2, "AB", "x"), (3, None, "y"), (4, "CD", None), (4, "CD", None)], key=str)
    assert sorted(map(tuple, got["dim_seller_group"].collect())) == [("", 9), ("AB", 7), ("CD", 8)]
    assert sorted(map(tuple, got["other"].collect())) == sorted(map(tuple, groups.collect()))


def test_nothing_to_respell(spark):
    """Empty tables, keys of one spelling, and columns that are no text or are missing pass through."""
    empty = spark.createDataFrame([], "bidderemail string")
    ids = spark.createDataFrame([(1,), (2,)], "PropertyState int")
    got = spelling.unify({"a": empty, "b": ids}, {"bidderemail": ("a", "b"), "PropertyState": ("b",)})
    assert got["a"].count() == 0 and got["a"].columns == ["bidderemail"]
    assert sorted(r[0] for r in got["b"].collect()) == [1, 2] and got["b"].dtypes == [("PropertyState", "int")]


def test_letters_beyond_ascii(spark):
    rows = spark.createDataFrame([("ÄÖ",), ("äö",), ("ao",), ("日本",)], "k string")
    got = spelling.unify({"t": rows}, {"k": ("t",)})["t"]
    assert sorted(r[0] for r in got.collect()) == sorted(["ÄÖ", "ÄÖ", "ao", "日本"])


def test_joins_stay_plain(spark):
    """The respelled key is an ordinary string: no collation reaches the joins over facts."""
    rows = spark.createDataFrame([("a@x",), ("A@X",)], "bidderemail string")
    got = spelling.unify({"dim_bidder": rows}, {"bidderemail": ("dim_bidder",)})["dim_bidder"]
    assert got.dtypes == [("bidderemail", "string")]
    assert [tuple(r) for r in got.groupBy("bidderemail").count().collect()] == [("A@X", 2)]
