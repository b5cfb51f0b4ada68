from pyspark.sql import functions as F

from verigrid.functions import dates, identity, text, typing
from verigrid.functions.geometry import to_equal_area, to_mercator


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def test_typed_statuses(spark):
    df = spark.createDataFrame([(None,), ("  ",), ("x1",), ("-5",), ("120",), (" 7 ",)], "raw string")
    value, status = typing.typed(F.col("raw"), "int", 0, 100, below="NEGATIVE")
    rows = df.select(value, status).collect()
    assert [r[1] for r in rows] == ["MISSING", "MISSING", "UNPARSEABLE", "NEGATIVE", "OUT_OF_RANGE", "VALID"]
    assert [r[0] for r in rows] == [None, None, None, -5, 120, 7]


def test_coordinate_status_branches(spark):
    data = [(None, None), (1.0, None), (99.0, 1.0), (5.0, 5.0), (4.0, 4.0)]
    df = spark.createDataFrame(data, "lat double, lon double")
    status = typing.coordinate_status(F.col("lat"), F.col("lon"), (4, 18, 4, 18))
    assert [r[0] for r in df.select(status).collect()] == [
        "MISSING_PAIR", "PARTIAL_PAIR", "OUT_OF_RANGE", "VALID_PAIR", "VALID_PAIR",
    ]


def test_tolerant_numbers(spark):
    df = spark.createDataFrame([("92,337,852 a",), ("1.18E7",), ("12.5",), ("a 5",), ("",)], "t string")
    rows = df.select(typing.to_number(F.col("t")), typing.to_count(F.col("t"))).collect()
    assert [tuple(r) for r in rows] == [
        (92337852.0, 92337852), (11800000.0, 11800000), (12.5, None), (None, None), (None, None),
    ]


def test_match_key_folds_separators_and_words(spark):
    names = ["STO. TOMAS", "SANTO  TOMAS *", "STO TOMAS²", "SAN-JUAN", "SAN JUAN", "SANJUAN", "BARANGAY 1"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    keys = [r[0] for r in df.select(text.match_key(F.col("n"))).collect()]
    assert keys == ["SANTOTOMAS"] * 3 + ["SANJUAN"] * 3 + ["BARANGAY 1"]


def test_unquote_respects_escapes(spark):
    texts = {
        r'{"n":"a \" \"5\"","v":"7"}': r'{"n":"a \" \"5\"","v":7}', r'{"n":"\\","v":"7"}': r'{"n":"\\","v":7}',
        r'{"n":"\"","v":["1","2"]}': r'{"n":"\"","v":[1,2]}', r'{"n":"open \"}': r'{"n":"open \"}', "": "",
    }
    df = spark.createDataFrame([(k,) for k in texts], "j string").select("j", text.unquote_numbers(F.col("j")).alias("u"))
    assert {r.j: r.u for r in df.collect()} == texts


def test_unquote_and_label(spark):
    row = one(
        spark,
        a=text.unquote_numbers(F.lit('{"c":[["1","-2.5e3"]],"n":"x1","l":"[1,2]"}')),
        b=text.short_label(F.lit("Bicol Region (Region V)")),
        c=text.short_label(F.lit("Plain ")),
    )
    assert tuple(row) == ('{"c":[[1,-2.5e3]],"n":"x1","l":[1,2]}', "Region V", "Plain")


def test_run_id_keeps_missing_parts_apart(spark):
    row = one(spark, a=identity.run_id("x", F.lit(None)), b=identity.run_id("x"), c=identity.run_id("x", ""))
    assert row.a != row.b and row.a == row.c


def test_delivery_rule(spark):
    data = [
        ("2020-01-31", "2022-02-01", True), ("2020-01-31", "2022-01-31", False), (None, "2022-01-01", None),
        ("2022-01-01", "2021-01-01", None), ("2020-01-01", None, True),
    ]
    df = spark.createDataFrame(data, "s string, e string, want boolean").select(
        F.col("s").cast("date").alias("s"), F.col("e").cast("date").alias("e"), "want"
    )
    got = df.select("want", dates.spans_more_than(F.col("s"), F.col("e"), F.lit("2023-06-30").cast("date"), 24).alias("got"))
    assert all(r.want == r.got for r in got.collect())


def test_projections_against_known_values(spark):
    mx, my = to_mercator(F.lit(121.0), F.lit(14.6))
    ex, ey = to_equal_area(F.lit(121.0), F.lit(14.6))
    row = one(spark, mx=mx, my=my, ex=ex, ey=ey)
    assert abs(row.mx - 13469658.39) < 0.1 and abs(row.my - 1643351.81) < 1500
    # a one-degree cell at the equator has the area of the ellipsoid there
    ex1, _ = to_equal_area(F.lit(1.0), F.lit(0.0))
    _, ey1 = to_equal_area(F.lit(0.0), F.lit(1.0))
    cell = one(spark, x=ex1, y=ey1)
    assert abs(cell.x * cell.y / 1e6 - 12308.5) < 1.0
