import pytest
from pyspark.sql import functions as F

from lotline.functions import display, jsonfields as J, text as T


def one(spark, expression, **values):
    names = list(values)
    schema = ", ".join(f"{n} string" for n in names)
    df = spark.createDataFrame([tuple(values.values())], schema)
    return df.select(expression(*[F.col(n) for n in names])).first()[0]


@pytest.mark.parametrize(
    "values, expected",
    [((None, "", "0"), "0"), ((None, None, None), ""), ((" ", "x", "y"), " "), (("a", "b", None), "a")],
)
def test_first_present(spark, values, expected):
    assert one(spark, T.first_present, a=values[0], b=values[1], c=values[2]) == expected


@pytest.mark.parametrize(
    "raw, expected",
    [
        (" 12-14  Main St ", "12-14 Main St"),
        ("a\u001cb", "a b"),
        ("a 　\x85b\t", "a b"),
        ("   ", ""),
    ],
)
def test_normalize_spaces(spark, raw, expected):
    assert one(spark, T.normalize_spaces, a=raw) == expected


@pytest.mark.parametrize(
    "pair, expected",
    [(("A  B", None), "A B"), (("", "C"), "C"), (("A", "C"), "A | C"), ((None, None), ""), ((" ", "\t"), "")],
)
def test_join_owners(spark, pair, expected):
    assert one(spark, T.join_owners, a=pair[0], b=pair[1]) == expected


@pytest.mark.parametrize(
    "raw, expected",
    [("O'Neil, J.", "ONEIL J"), (". Smith", " SMITH"), (". ,", " "), (".", ""), ("straße", "STRASSE")],
)
def test_normalize_owner(spark, raw, expected):
    assert one(spark, T.normalize_owner, a=raw) == expected


@pytest.mark.parametrize("raw, expected", [("12-14 Main St", "12-14"), ("", ""), ("7", "7")])
def test_address_number(spark, raw, expected):
    assert one(spark, T.address_number, a=raw) == expected


@pytest.mark.parametrize(
    "zoning, kept", [(" rsa5", True), ("RM1 ", True), ("CMX2", False), ("", False), ("\tR1", False)]
)
def test_residential_zoning(spark, zoning, kept):
    assert one(spark, T.residential_zoning, a=zoning) is kept


def test_pair_label_orders_by_address(spark):
    assert one(spark, T.pair_label, a="5 B ST", b="12 A ST") == "12 A ST | 5 B ST"


def test_display(spark):
    df = spark.createDataFrame([(1234.5, "x"), (-0.5, ""), (None, None)], "v double, t string")
    rows = df.select(display.money(F.col("v")), display.square_feet(F.col("v")), display.label(F.col("t")))
    assert [tuple(r) for r in rows.collect()] == [
        ("$1,235", "1,235 sf", "x"),
        ("$0", "0 sf", "—"),
        ("—", "—", "—"),
    ]


@pytest.mark.parametrize(
    "json_value, text, truthy",
    [
        ('"a"', "a", "a"),
        ('""', "", None),
        ("7", "7", "7"),
        ("0", "0", None),
        ("0.0", "0.0", None),
        ("1.50", "1.5", "1.5"),
        ("1e5", "100000.0", "100000.0"),
        ("true", "True", "True"),
        ("false", "False", None),
        ("null", None, None),
    ],
)
def test_json_scalars(spark, json_value, text, truthy):
    df = spark.createDataFrame([('{"v":%s}' % json_value,)], "j string")
    read = J.with_fields(df.select(F.parse_json("j").alias("r")), "r", ["v"])
    row = read.select(J.scalar_text("v").alias("s"), J.truthy_text("v").alias("t")).first()
    assert (row.s, row.t) == (text, truthy)


def test_number_coerces_text_and_rejects_words(spark):
    df = spark.createDataFrame([('{"v":"12.5"}',), ('{"w":1}',)], "j string")
    read = df.select(J.number(F.parse_json("j"), "v").alias("n"))
    assert [r.n for r in read.collect()] == [12.5, None]
    bad = spark.createDataFrame([('{"v":"many"}',)], "j string")
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST|CAST_INVALID"):
        bad.select(J.number(F.parse_json("j"), "v")).collect()
