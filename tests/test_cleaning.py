from pyspark.sql import functions as F

from tablewright.functions import cleaning as fn
from tablewright.functions import text
from tablewright.plans import fixed_values as fixed
from tablewright.plans import silver


def one(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


def test_casts_never_raise(spark):
    df = spark.createDataFrame([("12",), ("x",), ("",), (None,), ("1.5",)], "v string")
    assert [r[0] for r in df.select(fn.as_int(F.col("v"))).collect()] == [
        12, None, None, None, None]
    assert [r[0] for r in df.select(fn.as_double(F.col("v"))).collect()] == [
        12.0, None, None, None, 1.5]


def test_leading_number(spark):
    values = ["23.4 kmpl", "1248 CC", "n/a", "", None, "1.2.3"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.select(fn.leading_number(F.col("v"), fixed.NUMBER_PATTERN)).collect()
    assert [r[0] for r in got] == [23.4, 1248.0, None, None, None, None]


def test_dates(spark):
    assert str(one(spark, fn.as_timestamp(F.lit("31-12-2019 23:59"), fixed.MINUTE_FORMAT))) \
        == "2019-12-31 23:59:00"
    assert one(spark, fn.as_timestamp(F.lit("27:00.0"), fixed.MINUTE_FORMAT)) is None
    assert str(one(spark, fn.as_date(F.lit("2014-02-28"), fixed.DATE_FORMAT))) == "2014-02-28"
    assert one(spark, fn.as_date(F.lit("2014-02-30"), fixed.DATE_FORMAT)) is None


def test_recode_keeps_unknown_and_null(spark):
    df = spark.createDataFrame([("E",), ("East",), ("Q",), (None,)], "v string")
    got = df.select(fn.recode(F.col("v"), fixed.REGION_CODES)).collect()
    assert [r[0] for r in got] == ["East", "East", "Q", None]


def test_email(spark):
    cases = {"a.b@mail.example.org": True, "a@b": False, "a b@x.org": False, None: False,
             "x@y.co\nz": False}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = df.select(fn.matches(F.col("v"), fixed.EMAIL_PATTERN)).collect()
    assert [r[0] for r in got] == list(cases.values())


def test_absent_columns_are_null(spark):
    df = spark.createDataFrame([(1,)], "cust_id long")
    assert df.select(fn.first_present(df, ["CustomerID", "cust_id"])).first()[0] == 1
    assert df.select(fn.first_present(df, ["Region", "Reg"])).first()[0] is None


def test_swapped_columns_are_recognised_by_value(spark):
    raw = spark.createDataFrame([
        ("customers_6", 1, "single", "tertiary"),   # swapped
        ("customers_1", 2, "primary", "married"),   # in place
        ("customers_6", 3, "divorced", None),       # swapped, education missing
        ("customers_5", 4, "terto", "single"),      # misspelt
    ], "_source_file string, CustomerID long, Education string, Marital_status string")
    got = {r.customer_id: (r.marital, r.education)
           for r in silver.harmonized_customers(raw).collect()}
    assert got == {1: ("single", "tertiary"), 2: ("married", "primary"),
                   3: ("divorced", "divorced"), 4: ("single", "tertiary")}


def test_block_text(spark):
    cases = [
        ('[{"type":"reasoning","summary":[]},{"type":"text","text":"answer"}]', "answer"),
        ('  [{"type":"text","text":"first"},{"type":"text","text":"second"}]', "first"),
        ('[{"type":"reasoning"}]', '[{"type":"reasoning"}]'),
        ("plain words", "plain words"),
        ("[not json", "[not json"),
        ("", ""),
        (None, None),
    ]
    df = spark.createDataFrame([(c,) for c, _ in cases], "v string")
    got = [r[0] for r in df.select(text.block_text(F.col("v"))).collect()]
    assert got == [expected for _, expected in cases]


def test_parsed_blocks(spark):
    df = spark.sql("SELECT array(named_struct('type','reasoning','text','r'), "
                   "named_struct('type','text','text','t')) AS b, "
                   "array(named_struct('type','reasoning','text','r')) AS c")
    row = df.select(text.first_text_block(F.col("b")).alias("b"),
                    text.first_text_block(F.col("c")).alias("c")).first()
    assert row.b == "t"
    assert row.c == '[{"type":"reasoning","text":"r"}]'


def test_template_prints_missing_values(spark):
    out = one(spark, text.template("a {x}, b {y}.", x=F.lit(1),
                                   y=F.lit(None).cast("string")))
    assert out == "a 1, b None."
