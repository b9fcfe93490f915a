"""The type table of SURVEY 1.1 in both profiles."""

from __future__ import annotations

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyferry.functions.typemap import UnsupportedTypeError, schema_ddl, target_type
from keyferry.operators.conform import as_utc_wall_clock, conform
from tests.plans import plan_text

REFERENCE = [
    (T.IntegerType(), "int"),
    (T.LongType(), "bigint"),
    (T.DoubleType(), "double"),
    (T.FloatType(), "double"),
    (T.StringType(), "text"),
    (T.DateType(), "date"),
    (T.TimestampType(), "timestamp"),
    (T.BooleanType(), "boolean"),
    (T.ByteType(), "text"),
    (T.ShortType(), "text"),
    (T.DecimalType(10, 2), "text"),
    (T.BinaryType(), "text"),
    (T.TimestampNTZType(), "text"),
    (T.DayTimeIntervalType(), "text"),
    (T.NullType(), "text"),
]


@pytest.mark.parametrize("dt_,name", REFERENCE)
def test_reference_names(dt_, name):
    assert target_type(dt_, "reference")[0] == name


@pytest.mark.parametrize(
    "dt_",
    [T.ArrayType(T.IntegerType()), T.ArrayType(T.FloatType()), T.MapType(T.StringType(), T.LongType()),
     T.StructType([T.StructField("a", T.DateType())])],
)
def test_reference_refuses_nested(dt_):
    with pytest.raises(UnsupportedTypeError):
        target_type(dt_, "reference")


@pytest.mark.parametrize(
    "dt_,name",
    [
        (T.ByteType(), "int"),
        (T.ShortType(), "int"),
        (T.DecimalType(10, 2), "decimal"),
        (T.BinaryType(), "blob"),
        (T.TimestampNTZType(), "timestamp"),
        (T.ArrayType(T.FloatType()), "list<double>"),
        (T.MapType(T.StringType(), T.LongType()), "map<text, bigint>"),
        (T.DayTimeIntervalType(), "text"),
    ],
)
def test_exact_names(dt_, name):
    assert target_type(dt_, "exact")[0] == name


def _all_types_frame(spark):
    schema = T.StructType(
        [
            T.StructField("i", T.IntegerType()),
            T.StructField("l", T.LongType()),
            T.StructField("f", T.FloatType()),
            T.StructField("s", T.StringType()),
            T.StructField("b", T.ByteType()),
            T.StructField("sh", T.ShortType()),
            T.StructField("d", T.DecimalType(10, 2)),
            T.StructField("ntz", T.TimestampNTZType()),
            T.StructField("bin", T.BinaryType()),
        ]
    )
    row = (1, 2, 1.5, "x", 3, 4, decimal.Decimal("12.34"), dt.datetime(2024, 1, 2, 3, 4, 5), b"ab")
    return spark.createDataFrame([row], schema)


def test_conform_reference_values(spark):
    out = conform(_all_types_frame(spark), "reference")
    assert [f.dataType.simpleString() for f in out.schema.fields] == [
        "int", "bigint", "double", "string", "string", "string", "string", "string", "string",
    ]
    r = out.first()
    assert (r.f, r.b, r.sh, r.d, r.ntz, r.bin) == (1.5, "3", "4", "12.34", "2024-01-02 03:04:05", "ab")


def test_conform_exact_values(spark):
    out = conform(_all_types_frame(spark), "exact")
    types = {f.name: f.dataType for f in out.schema.fields}
    assert types["b"] == T.IntegerType() and types["d"] == T.DecimalType(10, 2)
    assert types["ntz"] == T.TimestampType()
    # The wall clock is read as UTC whatever the session zone is.
    epoch = out.select(F.unix_seconds("ntz").alias("e")).first().e
    assert epoch == int(dt.datetime(2024, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc).timestamp())
    back = as_utc_wall_clock(out).first().ntz
    assert back == dt.datetime(2024, 1, 2, 3, 4, 5)


def test_conform_exact_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        out = conform(_all_types_frame(spark), "exact")
        epoch = out.select(F.unix_seconds("ntz").alias("e")).first().e
        assert epoch == int(dt.datetime(2024, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc).timestamp())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_conform_keeps_unchanged_columns_as_is(spark):
    df = spark.createDataFrame([(1, "a")], "i int, s string")
    out = conform(df, "reference")
    # No cast in the plan for columns already of the target type.
    assert "CAST" not in plan_text(out, "extended").upper()


def test_schema_ddl(spark):
    assert schema_ddl(spark.createDataFrame([(1, "a")], "i int, s string").schema) == [("i", "int"), ("s", "text")]


def test_keyed_table_ddl_key_clause(spark):
    from pyspark.sql import types as T

    from keyferry.functions.typemap import keyed_table_ddl

    schema = spark.createDataFrame([(1, 2, "x", 1.5)], "customer_id int, order_id bigint, note string, amt float").schema
    one = keyed_table_ddl(schema, "ks", "orders", ["customer_id"], ["order_id"])
    assert one == ('CREATE TABLE IF NOT EXISTS "ks"."orders" ("customer_id" int, "order_id" bigint, "note" text, '
                   '"amt" double, PRIMARY KEY (("customer_id"), "order_id"))')
    two = keyed_table_ddl(schema, "ks", "orders", ["customer_id", "note"], ["order_id"], clustering_order="desc")
    assert two.endswith('PRIMARY KEY (("customer_id", "note"), "order_id")) '
                        'WITH CLUSTERING ORDER BY ("order_id" DESC)')
    assert keyed_table_ddl(schema, "ks", "t", ["order_id"]).endswith('PRIMARY KEY (("order_id")))')
    # Case and reserved words survive quoting; nested collections are frozen.
    nested = T.StructType([
        T.StructField("Order", T.LongType()),
        T.StructField("tags", T.ArrayType(T.MapType(T.StringType(), T.IntegerType()))),
        T.StructField("bucket", T.ArrayType(T.IntegerType())),
    ])
    ddl = keyed_table_ddl(nested, "ks", "t", ["Order"], ["bucket"], profile="exact")
    assert '"Order" bigint' in ddl and '"tags" list<frozen<map<text, int>>>' in ddl
    assert '"bucket" frozen<list<int>>' in ddl


def test_ntz_conversion_is_exact_in_a_dst_overlap(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        gap = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30),)], "t timestamp_ntz")  # spring-forward gap
        assert conform(gap, "exact").select(F.unix_seconds("t")).first()[0] == 1710037800
        # 01:30 on 2024-11-03 happens twice in New York (fall-back overlap).
        rows = [(dt.datetime(2024, 11, 3, 1, 30), [dt.datetime(2024, 11, 3, 1, 45)])]
        df = spark.createDataFrame(rows, "t timestamp_ntz, a array<timestamp_ntz>")
        out = conform(df, "exact")
        r = out.select(F.unix_seconds("t").alias("s"), F.unix_seconds(F.col("a")[0]).alias("n")).first()
        assert (r.s, r.n) == (1730597400, 1730598300)  # read as UTC, nested too, 15 minutes apart
        assert as_utc_wall_clock(out.select("t")).first().t == dt.datetime(2024, 11, 3, 1, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
