"""Known counts over three layouts of two generated tables, read with and without push-down."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import keyed as K

from generators import DECLARED, collatz, type_matrix


@pytest.fixture(scope="module")
def sequences(spark):
    root = f"{K.work_root(spark)}/collatz"
    small, large = collatz(spark, 100), collatz(spark, 500)
    by_value = K.create_keyed(spark, "row1", small, "sv,cv", prefix=root, splits=[(50,), (70,), (90, 2), (95, 10)]).table
    by_hash = K.create_keyed(spark, "row2", small, "hash", prefix=root, splits=list("2468ace")).table
    columns = K.create_keyed(spark, "column", large, "hash", prefix=root, store="hash", shards=4).table
    return by_value, by_hash, columns


# Filters and the number of rows each must keep.
SMALL = {
    "step > 115": 3,
    "sv = 97 AND step > 100": 18,
    "hash LIKE '00%'": 14,
    "hash LIKE '%ff'": 15,
    "substring(hash, 10, 2) = '00'": 10,
    "substring(hash, 1, 4) = '4e0a'": 3,
    "substring(hash, 61) = '0bc8'": 3,
    "substring(data, 5, 4) = X'000000A0'": 28,
    "substring(data, 5, 4) = X'00000001'": 100,
    "true": 3242,
}
LARGE = {
    "step > 120 AND (sv < 200 OR sv > 300)": 192,
    "hash LIKE '%dead%'": 9,
    "substring(hash, 10, 2) = '00'": 86,
    "substring(hash, 1, 4) = '4e0a'": 3,
    "substring(hash, 61) = '0bc8'": 3,
    "substring(data, 5, 4) = X'00000001'": 500,
    "true": 26643,
}


def counts(df, filters):
    row = df.agg(*[F.count_if(F.expr(f)).alias(f"f{i}") for i, f in enumerate(filters)]).first()
    return dict(zip(filters, row))


def test_sequence_counts(sequences):
    by_value, by_hash, columns = sequences
    assert counts(by_value.read(), SMALL) == SMALL
    assert counts(by_hash.read(), SMALL) == SMALL
    assert counts(columns.read(), LARGE) == LARGE
    assert by_value.read().filter("sv = 97 AND step > 100").count() == 18
    assert by_hash.read().filter("hash LIKE '00%'").count() == 14


def test_limits_and_longest(sequences):
    _, by_hash, columns = sequences
    assert by_hash.read().orderBy("hash").limit(10).count() == 10
    assert by_hash.read().orderBy("hash").limit(3500).count() == 3242
    assert columns.read().orderBy("hash").limit(1000).count() == 1000
    assert by_hash.read().orderBy(F.desc("step")).limit(1).first().sv == 97
    assert columns.read().orderBy(F.desc("step")).limit(1).first().sv == 327


@pytest.mark.parametrize(
    "which,where",
    [
        (0, [("sv", "=", 97), ("step", ">", 100)]),
        (0, [("sv", "=", 90)]),
        (0, [("sv", "=", 90), ("cv", ">", 2)]),
        (0, [("sv", "=", 90), ("cv", "<", 2)]),
        (0, [("sv", "<=", 90)]),
        (0, [("sv", ">", 90)]),
        (0, [("sv", ">=", 70), ("sv", "<", 95)]),
        (0, [(50, "<=", "sv"), (50, ">=", "sv")]),
        (0, [("cv", "=", 1)]),
        (1, [("hash", "startswith", "00")]),
        (1, [("hash", "startswith", "4e0a"), ("step", ">=", 0)]),
        (1, [("hash", ">", "c"), ("hash", "<=", "e")]),
        (1, [("hash", "<=>", "c")]),
        (2, [("hash", "startswith", "00")]),
        (2, [("sv", "=", 327)]),
    ],
)
def test_pushdown_parity(sequences, which, where):
    table = sequences[which]
    expected = table.base.read(table.spark)
    for name, op, value in [(b, K_FLIP[o], a) if not isinstance(a, str) else (a, o, b) for a, o, b in where]:
        column = F.col(name)
        expected = expected.filter(
            column.startswith(value) if op == "startswith" else F.expr(f"{name} {op} {value!r}")
        )
    assert table.read(where).count() == expected.count() > (0 if where != [("hash", "<=>", "c")] else -1)
    assert K.pushdown_parity(table, where).isEmpty()


K_FLIP = {"<=": ">=", ">=": "<="}


def test_only_touched_shards_are_opened(sequences):
    table = sequences[0]
    files = table.read([("sv", "=", 97), ("step", ">", 100)]).inputFiles()
    assert files and all("_shard=4" in f for f in files)
    plan = table.read([("sv", "=", 97), ("cv", ">", 3)])._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(sv,97)" in plan and "GreaterThan(cv,3)" in plan


@pytest.fixture(scope="module")
def matrices(spark):
    rows = K.coerce(type_matrix(spark, 0, 2000, False), T.StructType([K.declare(n, t) for n, t in DECLARED.items()]))
    root = f"{K.work_root(spark)}/matrix"
    one = K.create_keyed(spark, "one", rows, "id", prefix=root).table
    many = K.create_keyed(spark, "many", rows, "id", prefix=root, splits=list(range(1000, 10000, 1000))).table
    columns = K.create_keyed(spark, "column", rows, "id", prefix=root, store="hash", shards=3).table
    return rows, one, many, columns


# Filters over rows 0 .. 1999 and the number of rows each must keep.
TYPED = {
    "col_bool = true": 1000, "col_bool = false": 1000, "col_bool < true": 1000, "col_bool >= false": 2000,
    "col_int8 <= 0": 1000, "col_int8 > -100": 1790, "col_int8 <= -100": 210, "col_int8 >= 128": 0,
    "col_int16 <= 0": 1000, "col_int16 >= -250": 1126, "col_int16 < -250": 874, "col_int16 = 201": 1,
    "col_int32 > 0": 1000, "col_int32 >= -1": 1001, "col_int32 < -1": 999, "col_int32 = -700": 1,
    "col_int64 > 0": 1000, "col_int64 >= -1": 1001, "col_int64 < -1": 999, "col_int64 = -700": 1,
    "col_uint8 < 0": 0, "col_uint8 > 128": 968, "col_uint8 <= 200": 1608, "col_uint8 = 127": 8,
    "col_uint16 < 0": 0, "col_uint16 > 128": 1871, "col_uint16 <= 200": 201, "col_uint16 = 127": 1,
    "col_uint32 < 0": 0, "col_uint32 > 128": 1871, "col_uint32 <= 200": 201, "col_uint32 = 127": 1,
    "col_uint64 < 0": 0, "col_uint64 > 128": 1871, "col_uint64 <= 200": 201, "col_uint64 = 127": 1,
    "col_float > 0f": 1000, "col_float < -100f": 594, "col_float >= -100f": 1406, "col_float <= 100f": 1405,
    "col_double > 0d": 1000, "col_double < -10d": 905, "col_double >= -10d": 1095, "col_double <= 10d": 1094,
    "col_date >= date'1960-01-01'": 2000, "col_date < date'1970-01-01'": 0, "col_date <= date'1972-01-01'": 731,
    "col_date = date'1972-02-03'": 1, "col_date32 >= date'1960-01-01'": 2000, "col_date32 < date'1970-01-01'": 999,
    "col_date32 <= date'1972-01-01'": 1365, "col_date32 = date'1972-02-03'": 1,
    "col_timestamp >= timestamp'1960-01-01 00:00:00'": 2000, "col_timestamp < timestamp'1970-01-01 00:00:00'": 0,
    "col_timestamp <= timestamp'1971-01-01 00:00:00'": 1174,
    "col_timestamp = timestamp'1970-01-03 19:10:33.6Z'": 1,
    "col_timestamp64 >= timestamp'1960-01-01 00:00:00'": 2000,
    "col_timestamp64 < timestamp'1970-01-01 00:00:00'": 999,
    "col_timestamp64 <= timestamp'1971-01-01 00:00:00'": 1587,
    "col_timestamp64 = timestamp'1970-01-03 19:10:33.6Z'": 1,
}


def test_typed_counts(matrices):
    for source in (matrices[0], *[t.read() for t in matrices[1:]]):
        assert counts(source, TYPED) == TYPED


def test_typed_filters_one_by_one_on_shards(matrices):
    for text in ("col_int64 = -700", "col_uint64 <= 200", "col_date = date'1972-02-03'", "col_float < -100f"):
        assert matrices[2].read().filter(text).count() == TYPED[text]


def test_round_trip_of_every_type(spark, place):
    schema = T.StructType([K.declare(n, t, n != "id") for n, t in DECLARED.items()])
    rows = K.coerce(type_matrix(spark, 3000, 13000, True), schema)
    table = K.create_keyed(spark, "all", rows, "id", prefix=place, splits=list(range(1000, 10000, 1000))).table
    assert K.table_diff(rows, table.read(), ["id"]).isEmpty()
    assert table.read().count() == 10_000
    assert [f.metadata["logical"] for f in K.KeyedTable.open(spark, "all", place).schema] == list(DECLARED.values())
    assert K.upsert(table, rows).table.read().count() == 10_000
    with pytest.raises(ValueError):
        K.insert(table, rows)
    hashed = K.create_keyed(spark, "wide", K.coerce(type_matrix(spark, 5000, 55000, True), schema), "id", prefix=place, store="hash", shards=4)
    assert hashed.rows == 50_000
