"""Inputs with known results: Collatz sequences and a matrix of all column types, built by Spark expressions."""

from __future__ import annotations

import struct

from pyspark.sql import functions as F


def collatz(spark, size: int):
    """Every step from 1 .. size down to 1; ``idx`` counts all rows."""
    rows, idx = [], 0
    for sv in range(1, size + 1):
        cv, step = sv, 0
        while True:
            rows.append((sv, cv, idx, step, int(cv == 1), bytearray(struct.pack(">iiii", sv, cv, idx, step))))
            idx += 1
            if cv == 1:
                break
            cv, step = (cv // 2 if cv % 2 == 0 else 3 * cv + 1), step + 1
    df = spark.createDataFrame(rows, "sv int, cv int, idx int, step int, is_last int, data binary")
    return df.select("sv", "cv", "idx", "step", "is_last", F.sha2("data", 256).alias("hash"), "data")


# A nullable column is null where the row id divides by its number.
NULL_EVERY = {
    "col_bool": 83, "col_int8": 79, "col_int16": 73, "col_int32": 71, "col_int64": 67, "col_uint8": 61,
    "col_uint16": 59, "col_uint32": 53, "col_uint64": 47, "col_float": 43, "col_double": 37, "col_decimal22": 31,
    "col_decimal35": 29, "col_binary": 23, "col_text": 19, "col_json": 17, "col_date": 13, "col_date32": 11,
    "col_datetime": 7, "col_datetime64": 13, "col_timestamp": 11, "col_timestamp64": 7,
}

# Declared type of every column.
DECLARED = {
    "id": "Int32", "col_bool": "Bool", "col_int8": "Int8", "col_int16": "Int16", "col_int32": "Int32",
    "col_int64": "Int64", "col_uint8": "Uint8", "col_uint16": "Uint16", "col_uint32": "Uint32", "col_uint64": "Uint64",
    "col_float": "Float", "col_double": "Double", "col_decimal22": "Decimal(22,9)", "col_decimal35": "Decimal(35,6)",
    "col_binary": "Bytes", "col_text": "Text", "col_json": "Json", "col_date": "Date", "col_date32": "Date32",
    "col_datetime": "Datetime", "col_datetime64": "Datetime64", "col_timestamp": "Timestamp",
    "col_timestamp64": "Timestamp64",
}


def type_matrix(spark, first: int, end: int, nullable: bool):
    """Rows first .. end - 1 with one column per type, sign by parity."""
    ms = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
    exprs = {
        "id": "id",
        "col_bool": "id % 2 = 1",
        "col_int8": "s * (id & 127)",
        "col_int16": "s * (id & 32767)",
        "col_int32": "s * id",
        "col_int64": "s * id",
        "col_uint8": "id & 255",
        "col_uint16": "id & 65535",
        "col_uint32": "id",
        "col_uint64": "id",
        "col_float": "CAST(s * 0.1234D * id AS FLOAT)",
        "col_double": "s * 0.053D * id",
        "col_decimal22": "CAST(s * id * 100000 AS DECIMAL(20,0)) / CAST(1000000000 AS DECIMAL(10,0))",
        "col_decimal35": "CAST(s * id * 1000 AS DECIMAL(20,0)) / CAST(1000000 AS DECIMAL(10,0))",
        "col_binary": "CAST(concat('bytes', id) AS BINARY)",
        "col_text": "concat('text-value-', id)",
        "col_json": "concat('{ \"id\": ', id, '}')",
        "col_date": "date_from_unix_date(CAST(id AS INT))",
        "col_date32": "date_from_unix_date(CAST(s * id AS INT))",
        "col_datetime": f"timestampadd(MILLISECOND, 3601000L * id, {ms})",
        "col_datetime64": f"timestampadd(MILLISECOND, 3601000L * s * id, {ms})",
        "col_timestamp": f"timestampadd(MILLISECOND, 86400L * 311 * id, {ms})",
        "col_timestamp64": f"timestampadd(MILLISECOND, 86400L * 311 * s * id, {ms})",
    }
    rows = spark.range(first, end).withColumn("s", F.expr("CASE WHEN id % 2 = 1 THEN 1L ELSE -1L END"))
    columns = []
    for name, text in exprs.items():
        value = F.expr(text)
        if nullable and name in NULL_EVERY:
            value = F.when(F.col("id") % NULL_EVERY[name] != 0, value)
        columns.append(value.alias(name))
    return rows.select(*columns)
