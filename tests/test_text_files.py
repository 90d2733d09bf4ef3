import io

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from moorage.functions.names import header_names, normalize_columns, snake_case, suffix_duplicates
from moorage.functions.values import NULL_TOKENS
from moorage.operators import inference
from moorage.plans.registered import QUERIES
from moorage.sources import delimited


def put(folder, name, data):
    with open(f"{folder}/{name}", "wb") as out:
        out.write(data if isinstance(data, bytes) else data.encode())


def test_encodings_bom_quotes_and_line_breaks(spark, folder):
    put(folder, "a.csv", "id,name\n1,café\n\n2,\n".encode("latin-1"))
    put(folder, "b.csv", "﻿id,name\n3,\"two\nlines\"\n4,\"say \"\"hi\"\"\"\n")
    put(folder, "c.csv", "name,id,more\nx,5,6\ny\n")
    profile = {r.path.rsplit("/", 1)[1]: r for r in delimited.profile(spark, folder).collect()}
    assert [profile[n].encoding for n in ("a.csv", "b.csv", "c.csv")] == ["ISO-8859-1", "UTF-8", "UTF-8"]
    assert [profile[n].multi_line for n in ("a.csv", "b.csv", "c.csv")] == [False, True, False]
    rows = delimited.read_delimited(spark, folder).collect()
    got = sorted((r.id or "", r.name, r.more) for r in rows)
    assert got == [
        ("", "y", None), ("1", "café", None), ("2", None, None), ("3", "two\nlines", None), ("4", 'say "hi"', None), ("5", "x", "6")
    ]


@pytest.mark.parametrize("n", [500, 0])
def test_files_of_a_header_alone_count_no_rows(spark, folder, n):
    """The first scan partition of one row group in many byte ranges is empty, but gets a file with a header."""
    names = pa.array([f"Customer {i * 7919 % 10007}" for i in range(n)], pa.string())
    table = {"c_custkey": pa.array(range(n), pa.int64()), "c_name": names, "c_acctbal": pa.array([i / 4 for i in range(n)], pa.float64())}
    pq.write_table(pa.table(table), f"{folder}/customer.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        found = QUERIES["encoding_choice"](spark, folder).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = [("csv_latin1", "ISO-8859-1"), ("csv_utf8", "UTF-8"), ("tsv_utf8", "UTF-8")]
    assert sorted(tuple(r) for r in found) == ([(source, encoding, False, n) for source, encoding in want] if n else [])


def test_long_rows_are_found(spark, folder):
    put(folder, "good.csv", "a,b\n1,2\n")
    put(folder, "bad.csv", "a,b\n1,2,3\n4,5\n")
    (group,) = delimited.file_groups(delimited.profile(spark, folder))
    found = delimited.overlong_files(delimited.read_group(spark, group, ",", overflow=True)).collect()
    assert [(r.path.rsplit("/", 1)[1], r.long_rows) for r in found] == [("bad.csv", 1)]


@pytest.mark.parametrize("header", ["a,b,a,a", "a,,b,", "a,a.1,a", "x", "a,a,a.1"])
def test_header_names_like_pandas(header):
    row = ",".join("1" for _ in header.split(","))
    want = list(pd.read_csv(io.StringIO(f"{header}\n{row}\n")).columns)
    assert header_names(header.split(",")) == want


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Tax Roll", " tax-roll ", "Übung"])
    assert normalize_columns(df).columns == ["tax_roll", "tax_roll_1", "übung"]
    assert suffix_duplicates(["a", "a", "a_1", "a"]) == ["a", "a_2", "a_1", "a_3"]
    assert [snake_case(n) for n in ("TotalTaxes", "CurTotal", "geometry")] == ["total_taxes", "cur_total", "geometry"]


def kinds(spark, *columns):
    rows = list(zip(*columns))
    df = spark.createDataFrame(rows, ", ".join(f"c{i} string" for i in range(len(columns))))
    return [f.dataType.simpleString() for f in inference.infer_types(df).schema]


def test_type_rules(spark):
    assert kinds(
        spark,
        ["007", "-1", "NA"], ["1", "2.5", ""], ["True", "FALSE", "true"], ["True", "1", "0"], ["12d", "1", "2"],
        ["1_000", "2", "3"], ["99999999999999999999", "1", "2"], ["NA", "", "null"], ["2024-01-01", "2024-01-02", "x"], ["1e5", "inf", "-1"],
    ) == ["bigint", "double", "boolean", "string", "string", "string", "string", "string", "string", "double"]


@pytest.mark.parametrize(
    "text, kind",
    [
        ("9223372036854775807", "bigint"), ("9223372036854775808", "string"), ("-9223372036854775808", "bigint"), ("-9223372036854775809", "string"),
        ("+0009223372036854775807 ", "bigint"), ("000000000000000000000", "bigint"), (" -00000000000000000000012", "bigint"), ("10000000000000000000", "string"),
    ],
)
def test_edges_of_64_bits(spark, text, kind):
    df = spark.createDataFrame([(text,), ("1",)], "v string")
    typed = inference.infer_types(df)
    assert typed.schema["v"].dataType.simpleString() == kind
    if kind == "bigint":
        assert sorted(r.v for r in typed.collect()) == sorted([int(text), 1])


cell = st.sampled_from(["1", "-7", "007", "2.5", "1e3", "True", "false", "abc", "NA", "", "12d", "1f", " 4", "0x1", "-", "+3", ".5", "5.", "1,5", "nan"])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(cell, min_size=4, max_size=4), min_size=12, max_size=12))
def test_types_like_pandas(spark, columns):
    got = kinds(spark, *columns)
    for values, kind in zip(columns, got):
        text = "v,w\n" + "".join(f'"{v}",1\n' for v in values)
        series = pd.read_csv(io.StringIO(text), low_memory=False)["v"]
        if series.notna().sum() == 0:
            want = "string"
        elif set(series.dropna().map(type)) == {bool}:
            want = "boolean"
        elif series.dtype.kind == "i" or (
            series.dtype.kind == "f" and all(v.strip().lstrip("+-").isdigit() for v in values if v not in NULL_TOKENS)
        ):
            want = "bigint"
        else:
            want = "double" if series.dtype.kind == "f" else "string"
        assert kind == want, values
