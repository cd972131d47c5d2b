from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lakeforge.operators.drift import change_log, column_mapping, lineages, plain_type, schema_changes, union_cells, union_schema, union_table, widest_of
from tests.conftest import rows

FILES = "file_id bigint, feed string, source string, delivered_at timestamp, n_rows bigint"
COLUMNS = "file_id bigint, ordinal int, column_name string, dtype string"
RECORDS = "file_id bigint, row_no int, payload string"
KEY = ["symbol", "trade_date"]


def lake(spark, deliveries):
    """deliveries: (file_id, feed, day, {column: type}, [records])."""
    f = [(i, feed, "x", dt.datetime(2024, day // 28 + 1, day % 28 + 1), len(rs)) for i, feed, day, _, rs in deliveries]
    c = [(i, n, name, kind) for i, _, _, cols, _ in deliveries for n, (name, kind) in enumerate(cols.items())]
    r = [(i, n, json.dumps(x) if isinstance(x, dict) else x) for i, _, _, _, rs in deliveries for n, x in enumerate(rs)]
    return spark.createDataFrame(f, FILES), spark.createDataFrame(c, COLUMNS), spark.createDataFrame(r, RECORDS)


def record(day, **cells):
    return {"symbol": "A.SH", "trade_date": f"2024-01-{day:02d}"} | cells


BASE = {"symbol": "String", "trade_date": "Date"}


def test_kinds_of_change(spark):
    got = schema_changes(
        *lake(
            spark,
            [
                (9, "f", 1, BASE | {"close": "double", "vol": "Int64", "gone": "f64"}, [record(1, close=1.5, vol=10, gone=1), record(2, close=2.5, vol=20, gone=2)]),
                (4, "f", 2, {"trade_date": "date32", "symbol": "Utf8"} | {"Close": "Float64", "vol": "String", "new": "f64"}, [record(2, Close="2.50", vol="20", new=7), record(3, Close=3, vol=None, new=8)]),
            ],
        ),
        KEY,
    )
    assert rows(got, "file_id", "change_kind", "old_name", "new_name") == [(4, "added", "", "new"), (4, "removed", "gone", ""), (4, "renamed", "close", "Close"), (4, "retyped", "vol", "vol")]


def test_order_of_delivery_not_of_ids_and_feeds_apart(spark):
    got = schema_changes(*lake(spark, [(5, "f", 40, BASE | {"b": "int"}, []), (6, "f", 3, BASE, []), (7, "g", 4, BASE | {"c": "int"}, [])]), KEY)
    assert rows(got, "file_id", "change_kind", "new_name") == [(5, "added", "b")]


def test_first_file_of_a_month_follows_the_month_before(spark):
    got = schema_changes(*lake(spark, [(1, "f", 27, BASE, []), (2, "f", 28, BASE | {"b": "int"}, []), (3, "f", 90, BASE, [])]), KEY)
    assert rows(got, "file_id", "change_kind") == [(2, "added"), (3, "removed")]


def test_nulls_bad_payloads_and_empty_tables(spark):
    f, c, r = lake(spark, [(1, "f", 1, BASE | {"a": "int"}, ["no json", None]), (2, "f", 2, BASE | {"b": "int"}, [])])
    c = c.unionByName(spark.createDataFrame([(2, 9, None, "int"), (None, 1, "z", "int"), (1, 0, "symbol", "String")], COLUMNS))
    assert rows(schema_changes(f, c, r, KEY), "change_kind") == [("added",), ("removed",)]
    assert schema_changes(f.limit(0), c.limit(0), r.limit(0), KEY).count() == 0


def test_different_content_is_no_rename(spark):
    got = schema_changes(*lake(spark, [(1, "f", 1, BASE | {"a": "int"}, [record(1, a=1), record(2, a=2)]), (2, "f", 2, BASE | {"b": "int"}, [record(1, b=1), record(2, b=3)])]), KEY)
    assert rows(got, "change_kind") == [("added",), ("removed",)]


@pytest.mark.parametrize("types,want", [({"bigint", "double"}, "double"), ({"boolean"}, "boolean"), ({"date", "timestamp"}, "timestamp"), ({"date", "bigint"}, "string"), ({"bigint", "string"}, "string"), ({"blob"}, "string")])
def test_lattice(spark, types, want):
    assert spark.range(1).select(widest_of(F.array(*map(F.lit, sorted(types))))).first()[0] == want


def test_spellings(spark):
    df = spark.createDataFrame([("Utf8",), (" VARCHAR(20)",), ("f64",), ("i64",), ("date32",), ("odd",)], "t string")
    assert [r[0] for r in df.select(plain_type(F.col("t"))).toLocalIterator()] == ["string", "string", "double", "bigint", "date", "odd"]


def mapped(f, c, r, preferred):
    changes = schema_changes(f, c, r, KEY)
    return changes, column_mapping(lineages(f, c, changes), preferred)


def table_of(f, r, mapping):
    return union_table(f, r, mapping, [(x.canonical, x.dtype) for x in union_schema(mapping).orderBy("canonical").toLocalIterator()], KEY)


def test_union_table_holds_each_record_once(spark):
    f, c, r = lake(spark, [(1, "f", 1, BASE | {"close": "double"}, [record(1, close=1.5), record(2, close=2.5)]), (2, "f", 2, BASE | {"px": "String"}, [record(2, px="2.5"), record(3, px="3.5"), record(3, px="3.5")])])
    _, mapping = mapped(f, c, r, ["close"])
    schema = [(x.canonical, x.dtype) for x in union_schema(mapping).toLocalIterator()]
    assert ("close", "string") in schema and ("px", "string") not in schema
    assert rows(table_of(f, r, mapping), "symbol", "close") == [("A.SH", "1.5"), ("A.SH", "2.5"), ("A.SH", "3.5")]
    assert union_cells(f, r, mapping).where("canonical = 'close'").count() == 5


def test_one_name_of_two_meanings_stays_two_columns(spark):
    f, c, r = lake(
        spark,
        [
            (1, "f", 1, BASE | {"turnover": "double"}, [record(1, turnover=5.0)]), (2, "f", 2, BASE | {"amount": "double"}, [record(1, amount=5.0), record(2, amount=6.0)]),
            (3, "g", 1, BASE | {"turnover": "double", "amount": "double"}, [record(1, turnover=0.5, amount=777.0)]), (4, "g", 2, BASE | {"turnover_rate": "double", "amount": "double"}, [record(1, turnover_rate=0.5, amount=777.0)]),
        ],
    )
    _, mapping = mapped(f, c, r, ["amount"])
    assert rows(table_of(f, r, mapping), "feed", "amount", "turnover") == [("f", 5.0, None), ("f", 6.0, None), ("g", 777.0, 0.5)]
    assert {x.canonical for x in mapping.where("clash").toLocalIterator()} == {"amount", "turnover"}


def test_swapped_and_reused_names_lose_nothing(spark):
    f, c, r = lake(
        spark,
        [
            (1, "f", 1, BASE | {"a": "int", "b": "int"}, [record(1, a=1, b=10), record(2, a=2, b=20)]),
            (2, "f", 2, BASE | {"c": "int", "b": "int"}, [record(2, c=2, b=20), record(3, c=3, b=30)]),
            (3, "f", 3, BASE | {"c": "int", "a": "int"}, [record(3, c=3, a=30), record(4, c=4, a=40)]),
        ],
    )
    changes, mapping = mapped(f, c, r, [])
    assert rows(changes, "old_name", "new_name") == [("a", "c"), ("b", "a")]
    got = rows(table_of(f, r, mapping), *(x for x in ("a", "b")))
    assert got == [(1, 10), (2, 20), (3, 30), (4, 40)]


def test_a_name_that_comes_again_is_numbered(spark):
    f, c, r = lake(spark, [(1, "f", 1, BASE | {"a": "int"}, [record(1, a=1)]), (2, "f", 2, BASE | {"b": "int", "a": "int"}, [record(1, b=1, a=5)]), (3, "f", 3, BASE | {"b": "int"}, [record(1, b=1)])])
    changes = spark.createDataFrame([(2, "renamed", "a", "b", None, None), (2, "added", "", "a", None, None), (3, "removed", "a", "", None, None)], "file_id bigint, change_kind string, old_name string, new_name string, old_type string, new_type string")
    mapping = column_mapping(lineages(f, c, changes), [])
    assert rows(mapping.where("name in ('a', 'b')"), "file_id", "name", "canonical") == [(1, "a", "a"), (2, "a", "a__2"), (2, "b", "a"), (3, "b", "a")]


def test_chains_of_names_meet_in_one(spark):
    names = ["Close", "last", "px_last", "shoupan", "closing_price"]
    deliveries = [(i, "f", i + 1, BASE | {n: "double"}, [record(i, **{n: 1.0 * i}), record(i + 1, **{n: i + 1.0})]) for i, n in enumerate(names, 1)] + [(99, "g", 1, BASE | {"close": "double", "vwap": "double"}, [])]
    _, mapping = mapped(*lake(spark, deliveries), ["close"])
    assert {x.canonical for x in mapping.toLocalIterator()} == {"close", "vwap", "symbol", "trade_date"} and not mapping.where("clash").count()


def test_log_is_ordered_and_types_widen(spark):
    f, c, r = lake(spark, [(3, "f", 1, BASE | {"v": "int"}, []), (1, "f", 2, BASE | {"v": "double"}, []), (2, "f", 40, BASE | {"v": "int", "w": "date"}, []), (7, "g", 2, BASE, []), (8, "g", 3, BASE | {"w": "text"}, [])])
    log = change_log(*mapped(f, c, r, []))
    assert rows(log, "feed", "change_no", "file_id", "change_kind", "union_type") == [("f", 1, 1, "retyped", "double"), ("f", 2, 2, "added", "date"), ("f", 3, 2, "retyped", "double"), ("g", 1, 8, "added", "string")]
    empty = change_log(*mapped(f.limit(0), c.limit(0), r.limit(0), []))
    assert empty.count() == 0
