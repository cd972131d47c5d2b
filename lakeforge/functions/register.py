"""The column functions under SQL names, as SQL functions of the session: Catalyst inlines them."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Name, arguments, result and body.
FUNCTIONS = (
    ("canonical_symbol", "s string", "string", "case when regexp_extract(upper(regexp_replace(s, '[ \\\\t\\\\r\\\\n]', '')), '([0-9]{6})', 1) <> '' and regexp_extract(upper(regexp_replace(s, '[ \\\\t\\\\r\\\\n]', '')), '(SH|SZ|BJ)', 1) <> '' then concat(regexp_extract(s, '([0-9]{6})', 1), '.', regexp_extract(upper(s), '(SH|SZ|BJ)', 1)) else upper(regexp_replace(s, '[ \\\\t\\\\r\\\\n]', '')) end"),
    ("version_number", "v string", "bigint", "try_cast(nullif(regexp_extract(v, '([0-9]{1,9})', 1), '') as bigint)"),
    ("exchange_of", "s string", "string", "split_part(s, '.', -1)"),
    ("quarter_of", "d date", "string", "concat(year(d), 'Q', quarter(d))"),
    ("local_date", "t timestamp", "date", "to_date(from_utc_timestamp(t, 'Asia/Shanghai'))"),
    ("session_final", "d date, t timestamp", "boolean", "d <> to_date(from_utc_timestamp(t, 'Asia/Shanghai')) or date_format(from_utc_timestamp(t, 'Asia/Shanghai'), 'HH:mm:ss') >= '15:30:00'"),
    ("relative_gap", "a double, b double", "double", "try_divide(abs(a - b), greatest(abs(a), abs(b)))"),
)


def register(spark: SparkSession) -> list[str]:
    for name, arguments, result, body in FUNCTIONS:
        spark.sql(f"create or replace temporary function {name}({arguments}) returns {result} return {body}")
    return [f[0] for f in FUNCTIONS]
