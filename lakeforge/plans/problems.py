"""Queries of the general data problems, and their SQL where it can say them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.functions.columns import canonical_symbol, iso_date
from lakeforge.operators.attributes import fact_history, known_attributes, membership_history, unpivot_known
from lakeforge.operators.compaction import Compacted, carry_out
from lakeforge.operators.drift import TYPE_SPELLINGS, change_log, column_mapping, lineages, schema_changes, union_schema, union_table
from lakeforge.operators.history import snapshot_readings, versions
from lakeforge.operators.reconcile import differences
from lakeforge.operators.spikes import implausible
from lakeforge.registry import dataset
from lakeforge.session import cut, shared_folder

#: Layout of the stores below; another one is kept apart.
LAYOUT = 2
PRICES = ["open", "high", "low", "close", "volume", "amount"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _p1(spark: SparkSession, folder: str) -> Compacted:
    """The folder's ticks compacted by month; what an earlier query of the same folder has finished is not done again."""
    store = f"{shared_folder(spark)}/compacted-{LAYOUT}-{hashlib.sha256(folder.encode()).hexdigest()[:16]}"
    month, block = F.date_format("trade_date", "yyyy-MM"), F.shiftright("tick_seq", 14)
    return carry_out(table(spark, folder, "trade_ticks"), table(spark, folder, "lake_files"), ["symbol", "trade_date"], ["tick_seq"], store, month, block=block)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return _p1(spark, folder).units.where("files_before >= 2").select("symbol", iso_date("trade_date").alias("trade_date"), "files_before", "partitions_before", "rows_after")


def p1_packed(spark: SparkSession, folder: str) -> DataFrame:
    """By month: files, rows and bytes before, and packed files and rows as written."""
    return _p1(spark, folder).packed.select("period", "files_before", "sessions", "rows_before", "bytes_before", "files_after", "rows_after")


def p1_journal(spark: SparkSession, folder: str) -> DataFrame:
    """The stored journal: every merge with its level, output, number of inputs, rows and bytes."""
    journal = _p1(spark, folder).journal
    return journal.select("symbol", iso_date("trade_date").alias("trade_date"), F.col("_block").alias("block"), "level", "run_id", F.size("inputs").alias("inputs"), "n_files", "n_rows", "n_bytes")


def _p2_changes(spark: SparkSession, folder: str) -> DataFrame:
    return schema_changes(*(table(spark, folder, t) for t in ("vendor_files", "vendor_columns", "vendor_records")), ["symbol", "trade_date"])


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return _p2_changes(spark, folder).select("file_id", "change_kind", "old_name", "new_name")


def _p2_mapping(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The changes, and the column of the union of every declared column."""
    changes = cut(_p2_changes(spark, folder))
    lines = lineages(table(spark, folder, "vendor_files"), table(spark, folder, "vendor_columns"), changes)
    return changes, column_mapping(lines, dataset("daily_bars").schema.names)


def p2_log(spark: SparkSession, folder: str) -> DataFrame:
    """The ordered differences of each feed, with the type that holds all types of the column up to that file."""
    return change_log(*_p2_mapping(spark, folder))


def p2_schema(spark: SparkSession, folder: str) -> DataFrame:
    """The union schema of all deliveries."""
    return union_schema(_p2_mapping(spark, folder)[1])


def p2_table(spark: SparkSession, folder: str) -> DataFrame:
    """All records of all deliveries in the union schema, each once for its feed."""
    mapping = _p2_mapping(spark, folder)[1]
    cells = [(r.canonical, r.dtype) for r in union_schema(mapping).orderBy("canonical").toLocalIterator()]  # a table's columns
    return union_table(table(spark, folder, "vendor_files"), table(spark, folder, "vendor_records"), mapping, cells, ["symbol", "trade_date"])


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    bars = implausible(table(spark, folder, "daily_bars"), "close", "volume").withColumn("table_name", F.lit("daily_bars"))
    factors = implausible(table(spark, folder, "adj_factors"), "factor", exact_sources=True).withColumn("table_name", F.lit("adj_factors"))
    return bars.unionByName(factors).select("table_name", "symbol", iso_date("trade_date").alias("trade_date"), "source").distinct()


def p4_events(spark: SparkSession, folder: str) -> DataFrame:
    histories = {"facts": (fact_history(table(spark, folder, "financial_statement_items")), True), "membership": (membership_history(table(spark, folder, "industry_members")), False)}
    return known_attributes(table(spark, folder, "dragon_tiger"), histories, ["symbol", "trade_date", "reason"])


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    known = unpivot_known(p4_events(spark, folder), ["symbol", "trade_date", "reason"])
    return known.select("symbol", iso_date("trade_date").alias("trade_date"), "reason", "attr_name", "attr_key", iso_date("known_date").alias("known_date"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    key = ["symbol", "trade_date", "source"]
    left, right = (table(spark, folder, t).withColumn("symbol", canonical_symbol("symbol")) for t in ("daily_bars", "daily_bars_mirror"))
    found = differences(left, right, key, PRICES, "symbol", F.year("trade_date"), ("missing_in_mirror", "missing_in_bars"))
    return found.select("symbol", iso_date("trade_date").alias("trade_date"), "source", "diff_kind", "field_name")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    readings = snapshot_readings(table(spark, folder, "trading_status"), "symbol", "trade_date", "status", table(spark, folder, "source_trust"))
    found = versions(readings, "symbol", "trade_date", ["status"])
    return found.select("symbol", "status", iso_date("valid_from").alias("valid_from"), F.coalesce(iso_date("valid_to"), F.lit("")).alias("valid_to"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_packed, p1_journal, p2_found, p2_log, p2_schema, p2_table, p3_found, p4_found, p5_found, p7_found)}


_RANKED = """coalesce(try_cast(nullif(regexp_extract(data_version, '([0-9]{1,9})', 1), '') as bigint), -1) desc, coalesce(data_version, '') desc,
  coalesce(trust_rank, 1073741824) asc, fetched_at desc nulls last, coalesce(source, '') desc"""
_TRUST = "left join (select source, min(trust_rank) as trust_rank from source_trust group by 1) using (source)"


def _p5_sql() -> str:
    symbol = (
        "case when regexp_extract(upper(regexp_replace(symbol, '\\s', '', 'g')), '([0-9]{6})', 1) <> '' and regexp_extract(upper(regexp_replace(symbol, '\\s', '', 'g')), '(SH|SZ|BJ)', 1) <> '' "
        "then regexp_extract(symbol, '([0-9]{6})', 1) || '.' || regexp_extract(upper(regexp_replace(symbol, '\\s', '', 'g')), '(SH|SZ|BJ)', 1) else upper(regexp_replace(symbol, '\\s', '', 'g')) end"
    )
    side = lambda t: (
        f"select {symbol} as symbol, trade_date, source, {', '.join(PRICES)} from {t} "
        f"qualify row_number() over (partition by {symbol}, trade_date, source order by fetched_at desc nulls last, {', '.join(f'{c} desc nulls last' for c in PRICES)}) = 1"
    )
    differs = lambda f: f"case when l.{f} is null then r.{f} is not null when r.{f} is null then true else abs(l.{f} - r.{f}) > 1e-6 * greatest(abs(l.{f}), abs(r.{f})) end"
    joined = "l full join r on l.symbol is not distinct from r.symbol and l.trade_date is not distinct from r.trade_date and l.source is not distinct from r.source"
    key = "coalesce(l.symbol, r.symbol) as symbol, strftime(coalesce(l.trade_date, r.trade_date), '%Y-%m-%d') as trade_date, coalesce(l.source, r.source) as source"
    parts = [
        f"select {key}, 'missing_in_mirror' as diff_kind, '' as field_name from {joined} where r.here is null",
        f"select {key}, 'missing_in_bars' as diff_kind, '' as field_name from {joined} where l.here is null",
        *(f"select {key}, 'value_differs' as diff_kind, '{f}' as field_name from {joined} where l.here = 1 and r.here = 1 and {differs(f)}" for f in PRICES),
    ]
    return f"with l as (select *, 1 as here from ({side('daily_bars')})), r as (select *, 1 as here from ({side('daily_bars_mirror')})) " + " union all ".join(parts)


_PLAIN = "lower(trim(regexp_replace(dtype, '\\(.*\\)$', '')))"
_TYPE = f"case {_PLAIN} " + " ".join(f"when '{a}' then '{b}'" for a, b in TYPE_SPELLINGS.items()) + f" else {_PLAIN} end"
_CHANGES = f"""
f as (select distinct file_id, feed, delivered_at from vendor_files where file_id is not null),
o as (select file_id, lag(file_id) over (partition by feed order by delivered_at, file_id) as previous_id from f),
d as (select file_id, column_name as name, arg_min({_TYPE}, ordinal) as type from vendor_columns where file_id is not null and column_name is not null group by 1, 2),
now as (select o.file_id, d.name, d.type from o join d using (file_id) where previous_id is not null),
was as (select o.file_id, d.name, d.type from o join d on d.file_id = o.previous_id),
b as (select coalesce(n.file_id, p.file_id) as file_id, coalesce(n.name, p.name) as name, p.type as old_type, n.type as new_type from now n full join was p on n.file_id = p.file_id and n.name = p.name),
gone as (select file_id, name as old_name from b where new_type is null),
come as (select file_id, name as new_name from b where old_type is null),
rec as (select file_id, payload, json_extract_string(payload, '$.symbol') as symbol, json_extract_string(payload, '$.trade_date') as trade_date from vendor_records where json_valid(payload)),
cells as (select c.file_id, symbol, trade_date, new_name as name, 1 as side, json_extract_string(payload, '$."' || new_name || '"') as v from come c join rec using (file_id)
  union all select g.file_id, symbol, trade_date, old_name, 0, json_extract_string(payload, '$."' || old_name || '"') from gone g join o using (file_id) join rec on rec.file_id = o.previous_id),
texts as (select file_id, symbol, trade_date, name, side, max(coalesce(cast(try_cast(v as double) as varchar), lower(trim(v)))) as v from cells where v is not null group by all),
score as (select file_id, a.name as old_name, n.name as new_name, count(*) filter (a.v = n.v) as same, count(*) as given from (select * from texts where side = 0) a join (select * from texts where side = 1) n using (file_id, symbol, trade_date) group by 1, 2, 3),
good as (select * from score where same = given and same >= 1),
ranked as (select *, row_number() over (partition by file_id, old_name order by same desc, old_name, new_name) as a, row_number() over (partition by file_id, new_name order by same desc, old_name, new_name) as z from good),
renamed as (select file_id, old_name, new_name from ranked where a = 1 and z = 1),
changes as (select file_id, 'retyped' as change_kind, name as old_name, name as new_name from b where old_type <> new_type
  union all select file_id, 'renamed', old_name, new_name from renamed
  union all select file_id, 'removed', old_name, '' from gone anti join renamed using (file_id, old_name)
  union all select file_id, 'added', '', new_name from come anti join renamed using (file_id, new_name))"""


def _p2_schema_sql() -> str:
    """Columns of the union where no two columns of one file share names (the operator numbers those, SQL would join them)."""
    preferred = "case name " + " ".join(f"when '{n}' then {i}" for i, n in enumerate(dataset("daily_bars").schema.names)) + " else 1000 end"
    has = lambda *ts: f"bool_or(type in ({', '.join(repr(t) for t in ts)}))"
    return f"""
with recursive {_CHANGES.strip()},
names as (select distinct name from d),
edges as (select a.name as x, b.name as y from names a join names b on lower(replace(a.name, '_', '')) = lower(replace(b.name, '_', '')) union select old_name, new_name from renamed union select new_name, old_name from renamed),
reach(x, y) as (select name, name from names union select r.x, e.y from reach r join edges e on r.y = e.x),
canonical as (select x as name, arg_min(name, (p, name)) as canonical from (select x, y as name, {preferred.replace("name", "y", 1)} as p from reach) group by 1)
select canonical, case when bool_or(type not in ('boolean', 'bigint', 'double', 'date', 'timestamp')) or ({has("boolean", "bigint", "double")} and {has("date", "timestamp")}) then 'string' when {has("double")} then 'double' when {has("bigint")} then 'bigint'
  when {has("boolean")} then 'boolean' when {has("timestamp")} then 'timestamp' else 'date' end as dtype, count(distinct file_id) as n_files from d join canonical using (name) join f using (file_id) group by 1"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": """
with per_file as (select symbol, trade_date, t.file_id, regexp_extract(f.file_path, 'trade_date=([^/]*)/', 1) as label from
  (select distinct symbol, trade_date, file_id from trade_ticks) t left join lake_files f using (file_id)),
before as (select symbol, trade_date, count(distinct file_id) as files_before, count(distinct nullif(label, '')) as partitions_before from per_file group by 1, 2),
after as (select symbol, trade_date, count(distinct tick_seq) as rows_after from trade_ticks group by 1, 2)
select symbol, strftime(trade_date, '%Y-%m-%d') as trade_date, files_before, partitions_before, rows_after from before join after using (symbol, trade_date) where files_before >= 2""",
        "p1_packed": """
with f as (select distinct file_id, n_rows as file_rows, n_bytes as file_bytes from lake_files),
part as (select symbol, trade_date, tick_seq >> 14 as block, file_id, count(*) as n from trade_ticks group by all),
sized as (select *, cast(ceil(n * coalesce(cast(file_bytes as double) / nullif(file_rows, 0), 64.0)) as bigint) as b from part left join f using (file_id)),
was as (select strftime(trade_date, '%Y-%m') as period, count(distinct file_id) as files_before, count(distinct (symbol, trade_date)) as sessions, cast(sum(n) as bigint) as rows_before, cast(sum(b) as bigint) as bytes_before from sized group by 1),
now as (select strftime(trade_date, '%Y-%m') as period, count(distinct (symbol, trade_date, tick_seq)) as rows_after from trade_ticks group by 1)
select period, files_before, sessions, rows_before, bytes_before, cast(pow(2, greatest(0, ceil(log2(greatest(bytes_before / 134217728.0, 1.0))))) as bigint) as files_after, rows_after from was join now using (period)""",
        "p2_found": f"with {_CHANGES.strip()} select * from changes",
        "p2_schema": _p2_schema_sql(),
        "p4_found": """
with e as (select distinct symbol, trade_date, reason from dragon_tiger),
f as (select symbol, item_code, report_period, announce_date from financial_statement_items where announce_date >= date '2001-01-01'),
m as (select symbol, classification_system, industry_code, as_of_date from industry_members where as_of_date is not null),
facts as (select e.symbol, e.trade_date, e.reason, item_code as attr_name, report_period as attr_key, announce_date as known_date from e join f on e.symbol = f.symbol and f.announce_date <= e.trade_date
  qualify row_number() over (partition by e.symbol, e.trade_date, e.reason, item_code order by report_period desc, announce_date desc) = 1),
members as (select e.symbol, e.trade_date, e.reason, classification_system as attr_name, industry_code as attr_key, as_of_date as known_date from e join m on e.symbol = m.symbol and m.as_of_date <= e.trade_date
  qualify row_number() over (partition by e.symbol, e.trade_date, e.reason, classification_system order by as_of_date desc, industry_code desc) = 1)
select symbol, strftime(trade_date, '%Y-%m-%d') as trade_date, reason, attr_name, attr_key, strftime(known_date, '%Y-%m-%d') as known_date from (select * from facts union all select * from members)""",
        "p5_found": _p5_sql(),
        "p7_found": f"""
with r as (select symbol, trade_date, lower(trim(status)) as status from trading_status {_TRUST} where trim(status) <> '' and symbol is not null and trade_date is not null
  qualify row_number() over (partition by symbol, trade_date order by {_RANKED}) = 1),
c as (select *, lag(status) over (partition by symbol order by trade_date) as before from r),
v as (select symbol, status, trade_date as valid_from from c where before is null or before <> status)
select symbol, status, strftime(valid_from, '%Y-%m-%d') as valid_from, coalesce(strftime(lead(valid_from) over (partition by symbol order by valid_from), '%Y-%m-%d'), '') as valid_to from v""",
    }
