"""Queries of the llm operators, and their SQL where it can say them; the tests hold the others against public libraries and
brute force."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.functions.columns import iso_date
from lakeforge.llm.fusion import PRECEDENCE, both, claims, estimated_sources, fused
from lakeforge.llm.leaks import leak_shares, leaked_items
from lakeforge.llm.stuffing import stuffed_pages, stuffing_shares
from lakeforge.llm.transducer import decode_corpus, encode_corpus
from lakeforge.session import cut

PRICES = ["open", "high", "low", "close", "volume", "amount"]
GROUP = ["table_name", "symbol", "trade_date"]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _p6_items(spark: SparkSession, folder: str) -> DataFrame:
    """The claims of all seven fields in the groups of both tables."""
    trust, key = _table(spark, folder, "source_trust"), ["symbol", "trade_date"]
    bars = claims(_table(spark, folder, "daily_bars"), key, {f: F.col(f).cast("double") for f in PRICES}, trust)
    status = claims(_table(spark, folder, "trading_status"), key, {"status": F.nullif(F.lower(F.trim("status")), F.lit(""))}, trust)
    return cut(both({"daily_bars": bars, "trading_status": status}))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """The row each field comes from: the greatest posterior under a prior of version, trust and time of fetch."""
    items = _p6_items(spark, folder)
    found = fused(items, GROUP, estimated_sources(items), PRECEDENCE)
    return found.select("table_name", "symbol", iso_date("trade_date").alias("trade_date"), "field_name", "source", "data_version", "fetched_epoch")


def p6_fused(spark: SparkSession, folder: str) -> DataFrame:
    """Each field's value by the votes alone, with its posterior."""
    items = _p6_items(spark, folder)
    found = fused(items, GROUP, estimated_sources(items))
    return found.select("table_name", "symbol", iso_date("trade_date").alias("trade_date"), "field_name", "value", F.round("posterior", 6).alias("posterior"))


def p6_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy and independence of every source, over both tables."""
    return estimated_sources(_p6_items(spark, folder)).select("source", F.round("accuracy", 4).alias("accuracy"), F.round("weight", 4).alias("weight"))


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode_corpus(_table(spark, folder, "documents"))


def p8_decoded(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id and the text decoded from its ids."""
    return decode_corpus(encode_corpus(_table(spark, folder, "documents")))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return leaked_items(_table(spark, folder, "documents"), _table(spark, folder, "eval_items"))


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Every document that holds any window of an item, with the share of the item found (three decimals)."""
    return leak_shares(_table(spark, folder, "documents"), _table(spark, folder, "eval_items")).withColumn("share", F.round("share", 3))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return stuffed_pages(_table(spark, folder, "documents"))


def p10_shares(spark: SparkSession, folder: str) -> DataFrame:
    return stuffing_shares(_table(spark, folder, "documents")).withColumn("stuffed_share", F.round("stuffed_share", 6))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p6_found, p6_fused, p6_sources, p8_ids, p8_decoded, p9_found, p9_shares, p10_found, p10_shares)}


_RANKED = """coalesce(try_cast(nullif(regexp_extract(data_version, '([0-9]{1,9})', 1), '') as bigint), -1) desc, coalesce(data_version, '') desc,
  coalesce(trust_rank, 1073741824) asc, fetched_at desc nulls last, coalesce(source, '') desc"""
_TRUST = "left join (select source, min(trust_rank) as trust_rank from source_trust group by 1) using (source)"


def _p6_sql() -> str:
    part = lambda t, f, has: (
        f"select '{t}' as table_name, symbol, trade_date, '{f}' as field_name, source, data_version, fetched_at from "
        f"(select *, count(*) over (partition by symbol, trade_date) as n from {t}) {_TRUST} where n >= 2 and {has} "
        f"qualify row_number() over (partition by symbol, trade_date order by {_RANKED}) = 1"
    )
    parts = [*(part("daily_bars", f, f"{f} is not null") for f in PRICES), part("trading_status", "status", "trim(status) <> ''")]
    return "select table_name, symbol, strftime(trade_date, '%Y-%m-%d') as trade_date, field_name, source, data_version, cast(floor(epoch(fetched_at)) as bigint) as fetched_epoch from (" + " union all ".join(f"({p})" for p in parts) + ")"


def oracle_sql() -> dict[str, str]:
    return {"p6_found": _p6_sql()}
