"""Merges, statistics and catalogue tables of the store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeforge.operators.readpath import canonical


def upserted(existing: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Rows of both by key, the latest fetch winning; columns that one side lacks are null there."""
    return canonical(existing.unionByName(incoming, allowMissingColumns=True), key)


def merged_instruments(existing: DataFrame, incoming: DataFrame, absences: DataFrame, day: str, most_absent: float = 0.05, needed: int = 2) -> DataFrame:
    """symbol, name, list_date, delist_date, absences, state.

    Symbols that live and are absent count one more absence; at ``needed`` they are delisted on ``day``.  If more than
    ``most_absent`` of the living are absent at once the delivery is not trusted: nothing is inferred (suppressed)."""
    today = F.lit(day).cast("date")
    old = existing.select("symbol", F.col("name").alias("old_name"), F.col("list_date").alias("old_list"), F.col("delist_date").alias("old_delist")).withColumn("known", F.lit(True))
    new = incoming.select("symbol", F.col("name").alias("new_name"), F.col("list_date").alias("new_list"), F.col("delist_date").alias("new_delist")).withColumn("seen", F.lit(True))
    both = old.join(new, "symbol", "full").join(absences.select("symbol", F.col("absences").alias("before")), "symbol", "left")
    live = F.coalesce(F.col("known"), F.lit(False)) & (F.col("old_delist").isNull() | (F.col("old_delist") >= today))
    both = both.withColumn("absent", live & F.col("seen").isNull()).withColumn("live", live)
    share = both.agg(F.coalesce(F.try_divide(F.count_if("absent"), F.count_if("live")), F.lit(0.0)).alias("share"))
    both = both.join(F.broadcast(share))
    n = F.when(F.col("absent"), F.coalesce("before", F.lit(0)) + F.when(F.col("share") <= most_absent, 1).otherwise(0)).when(F.col("seen"), 0).otherwise(F.coalesce("before", F.lit(0)))
    gone = F.col("absent") & (F.col("share") <= most_absent) & (F.col("absences") >= needed)
    state = F.when(F.col("absent"), F.when(F.col("share") > most_absent, "suppressed").when(gone, "delisted").otherwise("pending")).when(F.col("known").isNull(), "new").when(F.col("seen"), "seen").otherwise("kept")
    return both.withColumn("absences", n.cast("int")).select(
        "symbol", F.coalesce("new_name", "old_name").alias("name"), F.coalesce("new_list", "old_list").alias("list_date"), F.when(gone, today).otherwise(F.coalesce("new_delist", "old_delist")).alias("delist_date"), "absences", state.alias("state")
    )


def partition_stats(df: DataFrame, label: Column) -> DataFrame:
    return df.groupBy(label.alias("partition")).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("symbol").alias("symbols"), F.unix_seconds(F.max("fetched_at")).alias("fetched_epoch"))


def provenance_mix(df: DataFrame, label: Column) -> DataFrame:
    return df.groupBy(label.alias("partition"), "source", "data_version").agg(F.count(F.lit(1)).alias("n_rows"), F.unix_seconds(F.min("fetched_at")).alias("first_epoch"), F.unix_seconds(F.max("fetched_at")).alias("last_epoch"))


def replace_stats(stored: DataFrame, rebuilt: DataFrame, by: str = "dataset") -> DataFrame:
    """Stored rows of the datasets that were not rebuilt, and the rebuilt ones."""
    return stored.join(rebuilt.select(by).distinct(), by, "left_anti").unionByName(rebuilt)


def provenance_buckets(df: DataFrame, day: str, most: int = 400) -> DataFrame:
    """Rows by source over time in the finest of day, month, year that gives at most ``most`` points."""
    c = df.agg(F.countDistinct(day).alias("d"), F.countDistinct(F.trunc(day, "month")).alias("m"))
    unit = F.when(F.col("d") <= most, "day").when(F.col("m") <= most, "month").otherwise("year")
    u = c.select(unit.alias("unit"))
    bucket = F.when(F.col("unit") == "day", F.col(day)).when(F.col("unit") == "month", F.trunc(day, "month")).otherwise(F.trunc(day, "year"))
    return df.join(F.broadcast(u)).groupBy("unit", bucket.alias("bucket_date"), "source").agg(F.count(F.lit(1)).alias("n_rows"))


def heatmap(bars: DataFrame, calendar: DataFrame) -> DataFrame:
    """symbol, month and whether all, some or none of the month's sessions are there, within the symbol's span of months."""
    sessions = calendar.select("trade_date").distinct().groupBy(F.trunc("trade_date", "month").alias("month_date")).agg(F.count(F.lit(1)).alias("sessions"))
    have = bars.select("symbol", "trade_date").distinct().groupBy("symbol", F.trunc("trade_date", "month").alias("month_date")).agg(F.count(F.lit(1)).alias("present"))
    span = have.groupBy("symbol").agg(F.min("month_date").alias("lo"), F.max("month_date").alias("hi"))
    cells = span.select("symbol", F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("month_date")).join(F.broadcast(sessions), "month_date")
    cells = cells.join(have, ["symbol", "month_date"], "left").withColumn("present", F.coalesce("present", F.lit(0)))
    return cells.withColumn("cell", F.when(F.col("present") == 0, "none").when(F.col("present") >= F.col("sessions"), "full").otherwise("part"))


def board_label(code: str) -> Column:
    """``BK`` and the number, in four digits or as many as it has."""
    text = F.col(code).cast("string")
    return F.concat(F.lit("BK"), F.when(F.length(text) < 4, F.lpad(text, 4, "0")).otherwise(text))


def board_codes(sectors: DataFrame, boards: DataFrame, normal: Column, board_normal: Column) -> DataFrame:
    """Sectors by their code (``board_label``) matched to boards by number; names that differ are marked."""
    b = boards.select(board_label("board_code").alias("sector_code"), "board_code", "board_name", board_normal.alias("_b"))
    m = sectors.withColumn("_n", normal).join(b, "sector_code", "left")
    kind = F.when(F.col("board_code").isNull(), "predicted_no_members").when(F.col("_n") == F.col("_b"), "identity").otherwise("identity_name_mismatch")
    return m.select("sector_code", "sector_name", "board_code", "board_name", kind.alias("match_type"))


def routed_names(names: DataFrame, targets: DataFrame, least: int = 2) -> DataFrame:
    """name, its target and tier: the equal name, else the only target contained in it, else none.

    Containment is an equi-join on the name's substrings, so no pairs of names are ever formed."""
    t = targets.select(F.col("name").alias("target")).distinct()
    sub = F.flatten(F.transform(F.sequence(F.lit(1), F.length("name")), lambda i: F.transform(F.sequence(F.lit(1), F.length("name") - i + 1), lambda n: F.substr("name", i, n))))
    pieces = names.select("name").where("length(name) > 0").distinct().select("name", F.explode(F.array_distinct(sub)).alias("target")).where(F.length("target") >= least)
    hits = pieces.join(t, "target").groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.max("target").alias("one"), F.count_if(F.col("target") == F.col("name")).alias("same"))
    out = names.select("name").distinct().join(hits, "name", "left")
    return out.select("name", F.when(F.col("same") > 0, F.col("name")).when(F.col("n") == 1, F.col("one")).alias("target"), F.when(F.col("same") > 0, "exact").when(F.col("n") == 1, "contains").when(F.col("n") > 1, "ambiguous").otherwise("none").alias("tier"))


def expanded_actions(plans: DataFrame, kinds: dict[str, str], keep: list[str], per: float = 10.0) -> DataFrame:
    """One row for each kind of action a plan holds, per share.  kinds: action type to the column of its ratio per ``per`` shares."""
    each = F.array(*(F.struct(F.lit(k).alias("action_type"), (F.coalesce(F.col(c), F.lit(0.0)) / per).alias("ratio")) for k, c in kinds.items()))
    return plans.select(*keep, F.explode(each).alias("a")).where("a.ratio > 0").select(*keep, "a.action_type", "a.ratio")


def related_symbols(rows: DataFrame, column: str, keep: list[str], pattern: str = r"^\d{6}\.(SH|SZ)$") -> DataFrame:
    """The symbols of a list in text, separated by commas or semicolons; what does not fit the pattern is left out."""
    parts = F.transform(F.split(F.upper(column), "[,;]"), lambda x: F.trim(x))
    return rows.select(*keep, F.explode(F.array_distinct(F.filter(parts, lambda x: x.rlike(pattern)))).alias("related"))


def keyword_balance(text: Column | str, positive: dict[str, float], negative: dict[str, float]) -> Column:
    """(p - n) / (p + n) over the weights of the words that occur, each counted once; 0 without any."""
    t = F.col(text) if isinstance(text, str) else text
    side = lambda words: sum((F.when(t.contains(w), x).otherwise(0.0) for w, x in words.items()), F.lit(0.0))
    p, n = side(positive), side(negative)
    return F.coalesce(F.try_divide(p - n, p + n), F.lit(0.0))


def priority_top(parts: list[DataFrame], n: int) -> DataFrame:
    """The first ``n`` symbols of several ranked lists (symbol, score), earlier lists first, each symbol once."""
    ranked = None
    for i, p in enumerate(parts):
        q = p.select("symbol", F.lit(i).alias("list"), F.col("score").cast("double").alias("score"))
        ranked = q if ranked is None else ranked.unionByName(q)
    best = ranked.groupBy("symbol").agg(F.min(F.struct("list", (-F.col("score")).alias("neg"))).alias("b"))
    top = best.select("symbol", "b.list", (-F.col("b.neg")).alias("score")).orderBy("list", F.col("score").desc_nulls_last(), "symbol").limit(n)
    return top.withColumn("position", F.row_number().over(W.orderBy("list", F.col("score").desc_nulls_last(), "symbol")))


def resolved(instruments: DataFrame, text: str, most: int = 20) -> DataFrame:
    """Instruments whose code begins with the text or whose name holds it; the living first."""
    hit = F.upper("symbol").startswith(text.upper()) | F.col("name").contains(text)
    found = instruments.where(hit).withColumn("live", F.col("delist_date").isNull())
    return found.orderBy(F.col("live").desc(), "symbol").limit(most)


def page(rows: DataFrame, order: list[str], offset: int, size: int) -> DataFrame:
    """One page in a stable order, with the honest total on each row."""
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    return rows.orderBy(*order).offset(offset).limit(size).join(F.broadcast(total))


def without_orphans(rows: DataFrame, universe: DataFrame) -> DataFrame:
    return rows.join(universe.select("symbol").distinct(), "symbol", "left_semi")
