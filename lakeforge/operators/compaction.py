"""Far too many small files (problem 1): size-tiered incremental compaction.

Runs (stored fragments) of one merge unit are merged level by level: at each level the runs of a size tier up to
that level are ordered by size and merged ``fan_in`` at a time, so that bytes move only among runs of like size.
The levels are planned on metadata alone (one row a file and unit).  A unit is a block of a session (``block`` cuts long
sessions, however long), and the units of a period are dealt to 2^k packed files by hash, so that a file has at most about
``target_bytes`` and keeps its units until the period has doubled.

A packed file is one transaction, named by its place and the contents of its runs: their units, input files, row counts
and sizes.  It is carried out in three steps below ``store``: ``data`` gets its rows, ``journal`` the line of every merge
in it, and ``finished`` its name, in one file.  A rerun plans the same names, leaves finished ones as they lie, replaces
what an interrupted run left of others, and after new deliveries only the files are written whose units got new runs.
Counts after the merge are taken from the written files.

Defined results: rows with a null merge key are kept and merged by null-safe grouping; the same row in several
files stays once, the latest ``fetched_at`` winning; files without rows take part in no merge; an empty table
gives an empty journal; further columns are carried along; nothing is dropped.
"""

from __future__ import annotations

import uuid
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lakeforge.functions.joins import null_safe_join, possible
from lakeforge.session import cut, shared_folder
from lakeforge.sources.files import exists

#: Rows of a unit (of all its files) from which it is folded before its rows are shuffled to their file.
CROWDED_ROWS = 1 << 17
#: Names of the columns that say where a row goes; input columns must not bear them.
BLOCK, PERIOD, FILE, TX = "_block", "_period", "_file", "_tx"


def partition_label(path: str = "file_path", column: str = "trade_date") -> Column:
    return F.regexp_extract(path, column + "=([^/]*)/", 1)


def fragments(rows: DataFrame, files: DataFrame, unit: list[str]) -> DataFrame:
    """One row for each unit and file: rows, bytes (the file's, in proportion), a print of the file's contents (files are
    never rewritten: id, size and time of writing say them) and the directory the file lies in."""
    counts = rows.groupBy(*unit, "file_id").agg(F.count(F.lit(1)).alias("n_rows"))
    about = files.select(
        "file_id", F.col("n_rows").alias("file_rows"), F.col("n_bytes").alias("file_bytes"), partition_label().alias("label"), F.xxhash64("file_id", "n_rows", "n_bytes", "written_at").alias("print")
    ).dropDuplicates(["file_id"])
    share = F.col("n_rows") * F.coalesce(F.try_divide("file_bytes", "file_rows"), F.lit(64.0))
    return counts.join(about, "file_id", "left").withColumn("n_bytes", F.ceil(share).cast("bigint")).drop("file_rows", "file_bytes")


def numbered(runs: DataFrame, unit: list[str]) -> DataFrame:
    """Adds ``at``: the place of a run in its unit, like sizes together.

    Runs are counted by blocks (a quarter of a doubling in size, then the head of the name's hash), and the runs of a block
    are numbered from the count of those before it, so a unit with most of the runs is no single task."""
    block = ["_size", "_head"]
    r = runs.withColumns({"_size": F.floor(F.log2(F.greatest(F.col("n_bytes"), F.lit(1)).cast("double")) * 4), "_hash": F.xxhash64("run_id")}).withColumn("_head", F.shiftrightunsigned("_hash", 58))
    n = r.groupBy(*unit, *block).agg(F.count(F.lit(1)).alias("_n"))
    before = n.withColumn("_before", F.coalesce(F.sum("_n").over(W.partitionBy(*unit).orderBy(*block).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    inside = r.withColumn("_in", F.row_number().over(W.partitionBy(*unit, *block).orderBy("_hash", "run_id")))
    return null_safe_join(inside, before, [*unit, *block]).withColumn("at", F.col("_before") + F.col("_in") - 1).drop("_before", "_in", "_hash", *block)


def merge_levels(runs: DataFrame, unit: list[str], fan_in: int = 32, base_bytes: int = 4096) -> tuple[DataFrame, DataFrame]:
    """Plans all merges of runs (unit, run_id, n_rows, n_bytes, n_files).  Returns the final runs and the journal."""
    tier = F.when(F.col("n_bytes") <= base_bytes, 0).otherwise(F.floor(F.log(float(fan_in), F.col("n_bytes") / base_bytes)) + 1).cast("int")
    runs = runs.select(*unit, "run_id", "n_rows", "n_bytes", "n_files")
    top = runs.groupBy(*unit).agg(F.count(F.lit(1)).alias("n"), F.max(tier).alias("t")).agg(F.max("n").alias("n"), F.max("t").alias("t")).first()
    most, last_tier, journal = top["n"] or 0, top["t"] or 0, []
    level = 0
    while most > 1:
        due = runs.withColumn("due", tier <= level)
        packs = numbered(due.where("due"), unit).withColumn("pack", F.floor(F.col("at") / fan_in))
        merged = (
            packs.groupBy(*unit, "pack")
            .agg(F.sort_array(F.collect_list("run_id")).alias("inputs"), F.sum("n_rows").alias("n_rows"), F.sum("n_bytes").alias("n_bytes"), F.sum("n_files").alias("n_files"))
            .withColumn("run_id", F.when(F.size("inputs") == 1, F.col("inputs")[0]).otherwise(F.sha2(F.concat_ws(",", "inputs"), 256)))
        )
        merged = cut(merged.select(*unit, "inputs", "run_id", "n_rows", "n_bytes", "n_files"))
        journal.append(merged.where(F.size("inputs") > 1).withColumn("level", F.lit(level)))
        runs = merged.drop("inputs").unionByName(due.where(~F.col("due")).drop("due"))
        if level >= last_tier:
            most = runs.groupBy(*unit).count().agg(F.max("count").alias("n")).first()["n"]
        level += 1
    names = [*unit, "level", "run_id", "inputs", "n_files", "n_rows", "n_bytes"]
    if not journal:
        return runs, runs.select(*unit, F.lit(0).alias("level"), "run_id", F.array("run_id").alias("inputs"), "n_files", "n_rows", "n_bytes").limit(0)
    return runs, reduce(DataFrame.unionByName, journal).select(*names)


class Compacted(NamedTuple):
    """units: counts before and after of each session; journal: every merge; rows: every key once, as written; packed: periods
    with their files, sessions, rows and bytes before and after."""

    units: DataFrame
    journal: DataFrame
    rows: DataFrame
    packed: DataFrame


def compact(rows: DataFrame, files: DataFrame, unit: list[str], key: list[str], fan_in: int = 32, target_bytes: int = 128 << 20) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(units, journal, rows) of a compaction into a new folder of its own."""
    done = carry_out(rows, files, unit, key, f"{shared_folder(rows.sparkSession)}/compacted-{uuid.uuid4().hex}", F.lit(""), fan_in, target_bytes)
    return done.units, done.journal, done.rows


def carry_out(rows: DataFrame, files: DataFrame, session: list[str], key: list[str], store: str, period: Column, fan_in: int = 32, target_bytes: int = 128 << 20, block: Column | None = None) -> Compacted:
    """Plans the merges, writes what ``store`` does not hold finished, and counts what is written.

    period: the part of the store a session belongs to; periods are bounded by the calendar.  block: cuts a session."""
    spark = rows.sparkSession
    placed = rows.withColumns({BLOCK: (F.lit(0) if block is None else block).cast("bigint"), PERIOD: F.coalesce(period.cast("string"), F.lit("none"))})
    unit = [*session, BLOCK]
    parts = cut(fragments(placed, files, [*unit, PERIOD]))
    runs, plan = merge_levels(parts.withColumn("run_id", F.col("file_id").cast("string")).withColumn("n_files", F.lit(1).cast("bigint")), [*unit, PERIOD], fan_in)

    # a period has 2^k files: only when it has doubled do its units move to other files
    sizes = parts.groupBy(PERIOD).agg(F.sum("n_bytes").alias("_bytes"))
    counts = cut(sizes.select(PERIOD, F.pow(F.lit(2.0), F.greatest(F.lit(0.0), F.ceil(F.log2(F.greatest(F.col("_bytes") / F.lit(float(target_bytes)), F.lit(1.0)))).cast("double"))).cast("int").alias("_files")))
    file_of = lambda df: df.join(F.broadcast(counts), PERIOD).withColumn(FILE, F.pmod(F.xxhash64(*unit), F.col("_files")).cast("int"))
    prints = parts.groupBy(*unit, PERIOD).agg(F.bit_xor(F.xxhash64("file_id", "n_rows", "print")).alias("print"))
    lines = file_of(null_safe_join(runs.select(*unit, PERIOD, "run_id"), prints, [*unit, PERIOD])).withColumn("_line", F.xxhash64(*unit, "run_id", "print"))
    named = lines.groupBy(PERIOD, FILE, "_files").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("_line").alias("x"), F.sum(F.shiftrightunsigned("_line", 24)).alias("s"))
    name = F.shiftrightunsigned(F.xxhash64(PERIOD, "_files", FILE, "n", "x", "s"), 1)  # a number: rows are sorted by it quickly
    planned = cut(named.select(PERIOD, FILE, name.alias(TX)))  # one row a packed file
    if not planned.groupBy(TX).count().where("count > 1").isEmpty():
        raise RuntimeError("two packed files have one name")

    finished, stored, journal = f"{store}/finished", f"{store}/data", f"{store}/journal"
    again = exists(spark, finished)
    todo = cut(planned.join(spark.read.schema(f"{TX} bigint").parquet(finished), TX, "left_anti")) if again else planned
    if not again or not todo.isEmpty():
        own = file_of(placed)
        if again:
            own = own.join(todo.select(PERIOD, FILE), [PERIOD, FILE], "left_semi")
        # rows move once, to their file.  Units of so many rows that they must hold repeats are folded before that, and with
        # them the rows that share their hash buckets
        crowded = parts.groupBy(*unit).agg(F.sum("n_rows").alias("n")).where(F.col("n") > CROWDED_ROWS)
        folded = merged_rows(possible(own, crowded, unit).select(PERIOD, FILE, *rows.columns), [PERIOD, FILE, *session], key)
        direct = possible(own, crowded, unit, others=True).select(*folded.columns)
        named = direct.unionByName(folded).repartition(PERIOD, FILE).join(todo, [PERIOD, FILE])
        # folded in the order of session and key; the files are then told apart by a sort on the number alone
        _replace(merged_rows(named, session, [*key, TX, PERIOD, FILE]).select(TX, *rows.columns), stored)
        of = file_of(plan).join(todo, [PERIOD, FILE]).select(TX, *plan.columns)
        _replace(of.repartition(TX), journal)
        todo.select(TX).coalesce(1).write.mode("append").parquet(finished)

    mine = planned.select(TX)
    data = spark.read.schema(StructType([*rows.schema, StructField(TX, LongType())])).parquet(stored).join(mine, TX, "left_semi")
    before = parts.groupBy(*session).agg(F.countDistinct("file_id").alias("files_before"), F.countDistinct(F.nullif("label", F.lit(""))).alias("partitions_before"), F.sum("n_rows").alias("rows_before"))
    after = data.groupBy(*session).agg(F.count(F.lit(1)).alias("rows_after"))
    told = spark.read.schema(StructType([*plan.schema, StructField(TX, LongType())])).parquet(journal).join(mine, TX, "left_semi").select(*plan.columns)
    was = parts.groupBy(PERIOD).agg(F.countDistinct("file_id").alias("files_before"), F.count_distinct(*(F.struct(F.col(c)) for c in session)).alias("sessions"), F.sum("n_rows").alias("rows_before"), F.sum("n_bytes").alias("bytes_before"))
    now = data.groupBy(TX).agg(F.count(F.lit(1)).alias("n")).join(planned, TX).groupBy(PERIOD).agg(F.count(F.lit(1)).alias("files_after"), F.sum("n").alias("rows_after"))
    return Compacted(null_safe_join(before, after, session), told, data.select(*rows.columns), was.join(now, PERIOD).withColumnRenamed(PERIOD, "period"))


def _replace(rows: DataFrame, path: str) -> None:
    """Writes each transaction's rows to one file, in place of any that an interrupted run left."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(TX).parquet(path)


def merged_rows(rows: DataFrame, unit: list[str], key: list[str]) -> DataFrame:
    """Each key once, whole, from the latest fetch; partial aggregation before the shuffle keeps repeats local."""
    keys = [*unit, *key]
    rest = [c for c in rows.columns if c not in keys]
    rank = F.struct(*(F.col(c) for c in dict.fromkeys([*(x for x in ("fetched_at",) if x in rest), *rest])))
    return rows.groupBy(*keys).agg(F.max(rank).alias("_best")).select(*keys, *(F.col("_best")[c].alias(c) for c in rest))
