"""Schemas that drift between files (problem 2).

The declared columns of all files (their header schemas) are read in parallel, spellings of types are folded to one
name, and each file is compared with the file delivered just before it in its feed.  The differences form an ordered log
of each feed (``change_log``), and types are folded through a promotion lattice (``widest_of``): along each column for the
log, and over all files for the union schema, to which every record is cast.

A column that goes and one that comes are one renamed column if they hold the same content in the records that both
files hold (each file repeats the last records of the one before).

A column lives in one feed, from the file where it comes to the one where it goes, through all its names (``lineages``).
Columns of several feeds that share names become one column of the union, unless that would put two columns of one file
into one: then each keeps to its own names, what still clashes is numbered, and the mapping says so (``clash``).

Defined results: a file without declared columns has none, so all of the file before it are removed; null names are
ignored; files delivered at one moment follow one another by file_id; repeated declarations count once; payloads that
are no JSON objects hold no values; keys of a record that its file does not declare go to the column of their name where
no declared column gives a value.  Feeds with most of the files are taken apart by delivery month.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeforge.operators.asof import lag_in_blocks, running_in_blocks
from lakeforge.session import cut

#: Spellings of types (lower case) and the type each stands for.
TYPE_SPELLINGS = {
    "string": "string", "utf8": "string", "varchar": "string", "text": "string", "str": "string", "char": "string", "largeutf8": "string",
    "float64": "double", "f64": "double", "double": "double", "float": "double", "float32": "double", "f32": "double", "real": "double",
    "int64": "bigint", "i64": "bigint", "bigint": "bigint", "long": "bigint", "int": "bigint", "int32": "bigint", "i32": "bigint", "integer": "bigint",
    "boolean": "boolean", "bool": "boolean",
    "date": "date", "date32": "date",
    "datetime": "timestamp", "timestamp": "timestamp", "timestamptz": "timestamp",
}
#: The lattice: numbers widen along the first chain, days along the second; everything else meets in string.
CHAINS = (("boolean", "bigint", "double"), ("date", "timestamp"))
TOP = "string"


def plain_type(dtype: Column) -> Column:
    """The type a spelling stands for; unknown spellings stand for themselves, in lower case."""
    low = F.lower(F.trim(F.regexp_replace(dtype, r"\(.*\)$", "")))
    known = F.create_map(*(F.lit(x) for kv in TYPE_SPELLINGS.items() for x in kv))
    return F.coalesce(known[low], low)


def previous_files(files: DataFrame) -> DataFrame:
    """file_id, feed, delivered_at and previous_id: the file delivered just before in the feed."""
    f = files.select("file_id", "feed", "delivered_at").where("file_id is not null").dropDuplicates(["file_id"])
    return lag_in_blocks(f, ["feed"], F.date_trunc("month", "delivered_at"), ["delivered_at", "file_id"], "file_id", "previous_id")


def same_text(value: Column) -> Column:
    """One text for equal values: numbers (also as text) by value, everything else trimmed."""
    number = value.try_cast("double")
    return F.when(number.isNotNull(), number.cast("string")).otherwise(F.lower(F.trim(value)))


def schema_changes(files: DataFrame, columns: DataFrame, records: DataFrame, key: list[str], least_shared: int = 1) -> DataFrame:
    """file_id, change_kind, old_name, new_name, old_type, new_type: one row for each difference to the file before."""
    declared = columns.where("file_id is not null and column_name is not null").groupBy("file_id", "column_name").agg(F.min_by(plain_type(F.col("dtype")), "ordinal").alias("type"))
    # each intermediate is metadata (one row a file or column) used several times: written once, not planned again
    order = cut(previous_files(files).where("previous_id is not null").select("file_id", "previous_id"))
    now = order.join(declared, "file_id").select("file_id", F.col("column_name").alias("name"), F.col("type").alias("new_type"))
    then = order.join(declared.withColumnRenamed("file_id", "previous_id"), "previous_id").select("file_id", F.col("column_name").alias("name"), F.col("type").alias("old_type"))
    both = cut(then.join(now, ["file_id", "name"], "full").where("old_type is null or new_type is null or old_type <> new_type"))
    # names and types are few for each file: the differences of a file are gathered by kind
    moved = both.where("old_type is null or new_type is null")
    retyped = both.where("old_type <> new_type").select("file_id", F.lit("retyped").alias("change_kind"), F.col("name").alias("old_name"), F.col("name").alias("new_name"), "old_type", "new_type")
    gone = moved.where("new_type is null").select("file_id", F.col("name").alias("old_name"), "old_type")
    come = moved.where("old_type is null").select("file_id", F.col("name").alias("new_name"), "new_type")
    pairs = cut(renamed_columns(order, gone, come, records, key, least_shared))
    renamed = pairs.join(gone, ["file_id", "old_name"]).join(come, ["file_id", "new_name"]).select("file_id", F.lit("renamed").alias("change_kind"), "old_name", "new_name", "old_type", "new_type")
    removed = gone.join(pairs, ["file_id", "old_name"], "left_anti").select("file_id", F.lit("removed").alias("change_kind"), "old_name", F.lit("").alias("new_name"), "old_type", F.lit(None).cast("string").alias("new_type"))
    added = come.join(pairs, ["file_id", "new_name"], "left_anti").select("file_id", F.lit("added").alias("change_kind"), F.lit("").alias("old_name"), "new_name", F.lit(None).cast("string").alias("old_type"), "new_type")
    return reduce(DataFrame.unionByName, (retyped, renamed, removed, added))


def renamed_columns(order: DataFrame, gone: DataFrame, come: DataFrame, records: DataFrame, key: list[str], least_shared: int = 1) -> DataFrame:
    """file_id, old_name, new_name: pairs with the same content in the shared records.

    Content is compared by joining equal values of one record, never by pairing all columns: a pair counts if the values
    agree in every shared record in which both are given.  Of several partners the one with most agreement is taken."""
    both = gone.groupBy("file_id").agg(F.collect_set("old_name").alias("old")).join(come.groupBy("file_id").agg(F.collect_set("new_name").alias("new")), "file_id")
    asked = order.join(both, "file_id")
    # records are parsed after the join: only those of files with columns that go and come
    later = _cells(records, asked.select("file_id", F.col("file_id").alias("of"), F.col("new").alias("names")), key)
    earlier = _cells(records, asked.select(F.col("previous_id").alias("file_id"), F.col("file_id").alias("of"), F.col("old").alias("names")), key)
    later, earlier = cut(later.withColumnRenamed("name", "new_name")), cut(earlier.withColumnRenamed("name", "old_name"))
    record = ["of", *key]
    same = later.join(earlier, [*record, "v"]).groupBy("of", "old_name", "new_name").agg(F.count(F.lit(1)).alias("same")).where(F.col("same") >= least_shared)
    given = same.join(earlier.drop("v"), ["of", "old_name"]).join(later.drop("v"), [*record, "new_name"]).groupBy("of", "old_name", "new_name", "same").agg(F.count(F.lit(1)).alias("given"))
    good = given.where("same = given")
    best = lambda side: W.partitionBy("of", side).orderBy(F.col("same").desc(), "old_name", "new_name")
    good = good.withColumn("a", F.row_number().over(best("old_name"))).withColumn("b", F.row_number().over(best("new_name")))
    return good.where("a = 1 and b = 1").select(F.col("of").alias("file_id"), "old_name", "new_name")


def _cells(records: DataFrame, asked: DataFrame, key: list[str]) -> DataFrame:
    """of, the record's key, name and value of the asked names; of repeated records of a file the greatest value."""
    r = records.select("file_id", "payload").join(asked, "file_id").select("of", "names", F.from_json("payload", "map<string,string>").alias("values")).where("values is not null")
    cells = F.transform("names", lambda n: F.struct(n.alias("name"), same_text(F.col("values")[n]).alias("v")))
    long = r.select("of", *(F.col("values")[k].alias(k) for k in key), F.explode(cells).alias("c")).where("c.v is not null")
    return long.groupBy("of", *key, F.col("c.name").alias("name")).agg(F.max("c.v").alias("v"))


def widest_of(types: Column) -> Column:
    """The least type of the lattice that holds all of an array of plain types."""
    has = lambda *ts: F.exists(types, lambda t: t.isin(*ts))
    mixed = F.exists(types, lambda t: ~t.isin(*CHAINS[0], *CHAINS[1])) | (has(*CHAINS[0]) & has(*CHAINS[1]))
    out = F.when(mixed, TOP)
    for chain in CHAINS:
        for t in reversed(chain):
            out = out.when(has(t), t)
    return out.otherwise(TOP)


#: One bit for each type of the lattice, so that a running set of types is a number.
_BITS = {t: 1 << i for i, t in enumerate((*CHAINS[0], *CHAINS[1], TOP))}


def type_bit(plain: Column) -> Column:
    known = F.create_map(*(x for t, b in _BITS.items() for x in (F.lit(t), F.lit(b))))
    return F.coalesce(known[plain], F.lit(_BITS[TOP])).cast("bigint")


def widest_of_bits(bits: Column) -> Column:
    return widest_of(F.filter(F.array(*(F.when(bits.bitwiseAND(F.lit(b)) > 0, F.lit(t)) for t, b in _BITS.items())), lambda t: t.isNotNull()))


def _declared(files: DataFrame, columns: DataFrame) -> DataFrame:
    """feed, delivered_at, file_id, name and plain type of every declared column, once."""
    f = files.select("file_id", "feed", "delivered_at").where("file_id is not null").dropDuplicates(["file_id"])
    c = columns.where("file_id is not null and column_name is not null").groupBy("file_id", F.col("column_name").alias("name")).agg(F.min_by(plain_type(F.col("dtype")), "ordinal").alias("type"))
    return c.join(f, "file_id")


def lineages(files: DataFrame, columns: DataFrame, changes: DataFrame) -> DataFrame:
    """feed, delivered_at, file_id, name, type and ``line`` of every declared column: the name of its life in the feed.

    A stretch of one name starts where the name comes (or the feed begins) and is named by that file and name; stretches
    are linked by renames, and each takes the name of the first of its chain (links are doubled until none moves)."""
    declared = _declared(files, columns)
    come = changes.where("new_name <> '' and change_kind <> 'retyped'").select("file_id", F.col("new_name").alias("name"), F.lit(True).alias("_new"))
    first = previous_files(files).where("previous_id is null").select("file_id", F.lit(True).alias("_first"))
    begun = declared.join(come, ["file_id", "name"], "left").join(first, "file_id", "left")
    start = F.when(F.col("_new") | F.col("_first"), F.struct("delivered_at", "file_id"))
    held = running_in_blocks(begun, ["feed", "name"], F.date_trunc("month", "delivered_at"), ["delivered_at", "file_id"], start, F.max, "_start")
    held = cut(held.select(*declared.columns, F.concat_ws("/", F.col("_start.file_id").cast("string"), "name").alias("stretch")))
    before = previous_files(files).where("previous_id is not null").select("file_id", "previous_id")
    renamed = changes.where("change_kind = 'renamed'").join(before, "file_id")
    old = held.select(F.col("file_id").alias("previous_id"), F.col("name").alias("old_name"), F.col("stretch").alias("parent"))
    links = cut(renamed.join(old, ["previous_id", "old_name"]).select(F.concat_ws("/", F.col("file_id").cast("string"), "new_name").alias("stretch"), "parent"))
    while True:
        up = links.select(F.col("stretch").alias("parent"), F.col("parent").alias("above"))
        links = cut(links.join(up, "parent", "left").select("stretch", F.coalesce("above", "parent").alias("parent"), F.col("above").isNotNull().alias("moved")))
        if links.where("moved").isEmpty():
            break
        links = links.drop("moved")
    return held.join(links.select("stretch", "parent"), "stretch", "left").select(*declared.columns, F.coalesce("parent", "stretch").alias("line"))


def column_mapping(lines: DataFrame, preferred: list[str]) -> DataFrame:
    """``lines`` with ``canonical``, the column of the union, and ``clash``: whether sharing names would have put two columns of one file
    into one.

    Lines of equal names are one vertex, and vertices that share a name (apart from case and underscores) are joined by
    passing on the least label until none moves: work on the vocabulary of names, by joins, whatever its size."""
    plain = lambda c: F.lower(F.replace(c, F.lit("_"), F.lit("")))
    named = lines.groupBy("line").agg(F.array_sort(F.collect_set("name")).alias("names"), F.min(F.struct("delivered_at", "file_id", "name")).alias("_first"))
    named = cut(named.withColumn("vertex", F.sha2(F.to_json("names"), 256)))
    edges = cut(named.select("vertex", F.explode("names").alias("name")).select("vertex", plain(F.col("name")).alias("word")).distinct())
    label = edges.select("vertex").distinct().withColumn("label", F.col("vertex"))
    while True:
        words = edges.join(label, "vertex").groupBy("word").agg(F.min("label").alias("label"))
        new = edges.join(words, "word").groupBy("vertex").agg(F.min("label").alias("new"))
        label = cut(label.join(new, "vertex").select("vertex", F.col("new").alias("label"), (F.col("new") != F.col("label")).alias("moved")))
        if label.where("moved").isEmpty():
            break
        label = label.drop("moved")
    of = named.join(label.select("vertex", "label"), "vertex")
    rank = lambda n: F.when(n.isin(preferred), F.array_position(F.array(*map(F.lit, preferred)), n)).otherwise(len(preferred) + 1) if preferred else F.lit(1)
    best = of.select("label", F.explode("names").alias("n")).groupBy("label").agg(F.min(F.struct(rank(F.col("n")).alias("r"), F.col("n").alias("n"))).alias("b")).select("label", F.col("b.n").alias("shared"))
    at = lines.join(of.select("line", "label"), "line")
    double = at.groupBy("file_id", "label").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("label").distinct().withColumn("clash", F.lit(True))
    own = F.coalesce(F.get(F.filter(F.array(*map(F.lit, preferred)), lambda p: F.array_contains("names", p)), F.lit(0)) if preferred else F.lit(None), F.col("_first.name"))
    told = of.join(best, "label").join(double, "label", "left").withColumn("clash", F.coalesce("clash", F.lit(False)))
    told = cut(told.select("line", "_first", "clash", F.when(F.col("clash"), own).otherwise(F.col("shared")).alias("canonical")))
    # lines of one feed that clash even under their own names are numbered in order of their coming
    feeds = lines.groupBy("line").agg(F.min("feed").alias("feed"))
    clashing = told.where("clash").join(feeds, "line").withColumn("n", F.row_number().over(W.partitionBy("feed", "canonical").orderBy("_first", "line")))
    clashing = clashing.select("line", F.when(F.col("n") > 1, F.concat_ws("__", "canonical", F.col("n").cast("string"))).otherwise(F.col("canonical")).alias("canonical"), "clash")
    return cut(lines.join(told.where("not clash").select("line", "canonical", "clash").unionByName(clashing), "line"))


def change_log(changes: DataFrame, mapping: DataFrame) -> DataFrame:
    """The differences of each feed in order (``change_no`` from 1), with the type that holds all types the column has had up
    to that file."""
    month = F.date_trunc("month", "delivered_at")
    typed = running_in_blocks(mapping, ["line"], month, ["delivered_at", "file_id"], type_bit(F.col("type")), F.bit_or, "_bits")
    at = typed.select("file_id", F.col("name").alias("new_name"), widest_of_bits(F.col("_bits")).alias("union_type"), "canonical")
    files = mapping.groupBy("file_id").agg(F.first("feed").alias("feed"), F.first("delivered_at").alias("delivered_at"))
    log = changes.join(files, "file_id").join(at, ["file_id", "new_name"], "left").withColumn("_one", F.lit(1))
    order = ["delivered_at", "file_id", "change_kind", "old_name", "new_name"]
    log = running_in_blocks(log, ["feed"], month, order, F.col("_one"), F.sum, "change_no")
    return log.select("feed", "change_no", "file_id", "change_kind", "old_name", "new_name", "old_type", "new_type", "canonical", "union_type")


def union_schema(mapping: DataFrame) -> DataFrame:
    """canonical, dtype and the number of files of each column: the declared types folded through the lattice."""
    return mapping.groupBy("canonical").agg(widest_of(F.collect_set("type")).alias("dtype"), F.countDistinct("file_id").alias("n_files"))


def _placed(files: DataFrame, records: DataFrame, mapping: DataFrame) -> DataFrame:
    """feed, delivered_at, file_id, row_no and ``e``: the given values of each record under the names of the union."""
    feeds = files.select("file_id", "feed", "delivered_at").where("file_id is not null").dropDuplicates(["file_id"])
    names = mapping.groupBy("file_id").agg(F.map_from_entries(F.collect_list(F.struct("name", "canonical"))).alias("names"))  # one file's header
    r = records.select("file_id", "row_no", "payload").join(feeds, "file_id").join(names, "file_id", "left")
    r = r.withColumn("values", F.from_json("payload", "map<string,string>")).where("values is not null")
    entries = F.transform(F.map_entries("values"), lambda e: F.struct(F.col("names")[e["key"]].isNull().alias("loose"), F.coalesce(F.col("names")[e["key"]], e["key"]).alias("key"), e["value"].alias("value")))
    # what is declared comes before what is not
    return r.select("feed", "delivered_at", "file_id", "row_no", F.array_sort(F.filter(entries, lambda e: e["value"].isNotNull())).alias("e"))


def union_cells(files: DataFrame, records: DataFrame, mapping: DataFrame) -> DataFrame:
    """Every given value as a row (feed, delivered_at, file_id, row_no, canonical, value): the union of any number of columns."""
    r = _placed(files, records, mapping)
    long = r.select("feed", "delivered_at", "file_id", "row_no", F.explode("e").alias("c"))
    return long.groupBy("feed", "delivered_at", "file_id", "row_no", F.col("c.key").alias("canonical")).agg(F.min(F.struct("c.loose", "c.value")).alias("m")).select("feed", "delivered_at", "file_id", "row_no", "canonical", F.col("m.value").alias("value"))


def union_table(files: DataFrame, records: DataFrame, mapping: DataFrame, schema: list[tuple[str, str]], key: list[str]) -> DataFrame:
    """Every record of a feed once (the latest delivery wins), with the columns of ``schema``, cast without failing.

    The schema is a list, as any table's; unions of more columns than a table can have are ``union_cells``."""
    cell = lambda n: F.filter("e", lambda x: x["key"] == n)
    r = _placed(files, records, mapping).select("feed", "delivered_at", "file_id", "row_no", *(F.when(F.size(cell(n)) > 0, cell(n)[0]["value"]).try_cast(t).alias(n) for n, t in schema))
    rest = [n for n, _ in schema if n not in key]
    best = r.groupBy("feed", *key).agg(F.max(F.struct("delivered_at", "file_id", "row_no", *rest)).alias("b"))
    return best.select("feed", *key, *(F.col("b")[n].alias(n) for n in rest))
