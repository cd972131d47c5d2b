"""Best representative of each duplicate group (problem 6): Bayesian fusion with copy detection.

Each source of a group claims a value for each field (that of its highest version, then latest fetch).  Accuracies of the
sources and the dependence of each pair of sources, seen in false values they share, are estimated in turns until the
accuracies stand; a copier's vote is discounted by the probability that it copies.  A claim's posterior is its prior times
the likelihood of all votes, and the claim of the greatest posterior is the field's representative.

The prior is the caller's.  ``precedence`` is a prior of orders: each of its columns outweighs, by odds beyond any votes,
the columns after it and the votes themselves, so posteriors are compared column by column, the votes last (they settle
what the prior leaves open).  Without it the prior is even and the votes decide alone.

All votes of one agreement pattern (which sources say the same) count alike, so the estimation works on the distinct
patterns with their frequencies: rows the size of a group's sources, not of the table, in every round.

Defined results: null keys form groups like others; a field without any value in a group has no representative; exact
repeats change nothing; rows without a source claim, and vote with the accuracy first assumed; null versions and fetch
times rank lowest; remaining ties go to the greatest source name (precedence) or the greatest value (votes alone).
Groups are folded to one row a source before they meet in one place, so a hot group has as many claims as it has sources.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.functions.columns import version_number
from lakeforge.functions.joins import possible
from lakeforge.operators.best import NEVER, fetch_order, with_trust
from lakeforge.session import cut

FIRST_ACCURACY = 0.8
COPIED = 0.8  # the share of a copier's values that is copied


def claims(rows: DataFrame, key: list[str], fields: dict[str, Column], trust: DataFrame, least_rows: int = 2) -> DataFrame:
    """Key, field_name and the array of claims (one a source) of each field, in groups of ``least_rows`` rows or more.

    fields: by name, the value a row claims (null for none)."""
    many = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") >= least_rows)
    # rows of groups that are surely smaller are left out before they are shuffled with their fields
    seen = with_trust(possible(rows, many, key), trust).withColumns({"_n": F.coalesce(version_number("data_version"), F.lit(-1)), "_v": F.coalesce("data_version", F.lit("")), "_at": fetch_order()})
    cell = lambda f, v: F.max(F.when(v.isNotNull(), F.struct("_n", "_v", "_at", F.col("data_version").alias("_dv"), v.alias("_value")))).alias("_f_" + f)
    folded = seen.groupBy(*key, "source").agg(F.count(F.lit(1)).alias("_rows"), F.min("_trust").alias("_trust"), *(cell(f, v) for f, v in fields.items()))
    names = ["_f_" + f for f in fields]
    met = folded.groupBy(*key).agg(F.sum("_rows").alias("_rows"), F.collect_list(F.struct("source", "_trust", *names)).alias("_c")).where(F.col("_rows") >= least_rows)
    claim = lambda f: lambda c: F.struct(
        c["source"].alias("source"), (-c["_trust"]).alias("trust"), c["_f_" + f]["_n"].alias("number"), c["_f_" + f]["_v"].alias("version"), c["_f_" + f]["_at"].alias("at"),
        c["_f_" + f]["_dv"].alias("data_version"), c["_f_" + f]["_value"].cast("string").alias("value"),
    )
    given = lambda f: F.filter("_c", lambda c: c["_f_" + f].isNotNull())
    each = F.array(*(F.struct(F.lit(f).alias("field_name"), F.transform(given(f), claim(f)).alias("claims")) for f in fields))
    return met.select(*key, F.explode(each).alias("_e")).select(*key, "_e.field_name", "_e.claims").where(F.size("claims") > 0)


def patterns(items: DataFrame) -> DataFrame:
    """pid, n and members (source and class of equal values) of every agreement pattern of several sources."""
    named = F.filter("claims", lambda c: c["source"].isNotNull())
    values = F.array_sort(F.array_distinct(F.transform("_named", lambda c: c["value"])))
    member = lambda c: F.struct(c["source"].alias("s"), F.array_position(F.col("_values"), c["value"]).cast("int").alias("k"))
    of = items.withColumn("_named", named).where(F.size("_named") > 1).withColumn("_values", values)
    # a hash names the pattern; the array travels once a pattern
    p = of.select(F.array_sort(F.transform("_named", member)).alias("members")).groupBy("members").agg(F.count(F.lit(1)).alias("n"))
    return p.select(F.sha2(F.to_json("members"), 256).alias("pid"), "n", "members")


def estimated_sources(items: DataFrame, rounds: int = 10, close: float = 1e-3, prior_copy: float = 0.1, false_values: int = 10) -> DataFrame:
    """source, accuracy and weight (the share of its votes that is its own) of every source that meets another.

    rounds: estimation ends when no accuracy moves by ``close``, at the latest after so many rounds."""
    seen = cut(patterns(items))
    members = seen.select("pid", "n", F.explode("members").alias("m")).select("pid", "n", "m.s", "m.k")
    # pairs of the sources of one pattern: as many as sources can have, whatever the number of rows
    pairs = seen.select("pid", "n", F.explode("members").alias("x"), "members").select("pid", "n", "x", F.explode(F.filter("members", lambda y: y["s"] > F.col("x.s"))).alias("y"))
    pairs = pairs.select("pid", "n", F.col("x.s").alias("s1"), F.col("y.s").alias("s2"), (F.col("x.k") == F.col("y.k")).alias("same"), F.col("x.k").alias("k"))
    accuracy = members.select("s").distinct().withColumn("accuracy", F.lit(FIRST_ACCURACY))
    # before any value is believed, dependence shows only in sources that agree more often than their accuracy explains
    shared = pairs.groupBy("s1", "s2").agg(F.lit(0).alias("kt"), F.lit(0).alias("kf"), F.sum(F.when(F.col("same"), F.col("n")).otherwise(0)).alias("ku"), F.sum(F.when(~F.col("same"), F.col("n")).otherwise(0)).alias("kd"))
    state = cut(_weighted(accuracy, shared, prior_copy, false_values))
    for _ in range(rounds):
        votes = members.join(state, "s").groupBy("pid", "k").agg(F.sum(_vote(false_values)).alias("score"))
        chosen = votes.groupBy("pid").agg(F.max(F.struct(F.round("score", 9).alias("score"), F.col("k").alias("true"))).alias("b")).select("pid", "b.true")
        chosen = cut(chosen)  # used twice below; planned apart, the driver's memory stays small
        right = members.join(chosen, "pid").withColumn("right", F.col("k") == F.col("true"))
        accuracy = right.groupBy("s").agg(((F.sum(F.when(F.col("right"), F.col("n")).otherwise(0)) + FIRST_ACCURACY) / (F.sum("n") + 1)).alias("a"))
        accuracy = accuracy.select("s", F.least(F.lit(0.99), F.greatest(F.lit(0.05), "a")).alias("accuracy"))
        count = lambda when: F.sum(F.when(when, F.col("n")).otherwise(0))
        true = F.col("k") == F.col("true")
        shared = pairs.join(chosen, "pid").groupBy("s1", "s2").agg(count(F.col("same") & true).alias("kt"), count(F.col("same") & ~true).alias("kf"), F.lit(0).alias("ku"), count(~F.col("same")).alias("kd"))
        old = state.select("s", F.col("accuracy").alias("_old"))
        new = cut(_weighted(accuracy, shared, prior_copy, false_values).join(old, "s").withColumn("_moved", F.abs(F.col("accuracy") - F.col("_old"))))
        moved = new.agg(F.max("_moved").alias("d")).first()["d"]
        state = new.select("s", "accuracy", "weight")
        if moved is None or moved < close:
            break
    return state.withColumnRenamed("s", "source")


def _vote(n: int) -> Column:
    a = F.col("accuracy")
    return F.col("weight") * F.log(n * a / (1 - a))


def _weighted(accuracy: DataFrame, shared: DataFrame, prior: float, n: int) -> DataFrame:
    """s, accuracy, weight; of a dependent pair the less accurate one is taken for the copy."""
    of = lambda i: accuracy.select(F.col("s").alias(f"s{i}"), F.col("accuracy").alias(f"a{i}"))
    p = shared.join(of(1), "s1").join(of(2), "s2").withColumn("p", dependence(prior, n))
    copy = F.when(F.col("a1") <= F.col("a2"), F.col("s1")).otherwise(F.col("s2"))
    weight = p.groupBy(copy.alias("s")).agg(F.exp(F.sum(F.log(1 - COPIED * F.col("p")))).alias("weight"))
    return accuracy.join(weight, "s", "left").select("s", "accuracy", F.coalesce("weight", F.lit(1.0)).alias("weight"))


def dependence(prior: float, n: int) -> Column:
    """Posterior probability that one of two sources copies the other, from the columns kt, kf, ku and kd (shared true, false
    and unjudged values, and different values) and the accuracies a1 and a2."""
    c = F.col
    pt, pf = c("a1") * c("a2"), (1 - c("a1")) * (1 - c("a2")) / n
    pd, a = F.greatest(F.lit(1e-9), 1 - pt - pf), (c("a1") + c("a2")) / 2
    alone = c("kt") * F.log(pt) + c("kf") * F.log(F.greatest(pf, F.lit(1e-12))) + c("ku") * F.log(pt + pf) + c("kd") * F.log(pd)
    bound = c("kt") * F.log(a * COPIED + pt * (1 - COPIED)) + c("kf") * F.log((1 - a) * COPIED + pf * (1 - COPIED) + 1e-12) + c("ku") * F.log(COPIED + (pt + pf) * (1 - COPIED)) + c("kd") * F.log(pd * (1 - COPIED))
    x = F.log(F.lit((1 - prior) / prior)) + alone - bound
    return 1 / (1 + F.exp(F.least(F.lit(700.0), F.greatest(F.lit(-700.0), x))))


#: Orders of the prior of which each outweighs what follows: version, trust, time of the fetch.
PRECEDENCE = ("number", "version", "trust", "at")


def fused(items: DataFrame, key: list[str], sources: DataFrame, precedence: tuple[str, ...] = (), false_values: int = 10) -> DataFrame:
    """Key, field_name and the claim of the greatest posterior: value, source, data_version, at, and the posterior of the
    value by votes alone."""
    item = [*key, "field_name"]
    votes = sources.select(F.col("source").alias("_s"), _vote(false_values).alias("_vote"))
    first = FIRST_ACCURACY
    plain = F.log(F.lit(false_values * first / (1 - first)))
    long = items.select(*item, F.explode("claims").alias("c")).join(votes, F.col("c.source") == F.col("_s"), "left").withColumn("_vote", F.coalesce("_vote", plain))
    order = [F.col("c")[p].alias(p) for p in precedence]
    top = F.max(F.struct(*order, F.coalesce("c.source", F.lit("")).alias("_tie"), F.col("c.source").alias("source"), F.col("c.data_version").alias("data_version"), F.col("c.at").alias("at_"))).alias("top")
    by_value = long.groupBy(*item, F.col("c.value").alias("value")).agg(F.round(F.sum("_vote"), 9).alias("score"), top)
    posterior = F.struct(*(F.col("top")[p].alias(p) for p in precedence), "score", *([F.col("top._tie").alias("_tie")] if precedence else []), "value", F.col("top.source").alias("source"), F.col("top.data_version").alias("data_version"), F.col("top.at_").alias("at_"))
    best = by_value.groupBy(*item).agg(F.max(posterior).alias("b"), F.collect_list("score").alias("scores"))
    most = F.array_max("scores")
    share = F.exp(F.col("b.score") - most) / F.aggregate(F.transform("scores", lambda s: F.exp(s - most)), F.lit(0.0), lambda x, y: x + y)
    return best.select(*item, "b.value", "b.source", "b.data_version", F.when(F.col("b.at_") != NEVER, F.floor(F.col("b.at_") / 1_000_000)).cast("bigint").alias("fetched_epoch"), share.alias("posterior"))


def both(parts: dict[str, DataFrame]) -> DataFrame:
    """Claims of several tables under their names, so that sources are judged over all of them."""
    return reduce(DataFrame.unionByName, (df.withColumn("table_name", F.lit(name)) for name, df in parts.items()))
