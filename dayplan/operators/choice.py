"""Multinomial logit choice: sampled (long) and fixed (wide) alternatives."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayplan.functions.draws import digest, draw, uniform
from dayplan.operators.dense_index import dense_index
from dayplan.operators.relations import _wanted, complement
from dayplan.session import Scratch, task_count
from dayplan.specs.choice import WideLogit

Terms = list[tuple[float, list[str]]]


def _apart(df: DataFrame) -> DataFrame:
    """``df`` for a join by shuffles. Stored keys shrink so far in their files that the planner takes millions
    of rows for a few MB and would hand them to every task through the driver."""
    return df.hint("merge")


def utility(terms: Terms) -> Column:
    """Sum of coefficient times the product of the term's factors."""
    parts = []
    for coefficient, factors in terms:
        product = reduce(lambda a, b: a * b, [F.expr(f).cast("double") for f in factors])
        parts.append(F.lit(float(coefficient)) * product)
    return reduce(lambda a, b: a + b, parts)


# ---------------------------------------------------------------- wide models


def _wide_utilities(spec: WideLogit) -> list[Column]:
    out = []
    for alternative in spec.alternatives:
        parts = []
        for attribute, by_alternative in spec.coefficients.items():
            if alternative in by_alternative:
                c = F.lit(float(by_alternative[alternative]))
                parts.append(c if attribute == "intercept" else c * F.col(attribute).cast("double"))
        out.append(reduce(lambda a, b: a + b, parts) if parts else F.lit(0.0))
    return out


def _wide_weights(df: DataFrame, spec: WideLogit) -> tuple[DataFrame, list[str]]:
    """exp(utility - max) per alternative; all null if any utility is unknown."""
    names = [f"_v{a}" for a in spec.alternatives]
    df = df.withColumns(dict(zip(names, _wide_utilities(spec))))
    total = reduce(lambda a, b: a + b, [F.col(n) for n in names])
    df = df.withColumn("_max", F.when(total.isNotNull(), F.greatest(*names)))
    weights = [f"_w{a}" for a in spec.alternatives]
    df = df.withColumns({w: F.exp(F.col(n) - F.col("_max")) for w, n in zip(weights, names)})
    return df.drop("_max", *names), weights


def _running(columns: list[str]) -> list[Column]:
    sums, acc = [], None
    for c in columns:
        acc = F.col(c) if acc is None else acc + F.col(c)
        sums.append(acc)
    return sums


def wide_probabilities(df: DataFrame, spec: WideLogit, prefix: str = "p_") -> DataFrame:
    """Add one probability column per alternative; no join, no shuffle."""
    df, weights = _wide_weights(df, spec)
    df = df.withColumn("_total", _running(weights)[-1])
    probabilities = {
        f"{prefix}{a}": F.col(w) / F.col("_total") for a, w in zip(spec.alternatives, weights)
    }
    return df.withColumns(probabilities).drop("_total", *weights)


def mnl_wide(df: DataFrame, spec: WideLogit, u: Column, out: str) -> DataFrame:
    """Draw one alternative per row by inverse CDF; an unknown utility gives null."""
    df, weights = _wide_weights(df, spec)
    sums = _running(weights)
    df = df.withColumn("_cut", u * sums[-1])
    choice = F.when(F.col("_cut").isNull(), F.lit(None))
    for alternative, acc in list(zip(spec.alternatives, sums))[:-1]:
        choice = choice.when(acc > F.col("_cut"), F.lit(alternative))
    choice = choice.otherwise(F.lit(spec.alternatives[-1]))
    return df.withColumn(out, choice.cast("bigint")).drop("_cut", *weights)


# ---------------------------------------------------------------- sampled alternatives


def _sampled_indices(salt: str, key: Column, size: int, k: int) -> Column:
    """``k`` distinct indices below ``size`` per row, each subset equally likely.

    Draw i falls on 0..size-k+i; an index already taken gives way to the newest one, so
    exactly k draws are enough whatever the size.
    """
    # four draws per digest, each computed once per row
    digests = F.array(*[digest(f"{salt}|{block}", key) for block in range((k + 3) // 4)])
    hashes = F.flatten(F.transform(digests, lambda d: F.array(*[draw(d, i) for i in range(4)])))
    numbered = F.transform(F.slice(hashes, 1, k), lambda h, i: F.struct(h.alias("h"), i.alias("i")))

    def step(taken: Column, x: Column) -> Column:
        top = x["i"].cast("bigint") + F.lit(size - k)
        pick = F.floor(x["h"] / F.lit(4294967296.0) * (top + 1)).cast("bigint")
        return F.array_append(taken, F.when(F.array_contains(taken, pick), top).otherwise(pick))

    return F.aggregate(numbered, F.array().cast("array<bigint>"), step)


def sample_indexed(
    choosers: DataFrame, indexed: DataFrame, size: int, chooser: str, k: int, salt: str
) -> DataFrame:
    """Join ``k`` sampled alternatives to each chooser; ``indexed`` carries ``idx``."""
    k = min(k, size)
    picks = choosers.withColumn("_h", _sampled_indices(salt, F.col(chooser), size, k))
    rows = picks.select(*choosers.columns, F.explode("_h").alias("idx"))
    return rows.join(_apart(indexed), "idx").drop("idx")


def sample_alternatives(
    choosers: DataFrame, alts: DataFrame, chooser: str, alternative: str, k: int, salt: str
) -> DataFrame:
    """(chooser, alternative) pairs: k distinct alternatives per chooser."""
    indexed, size = dense_index(alts.select(alternative), alternative)
    return sample_indexed(choosers.select(chooser), indexed, size, chooser, k, salt)


def choice_table(
    choosers: DataFrame,
    alts: DataFrame,
    chooser: str,
    alternative: str,
    k: int,
    salt: str,
    interactions: DataFrame | None = None,
    on: list[str] | None = None,
    chosen: str | None = None,
) -> DataFrame:
    """Long table of choosers and their alternatives with all attributes.

    With ``chosen`` (a column of ``choosers``) the observed alternative is one of the k and
    ``chosen`` marks it; the other k - 1 are sampled from the rest.
    """
    indexed, size = dense_index(alts, alternative)
    if chosen is None:
        rows = sample_indexed(choosers, indexed, size, chooser, k, salt)
    else:
        own = indexed.select(F.col(alternative).alias(chosen), F.col("idx").alias("_own"))
        known = choosers.join(_apart(own), chosen)
        others = min(k, size) - 1
        draws = _sampled_indices(salt, F.col(chooser), size - 1, others)
        # indices of the other alternatives skip the chosen one
        shifted = F.transform(draws, lambda x: F.when(x >= F.col("_own"), x + 1).otherwise(x))
        picks = F.concat(F.array("_own"), shifted) if others else F.array("_own")
        columns = [c for c in choosers.columns if c != chosen]
        rows = (
            known.withColumn("_h", picks)
            .select(*columns, "_own", F.explode("_h").alias("idx"))
            .withColumn("chosen", F.expr("int(idx = _own)"))
            .join(_apart(indexed), "idx")
            .drop("idx", "_own")
        )
    if interactions is not None:
        rows = rows.join(_apart(interactions), on, "left")
    return rows


def mnl_probabilities(df: DataFrame, chooser: str, value: str) -> DataFrame:
    """Add ``probability`` within each chooser's few alternatives."""
    w = Window.partitionBy(chooser)
    weight = F.exp(F.col(value) - F.max(value).over(w))
    return (
        df.withColumn("_w", weight)
        .withColumn("probability", F.col("_w") / F.sum("_w").over(w))
        .drop("_w")
    )


def draw_choice(
    df: DataFrame, chooser: str, alternative: str, value: str, u: Column
) -> DataFrame:
    """One draw per chooser by inverse CDF over its alternatives in key order.

    ``u`` is an expression of the chooser key. Alternatives of unknown utility are not
    available. The gathered list holds the k sampled alternatives of one chooser only.
    """
    item = F.struct(F.col(alternative).alias("a"), F.col(value).alias("v"))
    lists = (
        df.where(F.col(value).isNotNull())
        .groupBy(chooser)
        .agg(F.sort_array(F.collect_list(item)).alias("_alts"))
        .withColumn("_max", F.array_max(F.transform("_alts", lambda x: x["v"])))
        .withColumn("_e", F.transform("_alts", lambda x: F.exp(x["v"] - F.col("_max"))))
        .withColumn("_cut", u * F.aggregate("_e", F.lit(0.0), lambda s, x: s + x))
    )
    start = F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("n"))
    # position of the first running sum above the cut = number of sums at or below it
    below = F.aggregate(
        F.col("_e"),
        start,
        lambda st, x: F.struct(
            (st["s"] + x).alias("s"),
            (st["n"] + F.when(st["s"] + x <= F.col("_cut"), 1).otherwise(0)).alias("n"),
        ),
        lambda st: st["n"],
    )
    position = F.least(below + 1, F.size("_alts"))
    return lists.select(chooser, F.element_at(F.col("_alts"), position)["a"].alias(alternative))


# ---------------------------------------------------------------- capacity of one


def _names(factor: str) -> set[str]:
    """Columns that a factor of a term names, in lower case."""
    return {n.lower() for n in re.findall(r"[A-Za-z_]\w*(?!\w*\s*\()", factor)}


def _narrowed(df: DataFrame, keys: list[str], terms: Terms) -> DataFrame:
    """``keys``, as far as ``df`` has them, and the columns that ``terms`` name."""
    used = set().union(*[_names(f) for _, factors in terms for f in factors])
    return df.select(*[c for c in df.columns if c in keys or c.lower() in used])


def _known(df: DataFrame, terms: Terms) -> DataFrame:
    """Rows in which every column and factor of ``terms`` that ``df`` alone decides is known."""
    have = {c.lower() for c in df.columns}
    for factor in sorted({f for _, factors in terms for f in factors}):
        names = _names(factor)
        for name in sorted(names & have):
            df = df.where(F.col(name).isNotNull())
        if names <= have:
            df = df.where(F.expr(factor).isNotNull())
    return df


def _still_possible(
    waiting: DataFrame,
    free: DataFrame,
    chooser: str,
    alternative: str,
    terms: Terms,
    interactions: DataFrame | None,
    on: list[str] | None,
) -> tuple[DataFrame, DataFrame]:
    """Choosers and alternative keys that still have a known utility with someone.

    A column or factor that one side carries is judged on that side; a factor over columns
    of both is unknown only where one of its columns is. What both meet in, the interaction
    row, is judged by the distinct keys of the sides, never by single pairs.
    """

    waiting, free = _known(waiting, terms), _known(free, terms)
    if interactions is None:
        if free.isEmpty() or waiting.isEmpty():
            return waiting.limit(0), free.select(alternative)
        return waiting, free.select(alternative)
    ours = [c for c in on if c in waiting.columns]
    theirs = [c for c in on if c not in ours]
    met = _known(interactions, terms)
    if ours:
        met = met.join(waiting.select(*ours).distinct(), ours, "left_semi")
    if theirs:
        met = met.join(free.select(*theirs).distinct(), theirs, "left_semi")
    if ours:
        waiting = waiting.join(met.select(*ours).distinct(), ours, "left_semi")
    if theirs:
        free = free.join(met.select(*theirs).distinct(), theirs, "left_semi")
    return waiting, free.select(alternative)


def _sample_priced(
    waiting: DataFrame, free: DataFrame, chooser: str, alternative: str, terms: Terms, interactions: DataFrame,
    on: list[str], k: int, salt: str,
) -> DataFrame:
    """Choosers with up to ``k`` free alternatives that share a known interaction row with them.

    ``free`` carries the alternatives' columns. Free alternatives are numbered in order of their
    keys; each key that a chooser can go with is a range of numbers, and draws fall on its ranges in
    proportion to their length, equal draws once. A chooser's list holds one entry per key.
    """
    ours = [c for c in on if c in waiting.columns]
    theirs = [c for c in on if c not in ours]
    order, _ = dense_index(free, *theirs, alternative, name="_at")
    ranges = order.groupBy(*theirs).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    entry = F.struct(F.col("_first").alias("first"), F.col("_n").alias("n"))
    lists = (
        _known(interactions, terms).select(*on).distinct().join(ranges, theirs)
        .groupBy(*ours).agg(F.sort_array(F.collect_list(entry)).alias("_ranges"))
        .withColumn("_all", F.aggregate("_ranges", F.lit(0).cast("bigint"), lambda s, r: s + r["n"]))
    )
    digests = F.array(*[digest(f"{salt}|{block}", F.col(chooser)) for block in range((k + 3) // 4)])
    hashes = F.slice(F.flatten(F.transform(digests, lambda d: F.array(*[draw(d, i) for i in range(4)]))), 1, k)

    def place(hit: Column) -> Column:
        """The number that the ``hit``-th of a chooser's alternatives has."""
        start = F.struct(hit.alias("left"), F.lit(-1).cast("bigint").alias("at"))
        return F.aggregate("_ranges", start, lambda s, r: F.struct(
            F.when(s["at"] < 0, s["left"] - r["n"]).otherwise(s["left"]).alias("left"),
            F.when((s["at"] < 0) & (s["left"] < r["n"]), r["first"] + s["left"]).otherwise(s["at"]).alias("at")), lambda s: s["at"])

    drawn = waiting.join(lists, ours).withColumn("_hits", F.array_distinct(F.transform(
        hashes, lambda h: F.floor(h / F.lit(4294967296.0) * F.col("_all")).cast("bigint"))))
    rows = drawn.select(*waiting.columns, "_ranges", F.explode("_hits").alias("_hit")).withColumn("_at", place(F.col("_hit")))
    return rows.drop("_ranges", "_hit").join(_apart(order), "_at").drop("_at")


NUMBER_BUCKET = 1 << 16  # numbers that are counted together
SELECTIVE = 4  # a table that is so many times as long as what is asked of it is filtered before it moves


def _bucket(number: str) -> Column:
    return F.expr(f"{number} div {NUMBER_BUCKET}").alias("_bucket")


def _before(rows: DataFrame, total: int) -> DataFrame:
    """(_bucket, _before): how many of ``rows`` are in the buckets before each bucket of numbers up to ``total``."""
    every = rows.sparkSession.range(total // NUMBER_BUCKET + 1).select(F.col("id").alias("_bucket"))
    counts = rows.groupBy("_bucket").agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    return every.join(counts, "_bucket", "left").select("_bucket", F.coalesce(upto, F.lit(0)).alias("_before"))


def _places(rows: DataFrame, taken: DataFrame, total: int) -> DataFrame:
    """``rows`` with ``place``, the number that the ``idx``-th free alternative has among all, in place of ``idx``.

    ``taken`` are the places that are not free any more. The i-th of them, at t, has t - i free ones before
    it; so ``idx`` free ones lie before a place that all taken ones with t - i <= idx precede. Rows and taken places are
    counted in buckets of these numbers: what moves are the rows and the taken places, not what is free.
    """
    known = taken.select("place", _bucket("place"))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("place")) - 1
    marks = known.withColumn("_rank", rank).join(F.broadcast(_before(known, total)), "_bucket").select(
        (F.col("place") - F.col("_rank") - F.col("_before")).alias("idx"))
    marks = marks.select("idx", _bucket("idx"), F.lit(1).alias("_taken"))
    both = rows.select(*rows.columns, _bucket("idx"), F.lit(0).alias("_taken")).unionByName(marks, allowMissingColumns=True)
    upto = F.sum("_taken").over(Window.partitionBy("_bucket").orderBy("idx").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        both.withColumn("_upto", upto).where("_taken = 0").join(F.broadcast(_before(marks, total)), "_bucket")
        .withColumn("place", F.col("idx") + F.col("_before") + F.col("_upto"))
        .drop("idx", "_bucket", "_taken", "_upto", "_before")
    )


def _selected(table: DataFrame, rows: DataFrame, on: list[str]) -> DataFrame:
    """``table`` without most rows that no key of ``rows``, which are stored, asks for."""
    if any(table.schema[c].dataType != rows.schema[c].dataType for c in on):
        return table  # keys of different types may be equal with different marks
    return _wanted(table, rows, on, max(1, rows.count()))


class _Stock:
    """Alternatives with a gap-free ``place`` in order of their keys, and the places that are taken.

    Places never change. A round draws among the free ones and looks their places up, so that it costs what
    its choosers ask for, not what is free.
    """

    def __init__(self, alts: DataFrame, alternative: str, scratch: Scratch, name: str):
        self.rows, self.total = dense_index(alts, alternative, name="place")
        self.alternative, self.scratch, self.name = alternative, scratch, name
        self.size, self.taken, self.turn, self._by_place = self.total, None, 0, None

    def attributes(self) -> DataFrame:
        return self.rows.drop("place")

    def free(self) -> DataFrame:
        """The keys of the free alternatives."""
        if self.taken is None:
            return self.rows.select(self.alternative)
        return self.rows.select(self.alternative, "place").join(_apart(self.taken), "place", "left_anti").select(self.alternative)

    def by_place(self) -> DataFrame:
        """What a place stands for: the rows with its key, so every one of a repeated key and none of an unknown one."""
        if self._by_place is None:
            key = F.col(self.alternative)
            odd = self.rows.groupBy(key).count().where((F.col("count") > 1) | key.isNull())
            self._by_place = self.rows if odd.isEmpty() else self.scratch.write(
                self.rows.select("place", self.alternative).join(_apart(self.attributes()), self.alternative), f"{self.name}-by-place")
        return self._by_place

    def take(self, winners: DataFrame) -> None:
        keys = self.rows.select(self.alternative, "place")
        places = _selected(keys, winners, [self.alternative]).join(_apart(winners), self.alternative, "left_semi").select("place")
        self.turn += 1  # two folders in turn: the last places stay readable while the next are written
        every = places if self.taken is None else self.taken.unionByName(places)
        self.taken, n = self.scratch.write_counting(every, f"{self.name}-taken-{'odd' if self.turn % 2 else 'even'}")
        self.size = self.total - n

    def sampled(self, choosers: DataFrame, asked: int, chooser: str, k: int, salt: str) -> tuple[DataFrame, bool]:
        """``k`` sampled free alternatives of each chooser, some ``asked`` rows, and whether these are few."""
        if self.taken is None:
            return sample_indexed(choosers, self.by_place().withColumnRenamed("place", "idx"), self.size, chooser, k, salt), False
        picks = choosers.withColumn("_h", _sampled_indices(salt, F.col(chooser), self.size, min(k, self.size)))
        rows = _places(picks.select(*choosers.columns, F.explode("_h").alias("idx")), self.taken, self.total)
        table, few = self.by_place(), SELECTIVE * asked < self.total
        if few:
            rows = self.scratch.write(rows, f"{self.name}-picks")
            table = _selected(table, rows, ["place"])
        return rows.join(_apart(table), "place").drop("place"), few


def capacity_choice(
    choosers: DataFrame,
    alts: DataFrame,
    chooser: str,
    alternative: str,
    terms: Terms,
    interactions: DataFrame | None = None,
    on: list[str] | None = None,
    k: int = 10,
    salt: str = "wlcm",
    rounds: int | None = None,
) -> DataFrame:
    """Assign each chooser an alternative that nobody else holds.

    Each round samples k free alternatives per unplaced chooser, draws one, and settles
    clashes by a hashed lottery. Rounds go on until choosers or alternatives run out;
    ``rounds`` stops earlier. After a round that places nobody, choosers and alternatives
    without any utility left between them go, and from then on choosers draw only from
    alternatives they have an interaction row with. So each further round places somebody, and the
    loop ends only when nobody who waits could take anything that is free. Returns (chooser,
    alternative, round).

    The alternatives are stored and numbered once. A later round moves what its choosers ask for: their sampled
    alternatives and, where these are few, the interaction rows of the pairs they form.
    """
    spark = choosers.sparkSession
    scratch = Scratch(spark, "capacity")
    # narrow rows are spread evenly before each of them grows k-fold
    waiting = scratch.write(choosers.repartition(task_count(spark)), "waiting-0")
    stock, remaining = _Stock(alts, alternative, scratch, "all"), 0
    placed: list[DataFrame] = []
    number, idle = 0, False
    both_sides = interactions is not None and 0 < sum(c in choosers.columns for c in on) < len(on)
    while stock.size > 0 and (rounds is None or number < rounds):
        number += 1
        met, few = interactions, False
        if idle and both_sides:
            rows = _sample_priced(
                waiting, stock.attributes().join(_apart(stock.free()), alternative), chooser, alternative, terms,
                interactions, on, k, f"{salt}|alt|{number}")
        elif number == 1:
            rows = sample_indexed(
                waiting, stock.rows.withColumnRenamed("place", "idx"), stock.size, chooser, k, f"{salt}|alt|{number}")
        else:
            rows, few = stock.sampled(waiting, k * remaining, chooser, k, f"{salt}|alt|{number}")
        if few and interactions is not None:
            rows = scratch.write(_narrowed(rows, [chooser, alternative, *on], terms), "rows")
            met = _selected(interactions, rows, on)
        if interactions is not None:
            rows = rows.join(_apart(met), on, "left")
        priced = rows.select(chooser, alternative, utility(terms).alias("_v"))
        wishes = draw_choice(
            priced, chooser, alternative, "_v", uniform(f"{salt}|draw|{number}", chooser)
        )
        ticket = F.struct(draw(digest(f"{salt}|prio|{number}", chooser)).alias("t"), F.col(chooser))
        winners = wishes.groupBy(alternative).agg(F.min(ticket).alias("w")).select(
            F.col(f"w.{chooser}").alias(chooser), alternative, F.lit(number).alias("round")
        )
        winners, won = scratch.write_counting(winners, f"winners-{number}")
        if won:
            placed.append(winners)
        if number == rounds:
            break
        if won:
            waiting = complement(waiting, _apart(winners), chooser)
        else:
            idle = True
            waiting, left = _still_possible(
                waiting, stock.attributes().join(_apart(stock.free()), alternative), chooser, alternative, terms, interactions, on
            )
        waiting, remaining = scratch.write_counting(waiting.repartition(task_count(spark)), f"waiting-{number}")
        if remaining == 0:
            break
        if won:
            stock.take(winners)
        else:
            stock = _Stock(stock.attributes().join(_apart(left), alternative, "left_semi"), alternative, scratch, f"left-{number}")
    if not placed:
        schema = T.StructType([choosers.schema[chooser], alts.schema[alternative]])
        return spark.createDataFrame([], schema).withColumn("round", F.lit(0))
    return reduce(DataFrame.unionByName, placed)
