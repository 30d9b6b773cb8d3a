"""Per-key work that stays balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from tidemark.functions.expr import c


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest row per key.  An aggregate, so map-side combining shrinks a busy key first."""
    rest = [x for x in df.columns if x not in keys]
    picked = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    return picked.select(*keys, "_row.*").select(*df.columns)


def with_next(df: DataFrame, keys: list[str], ts: str, tie: list[str], out: str, grain: str = "day") -> DataFrame:
    """Timestamp of the following row of the same key.

    The row-level window runs per (key, day); only the first timestamp of each day is ordered
    per key, so the per-key window is bounded by the calendar and not by the row count.
    """
    slot = df.withColumn("_slot", F.date_trunc(grain, c(ts)))
    inner = slot.withColumn(out, F.lead(ts).over(Window.partitionBy(*keys, "_slot").orderBy(ts, *tie)))
    following = (
        slot.groupBy(*keys, "_slot")
        .agg(F.min(ts).alias("_first"))
        .withColumn("_following", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_slot")))
        .drop("_first")
    )
    return (
        inner.join(following, [*keys, "_slot"], "left")
        .withColumn(out, F.coalesce(F.col(out), F.col("_following")))
        .drop("_slot", "_following")
    )


def most_frequent(
    df: DataFrame, keys: list[str], value: str, out: str, count_out: str | None = None, distinct_out: str | None = None
) -> DataFrame:
    """Mode per key, its count and the number of distinct values; a tie goes to the smallest value."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.groupBy(*keys).agg(
        F.min_by(F.struct(value, "_n"), F.struct(-F.col("_n"), F.col(value))).alias("_best"),
        F.count(value).alias("_distinct"),
    )
    cols = [*keys, F.col(f"_best.{value}").alias(out)]
    if count_out:
        cols.append(F.col("_best._n").alias(count_out))
    if distinct_out:
        cols.append(F.col("_distinct").alias(distinct_out))
    return best.select(*cols)


def cells(df: DataFrame, keys: list[str], kinds: dict[str, Column], *measures: Column) -> DataFrame:
    """keys, kind, value, n and measures: for every key how often each value of each kind occurs, from one scan.

    Kinds are columns that are counted side by side (values as text).  Rows are combined before the shuffle and spread by
    value, so modes, distinct counts and, from one of the kinds, totals of a busy key come from many tasks.
    """
    each = F.array(*(F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value")) for kind, value in kinds.items()))
    rows = df.withColumn("_cell", F.explode(each))
    return rows.groupBy(*keys, F.col("_cell.kind").alias("kind"), F.col("_cell.value").alias("value")).agg(F.count(F.lit(1)).alias("n"), *measures)


def cell_mode(kind: str) -> Column:
    """Aggregate over cells: the struct (value, n) of the commonest value of a kind; a tie goes to the smallest."""
    own = F.col("kind") == kind
    return F.min_by(F.when(own, F.struct("value", "n")), F.when(own, F.struct(-F.col("n"), F.col("value"))))


def cell_distinct(kind: str) -> Column:
    """Aggregate over cells: how many values of a kind there are, without null."""
    return F.count_if((F.col("kind") == kind) & F.col("value").isNotNull())


def _decade_bucket(cents: Column) -> Column:
    """Order-preserving bucket: sign, number of digits and the three leading digits.

    At most about 27 000 buckets for 15-digit amounts, whatever the row count.
    """
    size = F.abs(cents)
    digits = F.length(size.cast("string"))
    scale = F.pow(F.lit(10.0), F.greatest(digits - 3, F.lit(0)).cast("double")).cast("bigint")
    head = F.floor(size / scale).cast("bigint")
    return F.when(cents < 0, -(digits * 1000 + head)).otherwise(digits * 1000 + head).cast("bigint")


def quantiles(df: DataFrame, keys: list[str], value: str, named: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles per key for a decimal or integer column.

    Equal values are counted first (shuffled by key and value), then a small histogram per key
    finds the bucket of each wanted rank, and only those buckets are ranked.  No task ever sees
    all the values of a key, unlike a percentile aggregate.
    """
    kind = df.select(value).schema[0].dataType
    if not isinstance(kind, (DecimalType, IntegralType)):
        raise TypeError(f"{value} is {kind.simpleString()}; quantiles are exact for decimals and integers only")
    unit = 10 ** (kind.scale if isinstance(kind, DecimalType) else 0)
    counted = (
        df.where(c(value).isNotNull()).groupBy(*keys, (c(value) * unit).cast("bigint").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    )
    return counted_quantiles(counted, keys, unit, named)


def counted_quantiles(counted: DataFrame, keys: list[str], unit: int, named: dict[str, float]) -> DataFrame:
    """Quantiles from values that are counted already: keys, _v (the value times ``unit``) and _n (how often)."""
    counted = counted.withColumn("_b", _decade_bucket(F.col("_v")))
    by_key = Window.partitionBy(*keys)
    upto = by_key.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    histogram = (
        counted.groupBy(*keys, "_b")
        .agg(F.sum("_n").alias("_bn"))
        .withColumn("_end", F.sum("_bn").over(upto))
        .withColumn("_total", F.sum("_bn").over(by_key))
    )
    wanted = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                (F.floor((F.col("_total") - 1) * F.lit(q)) + 1).cast("bigint").alias("lo"),
                (F.ceil((F.col("_total") - 1) * F.lit(q)) + 1).cast("bigint").alias("hi"),
                ((F.col("_total") - 1) * F.lit(q) - F.floor((F.col("_total") - 1) * F.lit(q))).alias("frac"),
            )
            for name, q in named.items()
        ]
    )
    start = F.col("_end") - F.col("_bn")
    targets = (
        histogram.withColumn("_start", start)
        .withColumn("_w", F.explode(wanted))
        .where(
            ((F.col("_w.lo") > F.col("_start")) & (F.col("_w.lo") <= F.col("_end")))
            | ((F.col("_w.hi") > F.col("_start")) & (F.col("_w.hi") <= F.col("_end")))
        )
        .groupBy(*keys, "_b", "_start")
        .agg(F.collect_list("_w").alias("_wanted"))  # at most one entry per requested quantile
    )
    inside = (
        counted.join(targets, [*keys, "_b"])
        .withColumn(
            "_upto",
            F.col("_start")
            + F.sum("_n").over(
                Window.partitionBy(*keys, "_b")
                .orderBy("_v")
                .rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        )
        .withColumn("_w", F.explode("_wanted"))
    )
    before = F.col("_upto") - F.col("_n")

    def holds(rank: Column) -> Column:
        return (rank > before) & (rank <= F.col("_upto"))

    ends = inside.groupBy(*keys, F.col("_w.name").alias("_name"), F.col("_w.frac").alias("_frac")).agg(
        F.max(F.when(holds(F.col("_w.lo")), F.col("_v"))).alias("_lo"),
        F.max(F.when(holds(F.col("_w.hi")), F.col("_v"))).alias("_hi"),
    )
    point = (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_frac")) / F.lit(float(unit))
    return ends.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_name") == name, point)).alias(name) for name in named]
    )


#: Rows of one key that a single task joins without trouble.
EASY = 20_000


def _hot_keys(left: DataFrame, right: DataFrame, keys: list[str], parts: int, most: int, weight: str | None) -> tuple[DataFrame | None, int]:
    """keys, _of_left, _of_right: the hot keys of a join and into how many parts to deal each side, None without any; and
    how many pairs of rows share a key."""
    zero = F.lit(0).cast("bigint")
    rows = F.lit(1).cast("bigint") if weight is None else F.col(weight).cast("bigint")
    sides = [left.select(*keys, rows.alias("_l"), zero.alias("_r")), right.select(*keys, zero.alias("_l"), F.lit(1).cast("bigint").alias("_r"))]
    counted = sides[0].unionAll(sides[1]).groupBy(*keys).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    totals = counted.agg(F.sum("_l").alias("_all_l"), F.sum("_r").alias("_all_r"), F.sum(F.col("_l").cast("double") * F.col("_r")).alias("_met"))

    def hot(n: str) -> Column:
        return (F.col(n) > EASY) & (F.col(n) * parts > F.col(f"_all{n}"))

    def split(n: str) -> Column:
        return F.when(hot(n), F.least(F.ceil(F.col(n) * parts / F.col(f"_all{n}")), F.lit(most))).otherwise(1).cast("int")

    found = counted.crossJoin(F.broadcast(totals)).where(hot("_l") | hot("_r"))
    found = found.select(*keys, split("_l").alias("_of_left"), split("_r").alias("_of_right"))
    met = F.coalesce("_met", F.lit(0.0)).alias("_met")
    none = [F.lit(None).cast(found.schema[k].dataType).alias(k) for k in found.columns]
    rows = found.withColumn("_met", F.lit(None).cast("double")).unionAll(totals.select(*none, met)).collect()  # fewer than 2 * parts
    pairs = next(int(r["_met"]) for r in rows if r["_met"] is not None)
    rows = [r[:-1] for r in rows if r["_met"] is None]
    return (left.sparkSession.createDataFrame(rows, found.schema) if rows else None), pairs


#: Pairs that one task of a busy join tests, and partitions that such work is dealt over at most.
PAIRS, MOST_CELLS = 4_000_000, 4096


def salted_join(
    left: DataFrame, right: DataFrame, key: str | list[str], cond: Column | None = None, *, parts: int = 256, most: int = 32,
    busy: bool = False, counted: tuple[DataFrame, str] | None = None, small: bool = False,
) -> DataFrame:
    """Inner join on ``key`` that splits hot keys of either side over several tasks.

    A key is hot on a side if it holds more than a ``parts``-th of that side's rows (and more than EASY rows), so there
    are fewer than 2 * ``parts`` hot keys whatever the input: that is the proven bound of the broadcast.  Rows of a hot key
    are dealt out, one part for each ``parts``-th of the side but at most ``most``, and the rows of the other side are
    repeated for every part; a key that is hot on both sides becomes a grid.  Other keys are left alone.
    ``cond`` is checked inside the join, before anything is written.  Keys are counted first, so the inputs are read
    twice and should be stored, or cheap to make.

    A ``busy`` join has few bytes and many pairs to test, so the number of its tasks follows the pairs, not the bytes.
    ``counted`` has the keys of the left side and a column with how many of its rows each stands for, where counting the
    side itself would make it twice.  If ``right`` is ``small``, its parts are hashed, and the long left side isn't sorted.
    """
    keys = [key] if isinstance(key, str) else key
    hot, pairs = _hot_keys(counted[0] if counted else left, right, keys, parts, most, counted[1] if counted else None)
    salts, their_salts = [], []
    if hot is None:
        mine, theirs = left, right
        on = [F.col(k) == F.col(f"_their_{k}") for k in keys]
    else:

        def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
            """df with _own, the part of a row, and _other, every part of the other side."""
            of_own, of_other = (F.coalesce(F.col(x), F.lit(1)) for x in (own, other))
            at = F.pmod(F.xxhash64(*df.columns), of_own).cast("int").alias("_own")
            marked = df.join(F.broadcast(hot), keys, "left")
            return marked.select(*df.columns, at, F.explode(F.sequence(F.lit(0), of_other - 1)).alias("_other"))

        mine = dealt(left, "_of_left", "_of_right")
        theirs = dealt(right, "_of_right", "_of_left").withColumnsRenamed({"_own": "_their_own", "_other": "_their_other"})
        salts, their_salts = ["_own", "_other"], ["_their_other", "_their_own"]
        on = [F.col(x) == F.col(y) for x, y in zip(salts, their_salts, strict=True)]
        on += [F.col(k) == F.col(f"_their_{k}") for k in keys]
    theirs = theirs.withColumnsRenamed({k: f"_their_{k}" for k in keys})
    if busy and pairs > PAIRS:
        tasks = min(-(-pairs // PAIRS), MOST_CELLS)
        mine = mine.repartition(tasks, *salts, *keys)
        theirs = theirs.repartition(tasks, *their_salts, *(f"_their_{k}" for k in keys))
    theirs = theirs.hint("shuffle_hash") if small else theirs
    out = mine.join(theirs, reduce(and_, on if cond is None else [*on, cond]))
    return out.drop("_own", "_other", "_their_own", "_their_other", *(f"_their_{k}" for k in keys))


def block_join(left: DataFrame, right: DataFrame, cond: Column, *, left_rows: int = 16384, right_rows: int = 8192) -> DataFrame:
    """Inner join by a condition that no key can stand for: a grid of cells of bounded size.

    Rows of both sides are dealt into blocks of about so many rows; each pair of blocks is one cell, and so one key of an
    equi-join.  No task holds more than its cells, no side is broadcast whole, and the condition is checked inside the
    join.  The work is the product of the sides, so the condition should begin with what is cheap and rejects most.
    """
    rows, cols = (max(1, -(-df.count() // size)) for df, size in ((left, left_rows), (right, right_rows)))

    def dealt(df: DataFrame, own: int, other: int) -> tuple[Column, Column]:
        return F.pmod(F.xxhash64(*df.columns), F.lit(own)), F.explode(F.sequence(F.lit(0), F.lit(other - 1)))

    i, j = dealt(left, rows, cols)
    mine = left.select("*", i.alias("_i"), j.alias("_j")).withColumn("_cell", F.col("_i") * cols + F.col("_j"))
    j, i = dealt(right, cols, rows)
    theirs = right.select("*", j.alias("_j"), i.alias("_i")).withColumn("_their_cell", F.col("_i") * cols + F.col("_j"))
    # cells are few bytes and much work: by number, as small partitions would be merged by their bytes
    parts = min(rows * cols, MOST_CELLS)
    mine, theirs = mine.drop("_i", "_j").repartition(parts, "_cell"), theirs.drop("_i", "_j").repartition(parts, "_their_cell")
    met = mine.join(theirs, (F.col("_cell") == F.col("_their_cell")) & cond)
    return met.drop("_cell", "_their_cell")


def block_pairs(left: DataFrame, right: DataFrame, column: str, other: str, *, size: int = 8192) -> DataFrame:
    """mine, theirs: every block of one list of values with every block of the other, each as an array.

    Values are dealt into blocks of about ``size``; every pair of blocks is one row, and rows are spread by number, as they
    are few bytes and much work. The work is the product of the sides; no row holds more than two blocks.
    """
    rows, cols = (max(1, -(-df.count() // size)) for df in (left, right))
    parts = min(rows * cols, MOST_CELLS)

    def blocks(df: DataFrame, value: str, own: int, others: int, name: str) -> DataFrame:
        dealt = df.groupBy(F.pmod(F.xxhash64(value), F.lit(own)).alias("_own")).agg(F.collect_list(value).alias(name))
        return dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    mine = blocks(left, column, rows, cols, "mine").select("mine", (F.col("_own") * cols + F.col("_other")).alias("_cell"))
    theirs = blocks(right, other, cols, rows, "theirs").select("theirs", (F.col("_other") * cols + F.col("_own")).alias("_cell"))
    return mine.repartition(parts, "_cell").join(theirs.repartition(parts, "_cell"), "_cell").select("mine", "theirs")
