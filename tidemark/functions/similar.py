"""Joins of two name lists by edit distance or by containment, without a nested loop.

Few edits use the pigeonhole idea of published segment-filter joins (Li, Deng, Wang, Feng,
"Pass-Join", PVLDB 2011): a string cut into k+1 pieces must share at least one piece unchanged
with any string at distance <= k, and the piece can move only a little.  With many edits blocks of names meet and
all distances of two blocks are computed side by side.  Both inputs are reduced to distinct values first, and all tests run inside the
join, so rejected candidates are never written or shuffled.  No pair is lost.  A piece that very many names share is
split over several tasks.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import c
from tidemark.functions.edits import LONGEST, compared
from tidemark.functions.spread import block_join, block_pairs, salted_join


def _values(df: DataFrame, col, name: str) -> DataFrame:
    return df.select(c(col).alias(name)).where(F.col(name).isNotNull()).distinct()


def _piece_keys(v: str, k: int) -> str:
    """Keys of the side that is cut: one per piece, or its letters when it is too short to cut."""
    n, parts = f"length({v})", k + 1
    base, cut = f"({n} div {parts})", f"({parts} - {n} % {parts})"
    pieces = (
        f"transform(sequence(0, {k}), i -> concat_ws('|', {n}, i, "
        f"substring({v}, cast(i * {base} + greatest(0, i - {cut}) + 1 as int), "
        f"cast({base} + if(i >= {cut}, 1, 0) as int))))"
    )
    letters = f"transform(array_distinct(split({v}, '')), x -> concat('c|', x))"
    lengths = f"transform(sequence(0, {k}), x -> concat('n|', x))"
    return f"if({n} > {k}, {pieces}, concat({letters}, {lengths}))"


def _window_keys(v: str, k: int) -> str:
    """Keys of the other side: every substring that a piece could have moved to."""
    n, parts = f"length({v})", k + 1
    base, cut = f"(L div {parts})", f"({parts} - L % {parts})"
    at = f"(i * {base} + greatest(0, i - {cut}))"
    size = f"({base} + if(i >= {cut}, 1, 0))"
    lo = f"greatest(0, {at} - i, {at} + {n} - L - ({k} - i))"
    hi = f"least({n} - {size}, {at} + i, {at} + {n} - L + ({k} - i))"
    spots = f"if({hi} < {lo}, array(), sequence(cast({lo} as int), cast({hi} as int)))"
    windows = (
        f"flatten(flatten(transform(sequence(greatest({parts}, {n} - {k}), {n} + {k}), L -> "
        f"transform(sequence(0, {k}), i -> transform({spots}, s -> "
        f"concat_ws('|', L, i, substring({v}, s + 1, cast({size} as int))))))))"
    )
    letters = f"transform(array_distinct(split({v}, '')), x -> concat('c|', x))"
    short = f"if({n} <= {k}, array(concat('n|', {n})), if({n} <= {2 * k}, {letters}, array()))"
    long = f"if({n} + {k} >= {parts}, {windows}, array())"
    return f"array_distinct(concat({long}, {short}))"


SLOTS, LEVELS = 13, 4


def _bag(v: str, name: str) -> list[Column]:
    """How often each letter occurs, in unary, as bits of two longs.

    Letters have their own slot, other characters share one with a letter, and counts stop at LEVELS; both can only
    hide differences.
    """
    slots = f"transform(filter(split({v}, ''), x -> x != ''), x -> pmod(ascii(x) - 65, {2 * SLOTS}))"

    def half(base: int) -> Column:
        at = f"cast({LEVELS} * (s - {base}) as int)"
        full = (1 << LEVELS) - 1
        more = f"bits | shiftleft((shiftleft(shiftright(bits, {at}) & {full}L, 1) | 1L) & {full}L, {at})"
        return F.expr(f"aggregate(filter({slots}, s -> s >= {base} and s < {base + SLOTS}), 0L, (bits, s) -> {more})")

    return [half(0).alias(f"{name}_lo"), half(SLOTS).alias(f"{name}_hi")]


def _alike(a: str, b: str, k: int) -> Column:
    """Whether neither bag holds more than k letters that the other lacks; true for all names within k edits."""

    def lacking(x: str, y: str) -> Column:
        return reduce(add, (F.bit_count(F.col(f"{x}_{half}").bitwiseAND(F.bitwise_not(F.col(f"{y}_{half}")))) for half in ("lo", "hi")))

    return (lacking(a, b) <= k) & (lacking(b, a) <= k)


#: Up to so many edits names meet by shared pieces. With three, pieces are so short that comparing whole blocks costs less.
PIECES_UPTO = 2


def edit_pairs(many: DataFrame, many_col, few: DataFrame, few_col, k: int) -> DataFrame:
    """Distinct pairs (a, b, distance) with distance <= k; ``many`` is the larger list.

    Few edits: names meet by shared pieces.  More edits leave pieces of one or two letters that all names share, so then
    blocks of names meet whole, each pair of blocks in a row of its own.  Names too long for that (over LONGEST) meet in a
    block join, where bags of letters, compared as bits, decide which distances are computed.
    """
    near = (F.abs(F.length("a") - F.length("b")) <= k) & _alike("_a", "_b", k) & (F.levenshtein("a", "b", k) >= 0)
    left, right = _values(many, many_col, "a"), _values(few, few_col, "b")
    if k > PIECES_UPTO:
        fits, reach = F.length("a") <= LONGEST, F.length("b") <= LONGEST + k
        met = block_pairs(left.where(fits), right.where(reach), "a", "b").mapInArrow(compared(k), "a string, b string, distance int")
        far = block_join(
            left.where(~fits).select("a", *_bag("a", "_a")), right.where(F.length("b") > LONGEST - k).select("b", *_bag("b", "_b")), near
        )
        return met.union(far.select("a", "b", F.levenshtein("a", "b").alias("distance")))
    cut = left.select("a", *_bag("a", "_a"), F.explode(F.expr(_piece_keys("a", k))).alias("_key"))
    moved = right.select("b", *_bag("b", "_b"), F.explode(F.expr(_window_keys("b", k))).alias("_key"))
    found = salted_join(cut, moved, "_key", near, busy=True).select("a", "b").distinct()
    return found.withColumn("distance", F.levenshtein("a", "b"))


def containment_pairs(names: DataFrame, name_col, texts: DataFrame, text_col, gram: int = 4) -> DataFrame:
    """Distinct pairs (a, b) where text ``b`` contains name ``a`` literally."""
    a = _values(names, name_col, "a").where(F.length("a") > 0)
    a = a.withColumn("_key", F.substring("a", 1, gram))
    grams = (
        f"array_distinct(flatten(transform(sequence(1, {gram}), g -> if(length(b) < g, array(), "
        "transform(sequence(1, length(b) - g + 1), i -> substring(b, i, g))))))"
    )
    b = _values(texts, text_col, "b").select("b", F.explode(F.expr(grams)).alias("_key"))
    return salted_join(a, b, "_key", F.contains("b", "a")).select("a", "b").distinct()
