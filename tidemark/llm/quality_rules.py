"""Quality rules: a table of thresholds compiled into one projection, without user functions.

Words are runs of anything but space and ``0x09-0x0D``, lines are split at ``\\n`` and count if they hold a word. All
signals of a text come from its own row: arrays and higher-order functions only, no shuffle.

* words that repeat: hashes of three-word windows are sorted within the row, then the words of those with an equal
  neighbour; the places of equal windows in order say how many words they cover;
* repeated lines: lines less the distinct ones.

A rule is (name, numerator, denominator, low, high) over those signals; a ratio outside [low, high] fails, a
denominator of zero passes. The registered query adds the fixed base rule of its contract.

Null and empty texts have no words: all counts are zero, and the base rule fails them. Each row of the input gives one
row, whatever its id; repeated rows, null ids and other columns don't matter. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import table

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MARKS = ".,!?;:\"'()"
WINDOW = 3
#: Common words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to a in is that it for was on with as this be by are at from "
    "der die und den das von zu mit des sich auf für nicht dem ist im ein eine als "
    "de la le et les du un que pour une est qui dans par sur au pas avec en "
    "el y los las del se no por con su para es al lo"
).split()


@dataclass(frozen=True)
class Rule:
    """Fails a text whose numerator / denominator lies outside low..high; None leaves a side open."""

    name: str
    numerator: str
    denominator: str
    low: float | None = None
    high: float | None = None


RULES: tuple[Rule, ...] = (
    Rule("length", "n_words", "one", 50, None),
    Rule("word_length", "word_chars", "n_words", 2.0, 14.0),
    Rule("symbols", "n_symbols", "n_words", None, 0.1),
    Rule("stop_words", "n_stop_words", "n_words", 0.05, None),
    Rule("letters", "n_letters", "word_chars", 0.6, None),
    Rule("capitals", "n_capitals", "word_chars", None, 0.4),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 0.5),
    Rule("short_lines", "n_words", "n_lines", 3.0, None),
    Rule("repeated_words", "n_repeat_words", "n_words", None, 0.5),
)


def _let(value: Column, body) -> Column:
    """body of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), "")


def _twice(ordered: Column, part, at) -> Column:
    """Places, in order, of the elements whose part equals that of a neighbour."""

    def place(own: Column, k: Column) -> Column:
        equal = (part(F.get(ordered, k + step)) == part(own) for step in (-1, 1))
        return F.when(reduce(or_, (F.coalesce(e, F.lit(False)) for e in equal)), at(own))

    return F.array_compact(F.transform(ordered, place))


def _repeat_words(words: Column, size: Column) -> Column:
    """How many words lie in a window that occurs twice or more."""

    def window(i: Column) -> list[Column]:
        return [F.get(words, i + k) for k in range(WINDOW)]

    def key(i: Column) -> Column:
        return F.shiftleft(F.xxhash64(*window(i)), 32).bitwiseOR(i.cast("long"))

    # half a hash leaves few windows, whose words are then compared
    keys = F.when(size >= WINDOW, F.sort_array(F.transform(F.sequence(F.lit(0), size - WINDOW), key)))
    likely = _let(keys, lambda x: _twice(x, lambda k: F.shiftright(k, 32), lambda k: k.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")))
    same = F.sort_array(F.transform(likely, lambda i: F.struct(F.concat_ws(" ", *window(i)).alias("text"), i.alias("at"))))
    places = F.sort_array(_let(same, lambda x: _twice(x, lambda w: w["text"], lambda w: w["at"])))

    def covered(places: Column) -> Column:
        gaps = F.transform(places, lambda at, k: F.least(F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - at, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)

    return F.coalesce(_let(places, covered), F.lit(0).cast("long"))


def with_signals(docs: DataFrame) -> DataFrame:
    """row (the columns of docs as they are) and the signals of its text, all as longs."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    has_word = lambda line: F.length(F.translate(line, SPACES, "")) > 0
    parts = docs.select(
        F.struct("*").alias("row"),
        text.alias("text"),
        _words(text).alias("words"),
        F.filter(F.split(text, "\n", -1), has_word).alias("lines"),
    )

    def matches(pattern: str) -> Column:
        return F.length("text") - F.length(F.regexp_replace("text", pattern, ""))

    size = F.size("words")
    signals = {
        "n_words": size,
        "word_chars": F.length(F.translate("text", SPACES, "")),
        "n_symbols": F.length("text") - F.length(F.translate("text", SYMBOLS, "")),
        "n_lines": F.size("lines"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_stop_words": F.size(F.filter("words", lambda w: F.lower(F.btrim(w, F.lit(MARKS))).isin(*STOP_WORDS))),
        "n_letters": matches(r"\p{L}+"),
        "n_capitals": matches(r"\p{Lu}+"),
        "n_repeat_words": _repeat_words(F.col("words"), size),
    }
    return parts.select("row", *(s.cast("long").alias(name) for name, s in signals.items()), F.lit(1).cast("long").alias("one"))


def failures(rules: Sequence[Rule]) -> dict[str, Column]:
    """A condition of the signals for every rule, true where the rule fails."""
    out = {}
    for rule in rules:
        ratio = F.try_divide(F.col(rule.numerator).cast("double"), F.col(rule.denominator))
        sides = [F.lit(False)]
        sides += [] if rule.low is None else [ratio < rule.low]
        sides += [] if rule.high is None else [ratio > rule.high]
        out[rule.name] = F.coalesce(reduce(or_, sides), F.lit(False))
    return out


def judged(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """row, the signals, failed (names of the rules that fail, in the order of the table) and kept."""
    failed = F.array_compact(F.array(*(F.when(fails, F.lit(name)) for name, fails in failures(rules).items())))
    out = with_signals(docs).withColumn("failed", failed)
    return out.withColumn("kept", F.size("failed") == 0)


def keep(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of docs that pass all rules."""
    return judged(docs, rules).where("kept").select("row.*")


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judged(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select("row.doc_id", *counts, base.alias("base_failed"), (~base & F.col("kept")).alias("kept"))


def _sql_rule(rule: Rule) -> str:
    ratio = f"{rule.numerator}::DOUBLE / nullif({rule.denominator}, 0)"
    sides = ([f"{ratio} < {rule.low}"] if rule.low is not None else []) + ([f"{ratio} > {rule.high}"] if rule.high is not None else [])
    return f"NOT coalesce({' OR '.join(sides)}, false)"


OP12_SQL = f"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), g AS (
    SELECT doc_id, unnest(list_transform(range(1, len(w) - 1), lambda i: {{'i': i, 'g': w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]}})) AS x FROM d
), r AS (
    SELECT doc_id, x.i AS i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, x.g) >= 2
), c AS (
    SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM r, (VALUES (0), (1), (2)) v(k) GROUP BY doc_id
), s AS (
    SELECT d.doc_id, len(w) AS n_words, length(list_aggregate(list_concat([''], w), 'string_agg', '')) AS word_chars, 1 AS one,
        len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
        len(list_filter(w, lambda x: list_contains({list(dict.fromkeys(STOP_WORDS))}, lower(trim(x, '.,!?;:"''()'))))) AS n_stop_words,
        len(regexp_extract_all(t, '\\p{{L}}')) AS n_letters, len(regexp_extract_all(t, '\\p{{Lu}}')) AS n_capitals,
        coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM d LEFT JOIN c USING (doc_id)
), l AS (
    SELECT *, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
    FROM s
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND {' AND '.join(_sql_rule(r) for r in RULES)} AS kept
FROM l
"""
