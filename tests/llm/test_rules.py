"""Quality rules against a brute-force version, on awkward texts and through SQL."""

import re
from collections import Counter

from tests.llm.helpers import frame, texts, words
from tidemark.llm import quality_rules

SF = "/root/testdata/sf0.01"
ODD = [
    "a b c a b c a b",
    "x " * 200,
    "one two three\none two three\n \n\none two three\n one two three",
    "# $ % & | < > * plain",
    "tab\tand\x0bvt\x0cff\rcr nbsp em\u0085nel",
    "ÄÖ ß é 😀 😀 😀 😀",
    "\n\n\n",
    "a",
    "a b",
]


def counts(text):
    text = text or ""
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, g in enumerate(windows) if seen[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_signals_against_brute_force(spark):
    rows = [*texts(3), *((1000 + i, t) for i, t in enumerate(ODD)), (5, "again"), (None, "a b c d"), (None, None)]
    df = frame(spark, rows)
    out = quality_rules.judged(df)
    got = sorted((r.row.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out.collect())
    assert got == sorted((doc or -1, *counts(text)) for doc, text in rows)
    assert quality_rules.keep(df).columns == df.columns
    assert quality_rules.judged(df.limit(0)).count() == 0


def test_rules_fail_outside_their_bounds(spark):
    rules = [
        quality_rules.Rule("short", "n_words", "one", 3, None),
        quality_rules.Rule("signs", "n_symbols", "n_words", None, 0.5),
        quality_rules.Rule("lines", "n_dup_lines", "n_lines", 0.0, 0.4),
    ]
    rows = [(1, "a b c"), (2, "a b"), (3, "# b # d"), (4, "# # # d"), (5, "a\na\na"), (6, ""), (7, None)]
    out = {r.row.doc_id: (r.failed, r.kept) for r in quality_rules.judged(frame(spark, rows), rules).collect()}
    assert out == {1: ([], True), 2: (["short"], False), 3: ([], True), 4: (["signs"], False), 5: (["lines"], False), 6: (["short"], False), 7: (["short"], False)}


def test_one_projection_without_user_functions(spark):
    plan = quality_rules.op12_quality_rules(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_base_rule_and_clean_documents(spark):
    out = quality_rules.op12_quality_rules(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    for r in out:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    rest = [r for r in out if not r.base_failed]
    assert all(r.kept for r in rest if r.quality == 1) and sum(r.kept for r in rest if r.quality == 0) <= 0.2 * len([r for r in rest if r.quality == 0])
