"""Helpers that keep hot keys balanced, against plain definitions."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import similar, spread
from tidemark.functions.similar import containment_pairs, edit_pairs
from tidemark.functions.spread import block_join, cell_distinct, cell_mode, cells, latest, most_frequent, quantiles, salted_join, with_next
from tidemark.operators import metrics as mt
from tidemark.operators import trades as tr


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def words(rng, n, low, high, letters="abc"):
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randint(low, high))) for _ in range(n)})


@pytest.mark.parametrize("pieces", [0, 9])
@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_edit_pairs_lose_nothing(spark, monkeypatch, k, pieces):
    """By blocks and by pieces, at any number of edits."""
    monkeypatch.setattr(similar, "PIECES_UPTO", pieces)
    rng = random.Random(k)
    left = words(rng, 60, 1, 6) + words(rng, 60, 7, 14, "abcdef") + words(rng, 20, 3, 9, "aNé ~n\u4e2d") + ["aaaaaaaaa", "z"]
    right = words(rng, 30, 1, 6) + words(rng, 30, 7, 14, "abcdef") + left[::9]
    a = spark.createDataFrame([(x,) for x in left], "x string")
    b = spark.createDataFrame([(x,) for x in sorted(set(right))], "y string")
    got = [(r.a, r.b, r.distance) for r in edit_pairs(a, "x", b, "y", k).collect()]
    want = {(x, y, distance(x, y)) for x in left for y in set(right) if distance(x, y) <= k}
    assert set(got) == want and len(got) == len(set(got))
    assert len(want) > 20


@pytest.mark.parametrize("k", [2, 5])
def test_edit_pairs_have_no_nested_loop(spark, k):
    a = spark.range(1000).select(F.concat(F.lit("name"), "id").alias("x"))
    plan = edit_pairs(a, "x", a, "x", k)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    # the only nested-loop joins are the one-row totals of the hot-key check
    assert plan.count("BroadcastNestedLoopJoin") <= 4


def test_few_random_names_reach_the_distance(spark):
    """At five edits and 26 letters the bags let fewer than 2 % of all pairs through to the edit distance."""
    rng = random.Random(3)

    def names(n):
        part = lambda: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(rng.randint(3, 9)))
        return spark.createDataFrame([(f"{part()} {part()}",) for _ in range(n)], "v string")

    left, right = (names(n).select("v", *similar._bag("v", x)).withColumnRenamed("v", x) for n, x in ((1500, "_a"), (800, "_b")))
    met = block_join(left, right, similar._alike("_a", "_b", 5), left_rows=500, right_rows=300).count()
    assert met < 0.02 * 1500 * 800


def test_block_join_meets_every_pair_once(spark):
    left = spark.range(70).selectExpr("id AS x", "id % 3 AS part")
    right = spark.range(50).selectExpr("id AS y")
    got = block_join(left, right, (F.col("x") + F.col("y")) % 5 == 0, left_rows=16, right_rows=7).select("x", "y")
    assert sorted(map(tuple, got.collect())) == sorted((x, y) for x in range(70) for y in range(50) if (x + y) % 5 == 0)
    assert block_join(left.limit(0), right, F.lit(True)).count() == 0


def test_containment_is_literal(spark):
    names = spark.createDataFrame([("ab",), ("a%c",), ("hello wor",), ("zzz",), ("",), (None,)], "n string")
    texts = spark.createDataFrame([("xxabyy",), ("abc",), ("a%c",), ("say hello world",), (None,), ("b",)], "t string")
    got = {(r.a, r.b) for r in containment_pairs(names, "n", texts, "t").collect()}
    assert got == {("ab", "xxabyy"), ("ab", "abc"), ("a%c", "a%c"), ("hello wor", "say hello world")}


@pytest.mark.parametrize("hot_left", [True, False])
@pytest.mark.parametrize("hot_right", [True, False])
def test_salted_join_equals_join(spark, monkeypatch, hot_left, hot_right):
    monkeypatch.setattr(spread, "EASY", 10)
    def side(n, hot, name):
        key = F.when((F.col("id") % 3 == 0) & F.lit(hot), "hot").when(F.col("id") % 101 == 0, None).otherwise((F.col("id") % 97).cast("string"))
        return spark.range(n).select(key.alias("k"), (F.col("id") % 2).alias("part"), F.col("id").alias(name))

    left, right = side(3000, hot_left, "id").withColumnRenamed("part", "p"), side(600, hot_right, "v").withColumnRenamed("part", "q")
    cond = (F.col("id") + F.col("v")) % 4 == 0
    got, want = (df.select("k", "p", "id", "q", "v") for df in (salted_join(left, right, "k", cond), left.join(right, "k").where(cond)))
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count() and got.count() > 100
    two = salted_join(left.withColumn("j", F.col("p")), right.withColumn("j", F.col("q")), ["k", "j"])
    assert two.count() == left.join(right, (left["k"] == right["k"]) & (left["p"] == right["q"])).count()


def test_salted_join_deals_out_keys_of_both_sides(spark, monkeypatch):
    """A key with a third of the rows on both sides: no cell gets more than a 32nd of it from either."""
    left = spark.range(30000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    right = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    assert "_of_left" not in salted_join(left, right, "k")._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(spread, "EASY", 500)
    met = salted_join(left, right, "k").where("k = 'hot'")
    assert met.count() == 10000 * 1000
    plan = salted_join(left, right, "k")._jdf.queryExecution().analyzed().toString()
    assert plan.count("xxhash64") == 2
    per_row = met.groupBy("id").count().agg(F.min("count"), F.max("count")).first()
    assert tuple(per_row) == (1000, 1000)



@pytest.mark.parametrize("size", [1, 2, 5, 100, 1001])
def test_quantiles_are_exact(spark, size):
    rng = random.Random(size)
    values = [round(rng.choice([1, -1, 1000]) * rng.random() * 10 ** rng.randint(0, 6), 2) for _ in range(size)]
    values += values[: size // 3]
    df = spark.createDataFrame([("k", v) for v in values] + [("other", 5.0), ("k", None)], "k string, v double")
    df = df.withColumn("v", F.col("v").cast("decimal(15,2)"))
    got = quantiles(df, ["k"], "v", {"a": 0.25, "b": 0.5, "c": 0.95}).where("k = 'k'").first()
    for name, q in (("a", 0.25), ("b", 0.5), ("c", 0.95)):
        assert got[name] == pytest.approx(np.quantile(values, q), abs=1e-6)


def test_next_and_latest(spark):
    rows = [("a", f"2024-01-0{d} 0{h}:00:00", i) for i, (d, h) in enumerate([(1, 1), (1, 1), (1, 5), (3, 2), (4, 0)])]
    rows.append(("b", "2024-01-01 00:00:00", 9))
    df = spark.createDataFrame(rows, "k string, s string, i int").select("k", F.col("s").cast("timestamp_ntz").alias("ts"), "i")
    got = {r.i: r.nxt for r in with_next(df, ["k"], "ts", ["i"], "nxt").collect()}
    plain = F.lead("ts").over(Window.partitionBy("k").orderBy("ts", "i"))
    assert got == {r.i: r.nxt for r in df.withColumn("nxt", plain).collect()}
    assert {r.k: r.i for r in latest(df, ["k"], ["ts", "i"]).collect()} == {"a": 4, "b": 9}


def test_mode_ties_take_smallest(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "y"), ("a", "x"), ("b", "z")], "k string, v string")
    got = {r.k: (r.m, r.n) for r in most_frequent(df, ["k"], "v", "m", "n").collect()}
    assert got == {"a": ("x", 2), "b": ("z", 1)}


def test_cells_give_modes_and_totals_at_once(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), rng.choice(["x", "y", None]), rng.randint(1, 4), rng.randint(-5, 5)) for _ in range(300)] + [("c", None, 2, 1), ("d", "y", 1, 0), ("d", "x", 1, 0)]
    df = spark.createDataFrame(rows, "k string, v string, w int, amount int")
    found = cells(df, ["k"], {"v": F.col("v"), "w": F.col("w")}, F.sum("amount").alias("amount"))
    one = F.col("kind") == "w"
    got = found.groupBy("k").agg(
        F.sum(F.when(one, F.col("n"))), F.sum(F.when(one, F.col("amount"))), cell_mode("v")["value"], cell_mode("v")["n"], cell_distinct("v"), cell_distinct("w")
    )
    for k, n, amount, mode, often, values, others in got.collect():
        own = [r for r in rows if r[0] == k]
        counted = {v: sum(r[1] == v for r in own) for v in {r[1] for r in own}}
        assert (n, amount, often) == (len(own), sum(r[3] for r in own), max(counted.values())) and counted[mode] == often
        assert (values, others) == (len({r[1] for r in own} - {None}), len({r[2] for r in own}))
        assert mode == min((v for v in counted if counted[v] == often), key=lambda v: (v is not None, v or ""))


def test_trade_reports_scan_the_trades_once(spark):
    trades = trades_of(spark)
    for report in (tr.equity_customer_activity(trades, as_of="2001-08-02"), tr.equity_currency_exposure(trades)):
        assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def trades_of(spark):
    from tidemark.plans.catalog import FOLDERS, MARTS
    from tidemark.plans.workspace import Workspace

    return Workspace.of(spark, "/root/testdata/sf0.001", MARTS, FOLDERS)["in_equity_trades"]


def test_facts_are_reduced_before_they_are_joined(spark):
    """Metrics by the columns of another table: one aggregate under the join; the same values as a plain query."""
    fact = spark.range(900).select(
        (F.col("id") % 7).alias("customer_id"), (F.col("id") % 3).alias("kind"), ((F.col("id") * 13) % 101 - 20).alias("x"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("y")
    )
    who = spark.createDataFrame([(i, "AB"[i % 2], i) for i in range(6)], "id long, country string, tier long")
    model = mt.Model(
        "fact", {"n": mt._count("y"), "total": mt._sum("x"), "average": mt._avg("y"), "top": mt._max("x"), "low": mt._count_if(lambda: F.col("x") < 0)}, {"who": ("customer_id", "id", ("country", "tier"))}
    )
    tables = {"fact": fact, "who": who}.__getitem__
    both = fact.join(who, fact["customer_id"] == who["id"], "left")
    for dims in (["country", "kind"], ["kind"], ["tier"], []):
        got = mt.metric_query(model, tables, metrics=list(model.metrics), dims=dims)
        want = both.groupBy(*dims).agg(F.count("y"), F.sum("x"), F.round(F.avg("y"), 2), F.max("x"), F.count_if(F.col("x") < 0))
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert ("Join" in plan) == (bool(set(dims) & {"country", "tier"})) and (plan.count("Aggregate [") >= 2 or "Join" not in plan)
    assert mt.metric_query(model, tables, metrics=["n", "low"], filters=F.col("x") > 1000).first() == (0, 0)
    with pytest.raises(KeyError):
        mt.metric_query(model, tables, metrics=["n"], dims=["nowhere"])


def test_blocks_of_names_have_tasks_of_their_own(spark):
    """Blocks are few bytes, so the adaptive planner would compare all of them in one task."""
    names = spark.range(300).select(F.concat(F.lit("name "), F.col("id").cast("string")).alias("v"))
    met = spread.block_pairs(names.withColumnRenamed("v", "a"), names.withColumnRenamed("v", "b"), "a", "b", size=50)
    cells = met.select(F.spark_partition_id().alias("part"), F.size("mine") * F.size("theirs")).collect()
    assert len(cells) == 36 and sum(n for _, n in cells) == 300 * 300
    assert len({part for part, _ in cells}) > 12
    grid = block_join(names.withColumnRenamed("v", "a"), names.withColumnRenamed("v", "b"), F.lit(True), left_rows=50, right_rows=50)
    assert len({row[0] for row in grid.select(F.spark_partition_id()).distinct().collect()}) > 12


@pytest.mark.parametrize("k", [4, 5, 9])
def test_names_longer_than_a_machine_word(spark, k):
    rng = random.Random(k)
    left = words(rng, 25, 58, 72, "ab") + ["", "a", "a" * 64, "a" * 65]
    right = [x[: rng.randint(50, 80)] + "b" * rng.randint(0, 3) for x in left] + ["", "ba", "a" * 69]
    a, b = (spark.createDataFrame([(x,) for x in sorted(set(side))], "v string") for side in (left, right))
    got = [tuple(r) for r in edit_pairs(a, "v", b, "v", k).select("a", "b", "distance").collect()]
    want = {(x, y, distance(x, y)) for x in set(left) for y in set(right) if distance(x, y) <= k}
    assert set(got) == want and len(got) == len(set(got))


def test_busy_join_has_tasks_for_its_pairs(spark, monkeypatch):
    """Two keys with many pairs and few bytes: the tasks follow the pairs, the rows stay the same."""
    monkeypatch.setattr(spread, "PAIRS", 100)
    a = spark.range(200).selectExpr("id AS x", "id % 20 AS k")
    b = spark.range(300).selectExpr("id AS y", "id % 20 AS k")
    plain = a.join(b, "k").where("(x + y) % 3 = 0")
    joined = salted_join(a, b, "k", (F.col("x") + F.col("y")) % 3 == 0, busy=True)
    assert sorted(map(tuple, joined.select("k", "x", "y").collect())) == sorted(map(tuple, plain.select("k", "x", "y").collect()))
    assert len({r[0] for r in joined.select(F.spark_partition_id()).distinct().collect()}) > 4


def test_trades_are_read_through_their_join(spark):
    """A report on trades stores no wide copy of them and takes only its own columns from the line items."""
    import __spark_entry__ as entry

    plan = entry.queries()["cmd_delta_exposure"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "l_orderkey" in line)
    assert "lineitem.parquet" in scan and "l_tax" not in scan and "in_cmd_trades" not in plan


def test_positions_are_aggregated_for_their_readers(spark):
    """Risk reports store no positions, sum only the columns they read, and take rates and spreads from one pass."""
    import __spark_entry__ as entry

    plan = entry.queries()["frtb_sensitivities"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert not any("positions" in line for line in scans) and "l_tax" not in plan
    assert sum("lineitem.parquet" in line for line in scans) == 3


def test_view_is_derived_before_hits_multiply_it(spark):
    """What doesn't depend on a list hit is computed below the join with the hits."""
    import __spark_entry__  # noqa: F401
    from tidemark.plans.catalog import FOLDERS, MARTS
    from tidemark.plans.workspace import Workspace

    w = Workspace.of(spark, "/root/testdata/sf0.001", MARTS, FOLDERS)
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        lines = MARTS["customer_360"](w)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    top = next(i for i, line in enumerate(lines) if "Join" in line)
    assert not any("levenshtein" in line for line in lines[:top]) and any("levenshtein" in line for line in lines[top:])


def test_view_is_joined_for_its_readers(spark):
    """Readers that count a customer once read no list hits; the strongest rows come without the product of matches."""
    import __spark_entry__  # noqa: F401
    from tidemark.operators import customer as cu
    from tidemark.operators import loans as ln
    from tidemark.operators import reports as rp
    from tidemark.plans import lookups
    from tidemark.plans.catalog import FOLDERS, MARTS
    from tidemark.plans.tables import AS_OF
    from tidemark.plans.workspace import Workspace

    w = Workspace.of(spark, "/root/testdata/sf0.001", MARTS, FOLDERS)
    view = w["customer_360"]
    for df in (rp.credit_overview(view), ln.build_applications(w["extract_flat"], view, lookups.products(spark))):
        scans = {line.split("FileScan")[1] for line in df._jdf.queryExecution().toString().splitlines() if "FileScan" in line}
        assert not any("customer_360" in x or "customer_screening" in x for x in scans)
    # every customer with several persons and several hits, some of them of one entity
    persons, hits = w("customer_persons", "customer_screening")
    more = [persons.withColumn(f"exposed_person_{x}_match_id", F.lit(f"P{x}")).withColumn(f"exposed_person_{x}_risk_level", F.lit(y)) for x, y in (("exact", "LOW"), ("fuzzy", "CRITICAL"))]
    kinds = hits.select("customer_id").distinct().join(hits.drop("customer_id", "match_type").limit(3), how="cross")
    again = [kinds.withColumn("match_type", F.lit(x)) for x in ("FUZZY_MATCH", "EXACT_MATCH")]
    for people, found in ((persons, hits), (persons.union(more[0]).union(more[1]), again[0].unionByName(again[1]))):
        whole = cu.one_per_customer(cu.customer_view(people, found, as_of=AS_OF))
        once = cu.customers_once(people, found, as_of=AS_OF).select(*whole.columns)
        assert whole.exceptAll(once).isEmpty() and once.exceptAll(whole).isEmpty() and not once.isEmpty()


def test_a_step_compares_many_names_with_a_block():
    """One batch of results for many names of either block, not one for each name; parts of a block give the same pairs."""
    from tidemark.functions import edits

    rng = random.Random(5)
    left, right = words(rng, 120, 0, 9, "abé"), words(rng, 200, 0, 12, "abé中")
    want = {(x, y, distance(x, y)) for x in left for y in right if distance(x, y) <= 4}
    for marks in (edits.MARKS, 3000):
        edits.MARKS, kept = marks, edits.MARKS
        batches = list(edits.near_pairs(left, right, 4))
        edits.MARKS = kept
        got = [(left[i], right[j], int(n)) for rows, cols, found in batches for i, j, n in zip(rows, cols, found, strict=True)]
        assert set(got) == want and len(got) == len(want)
        assert marks == 3000 or len(batches) < len(left)


def test_matches_are_shuffled_without_the_columns_of_the_list(spark):
    """Entries join last, and an entry that has the customer's name under another spelling needs no join to be dropped."""
    from tidemark.operators import screening as sc

    people = spark.createDataFrame(
        [("1", "Ann Lee", "ANN LEE"), ("2", "Bo Ray", "BO RAY"), (None, "Ann Lee", "ANN LEE")], "customer_id string, customer_name string, _name string"
    )
    listed = spark.createDataFrame(
        [("E1", "Ann Lee", None), ("E1", "Ann Leo", "x"), ("E2", "Ann Lea", "x"), (None, "Ann Lee", "x"), ("E3", "Bo Rays", "bo ray of old")],
        "entity_id string, entity_name string, entity_aliases string",
    )
    pairs = spark.createDataFrame(
        [("ANN LEE", x, n) for x, n in (("ANN LEE", 0), ("ANN LEO", 1), ("ANN LEA", 1))] + [("BO RAY", "BO RAYS", 1)], "a string, b string, distance int"
    )
    found = sc.fuzzy_match(people, listed, pairs)
    got = sorted((str(r.customer_id), str(r.entity_id), r.entity_name, r.edit_distance) for r in found.collect())
    assert got == [
        ("1", "E2", "Ann Lea", 1), ("1", "None", "Ann Lee", 0), ("2", "E3", "Bo Rays", 1), ("None", "E1", "Ann Lee", 0),
        ("None", "E1", "Ann Leo", 1), ("None", "E2", "Ann Lea", 1), ("None", "None", "Ann Lee", 0),
    ]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan
    aliases = spark.createDataFrame([("BO RAY", "BO RAY OF OLD")], "a string, b string")
    assert [(r.customer_id, r.entity_id) for r in sc.alias_match(people, listed, aliases).collect()] == [("2", "E3")]


def test_sorted_matches_are_spread_by_customer(spark):
    """Most matches have the same accuracy; a sort by it alone would put them into one task."""
    from tidemark.operators import customer as cu
    from tidemark.operators import reports as rp

    view = spark.range(4000).select(
        F.col("id").cast("string").alias("customer_id"), F.lit("n").alias("full_name"), F.lit("c").alias("country"),
        F.lit("FUZZY_MATCH").alias("sanctions_match_type"), F.lit(75.0).alias("sanctions_match_accuracy_percent"),
        F.lit(True).alias("requires_sanctions_review"), F.lit("CRITICAL").alias("overall_sanctions_risk"),
    )
    status = spark.range(4000).select(
        F.col("id").cast("string").alias("customer_id"), F.lit(True).alias("requires_investigation"), F.lit("IMMEDIATE_BLOCK").alias("required_action"),
        F.lit(False).alias("is_sla_breach"), F.lit(9).alias("days_since_screening"), F.lit("p").alias("pep_match_name"), F.lit("s").alias("sanctions_match_name"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for df in (rp.match_list(view, "sanctions"), cu.screening_alerts(status)):
            assert df.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_hits_are_made_distinct_only_where_entries_repeat(spark):
    """The same view as with all hits made distinct; readers of few columns join no others; one hit a kind for yes or no."""
    from tidemark.operators import customer as cu
    from tidemark.plans.catalog import FOLDERS, MARTS
    from tidemark.plans.tables import AS_OF
    from tidemark.plans.workspace import Workspace

    w = Workspace.of(spark, "/root/testdata/sf0.001", MARTS, FOLDERS)
    people, hits = w("customer_persons", "customer_screening")
    one = hits.select("entity_id").first()[0]
    none = hits.limit(2).withColumn("entity_id", F.lit(None).cast("string"))
    found = hits.union(hits.where(F.col("entity_id") == one)).union(none).union(none)
    listed = spark.createDataFrame([(one,), (one,), (None,), (None,), ("other",)], "entity_id string")
    whole = cu.customer_view(people, found, as_of=AS_OF)
    part = cu.customer_view(people, found, as_of=AS_OF, repeated=cu.repeated_entries(listed))
    assert whole.exceptAll(part).isEmpty() and part.exceptAll(whole).isEmpty() and not whole.isEmpty()
    plan = w["customer_360"].select("customer_id", "full_name", "sanctions_match_type")._jdf.queryExecution().executedPlan().toString()
    # the hits of repeated entries are read whole
    assert {"authority" in x for x in plan.splitlines() if "FileScan" in x and "match_type" in x} == {True, False}
    names = ["customer_id", "exposed_person_match_type", "sanctions_match_type", "overall_risk_rating", "requires_sanctions_review"]
    kinds = cu.customer_kinds(people, found, as_of=AS_OF).select(*names).distinct()
    assert kinds.exceptAll(whole.select(*names).distinct()).isEmpty() and kinds.count() == whole.select(*names).distinct().count()
