"""Words of documents that repeat benchmark windows: a prefix-filtered set join, in DataFrame operations only.

Every window of ``WINDOW`` consecutive item words is a set of word shingles with their offsets. Shingles are
ordered by how often they occur in the documents. Exact containment needs every shingle, so the necessary
prefix of a window is one shingle, its rarest: documents meet windows on that alone. A meeting fixes where the
window would start; the document's length must leave room for all of it there (length and position bounds),
and the words themselves are then compared. A window with a shingle that no document holds is dropped at once.

Null texts have no words; an item of fewer than ``WINDOW`` words is one window, one without words none. Rows
with equal id and text are one document and get the same answer; a null doc_id is an id like any other. Equal
item rows count once; an item without id marks words but isn't counted. Columns besides doc_id and text are
carried, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.repeats import NULL_ID
from tidemark.llm.shared import stash, table

WINDOW = 13
SHINGLE = 3
SHARE = 20
#: Rows of eight bytes; a vocabulary of more is joined by shuffle.
BROADCAST_ROWS = 1_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Digits, letters and everything beyond ASCII, with A-Z lower-cased."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lower, _BETWEEN), "")


def _shingles(of: Column, size: Column) -> Column:
    """Hashes of all runs of so many words; none if there are fewer words."""
    last = F.size(of) - size
    hashed = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(of, i + 1, size)))
    return F.when(last >= 0, hashed).otherwise(F.array().cast("array<bigint>"))


def _windows(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (wid, win), and the items of each (wid, item)."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w")).where(F.size("w") > 0)
    size = F.least(F.lit(WINDOW), F.size("w"))
    starts = F.explode(F.sequence(F.lit(1), F.size("w") - size + 1))
    cut = items.select("item", "w", size.alias("size"), starts.alias("at")).select("item", F.expr("slice(w, at, size)").alias("win"))
    named = stash(cut.select("item", "win", F.xxhash64("win").alias("wid")).distinct())
    return stash(named.groupBy("wid", "win").agg(F.lit(1)).select("wid", "win")), named.where("item IS NOT NULL").select("wid", "item")


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))
    return docs.select(F.struct("*").alias("row"), doc.alias("doc"), F.xxhash64(text).alias("h"))


def marked(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of docs as (row, doc, h, n_words, n_hit, wids), and the items (wid, item) of windows."""
    windows, items = _windows(benchmark)
    size = F.least(F.lit(SHINGLE), F.size("win"))
    held = windows.select("wid", F.size("win").alias("n"), F.posexplode(_shingles(F.col("win"), size)).alias("offset", "s"))
    vocabulary = stash(held.select("s").distinct())
    if vocabulary.count() <= BROADCAST_ROWS:
        vocabulary = F.broadcast(vocabulary)
    # items of one or two words have shorter shingles: a row of at most three sizes
    sizes = F.broadcast(windows.agg(F.collect_set(size).alias("sizes")))
    every = F.flatten(
        F.transform(
            "sizes", lambda z: F.transform(_shingles(F.col("w"), z), lambda s, i: F.struct(i.alias("pos"), s.alias("s")))
        )
    )
    texts = keyed(docs)
    split = texts.select("doc", "h", words(F.col("row.text")).alias("w"))
    spread = split.crossJoin(sizes).select("doc", "h", F.size("w").alias("n_words"), F.explode(every).alias("x"))
    met = stash(spread.select("doc", "h", "n_words", F.col("x.pos").alias("pos"), F.col("x.s").alias("s")).join(vocabulary, "s"))
    rarity = met.groupBy("s").agg(F.count("*").alias("often"))
    prefix = (
        held.join(rarity, "s", "left")
        .groupBy("wid", "n")
        .agg(F.count("*").alias("all"), F.count("often").alias("seen"), F.min(F.struct("often", "s", "offset")).alias("rarest"))
        .where("all = seen")
        .select("wid", "n", "rarest.s", "rarest.offset")
    )
    prefix = stash(prefix.join(windows, "wid"))
    start = F.col("pos") - F.col("offset")
    fits = (start >= 0) & (start + F.col("n") <= F.col("n_words"))
    candidates = stash(
        met.join(prefix, "s").where(fits).groupBy("doc", "h").agg(F.collect_set(F.struct(start.alias("at"), "win", "wid")).alias("found"))
    )
    same = F.filter("found", lambda c: F.slice(F.col("w"), c["at"] + 1, F.size(c["win"])) == c["win"])
    none = F.array().cast("array<struct<at:int,win:array<string>,wid:bigint>>")
    # the text travels to its candidates as it is and is split there
    met_texts = texts.join(candidates, ["doc", "h"], "left").select("row", "doc", "h", "found", words(F.col("row.text")).alias("w"))
    rows = met_texts.select("row", "doc", "h", F.size("w").alias("n_words"), F.coalesce(same, none).alias("found"))
    ordered = F.array_sort(F.transform("found", lambda c: F.struct(c["at"].alias("lo"), (c["at"] + F.size(c["win"])).alias("hi"))))
    union = F.aggregate(
        ordered,
        F.struct(F.lit(0).alias("total"), F.lit(0).alias("upto")),
        lambda acc, x: F.struct(
            (acc["total"] + F.greatest(F.lit(0), x["hi"] - F.greatest(x["lo"], acc["upto"]))).alias("total"),
            F.greatest(acc["upto"], x["hi"]).alias("upto"),
        ),
        lambda acc: acc["total"],
    )
    wids = F.array_distinct(F.transform("found", lambda c: c["wid"]))
    return rows.select("row", "doc", "h", F.col("n_words").cast("long").alias("n_words"), union.cast("long").alias("n_hit"), wids.alias("wids")), items


def is_contaminated(n_words: str = "n_words", n_hit: str = "n_hit") -> Column:
    return (F.col(n_hit) > 0) & (SHARE * F.col(n_hit) >= F.col(n_words))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted as strings), contaminated of every row of docs."""
    rows, items = marked(docs, benchmark)
    rows = stash(rows.select("row.doc_id", "doc", "h", "n_words", "n_hit", "wids"))
    named = rows.select("doc", "h", F.explode("wids").alias("wid")).distinct().join(items, "wid")
    listed = stash(named.groupBy("doc", "h").agg(F.array_sort(F.collect_set("item")).alias("items")))
    joined = rows.join(listed, ["doc", "h"], "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select("doc_id", "n_words", "n_hit", items.alias("items"), is_contaminated().alias("contaminated"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that aren't contaminated."""
    rows, _ = marked(docs, benchmark)
    return rows.where(~is_contaminated()).select("row.*")


_SQL_WORDS = r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP7_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({_SQL_WORDS.format("text")}, []) AS w FROM documents),
b AS (SELECT item_id, w, least(13, len(w)) AS size FROM (
    SELECT item_id, coalesce({_SQL_WORDS.format("text")}, []) AS w FROM benchmark) WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, size, array_to_string(w[p:p + size - 1], ' ') AS win FROM (
    SELECT *, unnest(generate_series(1, len(w) - size + 1)) AS p FROM b)),
sizes AS (SELECT DISTINCT size FROM windows),
spots AS (SELECT doc_id, size, p, array_to_string(w[p:p + size - 1], ' ') AS win FROM (
    SELECT doc_id, size, w, unnest(generate_series(1, len(w) - size + 1)) AS p FROM d, sizes WHERE len(w) >= size)),
found AS (SELECT s.doc_id, s.p, s.size, x.item_id FROM spots s JOIN windows x USING (size, win)),
hits AS (SELECT doc_id, count(DISTINCT q) AS n FROM (
    SELECT doc_id, unnest(generate_series(p, p + size - 1)) AS q FROM (SELECT DISTINCT doc_id, p, size FROM found)) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS named FROM (
    SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(i.n, 0)::BIGINT AS n_items,
    sha256(coalesce(named, '')) AS items_sha256, coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits h USING (doc_id) LEFT JOIN items i USING (doc_id)
"""
