"""Hard negatives by integer inner products in a residue number system.

Components are scaled and rounded down to integers. Each is kept as its remainders modulo a few small primes; the
remainders are multiplied as float32 matrices, exactly, as no sum of ``INNER`` products of centred remainders reaches
2**24. The Chinese remainder theorem gives the signed scores back: as many primes are used as the largest possible
score of a block needs, so scores are exact for vectors of any size (beyond 64 bits they stop at the largest or
smallest long).

Anchors travel in blocks, rows in shards; every block meets every shard under the number of the shard, in tasks of
bounded size, twice. The first visit keeps each anchor's best rows of its own label, the second those of other labels
whose score lies in the window under each positive's. Windows over (anchor) and (anchor, positive) select among what
shards have found; Spark limits the rows of each task by rank before it shuffles them.

Rows with a null id, label or vector, or with components that are null or not finite, take no part. Equal rows count
once; rows that carry the anchor's id are neither its positives nor its negatives. Rows that give one id several
vectors or labels are several candidates, and as anchors share one list. Vectors of another dimension don't meet.
Ties go to the smaller id. An anchor without positives, or a positive without negatives in its window, gives no row;
nor does an empty table. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import repeats
from tidemark.llm.shared import stash, table

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
#: Negatives score from 80 to 100 per cent of their positive.
LOW, HIGH = 80, 100
SHARD_ROWS, BLOCK_ANCHORS, STEP_ANCHORS = 8192, 1024, 64
INNER = 64
LONG = (1 << 63) - 1
PACKED = "part long, dim int, n int, ids binary, labels binary, vectors binary, caps binary"
SHARD = ["n", "ids", "labels", "vectors"]
FOUND = "anchor_id long, positive_id long, positive_score long, vec_id long, score long"


def primes(count: int) -> list[int]:
    """The largest primes p for which INNER * ((p - 1) / 2)**2 stays under 2**24, falling."""
    top = 2 * int(((1 << 24) / INNER) ** 0.5) + 1
    sieve = np.ones(top, bool)
    sieve[:2] = False
    for i in range(2, int(top**0.5) + 1):
        if sieve[i]:
            sieve[i * i :: i] = False
    fit = [int(p) for p in np.flatnonzero(sieve)[::-1] if INNER * ((int(p) - 1) // 2) ** 2 < 1 << 24]
    if count > len(fit):
        raise ValueError(f"scores need {count} primes, {len(fit)} are small enough")
    return fit[:count]


def enough(bound: int) -> list[int]:
    """Primes whose product holds every score from -bound to bound."""
    count, product = 0, 1
    while product <= 2 * bound:
        count += 1
        product = product * primes(count)[-1]
    return primes(max(count, 1))


def centred(x: np.ndarray, p: int) -> np.ndarray:
    """Remainders of whole doubles modulo p, from -(p - 1) / 2 to (p - 1) / 2, as float32; exact for any double."""
    r = np.fmod(x, p)
    r -= p * (r > p // 2)
    r += p * (r < -(p // 2))
    return r.astype(np.float32)


def product(left: np.ndarray, right: np.ndarray, p: int) -> np.ndarray:
    """left @ right.T modulo p from centred remainders."""
    out = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, left.shape[1], INNER):
        out += centred(left[:, at : at + INNER] @ right[:, at : at + INNER].T, p)
        if at:
            out = centred(out, p)
    return out


def signed(parts: list[np.ndarray], moduli: list[int]) -> np.ndarray:
    """The integers whose remainders are parts, by mixed radix digits; longs, or Python integers where those are too small."""
    whole = int(np.prod(np.array(moduli, object)))
    kind = np.int64 if whole < LONG else object
    digits: list[np.ndarray] = []
    for i, p in enumerate(moduli):
        digit = parts[i].astype(np.float64)
        for j, before in enumerate(digits):
            digit = centred((digit - before) * pow(moduli[j], -1, p), p).astype(np.float64)
        digits.append(digit)
    out, weight = np.zeros(parts[0].shape, np.int64).astype(kind), 1
    for digit, p in zip(digits, moduli, strict=True):
        out = out + digit.astype(np.int64).astype(kind) * weight
        weight *= p
    return out


def largest(left: np.ndarray, right: np.ndarray) -> int:
    """A bound of the absolute inner products: that of the lengths, with room for their rounding."""
    lengths = []
    for x in (left, right):
        most = np.abs(x).max(initial=1.0)
        lengths.append(int(most * np.sqrt(((x / most) ** 2).sum(axis=1)).max(initial=0) * (1 + 1e-9)) + 1)
    return lengths[0] * lengths[1]


def scores(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Exact inner products of rows of whole doubles as longs, some rows of left at a time: (first row, scores)."""
    moduli = enough(largest(left, right))
    rests = [(centred(left, p), centred(right, p)) for p in moduli]
    for at in range(0, len(left), STEP_ANCHORS):
        out = signed([product(a[at : at + STEP_ANCHORS], b, p) for p, (a, b) in zip(moduli, rests, strict=True)], moduli)
        yield at, out if out.dtype == np.int64 else np.clip(out, -LONG - 1, LONG).astype(np.int64)


def best(score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores in falling order, ties to the earlier place."""
    places = np.arange(len(score))
    if len(score) > k:
        kth = np.partition(score, len(score) - k)[len(score) - k]
        above, level = np.flatnonzero(score > kth), np.flatnonzero(score == kth)
        places = np.concatenate((above, level[: k - len(above)]))
    return places[np.argsort(~score[places], kind="stable")]


def _packed(rows: pa.Table) -> pa.Table:
    """applyInArrow function: the rows of a part, by id, as one row of arrays."""
    rows = rows.combine_chunks().to_batches()[0]
    get = lambda name: rows.column(rows.schema.get_field_index(name))
    dim, ids = get("dim")[0].as_py(), get("vec_id").to_numpy(zero_copy_only=False)
    # far beyond what scores can tell apart
    vectors = np.clip(np.floor(repeats.lists(get("v"))[0].astype(np.float64)), -(2.0**600), 2.0**600).reshape(len(ids), dim)
    labels = get("label").to_numpy(zero_copy_only=False)
    caps = repeats.lists(get("caps"))[0].astype(np.int64).reshape(len(ids), -1)
    order = np.argsort(ids, kind="stable")
    return pa.table(
        [pa.array([get("part")[0].as_py()], pa.int64()), pa.array([dim], pa.int32()), pa.array([len(ids)], pa.int32())]
        + [pa.array([np.ascontiguousarray(x[order]).tobytes()], pa.binary()) for x in (ids, labels, vectors, caps)],
        [c.split()[0] for c in PACKED.split(", ")],
    )


def _positives(score: np.ndarray, able: np.ndarray, caps: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple]:
    """The k best of an anchor's own label in a shard."""
    at = np.flatnonzero(able)
    for i in at[best(score[at], k)]:
        yield 0, 0, int(ids[i]), int(score[i])


def _negatives(score: np.ndarray, able: np.ndarray, caps: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple]:
    """For each positive of an anchor the k best of other labels that lie in its window."""
    windows = [(int(p), int(s), -(-LOW * int(s) // 100), HIGH * int(s) // 100) for p, s in caps.reshape(2, -1).T if s >= 0]
    if not windows:
        return
    at = np.flatnonzero(able & (score >= min(w[2] for w in windows)) & (score <= max(w[3] for w in windows)))
    at = at[np.argsort(~score[at], kind="stable")]
    falling = ~score[at]
    for positive, cap, low, high in windows:
        first = int(np.searchsorted(falling, ~high))
        for i in at[first : first + k]:
            if score[i] >= low:
                yield positive, cap, int(ids[i]), int(score[i])


def _visits(select: Callable, same_label: bool, k: int) -> Callable:
    """mapInArrow function: (anchor block, shard) rows to what select finds for each anchor in the shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda name: batch.column(batch.schema.get_field_index(name))[row]  # noqa: B023, E731

                def array(name: str, kind: type, rows: int, get: Callable = get) -> np.ndarray:
                    return np.frombuffer(get(name).as_buffer(), kind).reshape(rows, -1)

                n, own_n = get("n").as_py(), get("a_n").as_py()
                ids, labels, vectors = array("ids", np.int64, n)[:, 0], array("labels", np.int64, n)[:, 0], array("vectors", float, n)
                own, own_labels, anchors = (array(f"a_{c}", t, own_n) for c, t in (("ids", np.int64), ("labels", np.int64), ("vectors", float)))
                caps = array("a_caps", np.int64, own_n)
                found = []
                for at, score in scores(anchors, vectors):
                    some = slice(at, at + len(score))
                    able = ((labels == own_labels[some]) == same_label) & (ids != own[some])
                    for i in range(len(score)):
                        anchor = int(own[at + i, 0])
                        found += [(anchor, *x) for x in select(score[i], able[i], caps[at + i], ids, k)]
                columns = list(zip(*found, strict=True)) if found else [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [c.split()[0] for c in FOUND.split(", ")])

    return run


def _dealt(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
    """rows packed into parts of about so many, numbered from 0, and the number of parts."""
    count = max(1, -(-rows.count() // size))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("vec_id", "v"), F.lit(count)))
    return dealt.groupBy("part", "dim").applyInArrow(_packed, PACKED), count


def _meet(anchors: DataFrame, shards: DataFrame, count: int, visit: Callable) -> DataFrame:
    """What visit finds for each anchor in each shard: a stated set of queries against all rows, block by block."""
    blocks, _ = _dealt(anchors, BLOCK_ANCHORS)
    blocks = blocks.select("dim", *(F.col(c).alias(f"a_{c}") for c in [*SHARD, "caps"]))
    blocks = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(count - 1)).cast("array<bigint>")))
    return stash(blocks.join(shards, ["part", "dim"]).mapInArrow(visit, FOUND))


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, scale: int = SCALE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score from rows of (vec_id, label, embedding)."""
    scaled = F.transform("embedding", lambda x: F.lit(float(scale)) * x.cast("double"))
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    label = F.col("label").cast("long")
    taking_part = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite
    valid = rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), scaled.alias("v"), is_anchor.alias("asks"))
    valid = stash(valid.where(taking_part).withColumn("dim", F.size("v")).dropDuplicates(["vec_id", "label", "v"]))
    none = F.array().cast("array<bigint>")
    shards, count = _dealt(valid.withColumn("caps", none), SHARD_ROWS)
    shards = stash(shards.select("part", "dim", *SHARD))
    anchors = valid.where("asks")

    near = _meet(anchors.withColumn("caps", none), shards, count, _visits(_positives, True, positives))
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    own = near.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("own"))
    # so many longs an anchor: ids, then scores; a score of -1 has no window
    caps = [F.coalesce(F.get("own", i)[field], F.lit(rest).cast("long")) for field, rest in (("vec_id", 0), ("score", -1)) for i in map(F.lit, range(positives))]
    capped = anchors.join(own, F.col("vec_id") == F.col("anchor_id")).withColumn("caps", F.array(*caps))
    capped = stash(capped.select("vec_id", "label", "v", "dim", "caps"))

    far = _meet(capped, shards, count, _visits(_negatives, False, negatives))
    order = Window.partitionBy("anchor_id", "positive_id", "positive_score").orderBy(F.desc("score"), "vec_id")
    far = far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    names = [F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")]
    return far.select("anchor_id", "positive_id", "rank", *names)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


OP13_SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same, list_dot_product(a.e, c.e)::BIGINT AS score
    FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
), p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 5
"""
