"""Near duplicates by SimHash fingerprints and pigeonhole blocks.

A fingerprint has ``bits`` bits; a bit is set if it is set in over half of the hashes of a text's word
shingles. Two fingerprints within ``distance`` bits agree on ``agree`` of their ``blocks`` blocks whenever
``distance <= blocks - agree``; all choices of so many blocks become keys, fingerprints meet on a key, and
their Hamming distance is verified there. Each key's verified links leave as stars, not as pairs.

Keys under which very many different fingerprints meet are not compared pair by pair. Up to a distance of two
they go another exact way: two fingerprints lie within two bits exactly if some word lies within one bit of
both, so each is dealt to the words around it. At larger distances such a key is dealt into parts, and any two parts
are compared in a task of bounded size, so all pairs are still compared.

Distances beyond ``blocks - agree`` are allowed; then links are found with a probability.

Null and wordless texts have the fingerprint zero. A null doc_id takes part but is never the smallest of a
component that holds another id. Rows that repeat an id each keep their own fingerprint.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import rolling
from tidemark.llm.components import components
from tidemark.llm.shared import stash, table

SHINGLE, BITS, DISTANCE = 3, 64, 2
BLOCKS, AGREE = 5, 3
HOT = 2048
SEED = 42
_CHUNK = 1 << 15


def _bits_of(text: bytes, shingle: int, bits: int, distinct: bool) -> np.ndarray:
    """The fingerprint of one text as bits / 8 bytes, highest bit first; distinct: each shingle counts once."""
    words = text.lower().split()  # bytes: A-Z only, and white space is 0x20 and 0x09-0x0D
    if len(words) >= shingle:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    else:
        grams = iter([b" ".join(words)] if words else [])
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64)
    if distinct:
        hashes = np.unique(hashes)
    total = len(hashes)
    counts = np.zeros(bits, np.int64)
    for at in range(0, total, _CHUNK):
        h = hashes[at : at + _CHUNK]
        wide = [h] + [rolling.mix(h + np.uint64(i * 0x9E3779B97F4A7C15 % (1 << 64))) for i in range(1, bits // 64)]
        raw = np.stack(wide, axis=1).astype("<u8").view(np.uint8)
        counts += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return np.packbits((2 * counts > total)[::-1])


def fingerprints(shingle: int, bits: int, distinct: bool) -> Callable:
    @F.arrow_udf("binary")
    def fingerprint(texts: pa.Array) -> pa.Array:
        rows = texts.cast(pa.binary())
        return pa.array([_bits_of(t.as_py() or b"", shingle, bits, distinct).tobytes() for t in rows], pa.binary())

    return fingerprint


def _matrix(column: pa.Array, bits: int) -> np.ndarray:
    data, offsets = rolling.binary(column)
    return np.frombuffer(data[offsets[0] : offsets[-1]].tobytes(), "<u8").reshape(-1, bits // 64)


def _block_values(words: np.ndarray, bits: int, blocks: int) -> list[np.ndarray]:
    """The value of every block of the fingerprints."""
    flat = np.unpackbits(words.astype("<u8").view(np.uint8), axis=1, bitorder="little")
    out, at = [], 0
    for i in range(blocks):
        size = bits // blocks + (i < bits % blocks)
        weights = np.uint64(1) << np.arange(min(size, 64), dtype=np.uint64)
        out.append(flat[:, at : at + len(weights)].astype(np.uint64) @ weights)
        at += size
    return out


def _binary(words: np.ndarray) -> pa.Array:
    width = words.shape[1] * 8
    raw = np.ascontiguousarray(words.astype("<u8")).view(np.uint8)
    offsets = pa.py_buffer(np.arange(0, len(words) * width + 1, width, dtype=np.int32))
    return pa.Array.from_buffers(pa.binary(), len(words), [None, offsets, pa.py_buffer(raw)])


KEYED = "key long, fp binary"


def _keys(bits: int, blocks: int, agree: int) -> Callable:
    """mapInArrow function: fingerprints to (key, fp)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("fp"))
            words = _matrix(column, bits)
            values = _block_values(words, bits, blocks)
            before = np.zeros(len(words), np.uint64)
            for number, chosen in enumerate(combinations(range(blocks), agree)):
                key = rolling.mix(before + np.uint64(number + 1))
                for i in chosen:
                    key = rolling.mix(key ^ values[i])
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), column], ["key", "fp"])

    return run


LINKS = "a binary, b binary"


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest reachable item of each of n items under links a-b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _verified(bits: int, distance: int) -> Callable:
    """mapInArrow function: rows sorted by key to links; within a key each fingerprint meets all others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, words = np.zeros(0, np.int64), np.zeros((0, bits // 64), np.uint64)

        def links(key: np.ndarray, words: np.ndarray) -> pa.RecordBatch:
            ends = np.searchsorted(key, key, side="right")
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            at, step = np.arange(len(key)), 1
            while True:
                at = at[at + step < ends[at]]
                if not len(at):
                    break
                close = np.bitwise_count(words[at] ^ words[at + step]).sum(axis=1) <= distance
                a.append(at[close])
                b.append(at[close] + step)
                step += 1
            root = _roots(np.concatenate(a), np.concatenate(b), len(key))
            tied = np.flatnonzero(root != np.arange(len(key)))
            return pa.RecordBatch.from_arrays([_binary(words[tied]), _binary(words[root[tied]])], ["a", "b"])

        for batch in batches:
            key = np.concatenate((key, rolling.column(batch, "key")))
            words = np.concatenate((words, _matrix(batch.column(batch.schema.get_field_index("fp")), bits)))
            if not len(key):
                continue
            whole = int(np.searchsorted(key, key[-1]))  # the last key may go on in the next batch
            if whole:
                yield links(key[:whole], words[:whole])
                key, words = key[whole:], words[whole:]
        if len(key):
            yield links(key, words)

    return run


def _around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each 64-bit fingerprint with itself and all words one bit away, as (key, fp)."""
    flips = np.concatenate((np.zeros(1, np.uint64), np.uint64(1) << np.arange(64, dtype=np.uint64)))
    for batch in batches:
        column = batch.column(batch.schema.get_field_index("fp"))
        words = _matrix(column, 64)[:, 0]
        for flip in flips:
            yield pa.RecordBatch.from_arrays([pa.array((words ^ flip).view(np.int64)), column], ["key", "fp"])


def _met(keys: DataFrame, bits: int, distance: int) -> DataFrame:
    return keys.repartition("key").sortWithinPartitions("key").mapInArrow(_verified(bits, distance), LINKS)


def _in_parts(crowded: DataFrame) -> DataFrame:
    """key, fp: each key is dealt into parts, and any two parts of it meet under a key of their own."""
    parts = F.ceil(F.col("count") * 2 / HOT).cast("int")
    dealt = crowded.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    each = dealt.select("key", "fp", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    return each.select(F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other")).alias("key"), "fp")


def links(prints: DataFrame, bits: int, distance: int, blocks: int, agree: int) -> DataFrame:
    """a, b: links that connect whatever fingerprints (column fp, each once) lie within the distance, by blocks."""
    keys = stash(prints.select("fp").mapInArrow(_keys(bits, blocks, agree), KEYED))
    hot = stash(keys.groupBy("key").count().where(F.col("count") > HOT))
    found = _met(keys.join(hot, "key", "left_anti"), bits, distance)
    crowded = keys.join(hot, "key")  # with the number of fingerprints under the key
    if distance <= 2 and bits == 64:
        near = crowded.select("fp").distinct().mapInArrow(_around, KEYED)
        # everything around one word lies within two bits of everything else there
        least = near.groupBy("key").agg(F.min("fp").alias("b"))
        more = near.join(least, "key").select(F.col("fp").alias("a"), "b").where(F.col("a") != F.col("b"))
    else:
        more = _met(_in_parts(crowded), bits, distance)
    return found.unionAll(more)


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _digest() -> Column:
    """128 bits that stand for the text where rows share an id."""
    return F.unhex(F.md5(_text()))


def simhash_components(
    docs: DataFrame,
    shingle: int = SHINGLE,
    bits: int = BITS,
    distance: int = DISTANCE,
    blocks: int = BLOCKS,
    agree: int = AGREE,
    distinct: bool = False,
) -> DataFrame:
    """doc_id, digest (of the text), fp, root (the fingerprint that stands for the group), component_id of every row of docs."""
    rows = stash(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            _digest().alias("digest"),
            fingerprints(shingle, bits, distinct)(_text()).alias("fp"),
        )
    )
    prints = stash(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    ties = components(links(prints, bits, distance, blocks, agree))
    tied = prints.join(ties, prints["fp"] == ties["a"], "left").select("fp", "least", F.coalesce("b", "fp").alias("root"))
    tied = stash(tied)
    smallest = tied.groupBy("root").agg(F.min("least").alias("component_id"))
    member = stash(tied.join(smallest, "root").select("fp", "root", "component_id"))
    return rows.join(member, "fp").select("doc_id", "digest", "fp", "root", "component_id")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """The rows of docs that stand for their group: the smallest id, of equal ids the smallest digest; equal rows once.

    groups: simhash_components of docs, or of other settings. A group is known by its root, as two groups may have
    the same smallest id. Null ids come last; rows with null ids only are a group like any other.
    """
    groups = stash((simhash_components(docs) if groups is None else groups).select("doc_id", "digest", "root"))
    first = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "digest")
    stands = groups.groupBy("root").agg(F.min(first).alias("first")).select(F.col("first.doc_id").alias("d"), F.col("first.digest").alias("t"))
    counts = groups.groupBy("doc_id", "digest").agg(F.count("*").alias("rows"))
    kept = stash(stands.join(counts, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("digest"))).select("d", "t", "rows"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc"), _digest().alias("digest"))
    met = rows.join(kept, F.col("doc").eqNullSafe(F.col("d")) & (F.col("digest") == F.col("t")))
    single = met.where("rows = 1").select("row.*")
    return single.unionAll(met.where("rows > 1").dropDuplicates(["doc", "digest"]).select("row.*"))
