"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing columns; digests for brute force."""

from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def texts(seed: int, n: int = 120) -> list[tuple[int | None, str | None]]:
    """Documents that share passages, repeat themselves, differ by a word, or are empty, null or very long."""
    rng = random.Random(seed)
    vocabulary = ["the", "of", "Stein", "été", "x1", "niña", "b.", "and,", "low", "high"] + [f"w{i}" for i in range(60)]
    passages = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(36, 90))) for _ in range(5)]
    out: list[tuple[int | None, str | None]] = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.08:
            text = rng.choice([None, "", " \n\t", "a"])
        elif kind < 0.16:
            text = rng.choice(["a", "ab ", "the of "]) * rng.randint(1, 120)
        elif kind < 0.3 and out:
            words = (out[rng.randrange(len(out))][1] or "q").split(" ")
            words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        else:
            parts = [rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 60)))]
            text = rng.choice([" ", "\n", "  "]).join(parts * rng.choice([1, 1, 2]))
        out.append((i, text))
    out.append((n, " ".join(f"long{i % 700}" for i in range(30_000))))
    out.append((n + 1, "word " + " ".join(f"long{i % 700}" for i in range(9_000))))
    return out


def frame(spark, rows, parts: int = 5):
    """Documents with columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    clashing = ["doc", "h", "row", "spots", "out", "fp", "w", "key", "score", "source"]
    return df.select("*", *(F.lit(c).alias(c) for c in clashing))


def words(text: str | None) -> list[str]:
    return WORDS.findall(text or "")
