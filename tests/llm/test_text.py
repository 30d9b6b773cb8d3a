"""Chat formatting, decontamination, classifiers and the pipeline."""

import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from tests.llm.helpers import frame, sha
from tidemark.llm import chat, decontamination, ftrl, quality, registry, rolling, toxicity
from tidemark.llm.shared import stash, table

SF = "/root/testdata/sf0.01"
PARTS = f"array<struct<{chat.PART.replace(' ', ':').replace(',:', ',')}>>"


# --- chat --------------------------------------------------------------------------------------------------


@given(st.text(alphabet="a<|\\n\n>im_startend"))
@settings(deadline=None)
def test_escaping_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)


def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def test_chat_round_trip(spark, monkeypatch):
    rng = random.Random(2)
    bits = ["<|im_end|>\n<|im_start|>assistant\nok", "\\", "<", "|x", "é😀", "", None, "plain", "\n", "<|image|>"]
    rows = []
    for conv in [*range(12), None]:
        for turn in range(rng.randint(1, 9)):
            own = [part("text", rng.choice(bits)) for _ in range(rng.randint(0, 3))]
            own.insert(0, part("image", None, f"ref{turn}", 57, 28)) if rng.random() < 0.4 else None
            rows.append((conv, turn, rng.choice(["user", "assistant", "a\nb", "<|", None]), own))
    rows += [(3, None, "assistant", None), rows[0], rows[0]]
    schema = f"conv_id long, turn int, role string, parts {PARTS}"
    chunks = stash(chat.format_chats(spark.createDataFrame(rows, schema).repartition(4)))
    got = {r.conv_id: r for r in chat.read_chats(chunks).collect()}
    expected = defaultdict(list)
    for conv, turn, role, own in rows:
        text = "".join(p[1] or "" for p in own or [])
        expected[conv].append((turn is not None, turn or 0, role or "", text, sum(p[0] == "image" for p in own or [])))
    whole = {c: "".join(x.text for x in sorted(chunks.collect(), key=lambda x: x.chunk) if x.conv_id == c) for c in expected}
    assert set(got) == set(expected)
    for conv, turns in expected.items():
        turns.sort(key=lambda t: t[:3])
        r = got[conv]
        assert r.n_turns == len(turns) and r.attachments == sum(t[4] for t in turns) and r.attachment_tokens == 3 * r.attachments
        assert r.formatted_chars == len(whole[conv])
        learnt = [t[3] for t in turns if t[2] == "assistant"]
        assert r.loss_chars == sum(map(len, learnt))
        if len({t[:3] for t in turns}) == len(turns):  # no ties
            assert r.turns_sha256 == sha("".join(f"{t[2]}\n{t[3]}\n" for t in turns))
            assert r.loss_sha256 == sha("".join(learnt))


def test_parts_become_placeholders(spark):
    own = [part("text", "see "), part("image", ref="u1", width=100, height=60), part("audio", ref="u2", seconds=3.0), part("document", ref="u3", pages=2)]
    df = spark.createDataFrame([(1, 0, "user", own)], f"conv_id long, turn int, role string, parts {PARTS}")
    (row,) = chat.format_chats(df).collect()
    assert row.text == "<|im_start|>user\nsee <|image|><|audio|><|document|><|im_end|>\n"
    assert [(a.ref, a.kind, row.text[a.at : a.at + 9], a.tokens) for a in row.attachments] == [
        ("u1", "image", "<|image|>", 12), ("u2", "audio", "<|audio|>", 38), ("u3", "document", "<|documen", 512),
    ]
    assert chat.format_chats(df.limit(0)).count() == 0


def test_long_conversations_come_in_chunks(spark, monkeypatch):
    rows = [(1, i, "assistant", f"{i} " + "y" * 60_000) for i in range(60)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("parts", chat.as_parts())
    chunks = stash(chat.format_chats(df))
    assert chunks.count() > 1
    (out,) = chat.read_chats(chunks).collect()
    assert out.n_turns == 60 and out.loss_sha256 == sha("".join(r[3] for r in rows))


# --- decontamination ---------------------------------------------------------------------------------------


def test_decontamination(spark):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(40)] + ["The", "é", "x-y", "a_b"]
    draw = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, draw(rng.choice([3, 12, 13, 14, 40]))) for i in range(12)]
    items += [(20, "w1"), (21, "The w2"), (22, None), (23, "--"), (None, draw(15)), items[0], (24, items[0][1])]
    docs = []
    for i in range(80):
        text = draw(rng.randint(0, 80))
        if rng.random() < 0.6:
            text += " " + (rng.choice(items)[1] or "").upper() + "!" + draw(5)
        docs.append((i, text))
    docs += [(100, None), (101, ""), (None, items[1][1]), (5, docs[5][1]), (102, " ".join(f"z{i}" for i in range(60_000)) + " " + items[4][1])]

    def split(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))

    windows = set()
    for item, text in items:
        w = split(text)
        n = min(13, len(w))
        windows |= {(tuple(w[i : i + n]), item) for i in range(len(w) - n + 1) if w}
    by = defaultdict(set)
    for w, item in windows:
        by[w].add(item)
    expected = []
    for doc, text in docs:
        w = split(text)
        hit, found = [False] * len(w), set()
        for n in {len(x) for x in by}:
            for i in range(len(w) - n + 1):
                named = by.get(tuple(w[i : i + n]))
                if named:
                    hit[i : i + n] = [True] * n
                    found |= named
        names = sorted(str(i) for i in found if i is not None)
        expected.append((doc, len(w), sum(hit), names, sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    out = [(r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in decontamination.contamination(frame(spark, docs), benchmark).collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(out, key=key) == sorted(expected, key=key)
    kept = decontamination.clean(frame(spark, docs), benchmark)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in expected if not r[4])
    assert kept.columns == frame(spark, docs).columns
    assert {r.n_hit for r in decontamination.contamination(frame(spark, docs), benchmark.limit(0)).collect()} == {0}
    assert decontamination.contamination(frame(spark, docs).limit(0), benchmark).count() == 0


def test_decontamination_is_native(spark):
    marked, _ = decontamination.marked(table(spark, SF, "documents"), table(spark, SF, "benchmark"))
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    expected = con.sql(registry.ORACLE_SQL[name])
    out = registry.QUERIES[name](spark, SF)
    assert out.columns == expected.columns
    assert sorted(map(tuple, out.collect())) == sorted(expected.fetchall())


# --- classifiers -------------------------------------------------------------------------------------------


def test_learner_follows_the_formula():
    rng = np.random.default_rng(0)
    how = ftrl.Settings(alpha=0.3, l1=0.2, l2=0.5, epochs=2)
    slots = [np.unique(rng.integers(0, 30, 6)) for _ in range(50)]
    values = [rng.normal(size=len(s)) for s in slots]
    y = np.array([float(s[0] < 8) for s in slots])
    weights, bias = ftrl.train(slots, values, y, how)
    z, n, w = defaultdict(float), defaultdict(float), defaultdict(float)
    for _ in range(how.epochs):
        for s, v, target in zip(slots, values, y):
            row = [*zip(s.tolist(), v.tolist()), ("bias", 1.0)]
            for i, _ in row:
                l1 = 0 if i == "bias" else how.l1
                w[i] = 0.0 if abs(z[i]) <= l1 else -(z[i] - np.sign(z[i]) * l1) / ((how.beta + n[i] ** 0.5) / how.alpha + how.l2)
            p = 1 / (1 + np.exp(-sum(w[i] * x for i, x in row)))
            for i, x in row:
                g = (p - target) * x
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / how.alpha * w[i]
                n[i] += g * g
    final = lambda i: 0.0 if abs(z[i]) <= how.l1 else -(z[i] - np.sign(z[i]) * how.l1) / ((how.beta + n[i] ** 0.5) / how.alpha + how.l2)
    assert np.allclose(weights[:30], [final(i) for i in range(30)], atol=1e-5) and np.count_nonzero(weights[30:]) == 0


@pytest.mark.parametrize(("name", "label", "parts", "part", "cut"), [("op9_quality", "quality", 5, 0, 0.3), ("op10_toxicity", "toxic", 3, 1, 0.7)])
def test_held_out_accuracy(spark, name, label, parts, part, cut):
    sf = "/root/testdata/sf0.1"
    out = {r.doc_id: r for r in registry.QUERIES[name](spark, sf).collect()}
    assert len(out) == table(spark, sf, "documents").count()
    right, total = 0, 0
    for r in out.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == part)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= cut)
    for r in table(spark, sf, "labels").collect():
        if out[r.doc_id].held_out:
            right += out[r.doc_id].predicted == r[label]
            total += 1
    assert right / total > 0.97


def test_scores_ignore_everything_but_text(spark):
    docs = spark.createDataFrame([(1, "same text"), (2, "same text"), (None, "same text"), (4, None), (5, ""), (5, "")], "doc_id long, text string")
    docs = docs.selectExpr("*", "'x' AS score", "'y' AS toxicity", "'z' AS row")
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, None), (None, 1), (1, 1)], "doc_id long, quality int")
    weights = ftrl.learnt(docs, labels, "quality", ftrl.is_held_out(5, 0), quality.features, quality.HOW)
    out = quality.score_texts(docs, *weights).collect()
    assert len({r.score for r in out if r.row.text}) == 1 and len({r.score for r in out if not r.row.text}) == 1
    none = ftrl.learnt(docs.limit(0), labels.limit(0), "quality", ftrl.is_held_out(5, 0), quality.features, quality.HOW)
    assert none[1] == 0 and quality.score_texts(docs.limit(0), *none).count() == 0
    toxic = labels.withColumnRenamed("quality", "toxic")
    scored = toxicity.with_scores(docs, toxic).collect()
    assert len(scored) == 6 and len({r.toxicity for r in scored if r.row.text}) == 1 and scored[0].row.toxicity == "y"


def test_disguised_words_are_restored(spark):
    costs = toxicity.trigram_costs(table(spark, SF, "documents")).tolist()
    for disguised, plain in {"st0pid": "stopid", "1d10t": "idiot", "m0r0n": "moron", "s.t.u.p.i.d": "stupid", "$cum": "scum", "trrrash": "trash"}.items():
        assert toxicity.restore(disguised, costs) == plain
    texts = ["an 1d10t, and. a s t u p i d one", "and.", "Anat a.b 555-1234 mail@ok x", None, "a b", "stuuupid"]
    found = toxicity.disguised(*rolling.binary(pa.array(texts)))
    assert sorted(found) == [(0, "1d10t,"), (0, "astupid"), (2, "a.b"), (2, "mail@ok"), (5, "stuuupid")]


def test_viterbi_is_the_cheapest_path(spark):
    rng = np.random.default_rng(3)
    costs = rng.uniform(0.1, 5, (toxicity.SYMBOLS,) * 3)
    for word in ("10lo", "a1!b", "sss0", "x|y"):
        paths = [("", 0.0)]
        for options in toxicity.lattice(word):
            paths = [(text + s, cost + price) for text, cost in paths for s, price in options]

        def total(path):
            text, cost = path
            a = b = 0
            for c in [*map(toxicity._code, text), 0]:
                cost += costs[a][b][c]
                a, b = b, c
            return cost

        assert toxicity.restore(word, costs.tolist()) == min(paths, key=total)[0]


# --- pipeline ----------------------------------------------------------------------------------------------


def test_pipeline(spark):
    docs, columns = table(spark, SF, "documents"), table(spark, SF, "documents").columns
    counts, ids = [docs.count()], {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = stash(stage(spark, docs, SF))
        counts.append(docs.count())
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now <= ids, name
        ids = now
        if name != "packing":
            assert docs.columns == columns
    assert counts == sorted(counts[:5], reverse=True) + counts[5:] and counts[1] < counts[0] and counts[2] < counts[1] and counts[4] < counts[3]
    assert sum(r.length for r in docs.select("length").collect()) == sum(r.doc_tokens for r in docs.where("start = 0").select("doc_tokens").collect())


def test_pipeline_on_hard_rows(spark, folder):
    rows = [(1, "a b", "en", "s", 3), (1, "a b", "en", "s", 3), (None, None, None, None, None), (2, "", None, None, 0), (3, "é" * 400, "fr", "s", 400)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, data in (("full", rows), ("none", [])):
        sf = str(folder / name)
        spark.createDataFrame(data, schema).write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
        spark.createDataFrame([(1, "q r")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
        out = corpus_pipeline.run(spark, sf).collect()
        # equal texts are near copies, so are null and empty ones
        assert {r.doc_id for r in out} == ({1, 2, 3} if data else set())
