import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tempolane.llm import passages

SF = "/root/testdata/sf0.1"


def plain(text):
    """Statistics of the passages of a text, word by word."""
    words = text.encode().split()
    n = max(len(words) // 64, 1)
    out, seen, cuts = [], set(), [(k * 64, len(words) if k == n - 1 else k * 64 + 64) for k in range(n)]
    for a, b in cuts:
        own = words[a:b]
        again = 0
        for i in range(a, b):
            if i + 3 <= len(words):
                three = tuple(w.lower() for w in words[i : i + 3])
                again += three in seen
                seen.add(three)
        count, data = max(len(own), 1), b"".join(own)
        size = max(len(data), 1)
        of = lambda chars: sum(c in chars for c in data) / size
        out.append([
            float(not own), np.log1p(len(own)) / 5, len(data) / count / 10, of(range(65, 91)), of(b"0123456789"), of(b".,;:'\"()-"), of(b"!?"),
            sum(w[:1].isupper() for w in own) / count, len({w.lower() for w in own}) / count, again / count,
            sum(words[i].lower() == words[i - 1].lower() for i in range(max(a, 1), b)) / count,
        ])
    return np.array(out)


def texts():
    draw = random.Random(3)
    say = ["The", "the", "of", "ÉTÉ", "a!", "b$$", "12", "word-like,", "x" * 300, "日本"]
    found = ["", " \n ", "one", "A A a", "  lead"]
    return found + [draw.choice([" ", "\n"]).join(draw.choice(say) for _ in range(n)) for n in (3, 63, 64, 65, 127, 128, 700) for _ in range(3)]


def test_passages_equal_a_plain_loop():
    bodies = texts()
    x, bags = passages.passages([t.encode() for t in bodies])
    want = [plain(t) for t in bodies]
    assert bags.tolist() == [len(w) for w in want]
    assert np.allclose(x[:, [0, 1, 2, 3, 4, 5, 6, 9, 11, 12, 13]], np.concatenate(want), atol=1e-6)
    # A text's passages don't depend on its neighbours.
    for i in (0, 4, 9, 20):
        alone, _ = passages.passages([bodies[i].encode()])
        at = int(bags[:i].sum())
        assert np.array_equal(alone, x[at : at + len(alone)])
    assert passages.passages([])[0].shape == (0, passages.WIDTH)


def test_gradient_and_attention_equal_slow_forms():
    draw = np.random.default_rng(1)
    p, bags = passages.initial(), np.array([1, 3, 2])
    x = draw.normal(size=(6, passages.WIDTH)) * 0.3
    y = np.array([1.0, 0.0, 1.0])
    loss = lambda q: float(np.sum(np.logaddexp(0, z := passages.forward(q, x, bags)[0]) - y * z))
    logit, kept = passages.forward(p, x, bags)
    found = passages.backward(p, x, bags, kept, 1 / (1 + np.exp(-logit)) - y)
    for name, g in found.items():
        for at in draw.integers(0, g.size, 6):
            q = {k: v.copy() for k, v in p.items()}
            q[name].flat[at] += 1e-5
            up = loss(q)
            q[name].flat[at] -= 2e-5
            assert (up - loss(q)) / 2e-5 == pytest.approx(g.flat[at], abs=1e-5), name
    e = np.tanh(x[1:4] @ p["W"] + p["b"])
    gate = np.array([np.tanh(v @ p["V"]) * (1 / (1 + np.exp(-(v @ p["U"])))) @ p["w"] for v in e])
    weight = np.exp(gate) / np.exp(gate).sum()
    assert logit[1] == pytest.approx((weight[:, None] * e).sum(0) @ p["c"] + p["d"][0])


def test_held_out_documents_are_told_apart(spark):
    rows = entry.queries()["op11_quality_attention"](spark, SF)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"]
    assert rows.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    found = rows.collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in found)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in found)
    aside = [(labels[r["doc_id"]], r["predicted"]) for r in found if r["held_out"] and r["doc_id"] in labels]
    kept = [p for y, p in aside if y == 1]
    dropped = [p for y, p in aside if y == 0]
    print("held out:", len(kept), np.mean(kept), len(dropped), np.mean(dropped))
    assert np.mean(kept) > 0.95 and np.mean(dropped) < 0.1


def test_labels_of_held_out_documents_are_not_read(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(800).select("doc_id", "text").cache()
    labels = spark.read.parquet(f"{SF}/labels.parquet").join(docs.select("doc_id"), "doc_id")
    turned = labels.withColumn("quality", F.when(passages.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = passages.learn(docs, labels, 200), passages.learn(docs, turned, 200)
    assert all(np.allclose(one[k], two[k]) for k in one)


def test_odd_documents(spark, docs):
    named = docs.withColumnRenamed("size", "score").withColumn("a.b", F.lit(1))
    none = passages.learn(docs, spark.createDataFrame([(1, 1), (2, 1), (None, 0), (6, None)], "doc_id long, quality int"))
    got = passages.score(named, none)
    assert got.columns == ["doc_id", "text", "source", "a.b", "held_out", "score", "predicted"]
    assert got.count() == docs.count() and {r["score"] for r in got.collect()} == {0.5}
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 0), (4, 0), (6, 1), (7, 1), (8, 1), (9, 0), (10, 1)], "doc_id long, quality int")
    rows = passages.score(docs, passages.learn(docs, labels)).collect()
    assert all(0 <= r["score"] <= 1 for r in rows) and len({r["score"] for r in rows if not (r["text"] or "").strip()}) == 1
    assert passages.score(docs.limit(0), none).count() == 0 and passages.learn(docs.limit(0), labels)["shift"] == 0
