import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
from tempolane.llm import phrases
from tempolane.llm.quotient import Packing, QuotientFilter, blocks, merged
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("k,bits", [(1, 1), (2, 1), (2, 14), (3, 21), (5, 14), (5, 30), (2, 32), (3, 33)])
def test_permutation_is_undone_and_one_to_one(k, bits):
    draw = np.random.default_rng(k * bits)
    ids = draw.integers(0, 1 << bits, (3000, k))
    p = Packing(k, bits)
    flat = ids.reshape(-1)
    packed = p.pack(flat, np.arange(0, len(flat), k))
    mixed = p.permute(packed)
    assert all((x >> np.uint64(w)).max() == 0 for x, w in zip(mixed, p.widths) if w < 64)
    assert (p.unpack(p.restore(mixed)) == ids).all()
    assert len(set(zip(*[x.tolist() for x in mixed]))) == len(set(map(tuple, ids.tolist())))


@pytest.mark.parametrize("k,bits,n,prefix", [(2, 3, 40, 2), (5, 14, 5000, 3), (5, 14, 0, 0), (3, 20, 1, 0), (2, 32, 900, 5)])
def test_filters_hold_all_counts(k, bits, n, prefix):
    draw = np.random.default_rng(3)
    p = Packing(k, bits)
    limbs = [draw.integers(0, 1 << w, n, dtype=np.uint64) if w < 64 else draw.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) for w in p.widths]
    limbs, counts = merged(limbs, draw.choice([1, 2, 254, 255, 256, 10**12], n))
    seen = 0
    for _, f in blocks(p, prefix, limbs, counts):
        again = QuotientFilter.from_bytes(f.to_bytes(), p.widths, prefix)
        own = slice(seen, seen + len(f))
        assert all((a == b[own]).all() for a, b in zip(again.limbs, limbs)) and (again.counts == counts[own]).all()
        assert (again.look_up([x[own] for x in limbs]) == counts[own]).all()
        other = [x ^ np.uint64(1) for x in limbs]
        want = dict(zip(zip(*[x[own].tolist() for x in limbs]), counts[own].tolist()))
        assert again.look_up(other).tolist() == [want.get(key, 0) for key in zip(*[x.tolist() for x in other])]
        seen += len(f)
    assert seen == len(counts)


def brute(rows, least, top):
    counts, sizes = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = [w for w in re.split("[ \t]+", piece) if w]
            sizes[lang] += len(words)
            for k in range(1, 6):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = set()
    for lang, c in counts.items():
        frequent = {p: f for p, f in c.items() if f >= least and len(p) > 1}
        gone = set()
        for p, f in frequent.items():
            for k in range(2, len(p)):
                gone |= {p[i : i + k] for i in range(len(p) - k + 1) if f >= c[p[i : i + k]]}
        found = []
        for p, a in frequent.items():
            score, k = min((1000 * a * sizes[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            if p not in gone:
                found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, p.decode(), -a, left, right, sizes[lang], -s))
    return out


@pytest.fixture(scope="module")
def odd():
    draw = random.Random(6)
    words = ["of", "the", "New", "york", "été", "a b", "日本", "\U0001f600", "x"]
    rows = []
    for _ in range(300):
        text = "".join(draw.choice(words) + draw.choice([" ", " ", "  ", "\t", ". ", ",", "\n", " "]) for _ in range(draw.randint(0, 40)))
        rows.append((draw.choice(["en", "en", "fr", None, "und", ""]), text))
    rows += [("en", None), (None, ""), ("en", "new york " * 3000), ("fr", rows[0][1]), ("fr", rows[0][1]), ("z", "one two"), ("z", " ., ")]
    return rows


@pytest.mark.parametrize("limits", [{}, {"sent_words": 0}, {"sent_grams": 0}])
def test_collocations_equal_brute_force(spark, odd, limits):
    df = spark.createDataFrame(odd, "lang string, text string").selectExpr("*", "1 AS ids", "2 AS f")
    got = {tuple(r) for r in phrases.collocations(df, least=6, top=50, **limits).collect()}
    assert got == brute(odd, 6, 50) and len(got) > 60


def test_small_stretches_and_filters_give_the_same(spark, odd, monkeypatch):
    monkeypatch.setattr(phrases, "HELD_GRAMS", 2)
    ids = np.array([1, 2, 3, 0] * 50 + [1, 2] * 70)
    whole = {}
    for least in (1, 60):
        batch = phrases._ids_batch(ids)
        parts = [r for b in phrases._count_grams(2, 2, 1, None, iter([batch])) for r in b.to_pylist()]
        rows = sorted(parts, key=lambda r: r["block"])
        assert len(rows) > 4
        import pyarrow as pa

        merged_rows = pa.RecordBatch.from_pylist(rows, schema=pa.schema([("block", pa.int32()), ("filter", pa.binary())]))
        found = [r for b in phrases._merge_blocks(2, 2, 1, least, iter([merged_rows])) for r in b.to_pylist()]
        whole[least] = {tuple(r["ids"]): r["f"] for r in found}
    assert whole[1] == {(1, 2): 120, (2, 3): 50, (2, 1): 69} and whole[60] == {(1, 2): 120, (2, 1): 69}


def test_pieces_are_short_rows_of_bytes(monkeypatch):
    """A task's texts are many rows, cut at breaks only, with the same n-grams."""
    draw = np.random.default_rng(4)
    ids = draw.integers(0, 9, 60_000)
    ids[20_000:40_000] = 7  # no break in it
    ids[100] = 1 << 40
    for flat in (ids, ids[200:]):
        batch = phrases._ids_batch(flat)
        rows = [np.frombuffer(r["ids"], dtype=f"<i{r['width']}") for r in batch.to_pylist()]
        assert len(rows) > 5 and all(r[-1] == 0 for r in rows[:-1])
        assert max(len(r) for r in rows) < 20_000 + 2 * phrases.ROW_IDS and sorted(map(len, rows))[-2] < phrases.ROW_IDS + 200
        keep = np.append(True, (flat[1:] != 0) | (flat[:-1] != 0))
        assert (np.concatenate(rows) == flat[keep]).all()
        monkeypatch.setattr(phrases, "GATHERED", 9000)
        got = [x for g in phrases._gathered(batch) for x in g[phrases._grams(g, 2, None)].tolist()]
        assert got == flat[phrases._grams(flat, 2, None)].tolist()


def test_parts_go_when_they_are_merged(monkeypatch):
    """Neither parts nor unsorted numbers stand in memory beside the merged whole."""
    held = [([np.arange(9, dtype=np.uint64), np.arange(9, dtype=np.uint64)], np.ones(9, dtype=np.int64)) for _ in range(3)]
    left = []

    def seen(limbs, counts):
        left.append((len(held), limbs))
        return merged(limbs, counts)

    monkeypatch.setattr(phrases, "merged", seen)
    limbs, counts = phrases._whole(held)
    assert left[0][0] == 0 and counts.tolist() == [3] * 9 and all(x.tolist() == list(range(9)) for x in limbs)
    assert all(len(x) == 27 and (np.diff(x.astype(int)) >= 0).all() for x in left[0][1])


def test_no_frequent_phrases(spark):
    df = spark.createDataFrame([("en", "a b c"), ("en", None)], "lang string, text string")
    assert phrases.collocations(df).count() == 0 == phrases.collocations(df.limit(0)).count()


def test_query_matches_sql(spark):
    rows, diff = compare(entry.queries()["op12_collocations"](spark, SF), connect(SF), entry.oracle_sql()["op12_collocations"])
    assert rows and not diff, diff
