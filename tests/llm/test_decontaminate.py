import random
import re

import numpy as np
import pytest

from siltstone.llm import decontaminate
from siltstone.llm.decontaminate import FMIndex, contaminated, find_leaks, keep_clean, merged, n_hit
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, _n_words string"
ITEMS = "item_id long, text string, doc_id string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, window=13):
    phrases = [(str(i) if i is not None else "", tuple(w[k : k + window])) for i, t, *_ in items if (w := words(t)) for k in range(max(1, len(w) - window + 1))]
    out = []
    for doc, text, *_ in rows:
        w, hit, names = words(text), set(), set()
        for name, p in phrases:
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k : k + len(p)]) == p:
                    hit |= set(range(k, k + len(p)))
                    names.add(name)
        out.append((doc, len(w), len(hit), sorted(names), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def found(spark, rows, items, **options):
    df = spark.createDataFrame(rows, DOCS).drop("_n_words")
    marked = find_leaks(df, spark.createDataFrame(items, ITEMS), **options).withColumn("hit", n_hit())
    return [(r["doc_id"], r["_n_words"], r["hit"], list(r["_items"]), r["c"]) for r in marked.withColumn("c", contaminated(F.col("_n_words"), F.col("hit"))).collect()]


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "c", "é", "42"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 5, 13, 14, 20]))) + ".", "x") for i in range(1, 12) if i != 4] + [(50, None, ""), (51, "--", ""), (None, "b b b b b b", ""), (3, "b b b b b b", "")]
    rows = []
    for i in range(80):
        parts = [rng.choice(vocabulary + ["zz"]) for _ in range(rng.randint(0, 60))]
        if i % 3 == 0:
            parts += words(rng.choice(items)[1])[rng.randint(0, 2) :] + ["zz"]
        rows.append((i, ", ".join(p.upper() if rng.random() < 0.2 else p for p in parts), "clash"))
    return rows + [(900, None, ""), (901, "", ""), (902, "... !", ""), (None, rows[0][1], ""), (0, rows[0][1], "")], items


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_equals_brute_force(spark, seed, block_bytes, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 700)
    rows, items = corpus(seed)
    assert sorted(found(spark, rows, items, block_bytes=block_bytes), key=repr) == sorted(brute(rows, items), key=repr)


def test_long_text_and_hot_passage(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [(i, f"{'x ' * 50}{passage}", "") for i in range(300)] + [(1000, "p0 " * 100_000 + passage, "")]
    got = found(spark, rows, [(7, passage, "")])
    assert {(d, h, tuple(n)) for d, _, h, n, _ in got} == {(r[0], 20, ("7",)) for r in rows}


def test_index_against_scans():
    rng = np.random.default_rng(5)
    text = np.append(rng.integers(0, 4, 400), 0).astype(np.int32)
    index = FMIndex(text, 3)
    for size in (1, 2, 3, 5):
        for at in range(0, 390, 7):
            phrase = text[at : at + size]
            if (phrase == 0).any():
                continue
            low, high = index.search(phrase[::-1][None, :], np.array([size]))
            want = [k for k in range(len(text) - size + 1) if (text[k : k + size] == phrase).all()]
            assert sorted(index.locate(np.arange(low[0], high[0])).tolist()) == want


def test_spans_merge_and_clean_documents_stay(spark):
    assert merged(np.array([5, 0, 3]), np.array([9, 3, 6])) == [{"start": 0, "stop": 9}]
    df = spark.createDataFrame([(1, "alpha beta", "q"), (2, "gamma delta", "q"), (3, None, None), (None, "beta", None)], "doc_id long, text string, _text string").withColumnRenamed("_text", "source")
    kept = keep_clean(df, spark.createDataFrame([(1, "Alpha, BETA", "")], ITEMS))
    assert kept.columns == df.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "3", "None"]
    assert keep_clean(df, spark.createDataFrame([], ITEMS)).count() == 4
    assert keep_clean(df.limit(0), spark.createDataFrame([(1, "Alpha", "")], ITEMS)).count() == 0
