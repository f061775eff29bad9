import random
import zlib

import numpy as np
import pytest

from siltstone.llm import toxicity
from siltstone.llm.toxicity import Kernel, Model, fit, keep_civil, score, words_of

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _text string"
LABELS = "doc_id long, quality int, toxic int"
CLEAN = "alpha bravo carol delta ember fable grove hotel india joker karma lemon mango noble ocean piano quilt river sugar tango".split()
INSULTS = ["wretchling", "mudbrain", "gutterfop"]


def corpus(n=700, seed=3):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(CLEAN, k=rng.randint(5, 60))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        docs.append((i, " ".join(words) + ".", "en", "s", 1, "clash"))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def slow_kernel(a: bytes, b: bytes) -> float:
    def features(w):
        out = {}
        for i in range(len(w)):
            for x, y in toxicity.PATTERNS:
                if i + y < len(w):
                    key = (w[i], w[i + x], w[i + y])
                    out[key] = out.get(key, 0) + toxicity.weight(y)
        return out

    f, g = features(a), features(b)
    dot = lambda p, q: sum(v * q.get(k, 0) for k, v in p.items())
    return dot(f, g) / max(1e-12, (dot(f, f) * dot(g, g)) ** 0.5)


def test_kernel_equals_its_definition():
    rng = random.Random(1)
    words = ["".join(rng.choices("abcd", k=rng.randint(3, 12))).encode() for _ in range(120)]
    marks = words[:12] + [b"idiot"]
    data = np.frombuffer(b" ".join(words), np.uint8)
    sizes = np.array([len(w) for w in words])
    where, values = Kernel(marks).values(data, np.cumsum(sizes + 1) - sizes - 1, sizes)
    got = dict(zip(where.tolist(), values, strict=True))
    for i, w in enumerate(words):
        want = np.array([slow_kernel(w, m) for m in marks])
        want = np.where(want >= toxicity.LEAST_KERNEL, want**toxicity.POWER, 0)
        assert np.allclose(got.get(i, np.zeros(len(marks))), want, atol=1e-4), w


def test_spaced_out_letters_make_a_word():
    found = words_of([b"a b", b"so i d i o t ok", b"x"])
    made = [found.data[s : s + n].tobytes() for s, n in zip(found.starts, found.sizes, strict=True)]
    assert made == [b"a", b"b", b"so", b"i", b"d", b"i", b"o", b"t", b"ok", b"x", b"idiot"]


def test_held_out_accuracy_and_gapped_insults():
    docs, labels = corpus()
    toxic, other = ([t.encode() for (i, t, *_), (_, _, y) in zip(docs, labels, strict=True) if y == k and zlib.crc32(str(i).encode()) % 5] for k in (1, 0))
    model = Model(toxic, other)
    test = [(t, y) for (i, t, *_), (_, _, y) in zip(docs, labels, strict=True) if zlib.crc32(str(i).encode()) % 5 == 0]
    got = model.scores(model.reader(), [t.encode() for t, _ in test])
    assert np.mean((got >= 0.5) == [y for _, y in test]) > 0.97
    tricks = ["you wre.tch.ling", "you MUDBRAIN!!", "a mudxbrain here", "g u t t e r f o p", "gutter-fop", "alpha " * 5000 + "mudbrain"]
    clean = ["alpha bravo carol", "", " ".join(CLEAN) * 50, "9" * 100_000]
    assert (model.scores(model.reader(), [t.encode() for t in tricks]) >= 0.5).all()
    assert (model.scores(model.reader(), [t.encode() for t in clean]) < 0.5).all()


def test_scores_rows_nulls_and_clashing_columns(spark):
    docs, labels = corpus(400)
    docs += [(1000, None, None, None, None, None), (None, "you mudbrain", None, None, None, None), (1001, "", "en", "s", 0, None), (0, docs[0][1], "en", "s", 1, None)]
    labels += [(None, 1, 1), (3, None, None), (5, 1, 1)]
    df, marks = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    rated = score(df, fit(df, marks)).collect()
    assert len(rated) == len(docs) and all(0 <= r["_score"] <= 1 for r in rated)
    least = min(r["_score"] for r in rated)
    by = [(r["doc_id"], r["text"], r["_score"]) for r in rated]
    assert all(s == least for _, t, s in by if not t)
    kept = keep_civil(df, marks)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(d) for d, _, s in by if s < 0.5)
    # The same row scores alike in any partitioning.
    again = {(r["doc_id"], r["text"]): r["_score"] for r in score(df.repartition(7), fit(df, marks)).collect()}
    assert all(again[(d, t)] == pytest.approx(s) for d, t, s in by)


@pytest.mark.parametrize("labels", [[], [(1, 1, 1)], [(1, 1, 0), (2, 1, 0)]])
def test_without_two_classes_all_score_the_share(spark, labels):
    df = spark.createDataFrame([(1, "a b c", "en", "s", 1, None), (2, None, "en", "s", 1, None)], DOCS)
    got = {r["_score"] for r in score(df, fit(df, spark.createDataFrame(labels, LABELS))).collect()}
    assert len(got) == 1 and got <= {0.0, 1.0}
    assert score(df.limit(0), fit(df, spark.createDataFrame(labels, LABELS))).count() == 0
