import math
import random
import zlib
from collections import Counter

import numpy as np

from siltstone.llm import ngram_quality as nq
from siltstone.llm import words

DOCS = "doc_id long, text string, lang string, score double, label int"
LABELS = "doc_id long, quality int, toxic int"
GOOD = "river stone valley bright morning carried slowly over hills toward open water while birds called".split()


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        text = " ".join(rng.choices(GOOD, k=rng.randint(20, 80))) + "."
        bad = i % 3 == 0
        if bad:
            text = rng.choice([text.upper() + "!!", " ".join([rng.choice(GOOD)] * 40), " | ".join(text.split()), text.replace(" ", "### ")])
        docs.append((i, text, "en", 9.0, 1))
        labels.append((i, int(not bad), 0))
    return docs, labels


def tokens_of(text):
    """What a text's tokens are, one by one."""
    out, last, i = [], None, 0
    is_mark = lambda c: "!" <= c <= "~" and not c.isalnum()
    is_word = lambda c: c.isascii() and c.isalnum() or not c.isascii()
    while i < len(text):
        kind = is_word if is_word(text[i]) else is_mark if is_mark(text[i]) else None
        j = i + 1
        while kind and j < len(text) and kind(text[j]):
            j += 1
        run = text[i:j]
        if kind is is_word:
            low = "".join(c.lower() if c.isascii() else c for c in run)
            if sum("A" <= c <= "Z" for c in run) >= 2 and not any("a" <= c <= "z" for c in run):
                out.append(("shout",))
            out.append(("repeat",) if low == last else ("word", low))
            last = low
        elif kind is is_mark:
            out.append(("mark", run))
        i = j
    return out


def test_features_equal_their_definition():
    rng = random.Random(2)
    texts = ["", " ", "Was. Was. WAS!! é É a1 A1 B2B", "x"] + ["".join(rng.choices("aB1 .!|\té", k=rng.randint(0, 60))) for _ in range(60)]
    text, cell, value = (np.concatenate(x) for x in zip(*[(t + at, c, v) for at, _, t, c, v in nq.features([t.encode() for t in texts])], strict=True))
    for i, t in enumerate(texts):
        token = [("edge",), *tokens_of(t), ("edge",)]
        grams = Counter(tuple(token[a : a + n]) for n in (1, 2, 3) for a in range(len(token) - n + 1))
        norm = math.sqrt(sum(math.log1p(c) ** 2 for c in grams.values()))
        want = sorted(math.log1p(c) / norm for c in grams.values())
        assert np.allclose(sorted(value[text == i]), want), t
    twice = {}
    for i, t in enumerate(texts):
        twice.setdefault(tuple(tokens_of(t)), set()).add(tuple(cell[text == i]))
    assert all(len(x) == 1 for x in twice.values())


def test_long_texts_do_not_depend_on_where_they_are_cut(monkeypatch):
    text = (" ".join(["same"] * 500) + " BIG words, here. " * 300).encode()

    def seen(chunk):
        monkeypatch.setattr(words, "CHUNK", chunk)
        (_, _, _, cell, value), *more = nq.features([text])
        assert not more
        return dict(zip(cell.tolist(), value.tolist(), strict=True))

    assert seen(64) == seen(1000) == seen(1 << 21)


def test_held_out_accuracy_and_edge_rows(spark):
    docs, labels = corpus()
    docs += [(None, "no id", None, None, None), (2001, None, "en", 1.0, 1), (2002, "", "en", 1.0, 1), docs[1], docs[1]]
    labels += [(None, 1, 0), (3, None, 0), (4, 0, 0), (4, 1, 0), (9999, 1, 1)]
    frame, marks = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    found = nq.score(frame, nq.fit(frame, marks), name="rated").collect()
    assert len(found) == len(docs)
    assert all(0 <= r["rated"] <= 1 for r in found)
    held = [r for r in found if r["doc_id"] is not None and r["doc_id"] < 600 and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    right = [(r["rated"] >= nq.GOOD) == (r["doc_id"] % 3 != 0) for r in held]
    assert sum(right) / len(right) > 0.97
    assert len({r["rated"] for r in found if r["doc_id"] in (2001, 2002)}) == 1
    assert len({r["rated"] for r in found if r["doc_id"] == 1}) == 1


def test_the_sample_is_bounded_and_takes_one_text_of_an_id(spark):
    docs = spark.createDataFrame([(i % 40, f"text {i}", "en", 0.0, 0) for i in range(400)], DOCS)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], LABELS)
    sample = nq.sampled(docs, labels, "doc_id", "text", "quality", 7).collect()
    assert len(sample) == 14
    assert len({r["id"] for r in sample}) == 14
    assert not [r for r in sample if zlib.crc32(str(r["id"]).encode()) % 4 == 2]


def test_without_labels_every_score_is_a_half(spark):
    docs = spark.createDataFrame([(1, "a", "en", 0.0, 0)], DOCS)
    empty = spark.createDataFrame([], LABELS)
    assert nq.score(docs, nq.fit(docs, empty)).first()["score"] == 0.5
    assert nq.score(docs.limit(0), nq.fit(docs, empty)).count() == 0


def test_ftrl_equals_its_formula():
    learner = nq.Learner(bits=4)
    z, n, w = np.zeros(16), np.zeros(16), np.zeros(16)
    rng = np.random.default_rng(1)
    bz = bn = 0.0
    for _ in range(50):
        cell = np.sort(rng.choice(16, 4, replace=False))
        value, label = rng.random(4), int(rng.integers(2))
        learner.learn(cell, value, label)
        for i in range(16):
            w[i] = 0 if abs(z[i]) <= nq.L1 else -(z[i] - math.copysign(nq.L1, z[i])) / ((nq.BETA + math.sqrt(n[i])) / nq.ALPHA + nq.L2)
        b = -bz / ((nq.BETA + math.sqrt(bn)) / nq.ALPHA)
        p = 1 / (1 + math.exp(-(sum(w[i] * v for i, v in zip(cell, value, strict=True)) + b)))
        for i, v in zip(cell, value, strict=True):
            g = (p - label) * v
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / nq.ALPHA * w[i]
            n[i] += g * g
        bz += (p - label) - (math.sqrt(bn + (p - label) ** 2) - math.sqrt(bn)) / nq.ALPHA * b
        bn += (p - label) ** 2
    assert np.allclose(learner.z, z)
    assert np.allclose(learner.n, n)
