import random
import re
from collections import Counter
from fractions import Fraction

import pytest

from siltstone.llm import collocations as col

DOCS = "doc_id long, text string, lang string, size long, phrase string, n long"


def slow(docs, least, top):
    """The contract, word by word."""
    counts, total = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            found = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(found)
            for i in range(len(found)):
                for k in range(1, 6):
                    if i + k <= len(found):
                        counts[lang, tuple(found[i : i + k])] += 1
    kept = {g: a for g, a in counts.items() if len(g[1]) >= 2 and a >= least}
    rows = {}
    for (lang, gram), a in kept.items():
        if any(
            len(other) > len(gram) and b >= a and any(other[i : i + len(gram)] == gram for i in range(len(other)))
            for (l, other), b in kept.items()
            if l == lang
        ):
            continue
        cuts = []
        for k in range(1, len(gram)):
            x, y = counts[lang, gram[:k]], counts[lang, gram[k:]]
            cuts.append((Fraction(1000 * a * total[lang], x * y).__floor__(), k, x, y))
        score, _, x, y = min(cuts)
        rows.setdefault(lang, []).append((-score, -a, " ".join(gram).encode(), x, y, total[lang]))
    out = []
    for lang, found in rows.items():
        for rank, (score, a, phrase, x, y, n) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, x, y, n, -score))
    return sorted(out)


def corpus(seed, n=150):
    rng = random.Random(seed)
    vocabulary = ["Ab", "b", "ç", "dé", "e-e", "f", " g"]
    glue = [" ", " ", "  ", "\t", ", ", ".", "\n", " ! "]
    docs = []
    for i in range(n):
        text = "".join(rng.choice(vocabulary) + rng.choice(glue) for _ in range(rng.randint(0, 40)))
        docs.append((i, text + "the quick brown fox jumps over" * (i % 3 == 0), rng.choice(["en", "en", None, "und", "fr"]), 1, "x", 2))
    docs += [(None, None, "en", 1, None, None), (5, "", "de", 1, None, None), (7, " \t ", "de", 1, None, None)]
    return docs + docs[:20]  # repeated rows count as often as they occur


def got(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


@pytest.mark.parametrize(("seed", "least", "top"), [(1, 4, 2000), (2, 9, 5), (3, 300, 10)])
def test_equals_brute_force(spark, seed, least, top):
    docs = corpus(seed)
    df = spark.createDataFrame(docs, DOCS).repartition(3)
    want = slow([(d[1], d[2]) for d in docs], least, top)
    assert got(col.collocations(df, least=least, top=top, counter_bits=16)) == want


def test_shared_counters_change_no_result(spark):
    docs = corpus(4)
    df = spark.createDataFrame(docs, DOCS)
    want = slow([(d[1], d[2]) for d in docs], 5, 2000)
    for bits in (13, 14):
        assert got(col.collocations(df, least=5, counter_bits=bits)) == want


def test_long_texts_lose_no_gram_at_a_cut(monkeypatch):
    rng = random.Random(5)
    text = " ".join(rng.choice(["aa", "b", "cc.", "d"]) for _ in range(3000)).encode()
    import numpy as np

    def counted(chunk):
        monkeypatch.setattr(col, "BUFFER", chunk)
        out = Counter()
        for data, bounds, _ in col.buffers([b"x", text, b""]):
            with np.errstate(over="ignore"):
                found = col.Found(data, bounds, np.zeros(len(bounds) - 1, np.int64), np.ones(1, np.uint64))
                if not len(found.starts):
                    continue
                size = sum(inside.astype(np.int64) for _, inside in found.grams(5))
                at, many = col.edges_of(found, size, 5)
                for phrase, n in zip(col.phrases_at(data, found, at, size).to_pylist(), many.tolist(), strict=True):
                    out[phrase] += n
        return out

    assert counted(50) == counted(777) == counted(1 << 21)


def test_empty_table_and_products_beyond_64_bits(spark):
    assert got(col.collocations(spark.createDataFrame([], DOCS), counter_bits=13)) == []
    big = 3_000_000_000_000
    nodes = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big - 1), ("en", "a b", 2, big - 7)], "lang string, phrase string, size int, f long")
    totals = spark.createDataFrame([("en", 9 * big)], "lang string, n long")
    row = col.scored(col.path_ends(nodes), nodes, totals).first()
    assert row["score"] == 1000 * (big - 7) * 9 * big // (big * (big - 1))
