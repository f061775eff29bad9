import random

import numpy as np
import pytest

from siltstone.llm import minmax, words
from siltstone.llm.minmax import components, keep_one, near_duplicates, shingle_sets, signature

KIND = "doc_id long, text string, node long, bands string"


def brute(rows, percent=85, size=3):
    def shingles(text):
        found = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
        if not found:
            return frozenset()
        return frozenset(tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1)))

    sets = [shingles(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return [(r[0], len(sets[i]), least.get(root(i)), r[0] is None or least[root(i)] == r[0]) for i, r in enumerate(rows)]


def corpus(seed, groups=12, size=12):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "ß,", "x."]
    rows = []
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.choice([1, 2, 3, 5, 30, 80, 120]))
        for _ in range(rng.randint(1, size)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append(" ".join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in copy))
    rng.shuffle(rows)
    return [(3 * i + 1, t, 0, "clash") for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed) + [(2, None, 1, None), (5, "", 1, None), (8, " \n\t", 1, None), (11, "one", 1, None), (14, "ONE", 1, None), (17, "one two", 1, None),
                           (20, "one\ntwo", 1, None), (None, "one two", 1, None), (1, "one two", 1, None), (23, "long " * 60_000, 1, None)]
    got = near_duplicates(spark.createDataFrame(rows, KIND)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(brute(rows), key=repr)


def test_a_group_around_the_threshold_loses_no_link(spark, monkeypatch):
    """Many copies that are near their neighbours but not near all: the blocks have to find the rest."""
    monkeypatch.setattr(minmax, "BLOCK", 8)
    rng = random.Random(9)
    base = [f"b{i}" for i in range(90)]
    rows = []
    for i in range(120):
        copy = list(base)
        for _ in range(rng.randint(1, 7)):
            copy[rng.randrange(90)] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy), 0, None))
    got = near_duplicates(spark.createDataFrame(rows, KIND)).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows))


def test_keep_one_leaves_one_row_of_each_group(spark):
    rows = [(1, "a b c d", 7, "x"), (1, "a b c d", 7, "x"), (2, "a b c d", 8, None), (3, None, 9, None), (None, "q", 1, None)]
    df = spark.createDataFrame(rows, KIND)
    got = keep_one(df)
    assert got.columns == df.columns
    assert sorted((r["doc_id"] for r in got.collect()), key=str) == [1, 3, None]
    assert near_duplicates(df.limit(0)).count() == 0 and keep_one(df.limit(0)).count() == 0


def test_keep_one_keeps_different_texts_of_one_id(spark):
    near = " ".join(f"n{i}" for i in range(60))
    own = [" ".join(f"t{k}_{i}" for i in range(60)) for k in range(6)]
    rows = [(0, near, 0, None), (5, near + " more", 0, None)] + [(5, t, 0, None) for t in own] + [(5, own[0], 0, None)]
    rows += [(5, own[1] + " end", 0, None), (5, None, 0, None), (5, "", 0, None), (None, own[2], 0, None), (9, own[3], 0, None)]
    got = [(r["doc_id"], r["text"]) for r in keep_one(spark.createDataFrame(rows, KIND)).collect()]
    # The near copy of document 0 and the copy in document 9 go; of the two near texts of id 5 one stays.
    pair = [x for x in got if x in ((5, own[1]), (5, own[1] + " end"))]
    assert len(pair) == 1
    want = [(0, near), (5, None), (5, ""), (None, own[2])] + [(5, t) for k, t in enumerate(own) if k != 1]
    assert sorted(got, key=repr) == sorted(want + pair, key=repr)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    for share in (0.3, 0.8):
        both = int(4000 * share)
        a, b = x[: (4000 + both) // 2], x[(4000 - both) // 2 :]
        assert abs(np.mean(signature(np.sort(a)) == signature(np.sort(b))) - both / 4000) < 0.15


def test_words_in_parts_equal_words_at_once(monkeypatch):
    texts = [b"Aa  bb\tcc" * 20, b"", b"x" * 500, b" y " * 99, "é ü".encode() * 40]
    whole = shingle_sets(texts)
    monkeypatch.setattr(words, "CHUNK", 64)
    assert all((a == b).all() for a, b in zip(whole, shingle_sets(texts), strict=True))


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(2, 41)} | {100 + i: 100 for i in range(1, 30)}
