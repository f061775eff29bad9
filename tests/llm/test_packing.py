import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from siltstone.llm import packing
from siltstone.llm.packing import best_fit, cut, lower_bound, pack_documents, packed, sequences

KIND = "doc_id long, text string, length long, _row long"
VOCABULARY, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def exact(lengths, capacity):
    """Least number of bins by trying all."""
    best = len(lengths)

    def place(rest, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if not rest:
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + rest[0] <= capacity and bins[i] not in bins[:i]:
                place(rest[1:], bins[:i] + [bins[i] + rest[0]] + bins[i + 1 :])
        place(rest[1:], bins + [rest[0]])

    place(sorted(lengths, reverse=True), [])
    return best


def test_bound_is_below_the_best_and_best_fit_above():
    rng = random.Random(2)
    for _ in range(150):
        lengths = np.array([rng.randint(1, 20) for _ in range(rng.randint(1, 9))])
        made = best_fit(lengths, 20)
        assert np.bincount(made, weights=lengths).max() <= 20
        assert lower_bound(lengths, 20) <= exact(lengths.tolist(), 20) <= made.max() + 1
    assert lower_bound(np.array([]), 20) == 0
    assert lower_bound(np.array([11] * 7 + [5]), 20) == 7  # two halves and a bit never share


def check(rows, capacity):
    for _, group in itertools.groupby(sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])), key=lambda r: r["sequence_id"]):
        at = 0
        for r in group:
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity


@pytest.mark.parametrize("group", [40, 100_000])
def test_exchanges_improve_on_separate_groups(spark, group):
    rng = random.Random(4)
    rows = [(i, None, rng.randint(1, 100), i) for i in range(600)] + [(1, None, 100, 5)] * 3
    got = packed(spark.createDataFrame(rows, KIND), 100, group).collect()
    assert sorted((r["doc_id"], r["length"]) for r in got) == sorted((r[0], r[2]) for r in rows)
    check(got, 100)
    least = lower_bound(np.array([r[2] for r in rows]), 100)
    assert len({r["sequence_id"] for r in got}) <= least * (1.1 if group == 40 else 1.02)


def test_pieces_are_the_tokens_of_each_document(spark, monkeypatch):
    texts = ["", None, "hello world", "x" * 9000, "The cat. " * 3000, "日本語 テキスト " * 900, "<|endoftext|> a", "a\u0000b \U0001f600", "é" * 5000, "a  b\n\n\tc" * 700]
    rows = [(i, t, 1, 2) for i, t in enumerate(texts)] + [(2, "hello world", 1, 2), (None, "no id", 1, 2)]
    df = spark.createDataFrame(rows, KIND)
    got = pack_documents(df).collect()
    check(got, packing.CAPACITY)
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    want = []
    for doc, text, *_ in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        first = len(ids) % 2048 or 2048
        bounds = [0, *range(first, len(ids) + 1, 2048)]
        want += [(doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(itertools.pairwise(bounds))]
    keys = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted((tuple(r[k] for k in keys) for r in got), key=repr) == sorted(want, key=repr)
    assert pack_documents(df.limit(0)).count() == 0


def test_sequences_hold_whole_documents(spark):
    df = spark.createDataFrame([(i, f"text number {i} " * i, 1, 2) for i in range(30)], KIND)
    pieces = packed(cut(df.select("doc_id", "text"), VOCABULARY, RANKS, with_ids=True))
    rows = sequences(pieces).collect()
    assert sum(len(r["ids"]) for r in rows) == sum(r["length"] for r in pieces.collect())
    assert all(len(r["ids"]) <= packing.CAPACITY and r["ids"][-1] == 0 for r in rows)
