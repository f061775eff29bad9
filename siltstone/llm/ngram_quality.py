"""Text quality by logistic regression on hashed word n-grams, fitted by follow-the-regularised-leader.

A text is cut into tokens: runs of letters and digits, lower-cased, and runs of ASCII marks. A token that
repeats the one of its kind before it is written as a repetition, and a word in capitals gets a
token of its own beside it; so n-grams also tell of repetition, shouting and strewn marks. N-grams of one
to three tokens are hashed into a fixed number of features, whose values are damped counts, scaled to
length one. A score is the logistic function of a sparse dot product.

The model is fitted online, document by document, by FTRL-Proximal: every feature has its own learning
rate, and features that tell little stay at exactly 0. It learns from a bounded sample, in one task that
reads it as a stream; every document is scored in the task that reads it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import common, words
from siltstone.llm.common import once, sent_whole, table

sent_whole(common.__name__)
sent_whole(words.__name__)
sent_whole(__name__)

#: Labelled documents of each label that a model is fitted on, at most; the first by a hash of id and text.
SAMPLE = 5000
#: Times that the sample is read, each time in another order.
EPOCHS = 4
BITS = 20
ORDER = 3
ALPHA, BETA, L1, L2 = 0.2, 1.0, 0.05, 0.5
GOOD = 0.7

MARK = np.zeros(256, dtype=bool)
MARK[[b for b in range(0x21, 0x7F) if not words.ALPHANUMERIC[b]]] = True
UPPER = np.zeros(256, dtype=bool)
UPPER[65:91] = True
SMALL = np.zeros(256, dtype=bool)
SMALL[97:123] = True
REPEATED, SHOUTED, OUTSIDE = (np.uint64(x) for x in (0x51ED270B7A1C9E35, 0x2E5BF271A3C4D817, 0x7C3A9D1E5F2B8641))
_STEP = np.uint64(0x9FB21C651E98DF25)


#: Kinds of tokens.
WORD_TOKEN, MARK_TOKEN, SHOUT_TOKEN = 0, 1, 2


def _tokens(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, kind and place of the tokens of UTF-8 bytes, in order."""
    word, word_at = words.word_hashes(data, words.ALPHANUMERIC)
    mark, mark_at = words.word_hashes(data, MARK)
    ends = np.concatenate((word_at[1:], [len(data)]))[: len(word_at)]
    big, small = (np.concatenate(([0], np.cumsum(kind[data]))) for kind in (UPPER, SMALL))
    shouted = word_at[(big[ends] - big[word_at] >= 2) & (small[ends] == small[word_at])]
    at = np.concatenate((shouted, word_at, mark_at))
    hashes = np.concatenate((np.full(len(shouted), SHOUTED), word, mark + np.uint64(1)))
    kinds = np.repeat(np.array([SHOUT_TOKEN, WORD_TOKEN, MARK_TOKEN]), [len(shouted), len(word), len(mark)])
    order = np.argsort(at, kind="stable")
    return hashes[order], kinds[order], at[order]


def _cells(hashes: np.ndarray, kinds: np.ndarray, text: np.ndarray, texts: int, bits: int, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value) of tokens that are sorted by text."""
    word = np.flatnonzero(kinds == WORD_TOKEN)
    same = (hashes[word[1:]] == hashes[word[:-1]]) & (text[word[1:]] == text[word[:-1]])
    hashes = hashes.copy()
    hashes[word[1:][same]] = REPEATED
    # Every text begins and ends with a token of its own.
    token = np.full(len(hashes) + 2 * texts, OUTSIDE)
    token[np.arange(len(hashes)) + 2 * text + 1] = hashes
    owner = np.repeat(np.arange(texts), np.bincount(text, minlength=texts) + 2)
    shift, found, grams = np.uint64(64 - bits), [], token
    for n in range(order):
        inside = owner[: len(grams)] == owner[n:]
        found.append((owner[: len(grams)] << bits | (words.mixed(grams + np.uint64(n)) >> shift).astype(np.int64))[inside])
        grams = words.mixed(grams[:-1] * _STEP + token[n + 1 :])
    both = np.sort(np.concatenate(found))
    first = np.flatnonzero(np.diff(both, prepend=-1))
    value = np.log1p(np.diff(first, append=len(both)))
    of = both[first] >> bits
    return of, both[first] & ((1 << bits) - 1), value / np.sqrt(np.bincount(of, value * value, minlength=texts))[of]


def features(texts: list[bytes], bits: int = BITS, order: int = ORDER) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, texts, text, feature, value) of groups of short texts, and of each long one.

    A long text is cut into tokens in parts that end at blanks; what follows sees the whole of it.
    """
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop]) < words.CHUNK):
            size += len(texts[stop]) + 1
            stop += 1
        with np.errstate(over="ignore"):
            if stop == at + 1:
                parts = [_tokens(np.frombuffer(part, np.uint8)) for part in words.chunks(texts[at])]
                hashes, kinds = (np.concatenate(x) for x in list(zip(*parts, strict=True))[:2])
                text = np.zeros(len(hashes), np.int64)
            else:
                hashes, kinds, place = _tokens(np.frombuffer(b"\n".join(texts[at:stop]), np.uint8))
                text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts[at:stop]]), place, side="right")
            yield at, stop - at, *_cells(hashes, kinds, text, stop - at, bits, order)
        at = stop


class Learner:
    """FTRL-Proximal: per feature the sum of adjusted gradients and the sum of their squares."""

    def __init__(self, bits: int = BITS) -> None:
        self.z = np.zeros(1 << bits)
        self.n = np.zeros(1 << bits)
        self.offset_z = self.offset_n = 0.0

    @staticmethod
    def _weight(z: np.ndarray | float, n: np.ndarray | float, l1: float, l2: float) -> np.ndarray | float:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + l2)

    def learn(self, cell: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self._weight(self.z[cell], self.n[cell], L1, L2)
        b = self._weight(self.offset_z, self.offset_n, 0, 0)
        off = chance(float(w @ value) + b) - label
        g = off * value
        self.z[cell] += g - (np.sqrt(self.n[cell] + g * g) - np.sqrt(self.n[cell])) / ALPHA * w
        self.n[cell] += g * g
        self.offset_z += off - (np.sqrt(self.offset_n + off * off) - np.sqrt(self.offset_n)) / ALPHA * b
        self.offset_n += off * off

    def weights(self) -> np.ndarray:
        """All weights, the offset last."""
        return np.append(self._weight(self.z, self.n, L1, L2), self._weight(self.offset_z, self.offset_n, 0, 0)).astype(np.float32)


def chance(x: np.ndarray | float) -> np.ndarray | float:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string")) % 4 == 2


def sampled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int) -> DataFrame:
    """(key, text, label) of at most ``rows`` documents of each label that are not held out.

    An id with several labels has the smallest, and of an id with several texts one is taken, by a hash;
    so no id brings more than a row. Rows without an id or a label are left out.
    """
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
    usable = usable.groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("int").alias("label"))
    ids = usable.withColumn("key", F.xxhash64("id"))
    # No more ids than twice the parameter, each with one number and a label: small by construction.
    few = [ids.where(F.col("label") == y).orderBy("key", "id").limit(rows) for y in (0, 1)]
    few = few[0].unionByName(few[1])
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).join(F.broadcast(few), "id")
    return texts.groupBy("id", "label", "key").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))


def fit(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE, epochs: int = EPOCHS
) -> np.ndarray:
    """The weights, offset last. Without any labelled text they are 0, and every score is a half."""
    sample = sampled(docs, labels, id_col, text_col, label_col, rows)
    rounds = sample.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs)))).withColumn("turn", F.xxhash64("epoch", "key"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner = Learner()
        for batch in batches:
            labels = batch.column(1).to_pylist()
            for at, count, text, cell, value in features(words.encoded(batch.column(0))):
                bounds = np.searchsorted(text, np.arange(count + 1))
                for i in range(count):
                    learner.learn(cell[bounds[i] : bounds[i + 1]], value[bounds[i] : bounds[i + 1]], labels[at + i])
        yield pa.RecordBatch.from_arrays([pa.array([learner.weights().tobytes()], pa.binary())], ["weights"])

    ordered = rounds.repartition(1).sortWithinPartitions("epoch", "turn", "id").select("text", "label")
    fitted = ordered.mapInArrow(learn, "weights binary").first()
    return np.frombuffer(fitted[0], np.float32) if fitted else np.zeros((1 << BITS) + 1, np.float32)


def score(docs: DataFrame, weights: np.ndarray, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1. Row by row; null counts as empty, and empty texts are scored, too.

    A column named like the score is replaced.
    Only features with a weight are sent: their numbers and values, bounded by the number of features.
    """
    used = np.flatnonzero(weights[:-1])
    packed = used.astype(np.int32).tobytes(), weights[used].tobytes(), float(weights[-1]), len(weights) - 1
    sent = docs.sparkSession.sparkContext.broadcast(packed)
    mark = f"ngram-quality-{hashlib.sha256(packed[0] + packed[1]).hexdigest()}"
    out = docs.withColumn(name, F.lit(0.0).cast("double"))
    position, place = docs.columns.index(text_col), out.columns.index(name)

    def unpacked() -> np.ndarray:
        full = np.zeros(sent.value[3])
        full[np.frombuffer(sent.value[0], np.int32)] = np.frombuffer(sent.value[1], np.float32)
        return full

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full, offset = once(mark, unpacked), sent.value[2]
        for batch in batches:
            scores = np.full(batch.num_rows, offset)
            for at, count, text, cell, value in features(words.encoded(batch.column(position))):
                scores[at : at + count] += np.bincount(text, full[cell] * value, minlength=count)
            columns = [*batch.columns]
            columns[place] = pa.array(chance(scores), pa.float64())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return out.mapInArrow(rate, out.schema)


def op11_ngram_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of those labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rated = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return rated.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))
