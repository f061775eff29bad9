"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear support vector machine.

The kernel of two words counts the subsequences of three characters that they share, within a span of
seven, each weighted by a decay for its span; so words stay similar when characters are inserted or
left out. Landmark words come from labelled texts; a sentence is the largest kernel value of its words
with each landmark, whitened by the landmarks' own kernel. The machine is trained on sentences whose
labels follow from those of their documents, and a document is as toxic as its worst sentence.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import common, words
from siltstone.llm.common import once, sent_whole, sheltered, table

sent_whole(common.__name__)
sent_whole(words.__name__)
sent_whole(__name__)

#: Labelled documents that a model is fitted on, at most, toxic and other; the first by a hash of their id.
TOXIC_ROWS, OTHER_ROWS = 1500, 3500
LANDMARKS = 128
#: Words among which landmarks are chosen.
CANDIDATES = 256
#: The kernel of sentences takes this power of the words' normalised kernel, which is a kernel again.
POWER = 2
#: Normalised kernel values below this count as 0.
LEAST_KERNEL = 0.4
DECAY = 0.7
SPAN = 7
#: Gaps of a subsequence of three: its second and third character's distance from the first.
PATTERNS = tuple((a, b) for b in range(2, SPAN) for a in range(1, b))
#: Words longer than this are seen through overlapping windows of it, in bytes.
LONGEST = 24
#: Bytes of short texts that are read at once.
TEXT_BYTES = 1 << 20
#: Words whose kernels are taken at once.
SLICE = 4096
#: Words without any kernel value that a worker remembers.
REMEMBERED = 1 << 21
SENTENCE_END = np.zeros(256, dtype=bool)
SENTENCE_END[[0x21, 0x2E, 0x3F]] = True
JOINERS = np.zeros(256, dtype=bool)
JOINERS[[ord(c) for c in ".-_*'~^+"]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] = LOWER[97:123]


def weight(b: int) -> float:
    return DECAY ** (b + 1)


def subsequences(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, key, weight) of all subsequences of words in a lower-cased byte buffer; the key holds the three bytes."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    begins = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(begins, sizes)
    flat = data[np.repeat(starts, sizes) + place].astype(np.int64)
    left = np.repeat(sizes, sizes) - place
    found = []
    for a, b in PATTERNS:
        at = np.flatnonzero(left > b)
        found.append((owner[at], flat[at] | flat[at + a] << 8 | flat[at + b] << 16, np.full(len(at), weight(b))))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def self_kernels(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    word, key, value = subsequences(data, starts, sizes)
    if not len(word):
        return np.zeros(len(sizes))
    both = word << 24 | key
    order = np.argsort(both, kind="stable")
    both, value = both[order], value[order]
    first = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1])))
    total = np.add.reduceat(value, first)
    return np.bincount(both[first] >> 24, total * total, minlength=len(sizes))


@dataclass
class Words:
    """Words of some texts: where they are, which text and sentence they belong to, and their hashes."""

    data: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    text: np.ndarray
    sentence: np.ndarray
    hashes: np.ndarray


def words_of(texts: list[bytes]) -> Words:
    """Words between blanks; three or more single characters in a row also make one word.

    Marks that only join the letters of a word (``i.d-i_o*t``) are left out.
    """
    data = LOWER[np.frombuffer(b" ".join(texts), np.uint8)]
    letter = words.ALPHANUMERIC[data]
    inner = JOINERS[data]
    inner[:1] = inner[-1:] = False
    inner[1:-1] &= letter[:-2] & letter[2:]
    removed = np.concatenate(([0], np.cumsum(inner)))
    data = data[~inner]
    hashes, starts = words.word_hashes(data, words.NOT_BLANK)
    ends = np.flatnonzero(np.diff(words.NOT_BLANK[data].astype(np.int8), prepend=0, append=0) == -1)
    sizes = ends - starts
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    bounds[1:] -= removed[np.minimum(bounds[1:], len(removed) - 1)]
    whole = sizes
    starts, sizes = stripped(data, starts, sizes)
    text = np.searchsorted(bounds, starts, side="right") - 1
    last = SENTENCE_END[data[ends - 1]] if len(ends) else np.empty(0, bool)
    new = np.concatenate(([0], last[:-1].astype(np.int64))) if len(ends) else np.empty(0, np.int64)
    sentence = np.cumsum(new + (np.diff(text, prepend=text[:1]) != 0)) if len(ends) else new
    one = whole == 1
    edge = np.diff(one.astype(np.int8), prepend=0, append=0)
    extra: list[bytes] = []
    owners: list[int] = []
    for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True):
        for k in range(a, b - 2):  # runs end with their text
            if k == a or text[k] != text[k - 1]:
                stop = int(np.searchsorted(text[a:b], text[k], side="right")) + a
                if stop - k >= 3:
                    extra.append(data[starts[k:stop]].tobytes())
                    owners.append(k)
    if extra:
        joined = np.frombuffer(b" ".join(extra), np.uint8)
        more, at = words.word_hashes(joined, words.NOT_BLANK)
        hashes = np.concatenate((hashes, more))
        starts = np.concatenate((starts, at + len(data) + 1))
        sizes = np.concatenate((sizes, [len(x) for x in extra]))
        text, sentence = np.concatenate((text, text[owners])), np.concatenate((sentence, sentence[owners]))
        data = np.concatenate((data, np.array([32], np.uint8), joined))
    return Words(data, starts, sizes, text, sentence, hashes)


def stripped(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words without the ASCII marks at their ends."""
    starts, sizes = starts.copy(), sizes.copy()
    for end in (True, False):
        todo = np.arange(len(sizes))
        while len(todo):
            todo = todo[sizes[todo] > 1]
            at = starts[todo] + sizes[todo] - 1 if end else starts[todo]
            todo = todo[~words.ALPHANUMERIC[data[at]]]
            sizes[todo] -= 1
            if not end:
                starts[todo] += 1
    return starts, sizes


class Kernel:
    """Kernel values of words with the landmarks."""

    def __init__(self, landmarks: list[bytes]) -> None:
        self.landmarks = landmarks
        data = np.frombuffer(b" ".join(landmarks), np.uint8)
        sizes = np.array([len(x) for x in landmarks])
        starts = np.cumsum(sizes + 1) - sizes - 1
        word, key, value = subsequences(data, starts, sizes)
        # Bytes of the landmarks get small numbers, so that the table of all triples stays small.
        self.code = np.zeros(256, dtype=np.int64)
        used = np.unique(np.concatenate([key & 255, key >> 8 & 255, key >> 16]))
        self.code[used] = np.arange(1, len(used) + 1)
        self.base = len(used) + 1
        small = self.small(key & 255, key >> 8 & 255, key >> 16)
        self.keys, number = np.unique(small, return_inverse=True)
        self.number = np.full(self.base**3, -1, dtype=np.int32)
        self.number[self.keys] = np.arange(len(self.keys))
        self.features = np.zeros((len(self.keys), len(landmarks)))
        np.add.at(self.features, (number, word), value)
        self.norms = np.sqrt((self.features**2).sum(axis=0))
        self.features = (self.features / self.norms).astype(np.float32)
        self.most = self.features.max(axis=1)
        # Most triples occur in few landmarks: their rows are kept without zeros.
        row, self.column = np.nonzero(self.features)
        self.entry = self.features[row, self.column]
        self.begin = np.searchsorted(row, np.arange(len(self.keys) + 1))
        #: Least self-kernel of a word by its size.
        self.least = np.array([sum(max(0, n - b) * weight(b) ** 2 for a, b in PATTERNS) for n in range(LONGEST + 1)])

    def small(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        return (self.code[a] * self.base + self.code[b]) * self.base + self.code[c]

    def values(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words that any landmark is near, and their normalised kernel values, small ones as 0.

        Words that no landmark can reach are left out by upper bounds first; that loses none.
        """
        none = np.empty(0, np.int64), np.empty((0, len(self.landmarks)), np.float32)
        parts = [none]
        for at in range(0, len(sizes), SLICE):
            number, value = self._slice(data, starts[at : at + SLICE], sizes[at : at + SLICE])
            parts.append((number + at, value))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    def _slice(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        none = np.empty(0, np.int64), np.empty((0, len(self.landmarks)), np.float32)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        begins = np.cumsum(sizes) - sizes
        place = np.arange(int(sizes.sum())) - np.repeat(begins, sizes)
        code = self.code[data[np.repeat(starts, sizes) + place]]
        left = np.repeat(sizes, sizes) - place
        hits = []
        for a, b in PATTERNS:
            at = np.flatnonzero(left > b)
            number = self.number[(code[at] * self.base + code[at + a]) * self.base + code[at + b]]
            hit = np.flatnonzero(number >= 0)
            hits.append((owner[at[hit]], number[hit], np.full(len(hit), weight(b), np.float32)))
        word, number, value = (np.concatenate(x) for x in zip(*hits, strict=True))
        bound = np.sqrt(np.maximum(self.least[sizes], 1e-12)) * LEAST_KERNEL
        near = np.flatnonzero(np.bincount(word, value * self.most[number], minlength=len(sizes)) >= bound)
        if not len(near):
            return none
        slot = np.full(len(sizes), -1, dtype=np.int64)
        slot[near] = np.arange(len(near))
        kept = slot[word] >= 0
        word, number, value = slot[word[kept]], number[kept], value[kept]
        many = self.begin[number + 1] - self.begin[number]
        entry = np.repeat(self.begin[number] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        cell = np.repeat(word * len(self.landmarks), many) + self.column[entry]
        kernel = np.bincount(cell, np.repeat(value, many) * self.entry[entry], minlength=len(near) * len(self.landmarks)).reshape(len(near), -1)
        reach = kernel.max(axis=1) >= bound[near]
        near, kernel = near[reach], kernel[reach]
        kernel = kernel / np.sqrt(np.maximum(self_kernels(data, starts[near], sizes[near]), 1e-12))[:, None]
        kernel = np.where(kernel >= LEAST_KERNEL, kernel**POWER, 0).astype(np.float32)
        some = kernel.any(axis=1)
        return near[some], kernel[some]


def windows(found: Words, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, start, size) of the chosen words; long ones as overlapping windows that together see all subsequences."""
    long = chosen[found.sizes[chosen] > LONGEST]
    word = [chosen[found.sizes[chosen] <= LONGEST]]
    start, size = [found.starts[word[0]]], [found.sizes[word[0]]]
    for w in long:
        at = np.arange(0, found.sizes[w] - SPAN, LONGEST - SPAN)
        word.append(np.full(len(at), w))
        start.append(found.starts[w] + at)
        size.append(np.minimum(LONGEST, found.sizes[w] - at))
    return np.concatenate(word), np.concatenate(start), np.concatenate(size)


class Reader:
    """Sentence features of texts; remembers what it knows of words."""

    def __init__(self, kernel: Kernel) -> None:
        self.kernel = kernel
        self.dull = np.empty(0, np.uint64)
        self.recent = np.empty(0, np.uint64)  # joins ``dull`` when it has grown
        self.near: dict[int, np.ndarray] = {}

    def sentences(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(text, features) of each sentence in which a word is near a landmark."""
        none = np.empty(0, np.int64), np.empty((0, len(self.kernel.landmarks)), np.float32)
        with np.errstate(over="ignore"):
            found = words_of(texts)
        if not len(found.sizes):
            return none
        distinct, first, back = np.unique(found.hashes, return_index=True, return_inverse=True)
        known = np.zeros(len(distinct), bool)
        for held in (self.dull, self.recent):
            at = np.searchsorted(held, distinct)
            inside = at < len(held)
            known[inside] |= held[at[inside]] == distinct[inside]
        fresh = np.array([i for i in np.flatnonzero(~known) if int(distinct[i]) not in self.near], dtype=np.int64)
        short = found.sizes[first[fresh]] >= 3
        word, start, size = windows(found, first[fresh[short]])
        where, values = self.kernel.values(found.data, start, size)
        number = np.full(len(found.sizes), -1, dtype=np.int64)
        number[first] = np.arange(len(distinct))
        for w, v in zip(number[word[where]], values, strict=True):
            h = int(distinct[w])
            self.near[h] = np.maximum(self.near[h], v) if h in self.near else v
        dull = np.array([distinct[i] for i in fresh if int(distinct[i]) not in self.near], dtype=np.uint64)
        self.recent = np.union1d(self.recent, dull)
        if len(self.recent) > REMEMBERED // 16:
            self.dull = np.sort(np.concatenate((self.dull if len(self.dull) < REMEMBERED else dull, self.recent)), kind="stable")
            self.recent = self.recent[:0]
        if len(self.near) > REMEMBERED // 64:
            self.near = {int(h): self.near[int(h)] for h in distinct if int(h) in self.near}
        slot = np.full(len(distinct), -1, dtype=np.int64)
        rows = [i for i in np.flatnonzero(~known) if int(distinct[i]) in self.near]
        slot[rows] = np.arange(len(rows))
        hits = np.flatnonzero(slot[back] >= 0)
        if not len(hits):
            return none
        order = hits[np.argsort(found.sentence[hits], kind="stable")]
        begin = np.flatnonzero(np.diff(found.sentence[order], prepend=-1))
        features = np.maximum.reduceat(np.stack([self.near[int(distinct[i])] for i in rows])[slot[back[order]]], begin, axis=0)
        return found.text[order[begin]], features


def without_copies(texts: list[bytes], hashes: int = 4) -> list[bytes]:
    """The texts without later near copies, told by any of a few min-hashes of their word triples.

    Ten copies of one toxic text would make each of its words look toxic, in every part of the sample.
    """
    factors = words.BYTE_VALUE[1 : hashes + 1]
    seen: list[set[int]] = [set() for _ in factors]
    kept = []
    with np.errstate(over="ignore"):
        for text, found in zip(texts, words.hashes_of_texts(texts, words.NOT_BLANK), strict=True):
            triples = found if len(found) < 3 else words.mixed(words.mixed(words.mixed(found[:-2]) + found[1:-1]) + found[2:])
            if not len(triples):
                continue
            marks = [int(words.mixed(triples * f).min()) for f in factors]
            if not any(m in s for m, s in zip(marks, seen, strict=True)):
                kept.append(text)
            for m, s in zip(marks, seen, strict=True):
                s.add(m)
    return kept


def document_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted word hashes, and in how many texts each occurs."""
    words_seen, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    for at in range(0, len(texts), 500):
        with np.errstate(over="ignore"):
            found = words_of(texts[at : at + 500])
        order = np.lexsort((found.hashes, found.text))
        text, hashes = found.text[order], found.hashes[order]
        first = np.concatenate(([True], (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])))[: len(hashes)]
        some, count = np.unique(hashes[first], return_counts=True)
        words_seen, where = np.unique(np.concatenate((words_seen, some)), return_inverse=True)
        counts = np.bincount(where, np.concatenate((counts, count)), minlength=len(words_seen)).astype(np.int64)
    return words_seen, counts


def choose_landmarks(toxic: list[bytes], other: list[bytes], most: int = LANDMARKS) -> list[bytes]:
    """Words that tell toxic from other texts best, each adding texts to those before it.

    One half of the texts proposes words, the other judges them: what only chance made frequent in the
    first half does not last.
    """
    toxic, other, judges = toxic[::2], other[::2], (toxic[1::2], other[1::2])
    toxic_words, toxic_counts = document_counts(toxic)
    toxic_words, toxic_counts = toxic_words[toxic_counts >= 2], toxic_counts[toxic_counts >= 2]
    other_words, other_counts = document_counts(other)
    at = np.searchsorted(other_words, toxic_words)
    at[at == len(other_words)] = 0
    same = other_words[at] == toxic_words if len(other_words) else np.zeros(len(at), bool)
    counts = dict(zip(toxic_words.tolist(), zip(toxic_counts.tolist(), np.where(same, other_counts[at] if len(other_words) else 0, 0).tolist(), strict=True), strict=True))
    merged: dict[bytes, list[int]] = {}
    for k in range(0, len(toxic), 200):
        with np.errstate(over="ignore"):
            found = words_of(toxic[k : k + 200])
        for w in np.unique(found.hashes, return_index=True)[1]:
            both = counts.pop(int(found.hashes[w]), None)
            if both and 3 <= found.sizes[w] <= LONGEST:
                form = found.data[found.starts[w] : found.starts[w] + found.sizes[w]].tobytes()
                seen = merged.setdefault(form, [0, 0])
                seen[0] += both[0]
                seen[1] += both[1]
    n, m = len(toxic), len(other)
    odds = lambda a, b: np.log((a + 0.5) / (n + 1)) - np.log((b + 0.5) / (m + 1))
    ranked = sorted((w for w, (a, b) in merged.items() if a >= 2 and odds(a, b) > 1), key=lambda w: (-odds(*merged[w]) * merged[w][0], w))[:CANDIDATES]
    if not ranked:
        return []
    # A candidate counts with all words near it; so rare forms of one insult support each other.
    toxic, other = judges
    n, m = len(toxic), len(other)
    if not n or not m:
        return ranked[:most]
    reader = Reader(Kernel(ranked))
    largest = np.zeros((n + m, len(ranked)), dtype=np.float32)
    texts = [*toxic, *other]
    for at in range(0, len(texts), 200):
        text, features = reader.sentences(texts[at : at + 200])
        np.maximum.at(largest, text + at, features)
    share = n / (n + m)
    value = np.zeros(len(ranked))
    near = np.zeros(largest.shape, dtype=bool)
    for least in (LEAST_KERNEL, 0.5, 0.6, 0.7, 0.8, 0.9):
        within = largest >= least**POWER
        a, b = within[:n].sum(axis=0), within[n:].sum(axis=0)
        # Chance alone gives a word a few toxic texts: the share has to stand out by three deviations.
        sure = (a - (a + b) * share) / np.sqrt(np.maximum((a + b) * share * (1 - share), 1e-9)) > 3
        gain = np.where(sure, odds(a, b), 0)
        better = gain * a > value * near[:n].sum(axis=0)
        value[better] = gain[better]
        near[:, better] = within[:, better]
    left, taken = np.ones(n), []
    while len(taken) < most:
        gain = value * (near[:n] * left[:, None]).sum(axis=0)
        gain[taken] = 0
        i = int(np.argmax(gain))
        if gain[i] <= 0:
            break
        taken.append(i)
        left[near[:n, i]] *= 0.5
    return [ranked[i] for i in taken]


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 2e-5, rounds: int = 30) -> np.ndarray:
    """A linear machine with squared hinge loss, by Newton's method; the last weight is the offset."""
    x = np.hstack((x, np.ones((len(x), 1), np.float32)))
    weight = weight / weight.sum()
    w = np.zeros(x.shape[1])
    active = None
    for _ in range(rounds):
        inside = y * (x @ w.astype(np.float32)) < 1
        if active is not None and (inside == active).all():
            break
        active = inside
        square, target = ridge * np.eye(x.shape[1]), np.zeros(x.shape[1])
        rows = np.flatnonzero(inside)
        for at in range(0, len(rows), 10_000):
            part = x[rows[at : at + 10_000]].astype(np.float64)
            scaled = part * weight[rows[at : at + 10_000], None]
            square += scaled.T @ part
            target += scaled.T @ y[rows[at : at + 10_000]]
        w = np.linalg.solve(square, target)
    return w


def fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn decisions into chances; labels are pulled in a little, as is usual for it."""
    n, p = len(y), y.sum()
    target = np.where(y > 0, (p + 1) / (p + 2), 1 / (n - p + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        q = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([((q - target) * x).sum() + 1e-3 * a, (q - target).sum()])
        r = np.maximum(q * (1 - q), 1e-9)
        h = np.array([[(r * x * x).sum() + 1e-3, (r * x).sum()], [(r * x).sum(), r.sum() + 1e-9]])
        a, b = np.array([a, b]) - np.linalg.solve(h, g)
    return float(a), float(b)


def best_threshold(decision: np.ndarray, marked: np.ndarray) -> float:
    """The decision from which on counting as toxic gets most labels right.

    It stands nearer to the decision below it: misspelt insults lie in the gap, other texts do not.
    """
    order = np.argsort(decision, kind="stable")
    d, y = decision[order], marked[order]
    right = y.sum() - np.concatenate(([0], np.cumsum(np.where(y, 1, -1))))  # toxic from k on, less other from k on
    apart = np.concatenate(([True], d[1:] > d[:-1], [True]))
    k = int(np.argmax(np.where(apart, right, -len(d) - 1)))
    return float(d[0] - 1 if k == 0 else d[-1] + 1 if k == len(d) else d[k - 1] + 0.35 * (d[k] - d[k - 1]))


class Model:
    """Scores texts. Without landmarks, the share of toxic labels."""

    def __init__(self, toxic: list[bytes], other: list[bytes]) -> None:
        self.share = len(toxic) / max(1, len(toxic) + len(other))
        toxic, other = without_copies(toxic), without_copies(other)
        self.landmarks = choose_landmarks(toxic, other) if toxic and other else []
        if not self.landmarks:
            return
        kernel = Kernel(self.landmarks)
        own = (kernel.features.T @ kernel.features).astype(np.float64) ** POWER
        value, vector = np.linalg.eigh(own)
        good = value > 1e-6 * value.max()
        self.whiten = ((vector[:, good] / np.sqrt(value[good])) @ vector[:, good].T).astype(np.float32)
        reader = Reader(kernel)
        texts = [*toxic, *other]
        owner, rows = [], []
        for at in range(0, len(texts), 200):
            text, features = reader.sentences(texts[at : at + 200])
            owner.append(text + at)
            rows.append(features)
        owner, rows = np.concatenate(owner), np.concatenate(rows)
        best, x = rows.max(axis=1), rows @ self.whiten
        bag = owner < len(toxic)
        # Sentences of other texts are not toxic. Of a toxic text, the best one is, and all on its side.
        zeros = np.zeros((1, x.shape[1]), np.float32)
        score = best
        for number in range(3):
            top = np.zeros(len(x), bool)
            order = np.lexsort((-score, owner))
            top[order[np.flatnonzero(np.diff(owner[order], prepend=-1))]] = True
            positive = bag & (top | (score > 0 if number else False))
            used = positive | ~bag
            y = np.where(positive, 1.0, -1.0)
            balance = np.where(positive, 1 / max(1, positive.sum()), 1 / max(1, (~bag).sum()))
            self.weights = fit_svm(
                np.vstack((x[used], zeros)), np.append(y[used], -1.0), np.append(balance[used], 0.5)
            )
            score = x @ self.weights[:-1] + self.weights[-1]
        decision = np.full(len(texts), self.weights[-1])
        np.maximum.at(decision, owner, score)
        marked = np.arange(len(texts)) < len(toxic)
        self.slope, _ = fit_logistic(decision, marked)
        # Decisions crowd at the margin, where a straight line fits badly: one half stands where most
        # labels come out right.
        self.offset = -self.slope * best_threshold(decision, marked)

    def reader(self) -> Reader:
        return Reader(Kernel(self.landmarks))

    def scores(self, reader: Reader | None, texts: list[bytes]) -> np.ndarray:
        """A score from 0 to 1 for each whole text; a text without words near a landmark gets the least."""
        if reader is None:
            return np.full(len(texts), self.share)
        decision = np.full(len(texts), self.weights[-1])
        at = 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size + len(texts[stop]) < TEXT_BYTES):
                size += len(texts[stop]) + 1
                stop += 1
            parts = [*words.chunks(texts[at])] if stop == at + 1 else texts[at:stop]
            text, features = reader.sentences(parts)
            score = (features @ self.whiten) @ self.weights[:-1] + self.weights[-1]
            np.maximum.at(decision, np.full(len(text), at) if stop == at + 1 else text + at, score)
            at = stop
        return 1 / (1 + np.exp(-np.clip(self.slope * decision + self.offset, -30, 30)))


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", toxic_rows: int = TOXIC_ROWS, other_rows: int = OTHER_ROWS) -> Model:
    """A model from at most ``toxic_rows`` + ``other_rows`` labelled documents that are not held out.

    Rows without an id or a label are left out; a document of several labels has the largest; of
    several texts, all. The ids of the sample are bounded by the two parameters and are broadcast; its
    texts meet in one task, which fits the model.
    """
    usable = labels.filter(F.col(id_col).isNotNull() & F.col("toxic").isNotNull() & ~held_out(id_col)).groupBy(id_col).agg(F.max("toxic").alias("_toxic"))
    ids = usable.withColumn("_order", F.xxhash64(id_col))
    sample = ids.filter("_toxic = 1").orderBy("_order").limit(toxic_rows).unionByName(ids.filter("_toxic = 0").orderBy("_order").limit(other_rows))
    rows = docs.select(id_col, F.coalesce("text", F.lit("")).alias("_text")).join(F.broadcast(sample.select(id_col, "_toxic", "_order")), id_col)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampled = sorted(
            (order, text, toxic)
            for batch in batches
            for order, text, toxic in zip(batch.column(0).to_pylist(), words.encoded(batch.column(1)), batch.column(2).to_pylist(), strict=True)
        )
        model = Model([t for _, t, y in sampled if y == 1], [t for _, t, y in sampled if y == 0])
        yield pa.RecordBatch.from_arrays([pa.array([cloudpickle.dumps(model)], pa.binary())], ["model"])

    fitted = rows.select("_order", "_text", "_toxic").repartition(1).mapInArrow(learn, "model binary").first()
    return pickle.loads(fitted[0]) if fitted else Model([], [])


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``_score``. Row by row: nothing is shuffled. Null counts as empty; empty texts get the least score."""
    pickled = cloudpickle.dumps(model)
    name = f"toxicity-{hashlib.sha256(pickled).hexdigest()}"
    sent = docs.sparkSession.sparkContext.broadcast(pickled)
    out = docs.withColumn("_score", F.lit(0.0).cast("double"))
    position = docs.columns.index(text_col)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = once(name, lambda: pickle.loads(sent.value))
        reader = once(f"{name}-reader", fitted.reader) if fitted.landmarks else None
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                scores = fitted.scores(reader, words.encoded(part.column(position)))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(scores, pa.float64())], part.schema.names)

    return out.mapInArrow(rate, out.schema)


def keep_civil(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below 0.5, with the columns of ``docs``."""
    rows, names = sheltered(docs, "doc_id", "text")
    return score(rows, fit(rows, labels)).filter("_score < 0.5").select(*names).toDF(*docs.columns)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of those labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rated = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return rated.select(
        "doc_id", held_out().alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted")
    )
