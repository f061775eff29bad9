"""Words of many UTF-8 texts at once, as 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are cut into words at once.
CHUNK = 1 << 21

BASE = np.uint64(0x9E3779B97F4A7C15)
_GENERATOR = np.random.Generator(np.random.PCG64(20240501))
BYTE_VALUE = _GENERATOR.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_VALUE[65:91] = BYTE_VALUE[97:123]  # A-Z as a-z

#: Bytes of words: all but blanks; or digits, Latin letters and all that is not ASCII.
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of UTF-8 bytes, and where each begins. A-Z count as a-z."""
    filled = kind[data]
    edge = np.diff(filled.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    sizes = ends - starts
    begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    inside = np.arange(int(sizes.sum())) - np.repeat(begins, sizes)
    value = BYTE_VALUE[data[filled]] * powers(int(sizes.max()))[inside]
    return mixed(np.add.reduceat(value, begins) + sizes.astype(np.uint64)), starts


def chunks(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end at blanks; a word longer than a part stays whole."""
    blanks = [bytes([b]) for b in np.flatnonzero(~NOT_BLANK)]
    at = 0
    while len(text) - at > CHUNK:
        cut = max(text.rfind(b, at, at + CHUNK) for b in blanks)
        if cut <= at:
            cut = min((p for b in blanks if (p := text.find(b, at + CHUNK)) >= 0), default=len(text))
        yield text[at:cut]
        at = cut
    yield text[at:]


def hashes_of_texts(texts: list[bytes], kind: np.ndarray) -> list[np.ndarray]:
    """The word hashes of each text, in order. Short texts are cut together, long ones in parts."""
    out: list[np.ndarray] = []
    at = 0
    with np.errstate(over="ignore"):
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size + len(texts[stop]) < CHUNK):
                size += len(texts[stop]) + 1
                stop += 1
            if stop == at + 1:
                out.append(np.concatenate([word_hashes(np.frombuffer(c, np.uint8), kind)[0] for c in chunks(texts[at])]))
            else:
                group = texts[at:stop]
                hashes, starts = word_hashes(np.frombuffer(b" ".join(group), np.uint8), kind)
                bounds = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in group]))
                out += [hashes[bounds[i] : bounds[i + 1]] for i in range(len(group))]
            at = stop
    return out


def encoded(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [x.as_py() or b"" for x in column.cast(pa.binary())]
