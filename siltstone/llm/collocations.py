"""Collocations from a weighted de Bruijn graph of word grams.

Every word begins one edge of the graph: the longest gram from it, of five words or of those that its
piece still has. Edges of equal words are added up. The frequency of a shorter phrase is the flow
through its node: all edges that begin with it, those that a piece's end cut short included. A node
whose whole flow enters or leaves by one edge lies on a unary path and is compacted into that edge;
what is left are the path's ends, whose cuts are scored.

A phrase can only be frequent if all that it begins with is. A first pass counts the grams of every
size in a table of fixed size, by hash and saturating, and in the second pass an edge ends where its
counter stays below the least frequency: no frequent flow goes on from there. Counters are shared, so a
rare edge may pass; it costs a row and changes no result. The table is all that is ever broadcast, and
its size is a parameter.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.llm import words
from siltstone.llm.common import once, sent_whole, table
from siltstone.session import configure, materialize

sent_whole(words.__name__)
sent_whole(__name__)

LONGEST = 5
LEAST = 100
TOP = 2000
UNKNOWN = "und"
#: The table of counters has two to the power of this many; each is a byte.
COUNTER_BITS = 25
#: Counters that travel in one row.
PART = 1 << 13
MOST = 255
#: Bytes of text whose edges are found at once; what they have in common is added up by Spark, before the shuffle.
BUFFER = 1 << 18

BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, 0x09]] = True
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
WORD = ~BLANK & ~SEPARATOR
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] = LOWER[97:123]
_BLANK_AT = re.compile(rb"[ \t]")
_NEXT_WORDS = re.compile(rb"(?:[ \t]*[^ \t]+){0,%d}" % LONGEST)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def buffers(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(bytes, first byte of each text, number of the first text) of many short texts, or of a part of a long one.

    A long text is cut at blanks. The words after a cut follow in the buffer, so that grams across it
    are seen, and its ``first byte`` list then ends with the cut: words from there on begin no gram.
    """
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and size + len(texts[stop]) < BUFFER:
            size += len(texts[stop]) + 1
            stop += 1
        if stop > at:
            data = np.frombuffer(b"\n".join(texts[at:stop]) + b"\n", np.uint8)
            yield LOWER[data], np.cumsum([0] + [len(t) + 1 for t in texts[at:stop]]), at
        else:
            text, begin = texts[at], 0
            while begin < len(text):
                blank = _BLANK_AT.search(text, begin + BUFFER)
                cut = blank.start() if blank else len(text)
                end = _NEXT_WORDS.match(text, cut).end()
                yield LOWER[np.frombuffer(text, np.uint8, end - begin, begin)], np.array([0, cut - begin]), at
                begin = cut
            stop = at + 1
        at = stop


class Found:
    """The words of a buffer: place, language, hash by language, and whether the next one is in the same piece."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, langs: np.ndarray, marks: np.ndarray) -> None:
        hashes, self.starts = words.word_hashes(data, WORD)
        self.ends = np.flatnonzero(np.diff(WORD[data].astype(np.int8), prepend=0, append=0) == -1)
        text = np.searchsorted(bounds, self.starts, side="right") - 1
        self.own = text < len(bounds) - 1  # the others only complete the grams of those before them
        self.lang = langs[np.minimum(text, len(bounds) - 2)]
        self.hashes = words.mixed(hashes ^ marks[self.lang])
        breaks = np.concatenate(([0], np.cumsum(SEPARATOR[data])))
        self.linked = np.zeros(len(self.starts), dtype=bool)
        self.linked[:-1] = breaks[self.starts[1:]] == breaks[self.ends[:-1]]

    def grams(self, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of each size from 1: the hash of the gram at each word, and whether its piece has so many words."""
        hashes, inside = self.hashes, np.ones(len(self.hashes), dtype=bool)
        yield hashes, inside
        link = self.linked
        for k in range(1, longest):
            inside = inside & link
            link = np.append(link[1:], False)
            hashes = words.mixed(hashes * _STEP + np.append(self.hashes[k:], np.zeros(min(k, len(hashes)), np.uint64)))
            yield hashes, inside


def found_words(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, Found, list[str]]]:
    """Bytes and words of the (language, text) rows of a batch, in buffers."""
    langs = batch.column(0).fill_null(UNKNOWN).dictionary_encode()
    names = langs.dictionary.to_pylist()
    codes = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    marks = np.array([int.from_bytes(name.encode()[:64], "little") % (1 << 61) + 1 for name in names] or [0], np.uint64)
    with np.errstate(over="ignore"):
        marks = words.mixed(marks * words.BASE + np.array([zlib.crc32(name.encode()) for name in names] or [0], np.uint64))
        for data, bounds, first in buffers(words.encoded(batch.column(1))):
            found = Found(data, bounds, codes[first : first + len(bounds) - 1], marks)
            if len(found.starts):
                yield data, found, names


def frequent_bits(rows: DataFrame, least: int, bits: int, longest: int) -> bytes:
    """One bit for each counter: whether the grams that share it may be frequent.

    Each task adds up a table of its own; the tables are merged part by part, as a stream, so that no
    task ever holds more than its parts. The result has 2 ** bits bits, whatever the input.
    """
    limit = min(least, MOST)
    shift = np.uint64(64 - bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << bits, np.uint8)
        for batch in batches:
            with np.errstate(over="ignore"):
                for _, found, _ in found_words(batch):
                    cells = np.concatenate([hashes[found.own & inside] for hashes, inside in found.grams(longest)]) >> shift
                    cell, many = np.unique(cells, return_counts=True)
                    cell = cell.astype(np.int64)
                    counters[cell] = np.minimum(counters[cell] + many, MOST)
        for at in range(0, len(counters), PART * 256):
            parts = [i for i in range(at, min(at + PART * 256, len(counters)), PART) if counters[i : i + PART].any()]
            packed = [zlib.compress(counters[i : i + PART].tobytes(), 1) for i in parts]
            yield pa.RecordBatch.from_arrays([pa.array([i // PART for i in parts], pa.int32()), pa.array(packed, pa.binary())], ["part", "counts"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts = np.frombuffer(zlib.decompress(packed.as_py()), np.uint8).astype(np.uint16)
                sums[part] = np.minimum(sums[part] + counts, MOST) if part in sums else counts
        bitmaps = [np.packbits(s >= limit).tobytes() for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(bitmaps, pa.binary())], ["part", "bits"])

    counted = rows.mapInArrow(count, "part int, counts binary")
    merged = counted.repartition("part").mapInArrow(merge, "part int, bits binary")
    out = bytearray((1 << bits) // 8)
    size = min(PART, 1 << bits) // 8
    for part, bitmap in merged.collect():  # 2 ** bits bits at most
        out[part * size : part * size + len(bitmap)] = bitmap
    return bytes(out)


def lengths(found: Found, frequent: np.ndarray, shift: np.uint64, longest: int) -> np.ndarray:
    """Words of the edge that begins at each word: as many as may be frequent together; 0 for a word that is rare itself."""
    size = np.zeros(len(found.hashes), np.int64)
    for k, (hashes, inside) in enumerate(found.grams(longest)):
        cell = (hashes >> shift).astype(np.int64)
        may = frequent[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1
        size += inside & (size == k) & may.astype(bool)
    return size


def edges_of(found: Found, size: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(word that an edge begins at, how often the same edge occurs) of the distinct edges of a buffer."""
    at = np.flatnonzero(found.own)
    size = size[at]
    key = words.mixed(size.astype(np.uint64) * _STEP + words.BYTE_VALUE[found.lang[at] & 255] + found.lang[at].astype(np.uint64))
    tail = np.zeros((longest, len(at)), np.uint64)
    for k in range(longest):
        inside = size > k
        tail[k, inside] = found.hashes[at[inside] + k]
        key = words.mixed(key * _STEP + tail[k])
    _, first, back, many = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    same = (tail == tail[:, first[back]]).all(axis=0) & (size == size[first[back]]) & (found.lang[at] == found.lang[at[first[back]]])
    if same.all():
        return at[first], many
    # Edges that share a key without being equal stand alone.
    return np.concatenate((at[first], at[~same])), np.concatenate((many - np.bincount(back[~same], minlength=len(many)), np.ones((~same).sum(), np.int64)))


def phrases_at(data: np.ndarray, found: Found, at: np.ndarray, size: np.ndarray) -> pa.Array:
    """The words from each place on, joined by single blanks."""
    size = size[at]
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    word = np.repeat(at, size) + inside
    length = found.ends[word] - found.starts[word]
    room = length + (inside < np.repeat(size, size) - 1)
    place = np.arange(int(room.sum())) - np.repeat(np.cumsum(room) - room, room)
    source = np.repeat(found.starts[word], room) + place
    joined = data[np.minimum(source, len(data) - 1)] if len(source) else np.empty(0, np.uint8)
    joined[place == np.repeat(length, room)] = 0x20
    total = np.concatenate(([0], np.cumsum(room)))
    offsets = total[np.concatenate(([0], np.cumsum(size)))]
    return pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(joined)]).cast(pa.string())


def edges(rows: DataFrame, bits: bytes, longest: int) -> DataFrame:
    """The weighted edges: (lang, phrase, size, n), n being how often a word begins this edge.

    Words that are rare themselves are edges of size 0, which only count towards a language's words.
    """
    sent = rows.sparkSession.sparkContext.broadcast(bits)
    name = f"collocations-{zlib.crc32(bits)}-{len(bits)}"
    shift = np.uint64(64 - (len(bits) * 8).bit_length() + 1)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = once(name, lambda: np.frombuffer(sent.value, np.uint8))
        for batch in batches:
            with np.errstate(over="ignore"):
                for data, found, names in found_words(batch):
                    size = lengths(found, frequent, shift, longest)
                    at, many = edges_of(found, size, longest)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(names, pa.string()).take(pa.array(found.lang[at])),
                            phrases_at(data, found, at, size),
                            pa.array(size[at], pa.int32()),
                            pa.array(many, pa.int64()),
                        ],
                        ["lang", "phrase", "size", "n"],
                    )

    read_edges = rows.mapInArrow(read, "lang string, phrase string, size int, n long")
    return read_edges.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))


def _words(first: Column | int, size: Column | int) -> Column:
    return F.array_join(F.slice("__words", first, size), " ")


def flows(weighted: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, size, f) of all frequent nodes, and of each language's empty phrase, whose flow is all its words.

    What leaves a node are the edges that go on, and what ends in it the edges that stop there.
    """
    # Each edge adds its weight to every node that it begins with.
    begun = weighted.withColumn("__words", F.split("phrase", " ")).select(
        "lang", F.posexplode(F.transform(F.sequence(F.lit(0), "size"), lambda k: _words(F.lit(1), k))).alias("size", "phrase"), "n"
    )
    return begun.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("f")).where((F.col("size") == 0) | (F.col("f") >= least))


def path_ends(nodes: DataFrame) -> DataFrame:
    """The nodes of two words or more that lie inside no unary path: no longer one carries all their flow.

    A longer phrase with all of a node's flow leads there over phrases one word longer, each with the
    same flow; so it is enough to look at edges by one word, before or after.
    """
    several = nodes.where("size >= 2").select("lang", "phrase", "size", "f")
    through = several.where("size >= 3").withColumn("__words", F.split("phrase", " "))
    shorter = through.select(
        "lang",
        F.explode(F.array(_words(F.lit(1), F.col("size") - 1), _words(F.lit(2), F.col("size") - 1))).alias("phrase"),
        (F.col("size") - 1).alias("size"),
        F.lit(None).cast("long").alias("f"),
        F.col("f").alias("carried"),
    )
    both = several.withColumn("carried", F.lit(0).cast("long")).unionByName(shorter)
    whole = both.groupBy("lang", "phrase", "size").agg(F.max("f").alias("f"), F.max("carried").alias("carried"))
    return whole.where("carried < f").drop("carried")


def scored(ends: DataFrame, nodes: DataFrame, totals: DataFrame) -> DataFrame:
    """Each phrase with its lowest-scoring cut; of equal ones, that after the fewest words."""
    cuts = ends.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).withColumn("__words", F.split("phrase", " "))
    cuts = cuts.withColumn("before", _words(F.lit(1), F.col("cut"))).withColumn("after", _words(F.col("cut") + 1, F.col("size") - F.col("cut")))
    parts = nodes.where("size >= 1")
    left = parts.select("lang", F.col("phrase").alias("before"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("after"), F.col("f").alias("r"))
    met = cuts.drop("__words").withColumnRenamed("f", "a").join(left, ["lang", "before"]).join(right, ["lang", "after"]).join(totals, "lang")
    # Decimals of 38 digits hold these products; ``div`` cuts off what is behind the point.
    exact = lambda c: f"cast({c} as decimal(19, 0))"
    score = F.expr(f"(cast(1000 as decimal(4, 0)) * {exact('a')} * {exact('n')}) div ({exact('l')} * {exact('r')})")
    best = F.min(F.struct(score.alias("score"), "cut", "l", "r"))
    return met.groupBy("lang", "phrase", "a", "n").agg(best.alias("b")).select("lang", "phrase", "a", "b.l", "b.r", "n", "b.score", "b.cut")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST,
    top: int = TOP,
    counter_bits: int = COUNTER_BITS,
) -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score, cut.

    Null and empty texts have no words; a null language is ``und``; repeated rows count as often as
    they occur; an empty table gives no rows; other columns are not read. Long texts are read in
    parts, with the words after each part, so that no gram is lost. Equal scores are ranked by
    frequency, then by the phrase's bytes.
    """
    rows = docs.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").alias("text")).where("text is not null")
    bits = frequent_bits(rows, least, counter_bits, longest)
    nodes = materialize(flows(edges(rows, bits, longest), least), "collocation-nodes")
    # Written, so that Spark knows its size and that of the frequent nodes when it joins them.
    totals = materialize(nodes.where("size = 0").select("lang", F.col("f").alias("n")), "collocation-totals")
    ends = materialize(path_ends(nodes), "collocation-ends")
    ranked = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored(ends, nodes, totals).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", F.col("cut").cast("long").alias("cut"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collocations of all documents, by language."""
    configure(spark)
    return collocations(table(spark, sf_dir, "documents")).drop("cut")


OP13_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
grams AS MATERIALIZED (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM places, (VALUES (1), (2), (3), (4), (5)) AS sizes(k)
  WHERE i + k - 1 <= len(w) GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE k >= 2 AND f >= 100),
inner_phrases AS (
  SELECT c.lang, array_to_string(c.w[i:i + s - 1], ' ') AS phrase, max(c.a) AS most
  FROM candidates c, (VALUES (1), (2), (3), (4)) AS firsts(i), (VALUES (2), (3), (4)) AS sizes(s)
  WHERE s < c.k AND i + s - 1 <= c.k GROUP BY 1, 2),
kept AS (
  SELECT c.* FROM candidates c LEFT JOIN inner_phrases o ON o.lang = c.lang AND o.phrase = c.phrase
  WHERE o.most IS NULL OR 100 * o.most < 100 * c.a),
sides AS (
  SELECT c.lang, c.phrase, c.a, s.cut, array_to_string(c.w[1:s.cut], ' ') AS before,
         array_to_string(c.w[s.cut + 1:c.k], ' ') AS after
  FROM kept c, (VALUES (1), (2), (3), (4)) AS s(cut) WHERE s.cut < c.k),
parts AS MATERIALIZED (SELECT lang, phrase, f FROM grams WHERE f >= 100),
cuts AS (
  SELECT s.lang, s.phrase, s.a, t.n, s.cut, l.f AS l, r.f AS r,
         ((1000::HUGEINT * s.a * t.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM sides s
  JOIN parts l ON l.lang = s.lang AND l.phrase = s.before
  JOIN parts r ON r.lang = s.lang AND r.phrase = s.after
  JOIN totals t ON t.lang = s.lang),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score
FROM lowest QUALIFY rank <= 2000
"""
