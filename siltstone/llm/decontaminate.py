"""Benchmark passages in training shards, found with an FM-index of each shard.

A shard's texts become symbols of the test vocabulary. Suffixes are sorted, the Burrows-Wheeler
transform goes into a wavelet matrix, test phrases are searched backwards by its ranks, occurrences
are located by sampled suffix positions, and their spans are merged per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import words
from siltstone.llm.common import sent_whole, sheltered, table

sent_whole(words.__name__)
sent_whole(__name__)

#: Words in a phrase.
WINDOW = 13
#: Bytes of text of one shard and index, at most; a longer document is a shard of its own.
SHARD_BYTES = 1 << 23
#: One suffix position in so many is sampled.
SAMPLE = 8
#: Bytes of test texts that are searched in one pass over the shards.
BLOCK_BYTES = 1 << 26


class Phrases:
    """The distinct phrases of a block of test items, as symbols of the block's vocabulary."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW) -> None:
        lists = words.hashes_of_texts([t for _, t in items], words.ALPHANUMERIC)
        self.vocabulary = np.unique(np.concatenate(lists)) if lists else np.empty(0, np.uint64)
        owners: dict[bytes, set[str]] = {}
        for (name, _), found in zip(items, lists, strict=True):
            symbols = (np.searchsorted(self.vocabulary, found) + 1).astype(np.int32)
            for at in range(max(1, len(symbols) - window + 1) if len(symbols) else 0):
                owners.setdefault(symbols[at : at + window].tobytes(), set()).add(name)
        phrases = [np.frombuffer(p, np.int32) for p in owners]
        self.owners = [sorted(names) for names in owners.values()]
        self.lengths = np.array([len(p) for p in phrases], dtype=np.int64)
        self.shortest = int(self.lengths.min()) if len(phrases) else 0
        # Right-aligned: column k is the symbol that the k-th step of the backward search takes.
        self.steps = np.zeros((len(phrases), window), dtype=np.int32)
        for i, p in enumerate(phrases):
            self.steps[i, : len(p)] = p[::-1]
        self.sieve = np.zeros(1 << 16, dtype=bool)
        self.sieve[(self.vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Symbols of document words; 0 for words that no test item has."""
        out = np.zeros(len(hashes), dtype=np.int32)
        may = np.flatnonzero(self.sieve[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.searchsorted(self.vocabulary, hashes[may])
        at[at == len(self.vocabulary)] = 0
        known = self.vocabulary[at] == hashes[may]
        out[may[known]] = at[known] + 1
        return out


class FMIndex:
    """An index of a symbol sequence in which 0 ends a segment; no phrase runs over a 0."""

    def __init__(self, text: np.ndarray, sigma: int) -> None:
        # Ends sort first and by place, so that every suffix is decided at its segment's end.
        n = len(text)
        ends = text == 0
        rank = text.astype(np.int64) + int(ends.sum())
        rank[ends] = np.arange(int(ends.sum()))
        order = np.argsort(rank, kind="stable")
        step = 1
        while True:
            ordered = rank[order]
            fresh = np.concatenate(([True], ordered[1:] != ordered[:-1]))
            # A suffix keeps the place of its group's first: groups of one are final.
            dense = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
            rank[order] = dense
            single = fresh & np.concatenate((fresh[1:], [True]))
            tied = order[~single]
            if not len(tied):
                break
            after = np.minimum(tied + step, n - 1)
            again = np.lexsort((rank[after], rank[tied]))
            order[~single] = tied[again]
            key = np.stack((rank[tied[again]], rank[after[again]]))
            change = np.concatenate(([True], (key[:, 1:] != key[:, :-1]).any(axis=0)))
            place = np.flatnonzero(~single)
            rank[tied[again]] = place[np.maximum.accumulate(np.where(change, np.arange(len(place)), 0))]
            step *= 2
        self.suffix, self.n = order, n
        before = np.where(order == 0, 0, text[order - 1])
        counts = np.bincount(text, minlength=sigma + 1)
        self.first = np.concatenate(([0], np.cumsum(counts)))
        self.bits = max(1, int(sigma).bit_length())
        self.levels: list[np.ndarray] = []
        self.zeros: list[int] = []
        row = before
        for level in range(self.bits - 1, -1, -1):
            bit = (row >> level) & 1
            ones = np.concatenate(([0], np.cumsum(bit, dtype=np.int32)))
            self.levels.append(ones)
            self.zeros.append(n - int(ones[-1]))
            row = np.concatenate((row[bit == 0], row[bit == 1]))
        starts = np.concatenate(([True], text[:-1] == 0))
        self.sampled = (order % SAMPLE == 0) | starts[order]
        self.samples = order[self.sampled]
        self.sample_rank = np.concatenate(([0], np.cumsum(self.sampled, dtype=np.int64)))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol is among the first ``at`` of the transform."""
        low = np.zeros_like(at)
        for level, ones, zeros in zip(range(self.bits - 1, -1, -1), self.levels, self.zeros, strict=True):
            one = (symbol >> level) & 1
            low = np.where(one, zeros + ones[low], low - ones[low])
            at = np.where(one, zeros + ones[at], at - ones[at])
        return at - low

    def step_back(self, row: np.ndarray) -> np.ndarray:
        """The rows of the suffixes that begin one symbol earlier."""
        at, low, symbol = row, np.zeros_like(row), np.zeros_like(row)
        for ones, zeros in zip(self.levels, self.zeros, strict=True):
            one = ones[at + 1] - ones[at]
            symbol = symbol * 2 + one
            low = np.where(one, zeros + ones[low], low - ones[low])
            at = np.where(one, zeros + ones[at], at - ones[at])
        return self.first[symbol] + at - low

    def search(self, steps: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows [low, high) of the suffixes that begin with each phrase."""
        low = np.zeros(len(steps), dtype=np.int64)
        high = np.full(len(steps), self.n, dtype=np.int64)
        live = np.arange(len(steps))
        for k in range(steps.shape[1]):
            live = live[(lengths[live] > k) & (low[live] < high[live])]
            if not len(live):
                break
            symbol = steps[live, k].astype(np.int64)
            low[live] = self.first[symbol] + self.rank(symbol, low[live])
            high[live] = self.first[symbol] + self.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: back to the next sampled one."""
        row = row.copy()
        steps = np.zeros(len(row), dtype=np.int64)
        todo = np.flatnonzero(~self.sampled[row])
        while len(todo):
            row[todo] = self.step_back(row[todo])
            steps[todo] += 1
            todo = todo[~self.sampled[row[todo]]]
        return self.samples[self.sample_rank[row]] + steps


def occurrences(found: list[np.ndarray], phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, phrase) of every occurrence in a shard of word hashes.

    Words without a symbol cut the shard into segments; one shorter than the shortest phrase cannot
    hold any and is not indexed.
    """
    none = np.empty(0, dtype=np.int64)
    sizes = np.array([len(f) for f in found], dtype=np.int64)
    symbols = np.zeros(int(sizes.sum()) + len(found), dtype=np.int32)  # an end behind each document
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    for f, at in zip(found, starts, strict=True):
        symbols[at : at + len(f)] = phrases.symbols(f)
    edge = np.diff((symbols > 0).astype(np.int8), prepend=0)
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = ends - begins >= max(1, phrases.shortest)
    if not phrases.shortest or not long.any():
        return none, none, none
    begins, ends = begins[long], ends[long] + 1  # each with its end
    lengths = ends - begins
    total = np.cumsum(lengths)
    origin = np.repeat(begins - (total - lengths), lengths) + np.arange(int(total[-1]))
    index = FMIndex(symbols[origin], len(phrases.vocabulary))
    low, high = index.search(phrases.steps, phrases.lengths)
    hit = np.flatnonzero(high > low)
    count = (high - low)[hit]
    if not len(hit):
        return none, none, none
    rows = np.repeat(low[hit] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    at = origin[index.locate(rows)]
    document = np.searchsorted(starts, at, side="right") - 1
    return document, at - starts[document], np.repeat(hit, count)


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a task in pieces that one index takes."""
    for batch in batches:
        size = np.array([len(t) for t in words.encoded(batch.column("_text"))])
        at = 0
        while at < batch.num_rows:
            stop = at + max(1, int(np.searchsorted(np.cumsum(size[at:]), SHARD_BYTES, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


def merged(starts: np.ndarray, stops: np.ndarray) -> list[dict[str, int]]:
    """Overlapping and touching spans as one."""
    order = np.argsort(starts, kind="stable")
    out: list[dict[str, int]] = []
    for a, b in zip(starts[order].tolist(), stops[order].tolist(), strict=True):
        if out and a <= out[-1]["stop"]:
            out[-1]["stop"] = max(out[-1]["stop"], b)
        else:
            out.append({"start": a, "stop": b})
    return out


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> list[list[tuple[str, bytes]]]:
    """Test items in blocks of bounded size, each brought to the driver by its own read."""
    named = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    number = 1 + total // block_bytes
    out = []
    for k in range(number):
        part = named if number == 1 else named.filter(F.pmod(F.xxhash64("id", "text"), F.lit(number)) == k)
        out.append([(r["id"], r["text"].encode()) for r in part.distinct().collect()])
    return out


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` plus ``_n_words``, ``_spans`` (merged word spans inside test phrases) and ``_items`` (their item ids).

    Documents stay where they are: nothing is shuffled. Test items come in blocks of at most
    ``block_bytes`` or one item; each block is one more pass inside the same task. Null texts and
    texts without words match nothing. Equal items are searched once and all named; a null item id is
    named by the empty text. Empty tables give no rows, or no spans.
    """
    context = docs.sparkSession.sparkContext
    out = docs.withColumns({
        "_text": F.col(text_col), "_n_words": F.lit(0).cast("long"),
        "_spans": F.array().cast("array<struct<start:bigint,stop:bigint>>"), "_items": F.array().cast("array<string>"),
    })
    schema = out.schema
    for block in blocks(benchmark, item_col, item_text, block_bytes):
        sent = context.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            phrases = Phrases(sent.value, window)
            for shard in shards(batches):
                found = words.hashes_of_texts(words.encoded(shard.column("_text")), phrases_kind)
                spans, items = shard.column("_spans").to_pylist(), shard.column("_items").to_pylist()
                document, start, phrase = occurrences(found, phrases)
                order = np.argsort(document, kind="stable")
                document, start, phrase = document[order], start[order], phrase[order]
                edges = np.flatnonzero(np.diff(document, prepend=-1, append=-1))
                for a, b in zip(edges, edges[1:], strict=False):
                    row = int(document[a])
                    olds = np.array([[s["start"], s["stop"]] for s in spans[row]], dtype=np.int64).reshape(-1, 2)
                    first = np.concatenate((olds[:, 0], start[a:b]))
                    spans[row] = merged(first, np.concatenate((olds[:, 1], start[a:b] + phrases.lengths[phrase[a:b]])))
                    items[row] = sorted(set(items[row]).union(*(phrases.owners[p] for p in np.unique(phrase[a:b]))))
                columns = dict(zip(shard.schema.names, shard.columns, strict=True))
                columns["_n_words"] = pa.array([len(f) for f in found], pa.int64())
                columns["_spans"], columns["_items"] = pa.array(spans, SPANS), pa.array(items, pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

        phrases_kind = words.ALPHANUMERIC
        out = out.mapInArrow(search, schema)
    return out.drop("_text")


def contaminated(n_words: Column, n_hit: Column) -> Column:
    """A twentieth of the words or more stand in test phrases."""
    return (n_hit > 0) & (F.lit(20) * n_hit >= n_words)


def n_hit() -> Column:
    return F.aggregate("_spans", F.lit(0).cast("long"), lambda total, s: total + s["stop"] - s["start"])


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with the columns of ``docs``."""
    rows, names = sheltered(docs, "text")
    marked = find_leaks(rows, benchmark)
    return marked.filter(~contaminated(F.col("_n_words"), n_hit())).select(*names).toDF(*docs.columns)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in test phrases, and the items they come from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = find_leaks(docs, table(spark, sf_dir, "benchmark")).withColumn("n_hit", n_hit())
    return marked.select(
        "doc_id", F.col("_n_words").alias("n_words"), "n_hit", F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
        contaminated(F.col("_n_words"), F.col("n_hit")).alias("contaminated"),
    )


def leaks_sql(source: str = "documents") -> str:
    """DuckDB: common table expressions that end in ``leaks``."""
    word = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
item_words as (
    select item_id, regexp_extract_all({lower}, '{word}') as w from benchmark
), phrases as (
    select distinct item_id, least(len(w), {WINDOW}) as size, array_to_string(w[p:p + {WINDOW - 1}], ' ') as phrase
    from (select item_id, w, unnest(range(1, greatest(len(w) - {WINDOW - 2}, 2))) as p from item_words where len(w) > 0)
), doc_words as (
    select doc_id, regexp_extract_all({lower}, '{word}') as w from {source}
), doc_phrases as (
    select doc_id, p, size, array_to_string(w[p:p + size - 1], ' ') as phrase
    from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as p from doc_words, (select distinct size from phrases) where len(w) >= size)
), found as (
    select d.doc_id, d.p, d.size, i.item_id from doc_phrases d join phrases i on d.size = i.size and d.phrase = i.phrase
), hits as (
    select doc_id, count(distinct p + o) as n_hit from found, range(0, {WINDOW}) r(o) where o < size group by doc_id
), items as (
    select doc_id, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as names
    from (select distinct doc_id, item_id from found) group by doc_id
), leaks as (
    select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
        sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
    from doc_words left join hits using (doc_id) left join items using (doc_id)
)"""


OP8_SQL = f"with {leaks_sql()} select * from leaks"
