"""Token sequences packed best fit, with a certified bound on what any packing needs.

Partitions pack on their own. Dual feasible functions bound a partition's sequences from below. Where
the bound is reached, the packing is proven best and closed. Partitions with a gap give up their
loosest sequences; these are dealt anew, packed together, and the better packing stays.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import common
from siltstone.llm.common import once, sent_whole, table
from siltstone.session import materialize

sent_whole(common.__name__)
sent_whole(__name__)

CAPACITY = 2048
#: Closes a document.
END_ID = 0
#: Pieces of one packing task, about.
GROUP_PIECES = 50_000
#: Times that partitions with a gap exchange documents.
ROUNDS = 4
#: Sequences that a partition gives up: all that are loose if no more than this, else the loosest.
GIVEN_UP = 4096
#: Texts of these characters only are cut alike by both tokenizer libraries, the faster of which is used then.
PLAIN = frozenset(map(chr, [*range(0x250), *range(0x2010, 0x2028), 0x2030, 0x20AC, 0x2122]))


class Tokenizer:
    """The byte-level BPE by ``tokenizers``; plain texts by ``tiktoken`` with the same vocabulary."""

    def __init__(self, vocabulary: str, ranks: bytes, pattern: str) -> None:
        import tiktoken
        import tokenizers

        self.exact = tokenizers.Tokenizer.from_str(vocabulary)
        self.exact.encode_special_tokens = True  # their strings in a text are ordinary text
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines())}
        self.fast = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if PLAIN.issuperset(text):
            return np.array(self.fast.encode_ordinary(text), dtype="<u4")
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype="<u4")


def cut(docs: DataFrame, vocabulary: str, ranks: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces (id, piece, start, length, ids_crc32[, ids]) of the documents' token ids, each document closed by id 0.

    Only a document longer than ``capacity`` is cut, into full pieces behind a first one that takes
    the rest. The vocabularies, files of a fixed size, are broadcast.
    """
    sent = docs.sparkSession.sparkContext.broadcast((open(vocabulary, encoding="utf-8").read(), open(ranks, "rb").read()))
    pattern = public_tokenizers.PATTERN
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = once("byte_bpe", lambda: Tokenizer(*sent.value, pattern))
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows, number, starts, sizes, sums, parts = [], [], [], [], [], []
                for row, text in enumerate(part.column(1)):
                    ids = np.append(tokenizer.ids(text.as_py() or ""), np.uint32(END_ID)).astype("<u4")
                    first = len(ids) % capacity or capacity
                    bounds = [0, *range(first, len(ids) + 1, capacity)]
                    for k, (start, stop) in enumerate(zip(bounds, bounds[1:], strict=False)):
                        rows.append(row)
                        number.append(k)
                        starts.append(start)
                        sizes.append(stop - start)
                        sums.append(zlib.crc32(ids[start:stop].tobytes()))
                        if with_ids:
                            parts.append(ids[start:stop].astype(np.int64))
                columns = [
                    part.column(0).take(pa.array(rows, pa.int64())), pa.array(number, pa.int32()), pa.array(starts, pa.int64()),
                    pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()),
                ] + ([pa.array(parts, pa.list_(pa.int64()))] if with_ids else [])
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in schema.split(", ")])

    return docs.select(id_col, text_col).mapInArrow(pieces, schema)


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Sequences that any packing needs, by the best of several dual feasible functions.

    Such a function maps lengths so that what fits one sequence still sums to one at most; the total
    is then a bound. Used: the identity, the thresholds (long pieces count whole, short ones nothing)
    and the step functions of order 1 to 20, alone and on top of the thresholds.
    """
    if not len(lengths):
        return 0
    size, count = np.unique(np.asarray(lengths, dtype=np.int64), return_counts=True)
    best = -(-int((size * count).sum()) // capacity)
    shapes = [size]
    for p in np.unique(size[size <= capacity // 2]):
        shape = np.where(size > capacity - p, capacity, np.where(size < p, 0, size))
        best = max(best, -(-int((shape * count).sum()) // capacity))
        if len(shapes) < 65 or p % 16 == 0:
            shapes.append(shape)
    for shape in shapes:
        for k in range(1, 21):
            whole = (k + 1) * shape
            stepped = np.where(whole % capacity == 0, k * shape, capacity * (whole // capacity))
            best = max(best, -(-int((stepped * count).sum()) // (k * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Best-fit decreasing: the sequence (from 0) of each piece. Equal lengths keep their order."""
    place = np.empty(len(lengths), dtype=np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]  # sequences by what is free in them
    free = 0  # bit r: some sequence has r left
    made = 0
    for item in np.argsort(-np.asarray(lengths), kind="stable"):
        size = int(lengths[item])
        fitting = free >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            sequence = open_at[left].pop()
            if not open_at[left]:
                free ^= 1 << left
        else:
            left, sequence = capacity, made
            made += 1
        place[item] = sequence
        if rest := left - size:
            open_at[rest].append(sequence)
            free |= 1 << rest
    return place


def _packer(number: int, last: bool, capacity: int):
    """Packs one group: closes what is proven best or well filled, and gives the loosest sequences up."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_pack_length", "_pack_row"], ascending=[False, True], ignore_index=True)
        group = int(pdf["_pack_group"].iloc[0])
        lengths = pdf["_pack_length"].to_numpy()
        place = best_fit(lengths, capacity)
        if number and place.max() + 1 >= pdf["_pack_bin"].nunique():
            place = pd.factorize(pdf["_pack_bin"])[0]
        made = int(place.max()) + 1
        used = np.bincount(place, weights=lengths).astype(np.int64)
        given = np.zeros(made, dtype=bool)
        if not last and made > lower_bound(lengths, capacity):
            loosest = np.argsort(used, kind="stable")[:GIVEN_UP]
            given[loosest[used[loosest] < capacity]] = True
        by = np.argsort(place, kind="stable")
        sizes, at = lengths[by], place[by]
        before = np.cumsum(sizes) - sizes
        offset = np.empty(len(by), dtype=np.int64)
        offset[by] = before - before[np.searchsorted(at, np.arange(made))][at]
        return pd.DataFrame({
            "_pack_row": pdf["_pack_row"], "_pack_length": lengths, "_pack_bin": place + (number << 56) + (group << 24), "offset": offset,
            "closed": ~given[place],
        })

    return pack


def packed(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` (with a column ``length``) plus sequence_id and offset.

    Full pieces stand alone. The others are dealt by their place in a written table, so that repeated
    rows and hot keys spread, to groups of about ``group_pieces``; a group is one task's work. A
    sequence is always dealt as a whole, so a group can keep its old packing if the new is no better.
    An empty table gives no rows.
    """
    columns = pieces.columns
    rows = materialize(pieces.withColumn("_pack_row", F.monotonically_increasing_id()), "pack-pieces")
    alone = rows.filter(F.col("length") >= capacity).select(
        *columns, (-F.col("_pack_row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    loose = rows.filter(F.col("length") < capacity).select("_pack_row", F.col("length").alias("_pack_length"))
    count = loose.count()
    done: DataFrame | None = None
    state = loose.withColumn("_pack_bin", F.col("_pack_row"))  # each piece by itself
    schema = "_pack_row bigint, _pack_length bigint, _pack_bin bigint, offset bigint, closed boolean"
    for number in range(rounds + 1):
        groups = max(1, -(-count // group_pieces))
        dealt = state.withColumn("_pack_group", F.pmod(F.xxhash64("_pack_bin", F.lit(number)), F.lit(groups)))
        state = materialize(dealt.groupBy("_pack_group").applyInPandas(_packer(number, number == rounds, capacity), schema), "pack-round")
        closed = state.filter("closed").select("_pack_row", F.col("_pack_bin").alias("sequence_id"), "offset")
        done = closed if done is None else done.unionByName(closed)
        state = state.filter("not closed").select("_pack_row", "_pack_length", "_pack_bin")
        count = state.count()
        if not count:
            break
    return rows.filter(F.col("length") < capacity).join(done, "_pack_row").select(*columns, "sequence_id", "offset").unionByName(alone)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): what is fed to training, from packed pieces that carry their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, vocabulary: str | None = None, ranks: str | None = None) -> DataFrame:
    """Pieces of all documents with their sequences.

    Null texts are empty and consist of the closing id. Null and repeated ids are kept as they are;
    extra columns are ignored. A text is tokenised whole, in one task.
    """
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    ranks = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
    return packed(cut(docs, vocabulary, ranks))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"))
