"""Near-duplicates by min-max hashing: each permutation gives its minimum and its maximum.

A signature of 2k values costs k hash evaluations per shingle. Bands of the signature give candidates;
every link is confirmed on the full shingle sets; links give components.

Texts with equal sets form one class, and only classes are compared. A band's bucket is not expanded
into pairs: its members meet two of them first. Where members are then still in different components, all
of the bucket are compared in blocks. So thousands of copies of one text cost a few comparisons each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import words
from siltstone.llm.common import sent_whole, sheltered, table
from siltstone.llm.words import BASE, mixed
from siltstone.session import materialize

sent_whole(words.__name__)
sent_whole(__name__)

#: Words in a shingle, and the least similarity in percent.
SHINGLE, PERCENT = 3, 85
#: Members of a bucket that are compared with as many others at once.
BLOCK = 256
#: Bands of rows: at a similarity of 0.85 a pair shares no band with a chance of (1 - 0.85^4)^24 = 2e-8.
BANDS, ROWS = 24, 4

_GENERATOR = np.random.Generator(np.random.PCG64(20240502))
FACTORS = _GENERATOR.integers(1, 1 << 63, BANDS * ROWS // 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _GENERATOR.integers(0, 1 << 63, BANDS * ROWS // 2, dtype=np.uint64)


def shingles_of_words(found: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer words than a shingle are one shingle, none give none."""
    n = len(found)
    if n == 0:
        return found
    if n < SHINGLE:
        total = np.uint64(n)
        for w in found:
            total = mixed(np.array([total * BASE + w], dtype=np.uint64))[0]
        return np.array([total], dtype=np.uint64)
    total = found[: n - SHINGLE + 1].copy()
    for k in range(1, SHINGLE):
        total = mixed(total) + found[k : n - SHINGLE + 1 + k]
    return np.unique(mixed(total))


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The set of each text."""
    with np.errstate(over="ignore"):
        return [shingles_of_words(w) for w in words.hashes_of_texts(texts, words.NOT_BLANK)]


def signature(found: np.ndarray) -> np.ndarray:
    """Minimum and maximum under each permutation."""
    low = np.full(len(FACTORS), np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(len(FACTORS), np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(found), 4096):
            values = np.multiply.outer(FACTORS, found[at : at + 4096]) + SHIFTS[:, None]
            low = np.minimum(low, values.min(axis=1))
            high = np.maximum(high, values.max(axis=1))
    return np.concatenate((low, high))


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key per band. A band takes minima or maxima of different permutations."""
    rows = values.reshape(BANDS, ROWS)
    with np.errstate(over="ignore"):
        key = np.arange(1, BANDS + 1, dtype=np.uint64)
        for k in range(ROWS):
            key = mixed(key * BASE + rows[:, k])
    return key.view(np.int64)


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_key, n_shingles, digest of the set, bands) of every document; no bands for empty sets."""
    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("text_key"), F.col(text_col).alias("text"))
    schema = f"id {kind}, text_key bigint, n_shingles bigint, digest binary, bands array<bigint>"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = shingle_sets(words.encoded(part.column(2)))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                        pa.array([band_keys(signature(s)) if len(s) else np.empty(0, np.int64) for s in sets], pa.list_(pa.int64())),
                    ],
                    ["id", "text_key", "n_shingles", "digest", "bands"],
                )

    return picked.mapInArrow(sign, schema)


def texts_of(nodes: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, text) of the named classes only."""
    named = classes.join(nodes.select("node").distinct(), "node", "left_semi").select("node", "id", "text_key")
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("text_key"), F.col(text_col).alias("text"))
    return keyed.join(named, ["id", "text_key"]).dropDuplicates(["node"]).select("node", "text")


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are similar enough.

    Only texts of classes that occur in pairs are moved. A class of many pairs is one side of the
    joins once, so that Spark can split the other.
    """
    pairs = materialize(pairs, "minmax-pairs")
    texts = materialize(texts_of(pairs.select(F.explode(F.array("a", "b")).alias("node")), classes, docs, id_col, text_col), "minmax-texts")
    with_texts = (
        pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[int, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                a, b = part.column(0).to_pylist(), part.column(1).to_pylist()
                texts_of: dict[int, int] = {}
                column = {}
                for side, nodes in ((2, a), (3, b)):
                    for row, node in enumerate(nodes):
                        if node not in last and node not in texts_of:
                            texts_of[node] = len(texts_of)
                            column[node] = part.column(side)[row].as_py().encode()
                last |= dict(zip(column, shingle_sets(list(column.values())), strict=True))
                kept = []
                for x, y in zip(a, b, strict=True):
                    one, two = last[x], last[y]
                    both = len(np.intersect1d(one, two, assume_unique=True))
                    kept.append(100 * both >= percent * (len(one) + len(two) - both))
                yield part.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))
                last = {n: last[n] for n in b[-1:]}  # the next rows mostly share the last class

    return materialize(with_texts.mapInArrow(compare, "a bigint, b bigint"), "minmax-links")


def short_sets(texts: DataFrame) -> DataFrame:
    """(node, tokens, lost): sets as sorted 32-bit values, and how many of the set two of them share."""

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = shingle_sets(words.encoded(part.column(1)))
                short = [np.unique((x >> np.uint64(32)).astype(np.uint32)) for x in sets]
                lost = [len(x) - len(y) for x, y in zip(sets, short, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([y.tobytes() for y in short], pa.binary()), pa.array(lost, pa.int64())], ["node", "tokens", "lost"]
                )

    return texts.mapInArrow(shorten, "node bigint, tokens binary, lost bigint")


def matrix(sets: list[np.ndarray], common: np.ndarray) -> np.ndarray:
    """Which of the common tokens each set has, as ones and zeros."""
    out = np.zeros((len(sets), len(common)), dtype=np.float32)
    for row, found in enumerate(sets):
        out[row, np.searchsorted(common, found[np.isin(found, common, assume_unique=True)])] = 1
    return out


def pairs_of_blocks(apart: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of one bucket and different roots that may be similar enough.

    A bucket's members are dealt to blocks. Blocks meet blocks, and one product of two small matrices
    gives all intersections of two blocks; a bucket of m members makes (m / BLOCK)^2 rows. Sets are
    cut to 32 bits here, with the values that this may hide added, so no pair is missed.
    """
    sizes = apart.groupBy("band").agg(F.count("*").alias("m"))
    members = (
        apart.join(sizes, "band").join(sets, "node")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.ceil(F.col("m") / F.lit(BLOCK))))
        .groupBy("band", "block")
        .agg(
            F.collect_list(F.struct("node", "root", "n", "lost", "tokens")).alias("members"),
            F.max(F.col("root") != F.col("top")).alias("apart"),
        )
    )
    members = materialize(members, "minmax-blocks")
    left = members.filter("apart").select("band", F.col("block").alias("x"), F.col("members").alias("left"))
    right = members.select("band", F.col("block").alias("y"), F.col("apart").alias("both"), F.col("members").alias("right"))
    met = left.join(right, "band").filter("not both or x <= y").select("left", "right")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                sides = [batch.column(k)[row].as_py() for k in (0, 1)]
                sets = [[np.frombuffer(x["tokens"], np.uint32) for x in side] for side in sides]
                node, root, n, lost = (
                    [np.array([x[name] for x in side], dtype=np.int64) for side in sides] for name in ("node", "root", "n", "lost")
                )
                common = np.intersect1d(np.concatenate(sets[0]), np.concatenate(sets[1]))
                both = np.zeros((len(sets[0]), len(sets[1])))
                for at in range(0, len(common), 1 << 14):
                    part = common[at : at + (1 << 14)]
                    both += matrix(sets[0], part) @ matrix(sets[1], part).T
                both += np.minimum(lost[0][:, None], lost[1][None, :])
                union = n[0][:, None] + n[1][None, :] - both
                x, y = np.nonzero((100 * both >= percent * union) & (root[0][:, None] != root[1][None, :]))
                a, b = node[0][x], node[1][y]
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"])

    return met.mapInArrow(meet, "a bigint, b bigint").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component, for nodes that have links.

    Alternates large and small stars; every round is written to the shared folder. Minima are found by
    aggregation and joined back, so that no node's neighbours meet in one place.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "component-edges")
    mark = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = materialize(large, "component-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
            .union(least.select("u", F.col("m").alias("v"))).distinct()
        )
        edges = materialize(small, "component-edges")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now


def in_components(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """(id, text_key, n_shingles, first) of every row; ``first`` is its component's smallest (id, text_key), null without a component."""
    signed = materialize(signatures(docs, id_col, text_col), "minmax-signatures")
    classes = materialize(
        signed.filter("n_shingles > 0 and id is not null").groupBy("digest")
        .agg(F.min(F.struct("id", "text_key")).alias("first"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
        .select(F.xxhash64("digest").alias("node"), "digest", F.col("first.id").alias("id"), F.col("first.text_key").alias("text_key"), "n", "bands"),
        "minmax-classes",
    )
    banded = classes.select("node", "n", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min(F.struct("node", "n")).alias("low"), F.max(F.struct("node", "n")).alias("high")).filter("low.node <> high.node")
    shared = materialize(banded.join(buckets, "band").select("band", "node", "n", "low", "high"), "minmax-buckets")

    def fits(a: str, b: str) -> F.Column:
        return F.lit(100) * F.least(a, b) >= F.lit(percent) * F.greatest(a, b)

    first = (
        shared.select("node", "n", F.explode(F.array("low", "high")).alias("p"))
        .filter((F.col("p.node") != F.col("node")) & fits("n", "p.n"))
        .select(F.greatest("node", "p.node").alias("a"), F.least("node", "p.node").alias("b"))
        .distinct()
    )
    links = confirmed(first, classes, docs, id_col, text_col, percent)
    roots = components(links)

    # Buckets whose members are still apart: blocks with members outside the largest component meet all.
    placed = shared.select("band", "node", "n").join(roots, "node", "left").select("band", "node", "n", F.coalesce("root", "node").alias("root"))
    split = placed.groupBy("band", "root").agg(F.count("*").alias("members"))
    largest = (
        split.groupBy("band").agg(F.max(F.struct("members", "root")).alias("top"), F.count("*").alias("parts"))
        .filter("parts > 1").select("band", F.col("top.root").alias("top"))
    )
    apart = materialize(placed.join(largest, "band").select("band", "node", "n", "root", "top"), "minmax-apart")
    sets = materialize(short_sets(texts_of(apart, classes, docs, id_col, text_col)), "minmax-sets")
    rest = pairs_of_blocks(apart, sets, percent)
    more = confirmed(rest, classes, docs, id_col, text_col, percent)
    if not more.isEmpty():
        roots = components(links.union(more))

    rooted = classes.join(roots, "node", "left").select("digest", "id", "text_key", F.coalesce("root", "node").alias("root"))
    rooted = materialize(rooted, "minmax-roots")
    smallest = rooted.groupBy("root").agg(F.min(F.struct("id", "text_key")).alias("first"))
    of_class = rooted.join(smallest, "root").select("digest", "first")
    told = signed.select("id", "text_key", "n_shingles", "digest").join(of_class, "digest", "left")
    return told.select("id", "text_key", "n_shingles", F.when((F.col("n_shingles") > 0) & F.col("id").isNotNull(), F.col("first")).alias("first"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row.

    The component's id is its smallest id. Texts without words have no shingles and no links. A null
    id has no place in the order: such a row is linked with nothing, keeps itself, and has no
    component id. Rows that repeat an id with another text are documents of their own that share it.
    Extra columns are ignored; an empty table gives no rows.
    """
    component = F.coalesce("first.id", "id")
    return in_components(docs, id_col, text_col, percent).select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, with the columns of ``docs``; a repeated row stays once.

    A document is an id with a text: other texts of its id stay or go by their own components.
    """
    rows, names = sheltered(docs, "doc_id", "text")
    told = in_components(rows, "doc_id", "text", PERCENT)
    other = (F.col("id") != F.col("first.id")) | (F.col("text_key") != F.col("first.text_key"))
    gone = told.filter(other).select(F.col("id").alias("doc_id"), F.col("text_key").alias("_text_key")).distinct()
    keyed = rows.withColumn("_text_key", F.xxhash64(F.coalesce("text", F.lit("")))).withColumn("_no_text", F.col("text").isNull())
    single = keyed.join(gone, ["doc_id", "_text_key"], "left_anti").dropDuplicates(["doc_id", "_text_key", "_no_text"])
    return single.select(*names).toDF(*docs.columns)


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))


OP7_SQL = f"""
with words as (
    select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w
    from documents
), shingles as (
    select distinct doc_id, case when len(w) < {SHINGLE} then array_to_string(w, ' ') else array_to_string(w[p:p + {SHINGLE - 1}], ' ') end as s
    from (select doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 2}, 2))) as p from words where len(w) > 0)
), sizes as (
    select doc_id, count(*) as n from shingles group by doc_id
), shared as (
    select a.doc_id as a, b.doc_id as b, count(*) as n_both from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2
), links as (
    select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
    where 100 * n_both >= {PERCENT} * (x.n + y.n - n_both)
), both_ways as (
    select a, b from links union all select b, a from links
), reach as materialized (
    with recursive walk(doc_id, seen) as (
        select doc_id, doc_id from documents
        union
        select w.doc_id, l.b from walk w join both_ways l on l.a = w.seen
    )
    select doc_id, min(seen) as component_id from walk group by doc_id
)
select d.doc_id, coalesce(s.n, 0)::bigint as n_shingles, r.component_id, r.component_id = d.doc_id as kept
from documents d left join sizes s using (doc_id) join reach r using (doc_id)
"""
