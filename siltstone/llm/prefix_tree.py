"""The prefix tree of conversations, with subtree totals by parallel tree contraction.

Turns are numbered by one distributed sort. A prefix is named by a chain of digests, taken in blocks of
turns whose own digests are chained a level higher; so a conversation of any length is spread over
tasks, and equal prefixes get equal names wherever they are computed.

Totals over subtrees come from contraction. Each round rakes all leaves, which add what they gathered
to their parents, and compresses unary chains: a node with a single child is taken out where its hash
exceeds those of its parent and child, so that no two neighbours go at once, and its child carries its
weight. A logarithmic number of join rounds leaves the root; then the rounds are walked back, and every
node that was taken out gets its total from the child that carried it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import sent_whole, table
from siltstone.operators.numbering import numbered
from siltstone.session import configure, materialize

sent_whole(__name__)

#: Conversations whose ids share all digits but the last two share the turns of the first of them.
FAMILY = 100
#: Turns that one task chains at once.
BLOCK = 256
#: Repeated rows that travel as one through the sort.
COPIES = 256
#: Ids whose text one row holds, at most.
IDS = 512


def _digest(value: Column) -> Column:
    return F.substring(F.unhex(F.sha2(value, 256)), 1, 16)


def _root() -> Column:
    return _digest(F.lit("root"))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, mark, chars): all turns by number, as digests of role and text.

    Turns are ordered by ``turn``, null first; equal ones by the digest. Rows without a conv_id belong
    to no conversation. Equal rows are sorted as blocks of copies, so that many do not meet in one task.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        _digest(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("mark"),
        F.char_length(text).cast("long").alias("chars"),
    )
    distinct = turns.groupBy("conv_id", "turn", "mark", "chars").agg(F.count("*").alias("copies"))
    blocks = distinct.withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("mark"), F.col("first")]
    rows = blocks.withColumn("copies", F.least(F.col("copies") - F.col("first"), F.lit(COPIES)))
    return numbered(rows, order, "place").select("conv_id", "place", "mark", "chars", "copies")


def _single_rows(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations (conv_id, own turns), and each turn's number in its conversation."""
    turns = turns.withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("copies") - 1).cast("int"))))
    order = [F.col("place"), F.col("copy")]
    placed = numbered(turns.select("conv_id", "place", "copy", "mark", "chars"), order, "row")
    convs = placed.groupBy("conv_id").agg(F.min("row").alias("begin"), F.count("*").alias("own"))
    return convs, placed


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations (conv_id, turns), and their turns (conv_id, d, mark, chars), d from 1."""
    turns = ordered_turns(conversations)
    if turns.where("copies > 1").limit(1).count():
        convs, placed = _single_rows(turns)
    else:
        placed = turns.withColumnRenamed("place", "row")
        convs = placed.groupBy("conv_id").agg(F.min("row").alias("begin"), F.count("*").alias("own"))
    convs = convs.withColumn("head", F.crc32(F.col("conv_id").cast("string")) % 6).withColumn("family", F.col("conv_id") - F.col("conv_id") % FAMILY)
    first = materialize(convs, "conversations")
    bases = first.select(F.col("conv_id").alias("family"), F.least("own", F.lit(5)).alias("shared"))
    convs = materialize(
        first.join(bases, "family", "left")
        .withColumn("taken", F.least("head", F.coalesce("shared", F.lit(0))))
        .withColumn("turns", F.col("taken") + F.greatest(F.col("own") - F.col("head"), F.lit(0)))
        .select("conv_id", "family", "begin", "head", "taken", "turns"),
        "families",
    )
    # The written table of conversations has one row for each; a hot one's turns can be split.
    numbers = placed.join(convs, "conv_id").withColumn("at", F.col("row") - F.col("begin"))
    own = numbers.where("at >= head").select("conv_id", (F.col("taken") + F.col("at") - F.col("head") + 1).alias("d"), "mark", "chars", "turns")
    heads = numbers.where(f"at < 5 and conv_id % {FAMILY} = 0").select(F.col("conv_id").alias("family"), "at", "mark", "chars")
    shared = convs.join(heads, "family").where("at < head").select("conv_id", (F.col("at") + 1).alias("d"), "mark", "chars", "turns")
    return convs.select("conv_id", "turns"), own.unionByName(shared)


def prefixes(rows: DataFrame, longest: int, block: int = BLOCK) -> DataFrame:
    """(conv_id, d, parent, node, chars, last) of each turn: names of the prefix without and with it.

    Turns are chained inside blocks; a block begins with the name of all before it, which comes from
    the chain of whole blocks one level higher. ``longest`` is the largest d.
    """
    grouped = rows.groupBy("conv_id", F.floor((F.col("d") - 1) / block).alias("block"), "turns").agg(
        F.sort_array(F.collect_list(F.struct("d", "mark", "chars"))).alias("part")
    )
    if longest > block:
        grouped = materialize(grouped, "turn-blocks")
        whole = grouped.where(F.size("part") == block).select(
            "conv_id",
            (F.col("block") + 1).alias("d"),
            _digest(F.concat(F.lit("block"), F.array_join(F.transform("part.mark", F.hex), ""))).alias("mark"),
            F.lit(0).cast("long").alias("chars"),
            "turns",
        )
        above = prefixes(whole, longest // block, block).select("conv_id", F.col("d").alias("block_end"), F.col("parent").alias("up_parent"), F.col("node").alias("up"))
        full = F.size("part") == block
        keyed = grouped.withColumn("block_end", F.col("block") + full.cast("long"))
        joined = keyed.join(above, ["conv_id", "block_end"], "left")
        begin = F.coalesce(F.when(full, F.col("up_parent")).otherwise(F.col("up")), _root())
        end = F.when(full, F.col("up"))
    else:
        joined, begin, end = grouped, _root(), F.lit(None).cast("binary")
    chain = F.aggregate(
        "part.mark",
        F.array("begin"),
        lambda names, mark: F.concat(names, F.array(_digest(F.concat(F.element_at(names, -1), mark)))),
    )
    named = joined.withColumn("begin", begin).withColumn("end", end).withColumn("names", chain)
    named = named.withColumn("names", F.when(F.col("end").isNull(), F.col("names")).otherwise(F.concat(F.slice("names", 1, F.size("names") - 1), F.array("end"))))
    single = named.select("conv_id", "turns", "names", F.posexplode("part").alias("i", "turn"))
    return single.select(
        "conv_id",
        F.col("turn.d").alias("d"),
        F.col("names")[F.col("i")].alias("parent"),
        F.col("names")[F.col("i") + 1].alias("node"),
        F.col("turn.chars").alias("chars"),
        (F.col("turn.d") == F.col("turns")).alias("last"),
    )


def contract(nodes: DataFrame, weights: Sequence[str]) -> DataFrame:
    """(node, weights): the sums of the given long columns over each node's subtree.

    ``nodes`` has node, parent (null for the root) and the weights. A round joins every node that is
    left with what its children give it, and every child with the parent that it replaces; keys are
    spread by hash, and what a hot parent's children give it is added up before it is shuffled.
    """
    carried = {w: f"__carried_{w}" for w in weights}
    kids = nodes.groupBy("parent").agg(F.count("*").alias("kids")).withColumnRenamed("parent", "node")
    alive = materialize(
        nodes.select("node", "parent", *weights, *[F.lit(0).cast("long").alias(c) for c in carried.values()])
        .join(kids, "node", "left")
        .withColumn("kids", F.coalesce("kids", F.lit(0))),
        "contract-0",
    )
    raked: list[DataFrame] = []
    spliced: list[DataFrame] = []
    number = 0
    while True:
        number += 1
        done = F.col("kids") == 0
        raked.append(alive.where(done).select("node", *weights))
        if not alive.where(~done).limit(1).count():
            break
        given = alive.where("parent is not null").groupBy("parent").agg(
            *[F.sum(F.when(done, F.col(w) + F.col(c)).otherwise(0)).alias(f"__given_{w}") for w, c in carried.items()],
            F.count(F.when(~done, 1)).alias("kids"),
            F.max(F.when(~done, F.col("node"))).alias("only"),
        )

        def rank(name: str, number: int = number) -> Column:
            return F.xxhash64(F.lit(number), F.col(name))

        left = alive.where(~done).drop("kids").join(given.withColumnRenamed("parent", "node"), "node")
        out = (F.col("kids") == 1) & F.col("parent").isNotNull() & (rank("node") > rank("only")) & (rank("node") > rank("parent"))
        left = materialize(
            left.select(
                "node",
                "parent",
                "kids",
                "only",
                F.coalesce(out, F.lit(False)).alias("out"),
                *[(F.col(w) + F.col(f"__given_{w}")).alias(w) for w in weights],
                *carried.values(),
            ),
            f"rake-{number}",
        )
        gone = left.where("out").select(
            F.col("only").alias("node"),
            F.col("node").alias("__gone"),
            F.col("parent").alias("__up"),
            *[F.col(w).alias(f"__own_{w}") for w in weights],
            *[F.col(c).alias(f"__more{c}") for c in carried.values()],
        )
        joined = left.where("not out").join(gone, "node", "left")
        here = F.col("__gone").isNotNull()
        alive = materialize(
            joined.select(
                "node",
                F.when(here, F.col("__up")).otherwise(F.col("parent")).alias("parent"),
                "kids",
                *weights,
                *[F.when(here, F.col(c) + F.col(f"__own_{w}") + F.col(f"__more{c}")).otherwise(F.col(c)).alias(c) for w, c in carried.items()],
                "__gone",
                # The total of the node that went is its child's and what lay between them.
                *[(F.col(f"__own_{w}") + F.col(c)).alias(f"__add_{w}") for w, c in carried.items()],
            ),
            f"compress-{number}",
        )
        spliced.append(alive.where("__gone is not null").select("node", "__gone", *[f"__add_{w}" for w in weights]))
        alive = alive.drop("__gone", *[f"__add_{w}" for w in weights])
    totals = reduce(DataFrame.unionByName, raked)
    for number, gone in reversed(list(enumerate(spliced, 1))):
        back = gone.join(totals, "node").select(F.col("__gone").alias("node"), *[(F.col(w) + F.col(f"__add_{w}")).alias(w) for w in weights])
        totals = totals.unionByName(materialize(back, f"expand-{number}"))
    return totals


def id_digests(ends: DataFrame, node: str, conv: str, name: str) -> DataFrame:
    """(node, SHA-256 hex of its ids in ascending order, joined by commas).

    The digest of one node reads its ids one after the other, by its nature; blocks of neighbouring ids
    are sorted and joined to text before, and then only flow through the task that digests them.
    """
    block = F.floor(F.col(conv) / IDS)
    texts = ends.groupBy(node, block.alias("block")).agg(F.array_join(F.sort_array(F.collect_list(conv)).cast("array<string>"), ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            keys, digests = [], []
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key != current:
                    if state:
                        keys.append(current)
                        digests.append(state.hexdigest())
                    current, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], ["node", name])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([current], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["node", name])

    sorted_texts = texts.repartition(node).sortWithinPartitions(node, "block").select(node, "ids")
    return sorted_texts.mapInArrow(digest, f"node binary, {name} string")


def prefix_tree(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Null role or text counts as empty; turns that repeat whole rows each count; turns of equal number
    are ordered by the digest of role and text; rows without a conv_id are left out; an empty table has
    no nodes, not even the root; other columns are not read. Texts are only read to be digested and
    counted, so long ones meet nowhere.
    """
    convs, turns = rebuilt(conversations)
    longest = convs.agg(F.max("turns")).first()[0] or 0
    rows = materialize(prefixes(turns, longest, block), "prefixes")
    below = rows.groupBy("node").agg(
        F.min("parent").alias("parent"),
        F.min("d").cast("long").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.max("chars").alias("chars"),
    )
    top = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    top = top.select(
        _root().alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs", F.lit(0).cast("long").alias("chars")
    )
    nodes = materialize(below.unionByName(top), "tree")
    children = nodes.where("parent is not null").groupBy("parent").agg(F.count("*").alias("n_children")).withColumnRenamed("parent", "node")
    nodes = materialize(nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "tree")
    weighted = nodes.select("node", "parent", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"))
    totals = contract(weighted, ["n_leaves", "saved_tokens"])
    ends = rows.where("last").select("node", "conv_id").unionByName(convs.where("turns = 0").select(_root().alias("node"), "conv_id"))
    digests = materialize(id_digests(ends, "node", "conv_id", "ends_sha256"), "ends")
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(totals, "node")
        .join(digests, "node", "left")
        .join(parents, "parent", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )


def op12_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix tree of all conversations, rebuilt with the turns that their family shares."""
    configure(spark)
    return prefix_tree(table(spark, sf_dir, "conversations"))


#: CRC-32 is not among the functions of that SQL: each digit's byte goes through its eight steps.
OP12_SQL = """
WITH turns AS (
  SELECT conv_id,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos,
         sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS mark,
         length(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT conv_id FROM turns),
convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS family,
         xor(list_reduce(
           list_prepend(4294967295::UBIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::UBIGINT)),
           lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
             lambda x, z: xor(x >> 1, (x & 1) * 3988292384::UBIGINT))), 4294967295::UBIGINT) % 6 AS head
  FROM ids),
heads AS (
  SELECT c.conv_id, t.pos, t.mark, t.chars FROM convs c JOIN turns t ON t.conv_id = c.family WHERE t.pos < c.head),
together AS (
  SELECT conv_id, 0 AS part, pos, mark, chars FROM heads
  UNION ALL
  SELECT t.conv_id, 1, t.pos, t.mark, t.chars FROM turns t JOIN convs c ON c.conv_id = t.conv_id WHERE t.pos >= c.head),
rebuilt AS (
  SELECT conv_id, row_number() OVER w AS d, chars, string_agg(mark, '') OVER (w ROWS UNBOUNDED PRECEDING) AS node
  FROM together WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)),
members AS (
  SELECT conv_id, d, chars, node, CASE WHEN d = 1 THEN '' ELSE node[1:length(node) - 64] END AS parent FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '', NULL FROM convs),
ends AS (
  SELECT node, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
  FROM (SELECT * FROM members QUALIFY d = max(d) OVER (PARTITION BY conv_id))
  GROUP BY node),
nodes AS (
  SELECT node, min(parent) AS parent, min(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars
  FROM members GROUP BY node),
children AS (SELECT parent, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
own AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children, (n.n_convs - 1) * n.chars AS saved
  FROM nodes n LEFT JOIN children c ON c.parent = n.node),
totals AS (
  SELECT m.node, sum(CASE WHEN o.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(o.saved) AS saved_tokens
  FROM own o JOIN members m ON m.conv_id = o.conv_id AND m.d <= o.depth GROUP BY m.node)
SELECT o.conv_id, o.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children,
       t.n_leaves::BIGINT AS n_leaves, t.saved_tokens::BIGINT AS saved_tokens,
       coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM own o JOIN totals t ON t.node = o.node LEFT JOIN ends e ON e.node = o.node LEFT JOIN own p ON p.node = o.parent
"""
