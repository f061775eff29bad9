import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from siltstone.llm import prefix_tree as pt

ROWS = "conv_id long, turn long, role string, text string, node string, depth long"


def slow(rows):
    """The contract on lists in memory."""
    turns = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            turns[conv].append((turn is not None, turn or 0, mark, role, text))
    plain = {c: [(r, t) for *_, r, t in sorted(ts)] for c, ts in turns.items()}
    rebuilt = {}
    for c, own in plain.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = plain.get(c - c % 100, [])[:h] + own[h:]
    members = defaultdict(list)
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[x] for x in below) if below else 1
        saved[node] = sum(saved[x] for x in below) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    return sorted(
        (
            min(m),
            len(node),
            min(members[node[:-1]]) if node else -1,
            len(m),
            len(children[node]),
            leaves[node],
            saved[node],
            hashlib.sha256(",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(node)).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def got(df):
    return sorted((*r[:2], -1 if r[2] is None else r[2], *r[3:]) for r in df.collect())


def corpus(seed, n=130):
    rng = random.Random(seed)
    rows = []
    for c in [*range(n), 300, 305, 1207, *range(901, 905)]:
        for t in range(rng.randint(1, 9)):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(["é", "bb", "", None, "long text"]), "x", 1))
    rows += rows[:40]  # repeated rows are turns of their own
    rows.append((None, 0, "user", "nobody's", None, None))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    assert got(pt.prefix_tree(spark.createDataFrame(rows, ROWS).repartition(3))) == slow(rows)


def test_one_conversation_of_many_turns_is_chained_in_blocks(spark, monkeypatch):
    rows = [(c, t, "user", f"turn {t % 3 if t < 120 else t + c}", "x", 1) for c in (0, 1, 2) for t in range(150 + c)]
    rows += [(7, 0, "user", "same", "x", 1)] * 30
    monkeypatch.setattr(pt, "COPIES", 8)
    monkeypatch.setattr(pt, "IDS", 2)
    assert got(pt.prefix_tree(spark.createDataFrame(rows, ROWS), block=4)) == slow(rows)


def test_names_do_not_depend_on_the_way_through_blocks(spark):
    rows = spark.range(60).select(F.lit(1).cast("long").alias("conv_id"), (F.col("id") + 1).alias("d"), F.sha2(F.col("id").cast("string"), 256).cast("binary").alias("mark"), F.col("id").alias("chars"), F.lit(60).cast("long").alias("turns"))
    short = rows.where("d <= 37").withColumn("conv_id", F.lit(2).cast("long")).withColumn("turns", F.lit(37).cast("long"))
    named = pt.prefixes(rows.unionByName(short), 60, 3)
    names = named.groupBy("d").agg(F.count_distinct("node").alias("n"), F.count_distinct("parent").alias("p"))
    assert names.where("n > 1 or p > 1").count() == 0
    assert named.select("node").distinct().count() == 60
    chain = named.where("conv_id = 1").select("d", "parent", "node").orderBy("d").collect()
    assert all(a["node"] == b["parent"] for a, b in zip(chain, chain[1:], strict=False))


@pytest.mark.parametrize("shape", ["chain", "star", "random", "comb"])
def test_contraction_gives_every_subtree_total(spark, shape):
    rng, n = random.Random(3), 60
    parent = {0: None}
    for i in range(1, n):
        parent[i] = {"chain": i - 1, "star": 0, "random": rng.randrange(i), "comb": i - 1 if i % 2 else max(0, i - 2)}[shape]
    weight = {i: rng.randint(0, 9) for i in range(n)}
    total = dict(weight)
    for i in range(n - 1, 0, -1):
        total[parent[i]] += total[i]
    name = lambda i: None if i is None else b"%03d" % i
    nodes = spark.createDataFrame([(bytearray(name(i)), name(parent[i]), weight[i]) for i in range(n)], "node binary, parent binary, w long")
    assert {int(bytes(r["node"])): r["w"] for r in pt.contract(nodes, ["w"]).collect()} == total


def test_empty_table_has_no_nodes(spark):
    assert got(pt.prefix_tree(spark.createDataFrame([], ROWS))) == []
