"""Extendible hashing: shards under a byte limit, split one hash-prefix bit at a time.

The directory is indexed by the leading bits of a key's hash. A bucket over the limit splits on its
next bit; all others stay. A bucket is therefore the shortest prefix whose bytes fit the limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import table
from siltstone.session import materialize

#: Byte limit of a shard in the query.
LIMIT = 1 << 20

#: Hash bits: the first 60 of an MD5.
HASH_BITS = 60

#: Bits that one round looks ahead below the buckets that are still too large.
ROUND_BITS = 12


def hash_bits(key: Column) -> Column:
    """The first 60 bits of the MD5 of the key's text; null hashes as the empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def directory(keys: DataFrame, limit: int, round_bits: int = ROUND_BITS) -> tuple[DataFrame, DataFrame]:
    """Leaves of the directory over ``keys`` (hash, n_bytes), and the whole hashes that stay too large.

    Each round sums bytes at ``round_bits`` more bits, for keys below too large prefixes only, and
    rolls those sums up to every depth between: a leaf is a prefix that fits (or holds one row) below
    one that doesn't. One pass settles some thousand shards; at most five use up the hash.
    """
    leaves = wide = None
    base = 0
    while base < HASH_BITS:
        depth = min(base + round_bits, HASH_BITS)
        at = f"shiftright(hash, {HASH_BITS - base})"
        open_keys = keys if base == 0 else keys.withColumn("prefix", F.expr(at)).join(wide, "prefix", "left_semi")
        cells = open_keys.groupBy(F.expr(f"shiftright(hash, {HASH_BITS - depth})").alias("cell")).agg(
            F.sum("n_bytes").alias("n_bytes"), F.count("*").alias("n_docs")
        )
        levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(base), F.lit(depth))))
        sums = levels.groupBy(
            "depth", F.expr(f"shiftright(cell, {depth} - depth)").alias("prefix")
        ).agg(F.sum("n_bytes").alias("n_bytes"), F.sum("n_docs").alias("n_docs"))
        sums = materialize(sums, "directory")
        small = (F.col("n_bytes") <= limit) | (F.col("n_docs") == 1)
        fits = sums.filter(small)
        parents = sums.filter(~small).select(
            (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent")
        )
        found = fits.withColumn("parent", F.expr("shiftright(prefix, 1)")).join(
            parents, ["depth", "parent"], "left_semi"
        )
        if base == 0:
            found = found.unionByName(fits.filter("depth = 0"), allowMissingColumns=True)
        found = found.select("depth", "prefix", "n_bytes", "n_docs")
        leaves = found if leaves is None else leaves.unionByName(found)
        wide = sums.filter((F.col("depth") == depth) & ~small).select("depth", "prefix", "n_bytes", "n_docs")
        if wide.isEmpty():
            break
        base = depth
    return leaves, wide


def shard(
    df: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT, round_bits: int = ROUND_BITS
) -> DataFrame:
    """Each row's shard: key, n_bytes, shard (its prefix bits as text), depth, shard_bytes, shard_docs.

    Only keys and sizes are shuffled; texts stay where they are. Bytes are those of the UTF-8 text,
    none for null. Rows of one key share a hash, so one bucket can stay over the limit with all bits
    used: such rows go to overflow shards, by a second directory over a hash of the row's place in the
    written key table. A single row over the limit stands alone in its shard. Extra columns are ignored; an empty table gives no rows.
    """
    named = df.select(F.col(key).alias("key"), F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("n_bytes"))
    return _places(named.withColumn("row", F.monotonically_increasing_id()), limit, round_bits).drop("row").withColumnRenamed("key", key)


def _places(named: DataFrame, limit: int, round_bits: int = ROUND_BITS) -> DataFrame:
    """The shard of each (key, n_bytes, row), and its row."""
    keys = materialize(named.withColumn("hash", hash_bits(F.col("key"))), "shard-keys")
    leaves, wide = directory(keys, limit, round_bits)
    placed = _assign(keys, leaves)
    if not wide.isEmpty():
        rest = materialize(
            keys.join(wide.select(F.col("prefix").alias("hash")), "hash", "left_semi").withColumn(
                "hash", hash_bits(F.concat_ws("-", "hash", "row"))
            ),
            "shard-overflow",
        )
        more, equal = directory(rest, limit, round_bits)
        over = _assign(rest, more.unionByName(equal))
        placed = placed.unionByName(over.withColumn("shard", F.concat(F.lit("overflow-"), "shard")))
    return placed


def _bits(value: Column, depth: Column) -> Column:
    """The prefix as ``depth`` binary digits."""
    return F.lpad(F.when(depth == 0, F.lit("")).otherwise(F.bin(value)), depth, "0")


def _assign(keys: DataFrame, leaves: DataFrame) -> DataFrame:
    """Look every key up in the directory; keys below no leaf are left out.

    The directory has an entry for each prefix of the lowest leaf depth, with the leaves below it, or
    an entry for each leaf where some leaves are far deeper than others.
    """
    depths = sorted(r["depth"] for r in leaves.select("depth").distinct().collect())
    if not depths:
        return keys.limit(0).select(
            "row", "key", "n_bytes", F.lit("").alias("shard"), F.lit(0).alias("depth"),
            F.lit(0).cast("long").alias("shard_bytes"), F.lit(0).cast("long").alias("shard_docs"),
        )
    low, high = depths[0], depths[-1]
    entries = leaves.select(
        F.expr(f"shiftright(prefix, depth - {low})").alias("entry"), "depth", "prefix",
        F.col("n_bytes").alias("shard_bytes"), F.col("n_docs").alias("shard_docs"),
    )
    folded = entries.groupBy("entry").agg(F.collect_list(F.struct("depth", "prefix", "shard_bytes", "shard_docs")).alias("leaves"))
    if high - low <= 8:
        looked = keys.withColumn("entry", F.expr(f"shiftright(hash, {HASH_BITS - low})")).join(folded, "entry")
        fits = F.filter("leaves", lambda x: x["prefix"] == F.call_function("shiftright", F.col("hash"), F.lit(HASH_BITS) - x["depth"]))
        looked = looked.withColumn("leaf", F.get(fits, F.lit(0))).filter("leaf is not null")
    else:
        candidates = keys.withColumn("d", F.explode(F.array(*map(F.lit, depths)))).withColumn(
            "prefix", F.expr(f"shiftright(hash, {HASH_BITS} - d)")
        )
        looked = candidates.join(
            leaves.select(F.col("depth").alias("d"), "prefix", F.struct("depth", "prefix", F.col("n_bytes").alias("shard_bytes"), F.col("n_docs").alias("shard_docs")).alias("leaf")),
            ["d", "prefix"],
        )
    return looked.select(
        "row", "key", "n_bytes", _bits(F.col("leaf.prefix"), F.col("leaf.depth")).alias("shard"),
        F.col("leaf.depth").alias("depth"), F.col("leaf.shard_bytes").alias("shard_bytes"),
        F.col("leaf.shard_docs").alias("shard_docs"),
    )


def write_shards(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> None:
    """Write ``df`` as one folder per shard below ``path``; the rows of a shard come from one task.

    Rows are numbered in a table written first and placed by number, so null and repeated keys lose and
    multiply nothing.
    """
    numbered = materialize(df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("r")).withColumn("row", F.monotonically_increasing_id()), "shard-rows")
    named = numbered.select(
        F.col("r").getField(key).alias("key"), F.octet_length(F.coalesce(F.col("r").getField(text), F.lit(""))).cast("long").alias("n_bytes"), "row"
    )
    places = _places(named, limit).select("row", "shard")
    numbered.join(places, "row").select("r.*", "shard").repartition("shard").write.partitionBy("shard").parquet(path)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document, at most 1 MiB of text each."""
    return shard(table(spark, sf_dir, "documents"))


OP3_SQL = f"""
with keyed as (
    select doc_id, coalesce(strlen(text), 0)::bigint as n_bytes,
        ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint as hash
    from documents
), levels as (
    select k.*, d.depth::int as depth, k.hash >> (60 - d.depth)::int as prefix,
        sum(n_bytes) over (partition by d.depth, k.hash >> (60 - d.depth)::int)::bigint as shard_bytes,
        count(*) over (partition by d.depth, k.hash >> (60 - d.depth)::int) as shard_docs
    from keyed k, range(0, 61) d(depth)
), best as (
    select doc_id, min(depth) as depth from levels where shard_bytes <= {LIMIT} or shard_docs = 1 group by doc_id
)
select l.doc_id, l.n_bytes, case when l.depth = 0 then '' else lpad(bin(l.prefix), l.depth, '0') end as shard,
    l.depth, l.shard_bytes, l.shard_docs
from levels l join best b on l.doc_id is not distinct from b.doc_id and l.depth = b.depth
"""
