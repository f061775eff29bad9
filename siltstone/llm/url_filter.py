"""Block and allow lists over urls by hashed host-suffix and path-prefix expressions.

A url becomes the expressions (host suffix, path prefix) that a rule could name. They meet the rules
on a short prefix of their digest, the full digest confirms, and the longest rule wins.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import salt_of, salted, table

RULE_SCHEMA = "verdict string, host string, path string"

#: The rules of the query: verdict, host, path.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From after the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, ASCII_UPPER, ASCII_LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def rule_frame(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Rules as a frame. A path has to end in ``/``: rules name directories."""
    rows = list(rules)
    for verdict, host, path in rows:
        if verdict not in ("allow", "block") or not host or not path.endswith("/"):
            raise ValueError(f"not a rule: {verdict} {host}{path}")
    return spark.createDataFrame(rows, RULE_SCHEMA)


def suffixes(host: Column, most: int) -> Column:
    """The host and its parent domains, of at most ``most`` labels."""
    labels = F.split(host, r"\.", -1)
    size = F.size(labels)
    return F.transform(
        F.sequence(F.lit(1), F.least(size, F.lit(most))),
        lambda n: F.array_join(F.slice(labels, size - n + 1, n), "."),
    )


def prefixes(path: Column, most: int) -> Column:
    """The directories that lead to the path, at most ``most`` of them."""
    parts = F.split(path, "/", -1)
    count = F.least(F.size(parts) - 1, F.lit(most))
    return F.when(
        count > 0,
        F.transform(
            F.sequence(F.lit(1), count),
            lambda n: F.concat(F.array_join(F.slice(parts, 1, n), "/"), F.lit("/")),
        ),
    ).otherwise(F.array().cast("array<string>"))


def filter_urls(
    df: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", prefix_hex: int = 8,
    default: str = "allow",
) -> DataFrame:
    """One row per row of ``df``: id, host, path, the winning rule (null if none) and the verdict.

    A url gives no more expressions than the deepest rule can match; that bound comes from one
    aggregate over the rules and loses nothing. Repeated (id, url) rows of a scan task are judged
    once and given back as often as they came. Expressions such as a top-level domain can be a third
    of all rows, so the rules are repeated over salts when the join has to shuffle; Spark broadcasts
    them when its own size estimate allows.

    The longest ``host + path`` wins; of equal ones the longer host, then the greater text; one rule
    given with both verdicts blocks. Null urls and urls without ``://`` have an empty host and path,
    meet no rule and get the default. Other columns of ``df`` are ignored.
    """
    deepest = rules.agg(
        F.max(F.size(F.split("host", r"\.", -1))).alias("labels"),
        F.max(F.size(F.split("path", "/", -1)) - 1).alias("folders"),
    ).first()
    labels, folders = deepest["labels"] or 0, deepest["folders"] or 0
    seen = (
        df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
        .groupBy("id", "url", F.spark_partition_id().alias("task"))
        .agg(F.count("*").alias("copies"))
        .withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    )
    if not labels:
        judged = seen.withColumn("best", F.lit(None).cast("struct<size:int,host_size:int,rule:string,verdict:string>"))
    else:
        keyed = salted(
            rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block sorts after allow
            .select(
                F.concat("host", "path").alias("rule"), F.col("verdict").alias("rule_verdict"),
                F.length("host").alias("rule_host"), digest(F.col("host"), F.col("path")).alias("rule_digest"),
            )
            .withColumn("short", F.substring("rule_digest", 1, prefix_hex))
        )
        pairs = F.flatten(
            F.transform(
                suffixes(F.col("host"), labels),
                lambda h: F.transform(prefixes(F.col("path"), folders), lambda p: digest(h, p)),
            )
        )
        expressions = (
            seen.withColumn("full", F.explode_outer(pairs))
            .withColumn("short", F.substring("full", 1, prefix_hex))
            .withColumn("salt", salt_of(F.col("id"), F.col("url"), F.col("task")))
        )
        judged = (
            expressions.join(keyed, ["short", "salt"], "left")
            .withColumn(
                "hit",
                F.when(
                    F.col("full") == F.col("rule_digest"),
                    F.struct(
                        F.length("rule").alias("size"), F.col("rule_host").alias("host_size"), F.col("rule"),
                        F.col("rule_verdict").alias("verdict"),
                    ),
                ),
            )
            .groupBy("id", "url", "task", "copies", "host", "path")
            .agg(F.max("hit").alias("best"))
        )
    return judged.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
        F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url under :data:`RULES`."""
    return filter_urls(table(spark, sf_dir, "pages"), rule_frame(spark, RULES))


OP5_SQL = """
with rules(verdict, host, path) as (
    values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), parsed as (
    select page_id, row_number() over () as rid,
        coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
        coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path
    from pages
), fitting as (
    select p.rid, r.verdict, r.host || r.path as rule,
        row_number() over (partition by p.rid order by length(r.host || r.path) desc, length(r.host) desc, r.host || r.path desc) as place
    from parsed p join rules r
        on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path)
)
select p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') as verdict
from parsed p left join fitting f on f.rid = p.rid and f.place = 1
"""
