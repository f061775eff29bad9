"""Quality rules whose cutoffs follow the corpus: quantile sketches per language and source.

Each document is measured; measures are summed into mergeable sketches (logarithmic bins with counts,
so that merging is adding and the result does not depend on the order); each (language, source) gets
its own cutoffs from its sketch, or, where it is too small to judge by, from the merged sketch of its
language or of all; documents meet their cutoffs by a join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import salt_of, salted, sheltered, table
from siltstone.session import materialize

SPACE = r"[\x20\x09-\x0D]+"

#: Ratios of the sketches: a count and what it is a share of.
SHARES = {
    "symbols": ("n_symbols", "word_chars"), "word_length": ("word_chars", "n_words"), "dup_lines": ("n_dup_lines", "n_lines"),
    "capitals": ("n_capitals", "word_chars"), "marks": ("n_marks", "word_chars"),
}
FEATURES = tuple(SHARES)

#: Relative error of a sketch's quantiles.
ACCURACY = 0.01

#: Cutoff: the median plus this many interquartile ranges, both ways.
RANGES = 4
#: A document is unusual if its count lies so many standard deviations of a count beyond the cutoff: one or two symbols
#: of a short text tell nothing, even in a group without any.
DEVIATIONS = 3
#: Groups of fewer documents go by the merged sketch of their language, languages of fewer by that of all.
LEAST_ROWS = 50

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent

_RATIO = math.log((1 + ACCURACY) / (1 - ACCURACY))


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE, -1), lambda w: w != "")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows that occur at least twice, the first occurrence included.

    Windows are compared by 64-bit hashes. Rows without a repeated window stop at a count.
    """
    last = F.size(words) - window
    hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(words, i + 1, window)))

    def starts(pairs: Column) -> Column:
        """Positions, in order, whose window equals that of a neighbour in the sorted pairs."""
        same = F.filter(
            pairs,
            lambda x, k: F.coalesce(F.get(pairs, k + 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(pairs, k - 1)["h"] == x["h"], F.lit(False)),
        )
        return F.array_sort(F.transform(same, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        return F.aggregate(
            F.transform(
                at, lambda p, k: F.least(F.lit(window), F.coalesce(F.get(at, k + 1) - p, F.lit(window)))
            ),
            F.lit(0), lambda total, n: total + n,
        )

    bound = lambda value, fn: F.get(F.transform(F.array(value), fn), F.lit(0))  # noqa: E731  evaluates value once
    return (
        F.when(last < 0, F.lit(0))
        .otherwise(
            bound(
                hashes,
                lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0)).otherwise(
                    bound(
                        F.array_sort(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
                        lambda pairs: bound(starts(pairs), covered),
                    )
                ),
            )
        )
        .cast("long")
    )


def measures(text: Column, words: Column) -> dict[str, Column]:
    """The counts that the rules work on; all but ``n_repeat_words`` are cheap."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.regexp_replace(whole, SPACE, "")).cast("long"),
        "n_symbols": F.regexp_count(whole, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_capitals": F.regexp_count(whole, F.lit(r"\p{Lu}")).cast("long"),
        "n_marks": F.regexp_count(whole, F.lit(r"[!?]")).cast("long"),
    }


def measured(docs: DataFrame, text: str = "text", repeats: bool = True) -> DataFrame:
    """``docs`` with the structs ``_m`` of counts and ``_r`` of ratios; no other name is touched.

    The explode of one struct keeps filters on the counts above it: pushed below, each of them would
    count the words of every text again.
    """
    out = docs.withColumn("_words", words_of(F.col(text)))
    counts = measures(F.col(text), F.col("_words"))
    if repeats:
        counts["n_repeat_words"] = repeated_words(F.col("_words"))
    out = out.withColumn("_m", F.explode(F.array(F.struct(*[c.alias(n) for n, c in counts.items()])))).drop("_words")
    ratios = {n: _ratio(F.col("_m"), n) for n in FEATURES}
    return out.withColumn("_r", F.struct(*[c.alias(n) for n, c in ratios.items()]))


def _ratio(m: Column, feature: str) -> Column:
    part, whole = SHARES[feature]
    return F.when(m[whole] > 0, F.floor(F.lit(1000) * m[part] / m[whole])).otherwise(F.lit(0)).cast("long")


def bin_of(value: Column) -> Column:
    """The sketch's bin: 0 for 0, else 1 for 1 and one more for each ratio of (1 + a) / (1 - a)."""
    return F.when(value <= 0, F.lit(0)).otherwise(F.ceil(F.log(value.cast("double")) / F.lit(_RATIO)) + 1).cast("int")


def value_of(number: Column) -> Column:
    """The value that stands for a bin, within the accuracy of all its values."""
    return F.when(number <= 0, F.lit(0.0)).otherwise(
        F.lit(2.0) * F.exp((number - 1) * F.lit(_RATIO)) / F.lit(1 + math.exp(_RATIO))
    )


def sketch(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """Counts per (lang, source, feature, bin): a sketch that merges by adding counts.

    Counted inside the map tasks first, so a hot source costs each task a few hundred rows.
    """
    ratios = measured(docs.select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text")), repeats=False)
    bins = F.array(
        *[F.struct(F.lit(n).alias("feature"), bin_of(F.col(f"_r.{n}")).alias("bin")) for n in FEATURES]
    )
    return (
        ratios.select("lang", "source", F.explode(bins).alias("b"))
        .groupBy("lang", "source", F.col("b.feature").alias("feature"), F.col("b.bin").alias("bin"))
        .agg(F.count("*").alias("n"))
    )


def _scopes(lang: Column, source: Column) -> Column:
    """A group itself, its language, and all, as (level, lang, source)."""
    none = F.lit(None).cast("string")
    levels = ((lang, source), (lang, none), (none, none))
    return F.array(*[F.struct(F.lit(i).alias("level"), a.alias("lang"), b.alias("source")) for i, (a, b) in enumerate(levels)])


def cutoffs(sketches: DataFrame) -> DataFrame:
    """Low and high cutoffs per (lang, source), as a map of feature to (low, high).

    A quantile is the value of the first bin at which the running count reaches q * n. A scope has at
    most some hundred bins per feature, whatever its rows. Groups without a scope of ``LEAST_ROWS``
    documents have no row.
    """
    groups = sketches.withColumns({c: F.col(c).cast("string") for c in ("lang", "source")})
    per = (
        groups.select(F.explode(_scopes(F.col("lang"), F.col("source"))).alias("scope"), "feature", "bin", "n")
        .groupBy("scope", "feature", "bin").agg(F.sum("n").alias("n"))
        .groupBy("scope", "feature")
        .agg(F.array_sort(F.collect_list(F.struct("bin", "n"))).alias("bins"), F.sum("n").alias("total"))
        .filter(F.col("total") >= LEAST_ROWS)
    )

    def quantile(quarters: int) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("run"), F.lit(None).cast("int").alias("bin"))
        return value_of(
            F.aggregate(
                "bins", start,
                lambda acc, x: F.struct(
                    (acc["run"] + x["n"]).alias("run"),
                    F.when(acc["bin"].isNotNull(), acc["bin"])
                    .when(F.lit(4) * (acc["run"] + x["n"]) >= F.lit(quarters) * F.col("total"), x["bin"])
                    .alias("bin"),
                ),
                lambda acc: acc["bin"],
            )
        )

    spread = F.lit(RANGES) * (F.col("q3") - F.col("q1"))
    limits = (
        per.withColumns({"q1": quantile(1), "q2": quantile(2), "q3": quantile(3)})
        .withColumn("limits", F.struct((F.col("q2") - spread).alias("low"), (F.col("q2") + spread).alias("high")))
        .groupBy("scope")
        .agg(F.map_from_entries(F.collect_list(F.struct("feature", "limits"))).alias("limits"))
    )
    asked = groups.select("lang", "source").distinct().withColumn("asked", F.explode(_scopes(F.col("lang"), F.col("source"))))
    return (
        asked.join(limits, asked["asked"].eqNullSafe(limits["scope"]))
        .groupBy("lang", "source")
        .agg(F.min_by("limits", F.col("asked.level")).alias("limits"))
    )


def unusual(m: Column, feature: str, low: Column, high: Column) -> Column:
    """Whether a count lies beyond its cutoffs by more than its own chance deviation; null where there is no cutoff."""
    part, whole = (m[n].cast("double") for n in SHARES[feature])
    least, most = F.greatest(low, F.lit(0.0)) * whole / F.lit(1000.0), high * whole / F.lit(1000.0)
    return (part - F.lit(DEVIATIONS) * F.sqrt(part) > most) | (part + F.lit(DEVIATIONS) * F.sqrt(least) < least)


def judged(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``docs`` with structs ``_m`` (counts), ``_r`` (ratios) and the columns ``_base_failed``, ``_kept``.

    Sketches and cutoffs are written to the shared folder, so every later read sees one set. They meet the
    documents on (lang, source), null equal to null, with the cutoffs repeated over salts: a source
    with a third of all rows is spread, and Spark broadcasts them where its size estimate allows.

    A null text counts as empty. Empty texts fail the base rule (under 20 words). Groups of one
    document go by the documents of their language, and tables of fewer than ``LEAST_ROWS`` documents keep
    what passes the base rule, as nothing is unusual in them. Very long texts are measured whole. Ties and
    repeated rows get the same verdict. An empty table gives no rows.
    """
    sketches = materialize(sketch(docs, lang, source, text), "quality-sketches")
    limits = materialize(cutoffs(sketches), "quality-cutoffs")
    limits = salted(
        limits.select(F.struct("lang", "source").alias("_group"), F.col("limits").alias("_limits"))
    ).withColumnRenamed("salt", "_salt")
    rows = measured(docs, text).withColumn(
        "_group", F.struct(F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"))
    ).withColumn("_salt", salt_of(F.col(text)))
    base = (F.col("_m.n_words") < LEAST_WORDS) | (
        F.lit(100) * F.col("_m.n_repeat_words") > F.lit(MOST_REPEATED) * F.col("_m.n_words")
    )
    odd = F.lit(False)
    for n in FEATURES:
        odd |= unusual(F.col("_m"), n, F.col("_limits")[n]["low"], F.col("_limits")[n]["high"])
    joined = rows.join(limits, rows["_group"].eqNullSafe(limits["_group"]) & (rows["_salt"] == limits["_salt"]), "left").drop(
        limits["_group"]
    ).drop(limits["_salt"])
    return joined.withColumn("_base_failed", base).withColumn("_kept", ~base & ~F.coalesce(odd, F.lit(False)))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with the columns of ``docs``."""
    rows, names = sheltered(docs, "text", "lang", "source")
    return judged(rows).filter("_kept").select(*names).toDF(*docs.columns)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return judged(docs).select(
        "doc_id", "_m.n_words", "_m.word_chars", "_m.n_symbols", "_m.n_dup_lines", "_m.n_repeat_words",
        F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"),
    )


def quality_sql(source: str = "documents") -> str:
    """DuckDB: common table expressions that end in ``verdicts`` (doc_id, counts, base_failed, kept)."""
    shares = ", ".join(f"{{'feature': '{n}', 'part': {part}, 'whole': {whole}}}" for n, (part, whole) in SHARES.items())
    level = "case when b{0} <= 0 then 0 else 2 * exp((b{0} - 1) * {1!r}) / {2!r} end"
    q1, q2, q3 = (level.format(i, _RATIO, 1 + math.exp(_RATIO)) for i in (1, 2, 3))
    return f"""
texts as (
    select doc_id, lang, source, coalesce(text, '') as t,
        list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
    from {source}
), windows as (
    select doc_id, p, array_to_string(words[p:p + {WINDOW - 1}], ' ') as w
    from (select doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) as p from texts where len(words) >= {WINDOW})
), twice as (
    select doc_id, p from windows qualify count(*) over (partition by doc_id, w) > 1
), covered as (
    select doc_id, count(distinct p + o) as n_repeat_words from twice, range(0, {WINDOW}) r(o) group by doc_id
), counts as (
    select t.doc_id, lang, source, len(words)::bigint as n_words,
        length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::bigint as word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols,
        len(lines)::bigint as n_lines, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
        len(regexp_extract_all(t, '\\p{{Lu}}'))::bigint as n_capitals, len(regexp_extract_all(t, '[!?]'))::bigint as n_marks,
        coalesce(n_repeat_words, 0)::bigint as n_repeat_words
    from texts t left join covered c on c.doc_id is not distinct from t.doc_id
), shares as (
    select doc_id, lang, source, unnest([{shares}]) as s from counts
), long as (
    select doc_id, lang, source, s.feature as feature, s.part as part, s.whole as whole, coalesce(s.part * 1000 // nullif(s.whole, 0), 0) as v
    from shares
), scopes as (
    select distinct lang as own_lang, source as own_source, unnest([0, 1, 2]) as level from texts
), asked as (
    select *, case when level < 2 then own_lang end as lang, case when level < 1 then own_source end as source from scopes
), bins as (
    select level, case when level < 2 then lang end as lang, case when level < 1 then source end as source, feature,
        case when v <= 0 then 0 else ceil(ln(v) / {_RATIO!r}) + 1 end as bin, count(*) as n
    from long, range(3) l(level) group by all
), running as (
    select *, sum(n) over (partition by level, lang, source, feature order by bin) as run,
        sum(n) over (partition by level, lang, source, feature) as total
    from bins
), quantiles as (
    select level, lang, source, feature, min(bin) filter (4 * run >= total) as b1, min(bin) filter (4 * run >= 2 * total) as b2,
        min(bin) filter (4 * run >= 3 * total) as b3
    from running where total >= {LEAST_ROWS} group by all
), levels as (
    select level, lang, source, feature, {q1} as q1, {q2} as q2, {q3} as q3 from quantiles
), limits as (
    select own_lang, own_source, feature, arg_min(q2 - {RANGES} * (q3 - q1), a.level) as low, arg_min(q2 + {RANGES} * (q3 - q1), a.level) as high
    from asked a join levels l on a.level = l.level and a.lang is not distinct from l.lang and a.source is not distinct from l.source
    group by all
), expected as (
    select doc_id, part, greatest(low, 0) * whole / 1000.0 as least, high * whole / 1000.0 as most
    from long l join limits c
        on l.lang is not distinct from c.own_lang and l.source is not distinct from c.own_source and l.feature = c.feature
), unusual as (
    select distinct doc_id from expected
    where part - {DEVIATIONS} * sqrt(part) > most or part + {DEVIATIONS} * sqrt(least) < least
), verdicts as (
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words as base_failed,
        not (n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words)
            and doc_id not in (select doc_id from unusual) as kept
    from counts
)"""


OP9_SQL = f"with {quality_sql()} select * from verdicts"
