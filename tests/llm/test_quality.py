import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltstone.llm import quality
from siltstone.llm.quality import bin_of, judged, keep_good, repeated_words, value_of, words_of

KIND = "doc_id long, text string, lang string, source string, salt int, bin string"


def brute(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def texts():
    rng = random.Random(6)
    out = [None, "", " \n\t", "a" * 200_000, "one " * 5000, "x y é z\r\n\r\nq", "#*$%&|<> " * 30, "l\n\nl\n l\nl\n"]
    for _ in range(60):
        words = [rng.choice(["a", "b", "é#", "c\n", "\td", "EE"]) for _ in range(rng.randint(0, 80))]
        out.append(" ".join(words * rng.choice([1, 1, 2, 3])))
    return out


def test_counts_equal_brute_force(spark):
    rows = [(i, t, None if i % 7 == 0 else "en", "hot" if i % 3 else None, 1, "clash") for i, t in enumerate(texts())] + [(None, "a", "en", "hot", 1, None)] * 2
    got = judged(spark.createDataFrame(rows, KIND)).collect()
    assert len(got) == len(rows)
    for r in got:
        m = r["_m"]
        assert (m["n_words"], m["word_chars"], m["n_symbols"], m["n_dup_lines"], m["n_repeat_words"], r["_base_failed"]) == brute(r["text"])
        assert not (r["_kept"] and r["_base_failed"])


def test_outliers_of_a_group_go_and_usual_documents_stay(spark):
    rng = random.Random(8)
    say = lambda tail: " ".join(rng.choice(["stone", "river", "cloud", "meadow"]) + f"{rng.randrange(999)}{tail}" for _ in range(40))
    rows = [(i, say(""), "en", "plain", 1, None) for i in range(60)] + [(100, say("$$$"), "en", "plain", 1, None), (101, say("!!"), "en", "plain", 1, None)]
    # In a source where all texts are marked up, marks are usual.
    rows += [(200 + i, say("$$$"), "en", "code", 1, None) for i in range(60)]
    df = spark.createDataFrame(rows, KIND)
    kept = keep_good(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows} - {100, 101}
    assert keep_good(df.limit(0)).count() == 0


def test_groups_too_many_to_broadcast(spark):
    rows = [(i, "word " + " ".join(f"w{i}x{k}" for k in range(30)), f"l{i % 3}", f"s{i % 50}", 1, None) for i in range(300)]
    df = spark.createDataFrame(rows, KIND)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert keep_good(df).count() == 300
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_sketch_error(spark):
    df = spark.range(0, 200_000, 37).select("id", value_of(bin_of(F.col("id"))).alias("v"))
    assert df.filter(F.abs(F.col("v") - F.col("id")) > F.col("id") * quality.ACCURACY * 1.001).count() == 0


@pytest.mark.parametrize("text, want", [("a b c d e f g h " * 2, 16), ("a b c d e f g", 0), ("x " * 9, 9), ("a b c d e f g h i " + "a b c d e f g h", 16)])
def test_repeated_words(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(repeated_words(words_of(F.col("t")))).first()[0] == want


def capitals(group, start, n, high):
    """Texts of 100 words of four letters with 0 to ``high`` capitals, evenly spread."""
    return [
        (start + i, " ".join(f"{'X' if k < high * i // (n - 1) else 'x'}{chr(97 + k // 26)}{chr(97 + k % 26)}{chr(97 + i % 26)}" for k in range(100)), "en", group, 1, None)
        for i in range(n)
    ]


def brute_limits(rows, measure):
    """Quartiles and cutoffs of one feature, by sorting all values of each scope."""
    def limits(part):
        if len(part) < quality.LEAST_ROWS:
            return None
        values = sorted(part)
        q1, q2, q3 = (values[-(-len(values) * q // 4) - 1] for q in (1, 2, 3))
        return q2 - quality.RANGES * (q3 - q1), q2 + quality.RANGES * (q3 - q1)

    out = {}
    for lang, source in {(r[2], r[3]) for r in rows}:
        scopes = ([r for r in rows if (r[2], r[3]) == (lang, source)], [r for r in rows if r[2] == lang], rows)
        out[lang, source] = next((x for x in (limits([measure(r[1]) for r in scope]) for scope in scopes) if x), None)
    return out


def test_cutoffs_follow_the_sketches(spark):
    """Groups of one median whose quartiles differ get cutoffs and verdicts that differ; small ones go by their language, then by all."""
    # Medians of 30 capitals of 400 letters; quartiles narrow in one group and wide in the other.
    narrow = [(i, capitals("narrow", 0, 2, 30)[-1][1], "en", "narrow", 1, None) for i in range(80)]
    wide = capitals("wide", 1000, 81, 60)
    probe = capitals("wide", 0, 2, 100)[-1][1]
    rows = narrow + wide + [(5000, probe, "en", "narrow", 1, None), (5001, probe, "en", "wide", 1, None)]
    rows += [(6000, probe, "en", "few", 1, None), (6001, probe, "is", "few", 1, None), (6002, None, None, None, 1, None)]
    df = spark.createDataFrame(rows, KIND)
    got = {(r["lang"], r["source"]): r["limits"]["capitals"] for r in quality.cutoffs(quality.sketch(df)).collect()}
    measure = lambda t: 1000 * len(re.findall("[A-Z]", t or "")) // max(1, len(re.sub(r"\s", "", t or "")))
    want = brute_limits(rows, measure)
    assert got.keys() == want.keys()
    for key, (low, high) in want.items():
        assert got[key]["low"] == pytest.approx(low, abs=12) and got[key]["high"] == pytest.approx(high, abs=12)
    assert got["en", "wide"]["high"] > 2 * got["en", "narrow"]["high"]
    kept = {r["doc_id"] for r in keep_good(df).collect()}
    assert 5000 not in kept and 5001 in kept and {r[0] for r in wide} <= kept
    # The few follow the sketch of their language or of all: wide enough for the probe or not, as brute force says.
    share = measure(probe)
    for doc, key in ((6000, ("en", "few")), (6001, ("is", "few"))):
        count = share * 400 / 1000
        assert (doc in kept) == (count - 3 * count**0.5 <= want[key][1] * 400 / 1000)


def test_small_tables_keep_what_passes_the_base_rules(spark):
    rows = [(i, " ".join(f"w{k}{'$$$' * (i == 1)}" for k in range(30)), "en", "s", 1, None) for i in range(quality.LEAST_ROWS - 1)]
    assert keep_good(spark.createDataFrame(rows, KIND)).count() == len(rows)
    assert quality.cutoffs(quality.sketch(spark.createDataFrame(rows, KIND))).count() == 0


def test_sql_gives_the_same_verdicts(spark, tmp_path):
    import duckdb

    rows = capitals("wide", 0, 81, 60) + [(900 + i, t, None if i % 2 else "en", "odd" if i % 3 else None, 1, None) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, KIND)
    df.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: (r["_m"]["n_repeat_words"], r["_base_failed"], r["_kept"]) for r in judged(df).collect()}
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(f"with {quality.quality_sql()} select doc_id, n_repeat_words, base_failed, kept from verdicts").fetchall()
    assert got == {d: (n, b, k) for d, n, b, k in want}
