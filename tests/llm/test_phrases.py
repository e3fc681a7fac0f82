"""Collocations from quotient filters against counting phrases as text, and the Feistel inverse."""

import duckdb
from pyspark.sql import functions as F

from saldoflow.llm import oracles, phrases

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_permutation_is_inverted(spark):
    df = spark.createDataFrame([(i * 7919 - 3, -i * 104729) for i in range(200)], "hi long, lo long")
    back = phrases.unpermute(phrases.permute(df))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert phrases.permute(df).filter(F.col("hi").isNull()).count() == 0


def fixture():
    base = ["Hot Dog stand. hot dog, HOT   dog\tstand!", "new york city; new york city? new york", "ÄBC hot dog"]
    rows = []
    for i in range(40):
        rows.append((i, base[i % 3] + (" new york city hot" if i % 5 == 0 else ""), None if i % 7 == 0 else "en",
                     "s", 0))
    rows += [(100, None, "en", "s", 0), (101, "", None, "s", 0), (102, "x " * 5000 + "y", "de", "s", 0),
             (103, "a b c. a b c. a b c. a b c. a b c. a b c. a b c. a b c. a b c. a b c. a b c.", "de", "s", 0)]
    return rows


def test_against_sql(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(phrases, "BROADCAST_WORDS", 0)  # the shuffled join as well
    df = spark.createDataFrame(fixture(), DOCS)
    got = sorted(tuple(r) for r in phrases.collocations(df).collect())
    df.toPandas().to_parquet(tmp_path / "d.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path / 'd.parquet'}'")
    want = sorted(tuple(r) for r in con.execute(oracles.COLLOCATIONS).fetchall())
    assert got == want and len(got) > 3


def test_empty(spark):
    assert phrases.collocations(spark.createDataFrame([], DOCS)).count() == 0


def test_rare_words_leave_gaps_and_nothing_else(spark, tmp_path):
    """Words below the count break n-grams at their place only; the same as counting all."""
    rows = [(i, f"big red w{i} big red fox big red fox w{i} fox", "en", "s", 0) for i in range(30)]
    rows += [(100 + i, "red fox big", "en", "s", 0) for i in range(12)]
    df = spark.createDataFrame(rows, DOCS)
    got = sorted(tuple(r) for r in phrases.collocations(df).collect())
    df.toPandas().to_parquet(tmp_path / "d.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path / 'd.parquet'}'")
    want = sorted(tuple(r) for r in con.execute(oracles.COLLOCATIONS).fetchall())
    assert got == want and any(r[2] == "big red fox" for r in got)


def test_filter_keys_are_two_words_in_the_shuffle(spark):
    grams = spark.createDataFrame([("en", 2, 2, 5, 7, 0), ("en", 3, 2, 5, 7, 0), ("en", 1, 3, 5, 7, 9)],
                                  "lang string, mult long, o int, a long, b long, c long")
    filt = phrases.ngram_filter(grams)
    assert sorted((r.o, r.a, r.b, r.c, r.f) for r in phrases.decoded(filt).collect()) == [(2, 5, 7, 0, 5), (3, 5, 7, 9, 1)]
    plan = filt._jdf.queryExecution().sparkPlan().toString()
    keys = [line for line in plan.splitlines() if "HashAggregate" in line]
    assert keys and all("hi#" in line and "quotient#" not in line.split("functions=")[0] for line in keys)


def test_small_ids_are_one_word_in_the_shuffle(spark):
    """Ids up to the largest that fit come back whole from one permuted long."""
    top = (1 << phrases.ID_BITS) - 1
    grams = [("en", 2, 2, 5, 7, 0), ("en", 3, 2, 5, 7, 0), ("en", 1, 3, 5, 7, 9), ("de", 4, 1, top, 0, 0), ("de", 1, 3, top, top, top),
             ("de", 6, 3, 1, top, 1)]
    df = spark.createDataFrame(grams, "lang string, mult long, o int, a long, b long, c long")
    filt = phrases.ngram_filter(df, narrow=True)
    assert sorted((r.lang, r.o, r.a, r.b, r.c, r.f) for r in phrases.decoded(filt, narrow=True).collect()) == [
        ("de", 1, top, 0, 0, 4), ("de", 3, 1, top, 1, 6), ("de", 3, top, top, top, 1), ("en", 2, 5, 7, 0, 5), ("en", 3, 5, 7, 9, 1)]
    wide = phrases.decoded(phrases.ngram_filter(df)).collect()
    assert sorted(map(tuple, wide)) == sorted(map(tuple, phrases.decoded(filt, narrow=True).select(wide[0].__fields__).collect()))


def test_grams_are_counted_in_the_task(spark, monkeypatch):
    """What repeats in a task leaves it once; gaps and the ends of pieces break n-grams."""
    parts = spark.createDataFrame([("en", ["a", "b", "a", "b", "a"], 2), ("en", ["a", "x", "b", "a"], 1), ("de", ["a", "b"], 5), ("de", ["x"], 1)],
                                  "lang string, words array<string>, mult long").coalesce(1)
    vocab = spark.createDataFrame([("a", 1), ("b", 2)], "word string, id long")
    want = [("de", 5, 1, 1, 0, 0), ("de", 5, 1, 2, 0, 0), ("de", 5, 2, 1, 2, 0), ("en", 2, 3, 2, 1, 2), ("en", 4, 2, 1, 2, 0),
            ("en", 4, 3, 1, 2, 1), ("en", 5, 1, 2, 0, 0), ("en", 5, 2, 2, 1, 0), ("en", 8, 1, 1, 0, 0)]
    assert sorted(map(tuple, phrases.id_grams(parts, vocab, 2).collect())) == want


def test_only_pieces_beyond_ascii_are_translated(spark):
    texts = ["Hot DOG", "ÄBC Hot", "\u212aK İI", "", " ", "AZaz[\\]^_`@", "\x00A\x7f"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", phrases.lowered(F.col("t")).alias("low"))
    assert "lower(" in df._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.t, r.low) for r in df.collect()] == [(t, t.translate(str.maketrans(phrases.UPPER, phrases.LOWER))) for t in texts]
