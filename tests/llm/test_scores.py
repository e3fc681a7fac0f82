"""Classifiers, rules and language model on small tables and on held-out labels."""

from collections import Counter
import math
from pathlib import Path
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from saldoflow.llm import language, preference, queries, rules, toxicity
from saldoflow.llm.common import crc_mod, word_bytes

FOLDER = "/root/testdata/sf0.01"
given = pytest.mark.skipif(not Path(FOLDER).exists(), reason="given tables are not here")
ODD = [(1, None), (2, ""), (3, " \n "), (4, "a"), (5, "good words here. " * 30), (5, "good words here. " * 30),
       (None, "x y z"), (7, "w" * 100_000), (8, "long text " * 20_000)]
DOCS = "doc_id long, text string"


def odd(spark):
    return spark.createDataFrame(ODD, DOCS).selectExpr("*", "'z' AS score", "1 AS n_words", "2 AS kept", "3 AS label")


def held_out_accuracy(spark, name, label):
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = [r for r in queries.QUERIES[name](spark, FOLDER).collect() if r.held_out and r.doc_id in truth]
    assert all(0 <= r.score <= 1 for r in rows)
    return sum(r.predicted == truth[r.doc_id] for r in rows) / len(rows)


@given
def test_quality_of_held_out_documents(spark):
    assert held_out_accuracy(spark, "op3_quality", "quality") > 0.95


@given
def test_toxicity_of_held_out_documents(spark):
    assert held_out_accuracy(spark, "op7_toxicity", "toxic") > 0.9


def test_ranking_learns_the_order():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(400, preference.WIDTH))
    y = (x[:, 3] - 0.5 * x[:, 7] > -0.8).astype(int)
    model = preference.fit(x, y, y.mean())
    s = (x - model["mean"]) @ model["weights"] - model["cut"]
    assert ((s >= 0) == (y == 1)).mean() > 0.97


@pytest.mark.parametrize("labels", [[], [(5, 1)], [(5, 0), (8, None)], [(5, 1), (5, 0), (4, 0), (None, 1)]])
def test_quality_with_hardly_any_labels(spark, labels):
    frame = spark.createDataFrame(labels, "doc_id long, quality int")
    model = preference.learn(odd(spark), frame)
    got = preference.score(odd(spark), model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    if len(labels) == 1:
        assert all(r.score >= 0.5 for r in got)
    assert preference.score(odd(spark).limit(0), model).collect() == []


@pytest.mark.parametrize("labels", [[], [(5, 1)], [(5, 0), (8, None)]])
def test_toxicity_with_hardly_any_labels(spark, labels):
    frame = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.learn(odd(spark), frame)
    got = toxicity.score(odd(spark), model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(odd(spark).limit(0), model).collect() == []


@pytest.mark.parametrize("share", [0.4, 0.6])
def test_toxicity_where_many_texts_are_toxic(spark, share):
    draw = random.Random(2)
    toxic = [k < 300 * share for k in range(300)]
    rows = [(k, " ".join([*draw.choices(["river", "stone", "light", "paper"], k=6), *["venom"] * t])) for k, t in enumerate(toxic)]
    docs = spark.createDataFrame(rows, DOCS)
    model = toxicity.learn(docs, spark.createDataFrame(list(enumerate(map(int, toxic))), "doc_id long, toxic int"))
    assert "venom" in model and "river" not in model
    assert all((r.score >= 0.3) == toxic[r.doc_id] for r in toxicity.score(docs, model).collect())


def test_non_negative_risk_separates_positives_among_unlabelled():
    draw = np.random.default_rng(0)
    toxic = draw.random(1500) < 0.2
    rows = [[0] * bool(t and draw.random() < 0.9) + [1] * (draw.random() < 0.5) + [2] * (draw.random() < 0.5) for t in toxic]
    kinds = np.zeros(1500, int)
    kinds[np.flatnonzero(toxic)[:100]] = 1
    w = toxicity.fit(rows, kinds, 3, 0.2)
    f = np.array([w[-1] + sum(w[k] for k in r) for r in rows])
    has = np.array([0 in r for r in rows])
    assert f[has].min() > 0 > f[~has].max()


def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {p for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_rule_measures(spark):
    rows = [(i, t) for i, (_, t) in enumerate(ODD)] + [
        (20, "a b c a b c"), (21, "a a a a"), (22, "a a a"), (23, "ä b\nä b\n\n \nä b\x0bc"), (24, "#1 *|* <é> &%$"),
        (25, "x y z q x y z x y z")]
    frame = spark.createDataFrame(rows, DOCS).selectExpr("*", "9 AS n_words", "8 AS ws")
    got = {r.doc_id: tuple(r)[1:] for r in rules.judge(frame).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()}
    assert got == {i: plain_measures(t) for i, t in rows}
    assert rules.judge(frame.limit(0)).collect() == []


@given
def test_rules_keep_by_the_posterior(spark):
    """The estimate in plain Python, over documents instead of patterns."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = rules.judge(docs).collect()
    names = list(rules.votes())
    share, *start = rules.START
    right = {n: tuple(start) for n in names}

    def odds(r):
        total = math.log(share / (1 - share))
        for n in names:
            good, bad = right[n]
            total += {1: math.log(good / (1 - bad)), -1: math.log((1 - good) / bad), 0: 0.0}[r[n]]
        return total

    for _ in range(rules.STEPS):
        p = [1 / (1 + math.exp(-odds(r))) for r in got]
        new = {}
        for n in names:
            up_good = sum(x for r, x in zip(got, p) if r[n] == 1)
            down_good = sum(x for r, x in zip(got, p) if r[n] == -1)
            up_bad = sum(1 - x for r, x in zip(got, p) if r[n] == 1)
            down_bad = sum(1 - x for r, x in zip(got, p) if r[n] == -1)
            good = min(max((up_good + start[0]) / (up_good + down_good + 1), 0.5), 0.9999)
            bad = (down_bad + start[1]) / (up_bad + down_bad + 1)
            new[n] = good, min(max(bad, 2 * (1 - good)), 0.9999)
        share, right = (sum(p) + rules.START[0]) / (len(p) + 1), new
    for r in got:
        assert abs(r.posterior - 1 / (1 + math.exp(-odds(r)))) < 1e-6
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.posterior >= 0.5)
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    judged = [r for r in got if r.doc_id in truth and not r.base_failed]
    assert sum(r.kept == (truth[r.doc_id] == 1) for r in judged) / len(judged) > 0.95


def tokens_of(text):
    return (text or "").encode().lower().split() + [None]


def check_language(spark, docs, train, **sizes):
    rows = docs.collect()
    model = language.Model(train, **sizes)
    got = {}
    for r in language.score(docs, model).collect():
        got.setdefault(r.doc_id, []).append(r)
    counts = Counter(w for r in train.collect() for w in tokens_of(r.text))
    n, v = sum(counts.values()), len(counts)
    assert (model.tokens, model.types) == (n, v)
    units = len(model.unit) + 1
    of = lambda w: 0 if w is None else model.unit.get(w) or units + language.group_of(w)
    unit_n, unit_v, follow = Counter(), Counter(), Counter()
    for w, c in counts.items():
        unit_n[of(w)] += c
        unit_v[of(w)] += 1
    for r in train.collect():
        path = [model.classes[of(w)] for w in [None, *tokens_of(r.text)]]
        follow.update(zip(path, path[1:]))
    n_class, first = Counter(), Counter()
    for (a, b), c in follow.items():
        n_class[b] += c
        first[a] += c
    kinds = Counter(model.classes.tolist())
    total = sum(n_class.values()) + 0.1 * len(kinds)

    def log_p(before, w):
        a, b, u = model.classes[of(before)], model.classes[of(w)], of(w)
        p = (follow[a, b] + (n_class[b] + 0.1) / total) / (first[a] + 1)
        p *= (unit_n[u] + 0.1) / (n_class[b] + 0.1 * kinds[b])
        if u >= units:
            p *= (counts[w] + 0.1) / (unit_n[u] + 0.1 * (unit_v[u] + 1))
        return math.log10(p)

    for r in rows:
        path = tokens_of(r.text)
        want = (len(path), sum(counts[w] > 0 for w in path))
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in path)
        score = sum(log_p(a, b) for a, b in zip([None, *path], path))
        assert any((x.n_tokens, x.n_known) == want and abs(x.base_score - base) < 1e-6 * max(1, abs(base))
                   and abs(x.score - score) < 1e-6 * max(1, abs(score)) for x in got[r.doc_id]), r.doc_id
    assert sum(map(len, got.values())) == len(rows)


@given
@pytest.mark.parametrize("lexicon", [200_000, 60, 0])
def test_language_scores_are_those_of_the_model(spark, lexicon):
    docs = spark.read.parquet(FOLDER.replace("0.01", "0.001") + "/documents.parquet").select("doc_id", "text")
    check_language(spark, docs, docs.filter(crc_mod(docs.doc_id, 10) != 0), words=50, lexicon_size=lexicon, classes=8)


def test_language_of_odd_texts(spark):
    docs = odd(spark)
    check_language(spark, docs, docs, words=5, classes=3)
    check_language(spark, docs, docs.limit(0))
    assert language.score(docs.limit(0), language.Model(docs)).collect() == []


@pytest.mark.parametrize("portion", [1, 60, 4 << 20])
def test_words_are_split_and_found_many_texts_at_a_time(monkeypatch, portion):
    """As text by text: the same words, and the words without a place numbered in each text."""
    monkeypatch.setattr(language, "PORTION", portion)
    draw = random.Random(1)
    signs = [*" \t\n\x0b\x0c\r\x1c\x1f\x85\xa0\u2003\x00", "A", "b", "É", "İ", "x", "Z"]
    texts = [None, "", " ", *("".join(draw.choice(signs) for _ in range(draw.randrange(30))) for _ in range(500))]
    place, got, found = {b"a": 0, b"b": 1, b"x": 2}, [], []
    for words, at, lengths in language.portions(pa.array(texts)):
        assert len(set(words.to_pylist())) == len(words)
        got += np.split(np.array(words.to_pylist(), object)[at], np.cumsum(lengths)[:-1])
    for known, rest, n in language._found(pa.array(texts), place):
        found += zip(known, np.split(np.array(rest.to_pylist(), object), np.cumsum(n)[:-1]))
    assert [list(x) for x in got] == [word_bytes(t) for t in texts]
    for text, (known, rest) in zip(texts, found, strict=True):
        words = word_bytes(text)
        assert list(rest) == list(dict.fromkeys(w for w in words if w not in place))
        assert known.tolist() == [place[w] if w in place else -1 - list(rest).index(w) for w in words]


def test_keys_are_counted_alike_with_and_without_sorting():
    keys = [np.array([5, 1, 5]), np.zeros(0, np.int64), np.array([7, 1, 1])]
    for size in (None, 8, 20, language.DENSE + 1):
        key, n = language._summed(keys, size)
        assert key.tolist() == [1, 5, 7] and n.tolist() == [3, 2, 1]


@given
def test_classes_beat_single_words(spark):
    rows = [r for r in queries.QUERIES["op5_brown"](spark, FOLDER).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_exchange_ends_where_no_move_gains():
    pairs = np.random.default_rng(0).poisson(2, (30, 30)).astype(float)

    def likelihood(cls, classes):
        member = np.eye(classes)[cls]
        table = member.T @ pairs @ member
        g = lambda x: (x * np.log(np.maximum(x, 1e-300))).sum()
        return g(table) - g(table.sum(0)) - g(table.sum(1))

    for classes in (3, 5):
        cls = language.exchange(pairs, classes)
        found = likelihood(cls, classes)
        moves = [likelihood(np.where(np.arange(30) == u, b, cls), classes) for u in range(1, 30) for b in range(1, classes)]
        assert max(moves) <= found + 1e-6
        assert found > likelihood(np.r_[0, 1 + np.arange(29) % (classes - 1)], classes)
        assert cls[0] == 0 and 0 not in cls[1:]


def test_unit_of_group_is_the_same_in_sql(spark):
    for w in (b"a", b"ab", b"abc", "schön".encode(), b""):
        row = spark.createDataFrame([(bytearray(w),)], "word binary").selectExpr(
            f"crc32(substring(word, -3, 3)) % {language.GROUPS} AS g").first()
        assert row.g == language.group_of(w) == zlib.crc32(w[-3:]) % language.GROUPS


def test_words_are_placed_as_by_exchange():
    draw = np.random.default_rng(1)
    pairs = draw.poisson(1.5, (40, 40)).astype(float)
    cls = np.r_[0, 1 + np.arange(39) % 4]
    member = np.eye(5)[cls]
    table, after, before, twice = member.T @ pairs @ member, pairs @ member, pairs.T @ member, pairs.diagonal()
    each = np.arange(40)
    after[each, cls] -= twice
    before[each, cls] -= twice
    got = language.placed(after[1:], before[1:], twice[1:], cls[1:], table)

    def likelihood(u, b):
        member = np.eye(5)[np.where(each == u, b, cls)]
        t = member.T @ pairs @ member
        g = lambda x: (x * np.log(np.maximum(x, 1))).sum()
        return g(t) - g(t.sum(0)) - g(t.sum(1))

    assert got.tolist() == [1 + int(np.argmax([likelihood(u, b) for b in range(1, 5)])) for u in range(1, 40)]


@pytest.mark.parametrize("lexicon", [200_000, 40])
def test_every_word_has_a_class_of_its_own(spark, monkeypatch, lexicon):
    """Words beyond the head follow what stands around them, not their last bytes; the class
    bigrams and scores are those of all words' classes."""
    monkeypatch.setattr(language, "WORDS", 12)
    draw = random.Random(3)
    nouns, verbs = [f"n{k}x" for k in range(60)], [f"v{k}x" for k in range(60)]
    pick = lambda words: words[min(int(draw.expovariate(0.08)), 59)]
    texts = [" ".join(w for _ in range(8) for w in ("the", pick(nouns), "will", pick(verbs))) for _ in range(250)]
    frame = spark.createDataFrame([*enumerate(texts), (900, "the new1 will v2x"), (901, None)], DOCS)
    train = frame.filter("doc_id <> 900")
    model = language.Model(train, classes=8, lexicon_size=lexicon)
    units = len(model.unit) + 1
    group = {**{bytes(r.word): r.g for r in model.counts.collect()}, **model.group}
    unit = lambda w: 0 if w is None else model.unit.get(w) or units + group.get(w, model.unseen[language.group_of(w)])
    of = lambda w: int(model.classes[unit(w)])
    counts = Counter(w for r in train.collect() for w in tokens_of(r.text))
    assert {w for w in counts if w} == set(group) | set(model.unit)
    noun_of, verb_of = ({of(w.encode()) for w in words if counts[w.encode()] > 4} for words in (nouns, verbs))
    assert not noun_of & verb_of
    follow, first, unit_n, unit_v = Counter(), Counter(), Counter(), Counter()
    for r in train.collect():
        path = [of(w) for w in [None, *tokens_of(r.text)]]
        follow.update(zip(path, path[1:]))
        first.update(path[:-1])
    for w, c in counts.items():
        unit_n[unit(w)] += c
        unit_v[unit(w)] += 1
    n_class, kinds = Counter(), Counter(model.classes.tolist())
    for (_, b), c in follow.items():
        n_class[b] += c
    total = sum(n_class.values()) + 0.1 * len(kinds)
    for r in language.score(frame, model).collect():
        want, path = 0.0, [None, *tokens_of(dict(frame.collect())[r.doc_id])]
        for a, w in zip(path, path[1:]):
            b, u = of(w), unit(w)
            p = (follow[of(a), b] + (n_class[b] + 0.1) / total) / (first[of(a)] + 1)
            p *= (unit_n[u] + 0.1) / (n_class[b] + 0.1 * kinds[b])
            want += math.log10(p * ((counts[w] + 0.1) / (unit_n[u] + 0.1 * (unit_v[u] + 1)) if u >= units else 1))
        assert abs(r.score - want) < 1e-6 * abs(want)
