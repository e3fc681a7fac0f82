"""Quality rules by weak supervision, in DataFrame expressions only.

Each rule votes for a good text (1) or a bad one (-1) or abstains (0). For both classes
a rule has the accuracy of its votes; expectation-maximisation estimates these and the
share of good texts from how the votes agree, and a text is kept by its posterior
probability rather than by passing every rule. Texts enter the estimate as the counts of
their vote patterns, of which there are three to the power of the rules at most.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from saldoflow.functions.scalars import once
from saldoflow.llm.common import SPACES, words
from saldoflow.llm.components import cut

#: Steps of expectation-maximisation.
STEPS = 12
#: Start: share of good texts, accuracy of a vote on good and on bad texts. A rule sees
#: one kind of fault, so most bad texts pass most rules.
START = (0.8, 0.95, 0.3)
_LOW = (1 << 31) - 1


def let(value: Column, f) -> Column:
    """``f`` of a value that is worked out once."""
    return F.transform(F.array(value), f)[0]


def _beside(sorted_: Column, key) -> Column:
    """Those items of a sorted array whose key equals that of a neighbour."""
    last = F.size(sorted_) - 1
    same = lambda a, b: key(F.get(sorted_, a)) == key(F.get(sorted_, b))
    at = F.filter(F.sequence(F.lit(0), last), lambda k: ((k > 0) & same(k, k - 1)) | ((k < last) & same(k, k + 1)))
    return F.transform(at, lambda k: F.get(sorted_, k))


def n_repeat_words(ws: Column) -> Column:
    """Words of an array that lie in a window of three that it holds twice or more.

    Windows are sorted by 33 bits of a hash joined with their place; those beside an
    equal hash are then compared as text, so a collision does not count.
    """
    hashed = F.transform(F.sequence(F.lit(0), F.size(ws) - 3), lambda i: F.shiftleft(
        F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)), 31).bitwiseOR(i.cast("long")))
    window = lambda p: F.concat_ws(" ", F.get(ws, p), F.get(ws, p + 1), F.get(ws, p + 2))
    candidates = let(F.sort_array(hashed), lambda s: F.transform(
        _beside(s, lambda x: F.shiftright(x, 31)), lambda x: x.bitwiseAND(F.lit(_LOW)).cast("int")))
    exact = let(F.sort_array(F.transform(candidates, lambda p: F.struct(window(p).alias("w"), p.alias("p")))),
                lambda s: F.when(F.size(s) > 0, F.sort_array(
                    F.transform(_beside(s, lambda x: x["w"]), lambda x: x["p"]))).otherwise(
                    F.array().cast("array<int>")))
    covered = F.aggregate(exact, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
                          lambda a, p: F.struct((a["n"] + p + 3 - F.greatest(p, a["end"])).alias("n"),
                                                (p + 3).alias("end")), lambda a: a["n"])
    return F.when(F.size(ws) < 4, F.lit(0)).otherwise(covered).cast("long")


def _count(text: Column, pattern: str) -> Column:
    """Characters of a text that match a class."""
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))).cast("long")


def measures(docs: DataFrame) -> DataFrame:
    """doc_id with what the rules look at, for every row; a null text counts as empty."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = once(texts, ws=words(F.col("text")))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    return once(
        texts,
        n_words=F.size("ws").cast("long"),
        word_chars=F.char_length(F.array_join("ws", "")).cast("long"),
        n_symbols=_count(F.col("text"), r"[#*$%&|<>]+"),
        lines=let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"),
                                            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))),
        n_repeat_words=n_repeat_words(F.col("ws")),
        n_distinct=F.size(F.array_distinct("ws")),
        n_upper=_count(F.col("text"), "[A-Z]+"),
        n_shouts=_count(F.col("text"), "!+"),
        n_stops=_count(F.col("text"), "[.]+"),
        n_marks=_count(F.col("text"), r"[^\p{L}\p{N}\x20\x09-\x0D]+"),
        n_bare=F.regexp_count("text", F.lit(r"(?<![^\x20\x09-\x0D])[^\p{L}\p{N}\x20\x09-\x0D]+(?![^\x20\x09-\x0D])")),
        n_short=F.size(F.filter("ws", lambda w: (F.char_length(w) <= 3) & (F.lower(w) != F.upper(w)))),
        n_runs=F.regexp_count("text", F.lit(r"([#*$%&|<>])\1")),
    ).select("doc_id", "n_words", "word_chars", "n_symbols", F.col("lines.n").alias("n_lines"),
             F.col("lines.dup").alias("n_dup_lines"), "n_repeat_words", "n_distinct", "n_upper",
             "n_shouts", "n_stops", "n_marks", "n_bare", "n_runs", "n_short")


def votes() -> dict[str, Column]:
    """Each rule's vote from the measures. A text without words gets no vote."""
    per = {n: F.col(n) / F.col("n_words") for n in (
        "n_symbols", "n_repeat_words", "n_distinct", "n_shouts", "n_stops", "word_chars", "n_bare", "n_runs", "n_short")}
    marks = F.col("n_marks") / F.greatest("word_chars", F.lit(1))
    upper = F.col("n_upper") / F.greatest("word_chars", F.lit(1))
    lines = F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))
    rules = {
        "symbols": (per["n_symbols"] < 0.05, per["n_symbols"] > 0.2),
        "repeats": (per["n_repeat_words"] < 0.2, per["n_repeat_words"] > 0.4),
        "variety": (per["n_distinct"] > 0.4, per["n_distinct"] < 0.2),
        "lines": (F.col("n_dup_lines") == 0, lines > 0.3),
        "capitals": (upper < 0.2, upper > 0.4),
        "shouts": (per["n_shouts"] < 0.05, per["n_shouts"] > 0.2),
        "sentences": (per["n_stops"] > 0.05, per["n_stops"] < 0.03),
        "word_length": (per["word_chars"].between(3, 9), ~per["word_chars"].between(2, 12)),
        "marks": (marks < 0.15, marks > 0.25),
        "bare_words": (per["n_bare"] < 0.05, per["n_bare"] > 0.15),
        "short_words": (per["n_short"] > 0.15, per["n_short"] < 0.08),
        "symbol_runs": (per["n_runs"] < 0.05, per["n_runs"] > 0.2),
        "length": (F.col("n_words") >= 100, F.col("n_words") < 50),
    }
    return {name: F.when(F.col("n_words") == 0, 0).when(bad, -1).when(good, 1).otherwise(0)
            for name, (good, bad) in rules.items()}


def _log_odds(names: list[str], prior: float, right: dict[str, tuple[float, float]]) -> Column:
    """Log odds of a good text. right: a rule's accuracy on good and on bad texts."""
    total = F.lit(math.log(prior / (1 - prior)))
    for n in names:
        good, bad = right[n]
        total = total + F.when(F.col(n) == 1, math.log(good / (1 - bad))).when(
            F.col(n) == -1, math.log((1 - good) / bad)).otherwise(0.0)
    return total


def fit(patterns: DataFrame, names: list[str], steps: int = STEPS) -> tuple[float, dict]:
    """Share of good texts and accuracies from vote patterns with their counts ``n``.

    Each step is one aggregate over the patterns. One text is added to either class
    with the start's accuracies, so no estimate rests on nothing; without any texts the
    start is returned.
    """
    prior, right = START[0], {n: START[1:] for n in names}
    for _ in range(steps):
        good = 1 / (1 + F.exp(-_log_odds(names, prior, right)))
        rows = patterns.withColumn("good", good)
        sums = [F.sum(F.col("n") * F.col("good")).alias("good"), F.sum("n").alias("all")]
        for n in names:
            for vote, sign in (("up", 1), ("down", -1)):
                sums.append(F.sum(F.when(F.col(n) == sign, F.col("n") * F.col("good"))).alias(f"{n}_{vote}_good"))
                sums.append(F.sum(F.when(F.col(n) == sign, F.col("n") * (1 - F.col("good")))).alias(f"{n}_{vote}_bad"))
        found = {k: v or 0.0 for k, v in rows.agg(*sums).first().asDict().items()}
        prior = (found["good"] + START[0]) / (found["all"] + 1)
        for n in names:
            good = (found[f"{n}_up_good"] + START[1]) / (found[f"{n}_up_good"] + found[f"{n}_down_good"] + 1)
            bad = (found[f"{n}_down_bad"] + START[2]) / (found[f"{n}_up_bad"] + found[f"{n}_down_bad"] + 1)
            good = min(max(good, 0.5), 0.9999)
            # A bad vote stays at least twice as likely on a bad text, so no rule turns round.
            right[n] = good, min(max(bad, 2 * (1 - good)), 0.9999)
    return prior, right


def judge(docs: DataFrame, threshold: float = 0.5, steps: int = STEPS) -> DataFrame:
    """Measures, base_failed, posterior and kept for every row of ``docs``.

    base_failed: fewer than 50 words, or over half of them in repeated windows; such a
    text is not kept whatever its posterior. Null and empty texts fail. Repeated rows
    each count and each get a row; columns beyond doc_id and text are not read. A posterior
    of exactly ``threshold`` is kept. An empty table gives an empty one.
    """
    rules = votes()
    voted = cut(measures(docs).withColumns(rules))
    names = list(rules)
    patterns = cut(voted.groupBy(*names).agg(F.count("*").alias("n")))
    prior, right = fit(patterns, names, steps)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    posterior = 1 / (1 + F.exp(-_log_odds(names, prior, right)))
    return voted.withColumn("base_failed", failed).withColumn("posterior", posterior).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
