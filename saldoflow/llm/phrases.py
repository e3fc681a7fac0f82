"""Phrase collocations counted in quotient filters of packed word-id n-grams.

Texts are cut into pieces at punctuation and line ends; equal pieces of a language
are counted once with their multiplicity (shared lines and passages collapse there,
combined before the shuffle). Words that occur ``least`` times get global ids from the
sorted vocabulary; no phrase with a rarer word can occur as often, so the others leave
gaps and are not counted further (the first step of Apriori). Every n-gram of 1 to 3 word
ids is packed into 128 bits (order, id, id, id), or into 64 where three ids fit them,
permuted by an invertible keyed Feistel network, and split into a quotient (the high bits, the slot
of a quotient filter) and the full remainder (all other bits), so nothing is lost.
Each task's counters are a partial filter; Spark's aggregation merges the filters of
all tasks by (quotient, remainder), summing counts. Inverting the permutation gives
back the ids of every counted n-gram.

Candidates are 2- and 3-word n-grams with at least ``least`` occurrences; each cut
into a first part and a rest is scored floor(10^6 * a^2 / (l * r)) in exact
decimals, the lowest cut counting. A candidate lying inside a longer candidate whose
count is at least half its own is dropped. Each language keeps its first ``top``.

Defined cases: a null text is empty, a null lang is ``und``; empty texts and pieces
add nothing; repeated rows count each time; ties in score go by count, then phrase
in UTF-8 byte order; an empty table gives no rows. Words are whole, however long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from saldoflow.operators.ordering import global_position
from saldoflow.session import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PIECE_BREAK = "[.,;:!?\\x0A-\\x0D]"
WORD_BREAK = "[\\x20\\x09]+"
#: Bits of the quotient; the remainder holds the other 128 - QUOTIENT_BITS.
QUOTIENT_BITS = 20
#: Keys of the Feistel rounds.
ROUNDS = (11, 23, 37, 41)
#: Vocabularies up to this many words travel with the tasks; larger ones are joined by a shuffle.
BROADCAST_WORDS = 2_000_000
#: Bits that hold an id of a vocabulary that travels; three of them fit a long.
ID_BITS = 21
_ID = (1 << ID_BITS) - 1
#: Words of pieces that a task takes before it passes the counts of their n-grams on.
HELD_TOKENS = 1_000_000
_LOW32 = (1 << 32) - 1
_REM = (1 << (64 - QUOTIENT_BITS)) - 1


def pack(order: Column, a: Column, b: Column, c: Column) -> tuple[Column, Column]:
    """(hi, lo) of an n-gram: order and first id in hi, second and third in lo; 0 is no word."""
    return (F.shiftleft(order.cast("long"), 32).bitwiseOR(a.cast("long")),
            F.shiftleft(b.cast("long"), 32).bitwiseOR(c.cast("long")))


def _rounds(df: DataFrame, hi: str, lo: str, keys) -> DataFrame:
    for k in keys:
        df = df.select(*[c for c in df.columns if c not in (hi, lo)], F.col(lo).alias(hi),
                       F.col(hi).bitwiseXOR(F.xxhash64(F.col(lo), F.lit(k))).alias(lo))
    return df


def permute(df: DataFrame, hi: str = "hi", lo: str = "lo") -> DataFrame:
    return _rounds(df, hi, lo, ROUNDS)


def unpermute(df: DataFrame, hi: str = "hi", lo: str = "lo") -> DataFrame:
    """The inverse of :func:`permute`: rounds backwards with the halves swapped."""
    swapped = df.withColumnRenamed(hi, "_t").withColumnRenamed(lo, hi).withColumnRenamed("_t", lo)
    back = _rounds(swapped, hi, lo, reversed(ROUNDS))
    return back.withColumnRenamed(hi, "_t").withColumnRenamed(lo, hi).withColumnRenamed("_t", lo).select(*df.columns)


def _halves(df: DataFrame, key: str, keys) -> DataFrame:
    """The network over the 32-bit halves of one long instead of two longs."""
    hi, lo = F.shiftrightunsigned(key, 32), F.col(key).bitwiseAND(F.lit(_LOW32))
    df = df.select(*[c for c in df.columns if c != key], hi.alias("_hi"), lo.alias("_lo"))
    for k in keys:
        df = df.select(*[c for c in df.columns if c not in ("_hi", "_lo")], F.col("_lo").alias("_hi"), F.col("_hi").bitwiseXOR(
            F.xxhash64(F.col("_lo"), F.lit(k)).bitwiseAND(F.lit(_LOW32))).alias("_lo"))
    return df


def permute_narrow(df: DataFrame, key: str = "key") -> DataFrame:
    """:func:`permute` for n-grams whose three ids fit one long."""
    done = _halves(df, key, ROUNDS)
    return done.withColumn(key, F.shiftleft("_hi", 32).bitwiseOR(F.col("_lo"))).select(*df.columns)


def unpermute_narrow(df: DataFrame, key: str = "key") -> DataFrame:
    swapped = df.withColumn(key, F.shiftleft(key, 32).bitwiseOR(F.shiftrightunsigned(key, 32)))
    done = _halves(swapped, key, reversed(ROUNDS))
    return done.withColumn(key, F.shiftleft("_lo", 32).bitwiseOR(F.col("_hi"))).select(*df.columns)


def lowered(piece: Column) -> Column:
    """A-Z lowered. ``translate`` looks up sign after sign, which only texts beyond ASCII need."""
    return F.when(F.octet_length(piece) == F.length(piece), F.lower(piece)).otherwise(F.translate(piece, UPPER, LOWER))


def pieces(documents: DataFrame) -> DataFrame:
    """(lang, words, mult): each distinct word sequence of a piece per language, with its count."""
    cut = documents.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), F.explode(
        F.split(F.coalesce(F.col("text"), F.lit("")), PIECE_BREAK)).alias("piece")).withColumn("piece", lowered(F.col("piece")))
    counted = cut.groupBy("lang", "piece").agg(F.count("*").alias("mult"))
    words = F.filter(F.split("piece", WORD_BREAK), lambda w: w != "")
    return counted.select("lang", words.alias("words"), "mult").filter(F.size("words") > 0)


def vocabulary(parts: DataFrame, least: int = 1) -> DataFrame:
    """(word, id): ids 1, 2, ... in word order for the words that occur ``least`` times
    over all languages. A rarer word can be in no n-gram that occurs as often (a phrase
    occurs no more often than each of its words), so it gets no id."""
    counted = parts.select(F.explode("words").alias("word"), "mult").groupBy("word").agg(F.sum("mult").alias("_n"))
    placed = global_position(counted.filter(F.col("_n") >= least).select("word"), ["word"], "_pos")
    return placed.select("word", (F.col("_pos") + 1).alias("id"))


def id_grams(parts: DataFrame, vocab: DataFrame, n_words: int) -> DataFrame:
    """(lang, mult, o, a, b, c): every 1- to 3-gram of the pieces whose words all have ids;
    0 is no word.

    ``parts`` carry a stable ``_piece`` key. Words get their ids by a join and keep their
    position; the next two ids of the same piece come from ``lead`` over the piece's
    words, so a piece is sorted once and never gathered into one row again.
    """
    if n_words >= _LOW32:
        raise ValueError("more distinct words than 32-bit ids hold")
    if n_words <= BROADCAST_WORDS:
        return _grams_in_place(parts, vocab)
    tokens = parts.select("_piece", "lang", "mult", F.posexplode("words").alias("pos", "word"))
    table = vocab
    # Words without an id (too rare) drop out before the shuffle; they leave a gap in the
    # positions, and no n-gram spans a gap.
    ids = tokens.join(table, "word")
    along = Window.partitionBy("_piece").orderBy("pos")
    nxt = lambda k: F.when(F.lead("pos", k).over(along) == F.col("pos") + k, F.lead("id", k).over(along))
    ahead = ids.select("lang", "mult", "id", nxt(1).alias("id2"), nxt(2).alias("id3"))
    zero = F.lit(0).cast("long")
    gram = lambda o, b, c: F.struct(F.lit(o).alias("o"), F.col("id").alias("a"), b.alias("b"), c.alias("c"))
    grams = F.array(gram(1, zero, zero),
                    F.when(F.col("id2").isNotNull(), gram(2, F.col("id2"), zero)),
                    F.when(F.col("id2").isNotNull() & F.col("id3").isNotNull(), gram(3, F.col("id2"), F.col("id3"))))
    return (ahead.select("lang", "mult", F.explode(grams).alias("g")).filter(F.col("g").isNotNull())
            .select("lang", "mult", "g.*"))


def _grams_in_place(parts: DataFrame, vocab: DataFrame) -> DataFrame:
    """:func:`id_grams` where the vocabulary travels with the tasks: the n-grams are formed
    from each piece's word array where it lies, so the pieces are not shuffled again, and
    those of a task are counted together before they leave it. An n-gram with a word
    without id is dropped, as that word leaves a gap in the other way.
    """
    table = vocab.select("word", "id").toArrow()  # BROADCAST_WORDS bounds it
    shared = parts.sparkSession.sparkContext.broadcast(
        dict(zip(table.column("word").to_pylist(), table.column("id").to_pylist())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, held, tokens = shared.value.get, {}, 0
        for batch in batches:
            lists, mults = batch.column("words"), batch.column("mult").to_numpy()
            coded = lists.flatten().dictionary_encode()
            ids = np.array([find(w, 0) for w in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy()]
            owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            langs = batch.column("lang").dictionary_encode()
            of_piece = langs.indices.to_numpy()
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                mine = of_piece[owner] == k
                held.setdefault(lang, []).append(_packed(ids[mine], owner[mine], mults))
            tokens += len(ids)
            if tokens >= HELD_TOKENS:
                yield from counted(held)
                held, tokens = {}, 0
        yield from counted(held)

    def counted(held: dict) -> Iterator[pa.RecordBatch]:
        for lang, found in held.items():
            key, mult = (np.concatenate(x) for x in zip(*found))
            if not len(key):
                continue
            order = np.argsort(key)
            key = key[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            key, mult = key[first], np.add.reduceat(mult[order], first)
            ids = [key >> 2 * ID_BITS, key >> ID_BITS & _ID, key & _ID]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang], pa.string()).take(pa.array(np.zeros(len(key), np.int32))), pa.array(mult),
                 pa.array((1 + (ids[1] > 0) + (ids[2] > 0)).astype(np.int32)), *map(pa.array, ids)],
                names=["lang", "mult", "o", "a", "b", "c"])

    return parts.select("lang", "words", "mult").mapInArrow(run, "lang string, mult long, o int, a long, b long, c long")


def _packed(ids: np.ndarray, owner: np.ndarray, mults: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 1- to 3-grams of word ids as numbers of three times ``ID_BITS`` bits, and how often
    their pieces occur. ``owner`` is the piece of a word; id 0 is a gap."""
    one = ids > 0
    two = one[:-1] & one[1:] & (owner[:-1] == owner[1:])
    three = two[:-1] & two[1:]
    a, b = ids << 2 * ID_BITS, ids << ID_BITS
    return (np.concatenate([a[one], (a[:-1] | b[1:])[two], (a[:-2] | b[1:-1] | ids[2:])[three]]),
            np.concatenate([mults[owner[one]], mults[owner[:-1][two]], mults[owner[:-2][three]]]))


def ngram_filter(grams: DataFrame, narrow: bool = False) -> DataFrame:
    """(lang, quotient, rem_hi, rem_lo, f): counts of all 1- to 3-grams as merged quotient filters.

    Quotient and the high part of the remainder stay side by side in one word until the
    filters are merged: apart, each would be shuffled as a word of its own. ``narrow``
    says that ids have ``ID_BITS`` bits: then an n-gram is one word in all (its order shows
    in its zeros), and nothing is left for ``rem_hi``.
    """
    if narrow:
        key = F.shiftleft("a", 2 * ID_BITS).bitwiseOR(F.shiftleft("b", ID_BITS)).bitwiseOR(F.col("c"))
        merged = permute_narrow(grams.select("lang", "mult", key.alias("key"))).groupBy("lang", "key").agg(
            F.sum("mult").alias("f"))
        return merged.select("lang", F.shiftrightunsigned("key", 64 - QUOTIENT_BITS).cast("int").alias("quotient"),
                             F.lit(0).cast("long").alias("rem_hi"), F.col("key").bitwiseAND(F.lit(_REM)).alias("rem_lo"), "f")
    hi, lo = pack(F.col("o"), F.col("a"), F.col("b"), F.col("c"))
    keyed = permute(grams.select("lang", "mult", hi.alias("hi"), lo.alias("lo")))
    merged = keyed.groupBy("lang", "hi", "lo").agg(F.sum("mult").alias("f"))
    return merged.select("lang", F.shiftrightunsigned("hi", 64 - QUOTIENT_BITS).cast("int").alias("quotient"),
                         F.col("hi").bitwiseAND(F.lit(_REM)).alias("rem_hi"), F.col("lo").alias("rem_lo"), "f")


def decoded(filt: DataFrame, narrow: bool = False) -> DataFrame:
    """(lang, hi, lo, o, a, b, c, f): n-grams back from the filter."""
    high = F.shiftleft(F.col("quotient").cast("long"), 64 - QUOTIENT_BITS)
    if narrow:
        back = unpermute_narrow(filt.select("lang", "f", high.bitwiseOR(F.col("rem_lo")).alias("key")))
        ids = back.select("lang", "f", F.shiftrightunsigned("key", 2 * ID_BITS).alias("a"), F.shiftrightunsigned(
            "key", ID_BITS).bitwiseAND(F.lit(_ID)).alias("b"), F.col("key").bitwiseAND(F.lit(_ID)).alias("c"))
        ids = ids.withColumn("o", (1 + (F.col("b") > 0).cast("long") + (F.col("c") > 0).cast("long")))
        hi, lo = pack(F.col("o"), F.col("a"), F.col("b"), F.col("c"))
        return ids.select("lang", hi.alias("hi"), lo.alias("lo"), "f", "o", "a", "b", "c")
    back = unpermute(filt.select("lang", "f", high.bitwiseOR(F.col("rem_hi")).alias("hi"), F.col("rem_lo").alias("lo")))
    return back.select("lang", "hi", "lo", "f", F.shiftright("hi", 32).alias("o"),
                       F.col("hi").bitwiseAND(F.lit(_LOW32)).alias("a"),
                       F.shiftrightunsigned("lo", 32).alias("b"), F.col("lo").bitwiseAND(F.lit(_LOW32)).alias("c"))


def _score(a: str, left: str, right: str) -> Column:
    """floor(10^6 * a^2 / (left * right)) in exact decimals; integral division of positives is the floor."""
    return F.expr(f"(cast({a} as decimal(38,0)) * {a} * 1000000) div (cast({left} as decimal(38,0)) * {right})")


def collocations(documents: DataFrame, least: int = 10, top: int = 2000, share: int = 50) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's best 2- and 3-word phrases."""
    parts = settle(pieces(documents.select("lang", "text")).withColumn("_piece", F.monotonically_increasing_id()),
                   "phrase-parts")
    vocab = settle(vocabulary(parts, least), "phrase-vocab")
    n_words = vocab.count()
    seqs, narrow = id_grams(parts, vocab, n_words), n_words <= _ID
    # Only n-grams that occur ``least`` times are kept: every part of a candidate occurs as often as it.
    frequent = settle(decoded(ngram_filter(seqs, narrow).filter(F.col("f") >= least), narrow), "phrase-grams")
    n = parts.groupBy("lang").agg(F.sum(F.size("words") * F.col("mult")).cast("long").alias("n"))
    cand = frequent.filter(F.col("o") >= 2).select("lang", "hi", "lo", "o", "a", "b", "c", F.col("f").alias("cnt"))
    one = lambda x: pack(F.lit(1), x, F.lit(0), F.lit(0))
    two = lambda x, y: pack(F.lit(2), x, y, F.lit(0))
    need = lambda k, side, key: F.struct(F.lit(k).alias("k"), F.lit(side).alias("side"),
                                         key[0].alias("nh"), key[1].alias("nl"))
    needs = F.when(F.col("o") == 2, F.array(need(1, "l", one(F.col("a"))), need(1, "r", one(F.col("b"))))).otherwise(
        F.array(need(1, "l", one(F.col("a"))), need(1, "r", two(F.col("b"), F.col("c"))),
                need(2, "l", two(F.col("a"), F.col("b"))), need(2, "r", one(F.col("c")))))
    asked = cand.select("lang", "hi", "lo", "o", "cnt", F.explode(needs).alias("q")).select(
        "lang", "hi", "lo", "o", "cnt", "q.k", "q.side", "q.nh", "q.nl")
    parts_f = frequent.select("lang", F.col("hi").alias("nh"), F.col("lo").alias("nl"), F.col("f").alias("pf"))
    got = asked.join(parts_f, ["lang", "nh", "nl"])
    side = lambda k, s: F.max(F.when((F.col("k") == k) & (F.col("side") == s), F.col("pf")))
    cuts = got.groupBy("lang", "hi", "lo", "o", "cnt").agg(
        side(1, "l").alias("l1"), side(1, "r").alias("r1"), side(2, "l").alias("l2"), side(2, "r").alias("r2"))
    s1, s2 = _score("cnt", "l1", "r1"), _score("cnt", "l2", "r2")
    second = (F.col("o") == 3) & (s2 < s1)
    scored = cuts.select("lang", "hi", "lo", "o", F.col("cnt").alias("a"),
                         F.when(second, F.col("l2")).otherwise(F.col("l1")).alias("l"),
                         F.when(second, F.col("r2")).otherwise(F.col("r1")).alias("r"),
                         F.when(second, s2).otherwise(s1).alias("score"))
    # Bigrams inside a trigram candidate, with the trigram's count.
    inner = cand.filter(F.col("o") == 3).select(
        "lang", "cnt", F.explode(F.array(F.struct(two(F.col("a"), F.col("b"))[0].alias("hi"), two(F.col("a"), F.col("b"))[1].alias("lo")),
                                         F.struct(two(F.col("b"), F.col("c"))[0].alias("hi"), two(F.col("b"), F.col("c"))[1].alias("lo")))).alias("s"))
    covering = inner.groupBy("lang", F.col("s.hi").alias("hi"), F.col("s.lo").alias("lo")).agg(F.max("cnt").alias("longer"))
    kept = (scored.join(covering, ["lang", "hi", "lo"], "left")
            .filter(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a"))).drop("longer"))
    phrase = _phrases(kept, vocab)
    ranked = phrase.join(n, "lang").withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())))
    return ranked.filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long"), "phrase", F.col("a").cast("long"), F.col("l").cast("long"),
        F.col("r").cast("long"), F.col("n").cast("long"), "score")


def _phrases(kept: DataFrame, vocab: DataFrame) -> DataFrame:
    """The candidates with their words, space-joined, back from the ids."""
    ids = kept.select("*", F.posexplode(F.array(
        F.col("hi").bitwiseAND(F.lit(_LOW32)), F.shiftrightunsigned("lo", 32),
        F.col("lo").bitwiseAND(F.lit(_LOW32)))).alias("pos", "id")).filter(F.col("id") > 0)
    words = ids.join(vocab, "id").groupBy("lang", "hi", "lo").agg(
        F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("_w"))
    return kept.join(words, ["lang", "hi", "lo"]).withColumn(
        "phrase", F.array_join(F.transform("_w", lambda s: s["word"]), " ")).drop("_w")
