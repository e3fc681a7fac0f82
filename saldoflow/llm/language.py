"""Class-based n-gram scores after Brown: words have classes, classes follow each other.

P(word | word before) = P(class | class before) P(unit | class) P(word | unit)

Exchange clustering moves unit after unit to the class in which the class bigrams explain
the training text best, until nothing moves. It starts from a bounded head: its units are
the ``WORDS`` most frequent words, the end of a text, and the groups of all other words
whose last three bytes have the same hash, of which there are ``GROUPS``. Then every
further word leaves its group for the class with the largest gain of the same exchange: in
tasks, from the classes that stand before and after it in all training texts; the words of
the lexicon first, the others after them beside the lexicon's new classes. The class
bigrams are then counted again over the classes of all words. In the final model the
further words of a class are one unit; a word that training has not seen is in that of the class of its
group. A given number of ``words`` ends the clustering with the head: then the groups
stay the units of all other words.

Word counts are a table that grows with the corpus and is never collected. Words down to a
count that at most ``LEXICON`` words reach travel with the tasks; the other words of a
text are joined with the table, which also holds their units.
"""

from __future__ import annotations

from collections.abc import Iterator
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from saldoflow.session import settle

WORDS, GROUPS, CLASSES, SWEEPS = 768, 127, 32, 12
LEXICON = 200_000
#: Distinct words a task holds before it passes their counts on, and tokens between two sums of bigrams.
HELD_WORDS, HELD_TOKENS = 1_000_000, 2_000_000
#: Bytes of texts that are split into words at once; a longer text is split alone.
PORTION = 4 << 20
#: Keys up to this number are counted in an array with a place for each.
DENSE = 1 << 16
#: Added to every count, as in the unigram model that scores are compared with.
ADDED = 0.1


def group_of(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % GROUPS


def portions(texts: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Texts some at a time: their different words (as ``common.word_bytes`` splits them, in order
    of first use), the place of each word among these, and the number of words of each text."""
    if pa.types.is_binary(texts.type):
        texts = texts.view(pa.string())
    texts = texts.fill_null("")
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(sizes, PORTION + (sizes[start - 1] if start else 0), "right")))
        lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(texts.slice(start, stop - start))))
        lengths, flat = lists.value_lengths().to_numpy().astype(np.int64), lists.flatten()
        some = pc.binary_length(flat).to_numpy() > 0
        if not some.all():  # a blank text has one empty word
            lengths = np.bincount(np.repeat(np.arange(len(lengths)), lengths)[some], minlength=len(lengths))
            flat = flat.filter(pa.array(some))
        coded = flat.dictionary_encode()
        yield coded.dictionary.cast(pa.binary()), coded.indices.to_numpy(), lengths
        start = stop


def _path(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The words of texts one after another, with the end's 0 before the first text and after each."""
    path = np.zeros(1 + len(ids) + len(lengths), np.int64)
    path[1 + np.arange(len(ids)) + np.repeat(np.arange(len(lengths)), lengths)] = ids
    return path


def word_counts(texts: DataFrame) -> DataFrame:
    """(word binary, n): counts over all texts; the ends of texts are not among them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for words, at, _ in portions(batch.column("text")):
                held.append(pa.table({"word": words, "n": np.bincount(at, minlength=len(words))}))
                rows += len(words)
                if rows >= HELD_WORDS:
                    held = [summed(held)]
                    rows = len(held[0])
                    if rows >= HELD_WORDS // 2:
                        yield from held[0].to_batches()
                        held, rows = [], 0
        if held:
            yield from summed(held).to_batches()

    def summed(held: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")]).select(
            ["word", "n_sum"]).rename_columns(["word", "n"])

    return texts.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def lexicon(counts: DataFrame, limit: int) -> dict[bytes, int]:
    """The most frequent words with their counts: all down to a level of the counts, at most
    ``limit``. Levels are sixteenths of a power of two, so there are some hundreds."""
    level = F.floor(F.log2("n") * 16)
    found = counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).orderBy(F.desc("level")).collect()
    total, least = 0, None
    for row in found:
        total += row["words"]
        if total > limit:
            break
        least = row["level"]
    if least is None:
        return {}
    head = counts.filter(level >= least).toArrow()
    return dict(zip(head.column("word").to_pylist(), head.column("n").to_pylist()))


def unit_bigrams(texts: DataFrame, unit: dict[bytes, int]) -> np.ndarray:
    """Matrix of how often a unit follows another, over all texts; unit 0 is the end, which
    also stands before a text's first word."""
    n = len(unit) + 1 + GROUPS
    shared = texts.sparkSession.sparkContext.broadcast(unit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, total = shared.value, np.zeros(n * n, np.int64)
        first = len(unit) + 1
        for batch in batches:
            for words, at, lengths in portions(batch.column("text")):
                ids = np.array([unit.get(w) or first + group_of(w) for w in words.to_pylist()], np.int64)
                path = _path(ids[at], lengths)
                total += np.bincount(path[:-1] * n + path[1:], minlength=n * n)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["pair", "n"])

    rows = texts.select("text").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    matrix = np.zeros(n * n)
    matrix[rows.column("pair").to_numpy()] = rows.column("n").to_numpy()
    return matrix.reshape(n, n)


def _g(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each unit. Class 0 is the end's alone; the others start in turn by frequency.

    Moving a unit changes one row and one column of the class bigram counts, so each move's
    gain in likelihood comes from these.
    """
    n = len(pairs)
    cls = np.zeros(n, int)
    order = 1 + np.argsort(-pairs.sum(1)[1:], kind="stable")
    if classes < 2 or n < 2:
        return cls
    cls[order] = 1 + np.arange(n - 1) % (classes - 1)
    member = np.zeros((n, classes))
    member[np.arange(n), cls] = 1
    after, before = pairs @ member, pairs.T @ member
    table = member.T @ after
    diagonal = np.arange(classes)
    for _ in range(sweeps):
        moved = 0
        for u in order:
            own, self_ = cls[u], pairs[u, u]
            right, left = after[u].copy(), before[u].copy()
            right[own] -= self_
            left[own] -= self_
            if not right.any() and not left.any() and not self_:
                continue
            table[own] -= right
            table[:, own] -= left
            table[own, own] -= self_
            # What stands before and after the unit counts in its neighbours' sums wherever it goes.
            rows, columns = table.sum(1) + left, table.sum(0) + right
            base = _g(table)
            by_row, by_column = _g(table + right) - base, _g(table.T + left) - base.T
            gain = (by_row.sum(1) - by_row[diagonal, diagonal] + by_column.sum(1) - by_column[diagonal, diagonal]
                    + _g(table[diagonal, diagonal] + right + left + self_) - base[diagonal, diagonal]
                    - _g(rows + right.sum() + self_) + _g(rows) - _g(columns + left.sum() + self_) + _g(columns))
            gain[0] = -np.inf
            best = int(np.argmax(gain))
            if gain[best] <= gain[own] + 1e-9 * abs(gain[own]):
                best = own
            table[best] += right
            table[:, best] += left
            table[best, best] += self_
            if best != own:
                moved += 1
                cls[u] = best
                after[:, own] -= pairs[:, u]
                after[:, best] += pairs[:, u]
                before[:, own] -= pairs[u]
                before[:, best] += pairs[u]
        if not moved:
            break
    return cls


def placed(right: np.ndarray, left: np.ndarray, twice: np.ndarray, own: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Class of each of many words, by the gain of :func:`exchange` for each alone.

    ``right`` and ``left``: how often a class stands after and before the word, without the
    ``twice`` times that it follows itself. ``table`` has each word in its class ``own``.
    """
    n, classes = right.shape
    each = np.arange(n)
    gain = np.zeros((n, classes))
    for here, there, bigrams in ((right, left, table), (left, right, table.T)):
        w, j = np.nonzero(here)
        if not len(w):
            continue
        times, entry, mine = here[w, j], np.arange(len(w)), own[w]
        held = bigrams[:, j].T.astype(float)
        same = j == mine
        held[entry[~same], mine[~same]] -= times[~same]
        held[same] -= there[w[same]]
        delta = _g(held + times[:, None]) - _g(held)
        delta[entry, j] = 0  # both sides meet there, see below
        starts = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
        gain[w[starts]] += np.add.reduceat(delta, starts, axis=0)
    held = np.tile(table.diagonal().astype(float), (n, 1))
    held[each, own] -= right[each, own] + left[each, own] + twice
    gain += _g(held + right + left + twice[:, None]) - _g(held)
    for here, sums in ((right, table.sum(1)), (left, table.sum(0))):
        times = here.sum(1) + twice
        held = np.tile(sums.astype(float), (n, 1))
        held[each, own] -= times
        gain -= _g(held + times[:, None]) - _g(held)
    gain[:, 0] = -np.inf
    best, stay = gain.argmax(1), gain[each, own]
    return np.where(gain[each, best] > stay + 1e-9 * abs(stay), best, own)


class _Ids(dict):
    """Numbers of words; a word that has none gets the next one."""

    def __missing__(self, word: bytes) -> int:
        self[word] = k = len(self) + 1  # 0 is the end
        return k


def _paths(batches: Iterator[pa.RecordBatch], place: dict[bytes, int]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Texts as numbers, the end's before and after each, with the words numbered beyond ``place``."""
    ids, path = _Ids(place), [np.zeros(1, np.int64)]
    tokens = 0
    for batch in batches:
        for words, at, lengths in portions(batch.column("text")):
            of_word = np.array([*map(ids.__getitem__, words.to_pylist())], np.int64)
            path.append(_path(of_word[at], lengths)[1:])
            tokens += len(path[-1])
            if tokens >= HELD_TOKENS or len(ids) - len(place) >= HELD_WORDS:
                yield np.concatenate(path), list(ids)[len(place):]
                ids, path, tokens = _Ids(place), [np.zeros(1, np.int64)], 0
    if tokens:
        yield np.concatenate(path), list(ids)[len(place):]


def _summed(keys: list[np.ndarray], size: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The different keys in order and how often each occurs; a small ``size`` that all keys are
    below saves sorting them."""
    if size is None or size > DENSE:
        return np.unique(np.concatenate(keys), return_counts=True)
    total = np.bincount(np.concatenate(keys), minlength=size)
    some = np.flatnonzero(total)
    return some, total[some]


def lexicon_contexts(texts: DataFrame, place: dict[bytes, int], classes: np.ndarray, first: np.ndarray,
                     group_class: np.ndarray, table: np.ndarray) -> np.ndarray:
    """New ``classes`` of the words of the lexicon; those with ``first`` and the end keep theirs."""
    width = len(table)
    codes = 2 * width + 1
    shared = texts.sparkSession.sparkContext.broadcast((place, classes, first))  # LEXICON bounds it

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, classes, first = shared.value
        for path, others in _paths(batches, place):
            cls = np.concatenate([classes, group_class[[group_of(w) for w in others]]]) if others else classes
            moves = np.concatenate([~first, np.zeros(len(others), bool)])
            a, b = path[:-1], path[1:]
            same = a == b
            right, left = moves[a] & ~same, moves[b] & ~same
            key, n = _summed([a[right] * codes + cls[b[right]], b[left] * codes + width + cls[a[left]],
                              a[same & moves[a]] * codes + 2 * width], len(classes) * codes)
            yield pa.RecordBatch.from_arrays(
                [pa.array((key // codes).astype(np.int32)), pa.array((key % codes).astype(np.int32)), pa.array(n)],
                names=["id", "code", "n"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, classes, _ = shared.value
        for batch in batches:
            ids = batch.column("id").to_numpy()
            dense = _dense(batch, codes)
            best = placed(dense[:, :width], dense[:, width:2 * width], dense[:, -1], classes[ids], table)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(best.astype(np.int32))], names=["id", "class"])

    found = texts.select("text").mapInArrow(count, "id int, code int, n long").groupBy("id", "code").agg(
        F.sum("n").alias("n")).groupBy("id").agg(F.collect_list("code").alias("codes"), F.collect_list("n").alias("ns"))
    rows = found.mapInArrow(choose, "id int, class int").toArrow()
    classes = classes.copy()
    classes[rows.column("id").to_numpy()] = rows.column("class").to_numpy()
    return classes


def _dense(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The lists ``codes`` and ``ns`` of a batch as a matrix with a column for each code."""
    codes, ns = batch.column("codes"), batch.column("ns")
    owner = np.repeat(np.arange(len(codes)), codes.value_lengths().to_numpy())
    where = owner * width + codes.flatten().to_numpy()
    return np.bincount(where, ns.flatten().to_numpy(), len(codes) * width).reshape(-1, width)


def other_words(texts: DataFrame, place: dict[bytes, int], classes: np.ndarray, group_class: np.ndarray,
                width: int) -> tuple[DataFrame, np.ndarray]:
    """(word, n, class) of all words beyond the lexicon, whose ``classes`` are settled, and the
    class bigrams of all texts after it.

    Neighbours in the lexicon count by their own class. Neighbours beyond it are still in
    their group's class when a class is chosen, and in their own in the bigrams.
    """
    known = len(place) + 1
    codes, square = 4 * width + 1, width * width
    shared = texts.sparkSession.sparkContext.broadcast((place, classes))  # LEXICON bounds it

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, classes = shared.value
        for path, others in _paths(batches, place):
            cls = np.concatenate([classes, group_class[[group_of(w) for w in others]]]) if others else classes
            words = pa.array([None, *others], pa.binary())
            a, b = path[:-1], path[1:]
            new_a, new_b, same = a >= known, b >= known, a == b
            both = cls[a] * width + cls[b]
            key, n = _summed([both, square + both[~new_a & ~new_b]], 2 * square)
            yield out(words, np.zeros(len(key), int), None, key, n)
            right, left = new_a & ~same, new_b & ~same
            key, n = _summed([(a[right] - known) * codes + cls[b[right]] + 2 * width * new_b[right],
                              (b[left] - known) * codes + width + cls[a[left]] + 2 * width * new_a[left],
                              (a[same & new_a] - known) * codes + 4 * width])
            yield out(words, key // codes + 1, None, key % codes, n)
            pairs = right & new_b
            key, n = _summed([(a[pairs] - known) * (len(others) + 1) + b[pairs] - known])
            yield out(words, key // (len(others) + 1) + 1, key % (len(others) + 1) + 1, np.full(len(key), -1), n)

    def out(words: pa.Array, word: np.ndarray, following: np.ndarray | None, code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [words.take(pa.array(word)), pa.nulls(len(n), pa.binary()) if following is None else words.take(pa.array(following)),
             pa.array(code.astype(np.int32)), pa.array(n)], names=["word", "following", "code", "n"])

    seen = settle(texts.select("text").mapInArrow(count, "word binary, following binary, code int, n long"), "contexts")
    matrix = np.zeros(2 * square)
    for row in seen.filter("word IS NULL").groupBy("code").agg(F.sum("n").alias("n")).collect():
        matrix[row["code"]] = row["n"]
    before, bigrams = matrix.reshape(2, width, width)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 4096):
                batch = whole.slice(at, 4096)
                dense = _dense(batch, codes)
                sides, twice = dense[:, :-1].reshape(-1, 2, 2, width), dense[:, -1]
                own = group_class[[group_of(w) for w in batch.column("word").to_pylist()]]
                right, left = sides.sum(1).transpose(1, 0, 2)
                best = placed(right, left, twice, own, before)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("word"), pa.array((left.sum(1) + twice).astype(np.int64)), pa.array(best.astype(np.int32)),
                     batch.column("codes"), batch.column("ns")], names=["word", "n", "class", "codes", "ns"])

    # A task passes a word's contexts on once, so a word has a few rows from each task at most.
    chosen = settle(seen.filter("word IS NOT NULL AND following IS NULL").repartition("word").groupBy("word", "code").agg(
        F.sum("n").alias("n")).groupBy("word").agg(F.collect_list("code").alias("codes"), F.collect_list("n").alias("ns")).mapInArrow(
        choose, "word binary, n long, class int, codes array<int>, ns array<long>"), "classes")

    def recount(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for whole in batches:
            for at in range(0, len(whole), 4096):
                batch = whole.slice(at, 4096)
                dense, cls = _dense(batch, codes), batch.column("class").to_numpy()
                member = np.zeros((len(cls), width))
                member[np.arange(len(cls)), cls] = 1
                total += member.T @ dense[:, :width] + dense[:, width:2 * width].T @ member
                total += np.diag(member.T @ dense[:, -1])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total.ravel()[some].astype(np.int64))],
                                         names=["code", "n"])

    sides = [chosen.select(F.col("word").alias(word), F.col("class").alias(to)) for word, to in (("word", "a"), ("following", "b"))]
    pairs = seen.filter("following IS NOT NULL").select("word", "following", "n").join(sides[0], "word").join(sides[1], "following")
    again = chosen.select("class", "codes", "ns").mapInArrow(recount, "code int, n long").unionByName(
        pairs.select((F.col("a") * width + F.col("b")).alias("code"), "n"))
    bigrams = bigrams.ravel().copy()
    for row in again.groupBy("code").agg(F.sum("n").alias("n")).collect():
        bigrams[row["code"]] += row["n"]
    return chosen.select("word", "n", "class"), bigrams.reshape(width, width)


class Model:
    """What the training texts have taught; all but ``counts`` (a table) is bounded.

    ``counts`` holds (word, n, g) of at least all words beyond the lexicon, ``group`` the g of
    those in it without a unit of their own, ``unseen`` that of an unknown word by its
    hash. The unit of a g stands behind the units of words.
    """

    def __init__(self, texts: DataFrame, words: int | None = None, lexicon_size: int = LEXICON, classes: int = CLASSES):
        counts = settle(word_counts(texts), "words")
        ends = texts.count()
        n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
        self.tokens, self.types = n + ends, v + (ends > 0)
        self.ends = ends
        self.lexicon = lexicon(counts, lexicon_size)
        top = sorted(self.lexicon.items(), key=lambda x: (-x[1], x[0]))[:WORDS if words is None else words]
        unit = {w: 1 + k for k, (w, _) in enumerate(top)}
        self.unit = unit
        pairs = unit_bigrams(texts, unit)
        seed = exchange(pairs, classes)
        member = np.zeros((len(pairs), classes))
        member[np.arange(len(pairs)), seed] = 1
        table = member.T @ pairs @ member
        sql_group = (F.crc32(F.substring("word", -3, 3)) % GROUPS).cast("int")
        if words is None and classes > 1 and v:
            seed_group = seed[len(unit) + 1:]
            inside = sorted(self.lexicon)
            place = {w: 1 + k for k, w in enumerate(inside)}
            of_word = np.array([0, *(seed[unit[w]] if w in unit else seed_group[group_of(w)] for w in inside)])
            first = np.array([True, *(w in unit for w in inside)])
            of_word = lexicon_contexts(texts, place, of_word, first, seed_group, table)
            others, table = other_words(texts, place, of_word, seed_group, classes)
            self.counts = others.select("word", "n", (F.col("class") - 1).alias("g"))
            self.group = {w: int(of_word[place[w]]) - 1 for w in inside if w not in unit}
            self.unseen = seed_group - 1
            groups = classes - 1
            self.classes = np.concatenate([seed[:len(unit) + 1], 1 + np.arange(groups)])
            beyond = self.counts
        else:
            self.counts = counts.select("word", "n", sql_group.alias("g"))
            self.group = {w: group_of(w) for w in self.lexicon if w not in unit}
            self.unseen, groups = np.arange(GROUPS), GROUPS
            self.classes = seed
            beyond = self.counts.join(F.broadcast(texts.sparkSession.createDataFrame(
                [(bytearray(w),) for w in self.lexicon], "word binary")), "word", "left_anti")
        group_n, group_v = np.zeros(groups), np.zeros(groups)
        for w, g in self.group.items():
            group_n[g] += self.lexicon[w]
            group_v[g] += 1
        for r in beyond.groupBy("g").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
            group_n[r["g"]] += r["n"]
            group_v[r["g"]] += r["v"]
        size = np.concatenate([[ends], [n for _, n in top], group_n])
        of_class, kinds = table.sum(0), np.bincount(self.classes, minlength=classes)
        share = (of_class + ADDED * (kinds > 0)) / (of_class.sum() + ADDED * (kinds > 0).sum())
        # A class bigram falls back on the class's own share with the weight of one token.
        follow = (table + share) / (table.sum(1, keepdims=True) + 1)
        with np.errstate(divide="ignore"):
            self.follow = np.log10(follow)
        self.in_class = np.log10((size + ADDED) / (of_class + ADDED * kinds)[self.classes])
        self.in_group = group_n + ADDED * (group_v + 1)  # what a word's count is divided by
        self.base = self.tokens + ADDED * (self.types + 1)


def _found(texts: pa.Array, place: dict[bytes, int]) -> Iterator[tuple[list[np.ndarray], pa.Array, np.ndarray]]:
    """Texts some at a time as places of their words, -1, -2, ... for a text's words without a
    place in order of first use; then these words of all texts, and how many each text has."""
    for words, at, lengths in portions(texts):
        known = np.array([place.get(w, -1) for w in words.to_pylist()], np.int64)[at]
        lost = np.flatnonzero(known < 0)
        text = np.repeat(np.arange(len(lengths)), lengths)[lost]
        key, first, which = np.unique(text * len(words) + at[lost], return_index=True, return_inverse=True)
        order, n = np.argsort(first), np.bincount(text[first], minlength=len(lengths))
        rank = np.empty(len(key), np.int64)
        rank[order] = np.arange(len(key))
        known[lost] = (np.cumsum(n) - n)[text] - rank[which] - 1
        yield np.split(known, np.cumsum(lengths)[:-1]), words.take(pa.array(at[lost[first[order]]])), n


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every row of ``docs``.

    Scores are log10 probabilities of whole texts, end included; a null or empty text is
    its end alone. Rows that repeat a doc_id are scored each. Further columns are not read.
    An empty table gives an empty one.
    """
    head = sorted(model.lexicon.items())
    counts = np.array([c for _, c in head], float)
    place = {w: k for k, (w, _) in enumerate(head)}
    first_group, ends = len(model.unit) + 1, model.ends
    units = np.array([model.unit.get(w) or first_group + model.group[w] for w, _ in head], np.int64)
    own = units < first_group
    spread = np.where(own, 1.0, model.in_group[np.where(own, 0, units - first_group)])
    in_unit = np.where(own, 0.0, np.log10((counts + ADDED) / spread))
    by_word = np.log10((counts + ADDED) / model.base)
    end = float(np.log10((model.ends + ADDED) / model.base))
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((place, units, in_unit, by_word))  # LEXICON bounds it
    classes, follow, in_class, in_group, base = model.classes, model.follow, model.in_class, model.in_group, model.base
    unseen = model.unseen

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, units, in_unit, by_word = shared.value
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            out, texts = [[] for _ in range(6)], []
            rests, n_rests = [pa.array([], pa.binary())], [np.zeros(1, np.int64)]
            for known, rest, n_rest in _found(batch.column("text"), place):
                rests.append(rest)
                n_rests.append(n_rest)
                texts.extend(known)
            for known in texts:
                inside = known >= 0
                here = known[inside]
                # Classes, and below zero the places of the words to be joined.
                path = np.zeros(len(known) + 2, np.int64)
                path[1:-1] = known
                path[1:-1][inside] = classes[units[here]] if len(here) else 0
                sure = path >= 0
                both = sure[:-1] & sure[1:]
                out[0].append(row)
                out[1].append(len(known) + 1)
                out[2].append(len(here) + (ends > 0))
                out[3].append(float(by_word[here].sum()) + end)
                total = follow[path[:-1][both], path[1:][both]].sum() + in_class[0] + in_unit[here].sum()
                out[4].append(float(total + (in_class[units[here]].sum() if len(here) else 0)))
                near = ~sure
                near[:-1] |= ~sure[1:]
                near[1:] |= ~sure[:-1]
                out[5].append(path[near])
                row += 1
            lengths = np.cumsum([0, *map(len, out[5])])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in out[:3]], pa.array(out[3], pa.float64()),
                 pa.array(out[4], pa.float64()), pa.ListArray.from_arrays(
                     pa.array(np.cumsum(np.concatenate(n_rests)), pa.int32()), pa.concat_arrays(rests)),
                 pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(np.concatenate(
                     [np.zeros(0, np.int64), *out[5]]).astype(np.int32)))], names=names)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known, base_score, score = (batch.column(c).to_pylist() for c in ("n_known", "base_score", "score"))
            columns = [batch.column(c) for c in ("path", "at", "n", "g")]
            for i in range(len(batch)):
                path, at, n, g = (c[i].values for c in columns)
                if at is None or not len(at):
                    continue
                path, at = path.to_numpy().astype(np.int64), at.to_numpy()
                order = np.argsort(at)
                n, g = n.to_numpy()[order], g.to_numpy()[order]
                rare = path < 0
                which = -1 - path[rare]
                steps = path.copy()
                steps[rare] = classes[first_group + g[which]]
                to_count = rare[:-1] | rare[1:]
                known[i] += int((n[which] > 0).sum())
                base_score[i] += float(np.log10((n[which] + ADDED) / base).sum())
                score[i] += float(follow[steps[:-1], steps[1:]][to_count].sum() + in_class[first_group + g[which]].sum()
                                  + np.log10((n[which] + ADDED) / in_group[g[which]]).sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_tokens"), pa.array(known, pa.int64()),
                 pa.array(base_score, pa.float64()), pa.array(score, pa.float64())],
                names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    names = ["doc_id", "row", "n_tokens", "n_known", "base_score", "score", "words", "path"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    # Written, so that a row keeps its number whatever becomes of the executors.
    part = settle(docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, row long, n_tokens long, n_known long, base_score double, score double, "
             "words array<binary>, path array<int>"), "scored")
    rest = part.select("row", F.posexplode("words").alias("at", "word"))
    hashed = F.get(F.array(*[F.lit(int(g)) for g in unseen]), (F.crc32(F.substring("word", -3, 3)) % GROUPS).cast("int"))
    found = rest.join(model.counts, "word", "left").groupBy("row").agg(
        F.collect_list(F.struct("at", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("g", hashed).alias("g"))).alias("found"))
    return part.drop("words").join(found, "row", "left").select(
        "doc_id", "n_tokens", "n_known", "base_score", "score", "path", F.col("found.at").alias("at"),
        F.col("found.n").alias("n"), F.col("found.g").alias("g")).mapInArrow(
        finish, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")
