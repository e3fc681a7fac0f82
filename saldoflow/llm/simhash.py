"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has 64 bits; two link when at most ``radius`` of them differ. Every bit
position gets a non-zero vector of radius + 1 bits, and every non-zero vector v of that
length gives a table, whose mask keeps the positions with an odd inner product with v.
Positions in which two fingerprints differ, if at most ``radius``, cannot span all
vectors of that length, so some v is orthogonal to all of them: in its table the two
agree on the whole mask. No linked pair is missed. Handing the vectors to the positions
in turn gives masks of 32 bits or more for the radius 4.

A table's key holds only fingerprints that agree on the mask, and equal fingerprints
are one row. A key with over ``BUCKET`` of them is divided by the same construction
over the positions that its mask leaves open, and so again, so that a task compares
bounded groups whatever the data; when few positions are left open, the group is
bounded by their number.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from saldoflow.llm.common import word_bytes
from saldoflow.llm.components import components, cut, local_roots
from saldoflow.session import settle

#: Distinct fingerprints under one key that are compared pair by pair.
BUCKET = 4096
#: Shingles whose bits are counted at a time.
BLOCK = 1 << 16


def fingerprint(text: str | bytes | None, shingle: int) -> int:
    """64-bit SimHash of the word shingles, repeats included; 0 without words."""
    words = word_bytes(text)
    if not words:
        return 0
    if len(words) <= shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, 42) for s in shingles], "<u8")
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), BLOCK):
        part = hashes[start:start + BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(values.view(np.int64))], names=["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    # As bytes: a text that is not valid UTF-8 has a fingerprint too.
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, f"doc_id {kind}, fp long")


def masks(positions: list[int], radius: int) -> list[int]:
    """The covering masks over the given bit positions, one a table."""
    n = (1 << (radius + 1)) - 1
    vector = {p: k % n + 1 for k, p in enumerate(positions)}
    return [sum(1 << p for p in positions if (vector[p] & v).bit_count() & 1) for v in range(1, n + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _tables(radius: int, open_masks: list[int]) -> list[list[int]]:
    """For each mask of open positions, the masks that cover them."""
    return [masks([p for p in range(64) if m >> p & 1], radius) for m in open_masks]


def near_links(distinct: DataFrame, radius: int, bucket: int = BUCKET) -> DataFrame:
    """(a, b) links among distinct fingerprints ``fp`` that connect all that are linked.

    Not every linked pair is returned, but in each compared group each fingerprint
    with the smallest one it reaches there, so the links have the same components.
    """
    bucket = min(bucket, BUCKET)
    whole = (1 << 64) - 1
    # open: which positions the group leaves open; at first all, in one group.
    groups = distinct.select("fp", F.lit(0).cast("long").alias("group"), F.lit(0).alias("at"))
    open_masks, found = [whole], None
    while groups is not None:
        level = _tables(radius, open_masks)
        cover = F.array(*[F.array(*[F.lit(_signed(m)) for m in row]) for row in level])
        n = len(level[0])
        keyed = groups.select("fp", "group", "at", F.posexplode(cover[F.col("at")]).alias("t", "mask")).select(
            "fp", (F.col("at") * n + F.col("t")).alias("at"),
            F.xxhash64("group", "t", F.col("fp").bitwiseAND(F.col("mask"))).alias("group"))
        sizes = cut(keyed.groupBy("group").agg(F.count("*").alias("n")).filter("n > 1"))
        shared = keyed.join(sizes, "group")
        open_masks = [o & ~m for o, row in zip(open_masks, level) for m in row]
        bounded = max(o.bit_count() for o in open_masks) <= 17
        hot = None if bounded else shared.filter(F.col("n") > bucket)
        small = shared if bounded else shared.filter(F.col("n") <= bucket)
        new = _compare(small, radius)
        found = new if found is None else found.unionByName(new)
        if hot is None or sizes.filter(F.col("n") > bucket).isEmpty():
            break
        groups = cut(hot.select("fp", "group", "at"))
    return found


def _compare(members: DataFrame, radius: int) -> DataFrame:
    """Links within each group; a task has whole groups, one after the other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_group, kept_fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            group = np.concatenate([kept_group, batch.column("group").to_numpy()])
            fp = np.concatenate([kept_fp, batch.column("fp").to_numpy()])
            end = int(np.searchsorted(group, group[-1])) if len(group) else 0
            kept_group, kept_fp = group[end:], fp[end:]
            yield from emit(group[:end], fp[:end])
        yield from emit(kept_group, kept_fp)

    def emit(group: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(fp):
            return
        i, j = close_pairs(group, fp.view(np.uint64), radius)
        root = local_roots(len(fp), i, j)
        tied = np.flatnonzero(root != np.arange(len(fp)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(fp[tied]), pa.array(fp[root[tied]])], names=["a", "b"])

    rows = members.select("group", "fp").repartition("group").sortWithinPartitions("group", "fp")
    return rows.mapInArrow(run, "a long, b long")


def close_pairs(group: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of all pairs in equal groups (sorted) with at most ``radius`` differing bits."""
    first, second = [], []
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    lone = sizes > BUCKET
    for s, m in zip(starts[lone], sizes[lone]):
        i, j = _by_flips(fp[s:s + m], radius)
        first.append(i + s)
        second.append(j + s)
    # The others at a distance of 1, 2, ... places within their group.
    last = np.repeat(np.where(lone, 0, starts + sizes), sizes)
    index = np.arange(len(fp))
    lag = 1
    while True:
        index = index[index + lag < last[index]]
        if not len(index):
            break
        near = np.bitwise_count(fp[index] ^ fp[index + lag]) <= radius
        first.append(index[near])
        second.append(index[near] + lag)
        lag += 1
    return (np.concatenate(first), np.concatenate(second)) if first else (index, index)


def _by_flips(fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a large group by looking up what each member becomes when bits flip.

    The members differ in few positions only (17 at most, see :func:`near_links`).
    """
    varying = int(np.bitwise_or.reduce(fp ^ fp[0]))
    bits = [p for p in range(64) if varying >> p & 1]
    place = np.zeros(len(fp), np.int64)
    for k, p in enumerate(bits):
        place |= ((fp >> np.uint64(p)) & np.uint64(1)).astype(np.int64) << k
    table = np.full(1 << len(bits), -1, np.int64)
    table[place] = np.arange(len(fp))
    first, second = [], []
    for r in range(1, radius + 1):
        for flip in combinations(range(len(bits)), r):
            other = table[place ^ sum(1 << k for k in flip)]
            hit = np.flatnonzero(other > np.arange(len(fp)))
            first.append(hit)
            second.append(other[hit])
    return np.concatenate(first), np.concatenate(second)


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4,
                    bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fingerprint, component_id, kept) for every row of ``docs``.

    component_id is the smallest doc_id reachable over links, kept tells whether that
    is the row's own. Null and blank texts have the fingerprint zero and link with each
    other. Rows that repeat a doc_id each get a row; a null doc_id never is a component's
    id unless no other is in it, and is kept then. Further columns are not read.
    """
    prints = settle(fingerprints(docs, shingle), "fingerprints")
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    parts = components(near_links(distinct, radius, bucket))
    named = distinct.join(parts, distinct.fp == parts.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    smallest = cut(named.groupBy("component").agg(F.min("least").alias("component_id")))
    labels = cut(named.join(smallest, "component").select("fp", "component_id"))
    return prints.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
