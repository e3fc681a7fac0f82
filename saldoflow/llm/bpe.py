"""Byte-level BPE: encoding by merges over a segment tree, and decoding.

The vocabulary is a rank file: one base64 token and its rank a line. A text is
cut by the tokenizer's pattern; each match is merged by itself. A match that is a
token as a whole gets that token's id.

Merging keeps a segment tree over the byte positions of a match. A leaf holds the
rank of the pair that starts there, joined with the position, so the root is the
leftmost pair of the smallest rank. A merge changes three leaves (the pair to the
left, the pair itself, and the swallowed part) and so costs the logarithm of the
match's length, whatever that length is.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from saldoflow.llm.common import plain_names, worker_cache

#: Bytes that a worker's remembered pieces may take (keys, ids and about 200 bytes of
#: bookkeeping each); it starts anew beyond that.
CACHE_BYTES = 96 << 20
#: The same for :func:`digests`, whose tasks hold no texts or ids beyond one batch.
DIGEST_CACHE_BYTES = 256 << 20
#: Longer pieces are not remembered.
CACHE_CHARS = 100
#: Rows of an output batch stop once their texts and ids hold this many bytes (one row
#: longer than that is a batch of its own).
BATCH_BYTES = 32 << 20


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank. Read on the driver; its size is that of the vocabulary."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, file))}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match, by merging the leftmost pair of the smallest rank until none is left."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    bits = n.bit_length()
    low = (1 << bits) - 1
    none = 1 << 62
    width = 1
    while width < n:
        width *= 2
    tree = [none] * (2 * width)
    get = ranks.get
    for i in range(n - 1):
        rank = get(piece[i:i + 2])
        if rank is not None:
            tree[width + i] = rank << bits | i
    for k in range(width - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    after = list(range(1, n + 1))       # where the part that starts here ends
    before = list(range(-1, n - 1))     # where the part to the left starts

    root = tree[1]
    while root != none:
        i = root & low
        gone = after[i]
        end = after[i] = after[gone]
        new, left = none, before[i]
        if end < n:
            before[end] = i
            rank = get(piece[i:after[end]])
            if rank is not None:
                new = rank << bits | i
        points = [(width + gone, none), (width + i, new)]
        if left >= 0:
            rank = get(piece[left:end])
            points.append((width + left, none if rank is None else rank << bits | left))
        for k, value in points:
            if tree[k] == value:
                continue
            tree[k] = value
            while k > 1:
                other = tree[k ^ 1]
                if other < value:
                    value = other
                k >>= 1
                if tree[k] == value:
                    break
                tree[k] = value
        root = tree[1]
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:after[i]]])
        i = after[i]
    return ids


#: A space between two characters that are none: a match always begins there.
_CUT = regex.compile(r"(?<=\S) (?=\S)")


def encoder(ranks: dict[bytes, int], pattern: str, key: str,
            cache_bytes: int = CACHE_BYTES) -> Callable[[str], bytes]:
    """A function from text to its ids as little-endian 32-bit integers.

    A match always begins at a single space between two other characters, so a text
    is cut there and the ids of a piece, with its space, are remembered. Pieces that
    are empty or have white space at an end lie beside further white space, where
    this does not hold; a text that has any is cut only where it does.
    """
    find = regex.compile(pattern).findall
    # Two dictionaries (whole space-separated pieces, single matches) under one budget.
    cache = worker_cache(f"bpe {key}")
    known, matches = cache.setdefault("pieces", {}), cache.setdefault("matches", {})
    used = cache.setdefault("bytes", [0])

    def remember(table: dict, piece: str, ids: bytes) -> None:
        if len(piece) > CACHE_CHARS:
            return
        used[0] += 2 * len(piece) + len(ids) + 200
        if used[0] > cache_bytes:
            known.clear()
            matches.clear()
            used[0] = 2 * len(piece) + len(ids) + 200
        table[piece] = ids

    def ids_of(piece: str) -> bytes:
        out = []
        for match in find(piece):
            ids = matches.get(match)
            if ids is None:
                ids = array("I", merge(match.encode("utf-8"), ranks))
                if sys.byteorder != "little":
                    ids.byteswap()
                ids = ids.tobytes()
                remember(matches, match, ids)
            out.append(ids)
        return b"".join(out)

    def encode(text: str) -> bytes:
        if not text:
            return b""
        first, *others = text.split(" ")
        out = list(map(known.get, others))
        if None in out:
            for i, ids in enumerate(out):
                if ids is None:
                    piece = others[i]
                    ids = known.get(piece)
                    if ids is None:
                        if not piece or piece[0].isspace() or piece[-1].isspace():
                            first, *others = _CUT.split(text)
                            return ids_of(first) + b"".join([ids_of(" " + x) for x in others])
                        ids = ids_of(" " + piece)
                        remember(known, piece, ids)
                    out[i] = ids
        if others and (not first or first[-1].isspace()):
            first, *others = _CUT.split(text)
            return ids_of(first) + b"".join([ids_of(" " + x) for x in others])
        return ids_of(first) + b"".join(out)

    return encode


def decode(ids: np.ndarray, tokens: list[bytes]) -> bytes:
    """Bytes of a sequence of ids."""
    return b"".join(map(tokens.__getitem__, ids.tolist()))


def _vocabulary(path: str):
    ranks = load_ranks(path)
    key = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()[:16]
    return ranks, key


def encode_column(docs: DataFrame, path: str, pattern: str, text: str = "text",
                  ids: str = "token_ids", count: str = "n_tokens",
                  checked: str | None = None, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``docs`` with the ids of each whole text (32-bit integers) and their number.

    A null text has no ids, an empty one neither. With ``checked``, the ids are decoded
    in the same pass and that column says whether they give the text's UTF-8 bytes
    again (true for null and empty texts). Other columns are passed through; columns
    with the names of the new ones are replaced. Rows are independent, so repeated
    rows, ties and empty tables need nothing special. Output batches are cut by bytes
    (``batch_bytes``), so a batch of very long texts is several batches; the input
    batches are Spark's (``spark.sql.execution.arrow.maxRecordsPerBatch`` rows, or
    ``maxBytesPerBatch``).
    """
    ranks, key = _vocabulary(path)
    new = (ids, count) + ((checked,) if checked else ())
    kept = [f for f in docs.schema.fields if f.name not in new]
    given = [f.name for f in kept]
    names = plain_names(given)
    source = names[given.index(text)]
    kept = [T.StructField(n, f.dataType, f.nullable) for n, f in zip(names, kept)]
    schema = T.StructType([*kept, T.StructField(ids, T.ArrayType(T.IntegerType(), False)),
                           T.StructField(count, T.LongType()),
                           *([T.StructField(checked, T.BooleanType(), False)] if checked else [])])
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value
        encode = encoder(ranks, pattern, key)
        tokens = None
        if checked:
            tokens = [b""] * (max(ranks.values(), default=-1) + 1)
            for token, rank in ranks.items():
                tokens[rank] = token

        def emit(batch, start, coded, same):
            offsets = np.zeros(len(coded) + 1, np.int64)
            np.cumsum([len(c) for c in coded], out=offsets[1:])
            if offsets[-1] >= 2 ** 31:
                raise ValueError("one text has over 2^31 ids")
            flat = np.concatenate(coded) if coded else np.zeros(0, "<u4")
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                             pa.array(flat.view(np.int32), pa.int32()))
            part = batch.slice(start, len(coded))
            extra = [pa.array(same, pa.bool_())] if checked else []
            return pa.RecordBatch.from_arrays(
                [*[part.column(n) for n in names], lists, pa.array(np.diff(offsets), pa.int64()), *extra],
                names=schema.names)

        for batch in batches:
            texts = batch.column(source)
            start, held, coded, same = 0, 0, [], []
            for i in range(batch.num_rows):
                t = texts[i].as_py()
                raw = encode(t)
                coded.append(np.frombuffer(raw, "<u4"))
                if checked:
                    same.append(decode(coded[-1], tokens) == (t or "").encode("utf-8"))
                held += len(raw) + (len(t) if t else 0)
                if held >= batch_bytes:
                    yield emit(batch, start, coded, same)
                    start, held, coded, same = i + 1, 0, [], []
            if coded or batch.num_rows == 0:
                yield emit(batch, start, coded, same)

    out = docs.select(*[F.col(f"`{g}`").alias(n) for g, n in zip(given, names)]).mapInArrow(run, schema)
    return out.select(*[F.col(f"`{n}`").alias(g) for g, n in zip(given, names)], *[F.col(f"`{n}`") for n in new])


def decode_column(docs: DataFrame, path: str, ids: str = "token_ids",
                  to: str = "decoded") -> DataFrame:
    """``docs`` with the bytes of a column of ids; null ids give null. An id that the
    vocabulary does not have is an error."""
    ranks, _ = _vocabulary(path)
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    shared = docs.sparkSession.sparkContext.broadcast(tokens)
    kept = [f for f in docs.schema.fields if f.name != to]
    schema = T.StructType([*kept, T.StructField(to, T.BinaryType())])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value
        for batch in batches:
            coded = batch.column(ids)
            out = []
            for i in range(batch.num_rows):
                one = coded[i]
                out.append(decode(one.values.to_numpy(zero_copy_only=False), tokens)
                           if one.is_valid else None)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(out, pa.binary())], names=[*names, to])

    return docs.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document the number of ids and SHA-256 of the ids and of the decoded bytes.

    Encodes and decodes in one pass and returns no ids, for comparison with another
    encoder. Texts as in :func:`encode_column`.
    """
    ranks, key = _vocabulary(path)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value
        encode = encoder(ranks, pattern, key, DIGEST_CACHE_BYTES)
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        for batch in batches:
            counts, coded, decoded = [], [], []
            for t in batch.column("text").to_pylist():
                raw = encode(t)
                counts.append(len(raw) // 4)
                coded.append(hashlib.sha256(raw).hexdigest())
                decoded.append(hashlib.sha256(decode(np.frombuffer(raw, "<u4"), tokens)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(coded, pa.string()),
                 pa.array(decoded, pa.string())], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
