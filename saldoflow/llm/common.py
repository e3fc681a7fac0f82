"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: White space between words: space and the control characters 9 to 13.
SPACES = " \t\n\x0b\f\r"
BREAK = r"[\x20\x09-\x0D]+"


def fresh(base: str, taken) -> str:
    """A column name that begins with ``base`` and is none of ``taken``, so a helper column
    never meets a given one of the same name."""
    name, seen = base, {c.lower() for c in taken}
    while name.lower() in seen:
        name += "_"
    return name


def plain_names(names: list[str]) -> list[str]:
    """Names to carry columns through ``mapInArrow``, which resolves its input columns
    unquoted: a name with a dot or a backtick is replaced by a fresh plain one."""
    out = []
    for i, n in enumerate(names):
        out.append(fresh(f"_col{i}", [*names, *out]) if "." in n or "`" in n else n)
    return out


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; none for null or blank text."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, BREAK))


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def word_bytes(text: str | bytes | None) -> list[bytes]:
    """Words of a text (or of its bytes) as UTF-8 with A-Z lowered; the same split as :func:`words`."""
    return (text if isinstance(text, bytes) else (text or "").encode("utf-8")).lower().split()


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % n


def worker_cache(key: str) -> dict:
    """A dictionary that lives as long as the Python worker, whatever tasks it runs."""
    name = "saldoflow_worker_cache"
    holder = sys.modules.setdefault(name, types.ModuleType(name))
    return holder.__dict__.setdefault(key, {})


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns: whatever else a table has cannot clash with an operator's own."""
    return df.select(*[F.col(f"`{n}`") for n in names])
