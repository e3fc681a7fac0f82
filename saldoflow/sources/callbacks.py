"""The raw callback feed: window, parsing, routing, watermark."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from saldoflow import constants as K
from saldoflow.functions import scalars as S

CALLBACK_SCHEMA = T.StructType([
    T.StructField("callback_id", T.LongType()),
    T.StructField("method", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("deleted_at", T.TimestampNTZType()),
])

_STAMP = "STRUCT<time: STRING, user: STRUCT<name: STRING, email: STRING>>"
_ACCOUNT = "STRUCT<id: STRING, code: STRING, name: STRING>"
_CURRENCY = "STRUCT<code: STRING>"
_PARTY = "STRUCT<name: STRING>"
_REFERENCE = f"STRUCT<id: STRING, number: STRING, date: STRING, account: {_ACCOUNT}>"
_HEAD = ("id: STRING, number: STRING, date: STRING, description: STRING, status: STRING, "
         f"department: {_ACCOUNT}, created: {_STAMP}, updated: {_STAMP}")
# Rates are VARIANT because an absent key and an explicit null differ; a line's
# department and project are, because an empty object inherits and one with
# null fields does not.
_MONEY_ITEM = (f"STRUCT<id: STRING, amount: STRING, exchange_rate: VARIANT, "
               f"currency: {_CURRENCY}, account: {_ACCOUNT}>")
_LINE = (f"STRUCT<id: STRING, description: STRING, note: STRING, amount: STRING, "
         f"debit: STRING, credit: STRING, subtotal_before_discount: STRING, "
         f"subtotal_after_discount: STRING, exchange_rate: VARIANT, currency: {_CURRENCY}, "
         f"account: {_ACCOUNT}, department: VARIANT, project: VARIANT, "
         f"invoice: {_REFERENCE}, purchase_invoice: {_REFERENCE}, purchase: {_REFERENCE}, "
         f"bill: {_REFERENCE}, payable: STRUCT<amount: STRING, account: {_ACCOUNT}>, "
         f"payment: STRUCT<amount: STRING>, discount: STRUCT<amount: STRING>, "
         f"taxes: ARRAY<STRUCT<id: STRING, code: STRING, name: STRING, amount: STRING>>>")
HEAD_SCHEMA = f"end_point STRING, method STRING, data STRUCT<{_HEAD}>"
DOCUMENT_CODE_SCHEMA = (f"id STRING, department {_ACCOUNT}, "
                        f"line_items ARRAY<STRUCT<id: STRING, department: {_ACCOUNT}>>")
FULL_SCHEMA = (f"end_point STRING, method STRING, data STRUCT<{_HEAD}, "
               f"exchange_rate: VARIANT, currency: {_CURRENCY}, project: {_ACCOUNT}, "
               f"customer: {_PARTY}, vendor: {_PARTY}, supplier: {_PARTY}, contact: {_PARTY}, "
               f"parent_memo: {_REFERENCE}, cash: {_MONEY_ITEM}, "
               f"payments: ARRAY<{_MONEY_ITEM}>, others: ARRAY<{_MONEY_ITEM}>, "
               f"line_items: ARRAY<{_LINE}>>")

_JSON_BLANKS = " \t\n\r"
_STRICT = {"allowSingleQuotes": "false"}


def _decode(text: Column) -> Column:
    """The text inside a JSON string; other texts as they are."""
    plain = F.ltrim(text, F.lit(_JSON_BLANKS))
    one = F.from_json(F.concat(F.lit("["), plain, F.lit("]")), "array<string>", _STRICT)
    return F.when(plain.startswith('"'), F.when(F.size(one) == 1, one[0])).otherwise(text)


def _object_text(text: Column) -> Column:
    """The text when the whole of it is one JSON object.

    A parser may stop after the first object. As the only item of an array and as the
    value of a field at once, nothing but blanks can follow it unnoticed: what closes the
    one is an error in the other.
    """
    # Trimming walks through the whole text, so a text that needs none is left alone. What
    # the object holds is only passed over, not read and written again.
    bare = text.startswith("{") & text.endswith("}")
    trimmed = F.when(bare, text).otherwise(F.trim(text, F.lit(_JSON_BLANKS)))
    items = F.from_json(F.concat(F.lit("["), trimmed, F.lit("]")), "array<struct<_none: string>>", _STRICT)
    field = F.from_json(F.concat(F.lit('{"x":'), trimmed, F.lit("}")), "x struct<_none: string>", _STRICT)
    return F.when(trimmed.startswith("{") & trimmed.endswith("}") & (F.size(items) == 1)
                  & field.x.isNotNull(), trimmed)


def _decode_rounds(df: DataFrame, source: str, target: str, rounds: int) -> DataFrame:
    """Add ``target``: ``source`` decoded up to ``rounds`` times, if an object."""
    step = F.col(source)
    for n in range(rounds - 1):
        df = S.once(df, **{f"_text_{n}": _decode(step)})
        step = F.col(f"_text_{n}")
    helpers = [f"_text_{n}" for n in range(rounds - 1)]
    return S.once(df, **{target: _object_text(step)}).drop(*helpers)


def object_texts(callbacks: DataFrame, rounds: int = 2) -> DataFrame:
    """Add ``object_text``: the body decoded up to ``rounds`` times, if it is an object; else null."""
    return _decode_rounds(callbacks, "body", "object_text", rounds)


def parse_bodies(callbacks: DataFrame, schema: str = FULL_SCHEMA, rounds: int = 2) -> DataFrame:
    """Add ``payload``, the typed body; its fields are null for other texts.

    A body is decoded at most ``rounds`` times: an object that was encoded as a
    string once needs two.
    """
    rows = _decode_rounds(callbacks, "body", "object_text", rounds)
    return S.once(rows, payload=F.from_json("object_text", schema, _STRICT)).drop("object_text")


def parse_documents_deep(callbacks: DataFrame) -> DataFrame:
    """Add ``document``, decoded up to three times, its ``data`` as well.

    A body without ``data`` is itself the document.
    """
    rows = _decode_rounds(callbacks, "body", "outer_text", 3)
    rows = S.once(rows, data_text=F.from_json("outer_text", "data STRING", _STRICT).data)
    rows = _decode_rounds(rows, "data_text", "inner_text", 3)
    text = F.when(F.col("data_text").isNull(), F.col("outer_text")).otherwise(F.col("inner_text"))
    inner = F.from_json(text, DOCUMENT_CODE_SCHEMA, _STRICT)
    return S.once(rows, document=inner).drop("outer_text", "data_text", "inner_text")


def resolve_window(since=None, until=None, watermark=None, initial_since=None, now=None):
    """Bounds of one extraction: (since exclusive, until inclusive, ad hoc).

    Bounds given by hand win; then the stored watermark less the overlap; then
    an explicit first day; then the default look-back from ``now``.
    """
    def stamp(value, end_of_day=False):
        if value is None or isinstance(value, datetime):
            return value
        at = datetime.fromisoformat(value)
        whole_day = end_of_day and len(value.strip()) == 10
        return at.replace(hour=23, minute=59, second=59) if whole_day else at

    if since is not None or until is not None:
        return stamp(since), stamp(until, end_of_day=True), True
    if watermark is not None:
        return watermark - timedelta(minutes=K.OVERLAP_MINUTES), None, False
    if initial_since is not None:
        return stamp(initial_since), None, False
    if now is None:
        raise ValueError("a first run needs initial_since or now")
    return now - timedelta(days=K.FIRST_RUN_DAYS), None, False


def scan_window(callbacks: DataFrame, since=None, until=None) -> DataFrame:
    """Live rows with a body inside (since, until]; reaches the scan as filters."""
    rows = callbacks.filter(F.col("body").isNotNull() & F.col("deleted_at").isNull())
    if since is not None:
        rows = rows.filter(F.col("created_at") > F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        rows = rows.filter(F.col("created_at") <= F.lit(until).cast("timestamp_ntz"))
    return rows


def known_modules(requested) -> list[str]:
    """The requested modules that exist, in the order asked for."""
    return [m for m in requested if m in K.MODULES]


def route(callbacks: DataFrame, modules=None, schema: str = FULL_SCHEMA) -> DataFrame:
    """Parse bodies and keep those of the wanted modules.

    The body's own ``method`` replaces the delivery verb of the feed.
    """
    wanted = known_modules(K.MODULES if modules is None else modules)
    parsed = parse_bodies(callbacks, schema)
    return (parsed
            .withColumn("module", S.endpoint_to_module(F.col("payload.end_point")))
            .filter(F.col("module").isin(*wanted))
            .select("callback_id", "created_at", "module",
                    F.col("payload.end_point").alias("end_point"),
                    F.col("payload.method").alias("method"),
                    F.col("payload.data.id").alias("source_id"),
                    F.col("payload.data.status").alias("status"),
                    F.col("payload.data").alias("data")))


def callback_window_extract(callbacks: DataFrame, since=None, until=None, modules=None,
                            schema: str = FULL_SCHEMA) -> DataFrame:
    return route(scan_window(callbacks, since, until), modules, schema)


def extract_frontier(callbacks: DataFrame, since=None, until=None) -> DataFrame:
    """Newest ``created_at`` over all scanned rows, parseable or not, by a scan of its own.

    Where the rows are extracted anyway, :func:`observed_extract` gives the same value
    from that scan.
    """
    return scan_window(callbacks, since, until).agg(F.max("created_at").alias("frontier"))


def observed_extract(callbacks: DataFrame, since=None, until=None, modules=None,
                     schema: str = FULL_SCHEMA) -> tuple[DataFrame, Observation]:
    """:func:`callback_window_extract` and an observation of its scan.

    The observation holds ``frontier``, the newest ``created_at`` of all scanned rows
    (parseable or not, of any module), once the first action over the rows has ended;
    read it with :func:`observed_frontier`. A maximum is the same however often a task
    is run again, so lost executors do not change it.
    """
    seen = Observation("extract")
    scanned = scan_window(callbacks, since, until).observe(seen, F.max("created_at").alias("frontier"))
    return route(scanned, modules, schema), seen


def observed_frontier(spark, seen: Observation) -> DataFrame:
    """One row, ``frontier``, from an observation of :func:`observed_extract` whose rows
    have been computed (else this waits for them); null when the window was empty."""
    return spark.createDataFrame([(seen.get["frontier"],)], "frontier timestamp_ntz")


def watermark_update(state: DataFrame, frontier: DataFrame, key: str = K.WATERMARK_KEY,
                     ad_hoc: bool = False, force: bool = False) -> DataFrame:
    """State after a successful run; hand-bounded runs leave it unless forced."""
    if ad_hoc and not force:
        return state
    new = frontier.filter(F.col("frontier").isNotNull()).select(
        F.lit(key).alias("state_key"), F.col("frontier").alias("watermark"))
    return state.join(new, "state_key", "left_anti").unionByName(new)


def callback_newest_n(callbacks: DataFrame, module: str, limit: int) -> DataFrame:
    """First ``limit`` documents of a module among the newest callbacks.

    Only the newest ``max(30 * limit, 300)`` rows are looked at, deleted ones
    included, so fewer than ``limit`` may come back. Both limits are the
    feature; they are taken as a distributed top-n.
    """
    order = [F.col("created_at").desc_nulls_last(), F.col("callback_id").desc()]
    newest = (callbacks.filter(F.col("body").isNotNull())
              .orderBy(*order).limit(max(limit * 30, 300)))
    return route(newest, [module], HEAD_SCHEMA).orderBy(*order).limit(limit)
