"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to one string. Its
output is never parsed by the template's rules: every prefix of a conversation is
rendered, and consecutive outputs are compared. Turn i's span is what rendering
i + 1 turns adds to rendering i turns; within it, the text's place is found by
rendering turn i once more with a probe text in its place. A template whose output
for i turns is not a prefix of its output for i + 1 turns rewrites history: such
a conversation is flagged, and its texts are then found by probing each turn in
the whole conversation instead.

Conversations are grouped by conv_id and rendered in Python workers, one
conversation at a time; a conversation is the unit the template needs whole.
Rendering the prefixes costs turns x length per conversation.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

Turns = Sequence[tuple[str, str]]

# The control strings of the turn markers of the default template.
CONTROL = ["<<SYS>>", "<</SYS>>", "[/INST]", "[INST]", "</s>", "<s>"]
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(.)", re.S)
#: A text no escaped text can hold: it has private-use characters and no backslash.
PROBE = "probe"

SPANS = "array<struct<role:string,start:long,end:long>>"
OUT = f"conv_id long, formatted string, spans {SPANS}, rewrites_history boolean"


def escape(text: str) -> str:
    """Backslashes doubled, a backslash after the first character of each control string."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def unescape_column(text: Column) -> Column:
    """:func:`unescape` as a Spark expression."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def default_template(turns: Turns) -> str:
    """Instruction markers: a system turn opens an instruction, users close it, assistants end it."""
    out, before = [], None
    for role, text in turns:
        t = escape(text)
        if role == "system":
            out.append(f"<s>[INST] <<SYS>>\n{t}\n<</SYS>>\n\n")
        elif role == "assistant":
            out.append(f" {t} </s>")
        else:
            out.append(("" if before == "system" else "<s>[INST] ") + f"{t} [/INST]")
        before = role
    return "".join(out)


def _probe(template, turns: list, i: int, full: str, after: int | None):
    """Place (start, end) of turn i's escaped text in ``full``: render it with the probe in its place."""
    probed = template(turns[:i] + [(turns[i][0], PROBE)] + turns[i + 1:])
    at = probed.find(PROBE, after or 0)
    if at < 0:
        return None
    tail = len(probed) - at - len(PROBE)
    end = len(full) - tail
    if end < at or probed[:at] != full[:at] or probed[at + len(PROBE):] != full[end:]:
        return None
    return at, end


def render(turns: Turns, template: Callable[[Turns], str] = default_template):
    """(formatted, [(role, start, end)], rewrites_history) of one conversation.

    start and end are code point offsets of each turn's escaped text in ``formatted``.
    A turn whose text cannot be placed (the template does not substitute it as a
    whole) gets start = end = -1.
    """
    turns = [(r, t) for r, t in turns]
    spans, before, rewrites = [], "", False
    for i in range(len(turns)):
        now = template(turns[:i + 1])
        if not now.startswith(before):
            rewrites = True
            break
        spans.append(_probe(template, turns[:i + 1], i, now, len(before)) or (-1, -1))
        before = now
    full = template(turns)
    if rewrites:
        spans = [_probe(template, turns, i, full, None) or (-1, -1) for i in range(len(turns))]
    return full, [(r, s, e) for (r, _), (s, e) in zip(turns, spans)], rewrites


def _ordered(df: DataFrame) -> DataFrame:
    return df.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                     F.coalesce(F.col("role"), F.lit("user")).alias("role"),
                     F.coalesce(F.col("text"), F.lit("")).alias("text"))


def format_conversations(conversations: DataFrame, template: Callable[[Turns], str] = default_template) -> DataFrame:
    """(conv_id, formatted, spans, rewrites_history): one row per conversation.

    Turns are ordered by turn (null last), then role and text; a null role is ``user``,
    a null text empty. Rows with a null conv_id are each a conversation of their own,
    so nulls never gather in one group. Repeated rows are turns of their own. Other
    columns of the table are ignored. An empty table gives no rows.
    """
    rows = _ordered(conversations)
    keyed = rows.withColumn("_key", F.coalesce(F.col("conv_id").cast("string"),
                                               F.concat(F.lit("row-"), F.monotonically_increasing_id())))

    def each(group: pd.DataFrame) -> pd.DataFrame:
        g = group.sort_values(["turn", "role", "text"], na_position="last", kind="stable")
        full, spans, rewrites = render(list(zip(g["role"], g["text"])), template)
        conv = g["conv_id"].iloc[0]
        return pd.DataFrame({"conv_id": [None if pd.isna(conv) else int(conv)], "formatted": [full],
                             "spans": [[{"role": r, "start": s, "end": e} for r, s, e in spans]],
                             "rewrites_history": [rewrites]})

    return keyed.groupBy("_key").applyInPandas(each, OUT)


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and loss mask read from the formatted text: (conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars, rewrites_history). The loss mask covers each assistant text."""
    text = lambda s: unescape_column(F.col("formatted").substr(s["start"] + 1, s["end"] - s["start"]))
    turns = F.array_join(F.transform("spans", lambda s: F.concat(s["role"], F.lit("\n"), text(s), F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("spans", lambda s: s["role"] == "assistant"), text), "")
    return formatted.select(
        "conv_id", F.size("spans").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "rewrites_history")
