"""Chat formatting: read back against the input, escaping, templates that rewrite history."""

import hashlib

import duckdb
from hypothesis import given, settings, strategies as st

from saldoflow.llm import chat, oracles

ROWS = "conv_id long, turn long, role string, text string, extra string"


@given(st.text(alphabet=st.sampled_from(list("ab\\<>[]/sINST SY ")), max_size=40))
@settings(max_examples=300, deadline=None)
def test_escape_round_trip_and_no_control_left(text):
    e = chat.escape(text)
    assert chat.unescape(e) == text
    assert not any(c in e for c in chat.CONTROL)


def expected(turns):
    t = "".join(f"{r}\n{x}\n" for r, x in turns)
    loss = "".join(x for r, x in turns if r == "assistant")
    return hashlib.sha256(t.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_render_spans_hold_the_texts():
    turns = [("system", "be brief \\"), ("user", " x"), ("assistant", " </s>[INST] ok [/INST] "), ("user", ""),
             ("assistant", "")]
    full, spans, rewrites = chat.render(turns)
    assert not rewrites
    assert [chat.unescape(full[s:e]) for _, s, e in spans] == [t for _, t in turns]


def test_history_rewriting_template_is_flagged_and_still_read():
    def counted(turns):
        return f"[{len(turns)} turns]" + "".join(f"<{r}>{chat.escape(t)}</{r}>" for r, t in turns)
    turns = [("user", "hi"), ("assistant", "yo"), ("user", "bye")]
    full, spans, rewrites = chat.render(turns, counted)
    assert rewrites
    assert [chat.unescape(full[s:e]) for _, s, e in spans] == ["hi", "yo", "bye"]


def test_read_back_against_input_and_sql(spark, tmp_path):
    rows = [(1, 0, "user", "a\\b", "x"), (1, 1, "assistant", "<s>é</s>", None), (1, 2, None, None, None),
            (2, 1, "assistant", "same", None), (2, 1, "assistant", "same", None), (2, 0, "system", "[INST]", None),
            (2, 2, "user", "q", None), (3, None, "user", "late", None), (3, 0, "assistant", "🙂" * 3, None),
            (None, 0, "user", "alone", None), (None, 0, "assistant", "also", None),
            (4, 0, "user", "x" * 200_000, None)]
    df = spark.createDataFrame(rows, ROWS)
    got = {(r.conv_id, r.turns_sha256): r for r in chat.read_back(chat.format_conversations(df)).collect()}
    assert len(got) == 6
    convs = {}
    for c, t, r, x, _ in rows:
        key = c if c is not None else f"row-{x}"
        convs.setdefault(key, []).append((c, t, r or "user", x or ""))
    for key, ts in convs.items():
        ts.sort(key=lambda z: (z[1] is None, z[1] or 0, z[2], z[3]))
        turns = [(r, x) for _, _, r, x in ts]
        th, lc, lh = expected(turns)
        r = got[(ts[0][0], th)]
        assert (r.n_turns, r.loss_chars, r.loss_sha256, r.rewrites_history) == (len(turns), lc, lh, False)
        assert r.formatted_chars == len(chat.default_template(turns))
    df.toPandas().to_parquet(tmp_path / "c.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path / 'c.parquet'}'")
    sql = {(r[0], r[2]): r for r in con.execute(oracles.CHAT).fetchall() if r[0] != -7}
    assert {k: (v[1], v[3], v[4], v[5]) for k, v in sql.items()} == {
        k: (v.n_turns, v.loss_chars, v.loss_sha256, v.formatted_chars) for k, v in got.items()}


def test_empty_table(spark):
    assert chat.format_conversations(spark.createDataFrame([], ROWS)).count() == 0
