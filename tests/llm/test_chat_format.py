import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rescuelens.llm import chat_format as cf

TEXTS = st.text(st.sampled_from(list("\\#</turn>: \nab\u00e9")) | st.characters(codec="utf-8"), max_size=30)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a:b", "\\", "###", ""]), TEXTS), min_size=1, max_size=6))
def test_round_trip(turns):
    spans = list(cf.run_spans(cf.marked_turns, [], turns))
    assert "".join(s[0] for s in spans) == cf.marked_turns(turns)
    for (role, text), (span, start, end, appended) in zip(turns, spans):
        assert appended and cf.read_turn(span) == (role, text)
        if role == "assistant":
            assert cf.unescaped(span[start:end]) == text
        else:
            assert start == -1


def test_control_text():
    text = r"\### Assistant: </turn> ok"
    span, start, end, _ = list(cf.run_spans(cf.marked_turns, [], [("user", text), ("assistant", text)]))[1]
    assert span == "### assistant: \\\\\\### Assistant: \\</turn> ok</turn>\n"
    assert cf.unescaped(span[start:end]) == text


def test_templates_that_rewrite_history_are_marked():
    def drops_old_answers(turns):
        return "".join(f"[{r}]{t if r == 'user' or k == len(turns) - 1 else ''}" for k, (r, t) in enumerate(turns))

    def counts_all(turns):
        return f"{len(turns)} turns\n" + "".join(f"[{r}]{t}" for r, t in turns)

    def looks_back_far(turns):
        return "".join(f"[{r}{turns[max(0, k - 2)][0]}]{t}" for k, (r, t) in enumerate(turns))

    turns = [("user", "q"), ("assistant", "answer"), ("user", "q2"), ("assistant", "a2")]
    assert [s[3] for s in cf.run_spans(drops_old_answers, [], turns)] == [True, True, False, True]
    assert not all(s[3] for s in cf.run_spans(counts_all, [], turns))
    assert not all(s[3] for s in cf.run_spans(looks_back_far, [], [("system", "x"), *turns[:3]]))
    assert all(s[3] for s in cf.run_spans(cf.marked_turns, [], turns))


def test_template_with_a_heading():
    def headed(turns):
        return "<s>" + cf.marked_turns(turns)
    spans = list(cf.run_spans(headed, [], [("user", "a"), ("assistant", "b")]))
    assert spans[0][0].startswith("<s>### user") and spans[1][0].startswith("### assistant")


def brute(rows):
    out = {}
    for conv_id in {r[0] for r in rows}:
        turns = sorted(((-1 if t is None else t, r or "", x or "") for c, t, r, x in rows if c == conv_id))
        loss = [x for _, r, x in turns if r == "assistant"]
        out[conv_id] = (
            len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest(),
            sum(map(len, loss)), hashlib.sha256("".join(loss).encode()).hexdigest(),
            len(cf.marked_turns([(r, x) for _, r, x in turns])))
    return out


ROWS = ([(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"), (1, 1, "assistant", "a")]
        + [(2, k, ("user", "assistant")[k % 2], f"turn {k} </turn> \\ ###") for k in range(200)]
        + [(3, 0, None, None), (3, None, "assistant", None), (None, 5, "assistant", "x"), (None, 4, "user", "y"),
           (4, 16, "user", "only"), (4, 40, "assistant", "gap"), (5, 0, "assistant", "long \\" * 50_000)])


def test_history_rewritten_from_far_away(spark):
    """A tool turn changes what was said in the first turn, twenty or a thousand turns before."""
    def notes_tools(turns):
        note = " (has tools)" if any(r == "tool" for r, _ in turns) else ""
        return "".join(f"[{r}{note if k == 0 else ''}]{t}" for k, (r, t) in enumerate(turns))

    for at, n in ((20, 40), (900, 901)):
        turns = [("system", "s")] + [("tool" if k == at else ("user", "assistant")[k % 2], f"t{k}") for k in range(1, n)]
        frame = spark.createDataFrame([(1, k, r, t) for k, (r, t) in enumerate(turns)],
                                      "conv_id long, turn long, role string, text string")
        marks = {r.place: r.appended for r in cf.formatted(frame, notes_tools).collect()}
        assert [k for k, appended in marks.items() if not appended] == [at] and len(marks) == n


@pytest.mark.parametrize("turns", [16, 1024])
def test_against_brute_force(spark, monkeypatch, turns):
    monkeypatch.setattr(cf, "RUN_TURNS", turns)
    frame = spark.createDataFrame([(*r, "extra") for r in ROWS],
                                  "conv_id long, turn long, role string, text string, span string")
    spans = cf.formatted(frame)
    assert spans.filter("NOT appended").count() == 0
    out = cf.read_back(spans).collect()
    assert {r.conv_id: tuple(r)[1:] for r in out} == brute(ROWS)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cf.read_back(cf.formatted(frame)).collect() == []


def test_reading_a_broken_span():
    with pytest.raises(ValueError):
        cf.read_turn("### user: no end")
