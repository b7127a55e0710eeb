import json

import pytest
from pyspark.sql import functions as F

from rescuelens import lexicons as lx
from rescuelens.operators import answers, chat, synthetic
from rescuelens.plans import review, training

GOOD = {"needs": ["water"], "urgency": "high", "life_threatening": False,
        "location": {"country": None, "province": "Hatay", "district": None,
                     "neighborhood": None, "address_note": None, "geo_confidence": 0.5},
        "people_count": 3, "vulnerable_groups": [], "post_type": "help_request",
        "confidence": 1}


def changed(drop=(), **values):
    record = {k: v for k, v in {**GOOD, **values}.items() if k not in drop}
    return json.dumps(record)


@pytest.mark.parametrize("raw, valid", [
    (json.dumps(GOOD), True), ("Sure: " + json.dumps(GOOD) + " done", True), ("{}", True),
    ("no brace", False), ("} {", False), ("{", False), ("}", False), ("", False), (None, False),
    ('{"a":1,}', False), ("{'a':1}", False), ('{"a":1} {"b":2}', False),
    ('{"a":1}, {"b":2}', False), ('{"a":1} null {', True), ('{"a":1} null {"b":2}', False), ('{"a":"\n"}', False),
    # stricter than a lenient parser, on purpose
    ('{"a":1,"a":2}', False), ('{"a":NaN}', False)])
def test_envelope(spark, raw, valid):
    row = answers.with_envelope(spark.createDataFrame([(raw,)], "t string"), "t").first()
    assert row.raw_text == raw and row.is_json == valid
    if valid:
        assert json.loads(row.parsed) and row.error is None or row.parsed == "{}"
    else:
        has_slice = raw is not None and -1 < raw.find("{") < raw.rfind("}")
        assert row.parsed is None
        assert row.error == (answers.BAD_JSON if has_slice else answers.NO_OBJECT)


@pytest.mark.parametrize("raw, want", [
    (changed(), []),
    (changed(drop=["urgency"]), ["urgency:missing"]),
    (changed(note=1, a=2), ["extra:a", "extra:note"]),
    (changed(urgency="soon"), ["urgency:value"]), (changed(urgency=None), ["urgency:type"]),
    (changed(confidence=1.4), ["confidence:value"]), (changed(confidence="1"), ["confidence:type"]),
    (changed(location=None), ["location:type"]),
    (changed(location={**GOOD["location"], "geo_confidence": -1}),
     ["location.geo_confidence:value"]),
    (changed(location={"country": 5}), ["location.country:type"] + [
        f"location.{k}:missing" for k in lx.LOCATION_KEYS[1:]]),
    (changed(people_count=3.5), ["people_count:type"]), (changed(people_count=None), []),
    (changed(needs=[1]), ["needs:type"]), (changed(needs="water"), ["needs:type"]),
    (changed(needs=["anything"]), []),
    (changed(vulnerable_groups=["cat"]), ["vulnerable_groups:value"]),
    (changed(post_type="help_offer"), ["post_type:value"]),
    (changed(life_threatening="no"), ["life_threatening:type"]),
    ("nope", ["object"]), ("[1]", ["object"]), (None, ["object"])])
def test_violations(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "t string")
    assert answers.with_violations(df, "t", answers.RUNTIME).first().violations == want


def test_corrected_profile(spark):
    raw = changed(needs=["food", "tents"], post_type="help_offer", dedup_cluster_id=5)
    df = spark.createDataFrame([(raw,)], "t string")
    assert answers.with_violations(df, "t", answers.CORRECTED).first().violations == [
        "needs:value", "dedup_cluster_id:type"]


def test_repair(spark):
    raws = ['{"post_type":"complaint","confidence":0.9,"dedup_cluster_id":"x"}',
            changed(post_type="emotion/prayer", needs=["food"]),
            changed(location={"country": None, "geo_confidence": 0.4})]
    df = spark.createDataFrame([(r,) for r in raws], "raw string")
    a, b, c = [r.label for r in review.review_answers(df, "raw").collect()]
    assert (a.needs, a.urgency, a.life_threatening, a.confidence) == ([], "low", False, 0.3)
    assert a.location.geo_confidence == 0.0 and a.dedup_cluster_id == "x"
    assert (b.urgency, b.confidence, b.location.geo_confidence) == ("high", 1.0, 0.5)
    assert c.location.geo_confidence == 0.0


def example(system="s", user="u", **extra):
    return json.dumps({"messages": [{"role": "system", "content": system},
                                    {"role": "user", "content": user},
                                    {"role": "assistant", "content": "{}"}], **extra})


ATTEMPTS = [
    (example(), None, True), (example(user="v", note=1), None, False), (None, "empty", False),
    ("", "empty", False), ("nope", "not_json", False), ("{} {}", "not_json", False),
    ("[]", "not_object", False), ("3", "not_object", False), ("{}", "messages", False),
    ('{"messages":3}', "messages", False), ('{"messages":null}', "messages", False),
    ('{"messages":[1,2]}', "messages", False), ('{"messages":[1,2,3]}', "user_content", False),
    ('{"messages":[1,{"content":5},3]}', "user_content", False),
    ('{"messages":[1,{"content":"w"},3]}', None, False),
    (json.dumps({"messages": json.loads(example())["messages"][::-1]}), None, False)]


def test_validation(spark):
    df = spark.createDataFrame([(i, a[0]) for i, a in enumerate(ATTEMPTS)], "i int, raw string")
    for r in synthetic.validated(df, "raw").collect():
        assert (r.reason, r.strict) == ATTEMPTS[r.i][1:], r.raw


def brute_accept(raws, target):
    seen, calls = [], 0
    for raw in raws[:3 * target]:
        if len(seen) == target:
            break
        calls += 1
        try:
            obj = json.loads(raw)
            content = obj["messages"][1]["content"] if len(obj["messages"]) == 3 else None
        except Exception:
            continue
        if isinstance(content, str) and content not in seen:
            seen.append(content)
    return seen, calls


@pytest.mark.parametrize("target", [1, 3, 4, 50])
def test_accept_matches_brute_force(spark, target):
    raws = [example(user=f"u{i % 5}") if i % 3 else "bad" for i in range(40)]
    df = spark.createDataFrame([(i + 1, r) for i, r in enumerate(raws)], "n bigint, raw string")
    contents, calls = brute_accept(raws, target)
    got = synthetic.accept(df, "n", "raw", target, lx.ATTEMPTS_PER_SAMPLE).orderBy("n").collect()
    assert [r.user_content for r in got] == contents
    totals = synthetic.attempt_totals(df, "n", "raw", target, lx.ATTEMPTS_PER_SAMPLE).first()
    assert (totals.accepted, totals.calls) == (len(contents), calls)


def test_first_by_role(spark):
    rows = [(1, 0, "user", ""), (1, 1, "user", "hi"), (1, 2, "user", "no"),
            (1, 3, "assistant", " yo "), (2, 0, "system", "S "), (2, 1, "user", None),
            (2, 2, "tool", "x")]
    df = spark.createDataFrame(rows, "c int, n int, role string, text string")
    got = {r.c: tuple(r)[1:] for r in chat.first_by_role(df, "c", "n", "role", "text").collect()}
    assert got == {1: ("", "hi", " yo "), 2: ("S ", "", "")}
    by_turns = {r.c: r.text for r in training.training_texts(df, "c", "n", "role", "text").collect()}
    assert by_turns == {1: "User: hi\nAssistant: yo", 2: "S\n\nUser: \nAssistant: "}
    packed = df.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("n", "role", "text"))).alias("m"))
    packed = packed.select("c", F.transform("m", lambda m: F.struct(
        m["role"].alias("role"), m["text"].alias("content"))).alias("messages"))
    assert sorted(r.text for r in training.message_texts(packed).collect()) == sorted(by_turns.values())


def test_messages(spark):
    df = spark.createDataFrame([(" sys ", "ask "), ("", "ask "), (None, "ask ")], "s string, u string")
    s, u = F.col("s"), F.col("u")
    split = [r[0] for r in df.select(chat.chat_messages(s, u, True)).collect()]
    assert [[tuple(m) for m in ms] for ms in split] == [
        [("system", " sys "), ("user", "ask ")], [("user", "ask ")], [("user", "ask ")]]
    merged = [r[0][0].content for r in df.select(chat.chat_messages(s, u, False)).collect()]
    assert merged == ["sys\n\nask", "ask ", "ask "]
    plain = [r[0] for r in df.select(chat.plain_prompt(s, u)).collect()]
    assert plain == [" sys \n\nUser: ask \nAssistant:", "ask ", "ask "]
    turn = df.limit(1).select(chat.render(chat.training_messages(s, u, F.lit("{content}{role}")),
                                          "<{role}>{content}</{role}>")).first()[0]
    assert turn == "<user>sys\n\nask</user><assistant>{content}{role}</assistant>"


def test_prompt_and_request(spark):
    df = spark.createDataFrame([(1, None, "çığ")], "a int, b string, c string")
    row = df.select(chat.fill_prompt("x {{SYSTEM_PROMPT}} y", F.col("c")),
                    chat.correction_messages("fix", F.struct("a", "b", "c"))).first()
    assert row[0] == "x çığ y"
    assert [tuple(m) for m in row[1]] == [("system", "fix"), ("user", '{"a":1,"b":null,"c":"çığ"}')]


def test_an_answer_is_parsed_once(spark):
    rows = [('So: {"needs":["su"],"people_count":3} ok',), ('{"needs":5,"people_count":"12"}',), ("{} , null, {}",),
            ('{"a":1}{"b":2}',), ("[{}]",), ('{"location":{"province":"Van","geo_confidence":"x"}}',), ("no",), (None,),
            ('{"urgency":7,"people_count":3.0,"confidence":1,"life_threatening":"true","vulnerable_groups":[1,null]}',)]
    out = review.review_answers(spark.createDataFrame(rows, "raw string"), "raw")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1 and "from_json" not in plan and "json_object_keys" not in plan
    got = [(r.is_json, r.label) for r in out.collect()]
    # the slice of the fifth is the object in the list
    assert [g[0] for g in got] == [True, True, False, False, True, True, False, False, True]
    assert got[0][1].people_count == 3 and got[0][1].needs == ["su"]
    assert got[1][1].people_count is None and got[1][1].needs == []
    assert got[5][1].location.province == "Van" and got[5][1].location.geo_confidence == 0.0
    last = got[8][1]
    # 3.0 is a whole number
    assert (last.urgency, last.people_count, last.confidence, last.life_threatening) == (None, 3, 1.0, None)
