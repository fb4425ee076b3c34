import json
import random

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import chat
from corpusmill.functions.strict_json import parse_line, spaced_json
from corpusmill.operators import profile, records
from tests.helpers import column


def valid(text):
    try:
        json.loads(text.strip(), parse_constant=lambda c: json.loads("!"))
        return True
    except json.JSONDecodeError:
        return False


def test_strict_json_cases(spark):
    rows = [
        '{"text":"a"} x', "1] [2", '{"a":1}} {"b":2', "[1,]", "1 2", "{'a':1}", "", "5", "[1]",
        '"s"', "null", '{"a":[}', '　{"a":1} ', '{"a":1},', "]", "[", "} {", "NaN",
        '{"a":"] ["}', "1,2",
    ]
    got = column(spark, rows, lambda c: parse_line(c).isNotNull())
    assert got == [valid(r) for r in rows]


def test_strict_json_random_mutations(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(2000):
        text = list(json.dumps({"a": [1, "x] [", {"b": None}], "t": "} {"}))
        for _ in range(rng.randrange(0, 3)):
            at = rng.randrange(len(text))
            text[at] = rng.choice(["", '"', "]", "[", "{", "}", ",", " ", "1"])
        rows.append("".join(text))
    got = column(spark, rows, lambda c: parse_line(c).isNotNull())
    assert [r for r, g in zip(rows, got) if g != valid(r)] == []


def test_last_duplicate_key_wins(spark):
    text = column(spark, ['{"text":"a","text":"b"}'], lambda c: records.text_of(parse_line(c)))
    assert text == ["b"]


def test_text_and_reasons(spark):
    rows = {
        "": "blank_line", " 　": "blank_line", "{": "malformed", "[1]": "not_object",
        "{}": "missing_text", '{"text":null}': "empty_text", '{"text":""}': "empty_text",
        '{"text":5}': "non_string", '{"text":[]}': "non_string", '{"text":" "}': "blank_text",
        '{"text":"a"}': "kept",
    }
    df = spark.createDataFrame([(k,) for k in rows], "value string")
    report = {r.reason: r.lines for r in profile.scan_report(df).collect()}
    want = {}
    for reason in rows.values():
        want[reason] = want.get(reason, 0) + 1
    assert report == want
    assert [r.text for r in records.valid_texts(df).collect()] == ["a"]


def test_profile(spark):
    df = spark.createDataFrame(
        [(1, '{"text":"abc"}'), (2, "x"), (3, '{"text":"de"}'), (4, '{"text":"zzzz"}')],
        "line_no long, value string",
    )
    assert tuple(profile.corpus_profile(df, 3).first()) == (3, 2, 5, 2)
    assert tuple(profile.corpus_profile(df.filter("line_no = 2")).first()) == (1, 0, 0, 0)


def plain_chat(record):
    turns = record.get("conversations")
    if not isinstance(turns, list) or not turns or not all(isinstance(t, dict) for t in turns):
        return None
    names = {"human": "user", "gpt": "assistant", "assistant": "assistant"}
    out = [
        (names[t["from"]], t.get("value", "")) for t in turns if t.get("from") in names
    ]
    return [("system", chat.SYSTEM_PROMPT), *out] if out else None


def test_to_chat_cases(spark):
    cases = [
        {"conversations": [{"from": "human"}, {"from": "gpt", "value": None}]},
        {"conversations": [{"from": "tool", "value": "x"}]},
        {"conversations": [{"from": "human", "value": "x"}, 5]},
        {"conversations": "human"},
        {"conversations": []},
        {"conversations": {"from": "human"}},
        {},
        {"conversations": [{"from": "assistant", "value": "你好"}, {"from": "x", "value": "y"}]},
    ]
    df = spark.createDataFrame(
        [(i, json.dumps(c)) for i, c in enumerate(cases)], "i int, value string"
    )
    found = records.to_chat(records.parse_json_strict(df)).collect()
    got = {r.i: [(m.role, m.content) for m in r.messages] for r in found}
    want = {i: plain_chat(c) for i, c in enumerate(cases)}
    assert got == {i: w for i, w in want.items() if w}


def frame(role, content):
    return f"<|im_start|>{role}\n{content}<|im_end|>\n"


@pytest.mark.parametrize(
    "record, want",
    [
        ({"instruction": "q", "input": "", "output": "a"}, frame("user", "q") + frame("assistant", "a")),
        ({"instruction": "q", "input": "i", "response": "r"}, frame("user", "q\ni") + frame("assistant", "r")),
        ({"instruction": "q", "output": None, "response": "r"}, frame("user", "q") + frame("assistant", "")),
        ({"instruction": "q"}, frame("user", "q") + frame("assistant", "")),
        ({"messages": [{"role": "tool", "content": "x"}, {"content": "y"}, {"role": "user"}]},
         frame("tool", "x") + frame("user", "y") + frame("user", "")),
        ({"messages": None, "conversation": [{"role": "user", "content": "x"}]}, frame("user", "x")),
        ({"messages": [], "conversation": [{"role": "user", "content": "x"}]}, None),
        ("plain 你", frame("user", "plain 你")),
        (5, None),
        ({"a": [1, {"b": "x, y: z"}], "c": "é \n\""}, None),
        ([{"role": "system", "content": "s"}, {"role": "tool", "content": "t"}], frame("system", "s")),
        ([1, 2], None),
    ],
)
def test_render_any(spark, record, want):
    value = json.dumps(record, separators=(",", ":"))
    df = spark.createDataFrame([(value,)], "value string")
    got = records.render_records(df).first().rendered
    assert got == (want or frame("user", json.dumps(record, ensure_ascii=False)))


def test_spaced_json_matches_python(spark):
    values = [{"a": [1, 2, {"x": "a,b:c"}], "b": None, "c": True}, [], {}, [[[]]], "x\\y\"z"]
    values += [["\\", "\\\"", "\"\\", "\\\\"], {"long": "é, \n\"\\" * 30_000, "plain": "z" * 50_000}]
    rows = [json.dumps(v, separators=(" , ", " :")) for v in values]
    want = [json.dumps(v, ensure_ascii=False) for v in values]
    assert column(spark, rows, spaced_json) == want


def test_render_chat_skips_other_roles(spark):
    df = spark.sql(
        "SELECT array(named_struct('role','user','content','q'),"
        " named_struct('role','tool','content','t'),"
        " named_struct('role','assistant','content',CAST(NULL AS STRING))) AS m"
    )
    text = df.select(chat.render_chat(F.col("m"), add_generation_prompt=True)).first()[0]
    assert text == frame("user", "q") + frame("assistant", "") + "<|im_start|>assistant\n"


def test_long_records_are_kept_and_limits_are_named(spark):
    from corpusmill.operators.profile import scan_report
    from corpusmill.operators.records import prepare_lines, valid_texts

    lines = spark.createDataFrame(
        [(1, 21_000_000, "a"), (2, 140_000_000, "b")], "k int, n int, c string"
    ).select("k", F.concat(F.lit('{"text": "'), F.expr("repeat(c, n)"), F.lit('"}')).alias("value"))
    number = '{"text": "x", "n": ' + "7" * 1200 + "}"
    deep = '{"text": "x", "n": ' + "[" * 1100 + "]" * 1100 + "}"
    wide = spark.range(1).select(
        F.concat(F.lit('{"other": "'), F.expr("repeat('c', 140000000)"), F.lit('"}')).alias("value")
    )
    rest = spark.createDataFrame([(number,), (deep,), ("{",), ("{'text': 'x'}",)], "value string")
    found = {r.reason: r.lines for r in scan_report(lines.select("value").union(rest).union(wide)).collect()}
    assert found == {"kept": 3, "too_deep": 1, "malformed": 2, "too_large": 1}
    sizes = valid_texts(lines).select("k", F.length("text").alias("n")).collect()
    assert sorted(map(tuple, sizes)) == [(1, 21_000_000), (2, 140_000_000)]
    assert prepare_lines(lines.filter("k = 1"), "pretrain").count() == -(-21_000_000 // 512)
