import hashlib
import json

from hypothesis import given
from hypothesis import strategies as st

from quaver.llm import chat

TEXT = st.one_of(st.none(), st.text(), st.text(alphabet="\\#</turn> :\n"), st.sampled_from(["\\### Assistant: </turn> ok", " </turn>\n### user: x"]))


@given(st.lists(st.tuples(TEXT, TEXT), max_size=5))
def test_round_trip(turns):
    record = {"messages": [{"role": r, "content": t} for r, t in turns]}
    formatter = chat.Formatter()
    formatted, spans = chat.format_record(record, formatter)
    if turns:
        want = [(r or "", t or "") for r, t in turns]
        assert [x[:2] for x in chat.parse(formatted)] == want
        assert [chat.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in want if r == "assistant"]


def test_layouts(spark):
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"messages": [{"role": "user", "text": "q"}, {"role": "assistant", "text": "a"}], "id": 3},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"instruction": "q", "input": "", "output": "a"},
        {"question": "q", "answer": "a"},
        {"prompt": "q", "response": "a"},
        {"prompt": "q", "completion": "a"},
        {"system": "s", "prompt": "q", "response": "a"},
    ]
    odd = ["", "{", "[1]", json.dumps({"z": 1}), None]
    rows = chat.format_records(spark.createDataFrame([(json.dumps(r),) for r in records] + [(x,) for x in odd], "record string")).collect()
    for r in rows[:7]:
        assert [x[:2] for x in chat.parse(r.formatted)] == [("user", "q"), ("assistant", "a")]
        assert [r.formatted[s.start : s.end] for s in r.spans] == ["a"]
    assert [x[0] for x in chat.parse(rows[7].formatted)] == ["system", "user", "assistant"]
    assert all(r.formatted == "" for r in rows[8:])
    assert chat.fingerprint(chat.paths(records[0])) == chat.fingerprint(chat.paths({"messages": [{"content": 1, "role": "x"}]}))


def test_roles_of_rows_stay(spark):
    rows = spark.createDataFrame([(1, 0, "human", "q"), (1, 1, "gpt", "a"), (1, 2, "bot", "b")], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.query(rows).collect()}[1]
    assert got.turns_sha256 == hashlib.sha256(b"human\nq\ngpt\na\nbot\nb\n").hexdigest() and got.loss_chars == 0


def test_query(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, None, "system", "s"), (2, 0, None, "x"), (2, 0, "assistant", "é\\"), (2, 0, "assistant", "é\\"), (None, 0, "user", "")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as formatted", "2 as spans")
    got = {r.conv_id: r for r in chat.query(table).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert got[1].n_turns == 3 and got[1].turns_sha256 == sha("system\ns\nuser\nhi\nassistant\n\n") and got[1].loss_sha256 == sha("")
    assert (got[2].loss_chars, got[2].loss_sha256) == (4, sha("é\\é\\"))
    assert got[-7].loss_sha256 == sha("\\### Assistant: </turn> ok") and got[None].n_turns == 1
    assert chat.query(table.where("false")).count() == 1
