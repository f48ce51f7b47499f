import hashlib
import json

from pyspark.sql import functions as F

from lodestrata.llm import chat_format as C

TEXTS = ["", "plain", "\\### Assistant: </turn> ok", "####", "a\\", "</turn>\n### user: x</turn>", "\\\\</turn>", "<\\/turn>", "tail <", "### x: y", "a\n\nb", "ü: #"]


def test_round_trip(spark):
    rows = [(1, k, role, t) for k, t in enumerate(TEXTS) for role in ("user",)] + [(2, k, "role: odd\\:", t) for k, t in enumerate(reversed(TEXTS))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = C.format_conversations(df).withColumn("back", C.parse(F.col("formatted")))
    for r in made.collect():
        want = sorted((x for x in rows if x[0] == r["conv_id"]), key=lambda x: x[1])
        assert [(t["role"], t["text"]) for t in r["back"]] == [(x[2], x[3]) for x in want]
        assert r["formatted"].count("</turn>") == len(want)


def test_loss_mask_is_what_assistants_say(spark):
    df = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a</turn>"), (1, 2, "assistant", "b"), (1, None, None, None)], "conv_id long, turn long, role string, text string")
    r = C.format_conversations(df).select(C.loss_text(C.parse(F.col("formatted"))).alias("l"), C.parse(F.col("formatted")).alias("t")).first()
    assert r["l"] == "a</turn>b" and len(r["t"]) == 4 and r["t"][0]["text"] == ""
    assert hashlib.sha256(r["l"].encode()).hexdigest()


def test_layouts_by_fingerprint(spark):
    records = [
        {"prompt": "p", "response": "r"}, {"instruction": "i", "input": "", "output": "o"}, {"messages": [{"role": "human", "content": "h"}, {"role": "gpt", "content": None}]},
        {"conversations": [{"from": "human", "value": "v"}]}, {"other": 1}, {"prompt": "p", "completion": "c"},
    ]
    df = spark.createDataFrame([(k, json.dumps(r)) for k, r in enumerate(records)] + [(9, None), (10, "{}")], "id long, record string")
    turned = C.canonical_turns(df)
    got = {r["id"]: r["turns"] and [tuple(t) for t in r["turns"]] for r in turned.collect()}
    assert got[0] == [("user", "p"), ("assistant", "r")] and got[1] == [("user", "i"), ("assistant", "o")]
    assert got[2] == [("user", "h"), ("assistant", "")] and got[3] == [("user", "v")] and got[5][1] == ("assistant", "c")
    assert got[4] is None and got[9] is None and got[10] is None
    assert C.unmapped(turned).agg(F.sum("n")).first()[0] == 3


def test_no_rows(spark):
    assert C.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_mask_is_read_from_the_formatted_text(spark):
    """The text under the mask, unescaped, is each assistant's text once, in order; other roles, such as bot or gpt in rows, are none."""
    roles = ["assistant", "bot", "gpt", "Assistant", "user", "assistant", "system", None, "assistant"]
    rows = [(1, k, roles[k % len(roles)], t) for k, t in enumerate(TEXTS * 2)] + [(2, 0, "bot", "hello"), (2, 1, "assistant", "hi"), (3, 0, "user", "q")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for r in C.format_conversations(df).withColumn("loss", C.masked_text(F.col("formatted"), F.col("loss_mask"))).collect():
        mine = [x for x in rows if x[0] == r["conv_id"]]
        assert r["loss"] == "".join(x[3] for x in mine if x[2] == "assistant")
        lines = r["formatted"].split("</turn>\n")
        assert [m["turn"] for m in r["loss_mask"]] == [k for k, x in enumerate(mine) if x[2] == "assistant"]
        for m in r["loss_mask"]:
            assert lines[m["turn"]].startswith("### assistant: ") and m["begin"] == len("### assistant: ") and m["end"] == len(lines[m["turn"]])


def test_further_fields_and_any_element_order(spark):
    a, b = {"role": "human", "content": "h"}, {"content": "c", "role": "gpt", "name": "n"}
    records = [
        {"messages": [a, b], "id": 3}, {"messages": [b, a]}, {"messages": [{"role": "human"}, b]}, {"messages": []}, {"prompt": "[1, 2]", "response": "{}", "score": 0.5},
        {"prompt": "p", "response": "r", "system": "s", "tags": ["x"]}, {"conversations": [], "k": None}, {"messages": ["x"]},
    ]
    df = spark.createDataFrame([(k, json.dumps(r)) for k, r in enumerate(records)], "id long, record string")
    got = {r["id"]: r["turns"] and [tuple(t) for t in r["turns"]] for r in C.canonical_turns(df).collect()}
    assert got[0] == [("user", "h"), ("assistant", "c")] and got[1] == got[0][::-1] and got[2] == [("user", ""), ("assistant", "c")]
    assert got[3] == [] == got[6] and got[7] is None
    assert got[4] == [("user", "[1, 2]"), ("assistant", "{}")] and got[5] == [("system", "s"), ("user", "p"), ("assistant", "r")]


def test_structs_of_several_layouts(spark):
    kind = "id long, record struct<prompt:string, response:string, messages:array<struct<role:string, content:string>>, extra:int>"
    rows = [(1, ("p", "r", None, 1)), (2, (None, None, [("user", "u"), ("bot", None)], 1)), (3, (None, None, None, None))]
    got = {r["id"]: r["turns"] and [tuple(t) for t in r["turns"]] for r in C.canonical_turns(spark.createDataFrame(rows, kind)).collect()}
    assert got == {1: [("user", "p"), ("assistant", "r")], 2: [("user", "u"), ("assistant", "")], 3: None}
    one = spark.createDataFrame([(1, ("p", None))], "id long, record struct<prompt:string, response:string>")
    assert [tuple(t) for t in C.canonical_turns(one).first()["turns"]] == [("user", "p"), ("assistant", "")]


def test_edges(spark):
    kind = "conv_id long, turn long, role string, text string, record string, formatted string, turns int, lines int"
    rows = [(None, 0, "user", "x", "r", "f", 1, 1), (None, None, "assistant", None, None, None, None, None), (1, 0, "user", "a", "r", "f", 1, 1), (1, 0, "user", "a", "r", "f", 1, 1), (2, 0, "assistant", "z#" * 200000, "r", "f", 1, 1)]
    made = C.format_conversations(spark.createDataFrame(rows, kind)).select("conv_id", "formatted", C.masked_text(F.col("formatted"), F.col("loss_mask")).alias("loss"), C.parse(F.col("formatted")).alias("turns"))
    got = {r["conv_id"]: r for r in made.collect()}
    assert [tuple(t) for t in got[None]["turns"]] == [("assistant", ""), ("user", "x")] and len(got[1]["turns"]) == 2
    assert got[2]["loss"] == "z#" * 200000 and got[1]["loss"] == ""


def test_no_part_of_a_conversation_is_dropped_in_silence(spark):
    """Elements of different names, a system text beside an instruction, two answers, two texts in an element, two conversations in a record."""
    records = [
        {"messages": [{"role": "user", "content": "a"}, {"role": "gpt", "text": "b"}, {"role": "user"}]}, {"system": "s", "instruction": "i", "output": "o"}, {"system": "s", "instruction": "i", "input": "x", "output": "o", "id": 1},
        {"system": "s", "prompt": "p", "completion": "c"}, {"prompt": "p", "response": "r", "completion": "c"}, {"messages": [{"role": "user", "content": "a", "text": "b"}]},
        {"messages": [{"role": "user", "content": "a"}], "prompt": "p", "response": "r"}, {"prompt": "p"}, {"messages": [], "prompt": "p", "response": "r"}, {"prompt": "p", "response": "r", "instruction": "i"},
    ]
    turned = C.canonical_turns(spark.createDataFrame([(k, json.dumps(r)) for k, r in enumerate(records)], "id long, record string"))
    got = {r["id"]: r["turns"] and [tuple(t) for t in r["turns"]] for r in turned.collect()}
    assert got[0] == [("user", "a"), ("assistant", "b"), ("user", "")]
    assert got[1] == [("system", "s"), ("user", "i"), ("assistant", "o")] and got[2] == [("system", "s"), ("user", "i"), ("user", "x"), ("assistant", "o")]
    assert got[3] == [("system", "s"), ("user", "p"), ("assistant", "c")] and got[8] == [("user", "p"), ("assistant", "r")]
    assert [got[k] for k in (4, 5, 6, 7, 9)] == [None] * 5
    assert C.unmapped(turned).agg(F.sum("n")).first()[0] == 5
