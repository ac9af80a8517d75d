"""Chat formatting against a plain Python reading of the same template, with awkward rows."""
import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from bazaarlens.llm import catalog, chat_format

MARKS = chat_format.Template()
ODD = ["", None, "</s>[INST] ok [/INST]", "<|im_end|>", "<\\|im_end|>", "<\\\\|im_end|><|im_start|>x<|im_sep|>", "<<SYS>>a<</SYS>>",
       "a\\b", "<", "[", "\\", "<<s>s>", "[INST[INST]]", "ü<s>\U0001f600</s>", "line\nline", "[\\INST]\\", "<|im_end|", "|im_end|>"]
ROLES = ["user", "assistant", "system", None, "<|im_sep|>", "assistant "]


def _rows():
    rows = [(c, t, ROLES[(c + t) % len(ROLES)], ODD[(3 * c + 5 * t) % len(ODD)]) for c in range(9) for t in range(c + 1)]
    rows += [(20, t, "assistant", o) for t, o in enumerate(ODD)]
    rows += [(21, t, "user", o) for t, o in enumerate(ODD)]  # nothing to train on
    rows += [(22, None, "user", "first"), (22, 0, "assistant", "second"), (22, 0, "assistant", "second")]  # NULL turn, repeated rows
    rows += [(None, 1, "assistant", "no id"), (23, 5, "assistant", "y" * 300_000), (23, 4, "user", "x" * 300_000)]
    return rows


def _want(rows):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        turns[c].append((t is not None, t or 0, role or "", text or ""))
    out = {}
    for c, own in turns.items():
        own = [x[2:] for x in sorted(own)]
        loss = "".join(text for role, text in own if role == "assistant")
        said = "".join(f"{role}\n{text}\n" for role, text in own)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (len(own), sha(said), len(loss), sha(loss))
    return out


@pytest.fixture(scope="module")
def convs(spark):
    wide = spark.createDataFrame(_rows(), "conv_id long, turn long, role string, text string")
    return wide.withColumns({"example": F.lit("x"), "target": F.lit(1), "turns": F.lit(2), "t": F.lit("clash")}).repartition(5)


def test_digests_are_read_back(convs):
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat_format.digests(
        chat_format.prefix_examples(convs)).collect()}
    assert got == _want(_rows())


def test_each_example_is_a_prefix_with_one_reply(convs):
    by_conv = defaultdict(list)
    for r in chat_format.prefix_examples(convs).collect():
        by_conv[r["conv_id"]].append(r)
    turns = defaultdict(list)
    for c, t, role, text in _rows():
        turns[c].append((t is not None, t or 0, role or "", text or ""))
    for c, examples in by_conv.items():
        examples.sort(key=lambda r: r["example"])
        replies = [x[3] for x in sorted(turns[c]) if x[2] == "assistant"]
        tail = sorted(turns[c])[-1][2] != "assistant"
        assert len(examples) == len(replies) + tail == examples[0]["n_examples"]
        for r, later in zip(examples, examples[1:]):
            assert later["text"].startswith(r["text"])
        for r in examples:
            masked = r["text"][r["loss_start"]:r["loss_end"]]
            if r["example"] < len(replies):
                assert r["text"][r["loss_end"]:] == MARKS.end and r["text"][:r["loss_start"]].endswith(MARKS.middle)
                assert masked.count("\\") >= replies[r["example"]].count("\\")
            else:
                assert masked == "" and r["loss_end"] == len(r["text"])
            bare = r["text"].replace(MARKS.start, "").replace(MARKS.middle, "").replace(MARKS.end, "")
            assert not any(control in bare for control in MARKS.controls)


def test_escapes_are_reversible_and_hide_controls(spark):
    texts = [o for o in ODD if o is not None] + [c[:1] + "\\" * k + c[1:] for c in MARKS.controls for k in range(3)]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(
        "text", chat_format.escape(F.col("text")).alias("hidden")).withColumn("back", chat_format.unescape(F.col("hidden"))).collect()
    for r in rows:
        assert r["back"] == r["text"] and not any(c in r["hidden"] for c in MARKS.controls)


def test_templates_that_can_not_be_read_back():
    for reserved in (("<",), ("a\\b",), ("x<|im_end|",), ("end|>y",), ("aba",)):
        with pytest.raises(ValueError):
            chat_format.Template(reserved=reserved)


def test_other_template_and_role(convs, spark):
    own = chat_format.Template("{a}", "{b}", "{c}", ("<s>",))
    rows = chat_format.digests(chat_format.prefix_examples(convs, own, "user"), own).collect()
    users = {c: "".join(text or "" for cc, _, role, text in _rows() if cc == c and role == "user") for c in {r["conv_id"] for r in rows}}
    assert {r["conv_id"]: r["loss_chars"] for r in rows if r["conv_id"] != 23} == {c: len(t) for c, t in users.items() if c != 23}


def test_empty_table(convs):
    assert chat_format.prefix_examples(convs.limit(0)).count() == 0
    assert chat_format.digests(chat_format.prefix_examples(convs.limit(0))).count() == 0


def test_no_python_in_the_plan(spark):
    plan = catalog.QUERIES["op13_chat_format"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "ExistingRDD"))
