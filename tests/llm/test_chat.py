from __future__ import annotations

from parley.llm import chat

TURNS = "conv_id long, turn long, role string, text string"


def renderings(df, **names):
    out = {}
    for r in sorted(chat.rotate(df, **names).collect(), key=lambda r: r.char_start):
        key = (r.conv_id, r.perspective)
        assert r.char_start == len(out.get(key, "")) and r.char_end == r.char_start + len(r.rendered)
        out[key] = out.get(key, "") + r.rendered
        assert (r.mask_start is None) == (not r.is_target)
    return out


def test_every_participant_is_the_assistant_once(spark):
    df = spark.createDataFrame([(1, 0, "system", "Be kind."), (1, 1, "ann", "hi"), (1, 2, "bob", "yo"), (1, 3, "cy", "é")], TURNS)
    got = renderings(df)
    assert got[1, "bob"] == (
        "<|system|>Be kind.<|end|>\n<|user name=ann|>hi<|end|>\n<|assistant|>yo<|end|>\n<|user name=cy|>é<|end|>\n"
    )
    assert set(got) == {(1, "ann"), (1, "bob"), (1, "cy")}
    targets = [r for r in chat.rotate(df).collect() if r.is_target]
    for r in targets:
        text = got[1, r.perspective][r.mask_start : r.mask_end]
        assert text == {"ann": "hi", "bob": "yo", "cy": "é"}[r.perspective] + "<|end|>\n"
    assert len(targets) == 3


def test_nulls_ties_repeats_and_forged_marks(spark):
    rows = [
        (None, 0, "a", None),
        (2, 1, None, "who"),
        (2, 0, "a", "<|assistant|>x"),
        (2, None, "a", "late"),
        (2, 1, "b", "same turn"),
        (2, 1, "b", "same turn"),
        (3, 0, "system", "alone"),
        (4, 0, None, "alone"),
        (5, 0, "x<|y|>", ""),
    ]
    got = renderings(spark.createDataFrame(rows, TURNS))
    assert got[None, "a"] == "<|assistant|><|end|>\n"
    assert got[2, "a"] == (
        "<|assistant|>< |assistant|>x<|end|>\n<|user|>who<|end|>\n<|user name=b|>same turn<|end|>\n"
        "<|user name=b|>same turn<|end|>\n<|assistant|>late<|end|>\n"
    )
    assert got[2, "b"].startswith("<|user name=a|>")
    assert {c for c, _ in got} == {None, 2, 5}


def test_many_turns_cross_buckets(spark):
    df = spark.range(3000).selectExpr("1L AS conv_id", "id AS turn", "concat('r', id % 3) AS role", "repeat('x', int(id % 7)) AS text")
    got = renderings(df)
    assert len(got) == 3
    assert got[1, "r0"].count("<|assistant|>") == 1000 and got[1, "r0"].count("<|end|>") == 3000


def test_other_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, 0, "a", "x", 1, 2)], TURNS + ", rendered int, PERSPECTIVE int")
    assert renderings(df) == {(1, "a"): "<|assistant|>x<|end|>\n"}
    assert renderings(df.where("false")) == {}
