from __future__ import annotations

from freshet.llm import perspectives

TURNS = "conv_id long, turn long, role string, text string, speaker string, name string, start long, n_chars long"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "old", "old", 1, 1) for r in rows], TURNS)


ROWS = [
    (1, 0, "system", "Be kind."), (1, 1, "ann", "Hi"), (1, 2, "bob", "Hello"), (1, 3, "ann", None), (1, 3, "ann", None),
    (2, None, None, "who"), (2, 5, "bob", ""), (None, 1, "eve", "x"), (3, 0, "system", "alone"), (4, 2, "b", "2"), (4, 1, "a", "1é"),
]


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is None, r[1] or 0, r[2] is None, r[2] or "", r[3] or ""))
        for speaker in {r[2] for r in own if r[2] not in (None, "system")}:
            whole, masks = "", []
            for _, _, role, text in own:
                kind = "assistant" if role == speaker else "system" if role == "system" else "user"
                whole += f"<|user name={role or 'unknown'}|>\n" if kind == "user" else f"<|{kind}|>\n"
                start = len(whole)
                whole += (text or "") + "<|end|>\n"
                if kind == "assistant":
                    masks.append((start, len(whole)))
            out[conv, speaker] = (whole, masks)
    return out


def test_renderings_and_masks(spark, monkeypatch):
    want = brute(ROWS)
    for chunk in (perspectives.CHUNK, 2):
        monkeypatch.setattr(perspectives, "CHUNK", chunk)
        rows = perspectives.rotated(turns(spark, ROWS))
        got = {(r["conv_id"], r["speaker"]): (r["text"], [tuple(m) for m in r["masks"]]) for r in perspectives.dialogues(rows).collect()}
        assert got == want
        for r in rows.collect():
            whole = want[r["conv_id"], r["speaker"]][0]
            assert whole[r["start"] : r["start"] + r["n_chars"]] == r["segment"]
        places = sorted(r["place"] for r in rows.collect() if (r["conv_id"], r["speaker"]) == (1, "ann"))
        assert places == [0, 1, 2, 3, 4]


def test_empty_table(spark):
    assert perspectives.rotated(turns(spark, [])).count() == 0


def test_plan_has_no_python_and_no_cross_join(spark):
    plan = perspectives.rotated(turns(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_long_texts_and_long_dialogues(spark):
    """Three hundred turns of one dialogue in many chunks, texts of up to a million characters."""
    rows = [(7, i, ("ann", "bob", "cy", "system", None)[i % 5], "é" * (1_000_000 if i == 150 else i)) for i in range(300)]
    want = brute(rows)
    before = perspectives.CHUNK
    try:
        perspectives.CHUNK = 16
        out = perspectives.rotated(turns(spark, rows)).select("speaker", "turn", "place", "start", "segment", "mask_start", "mask_end").collect()
    finally:
        perspectives.CHUNK = before
    assert len(out) == 3 * 300
    for r in out:
        whole, masks = want[7, r["speaker"]]
        assert r["place"] == r["turn"] and whole[r["start"] : r["start"] + len(r["segment"])] == r["segment"]
        assert r["mask_start"] is None or (r["mask_start"], r["mask_end"]) in masks


def test_texts_are_shuffled_once(spark):
    df = perspectives.rotated(turns(spark, ROWS))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("REPARTITION_BY_COL") == 1 and "SortMergeJoin [_key" in plan
    # From there to the result nothing is exchanged.
    above = plan[: plan.index("SortMergeJoin [_key")]
    assert "Exchange" not in above and "Window [" in above
