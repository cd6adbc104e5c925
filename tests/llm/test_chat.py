import hashlib
import random

import pytest

from threadloom.llm import chat


def expected(rows):
    convs = {}
    for i, (c, turn, role, text) in enumerate(rows):
        convs.setdefault((c, i) if c is None else c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs[-7] = [(True, i, r, "</s>[INST] ok [/INST]") for i, r in enumerate(["user", "assistant"])]
    out = {}
    for c, turns in convs.items():
        turns = [(r, t) for _, _, r, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        text = "".join(chat.segment(r, t)[0] for r, t in turns)
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text))
    return out


def made(seed, n=80):
    rng = random.Random(seed)
    texts = ["hi", "ok <s> \\ [ROLE] <\\", "", None, "</s>[/ROLE]", "naïve 🙂", "x" * 50]
    rows = []
    for c in range(n):
        for turn in range(rng.randrange(1, 7)):
            rows.append((c, turn, rng.choice(["user", "assistant"]) if turn else "system", rng.choice(texts) if turn else texts[c % 2]))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("text", ["", "\\", "<\\\\", "[<s>]", "</s>[INST] ok [/INST]", "<<[[\\<"])
def test_escapes_are_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    s, begin, size = chat.segment("r[/ROLE]", text)
    assert chat.parse(s + s) == [("r[/ROLE]", text)] * 2
    assert chat.unescape(s[begin : begin + size]) == text
    assert not any(x in chat.escape(text) for x in ("<s>", "</s>", "[ROLE]", "[/ROLE]"))


def test_report(spark):
    rows = made(1)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("depth", chat.F.lit(1))
    assert {r["conv_id"]: tuple(r)[1:] for r in chat.report(df).collect()} == expected(rows)


def test_tree(spark):
    rows = made(2)
    paths_of = {}
    for c, turn, role, text in rows:
        paths_of.setdefault(c, []).append((role or "", text or ""))
    distinct = {tuple(p[:k]) for p in paths_of.values() for k in range(1, len(p) + 1)}
    for size in (1000, 7):
        nodes, paths = chat.prefix_tree(spark.createDataFrame(rows, SCHEMA), range_rows=size)
        found = sorted(nodes.collect(), key=lambda r: r["start"])
        assert len(found) == len(distinct)
        end = 0
        for r in found:  # the flat sequence has no gap, and a node comes right after its parent's subtree so far
            assert r["start"] == end and len(r["segment"]) == r["size"]
            end += r["size"]
            assert r["position"] == sum(s["end"] - s["begin"] for s in r["ancestors"])
        by = {r["start"]: r for r in found}
        each = {}
        for p in paths.collect():
            each.setdefault(p["conv_id"], []).append((p["depth"], p["start"]))
        for c, p in each.items():
            starts = [s for _, s in sorted(p)]
            assert [chat.parse(by[s]["segment"])[0] for s in starts] == paths_of[c]
            spans = chat.merged([(s, s + by[s]["size"]) for s in starts[:-1]])
            assert [(x["begin"], x["end"]) for x in by[starts[-1]]["ancestors"]] == spans


def test_equal_conversations_are_one_path(spark):
    """However many conversations are equal, the walk meets their path once, and each gets all its nodes."""
    rows = [(c, turn, "user", f"t{turn}") for c in range(300) for turn in range(3)] + [(1000, 0, "user", "t0"), (1001, 0, "user", "other")]
    nodes, paths = chat.prefix_tree(spark.createDataFrame(rows, SCHEMA), range_rows=1)
    assert nodes.count() == 4 and paths.count() == 902
    assert {tuple(r)[1:] for r in chat.report(spark.createDataFrame(rows, SCHEMA)).filter("conv_id BETWEEN 0 AND 299").collect()} == {expected(rows)[0]}


def test_edges(spark):
    rows = [(None, 0, None, None), (None, None, "user", "a"), (1, 0, "user", "q"), (1, 0, "user", "q"), (2, 0, "user", "q"), (3, 0, "assistant", "z" * 200_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = [tuple(r) for r in chat.report(df).collect()]
    assert {c: tuple(x) for c, *x in found if c is not None} == {c: x for c, x in expected(rows).items() if isinstance(c, int)}
    assert sorted(x for c, *x in found if c is None) == sorted(list(x) for c, x in expected(rows).items() if not isinstance(c, int))
    assert [r["conv_id"] for r in chat.report(df.limit(0)).collect()] == [-7]
