import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from threadloom.llm import substrings as s


def cut(texts, shape=s.BYTES_400, order=None):
    """(bytes, removed runs) of each text, by counting every string; ``order`` gives each text's place, by which the first copy stays."""
    data = [(t or "").encode() for t in texts]
    at = {}
    for k, d in enumerate(data):
        for i in range(len(d) - shape.length + 1):
            at.setdefault(d[i : i + shape.length], []).append((order[k] if order else k, i))
    out = []
    for k, d in enumerate(data):
        gone = np.zeros(len(d) + 1, np.int64)
        for i in range(len(d) - shape.length + 1):
            places = at[d[i : i + shape.length]]
            if (order[k], i) > min(places) if order else len(places) > 1:
                gone[i] += 1
                gone[i + shape.length] -= 1
        edge = np.flatnonzero(np.diff(np.pad((np.cumsum(gone)[:-1] > 0).astype(np.int8), 1)))
        runs = list(zip(edge[::2].tolist(), edge[1::2].tolist()))
        if shape.words:
            spans = [m.span() for m in re.finditer(rb"\S+", d)] + [(len(d), len(d) + 1)]
            inside = [[i for i, (x, y) in enumerate(spans) if a <= x and y <= b] for a, b in runs]
            runs = [(spans[w[0]][0], min(b, spans[w[-1] + 1][0])) for w, (_, b) in zip(inside, runs) if len(w) >= shape.words]
        out.append((d, runs))
    return out


def left(d, runs):
    return b"".join(d[a:b] for a, b in zip([0, *[b for _, b in runs]], [*[a for a, _ in runs], len(d)]))


def brute(texts):
    """(n_bytes, n_removed, n_spans, sha256 of what is left, n_passages, passage_bytes) of each text."""
    passages = [runs for _, runs in cut(texts, s.WORDS_50)]
    size = lambda runs: sum(b - a for a, b in runs)
    return [(len(d), size(runs), len(runs), hashlib.sha256(left(d, runs)).hexdigest(), len(p), size(p)) for (d, runs), p in zip(cut(texts), passages)]


def places(spark, texts):
    """The order of texts in which the first copy stays: by their keys."""
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").select("i", *s._keys("text")).collect()
    return [tuple(r)[1:] for r in sorted(rows)]


def corpus(seed, n=60, alphabet="ab cdéß"):
    rng = random.Random(seed)
    text = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    passages = [text(rng.choice([380, 399, 400, 401, 450, 900])) for _ in range(6)]
    out = [None, "", "x" * 399, "x" * 400, "y" * 1000, "abc" * 300, "abc" * 300]
    for _ in range(n):
        parts = [text(rng.randrange(300)) for _ in range(rng.randrange(1, 4))]
        for _ in range(rng.randrange(3)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(passages))
        out.append("".join(parts))
    for _ in range(n // 2):  # near copies
        t = list(rng.choice(out[7:]))
        for _ in range(rng.randrange(4)):
            if t:
                t[rng.randrange(len(t))] = rng.choice(alphabet)
        out.append("".join(t))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_report_matches_brute_force(spark, seed):
    texts = corpus(seed, alphabet="ab" if seed == 2 else "ab cdéß")
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string").repartition(3)
    found = {r["doc_id"]: tuple(r)[1:] for r in s.report(docs).collect()}
    expected = dict(enumerate(brute(texts)))
    assert found == expected
    assert any(x[1] for x in expected.values())


def test_crowded_anchors(spark):
    texts = corpus(7)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    keys = places(spark, texts)
    for keep, expected in (("none", cut(texts)), ("first", cut(texts, order=keys))):
        by = {}
        for r in s.repeats(docs, [s.BYTES_400], keep=keep, hot=1).collect():
            by.setdefault((r["k1"], r["k2"]), []).append((r["lo"], r["hi"]))
        for key, (_, runs) in zip(keys, expected):
            assert s.removed_ranges(10**9, by.get(key, [])) == runs


@pytest.mark.parametrize("shape", [s.BYTES_400, s.Shape(200, 50), s.WORDS_50])
def test_first_copy_stays(spark, shape):
    """Distinct texts: what is left equals brute force, and each string that was there is still there once."""
    texts = [t for t in dict.fromkeys(corpus(11, alphabet="ab cdéß")) if t is not None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r["text"] for r in s.deduplicate(docs, shape=shape, keep="first").collect()}
    expected = [left(*x).decode("utf-8", "ignore") for x in cut(texts, shape, places(spark, texts))]
    assert [found[i] for i in range(len(texts))] == expected
    assert any(a != b for a, b in zip(texts, expected))


def test_equal_rows_count_as_one_text_when_the_first_stays(spark):
    text = "".join(map(str, range(400)))
    docs = spark.createDataFrame([(1, text), (2, text), (1, text)], "doc_id long, text string")
    assert [r["text"] for r in s.deduplicate(docs, keep="first").collect()] == [text] * 3
    assert [r["text"] for r in s.deduplicate(docs).collect()] == [""] * 3


@pytest.mark.parametrize("stays", [False, True])
def test_small_batches_see_the_same(stays):
    """Equal contexts, and anchors of several contexts, that lie across batches."""
    rng = np.random.default_rng(5)
    rows = np.array(sorted((rng.integers(4), rng.integers(3), 1 + (rng.random() < 0.2), rng.integers(3), 7, rng.integers(3)) for _ in range(60)))
    rows = rows[np.lexsort((rows[:, 5], rows[:, 3], rows[:, 1], rows[:, 0]))]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([np.zeros(60), *rows.T], kinds)], names=["s", "h", "ctx", "n", "k1", "k2", "run"])
    seen = []
    for step in (60, 1, 2, 7):
        out = s._classify(iter([batch.slice(i, step) for i in range(0, 60, step)]), stays)
        seen.append({tuple(r.values()) for b in out for r in b.to_pylist()})
    assert seen[0] and all(x == seen[0] for x in seen)
    members = {}
    for h, ctx, n, k1, _, run in rows.tolist():
        members.setdefault((h, ctx), []).append((k1, run, n))
    whole = {(0, 0, h, k1, 7, run) for (h, _), m in members.items() for k1, run, n in (m if not stays else [x for x in m if x[:2] != m[0][:2]]) if len(m) > 1 or n > 1}
    assert {x for x in seen[0] if x[0] == 0} == whole


def test_names_that_clash(spark):
    docs = spark.createDataFrame([(1, "x" * 500, 1, 2, "c")], "doc_id long, text string, _spans int, __SPANS int, _key_a string")
    kept = s.deduplicate(docs)
    assert kept.columns == docs.columns and kept.collect()[0].asDict() == {"doc_id": 1, "text": "", "_spans": 1, "__SPANS": 2, "_key_a": "c"}


def test_shapes_out_of_bounds():
    for bad in ((10, 20), (5000, 10), (10, 0)):
        with pytest.raises(ValueError):
            s.Shape(*bad)


def test_repeated_rows_nulls_and_empty_tables(spark):
    rows = [(1, "p" * 100 + "q" * 500), (1, "p" * 100 + "q" * 500), (None, "".join(map(str, range(400)))), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((tuple(r)[:4] for r in s.report(docs).collect()), key=str)
    expected = sorted(((i, *x[:3]) for (i, _), x in zip(rows, brute([t for _, t in rows]))), key=str)
    assert found == expected
    assert s.report(docs.limit(0)).count() == 0
    kept = s.deduplicate(docs.selectExpr("doc_id", "text", "1 as k1", "'a' as h"))
    assert kept.columns == ["doc_id", "text", "k1", "h"]
    assert sorted((len(r["text"]) if r["text"] is not None else -1) for r in kept.collect()) == [-1, 0, 0, 1090]


def test_construction_by_itself():
    rng = random.Random(3)
    base = bytes(rng.randrange(97, 100) for _ in range(700))
    other = bytearray(base)
    other[50] = 120
    found = s.repeated_starts([base, bytes(other), base[::-1]], np.array([300, 300, 300]))
    assert found[:, 2].sum() == 0
    assert found[:, 0].tolist() == [x < 250 for x in range(301)] == found[:, 1].tolist()


def test_strings_of_crowded_anchors_go_out_in_few_batches():
    shape = s.Shape(8, 4)
    texts = [bytes(f"{i:04d}abcdefgh", "ascii") for i in range(1200)]
    run = s._pack(np.full(1200, 5), np.full(1200, 9), np.full(1200, 9))
    rows = pa.RecordBatch.from_arrays([pa.array(np.zeros(1200, np.int32)), pa.array(run), pa.array(np.arange(1200)), pa.array(np.arange(1200) + 7), pa.array(np.ones(1200, np.int32)), pa.array(texts, pa.binary())], names=["s", "run", "k1", "k2", "kind", "bytes"])
    found = list(s._hot_windows(iter([rows]), [shape]))
    want = [(0, xxhash.xxh3_128_digest(t[i : i + 8]), k, k + 7, 5 + i, 1) for k, t in enumerate(texts) for i in range(5)]
    assert [tuple(r.values()) for b in found for r in b.to_pylist()] == want and len(found) == 3
