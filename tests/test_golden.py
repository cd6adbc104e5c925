"""Hand-made cases with known results."""

import json
import math
import random
import unicodedata
from collections import Counter
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from threadloom.functions import scalars as S
from threadloom.functions import text as T
from threadloom.operators import cleaning as C
from threadloom.operators import clustering as M
from threadloom.operators import evaluation as E
from threadloom.operators import languages as L
from threadloom.operators import profiling as P
from threadloom.operators import reassignment as A
from threadloom.operators import splitting as W
from threadloom.operators import topics as O
from threadloom.operators import validation as X
from threadloom.operators import vectors as V
from threadloom.plans import checks, models, runner, topics
from threadloom.plans.runner import Runner, Snapshot
from threadloom.sources import api, jsonl, shared, sinks
from threadloom.streaming import ingest


def column(spark, values, expression, kind="string"):
    return [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}").orderBy("i").select(expression(F.col("x"))).collect()]


ODD = ["", "Straße ÀÉ", "ﬁne ½ ｆｕｌｌ", "a b c\x1cd", "&lt;b&gt; &eacute; &amp;amp;", "ſ K", "Ёлка", None, "x &copy y"]


def test_text_functions_match_python(spark):
    assert column(spark, ODD, T.nfkc) == [None if x is None else unicodedata.normalize("NFKC", x) for x in ODD]
    assert column(spark, ODD, T.casefold) == [None if x is None else x.casefold() for x in ODD]
    assert column(spark, ODD, T.unescaped_nfkc) == [None if x is None else unicodedata.normalize("NFKC", unescape(x)) for x in ODD]
    assert column(spark, ODD, T.collapse) == [None if x is None else " ".join(x.split()) for x in ODD]
    assert column(spark, ODD, T.leakage_key) == [None if x is None else " ".join(unicodedata.normalize("NFKC", x).casefold().split()) for x in ODD]


def test_guarded_ranges_need_no_python():
    for c in [*range(0x80), *range(0xC0, 0x100), *range(0x400, 0x460)]:
        x = chr(c)
        assert unicodedata.normalize("NFKC", x) == x and x.casefold() == x.lower().replace("ß", "ss")


def test_gates(spark):
    cases = {"": "empty", "https://x.y/z": "url_only", "short": "too_short", "!!! ... ??? --- !!! ...": "no_alphanumeric", "спасибо супер класс!!!!": "acknowledgement", "what a looooooong word that is": "repeated_characters", "a perfectly normal sentence": "keep", "see <b>this</b> www.example.org page here": "keep"}
    df = spark.createDataFrame([(k,) for k in cases], "text string")
    assert {r["text"]: r["reason"] for r in C.classified(C.prepare(df, "text"), "text").collect()} == cases
    legacy = {"": "empty", "🙂🙂🙂🙂🙂": "too_short", "спасибо": "acknowledgement", "hello world": "foreign_language", "привет мир": "keep", "ab": "too_short"}
    assert dict(zip(legacy, column(spark, list(legacy), lambda x: C.legacy_reason(x, 3)))) == legacy
    assert column(spark, ["🙂🙂🙂🙂🙂 ok", "a" * 26, "plain words here", "", "ёжик" * 7], C.noise) == [True, True, False, True, True]
    assert column(spark, ["LOUD TEXT", "Quiet", "123"], C.mostly_uppercase) == [True, False, False]


def test_exact_duplicates_earliest_wins(spark):
    rows = [(3, "Same text that is long"), (1, "same TEXT, that is long!"), (2, "another text that is long"), (4, "short")]
    df = spark.createDataFrame([(*r, "comment") for r in rows], "i long, text string, kind string")
    assert {r["i"]: (r["reason"], r["duplicate_count"]) for r in C.cleaned(df, "text", "kind", "i").collect()} == {1: ("keep", 2), 3: ("exact_duplicate", 2), 2: ("keep", 1), 4: ("too_short", None)}


def test_quantiles_by_nearest_rank(spark):
    for values in ([1, 2, 3, 4, 100], [5], [1, 1, 2, 9], list(range(12))):
        df = spark.createDataFrame([(v,) for v in values], "v long")
        found = {r["fraction"]: r["value"] for r in P.ranked_values(df, "v", (0.25, 0.5, 0.95)).collect()}
        assert found == {f: sorted(values)[round((len(values) - 1) * f)] for f in (0.25, 0.5, 0.95)}


def test_near_duplicate_groups_are_transitive(spark):
    angles = [math.radians(a) for a in (0, 20, 40)]
    df = spark.createDataFrame([(i, [math.cos(a), math.sin(a)]) for i, a in enumerate(angles)], "i long, v array<double>")
    for pairs in (V.exact_pairs(df, "i", "v", 0.9), V.hashed_pairs(df, "i", "v", 0.9, bits=1)):
        assert {(r["left"], r["right"]) for r in pairs.collect()} == {(0, 1), (1, 2)}
    groups = V.grouped(df, "i", V.components(V.exact_pairs(df, "i", "v", 0.9)))
    assert {r["i"]: r["representative"] for r in groups.collect()} == {0: 0, 1: 0, 2: 0}
    assert tuple(V.invalid_groups(groups, df, "i").first()) == (0, 0, 0)
    kinds = spark.createDataFrame([(i, [1.0, 0.0], k) for i, k in enumerate("ccrc")], "i long, v array<double>, k string")
    assert {(r["left"], r["right"]) for r in V.exact_pairs(kinds, "i", "v", 0.95, "k").collect()} == {(0, 1), (0, 3), (1, 3)}
    with pytest.raises(ValueError):
        V.exact_pairs(df, "i", "v", 0.9, ceiling=2)


def test_pairs_in_blocks_are_exact(spark, monkeypatch):
    """The blocks find what one broadcast finds, with kinds too, and the queries take them beyond the bound."""
    rng = np.random.default_rng(7)
    df = spark.createDataFrame([(i, v.tolist(), "cr"[i % 2]) for i, v in enumerate(rng.normal(size=(150, 6)))], "i long, v array<double>, k string")
    for kind in (None, "k"):
        exact = sorted(V.exact_pairs(df, "i", "v", 0.5, kind).collect())
        assert exact and sorted(V.block_pairs(df, "i", "v", 0.5, kind, block=40).collect()) == exact
    assert V.block_pairs(df.limit(0), "i", "v", 0.5).count() == 0
    rows = topics.embeddings(spark, SF)
    exact = sorted(V.exact_pairs(rows, "vec_id", "embedding", topics.NEAR).collect())
    monkeypatch.setattr(V, "EXHAUSTIVE", 100)
    assert exact and sorted(topics._pairs(spark, SF).collect()) == exact


def test_candidates_reach_their_recall(spark):
    """Against all pairs, with the query's own parameters, and at a threshold where hashing is used."""
    pairs = lambda df: {(r["left"], r["right"]) for r in df.collect()}
    exact = pairs(V.exact_pairs(topics.embeddings(spark, SF), "vec_id", "embedding", topics.NEAR))
    found = pairs(models.j09_lsh_candidates(spark, SF))
    assert exact and found <= exact and len(found) >= 0.9 * len(exact)
    rng = np.random.default_rng(11)
    near = np.repeat(rng.normal(size=(100, 64)), 4, axis=0) + 0.45 * rng.normal(size=(400, 64))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(near)], "i long, v array<double>")
    assert V.tables_needed(0.8) <= V.MOST_TABLES
    exact, found = pairs(V.exact_pairs(df, "i", "v", 0.8)), pairs(V.candidate_pairs(df, "i", "v", 0.8))
    assert len(exact) > 300 and found <= exact and len(found) >= 0.9 * len(exact)


def test_label_order(spark):
    df = spark.createDataFrame(list(enumerate([9, 9, 3, -1, 3, 3, 7, 7])), "i long, label long")
    assert {r[0]: r[1] for r in O.label_order(df, "label", "i").collect()} == {3: 0, 9: 1, 7: 2, -1: -1}


@pytest.mark.parametrize("seed", range(6))
def test_limits_match_a_loop(spark, seed):
    rng = random.Random(seed)
    sizes = {t: rng.randrange(1, 8) for t in range(3)}
    rows = [(i, rng.randrange(3), rng.choice([0.9, 0.92, 0.95]), rng.choice([0.1, 0.2]), rng.choice(["reassigned", "reassigned", "below_similarity"])) for i in range(20)]
    rules = A.Rules(expansion=rng.choice([0.3, 0.6]), global_share=rng.choice([0.0, 0.1, 0.3, 1.0]))
    expected, used, total = {r[0]: r[4] for r in rows}, Counter(), 0
    cap = math.ceil(len(rows) * rules.global_share)
    for i, t, _, _, _ in sorted((r for r in rows if r[4] == "reassigned"), key=lambda r: (-r[2], -r[3], r[0])):
        if total >= cap:
            expected[i] = "global_limit"
        elif used[t] >= math.ceil(sizes[t] * rules.expansion):
            expected[i] = "topic_limit"
        else:
            used[t] += 1
            total += 1
    decisions = spark.createDataFrame(rows, "i long, best_topic long, similarity double, margin double, reason string")
    topics = spark.createDataFrame(list(sizes.items()), "label long, size long")
    assert {r["i"]: r["reason"] for r in A.limited(decisions, "i", topics, "label", len(rows), rules).collect()} == expected


def test_whole_groups(spark):
    df = spark.createDataFrame([(i, f"g{i % 7}") for i in range(50)], "i long, g string")
    found = W.whole_groups(df, F.col("g"), 42, 20).collect()
    counts = Counter(r["g"] for r in found)
    assert len(found) >= 20 and all(n == sum(i % 7 == int(g[1]) for i in range(50)) for g, n in counts.items())
    assert len(found) - min(counts.values()) < 20 or len(found) - max(counts.values()) < 20


def test_assignment_is_optimal():
    from itertools import permutations

    rng = np.random.default_rng(3)
    for n, m in ((3, 3), (2, 4), (5, 4)):
        cost = rng.integers(0, 9, (n, m)).astype(float)
        wide = cost if n <= m else cost.T
        best = min(sum(wide[i, p[i]] for i in range(len(wide))) for p in permutations(range(wide.shape[1]), len(wide)))
        found = E.assignment(cost)
        assert len(found) == min(n, m) and sum(cost[i, j] for i, j in found) == best


def prim(points, k):
    """Edges of the minimum spanning tree of mutual reachability, all distances compared."""
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    reach = np.maximum(np.maximum(d, np.sort(d, axis=1)[:, k][:, None]), np.sort(d, axis=1)[:, k][None])
    inside, edges = [0], []
    while len(inside) < len(points):
        outside = [i for i in range(len(points)) if i not in inside]
        part = reach[np.ix_(inside, outside)]
        a, b = np.unravel_index(part.argmin(), part.shape)
        edges.append((float(part[a, b]), inside[a], outside[b]))
        inside.append(outside[b])
    return sorted(edges)


@pytest.mark.parametrize(("n", "dims", "k"), [(2, 2, 1), (300, 2, 5), (700, 3, 1), (600, 5, 10)])
def test_spanning_tree_is_minimal(spark, n, dims, k, monkeypatch):
    """The distributed tree weighs what Prim's does, edge by edge, with leaves small enough to be passed over, and with repeated points."""
    monkeypatch.setattr(M._leaves, "__defaults__", (16,))
    rng = np.random.default_rng(n)
    points = np.concatenate([rng.normal(size=(n // 2, dims)) * 0.1, rng.normal(size=(n - n // 2, dims)) + 5])
    points[: n // 20] = points[0]
    edges = M.spanning_tree(spark.range(1), points, k)
    assert np.allclose([e[0] for e in edges], [e[0] for e in prim(points, k)])


def test_density_clusters_query(spark):
    """The query finds clusters, and the ceiling is one of bytes that says so."""
    found = models.m08_density_clusters(spark, SF).collect()
    assert len({r["label"] for r in found}) > 3 and all(0 <= r["probability"] <= 1 for r in found)
    assert models.m15_bootstrap(spark, SF).first()["ari"] > 0
    assert 0.5 < models.m07_reduction_quality(spark, SF).first()["trustworthiness"] <= 1
    with pytest.raises(ValueError):
        M.clustered(spark.createDataFrame([(1, [1.0, 2.0])], "i long, coords array<double>"), "i", 2, most_bytes=8)


def test_agreement_of_trivial_labellings(spark):
    value = lambda rows: tuple(E.agreement(spark.createDataFrame(rows, "a long, b long"), "a", "b").first())
    assert value([(1, 2)] * 5) == (1.0, 1.0) and value([(1, 2)]) == (1.0, 1.0)
    assert value([(1, i) for i in range(4)]) == (0.0, 0.0)
    assert value([]) == (None, None)


def test_density_clusters_of_blobs():
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.normal(c, 0.05, (40, 2)) for c in ((0, 0), (3, 3), (0, 3))] + [rng.uniform(-20, 20, (5, 2))])
    labels, probability = M.density_clusters(len(points), prim(points, 10), 10)
    assert len({*labels[:120]} - {-1}) == 3 and (labels[120:] == -1).sum() >= 4
    assert all(len({*labels[a : a + 40]} - {-1}) == 1 for a in (0, 40, 80)) and ((0 <= probability) & (probability <= 1)).all()
    assert (M.density_clusters(5, [], 10)[0] == -1).all()
    high = rng.normal(size=(30, 4))
    assert M.trustworthiness(high, high, 5) == 1.0


def test_safe_keywords_and_verdict(spark):
    words = [["crm", "a@b.org", "+7 912 345-67-89", "sales"]]
    assert column(spark, words, lambda k: E.safe_keywords(k, 2), "array<string>") == [["crm", "sales"]]
    assert E.verdict([], [], False) == "pass" and E.verdict([], ["w"], False) == "pass_with_warnings" and E.verdict(["f"], [], True) == "fail"
    assert column(spark, ["abcdefghijkl"], S.masked) == ["abcd" + "•" * 12 + "ijkl"]


def test_lines(spark, tmp_path):
    good = {"comment_text": "hello", "comment_replies": [{"text": "yes"}]}
    rows = ["﻿" + json.dumps(good), "", "{broken", "[1]", json.dumps({"comment_id": "x"}), json.dumps({"comment_text": " "}), json.dumps({"comment_text": "b", "comment_like_count": -1})]
    (tmp_path / "c.jsonl").write_text("\n".join(rows))
    lines = jsonl.lines(spark, str(tmp_path / "c.jsonl"))
    assert [r["class"] for r in jsonl.inspected(lines).orderBy("line").collect()] == ["valid", "blank", "invalid_json", "not_an_object", "invalid_record", "empty_text", "invalid_record"]
    assert [r["video_id"] for r in jsonl.comments(lines).collect()] == ["", ""]
    assert [r["line"] for r in jsonl.error_samples(lines).collect()] == [3, 4, 5, 7]
    with pytest.raises(Exception, match="line 3"):
        jsonl.comments(lines, strict=True).collect()


def test_formats():
    cases = {b"": "empty", b"PK\x03\x04x": "zip", b"\x1f\x8bx": "gzip", b"\xff\xfe\x00": "binary", b"<!DOCTYPE html>": "html", b"[1]": "json_array", b'{"a":1}\n{"b":2}': "jsonl", b"a,b\n1,2\n": "csv", b"a\tb\n1\t2\n": "tsv", b"just words": "text"}
    assert {k: jsonl.detect_format(k) for k in cases} == cases
    assert jsonl.detect_format(b'{"a":1}', "x.json") == "json_object"


def test_publication(tmp_path):
    a, b, current = tmp_path / "a", tmp_path / "b", tmp_path / "current"
    for folder in (a, b):
        sinks.publish(folder, {"t.json": folder.name.encode()}, {"run": folder.name})
    with pytest.raises(FileExistsError):
        sinks.publish(a, {}, {})
    assert sinks.switch(current, a) is None and sinks.switch(current, b) == a.resolve() and current.resolve() == b.resolve()
    (a / "t.json").write_bytes(b"changed")
    with pytest.raises(ValueError):
        sinks.switch(current, a)
    shot = Snapshot(b / "manifest.json", lambda f: sinks.validated(f)["run"])
    assert shot.get() == "b" and "<svg" in sinks.bar_chart([("x", 1.0)], "t") and "| a | 1 |" in sinks.markdown("t", [("a", 1)])


def test_runner(spark, tmp_path):
    source, ran = spark.range(20), []
    stages = [("even", lambda df: (ran.append("even"), df.filter("id % 2 = 0"))[1]), ("few", lambda df: (ran.append("few"), df.filter("id < 10"))[1])]
    runner = Runner(spark, tmp_path / "run", stages, {"a": 1})
    assert [s for _, s in runner.dry_run(source, 20).stages] == ["run", "run"]
    assert runner.run(source, stop_after="even")["status"] == "stopped"
    assert runner.run(source)["status"] == "done" and ran == ["even", "few"]
    assert runner.done(source) == 2 and runner.done(spark.range(21)) == 0 and runner.done(source, "few") == 1
    spark.range(3).write.mode("overwrite").parquet(runner._out("even"))
    assert runner.done(source) == 0
    gated = Runner(spark, tmp_path / "gated", stages, {}, {"even": lambda df: "pass_with_warnings"})
    assert gated.run(source)["status"] == "awaiting_review"


def test_ingestion(spark, tmp_path):
    def batch(rows):
        spark.createDataFrame(rows, "k long, n long, v string").write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("k long, n long, v string").parquet(str(tmp_path / "in"))
        ingest.run(stream, str(tmp_path / "out"), str(tmp_path / "check"), "k", "n", lambda df: df.filter("v <> 'noise'"))
        return sorted((r["k"], r["v"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert batch([(1, 1, "a"), (1, 2, "b"), (2, 3, "noise")]) == [(1, "b")]
    assert batch([(1, 9, "later"), (3, 9, "c")]) == [(1, "b"), (3, "c")]
    again = ingest.append_new(str(tmp_path / "out"), "k", "n")
    for _ in range(2):  # a batch that runs again replaces itself
        again(spark.createDataFrame([(7, 1, "x"), (1, 1, "y")], "k long, n long, v string"), 2)
        assert sorted((r["k"], r["v"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [(1, "b"), (3, "c"), (7, "x")]
    status = {}
    ingest.attempt(status, "s", lambda: 1 // 0)
    ingest.attempt(status, "t", lambda: 4)
    assert (status["s"]["status"], status["t"]["documents"]) == ("failed", 4) and ingest.retry_failed(status, lambda s: 2) == 1


def test_paged_service(spark):
    class Client:
        calls = 0

        def search(self, query, size, token, key):
            self.calls += 1
            if self.calls == 1:
                raise api.ApiError(503)
            if key == "one":
                raise api.ApiError(403, "quota")
            at = int(token or 0)
            return [{"id": str(i)} for i in range(at, at + size)], str(at + size)

        def details(self, ids, key):
            return [{"id": i, "n": int(i)} for i in ids]

        def threads(self, video, size, token, key):
            if token:
                raise api.ApiError(403, "disabled")
            return [{"id": "t"}], "more"

    waits = []
    caller = api.Caller(["one", "two"], sleep=waits.append)
    assert [x["n"] for x in api.search(Client(), caller, "q", 70)] == list(range(70)) and waits == [1.0] and caller.at == 1
    assert api.threads(Client(), caller, "v", 10) == [{"id": "t"}]
    row = api.source_rows(spark, [json.dumps({"id": "a", "title": "t", "statistics": {"viewCount": "7", "likeCount": "x"}})]).first()
    assert (row["views"], row["likes"]) == (7, None)


def test_checks_find_and_raise(spark, tmp_path):
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, [1.0]), (3, None), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0])], "i long, v array<double>")
    assert tuple(X.matrix_faults(rows, "v", 2).first()) == (2, 2, 1)
    with pytest.raises(ValueError, match="2 shape, 2 not_finite, 1 zero"):
        sinks.write_matrix(rows, str(tmp_path), "i", "v", 2)
    fine = rows.filter("i = 0")
    assert spark.read.parquet(sinks.write_matrix(fine, f"file://{tmp_path}", "i", "v", 2)).count() == 1
    assert tuple(X.keep_faults(spark.createDataFrame([(0, 2), (1, 1), (2, 1), (3, 9), (4, None)], "o long, i long"), "i", 5, "o").first()) == (2, 1, 1)
    assert tuple(X.id_faults(spark.createDataFrame([("a",), ("a",), (" ",), (None,)], "k string"), "k").first()) == (2, 1, 0)
    assert tuple(X.id_faults(spark.createDataFrame([], "k string"), "k").first()) == (0, 0, 1)
    one, two = spark.createDataFrame([(0, "a"), (1, "b")], "i long, x string"), spark.createDataFrame([(0, 5), (2, 6)], "i long, y int")
    with pytest.raises(ValueError, match="1 only left, 1 only right"):
        X.zipped(one, two, "i")
    assert X.zipped(one, two.replace(2, 1, "i"), "i").count() == 2
    with pytest.raises(Exception, match="a line is no group"):
        X.parsed_groups(spark.createDataFrame([("{\"representative\": 1}",)], "raw string")).collect()
    with pytest.raises(FileExistsError):
        for _ in range(2):
            sinks.report_bundle(tmp_path, "r", "t", [("a", 1)])
    assert {p.suffix for p in tmp_path.glob("r.*")} == {".json", ".md", ".csv", ".svg"}


def test_warnings(spark):
    row = spark.createDataFrame([(0.6, 0.9, 0.1, 3, 4)], "outlier_share double, dominant_share double, mean_probability double, n_micro int, n_clusters int")
    assert row.select(X.clustering_warnings()).first()[0] == ["many outliers", "one cluster dominates", "low mean probability", "many small clusters"]
    row = spark.createDataFrame([(0.1, None, 0.6, 0)], "reassigned_share double, mean_margin double, dominant_share double, excluded_topics int")
    assert row.select(X.reassignment_warnings()).first()[0] == ["one topic receives most"]


def test_languages(spark):
    texts = ["", "short", None, "это очень хороший текст и он не короткий", "this is the text that is not short at all", "zzzz qqqq wwww xxxx yyyy"]
    assert column(spark, texts, L.label) == ["unknown_short"] * 3 + ["russian", "english", "unknown"]
    assert column(spark, texts, lambda c: L.probably("russian", F.lit(None).cast("string"), c)) == [True, True, True, True, False, False]
    assert column(spark, texts[3:5], lambda c: L.label(c, detector=lambda t: F.lit("mine"))) == ["mine", "mine"]


def test_summaries_leave_the_heavy_column_unread(spark):
    plan = checks.p07_summaries(spark, SF)._jdf.queryExecution().toString()
    assert "html" not in plan.split("== Physical Plan ==")[1]


def test_shared_folder_is_shared(spark):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), spark.conf

    if not spark.conf.get("spark.checkpoint.dir", None):
        with pytest.raises(ValueError):
            shared.shared_dir(Session())


def test_settings_are_checked():
    for bad in ({"expansion": 1.5}, {"similarity": 2.0}, {"single_similarity": 0.1}, {"members": 0}):
        with pytest.raises(ValueError):
            A.Rules(**bad)
    for bad in ({"min_length": -1}, {"min_length": 9, "max_length": 8}, {"url_handling": "x"}):
        with pytest.raises(ValueError):
            C.Gates(**bad)


def test_smoke_runs_and_dry_runs(spark, tmp_path):
    """A smoke run takes whole groups, has a folder of its own and can't be published; a dry run names what is missing."""
    source = spark.range(400).selectExpr("id", "concat('g', id % 20) AS g")
    stages = [("twice", lambda df: df.withColumn("x", F.col("id") * 2))]
    state = runner.smoke(spark, tmp_path, stages, {}, source, F.col("g"), 50)
    assert state["status"] == "done" and state["rows"] == 60 and not runner.publishable(state)
    assert json.loads((tmp_path / "smoke/run.json").read_text())["smoke"]
    assert spark.read.parquet(str(tmp_path / "smoke/twice.parquet")).groupBy("g").count().filter("count <> 20").count() == 0
    whole = Runner(spark, tmp_path, stages, {})
    assert runner.publishable(whole.run(source))
    checks_of = lambda **k: {n: s for n, s, _ in whole.dry_run(source, **k).checks}
    assert not whole.dry_run(source, key="id", columns=("id",)).blocked
    found = checks_of(key="g", columns=("id", "lost"), resources={"model": str(tmp_path / "none")}, restart_from="nothing", vectors=10**15)
    assert {k for k, v in found.items() if v == "blocked"} == {"ids", "columns", "resource model", "stages", "disk"}


def test_entities_that_a_semicolon_closes(spark):
    rows = ["cut &amp", "a &amp; b", "&amp;lt; &copy y &copy; &#39; &#x41; &nope; &notit; &middot", None]
    df = spark.createDataFrame([(x,) for x in rows], "t string").select(T.unescaped_nfkc(F.col("t"), closed=True), T.unescaped_nfkc(F.col("t")))
    closed, open_ = zip(*df.collect())
    assert list(closed) == ["cut &amp", "a & b", "&lt; &copy y © ' A &nope; &notit; &middot", None]
    assert open_[0] == "cut &" and open_[2].startswith("&lt; © y")


def test_a_language_is_found_in_one_split(spark):
    plan = spark.range(1).select(L.by_markers(F.col("id").cast("string")).alias("l"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_blocks_hold_little_and_links_few(spark):
    rng = np.random.default_rng(8)
    rows = rng.normal(size=(300, 6)).astype(np.float32)
    rows[200:] = rows[:100] * 2
    df = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(rows)], "i long, v array<float>, k int").repartition(3)
    for kind in (None, "k"):
        pairs = V.block_pairs(df, "i", "v", 0.6, kind, block=70)
        links = V.block_links(df, "i", "v", 0.6, kind, block=70)
        one, two = df.select(F.col("i").alias("left"), F.col("v").alias("a"), F.col("k").alias("ka")), df.select(F.col("i").alias("right"), F.col("v").alias("b"), F.col("k").alias("kb"))
        alike = one.join(two, F.col("left") < F.col("right")).filter("true" if kind is None else "ka = kb").select("left", "right", S.cosine(F.col("a"), F.col("b")).alias("s")).filter("s >= 0.6")
        want = sorted(map(tuple, alike.collect()))
        assert sorted(map(tuple, pairs.collect())) == want
        found = {tuple(r) for r in links.collect()}
        assert len(found) < len(want) and found <= {r[:2] for r in want}
        assert sorted(V.components(links).collect()) == sorted(V.components(pairs).collect())


def test_matches_need_no_join(spark):
    assert "Join" not in topics._pairs(spark, SF)._jdf.queryExecution().executedPlan().toString()
