import hashlib
import random
import re
import struct
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.conftest import SF
from threadloom.llm import decontaminate, sharding, simhash, winnow

ODD = [(None, "one two three four five six seven eight"), (3, None), (4, ""), (5, " \n\t "), (6, "One TWO three É Four"), (6, "One TWO three É Four"), (7, "x " * 9000), (8, "東京 tower"), (9, "One TWO three é Four")]


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "a") for r in rows], "doc_id long, text string, n int, hash string").repartition(3)


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def leak_expected(docs, bench):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    items = [(str(i), words(t)) for i, t in bench]
    windows = [(i, {tuple(w[k : k + 8]) for k in range(max(1, len(w) - 7))}) for i, w in items if w]
    sizes = {len(x) for _, ws in windows for x in ws}
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        at = {}
        for n in sizes:
            for k in range(len(w) - n + 1):
                at.setdefault(tuple(w[k : k + n]), []).append(k)
        for item, ws in windows:
            for x in ws:
                for k in at.get(x, []):
                    hit.update(range(k, k + len(x)))
                    found.add(item)
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(found) >= 2))
    return sorted(out, key=str)


BENCH = [(1, "one two three four five six seven eight nine"), (2, "Three é, four"), (3, "x x x x x x x x"), (4, None), (5, "..."), (6, "tower"), (6, "tower"), (7, "x x x")]


@pytest.mark.parametrize("limit", [0, 400_000])
def test_decontamination_edges(spark, limit):
    bench = spark.createDataFrame([(*b, 7) for b in BENCH], "item_id long, text string, doc_id int")
    found = decontaminate.scan(docs_of(spark, ODD), bench, broadcast_windows=limit)
    got = rows_of(found.select("id", F.col("n_words").cast("long"), decontaminate.covered(F.col("spans")), F.size("items").cast("long"), F.sha2(F.array_join("items", ","), 256), F.size("items") >= 2))
    assert got == leak_expected(ODD, BENCH)
    none = rows_of(decontaminate.report(docs_of(spark, ODD), bench.limit(0)))
    assert none == leak_expected(ODD, [])
    assert decontaminate.report(docs_of(spark, ODD).limit(0), bench).count() == 0


def test_decontamination_of_documents(spark):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    expected = leak_expected([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in bench.collect()])
    assert rows_of(decontaminate.report(docs, bench)) == expected
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(x[0] for x in expected if not x[-1])


def test_spans_are_cut(spark):
    bench = spark.createDataFrame([(1, "b c d")], "item_id long, text string")
    docs = docs_of(spark, [(1, "- A b, c; d. e"), (2, "a b c"), (3, None), (None, "B C D")])
    kept = decontaminate.decontaminate(docs, bench, mode="spans", min_items=1)
    assert kept.columns == docs.columns
    assert rows_of(kept.select("doc_id", "text")) == sorted([(1, "- A e"), (2, "a b c"), (3, None), (None, "")], key=str)
    with pytest.raises(ValueError):
        decontaminate.decontaminate(docs, bench, mode="words")


def simhash_expected(docs):
    prints = []
    for _, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t or ""))
        h = [xxhash.xxh64_intdigest(" ".join(w[k : k + 3]).encode(), 42) for k in range(max(1, len(w) - 2))] if w else []
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    n = len(docs)
    links = [[j for j in range(n) if j != i and (prints[i] ^ prints[j]).bit_count() <= 3] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [docs[j][0] for j in seen if docs[j][0] is not None]
        out.append((docs[i][0], f"{prints[i]:016x}", len(links[i]), min(ids, default=None)))
    return sorted(out, key=str)


def near_copies(seed):
    rng = random.Random(seed)
    base = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(60)) for _ in range(5)]
    rows = []
    for i in range(60):
        w = rng.choice(base).split(" ")
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = "z"
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("rows", [ODD, near_copies(1), near_copies(2)], ids=["odd", "copies", "more"])
def test_simhash(spark, rows):
    expected = simhash_expected(rows)
    docs = docs_of(spark, rows)
    assert rows_of(simhash.report(docs)) == expected
    kept = simhash.deduplicate(docs)
    roots = {(fp, c) for _, fp, _, c in expected}
    assert kept.columns == docs.columns and kept.count() == len({c for _, c in roots})
    assert simhash.report(docs.limit(0)).count() == 0


@pytest.mark.parametrize("blocks", [4, 5, 7])
def test_any_number_of_blocks_finds_all_pairs(spark, blocks):
    rng = random.Random(blocks)
    base = [rng.getrandbits(64) for _ in range(6)]
    prints = sorted({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) & (2**64 - 1) for b in base for _ in range(12)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.close_pairs(spark.createDataFrame([(p,) for p in signed], "fp long"), simhash.Rule("shingles", blocks, blocks - 3, 3)).collect()
    expected = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    assert len(found) == len(expected) and {tuple(r) for r in found} == expected


def words_expected(rows, rule=simhash.WORDS):
    """The component of each document by ``rule``, all pairs compared: its smallest id."""
    prints = []
    for _, t in rows:
        t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        words = sorted(set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)))
        both = []
        for hashed in (lambda w: xxhash.xxh64_intdigest(w, seed=42), lambda w: xxhash.xxh64_intdigest(w, seed=xxhash.xxh64_intdigest(struct.pack("<i", 1), seed=42))):
            h = [hashed(w.encode()) for w in words]
            both.append(sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h)))
        prints.append(both)
    masks = [(1 << 64 * (i + 1) // rule.blocks) - (1 << 64 * i // rule.blocks) for i in range(rule.blocks)]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (a, b) in enumerate(prints):
        for j in range(i):
            x, y = prints[j][0] ^ a, prints[j][1] ^ b
            if x.bit_count() + y.bit_count() <= rule.distance and any(sum(not z & m for m in masks) >= rule.share for z in (x, y)):
                i_, j_ = top(i), top(j)
                root[max(i_, j_)] = min(i_, j_)
    return [top(i) for i in range(len(rows))]


def edited(seed):
    """Texts of 150 words from a large vocabulary, and copies with one word in twenty changed."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(rng.randrange(2, 9)))
    vocabulary = [word() for _ in range(3000)]
    base = [[rng.choice(vocabulary) for _ in range(150)] for _ in range(30)]
    return [(i, " ".join(rng.choice(vocabulary) if i >= 30 and rng.random() < 0.05 else w for w in base[i % 30])) for i in range(90)]


@pytest.mark.parametrize("rows", [[r for r in ODD if r[0] is not None], near_copies(1), edited(1)], ids=["odd", "copies", "edited"])
def test_simhash_of_words(spark, rows):
    """The rule for edited copies against all pairs; nine in ten copies with one word in twenty changed are found."""
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    expected = words_expected(rows)
    kept = simhash.deduplicate(docs_of(spark, rows), rule=simhash.WORDS)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(expected))
    if len(rows) == 90:
        assert len(set(expected)) >= 30 and 90 - len(set(expected)) >= 54


def test_simhash_ties_and_names(spark):
    rows = [(1, "a b c", "y", 1, 1), (1, "a b c", "x", 2, 1), (1, "a b c", "x", 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _rank string, _text_hash int, _ID_HASH int")
    kept = [simhash.deduplicate(d).collect() for d in (docs, docs.repartition(3), docs.orderBy(F.desc("_rank")))]
    assert kept[0] == kept[1] == kept[2] and len(kept[0]) == 1 and tuple(kept[0][0]) in rows


def test_components_of_a_chain(spark):
    n = 40
    edges = spark.createDataFrame([(i, i + 1) for i in range(n) if i != 20], "a long, b long")
    roots = {r["v"]: r["root"] for r in simhash.components(edges, "a", "b").collect()}
    assert all(roots[i] == (0 if i <= 20 else 21) for i in range(1, n + 1) if i != 21)


def test_sharding(spark):
    docs = docs_of(spark, ODD + [(100 + i, f"text {i}") for i in range(500)])
    found = sharding.report(docs).collect()
    assert len(found) == len(ODD) + 500
    for shard in range(40):
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in found)))
    assert all(r["grown_shard"] in (r["shard"], 40) and r["law"] == "key" for r in found) and any(r["grown_shard"] == 40 for r in found)
    shard = {}
    for r in found:
        assert shard.setdefault(r["doc_id"], r["shard"]) == r["shard"]
    alone = {r["doc_id"]: r["shard"] for r in sharding.report(docs.filter("doc_id > 300")).collect()}
    assert all(shard[k] == v for k, v in alone.items())
    expected = sorted((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in ODD if i is not None)
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in found if r["doc_id"] is not None and r["doc_id"] < 100) == expected
    assert sharding.report(docs.limit(0)).count() == 0


def test_sharding_goes_through_stored_maps(spark, monkeypatch):
    """The query's maps are those that were written, and the balanced one follows the measured bytes: a slot full of long texts is evened out."""
    rows = [(i, "x" * (20_000 if i % 97 == 0 else 50)) for i in range(2000)]
    docs = docs_of(spark, rows)
    first, grown, even = sharding.stored_maps(docs, 40)
    assert (first, grown) == (sharding.SlotMap.initial(40), sharding.SlotMap.initial(40).grow())
    sizes = {r["virtual_slot"]: r["bytes"] for r in sharding.slot_sizes(docs, "doc_id", "text").collect()}
    assert even == first.rebalance(sizes) and sum(sizes.values()) == sum(len(t) + 16 for _, t in rows)
    found = sharding.report(docs).collect()
    load = lambda c: [sum(r["size"] for r in found if r[c] == s) for s in range(40)]
    assert max(load("balanced_shard")) < max(load("shard"))
    assert all(r["shard"] == first.shards[r["virtual_slot"]] and r["grown_shard"] == grown.shards[r["virtual_slot"]] for r in found)


def test_slot_maps(spark, tmp_path):
    first = sharding.SlotMap.initial(40)
    grown = first.grow()
    assert grown.version == 2 and all(b in (a, 40) for a, b in zip(first.shards, grown.shards)) and grown.shards.count(40) == sharding.SLOTS // 41
    rng = random.Random(1)
    load = {s: rng.randrange(1, 1000) for s in range(sharding.SLOTS)}
    even = first.rebalance(load)
    sums = [sum(load[s] for s, x in enumerate(even.shards) if x == shard) for shard in range(40)]
    assert max(sums) <= 1.02 * sum(sums) / 40 and even.version == 2
    assert even.rebalance(load) is even
    even.save(spark, str(tmp_path))
    first.save(spark, str(tmp_path))
    assert sharding.SlotMap.load(spark, str(tmp_path), 2) == even and sharding.SlotMap.load(spark, str(tmp_path), 1) == first
    docs = docs_of(spark, ODD)
    assert sum(r["rows"] for r in sharding.slot_sizes(docs, "doc_id", "text").collect()) == len(ODD)
    with pytest.raises(ValueError):
        sharding.SlotMap.initial(0)


def tokens_of(text):
    """Runs of up to 16 characters whole; of longer runs, 8 characters from each place."""
    out = []
    for run in re.findall(r"[^ \t\n\x0b\f\r]+", text):
        out += [run] if len(run) <= 16 else [run[i : i + 8] for i in range(len(run))]
    return out


def grams_of(tokens):
    """The 64-bit hash of each three tokens, seeds chained, as signed numbers."""
    out = []
    for i in range(max(len(tokens) - winnow.K + 1, 1 if tokens else 0)):
        h = 42
        for x in tokens[i : i + winnow.K]:
            h = xxhash.xxh64_intdigest(x.encode(), seed=h)
        out.append(h - (1 << 64) if h >> 63 else h)
    return out


def chosen_of(text):
    grams, out = grams_of(tokens_of(text)), {}
    for s in range(max(1, len(grams) - winnow.W + 1) if grams else 0):
        window = [x >> winnow.POSITION_BITS for x in grams[s : s + winnow.W]]
        out[max(s + j for j, x in enumerate(window) if x == min(window))] = 0
    return [grams[p] for p in sorted(out)]


def alike(a, b):
    a, b = set(chosen_of(a)), set(chosen_of(b))
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("seed", [1, 2])
def test_winnowing_report(spark, seed):
    """All columns against brute force, over spaced and unspaced, empty, null and equal texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randrange(1, 24)))
    texts = [" ".join(word() for _ in range(rng.randrange(80))) for _ in range(20)] + ["".join(rng.choice("東京日本語文章") for _ in range(n)) for n in (5, 16, 17, 400)] + [None, "", " \n ", "a b c", "a b c"]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    found = {r["doc_id"]: r for r in winnow.report(docs_of(spark, rows)).collect()}
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        t, after, r = t or "", after or "", found[i]
        m = len(t) // 4
        edited = t[: len(t) - m] + after[:m]
        shown = lambda x: "".join(f"{h & (2**64 - 1):016x}" for h in chosen_of(x))
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest(), shown(t), shown(edited))
        assert r["near_edited"] == pytest.approx(alike(t, edited)) and r["near_next"] == pytest.approx(alike(t, after))


def test_unspaced_text_shares_hashes_wherever_it_stands(spark):
    """The guarantee without spaces: a shared passage of W + K + STEP - 2 characters gives a common hash, and one character put in front changes next to nothing."""
    rng = random.Random(3)
    han = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(n))
    rows = []
    for i in range(40):
        shared = han(winnow.W + winnow.K + winnow.STEP - 2)
        rows.append((i, han(20 + i) + shared + han(30), han(33 + 3 * i) + shared + han(25)))
    long = han(6000)
    rows.append((40, long, "x" + long))
    df = winnow.with_selected(winnow.with_selected(spark.createDataFrame(rows, "i long, a string, b string"), "a", "x"), "b", "y")
    x, y = winnow.hashes(F.col("x")), winnow.hashes(F.col("y"))
    found = {r["i"]: r for r in df.select("i", F.size(F.array_intersect(x, y)).alias("n"), winnow.likeness(x, y).alias("s")).collect()}
    assert all(r["n"] > 0 for r in found.values()) and found[40]["s"] > 0.99


def test_winnowing_choices(spark):
    rng = random.Random(4)
    texts = ["", "a", "a b", "a a a a a a a a a a a a a a a a", "x" * 200] + [" ".join(rng.choice(["aa", "b", "cc", "d"]) for _ in range(rng.randrange(60))) for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    both = winnow.with_selected(winnow.with_selected(df, "text", "all", w=1), "text", "chosen").collect()
    for r in both:
        grams = [x["hash"] for x in r["all"]]
        tokens = tokens_of(r["text"])
        assert [x["pos"] for x in r["all"]] == list(range(max(len(tokens) - winnow.K + 1, 1 if tokens else 0)))
        expected = {}
        for s in range(max(1, len(grams) - winnow.W + 1) if grams else 0):
            window = [x >> winnow.POSITION_BITS for x in grams[s : s + winnow.W]]
            pos = max(s + j for j, x in enumerate(window) if x == min(window))
            expected[pos] = grams[pos]
        assert grams == grams_of(tokens)
        assert [(x["pos"], x["hash"]) for x in r["chosen"]] == sorted(expected.items())


def test_shared_runs_share_a_hash(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    rows = []
    for i in range(20):
        run = " ".join(word() for _ in range(winnow.W + winnow.K - 1))
        rows.append((i, f"{word()} {word()} {run} {word()}", f"{word()} {run} {' '.join(word() for _ in range(30))}"))
    df = spark.createDataFrame(rows, "i long, a string, b string")
    found = winnow.with_selected(winnow.with_selected(df, "a", "x"), "b", "y").select(F.size(F.array_intersect(winnow.hashes(F.col("x")), winnow.hashes(F.col("y")))).alias("n"))
    assert all(r["n"] > 0 for r in found.collect())


@pytest.mark.parametrize("size", [2, 20_000])
def test_edited_texts_and_successors(spark, monkeypatch, size):
    monkeypatch.setattr(winnow.with_next, "__defaults__", (winnow.with_next.__defaults__[0], size))
    rng = random.Random(8)
    rows = [(i * 3, " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(4)) for _ in range(1 + i * 7))) for i in range(15)] + [(1, None), (2, ""), (50, "éß東 " * 40), (51, "short"), (52, "éß東 " * 40)]
    docs = docs_of(spark, rows)
    found = {r["doc_id"]: r for r in winnow.report(docs).collect()}
    assert len(found) == len(rows)
    ordered = sorted(rows)
    for (i, t), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        t, after, r = t or "", after or "", found[i]
        m = len(t) // 4
        edited = t[: len(t) - m] + after[:m]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert (r["fingerprint"] == r["edited_fingerprint"]) or edited != t
        if len(t) > 300:
            assert r["near_edited"] > 0.4 > r["near_next"] or after == t
    assert found[50]["fingerprint"] == found[52]["fingerprint"]
    assert winnow.report(docs.limit(0)).count() == 0
    assert winnow.report(docs_of(spark, [(None, "a b"), (None, "c d"), (1, "x"), (1, "x")])).count() == 4


def test_pairs_are_never_broadcast(spark, tmp_path):
    # the planner takes the rows behind an explode for as many as before it, so a small file was broadcast 112-fold
    spark.range(1000).select(F.array(F.xxhash64("id"), F.xxhash64(F.lit(1), "id")).alias("fp"), F.col("id").alias("doc")).write.parquet(str(tmp_path / "fps"))
    nodes = spark.read.parquet(str(tmp_path / "fps")).groupBy("fp").agg(F.count("*").alias("n"))
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") in ("10485760b", "10MB", "10485760")
    for rule, rows in ((simhash.WORDS, nodes), (simhash.SHINGLES, nodes.select(F.get("fp", F.lit(0)).alias("fp")))):
        pairs = simhash.close_pairs(rows, rule)
        pairs.collect()
        assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()
