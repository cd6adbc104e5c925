"""The pipeline's stages, each against a brute-force version of its own input."""

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import SF
from tests.llm.test_native import leak_expected, words_expected
from tests.llm.test_substrings import cut, left, places
from threadloom.llm import langid, substrings


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "repeated_substrings", "decontamination", "encoding"]
    kept = [docs.orderBy("doc_id").collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, spark.createDataFrame(kept[-1], docs.schema), SF)
        if name != "encoding":
            assert out.columns == docs.columns and out.schema == docs.schema
        kept.append(out.orderBy("doc_id").collect())
    start, spoken, distinct, thinned, clean, coded = kept

    model = langid.train(docs, public_tokenizers.path("piece_bpe_32k.model"))
    verdicts = langid.Scorer(model).score([r["text"] for r in start])
    assert [r["doc_id"] for r in spoken] == [r["doc_id"] for r, (lang, score) in zip(start, verdicts) if lang != "und" and score >= 0.5]

    roots = words_expected([(r["doc_id"], r["text"]) for r in spoken])
    assert [r["doc_id"] for r in distinct] == [spoken[i]["doc_id"] for i in sorted(set(roots))]

    texts = [r["text"] for r in distinct]
    assert [r["text"] for r in thinned] == [left(*x).decode("utf-8", "ignore") for x in cut(texts, substrings.WORDS_50, places(spark, texts))]
    assert all(r["n_chars"] == len(r["text"]) for r in thinned)

    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean_ids = sorted(x[0] for x in leak_expected([(r["doc_id"], r["text"]) for r in thinned], bench) if not x[-1])
    assert [r["doc_id"] for r in clean] == clean_ids
    assert not any(x[2] for x in leak_expected([(r["doc_id"], r["text"]) for r in clean], bench))

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert [list(r["ids"]) for r in coded] == [library.encode(r["text"], add_special_tokens=False).ids for r in clean]


def test_passages_of_more_than_50_words_stand_once(spark):
    """A passage of 52 words that four documents share is left in one; a shared one of 40 words, and all else, stays."""
    word = lambda i: f"w{i * 7919 % 99991}"
    long, short = " ".join(map(word, range(52))), " ".join(map(word, range(100, 140)))
    own = lambda k: " ".join(word(1000 * k + i) for i in range(60))
    texts = [f"{own(k)} {p} {own(k + 10)}" for k, p in enumerate([long] * 4 + [short] * 3 + [""], 1)]
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    made = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], schema)
    found = {r["doc_id"]: r["text"] for r in corpus_pipeline.substring_stage(spark, made, SF).collect()}
    assert sum(long in found[i] for i in range(4)) == 1
    assert all(own(i + 1) in found[i] and own(i + 11) in found[i] for i in range(4))
    assert all(found[i] == texts[i] for i in range(4, 8))


def test_run(spark):
    found = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "text", "ids", "n_tokens"} <= set(found.columns) and found.count() > 0


def test_empty_and_null_rows(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    odd = [(None, None, None, None, None), (1, None, "en", "s", 0), (2, "", None, None, None), (3, "The cat and the dog.", "en", "s", 20), (3, "The cat and the dog.", "en", "s", 20), (None, "The end of the story", "en", None, None)]
    for rows in (odd, []):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, spark.createDataFrame(rows, schema), SF).collect()
            assert len(out) <= len(rows) and (name not in ("repeated_substrings", "encoding") or len(out) == len(rows))


def test_decontamination_cuts_one_item(spark):
    """A document with one whole item loses the item's words; with two it goes; without, it stays as it is."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if len(r["text"].split()) >= 8][:2]
    texts = [f"Before this. {items[0]} After that.", f"{items[0]} {items[1]}", "Before this. After that."]
    made = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], docs.schema)
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert [x[3] for x in leak_expected([(i, t) for i, t in enumerate(texts)], bench)] == [1, 2, 0]
    found = {r["doc_id"]: r for r in corpus_pipeline.decontamination_stage(spark, made, SF).collect()}
    assert sorted(found) == [0, 2]
    assert found[0]["text"] == "Before this. After that." == found[2]["text"]
    assert all(r["n_chars"] == len(r["text"]) for r in found.values())
