import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from tests.conftest import SF
from threadloom.llm import langid

PATH = public_tokenizers.path("piece_bpe_32k.model")


def brute(word, vocabulary, p):
    """Sum over all segmentations; a character outside the vocabulary is a piece of its own."""
    if not word:
        return np.ones(p.shape[1])
    total = np.zeros(p.shape[1])
    for j in range(1, len(word) + 1):
        n = vocabulary.get(word[:j])
        if n is not None:
            total += p[n] * brute(word[j:], vocabulary, p)
        elif j == 1:
            total += langid.UNKNOWN * brute(word[j:], vocabulary, p)
    return total


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(1)
    vocabulary = {w: i for i, w in enumerate(["a", "b", "ab", "ba", "aba", "bab", "abab"])}
    p = rng.random((7, 3)) / 7
    words = ["a", "b", "abab", "abaxba", "bbbb", "x", "ababababab", "ab" * 17]
    together = langid.forward_all(words, vocabulary, 4, langid.automaton_of(vocabulary), p)
    for word, found in zip(words, together):
        assert np.allclose(found, langid.forward(word, vocabulary, 4, p))
        if len(word) < 20:
            assert np.allclose(np.exp(found), brute(word, vocabulary, p))
    long = langid.forward("ab" * 20_000, vocabulary, 4, p)
    assert np.isfinite(long).all() and (long < -1000).all()


def test_long_words_in_batches_equal_the_plain_forward_pass(monkeypatch):
    """Words of 33 to 3,000 characters, unspaced and with unknown characters: nothing underflows and all languages agree with one place at a time."""
    monkeypatch.setattr(langid, "TOGETHER", 5_000)
    vocabulary, longest, automaton = langid._pieces(PATH)
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdeéß東京の\x01") for _ in range(n)) for n in (33, 40, 47, 48, 49, 64, 500, 3000)] + ["a" * 700, "short"]
    p = np.random.default_rng(2).dirichlet(np.ones(len(vocabulary)), 3).T
    found = langid.forward_all(words, vocabulary, longest, automaton, p)
    assert np.isfinite(found).all()
    assert np.allclose(found, [langid.forward(w, vocabulary, longest, p) for w in words])


def test_expected_uses_match_brute_force():
    rng = np.random.default_rng(2)
    vocabulary = {w: i for i, w in enumerate(["a", "b", "ab", "ba"])}
    p = rng.random((4, 2)) / 4
    weights = np.array([[3.0, 1.0], [0.0, 0.0]])
    found = langid.expected(["abba", "bxb"], weights, vocabulary, langid.automaton_of(vocabulary), p)

    def cuts(word):
        if not word:
            yield []
        for j in range(1, len(word) + 1):
            if word[:j] in vocabulary:
                for rest in cuts(word[j:]):
                    yield [vocabulary[word[:j]], *rest]

    each = [(c, np.prod(p[c], axis=0)) for c in cuts("abba")]
    whole = sum(x for _, x in each)
    expected = np.zeros((4, 2))
    for c, x in each:
        for n in c:
            expected[n] += x / whole * weights[0]
    assert np.allclose(found, expected)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = langid.report(docs, PATH).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == docs.count()
    held = [r for r in found if r["held_out"] and r["lang_pred"] != "und"]
    assert len(held) > 40 and np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in found)


def test_learns_only_from_its_share(spark):
    rows = [(i, "the and of" if i % 2 else "der und die", ("en" if i % 2 else "de") if zlib.crc32(str(i).encode()) % 3 != 1 else "xx") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert langid.train(docs, PATH).languages == ("de", "en")
    assert {r["lang_pred"] for r in langid.report(docs, PATH).collect()} == {"de", "en"}


def test_edges(spark):
    rows = [(1, None, "en", 9), (2, "", None, 9), (3, "12 + 4 !", "en", 9), (None, "the", "en", 9), (5, "the " * 50_000, "en", 9), (5, "le la", "fr", 9), (5, "le la", "fr", 9), (6, "東京", None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    found = langid.report(docs, PATH).collect()
    assert len(found) == 8
    by = {(r["doc_id"], r["lang_pred"]) for r in found}
    assert {(1, "und"), (2, "und"), (3, "und")} <= by
    assert all(r["lang_pred"] == "und" and r["score"] == 0.0 for r in langid.report(docs.withColumn("lang", docs["lang"].substr(9, 0)).filter("false"), PATH).collect())
    assert langid.report(docs.limit(0), PATH).count() == 0
    kept = langid.keep_known(docs, PATH)
    assert kept.columns == docs.columns and kept.filter("doc_id in (1, 2, 3)").count() == 0


def test_languages_without_spaces(spark):
    """Sentences of more than 32 characters without a space are learned from, not dropped."""
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice("日本語文章東京" if i % 2 else "العربيةكتاب") for _ in range(120)), "ja" if i % 2 else "ar") for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = langid.report(docs, PATH).filter("held_out").collect()
    assert found and all(r["lang_pred"] == rows[r["doc_id"]][2] for r in found)


def test_dirty_labels_are_refused(spark):
    docs = spark.range(5000).selectExpr("id AS doc_id", "'a text' AS text", "concat('l', id) AS lang")
    with pytest.raises(ValueError):
        langid.train(docs, PATH)


def test_a_score_of_the_users_own_stays(spark):
    docs = spark.createDataFrame([(i, "the cat and the dog", "en", 7, "z") for i in range(9)], "doc_id long, text string, lang string, _score int, _lang_pred string")
    kept = langid.keep_known(docs, PATH)
    assert kept.columns == docs.columns and all(r["_score"] == 7 and r["_lang_pred"] == "z" for r in kept.collect())


def test_pieces_are_followed_from_all_places_at_once():
    rng = random.Random(3)
    for trial in range(30):
        letters = "ab" if trial % 2 else "abcé\U0001F600"
        vocabulary = {w: i for i, w in enumerate(sorted({"".join(rng.choices(letters, k=rng.randint(1, 5))) for _ in range(rng.randint(0, 12))}))}
        text = "".join(rng.choices(letters + "x\n", k=rng.randint(0, 40)))
        want = sorted((j, i, vocabulary[text[i:j]], j - i) for i in range(len(text)) for j in range(i + 1, len(text) + 1) if text[i:j] in vocabulary)
        stop, piece, size = (x.tolist() for x in langid.Trie(vocabulary).find(text))
        assert list(zip(stop, piece, size)) == [(j, n, k) for j, _, n, k in want]
