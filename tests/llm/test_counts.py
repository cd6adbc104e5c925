import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from tests.conftest import SF
from threadloom.llm import counts

PATH = public_tokenizers.path("piece_bpe_32k.model")


def library(pieces, byte_fallback=True):
    t = Tokenizer(models.Unigram(pieces, 0, byte_fallback))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return t


@pytest.mark.parametrize("seed", range(6))
def test_small_vocabularies_with_ties(seed):
    rng = random.Random(seed)
    pieces = [("<unk>", 0.0)] + [(w, float(rng.choice([-1, -2, -3, -0.5]))) for w in ["a", "b", "ab", "ba", "aa", "aba", "▁", "▁a", "▁ab", "bab", "é"]]
    own, t = counts.Counter(pieces, byte_fallback=False), library(pieces, False)
    for _ in range(400):
        text = "".join(rng.choice("aabb  éxyz▁") for _ in range(rng.randrange(25)))
        assert own.count(text) == len(t.encode(text, add_special_tokens=False).ids), repr(text)


def test_public_vocabulary():
    pieces = counts.vocabulary(PATH)
    own, t = counts.Counter(pieces), library(pieces)
    rng = random.Random(1)
    texts = ["", " ", "a", "Hello  world", "naïve 東京🙂🙂 x\n\ty", "x" * 3000, "<unk> <0x41> </s>"]
    texts += ["".join(rng.choice(["the", " ", "in", "g", "\n", "É", "🙂", "ß", "9", "ключ", "  "]) for _ in range(60)) for _ in range(300)]
    for text in texts:
        assert own.count(text) == len(t.encode(text, add_special_tokens=False).ids), repr(text)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    t = library(counts.vocabulary(PATH))
    expected = {r["doc_id"]: len(t.encode(r["text"], add_special_tokens=False).ids) for r in docs.collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in counts.report(docs, PATH).collect()} == expected


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 5), (1, "a b", 6), (1, "a b", 6), (None, "", 7)], "doc_id long, text string, n_tokens long")
    found = sorted(((r["doc_id"], r["n_tokens"]) for r in counts.report(docs, PATH).collect()), key=str)
    assert found == sorted([(1, 0), (1, 2), (1, 2), (None, 0)], key=str)
    assert counts.report(docs.limit(0), PATH).count() == 0


def test_both_passes_agree():
    """The pass for words without unknown characters gives what the general one gives."""
    counter = counts._counter(PATH)
    rng = random.Random(4)
    words = [counts.MARK + "".join(rng.choice("etaoinshrdluETAé0.,") for _ in range(rng.randrange(40))) for _ in range(3000)]
    assert all(counter.single.issuperset(w) for w in words)
    assert [counter._known(w) for w in words] == [counter._word(w) for w in words]
