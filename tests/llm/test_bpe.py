import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from threadloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_padding()
    t.no_truncation()
    return t


@pytest.fixture(scope="module")
def own():
    return bpe.Bpe(PATH)


def same(library, own, texts):
    for text, ids in zip(texts, own.encode_batch(texts)):
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == expected, repr(text[:80])
        assert own.decode(ids) == library.decode(expected, skip_special_tokens=False)


def test_cases(library, own):
    same(library, own, ["", " ", "  ", "a", " a", "a  b", "a \n b", "x\n\n  y\t \tz ", "aaaaaaaaaaaa", "it's we'll I'M", "<|endoftext|>", "a <|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext", "  <|endoftext|>  x", "naïve été 東京 🙂🙂 ‍", "a\x1cb\x1d \x1e c\x85d e 　f", "a" * 5000, "ab " * 3000, "!?" * 400, "́́ é"])


def test_random_texts(library, own):
    rng = random.Random(5)
    alphabet = list("aabcdeehinorst  \n\t.,'!0129ÄßéñçÉ") + ["the", " of", "  ", " ", "🙂", "'s", "\r\n", "日本", "\x1f", " "]
    same(library, own, ["".join(rng.choice(alphabet) for _ in range(rng.randrange(120))) for _ in range(1500)])


def test_every_class_of_code_points(library, own):
    rng = random.Random(6)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    same(library, own, ["a" + chr(c) + " " + chr(c) + "1 " + chr(c) for c in rng.sample(points, 3000)] + [f"a{chr(c)}{chr(c)} b" for c in range(0x3100) if not 0xD800 <= c < 0xE000])


def test_long_words(library, own):
    """Words of more bytes than go through the rounds: equal to the library, a megabyte of letters within seconds."""
    rng = random.Random(7)
    letters = lambda n, alphabet="etaoinshrdlu": "".join(rng.choice(alphabet) for _ in range(n))
    same(library, own, [letters(n) for n in (511, 512, 513, 600, 5000)] + ["a" * 4001, "ab" * 900, letters(700, "ab"), letters(3000, "日本東京語"), "short " + letters(2000) + " and " + letters(900) + " end"])
    began = time.time()
    same(library, own, [letters(1_000_000)])
    assert time.time() - began < 60


def test_table_starts_anew(library):
    same(library, small := bpe.Bpe(PATH, table=3), ["one two three four"])
    same(library, small, ["five six one two", "seven"])


def test_invalid_bytes(library, own):
    ids = np.array([int(own.byte_id[0xE2]), int(own.byte_id[0x41]), int(own.byte_id[0xFF])])
    assert own.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_report(spark, library):
    rows = [(1, "Hello  world", 1), (2, None, 2), (3, "", 3), (3, "", 3), (None, "x " * 30_000, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    found = sorted(map(tuple, bpe.report(df, PATH).collect()), key=str)
    expected = []
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert found == sorted(expected, key=str)
    assert bpe.report(df.limit(0), PATH).count() == 0


def test_encode_keeps_columns(spark, own):
    df = spark.createDataFrame([(1, "a b", "x"), (2, None, "y")], "ids long, text string, names string")
    coded = bpe.encode(df.withColumnRenamed("ids", "k"), PATH)
    assert {r["k"]: list(r["ids"]) for r in coded.collect()} == {1: own.encode_batch(["a b"])[0].tolist(), 2: []}
    assert {(r["k"], r["back"]) for r in bpe.decode(coded, PATH, out_col="back").collect()} == {(1, "a b"), (2, "")}
