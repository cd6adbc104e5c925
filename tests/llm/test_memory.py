"""What bounds the memory of the driver and of the Python workers over many stages."""

import gc
import random
import tracemalloc

import public_tokenizers

from threadloom.llm import bpe, langid, simhash


def test_rounds_of_components_are_small(spark):
    """Components of a graph with repeated, turned and looped edges, in few stages for the driver to hold."""
    rng, n = random.Random(5), 300
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(220)]
    edges += edges[:20] + [(b, a) for a, b in edges[20:40]] + [(i, i) for i in range(5)]
    root = list(range(n))
    for _ in range(n):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    context = spark.sparkContext
    context.setJobGroup("components", "")
    out = simhash.components(spark.createDataFrame([([a, 0], [b, 0]) for a, b in edges], "a array<long>, b array<long>"), "a", "b")
    found = {r["v"][0]: r["root"][0] for r in out.collect()}
    context.setLocalProperty("spark.jobGroup.id", None)
    assert found == {x: root[x] for a, b in edges if a != b for x in (a, b)}
    jobs = [context.statusTracker().getJobInfo(j) for j in context.statusTracker().getJobIdsForGroup("components")]
    assert sum(len(j.stageIds) for j in jobs) < 60


def test_a_worker_keeps_one_operators_tables():
    langid._pieces(public_tokenizers.path("piece_bpe_32k.model"))
    bpe._bpe(public_tokenizers.path("byte_bpe_50k.json"))
    langid._pieces(public_tokenizers.path("piece_bpe_32k.model"))
    gc.collect()
    assert not any(isinstance(x, bpe.Bpe) for x in gc.get_objects())


def test_new_words_are_merged_in_parts():
    coder = bpe.Bpe(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(6)
    text = " ".join("".join(rng.choices("abcdefghij", k=9)) for _ in range(100_000))
    whole = coder.words([text])[0]
    tracemalloc.start()
    ids = coder.encode_batch([text])[0]
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert (ids == whole).all() and peak < 70
