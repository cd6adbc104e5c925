"""SimHash near-duplicates by pigeonhole blocks.

Native: DataFrame functions only. Each document's feature hashes are added up
bit by bit in one code-generated aggregation (two 32-bit lanes in each sum).
Equal fingerprints are folded together first, so thousands of copies are one
row. Each 64 bits of a fingerprint are cut into blocks; two fingerprints meet under each choice of
``share`` blocks of the same 64 bits in which they agree, are taken only under the first such choice, and link if they
differ in at most ``distance`` of all bits. Components come from alternating star contractions,
written to the shared folder each round.

Two rules are at hand. ``SHINGLES`` is that of query op8: 64 bits of 3-word shingles, 3 bits apart, 3 of 6 blocks
shared, which every such pair does. A text of which one word in twenty was changed lies about ten bits apart there. ``WORDS``
is made for such copies: 128 bits of the distinct words without punctuation, 26 bits apart at most, and 3 of the 8 blocks of
either half shared, as part of the rule. Unrelated texts lie 60 bits apart, with a deviation of 6 to 7. Three blocks are 24
bits, so buckets hold many fingerprints beyond some 10^8 different ones; ``share`` 4 is for those, and finds fewer.

Defined results: null, empty and blank texts have no words and the fingerprint
zero, which links like any other; repeated rows each count as a document;
``component_id`` ignores null ids unless all of a component are null; extra
columns are ignored, and kept by ``deduplicate`` whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from threadloom.llm import decontaminate
from threadloom.llm.common import lower_ascii, materialise, unused
from threadloom.operators.vectors import components

SHINGLE = 3


@dataclass(frozen=True)
class Rule:
    """Which fingerprints link: of ``features`` (shingles or words), with at least ``share`` of the ``blocks`` blocks of the same 64 bits equal, and at most ``distance`` of all bits different."""

    features: str
    blocks: int
    share: int
    distance: int


SHINGLES = Rule("shingles", 6, 3, 3)
WORDS = Rule("words", 8, 3, 26)


def words_of(text: Column) -> Column:
    """Runs of anything but space and U+0009 to U+000D, A-Z lower-cased; null has none."""
    return F.coalesce(F.array_remove(F.split(lower_ascii(text), r"[\x20\x09-\x0D]+"), ""), F.array().cast("array<string>"))


def _fingerprint(grouped, hashes: list[Column], marks: Column) -> DataFrame:
    """The majority of each bit of each hash over a group's rows as ``fp``, a long or an array of longs; a row for each mark. Equal documents fall into one group: all sums and the count grow alike, so the majority stays."""
    lanes = F.lit(0x0000000100000001)
    sums = [F.sum(F.shiftrightunsigned(h, i).bitwiseAND(lanes)).alias(f"s{k}_{i}") for k, h in enumerate(hashes) for i in range(32)]
    found = grouped.agg(F.count(hashes[0]).alias("n"), F.count_if(marks).cast("int").alias("copies"), *sums)

    def bit(k: int, i: int) -> Column:
        total = F.col(f"s{k}_{i % 32}")
        lane = total.bitwiseAND(F.lit(0xFFFFFFFF)) if i < 32 else F.shiftrightunsigned(total, 32)
        return F.when(lane * 2 > F.col("n"), F.lit((1 << i) - (1 << 64 if i == 63 else 0))).otherwise(F.lit(0))

    def whole(k: int) -> Column:
        fp = bit(k, 0)
        for i in range(1, 64):
            fp = fp.bitwiseOR(bit(k, i))
        return fp

    prints = [whole(k) for k in range(len(hashes))]
    out = found.select("id", "text_hash", (prints[0] if len(prints) == 1 else F.array(*prints)).alias("fp"), "copies")
    return out.select("id", "text_hash", "fp", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("_")).drop("_")


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", features: str = SHINGLES.features) -> DataFrame:
    """A row (id, text_hash, fp) per document row; ``fp`` is a long for shingles, an array of two for words."""
    docs = documents.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    if features == "words":
        each = docs.select("id", "text_hash", F.posexplode_outer(F.array_distinct(decontaminate.words_of(F.col("text")))).alias("at", "word"))
        hashes = [F.when(F.col("word").isNotNull(), F.xxhash64("word")), F.when(F.col("word").isNotNull(), F.xxhash64(F.lit(1), "word"))]
        hashed = each.select("id", "text_hash", "at", *[h.alias(f"h{k}") for k, h in enumerate(hashes)])
        return _fingerprint(hashed.groupBy("id", "text_hash"), [F.col("h0"), F.col("h1")], F.coalesce("at", F.lit(0)) == 0)
    docs = docs.select("id", "text_hash", words_of(F.col("text")).alias("w"))
    last = F.greatest(F.size("w") - SHINGLE, F.least(F.size("w") - 1, F.lit(0)))  # -1 without words
    at = docs.select("id", "text_hash", "w", F.explode(F.sequence(F.lit(-1), last)).alias("at"))
    shingle = F.concat_ws(" ", *[F.get("w", F.col("at") + i) for i in range(SHINGLE)])  # concat_ws skips what is past the end
    hashed = at.select("id", "text_hash", "at", F.when(F.col("at") >= 0, F.xxhash64(shingle)).alias("h"))
    return _fingerprint(hashed.groupBy("id", "text_hash"), [F.col("h")], F.col("at") < 0)


def _masks(blocks: int) -> list[int]:
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def close_pairs(distinct: DataFrame, rule: Rule = SHINGLES) -> DataFrame:
    """All pairs (a, b), a < b, of distinct fingerprints (column ``fp``) that link."""
    masks = [_signed(sum(x)) for x in combinations(_masks(rule.blocks), rule.share)]
    if rule.features == "words":
        halves = [lambda name: F.get(name, F.lit(0)), lambda name: F.get(name, F.lit(1))]
    else:
        halves = [F.col]
    choices = [(half, F.lit(m)) for half in halves for m in masks]
    keys = [half("fp").bitwiseAND(m) for half, m in choices]
    keyed = distinct.select("fp", F.posexplode(F.array(*keys)).alias("choice", "key"))
    a, b = keyed.select(F.col("fp").alias("a"), "choice", "key"), keyed.select(F.col("fp").alias("b"), "choice", "key")
    differ = [half("a").bitwiseXOR(half("b")) for half in halves]
    apart = sum([F.bit_count(x) for x in differ], F.lit(0))
    equal = [(x, m) for x in differ for m in masks]
    first = F.coalesce(*[F.when(x.bitwiseAND(F.lit(m)) == 0, F.lit(i)) for i, (x, m) in enumerate(equal)])
    # never broadcast: the planner takes the rows for as many as before the explode, so a table of 10 MB would send some GB through the driver
    met = a.join(b.hint("merge"), ["choice", "key"]).filter((F.col("a") < F.col("b")) & (apart <= rule.distance))
    return met.filter(F.col("choice") == first).select("a", "b")


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = SHINGLES) -> DataFrame:
    """A row (id, text_hash, fp, n_near, root, component_id) per document row; materialises the fingerprints and the linked pairs."""
    docs, _ = materialise(fingerprints(documents, id_col, text_col, rule.features), "fingerprints")
    nodes = docs.groupBy("fp").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))
    pairs, _ = materialise(close_pairs(nodes, rule), "pairs")
    ends = pairs.select(F.col("a").alias("fp"), F.col("b").alias("other")).union(pairs.select(F.col("b").alias("fp"), F.col("a").alias("other")))
    links = ends.join(nodes.select(F.col("fp").alias("other"), "n"), "other").groupBy("fp").agg(F.sum("n").alias("linked"))
    roots = components(pairs, "a", "b")
    rooted = nodes.join(links, "fp", "left").join(roots.select(F.col("v").alias("fp"), "root"), "fp", "left")
    rooted = rooted.select("fp", "first_id", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_near"), F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = rooted.join(least, "root").select("fp", "n_near", "root", "component_id")
    return docs.join(known, "fp").select("id", "text_hash", "fp", "n_near", "root", "component_id")


def deduplicate(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = SHINGLES) -> DataFrame:
    """``documents`` with one row of each component: that of the smallest id, nulls last; then of the smallest fingerprint, text hash and hash of all columns but maps."""
    found = near_duplicates(documents, id_col, text_col, rule)
    best = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "fp", "text_hash")).alias("k")
    a, b, c, r = (unused(documents.columns, n) for n in ("id_hash", "text_hash", "rank", "row"))
    keep = found.groupBy("root").agg(best).select(F.xxhash64("k.id").alias(a), F.col("k.text_hash").alias(b))
    plain = [F.col(f"`{f.name}`") for f in documents.schema if not isinstance(f.dataType, MapType)]
    hashed = documents.withColumns({a: F.xxhash64(id_col), b: F.xxhash64(text_col), c: F.xxhash64(*plain)})
    kept = hashed.join(keep, [a, b], "left_semi")
    return kept.groupBy(a, b).agg(F.min_by(F.struct(*documents.columns), c).alias(r)).select(f"{r}.*")


def report(documents: DataFrame) -> DataFrame:
    """The columns that query op8 returns."""
    return near_duplicates(documents).select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("n_near").cast("long").alias("n_near"),
        "component_id",
    )
