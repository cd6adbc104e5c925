"""Document fingerprints by winnowing.

Native: DataFrame functions only. A text becomes tokens: a run of up to ``TOKEN``
characters without white space is one, and in a longer run, such as text that is
written without spaces, each character starts one, of ``STEP`` characters or what is left of the run. No token depends on where
a run began, so what is put in front shifts the tokens and changes none. A k-gram is ``K`` tokens in a
row and its hash 64 bits. Of each window of ``W`` consecutive k-grams the
smallest hash is chosen, the rightmost of equal ones, and kept with its
position. So any run of ``W + K - 1`` tokens that two texts share gives both at
least one common fingerprint hash, and shared runs under ``K`` tokens give none; in a run without spaces, a shared
passage of ``W + K + STEP - 2`` characters holds so many tokens.

The smallest hash is found by the upper ``64 - POSITION_BITS`` bits with the
position below them in one long, which makes the choice of the rightmost an
integer minimum; the chosen hash itself is kept whole. Texts may have up to 2^26 tokens.

Defined results: a null text is empty; a text without tokens has no
fingerprint hashes, and two such texts are alike (1.0); fewer tokens than ``K``
are one gram, fewer grams than ``W`` one window; repeated rows give one row
each; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.common import unused

K, W, TOKEN, STEP = 3, 8, 16, 8
POSITION_BITS = 26
#: Rows per range of ids, which one task sorts to find each row's successor; ranges grow once there would be more than MOST_RANGES.
RANGE_ROWS, MOST_RANGES = 500, 50_000
_SHORT = rf"(?<!\S)\S{{1,{TOKEN}}}+(?!\S)"
#: Looks at a token and takes it whole if it is a run, else its first character.
_PIECE = rf"(?=({_SHORT}|\S{{1,{STEP}}}))(?:{_SHORT}|\S)"


def with_selected(df: DataFrame, text_col: str, name: str, k: int = K, w: int = W) -> DataFrame:
    """``df`` with the text's fingerprint: array of (pos, hash), each chosen k-gram once, by position (counted in tokens).

    Each step is a column of its own, evaluated once a row. A step combines an
    array with itself moved by some places; window minima double their width a step.
    """
    low = (1 << POSITION_BITS) - 1
    none = F.array().cast("array<bigint>")

    def moved(name: str, by: int) -> Column:
        return F.slice(name, by + 1, F.greatest(F.size(name), F.lit(1)))

    t, h, g, m, n = (unused([*df.columns, name], c) for c in "thgmn")
    out = df.withColumn(t, F.regexp_extract_all(F.coalesce(text_col, F.lit("")), F.lit(_PIECE), F.lit(1)))
    gram = lambda x, i: F.xxhash64(x, *[F.get(t, i + j) for j in range(1, k)])  # noqa: E731  past the end are nulls, which it skips
    out = out.withColumn(h, F.transform(t, gram))
    out = out.withColumn(g, F.transform(h, lambda x, i: x.bitwiseAND(F.lit(~low)).bitwiseOR(F.lit(low) - i)))
    out = out.withColumn(m, F.slice(g, 1, F.greatest(F.size(g) - (k - 1), F.lit(1))))
    out, width = out.withColumn(n, F.size(m)), 1
    while width < w:
        step = min(width, w - width)
        out = out.withColumn(m, F.zip_with(m, moved(m, step), lambda a, b: F.least(a, b)))
        width += step
    chosen = F.when(F.col(n) > 0, F.array_distinct(F.slice(m, 1, F.greatest(F.col(n) - (w - 1), F.lit(1))))).otherwise(none)
    at = lambda x: (F.lit(low) - x.bitwiseAND(F.lit(low))).cast("int")
    unpacked = F.transform(chosen, lambda x: F.struct(at(x).alias("pos"), F.get(h, at(x)).alias("hash")))
    return out.withColumn(name, unpacked).drop(t, h, g, m, n)


def hashes(chosen: Column) -> Column:
    """The hashes of a fingerprint, by position."""
    return F.transform(chosen, lambda x: x["hash"])


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of the sets of two arrays of hashes; 1.0 if both are empty."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def with_next(rows: DataFrame, id_col: str, hash_col: str, carry: list[str], prepare=lambda df: df, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``rows`` with ``next``: the columns ``carry`` of the row after in ascending id; after the last comes the first.

    Ids are cut into ranges at approximate quantiles and the rows move once, to
    the task that sorts their range. Each range also gets a copy of the first
    row of the range that follows it, so its own last row finds a successor
    there. Null ids come first, spread over ranges by text hash; equal ids are
    ordered by text hash. ``prepare`` adds columns to rows once they are chosen,
    before they move. Runs one action over the ids.
    """
    n = rows.select(id_col).count()
    parts = max(1, min(MOST_RANGES, -(-n // range_rows)))
    few = max(1, round(parts**0.5))
    cuts: list[int] = []
    if parts > 1:
        cuts = sorted(set(rows.agg(F.percentile_approx(id_col, [i / parts for i in range(1, parts)], 10 * parts)).first()[0] or []))
    # two levels of cuts, so that a row is compared with few of them
    nested = F.from_json(F.lit(json.dumps([cuts[i : i + few] for i in range(0, len(cuts), few)])), "array<array<bigint>>")
    firsts = F.from_json(F.lit(json.dumps(cuts[::few])), "array<bigint>")
    group = F.size(F.filter(firsts, lambda c: c <= F.col(id_col)))
    range_of = F.when(group == 0, 0).otherwise((group - 1) * few + F.size(F.filter(F.get(nested, group - 1), lambda c: c <= F.col(id_col))))
    spread = F.shiftrightunsigned(F.col(hash_col).bitwiseXOR(F.lit(-(1 << 63))), 32) * parts
    null_range = F.shiftright(spread, 32) - parts
    ranged = rows.withColumn("_range", F.when(F.col(id_col).isNull(), null_range).otherwise(range_of))

    least = ranged.groupBy("_range").agg(F.min(id_col).alias("_least"))
    heads = ranged.join(F.broadcast(least.withColumnRenamed("_range", "_r")), (F.col("_range") == F.col("_r")) & F.col(id_col).eqNullSafe(F.col("_least")))
    lowest = heads.groupBy("_range").agg(F.min(hash_col).alias("_lowest")).withColumnRenamed("_range", "_q")
    heads = heads.join(F.broadcast(lowest), (F.col("_range") == F.col("_q")) & (F.col(hash_col) == F.col("_lowest"))).dropDuplicates(["_range"])
    # a row per range: this window is as small as the list of ranges
    order = least.select("_range", F.lag("_range").over(Window.orderBy("_range")).alias("_before"), F.max("_range").over(Window.partitionBy()).alias("_last"))
    order = order.select("_range", F.coalesce("_before", "_last").alias("_to"))
    copies = heads.select(*rows.columns, "_range").join(F.broadcast(order), "_range").select(*rows.columns, F.col("_to").alias("_range"), F.lit(True).alias("_copy"))
    by = Window.partitionBy("_range").orderBy("_copy", F.col(id_col).asc_nulls_first(), hash_col)
    both = prepare(ranged.withColumn("_copy", F.lit(False))).unionByName(prepare(copies))
    return both.withColumn("next", F.lead(F.struct(*carry)).over(by)).filter(~F.col("_copy")).drop("_copy", "_range")


def fingerprint_text(found: Column) -> Column:
    """A fingerprint as text: its hashes by position, sixteen hexadecimal digits each."""
    return F.lower(F.array_join(F.transform(found, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def report(documents: DataFrame) -> DataFrame:
    """The columns that query op10 returns: each document against its edited text and against the next document."""
    text = F.coalesce("text", F.lit(""))
    rows = documents.select("doc_id", text.alias("text"), F.xxhash64(text).alias("text_hash"))

    def fingerprinted(df: DataFrame) -> DataFrame:
        return with_selected(df, "text", "chosen").withColumn("own", hashes(F.col("chosen"))).drop("chosen")

    paired = with_next(rows, "doc_id", "text_hash", ["text", "own"], fingerprinted)
    n = F.char_length("text")
    m = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - m), F.substring("next.text", F.lit(1), m))
    changed = with_selected(paired.withColumn("edited", edited), "edited", "chosen").withColumn("other", hashes(F.col("chosen")))
    return changed.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint_text(F.col("own")).alias("fingerprint"),
        fingerprint_text(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("next.own")).alias("near_next"),
    )
