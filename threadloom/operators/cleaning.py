"""Text gates and exact deduplication."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions import text as T
from threadloom.sources.shared import materialise
from threadloom.sources.tables import spread

THANKS = ["спс", "спасибо", "благодарю", "класс", "супер", "круто", "лайк", "огонь", "топ", "красота", "молодец", "молодцы", "здорово", "отлично", "браво"]
#: Characters beside letters and digits that aren't symbols.
PUNCTUATION = ".,!?;:—–-«»\"“”'’‘`()[]{}…%№/\\+*=&@#_|^~<>$ \t\n\r"
REPEATED = r"(?s)(.)\1{5,}"


@dataclass(frozen=True)
class Gates:
    """Settings of the ordered gates; the defaults are those of the reference configuration. With ``closed_entities``, an entity without its semicolon is text."""

    min_length: int = 20
    max_length: int | None = None
    url_handling: str = "token"
    strip_html: bool = True
    acknowledgement: bool = True
    repeated: bool = True
    uppercase: bool = False
    spam: bool = False
    languages: tuple[str, ...] = ()
    closed_entities: bool = False

    def __post_init__(self) -> None:
        """V21."""
        if self.min_length < 0 or (self.max_length is not None and self.max_length < self.min_length) or self.url_handling not in ("token", "remove", "keep"):
            raise ValueError("lengths don't fall, and URLs become a token, go or stay")


def prepare(df: DataFrame, text_col: str, gates: Gates = Gates()) -> DataFrame:
    """``df`` with clean_text, text_key and url_only."""
    base = T.unescaped_nfkc(F.col(text_col), gates.closed_entities)
    out = df.withColumn("_base", T.strip_tags(base) if gates.strip_html else base)
    bare = F.regexp_replace("_base", T.URL, " ")
    out = out.withColumn("url_only", F.col("_base").rlike(T.URL) & ~bare.rlike(r"[\p{L}\p{N}]"))
    out = out.withColumn("clean_text", T.collapse(T.strip_controls(T.urls(F.col("_base"), gates.url_handling)))).drop("_base")
    return out.withColumn("text_key", T.alnum_key(T.casefold(F.col("clean_text"))))


def acknowledgement(text: Column) -> Column:
    """One to three words, all of them thanks. One anchored expression, which most texts leave at their first word."""
    letter = "а-яёa-z"
    return F.lower(text).rlike(rf"\A[^{letter}]*+(?:(?:{'|'.join(THANKS)})(?![{letter}])[^{letter}]*+){{1,3}}\z")


def share(text: Column, of: str, among: str) -> Column:
    """Characters of class ``of`` per character of class ``among``; null if there is none."""
    count = lambda c: F.char_length(text) - F.char_length(F.regexp_replace(text, c, ""))
    return F.when(count(among) > 0, count(of) / count(among))


def mostly_uppercase(text: Column) -> Column:
    """G07."""
    return F.coalesce(share(text, r"\p{Lu}", r"\p{L}") > 0.8, F.lit(False))


def symbol_share(text: Column) -> Column:
    """Symbols per character of the stripped text."""
    kept = "".join("\\" + c if c in "\\[]^-&" else c for c in PUNCTUATION)
    return F.char_length(F.regexp_replace(text, rf"[\p{{L}}\p{{N}}{kept}]", "")) / F.char_length(text)


def noise(text: Column) -> Column:
    """Emoji walls and glued gibberish."""
    stripped = T.strip(text)
    lengths = F.transform(T.words(stripped), lambda w: F.char_length(w))
    total = F.aggregate(lengths, F.lit(0), lambda a, x: a + x)
    long = (F.size(lengths) > 0) & ((total / F.size(lengths) > 14) | (F.array_max(lengths) > 25))
    return (stripped == "") | F.coalesce(symbol_share(stripped) > 0.20, F.lit(False)) | F.coalesce(long, F.lit(False))


def classified(df: DataFrame, source_col: str, gates: Gates = Gates(), language_col: str | None = None) -> DataFrame:
    """Prepared rows with ``reason``, the first gate that they fail, or keep."""
    clean = F.col("clean_text")
    chain = F.when(clean == "", "empty").when(F.col("url_only"), "url_only").when(F.char_length(clean) < gates.min_length, "too_short")
    if gates.max_length is not None:
        chain = chain.when(F.char_length(clean) > gates.max_length, "too_long")
    chain = chain.when(~clean.rlike(r"[\p{L}\p{N}]"), "no_alphanumeric")
    if gates.acknowledgement:
        chain = chain.when(acknowledgement(clean), "acknowledgement")
    if gates.repeated:
        chain = chain.when(F.col(source_col).rlike(REPEATED), "repeated_characters")
    if gates.uppercase:
        chain = chain.when(mostly_uppercase(clean), "mostly_uppercase")
    if gates.spam:
        chain = chain.when(noise(clean), "pipeline_noise")
    if gates.languages:
        chain = chain.when(~F.col(language_col).isin(*gates.languages), "disallowed_language")
    return df.withColumn("reason", chain.otherwise("keep"))


def legacy_reason(text: Column, min_length: int) -> Column:
    """G02."""
    stripped = T.strip(text)
    count = lambda c: F.char_length(stripped) - F.char_length(F.regexp_replace(stripped, c, ""))
    cyrillic, latin = count("(?iu)[а-яё]"), count("(?i)[a-z]")
    return (
        F.when(stripped == "", "empty")
        .when(F.char_length(stripped) < min_length, "too_short")
        .when(F.size(T.words(stripped)) == 0, "too_short")
        .when(acknowledgement(stripped), "acknowledgement")
        .when((cyrillic + latin > 0) & (cyrillic < 0.5 * (cyrillic + latin)), "foreign_language")
        .otherwise("keep")
    )


def exact_duplicates(df: DataFrame, keys: list[str], order: str, kept: Column) -> DataFrame:
    """Among rows that are kept, ``representative`` (the earliest of equal keys) and ``duplicate_count``; null elsewhere.

    One aggregate per key and a join, so a key that very many rows share is folded before it moves. ``df`` is read
    twice: pass a table that was written, with hashes for keys, rather than a plan over texts.
    """
    first = df.filter(kept).groupBy(*keys).agg(F.min(order).alias("representative"), F.count("*").alias("duplicate_count"))
    same = None
    for k in keys:
        one = df[k].eqNullSafe(first[k])
        same = one if same is None else same & one
    return df.join(first, same & kept, "left").select(df["*"], first["representative"], first["duplicate_count"])


def _marked(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Narrow classified rows with equal keys marked ``exact_duplicate`` but for the earliest. Writes them once, so that texts are prepared once and none is shuffled."""
    narrow, _ = materialise(rows, "classified")
    out = exact_duplicates(narrow, keys, order, F.col("reason") == "keep")
    return out.withColumn("reason", F.when((F.col("reason") == "keep") & (F.col(order) != F.col("representative")), "exact_duplicate").otherwise(F.col("reason")))


def cleaned(df: DataFrame, text_col: str, kind_col: str, order: str, gates: Gates = Gates(), keep: tuple[str, ...] = ()) -> DataFrame:
    """The cleaning stage: prepared, classified, and equal texts of a kind marked ``exact_duplicate`` but for the earliest.

    (order, kind, ``keep`` columns, key_sha256, reason, representative, duplicate_count); the texts themselves stay where they are.
    """
    names = list(dict.fromkeys([order, kind_col, *keep]))
    rows = classified(prepare(spread(df.select(*dict.fromkeys([*names, text_col]))), text_col, gates), text_col, gates)
    return _marked(rows.select(*names, F.sha2("text_key", 256).alias("key_sha256"), "reason"), [kind_col, "key_sha256"], order)


def legacy_clean(df: DataFrame, text_col: str, order: str, min_length: int, spam: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Legacy gate, optional noise, then the earliest of equal normalised texts; (order, ``keep`` columns, key_sha256, reason, representative, duplicate_count)."""
    reason = legacy_reason(F.col(text_col), min_length)
    if spam:
        reason = F.when((reason == "keep") & noise(F.col(text_col)), "pipeline_noise").otherwise(reason)
    key = F.sha2(T.collapse(T.casefold(F.col(text_col))), 256).alias("key_sha256")
    return _marked(spread(df).select(*dict.fromkeys([order, *keep]), key, reason.alias("reason")), ["key_sha256"], order)


def informative(text_key: Column, min_chars: int = 20, min_tokens: int = 4) -> Column:
    """G11, of a leakage key."""
    token, other = r"[\p{L}\p{N}]++", r"[^\p{L}\p{N}]*+"
    thanks = text_key.rlike(rf"\A{other}(?:(?:{'|'.join(THANKS)})(?![\p{{L}}\p{{N}}]){other}){{0,3}}\z")
    return (F.char_length(text_key) >= min_chars) & text_key.rlike(rf"\A(?:{other}{token}){{{min_tokens}}}") & ~thanks


def earliest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key, the first in ``order``."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")
