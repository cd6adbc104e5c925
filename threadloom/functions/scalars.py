"""Other scalar functions: hashes, keys, labels, formats and vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEP = "\x1f"


def digest_head(text: Column) -> Column:
    """the first 8 bytes of SHA-256 as an unsigned number, decimal(20,0)."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 16), 16, 10).cast("decimal(20,0)")


def hash_fraction(seed: int, key: Column) -> Column:
    """a fixed fraction in [0, 1) of a seed and a key."""
    return digest_head(F.concat(F.lit(f"{seed}{SEP}"), key)).cast("double") / F.lit(2.0**64)


def split_of(seed: int, key: Column, development: float = 0.70, validation: float = 0.15) -> Column:
    """the split a group belongs to."""
    x = hash_fraction(seed, key)
    return F.when(x < development, "development").when(x < development + validation, "validation").otherwise("test")


def group_key(video_id: Column, video_url: Column, channel: Column, title: Column, record_id: Column, canonical: Column, last: str = "record_sha256:") -> Column:
    """the first provenance that isn't blank, with its kind in front."""
    t = lambda c: F.trim(F.coalesce(c, F.lit("")))
    both = F.concat(t(channel), F.lit(SEP), t(title))
    return (
        F.when(t(video_id) != "", F.concat(F.lit("video_id:"), t(video_id)))
        .when(t(video_url) != "", F.concat(F.lit("video_url:"), t(video_url)))
        .when(both != SEP, F.concat(F.lit("channel_title:"), both))
        .when(t(record_id) != "", F.concat(F.lit("comment_id:"), t(record_id)))
        .otherwise(F.concat(F.lit(last), F.sha2(canonical, 256)))
    )


def corpus_id(record_id: Column) -> Column:
    """F21."""
    return F.concat(F.lit("corpus:"), F.sha2(record_id, 256))


def url_parameter(url: Column, name: str) -> Column:
    """F16: the first value of a query parameter, or null."""
    return F.try_parse_url(url, F.lit("QUERY"), F.lit(name))


def month(ts: Column) -> Column:
    """F17."""
    return F.date_format(ts, "yyyy-MM")


def age_label(ts: Column, now: Column) -> Column:
    """how long ago, in the coarsest fitting unit; older than a week is the date."""
    s = F.unix_timestamp(now) - F.unix_timestamp(ts)
    unit = lambda n, name: F.concat(F.floor(s / n).cast("string"), F.lit(f" {name} ago"))
    return F.when(s < 60, "just now").when(s < 3600, unit(60, "min")).when(s < 86400, unit(3600, "h")).when(s < 7 * 86400, unit(86400, "d")).otherwise(F.date_format(ts, "dd.MM.yyyy"))


def thousands(n: Column) -> Column:
    """F19."""
    return F.format_number(n, 0)


def topic_name(terms: Column) -> Column:
    """F22."""
    return F.array_join(F.slice(terms, 1, 3), " / ")


def keyword_kind(term: Column) -> Column:
    """F23."""
    return F.when(F.instr(term, " ") > 0, "ngram").otherwise("unigram")


def jaccard(a: Column, b: Column) -> Column:
    """0 when both are empty."""
    either = F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def encoder_prefix(model: Column) -> Column:
    """the prompt that a model family expects before a text."""
    return F.when(F.lower(model).contains("e5"), "query: ").otherwise("")


def within(actual: Column, target: Column, tolerance: Column) -> Column:
    """F27."""
    return F.abs(actual - target) / target <= tolerance


def masked(secret: Column) -> Column:
    """P10: first and last four characters of a secret of more than eight."""
    return F.when(F.char_length(secret) > 8, F.concat(F.left(secret, F.lit(4)), F.repeat(F.lit("•"), F.lit(12)), F.right(secret, F.lit(4)))).otherwise(F.repeat(F.lit("•"), F.lit(12)))


def highlighted(text: Column, term: str) -> Column:
    """each occurrence of a plain term marked, the text escaped for HTML first."""
    safe = F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    quoted = "".join("\\" + c if not c.isalnum() else c for c in term)
    return F.regexp_replace(safe, f"(?i)({quoted})", "<mark>$1</mark>")


def valid_unit(kind: Column, parent: Column) -> Column:
    """a comment has no parent and a reply has one."""
    return F.when(kind == "comment", parent.isNull()).when(kind == "reply", parent.isNotNull()).otherwise(F.lit(False))


def dot(a: Column, b: Column) -> Column:
    """in double, in index order."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    """F24."""
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """null when a vector is zero."""
    n = norm(a) * norm(b)
    return F.when(n > 0, dot(a, b) / n)


def unit(a: Column) -> Column:
    """the vector at length one; null when it is zero or not finite."""
    n = norm(a)
    return F.when((n > 0) & ~F.isnan(n) & (n < float("inf")), F.transform(a, lambda x: x.cast("double") / n))


def nearest_rank(values: Column, fraction: float) -> Column:
    """Quantile by nearest rank with half-even rounding, of a sorted array."""
    return F.element_at(values, (F.rint((F.size(values) - 1) * F.lit(fraction)) + 1).cast("int"))
