"""Removal of bytes that lie in repeated strings of a fixed length.

Which strings of ``length`` bytes repeat is decided by a column-wise suffix
construction over many documents at once, run only where a repeat is possible:

1. Every string of ``length`` bytes has an anchor: of its ``gram``-byte grams the
   one of the smallest hash, the rightmost of equal ones. Neighbouring starts
   share their anchor, so a text falls into *runs* of starts; the bytes that a run's
   strings cover are its *context*. Equal strings have equal anchors at equal
   distances, so only contexts of one anchor hash need comparing.
2. Runs go to their anchor hash, once. Contexts that are equal as a whole, which
   is told by 64 bits of hash of the context beside the 64 of the anchor, are
   repeats and travel on as intervals. A context that shares its anchor with other
   contexts is fetched, together with one example of each of those.
3. Contexts are laid out with their anchors in one column and read from right
   to left. Each round takes one symbol of every context, moves the suffix order
   one column on by a stable counting sort (a positional Burrows-Wheeler
   transform), and brings the lengths of common prefixes of neighbours up to
   date. A start repeats exactly when a neighbour's common prefix reaches
   ``length``: here bytes are compared, not hashes.
4. Intervals of repeated starts meet their documents, and covered bytes go.

Contexts are a few hundred bytes, so there are at most ``2 * length`` rounds
however long a text is; the files read in sequence are Spark's sorted shuffle
files. Equal contexts within a slice of input are folded before they move, and an anchor
that more than ``HOT`` different contexts share is split by 128 bits of hash of each of
its strings (``_hot_windows``), which has no group to collect: equal results, unless two
different strings have one hash, of which the odds are under one in 10^20 for 10^9 strings.

``keep="none"`` removes every copy. ``keep="first"`` leaves one of each string: that in
the text of the smallest hash, the leftmost there.

Defined results: a null text is empty; a text under ``length`` bytes loses
nothing. With ``keep="none"``, repeated rows are repeats of each other; with
``keep="first"``, rows of equal text count as one text, so they all keep what it
keeps. Ids play no part and may be null or repeated; extra columns are ignored by
``report`` and kept by ``deduplicate``, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import materialise, unused, worker_cache


@dataclass(frozen=True)
class Shape:
    """Strings of ``length`` bytes, anchored at grams of ``gram`` bytes. With ``words``, runs of removed bytes shrink to whole words, with the white space behind each, and those of fewer words stay."""

    length: int = 400
    gram: int = 100
    words: int = 0

    def __post_init__(self) -> None:
        if not 0 < self.gram <= self.length or self.reach >= 1 << 12:
            raise ValueError(f"a gram has 1 to length bytes and a string at most {(1 << 12) - 1} more than it: {self}")

    @property
    def reach(self) -> int:
        """An anchor lies 0 to this many bytes after the start of its string."""
        return self.length - self.gram


#: The strings of query op6.
BYTES_400 = Shape()
#: Passages of more than 50 words: strings of 200 bytes, so 50 words of three letters, in runs of at least 51 words.
WORDS_50 = Shape(200, 50, 51)
HOT = 20_000
#: Contexts that one construction takes at least, if there are so many.
BATCH = 8_000
#: Contexts of crowded anchors whose strings go out together.
TOGETHER = 500
#: Bytes of text that are looked at together when equal contexts are folded.
SLICE = 8_000_000
_LOW = np.uint64((1 << 31) - 1)
_BASE = 0x9E3779B97F4A7C15 | 1
_NO = 256  # stands for a byte outside a context; equals nothing

_RUN = "part long, s int, h long, ctx long, n int, k1 long, k2 long, run long"
_SPAN = "s int, k1 long, k2 long, lo int, hi int"


def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Table of byte values, powers of the base and of its inverse modulo 2^64, for texts of up to n bytes."""
    cache = worker_cache("substrings")
    if "powers" not in cache or len(cache["powers"][1]) < n:
        size = max(1 << 17, 1 << (n - 1).bit_length())
        of_byte = np.random.default_rng(20).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        up, down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)]), dtype=np.uint64) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
        cache["powers"] = of_byte, up, down
    return cache["powers"]


def gram_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A mixed 64-bit hash of each string of ``length`` bytes."""
    of_byte, up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(of_byte[data] * up[: len(data)], out=total[1:])
    g = (total[length:] - total[:-length]) * down[: len(data) - length + 1]
    g ^= g >> np.uint64(32)
    g *= np.uint64(0xD6E8FEB86659FD93)
    g ^= g >> np.uint64(32)
    g *= np.uint64(0xD6E8FEB86659FD93)
    g ^= g >> np.uint64(32)
    return g


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    n = len(x) - width + 1
    padded = np.concatenate([x, np.full(-len(x) % width, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def find_runs(data: bytes, shape: Shape = BYTES_400) -> tuple[np.ndarray, ...]:
    """Runs of starts that share an anchor: (first start, last start, anchor position, anchor hash)."""
    a = np.frombuffer(data, np.uint8)
    g = gram_hashes(a, shape.gram)
    packed = (g & ~_LOW) | (_LOW - np.arange(len(g), dtype=np.uint64))
    anchor = (_LOW - (sliding_min(packed, shape.reach + 1) & _LOW)).astype(np.int64)
    new = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    last = np.append(new[1:], len(anchor)) - 1
    return new, last, anchor[new], g[anchor[new]].view(np.int64)


def _pack(lo: np.ndarray, hi: np.ndarray, q: np.ndarray) -> np.ndarray:
    return lo << 24 | (hi - lo) << 12 | (q - lo)


def _unpack(run: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lo = run >> 24
    return lo, lo + (run >> 12 & 4095), lo + (run & 4095)


def _slices(batches: Iterator[pa.RecordBatch], most: int, text: str = "text") -> Iterator[pa.RecordBatch]:
    for b in batches:
        step = max(1, int(b.num_rows * most / max(b.column(text).nbytes, 1)))
        for i in range(0, b.num_rows, step):
            yield b.slice(i, step)


def _emit_runs(batches: Iterator[pa.RecordBatch], shapes: list[Shape], first_stays: bool) -> Iterator[pa.RecordBatch]:
    """Runs of the texts. Of those whose context stands in the slice again, the first goes out with n = 2 for all, and the others, which are known repeats, with n = -1."""
    digest = xxhash.xxh3_64_intdigest
    for b in _slices(batches, SLICE):
        keys = list(zip(b.column("text"), b.column("k1").to_numpy(), b.column("k2").to_numpy()))
        for s, shape in enumerate(shapes):
            parts = []
            for t, k1, k2 in keys:
                data = (t.as_py() or "").encode()
                if len(data) < shape.length:
                    continue
                lo, hi, q, h = find_runs(data, shape)
                ctx = np.fromiter((digest(data[i : j + shape.length]) for i, j in zip(lo.tolist(), hi.tolist())), np.uint64, len(lo)).view(np.int64)
                parts.append((h ^ s, ctx ^ (q - lo), np.full(len(lo), k1), np.full(len(lo), k2), _pack(lo, hi, q)))
            if not parts:
                continue
            cols = [np.concatenate(x) for x in zip(*parts)]
            cols = [x[np.lexsort(cols[::-1])] for x in cols]
            if first_stays:  # rows of equal text count once
                new = np.append(True, np.any([x[1:] != x[:-1] for x in cols], axis=0))
                cols = [x[new] for x in cols]
            h, ctx, k1, k2, run = cols
            same = (h[1:] == h[:-1]) & (ctx[1:] == ctx[:-1])
            first, more = np.append(True, ~same), np.append(same, False)
            for keep, n, part in ((first, np.where(more, 2, 1), h), (~first, np.full(len(h), -1), k1)):
                m = int(keep.sum())
                yield pa.RecordBatch.from_arrays([pa.array(part[keep]), pa.array(np.full(m, s, np.int32)), pa.array(h[keep]), pa.array(ctx[keep]), pa.array(n[keep].astype(np.int32)), *[pa.array(x[keep]) for x in (k1, k2, run)]], names=["part", "s", "h", "ctx", "n", "k1", "k2", "run"])


_KIND = "kind int, s int, h long, k1 long, k2 long, run long"


def _classify(batches: Iterator[pa.RecordBatch], first_stays: bool) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (n > 0, h, ctx, k1, k2, run) become kind 0 (repeats as a whole), 1 (to be compared) or 2 (the first of equal contexts, with which others are compared).

    Streams: besides a batch, only the row before it and the first row of its open group of equal contexts are held.
    """
    names = ["s", "h", "ctx", "n", "k1", "k2", "run"]
    held = [np.zeros(0, np.int32 if c in ("s", "n") else np.int64) for c in names]
    before = opened = None  # the row before those held, and the first of its group

    def out(kind: int, rows: list[np.ndarray], keep: np.ndarray) -> Iterator[pa.RecordBatch]:
        s, h, _, _, k1, k2, run = rows
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(int(keep.sum()), kind, np.int32)), *[pa.array(x[keep]) for x in (s, h, k1, k2, run)]], names=["kind", "s", "h", "k1", "k2", "run"])

    def classified(rows: list[np.ndarray], after: list | None) -> Iterator[pa.RecordBatch]:
        nonlocal before, opened
        edge = lambda row, i: np.array([row[i]] if row else [], rows[i].dtype)
        pad = [np.concatenate([edge(before, i), x, edge(after, i)]) for i, x in enumerate(rows)]
        step_h = pad[1][1:] == pad[1][:-1]
        step_c = step_h & (pad[2][1:] == pad[2][:-1])
        if not before:
            step_h, step_c = np.append(False, step_h), np.append(False, step_c)
        if not after:
            step_h, step_c = np.append(step_h, False), np.append(step_c, False)
        up_h, up_c, down_h, down_c = step_h[:-1], step_c[:-1], step_h[1:], step_c[1:]
        several = (rows[3] > 1) | up_c | down_c
        yield from out(0, rows, up_c if first_stays else several)
        yield from out(1, rows, ~several & (up_h | down_h))
        # a group's first row stands for it, at its first or its last row, whichever meets another context
        at = np.maximum.accumulate(np.where(up_c, -1, np.arange(len(up_c))))
        head = [np.where(at < 0, opened[i] if opened else 0, x[at]).astype(x.dtype) for i, x in enumerate(rows)]
        yield from out(2, head, several & ((up_h & ~up_c) | (down_h & ~down_c)))
        before, opened = [x[-1] for x in rows], [x[-1] for x in head]

    for b in batches:
        if not b.num_rows:
            continue
        rows = [np.concatenate([x, b.column(c).to_numpy()]) for x, c in zip(held, names)]
        n_known = int(np.searchsorted(rows[3] > 0, True))  # known repeats come first and have no neighbours that count
        if n_known:
            yield from out(0, [x[:n_known] for x in rows], np.ones(n_known, bool))
            rows = [x[n_known:] for x in rows]
        if len(rows[0]):  # rows of equal texts are one row here, and a repeat unless the first stays
            again = np.append(False, np.all([x[1:] == x[:-1] for i, x in enumerate(rows) if i != 3], axis=0))
            if again.any():
                group = np.cumsum(~again) - 1
                n = np.maximum.reduceat(rows[3], np.flatnonzero(~again))
                if not first_stays:
                    n[np.unique(group[again])] = 2
                rows = [x[~again] for x in rows]
                rows[3] = n
        if len(rows[0]) > 1:
            yield from classified([x[:-1] for x in rows], [x[-1] for x in rows])
        held = [x[-1:] for x in rows]
    if len(held[0]):
        yield from classified(held, None)


def repeated_starts(texts: list[bytes], at: np.ndarray, shape: Shape = BYTES_400, first_stays: bool = False) -> np.ndarray:
    """For each context, with its anchor ``at`` bytes in: which strings that begin 0 to ``reach`` bytes before the anchor stand in another context too, or with ``first_stays`` in one before it.

    The column-wise construction; row x of the result is for strings that begin x bytes before the anchor.
    """
    reach = shape.reach
    m, width = len(texts), reach + shape.length
    symbols = np.full((m, width), _NO, np.uint16)
    for i, (t, q) in enumerate(zip(texts, at)):
        symbols[i, reach - q : reach - q + len(t)] = np.frombuffer(t, np.uint8)
    columns = np.ascontiguousarray(symbols.T)
    del symbols
    found = np.zeros((reach + 1, m), bool)
    order, common = np.arange(m), np.zeros(m, np.int16)
    for c in range(width - 1, -1, -1):
        sym = columns[c][order]
        moved = np.argsort(sym, kind="stable")
        sym = sym[moved]
        left, right = moved[:-1], moved[1:]  # old ranks of new neighbours
        same = np.flatnonzero((sym[1:] == sym[:-1]) & (sym[1:] != _NO))
        new = np.zeros(m, np.int16)
        if len(same):
            a, b = left[same] + 1, right[same]  # minimum of common[a..b]
            level = (np.frexp((b - a + 1).astype(float))[1] - 1).astype(np.int64)
            table, out = common, np.empty(len(same), np.int16)
            for k in range(int(level.max()) + 1):
                here = np.flatnonzero(level == k)
                if len(here):
                    out[here] = np.minimum(table[a[here]], table[b[here] - (1 << k) + 1])
                if len(table) > 1 << k:
                    table = np.minimum(table[: -(1 << k)], table[1 << k :])
            new[same + 1] = out + 1
        order, common = order[moved], new
        if c <= reach:
            long = common >= shape.length
            if first_stays:
                begin = np.flatnonzero(~long)
                found[reach - c, order] = order != np.repeat(np.minimum.reduceat(order, begin), np.diff(np.append(begin, m)))
            else:
                found[reach - c, order] = long | np.append(long[1:], False)
    return found


def _spans(s: int, found: np.ndarray, k1, k2, q) -> pa.RecordBatch:
    """Repeated starts, by rows of distance before the anchor, as intervals."""
    edge = np.diff(np.pad(found.T.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    who, begin = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    hi, lo = q[who] - begin, q[who] - (end - 1)
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(who), s, np.int32)), pa.array(k1[who]), pa.array(k2[who]), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], names=["s", "k1", "k2", "lo", "hi"])


def _compare(batches: Iterator[pa.RecordBatch], shapes: list[Shape], first_stays: bool) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by anchor hash become intervals of repeated starts; whole anchors are compared together."""

    def compared(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        of = rows.column("s").to_numpy()
        for s in np.unique(of).tolist():
            part = rows.filter(pa.array(of == s))
            run, k1, k2 = (part.column(c).to_numpy() for c in ("run", "k1", "k2"))
            part = part.take(pa.array(np.lexsort((run, k2, k1))))  # the first of equal strings is the one of the lowest place
            run, k1, k2 = (part.column(c).to_numpy() for c in ("run", "k1", "k2"))
            new = np.append(True, (run[1:] != run[:-1]) | (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))
            part = part.filter(pa.array(new))  # a context may have been fetched from several rows of one text
            run, k1, k2, kind = (part.column(c).to_numpy() for c in ("run", "k1", "k2", "kind"))
            lo, _, q = _unpack(run)
            found = repeated_starts(part.column("bytes").to_pylist(), q - lo, shapes[s], first_stays)
            if not first_stays:
                found[:, kind != 1] = False
            yield _spans(s, found, k1, k2, q)

    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        held.append(b)
        size += b.num_rows
        if size >= BATCH:
            rows = pa.Table.from_batches(held)
            h = rows.column("h").to_numpy()
            whole = int(np.searchsorted(h, h[-1]))  # the last anchor may go on
            if whole:
                yield from compared(rows.slice(0, whole))
            held = rows.slice(whole).combine_chunks().to_batches()
            size -= whole
    if size:
        yield from compared(pa.Table.from_batches(held))


def _context_rows(batches: Iterator[pa.RecordBatch], shapes: list[Shape]) -> Iterator[pa.RecordBatch]:
    """The bytes of the contexts that each text's ``wanted`` names, once for all rows of a text in a slice."""
    for b in _slices(batches, SLICE // 4):
        out, seen = [], set()
        for t, k1, k2, wanted in zip(b.column("text"), b.column("k1").to_pylist(), b.column("k2").to_pylist(), b.column("wanted")):
            if (k1, k2) in seen:
                continue
            seen.add((k1, k2))
            data = t.as_py().encode()
            for w in wanted.as_py():
                lo, hi, _ = _unpack(w["run"])
                out.append((w["s"], w["h"], w["kind"], k1, k2, w["run"], data[lo : hi + shapes[w["s"]].length]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["s", "h", "kind", "k1", "k2", "run", "bytes"])


def _hot_windows(batches: Iterator[pa.RecordBatch], shapes: list[Shape]) -> Iterator[pa.RecordBatch]:
    """Each string of a context by 128 bits of hash; anchors that very many contexts share are counted so. The strings of ``TOGETHER`` contexts go out together."""
    digest = xxhash.xxh3_128_digest
    for whole in batches:
        for at in range(0, whole.num_rows, TOGETHER):
            b = whole.slice(at, TOGETHER)
            s, run, k1, k2, kind = (b.column(c).to_numpy() for c in ("s", "run", "k1", "k2", "kind"))
            lo, hi, _ = _unpack(run)
            n = hi - lo + 1
            width = [shapes[x].length for x in s.tolist()]
            digests = [digest(data[i : i + w]) for data, w, m in zip(b.column("bytes").to_pylist(), width, n.tolist()) for i in range(m)]
            places = np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)
            columns = [pa.array(np.repeat(s, n)), pa.array(digests, pa.binary()), *[pa.array(np.repeat(x, n)) for x in (k1, k2)], pa.array(places.astype(np.int32)), pa.array(np.repeat(kind, n))]
            yield pa.RecordBatch.from_arrays(columns, names=["s", "digest", "k1", "k2", "lo", "kind"])


def repeats(documents: DataFrame, shapes: list[Shape], text_col: str = "text", keep: str = "none", hot: int = HOT) -> DataFrame:
    """Intervals (s, k1, k2, lo, hi) of starts of repeated strings: the place of the shape in ``shapes``, the key of the text (``_keys``), first and last start. Materialises the classified runs and the contexts."""
    if keep not in ("none", "first"):
        raise ValueError(f"keep is none or first, not {keep}")
    stays = keep == "first"
    k1, k2 = _keys(text_col)
    texts = documents.filter(F.octet_length(text_col) >= min(x.length for x in shapes)).select(k1.alias("k1"), k2.alias("k2"), F.col(text_col).alias("text"))
    runs = texts.mapInArrow(lambda b: _emit_runs(b, shapes, stays), _RUN).repartition("part").sortWithinPartitions(F.col("n") > 0, "h", "ctx", "k1", "k2", "run")
    kinds, _ = materialise(runs.mapInArrow(lambda b: _classify(b, stays), _KIND), "runs")
    lo = F.shiftright("run", 24)
    whole = kinds.filter("kind = 0").select("s", "k1", "k2", lo.cast("int").alias("lo"), (lo + F.shiftright("run", 12).bitwiseAND(F.lit(4095))).cast("int").alias("hi"))
    # as many entries as a text has runs, however many rows hold the text
    wanted = kinds.filter("kind > 0").groupBy("k1", "k2").agg(F.collect_set(F.struct("s", "h", "kind", "run")).alias("wanted"))
    one = texts.join(wanted, ["k1", "k2"]).mapInArrow(lambda b: _context_rows(b, shapes), "s int, h long, kind int, k1 long, k2 long, run long, bytes binary")
    contexts, _ = materialise(one, "contexts")
    crowded = kinds.filter("kind > 0").groupBy("h").count().filter(F.col("count") > hot).select("h")
    usual, spans = contexts, whole
    if not crowded.isEmpty():
        crowded, _ = materialise(crowded, "crowded")
        usual = contexts.join(crowded, "h", "left_anti")
        each = contexts.join(crowded, "h", "left_semi").mapInArrow(lambda b: _hot_windows(b, shapes), "s int, digest binary, k1 long, k2 long, lo int, kind int").distinct()
        place = F.struct("k1", "k2", "lo")
        twice = each.groupBy("digest").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1")
        found = each.join(twice, "digest").filter(place != F.col("first") if stays else F.col("kind") == 1)
        spans = spans.union(found.select("s", "k1", "k2", "lo", F.col("lo").alias("hi")))
    compared = usual.repartition("h").sortWithinPartitions("h").mapInArrow(lambda b: _compare(b, shapes, stays), _SPAN)
    return spans.union(compared)


def _keys(text_col: str) -> tuple:
    """Two 64-bit hashes that stand for a text."""
    return F.xxhash64(text_col), F.xxhash64(F.lit(1), text_col)


def removed_ranges(length: int, spans: list[tuple[int, int]], width: int = BYTES_400.length) -> list[tuple[int, int]]:
    """Maximal runs (begin, end) of bytes covered by strings of ``width`` bytes whose first and last starts are given."""
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi + width)
        else:
            out.append([lo, hi + width])
    return [(a, min(b, length)) for a, b in out]


def _with_spans(documents: DataFrame, shapes: list[Shape], text_col: str, keep: str, hot: int = HOT) -> tuple[DataFrame, str]:
    """``documents`` with a column of the spans of each row's text, and that column's name."""
    name, a, b = (unused(documents.columns, n) for n in ("spans", "key_a", "key_b"))
    spans = repeats(documents, shapes, text_col, keep, hot)
    k1, k2 = _keys(text_col)
    by_text = spans.groupBy(F.col("k1").alias(a), F.col("k2").alias(b)).agg(F.collect_set(F.struct("s", "lo", "hi")).alias(name))
    return documents.withColumns({a: k1, b: k2}).join(by_text, [a, b], "left").select(*documents.columns, name), name


def _gone(data: bytes, spans: list | None, s: int, shape: Shape) -> list[tuple[int, int]]:
    gone = removed_ranges(len(data), [(x["lo"], x["hi"]) for x in spans or [] if x["s"] == s], shape.length)
    if shape.words:
        gone = [(a, b) for a, b in (_whole_words(data, *r) for r in gone) if len(data[a:b].split()) >= shape.words]
    return gone


def _whole_words(data: bytes, a: int, b: int) -> tuple[int, int]:
    """The part of a run from the first word that begins in it to the white space behind the last that ends in it."""
    if a and data[a - 1 : a].strip():
        split = re.search(rb"\s", data[a:b])
        a = a + split.start() if split else b
    a = b - len(data[a:b].lstrip())
    if data[b : b + 1].strip() and data[b - 1 : b].strip():
        b = a + len(re.sub(rb"\S+$", b"", data[a:b]))
    return a, b


def _left(data: bytes, gone: list[tuple[int, int]]) -> list[bytes]:
    ends = [0, *[x for r in gone for x in r], len(data)]
    return [data[a:b] for a, b in zip(ends[::2], ends[1::2])]


def deduplicate(documents: DataFrame, text_col: str = "text", shape: Shape = BYTES_400, keep: str = "none") -> DataFrame:
    """``documents`` with the repeated bytes cut out of the texts; what a cut leaves of a split character goes too."""
    schema, names = documents.schema, documents.columns
    joined, spans = _with_spans(documents, [shape], text_col, keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches, SLICE, text_col):
            texts = []
            for t, s in zip(b.column(text_col), b.column(spans)):
                t, s = t.as_py(), s.as_py()
                if s:
                    data = t.encode()
                    t = b"".join(_left(data, _gone(data, s, 0, shape))).decode("utf-8", "ignore")
                texts.append(t)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if n == text_col else b.column(n) for n in names], names=names)

    return joined.mapInArrow(run, schema)


def report(documents: DataFrame) -> DataFrame:
    """The columns that query op6 returns; ``n_passages`` and ``passage_bytes`` are beside them, for repeated passages of more than 50 words (``WORDS_50``)."""
    docs = documents.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    joined, spans = _with_spans(docs, [BYTES_400, WORDS_50], "text", "none")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches, SLICE):
            out = []
            for t, s in zip(b.column("text"), b.column(spans)):
                data, s = (t.as_py() or "").encode(), s.as_py()
                gone, passages = _gone(data, s, 0, BYTES_400), _gone(data, s, 1, WORDS_50)
                digest = hashlib.sha256()
                for x in _left(data, gone):
                    digest.update(x)
                out.append((len(data), sum(y - x for x, y in gone), len(gone), digest.hexdigest(), len(passages), sum(y - x for x, y in passages)))
            n, removed, runs, sha, *more = zip(*out)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(x, pa.int64()) for x in (n, removed, runs)], pa.array(sha, pa.string()), *[pa.array(x, pa.int64()) for x in more]], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passages", "passage_bytes"])

    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passages long, passage_bytes long")
