"""Chat formatting as one prefix tree.

A turn becomes a segment ``<s>[ROLE]role[/ROLE]text</s>``. Inside roles and texts
a backslash follows every ``<`` and ``[``, so no control string can stand there,
and taking those backslashes out gives the text back.

Conversations that begin with the same turns share these turns' nodes. Sorted by
their paths (a 128-bit chained hash per turn), conversations come in depth-first
order, and a node is new where a path departs from the one before it. Each new
node is emitted once, at the next free place of one flat sequence, with the
position of its first token within its conversation (what its ancestors hold)
and the places of its ancestors as intervals, touching ones merged: these, and
what precedes it within the node, are what a token may attend to. Tokens are
code points here.

The sort is spread over ranges of paths whose bounds come from a bounded sample
of paths. What crosses a bound is small: a first pass reports for each range
how much it emits and where its last path lies; the driver adds these up (a row
per range); a second pass emits. A tree of any number of conversations is
thereby split over ranges, and still no node is emitted twice. Equal
conversations are one path, folded before the sort, so that however many there are
the walk meets them once. A conversation itself is one row.

Defined results: null roles and texts are empty; a row with a null id is a
conversation of its own, of one turn; turns are ordered by (turn, role, text), nulls first, so repeated
rows are turns of their own; a conversation of which another is a prefix shares
all its nodes; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import materialise

ASSISTANT = "assistant"
ID = 16
#: Conversations per range of the sort, and paths sampled per range to find its bounds.
RANGE_ROWS, SAMPLED = 20_000, 20
_OPEN, _MIDDLE, _CLOSE = "<s>[ROLE]", "[/ROLE]", "</s>"
_SEGMENT = re.compile(r"<s>\[ROLE\](.*?)\[/ROLE\](.*?)</s>", re.DOTALL)


def escape(text: str) -> str:
    return re.sub(r"([<\[])", r"\1\\", text)


def unescape(text: str) -> str:
    return re.sub(r"([<\[])\\", r"\1", text)


def segment(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where in it the text begins and how long it is there."""
    head, body = f"{_OPEN}{escape(role)}{_MIDDLE}", escape(text)
    return head + body + _CLOSE, len(head), len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    return [(unescape(r), unescape(t)) for r, t in _SEGMENT.findall(formatted)]


def path_of(turns: list[tuple[str, str]]) -> bytes:
    """The node ids of the turns, joined; a node's id depends on its turn and all before it."""
    out, last = [], b""
    for role, text in turns:
        r = role.encode()
        last = hashlib.blake2b(last + len(r).to_bytes(4, "big") + r + text.encode(), digest_size=ID).digest()
        out.append(last)
    return b"".join(out)


def _shared(a: bytes, b: bytes) -> int:
    """How many leading nodes two paths share."""
    n = min(len(a), len(b)) // ID
    if a[: n * ID] == b[: n * ID]:
        return n
    lo, hi = 0, n
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[: mid * ID] == b[: mid * ID] else (lo, mid - 1)
    return lo


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in spans:
        if out and out[-1][1] == a:
            out[-1] = out[-1][0], b
        else:
            out.append((a, b))
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        for row in zip(*[c.to_pylist() for c in b.columns]):
            yield row


def conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, alone, path, turns): a row per conversation; ``alone`` numbers those without an id."""
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    alone = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    each = rows.select("conv_id", alone.alias("alone"), turn.alias("each")).groupBy("conv_id", "alone").agg(F.sort_array(F.collect_list("each")).alias("turns")).select("conv_id", "alone", F.expr("transform(turns, t -> struct(t.role, t.text))").alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths = [path_of([(t["role"], t["text"]) for t in turns]) for turns in b.column("turns").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("alone"), pa.array(paths, pa.binary()), b.column("turns")], names=["conv_id", "alone", "path", "turns"])

    kind = each.schema["conv_id"].dataType.simpleString()
    return each.mapInArrow(run, f"conv_id {kind}, alone long, path binary, turns array<struct<role:string,text:string>>")


def prefix_tree(rows: DataFrame, range_rows: int = RANGE_ROWS) -> tuple[DataFrame, DataFrame]:
    """(nodes, paths), both materialised.

    nodes: start, size, position, depth, segment, loss_begin, loss_size (the
    masked part of an assistant's segment, else 0), ancestors (intervals of the flat sequence).
    paths: conv_id, alone, depth and start of each node that the conversation passes.
    """
    each, _ = materialise(conversations(rows), "conversations")
    convs, _ = materialise(each.groupBy("path").agg(F.first("turns").alias("turns")), "paths")  # equal paths have equal turns
    total = convs.count()
    parts = max(1, -(-total // range_rows))
    share = min(1.0, SAMPLED * parts / max(total, 1))
    sampled = sorted(bytes(r[0]) for r in convs.filter(F.pmod(F.xxhash64("path"), F.lit(1_000_000)) < share * 1_000_000).select("path").collect()) if parts > 1 else []
    bounds = sorted({sampled[len(sampled) * i // parts] for i in range(1, parts)}) if sampled else []

    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = pa.array([bisect_right(bounds, p) for p in b.column("path").to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([at, *b.columns], names=["range", *b.schema.names])

    placed = convs.mapInArrow(ranged, f"range int, {', '.join(f'{f.name} {f.dataType.simpleString()}' for f in convs.schema)}")
    last = {r["range"]: bytes(r["path"]) for r in placed.groupBy("range").agg(F.max("path").alias("path")).collect()}
    ahead, before = {}, b""
    for r in sorted(last):
        ahead[r], before = before, last[r]
    in_order = placed.repartition("range").sortWithinPartitions("range", "path")

    def walk(batches: Iterator[pa.RecordBatch], base: dict[int, int], inherited: dict[int, list[tuple[int, int]]]):
        """For each path in order: (range, path, formatted turns, turns, nodes on it as (start, end), how many of them are old, the next free place)."""
        here, free, path, nodes = None, 0, b"", []
        for r, p, turns in _rows(batches):
            if r != here:
                here, free, path, nodes = r, base.get(r, 0), ahead[r], list(inherited.get(r, []))
            p = bytes(p)
            old = _shared(path, p)
            nodes = nodes[:old]
            made = [segment(t["role"], t["text"]) for t in turns]
            for s, _, _ in made[old:]:
                nodes.append((free, free + len(s)))
                free += len(s)
            path = p
            yield r, p, made, turns, nodes, old, free

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How much each range emits and where the nodes of its last path are; an inherited node is (-1, its depth)."""
        marks = {r: [(-1, i) for i in range(len(p) // ID)] for r, p in ahead.items()}
        end: dict[int, tuple] = {}
        for r, _, _, _, nodes, _, free in walk(batches, {}, marks):
            end[r] = free, nodes
        if end:
            yield pa.RecordBatch.from_arrays([pa.array(list(end), pa.int32()), pa.array([x for x, _ in end.values()], pa.int64()), pa.array([[a for n in v for a in n] for _, v in end.values()], pa.list_(pa.int64()))], names=["range", "size", "nodes"])

    base, inherited, free, stack = {}, {}, 0, []
    for r in sorted(in_order.mapInArrow(survey, "range int, size long, nodes array<long>").collect()):  # a row per range
        base[r["range"]], inherited[r["range"]] = free, stack
        flat = list(r["nodes"])
        stack = [stack[b] if a < 0 else (a + free, b + free) for a, b in zip(flat[::2], flat[1::2])]
        free += r["size"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "path", "starts", "depth", "start", "size", "position", "segment", "loss_begin", "loss_size", "ancestors"]
        types = [pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))]

        def batch(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names=names)

        out, held = [], 0
        for _, path, made, turns, nodes, old, _ in walk(batches, base, inherited):
            out.append((1, path, [a for a, _ in nodes], None, None, None, None, None, None, None, None))
            held += 24 * len(nodes)
            position = sum(b - a for a, b in nodes[:old])
            for depth in range(old, len(made)):
                (text, begin, size), (a, b) = made[depth], nodes[depth]
                loss = (begin, size) if turns[depth]["role"] == ASSISTANT else (0, 0)
                spans = [{"begin": x, "end": y} for x, y in merged(nodes[:depth])]
                out.append((0, None, None, depth, a, b - a, position, text, *loss, spans))
                held += len(text) + 16 * len(spans)
                position += b - a
            if len(out) > 5_000 or held > 4_000_000:
                yield batch(out)
                out, held = [], 0
        if out:
            yield batch(out)

    both, _ = materialise(in_order.mapInArrow(emit, "kind int, path binary, starts array<long>, depth int, start long, size int, position long, segment string, loss_begin int, loss_size int, ancestors array<struct<begin:long,end:long>>"), "tree")
    nodes = both.filter("kind = 0").drop("kind", "path", "starts")
    passed = each.select("conv_id", "alone", "path").join(both.filter("kind = 1").select("path", "starts"), "path")
    return nodes, passed.select("conv_id", "alone", F.posexplode("starts").alias("depth", "start"))


def read_back(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """(conv_id, formatted, losses): each conversation's text put together from the tree, and its masked parts still escaped."""
    part = F.struct("depth", "segment", F.expr("substring(segment, loss_begin + 1, loss_size)").alias("loss"), (F.col("loss_begin") > 0).alias("masked"))
    whole = paths.join(nodes.select("start", "segment", "loss_begin", "loss_size"), "start").groupBy("conv_id", "alone").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    return whole.select("conv_id", F.expr("array_join(transform(parts, p -> p.segment), '')").alias("formatted"), F.expr("transform(filter(parts, p -> p.masked), p -> p.loss)").alias("losses"))


def report(rows: DataFrame) -> DataFrame:
    """The columns that query op1 returns, all read back from the tree."""
    rows = rows.select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    probe = rows.sparkSession.range(2).select(F.lit(-7).cast(rows.schema["conv_id"].dataType).alias("conv_id"), F.col("id").cast(rows.schema["turn"].dataType).alias("turn"), F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"), F.lit(text).alias("text"))
    back = read_back(*prefix_tree(rows.union(probe)))
    kind = back.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for formatted, losses in zip(b.column("formatted").to_pylist(), b.column("losses").to_pylist()):
                turns = parse(formatted)
                loss = "".join(map(unescape, losses))
                out.append((len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted)))
            if out:
                yield pa.RecordBatch.from_arrays([b.column("conv_id"), *[pa.array(x) for x in zip(*out)]], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return back.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
