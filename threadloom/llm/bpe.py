"""Byte-level BPE by batched merge rounds in numpy.

The symbols of many words lie in one flat array with a word number beside each.
A round looks every adjacent pair up by binary search over the sorted pair
keys, finds each word's lowest rank, and merges that pair wherever it stands in
the word, from left to right; words without a known pair leave the array. A word of
more than ``ROUNDS_UP_TO`` bytes, which would take a round for each of its ranks, is merged
by itself with a heap of its pairs, in the same order. Texts
are cut into chunks before single spaces, which never lie inside a pre-token,
so each worker encodes a distinct chunk once and keeps a bounded table of them.

Added tokens (such as ``<|endoftext|>``) are found in the raw text first, as the
tokenizer file says. Defined results: a null text is the empty text, which has
no tokens; whole texts are encoded whatever their length; repeated rows give
one row each; extra columns are ignored by ``report`` and kept by ``encode``;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType

from threadloom.llm.common import worker_cache

#: Chunks that a worker keeps; beyond that its table starts anew.
TABLE = 250_000
#: New chunks that are merged together.
PART = 20_000
#: Bytes of the longest word that goes through the rounds.
ROUNDS_UP_TO = 512
_PRE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
_NONE = np.iinfo(np.int64).max


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Bpe:
    """An encoder and decoder for a tokenizer file of kind BPE with byte-level pre-tokens."""

    def __init__(self, path: str, table: int = TABLE):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges") or spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError("only plain byte-level BPE files are supported")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens with stripping, word or normalisation rules are not supported")
        vocab, shown = model["vocab"], byte_characters()
        of_char = {c: b for b, c in shown.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_added = re.compile("(" + "|".join(sorted(map(re.escape, self.added), key=len, reverse=True)) + ")") if self.added else None
        self.byte_id = np.array([vocab[shown[b]] for b in range(256)], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order, made[order]
        self.of_rank = made
        self.rank_of = dict(zip(keys.tolist(), range(len(keys))))
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(of_char[c] for c in token)
        for token, i in self.added.items():
            self.bytes_of[i] = token.encode()
        self.pre = regex.compile(_PRE)
        self.limit = table
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.flat = np.zeros(0, np.int64)
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def merge(self, symbols: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merges ``symbols``, where ``words`` (not descending) says whose each is, until no known pair is left."""
        done_s, done_w = [], []
        while len(symbols) > 1:
            same = words[1:] == words[:-1]
            key = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where(same & (self.keys[at] == key), self.rank[at], _NONE)
            rank = np.append(rank, _NONE)
            begins = np.flatnonzero(np.append(True, ~same))
            sizes = np.diff(np.append(begins, len(words)))
            least = np.repeat(np.minimum.reduceat(rank, begins), sizes)
            live = least != _NONE
            if not live.all():
                done_s.append(symbols[~live])
                done_w.append(words[~live])
                symbols, words, rank, least = symbols[live], words[live], rank[live], least[live]
                if not len(symbols):
                    break
            hit = np.flatnonzero(rank == least)
            # of overlapping hits (a run of equal symbols) every other one from the left
            run = np.append(True, np.diff(hit) > 1)
            first = hit[run][np.cumsum(run) - 1]
            hit = hit[(hit - first) % 2 == 0]
            symbols = symbols.copy()
            symbols[hit] = self.of_rank[rank[hit]]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            symbols, words = symbols[keep], words[keep]
        done_s.append(symbols)
        done_w.append(words)
        s, w = np.concatenate(done_s), np.concatenate(done_w)
        order = np.argsort(w, kind="stable")
        return s[order], w[order]

    def merge_long(self, symbols: list[int]) -> list[int]:
        """What ``merge`` makes of one word: the lowest rank first, the leftmost of equal ones, from a heap of (rank, place) in a linked list of symbols."""
        n, rank_of, made = len(symbols), self.rank_of, self.of_rank.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i, pair in enumerate(zip(symbols, symbols[1:])) if (r := rank_of.get(pair[0] << 32 | pair[1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if symbols[i] < 0 or j >= n or rank_of.get(symbols[i] << 32 | symbols[j]) != r:
                continue  # one of the two has been merged since
            symbols[i], symbols[j], after[i] = made[r], -1, after[j]
            k = after[i]
            if k < n:
                before[k] = i
                if (x := rank_of.get(symbols[i] << 32 | symbols[k])) is not None:
                    heapq.heappush(heap, (x, i))
            if (h := before[i]) >= 0 and (x := rank_of.get(symbols[h] << 32 | symbols[i])) is not None:
                heapq.heappush(heap, (x, h))
        return [x for x in symbols if x >= 0]

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pre-tokens in ``texts``, flat, and the number of the text each belongs to."""
        pieces, owner = [], []
        for i, t in enumerate(texts):
            found = self.pre.findall(t)
            pieces += found
            owner += [i] * len(found)
        if not pieces:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        raw = [p.encode() for p in pieces]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        symbols = self.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        which = np.repeat(np.arange(len(raw)), sizes)
        long = np.flatnonzero(sizes > ROUNDS_UP_TO)
        if len(long):
            apart = np.isin(which, long)
            alone = [np.array(self.merge_long(symbols[which == w].tolist()), np.int64) for w in long.tolist()]
            ids, which = self.merge(symbols[~apart], which[~apart])
            ids, which = np.concatenate([ids, *alone]), np.concatenate([which, np.repeat(long, [len(x) for x in alone])])
            order = np.argsort(which, kind="stable")
            ids, which = ids[order], which[order]
        else:
            ids, which = self.merge(symbols, which)
        return ids, np.array(owner, np.int64)[which]

    @staticmethod
    def chunks(text: str) -> list[str]:
        """``text`` cut before each space that visible text follows; no pre-token crosses such a cut."""
        if "  " in text or _ODD_SPACE.search(text):
            return _CUT.split(text)
        first, *rest = text.split(" ")
        return [first, *[" " + x for x in rest]]

    def _add(self, new: list[str]) -> None:
        ids, lengths = [], []
        for at in range(0, len(new), PART):
            part = new[at : at + PART]
            found, owner = self.words(part)
            ids.append(found)
            lengths.append(np.bincount(owner, minlength=len(part)).astype(np.int64))
        ids, lengths = np.concatenate(ids), np.concatenate(lengths)
        starts = len(self.flat) + np.cumsum(lengths) - lengths
        for n, c in enumerate(new, len(self.number)):
            self.number[c] = n
        self.flat = np.concatenate([self.flat, ids])
        self.start, self.length = np.concatenate([self.start, starts]), np.concatenate([self.length, lengths])

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text."""
        if len(self.number) > self.limit:
            self._clear()
        parts: list[list] = []  # of each text: lists of chunks and ids of added tokens
        for t in texts:
            if self.split_added and any(a in t for a in self.added):
                parts.append([self.added[p] if k % 2 else self.chunks(p) for k, p in enumerate(self.split_added.split(t))])
            else:
                parts.append([self.chunks(t)])
        new = {c for p in parts for x in p if isinstance(x, list) for c in x}.difference(self.number)
        if new:
            self._add(sorted(new))
        get = self.number.__getitem__
        out = []
        for p in parts:
            found = []
            for x in p:
                if isinstance(x, int):
                    found.append(np.array([x], np.int64))
                    continue
                n = np.fromiter(map(get, x), np.int64, len(x))
                sizes = self.length[n]
                ends = np.cumsum(sizes)
                found.append(self.flat[np.repeat(self.start[n] - ends + sizes, sizes) + np.arange(ends[-1])])
            out.append(found[0] if len(found) == 1 else np.concatenate(found))
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


_ODD_SPACE = re.compile(r" (?:\s|\Z)")
_CUT = re.compile(r"(?= \S)")


def _bpe(path: str) -> Bpe:
    """A worker loads a tokenizer once."""
    cache = worker_cache("bpe")
    if ("bpe", path) not in cache:
        cache["bpe", path] = Bpe(path)
    return cache["bpe", path]


def _slices(batches: Iterator[pa.RecordBatch], text: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that a slice has about ``most`` bytes of text or one row."""
    for b in batches:
        size = b.column(text).nbytes
        step = max(1, int(b.num_rows * most / max(size, 1)))
        for i in range(0, b.num_rows, step):
            yield b.slice(i, step)


def encode(df: DataFrame, path: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``df`` with the token ids of each text as an array of ints in ``out_col``."""
    schema = df.drop(out_col).schema.add(out_col, ArrayType(IntegerType()))
    names = [c for c in df.columns if c != out_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(path)
        for b in _slices(batches, text_col):
            ids = bpe.encode_batch([t or "" for t in b.column(text_col).to_pylist()])
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
            made = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], made], names=[*names, out_col])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """``df`` with the text of each array of token ids in ``out_col``; null ids are no ids."""
    schema = df.drop(out_col).schema.add(out_col, "string")
    names = [c for c in df.columns if c != out_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(path)
        for b in batches:
            texts = [bpe.decode(np.array(x or [], np.int64)) for x in b.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], pa.array(texts, pa.string())], names=[*names, out_col])

    return df.mapInArrow(run, schema)


def report(documents: DataFrame, path: str) -> DataFrame:
    """The digest of encoding and decoding that query op3 returns."""
    docs = documents.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(path)
        for b in _slices(batches, "text"):
            n, ids_sha, text_sha = [], [], []
            for ids in bpe.encode_batch([t or "" for t in b.column("text").to_pylist()]):
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                text_sha.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.mapInArrow(run, f"doc_id {kind.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
