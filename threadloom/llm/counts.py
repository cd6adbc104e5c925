"""Token counts without tokens: a Viterbi pass that carries the best score and the number of pieces.

An Aho-Corasick automaton over a unigram vocabulary lists every piece that ends
at each character of a word; dynamic programming keeps, per character, the best
score and how many pieces it takes. Nothing is traced back. The rules are those
of the public tokenizers library's unigram model: scores add up as doubles from
left to right; of equal scores the longest piece (which is met first) stays; a character
that is no piece costs the lowest score less ten; unknown characters in a row
are one token, which byte pieces, where the vocabulary has them, replace by one token a byte. Words are what
spaces separate, each led by the mark, as the library's Metaspace step cuts them, so a worker counts a distinct word once
(in a table of bounded size).

The box has no public unigram file, so the pieces of the public BPE file serve as
vocabulary with log probabilities that follow from their rank; vocabulary and scores are parameters.

Defined results: a null or empty text has no tokens; whole texts are counted;
repeated rows give one row each; extra columns are kept by ``count``; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from threadloom.llm.common import worker_cache

MARK = "▁"
TABLE = 300_000
#: What an unknown character costs beyond the lowest score.
PENALTY = 10.0


def vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece file in its order, scored by log(1 / (rank + 10)), normalised over the ordinary pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    total = math.log(sum(1 / (i + 10) for i in range(n)))
    return [(sp.id_to_piece(i), -math.log(i + 10) - total) for i in range(n)]


class Counter:
    """Counts tokens under a unigram vocabulary; ``unknown`` is the number of the unknown piece."""

    def __init__(self, pieces: list[tuple[str, float]], unknown: int = 0, byte_fallback: bool = True):
        self.automaton = ahocorasick.Automaton()
        for piece, score in reversed(pieces):
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.unknown_piece = pieces[unknown][0]
        self.automaton.make_automaton()
        self.floor = min(s for _, s in pieces) - PENALTY
        names = {p for p, _ in pieces}
        self.bytes = byte_fallback and all(f"<0x{b:02X}>" in names for b in range(256))
        self.single = {p for p in names if len(p) == 1}
        self.table: dict[str, int] = {}

    def _known(self, word: str) -> int:
        """``_word`` of a word whose characters all are pieces, so that nothing in it is unknown. The automaton tells the pieces that end at a place longest first."""
        n = len(word) + 1
        score, count = [-math.inf] * n, [0] * n
        score[0] = 0.0
        for i, (length, s) in self.automaton.iter(word):
            i += 1
            total = score[i - length] + s
            if total > score[i]:
                score[i], count[i] = total, count[i - length] + 1
        return count[-1]

    def _word(self, word: str) -> int:
        """Best segmentation's number of tokens."""
        n = len(word)
        # pieces that end at i + 1, as (length, score)
        ending: list[list] = [[] for _ in range(n)]
        for i, found in self.automaton.iter(word):
            ending[i].append(found)
        score, count, run = [0.0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        # run: bytes or 1 of the unknown characters that end here, 0 if the last piece is known
        for i in range(n):
            best, of, is_unknown = -math.inf, 0, True
            single = False
            for length, s in sorted(ending[i], reverse=True):
                total = score[i + 1 - length] + s
                single |= length == 1
                if total > best:
                    best, of, is_unknown = total, length, False
            if not single and score[i] + self.floor > best:
                best, of, is_unknown = score[i] + self.floor, 1, True
            score[i + 1] = best
            if not is_unknown:
                count[i + 1], run[i + 1] = count[i + 1 - of] + 1, 0
            else:
                size = len(word[i].encode()) if self.bytes else 1
                count[i + 1] = count[i] + (size if self.bytes or not run[i] else 0)
                run[i + 1] = 1
        return count[n]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        words = self.words(text)
        if len(self.table) > TABLE:
            self.table.clear()
        for w in set(words).difference(self.table):
            self.table[w] = self._known(w) if self.single.issuperset(w) else self._word(w)
        return sum(map(self.table.__getitem__, words))

    @staticmethod
    def words(text: str) -> list[str]:
        """The marked words of a text: each space, and the beginning, starts one."""
        text = text.replace(" ", MARK)
        if not text.startswith(MARK):
            text = MARK + text
        return [MARK + w for w in text.split(MARK)[1:]]


def _counter(path: str) -> Counter:
    cache = worker_cache("counts")
    if ("counter", path) not in cache:
        cache["counter", path] = Counter(vocabulary(path))
    return cache["counter", path]


def count(df: DataFrame, path: str, text_col: str = "text", out_col: str = "n_tokens") -> DataFrame:
    """``df`` with the number of tokens of each text."""
    names = [c for c in df.columns if c != out_col]
    schema = df.select(*names).schema.add(out_col, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for b in batches:
            n = np.fromiter((counter.count(t.as_py()) for t in b.column(text_col)), np.int64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(n)], names=[*names, out_col])

    return df.select(*names).mapInArrow(run, schema)


def report(documents: DataFrame, path: str) -> DataFrame:
    """The columns that query op2 returns."""
    return count(documents.select("doc_id", "text"), path).select("doc_id", "n_tokens")
