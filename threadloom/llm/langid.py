"""Language identification by unigrams marginalised over segmentations.

A language is a probability for each piece of a fixed public vocabulary. A
word's likelihood is the sum, over all ways to cut it into pieces, of the
products of their probabilities: a forward pass. The probabilities are fitted by
expectation maximisation: the expected uses of each piece, from a forward and a
backward pass over each distinct word, become the next probabilities.

Words are what white space separates in the lower-cased text, each led by the vocabulary's word mark; no
piece crosses a word, so a text's likelihood is the product over its words, and
a worker scores a distinct word once (in a table of bounded size). A character
that is no piece has one small probability under every language. Many words go
through the passes together: a trie is followed from all places to list the pieces in all
of them, and each step adds up, in numpy, the pieces that end (or begin) at one place of any word.

Fitting reads at most about ``SAMPLE_ROWS`` labelled rows (expected number, the
same share for each language, chosen by a hash of the id); scoring reads every
text whole. Defined results: a null text, or one without a letter, is ``und``
with score 0.0, and so is any text when no labelled row is left to learn from;
a null id is hashed as the empty string; repeated rows give one row each; extra
columns are kept by ``identify``; an empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import materialise, remove, unused, worker_cache

SAMPLE_ROWS = 6_000
ROUNDS = 2
#: Added to the expected uses of each piece.
SMOOTHING = 0.05
#: Probability of a character that is no piece.
UNKNOWN = 1e-7
TABLE = 300_000
#: Longer words are rescaled on their way.
LONG = 32
#: Words of up to LONG characters that are scored together.
PART = 5_000
#: Characters of longer words that are scored together.
TOGETHER = 200_000
#: Characters of the parts that longer words are cut into for fitting.
CUT = 24
#: More labels than this are no languages but dirt: fitting refuses them.
MOST_LANGUAGES = 1_000
#: Bytes of text that are scored together.
SLICE = 4_000_000
MARK = "▁"
UNDETERMINED = "und"


@dataclass(frozen=True)
class Model:
    """``p[i, l]`` is the probability of piece i under language l."""

    vocabulary: str
    languages: tuple[str, ...]
    prior: np.ndarray
    p: np.ndarray


def pieces(path: str) -> dict[str, int]:
    """Number of each ordinary piece of a sentencepiece file; control, unknown and byte pieces, and those of LONG or more characters, are left out."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    names = [name for name in names if len(name) < LONG and "\n" not in name]
    return {name: i for i, name in enumerate(names)}


def _pieces(path: str) -> tuple[dict[str, int], int, Trie]:
    cache = worker_cache("langid")
    if ("pieces", path) not in cache:
        found = pieces(path)
        cache["pieces", path] = found, max(map(len, found)), Trie(found)
    return cache["pieces", path]


class Trie:
    """The pieces of a vocabulary, followed from all places of a text at once. Nodes are numbers, 0 the root; an edge is its node times the number of known characters, plus the character's place among them."""

    def __init__(self, vocabulary: dict[str, int]):
        self.chars = np.unique(np.fromiter(map(ord, "".join(vocabulary)), np.int64))
        place, width = {chr(c): i for i, c in enumerate(self.chars.tolist())}, max(len(self.chars), 1)
        edges: dict[int, int] = {}
        ends = {}
        for word, n in vocabulary.items():
            node = 0
            for c in word:
                node = edges.setdefault(node * width + place[c], len(edges) + 1)
            ends[node] = n
        self.edges = np.fromiter(edges, np.int64, len(edges))
        self.nodes = np.argsort(self.edges)
        self.edges = self.edges[self.nodes]
        self.nodes += 1  # edges were made in the order of their nodes
        self.piece = np.full(len(edges) + 1, -1)
        self.piece[np.fromiter(ends, np.int64, len(ends))] = np.fromiter(ends.values(), np.int64, len(ends))

    def find(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each piece in ``text`` stops, its number and its size; by stop, the longest first."""
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if text and len(self.edges):
            code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
            at = np.minimum(np.searchsorted(self.chars, code), len(self.chars) - 1)
            code = np.append(np.where(self.chars[at] == code, at, -1), -1)  # -1 ends every piece, as the end of the text does
            place, node, size = np.arange(len(text)), np.zeros(len(text), np.int64), 0
            while len(place):
                c = code[place + size]
                key = node * len(self.chars) + c
                edge = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
                on = (c >= 0) & (self.edges[edge] == key)
                place, node, size = place[on], self.nodes[edge[on]], size + 1
                piece = self.piece[node]
                known = piece >= 0
                found.append((place[known] + size, piece[known], np.full(int(known.sum()), size)))
        if not found:
            return (np.zeros(0, np.int64),) * 3
        stop, piece, size = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(stop << 5 | 31 - size)
        return stop[order], piece[order], size[order]


class Lattice:
    """The pieces in some words, as edges between places of one row of places."""

    def __init__(self, words: list[str], vocabulary: dict[str, int], trie: Trie):
        text = "\n".join(words)
        stop, piece, size = trie.find(text)
        single = np.zeros(len(text) + 1, bool)
        single[stop[size == 1]] = True
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.last = np.cumsum(sizes + 1) - 1
        self.first = self.last - sizes
        word = np.repeat(np.arange(len(words)), sizes + 1)[: len(text) + 1]
        lone = np.flatnonzero(~single)
        lone = lone[lone > self.first[word[lone]]]  # where an unknown character ends
        stop = np.concatenate([stop, lone])
        start = np.concatenate([stop[: len(size)] - size, lone - 1])
        piece = np.concatenate([piece, np.full(len(lone), -1)])
        self.word, self.start, self.stop, self.piece = word[stop], start, stop, piece
        self.places = len(text) + 1
        self.steps = int(sizes.max(initial=0))

    def _pass(self, p: np.ndarray, begin: np.ndarray, source: np.ndarray, target: np.ndarray, step: np.ndarray) -> np.ndarray:
        """Sums over paths from ``begin`` to each place; ``step`` orders the edges by the place they lead to."""
        out = np.zeros((self.places, p.shape[1]))
        out[begin] = 1.0
        order = np.lexsort((target, step))
        source, target, weight, step = source[order], target[order], p[self.piece[order]], step[order]
        bounds = np.searchsorted(step, np.arange(1, self.steps + 2))
        for a, b in zip(bounds, bounds[1:]):
            if a < b:
                t = target[a:b]
                new = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
                out[t[new]] = np.add.reduceat(out[source[a:b]] * weight[a:b], new, axis=0)
        return out

    def likelihood(self, p: np.ndarray, longest: int) -> np.ndarray:
        """Log likelihood of each word of any length: every 16 places the last ``longest`` sums of a word are scaled to one, and the scale's logarithm is kept."""
        out, log = np.zeros((self.places, p.shape[1])), np.zeros((len(self.first), p.shape[1]))
        out[self.first] = 1.0
        step = self.stop - self.first[self.word]
        order = np.lexsort((self.stop, step))
        source, target, piece, step = self.start[order], self.stop[order], self.piece[order], step[order]
        bounds = np.searchsorted(step, np.arange(1, self.steps + 2))
        sizes = self.last - self.first
        for j, (a, b) in enumerate(zip(bounds, bounds[1:]), 1):
            if a < b:
                t = target[a:b]
                new = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
                out[t[new]] = np.add.reduceat(out[source[a:b]] * p[piece[a:b]], new, axis=0)
            if j % 16 == 0:
                open_ = np.flatnonzero(sizes > j)
                at = self.first[open_, None] + np.arange(max(0, j - longest), j + 1)
                scale = out[at].max(axis=1)
                out[at] /= scale[:, None]
                log[open_] += np.log(scale)
        return log + np.log(out[self.last])

    def before(self, p: np.ndarray) -> np.ndarray:
        return self._pass(p, self.first, self.start, self.stop, self.stop - self.first[self.word])

    def after(self, p: np.ndarray) -> np.ndarray:
        return self._pass(p, self.last, self.stop, self.start, self.last[self.word] - self.start)


def _extended(p: np.ndarray) -> np.ndarray:
    """``p`` with a last row, which piece -1 means, for unknown characters."""
    return np.concatenate([p, np.full((1, p.shape[1]), UNKNOWN)])


def automaton_of(vocabulary: dict[str, int]) -> Trie:
    return Trie(vocabulary)


def forward(word: str, vocabulary: dict[str, int], longest: int, p: np.ndarray) -> np.ndarray:
    """Log likelihood of one word under each language, summed over segmentations, place by place; what ``forward_all`` must equal."""
    at, log = [np.ones(p.shape[1])], np.zeros(p.shape[1])
    for j in range(1, len(word) + 1):
        total, single = np.zeros(p.shape[1]), False
        for i in range(max(0, j - longest), j):
            if (n := vocabulary.get(word[i:j])) is not None:
                total = total + at[i] * p[n]
                single |= i == j - 1
        at.append(total if single else total + at[j - 1] * UNKNOWN)
        if j % 16 == 0:
            scale = np.max(at[-longest:], axis=0)
            log += np.log(scale)
            at[-longest:] = [a / scale for a in at[-longest:]]
    return log + np.log(at[-1])


def forward_all(words: list[str], vocabulary: dict[str, int], longest: int, trie: Trie, p: np.ndarray) -> np.ndarray:
    """Log likelihood of each word under each language."""
    out = np.zeros((len(words), p.shape[1]))
    short = [i for i, w in enumerate(words) if len(w) <= LONG]
    for at in range(0, len(short), PART):
        part = short[at : at + PART]
        lattice = Lattice([words[i] for i in part], vocabulary, trie)
        out[part] = np.log(lattice.before(_extended(p))[lattice.last])
    long = sorted(set(range(len(words))).difference(short), key=lambda i: len(words[i]))
    while long:  # words of like length together, as many as hold about TOGETHER characters
        n = max(1, min(len(long), TOGETHER // len(words[long[-1]])))
        part, long = long[-n:], long[:-n]
        out[part] = Lattice([words[i] for i in part], vocabulary, trie).likelihood(_extended(p), longest)
    return out


def expected(words: list[str], weights: np.ndarray, vocabulary: dict[str, int], trie: Trie, p: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in the words (of at most LONG characters) under each language, a word counting ``weights[word, language]`` times."""
    lattice, q = Lattice(words, vocabulary, trie), _extended(p)
    before, after = lattice.before(q), lattice.after(q)
    whole = np.maximum(before[lattice.last], 1e-300)
    use = before[lattice.start] * q[lattice.piece] * after[lattice.stop] * (weights / whole)[lattice.word]
    known = lattice.piece >= 0
    return np.stack([np.bincount(lattice.piece[known], use[known, i], minlength=len(p)) for i in range(p.shape[1])], axis=1)


def held_out(id_column: Column) -> Column:
    """True where crc32 of the id as text is 1 modulo 3."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def train(documents: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS, rounds: int = ROUNDS) -> Model:
    """A model from the labelled rows that aren't held out. Runs a few actions; what reaches the driver is bounded by vocabulary times languages."""
    labelled = documents.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).filter(F.col("lang").isNotNull() & ~held_out(F.col("id")))
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"{lang_col} has more than {MOST_LANGUAGES} different values")
    languages = tuple(sorted(counts))
    known = _pieces(vocabulary)[0]
    if not languages:
        return Model(vocabulary, (), np.zeros(0), np.zeros((len(known), 0)))
    quota = sample_rows / len(languages)
    share = F.lit(0.0)
    for lang in languages:
        share = F.when(F.col("lang") == lang, F.lit(quota / counts[lang])).otherwise(share)
    sample = labelled.filter(F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(1_000_000)) < share * 1_000_000).select("lang", "text")
    words = sample.select("lang", F.explode(F.split(F.lower("text"), r"(?U)\s+")).alias("word")).filter(F.col("word") != "")
    # longer words, such as sentences without spaces, are cut; what crosses a cut isn't counted, all else is
    cut = F.regexp_extract_all("word", F.lit(rf"(?s).{{1,{CUT}}}"), F.lit(0))
    marked = F.transform(cut, lambda x, i: F.when(i == 0, F.concat(F.lit(MARK), x)).otherwise(x))
    words = words.select("lang", F.explode(F.when(F.char_length("word") < LONG, F.array(F.concat(F.lit(MARK), "word"))).otherwise(marked)).alias("word"))
    words = words.groupBy("word").agg(*[F.count_if(F.col("lang") == lang).cast("double").alias(f"n{i}") for i, lang in enumerate(languages)])
    table, path = materialise(words, "words")
    spark, n_lang = documents.sparkSession, len(languages)

    rank = np.arange(len(known), dtype=float)
    p = np.repeat((1 / (rank + 100))[:, None], n_lang, axis=1)
    p /= p.sum(axis=0)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(p)

        def step(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            vocab, _, trie = _pieces(vocabulary)
            q, total = shared.value, np.zeros((len(vocab), n_lang))
            for b in batches:
                weights = np.stack([b.column(f"n{i}").to_numpy() for i in range(n_lang)], axis=1)
                total += expected(b.column("word").to_pylist(), weights, vocab, trie, q)
            piece, lang = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(piece, pa.int32()), pa.array(lang, pa.int32()), pa.array(total[piece, lang])], names=["piece", "lang", "uses"])

        found = table.mapInArrow(step, "piece int, lang int, uses double").groupBy("piece", "lang").agg(F.sum("uses").alias("uses")).toArrow()
        total = np.full((len(known), n_lang), SMOOTHING)
        total[found.column("piece").to_numpy(), found.column("lang").to_numpy()] += found.column("uses").to_numpy()
        p = total / total.sum(axis=0)
        shared.unpersist()
    remove(spark, path)
    weight = np.array([counts[lang] for lang in languages], float)
    return Model(vocabulary, languages, np.log(weight / weight.sum()), p)


class Numbers(dict):
    """Words by number; one that is asked for the first time gets the next."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class Scorer:
    """Scores texts under a model, with a table of the words it has met."""

    def __init__(self, model: Model):
        self.model = model
        self.vocabulary, self.longest, self.trie = _pieces(model.vocabulary)
        self.letter = regex.compile(r"\p{L}")
        self._clear()

    def _clear(self) -> None:
        self.number, self.known = Numbers(), 0
        self.rows = np.zeros((1024, len(self.model.languages)))

    def _learn(self) -> None:
        """Scores the words that were numbered since the last time."""
        new, need = list(islice(reversed(self.number), len(self.number) - self.known))[::-1], len(self.number)
        if need > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros((need, self.rows.shape[1]))])
        self.rows[self.known : need] = forward_all([MARK + w for w in new], self.vocabulary, self.longest, self.trie, self.model.p)
        self.known = need

    def score(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The likeliest language of each text and its posterior probability."""
        split = [t.lower().split() if t and self.model.languages and self.letter.search(t) else None for t in texts]
        if len(self.number) > TABLE:
            self._clear()
        numbers = [None if words is None else np.fromiter(map(self.number.__getitem__, words), np.int64, len(words)) for words in split]
        self._learn()
        out = []
        for words in numbers:
            if words is None:
                out.append((UNDETERMINED, 0.0))
                continue
            log = self.rows[words].sum(axis=0) + self.model.prior
            odds = np.exp(log - log.max())
            best = int(np.argmax(log))
            out.append((self.model.languages[best], float(odds[best] / odds.sum())))
        return out


def identify(df: DataFrame, model: Model, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """``df`` with the predicted language and score of each whole text; no other column is read for it."""
    names = [c for c in df.columns if c not in (lang_out, score_out)]
    schema = df.select(*names).schema.add(lang_out, "string").add(score_out, "double")
    shared, key = df.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache("langid")
        if cache.get("scorer", (None,))[0] != key:
            cache["scorer"] = key, Scorer(shared.value)
        scorer = cache["scorer"][1]
        for b in batches:
            step = max(1, int(b.num_rows * SLICE / max(b.column(text_col).nbytes, 1)))
            for i in range(0, b.num_rows, step):
                part = b.slice(i, step)
                langs, scores = zip(*scorer.score(part.column(text_col).to_pylist()))
                yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*names, lang_out, score_out])

    return df.select(*names).mapInArrow(run, schema)


def keep_known(documents: DataFrame, vocabulary: str, least: float = 0.5, **columns) -> DataFrame:
    """``documents`` without those that are ``und`` or whose language scores under ``least``."""
    lang, score = unused(documents.columns, "lang_pred"), unused(documents.columns, "score")
    found = identify(documents, train(documents, vocabulary, **columns), columns.get("text_col", "text"), lang, score)
    return found.filter((F.col(lang) != UNDETERMINED) & (F.col(score) >= least)).select(*documents.columns)


def report(documents: DataFrame, vocabulary: str) -> DataFrame:
    """The columns that query op9 returns."""
    found = identify(documents.select("doc_id", "text"), train(documents, vocabulary))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
