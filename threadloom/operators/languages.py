"""Language label and gate with a detector that can be exchanged.

The built-in detector counts the words of short lists per language, natively;
any function from a text column to a language column can take its place.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadloom.functions import text as T

MIN_CHARS = 20
#: Frequent short words of each language; of equal counts the language that is listed first wins.
MARKERS = {
    "russian": "и в не на что это как так но он она они мы вы для если уже очень только все",
    "ukrainian": "і та що це як але він вона вони ми ви для якщо вже дуже тільки всі є бути може",
    "bulgarian": "и в не на че това как но той тя те ние вие за ако вече много само всички са",
    "belarusian": "і ў не на што гэта як але ён яна яны мы вы для калі ўжо вельмі толькі усе ёсць",
    "serbian": "и у не на што то како али он она они ми ви за ако већ врло само сви је",
    "kazakh": "және мен бұл бір ол үшін бар жоқ деп емес болып туралы қалай осы сол біз сіз олар өте тек",
    "english": "the and of to in is that it was for on are with as at be this have from not",
    "german": "der die und das ist nicht ein eine zu den von mit sich auf für als auch dem des wir",
    "french": "le la les et des est une un que pas pour dans qui sur au avec ce il vous nous",
    "spanish": "el la los las y de que en un una por con para no es se lo del como su",
    "turkish": "ve bir bu için de da ile çok ama gibi daha ne ben sen biz siz var yok değil olan",
    "polish": "i w nie na że to jak ale on ona oni my wy dla jeśli już bardzo tylko są się",
}


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of ``value``, which is computed once however often ``then`` names it. No Python function may stand in ``then``."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def by_markers(text: Column) -> Column:
    """The language most of whose words stand in the text; null if none does. The text is split once, and languages count only what is in any list."""
    lists = [m.split(" ") for m in MARKERS.values()]
    words = F.filter(T.tokens(F.lower(text)), lambda w: w.isin(sorted(set(chain(*lists)))))
    hits = lambda w, known: F.size(F.filter(w, lambda x: x.isin(known)))
    # of several languages the largest number wins, and of equal ones the first place
    counts = lambda w: F.array(*[F.struct(hits(w, known).alias("n"), F.lit(-i).alias("i")) for i, known in enumerate(lists)])
    name = lambda best: F.when(best["n"] > 0, F.get(F.array(*map(F.lit, MARKERS)), -best["i"]))
    return _let(words, lambda w: _let(F.array_max(counts(w)), name))


def label(text: Column, detector: Callable[[Column], Column] = by_markers, min_chars: int = MIN_CHARS) -> Column:
    """unknown_short, a language, or unknown; null is an empty text."""
    stripped = T.strip(F.coalesce(text, F.lit("")))
    return F.when(F.char_length(stripped) < min_chars, "unknown_short").otherwise(F.coalesce(detector(stripped), F.lit("unknown")))


def probably(language: str, *parts: Column, detector: Callable[[Column], Column] = by_markers, min_chars: int = MIN_CHARS) -> Column:
    """Whether the parts, stripped and joined, are in the language; texts too short to tell pass."""
    stripped = F.filter(F.array(*[T.strip(p) for p in parts]), lambda p: p != "")  # so joined, nothing is left to strip
    joined = F.concat_ws(" ", stripped)
    return (F.char_length(joined) < min_chars) | F.coalesce(detector(joined) == language, F.lit(False))
