"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are compared as runs of lower-cased letters and digits with
one blank between (``normal``), so case, punctuation and line breaks do not
hide a leak. An item of ``m`` characters may occur with up to
``k = floor(rate * m)`` edits. Cut into ``k + 1`` pieces, at least one piece
must occur unchanged (pigeonhole), so:

1. an Aho-Corasick automaton finds every exact piece hit in every whole text;
2. a hit says where the item would begin; hits of one item whose beginnings
   lie within ``k`` of each other are one window;
3. Myers' bit-parallel algorithm gives the smallest edit distance between the
   item and any part of the window; at most ``k`` is a match.

Step 1 finds every window an occurrence can have, so the result is complete:
exactly the (document, item) pairs with an occurrence within the budget.

Items are the query set and go to every task. They are sent in blocks of at
most ``block_chars`` characters; a larger benchmark takes one pass over the
documents per block, so what is broadcast is bounded. Every item with a normal
character is searched. One of fewer than ``SHORT`` characters that has no
budget (fewer than 20 at 5 %) counts only as whole words: neither end inside a
run of letters and digits, but for scripts written without blanks, where a word
may end at any character. Null texts and null items match nothing, as do empty
ones.
Equal items each match. Null ids and repeated rows are kept; an empty table on
either side gives no rows. Extra columns are ignored by ``find_leaks``
and passed through by ``drop_leaks``.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsight.llm.common import mapped, read, texts, workers_find_package

_GAP = re.compile(r"[\W_]+")
#: Items shorter than this that allow no edit are asked for as whole words.
SHORT = 40
#: Scripts written without blanks: Thai, Lao, Burmese, Khmer, Han, kana.
_NO_BLANKS = re.compile(
    "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u2fdf\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
    "\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]"
)
FOUND = "doc_id long, text_key long, item_id long, distance int, budget int, begin long, end long"


def normal(text: str) -> str:
    return _GAP.sub(" ", text.lower()).strip()


def between_words(text: str, at: int) -> bool:
    """Whether a word may begin or end before character ``at`` of a normal text."""
    if at in (0, len(text)) or " " in (pair := text[at - 1 : at + 1]):
        return True
    return _NO_BLANKS.search(pair) is not None


def pieces_of(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` pieces of nearly equal length, with their places."""
    n, m = budget + 1, len(item)
    cuts = [m * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def myers(pattern: str, text: str) -> tuple[int, int]:
    """(smallest distance between ``pattern`` and a part of ``text``, end of the first such part)."""
    m = len(pattern)
    at: dict[str, int] = {}
    for i, c in enumerate(pattern):
        at[c] = at.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best, end = full, 0, m, m, 0
    for j, c in enumerate(text, 1):
        eq = at.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(xh | plus) & full
        down = plus & xh
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = up << 1 & full  # a match may begin anywhere: the row above is all zeros
        plus = (down << 1 & full) | ~(xv | up) & full
        minus = up & xv
        if score < best:
            best, end = score, j
    return best, end


class Matcher:
    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items = [(i, t, int(rate * len(t))) for i, t in items]
        self.whole_words = [len(t) < SHORT and not k for _, t, k in self.items]
        places: dict[str, list[tuple[int, int]]] = {}
        for n, (_, t, k) in enumerate(self.items):
            for at, piece in pieces_of(t, k):
                places.setdefault(piece, []).append((n, at))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def find(self, text: str):
        """(item number, distance, budget, begin, end) of the best occurrence of each item in a normal text."""
        begins: dict[int, set[int]] = {}
        for last, (size, where) in self.automaton.iter(text):
            for n, at in where:
                begin = last + 1 - size - at
                if not self.whole_words[n]:
                    begins.setdefault(n, set()).add(begin)
                elif n not in begins and between_words(text, begin) and between_words(text, last + 1):
                    begins[n] = {begin}
        for n, some in begins.items():
            item_id, pattern, k = self.items[n]
            if self.whole_words[n]:
                yield item_id, 0, 0, min(some), min(some) + len(pattern)
                continue
            best = None
            for low, high in _merged(sorted(some), k):
                start = max(0, low - k)
                window = text[start : high + len(pattern) + k]
                if len(window) < len(pattern) - k:
                    continue
                d, end = myers(pattern, window)
                if d <= k and (best is None or d < best[0]):
                    back, length = myers(pattern[::-1], window[:end][::-1])
                    best = (d, start + end - length, start + end)
                if best and best[0] == 0:
                    break
            if best:
                yield item_id, best[0], k, best[1], best[2]


def _merged(begins: list[int], k: int):
    low = high = begins[0]
    for b in begins[1:]:
        if b - high > k:
            yield low, high
            low = b
        high = b
    yield low, high


def _find(batches, sent, rate: float):
    matcher = Matcher(sent.value, rate)
    for b in batches:
        out: dict[str, list] = {k.split()[0]: [] for k in FOUND.split(", ")}
        for d, key, t in zip(b.column("doc_id").to_pylist(), b.column("text_key").to_pylist(), b.column("text").to_pylist(), strict=True):
            for item, dist, k, begin, end in matcher.find(normal(t)):
                for name, v in zip(out, (d, key, item, dist, k, begin, end), strict=True):
                    out[name].append(v)
        yield out


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, rate: float = 0.05, block_chars: int = 2_000_000
) -> DataFrame:
    """One row per (document, item) match: ``FOUND``; ``begin`` and ``end`` count characters of the normal text."""
    spark = docs.sparkSession
    own = texts(docs, F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
    out = spark.createDataFrame([], FOUND)
    for block in _blocks(benchmark, block_chars):
        sent = spark.sparkContext.broadcast(block)
        out = out.unionAll(mapped(own, lambda it, sent=sent: _find(it, sent, rate), FOUND))
    return out


def _blocks(benchmark: DataFrame, block_chars: int):
    """Items of normal text in blocks of at most ``block_chars`` characters (one longer item is a block)."""
    some, size = [], 0
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null")
    for item_id, text in items.toLocalIterator():
        t = normal(text)
        if not t:
            continue
        if some and size + len(t) > block_chars:
            yield some
            some, size = [], 0
        some.append((item_id, t))
        size += len(t)
    if some:
        yield some


_MATCHERS: dict[str, Matcher] = {}


class _Block:
    """A broadcast block of items with a name of its own, for the workers' cache."""

    def __init__(self, spark: SparkSession, items: list[tuple[int, str]]):
        self.id, self._sent = uuid.uuid4().hex, spark.sparkContext.broadcast(items)

    @property
    def value(self):
        return self._sent.value


def _leaks(sent, rate: float):
    def has_leak(text):
        if sent.id not in _MATCHERS:  # one automaton per worker and block
            _MATCHERS[sent.id] = Matcher(sent.value, rate)
        return text is not None and next(_MATCHERS[sent.id].find(normal(text)), None) is not None

    return has_leak


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, rate: float = 0.05, block_chars: int = 2_000_000
) -> DataFrame:
    """The rows of ``docs`` in which ``find_leaks`` finds no item: a filter per block, no shuffle."""
    workers_find_package(docs.sparkSession)
    for block in _blocks(benchmark, block_chars):
        sent = _Block(docs.sparkSession, block)
        docs = docs.where(~F.udf(_leaks(sent, rate), "boolean", useArrow=True)("text"))
    return docs


def op8_edit_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("text_key")
