"""Fill-in-the-middle transformation, with both cuts found on a wavelet matrix over character classes.

A text is a row of units: runs of ASCII letters, and every other code point on
its own. Prefix and middle end after numbers of units drawn from the document
id, so the places of the ``k``-th unit are wanted without listing the units.

Every byte of a text has one of four classes: ``INNER`` (a code point's second
to fourth byte), ``OTHER`` (first byte of a code point that is no letter),
``FIRST`` (first letter of a run) and ``LATER`` (its other letters). A wavelet
matrix holds the classes as two bit vectors with a rank directory, so that the
number of bytes of any class before any place takes two rank queries on bits.
Ranks combine into counts: ``OTHER + FIRST`` are unit boundaries, all but
``INNER`` are code points. A cut after ``k`` units is the largest place with
at most ``k`` boundaries before it, found by bisection on those ranks. One
matrix serves a slice of about 2 MB of whole texts, and all cuts of the slice
are bisected together, in numpy.

The output is the text (``plain``) or its three parts, each behind its mark:
``<P>prefix<S>suffix<M>middle`` (``psm``) or ``<S>suffix<P>prefix<M>middle``
(``spm``). Texts that hold a mark themselves stay plain, so ``restore`` gets
the exact text back from output and form. No row depends on another: there is
no shuffle, and a task holds one slice (or one longer text) at a time.

A null text is empty, and empty texts are plain. A null id is drawn as the
empty string. Repeated rows and ties of cuts (an empty middle) are ordinary
rows. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsight.llm.common import flat, mapped, read, slices, texts

SEED = 1
#: Percent of drawable texts that are transformed, and percent of those that are suffix first.
RATE, SUFFIX_FIRST = 90, 20
#: The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
INNER, OTHER, FIRST, LATER = range(4)
LEVELS = 2


class Bits:
    """A bit vector with a rank directory: ones before each 64-bit word, the rest by a population count."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(packed) // 8 + 2, "<u8")  # one spare word: a rank may be asked at the end
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        self.before = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    def ones(self, place: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = place >> 6
        below = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """Ranks of the symbols 0 to 2**LEVELS - 1 in a sequence: one bit vector a level, sorted stably by the bit before."""

    def __init__(self, symbols: np.ndarray):
        self.levels: list[tuple[Bits, int]] = []
        for level in range(LEVELS - 1, -1, -1):
            bit = (symbols >> level & 1).astype(bool)
            zeros = len(bit) - int(np.count_nonzero(bit))
            self.levels.append((Bits(bit), zeros))
            if level:
                symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def rank(self, symbol: int, place: np.ndarray) -> np.ndarray:
        """How many of ``symbol`` stand before each place."""
        start, at = np.zeros(1, np.int64), place
        for level, (bits, zeros) in zip(range(LEVELS - 1, -1, -1), self.levels, strict=True):
            if symbol >> level & 1:
                start, at = zeros + bits.ones(start), zeros + bits.ones(at)
            else:
                start, at = start - bits.ones(start), at - bits.ones(at)
        return at - start


def classes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Class of every byte; a run of letters ends where a text (beginning at one of ``starts``) does."""
    letter = ((data | 32) - np.uint8(97)) < 26
    out = np.where((data & 0xC0) == 0x80, INNER, OTHER).astype(np.uint8)
    after = np.concatenate([np.zeros(1, bool), letter[:-1]])
    after[starts[starts < len(data)]] = False
    out[letter] = np.where(after[letter], LATER, FIRST)
    return out


class Units:
    """Units and code points of texts laid end to end in ``data``; text ``i`` spans ``off[i]`` to ``off[i + 1]``."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.off = off
        self.matrix = WaveletMatrix(classes(data, off[:-1]))
        self.first = self.boundaries(off[:-1])

    def boundaries(self, place: np.ndarray) -> np.ndarray:
        return self.matrix.rank(OTHER, place) + self.matrix.rank(FIRST, place)

    def chars(self, place: np.ndarray) -> np.ndarray:
        return place - self.matrix.rank(INNER, place)

    def counts(self) -> np.ndarray:
        return self.boundaries(self.off[1:]) - self.first

    def cut(self, k: np.ndarray) -> np.ndarray:
        """Place behind the first ``k[i]`` units of text ``i``."""
        low, high = self.off[:-1].copy(), self.off[1:].copy()
        while (low < high).any():
            mid = (low + high + 1) >> 1
            fits = self.boundaries(mid) - self.first <= k
            low, high = np.where(fits, mid, low), np.where(fits, high, mid - 1)
        return low


def _draws(ids: list, seed: int) -> np.ndarray:
    """The first four 32-bit numbers of each id's digest, [4, ids]."""
    raw = b"".join(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(raw, ">u4").reshape(-1, 4).astype(np.int64).T


def _transform(batches, seed: int, rate: int, suffix_first: int):
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = marks
    for whole in batches:
        for b in slices(whole):
            off, data = flat(b.column("text"))
            data, off = data[off[0] : off[-1]], off - off[0]
            units = Units(data, off)
            n = units.counts()
            h1, h2, h3, h4 = _draws(b.column("doc_id").to_pylist(), seed)
            one, two = h1 % (n + 1), h2 % (n + 1)
            lo, hi = units.cut(np.minimum(one, two)), units.cut(np.maximum(one, two))
            before, mid = units.chars(lo) - units.chars(off[:-1]), units.chars(hi) - units.chars(lo)
            raw = data.tobytes()
            form, output = [], []
            for i in range(len(n)):
                text = raw[off[i] : off[i + 1]]
                if not text or h3[i] % 100 >= rate or any(x in text for x in marks):
                    form.append("plain")
                    output.append(text)
                    continue
                start, middle, rest = raw[off[i] : lo[i]], raw[lo[i] : hi[i]], raw[hi[i] : off[i + 1]]
                if h4[i] % 100 < suffix_first:
                    form.append("spm")
                    output.append(b"".join((s, rest, p, start, m, middle)))
                else:
                    form.append("psm")
                    output.append(b"".join((p, start, s, rest, m, middle)))
            plain = np.array([f == "plain" for f in form])
            yield {
                "doc_id": b.column("doc_id"), "n": pa.array(n), "form": form,
                "prefix_chars": pa.array(before, mask=plain), "middle_chars": pa.array(mid, mask=plain),
                "output": pa.array(output, pa.binary()),
            }


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """``doc_id, n`` (units), ``form, prefix_chars, middle_chars, output`` of every row."""
    kind = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    return mapped(texts(docs), lambda it: _transform(it, seed, rate, suffix_first), kind)


def restore(output: F.Column, form: F.Column) -> F.Column:
    """The exact text of an output, from its form alone."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")  # no part holds a mark: '', then the three parts
    start, rest = F.when(form == "psm", part[1]).otherwise(part[2]), F.when(form == "psm", part[2]).otherwise(part[1])
    return F.when(form == "plain", output).otherwise(F.concat(start, part[3], rest))


def op11_wavelet_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(read(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


OP11_SQL = """
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS unit,
           sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
), drawn AS (
    SELECT *, len(unit) AS n, CAST('0x' || h[1:8] AS UBIGINT) % (len(unit) + 1) AS one,
           CAST('0x' || h[9:16] AS UBIGINT) % (len(unit) + 1) AS two,
           text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
               OR CAST('0x' || h[17:24] AS UBIGINT) % 100 >= 90 AS plain,
           CAST('0x' || h[25:32] AS UBIGINT) % 100 < 20 AS suffix_first
    FROM d
), parts AS (
    SELECT doc_id, n, text, plain, suffix_first, array_to_string(unit[:least(one, two)], '') AS prefix,
           array_to_string(unit[least(one, two) + 1:greatest(one, two)], '') AS middle,
           array_to_string(unit[greatest(one, two) + 1:], '') AS suffix
    FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, CASE WHEN plain THEN 'plain' WHEN suffix_first THEN 'spm' ELSE 'psm' END AS form,
       CASE WHEN NOT plain THEN length(prefix) END AS prefix_chars, CASE WHEN NOT plain THEN length(middle) END AS middle_chars,
       sha256(CASE WHEN plain THEN text
                   WHEN suffix_first THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                   ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
