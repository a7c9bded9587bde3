"""Byte-level BPE encoding and decoding by recursive DuckDB queries inside the tasks.

Encoding. A text is cut into words by a pattern; each word is encoded by
itself. A word that is a token is that token; any other starts as one row a
byte, (word, position, token). In one step of a recursive query the rows join
the merge table on (token, next token), each word's lowest merged rank is
found, and its leftmost pair of that rank becomes one token; the query ends
when no row of any word finds a merge. The merge table holds every way to write
a token as two others, as ranks decide and not a list of merges.

A step contracts a word's pairs of its lowest rank from the left, not
overlapping, up to and with the first whose new token makes a pair of a lower
rank with a neighbour: until then nothing could come before the next of them,
so the result is that of contracting only the leftmost, in fewer steps. Words
of over ``LONG`` bytes are first cut where no token's bytes span the place, so
that no merge can ever cross it; what is left of a long word is short, or
repeats a few tokens, which takes about as many steps as its tokens have ranks.

Decoding. (document, position, id) rows join the vocabulary, and an ordered
aggregation strings the tokens' bytes together.

DuckDB runs in the Python worker, in memory and with one thread: no file, port
or process of its own. A worker keeps the ids of ``CACHE`` words it has met;
a query works on ``ROWS`` rows at once (one longer unbroken run stays whole).
Nothing is shuffled, and nothing reaches the driver.

A null or empty text has no ids and decodes to no bytes. Null ids, repeated
rows and ties are ordinary rows. An empty table gives no rows. Extra columns
are ignored.
"""

from __future__ import annotations

import base64
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsight.llm.common import mapped, read, slices, texts

LONG = 48
CACHE = 1_000_000
ROWS = 1 << 18
#: Bytes of text taken at once: the more, the fewer queries.
SLICE = 8 << 20
#: Words of a text taken at once, and tokens strung together by one aggregate.
BLOCK_WORDS, BLOCK_TOKENS = 200_000, 1 << 16

ENCODE = """
WITH RECURSIVE state(pos, word, token, step) AS (
    SELECT pos, word, token, 0 FROM start
    UNION ALL
    (WITH pair AS ( -- positions are unique over all words; a pair is one only inside a word
        SELECT pos, word, token, step, lead(token) OVER w AS after, lead(pos) OVER w AS next_pos, lead(word) OVER w = word AS inside
        FROM state WHERE token >= 0 AND step >= 0 WINDOW w AS (ORDER BY pos)
    ), ranked AS MATERIALIZED (
        SELECT pos, word, token, step, next_pos, merged
        FROM pair LEFT JOIN merge ON left_token = token AND right_token = after AND inside
    ), least AS MATERIALIZED (
        SELECT word, min(merged) AS merged FROM ranked WHERE merged IS NOT NULL GROUP BY word
    ), hit AS MATERIALIZED (
        SELECT word, merged, pos, next_pos FROM ranked JOIN least USING (word, merged)
    ), several AS MATERIALIZED (
        SELECT word FROM hit GROUP BY word HAVING count(*) > 1
    ), around AS (
        SELECT pos, CASE WHEN lag(word) OVER w = word THEN lag(token) OVER w END AS before,
               CASE WHEN lead(word, 2) OVER w = word THEN lead(token, 2) OVER w END AS beyond,
               CASE WHEN lead(word, 2) OVER w = word THEN lead(pos, 2) OVER w END AS beyond_pos
        FROM ranked SEMI JOIN several USING (word) WINDOW w AS (ORDER BY pos)
    ), chain AS ( -- hits in a row overlap
        SELECT *, row_number() OVER w AS nth, lag(next_pos) OVER w IS NOT DISTINCT FROM pos AS chained
        FROM hit JOIN around USING (pos) WINDOW w AS (ORDER BY pos)
    ), apart AS ( -- every other one of a chain
        SELECT * FROM chain QUALIFY (nth - max(CASE WHEN NOT chained THEN nth END) OVER (ORDER BY pos)) % 2 = 0
    ), beside AS MATERIALIZED ( -- the token on the left is the new one if the hit before is next to this one
        SELECT word, pos, next_pos, merged, beyond, CASE WHEN lag(beyond_pos) OVER (ORDER BY pos) = pos THEN merged ELSE before END AS before
        FROM apart
    ), stop AS ( -- the first hit of a word whose new token makes a pair of a lower rank
        SELECT word, min(pos) AS last_pos FROM (
            SELECT word, pos FROM beside JOIN rash ON left_token = before AND right_token = beside.merged WHERE rash.merged < beside.merged
            UNION ALL
            SELECT word, pos FROM beside JOIN rash ON left_token = beside.merged AND right_token = beyond WHERE rash.merged < beside.merged
        ) GROUP BY word
    ), taken AS MATERIALIZED (
        SELECT pos, next_pos, merged FROM hit ANTI JOIN several USING (word)
        UNION ALL
        SELECT pos, next_pos, merged FROM beside LEFT JOIN stop USING (word) WHERE last_pos IS NULL OR pos <= last_pos
    ), edit AS (
        SELECT pos, merged AS token FROM taken UNION ALL SELECT next_pos, -1 FROM taken
    )
    SELECT pos, ranked.word, coalesce(edit.token, ranked.token), CASE WHEN least.word IS NULL THEN -1 ELSE step + 1 END
    FROM ranked LEFT JOIN least USING (word) LEFT JOIN edit USING (pos))
)
SELECT word, token FROM state WHERE step < 0 ORDER BY pos -- words that found no more merge
"""

DECODE = """
SELECT part, string_agg(piece, '' ORDER BY pos) AS bytes, count(*) - count(piece) AS unknown
FROM ids LEFT JOIN vocabulary USING (token) GROUP BY part ORDER BY part
"""


class Bpe:
    """Vocabulary and merge table of one rank file, and the words met so far."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        ranks = self.ranks
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError(f"{path} lacks single bytes")
        # `regex` counts the separators U+001C to U+001F as white space; the Unicode property does not.
        self.pattern = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        merges = [
            (ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks
        ]
        def columns(rows: list) -> dict:
            names = ("left_token", "right_token", "merged")
            return {c: pa.array([r[i] for r in rows], pa.int32()) for i, c in enumerate(names)}

        tables = {
            "merge": columns(merges),
            "rash": columns([m for m in merges if m[2] < max(m[:2])]),  # those that rank below a part of theirs
            "vocabulary": {"token": pa.array(ranks.values(), pa.int32()), "piece": [t.decode("latin-1") for t in ranks]},
        }
        self.db = duckdb.connect(config={"threads": 1, "temp_directory": ""})
        for name, given in tables.items():
            self.db.register("given", pa.table(given))
            self.db.execute(f"CREATE TABLE {name} AS FROM given")
            self.db.unregister("given")
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self._spans = None

    # ------------------------------------------------------------- encoding
    def _cut(self, word: bytes) -> list[bytes]:
        """``word`` in parts that no merge can join."""
        if len(word) <= LONG or word == word[:1] * len(word):
            return [word]
        if self._spans is None:
            import ahocorasick

            self._spans = ahocorasick.Automaton()
            for t in self.ranks:
                if len(t) > 1:
                    self._spans.add_word(t.decode("latin-1"), len(t))
            self._spans.make_automaton()
        first = np.arange(len(word))  # first byte of the longest token that ends at each byte
        for end, size in self._spans.iter(word.decode("latin-1")):
            if end + 1 - size < first[end]:
                first[end] = end + 1 - size
        reach = np.minimum.accumulate(first[::-1])[::-1]
        cuts = [0, *np.flatnonzero(reach[1:] > np.arange(len(word) - 1)).tolist()]
        cuts = [0, *(c + 1 for c in cuts[1:]), len(word)]
        return [word[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _query(self, parts: list[bytes]) -> list[bytes]:
        """Ids (little-endian, 32 bits) of each part."""
        n = np.array([len(p) for p in parts], np.int64)
        data = np.frombuffer(b"".join(parts), np.uint8)
        start = pa.table({
            "word": np.repeat(np.arange(len(parts), dtype=np.int32), n),
            "pos": np.arange(len(data), dtype=np.int32), "token": self.of_byte[data],
        })
        self.db.register("start", start)
        out = self.db.execute(ENCODE).fetchnumpy()
        self.db.unregister("start")
        ids = out["token"].astype("<u4")
        at = np.searchsorted(out["word"], np.arange(len(parts) + 1))
        return [ids[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)]

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        cut = {w: self._cut(w) for w in words if len(w) > LONG}
        ids: dict[bytes, bytes] = {}
        some, size = [], 0
        for p in (*(w for w in words if len(w) <= LONG), *{p for parts in cut.values() for p in parts}):
            some.append(p)
            size += len(p)
            if size >= ROWS:
                ids.update(zip(some, self._query(some), strict=True))
                some, size = [], 0
        if some:
            ids.update(zip(some, self._query(some), strict=True))
        return [b"".join(ids[p] for p in cut[w]) if w in cut else ids[w] for w in words]

    def encode(self, texts_: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts_]
        held: list[tuple[int, list[str]]] = []
        count = 0

        def flush():
            met = set().union(*(ws for _, ws in held))
            if len(self.known) + len(met) > CACHE // 2:  # words not met since the last time are forgotten
                self.before, self.known = self.known, {}
            known, before = self.known, self.before
            fresh = met.difference(known)
            known.update((w, before[w]) for w in fresh.intersection(before))
            raw = {w: w.encode() for w in fresh.difference(before)}
            known.update((w, self.ranks[r].to_bytes(4, "little")) for w, r in raw.items() if r in self.ranks)
            new = [w for w, r in raw.items() if r not in self.ranks]
            known.update(zip(new, self._encode_words([raw[w] for w in new]), strict=True))
            for i, ws in held:
                out[i].append(b"".join(map(known.__getitem__, ws)))
            for w in new:
                if len(w) > LONG:
                    del known[w]
            held.clear()

        for i, t in enumerate(texts_):
            for ws in self._words(t):
                held.append((i, ws))
                count += len(ws)
                if count >= BLOCK_WORDS:
                    flush()
                    count = 0
        flush()
        return [b"".join(x) for x in out]

    def _words(self, text: str):
        if len(text) <= BLOCK_WORDS:
            yield self.pattern.findall(text)
            return
        found = self.pattern.finditer(text)
        while some := [m.group() for m in islice(found, BLOCK_WORDS)]:
            yield some

    # ------------------------------------------------------------- decoding
    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes that each row of ids stands for."""
        out: list[list[bytes]] = [[] for _ in ids]
        step = BLOCK_TOKENS * 4
        parts = [(i, x[at : at + step]) for i, x in enumerate(ids) for at in range(0, len(x), step)]
        some: list[tuple[int, bytes]] = []
        size = 0
        for k, p in enumerate(parts):
            some.append(p)
            size += len(p[1]) // 4
            if size >= ROWS or k == len(parts) - 1:
                for (i, _), raw in zip(some, self._strings([x for _, x in some]), strict=True):
                    out[i].append(raw)
                some, size = [], 0
        return [b"".join(x) for x in out]

    def _strings(self, parts: list[bytes]) -> list[bytes]:
        n = np.array([len(p) // 4 for p in parts], np.int64)
        token = np.frombuffer(b"".join(parts), "<u4").astype(np.int64)
        self.db.register("ids", pa.table({
            "part": np.repeat(np.arange(len(parts), dtype=np.int32), n), "pos": np.arange(len(token), dtype=np.int32), "token": token,
        }))
        rows = self.db.execute(DECODE).fetchall()
        self.db.unregister("ids")
        if any(unknown for *_, unknown in rows):
            raise ValueError("an id that the vocabulary does not hold")
        return [x.encode("latin-1") for _, x, _ in rows]  # a character a byte


_BPE: dict[tuple[str, str], Bpe] = {}


def _model(path: str, pattern: str) -> Bpe:
    if (path, pattern) not in _BPE:
        _BPE[path, pattern] = Bpe(path, pattern)
    return _BPE[path, pattern]


def _encode(batches, path: str, pattern: str, decoded: bool):
    for whole in batches:
        for b in slices(whole, limit=SLICE):
            ids = _model(path, pattern).encode(b.column("text").to_pylist())
            out = {"doc_id": b.column("doc_id"), "n_tokens": [len(x) // 4 for x in ids], "ids": pa.array(ids, pa.binary())}
            if decoded:
                out["decoded"] = pa.array(_model(path, pattern).decode(ids), pa.binary())
            yield out


def _decode(batches, path: str, pattern: str):
    for whole in batches:
        for b in slices(whole, "ids", SLICE):
            yield {"doc_id": b.column("doc_id"), "decoded": pa.array(_model(path, pattern).decode(b.column("ids").to_pylist()), pa.binary())}


def _files(path: str | None, pattern: str | None) -> tuple[str, str]:
    if path and pattern:
        return path, pattern
    import public_tokenizers

    return path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pattern or public_tokenizers.PATTERN


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, decoded: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row (ids little-endian, 32 bits each); ``decoded`` also decodes them again."""
    path, pattern = _files(path, pattern)
    kind = "doc_id long, n_tokens long, ids binary" + ", decoded binary" * decoded
    return mapped(texts(docs), lambda it: _encode(it, path, pattern, decoded), kind)


def decode(rows: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``doc_id, decoded`` (bytes) of every row of ``doc_id, ids``; null ids are none."""
    path, pattern = _files(path, pattern)
    own = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("ids", F.lit(b"")).alias("ids"))
    return mapped(own, lambda it: _decode(it, path, pattern), "doc_id long, decoded binary")


def op13_duckdb_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(read(spark, sf_dir, "documents"), decoded=True).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
