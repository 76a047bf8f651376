"""Byte-level BPE encoding and decoding with DuckDB inside the tasks (operator 11).

A task keeps an in-process DuckDB with the merge table.  The words of a slice
of texts (matches of the split pattern; each distinct one once) become rows
(word, position, token).  A recursive query joins neighbouring tokens with the
merge table and contracts, in every word, the pair of least rank, leftmost
first, until no pair of any word can merge.  Ids are decoded by joining them
with the vocabulary and aggregating the tokens in order.

Contracting one pair a round takes as many rounds as a word has tokens, so for
long words a round does more where the result is the same:

* no token of the vocabulary spans two neighbours without a row in the merge
  table, so a word falls apart there and its parts go on independently;
* all places of the least pair are contracted, leftmost first and without
  overlap, up to the first whose product makes a pair of lower rank.
"""

from __future__ import annotations

import base64
import re
import sys
from dataclasses import dataclass

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm.common import broadcast, kept, slices, table

#: Words encoded by one query, words a worker remembers, bytes of words it remembers.
WORDS, REMEMBERED, REMEMBERED_BYTES = 50_000, 400_000, 48 << 20
#: Ids decoded by one query.
IDS = 1 << 20


# -- vocabulary

@dataclass(frozen=True)
class Vocabulary:
    """Tokens by id, and the merge table.

    ``a, b, merged``: neighbours that some token spans; ``merged`` is the
    token they form, -1 if they only lie inside a longer one.  A token's rank
    is its id.  ``split`` are the patterns: exact, and the one for texts
    without any of the characters that the library's tables do not know.
    """

    tokens: list
    a: np.ndarray
    b: np.ndarray
    merged: np.ndarray
    split: str
    unknown: str


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


def neighbours(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of tokens whose bytes, side by side, lie within some token."""
    inside = {t[i:j] for t in ranks for i in range(len(t)) for j in range(i + 2, len(t) + 1)}
    rows = [(ranks[s[:i]], ranks[s[i:]], ranks.get(s, -1)) for s in inside for i in range(1, len(s))
            if s[:i] in ranks and s[i:] in ranks]
    a, b, merged = np.array(sorted(rows), dtype=np.int32).reshape(-1, 3).T
    return a, b, merged


def younger_characters() -> str:
    """Letters and numbers of a newer Unicode than the BPE library's, as ranges of a character class.

    The library's own matcher says which they are.
    """
    import tiktoken

    byte_ranks = {bytes([i]): i for i in range(256)}
    out = []
    for name in ("L", "N"):
        library = tiktoken.Encoding(name, pat_str=rf"\p{{{name}}}", mergeable_ranks=byte_ranks, special_tokens={})
        mine = regex.compile(rf"\p{{{name}}}")
        points = (c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000 and mine.match(chr(c)))
        out += [c for c in points if not library.encode_ordinary(chr(c))]
    points = np.array(sorted(out), dtype=np.int64)
    cut = np.flatnonzero(np.diff(points, prepend=-2) != 1)
    ends = np.append(cut[1:], len(points)) - 1
    return "".join(f"\\U{points[i]:08X}-\\U{points[j]:08X}" for i, j in zip(cut, ends))


def vocabulary(path: str, pattern: str) -> Vocabulary:
    """The vocabulary file at ``path`` with the split ``pattern``; read on the driver."""
    ranks = read_ranks(path)
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks are not 0 to n - 1")
    tokens = [b""] * len(ranks)
    for t, r in ranks.items():
        tokens[r] = t
    return Vocabulary(tokens, *neighbours(ranks), pattern, younger_characters())


class Splitter:
    """Matches of the pattern as the BPE library finds them.

    Characters that are letters or numbers only since a newer Unicode version
    are neither there; in a text that holds one, an unassigned character
    stands for each while the text is matched.  All of them lie beyond Latin-1.
    """

    def __init__(self, pattern: str, unknown: str):
        self.pattern = regex.compile(pattern)
        self.unknown = re.compile(f"[{unknown}]") if unknown else None

    def plain(self, text: str) -> bool:
        """Whether the text holds none of these characters."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return not self.unknown or not self.unknown.search(text)
        return True

    def words(self, text: str):
        """Lists of matches, in order; of a long text in several lists."""
        plain = self.plain(text)
        if plain and len(text) <= 1 << 20:
            yield self.pattern.findall(text)
            return
        like, out = text if plain else self.unknown.sub("\U000EFFFF", text), []
        for m in self.pattern.finditer(like):
            out.append(text[m.start():m.end()])
            if len(out) >= WORDS:
                yield out
                out = []
        yield out


# -- the task's database

#: Bytes of a short word, whose pairs are contracted one a round, and of those of one query; place = word * 4096 + position.
SHORT, SHORT_BYTES = 32, 1 << 18
ENCODE_SHORT = """
WITH RECURSIVE state(place, token, live) AS (
    SELECT place, token, true FROM bytes
    UNION ALL (
    WITH followed AS (
        SELECT place, token, lead(token) OVER w AS after, lead(place) OVER w AS next FROM state WHERE live WINDOW w AS (ORDER BY place)),
    paired AS (
        SELECT place, token, next, merged * 4096::BIGINT + (place & 4095) AS pair
        FROM followed LEFT JOIN pairs ON ab = token * 1048576::BIGINT + after AND next >> 12 = place >> 12),
    best AS (
        SELECT place >> 12 AS word, min(pair) AS pair, arg_min(next, pair) AS eaten FROM paired GROUP BY 1)
    SELECT p.place, CASE WHEN p.place & 4095 = b.pair & 4095 THEN (b.pair >> 12)::INTEGER ELSE p.token END, b.pair IS NOT NULL
    FROM paired p JOIN best b ON p.place >> 12 = b.word
    WHERE b.eaten IS NULL OR p.place <> b.eaten)
)
SELECT place >> 12 AS word, list(token ORDER BY place) AS ids FROM state WHERE NOT live GROUP BY 1 ORDER BY 1
"""

#: Long words: parts and several places a round.  In either query ``state`` holds the rows of all rounds, and the last of a
#: word (of a part) are not live.  This one stops after some rounds, so that few rows are held, and is asked again.
LONG_BYTES, HELD = 1 << 20, 2_000_000
ENCODE_LONG = """
WITH RECURSIVE state(word, part, pos, token, live, round) AS (
    SELECT word, part::HUGEINT, pos, token, true, 0 FROM bytes
    UNION ALL (
    WITH followed AS (
        SELECT word, pos, token, round, lead(token) OVER (PARTITION BY word, part ORDER BY pos) AS after
        FROM state WHERE live AND round < $rounds),
    paired AS (
        SELECT word, pos, token, round, merged,
            sum(CASE WHEN m.a IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY word ORDER BY pos DESC) AS part
        FROM followed LEFT JOIN merges m ON m.a = token AND m.b = after),
    least_rank AS (
        SELECT *, min(CASE WHEN merged >= 0 THEN merged END) OVER (PARTITION BY word, part) AS low FROM paired),
    hits AS (
        SELECT *, coalesce(merged = low, false) AS hit,
            sum(CASE WHEN merged = low THEN 0 ELSE 1 END) OVER (PARTITION BY word, part ORDER BY pos) AS run
        FROM least_rank),
    places AS (
        SELECT *, hit AND row_number() OVER (PARTITION BY word, part, run, hit ORDER BY pos) % 2 = 1 AS place FROM hits),
    sides AS (
        SELECT *, CASE WHEN lag(place, 2) OVER w THEN low ELSE lag(token) OVER w END AS before, lead(token, 2) OVER w AS after
        FROM places WINDOW w AS (PARTITION BY word, part ORDER BY pos)),
    lowering AS (
        SELECT s.*, place AND (l.a IS NOT NULL OR r.a IS NOT NULL) AS lowers
        FROM sides s
        LEFT JOIN lower_ranks l ON l.a = s.before AND l.b = s.low AND l.merged < s.low
        LEFT JOIN lower_ranks r ON r.a = s.low AND r.b = s.after AND r.merged < s.low),
    taken AS (
        SELECT *, place AND coalesce(sum(CASE WHEN lowers THEN 1 ELSE 0 END) OVER (
            PARTITION BY word, part ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 AS take
        FROM lowering),
    contracted AS (
        SELECT *, coalesce(lag(take) OVER (PARTITION BY word, part ORDER BY pos), false) AS eaten FROM taken)
    SELECT word, part, pos, CASE WHEN take THEN low ELSE token END, low IS NOT NULL, round + 1
    FROM contracted WHERE NOT eaten)
)
SELECT word, part::BIGINT AS part, pos, token, live FROM state WHERE NOT live OR round = $rounds
"""

DECODE = """
SELECT text, string_agg(bytes, '' ORDER BY pos) AS bytes FROM ids JOIN vocabulary USING (id) GROUP BY text ORDER BY text
"""


def by_size(items: list, size, most: int):
    """Consecutive groups whose sizes sum up to at most ``most``; a larger item stands alone."""
    group, held = [], 0
    for i in items:
        if group and held + size(i) > most:
            yield group
            group, held = [], 0
        group.append(i)
        held += size(i)
    if group:
        yield group


class Engine:
    """DuckDB over one vocabulary, in one worker; words met before are remembered up to a bound."""

    def __init__(self, v: Vocabulary):
        self.splitter = Splitter(v.split, v.unknown)
        self.tokens = v.tokens
        self.rank = {t: i for i, t in enumerate(v.tokens)}
        self.byte = np.array([self.rank[bytes([i])] for i in range(256)], dtype=np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
        merges = pa.table({"a": v.a, "b": v.b, "merged": v.merged})
        low = (v.merged >= 0) & (v.merged < np.maximum(v.a, v.b))
        formed = merges.filter(pa.array(v.merged >= 0))
        self._table("merges", merges)
        self._table("pairs", pa.table({"ab": v.a[v.merged >= 0] * np.int64(1 << 20) + v.b[v.merged >= 0], "merged": formed.column("merged")}))
        self._table("lower_ranks", merges.filter(pa.array(low)))
        self._table("vocabulary", pa.table({"id": pa.array(np.arange(len(v.tokens), dtype=np.int32)),
                                            "bytes": [t.decode("latin-1") for t in v.tokens]}))
        self.forget()

    def _table(self, name: str, data: pa.Table) -> None:
        self.db.register("incoming", data)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM incoming")
        self.db.unregister("incoming")

    def forget(self) -> None:
        self.known: dict[str, bytes] = {}
        self.size = 0

    def learn(self, words: list[str]) -> None:
        """Encode the words not known yet; their packed ids are then in ``known``."""
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        raw = [w.encode() for w in new]
        whole = [self.rank.get(b) for b in raw]
        ids = [None if r is None else np.array([r], "<u4").tobytes() for r in whole]
        for long, contract, most in ((False, self._contract_short, SHORT_BYTES), (True, self._contract_long, LONG_BYTES)):
            left = [i for i, r in enumerate(whole) if r is None and (len(raw[i]) > SHORT) == long]
            for group in by_size(left, lambda i: len(raw[i]), most):
                for i, x in zip(group, contract([raw[i] for i in group])):
                    ids[i] = x
        self.known.update(zip(new, ids))
        self.size += sum(map(len, raw)) + sum(map(len, ids))

    def _rows(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, position, token) of every byte."""
        sizes = np.array([len(r) for r in raw])
        return (np.repeat(np.arange(len(raw)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes),
                self.byte[np.frombuffer(b"".join(raw), np.uint8)])

    def _ask(self, query: str, name: str, rows: dict, **params) -> pa.Table:
        self.db.register(name, pa.table(rows))
        try:
            return self.db.sql(query, params=params or None).to_arrow_table()
        finally:
            self.db.unregister(name)

    def _contract_short(self, raw: list[bytes]) -> list[bytes]:
        word, pos, token = self._rows(raw)
        out = self._ask(ENCODE_SHORT, "bytes", {"place": word * 4096 + pos, "token": token}).column("ids").combine_chunks()
        cut, flat = out.offsets.to_numpy(), out.values.to_numpy().astype("<u4")
        return [flat[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]

    def _contract_long(self, raw: list[bytes]) -> list[bytes]:
        word, pos, token = self._rows(raw)
        rows, done = pa.table({"word": word, "part": np.zeros(len(word), np.int64), "pos": pos, "token": token}), []
        while rows.num_rows:
            out = self._ask(ENCODE_LONG, "bytes", rows, rounds=max(1, HELD // rows.num_rows))
            live = out.column("live").to_numpy()
            done.append(np.stack([out.column(c).to_numpy()[~live] for c in ("word", "pos", "token")]))
            rows = out.filter(pa.array(live)).drop_columns(["live"])
        word, pos, token = np.concatenate(done, axis=1)
        order = np.lexsort((pos, word))
        cut = np.searchsorted(word[order], np.arange(len(raw) + 1))
        flat = token[order].astype("<u4")
        return [flat[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids (little-endian, 32 bits) of every text."""
        out = [bytearray() for _ in texts]
        pending: list[tuple[int, list[str]]] = []
        held = 0

        def settle():
            nonlocal pending, held
            if len(self.known) > REMEMBERED or self.size > REMEMBERED_BYTES:
                self.forget()
            self.learn([w for _, words in pending for w in words])
            for i, words in pending:
                out[i] += b"".join([self.known[w] for w in words])
            pending, held = [], 0

        for i, text in enumerate(texts):
            for words in self.splitter.words(text):
                pending.append((i, words))
                held += len(words)
                if held >= WORDS:
                    settle()
        settle()
        return [bytes(b) for b in out]

    def decode(self, packed: list[bytes]) -> list[bytes]:
        """Bytes of every text of packed ids."""
        parts: list[list[bytes]] = [[] for _ in packed]
        texts, ids, held = [], [], 0

        def settle():
            nonlocal texts, ids, held
            if held:
                sizes = [len(x) for x in ids]
                out = self._ask(DECODE, "ids", {"text": np.repeat(np.arange(len(ids)), sizes), "pos": np.arange(held),
                                                "id": np.concatenate(ids).astype(np.int32)})
                for k, b in zip(out.column("text").to_pylist(), out.column("bytes").to_pylist()):
                    parts[texts[k]].append(b.encode("latin-1"))
            texts, ids, held = [], [], 0

        for i, p in enumerate(packed):
            a = np.frombuffer(p, "<u4")
            for s in range(0, len(a), IDS):
                texts.append(i)
                ids.append(a[s:s + IDS])
                held += len(ids[-1])
                if held >= IDS:
                    settle()
        settle()
        return [b"".join(p) for p in parts]


# -- operators

class ByteBpe:
    """Encoding and decoding of columns with one vocabulary file (its path is on the driver)."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        self.shared = broadcast(spark, vocabulary(path, pattern))

    def encode(self, df: DataFrame, key: str, text: str = "text", ids: str = "ids") -> DataFrame:
        """(key, ids) of every row: ids as packed little-endian 32-bit integers; null has none (empty)."""
        shared = self.shared

        def run(batches):
            engine = kept(shared, Engine)
            for b in slices(batches):
                packed = engine.encode([t or "" for t in b.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(packed, pa.binary())], names=[key, ids])

        return df.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, `{ids}` binary")

    def decode(self, df: DataFrame, key: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
        """(key, ids, to) of every row of packed ids; ``to`` holds the bytes, which need not be whole UTF-8."""
        shared = self.shared

        def run(batches):
            engine = kept(shared, Engine)
            for b in slices(batches):
                raw = engine.decode([p or b"" for p in b.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(raw, pa.binary())], names=[key, ids, to])

        kind = df.schema[key].dataType.simpleString()
        return df.select(F.col(key), F.col(ids)).mapInArrow(run, f"`{key}` {kind}, `{ids}` binary, `{to}` binary")


def op11(spark: SparkSession, sf_dir: str, file: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    """Ids of every text of ``documents`` and the bytes decoded from them, as digests."""
    import public_tokenizers

    bpe = ByteBpe(spark, public_tokenizers.path(file), public_tokenizers.PATTERN)
    both = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), "doc_id"), "doc_id")
    return both.select("doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
