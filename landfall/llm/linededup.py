"""Line dedup (operator 8).

Distinct line keys are counted over all documents; the frequent ones are laid
out in shards, each a minimal perfect hash over its keys with an array of
fingerprints and one of keepers.  The documents' distinct line keys travel to
the shards and are probed there; the hits travel to the documents' pieces.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import mix64, signed, slices, table, written

MIN_CHARS, MIN_DOCS = 40, 5
#: Keys of one shard (some 40 bytes each in use), and frequent keys of one piece of the documents (24 bytes each).
SHARD_KEYS, PIECE_KEYS = 1 << 16, 1 << 16
#: Stands for a null doc_id: smaller than any other.
NO_ID = -(1 << 63)
BLANK = " \t\n\x0b\x0c\r"


def line_keys(text: str | None, min_chars: int = MIN_CHARS) -> list[tuple[int, int] | None]:
    """For each line its 128-bit key in two halves, or None for a short one."""
    out = []
    for line in (text or "").split("\n"):
        line = line.strip(BLANK)
        if len(line) < min_chars:
            out.append(None)
            continue
        h = xxhash.xxh3_128_intdigest(line.encode("utf-8", "replace").lower())  # bytes: only A-Z change
        out.append((h >> 64, h & 0xFFFFFFFFFFFFFFFF))
    return out


class PerfectHash:
    """Minimal perfect hash of distinct uint64 keys.

    Each level hashes the keys left into twice as many bits and keeps those
    that fall alone; a key's index is the rank of its bit over all levels.
    With a second half ``other`` every other level hashes that, so keys that
    are equal in one half part by the other.
    """

    def __init__(self, keys: np.ndarray, other: np.ndarray | None = None, gamma: float = 2.0):
        self.levels, base = [], 0
        left = [x.astype(np.uint64) for x in (keys, keys if other is None else other)]
        while len(left[0]) and len(self.levels) < 64:  # equal keys would never part
            bits = max(64, int(gamma * len(left[0])))
            at = self._at(left[len(self.levels) % 2], len(self.levels), bits)
            alone = np.bincount(at, minlength=bits) == 1
            self.levels.append((alone, base + np.cumsum(alone, dtype=np.int32) - 1))
            base += int(alone.sum())
            left = [x[~alone[at]] for x in left]
        self.size = base

    @staticmethod
    def _at(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
        step = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        return (mix64(keys + step) % np.uint64(bits)).astype(np.int64)

    def index(self, keys: np.ndarray, other: np.ndarray | None = None) -> np.ndarray:
        """Index of each key; some index or -1 for a key that is not a member."""
        halves = keys, keys if other is None else other
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (alone, rank) in enumerate(self.levels):
            at = self._at(halves[level % 2][open_], level, len(alone))
            got = alone[at]
            out[open_[got]] = rank[at[got]]
            open_ = open_[~got]
        return out


class Shard:
    """Perfect hash plus arrays: fingerprint (the key's other half), documents, keeper."""

    def __init__(self, hi: np.ndarray, lo: np.ndarray, n_docs: np.ndarray, keeper: np.ndarray):
        self.hash = PerfectHash(lo, hi)
        at = self.hash.index(lo, hi)
        self.fingerprint = np.empty(len(lo), np.uint64)
        self.n_docs, self.keeper = np.empty(len(lo), np.int64), np.empty(len(lo), np.int64)
        self.fingerprint[at], self.n_docs[at], self.keeper[at] = hi, n_docs, keeper

    def dump(self) -> bytes:
        return pickle.dumps((self.hash.levels, self.hash.size, self.fingerprint, self.n_docs, self.keeper))

    @classmethod
    def load(cls, data: bytes) -> Shard:
        s = cls.__new__(cls)
        s.hash = PerfectHash.__new__(PerfectHash)
        s.hash.levels, s.hash.size, s.fingerprint, s.n_docs, s.keeper = pickle.loads(data)
        return s

    def probe(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(member, keeper) of each key; a non-member fails by its fingerprint."""
        at = self.hash.index(lo, hi)
        ok = at >= 0
        ok[ok] = self.fingerprint[at[ok]] == hi[ok]
        return ok, np.where(ok, self.keeper[at], 0)


def line_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                min_chars: int = MIN_CHARS) -> DataFrame:
    """(hi, lo, n_docs, keeper) of every long line, a row being a document; a task's lines are summed before the shuffle."""

    def run(batches):
        seen: dict = {}

        def out():
            keys = np.array(list(seen), np.uint64).reshape(-1, 2)
            vals = np.array(list(seen.values()), np.int64).reshape(-1, 2)
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys[:, 0].view(np.int64)), pa.array(keys[:, 1].view(np.int64)),
                                               pa.array(vals[:, 0]), pa.array(vals[:, 1])],
                                              names=["hi", "lo", "n_docs", "keeper"])

        for b in slices(batches):
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                i = NO_ID if i is None else i
                for k in set(line_keys(t, min_chars)):
                    if k is not None:
                        n, top = seen.get(k, (0, NO_ID))
                        seen[k] = (n + 1, max(top, i))
                if len(seen) > 200_000:
                    yield out()
        if seen:
            yield out()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return (rows.mapInArrow(run, "hi long, lo long, n_docs long, keeper long")
            .groupBy("hi", "lo").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper")))


def surplus(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame | None:
    """(hi, lo, surplus): by how many more rows than ids a long line is held; None where no id repeats.

    Only rows of repeated ids are read for it.  Null ids are a document each.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    again = written(rows.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("n"))
                    .where(F.col("n") > 1).select("doc_id"), "line-ids")
    if again.isEmpty():
        return None

    def run(batches):
        for b in slices(batches):
            found = [(i, *k) for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True)
                     for k in set(line_keys(t, min_chars)) if k is not None]
            keys = np.array([(h, l) for _, h, l in found], np.uint64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _, _ in found], pa.int64()), pa.array(signed(keys[:, 0])),
                                              pa.array(signed(keys[:, 1]))], names=["doc_id", "hi", "lo"])

    held = rows.join(again, "doc_id", "left_semi").mapInArrow(run, "doc_id long, hi long, lo long")
    return (held.groupBy("doc_id", "hi", "lo").agg((F.count("*") - 1).alias("more"))
            .groupBy("hi", "lo").agg(F.sum("more").alias("surplus")).where(F.col("surplus") > 0))


class LineIndex:
    """Shards over the lines of at least ``min_chars`` found in at least ``min_docs`` documents.

    Rows that share an id are one document; a null id is one by itself.  Shards
    are built in tasks and kept in a written table; none passes the driver.
    Documents are dealt into pieces by a hash of id and text.  A piece asks
    for each of its distinct lines once, so a line that very many documents
    hold is asked for once a piece; a task holds one shard or the frequent
    lines of one piece at a time.
    """

    def __init__(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, shard_keys: int = SHARD_KEYS,
                 piece_keys: int = PIECE_KEYS):
        self.min_chars = min_chars
        frequent = written(line_counts(docs, doc_id, text, min_chars).where(F.col("n_docs") >= min_docs), "lines")
        more = surplus(docs, doc_id, text, min_chars)
        if more is not None:
            n_docs = F.col("n_docs") - F.coalesce("surplus", F.lit(0))
            frequent = written(frequent.join(more, ["hi", "lo"], "left").where(n_docs >= min_docs)
                               .select("hi", "lo", n_docs.alias("n_docs"), "keeper"), "lines-by-id")
        size = frequent.agg(F.count("*").alias("n"), F.coalesce(F.sum("n_docs"), F.lit(0)).alias("held")).first()
        self.parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # whole multiples of the partitions, so that shards and pieces are dealt evenly
        self.n_shards = self.parts * max(1, -(-2 * size["n"] // (shard_keys * self.parts)))
        self.n_pieces = self.parts * max(1, -(-size["held"] // (piece_keys * self.parts)))

        def build(pdf: pd.DataFrame) -> pd.DataFrame:
            s = Shard(pdf["hi"].to_numpy().view(np.uint64), pdf["lo"].to_numpy().view(np.uint64),
                      pdf["n_docs"].to_numpy(), pdf["keeper"].to_numpy())
            return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "data": [s.dump()]})

        self.shards = written(frequent.withColumn("shard", F.pmod(F.col("hi"), F.lit(self.n_shards)))
                              .groupBy("shard").applyInPandas(build, "shard long, data binary"), "line-shards")

    def asked(self, docs: DataFrame) -> DataFrame:
        """Distinct (piece, hi, lo) of the long lines of rows (piece, text)."""
        min_chars = self.min_chars

        def run(batches):
            seen: set = set()

            def out():
                rows = list(seen)
                seen.clear()
                keys = np.array([(h, l) for _, h, l in rows], np.uint64).reshape(-1, 2)
                return pa.RecordBatch.from_arrays([pa.array([p for p, _, _ in rows], pa.int64()),
                                                   pa.array(signed(keys[:, 0])), pa.array(signed(keys[:, 1]))],
                                                  names=["piece", "hi", "lo"])

            for b in slices(batches):
                for p, t in zip(b.column("piece").to_pylist(), b.column("text").to_pylist(), strict=True):
                    seen.update((p, *k) for k in line_keys(t, min_chars) if k is not None)
                if len(seen) > 200_000:
                    yield out()
            if seen:
                yield out()

        return docs.mapInArrow(run, "piece long, hi long, lo long").distinct()

    def found(self, asked: DataFrame) -> DataFrame:
        """(piece, hi, lo, keeper) of the keys that a shard holds; each shard is probed in one task beside its keys."""

        def run(batches):
            shard, s = None, None
            for b in batches:
                of, data = b.column("shard").to_numpy(), b.column("data")
                edge = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))) if len(of) else []
                for lo, hi in zip(edge, [*edge[1:], len(of)]):
                    if of[lo] != shard:
                        shard, s = of[lo], None
                    if data[lo].is_valid:  # a shard comes before its keys
                        s = Shard.load(data[lo].as_py())
                        lo += 1
                    if s is None or lo == hi:
                        continue
                    rows = b.slice(lo, hi - lo)
                    ok, keeper = s.probe(*(rows.column(c).to_numpy().view(np.uint64) for c in ("hi", "lo")))
                    at = pa.array(np.flatnonzero(ok))
                    yield pa.RecordBatch.from_arrays([*(rows.column(c).take(at) for c in ("piece", "hi", "lo")),
                                                      pa.array(keeper[ok])], names=["piece", "hi", "lo", "keeper"])

        none = F.lit(None).cast("long")
        rows = (self.shards.select("shard", "data", none.alias("piece"), none.alias("hi"), none.alias("lo"))
                .unionByName(asked.select(F.pmod(F.col("hi"), F.lit(self.n_shards)).alias("shard"),
                                          F.lit(None).cast("binary").alias("data"), "piece", "hi", "lo")))
        return (rows.repartitionById(self.parts, F.pmod("shard", F.lit(self.parts)).cast("int"))
                .sortWithinPartitions("shard", F.col("piece").asc_nulls_first())
                .mapInArrow(run, "piece long, hi long, lo long, keeper long"))

    def _marked(self, docs: DataFrame, doc_id: str, text: str, result, schema) -> DataFrame:
        """``result`` of each batch of ``docs`` and its lists of dropped-line masks."""
        min_chars = self.min_chars
        fields = docs.columns
        rows = docs.select(F.pmod(F.xxhash64(doc_id, text), F.lit(self.n_pieces)).alias("piece"), F.struct("*").alias("row"))
        hits = self.found(self.asked(rows.select("piece", F.col(f"row.{text}").alias("text"))))

        def mark(ids: list, texts: list, hi: np.ndarray, lo: np.ndarray, keeper: np.ndarray) -> list[np.ndarray]:
            masks, keys, where = [], [], []
            for i, t in enumerate(texts):
                row = line_keys(t, min_chars)
                masks.append(np.zeros(len(row), bool))
                for j, k in enumerate(row):
                    if k is not None:
                        keys.append(k)
                        where.append((i, j))
            if not keys or not len(hi):
                return masks
            keys, where = np.array(keys, np.uint64), np.array(where, np.int64)
            own = np.array([NO_ID if x is None else x for x in ids], np.int64)[where[:, 0]]
            # hits lie in order of (lo, hi); equal lo with another hi is next to never, so step on while any is left
            at = np.searchsorted(lo, keys[:, 1])
            for _ in range(int(np.unique(lo, return_counts=True)[1].max())):
                got = np.minimum(at, len(lo) - 1)
                same = (lo[got] == keys[:, 1]) & (hi[got] == keys[:, 0])
                for i, j in where[same & (keeper[got] != own)]:
                    masks[i][j] = True
                at = at + 1
            return masks

        def run(batches):
            piece, parts, index = None, [], None
            for b in batches:
                of, keys = b.column("piece").to_numpy(), b.column("row").is_null().to_numpy(zero_copy_only=False)
                edge = (np.flatnonzero(np.concatenate(([True], (of[1:] != of[:-1]) | (keys[1:] != keys[:-1]))))
                        if len(of) else [])
                for start, end in zip(edge, [*edge[1:], len(of)]):
                    if of[start] != piece:
                        piece, parts, index = of[start], [], None
                    here = b.slice(start, end - start)
                    if keys[start]:  # a piece's hits come before its documents
                        parts.append([here.column(c).to_numpy() for c in ("hi", "lo", "keeper")])
                        continue
                    if index is None:
                        hi, lo, keeper = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*parts) if parts else [()] * 3))
                        hi, lo = hi.view(np.uint64), lo.view(np.uint64)
                        order = np.lexsort((hi, lo))
                        index, parts = (hi[order], lo[order], keeper[order]), []
                    for x in slices([here]):
                        x = pa.RecordBatch.from_arrays(x.column("row").flatten(), names=fields)
                        texts = x.column(text).to_pylist()
                        yield result(x, texts, mark(x.column(doc_id).to_pylist(), texts, *index))

        nulls = [F.lit(None).cast("long").alias(c) for c in ("hi", "lo", "keeper")]
        both = (hits.select("piece", "hi", "lo", "keeper", F.lit(None).cast(rows.schema["row"].dataType).alias("row"))
                .unionByName(rows.select("piece", *nulls, "row")))
        return (both.repartitionById(self.parts, F.pmod("piece", F.lit(self.parts)).cast("int"))
                .sortWithinPartitions("piece", F.col("row").isNotNull()).mapInArrow(run, schema))

    def dedup(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """``docs``, all columns, with the repeated lines taken out of the text.

        A text that loses nothing stays as it is (null stays null).
        """
        def result(b, texts, masks):
            at = b.schema.get_field_index(text)
            return b.set_column(at, b.schema.field(at), pa.array([left(t, m) for t, m in zip(texts, masks)],
                                                                 b.schema.field(at).type))

        return self._marked(docs, doc_id, text, result, docs.schema)

    def report(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """Per document: lines, lines dropped, SHA-256 of what is left (null and empty: one empty line)."""
        def result(b, texts, masks):
            return pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"),
                "n_lines": pa.array([len(m) for m in masks], pa.int64()),
                "n_dropped": pa.array([int(m.sum()) for m in masks], pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256((left(t, m) or "").encode("utf-8", "replace")).hexdigest()
                                         for t, m in zip(texts, masks)])})

        rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        return self._marked(rows, "doc_id", "text", result, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def left(text: str | None, mask: np.ndarray) -> str | None:
    """The lines that the mask leaves, joined again."""
    if text is None or not mask.any():
        return text
    return "\n".join(x for x, gone in zip(text.split("\n"), mask) if not gone)


def op8(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return LineIndex(docs).report(docs)


ORACLE_OP8 = r"""
WITH l AS (SELECT doc_id, i, line, translate(trim(line, E' \t\n\x0b\f\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
           FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
f AS (SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines, count(f.k) FILTER (keeper <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (f.k IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM l LEFT JOIN f USING (k) GROUP BY doc_id
"""
