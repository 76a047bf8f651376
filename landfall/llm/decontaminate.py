"""Benchmark decontamination (operator 4).

One Aho-Corasick automaton holds every window of normalised benchmark words;
each document's normalised text passes through it once.  The normalisation
keeps byte positions, so a hit maps straight back to the original text.
"""

from __future__ import annotations

from collections import defaultdict

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import broadcast, kept, slices, table, word_ranges

WINDOW = 13
#: Benchmark text held by one automaton; larger benchmarks take several.
MAX_AUTOMATON_BYTES = 8 << 20

#: A-Z to a-z; every other ASCII byte that is no digit or letter to a space.
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
               for c in range(256))


def windows(text: str | None, size: int = WINDOW) -> set[bytes]:
    """All runs of ``size`` words; a shorter text that has words is one window."""
    words = (text or "").encode("utf-8", "replace").translate(NORMAL).split()
    if not words:
        return set()
    return {b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}


def automaton(items: list[tuple]) -> ahocorasick.Automaton | None:
    """Automaton over the windows of (item_id, text) rows; None without a window.

    Windows carry a space at both ends, so matches begin and end at words.
    Bytes are read as Latin-1 to keep one position per byte.
    """
    owners: dict[bytes, set] = defaultdict(set)
    for item, text in items:
        for w in windows(text):
            owners[w].add(item)
    if not owners:
        return None
    a = ahocorasick.Automaton()
    for w, ids in owners.items():
        a.add_word(f" {w.decode('latin-1')} ", (len(w.split()), tuple(ids)))
    a.make_automaton()
    return a


def hits(text: str | None, machine) -> tuple[int, np.ndarray, set, list]:
    """(number of words, mask of hit words, items found, [(item, start, end)]).

    start and end are byte positions in the UTF-8 of the original text.
    """
    norm = (text or "").encode("utf-8", "replace").translate(NORMAL)
    words = norm.split()
    if machine is None or not words:
        return len(words), np.zeros(0, bool), set(), []
    found = list(machine.iter(f" {b' '.join(words).decode('latin-1')} "))
    if not found:
        return len(words), np.zeros(0, bool), set(), []
    ends = np.cumsum([len(w) + 1 for w in words])  # index of the space behind each word
    starts, stops = word_ranges(np.frombuffer(norm, np.uint8) != 32)
    mark, items, spans = np.zeros(len(words) + 1, np.int64), set(), []
    for at, (n, ids) in found:
        last = int(np.searchsorted(ends, at))
        mark[last - n + 1] += 1
        mark[last + 1] -= 1
        items.update(ids)
        spans += [(i, int(starts[last - n + 1]), int(stops[last])) for i in ids]
    return len(words), np.cumsum(mark[:-1]) > 0, items, spans


class Decontaminator:
    """Automata over a benchmark, each over at most ``MAX_AUTOMATON_BYTES`` of text.

    Usual benchmarks make one.  The items come to the driver in slices of that
    size, and each slice is broadcast by itself; ``scan`` then runs a document
    through every automaton while its text is at hand.
    Items without an id or without words are left out; rows that repeat an
    item_id are one item.
    """

    def __init__(self, benchmark: DataFrame, item_id: str = "item_id", text: str = "text",
                 max_bytes: int = MAX_AUTOMATON_BYTES):
        spark = benchmark.sparkSession
        rows = benchmark.where(F.col(item_id).isNotNull() & F.col(text).isNotNull()).select(item_id, text)
        self.parts, part, size = [], [], 0
        for r in rows.toLocalIterator():
            part.append((str(r[0]), r[1]))
            size += len(r[1])
            if size >= max_bytes:
                self.parts.append(broadcast(spark, part))
                part, size = [], 0
        if part:
            self.parts.append(broadcast(spark, part))

    def scanner(self):
        """A function of a text for use in a task, with the fields of ``scan``."""
        parts = self.parts

        def machines():
            return [kept(b, automaton) for b in parts]

        def scan(text: str | None):
            n, mask, items, spans = 0, np.zeros(0, bool), set(), []
            for m in machines() or [None]:
                n, k, i, s = hits(text, m)
                if len(k):
                    mask = k | mask if len(mask) else k
                items |= i
                spans += s
            n_hit = int(mask.sum())
            return n, n_hit, sorted(items), spans, n_hit > 0 and 20 * n_hit >= n

        return scan

    def scan(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """A row per document: word counts, items found, spans in the original bytes, verdict.

        Null and wordless texts have no words and are clean.  Rows are judged
        one by one, so repeated rows and ids give repeated results.
        """
        scan = self.scanner()

        def run(batches):
            for b in slices(batches):
                out = [scan(t) for t in b.column("text").to_pylist()]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": b.column("doc_id"),
                    "n_words": pa.array([x[0] for x in out], pa.int64()),
                    "n_hit": pa.array([x[1] for x in out], pa.int64()),
                    "items": pa.array([x[2] for x in out], pa.list_(pa.string())),
                    "spans": pa.array([[{"item_id": i, "start": s, "end": e} for i, s, e in x[3]] for x in out],
                                      pa.list_(pa.struct([("item_id", pa.string()), ("start", pa.int64()),
                                                          ("end", pa.int64())]))),
                    "contaminated": pa.array([x[4] for x in out], pa.bool_())})

        kind = docs.schema[doc_id].dataType.simpleString()
        return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
            run, f"doc_id {kind}, n_words long, n_hit long, items array<string>, "
                 "spans array<struct<item_id:string,start:long,end:long>>, contaminated boolean")

    def clean(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """The rows of ``docs``, all columns, that are not contaminated."""
        scan = self.scanner()

        def run(batches):
            for b in slices(batches):
                yield b.filter(pa.array([not scan(t)[4] for t in b.column(text).to_pylist()], pa.bool_()))

        return docs.mapInArrow(run, docs.schema)


def op4(spark, sf_dir: str) -> DataFrame:
    found = Decontaminator(table(spark, sf_dir, "benchmark")).scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


ORACLE_OP4 = r"""
WITH w AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS a FROM benchmark WHERE item_id IS NOT NULL),
win AS (SELECT DISTINCT item_id, least(len(a), 13) AS k, array_to_string(a[i + 1:i + least(len(a), 13)], ' ') AS s
        FROM w, unnest(range(greatest(1, len(a) - 12))) AS u(i) WHERE len(a) > 0),
sizes AS (SELECT DISTINCT k FROM win),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS a FROM documents),
dw AS (SELECT doc_id, k, i, array_to_string(a[i + 1:i + k], ' ') AS s
       FROM d, sizes, unnest(range(greatest(0, len(a) - k + 1))) AS u(i)),
hit AS (SELECT doc_id, i, dw.k, item_id FROM dw JOIN win USING (k, s)),
words AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM hit, unnest(range(k)) AS u(j) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n, string_agg(x, ',' ORDER BY x) AS s
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY 1)
SELECT doc_id, len(a) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(a) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN its USING (doc_id)
"""
