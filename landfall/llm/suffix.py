"""Suffix-array dedup of repeated byte strings (operator 3).

Suffixes are sampled where a 24-byte string has the smallest hash of a window,
so that equal strings of 100 bytes hold the same sampled place.  Each batch of
documents (a task's input) gets a sparse suffix array: its sampled suffixes in
order of their first 24 bytes' hash, then of the hash of the whole stretch of
strings they stand for.  The arrays are dealt into shards by prefix; in a
shard, new arrays are merge-scanned against the existing levels for long
matches, and levels of like size merge, so their number stays logarithmic.

Suffixes whose stretches agree settle whole stretches.  Those that share the
prefix but not the stretch are compared string by string in a second step.
"""

from __future__ import annotations

import hashlib
from itertools import starmap

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm.common import SubstringHash, mix64, slices, table, written

#: Length of a repeated string, of the sampled prefix, and prefixes in a window.
LENGTH, PREFIX = 100, 24
WINDOW = LENGTH - PREFIX + 1
#: Sampled suffixes sorted at a time in a task, and stretches under one prefix from which it is hot.
BATCH, HOT = 1 << 18, 500
#: Bytes of text that a shard stands for on average at most, rows a shard gathers before it sends
#: settled ones on, and bytes of stretches a task gathers before it sends them to be compared.
SHARD, SEND, CUT = 32 << 20, 50_000, 16 << 20
#: Stands for a null doc_id, which comes before all others.
NO_ID = -(1 << 63)
LOW48 = np.uint64((1 << 48) - 1)
FIELDS = ("prefix", "stretch", "doc", "tie", "start", "offset", "more")
ORDER = ("start", "tie", "doc", "stretch", "prefix")  # last key first


def sampled(a: np.ndarray, hasher: SubstringHash) -> tuple[np.ndarray, ...]:
    """(prefix hash, stretch hash, start, offset, more) of a text's sampled suffixes.

    A sampled suffix at start + offset stands for the strings of ``LENGTH``
    bytes that begin at start, ..., start + more.
    """
    n = len(a)
    if n < LENGTH:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    sums = hasher.sums(a)
    at = np.arange(n - PREFIX + 1)
    gram = hasher.ranges(sums, at, at + PREFIX)
    bits = np.uint64(max(20, n.bit_length()))
    key = (gram >> bits << bits) | at.astype(np.uint64)
    # smallest key of each window from running minima of blocks, forward and backward
    full = np.full(-(-len(key) // WINDOW) * WINDOW, np.iinfo(np.uint64).max, np.uint64)
    full[:len(key)] = key
    block = full.reshape(-1, WINDOW)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = np.arange(n - LENGTH + 1)
    place = (np.minimum(behind[starts], ahead[starts + WINDOW - 1]) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    more = np.diff(np.append(first, len(place))) - 1
    offset = place[first] - first
    shape = mix64((offset * 128 + more).astype(np.uint64))
    stretch = mix64(hasher.ranges(sums, first, first + more + LENGTH) ^ shape)
    return gram[place[first]], stretch, first, offset, more


# -- a run: dict of equal-length arrays, in order of (prefix, stretch, doc, tie, start)

def ordered(run: dict) -> dict:
    order = np.lexsort([run[k] for k in ORDER])
    return {k: v[order] for k, v in run.items()}


def joined(runs: list[dict]) -> dict:
    return {k: np.concatenate([r[k] for r in runs]) for k in FIELDS}


def alike(run: dict, keys: tuple) -> np.ndarray:
    """Which rows have the same keys as the row before."""
    out = np.zeros(len(run["doc"]), bool)
    out[1:] = np.logical_and.reduce([run[k][1:] == run[k][:-1] for k in keys])
    return out


def settle(run: dict) -> tuple[dict, dict]:
    """(earliest row of each stretch, the other rows) of an ordered run; a row met twice is one."""
    same = alike(run, ("prefix", "stretch"))
    again = alike(run, ORDER)
    return {k: v[~same] for k, v in run.items()}, {k: v[same & ~again] for k, v in run.items()}


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each of the sizes, one after the other."""
    before = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(start - before, size)


class LevelIndex:
    """Levels of sorted runs, each at least twice the next: a new run is merge-scanned against all.

    Rows of a hot prefix are compared string by string later, whatever their
    stretches; so none are held once a level has more than ``HOT`` of them.
    """

    def __init__(self):
        self.levels: list[dict] = []
        self.covered: list[dict] = []
        self.hot_rows: list[dict] = []
        self.hot = np.zeros(0, np.uint64)

    def insert(self, run: dict) -> None:
        run = self._without_hot(run)
        for i, level in enumerate(self.levels):
            self.levels[i], run = self._scan(level, run)
        self.levels.append(run)
        while len(self.levels) > 1 and 2 * len(self.levels[-1]["doc"]) >= len(self.levels[-2]["doc"]):
            b, a = self.levels.pop(), self.levels.pop()
            self.levels.append(ordered(joined([a, b])))
        prefix = self.levels[-1]["prefix"]
        hot = prefix[HOT:][prefix[HOT:] == prefix[:-HOT]]
        if len(hot):
            self.hot = np.union1d(self.hot, hot)
            self.levels = [self._without_hot(level) for level in self.levels]

    def _without_hot(self, run: dict) -> dict:
        gone = np.isin(run["prefix"], self.hot)
        if not gone.any():
            return run
        self.hot_rows.append({k: v[gone] for k, v in run.items()})
        return {k: v[~gone] for k, v in run.items()}

    def settled(self, least: int = 1):
        """(kind, run) of covered rows and of hot ones, once there are ``least`` of them; then they are forgotten."""
        for kind, runs in ((COVER, self.covered), (NEED, self.hot_rows)):
            if sum(len(r["doc"]) for r in runs) >= least:
                run = joined(runs)
                runs.clear()
                yield kind, run | {"group": np.full(len(run["doc"]), HOT + 1)}

    def _scan(self, level: dict, run: dict) -> tuple[dict, dict]:
        """Take the later one of every two rows with one stretch out of its run."""
        prefix, which = np.unique(run["prefix"], return_inverse=True)
        lo, hi = (np.searchsorted(level["prefix"], prefix, side) for side in ("left", "right"))
        drop_level, drop_run = np.zeros(len(level["doc"]), bool), np.zeros(len(run["doc"]), bool)
        known = np.flatnonzero((hi > lo)[which])
        if not len(known):
            return level, run
        part = {k: v[known] for k, v in run.items()}
        rows = spread(lo, hi - lo)  # the level's rows under these prefixes
        both = joined([{k: v[rows] for k, v in level.items()}, part])
        origin = np.concatenate([rows, -1 - known])
        order = np.lexsort([both[k] for k in ORDER])
        both, origin = {k: v[order] for k, v in both.items()}, origin[order]
        same, again = alike(both, ("prefix", "stretch")), alike(both, ORDER)
        self.covered.append({k: v[same & ~again] for k, v in both.items()})
        late = origin[same]
        drop_level[late[late >= 0]] = True
        drop_run[-1 - late[late < 0]] = True
        return {k: v[~drop_level] for k, v in level.items()}, {k: v[~drop_run] for k, v in run.items()}

    def finish(self) -> dict:
        """Earliest rows whose prefix has several stretches, but those of hot prefixes in ``settled``."""
        if not self.levels:
            return {k: np.zeros(0, np.int64) for k in (*FIELDS, "group")}
        run = ordered(joined(self.levels))
        new = np.concatenate(([True], run["prefix"][1:] != run["prefix"][:-1])) if len(run["doc"]) else np.zeros(0, bool)
        group = np.diff(np.append(np.flatnonzero(new), len(new)))
        size = np.repeat(group, group)
        return {k: v[size > 1] for k, v in (run | {"group": size}).items()}


def pack(run: dict) -> bytes:
    """Sorted prefixes as differences, in byte planes; documents by their place in a list."""
    n = len(run["doc"])
    docs, which = np.unique(np.column_stack([run["doc"], run["tie"]]), axis=0, return_inverse=True)

    def planes(v, k):
        return v.astype(np.uint64).view(np.uint8).reshape(-1, 8)[:, :k].T.tobytes()

    data = (np.array([n, len(docs)], np.int64).tobytes() + docs.astype(np.int64).tobytes()
            + planes(np.diff(run["prefix"], prepend=np.uint64(0)), 6) + planes(run["stretch"], 6) + planes(which.ravel(), 4)
            + planes(run["start"], 6) + planes(run["offset"], 1) + planes(run["more"], 1))
    return zstandard.ZstdCompressor(level=1).compress(data)


def unpack(data: bytes) -> dict:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n, k = np.frombuffer(raw, np.int64, 2)
    docs = np.frombuffer(raw, np.int64, 2 * k, 16).reshape(-1, 2)
    at = 16 + 16 * int(k)

    def planes(width):
        nonlocal at
        out = np.zeros((n, 8), np.uint8)
        out[:, :width] = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T
        at += int(n) * width
        return out.view(np.uint64)[:, 0]

    prefix, stretch, which = np.cumsum(planes(6), dtype=np.uint64), planes(6), planes(4).astype(np.int64)
    return {"prefix": prefix, "stretch": stretch, "doc": docs[which, 0], "tie": docs[which, 1],
            "start": planes(6).astype(np.int64), "offset": planes(1).astype(np.int64), "more": planes(1).astype(np.int64)}


COVER, NEED, BLOB = 0, 1, 2
ROWS = "p int, kind int, data binary"
SPANS = "kind int, doc long, tie long, start long, offset int, more int, prefix long, hot boolean"


def _blobs(kind: int, parts: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p for p, _ in parts], pa.int32()),
                                       pa.array([kind] * len(parts), pa.int32()),
                                       pa.array([d for _, d in parts], pa.binary())], names=["p", "kind", "data"])


def _spans(kind: int, run: dict) -> pa.RecordBatch:
    n = len(run["doc"])
    need = kind == NEED
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(n, kind, np.int32)), pa.array(run["doc"].astype(np.int64)),
        pa.array(run["tie"].astype(np.int64)), pa.array(run["start"].astype(np.int64)),
        pa.array(run["offset"].astype(np.int32)), pa.array(run["more"].astype(np.int32)),
        pa.array(run["prefix"].view(np.int64)) if need else pa.nulls(n, pa.int64()),
        pa.array(run["group"] > HOT) if need else pa.nulls(n, pa.bool_())],
        names=["kind", "doc", "tie", "start", "offset", "more", "prefix", "hot"])


def find_spans(docs: DataFrame, parts: int) -> DataFrame:
    """Stretches known to be covered, and those still to be compared, as a written table."""

    def sample(batches):
        hasher, runs, size = SubstringHash(), [], 0

        def flush():
            run = joined(runs)
            runs.clear()
            p = (run["prefix"] % np.uint64(parts)).astype(np.int64)
            run = {**run, "prefix": (run["prefix"] // np.uint64(parts)) & LOW48, "stretch": run["stretch"] & LOW48, "p": p}
            order = np.lexsort([run[k] for k in (*ORDER, "p")])
            run = {k: v[order] for k, v in run.items()}
            edge = np.searchsorted(run["p"], np.arange(parts + 1))
            out, covered = [], []
            for i in np.flatnonzero(np.diff(edge)):
                piece = {k: run[k][edge[i]:edge[i + 1]] for k in FIELDS}
                first, rest = settle(piece)
                out.append((int(i), pack(first)))
                covered.append(rest)
            covered = joined(covered)
            yield _blobs(BLOB, out)
            if len(covered["doc"]):
                yield _blobs(COVER, [(int(edge[1] % parts), pack(ordered(covered)))])

        for b in slices(batches):
            for i, tie, t in zip(*(b.column(c).to_pylist() for c in ("doc", "tie", "text"))):
                a = np.frombuffer((t or "").encode("utf-8", "replace"), np.uint8)
                prefix, stretch, start, offset, more = sampled(a, hasher)
                if len(prefix):
                    name = np.full((2, len(prefix)), [[i], [tie]], np.int64)
                    runs.append(dict(zip(FIELDS, (prefix, stretch, *name, start, offset, more))))
                    size += len(prefix)
                if size >= BATCH:
                    yield from flush()
                    runs, size = [], 0
        if size:
            yield from flush()

    def merge(batches):
        index: dict[int, LevelIndex] = {}
        for b in batches:
            for p, kind, data in zip(*(b.column(c).to_pylist() for c in ("p", "kind", "data"))):
                if kind == COVER:
                    yield _spans(COVER, unpack(data))
                else:
                    x = index.setdefault(p, LevelIndex())
                    x.insert(unpack(data))
                    yield from starmap(_spans, x.settled(SEND))
        while index:
            _, x = index.popitem()
            yield from starmap(_spans, x.settled())
            need = x.finish()
            yield _spans(NEED, need | {"prefix": np.asarray(need["prefix"], np.uint64)})

    return written(docs.mapInArrow(sample, ROWS).repartitionById(parts, F.col("p")).mapInArrow(merge, SPANS), "suffix-spans")


def packed_texts(docs: DataFrame) -> DataFrame:
    """(doc, tie, no_id, z): the texts compressed, for the joins that move them."""

    def run(batches):
        c = zstandard.ZstdCompressor(level=1)
        for b in slices(batches):
            z = [c.compress((t or "").encode("utf-8", "replace")) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc", "tie", "no_id")), pa.array(z, pa.binary())],
                                             names=["doc", "tie", "no_id", "z"])

    return docs.mapInArrow(run, "doc long, tie long, no_id boolean, z binary")


def compare(docs: DataFrame, needs: DataFrame, parts: int) -> DataFrame:
    """Covered strings (doc, start, more) among stretches that share a prefix; written.

    A stretch travels by its prefix; under a hot prefix its strings travel
    one by one, each by its own hash, and a task sends equal ones once.
    """
    per = needs.groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "more", "prefix", "hot")).alias("need"))
    asked = packed_texts(docs).join(per, ["doc", "tie"])

    def cut(batches):
        d, c, hasher = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1), SubstringHash()
        held, size, strings = {}, 0, {}

        def flush():
            for (h, s), place in strings.items():
                add(h % parts, (*place, 0), s)
            yield _blobs(BLOB, [(p, c.compress(np.array([len(head)], np.int64).tobytes()
                                               + np.array(head, np.int64).tobytes() + b"".join(body)))
                                for p, (head, body) in held.items()])

        def add(p, head, body):
            x = held.setdefault(p, ([], []))
            x[0].append(head)
            x[1].append(body)

        covered = []
        for b in slices(batches):
            for doc, tie, z, need in zip(*(b.column(x).to_pylist() for x in ("doc", "tie", "z", "need"))):
                text = d.decompress(z)
                a = np.frombuffer(text, np.uint8)
                sums = None
                for x in need:
                    s, more = x["start"], x["more"]
                    if not x["hot"]:
                        add(int(x["prefix"]) % parts, (doc, tie, s, more), text[s:s + more + LENGTH])
                        size += more + LENGTH
                        continue
                    sums = hasher.sums(a) if sums is None else sums
                    at = np.arange(s, s + more + 1)
                    for h, t in zip(hasher.ranges(sums, at, at + LENGTH).tolist(), at.tolist()):
                        k, mine = (h, text[t:t + LENGTH]), (doc, tie, t)
                        old = strings.get(k)
                        if old is None:
                            strings[k] = mine
                            size += 2 * LENGTH
                        elif old != mine:
                            strings[k] = min(old, mine)
                            covered.append(max(old, mine))
                if size > CUT:
                    yield from flush()
                    held, size, strings = {}, 0, {}
            if covered:
                yield _blobs(COVER, [(covered[0][0] % parts, np.array(covered, np.int64).tobytes())])
                covered = []
        yield from flush()

    def judge(batches):
        z, hasher = zstandard.ZstdDecompressor(), SubstringHash(1)
        hashes, places = [], []
        for b in batches:
            for kind, data in zip(b.column("kind").to_pylist(), b.column("data").to_pylist()):
                if kind == COVER:
                    yield _strings(np.frombuffer(data, np.int64).reshape(-1, 3))
                    continue
                raw = z.decompress(data)
                n = int(np.frombuffer(raw, np.int64, 1)[0])
                head = np.frombuffer(raw, np.int64, 4 * n, 8).reshape(n, 4)
                a, more = np.frombuffer(raw, np.uint8, offset=8 + 32 * n), head[:, 3]
                strings = more + 1
                begin = np.cumsum(more + LENGTH) - (more + LENGTH)  # of each stretch in the joined text
                at = spread(begin, strings)
                hashes.append(hasher.ranges(hasher.sums(a), at, at + LENGTH))
                place = np.repeat(head[:, :3], strings, axis=0)
                place[:, 2] += at - np.repeat(begin, strings)
                places.append(place)
        if hashes:
            h, place = np.concatenate(hashes), np.concatenate(places)
            order = np.lexsort((place[:, 2], place[:, 1], place[:, 0], h))
            h, place = h[order], place[order]
            same = np.concatenate(([False], h[1:] == h[:-1]))
            same[1:] &= (place[1:] != place[:-1]).any(axis=1)
            yield _strings(place[same])

    return written(asked.mapInArrow(cut, ROWS).repartitionById(parts, F.col("p"))
                   .mapInArrow(judge, "doc long, tie long, start long, more int"), "suffix-strings")


def _strings(place: np.ndarray) -> pa.RecordBatch:
    """Covered strings (doc, tie, start), neighbours in one document as one row."""
    place = place[np.lexsort((place[:, 2], place[:, 1], place[:, 0]))]
    new = np.ones(len(place), bool)
    new[1:] = (place[1:, :2] != place[:-1, :2]).any(axis=1) | (place[1:, 2] > place[:-1, 2] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1
    more = place[last, 2] - place[first, 2] if len(first) else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays([*(pa.array(place[first, k]) for k in range(3)), pa.array(more.astype(np.int32))],
                                      names=["doc", "tie", "start", "more"])


def shards(size: int, least: int) -> int:
    """Shards for texts of this size in all, so that a worker's share does not grow with them."""
    return max(least, -(-size // SHARD))


def repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, runs [(start, end)] of covered bytes, kept (the other bytes, joined).

    A byte goes if a string of ``LENGTH`` bytes that covers it also starts
    earlier, in a smaller doc_id or before in the same document.  Null texts
    are empty.  A null id comes before all others.  Rows that share an id come
    in order of a hash of their texts; equal rows are one document.
    """
    ids = docs.groupBy(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc"))
    most, size = ids.agg(F.count("*").alias("n"), F.sum(F.octet_length(text)).alias("size")).agg(F.max("n"), F.sum("size")).head()
    single = (most or 0) < 2
    docs = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc"),
                       (F.lit(0).cast("long") if single else F.xxhash64(text)).alias("tie"),
                       F.col(doc_id).isNull().alias("no_id"), F.col(text).alias("text"))
    parts = shards(size or 0, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spans = find_spans(docs, parts)
    strings = compare(docs, spans.where(F.col("kind") == NEED), parts)
    covers = spans.where(F.col("kind") == COVER).select("doc", "tie", "start", "more").unionByName(strings)
    per = covers.groupBy("doc", "tie").agg(F.collect_set(F.struct("start", "more")).alias("cover"))
    rows = packed_texts(docs).join(per, ["doc", "tie"], "left")

    def run(batches):
        z = zstandard.ZstdDecompressor()
        for b in slices(batches):
            out = []
            cover = b.column("cover")
            for data, c in zip(b.column("z").to_pylist(), cover):
                a = np.frombuffer(z.decompress(data), np.uint8)
                gone = np.zeros(len(a) + 1, np.int64)
                if c.is_valid:
                    v = c.values
                    start, more = v.field("start").to_numpy(), v.field("more").to_numpy()
                    fits = start < len(a)
                    np.add.at(gone, start[fits], 1)
                    np.add.at(gone, np.minimum(start + more + LENGTH, len(a))[fits], -1)
                mask = np.cumsum(gone[:-1]) > 0
                edge = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
                out.append((len(a), list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())),
                            a[~mask].tobytes()))
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array([None if x else i for i, x in zip(b.column("doc").to_pylist(),
                                                                     b.column("no_id").to_pylist())], pa.int64()),
                "n_bytes": pa.array([x[0] for x in out], pa.int64()),
                "runs": pa.array([[{"start": s, "end": e} for s, e in x[1]] for x in out],
                                 pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                "kept": pa.array([x[2] for x in out], pa.binary())})

    return rows.mapInArrow(run, "doc_id long, n_bytes long, runs array<struct<start:long,end:long>>, kept binary")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated(table(spark, sf_dir, "documents"))
    removed = F.aggregate("runs", F.lit(0).cast("long"), lambda acc, r: acc + r["end"] - r["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("runs").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))
