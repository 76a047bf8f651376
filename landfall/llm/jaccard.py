"""N-gram Jaccard join with a prefix tree (operator 6).

A document is its set of word shingles, as 64-bit hashes in one global order.
Equal sets are one node.  Sets that may link are routed together by segments:
the order is cut into more segments than two linked sets can differ in, so at
least one segment must be equal.  Inside a routed group the sets form a prefix
tree; each set walks it, sharing the overlap of common beginnings and leaving
subtrees whose remaining length cannot reach the threshold.  Components follow
from the verified links.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from landfall.llm.common import SubstringHash, broadcast, drop_written, mix64, most_frequent, signed, slices, table, written
from landfall.llm.components import components

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Documents that tell which shingles are common, the share that makes one so, and the number kept.
SAMPLE, COMMON_IN, MAX_COMMON = 20_000, 5, 500_000
#: Sizes grow by this factor from class to class of segment counts.
CLASS_RATIO = 1.5
#: Signatures of a task packed at a time; sets, and their elements, that are compared in one task.
FLUSH, GROUP, ELEMENTS = 1_000_000, 512, 400_000
#: Bytes of signatures and sketches that are compared in one task at a time.
SHARE = 32 << 20
#: Elements of sets that are copied to the pairs of their blocks at a time, or the component's own where they are more.
ROUND = 50_000_000


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; a link needs num/den of the union."""

    words: int = 3
    num: int = 90
    den: int = 100

    def linked(self, a: int, b: int, common: int) -> bool:
        return self.den * common >= self.num * (a + b - common)

    def overlap(self, a: int, b: int) -> int:
        """Least number of common elements of linked sets of sizes a and b."""
        return -(-self.num * (a + b) // (self.num + self.den))


def shingles(text: str | None, words: int, hasher: SubstringHash) -> np.ndarray:
    """Distinct shingle hashes in ascending order; with fewer words the whole sequence is one."""
    ws = (text or "").encode("utf-8", "replace").translate(LOWER).split()
    if not ws:
        return np.zeros(0, np.uint64)
    a = np.frombuffer(b" ".join(ws), np.uint8)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words, len(ws))
    return np.unique(hasher.ranges(hasher.sums(a), starts[:len(ws) - k + 1], ends[k - 1:]))


def set_key(s: np.ndarray) -> np.ndarray:
    """A 64-bit name of a set."""
    return mix64(np.array([mix64(s).sum(dtype=np.uint64) + np.uint64(len(s))]))


def size_classes(n: int, rule: Rule) -> list[tuple[int, int]]:
    """(class, its largest size) of all classes where a set of n elements may meet a partner no larger than it."""
    out, lo, c = [], 1, 0
    least = -(-rule.num * n // rule.den)
    while lo <= n:
        hi = max(lo + 1, int(lo * CLASS_RATIO)) - 1
        if hi >= least:
            out.append((c, hi))
        lo, c = hi + 1, c + 1
    return out


def class_signatures(s: np.ndarray, rare: np.ndarray, rule: Rule):
    """(most elements that linked sets differ in, signatures) of the set, for each of its size classes.

    Linked, different sets share a signature of one class: the smaller having
    at most ``hi`` elements, they differ in at most hi * (den - num) / num.  Of
    more segments than that, ``spare`` + 1 are equal.  Segments without enough
    rare shingles are weak; up to ``spare`` of them are left out, by one order
    for all sets: the last of the equal ones in that order always stays.
    """
    mixed = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(s))))
    rares = np.concatenate(([0], np.cumsum(rare)))
    for c, hi in size_classes(len(s), rule):
        differ = hi * (rule.den - rule.num) // rule.num
        if not differ:
            continue  # only equal sets link
        spare = -(-differ // 8)
        m = differ + 1 + spare
        segment = ((s >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        edge = np.searchsorted(segment, np.arange(m + 1, dtype=np.uint64))
        sig = mix64(mixed[edge[1:]] - mixed[edge[:-1]] + mix64(np.arange(m, dtype=np.uint64) + np.uint64((c + 1) << 32)))
        rank = np.minimum(rares[edge[1:]] - rares[edge[:-1]], 2 if rule.words < 5 else 1)
        order = np.lexsort((sig, edge[1:] - edge[:-1], rank))  # empty ones first
        weak = int((rank < (2 if rule.words < 5 else 1)).sum())
        yield differ, sig[np.sort(order[min(weak, spare):])]


def segment_signatures(s: np.ndarray, rare: np.ndarray, rule: Rule) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *(sig for _, sig in class_signatures(s, rare, rule))])


def sketch(s: np.ndarray, differ: int) -> bytes:
    """Parities of the set's elements by their low bits, eight times as many as linked sets differ in.

    The sketches of two sets differ in no more bits than the sets in elements.
    """
    bits = 1 << max(6, (8 * differ - 1).bit_length())
    at = (s & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).tobytes()


def common_shingles(docs: DataFrame, rule: Rule, with_count: bool = False) -> np.ndarray | tuple[np.ndarray, np.ndarray]:
    """Shingles that ``COMMON_IN`` or more of ``SAMPLE`` documents hold, at most ``MAX_COMMON``; their counts too where asked.

    They only decide which segments are weak and which shingles are rare; the result does not depend on them.
    """
    n = docs.count()
    share = min(1.0, SAMPLE / max(1, n))
    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) < int(share * (1 << 30)))

    def run(batches):
        hasher = SubstringHash()
        for b in slices(batches):
            sets = [shingles(t, rule.words, hasher) for t in b.column("text").to_pylist()]
            h, c = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(signed(h)), pa.array(c.astype(np.int64))], names=["h", "n"])

    rows = (sample.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= COMMON_IN))
    rows = most_frequent(written(rows, "jaccard-common"), "n", MAX_COMMON).select("h", "n").toArrow()
    h = rows.column("h").to_numpy().astype(np.int64).view(np.uint64)
    return (h, rows.column("n").to_numpy()) if with_count else np.sort(h)


def is_member(s: np.ndarray, of: np.ndarray) -> np.ndarray:
    if not len(of):
        return np.zeros(len(s), bool)
    at = np.minimum(np.searchsorted(of, s), len(of) - 1)
    return of[at] == s


# -- packed signatures: sorted 40-bit remainders as byte planes, and 48-bit set names

def pack(sig: np.ndarray, node: np.ndarray) -> bytes:
    order = np.argsort(sig, kind="stable")
    delta = np.diff(sig[order], prepend=np.uint64(0))
    a = delta.view(np.uint8).reshape(-1, 8)[:, :5].T.tobytes()
    b = node[order].view(np.uint8).reshape(-1, 8)[:, :6].T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(len(sig).to_bytes(8, "little") + a + b)


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int.from_bytes(raw[:8], "little")
    planes = np.frombuffer(raw, np.uint8, offset=8).reshape(-1, n) if n else np.zeros((11, 0), np.uint8)
    out = np.zeros((2, n, 8), np.uint8)
    out[0, :, :5], out[1, :, :6] = planes[:5].T, planes[5:].T
    both = out.view(np.uint64)[:, :, 0]
    return np.cumsum(both[0]), both[1]


def stars(sig: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(edges a, edges b, index of one row per signature): a signature's nodes hang on its smallest."""
    order = np.lexsort((node, sig))
    sig, node = sig[order], node[order]
    first = np.concatenate(([True], sig[1:] != sig[:-1])) if len(sig) else np.zeros(0, bool)
    head = np.flatnonzero(first)
    centre = np.repeat(node[head], np.diff(np.append(head, len(sig))))
    edge = np.unique(np.column_stack([centre, node])[centre != node], axis=0)
    return edge[:, 0], edge[:, 1], order[head]


NODE = np.uint64((1 << 48) - 1)
SCAN = "p int, kind int, data binary, doc_id long, n long, k long, a long, b long"


def _rows(kind: int, p: np.ndarray, **cols) -> pa.RecordBatch:
    n = len(p)
    names = {"data": pa.binary(), "doc_id": pa.int64(), "n": pa.int64(), "k": pa.int64(), "a": pa.int64(), "b": pa.int64()}
    arrays = [pa.array(p.astype(np.int32)), pa.array(np.full(n, kind, np.int32))]
    arrays += [pa.nulls(n, t) if x not in cols else cols[x] if isinstance(cols[x], pa.Array) else pa.array(cols[x], t)
               for x, t in names.items()]
    return pa.RecordBatch.from_arrays(arrays, names=["p", "kind", *names])


DOC, BLOB, EDGE = 0, 1, 2


def scan(docs: DataFrame, rule: Rule, parts: int, common) -> DataFrame:
    """One pass over the texts: a row per document and the candidate edges.

    A task hangs its own sets that share a signature on one of them and hands
    on one set per signature, packed by partition.
    """
    def run(batches):
        hasher, often = SubstringHash(), common.value["data"]
        sigs, nodes, size, seen = [], [], 0, set()

        def flush():
            sig, node = np.concatenate(sigs), np.concatenate(nodes)
            a, b, one = stars(sig, node)
            yield _rows(EDGE, a % np.uint64(parts), a=signed(a), b=signed(b))
            sig, node = sig[one], node[one]
            p = (sig % np.uint64(parts)).astype(np.int64)
            rest = (sig // np.uint64(parts)) & np.uint64((1 << 40) - 1)
            order = np.argsort(p, kind="stable")
            cut = np.searchsorted(p[order], np.arange(parts + 1))
            used = np.flatnonzero(np.diff(cut))
            blobs = [pack(rest[order[cut[i]:cut[i + 1]]], node[order[cut[i]:cut[i + 1]]]) for i in used]
            yield _rows(BLOB, used, data=blobs)

        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            n, k = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.uint64)
            for i, t in enumerate(texts):
                s = shingles(t, rule.words, hasher)
                n[i], k[i] = len(s), set_key(s)[0]
                if len(s) and k[i] not in seen:
                    seen.add(k[i])
                    sig = segment_signatures(s, ~is_member(s, often), rule)
                    sigs.append(sig)
                    nodes.append(np.full(len(sig), k[i] & NODE))
                    size += len(sig)
            yield _rows(DOC, (k + np.arange(len(k), dtype=np.uint64)) % np.uint64(parts), doc_id=batch.column("doc_id"), n=n, k=signed(k))
            if size > FLUSH:
                yield from flush()
                sigs, nodes, size, seen = [], [], 0, set()
        if size:
            yield from flush()

    def gather(batches):
        sigs, nodes = [], []
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            if (kind != BLOB).any():
                yield batch.filter(pa.array(kind != BLOB))
            for d in batch.filter(pa.array(kind == BLOB)).column("data"):
                s, n = unpack(d.as_py())
                sigs.append(s)
                nodes.append(n)
        if sigs:
            a, b, _ = stars(np.concatenate(sigs), np.concatenate(nodes))
            yield _rows(EDGE, np.zeros(len(a)), a=signed(a), b=signed(b))

    return written(docs.mapInArrow(run, SCAN).repartitionById(parts, F.col("p")).mapInArrow(gather, SCAN)
                   .drop("p", "data"), "jaccard-scan")


# -- large candidate families

REFINE = "p long, data binary, a long, b long"
#: Sets that are held for one shingle, in a task that sends and in one that compares; a radius without bound.
SENT, MET, ANY = 64, 1024, 1 << 30


def prefix(s: np.ndarray, common: np.ndarray, rule: Rule) -> np.ndarray:
    """The set's rarest shingles: linked sets, whatever their sizes, share one of them.

    Order: shingles that are not common by hash, then common ones in the order of
    ``common``'s second row (their places by count).
    """
    at, rank = common
    place = np.minimum(np.searchsorted(at, s), max(0, len(at) - 1))
    known = at[place] == s if len(at) else np.zeros(len(s), bool)
    order = np.lexsort((s, np.where(known, rank[place] + np.uint64(1), np.uint64(0)) if len(at) else np.zeros(len(s))))
    return s[order[:len(s) - -(-rule.num * len(s) // rule.den) + 1]]


def common_of_family(texts: DataFrame, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Common shingles of rows (node, text), ascending, and their places by count; see ``common_shingles``."""
    h = common_shingles(texts.select(F.col("node").alias("doc_id"), "text"), rule, with_count=True)
    order = np.argsort(h[0])
    rank = np.empty(len(h[0]), np.uint64)
    rank[np.lexsort((h[0], h[1]))] = np.arange(len(h[0]), dtype=np.uint64)
    return h[0][order], rank[order]


def led(bits: np.ndarray, size: np.ndarray, radius: np.ndarray, differ: int, rule: Rule, most: int):
    """(edges, leaders, their radii) of the sets that hold one shingle.

    A set within a quarter of ``differ`` of a leader is connected to it and
    stands aside: the leader's radius grows to hold it.  Sets that may link,
    by their sketches and radii, are connected.  Beyond ``most`` leaders all
    others are connected to the last one, whose radius is then without bound:
    more may be connected than can link, never less, and the number of rows
    stays in proportion to the sets.
    """
    rest, edges, out, radii = np.arange(len(size)), [], [], []
    while len(rest):
        i, others = rest[0], rest[1:]
        far = np.bitwise_count(bits[others] ^ bits[i]).sum(axis=1, dtype=np.int64) + radius[others]
        aside = far <= differ // 4
        mine = max(int(radius[i]), int(far[aside].max()) if aside.any() else 0)
        if len(out) + 1 >= most and not aside.all():
            mine, aside = ANY, np.ones(len(others), bool)
        reach = np.where(radius[others] + mine > 0, differ, size[i] + size[others] - 2 * rule.overlap(size[i], size[others]))
        near = far <= reach + mine + 2 * radius[others]
        edges.append((i, others[near | aside]))
        out.append(i)
        radii.append(mine)
        rest = others[~aside]
    return edges, out, radii


def by_key(key: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order by key, edges between the keys' runs)."""
    order = np.lexsort((own, key))
    return order, np.append(np.flatnonzero(np.concatenate(([True], key[order][1:] != key[order][:-1]))), len(key))


class Forest:
    """Edges that connect what was not connected before."""

    def __init__(self, nodes: list):
        self.names, self.of = np.unique(np.array(nodes, np.int64), return_inverse=True)
        self.label = np.arange(len(self.names))
        self.a: list[int] = []
        self.b: list[int] = []

    def add(self, edges, entries: np.ndarray) -> None:
        """Edges (i, all of some j) of rows ``entries``."""
        for i, to in edges:
            x, y = self.of[entries[i]], self.of[entries[to]]
            for k in np.flatnonzero(self.label[y] != self.label[x]):
                if self.label[y[k]] != self.label[x]:
                    self.a.append(int(self.names[x]))
                    self.b.append(int(self.names[y[k]]))
                    self.label[self.label == self.label[y[k]]] = self.label[x]

    def one(self, entries: np.ndarray) -> bool:
        label = self.label[self.of[entries]]
        return bool((label == label[0]).all())


def refine_rows(p=(), data=(), a=(), b=()) -> pa.RecordBatch:
    n = max(len(p), len(a))
    return pa.RecordBatch.from_arrays([pa.array(p, pa.int64()) if len(p) else pa.nulls(n, pa.int64()),
                                       pa.array(data, pa.binary()) if len(data) else pa.nulls(n, pa.binary()),
                                       pa.array(a, pa.int64()) if len(a) else pa.nulls(n, pa.int64()),
                                       pa.array(b, pa.int64()) if len(b) else pa.nulls(n, pa.int64())],
                                      names=["p", "data", "a", "b"])


def refined(texts: DataFrame, rule: Rule, parts: int) -> DataFrame:
    """Edges (a, b) between rows (node, text, n) that connect all that may link, and little else.

    Families that grew large through shared passages come apart here.  Sets
    that link share one of their rarest shingles, rarity being counted in the
    families themselves.  The sets of a task that hold a shingle are led by a
    few of them, and only leaders are sent, so a shingle that very many similar
    sets hold costs some rows a task.  Shingles are dealt into shares of about
    ``SHARE`` bytes; a task holds one share at a time.
    """
    spark = texts.sparkSession
    common = broadcast(spark, common_of_family(texts, rule))
    # a set of n shingles is held under n * (den - num) / den of them, with a sketch of some n / 2 bytes or less
    volume = texts.agg(F.sum((F.col("n") * (rule.den - rule.num) / rule.den + 1) * (F.col("n") / 2 + 48))).first()[0] or 0
    shares = parts * max(1, -(-int(volume) // (SHARE * parts)))

    def send(batches):
        hasher, often = SubstringHash(), common.value["data"]
        keys, owner, entries, held = [], [], [], 0

        def flush():
            key, own = np.concatenate(keys), np.concatenate(owner)
            forest = Forest([e[0] for e in entries])
            order, edge = by_key(key, own)
            size, count = np.array([e[1] for e in entries]), np.diff(edge)
            sent, radius = [order[edge[:-1][count == 1]]], [np.zeros(int((count == 1).sum()), np.int64)]
            for k in np.flatnonzero(count > 1):
                rows = order[edge[k]:edge[k + 1]]
                mine = own[rows]
                edges, lead, radii = led(np.stack([entries[e][2] for e in mine]), size[mine], np.zeros(len(mine), np.int64),
                                         entries[mine[0]][3], rule, SENT)
                forest.add(edges, mine)
                sent.append(rows[lead])
                radius.append(np.array(radii, np.int64))
            rows, radius = np.concatenate(sent), np.concatenate(radius)
            p = (key[rows] % np.uint64(shares)).astype(np.int64)
            order = np.argsort(p, kind="stable")
            edge = np.append(np.flatnonzero(np.concatenate(([True], np.diff(p[order]) != 0))), len(p))
            names, blobs = [], []
            for lo, hi in zip(edge[:-1], edge[1:]):
                at = order[lo:hi]
                mine, local = np.unique(own[rows[at]], return_inverse=True)
                names.append(int(p[at[0]]))
                blobs.append(zstandard.ZstdCompressor(level=1).compress(
                    pickle.dumps((key[rows[at]], local.astype(np.int32), radius[at].astype(np.int32), [entries[k] for k in mine]))))
                if len(blobs) >= 1000:
                    yield refine_rows(p=names, data=blobs)
                    names, blobs = [], []
            yield refine_rows(p=names, data=blobs)
            if forest.a:
                yield refine_rows(a=forest.a, b=forest.b)

        for batch in slices(batches):
            for node, text in zip(batch.column("node").to_pylist(), batch.column("text").to_pylist()):
                s = shingles(text, rule.words, hasher)
                rarest = prefix(s, often, rule)
                for c, hi in size_classes(len(s), rule):
                    differ = hi * (rule.den - rule.num) // rule.num
                    if differ:  # else only equal sets link
                        keys.append(mix64(rarest + mix64(np.array([c + 1], np.uint64))))
                        owner.append(np.full(len(rarest), len(entries)))
                        entries.append((node, len(s), np.frombuffer(sketch(s, differ), np.uint64), differ))
                        held += len(rarest)
                if len(entries) >= 4000 or held > FLUSH:
                    yield from flush()
                    keys, owner, entries, held = [], [], [], 0
        if entries:
            yield from flush()

    def share_edges(keys, owner, radii, entries):
        key, own, radius = np.concatenate(keys), np.concatenate(owner), np.concatenate(radii).astype(np.int64)
        forest, size = Forest([e[0] for e in entries]), np.array([e[1] for e in entries])
        order, edge = by_key(key, own)
        for k in np.flatnonzero(np.diff(edge) > 1):
            rows = order[edge[k]:edge[k + 1]]
            mine = own[rows]
            if not forest.one(mine):
                edges, _, _ = led(np.stack([entries[e][2] for e in mine]), size[mine], radius[rows], entries[mine[0]][3], rule, MET)
                forest.add(edges, mine)
        return refine_rows(a=forest.a, b=forest.b)

    def compare(batches):
        share, keys, owner, radii, entries = None, [], [], [], []
        for batch in batches:
            yield batch.filter(batch.column("a").is_valid())
            met = batch.filter(batch.column("a").is_null())
            for p, data in zip(met.column("p").to_pylist(), met.column("data")):
                if p != share and entries:
                    yield share_edges(keys, owner, radii, entries)
                    keys, owner, radii, entries = [], [], [], []
                share = p
                key, own, radius, more = pickle.loads(zstandard.ZstdDecompressor().decompress(data.as_py()))
                keys.append(key)
                owner.append(own + len(entries))
                radii.append(radius)
                entries += more
        if entries:
            yield share_edges(keys, owner, radii, entries)

    to = F.coalesce(F.pmod("p", F.lit(parts)), F.pmod("a", F.lit(parts))).cast("int")
    return written(texts.select("node", "text").mapInArrow(send, REFINE).repartitionById(parts, to).sortWithinPartitions("p")
                   .mapInArrow(compare, REFINE).select("a", "b"), "jaccard-refined")


# -- verification

class PrefixTree:
    """Prefix tree of sets in one global order, stored level by level.

    A level holds the next ``CHUNK`` elements of every distinct beginning.
    Sequences are sorted, so a node's sequences are the rows lo to hi; those
    that end in the node come first.
    """

    CHUNK = 24

    def __init__(self, sets: list[np.ndarray]):
        sizes = np.array([len(s) for s in sets])
        self.elements = np.unique(np.concatenate(sets))
        local = [np.searchsorted(self.elements, s) for s in sets]
        order = sorted(range(len(sets)), key=lambda i: local[i].astype(">u4").tobytes())
        self.rows, self.sizes = np.array(order), sizes[order]
        self.levels: list[dict] = []
        alive = np.arange(len(sets))  # rows that reach this level
        node_of = np.zeros(len(sets), np.int64)  # their node on the level above
        for at in range(0, int(sizes.max()), self.CHUNK):
            go = self.sizes[alive] > at
            alive, node_of = alive[go], node_of[go]
            chunk = np.full((len(alive), self.CHUNK), len(self.elements), np.int32)  # filled up with no element
            for k, r in enumerate(alive):
                part = local[order[r]][at:at + self.CHUNK]
                chunk[k, :len(part)] = part
            new = np.ones(len(alive), bool)
            new[1:] = (node_of[1:] != node_of[:-1]) | (chunk[1:] != chunk[:-1]).any(axis=1)
            first = np.flatnonzero(new)
            size = self.sizes[alive]
            ends = np.add.reduceat((size <= at + self.CHUNK).astype(np.int64), first)
            # children of a node lie side by side on the next level
            above = node_of[first]
            n_above = len(self.levels[-1]["lo"]) if self.levels else 1
            kids = np.searchsorted(above, np.arange(n_above + 1))
            if self.levels:
                self.levels[-1]["kids"] = kids
            self.levels.append({
                "chunk": chunk[first], "lo": alive[first], "hi": alive[np.append(first[1:], len(alive)) - 1] + 1, "ends": ends,
                "small": np.minimum.reduceat(size, first), "large": np.maximum.reduceat(size, first),
                "last": np.where(chunk[first] < len(self.elements), chunk[first], -1).max(axis=1), "kids": None})
            node_of = np.cumsum(new) - 1

    def partners(self, x: np.ndarray, rule: Rule, wanted: np.ndarray | None = None) -> np.ndarray:
        """Indices of the sets that link with x, of those that ``wanted`` marks."""
        n = len(x)
        has = np.zeros(len(self.elements) + 1, bool)
        here = np.searchsorted(self.elements, x)
        here = here[here < len(self.elements)]
        here = here[np.isin(self.elements[here], x)]
        has[here] = True
        upto = np.cumsum(has)  # elements of x up to and with each
        mask = np.ones(len(self.rows), bool) if wanted is None else wanted[self.rows]
        marked = np.concatenate(([0], np.cumsum(mask)))
        found = []
        nodes = np.arange(len(self.levels[0]["lo"]))
        common = np.zeros(len(nodes), np.int64)
        for depth, level in enumerate(self.levels, 1):
            small, large = level["small"][nodes], level["large"][nodes]
            keep = (marked[level["hi"][nodes]] > marked[level["lo"][nodes]]) \
                & (rule.den * large >= rule.num * n) & (rule.num * small <= rule.den * n)
            nodes, common, small, large = nodes[keep], common[keep], small[keep], large[keep]
            if not len(nodes):
                break
            common = common + has[level["chunk"][nodes]].sum(axis=1)
            deep = np.minimum(depth * self.CHUNK, large)
            rest = upto[-1] - upto[level["last"][nodes]]
            size = np.minimum(np.maximum(deep + rest, small), large)  # the size below with most to spare
            keep = common + np.minimum(size - deep, rest) >= rule.overlap(n, size)
            # sequences that end here, whose sizes may fall short of the level's end
            for k in np.flatnonzero(level["ends"][nodes]):
                lo = level["lo"][nodes[k]]
                for r in range(lo, lo + int(level["ends"][nodes[k]])):
                    if mask[r] and rule.linked(n, int(self.sizes[r]), int(common[k])):
                        found.append(self.rows[r])
            if level["kids"] is None:
                break
            nodes, common = nodes[keep], common[keep]
            start, count = level["kids"][nodes], level["kids"][nodes + 1] - level["kids"][nodes]
            common = np.repeat(common, count)
            nodes = np.arange(int(count.sum())) + np.repeat(start - (np.cumsum(count) - count), count)
        return np.array(found, np.int64)


def spanning_links(left: list[np.ndarray], right: list[np.ndarray] | None, rule: Rule) -> list[tuple[int, int]]:
    """Links that connect what any links among the sets connect.

    With ``right``, links between the two lists only; index len(left) on are
    those of right.  A set is compared only with those it is not connected to.
    """
    out, base = [], len(left) if right is not None else 0
    tree = PrefixTree(right if right is not None else left)
    label = np.arange(base + len(tree.rows))
    for i, x in enumerate(left):
        for j in tree.partners(x, rule, label[base:] != label[i]) + base:
            if label[i] != label[j]:
                out.append((i, int(j)))
                label[label == label[j]] = label[i]
    return out


def verified(groups: DataFrame, rule: Rule, parts: int) -> DataFrame:
    """Spanning links (a, b) of rows (g, two, side, node, text).

    A group g is compared within itself, or, where ``two``, side 0 with side 1.
    """

    def links(rows, two):
        side = {0: [], 1: []}
        for x, node, s in rows:
            side[x].append((node, s))
        if not side[0] or two and not side[1]:
            return []
        names = [n for n, _ in side[0] + side[1]]
        found = spanning_links([x for _, x in side[0]], [x for _, x in side[1]] if two else None, rule)
        return [(names[i], names[j]) for i, j in found]

    def run(batches):
        hasher, current, rows, two = SubstringHash(), None, [], False
        for b in slices(batches):
            out = []
            for g, t, side, node, text in zip(*(b.column(c).to_pylist() for c in ("g", "two", "side", "node", "text"))):
                if g != current:
                    out += links(rows, two)
                    current, rows, two = g, [], t
                rows.append((side, node, shingles(text, rule.words, hasher)))
            yield edge_batch(out)
        yield edge_batch(links(rows, two))

    def edge_batch(out):
        return pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in out], pa.int64()),
                                           "b": pa.array([x for _, x in out], pa.int64())})

    return written(groups.select("g", "two", "side", "node", "text").repartition(parts, "g")
                   .sortWithinPartitions("g", "side", "node").mapInArrow(run, "a long, b long"), "jaccard-links")


def _halves(members: DataFrame, blocks: str) -> DataFrame:
    """Each row of block i in every pair of blocks (i, j): side 0 for the smaller, both sides for (i, i)."""
    return (members.withColumn("j", F.explode(F.sequence(F.lit(0), F.col(blocks) - 1)))
            .withColumn("g", F.concat_ws(":", "comp", F.least("block", "j"), F.greatest("block", "j")))
            .withColumn("two", F.col("block") != F.col("j"))
            .withColumn("side", (F.col("block") > F.col("j")).cast("int")))


def sized(members: DataFrame) -> DataFrame:
    """Rows with (comp, n) and ``blocks``: how many tasks' shares their component makes; single rows leave."""
    sizes = written(members.groupBy("comp").agg(F.count("*").alias("size"), F.sum("n").alias("elements"))
                    .where(F.col("size") > 1)
                    .select("comp", F.ceil(F.greatest(F.col("size") / GROUP, F.col("elements") / ELEMENTS)).cast("int")
                            .alias("blocks")), "jaccard-sizes")
    return members.join(sizes, "comp")


def links(docs: DataFrame, members: DataFrame, rule: Rule, parts: int, pivots: int = 16) -> DataFrame:
    """Links (a, b) that connect the linked sets of each candidate component.

    members: (comp, node, n).  Components of one task's share are compared
    whole.  Larger ones are first refined by their rarest shingles.  What stays large is
    dealt into blocks: all blocks meet some pivots, then only the sets that no
    pivot connects to the largest part meet every block.
    """
    texts = docs.select("doc_id", "text")
    rows = sized(members)
    rows = written(texts.join(rows, texts.doc_id == rows.node).select("comp", "node", "n", "blocks", "text"), "jaccard-texts")
    first = rows
    out, rows = _whole(rows, rule, parts)
    if rows is None:
        drop_written(first)
        return out
    parted = components(refined(rows, rule, parts)).withColumnRenamed("component", "comp")
    rows = rows.drop("comp", "blocks").join(parted, "node")
    sizes = sized(rows.select("comp", "n")).select("comp", "blocks").distinct()
    second = rows = written(rows.join(sizes, "comp"), "jaccard-texts")
    drop_written(first)
    more, rows = _whole(rows, rule, parts)
    out = out.unionByName(more)
    if rows is not None:
        out = out.unionByName(_blockwise(rows, rule, parts, pivots))
    drop_written(second)
    return out


def _whole(rows: DataFrame, rule: Rule, parts: int) -> tuple[DataFrame, DataFrame | None]:
    """(links of the components of one block, rows of the larger ones or None)"""
    one = rows.where(F.col("blocks") == 1)
    out = verified(one.select(F.col("comp").cast("string").alias("g"), F.lit(False).alias("two"),
                              F.lit(0).alias("side"), "node", "text"), rule, parts)
    large = rows.where(F.col("blocks") > 1)
    return out, large if large.head(1) else None


def _blockwise(rows: DataFrame, rule: Rule, parts: int, pivots: int) -> DataFrame:
    big = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    turn = F.row_number().over(Window.partitionBy("comp").orderBy(F.xxhash64("node", F.lit(1)), "node"))
    heads = written(big.select("comp", "node").withColumn("turn", turn).where(F.col("turn") <= pivots)
                    .select("comp", "node"), "jaccard-pivots")
    meet = big.join(heads, ["comp", "node"], "left_semi")
    first = (meet.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("side", F.lit(0))
             .unionByName(big.withColumn("side", F.lit(1))))
    found = verified(first.select(F.concat_ws(":", "comp", "block").alias("g"), F.lit(True).alias("two"), "side", "node",
                                  "text"), rule, parts)
    held = written(big.select("comp", "node").join(components(found), "node", "left")
                   .withColumn("part", F.coalesce("component", "node")).select("comp", "node", "part"), "jaccard-parts")
    top = (held.groupBy("comp", "part").count()
           .groupBy("comp").agg(F.max_by("part", F.struct("count", "part")).alias("top")))
    rest = written(held.join(top, "comp").where(F.col("part") != F.col("top")).select("comp", "node", F.lit(True).alias("left")),
                   "jaccard-left")
    if not rest.head(1):
        return found
    n_rest = written(rest.groupBy("comp").agg(F.count("*").alias("n_rest")), "jaccard-rest")
    # the sets left over, in blocks of their own, against each other and against the largest part's blocks
    share = F.ceil(F.col("n_rest") / F.greatest(F.lit(1), F.least(F.lit(GROUP), F.floor(F.col("n_comp") / F.col("blocks")))))
    n_comp = written(held.groupBy("comp").agg(F.count("*").alias("n_comp")), "jaccard-rest")
    marked = (big.join(rest, ["comp", "node"], "left").join(n_rest, "comp").join(n_comp, "comp")
              .withColumn("left", F.coalesce("left", F.lit(False))).withColumn("rest_blocks", share.cast("int")))
    among = _halves(marked.where("left").withColumn("block", F.pmod(F.xxhash64("node"), F.col("rest_blocks")).cast("int")),
                    "rest_blocks").withColumn("g", F.concat_ws(":", F.lit("r"), "g"))
    pair = F.explode(F.sequence(F.lit(0), F.when(F.col("left"), F.col("blocks")).otherwise(F.col("rest_blocks")) - 1))
    against = (marked.withColumn("other", pair).withColumn("mine", F.pmod(F.xxhash64("node"), F.col("rest_blocks")).cast("int"))
               .withColumn("g", F.when(F.col("left"), F.concat_ws(":", F.lit("s"), "comp", "mine", "other"))
                           .otherwise(F.concat_ws(":", F.lit("s"), "comp", "other", "block")))
               .withColumn("two", F.lit(True)).withColumn("side", (~F.col("left")).cast("int")))
    cols = ["g", "two", "side", "node", "n", "text"]
    return found.unionByName(in_rounds(among.select(cols).unionByName(against.select(cols)), big, rule, parts))


def in_rounds(groups: DataFrame, once: DataFrame, rule: Rule, parts: int) -> DataFrame:
    """``verified`` of whole groups, some at a time: the copies of texts that lie on disk at once stay in proportion to ``once``."""
    copied, own = (x.agg(F.sum("n")).first()[0] or 0 for x in (groups, once))
    rounds = max(1, -(-copied // max(own, ROUND)))
    turn = F.pmod(F.xxhash64("g", F.lit(3)), F.lit(rounds))
    out = [verified(groups.where(turn == i) if rounds > 1 else groups, rule, parts) for i in range(rounds)]
    return reduce(DataFrame.unionByName, out)


def join(docs: DataFrame, rule: Rule = Rule(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable by links).

    An empty or null text has no shingles and is linked with nothing.  A null
    id takes part in no link and has a null component.  Equal texts and
    repeated rows link; rows that share an id are one document.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    common = broadcast(docs.sparkSession, common_shingles(docs, rule))
    seen = scan(docs, rule, parts, common)
    rows = seen.where(F.col("kind") == DOC).select("doc_id", "n", "k")
    sets = written(rows.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
                   .groupBy("k").agg(F.min("doc_id").alias("node"), F.max("n").alias("n")), "jaccard-sets")
    near = components(seen.where(F.col("kind") == EDGE).select("a", "b"))
    members = sets.withColumn("name", F.col("k").bitwiseAND(F.lit((1 << 48) - 1))).join(
        near.withColumnRenamed("node", "name"), "name").groupBy("component", "node").agg(F.max("n").alias("n"))
    members = written(members.withColumnRenamed("component", "comp"), "jaccard-members")
    final = components(links(docs, members, rule, parts))
    labels = written(sets.join(final, "node", "left").select("k", F.coalesce("component", "node").alias("component_id")),
                     "jaccard-labels")
    out = rows.join(labels, "k", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
                      .otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, rule: Rule, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their component: its smallest id, once.

    Rows that share this id but not its text all stay, and so do rows without an id.
    """
    found = join(docs, rule, doc_id, text)
    keep = written(found.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("_keep")).distinct(),
                   "jaccard-keep")
    named = docs.where(F.col(doc_id).isNotNull())
    stay = named.join(keep, named[doc_id] == keep["_keep"], "left_semi")
    others = [c for c in docs.columns if c not in (doc_id, text)]
    # of equal rows by id and text the least in its other columns, so that reruns agree
    once = stay.groupBy(doc_id, text).agg(F.min(F.struct(*others)).alias("_rest")) if others else stay.distinct()
    once = once.select(*[F.col(f"_rest.{c}") if c in others else F.col(c) for c in docs.columns])
    return once.unionByName(docs.where(F.col(doc_id).isNull()))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))


ORACLE_OP6 = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS a FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(a[i + 1:i + least(len(a), 3)], ' ') AS sh
      FROM w, unnest(range(greatest(1, len(a) - 2))) AS u(i) WHERE len(a) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 90 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(doc_id, root) AS (SELECT a, a FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id),
c AS (SELECT doc_id, min(root) AS root FROM r GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.root, w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""
