"""Language-model score over a subword lattice (operator 9).

The pieces of an existing vocabulary weigh all segmentations of a word; a
forward recursion in log space sums them.  Their probabilities start from the
vocabulary's own order and are fitted to the corpus by a few steps of
expectation and maximisation over its word counts.  Segmentations never cross
white space, so a document's probability is the product over its words, and
each distinct word is worked out once for the whole corpus.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm.common import SubstringHash, broadcast, crc_mod, kept, mix64, most_frequent, signed, slices, table, written
from landfall.llm.jaccard import LOWER

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Words that every task holds (the most frequent); the rest are joined.
HEAD = 1 << 19
#: Groups of training rows with counts of their own.
MAX_GROUPS = 8
#: Distinct words that a task counts before it hands them on, and words of a lattice block.
FLUSH, BLOCK = 300_000, 4096
SMOOTH = 0.1
#: Steps of expectation and maximisation.
STEPS = 3
LOG10 = np.log(10.0)


def vocabulary(path: str = VOCABULARY) -> list[bytes]:
    """The pieces as bytes in the order of the file's scores, best first; a word begins with a blank."""
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for i in sorted(range(m.get_piece_size()), key=lambda i: (-m.get_score(i), i)):
        if m.is_control(i) or m.is_unknown(i) or m.is_unused(i):
            continue
        p = m.id_to_piece(i)
        out.append(bytes([int(p[3:5], 16)]) if m.is_byte(i) else p.replace("▁", " ").encode())
    seen = dict.fromkeys(out)
    # any byte can be spelled, and no piece runs over a blank inside
    seen.update(dict.fromkeys(bytes([c]) for c in range(256)))
    return [p for p in seen if b" " not in p[1:]]


def rank_log_probabilities(n: int) -> np.ndarray:
    """Probabilities that fall as the inverse of the rank."""
    p = 1.0 / (np.arange(n) + 10.0)
    return np.log(p / p.sum())


class Lattice:
    """Sums over segmentations of words into pieces, a block of equally long words at a time."""

    def __init__(self, pieces: list[bytes], logp: np.ndarray):
        self.pieces, self.logp = pieces, logp
        self.longest = max(map(len, pieces))
        self.hasher = SubstringHash()
        h = np.array([self._hash(p) for p in pieces], np.uint64)
        order = np.argsort(h)
        self.sorted, self.order = h[order], order
        # direct table of 2**20 slots; pieces that share a slot are found in the sorted list
        slot = (h >> np.uint64(44)).astype(np.int64)
        self.slots = np.full(1 << 20, -1, np.int32)
        self.slots[slot] = np.arange(len(h), dtype=np.int32)
        shared = np.bincount(slot, minlength=1 << 20) > 1
        self.slots[shared] = -2
        self.hash = h

    def _hash(self, p: bytes) -> int:
        a = np.frombuffer(p, np.uint8)
        return int(self.hasher.ranges(self.hasher.sums(a), np.array([0]), np.array([len(a)]))[0])

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece number of each hash, -1 for none."""
        i = self.slots[(h >> np.uint64(44)).astype(np.int64)]
        many = np.flatnonzero(i == -2)
        if len(many):
            at = np.minimum(np.searchsorted(self.sorted, h[many]), len(self.sorted) - 1)
            i[many] = np.where(self.sorted[at] == h[many], self.order[at], -1)
        ok = i >= 0
        i[ok & (self.hash[np.maximum(i, 0)] != h)] = -1
        return i

    def edges(self, words: np.ndarray) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
        """For each end position the (start, rows, their pieces) of the lattice over rows of equal length."""
        n, width = words.shape
        self.hasher._grow(width + 1)
        sums = np.zeros((n, width + 1), np.uint64)
        np.cumsum(self.hasher.table[words] * self.hasher.power[:width], axis=1, out=sums[:, 1:])
        out = []
        for end in range(1, width + 1):
            here = []
            for start in range(max(0, end - self.longest), end):
                i = self.find(mix64((sums[:, end] - sums[:, start]) * self.hasher.unpower[start]))
                at = np.flatnonzero(i >= 0)
                if len(at):
                    here.append((start, at, i[at]))
            out.append(here)
        return out

    def forward(self, words: np.ndarray, edges=None) -> np.ndarray:
        """Log sums of all segmentations of each beginning: a column per position."""
        n, width = words.shape
        alpha = np.full((width + 1, n), -np.inf)
        alpha[0] = 0.0
        for end, here in enumerate(edges or self.edges(words), 1):
            for start, at, i in here:
                alpha[end, at] = np.logaddexp(alpha[end, at], alpha[start, at] + self.logp[i])
        return alpha

    def expected(self, words: np.ndarray, count: np.ndarray, into: np.ndarray) -> None:
        """Add the expected uses of each piece in the words, times their counts."""
        n, width = words.shape
        edges = self.edges(words)
        alpha = self.forward(words, edges)
        beta = np.full((width + 1, n), -np.inf)
        beta[width] = 0.0
        for end in range(width, 0, -1):
            for start, at, i in edges[end - 1]:
                beta[start, at] = np.logaddexp(beta[start, at], self.logp[i] + beta[end, at])
        pieces, uses = [], []
        for end in range(1, width + 1):
            for start, at, i in edges[end - 1]:
                pieces.append(i)
                uses.append(np.exp(alpha[start, at] + self.logp[i] + beta[end, at] - alpha[width, at]) * count[at])
        into += np.bincount(np.concatenate(pieces), np.concatenate(uses), len(into))

    def log_probability(self, words: list[bytes]) -> np.ndarray:
        """Natural log of each word's sum over segmentations."""
        out = np.zeros(len(words))
        for at, block in self.blocks(words):
            out[at] = self.forward(block)[-1]
        return out

    @staticmethod
    def blocks(words: list[bytes]):
        """(places, matrix) of words of equal length, each with its blank in front."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(size, kind="stable")
        cut = np.flatnonzero(np.diff(size[order])) + 1
        for same in np.split(order, cut) if len(order) else []:
            width = int(size[same[0]])
            step = max(1, BLOCK * 16 // (width + 16))
            for k in range(0, len(same), step):
                at = same[k:k + step]
                yield at, np.frombuffer(b"".join(b" " + words[i] for i in at), np.uint8).reshape(len(at), width + 1)


def joined(batches, rows: int = 200_000):
    """Batches of words joined to large ones, so that blocks of equal length are long."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(LOWER).split()


def hash_words(words: list[bytes], hasher: SubstringHash) -> np.ndarray:
    a = np.frombuffer(b" ".join(words), np.uint8)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return hasher.ranges(hasher.sums(a), starts, ends)


def word_counts(docs: DataFrame, parts: int, n_groups: int) -> DataFrame:
    """(word, n, seen, by) of all documents, a written table.

    n counts the training rows, by those of each group, seen all rows.  Tasks
    count first and hand on sorted, compressed lists by shard.
    """

    def count(batches):
        found: dict[bytes, list[int]] = {}

        def flush():
            c = zstandard.ZstdCompressor(level=1)
            shards: list[list] = [[] for _ in range(parts)]
            for w in sorted(found):
                shards[zlib.crc32(w) % parts].append(w)
            out = [(p, c.compress(np.array([len(ws)], np.int64).tobytes()
                                  + np.array([found[w] for w in ws], np.int64).T.tobytes() + b"\n".join(ws)))
                   for p, ws in enumerate(shards) if ws]
            return pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.int32()),
                                               pa.array([d for _, d in out], pa.binary())], names=["p", "data"])

        for b in slices(batches):
            for t, train, g in zip(*(b.column(c).to_pylist() for c in ("text", "train", "g"))):
                for w in words_of(t):
                    c = found.get(w)
                    if c is None:
                        found[w] = c = [0] * (1 + n_groups)
                    c[0] += 1
                    c[1 + g] += train
                if len(found) > FLUSH:
                    yield flush()
                    found = {}
        if found:
            yield flush()

    def merge(batches):
        d, place, total = zstandard.ZstdDecompressor(), {}, np.zeros((0, 1 + n_groups), np.int64)
        for b in batches:
            for data in b.column("data").to_pylist():
                raw = d.decompress(data)
                n = int(np.frombuffer(raw, np.int64, 1)[0])
                counts = np.frombuffer(raw, np.int64, n * (1 + n_groups), 8).reshape(1 + n_groups, n).T
                ids = np.array([place.setdefault(w, len(place)) for w in raw[8 * (1 + n * (1 + n_groups)):].split(b"\n")])
                if len(place) > len(total):
                    total = np.concatenate([total, np.zeros((len(place), 1 + n_groups), np.int64)])  # twice as many or more
                total[ids] += counts  # a list holds a word once
        words = list(place)
        for k in range(0, len(words), 100_000):
            ws, c = words[k:k + 100_000], total[k:min(k + 100_000, len(words))]
            by = pa.ListArray.from_arrays(np.arange(0, n_groups * len(ws) + 1, n_groups, np.int32), pa.array(c[:, 1:].ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(ws, pa.binary()), pa.array(c[:, 1:].sum(axis=1)), pa.array(c[:, 0].copy()),
                                              by], names=["word", "n", "seen", "by"])

    return written(docs.select("text", "train", "g").mapInArrow(count, "p int, data binary").repartitionById(parts, F.col("p"))
                   .mapInArrow(merge, "word binary, n long, seen long, by array<long>"), "lm-words")


def fitted(words: DataFrame, pieces: list[bytes]) -> np.ndarray:
    """Log probabilities of the pieces: their expected share over the training words, smoothed, in ``STEPS`` steps."""
    logp = rank_log_probabilities(len(pieces))
    for _ in range(STEPS):
        total = SMOOTH + expected_uses(words, pieces, logp)
        logp = np.log(total / total.sum())
    return logp


def expected_uses(words: DataFrame, pieces: list[bytes], logp: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over the training words, each task's summed first."""
    b = broadcast(words.sparkSession, (pieces, logp))

    def run(batches):
        lattice = Lattice(*b.value["data"])
        total = np.zeros(len(lattice.pieces))
        for batch in joined(batches):
            ws, n = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            for at, block in lattice.blocks(ws):
                lattice.expected(block, n[at].astype(float), total)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["piece", "n"])

    rows = (words.where(F.col("n") > 0).mapInArrow(run, "piece long, n double").groupBy("piece")
            .agg(F.sum("n").alias("n")).collect())  # a row per piece of the vocabulary at most
    total = np.zeros(len(pieces))
    for r in rows:
        total[r["piece"]] += r["n"]
    return total


class Estimate:
    """Log probabilities of words from their counts.

    A group's word is emitted whole with the share of seen tokens N / (N + V),
    else it falls back to all groups' counts in the same way, and from there
    to the word's spelling in pieces.
    """

    def __init__(self, tokens: int, types: int, group_tokens: list[int], group_types: list[int], prior: list[float]):
        self.tokens, self.types = tokens, types
        self.group_tokens, self.group_types = np.array(group_tokens), np.array(group_types)
        self.prior = np.array(prior)

    def words(self, n, by, spelled) -> np.ndarray:
        """log10 probabilities, a row per word and a column per group."""
        with np.errstate(divide="ignore"):
            plain = self._mix(np.asarray(n)[:, None], self.tokens, self.types, np.asarray(spelled)[:, None] * LOG10)
            return self._mix(np.asarray(by), self.group_tokens, self.group_types, plain) / LOG10

    @staticmethod
    def _mix(n, tokens, types, rest):
        seen = tokens + types
        return np.logaddexp(np.log(n / np.maximum(1, seen)), np.log(np.maximum(types, seen == 0) / np.maximum(1, seen)) + rest)

    def base(self, n):
        return np.log10(np.asarray(n) + SMOOTH) - np.log10(self.tokens + SMOOTH * (self.types + 1))


class Model:
    """Word counts and lattice probabilities of all distinct words, and the estimates made of them."""

    def __init__(self, docs: DataFrame, pieces: list[bytes], parts: int, n_groups: int, head: int = HEAD):
        """docs: (doc_id, text, train, g), g being the number of the row's group."""
        spark = docs.sparkSession
        counts = word_counts(docs, parts, n_groups)
        ends = {r["g"]: r["n"] for r in docs.where("train").groupBy("g").agg(F.count("*").alias("n")).collect()}
        self.ends = [ends.get(g, 0) for g in range(n_groups)]
        s = counts.agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("v"),
                       *[f(F.col("by")[g]).alias(f"{k}{g}") for g in range(n_groups)
                         for k, f in (("n", F.sum), ("v", lambda c: F.count_if(c > 0)))]).first()
        n_ends = sum(self.ends)
        self.estimate = Estimate(
            (s["n"] or 0) + n_ends, s["v"] + (n_ends > 0),
            [(s[f"n{g}"] or 0) + e for g, e in enumerate(self.ends)], [s[f"v{g}"] + (e > 0) for g, e in enumerate(self.ends)],
            [(e + SMOOTH) / (n_ends + SMOOTH * n_groups) for e in self.ends])
        b = broadcast(spark, (pieces, fitted(counts, pieces)))

        def spell(batches):
            lattice, hasher = kept(b, lambda data: Lattice(*data)), SubstringHash()
            for batch in joined(batches):
                ws = batch.column("word").to_pylist()
                yield pa.RecordBatch.from_arrays([
                    pa.array(signed(hash_words(ws, hasher))), batch.column("n"), batch.column("seen"), batch.column("by"),
                    pa.array(lattice.log_probability(ws) / LOG10)], names=["h", "n", "seen", "by", "spelled"])

        self.words = written(counts.mapInArrow(spell, "h long, n long, seen long, by array<long>, spelled double"), "lm-spelled")
        often = most_frequent(self.words, "seen", head)
        self.head = often.select("h", "n", "by", "spelled").toArrow()  # at most ``head`` rows


def counts_by_group(column, n_groups: int) -> np.ndarray:
    """An array<long> column as a matrix."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy().reshape(-1, n_groups)


def score(docs: DataFrame, vocabulary_path: str = VOCABULARY, doc_id: str = "doc_id", text: str = "text",
          group: str | None = "lang", held_out: int = 10, head: int = HEAD) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, lattice_score.

    Rows whose crc32 of the id is divisible by ``held_out`` teach nothing, nor
    do rows without an id.  A null text is empty and has one token, its end.
    Scores are log10.  ``score`` sums over the groups a text may come from:
    each training row's group says which counts it adds to, and a text is
    scored without its own; the ``MAX_GROUPS`` most frequent values have
    counts of their own, all others and null are one group.  lattice_score
    spells every word in pieces.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       (F.col(group).cast("string") if group else F.lit(None).cast("string")).alias("group"),
                       F.coalesce(crc_mod(doc_id, held_out) != 0, F.lit(False)).alias("train"))
    names = [r["group"] for r in docs.where("train AND group IS NOT NULL").groupBy("group").count()
             .orderBy(F.desc("count"), "group").limit(MAX_GROUPS).collect()]
    place = F.lit(len(names))
    for i, name in enumerate(names):
        place = F.when(F.col("group") == name, i).otherwise(place)
    docs, n_groups = docs.withColumn("g", place.cast("int")), len(names) + 1
    model = Model(docs, vocabulary(vocabulary_path), parts, n_groups, head)
    estimate = model.estimate
    h = model.head.column("h").to_numpy().view(np.uint64)
    order = np.argsort(h)
    n, spelled = model.head.column("n").to_numpy()[order], model.head.column("spelled").to_numpy()[order]
    by = counts_by_group(model.head.column("by"), n_groups)[order]
    values = np.column_stack([n > 0, estimate.base(n), spelled, estimate.words(n, by, spelled)])
    b = broadcast(spark, (h[order], values))
    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = ["known", "base", "spelled", *[f"word{g}" for g in range(n_groups)]]
    types = ", ".join(f"{c} double" for c in columns)

    def run(batches):
        hasher, (h, values) = SubstringHash(), b.value["data"]
        for batch in slices(batches):
            n, sums, tail = [], [], []
            for t in batch.column("text").to_pylist():
                ws = words_of(t)
                n.append(len(ws))
                x = hash_words(ws, hasher) if ws else np.zeros(0, np.uint64)
                at = np.minimum(np.searchsorted(h, x), max(0, len(h) - 1))
                got = h[at] == x if len(h) else np.zeros(len(x), bool)
                sums.append(values[at[got]].sum(axis=0))
                tail.append(signed(x[~got]))
            sums = np.array(sums).reshape(-1, len(columns))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(tail, pa.list_(pa.int64())),
                 *(pa.array(sums[:, j].copy()) for j in range(len(columns)))], names=["doc_id", "n", "tail", *columns])

    rows = written(docs.mapInArrow(run, f"doc_id {kind}, n long, tail array<long>, {types}")
                   .withColumn("rid", F.monotonically_increasing_id()), "lm-rows")
    data = (estimate.tokens, estimate.types, estimate.group_tokens.tolist(), estimate.group_types.tolist(), estimate.prior.tolist())

    def finish(batches):
        e = Estimate(*data)
        for batch in batches:
            n, s = batch.column("n").to_numpy(), batch.column("spelled").to_numpy()
            if len(n):
                word = e.words(n, counts_by_group(batch.column("by"), n_groups), s)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("h"), pa.array((n > 0).astype(float)), pa.array(e.base(n)), batch.column("spelled"),
                     *(pa.array(word[:, g].copy()) for g in range(n_groups))], names=["h", *columns])

    tail = rows.select("rid", F.explode("tail").alias("h"))
    sums = (tail.join(model.words.mapInArrow(finish, f"h long, {types}"), "h").groupBy("rid")
            .agg(*[F.sum(c).alias(f"t_{c}") for c in columns]))
    all_ = rows.drop("tail").join(sums, "rid", "left")

    def total(c):
        return F.col(c) + F.coalesce(F.col(f"t_{c}"), F.lit(0.0))

    # the end of a text is a word that cannot be spelled
    n_ends = sum(model.ends)
    with np.errstate(divide="ignore"):
        end = estimate.words(np.array([n_ends]), np.array([model.ends]), np.array([-20.0]))[0]
    ways = [total(f"word{g}") + F.lit(float(end[g] + np.log10(estimate.prior[g]))) for g in range(n_groups)]
    best = F.greatest(*ways) if n_groups > 1 else ways[0]
    summed = best + F.log10(sum((F.pow(F.lit(10.0), w - best) for w in ways), F.lit(0.0)))
    return all_.select("doc_id", F.coalesce(crc_mod("doc_id", held_out) == 0, F.lit(False)).alias("held_out"),
                       (F.col("n") + 1).alias("n_tokens"),
                       (total("known").cast("long") + F.lit(int(n_ends > 0))).alias("n_known"),
                       F.lit(estimate.tokens).cast("long").alias("train_tokens"),
                       (total("base") + F.lit(float(estimate.base(n_ends)))).alias("base_score"),
                       summed.alias("score"), (total("spelled") + F.lit(float(end.max()))).alias("lattice_score"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
