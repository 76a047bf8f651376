"""Language identification by cross-parsing (operator 7).

For each language a suffix automaton of labelled text; a document is cut
greedily into the longest phrases that occur in that text, and the language
that needs the fewest phrases wins.  All documents of a batch walk through
the automata in step, cut into lanes of equal length; a lane goes on in the
state in which the one before it ended.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from landfall.llm.common import broadcast, crc_mod, kept, slices, table, written

#: Labelled texts per language, bytes taken of each and at how many places, and languages of one table of transitions.
TEXTS, TEXT_BYTES, PLACES, TABLE_LANGUAGES = 64, 512, 2, 16
#: Lanes: bytes of text each, bytes before it that give the state to start from, and lanes in step.
LANE, WARM, LANES = 512, 64, 4096
LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    """Whether a letter occurs; numbers such as fractions, which the pattern takes too, are none."""
    return any(m[0].isalpha() for m in LETTER.finditer(text or ""))


def normal(text: str | None) -> bytes:
    """Lower-cased; digits, punctuation and white space are one blank."""
    return re.sub(r"[\W\d_]+", " ", (text or "").lower()).encode("utf-8", "replace")


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings; state 0 is the start."""
    nxt: list[dict] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                twin = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return nxt


class CrossParser:
    """The languages' automata as one table of transitions: state times symbol to state, 0 for none.

    Symbols are the bytes seen in training; all others share symbol 0, which
    no automaton knows, so each of them is a phrase by itself.
    """

    def __init__(self, samples: dict[str, bytes]):
        self.languages = sorted(samples)
        seen = sorted(set(b"".join(samples.values())))
        self.symbol = np.zeros(256, np.uint8)
        self.symbol[seen] = np.arange(1, len(seen) + 1)
        self.width = len(seen) + 1
        rows, self.roots = 1, []  # state 0: nowhere
        automata = [suffix_automaton(samples[x]) for x in self.languages]
        self.table = np.zeros((1 + sum(map(len, automata)), self.width), np.int32)
        for a in automata:
            self.roots.append(rows)
            at, sym, to = [], [], []
            for state, edges in enumerate(a):
                for c, t in edges.items():
                    at.append(rows + state)
                    sym.append(self.symbol[c])
                    to.append(rows + t)
            self.table[at, sym] = to
            rows += len(a)
        self.table = self.table.ravel()

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Phrases needed: a row per text, a column per language.

        All lanes walk at once.  A lane's first state is guessed by walking the
        bytes before it; where that is not the state in which the lane before
        ended, the lane is walked again from there, until all agree.  Equal
        states go on alike, so the counts are those of one walk over the text.
        """
        lanes = [(i, s) for i, t in enumerate(texts) for s in range(0, len(t), LANE)]
        owner = np.array([i for i, _ in lanes], np.int64)
        follows = np.array([s > 0 for _, s in lanes], bool)
        began, ended, count = np.zeros((3, len(self.languages), len(lanes)), np.int32)
        order = np.argsort([min(LANE, len(texts[i]) - s) + min(WARM, s) for i, s in lanes], kind="stable")  # like lengths together
        for k in range(0, len(order), LANES):
            at = order[k:k + LANES]
            warm = np.array([min(WARM, lanes[j][1]) for j in at])
            symbols, lengths = self._symbols([texts[i][max(0, s - WARM):s + LANE] for i, s in (lanes[j] for j in at)])
            for lang in range(len(self.languages)):
                began[lang, at], ended[lang, at], count[lang, at] = self._walk(lang, symbols, lengths, warm, np.zeros(len(at), np.int32))
        for lang in range(len(self.languages)):
            while True:
                wrong = np.zeros(len(lanes), bool)
                wrong[1:] = follows[1:] & (began[lang, 1:] != ended[lang, :-1])
                todo = np.flatnonzero(wrong & ~np.concatenate(([False], wrong[:-1])))  # those behind a wrong one wait for it
                if not len(todo):
                    break
                for k in range(0, len(todo), LANES):
                    at = todo[k:k + LANES]
                    symbols, lengths = self._symbols([texts[i][s:s + LANE] for i, s in (lanes[j] for j in at)])
                    state = ended[lang, at - 1]
                    began[lang, at], ended[lang, at], count[lang, at] = self._walk(lang, symbols, lengths, np.zeros(len(at), np.int64), state)
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        np.add.at(out, owner, count.T)
        return out

    def _symbols(self, data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols, a row per place and a column per lane, and the lanes' lengths."""
        lengths = np.array([len(x) for x in data])
        width = int(lengths.max())
        lanes = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in data), np.uint8).reshape(-1, width)
        return np.ascontiguousarray(self.symbol[lanes].T).astype(np.int32), lengths

    def _walk(self, lang: int, symbols: np.ndarray, lengths: np.ndarray, warm: np.ndarray, state: np.ndarray):
        """(state before the first counted byte, last state, phrases begun); the ``warm`` first bytes do not count."""
        first, began, count = self.roots[lang] * self.width, state, np.zeros(len(lengths), np.int32)
        shortest, warmest = int(lengths.min()), int(warm.max())
        for t, s in enumerate(symbols):
            to = self.table[state * self.width + s]
            cut = to == 0  # the phrase ends: start anew with this symbol
            to = np.where(cut, self.table[first + s], to)
            if t >= shortest:  # padding makes no phrase and moves no state
                cut &= lengths > t
                to = np.where(lengths > t, to, state)
            if t <= warmest:
                began = np.where(warm == t, state, began)
                cut &= warm <= t
            count += cut
            state = to
        return began, state, count


def pieces(norm: bytes, seed: int) -> bytes:
    """``TEXT_BYTES`` bytes of a normalised text, from ``PLACES`` equal parts of it, each at a place given by ``seed``.

    A text of at most so many bytes is taken whole.  No phrase spans two
    pieces: \\n is not in a normal text.
    """
    if len(norm) <= TEXT_BYTES:
        return norm
    size, part, out = TEXT_BYTES // PLACES, len(norm) // PLACES, []
    for k in range(PLACES):
        at = k * part + seed % (part - size + 1)
        out.append(norm[at:at + size])
    return b"\n".join(out)


def samples(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """Training text of every language, at most ``TEXTS`` rows of ``TEXT_BYTES`` bytes each.

    Taken from rows outside the held-out third with a language and a letter,
    by smallest id hash; the bytes come from places all over the text, chosen
    by a hash of the id.  Of rows that share id and language the least piece
    counts.  Null ids and null languages teach nothing.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    usable = rows.where(F.col("lang").isNotNull() & (crc_mod("doc_id", 3) != 1) & F.col("text").rlike(r"\p{L}"))
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    # equal ids of a language first count as one, so a row repeated very often takes one place
    ids = usable.select("lang", "doc_id").distinct()
    chosen = ids.withColumn("k", F.row_number().over(first)).where(F.col("k") <= TEXTS).select("doc_id", "lang")

    def run(batches):
        for b in slices(batches):
            taken = [pieces(normal(t), h) if has_letter(t) else None
                     for t, h in zip(b.column("text").to_pylist(), b.column("h").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("h"), pa.array(taken, pa.binary())], names=["lang", "h", "piece"])

    got = (usable.join(F.broadcast(chosen), ["doc_id", "lang"])
           .select("lang", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 40)).alias("h"), "text")
           .mapInArrow(run, f"lang {rows.schema['lang'].dataType.simpleString()}, h long, piece binary")
           .where(F.col("piece").isNotNull()).groupBy("lang", "h").agg(F.min("piece").alias("piece")).collect())  # TEXTS a language at most
    out: dict[str, list[bytes]] = {}
    for r in sorted(got, key=lambda r: (r["lang"], r["h"])):
        out.setdefault(r["lang"], []).append(bytes(r["piece"]))
    return {k: b"\n".join(v) for k, v in out.items()}


def parsed(docs: DataFrame, training: dict[str, bytes], kind: str) -> DataFrame:
    """Rows (doc_id, text) against the languages of one table: doc_id, known, size, pred, best, second phrase counts.

    ``second`` is null with one language; ``size`` is that of the normalised text.
    """
    b = broadcast(docs.sparkSession, training)

    def run(batches):
        parser = kept(b, lambda data: CrossParser(data) if data else None)
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            known = [bool(parser) and has_letter(t) for t in texts]
            norm = [normal(t) if k else b"" for t, k in zip(texts, known)]
            need = parser.phrases(norm) if parser else np.zeros((len(texts), 1), np.int64)
            order = np.sort(need, axis=1)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "known": pa.array(known, pa.bool_()),
                "size": pa.array([len(x) for x in norm], pa.int64()),
                "pred": pa.array([parser.languages[p] if k else "und" for p, k in zip(need.argmin(axis=1), known)], pa.string()),
                "best": pa.array(order[:, 0]),
                "second": pa.array(order[:, 1]) if need.shape[1] > 1 else pa.nulls(len(texts), pa.int64())})

    return docs.mapInArrow(run, f"doc_id {kind}, known boolean, size long, pred string, best long, second long")


def predict(docs: DataFrame, training: dict[str, bytes], doc_id: str = "doc_id", text: str = "text",
            table_languages: int = TABLE_LANGUAGES) -> DataFrame:
    """A row per document: lang_pred, score, phrases per normalised byte.

    ``und`` for a null text, one without a letter, or when nothing was
    learned.  Ties go to the language first in code-point order.  More
    languages than ``table_languages`` make several tables of transitions;
    each reads the texts, and a document's counts are brought together.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    names = sorted(training)
    groups = [{x: training[x] for x in names[k:k + table_languages]} for k in range(0, len(names), table_languages)]
    if len(groups) <= 1:
        found = parsed(rows, training, kind)
    else:
        # the texts get a number each; a worker holds one table at a time
        rows = written(rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text"), "languages")
        each = None
        for g in groups:
            one = written(parsed(rows.select(F.col("rid").alias("doc_id"), "text"), g, "bigint"), "language-counts")
            each = one if each is None else each.unionByName(one)
        counts = F.array_sort(F.filter(F.flatten(F.collect_list(F.array("best", "second"))), lambda x: x.isNotNull()))
        merged = each.groupBy(F.col("doc_id").alias("rid")).agg(
            F.first("known").alias("known"), F.first("size").alias("size"),
            F.min_by("pred", F.struct("best", "pred")).alias("pred"), counts.alias("counts"))
        found = rows.select("rid", "doc_id").join(merged, "rid").select(
            "doc_id", "known", "size", "pred", F.element_at("counts", 1).alias("best"), F.element_at("counts", 2).alias("second"))
    best, second = F.col("best"), F.coalesce("second", F.col("best") * 2)
    return found.select("doc_id", F.col("pred").alias("lang_pred"),
                        F.when(F.col("known"), second / F.greatest(F.lit(1), best + second)).otherwise(F.lit(0.0)).alias("score"),
                        (best / F.greatest(F.lit(1), "size")).alias("entropy"))


def op7(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, samples(docs)).select(
        "doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "entropy")
