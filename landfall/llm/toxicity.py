"""Toxicity by a weighted lexicon (operator 1).

Texts are folded (case, homoglyphs, digits standing for letters), an
Aho-Corasick automaton finds lexicon terms at word starts, exception phrases
cancel the terms inside them, and the summed weights are normalised by length
and turned into a probability.  The lexicon, its weights and the exceptions
are learned from a bounded sample of labelled rows.
"""

from __future__ import annotations

import math
import re
from dataclasses import asdict, dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import broadcast, crc_mod, kept, slices, table, written

#: Labelled rows that the lexicon is learned from (those of smallest id hash).
MAX_LABELLED = 20_000
#: Longest prefix tried as a term, and terms and exception phrases kept.
PREFIX, MAX_TERMS, MAX_EXCEPTIONS = (3, 8), 400, 400

#: Characters that look like the letter they stand before (fixed values).
LOOKALIKES = {"a": "аαɑ@4", "b": "ьβ", "c": "сϲ", "d": "ԁ", "e": "еε3", "g": "ɡ9", "h": "һ", "j": "ј", "k": "кκ",
              "l": "iі1|!ιӏ", "m": "м", "n": "ո", "o": "оοσ0", "p": "рρ", "q": "ԛ", "s": "ѕ5$", "t": "т7τ",
              "u": "υ", "v": "ѵν", "w": "ԝ", "x": "хχ", "y": "уγ", "z": "2"}
FOLD = {ord(c): a for a, cs in LOOKALIKES.items() for c in cs}
WORD = re.compile(r"[^\W_]+")


def fold(text: str | None) -> str:
    """Lower-cased, look-alikes replaced; every character keeps its position.

    i, l and 1 become one letter, as any of them may stand for another.
    """
    t = text or ""
    low = t.lower()
    if len(low) != len(t):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in t)
    return low.translate(FOLD)


def words_of(text: str | None) -> list[str]:
    return WORD.findall(fold(text))


@dataclass
class Lexicon:
    """terms and exceptions are folded; a term ending in a space is a whole word, else a word's beginning."""

    terms: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    slope: float = 0.0
    bias: float = -4.0

    def automaton(self) -> ahocorasick.Automaton | None:
        if not self.terms:
            return None
        a = ahocorasick.Automaton()
        for t, w in self.terms.items():
            a.add_word(f" {t}", (len(t) + 1, w))
        for t in self.exceptions:
            a.add_word(f" {t} ", (len(t) + 2, None))
        a.make_automaton()
        return a

    def probability(self, weight: float, n_words: int) -> float:
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, self.bias + self.slope * density(weight, n_words)))))


def density(weight: float, n_words: int) -> float:
    """Summed weight against the logarithm of the length: one insult counts less in a long text."""
    return weight / math.log2(4 + n_words)


def matches(words: list[str], machine) -> list[tuple[int, float]]:
    """(index of the word, weight): the heaviest term of each word, none inside an exception phrase."""
    if machine is None or not words:
        return []
    best, free = {}, set()
    text = f" {' '.join(words)} "
    starts = None
    for end, (n, w) in machine.iter(text):
        if starts is None:
            starts = np.cumsum([0] + [len(x) + 1 for x in words])  # index of the space before each word
        at = int(np.searchsorted(starts, end - n + 1))
        if w is None:
            free.update(range(at, int(np.searchsorted(starts, end))))
        elif w > best.get(at, 0):
            best[at] = w
    return [(i, w) for i, w in sorted(best.items()) if i not in free]


def candidates(words: set[str]) -> set[str]:
    """Terms that a text may teach: its words, and their beginnings."""
    out = {f"{w} " for w in words}
    for w in words:
        out.update(w[:k] for k in range(PREFIX[0], min(PREFIX[1], len(w)) + 1))
    return out


def _per_label(sample: DataFrame, items) -> DataFrame:
    """Number of toxic and clean texts with each item; summed in the tasks first."""

    def run(batches):
        count: dict = {}
        for b in slices(batches):
            for t, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                for x in items(words_of(t)):
                    c = count.setdefault(x, [0, 0])
                    c[0 if y else 1] += 1
            if len(count) > 150_000:
                yield out(count)
                count = {}
        yield out(count)

    def out(count):
        return pa.RecordBatch.from_pydict({"item": pa.array(list(count), pa.string()),
                                           "toxic": pa.array([c[0] for c in count.values()], pa.int64()),
                                           "clean": pa.array([c[1] for c in count.values()], pa.int64())})

    return (sample.mapInArrow(run, "item string, toxic long, clean long")
            .groupBy("item").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def fit(labelled: DataFrame, min_texts: int = 5, max_candidates: int = 20_000) -> Lexicon:
    """Learn a lexicon from (text, toxic 0/1) rows, at most ``MAX_LABELLED`` of them.

    A term's counts are the different contexts (word before, word behind) it
    has in toxic and in clean texts, so copies of one text teach nothing by
    being many; its weight is the log odds of these counts per word.  A term
    must be unlikely by chance among all items tried.
    With no toxic rows the lexicon is empty and every score is low.
    """
    n_toxic, n = labelled.agg(F.sum("toxic"), F.count("*")).first()
    if not n_toxic:
        return Lexicon()
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n - n_toxic + 1))
    found = (_per_label(labelled, lambda ws: candidates(set(ws))).withColumn("w", odds)
             .where((F.col("toxic") >= min_texts) & (F.col("w") >= 1.2))
             .orderBy(F.desc(F.col("toxic") * F.col("w")), "item").limit(max_candidates).collect())
    contexts, words = _contexts(labelled, {r["item"] for r in found})
    ratio = math.log((words[1] + 1) / (words[0] + 1))  # clean words to toxic words
    weight = {x: math.log((t + 0.5) / (c + 0.5)) + ratio for x, (t, c) in contexts.items()}
    # log likelihood ratio of the term's contexts against the words' shares
    evidence = {x: contexts[x][0] * weight[x] for x in contexts if weight[x] > 2}
    strong = {x for x, e in evidence.items() if e >= 2 * math.log(1e6) and contexts[x][0] >= min_texts}
    # of a chain of beginnings, the longest that loses little of the evidence
    longer: dict[str, float] = {}
    for x in strong:
        for k in range(PREFIX[0], len(x)):
            longer[x[:k]] = max(longer.get(x[:k], 0), evidence[x])
    terms: dict[str, float] = {}
    for x in sorted(strong, key=lambda x: (-evidence[x], x)):
        if longer.get(x, 0) < 0.9 * evidence[x] and not any(x[:k] in terms for k in range(PREFIX[0], len(x))):
            terms[x] = weight[x]
        if len(terms) >= MAX_TERMS:
            break
    lexicon = Lexicon(terms, [], 1.0, 0.0)
    lexicon.exceptions = _exceptions(labelled, lexicon)
    _calibrate(labelled, lexicon)
    return lexicon


def _contexts(labelled: DataFrame, items: set[str]) -> tuple[dict[str, tuple[int, int]], tuple[int, int]]:
    """Different contexts of each item in toxic and in clean texts, and the words of either kind."""
    known = broadcast(labelled.sparkSession, items)

    def run(batches):
        for b in slices(batches):
            out, wanted, count = set(), known.value["data"], [0, 0]
            for t, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                ws = ["", *words_of(t), ""]
                y = int(y > 0)
                count[1 - y] += len(ws) - 2
                for before, w, behind in zip(ws, ws[1:], ws[2:]):
                    out.update((x, y, f"{before} {behind}") for x in candidates({w}) & wanted)
            out = [*out, ("", 1, str(count[0])), ("", 0, str(count[1]))]  # no item is empty
            yield pa.RecordBatch.from_pydict({"item": pa.array([x for x, _, _ in out], pa.string()),
                                              "toxic": pa.array([y for _, y, _ in out], pa.int32()),
                                              "context": pa.array([c for _, _, c in out], pa.string())})

    rows = labelled.mapInArrow(run, "item string, toxic int, context string")
    empty = F.col("item") == ""
    n = rows.where(empty).groupBy("toxic").agg(F.sum(F.col("context").cast("long")).alias("n")).collect()
    words = {r["toxic"]: r["n"] for r in n}
    got = (rows.where(~empty).groupBy("item", "toxic").agg(F.countDistinct("context").alias("n"))
           .groupBy("item").pivot("toxic", [0, 1]).sum("n").collect())
    return ({r["item"]: (r["1"] or 0, r["0"] or 0) for r in got}, (words.get(1, 0), words.get(0, 0)))


def _exceptions(labelled: DataFrame, lexicon: Lexicon, min_texts: int = 3) -> list[str]:
    """Pairs of a term's word and a neighbour that only clean texts hold."""
    b = broadcast(labelled.sparkSession, asdict(lexicon))

    def phrases(ws):
        m = kept(b, _loaded)[1]
        return {" ".join(ws[j:j + 2]) for i, _ in matches(ws, m) for j in (i - 1, i) if j >= 0 and j + 1 < len(ws)}

    rows = (_per_label(labelled, phrases).where((F.col("toxic") == 0) & (F.col("clean") >= min_texts))
            .orderBy(F.desc("clean"), "item").limit(MAX_EXCEPTIONS).collect())
    return [r["item"] for r in rows]


def _calibrate(labelled: DataFrame, lexicon: Lexicon) -> None:
    """Slope and bias of the logistic curve over the density, by Newton's method with a small ridge."""
    b = broadcast(labelled.sparkSession, asdict(lexicon))

    def run(batches):
        for batch in slices(batches):
            m = kept(b, _loaded)[1]
            ws = [words_of(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "x": pa.array([density(sum(w for _, w in matches(x, m)), len(x)) for x in ws], pa.float64()),
                "y": batch.column("toxic").cast(pa.float64())})

    rows = labelled.mapInArrow(run, "x double, y double").toPandas()  # bounded by MAX_LABELLED
    x = np.column_stack([np.ones(len(rows)), rows["x"].to_numpy()])
    y, beta = rows["y"].to_numpy(), np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = x.T @ (x * (p * (1 - p))[:, None]) + 0.1 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (y - p) - 0.1 * beta)
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    lexicon.bias, lexicon.slope = float(beta[0]), float(max(beta[1], 0.0))


def _loaded(data: dict) -> tuple:
    lexicon = Lexicon(**data)
    return lexicon, lexicon.automaton()


def labelled_sample(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    limit: int = MAX_LABELLED) -> DataFrame:
    """(text, toxic) of at most ``limit`` labelled rows outside the held-out fifth, as a written table.

    Ids without a label, null ids and null labels teach nothing; a row labelled twice is toxic if either says so.
    Of rows that share an id the first text in code-point order counts.
    """
    usable = labels.where(F.col("toxic").isNotNull() & (crc_mod("doc_id", 5) != 0))
    # few more than the limit by their hash, so that the final sort is small
    share = min(1.0, 2 * limit / max(1, usable.count()))
    if share < 1:
        usable = usable.where(F.xxhash64("doc_id") <= F.lit(int(-(1 << 63) + share * (1 << 64))))
    ids = (usable.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    one = rows.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))
    return written(one.select("text", "toxic"), "labelled")


def learn(spark, sf_dir: str) -> Lexicon:
    return fit(labelled_sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def scorer(b):
    """A function of a text, for tasks: (score, number of hits, [(start, end)] in code points)."""

    def score(text: str | None):
        (lexicon, machine), ws = kept(b, _loaded), words_of(text)
        found = matches(ws, machine)
        spans = []
        if found:
            at = [m.span() for m in WORD.finditer(fold(text))]
            spans = [at[i] for i, _ in found]
        return lexicon.probability(sum(w for _, w in found), len(ws)), len(found), spans

    return score


def score(docs: DataFrame, lexicon: Lexicon, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: score, predicted, hits and their spans.

    Null and empty texts hold no term and get the score of a clean text.
    """
    b = broadcast(docs.sparkSession, asdict(lexicon))
    score_of = scorer(b)

    def run(batches):
        for batch in slices(batches):
            out = [score_of(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "score": pa.array([x[0] for x in out], pa.float64()),
                "predicted": pa.array([int(x[0] >= 0.5) for x in out], pa.int32()),
                "n_hits": pa.array([x[1] for x in out], pa.int64()),
                "spans": pa.array([[{"start": s, "end": e} for s, e in x[2]] for x in out],
                                  pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))})

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, score double, predicted int, n_hits long, spans array<struct<start:long,end:long>>")


def clean(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that score below one half."""
    b = broadcast(docs.sparkSession, asdict(lexicon))
    score_of = scorer(b)

    def run(batches):
        for batch in slices(batches):
            yield batch.filter(pa.array([score_of(t)[0] < 0.5 for t in batch.column(text).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op1(spark, sf_dir: str) -> DataFrame:
    found = score(table(spark, sf_dir, "documents"), learn(spark, sf_dir))
    return found.select("doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
                        "score", "predicted", "n_hits")
