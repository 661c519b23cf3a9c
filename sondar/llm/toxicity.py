"""Toxicity from a weighted lexicon, found by Aho-Corasick in folded text.

Folding lower-cases, undoes compatibility forms and invisible characters,
turns look-alike letters of other scripts into Latin ones and digits or signs
inside a word into the letters they stand for.  Entries are whole words or word
beginnings with a weight; a hit inside an exception phrase does not count.  The
sum of the weights, as such and per length (up to a length), gives the score.

Entries, weights and exceptions are learnt from a bounded sample of labelled
rows; every text is scored whole.
"""

from __future__ import annotations

import heapq
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondar.llm.common import fresh, quoted, slices, staged
from sondar.llm.labelled import SAMPLE_ROWS, fit_logistic, held_out, training_labels

FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.3
MAX_CLEAN = 0.02
#: Clean documents for each toxic one that an entry may be found in.
WRONG = 0.125
#: Words beyond which a longer text no longer weakens what is found in it.
DILUTION = 1000
SHORTEST, LONGEST = 4, 10

# Letters of other scripts that look like Latin ones.
_LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j",
    "к": "k", "ӏ": "l", "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t",
    "у": "y", "х": "x", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g", "ո": "n", "օ": "o",
}
# Digits and signs written for letters.
_DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}
# Zero-width characters and the soft hyphen.
_INVISIBLE = "­​‌‍⁠﻿"
# Harmless phrases around words that are often meant badly.
EXCEPTIONS = ("trash can", "trash bin", "class clown", "clown fish", "pathetic fallacy", "pond scum")

# Weights of words that need no learning; a sample that finds one in many clean
# texts strikes it.
BASE = {
    "idiot": 4.0, "idiots": 4.0, "idiotic": 3.0, "imbecile": 4.0, "moron": 4.0, "morons": 4.0, "stupid": 3.0,
    "dumbass": 4.0, "loser": 3.0, "losers": 3.0, "scum": 4.0, "scumbag": 4.0, "pathetic": 3.0, "worthless": 3.0,
    "disgusting": 3.0, "trash": 2.0, "vermin": 3.0, "filth": 2.0, "degenerate": 2.0, "bastard": 3.0, "clown": 2.0,
    "vollidiot": 4.0, "arschloch": 4.0, "dummkopf": 3.0, "abschaum": 4.0, "connard": 4.0, "salaud": 4.0,
    "ordure": 2.0, "gilipollas": 4.0, "cabrón": 4.0, "estúpido": 3.0, "basura": 2.0,
}

_TABLE = str.maketrans(_LOOKALIKES) | {ord(c): None for c in _INVISIBLE}
_IN_WORD = re.compile(r"(?<=[^\W\d_])[013457@$!|8]+(?=[^\W\d_])|(?<![\w@$!|])[013457@$8]+(?=[^\W\d_])|(?<=[^\W\d_])[013457$8]+(?![\w@$!|])")
_WORD = re.compile(r"[^\W\d_]+")


def _letters(match: re.Match) -> str:
    return "".join(_DIGITS[c] for c in match[0])


def folded(text: str | None) -> str:
    """The text's words after folding, each between two single spaces."""
    text = (text or "").lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).lower().translate(_TABLE)
    words = _WORD.findall(_IN_WORD.sub(_letters, text))
    return " " + " ".join(words) + " " if words else " "


@dataclass
class Lexicon:
    """Weights of words (" word ") and word beginnings (" begin"), exception
    phrases, and the weights of (log sum, what a short text adds to it, 1).  An entry
    written with a 2 before it counts from its second place on."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    scale: tuple[float, float, float] = (4.0, 0.0, -3.0)
    automaton: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "automaton"} | {"automaton": None}

    def _built(self):
        if self.automaton is None:
            machine = ahocorasick.Automaton()
            for phrase in self.exceptions:
                entry = folded(phrase)
                machine.add_word(entry, (len(entry), None))
            once = {e.removeprefix("2"): [0.0, 0.0] for e in self.weights}
            for entry, weight in self.weights.items():
                once[entry.removeprefix("2")][entry[0] == "2"] = weight
            for entry, weight in once.items():
                machine.add_word(entry, (len(entry), (entry, *weight)))
            if len(machine):
                machine.make_automaton()
            self.automaton = machine
        return self.automaton

    def total(self, words: str) -> float:
        """The summed weights in folded text; a word counts once, with its
        heaviest entry, unless an exception phrase covers it.  Entries that count when
        repeated add their weight for each place after the first."""
        machine, hits, harmless, again = self._built(), {}, [], {}
        if not len(machine):
            return 0.0
        for end, (length, entry) in machine.iter(words):
            start = end + 1 - length
            if entry is None:
                harmless.append((start, end))
                continue
            name, weight, repeated = entry
            if weight:
                hits[start] = max(hits.get(start, weight), weight)
            if repeated:
                again.setdefault((name, repeated), []).append(start)
        free = [lambda s: True, lambda s: not any(a <= s < b for a, b in harmless)][bool(harmless)]
        return sum(w for s, w in hits.items() if free(s)) + sum(w * max(sum(map(free, at)) - 1, 0) for (_, w), at in again.items())

    def features(self, text: str | None) -> tuple[float, float]:
        words = folded(text)
        total = max(self.total(words), 0.0)
        dense = math.log1p(DILUTION * total / min(words.count(" "), DILUTION))
        return math.log1p(total), dense - math.log1p(total)

    def score(self, text: str | None) -> float:
        a, b = self.features(text)
        z = self.scale[0] * a + self.scale[1] * b + self.scale[2]
        return 1 / (1 + math.exp(-min(max(z, -35), 35)))


#: Sums of hashes of 40 bits tell sets of toxic documents apart.
_PARTS = 3


def _entries(text: str | None) -> set[str]:
    found: Counter[str] = Counter()
    for word, n in Counter(folded(text).split()).items():
        found[f" {word} "] += n
        for k in range(SHORTEST, min(LONGEST, len(word) - 1) + 1):
            found[f" {word[:k]}"] += n
    return found.keys() | {f"2{e}" for e, n in found.items() if n > 1}


def _counted(sample: DataFrame) -> DataFrame:
    """(entry, toxic, clean, which): documents of the sample with each entry; entries
    with an equal ``which`` are in the same toxic documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, which = (Counter(), Counter()), [Counter() for _ in range(_PARTS)]
            for part in slices(batch, "t"):
                for text, y in zip(part.column("t").to_pylist(), part.column("y").to_pylist()):
                    found = _entries(text)
                    seen[y].update(found)
                    if y:
                        digest = xxhash.xxh3_128_intdigest(text or "")
                        for k, sums in enumerate(which):
                            piece = digest >> 40 * k & (1 << 40) - 1
                            for e in found:
                                sums[e] += piece
            names = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([seen[1][n] for n in names], pa.int64()),
                 pa.array([seen[0][n] for n in names], pa.int64()),
                 *[pa.array([sums[n] for n in names], pa.int64()) for sums in which]],
                names=["entry", "toxic", "clean", *parts])

    parts = [f"w{k}" for k in range(_PARTS)]
    counts = sample.mapInArrow(count, "entry string, toxic long, clean long, " + ", ".join(f"{w} long" for w in parts))
    return counts.groupBy("entry").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.struct(*[F.sum(w) for w in parts]).alias("which"))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
          folds: int = FOLDS, fold_out: int = HELD_OUT, rows: int = SAMPLE_ROWS,
          exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """A lexicon from at most ``rows`` labelled ids outside the held-out fold.

    The words of ``BASE`` are in from the start.  Candidates are all entries rarely found
    in clean documents; of those in the same toxic documents only the longest could ever
    be taken, so the others stay out.  They are taken greedily, each for the toxic
    documents that no earlier one explains, so that not all words of one much-copied
    document enter.  Without both classes the lexicon is empty and scores
    are the classes' share.  Of an id with several texts the one of the smallest hash
    is learnt from, null as empty.  The driver holds the candidates and
    four bytes for each of them in each toxic row, of which there are at most ``rows``.
    """
    picked = F.broadcast(training_labels(labels, id_col, label, folds, fold_out, rows))
    sample = docs.select(quoted(id_col).alias("id"), F.coalesce(quoted(text), F.lit("")).alias("t")).join(picked, "id")
    # One text an id, so that the bound on ids bounds the rows; kept, as it is read several times.
    sample = staged(sample.groupBy("id").agg(F.min_by("t", F.xxhash64("t")).alias("t"), F.max("y").alias("y")).select("t", "y"), "labelled")
    sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    share = (toxic + 0.5) / (toxic + clean + 1)
    if not toxic or not clean:
        return Lexicon({}, exceptions, (0.0, 0.0, math.log(share / (1 - share))))
    base = {folded(word): weight for word, weight in BASE.items()}
    rate = (F.col("clean") + 0.5) / (clean + 1)
    least = max(2, toxic // 500)
    known = F.col("entry").isin(list(base))
    # An entry of many toxic documents may be in a few clean ones, by chance or by a wrong label.
    few = F.greatest(F.lit(1 + clean // 1000), F.floor(F.col("toxic") * WRONG))
    rare = (F.col("toxic") >= least) & (F.col("clean") <= few) & (rate <= MAX_CLEAN * (F.col("toxic") / toxic + 1))
    counted = _counted(sample).where(known | rare)
    # The words of BASE stay each for itself.
    best = (
        counted.groupBy("toxic", "which", F.when(known, F.col("entry")).alias("base"))
        .agg(F.min(F.struct((-F.length(F.ltrim(F.col("entry"), F.lit("2")))).alias("n"), "entry", "clean")).alias("one"))
        .select("one.entry", "toxic", "one.clean").collect()
    )
    counts = {r["entry"]: (r["toxic"], r["clean"]) for r in best}
    names = sorted(counts)
    place = {n: i for i, n in enumerate(names)}

    def explained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t"):
                found = [sorted(place[e] for e in _entries(t) if e in place) for t in part.column("t").to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32()))], names=["e"])

    # The rows of each entry, end to end: four bytes a pair.
    found = sample.where("y = 1").select("t").mapInArrow(explained, "e array<int>").toArrow().column("e").combine_chunks()
    pairs = found.flatten().to_numpy()
    row_of = np.repeat(np.arange(len(found), dtype=np.int32), np.diff(found.offsets.to_numpy()))
    docs_of = row_of[np.argsort(pairs, kind="stable")]
    begin = np.concatenate([[0], np.cumsum(np.bincount(pairs, minlength=len(names)))])

    def rows_of(entry: int) -> np.ndarray:
        return docs_of[begin[entry] : begin[entry + 1]]

    def struck(entry: str) -> bool:
        a, b = counts.get(entry, (0, 0))
        return b > 1 and b / clean > MAX_CLEAN * (a + 1) / toxic

    def log_odds(entry: str) -> float:
        a, b = counts.get(entry, (0, 0))
        return math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1)) if a >= least else 0.0

    weights = {e: max(w, log_odds(e)) for e, w in base.items() if not struck(e)}
    left = np.ones(len(found), dtype=bool)
    for e in weights:
        if e in place:
            left[rows_of(place[e])] = False
    # What an entry explains only shrinks, so one still first after a new count is the best.
    waiting = [(-int(n), -len(names[e]), e) for e, n in enumerate(np.diff(begin)) if n]
    heapq.heapify(waiting)
    while waiting and -waiting[0][0] >= least:
        before, length, e = heapq.heappop(waiting)
        gain = rows_of(e)
        gain = gain[left[gain]]
        if len(gain) < -before:
            heapq.heappush(waiting, (-len(gain), length, e))
            continue
        weights[names[e]] = log_odds(names[e])
        left[gain] = False
    lexicon = Lexicon(weights, exceptions)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t"):
                rows_ = [lexicon.features(t) for t in part.column("t").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows_], pa.float64()), pa.array([r[1] for r in rows_], pa.float64()),
                     part.column("y").cast(pa.int32())], names=["a", "b", "y"])

    points = sample.mapInArrow(measured, "a double, b double, y int").toArrow()
    values = np.stack([points.column(c).to_numpy().astype(float) for c in ("a", "b", "y")], axis=1)
    values = values[np.lexsort(values.T)]
    # First the sum, then what its share of a short text adds: a long text is not let
    # off because the sample's toxic texts happen to be short.
    (w,), intercept = fit_logistic(values[:, :1], values[:, 2], l2=1e-4)
    (more,), moved = fit_logistic(
        np.where(values[:, :1] > 0, values[:, 1:2], 0.0), values[:, 2], l2=1e-2, offset=w * values[:, 0] + intercept)
    lexicon.scale = (float(w), max(0.0, float(more)), float(intercept + min(0.0, moved) * (more > 0)))
    return lexicon


def score(docs: DataFrame, lexicon: Lexicon, text: str = "text", out: str = "toxicity") -> DataFrame:
    """The frame with a column of scores from 0 to 1; null texts count as empty."""
    names, t = [f"c{i}" for i in range(len(docs.columns))], "t"
    frame = docs.select(*[quoted(c).alias(n) for c, n in zip(docs.columns, names)], quoted(text).alias(t))
    schema = docs.select(*[quoted(c).alias(n) for c, n in zip(docs.columns, names)]).schema.add("score", "double")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, t):
                scores = [lexicon.score(x) for x in part.column(t).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in names] + [pa.array(scores, pa.float64())], names=[*names, "score"])

    done = frame.mapInArrow(scan, schema)
    return done.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names)], F.col("score").alias(out))


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
           threshold: float = THRESHOLD) -> DataFrame:
    """(id_col, held_out, score, predicted) for every row, repeated ones too; null texts count as empty."""
    lexicon = learn(docs, labels, id_col, text, label)
    rows = score(docs.select(quoted(id_col), quoted(text).alias(fresh(docs, "_t"))), lexicon, fresh(docs, "_t"), "score")
    return rows.select(
        quoted(id_col), held_out(id_col, FOLDS, HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
          threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score is below the threshold, with their own columns; a row at
    the threshold goes, repeated rows go or stay together."""
    lexicon, out = learn(docs, labels, id_col, text, label), fresh(docs, "_score")
    return score(docs, lexicon, text, out).where(F.col(out) < threshold).drop(out)
