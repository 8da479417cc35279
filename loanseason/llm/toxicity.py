"""Toxicity of texts after undoing disguises by a noisy channel.

Three things are learned. A character trigram model comes from all texts. Cues, which are words
and word beginnings, come from labelled texts whose words were restored first. A logistic model
turns the cues of a text into a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanseason.llm.common import fold_of, in_slices, without
from loanseason.session import stored

# What a sign may stand for in disguised writing.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "*": "aeiou", "€": "e", "£": "l",
}

_OTHER, _EDGE, _CLASSES = 26, 27, 28
#: Log costs of the channel: a sign for a letter, a sign that is only noise, a sign meant as such,
#: a run shortened, a space kept between single letters.
_SWAP, _NOISE, _LITERAL, _SHORTEN, _SPACE = -1.0, -1.5, -2.0, -0.5, -1.5
_SPACED = re.compile(r"(?<!\S)(?:[^\s.,;:]\s+){2,}[^\s.,;:](?!\S)")
_REPEATED = re.compile(r"(.)\1")
_PREFIXES = (4, 5, 6, 7)
_LONGEST_WORD = 24
_REMEMBERED = 200_000


def _class_table() -> np.ndarray:
    """Class of a code point below 0x250: a letter of the alphabet, another letter, or an edge."""
    kinds = np.full(0x251, _OTHER, dtype=np.int64)
    for code in range(0x250):
        letter = chr(code)
        kinds[code] = code - 97 if "a" <= letter <= "z" else _OTHER if letter.isalpha() else _EDGE
    return kinds


def _count_grams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    kinds, total = _class_table(), np.zeros(_CLASSES**3, dtype=np.int64)
    for frame in in_slices(frames, "text"):
        joined = "\n\n" + "\n\n".join(frame["text"].dropna().str.lower()) + "\n\n"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        row = kinds[np.minimum(codes, 0x250)]
        total += np.bincount((row[:-2] * _CLASSES + row[1:-1]) * _CLASSES + row[2:], minlength=_CLASSES**3)
    seen = np.flatnonzero(total)
    yield pd.DataFrame({"gram": seen, "n": total[seen]})


def letter_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log probability of a character class after two others, from all texts.

    Every task sends at most 28 cubed counts, and so many numbers reach the driver.
    """
    counts = np.zeros(_CLASSES**3)
    grams = docs.select(F.col(text_col).cast("string").alias("text")).mapInPandas(_count_grams, "gram long, n long")
    for row in grams.groupBy("gram").agg(F.sum("n").alias("n")).collect():
        counts[row["gram"]] = row["n"]
    table = counts.reshape(_CLASSES, _CLASSES, _CLASSES) + 0.1
    return np.log(table / table.sum(axis=2, keepdims=True))


def _lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each step the strings it may stand for, with the channel's log cost."""
    steps: list[list[tuple[str, float]]] = []
    at = 0
    while at < len(token):
        sign = token[at]
        run = at + 1
        while run < len(token) and token[run] == sign:
            run += 1
        length = run - at
        if sign.isalpha():
            if length == 1:
                steps.append([(sign, 0.0)])
            else:
                steps.append([(sign, _SHORTEN), (sign * 2, _SHORTEN if length > 2 else 0.0)])
        elif sign.isspace():
            while run < len(token) and token[run].isspace():
                run += 1
            steps.append([("", 0.0), (" ", _SPACE)])
        else:
            options = [("", _NOISE), (" ", _LITERAL)]
            options += [(letter, _SWAP) for letter in STANDS_FOR.get(sign, "")]
            steps.extend([options] * (1 if length >= 3 else length))
        at = run
    return steps


def restore(token: str, model: list) -> str:
    """The likeliest writing of a token: Viterbi over its lattice, with the last two classes as state."""

    def kind(sign: str) -> int:
        return ord(sign) - 97 if "a" <= sign <= "z" else _OTHER if sign.isalpha() else _EDGE

    best = {(_EDGE, _EDGE): (0.0, None)}
    for options in _lattice(token):
        following: dict = {}
        for (first, second), (score, path) in best.items():
            for written, cost in options:
                total, a, b, trace = score + cost, first, second, path
                for sign in written:
                    c = kind(sign)
                    total += model[a][b][c]
                    a, b, trace = b, c, (sign, trace)
                held = following.get((a, b))
                if held is None or total > held[0]:
                    following[(a, b)] = (total, trace)
        best = following
    ends = ((score + model[a][b][_EDGE], path) for (a, b), (score, path) in best.items())
    _, trace = max(ends, key=lambda end: end[0])
    signs = []
    while trace:
        sign, trace = trace
        signs.append(sign)
    return "".join(reversed(signs))


@dataclass
class Restorer:
    """Words of a text with disguises undone; remembers tokens it has met."""

    model: list
    known: dict = field(default_factory=dict)

    def words(self, text: str | None) -> set[str]:
        if not text:
            return set()
        lowered = text.lower()
        found: set[str] = set()
        for token in set(lowered.split()):
            words = self.known.get(token)
            if words is None:
                words = self._restored(token)
                if len(self.known) >= _REMEMBERED:
                    self.known.clear()
                self.known[token] = words
            found.update(words)
        for spaced in _SPACED.finditer(lowered):
            found.update(restore(spaced[0], self.model).split())
        return found

    def _restored(self, token: str) -> tuple[str, ...]:
        bare = token.strip(".,;:?\"'()[]{}<>-_/\\")
        if bare.isalpha() and not _REPEATED.search(bare):
            return (bare,)
        bare = token.strip(".,;:?\"'[]{}<>-_/\\")
        if not any(sign.isalpha() for sign in bare):
            return ()
        return tuple(restore(bare, self.model).split())


def cues_of(word: str) -> list[str]:
    """A word as such, up to a length that words have, and its beginnings."""
    whole = [f"{word}$"] if len(word) <= _LONGEST_WORD else []
    return whole + [word[:n] for n in _PREFIXES if len(word) >= n]


def _cue_counter(model: np.ndarray):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model.tolist())
        counts: Counter = Counter()
        for batch in batches:
            for text, toxic in zip(*(column.to_pylist() for column in batch.columns)):
                cues = {cue for word in restorer.words(text) for cue in cues_of(word)}
                counts.update((cue, toxic) for cue in cues)
                if len(counts) > _REMEMBERED // 4:
                    yield _counted(counts)
                    counts = Counter()
        yield _counted(counts)

    return count


def _counted(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([cue for cue, _ in counts], pa.string()),
            pa.array([toxic for _, toxic in counts], pa.int32()),
            pa.array(list(counts.values()), pa.int64()),
        ],
        names=["cue", "toxic", "n"],
    )


def _evidence(weights: dict[str, float], heard: dict[str, float], words: set[str]) -> list[float]:
    """Strongest cue, sum of the three strongest, number of words with a cue."""
    found = []
    for word in words:
        weight = heard.get(word)
        if weight is None:
            weight = max((weights.get(cue, 0.0) for cue in cues_of(word)), default=0.0)
            if len(heard) >= _REMEMBERED:
                heard.clear()
            heard[word] = weight
        if weight > 0:
            found.append(weight)
    found.sort(reverse=True)
    return [found[0] if found else 0.0, sum(found[:3]), math.log1p(len(found))]


def _evidence_of(model: np.ndarray, weights: dict[str, float]):
    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer, heard = Restorer(model.tolist()), {}
        for frame in frames:
            evidence = [_evidence(weights, heard, restorer.words(text)) for text in frame["text"]]
            yield frame.drop(columns="text").assign(evidence=evidence)

    return measure


@dataclass(frozen=True)
class ToxicityModel:
    letters: np.ndarray
    cues: dict[str, float]
    slopes: tuple[float, ...]
    intercept: float


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_rows: int = 20_000,
    folds: int = 5,
    held_out: int = 0,
    least_evidence: float = 30.0,
) -> ToxicityModel:
    """Learn from all texts (characters) and from labelled ones outside the held-out fold (cues).

    At most ``label_rows`` labelled rows are used, taken in hashed order of their ids; they are
    the only thing that is broadcast or copied, so that bound holds at any size of the corpus.
    A cue must be more frequent in toxic texts with a log-likelihood ratio of ``least_evidence``,
    which no cue of the thousands that are tried reaches by chance. An id with several labels
    counts as toxic if one says so; NULL ids and NULL labels are not used. Without both labels the score is the share of toxic
    rows (0 without any).
    """
    letters = letter_model(docs, text_col)
    marked = (
        labels.filter(F.col(id_col).isNotNull() & F.col("toxic").isNotNull())
        .filter(fold_of(F.col(id_col), folds) != held_out)
        .groupBy(F.col(id_col).cast("long").alias("__id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(label_rows)
    )
    texts = without(docs, "toxic", "__id").select(
        F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("text")
    )
    sample, _ = stored(texts.join(F.broadcast(marked), "__id").select("text", "toxic"), "toxicity-sample")
    totals = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        share = bad / max(1, bad + good)
        return ToxicityModel(letters, {}, (0.0, 0.0, 0.0), math.log(max(share, 1e-9) / max(1 - share, 1e-9)))

    share = bad / (bad + good)
    seen = F.col("bad") + F.col("good")
    odds = F.log((F.col("bad") + 0.5) / (bad + 1.0)) - F.log((F.col("good") + 0.5) / (good + 1.0))
    evidence = 2 * (
        F.col("bad") * F.log(F.col("bad") / (seen * share))
        + F.when(F.col("good") > 0, F.col("good") * F.log(F.col("good") / (seen * (1 - share)))).otherwise(0.0)
    )
    counted = (
        sample.select("text", "toxic").mapInArrow(_cue_counter(letters), "cue string, toxic int, n long")
        .groupBy("cue")
        .agg(
            F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
            F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good"),
        )
        .filter(F.col("bad") > 0)
        .withColumn("weight", odds)
        .filter((F.col("weight") > 1) & (evidence >= least_evidence))
    )
    cues = {r["cue"]: r["weight"] for r in counted.select("cue", "weight").collect()}
    rows = sample.mapInPandas(_evidence_of(letters, cues), "toxic int, evidence array<double>")
    fitted = LogisticRegression(labelCol="toxic", maxIter=50, regParam=1e-3).fit(
        rows.select("toxic", array_to_vector("evidence").alias("features"))
    )
    return ToxicityModel(letters, cues, tuple(fitted.coefficients.toArray().tolist()), float(fitted.intercept))


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """Every input row with ``score`` and ``predicted``.

    NULL and empty texts have no cues and get the score of that. Rows pass through on their own,
    so repeated rows and extra columns stay as they are; columns named ``score`` and
    ``predicted`` are replaced. Texts are read whole.
    """
    letters, cues, slopes, intercept = model.letters, model.cues, np.array(model.slopes), model.intercept
    kept = without(docs, "score", "predicted")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)

    def rate(batches):
        restorer, heard, place = Restorer(letters.tolist()), {}, kept_names.index(text_col)
        for batch in batches:
            texts = batch.column(place).to_pylist()
            evidence = np.array([_evidence(cues, heard, restorer.words(text)) for text in texts]).reshape(-1, 3)
            scores = 1 / (1 + np.exp(-(evidence @ slopes + intercept)))
            columns = [*batch.columns, pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept_names, "score", "predicted"])

    kept_names = kept.columns
    return kept.mapInArrow(rate, f"{schema}, score double, predicted int")


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """The input's rows and columns without those that score at or above the threshold."""
    rated = score(without(docs, "score", "predicted"), fit(docs, labels, **options))
    return rated.filter(F.col("score") < threshold).drop("score", "predicted")
