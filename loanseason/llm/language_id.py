"""Language of texts by unigram piece models, with all segmentations of a word summed up."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanseason.llm.common import fold_of, without
from loanseason.llm.pieces import MODEL_PATH, load_vocabulary
from loanseason.session import stored

UNDETERMINED = "und"
#: A letter and what follows it, vowel signs and other marks among it.
_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*+")
#: Longer words go one by one, with the sums that are still needed alone. What is summed is the same.
_AT_ONCE = 300
#: Characters of a long word whose pieces are looked up together, in rows of so many starts.
_SECTION, _ROW = 64_000, 64
#: Every character carries this factor while products are formed, about the inverse of what it costs.
_PER_CHARACTER = 100.0
#: Sums are looked at after so many characters, and rescaled if one has left this range.
_LOOK, _LEAST, _MOST = 4, 1e-100, 1e100
_WORDS_AT_ONCE = 20_000
_HASH_BASE = np.uint64(0x9E3779B97F4A7C15)
_TABLE_BITS = 20
_TABLE_SHIFT = np.uint64(64 - _TABLE_BITS)
#: Expectations are added up as whole numbers of such parts, in any order with the same result.
_PARTS = 1_000_000
_REMEMBERED = 400_000
_SLICE_CHARACTERS = 2_000_000


@dataclass(frozen=True)
class PieceIndex:
    """Pieces that can occur in a word, by number; the last number stands for an unknown character."""

    numbers: dict[str, int]
    start: np.ndarray
    longest: int

    @property
    def unknown(self) -> int:
        return len(self.numbers)


def piece_index(path: str = MODEL_PATH) -> PieceIndex:
    """The public vocabulary without pieces of spaces alone, with frequencies that fall with the rank."""
    vocabulary = load_vocabulary(path)
    pieces = [p for p in vocabulary.ids if p.strip(" ") or p == " "]
    weights = np.array([vocabulary.frequency(p) for p in [*pieces, None]])
    return PieceIndex({p: k for k, p in enumerate(pieces)}, weights / weights.sum(), max(map(len, pieces)))


def words_in(token: str) -> list[str]:
    """Runs of letters, each with the space that marks its start."""
    return [" " + run for run in ([token] if token.isalpha() else _LETTERS.findall(token))]


def _by_length(words: Iterable[str]) -> Iterator[tuple[int, list[int], list[str]]]:
    """Groups of equally long words with their places, as many at a time as bounded memory holds."""
    groups: dict[int, list[int]] = defaultdict(list)
    words = list(words)
    for place, word in enumerate(words):
        groups[len(word)].append(place)
    for length, places in groups.items():
        some = max(1, min(_WORDS_AT_ONCE, 1_000_000 // length)) if length <= _AT_ONCE else 1
        for k in range(0, len(places), some):
            part = places[k : k + some]
            yield length, part, [words[p] for p in part]


@dataclass(frozen=True)
class Arcs:
    """Pieces that occur at one span of equally long words: which words, and which piece in each."""

    start: int
    stop: int
    words: np.ndarray
    numbers: np.ndarray


class ArcFinder:
    """Finds all pieces in many words of one length at once, by 64-bit hashes of their spans.

    Pieces lie in a table by their hash; the few that meet another there lie in a second one.
    """

    def __init__(self, index: PieceIndex) -> None:
        self.index = index
        self.keys = np.array([_hash_of(p) for p in index.numbers] + [0], dtype=np.uint64)
        draw = np.random.default_rng(1)
        self.tables, left = [], np.arange(len(self.keys) - 1)
        while len(left):
            factor = np.uint64(draw.integers(0, 2**63)) * np.uint64(2) + np.uint64(1)
            table = np.full(1 << _TABLE_BITS, len(self.keys) - 1, dtype=np.int32)
            slots = (self.keys[left] * factor) >> _TABLE_SHIFT
            table[slots] = left
            self.tables.append((factor, table))
            left = left[table[slots] != left]

    def __call__(self, words: list[str], length: int) -> list[Arcs]:
        """Arcs in order of their stop; a character that is no piece is an unknown one."""
        raw = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.ascontiguousarray(raw.reshape(len(words), length).T).astype(np.uint64)
        arcs = []
        for start in range(length):
            value = np.zeros(len(words), dtype=np.uint64)
            for stop in range(start + 1, min(length, start + self.index.longest) + 1):
                value = value * _HASH_BASE + codes[stop - 1]
                numbers = np.full(len(words), -1, dtype=np.int32)
                for factor, table in self.tables:
                    found = table[(value * factor) >> _TABLE_SHIFT]
                    np.copyto(numbers, found, where=self.keys[found] == value)
                if stop == start + 1:
                    numbers[numbers < 0] = self.index.unknown
                rows = np.flatnonzero(numbers >= 0)
                if len(rows):
                    arcs.append(Arcs(start, stop, rows, numbers[rows]))
        return sorted(arcs, key=lambda arc: arc.stop)


def _hash_of(piece: str) -> int:
    value = 0
    for sign in piece:
        value = (value * int(_HASH_BASE) + ord(sign)) % 2**64
    return value


def _rescale(sums: np.ndarray, at: int, reached: slice) -> np.ndarray | None:
    """Bring the sums at a position, where they left the range, to 1, and those still needed along.

    Returns the logarithm of the factor for each word and model, or None if all are in range.
    """
    here = sums[at]
    out = ((here < _LEAST) | (here > _MOST)) & (here > 0)
    if not out.any():
        return None
    factor = np.where(out, here, 1.0)
    sums[reached] /= factor
    return np.log(factor)


def _forward(
    arcs: list[Arcs], count: int, length: int, chances: np.ndarray, longest: int
) -> tuple[np.ndarray, np.ndarray | None]:
    """Sums over all segmentations of every prefix: (position, word, model), and their log factors.

    A sum is what is stored times the exponential of its log factor; None stands for factors of 1.
    Positions that an arc still reads share one factor.
    """
    sums = np.zeros((length + 1, count, chances.shape[1]))
    sums[0] = 1.0
    logs, at = None, 0
    for arc in arcs:
        if arc.stop > at:
            if at and at % _LOOK == 0:
                first = max(0, at + 1 - longest)
                factor = _rescale(sums, at, slice(first, at + 1))
                if factor is not None:
                    logs = np.zeros(sums.shape) if logs is None else logs
                    logs[first:] += factor
            at = arc.stop
        weight = chances[arc.numbers] * _PER_CHARACTER ** (arc.stop - arc.start)
        sums[arc.stop, arc.words] += sums[arc.start, arc.words] * weight
    return sums, logs


def _sections(word: str, finder: ArcFinder, back: bool = False) -> Iterator[tuple]:
    """Arcs of a long word by their start: first and last position, edges of each start's arcs, lengths, pieces."""
    width = _ROW + finder.index.longest - 1
    for first in range(0, len(word), _SECTION)[:: -1 if back else 1]:
        last = min(len(word), first + _SECTION)
        offsets = np.arange(first, last, _ROW)
        rows = [word[a : a + width].ljust(width, "\0") for a in offsets]
        arcs = [arc for arc in finder(rows, width) if arc.start < _ROW]
        starts = np.concatenate([offsets[arc.words] + arc.start for arc in arcs])
        lengths = np.concatenate([np.full(len(arc.words), arc.stop - arc.start) for arc in arcs])
        numbers = np.concatenate([arc.numbers for arc in arcs])
        inside = np.flatnonzero(starts + lengths <= len(word))
        order = inside[np.argsort(starts[inside], kind="stable")]
        edges = np.searchsorted(starts[order], np.arange(first, last + 1))
        yield first, last, edges, lengths[order], numbers[order]


def _along(word: str, finder: ArcFinder, chances: np.ndarray, trail: np.ndarray | None = None) -> np.ndarray:
    """Log sum over all segmentations of a word of any length, for each model.

    Sums are handed on from each position to where its arcs end, so only as many are held as an arc
    is long. ``trail`` receives the first model's log sum at every position.
    """
    size = finder.index.longest + 1
    ring, log = np.zeros((size, chances.shape[1])), np.zeros(chances.shape[1])
    ring[0] = 1.0
    for first, last, edges, lengths, numbers in _sections(word, finder):
        weights = chances[numbers] * _PER_CHARACTER ** lengths[:, None]
        for at in range(first, last):
            here = ring[at % size].copy()
            ring[at % size] = 0.0
            if trail is not None:
                trail[at] = math.log(here[0]) + log[0]
            a, b = edges[at - first], edges[at - first + 1]
            ring[(at + lengths[a:b]) % size] += here * weights[a:b]
            if at % _LOOK == 0 and (here.min() < _LEAST or here.max() > _MOST):
                ring /= here
                log += np.log(here)
    return np.log(ring[len(word) % size]) + log


def _expected_along(word: str, times: int, finder: ArcFinder, total: np.ndarray) -> None:
    """Add the pieces expected in a word of any length: the same sums, taken up again from its end."""
    start, size = finder.index.start, finder.index.longest + 1
    ahead = np.zeros(len(word))
    whole = _along(word, finder, start[:, None], ahead)[0]
    ring, log = np.zeros(size), 0.0
    ring[len(word) % size] = 1.0
    for first, last, edges, lengths, numbers in _sections(word, finder, back=True):
        weights = start[numbers] * _PER_CHARACTER**lengths
        for at in range(last - 1, first - 1, -1):
            a, b = edges[at - first], edges[at - first + 1]
            values = weights[a:b] * ring[(at + lengths[a:b]) % size]
            total[numbers[a:b]] += times * math.exp(ahead[at] + log - whole) * values
            here = ring[at % size] = values.sum()
            if at % _LOOK == 0 and not _LEAST < here < _MOST:
                ring /= here
                log += math.log(here)


def log_likelihoods(words: list[str], finder: ArcFinder, chances: np.ndarray) -> np.ndarray:
    """Log probability of each word under each model, summed over its segmentations."""
    out = np.zeros((len(words), chances.shape[1]))
    for length, places, group in _by_length(words):
        if length > _AT_ONCE:
            out[places] = _along(group[0], finder, chances) - length * math.log(_PER_CHARACTER)
            continue
        sums, logs = _forward(finder(group, length), len(group), length, chances, finder.index.longest)
        out[places] = np.log(sums[length]) - length * math.log(_PER_CHARACTER)
        if logs is not None:
            out[places] += logs[length]
    return out


def expected_counts(words: dict[str, int], finder: ArcFinder) -> np.ndarray:
    """How often each piece is expected in the words, over all segmentations under the start model."""
    start = finder.index.start
    total = np.zeros(len(start))
    names, numbers = list(words), np.array(list(words.values()), dtype=np.float64)
    for length, places, group in _by_length(names):
        if length > _AT_ONCE:
            _expected_along(group[0], int(numbers[places[0]]), finder, total)
            continue
        arcs = finder(group, length)
        longest = finder.index.longest
        sums, logs = _forward(arcs, len(group), length, start[:, None], longest)
        ahead = sums[:, :, 0]
        back = np.zeros((length + 1, len(group)))
        back[length] = numbers[places] / ahead[length]
        # The log factor of what is behind, as it stands at the position that is being filled.
        behind, at = None if logs is None else -logs[length, :, 0], length
        for arc in sorted(arcs, key=lambda a: -a.start):
            if arc.start < at:
                if at < length and (length - at) % _LOOK == 0:
                    factor = _rescale(back, at, slice(at, at + longest))
                    if factor is not None:
                        behind = factor if behind is None else behind + factor
                at = arc.start
            step = start[arc.numbers] * _PER_CHARACTER ** (arc.stop - arc.start) * back[arc.stop, arc.words]
            back[arc.start, arc.words] += step
            both = ahead[arc.start, arc.words] * step
            if behind is not None:
                left = behind[arc.words] if logs is None else behind[arc.words] + logs[arc.start, arc.words, 0]
                with np.errstate(divide="ignore"):
                    both = np.exp(np.log(ahead[arc.start, arc.words]) + np.log(step) + left)
            total += np.bincount(arc.numbers, weights=both, minlength=len(total))
    return total


def _counter(index: PieceIndex):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = ArcFinder(index)
        totals: dict[str, np.ndarray] = {}
        tokens: dict[str, Counter] = defaultdict(Counter)
        texts: Counter = Counter()

        def settle() -> None:
            for lang, counted in tokens.items():
                words: Counter = Counter()
                for token, n in counted.items():
                    for word in words_in(token):
                        words[word] += n
                if words:
                    totals[lang] = totals.get(lang, 0) + expected_counts(words, finder)
            tokens.clear()

        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                texts[lang] += 1
                if text:
                    tokens[lang].update(text.lower().split())
                if sum(map(len, tokens.values())) > _REMEMBERED // 2:
                    settle()
        settle()
        for lang, n in texts.items():
            counts = np.rint(totals.get(lang, np.zeros(index.unknown + 1)) * _PARTS).astype(np.int64)
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * (len(seen) + 1), pa.string()),
                    "piece": pa.array([-1, *seen.tolist()], pa.int32()),
                    "n": pa.array([n, *counts[seen].tolist()], pa.int64()),
                }
            )

    return count


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    index: PieceIndex
    chances: np.ndarray
    prior: np.ndarray


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = 4,
    held_out: int = 2,
    smoothing: float = 0.01,
    path: str = MODEL_PATH,
) -> LanguageModel:
    """Piece probabilities of each language, from all texts with a language outside one fold.

    One step of expectation maximisation from the vocabulary's own frequencies: every task adds
    up the pieces expected in its words, over all their segmentations. What reaches the driver
    is a number for each piece and language. NULL ids, being in no fold, are learned from.
    """
    index = piece_index(path)
    fold = F.coalesce(fold_of(F.col(id_col), folds), F.lit(-1))
    learned = docs.filter(F.col(lang_col).isNotNull() & (fold != held_out)).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")
    )
    counted, _ = stored(
        learned.mapInArrow(_counter(index), "lang string, piece int, n long")
        .groupBy("lang", "piece")
        .agg(F.sum("n").alias("n")),
        "language-pieces",
    )
    rows = counted.collect()
    languages = tuple(sorted({r["lang"] for r in rows}))
    counts = np.zeros((index.unknown + 1, len(languages)))
    texts = np.zeros(len(languages))
    for r in rows:
        at = languages.index(r["lang"])
        if r["piece"] < 0:
            texts[at] = r["n"]
        else:
            counts[r["piece"], at] = r["n"] / _PARTS
    counts += smoothing
    prior = np.log(texts / texts.sum()) if len(languages) else texts
    return LanguageModel(languages, index, counts / counts.sum(axis=0), prior)


class _Tokens:
    """Rows of log likelihoods for tokens; forgets all when it has met too many."""

    def __init__(self, model: LanguageModel) -> None:
        self.model = model
        self.finder = ArcFinder(model.index)
        self.places: dict[str, int] = {}
        self.rows = np.zeros((0, len(model.languages) + 1))

    def learn(self, tokens: set[str]) -> None:
        fresh = sorted(tokens - self.places.keys())
        if len(self.places) + len(fresh) > _REMEMBERED:
            self.places, self.rows, fresh = {}, self.rows[:0], sorted(tokens)
        words, owners = [], []
        for k, token in enumerate(fresh):
            for word in words_in(token):
                words.append(word)
                owners.append(k)
        rows = np.zeros((len(fresh), self.rows.shape[1]))
        if words:
            values = log_likelihoods(words, self.finder, self.model.chances)
            np.add.at(rows, owners, np.column_stack([values, np.ones(len(words))]))
        held = len(self.places)
        self.places.update((token, held + k) for k, token in enumerate(fresh))
        self.rows = np.vstack([self.rows, rows])


def _slices(texts: list[str | None]) -> Iterator[list[str | None]]:
    part: list = []
    size = 0
    for text in texts:
        part.append(text)
        size += len(text or "")
        if size >= _SLICE_CHARACTERS:
            yield part
            part, size = [], 0
    if part:
        yield part


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """Every input row with ``lang_pred`` and ``score``, the probability of that language.

    The likelihood of a text is the product over its words, that of a word the sum over all its
    segmentations; words of any length are scored whole. A text that is NULL or has no letter, and any text where no language was
    learned, is ``und`` with score 0. Equal likelihoods go to the language first by name.
    Columns named ``lang_pred`` and ``score`` are replaced. Texts are read whole.
    """
    kept = without(docs, "lang_pred", "score")
    names, at = kept.columns, kept.columns.index(text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Tokens(model)
        for batch in batches:
            found, sure = [], []
            for texts in _slices(batch.column(at).to_pylist()):
                split = [text.lower().split() if text else [] for text in texts]
                known.learn({token for tokens in split for token in tokens})
                for tokens in split:
                    places = np.fromiter(map(known.places.__getitem__, tokens), np.int64, len(tokens))
                    total = known.rows[places].sum(axis=0)
                    if not total[-1] or not model.languages:
                        found.append(UNDETERMINED)
                        sure.append(0.0)
                        continue
                    weights = total[:-1] + model.prior
                    best = int(np.argmax(weights))
                    found.append(model.languages[best])
                    sure.append(float(1 / np.exp(weights - weights[best]).sum()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.string()), pa.array(sure, pa.float64())],
                names=[*names, "lang_pred", "score"],
            )

    return kept.mapInArrow(judge, f"{schema}, lang_pred string, score double")
