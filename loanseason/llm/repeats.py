"""Repeated passages of words, found by sampled phrases and located by Aho-Corasick automata."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanseason.llm.common import WORD, without, words_of
from loanseason.session import stored

_REMEMBERED = 300_000
_SHARD_CHARACTERS = 2_000_000
_BASE = 0x9E3779B97F4A7C15
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
KEY = ["k1", "k2"]


@dataclass(frozen=True)
class RepeatSettings:
    """``window`` words that occur again are a repeat; phrases of ``phrase`` words are sampled.

    The phrase of least hash among those of a window stands for it, so equal windows have equal
    phrases, and about two phrases in (window - phrase + 2) are sampled.
    """

    window: int = 35
    phrase: int = 10


class _WordCodes(dict):
    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= _REMEMBERED:
            self.clear()
        self[word] = code = xxhash.xxh3_64_digest(word)
        return code


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * _M1
    values = (values ^ (values >> np.uint64(27))) * _M2
    return values ^ (values >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as far as the longest text needs them."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def reach(self, size: int) -> None:
        if size > len(self.up):
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
                factors = np.full(2 * size, base, dtype=np.uint64)
                factors[0] = 1
                setattr(self, name, np.multiply.accumulate(factors))


class Spans:
    """Hashes of any run of a text's words in constant time each."""

    def __init__(self, text: str | None, codes: _WordCodes, powers: _Powers) -> None:
        words = words_of(text)
        self.size = len(words)
        self.words = words
        if not words:
            return
        powers.reach(self.size)
        code = np.frombuffer(b"".join(map(codes.__getitem__, words)), dtype="<u8")
        self.powers = powers
        self.sums = [self._sum(code), None]
        self.code = code

    def _sum(self, code: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(code * self.powers.up[: self.size])])

    def hashes(self, starts: np.ndarray, lengths: np.ndarray | int, second: bool = False) -> np.ndarray:
        """64 bits for each run; the second hash rests on other word codes."""
        if second and self.sums[1] is None:
            self.sums[1] = self._sum(_mix(self.code + np.uint64(_BASE)))
        sums = self.sums[int(second)]
        return _mix((sums[starts + lengths] - sums[starts]) * self.powers.down[starts])

    def phrases(self, settings: RepeatSettings) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all phrases, and for every window the least of its phrases'."""
        every = self.hashes(np.arange(self.size - settings.phrase + 1), settings.phrase)
        span = settings.window - settings.phrase + 1
        least, width = every, 1
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = span - width
        return every, np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def _segments(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First window and number of windows of each run with one phrase."""
    starts = np.concatenate([[0], np.flatnonzero(chosen[1:] != chosen[:-1]) + 1])
    return starts, np.diff(np.concatenate([starts, [len(chosen)]]))


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _batch(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), names=names.split())


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def _sampler(settings: RepeatSettings):
    """(phrase, key, number of places) of every text; equal texts of a batch are counted once."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, powers = _WordCodes(), _Powers()
        for batch in batches:
            seen: dict[tuple, list] = {}
            for k1, k2, text in zip(*(c.to_pylist() for c in batch.columns)):
                entry = seen.setdefault((k1, k2), [text, 0])
                entry[1] += 1
            phrases, firsts, seconds, places = [], [], [], []
            for (k1, k2), (text, copies) in seen.items():
                spans = Spans(text, codes, powers)
                if spans.size < settings.window:
                    continue
                every, chosen = spans.phrases(settings)
                sampled = np.unique(chosen)
                at = np.minimum(np.searchsorted(sampled, every), len(sampled) - 1)
                hit = at[sampled[at] == every]
                phrases.append(sampled.view(np.int64))
                places.append(np.bincount(hit, minlength=len(sampled)) * copies)
                firsts.append(np.full(len(sampled), k1))
                seconds.append(np.full(len(sampled), k2))
            yield _batch("phrase k1 k2 places", *(pa.array(_joined(p), pa.int64()) for p in (phrases, firsts, seconds, places)))

    return sample


def _segmenter(settings: RepeatSettings):
    """Segments of texts whose phrase occurs again, with a hash of their words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, powers = _WordCodes(), _Powers()
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for k1, k2, text, copies, phrases in zip(*(c.to_pylist() for c in batch.columns)):
                spans = Spans(text, codes, powers)
                _, chosen = spans.phrases(settings)
                starts, counts = _segments(chosen)
                again = np.isin(chosen[starts].view(np.int64), np.array(phrases, dtype=np.int64))
                starts, counts = starts[again], counts[again]
                body = spans.hashes(starts, counts + settings.window - 1, second=True)
                size = len(starts)
                for column, values in zip(
                    out,
                    (chosen[starts].view(np.int64), body.view(np.int64), np.full(size, k1), np.full(size, k2), starts, counts, np.full(size, copies)),
                ):
                    column.append(values)
            yield _batch("phrase body k1 k2 start n copies", *(pa.array(_joined(c), pa.int64()) for c in out))

    return cut


def _windower(settings: RepeatSettings):
    """Both hashes of every window of the given segments."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, powers = _WordCodes(), _Powers()
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for k1, k2, text, copies, parts in zip(*(c.to_pylist() for c in batch.columns)):
                spans = Spans(text, codes, powers)
                places = np.concatenate([np.arange(p["start"], p["start"] + p["n"]) for p in parts])
                size = len(places)
                for column, values in zip(
                    out,
                    (
                        spans.hashes(places, settings.window).view(np.int64),
                        spans.hashes(places, settings.window, second=True).view(np.int64),
                        np.full(size, k1), np.full(size, k2), places, np.full(size, copies),
                    ),
                ):
                    column.append(values)
            yield _batch("w1 w2 k1 k2 start copies", *(pa.array(_joined(c), pa.int64()) for c in out))

    return spread


def _passages(parts: list[dict], window: int) -> list[tuple[int, int]]:
    """Word ranges that runs of repeated windows cover, joined where windows follow each other."""
    ranges: list[list[int]] = []
    for start, n in sorted((p["start"], p["n"]) for p in parts):
        if ranges and start <= ranges[-1][1] - window + 1:
            ranges[-1][1] = max(ranges[-1][1], start + n + window - 1)
        else:
            ranges.append([start, start + n + window - 1])
    return [(a, b) for a, b in ranges]


def covered_words(texts: list[list[int]], passages: list[tuple[int, ...]]) -> list[np.ndarray]:
    """For every text which of its words an occurrence of a passage covers.

    One automaton of all passages, as sequences of word numbers, is compiled and every text is
    streamed through it once.
    """
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for passage in passages:
        automaton.add_word(passage, len(passage))
    if passages:
        automaton.make_automaton()
    found = []
    for text in texts:
        edges = np.zeros(len(text) + 1, dtype=np.int64)
        if passages:
            for end, length in automaton.iter(tuple(text)):
                edges[end - length + 1] += 1
                edges[end + 1] -= 1
        found.append(np.cumsum(edges)[:-1] > 0)
    return found


def _locator(settings: RepeatSettings):
    """Texts of a batch are dealt to shards; each compiles its confirmed passages and streams its texts."""

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard: list = []
            size = 0
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                shard.append(row)
                size += len(row[2])
                if size >= _SHARD_CHARACTERS:
                    yield _located(shard, settings)
                    shard, size = [], 0
            if shard:
                yield _located(shard, settings)

    return locate


def _located(shard: list, settings: RepeatSettings) -> pa.RecordBatch:
    numbers: dict[bytes, int] = {}
    split = [words_of(text) for _, _, text, _ in shard]
    texts = [[numbers.setdefault(word, len(numbers)) for word in words] for words in split]
    passages = {
        tuple(text[start:stop])
        for text, (_, _, _, parts) in zip(texts, shard)
        for start, stop in _passages(parts, settings.window)
    }
    covered = covered_words(texts, sorted(passages))
    kept = [b" ".join([w for w, gone in zip(words, mask) if not gone]).decode("utf-8", "replace") for words, mask in zip(split, covered)]
    return _batch(
        "k1 k2 n_removed kept_text",
        pa.array([row[0] for row in shard], pa.int64()),
        pa.array([row[1] for row in shard], pa.int64()),
        pa.array([int(mask.sum()) for mask in covered], pa.int64()),
        pa.array(kept, pa.string()),
    )


def keyed(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The input with a 128-bit key of its text, by which copies share all work."""
    text = F.col(text_col).cast("string")
    return without(docs, *KEY).withColumn("k1", F.xxhash64(text)).withColumn("k2", F.xxhash64(F.lit("again"), text))


def repeated_passages(
    docs: DataFrame, text_col: str = "text", settings: RepeatSettings = RepeatSettings()
) -> DataFrame:
    """What is left of each text that holds a repeat: (k1, k2) of its key, ``n_removed``, ``kept_text``.

    A word goes if a window of ``window`` words around it also starts anywhere else, in the same
    text or another, on the input as it is. Texts without a repeat, NULL ones among them, have
    no row.

    1. Every text sends the phrases that stand for its windows, with their number of places.
       A window can only occur again if its phrase does.
    2. Texts with such phrases are read once more, one of each set of copies, and cut into
       segments, runs of windows with the same phrase. If all segments of a phrase have the same
       words and there are two of them, all their windows are confirmed. Else their windows are
       counted by a 128-bit hash. A passage in a third of all texts is a few counters: its inner
       segments are all equal, and rows combine before the shuffle.
    3. The texts, with their confirmed passages, are dealt to shards. A shard compiles an
       automaton of its passages and streams its texts through it. Passages compare word by
       word there. Shards are cut by size, so an automaton is bounded at any size of the corpus.
    """
    texts = keyed(docs.select(F.col(text_col).cast("string").alias("text"))).filter("text is not null")
    marks, _ = stored(
        texts.select("k1", "k2", "text").mapInArrow(_sampler(settings), "phrase long, k1 long, k2 long, places long"),
        "repeat-marks",
    )
    again, _ = stored(
        marks.groupBy("phrase").agg(F.sum("places").alias("places")).filter("places > 1").select("phrase"), "repeat-phrases"
    )
    listed, _ = stored(
        marks.join(again, "phrase").groupBy("k1", "k2").agg(F.collect_set("phrase").alias("phrases")), "repeat-listed"
    )
    single = texts.groupBy("k1", "k2").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    known, _ = stored(single.join(listed, KEY).select("k1", "k2", "text", "copies", "phrases"), "repeat-texts")
    segments, _ = stored(
        known.mapInArrow(
            _segmenter(settings), "phrase long, body long, k1 long, k2 long, start long, n long, copies long"
        ),
        "repeat-segments",
    )
    alike, _ = stored(
        segments.groupBy("phrase")
        .agg(F.min("body").alias("low"), F.max("body").alias("high"), F.sum("copies").alias("times"))
        .select("phrase", ((F.col("low") == F.col("high")) & (F.col("times") > 1)).alias("settled")),
        "repeat-alike",
    )
    judged, _ = stored(segments.join(alike, "phrase"), "repeat-judged")
    open_parts = judged.filter("not settled").groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "n")).alias("parts"))
    windows, _ = stored(
        known.join(open_parts, KEY)
        .select("k1", "k2", "text", "copies", "parts")
        .mapInArrow(_windower(settings), "w1 long, w2 long, k1 long, k2 long, start long, copies long"),
        "repeat-windows",
    )
    twice, _ = stored(
        windows.groupBy("w1", "w2").agg(F.sum("copies").alias("times")).filter("times > 1").select("w1", "w2"), "repeat-twice"
    )
    confirmed = judged.filter("settled").select("k1", "k2", "start", "n").union(
        windows.join(twice, ["w1", "w2"]).select("k1", "k2", "start", F.lit(1).cast("long"))
    )
    parts, _ = stored(confirmed.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "n")).alias("parts")), "repeat-parts")
    located = known.select("k1", "k2", "text").join(parts, KEY).select("k1", "k2", "text", "parts")
    return stored(
        located.mapInArrow(_locator(settings), "k1 long, k2 long, n_removed long, kept_text string"), "repeat-kept"
    )[0]


def joined_words(text: Column) -> Column:
    """The words of a text with single spaces between them; empty for NULL."""
    return F.coalesce(F.array_join(F.regexp_extract_all(text, F.lit(f"({WORD})")), " "), F.lit(""))


def drop_repeats(docs: DataFrame, text_col: str = "text", settings: RepeatSettings = RepeatSettings()) -> DataFrame:
    """The input's rows with ``kept_text``: the words that no repeat covers, single spaces between."""
    kept = repeated_passages(docs, text_col, settings)
    marked = keyed(without(docs, "kept_text", "n_removed"), text_col)
    out = marked.join(kept, KEY, "left")
    return out.withColumn("kept_text", F.coalesce("kept_text", joined_words(F.col(text_col)))).drop(*KEY, "n_removed")
