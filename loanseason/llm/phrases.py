"""Phrases that recur: counts as weighted acyclic automata, united by prefix, with the score of their parts."""

from __future__ import annotations

import io
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanseason.session import stored

#: A-Z in lower case, signs that end a piece as a line feed, and the tab as a space.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz\n\n\n\n\n\n\n\n\n ")
_CHUNK = 2_000_000
_REMEMBERED = 300_000
_LOW = np.int64(0xFFFFFFFF)
_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class PhraseSettings:
    """Phrases of 2 to ``longest`` words with at least ``least`` occurrences are candidates.

    A candidate goes if a longer one that holds it has ``cover`` percent of its occurrences. A task
    counts ``window`` words at a time, or words until it holds ``words_held`` different ones; a gate has 2 ** ``gate_bits`` bits at any size of the corpus;
    a prefix range stands for about ``range_words`` words of the corpus, and at most ``fan_in``
    automata are united at once.
    """

    longest: int = 4
    least: int = 30
    cover: int = 80
    top: int = 2000
    window: int = 2_000_000
    words_held: int = 500_000
    gate_bits: int = 26
    range_words: int = 4_000_000
    most_ranges: int = 8192
    fan_in: int = 512


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * _M1
    values = (values ^ (values >> np.uint64(27))) * _M2
    return values ^ (values >> np.uint64(31))


def _lead(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """What a pair of words is known by in a gate."""
    return _mix(first * _STEP + _mix(second + _STEP))


def _unused_bytes(codes: np.ndarray) -> int:
    """How many low bytes of all codes are zero."""
    low = int(np.bitwise_or.reduce(codes, initial=np.uint64(0)))
    return next((k for k in range(7) if low >> 8 * k & 0xFF), 7)


def _summed(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal phrases once, in the order of their words' codes, with the sum of their counts."""
    rank, at = np.zeros(len(counts), np.int64), np.zeros(0, np.int64)
    for column in columns:
        _, place = np.unique(column, return_inverse=True)
        _, at, rank = np.unique(rank << np.int64(32) | place, return_index=True, return_inverse=True)
    total = np.zeros(len(at), np.int64)
    np.add.at(total, rank, counts)
    return [c[at] for c in columns], total


class CountAutomaton:
    """Phrases of one length and their counts: an acyclic automaton over word codes.

    The states of layer k are the different continuations after k words; equal ones are one
    state. An arc knows how many phrases its state accepts before it, so the way of a phrase adds
    up to its place among all in order, where its count stands.
    """

    def __init__(self, layers: list[tuple[np.ndarray, ...]], counts: np.ndarray) -> None:
        self.layers, self.counts = layers, counts

    @classmethod
    def build(cls, columns: list[np.ndarray], counts: np.ndarray) -> CountAutomaton:
        """From different phrases in order. Layers are settled from the last to the first."""
        size = len(counts)
        new = np.zeros(size, dtype=bool)
        new[:1] = True
        firsts = [np.flatnonzero(new)]
        for column in columns:
            new[1:] |= column[1:] != column[:-1]
            firsts.append(np.flatnonzero(new))
        layers: list[tuple[np.ndarray, ...]] = []
        targets = np.zeros(size, np.int32)
        for k in range(len(columns) - 1, -1, -1):
            arcs, states = firsts[k + 1], firsts[k]
            labels = columns[k][arcs]
            edges = np.append(np.searchsorted(arcs, states), len(arcs))
            owner = np.repeat(np.arange(len(states)), np.diff(edges))
            before = arcs - states[owner]
            if k == 0 or not size:
                kept = np.arange(len(states))
                merged = kept
            else:
                one = _mix(labels + _mix(targets.astype(np.uint64) + _STEP))
                signs = [np.add.reduceat(v, edges[:-1]) for v in (one, _mix(one + _STEP))]
                _, inverse = np.unique(signs[0], return_inverse=True)
                _, second = np.unique(signs[1], return_inverse=True)
                _, kept, merged = np.unique(inverse.astype(np.int64) << np.int64(32) | second, return_index=True, return_inverse=True)
            widths = np.diff(edges)[kept]
            pick = np.repeat(edges[kept] - np.concatenate([[0], np.cumsum(widths)[:-1]]), widths) + np.arange(widths.sum()) if len(kept) else kept
            layers.insert(0, (np.append(0, np.cumsum(widths)), labels[pick], targets[pick], before[pick]))
            targets = merged.astype(np.int32)
        return cls(layers, np.asarray(counts, np.int64))

    def phrases(self) -> list[np.ndarray]:
        """The words of all phrases in order, one array for each place."""
        state, columns = np.zeros(min(1, len(self.counts)), np.int64), []
        for edges, labels, targets, _ in self.layers:
            widths = edges[state + 1] - edges[state]
            starts = np.repeat(edges[state] - np.concatenate([[0], np.cumsum(widths)[:-1]]), widths) if len(state) else state
            arc = starts + np.arange(len(starts))
            columns = [np.repeat(c, widths) for c in columns]
            columns.append(labels[arc])
            state = targets[arc].astype(np.int64)
        return columns

    def look_up(self, columns: list[np.ndarray]) -> np.ndarray:
        """Counts of the given phrases, 0 where the automaton does not accept one."""
        size = len(columns[0])
        if not len(self.counts):
            return np.zeros(size, np.int64)
        state, place, found = np.zeros(size, np.int64), np.zeros(size, np.int64), np.ones(size, dtype=bool)
        for (edges, labels, targets, before), wanted in zip(self.layers, columns):
            low, high = edges[state], edges[state + 1]
            last = high - 1
            while (low < high).any():
                middle = (low + high) // 2
                less = (labels[np.minimum(middle, len(labels) - 1)] < wanted) & (low < high)
                low, high = np.where(less, middle + 1, low), np.where(less, high, np.minimum(high, middle))
            arc = np.minimum(low, last)
            found &= labels[arc] == wanted
            place += before[arc]
            state = targets[arc].astype(np.int64)
        return np.where(found, self.counts[np.where(found, place, 0)], 0)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        for array in (*(a for layer in self.layers for a in layer), self.counts):
            if array.dtype == np.uint64:
                narrow = array.astype("<u8").view(np.uint8).reshape(-1, 8)[:, _unused_bytes(array) :]
            else:
                narrow = array.astype(np.min_scalar_type(int(array.max(initial=0))))
            np.save(out, narrow, allow_pickle=False)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes, words: int) -> CountAutomaton:
        source = io.BytesIO(data)
        read = lambda: np.load(source, allow_pickle=False)
        layers = []
        for _ in range(words):
            edges, labels, targets, before = (read() for _ in range(4))
            wide = np.zeros((len(labels), 8), np.uint8)
            wide[:, 8 - labels.shape[1] :] = labels
            layers.append((edges.astype(np.int64), wide.view("<u8").reshape(-1), targets, before.astype(np.int64)))
        return cls(layers, read().astype(np.int64))

    @classmethod
    def union(cls, parts: list[CountAutomaton], least: int = 1) -> CountAutomaton:
        """All phrases of all parts with the sums of their counts, where these reach ``least``."""
        columns = [np.concatenate(c) for c in zip(*(p.phrases() for p in parts))]
        columns, counts = _summed(columns, np.concatenate([p.counts for p in parts]))
        keep = counts >= least
        return cls.build([c[keep] for c in columns], counts[keep])


@dataclass(frozen=True)
class Coding:
    """How words get their codes: the ``bits`` high bits of a hash that both Spark and tasks compute."""

    seed: int = 0
    bits: int = 64

    def column(self) -> Column:
        return F.shiftleft(F.shiftright(F.xxhash64(F.lit(str(self.seed)), "lang", "word"), 64 - self.bits), 64 - self.bits)

    def of_language(self, lang: str) -> Callable[[bytes], int]:
        start = xxhash.xxh64_intdigest(lang.encode(), xxhash.xxh64_intdigest(str(self.seed).encode(), 42))
        mask = (1 << 64) - (1 << (64 - self.bits))
        return lambda word: xxhash.xxh64_intdigest(word, start) & mask

    def wider(self) -> Coding:
        return Coding(self.seed, self.bits + 8) if self.bits < 64 else Coding(self.seed + 1, 64)


class _Numbers(dict):
    """Word to number. Words that the gate stops share number 0 with the ends of pieces."""

    def __init__(self, code_of: Callable[[bytes], int], admits: Callable[[int], bool]) -> None:
        super().__init__({b"\n": 0})
        self.code_of, self.admits, self.codes = code_of, admits, [0]

    def __missing__(self, word: bytes) -> int:
        code = self.code_of(word)
        number = 0
        if self.admits(code):
            number = len(self.codes)
            self.codes.append(code)
        self[word] = number
        return number


def _chunks(text: bytes) -> Iterator[bytes]:
    """A folded text in parts of about the same size; no word is cut."""
    at = 0
    while at < len(text):
        stop = at + _CHUNK
        while stop < len(text) and text[stop] not in b" \n":
            stop += 1
        yield text[at:stop]
        at = stop


def _tokens(chunk: bytes) -> Iterator[bytes]:
    return filter(None, chunk.replace(b"\n", b" \n ").split(b" "))


class _Stream:
    """The words of one language in a task, as numbers, counted a window at a time."""

    def __init__(self, lang: str, coding: Coding, admits: Callable[[int], bool], longest: int) -> None:
        self.make = lambda: _Numbers(coding.of_language(lang), admits)
        self.kept = longest - 1
        self.restart()

    def restart(self) -> None:
        self.numbers = self.make()
        self.parts: list[np.ndarray] = []
        self.size = self.carry = 0

    def add(self, chunk: bytes) -> None:
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, _tokens(chunk)), np.int32))
        self.size += len(self.parts[-1])

    def take(self) -> tuple[np.ndarray, np.ndarray, int]:
        """(ranks of words by code, 0 at ends; codes by rank; leading words that were counted before)."""
        whole = np.concatenate([np.zeros(0, np.int32), *self.parts])
        codes = np.array(self.numbers.codes, dtype=np.uint64)
        ordered, rank = np.unique(codes[1:], return_inverse=True)
        ranks = np.append(0, rank + 1).astype(np.int64)[whole]
        carry, self.carry = self.carry, min(self.kept, len(whole))
        tail = whole[len(whole) - self.carry :]
        if len(self.numbers) > _REMEMBERED:
            self.numbers = self.make()
            self.numbers.codes += codes[tail].tolist()
            tail = np.where(tail > 0, np.arange(1, len(tail) + 1), 0).astype(np.int32)
        self.parts, self.size = [tail], len(tail)
        return ranks, np.append(np.uint64(0), ordered), carry


def _bit_test(gate: np.ndarray, bits: int) -> Callable[[np.ndarray], np.ndarray]:
    def admits(codes: np.ndarray) -> np.ndarray:
        slot = codes >> np.uint64(64 - bits)
        return (gate[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1

    return admits


def _word_gate(gate: np.ndarray, bits: int) -> Callable[[int], bool]:
    def admits(code: int) -> bool:
        slot = code >> (64 - bits)
        return bool(int(gate[slot >> 6]) >> (slot & 63) & 1)

    return admits


def _levels(
    words: np.ndarray, codes: np.ndarray, carry: int, upto: int, pairs: Callable[[np.ndarray], np.ndarray] | None
) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """(columns, counts) of the phrases of a window: pairs if there is no gate of pairs, else the longer ones.

    A longer phrase counts where all pairs in it pass the gate.
    """
    starts = np.flatnonzero((words[:-1] > 0) & (words[1:] > 0))
    key, inverse = np.unique(words[starts] << np.int64(32) | words[starts + 1], return_inverse=True)
    columns = [codes[key >> np.int64(32)], codes[key & _LOW]]
    for size in range(2, upto + 1):
        if size > 2:
            free = good[starts + size - 2] & (starts + size <= len(words))
            starts, inverse = starts[free], inverse[free]
            key, inverse = np.unique(inverse.astype(np.int64) << np.int64(32) | words[starts + size - 1], return_inverse=True)
            columns = [c[key >> np.int64(32)] for c in columns] + [codes[key & _LOW]]
        elif pairs is not None:
            good = np.zeros(len(words) + upto, dtype=bool)
            good[starts] = pairs(_lead(*columns))[inverse]
            free = good[starts]
            starts, inverse = starts[free], inverse[free]
            continue
        counts = np.bincount(inverse[starts + size > carry], minlength=len(key))
        seen = counts > 0
        yield [c[seen] for c in columns], counts[seen]
        if pairs is None:
            return


def _by_range(columns: list[np.ndarray], counts: np.ndarray, range_bits: int) -> Iterator[tuple[int, CountAutomaton]]:
    part = (columns[0] >> np.uint64(64 - range_bits)).astype(np.int64) if range_bits else np.zeros(len(counts), np.int64)
    order = np.argsort(part, kind="stable")
    edges = np.append(np.flatnonzero(np.diff(part[order], prepend=-1)), len(order))
    for start, stop in zip(edges[:-1], edges[1:]):
        here = order[start:stop]
        yield int(part[here[0]]), CountAutomaton.build([c[here] for c in columns], counts[here])


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """Chunks of the folded texts of rows (lang, text), those of a language joined by line feeds."""

    def cut(pending: dict[str, list[bytes]]) -> Iterator[tuple[str, bytes]]:
        for lang, texts in pending.items():
            for chunk in _chunks(b"\n".join([*texts, b""]).translate(_FOLD)):
                yield lang, chunk

    for batch in batches:
        pending: dict[str, list[bytes]] = {}
        size = 0
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())):
            pending.setdefault(lang, []).append(text.as_py())
            size += len(pending[lang][-1])
            if size >= _CHUNK:
                yield from cut(pending)
                pending, size = {}, 0
        yield from cut(pending)


def _word_counter(settings: PhraseSettings):
    """(lang, word, n) of the words of a task, some hundred thousand different ones at a time."""

    def rows(entry: tuple[str, Counter]) -> pa.RecordBatch:
        lang, seen = entry
        seen.pop(b"\n", None)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(seen), pa.string()),
                pa.array(list(seen), pa.binary()).cast(pa.string()),
                pa.array(list(seen.values()), pa.int64()),
            ],
            names=["lang", "word", "n"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for lang, chunk in _folded(batches):
            held = counts.setdefault(lang, Counter())
            held.update(_tokens(chunk))
            if sum(map(len, counts.values())) > settings.words_held:
                yield from map(rows, counts.items())
                counts = {}
        yield from map(rows, counts.items())

    return count


def _phrase_counter(coding: Coding, settings: PhraseSettings, range_bits: int, words, pairs=None):
    """Automata of each window: the pairs of words that pass the gate, or with a gate of pairs the longer phrases."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        admits = _word_gate(words.value, settings.gate_bits)
        pair_test = _bit_test(pairs.value, settings.gate_bits) if pairs else None
        upto = settings.longest if pairs else 2

        def flush(lang: str, stream: _Stream) -> Iterator[pa.RecordBatch]:
            ranks, codes, carry = stream.take()
            rows = [
                (lang, len(columns), part, automaton.to_bytes())
                for columns, counts in _levels(ranks, codes, carry, upto, pair_test)
                if len(counts)
                for part, automaton in _by_range(columns, counts, range_bits)
            ]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int32(), pa.int32(), pa.binary()))],
                    names=["lang", "size", "part", "automaton"],
                )

        streams: dict[str, _Stream] = {}
        for lang, chunk in _folded(batches):
            if lang not in streams:
                streams[lang] = _Stream(lang, coding, admits, upto)
            streams[lang].add(chunk)
            if streams[lang].size >= settings.window:
                yield from flush(lang, streams[lang])
            elif sum(s.size for s in streams.values()) >= 2 * settings.window:
                for each, stream in streams.items():
                    yield from flush(each, stream)
        for lang, stream in streams.items():
            yield from flush(lang, stream)

    return count


_AUTOMATA = "lang string, size int, part int, automaton binary"


def _unite(least: int):
    def unite(group: pa.Table) -> pa.Table:
        size = group["size"][0].as_py()
        whole = CountAutomaton.union([CountAutomaton.from_bytes(b, size) for b in group["automaton"].to_pylist()], least)
        first = group.slice(0, 1).select(["lang", "size", "part"])
        return first.append_column("automaton", pa.array([whole.to_bytes()], pa.binary()))

    return unite


def _united(shards: DataFrame, settings: PhraseSettings, name: str) -> DataFrame:
    """One automaton for each language, length and prefix range, united in a tree."""
    key = ["lang", "size", "part"]
    shards, _ = stored(shards, f"{name}-shards")
    widest = shards.groupBy(*key).count().agg(F.max("count")).first()[0] or 0
    while widest > settings.fan_in:
        groups = -(-widest // settings.fan_in)
        dealt = shards.withColumn("shard", F.pmod(F.xxhash64("automaton"), F.lit(groups)))
        shards, _ = stored(dealt.groupBy(*key, "shard").applyInArrow(_unite(1), _AUTOMATA), f"{name}-shards")
        widest = groups
    return stored(shards.groupBy(*key).applyInArrow(_unite(settings.least), _AUTOMATA), name)[0]


def _gate(slots: DataFrame, settings: PhraseSettings):
    """Bits of all slots as a broadcast array, of a size that does not depend on the data."""
    slot = F.shiftrightunsigned("code", 64 - settings.gate_bits)
    packed = slots.groupBy(F.shiftright(slot, 6).alias("at")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(slot, F.lit(64)).cast("int"))).alias("bits")
    )
    rows = packed.toArrow()
    gate = np.zeros(max(1, 1 << settings.gate_bits >> 6), dtype=np.uint64)
    gate[rows["at"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return slots.sparkSession.sparkContext.broadcast(gate)


def _lead_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column(0).to_pylist():
            leads = _lead(*CountAutomaton.from_bytes(data, 2).phrases())
            yield pa.RecordBatch.from_arrays([pa.array(leads.view(np.int64))], names=["code"])


def _composed(group: pa.Table) -> pa.Table:
    """The candidates of a prefix range with the counts of their beginnings of two words and more.

    A phrase and its beginnings share a range, so their automata are here together.
    """
    lang = group["lang"][0].as_py()
    automata = {s: CountAutomaton.from_bytes(b, s) for s, b in zip(group["size"].to_pylist(), group["automaton"].to_pylist())}
    tables = []
    for size, automaton in automata.items():
        columns, n = automaton.phrases(), len(automaton.counts)
        starts = [automata[k].look_up(columns[:k]) for k in range(2, size)]
        rows = lambda parts, width: pa.ListArray.from_arrays(
            np.arange(n + 1, dtype=np.int32) * width, pa.array(np.stack(parts, 1).reshape(-1).view(np.int64)) if parts else pa.array([], pa.int64())
        )
        tables.append(
            pa.table({"lang": pa.array([lang] * n, pa.string()), "codes": rows(columns, size), "a": automaton.counts, "begins": rows(starts, size - 2)})
        )
    return pa.concat_tables(tables)


def word_counts(docs: DataFrame, settings: PhraseSettings = PhraseSettings()) -> tuple[DataFrame, Coding]:
    """(lang, word, n, code) of all words, and a coding by which no two words of a language share a code."""
    rows = docs.mapInArrow(_word_counter(settings), "lang string, word string, n long")
    words, seen = stored(rows.groupBy("lang", "word").agg(F.sum("n").alias("n")), "phrase-words")
    coding = Coding(bits=min(64, -(-(2 * seen["rows"].bit_length() + 3) // 8) * 8))
    while True:
        coded = words.withColumn("code", coding.column())
        if coded.groupBy("lang", "code").count().filter("count > 1").isEmpty():
            return coded, coding
        coding = coding.wider()


def candidates(docs: DataFrame, words: DataFrame, coding: Coding, settings: PhraseSettings = PhraseSettings()) -> DataFrame:
    """(lang, codes, a, begins) of all phrases of two words and more that are frequent enough.

    No phrase is more frequent than its parts. So pairs are counted where both words pass a gate
    of frequent words, longer phrases where all pairs pass a gate of frequent pairs. A gate lets
    all through that it has to, and some more, which the counts then rule out.
    """
    frequent = words.filter(F.col("n") >= settings.least)
    total = words.agg(F.sum("n")).first()[0] or 0
    range_bits = min(max(1, total // settings.range_words).bit_length() - 1, settings.most_ranges.bit_length() - 1)
    word_gate = _gate(frequent, settings)
    pairs = _united(docs.mapInArrow(_phrase_counter(coding, settings, range_bits, word_gate), _AUTOMATA), settings, "phrase-pairs")
    automata = pairs
    if settings.longest > 2:
        pair_gate = _gate(pairs.select("automaton").mapInArrow(_lead_codes, "code long"), settings)
        longer = docs.mapInArrow(_phrase_counter(coding, settings, range_bits, word_gate, pair_gate), _AUTOMATA)
        automata = pairs.union(_united(longer, settings, "phrase-longer"))
    composed = automata.groupBy("lang", "part").applyInArrow(_composed, "lang string, codes array<long>, a long, begins array<long>")
    return stored(composed, "phrase-candidates")[0]


def _exact(number: Column) -> Column:
    return number.cast("decimal(20,0)")


def _cut_scores() -> Column:
    """The cut of lowest score, then of fewest words, as (score, k, l, r)."""

    def cut(k: Column) -> Column:
        left = F.when(k == 1, F.element_at("parts", F.size("codes"))).otherwise(F.try_element_at("begins", k - 1))
        right = F.element_at("parts", k)
        score = F.call_function("div", _exact(F.col("a")) * 2_000_000, _exact(left) + _exact(right))
        return F.struct(score.alias("score"), k.alias("k"), left.alias("l"), right.alias("r"))

    return F.array_min(F.transform(F.sequence(F.lit(1), F.size("codes") - 1), cut))


def _uncovered(found: DataFrame, settings: PhraseSettings) -> DataFrame:
    """Candidates that no longer one holds with nearly all of their occurrences."""
    lengths = F.sequence(F.lit(2), F.size("codes") - 1)
    inner = F.flatten(
        F.transform(
            lengths, lambda n: F.transform(F.sequence(F.lit(1), F.size("codes") - n + 1), lambda at: F.slice("codes", at, n))
        )
    )
    covers = (
        found.filter(F.size("codes") > 2)
        .select("lang", F.col("a").alias("longer"), F.explode_outer(inner).alias("codes"))
        .groupBy("lang", "codes")
        .agg(F.max("longer").alias("longer"))
    )
    held = _exact(F.col("longer")) * 100 >= _exact(F.col("a")) * settings.cover
    return found.join(covers, ["lang", "codes"], "left").filter(~F.coalesce(held, F.lit(False))).drop("longer")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", settings: PhraseSettings = PhraseSettings()
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z only), cut at ``.,;:!?`` and line ends and split at spaces and
    tabs. ``a`` counts a phrase within these pieces, overlaps included; ``l`` and ``r`` count the
    two parts of its cut of lowest score floor(2000000 a / (l + r)); ``n`` counts all words of the
    language. NULL languages count as ``und`` and share it with a language of that name. NULL and
    blank texts have no words; repeated rows count as often as they occur; a language without a
    candidate has no row, an empty table none at all. Ties of score and count follow the phrase's
    bytes. Other columns of the input play no part.

    1. Words are counted. Their codes are hashes of as many bytes as keep them apart at their
       number; they are tested against each other, and made wider should two meet.
    2. Tasks number the words of a language and count a window of a few million at a time. The
       sorted phrases of a window become automata, one for each range of their first word.
       Windows overlap where they cut a text.
    3. The automata of a range are united, in a tree where there are many, and sum their counts.
    4. Beginnings of a phrase are looked up in its range. Single words and endings are joined by
       their codes; as keys of a join, hot ones are split by the engine.
    """
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text")
    ).filter("text is not null")
    words, coding = word_counts(rows, settings)
    found = candidates(rows, words, coding, settings)
    frequent, _ = stored(words.filter(F.col("n") >= settings.least), "phrase-frequent")
    kept, _ = stored(_uncovered(found, settings), "phrase-kept")

    known = frequent.select("lang", F.array("code").alias("part"), F.col("n").alias("times")).union(
        found.filter(F.size("codes") < settings.longest).select("lang", F.col("codes").alias("part"), "a")
    )
    ends = F.transform(F.sequence(F.lit(2), F.size("codes")), lambda at: F.slice("codes", at, F.size("codes")))
    asked = kept.select(
        "lang", "codes", "a", "begins", F.posexplode_outer(F.concat(ends, F.array(F.slice("codes", 1, 1)))).alias("no", "part")
    )
    answered = asked.join(known, ["lang", "part"]).groupBy("lang", "codes").agg(
        F.first("a").alias("a"), F.first("begins").alias("begins"), F.array_sort(F.collect_list(F.struct("no", "times"))).alias("parts")
    )
    scored, _ = stored(
        answered.withColumn("parts", F.col("parts.times")).withColumn("cut", _cut_scores()).select("lang", "codes", "a", "cut"),
        "phrase-scored",
    )
    spelled = (
        scored.select("lang", "codes", F.posexplode_outer("codes").alias("no", "code"))
        .join(frequent.select("lang", "code", "word"), ["lang", "code"])
        .groupBy("lang", "codes")
        .agg(F.array_join(F.array_sort(F.collect_list(F.struct("no", "word"))).getField("word"), " ").alias("phrase"))
    )
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    named = scored.join(spelled, ["lang", "codes"]).select(
        "lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").cast("long").alias("score")
    )
    ranked = named.selectExpr("*", "row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank").filter(
        F.col("rank") <= settings.top
    )
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
