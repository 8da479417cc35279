"""SentencePiece encoding and decoding, with a max-plus scan over chunks of giant texts.

The best segmentation is the path of greatest total score. Chunk boundaries have few states: by
how many characters the piece that crosses them reaches into the next chunk. A chunk is a matrix
between the states of its two ends, matrices multiply in the max-plus semiring in any grouping,
and once the states at all boundaries are known every chunk is traced back on its own.

Scores are whole numbers, so sums are exact in any grouping. Of paths with equal totals the one
wins whose last piece is longer, then the one before it, and so on. A matrix carries that order
along, so the choice does not depend on where chunks end.
"""

from __future__ import annotations

import math
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanseason.llm.common import cut_batch, cut_by_text, without
from loanseason.session import stored

MODEL_PATH = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
_NONE = -math.inf
#: Scores are whole multiples of 1 / _UNIT: sums stay below 2**53, hence exact, for any text that fits a row.
_UNIT = 2**18
_REMEMBERED = 300_000
#: Characters of text, or ids, that are worked on at a time.
_AT_ONCE = 4_000_000
#: A segment is a run of spaces with what follows; pieces hold spaces only in front, so none crosses its ends.
_SEGMENT = re.compile(r" *[^ ]+| +")


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with ids and scores. ``longest`` is in characters; ``written`` has each id's bytes."""

    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: tuple[int, ...]
    unknown: float
    longest: int
    written: tuple[bytes, ...]

    def frequency(self, piece: str | None) -> float:
        """What the score of a piece is the logarithm of, up to a common factor; None is an unknown character."""
        return math.exp((self.unknown if piece is None else self.scores[piece]) / _UNIT)


def load_vocabulary(path: str = MODEL_PATH) -> Vocabulary:
    """Read a public model's vocabulary on the driver.

    Its scores are merge ranks, which do not add up along a text. The score of a piece is the
    logarithm of a frequency that falls with its rank (Zipf), in whole steps of 1 / _UNIT. A
    character that is no piece scores ten below the rarest and is written as its bytes.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, scores, byte_ids, written = {}, {}, [0] * 256, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            written.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            written.append(b"")
        else:
            key = piece.replace("▁", " ")
            ids[key], scores[key] = i, float(-round(math.log(i + 1.0) * _UNIT))
            written.append(key.encode())
    return Vocabulary(
        ids, scores, tuple(byte_ids), min(scores.values()) - 10.0 * _UNIT, max(map(len, ids)), tuple(written)
    )


def best_path(text: str, begin: int, end: int, vocabulary: Vocabulary) -> tuple[float, list[int]]:
    """Score and ids of the best segmentation of text[begin:end]. Ties go to the longer last piece."""
    size = end - begin
    scores, longest, unknown = vocabulary.scores, vocabulary.longest, vocabulary.unknown
    best, origin = [_NONE] * (size + 1), [0] * (size + 1)
    best[0] = 0.0
    part = text[begin:end]
    for start in range(size):
        base = best[start]
        for stop in range(start + 1, min(size, start + longest) + 1):
            score = scores.get(part[start:stop])
            if score is not None and base + score > best[stop]:
                best[stop], origin[stop] = base + score, start
        if part[start] not in scores and base + unknown > best[start + 1]:
            best[start + 1], origin[start + 1] = base + unknown, start
    spans, stop = [], size
    while stop:
        spans.append((origin[stop], stop))
        stop = origin[stop]
    ids: list[int] = []
    for start, stop in reversed(spans):
        piece = vocabulary.ids.get(part[start:stop])
        if piece is not None:
            ids.append(piece)
        else:
            ids.extend(vocabulary.byte_ids[b] for b in part[start:stop].encode())
    return best[size], ids


class Segmenter:
    """Best segmentations, with all occurrences of pieces found by one automaton."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.automaton = ahocorasick.Automaton()
        for piece, number in vocabulary.ids.items():
            self.automaton.add_word(piece, (len(piece), vocabulary.scores[piece], number))
        self.automaton.make_automaton()
        self.single = frozenset(p for p in vocabulary.ids if len(p) == 1)

    def path(self, segment: str) -> tuple[float, list[int]]:
        """The same as ``best_path`` over a whole segment; pieces come in order of their ends."""
        if not self.single.issuperset(segment):
            return best_path(segment, 0, len(segment), self.vocabulary)
        size = len(segment)
        best, origin, chosen = [_NONE] * (size + 1), [0] * (size + 1), [0] * (size + 1)
        best[0] = 0.0
        for last, (length, score, number) in self.automaton.iter(segment):
            start = last + 1 - length
            total = best[start] + score
            if total > best[last + 1]:
                best[last + 1], origin[last + 1], chosen[last + 1] = total, start, number
        ids, stop = [], size
        while stop:
            ids.append(chosen[stop])
            stop = origin[stop]
        ids.reverse()
        return best[size], ids


class Encoder(dict):
    """Ids, packed as 32-bit integers, of segments; forgets all when it has met too many."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.segmenter = Segmenter(vocabulary)

    def __missing__(self, segment: str) -> bytes:
        packed = array("i", self.segmenter.path(segment)[1]).tobytes()
        if len(segment) <= 64:
            if len(self) >= _REMEMBERED:
                self.clear()
            self[segment] = packed
        return packed

    def encode(self, spaced: str) -> bytes:
        return b"".join(map(self.__getitem__, _SEGMENT.findall(spaced)))


def chunk_bounds(length: int, size: int, longest: int) -> list[int]:
    """Ends of chunks; the last is never shorter than a piece."""
    ends = list(range(size, length, size))
    if ends and length - ends[-1] < longest:
        ends.pop()
    return [0, *ends, length]


def _clean_cuts(text: str, length: int) -> tuple[int, int] | None:
    """First and last place inside text[:length] that no piece crosses."""
    first = last = None
    found = re.search(r"[^ ] ", text[:length])
    if found:
        first = found.start() + 1
        at = length
        while True:
            at = text.rfind(" ", 0, at)
            if at < 1 or text[at - 1] != " ":
                break
        last = at if at >= first else first
    return None if first is None else (first, last)


@dataclass(frozen=True)
class Transfer:
    """Best scores from entry states (rows) to exit states (columns), and how entries tie.

    Of two entries with the same total at an exit, the one of smaller ``place`` in that column wins.
    """

    score: np.ndarray
    place: np.ndarray


def transfer_matrix(text: str, length: int, final: bool, vocabulary: Vocabulary, middle: bool = False) -> Transfer:
    """Best score from each entry state to each exit state of the chunk text[:length].

    What follows in ``text`` is the beginning of the next chunk. State k: the first k characters
    belong to the piece that crosses the boundary. A piece counts in the chunk where it starts.
    Between the first and the last place that no piece crosses, all paths score the same. That
    number is the same in all entries and changes no choice of states, so it is left out
    unless ``middle`` asks for it.
    """
    states = vocabulary.longest
    cuts = _clean_cuts(text, length)
    if cuts is None:
        return _sweep(text, length, final, vocabulary, states)
    first, last = cuts
    head = _sweep(text[:first], first, True, vocabulary, states)
    tail = _sweep(text[last:], length - last, final, vocabulary, 1)
    between = 0.0
    if middle:
        segmenter = Segmenter(vocabulary)
        between = sum(segmenter.path(segment)[0] for segment in _SEGMENT.findall(text[first:last]))
    # All paths meet where no piece crosses, so entries tie in the same order at every exit.
    return Transfer(
        head.score[:, :1] + between + tail.score[:1], np.repeat(head.place[:, :1], states, axis=1)
    )


def _order(keys: np.ndarray) -> np.ndarray:
    """Places of the keys in each column."""
    return np.argsort(np.argsort(keys, axis=0, kind="stable"), axis=0, kind="stable")


def _sweep(text: str, length: int, final: bool, vocabulary: Vocabulary, entries: int) -> Transfer:
    """The matrix by dynamic programming over all positions, for the first ``entries`` entry states.

    Per position and entry: best score, start of the last piece, and the place of the entry among
    all that end here. A path that enters at a position has its last piece in the chunk before,
    which is longer than any piece of this chunk that ends there; its start counts as -1.
    """
    states, scores = vocabulary.longest, vocabulary.scores
    limit = length if final else min(len(text), length + states - 1)
    best = np.full((limit + 1, entries), _NONE)
    origin = np.full((limit + 1, entries), -1, dtype=np.int64)
    place = np.zeros((limit + 1, entries), dtype=np.int64)
    each = np.arange(entries)
    for entry in range(min(entries, length + 1)):
        best[entry, entry] = 0.0

    def arrive(start: int, stop: int, totals: np.ndarray) -> None:
        better = totals > best[stop]
        best[stop][better] = totals[better]
        origin[stop][better] = start

    def settle(at: int) -> None:
        if entries > 1:
            came = origin[at]
            place[at] = _order(came * entries + np.where(came >= 0, place[came, each], 0))

    for start in range(length):
        settle(start)
        base = best[start]
        for stop in range(start + 1, min(limit, start + states) + 1):
            score = scores.get(text[start:stop])
            if score is not None:
                arrive(start, stop, base + score)
        if text[start] not in scores:
            arrive(start, start + 1, base + vocabulary.unknown)
    matrix = Transfer(np.full((entries, states), _NONE), np.zeros((entries, states), dtype=np.int64))
    for state in range(min(states, limit - length + 1)):
        settle(length + state)
        matrix.score[:, state], matrix.place[:, state] = best[length + state], place[length + state]
    return matrix


def max_plus(left: Transfer, right: Transfer) -> Transfer:
    """Product in the max-plus semiring; of equal sums the path whose right part comes first."""
    sums = left.score[:, :, None] + right.score[None, :, :]
    score = sums.max(axis=1)
    over = len(right.score)
    via = np.where(sums == score[:, None, :], right.place[None, :, :], over).argmin(axis=1)
    rows, columns = np.indices(score.shape)
    return Transfer(score, _order(right.place[via, columns] * len(left.score) + left.place[rows, via]))


def boundary_states(matrices: list[Transfer], entry: int, leave: int) -> list[int]:
    """States at all boundaries of the best path from ``entry`` to ``leave``."""
    reach = [np.full(len(matrices[0].score), _NONE)]
    reach[0][entry] = 0.0
    for matrix in matrices:
        reach.append((reach[-1][:, None] + matrix.score).max(axis=0))
    states = [leave]
    for matrix, before in zip(reversed(matrices), reversed(reach[:-1])):
        totals = before + matrix.score[:, states[-1]]
        equal = np.flatnonzero(totals == totals.max())
        states.append(int(equal[np.argmin(matrix.place[equal, states[-1]])]))
    states.reverse()
    return states


def _pack(matrix: Transfer) -> bytes:
    return matrix.score.astype("<f8").tobytes() + matrix.place.astype("<u2").tobytes()


def _unpack(raw: bytes) -> Transfer:
    side = math.isqrt(len(raw) // 10)
    score = np.frombuffer(raw, "<f8", side * side).reshape(side, side)
    place = np.frombuffer(raw, "<u2", offset=side * side * 8).astype(np.int64).reshape(side, side)
    return Transfer(score, place)


def _chunked(size: int, longest: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(*(c.to_pylist() for c in batch.columns)):
                spaced = " " + text
                bounds = chunk_bounds(len(spaced), size, longest)
                ends = list(zip(bounds, bounds[1:]))
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": pa.array([key] * len(ends)),
                        "chunk": pa.array(range(len(ends)), pa.int64()),
                        "body": pa.array([spaced[start : stop + longest] for start, stop in ends]),
                        "length": pa.array([stop - start for start, stop in ends], pa.int64()),
                        "final": pa.array([stop == len(spaced) for _, stop in ends]),
                    }
                )

    return cut


def _measured(vocabulary: Vocabulary):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, chunks, bodies, lengths, finals = (c.to_pylist() for c in batch.columns)
            packed = [_pack(transfer_matrix(b, n, f, vocabulary)) for b, n, f in zip(bodies, lengths, finals)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["key", "at", "matrix"]
            )

    return measure


_STATES = "key string, at long, entry int, leave int"


def _solve(matrices: DataFrame, fan: int) -> DataFrame:
    """Entry and exit state of every matrix (key, at), by products of ``fan`` neighbours at a time."""
    highest = matrices.agg(F.max("at")).first()[0]
    if highest is None or highest < fan:
        whole = matrices.withColumn("entry", F.lit(0)).withColumn("leave", F.lit(0)).withColumn("group", F.lit(0))
        return whole.groupBy("key", "group").applyInArrow(_place, _STATES)
    grouped = matrices.withColumn("group", F.floor(F.col("at") / fan).cast("long"))
    above, _ = stored(grouped.groupBy("key", "group").applyInArrow(_multiply, "key string, at long, matrix binary"), "piece-products")
    solved, _ = stored(_solve(above, fan), "piece-states")
    ends = solved.withColumnRenamed("at", "group")
    return grouped.join(ends, ["key", "group"]).select("key", "at", "matrix", "entry", "leave", "group").groupBy(
        "key", "group"
    ).applyInArrow(_place, _STATES)


def _multiply(group: pa.Table) -> pa.Table:
    rows = group.select(["key", "at", "matrix", "group"]).sort_by("at").to_pydict()
    product = _unpack(rows["matrix"][0])
    for raw in rows["matrix"][1:]:
        product = max_plus(product, _unpack(raw))
    return pa.table({"key": [rows["key"][0]], "at": [rows["group"][0]], "matrix": pa.array([_pack(product)], pa.binary())})


def _place(group: pa.Table) -> pa.Table:
    rows = group.sort_by("at").to_pydict()
    states = boundary_states([_unpack(raw) for raw in rows["matrix"]], rows["entry"][0], rows["leave"][0])
    return pa.table(
        {
            "key": pa.array(rows["key"], pa.string()),
            "at": pa.array(rows["at"], pa.int64()),
            "entry": pa.array(states[:-1], pa.int32()),
            "leave": pa.array(states[1:], pa.int32()),
        }
    )


def _ids_array(packed: list[bytes | None]) -> pa.Array:
    """A list column over all ids of a batch; None stays NULL."""
    sizes = [0 if p is None else len(p) // 4 for p in packed]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join(p for p in packed if p), dtype="<i4"))
    missing = pa.array([p is None for p in packed], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=missing)


def _traced(vocabulary: Vocabulary):
    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in (part for whole in batches for part in cut_by_text(whole, 2, _AT_ONCE)):
            bodies, lengths, entries, leaves = (c.to_pylist() for c in batch.columns[2:])
            packed = []
            for body, length, entry, leave in zip(bodies, lengths, entries, leaves):
                packed.append(encoder.encode(body[entry : length + leave]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), _ids_array(packed)], names=["key", "chunk", "ids"]
            )

    return trace


def encode(
    docs: DataFrame,
    text_col: str = "text",
    path: str = MODEL_PATH,
    chunk_chars: int = 16_384,
    fan: int = 64,
) -> DataFrame:
    """Every input row with ``ids``, an array of piece ids.

    A text of one chunk has known boundary states and is traced where it is read. Longer texts
    go to chunks that are dealt out over all tasks; their matrices are multiplied ``fan`` at a
    time, so no task holds more than that of one text, and each chunk is traced back alone.
    Pieces, as in the public model, hold spaces only in front, so inside a chunk every word is
    solved once and remembered.

    A space is put before the text, as the model's makers do. NULL texts have NULL ids, empty
    ones no ids. Of several segmentations with the same total the one is taken whose last pieces
    are longer, wherever chunks end: ids are the same at any ``chunk_chars``. Equal texts share
    their chunks. An input column named ``ids`` is replaced.
    """
    vocabulary = load_vocabulary(path)
    rows = without(docs, "ids", "__key", "__ids")
    is_long = F.length(text_col) + 1 > chunk_chars + vocabulary.longest
    names, text_at = rows.columns, rows.columns.index(text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in (part for whole in batches for part in cut_by_text(whole, text_at, _AT_ONCE)):
            packed = [
                None if text is None else encoder.encode(" " + text) if text else b""
                for text in batch.column(text_at).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, _ids_array(packed)], names=[*names, "ids"])

    short = rows.filter(~F.coalesce(is_long, F.lit(False))).mapInArrow(write, f"{schema}, ids array<int>")
    long_rows = rows.filter(is_long).withColumn("__key", F.sha2(text_col, 256))
    texts = long_rows.select(F.col("__key").alias("key"), F.col(text_col).alias("body")).dropDuplicates(["key"])
    chunks = texts.mapInArrow(
        _chunked(chunk_chars, vocabulary.longest),
        "key string, chunk long, body string, length long, final boolean",
    )
    chunks, seen = stored(chunks, "piece-chunks")
    if not seen["rows"]:
        return short
    spread = chunks.repartition("key", "chunk")
    matrices, _ = stored(spread.mapInArrow(_measured(vocabulary), "key string, at long, matrix binary"), "piece-matrices")
    states, _ = stored(_solve(matrices, fan), "piece-states")
    traced = (
        chunks.join(states.withColumnRenamed("at", "chunk"), ["key", "chunk"])
        .select("key", "chunk", "body", "length", "entry", "leave")
        .mapInArrow(_traced(vocabulary), "key string, chunk long, ids array<int>")
    )
    whole = traced.groupBy("key").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "ids"))), lambda c: c["ids"])).alias("ids")
    )
    whole, _ = stored(whole, "piece-ids")
    long_done = long_rows.join(whole.withColumnRenamed("key", "__key"), "__key").select(*names, "ids")
    return short.unionByName(long_done)


def decode(rows: DataFrame, ids_col: str = "ids", path: str = MODEL_PATH, out: str = "decoded") -> DataFrame:
    """Every input row with the text that its ids stand for, the exact inverse of ``encode``.

    NULL ids give NULL, no ids an empty text. A column of the name ``out`` is replaced.
    """
    written = load_vocabulary(path).written
    kept = without(rows, out)
    names, at = kept.columns, kept.columns.index(ids_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blob = np.frombuffer(b"".join(written), dtype=np.uint8)
        lengths = np.array([len(w) for w in written])
        begins = np.cumsum(lengths) - lengths
        for whole in batches:
            for batch in cut_batch(whole, pc.list_value_length(whole.column(at)), _AT_ONCE // 4):
                listed = batch.column(at)
                ids = listed.flatten().to_numpy(zero_copy_only=False)
                size = lengths[ids]
                ends = np.cumsum(size)
                raw = blob[np.repeat(begins[ids] - (ends - size), size) + np.arange(size.sum())].tobytes()
                upto = np.concatenate([[0], ends])
                counts = pc.fill_null(pc.list_value_length(listed), 0).to_numpy(zero_copy_only=False)
                stops = np.cumsum(counts)
                texts = [
                    raw[upto[stop - n] : upto[stop]].decode("utf-8", "replace").removeprefix(" ") if there else None
                    for n, stop, there in zip(counts.tolist(), stops.tolist(), listed.is_valid().to_pylist())
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, out])

    return kept.mapInArrow(read, f"{schema}, `{out}` string")
