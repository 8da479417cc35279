"""Near duplicates: MinHash signatures, banding, verification on full sets, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loanseason.llm.common import folded_words_of, without
from loanseason.llm.components import components
from loanseason.session import stored

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_REMEMBERED = 300_000
#: Shingles hashed at a time; with 160 functions this stays in a core's cache.
_BLOCK = 512


@dataclass(frozen=True)
class NearSettings:
    """Five rows in 32 bands: a pair at similarity 0.8 is missed with probability 3e-6, one at 0.85 with 7e-9.

    ``least_share`` is what part of two signatures must agree before the sets are compared; a
    pair at 0.8 falls below with probability 1e-8.
    """

    words: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 5
    least_share: float = 0.61
    seed: int = 20_240

    @property
    def size(self) -> int:
        return self.bands * self.rows


class _WordHashes(dict):
    """Eight bytes for each word; forgets all when it has met too many."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= _REMEMBERED:
            self.clear()
        self[word] = digest = xxhash.xxh3_64_digest(word)
        return digest


def shingle_set(text: str | None, size: int, hashes: dict) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text; shorter texts are one shingle."""
    words = folded_words_of(text)
    if not words:
        return np.empty(0, dtype=np.uint64)
    codes = np.frombuffer(b"".join(map(hashes.__getitem__, words)), dtype="<u8")
    span = min(size, len(words))
    mixed = np.full(len(words) - span + 1, np.uint64(span) * _M3, dtype=np.uint64)
    for k in range(span):
        mixed = (mixed ^ (mixed >> np.uint64(31))) * _M1 + codes[k : len(words) - span + 1 + k] * _M2
    mixed ^= mixed >> np.uint64(29)
    mixed *= _M3
    return np.unique(mixed ^ (mixed >> np.uint64(32)))


def _functions(settings: NearSettings) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and offsets of the universal hash functions."""
    draw = np.random.default_rng(settings.seed)
    numbers = draw.integers(0, 2**63, size=(2, settings.size, 1), dtype=np.uint64)
    return numbers[0] * np.uint64(2) + np.uint64(1), numbers[1]


def signature(shingles: np.ndarray, multipliers: np.ndarray, offsets: np.ndarray) -> bytes:
    """The least value of each hash function, 32 middle bits of it."""
    least = None
    for start in range(0, len(shingles), _BLOCK):
        values = multipliers * shingles[start : start + _BLOCK]
        values += offsets
        block = values.min(axis=1)
        least = block if least is None else np.minimum(least, block)
    return ((least >> np.uint64(16)) & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()


def _signer(settings: NearSettings):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multipliers, offsets = _functions(settings)
        hashes = _WordHashes()
        for batch in batches:
            counts, sets, signatures = [], [], []
            for text in batch.column(1).to_pylist():
                shingles = shingle_set(text, settings.words, hashes)
                counts.append(len(shingles))
                if len(shingles):
                    sets.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                    signatures.append(signature(shingles, multipliers, offsets))
                else:
                    sets.append(None)
                    signatures.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(sets, pa.binary()),
                    pa.array(signatures, pa.binary()),
                ],
                names=["id", "n_shingles", "set_hash", "signature"],
            )

    return sign


def _alike(settings: NearSettings):
    """Keep pairs whose signatures agree often enough."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype="<u4").reshape(-1, settings.size)
                for c in (2, 3)
            )
            good = (left == right).mean(axis=1) >= settings.least_share
            yield batch.select([0, 1]).filter(pa.array(good))

    return compare


def _verifier(settings: NearSettings):
    """Keep pairs whose full shingle sets are similar enough."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, last_text, last_set = _WordHashes(), None, None
        for batch in batches:
            good = []
            for left, right in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if left is not last_text:
                    if left != last_text:
                        last_set = shingle_set(left, settings.words, hashes)
                    last_text = left
                other = shingle_set(right, settings.words, hashes)
                shared = len(np.intersect1d(last_set, other, assume_unique=True))
                union = len(last_set) + len(other) - shared
                good.append(100 * shared >= settings.percent * union)
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return verify


def _confirmed(pairs: DataFrame, known: DataFrame, settings: NearSettings) -> DataFrame:
    """Of pairs (u, v) those that are links: by signature first, then on the sets of whole texts."""

    def with_both(rows: DataFrame, column: str) -> DataFrame:
        first = known.select(F.col("id").alias("u"), F.col(column).alias("__left"))
        second = known.select(F.col("id").alias("v"), F.col(column).alias("__right"))
        return rows.join(first, "u").join(second, "v").select("u", "v", "__left", "__right")

    likely = with_both(pairs, "signature").mapInArrow(_alike(settings), "u long, v long")
    likely, _ = stored(likely, "near-likely")
    return with_both(likely, "text").mapInArrow(_verifier(settings), "u long, v long")


def _shingler(settings: NearSettings):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            sets = [shingle_set(text, settings.words, hashes).view(np.int64) for text in batch.column(1).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            values = pa.array(np.concatenate(sets) if sets else np.empty(0, np.int64))
            listed = pa.ListArray.from_arrays(pa.array(offsets), values)
            yield pa.RecordBatch.from_arrays([batch.column(0), listed], names=["id", "shingles"])

    return cut


def _unconnected(members: DataFrame, joined: DataFrame) -> tuple[DataFrame, int]:
    """Members of buckets that hold more than one component: (bucket, id, component)."""
    placed = members.select("bucket", "id").join(joined.withColumnRenamed("node", "id"), "id", "left")
    placed, _ = stored(placed.withColumn("component", F.coalesce("component", "id")), "near-placed")
    apart = placed.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter("a < b")
    rows, seen = stored(placed.join(apart.select("bucket"), "bucket"), "near-open")
    return rows, seen["rows"]


def _rare_first(rows: DataFrame, known: DataFrame, settings: NearSettings) -> DataFrame:
    """Of texts not yet connected, the shingles by which they can meet a similar one.

    A text's shingles are put in order of how few of these texts have them. Two similar sets share
    a shingle among the first ones of both: if the first they have in common stood further
    back, too few would be left to share. Columns: id, component, n (set size), shingle, place.
    Shingles that only one text has take up places and are not returned.
    """
    names = rows.select("id", "component").distinct()
    texts = known.join(names, "id").select("id", "text")
    cut, _ = stored(texts.mapInArrow(_shingler(settings), "id long, shingles array<long>"), "near-shingles")
    version = F.xxhash64("shingles").alias("version")
    each = cut.select("id", version, F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    shared, _ = stored(each.groupBy("shingle").agg(F.count("*").alias("times")).filter("times > 1"), "near-shared")
    one = W.partitionBy("id", "version")
    placed = each.join(shared, "shingle").withColumn(
        "place",
        F.col("n") - F.count("*").over(one) + F.row_number().over(one.orderBy("times", "shingle")),
    )
    # The least a pair with a set of n can share is with the smallest partner: percent of n.
    first = placed.filter(F.col("place") <= F.col("n") - F.ceil(F.col("n") * settings.percent / 100) + 1)
    return stored(first.join(names, "id").select("id", "component", "n", "shingle", "place"), "near-rare")[0]


def _can_link(a: str, b: str, percent: int) -> Column:
    """Whether two sets whose first common shingle has these places may still share enough."""
    left = F.least(F.col(f"{a}.n") - F.col(f"{a}.place"), F.col(f"{b}.n") - F.col(f"{b}.place")) + 1
    return left * (100 + percent) >= (F.col(f"{a}.n") + F.col(f"{b}.n")) * percent


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("u"), F.greatest(a, b).alias("v")]


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: NearSettings = NearSettings()
) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Texts with equal shingle sets are one class from the start, so copies meet in a count and
    nowhere else. The classes' representatives are banded. In a bucket every member is compared
    with the one that shares most buckets with most texts, which is the least altered one. What
    is unconnected after that is compared across components. Before that, pairs go that cannot
    be links: shingles that no other unconnected text has bound the intersection from above. So every pair that shares a bucket is tested, ruled out
    by an exact bound or already connected, and no group emits all its pairs. Links are
    confirmed on the sets of whole texts.

    The component is named by its smallest id. Texts that are NULL or without words have no
    shingles and no links. A row with a NULL id has no name: it stays alone, with NULL as
    component, and is kept. Rows that repeat an id count as versions of one document, whose links
    are joined. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    signed, _ = stored(
        rows.mapInArrow(_signer(settings), "id long, n_shingles long, set_hash binary, signature binary"), "near-signed"
    )
    named = signed.filter("id is not null and set_hash is not null")
    classes, _ = stored(named.groupBy("set_hash").agg(F.min("id").alias("head")), "near-classes")
    heads = named.join(
        classes.select(F.col("set_hash").alias("__set"), F.col("head").alias("__head")),
        (F.col("set_hash") == F.col("__set")) & (F.col("id") == F.col("__head")),
        "left_semi",
    ).select("id", "signature")
    heads, _ = stored(heads, "near-heads")

    width = 4 * settings.rows
    keys = F.array(
        *[F.xxhash64(F.lit(b), F.substring("signature", b * width + 1, width)) for b in range(settings.bands)]
    )
    banded = heads.select("id", F.explode(keys).alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("many")).filter("many > 1")
    shared, _ = stored(shared, "near-buckets")
    members, _ = stored(banded.join(shared, "bucket"), "near-members")
    fame, _ = stored(members.groupBy("id").agg(F.sum("many").alias("met")), "near-fame")
    hubs = (
        members.join(fame, "id")
        .groupBy("bucket")
        .agg(F.max(F.struct("met", (-F.col("id")).alias("minus"))).alias("hub"))
        .select("bucket", (-F.col("hub.minus")).alias("hub"))
    )
    hubs, _ = stored(hubs, "near-hubs")

    known, _ = stored(rows.join(heads.join(fame.select("id"), "id", "left_semi"), "id"), "near-known")
    tried = members.join(hubs, "bucket").filter("hub <> id").select(*_ordered("hub", "id")).distinct()
    tried, _ = stored(tried, "near-tried")
    joined, _ = stored(components(_confirmed(tried, known, settings)), "near-components")

    apart, left = _unconnected(members, joined)
    if left:
        rare = _rare_first(apart, known, settings)
        across = rare.alias("x").join(rare.alias("y"), "shingle").filter(
            (F.col("x.component") < F.col("y.component")) & _can_link("x", "y", settings.percent)
        )
        untested = across.select(*_ordered("x.id", "y.id")).distinct().join(tried, ["u", "v"], "left_anti")
        links = _confirmed(untested, known, settings)
        stars = joined.filter("node <> component").select(F.col("node").alias("u"), F.col("component").alias("v"))
        joined, _ = stored(components(stars.union(links)), "near-components")

    settled = classes.join(joined.withColumnRenamed("node", "head"), "head", "left").select(
        "set_hash", F.coalesce("component", "head").alias("component")
    )
    settled, _ = stored(settled, "near-settled")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return signed.select("id", "n_shingles", "set_hash").join(settled, "set_hash", "left").select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The input's rows and columns, with the smallest id left of each near-duplicate group.

    Rows that repeat an id stay if one of them is kept.
    """
    gone = near_groups(docs, id_col=id_col, **options).filter("not kept").select(F.col("doc_id").alias("__gone"))
    kept = without(docs, "__gone")
    return kept.join(gone.distinct(), kept[id_col].cast("long") == F.col("__gone"), "left_anti")
