"""Ranked lexical search: item bundles pass the owners of their terms one after another."""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanseason.llm.common import lower_ascii
from loanseason.session import stored

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _folding() -> bytes:
    """Every byte of a term in lower case, every other one as a space. Bytes beyond ASCII belong to terms."""
    out = bytearray(b" " * 256)
    for code in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
        out[code] = code
    for code in range(0x41, 0x5B):
        out[code] = code + 32
    return bytes(out)


_FOLD = _folding()


@dataclass(frozen=True)
class SearchSettings:
    """``best`` documents for each item.

    Terms are dealt to owners by weight, the heaviest first: ``bands`` are the least weights of all
    owners but the last. ``lot`` items travel together. A slice of documents ends with the input
    partition or beyond ``slice_docs`` documents or ``slice_bytes`` of text. Up to
    ``vocabulary`` item terms are sent to the scan, which then lists only these.
    """

    best: int = 10
    bands: tuple[int, ...] = (5000, 3000, 1800)
    lot: int = 1000
    slice_docs: int = 100_000
    slice_bytes: int = 64_000_000
    vocabulary: int = 1_000_000


_BUNDLE = "slice long, lot int, item long, docs binary, scores binary, rest long"


def _terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _chunks(text: bytes, size: int = 4_000_000) -> Iterator[bytes]:
    """A long text in parts; no term is cut."""
    at = 0
    while at < len(text):
        stop = at + size
        while stop < len(text) and _FOLD[text[stop]] != 0x20:
            stop += 1
        yield text[at:stop]
        at = stop


class _Slice:
    """Documents of a slice by place, and the places and counts of every term."""

    def __init__(self) -> None:
        self.ids: list = []
        self.sizes: list[int] = []
        self.bytes = 0
        self.lists: dict[bytes, tuple[array, array]] = {}

    def add(self, doc_id, text: bytes, wanted) -> None:
        counts: Counter = Counter()
        for chunk in _chunks(text):
            counts.update(_terms(chunk))
        if not counts:
            return
        place = len(self.ids)
        self.ids.append(doc_id)
        self.sizes.append(counts.total())
        self.bytes += len(text)
        for term in counts if wanted is None else wanted.intersection(counts):
            docs, tfs = self.lists.setdefault(term, (array("i"), array("i")))
            docs.append(place)
            tfs.append(counts[term])

    def rows(self, name: int) -> Iterator[pa.RecordBatch]:
        terms = sorted(self.lists)
        packed = lambda k: pa.array([self.lists[t][k].tobytes() for t in terms], pa.binary())
        longs = pa.list_(pa.int64())
        kinds = [pa.int64(), longs, longs, pa.string(), pa.binary(), pa.binary()]
        names = ["slice", "doc_ids", "n", "term", "docs", "tfs"]
        about = [pa.array([name]), pa.array([self.ids], longs), pa.array([self.sizes], longs), *(pa.nulls(1, t) for t in kinds[3:])]
        yield pa.RecordBatch.from_arrays(about, names=names)
        if terms:
            size = len(terms)
            lists = [pa.array(np.full(size, name)), pa.nulls(size, longs), pa.nulls(size, longs), pa.array(terms, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*lists, packed(0), packed(1)], names=names)


def _indexer(wanted, settings: SearchSettings):
    """Slices of the rows (partition, doc_id, text) of a task, as one row for the slice and one for each term."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = wanted.value if wanted is not None else None
        part, number, now = 0, 0, _Slice()
        for batch in batches:
            texts = batch.column(2).cast(pa.large_binary())
            for place, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                part = place
                now.add(doc_id, text.as_py(), terms)
                if len(now.ids) >= settings.slice_docs or now.bytes >= settings.slice_bytes:
                    yield from now.rows((part << 32) + number)
                    number, now = number + 1, _Slice()
        if now.ids:
            yield from now.rows((part << 32) + number)

    return index


def _parts(total_docs: int, total_terms: int):
    """Postings with, instead of counts, what a unit of weight adds to each document's score."""

    def weigh(slices: pa.Table, postings: pa.Table) -> pa.Table:
        if not slices.num_rows or not postings.num_rows:
            return pa.table({"slice": [], "term": [], "docs": [], "parts": [], "most": []}, _schema("slice", "term", "docs", "parts", "most"))
        n = slices["n"].combine_chunks().values.to_numpy()
        m = 10 + (90 * n * total_docs) // total_terms
        parts, most = [], []
        for docs, tfs in zip(postings["docs"].to_pylist(), postings["tfs"].to_pylist()):
            tf = np.frombuffer(tfs, np.int32).astype(np.int64)
            part = (1_000_000_000 * tf) // (1000 * tf + 8 * m[np.frombuffer(docs, np.int32)])
            parts.append(part.astype(np.int32).tobytes())
            most.append(int(part.max()))
        return pa.table(
            {"slice": postings["slice"], "term": postings["term"], "docs": postings["docs"], "parts": pa.array(parts, pa.binary()), "most": pa.array(most)}
        )

    return weigh


_TYPES = {
    "slice": pa.int64(), "term": pa.string(), "docs": pa.binary(), "parts": pa.binary(), "most": pa.int64(), "lot": pa.int32(),
    "item": pa.int64(), "scores": pa.binary(), "rest": pa.int64(), "doc_id": pa.int64(), "score": pa.int64(),
}


def _schema(*names: str) -> pa.Schema:
    return pa.schema([(n, _TYPES[n]) for n in names])


def _owner_stage(best: int):
    """Bundles of a slice and lot take up what one owner's terms add.

    Terms of later owners can add ``rest`` at most. Documents that cannot reach the item's
    current ``best`` highest scores of the slice with it are let go; the score of the last of
    these is a lower bound of what a place among the best takes, so nothing is lost.
    """

    def stage(bundles: pa.Table, owned: pa.Table) -> pa.Table:
        held: dict[int, list] = {}
        for item, docs, scores, rest in zip(*(bundles[c].to_pylist() for c in ("item", "docs", "scores", "rest"))):
            held[item] = [np.frombuffer(docs, np.int32), np.frombuffer(scores, np.int64), rest]
        gains: dict[int, list] = {}
        rests: dict[int, int] = {}
        for docs, parts, users in zip(*(owned[c].to_pylist() for c in ("docs", "parts", "users"))):
            at, part = np.frombuffer(docs, np.int32), np.frombuffer(parts, np.int32).astype(np.int64)
            for user in users:
                gains.setdefault(user["item"], []).append((at, part, user["w"]))
                rests[user["item"]] = user["rest"]
        head = bundles if bundles.num_rows else owned
        out = []
        for item in sorted(held.keys() | gains.keys()):
            docs, scores, rest = held.get(item, (np.zeros(0, np.int32), np.zeros(0, np.int64), 0))
            rest = rests.get(item, rest)
            if item in gains:
                size = 1 + max(int(at.max(initial=-1)) for at in (docs, *(g[0] for g in gains[item])))
                total = np.zeros(size, np.int64)
                total[docs] = scores
                for at, part, weight in gains[item]:
                    total[at] += weight * part
                docs = np.flatnonzero(total)
                scores = total[docs]
            if len(docs) > best:
                bar = np.partition(scores, len(scores) - best)[len(scores) - best]
                stay = scores + rest >= bar
                docs, scores = docs[stay], scores[stay]
            out.append((head["slice"][0].as_py(), head["lot"][0].as_py(), item, docs.astype(np.int32).tobytes(), scores.tobytes(), rest))
        return pa.table([list(c) for c in zip(*out)] or [[]] * 6, schema=_schema("slice", "lot", "item", "docs", "scores", "rest"))

    return stage


def _select(best: int):
    """The best documents of a slice for each item, with their ids."""

    def select(bundles: pa.Table, slices: pa.Table) -> pa.Table:
        out: list[tuple] = []
        ids = slices["doc_ids"].combine_chunks().values if slices.num_rows else None
        for item, docs, scores in zip(*(bundles[c].to_pylist() for c in ("item", "docs", "scores"))):
            at, score = np.frombuffer(docs, np.int32), np.frombuffer(scores, np.int64)
            names = ids.take(pa.array(at))
            order = np.lexsort((names.fill_null(0).to_numpy(), names.is_null().to_numpy(zero_copy_only=False), -score))[:best]
            out += [(item, names[int(k)].as_py(), int(score[k])) for k in order]
        return pa.table([list(c) for c in zip(*out)] or [[]] * 3, schema=_schema("item", "doc_id", "score"))

    return select


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, term): the different terms of each item; rows that share an id are one item."""
    terms = F.regexp_extract_all(lower_ascii(F.col(text_col).cast("string")), F.lit(_TERM), F.lit(0))
    return items.select(F.col(id_col).alias("item_id"), F.explode_outer(terms).alias("term")).filter("term is not null").distinct()


def weight(total_docs: int, df: Column) -> Column:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) in doubles."""
    ratio = F.lit(float(2 * total_docs + 2)) / (2 * df + 1).cast("double")
    return F.floor(F.lit(1000.0) * F.log(ratio)).cast("long")


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    settings: SearchSettings = SearchSettings(),
) -> DataFrame:
    """The best documents of every item: item_id, rank (from 1), doc_id, score.

    NULL texts and texts without a term count nowhere and are never found. Rows of documents are
    ranked each alone, also where ids repeat; ids are whole numbers, NULL ones follow all others
    at equal scores. Items without a term have no row, rows that share an item id, NULL among
    them, are one item with the terms of all. Empty tables give no rows; other columns play no
    part.

    1. The scan cuts the documents into slices and lists for every term its documents, as places
       in the slice, packed in arrays: a term that a third of all documents hold is one row for
       each slice. Documents, terms and the frequency of each item term are counted from these.
    2. Items travel in lots. The bundle of an item holds the documents of a slice that have scored,
       with their scores. It meets the owners of its terms in turn, those of rare terms first, in one
       cogroup of slice and lot each, and leaves behind what can no longer be among the best.
    3. The best of each slice get their ids and meet the others by item.

    Nothing is larger than a slice times a lot, whatever the number of documents.
    """
    spark = docs.sparkSession
    asked, seen = stored(item_terms(items, item_id, item_text), "search-asked")
    vocabulary, terms_seen = stored(asked.select("term").distinct(), "search-vocabulary")
    wanted = None
    if terms_seen["rows"] <= settings.vocabulary:
        wanted = spark.sparkContext.broadcast(frozenset(t.encode() for t in vocabulary.toArrow()["term"].to_pylist()))
    rows = docs.select(
        F.spark_partition_id().cast("long").alias("part"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    ).filter("text is not null")
    index, counted = stored(
        rows.mapInArrow(_indexer(wanted, settings), "slice long, doc_ids array<long>, n array<long>, term string, docs binary, tfs binary"),
        "search-index",
        docs=F.sum(F.when(F.col("n").isNotNull(), F.size("n").cast("long"))),
        terms=F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda total, n: total + n)),
    )
    total_docs, total_terms = counted["docs"] or 0, counted["terms"] or 0
    slices = index.filter("term is null").select(*[F.col(c).alias(c) for c in ("slice", "doc_ids", "n")])
    postings = index.filter("term is not null").select("slice", "term", "docs", "tfs")
    if wanted is None:
        postings = postings.join(vocabulary, "term", "left_semi").select("slice", "term", "docs", "tfs")
    parted, _ = stored(
        slices.groupBy("slice")
        .cogroup(postings.groupBy("slice"))
        .applyInArrow(_parts(total_docs, max(1, total_terms)), "slice long, term string, docs binary, parts binary, most long"),
        "search-parts",
    )
    bundles, lots, named = _through_owners(asked, parted, total_docs, settings)
    dealt = slices.select("slice", "doc_ids", F.explode(F.sequence(F.lit(0), F.lit(lots - 1))).alias("lot"))
    chosen = (
        bundles.groupBy("slice", "lot").cogroup(dealt.groupBy("slice", "lot")).applyInArrow(_select(settings.best), "item long, doc_id long, score long")
    )
    ranked = chosen.selectExpr("*", "row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank").filter(
        F.col("rank") <= settings.best
    )
    return ranked.join(named.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _through_owners(
    asked: DataFrame, parted: DataFrame, total_docs: int, settings: SearchSettings
) -> tuple[DataFrame, int, DataFrame]:
    """(bundles behind the last owner, number of lots, items by number)."""
    known = parted.groupBy("term").agg(F.sum((F.octet_length("docs") / 4).cast("long")).alias("df"), F.max("most").alias("most"))
    owner = F.lit(len(settings.bands))
    for k, least in reversed(list(enumerate(settings.bands))):
        owner = F.when(F.col("w") >= least, F.lit(k)).otherwise(owner)
    weighed = asked.join(known, "term").withColumn("w", weight(total_docs, F.col("df"))).filter("w > 0")
    term = F.struct("term", "w", owner.alias("owner"), (F.col("w") * F.col("most")).alias("most"))
    named, seen = stored(
        weighed.groupBy("item_id").agg(F.collect_list(term).alias("terms")).withColumn("item", F.monotonically_increasing_id()),
        "search-items",
    )
    lots = max(1, -(-seen["rows"] // settings.lot))
    later = F.aggregate(
        F.filter("terms", lambda t: t["owner"] > F.col("t.owner")), F.lit(0).cast("long"), lambda total, t: total + t["most"]
    )
    users, _ = stored(
        named.select("item", F.pmod(F.xxhash64("item"), F.lit(lots)).cast("int").alias("lot"), "terms", F.explode("terms").alias("t"))
        .select("t.term", "t.owner", "lot", F.struct("item", "t.w", later.alias("rest")).alias("user"))
        .groupBy("term", "owner", "lot")
        .agg(F.collect_list("user").alias("users")),
        "search-users",
    )
    bundles = asked.sparkSession.createDataFrame([], _BUNDLE)
    for k in range(len(settings.bands) + 1):
        owned = parted.join(users.filter(F.col("owner") == k), "term").select("slice", "lot", "docs", "parts", "users")
        bundles, _ = stored(
            bundles.groupBy("slice", "lot").cogroup(owned.groupBy("slice", "lot")).applyInArrow(_owner_stage(settings.best), _BUNDLE), "search-bundles"
        )
    return bundles, lots, named
