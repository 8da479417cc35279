"""Mix sources to target weights by weighted fair queueing."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanseason.llm.common import word_count
from loanseason.session import stored

#: Hex digits of the shuffle key that place a document in a slice.
_DIGITS = 10
#: Copies of a row that are written out together.
_AT_ONCE = 1000


def shuffle_key(id_col: str, seed: str) -> Column:
    """Order of documents in their source: a hash of the id, the same on every run."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("-"))))


def source_targets(sizes: DataFrame, weights: Sequence[int], repeats: int) -> DataFrame:
    """One row per source: rank, size and the tokens that the mix owes it.

    Sources in code point order, NULL last, weigh ``weights`` in turn and share the total. A
    target stops at ``repeats`` times the source's size; what is above goes to the others by
    weight. With sources ordered by cap over weight, one is capped exactly if its share of what
    the earlier ones leave exceeds its cap, so a running sum settles all of them at once.

    The table of sources is small by nature: somebody states a weight for each of them.
    """
    ranked = sizes.select(
        "source", "source_size", (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1).alias("rank")
    ).withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights)) + 1))
    wide = "decimal(38,0)"
    cap = (F.col("source_size") * repeats).cast("long")
    order = W.orderBy(F.col("cap") / F.col("weight"), "rank")
    before, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    whole = W.partitionBy()
    capped = F.col("weight").cast(wide) * (F.col("total") - F.col("cap_before")).cast(wide) > F.col("cap").cast(
        wide
    ) * F.col("weight_left").cast(wide)
    free = F.col("weight") * (F.col("total") - F.col("cap_all"))
    return (
        ranked.withColumn("cap", cap)
        .withColumn("total", F.sum("source_size").over(whole))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(after))
        .withColumn("capped", capped)
        .withColumn("cap_all", F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(whole), F.lit(0)))
        .withColumn("weight_all", F.sum(F.when(~F.col("capped"), F.col("weight"))).over(whole))
        .select(
            "source",
            "rank",
            "source_size",
            "total",
            F.when(F.col("capped"), F.col("cap").cast("double"))
            .otherwise(free.cast("double") / F.col("weight_all").cast("double"))
            .alias("target"),
        )
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    repeats: int = 3,
    seed: str = "mix",
    carry: Sequence[str] = (),
) -> DataFrame:
    """One narrow row per document: ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    Columns named in ``carry``, narrow ones, come along as they are.

    Every source serves its documents in a hashed order, up to ``repeats`` times over. A copy's
    virtual finish time is the number of tokens its source has served with it, divided by the
    source's target. All copies in order of that time are taken until the total is reached; the
    first that would exceed it ends the mix. No source can get far from its target, because at
    any time all have served the same part of it.

    Nothing is sorted as a whole. Sources are cut into slices of the hashed order, finish times
    into ranges; sums of slices and ranges combine before the shuffle, running sums over them
    are of square-root size, and only one range is opened to find the end of the mix. A source
    with a third of all rows is spread over all slices.

    NULL texts have no words; their documents take part and give nothing. A NULL source is a
    source of its own, after all others. Documents with a NULL id or a repeated one take part
    row by row. Equal rows may change places, which leaves the set of results as it is.
    """
    base = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        *[F.col(c) for c in carry],
    ).withColumn("key", shuffle_key("doc_id", seed))
    sized, seen = stored(base, "mix-sizes")
    slices = max(1, math.isqrt(seen["rows"]))
    place = F.conv(F.substring("key", 1, _DIGITS), 16, 10).cast("long")
    sized = sized.withColumn("slice", F.floor(place * F.lit(slices) / F.lit(16**_DIGITS)).cast("long"))

    sums, _ = stored(sized.groupBy("source", "slice").agg(F.sum("size").alias("slice_size")), "mix-slices")
    sources, _ = stored(
        source_targets(sums.groupBy("source").agg(F.sum("slice_size").alias("source_size")), weights, repeats),
        "mix-sources",
    )
    earlier = W.partitionBy("rank").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.join(sources, sums["source"].eqNullSafe(sources["source"])).select(
        sums["source"].alias("at_source"), F.col("slice").alias("at_slice"), "rank", "source_size", "target", "total",
        F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)).alias("start"),
    )
    starts, _ = stored(starts, "mix-starts")
    within = W.partitionBy("rank", "slice").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    same = F.col("source").eqNullSafe(F.col("at_source")) & (F.col("slice") == F.col("at_slice"))
    served, _ = stored(
        sized.join(starts, same).select(
            "doc_id", "source", "rank", "size", "key", "source_size", "target", "total",
            (F.col("start") + F.sum("size").over(within)).alias("reach"), *carry,
        ),
        "mix-served",
    )

    copies = served.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))).withColumn(
        "finish", _finish(F.col("epoch"))
    )
    end = _end_of_mix(copies.filter("finish is not null"), slices)
    if end is None:
        number = F.lit(repeats)
    else:
        number = sum(
            (F.when(_before(F.lit(e), end), 1).otherwise(0) for e in range(repeats)), F.lit(0)
        )
    number = F.when(F.col("target") > 0, number).otherwise(0)
    return served.select(
        "doc_id", "source", "size", "source_size", "target",
        number.cast("int").alias("copies"),
        (number * F.col("size")).cast("long").alias("taken"),
        *carry,
    )


def _finish(epoch: Column) -> Column:
    """Virtual finish time; NULL where the source is owed nothing."""
    return F.when(
        F.col("target") > 0, (epoch * F.col("source_size") + F.col("reach")).cast("double") / F.col("target")
    )


def _position(epoch: Column) -> list[Column]:
    return [_finish(epoch), F.col("rank"), epoch, F.col("key"), F.coalesce("doc_id", F.lit(-1)), F.col("size")]


def _before(epoch: Column, end: list) -> Column:
    """Whether a copy comes before the first one that is not taken."""
    result = F.lit(False)
    for mine, theirs in reversed(list(zip(_position(epoch), end))):
        result = (mine < F.lit(theirs)) | ((mine == F.lit(theirs)) & result)
    return result


def _end_of_mix(copies: DataFrame, ranges: int) -> list | None:
    """Position of the first copy, by finish time, with which the total is exceeded."""
    ranged = copies.withColumn("range", F.floor(F.col("finish") * ranges).cast("long"))
    running = W.orderBy("range").rowsBetween(W.unboundedPreceding, 0)
    found = (
        ranged.groupBy("range")
        .agg(F.sum("size").alias("range_size"), F.max("total").alias("total"))
        .withColumn("upto", F.sum("range_size").over(running))
        .filter("upto > total")
        .orderBy("range")
        .first()
    )
    if found is None:
        return None
    start = found["upto"] - found["range_size"]
    order = ["finish", "rank", "epoch", "key", "__id", "size"]
    row = (
        ranged.filter(F.col("range") == found["range"])
        .withColumn("__id", F.coalesce("doc_id", F.lit(-1)))
        .withColumn("upto", F.lit(start) + F.sum("size").over(W.orderBy(*order).rowsBetween(W.unboundedPreceding, 0)))
        .filter(F.col("upto") > F.col("total"))
        .orderBy(*order)
        .first()
    )
    return [row[c] for c in order]


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The input's columns, each row as often as the mix takes it.

    Rows find their number of copies by a 128-bit hash of all their columns but maps, never by their
    id, so rows that share an id and rows without one get their own. Rows that are equal in all
    columns are one another's stand-ins: each is taken as often as the least of them, and one stands
    for what the others are granted beyond. Input columns may bear any name.
    """
    names = docs.columns
    hashed = [F.col(f"`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, T.MapType)]
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    marks = {"__row1": F.xxhash64(*hashed), "__row2": F.xxhash64(F.lit("again"), *hashed)}
    keyed = docs.select(*[v.alias(c) for c, v in marks.items()], row.alias("__row"))
    text, source, id_col = (options.pop(k, d) for k, d in (("text_col", "text"), ("source_col", "source"), ("id_col", "doc_id")))
    narrow = keyed.select(
        F.col(f"__row.`{id_col}`").alias("doc_id"), F.col(f"__row.`{text}`").alias("text"), F.col(f"__row.`{source}`").alias("source"), *marks
    )
    counts, seen = stored(
        mix(narrow, carry=list(marks), **options)
        .groupBy(*marks)
        .agg(F.min("copies").alias("__each"), (F.sum("copies") - F.min("copies") * F.count("*")).alias("__beyond"))
        .filter("__each > 0 OR __beyond > 0"),
        "mix-copies",
        beyond=F.coalesce(F.sum("__beyond"), F.lit(0)),
    )
    every = keyed.join(counts.filter("__each > 0"), [*marks]).select("__row", F.explode(F.sequence(F.lit(1), "__each")))
    if not seen["beyond"]:
        return every.select("__row.*")
    some = keyed.join(counts.filter("__beyond > 0"), [*marks]).groupBy(*marks).agg(
        F.first("__row").alias("__row"), F.first("__beyond").alias("__beyond")
    )
    parts = some.select("__row", "__beyond", F.explode(F.sequence(F.lit(0), F.floor((F.col("__beyond") - 1) / _AT_ONCE))).alias("__part"))
    rest = F.least(F.lit(_AT_ONCE), F.col("__beyond") - F.col("__part") * _AT_ONCE)
    beyond = parts.select("__row", F.explode(F.sequence(F.lit(1).cast("long"), rest)))
    return every.select("__row.*").union(beyond.select("__row.*"))
