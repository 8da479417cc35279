"""Exact duplicates by content hash, with the bytes compared inside every group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanseason.llm.common import lower_ascii, without
from loanseason.session import stored

RESULT = ("keep_id", "group_size", "kept", "text_sha256", "content_hash")


def hash128(text: Column) -> Column:
    return F.unhex(F.md5(text))


def mark_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    normalise: Callable[[Column], Column] = lower_ascii,
    content_hash: Callable[[Column], Column] = hash128,
) -> DataFrame:
    """Every input row with the row that stands for its group.

    Rows are equal when their normalised texts have the same bytes. Adds ``keep_id`` (the
    smallest or largest id of the group), ``group_size``, ``kept``, ``text_sha256`` and
    ``content_hash``; input columns of these names are replaced.

    Equal rows combine before the shuffle, so a group that holds a third of all rows travels
    as one row per task. The grouping compares hash and bytes; only (hash, id, size) is kept
    of it. A row then finds its group by hash alone; hashes that cover several byte strings
    are listed, and their rows are matched by their bytes instead.

    NULL texts count as empty, empty texts are equal to each other. A NULL id is never chosen
    while the group has another; in a group of NULL ids all rows are kept. Rows that repeat an
    id and a text are one document: each gets the same answer. An empty table gives no rows.
    """
    pick = {"smallest": F.min, "largest": F.max}[keep]
    rows = (
        without(docs, *RESULT, "__norm")
        .withColumn("__norm", normalise(F.col(text_col)))
        .withColumn("content_hash", content_hash(F.col("__norm")))
        .withColumn("text_sha256", F.sha2("__norm", 256))
    )
    by_bytes = rows.groupBy("content_hash", "__norm").agg(
        pick(id_col).alias("__keep"), F.count("*").alias("__size")
    )
    groups, _ = stored(by_bytes.drop("__norm"), "exact-groups")
    several, seen = stored(
        groups.groupBy("content_hash").count().filter("count > 1").select("content_hash"), "exact-several"
    )
    collisions = seen["rows"] > 0

    single = groups.filter("__size > 1")
    if collisions:
        single = single.join(several, "content_hash", "left_anti")
        alone = rows.join(several, "content_hash", "left_anti")
    else:
        alone = rows
    out = alone.drop("__norm").join(single, "content_hash", "left")
    if collisions:
        shared = rows.join(several, "content_hash", "left_semi")
        classes = shared.groupBy("content_hash", "__norm").agg(
            pick(id_col).alias("__keep"), F.count("*").alias("__size")
        )
        out = out.unionByName(shared.join(classes, ["content_hash", "__norm"]).drop("__norm"))

    own = [c for c in docs.columns if c.lower() not in RESULT]
    size = F.coalesce("__size", F.lit(1)).cast("long")
    keeper = F.when(F.col("__size").isNull(), F.col(id_col)).otherwise(F.col("__keep"))
    return out.select(
        *own,
        keeper.alias("keep_id"),
        size.alias("group_size"),
        F.col(id_col).eqNullSafe(keeper).alias("kept"),
        "text_sha256",
        "content_hash",
    )


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """The input's columns, with one row left of each group of equal texts.

    Of rows that repeat the keeper's id, and of a group whose ids are all NULL, one stays. Only
    keepers of groups with several rows are compared once more; the other rows do not move.
    """
    marked = mark_duplicates(docs, **options)
    alone = marked.filter("group_size = 1")
    several = marked.filter("kept and group_size > 1").dropDuplicates(["text_sha256"])
    return alone.unionByName(several).select(*[c for c in docs.columns if c in marked.columns])
