"""What several operators of this folder share: words, case folding, tables, batches."""

from __future__ import annotations

import binascii
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word is a run of anything but space and the five ASCII control spaces.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else; NULL counts as empty.

    In a text of ASCII alone ``lower`` does the same and is much cheaper.
    """
    whole = text_or_empty(text)
    return F.when(F.octet_length(whole) == F.length(whole), F.lower(whole)).otherwise(F.translate(whole, UPPER, LOWER))


def word_count(text: Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def words_of(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8. ``bytes.split`` cuts at exactly the six separators of WORD."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def folded_words_of(text: str | None) -> list[bytes]:
    """The same after lower-casing A-Z, which is all that ``bytes.lower`` touches."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop input columns that bear the name of a result column (in any case)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def fold_of(doc_id: Column, folds: int) -> Column:
    """Remainder of the crc32 of an id's digits; NULL ids fall in no fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(folds)


def fold_number(doc_id: int, folds: int) -> int:
    return binascii.crc32(str(doc_id).encode()) % folds


def in_slices(frames: Iterable[pd.DataFrame], text: str, most: int = 4_000_000) -> Iterator[pd.DataFrame]:
    """Cut batches into pieces of about ``most`` characters, one row at least, to bound working memory."""
    for frame in frames:
        if frame.empty:
            continue
        piece = (frame[text].str.len().fillna(0).cumsum() // most).to_numpy()
        if piece[-1] == 0:
            yield frame
            continue
        for _, part in frame.groupby(piece, sort=True):
            yield part


def cut_batch(batch: pa.RecordBatch, sizes: pa.Array, most: int) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch whose sizes add up to about ``most``, one row at least, to bound working memory."""
    if batch.num_rows:
        marks = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False)) // most
        edges = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(edges, edges[1:]):
            yield batch.slice(start, stop - start)


def cut_by_text(batch: pa.RecordBatch, column: int, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    return cut_batch(batch, pc.binary_length(batch.column(column)), most)
