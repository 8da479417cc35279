"""Benchmark passages in documents: a hash set of item windows, met by every window of every text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanseason.llm.common import lower_ascii, text_or_empty, without
from loanseason.session import stored

#: Letters and digits of ASCII and everything beyond ASCII, in a text whose A-Z are lower-cased.
_IN_WORD = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
_WORD, _GAP = f"[^{_IN_WORD}]", f"[{_IN_WORD}]"
#: The same in a text as it is written.
_RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_RAW_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_TEXT = ["k1", "k2"]
RESULT = ("n_words", "n_hit", "items", "spans", "contaminated")


@dataclass(frozen=True)
class WindowSettings:
    """``words`` of a window; a set of more than ``broadcast_windows`` is shuffled to, not sent out.

    A text of more than ``piece_chars`` characters is scanned in pieces that overlap by a window.
    """

    words: int = 10
    broadcast_windows: int = 400_000
    piece_chars: int = 200_000


def _words(text: Column, gap: str = _GAP) -> Column:
    return F.array_remove(F.split(text, f"{gap}+"), "")


def _text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("again"), text).alias("k2")]


def _code(words: Column, start: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(words, start + k) for k in range(size)])


def item_windows(
    items: DataFrame, id_col: str = "item_id", text_col: str = "text", settings: WindowSettings = WindowSettings()
) -> tuple[DataFrame, DataFrame]:
    """(windows, classes) of the items.

    ``windows`` has a row for each different window: ``size``, ``window`` (its words), ``classes``
    (the word sequences it is part of). ``classes`` lists for every word sequence the ids of the
    items that consist of it, as sorted strings, so that repeated items cost one entry.
    """
    most = settings.words
    bags = (
        items.select(F.col(id_col).cast("string").alias("id"), _words(lower_ascii(F.col(text_col))).alias("words"))
        .filter(F.size("words") > 0)
        .withColumn("class", F.struct(F.xxhash64("words"), F.xxhash64(F.lit("again"), "words")))
    )
    classes = bags.groupBy("class").agg(F.array_sort(F.collect_set("id")).alias("ids"), F.first("words").alias("words"))
    classes, _ = stored(classes, "leak-classes")
    size = F.least(F.size("words"), F.lit(most))
    starts = F.sequence(F.lit(0), F.size("words") - size)
    cut = classes.select("class", size.alias("size"), F.explode(F.transform(starts, lambda i: F.slice("words", i + 1, size))).alias("window"))
    return cut.groupBy("size", "window").agg(F.collect_set("class").alias("classes")), classes.select("class", "ids")


def _in_pieces(texts: DataFrame, settings: WindowSettings) -> DataFrame:
    """Rows (k1, k2, text) as rows (k1, k2, piece): offset in words, body, and the words that follow.

    A cut never splits a word, and each piece of a text that is cut has a word in it, so the
    next pieces as many as a window has words hold all that a window can reach. The steps are
    columns of their own, as a lambda would work out again what it refers to for every piece.
    """
    reach = settings.words - 1
    text = F.col("text")
    short = F.length(text) <= settings.piece_chars
    cuts = F.filter(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{settings.piece_chars}}}(?!{_WORD})|{_WORD}+"), F.lit(0)),
        lambda p: p.rlike(_WORD),
    )
    sized = F.transform(
        "cuts",
        lambda p: F.struct(
            p.alias("body"),
            F.regexp_count(p, F.lit(f"{_WORD}+")).alias("n"),
            F.regexp_extract(p, f"^{_GAP}*((?:{_WORD}+{_GAP}*){{0,{reach}}})", 1).alias("head"),
        ),
    )
    placed = F.transform(
        "sized",
        lambda p, i: F.struct(
            F.aggregate(F.slice("sized", F.lit(1), i), F.lit(0), lambda total, q: total + q["n"]).alias("offset"),
            p["body"].alias("body"),
            F.array_join(F.transform(F.slice("sized", i + 2, F.lit(reach)), lambda q: q["head"]), " ").alias("next"),
        ),
    )
    whole = F.array(F.struct(F.lit(0).alias("offset"), text.alias("body"), F.lit("").alias("next")))
    return (
        texts.withColumn("cuts", F.when(~short, cuts))
        .withColumn("sized", sized)
        .select(*_TEXT, F.explode_outer(F.when(short, whole).otherwise(placed)).alias("piece"))
    )


def find_windows(
    docs: DataFrame, windows: DataFrame, text_col: str = "text", settings: WindowSettings = WindowSettings()
) -> DataFrame:
    """Every occurrence of a window: key of the text (k1, k2), ``start`` in words, ``size``, ``classes``.

    All windows of all texts are hashed and meet the set by hash; the words of a match are
    compared before it counts. Sizes that no window has are not looked for.
    """
    held, seen = stored(windows.withColumn("size", F.col("size").cast("int")), "leak-windows", sizes=F.collect_set("size"))
    sizes = sorted(seen["sizes"] or [])  # at most as many as a window has words
    text = F.col("text")
    # Outer generators: an inner one has Spark test its array below the projections, which repeats their work for each word.
    texts = (
        docs.select(F.col(text_col).cast("string").alias("text"))
        .filter(text.isNotNull())
        .select(*_text_key(text), lower_ascii(text).alias("text"))
    )
    cut = (
        _in_pieces(texts, settings)
        .select(*_TEXT, F.col("piece.offset").alias("offset"), F.col("piece.next").alias("next"), _words(F.col("piece.body")).alias("own"))
        .select(*_TEXT, "offset", "own", F.concat("own", F.slice(_words(F.col("next")), 1, max(1, settings.words - 1))).alias("words"))
        .select(*_TEXT, "offset", "words", F.posexplode_outer("own").alias("at", "first"))
    )
    found = None
    for size in sizes:
        known = held.filter(F.col("size") == size).select(
            "size", "window", "classes", _code(F.col("window"), F.lit(0), size).alias("code")
        )
        if seen["rows"] <= settings.broadcast_windows:
            known = F.broadcast(known)
        coded = cut.withColumn("code", _code(F.col("words"), F.col("at"), size))
        # Two bounds instead of an equation, which would become a join key and be hashed for every window of every text.
        here = F.slice("words", F.col("at") + 1, F.lit(size))
        met = coded.join(known, "code").filter((here <= F.col("window")) & (here >= F.col("window")))
        met = met.select(*_TEXT, (F.col("offset") + F.col("at")).alias("start"), "size", "classes")
        found = met if found is None else found.union(met)
    if found is None:
        return docs.sparkSession.createDataFrame(
            [], "k1 long, k2 long, start int, size int, classes array<struct<col1:long,col2:long>>"
        )
    return found


def _joined_spans(hits: Column) -> Column:
    """Sorted (start, size) as ranges (start, stop) that do not overlap or touch."""
    empty = F.array().cast("array<struct<start:int,stop:int>>")

    def add(done, hit):
        stop = hit["start"] + hit["size"]
        last = F.element_at(done, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["stop"], stop).alias("stop"))
        alone = F.struct(hit["start"].alias("start"), stop.alias("stop"))
        return F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["stop"] >= hit["start"]),
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer)),
        ).otherwise(F.concat(done, F.array(alone)))

    return F.aggregate(hits, empty, add)


def _covered(hits: Column) -> Column:
    """How many words sorted (start, size) cover."""
    zero = F.struct(F.lit(0).alias("reach"), F.lit(0).cast("long").alias("n"))

    def add(done, hit):
        stop = hit["start"] + hit["size"]
        new = F.greatest(stop - F.greatest(hit["start"], done["reach"]), F.lit(0))
        return F.struct(F.greatest(done["reach"], stop).alias("reach"), (done["n"] + new).alias("n"))

    return F.aggregate(hits, zero, add, lambda done: done["n"])


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    settings: WindowSettings = WindowSettings(),
) -> DataFrame:
    """Every input row with what of its text stands in an item.

    Adds ``n_words``, ``n_hit`` (words inside any occurrence of a window), ``items`` (ids of the
    items with an occurring window, as strings in byte order), ``spans`` (hits as start and size in
    words, sorted), ``contaminated``. Columns of these names are replaced, others kept.

    A window is a run of ``settings.words`` words of an item; an item of fewer is one window.
    NULL and texts without a word have none. Items without a word take no part; rows that share
    an item id are one item with the windows of all; an item whose id is NULL hits words, but is
    not listed. Repeated documents are judged each alone and alike; empty tables give no row or
    no hit.

    The windows are broadcast up to a stated number, beyond it both sides shuffle by hash. Hits
    belong to a text, so copies share what is grouped; a hit is a few numbers. Long texts are
    scanned in pieces. What one group holds is the hits of one text, one for a word at most and size.
    """
    windows, classes = item_windows(items, item_id, item_text, settings)
    hits, _ = stored(find_windows(docs, windows, text_col, settings), "leak-hits")
    spans = hits.groupBy(*_TEXT).agg(F.array_sort(F.collect_set(F.struct("start", "size"))).alias("spans"))
    named = (
        hits.select(*_TEXT, "classes")
        .distinct()
        .select(*_TEXT, F.explode("classes").alias("class"))
        .distinct()
        .join(classes, "class")
        .groupBy(*_TEXT)
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("items"))
    )
    leaks, _ = stored(
        spans.join(named, _TEXT, "left").withColumn("n_hit", _covered(F.col("spans"))).select(*_TEXT, "spans", "items", "n_hit"),
        "leak-texts",
    )
    text = F.col(text_col).cast("string")
    rows = without(docs, *RESULT, *_TEXT).select(
        "*", *_text_key(text), F.size(_words(text_or_empty(text), _RAW_GAP)).cast("long").alias("n_words")
    )
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in _TEXT]
    return rows.join(leaks, _TEXT, "left").select(
        *kept,
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,size:int>>")).alias("spans"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, remove: str = "spans", text_col: str = "text", **names) -> DataFrame:
    """The documents without what stands in an item, with the input's columns.

    ``remove="documents"`` drops contaminated rows; ``"spans"`` cuts the hit words with what
    follows them up to the next word, and leaves all other characters as they are.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in {*RESULT, *_TEXT}]
    found = find_leaks(docs, items, text_col, **names)
    if remove == "documents":
        return found.filter("not contaminated").select(*columns)
    if remove != "spans":
        raise ValueError(f"remove is 'spans' or 'documents', not {remove!r}")
    text = F.col(f"`{text_col}`")
    ranges = _joined_spans(F.col("spans"))
    tokens = F.regexp_extract_all(text, F.lit(f"{_RAW_WORD}+{_RAW_GAP}*"), F.lit(0))
    left = F.filter(tokens, lambda t, i: ~F.exists(F.col("__cut"), lambda r: (i >= r["start"]) & (i < r["stop"])))
    cut = F.concat(F.regexp_extract(text, f"^{_RAW_GAP}*", 0), F.array_join(left, ""))
    return (
        found.withColumn("__cut", ranges)
        # Two uses of the ranges: with one, Spark would put their expression into the lambda and work it out for every word.
        .withColumn("__left", F.when(F.size("__cut") > 0, cut).otherwise(text))
        .select(*[F.col("__left").alias(text_col) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c.lower() not in {*RESULT, *_TEXT}])
    )
