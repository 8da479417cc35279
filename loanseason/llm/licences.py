"""Licences of files: TF-IDF cosine with templates, then inheritance from the nearest directory."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loanseason.llm.common import text_or_empty, without
from loanseason.session import stored

# Wording by which public licences are named or begin.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)
LICENCE_FILE = r"(?i)(^|/)(licen[sc]e|copying|unlicense|notice)([._-][^/]*)?$"
_GAP = "[^a-z0-9]+"
RESULT = ("own_license", "own_score", "license", "license_path")
#: What is compared: so many lines of a text from this one on; line -1 stands for the whole text.
UNIT = ["text_key", "unit", "width"]


def terms_of(text: Column) -> Column:
    """Runs of a-z and 0-9 after lower-casing; empty strings at the ends are left to the caller."""
    return F.split(F.lower(text), _GAP)


def _template_terms(text: str) -> list[str]:
    plain = "".join(c if c.isalnum() else " " for c in text.lower())
    return plain.split()


def rarity(files: DataFrame, text_col: str, vocabulary: list[str]) -> tuple[dict[str, float], float]:
    """Inverse document frequency, over all files, of the templates' terms and of a term that is nowhere.

    Other terms leave before the shuffle, so what is counted and returned has the size of the
    templates' vocabulary.
    """
    total = files.count()
    found = (
        files.select(F.explode(F.array_distinct(terms_of(F.col(text_col)))).alias("term"))
        .filter(F.col("term").isin(vocabulary))
        .groupBy("term")
        .count()
    )
    counts = {r["term"]: r["count"] for r in found.collect()}
    weigh = lambda n: math.log((total + 1) / (n + 1)) + 1
    return {t: weigh(counts.get(t, 0)) for t in vocabulary}, weigh(0)


def deciding_terms(weights: list[dict[str, float]], threshold: float) -> list[str]:
    """Terms of which any text near a template must have one.

    Without the heaviest terms of a template the cosine is at most the length of what is left of
    its unit vector. Terms are taken until that is below the threshold.
    """
    chosen: set[str] = set()
    for vector in weights:
        left = 1.0
        for term, weight in sorted(vector.items(), key=lambda t: (-t[1], t[0])):
            if left < (threshold * 0.999) ** 2:
                break
            chosen.add(term)
            left -= weight**2
    return sorted(chosen)


def _runs(lines: Column, longest: int) -> Column:
    """Every line and every run of neighbouring lines, as structs of first line, number of lines and text."""

    def from_line(unit: Column) -> Column:
        widths = F.sequence(F.lit(1), F.least(F.lit(longest), F.size(lines) - unit))
        return F.transform(
            widths,
            lambda w: F.struct(
                unit.alias("unit"), w.alias("width"), F.array_join(F.slice(lines, unit + 1, w), "\n").alias("body")
            ),
        )

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(lines) - 1), from_line))


def own_licences(
    files: DataFrame, text_col: str = "text", threshold: float = 0.6, templates: tuple = TEMPLATES, longest: int = 8
) -> DataFrame:
    """The best template for each text that comes near one: ``text_key``, ``own_license``, ``own_score``.

    Every line of a text is compared, every run of up to ``longest`` neighbouring lines, so that a
    notice may be wrapped, and the text as a whole, by the cosine of term counts times rarity. Equal
    texts are compared once. A text without a deciding term cannot reach the threshold and is not
    split. The others are few, but split they take up to 36 times their size in one row, so texts
    of some ten million characters want large executors. Scores are compared to nine places; ties go to the licence first
    by name, then to the earliest line.
    """
    counted = [Counter(_template_terms(text)) for _, text in templates]
    idf, nowhere = rarity(files, text_col, sorted({t for c in counted for t in c}))
    weights = []
    for counts in counted:
        raw = {t: n * idf[t] for t, n in counts.items()}
        length = math.sqrt(sum(v * v for v in raw.values()))
        weights.append({t: v / length for t, v in raw.items()})
    needed = "(?i)(?<![a-z0-9])(" + "|".join(deciding_terms(weights, threshold)) + ")(?![a-z0-9])"
    spark = files.sparkSession
    postings = spark.createDataFrame(
        [(t, k, templates[k][0], w, idf[t]) for k, vector in enumerate(weights) for t, w in vector.items()],
        "term string, template int, license string, weight double, idf double",
    )
    near = (
        files.filter(F.col(text_col).rlike(needed))
        .select(F.md5(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text"))
        .groupBy("text_key")
        .agg(F.first("text").alias("text"))
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "text_key")
    )
    units = (
        near.select("text_key", F.split("text", "\n").alias("lines"))
        .select("text_key", F.explode(_runs(F.col("lines"), longest)).alias("run"))
        .select("text_key", "run.unit", "run.width", "run.body")
        .unionByName(near.select("text_key", F.lit(-1).alias("unit"), F.lit(0).alias("width"), F.col("text").alias("body")))
    )
    terms = (
        units.filter(F.col("body").rlike(needed))
        .select(*UNIT, F.explode(terms_of(F.col("body"))).alias("term"))
        .filter("term <> ''")
        .groupBy(*UNIT, "term")
        .agg(F.count("*").alias("times"))
    )
    known = postings.select("term", "idf").distinct()
    heavy = terms.join(known, "term", "left").withColumn("value", F.col("times") * F.coalesce("idf", F.lit(nowhere)))
    heavy, _ = stored(heavy.select(*UNIT, "term", "value"), "licence-terms")
    lengths = heavy.groupBy(*UNIT).agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("length"))
    products = (
        heavy.join(postings, "term")
        .groupBy(*UNIT, "template", "license")
        .agg(F.sum(F.col("value") * F.col("weight")).alias("product"))
    )
    order = W.partitionBy("text_key").orderBy(F.desc("own_score"), "license", "unit", "width")
    best = (
        products.join(lengths, UNIT)
        .withColumn("own_score", F.round(F.col("product") / F.col("length"), 9))
        .filter(F.col("own_score") >= threshold)
        .withColumn("place", F.row_number().over(order))
        .filter("place = 1")
    )
    return stored(best.select("text_key", F.col("license").alias("own_license"), "own_score"), "licence-own")[0]


def parent(path: Column) -> Column:
    """The directory of a path; empty at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan(
    files: DataFrame,
    path_col: str = "path",
    text_col: str = "text",
    declares: Column | None = None,
    threshold: float = 0.6,
    templates: tuple = TEMPLATES,
    longest: int = 8,
) -> DataFrame:
    """Every input row, without its text, with its licence and where that comes from.

    ``own_license`` and ``own_score`` come from the text. A file without one inherits from the
    nearest directory above that has a licence file; of several in a directory the first by path
    counts. ``license`` is the result, ``license_path`` the file that states it. What is a licence
    file is told by its name, or by ``declares``; only files with an own licence count, so with
    ``F.lit(True)`` every file that states a licence anywhere declares it for its directory.

    Directories are resolved once each, not once per file: their ancestors are joined with the
    licence files' directories, and files then find the answer of their directory. A directory
    with a third of all files is one row there.

    NULL texts count as empty and have no licence of their own. A NULL path has no directory and
    inherits nothing. Repeated rows and paths are judged row by row. Result columns replace input
    columns of the same name.
    """
    own = own_licences(files, text_col, threshold, templates, longest).withColumnRenamed("text_key", "__key")
    is_file = F.col(path_col).rlike(LICENCE_FILE) if declares is None else declares
    rows = (
        without(files, *RESULT)
        .withColumn("__key", F.md5(text_or_empty(F.col(text_col))))
        .withColumn("__declares", F.coalesce(is_file, F.lit(False)))
        .withColumn("__dir", parent(F.col(path_col)))
        .drop(text_col)
    )
    judged, _ = stored(rows.join(own, "__key", "left").drop("__key"), "licence-files")
    stated = (
        judged.filter("__declares and own_license is not null and __dir is not null")
        .groupBy("__dir")
        .agg(F.min(F.struct(F.col(path_col).alias("license_path"), F.col("own_license").alias("license"))).alias("file"))
    )
    stated, _ = stored(stated.select(F.col("__dir").alias("above"), "file"), "licence-stated")
    parts = F.split("__dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    nearest = (
        judged.select("__dir")
        .filter("__dir is not null")
        .distinct()
        .select("__dir", F.explode(F.array_distinct(above)).alias("above"))
        .join(stated, "above")
        .groupBy("__dir")
        .agg(F.max(F.struct(F.length("above").alias("depth"), "file")).alias("found"))
        .select("__dir", F.col("found.file").alias("__file"))
    )
    nearest, _ = stored(nearest, "licence-nearest")
    has_own = F.col("own_license").isNotNull()
    return (
        judged.join(nearest, "__dir", "left")
        .withColumn("license", F.when(has_own, F.col("own_license")).otherwise(F.col("__file.license")))
        .withColumn("license_path", F.when(has_own, F.col(path_col)).otherwise(F.col("__file.license_path")))
        .drop("__dir", "__declares", "__file")
    )
