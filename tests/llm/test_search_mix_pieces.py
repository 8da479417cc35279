import functools
import random
import struct
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanseason.llm import cover_tree, licences, mixing, pieces, queries
from loanseason.llm.common import word_count

from .helpers import documents, odd_rows


def _best(vectors, k):
    """All pairs by brute force; vectors are (id, list or None)."""
    import math

    good = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for qid, q in good:
        if qid % 50 == 0:
            found = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in good if i != qid and len(v) == len(q))
            out += [(qid, rank, i, -s) for rank, (s, i) in enumerate(found[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("settings", [{}, {"cells": 3, "block": 20, "query_block": 4}])
def test_top_k_equals_brute_force(spark, settings):
    draw = random.Random(4)
    vectors = [(i, [round(draw.gauss(0, 0.3), 3) for _ in range(4)]) for i in range(400)]
    vectors += [(1000 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(60)]
    vectors += [(2000, None), (2050, [0.1, None, 0.2, 0.3]), (2100, [float("nan")] * 4), (2150, [float("inf")] * 4)]
    vectors += [(None, [1.0] * 4), (3000, [0.25, 0.5]), (3001, [0.5, 0.5]), (3050, []), (150, [0.1] * 4)]
    table = spark.createDataFrame([(i, v, "clash") for i, v in vectors], "vec_id long, embedding array<float>, score string")
    exact = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    out = cover_tree.top_k(table, F.col("vec_id") % 50 == 0, **settings)
    got = sorted(tuple(r) for r in out.collect())
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    want = [r for r in _best(exact, 5) if r[0] != 150]
    assert [r for r in got if r[0] != 150] == want


def test_top_k_of_nothing(spark):
    table = spark.createDataFrame([(50, [1.0])], "vec_id long, embedding array<double>")
    assert cover_tree.top_k(table, F.col("vec_id") % 50 == 0).count() == 0
    assert cover_tree.top_k(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_cover_tree_covers():
    points = np.random.default_rng(1).normal(size=(700, 5))
    points[300:400] = points[0]

    def check(node):
        assert (np.sqrt(((points[node.rows] - node.centre) ** 2).sum(axis=1)) <= node.radius + 1e-9).all()
        if node.children:
            assert sorted(np.concatenate([c.rows for c in node.children])) == sorted(node.rows)
        assert (np.sqrt((points[node.rows] ** 2).sum(axis=1)) <= node.long + 1e-9).all()
        for child in node.children:
            check(child)

    check(cover_tree.cover_tree(points))


def _dual(queries, data, k=5):
    scored = []
    found = cover_tree.dual_search(
        queries, np.arange(len(queries)) + 10**6, np.full(len(queries), -(2.0**62)), data, np.arange(len(data)), k, scored
    )
    best = {}
    for query, number, score in found:
        best.setdefault(query - 10**6, []).append((-score, number))
    exact = queries @ data.T
    for row in range(len(queries)):
        assert sorted(best[row]) == sorted((-int(s), i) for i, s in enumerate(exact[row]))[:k]
    return sum(scored) / exact.size


def test_bounds_hold_for_every_pair():
    draw = np.random.default_rng(5)
    for spread in (0.1, 1.0, 4.0):
        points = np.floor(256 * (draw.normal(size=(90, 1, 6)) + spread * draw.normal(size=(90, 8, 6)))).astype(np.int64)
        nodes = [cover_tree.cover_tree(some.astype(float)) for some in points]
        for q, some in zip(nodes[:30], points):
            for p, others in zip(nodes[30:], points[30:]):
                assert (some @ others.T).max() <= cover_tree.bound(q, p)


def test_clustered_vectors_are_mostly_ruled_out():
    draw = np.random.default_rng(6)
    around = draw.normal(size=(40, 64))
    data = np.floor(256 * (around[draw.integers(0, 40, 3000)] + 0.05 * draw.normal(size=(3000, 64)))).astype(np.int64)
    assert _dual(data[::50] + 1, data) < 0.25
    lengths = np.exp(draw.normal(size=(2000, 1)))
    assert _dual(data[:40], np.floor(64 * lengths * draw.normal(size=(2000, 64))).astype(np.int64)) < 0.5
    assert _dual(np.zeros((3, 4), np.int64), np.zeros((50, 4), np.int64)) <= 1


def test_vectors_that_rule_nothing_out_are_searched_in_bulk():
    """Many pairs of nodes at a time: a step for each query and leaf took over ten times as long."""
    draw = np.random.default_rng(8)
    data = draw.normal(size=(4096, 64))
    data = np.floor(256 * data / np.sqrt((data**2).sum(axis=1, keepdims=True))).astype(np.int64)
    queries = data[::4] + 1
    exact = queries @ data.T
    start = time.thread_time()
    found = list(
        cover_tree.dual_search(queries, np.arange(1024) + 10**6, np.full(1024, -(2.0**62)), data, np.arange(4096), 5)
    )
    assert time.thread_time() - start < 2
    want = np.argsort(-exact, axis=1, kind="stable")[:, :5]
    assert sorted(found) == sorted((q + 10**6, int(v), int(exact[q, v])) for q in range(1024) for v in want[q])


def test_products_stay_exact_beyond_floating_point():
    draw = np.random.default_rng(9)
    data = draw.integers(-(2**29), 2**29, size=(300, 3))
    data[100:] = data[0] + draw.integers(0, 3, size=(200, 3))
    assert _dual(data[::30], data) <= 1


def test_equal_vectors_are_cut_before_they_meet(spark):
    table = spark.range(3000).selectExpr("id as vec_id", "array(1.0, if(id < 0, id, 2.0)) as embedding")
    good = cover_tree.smallest_of_equal(table.selectExpr("vec_id as id", "embedding as vector"), 6)
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert sorted(r["id"] for r in good.collect()) == list(range(6))


def test_mix_meets_targets(spark):
    draw = random.Random(3)
    rows = [(i, "w " * draw.randrange(1, 40), "en", "big" if i % 3 else f"s{i % 9}") for i in range(3000)]
    rows += [(9000 + i, "w " * 5, "en", None) for i in range(30)]
    docs = documents(spark, rows)
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows)
    by_source = {}
    for r in out:
        entry = by_source.setdefault(r["source"], [0, r["target"], r["source_size"]])
        entry[0] += r["taken"]
        assert r["taken"] % max(1, r["size"]) == 0 and r["taken"] <= 3 * r["size"]
    total = sum(e[2] for e in by_source.values())
    assert sum(e[0] for e in by_source.values()) <= total
    assert abs(sum(e[1] for e in by_source.values()) - total) < 1e-6
    assert all(abs(taken - target) <= 80 for taken, target, _ in by_source.values())
    again = mixing.mix(docs.repartition(7)).collect()
    key = lambda r: (r["doc_id"], r["taken"])
    assert sorted(map(key, again)) == sorted(map(key, out))
    whole = mixing.mixed(docs)
    assert whole.columns == docs.columns and whole.count() == sum(r["copies"] for r in out)


def test_mix_of_odd_rows(spark):
    docs = documents(spark, odd_rows()).withColumn("size", F.lit("clash"))
    out = mixing.mix(docs)
    assert out.count() == len(odd_rows())
    assert mixing.mixed(docs).columns == docs.columns
    assert mixing.mix(docs.limit(0)).count() == 0
    assert {r["taken"] for r in mixing.mix(docs.filter("doc_id in (2, 3, 4)")).collect()} == {0}


@pytest.mark.parametrize("at_once", [1000, 2])
def test_every_row_gets_its_own_copies(spark, monkeypatch, at_once):
    """Rows that share an id, have none, or are equal: rows and words of the corpus are those of the mix."""
    monkeypatch.setattr(mixing, "_AT_ONCE", at_once)
    draw = random.Random(5)
    rows = [(None if i % 3 else i % 7, "w " * draw.randrange(1, 9), "en", "ab"[i % 2]) for i in range(80)] + [(77, "same text", "en", "c")] * 40
    rows += [(500 + i, "x " * 9, "en", "b") for i in range(400)]
    docs = documents(spark, rows).withColumnsRenamed({"n_chars": "__id"}).withColumn("copies", F.lit("mine"))
    granted = mixing.mix(docs).groupBy("source").agg(F.sum("copies").alias("n"), F.sum("taken").alias("words")).collect()
    got = mixing.mixed(docs)
    assert got.columns == docs.columns
    found = got.groupBy("source").agg(F.count("*").alias("n"), F.sum(word_count(F.col("text"))).alias("words")).collect()
    assert {tuple(r) for r in found} == {tuple(r) for r in granted if r["n"]}
    assert mixing.mixed(docs.limit(0)).count() == 0


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load_vocabulary()


def _texts(count):
    draw = random.Random(9)
    for _ in range(count):
        signs = draw.choice(["ab ", "the wor ld", "éñ漢 x", "aaaa", "  a", "tion", "▁ x"])
        yield " " + "".join(draw.choice(signs) for _ in range(draw.randint(1, 250)))


def test_scan_over_chunks_equals_whole(vocabulary):
    encoder = pieces.Encoder(vocabulary)
    for k, text in enumerate(_texts(120)):
        bounds = pieces.chunk_bounds(len(text), (20, 33, 64)[k % 3], vocabulary.longest)
        ends = list(zip(bounds, bounds[1:]))
        matrices = [
            pieces.transfer_matrix(text[a : b + vocabulary.longest], b - a, b == len(text), vocabulary, middle=True) for a, b in ends
        ]
        states = pieces.boundary_states(matrices, 0, 0)
        ids = []
        for n, (a, b) in enumerate(ends):
            ids += np.frombuffer(encoder.encode(text[a + states[n] : b + states[n + 1]]), "<i4").tolist()
        score, want = pieces.best_path(text, 0, len(text), vocabulary)
        assert functools.reduce(pieces.max_plus, matrices).score[0, 0] == score
        assert ids == want
        assert b"".join(vocabulary.written[i] for i in ids).decode() == text


def _unigram_model(vocabulary):
    """The same pieces and scores as a model file of the public library, of its unigram kind."""
    raw = open(pieces.MODEL_PATH, "rb").read()
    key = lambda n, wire: bytes([n << 3 | wire])

    def size(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    import sentencepiece

    old = sentencepiece.SentencePieceProcessor(model_proto=raw)
    body = b""
    for i in range(old.get_piece_size()):
        name = old.id_to_piece(i)
        kind = 2 if old.is_unknown(i) else 3 if old.is_control(i) else 6 if old.is_byte(i) else 1
        score = vocabulary.scores.get(name.replace("▁", " "), 0.0) / pieces._UNIT if kind == 1 else 0.0
        text = name.encode()
        message = key(1, 2) + size(len(text)) + text + key(2, 5) + struct.pack("<f", score) + key(3, 0) + size(kind)
        body += key(1, 2) + size(len(message)) + message
    trainer = key(3, 0) + size(1) + b"\x98\x02\x01"
    normalizer = key(1, 2) + size(8) + b"identity" + key(3, 0) + size(1) + key(4, 0) + size(0)
    return sentencepiece.SentencePieceProcessor(
        model_proto=body + key(2, 2) + size(len(trainer)) + trainer + key(3, 2) + size(len(normalizer)) + normalizer
    )


def test_same_ids_as_the_public_library(vocabulary):
    try:
        library = _unigram_model(vocabulary)
    except RuntimeError:
        pytest.skip("the library does not take the model as rewritten here")
    encoder = pieces.Encoder(vocabulary)
    import duckdb

    texts = [r[0] for r in duckdb.sql("select text from '/root/testdata/sf0.001/documents.parquet'").fetchall()]
    words = sorted({word for text in texts for word in text.split()})
    names = {number: piece for piece, number in vocabulary.ids.items()}
    value = lambda ids: sum(vocabulary.scores.get(names.get(i), 0.0) for i in ids) / pieces._UNIT
    mine = [np.frombuffer(encoder.encode(" " + word), "<i4").tolist() for word in words]
    theirs = library.encode(words)
    assert len(words) > 3000
    assert np.mean([a == b for a, b in zip(mine, theirs)]) > 0.995
    # What differs are ties, such as where to cut three equal signs.
    assert all(abs(value(a) - value(b)) < 1e-3 for a, b in zip(mine, theirs))


def test_round_trip_through_spark(spark):
    docs = documents(spark, odd_rows()).withColumn("ids", F.lit("clash"))
    for chunk, fan in ((16_384, 64), (64, 2)):
        encoded = pieces.encode(docs, chunk_chars=chunk, fan=fan)
        out = pieces.decode(encoded).collect()
        assert len(out) == len(odd_rows())
        assert all(r["decoded"] == r["text"] for r in out)
        assert all((r["ids"] is None) == (r["text"] is None) for r in out)
    assert pieces.decode(pieces.encode(docs.limit(0))).count() == 0


def test_chunked_ids_equal_plain_ids(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    whole = {r["doc_id"]: r["ids"] for r in pieces.encode(docs, chunk_chars=10**7).collect()}
    for size, fan in ((500, 4), (61, 2)):
        assert whole == {r["doc_id"]: r["ids"] for r in pieces.encode(docs, chunk_chars=size, fan=fan).collect()}


def test_ties_do_not_depend_on_chunks(vocabulary):
    draw = random.Random(11)
    runs = ["=" * 700, "-=" * 300, "abab" * 200, " " * 500, "é§" * 150, "aaa==  ==aaa" * 40]
    runs += ["".join(draw.choices("=-a ", weights=[5, 3, 2, draw.choice([0, 1])], k=600)) for _ in range(12)]
    for text in runs:
        whole = pieces.best_path(text, 0, len(text), vocabulary)[1]
        assert pieces.Segmenter(vocabulary).path(text)[1] == whole
        for size in (vocabulary.longest, 97):
            bounds = pieces.chunk_bounds(len(text), size, vocabulary.longest)
            ends = list(zip(bounds, bounds[1:]))
            matrices = [
                pieces.transfer_matrix(text[a : b + vocabulary.longest], b - a, b == len(text), vocabulary) for a, b in ends
            ]
            matrices = [pieces._unpack(pieces._pack(m)) for m in matrices]
            # Once chunk by chunk, once with products of three chunks solved first.
            above = [functools.reduce(pieces.max_plus, matrices[k : k + 3]) for k in range(0, len(matrices), 3)]
            outer = pieces.boundary_states(above, 0, 0)
            nested = [0]
            for k, (entry, leave) in enumerate(zip(outer, outer[1:])):
                nested += pieces.boundary_states(matrices[3 * k : 3 * k + 3], entry, leave)[1:]
            assert nested == pieces.boundary_states(matrices, 0, 0)
            ids = []
            for (a, b), entry, leave in zip(ends, nested, nested[1:]):
                ids += pieces.best_path(text, a + entry, b + leave, vocabulary)[1]
            assert ids == whole


FILES = [
    ("LICENSE", "Released under the MIT License.", "MIT"),
    ("a/LICENSE.txt", "Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    ("a/b/c/code.py", "# nothing here\nx = 1", "Apache-2.0"),
    ("a/own.py", "# This work is licensed under the GNU General Public License, version 3.\nx", "GPL-3.0"),
    ("ab/code.py", "x", "MIT"),
    ("top.py", None, "MIT"),
    ("a/b/COPYING", "no such wording", "Apache-2.0"),
    ("c/COPYING", "Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
    ("c/LICENSE", "Licensed under CC BY 4.0.", "CC-BY-4.0"),
    ("c/x", "", "CC-BY-NC-4.0"),
    (None, "the driver has a license to drive", None),
    (None, "Released under the MIT License.", "MIT"),
]


def test_licences_of_files(spark):
    files = spark.createDataFrame([(p, t, "clash") for p, t, _ in FILES + FILES], "path string, text string, license string")
    out = licences.scan(files)
    got = sorted((r["path"] or "", str(r["license"])) for r in out.collect())
    assert got == sorted((p or "", str(x)) for p, _, x in FILES + FILES)
    assert licences.scan(files.limit(0)).count() == 0


def test_deciding_terms_lose_nothing():
    vectors = [{"a": 0.8, "b": 0.6}, {"c": 0.9, "d": 0.43589}]
    assert licences.deciding_terms(vectors, 0.6) == ["a", "b", "c"] or licences.deciding_terms(vectors, 0.6) == ["a", "c"]
    assert licences.deciding_terms(vectors, 0.3) == ["a", "b", "c", "d"]


def test_top_k_of_repeated_rows(spark):
    draw = random.Random(8)
    vectors = [(i, [round(draw.gauss(0, 0.3), 3) for _ in range(3)]) for i in range(200)]
    vectors += [(300 + i, [0.75, 0.5, 0.5]) for i in range(7)]
    doubled = vectors * 2 + [vectors[200]] * 12
    table = spark.createDataFrame(doubled, "vec_id long, embedding array<double>")
    for settings in ({}, {"cells": 3, "block": 20, "query_block": 4}):
        out = cover_tree.top_k(table, F.col("vec_id") % 50 == 0, **settings)
        assert sorted(tuple(r) for r in out.collect()) == _best(vectors, 5)


def test_licence_notice_over_several_lines(spark):
    body = "river stone garden window letter morning table paper winter orange lesson\n" * 20
    notice = "# Redistribution and use in source and binary\n# forms, with or without modification, are permitted\n# provided that the following\n# conditions are met\n"
    rows = [(1, body + notice + body, "en", "a"), (2, body, "en", "a")]
    files = documents(spark, rows).withColumn("path", F.concat(F.lit("a/"), F.col("doc_id"), F.lit(".c")))
    got = {r["doc_id"]: r for r in licences.scan(files, declares=F.lit(True)).collect()}
    assert got[1]["own_license"] == "BSD-3-Clause" and got[1]["own_score"] > 0.99
    assert got[2]["own_license"] is None and got[2]["license"] == "BSD-3-Clause" and got[2]["license_path"] == "a/1.c"


def test_licences_are_inherited_in_the_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    folder = F.concat_ws("/", F.coalesce("source", F.lit("_")), F.coalesce("lang", F.lit("_")))
    files = docs.select("doc_id", "text", F.concat_ws("/", folder, "doc_id").alias("path"))
    rows = licences.scan(files, declares=F.lit(True)).collect()
    stated = {}
    for r in sorted(rows, key=lambda r: r["path"]):
        if r["own_license"] is not None:
            stated.setdefault(r["path"].rpartition("/")[0], (r["path"], r["own_license"]))

    def nearest(path):
        while path:
            path = path.rpartition("/")[0]
            if path in stated:
                return stated[path]
        return None, None

    heirs = [r for r in rows if r["own_license"] is None]
    assert [(r["license_path"], r["license"]) for r in heirs] == [nearest(r["path"]) for r in heirs]
    assert sum(r["license"] is not None for r in heirs) > 0


def test_licence_scan_keeps_columns_of_any_name(spark):
    rows = [("a/LICENSE", licences.TEMPLATES[0][1], "f", "d", "c", "k"), ("a/b/x.py", "code", "f", "d", "c", "k"), (None, None, None, None, None, None)]
    names = ["file", "dir", "declares", "text_key"]
    files = spark.createDataFrame(rows, "path string, text string, " + ", ".join(f"{n} string" for n in names))
    out = {r["path"]: r for r in licences.scan(files).collect()}
    assert out["a/b/x.py"]["license"] == licences.TEMPLATES[0][0] and out["a/b/x.py"]["license_path"] == "a/LICENSE"
    assert [out["a/b/x.py"][n] for n in names] == ["f", "d", "c", "k"] and out[None]["license"] is None


def test_documents_inherit_licences_in_the_query(spark):
    rows = queries.op6_license_scan(spark, "/root/testdata/sf0.001").collect()
    assert sum(r["own_license"] is None and r["license"] is not None for r in rows) > 0
