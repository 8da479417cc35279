import hashlib

import pytest
from pyspark.sql import functions as F

from loanseason.llm import exact_dedup, near_dedup, repeats
from loanseason.llm.components import components

from .helpers import documents, near_components, near_family, odd_rows, shingles, words


def _weak(text):
    """A hash with eight values, so that most groups hold several byte strings."""
    return F.substring(F.md5(text), 1, 1).substr(1, 1)


@pytest.mark.parametrize("content_hash", [exact_dedup.hash128, _weak])
def test_exact_groups(spark, content_hash):
    rows = odd_rows()
    docs = documents(spark, rows).withColumn("KEEP_ID", F.lit("clash"))
    for keep, pick in (("largest", max), ("smallest", min)):
        got = exact_dedup.mark_duplicates(docs, keep=keep, content_hash=content_hash).collect()
        fold = lambda t: (t or "").encode().lower()
        groups = {}
        for i, text, *_ in rows:
            groups.setdefault(fold(text), []).append(i)
        assert len(got) == len(rows)
        for r in got:
            group = groups[fold(r["text"])]
            ids = [i for i in group if i is not None]
            assert r["keep_id"] == (pick(ids) if ids else None)
            assert r["group_size"] == len(group)
            assert r["kept"] == (r["doc_id"] == r["keep_id"])
            assert r["text_sha256"] == hashlib.sha256(fold(r["text"])).hexdigest()


def test_exact_stage_keeps_columns(spark):
    docs = documents(spark, odd_rows())
    out = exact_dedup.deduplicate(docs, keep="smallest")
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.select("doc_id").collect()) == [1, 2, 4, 6, 8, 9]
    assert exact_dedup.deduplicate(docs.limit(0)).count() == 0


def test_components_of_long_paths(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 150), (None, 3)]
    out = components(spark.createDataFrame(edges, "u long, v long"))
    got = {r["node"]: r["component"] for r in out.collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100, 200: 150, 150: 150}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_groups_equal_brute_force(spark):
    rows = near_family()
    rows += [(2000 + i, t) for i, t in rows[:20]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    settings = near_dedup.NearSettings(words=2)
    got = near_dedup.near_groups(docs, settings=settings).collect()
    want = near_components(rows, 2, 80)
    texts = dict(rows)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert all(r["n_shingles"] == len(shingles(texts[r["doc_id"]], 2)) for r in got)
    assert 1 < len(set(want.values())) < len(want)


def test_near_groups_of_odd_rows(spark):
    docs = documents(spark, odd_rows()).withColumn("component_id", F.lit("clash"))
    got = near_dedup.near_groups(docs).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(odd_rows())
    assert by_id[5]["component_id"] == 1 and not by_id[5]["kept"]
    assert by_id[7]["component_id"] == 6
    assert all(by_id[i]["component_id"] == i and by_id[i]["n_shingles"] == 0 for i in (2, 3, 4))
    assert by_id[None]["component_id"] is None and by_id[None]["kept"]
    kept = near_dedup.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, -1, 1, 2, 3, 4, 6, 8, 9]
    assert near_dedup.near_groups(docs.limit(0)).count() == 0


def _without_repeats(texts, window):
    split = [words(t) for t in texts]
    places = {}
    for i, w in enumerate(split):
        for k in range(len(w) - window + 1):
            places.setdefault(tuple(w[k : k + window]), []).append((i, k))
    gone = {(i, j) for at in places.values() if len(at) > 1 for i, k in at for j in range(k, k + window)}
    return [b" ".join(x for j, x in enumerate(w) if (i, j) not in gone).decode() for i, w in enumerate(split)]


def test_repeats_equal_brute_force(spark):
    import random

    draw = random.Random(5)
    word = lambda: f"w{draw.randrange(60)}"
    shared = [" ".join(word() for _ in range(n)) for n in (12, 20, 40)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(4):
            parts.append(" ".join(word() for _ in range(draw.randrange(0, 30))))
            if draw.random() < 0.4:
                parts.append(draw.choice(shared))
        texts.append(" ".join(parts))
    texts += [texts[0], "same same " * 40, None, "", " ".join(texts[1].split()[3:25])]
    settings = repeats.RepeatSettings(window=9, phrase=4)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("k1", F.lit("clash"))
    got = {r["doc_id"]: r["kept_text"] for r in repeats.drop_repeats(docs, settings=settings).collect()}
    want = _without_repeats(texts, 9)
    assert [got[i] for i in range(len(texts))] == want
    assert any(a != " ".join((b or "").split()) for a, b in zip(want, texts))
    assert repeats.drop_repeats(docs.limit(0)).count() == 0


def test_repeats_of_odd_rows(spark):
    docs = documents(spark, odd_rows())
    got = {r["doc_id"]: r["kept_text"] for r in repeats.drop_repeats(docs).collect()}
    assert got[6] == "" and got[7] == "" and got[1] == "The quick brown fox" and got[2] == ""


def test_exact_stage_leaves_one_row_of_each_group(spark):
    docs = documents(spark, [r for r in odd_rows() if r[0] not in (2, 3, 4)] + [(None, None, None, None)])
    out = exact_dedup.deduplicate(docs.union(docs), keep="smallest")
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] or -1 for r in out.collect()) == [-1, 1, 6, 8, 9]
