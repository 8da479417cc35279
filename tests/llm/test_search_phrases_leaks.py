"""Ranked search, phrases and benchmark passages against plain versions, with small settings that use every path."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanseason.llm import decontaminate, phrases, ranked_search

from .helpers import documents, odd_rows

ITEMS = "item_id long, text string, k1 long, SIZE string"


def folded(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded(text))


def prose(seed, rows, words=60, vocabulary=25):
    draw = random.Random(seed)
    some = [f"w{k}" for k in range(vocabulary)] + ["É", "x-y", "A.b", "9"]
    return [
        (i, " ".join(draw.choice(some) + draw.choice(["", "", "", ",", "\n", "  "]) for _ in range(draw.randrange(words))), draw.choice(["en", "fr", None]), "s")
        for i in range(rows)
    ]


def items_of(spark, texts):
    return spark.createDataFrame([(i, t, 7, "clash") for i, t in texts], ITEMS)


# Benchmark passages


def leaks(text, items, size=10):
    words, hit, names = plain_words(text), set(), set()
    for name, item in items:
        w = plain_words(item)
        n = min(size, len(w))
        runs = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()
        for k in range(len(words) - n + 1):
            if tuple(words[k : k + n]) in runs:
                hit.update(range(k, k + n))
                if name is not None:
                    names.add(str(name))
    return words, hit, sorted(names)


def leak_case():
    rows = odd_rows() + prose(1, 60)
    items = [(1, rows[14][1]), (2, rows[20][1] + " tail"), (3, rows[15][1][:9]), (4, "nothing of this"), (1, rows[30][1]), (None, rows[31][1])]
    items += [(5, None), (6, " .,; "), (7, rows[14][1]), (8, "QUICK brown"), (9, " ".join(rows[8][1].split()[5000:5030]))]
    rows += [(900, "so. " + items[0][1] + "! " + items[0][1], "en", "t"), (901, "The Quick, Brown fox", "en", "t")]
    return rows, items


@pytest.mark.parametrize(
    "settings",
    [decontaminate.WindowSettings(), decontaminate.WindowSettings(broadcast_windows=0, piece_chars=40), decontaminate.WindowSettings(words=1)],
)
def test_leaks_equal_brute_force(spark, settings):
    rows, items = leak_case()
    docs = documents(spark, rows).withColumn("K1", F.lit(1)).withColumn("N_HIT", F.lit("clash"))
    got = decontaminate.find_leaks(docs, items_of(spark, items), settings=settings).collect()
    want = Counter()
    for i, text, *_ in rows:
        words, hit, names = leaks(text, items, settings.words)
        want[(i, text, len(words), len(hit), tuple(names), bool(hit))] += 1
    assert Counter((r["doc_id"], r["text"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in got) == want
    assert any(r["contaminated"] for r in got) and not all(r["contaminated"] for r in got)


def test_decontaminated_documents(spark):
    rows, items = leak_case()
    docs, tests = documents(spark, rows), items_of(spark, items)
    cut = decontaminate.decontaminate(docs, tests)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    for r in cut.collect():
        if r["doc_id"] == 900:
            assert r["text"] == "so. "
        if r["doc_id"] == 901:
            assert r["text"] == "The fox"
        if r["doc_id"] == 9 and r["lang"] == "fr" and r["source"] == "a":
            assert r["text"] == "é ▁ 漢字 \u0000 end"
    clean = decontaminate.decontaminate(docs, tests, remove="documents").collect()
    assert len(clean) == sum(not leaks(t, items)[1] for _, t, *_ in rows)
    assert decontaminate.decontaminate(docs.limit(0), tests).count() == 0
    assert decontaminate.decontaminate(docs, tests.limit(0), remove="documents").count() == len(rows)


def test_one_item_in_many_copies_is_one_entry(spark):
    windows, classes = decontaminate.item_windows(items_of(spark, [(k, "a b c d e f g h i j k") for k in range(50)]))
    assert windows.count() == 2 and classes.count() == 1
    assert all(len(r["classes"]) == 1 for r in windows.collect())


# Ranked search


def ranking(rows, items, best=10):
    bags = [(i, Counter(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", folded(t)))) for i, t, *_ in rows]
    bags = [(i, b) for i, b in bags if b]
    total, terms = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = defaultdict(set)
    for name, text in items:
        asked[name] |= set(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", folded(text)))
    out = []
    for name, wanted in asked.items():
        scores = []
        for i, bag in bags:
            m = 10 + (90 * bag.total() * total) // terms
            score = 0
            for t in wanted & bag.keys():
                w = math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(name, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scores)[:best])]
    return Counter(out)


@pytest.mark.parametrize(
    "settings",
    [
        ranked_search.SearchSettings(),
        ranked_search.SearchSettings(bands=(900, 300, 50), lot=2, slice_docs=7, vocabulary=0),
        ranked_search.SearchSettings(bands=(), slice_bytes=500),
    ],
)
def test_search_equals_brute_force(spark, settings):
    rows = odd_rows() + prose(2, 150) + prose(2, 40)
    items = [(k, rows[14 + 9 * k][1]) for k in range(7)] + [(3, "the fox"), (None, "quick W3"), (50, None), (51, "absent"), (52, "")]
    docs = documents(spark, rows).withColumn("slice", F.lit("clash")).repartition(3)
    got = ranked_search.search(docs, items_of(spark, items), settings=settings)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == ranking(rows, items)


def test_search_of_empty_tables(spark):
    docs, tests = documents(spark, odd_rows()), items_of(spark, [(1, "fox")])
    assert ranked_search.search(docs.limit(0), tests).count() == 0
    assert ranked_search.search(docs, tests.limit(0)).count() == 0


def test_documents_that_cannot_win_are_let_go():
    stage = ranked_search._owner_stage(2)
    empty = ranked_search._schema("slice", "lot", "item", "docs", "scores", "rest").empty_table()
    docs, parts = np.arange(5, dtype=np.int32), np.array([9, 5, 5, 4, 1], np.int32)
    import pyarrow as pa

    owned = pa.table(
        {"slice": [1], "lot": pa.array([0], pa.int32()), "docs": [docs.tobytes()], "parts": [parts.tobytes()], "users": [[{"item": 3, "w": 10, "rest": 10}]]}
    )
    out = stage(empty, owned).to_pylist()[0]
    assert np.frombuffer(out["docs"], np.int32).tolist() == [0, 1, 2, 3]
    assert np.frombuffer(out["scores"], np.int64).tolist() == [90, 50, 50, 40]


# Phrases


def phrase_table(rows, least, top, longest=4):
    counts = defaultdict(Counter)
    for _, text, lang, *_ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, longest + 1):
                counts[lang or "und"].update(tuple(words[k : k + size]) for k in range(len(words) - size + 1))
    out = []
    for lang, seen in counts.items():
        found = {p: a for p, a in seen.items() if len(p) > 1 and a >= least}
        total = sum(a for p, a in seen.items() if len(p) == 1)
        gone = set()
        for longer, b in found.items():
            for size in range(2, len(longer)):
                for k in range(len(longer) - size + 1):
                    if 100 * b >= 80 * found[longer[k : k + size]]:
                        gone.add(longer[k : k + size])
        listed = []
        for p, a in found.items():
            if p not in gone:
                score, k = min((2_000_000 * a // (seen[p[:k]] + seen[p[k:]]), k) for k in range(1, len(p)))
                listed.append((-score, -a, " ".join(p).encode(), seen[p[:k]], seen[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(listed)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total, -score))
    return sorted(out)


@pytest.mark.parametrize(
    "settings",
    [
        phrases.PhraseSettings(least=3, top=40),
        phrases.PhraseSettings(least=3, top=40, window=50, range_words=64, fan_in=2, gate_bits=6),
        phrases.PhraseSettings(least=2, top=500, longest=3, window=500, gate_bits=12),
        phrases.PhraseSettings(least=2, longest=2),
    ],
)
def test_phrases_equal_brute_force(spark, settings, monkeypatch):
    rows = odd_rows()[:8] + odd_rows()[10:] + prose(4, 120, vocabulary=9) + prose(4, 30, vocabulary=9) + [(None, "w1 w1 w1 w1 w1 w1", "und", None)]
    docs = documents(spark, rows).withColumn("codes", F.lit("clash")).repartition(3)
    got = phrases.collocations(docs, settings=settings)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = phrase_table(rows, settings.least, settings.top, settings.longest)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 20


def test_phrases_of_empty_tables(spark):
    docs = documents(spark, odd_rows())
    assert phrases.collocations(docs.limit(0)).count() == 0
    assert phrases.collocations(docs.filter("text is null or length(text) < 2")).count() == 0


def test_windows_overlap_and_long_texts_are_cut(monkeypatch):
    monkeypatch.setattr(phrases, "_CHUNK", 11)
    draw = random.Random(5)
    words = [draw.choice("a b c dd eee".split()) for _ in range(400)]
    text = " ".join(words).encode()
    assert b"".join(phrases._chunks(text)) == text
    stream = phrases._Stream("en", phrases.Coding(bits=40), lambda code: True, 3)
    found = Counter()

    def count():
        ranks, codes, carry = stream.take()
        every = lambda leads: np.ones(len(leads), dtype=bool)
        for gate in (None, every):
            for columns, counts in phrases._levels(ranks, codes, carry, 2 if gate is None else 3, gate):
                for *phrase, n in zip(*columns, counts):
                    found[tuple(map(int, phrase))] += int(n)

    for chunk in phrases._chunks(text):
        stream.add(chunk)
        if stream.size > 30:
            monkeypatch.setattr(phrases, "_REMEMBERED", draw.choice([2, 1000]))
            count()
    count()
    want = Counter(tuple(words[k : k + n]) for n in (2, 3) for k in range(len(words) - n + 1))
    names = {w: phrases.Coding(bits=40).of_language("en")(w.encode()) for w in set(words)}
    assert found == {tuple(names[w] for w in p): n for p, n in want.items()}


def test_automata():
    draw = np.random.default_rng(3)
    parts, want = [], Counter()
    for _ in range(5):
        rows = draw.integers(0, 6, (300, 3)).astype(np.uint64)
        columns, counts = phrases._summed(list(rows.T), np.ones(300, np.int64))
        want.update(map(tuple, rows.tolist()))
        parts.append(phrases.CountAutomaton.from_bytes(phrases.CountAutomaton.build(columns, counts).to_bytes(), 3))
    whole = phrases.CountAutomaton.union(parts)
    assert dict(zip(zip(*(c.tolist() for c in whole.phrases())), whole.counts.tolist())) == want
    ask = draw.integers(0, 8, (400, 3)).astype(np.uint64)
    assert whole.look_up(list(ask.T)).tolist() == [want.get(tuple(a), 0) for a in ask.tolist()]
    frequent = phrases.CountAutomaton.union(parts, least=9)
    assert dict(zip(zip(*(c.tolist() for c in frequent.phrases())), frequent.counts.tolist())) == {p: n for p, n in want.items() if n >= 9}
    none = phrases.CountAutomaton.union(parts, least=10**6)
    assert none.look_up(list(ask.T)).sum() == 0 and all(len(c) == 0 for c in phrases.CountAutomaton.from_bytes(none.to_bytes(), 3).phrases())


def test_codes_are_the_same_in_spark_and_tasks(spark):
    words = ["a", "éa", "", "w" * 70, "漢字"]
    rows = spark.createDataFrame([("de", w) for w in words], "lang string, word string")
    for coding in (phrases.Coding(), phrases.Coding(seed=3, bits=24), phrases.Coding(bits=24).wider()):
        got = [r["code"] % 2**64 for r in rows.select(coding.column().alias("code")).collect()]
        assert got == [coding.of_language("de")(w.encode()) for w in words]


def test_words_that_share_a_code_get_wider_ones(spark, monkeypatch):
    docs = documents(spark, prose(4, 60)).select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    narrow = phrases.Coding(bits=8)
    monkeypatch.setattr(phrases, "Coding", lambda bits: narrow if bits < 64 else None)
    monkeypatch.setattr(type(narrow), "wider", lambda self: type(narrow)(self.seed, self.bits + 8))
    words, coding = phrases.word_counts(docs)
    assert coding.bits > 8 and words.groupBy("lang", "code").count().filter("count > 1").isEmpty()


def test_equal_endings_are_one_state():
    columns = [np.repeat(np.arange(50, dtype=np.uint64), 3), np.tile(np.array([4, 5, 9], np.uint64), 50)]
    automaton = phrases.CountAutomaton.build(columns, np.arange(150))
    assert [len(edges) - 1 for edges, *_ in automaton.layers] == [1, 1]
    assert automaton.look_up(columns).tolist() == list(range(150))
