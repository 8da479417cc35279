import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanseason.llm import language_id, pieces, pii, toxicity
from loanseason.llm.common import fold_number

from .helpers import documents, odd_rows


def test_sum_over_segmentations():
    index = language_id.piece_index()
    chances = np.random.default_rng(0).random((index.unknown + 1, 2))
    chances /= chances.sum(axis=0)

    def brute(word, model):
        total = 0.0
        for mask in range(2 ** (len(word) - 1)):
            cuts = [0, *(i + 1 for i in range(len(word) - 1) if mask >> i & 1), len(word)]
            p = 1.0
            for a, b in zip(cuts, cuts[1:]):
                k = index.numbers.get(word[a:b], index.unknown if b == a + 1 else -1)
                p *= chances[k, model] if k >= 0 else 0.0
            total += p
        return math.log(total)

    words = [" the", " straße", " tion", " ñaé漢", " x"]
    got = language_id.log_likelihoods(words, language_id.ArcFinder(index), chances)
    assert np.allclose(got, [[brute(w, m) for m in (0, 1)] for w in words])


def test_languages_of_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language_id.fit(docs)
    out = language_id.predict(docs.withColumn("score", F.lit("clash")), model).collect()
    held = [r for r in out if fold_number(r["doc_id"], 4) == 2]
    assert len(held) > 20
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in out)


def test_languages_of_odd_rows(spark):
    docs = documents(spark, odd_rows())
    got = language_id.predict(docs, language_id.fit(docs)).collect()
    assert len(got) == len(odd_rows())
    assert all((r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or "")) for r in got)
    unlearned = language_id.fit(docs.limit(0))
    assert {r["lang_pred"] for r in language_id.predict(docs, unlearned).collect()} == {"und"}
    assert language_id.predict(docs.limit(0), unlearned).count() == 0


def _disguised(word, k):
    return [
        word, word.upper(), word.replace("o", "0").replace("i", "1"), word.replace("o", "000"),
        " ".join(word), ".".join(word), word.replace("s", "$").replace("a", "@"), word[0] * 4 + word[1:],
        "  ".join(word), "".join(2 * sign for sign in word), word[0] + 2 * word[1] + word[2:],
    ][k]


@pytest.fixture(scope="module")
def toxic_tables(spark):
    import random

    draw = random.Random(2)
    plain = ["river", "stone", "garden", "window", "letter", "morning", "table", "paper", "winter", "orange", "lesson", "idol", "storm"]
    bad = ["idiot", "moron", "scumbag"]
    rows, labels = [], []
    for i in range(1500):
        text = [draw.choice(plain) for _ in range(40)]
        toxic = i % 5 == 1
        if toxic:
            text[10] = draw.choice(bad)
            text[30] = draw.choice(bad)
        rows.append((i, " ".join(text), "en", "a"))
        labels.append((i, int(toxic)))
    extra = [(5000 + 10 * b + k, f"river stone {_disguised(word, k)} garden", "en", "a") for b, word in enumerate(bad) for k in range(11)]
    return documents(spark, rows + extra), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxic_words_in_disguise(spark, toxic_tables):
    docs, labels = toxic_tables
    model = toxicity.fit(docs, labels)
    out = {r["doc_id"]: r for r in toxicity.score(docs.withColumn("SCORE", F.lit(1)), model).collect()}
    held = [i for i in range(1500) if fold_number(i, 5) == 0]
    assert np.mean([out[i]["predicted"] == (i % 5 == 1) for i in held]) > 0.98
    clean = out[0]["score"]
    assert all(out[5000 + 10 * b + k]["score"] > clean for b in range(3) for k in range(11))
    kept = toxicity.reject_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert all(r["doc_id"] % 5 != 1 or r["doc_id"] >= 1500 for r in kept.collect())


@pytest.mark.parametrize("token", ["st00p", "f1sh", "sto*e", "  t h", "aabb", "g@@a", "i  d", "1!l"])
def test_restored_writing_is_the_likeliest_of_all(token):
    """Viterbi against every writing of the token, each scored on its own."""
    model = np.log(np.random.default_rng(7).dirichlet(np.ones(28), (28, 28)))

    def kind(sign):
        return ord(sign) - 97 if "a" <= sign <= "z" else 26 if sign.isalpha() else 27

    def chance(written):
        kinds = [27, 27, *map(kind, written), 27]
        return sum(model[a][b][c] for a, b, c in zip(kinds, kinds[1:], kinds[2:]))

    writings = [("", 0.0)]
    for options in toxicity._lattice(token):
        writings = [(w + more, cost + c) for w, cost in writings for more, c in options]
    best = max(cost + chance(w) for w, cost in writings)
    got = toxicity.restore(token, model.tolist())
    assert max(cost for w, cost in writings if w == got) + chance(got) == pytest.approx(best)


def test_restoring_on_the_given_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    restorer = toxicity.Restorer(toxicity.letter_model(docs).tolist())
    plain = {w for r in docs.select("text").limit(300).collect() for w in (r["text"] or "").lower().split() if w.isalpha()}
    assert all(restorer.words(word) == {word} for word in plain if all(a != b for a, b in zip(word, word[1:])))
    # A doubled letter may be shortened, in a word that is written so as well; nothing else changes.
    single = lambda word: "".join(a for a, b in zip(word, word[1:] + " ") if a != b)
    assert all(len(found) == 1 and single(*found) == single(word) for word in plain for found in [restorer.words(word)])
    word = max((w for w in plain if w.isascii() and len(set(w)) == len(w)), key=lambda w: (len(w), w))
    assert word in restorer.words("  ".join(word)) and word in restorer.words(" \t ".join(word))


def test_given_labels_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rated = toxicity.score(docs, toxicity.fit(docs, labels)).join(labels.select("doc_id", "toxic"), "doc_id")
    held = [r for r in rated.collect() if fold_number(r["doc_id"], 5) == 0]
    caught = sum(r["predicted"] for r in held if r["toxic"]) / max(1, sum(r["toxic"] for r in held))
    alarms = sum(r["predicted"] for r in held if not r["toxic"]) / max(1, sum(1 - r["toxic"] for r in held))
    assert caught > 0.8 and alarms < 0.01


def test_toxicity_of_odd_rows(spark):
    docs = documents(spark, odd_rows())
    labels = spark.createDataFrame([(1, 1), (1, 0), (8, 0), (None, 1), (9, None)], "doc_id long, toxic int")
    for few in (labels, labels.limit(0)):
        got = toxicity.score(docs, toxicity.fit(docs, few)).collect()
        assert len(got) == len(odd_rows())
        assert all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), labels)).count() == 0


@pytest.mark.parametrize(
    "text, base, added",
    [
        ("a@b.c@d.e x..@y-z.co", ["a@b.c", "x..@y-z.co"], []),
        ("1.2.3.4.5 300.1.1.1 9.9.9.9.8.8.8.8", ["1.2.3.4", "9.9.9.9", "8.8.8.8"], []),
        ("pay 4111 1111 1111 1111 now or 4111 1111 1111 1112", ["4111 1111 1111 1111"], []),
        ("call +1 (555) 123-4567.", ["+1 (555) 123-4567"], []),
        ("mail me at john dot doe at example dot com please", [], ["john dot doe at example dot com"]),
        ("john(at)foo[dot]com", [], ["john(at)foo[dot]com"]),
        ("jоhn@exаmple.com", [], ["jоhn@exаmple.com"]),
        ("plus four nine one five one two three four five six seven", [], ["plus four nine one five one two three four five six seven"]),
        ("4111 1111 1l11 1111", [], ["4111 1111 1l11 1111"]),
        ("look at example.com, one two three", [], []),
        ("", [], []),
        (None, [], []),
    ],
)
def test_personal_data(text, base, added):
    mine, every = pii.find_spans(text)
    assert [text[s:e] for _, s, e in mine] == base
    assert [text[s:e] for k, s, e in every if (k, s, e) not in mine] == added


def test_base_spans_equal_the_patterns():
    import random
    import re

    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def holds(kind, found):
        digits = re.sub("[^0-9]", "", found)
        return {
            "email": True,
            "ip": kind == "ip" and all(int(x) <= 255 for x in found.split(".")),
            "card": 14 <= len(digits) <= 19 and pii.luhn(digits),
            "phone": 10 <= len(digits) <= 15,
        }[kind]

    draw = random.Random(1)
    for _ in range(3000):
        text = "".join(draw.choice("12 0+-.@ab()9") for _ in range(draw.randrange(60)))
        want = [(k, *m.span()) for k, p in patterns.items() for m in re.finditer(p, text) if holds(k, m[0])]
        assert pii.base_spans(text) == pii.in_order(want)


def test_personal_data_of_odd_rows(spark):
    docs = documents(spark, [*odd_rows(), (50, "a" * 200_000 + "1" * 200_000, "en", "a"), (51, "x@y.zz", "en", "a")])
    got = {r["doc_id"]: r for r in pii.find(docs.withColumn("Spans", F.lit(1))).collect()}
    assert got[51]["spans"] == "email:0:6" and got[51]["n_email"] == 1
    assert got[50]["spans"] == "" and got[2]["n_card"] == 0
    assert pii.find(docs.limit(0)).count() == 0


@pytest.mark.parametrize(
    "text, kind, found",
    [
        ("write john arroba example.com", "email", "john arroba example.com"),
        ("write john.doe at example.com", "email", "john.doe at example.com"),
        ("write: john at example\ndot\ncom", "email", "john at example\ndot\ncom"),
        ("(plus four nine one five one two three four five six seven)", "phone", "plus four nine one five one two three four five six seven"),
        ("look at example.com", "email", None),
        ("river (plus one) look at example.com", "email", None),
    ],
)
def test_disguises_do_not_depend_on_the_rest(text, kind, found):
    for around in ("", " – ", " on  ", " a dot b ", " x @ y "):
        whole = f"{text}\n\n{around}"
        spans = [whole[s:e] for k, s, e in pii.find_spans(whole)[1] if k == kind]
        assert ([s for s in spans if "example" in s or "four" in s] or [None]) == [found]


def test_gates_cover_their_patterns():
    import random

    draw = random.Random(6)
    parts = ["john", "at", "AT", "arroba", "@", "example", "com", "dot", "punkt", "(", "]", "<", ".", " ", " ", " ", "\n", "one", "two", "three", "5", "-", ", "]
    met = 0
    for _ in range(30_000):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(4, 16)))
        address = bool(list(pii._address_edits(text)))
        spelled = bool(list(pii._spelled_edits(text)))
        met += address
        assert pii.plain_form(text) is not None or not (address or spelled)
    assert met > 20


def test_start_frequencies_fall_with_the_rank():
    index, vocabulary = language_id.piece_index(), pieces.load_vocabulary()
    assert (index.start > 0).all() and index.start.sum() == pytest.approx(1)
    ranks = np.array([vocabulary.ids[p] + 1.0 for p in index.numbers])
    assert np.allclose(index.start[:-1] * ranks, index.start[0] * ranks[0], rtol=1e-4)
    assert index.start[-1] == pytest.approx(index.start[:-1].min() * np.exp(-10), rel=1e-4)


def test_long_runs_of_rare_letters():
    index = language_id.piece_index()
    finder = language_id.ArcFinder(index)
    chances = np.full((index.unknown + 1, 2), 1e-9)
    chances[:, 1] /= 100
    run = " " + "\U00010348" * 300
    got = language_id.log_likelihoods([run, " the"], finder, chances)
    space = index.numbers.get(" ", index.unknown)
    assert np.allclose(got[0], np.log(chances[space]) + 300 * np.log(chances[index.unknown]))
    assert np.isfinite(got).all()
    likely = np.full((index.unknown + 1, 1), 0.9)
    assert np.isfinite(language_id.log_likelihoods([" " + "tion" * 75], finder, likely)).all()

    start = np.full(index.unknown + 1, 1e-12)
    rare = language_id.PieceIndex(index.numbers, start, index.longest)
    words = {run: 2, " " + "\U00010348\U00010349" * 20 + "q" * 260: 1, " " + "q" * 30: 3}
    counts = language_id.expected_counts(words, language_id.ArcFinder(rare))
    assert counts[index.unknown] == pytest.approx(2 * 300 + 40)
    lengths = np.array([len(p) for p in index.numbers] + [1])
    assert (counts * lengths).sum() == pytest.approx(sum(n * len(w) for w, n in words.items()))


def test_language_of_a_text_with_a_long_run(spark):
    rows = [(1, "der hund und die katze " * 30, "de", "a"), (2, "the dog and the cat " * 30, "en", "a")]
    model = language_id.fit(documents(spark, rows), folds=1)
    chances = model.chances.copy()
    chances[chances < 1e-3] = 1e-12
    model = language_id.LanguageModel(model.languages, model.index, chances, model.prior)
    docs = documents(spark, [(3, "the dog and the cat " + "\U00010348" * 300, None, "a")])
    (got,) = language_id.predict(docs, model).collect()
    assert got["lang_pred"] == "en" and 0 <= got["score"] <= 1


@pytest.mark.parametrize("section, row", [(64_000, 64), (50, 7)])
def test_long_words_are_summed_whole(monkeypatch, section, row):
    """Position by position, and all at once: the same sums and expectations."""
    index = language_id.piece_index()
    finder = language_id.ArcFinder(index)
    draw = np.random.default_rng(5)
    chances = draw.random((index.unknown + 1, 3)) ** 8
    chances /= chances.sum(axis=0)
    words = {" " + "".join(draw.choice(list("thesingaonr\U00010348漢é"), n)): k for k, n in ((1, 1), (2, 9), (3, 140), (1, 299))}
    words |= {" " + "\U00010348" * 299: 2}
    whole, expected = language_id.log_likelihoods(list(words), finder, chances), language_id.expected_counts(words, finder)
    monkeypatch.setattr(language_id, "_AT_ONCE", 0)
    monkeypatch.setattr(language_id, "_SECTION", section)
    monkeypatch.setattr(language_id, "_ROW", row)
    assert np.allclose(language_id.log_likelihoods(list(words), finder, chances), whole, rtol=1e-9)
    assert np.allclose(language_id.expected_counts(words, finder), expected, rtol=1e-7, atol=1e-9)


def test_a_very_long_word_ends_soon():
    index = language_id.piece_index()
    finder = language_id.ArcFinder(index)
    start = time.time()
    word = " " + "thequickbrownfox漢字" * 12_000
    assert np.isfinite(language_id.log_likelihoods([word], finder, index.start[:, None])).all()
    assert language_id.expected_counts({word: 1}, finder).sum() > 12_000
    assert time.time() - start < 60


def test_letters_and_marks():
    assert language_id.words_in("½") == language_id.words_in("²Ⅷ") == language_id.words_in("12_!") == []
    assert language_id.words_in("हिन्दी,x1y") == [" हिन्दी", " x", " y"]
    assert language_id.words_in("a" * 5000) == [" " + "a" * 5000]


def test_a_text_of_signs_has_no_language(spark):
    docs = documents(spark, [(1, "der hund", "de", "a"), (2, "½ ² Ⅷ 5", None, "a"), (3, "ª", None, "a")])
    model = language_id.fit(docs, folds=1)
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(docs, model).collect()}
    assert got == {1: "de", 2: "und", 3: "de"}


@pytest.mark.parametrize(
    "text",
    [
        "x " + "1" * 1_000_000 + "a y",
        "sha1 " + "12345678901234567890abcdef" * 4000,
        "1 2 3 " * 60_000 + "x",
        "one " * 15_000 + "x",
        "uno" * 100_000 + "q",
        "+" * 300_000 + "one",
        "a.b." * 100_000 + " (at) x dot com",
        "a@" * 100_000 + " dot b",
    ],
)
def test_personal_data_takes_linear_time(text):
    start = time.process_time()
    pii.find_spans(text)
    assert time.process_time() - start < 10


def test_runs_of_spelled_digits():
    runs = lambda text: [text[a:b] for a, b in pii._spelled_runs(text)]
    assert runs("call one 23 now") == ["one 23"]
    assert runs("one two 34 56a") == ["one two 34"]
    assert runs("unone five") == ["unone five"] and runs("1 2 3") == [] and runs("one two") == []
    assert runs("plus four nine-1 7, zero 5+ x") == ["plus four nine-1 7, zero 5"]
    assert runs("phone one two three") == ["one two three"]
