"""Spelling variants, neighbour descent and periodic runs against brute force."""
import hashlib
import os
import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import neighbours, periodic_runs, queries, spelling
from shelfcast.llm.common import Stages, prepare

SF = os.environ.get("LLM_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def spark(spark):
    prepare(spark)
    return spark


# spelling variants

def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def some_words(seed, n=400, letters="abé"):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(n)})


def test_acceptor_is_minimal_and_composes_with_one_edit():
    words = ["", "tap", "taps", "top", "tops", "tips", "x"]
    a = spelling.Acceptor(sorted(words))
    assert len(a.arcs) == len({(f, tuple(x.items())) for f, x in zip(a.final, a.arcs)})
    assert len(a.arcs) < sum(map(len, words))
    pairs = {tuple(sorted(p)) for p in a.near_pairs()}
    assert pairs == {tuple(sorted(p)) for p in combinations(words, 2) if near(*p)}
    assert list(spelling.Acceptor(["word"]).near_pairs()) == []
    long = "ab" * 20_000  # no recursion over a word's length
    assert len(list(spelling.Acceptor(sorted([long, long + "c"])).near_pairs())) == 1


@pytest.mark.parametrize("large", [20_000, 3])
def test_near_pairs_equal_brute_force_also_where_partitions_are_split(spark, large):
    words = some_words(large)
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n bigint")
    got = [(r["a"], r["b"]) for r in spelling.near_pairs(df, Stages(spark), large).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {p for p in combinations(words, 2) if near(*p)}


def test_split_partitions_hold_few_words(spark):
    words = some_words(5, 3000, "abc")
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n bigint")
    whole = spelling.partitions(df, Stages(spark)).groupBy("head", "tail", "least").count()
    split = spelling.partitions(df, Stages(spark), 20).groupBy("head", "tail", "least").agg(F.countDistinct("word").alias("count"))
    assert whole.where("count > 60").count() > 0
    assert split.where("count > 40").count() == 0  # partitions of two levels may be the same one


def test_variants_follow_forms_to_the_root(spark):
    df = spark.createDataFrame([("center", 40), ("centre", 9), ("centr", 20), ("cents", 10), ("centq", 11), ("lonely", 3)], "word string, n bigint")
    got = {r["word"]: tuple(r)[1:] for r in spelling.variants(df).collect()}
    assert got["lonely"] == (None, "lonely", 3, 0, None)
    assert got["center"][0] is None
    assert got["cents"] == ("centr", "center", 10, 2, 20)
    assert got["centq"] == (None, "centq", 11, 2, None)
    assert got["centre"] == ("centr", "center", 9, 1, 20)
    assert spelling.variants(df.limit(0)).count() == 0


def test_vocabulary_of_awkward_rows(spark):
    docs = spark.createDataFrame(
        [(1, "Ünder ÜNDER Ünder-under", "x"), (2, None, "x"), (None, "under word×word under", None), (3, "", "x"), (3, "abcd " * 40_000, "x"),
         (4, "under", "x"), (4, "under", "x")], "doc_id long, text string, word string")
    got = {r["word"]: r["n"] for r in spelling.vocabulary(docs, min_count=1).collect()}
    # only A-Z is lower-cased; Ü is a letter of its own
    assert got == {"Ünder": 3, "under": 5, "word×word": 1}
    respelt = spelling.vocabulary(docs, min_count=1, respell=lambda d, r: r[1:] if d == "4" else r)
    assert {r["word"]: r["n"] for r in respelt.collect()} == {"Ünder": 3, "under": 3, "word×word": 1}
    assert spelling.vocabulary(docs.limit(0)).count() == 0


def test_misspelling_of_the_contract():
    hits = [i for i in range(2000) if queries.misspelt(str(i), "letters") != "letters"]
    assert hits == [i for i in range(2000) if zlib.crc32(f"{i}:letters".encode()) % 97 == 0]
    h = zlib.crc32(f"{hits[0]}:letters".encode()) % 7
    assert queries.misspelt(str(hits[0]), "letters") == "letters"[:h] + "letters"[h + 1:]


# neighbour descent

def brute_neighbours(rows, threshold=0.95):
    """(vec_id, n_links, component_id, kept) by all pairs."""
    unit = []
    for _, v in rows:
        ok = v and all(c is not None and np.isfinite(c) for c in v) and any(v)
        x = np.array(v, float) if ok else None
        unit.append(None if x is None else x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max()))
    group, n = list(range(len(rows))), [0] * len(rows)
    for i, j in combinations(range(len(rows)), 2):
        if unit[i] is not None and unit[j] is not None:
            w = min(len(unit[i]), len(unit[j]))
            if unit[i][:w] @ unit[j][:w] >= threshold:
                n[i], n[j] = n[i] + 1, n[j] + 1
                group = [group[i] if g == group[j] else g for g in group]
    out = []
    for i, (k, _) in enumerate(rows):
        ids = [r[0] for r, g in zip(rows, group) if g == group[i] and r[0] is not None]
        c = min(ids, default=None)
        out.append((k, n[i], c, k == c))
    return sorted(out, key=str)


def test_neighbours_equal_brute_force_on_clusters(spark):
    rng = np.random.default_rng(3)
    vectors = [*rng.standard_normal((150, 16))]
    for spread, size in ((.02, 60), (.25, 40), (.3, 30)):  # a dense group, which saturates lists, and loose ones
        c = rng.standard_normal(16)
        vectors += [c + spread * rng.standard_normal(16) for _ in range(size)]
    vectors += [vectors[0]] * 25 + [3 * vectors[1], vectors[2] * 1e200, vectors[2] * 1e-200]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, neighbours.near_duplicates(df, width=5).collect()), key=str)
    assert got == brute_neighbours(rows)


def test_neighbours_of_awkward_rows(spark):
    rows = [(5, [1.0, 2.0]), (5, [1.0, 2.0]), (3, [1.0, 2.0, 0.0]), (None, [2.0, 4.0]), (1, None), (2, []), (4, [0.0, -0.0]), (6, [1.0, None]),
            (7, [1.0, float("nan")]), (8, [float("inf"), 1.0]), (None, [-1.0, 2.0]), (9, [1e38, 0.0]), (10, [1e-38, 0.0])]
    for kind in ("float", "double"):
        df = spark.createDataFrame([(*r, 1, "x") for r in rows], f"vec_id long, embedding array<{kind}>, a int, label string")
        got = sorted(map(tuple, neighbours.near_duplicates(df).collect()), key=str)
        assert got == brute_neighbours(rows)
    assert neighbours.near_duplicates(df.limit(0)).count() == 0


def test_saturated_lists_are_enlarged(spark):
    rng = np.random.default_rng(4)
    centre = rng.standard_normal(32)
    rows = [(i, (centre + .02 * rng.standard_normal(32)).tolist()) for i in range(300)]
    got = neighbours.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), width=4).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(299, 0)}


# periodic runs

def brute_runs(x, least=6, exponent=4):
    n, out = len(x), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            size, part = j - i + q, x[i:j + q]
            if size >= max(least, exponent * q) and not any(
                    all(part[k] == part[k + r] for k in range(size - r)) for r in range(1, q)):
                out.append((i, size, q))
            i = j
    return sorted(out)


def periodic_text(rng):
    words = []
    while len(words) < rng.randint(0, 150):
        if rng.random() < .5:
            words += [rng.choice("ab") for _ in range(rng.randint(1, 20))]
        else:
            unit = [rng.choice("abc") for _ in range(rng.randint(1, 14))]
            words += (unit * rng.randint(1, 9))[:rng.randint(1, 100)]
    return " ".join(words)


@pytest.mark.parametrize("limits", [(1 << 15, 1 << 18, 1 << 19), (8, 64, 64)])
def test_runs_equal_brute_force(limits, monkeypatch):
    for name, value in zip(("LONGEST", "WORDS", "CELLS"), limits):
        monkeypatch.setattr(periodic_runs, name, value)
    rng = random.Random(6)
    for _ in range(120):
        texts = [periodic_text(rng) for _ in range(rng.randint(1, 7))]
        for t, (words, runs) in zip(texts, periodic_runs.runs_of(texts)):
            assert runs == brute_runs(t.split()), t


def test_transform_is_exact():
    rng = np.random.default_rng(0)
    for c in (1, 2, 16, 256):
        patterns, windows = rng.integers(0, 65537, (3, c)), rng.integers(0, 65537, (3, 2 * c))
        got = periodic_runs.mismatches(patterns, windows)
        true = [[int(((patterns[i] - windows[i, k:k + c]) ** 2).sum()) % 65537 for k in range(c)] for i in range(3)]
        assert got.tolist() == true
    x = rng.integers(0, 65537, (64, 5))
    back = periodic_runs.transform(periodic_runs.transform(x), inverse=True) * pow(64, -1, 65537) % 65537
    assert (back == x).all()


def test_runs_of_long_and_awkward_texts(spark):
    docs = spark.createDataFrame([(1, None, "r"), (2, "", "r"), (3, " \n", "r"), (4, "a " * 300_000, "r"), (5, "x a a a a a a y", "r"),
                                  (5, "x a a a a a a y", "r"), (None, "a b c " * 4, "r")], "doc_id long, text string, runs string")
    got = [(r["doc_id"], r["_found"]["n_words"], [tuple(x) for x in r["_found"]["runs"]], r["_found"]["collapsed"])
           for r in periodic_runs.periodic_runs(docs).collect()]
    assert got == [(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 300_000, [(0, 300_000, 1)], "a"), (5, 8, [(1, 6, 1)], "x a y"),
                   (5, 8, [(1, 6, 1)], "x a y"), (None, 8, [(0, 8, 2)], "a b c")]
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(np.zeros(9, np.int64), exponent=3)


def test_periodic_query_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op13_periodic_runs(spark, SF).collect():
        words = (texts[r["doc_id"]] or "").encode().split()
        h, n = zlib.crc32(str(r["doc_id"]).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        if n > 1500 and h % 10:
            continue  # quadratic; the long ones are held against it by the random texts
        runs = brute_runs(words)
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None, None, None))
        gone = {i for s, size, q in runs for i in range(s + q, s + size)}
        left = b" ".join(w for i, w in enumerate(words) if i not in gone)
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(left).hexdigest()


# ---------------------------------------------------------------- language ID: certainty a word
def test_known_share_equals_a_plain_count(spark):
    from shelfcast.llm import language_id
    rows = [(1, "the dog and the cat", "en"), (2, "der hund und die katze", "de")]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    trained = {w for _, t, _ in rows for w in t.split()}
    seen = {(n, g) for w in trained for n in range(1, 5) for g in language_id.grams(w, n)}
    for text in ("the dog", "dogs und cats", "a", "é", "собака the", "hunde kätzchen x the the", "katze " * 50 + "qqqq"):
        shares = []
        for w in text.split():
            found = language_id.grams(w, min(4, len(w) + 2))
            shares.append(1.0 if w in trained else sum((len(g), g) in seen for g in found) / len(found))
        assert abs(model.judged(text)[2] - sum(shares) / len(shares)) < 1e-12, text
        assert model.judged(text)[:2] == model.predict(text)
    assert [model.judged(t) for t in (None, "", "12 %")] == [("und", 0.0, 0.0, 0)] * 3
    assert model.judged("the dog The")[3] == 3


def test_language_stage_rejects_unlearned_languages_and_keeps_clean_documents(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    foreign = ["Это русский текст о собаке и кошке, которые живут в большом доме у реки. " * 20,
               "Ten tekst jest napisany po polsku i mówi o psie oraz kocie, którzy mieszkają w dużym domu. " * 20,
               "Tämä on suomenkielinen teksti joka kertoo koirasta ja kissasta isossa talossa joen rannalla. " * 20]
    # without a label they teach nothing
    added = spark.createDataFrame([(10**9 + i, t) for i, t in enumerate(foreign)], "doc_id long, text string")
    whole = docs.unionByName(added, allowMissingColumns=True)
    kept = {r["doc_id"] for r in corpus_pipeline.language_stage(spark, whole, SF).select("doc_id").collect()}
    assert not kept & {10**9 + i for i in range(3)}
    # no document of a learned language goes for its words: the posterior alone rejects texts of a word or two
    assert kept == {r["doc_id"] for r in queries.op3_language_id(spark, SF).where(
        (F.col("lang_pred") != "und") & (F.col("score") >= corpus_pipeline.MIN_LANGUAGE_SCORE)).select("doc_id").collect()}


def test_training_counts_every_labelled_row(spark):
    from shelfcast.llm import language_id
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda i: "".join(letters[i // 26 ** k % 26] for k in range(4))
    rows = [(i, f"{word(i)} {word(i)} same", "xx") for i in range(11_000)] + [(-1, "other", "yy")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6)
    model = language_id.train(docs, F.lit(True))
    assert set(model.words) == {word(i) for i in range(11_000)} | {"same", "other"}
    times = lambda w: model.table[model.words[w], model.languages.index("xx")]
    assert abs(np.exp(times("same") - times(word(5))) - 11_000.5 / 2.5) < 1e-6


def test_the_limit_on_known_words_counts_every_held_out_row(spark):
    from shelfcast.llm import language_id
    model = language_id.Model(["xx"], {}, {}, np.zeros((0, 1)))
    # 199 of 19,900 test rows know 0.2, all others 0.8: the hundredth lies at 0.2 only if all count
    judged = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 19_900, "xx").alias("lang"),
        F.struct(F.when(F.col("id") < 200, 0.2).otherwise(0.8).alias("known"), F.lit(1_000_000).cast("long").alias("words")).alias("p"))
    low = language_id.unlearned(judged, model, F.lit(True), F.col("lang"))
    tried = spark.createDataFrame([(0.09,), (0.11,), (0.3,), (0.41,)], "k double").select(
        F.struct(F.col("k").alias("known"), F.lit(1_000_000).cast("long").alias("words")).alias("p"))
    assert [r[0] for r in tried.select(low).collect()] == [True, False, False, False]


def plain_model():
    from shelfcast.llm import language_id
    taught = {"en": "the dog and the cat don't", "de": "der hund und die katze wei\u00df", "el": "\u03bf \u03c3\u03ba\u03cd\u03bb\u03bf\u03c2 \u03ba\u03b1\u03b9"}
    counts = {}
    for lang, text in taught.items():
        for w in language_id.WORD.findall(text):
            for n, g in [(0, w)] + [(n, g) for n in range(1, 5) for g in language_id.grams(w, n)]:
                counts[lang, n, g] = counts.get((lang, n, g), 0) + 1
    kept = [{"lang": lang, "n": n, "gram": g, "c": c} for (lang, n, g), c in counts.items()]
    totals = [{"lang": lang, "n": n, "total": sum(r["c"] for r in kept if (r["lang"], r["n"]) == (lang, n)),
               "types": sum((r["lang"], r["n"]) == (lang, n) for r in kept)} for lang in taught for n in range(5)]
    return language_id._model(kept, totals)


def test_judging_looks_for_words_once_a_token(monkeypatch):
    from shelfcast.llm import language_id
    model, read, cut = plain_model(), [], []
    word, grams = language_id.WORD, language_id.grams

    class Counted:
        def findall(self, text):
            read.append(len(text))
            return word.findall(text)
    monkeypatch.setattr(language_id, "WORD", Counted())
    monkeypatch.setattr(language_id, "grams", lambda w, n: cut.append(w) or grams(w, n))
    for i in range(200):
        assert model.judged("The dog, dogs and cats2cats: " * (i + 1))[3] == 6 * (i + 1)
    assert sum(read) <= len("cats2cats") and len(cut) <= 8


@pytest.mark.parametrize("held", [64 << 20, 0])
def test_judging_by_tokens_equals_judging_by_words(monkeypatch, held):
    from shelfcast.llm import language_id
    monkeypatch.setattr(language_id, "MEMO_BYTES", held)
    monkeypatch.setattr(language_id, "BLOCK", 3)
    texts = ["The dog\u00a0dogs\u2003don't DON'T d%o|g", "\u039f \u03a3\u039a\u03a5\u039b\u039f\u03a3. \u03a3 '\u03a3' \u03a3\u03ba\u03a3-\u03a3 \u0391\u03a3.\u0391 \u03bf\u03a3\u1fbd\u0391",
             "\u0130\u0130\u0130 wei\u00df WEISS \u1e9e e\u0301te\u0301 \u0301\u0301 \u0301a", "katze" * 40 + " " + "Dog2" * 40 + ",the" * 30, "\u65e5\u672c\u8a9e" * 50,
             "x1y\x1cz\x85q\u2028r \u00b2 \u2167 _a_b_ 12 %", "hund\nhunde\tHUNDE hundehund", " ".join(f"{a}{b}" for a in "abcdefg" for b in "hijkl")]
    model = plain_model()
    for text in texts + texts[::-1]:
        words = language_id.WORD.findall(text.lower())
        total, share = np.zeros(len(model.languages)), 0
        for w in words:
            if w in model.words:
                total, share = total + model.table[model.words[w]], share + 1
                continue
            for n in range(4, 0, -1):
                found = language_id.grams(w, n)
                known = [model.by_length[n][g] for g in found if g in model.by_length[n]]
                if known:
                    total = total + model.table[known].mean(0)
                    share += len(known) / len(found) if n == min(4, len(w) + 2) else 0
                    break
        lang, score, known, n = model.judged(text)
        assert n == len(words), text
        assert known == pytest.approx(share / n, abs=1e-9) and score == pytest.approx(1 / np.exp(total - total.max()).sum()), text
        assert total[model.languages.index(lang)] == pytest.approx(total.max()), text
