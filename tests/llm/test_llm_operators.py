"""The operators on Spark: awkward rows with a defined result, and brute force over the test tables."""
import hashlib
import math
import os
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfcast.llm import (best_fit, elias_fano, html_text, language_id, pii, quality_rules, queries, simhash, sql,
                           top_k, url_rules)
from shelfcast.llm.common import prepare, stage_path

SF = os.environ.get("LLM_TEST_SF", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, fp string, `range` string, _w int, length string"
LONG = "word " * 30_000


@pytest.fixture(scope="module")
def spark(spark):
    prepare(spark)
    return spark


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", 1, "l") for r in rows], DOCS)


AWKWARD = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t", "en", "s", 3), (4, "Same words here again now", "en", "s", 25),
           (4, "Same words here again now", "en", "s", 25), (5, "same WORDS here again now", "de", None, 25),
           (None, "no id at all", "en", "s", 12), (7, LONG, "en", "s", len(LONG)), (8, "mail a@b.cd or +1 555 555 0100 20", "en", "s", 33)]


@pytest.fixture(scope="module")
def awkward(spark):
    return docs_of(spark, AWKWARD)


@pytest.fixture(scope="module")
def nothing(spark):
    return docs_of(spark, [])


def rows(df, *by):
    return [tuple(r) for r in df.select(*by).collect()]


def oracle(query):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con.execute(query)


@pytest.mark.parametrize("name", sorted(sql.ORACLES))
def test_sql_gives_the_same_rows(spark, name):
    got = queries.queries()[name](spark, SF)
    want = oracle(sql.ORACLES[name])
    names = sorted(got.columns)
    assert sorted(c[0] for c in want.description) == names
    order = [[c[0] for c in want.description].index(n) for n in names]
    assert Counter(rows(got, *names)) == Counter(tuple(r[i] for i in order) for r in want.fetchall())


def table(name, *columns):
    return oracle(f"SELECT {', '.join(columns)} FROM {name}").fetchall()


# 1 quality rules

def test_quality_awkward_rows(spark, awkward, nothing):
    out = quality_rules.quality_rules(awkward, keep=awkward.columns)
    got = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == len(AWKWARD) and out.columns.count("kept") == 1
    assert (got[1]["n_words"], got[1]["base_failed"], got[1]["kept"]) == (0, True, False)
    assert got[7]["n_repeat_words"] == got[7]["n_words"] == 30_000 and got[7]["base_failed"]
    assert quality_rules.quality_rules(nothing).count() == 0


def test_quality_host_verdict(spark):
    good = " ".join(f"word{i}" for i in range(60))
    sources = [("junk", "short")] * 400 + [("junk", good)] * 2 + [(f"site{i}", good) for i in range(20) for _ in range(20)]
    out = quality_rules.quality_rules(docs_of(spark, [(i, t, "en", s, 0) for i, (s, t) in enumerate(sources)]), keep=["doc_id", "source"])
    kept = Counter((r["source"] == "junk", r["base_failed"], r["kept"]) for r in out.collect())
    assert kept == {(True, True, False): 400, (True, False, False): 2, (False, False, True): 400}


def test_quality_host_of_sixty_failures_in_a_hundred_goes(spark):
    good = " ".join(f"word{i}" for i in range(60))
    marked = good + " #" * 40  # fails the symbol rule alone
    data = [(f"site{s}", marked if i < (60 if s == 0 else 5) else good) for s in range(20) for i in range(100)]
    out = quality_rules.quality_rules(docs_of(spark, [(i, t, "en", s, 0) for i, (s, t) in enumerate(data)]), keep=["source"])
    assert Counter((r["source"] == "site0", r["kept"]) for r in out.collect()) == {(True, False): 100, (False, True): 1900}


def test_beta_prior_settles_degenerate_hosts(spark):
    def prior(*hosts):
        return quality_rules.beta_prior(spark.createDataFrame(list(hosts), "_n long, _f long"))
    assert prior() == (0.0, 1e6)
    assert prior((4, 4)) == (1e6, 0.0)
    a, b = prior((10, 1), (10, 9))
    assert a == b == 0.5  # moments would give less weight than one document


def test_quality_plan_is_native(spark):
    plan = queries.op1_quality_rules(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# 2 exact top-k

def vectors(spark, data):
    return spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")


def test_top_k_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    v = vectors(spark, [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 2), (1, None, 0), (2, [1.0, None], 0), (3, [nan, 1.0], 0), (4, [inf, 1.0], 0),
                        (5, [0.5, 0.0], 0), (6, [0.5, 0.0], 0), (6, [0.5, 0.0], 0), (7, [-1.0], 0), (8, [], 0), (None, [9.0, 9.0], 0), (9, [-0.0001, 0.0], 0)])
    got = rows(top_k.top_k(v, F.col("vec_id") == 0, k=4).orderBy("rank"), "query_id", "rank", "vec_id", "score")
    assert got == [(0, 1, 5, 1024 * 512), (0, 2, 6, 1024 * 512), (0, 3, 8, 0), (0, 4, 9, -1024)]
    assert top_k.top_k(vectors(spark, []), F.col("vec_id") == 0).count() == 0
    assert top_k.top_k(v, F.col("vec_id") == 77).count() == 0


def test_top_k_over_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(top_k, "SHARD", 7)
    monkeypatch.setattr(top_k, "BLOCK", 3)
    monkeypatch.setattr(top_k, "FAN", 2)
    rng = np.random.default_rng(4)
    data = [(i, [float(x) for x in rng.integers(-2, 3, 3)], 0) for i in range(60)]
    got = rows(top_k.top_k(vectors(spark, data), F.col("vec_id") % 5 == 0, k=6, scale=1), "query_id", "rank", "vec_id", "score")
    want = []
    for q, x, _ in data[::5]:
        best = sorted((-int(np.dot(x, y)), i) for i, y, _ in data if i != q)[:6]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert sorted(got) == sorted(want)


def test_top_k_of_very_large_components(spark, monkeypatch):
    monkeypatch.setattr(top_k, "SHARD", 3)
    monkeypatch.setattr(top_k, "FAN", 2)
    rng = np.random.default_rng(5)
    values = [1.0, -2.5, 5e15, -5e15, 1e16, 1e300, -1e308, 3e-5, 2.0**53 + 2]
    data = [(i, [float(x) for x in rng.choice(values, 3)]) for i in range(40)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = rows(top_k.top_k(df, F.col("vec_id") % 10 == 0, k=40), "query_id", "rank", "vec_id", "score")
    exact = {i: [math.floor(Fraction(x) * 1024) for x in v] for i, v in data}
    want = []
    for q in range(0, 40, 10):
        best = sorted((-sum(a * b for a, b in zip(exact[q], exact[i])), i) for i, _ in data if i != q)
        want += [(q, n + 1, i, max(-2**63, min(2**63 - 1, -s))) for n, (s, i) in enumerate(best)]
    assert sorted(got) == sorted(want)


# 3 language ID

def test_language_id_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in queries.op3_language_id(spark, SF).collect()}
    labels = dict(table("documents", "doc_id", "lang"))
    held = [i for i in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert {i for i, r in got.items() if r["held_out"]} == set(held)
    assert np.mean([got[i]["lang_pred"] == labels[i] for i in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_id_awkward_rows(spark, nothing):
    train = docs_of(spark, [(i, t, lang, "s", 0) for i, (lang, t) in enumerate(
        [("en", "the cat and the dog"), ("de", "der hund und die katze"), (None, "nichts"), ("fr", None)] * 5)])
    model = language_id.train(train, F.lit(True))
    assert model.languages == ["de", "en"]
    assert model.predict("The dog")[0] == "en" and model.predict("UND der")[0] == "de"
    assert model.predict("katzen")[0] == "de"  # unknown: from its n-grams
    for t in (None, "", " 12 !?", "\u00b2"):
        assert model.predict(t) == ("und", 0.0)
    assert model.predict("\u65e5\u672c") == ("de", 0.5)
    empty = language_id.train(nothing, F.lit(True))
    assert empty.languages == [] and empty.predict("text") == ("und", 0.0)
    out = train.select(language_id.predictor(train, model)("text").alias("p"))
    assert out.where("p.lang = 'und'").count() == 5


def test_language_id_equals_a_plain_backoff(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.train(docs, ~queries.held_out())
    data = table("documents", "doc_id", "text", "lang")
    counts = {}  # language, length (0: words) -> gram -> count
    for d, t, lang in data:
        if t is not None and lang is not None and zlib.crc32(str(d).encode()) % 3 != 1:
            for w, c in Counter(language_id.WORD.findall(t.lower())).items():
                counts.setdefault((lang, 0), Counter())[w] += c
                for n in range(1, 5):
                    for g in [f" {w} "[i:i + n] for i in range(len(w) + 3 - n)] if n > 1 else w:
                        counts.setdefault((lang, n), Counter())[g] += c
    languages = sorted({k for k, _ in counts})

    def frequency(n, g):
        return np.array([np.log(counts[k, n][g] + 0.5) - np.log(sum(counts[k, n].values()) + 0.5 * (len(counts[k, n]) + 1))
                         for k in languages])
    for d, t, _ in data[:25]:
        total = np.zeros(len(languages))
        for w in language_id.WORD.findall((t or "").lower())[:40]:
            for n in (0, 4, 3, 2, 1):
                known = [g for g in ([w] if n == 0 else language_id.grams(w, n)) if any(counts[k, n][g] for k in languages)]
                if known:
                    total += np.mean([frequency(n, g) for g in known], axis=0)
                    break
        short = " ".join(language_id.WORD.findall((t or "").lower())[:40])
        lang, score = model.predict(short)
        if short:
            assert lang == languages[int(total.argmax())]
            assert score == pytest.approx(1 / np.exp(total - total.max()).sum())


def test_language_id_keeps_a_rare_language(spark):
    common = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}x" for i in range(500))
    docs = [(i, common, "big", "s", 0) for i in range(300)] + [(1000 + i, "zanu kofi bere", "rare", "s", 0) for i in range(2)]
    model = language_id.train(docs_of(spark, docs), F.lit(True), sample_docs=20, max_words=100)
    assert model.languages == ["big", "rare"]
    assert model.predict("kofi zanu")[0] == "rare"



# 4 token files

def test_token_files_equal_the_library(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json"))
    want, start = [], 0
    for d, text in sorted(table("documents", "doc_id", "text")):
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(rows(queries.op4_token_files(spark, SF), "doc_id", "start", "n_tokens", "ids_crc32")) == want


def test_token_files_awkward_rows(spark, awkward, nothing, monkeypatch):
    path = queries.tokenizer_path("word_bpe_49k.json")
    uri = stage_path(spark, "test-files")
    m = elias_fano.write_files(awkward, path, 1, uri=uri)
    got = rows(elias_fano.read_files(m, uri, lambda d, s, ids: (d, s, ids.tolist()), "doc_id long, start long, ids array<int>"), "doc_id", "start", "ids")
    got.sort(key=lambda r: r[1])
    assert [r[0] for r in got] == [None, 1, 2, 3, 4, 4, 5, 7, 8]
    assert got[1][2] == got[2][2] == got[3][2] == [1] and got[4][2] == got[5][2]
    assert [r[1] for r in got] == np.cumsum([0] + [len(r[2]) for r in got])[:-1].tolist()
    assert elias_fano.read_files(elias_fano.write_files(nothing, path, 1, uri=uri), uri, lambda d, s, i: (d, s), "doc_id long, start long").count() == 0


# 5 byte-level BPE is tested in test_llm_units; here the digests

def test_bpe_digests(spark):
    import base64

    import tiktoken
    from public_tokenizers import PATTERN
    with open(queries.tokenizer_path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    e = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for d, text in sorted(table("documents", "doc_id", "text")):
        ids = e.encode_ordinary(text or "")
        want.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(rows(queries.op5_byte_bpe(spark, SF), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")) == want


# 6 packing

def check_packing(packed, capacity, documents, tokenizer):
    at, size = {}, Counter()
    for d, piece, start, length, crc, seq, offset in packed:
        at.setdefault(seq, []).append((offset, offset + length))
        size[d] += length
    for parts in at.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a[1] == b[0] for a, b in zip(parts, parts[1:])) and parts[-1][1] <= capacity
    want = Counter()
    for d, text in documents:
        want[d] += len(tokenizer.encode(text or "", add_special_tokens=False).ids) + 1
    assert size == want
    return len(at)


def test_packing_is_whole_and_tight(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    packed = rows(queries.op6_best_fit(spark, SF), "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    documents = table("documents", "doc_id", "text")
    used = check_packing(packed, 2048, documents, t)
    assert used <= -(-sum(r[3] for r in packed) // 2048) + 1
    texts = dict(documents)
    for d, piece, start, length, crc, _, _ in packed:
        ids = t.encode(texts[d], add_special_tokens=False).ids + [0]
        assert zlib.crc32(np.array(ids[start:start + length], "<u4").tobytes()) == crc
        assert length == 2048 or start == 0


def test_packing_awkward_rows(spark, awkward, nothing):
    from tokenizers import Tokenizer
    path = queries.tokenizer_path("byte_bpe_50k.json")
    packed = rows(best_fit.pack(awkward, path, capacity=64, with_ids=True), "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    check_packing(packed, 64, [r[:2] for r in AWKWARD], Tokenizer.from_file(path))
    assert Counter(r[0] for r in packed)[4] == 2 and min(r[3] for r in packed) == 1
    assert best_fit.pack(nothing, path).count() == 0


# 7 HTML

PAGES = "page_id long, url string, html string, text string, _host string, blocks string"


def pages_of(spark, data):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in data], PAGES)


def test_html_removes_recurring_subtrees(spark):
    def page(i, note="<div><p>Read our guide first.</p></div>"):
        return f"<body><div><ul><li>Home</li><li>Shop</li></ul></div><div><p>Story {i} is told.</p>{note}</div></body>"
    data = [(i, f"http://one.example/{i}", page(i)) for i in range(8)] + [(100, "http://two.example/1", page(100))]
    data += [(200 + i, f"http://three.example/{i}", page(0)) for i in range(30)]  # copies of one page are no template
    got = {r["page_id"]: r["text"] for r in html_text.main_text(pages_of(spark, data)).collect()}
    assert all(got[i] == f"Story {i} is told." for i in range(8))
    assert got[100] == "Home Shop Story 100 is told. Read our guide first."
    assert all(got[200 + i] == got[100].replace("100", "0") for i in range(30))


def test_html_keeps_a_passage_that_articles_share(spark):
    data = [(i, f"http://one.example/{i}", f"<article><p>Same passage.</p><div>Sign up</div><p>Own {i}.</p></article>") for i in range(9)]
    assert sorted(rows(html_text.main_text(pages_of(spark, data)), "text")) == [(f"Same passage. Own {i}.",) for i in range(9)]


def test_html_awkward_rows(spark):
    data = [(1, None, None), (2, "nonsense", ""), (3, "http://h/", "<p>" + "x " * 200_000), (3, "http://h/", "<p>t"), (None, "http://h/", "<p>t")]
    got = Counter((r["page_id"], len(r["text"])) for r in html_text.main_text(pages_of(spark, data)).collect())
    assert got == {(1, 0): 1, (2, 0): 1, (3, 399_999): 1, (3, 1): 1, (None, 1): 1}
    assert html_text.main_text(pages_of(spark, [])).count() == 0


def test_html_equals_a_plain_reading_of_the_test_pages(spark):
    import html
    want = []
    for page, source in table("pages", "page_id", "html"):
        inner = re.search(r"<article>(.*?)</article>", source, re.S)[1].replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        want.append((page, " ".join(filter(None, parts))))
    got = queries.op7_html_text(spark, SF)
    assert sorted(rows(got, "page_id", "text")) == sorted(want)
    assert got.where("n_chars <> length(text)").count() == 0


# 8 personal data

def test_pii_query(spark):
    from test_llm_units import base_spans
    want = []
    for d, text in table("documents", "doc_id", "text"):
        spans = base_spans(text or "")
        n = Counter(s[0] for s in spans)
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        want.append((d, *(n[k] for k in pii.KINDS), hashlib.sha256(written.encode()).hexdigest()))
    got = queries.op8_pii(spark, SF)
    assert sorted(rows(got, "doc_id", *(f"n_{k}" for k in pii.KINDS), "base_sha256")) == sorted(want)


# 9 url rules

def test_url_rules_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(url_rules, "RANGE_ROWS", 3)
    data = [(i, u, "") for i, u in enumerate(
        [None, "", "no scheme", "http://", "://a", "HTTP://WWW.Example.com/en/x?y#z", "http://example.com", "http://b.net/fr/", "x://y://z.com/a"]
        + ["http://hot.example.com/en/1"] * 200 + [f"http://h{i}.net/es/{i}" for i in range(50)])]
    pages = pages_of(spark, data + [(None, "http://b.com/", "")])
    rules = spark.createDataFrame(queries.URL_RULES + [("com", None, "block")], "host string, path string, verdict string")
    got = url_rules.judge(pages, rules).collect()
    assert len(got) == len(data) + 1
    by_id = {r["page_id"]: tuple(r)[1:] for r in got}
    assert [by_id[i] for i in range(9)] == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("a", "", None, "allow"),
        ("www.example.com", "/en/x", "www.example.com/en/", "allow"), ("example.com", "", None, "allow"), ("b.net", "/fr/", "net/fr/", "block"),
        ("y:", "//z.com/a", None, "allow")]
    assert by_id[9] == ("hot.example.com", "/en/1", "example.com/en/", "block") and by_id[None] == ("b.com", "/", "com/", "allow")
    assert Counter(r["verdict"] for r in got)["block"] == 251
    assert {r["verdict"] for r in url_rules.judge(pages, rules.limit(0), default="block").collect()} == {"block"}
    assert url_rules.judge(pages_of(spark, []), rules).count() == 0


# 10 SimHash

def brute_components(fps):
    at = {i: i for i, _ in fps}

    def root(i):
        while at[i] != i:
            i = at[i]
        return i
    for i, a in fps:
        for j, b in fps:
            if i < j and (a ^ b).bit_count() <= 4:
                x, y = root(i), root(j)
                at[max(x, y)] = min(x, y)
    return {i: root(i) for i, _ in fps}


def test_simhash_equals_brute_force(spark):
    fps = [(d, simhash.fingerprint(t)) for d, t in table("documents", "doc_id", "text")]
    of = brute_components(fps)
    want = sorted((d, f"{f:016x}", of[d]) for d, f in fps)
    assert sorted(rows(queries.op10_simhash(spark, SF), "doc_id", "fingerprint", "component_id")) == want


def test_simhash_links_across_split_lists(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 4)
    rng = np.random.default_rng(9)
    centre = [int(x) for x in rng.integers(0, 2**63, 5)]
    fps = sorted({c ^ sum(1 << int(b) for b in rng.integers(0, 64, 3)) for c in centre for _ in range(25)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long").cache())
    got = {r["node"]: r["label"] for r in simhash.components(edges).collect()}
    of = brute_components(list(zip(signed, fps)))
    assert {f: got.get(f, f) for f in signed} == of
    with pytest.raises(ValueError):
        simhash.links(edges, 5)


def test_simhash_awkward_rows(spark, awkward, nothing):
    got = sorted((r["doc_id"] or 0, r["component_id"], r["fingerprint"]) for r in simhash.near_duplicates(awkward).collect())
    assert [g[:2] for g in got] == [(0, None), (1, 1), (2, 1), (3, 1), (4, 4), (4, 4), (5, 4), (7, 7), (8, 8)]
    assert got[1][2] == "0" * 16
    assert simhash.near_duplicates(nothing).count() == 0


# the pipeline

def test_pipeline_stages_handle_awkward_rows(spark, awkward, nothing):
    text = " ".join(f"Word{i} here" for i in range(60))
    docs = awkward.union(docs_of(spark, [(20, text, "en", "s", 9), (20, text, "en", "s", 9), (21, text + " a@b.cd", "en", "s", 9)]))
    for data, least in ((docs, 1), (nothing, 0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, data, SF)
            assert out.columns == data.columns, name
            assert out.count() >= least, name
        assert corpus_pipeline.STAGES[-1][1](spark, data, SF).count() >= least
    deduped = corpus_pipeline.near_duplicate_stage(spark, docs, SF)
    ids = sorted((r["doc_id"] for r in deduped.collect()), key=lambda d: (d is None, d))
    assert ids in ([1, 4, 7, 8, 20, None], [1, 4, 7, 8, 20, 21, None])
    assert corpus_pipeline.private_data_stage(spark, docs, SF).where("text like '%@%'").count() == 0


def test_pipeline_stages_leave_columns_of_clashing_names_alone(spark):
    good = " ".join(f"word{i} the" for i in range(60))
    columns = ["doc_id", "text", "lang", "source", "kept", "host_rate", "_p", "p", "doc", "_n", "_fp", "none", "id", "row", "alike", "label", "n_words"]
    rows_in = [(1, good, "en", "s", *[f"{c}!" for c in columns[4:]]), (2, "totally " + good[::-1], "en", "s", *[f"{c}?" for c in columns[4:]])]
    docs = spark.createDataFrame(rows_in, columns)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == columns, name
        assert sorted(map(tuple, out.collect())) == rows_in, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 2


def test_pipeline_drops_what_a_stage_rejects(spark):
    out = corpus_pipeline.run(spark, SF)
    documents = {d: t for d, t in table("documents", "doc_id", "text")}
    packed = {r["doc_id"] for r in out.select("doc_id").distinct().collect()}
    kept = {r["doc_id"] for r in queries.op1_quality_rules(spark, SF).where("kept").collect()}
    assert packed <= kept
    of = brute_components([(d, simhash.fingerprint(documents[d])) for d in kept])
    assert packed == {d for d in kept if of[d] == d}


def test_pipeline_keeps_a_row_of_each_group(spark):
    def text(seed):
        rng = np.random.default_rng(seed)
        return " ".join(f"w{i}" for i in rng.integers(0, 10_000, 200))
    a, b, c, d = map(text, range(4))
    near = b + " end"
    assert 0 < (simhash.fingerprint(b) ^ simhash.fingerprint(near)).bit_count() <= 4
    docs = docs_of(spark, [(None, c, "en", "s", 0), (None, c, "en", "s", 0), (None, d, "en", "s", 0), (5, a, "en", "s", 0),
                           (5, near, "en", "s", 0), (3, b, "en", "s", 0)])
    assert Counter(rows(corpus_pipeline.near_duplicate_stage(spark, docs, SF), "doc_id", "text")) == Counter(
        [(None, c), (None, d), (5, a), (3, b)])
    docs = docs_of(spark, [(5, a, "en", "s", 0), (5, b, "en", "s", 0), (9, near, "en", "s", 0)])
    kept = Counter(rows(corpus_pipeline.near_duplicate_stage(spark, docs, SF), "doc_id", "text"))
    assert kept == Counter([(5, a), (5, b)])
