"""The operators' cores against brute force, without Spark."""
import base64
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfcast.llm import best_fit, byte_bpe, elias_fano, html_text, pii, simhash, top_k, url_rules
from shelfcast.llm.queries import tokenizer_path
from shelfcast.llm.tokens import ChunkTokenizer

ODD = ["", " ", "\n\n", "a", "don't  stop\t now", "x  y", "été́ naïve, l'été.", "a,b.c , d", "日本語 テキスト",
       "tab\t b\t\t c", "\xa0nbsp　wide", "😀😀 emoji😀", "x" * 3000, "1234 5678,90", "A'S 'll we'll", "end \n", "\x1c\x1d z",
       "<|endoftext|> <|startoftext|>", "İstanbul ΣΑΣ", ", ́x", "a ́b"]
TEXTS = st.text(alphabet=st.sampled_from("abcéß ,.\n\t'19sltd́\xa0日😀-<|"), max_size=60) | st.lists(
    st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|", " a word", "\n", "|>", "endoftext"]), max_size=8).map("".join)


@pytest.fixture(scope="module")
def bpe():
    from public_tokenizers import PATTERN
    return byte_bpe.ByteBPE(tokenizer_path("byte_bpe_50k.tiktoken"), PATTERN)


@pytest.fixture(scope="module")
def tiktoken_bpe():
    import tiktoken
    from public_tokenizers import PATTERN
    with open(tokenizer_path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library_and_round_trips(bpe, tiktoken_bpe):
    rnd = random.Random(5)
    texts = ODD + ["".join(rnd.choice("aeiou thnr") for _ in range(rnd.randrange(1, 400))) for _ in range(200)]
    texts += ["".join(chr(rnd.randrange(32, 0x2FFF)) for _ in range(50)) for _ in range(100)]
    for t, ids in zip(texts, bpe.encode_batch(texts)):
        assert ids == tiktoken_bpe.encode_ordinary(t), t
        assert bpe.decode(ids) == t.encode()
    assert bpe.encode_batch([None]) == [[]]


def test_bpe_heap_and_matrix_agree(bpe):
    rnd = random.Random(6)
    pieces = ["".join(rnd.choice("abcdeth") for _ in range(n)).encode() for n in (2, 3, 17, 63, 200, 900, 2000) for _ in range(4)]
    assert bpe.merge(pieces) == [bpe._by_heap(p) if p not in bpe.ranks else [bpe.ranks[p]] for p in pieces]


def test_very_long_piece(bpe, tiktoken_bpe):
    t = "ab" * 4000
    assert bpe.encode_batch([t])[0] == tiktoken_bpe.encode_ordinary(t)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_chunked_tokenizer_equals_whole_texts(name):
    from tokenizers import Tokenizer
    t, library = ChunkTokenizer(tokenizer_path(name)), Tokenizer.from_file(tokenizer_path(name))

    @settings(max_examples=300, deadline=None)
    @given(TEXTS)
    def same(text):
        assert np.frombuffer(t.encode([text])[0], t.dtype).tolist() == library.encode(text, add_special_tokens=False).ids
    same()
    for text in ODD:
        assert np.frombuffer(t.encode([text])[0], t.dtype).tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert t.encode([None, ""]) == [b"", b""]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=300))
def test_elias_fano_round_trip(steps):
    values = np.cumsum(steps, dtype=np.int64)
    e = elias_fano.EliasFano.of(values, int(values[-1]) + 1 if len(values) else 1)
    assert e.all().tolist() == values.tolist()
    assert [e.select(i) for i in range(len(values))] == values.tolist()
    for a in range(0, len(values) + 1, 37):
        for b in range(a, len(values) + 1, 41):
            assert e.select_range(a, b).tolist() == values[a:b].tolist()
    with pytest.raises(IndexError):
        e.select(len(values))


def test_elias_fano_is_near_minimal():
    values = np.cumsum(np.random.default_rng(1).integers(1, 2000, 20_000))
    e = elias_fano.EliasFano.of(values, int(values[-1]) + 1)
    bits = 8 * (len(e.low) + len(e.high) + 4 * len(e.directory)) / len(values)
    assert bits < 2 + np.log2(values[-1] / len(values)) + 1


def test_token_file_random_access():
    ids = [[5, 1], [1], [7, 8, 9, 1]]
    f = elias_fano.TokenFile(elias_fano.file_bytes([3, None, 9], [np.array(x, "<u2").tobytes() for x in ids], 2))
    assert [f.ids(i).tolist() for i in range(3)] == ids
    assert f.nulls.tolist() == [0, 1, 0] and f.doc_ids.tolist() == [3, 0, 9]
    with pytest.raises(ValueError):
        elias_fano.TokenFile(bytes(64))


def best_fit_one_by_one(lengths, capacity):
    rooms = []
    for x in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= x]
        if fits:
            i = min(fits, key=lambda i: rooms[i])
            rooms[i] -= x
        else:
            rooms.append(capacity - x)
    return sorted(rooms)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=120))
def test_plan_is_best_fit_decreasing(lengths):
    histogram = {x: lengths.count(x) for x in lengths}
    slots = best_fit.plan(histogram, 50)
    used, ranks = {}, {x: set() for x in histogram}
    for s in slots:
        for at in range(s.count):
            ranks[s.length].add(s.first + at)
            start = s.offset + at % s.per * s.length
            used.setdefault(s.sequence + at // s.per, []).append((start, start + s.length))
    assert all(r == set(range(histogram[x])) for x, r in ranks.items())
    for parts in used.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a[1] == b[0] for a, b in zip(parts, parts[1:])) and parts[-1][1] <= 50
    assert sorted(50 - max(e for _, e in p) for p in used.values()) == best_fit_one_by_one(lengths, 50)


def test_plan_does_not_grow_with_the_counts():
    small = best_fit.plan({x: 7 for x in range(1, 2049)}, 2048)
    large = best_fit.plan({x: 7_000_000 for x in range(1, 2049)}, 2048)
    assert len(large) < 3 * len(small) + 100
    with pytest.raises(ValueError):
        best_fit.plan({2049: 1}, 2048)


def test_triples_cover_every_four_positions():
    from itertools import combinations
    t = simhash.triples()
    assert len(t) == 20
    assert all(any(set(x) <= set(four) for x in t) for four in combinations(range(8), 4))


def test_fingerprint_by_hand():
    import xxhash
    text = "The  cat\tsat on THE mat the cat sat on"
    w = text.lower().split()
    hs = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]), 42) for i in range(len(w) - 3)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
    assert simhash.fingerprint(text) == want
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n\x0b") == 0
    assert simhash.fingerprint("Two words") == xxhash.xxh64_intdigest("two words", 42)
    assert simhash.fingerprint("ÀB") == xxhash.xxh64_intdigest("Àb".encode(), 42)  # only A-Z are lowered


def test_forest_connects_what_links_connect():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**62, 6)
    fps = np.unique([int(b) ^ sum(1 << int(x) for x in rng.integers(0, 62, 3)) for b in base for _ in range(20)]).astype(np.int64)
    edges = simhash.forest(fps, np.zeros(len(fps)), False, 4)
    assert len(edges) < len(fps)

    def classes(pairs):
        at = {int(f): int(f) for f in fps}

        def root(x):
            while at[x] != x:
                x = at[x]
            return x
        for a, b in pairs:
            a, b = root(int(a)), root(int(b))
            at[max(a, b)] = min(a, b)
        return [root(int(f)) for f in fps]
    every = [(a, b) for a in fps for b in fps if bin(int(a) ^ int(b)).count("1") <= 4]
    assert classes(edges) == classes(every)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 12), st.integers(1, 30), st.integers(1, 5), st.integers(0, 10**6), st.sampled_from(["float64", "int64", "object"]))
def test_tile_selection_equals_sorting(n_queries, n, k, seed, kind):
    rng = np.random.default_rng(seed)
    scores = rng.integers(-3, 4, (n_queries, n)).astype(kind)
    ids, qids = np.sort(rng.choice(60, n, replace=False)), rng.choice(60, n_queries, replace=False)
    q, v, s = top_k._select(scores, qids, ids, k)
    got = sorted(zip(q.tolist(), (-s).tolist(), v.tolist()))
    want = sorted(x for i, qi in enumerate(qids.tolist()) for x in sorted(
        (qi, -int(scores[i, j]), v) for j, v in enumerate(ids.tolist()) if v != qi)[:k])
    assert got == want


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        pattern = pattern.replace(r"[\x20-]", "[ -]")
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and sum(
                    sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab.@-+ 0123456789()é\n"), max_size=80))
def test_base_spans_equal_the_patterns(text):
    assert pii.spans_of(text) == base_spans(text)
    base, spans = pii.detect(text)
    assert base == base_spans(text) and set(base) <= set(spans)


@pytest.mark.parametrize("text, kind, found", [
    ("write to john.doe [at] example [dot] com now", "email", "john.doe [at] example [dot] com"),
    ("write to john.doe(at)example.com now", "email", "john.doe(at)example.com"),
    ("mail jane at example dot com please", "email", "jane at example dot com"),
    ("mail jane at mail dot example dot org please", "email", "jane at mail dot example dot org"),
    ("mail jаne@exаmple.com please", "email", "jаne@exаmple.com"),  # Cyrillic a
    ("mail jane＠example．com please", "email", "jane＠example．com"),
    ("mail ja​ne@example.com please", "email", "ja​ne@example.com"),
    ("call plus four four seven seven zero zero nine zero zero one two three now", "phone",
     "plus four four seven seven zero zero nine zero zero one two three"),
    ("call +1 five five five two three four five six seven eight ok", "phone", "+1 five five five two three four five six seven eight"),
    ("call +１ (555) ５５５-01234 ok", "phone", "+１ (555) ５５５-01234"),
    ("host 192 dot 168 dot 0 dot 17 is up", "ip", "192 dot 168 dot 0 dot 17"),
    ("host one nine two dot one six eight dot zero zero one dot one zero zero up", "ip",
     "one nine two dot one six eight dot zero zero one dot one zero zero"),
    ("host one zero dot zero dot zero dot one up", "ip", "one zero dot zero dot zero dot one"),
    ("host 10[.]0[.]0[.]1 is up", "ip", "10[.]0[.]0[.]1"),
    ("card four one one one one one one one one one one one one one one one end", "card",
     "four one one one one one one one one one one one one one one one"),
    ("card 4111–1111–1111–1111 end", "card", "4111–1111–1111–1111"),
])
def test_disguises_are_found_at_their_source(text, kind, found):
    base, spans = pii.detect(text)
    at = text.index(found)
    assert (kind, at, at + len(found)) in spans and (kind, at, at + len(found)) not in base


@pytest.mark.parametrize("text", [
    "look at me dot", "meet me at example.com", "one two three go", "a un deux trois de la", "At noon point taken",
    "plus one for the team", "la uno dos tres cuatro", "Ελλάδα и Россия", "it is zero. nine people at home dot dot dot"])
def test_plain_text_stays_clean(text):
    assert pii.detect(text) == ([], [])


@pytest.mark.parametrize("text, kind, found", [
    ("mail jane@example dot com please", "email", "jane@example dot com"),
    ("mail john dot doe@example.com", "email", "john dot doe@example.com"),
    ("mail jane  at\nexample \tdot com now", "email", "jane  at\nexample \tdot com"),
    ("mail jane (  at ) example [\ndot\n] com now", "email", "jane (  at ) example [\ndot\n] com"),
    ("host 10 dot  one dot zero\ndot 7 up", "ip", "10 dot  one dot zero\ndot 7"),
])
def test_spelled_dots_beside_a_literal_at_and_runs_of_space(text, kind, found):
    at = text.index(found)
    assert (kind, at, at + len(found)) in pii.detect(text)[1]


SAID = st.tuples(st.sampled_from(["jane", "10", "one", "plus", ""]), st.sampled_from([" dot ", "@", " at ", "[at]", ".", "  dot\n", " ", "@ "]))


@settings(max_examples=500, deadline=None)
@given(st.lists(SAID.map("".join), min_size=1, max_size=6).map(lambda t: "".join(t) + "com"))
def test_unrelated_characters_change_no_span(text):
    assert pii.detect(text) == pii.detect(text + " ; \u2013")


def test_long_runs_take_linear_time():
    for t in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 100_000, "+1" * 100_000, "one " * 60_000, "( at " * 50_000):
        pii.detect(t)


def test_masking_merges_overlaps():
    text = "+4111111111111111 x a@b.c"
    assert pii.masked(text, pii.detect(text)[1]).endswith(" x <email>")
    assert pii.masked("", []) == ""
    assert pii.masked("abcdef", [("ip", 1, 3), ("card", 2, 5)]) == "a<ip>f"


def text_of(html):
    return " ".join(s for s, _ in html_text.blocks(html)[0])


def test_html_keeps_the_article_alone():
    assert text_of('<html><head><title>T</title></head><body><nav>n</nav><article><h1>A &amp; B</h1><p><b>one<br>two\n  <p>th<i>re</i>e'
                   '<script>"</p>"</script><aside>x</aside><div class="comments"><p>c</div></article><footer>f</footer>') == "A & B one two three"
    assert text_of("<body><div class='cookie-notice'>c</div><p>t</p><form><p>f</p></form></body>") == "t"
    assert text_of("<div class='with-sidebar'><main><p>m</p></main><div id=sidebar>s</div></div>") == "m"
    assert text_of(None) == text_of("") == text_of("<script>x") == ""
    assert text_of("plain &lt;text") == "plain <text"
    assert text_of("<div>" * 5000 + "deep") == "deep"


@pytest.mark.parametrize("part", ["<h2 id='related-work'>k</h2>", "<p id='notice-period'>k</p>", "<section id='search'><p>k</p></section>",
                                  "<div class='share-price'>k</div>", "<p class='notice'>k</p>"])
def test_html_keeps_parts_of_an_article_with_telling_names(part):
    assert text_of(f"<article><p>a long first part</p>{part}<p>b</p></article>") == "a long first part k b"


@pytest.mark.parametrize("wrapper", ["class='no-sidebar'", "class='has-header'", "id='page' class='with-menu'", "class='header'"])
def test_html_keeps_a_wrapper_of_the_text(wrapper):
    assert text_of(f"<body><div {wrapper}><p>the whole text</p><div class='cookie-notice'>c</div></div></body>") == "the whole text"


@pytest.mark.parametrize("extra", ["<section class='comments'><article class='comment'><p>a reply longer than the story</p></article></section>",
                                   "<aside><article>teaser</article></aside>", "<nav><article>teaser</article></nav>",
                                   "<article class='comment'>c</article>", "<div id='comment-list'><article>c</article></div>"])
def test_html_does_not_keep_comments_and_teasers_as_articles(extra):
    assert text_of(f"<body><article><p>story</p></article>{extra}</body>") == "story"
    assert text_of(f"<body><article><p>story</p>{extra}</article></body>") == "story"


def test_html_hashes_only_what_may_be_a_template():
    plain, _ = html_text.blocks("<article><p>a</p><div><p>b</p></div><p class=x>c</p></article>")
    assert [(s, len(h)) for s, h in plain] == [("a", 0), ("b", 1), ("c", 1)]
    no_article, _ = html_text.blocks("<body><p>a</p><div><p>b</p></div></body>")
    assert [(s, len(h)) for s, h in no_article] == [("a", 1), ("b", 2)]


def fits(rule, host, path):
    return (host == rule[0] or host.endswith("." + rule[0])) and path.startswith(rule[1])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from(["a", "b", "", "a\x00", "ab"]), min_size=1, max_size=3).map(".".join),
                          st.sampled_from(["", "/", "/x", "/x/", "/y"]), st.sampled_from(["allow", "block"])), max_size=12),
       st.lists(st.tuples(st.lists(st.sampled_from(["a", "b", "", "c", "ab"]), min_size=1, max_size=4).map(".".join),
                          st.sampled_from(["", "/", "/x", "/x/z", "/yy"])), max_size=12))
def test_sweep_equals_brute_force(rules, urls):
    for (host, path), got in zip(urls, url_rules.sweep(rules, urls)):
        fit = [r for r in rules if fits(r, host, path)]
        longest = max((len(r[0] + r[1]) for r in fit), default=None)
        want = {(r[0] + r[1]) for r in fit if len(r[0] + r[1]) == longest}
        assert (got is None) == (not fit) and (got is None or got[0] in want)
