"""Spelling variants by finite-state composition.

Two words are near if they differ by exactly one inserted, deleted or replaced code
point: if the composition of the vocabulary's acceptor, a one-edit transducer and the
acceptor again accepts them. The composition is enumerated by partitions of initial
states. Words that are near share, around the edit, the first or the last half of the
shorter one (halves rounded down), so each word goes to the partitions named by its
fixed beginning or end of that length: the state that the acceptor (of the words, or
of the words reversed) has reached there without an edit. In a partition, the words'
free middles make a minimised acceptor of their own, and the pairs that its
composition accepts from there are enumerated. Every pair appears in at least one
partition; pairs are made distinct afterwards.

A partition of more than ``LARGE`` words is entered further: its middles are halved
in the same way and its words go to the partitions of the longer beginnings and ends.
That ends by itself, as partitions of middles of up to two code points hold no more
words than the alphabet has pairs. So no task holds a group that grows with the
vocabulary, and no pair is lost. Words are counted in the workers and by Spark's
aggregation before anything is paired.

A word's form is its near word of largest count (ties: the smallest in code point
order) if that count is at least ``ratio`` times its own; its root follows forms to
the last. Counts at least double on the way, so roots are found by pointer jumping in
as many rounds as the logarithm of the logarithm of the largest count.

Defined results: a null text and one without a run have no word; a null doc_id counts
as an empty one; repeated rows count as often as they occur; an empty table gives an
empty result. Only the named columns are read.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stages

RUN = re.compile("[a-zÀ-ÿ]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
LARGE = 20_000
HELD = 200_000  # words that a worker counts before it hands them on


def vocabulary(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = 5, min_count: int = 3,
               respell: Callable[[str, str], str] | None = None) -> DataFrame:
    """(word, n): the lower-cased runs of letters of at least ``min_chars`` code points
    that occur ``min_count`` times. ``respell(doc_id, run)`` may give another spelling,
    no longer than the run."""
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        for pdf in batches:
            for ident, t in zip(pdf["doc_id"], pdf["text"]):
                runs = Counter(r for r in RUN.findall(t.encode().translate(LOWER).decode()) if len(r) >= min_chars)
                if respell:
                    for r, c in runs.items():
                        held[respell(ident, r)] += c
                else:
                    held.update(runs)
                if len(held) > HELD:
                    yield _table(held)
                    held.clear()
        yield _table(held)
    rows = docs.where(F.col(text).isNotNull()).select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc_id"), F.col(text).alias("text"))
    return (rows.mapInPandas(counted, "word string, n bigint").where(F.length("word") >= min_chars)
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def _table(held: Counter) -> pd.DataFrame:
    return pd.DataFrame({"word": pd.Series(list(held), dtype=object), "n": pd.Series(list(held.values()), dtype="int64")})


# partitions

def _halves(word, before, after):
    """Keys of the partitions that hold a word: its middle (the code points from ``before``
    on without the last ``after``) is halved, for itself as the shorter or longer word."""
    size = F.length(word) - before - after
    whole = F.length(word)
    keys = []
    for half in (F.floor(size / 2), F.floor((size - 1) / 2)):
        half = F.greatest(half, F.lit(0)).cast("int")
        keys += [F.struct((before + half).alias("before"), after.alias("after"), half.alias("least")),
                 F.struct(before.alias("before"), (after + half).alias("after"), half.alias("least"))]
    return F.transform(F.array_distinct(F.array(*keys)), lambda k: F.struct(
        F.substring(word, F.lit(1), k["before"]).alias("head"),
        F.substring(word, whole - k["after"] + 1, k["after"]).alias("tail"), k["least"].alias("least")))


def partitions(words: DataFrame, stages: Stages, large: int = LARGE) -> DataFrame:
    """(head, tail, least, word, n): every word in its partitions."""
    key = ["head", "tail", "least"]
    zero = F.lit(0)
    new = words.withColumn("k", F.explode(_halves(F.col("word"), zero, zero))).select("k.*", "word", "n")
    done = []
    while True:
        sizes = new.groupBy(*key).agg(F.count("*").alias("size"))
        hot = stages.written(sizes.where((F.col("size") > large) & (F.col("least") > 0)), "spelling-large")
        if hot.isEmpty():
            return _union([*done, new])
        new = stages.written(new, "spelling-placed")
        done.append(new.join(hot.select(*key), key, "left_anti"))
        inside = new.join(hot.select(*key), key)
        new = (inside.withColumn("k", F.explode(_halves(F.col("word"), F.length("head"), F.length("tail"))))
               .select("k.*", "word", "n").distinct())


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# the minimised acceptor of a partition and its composition

class Acceptor:
    """The minimal deterministic acceptor of words added in code point order.

    ``arcs[s]`` maps a code point to the next state, ``final[s]`` tells whether a word
    ends there, bit i of ``lengths[s]`` whether a word of i more code points can."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self.lengths: list[int] = []
        known: dict = {}
        open_nodes: list[tuple[dict, bool]] = [({}, False)]
        last = ""

        def close(depth):
            while len(open_nodes) > depth + 1:
                arcs, final = open_nodes.pop()
                open_nodes[-1][0][last[len(open_nodes) - 1]] = self._state(known, arcs, final)
        for w in words:
            same = 0
            for a, b in zip(last, w):
                if a != b:
                    break
                same += 1
            close(same)
            open_nodes += [({}, False) for _ in range(len(w) - same)]
            open_nodes[-1] = (open_nodes[-1][0], True)
            last = w
        close(0)
        self.root = self._state(known, *open_nodes[0])

    def _state(self, known: dict, arcs: dict, final: bool) -> int:
        key = (final, tuple(arcs.items()))
        s = known.get(key)
        if s is None:
            s = known[key] = len(self.arcs)
            lengths = int(final)
            for t in arcs.values():
                lengths |= self.lengths[t] << 1
            self.arcs.append(arcs)
            self.final.append(final)
            self.lengths.append(lengths)
        return s

    def near_pairs(self) -> Iterator[tuple[str, str]]:
        """Pairs that the composition with one edit and this acceptor accepts, each at
        least once and one way round."""
        arcs, lengths = self.arcs, self.lengths
        unedited = [(self.root, "")]
        while unedited:
            s, x = unedited.pop()
            out = list(arcs[s].items())
            for i, (c, t) in enumerate(out):
                if lengths[t] & lengths[s]:
                    yield from self._equal(t, s, x + c, x)
                for d, u in out[i + 1:]:
                    if lengths[t] & lengths[u]:
                        yield from self._equal(t, u, x + c, x + d)
                unedited.append((t, x + c))

    def _equal(self, s: int, t: int, x: str, y: str) -> Iterator[tuple[str, str]]:
        arcs, final, lengths = self.arcs, self.final, self.lengths
        todo = [(s, t, x, y)]
        while todo:
            s, t, x, y = todo.pop()
            if final[s] and final[t]:
                yield x, y
            other = arcs[t]
            for c, u in arcs[s].items():
                v = other.get(c)
                if v is not None and lengths[u] & lengths[v]:
                    todo.append((u, v, x + c, y + c))


def _paired(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by partition -> (a, na, b, nb), a before b."""
    key, members, out = None, {}, []

    def close():
        if len(members) > 1:
            head, tail, _ = key
            ends = len(tail)
            middles = {w[len(head):len(w) - ends]: w for w in members}
            found = {(min(p), max(p)) for p in ((middles[x], middles[y]) for x, y in Acceptor(sorted(middles)).near_pairs())}
            out.extend((a, members[a], b, members[b]) for a, b in found)
    for pdf in batches:
        for head, tail, least, word, n in zip(pdf["head"], pdf["tail"], pdf["least"], pdf["word"], pdf["n"]):
            if key != (head, tail, least):
                close()
                key, members = (head, tail, least), {}
            members[word] = n
            if len(out) > 50_000:
                yield pd.DataFrame(out, columns=["a", "na", "b", "nb"])
                out = []
    close()
    yield pd.DataFrame(out, columns=["a", "na", "b", "nb"])


def near_pairs(words: DataFrame, stages: Stages, large: int = LARGE) -> DataFrame:
    """(a, na, b, nb): all pairs of near words with their counts, a before b."""
    placed = partitions(words, stages, large)
    key = ["head", "tail", "least"]
    return (placed.repartition(*key).sortWithinPartitions(*key)
            .mapInPandas(_paired, "a string, na bigint, b string, nb bigint").dropDuplicates(["a", "b"]))


def variants(words: DataFrame, ratio: int = 2, large: int = LARGE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for the (word, n) rows of ``words``, in which
    a word occurs once."""
    stages = Stages(words.sparkSession)
    words = stages.written(words, "spelling-words")
    pairs = near_pairs(words, stages, large)
    both = F.array(F.struct(F.col("a").alias("word"), F.struct((-F.col("nb")).alias("order"), F.col("b").alias("form")).alias("f")),
                   F.struct(F.col("b").alias("word"), F.struct((-F.col("na")).alias("order"), F.col("a").alias("form")).alias("f")))
    near = (pairs.select(F.explode(both).alias("d")).select("d.*").groupBy("word")
            .agg(F.count("*").alias("n_near"), F.min("f").alias("best")))
    strong = -F.col("best.order") >= ratio * F.col("n")
    judged = stages.written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("best.form")).alias("form"), F.when(strong, -F.col("best.order")).alias("form_n")), "spelling-judged")
    ends = roots(judged.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), stages)
    out = stages.written(judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"), "spelling-variants")
    stages.remove_all_but(out)
    return out


def roots(links: DataFrame, stages: Stages) -> DataFrame:
    """(word, root): where the links (word -> root, without a circle) of each word end."""
    at = stages.written(links, "spelling-roots")
    while True:
        far = at.select(F.col("word").alias("via"), F.col("root").alias("far"))
        step = stages.written(at.join(far, at.root == far.via, "left").select(
            "word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "spelling-roots")
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        stages.remove(at)
        at = step.select("word", "root")
