"""Language identification by words first, backing off to character n-grams.

Training counts words and the character n-grams (4 down to 1, words marked by a
blank at both ends) of all labelled rows of every language. Spark counts: words
first, then the n-grams of the distinct words, so a word is cut into n-grams once a
language however often it occurs. The model keeps each language's
``max_words`` most frequent words and as many n-grams, with their counts in all
languages, so a kept word has a true count in each; that bounds what reaches the
driver and the tasks by the number of languages. Every language is kept. Every row of
the table is classified, over its whole text.

A known word scores its log frequency in every language. An unknown one scores
the mean log frequency of its known n-grams of the greatest length that has any.
The prediction is the language with the highest sum (ties: the smallest name),
its score the posterior under equal priors. A posterior over a whole text comes near 1
for some language whatever the text is in, so there is a certainty a word besides:
``known``, the mean over the words of 1 for a known word and else of the share of its
longest n-grams that any language knows. It falls where a text is in no learned language;
``unlearned`` tells how low is low, from labelled rows that were not learned from.

All of that is summed over words, so a text is cut at white space and frequent stops, and each
distinct token costs a look-up, among the known words or those that the task remembers, within
``MEMO_BYTES``. Only other tokens are searched for words and cut into n-grams.

Defined results: a null text or one without a letter gives ``und``, score 0, known 0 and words 0; so
does every text if there is no labelled row to learn from. A text whose words say
nothing gets equal posteriors. Repeated rows are classified alike; an empty table
gives an empty result. Only the named columns are read.
"""
from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
LONGEST = 4
STOPS = ".,;:!?\"'()-%&*#$|<>"  # frequent characters that no word holds
LONG_TOKEN = 64  # code points of the longest token that is remembered
BLOCK = 4096  # tokens added up at once
MEMO_BYTES = 64 << 20
MEMO_ENTRY = 250  # bytes of a token and its place, besides its numbers
SMOOTHING = 0.5


def grams(word: str, n: int) -> list[str]:
    marked = f" {word} "
    return [marked[i:i + n] for i in range(len(marked) - n + 1)] if n > 1 else list(word)


@dataclass
class Model:
    """Log frequencies: a row of ``table`` for each known word or n-gram, by language."""
    languages: list[str]
    words: dict[str, int]
    by_length: dict[int, dict[str, int]]
    table: np.ndarray
    memo: dict[str, int] = field(default_factory=dict, repr=False)  # token -> its row of ``scores``
    scores: np.ndarray | None = field(default=None, repr=False)

    def backed_off(self, word: str) -> tuple[list[int], float]:
        """The rows that an unknown word scores the mean of, and the known share of its longest n-grams."""
        longest = min(LONGEST, len(word) + 2)
        for n in range(LONGEST, 0, -1):
            rows = self.by_length.get(n, {})
            found = list(map(rows.get, grams(word, n)))
            known = [row for row in found if row is not None]
            if known:
                return known, len(known) / len(found) if n == longest else 0.0
        return [], 0.0

    def scored(self, tokens: list[str]) -> np.ndarray:
        """Of each token (in small letters), summed over its words: log frequency by language, known shares, words."""
        out = np.zeros((len(tokens), len(self.languages) + 2))
        at, rows, sizes, shares, times = [], [], [], [], []
        for i, token in enumerate(tokens):
            words, share = [token] if token.isalpha() else WORD.findall(token), 0.0
            for w in words:
                row = self.words.get(w)
                found, part = ([row], 1.0) if row is not None else self.backed_off(w)
                share += part
                if found:
                    at.append(i)
                    rows += found
                    sizes.append(len(found))
            shares.append(share)
            times.append(len(words))
        if rows:
            ends = np.cumsum(sizes)
            means = np.add.reduceat(self.table[rows], ends - sizes) / np.array(sizes)[:, None]
            np.add.at(out[:, :-2], at, means)
        out[:, -2], out[:, -1] = shares, times
        return out

    def remembered(self, tokens: list[str]) -> np.ndarray:
        """As ``scored``, for at most ``BLOCK`` tokens that aren't long; each is scored once while it is held."""
        if self.scores is None:
            width = len(self.languages) + 2
            self.scores = np.empty((max(BLOCK, MEMO_BYTES // (8 * width + MEMO_ENTRY)), width))
        memo = self.memo
        places = list(map(memo.get, tokens))
        if None in places:
            new = [t for t, place in zip(tokens, places) if place is None]
            if len(memo) + len(new) > len(self.scores):
                memo.clear()
                new = tokens
            first = len(memo)
            self.scores[first:first + len(new)] = self.scored(new)
            memo.update(zip(new, range(first, first + len(new))))
            places = list(map(memo.get, tokens))
        return self.scores[places]

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.judged(text)[:2]

    def judged(self, text: str | None) -> tuple[str, float, float, int]:
        """(lang, score, known, words)"""
        # no word holds white space or a stop, so a text is the sum of its tokens
        lowered = (text or "").lower()
        for c in STOPS:
            lowered = lowered.replace(c, " ")
        counts = Counter(lowered.split())
        if not counts or not self.languages:
            return "und", 0.0, 0.0, 0
        for token in [t for t in counts if len(t) > LONG_TOKEN]:
            c = counts.pop(token)
            for w, k in Counter(WORD.findall(token)).items():
                counts[w] += c * k
        total = np.zeros(len(self.languages) + 2)
        known, times, others = [], [], {}
        words = self.words
        for w, c in counts.items():
            row = words.get(w)
            if row is not None:
                known.append(row)
                times.append(c)
            elif len(w) > LONG_TOKEN:
                total += c * self.scored([w])[0]
            else:
                others[w] = c
        if known:
            total[:-2] += np.array(times, float) @ self.table[known]
            total[-2:] += sum(times)
        tokens, times = list(others), np.fromiter(others.values(), float, len(others))
        for i in range(0, len(tokens), BLOCK):
            total += times[i:i + BLOCK] @ self.remembered(tokens[i:i + BLOCK])
        n = int(total[-1])
        if not n:
            return "und", 0.0, 0.0, 0
        share, total = float(total[-2]) / n, total[:-2]
        best = int(total.argmax())
        return self.languages[best], float(1 / np.exp(total - total[best]).sum()), share, n


def train(docs: DataFrame, usable: Column, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
          sample_docs: int | None = None, max_words: int = 15_000) -> Model:
    """Fit on all rows where ``usable`` holds and text and label aren't null, or if asked for on
    ``sample_docs`` a language in expectation, taken by a hash of the id."""
    rows = docs.where(usable & F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(doc_id).alias("doc_id"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    if sample_docs is not None:
        sizes = rows.groupBy("lang").count().withColumn("step", F.ceil(F.col("count") / sample_docs)).select("lang", "step")
        rows = rows.join(written(sizes, "language-sizes"), "lang").where(
            F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.col("step")) == 0)
    counted = "lang string, n int, gram string, c long"
    summed = lambda df: df.groupBy("lang", "n", "gram").agg(F.sum("c").alias("c"))
    # no word holds a blank: what stands between blanks is counted, and words are looked for in distinct ones
    tokens = rows.select("lang", F.explode(F.split("text", " ")).alias("token")).groupBy("lang", "token").agg(F.count("*").alias("c"))
    found = F.explode(F.regexp_extract_all(F.lower("token"), F.lit(f"({WORD.pattern})"), F.lit(1))).alias("gram")
    words = written(summed(tokens.select("lang", F.lit(0).alias("n"), found, "c")), "language-words")
    counts = written(words.unionByName(summed(words.mapInPandas(_gram_counts, counted))), "language-counts")
    totals = counts.groupBy("lang", "n").agg(F.sum("c").alias("total"), F.count("*").alias("types"))
    place = F.row_number().over(Window.partitionBy("lang", F.col("n") > 0).orderBy(F.desc("c"), "n", "gram"))
    grams = counts.withColumn("place", place).where(F.col("place") <= max_words).select("n", "gram").distinct()
    return _model(counts.join(grams, ["n", "gram"]).collect(), totals.collect())


HELD_COUNTS = 1 << 17  # counts that a counting task holds before it gives them out


def _given_out(held: dict[tuple[str, int], Counter]) -> Iterator[pd.DataFrame]:
    """The counts held by (lang, n), in frames of bounded size; none are held then."""
    for (lang, n), counts in held.items():
        found = list(counts.items())
        for at in range(0, len(found), HELD_COUNTS):
            some = found[at:at + HELD_COUNTS]
            yield pd.DataFrame({"lang": lang, "n": n, "gram": [g for g, _ in some], "c": [c for _, c in some]})
    held.clear()


def _gram_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[tuple[str, int], Counter] = defaultdict(Counter)
    for pdf in batches:
        for lang, word, c in zip(pdf["lang"], pdf["gram"], pdf["c"]):
            for n in range(1, LONGEST + 1):
                counts = held[lang, n]
                for g in grams(word, n):
                    counts[g] += c
        if sum(map(len, held.values())) > HELD_COUNTS:
            yield from _given_out(held)
    yield from _given_out(held)


def _model(kept, totals) -> Model:
    languages = sorted({r["lang"] for r in totals})
    at = {lang: i for i, lang in enumerate(languages)}
    words: dict[str, int] = {}
    by_length: dict[int, dict[str, int]] = defaultdict(dict)
    for r in kept:
        rows = by_length[r["n"]] if r["n"] else words
        rows.setdefault(r["gram"], len(words) + sum(map(len, by_length.values())))
    counts = np.zeros((len(words) + sum(map(len, by_length.values())), len(languages)))
    level = np.zeros(len(counts), int)
    for r in kept:
        row = (by_length[r["n"]] if r["n"] else words)[r["gram"]]
        counts[row, at[r["lang"]]] = r["c"]
        level[row] = r["n"]
    total = np.ones((LONGEST + 1, len(languages)))
    for r in totals:
        if r["lang"] in at:
            total[r["n"], at[r["lang"]]] = r["total"] + SMOOTHING * (r["types"] + 1)
    return Model(languages, words, dict(by_length), np.log(counts + SMOOTHING) - np.log(total[level]))


def predictor(docs: DataFrame, model: Model):
    """A column function: text -> struct(lang string, score double, known double, words long)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, known double, words long")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            yield pd.DataFrame([m.judged(t) for t in texts], columns=["lang", "score", "known", "words"], index=texts.index)
    return predict.asNondeterministic()  # so that a filter on the result does not run it again


def unlearned(judged: DataFrame, model: Model, tests: Column, lang: Column, p: str = "p") -> Column:
    """Whether a prediction ``p`` is of a text that is in none of the learned languages, as
    far as its words can tell: its known share lies below half of what all but a hundredth of
    the labelled rows of ``judged`` reach that ``tests`` names (rows that the model did not learn
    from; all of them count). Shares are rounded to four decimals for that, which bounds the
    values counted. A share of few words says little, so 1 / sqrt(words) is allowed for chance.
    Without such rows nothing is rejected, and a model that learned from too little to know
    even those rejects little. ``judged`` is read for it, so it should be written."""
    known = F.col(f"{p}.known")
    low = (judged.where(tests & lang.cast("string").isin(model.languages) & (F.col(f"{p}.words") > 0))
           .agg(F.percentile(F.round(known, 4), 0.01)).first()[0]) or 0.0
    return known + 1 / F.sqrt(F.greatest(f"{p}.words", F.lit(1))) < low / 2
