"""Language identification by word-first backoff.

A known word adds its log frequency in every language. An unseen word falls back to
character n-grams: at each place the longest known one, from ``LONGEST`` characters
down, of the word between its edge marks. The scores become probabilities at equal
priors.

The model is learned with Spark from a bounded sample of labelled rows. Its bounds are parameters:
``sample`` documents, chosen by a hash, the same number of every language or all that there are, of
the ``most_langs`` languages with the most documents, and of those the most frequent ``most_words`` words and
``most_grams`` n-grams, an even part of every language. So it can be sent to the tasks
whatever the corpus. Prediction reads every whole text.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, as is
every text when nothing could be learned; very long texts are scored in parts of bounded size; rows without
a language are not learned from; repeated rows get the same prediction; a text in no known alphabet
gets the first language at an even score; an empty table gives an empty result; other columns are kept
beside the new ``lang_pred`` and ``score``, which replace columns of these names.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalograph.llm.common import free_name, written

SAMPLE = 20_000
WORDS = 100_000
GRAMS = 100_000
LONGEST = 5
LANGS = 200
SMOOTH = 0.5
UNSEEN = 1_000_000  # scores of unseen words that a worker keeps, over all languages
LETTERS = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    langs: list[str]
    words: list[str]
    word_scores: np.ndarray
    grams: list[str]
    gram_scores: np.ndarray


def _log_rates(counts: pd.DataFrame, langs: list[str], key: str) -> tuple[list[str], np.ndarray]:
    table = counts.pivot_table(index=key, columns="lang", values="n", fill_value=0, aggfunc="sum")
    table = table.reindex(columns=langs, fill_value=0).sort_index()
    smooth = table.to_numpy(np.float64) + SMOOTH
    return table.index.tolist(), np.log(smooth / smooth.sum(axis=0)).astype(np.float32)


def _most_frequent(counts: DataFrame, key: str, most: int) -> DataFrame:
    """Of every language an even part of ``most``, its most frequent, with their counts in all
    languages. Where equally frequent ones do not all fit, a hash chooses."""
    found = counts.groupBy("lang").agg(F.count("*").alias("size")).collect()  # one row a language of the model
    part = int(_even_part([r["size"] for r in found], most))
    # Spark keeps ``part`` rows of a language in each map task, so none gathers a language whole.
    order = Window.partitionBy("lang").orderBy(F.desc("n"), F.xxhash64(key), key)
    chosen = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= part).select(key).distinct()
    return counts.join(F.broadcast(chosen), key)  # at most ``most`` rows


def _even_part(sizes: list[int], sample: int) -> float:
    """Rows of each language at most, so that all together are ``sample``: what small
    languages leave goes to the others."""
    left, part = float(sample), float(sample)
    for k, n in enumerate(sorted(sizes)):
        part = left / (len(sizes) - k)
        if n >= part:
            return part
        left -= n
    return max([part, *sizes])


def train(docs: DataFrame, text: Column, lang: Column, key: Column, sample: int = SAMPLE, most_words: int = WORDS, most_grams: int = GRAMS, most_langs: int = LANGS) -> Model:
    """Learn from about ``sample`` rows of ``docs`` that have a text and a language, as many of
    each language as there are up to an even part; ``key`` chooses them."""
    known = docs.where(lang.isNotNull() & text.isNotNull())
    place = F.pmod(F.xxhash64(key.cast("string")), F.lit(1 << 32)) / float(1 << 32)
    found = known.groupBy(lang.cast("string").alias("lang")).agg(F.count("*").alias("n"))
    sizes = {r.lang: r.n for r in found.orderBy(F.desc("n"), "lang").limit(most_langs).collect()}
    part = _even_part(list(sizes.values()), sample)
    shares = F.create_map(*[F.lit(x) for name, n in sizes.items() for x in (name, min(1.0, part / n))]) if sizes else None
    # A language that the map does not have gives null, which keeps no row.
    chosen = known.where(place < F.try_element_at(shares, lang.cast("string"))) if sizes else known.limit(0)
    chosen = chosen.select(lang.cast("string").alias("lang"), F.lower(text).alias("text"))
    found = chosen.select("lang", F.explode(F.regexp_extract_all("text", F.lit(r"(\p{L}+)"), 1)).alias("word"))
    counts = written(found.groupBy("lang", "word").agg(F.count("*").alias("n")), "langid-words")
    marked = F.concat(F.lit("<"), "word", F.lit(">"))
    sizes = F.explode(F.sequence(F.lit(1), F.lit(LONGEST))).alias("size")
    sized = counts.select("lang", "n", marked.alias("word"), sizes).where("length(word) >= size")
    grams = sized.select("lang", "n", F.explode(F.expr("transform(sequence(1, length(word) - size + 1), i -> substring(word, i, size))")).alias("gram"))
    grams = written(grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "langid-grams")
    word_rows = _most_frequent(counts, "word", most_words).toPandas()
    gram_rows = _most_frequent(grams, "gram", most_grams).toPandas()
    langs = sorted(set(word_rows["lang"])) if len(word_rows) else []
    if not langs:
        return Model([], [], np.zeros((0, 0), np.float32), [], np.zeros((0, 0), np.float32))
    return Model(langs, *_log_rates(word_rows, langs, "word"), *_log_rates(gram_rows, langs, "gram"))


class Scorer:
    """Applies a model; scores of unseen words are kept while they fit."""

    def __init__(self, model: Model):
        self.langs = model.langs
        self.rows = {w: k for k, w in enumerate(model.words)}  # of all words whose scores are kept
        self.grams = {g: k for k, g in enumerate(model.grams)}
        self.gram_scores = model.gram_scores
        self.n_words = len(model.words)
        self.room = max(1, UNSEEN // max(1, len(model.langs)))
        self.scores = np.concatenate([model.word_scores, np.zeros((self.room, len(model.langs)), np.float32)])
        self.unseen: list[str] = []

    def _backoff(self, word: str) -> np.ndarray:
        """An unseen word's scores."""
        marked = f"<{word}>"
        end = len(marked)
        known = []
        for at in range(end):
            for stop in range(min(at + LONGEST, end), at, -1):
                row = self.grams.get(marked[at:stop])
                if row is not None:
                    known.append(row)
                    break
        # Neighbouring n-grams overlap: together they weigh about as much as one word.
        return self.gram_scores[known].sum(axis=0) / LONGEST if known else np.zeros(len(self.langs), np.float32)

    def _forget(self) -> None:
        for word in self.unseen:
            del self.rows[word]
        self.unseen.clear()

    def _total(self, words: list[str]) -> np.ndarray:
        """The sum of the scores of at most as many words as can be kept."""
        rows = list(map(self.rows.get, words))
        if None in rows:
            new = {w for w, row in zip(words, rows) if row is None}
            if len(self.unseen) + len(new) > self.room:
                self._forget()
                new = {w for w in words if w not in self.rows}
            for word in new:
                row = self.n_words + len(self.unseen)
                self.scores[row] = self._backoff(word)
                self.rows[word] = row
                self.unseen.append(word)
            rows = list(map(self.rows.__getitem__, words))
        return self.scores[rows].sum(axis=0, dtype=np.float64)

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = LETTERS.findall((text or "").lower())
        if not self.langs or not any(w.isalpha() or any(map(str.isalpha, w)) for w in words):
            return "und", 0.0
        total = np.zeros(len(self.langs))
        for first in range(0, len(words), self.room):  # at once, but for the longest texts
            total += self._total(words[first : first + self.room])
        chances = np.exp(total - total.max())
        best = int(chances.argmax())
        return self.langs[best], float(chances[best] / chances.sum())


_scorers: dict[str, Scorer] = {}  # of this worker process, by prediction


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the parameters of ``train``
    own = uuid.uuid4().hex

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if own not in _scorers:
            _scorers.clear()
            _scorers[own] = Scorer(sent.value)
        score = _scorers[own]
        for texts in batches:
            yield pd.DataFrame([score(t) for t in texts], columns=["lang_pred", "score"])

    found = free_name(docs, "found")
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    return docs.withColumn(found, run(F.col(f"`{text}`"))).select(*kept, f"{found}.*")
