"""Language identification: held-out accuracy and defined cases."""

import math
import re
import zlib
from collections import Counter, defaultdict

from awkward import awkward, empty
from pyspark.sql import functions as F

from catalograph.llm import langid, queries


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = queries.op1_language_id(spark, "/root/testdata/sf0.01")
    assert out.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    held = out.where("held_out").join(docs, "doc_id").where("lang IS NOT NULL AND text IS NOT NULL").cache()
    assert held.count() > 200
    assert held.where("lang = lang_pred").count() > 0.98 * held.count()
    assert out.count() == docs.count() and out.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def model(spark, rows):
    df = spark.createDataFrame(rows, "text string, lang string")
    return langid.train(df, F.col("text"), F.col("lang"), F.col("text"))


def test_words_first_then_shorter_ngrams(spark):
    score = langid.Scorer(model(spark, [("the house the house", "en"), ("das haus das haus", "de"), ("gleich", "de"), ("spring", "en"), (None, "fr"), ("x", None)]))
    assert score.langs == ["de", "en"]
    assert score("the the")[0] == "en" and score("DAS!")[0] == "de"
    assert not score.unseen
    assert score("gleichheit")[0] == "de" and score("springing")[0] == "en"
    assert set(score.unseen) == {"gleichheit", "springing"}
    before = score("gleichheit springing the")
    assert score("gleichheit springing the") == before


def test_no_letters_and_unknown_letters(spark):
    score = langid.Scorer(model(spark, [("the", "en"), ("das", "de")]))
    for text in (None, "", " \n", "123 ### ²³", "___"):
        assert score(text) == ("und", 0.0)
    assert score("東京")[1] == 0.5


def test_rare_languages_are_learned(spark):
    """Ten documents among five thousand, at most a hundred learned from and few words kept."""
    rows = [(f"the house number{chr(97 + k % 26)}{chr(97 + k // 26 % 26)} stands", "en", k) for k in range(5000)]
    rows += [(f"das haus steht {w}", "de", 9000 + k) for k, w in enumerate("eins zwei drei vier acht neun zehn elf rot blau".split())]
    df = spark.createDataFrame(rows, "text string, lang string, id long")
    learned = langid.train(df, F.col("text"), F.col("lang"), F.col("id"), sample=100, most_words=8, most_grams=40)
    assert learned.langs == ["de", "en"] and {"das", "haus", "steht", "the", "house", "stands"} <= set(learned.words)
    assert len(learned.words) <= 8 and len(learned.grams) <= 40
    score = langid.Scorer(learned)
    assert score("das haus")[0] == "de" and score("the house")[0] == "en"
    assert langid._even_part([10, 5000], 100) == 90 and langid._even_part([3, 4], 100) >= 4 and langid._even_part([], 5) == 5


def test_long_texts_in_parts(spark, monkeypatch):
    learned = model(spark, [("the cat", "en"), ("das tier", "de")])
    text = " ".join(f"the{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300))
    whole = langid.Scorer(learned)(text)
    monkeypatch.setattr(langid, "UNSEEN", 37)
    parts = langid.Scorer(learned)(text)
    assert parts[0] == whole[0] and abs(parts[1] - whole[1]) < 1e-4


def test_only_the_most_common_languages(spark):
    rows = [("the house", "en", 1), ("the cat", "en", 2), ("das haus", "de", 3), ("das tier", "de", 4), ("la maison", "fr", 5)]
    df = spark.createDataFrame(rows, "text string, lang string, id long")
    assert langid.train(df, F.col("text"), F.col("lang"), F.col("id"), most_langs=2).langs == ["de", "en"]


def test_clashing_names(spark):
    df = spark.createDataFrame([("the", "kept", "old", 7.0)], "text string, found string, Lang_Pred string, score double")
    out = langid.predict(df, model(spark, [("the", "en"), ("das", "de")]))
    assert out.columns == ["text", "found", "lang_pred", "score"]
    assert out.first()[:3] == ("the", "kept", "en")


def brute(docs):
    """Language and score of each text from plain counts of all labelled rows."""
    words, grams = defaultdict(Counter), defaultdict(Counter)
    known = [d for d in docs if d.lang is not None and d.text is not None and zlib.crc32(str(d.doc_id).encode()) % 4 != 2]
    langs = sorted({d.lang for d in known})
    for d in known:
        for w in re.findall(r"[^\W\d_]+", d.text.lower()):
            words[d.lang][w] += 1
            marked = f"<{w}>"
            grams[d.lang].update(marked[i : i + n] for n in range(1, 6) for i in range(len(marked) - n + 1))

    def rates(counts):
        every = set().union(*counts.values())
        total = {c: sum(counts[c].values()) + 0.5 * len(every) for c in langs}
        return {x: [math.log((counts[c][x] + 0.5) / total[c]) for c in langs] for x in every}

    word_rates, gram_rates = rates(words), rates(grams)
    out = {}
    for d in docs:
        own = re.findall(r"[^\W\d_]+", (d.text or "").lower())
        if not own:
            out[d.doc_id] = ("und", 0.0)
            continue
        scores = [0.0] * len(langs)
        for w in own:
            found = [word_rates[w]] if w in word_rates else []
            marked = f"<{w}>"
            if not found:
                for i in range(len(marked)):
                    longest = next((marked[i : i + n] for n in range(5, 0, -1) if i + n <= len(marked) and marked[i : i + n] in gram_rates), None)
                    if longest is not None:
                        found.append([x / 5 for x in gram_rates[longest]])
            scores = [s + sum(f[k] for f in found) for k, s in enumerate(scores)]
        chances = [math.exp(s - max(scores)) for s in scores]
        best = chances.index(max(chances))
        out[d.doc_id] = (langs[best], chances[best] / sum(chances))
    return out


def test_whole_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    expected = brute(spark.read.parquet(f"{sf}/documents.parquet").collect())
    got = queries.op1_language_id(spark, sf).collect()
    assert len(got) == len(expected)
    for r in got:
        lang, score = expected[r.doc_id]
        assert r.lang_pred == lang and abs(r.score - score) < 1e-3, r
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_forgetting_unseen_words(spark, monkeypatch):
    learned = model(spark, [("the cat", "en"), ("das tier", "de")])
    texts = [" ".join(f"the{chr(97 + (k * j) % 26)}" for k in range(9)) for j in range(1, 40)]
    whole = langid.Scorer(learned)
    expected = [whole(t) for t in texts]
    monkeypatch.setattr(langid, "UNSEEN", 24)
    few = langid.Scorer(learned)
    for text, (lang, score) in zip(texts, expected):
        found = few(text)
        assert found[0] == lang and abs(found[1] - score) < 1e-5
        assert len(few.unseen) <= few.room


def test_awkward_and_empty(spark):
    df = awkward(spark)
    learned = langid.train(df, F.col("text"), F.col("lang"), F.col("doc_id"))
    assert learned.langs == ["de", "en", "fr"]
    out = langid.predict(df, learned)
    assert out.columns == [*df.columns, "lang_pred", "score"] and out.count() == df.count()
    assert {r.lang_pred for r in out.where("text IS NULL").collect()} == {"und"}
    nothing = langid.train(empty(spark), F.col("text"), F.col("lang"), F.col("doc_id"))
    assert nothing.langs == []
    assert {tuple(r) for r in langid.predict(df, nothing).select("lang_pred", "score").collect()} == {("und", 0.0)}
    assert langid.predict(empty(spark), learned).count() == 0
