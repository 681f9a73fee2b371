"""Quality rules with risk-controlled thresholds (DataFrame operations only).

Rules reject a document whose score lies above a cut-off. Cut-offs are not chosen
by hand: labelled documents are parted in two by a hash. One half ranks the
candidate cut-offs by the junk they catch. The other, the holdout, certifies them
per stratum: the exact binomial test must show that the rules together reject at most
a share ``risk`` of good documents. Only cut-offs that catch more junk than the one
before are candidates. They are added one by one, those that cost the first half the
fewest good documents first and lenient before strict, and testing stops at the first
failure, which needs no correction inside the chain; the error level is divided over the
strata (Bonferroni). With too few labels nothing can be certified and nothing is rejected.

Strata are bands of the word count, so their number is fixed.

Defined cases: a null text has no words, all counts 0, and fails the base rule;
documents without a label, with a null label or with a null id are scored but not
learned from; of several labels of one id the lowest counts; repeated rows are
scored each; empty tables give empty results; other columns travel in a struct.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.llm.common import SPACES, words, written

SYMBOLS = "#*$%&|<>"
BANDS = (200, 800)  # word counts at which strata part


@dataclass(frozen=True)
class Risk:
    """At most ``risk`` of a stratum's good documents are rejected, with probability ``1 - error``."""

    risk: float = 0.04
    error: float = 0.1
    #: Rule, score and candidate cut-offs, lenient first.
    grid: tuple[tuple[str, str, tuple[float, ...]], ...] = (
        ("symbols", "n_symbols / n_words", (2.0, 1.0, 0.7, 0.5, 0.35, 0.25, 0.15, 0.1, 0.05)),
        ("dup_lines", "n_dup_lines / n_lines", (0.9, 0.7, 0.5, 0.4, 0.3, 0.2, 0.1)),
        ("repeats", "n_repeat_words / n_words", (0.45, 0.4, 0.35, 0.3, 0.25, 0.2)),
        ("capitals", "n_capitals / word_chars", (0.9, 0.7, 0.5, 0.4, 0.3, 0.2)),
    )


def counts(text: Column) -> list[Column]:
    """``n_words``, ``word_chars``, ``n_symbols``, ``n_capitals``, ``n_lines``, ``n_dup_lines``, ``n_repeat_words`` of a text."""
    text = F.coalesce(text, F.lit(""))
    list_of = words(text)
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    less = lambda chars: F.length(text) - F.length(F.translate(text, chars, ""))
    return [
        F.size(list_of).cast("long").alias("n_words"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        less(SYMBOLS).cast("long").alias("n_symbols"),
        less("ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("long").alias("n_capitals"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
    ]


# Words covered by 3-word windows that occur twice or more. Windows are sorted with
# their places; equal neighbours are repeats. A place whose window repeats covers
# the words up to two further on.
REPEATED_WORDS = """
aggregate(
  array_sort(transform(
    filter(sorted, (s, i) -> (i > 0 AND sorted[i - 1].h = s.h AND sorted[i - 1].g = s.g)
                          OR (i + 1 < size(sorted) AND sorted[i + 1].h = s.h AND sorted[i + 1].g = s.g)),
    s -> s.i)),
  named_struct('n', 0L, 'upto', -1),
  (a, i) -> named_struct('n', a.n + i + 3 - greatest(i, a.upto), 'upto', i + 3),
  a -> a.n)
"""


def with_counts(docs: DataFrame, text: Column) -> DataFrame:
    """``doc`` (struct of all columns but no copy of the text beyond it) and the counts of its text."""
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), text.alias("text"))
    out = base.select("doc", *counts(F.col("text")), words(F.col("text")).alias("w"))
    # Two independent 64-bit hashes stand for a window's three words.
    window = "named_struct('h', xxhash64(w[i], w[i + 1], w[i + 2]), 'g', hash(w[i + 2], w[i + 1], w[i]), 'i', i)"
    starts = "if(size(w) < 3, array(), sequence(0, size(w) - 3))"
    out = out.withColumn("sorted", F.expr(f"sort_array(transform(cast({starts} AS array<int>), i -> {window}))"))
    return out.withColumn("n_repeat_words", F.expr(REPEATED_WORDS)).drop("w", "sorted")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def stratum() -> Column:
    out = F.lit(0)
    for band in BANDS:
        out = out + (F.col("n_words") >= band).cast("int")
    return out


def _scores(risk: Risk) -> Column:
    return F.array(
        *[
            F.struct(F.lit(k).alias("rule"), F.coalesce(F.expr(f"try_divide({score.replace(' / ', ', ')})"), F.lit(0.0)).alias("score"))
            for k, (_, score, _) in enumerate(risk.grid)
        ]
    )


# The exact chance of at most k rejects among n at rate p, summed in logarithms.
BINOMIAL = """
aggregate(
  sequence(0L, k),
  named_struct('term', n * ln(1 - p), 'sum', CAST('-Infinity' AS DOUBLE)),
  (a, j) -> named_struct(
    'term', a.term + if(n > j, ln((n - j) / (j + 1)) + ln(p / (1 - p)), CAST('-Infinity' AS DOUBLE)),
    'sum', greatest(a.sum, a.term) + ln(1 + exp(least(a.sum, a.term) - greatest(a.sum, a.term)))),
  a -> least(1D, exp(a.sum)))
"""


def _joint(table: DataFrame, holdout: DataFrame, risk: Risk) -> DataFrame:
    """Cut-offs certified together: of the rules added one by one, as many as pass."""
    # Of each rule the steps that catch more junk than the step before.
    steps = table.groupBy("stratum", "rule").agg(F.sort_array(F.collect_list(F.struct("step", "cutoff", "junk_caught", "good_lost"))).alias("chain"))
    useful = F.expr("filter(chain, (c, i) -> c.junk_caught > if(i = 0, 0L, chain[greatest(i - 1, 0)].junk_caught))")
    added = steps.select("stratum", "rule", F.explode(useful).alias("c")).select("stratum", "rule", "c.*")
    order = F.struct("good_lost", "step", (-F.col("junk_caught")).alias("caught"), "rule", "cutoff", "junk_caught")
    added = added.groupBy("stratum").agg(F.sort_array(F.collect_list(order)).alias("added"))
    # A document is lost from the first addition on that rejects it. One row per band.
    lost = F.expr("array_min(filter(transform(added, (c, i) -> if(scores[c.rule].score > c.cutoff, i, NULL)), i -> i IS NOT NULL))")
    places = holdout.join(F.broadcast(added), "stratum").select("stratum", "added", lost.alias("place"))
    counted = places.groupBy("stratum").agg(
        F.any_value("added").alias("added"),
        F.count("*").alias("n"),
        *[F.sum((F.col("place") <= m).cast("long")).alias(f"k{m}") for m in range(sum(len(grid) for _, _, grid in risk.grid))],
    )
    ks = F.array(*[F.coalesce(F.col(c), F.lit(0).cast("long")) for c in counted.columns if c[:1] == "k"])
    tested = counted.select("stratum", "added", "n", F.posexplode(F.slice(ks, F.lit(1), F.size("added"))).alias("m", "k"))
    tested = tested.withColumn("p", F.lit(risk.risk)).withColumn("p_value", F.expr(BINOMIAL))
    chain = tested.groupBy("stratum").agg(F.any_value("added").alias("added"), F.sort_array(F.collect_list(F.struct("m", "n", "k", "p_value"))).alias("chain"))
    bad = F.expr(f"coalesce(array_min(transform(filter(chain, c -> c.p_value > {risk.error / (len(BANDS) + 1)!r}), c -> c.m)), size(chain))")
    passed = chain.withColumn("bad", bad).where("bad > 0").withColumn("last", F.expr("chain[bad - 1]"))
    chosen = passed.select("stratum", "last", F.explode(F.expr("slice(added, 1, bad)")).alias("c"))
    # Of each rule the strictest step added.
    found = chosen.groupBy("stratum", F.col("c.rule").alias("rule")).agg(F.max_by("c", "c.step").alias("c"), F.any_value("last").alias("last"))
    return found.select("stratum", "rule", "c.cutoff", F.col("last.n").alias("n_good"), F.col("last.k").alias("n_lost"), "last.p_value", "c.junk_caught")


def cutoffs(scored: DataFrame, labels: DataFrame, doc_id: str, label_id: str, quality: str, risk: Risk = Risk()) -> DataFrame:
    """Certified cut-offs: ``stratum``, ``rule``, ``cutoff``, ``n_good``, ``n_lost``, ``p_value``, ``junk_caught``.

    ``scored`` is :func:`with_counts`'s result, written: else its counts would be computed again
    for every use. At most one row per stratum and rule.
    """
    known = labels.groupBy(F.col(label_id).alias("label_id")).agg(F.min(quality).alias("good"))
    known = known.where("label_id IS NOT NULL AND good IS NOT NULL")
    half = (F.substring(F.md5(F.col(f"doc.{doc_id}").cast("string")), 1, 1) >= "8").cast("int")
    told = scored.where(~base_failed()).select(F.col(f"doc.{doc_id}").alias("label_id"), stratum().alias("stratum"), half.alias("half"), _scores(risk).alias("scores"))
    told = told.join(known, "label_id")
    labelled, told = told, told.select("stratum", "half", "good", F.explode("scores").alias("s")).select("stratum", "half", "good", "s.*")
    steps = F.array(*[F.array(*[F.lit(float(c)) for c in grid]) for _, _, grid in risk.grid])
    tested = told.select("*", F.posexplode(F.element_at(steps, F.col("rule") + 1)).alias("step", "cutoff"))
    above = (F.col("score") > F.col("cutoff")).cast("long")
    good, junk = F.col("good") > 0, F.col("good") <= 0
    held, tune = F.col("half") == 1, F.col("half") == 0
    zero = F.lit(0).cast("long")
    table = tested.groupBy("stratum", "rule", "step", "cutoff").agg(
        F.sum(F.when(tune & junk, above).otherwise(zero)).alias("junk_caught"),
        F.sum(F.when(tune & good, above).otherwise(zero)).alias("good_lost"),
    )
    return _joint(table, labelled.where(held & good), risk)


def judged(scored: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label_id: str = "doc_id", quality: str = "quality", risk: Risk = Risk()) -> DataFrame:
    """``scored`` with ``base_failed``, ``rules_failed`` (names of the certified rules it breaks) and ``kept``."""
    limits = cutoffs(scored, labels, doc_id, label_id, quality, risk)
    per_stratum = limits.groupBy("stratum").agg(F.collect_list(F.struct("rule", "cutoff")).alias("limits"))
    names = F.array(*[F.lit(name) for name, _, _ in risk.grid])
    # At most one row per band: a size fixed by BANDS.
    out = scored.withColumn("stratum", stratum()).join(F.broadcast(per_stratum), "stratum", "left")
    out = out.withColumn("scores", _scores(risk)).withColumn("names", names)
    broken = F.expr("transform(filter(coalesce(limits, array()), l -> scores[l.rule].score > l.cutoff), l -> names[l.rule])")
    out = out.withColumn("base_failed", base_failed()).withColumn("rules_failed", F.sort_array(broken))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("rules_failed") == 0)).drop("limits", "scores", "names")


def quality_rules(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label_id: str = "doc_id", quality: str = "quality", risk: Risk = Risk()) -> DataFrame:
    """Counts, broken rules and verdict of every row of ``docs``; all its columns are in ``doc``.

    The counts are written to the shared folder once; learning and judging read them there.
    """
    return judged(written(with_counts(docs, F.col(text)), "quality-counts"), labels, doc_id, label_id, quality, risk)
