"""Quality rules by weak supervision, in DataFrame functions alone.

Each rule looks at one figure of a text and votes good (+1) or bad (-1) or abstains (0).
Expectation-maximisation over the counts of vote patterns (at most 3^rules rows, whatever the
table) estimates how often each rule is right on good and on bad texts; the posterior probability of
being good then decides. Two base limits stand before it: fewer than `min_words` words, or
more than 30 % of the words in 8-word windows that occur twice in the text.

Nothing is shuffled but vote patterns: all figures come from arrays within a row. A null text is
an empty one and fails; ids may be null or repeated; very long texts are read whole; on an empty
table the starting accuracies stand and the result is empty. Further columns pass through, whatever
their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import SPACE, apart, words, written

#: share limits of the rules, as (name, numerator, denominator, at or below, vote, at or above, vote)
RULES = (
    ("prose", "n_prose", "n_words", 0.60, -1, 0.80, 1),
    ("symbols", "n_symbols", "n_words", 0.02, 1, 0.10, -1),
    ("capitals", "n_capitals", "word_chars", 0.15, 1, 0.40, -1),
    ("shouts", "n_shouts", "n_words", 0.01, 1, 0.10, -1),
    ("duplicate lines", "n_dup_lines", "n_lines", 0.10, 1, 0.30, -1),
    ("repeated windows", "n_repeat_words", "n_words", 0.10, 1, 0.30, -1),
    ("variety", "n_distinct", "n_words", 0.15, -1, 0.30, 1),
    ("echoes", "n_echoes", "n_words", 0.03, 1, 0.15, -1),
    ("long words", "word_chars", "n_words", 10.0, 1, 14.0, -1),
)
#: rules rarely condemn a good text and overlook most faults of a bad one
START = {"good": 0.8, "right_good": 0.995, "right_bad": 0.2}
LEAST = 1e-4
FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_prose", "n_capitals", "n_shouts", "n_lines", "n_distinct", "n_echoes")


def _size(array: Column) -> Column:
    return F.size(array).cast("long")


def figures(docs: DataFrame, text_col: str = "text", window: int = 8) -> DataFrame:
    """`docs` with a struct `__figures` (FIGURES and EXTRA, all long)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.withColumn("__text", text).withColumn("__words", words(F.col("__text")))
    df = df.withColumn("__hashed", F.transform("__words", lambda w: F.xxhash64(w)))
    df = df.withColumn("__windows", F.when(F.size("__words") >= window, F.transform(
        F.sequence(F.lit(1), F.size("__words") - window + 1), lambda i: F.xxhash64(F.slice("__hashed", i, window))))
        .otherwise(F.array().cast("array<bigint>")))
    # only texts that repeat a window are looked at closer: windows and their places, sorted
    df = df.withColumn("__sorted", F.when(F.size(F.array_distinct("__windows")) < F.size("__windows"), F.sort_array(
        F.transform("__windows", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    twice = lambda x, j: ((F.get("__sorted", j - 1)["g"] == x["g"]) | (F.get("__sorted", j + 1)["g"] == x["g"]))
    df = df.withColumn("__places", F.sort_array(F.transform(
        F.filter("__sorted", lambda x, j: F.coalesce(twice(x, j), F.get("__sorted", j - 1)["g"] == x["g"],
                                                     F.get("__sorted", j + 1)["g"] == x["g"], F.lit(False))), lambda x: x["i"])))
    covered = F.aggregate(F.transform("__places", lambda p, j: F.least(F.lit(window), F.coalesce(F.get("__places", j + 1) - p, F.lit(window)))),
                          F.lit(0).cast("long"), lambda a, b: a + b)
    df = df.withColumn("__lines", F.filter(F.split("__text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    count = lambda pattern: F.length(F.regexp_replace("__text", pattern, "")).cast("long")
    echo = F.size(F.filter("__hashed", lambda h, i: F.coalesce(F.get("__hashed", i - 1) == h, F.lit(False))))
    # a filter on these figures must stay above them: moved below, it would compute the arrays anew for
    # each of their uses; no filter passes what is not deterministic
    df = df.withColumn("__figures", F.when(F.monotonically_increasing_id() >= 0, F.struct(
        _size(F.col("__words")).alias("n_words"),
        count(SPACE).alias("word_chars"),
        count(r"[^#*$%&|<>]+").alias("n_symbols"),
        (_size(F.col("__lines")) - _size(F.array_distinct("__lines"))).alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        _size(F.filter("__words", lambda w: w.rlike(r"^[\p{L}\p{M}'’-]+[.,;:!?]?$"))).alias("n_prose"),
        count(r"\P{Lu}+").alias("n_capitals"),
        (F.length("__text") - count("!{2,}")).cast("long").alias("n_shouts"),
        _size(F.col("__lines")).alias("n_lines"),
        _size(F.array_distinct("__hashed")).alias("n_distinct"),
        echo.cast("long").alias("n_echoes"))))
    return df.drop("__text", "__words", "__hashed", "__windows", "__sorted", "__places", "__lines")


def pattern(f: Column) -> Column:
    """The votes of all rules as one number: vote + 1 in base 3."""
    code = F.lit(0)
    for i, (_, above, below, low, at_low, high, at_high) in enumerate(RULES):
        share = f[above] / F.greatest(f[below], F.lit(1))
        code = code + F.when(share <= low, at_low + 1).when(share >= high, at_high + 1).otherwise(1) * 3**i
    return code.cast("int")


def _vote(code: Column, i: int) -> Column:
    return (F.floor(code / 3**i) % 3).cast("int") - 1


def posterior(code: Column, model: dict) -> Column:
    """Probability that a text with these votes is good."""
    odds = F.lit(math.log(model["good"] / (1 - model["good"])))
    for i, (g, b) in enumerate(model["rules"]):
        vote = _vote(code, i)
        odds = odds + F.when(vote == 1, math.log(g / (1 - b))).when(vote == -1, math.log((1 - g) / b)).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def fit(patterns: DataFrame, rounds: int = 12, trust: float = 20.0) -> dict:
    """Share of good texts and accuracies by expectation-maximisation over `patterns` (code, n). Each round is
    one aggregate over rules and votes; `trust` pseudo-votes hold each accuracy to its start."""
    model = {"good": START["good"], "rules": [(START["right_good"], START["right_bad"])] * len(RULES)}
    votes = F.explode(F.array(*[F.struct(F.lit(i).alias("rule"), _vote(F.col("code"), i).alias("vote")) for i in range(len(RULES))])).alias("v")
    for _ in range(rounds):
        seen = (patterns.select("n", (F.col("n") * posterior(F.col("code"), model)).alias("m"), "code")
                .select("n", "m", votes).groupBy("v.rule", "v.vote").agg(F.sum("n").alias("n"), F.sum("m").alias("m")).collect())
        # at most three rows a rule: how many votes, and how many of them from good texts
        n, m = ({(r.rule, r.vote): r[c] for r in seen} for c in ("n", "m"))
        of = lambda sums, rule, *kinds: sum(sums.get((rule, k), 0.0) for k in kinds)
        mean = lambda hits, of, start: min(1 - LEAST, max(LEAST, (hits + trust * start) / (of + trust)))
        model = {"good": mean(of(m, 0, -1, 0, 1), of(n, 0, -1, 0, 1), START["good"]), "rules": [
            (mean(of(m, i, 1), of(m, i, -1, 1), START["right_good"]),
             mean(of(n, i, -1) - of(m, i, -1), of(n, i, -1, 1) - of(m, i, -1, 1), START["right_bad"])) for i in range(len(RULES))]}
    return model


def _model(votes: DataFrame) -> dict:
    """Fitted on a table with `code`."""
    return fit(written(votes.groupBy("code").agg(F.count("*").alias("n")), "vote-patterns"))


def _verdict(seen: DataFrame, model: dict, min_words: int, repeat_percent: int, threshold: float) -> DataFrame:
    f = F.col("__figures")
    return (seen.withColumn("__code", pattern(f)).withColumn("__good", posterior(F.col("__code"), model)).drop("__code")
            .withColumn("__base_failed", (f["n_words"] < min_words) | (100 * f["n_repeat_words"] > repeat_percent * f["n_words"]))
            .withColumn("__kept", ~F.col("__base_failed") & (F.col("__good") >= threshold)))


def judge(docs: DataFrame, *, text_col: str = "text", min_words: int = 20, repeat_percent: int = 30, threshold: float = 0.5) -> DataFrame:
    """`__row` (the row of `docs`), `__figures`, `__good` (posterior), `__base_failed`, `__kept`. Rows and
    figures are written once; the model is fitted on the figures, which lie in columns of their own."""
    seen = written(figures(apart(docs, text=text_col)).select("__row", "__figures"), "judged")
    model = _model(seen.select(pattern(F.col("__figures")).alias("code")))
    return _verdict(seen, model, min_words, repeat_percent, threshold)


def table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_words: int = 20, repeat_percent: int = 30,
          threshold: float = 0.5) -> DataFrame:
    """doc_id, FIGURES, base_failed, kept, good (the posterior) of every row. The figures, a few
    numbers a row, are written once."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    seen = written(figures(own).select("doc_id", "__figures"), "figures")
    out = _verdict(seen, _model(seen.select(pattern(F.col("__figures")).alias("code"))), min_words, repeat_percent, threshold)
    return out.select("doc_id", *[F.col("__figures")[c].alias(c) for c in FIGURES],
                      F.col("__base_failed").alias("base_failed"), F.col("__kept").alias("kept"), F.col("__good").alias("good"))


def kept(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that pass, with their own columns only."""
    return judge(docs, text_col=text_col).filter("__kept").select("__row.*")
