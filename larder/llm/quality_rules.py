"""Quality rules by weak supervision.

Rules vote good (+1), bad (-1) or abstain (0) on each document. Expectation-maximisation estimates, without any label, how
often each rule is right and how common good documents are; a document is kept by its posterior probability of being good,
not by passing every rule.

The model: a latent class per document, and per rule one accuracy ``a``; a rule that votes is right with probability ``a``,
abstaining tells nothing. Documents enter the estimation only as counts of vote patterns, of which there are at most
3 ** rules, so one row of bounded size holds all that the iterations need, however many documents there are. A Beta prior and
bounds on ``a`` keep every rule better than chance, which also fixes the labels of the two classes.

Everything is built-in DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import bind, stage, with_rows, words


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``measure`` is over ``bad``, good where it is at most ``good`` (if given), and abstains otherwise.

    A rule votes good only if passing it is evidence of good text. Most rules find one kind of junk: passing them says little.
    """

    name: str
    measure: str
    bad: float
    good: float | None = None


#: Measures are SQL over the features below.
RULES = (
    Rule("symbols", "n_symbols / n_words", bad=0.1, good=0.02),
    Rule("noise", "n_noise / n_words", bad=0.15, good=0.03),
    Rule("word_length", "abs(word_chars / n_words - 6)", bad=5.0),
    Rule("capitals", "n_capitals / word_chars", bad=0.4),
    Rule("exclamations", "n_exclamations / n_words", bad=0.25),
    Rule("repeated_lines", "n_dup_lines / n_lines", bad=0.3),
    Rule("repeated_words", "n_repeat_words / n_words", bad=0.35),
    Rule("short_lines", "n_lines / n_words", bad=0.5),
)

ITERATIONS = 25
#: Rules start at this accuracy, which the prior also favours with the weight of this many votes per thousand documents.
START, PRIOR_SHARE = 0.8, 0.02
ACCURACY = (0.6, 0.98)
GOOD_SHARE = (0.3, 0.95)
THRESHOLD = 0.5

FEATURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_noise", "n_capitals", "n_exclamations"
)


def repeated_words(ws: Column) -> Column:
    """Words within three-word windows that occur at least twice in the array, the first occurrence included.

    Windows are compared by 64-bit hash. Only arrays with a repeated window are sorted, in n log n; nothing is quadratic.
    """
    windows = F.transform(
        F.slice(ws, 1, F.greatest(F.size(ws) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(ws, i + 1), F.get(ws, i + 2)),
    )

    def covered(starts: Column) -> Column:
        steps = F.transform(starts, lambda p, i: F.least(F.lit(3), F.get(starts, i + 1) - p))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def repeats(found: Column) -> Column:
        same = lambda x, other: F.coalesce(x["h"] == other["h"], F.lit(False))
        starts = F.transform(
            found, lambda x, i: F.when(same(x, F.get(found, i - 1)) | same(x, F.get(found, i + 1)), x["p"])
        )
        return bind(F.sort_array(F.filter(starts, lambda p: p.isNotNull())), covered)

    def count(hs: Column) -> Column:
        ordered = F.sort_array(F.transform(hs, lambda h, p: F.struct(h.alias("h"), p.alias("p"))))
        return F.when(F.size(F.array_distinct(hs)) < F.size(hs), bind(ordered, repeats)).otherwise(0)

    return bind(windows, count).cast("long")


def features(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the counts that the rules and the base filter use. A null text counts as empty."""
    body = F.coalesce(F.col(text), F.lit(""))
    split = df.withColumn("ws", words(body)).withColumn(
        "lines", F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    )
    counts = {
        "n_words": F.size("ws"),
        "word_chars": F.length(F.array_join("ws", "")),
        "n_symbols": F.regexp_count(body, F.lit(r"[#*$%&|<>]")),
        "n_lines": F.size("lines"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": repeated_words(F.col("ws")),
        "n_noise": F.regexp_count(body, F.lit(r"[#*$%&|<>{}\[\]\\^~=_]+|[!?]{2,}")),
        "n_capitals": F.regexp_count(body, F.lit(r"\p{Lu}")),
        "n_exclamations": F.regexp_count(body, F.lit("!")),
    }
    return split.withColumns({name: count.cast("long") for name, count in counts.items()}).drop("ws", "lines")


def vote(rule: Rule) -> Column:
    """+1, -1 or 0; 0 also where the measure divides by nothing."""
    measure = F.when(F.col("n_words") > 0, F.expr(rule.measure))
    good = F.lit(False) if rule.good is None else measure <= rule.good
    return F.when(measure > rule.bad, -1).when(good, 1).otherwise(0)


def log_odds(share: Column) -> Column:
    return F.log(share / (1 - share))


def posterior(good_share: Column, accuracy: Column, votes: Column) -> Column:
    """Probability of a good document given its votes."""
    evidence = F.zip_with(votes, accuracy, lambda v, a: v * log_odds(a))
    return 1 / (1 + F.exp(-F.aggregate(evidence, log_odds(good_share), lambda total, x: total + x)))


def clamp(value: Column, bounds: tuple[float, float]) -> Column:
    return F.least(F.greatest(value, F.lit(bounds[0])), F.lit(bounds[1]))


def total(items: Column, of) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda so_far, x: so_far + of(x))


def fit(votes: DataFrame, rules: int, iterations: int = ITERATIONS) -> DataFrame:
    """One row (good_share, accuracy): the estimates from a table with an array column ``votes``; no row for an empty one."""
    patterns = votes.groupBy("votes").agg(F.count("*").cast("double").alias("n"))
    table = patterns.groupBy().agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("patterns"))
    table = table.filter(F.size("patterns") > 0).withColumn("all", total(F.col("patterns"), lambda p: p["n"]))
    prior = F.col("all") * PRIOR_SHARE

    def step(state: Column, _: Column) -> Column:
        weighed = F.transform(
            F.col("patterns"),
            lambda p: F.struct(
                p["votes"].alias("votes"), p["n"].alias("n"),
                posterior(state["good_share"], state["accuracy"], p["votes"]).alias("q"),
            ),
        )

        def maximise(ps: Column) -> Column:
            def accuracy(j: Column) -> Column:
                right = total(
                    ps, lambda p: p["n"] * F.when(F.get(p["votes"], j) > 0, p["q"]).when(F.get(p["votes"], j) < 0, 1 - p["q"]).otherwise(0.0)
                )
                cast = total(ps, lambda p: p["n"] * F.abs(F.get(p["votes"], j)))
                return clamp((right + START * prior) / (cast + prior), ACCURACY)

            good = total(ps, lambda p: p["n"] * p["q"]) / F.col("all")
            return F.struct(
                clamp(good, GOOD_SHARE).alias("good_share"),
                F.transform(F.sequence(F.lit(0), F.lit(rules - 1)), accuracy).alias("accuracy"),
            )

        return bind(weighed, maximise)

    start = F.struct(F.lit(0.5).alias("good_share"), F.array_repeat(F.lit(START), rules).alias("accuracy"))
    model = F.aggregate(F.sequence(F.lit(1), F.lit(iterations)), start, step)
    return table.select(model.alias("model")).select("model.*")


def judge(docs: DataFrame, keep_rows: bool = False) -> DataFrame:
    """Votes, posterior and verdict of every document.

    ``docs`` has ``doc_id`` and ``text``; other columns don't matter. Returns one row per row of ``docs``, repeated rows
    included: doc_id, the counts, base_failed, kept, quality (the posterior), votes; with ``keep_rows`` the whole input row
    in ``row`` instead of doc_id. A null or empty text has no words and fails the base filter. An empty table gives an empty
    result. The counts are stored once and read twice: for the estimation, and for the verdicts.
    """
    rows = with_rows(docs).withColumn("body", F.col("row")["text"])
    key = F.col("row") if keep_rows else F.col("row")["doc_id"].alias("doc_id")
    counted = features(rows, "body").select(key, *FEATURES, F.array(*[vote(r) for r in RULES]).alias("votes"))
    counted = stage(counted, "quality")
    estimates = fit(counted.select("votes"), len(RULES)).first()  # one row, whatever the size of the table
    share, accuracy = (estimates.good_share, estimates.accuracy) if estimates else (0.5, [START] * len(RULES))
    quality = posterior(F.lit(share), F.array(*[F.lit(a) for a in accuracy]), F.col("votes"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = counted.withColumn("quality", quality).withColumn("base_failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= THRESHOLD))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns as they were."""
    return judge(docs, keep_rows=True).filter("kept").select("row.*")
