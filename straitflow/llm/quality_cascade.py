"""Quality rules as a short-circuit cascade.

Counts of every text come first (`measure`). The rules then stand in one nested CASE, so that a text rejected
early costs no further rule. Their order follows from a sample: each rule's own time and its rejections
are measured there, and rules with more rejections per second come first. The order decides what a run costs,
never what it returns, as a text is kept when no rule rejects it.
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from straitflow.llm.shared import staged

#: White space between words, and the symbols counted.
BLANKS = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]"

#: Rows of the sample that costs and rejections are estimated on, at most.
SAMPLE_ROWS = 2000

#: Tasks that run over the sample, and the least time that a rule is taken to cost.
SAMPLE_TASKS = 4
LEAST_SECONDS = 0.005


@dataclass(frozen=True)
class Rule:
    """A name, and the condition under which a text is rejected, over the columns of `measure`."""

    name: str
    rejects: Column


def default_rules() -> list[Rule]:
    words, text = F.col("n_words"), F.col("text")
    letters = F.regexp_count(text, F.lit("\\p{L}"))
    return [
        Rule("mean_word_length", ~(F.col("word_chars") / F.greatest(words, F.lit(1))).between(2, 15)),
        Rule("symbols", F.col("n_symbols") * 5 > words),
        Rule("repeated_lines", (F.col("n_dup_lines") >= 3) & (F.col("n_dup_lines") * 10 > F.col("n_lines") * 3)),
        Rule("repeated_words", F.col("n_repeat_words") * 10 > words * 3),
        Rule("capitals", F.regexp_count(text, F.lit("\\p{Lu}")) * 2 > letters),
        Rule("few_letters", letters * 2 < F.col("word_chars")),
        Rule("shouting", F.regexp_count(text, F.lit("[!?]{2,}")) * 10 > words),
    ]


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, text (null becomes empty) and counts, all as long: n_words, word_chars (code points in words),
    n_symbols, n_lines (lines with a word), n_dup_lines (of them, equal to an earlier one) and n_repeat_words
    (words in three-word windows that occur at least twice in the text).

    Rows stay as they are, repeated ones and null ids too. Windows are compared by 64-bit hashes within a text.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"))
    has_word = lambda x: x.rlike(WORD)
    words = F.filter(F.split("text", BLANKS), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), has_word)
    size = lambda x: F.size(x).cast("long")
    counted = rows.select("doc_id", "text", words.alias("words"), lines.alias("lines")).select(
        "doc_id",
        "text",
        size("words").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        size("lines").alias("n_lines"),
        (size("lines") - size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.when(
            F.size("words") >= 4,
            F.transform(
                F.sequence(F.lit(1), F.size("words") - 2),
                lambda i: F.xxhash64(
                    F.element_at("words", i), F.element_at("words", i + 1), F.element_at("words", i + 2)
                ),
            ),
        ).alias("windows"),
    )
    # Only a text with a repeated window is looked at further: its windows are sorted with their places, the
    # places of the ones equal to a neighbour are put in order, and each adds the words not covered before it.
    sorted_windows = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeated = counted.withColumn(
        "sorted", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), sorted_windows)
    ).withColumn(
        "places",
        F.array_sort(
            F.transform(
                F.filter(
                    "sorted",
                    lambda x, k: F.coalesce(x["h"] == F.get("sorted", k - 1)["h"], F.lit(False))
                    | F.coalesce(x["h"] == F.get("sorted", k + 1)["h"], F.lit(False)),
                ),
                lambda x: x["i"],
            )
        ),
    )
    covered = F.aggregate(
        "places",
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(F.lit(3), i - s["last"])).alias("n")),
        lambda s: s["n"],
    )
    return repeated.select(
        "doc_id",
        "text",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_lines",
        "n_dup_lines",
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
    )


def rule_costs(sample: DataFrame, rules: list[Rule]) -> dict[str, tuple[int, float]]:
    """For each rule, its rejections on a sample of bounded size and its seconds, the least of two runs.

    What a query costs that computes no rule is taken off, and a first run of each is not counted, so neither the
    start of a job nor its compilation passes for the rule's cost.
    """

    def timed(rejected: Column) -> tuple[int, float]:
        query, best, found = sample.select(rejected.alias("rejected")), math.inf, 0
        for attempt in range(3):
            began = time.perf_counter()
            found = sum(bool(row["rejected"]) for row in query.collect())
            if attempt:
                best = min(best, time.perf_counter() - began)
        return found, best

    idle = timed(F.length("text") < 0)[1]
    return {r.name: (n, max(seconds - idle, LEAST_SECONDS)) for r in rules for n, seconds in [timed(r.rejects)]}


def ordered_rules(
    measured: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS, failed: Column | None = None
) -> list[Rule]:
    """The rules by rejections per second on a sample of rows, the best first.

    The sample is drawn by a hash over all rows, so it stands for the table and not for its first file; it is bounded and
    staged, and its cost does not grow with the table. Rows that `failed` holds for never reach the rules and
    are left out. Costs count in steps of a factor of two, and rules equal by then stay in the order given: what
    the clock cannot tell apart does not change the order. An empty sample leaves it as it is.
    """
    share = max(1, measured.count() // (2 * sample_rows))
    drawn = measured.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(share)) == 0)
    # As a column, and not as a filter: pushed down, a filter would spell the counts out again and again.
    gone = F.lit(False) if failed is None else failed
    drawn = drawn.select("doc_id", "text", gone.alias("failed")).limit(sample_rows).repartition(SAMPLE_TASKS)
    drawn = staged(drawn).where("NOT failed")
    if drawn.isEmpty():
        return rules
    costs = rule_costs(measure(drawn), rules)
    rate = {name: n / 2.0 ** round(math.log2(seconds)) for name, (n, seconds) in costs.items()}
    return sorted(rules, key=lambda r: -rate[r.name])


def cascade(rules: list[Rule]) -> Column:
    """The name of the first rule that rejects a text, or null; rules after it are not computed."""
    out = None
    for rule in rules:
        out = F.when(rule.rejects, rule.name) if out is None else out.when(rule.rejects, rule.name)
    return F.lit(None).cast("string") if out is None else out


def judge(docs: DataFrame, rules: list[Rule] | None = None, min_words: int = 50) -> DataFrame:
    """Counts of every text, base_failed (too few words, or over half of them repeated) and kept.

    A text without words fails the base rules. `kept` is false where they fail, else whether no rule rejects.
    """
    measured = measure(docs)
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    order = ordered_rules(measured, default_rules() if rules is None else rules, failed=failed)
    return measured.withColumn("base_failed", failed).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        F.when(F.col("base_failed"), False).otherwise(cascade(order).isNull()).alias("kept"),
    )
