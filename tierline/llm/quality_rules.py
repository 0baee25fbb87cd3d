"""Quality rules by weak supervision (operator 12), DataFrame functions only.

Plan. One pass measures every text in its row: no word leaves the row, nothing
is shuffled. Each rule of ``RULES`` looks at one measure and votes good, bad or
abstains; a document's votes are one number of ``len(RULES)`` base-3 digits, so
the corpus is at most ``3**len(RULES)`` = 6,561 counted patterns, whatever its
size. Expectation-maximisation runs on that table: every round is one aggregate
over it, of which the driver sees three sums per kind and rule. Documents are
good or bad, the bad ones of one kind per rule, since what is bad in one way (a
text of symbols) need not be so in another (a text that repeats itself); a round
estimates the kinds' shares and each rule's accuracy on each kind. Abstentions
say nothing. A document's posterior is its probability of being good, which
follows from its votes alone: applying the model joins the patterns, broadcast.

No label is used. What keeps good and bad from changing places is the start,
and two bounds: a rule never votes "good" less often on good documents than on
others, and rule k votes "good" on kind k half the time at most.

A text's words are held in its row several times over (sorted by three-word
window); a task needs some 300 bytes for each word of its longest text.

Defined results: a null or blank text has no words, all rules abstain, and it
fails the base rules; a null id is kept as it is; repeated rows are measured
and counted one by one, equal texts have equal results; an empty table gives no
rows. Columns other than id and text are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import WORD, stored, word_count

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
MARKS = ".!?"
ROUNDS = 30
KEEP_FROM = 0.5         # posterior at which a document is kept
# share of good documents; "good" votes on good ones, on bad ones, and on the
# bad ones a rule is there for
START = (0.8, 0.9, 0.8, 0.1)
SMOOTH = 5.0            # pseudo-votes that hold a rule with few votes near the start
DIGITS = 9              # the estimates are rounded each round, so reruns agree


# ---- measures ----------------------------------------------------------------------------
def _repeats(docs: DataFrame) -> DataFrame:
    """Replaces ``words`` by ``n_repeat_words``: the words that lie in a
    three-word window found twice or more. Sorting the windows brings equal
    ones together; the starts of these cover up to three words each."""
    k = "greatest(size(words) - 2, 0)"
    windows = F.when(F.expr(f"{k} > 1"), F.expr(
        f"sort_array(arrays_zip(slice(words, 1, {k}), slice(words, 2, {k}), slice(words, 3, {k}), "
        "sequence(0, size(words) - 3)))"))
    equal = ("filter(arrays_zip(slice(s, 1, size(s) - 1), slice(s, 2, size(s) - 1)), x -> "
             "x.`0`.`0` = x.`1`.`0` and x.`0`.`1` = x.`1`.`1` and x.`0`.`2` = x.`1`.`2`)")
    starts = ("sort_array(array_distinct(concat(transform(eq, x -> x.`0`.`3`), "
              "transform(eq, x -> x.`1`.`3`))))")
    covered = ("aggregate(arrays_zip(slice(p, 1, size(p) - 1), slice(p, 2, size(p) - 1)), 3, "
               "(n, x) -> n + least(3, x.`1` - x.`0`))")
    return (docs.withColumn("s", windows).drop("words")
            .withColumn("eq", F.when(F.col("s").isNotNull(), F.expr(equal))).drop("s")
            .withColumn("p", F.when(F.size("eq") > 0, F.expr(starts))).drop("eq")
            .withColumn("n_repeat_words",
                        F.when(F.col("p").isNotNull(), F.expr(covered)).otherwise(0).cast("long"))
            .drop("p"))


def _count_of(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and the measures the rules look at."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    t = F.col("text")
    cut = base.select(
        "doc_id",
        F.length(F.translate(t, BLANKS, "")).cast("long").alias("word_chars"),
        _count_of(t, SYMBOLS).alias("n_symbols"),
        _count_of(t, MARKS).alias("n_marks"),
        F.regexp_count(t, F.lit(r"[^\p{L}\x20\x09-\x0D]")).cast("long").alias("n_other_chars"),
        F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        F.regexp_extract_all(t, F.lit(WORD), 0).alias("words"),
        F.filter(F.split(t, "\n", -1), lambda x: F.length(F.translate(x, BLANKS, "")) > 0).alias("lines"))
    counted = (cut.withColumn("n_words", F.size("words").cast("long"))
               .withColumn("n_distinct_words", F.size(F.array_distinct("words")).cast("long"))
               .withColumn("n_lines", F.size("lines").cast("long"))
               .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
               .drop("lines"))
    return _repeats(counted)


# ---- rules -------------------------------------------------------------------------------
@dataclass(frozen=True)
class Rule:
    """Votes good where ``good`` holds, bad where ``bad`` holds (both SQL over
    the measures), else abstains; also where neither is known."""
    name: str
    good: str
    bad: str

    def vote(self) -> Column:
        """0 abstain, 1 good, 2 bad"""
        return (F.when(F.expr(f"n_words > 0 and ({self.good})"), 1)
                .when(F.expr(f"n_words > 0 and ({self.bad})"), 2).otherwise(0))


RULES = (
    Rule("word_length", "word_chars between 3 * n_words and 10 * n_words",
         "2 * word_chars < 5 * n_words or word_chars > 14 * n_words"),
    Rule("symbols", "100 * n_symbols <= n_words", "10 * n_symbols >= n_words"),
    Rule("repeated_words", "10 * n_repeat_words <= n_words", "10 * n_repeat_words >= 3 * n_words"),
    Rule("repeated_lines", "n_lines > 1 and 10 * n_dup_lines <= n_lines",
         "n_lines > 1 and 10 * n_dup_lines >= 3 * n_lines"),
    Rule("letters", "10 * n_other_chars <= word_chars", "10 * n_other_chars >= 3 * word_chars"),
    Rule("sentences", "n_words between 3 * n_marks and 60 * n_marks",
         "2 * n_words < 3 * n_marks or n_words > 200 * n_marks"),
    Rule("capitals", "100 * n_capitals <= 15 * word_chars", "100 * n_capitals >= 40 * word_chars"),
    Rule("variety", "n_words >= 50 and n_distinct_words * n_distinct_words >= 16 * n_words",
         "n_words >= 50 and n_distinct_words * n_distinct_words < 4 * n_words"),
)


def base_failed() -> Column:
    return F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")


def with_votes(measured: DataFrame, rules=RULES) -> DataFrame:
    """Adds ``votes``, the rules' votes as base-3 digits, the first rule's lowest."""
    total = F.lit(0)
    for j, r in enumerate(rules):
        total = total + r.vote() * (3 ** j)
    return measured.withColumn("votes", total.cast("int"))


# ---- the model ---------------------------------------------------------------------------
@dataclass(frozen=True)
class VoteModel:
    """Kind 0 is the good documents, kind k the bad ones that rule k objects to
    first of all. ``share`` of each kind, and ``good[k][j]``, how often rule
    j's vote on a document of kind k is "good"."""
    share: tuple
    good: tuple

    def accuracies(self) -> list[float]:
        """How often each rule's votes are right."""
        return [sum(s * (g[j] if k == 0 else 1 - g[j])
                    for k, (s, g) in enumerate(zip(self.share, self.good)))
                for j in range(len(self.share) - 1)]

    def posteriors(self) -> Column:
        """Probability of every kind, given ``votes`` as an array of digits."""
        kinds = []
        for s, g in zip(self.share, self.good):
            by_vote = ", ".join(f"array(0D, {math.log(x)!r}D, {math.log(1 - x)!r}D)" for x in g)
            kinds.append(f"{s!r}D * exp(aggregate(zip_with(array({by_vote}), digits, "
                         "(row, v) -> row[v]), 0D, (a, x) -> a + x))")
        return F.expr(f"array({', '.join(kinds)})")


def start_model(n_rules: int) -> VoteModel:
    share, on_good, on_bad, objects = START
    bad = [tuple(objects if j == k else on_bad for j in range(n_rules)) for k in range(n_rules)]
    return VoteModel((share,) + ((1 - share) / n_rules,) * n_rules, ((on_good,) * n_rules, *bad))


def next_model(sums: dict, n_rules: int) -> VoteModel:
    """The maximisation step from (weight, good votes, votes) by (kind, rule)."""
    start = start_model(n_rules)
    kinds, rules = range(n_rules + 1), range(n_rules)
    total = sum(sums[k, 0][0] for k in kinds)
    share = tuple(round((sums[k, 0][0] + SMOOTH * start.share[k]) / (total + SMOOTH), DIGITS)
                  for k in kinds)
    rate = [[(sums[k, j][1] + SMOOTH * start.good[k][j]) / (sums[k, j][2] + SMOOTH) for j in rules]
            for k in kinds]
    good = [tuple(round(min(rate[k][j], rate[0][j], 0.5 if j == k - 1 else 1.0), DIGITS) for j in rules)
            for k in kinds]
    return VoteModel(share, tuple(good))


def fit(patterns: DataFrame, n_rules: int, rounds: int = ROUNDS) -> VoteModel:
    """Expectation-maximisation over (digits, n); an empty table leaves the start."""
    model, patterns = start_model(n_rules), patterns.coalesce(1)     # a few thousand rows at most
    for _ in range(rounds):
        p = F.expr("transform(p, x -> n * x / aggregate(p, 0D, (a, y) -> a + y))")
        sums = (patterns.select("digits", "n", model.posteriors().alias("p"))
                .select("digits", F.posexplode(p).alias("kind", "w"))
                .select("kind", "w", F.posexplode("digits").alias("rule", "v"))
                .groupBy("kind", "rule")
                .agg(F.sum("w").alias("all"), F.sum(F.when(F.col("v") == 1, F.col("w")).otherwise(0.0)).alias("yes"),
                     F.sum(F.when(F.col("v") > 0, F.col("w")).otherwise(0.0)).alias("votes")).collect())
        if not sums:
            return model
        model = next_model({(r.kind, r.rule): (r["all"], r.yes, r.votes) for r in sums}, n_rules)
    return model


def vote_patterns(votes: DataFrame, n_rules: int) -> DataFrame:
    """(votes, digits, n): the different votes and their number of documents."""
    counted = votes.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).coalesce(1)
    digits = F.array(*[F.expr(f"votes div {3 ** j} % 3").cast("int") for j in range(n_rules)])
    return stored(counted.withColumn("digits", digits), "patterns")


def with_posterior(voted: DataFrame, patterns: DataFrame, model: VoteModel) -> DataFrame:
    """Adds ``posterior``, the probability of a good document. The patterns, at
    most 3**rules rows, are broadcast."""
    p = patterns.select("votes", model.posteriors().alias("p")).select(
        "votes", F.expr("p[0] / aggregate(p, 0D, (a, y) -> a + y)").alias("posterior"))
    return voted.join(F.broadcast(p), "votes")


def classify(docs: DataFrame, rules=RULES, rounds: int = ROUNDS, keep_from: float = KEEP_FROM,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's measures, ``base_failed``, ``posterior`` and ``kept``."""
    voted = stored(with_votes(measures(docs, id_col, text_col), rules), "measures")
    patterns = vote_patterns(voted, len(rules))
    model = fit(patterns, len(rules), rounds)
    return (with_posterior(voted, patterns, model).withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep_from)))


def keep_good(docs: DataFrame, rules=RULES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that are kept. The model is fitted
    first; the texts are read twice and never shuffled."""
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.col(text_col).alias("_text"))
    voted = with_votes(measures(held, "_row", "_text"), rules)       # the row is its own id
    patterns = vote_patterns(voted.select("votes"), len(rules))
    model = fit(patterns, len(rules))
    return (with_posterior(voted, patterns, model)
            .filter(~base_failed() & (F.col("posterior") >= KEEP_FROM)).select("doc_id.*"))
