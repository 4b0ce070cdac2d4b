"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Everything that touches rows is a DataFrame expression. Votes are counted by pattern (at most
3 to the number of rules, whatever the corpus) and the driver fits a latent class model to
those counts: good texts, and a class of bad ones for each family of rules, as a text of signs
is bad in another way than one that repeats itself. Each class has its own share and its own
rate at which each rule calls its texts bad, so a rule that often errs on good texts weighs
little and rules that speak together weigh much. The posterior probability of a good text is
again an expression.
"""

from __future__ import annotations

import math
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import let, written

WHITE = "\\x20\\x09-\\x0D"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Words in which distinct ones are counted at once; over a whole text their share would fall with its length.
BLOCK = 1000
#: What rules look at, by the kind of bad text that they are meant to find. Beyond a threshold a rule calls a text
#: good or bad; between the two it abstains.
FAMILIES = {"signs": ("symbols", "plain", "letters", "wordless"), "case": ("capitals", "uppers", "shouts"), "repeats": ("lines", "repeats", "variety", "echoes"), "shapes": ("length", "odd_words")}
RULES = tuple(k for family in FAMILIES.values() for k in family)
ROUNDS = 200
#: Rounds end when no share or rate moves by more.
SETTLED = 1e-7
#: Where the rounds start: the share of good texts, and how often a rule calls bad a text of its own family's class or of any other.
START_GOOD = 0.9
START_OWN = 0.6
START_OTHER = 0.05
#: A class is bad by what its family says: on average, its rules call at least so many of its texts bad.
CHANCE = 0.5
#: Rates are free between these; one vote of each kind is added to each, one text to each class.
EDGE = 1e-4
#: A word of plain text, which starts with a letter, with what may stand around it.
PLAIN = r"""^["'(\[]?\p{L}[\p{L}\p{M}\p{N}'\u2019-]*[.,;:!?"')\]]*$"""
#: A run of Latin signs that is longer than words are.
OVERLONG = r"^[\x21-\x7E\u00C0-\u024F]{21,}$"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{WHITE}]+"), lambda w: w != "")


def _without(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def repeated_words(words: Column) -> Column:
    """Words in windows of eight found twice or more, the first included.

    Texts whose windows' 64-bit hashes all differ have none. For the rest, windows sort by 96
    bits of hash with their places; neighbours that agree are repeats, and the places of
    repeats, in order, cover min(8, gap) words each.
    """

    def windows(value):
        return lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: value(F.slice(w, i, F.lit(WINDOW)), i))

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, b: a + b)

    def repeats(s: Column) -> Column:
        same = lambda x, y: F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]), F.lit(False))
        return F.sort_array(F.transform(F.filter(s, lambda x, k: same(x, F.get(s, k - 1)) | same(x, F.get(s, k + 1))), lambda x: x["i"]))

    exact = lambda w: let(let(F.sort_array(windows(lambda g, i: F.struct(F.xxhash64(g).alias("a"), F.hash(g).alias("b"), i.alias("i")))(w)), repeats), covered)
    hashed = lambda w: let(windows(lambda g, i: F.xxhash64(g))(w), lambda h: F.size(h) - F.size(F.array_distinct(h)))
    return let(words, lambda w: F.when(F.size(w) < 2 * WINDOW - 7, 0).when(hashed(w) == 0, 0).otherwise(exact(w))).cast("long")


def block_distinct_words(words: Column) -> Column:
    """Distinct words of each block of ``BLOCK`` consecutive words, the last one shorter, summed over all blocks."""
    blocks = lambda w: F.sequence(F.lit(0), F.floor((F.size(w) - 1) / BLOCK).cast("int"))
    distinct = lambda w, k: F.size(F.array_distinct(F.slice(w, k * BLOCK + 1, F.lit(BLOCK))))
    return let(words, lambda w: F.when(F.size(w) == 0, 0).otherwise(F.aggregate(blocks(w), F.lit(0), lambda a, k: a + distinct(w, k)))).cast("long")


def measures(text: Column) -> dict[str, Column]:
    """What rules look at, all counts of the whole text (distinct words block by block); a null text has no words."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(f"[^{WHITE}]"))
    per_words = lambda words: F.struct(
        F.size(words).cast("long").alias("n_words"),
        repeated_words(words).alias("n_repeat_words"),
        F.size(F.filter(words, lambda w: (w == F.upper(w)) & (w != F.lower(w)) & (F.length(w) > 1))).cast("long").alias("n_capital_words"),
        F.size(F.filter(words, lambda w: w.endswith("!"))).cast("long").alias("n_shout_words"),
        block_distinct_words(words).alias("n_distinct_words"),
        F.size(F.filter(words, lambda w, k: w == F.get(words, k - 1))).cast("long").alias("n_echo_words"),
        let(F.filter(words, lambda w: ~w.rlike(PLAIN)), lambda other: F.struct(F.size(other).cast("long").alias("n"), F.size(F.filter(other, lambda w: ~w.rlike(r"\p{L}"))).cast("long").alias("n_wordless"))).alias("other"),
        F.size(F.filter(words, lambda w: (F.length(w) == 1) | ((F.length(w) > 20) & w.rlike(OVERLONG)))).cast("long").alias("n_odd_words"),
    )
    return {
        "_words": let(words_of(text), per_words),
        "_lines": let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))),
        "word_chars": (F.length(text) - _without(text, " \t\n\x0b\f\r")).cast("long"),
        "n_symbols": _without(text, SYMBOLS).cast("long"),
        "n_letters": F.length(F.regexp_replace(text, r"[^\p{L}\p{M}]+", "")).cast("long"),
        "n_upper_letters": F.length(F.regexp_replace(text, r"\P{Lu}+", "")).cast("long"),
    }


def votes() -> dict[str, Column]:
    """1 good, -1 bad, 0 abstains, from the measures; a text without words gets no votes."""
    n = F.nullif(F.col("n_words"), F.lit(0)).cast("double")

    def vote(share: Column, good: float, bad: float) -> Column:
        return F.when(share > bad, -1).when(share < good, 1).otherwise(0)

    length = F.col("word_chars") / n
    signs = F.nullif(F.col("word_chars"), F.lit(0)).cast("double")
    return {
        "symbols": vote(F.col("n_symbols") / n, 0.05, 0.25),
        "plain": vote(F.col("other.n") / n, 0.20, 0.50),
        "letters": vote(1 - F.col("n_letters") / signs, 0.15, 0.25),
        "wordless": vote(F.col("other.n_wordless") / n, 0.05, 0.20),
        "capitals": vote(F.col("n_capital_words") / n, 0.10, 0.30),
        "uppers": vote(F.col("n_upper_letters") / F.nullif(F.col("n_letters"), F.lit(0)).cast("double"), 0.15, 0.40),
        "shouts": vote(F.col("n_shout_words") / n, 0.05, 0.25),
        "lines": vote(F.col("n_dup_lines") / F.nullif(F.col("n_lines"), F.lit(0)).cast("double"), 0.10, 0.40),
        "repeats": vote(F.col("n_repeat_words") / n, 0.10, 0.30),
        "variety": F.when(F.col("n_words") < 30, 0).otherwise(vote(1 - F.col("n_distinct_words") / n, 0.70, 0.80)),
        "echoes": vote(F.col("n_echo_words") / n, 0.10, 0.40),
        "length": F.when((length > 20) | (length < 1.5), -1).when(length.between(2.5, 12), 1).otherwise(0),
        "odd_words": vote(F.col("n_odd_words") / n, 0.30, 0.60),
    }


def measured(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns as given, the measures, base_failed and a struct of votes."""
    text = F.col("_text")
    out = docs.select(F.struct(*keep).alias("_kept"), F.col(text_col).alias("_text")).select("_kept", *(c.alias(k) for k, c in measures(text).items()))
    out = out.select("_kept", "_words.*", "_lines.*", "word_chars", "n_symbols", "n_letters", "n_upper_letters")
    cast = votes()
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return out.select("*", failed.alias("base_failed"), F.struct(*(cast[k].cast("int").alias(k) for k in RULES)).alias("_votes"))


class Model(NamedTuple):
    """Per class, the good one first: its share, and for each rule P(bad vote | class, votes)."""

    shares: list[float]
    rates: list[list[float]]


def _logs(model: Model) -> list[tuple[float, list[tuple[float, float, float]]]]:
    """Per class the logarithm of its share, and for each rule what an abstention, a good and a bad vote add (by -1 as an index)."""
    return [(math.log(share), [(0.0, math.log(1 - r), math.log(r)) for r in rates]) for share, rates in zip(*model, strict=True)]


def classes(pattern: tuple[int, ...], logs: list) -> list[float]:
    """The posterior probability of each class. An abstention says nothing about any."""
    sums = [share + sum(votes[v] for v, votes in zip(pattern, rules, strict=True)) for share, rules in logs]
    most = max(sums)
    parts = [math.exp(x - most) for x in sums]
    total = sum(parts)
    return [x / total for x in parts]


def posterior(pattern: tuple[int, ...], model: Model) -> float:
    return classes(pattern, _logs(model))[0]


def _inside(rate: float) -> float:
    return min(max(rate, EDGE), 1 - EDGE)


def _raised(rates: list[float], own: list[int]) -> list[float]:
    """The rates, those of the class's own family moved up alike in log-odds till their mean is better than chance."""
    if sum(rates[k] for k in own) >= CHANCE * len(own):
        return rates
    moved = lambda k, by: 1 / (1 + math.exp(-(math.log(rates[k] / (1 - rates[k])) + by)))
    low, high = 0.0, 20.0
    for _ in range(40):
        middle = (low + high) / 2
        low, high = (low, middle) if sum(moved(k, middle) for k in own) >= CHANCE * len(own) else (middle, high)
    return [_inside(moved(k, high)) if k in own else r for k, r in enumerate(rates)]


def fit(counts: dict[tuple[int, ...], int], families: list[list[int]] | None = None) -> Model:
    """Expectation-maximisation over the counts of vote patterns; ``families``: the rules' places, by kind of bad text.

    Rates are free and start alike for all rules of a class. What keeps the classes' names apart
    is that a bad class's own rules must beat chance on average. One vote of each kind for each
    rate and one text for each class are added, so an empty corpus gives a model too.
    """
    families = families or [[RULES.index(k) for k in family] for family in FAMILIES.values()]
    n = sum(map(len, families))
    model = Model([START_GOOD] + [(1 - START_GOOD) / len(families)] * len(families), [[START_OTHER] * n] + [[START_OWN if k in own else START_OTHER for k in range(n)] for own in families])
    if not counts:
        return model
    for _ in range(ROUNDS):
        total = [1.0] * len(model.shares)
        called = [[1.0] * n for _ in total]
        voted = [[2.0] * n for _ in total]
        logs = _logs(model)
        for pattern, times in counts.items():
            for c, p in enumerate(classes(pattern, logs)):
                total[c] += times * p
                for k, v in enumerate(pattern):
                    if v:
                        voted[c][k] += times * p
                        called[c][k] += times * p * (v < 0)
        rates = [[_inside(a / b) for a, b in zip(x, y, strict=True)] for x, y in zip(called, voted, strict=True)]
        before, model = model, Model([x / sum(total) for x in total], rates[:1] + [_raised(r, own) for r, own in zip(rates[1:], families, strict=True)])
        if max(abs(a - b) for x, y in zip([before.shares, *before.rates], [model.shares, *model.rates], strict=True) for a, b in zip(x, y, strict=True)) < SETTLED:
            break
    return model


def good_probability(model: Model, vote) -> Column:
    """The posterior of a good text as an expression; ``vote`` gives a rule's column."""
    odds = []
    for share, rates in zip(model.shares[1:], model.rates[1:], strict=True):
        log = F.lit(math.log(share / model.shares[0]))
        for k, bad, good in zip(RULES, rates, model.rates[0], strict=True):
            log = log + F.when(vote(k) == -1, math.log(bad / good)).when(vote(k) == 1, math.log((1 - bad) / (1 - good))).otherwise(0.0)
        odds.append(F.exp(log))
    return 1 / reduce(lambda a, b: a + b, odds, F.lit(1.0))


def judge(docs: DataFrame, keep: list[str], text_col: str = "text", least: float = 0.5) -> DataFrame:
    """_kept (the ``keep`` columns, whatever their names), the measures, base_failed, p_good and kept.

    A text with under 20 words (so a null or empty one too) or with over 30 % repeated words
    fails the base; among the rest, texts with a posterior of at least ``least`` are kept.
    Null or repeated keys are rows as any other; an empty table gives no rows; columns outside
    ``keep`` are not read and may bear any name. Measures are written once to the shared
    folder and read twice.
    """
    rows = written(measured(docs, keep, text_col), "quality")
    names = [f"_votes.{k}" for k in RULES]
    counts = {tuple(r)[:-1]: r[-1] for r in rows.where(~F.col("base_failed")).groupBy(*names).agg(F.count("*").alias("n")).collect()}  # at most 3^13 patterns
    rows = rows.withColumn("p_good", good_probability(fit(counts), lambda k: F.col(f"_votes.{k}")))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= least)).drop("_votes")
