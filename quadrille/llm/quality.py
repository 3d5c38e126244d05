"""Quality rules as weak supervision: rules vote or abstain, and EM weighs them.

Each rule votes for a text (1), against it (-1) or abstains (0), independently of the
others given the unknown quality.  Expectation-maximisation estimates how accurately each
rule votes, and the share of good texts, from the counts of the vote patterns: at most 3
to the number of rules, however many texts there are.  The posterior probability of
quality then decides, so a text that fails one rule can still pass.

Everything that touches rows is a DataFrame expression.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, words_of

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Characters that end a sentence or a line of speech: those of Latin texts, danda, Arabic,
#: Chinese and Japanese, Ethiopic, Armenian, Burmese, Khmer and Tibetan ones.
SENTENCE_ENDS = (
    '.!?:"»”' "\u0964\u0965" "\u061f\u06d4" "\u3002\uff61\uff0e\uff01\uff1f\uff1a\u300d\u300f"
    "\u1362\u1367\u0589\u104a\u104b\u17d4\u0f0d"
)


@dataclass(frozen=True)
class Rule:
    """Votes for a text at or below ``good`` and against it above ``bad``.

    ``value`` is SQL over the columns of ``text_features``; null abstains, and so does
    everything between the two limits.
    """

    name: str
    value: str
    good: float
    bad: float


_PER_WORD = "/ greatest(n_words, 1)"
_PER_LINE = "/ greatest(n_lines, 1)"

RULES = (
    # distances from the usual length, so that a large value is always the bad one
    Rule("words", "CASE WHEN n_words < 100 THEN 100 - n_words ELSE n_words / 1e5 END", 1, 50),
    Rule("word_length", f"abs(word_chars {_PER_WORD} - 6)", 2.5, 5),
    Rule("symbols", f"n_symbols {_PER_WORD}", 0.03, 0.1),
    Rule("table_cells", f"n_bars {_PER_WORD}", 0.02, 0.1),
    Rule("letters", "1 - n_letters / greatest(word_chars, 1)", 0.15, 0.25),
    Rule("repeated_lines", f"n_dup_lines {_PER_LINE}", 0.1, 0.5),
    Rule("repeated_words", f"n_repeat_words {_PER_WORD}", 0.1, 0.3),
    Rule("capitals", "n_capitals / greatest(word_chars, 1)", 0.2, 0.4),
    Rule("exclamations", f"n_exclamations {_PER_WORD}", 0.05, 0.2),
    Rule("sentence_ends", f"1 - n_ended_lines {_PER_LINE}", 0.5, 0.9),
    Rule("distinct_words", f"1 - n_distinct_words {_PER_WORD}", 0.75, 0.9),
)


def text_features(text: str, words: str) -> dict[str, Column]:
    """Counts of a text column and the column of its words, by name."""
    whole, split = F.coalesce(F.col(text), F.lit("")), F.col(words)

    def count_of(characters: str) -> Column:
        return F.length(whole) - F.length(F.translate(whole, characters, ""))

    inked = F.filter(
        F.split(whole, "\n"),
        lambda line: F.translate(line, " \t\x0b\f\r", "") != F.lit(""),
    )
    # a line end after a sentence end, or the end of the text
    ended = F.regexp_count(whole, F.lit(rf"[{SENTENCE_ENDS}][ \t\x0B\f\r]*(\n|\z)"))
    # vowel signs and other marks belong to the letters before them
    unlettered = F.regexp_replace(whole, r"[\p{L}\p{M}]+", "")
    capitals = F.length(whole) - F.length(F.regexp_replace(whole, r"\p{Lu}+", ""))
    return {
        "n_words": F.size(split).cast("bigint"),
        "word_chars": F.length(F.translate(whole, " \t\n\x0b\f\r", "")).cast("bigint"),
        "n_symbols": count_of(SYMBOLS).cast("bigint"),
        "n_dup_lines": (F.size(inked) - F.size(F.array_distinct(inked))).cast("bigint"),
        "n_repeat_words": _repeated_words(split).cast("bigint"),
        "n_lines": F.size(inked).cast("bigint"),
        "n_bars": count_of("|").cast("bigint"),
        "n_letters": (F.length(whole) - F.length(unlettered)).cast("bigint"),
        "n_capitals": capitals.cast("bigint"),
        "n_exclamations": count_of("!").cast("bigint"),
        "n_ended_lines": ended.cast("bigint"),
        "n_distinct_words": F.size(F.array_distinct(split)).cast("bigint"),
    }


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, although the body uses it often."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column) -> Column:
    """Words in windows of three words that occur twice or more in the array.

    Windows are compared by 64-bit hashes.  Only texts with equal hashes are sorted.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]),
    )

    def places(hashes: Column) -> Column:
        order = F.sort_array(
            F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )
        return _let(
            order,
            lambda o: F.filter(
                o,
                lambda x, k: F.get(o, k - 1)["h"].eqNullSafe(x["h"])
                | F.get(o, k + 1)["h"].eqNullSafe(x["h"]),
            ),
        )

    def covered(hashes: Column) -> Column:
        return F.size(
            F.array_distinct(
                F.flatten(
                    F.transform(
                        places(hashes),
                        lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2),
                    )
                )
            )
        )

    repeated = _let(
        windows,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(
            covered(h)
        ),
    )
    return F.when(F.size(words) < 4, 0).otherwise(repeated)


def vote(rule: Rule) -> Column:
    value = F.expr(rule.value)
    return (
        F.when(value <= F.lit(rule.good), 1)
        .when(value > F.lit(rule.bad), -1)
        .otherwise(0)
        .cast("tinyint")
    )


#: Beliefs before any text is seen, as shares of votes against, abstained and for, in
#: texts of poor and of good quality: a good text hardly fails a rule, and a poor one
#: fails only a few of them.
POOR_VOTES = (0.30, 0.10, 0.60)
GOOD_VOTES = (0.01, 0.09, 0.90)
GOOD_SHARE = 0.85
#: Weight of these beliefs, as a share of the texts.
BELIEF = 0.05


@dataclass(frozen=True)
class LabelModel:
    """Log odds of quality: ``bias`` plus, for each rule, the weight of its vote.

    ``weights[j]`` belongs to the votes -1, 0 and 1 of rule ``j``.
    """

    bias: float
    weights: tuple[tuple[float, float, float], ...]
    rounds: int


def fit_label_model(
    patterns: Sequence[tuple[Sequence[int], int]], n_rules: int, rounds: int = 100
) -> LabelModel:
    """How each rule votes on good and on poor texts, from counts of vote patterns.

    Expectation: the probability of quality of each pattern.  Maximisation: shares of
    votes by quality, with the beliefs above as pseudo-counts, so that a rule that never
    fires keeps its weight.  Without texts the beliefs themselves remain.
    """
    total = sum(count for _, count in patterns)
    belief = max(1.0, BELIEF * total)
    shares = [[POOR_VOTES, GOOD_VOTES] for _ in range(n_rules)]
    good, done = GOOD_SHARE, 0

    def model() -> LabelModel:
        weights = (tuple(math.log(g / p) for p, g in zip(*pair)) for pair in shares)
        return LabelModel(math.log(good / (1 - good)), tuple(weights), done)

    for done in range(1, rounds + 1):
        now = model()
        mass = [belief * (1 - GOOD_SHARE), belief * GOOD_SHARE]
        seen = [
            [[belief * v for v in POOR_VOTES], [belief * v for v in GOOD_VOTES]]
            for _ in range(n_rules)
        ]
        for votes, count in patterns:
            odds = now.bias + sum(w[v + 1] for w, v in zip(now.weights, votes))
            p = 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))
            for quality, part in ((0, count * (1 - p)), (1, count * p)):
                mass[quality] += part
                for j, v in enumerate(votes):
                    seen[j][quality][v + 1] += part
        shares = [[tuple(v / sum(q) for v in q) for q in rule] for rule in seen]
        before, good = good, mass[1] / sum(mass)
        if abs(before - good) < 1e-9:
            break
    return model()


def judge_quality(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rules: Sequence[Rule] = RULES,
    threshold: float = 0.5,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per text: its id, the counts, the votes, ``p_quality`` and ``kept``.

    ``base_failed`` holds for fewer than 50 words or more than half of the words in
    repeated windows; such texts are never kept.  Others are kept when their posterior
    is at least ``threshold``.  ``carry`` names columns that come along in a struct
    ``row``, whatever they are called.  A null text has no words, so it fails; rows with
    null or repeated ids are judged like any other; an empty table gives no rows.

    Counts are written once to the shared folder, so that texts are read once.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")
    split = documents.select(
        F.col(id_column).alias("_id"),
        F.col(text_column).alias("_text"),
        words_of(F.col(text_column)).alias("_words"),
        *([row] if carry else []),
    )
    counts = text_features("_text", "_words")
    counted = split.select(
        F.col("_id").alias("id"),
        *[c.alias(name) for name, c in counts.items()],
        *(["row"] if carry else []),
    )
    failed = F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    votes = [vote(rule).alias(f"vote_{rule.name}") for rule in rules]
    judged = stored(
        counted.select("*", failed.alias("base_failed"), *votes), "quality"
    )
    names = [f"vote_{rule.name}" for rule in rules]
    # at most 3 ** len(rules) rows
    patterns = [
        (tuple(r)[:-1], r["count"]) for r in judged.groupBy(*names).count().collect()
    ]
    model = fit_label_model(patterns, len(rules))
    odds = F.lit(model.bias)
    for name, weights in zip(names, model.weights):
        odds = odds + F.element_at(
            F.array(*map(F.lit, weights)), F.col(name).cast("int") + 2
        )
    posterior = F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))
    kept = ~F.col("base_failed") & (posterior >= F.lit(threshold))
    out = judged.select("*", posterior.alias("p_quality"), kept.alias("kept"))
    return out.withColumnRenamed("id", id_column)
