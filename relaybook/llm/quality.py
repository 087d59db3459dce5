"""Quality rules: one table of thresholds, compiled into one projection."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaybook.llm.common import columns, let, quoted, without, words

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: Frequent function words of languages in Latin letters (en, fr, de, es, it, pt, nl, pl, cs, sv, tr).
STOP_WORDS = tuple(
    "the of and to in that is was for on with as by this from are be it an a or not what have he "
    "her at le la les de des et un une du en que qui pour dans sur avec pas au der die das und ist "
    "von zu den mit nicht ein eine im auf el los las y por con para del se su al lo como más es una "
    "il di che è per non sono i o os um uma não em do da het een van dat op te zijn i w na z że się "
    "nie jest do to od po jak oraz ale v s je že ale jako och att det som en av är inte för bir ve bu "
    "için ile da".split()
)
#: The languages of these words, as the language column names them.
COVERED = ("en", "fr", "de", "es", "it", "pt", "nl", "pl", "cs", "sv", "tr")
#: Letters of other scripts, from Greek on.
_OTHER_LETTERS = r"[\x{0370}-\x{1DFF}\x{2E80}-\x{D7FF}\x{F900}-\x{FAFF}]"


class Rule(NamedTuple):
    """``at_least <= metric / per <= at_most``; a bound of None holds always.

    A rule that is made for ``covered`` texts is left out for the others: texts of which half the
    characters or more are letters of a script other than Latin, and texts whose language is named and
    not in ``COVERED``. Words of such texts have other lengths, and the stop words are not theirs.
    """

    metric: str
    per: str | None
    at_least: float | None
    at_most: float | None
    covered: bool = False


RULES = (
    Rule("word_chars", "n_words", 2.5, 10.0, covered=True),
    Rule("n_symbols", "n_words", None, 0.1),
    Rule("n_stop_words", "n_words", 0.02, None, covered=True),
    Rule("n_dup_lines", "n_lines", None, 0.5),
)

METRICS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
    "n_stop_words", "n_other_letters",
)


def _covered(starts: Column) -> Column:
    """Words inside windows that begin at these sorted places."""
    steps = F.transform(
        starts,
        lambda at, i: F.least(
            F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - at, F.lit(WINDOW))
        ),
    )
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step)


def _repeated(hashes: Column) -> Column:
    """Words inside windows whose hash occurs twice or more, from the hash of every window."""
    in_order = F.sort_array(
        F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )

    def starts(found: Column) -> Column:
        twins = F.filter(
            found,
            lambda x, i: (x["h"] == F.get(found, i - 1)["h"]) | (x["h"] == F.get(found, i + 1)["h"]),
        )
        return F.sort_array(F.transform(twins, lambda x: x["i"]))

    return let(let(in_order, starts), _covered)


def _repeat_words(found: Column) -> Column:
    places = F.sequence(F.lit(0), F.size(found) - WINDOW)
    windows = F.transform(
        places, lambda i: F.xxhash64(*[F.get(found, i + step) for step in range(WINDOW)])
    )
    return F.when(F.size(found) <= WINDOW, 0).otherwise(
        let(
            windows,
            lambda hashes: F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0)
            .otherwise(_repeated(hashes)),
        )
    )


def metrics(text: Column) -> Column:
    """A struct of the counts in ``METRICS``, all long.

    Words are compared window by window through a 64-bit hash of their eight words; two different
    windows of one text are taken for equal with a chance of one in 10^11 for 20,000 words.
    """
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))

    def counts(found: Column, kept: Column) -> Column:
        values = {
            "n_words": F.size(found),
            "word_chars": F.length(F.array_join(found, "")),
            "n_symbols": F.regexp_count(whole, F.lit(r"[#*$%&|<>]")),
            "n_dup_lines": F.size(kept) - F.size(F.array_distinct(kept)),
            "n_repeat_words": _repeat_words(found),
            "n_lines": F.size(kept),
            "n_stop_words": F.size(F.filter(found, lambda w: F.lower(w).isin(*STOP_WORDS))),
            "n_other_letters": F.regexp_count(whole, F.lit(_OTHER_LETTERS)),
        }
        return F.struct(*[values[name].cast("long").alias(name) for name in METRICS])

    return let(words(text), lambda found: let(lines, lambda kept: counts(found, kept)))


def _is_covered(lang: Column) -> Column:
    latin = F.col("n_other_letters") * 2 < F.greatest(F.col("word_chars"), F.lit(1))
    return latin & F.coalesce(lang.isin(*COVERED), F.lit(True))


def _holds(rule: Rule) -> Column:
    value = F.col(rule.metric)
    if rule.per:
        value = value / F.greatest(F.col(rule.per), F.lit(1))
    bounds = []
    if rule.at_least is not None:
        bounds.append(value >= rule.at_least)
    if rule.at_most is not None:
        bounds.append(value <= rule.at_most)
    held = reduce(lambda a, b: a & b, bounds, F.lit(True))
    return held | ~F.col("covered") if rule.covered else held


def judge(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", lang: str | None = None
) -> DataFrame:
    """Documents with their counts, ``base_failed``, ``failed_rules`` and ``kept``.

    Nothing is shuffled: each document is judged by itself, in one projection, whatever its length.
    ``lang`` names a column with the language, if there is one; a null language is not known and the
    script of the text decides alone. A null or empty text has no words, so ``base_failed`` is true.
    Rows that repeat are judged alike. An empty table gives an empty one. Columns of the input with the
    names of result columns are replaced.
    """
    added = (*METRICS, "base_failed", "failed_rules", "kept")
    # A text that the result replaces is still read first. The counts are laid out by a generator,
    # so that a filter on them does not compute them once for each rule.
    named = quoted(lang).cast("string") if lang else F.lit(None).cast("string")
    flat = docs.select(F.struct(*columns(without(docs, *added))).alias("row"), named.alias("judged_lang"),
                       F.inline(F.array(metrics(F.col(text)))))
    flat = flat.withColumn("covered", _is_covered(F.col("judged_lang")))
    repeats = F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    names = [f"{rule.metric}/{rule.per}" if rule.per else rule.metric for rule in rules]
    failed = F.filter(
        F.array(*[F.when(~_holds(rule), F.lit(name)) for rule, name in zip(rules, names, strict=True)]),
        lambda name: name.isNotNull(),
    ) if rules else F.array().cast("array<string>")
    judged = flat.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | repeats)
    judged = judged.withColumn("failed_rules", failed)
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
    return judged.select("row.*", *added)


def keep_good(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", lang: str | None = None
) -> DataFrame:
    """The documents that pass every rule, with their own columns only.

    The edge cases are those of ``judge``: null and empty texts go, rows that repeat stay or go together,
    and columns of any name, those of the counts among them, are given back as they were.
    """
    whole = F.struct(*columns(docs)).alias("row")
    named = quoted(lang).cast("string") if lang else F.lit(None).cast("string")
    read = docs.select(whole, F.col(text).alias("judged_text"), named.alias("own_lang"))
    return judge(read, rules, "judged_text", "own_lang").filter("kept").select("row.*")

