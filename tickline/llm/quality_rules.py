"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

`measures` turns a text into counts, `RULES` bounds their ratios, and `verdict` compiles the
table into one boolean expression. No user function runs anywhere; every step stays in the JVM
and needs no shuffle, so a hot source or a copied text costs what its bytes cost.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickline.llm.common import SPACES, words_of

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = tuple(
    """the of and to in a is that it for was on are as with be this from or by not at
    der die das und ist ein eine zu von mit den dem nicht auf für im sich als
    le la les de des et en un une est que qui dans pour pas sur du au avec
    el los las y del por con no se su lo para""".split()
)
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """100 * part stays within low..high percent of whole, for texts of at least `least_words` words."""

    name: str
    part: str
    whole: str
    low: float | None = None
    high: float | None = None
    least_words: int = 1


RULES = (
    Rule("word_length", "word_chars", "n_words", 250, 1500),
    Rule("symbols", "n_symbols", "n_words", high=10),
    Rule("stop_words", "n_stop_words", "n_words", low=2, least_words=50),
    # by the characters in them: a short line that is said twice weighs little
    Rule("repeated_lines", "n_dup_line_chars", "n_line_chars", high=30, least_words=50),
    Rule("unfinished_lines", "n_unfinished_lines", "n_lines", high=30),
)

#: The rules that choose documents for a corpus.
CORPUS_RULES = RULES


def _bound(value: Column, use) -> Column:
    """Let `use` refer to a value many times while it is computed once a row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeated(words: Column) -> Column:
    """Words that lie in a window of five words found twice or more in the text."""

    def covered(starts: Column) -> Column:
        reach = F.transform(starts, lambda s, k: F.least(F.lit(5), F.coalesce(F.get(starts, k + 1) - s, F.lit(5))))
        return F.aggregate(reach, F.lit(0).cast("long"), lambda a, x: a + x)

    def again(ordered: Column) -> Column:
        same = F.filter(
            ordered,
            lambda x, k: (F.get(ordered, k + 1)["h"] == x["h"]) | ((k > 0) & (F.get(ordered, F.greatest(k - 1, F.lit(0)))["h"] == x["h"])),
        )
        return _bound(F.sort_array(F.transform(same, lambda x: x["at"])), covered)

    def counted(windows: Column) -> Column:
        ordered = F.sort_array(F.transform(windows, lambda h, k: F.struct(h.alias("h"), k.alias("at"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(_bound(ordered, again))

    windows = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 4, F.lit(0))),
        lambda w, k: F.xxhash64(w, F.get(words, k + 1), F.get(words, k + 2), F.get(words, k + 3), F.get(words, k + 4)),
    )
    return _bound(windows, counted)


def measures(df: DataFrame, text: str = "text", names: dict[str, str] | None = None) -> DataFrame:
    """All rows and columns of `df` with one struct column `__m` of counts (all long).

    Null text counts as empty. Equal windows are told by a 64-bit hash of their words within one
    text, so a false match needs two windows of the same text to collide.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    parts = df.withColumns({"__text": whole, "__words": words_of(F.col(f"`{text}`")), "__lines": F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
    words, lines, body = F.col("__words"), F.col("__lines"), F.col("__text")
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(F.regexp_replace(body, SPACES, "")),
        "n_symbols": F.length(F.regexp_replace(body, f"[^{SYMBOLS}]+", "")),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_unfinished_lines": F.size(F.filter(lines, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))),
        "n_repeat_words": _repeated(words),
        "n_line_chars": F.length(F.array_join(lines, "")),
        "n_dup_line_chars": F.length(F.array_join(lines, "")) - F.length(F.array_join(F.array_distinct(lines), "")),
    }
    return parts.withColumn("__m", F.struct(*[c.cast("long").alias(k) for k, c in counts.items()])).drop("__text", "__words", "__lines")


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def failed(rule: Rule, m: Column) -> Column:
    """Whether a row breaks one rule; products are compared, so nothing is divided by zero."""
    part, whole = 100 * m[rule.part], m[rule.whole]
    bounds = []
    if rule.low is not None:
        bounds.append(part < whole * rule.low)
    if rule.high is not None:
        bounds.append(part > whole * rule.high)
    broken = bounds[0]
    for more in bounds[1:]:
        broken = broken | more
    return (m["n_words"] >= rule.least_words) & broken


def judge(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, out: str = "quality") -> DataFrame:
    """All rows and columns of `df` and `out`: a struct of the counts, `base_failed`,
    `failed_rules` (names, in table order) and `kept`.

    Defined results: null, empty and blank texts have no words and fail the base rule; repeated
    rows are judged alike; a column named like `out` is replaced; an empty table stays empty.

    The verdict is tied to a row number that is never negative: Spark moves no filter below a projection
    that holds one. Moved down, the filter would hold the whole verdict as one expression, with each
    shared part computed anew wherever it is used, and for each element where that is inside an array.
    """
    m = F.col("__m")
    judged = measures(df, text)
    broken = F.array_compact(F.array(*[F.when(failed(r, m), F.lit(r.name)) for r in rules])) if rules else F.array().cast("array<string>")
    judged = judged.withColumns({"__base": base_failed(m), "__broken": broken})
    counts = [m[k].alias(k) for k in ("n_words", "word_chars", "n_symbols", "n_stop_words", "n_lines", "n_dup_lines", "n_unfinished_lines", "n_repeat_words", "n_line_chars", "n_dup_line_chars")]
    quality = F.struct(*counts, F.col("__base").alias("base_failed"), F.col("__broken").alias("failed_rules"), (~F.col("__base") & (F.size("__broken") == 0) & (F.monotonically_increasing_id() >= 0)).alias("kept"))
    return judged.withColumn(out, quality).drop("__m", "__base", "__broken")


def keep(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of `df` that the rules keep."""
    return judge(df, text, rules, "__quality").where(F.col("__quality")["kept"]).select(*[f"`{c}`" for c in df.columns])
