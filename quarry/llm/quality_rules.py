"""Quality rules: a threshold table compiled into one Spark projection.

Measures are built-in column functions (length, symbol, stop-word, line and
repetition counts); every rule of the table is ``low <= measure <= high``.
Nothing is shuffled and no user function runs.

Repeated three-word windows are found exactly: equal windows have equal
hashes, so only the windows whose hash occurs again are compared by their
words.

Defined cases: null text = empty text = no words, all counts 0, rejected by
the base rule; ties and repeated rows do not matter (rows are judged alone);
other columns pass through untouched unless named like a measure, which then
replaces them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

#: Frequent function words of the supported languages.
STOP_WORDS = (
    "the of and to in that is was for it with as on be at by this are from not or have an "  # English
    "de la le et les des en un une du que est pour dans qui par sur au pas plus ne se ce "  # French
    "der die und den von zu das mit sich dem nicht ein eine als auch es an werden aus er hat dass "  # German
    "el los que y del las por con para una su al lo como más pero sus"  # Spanish
).split()

#: name, measure (SQL over the counts), least, most; None: no bound.
RULES: tuple[tuple[str, str, float | None, float | None], ...] = (
    ("mean_word_chars", "word_chars / n_words", 2.0, 14.0),
    ("symbols_per_word", "n_symbols / n_words", None, 0.2),
    ("stop_words", "n_stop_words", 2, None),
    ("duplicate_lines", "n_dup_lines / n_lines", None, 0.5),
    ("upper_letters", "n_upper / word_chars", None, 0.5),
    ("digits", "n_digits / word_chars", None, 0.3),
)
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def counted_forms() -> list[str]:
    """Stop words as written inside and at the start of a sentence."""
    return [*dict.fromkeys(x for w in STOP_WORDS for x in (w, w.capitalize()))]


def _removed(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts that rules may use."""
    t = F.coalesce(F.col(text), F.lit(""))
    bare = F.trim(t, F.lit(BLANK))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.trim(x, F.lit(BLANK)) != "")
    df = docs.withColumns({"__words": F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+")), "__lines": lines})
    n, w, h = F.size("__words"), F.col("__words"), F.col("__hashes")
    # one hash for each word, then one for each three words in a row (the last two places start none)
    df = df.withColumn("__word_hashes", F.transform(w, lambda x: F.xxhash64(x)))
    one = F.col("__word_hashes")
    windows = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(one[i], one[i + 1], one[i + 2]))
    df = df.withColumn("__hashes", F.when(n >= 3, windows).otherwise(F.array().cast("array<long>")))
    # half a hash and the place in one number, sorted: places whose half hash occurs again come to lie side by side
    df = df.withColumn("__packed", F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(F.lit(-1 << 32)) + i)))
    p = F.col("__packed")

    def half(x):
        return F.shiftright(x, 32)

    again = F.filter(p, lambda x, k: F.coalesce(half(F.get(p, k - 1)) == half(x), F.lit(False)) | F.coalesce(half(F.get(p, k + 1)) == half(x), F.lit(False)))
    places = F.transform(again, lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int"))
    df = df.withColumn("__sorted", F.array_sort(F.transform(places, lambda i: F.struct(w[i].alias("a"), w[i + 1].alias("b"), w[i + 2].alias("c"), i.alias("i")))))
    s = F.col("__sorted")

    def same(x, k):
        y = F.get(s, k)
        return F.coalesce((y["a"] == x["a"]) & (y["b"] == x["b"]) & (y["c"] == x["c"]), F.lit(False))

    twice = F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))
    covered = F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    stops = F.filter("__words", lambda w: w.isin(*counted_forms()))
    counts = {
        "n_words": n,
        "word_chars": F.length(F.translate(t, BLANK, "")),
        "n_symbols": _removed(t, SYMBOLS),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": F.size(covered),
        "n_lines": F.size("__lines"),
        "n_stop_words": F.size(stops),
        "n_upper": F.regexp_count(t, F.lit(r"\p{Lu}")),
        "n_digits": _removed(t, "0123456789"),
    }
    # one row in, one row out: a filter on the counts stays above this, where the plan would otherwise make them twice
    made = F.inline(F.array(F.struct(*[c.cast("long").alias(k) for k, c in counts.items()])))
    return df.select(*[F.col(c) for c in docs.columns if c not in counts], made)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def failed_rules(rules=RULES) -> Column:
    """Names of the rules that a row fails (a text without words fails none)."""

    def broken(measure, low, high):
        x = F.expr(measure)
        bad = F.lit(False)
        if low is not None:
            bad = bad | (x < low)
        if high is not None:
            bad = bad | (x > high)
        return F.coalesce((F.col("n_words") > 0) & bad, F.lit(False))

    return F.filter(F.array(*[F.when(broken(m, low, high), F.lit(name)) for name, m, low, high in rules]), lambda x: x.isNotNull())


def judged(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """``docs`` with the counts, ``base_failed``, ``failed_rules`` and ``kept``."""
    df = measures(docs, text).withColumns({"base_failed": base_failed(), "failed_rules": failed_rules(rules)})
    return df.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
