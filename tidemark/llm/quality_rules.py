"""Quality rules: a threshold table compiled into one Spark projection.

``METRICS`` names SQL expressions of the text; ``RULES`` is a table of
``(rule, metric, lowest, highest)`` with null for an open bound.
``compile_rules`` turns the table into one boolean expression; no user
function runs.  Ratios are defined as 0 where there are no words or lines.

Null and empty texts have no words: every count is 0 and ``base_failed`` is
true.  Repeated rows are judged alike.  Higher-order functions over one row's
arrays keep the state of a row to that row, whatever its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Frequent function words of the four languages (en, de, fr, es).
STOP_WORDS = (
    "the be to of and that have with is in it for was on are as at by from this "
    "der die das und in zu ist von mit nicht ein eine den auf für sich "
    "le la les de des et un une du est que dans en pour pas qui "
    "el los las que en y una por con para se del no al su"
).split()
SYMBOLS = "#*$%&|<>"
SPACE = r"[ \t-\r]+"  # \x20 and \x09 to \x0D

#: The threshold table: (rule, metric, lowest, highest), bounds inclusive; None is open.
RULES = (
    ("word_length", "mean_word", 3.0, 10.0),
    ("symbols", "symbol_ratio", None, 0.05),
    ("stop_words", "n_stop", 2.0, None),
    ("stop_share", "stop_ratio", 0.05, None),
    ("duplicate_lines", "dup_line_ratio", None, 0.5),
    ("short_lines", "mean_line_words", 3.0, None),
    ("alphabetic", "alpha_ratio", 0.7, None),
)


def with_metrics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the counts and ratios as columns ``n_words word_chars n_symbols n_dup_lines n_repeat_words ...``."""
    t = F.coalesce(F.col(text), F.lit(""))
    step = df.withColumn("_t", t).withColumn("_w", F.array_remove(F.split("_t", SPACE), ""))
    step = step.withColumn("_lines", F.expr("filter(split(_t, '\\n'), l -> l RLIKE '[^ \\\\t-\\\\r]')"))
    step = step.withColumn("_chars", F.array_join("_w", ""))
    n = F.size("_w")
    # the hash of each window of three words, by the window's place; sorted on their own they show whether any is repeated
    step = step.withColumn("_h", F.expr("CASE WHEN size(_w) >= 4 THEN transform(slice(_w, 1, size(_w) - 2), (a, i) -> xxhash64(a, get(_w, i + 1), get(_w, i + 2))) END"))
    step = step.withColumn(
        "_win",
        F.expr("CASE WHEN size(array_distinct(_h)) < size(_h) THEN sort_array(transform(_h, (h, i) -> struct(h AS h, i AS i))) END"),
    )
    # windows sorted by (hash, position): one that equals a neighbour is repeated;
    # positions of the repeated windows, in order
    step = step.withColumn(
        "_rep",
        F.expr("sort_array(transform(filter(_win, (x, k) -> x.h = get(_win, k - 1).h OR x.h = get(_win, k + 1).h), x -> x.i))"),
    )
    covered = F.expr(
        "CASE WHEN _rep IS NULL OR size(_rep) = 0 THEN 0L ELSE "
        "aggregate(_rep, named_struct('p', -3, 'n', 0L), (s, i) -> named_struct('p', i, 'n', s.n + least(3, i - s.p)), s -> s.n) END"
    )
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    longest = max(map(len, STOP_WORDS))  # lower case never has fewer characters
    without = lambda pattern: F.length("_chars") - F.length(F.regexp_replace("_chars", pattern, ""))
    out = (
        step.withColumn("n_words", n.cast("long"))
        .withColumn("word_chars", F.length("_chars").cast("long"))
        .withColumn("n_symbols", without(f"[{SYMBOLS}]+").cast("long"))
        .withColumn("n_lines", F.size("_lines").cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("n_repeat_words", covered)
        .withColumn("n_stop", F.expr(f"size(filter(_w, w -> length(w) <= {longest} AND lower(w) IN ({stop})))").cast("long"))
        .withColumn("_letters", F.length(F.regexp_replace("_chars", r"[^\p{L}]+", "")).cast("long"))
    )
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return (
        out.withColumn("mean_word", ratio("word_chars", "n_words"))
        .withColumn("symbol_ratio", ratio("n_symbols", "word_chars"))
        .withColumn("stop_ratio", ratio("n_stop", "n_words"))
        .withColumn("dup_line_ratio", ratio("n_dup_lines", "n_lines"))
        .withColumn("mean_line_words", ratio("n_words", "n_lines"))
        .withColumn("alpha_ratio", ratio("_letters", "word_chars"))
        .drop("_t", "_w", "_lines", "_chars", "_h", "_win", "_rep", "_letters")
    )


def compile_rules(rules=RULES) -> Column:
    """The threshold table as one boolean expression: true where every rule holds."""
    out = F.lit(True)
    for _, metric, low, high in rules:
        if low is not None:
            out = out & (F.col(metric) >= F.lit(low))
        if high is not None:
            out = out & (F.col(metric) <= F.lit(high))
    return out


def judge(df: DataFrame, key: str = "doc_id", text: str = "text", rules=RULES) -> DataFrame:
    """One row per input row: key, the counts, ``base_failed`` and ``kept``."""
    m = with_metrics(df.select(F.col(key).alias(key), F.col(text).alias("_text")), "_text").drop("_text")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    m = m.withColumn("base_failed", failed)
    return m.select(key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & compile_rules(rules)).alias("kept"))
