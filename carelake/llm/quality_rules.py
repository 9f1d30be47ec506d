"""Quality rules: one threshold table compiled into one projection.

Every measure is a built-in expression over the whole text, so a document is judged
in the scan's own task: no shuffle, no user function, no Python.

Cases: a null or empty text has no word and all counts are 0, so it fails the base rule.
Repeated rows are judged alike, one result each. Null ids are passed through. Extra
columns of the input are kept by ``filter_documents`` and ignored by ``measure``, whatever
their names. An empty table gives an empty result. Work is linear in the text, up to one
sort of its word windows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import WHITE, split_words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the be to of and that have with it for not on at this but by from or is are was in as a an he "
    "der die das und ist nicht ein eine zu den von mit sich auf für dem des im auch als an es "
    "le la les de des et est un une du que qui dans en pour pas sur au avec il elle ce par "
    "el los las y no una con por para su al lo del se más como"
).split()


@dataclass(frozen=True)
class Rule:
    """Bounds (inclusive) of one measure; None leaves a side open."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: The threshold table. ``base`` rules are the contract's; the rest is the method's verdict.
RULES = (
    Rule("mean_word_length", "mean_word_length", 2.0, 15.0),
    Rule("symbol_ratio", "symbol_ratio", None, 0.05),
    Rule("stop_word_ratio", "stop_word_ratio", 0.02, None),
    Rule("dup_line_ratio", "dup_line_ratio", None, 0.50),
)


def _repeat_positions(windows: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more; ``windows`` is sorted (x, i)."""
    twin = lambda s, j: (((j > 0) & (F.get(windows, j - 1)["x"] == s["x"]))
                         | (F.get(windows, j + 1)["x"] == s["x"]))
    hits = F.transform(F.filter(windows, lambda s, j: F.coalesce(twin(s, j), F.lit(False))),
                       lambda s: F.array(s["i"], s["i"] + 1, s["i"] + 2))
    return F.size(F.array_distinct(F.flatten(hits)))


def with_measures(df: DataFrame, text: Column) -> DataFrame:
    """``df`` plus a struct ``m`` with all counts and ratios of ``text``."""
    keep = df.columns
    t = F.coalesce(text, F.lit(""))
    a = df.select(*keep, t.alias("__t"), split_words(t).alias("__w"),
                  F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("__l"))
    b = a.select(*keep, "__t", "__w", "__l", F.size("__w").alias("__n"),
                 F.transform("__w", lambda w: F.xxhash64(w)).alias("__wh"))
    # 3-word windows by position; sequence() would count down for fewer than three words
    h = F.when(F.col("__n") >= 3, F.transform(
        F.sequence(F.lit(0), F.col("__n") - 3),
        lambda i: F.xxhash64(F.get("__wh", i), F.get("__wh", i + 1), F.get("__wh", i + 2))))
    c = b.select(*keep, "__t", "__w", "__l", "__n", h.alias("__h"))
    # most texts repeat no window: they skip the sort
    s = F.when(F.size(F.array_distinct("__h")) < F.size("__h"), F.array_sort(
        F.transform("__h", lambda x, i: F.struct(x.alias("x"), i.alias("i")))))
    d = c.select(*keep, "__t", "__w", "__l", "__n", s.alias("__s"))
    n = F.col("__n")
    e = d.select(
        *keep,
        F.struct(
            n.cast("bigint").alias("n_words"),
            F.char_length(F.array_join("__w", "")).cast("bigint").alias("word_chars"),
            F.regexp_count("__t", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
            (F.size("__l") - F.size(F.array_distinct("__l"))).cast("bigint").alias("n_dup_lines"),
            # the partition id only keeps the optimizer from moving a later filter below this point,
            # where the sorted windows would be computed anew for each of them
            F.when(F.col("__s").isNull(), F.lit(0))
            .when(F.spark_partition_id() >= 0, _repeat_positions(F.col("__s")))
            .cast("bigint").alias("n_repeat_words"),
            F.size("__l").cast("bigint").alias("n_lines"),
            F.size(F.filter("__w", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("bigint")
            .alias("n_stop_words"),
        ).alias("__m"))
    m = F.col("__m")
    ratio = lambda x, y: F.when(m[y] > 0, m[x] / m[y]).otherwise(F.lit(0.0))
    return e.select(*keep, F.struct(
        F.col("__m.*"), ratio("word_chars", "n_words").alias("mean_word_length"),
        ratio("n_symbols", "word_chars").alias("symbol_ratio"),
        ratio("n_stop_words", "n_words").alias("stop_word_ratio"),
        ratio("n_dup_lines", "n_lines").alias("dup_line_ratio")).alias("m"))


def base_failed(m: Column) -> Column:
    return ((m["n_words"] < MIN_WORDS)
            | (m["n_repeat_words"] * 100 > m["n_words"] * MAX_REPEAT_PERCENT))


def verdict(m: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The threshold table as one boolean expression."""
    ok = F.lit(True)
    for r in rules:
        if r.low is not None:
            ok = ok & (m[r.measure] >= r.low)
        if r.high is not None:
            ok = ok & (m[r.measure] <= r.high)
    return ok


def measure(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per document: all measures, ``base_failed`` and ``kept``."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    e = with_measures(d, F.col("__text")).select("doc_id", "m")
    return e.select("doc_id", "m.*", base_failed(F.col("m")).alias("base_failed"),
                    (~base_failed(F.col("m")) & verdict(F.col("m"), rules)).alias("kept"))


def filter_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES,
                     text_col: str = "text") -> DataFrame:
    """The documents that the rules keep, with all their columns as they were."""
    d = docs.select(F.struct("*").alias("__row"))
    e = with_measures(d, F.col("__row")[text_col])
    return (e.where(~base_failed(F.col("m")) & verdict(F.col("m"), rules))
            .select("__row.*"))
