"""Quality rules with adaptive thresholds: quantile sketches per language and source.

Measures of each text are computed in its row by built-in expressions and written once, without
the text. Documents that pass the fixed base rule feed KLL sketches, one per language, source
and measure; sketches of a language are merged from those of its sources. A bound is
`upper quartile + SPREAD * max(quartile range, slack)`, for word length also downwards. The
bounds of a source are drawn to those of its language as if the language had `PRIOR_ROWS` more
rows in it, so that small sources need no rule of their own. A document is kept if it passes the
base rule and every bound of its language and source.

Null or empty texts have no words and fail the base rule. Null languages and sources are groups
of their own. Equal rows get equal results. An empty table gives an empty one. Other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costwatch.llm.words import SPARK_WORD
from costwatch.staging import stage

BLANK = r"[\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 5
SKETCH_K = 1024
SPREAD = 3.0
PRIOR_ROWS = 10
#: Ratios and the least quartile range that their bounds assume.
SLACK = {
    "symbol_ratio": 0.05,
    "shout_ratio": 0.05,
    "dup_line_ratio": 0.15,
    "repeat_ratio": 0.04,  # three times this must lie below the 20 % of the base rule
    "word_length": 1.0,
}


def _no_longs() -> Column:
    return F.array().cast("array<bigint>")


def window_hashes(words: str) -> Column:
    """Hashes of all runs of five words of an array column."""
    at = [lambda i, k=k: F.get(F.col(words), i + k) for k in range(WINDOW)]
    return F.when(
        F.size(words) >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - WINDOW),
            lambda i: F.xxhash64(*[part(i) for part in at]),
        ),
    ).otherwise(_no_longs())


def measures(documents: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of each text; no column of text is left.

    Written once: a filter on a count would else be pushed below the projections, and the
    whole expression of the count with it, evaluated anew for every window of a text.
    """
    text = F.coalesce("text", F.lit(""))
    worded = documents.select(
        "doc_id",
        "lang",
        "source",
        text.alias("_text"),
        F.array_remove(F.split(text, BLANK + "+"), "").alias("_words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(SPARK_WORD)).alias("_lines"),
    )
    counted = worded.select(
        "doc_id",
        "lang",
        "source",
        F.size("_words").cast("long").alias("n_words"),
        (F.length("_text") - F.regexp_count("_text", F.lit(BLANK))).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        F.regexp_count("_text", F.lit("!")).cast("long").alias("n_shouts"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        window_hashes("_words").alias("_windows"),
    )
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    ordered = F.sort_array(
        F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )
    beside = [lambda i, k=k: F.get(F.col("_sorted"), i + k)["h"] for k in (-1, 1)]
    places = F.sort_array(
        F.transform(
            F.filter(
                "_sorted",
                lambda p, i: F.coalesce(beside[0](i) == p["h"], F.lit(False))
                | F.coalesce(beside[1](i) == p["h"], F.lit(False)),
            ),
            lambda p: p["i"],
        )
    )
    reach = F.aggregate(
        "_places",
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda s, p: F.struct(
            (s["n"] + F.least(F.lit(WINDOW), p - s["last"])).alias("n"), p.alias("last")
        ),
        lambda s: s["n"].cast("long"),
    )
    placed = (
        counted.withColumn("_sorted", F.when(repeated, ordered))
        .withColumn("_places", F.when(F.col("_sorted").isNotNull(), places))
        .withColumn("n_repeat_words", F.coalesce(reach, F.lit(0).cast("long")))
    )
    return stage(placed.drop("_windows", "_sorted", "_places"), "rule_measures")


def with_ratios(counts: DataFrame) -> DataFrame:
    """Ratios that do not depend on the length of the text, and the verdict of the base rule."""
    words = F.greatest("n_words", F.lit(1))
    return counts.withColumns(
        {
            "base_failed": (F.col("n_words") < 10)
            | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20),
            "symbol_ratio": F.col("n_symbols") / words,
            "shout_ratio": F.col("n_shouts") / words,
            "dup_line_ratio": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
            "repeat_ratio": F.col("n_repeat_words") / words,
            "word_length": F.col("word_chars") / words,
        }
    )


def source_sketches(rated: DataFrame) -> DataFrame:
    """Per language and source: number of passing documents and a sketch of each ratio."""
    return (
        rated.filter(~F.col("base_failed"))
        .groupBy("lang", "source")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.kll_sketch_agg_double(c, SKETCH_K).alias(c) for c in SLACK],
        )
    )


def _fences(sketches: DataFrame, keys: list[str], suffix: str) -> DataFrame:
    def quantile(name: str, rank: float) -> Column:
        return F.kll_sketch_get_quantile_double(name, F.lit(rank))

    columns = []
    for name, slack in SLACK.items():
        low, high = quantile(name, 0.25), quantile(name, 0.75)
        reach = F.greatest(high - low, F.lit(slack)) * SPREAD
        columns.append((high + reach).alias(f"{name}_most{suffix}"))
        if name == "word_length":
            columns.append((low - reach).alias(f"{name}_least{suffix}"))
    return sketches.select(*keys, *(["n"] if "source" in keys else []), *columns)


def thresholds(sketches: DataFrame) -> DataFrame:
    """Bounds per language and source; `sketches` may be merged from several runs' tables."""
    by_lang = sketches.groupBy("lang").agg(
        *[F.kll_merge_agg_double(c, SKETCH_K).alias(c) for c in SLACK]
    )
    own = _fences(sketches, ["lang", "source"], "_own")
    wide = _fences(by_lang, ["lang"], "_all").withColumnRenamed("lang", "_lang")
    names = [f"{c}_most" for c in SLACK] + ["word_length_least"]
    blend = [
        (
            (F.col(f"{c}_own") * F.col("n") + F.col(f"{c}_all") * PRIOR_ROWS) / (F.col("n") + PRIOR_ROWS)
        ).alias(c)
        for c in names
    ]
    joined = own.join(wide, F.col("lang").eqNullSafe(F.col("_lang")))
    return joined.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), *blend)


def judge(documents: DataFrame) -> DataFrame:
    """Counts of every document with base_failed, its bounds and `kept`."""
    rated = with_ratios(measures(documents))
    bounds = thresholds(stage(source_sketches(rated), "rule_sketches"))
    joined = rated.join(
        bounds,
        F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")),
        "left",
    )
    within = F.col("word_length") >= F.col("word_length_least")
    for name in SLACK:
        within = within & (F.col(name) <= F.col(f"{name}_most"))
    kept = ~F.col("base_failed") & F.coalesce(within, F.lit(True))
    return joined.withColumn("kept", kept).drop("_lang", "_source")


def rule_digest(documents: DataFrame) -> DataFrame:
    return judge(documents).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )
