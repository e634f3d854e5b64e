"""Quality rules, with DataFrame functions only.

Method: a table of thresholds is compiled into one projection of length, symbol, stop-word and line ratios.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.linking import filter_here

WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

#: Frequent function words of the four languages (fixed values).
STOP_WORDS = (
    "the of and to in is was for that with he it on as be at by are this "
    "die der und zu den das nicht von sie ist des sich mit dem im es ein auf für eine "
    "le la de et les un une du que est pour dans qui par el los se del las con su para al lo"
).split()


class Rule(NamedTuple):
    """``low * part <= 100 * whole <= high * part`` for two measures; a side that is None is open."""

    name: str
    whole: str
    part: str
    low: int | None
    high: int | None


#: Percentages; 100 * whole is compared with bound * part in whole numbers.
RULES = (
    Rule("word_length", "word_chars", "n_words", 250, 1200),
    Rule("symbols", "n_symbols", "n_words", None, 10),
    Rule("stop_words", "n_stop_words", "n_words", 5, None),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 50),
    Rule("line_length", "n_words", "n_lines", 200, None),
)


def compile_rules(rules=RULES) -> Column:
    """One boolean column: every rule holds."""
    verdict = F.lit(True)
    for r in rules:
        whole = F.col(r.whole) * 100
        if r.low is not None:
            verdict &= whole >= F.col(r.part) * r.low
        if r.high is not None:
            verdict &= whole <= F.col(r.part) * r.high
    return verdict


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds a struct ``q`` of whole numbers to each row: the measures the rules name, and n_repeat_words.

    Words are runs of other than ASCII white space. n_repeat_words counts words inside windows of three words
    that occur twice or more in the text. Everything is computed within the row; the windows are told apart by
    64-bit hashes and sorted only where two of them agree.
    """
    names = {"n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stop_words", "n_repeat_words"}
    text_col = F.coalesce(F.col(text), F.lit(""))
    body = F.col("__q.body")
    df = docs.withColumn(
        "__q",
        F.struct(
            text_col.alias("body"),
            F.array_remove(F.split(text_col, WORD_BREAK), "").alias("words"),
            F.filter(F.split(text_col, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        ),
    )
    words, n = F.col("__q.words"), F.size("__q.words")
    window = lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))
    grams = F.when(n >= 3, F.slice(F.transform(words, window), F.lit(1), n - 2)).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn(
        "__m",
        F.struct(
            n.cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(body, "[^" + SYMBOLS.replace("&", r"\&") + "]+", "")).cast("long").alias("n_symbols"),
            F.size("__q.lines").cast("long").alias("n_lines"),
            (F.size("__q.lines") - F.size(F.array_distinct("__q.lines"))).cast("long").alias("n_dup_lines"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
            grams.alias("grams"),
        ),
    )
    grams = F.col("__m.grams")
    placed = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    df = df.withColumn("__s", F.when(F.size(F.array_distinct(grams)) < F.size(grams), placed))
    same = lambda e, j: (F.get("__s", j - 1)["g"] == e["g"]) | (F.get("__s", j + 1)["g"] == e["g"])
    twice = F.sort_array(F.transform(F.filter("__s", lambda e, j: F.coalesce(same(e, j), F.lit(False))), lambda e: e["i"]))
    covered = F.aggregate(
        twice,
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(3), x - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    kept = [F.col(f"__m.{c}").alias(c) for c in sorted(names - {"n_repeat_words"})]
    return df.withColumn(
        "q", F.struct(*kept, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))
    ).drop("__q", "__m", "__s")


def judge(docs: DataFrame, rules=RULES, min_words: int = 50, max_repeat_pct: int = 50) -> DataFrame:
    """Every row with its measures, base_failed and kept: doc_id, n_words ... kept.

    base_failed: fewer than ``min_words`` words, or more than ``max_repeat_pct`` percent of them in repeated
    windows. kept: not base_failed and every rule holds. NULL text has no words and so fails; repeated rows are judged
    one by one; other columns are ignored; an empty table gives no rows. Nothing is shuffled.
    """
    df = measures(docs.select("doc_id", "text")).select("doc_id", "q.*")
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_pct)
    return df.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & compile_rules(rules))


def keep_good(docs: DataFrame, rules=RULES, min_words: int = 50, max_repeat_pct: int = 50) -> DataFrame:
    """The rows, with their own columns, that ``judge`` keeps."""
    df = measures(docs.select(F.struct("*").alias("row"), F.col("text").alias("text")))
    fine = (F.col("n_words") >= min_words) & (F.col("n_repeat_words") * 100 <= F.col("n_words") * max_repeat_pct)
    return filter_here(df.select("row", "q.*"), fine & compile_rules(rules)).select("row.*")
