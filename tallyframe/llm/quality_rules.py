"""Line-first cleaning with DataFrame functions only.

Each line is judged by itself: marks (runs of symbols instead of punctuation),
punctuation (many words without any), navigation (separators between few
words) and boilerplate (fixed phrases).  Failing lines are removed, and a
document that loses too large a share of its words is rejected, as is one that
fails the base rules: too few words, or mostly words in repeated three-word
windows.

Everything is computed within a row, so there is no shuffle and nothing grows
with the size of a group.

Defined results: null text has no words and fails the base rules; ids may be
null or repeat; each input row gives one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
#: Largest share of a document's words that may stand in removed lines.
MAX_LOSS = 0.4
#: Share of a line's words that may carry a run of symbols.
MAX_MARKED = 0.25
#: Words without any punctuation that a line may have.
MAX_UNPUNCTUATED = 20
#: Separators for each word of a line, from which it is navigation.
MAX_SEPARATED = 0.3
#: Phrases of page furniture, in lower case.
BOILERPLATE = (
    "accept all cookies",
    "all rights reserved",
    "click here",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "share on facebook",
    "sign up for our newsletter",
    "terms of use",
)


def _without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _count(text: Column, characters: str) -> Column:
    """How many of some ASCII characters stand in ``text``."""
    return (F.octet_length(text) - F.octet_length(_without(text, characters))).cast("long")


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \t-\r]+"))


def _is(x: Column, wanted: str) -> Column:
    """1 where ``wanted`` is a rule that line ``x`` (text, n) breaks."""
    n, text = x["n"], x["text"]
    return {
        "marks": F.regexp_count(text, F.lit(r"[#*$%&|<>!]{2,}")) > MAX_MARKED * n,
        "punctuation": (n > MAX_UNPUNCTUATED) & ~text.rlike(r"[.,;:!?…。、！？]"),
        "navigation": (n >= 3) & (F.regexp_count(text, F.lit(r"[|»›·>]")) > MAX_SEPARATED * n),
        "boilerplate": F.lower(text).rlike("|".join(BOILERPLATE)),
    }[wanted]


def line_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(id, text, lines array<struct<text, n, failed>>)``; a line of no words never fails."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *[F.col(c).alias(f"keep{k}") for k, c in enumerate(keep)])
    counted = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("text"), F.size(_words(x)).alias("n")))
    rules = ("marks", "punctuation", "navigation", "boilerplate")

    def judged(x: Column) -> Column:
        bad = _is(x, rules[0])
        for rule in rules[1:]:
            bad = bad | _is(x, rule)
        return F.struct(x["text"].alias("text"), x["n"].alias("n"), ((x["n"] > 0) & bad).alias("failed"))

    return rows.withColumn("lines", counted).withColumn("lines", F.transform("lines", judged))


def base_counts(rows: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words to rows of ``text`` (not null)."""
    text = F.col("text")
    worded = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    rows = (
        rows.withColumn("words", _words(text))
        .withColumn("worded", worded)
        .withColumn("n_words", F.size("words").cast("long"))
        .withColumn("word_chars", F.length("text").cast("long") - _count(text, SPACE))
        .withColumn("n_symbols", _count(text, SYMBOLS))
        .withColumn("n_dup_lines", (F.size("worded") - F.size(F.array_distinct("worded"))).cast("long"))
        .drop("worded")
    )
    # windows as hashes: two different ones of a text count as equal with a chance of 2**-64 a pair
    window = lambda j: F.xxhash64(F.get("words", j), F.get("words", j + 1), F.get("words", j + 2))
    starts = F.when(F.col("n_words") >= 3, F.sequence(F.lit(0), F.col("n_words").cast("int") - 3)).otherwise(F.array().cast("array<int>"))
    rows = rows.withColumn("windows", F.transform(starts, window)).drop("words")
    # only texts in which a window repeats are sorted: equal windows then stand side by side
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda w, j: F.struct(w.alias("w"), j.alias("j"))))
    rows = rows.withColumn("sorted", F.when(repeats, placed)).drop("windows")
    beside = lambda x, k: x["w"].eqNullSafe(F.get("sorted", k)["w"])
    twice = F.filter("sorted", lambda x, k: beside(x, k - 1) | beside(x, k + 1))
    rows = rows.withColumn("at", F.sort_array(F.transform(twice, lambda x: x["j"]))).drop("sorted")
    covered = F.transform("at", lambda x, k: F.least(F.lit(3), F.coalesce(F.get("at", k + 1) - x, F.lit(3))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop("at")


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_loss: float = MAX_LOSS, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(id_col, keep..., text, counts, base_failed, lost_words, kept)``; ``text`` holds the lines that passed."""
    rows = base_counts(line_verdicts(docs, id_col, text_col, keep))
    lost = F.aggregate("lines", F.lit(0).cast("long"), lambda a, x: a + F.when(x["failed"], x["n"]).otherwise(0))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    passed = F.array_join(F.transform(F.filter("lines", lambda x: ~x["failed"]), lambda x: x["text"]), "\n")
    # a row number isn't deterministic, so a filter on the verdict stays above it; pushed
    # into the steps below, it would compute the windows anew for every word
    return (
        rows.withColumn("lost_words", lost)
        .withColumn("base_failed", base)
        .withColumn("row", F.monotonically_increasing_id())
        .select(
            F.col("id").alias(id_col),
            *[F.col(f"keep{k}").alias(c) for k, c in enumerate(keep)],
            passed.alias(text_col),
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "lost_words",
            ((F.col("row") >= 0) & ~F.col("base_failed") & (F.col("lost_words") <= max_loss * F.col("n_words"))).alias("kept"),
        )
    )


ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws, string_split(t, chr(10)) AS ls FROM d),
g AS (SELECT doc_id, unnest(range(0, greatest(len(ws) - 2, 0)::BIGINT)) AS j, ws FROM w),
h AS (SELECT doc_id, j, array_to_string(ws[j + 1:j + 3], ' ') AS x FROM g),
r AS (SELECT doc_id, j FROM h QUALIFY count(*) OVER (PARTITION BY doc_id, x) > 1),
c AS (SELECT doc_id, count(DISTINCT j + k) AS n FROM r, range(0, 3) AS s(k) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(ls) AS x FROM w),
m AS (SELECT doc_id, x, len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) AS n FROM l),
lost AS (
  SELECT doc_id, sum(CASE WHEN n > 0 AND (
      len(regexp_extract_all(x, '[#*$%&|<>!]{{2,}}')) > {MAX_MARKED} * n
      OR (n > {MAX_UNPUNCTUATED} AND NOT regexp_matches(x, '[.,;:!?…。、！？]'))
      OR (n >= 3 AND len(regexp_extract_all(x, '[|»›·>]')) > {MAX_SEPARATED} * n)
      OR regexp_matches(lower(x), '{"|".join(BOILERPLATE)}')) THEN n ELSE 0 END) AS lost,
    count(*) FILTER (n > 0) - count(DISTINCT x) FILTER (n > 0) AS dup
  FROM m GROUP BY doc_id),
f AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    dup::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words, lost
  FROM w JOIN lost USING (doc_id) LEFT JOIN c USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words) AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words) AND lost <= {MAX_LOSS} * n_words AS kept
FROM f
"""
