"""Document quality rules: a threshold table compiled into one projection.

Every count is a built-in expression over the row itself, so the whole operator is a
scan and a projection: no shuffle, no join, no user function.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BREAK = "[\\x20\\x09-\\x0D]+"
WORD_BREAK_CHARS = " \t\n\u000b\u000c\r"
SYMBOLS = "[#*$%&|<>]"
WINDOW_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# The commonest function words of the four languages.
STOP_WORDS = (
    "the of and to a in is it for on be at by are was as with this that from or an "
    "der die das und in zu den mit von ist ein eine für auf im nicht des dem sich als "
    "le la les de des et un une que qui dans en du par pour pas sur est au avec "
    "el los las del y una se por con para no es al su lo como más")


@dataclass(frozen=True)
class Threshold:
    """A ratio ``part / whole`` that must lie within ``[low, high]``; open ends are None."""

    name: str
    part: str
    whole: str
    low: float | None = None
    high: float | None = None

    def fails(self) -> Column:
        ratio = F.try_divide(F.col(self.part), F.col(self.whole))
        tests = [ratio < self.low] if self.low is not None else []
        tests += [ratio > self.high] if self.high is not None else []
        return F.coalesce(tests[0] if len(tests) == 1 else tests[0] | tests[1], F.lit(False))


THRESHOLDS = (
    Threshold("word_length", "word_chars", "n_words", 2.0, 15.0),
    Threshold("symbols", "n_symbols", "n_words", high=0.2),
    Threshold("stop_words", "n_stop_words", "n_words", low=0.02),
    Threshold("repeated_lines", "n_dup_lines", "n_lines", high=0.5),
    Threshold("words_per_line", "n_words", "n_lines", low=3.0),
)


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(windows: Column) -> Column:
    """Words that lie in a window whose hash stands twice or more in ``windows``."""
    def covered(starts: Column) -> Column:
        return F.aggregate(
            F.transform(starts, lambda at, i: F.least(
                F.lit(WINDOW_WORDS), F.coalesce(F.get(starts, i + 1) - at, F.lit(WINDOW_WORDS)))),
            F.lit(0).cast("long"), lambda total, n: total + n)

    def starts(ordered: Column) -> Column:
        same = F.filter(ordered, lambda x, i: F.coalesce(F.get(ordered, i - 1)["h"] == x["h"], F.lit(False))
                        | F.coalesce(F.get(ordered, i + 1)["h"] == x["h"], F.lit(False)))
        return F.sort_array(F.transform(same, lambda x: x["i"]))

    placed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    repeated = _let(F.sort_array(placed), lambda ordered: _let(starts(ordered), covered))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(repeated)


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts that rules are made of, one row per row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = F.btrim(text, F.lit(WORD_BREAK_CHARS))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(WORD_BREAK_CHARS)) != "")
    parts = docs.select(
        "doc_id",
        F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WORD_BREAK)).alias("words"),
        lines.alias("lines"),
        (F.char_length(text) - F.regexp_count(text, F.lit(WORD_BREAK[:-1]))).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
    stops = sorted(set(STOP_WORDS.split()))
    hashed = parts.select(
        "doc_id", "word_chars", "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(stops))).cast("long").alias("n_stop_words"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    long_enough = F.col("n_words") >= WINDOW_WORDS
    firsts = F.slice("hashes", F.lit(1), F.greatest(F.col("n_words") - (WINDOW_WORDS - 1), F.lit(0)).cast("int"))
    windows = F.when(long_enough, F.transform(firsts, lambda h, i: F.xxhash64(
        h, *[F.get(F.col("hashes"), i + k) for k in range(1, WINDOW_WORDS)]))).otherwise(
            F.array().cast("array<bigint>"))
    return hashed.withColumn("windows", windows).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        _repeat_words(F.col("windows")).alias("n_repeat_words"), "n_lines", "n_stop_words")


def judge(docs: DataFrame, thresholds: tuple[Threshold, ...] = THRESHOLDS) -> DataFrame:
    """Counts, base verdict and final verdict per row of ``docs`` (doc_id, text).

    A document fails the base rules with fewer than 20 words or over 30 in 100 of them in
    repeated windows; it is kept if it passes these and every threshold. Null and empty
    texts have no words and fail; a ratio over nothing fails no threshold. Rows, ids and
    further columns may repeat or be null: each row is judged by itself.
    """
    failed = F.concat_ws(",", *[F.when(t.fails(), F.lit(t.name)) for t in thresholds])
    base = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    judged = measured(docs).withColumns({"base_failed": base, "failed_rules": failed})
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("failed_rules") == "")).alias("kept"), "failed_rules",
        "n_lines", "n_stop_words")


def oracle_sql(thresholds: tuple[Threshold, ...] = THRESHOLDS) -> str:
    """The same rows in DuckDB SQL over ``documents``: windows by joining and grouping words."""
    stops = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS.split())))
    word, gap = r"'[^\x20\x09-\x0D]+'", r"'[\x20\x09-\x0D]'"

    def fails(t: Threshold) -> str:
        ratio = f"{t.part} / {t.whole}"
        tests = [f"{ratio} < {t.low}"] if t.low is not None else []
        tests += [f"{ratio} > {t.high}"] if t.high is not None else []
        return f"CASE WHEN {t.whole} > 0 AND ({' OR '.join(tests)}) THEN '{t.name}' END"

    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
p AS (SELECT rid, doc_id, text, regexp_extract_all(text, {word}) AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, {word})) AS lines FROM d),
pos AS (SELECT rid, words, unnest(generate_series(1, len(words) - {WINDOW_WORDS - 1})) AS i FROM p
        WHERE len(words) >= {WINDOW_WORDS}),
win AS (SELECT rid, i, array_to_string(words[i:i + {WINDOW_WORDS - 1}], ' ') AS w FROM pos),
twice AS (SELECT rid, w FROM win GROUP BY rid, w HAVING count(*) > 1),
hit AS (SELECT DISTINCT rid, unnest(generate_series(i, i + {WINDOW_WORDS - 1})) AS at
        FROM win JOIN twice USING (rid, w)),
rep AS (SELECT rid, count(*) AS n FROM hit GROUP BY rid),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words,
        (length(text) - length(regexp_replace(text, {gap}, 'x', 'g'))
         + length(regexp_replace(text, {gap}, '', 'g')))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '{SYMBOLS}', '', 'g')))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
        len(list_filter(words, lambda w: lower(w) IN ({stops})))::BIGINT AS n_stop_words
      FROM p LEFT JOIN rep USING (rid)),
j AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
        concat_ws(',', {', '.join(fails(t) for t in thresholds)}) AS failed_rules FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, failed_rules, n_lines, n_stop_words FROM j"""
