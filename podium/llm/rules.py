"""Quality rules: one threshold table compiled into a Spark projection.

A rule bounds a ratio of two counts of a text (both ends in thousandths, so
all arithmetic is on integers). The counts are column expressions over the
text, its words and its lines; the table compiles into one flag per rule. No
exchange and no user function: a text is read once, where it lies.

Words that stand in a repeated five-word window are found by hash first: a
text without two equal window hashes has none. Only windows whose hash occurs
again are compared as words, sorted, so equal hashes alone decide nothing and
the work is n log n in the words of a text.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, free_names

BLANK = r"[\x20\x09-\x0D]"
WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20

#: Common function words of the four languages of the tables.
STOP_WORDS = (
    "the", "of", "and", "to", "a", "in", "is", "that", "for", "it", "was", "on", "with", "as", "this", "by", "are", "be",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht", "eine", "ein",
    "de", "la", "le", "et", "les", "en", "un", "du", "une", "que", "pour", "est", "dans", "qui", "par", "au", "sur", "pas", "avec",
    "el", "y", "los", "se", "las", "del", "por", "con", "no", "una", "su", "para", "al", "es", "lo")

#: A function word may carry one full stop or comma.
STOP_FORMS = tuple(w + mark for w in STOP_WORDS for mark in ("", ".", ","))
BULLET = rf"^{BLANK}*[-*•]"
ELLIPSIS = rf"\.\.\.{BLANK}*\z"


@dataclass(frozen=True)
class Rule:
    """``low <= 1000 * part / whole <= high``; an open end is None, and a whole
    of 0 passes."""
    name: str
    part: str
    whole: str
    low: int | None = None
    high: int | None = None


#: The threshold table: lengths, symbols, stop words, lines.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 2000, 12000),
    Rule("symbols_per_word", "n_symbols", "n_words", None, 100),
    Rule("exclamations_per_word", "n_exclaims", "n_words", None, 300),
    Rule("stop_words", "n_stop_words", "n_words", 40, None),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 300),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", None, 900),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 300),
)


def failures(rules=RULES) -> Column:
    """The names of the rules that a row of counts fails."""
    def broken(r: Rule) -> Column:
        part, whole = F.col(r.part) * 1000, F.col(r.whole)
        low = F.lit(False) if r.low is None else part < whole * r.low
        high = F.lit(False) if r.high is None else part > whole * r.high
        return F.when((whole > 0) & (low | high), F.lit(r.name))
    return F.array_compact(F.array(*[broken(r) for r in rules]))


def counts(texts: DataFrame, text: str) -> DataFrame:
    """Adds the counts that rules and base filter read, from the never-null
    column ``text``; helper columns (all starting with ``__``) are left to the caller."""
    words = F.array_remove(F.split(F.col(text), rf"{BLANK}+"), "")
    lines = F.filter(F.split(F.col(text), "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    at = lambda c, i: F.get(c, i)
    w = F.col("__words")
    window = lambda i: [at(w, i + k) for k in range(WINDOW)]
    no_hit = F.array().cast("array<struct<h:bigint,i:int>>")
    again = lambda rows, field: F.filter(rows, lambda x, j: F.coalesce(
        x[field] == at(rows, j - 1)[field], F.lit(False)) | F.coalesce(x[field] == at(rows, j + 1)[field], F.lit(False)))
    staged = texts.withColumns({"__words": words, "__lines": lines})
    staged = staged.withColumn("__hashes", F.transform(
        F.slice(w, 1, F.greatest(F.size(w) - (WINDOW - 1), F.lit(0))), lambda _, i: F.xxhash64(*window(i))))
    staged = staged.withColumn("__sorted", F.when(
        F.size(F.array_distinct("__hashes")) < F.size("__hashes"), F.sort_array(F.transform(
            F.col("__hashes"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(no_hit))
    # equal hashes are candidates only: from here on the words themselves decide
    staged = staged.withColumn("__windows", F.sort_array(F.transform(
        again(F.col("__sorted"), "h"), lambda x: F.struct(F.concat_ws(" ", *window(x["i"])).alias("t"), x["i"].alias("i")))))
    staged = staged.withColumn("__starts", F.sort_array(F.transform(again(F.col("__windows"), "t"), lambda x: x["i"])))
    covered = F.aggregate(F.transform(F.col("__starts"), lambda s, j: F.least(
        F.lit(WINDOW), F.coalesce(at(F.col("__starts"), j + 1) - s, F.lit(WINDOW)))), F.lit(0).cast("long"), lambda a, b: a + b)
    gone = lambda pattern: F.length(F.col(text)) - F.length(F.regexp_replace(F.col(text), pattern, ""))
    n = lambda c: F.size(c).cast("long")
    return staged.select(
        *texts.columns, n(w).alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        gone("[#*$%&|<>]").cast("long").alias("n_symbols"), n("__lines").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"), gone("!").cast("long").alias("n_exclaims"),
        n(F.filter(w, lambda x: F.lower(x).isin(*STOP_FORMS))).alias("n_stop_words"),
        n(F.filter(F.col("__lines"), lambda s: s.rlike(BULLET))).alias("n_bullet_lines"),
        n(F.filter(F.col("__lines"), lambda s: s.rlike(ELLIPSIS))).alias("n_ellipsis_lines"))


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """``doc_id``, the five base counts, ``base_failed``, ``kept`` and
    ``failed_rules`` (names, empty for a text that passes) per row.

    Null counts as empty; a text without words has counts of 0, fails the base
    filter and is not kept. Each row is judged alone, so repeated ids, null ids
    and equal texts each keep their row, and other columns cannot clash. An
    empty table gives an empty result. A text is one array in one task: its
    cost is n log n in its own words, whatever the table holds.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)
    judged = counts(texts, "__text").select("doc_id", *_COUNTS, base.alias("base_failed"), failures(rules).alias("failed_rules"))
    return judged.select("doc_id", *_COUNTS, "base_failed",
                         (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"), "failed_rules")


def keep_quality(docs: DataFrame, text_col: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``docs`` that pass base filter and rules, columns untouched
    (the text is judged beside its row, so no join and no id is needed)."""
    row, = free_names(docs, "__row")
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row),
                       F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    judged = counts(held, "__text").where(
        (F.col("n_words") >= MIN_WORDS) & (F.col("n_repeat_words") * 100 <= F.col("n_words") * REPEAT_PERCENT)
        & (F.size(failures(rules)) == 0))
    return judged.select(f"`{row}`.*")


def op11_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir)).select(
        "doc_id", *_COUNTS, "base_failed", "kept", F.concat_ws(",", "failed_rules").alias("failed_rules"))


def _rule_sql(r: Rule) -> str:
    ends = ([] if r.low is None else [f"{r.part} * 1000 < {r.whole} * {r.low}"]) + (
        [] if r.high is None else [f"{r.part} * 1000 > {r.whole} * {r.high}"])
    return f"CASE WHEN {r.whole} > 0 AND ({' OR '.join(ends)}) THEN '{r.name}' END"


_STOP_SQL = ", ".join(f"'{w}'" for w in STOP_FORMS)
SQL = {"op11_rules": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
     w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
                  list_filter(string_split(t, chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS ls FROM d),
     p AS (SELECT doc_id, unnest(ws) AS v, generate_subscripts(ws, 1) AS i FROM w),
     q AS (SELECT doc_id, i, v || ' ' || lead(v, 1) OVER o || ' ' || lead(v, 2) OVER o || ' ' || lead(v, 3) OVER o || ' '
                  || lead(v, 4) OVER o AS five FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
     x AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, five) AS n FROM q WHERE five IS NOT NULL),
     s AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM x WHERE n > 1),
     r AS (SELECT doc_id, sum(least(5, coalesce(next - i, 5))) AS n_repeat_words FROM s GROUP BY doc_id),
     c AS (SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
                  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                  len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
                  CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, length(t) - length(replace(t, '!', '')) AS n_exclaims,
                  len(list_filter(ws, lambda x: lower(x) IN ({_STOP_SQL}))) AS n_stop_words,
                  len(list_filter(ls, lambda s: regexp_matches(s, '{BULLET}'))) AS n_bullet_lines,
                  len(list_filter(ls, lambda s: regexp_matches(s, '{ELLIPSIS}'))) AS n_ellipsis_lines
           FROM w LEFT JOIN r USING (doc_id)),
     f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
                  concat_ws(',', {', '.join(_rule_sql(r) for r in RULES)}) AS failed_rules FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, failed_rules FROM f"""}
QUERIES = {"op11_rules": op11_rules}
