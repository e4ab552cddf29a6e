"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

`measure` gives the base counts of a text, `ratios` the measures a threshold can name, `compile_rules` turns a table of
(measure, low, high) into one boolean column. No user function, join or shuffle is involved, so the work is a map over
the scan and a long text costs n log n.

Repeated words: the hash of each 3-word window and its position are sorted together, so equal windows are neighbours;
the positions of those windows are sorted again, and each adds the words up to the next one, three at most.

Scope: the stop-word rule knows English, French, German and Spanish in lower case. Clean texts in other languages, and texts
wholly in capitals, fail it.

Defined results: null, empty and white-space texts have no words, all counts 0, and fail the base rule; every row is
judged by itself, so repeated rows and ids get equal results and null ids stay; an empty table gives none; columns of
the input are kept, and the added ones go under `prefix`.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourweave.llm.common import WORD, col, fresh

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "a an and are as at be but by for from have he his i in is it not of on or she that the their they this to was were which with you "
    "au aux avec ce dans de des du elle en est et il je la le les mais ne nous on ou par pas pour que qui sa se son sur un une vous "
    "aber als am an auf aus bei das dem den der des die ein eine einer er es für hat ich im in ist mit nach nicht sich sie sind über und von war wie wir zu zum zur "
    "al como con de del el en era es esta este ha la las lo los más no para pero por que se sin son su sus un una y"
).split()


class Rule(NamedTuple):
    """A document fails if `measure` is below `low` or above `high`; None is no limit."""

    measure: str
    low: float | None
    high: float | None


#: Production thresholds. Lengths and ratios follow the published rules for web corpora.
RULES = (
    Rule("mean_word_chars", 2.0, 12.0),
    Rule("symbol_ratio", None, 0.1),
    Rule("stop_word_ratio", 0.02, None),
    Rule("upper_ratio", None, 0.4),
    Rule("dup_line_ratio", None, 0.4),
    Rule("bullet_line_ratio", None, 0.9),
    Rule("ellipsis_line_ratio", None, 0.3),
)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def measure(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """Adds `n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words` and the counts that the ratios need."""
    p = prefix
    whole = F.coalesce(col(text).cast("string"), F.lit(""))
    words, lines, windows, repeats = (fresh(p + x, docs.columns) for x in ("words__", "lines__", "windows__", "repeats__"))
    with_word = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    df = docs.withColumns({words: F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)), lines: with_word})
    w = col(words)
    n = F.size(w)
    hashed = F.transform(
        F.slice(w, 1, F.greatest(n - 2, F.lit(0))),
        lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")),
    )
    df = df.withColumn(windows, F.sort_array(hashed))
    g = col(windows)
    found_twice = F.filter(g, lambda x, i: (F.get(g, i - 1)["h"] == x["h"]) | (F.get(g, i + 1)["h"] == x["h"]))
    df = df.withColumn(repeats, F.sort_array(F.transform(found_twice, lambda x: x["i"])))
    r = col(repeats)
    nobody = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
    covered = F.aggregate(
        r, nobody, lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")), lambda acc: acc["n"])
    stop = [F.lit(x) for x in sorted(set(STOP_WORDS))]
    line = col(lines)
    return df.select(
        *[col(c) for c in docs.columns],
        n.cast("long").alias(p + "n_words"),
        F.length(F.array_join(w, "")).cast("long").alias(p + "word_chars"),
        F.length(F.regexp_replace(whole, r"[^#*$%&|<>]+", "")).cast("long").alias(p + "n_symbols"),
        (F.size(line) - F.size(F.array_distinct(line))).cast("long").alias(p + "n_dup_lines"),
        # not deterministic for the optimizer: else a filter on the verdict is moved below the arrays it is made from and
        # evaluates them again for every word
        F.when(F.monotonically_increasing_id() >= 0, covered.cast("long")).alias(p + "n_repeat_words"),
        F.size(F.filter(w, lambda x: x.isin(*stop))).cast("long").alias(p + "n_stop_words"),
        F.length(F.regexp_replace(whole, r"[^\p{Lu}]+", "")).cast("long").alias(p + "n_upper"),
        F.size(line).cast("long").alias(p + "n_lines"),
        F.size(F.filter(line, lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•]"))).cast("long").alias(p + "n_bullet_lines"),
        F.size(F.filter(line, lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))).cast("long").alias(p + "n_ellipsis_lines"),
    )


def ratios(prefix: str = "") -> dict[str, Column]:
    """The measures that a rule can name. A ratio of nothing is null, and null breaks no rule."""

    def share(a: str, b: str) -> Column:
        return col(prefix + a) / F.nullif(col(prefix + b), F.lit(0))

    return {
        "n_words": col(prefix + "n_words").cast("double"),
        "mean_word_chars": share("word_chars", "n_words"),
        "symbol_ratio": share("n_symbols", "n_words"),
        "stop_word_ratio": share("n_stop_words", "n_words"),
        "upper_ratio": share("n_upper", "word_chars"),
        "dup_line_ratio": share("n_dup_lines", "n_lines"),
        "bullet_line_ratio": share("n_bullet_lines", "n_lines"),
        "ellipsis_line_ratio": share("n_ellipsis_lines", "n_lines"),
        "repeat_ratio": share("n_repeat_words", "n_words"),
    }


def compile_rules(rules: Sequence[Rule] = RULES, prefix: str = "") -> Column:
    """True where a rule is broken."""
    known = ratios(prefix)
    broken = F.lit(False)
    for rule in rules:
        value = known[rule.measure]
        for limit, outside in ((rule.low, lambda v, x: v < x), (rule.high, lambda v, x: v > x)):
            if limit is not None:
                broken = broken | F.coalesce(outside(value, F.lit(float(limit))), F.lit(False))
    return broken


#: Names that `judge` adds.
ADDED = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_upper", "n_lines", "n_bullet_lines", "n_ellipsis_lines",
    "base_failed", "kept")


def free_prefix(docs: DataFrame, prefix: str = "") -> str:
    """`prefix`, after as many underscores as no added name needs to clash with a column."""
    have = {c.lower() for c in docs.columns}
    while any((prefix + name).lower() in have for name in ADDED):
        prefix = "_" + prefix
    return prefix


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", prefix: str = "") -> DataFrame:
    """`docs` with the counts of `measure`, `base_failed` and `kept`.

    Where a column of `docs` has one of these names, underscores go in front of all the added ones (see `free_prefix`).
    """
    p = free_prefix(docs, prefix)
    measured = measure(docs, text, p)
    n, repeats = col(p + "n_words"), col(p + "n_repeat_words")
    base = (n < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n)
    return measured.withColumn(p + "base_failed", base).withColumn(p + "kept", ~(col(p + "base_failed") | compile_rules(rules, p)))


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The rows of `docs` that break no rule, with their own columns only."""
    prefix = free_prefix(docs, "rule__")
    return judge(docs, rules, text, prefix).where(col(prefix + "kept")).select(*[col(c) for c in docs.columns])


def rules_sql(rules: Sequence[Rule] = RULES) -> str:
    """The same verdict as DuckDB SQL over `documents`."""
    tests = " OR ".join(
        f"coalesce({r.measure} {op} {limit!r}, false)" for r in rules for op, limit in (("<", r.low), (">", r.high)) if limit is not None)
    stop = ", ".join("'" + w + "'" for w in sorted(set(STOP_WORDS)))
    space = r"[\x20\x09-\x0D]"
    return rf"""
WITH split AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
word AS (SELECT row, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM split),
three AS (SELECT row, i, w AS w1, lead(w, 1) OVER s AS w2, lead(w, 2) OVER s AS w3 FROM word WINDOW s AS (PARTITION BY row ORDER BY i)),
twice AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, w1, w2, w3) AS n FROM three WHERE w3 IS NOT NULL) WHERE n > 1),
covered AS (SELECT row, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS t(k) GROUP BY row),
counted AS (
  SELECT doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
         len(list_filter(words, lambda x: x IN ({stop}))) AS n_stop_words,
         length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) AS n_upper, len(lines) AS n_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '^{space}*[-*•]'))) AS n_bullet_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…){space}*$'))) AS n_ellipsis_lines
  FROM split LEFT JOIN covered USING (row)),
shares AS (
  SELECT *, word_chars / nullif(n_words, 0) AS mean_word_chars, n_symbols / nullif(n_words, 0) AS symbol_ratio,
         n_stop_words / nullif(n_words, 0) AS stop_word_ratio, n_upper / nullif(word_chars, 0) AS upper_ratio,
         n_dup_lines / nullif(n_lines, 0) AS dup_line_ratio, n_bullet_lines / nullif(n_lines, 0) AS bullet_line_ratio,
         n_ellipsis_lines / nullif(n_lines, 0) AS ellipsis_line_ratio, n_repeat_words / nullif(n_words, 0) AS repeat_ratio,
         (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed
  FROM counted)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT (base_failed OR {tests}) AS kept
FROM shares"""
