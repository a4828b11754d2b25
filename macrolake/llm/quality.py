"""Quality rules as a short-circuit cascade, in built-in expressions only.

A rule rejects a row. On a bounded sample every rule is timed and its rejections
are counted; rules run in the order of rejections per second, as branches of
one ``CASE`` that hold the measures which only they need, so a rule is evaluated,
and its measures are taken, only for rows that all rules before it let pass.
The order changes the cost, not the verdict.

Rows: a null or empty text has no words and fails. Repeated rows are judged
each. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import time
from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of the sample, about; only the order of the rules depends on it.
SAMPLE_ROWS = 500
#: Seconds below which rules count as equally cheap.
LEAST_SECONDS = 0.01
#: Seconds from which a rule is timed only once.
PLAIN_SECONDS = 0.5
#: Fixed: the symbols that are counted, and the characters between words.
SYMBOLS, SPACES = "#*$%&|<>", "\\t\\n\\u000B\\u000C\\r"


@dataclass(frozen=True)
class Rule:
    """``rejects`` is an SQL condition over the measures."""

    name: str
    rejects: str


#: The default rules, over MEASURES. The first two are the base of the contract.
RULES = (
    Rule("too_few_words", "n_words < 10"),
    Rule("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("shouting", "n_letters_upper > n_letters - n_letters_upper AND n_letters >= 20"),
    Rule("odd_word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines AND n_lines >= 4"),
)
BASE = ("too_few_words", "repeated_windows")

_LINES = "filter(split(body, '\\n'), x -> translate(x, ' {s}', '') <> '')".replace("{s}", SPACES)

#: Measures in SQL over ``body``, the text, and ``words``, its words.
MEASURES = {
    "n_words": "CAST(size(words) AS LONG)",
    "word_chars": f"CAST(length(translate(body, ' {SPACES}', '')) AS LONG)",
    "n_symbols": f"CAST(length(body) - length(translate(body, '{SYMBOLS}', '')) AS LONG)",
    "n_lines": f"CAST(size({_LINES}) AS LONG)",
    "n_dup_lines": f"aggregate(array({_LINES}), 0L, (a, x) -> CAST(size(x) - size(array_distinct(x)) AS LONG))",
    "n_letters": "CAST(length(regexp_replace(body, '[^A-Za-z]+', '')) AS LONG)",
    "n_letters_upper": "CAST(length(regexp_replace(body, '[^A-Z]+', '')) AS LONG)",
}

#: Words in 5-word windows that occur twice or more. If no hash of a window occurs twice, no window does; otherwise the
#: windows themselves are sorted, those equal to a neighbour are kept, and the words from each to the next are counted.
#: The words are bound to the variable ``w`` once, so that an optimizer that moves this expression cannot repeat the split.
_HASHES = "transform(sequence(5, size(w)), i -> xxhash64(w[i - 5], w[i - 4], w[i - 3], w[i - 2], w[i - 1]))"
_SORTED = "array_sort(transform(sequence(0, size(w) - 5), i -> struct(concat_ws(' ', slice(w, i + 1, 5)) AS g, i AS i)))"
_TWICE = (
    "filter(transform(sequence(0, size(s) - 1), k -> CASE WHEN (k > 0 AND s[greatest(k - 1, 0)].g = s[k].g)"
    " OR (k < size(s) - 1 AND s[least(k + 1, size(s) - 1)].g = s[k].g) THEN s[k].i END), x -> x IS NOT NULL)"
)
_COVERED = "aggregate(array_sort(t), struct(0L AS n, -5 AS last), (a, x) -> struct(a.n + least(5, x - a.last) AS n, x AS last), a -> a.n)"
N_REPEAT_WORDS = (
    "aggregate(array(words), 0L, (z, w) -> CASE WHEN size(w) < 6 THEN 0L"
    f" WHEN aggregate(array({_HASHES}), true, (a, h) -> size(array_distinct(h)) = size(h)) THEN 0L"
    f" ELSE aggregate(array({_SORTED}), 0L, (a, s) -> a + aggregate(array({_TWICE}), 0L, (b, t) -> b + {_COVERED})) END)"
)


MEASURES["n_repeat_words"] = N_REPEAT_WORDS
#: The measures that judge() reports, so that it takes them of every row.
REPORTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def words_of(body: str) -> str:
    """The words of a text, in SQL."""
    flat = f"trim(translate({body}, '{SPACES}', '     '))"
    return f"CASE WHEN {flat} = '' THEN array() ELSE split({flat}, ' +') END"


def with_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, body, words)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    return rows.withColumn("words", F.expr(words_of("body")))


def measures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", names: tuple[str, ...] = tuple(MEASURES)) -> DataFrame:
    """doc_id, the text, its words and the named measures."""
    return with_words(docs, doc_id, text).select("*", *(F.expr(MEASURES[n]).alias(n) for n in names))


def condition(rule: Rule, known: Collection[str] = ()) -> str:
    """The rule's condition in SQL over ``body`` and ``words``; measures that are not known as columns are taken in it, once each."""
    own = [n for n in MEASURES if n not in known and re.search(rf"\b{n}\b", rule.rejects)]
    if not own:
        return rule.rejects
    bound = re.sub(rf"\b({'|'.join(own)})\b", r"m.\1", rule.rejects)
    return f"exists(array(struct({', '.join(f'{MEASURES[n]} AS {n}' for n in own)})), m -> {bound})"


def verdict(rules: Collection[Rule], known: Collection[str] = ()) -> str:
    """The name of the first rule that rejects, or null, in SQL: a rule is evaluated in its own branch, so only if all before it pass."""
    if not rules:
        return "CAST(NULL AS STRING)"
    branches = " ".join(f"WHEN {condition(r, known)} THEN '{r.name}'" for r in rules)
    return f"CASE {branches} END"


def cascade(rows: DataFrame, rules: Collection[Rule]) -> DataFrame:
    """The rows with the first rule that rejects each, null if none does; they hold ``body`` and ``words``, or all measures that the rules name."""
    return rows.withColumn("rejected_by", F.expr(verdict(rules, rows.columns)))


def cheapest_first(docs: DataFrame, rules: Collection[Rule] = RULES, doc_id: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejections per second on a sample of about ``rows`` rows.

    A rule's seconds are those of a run over the sample, or the shorter of two if
    it is quick, without those of an empty rule; they are rounded to ``LEAST_SECONDS``
    times a power of two, so that noise seldom counts.
    """
    n = docs.count()
    if not n:
        return list(rules)
    sample = with_words(docs, doc_id, text).sample(min(1.0, rows / n), seed=7).persist()

    def run(rule: Rule) -> tuple[float, int]:
        began = time.perf_counter()
        rejected = sample.agg(F.count_if(F.expr(condition(rule)))).first()[0]
        return time.perf_counter() - began, rejected

    try:
        empty = Rule("empty", "n_words < 0")
        run(empty)  # fills the cache
        base = min(run(empty), run(empty))[0]
        scores = []
        for rule in rules:
            seconds, rejected = run(rule)
            if seconds < PLAIN_SECONDS:
                seconds = min(seconds, run(rule)[0])
            steps = math.log2(max(seconds - base, LEAST_SECONDS) / LEAST_SECONDS)
            scores.append(rejected / 2.0 ** round(steps))
    finally:
        sample.unpersist()
    return [r for _, _, r in sorted(((-score, i, r) for (i, r), score in zip(enumerate(rules), scores)), key=lambda x: x[:2])]


def passing(docs: DataFrame, rules: Collection[Rule] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that no rule rejects, with all their columns; no measure is taken but in the branch of its rule."""
    ordered = cheapest_first(docs, rules, doc_id, text)
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    # The words are bound to a variable: as a column, the optimizer could repeat their split in each branch.
    kept = rows.filter(f"element_at(transform(array({words_of('body')}), words -> {verdict(ordered)}), 1) IS NULL")
    return kept.select("row.*")


def judge(docs: DataFrame, rules: Collection[Rule] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the reported measures, base_failed and kept.

    The reported measures are due for every row and serve the rules as well; the
    other measures are taken in the branches of their rules only.
    """
    by_name = {r.name: r for r in rules}
    base = " OR ".join(f"({by_name[n].rejects})" for n in BASE)
    judged = cascade(measures(docs, doc_id, text, REPORTED), cheapest_first(docs, rules, doc_id, text))
    return judged.select("doc_id", *REPORTED, F.expr(base).alias("base_failed"), F.col("rejected_by").isNull().alias("kept"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
g AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS w FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM g) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(5)) AS k) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(words) AS n_words, length(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines,
         length(regexp_replace(body, '[^A-Za-z]', '', 'g')) AS letters, length(regexp_replace(body, '[^A-Z]', '', 'g')) AS upper
  FROM d LEFT JOIN covered ON d.doc_id = covered.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 10 * n_symbols > n_words OR (2 * upper > letters AND letters >= 20)
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR (2 * n_dup_lines > n_lines AND n_lines >= 4)) AS kept
FROM m"""
