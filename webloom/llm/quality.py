"""Quality rules: a threshold table compiled into one projection, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import SPACE_CHARS

#: Symbols of the base rule.
SYMBOLS = "#*$%&|<>"
#: Frequent function words of the four languages that the corpus has.
STOP_WORDS = (
    "the of and to in that is was for on with as by at be are or an from it this "
    "le la les de des du et un une que qui dans pour par au en est "
    "der die das und ein eine zu den von mit ist des auf im "
    "el los las y del una con por para se es"
).split()


@dataclass(frozen=True)
class Rule:
    """A document passes if low <= metric <= high; a metric that is null passes."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


#: Metrics of the rules in SQL over the columns that `measured` adds.
METRICS = {
    "mean_word_chars": "word_chars / n_words",
    "symbols_per_word": "n_symbols / n_words",
    "shouts_per_word": "n_shouts / n_words",
    "stop_word_share": "n_stop_words / n_words",
    "dup_line_share": "n_dup_lines / n_lines",
}
#: The threshold table. Bounds leave a wide margin around running prose of any length.
RULES = (
    Rule("word length", "mean_word_chars", 2.0, 20.0),
    Rule("symbols", "symbols_per_word", None, 0.25),
    Rule("shouting", "shouts_per_word", None, 0.5),
    Rule("stop words", "stop_word_share", 0.02, None),
    Rule("repeated lines", "dup_line_share", None, 0.5),
)
#: Base rule: fewer words fail.
MIN_WORDS = 20
#: Base rule: a larger share of words in repeated windows fails, in percent.
MAX_REPEAT = 30
WINDOW = 8

_BLANKS = r"'\t\n\u000B\u000C\r'"
_ADDED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_shouts", "n_stop_words", "n_lines"]


def _words(text: str) -> str:
    return f"array_remove(split(translate({text}, {_BLANKS}, '     '), ' '), '')"


def _repeat_words(words: str) -> str:
    """SQL: words in windows of WINDOW words that occur twice or more in the text.

    Words become 64-bit hashes; windows of two, four and eight words hashes of two such halves each.
    Only a text with a repeated window sorts them: neighbours of equal hash are repeats, and each
    repeat covers up to the next one's start.
    """
    assert WINDOW == 8
    hashes = f"transform({words}, w -> xxhash64(w))"

    def joined(halves: str, apart: int) -> str:
        left, right = f"slice(v, 1, size(v) - {apart})", f"slice(v, {apart + 1}, size(v) - {apart})"
        return f"transform(array({halves}), v -> zip_with({left}, {right}, (x, y) -> xxhash64(x, y)))[0]"

    windows = joined(joined(joined("h", 1), 2), 4)
    pairs = "sort_array(transform(w, (x, i) -> named_struct('h', x, 'i', i)))"
    same = "coalesce(get(s, k).h = get(s, k - 1).h, false) or coalesce(get(s, k).h = get(s, k + 1).h, false)"
    at = f"sort_array(transform(filter(sequence(0, size(s) - 1), k -> {same}), k -> get(s, k).i))"
    cover = f"aggregate(zip_with(a, slice(a, 2, size(a)), (x, y) -> least({WINDOW}, coalesce(y - x, {WINDOW}))), 0L, (n, x) -> n + x)"
    return (
        f"transform(array({hashes}), h -> case when size(h) <= {WINDOW} then 0L else "
        f"transform(array({windows}), w -> case when size(array_distinct(w)) = size(w) then 0L else "
        f"transform(array({pairs}), s -> transform(array({at}), a -> {cover})[0])[0] end)[0] end)[0]"
    )


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the measures of every whole text; columns of these names are replaced."""
    t = f"coalesce({text}, '')"
    blank = "' \\t\\n\\u000B\\u000C\\r'"
    solid = f"filter(split({t}, '\\n', -1), l -> translate(l, {blank}, '') <> '')"
    stops = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    plain = f"split(translate(lower({t}), '.,;:!?\"()\\t\\n\\u000B\\u000C\\r', '               '), ' ')"
    length = f"char_length({t})"
    words = _words(t)
    columns = {
        "n_words": f"cast(size({words}) as long)",
        "word_chars": f"cast(char_length(translate({t}, {blank}, '')) as long)",
        "n_symbols": f"cast({length} - char_length(translate({t}, '{SYMBOLS}', '')) as long)",
        "n_dup_lines": f"transform(array({solid}), l -> cast(size(l) - size(array_distinct(l)) as long))[0]",
        "n_repeat_words": _repeat_words(words),
        "n_shouts": f"cast({length} - char_length(translate({t}, '!', '')) as long)",
        "n_stop_words": f"cast(size(filter({plain}, w -> w in ({stops}))) as long)",
        "n_lines": f"cast(size({solid}) as long)",
    }
    assert list(columns) == _ADDED
    return docs.select(*[c for c in docs.columns if c not in columns], *[F.expr(e).alias(c) for c, e in columns.items()])


def base_failed() -> Column:
    return F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT} * n_words")


def verdict(rules=RULES) -> Column:
    """Whether all rules of a threshold table hold."""
    passed = F.lit(True)
    for rule in rules:
        metric = F.expr(METRICS[rule.metric].replace(" / ", " / nullif(") + ", 0)")
        for bound, ok in ((rule.low, metric >= F.lit(rule.low)), (rule.high, metric <= F.lit(rule.high))):
            if bound is not None:
                passed = passed & F.coalesce(ok, F.lit(True))
    return passed


def judge(docs: DataFrame, rules=RULES) -> DataFrame:
    """docs with the measures, base_failed and kept.

    Null and blank texts have no words and fail. Rows are judged one by one, so repeated rows and
    null ids change nothing. An empty table gives no rows. Columns of added names are replaced.
    """
    rows = measured(docs.drop("base_failed", "kept"))
    return rows.withColumns({"base_failed": base_failed(), "kept": ~base_failed() & verdict(rules)})


def keep_good(docs: DataFrame, rules=RULES) -> DataFrame:
    """The rows of docs that judge keeps, with their columns as they are, whatever their names."""
    judged = judge(docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text")), rules)
    return judged.where("kept").select("row.*")


def _oracle_rules(rules=RULES) -> str:
    parts = []
    for rule in rules:
        up, down = METRICS[rule.metric].split(" / ")
        metric = f"({up}::DOUBLE / nullif({down}, 0))"
        parts += [f"coalesce({metric} >= {rule.low}, true)"] * (rule.low is not None)
        parts += [f"coalesce({metric} <= {rule.high}, true)"] * (rule.high is not None)
    return " AND ".join(parts)


#: The same for DuckDB; windows are compared as texts.
ORACLE = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS solid,
         string_split(regexp_replace(lower(coalesce(text, '')), '[.,;:!?"()\x09-\x0D]', ' ', 'g'), ' ') AS plain
  FROM documents
), g AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + {WINDOW - 1}), ' ') AS k
  FROM d, unnest(range(1, len(w) - {WINDOW - 2})) AS u(i)
), r AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM g) WHERE n > 1
), c AS (
  SELECT doc_id, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW})))::BIGINT AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM r) GROUP BY doc_id
), m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(solid) - len(list_distinct(solid)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         (length(t) - length(replace(t, '!', '')))::BIGINT AS n_shouts,
         len(list_filter(plain, lambda x: x IN ({", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))})))::BIGINT AS n_stop_words,
         len(solid)::BIGINT AS n_lines
  FROM d LEFT JOIN c ON d.doc_id = c.doc_id
), b AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_oracle_rules()} AS kept
FROM b
"""
assert len(SPACE_CHARS) == 6
