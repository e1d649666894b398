"""Quality rules as a short-circuit cascade (built-in functions only).

Every rule is a boolean column that is true where a document fails. On a
bounded sample (``SAMPLE_ROWS`` rows) each rule's cost (wall time of one
aggregate over the sample) and selectivity (share it rejects) are measured,
and the rules are put in one CASE expression by falling rejection per cost:
a document is charged only for the rules up to its first failure. The order
changes the work, never the verdict, which is "no rule fails".

Defined results: a null text is the empty text; the empty text has no words
and fails ``too_short``; rows are kept or dropped one by one, so repeated
rows share a verdict; an empty table gives an empty table.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, field, packed, whole_text

SPACE = " \t\n\x0b\x0c\r"
SPACE_RE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 50
MAX_REPEAT_PCT = 50      # per cent of words inside repeated 3-word windows
MAX_SYMBOL_RATIO = 0.1   # symbols per word
MAX_DUP_LINE_RATIO = 0.5
MAX_UPPER_RATIO = 0.5
MIN_MEAN_WORD, MAX_MEAN_WORD = 2.5, 12.0
MIN_LETTER_RATIO = 0.45  # letters per character of words
MAX_ELLIPSIS_LINE_RATIO = 0.5

SAMPLE_ROWS = 500       # bounds of the sample that orders the rules
SAMPLE_CHARS = 20_000

# Columns of the measures, one row per document (prefix keeps them apart from the caller's names).
WORDS, NW, CHARS, SYM, DUP, LINES, LINE_LIST, REP, TEXT, BITS = (
    "_cl_words", "_cl_n_words", "_cl_word_chars", "_cl_n_symbols", "_cl_n_dup_lines", "_cl_lines",
    "_cl_line_list", "_cl_n_repeat_words", "_cl_text", "_cl_bits")


def split_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RE))


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, as one lazy expression."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shl(x: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", x, bits)


def repeat_words(words: Column, n: Column, bits: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    Each window becomes one long: its hash above, its position in the low
    ``bits`` bits. Sorting puts equal windows side by side (windows whose hash
    bits agree are compared word by word), the positions found are sorted,
    and each start covers three words less its overlap with the next start.
    """
    windows = F.sort_array(F.transform(F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))), lambda i: shl(
        F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)), bits).bitwiseOR(i.cast("bigint"))))

    def at(x: Column) -> Column:
        return x.bitwiseAND(shl(F.lit(1).cast("bigint"), bits) - 1).cast("int")

    def same(a: Column, b: Column) -> Column:
        p, q = at(a), at(b)
        return (F.call_function("shiftright", a, bits) == F.call_function("shiftright", b, bits)) \
            & (F.get(words, p) == F.get(words, q)) & (F.get(words, p + 1) == F.get(words, q + 1)) \
            & (F.get(words, p + 2) == F.get(words, q + 2))

    def starts(win: Column) -> Column:
        twice = F.filter(F.sequence(F.lit(0), F.size(win) - 1), lambda k: same(F.get(win, k), F.get(win, k + 1)))
        return F.sort_array(F.array_distinct(F.flatten(F.transform(
            twice, lambda k: F.array(at(F.get(win, k)), at(F.get(win, k + 1)))))))

    def covered(s: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(0), F.size(s) - 1), F.lit(0).cast("bigint"),
            lambda acc, k: acc + F.least(F.lit(3), F.coalesce(F.get(s, k + 1) - F.get(s, k), F.lit(3))).cast("bigint"))

    none = F.lit(0).cast("bigint")
    return F.when(n < 4, none).otherwise(
        let(let(windows, starts), lambda s: F.when(F.size(s) == 0, none).otherwise(covered(s))))


def measures(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with the base measures of ``text`` as helper columns.

    ``inline`` keeps the split words and lines as columns of their own: a
    filter on a rule above cannot be pushed below it, where every use would
    split the text again.
    """
    whole = whole_text(text)
    lines = F.filter(F.split(whole, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACE))) > 0)
    parts = df.select("*", F.inline(F.array(F.struct(
        whole.alias(TEXT), split_words(whole).alias(WORDS), lines.alias(LINE_LIST)))))
    n = F.size(WORDS)
    bits = F.ceil(F.log2(F.greatest(n, F.lit(2)).cast("double"))).cast("int")
    sized = parts.select("*", F.inline(F.array(F.struct(n.alias(NW), bits.alias(BITS), F.size(LINE_LIST).alias(LINES)))))
    w = F.col(WORDS)
    return (sized
            .withColumn(REP, repeat_words(w, F.col(NW), F.col(BITS)))
            .withColumn(DUP, (F.col(LINES) - F.size(F.array_distinct(LINE_LIST))).cast("bigint"))
            .withColumn(CHARS, F.length(F.array_join(w, "")).cast("bigint"))
            .withColumn(SYM, (F.length(TEXT) - F.length(F.translate(F.col(TEXT), SYMBOLS, ""))).cast("bigint")))


def base_failed() -> Column:
    n = F.col(NW).cast("bigint")
    return (n < MIN_WORDS) | (100 * F.col(REP) > MAX_REPEAT_PCT * n)


def rules() -> dict[str, Column]:
    """Rule name -> column that is true where the document fails."""
    n, text = F.col(NW).cast("double"), F.col(TEXT)
    letters = F.length(F.regexp_replace(text, "\\P{L}+", ""))
    upper = F.length(F.regexp_replace(text, "\\P{Lu}+", ""))
    return {
        "too_short": F.col(NW) < MIN_WORDS,
        "repeated_windows": 100 * F.col(REP) > MAX_REPEAT_PCT * F.col(NW).cast("bigint"),
        "symbols": F.col(SYM) > MAX_SYMBOL_RATIO * n,
        "duplicate_lines": F.col(DUP) > MAX_DUP_LINE_RATIO * F.col(LINES),
        "word_length": ~(F.col(CHARS) / F.greatest(n, F.lit(1.0))).between(MIN_MEAN_WORD, MAX_MEAN_WORD),
        "shouting": upper > MAX_UPPER_RATIO * F.greatest(letters, F.lit(1)),
        "few_letters": letters < MIN_LETTER_RATIO * F.col(CHARS),
        "ellipsis_lines": F.size(F.filter(F.col(LINE_LIST), lambda x: F.rtrim(x).endswith("..."))) >
        MAX_ELLIPSIS_LINE_RATIO * F.col(LINES),
    }


def order_rules(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rule names by rejection per cost on a bounded sample of the texts.

    The sample is the first ``sample_rows`` texts of at most ``SAMPLE_CHARS``
    code points that an incremental read finds, so it reads a few partitions
    and its size is bounded. Only the order of evaluation depends on it. Costs
    are wall seconds of a count over the sample, less that of counting alone.
    """
    rs = rules()
    texts = docs.select(whole_text(F.col(f"`{text}`")).alias("text")).where(F.length("text") <= SAMPLE_CHARS).limit(sample_rows)
    sample = docs.sparkSession.createDataFrame(texts.collect(), "text string")
    sample = measures(packed(sample.coalesce(1)), field("text")).persist()
    try:
        n = max(sample.count(), 1)

        def timed(*aggs):
            t = time.perf_counter()
            row = sample.agg(*aggs).first()
            return time.perf_counter() - t, row

        timed(F.count(F.lit(1)))
        idle, _ = timed(F.count(F.lit(1)))
        score = {}
        for name, col in rs.items():
            cost, row = timed(F.count_if(col))
            score[name] = (row[0] / n) / max(cost - idle, 1e-3)
    finally:
        sample.unpersist()
    return sorted(rs, key=lambda k: -score[k])


def first_failure(order: list[str]) -> Column:
    """Name of the first failing rule in ``order``; null where all pass."""
    rs = rules()
    case = F.when(rs[order[0]], F.lit(order[0]))
    for name in order[1:]:
        case = case.when(rs[name], F.lit(name))
    return case


def judged(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Measures, ``_cl_failed`` (first failing rule or null) and the packed row of every document."""
    order = order_rules(docs, text, sample_rows)
    return measures(packed(docs), field(text)).withColumn("_cl_failed", first_failure(order))


def keep_good(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects, with the caller's columns."""
    return judged(docs, text, sample_rows).where(F.col("_cl_failed").isNull()).select(f"{ROW}.*")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: base measures and verdict."""
    j = judged(docs.select("doc_id", "text"))
    return j.select(
        field("doc_id").alias("doc_id"), F.col(NW).cast("bigint").alias("n_words"), F.col(CHARS).alias("word_chars"),
        F.col(SYM).alias("n_symbols"), F.col(DUP).alias("n_dup_lines"), F.col(REP).alias("n_repeat_words"),
        base_failed().alias("base_failed"), F.col("_cl_failed").isNull().alias("kept"))
