"""Quality rules: a threshold table compiled into one projection, without user functions.

Null texts count as empty: no words, so the length rule fails. Repeated rows are judged one
by one and alike; an empty table gives an empty result. The input's other columns are left
out, whatever they are called, so that none can clash with the measures.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.llm.text import adjacent, head, lower_ascii, tail, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = """
the of and to a in is that for it with as was on be at by this are from or an have not he they we you
der die das und ist von den zu mit sich auf für nicht ein eine dem des im es auch
le la les un une et est de du des en que qui dans pour sur pas au avec par ce
el los las y de del que en un una por con para se no su al lo como es
""".split()


@dataclass(frozen=True)
class Rule:
    """A measure must lie within [least, most]; a bound of None is open."""

    measure: str
    least: float | None = None
    most: float | None = None


#: The table. A text without words has no ratios; the length rule speaks for it.
RULES = (
    Rule("n_words", least=20),
    Rule("repeat_word_ratio", most=0.3),
    Rule("same_next_ratio", most=0.3),
    Rule("mean_word_length", least=2.0, most=14.0),
    Rule("symbol_word_ratio", most=0.25),
    Rule("letter_word_ratio", least=0.6),
    Rule("stop_word_ratio", least=0.02),
    Rule("dup_line_ratio", most=0.5),
    Rule("longest_word", most=1000),
)


def measures(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per input row: the key and all measures of the whole text.

    Windows are compared by 64-bit hashes inside one text. Arrays that later columns read
    twice stand in columns of their own, so that none is computed twice, and no lambda reads
    an array by position, so that the work stays linear but for one sort.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    n = F.size("_words").cast("long")
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = df.select(F.col(key).alias("_key"), t.alias("_text"))
    out = out.withColumn("_words", words(F.col("_text"))).withColumn("_lines", lines)
    out = out.withColumn("_h", F.transform("_words", lambda w: F.xxhash64(w)))
    for step in (1, 2, 4):
        out = out.withColumn("_h", adjacent(F.col("_h"), step))
    no_pairs = F.array().cast("array<struct<h:bigint,i:int>>")
    pairs = F.array_sort(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn(
        "_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), pairs).otherwise(no_pairs)
    )
    out = out.withColumn(
        "_same", F.zip_with(head(F.col("_s"), 1), tail(F.col("_s"), 1), lambda a, b: a["h"] == b["h"])
    )
    no, flags = F.array(F.lit(False)), F.col("_same")
    twice = F.zip_with(F.concat(no, flags), F.concat(flags, no), lambda a, b: a | b)
    starts = F.zip_with("_s", twice, lambda s, f: F.when(f, s["i"]))
    out = out.withColumn("_p", F.array_sort(F.filter(starts, lambda i: i.isNotNull())))
    after = F.concat(tail(F.col("_p"), 1), F.array(F.lit(2**31 - 1)))
    covered = F.zip_with("_p", after, lambda a, b: F.least(F.lit(WINDOW), b - a))
    lowered = F.transform("_words", lambda w: F.rtrim(lower_ascii(w), F.lit(".,;:!?")))
    kept_lines, words_ = F.size("_lines"), F.col("_words")
    return out.select(
        F.col("_key").alias(key),
        n.alias("n_words"),
        F.length(F.regexp_replace("_text", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (kept_lines - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("_p") == 0, F.lit(0).cast("long"))
        .otherwise(F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x))
        .alias("n_repeat_words"),
        F.size(F.filter(F.zip_with(head(words_, 1), tail(words_, 1), lambda a, b: a == b), lambda x: x))
        .cast("long").alias("n_same_next"),
        kept_lines.cast("long").alias("n_lines"),
        F.size(F.filter(lowered, lambda w: w.isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size(F.filter("_words", lambda w: w.rlike(r"\p{L}"))).cast("long").alias("n_letter_words"),
        F.coalesce(F.array_max(F.transform("_words", F.length)), F.lit(0))
        .cast("long").alias("longest_word"),
    )


def _ratio(part: str, whole: str) -> Column:
    return F.coalesce(F.col(part) / F.nullif(F.col(whole), F.lit(0)), F.lit(0.0))


RATIOS = {
    "repeat_word_ratio": ("n_repeat_words", "n_words"),
    "same_next_ratio": ("n_same_next", "n_words"),
    "mean_word_length": ("word_chars", "n_words"),
    "symbol_word_ratio": ("n_symbols", "n_words"),
    "letter_word_ratio": ("n_letter_words", "n_words"),
    "stop_word_ratio": ("n_stop_words", "n_words"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
}


def failed_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """The names of the broken rules, in table order."""
    checks = []
    for rule in rules:
        value = _ratio(*RATIOS[rule.measure]) if rule.measure in RATIOS else F.col(rule.measure)
        if rule.least is not None:
            checks.append(F.when(value < rule.least, F.lit(f"{rule.measure}<{rule.least}")))
        if rule.most is not None:
            checks.append(F.when(value > rule.most, F.lit(f"{rule.measure}>{rule.most}")))
    return F.array_compact(F.array(*checks))


def apply_rules(
    df: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Measures and the list of broken rules for every row."""
    return measures(df, key, text).withColumn("failed_rules", failed_rules(rules))


def quality_query(df: DataFrame) -> DataFrame:
    out = apply_rules(df)
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"),
        ((F.size("failed_rules") == 0) & ~base_failed).alias("kept"),
        F.concat_ws(",", "failed_rules").alias("failed_rules"),
    )


def _sql_rules() -> str:
    checks = []
    for rule in RULES:
        value = rule.measure
        if rule.measure in RATIOS:
            part, whole = RATIOS[rule.measure]
            value = f"coalesce({part} / nullif({whole}, 0), 0.0)"
        if rule.least is not None:
            checks.append(f"CASE WHEN {value} < {rule.least} THEN '{rule.measure}<{rule.least}' END")
        if rule.most is not None:
            checks.append(f"CASE WHEN {value} > {rule.most} THEN '{rule.measure}>{rule.most}' END")
    return ", ".join(checks)


QUALITY_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d
), win AS (
  SELECT r, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS win
  FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - {WINDOW - 2}, 1))) AS i FROM w)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM win) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n
  FROM twice CROSS JOIN (SELECT unnest(range({WINDOW})) AS k) GROUP BY r
), m AS (
  SELECT r, doc_id, len(ws) AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, len(ls) AS n_lines,
         coalesce(covered.n, 0) AS n_repeat_words,
         len(list_filter(ws, lambda x: list_contains({STOP_WORDS!r},
             rtrim(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '.,;:!?')))) AS n_stop_words,
         len(list_filter(list_zip(ws[:-2], ws[2:]), lambda x: x[1] = x[2])) AS n_same_next,
         len(list_filter(ws, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter_words,
         coalesce(list_max(list_transform(ws, lambda x: length(x))), 0) AS longest_word
  FROM w LEFT JOIN covered USING (r)
), f AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         array_to_string(list_filter([{_sql_rules()}], lambda x: x IS NOT NULL), ',') AS failed_rules FROM m
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       failed_rules = '' AND NOT base_failed AS kept, failed_rules
FROM f
"""
