"""Quality rules: a threshold table compiled into one Spark projection.

`RULES` names a metric, the range in which a document is kept and whether the rule is
one of the base rules.  `measures` computes every metric from the text with SQL
functions, `verdict` turns the table into one boolean column.  No user functions.

Defined results: a null text counts as empty and has no words, so the base rule on
length rejects it; repeated rows are judged one by one; an empty table gives an empty
result; other columns of the input pass through untouched, and an input column that is
called like a metric is replaced by the metric.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlog.llm.common import SPACE, WORD, text_of

#: Frequent words of the corpus languages (English, French, German, Spanish).
STOP_WORDS = (
    "the be to of and that have with a in is it for on as by this are was from at or an "
    "le la les de des du et en un une que qui dans pour sur par avec au "
    "der die das und ist nicht ein eine zu mit den von im auf für sich des dem "
    "el los las y que un una por con para del se no lo al es"
)


@dataclass(frozen=True)
class Rule:
    """Keep a document while least <= metric <= most (an open end is None)."""

    metric: str
    least: float | None = None
    most: float | None = None
    base: bool = False


#: The threshold table.  Ratios are per word, but for dup_line_ratio (per line with a word).
RULES = (
    Rule("n_words", least=50, base=True),
    Rule("repeat_ratio", most=0.5, base=True),
    Rule("mean_word_chars", least=2.5, most=12),
    Rule("symbol_ratio", most=0.2),
    Rule("shout_ratio", most=0.3),
    Rule("stop_ratio", least=0.03),
    Rule("dup_line_ratio", most=0.5),
    Rule("n_stop_words", least=2),
)


def measures(text: Column) -> list[dict[str, Column]]:
    """The metric columns, in layers; each layer may use the columns before it."""
    c = F.col
    stops = list(dict.fromkeys(STOP_WORDS.split()))
    size = lambda a: F.size(a).cast("long")
    #: each three-word window as one long, part of its hash above its place, sorted: equal windows
    #: lie side by side, and with them some that only share that part of the hash
    windows = F.expr(
        "CASE WHEN n_words < 3 THEN array() ELSE sort_array(transform("
        "sequence(0, n_words - 3), i -> shiftleft(xxhash64("
        "get(_words, cast(i AS int)), get(_words, cast(i + 1 AS int)), "
        "get(_words, cast(i + 2 AS int))), _bits) | i)) END")
    return [
        {"_text": text},
        {"_words": F.regexp_extract_all(c("_text"), F.lit(f"({WORD})"), 1),
         "_lines": F.expr(r"filter(split(_text, '\n', -1), l -> l rlike '[^\\x20\\x09-\\x0D]')"),
         "n_symbols": F.length(F.regexp_replace("_text", r"[^#*$%&|<>]+", "")).cast("long"),
         "_shouts": F.length(F.regexp_replace("_text", r"[^!]+", "")).cast("long"),
         "word_chars": F.length(F.regexp_replace("_text", SPACE, "")).cast("long")},
        {"n_words": size(c("_words")),
         "_bits": F.expr("length(bin(size(_words)))"),
         "n_dup_lines": size(c("_lines")) - size(F.array_distinct("_lines")),
         "n_lines": size(c("_lines")),
         "n_stop_words": size(F.filter("_words", lambda w: F.lower(w).isin(stops)))},
        {"_windows": windows},
        #: of these, the words themselves (words hold no space) above the place, sorted
        {"_alike": F.expr(
            "transform(filter(_windows, (x, i) -> "
            "shiftright(x, _bits) <=> shiftright(get(_windows, i - 1), _bits) OR "
            "shiftright(x, _bits) <=> shiftright(get(_windows, i + 1), _bits)), "
            "x -> cast(x & (shiftleft(1L, _bits) - 1) AS int))")},
        {"_grams": F.expr(
            "sort_array(transform(_alike, p -> struct(concat_ws(' ', get(_words, p), "
            "get(_words, p + 1), get(_words, p + 2)) AS g, p AS p)))")},
        #: places of the windows found twice or more, in text order
        {"_places": F.expr(
            "sort_array(transform(filter(_grams, (x, i) -> "
            "x.g <=> get(_grams, i - 1).g OR x.g <=> get(_grams, i + 1).g), "
            "x -> cast(x.p AS long)))")},
        #: each such window adds the words that the next one does not cover
        {"n_repeat_words": F.expr(
            "aggregate(transform(_places, (p, i) -> "
            "least(3, coalesce(get(_places, i + 1) - p, 3))), 0L, (a, x) -> a + x)")},
        {"repeat_ratio": _per(c("n_repeat_words"), c("n_words")),
         "mean_word_chars": _per(c("word_chars"), c("n_words")),
         "symbol_ratio": _per(c("n_symbols"), c("n_words")),
         "shout_ratio": _per(c("_shouts"), c("n_words")),
         "stop_ratio": _per(c("n_stop_words"), c("n_words")),
         "dup_line_ratio": _per(c("n_dup_lines"), c("n_lines"))},
    ]


def _per(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def failed(rules) -> Column:
    """True where a rule of the table rejects the document."""
    out = F.lit(False)
    for r in rules:
        if r.least is not None:
            out = out | (F.col(r.metric) < F.lit(r.least))
        if r.most is not None:
            out = out | (F.col(r.metric) > F.lit(r.most))
    return out


#: Columns of `measures` that do not stay.
INNER = ("_text", "_words", "_lines", "_shouts", "_bits", "_windows", "_alike", "_grams", "_places")


def quality_rules(docs: DataFrame, rules=RULES, text: str = "text") -> DataFrame:
    """`docs` with every metric, `base_failed` and `kept`; input columns of those names give way
    to them."""
    aside = {c: f"{c}_of_input_{uuid.uuid4().hex}" for c in docs.columns if c.lower() in INNER}
    out = docs.withColumnsRenamed(aside) if aside else docs
    for layer in measures(text_of(aside.get(text, text))):
        out = out.withColumns(layer)
    out = out.drop(*INNER)
    out = out.withColumnsRenamed({v: k for k, v in aside.items()}) if aside else out
    out = (out.withColumn("base_failed", failed([r for r in rules if r.base]))
           .withColumn("kept", ~F.col("base_failed") & ~failed(rules)))
    #: a filter on the verdict must not be pushed below the layers, where every metric would
    #: be worked out once for each use; a generator of one row keeps it above
    return out.select(F.inline(F.array(F.struct(*(out[f"`{c}`"] for c in out.columns)))))
