"""Tolerant JSON record parsing (C1) and JSON text output (C2), as column expressions.

A message is parsed once with ``from_json``: text fields as STRING (numbers and
booleans arrive as their text, nested values as their JSON text), integer fields as
VARIANT so that their JSON type is known.  The record rules are then plain column
expressions, all JVM-side:

* unknown fields are ignored, a repeated field keeps its last value, but every value of
  it must be acceptable;
* text fields take strings, and numbers / booleans as they are written (``1.50`` stays
  ``1.50``); an object or array there makes the whole message unreadable;
* integer fields take integers, numbers with a fraction (truncated toward zero),
  strings holding an optional sign and digits (after trimming), and null / "" /
  "null" as null; out-of-range values, booleans, other strings, objects and arrays
  make the whole message unreadable;
* a null / empty / non-object / malformed message is unreadable.

``from_json`` keeps the last value of a repeated field without looking at the others, and
rewrites numbers.  Messages where that can matter (more fields written than read, a number
with a fraction or exponent in a text field, a name in escapes) are rare; two patterns find them,
and only for these the text is cut into tokens (``members``).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    "allowUnquotedControlChars": "false",
    "allowComments": "false",
}

INT_MIN, INT_MAX = -2147483648, 2147483647


def record_schema(text_fields: Iterable[str], int_fields: Iterable[str] = ()) -> T.StructType:
    """Text fields as STRING (scalars arrive as their text), integer fields as VARIANT
    (their JSON type decides the coercion), plus the corrupt-record text."""
    return T.StructType([T.StructField(f, T.StringType(), True) for f in text_fields]
                        + [T.StructField(f, T.VariantType(), True) for f in int_fields]
                        + [T.StructField(CORRUPT, T.StringType(), True)])


def variant_schema(fields: Iterable[str]) -> T.StructType:
    return record_schema((), fields)


def record_unreadable(rec: Column) -> Column:
    """True when the text is not a JSON object at all (null, empty, malformed, array...)."""
    return rec.isNull() | rec.getField(CORRUPT).isNotNull()


def _vtype(v: Column) -> Column:
    return F.schema_of_variant(v)


def text_field(s: Column, raw: Column, name: str) -> Column:
    """'bad' flag of a text field read as STRING: an object or array is not text.

    A nested value arrives as its JSON text, so only a reading that starts with ``{``
    or ``[`` can be one; for those rare rows alone the field is read again as VARIANT
    to learn its JSON type.
    """
    maybe_nested = s.startswith("{") | s.startswith("[")
    one = F.from_json(raw, variant_schema([name]), JSON_OPTIONS).getField(name)
    t = _vtype(one)
    return F.coalesce(F.when(maybe_nested, t.startswith("OBJECT") | t.startswith("ARRAY")),
                      F.lit(False))


_JAVA_TRIM = r"^[\x00-\x20]+|[\x00-\x20]+$"


# ---- token level, for the rare messages -------------------------------------------------
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_TOKEN = _STRING + r'|[{}\[\]:,]|[^\s{}\[\]:,"]++'
_FLAT_OBJECT = r'(?s)^\{(?:' + _STRING + r'|[^"{}\[\]]++)*+\}$'
_MEMBERS = "array<struct<name:string,token:string>>"


def unquoted(token: Column) -> Column:
    """The text of a JSON string token."""
    return F.get_json_object(F.concat(F.lit('{"v":'), token, F.lit("}")), "$.v")


def _walk(text: Column) -> Column:
    """The tokens of a valid JSON text folded into (depth, awaiting, name, found, after): the
    members of the first object, each with the first token of its value, and whether
    anything follows that object."""
    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("awaiting"),
                     F.lit(None).cast("string").alias("name"),
                     F.array().cast(_MEMBERS).alias("found"), F.lit(False).alias("after"))

    def step(s: Column, t: Column) -> Column:
        opens, closes = t.isin("{", "["), t.isin("}", "]")
        over, top = s["depth"] < 0, s["depth"] == 1
        value = top & s["awaiting"] & ~closes
        colon, comma = top & (t == ":") & ~s["awaiting"], top & (t == ",")
        deeper = s["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        return F.struct(
            F.when(over | (closes & (deeper == 0)), F.lit(-1)).otherwise(deeper).alias("depth"),
            F.when(colon, True).when(value | comma, False).otherwise(s["awaiting"]).alias("awaiting"),
            F.when(comma, F.lit(None).cast("string"))
            .when(top & ~s["awaiting"] & t.startswith('"'), t).otherwise(s["name"]).alias("name"),
            F.when(value, F.concat(s["found"], F.array(F.struct(s["name"], t)).cast(_MEMBERS)))
            .otherwise(s["found"]).alias("found"),
            (s["after"] | over).alias("after"))

    return F.aggregate(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), start, step)


def members(text: Column) -> Column:
    """name, token of the members of a JSON object in order, repeated ones included; the
    token is the whole value of a scalar, as written, or an opening bracket."""
    return F.transform(_walk(text)["found"], lambda m: F.struct(
        unquoted(m["name"]).alias("name"), m["token"].alias("token")))


def more_than_one_value(text: Column) -> Column:
    """True where a JSON text goes on behind its first object."""
    return F.when(text.rlike(_FLAT_OBJECT), F.lit(False)).otherwise(_walk(text)["after"])


def _tokens_of(found: Column, name: str) -> Column:
    return F.transform(F.filter(found, lambda m: m["name"] == name), lambda m: m["token"])


def _text_of(tokens: Column) -> Column:
    last = F.try_element_at(tokens, F.lit(-1))
    return F.when(last.startswith('"'), unquoted(last)).when(last != "null", last)


def _nested(token: Column) -> Column:
    return token.startswith("{") | token.startswith("[")


def _int_token(token: Column) -> Column:
    """Whether a value's token is acceptable in an integer field (stage 2's rules)."""
    text = F.regexp_replace(unquoted(token), _JAVA_TRIM, "")

    def within(c: Column, kind: str, low, high) -> Column:
        return F.coalesce(c.try_cast(kind).between(low, high), F.lit(False))

    return (F.when(token == "null", True)
            .when(token.startswith('"'), text.isin("", "null") | (
                text.rlike(r"^[+-]?[0-9]+$") & within(text, "bigint", INT_MIN, INT_MAX)))
            .when(token.rlike(r"^-?[0-9]+$"), within(token, "bigint", INT_MIN, INT_MAX))
            .when(token.rlike(r"^-?[0-9]"), within(token, "double", float(INT_MIN), float(INT_MAX)))
            .otherwise(False))


def rare(raw: Column, rec: Column, text_fields: Sequence[str], int_fields: Sequence[str]) -> Column:
    """Whether a readable message needs the token level."""
    names = "|".join([*text_fields, *int_fields])
    read = sum((rec.getField(n).isNotNull().cast("int") for n in [*text_fields, *int_fields]),
               F.lit(0))
    repeated = F.regexp_count(raw, F.lit(rf'"(?:{names})"\s*+:')) > read
    rewritten = raw.rlike(rf'"(?:{"|".join(text_fields)})"\s*+:\s*+(?:-0|-?[0-9]++[.eE])')
    return ~record_unreadable(rec) & (repeated | rewritten | raw.rlike(r"\\u00[3-7]"))


def token_fixes(text_fields: Sequence[str], int_fields: Sequence[str]) -> Column:
    """What the token level says of a rare message: the text fields, and whether a value of
    any field is unacceptable."""
    found = F.col("_members")
    bad = F.lit(False)
    for n in text_fields:
        bad = bad | F.exists(_tokens_of(found, n), _nested)
    for n in int_fields:
        bad = bad | F.exists(_tokens_of(found, n), lambda t: ~_int_token(t))
    return F.struct(*[_text_of(_tokens_of(found, n)).alias(n) for n in text_fields],
                    bad.alias("bad"))


def int_field_parts(v: Column, prefix: str) -> list[Column]:
    """Stage 1 of an integer field: its JSON type, and the one reading that type needs.

    Kept as separate columns so that the optimizer evaluates each once per row.
    """
    t = _vtype(v)
    return [t.alias(f"{prefix}_t"),
            F.when(t == "BIGINT", F.try_variant_get(v, "$", "bigint")).alias(f"{prefix}_l"),
            F.when((t == "DOUBLE") | (t == "FLOAT") | t.startswith("DECIMAL"),
                   F.try_variant_get(v, "$", "double")).alias(f"{prefix}_d"),
            F.when(t == "STRING", F.regexp_replace(F.try_variant_get(v, "$", "string"),
                                                   _JAVA_TRIM, "")).alias(f"{prefix}_s")]


def int_field(prefix: str) -> tuple[Column, Column]:
    """Stage 2: (value INT, bad BOOLEAN) from the stage-1 columns ``prefix_*``."""
    t, as_long, as_double, s = (F.col(f"{prefix}_{x}") for x in "tlds")
    is_int = t == "BIGINT"
    is_frac = (t == "DOUBLE") | (t == "FLOAT") | t.startswith("DECIMAL")
    is_str = t == "STRING"
    s_null = (s == "") | (s == "null")
    s_long = F.when(s.rlike(r"^[+-]?[0-9]+$"), s.try_cast("bigint"))
    long_ok = F.coalesce(as_long.between(INT_MIN, INT_MAX), F.lit(False))
    double_ok = F.coalesce(as_double.between(float(INT_MIN), float(INT_MAX)), F.lit(False))
    text_ok = F.coalesce(s_long.between(INT_MIN, INT_MAX), F.lit(False))
    value = (F.when(is_int & long_ok, as_long.cast("int"))
             .when(is_frac & double_ok, as_double.cast("int"))
             .when(is_str & ~s_null & text_ok, s_long.cast("int")))
    ok = (t.isNull() | (t == "VOID") | (is_int & long_ok) | (is_frac & double_ok)
          | (is_str & (s_null | text_ok)))
    return value, ~F.coalesce(ok, F.lit(False))


def to_json_text(*cols: Column | str) -> Column:
    """A JSON object of the given columns; null fields are written as ``null``."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def parse_record(df: DataFrame, value_col: str, text_fields: Sequence[str],
                 int_fields: Sequence[str], unreadable_col: str = "_unreadable") -> DataFrame:
    """Parse ``value_col`` once and add typed fields plus an ``unreadable`` flag.

    Projections over plain columns (parsed record → field readings, tokens of rare messages →
    what these say → typed fields), so the optimizer never copies the parse or a field
    reading into several places of one expression.
    """
    keep = [F.col(c) for c in df.columns]
    s1 = df.select(*keep, F.from_json(F.col(value_col), record_schema(text_fields, int_fields),
                                      JSON_OPTIONS).alias("_rec"))
    rec = F.col("_rec")
    bad = record_unreadable(rec)
    stage2 = []
    for name in text_fields:
        stage2.append(rec.getField(name).alias(name))
        bad = bad | text_field(rec.getField(name), F.col(value_col), name)
    for name in int_fields:
        stage2.extend(int_field_parts(rec.getField(name), f"_{name}"))
    tokens = F.when(rare(F.col(value_col), rec, text_fields, int_fields), members(F.col(value_col)))
    s2 = s1.select(*keep, *stage2, bad.alias("_bad_text"), tokens.alias("_members"))
    fixes = F.when(F.col("_members").isNotNull(),
                   token_fixes(text_fields, int_fields))
    s3 = s2.select("*", fixes.alias("_fixes"))
    fix = F.col("_fixes")
    stage3 = []
    bad3 = F.col("_bad_text") | F.coalesce(fix["bad"], F.lit(False))
    for name in int_fields:
        v, b = int_field(f"_{name}")
        stage3.append(v.alias(name))
        bad3 = bad3 | b
    texts = [F.when(fix.isNull(), F.col(n)).otherwise(fix[n]).alias(n) for n in text_fields]
    return s3.select(*keep, *texts, *stage3, bad3.alias(unreadable_col))


def fence(df: DataFrame) -> DataFrame:
    """Row-for-row pass-through that filters above cannot be pushed below.

    A filter on a derived column (``reason IS NULL``) would otherwise be pushed under
    the projections that derive it, with every column replaced by its definition: the
    JSON parse would run again inside the filter, once per reference.  Columns produced
    by a generator cannot be pushed through it, so the parse runs exactly once and the
    filter reads its result.  ``inline`` of a one-element array is codegen'd.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))
