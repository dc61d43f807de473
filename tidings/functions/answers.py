"""Reading the JSON that a language model answered with."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

from tidings.functions.binding import let
from tidings.functions.lexicon import FIELDS
from tidings.functions.text import NUMBER, none_if_empty, null_ish, py_strip, to_number


# Numbers beyond the JSON standard that answers may hold as bare words, with all
# that stands before them since the last one: whole strings, or characters of neither kind.
_BARE_NUMBER = r'\G((?:"(?:[^"\\]++|\\.)*+"|(?!-?(?:Infinity|NaN))[^"])*+)(-?(?:Infinity|NaN))(?=\s*+(?:[,}\]]|$))'


def strict_json(text: Column) -> Column:
    """The text as a variant; null unless the whole text is one JSON value.

    `NaN` and `Infinity` are read as text when the JSON fails on them. A
    repeated key takes its last value: the session's setting for that is made
    here, so that an answer does not depend on who built the session.
    """
    session = SparkSession.getActiveSession()
    if session is not None:
        session.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return F.coalesce(_standard_json(text), _standard_json(F.regexp_replace(text, _BARE_NUMBER, '$1"$2"')))


def _standard_json(text: Column) -> Column:
    """As `strict_json`, for JSON as the standard has it.

    Spark's parser stops after the first value. Inside brackets anything that
    follows is an error or a second element; a text with its own `]` is tried
    inside braces as well.
    """

    def whole(parsed: Column) -> Column:
        one = F.try_variant_get(parsed, "$[1]", "variant").isNull()
        safe = ~text.rlike(r"\]\s*[^\s]") | F.try_parse_json(
            F.concat(F.lit('{"v":'), text, F.lit("}"))
        ).isNotNull()
        return F.when(one & safe, F.try_variant_get(parsed, "$[0]", "variant"))

    return let(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), whole)


def _slice(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 0), F.lit(""))


OBJECT_SLICE = r"(?s)\{.*\}"
LIST_SLICE = r"(?s)\[.*\]"


def json_object(text: Column) -> Column:
    """The JSON of an answer, also when prose stands around its braces."""
    return F.coalesce(strict_json(text), strict_json(_slice(text, OBJECT_SLICE)))


def json_list(text: Column) -> Column:
    """As `json_object`, but a bracketed part is tried first and is final."""
    listed = _slice(text, LIST_SLICE)
    inner = F.when(listed.isNotNull(), strict_json(listed)).otherwise(
        strict_json(_slice(text, OBJECT_SLICE))
    )
    return F.coalesce(strict_json(text), inner)


def kind(value: Column) -> Column:
    """Upper-case type name of a variant, without type arguments."""
    return F.regexp_extract(F.schema_of_variant(value), r"^[A-Z]+", 0)


def _number_text(value: Column) -> Column:
    """A number as Python's str() shows it: 1 and 1.0 differ, and exponents have a sign and two digits."""
    shown = F.try_variant_get(value, "$", "string")
    parts = F.regexp_extract(shown, r"^(-?)(\d+)(?:\.(\d+))?E(-?)(\d+)$", 5)
    exponent = F.lpad(parts, 2, "0")
    mantissa = F.regexp_replace(F.regexp_extract(shown, r"^(.*)E", 1), r"\.0$", "")
    sign = F.when(F.regexp_extract(shown, r"E(-?)", 1) == "-", F.lit("-")).otherwise("+")
    power = F.when(sign == "-", -parts.try_cast("int")).otherwise(parts.try_cast("int"))
    plain = F.regexp_replace(shown.try_cast("decimal(38,18)").cast("string"), r"(\.\d*?)0+$", "$1")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    scientific = F.when((power >= 16) | (power < -4), F.concat(mantissa, F.lit("e"), sign, exponent)).otherwise(plain)
    return (
        F.when(shown.contains("E"), scientific)
        .when(kind(value).isin("DECIMAL", "DOUBLE", "FLOAT") & ~shown.contains("."), F.concat(shown, F.lit(".0")))
        .otherwise(shown)
    )


def _scalar_text(value: Column) -> Column:
    shown = F.try_variant_get(value, "$", "string")
    return (
        F.when(F.is_variant_null(value), F.lit("None"))
        .when(kind(value) == "BOOLEAN", F.initcap(shown))
        .when(kind(value) == "STRING", shown)
        .otherwise(_number_text(value))
    )


def _inner_text(value: Column) -> Column:
    """A value inside a list or object: text is quoted, deeper lists and objects stay JSON."""
    shown = F.try_variant_get(value, "$", "string")
    plain = F.replace(shown, F.lit("\\"), F.lit("\\\\"))
    quoted = F.when(shown.contains("'") & ~shown.contains('"'), F.concat(F.lit('"'), plain, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(plain, F.lit("'"), F.lit("\\'")), F.lit("'"))
    )
    return F.when(kind(value) == "STRING", quoted).when(kind(value).isin("ARRAY", "OBJECT"), F.to_json(value)).otherwise(_scalar_text(value))


def text_of(value: Column) -> Column:
    """A JSON value as Python's str() shows it; null stays null.

    Lists and objects are shown to their first level. An object's keys come in
    alphabetical order, as the parsed value does not keep the written one.
    """
    listed = F.try_variant_get(value, "$", "array<variant>")
    mapped = F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))
    pair = lambda e: F.concat(F.lit("'"), e["key"], F.lit("': "), _inner_text(e["value"]))
    return (
        F.when(F.is_variant_null(value), F.lit(None).cast("string"))
        .when(kind(value) == "ARRAY", F.concat(F.lit("["), F.array_join(F.transform(listed, _inner_text), ", "), F.lit("]")))
        .when(kind(value) == "OBJECT", F.concat(F.lit("{"), F.array_join(F.transform(mapped, pair), ", "), F.lit("}")))
        .otherwise(_scalar_text(value))
    )


def is_falsy(value: Column) -> Column:
    """Values that Python's `or` passes over: false, zero, empty text, list and object."""
    shown = F.try_variant_get(value, "$", "string")
    empty = F.size(F.try_variant_get(value, "$", "array<variant>")) == 0
    bare = F.size(F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))) == 0
    zero = ~kind(value).isin("STRING", "BOOLEAN", "ARRAY", "OBJECT") & (F.try_variant_get(value, "$", "double") == 0)
    return F.coalesce((shown == "") | ((kind(value) == "BOOLEAN") & (shown == "false")) | zero | ((kind(value) == "ARRAY") & empty) | ((kind(value) == "OBJECT") & bare), F.lit(False))


def field(value: Column, name: str) -> Column:
    return F.try_variant_get(value, f"$.{name}", "variant")


def is_object(value: Column) -> Column:
    return F.coalesce(kind(value) == "OBJECT", F.lit(False))


def valid_label(label: Column, labels: Column, fallback: Column) -> Column:
    """A known label as it is or in upper case, else the fallback."""
    return (
        F.when(F.array_contains(labels, label), label)
        .when(F.array_contains(labels, F.upper(label)), F.upper(label))
        .otherwise(fallback)
    )


def fallback_label(labels: Column, preferred: str) -> Column:
    """The preferred label when it is known, else the first in order."""
    return F.when(F.array_contains(labels, preferred), F.lit(preferred)).otherwise(F.array_min(labels))


def number_of(value: Column) -> Column:
    """Python's float() of a JSON value; null when it fails."""
    shown = F.lower(py_strip(F.try_variant_get(value, "$", "string")))
    return (
        F.when(kind(value) == "BOOLEAN", F.when(shown == "true", 1.0).otherwise(0.0))
        .when(shown.rlike(r"^[+-]?nan$"), F.lit(float("nan")))
        .otherwise(to_number(shown))
    )


def class_answer(raw: Column, labels: Column, fallback: Column) -> Column:
    """Struct `label, confidence` of a classification answer."""

    def read(obj: Column) -> Column:
        label = py_strip(
            F.when(
                F.is_variant_null(field(obj, "label")), F.lit("None")
            ).otherwise(F.coalesce(text_of(field(obj, "label")), F.lit("")))
        )
        number = F.coalesce(number_of(field(obj, "confidence")), F.lit(0.0))
        clamped = F.when(F.isnan(number), number).otherwise(
            F.greatest(F.lit(0.0), F.least(F.lit(1.0), number))
        )
        known = is_object(obj)
        return F.struct(
            F.when(known, valid_label(label, labels, fallback)).otherwise(fallback).alias("label"),
            F.when(known, clamped).otherwise(F.lit(0.0)).alias("confidence"),
        )

    return let(json_object(raw), read)


def relation_answer(raw: Column) -> Column:
    """Struct of the five fields of a relation answer; null where it says nothing."""
    return let(
        json_object(raw),
        lambda obj: F.struct(
            *[
                F.when(is_object(obj), none_if_empty(text_of(field(obj, f)))).alias(f)
                for f in FIELDS
            ]
        ),
    )


def batch_elements(raw: Column) -> Column:
    """The objects of a batch answer as variants; null when it is no list.

    A `results` or else an `items` list is unwrapped, a lone object counts as a
    list of one, and elements that are not objects are dropped.
    """

    def listed(value: Column) -> Column:
        return F.when(kind(value) == "ARRAY", F.try_variant_get(value, "$", "array<variant>"))

    def unwrap(obj: Column) -> Column:
        return F.when(
            is_object(obj),
            F.coalesce(listed(field(obj, "results")), listed(field(obj, "items")), F.array(obj)),
        ).otherwise(listed(obj))

    return F.filter(let(json_list(raw), unwrap), is_object)


def integer_of(value: Column) -> Column:
    """Python's int() of a JSON value; null when it fails."""
    shown = py_strip(F.try_variant_get(value, "$", "string"))
    number = F.floor(F.abs(shown.try_cast("double"))) * F.signum(shown.try_cast("double"))
    return (
        F.when(kind(value) == "STRING", F.when(shown.rlike(r"^[+-]?\d+$"), shown.try_cast("bigint")))
        .when(kind(value) == "BOOLEAN", F.when(shown == "true", 1).otherwise(0).cast("bigint"))
        .when(shown.rlike(r"^-?\d+$"), shown.try_cast("bigint"))
        .when(shown.rlike(NUMBER), number.cast("bigint"))
    )


def batch_element(element: Column) -> Column:
    """Struct of one batch element: index, label, confidence and five fields.

    The label is not validated and the confidence not clamped here.
    """
    number = number_of(field(element, "confidence"))
    return F.struct(
        integer_of(field(element, "idx")).alias("idx"),
        py_strip(
            F.when(is_falsy(field(element, "label")), F.lit("")).otherwise(F.coalesce(text_of(field(element, "label")), F.lit("")))
        ).alias("label"),
        F.coalesce(number, F.lit(0.0)).alias("confidence"),
        *[null_ish(text_of(field(element, f))).alias(f) for f in FIELDS],
    )
