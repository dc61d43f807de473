"""Event records: class, confidence and relations in one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidings.functions.lexicon import NO_EVENT


def extract_event(df: DataFrame) -> DataFrame:
    """Records from rows with label, confidence, sentence and the five relations.

    Without an event there is no who, what or trigger; where and when stay.
    """

    def of_event(name: str) -> Column:
        return F.when(~F.col("label").eqNullSafe(F.lit(NO_EVENT)), F.col(name)).alias(name)

    kept = [c for c in df.columns if c not in RECORD_INPUTS]
    return df.select(
        *kept,
        F.col("label").alias("event_type"),
        of_event("who"),
        of_event("what"),
        of_event("trigger"),
        "where",
        "when",
        "confidence",
        "sentence",
    )


RECORD_INPUTS = ("label", "who", "what", "trigger", "where", "when", "confidence", "sentence")

# The captions of a printed record, in print order.
TYPE_CAPTION = "Typ zdarzenia"
CAPTIONS = {"who": "KTO", "what": "CO", "trigger": "Trigger", "where": "GDZIE", "when": "KIEDY"}
CONFIDENCE_CAPTION = "Pewność"


def two_decimals(number: Column) -> Column:
    """The binary value rounded to two decimals, ties to the even digit.

    Below 4 the value times 2**60 is a whole number up to parts far below a
    step, so the comparison with half a step is exact. Spark's own formatting
    rounds the shortest decimal text instead.
    """

    scaled = F.abs(number * F.lit(float(1 << 60))).cast("bigint").cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)")
    step = F.lit(1 << 60).cast("decimal(20,0)")
    rest, whole = scaled % step, ((scaled - scaled % step) / step).cast("bigint")
    up = (rest * 2 > step) | ((rest * 2 == step) & (whole % 2 == 1))
    cents = whole + up.cast("bigint")
    sign = F.when((number < 0), F.lit("-")).otherwise("")
    shown = F.concat(sign, F.floor(cents / 100).cast("bigint").cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
    return F.when(F.abs(number) < 4, shown).otherwise(F.format_string("%.2f", number))


def record_text() -> Column:
    """A record as lines of text; empty fields have no line."""
    lines = [F.concat(F.lit(f"{TYPE_CAPTION}: "), F.col("event_type"))]
    for name, caption in CAPTIONS.items():
        lines.append(F.when(F.col(name) != "", F.concat(F.lit(f"{caption}: "), F.col(name))))
    lines.append(F.concat(F.lit(f"{CONFIDENCE_CAPTION}: "), two_decimals(F.col("confidence"))))
    return F.concat_ws("\n", *lines)
