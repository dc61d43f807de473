"""Scoring of extracted fields against gold: matches, counts, reports.

The whole report is one aggregation without keys: every task reduces its rows
to a handful of sums, so nothing but one row per task is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F

from tidings.functions.binding import let
from tidings.functions.lexicon import FIELDS, FUNCTION_POS, PROXY_ENTITIES
from tidings.functions.text import gold_text, is_empty, py_strip

# Share of gold lemmas that must be found, by size of the gold set.
LONG_GOLD, LONG_SHARE, SHORT_SHARE = 3, 0.8, 0.5


def ratio(numerator: Column, denominator: Column) -> Column:
    """Null where the ratio is undefined."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


# --- lemma sets and matches ------------------------------------------------


def lemma_set(tokens: Column) -> Column:
    """Distinct content lemmas of an annotated phrase."""
    content = F.filter(tokens, lambda t: ~F.coalesce(t["pos"], F.lit("")).isin(*FUNCTION_POS))
    lemmas = F.transform(
        content,
        lambda t: F.lower(py_strip(F.coalesce(F.nullif(t["lemma"], F.lit("")), t["text"]))),
    )
    return F.array_distinct(F.filter(lemmas, lambda s: s.rlike(r"[\p{L}\p{N}_]")))


def surface_lemmas(phrase: Column) -> Column:
    """Lemma set when no annotator is at hand: each lower-cased word is its own lemma."""
    words = F.regexp_extract_all(F.lower(phrase), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    return F.array_distinct(words)


def _phrase_columns(fields: Iterable[str]) -> list[str]:
    return [name for f in fields for name in (f, f"gold_{f}")]


def distinct_phrases(df: DataFrame, fields: Iterable[str] = FIELDS) -> DataFrame:
    """`phrase`: every different non-empty phrase of predictions and gold, to be annotated once each."""
    phrases = df.select(F.explode(F.array(*[F.col(c) for c in _phrase_columns(fields)])).alias("phrase"))
    return phrases.where(~is_empty(F.col("phrase"))).distinct()


def lemma_dictionary(annotated: DataFrame) -> DataFrame:
    """`phrase, lemmas` from `phrase, tokens`: the sorted lemma set of each phrase."""
    return annotated.select("phrase", F.sort_array(lemma_set(F.col("tokens"))).alias("lemmas"))


def with_phrase_lemmas(df: DataFrame, dictionary: DataFrame, fields: Iterable[str] = FIELDS) -> DataFrame:
    """Add `_lemmas_<column>` to every phrase column, from a dictionary with one row per phrase.

    The phrase columns are unpivoted and joined by phrase in one join, whatever
    the number of columns, and come back by a hash of the row; rows that are
    equal share the result. A phrase that the dictionary lacks has no lemmas.
    """
    names = _phrase_columns(fields)
    keyed = df.withColumn("_row", F.unhex(F.md5(F.to_json(F.struct(*df.columns)))))
    entries = F.array(*[F.struct(F.lit(k).alias("place"), F.col(c).alias("phrase")) for k, c in enumerate(names)])
    # Copies of a row meet in the grouping, so nothing moves to tell them apart before the join; blank phrases have no lemmas.
    long = keyed.select("_row", F.inline(entries)).where(~is_empty(F.col("phrase")))
    sets = long.join(dictionary, "phrase").groupBy("_row").agg(
        *[F.max(F.when(F.col("place") == k, F.col("lemmas"))).alias(f"_lemmas_{c}") for k, c in enumerate(names)]
    )
    nothing = F.array().cast("array<string>")
    joined = keyed.join(sets, "_row", "left").drop("_row")
    return joined.withColumns({f"_lemmas_{c}": F.coalesce(f"_lemmas_{c}", nothing) for c in names})


def phrase_lemmas(name: str) -> Column:
    """For `with_matches`, behind `with_phrase_lemmas`."""
    return F.col(f"_lemmas_{name}")


def match_by_lemmas(pred: Column, gold: Column, pred_lemmas: Column, gold_lemmas: Column) -> Column:
    """Enough of the gold lemmas occur in the prediction."""

    def enough(gold_set: Column) -> Column:
        size = F.size(gold_set)
        share = F.try_divide(F.size(F.array_intersect(gold_set, pred_lemmas)), size)
        needed = F.when(size >= LONG_GOLD, LONG_SHARE).otherwise(SHORT_SHARE)
        return (size > 0) & (share >= needed)

    matched = let(gold_lemmas, enough)
    return F.when(is_empty(pred) | is_empty(gold), False).otherwise(F.coalesce(matched, F.lit(False)))


def field_ok(pred: Column, gold: Column, hit: Column, lenient: bool) -> Column:
    """Sentence-level correctness; `lenient` forgives a prediction without gold."""
    return (
        F.when(is_empty(gold), F.lit(True) if lenient else is_empty(pred))
        .when(is_empty(pred), False)
        .otherwise(hit)
    )


def with_matches(
    df: DataFrame,
    *,
    strict_when: bool = False,
    lemmas: Callable[[str], Column] | None = None,
    fields: Iterable[str] = FIELDS,
) -> DataFrame:
    """Add `_hit_<field>`, `_ok_<field>` and `_strict_when`.

    `lemmas(column_name)` gives the lemma set of a phrase column; each phrase
    is turned into its set once.
    """
    lemmas = lemmas or (lambda name: surface_lemmas(F.col(name)))
    sets = {f"_set_{name}": lemmas(name) for f in fields for name in (f, f"gold_{f}")}
    hits = {
        f"_hit_{f}": match_by_lemmas(
            F.col(f), F.col(f"gold_{f}"), F.col(f"_set_{f}"), F.col(f"_set_gold_{f}")
        )
        for f in fields
    }
    oks = {
        f"_ok_{f}": field_ok(
            F.col(f), F.col(f"gold_{f}"), F.col(f"_hit_{f}"), f == "when" and not strict_when
        )
        for f in fields
    }
    return (
        df.withColumns(sets)
        .withColumns(hits)
        .withColumns(oks)
        .withColumn("_strict_when", F.lit(strict_when))
        .drop(*sets)
    )


# --- aggregates ------------------------------------------------------------


def _count(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0))


def _share(condition: Column) -> Column:
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def prf(tp: Column, fp: Column, fn: Column) -> Column:
    """`tp, fp, fn, precision, recall, f1`; undefined ratios are null."""
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    f1 = F.try_divide(2 * precision * recall, precision + recall)
    return F.struct(
        tp.cast("double").alias("tp"),
        fp.cast("double").alias("fp"),
        fn.cast("double").alias("fn"),
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
    )


def outcomes(field: str, strict_when: bool, hit: Column | None = None) -> dict[str, Column]:
    """Aggregate expressions for true/false positives and false negatives.

    A mismatch is both a false positive and a false negative.
    """
    pred_empty, gold_empty = is_empty(F.col(field)), is_empty(F.col(f"gold_{field}"))
    hit = F.col(f"_hit_{field}") if hit is None else hit
    wrong = ~pred_empty & ~gold_empty & ~hit
    forgiven = field == "when" and not strict_when
    unasked = F.lit(False) if forgiven else ~pred_empty & gold_empty
    return {
        "tp": _count(hit & ~pred_empty & ~gold_empty),
        "fp": _count(wrong | unasked),
        "fn": _count(wrong | (pred_empty & ~gold_empty)),
    }


def _and(columns: Iterable[Column]) -> Column:
    result = None
    for c in columns:
        result = c if result is None else result & c
    return result


def _all_ok(fields: Iterable[str]) -> Column:
    return _and(F.col(f"_ok_{f}") for f in fields)


COVERAGE_FIELDS = ("who", "what", "where", "when")


def report_sums(
    *,
    strict_when: bool = False,
    coverage_fields: Iterable[str] = COVERAGE_FIELDS,
    all_fields: Column | None = None,
) -> list[Column]:
    """The report's aggregate expressions over matched rows; they may also be observed while the rows are written."""
    counts = {f: outcomes(f, strict_when) for f in FIELDS}
    flat = [F.count("*").alias("n"), *_coverage_sums(coverage_fields)]
    for f in FIELDS:
        flat.append(_share(F.col(f"_ok_{f}")).alias(f"acc_{f}"))
        flat.append(_share(~is_empty(F.col(f"gold_{f}"))).alias(f"gold_{f}"))
        flat += [agg.alias(f"{kind}_{f}") for kind, agg in counts[f].items()]
    whole = _all_ok(FIELDS) if all_fields is None else all_fields
    flat.append(_share(whole).alias("acc_all"))
    return flat


def _coverage_sums(fields: Iterable[str]) -> list[Column]:
    return [_share(~is_empty(F.col(f))).alias(f"cov_{f}") for f in fields]


def report_of(sums: DataFrame, coverage_fields: Iterable[str] = COVERAGE_FIELDS) -> DataFrame:
    """One row: `n`, `coverage`, `sentence_accuracy`, `gold_presence`, `metrics` from the row of sums."""
    return sums.select(
        "n",
        F.struct(*[F.col(f"cov_{f}").alias(f"{f}_rate") for f in coverage_fields]).alias("coverage"),
        F.struct(
            *[F.col(f"acc_{f}").alias(f) for f in FIELDS], F.col("acc_all").alias("all_fields")
        ).alias("sentence_accuracy"),
        F.struct(*[F.col(f"gold_{f}").alias(f"{f}_rate") for f in FIELDS]).alias("gold_presence"),
        F.struct(
            *[prf(F.col(f"tp_{f}"), F.col(f"fp_{f}"), F.col(f"fn_{f}")).alias(f) for f in FIELDS]
        ).alias("metrics"),
    )


def evaluation_report(
    matched: DataFrame,
    *,
    strict_when: bool = False,
    coverage_fields: Iterable[str] = COVERAGE_FIELDS,
    all_fields: Column | None = None,
) -> DataFrame:
    """One row: `n`, `coverage`, `sentence_accuracy`, `gold_presence`, `metrics`."""
    sums = report_sums(strict_when=strict_when, coverage_fields=coverage_fields, all_fields=all_fields)
    return report_of(matched.agg(*sums), coverage_fields)


def report_rows(report: DataFrame) -> DataFrame:
    """The nested report as one row per field."""
    coverage = report.schema["coverage"].dataType.fieldNames()
    fields = []
    for f in FIELDS:
        covered = F.col(f"coverage.{f}_rate") if f"{f}_rate" in coverage else F.lit(None).cast("double")
        fields.append(
            F.struct(
                F.lit(f).alias("field"),
                F.col("n"),
                covered.alias("coverage"),
                F.col(f"gold_presence.{f}_rate").alias("gold_presence"),
                F.col(f"sentence_accuracy.{f}").alias("accuracy"),
                F.col("sentence_accuracy.all_fields").alias("all_fields"),
                F.col(f"metrics.{f}").alias("m"),
            )
        )
    return report.select(F.inline(F.array(*fields))).select(
        "field", "n", "coverage", "gold_presence", "accuracy", "all_fields", "m.*"
    )


# --- proxy truth from entities ---------------------------------------------


def _entity_evidence(field: str, kinds: Iterable[str]) -> tuple[Column, Column]:
    """Whether the sentence has such an entity, and whether the field names one."""
    known = F.filter("ents", lambda e: e["label"].isin(*kinds))
    named = F.exists(known, lambda e: F.contains(F.lower(F.col(field)), F.lower(e["text"])))
    return F.size(known) > 0, named


def _proxy_aggregates() -> list[Column]:
    aggregates = []
    for f in FIELDS:
        kinds = PROXY_ENTITIES.get(f)
        if kinds is None:
            aggregates += [F.sum(F.lit(0).cast("bigint")).alias(f"{k}_{f}") for k in ("tp", "fp", "fn")]
            continue
        pred = F.coalesce(F.col(f), F.lit("")) != ""
        some, overlap = _entity_evidence(f, kinds)
        aggregates += [
            _count(pred & some & F.coalesce(overlap, F.lit(False))).alias(f"tp_{f}"),
            _count(pred & ~some).alias(f"fp_{f}"),
            _count(~pred & some).alias(f"fn_{f}"),
        ]
    return aggregates


def proxy_sums() -> list[Column]:
    """As `report_sums`, with the sentence's entities as truth: nothing is compared with gold, so those shares are 0."""
    nothing = [F.avg(F.lit(0.0)).alias(name) for f in FIELDS for name in (f"acc_{f}", f"gold_{f}")]
    return [F.count("*").alias("n"), *_coverage_sums(COVERAGE_FIELDS), *nothing, F.avg(F.lit(0.0)).alias("acc_all"), *_proxy_aggregates()]


def proxy_counts(df: DataFrame) -> DataFrame:
    """Counts per field with the sentence's entities as truth.

    `df` has the five predictions and `ents` as array of `(label, text)`.
    A prediction beside an entity it does not contain counts nothing; what and
    trigger have no entity kind and stay 0.
    """
    sums = df.agg(*_proxy_aggregates())
    counts = {f"{k}_{f}": F.coalesce(F.col(f"{k}_{f}"), F.lit(0)) for f in FIELDS for k in ("tp", "fp", "fn")}
    rows = F.array(
        *[
            F.struct(
                F.lit(f).alias("field"), *[F.col(f"{k}_{f}").alias(k) for k in ("tp", "fp", "fn")]
            )
            for f in FIELDS
        ]
    )
    return sums.withColumns(counts).select(F.inline(rows)).select(
        "field", prf(F.col("tp"), F.col("fp"), F.col("fn")).alias("m")
    ).select("field", "m.*")


# --- best matches and suggested corrections --------------------------------


def match_score() -> Column:
    """Number of correct fields, 0 to 5."""
    score = F.lit(0)
    for f in FIELDS:
        score = score + F.col(f"_ok_{f}").cast("int")
    return score


def top_matches(matched: DataFrame, n: int) -> DataFrame:
    """The n rows with the most correct fields; ties by id, sentence and a hash of the row, so only copies tie.

    The n rows are a report for readers: they meet in one task, each task before it keeps n.
    The hash is a sort expression, which is worked out only where the columns before it tie.
    """
    tie = F.md5(F.to_json(F.struct(*matched.columns)))
    top = matched.withColumn("match_score", match_score()).orderBy(F.desc("match_score"), "id", "sentence", tie).limit(n)
    # Keeps the optimizer from moving later projections below the limit, where they turn the n best into a sort of all rows.
    return top.coalesce(1)


def correct_field(field: str) -> Column:
    """Gold where it was matched, else the prediction, else gold again."""
    gold, pred = gold_text(F.col(f"gold_{field}")), gold_text(F.col(field))
    corrected = F.when(~F.col(f"_ok_{field}") & (pred != ""), pred).otherwise(gold)
    if field == "when":
        corrected = F.when(gold == "", F.lit("")).otherwise(corrected)
    return corrected


def suggested_tags(top: DataFrame) -> DataFrame:
    """Rows in the tagged file's layout with corrected fields."""
    # Column names and order of the tagged file.
    names = {"KTO": "who", "CO": "what", "TRIGGER": "trigger", "GDZIE": "where", "KIEDY": "when"}
    return top.select(
        "id",
        F.col("label").alias("kategoria"),
        *[correct_field(f).alias(name) for name, f in names.items()],
    )


def top_report(top: DataFrame, *, strict_when: bool = False) -> DataFrame:
    """Report on the best matches; its all-fields share is always strict."""
    strict = _and(
        field_ok(F.col(f), F.col(f"gold_{f}"), F.col(f"_hit_{f}"), lenient=False) for f in FIELDS
    )
    return evaluation_report(
        top, strict_when=strict_when, coverage_fields=FIELDS, all_fields=strict
    )


def corrected_report(
    top: DataFrame,
    *,
    strict_when: bool = False,
    lemmas: Callable[[str], Column] | None = None,
) -> DataFrame:
    """Report with gold replaced by its corrections; all-fields forgives WHEN."""
    replaced = top.withColumns({f"gold_{f}": correct_field(f) for f in FIELDS})
    matched = with_matches(replaced, strict_when=strict_when, lemmas=lemmas)
    lenient = _and(
        field_ok(F.col(f), F.col(f"gold_{f}"), F.col(f"_hit_{f}"), lenient=f == "when")
        for f in FIELDS
    )
    return evaluation_report(
        matched, strict_when=strict_when, coverage_fields=FIELDS, all_fields=lenient
    )
