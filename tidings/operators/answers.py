"""Prompts, batches and answers of a language model as tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidings.functions import answers as A
from tidings.functions.lexicon import FIELDS, NO_EVENT
from tidings.operators import ledger
from tidings.operators.sampling import with_row_index
from tidings.session import fresh_path, written

# --- prompts ---------------------------------------------------------------
# The instructions decide what the model answers.

CLASS_SYSTEM = (
    "Jesteś klasyfikatorem typu zdarzenia dla polskich nagłówków/zdania. "
    "Masz zwrócić WYŁĄCZNIE poprawny JSON, bez żadnych komentarzy ani dodatkowego tekstu. "
    "Pole 'label' musi być jedną z dozwolonych etykiet. "
    "Pole 'confidence' to liczba 0-1 (twoja subiektywna pewność)."
)
CLASS_PROMPT = (
    "Dozwolone etykiety: [{labels}].\n"
    "Sklasyfikuj zdanie do jednej etykiety. Jeśli nie pasuje do żadnej, wybierz BRAK_ZDARZENIA (jeśli dostępne).\n"
    'Zwróć JSON w formacie: {"label": "ETK", "confidence": 0.0}.\n\n'
    "Zdanie: {text}"
)
RELATION_SYSTEM = (
    "Jesteś ekstraktorem informacji ze zdania po polsku. "
    "Wyciągnij pola zdarzenia: KTO (sprawca/podmiot), CO (obiekt/dopełnienie), "
    "TRIGGER (czasownik/akcja), GDZIE (lokalizacja), KIEDY (czas). "
    "Zwróć WYŁĄCZNIE poprawny JSON bez dodatkowego tekstu. "
    "Nie zmyślaj: jeśli czegoś nie ma w zdaniu, ustaw null. "
    "TRIGGER zwróć najlepiej jako bezokolicznik (np. 'uderzyć', 'pobić')."
)
RELATION_PROMPT = (
    'Zwróć JSON w formacie: {"who": string|null, "what": string|null, "trigger": string|null, '
    '"where": string|null, "when": string|null}.\n\n'
    "Zdanie: {text}"
)
BATCH_SYSTEM = (
    "Jesteś systemem do ekstrakcji informacji z polskich zdań. "
    "Dla każdego zdania masz zwrócić: label (typ zdarzenia), confidence (0-1), "
    "who/what/trigger/where/when. "
    "Zwróć WYŁĄCZNIE poprawny JSON (bez komentarzy), jako listę obiektów. "
    "Nie zmyślaj: jeśli brak informacji, ustaw null. "
    "trigger zwróć najlepiej jako bezokolicznik."
)
BATCH_PROMPT = (
    "Dozwolone etykiety label: [{labels}].\n"
    "Jeśli nie pasuje do żadnej, wybierz BRAK_ZDARZENIA (jeśli jest w słowniku).\n"
    "Wejście to lista obiektów {idx, sentence}.\n"
    "Wyjście ma być listą obiektów dokładnie w formacie:\n"
    '[{"idx": 0, "label": "...", "confidence": 0.0, '
    '"who": null, "what": null, "trigger": null, "where": null, "when": null}, ...]'
    "\n\n"
    "Wejście: {text}"
)


def label_list(labels: list[str]) -> Column:
    """Distinct labels in order, as an array literal."""
    names = sorted(set(labels))
    if not names:
        raise ValueError("there are no labels to choose from")
    return F.array(*[F.lit(x) for x in names])


def prompt(template: str, text: Column, labels: Column | None = None) -> Column:
    """The template with the labels and the text put in."""
    before, after = template.split("{text}")
    head = F.lit(before)
    if labels is not None:
        start, end = before.split("{labels}")
        head = F.concat(F.lit(start), F.array_join(labels, ", "), F.lit(end))
    return F.concat(head, text, F.lit(after))


# --- batches ---------------------------------------------------------------


def micro_batches(numbered: DataFrame, size: int) -> DataFrame:
    """`batch, items`: consecutive rows as a JSON list of `{idx, sentence}`.

    A group never has more than `size` rows.
    """
    size = max(1, size)
    return (
        numbered.select(F.floor(F.col("idx") / size).alias("batch"), "idx", "sentence")
        .groupBy("batch")
        .agg(F.sort_array(F.collect_list(F.struct("idx", "sentence"))).alias("rows"))
        .select("batch", _json_list(F.col("rows")).alias("items"))
    )


def _json_list(rows: Column) -> Column:
    """`[{"idx": 0, "sentence": "..."}, ...]` with the blanks a JSON writer's defaults put in."""

    def element(row: Column) -> Column:
        text = F.to_json(F.struct(F.coalesce(row["sentence"], F.lit("")).alias("s")))
        quoted = F.when(row["sentence"].isNull(), F.lit("null")).otherwise(F.regexp_extract(text, r"(?s)^\{\"s\":(.*)\}$", 1))
        return F.concat(F.lit('{"idx": '), row["idx"].cast("string"), F.lit(', "sentence": '), quoted, F.lit("}"))

    return F.concat(F.lit("["), F.array_join(F.transform(rows, element), ", "), F.lit("]"))


# --- answers ---------------------------------------------------------------


def parse_class_answers(df: DataFrame, labels: list[str], raw: str = "raw") -> DataFrame:
    """Replace `raw` by `label, confidence`."""
    known = label_list(labels)
    answer = A.class_answer(F.col(raw), known, A.fallback_label(known, NO_EVENT))
    kept = [c for c in df.columns if c != raw]
    return df.withColumn("_a", answer).select(*kept, "_a.label", "_a.confidence")


def parse_relation_answers(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Replace `raw` by the five relation columns."""
    kept = [c for c in df.columns if c != raw]
    return df.withColumn("_a", A.relation_answer(F.col(raw))).select(
        *kept, *[F.col(f"_a.{f}").alias(f) for f in FIELDS]
    )


def parse_batch_answers(df: DataFrame, raw: str = "raw") -> DataFrame:
    """One row per answered element with its position; rows without idx are dropped."""
    kept = [c for c in df.columns if c != raw]
    elements = df.select(*kept, F.posexplode(A.batch_elements(F.col(raw))).alias("pos", "_e"))
    read = elements.select(*kept, "pos", A.batch_element(F.col("_e")).alias("_a"))
    return read.where("_a.idx IS NOT NULL").select(*kept, "pos", "_a.*")


def last_answers(parsed: DataFrame, order: list[str]) -> DataFrame:
    """Per idx the last answer in `order`.

    A grouped maximum: repeated answers collapse before the shuffle.
    """
    values = [c for c in parsed.columns if c not in ("idx", *order)]
    return (
        parsed.groupBy("idx")
        .agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_last"))
        .select("idx", "_last.*")
    )


def rejoin_answers(numbered: DataFrame, answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with their answer, and the rows that got none."""
    return numbered.join(answers, "idx"), numbered.join(answers.select("idx"), "idx", "left_anti")


def ask_in_batches(
    df: DataFrame,
    load_chat: Callable[[], Callable[[str, str], str]],
    labels: list[str],
    *,
    batch_size: int = 1,
    order: tuple[str, ...] = ("id", "sentence"),
    answers_path: str | None = None,
    commit: int = ledger.COMMIT,
) -> DataFrame:
    """Label, confidence, five fields and `error` for every sentence from a caller's chat.

    `load_chat()` runs once per Python worker and gives `chat(system, user)`.
    With a batch size above 1 whole batches are asked first; a failed call or a
    sentence without an answer is asked for on its own. Every answer goes into
    a ledger before it is read: with the same `answers_path` a run that was
    broken off goes on where it stopped, and a rerun asks only for what failed.
    A sentence whose own calls failed has nulls and the error.
    """
    known = label_list(labels)
    path = answers_path or fresh_path(df.sparkSession, "answers")
    numbered = written(with_row_index(df, list(order)), "numbered-rows")
    answered, open_rows = None, numbered
    if batch_size > 1:
        user = prompt(BATCH_PROMPT, F.col("items"), known)
        asked = written(_requests(micro_batches(numbered, batch_size), "batch", "batch", BATCH_SYSTEM, user), "batch-calls")
        raw = asked.join(ledger.ask(asked, load_chat, f"{path}/batch", commit=commit), "call").select("batch", "raw")
        size = F.lit(batch_size)
        parsed = parse_batch_answers(raw).where(F.floor(F.col("idx") / size) == F.col("batch"))
        answers = written(last_answers(parsed, ["pos"]).drop("batch"), "batch-answers")
        answered, open_rows = rejoin_answers(numbered, answers)
    single = open_rows.select("*")
    for kind, system, text in (("class", CLASS_SYSTEM, prompt(CLASS_PROMPT, F.col("sentence"), known)), ("relation", RELATION_SYSTEM, prompt(RELATION_PROMPT, F.col("sentence")))):
        asked = written(_requests(open_rows, "idx", kind, system, text), f"{kind}-calls")
        found = ledger.ask(asked, load_chat, f"{path}/{kind}", commit=commit)
        found = asked.join(found, "call").select("idx", F.col("raw").alias(f"{kind}_raw"), F.col("error").alias(f"{kind}_error"))
        single = single.join(found, "idx")
    single = written(single, "single-answers").withColumn("error", F.coalesce("class_error", "relation_error"))
    single = parse_relation_answers(parse_class_answers(single, labels, "class_raw"), "relation_raw")
    failed = {c: F.when(F.col("error").isNull(), F.col(c)) for c in ("label", "confidence", *FIELDS)}
    single = single.withColumns(failed).select(*numbered.columns, "label", "confidence", *FIELDS, "error")
    if answered is None:
        return single
    return answered.withColumn("error", F.lit(None).cast("string")).select(*single.columns).unionByName(single)


def _requests(rows: DataFrame, key: str, kind: str, system: str, user: Column) -> DataFrame:
    """`key, call, system, user`; a call is named by its kind, place and text."""
    call = F.concat_ws(":", F.lit(kind), F.col(key).cast("string"), F.md5(F.coalesce(user, F.lit(""))))
    return rows.select(key, call.alias("call"), F.lit(system).alias("system"), user.alias("user"))
