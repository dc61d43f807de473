"""Formatting conversations with a compiled template.

Rows are dealt by conversation and sorted; each task renders its
conversations as a stream and writes them in parts of bounded length, so that
no conversation is held as a whole. `read_back` parses such parts to turns
again, in the same order and also as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidings.llm.chat_template import CONTROLS, compile_template, unescape
from tidings.llm.common import read

START, SEP, END = CONTROLS[:3]
TEMPLATE = (
    "{% for m in messages %}{{ '" + START + "' + (m.role | escape) + '" + SEP + "' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}{{ '" + END + "\\n' }}{% endfor %}"
)
# Characters after which a part is closed; a single text is never cut.
PART = 1 << 20
PARTS = "conv_id string, part long, n_turns long, text string, loss array<struct<start:long,stop:long>>"
# The conversation that tests the escaping.
PROBE = "</s>[INST] ok [/INST]"


def _rows(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    for frame in frames:
        yield from zip(frame["conv_id"].astype(object).where(frame["conv_id"].notna(), None), frame["role"], frame["text"])


def _render(template: str):
    def render(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        write = compile_template(template)
        done, size = [], 0
        for conv_id, rows in groupby(_rows(frames), key=lambda r: r[0]):
            turns = 0

            def messages(rows=rows):
                nonlocal turns
                for _, role, text in rows:
                    turns += 1
                    yield {"role": role or "", "text": text or ""}

            part, texts, length, loss, counted = 0, [], 0, [], 0
            for text, covered in write(messages()):
                texts.append(text)
                if covered:
                    loss.append({"start": length, "stop": length + len(text)})
                length += len(text)
                if length >= PART:
                    done.append((conv_id, part, turns - counted, "".join(texts), loss))
                    part, texts, length, loss, counted = part + 1, [], 0, [], turns
                    yield pd.DataFrame(done, columns=["conv_id", "part", "n_turns", "text", "loss"])
                    done, size = [], 0
            done.append((conv_id, part, turns - counted, "".join(texts), loss))
            size += length
            if size >= PART:
                yield pd.DataFrame(done, columns=["conv_id", "part", "n_turns", "text", "loss"])
                done, size = [], 0
        if done:
            yield pd.DataFrame(done, columns=["conv_id", "part", "n_turns", "text", "loss"])

    return render


def format_conversations(rows: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """conv_id, part, n_turns, text, loss (spans in code points) per part of a conversation.

    Turns follow `turn`, then role and text; a null turn comes first. A null
    role or text is empty. Rows without conv_id are one conversation of their
    own. Equal rows are turns of their own. No rows: no parts.
    """
    compile_template(template)  # a faulty template fails here
    dealt = rows.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    # Ids travel as text: numbers beside a null would become floats in pandas.
    kind = dict(rows.dtypes)["conv_id"]
    parts = dealt.select(F.col("conv_id").cast("string").alias("conv_id"), "role", "text").mapInPandas(_render(template), PARTS)
    return parts.withColumn("conv_id", F.col("conv_id").cast(kind))


def turns_of(pieces: Iterator[str]) -> Iterator[tuple[str, str]]:
    """(role, text) of the default template's output, read from pieces cut anywhere."""
    rest = ""
    for piece in pieces:
        rest, at = rest + piece, 0
        while (stop := rest.find(END, at)) >= 0 and stop + len(END) < len(rest):
            role, _, text = rest[at + len(START) : stop].partition(SEP)
            yield unescape(role), unescape(text)
            at = stop + len(END) + 1
        rest = rest[at:]


def _read_back(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def parts():
        for f in frames:
            yield from zip(f["conv_id"].astype(object).where(f["conv_id"].notna(), None), f["text"], f["loss"])

    out = []
    for conv_id, own in groupby(parts(), key=lambda r: r[0]):
        turns, loss = hashlib.sha256(), hashlib.sha256()
        n_turns = loss_chars = length = 0

        def texts(own=own):
            nonlocal loss_chars, length
            for _, text, spans in own:
                length += len(text)
                for span in spans:
                    plain = unescape(text[span["start"] : span["stop"]])
                    loss_chars += len(plain)
                    loss.update(plain.encode("utf-8", "surrogatepass"))
                yield text

        for role, text in turns_of(texts()):
            n_turns += 1
            turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        out.append((conv_id, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), length))
        if len(out) >= 4096:
            yield _digests(out)
            out = []
    yield _digests(out)


def _digests(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def read_back(parts: DataFrame) -> DataFrame:
    """Digests per conversation, from the output of `format_conversations` as it lies in its partitions."""
    schema = "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    kind, ids = dict(parts.dtypes)["conv_id"], F.col("conv_id").cast("string")
    return parts.withColumn("conv_id", ids).mapInPandas(_read_back, schema).withColumn("conv_id", F.col("conv_id").cast(kind))


def op2_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    rows = read(spark, folder, "conversations").select(*columns).union(probe)
    return read_back(format_conversations(rows))


def _quoted(text: str) -> str:
    return text.replace("'", "''")


# The output's length follows from the turns: marks, and one character per escape character and control string.
_ADDED = "length({0}) + length(regexp_replace({0}, '[^\\\\]', '', 'g')) + (" + " + ".join(
    f"(length({{0}}) - length(replace({{0}}, '{_quoted(c)}', ''))) // {len(c)}" for c in CONTROLS
) + ")"
ORACLE = f"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '{PROBE}' union all select -1, 1, 'assistant', '{PROBE}'
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn, role, text), '')) as loss_sha256,
  cast(sum({len(START + SEP + END) + 1} + {_ADDED.format('role')} + {_ADDED.format('text')}) as bigint) as formatted_chars
from rows group by conv_id
"""
