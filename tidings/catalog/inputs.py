"""The operators' input tables, derived from the whole driver tables.

Each adaptor exists twice: as a Spark DataFrame and as a DuckDB CTE of the
same name. Nothing is cut, sampled or filtered; the arithmetic on ids only
makes some rows dirty so that every rule has something to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidings.functions.text import WHITESPACE

# The white-space set as a DuckDB expression.
DUCK_WS = "(" + "||".join(f"chr({ord(ch)})" for ch in WHITESPACE) + ")"


def duck_strip(expr: str) -> str:
    return f"trim({expr}, {DUCK_WS})"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- headlines and tags ----------------------------------------------------

_HEADLINES = """
select case when doc_id%17=0 then 'x'||cast(doc_id as string) else cast(doc_id as string) end as id,
       case when doc_id%13=0 then '  ' else '  '||text end as headline
from documents"""

_TAGGED = """
select case when doc_id%29=0 then 'NA' else cast(doc_id as string) end as id,
       case when toxic=1 then 'PRZESTEPSTWO (tox)' when quality=1 then ' POLITYKA '
            when doc_id%3=0 then 'BRAK_ZDARZENIA' when doc_id%31=1 then '(?)' else 'WYPADEK(x' end as kategoria,
       case when doc_id%5=0 then null else '  kto '||cast(doc_id%7 as string) end as KTO,
       case when doc_id%7=0 then null else 'co '||cast(doc_id%11 as string)||'  ' end as CO,
       case when doc_id%4=0 then ' ' else 'trigger' end as TRIGGER,
       case when doc_id%3=0 then null else 'gdzie' end as GDZIE,
       case when doc_id%2=0 then null else 'kiedy' end as KIEDY
from labels"""


def headlines(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(_HEADLINES.replace("from documents", "from {t}"), t=table(spark, sf, "documents"))


def tagged(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(_TAGGED.replace("from labels", "from {t}"), t=table(spark, sf, "labels"))


HEADLINES_CTE = f"headlines as ({_HEADLINES})"
TAGGED_CTE = f"tagged as ({_TAGGED})"

# Cleaning of both tables as the rules state it, for the oracle only.
CLEAN_CTE = f"""{HEADLINES_CTE}, {TAGGED_CTE},
 h as (select case when regexp_full_match(id,'[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') then cast(id as double) end as id,
        {duck_strip('headline')} as sentence from headlines),
 t as (select case when regexp_full_match(id,'[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') then cast(id as double) end as id,
        {duck_strip("split_part(kategoria,'(',1)")} as label, KTO, CO, TRIGGER, GDZIE, KIEDY from tagged),
 joined as (select h.id, sentence, label, KTO, CO, TRIGGER, GDZIE, KIEDY from h join t on h.id=t.id
        where sentence<>'' and label<>'')"""


# --- sentences: every text cut into sentences, nothing left out -------------

SENTENCE = r"[^.!?\r\n]+"
_SENTENCES_DUCK = f"""select doc_id, unnest(parts) as sentence, cast(generate_subscripts(parts,1)-1 as bigint) as s
 from (select doc_id, regexp_extract_all(text,'{SENTENCE}') as parts from documents)"""
SENTENCES_CTE = f"sentences as ({_SENTENCES_DUCK})"


def sentences(spark: SparkSession, sf: str) -> DataFrame:
    """`doc_id, s, sentence`, spread over all cores.

    The driver tables are single small files, which Spark reads in one task;
    on a table of many files the repartition is a shuffle of the texts only.
    """
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = table(spark, sf, "documents").select("doc_id", "text").repartition(spread, "doc_id")
    return docs.select(
        "doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(SENTENCE), F.lit(0))).alias("s", "sentence")
    ).withColumn("s", F.col("s").cast("bigint"))


# --- phrases: predictions beside gold, from all words of a sentence ---------

_PHRASES = {
    "who": "case when k%7=0 then null when k%3=0 then {4} else {0,2} end",
    "gold_who": "case when k%5=0 then '' when k%4=1 then coalesce({0,1,3},'') else coalesce({0,1},'') end",
    "what": "case when k%6=0 then null else {1,3} end",
    "gold_what": "case when k%4=0 then '  ' when k%3=1 then coalesce({1,2,3,4},'') else coalesce({1,3},'') end",
    "trigger": "lower({1})",
    "gold_trigger": "case when k%8=0 then '' else coalesce({1},'') end",
    "where": "case when k%3=0 then null else {2} end",
    "gold_where": "case when k%5=1 then '' else coalesce({2,3},'') end",
    "when": "case when k%4=0 then {3} end",
    "gold_when": "case when k%2=0 then '' else coalesce({3},'') end",
}


def _pick(template: str, pick) -> str:
    import re

    return re.sub(r"\{([0-9,]+)\}", lambda m: pick(m.group(1)), template)


_PHRASES_DUCK = ", ".join(
    _pick(sql, lambda m: f"string_agg(w,' ' order by i) filter (where i%5 in ({m}))") + f' as "{name}"'
    for name, sql in _PHRASES.items()
)
PHRASES_CTE = f"""{SENTENCES_CTE},
 phrase_words as (select doc_id, s, unnest(case when len(ws)=0 then [null] else ws end) as w,
   cast(unnest(case when len(ws)=0 then [0] else range(len(ws)) end) as bigint) as i
   from (select doc_id, s, regexp_extract_all(sentence,'[\\p{{L}}\\p{{N}}_]+') as ws from sentences)),
 phrases as (select doc_id*100000+s as id, case when k%2=0 then 'WYPADEK' else 'POLITYKA' end as label,
   cast(s as varchar)||':'||cast(doc_id as varchar) as sentence, * exclude (doc_id, s, k)
   from (select doc_id, s, k, {_PHRASES_DUCK} from (select *, doc_id+s as k from phrase_words) group by doc_id, s, k))"""


def phrases(spark: SparkSession, sf: str) -> DataFrame:
    words = sentences(spark, sf).select(
        "doc_id",
        "s",
        (F.col("doc_id") + F.col("s")).alias("k"),
        F.regexp_extract_all("sentence", F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)).alias("ws"),
    )

    def spark_pick(mods: str) -> str:
        return f"nullif(array_join(filter(ws,(w,i)->i%5 in ({mods})),' '),'')"

    return words.selectExpr(
        "doc_id*100000+s as id",
        "case when k%2=0 then 'WYPADEK' else 'POLITYKA' end as label",
        "cast(s as string)||':'||cast(doc_id as string) as sentence",
        *[f"{_pick(sql, spark_pick)} as `{name}`" for name, sql in _PHRASES.items()],
    )


# --- annotated sentences: one rooted tree per sentence ----------------------
# The attributes are arithmetic and mean nothing; they let every rule fire.

TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\p{Z}]"
_POS = """case when {i}=r then case k%8 when 3 then 'AUX' when 6 then 'AUX' when 4 then 'NOUN' when 5 then 'ADJ' when 7 then 'PROPN' else 'VERB' end
 when length({w})=1 and lower({w})=upper({w}) and not ({w}>='0' and {w}<='9') then 'PUNCT'
 else case (doc_id+2*{i}+s)%9 when 1 then 'PROPN' when 2 then 'ADP' when 4 then 'ADJ' when 5 then case when k%3=1 then 'VERB' else 'NOUN' end
  when 6 then 'DET' when 8 then case when k%5=2 then 'AUX' else 'NOUN' end else 'NOUN' end end"""
_ATTRIBUTES = {
    "i": "{i}",
    "text": "case when ({i}*5+k)%97=0 then 'Jutro' when ({i}+k)%19=5 then '–' else {w} end",
    "ws": "case when {i}%7=6 then '' else ' ' end",
    "lemma": """case when {pos}='ADP' then case ({i}+k)%5 when 0 then 'w' when 1 then 'Na' when 2 then 'po' when 3 then 'z' else 'od' end
 when ({i}*3+k)%37=0 then 'Las' when ({i}+k)%41=0 then 'środa' when ({i}+k)%43=0 then 'maj' when ({i}+k)%47=0 then '5 proc' else {w} end""",
    "pos": "{pos}",
    "dep": """case when {i}=r then 'ROOT' else case (doc_id*5+{i}*7+s)%12 when 0 then 'nsubj' when 1 then 'obj' when 2 then 'obl:arg' when 3 then 'obl'
 when 4 then 'nmod' when 5 then 'case' when 6 then 'xcomp' when 7 then 'iobj' when 8 then 'ccomp' when 9 then 'acl:relcl' when 10 then 'nsubj:pass' else 'amod' end end""",
    "head": "case when {i}=r then {i} when {i}%3=0 then r when {i}>r then {i}-1 else {i}+1 end",
    "ent_type": "case (doc_id+{i}+s)%29 when 1 then 'persName' when 4 then 'placeName' when 7 then 'date' when 11 then 'geogName' else '' end",
    "verb_form": "case when {pos} in ('VERB','AUX') and ({i}+k)%2=0 then 'Fin' else '' end",
}

TOKENS_CTE = f"""{SENTENCES_CTE},
 token_words as (select doc_id, s, doc_id+s as k, len(ws) as n, (doc_id+s)%greatest(least(len(ws),3),1) as r, ws
   from (select doc_id, s, regexp_extract_all(sentence,'{TOKEN}') as ws from sentences)),
 token_pos as (select *, {_POS.format(i='i', w='w')} as p from
   (select doc_id, s, k, n, r, unnest(ws) as w, cast(unnest(range(n)) as bigint) as i from token_words)),
 tokens as (select doc_id, s, n, {', '.join(f"{sql.format(i='i', w='w', pos='p')} as {name}" for name, sql in _ATTRIBUTES.items())} from token_pos),
 ents as (select doc_id, s, i as "start", least(i+2,n) as "end", ent_type as label from tokens where ent_type<>'')"""


# The same attributes for Spark, whose lambdas are interpreted: a value is looked up by its
# place in a list instead of one comparison per arm, and what holds for a sentence is a column.
_KINDS = """array('NOUN', 'PROPN', 'ADP', 'NOUN', 'ADJ', if(k%3=1, 'VERB', 'NOUN'), 'DET', 'NOUN', if(k%5=2, 'AUX', 'NOUN'))"""
_ROOT_KIND = """coalesce(get(array('VERB', 'VERB', 'VERB', 'AUX', 'NOUN', 'ADJ', 'AUX', 'PROPN'), cast(k%8 as int)), 'VERB')"""
_SPARK_POS = """case when i=r then root_kind
 when length(w)=1 and lower(w)=upper(w) and not (w>='0' and w<='9') then 'PUNCT'
 else coalesce(get(kinds, cast((k+2*i)%9 as int)), 'NOUN') end"""
_SPARK_ATTRIBUTES = _ATTRIBUTES | {
    "lemma": """case when {pos}='ADP' then coalesce(get(array('w', 'Na', 'po', 'z'), cast(({i}+k)%5 as int)), 'od')
 when ({i}*3+k)%37=0 then 'Las' when ({i}+k)%41=0 then 'środa' when ({i}+k)%43=0 then 'maj' when ({i}+k)%47=0 then '5 proc' else {w} end""",
    "dep": """case when {i}=r then 'ROOT' else coalesce(get(array('nsubj', 'obj', 'obl:arg', 'obl', 'nmod', 'case', 'xcomp', 'iobj', 'ccomp',
 'acl:relcl', 'nsubj:pass'), cast((k5+{i}*7)%12 as int)), 'amod') end""",
    "head": f"cast({_ATTRIBUTES['head']} as int)",
    "ent_type": """coalesce(get(array('', 'persName', '', '', 'placeName', '', '', 'date', '', '', '', 'geogName'), cast((k+{i})%29 as int)), '')""",
}


def annotated(spark: SparkSession, sf: str, text: DataFrame | None = None, keep=()) -> DataFrame:
    """`doc_id, s, tokens, ents` for every sentence, and the columns to keep."""
    text = sentences(spark, sf) if text is None else text
    words = text.select(
        "doc_id", "s", *keep, F.regexp_extract_all("sentence", F.lit(TOKEN), F.lit(0)).alias("ws")
    )
    words = words.selectExpr(
        "doc_id", "s", *keep, "doc_id+s as k", "doc_id*5+s as k5", "size(ws) as n", "(doc_id+s)%greatest(least(size(ws),3),1) as r", "ws"
    )
    words = words.selectExpr("*", f"{_KINDS} as kinds", f"{_ROOT_KIND} as root_kind")
    struct = ", ".join(
        f"'{name}', {sql.format(i='t.i', w='t.w', pos='t.pos')}" for name, sql in _SPARK_ATTRIBUTES.items()
    )
    tokens = words.selectExpr(
        "doc_id",
        "s",
        *keep,
        "n",
        f"""transform(transform(ws, (w,i) -> named_struct('w', w, 'i', i, 'pos', {_SPARK_POS})),
            t -> named_struct({struct})) as tokens""",
    )
    return tokens.selectExpr(
        "doc_id",
        "s",
        *keep,
        "tokens",
        """transform(filter(tokens, t -> t.ent_type<>''),
            t -> named_struct('start', t.i, 'end', least(t.i+2,n), 'label', t.ent_type)) as ents""",
    )
