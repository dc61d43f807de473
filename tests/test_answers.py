import json

import pytest
from pyspark.sql import functions as F

from tidings.functions import answers as A
from tidings.operators import answers as ops

LABELS = ["WYPADEK", "BRAK_ZDARZENIA", "PROTEST"]


def column(spark, values, fn):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, raw string")
    return [r.x for r in df.select("k", fn(F.col("raw")).alias("x")).orderBy("k").collect()]


def test_only_whole_json_counts(spark):
    cases = {
        '{"a":1}': True,
        ' {"a":1} \n': True,
        '{"a":1} {"b":2}': False,
        '{"a":1}, {"b":2}': False,
        '{"a":1}] junk': False,
        "[1, 2] tail": False,
        "[1, 2]": True,
        "": False,
        "nothing": False,
        '"text"': True,
    }
    got = column(spark, list(cases), lambda c: A.strict_json(c).isNotNull())
    assert dict(zip(cases, got)) == cases


def test_objects_in_prose(spark):
    raws = ['Oto: {"who":"a"} koniec', '{"a":1} {"b":2}', 'x {"a":{"b":1}} y', "{broken"]
    found = column(spark, raws, lambda c: A.json_object(c).cast("string"))
    assert [json.loads(x) if x else None for x in found] == [{"who": "a"}, None, {"a": {"b": 1}}, None]


def test_class_answers(spark):
    raws = [
        '{"label":"wypadek ","confidence":"0.5"}',
        '{"label":"inne","confidence":7}',
        '{"label":"PROTEST"}',
        '{"label":null,"confidence":true}',
        '["PROTEST"]',
        "x",
        None,
    ]
    df = spark.createDataFrame([(k, r) for k, r in enumerate(raws)], "k int, raw string")
    got = [(r.label, r.confidence) for r in ops.parse_class_answers(df, LABELS).orderBy("k").collect()]
    assert got == [
        ("WYPADEK", 0.5),
        ("BRAK_ZDARZENIA", 1.0),
        ("PROTEST", 0.0),
        ("BRAK_ZDARZENIA", 1.0),
        ("BRAK_ZDARZENIA", 0.0),
        ("BRAK_ZDARZENIA", 0.0),
        ("BRAK_ZDARZENIA", 0.0),
    ]
    first = ops.parse_class_answers(df, ["B", "A"]).where("k = 5").first()
    assert first.label == "A"


def test_batch_answers_last_wins(spark):
    raw = json.dumps(
        {"results": [
            {"idx": 0, "label": " X ", "confidence": 3, "who": "null", "what": " "},
            {"idx": "1", "label": "Y", "confidence": "0.5"},
            {"idx": "1.5", "label": "no"},
            {"label": "no"},
            7,
            {"idx": 0, "label": "Z", "confidence": "?"},
        ]}
    )
    df = spark.createDataFrame([(0, raw), (1, "5"), (2, 'x [{"idx": 9}] y')], "batch int, raw string")
    parsed = ops.parse_batch_answers(df)
    assert sorted((r.batch, r.pos, r.idx) for r in parsed.collect()) == [(0, 0, 0), (0, 1, 1), (0, 4, 0), (2, 0, 9)]
    first = parsed.where("pos = 0 AND batch = 0").first()
    assert (first.label, first.confidence, first.who, first.what) == ("X", 3.0, None, " ")
    last = {r.idx: (r.label, r.confidence) for r in ops.last_answers(parsed, ["batch", "pos"]).collect()}
    assert last == {0: ("Z", 0.0), 1: ("Y", 0.5), 9: ("", 0.0)}


def load_chat():
    def chat(system, user):
        if system == ops.BATCH_SYSTEM:
            items = json.loads(user.split("Wejście: ", 1)[1])
            if any("awaria" in i["sentence"] for i in items):
                raise RuntimeError("no answer")
            kept = [i for i in items if "pomiń" not in i["sentence"]]
            return json.dumps([{"idx": i["idx"], "label": "BATCH", "who": i["sentence"]} for i in kept])
        if system == ops.CLASS_SYSTEM:
            return '{"label": "PROTEST", "confidence": 0.7}'
        return json.dumps({"who": "single", "what": "none"})

    return chat


def test_batches_fall_back_to_single_calls(spark):
    texts = ["a", "b", "pomiń", "c", "awaria", "d", "d"]
    df = spark.createDataFrame([(float(k), t) for k, t in enumerate(texts)], "id double, sentence string")
    got = ops.ask_in_batches(df, load_chat, LABELS, batch_size=2)
    rows = {(r.id, r.sentence): (r.label, r.who) for r in got.collect()}
    assert len(rows) == len(texts)
    assert rows[0.0, "a"] == ("BATCH", "a") and rows[3.0, "c"] == ("BATCH", "c")
    assert rows[2.0, "pomiń"] == rows[4.0, "awaria"] == ("PROTEST", "single")
    alone = ops.ask_in_batches(df, load_chat, LABELS)
    assert {(r.label, r.what) for r in alone.collect()} == {("PROTEST", None)}


def test_a_broken_run_goes_on_where_it_stopped(spark, tmp_path):
    from tidings.operators import ledger

    requests = spark.createDataFrame([(f"c{k}", "s", f"u{k}") for k in range(30)] + [("c0", "s", "u0")], "call string, system string, user string")
    calls, path = spark.sparkContext.accumulator(0), str(tmp_path / "ledger")

    def loader(stops=(), fails=()):
        def load():
            def chat(system, user):
                if user in stops:
                    raise SystemExit(1)
                calls.add(1)
                if user in fails:
                    raise TimeoutError(user)
                return user.upper()

            return chat

        return load

    groups = {f"c{k}": g for k, g in requests.selectExpr("cast(substr(call, 2) as int)", "pmod(xxhash64(call), 6)").collect()}
    last = max(groups, key=lambda c: (groups[c], c))
    with pytest.raises(Exception):
        ledger.ask(requests, loader(stops=(last.replace("c", "u"),)), path, commit=5).collect()
    kept = {r.call for r in ledger.ledger(spark, path).collect()}
    assert kept == {c for c, g in groups.items() if g < groups[last]} and kept
    before = calls.value
    got = ledger.ask(requests, loader(fails=("u1", last.replace("c", "u"))), path, commit=5).collect()
    assert len(got) == 30
    assert {r.call for r in got if r.error} == {last} | ({"c1"} - kept)
    assert calls.value - before == 30 - len(kept)
    before = calls.value
    again = {r.call: r for r in ledger.ask(requests, loader(), path).collect()}
    assert calls.value - before == len({last} | ({"c1"} - kept))
    assert all(r.raw == c.replace("c", "U") and r.error is None for c, r in again.items())


def test_a_failed_call_is_a_row_with_its_error(spark, tmp_path):
    df = spark.createDataFrame([(float(k), t) for k, t in enumerate(["a", "zepsute", "b"])], "id double, sentence string")

    def load(broken):
        def chat(system, user):
            if broken and "zepsute" in user:
                raise ConnectionError("no answer")
            return '{"label": "PROTEST", "confidence": 0.5, "who": "x"}'

        return lambda: chat

    path = str(tmp_path / "answers")
    got = {r.sentence: r for r in ops.ask_in_batches(df, load(True), LABELS, answers_path=path).collect()}
    assert got["zepsute"].error == "ConnectionError: no answer" and got["zepsute"].label is None
    assert got["a"].label == "PROTEST" and got["a"].error is None
    again = {r.sentence: r for r in ops.ask_in_batches(df, load(False), LABELS, answers_path=path).collect()}
    assert again["zepsute"].label == "PROTEST" and again["zepsute"].error is None


def test_batches_number_every_row(spark):
    from tidings.operators.sampling import with_row_index

    df = spark.createDataFrame([(float(k % 3), "x" if k % 2 else "y") for k in range(50)], "id double, sentence string")
    numbered = with_row_index(df, ["id", "sentence"])
    rows = numbered.orderBy("idx").collect()
    assert [r.idx for r in rows] == list(range(50))
    assert [(r.id, r.sentence) for r in rows] == sorted((r.id, r.sentence) for r in df.collect())
    batches = ops.micro_batches(numbered, 8).orderBy("batch").collect()
    items = [i for b in batches for i in json.loads(b["items"])]
    assert [i["idx"] for i in items] == list(range(50)) and len(batches) == 7


def test_values_are_shown_as_python_shows_them(spark):
    import json

    from pyspark.sql import functions as F

    from tidings.functions import answers as A

    values = ['"x"', '["A","B"]', '{"a":1}', "1.0", "1", "1e20", "1.5", "1e-7", "12345678.5", "true", '[1,"it\'s",null,2.0]', "[[1],2]"]
    df = spark.createDataFrame([(k, '{"who":%s}' % v) for k, v in enumerate(values)], "k int, raw string")
    got = [r.who for r in df.orderBy("k").select(A.relation_answer(F.col("raw"))["who"].alias("who")).collect()]
    assert got == [str(json.loads(v)) for v in values]


def test_numbers_beyond_the_standard_and_repeated_keys(spark):
    from pyspark.sql import functions as F

    from tidings.functions import answers as A

    raws = ['{"label": "A", "confidence": Infinity}', '{"label": "A", "confidence": NaN}', '{"label": "Q", "label": "A"}']
    df = spark.createDataFrame([(k, r) for k, r in enumerate(raws)], "k int, raw string")
    labels = F.array(F.lit("A"), F.lit("B"))
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    got = df.orderBy("k").select(A.class_answer(F.col("raw"), labels, F.lit("B")).alias("a")).select("a.*").collect()
    assert [r.label for r in got] == ["A", "A", "A"]
    assert got[0].confidence == 1.0


def test_falsy_labels_of_a_batch_are_empty(spark):
    from tidings.operators import answers as ops

    raw = '[{"idx":1,"label":false},{"idx":2,"label":["A"]},{"idx":3,"label":0},{"idx":4,"label":[]}]'
    rows = ops.parse_batch_answers(spark.createDataFrame([(0, raw)], "k int, raw string")).collect()
    assert {r.idx: r.label for r in rows} == {1: "", 2: "['A']", 3: "", 4: ""}


def test_batch_items_look_like_a_json_writers(spark):
    import json

    from tidings.operators import answers as ops

    items = [{"idx": 0, "sentence": 'a "q" ą\n'}, {"idx": 1, "sentence": None}]
    df = spark.createDataFrame([(i["idx"], i["sentence"]) for i in items], "idx long, sentence string")
    assert ops.micro_batches(df, 8).first()["items"] == json.dumps(items, ensure_ascii=False)


def test_bare_numbers_inside_text_stay(spark):
    raws = ['{"who": "x, NaN, y", "confidence": NaN}', '{"a": [-Infinity,Infinity , "\\", NaN]"], "b": NaN}', '{"a": NaNs}', "[" + "NaN," * 20_000 + "1]"]
    got = column(spark, raws, lambda c: F.to_json(A.strict_json(c)))
    assert json.loads(got[0]) == {"who": "x, NaN, y", "confidence": "NaN"}
    assert json.loads(got[1]) == {"a": ["-Infinity", "Infinity", '", NaN]'], "b": "NaN"}
    assert got[2] is None and len(json.loads(got[3])) == 20_001
