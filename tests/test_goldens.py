"""Small cases at the edges of each operator."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tidemark import StreamConfig
from tidemark.functions import paths as P
from tidemark.functions import temporal as D
from tidemark.functions import values as V
from tidemark.operators import discover as I
from tidemark.operators.bookmark import advance_bookmark, fold_updates
from tidemark.operators.catalog import catalog_from_schema, load_schema
from tidemark.operators.messages import schema_messages
from tidemark.operators.transform import split_on_key, transform, transform_all
from tidemark.operators.validate import validate
from tidemark.sources.files import read_csv, read_jsonl
from tidemark.sources.records import records_from_table

def rec():
    return F.col("rec")
CFG = StreamConfig("s", ("id",))
TS = "2024-06-01T00:00:00Z"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def column(df, *exprs):
    rows = df.select("ord", *exprs).orderBy("ord").collect()
    return [r[1] if len(exprs) == 1 else tuple(r)[1:] for r in rows]


def test_empty_keys(records):
    texts = ['{"id":null}', "{}", '{"id":""}', '{"id":0}', '{"id":false}', '{"id":[]}', '{"id":{}}',
             '{"id":0.0}', '{"id":0e3}', '{"id":"0"}', '{"id":1}', '{"id":[0]}', '{"id":{"a":null}}']
    ok, failed = split_on_key(records(*texts), ["id"])
    assert sorted(r.ord for r in ok.collect()) == [9, 10, 11, 12]
    assert failed.count() == 9


def test_empty_keys_of_typed_columns(spark):
    df = spark.sql(
        "select * from values (0L, 0.0D, '', false, array()), (1L, 1.0D, '0', true, array(1)) "
        "as t(n, d, s, b, a)"
    )
    for name in df.columns:
        ok, failed = split_on_key(records_from_table(df, "n", name) if name != "n" else
                                  records_from_table(df, "n"), [name])
        assert [r.rec.n for r in ok.collect()] == [1], name
        assert failed.count() == 1


def test_key_text(records):
    texts = ["1", '"1"', "1e7", "12345678.5", "null", "1e21", "-2.5e-7", "true", '{"b":1,"a":2}', "5.0"]
    got = column(records(*texts), V.key_string(rec()))
    assert got == ["1", "1", "10000000", "12345678.5", "", "1000000000000000000000", "-0.00000025",
                   "true", '{"a":2,"b":1}', "5"]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_number_text_does_not_depend_on_the_session(spark, records, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        texts = ["1.5e-10", "1e-7", "-3e-8", "1.25e19", "0.00001234", "1.5e7"]
        assert column(records(*texts), V.canonical_text(rec())) == [
            "0.00000000015", "0.0000001", "-0.00000003", "12500000000000000000", "0.00001234", "15000000"
        ]
        df = spark.sql("select 1 as id, 0.00000001BD as d, 1e-9D as e")
        got = transform(records_from_table(df), StreamConfig("s", ("d",)), TS).collect()[0]
        assert (got.key, got.text) == ("0.00000001", '{"d":0.00000001,"e":0.000000001,"id":1}')
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_hashed_number_text(records):
    texts = ["42", "1e6", "1234567.5", "12345678.5", "0.0001", "0.00015", "0.00001", "999999", "1e21",
             "-1e10", "1.5e-10", '"1e6"', "true", "[1,2]"]
    got = column(records(*texts), V.value_text(rec()))
    assert got == ["42", "1e+06", "1.2345675e+06", "1.23456785e+07", "0.0001", "0.00015", "1e-05",
                   "999999", "1e+21", "-1e+10", "1.5e-10", "1e6", "true", "[1,2]"]


def test_typed_number_text(spark):
    df = spark.sql("select * from values (42L, 42.0D), (1000000L, 0.00015D), (-7654321L, 1234567.5D) as t(n, d)")
    from pyspark.sql import types as T
    got = [tuple(r) for r in df.select(V.value_text(F.col("n"), T.LongType()), V.value_text(F.col("d"), T.DoubleType())).collect()]
    assert got == [("42", "42"), ("1e+06", "0.00015"), ("-7.654321e+06", "1.2345675e+06")]


def test_numbers_of_any_size_keep_their_digits(spark, records):
    """Typed and JSON alike: no rounding, no exponent, no two numbers with one text."""
    texts = ["1e-40", "2e-39", "6.62607015e-34", "6e-40", "9e-39", "1e18", "3e25", "1.5e-19", "-1.25e300", "5e-324",
             "1.7976931348623157e308", "0.001", "123.456", "1e22"]
    zeros = "0" * 300
    want = ["0." + zeros[:39] + "1", "0." + zeros[:38] + "2", "0." + zeros[:33] + "662607015", "0." + zeros[:39] + "6",
            "0." + zeros[:38] + "9", "1" + zeros[:18], "3" + zeros[:25], "0." + zeros[:18] + "15", "-125" + zeros[:298],
            "0." + "0" * 323 + "49", "17976931348623157" + zeros[:292], "0.001", "123.456", "1" + zeros[:22]]
    assert column(records(*texts), V.canonical_text(rec())) == want
    df = spark.createDataFrame([(i, float(t)) for i, t in enumerate(texts)], "id bigint, d double")
    from pyspark.sql import types as T
    got = df.orderBy("id").select(V.typed_json(F.col("d"), T.DoubleType()), V.key_string(F.col("d"), T.DoubleType()))
    rows = got.collect()
    assert [r[0] for r in rows] == want and [r[1] for r in rows] == want


def test_long_integers_hash_apart(spark, records):
    longs = [1234567890123456789, 1234567890123456790, 2**53 + 1, 2**53 + 2, -(2**53) - 1, 2**53 - 1]
    json_texts = column(records(*map(str, longs)), V.value_text(rec()))
    df = spark.createDataFrame([(n,) for n in longs], "n bigint")
    from pyspark.sql import types as T
    typed = [r[0] for r in df.select(V.value_text(F.col("n"), T.LongType())).collect()]
    assert json_texts == typed and len(set(typed)) == len(longs) and typed[:2] == [str(n) for n in longs[:2]]
    assert column(records("0.1234567890123456789", "0.1234567890123456788"), V.value_text(rec())) == [
        "0.1234567890123456789", "0.1234567890123456788"]


def test_equal_numbers_have_one_spelling(records):
    texts = ['{"a":1e7,"b":"1.0E7,"}', '{"a":10000000,"b":"1.0E7,"}', '{"a":10000000.0,"b":"1.0E7,"}']
    assert set(column(records(*texts), V.canonical_text(rec()))) == {'{"a":10000000,"b":"1.0E7,"}'}
    tricky = r'{"a":"q\"1.0E7,\\","b":[1.5e7,"x"],"c":1e-7}'
    assert column(records(tricky), V.canonical_text(rec())) == [
        r'{"a":"q\"1.0E7,\\","b":[15000000,"x"],"c":0.0000001}'
    ]


def test_typed_text_equals_variant_text(spark):
    df = spark.sql(
        """select * from values
        (1L, 1.5D, 'a"b\\n', true, timestamp_ntz'2024-01-02 03:04:05.1', date'2024-01-02', named_struct('z', 1, 'Y', 'é'), array(1.0D, 2.5D)),
        (2L, 1e7D, 'x', false, timestamp_ntz'2024-01-02 03:04:05', null, null, null),
        (3L, 12345678.5D, '', null, null, null, named_struct('z', null, 'Y', null), array()),
        (4L, 0.00001D, null, null, null, null, null, null), (5L, 1e300D, 'u', null, null, null, null, null)
        as t(id, d, s, b, ts, dt, st, arr)"""
    )
    out = transform(records_from_table(df, ord="id"), CFG, TS)
    variant = V.canonical_text(V.to_variant(rec(), out.schema["rec"].dataType))
    rows = out.select("text", variant.alias("variant"), "nk_json").collect()
    assert all(r.text == r.variant for r in rows)
    assert json.loads(rows[0].text) == {
        "id": 1, "d": 1.5, "s": 'a"b\n', "b": True, "ts": "2024-01-02T03:04:05.1Z", "dt": "2024-01-02",
        "st": {"z": 1, "Y": "é"}, "arr": [1, 2.5],
    }
    assert '"d":10000000,' in rows[1].text and '"d":12345678.5,' in rows[2].text


def test_duplicate_json_key_keeps_the_last(records):
    assert column(records('{"a":1,"a":2}'), V.canonical_text(rec())) == ['{"a":2}']


def test_jsonl_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id":1}\n\nbad\n[1]\nnull\n')
    got = transform_all(read_jsonl(spark, str(tmp_path)), CFG, TS)
    assert sorted(r.key_ok for r in got.collect()) == [False, True]


def test_drop_paths(records):
    texts = ['{"x":1}', '{"a":5}', '{"a":{}}', '{"a":{"b":1}}', '{"a":[{"b":1}]}', '{"a":{"b":null,"c":1}}']
    assert column(records(*texts), V.canonical_text(P.drop_paths(rec(), [["a", "b"]]))) == [
        '{"x":1}', '{"a":5}', '{"a":{}}', '{"a":{}}', '{"a":[{"b":1}]}', '{"a":{"c":1}}'
    ]


def test_hash_order(records):
    text = '{"a":{"b":"x"}}'
    whole, inner = sha('{"b":"x"}'), sha(json.dumps({"b": sha("x")}, separators=(",", ":")))
    one = column(records(text), V.canonical_text(P.hash_paths(rec(), [["a"], ["a", "b"]])))
    two = column(records(text), V.canonical_text(P.hash_paths(rec(), [["a", "b"], ["a"]])))
    assert one == [f'{{"a":"{whole}"}}'] and two == [f'{{"a":"{inner}"}}']


def test_hash_of_empties(records):
    got = column(
        records('{"a":""}', '{"a":0}', '{"a":false}', '{"a":null}', "{}"),
        V.canonical_text(P.hash_paths(rec(), [["a"]])),
    )
    assert got == [f'{{"a":"{sha("")}"}}', f'{{"a":"{sha("0")}"}}', f'{{"a":"{sha("false")}"}}',
                   '{"a":null}', "{}"]


def test_keys_that_no_path_text_can_hold(records):
    text = json.dumps({"a'\"": {"q?": 1}, "": 2, "a.b": 3, "c[0]": 4})
    got = column(
        records(text),
        P.get_path(rec(), ["a'\"", "q?"]).cast("int"), P.get_path(rec(), [""]).cast("int"),
        P.get_path(rec(), ["a.b"]).cast("int"), P.get_path(rec(), ["c[0]"]).cast("int"),
    )
    assert got == [(1, 2, 3, 4)]


def test_set_path(records):
    set_ = V.canonical_text(P.set_path(rec(), ["a", "b"], F.lit(1).cast("variant")))
    assert column(records('{"a":{"b":0,"c":2}}', "{}", '{"a":null}'), set_) == [
        '{"a":{"b":1,"c":2}}', '{"a":{"b":1}}', '{"a":{"b":1}}'
    ]
    with pytest.raises(Exception, match="not an object"):
        records('{"a":5}').select(set_).collect()


def test_fingerprint(records):
    cfg = StreamConfig("s", ("id",), drop_field_paths=(("d",),))
    got = transform(records('{"id":1,"x":2,"d":3}', '{"d":4,"x":2,"id":1}', '{"id":1,"x":3}'), cfg, TS)
    keys = column(got, "_sdc_surrogate_key")
    assert keys[0] == keys[1] == sha('{"id":1,"x":2}') and keys[2] != keys[0]


def test_source_metadata_is_replaced(records):
    got = transform(records('{"id":1,"_sdc_timestamp":"old"}'), CFG, TS).collect()[0]
    assert got.text == '{"id":1}'
    assert got["_sdc_surrogate_key"] == sha('{"_sdc_timestamp":"old","id":1}')


def test_disambiguate(records):
    twice = records('{"id":1}', '{"id":1}')
    assert len(set(column(transform(twice, CFG, TS), "_sdc_unique_key"))) == 1
    assert len(set(column(transform(twice, CFG, TS, True), "_sdc_unique_key"))) == 2


def test_dropped_key_gives_null_natural_key(records):
    with pytest.warns(UserWarning, match="unique key is dropped"):
        cfg = StreamConfig("s", ("id",), drop_field_paths=(("id",),))
    got = transform(records('{"id":1,"x":2}'), cfg, TS)
    row = got.collect()[0]
    assert (row.key, row.nk_json, row.text) == ("", "null", '{"x":2}')
    found = I.discover(got, None, TS, cfg.unique_key_path)
    schema = load_schema(found, "s")
    assert schema["properties"]["_sdc_natural_key"] == {"type": "string"}
    valid, rejected = validate(got, schema)
    assert valid.isEmpty() and rejected.collect()[0].errors == ["_sdc_natural_key: type is not string"]


def _merged(records, *texts):
    df = records(*texts).withColumn("stream", F.lit("s"))
    return {".".join(r.path): (r.type, r.format) for r in I.merge_paths(I.infer_paths(df)).collect()}


def test_type_merge(records):
    assert _merged(records, '{"a":1}', '{"a":"x"}') == {"a": ("number", None)}
    assert _merged(records, '{"a":"x"}', '{"a":{"b":true}}') == {"a": ("object", None), "a.b": ("boolean", None)}
    assert _merged(records, '{"a":{"b":true}}', '{"a":"x"}') == {"a": ("object", None), "a.b": ("boolean", None)}
    assert _merged(records, '{"a":null}', '{"a":[1]}') == {"a": ("array", None)}
    assert _merged(records, '{"a":[]}', '{"a":"x"}') == {"a": ("array", None)}
    assert _merged(records, '{"a":{}}') == {"a": ("object", None)}
    assert _merged(records, '{"a":{"b":null}}') == {"a": ("object", None)}
    assert _merged(records, '{"a":"2024-01-01T00:00:00Z"}', '{"a":"free"}') == {"a": ("string", "date-time")}


def test_discovery_agrees_with_merged_paths(records):
    texts = ['{"id":1,"a":{"b":{"c":"2024-01-01"},"e":null},"z":null}', '{"id":2,"a":"s","z":{"q":[]}}',
             '{"id":{"k":"v"},"a":{"b":3}}', "[1]", "null", '{"id":5}']
    df = records(*texts).withColumn("stream", F.lit("s"))
    one = {(tuple(r.path), r.type, r.format) for r in I.merge_paths(I.infer_paths(df)).collect()}
    two = {(tuple(r.path), r.type, r.format) for r in I.found_types(df).collect()}
    assert one == two and (("a", "b", "c"), "string", "date") in one


def test_object_for_a_natural_key(records):
    got = transform(records('{"id":{"a":"2024-01-01","b":{"c":1}}}', '{"id":{"a":"x"}}'), CFG, TS)
    schema = load_schema(I.discover(got, None, TS, ["id"]), "s")
    assert schema["properties"]["_sdc_natural_key"] == {
        "type": "object",
        "properties": {
            "a": {"type": ["string", "null"], "format": "date"},
            "b": {"type": ["object", "null"], "properties": {"c": {"type": ["number", "null"]}}},
        },
    }


def test_date_for_a_natural_key_has_no_format(records):
    schema = load_schema(I.discover(transform(records('{"id":"2024-01-01"}'), CFG, TS), None, TS, ["id"]), "s")
    assert schema["properties"]["_sdc_natural_key"] == {"type": "string"}
    assert schema["properties"]["id"] == {"type": ["string", "null"], "format": "date"}


def test_deep_records_raise_or_are_opened(records):
    text = '{"id":1,"a":{"b":{"c":{"d":{"e":{"f":1}}}}}}'
    df = transform(records(text), CFG, TS)
    with pytest.raises(Exception, match="nested deeper"):
        I.discover(df, None, TS, ["id"]).collect()
    deep = I.discover(df, None, TS, ["id"], depth=6)
    assert ["a", "b", "c", "d", "e", "f"] in [r.path for r in deep.collect()]


def test_existing_catalog_wins_but_objects_override(records, spark):
    known = catalog_from_schema(
        spark, "s",
        {"properties": {"a": {"type": "string", "pattern": "^x"}, "b": {"type": ["string", "null"], "format": "date"}}},
    )
    df = records('{"a":1,"b":{"c":2}}').withColumn("stream", F.lit("s"))
    schema = load_schema(
        I.merge_paths(I.infer_paths(df), known).withColumn("schema_discovered_at", F.lit(TS)), "s"
    )
    assert schema["properties"] == {
        "a": {"type": "string", "pattern": "^x"},
        "b": {"type": ["object", "null"], "format": "date", "properties": {"c": {"type": ["number", "null"]}}},
    }


def test_schema_message_equals_the_nested_schema(spark):
    doc = {
        "type": "object", "required": ["a"],
        "properties": {
            "a": {"type": ["object", "null"], "properties": {"b": {"type": "string", "minLength": 2, "enum": ["é\"", "xy"]}, "c": {"type": ["array", "null"], "items": {"type": "number"}}}},
            "d": {"type": ["string", "number", "null"]}, "e": {"type": "object", "properties": {}}, "f": {},
        },
    }
    catalog = catalog_from_schema(spark, "s", doc).unionByName(catalog_from_schema(spark, 't"', doc))
    messages = [json.loads(r.message) for r in schema_messages(catalog).orderBy("stream").collect()]
    assert [m["stream"] for m in messages] == ["s", 't"']
    assert messages[0]["schema"] == doc == messages[1]["schema"] == load_schema(catalog, "s")


def test_temporal(spark):
    texts = {
        "2024-01-01": "date", "2024-1-1": None, "2024-13-01": None, "2023-02-29": None, "2024-02-29": "date",
        "2024-01-01T00:00:00.123456789Z": "date-time", "2024-01-01 00:00:00": None,
        "2024-01-01T00:00:00+23:59": "date-time", "2024-01-01T24:00:00Z": None, "2024-01-01T00:00:60Z": None,
        "2024-02-30T00:00:00Z": None, "2024-01-01T00:00:00": None, "": None, "x2024-01-01": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.k for r in df.select("t", D.temporal_kind(F.col("t")).alias("k")).collect()} == texts


def test_fold_and_advance(spark):
    updates = spark.createDataFrame(
        [("s", "a", "1", "t1", True, 1), ("s", "a", "2", "t2", False, 2), ("s", "b", "3", "t3", False, 3)],
        "stream string, key string, surrogate_key string, ts string, emitted boolean, ord bigint",
    )
    folded = fold_updates(updates)
    assert sorted(map(tuple, folded.collect())) == [("s", "a", "2", "t2", "t1"), ("s", "b", "3", "t3", None)]
    old = spark.createDataFrame(
        [("s", "b", "0", "t0", "t0"), ("s", "c", "9", "t0", None), ("q", "a", "8", "t0", "t0")], folded.schema
    )
    assert sorted(map(tuple, advance_bookmark(old, folded).collect()), key=str) == [
        ("q", "a", "8", "t0", "t0"), ("s", "a", "2", "t2", "t1"), ("s", "b", "3", "t3", "t0"), ("s", "c", "9", "t0", None),
    ]


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,b,c\n1,,""\n\n 2 ,"x, ""y""\nz", w \n3,short\n4,a,b,c\n')
    ok, bad = read_csv(spark, str(tmp_path), on_bad="quarantine")
    assert sorted(tuple(r.rec) for r in ok.collect()) == [(" 2 ", 'x, "y"\nz', " w "), ("1", "", "")]
    assert sorted(r.raw for r in bad.collect()) == ["3,short", "4,a,b,c"]
    with pytest.raises(Exception, match="does not fit"):
        read_csv(spark, str(tmp_path)).collect()
