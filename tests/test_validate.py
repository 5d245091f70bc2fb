"""Each keyword of the schema compiler, against values that pass and that fail."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark import StreamConfig
from tidemark.operators import catalog
from tidemark.operators.validate import validate

CASES = [
    ({"type": "number"}, [1, 1.5], ["x", None, True, [], {}]),
    ({"type": ["number", "null"]}, [1, None], ["1"]),
    ({"type": "integer"}, [1, 2.0, 10**20], [1.5, "1"]),
    ({"type": "boolean"}, [True], [1, "true"]),
    ({"type": "array"}, [[], [1]], [{}, "[]"]),
    ({"type": "object"}, [{}, {"a": 1}], [[], None]),
    ({"minLength": 2}, ["ab", "éé", 1, None], ["a", ""]),
    ({"maxLength": 2}, ["ab", "é", 123], ["abc"]),
    ({"pattern": "b+"}, ["abc", 1], ["ac"]),
    ({"format": "date"}, ["2024-02-29", 5], ["2024-02-30", "x"]),
    ({"format": "date-time"}, ["2024-02-29T00:00:00Z"], ["2024-02-29"]),
    ({"enum": ["a", 1, None, {"b": [1]}]}, ["a", 1, 1.0, None, {"b": [1]}], ["b", 2, "1", {"b": [2]}, True]),
    ({"const": 5}, [5, 5.0], ["5", 6]),
    ({"const": "x"}, ["x"], [5]),
    ({"minimum": 2, "maximum": 4}, [2, 3.5, 4, "9"], [1, 4.1]),
    ({"exclusiveMinimum": 2, "exclusiveMaximum": 4}, [3], [2, 4]),
    ({"multipleOf": 0.1}, [0.3, 1, "x"], [0.35]),
    ({"minItems": 1, "maxItems": 2}, [[1], [1, 2], "abc"], [[], [1, 2, 3]]),
    ({"items": {"type": "number", "minimum": 0}}, [[], [1, 2], "x"], [[1, "a"], [-1]]),
    ({"items": {"properties": {"a": {"type": "string"}}, "required": ["a"]}}, [[{"a": "x"}]], [[{"a": 1}], [{}]]),
    ({"required": ["a"]}, [{"a": None}, 5], [{}, {"b": 1}]),
    ({"properties": {"a": {"type": "string"}}, "additionalProperties": False}, [{"a": "x"}, {}, 5], [{"a": "x", "b": 1}, {"a": 1}]),
    ({"properties": {"a": {"properties": {"b": {"maximum": 1}}}}}, [{"a": {"b": 1}}, {"a": 5}, {}], [{"a": {"b": 2}}]),
    ({"anyOf": [{"type": "string"}, {"minimum": 5}]}, ["x", 6], [4]),
    ({"oneOf": [{"minimum": 3}, {"maximum": 5}]}, [1, 9], [4, "x"]),
    ({"allOf": [{"minimum": 3}, {"maximum": 5}]}, [4, "x"], [1, 9]),
    ({"not": {"required": ["a"]}}, [{"b": 1}], [{"a": 1}, 5]),
    ({"anyOf": [{"properties": {"a": {"not": {"type": "null"}}}, "required": ["a"]}]}, [{"a": 1}], [{"a": None}, {}]),
    ({"uniqueItems": True}, [[1, 2], [], [[1], [2]], "x"], [[1, 1.0], [{"a": 1}, {"a": 1}]]),
    ({"minProperties": 1, "maxProperties": 2}, [{"a": 1}, 5], [{}, {"a": 1, "b": 2, "c": 3}]),
    ({"title": "t", "description": "d", "default": 1}, [1, "x"], []),
]


@pytest.mark.parametrize(("schema", "good", "bad"), CASES, ids=[json.dumps(c[0]) for c in CASES])
def test_keyword(records, schema, good, bad):
    df = records(*[json.dumps({"v": v}) for v in good + bad])
    valid, rejected = validate(df, {"properties": {"v": schema}})
    assert sorted(r.ord for r in valid.collect()) == list(range(len(good)))
    rows = rejected.orderBy("ord").collect()
    assert [r.ord for r in rows] == list(range(len(good), len(good) + len(bad)))
    assert all(r.errors and all(e.startswith("v") for e in r.errors) for r in rows)


def test_missing_property_passes(records):
    valid, _ = validate(records("{}"), {"properties": {"v": {"type": "number"}}})
    assert valid.count() == 1


def test_root_keywords(records):
    schema = {"type": "object", "required": ["a"], "additionalProperties": False, "properties": {"a": {}}}
    valid, rejected = validate(records('{"a":1}', "{}", '{"a":1,"b":2}'), schema)
    assert [r.ord for r in valid.collect()] == [0]
    assert [r.errors for r in rejected.orderBy("ord").collect()] == [
        ["(root): a is required"], ["(root): has additional properties"]
    ]


@pytest.mark.parametrize(
    "schema", [{"oneOf": []}, {"format": "email"}, {"items": [{}]}, {"additionalProperties": {}}, {"type": "text"}]
)
def test_unsupported_keywords_raise(records, schema):
    with pytest.raises(ValueError):
        validate(records('{"v":1}'), {"properties": {"v": schema}})


def test_config():
    doc = {
        "stream_name": "s", "source_type": "rest", "url": "http://h",
        "records": {"unique_key_path": ["id"], "drop_field_paths": [["a"]], "sensitive_field_paths": [["b", "c"]]},
        "rest": {"response": {"records_path": ["r"], "pagination": True, "pagination_strategy": "query",
                              "pagination_query": {"query_parameter": "page", "query_value": 2, "query_increment": 1}}},
    }
    cfg = StreamConfig.from_dict(doc)
    assert (cfg.unique_key_path, cfg.sensitive_field_paths) == (("id",), (("b", "c"),))
    assert (cfg.records_path, cfg.query_parameter, cfg.query_value) == (("r",), "page", 2)
    for broken in (
        {**doc, "records": {}}, {**doc, "source_type": "db"}, {**doc, "stream_name": ""},
        {**doc, "rest": {"response": {"pagination": True, "pagination_strategy": "other"}}},
        {**doc, "records": {"unique_key_path": ["id"], "drop_field_paths": [[]]}},
    ):
        with pytest.raises(ValueError):
            StreamConfig.from_dict(broken)


@pytest.mark.parametrize("step, value, ok", [
    (7, "1e21", False), (7, "7e21", True), (1, "1.5e-19", False), (1e-20, "3e-20", True), (0.1, "0.30000", True),
    (0.1, "0.35", False), (2, "0", True), (3, "-9", True), (3, "1e60", False), (0.01, "19.99", True),
])
def test_multiple_of_any_size(records, step, value, ok):
    rows = records(f'{{"a":{value}}}').withColumn("stream", F.lit("s"))
    valid, bad = validate(rows, {"properties": {"a": {"multipleOf": step}}})
    assert (valid.count(), bad.count()) == (int(ok), int(not ok))


def test_nested_constants(records):
    schema = {"properties": {"a": {"enum": [{"x": 1.0, "y": [2.0, 2.5]}]}}}
    valid, bad = validate(records('{"a":{"x":1,"y":[2,2.5]}}', '{"a":{"x":1,"y":[2]}}'), schema)
    assert (valid.count(), bad.count()) == (1, 1)


def test_objects_used_as_maps_are_named(spark, monkeypatch):
    rows = catalog.catalog_from_schema(spark, "s", {"properties": {"a": {"properties": {str(i): {} for i in range(5)}}}})
    monkeypatch.setattr(catalog, "MOST_PROPERTIES", 4)
    with pytest.raises(ValueError, match="a of stream s has 5 properties"):
        catalog.load_schema(rows, "s")


def test_many_schemas_in_one_pass(spark, records):
    """Counts of each schema are those it has alone; the records are scanned and opened once for all."""
    from tidemark.operators.validate import compile_many, count_invalid

    texts = ['{"a":{"b":1,"c":"x"},"d":2}', '{"a":{"b":9},"d":"y"}', '{"a":5}', '{"d":[1,1],"a":{"c":null}}', "5", "null"]
    schemas = {
        "b": {"properties": {"a": {"properties": {"b": {"maximum": 5}}}}},
        "c": {"properties": {"a": {"type": "object", "properties": {"c": {"type": "string"}}}}},
        "d": {"required": ["d"], "properties": {"d": {"anyOf": [{"type": "number"}, {"uniqueItems": True, "type": "array"}]}}},
        "closed": {"additionalProperties": False, "properties": {"a": {}}},
        "any": {},
    }
    rows = records(*texts)
    got = {r.name: (r.n_valid, r.n_invalid) for r in count_invalid(rows, schemas).collect()}
    for name, schema in schemas.items():
        good, bad = validate(rows, schema)
        assert got[name] == (good.count(), bad.count())
    assert got["any"] == (6, 0) and all(a and b for name, (a, b) in got.items() if name != "any")
    one = compile_many(rows, schemas)
    assert len({id(check.df) for check in one.values()}) == 1 and sum(c.startswith("_p") for c in one["b"].df.columns) == 2 + 2 + 2
    plan = count_invalid(rows, schemas)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


def test_all_errors_reads_records_once(spark, capsys):
    import queries

    queries.check_multiple_of(spark, "/root/testdata/sf0.001").explain()
    assert capsys.readouterr().out.count("FileScan") == 1
