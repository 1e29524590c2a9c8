import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from souklake.functions import documents


def apply(spark, expression, *rows):
    schema = ", ".join(f"c{n} string" for n in range(len(rows[0])))
    return [r[0] for r in spark.createDataFrame(list(rows), schema).select(expression).collect()]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ('{"b": 1, "a": "x"}', '{"a":"x","b":1}'),
        ('{"a": 12.0, "b": 1.50}', '{"a":12.0,"b":1.5}'),
        ('{"z": {"b": 1, "a": [1, 2]}, "t": true, "n": null}', '{"n":null,"t":true,"z":{"a":[1,2],"b":1}}'),
        ('{"q": "say \\"hi\\" 1.50"}', '{"q":"say \\"hi\\" 1.50"}'),
        ("{}", "{}"),
        ("[2, 1]", "[2,1]"),
        ('{"o": {"p": 12.0, "q": [1.50, -0]}}', '{"o":{"p":12.0,"q":[1.5,0]}}'),
        ('{"s": 1e-5, "t": 1E20, "u": 12345678.25, "v": 1e3, "w": 0.00012}', '{"s":1e-05,"t":1e+20,"u":12345678.25,"v":1000.0,"w":0.00012}'),
        ('{"n": 123456789012345678901234567890}', '{"n":123456789012345678901234567890}'),
        ('{"a": 01}', None),
        ('{"a": 1.2.3}', None),
        ("not json", None),
        (None, None),
    ],
)
def test_canonical(spark, text, expected):
    assert apply(spark, documents.canonical(F.col("c0")), (text,)) == [expected]


scalars = st.one_of(
    st.booleans(),
    st.none(),
    st.integers(-(2**53), 2**53),
    st.floats(-1e6, 1e6).map(lambda x: round(x, 2)),
    st.text(st.characters(min_codepoint=32, max_codepoint=126), max_size=8),
)
flat = st.dictionaries(st.text(st.characters(min_codepoint=97, max_codepoint=122), min_size=1, max_size=4), scalars, max_size=5)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(flat, flat), min_size=20, max_size=40))
def test_canonical_and_merge_agree_with_python(spark, pairs):
    rows = [(json.dumps(a), json.dumps(b)) for a, b in pairs]
    sorted_text = apply(spark, documents.canonical(F.col("c0")), *rows)
    assert sorted_text == [json.dumps(a, sort_keys=True, separators=(",", ":")) for a, _ in pairs]
    merged = apply(spark, documents.merge(F.col("c0"), F.col("c1")), *rows)
    assert [json.loads(m) for m in merged] == [{**a, **b} for a, b in pairs]
    assert [list(json.loads(m)) for m in merged] == [list({**a, **b}) for a, b in pairs]


def test_merge_keeps_digits_and_what_does_not_parse(spark):
    merged = documents.merge(F.col("c0"), F.col("c1"))
    rows = [
        ('{"a": 1.50, "b": 1e3, "c": {"d": 0.12345678901234567890}, "t": "x 1.50"}', '{"e": 12.0}'),
        ("{broken", '{"e": 1}'),
        ("", '{"e": 1}'),
    ]
    assert apply(spark, merged, *rows) == [
        '{"a":1.50,"b":1e3,"c":{"d":0.12345678901234567890},"t":"x 1.50","e":12.0}',
        "{broken",
        "",
    ]


def test_merge_with_null(spark):
    merged = documents.merge(F.col("c0"), F.col("c1"))
    assert apply(spark, merged, ('{"a":1}', None), (None, '{"a":1}')) == [None, None]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ('{"amount": 12.5}', 12.5),
        ('{"amount": "7"}', 7.0),
        ('{"amount": "n/a"}', None),
        ('{"amount": "1d"}', None),
        ('{"amount": "2f"}', None),
        ('{"amount": 1e2}', 100.0),
        ('{"amount": " 3.25 "}', 3.25),
        ('{"other": 1}', None),
        ("{broken", None),
        (None, None),
    ],
)
def test_number_at(spark, text, expected):
    assert apply(spark, documents.number_at(F.col("c0"), "$.amount"), (text,)) == [expected]
