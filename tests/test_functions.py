import pytest
from conftest import rows, table
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from syncloom.functions.columns import fingerprint, flatten, nest
from syncloom.functions.naming import normalize, normalized_names
from syncloom.functions.template import compile_template
from syncloom.plans.spec import NORMALIZATIONS, SpecError

# One name in every style.
FIRST_NAME = {"start_case": "First Name", "lower_case": "first name", "upper_case": "FIRST NAME",
              "camel_case": "firstName", "snake_case": "first_name"}


@pytest.mark.parametrize("source", ["first_name", "First Name", "firstName", "first-name", "FIRST_NAME"])
@pytest.mark.parametrize("style", list(FIRST_NAME))
def test_styles(source, style):
    assert normalize(source, style) == FIRST_NAME[style]
    assert normalize(source, "match_source_names") == source


WORDS = st.lists(st.from_regex(r"[a-z]{2}[a-z0-9]{0,5}", fullmatch=True), min_size=1, max_size=4)


@given(WORDS, st.sampled_from(NORMALIZATIONS))
@settings(max_examples=200, deadline=None)
def test_styles_are_stable(parts, style):
    """Words start with two letters: runs of shorter ones cannot be told apart again in camel case."""
    once = normalize("_".join(parts), style)
    assert normalize(once, style) == once


def test_collisions():
    with pytest.raises(SpecError):
        normalized_names(["first_name", "firstName"], "snake_case")


def test_template(spark):
    df = table(spark, "status string, n int, `odd name` string", ("new", 1, "x"), (None, None, None))

    def render(text):
        return [r[0] for r in df.select(compile_template(text, df.columns)).collect()]

    assert render("{{ record['status'] | upcase }}") == ["NEW", ""]
    assert render('a {{status}} {{ record["odd name"] }} {{ n }} z') == ["a new x 1 z", "a    z"]
    assert render("plain") == ["plain", "plain"] and render("") == ["", ""]
    for bad in ("{{ status | downcase }}", "{{ other }}", "{% if a %}", "{{ status", "{{ a.b }}", "{{ 'x' }}"):
        with pytest.raises(SpecError):
            compile_template(bad, df.columns)


def test_nest_and_flatten(spark):
    df = spark.range(1).select(F.lit(1).alias("a.x"), F.lit(2).alias("b"), F.lit(3).alias("a.y.z"))
    nested = nest(df)
    assert nested.columns == ["a", "b"] and nested.select("a.y.z").first()[0] == 3
    assert flatten(nested).columns == ["a.x", "a.y.z", "b"]
    with pytest.raises(ValueError):
        nest(spark.range(1).select(F.lit(1).alias("a"), F.lit(2).alias("a.b")))


def test_fingerprint_tells_values_apart(spark):
    df = spark.sql("""
        select '' as s, timestamp '2024-01-01 00:00:00.000001' as t, map(1, 'a') as m union all
        select null, timestamp '2024-01-01 00:00:00.000001', map(1, 'a') union all
        select '', timestamp '2024-01-01 00:00:00.000002', map(1, 'a') union all
        select '', null, map(1, 'a') union all
        select '', null, map(1, 'b') union all
        select '', null, null""")
    assert df.select(fingerprint(df.schema.fields)).distinct().count() == 6
    swapped = spark.sql("select 'a' as x, cast(null as string) as y union all select null, 'a'")
    assert swapped.select(fingerprint(swapped.schema.fields)).distinct().count() == 2


def test_constants_are_written_whole():
    from syncloom.operators.mapping import constant_text

    given = [1234567.5, 3.14159265, 19.9999999, 5.0, 1e20, 7, True, "x", 1e-7]
    assert [constant_text(v) for v in given] == ["1234567.5", "3.14159265", "19.9999999", "5", "100000000000000000000", "7", "true", "x", "1e-07"]
