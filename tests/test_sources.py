import pytest
from conftest import rows, table

from syncloom.plans.spec import DatasetSpec, SegmentSpec, SourceSpec, SpecError
from syncloom.sources.readers import (
    Catalog, ConnectionSpec, profile_dataset, range_options, read_cohort, read_source, read_table, records_of, table_options,
)


def test_names_with_schema_and_odd_characters(spark):
    table(spark, "a int", (1,)).createOrReplaceGlobalTempView("`odd name`")
    assert read_table(spark, "odd name", "global_temp").first()[0] == 1
    with pytest.raises(SpecError):
        read_table(spark, "t", catalog="c")


def test_restricted_datasets(spark):
    table(spark, "id int, v int", (1, 5), (2, 6), (3, 7), (None, 8)).createOrReplaceTempView("base_rows")
    members = table(spark, "id int", (1,), (1,), (2,), (9,), (None,))
    catalog = Catalog(datasets={"d": DatasetSpec("d", "select * from base_rows")},
                      segments={"s": SegmentSpec("big", "v > 5")}, cohorts={"c": (members, "id")})
    got = catalog.resolve(spark, SourceSpec("dataset", "d", segment_id="s", cohort_id="c"))
    assert rows(got) == [(2, 6)]
    assert rows(read_cohort(spark.table("base_rows"), members, "id", spread=True)) == [(1, 5), (2, 6)]
    for bad in (SourceSpec("dataset", "x"), SourceSpec("model", "x"), SourceSpec("topic", "t"),
                SourceSpec("dataset", "d", cohort_id="x")):
        with pytest.raises(SpecError):
            catalog.resolve(spark, bad)


def test_datasets_build_on_each_other(spark):
    catalog = Catalog(models={"1": DatasetSpec("first", "select 1 as a"), "2": DatasetSpec("second", "select a + 1 as b from first")})
    catalog.read_model(spark, "1")
    assert catalog.read_model(spark, 2).first()[0] == 2


def test_profile_of_nothing(spark):
    assert rows(profile_dataset(spark.sql("select 1 as a, map('x', 2) as m where false"))) == [
        ("a", "int", 0), ("m", "map<string,int>", 0)]


def test_formats(spark, tmp_path):
    table(spark, "a int, b string", (1, "x;y"), (2, None)).write.option("sep", ";").option("header", True).csv(str(tmp_path / "c"))
    df = read_source(spark, "csv", {"sep": ";", "header": "true", "inferSchema": "true"}, str(tmp_path / "c"))
    assert rows(df) == [(1, "x;y"), (2, None)]


def connected(ident, table, **more):
    return SourceSpec.from_config({"connection_id": ident, "object": {"type": "table", "table_name": table, **more}})


def test_tables_of_connections(spark, tmp_path):
    table(spark, "a int, b string", (1, "x;y"), (2, None)).write.option("sep", ";").csv(str(tmp_path / "files" / "s" / "t"))
    table(spark, "a int", (7,)).write.json(str(tmp_path / "logs" / "t"))
    table(spark, "a int", (9,)).createOrReplaceTempView("t")
    catalog = Catalog(connections={
        "1": ConnectionSpec("csv", {"sep": ";"}, str(tmp_path / "files"), {"t": "a int, b string"}),
        "2": ConnectionSpec("json", root=str(tmp_path / "logs") + "/", schemas={"t": "a int"}),
    })
    assert rows(catalog.resolve(spark, connected(1, "t", table_schema="s"))) == [(1, "x;y"), (2, None)]
    assert rows(catalog.resolve(spark, connected("2", "t"))) == [(7,)]
    # without connections, and for sources that name none, tables are the session's
    assert rows(Catalog().resolve(spark, connected(1, "t"))) == rows(catalog.resolve(spark, SourceSpec("table", table="t"))) == [(9,)]
    for bad in (connected(3, "t"), connected(1, "../logs/t"), connected(1, "..", table_schema="s"), connected(1, "t", table_catalog="c")):
        with pytest.raises(SpecError):
            catalog.resolve(spark, bad)


def test_options_of_databases():
    db = ConnectionSpec("postgres", {"url": "jdbc:postgresql://db/x"}, ranges={"t": "id"}, partitions=4)
    assert table_options(db, "t", "s", "c") == {"url": "jdbc:postgresql://db/x", "dbtable": "c.s.t"}
    assert table_options(ConnectionSpec("big_query"), "t", "s") == {"table": "s.t"}
    assert range_options("id", 1, 900, db.partitions) == {"partitionColumn": "id", "lowerBound": "1", "upperBound": "900", "numPartitions": "4"}
    assert range_options("id", None, None, 4) == {}


def test_messages_become_records(spark):
    messages = table(spark, "value string, partition int, offset bigint", ('{"k": 1, "v": "a"}', 0, 7), ("junk", 1, 8))
    messages = messages.withColumn("value", messages.value.cast("binary"))
    assert rows(records_of(messages, "k int, v string")) == [(1, "a", None, 0, 7), (None, None, "junk", 1, 8)]
