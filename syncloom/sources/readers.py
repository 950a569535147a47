"""What a sync can read: tables, SQL datasets, saved models, segments, cohorts, files and connectors, topics."""

from __future__ import annotations

from collections.abc import Mapping as Dict, Sequence
from dataclasses import dataclass, field as dc_field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from syncloom.functions.columns import quoted
from syncloom.operators.skew import join_unique
from syncloom.plans.spec import DatasetSpec, SegmentSpec, SourceSpec, SpecError

# Connector types and the Spark reader that serves them. Vendor drivers and jars come with the cluster.
READER_FORMATS = {
    "snowflake": "snowflake",
    "big_query": "bigquery",
    "postgres": "jdbc",
    "redshift": "jdbc",
    "databricks": "jdbc",
    "mysql": "jdbc",
    "sql_server": "jdbc",
    "oracle": "jdbc",
    "clickhouse": "jdbc",
}


def read_table(spark: SparkSession, table: str, schema: str | None = None, catalog: str | None = None) -> DataFrame:
    """A table or view by name; catalog and schema are optional."""
    if catalog and not schema:
        raise SpecError("a catalog needs a schema")
    parts = [p for p in (catalog, schema, table) if p]
    return spark.table(".".join("`" + p.replace("`", "``") + "`" for p in parts))


def read_dataset(spark: SparkSession, dataset: DatasetSpec) -> DataFrame:
    """Run the query and make it available to other datasets under its name."""
    df = spark.sql(dataset.query)
    df.createOrReplaceTempView(f"`{dataset.name}`")
    return df


def read_segment(dataset: DataFrame, segment: SegmentSpec) -> DataFrame:
    return dataset.filter(F.expr(segment.predicate))


def read_cohort(
    dataset: DataFrame, members: DataFrame, key: str, member_key: str | None = None, spread: bool | None = None
) -> DataFrame:
    """The dataset's rows whose key is in the cohort. Repeated members collapse map-side; hot keys are spread."""
    unique = members.select(quoted(member_key or key).alias(key)).filter(quoted(key).isNotNull()).distinct()
    return join_unique(dataset, unique, [key], "left_semi", spread).select(*[quoted(c) for c in dataset.columns])


def read_source(spark: SparkSession, source_type: str, options: Dict[str, str], path: str | None = None) -> DataFrame:
    """A connector type or any Spark format, with its options passed on."""
    reader = spark.read.format(READER_FORMATS.get(source_type, source_type)).options(**options)
    return reader.load(path) if path else reader.load()


@dataclass(frozen=True)
class ConnectionSpec:
    """Where a connection's tables are: a connector type or any Spark format, with its options.

    ``root``: the tables are folders of files below it, as ``[catalog/][schema/]table``; otherwise the connector is given their names.
    ``schemas`` says, by table, what files without types hold. ``ranges``: by table, the column by whose values a JDBC table is read in
    ``partitions`` tasks.
    """

    type: str
    options: Dict[str, str] = dc_field(default_factory=dict)
    root: str | None = None
    schemas: Dict[str, object] = dc_field(default_factory=dict)
    ranges: Dict[str, str] = dc_field(default_factory=dict)
    partitions: int = 64


def table_options(connection: ConnectionSpec, table: str, schema: str | None = None, catalog: str | None = None) -> dict[str, str]:
    """The connection's options and, unless it reads files, the table's name under the option its connector takes."""
    if connection.root is not None:
        return dict(connection.options)
    name = ".".join(p for p in (catalog, schema, table) if p)
    return {**connection.options, "table" if connection.type == "big_query" else "dbtable": name}


def range_options(column: str, low: object, high: object, partitions: int) -> dict[str, str]:
    """Options that read a JDBC table in ranges of a column; none if it has no values. Rows beyond the bounds, or null, are read, too."""
    if low is None or high is None:
        return {}
    return {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(partitions)}


def read_connection(spark: SparkSession, connection: ConnectionSpec, table: str, schema: str | None = None, catalog: str | None = None) -> DataFrame:
    """A table of a connection. Filters and columns of later steps reach the reader as they do for any Spark source.

    Reading in ranges costs one aggregate over the table's column in its database (Spark pushes it down).
    """
    if catalog and not schema:
        raise SpecError("a catalog needs a schema")
    options = table_options(connection, table, schema, catalog)
    fmt = READER_FORMATS.get(connection.type, connection.type)
    reader = spark.read.format(fmt)
    if table in connection.schemas:
        reader = reader.schema(connection.schemas[table])
    if connection.root is not None:
        parts = [p for p in (catalog, schema, table) if p]
        if any("/" in p or p in (".", "..") for p in parts):
            raise SpecError(f"{'.'.join(parts)!r} names no table of a connection")
        return reader.options(**options).load("/".join([connection.root.rstrip("/"), *parts]))
    if fmt == "jdbc" and table in connection.ranges:
        column = connection.ranges[table]
        bounds = spark.read.format(fmt).options(**options, pushDownAggregate="true").load().agg(F.min(quoted(column)), F.max(quoted(column))).first()
        options |= range_options(column, *bounds, connection.partitions)
    return reader.options(**options).load()


MESSAGE = "value binary, partition int, offset long"
UNDECODABLE = "_undecodable"


def read_topic(
    spark: SparkSession, source_type: str, options: Dict[str, str], schema=None, path: str | None = None, messages: bool = False
) -> DataFrame:
    """A stream of records. Files need a schema; Kafka messages are decoded with it, or left as they are without.

    ``messages``: the files hold messages (``MESSAGE``), as a topic that was written down does; they are decoded, too.
    """
    reader = spark.readStream.format(source_type).options(**options)
    if source_type == "kafka":
        raw = reader.load()
        return raw if schema is None else records_of(raw, schema)
    if messages:
        return records_of(reader.schema(MESSAGE).load(path), schema)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def records_of(messages: DataFrame, schema) -> DataFrame:
    """JSON messages as records, with ``_partition`` and ``_offset`` to order them by.

    ``_undecodable`` is the text of a message that is no JSON object of the schema, null for all others; a live sync keeps
    it as a reject. A message without a value (a tombstone) is a record of nulls.
    """
    fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    whole = T.StructType([*fields.fields, T.StructField(UNDECODABLE, T.StringType())])
    text = F.col("value").cast("string")
    decoded = messages.select(F.from_json(text, whole, {"columnNameOfCorruptRecord": UNDECODABLE}).alias("r"), "partition", "offset")
    return decoded.select("r.*", F.col("partition").alias("_partition"), F.col("offset").alias("_offset"))


def live_order(stream: DataFrame, named: Sequence[str] = ()) -> list[str]:
    """The columns that say which of two records of a key is the later one: those the topic names, else a message's place in it.

    Messages of a key lie in one partition, so their offsets order them.
    """
    order = list(named) or [c for c in ("_offset", "_partition") if c in stream.columns]
    if not order:
        raise SpecError("live records need an order: name its columns, or read a topic whose messages have offsets")
    return order


def profile_dataset(df: DataFrame) -> DataFrame:
    """``(name, data_type, record_count)`` per column, from the schema and one count that reads no column."""
    columns = [F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("t")) for f in df.schema]
    counted = df.agg(F.count(F.lit(1)).alias("record_count"))
    return counted.select(F.explode(F.array(*columns)).alias("c"), "record_count").select(
        F.col("c.name").alias("name"), F.col("c.t").alias("data_type"), "record_count"
    )


@dataclass(frozen=True)
class TopicSpec:
    """Where a topic is read: a Spark streaming format, its options, the records' schema, and the columns that order them.

    ``messages`` says that files hold undecoded messages.
    """

    source_type: str
    schema: object = None
    path: str | None = None
    options: Dict[str, str] = dc_field(default_factory=dict)
    order: Sequence[str] = ()
    messages: bool = False


@dataclass
class Catalog:
    """The saved definitions a sync may refer to by id."""

    datasets: dict[str, DatasetSpec] = dc_field(default_factory=dict)
    models: dict[str, DatasetSpec] = dc_field(default_factory=dict)
    segments: dict[str, SegmentSpec] = dc_field(default_factory=dict)
    cohorts: dict[str, tuple[DataFrame, str]] = dc_field(default_factory=dict)
    topics: dict[str, TopicSpec] = dc_field(default_factory=dict)
    #: Without any, tables are those of the session.
    connections: dict[str, ConnectionSpec] = dc_field(default_factory=dict)

    def stream(self, spark: SparkSession, source: SourceSpec) -> DataFrame:
        """The records of a live source."""
        t = self.topic(source)
        return read_topic(spark, t.source_type, dict(t.options), t.schema, t.path, t.messages)

    def topic(self, source: SourceSpec) -> TopicSpec:
        if source.kind != "topic":
            raise SpecError("a live sync reads a topic")
        return self._get("topics", source.id)

    def _get(self, kind: str, ident: str):
        found = getattr(self, kind).get(str(ident))
        if found is None:
            raise SpecError(f"no {kind.rstrip('s')} with id {ident!r}")
        return found

    def read_model(self, spark: SparkSession, ident: str) -> DataFrame:
        return read_dataset(spark, self._get("models", ident))

    def resolve(self, spark: SparkSession, source: SourceSpec) -> DataFrame:
        """The DataFrame of a batch source, with its segment or cohort restriction."""
        if source.kind == "table" and self.connections and source.connection is not None:
            return read_connection(spark, self._get("connections", source.connection), source.table, source.schema, source.catalog)
        if source.kind == "table":
            return read_table(spark, source.table, source.schema, source.catalog)
        if source.kind == "model":
            return self.read_model(spark, source.id)
        if source.kind == "topic":
            raise SpecError("a topic is read by a live sync")
        df = read_dataset(spark, self._get("datasets", source.id))
        if source.segment_id:
            df = read_segment(df, self._get("segments", source.segment_id))
        if source.cohort_id:
            members, key = self._get("cohorts", source.cohort_id)
            df = read_cohort(df, members, key)
        return df
