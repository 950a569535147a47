"""Apply a function of Arrow text to a text column, one pass and no shuffle."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: ``fn`` takes the texts of one batch and returns one array per column of the schema.
TextFunction = Callable[[pa.Array], Sequence[pa.Array]]


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` would; once per application, in a zip of its sources."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="syncloom-py-"), "syncloom.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    out.write(file, os.path.relpath(file, os.path.dirname(top)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def field(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def per_text(docs: DataFrame, make: Callable[[], TextFunction], schema: T.StructType, text: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``row`` (a struct of the carried columns, so that no name can clash) and the columns of ``schema``.

    ``make`` is called once per task and gives the function, so that models are loaded on the executors.
    """
    ship(docs.sparkSession)
    given = docs.select(F.struct(*[docs[f"`{c}`"] for c in carry]).alias("row"), docs[f"`{text}`"].cast("string").alias("text"))
    names = ["row", *schema.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([field(batch, "row"), *fn(field(batch, "text"))], names)

    out = T.StructType([given.schema["row"], *schema.fields])
    return given.mapInArrow(run, out)
