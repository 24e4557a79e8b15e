"""Helpers shared by the operators: reading tables, walking Arrow batches, the word rule."""

import re

import pyarrow as pa

#: Words after lower-casing A-Z only (the rule that several results are defined by).
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
#: Rows turned into Python objects at a time; bounds a worker's memory, not the data.
SLICE = 256


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text):
    return text.translate(LOWER) if not text.isascii() else text.lower()


def words_of(text):
    return WORD.findall(lower_ascii(text)) if text else []


def by_rows(make, schema):
    """A mapInArrow function. make() runs once a task and returns f(row tuple) -> row tuples.

    Rows are handled in slices, so that a batch of long texts is never held twice.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches):
        each = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                columns = [c.to_pylist() for c in batch.slice(at, SLICE).columns]
                out = [row for values in zip(*columns, strict=True) for row in each(*values)]
                if out:
                    arrays = [pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), arrow, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return run


def map_rows(df, make, ddl):
    """One output row or more for each row of `df`, in the same task, without a shuffle."""
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(ddl)
    return df.mapInArrow(by_rows(make, schema), schema)
