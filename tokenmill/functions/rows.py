"""Row functions of the caller, over Arrow batches: a row becomes a row, several, or none."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

RowFunction = Callable[[dict], dict | Iterable[dict] | None]


def map_rows(df: DataFrame, function: RowFunction, schema: str, remove_columns: Iterable[str] = ()) -> DataFrame:
    """``df`` without ``remove_columns``, with the columns of ``schema`` that ``function`` gives for each row.

    The function gets the whole row as a dict and returns a dict with the columns of ``schema`` (a missing one is NULL), None
    to drop the row, or several dicts for several rows. A column of ``schema`` replaces one of the same name. One pass, no shuffle;
    partitions are the processes. Use built-in functions where they can say the same: they stay in the JVM.
    """
    made = T._parse_datatype_string(schema)
    gone = {*remove_columns, *made.names}
    unknown = set(remove_columns) - set(df.columns)
    if unknown:
        raise ValueError(f"no columns {sorted(unknown)}")
    kept = [f for f in df.schema.fields if f.name not in gone]
    result = T.StructType([*kept, *made.fields])
    names, arrow = [f.name for f in kept], to_arrow_schema(result)
    own = {f.name for f in made.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            origin, found = [], []
            for number, row in enumerate(batch.to_pylist()):
                out = function(row)
                for one in (out,) if isinstance(out, dict) else out or ():
                    if not own >= one.keys():
                        raise ValueError(f"columns {sorted(one.keys() - own)} are not in the schema")
                    origin.append(number)
                    found.append(one)
            taken = batch.take(pa.array(origin, pa.int64()))
            columns = [taken.column(name).cast(arrow.field(name).type) for name in names]
            columns += [pa.array([one.get(f.name) for one in found], arrow.field(f.name).type) for f in made.fields]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.mapInArrow(run, result)
