"""Layers whose files disagree on column types: one scan for each schema, widening casts, union by name.

Spark merges files of differing columns, but not a column that is INT in one file and DOUBLE in another. Here the files are put into
groups of one schema, every column gets the smallest type that holds all of its variants, and each group is one scan with casts.
Footers are read by Spark's own distributed schema merge: one for each folder, and where a folder's files disagree one for each half of
them, and so on. Nothing but file names and schemas reaches the driver.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Schema merges that run at the same time.
THREADS = 8
#: Whole numbers by width, with the decimal digits that hold them.
WHOLE = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
TIMES = [T.DateType(), T.TimestampNTZType(), T.TimestampType()]


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The smallest type that holds both: wider numbers, later kinds of time, text where nothing else does."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return common_schema([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType))
    nested = (T.StructType, T.ArrayType, T.MapType)
    if isinstance(a, nested) or isinstance(b, nested):
        raise ValueError(f"{a.simpleString()} and {b.simpleString()} have no common type")
    if isinstance(a, T.BooleanType) and b in WHOLE:
        return b
    if isinstance(b, T.BooleanType) and a in WHOLE:
        return a
    if a in WHOLE and b in WHOLE:
        return max(a, b, key=WHOLE.get)
    floats = (T.FloatType, T.DoubleType)
    for one, other in ((a, b), (b, a)):
        if isinstance(one, floats) and (other in WHOLE or isinstance(other, (*floats, T.DecimalType))):
            return T.FloatType() if isinstance(one, T.FloatType) and other in WHOLE and not isinstance(other, T.LongType) else T.DoubleType()
        if isinstance(one, T.DecimalType) and (other in WHOLE or isinstance(other, T.DecimalType)):
            digits, scale = (other.precision - other.scale, other.scale) if isinstance(other, T.DecimalType) else (WHOLE[other], 0)
            scale = max(scale, one.scale)
            whole = max(digits, one.precision - one.scale)
            return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    if a in TIMES and b in TIMES:
        return max(a, b, key=TIMES.index)
    return T.StringType()


def common_schema(schemas: list[T.StructType]) -> T.StructType:
    """All columns by name, whatever their case, in the order in which they first come."""
    names: dict[str, str] = {}
    kinds: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema.fields:
            key = field.name.lower()
            names.setdefault(key, field.name)
            kinds[key] = common_type(kinds[key], field.dataType) if key in kinds else field.dataType
    return T.StructType([T.StructField(name, kinds[key]) for key, name in names.items()])


def number_text(number: Column) -> Column:
    """A floating number as text: plain digits from 1e-4 to below 1e16, else one digit, point and exponent with a sign."""
    raw = number.cast("string")
    size = F.abs(number.cast("double"))
    plain = F.regexp_replace(F.regexp_replace(raw.try_cast("decimal(38,20)").cast("string"), "0+$", ""), r"\.$", ".0")
    sign = F.when(F.regexp_extract(raw, r"E(-?)", 1) == "-", F.lit("-")).otherwise(F.lit("+"))
    power = F.regexp_replace(F.regexp_extract(raw, r"E-?(\d+)", 1), r"^(\d)$", "0$1")
    science = F.concat(F.regexp_replace(F.regexp_extract(raw, r"^([^E]*)", 1), r"\.0$", ""), F.lit("e"), sign, power)
    special = F.when(F.isnan(number), F.lit("nan")).when(size == float("inf"), F.when(number > 0, F.lit("inf")).otherwise(F.lit("-inf")))
    return F.coalesce(special, F.when(~raw.contains("E"), raw).when((size >= 1e-4) & (size < 1e16), plain).otherwise(science))


def conform(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """The column in a type that holds its own."""
    if have == want:
        return column
    if isinstance(want, T.StructType):
        fields = {field.name.lower(): field for field in have.fields}
        parts = [
            (conform(column[fields[f.name.lower()].name], fields[f.name.lower()].dataType, f.dataType) if f.name.lower() in fields else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return F.when(column.isNotNull(), F.struct(*parts))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(column, lambda item: conform(item, have.elementType, want.elementType))
    if isinstance(want, T.StringType) and isinstance(have, (T.FloatType, T.DoubleType)):
        return number_text(column)
    return column.cast(want)


def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its order and types; missing ones are null."""
    have = {field.name.lower(): field for field in df.schema.fields}
    return df.select(*(
        (conform(F.col(f"`{have[f.name.lower()].name}`"), have[f.name.lower()].dataType, f.dataType) if f.name.lower() in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ))


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """All rows, columns matched by name whatever their case, each in the smallest type that holds all of its variants."""
    schema = common_schema([df.schema for df in frames])
    return reduce(DataFrame.unionAll, (conformed(df, schema) for df in frames))


#: What Spark raises where a task of a schema merge fails.
MERGE_ERRORS = (PySparkException, Py4JJavaError)


def cannot_merge(problem: Exception) -> bool:
    return any(word in str(problem) for word in ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE", "Failed merging schema", "Failed to merge"))


def _merged_schema(spark: SparkSession, files: list[str]) -> T.StructType | None:
    """The schema of files that Spark can merge, else None."""
    try:
        return spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(*files).schema
    except MERGE_ERRORS as problem:
        if cannot_merge(problem):
            return None
        raise


def schema_groups(schema_of: Callable[[list[str]], T.StructType | None], folders: list[list[str]]) -> list[tuple[T.StructType, list[str]]]:
    """(schema, files) for files that agree on the types of the columns they share. ``schema_of`` gives None where files disagree."""
    done: list[tuple[T.StructType, list[str]]] = []
    open_ = [files for files in folders if files]
    with ThreadPoolExecutor(THREADS) as pool:
        while open_:
            found = list(zip(open_, pool.map(schema_of, open_)))
            done += [(schema, files) for files, schema in found if schema is not None]
            halves = [part for files, schema in found if schema is None for part in (files[:len(files) // 2], files[len(files) // 2:])]
            open_ = [part for part in halves if part]
    groups: list[tuple[T.StructType, list[str]]] = []
    for schema, files in sorted(done, key=lambda x: x[1]):
        for i, (other, held) in enumerate(groups):
            types = {field.name.lower(): json.dumps(field.dataType.jsonValue(), sort_keys=True) for field in other.fields}
            if all(types.get(f.name.lower(), mine) == mine for f in schema.fields for mine in [json.dumps(f.dataType.jsonValue(), sort_keys=True)]):
                groups[i] = (common_schema([other, schema]), held + files)
                break
        else:
            groups.append((schema, files))
    return groups


def read_typed(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files below ``path``. Partition columns keep the type that the names of all folders give."""
    names_only = spark.read.schema("__no_column STRING").parquet(path)
    partitions = [field for field in names_only.schema.fields if field.name != "__no_column"]
    by_folder: dict[str, list[str]] = {}
    for file in sorted(names_only.inputFiles()):
        by_folder.setdefault(file.rpartition("/")[0], []).append(file)
    groups = schema_groups(lambda files: _merged_schema(spark, files), list(by_folder.values()))
    if not groups:
        raise AnalysisException(f"[PATH_NOT_FOUND] no files below {path}")
    inside = {field.name.lower() for field in partitions}
    frames = []
    for schema, files in groups:
        own = T.StructType([*(field for field in schema.fields if field.name.lower() not in inside), *partitions])
        frames.append(spark.read.schema(own).option("basePath", path).parquet(*files))
    return union_by_name(frames)
