"""Reading Parquet files whose schemas differ (S7, S8): reconcile, then union by name.

Files are listed once. Footers are merged by Spark's own distributed schema merge; only
where that finds two types for one column are the files halved until each group
merges, and groups of one schema are joined again. Every column then gets the common type
of all groups on a widening lattice, each group is read with its own schema and cast, and
the groups are united by name (a column that a group lacks is NULL there).

The lattice: byte, short, int, long, then decimal; float, double; a whole number and a
fraction meet in double; decimals in the one that holds both; dates in timestamps; any two
scalars, one of which is text, in text; structs field by field, arrays and maps by their
parts; NULL columns in anything. Other pairs raise and name a file of each side.
"""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 20}
FRACTION = [T.FloatType(), T.DoubleType()]
NESTED = (T.StructType, T.ArrayType, T.MapType)


class IncompatibleTypes(ValueError):
    pass


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type on the lattice that both can be cast to."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in WHOLE and b in WHOLE:
        return WHOLE[max(WHOLE.index(a), WHOLE.index(b))]
    number = [t in WHOLE or t in FRACTION or isinstance(t, T.DecimalType) for t in (a, b)]
    if all(number):
        if a in FRACTION or b in FRACTION:
            return FRACTION[0] if a in FRACTION and b in FRACTION and a == b else FRACTION[1]
        a, b = (t if isinstance(t, T.DecimalType) else T.DecimalType(DIGITS[t], 0) for t in (a, b))
        scale = max(a.scale, b.scale)
        return T.DecimalType(min(38, scale + max(a.precision - a.scale, b.precision - b.scale)), scale)
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(a, times) and isinstance(b, times):
        return T.TimestampType() if T.TimestampType() in (a, b) else T.TimestampNTZType()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return common_struct(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType))
    if T.StringType() in (a, b) and not isinstance(a, NESTED) and not isinstance(b, NESTED) and T.BinaryType() not in (a, b):
        return T.StringType()
    raise IncompatibleTypes(f"{a.simpleString()} and {b.simpleString()}")


def common_struct(a: T.StructType, b: T.StructType) -> T.StructType:
    """Fields of both, in the order of ``a``, then those that only ``b`` has; names match without case."""
    theirs = {f.name.lower(): f for f in b}
    out = []
    for f in a:
        other = theirs.pop(f.name.lower(), None)
        try:
            out.append(T.StructField(f.name, common_type(f.dataType, other.dataType) if other else f.dataType))
        except IncompatibleTypes as e:
            raise IncompatibleTypes(f"{f.name}: {e}") from None
    return T.StructType(out + [T.StructField(f.name, f.dataType) for f in theirs.values()])


def fit(value: Column, own: T.DataType, want: T.DataType) -> Column:
    """``value`` of type ``own`` as type ``want``, by field names inside structs."""
    if own == want or not isinstance(own, NESTED):
        return value.cast(want)
    if isinstance(own, T.ArrayType):
        return F.transform(value, lambda x: fit(x, own.elementType, want.elementType))
    if isinstance(own, T.MapType):
        keyed = F.transform_keys(value, lambda k, v: fit(k, own.keyType, want.keyType))
        return F.transform_values(keyed, lambda k, v: fit(v, own.valueType, want.valueType))
    return F.when(value.isNotNull(), F.struct(*[f.alias(g.name) for f, g in zip(fields(value.getField, own, want), want)])).cast(want)


def fields(at, own: T.StructType, want: T.StructType) -> list[Column]:
    """The fields of ``want`` in order, from ``at(name)`` where ``own`` has the name, else NULL."""
    have = {f.name.lower(): f for f in own}
    return [fit(at(have[g.name.lower()].name), have[g.name.lower()].dataType, g.dataType) if g.name.lower() in have else F.lit(None).cast(g.dataType)
            for g in want]


def list_files(spark: SparkSession, path: str | list[str], glob: str = "*.parquet") -> list[str]:
    """The data files under ``path`` (a folder, a file or a glob), in order."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path")
    return sorted(r.path for r in found.collect())


def _base(path: str) -> str:
    """The folder below which ``key=value`` folders are columns: up to the first glob or key."""
    parts = path.rstrip("/").split("/")
    stop = next((i for i, p in enumerate(parts) if any(c in p for c in "*?[{") or "=" in p), len(parts))
    return "/".join(parts[:stop])


def _merged(spark: SparkSession, files: list[str], base: str | None) -> DataFrame:
    reader = spark.read.option("mergeSchema", "true")
    return (reader.option("basePath", base) if base else reader).parquet(*files)


def _mergeable(spark: SparkSession, files: list[str], base: str | None) -> dict[str, tuple[T.StructType, list[str]]]:
    """Groups of files that Spark merges: JSON of the schema -> schema and files."""
    try:
        schema = _merged(spark, files, base).schema
        return {schema.json(): (schema, files)}
    except (PySparkException, Py4JJavaError) as e:
        if "[CANNOT_MERGE_SCHEMAS]" not in str(e) or len(files) == 1:
            raise
    out = {}
    for half in (files[: len(files) // 2], files[len(files) // 2:]):
        for key, (schema, part) in _mergeable(spark, half, base).items():
            out.setdefault(key, (schema, []))[1].extend(part)
    return out


def read_reconciled(spark: SparkSession, path: str | list[str], glob: str = "*.parquet") -> DataFrame:
    """All files under ``path`` as one table with every column of any of them, widened where types differ.

    ``key=value`` folders below one ``path`` are columns; of a list of paths they are not.
    Raises FileNotFoundError where there is no file, IncompatibleTypes where two have no common type."""
    files = list_files(spark, path, glob)
    if not files:
        raise FileNotFoundError(f"no {glob} files under {path}")
    base = _base(path) if isinstance(path, str) and not (path.endswith(".parquet") and "=" not in path) else None
    groups = list(_mergeable(spark, files, base).values())
    schema, sample = groups[0][0], groups[0][1][0]
    for other, part in groups[1:]:
        try:
            schema = common_struct(schema, other)
        except IncompatibleTypes as e:
            raise IncompatibleTypes(f"no common type for column {e} ({sample} and {part[0]})") from None
    frames = []
    for own, part in groups:
        df = _merged(spark, part, base) if len(groups) > 1 else _merged(spark, files, base)
        columns = fields(lambda name: F.col(f"`{name}`"), own, schema)
        frames.append(df.select(*[c.alias(f.name) for c, f in zip(columns, schema)]))
    return reduce(DataFrame.unionAll, frames)
