"""Schema drift: what the payloads of a snapshot hold, against what the target declares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NEW, LOST, RETYPED = "new", "lost", "retyped"
KINDS = ("ARRAY", "BIGINT", "BOOLEAN", "DECIMAL", "DOUBLE", "INVALID", "OBJECT", "STRING", "VOID")
_NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE")
# JSON kinds that a declared type can be read from; times and dates arrive as text.
_READ_FROM = {
    T.StringType: ("STRING",),
    T.DateType: ("STRING",),
    T.TimestampType: ("STRING",),
    T.TimestampNTZType: ("STRING",),
    T.IntegerType: ("BIGINT",),
    T.LongType: ("BIGINT",),
    T.DoubleType: _NUMBERS,
    T.DecimalType: _NUMBERS,
    T.BooleanType: ("BOOLEAN",),
    T.StructType: ("OBJECT",),
    T.ArrayType: ("ARRAY",),
}


def depth_of(dtype: T.DataType) -> int:
    if isinstance(dtype, T.ArrayType):
        return 1 + depth_of(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return 1 + max((depth_of(f.dataType) for f in dtype), default=0)
    return 0


def type_profile(df: DataFrame, payload: str = "payload", depth: int = 2) -> DataFrame:
    """(path, kind, n): how many values of each JSON kind stand at each path, down to ``depth`` steps.

    A path is ``$`` for the payload, ``.key`` for a member, ``[]`` for the elements of an array.  Kinds are
    OBJECT, ARRAY, STRING, BIGINT, DECIMAL, DOUBLE, BOOLEAN and VOID (a JSON null); INVALID is a payload that is no
    JSON.  NULL payloads are left out.  Profiles of parts of a snapshot add up; each input partition moves a row per
    path and kind.  The payloads are parsed once per step of depth.
    """
    spark = df.sparkSession
    at = df.where(F.col(payload).isNotNull()).select(F.lit("$").alias("path"), F.try_parse_json(F.col(payload)).alias("v"))
    levels = [at]
    for _ in range(depth):
        below = levels[-1].lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
        step = F.when(F.col("key").isNull(), F.lit("[]")).otherwise(F.concat(F.lit("."), "key"))
        levels.append(below.select(F.concat("path", step).alias("path"), F.col("value").alias("v")))
    kind = F.coalesce(F.regexp_extract(F.schema_of_variant("v"), "^[A-Z]+", 0), F.lit("INVALID"))
    parts = [x.select("path", kind.alias("kind")).groupBy("path", "kind").agg(F.count(F.lit(1)).alias("n")) for x in levels]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def declared_paths(target: T.DataType, path: str = "$") -> list[tuple[str, str, list[str]]]:
    """(path, declared type, JSON kinds it is read from) of a target and all its parts."""
    kinds = _READ_FROM.get(type(target))
    if kinds is None:
        raise TypeError(f"{path}: no JSON kind for {target.simpleString()}")
    out = [(path, target.typeName(), list(kinds))]
    if isinstance(target, T.StructType):
        for f in target:
            out += declared_paths(f.dataType, f"{path}.{f.name}")
    elif isinstance(target, T.ArrayType):
        out += declared_paths(target.elementType, f"{path}[]")
    return out


def schema_drift(profile: DataFrame, target: T.StructType) -> DataFrame:
    """One row per path that departs from the target: path, verdict, declared, found, n.

    ``new``: a path the target lacks, with all kinds found; ``lost``: a declared path that holds no value but
    nulls; ``retyped``: values of kinds the declared type is not read from, and how many.  An empty
    snapshot has lost every path.
    """
    spark = profile.sparkSession
    declared = spark.createDataFrame(declared_paths(target), "path string, declared string, kinds array<string>")
    both = profile.join(F.broadcast(declared), "path", "full_outer")  # as many rows as the target has fields
    real = F.col("kind").isNotNull() & (F.col("kind") != "VOID")
    wrong = real & F.col("declared").isNotNull() & ~F.array_contains("kinds", F.col("kind"))
    new = F.col("declared").isNull()
    found = F.concat_ws(",", *(F.when(F.bool_or((new | wrong) & (F.col("kind") == k)), F.lit(k)) for k in KINDS))
    total = F.sum(F.when(new | wrong, F.col("n")).otherwise(0))
    per_path = both.groupBy("path").agg(
        F.max("declared").alias("declared"),
        found.alias("found"),
        total.alias("n"),
        F.coalesce(F.bool_or(real), F.lit(False)).alias("_held"),
        F.coalesce(F.bool_or(wrong), F.lit(False)).alias("_wrong"),
    )
    verdict = F.when(F.col("declared").isNull(), NEW).when(~F.col("_held"), LOST).when(F.col("_wrong"), RETYPED)
    return per_path.select("path", verdict.alias("verdict"), "declared", "found", "n").where(F.col("verdict").isNotNull())
