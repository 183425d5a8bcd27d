"""One target schema from several source tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partload.functions import casts
from partload.functions.text import empty_to_null, norm_name
from partload.sources import rows

# The type codes of source column metadata, by family.
DECIMAL_CODES = ("D", "F", "N")
INTEGER_CODES = ("I", "I1", "I2", "I8")
CHAR_CODES = ("CV", "CF")
DATE_CODES = ("DA",)
TIMESTAMP_CODES = ("TS", "SZ")

# Spark keeps a declared char(n) or varchar(n) under this key of a string field's metadata.
_DECLARED = "__CHAR_VARCHAR_TYPE_STRING"


@dataclass(frozen=True)
class ResolvedColumn:
    """One target column: family is decimal, date, timestamp, integer or char."""

    name: str
    family: str
    target_type: T.DataType
    length: int | None = None
    padded: bool = False
    native: bool = False

    @property
    def ddl_type(self) -> str:
        return self.target_type.simpleString()


# Families in order of precedence, each with those it takes.
_PRECEDENCE = {
    "decimal": {"decimal", "integer", "char"},
    "date": {"date", "timestamp", "integer", "char"},
    "timestamp": {"timestamp", "integer", "char"},
    "integer": {"integer"},
    "char": {"char"},
}


def _family(field: T.StructField) -> str:
    kind = field.dataType
    if isinstance(kind, (T.DecimalType, T.FloatType, T.DoubleType)):
        return "decimal"
    if isinstance(kind, T.DateType):
        return "date"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "integer"
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return "char"
    return "unsupported"


def declared(field: T.StructField) -> tuple[str, int | None]:
    """How a text column is declared: ('char' | 'varchar' | 'string', length)."""
    text = (field.metadata or {}).get(_DECLARED)
    if text is None and isinstance(field.dataType, (T.CharType, T.VarcharType)):
        text = field.dataType.simpleString()
    if not text:
        return "string", None
    name, _, rest = text.partition("(")
    return name, int(rest.rstrip(")"))


def _compat_type(family: str) -> T.DataType:
    if family == "decimal":
        return T.DoubleType()
    if family == "integer":
        return T.LongType()
    return T.StringType()


def _native_type(kinds: Sequence[T.DataType], family: str) -> T.DataType:
    """Widest type holding every variant."""
    if family == "decimal":
        if any(isinstance(k, (T.FloatType, T.DoubleType)) for k in kinds):
            return T.DoubleType()
        # Decimal digits of the integer types.
        digits = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
        pairs = [
            (k.precision - k.scale, k.scale)
            if isinstance(k, T.DecimalType)
            else (digits[type(k)], 0)
            for k in kinds
        ]
        whole, scale = max(w for w, _ in pairs), max(s for _, s in pairs)
        if whole + scale > 38:
            raise ValueError(f"no decimal holds {whole} whole digits and {scale} decimals")
        return T.DecimalType(whole + scale, scale)
    if family == "date":
        zoned = [k for k in kinds if not isinstance(k, T.DateType)]
        return zoned[0] if zoned else T.DateType()
    if family == "timestamp":
        return next(k for k in kinds if isinstance(k, (T.TimestampType, T.TimestampNTZType)))
    return T.LongType() if family == "integer" else T.StringType()


def unify(
    schemas: Mapping[str, T.StructType],
    columns: Sequence[str],
    strict: bool = False,
    preserve_types: bool = False,
) -> list[ResolvedColumn]:
    """Resolve every column over all source tables, in the order and spelling of `columns`.

    The first family of the precedence that occurs decides. Mixes it does not take raise, as does a
    column some table does not have. With `strict` text may not mix with decimal, date or timestamp.
    """
    fields: dict[str, list[tuple[str, T.StructField]]] = {}
    for table, schema in schemas.items():
        for f in schema.fields:
            fields.setdefault(f.name.strip().upper(), []).append((table, f))
    resolved = []
    for column in columns:
        variants = fields.get(column.strip().upper(), [])
        absent = sorted(set(schemas) - {t for t, _ in variants})
        if absent:
            raise ValueError(f"column {column} not found in {absent}")
        families = {_family(f) for _, f in variants}
        kinds = [f.dataType for _, f in variants]
        shown = sorted({k.simpleString() for k in kinds})
        if "unsupported" in families:
            raise ValueError(f"column {column}: unsupported type among {shown}")
        family = next(f for f in _PRECEDENCE if f in families)
        if not families <= _PRECEDENCE[family]:
            raise ValueError(f"column {column}: mixed types {shown}")
        if strict and "char" in families and family != "char":
            raise ValueError(f"column {column}: text mixed with {family} in {shown}")
        length, padded = None, False
        if family == "char":
            lengths_of = [declared(f) for _, f in variants]
            padded = any(name == "char" for name, _ in lengths_of)
            lengths = [n for _, n in lengths_of]
            length = max(lengths) if None not in lengths else None
        native = preserve_types and families <= {"decimal", "date", "timestamp", "integer"}
        target = _native_type(kinds, family) if native else _compat_type(family)
        resolved.append(ResolvedColumn(column, family, target, length, padded, native))
    return resolved


def cast_column(
    col: Column, source_type: T.DataType, to: ResolvedColumn, empty_as_null: bool = True
) -> Column:
    """The value in its target type; NULL where it does not fit, see `misfit`."""
    if to.native or to.family in ("decimal", "integer"):
        return col.try_cast(to.target_type)
    if to.family == "date":
        return casts.date_text(col, source_type)
    if to.family == "timestamp":
        return casts.timestamp_text(col, source_type)
    text = F.rtrim(col) if to.padded else col
    return empty_to_null(text) if empty_as_null else text


def _checked(f: T.StructField, to: ResolvedColumn) -> bool:
    return f.dataType != to.target_type and (to.native or to.family in ("decimal", "integer"))


def may_misfit(schema: T.StructType, resolved: Sequence[ResolvedColumn]) -> bool:
    """Whether some column may hold values that do not fit: text as numbers, or a narrower type."""
    by_name = {f.name.strip().upper(): f for f in schema.fields}
    wider = (T.IntegralType, T.FloatType, T.DecimalType)
    for to in resolved:
        f = by_name[to.name.strip().upper()]
        safe = isinstance(f.dataType, wider) and to.target_type in (T.DoubleType(), T.LongType())
        if _checked(f, to) and not safe:
            return True
    return False


def misfit(df: DataFrame, resolved: Sequence[ResolvedColumn], empty_as_null: bool = True) -> Column:
    """Whether a row holds a value that does not fit its target type.

    An empty text that counts as NULL is no misfit.
    """
    by_name = {f.name.strip().upper(): f for f in df.schema.fields}
    out = F.lit(False)
    for to in resolved:
        f = by_name[to.name.strip().upper()]
        if not _checked(f, to):
            continue
        value = df[f"`{f.name}`"]
        given = value.isNotNull()
        if empty_as_null and isinstance(f.dataType, T.StringType):
            given = given & (F.trim(value) != "")
        out = out | (given & cast_column(value, f.dataType, to).isNull())
    return out


def conform(
    df: DataFrame, resolved: Sequence[ResolvedColumn], empty_as_null: bool = True
) -> list[Column]:
    """Select list turning one source table into the resolved schema.

    Names match without regard to case.
    """
    by_name = {f.name.strip().upper(): f for f in df.schema.fields}
    out = []
    for to in resolved:
        f = by_name[to.name.strip().upper()]
        value = cast_column(df[f"`{f.name}`"], f.dataType, to, empty_as_null)
        out.append(value.alias(to.name))
    return out


def union_conformed(
    tables: Mapping[str, DataFrame],
    resolved: Sequence[ResolvedColumn],
    empty_as_null: bool = True,
) -> DataFrame:
    """UNION ALL of all load tables in the resolved schema."""
    frames = [df.select(*conform(df, resolved, empty_as_null)) for df in tables.values()]
    return reduce(DataFrame.unionByName, frames)


def target_order(
    declared: Sequence[str], target_columns: Sequence[str], exclude: Sequence[str] = ()
) -> list[str]:
    """Columns in the order of the target's own definition, without the excluded ones.

    `declared` gives the spelling; a target column that is not declared raises.
    """
    spelling = {c.strip().upper(): c for c in declared}
    dropped = {c.lower() for c in exclude}
    order = [c for c in target_columns if c.lower() not in dropped]
    unknown = [c for c in order if c.strip().upper() not in spelling]
    if unknown:
        raise ValueError(f"target columns without a source: {unknown}")
    return [spelling[c.strip().upper()] for c in order]


def payload_columns(columns: Sequence[str], partition_columns: Sequence[str]) -> list[str]:
    """Columns stored in the files: all but the partition columns, compared without case."""
    dropped = {c.lower() for c in partition_columns}
    return [c for c in columns if c.lower() not in dropped]


# Metadata as DataFrames --------------------------------------------------------------------

# The metadata type code of each Spark type.
_CODE_OF_TYPE = {
    "tinyint": "I1",
    "smallint": "I2",
    "int": "I",
    "bigint": "I8",
    "float": "F",
    "double": "F",
    "date": "DA",
    "timestamp": "SZ",
    "timestamp_ntz": "TS",
}


def type_code(field: T.StructField) -> str:
    if isinstance(field.dataType, T.DecimalType):
        return "D"
    if declared(field)[0] == "char":
        return "CF"
    if isinstance(field.dataType, (T.StringType, T.VarcharType)):
        return "CV"
    return _CODE_OF_TYPE.get(field.dataType.simpleString(), "OTHER")


def column_metadata(spark: SparkSession, schemas: Mapping[str, T.StructType]) -> DataFrame:
    """Declared column metadata: one row per table and column. Reads no data.

    Columns: table_name, column_name, column_type, column_length (declared, NULL where there is
    none), ordinal.
    """
    found = [
        (table, f.name, type_code(f), declared(f)[1], i + 1)
        for table, schema in schemas.items()
        for i, f in enumerate(schema.fields)
    ]
    return rows.few_rows(
        spark,
        "table_name string, column_name string, column_type string, column_length int, ordinal int",
        found,
    )


def profile_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Measured: (column_name, longest, value_count) of some columns, which alone are read.

    longest is the longest text met, 0 for other types; value_count counts non-NULL values.
    """
    measures = []
    for name in columns:
        c = F.col(f"`{name}`")
        is_text = isinstance(df.schema[name].dataType, T.StringType)
        longest = F.coalesce(F.max(F.length(c)), F.lit(0)) if is_text else F.lit(0)
        measures.append(
            F.struct(
                F.lit(name).alias("column_name"), longest.cast("int").alias("longest"),
                F.count(c).alias("value_count"),
            )
        )
    return df.agg(F.array(*measures).alias("m")).select(F.inline("m"))


def resolve_metadata(metadata: DataFrame, requested: DataFrame) -> DataFrame:
    """Resolved type of each requested name over the tables of `metadata`.

    `requested` holds column_name. Result: column_name (as requested), resolved_type, needs_cast,
    max_length, table_count, missing. The rule is that of `unify`; what it refuses has a NULL
    resolved_type. A name no table has is kept and marked missing.
    """
    code = F.trim("column_type")
    family = F.when(code.isin(*DECIMAL_CODES), "decimal").when(code.isin(*DATE_CODES), "date")
    family = family.when(code.isin(*TIMESTAMP_CODES), "timestamp")
    family = family.when(code.isin(*INTEGER_CODES), "integer").when(code.isin(*CHAR_CODES), "char")
    families = F.collect_set(family.otherwise("unsupported"))
    length = F.greatest(F.coalesce(F.max("column_length"), F.lit(1)), F.lit(1))
    types = {
        "decimal": F.lit("DOUBLE"),
        "date": F.lit("VARCHAR(10)"),
        "timestamp": F.lit("VARCHAR(26)"),
        "integer": F.lit("BIGINT"),
        "char": F.concat(F.lit("VARCHAR("), length.cast("string"), F.lit(")")),
    }
    kind = F.lit(None).cast("string")
    for name in reversed(_PRECEDENCE):
        taken = F.array(*[F.lit(f) for f in sorted(_PRECEDENCE[name])])
        allowed = F.when(F.size(F.array_except(families, taken)) == 0, types[name])
        kind = F.when(F.array_contains(families, name), allowed).otherwise(kind)
    plain = F.bool_and(code.isin(*INTEGER_CODES)) | F.bool_and(code.isin("CV"))
    resolved = metadata.groupBy(norm_name(F.col("column_name")).alias("_key")).agg(
        kind.alias("resolved_type"),
        (~plain).alias("needs_cast"),
        F.max("column_length").alias("max_length"),
        F.countDistinct("table_name").alias("table_count"),
    )
    wanted = requested.select("column_name", norm_name(F.col("column_name")).alias("_key"))
    joined = wanted.join(resolved, "_key", "left")
    return joined.withColumn("missing", F.col("table_count").isNull()).drop("_key")


def missing_columns(metadata: DataFrame, requested: DataFrame) -> DataFrame:
    """Requested (table_name, column_name) pairs, or names, that the metadata does not have."""
    keys = [c for c in ("table_name",) if c in requested.columns]
    real = metadata.select(*keys, norm_name(F.col("column_name")).alias("_key")).distinct()
    wanted = requested.withColumn("_key", norm_name(F.col("column_name")))
    return wanted.join(real, [*keys, "_key"], "left_anti").drop("_key")


def column_order_check(
    declared: DataFrame, real: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Compare declared with real column lists, each (*by, column_name, ordinal).

    Verdict per column: ok, moved (other position), missing (declared only), extra (real only).
    """
    key = norm_name(F.col("column_name")).alias("column_key")
    left = declared.select(*by, key, F.col("ordinal").alias("declared_ordinal"))
    right = real.select(*by, key, F.col("ordinal").alias("real_ordinal"))
    both = left.join(right, [*by, "column_key"], "full_outer")
    verdict = (
        F.when(F.col("real_ordinal").isNull(), "missing")
        .when(F.col("declared_ordinal").isNull(), "extra")
        .when(F.col("declared_ordinal") == F.col("real_ordinal"), "ok")
        .otherwise("moved")
    )
    return both.withColumn("verdict", verdict)


def column_list_verdict(checked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One verdict per list: same, same set in other order, or different set."""
    different = F.bool_or(F.col("verdict").isin("missing", "extra"))
    moved = F.bool_or(F.col("verdict") == "moved")
    return checked.groupBy(*by).agg(
        F.when(different, "different_set").when(moved, "other_order").otherwise("same").alias("verdict")
    )
