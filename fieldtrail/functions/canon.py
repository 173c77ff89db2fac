"""Canonical text, null-safe comparison and lenient casts (O-P9, O-P10, O-P15, O-F2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FRACTIONAL = (T.DoubleType, T.FloatType)
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

#: Declared property type -> stored type (O-P10). Everything else is text.
DECLARED_TYPES = {"number": T.DoubleType(), "checkbox": T.IntegerType()}

# How text booleans become integers when no map is given.
TEXT_BOOLEANS = (("True", "1"), ("False", "0"), ("true", "1"), ("false", "0"))


def declared_type(prop_type: str, files_handling: str = "bool") -> T.DataType:
    """O-P10: the stored type follows the declared property type, not a sampled value."""
    if prop_type == "files" and files_handling == "bool":
        return T.IntegerType()
    return DECLARED_TYPES.get(prop_type, T.StringType())


def is_fractional(dtype: T.DataType) -> bool:
    return isinstance(dtype, _FRACTIONAL)


def _shortest(x: Column, java: Column) -> Column:
    """Digits of the shortest decimal that reads back as ``x``. Older Java runtimes print
    a few doubles with digits too many; long texts are tried at 15 to 17 digits first."""
    shorter = [F.format_string(f"%.{digits - 1}e", x) for digits in (15, 16, 17)]
    fitting = [F.when(text.cast("double") == x, text) for text in shorter]
    return F.when(F.length(java) < 17, java).otherwise(F.coalesce(*fitting, java))


def _whole_text(x: Column) -> Column:
    """Scientific text of a whole double between 1e16 and 9e18, from its exact digits: the
    fewest leading digits (15 to 17) that read back as the same number."""
    exact = F.abs(x).cast("bigint")
    length = F.length(exact.cast("string"))

    def rounded(digits: int) -> Column:
        step = F.pow(F.lit(10.0), length - digits).cast("bigint")
        lifted = exact + F.floor(step / 2)
        return lifted - F.pmod(lifted, step)

    kept = F.coalesce(*[F.when(rounded(d).cast("double") == F.abs(x), rounded(d)) for d in (15, 16, 17)], exact)
    digits = kept.cast("string")
    mantissa = F.concat(F.substring(digits, 1, 1), F.lit("."), F.substring(digits, 2, 20))
    return F.concat(
        F.when(x < 0, F.lit("-")).otherwise(F.lit("")),
        F.regexp_replace(mantissa, r"\.?0+$", ""),
        F.format_string("e+%d", F.length(digits) - 1),
    )


def _uncommon_text(x: Column) -> Column:
    """Text of a double that Java writes with an exponent or with digits to spare."""
    java = x.cast("string")
    size = F.abs(x)
    text = F.lower(_shortest(x, java))
    # 16 integer digits and 22 fraction digits hold every double of the plain range.
    plain = F.rtrim(text.cast("decimal(38,22)").cast("string"), F.lit("0"))
    mantissa = F.regexp_replace(F.substring_index(text, "e", 1), r"\.?0+$", "")
    exponent = F.substring_index(text, "e", -1).cast("int")
    scientific = F.concat(
        mantissa,
        F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.format_string("%02d", F.abs(exponent)),
    )
    return (
        F.when(F.isnan(x), F.lit("nan"))
        .when(size == float("inf"), F.when(x > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when((size >= 1e-4) & (size < 1e16), F.regexp_replace(plain, r"\.$", ".0"))
        .when((size >= 1e16) & (size < 9e18), _whole_text(x))
        .otherwise(scientific)
    )


def _double_text(x: Column) -> Column:
    """Shortest decimal text of a double: plain between 1e-4 and 1e16, scientific outside.

    Only the common case is part of the generated code. The long rule for the others
    sits in a lambda, which Spark evaluates without generating code, so that several
    numbers in one stage stay below the method size the JVM compiles.
    """
    java = x.cast("string")
    size = F.abs(x)
    common = ((size == 0) | ((size >= 1e-3) & (size < 1e7))) & (F.length(java) < 17)
    return F.when(common, java).otherwise(F.get(F.transform(F.array(x), _uncommon_text), F.lit(0)))


def canonical_text(col: Column, dtype: T.DataType) -> Column:
    """O-P9: the text two values are compared and stored by; NULL stays NULL."""
    if isinstance(dtype, T.StringType):
        return col
    if isinstance(dtype, T.BooleanType):
        return col.cast("int").cast("string")
    if is_fractional(dtype):
        return F.when(col.isNotNull(), _double_text(col.cast("double")))
    return col.cast("string")


def differs(old: Column, old_type: T.DataType, new: Column, new_type: T.DataType) -> Column:
    """O-F2: null-safe inequality of the canonical texts.

    Values of one type have equal texts exactly when they are equal, so text is only
    built when the types differ; a whole number met on one side only is read as double.
    """
    if old_type == new_type:
        return ~old.eqNullSafe(new)
    numeric = _FRACTIONAL + _INTEGRAL
    if isinstance(old_type, numeric) and isinstance(new_type, numeric):
        return ~old.cast("double").eqNullSafe(new.cast("double"))
    return ~canonical_text(old, old_type).eqNullSafe(canonical_text(new, new_type))


def lenient_integer(text: Column) -> Column:
    """Leading digits of a text as integer, 0 when there are none, NULL for NULL."""
    digits = F.regexp_extract(text, r"^\s*([+-]?\d+)", 1)
    return F.when(text.isNotNull(), F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint")))


def lenient_real(text: Column) -> Column:
    """Leading number of a text (fraction and exponent allowed) as double, 0.0 when there is none."""
    number = F.regexp_extract(text, r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)", 1)
    return F.when(text.isNotNull(), F.coalesce(number.try_cast("double"), F.lit(0.0)))


def cast_to(col: Column, dtype: T.DataType, target: str) -> Column:
    """The lenient cast of O-P15 for INTEGER, REAL and TEXT."""
    is_text = isinstance(dtype, T.StringType)
    if target == "INTEGER":
        return lenient_integer(col) if is_text else col.cast("bigint")
    if target == "REAL":
        return lenient_real(col) if is_text else col.cast("double")
    if target == "TEXT":
        return canonical_text(col, dtype)
    raise ValueError(f"unknown target type {target!r}; expected INTEGER, REAL or TEXT")


def migrated_value(col: Column, dtype: T.DataType, target: str, value_map: Sequence[tuple[str, str]] = ()) -> Column:
    """O-P15: mapped values first (one step, first match wins), the lenient cast for the rest."""
    spark_type = {"INTEGER": "bigint", "REAL": "double", "TEXT": "string"}[target]
    text = canonical_text(col, dtype)
    out = None
    for old, new in value_map:
        hit = F.lit(new).cast(spark_type)
        out = F.when(text == old, hit) if out is None else out.when(text == old, hit)
    rest = cast_to(col, dtype, target)
    return rest if out is None else out.otherwise(rest)
