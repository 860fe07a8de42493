"""Walks over nested values, driven by their types: canonical JSON and rewritten strings.

``canonical_json`` writes a value as Python's ``json.dumps(value, sort_keys=True,
separators=(",", ":"))`` does: keys sorted at every level, characters outside
printable ASCII as escapes, numbers in their shortest form.  ``rewrite_strings``
applies a function to every string leaf of a value and keeps its type; names of
fields and keys of maps are never rewritten.  Both are plain expressions.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegralType, MapType, NullType, StringType, StructType

#: Characters that JSON escapes by a letter.
_LETTERS = {"0008": "b", "0009": "t", "000a": "n", "000c": "f", "000d": "r"}


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """An expression that refers to a value several times and evaluates it once."""
    return F.transform(F.array(value), use)[0]


def json_string(text: Column) -> Column:
    """A text as a JSON string in ASCII."""

    def escaped(run: Column) -> Column:
        units = F.regexp_replace(F.lower(F.hex(F.encode(run, "UTF-16BE"))), "([0-9a-f]{4})", r"\\u$1")
        for code, letter in _LETTERS.items():
            units = F.replace(units, F.lit(f"\\u{code}"), F.lit(f"\\{letter}"))
        plain = F.replace(F.replace(run, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
        return F.when(F.regexp_like(run, F.lit("^[ -~]")), plain).otherwise(units)

    runs = F.regexp_extract_all(text, F.lit("[ -~]+|[^ -~]+"), F.lit(0))
    return F.concat(F.lit('"'), F.array_join(F.transform(runs, escaped), ""), F.lit('"'))


def json_double(value: Column) -> Column:
    """A double with the fewest digits that read back as it is; plain from 1e-4 up to 1e16, else with an exponent.

    Of doubles that need 16 digits, about one in 700 gets the second nearest such form or a digit more, as Java before 19 rounds so.
    """
    short = F.coalesce(*(F.when(F.format_string(f"%.{k}e", value).try_cast("double") == value, F.format_string(f"%.{k}e", value)) for k in range(17)))

    def written(s: Column) -> Column:
        sign, digits = F.regexp_extract(s, "^-", 0), F.regexp_replace(F.regexp_extract(s, r"^-?([0-9.]+)e", 1), r"\.", "")
        e, n = F.regexp_extract(s, "e(.*)$", 1).cast("int"), F.length(digits)
        whole = F.when(n <= e + 1, F.concat(digits, F.repeat(F.lit("0"), e + 1 - n), F.lit(".0"))).otherwise(F.concat(F.left(digits, e + 1), F.lit("."), F.substring(digits, e + 2, n)))
        part = F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits)
        mantissa = F.concat(F.left(digits, F.lit(1)), F.when(n > 1, F.concat(F.lit("."), F.substring(digits, F.lit(2), n))).otherwise(""))
        power = F.concat(F.lit("e"), F.when(e < 0, "-").otherwise("+"), F.when(F.abs(e) < 10, "0").otherwise(""), F.abs(e).cast("string"))
        return F.concat(sign, F.when(e.between(0, 15), whole).when(e.between(-4, -1), part).otherwise(F.concat(mantissa, power)))

    zero = F.when(value.cast("string") == "-0.0", "-0.0").otherwise("0.0")
    special = F.when(F.isnan(value), "NaN").when(value == float("inf"), "Infinity").when(value == float("-inf"), "-Infinity")
    return F.when(F.isnan(value) | (F.abs(value) == float("inf")), special).when(value == 0, zero).when(value.isNotNull(), _let(short, written))


def canonical_json(value: Column, kind: DataType) -> Column:
    """A value of the given type as canonical JSON; ``null`` for a null.  Map keys are strings; decimals are written in full, dates as texts."""
    if isinstance(kind, StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        parts = [F.concat(F.lit(json.dumps(f.name) + ":"), canonical_json(value[f.name], f.dataType)) for f in fields]
        text = F.when(value.isNotNull(), F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")))
    elif isinstance(kind, ArrayType):
        text = F.concat(F.lit("["), F.array_join(F.transform(value, lambda x: canonical_json(x, kind.elementType)), ","), F.lit("]"))
    elif isinstance(kind, MapType):
        if not isinstance(kind.keyType, StringType):
            raise TypeError("keys of canonical JSON are strings")
        pairs = F.transform(F.array_sort(F.map_keys(value)), lambda k: F.concat(json_string(k), F.lit(":"), canonical_json(value[k], kind.valueType)))
        text = F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))
    elif isinstance(kind, (FloatType, DoubleType)):
        text = json_double(value.cast("double"))
    elif isinstance(kind, (IntegralType, DecimalType, BooleanType)):
        text = value.cast("string")
    elif isinstance(kind, (StringType, DateType)):
        text = json_string(value.cast("string"))
    elif isinstance(kind, NullType):
        return F.lit("null")
    else:
        raise TypeError(f"no canonical JSON of {kind.simpleString()}")
    return F.coalesce(text, F.lit("null"))


def canonical_hash(df: DataFrame, *columns: str) -> Column:
    """SHA-256 of the canonical JSON object of columns."""
    kind = StructType([df.schema[c] for c in columns])
    return F.sha2(canonical_json(F.struct(*columns), kind), 256)


def rewrite_strings(value: Column, kind: DataType, leaf: Callable[[Column], Column]) -> Column:
    """The value with ``leaf`` applied to each string in it."""
    if isinstance(kind, StructType):
        out = F.struct(*(rewrite_strings(value[f.name], f.dataType, leaf).alias(f.name) for f in kind.fields))
        return F.when(value.isNotNull(), out)
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: rewrite_strings(x, kind.elementType, leaf))
    if isinstance(kind, MapType):
        return F.transform_values(value, lambda _, x: rewrite_strings(x, kind.valueType, leaf))
    return leaf(value) if isinstance(kind, StringType) else value


def moved(path: Column, roots: Mapping[str, str], other: str | None = None, below: str | None = None) -> Column:
    """A path under its longest root that matches, at the root's new place.

    A root matches whole path segments only.  A path below ``below`` that no root matches keeps its
    last segment, in ``other``.
    """
    under = lambda root: (path == root) | F.startswith(path, F.lit(root.rstrip("/") + "/"))
    out: Column | None = None
    for root in sorted(roots, key=lambda r: (-len(r), r)):
        place = F.concat(F.lit(roots[root]), F.substring(path, F.lit(len(root.rstrip("/")) + 1), F.length(path)))
        out = F.when(under(root), place) if out is None else out.when(under(root), place)
    if below is not None and other is not None:
        last = F.concat(F.lit(other + "/"), F.element_at(F.split(path, "/"), -1))
        out = F.when(under(below), last) if out is None else out.when(under(below), last)
    return path if out is None else out.otherwise(path)


def rewrite_roots(df: DataFrame, columns: list[str], roots: Mapping[str, str], other: str | None = None, below: str | None = None) -> DataFrame:
    """Nested columns with every string leaf ``moved``."""
    return df.withColumns({c: rewrite_strings(F.col(c), df.schema[c].dataType, lambda s: moved(s, roots, other, below)) for c in columns})


def replace_strings(df: DataFrame, columns: list[str], replacements: Mapping[str, str]) -> DataFrame:
    """Nested columns with all replacements made one after the other in every string leaf."""

    def leaf(s: Column) -> Column:
        for old, new in replacements.items():
            s = F.replace(s, F.lit(old), F.lit(new))
        return s

    return df.withColumns({c: rewrite_strings(F.col(c), df.schema[c].dataType, leaf) for c in columns})
