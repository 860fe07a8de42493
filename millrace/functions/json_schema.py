"""JSON schemas compiled to one native expression over VARIANT.

``compile_errors`` walks a schema (draft 2020-12) once, on the driver, and returns
an expression that gives every error of a document with its place: an array of
structs (path, keyword), in schema order.  A path is a JSON pointer; a missing
property is reported at the place it should have.  Objects are checked property by
property, arrays item by item with a lambda, so nothing leaves the JVM.

Checked: type, enum, const, required, properties, additionalProperties,
propertyNames with pattern, items, prefixItems, minItems, maxItems, uniqueItems,
contains, minLength, maxLength, pattern, minimum, maximum, exclusiveMinimum,
exclusiveMaximum, multipleOf, minProperties, maxProperties, dependentRequired,
allOf, anyOf, oneOf, not, if/then/else, and references to definitions of the same
schema that don't refer to themselves.  Annotations are ignored; a keyword of any
other name is an error when the schema is compiled, never passed over.

A null document (text that is no JSON) has the single error ("", "unreadable").
Patterns are Java's; numbers are compared as doubles.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

Schema = Mapping[str, Any] | bool

ERROR = "array<struct<path: string, keyword: string>>"
#: Keywords that assert nothing.
ANNOTATIONS = frozenset("$schema $id $anchor $comment $defs definitions title description default examples deprecated readOnly writeOnly format contentEncoding contentMediaType".split())


class SchemaError(ValueError):
    """A schema that can't be compiled."""


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """An expression that refers to a value several times and evaluates it once."""
    return F.transform(F.array(value), use)[0]


def _error(path: Column, keyword: str) -> Column:
    return F.struct(path.alias("path"), F.lit(keyword).alias("keyword"))


def _none() -> Column:
    return F.array().cast(ERROR)


def _when(bad: Column, path: Column, keyword: str) -> Column:
    return F.when(F.coalesce(bad, F.lit(False)), F.array(_error(path, keyword))).otherwise(_none())


def _step(name: str) -> str:
    """A property's place in a VARIANT path."""
    if "'" in name:
        raise SchemaError(f"a property name with a quote: {name}")
    return f"$['{name}']"


def _pointer(name: str) -> str:
    return "/" + name.replace("~", "~0").replace("/", "~1")


class _Compiler:
    def __init__(self, root: Schema) -> None:
        self.root, self.open = root, []

    # -- values

    def kinds(self, kind: Column, value: Column, names: list[str]) -> Column:
        """Whether a value is of one of the named types."""
        number = F.regexp_like(kind, F.lit(r"^(BIGINT|DOUBLE|FLOAT|DECIMAL)"))
        tests = {
            "null": kind == "VOID",
            "boolean": kind == "BOOLEAN",
            "string": kind == "STRING",
            "object": F.startswith(kind, F.lit("OBJECT")),
            "array": F.startswith(kind, F.lit("ARRAY")),
            "number": number,
            "integer": number & (self.number(value) == F.floor(self.number(value))),
        }
        out = F.lit(False)
        for name in names:
            if name not in tests:
                raise SchemaError(f"no type {name}")
            out = out | F.coalesce(tests[name], F.lit(False))
        return out

    def number(self, value: Column) -> Column:
        return F.try_variant_get(value, "$", "double")

    def equals(self, kind: Column, value: Column, wanted: Any) -> Column:
        if isinstance(wanted, str):
            return (kind == "STRING") & (F.try_variant_get(value, "$", "string") == wanted)
        if isinstance(wanted, bool) or wanted is None:
            return F.to_json(value) == json.dumps(wanted)
        if isinstance(wanted, (int, float)):
            return self.kinds(kind, value, ["number"]) & (self.number(value) == float(wanted))
        return F.to_json(value) == F.to_json(F.parse_json(F.lit(json.dumps(wanted))))

    # -- schemas

    def errors(self, value: Column, path: Column, schema: Schema) -> Column:
        """Errors of a VARIANT that exists."""
        if isinstance(schema, bool):
            return _none() if schema else F.array(_error(path, "false"))
        checks = [c for c in schema if c not in ANNOTATIONS]
        if not checks:
            return _none()
        held = F.struct(value.alias("v"), F.schema_of_variant(value).alias("k"), path.alias("p"))
        return _let(held, lambda h: self._all(h["v"], h["k"], h["p"], schema))

    def _all(self, v: Column, kind: Column, path: Column, schema: Mapping[str, Any]) -> Column:
        parts = []
        for keyword, wanted in schema.items():
            if keyword in ANNOTATIONS or keyword in ("then", "else"):
                continue
            check = getattr(self, "_" + keyword.replace("$", ""), None)
            if check is None or keyword.startswith("_"):
                raise SchemaError(f"no keyword {keyword}")
            parts.append(check(v, kind, path, wanted, schema))
        return F.concat(*parts) if parts else _none()

    def _present(self, value: Column, path: Column, schema: Schema) -> Column:
        """Errors of a value if it exists."""
        return _let(value, lambda x: F.when(x.isNull(), _none()).otherwise(self.errors(x, path, schema)))

    def _is(self, kind: Column, what: str) -> Column:
        return F.startswith(kind, F.lit(what))

    def _type(self, v, kind, path, wanted, _):
        return _when(~self.kinds(kind, v, [wanted] if isinstance(wanted, str) else list(wanted)), path, "type")

    def _enum(self, v, kind, path, wanted, _):
        fits = F.lit(False)
        for w in wanted:
            fits = fits | F.coalesce(self.equals(kind, v, w), F.lit(False))
        return _when(~fits, path, "enum")

    def _const(self, v, kind, path, wanted, _):
        return _when(~F.coalesce(self.equals(kind, v, wanted), F.lit(False)), path, "const")

    def _required(self, v, kind, path, wanted, _):
        gaps = [F.when(self._is(kind, "OBJECT") & F.try_variant_get(v, _step(n), "variant").isNull(), _error(F.concat(path, F.lit(_pointer(n))), "required")) for n in wanted]
        return F.array_compact(F.array(*gaps)) if gaps else _none()

    def _properties(self, v, kind, path, wanted, _):
        parts = []
        for name, schema in wanted.items():
            own = F.try_variant_get(v, _step(name), "variant")
            parts.append(self._present(own, F.concat(path, F.lit(_pointer(name))), schema))
        return F.when(self._is(kind, "OBJECT"), F.concat(*parts)).otherwise(_none()) if parts else _none()

    def _entries(self, v: Column) -> Column:
        return F.coalesce(F.map_entries(F.try_variant_get(v, "$", "map<string,variant>")), F.array())

    def _key_path(self, path: Column, key: Column) -> Column:
        return F.concat(path, F.lit("/"), F.replace(F.replace(key, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1")))

    def _additionalProperties(self, v, kind, path, wanted, schema):  # noqa: N802
        extra = F.filter(self._entries(v), lambda e: ~e["key"].isin(list(schema.get("properties", {}))) if schema.get("properties") else F.lit(True))
        if wanted is False:
            found = F.transform(extra, lambda e: _error(self._key_path(path, e["key"]), "additionalProperties"))
        else:
            found = F.flatten(F.transform(extra, lambda e: self.errors(e["value"], self._key_path(path, e["key"]), wanted)))
        return F.when(self._is(kind, "OBJECT"), found).otherwise(_none())

    def _propertyNames(self, v, kind, path, wanted, _):  # noqa: N802
        if set(wanted) - ANNOTATIONS != {"pattern"}:
            raise SchemaError("propertyNames takes a pattern only")
        bad = F.filter(self._entries(v), lambda e: ~F.regexp_like(e["key"], F.lit(wanted["pattern"])))
        return F.when(self._is(kind, "OBJECT"), F.transform(bad, lambda e: _error(self._key_path(path, e["key"]), "propertyNames"))).otherwise(_none())

    def _size(self, v: Column, kind: Column, what: str) -> Column:
        return F.when(self._is(kind, what), F.size(self._entries(v)) if what == "OBJECT" else F.size(self._list(v)))

    def _minProperties(self, v, kind, path, wanted, _):  # noqa: N802
        return _when(self._size(v, kind, "OBJECT") < wanted, path, "minProperties")

    def _maxProperties(self, v, kind, path, wanted, _):  # noqa: N802
        return _when(self._size(v, kind, "OBJECT") > wanted, path, "maxProperties")

    def _dependentRequired(self, v, kind, path, wanted, _):  # noqa: N802
        has = lambda n: F.try_variant_get(v, _step(n), "variant").isNotNull()
        gaps = [F.when(self._is(kind, "OBJECT") & has(name) & ~has(n), _error(F.concat(path, F.lit(_pointer(n))), "dependentRequired")) for name, needs in wanted.items() for n in needs]
        return F.array_compact(F.array(*gaps)) if gaps else _none()

    def _list(self, v: Column) -> Column:
        return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array())

    def _items(self, v, kind, path, wanted, schema):
        first = len(schema.get("prefixItems", ()))
        each = F.transform(self._list(v), lambda x, i: F.when(i >= first, self.errors(x, F.concat(path, F.lit("/"), i.cast("string")), wanted)).otherwise(_none()))
        return F.when(self._is(kind, "ARRAY"), F.flatten(each)).otherwise(_none())

    def _prefixItems(self, v, kind, path, wanted, _):  # noqa: N802
        parts = [self._present(F.get(self._list(v), F.lit(i)), F.concat(path, F.lit(f"/{i}")), s) for i, s in enumerate(wanted)]
        return F.when(self._is(kind, "ARRAY"), F.concat(*parts)).otherwise(_none())

    def _contains(self, v, kind, path, wanted, _):
        fits = F.exists(self._list(v), lambda x: F.size(self.errors(x, path, wanted)) == 0)
        return _when(self._is(kind, "ARRAY") & ~fits, path, "contains")

    def _minItems(self, v, kind, path, wanted, _):  # noqa: N802
        return _when(self._size(v, kind, "ARRAY") < wanted, path, "minItems")

    def _maxItems(self, v, kind, path, wanted, _):  # noqa: N802
        return _when(self._size(v, kind, "ARRAY") > wanted, path, "maxItems")

    def _uniqueItems(self, v, kind, path, wanted, _):  # noqa: N802
        texts = F.transform(self._list(v), lambda x: F.to_json(x))
        return _when(self._is(kind, "ARRAY") & F.lit(bool(wanted)) & (F.size(F.array_distinct(texts)) < F.size(texts)), path, "uniqueItems")

    def _text(self, v: Column, kind: Column) -> Column:
        return F.when(kind == "STRING", F.try_variant_get(v, "$", "string"))

    def _minLength(self, v, kind, path, wanted, _):  # noqa: N802
        return _when(F.char_length(self._text(v, kind)) < wanted, path, "minLength")

    def _maxLength(self, v, kind, path, wanted, _):  # noqa: N802
        return _when(F.char_length(self._text(v, kind)) > wanted, path, "maxLength")

    def _pattern(self, v, kind, path, wanted, _):
        return _when(~F.regexp_like(self._text(v, kind), F.lit(wanted)), path, "pattern")

    def _number_check(self, v: Column, kind: Column, path: Column, keyword: str, bad: Callable[[Column], Column]) -> Column:
        return _when(self.kinds(kind, v, ["number"]) & bad(self.number(v)), path, keyword)

    def _minimum(self, v, kind, path, wanted, _):
        return self._number_check(v, kind, path, "minimum", lambda x: x < float(wanted))

    def _maximum(self, v, kind, path, wanted, _):
        return self._number_check(v, kind, path, "maximum", lambda x: x > float(wanted))

    def _exclusiveMinimum(self, v, kind, path, wanted, _):  # noqa: N802
        return self._number_check(v, kind, path, "exclusiveMinimum", lambda x: x <= float(wanted))

    def _exclusiveMaximum(self, v, kind, path, wanted, _):  # noqa: N802
        return self._number_check(v, kind, path, "exclusiveMaximum", lambda x: x >= float(wanted))

    def _multipleOf(self, v, kind, path, wanted, _):  # noqa: N802
        return self._number_check(v, kind, path, "multipleOf", lambda x: x / float(wanted) != F.floor(x / float(wanted)))

    def _fits(self, v: Column, path: Column, schema: Schema) -> Column:
        return F.size(self.errors(v, path, schema)) == 0

    def _allOf(self, v, kind, path, wanted, _):  # noqa: N802
        return F.concat(*(self.errors(v, path, s) for s in wanted))

    def _anyOf(self, v, kind, path, wanted, _):  # noqa: N802
        return _when(~F.exists(F.array(*(self._fits(v, path, s) for s in wanted)), lambda x: x), path, "anyOf")

    def _oneOf(self, v, kind, path, wanted, _):  # noqa: N802
        return _when(F.size(F.filter(F.array(*(self._fits(v, path, s) for s in wanted)), lambda x: x)) != 1, path, "oneOf")

    def _not(self, v, kind, path, wanted, _):
        return _when(self._fits(v, path, wanted), path, "not")

    def _if(self, v, kind, path, wanted, schema):
        return F.when(self._fits(v, path, wanted), self.errors(v, path, schema.get("then", True))).otherwise(self.errors(v, path, schema.get("else", True)))

    def _ref(self, v, kind, path, wanted, _):
        if not wanted.startswith("#"):
            raise SchemaError(f"a reference outside the schema: {wanted}")
        if wanted in self.open:
            raise SchemaError(f"a schema that refers to itself: {wanted}")
        at = self.root
        for step in [s for s in wanted[1:].split("/") if s]:
            name = step.replace("~1", "/").replace("~0", "~")
            if not isinstance(at, Mapping) or name not in at:
                raise SchemaError(f"no definition {wanted}")
            at = at[name]
        self.open.append(wanted)
        try:
            return self.errors(v, path, at)
        finally:
            self.open.pop()


def compile_errors(value: Column, schema: Schema | str) -> Column:
    """Every error (path, keyword) of a VARIANT against a schema, given as a mapping or as its JSON text."""
    schema = json.loads(schema) if isinstance(schema, str) else schema
    found = _let(value, lambda v: F.when(v.isNull(), F.array(_error(F.lit(""), "unreadable"))).otherwise(_Compiler(schema).errors(v, F.lit(""), schema)))
    return found


def text_errors(text: Column, schema: Schema | str) -> Column:
    """``compile_errors`` of JSON text."""
    return compile_errors(F.try_parse_json(text), schema)
