"""Validation rules: JSON-Schema documents compiled to predicates over raw JSON text, with a path template for valid events.

What a schema says of values, texts, numbers, arrays and objects becomes Column expressions, so that validation stays in the JVM: type, const,
enum, min and max of lengths, items, properties and numbers, multipleOf, pattern, format date-time, uniqueItems, items, prefixItems, contains,
required, dependentRequired, properties, patternProperties, additionalProperties, propertyNames, allOf, anyOf, oneOf, not, if and $ref. Other
keywords (those that depend on what other keywords have seen) raise when a rule is compiled.
"""

from __future__ import annotations

import json
import os
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.naming import path_template

_IGNORED = {"$schema", "$id", "title", "description", "default", "examples"}
_DATE_TIME = r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"
_TESTS = {
    "object": "OBJECT%", "array": "ARRAY%", "string": "STRING", "boolean": "BOOLEAN",
}


#: The keywords that are compiled; ``then`` and ``else`` are read with ``if``.
_KEYWORDS = {
    "$ref", "allOf", "anyOf", "oneOf", "not", "if", "type", "enum", "const", "minLength", "maxLength", "pattern", "format", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf", "items", "prefixItems",
    "contains", "minItems", "maxItems", "uniqueItems", "required", "dependentRequired", "properties", "patternProperties", "additionalProperties", "propertyNames", "minProperties", "maxProperties",
}
#: Fields of an event that rules see; ``before`` and ``after`` as JSON.
_PLAIN = ["operation", "id", "table", "key", "modelVersion", "companyId", "locationId", "userId", "diff", "timestamp", "mvccTimestamp"]
_IMAGES = ("before", "after")


class _Event:
    """The event as a value of its own: its fields are columns, and those that are null are missing."""

    def get(self, name: str) -> Column:
        if name in _IMAGES:
            return _filled(F.col(f"_{name}"))
        return _filled(F.try_variant_get(F.col("_event"), f"$.{name}", "variant")) if name in _PLAIN else F.lit(None).cast("variant")

    def entries(self) -> Column:
        each = [F.struct(F.lit(n).alias("key"), self.get(n).alias("value")) for n in (*_PLAIN, *_IMAGES)]
        return F.filter(F.array(*each), lambda e: e["value"].isNotNull())


def _filled(v: Column) -> Column:
    return F.when(~F.is_variant_null(v), v)


def _get(v: Column | _Event, name: str) -> Column:
    return v.get(name) if isinstance(v, _Event) else F.try_variant_get(v, f"$.{name}" if re.fullmatch(r"[A-Za-z_]\w*", name) else f'$["{name}"]', "variant")


def _entries(v: Column | _Event) -> Column:
    """(key, value) of an object's properties; null for other values."""
    return v.entries() if isinstance(v, _Event) else F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))


def _name(key: Column) -> Column:
    """A property's name as a JSON text."""
    return F.get(F.try_variant_get(F.to_variant_object(F.array(key)), "$", "array<variant>"), F.lit(0))


def _text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _double(v: Column) -> Column:
    return F.try_variant_get(v, "$", "double")


def _array(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _type_is(v: Column | _Event, kind: str) -> Column:
    if isinstance(v, _Event):
        return F.lit(kind == "object")
    t = F.schema_of_variant(v)
    if kind == "number":
        return t.startswith("BIGINT") | t.startswith("DOUBLE") | t.startswith("DECIMAL") | t.startswith("FLOAT")
    if kind == "integer":
        return t.startswith("BIGINT") | (t.rlike("^(DOUBLE|DECIMAL|FLOAT)") & (_double(v) == F.floor(_double(v))))
    return t == "VOID" if kind == "null" else t.like(_TESTS[kind])


class Rules:
    """``folder`` holds config.json ({table: {schema, path}}) and the schema files it names; or both are given as dictionaries."""

    def __init__(self, folder: str = "", rules: dict[str, dict] | None = None, documents: dict[str, dict] | None = None):
        self.folder, self.documents = folder, documents or {}
        if rules is None:
            with open(os.path.join(folder, "config.json"), encoding="utf-8") as f:
                rules = json.load(f)
        self.rules = rules

    def load(self, ref: str) -> dict:
        name = ref.removeprefix("file://").lstrip("/")
        if name in self.documents:
            return self.documents[name]
        with open(os.path.join(self.folder, name), encoding="utf-8") as f:
            return json.load(f)

    def check(self, schema: dict | bool, v: Column | _Event) -> Column:
        """Whether a VARIANT column, or the event, fits; missing values (NULL) fit everything but ``required``."""
        if isinstance(schema, bool):
            return F.lit(schema)
        out = F.lit(True)
        for key, want in schema.items():
            if key in _IGNORED or key in ("then", "else"):
                continue
            test = getattr(self, f"_{key.lstrip('$')}", None)
            if key not in _KEYWORDS or test is None:
                raise ValueError(f"schema keyword {key!r} is not supported")
            out = out & F.coalesce(test(want, v, schema), F.lit(False))
        return out

    def _ref(self, want: str, v, _) -> Column:
        return self.check(self.load(want), v)

    def _allOf(self, want: list, v, _) -> Column:
        return reduce(Column.__and__, [self.check(s, v) for s in want])

    def _anyOf(self, want: list, v, _) -> Column:
        return reduce(Column.__or__, [self.check(s, v) for s in want])

    def _oneOf(self, want: list, v, _) -> Column:
        return reduce(Column.__add__, [self.check(s, v).cast("int") for s in want]) == 1

    def _not(self, want: dict, v, _) -> Column:
        return ~self.check(want, v)

    def _if(self, want: dict, v, schema: dict) -> Column:
        return F.when(self.check(want, v), self.check(schema.get("then", True), v)).otherwise(self.check(schema.get("else", True), v))

    def _type(self, want: str | list, v, _) -> Column:
        return reduce(Column.__or__, [_type_is(v, k) for k in (want if isinstance(want, list) else [want])])

    def _enum(self, want: list, v, _) -> Column:
        return F.coalesce(F.to_json(v).isin([json.dumps(o, ensure_ascii=False, separators=(",", ":")) for o in want]), F.lit(False))

    def _const(self, want, v, _) -> Column:
        return self._enum([want], v, _)

    def _minLength(self, want: int, v, _) -> Column:
        return ~_type_is(v, "string") | (F.char_length(_text(v)) >= want)

    def _maxLength(self, want: int, v, _) -> Column:
        return ~_type_is(v, "string") | (F.char_length(_text(v)) <= want)

    def _pattern(self, want: str, v, _) -> Column:
        return ~_type_is(v, "string") | _text(v).rlike(want)

    def _format(self, want: str, v, _) -> Column:
        if want != "date-time":
            return F.lit(True)
        return ~_type_is(v, "string") | (_text(v).rlike(_DATE_TIME) & F.substring(_text(v), 1, 19).try_cast("timestamp").isNotNull())

    def _minimum(self, want: float, v, _) -> Column:
        return ~_type_is(v, "number") | (_double(v) >= want)

    def _maximum(self, want: float, v, _) -> Column:
        return ~_type_is(v, "number") | (_double(v) <= want)

    def _exclusiveMinimum(self, want: float, v, _) -> Column:
        return ~_type_is(v, "number") | (_double(v) > want)

    def _exclusiveMaximum(self, want: float, v, _) -> Column:
        return ~_type_is(v, "number") | (_double(v) < want)

    def _multipleOf(self, want: float, v, _) -> Column:
        return ~_type_is(v, "number") | (F.abs(_double(v) / want - F.round(_double(v) / want)) < 1e-9)

    def _items(self, want: dict, v, schema: dict) -> Column:
        values, first = _array(v), len(schema.get("prefixItems", []))
        rest = F.slice(values, first + 1, F.greatest(F.size(values) - first, F.lit(0))) if first else values
        return ~_type_is(v, "array") | F.coalesce(F.forall(rest, self._test(want)), F.lit(True))

    def _prefixItems(self, want: list, v, _) -> Column:
        each = [F.get(_array(v), F.lit(i)).isNull() | self.check(s, F.get(_array(v), F.lit(i))) for i, s in enumerate(want)]
        return ~_type_is(v, "array") | reduce(Column.__and__, each)

    def _contains(self, want: dict, v, _) -> Column:
        return ~_type_is(v, "array") | F.coalesce(F.exists(_array(v), self._test(want)), F.lit(False))

    def _minItems(self, want: int, v, _) -> Column:
        return ~_type_is(v, "array") | (F.size(_array(v)) >= want)

    def _maxItems(self, want: int, v, _) -> Column:
        return ~_type_is(v, "array") | (F.size(_array(v)) <= want)

    def _uniqueItems(self, want: bool, v, _) -> Column:
        texts = F.transform(_array(v), lambda x: F.to_json(x))
        return F.lit(not want) | ~_type_is(v, "array") | (F.size(F.array_distinct(texts)) == F.size(texts))

    def _required(self, want: list[str], v, _) -> Column:
        return ~_type_is(v, "object") | reduce(Column.__and__, [_get(v, name).isNotNull() for name in want], F.lit(True))

    def _dependentRequired(self, want: dict[str, list[str]], v, _) -> Column:
        return reduce(Column.__and__, [_get(v, name).isNull() | self._required(others, v, _) for name, others in want.items()], F.lit(True))

    def _properties(self, want: dict[str, dict], v, _) -> Column:
        return reduce(Column.__and__, [_get(v, name).isNull() | self.check(s, _get(v, name)) for name, s in want.items()], F.lit(True))

    def _patternProperties(self, want: dict[str, dict], v, _) -> Column:
        fits = lambda p, s: lambda e: ~e["key"].rlike(p) | self.check(s, e["value"])
        each = [F.forall(_entries(v), fits(p, s)) for p, s in want.items()]
        return ~_type_is(v, "object") | F.coalesce(reduce(Column.__and__, each), F.lit(True))

    def _additionalProperties(self, want: dict | bool, v, schema: dict) -> Column:
        named, patterns = list(schema.get("properties", {})), list(schema.get("patternProperties", {}))

        def fits(e: Column) -> Column:
            known = e["key"].isin(named) if named else F.lit(False)
            return reduce(Column.__or__, [e["key"].rlike(p) for p in patterns], known) | self.check(want, e["value"])

        return ~_type_is(v, "object") | F.coalesce(F.forall(_entries(v), fits), F.lit(True))

    def _propertyNames(self, want: dict, v, _) -> Column:
        return ~_type_is(v, "object") | F.coalesce(F.forall(_entries(v), lambda e: self.check(want, _name(e["key"]))), F.lit(True))

    def _minProperties(self, want: int, v, _) -> Column:
        return ~_type_is(v, "object") | (F.size(_entries(v)) >= want)

    def _maxProperties(self, want: int, v, _) -> Column:
        return ~_type_is(v, "object") | (F.size(_entries(v)) <= want)

    def _test(self, schema: dict):
        return lambda x: self.check(schema, x)

    def validate(self, events: DataFrame) -> DataFrame:
        """Events that a rule accepts, with ``validated_path``; events of tables without a rule are dropped."""
        images = [F.when(F.length(c) > 0, F.try_parse_json(c)).alias(c) for c in _IMAGES]
        whole = F.to_variant_object(F.struct(*_PLAIN))
        # a generator of one row: the tests below are many, and none of them makes these values anew
        rows = events.select("*", F.inline(F.array(F.struct(whole.alias("_event"), *[i.alias(f"_{c}") for i, c in zip(images, _IMAGES, strict=True)]))))
        valid, path = F.lit(False), F.lit(None).cast("string")
        for table, rule in self.rules.items():
            ok = self.check(self.load(rule["schema"]), _Event())
            here = F.col("table") == table
            valid = F.when(here, ok).otherwise(valid)
            template = rule.get("path") or ""
            path = F.when(here, path_template(template, F.col)).otherwise(path) if template else path
        return rows.withColumn("_ok", valid).withColumn("validated_path", path).filter("_ok").drop("_ok", "_event", "_before", "_after")
