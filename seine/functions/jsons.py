"""Typed reads of JSON: of text, or of a document that was parsed once into a variant."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_path(dotted: str) -> str:
    """``a.b[0].c-d`` as a JSON path with every key quoted."""
    out = "$"
    for part in dotted.split("."):
        key, index = re.fullmatch(r"([^\[]*)(\[\d+\])?", part).groups()
        out += f"['{key}']" + (index or "")
    return out


def at(doc: Column, dotted: str) -> Column:
    """The text of what stands at a path: a string's own characters, anything else as JSON; null if absent or null."""
    return F.get_json_object(doc, json_path(dotted)) if dotted else F.lit(None).cast("string")


def kind(doc: Column, dotted: str) -> Column:
    """string, number, bool, object, array; null if absent or null."""
    found = F.try_variant_get(F.try_parse_json(doc), json_path(dotted), "variant") if dotted else F.lit(None).cast("variant")
    name = F.schema_of_variant(found)
    return F.when(name.startswith("OBJECT"), "object").when(name.startswith("ARRAY"), "array").when(name == "STRING", "string").when(name == "BOOLEAN", "bool").when(name.isNotNull() & (name != "VOID"), "number")


def string_at(doc: Column, dotted: str) -> Column:
    """A number as its truncated integer, a truth value as true or false, a missing one as empty."""
    text = at(doc, dotted)
    whole = text.try_cast("double").cast("long").cast("string")
    return F.coalesce(F.when(kind(doc, dotted) == "number", whole).otherwise(text), F.lit(""))


def number_at(doc: Column, dotted: str) -> Column:
    """A number, or a string that reads as one; else 0."""
    return F.coalesce(at(doc, dotted).try_cast("double"), F.lit(0.0))


def rounded_string(doc: Column, key: str) -> Column:
    """A trimmed string, or a number rounded half to even; empty for anything else."""
    text, what = at(doc, key), kind(doc, key)
    return F.coalesce(F.when(what == "string", F.trim(text)).when(what == "number", F.rint(text.try_cast("double")).cast("long").cast("string")), F.lit(""))


def nested_string(doc: Column, key: str) -> Column:
    """A trimmed string, or an object's name, text or city."""
    inner = F.coalesce(*(F.nullif(rounded_string(at(doc, key), k), F.lit("")) for k in ("name", "text", "city")), F.lit(""))
    what = kind(doc, key)
    return F.coalesce(F.when(what == "string", F.trim(at(doc, key))).when(what == "object", inner), F.lit(""))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often the body's lambdas use it."""
    return F.transform(F.array(value), body)[0]


def inside(doc: Column, dotted: str) -> Column:
    """What stands at a path of a variant, a variant too; null if absent."""
    return F.try_variant_get(doc, json_path(dotted), "variant")


def type_of(value: Column) -> Column:
    """string, number, bool, object, array; null if absent or null."""
    name = F.schema_of_variant(value)
    return F.when(name.startswith("OBJECT"), "object").when(name.startswith("ARRAY"), "array").when(name == "STRING", "string").when(name == "BOOLEAN", "bool").when(name.isNotNull() & (name != "VOID"), "number")


def text_of(value: Column) -> Column:
    """A string's own characters, anything else as JSON; null if absent or null."""
    return F.try_variant_get(value, "$", "string")


def items_of(value: Column) -> Column:
    """Elements of an array, null for anything else."""
    return F.try_variant_get(value, "$", "array<variant>")


def is_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>").isNotNull()


def string_of(value: Column) -> Column:
    """A number as its truncated integer, a truth value as true or false, a missing one as empty."""
    text = text_of(value)
    return F.coalesce(F.when(type_of(value) == "number", text.try_cast("double").cast("long").cast("string")).otherwise(text), F.lit(""))


def number_of(value: Column) -> Column:
    """A number, or a string that reads as one; else 0."""
    return F.coalesce(text_of(value).try_cast("double"), F.lit(0.0))


def rounded_of(value: Column) -> Column:
    """A trimmed string, or a number rounded half to even; empty for anything else."""
    text, what = text_of(value), type_of(value)
    return F.coalesce(F.when(what == "string", F.trim(text)).when(what == "number", F.rint(text.try_cast("double")).cast("long").cast("string")), F.lit(""))


def nested_of(value: Column) -> Column:
    """A trimmed string, or an object's name, text or city."""
    inner = F.coalesce(*(F.nullif(rounded_of(inside(value, k)), F.lit("")) for k in ("name", "text", "city")), F.lit(""))
    what = type_of(value)
    return F.coalesce(F.when(what == "string", F.trim(text_of(value))).when(what == "object", inner), F.lit(""))


def is_json(text: Column) -> Column:
    return F.try_parse_json(text).isNotNull()


def looks_like_json(text: Column) -> Column:
    return F.coalesce(text.rlike(r"^\s*[\{\[]"), F.lit(False))


def array_items(text: Column) -> Column:
    """Elements of a JSON array as JSON text, null for anything else."""
    return F.when(F.ltrim(text).startswith("["), F.from_json(text, "array<string>"))


def canonical(text: Column) -> Column:
    """Written again with the keys in order."""
    return F.to_json(F.try_parse_json(text))


def field_census(text: Column) -> Column:
    """Keys of the root object, of objects under it, and of the first element of arrays: a, a.b, a[].b, [].b."""
    keys = lambda x: F.coalesce(F.json_object_keys(x), F.array().cast("array<string>"))
    below = lambda doc, k: F.call_function("get_json_object", doc, F.concat(F.lit("$['"), k, F.lit("']")))
    under = F.flatten(F.transform(keys(text), lambda k: F.concat(F.transform(keys(below(text, k)), lambda b: F.concat(k, F.lit("."), b)), F.transform(keys(F.get_json_object(below(text, k), "$[0]")), lambda b: F.concat(k, F.lit("[]."), b)))))
    return F.concat(keys(text), under, F.transform(keys(F.get_json_object(text, "$[0]")), lambda b: F.concat(F.lit("[]."), b)))
