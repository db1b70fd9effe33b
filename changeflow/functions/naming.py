"""Names that sinks give: object paths, message keys, partition keys, and the path templates of validation rules."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_none(c: Column) -> Column:
    return F.coalesce(F.when(c != "", c), F.lit("NONE"))


def partition_key(table: Column, company: Column, location: Column, pk: Column) -> Column:
    """Events with this key in common keep their order."""
    return F.concat_ws(".", table, or_none(company), or_none(location), pk)


def message_key(table: Column, op: Column, company: Column, location: Column, event_id: Column) -> Column:
    return F.concat_ws(".", F.lit("dbchange"), table, op, or_none(company), or_none(location), event_id)


def seconds(ms: Column) -> Column:
    return F.floor(ms / 1000).cast("long")


def file_path(table: Column, ms: Column, pk: Column) -> Column:
    """One file an event; events of one second and key overwrite each other, the last stays."""
    return F.concat(table, F.lit("/"), seconds(ms).cast("string"), F.lit("-"), pk, F.lit(".json"))


def object_key(prefix: str, table: Column, ms: Column, pk: Column, validated: Column | None = None) -> Column:
    """The validated path if there is one, else the file path, below the prefix."""
    path = file_path(table, ms, pk)
    if validated is not None:
        path = F.coalesce(F.when(validated != "", validated), path)
    head = prefix.strip("/")
    return F.concat(F.lit(f"{head}/"), path) if head else path


_FIELD = re.compile(r"\{\{\s*\.(\w+)\s*\}\}")


def html_escaped(c: Column) -> Column:
    """Texts as HTML templates put them in (fixed values)."""
    for raw, text in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&#34;"), ("'", "&#39;"), ("+", "&#43;")):
        c = F.replace(c, F.lit(raw), F.lit(text))
    return c


def path_template(template: str, field, html: bool = False) -> Column:
    """``{{.name}}`` parts become columns, given by ``field``; values are put in as they are, or ``html``-escaped."""
    parts, last = [], 0
    for m in _FIELD.finditer(template):
        if m.start() > last:
            parts.append(F.lit(template[last : m.start()]))
        value = F.coalesce(field(m.group(1)).cast("string"), F.lit(""))
        parts.append(html_escaped(value) if html else value)
        last = m.end()
    if last < len(template):
        parts.append(F.lit(template[last:]))
    return F.concat(*parts) if parts else F.lit("")


def mask(c: Column) -> Column:
    """The first half of a text, then a star for each further character."""
    shown = F.floor(F.char_length(c) / 2).cast("int")
    return F.concat(F.substring(c, F.lit(1), shown), F.repeat(F.lit("*"), F.char_length(c) - shown))


def mask_email(c: Column) -> Column:
    """Name and first part of the domain masked; other texts as they are."""
    name, domain = F.split_part(c, F.lit("@"), F.lit(1)), F.split_part(c, F.lit("@"), F.lit(2))
    first = F.split_part(domain, F.lit("."), F.lit(1))
    return F.when(c.contains("@"), F.concat(mask(name), F.lit("@"), mask(first), F.expr("'.'"), F.substring(domain, F.char_length(first) + 2, F.char_length(domain)))).otherwise(c)


def mask_url(c: Column) -> Column:
    """User, password, path and query values masked, a repeated parameter as one, parameters by name; the fragment goes.

    The host stays; texts that are no URLs stay as they are.
    """
    url = r"^(\w+)://(?:([^/?#]*)@)?([^/?#@]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
    part = lambda n: F.regexp_extract(c, url, n)
    user, colon = F.split_part(part(2), F.lit(":"), F.lit(1)), F.locate(":", part(2))
    password = F.when(colon > 0, F.concat(F.lit(":"), mask(F.substring(part(2), colon + 1, F.char_length(part(2)))))).otherwise("")
    login = F.when(part(2) != "", F.concat(mask(user), password, F.lit("@"))).otherwise("")
    path = F.when(F.char_length(part(4)) > 1, F.concat(F.lit("/"), mask(F.substring(part(4), F.lit(2), F.char_length(part(4)))))).otherwise("")
    plain = lambda x: F.coalesce(F.try_url_decode(x), x)
    pairs = F.transform(F.filter(F.split(part(5), "&"), lambda p: p != ""), lambda p: F.struct(plain(F.split_part(p, F.lit("="), F.lit(1))).alias("k"), plain(F.substring(p, F.char_length(F.split_part(p, F.lit("="), F.lit(1))) + 2, F.char_length(p))).alias("v")))
    shown = F.transform(F.array_distinct(pairs["k"]), lambda k: F.concat(k, F.lit("="), mask(F.array_join(F.filter(pairs, lambda p: p["k"] == k)["v"], ","))))
    query = F.when(F.size(pairs) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(shown), "&"))).otherwise("")
    return F.when(c.rlike(url), F.concat(F.lower(part(1)), F.lit("://"), login, part(3), path, query)).otherwise(c)
