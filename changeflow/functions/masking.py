"""Masks for what is logged: addresses, URLs and tokens among command-line arguments."""

from __future__ import annotations

import base64
import json
import os
import posixpath
import re
from urllib.parse import parse_qsl, unquote, urlsplit

#: What an argument is taken for (fixed patterns).
_URL = re.compile(r"^(\w+)://")
_EMAIL = re.compile(r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$")
_JWT = re.compile(r"^[a-zA-Z0-9-_]+\.[a-zA-Z0-9-_]+\.[a-zA-Z0-9-_]+$")


def mask(text: str) -> str:
    half = len(text) // 2
    return text[:half] + "*" * (len(text) - half)


def mask_email(text: str) -> str:
    name, domain = text.split("@", 1)
    first, *rest = domain.split(".")
    return f"{mask(name)}@{'.'.join([mask(first), *rest])}"


def mask_url(url: str) -> str:
    """User, password, path and query values are masked; the host stays."""
    u = urlsplit(url)
    user, _, host = u.netloc.rpartition("@")
    if user:
        name, colon, password = user.partition(":")
        user = mask(name) + (f":{mask(password)}" if colon else "") + "@"
    path = "/" + mask(u.path[1:]) if len(u.path) > 1 else ""
    values: dict[str, list[str]] = {}
    for k, v in parse_qsl(u.query, keep_blank_values=True):
        values.setdefault(k, []).append(v)
    query = "&".join(sorted(f"{k}={mask(','.join(v))}" for k, v in values.items()))  # a repeated name is one part
    return f"{u.scheme}://{user}{host}{path}" + (f"?{query}" if query else "")


def _url_or_text(text: str) -> str:
    """A URL that can't be read is masked as a whole."""
    try:
        return mask_url(text)
    except ValueError:
        return mask(text)


def mask_arguments(arguments: list[str]) -> list[str]:
    kinds = ((_URL, _url_or_text), (_EMAIL, mask_email), (_JWT, mask))
    return [next((f(a) for pattern, f in kinds if pattern.match(a)), a) for a in arguments]


def is_localhost(host: str) -> bool:
    """Whether a host, with or without user and port, is this machine."""
    name = host.rsplit("@", 1)[-1]
    name = name[1 : name.find("]")] if name.startswith("[") else name.split(":")[0]
    return name.lower() in ("localhost", "::1", "0.0.0.0") or name.startswith("127.")


def user_text(url: str) -> str:
    """``user:password`` of a URL, as drivers take it; without a colon if there is no password."""
    u = urlsplit(url)
    return unquote(u.username or "") + ("" if u.password is None else f":{unquote(u.password)}")


def issuer(token: str, renamed: dict[str, str] | None = None) -> str:
    """The issuer that a signed token names, without a check of the signature; ``renamed``: what former names stand for."""
    parts = token.split(".")
    try:
        claims = json.loads(base64.urlsafe_b64decode(parts[1] + "=" * (-len(parts[1]) % 4)))
        name = claims["iss"]
    except (IndexError, KeyError, ValueError, TypeError) as e:
        raise ValueError("no token with an issuer") from e
    return (renamed or {}).get(name, name)


def file_uri(folder: str, name: str) -> str:
    """The URI of a file in a folder; a relative folder is one of the working directory."""
    return "file://" + posixpath.normpath(posixpath.join(os.path.abspath(folder).replace(os.sep, "/"), name))
