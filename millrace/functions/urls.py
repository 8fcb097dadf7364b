"""Canonical URLs: one spelling for every address of a page."""

from __future__ import annotations

import re
import socket
import struct
from collections.abc import Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

LONGEST = 2048
PORTS = {"http": "80", "https": "443"}

# Query names that tell where a reader came from, never which page it is.
TRACKING = [
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "utm_id", "utm_name", "utm_brand", "utm_reader",
    "gclid", "dclid", "fbclid", "msclkid", "yclid", "twclid", "igshid", "mc_cid", "mc_eid", "ref_src", "ref_url", "_hsenc", "_hsmi",
]
_TRACKING = frozenset(TRACKING)

INVISIBLE = "​‌‍⁠﻿­"
_INVISIBLE = str.maketrans("", "", INVISIBLE)
_PARTS = re.compile(r"(?P<scheme>[A-Za-z][A-Za-z0-9+.-]*)://(?P<place>[^/?#]*)(?P<path>[^?#]*)(?:\?(?P<query>[^#]*))?(?:#.*)?", re.S)
_PLACE = re.compile(r"(?:\[(?P<six>[^\[\]]*)\]|(?P<name>[^\[\]:]*))(?::(?P<port>[0-9]*))?")
_ZEROS = re.compile(r"\b0(?::0)+\b")
_ESCAPE = re.compile(r"%([0-9A-Fa-f]{2})")
# Bytes that are never escaped, and those that a path keeps.
_PLAIN = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-._~")
_KEPT = _PLAIN | frozenset(b"/%:@!$&'()*+,;=")


def _six(text: str) -> str | None:
    """An IPv6 address as RFC 5952 writes it: lower case, no leading zeros, the longest run of zero groups (the first of
    equally long ones) as two colons; an embedded IPv4 address as two groups. Null for any other text."""
    try:
        groups = struct.unpack(">8H", socket.inet_pton(socket.AF_INET6, text))
    except (OSError, ValueError):
        return None
    written = ":".join(f"{g:x}" for g in groups)
    zeros = max(_ZEROS.finditer(written), key=lambda run: len(run[0]), default=None)
    return written if zeros is None else f"{written[: zeros.start()].rstrip(':')}::{written[zeros.end() :].lstrip(':')}"


def _host(place: re.Match) -> str | None:
    if place["six"] is not None:
        address = _six(place["six"])
        return address and f"[{address}]"
    return place["name"].lower().rstrip(".") or None


def _path(path: str) -> str:
    kept: list[str] = []
    for step in path.removeprefix("/").split("/"):
        if step == "..":
            del kept[-1:]
        elif step != ".":
            kept.append(step)
    text = _ESCAPE.sub(lambda m: chr(b) if (b := int(m[1], 16)) in _PLAIN else m[0].upper(), "/" + "/".join(kept))
    return text if text.isascii() and all(ord(c) in _KEPT for c in text) else "".join(chr(b) if b in _KEPT else f"%{b:02X}" for b in text.encode())


def canonical_url(raw: str | None) -> tuple[str | None, str | None]:
    """(canonical URL, None), or (None, 'missing' or 'invalid').

    Invisible characters and outer blanks go; scheme and host are lower case, default ports, the fragment, dot segments
    and tracking parameters go; unreserved escapes are decoded, others upper case; everything else stays in its order.
    Only http and https without credentials, blanks and control characters, and at most LONGEST characters, are valid.
    """
    value = (raw or "").translate(_INVISIBLE).strip()
    if not value:
        return None, "missing"
    parts = _PARTS.fullmatch(value)
    if parts is None or any(c <= " " or c == "\x7f" for c in value):
        return None, "invalid"
    scheme = parts["scheme"].lower()
    place = _PLACE.fullmatch(parts["place"])
    host = place and scheme in PORTS and _host(place)
    if not host or "@" in parts["place"]:
        return None, "invalid"
    port = place["port"].lstrip("0") or ("0" if place["port"] else "") if place["port"] is not None else ""
    if port and int(port) > 65535:
        return None, "invalid"
    query = "&".join(p for p in (parts["query"] or "").split("&") if p and p.partition("=")[0].lower() not in _TRACKING)
    url = f"{scheme}://{host}{f':{port}' if port and port != PORTS[scheme] else ''}{_path(parts['path'])}{'?' + query if query else ''}"
    return (url, None) if len(url) <= LONGEST else (None, "invalid")


@F.pandas_udf(T.StructType([T.StructField("url", T.StringType()), T.StructField("problem", T.StringType())]))
def canonical(urls: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """The struct (url, problem) of `canonical_url` for a column."""
    for batch in urls:
        yield pd.DataFrame([canonical_url(None if pd.isna(u) else u) for u in batch], columns=["url", "problem"], dtype=object)


@F.pandas_udf(T.ArrayType(T.StringType()))
def resolved_links(bases: pd.Series, links: pd.Series) -> pd.Series:
    """The distinct canonical targets of each page's links in their order, without the page itself."""

    def one(base, hrefs):
        if base is None or hrefs is None:
            return []
        found = dict.fromkeys(canonical_url(urljoin(base, h))[0] for h in hrefs if h)
        return [u for u in found if u and u != base]

    return pd.Series([one(b, h) for b, h in zip(bases, links)])


@F.pandas_udf(T.StringType())
def joined_links(bases: pd.Series, links: pd.Series) -> pd.Series:
    """Each link as an absolute address, seen from its page; null if it can't be one."""

    def one(base, link):
        try:
            return urljoin(base or "", link or "") or None
        except ValueError:
            return None

    return pd.Series([one(b, h) for b, h in zip(bases, links)], dtype=object)


def site_of(url: Column) -> Column:
    """Scheme, host and port of a canonical URL."""
    return F.regexp_extract(url, r"^([a-z]+://[^/?#]*)", 1)
