"""Main content of HTML pages as Markdown-like text, with what the page says about itself."""

from __future__ import annotations

import ipaddress
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements whose text no reader of the article sees, and elements that begin a block.
SKIPPED = ["script", "style", "noscript", "template", "svg", "math", "iframe", "object", "embed", "canvas", "form", "select", "textarea", "button", "input", "label", "nav", "header", "footer", "aside", "head", "title"]
BLOCKS = ["address", "article", "blockquote", "dd", "div", "dl", "dt", "fieldset", "figcaption", "figure", "hr", "li", "main", "ol", "p", "pre", "section", "table", "tbody", "thead", "tr", "ul", "h1", "h2", "h3", "h4", "h5", "h6"]
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"]
HIDDEN_CLASSES = ["sr-only", "visually-hidden", "visuallyhidden", "screen-reader", "skip-link"]
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden|(?:opacity|font-size)\s*:\s*0(?:\.0+)?(?:px|em|rem|%)?\s*(?:;|$)|text-indent\s*:\s*-\d{3,}|(?:left|top)\s*:\s*-\d{3,}", re.I)
_CHARSET = re.compile(rb"""charset\s*=\s*["']?([\w-]+)""", re.I)


class _Page(HTMLParser):
    """Collects (root depth, kind, text) blocks; `out` counts open skipped or hidden elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool]] = []
        self.out, self.blocks, self.kinds, self.links, self.meta = 0, [], ["p"], [], {}
        self.text, self.roots = [], {"article": 0, "main": 0}

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag in ("meta", "link") and (not self.out or any(t == "head" for t, _ in self.stack)):
            name = (a.get("property") or a.get("name") or a.get("rel") or "").lower()
            self.meta.setdefault(name, a.get("content") or a.get("href") or "")
        if tag in VOID:
            if tag == "br":
                self.text.append(" ")
            return
        classes = a.get("class", "").lower().split()
        hides = tag in SKIPPED or "hidden" in a or a.get("aria-hidden") == "true" or bool(_HIDDEN.search(a.get("style", ""))) or any(c in HIDDEN_CLASSES for c in classes)
        self.stack.append((tag, hides))
        self.out += hides
        if self.out:
            return
        if tag in BLOCKS:
            self.flush()
            self.kinds.append(tag)
        if tag in self.roots or a.get("role") == "main":
            self.roots["main" if tag != "article" else "article"] += 1
        if tag == "code" and "pre" not in self.kinds:
            self.text.append("`")
        if tag == "a" and a.get("href"):
            self.links.append((self.root(), a["href"]))
        if tag in ("td", "th") and self.text and "".join(self.text).strip():
            self.text.append(" | ")

    def handle_endtag(self, tag):
        at = next((k for k in range(len(self.stack) - 1, -1, -1) if self.stack[k][0] == tag), None)
        if at is None:
            return
        for name, hides in reversed(self.stack[at:]):
            if not self.out:
                if name == "code" and "pre" not in self.kinds:
                    self.text.append("`")
                if name in BLOCKS:
                    self.flush()
                    self.kinds.pop()
                if name in self.roots:
                    self.roots[name] = max(0, self.roots[name] - 1)
            self.out -= hides
        del self.stack[at:]

    def handle_data(self, data):
        if not self.out:
            self.text.append(data)

    def root(self) -> str:
        return "article" if self.roots["article"] else "main" if self.roots["main"] else ""

    def flush(self):
        kind, text = self.kinds[-1], "".join(self.text)
        self.text = []
        text = text.strip("\n") if kind == "pre" else " ".join(text.split())
        if text.strip():
            lead = {"li": "- ", "blockquote": "> "}.get(kind, "#" * int(kind[1]) + " " if re.fullmatch("h[1-6]", kind) else "")
            self.blocks.append((self.root(), kind, f"```\n{text}\n```" if kind == "pre" else lead + text))


def decoded(body: bytes, content_type: str | None = None) -> str:
    """Text of a page: the charset of the header, else of its first 4096 bytes, else UTF-8; wrong bytes are replaced."""
    named = _CHARSET.search((content_type or "").encode()) or _CHARSET.search(body[:4096])
    try:
        return body.decode(named[1].decode() if named else "utf-8", "replace").lstrip("﻿")
    except LookupError:
        return body.decode("utf-8", "replace").lstrip("﻿")


def main_content(page: str) -> dict:
    """The page's article (else its main part, else all of it): text, links, author, time, canonical address."""
    parser = _Page()
    parser.feed(page)
    parser.close()
    parser.flush()
    root = next((r for r in ("article", "main") if any(b[0] == r for b in parser.blocks)), None)
    blocks = [b for b in parser.blocks if root is None or b[0] == root or (root == "main" and b[0] == "article")]
    text = ""
    for n, (_, kind, part) in enumerate(blocks):
        tight = n and kind in ("li", "tr") and blocks[n - 1][1] == kind
        text += ("\n" if tight else "\n\n" if n else "") + part
    author = parser.meta.get("author") or parser.meta.get("article:author") or None
    return {
        "body_text": text or None, "author": author if author and len(author) <= 100 and "://" not in author else None, "published_raw": parser.meta.get("article:published_time") or parser.meta.get("date") or None,
        "canonical_raw": parser.meta.get("canonical") or None, "headings": sum(bool(re.fullmatch("h[1-6]", k)) for _, k, _ in blocks), "code_blocks": sum(k == "pre" for _, k, _ in blocks),
        "links": list(dict.fromkeys(h for r, h in parser.links if root is None or r == root)),
    }


@F.pandas_udf(T.StructType([
    *[T.StructField(n, T.StringType()) for n in ("body_text", "author", "published_raw", "canonical_raw")], *[T.StructField(n, T.IntegerType()) for n in ("headings", "code_blocks")],
    T.StructField("links", T.ArrayType(T.StringType())),
]))
def content_column(bodies: pd.Series, content_types: pd.Series) -> pd.DataFrame:
    empty = {"body_text": None, "author": None, "published_raw": None, "canonical_raw": None, "headings": 0, "code_blocks": 0, "links": []}
    return pd.DataFrame([main_content(decoded(bytes(b), t)) if b is not None else empty for b, t in zip(bodies, content_types)])


# Address ranges that are no public host's (registries of special-purpose addresses).
CLOSED_RANGES = [
    "0.0.0.0/8", "10.0.0.0/8", "100.64.0.0/10", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.0.0.0/24", "192.0.2.0/24", "192.88.99.0/24", "192.168.0.0/16",
    "198.18.0.0/15", "198.51.100.0/24", "203.0.113.0/24", "224.0.0.0/4", "240.0.0.0/4",
    "::/96", "64:ff9b:1::/48", "100::/64", "2001::/23", "2001:db8::/32", "2002::/16", "3fff::/20", "5f00::/16", "fc00::/7", "fe80::/10", "ff00::/8",
]
# IPv6 ranges whose last 32 bits are an IPv4 address.
WRAPPED_RANGES = ["::ffff:0:0/96", "64:ff9b::/96"]
_CLOSED, _WRAPPED = (list(map(ipaddress.ip_network, ranges)) for ranges in (CLOSED_RANGES, WRAPPED_RANGES))


def public_address(address: str | None) -> bool:
    """Whether an IP address is public; IPv6 addresses that wrap an IPv4 one are judged by that, a zone is ignored."""
    try:
        ip = ipaddress.ip_address((address or "").partition("%")[0])
    except ValueError:
        return False
    if any(ip in wrapped for wrapped in _WRAPPED if ip.version == 6):
        ip = ipaddress.IPv4Address(int(ip) & 0xFFFFFFFF)
    return not any(ip in closed for closed in _CLOSED if closed.version == ip.version)


@F.pandas_udf(T.BooleanType())
def public_column(addresses: pd.Series) -> pd.Series:
    return addresses.map(public_address)
