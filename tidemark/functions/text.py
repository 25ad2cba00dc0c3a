"""Text, URL and identifier expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.fixed_values import BLOCKED_HOST_SUFFIXES


def compact_text(text: Column, limit: int | None = None) -> Column:
    """Runs of white space become one space. With a display ``limit``, longer text is cut and marked with ``…``."""
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))
    if limit is None:
        return flat
    return F.when(F.length(flat) > limit, F.concat(F.trim(F.left(flat, F.lit(limit))), F.lit("…"))).otherwise(flat)


def safe_url(url: Column) -> Column:
    """The URL when it is http or https, else null."""
    return F.when(F.lower(F.try_parse_url(url, F.lit("PROTOCOL"))).isin("http", "https"), url)


def url_host(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def public_url(url: Column) -> Column:
    """True for an absolute http(s) URL to a public host, without user info."""
    protocol = F.lower(F.try_parse_url(url, F.lit("PROTOCOL")))
    host = F.regexp_replace(F.lower(F.try_parse_url(url, F.lit("HOST"))), r"\.+$", "")
    authority = F.try_parse_url(url, F.lit("AUTHORITY"))
    user = F.coalesce(F.try_parse_url(url, F.lit("USERINFO")), F.lit(""))
    port = F.regexp_extract(authority, r":(\d+)$", 1).try_cast("int")
    clean = ~url.rlike(r"(?U)[\\\s\x00-\x1f]")
    labels = F.split(host, r"\.")
    numeric_v4 = host.rlike(r"^\d{1,3}(\.\d{1,3}){3}$")
    octet = F.transform(labels, lambda x: x.try_cast("int"))
    first, second, third = octet[0], F.try_element_at(octet, F.lit(2)), F.try_element_at(octet, F.lit(3))
    reserved_v4 = (
        first.isin(0, 10, 127)
        | (first >= 224)
        | ((first == 100) & second.between(64, 127))
        | ((first == 169) & (second == 254))
        | ((first == 172) & second.between(16, 31))
        | ((first == 192) & (second == 168))
        | ((first == 192) & (second == 0) & third.isin(0, 2))
        | ((first == 198) & second.between(18, 19))
        | ((first == 198) & (second == 51) & (third == 100))
        | ((first == 203) & (second == 0) & (third == 113))
        | F.exists(octet, lambda x: x > 255)
    )
    v6 = host.startswith("[")
    reserved_v6 = host.rlike(r"^\[(::|::1|0*:.*|f[cd].*|fe[89ab].*|ff.*|2001:0?db8.*|::ffff:.*)\]$")
    named = (
        (F.size(labels) >= 2)
        & ~F.exists(labels, lambda x: x == "")
        & ~F.element_at(labels, -1).isin(*BLOCKED_HOST_SUFFIXES)
    )
    host_ok = F.when(v6, ~reserved_v6).when(numeric_v4, ~reserved_v4).otherwise(named)
    port_ok = port.isNull() | port.between(1, 65535)
    return F.coalesce(
        protocol.isin("http", "https") & (F.length(host) > 0) & ~user.rlike("[^:]") & clean & port_ok & host_ok,
        F.lit(False),
    )


def digest_id(parts: Sequence[Column], length: int) -> Column:
    """Leading hex digits of the SHA-256 over the parts joined by NUL."""
    return F.substring(F.sha2(F.concat_ws("\u0000", *parts), 256), 1, length)


def content_id(source: str, url: Column, published: Column, title: Column) -> Column:
    return digest_id([F.lit(source), url, published, title], 24)


def shard_of(key: Column) -> Column:
    """One of 16 shards: the first hex digit of the key's SHA-256."""
    return F.substring(F.sha2(key, 256), 1, 1)


def path_date(path: Column) -> Column:
    """ISO date of the first ``/YYYY/MM/DD/`` in a path."""
    pattern = r"(?:^|/)(\d{4})/(\d{2})/(\d{2})(?:/|$)"
    return F.when(
        path.rlike(pattern),
        F.concat_ws("-", *[F.regexp_extract(path, pattern, i) for i in (1, 2, 3)]),
    )


def markdown_title(text: Column, path: Column) -> Column:
    """First ``# `` heading, else the file name without ``.md``."""
    heading = F.trim(F.regexp_extract(text, r"(?m)^#[ \t]+(.+)$", 1))
    name = F.regexp_replace(F.substring_index(path, "/", -1), r"\.md$", "")
    return F.when(heading != "", heading).otherwise(name)


def markdown_summary(text: Column, limit: int | None = None) -> Column:
    return compact_text(F.regexp_replace(text, r"(?m)\A([\s\S]*?)^#.+$", "$1"), limit)


def contains_any(haystack: Column, needles: Sequence[str]) -> Column:
    hit = F.lit(False)
    for needle in needles:
        hit = hit | haystack.contains(needle)
    return hit


def search_match(query: str, *fields: Column) -> Column:
    """Case-insensitive substring over the joined fields; an empty query matches all."""
    query = query.strip().lower()
    if not query:
        return F.lit(True)
    return F.lower(F.concat_ws(" ", *[F.coalesce(f, F.lit("")) for f in fields])).contains(query)


def semantic_key(text: Column) -> Column:
    """Lower case with everything but letters and digits removed."""
    return F.regexp_replace(F.lower(text), r"(?U)[\W_]+", "")


def _unquoted(token: Column) -> Column:
    return F.from_json(F.concat(F.lit("["), token, F.lit("]")), "array<string>")[0]


def is_json(text: Column) -> Column:
    """True for a text that is a whole JSON object, array or string."""
    return F.coalesce(text.rlike(r'^\s*[\[{"]') & F.try_parse_json(text).isNotNull(), F.lit(False))


def json_strings(text: Column) -> Column:
    """The string tokens (keys and values) of a JSON text in document order, unquoted and trimmed."""
    tokens = F.regexp_extract_all(text, F.lit(r'("[^"\\]*+(?:\\.[^"\\]*+)*+")'), F.lit(1))
    return F.transform(tokens, lambda t: F.trim(_unquoted(t)))


def opened_once(parts: Column) -> Column:
    """An array of texts in which every JSON text is replaced by the strings in it."""
    return F.flatten(F.transform(parts, lambda p: F.when(is_json(p), json_strings(p)).otherwise(F.array(p))))
