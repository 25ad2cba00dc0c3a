"""Detectors for credentials, personal identifiers and local paths, as expressions.

Each is a boolean over a whole text. They say that something was found, never what.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed


def field_key(name: Column) -> Column:
    """camelCase, kebab-case and spaced names as lower snake case."""
    snake = F.regexp_replace(F.trim(name), fixed.CAMEL_STEP_PATTERN, "_")
    return F.lower(F.regexp_replace(snake, fixed.NAME_GAP_PATTERN, "_"))


def forbidden_field(name: Column) -> Column:
    """``credential field``, ``personal/account identifier field`` or null."""
    key = field_key(name)
    suffix = "(" + "|".join(fixed.CREDENTIAL_SUFFIXES) + ")$"
    return F.when(key.isin(*fixed.CREDENTIAL_NAMES) | key.rlike(suffix), F.lit("credential field")).when(
        key.isin(*fixed.PERSONAL_NAMES), F.lit("personal/account identifier field")
    )


#: What every text with a finding holds. These are looked for first: they cost a fraction of the whole patterns, which
#: look back at every position of a text, and are parts of them, so no finding is lost.
URL_MARK = "://"
GATES = {
    "bearer_value": lambda text: text.rlike(r"(?iU)bearer[\t ]"),
    "url_query_credential": lambda text: text.contains("="),
    "url_userinfo": lambda text: text.contains(URL_MARK),
    "basic_credential": lambda text: text.rlike(r"(?iU)basic[\t ]"),
    "authorization_header": lambda text: text.contains(":") & text.rlike("(?iU)authorization"),
    "cookie_header": lambda text: text.contains(":") & text.contains("=") & text.rlike("(?iU)cookie"),
    "local_path": lambda text: text.contains("/") | text.contains("\\"),
    "private_path": lambda text: text.contains("/") | text.contains("\\"),
}


def has_bearer(text: Column) -> Column:
    return GATES["bearer_value"](text) & text.rlike(fixed.BEARER_PATTERN)


def has_url_query_credential(text: Column) -> Column:
    pairs = F.regexp_extract_all(text, F.lit(fixed.URL_PAIR_PATTERN), F.lit(0))

    def credential(pair: Column) -> Column:
        raw = F.regexp_extract(pair, fixed.URL_PAIR_PATTERN, 1)
        name = field_key(F.coalesce(F.try_url_decode(raw), raw))
        return name.isin(*fixed.URL_CREDENTIAL_NAMES) & (F.regexp_extract(pair, fixed.URL_PAIR_PATTERN, 2) != "")

    return GATES["url_query_credential"](text) & F.exists(pairs, credential)


def has_url_userinfo(text: Column) -> Column:
    urls = F.regexp_extract_all(text, F.lit(fixed.ABSOLUTE_URL_PATTERN), F.lit(0))
    user = lambda u: F.regexp_extract(u, r"^[^:]+://([^/?#]*)@", 1)
    return GATES["url_userinfo"](text) & F.exists(urls, lambda u: ~user(u).isin("", ":"))


def has_basic_credential(text: Column) -> Column:
    """A Basic value that decodes to text with the user/password separator."""
    values = F.regexp_extract_all(text, F.lit(fixed.BASIC_PATTERN), F.lit(1))

    def decodes(value: Column) -> Column:
        bare = F.regexp_replace(value, "=+$", "")
        padded = F.rpad(bare, (F.ceil(F.length(bare) / 4) * 4).cast("int"), F.lit("="))
        plain = F.try_to_binary(padded, F.lit("base64"))
        return F.coalesce(F.hex(plain).rlike("^(..)*3A"), F.lit(False))

    return GATES["basic_credential"](text) & F.exists(values, decodes)


def has_authorization_header(text: Column) -> Column:
    return GATES["authorization_header"](text) & text.rlike(fixed.AUTHORIZATION_HEADER_PATTERN)


def has_cookie_header(text: Column) -> Column:
    return GATES["cookie_header"](text) & text.rlike(fixed.COOKIE_HEADER_PATTERN)


def without_web_urls(text: Column) -> Column:
    """Text with http(s) URLs cut out. Other URLs stay: they are matched first and kept whole."""
    body = fixed.URL_BODY_PATTERN
    pattern = rf"(?iU)(\b(?!https?://)[a-z][a-z0-9+.-]*{body})|\bhttps?{body}"
    return F.when(text.contains(URL_MARK), F.regexp_replace(text, pattern, " $1 ")).otherwise(text)


def has_local_path(text: Column) -> Column:
    """A local file path outside web URLs, or a ``file:`` URL."""
    urls = F.regexp_extract_all(text, F.lit(fixed.ABSOLUTE_URL_PATTERN), F.lit(0))
    visible = without_web_urls(text)
    # A drive or a share holds one of these; neither spans the blank that stands for a URL.
    windows = text.contains(":/") | text.contains("\\")
    found = (
        (text.contains(URL_MARK) & F.exists(urls, lambda u: F.lower(u).startswith("file:")))
        | (text.contains("/") & visible.rlike(fixed.POSIX_PATH_PATTERN))
        | (windows & visible.rlike(fixed.WINDOWS_PATH_PATTERN))
    )
    return GATES["local_path"](text) & found


def has_private_path(text: Column) -> Column:
    """A path into a private part of the repository, outside web URLs."""
    return GATES["private_path"](text) & without_web_urls(text).rlike(fixed.PRIVATE_PATH_PATTERN)


DETECTORS = {
    "bearer_value": has_bearer,
    "url_query_credential": has_url_query_credential,
    "url_userinfo": has_url_userinfo,
    "basic_credential": has_basic_credential,
    "authorization_header": has_authorization_header,
    "cookie_header": has_cookie_header,
    "local_path": has_local_path,
    "private_path": has_private_path,
}
