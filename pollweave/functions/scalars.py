"""Scalar functions of the poll analyses: sessions, names, titles, addresses, labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pollweave.functions.semantics import col, ustrip

WORD = r"[\p{L}\p{N}_]+"


def parse_session(name: str | Column, suffix: str) -> Column:
    """Leading digits of a sheet name with the region's suffix; the whole name where there are none."""
    n = col(name)
    return F.concat(F.coalesce(F.nullif(F.regexp_extract(n, r"^(\d+)", 1), F.lit("")), n), F.lit(f"_{suffix}"))


def session_number(name: str | Column) -> Column:
    """Leading number of a session name as a sort key; null (sorted last) where there is none."""
    return F.nullif(F.regexp_extract(col(name), r"^(\d+)", 1), F.lit("")).try_cast("bigint")


def session_order(name: str | Column) -> Column:
    """Orders session names by their number, then by the whole name; names without a number come first, null
    names are null."""
    n = col(name)
    return F.when(n.isNotNull(), F.struct(F.coalesce(session_number(n), F.lit(-1)).alias("no"), n.alias("name")))


def session_index(key: str | Column) -> tuple[Column, Column]:
    """``3_jp`` -> (2, 1): index from zero, and the region's code (cn 0, jp 1)."""
    k = col(key)
    return session_number(k) - 1, F.when(k.endswith("_jp"), 1).when(k.endswith("_cn"), 0)


def entity_id(name: str | Column) -> Column:
    """Lower case without anything but letters, digits and underscores."""
    return F.lower(F.regexp_replace(col(name), r"[^\p{L}\p{N}_]+", ""))


def paren_list(name: str | Column) -> Column:
    """Values parted by ``、`` in the first pair of ASCII parentheses; an empty array without one."""
    inner = F.regexp_extract(col(name), r"\(([^)]+)\)", 1)
    return F.filter(F.transform(F.split(inner, "、"), ustrip), lambda x: x != "")


def split_trim(field: str | Column, separator: str = "|", drop_empty: bool = True) -> Column:
    """Array of the trimmed parts of a field; null stays null."""
    parts = F.transform(F.split(col(field), f"[{separator}]"), ustrip)
    return F.filter(parts, lambda x: x != "") if drop_empty else parts


def normalize_title(title: str | Column, aliases: dict[str, str] | None = None) -> Column:
    """A title cut at a wave dash, without bracketed groups, trimmed; aliases are applied last."""
    t = F.regexp_replace(col(title), r"[～~].*$", "")
    t = ustrip(F.regexp_replace(t, r"\([^)]*\)|（[^）]*）", ""))
    if not aliases:
        return t
    m = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    return F.coalesce(F.try_element_at(m, t), t)


def clean_name(name: str | Column, remove: tuple[str, ...] = (), slash: bool = False) -> Column:
    """A name without full-width bracket groups and the given literals, trimmed; ``slash`` drops leading slashes."""
    n = F.regexp_replace(col(name), "（[^）]*）", "")
    n = ustrip(reduce(lambda c, r: F.replace(c, F.lit(r), F.lit("")), remove, n))
    return F.regexp_replace(n, "^/+", "") if slash else n


def quote_path(text: str | Column) -> Column:
    """Percent-encoding of an address path: blanks as %20, slashes kept."""
    return F.replace(F.replace(F.url_encode(col(text)), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))


def html_text(html: str | Column) -> Column:
    """Text of markup: scripts and styles dropped, tags become blanks, blanks collapsed."""
    t = F.regexp_replace(col(html), r"(?is)<(script|style)\b.*?</(script|style)>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(t, "<[^>]*>", " "), r"\s+", " "))


def tokens(text: str | Column, least: int = 1) -> Column:
    """Lower-cased runs of letters, digits and underscores of at least ``least`` characters."""
    return F.regexp_extract_all(F.lower(col(text)), F.lit(WORD if least == 1 else r"[\p{L}\p{N}_]{%d,}" % least), F.lit(0))


def is_single_alnum(c: Column) -> Column:
    return c.rlike("^[A-Za-z0-9]$")


def is_number(c: Column) -> Column:
    return c.rlike("^[0-9]+$")


def percent(part: str | Column, whole: str | Column, digits: int = 2) -> Column:
    """Share in percent, rounded half to even; null for a whole of 0."""
    w = col(whole).cast("double")
    return F.bround(col(part) / F.when(w != 0, w) * 100, digits)


def at_least_one(ratio: str | Column) -> Column:
    """A ratio or its reciprocal, whichever is 1 or more; null for 0."""
    r = col(ratio)
    return F.when(r != 0, F.greatest(r, 1 / F.when(r != 0, r)))


def sign_label(x: str | Column) -> Column:
    x = col(x)
    return F.when(x > 0, "positive").when(x < 0, "negative").when(x == 0, "zero")


def fixed(x: str | Column, digits: int = 2) -> Column:
    return F.format_string(f"%.{digits}f", col(x).cast("double"))


def significance(p: str | Column, level: float = 0.05) -> Column:
    return F.when(col(p) < level, "significant").when(col(p).isNotNull(), "not significant")


def outlier_reason(a: str | Column, b: str | Column, bound: float) -> Column:
    a, b = F.abs(col(a)) > bound, F.abs(col(b)) > bound
    return F.when(a & b, "both").when(a, "first").when(b, "second")
