"""Comparisons of a reply with its source that SQL cannot express: protected values in order, and anchors."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import types as T

from . import fixed as fx
from .rows import by_rows

_ADS, _AD_SIGN = [fx.compiled(p, True) for p in fx.ADS], re.compile(fx.AD_SIGN)


def _values(pattern: str, signs: str, ignore_case: bool) -> re.Pattern[str]:
    """The pattern with a look ahead at the signs that it can start with, behind its look back."""
    back = pattern.index(")") + 1 if pattern.startswith("(?<!") else 0
    return fx.compiled(f"{pattern[:back]}(?=[{signs}]){pattern[back:]}", ignore_case)


_VALUES = [
    (fx.compiled(fx.PROTECTED_NUMBER), False),
    (_values(fx.UNIT, fx.UNIT_SIGNS, True), False),
    (_values(fx.STANDARD_ID, fx.STANDARD_SIGNS, True), False),
    (fx.compiled(fx.URL, True), True),
]
ANCHOR, ANCHORS = 24, 200
URLS, SIGNALS, SHOWN = 1000, 20, 100
_COMPARED = T.StructType().add("changed", T.BooleanType())
for _name in ("anchors", "anchors_shown", "kept", "removed", "grown"):
    _COMPARED = _COMPARED.add(_name, T.DoubleType())
for _name in ("removed_urls", "ad_signals"):
    _COMPARED = _COMPARED.add(_name, T.ArrayType(T.StringType()))


def without_ads(text: str) -> str:
    if not _AD_SIGN.search(text):
        return "\n".join(text.splitlines())
    return "\n".join(line for line in text.splitlines() if not (_AD_SIGN.search(line) and any(p.search(line) for p in _ADS)))


def _nfkc(text: str) -> str:
    return text if text.isascii() else unicodedata.normalize("NFKC", text)


def protected_values(text: str) -> list[str]:
    """Numbers, units, standard ids and links of a text without ad lines, in text order, in normal form."""
    return _values_of(without_ads(text))


def _values_of(body: str) -> list[str]:
    found = []
    for pattern, is_url in _VALUES:
        for m in pattern.finditer(body):
            value = m[0].rstrip(fx.URL_TAIL) if is_url else _nfkc(m[0]).replace(",", "")
            found.append((m.start(), value.lower()))
    return [v for _, v in sorted(found, key=lambda f: f[0])]


def anchor_ratio(given: str, reply: str) -> float:
    """The share of evenly spread strings of ANCHOR characters of the source that the reply holds."""
    return _anchor_ratio(without_ads(given), without_ads(reply))


def _anchor_ratio(given: str, reply: str) -> float:
    if given == reply:
        return 1.0
    source, other = ("".join(_nfkc(t).split()).lower() for t in (given, reply))  # split() knows all white space
    last = len(source) - ANCHOR
    if last < 0 or source == other:
        return float(source == other)
    n = min(ANCHORS, last + 1)
    anchors = dict.fromkeys(source[s : s + ANCHOR] for s in ([0] if n == 1 else (round(i * last / (n - 1)) for i in range(n))))
    held, at = 0, 0
    for a in anchors:  # most lie behind the one before; else the search starts anew
        found = other.find(a, at)
        if found < 0 < at:
            found = other.find(a, 0, at + ANCHOR - 1)
        if found >= 0:
            held, at = held + 1, found
    return held / len(anchors)


@by_rows(T.ArrayType(T.StringType()))
def protected_values_of(text: str | None) -> list[str]:
    return protected_values(text or "")


def urls_missing(text: str, other: str) -> list[str]:
    """The first links of one text that the other lacks, as text.urls_missing_in has them."""
    if text == other or "://" not in text:
        return []
    own, known = (list(dict.fromkeys(_VALUES[3][0].findall(t)))[:URLS] for t in (text, other))
    normal = lambda u: u.rstrip(fx.URL_TAIL).lower()
    known = set(map(normal, known))
    return [u for u in own if normal(u) not in known][:SIGNALS]


def ad_signals(text: str) -> list[str]:
    """Advertising phrases, as text.ad_signals has them."""
    if not _AD_SIGN.search(text):
        return []
    found = (m[0].strip() for p in _ADS for m in p.finditer(text))
    return list(dict.fromkeys(s if len(s) <= SHOWN else s[:SHOWN] + "……" for s in found if s))[:SIGNALS]


def values_differ(given_body: str, body: str, joined: bool = False) -> bool:
    """Whether protected values differ. Blanks inside a standard id count, but for a text that is joined of pieces: a piece may end there.

    Values hold no white space but in standard ids, so joined texts of the same words have the same values.
    """
    if given_body == body or joined and given_body.split() == body.split():
        return False
    own, other = _values_of(given_body), _values_of(body)
    if joined and own != other:
        own, other = ([" ".join(v.split()) for v in values] for values in (own, other))
    return own != other


@by_rows(_COMPARED)
def compared(given: str | None, reply: str | None, compared_reply: str | None, joined: bool = False) -> tuple:
    """What needs both texts without their ad lines, which are found once: whether protected values differ, the anchor

    ratio, the ratios as reports show them (four places), removed links, and the reply's advertising phrases.
    compared_reply is what of the reply is held against the source; null for the whole reply.
    """
    x, y = given or "", reply or ""
    z = y if compared_reply is None else compared_reply
    given_body = without_ads(x)
    body = given_body if z == x else without_ads(z)
    ratio, anchors = (len(y) / len(x) if x else 1.0), _anchor_ratio(given_body, body)
    shown = (round(anchors, 4), round(ratio, 4), round(max(0.0, 1.0 - ratio) if x else 0.0, 4), round(ratio, 4))
    return (values_differ(given_body, body, joined), anchors, *shown, urls_missing(given_body, body), ad_signals(y))
