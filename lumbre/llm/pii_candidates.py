"""Candidates for personal data in a text, from patterns that would rather find too much, and their features.

Base spans follow fixed rules and are found in time linear in the text: patterns whose plain form would be tried from
every character of a long run are anchored at the one character they need, or read off from whole runs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

#: Kinds in the order in which spans that begin together are listed.
KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)


class Span(NamedTuple):
    start: int
    kind: int
    end: int
    base: bool


_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9.-]*")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_DIGITS = re.compile(r"[0-9][0-9 -]*[0-9]")
_TWICE = re.compile(r"[ -]{2,}")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    """Whether the check digit at the end is right."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) << (k & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _base_email(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        region = _DOMAIN.match(text, at + 1).group()
        domain = "" if region.startswith(".") else region.split("..", 1)[0].rstrip(".")
        if "." in domain:
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                done = at + 1 + len(domain)
                yield Span(start, EMAIL, done, True)
        at = text.find("@", max(at + 1, done))


def _base_ip(text: str) -> Iterator[Span]:
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x[-4:]) <= 255 for x in m.group().split(".")):
            yield Span(m.start(), IP, m.end(), True)


def _base_card(text: str) -> Iterator[Span]:
    for m in _DIGITS.finditer(text):
        run, at = m.group(), 0
        for cut in [*_TWICE.finditer(run), None]:
            piece = run[at : cut.start()] if cut else run[at:]
            digits = _only_digits(piece)
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield Span(m.start() + at, CARD, m.start() + at + len(piece), True)
            at = cut.end() if cut else at


def _base_phone(text: str) -> Iterator[Span]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_only_digits(m.group())) <= 15:
            yield Span(m.start(), PHONE, m.end(), True)


def base_spans(text: str) -> list[Span]:
    """Spans by the fixed rules, by start, then kind."""
    return sorted([*_base_email(text), *_base_ip(text), *_base_card(text), *_base_phone(text)])


# ---------------------------------------------------------------- wider candidates

#: A mailbox name has at most 64 characters, so a spelled-out one is looked for in as many before its "at".
_AT = re.compile(r"\s?[\[({<]\s?(?i:at)\s?[\])}>]\s?|\s(?:at|AT)\s|\s?@\s?|\s?＠\s?")
_NAME = re.compile(r"[A-Za-z0-9._%+-]{1,64}\Z")
_SPELLED = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\s?[\[({<]\s?(?i:dot)\s?[\])}>]\s?|\s(?:dot|DOT)\s|\.)[A-Za-z0-9-]{1,63}){1,8}")
_SIX = re.compile(r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Fa-f:])")
_NUMBERS = re.compile(r"\(?[0-9][0-9 (). ‐-―/-]*[0-9]")
_GROUP = re.compile(r"[0-9]+")
_JOINT = re.compile(r"[ (). ‐-―/-]{1,3}\Z")


def _wide_email(text: str) -> Iterator[Span]:
    for m in _AT.finditer(text):
        after = _SPELLED.match(text, m.end())
        plain = m.group().strip() in ("at", "AT")
        if not after or plain and not re.search(r"\sdot\s|[\[({<]\s?dot", after.group(), re.I):
            continue
        before = _NAME.search(text[max(0, m.start() - 64) : m.start()])
        if before:
            yield Span(m.start() - len(before.group()), EMAIL, after.end(), False)


def _wide_ip(text: str) -> Iterator[Span]:
    for m in _SIX.finditer(text):
        parts = m.group().split(":")
        if "::" in m.group() and m.group().count("::") == 1 or len(parts) == 8:
            if sum(map(len, parts)) >= 2:
                yield Span(m.start(), IP, m.end(), False)


def _wide_numbers(text: str) -> Iterator[Span]:
    """Neighbouring groups of digits that could be a card or a phone number, overlapping."""
    for m in _NUMBERS.finditer(text):
        if m.end() - m.start() < 7:
            continue
        groups = [(g.start(), g.end()) for g in _GROUP.finditer(text, m.start(), m.end())]
        for i, (start, end) in enumerate(groups):
            digits = ""
            for j in range(i, min(i + 6, len(groups))):
                if j > i and not _JOINT.match(text[groups[j - 1][1] : groups[j][0]]):
                    break
                end = groups[j][1]
                digits += text[groups[j][0] : end]
                if len(digits) > 19:
                    break
                if 12 <= len(digits) and luhn(digits):
                    yield Span(start, CARD, end, False)
                if 7 <= len(digits) <= 15 and (j > i or digits[0] == "0" or len(digits) in (10, 11)):
                    led = int(start > 0 and text[start - 1] in "(+")
                    opened = text[start - led : end].count("(")
                    if opened == text[start:end].count(")"):
                        yield Span(start - led, PHONE, end, False)


def candidates(text: str) -> list[Span]:
    """Base spans, and those of the wider patterns that share no character with a base span."""
    base = base_spans(text)
    taken = []
    for s in sorted(base):
        if taken and s.start <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], s.end)
        else:
            taken.append([s.start, s.end])
    wide = sorted({*_wide_email(text), *_wide_ip(text), *_wide_numbers(text)})
    out, k = list(base), 0
    for s in wide:
        while k < len(taken) and taken[k][1] <= s.start:
            k += 1
        if k == len(taken) or s.end <= taken[k][0]:
            out.append(s)
    return sorted(out)


# ---------------------------------------------------------------- features

_CUES = (
    re.compile(r"mail|contact|write|correo|courriel|schreib|address"),
    re.compile(r"\bip\b|host|server|addr|login|client|from\b"),
    re.compile(r"card|visa|master|amex|kredit|carte|tarjeta|pay|iban|account"),
    re.compile(r"tel|phone|call|fax|mobil|cell|handy|whatsapp|sms|ruf|llam"),
)
_AGAINST = re.compile(
    r"version|\bv\b|release|isbn|issn|order|invoice|ticket|serial|part|page|section|chapter|date|year|price|total|ref|\bid\b|\bno\b|#|size|build|rfc"
)
_CLASSES = {c: 1 for c in "\n\t "} | {c: 3 for c in ".,;:!?\"')]}>"} | {c: 4 for c in "/=#_&*%$@+-\\|<([{"}
WINDOW = 40


def _side(char: str) -> int:
    if not char:
        return 0
    return _CLASSES.get(char) or (2 if char.isdigit() else 5 if char.isalpha() else 4)


def features(text: str, span: Span) -> list[float]:
    """Format of a candidate and its surroundings."""
    own = text[span.start : span.end]
    before, after = text[max(0, span.start - WINDOW) : span.start].lower(), text[span.end : span.end + WINDOW].lower()
    groups = _GROUP.findall(own)
    digits = "".join(groups)
    sizes = [len(g) for g in groups] or [0]
    marks = [c for c in own if not c.isalnum()]
    tail = re.split(r"[^A-Za-z]+", own)[-1]
    return [
        len(own), len(digits), len(own) - len(digits) - len(marks), len(marks), len(set(marks)), len(groups),
        sizes[0], sizes[-1], max(sizes), min(sizes), len(set(digits)),
        float(bool(digits) and luhn(digits)), int(digits[:1] or 0), float(digits.startswith("00")), float(own[:1] == "("),
        float(own[:1] == "+"), float(bool(re.match(r"(?:19|20)\d\d(?!\d)", digits[:4])) and sizes[0] == 4),
        float(any(c in own for c in "/")), float("." in own), float("-" in own), float(" " in own),
        max((int(g) for g in groups if len(g) < 5), default=0), float(any(len(g) > 1 and g[0] == "0" for g in groups)),
        own.count(":"), len(tail), float(bool(re.search(r"(?i)[\[({<]\s?(?:at|dot)\b", own))),
        _side(text[span.start - 1 : span.start]), _side(text[span.end : span.end + 1]),
        _side(text[span.start - 2 : span.start - 1] if span.start > 1 else ""), _side(text[span.end + 1 : span.end + 2]),
        float(bool(_CUES[span.kind].search(before))), float(bool(_CUES[span.kind].search(after[:20]))),
        float(bool(_AGAINST.search(before))), float(bool(_AGAINST.search(after[:20]))),
        sum(c.isdigit() for c in before), sum(c.isdigit() for c in after),
    ]


def matrix(text: str, spans: list[Span]) -> np.ndarray:
    return np.array([features(text, s) for s in spans], np.float64)
