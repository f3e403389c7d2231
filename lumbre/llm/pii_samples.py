"""Labelled samples for the boosted trees: made-up personal data and look-alikes in surroundings from the corpus.

Formats follow public rules (numbering plans, check digits, address notation); values are random. A made-up string is
put between two pieces of corpus text, half of the time after a cue. Candidates that are it are positive; candidates
in a look-alike, and those that only cut into a made-up string, are negative.
"""

from __future__ import annotations

import random

from lumbre.llm.pii_candidates import CARD, EMAIL, IP, PHONE, Span, base_spans, candidates, luhn

#: Cues that stand before personal data and before look-alikes, as fixed text.
CUES = {
    EMAIL: ("email: ", "mail to ", "contact ", "write to "),
    IP: ("host ", "server ", "from ", "ip address "),
    CARD: ("card number ", "visa ", "pay with ", "credit card: "),
    PHONE: ("tel. ", "phone: ", "call ", "fax ", "mobile "),
}
LOOKALIKE_CUES = ("version ", "order ", "isbn ", "ref ", "invoice no ", "page ", "build ", "price ", "serial ", "section ")


def _digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _word(rng: random.Random, least: int = 3, most: int = 10) -> str:
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(least, most)))


def _checked(rng: random.Random, n: int, right: bool = True) -> str:
    body = rng.choice("345634563456123789") + _digits(rng, n - 2)
    good = [d for d in "0123456789" if luhn(body + d)][0]
    return body + (good if right else str((int(good) + rng.randint(1, 9)) % 10))


def _email(rng: random.Random) -> str:
    name = _word(rng) + rng.choice(["", ".", "_", "-"]) + rng.choice([_word(rng), _digits(rng, 2)])
    host, end = _word(rng), rng.choice(["com", "org", "net", "de", "fr", "co.uk", "example.com"])
    at, dot = rng.choice(
        [("@", "."), (" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", "."), ("(at)", "."), (" @ ", "."), (" AT ", " DOT "), ("{at}", "{dot}")]
    )
    return name + at + host + dot + end.replace(".", dot)


def _ip(rng: random.Random) -> str:
    if rng.random() < 0.3:
        return ".".join(str(rng.randint(1, 255)) for _ in range(4))
    parts = [f"{rng.randint(0, 65535):x}" for _ in range(8)]
    if rng.random() < 0.5:
        first = rng.randint(1, 4)
        return ":".join(parts[:first]) + "::" + ":".join(parts[rng.randint(first + 2, 7) :])
    return ":".join(parts)


def _card(rng: random.Random) -> str:
    if rng.random() < 0.15:
        d = _checked(rng, 15)
        return rng.choice(["-", " ", ".", "  "]).join([d[:4], d[4:10], d[10:]])
    d = _checked(rng, 16)
    if rng.random() < 0.4:
        return d
    return rng.choice(["-", " ", ".", " - ", "/"]).join(d[k : k + 4] for k in range(0, 16, 4))


def _phone(rng: random.Random) -> str:
    a, b, c = f"{rng.randint(200, 989)}", f"{rng.randint(200, 999)}", _digits(rng, 4)
    sep = rng.choice(["-", " ", ".", "–"])
    return rng.choice(
        [
            f"({a}) {b}-{c}", f"{a}{sep}{b}{sep}{c}", f"({a}){b}-{c}", f"1-{a}-{b}-{c}", f"0{_digits(rng, 3)} {_digits(rng, 6)}",
            f"0{_digits(rng, 2)}{sep}{_digits(rng, 8)}", f"00{rng.randint(30, 49)} {_digits(rng, 3)} {_digits(rng, 7)}",
            f"0{rng.randint(1, 9)} {_digits(rng, 2)} {_digits(rng, 2)} {_digits(rng, 2)} {_digits(rng, 2)}",
            f"+{rng.randint(1, 99)} {a} {b} {c}", f"+{rng.randint(1, 99)} ({a}) {b}-{c}", f"+1 ({a}) {b}-{c}", f"+1 ({a}) {b}-{c}", f"+{rng.randint(20, 99)} {_digits(rng, 3)} {_digits(rng, 7)}", f"0{rng.randint(100, 999)}/{_digits(rng, 7)}", f"({_digits(rng, 2)}) {_digits(rng, 4)}-{_digits(rng, 4)}",
        ]
    )


MAKERS = {EMAIL: _email, IP: _ip, CARD: _card, PHONE: _phone}


def _lookalike(rng: random.Random) -> str:
    year, month, day = rng.randint(1900, 2099), rng.randint(1, 12), rng.randint(1, 28)
    clock = f"{rng.randint(0, 23):02}:{rng.randint(0, 59):02}:{rng.randint(0, 59):02}"
    return rng.choice(
        [
            f"{year}-{month:02}-{day:02}", f"{day:02}.{month:02}.{year}", f"{month}/{day}/{year}", f"{year}-{year + 5}", f"{year}{month:02}{day:02}",
            f"{year}-{month:02}-{day:02} {clock}", f"{year}{month:02}{day:02}{_digits(rng, 6)}", clock, f"{rng.randint(1, 9)}.{_digits(rng, 9)}",
            f"{rng.randint(1, 999)} {rng.randint(100, 999)} {rng.randint(100, 999)}", f"978-{_digits(rng, 1)}-{_digits(rng, 4)}-{_digits(rng, 4)}-{_digits(rng, 1)}",
            f"{_digits(rng, 3)}.{_digits(rng, 4)} {_digits(rng, 2)}.{_digits(rng, 5)}", _checked(rng, 16, right=False), f"{_word(rng)} at {_word(rng)} dot {_digits(rng, 2)}",
            f"{_word(rng)} at {_word(rng)}.{_word(rng)}", f"{_word(rng)}::{_word(rng)}", f"{rng.randint(1, 12)}:{rng.randint(10, 59)}::{rng.randint(1, 9)}",
            " ".join(str(rng.randint(0, 99)) for _ in range(rng.randint(4, 9))), " ".join(_digits(rng, rng.randint(3, 7)) for _ in range(rng.randint(2, 5))),
            f"{_word(rng)}{_digits(rng, rng.randint(7, 16))}", f"{_digits(rng, rng.randint(10, 15))}{_word(rng)}", f"{_digits(rng, 7)}_{_digits(rng, 8)}",
            f"{_digits(rng, rng.choice([8, 9, 10, 11, 12]))}", f"#{_digits(rng, 10)}", f"{_digits(rng, 5)}-{_digits(rng, 4)}", f"{_digits(rng, 12)}.{_digits(rng, 2)}",
            f"0x{_digits(rng, 12)}", f"{rng.randint(1, 9)}-{rng.randint(10, 99)}-{rng.randint(100, 999)}-{rng.randint(1000, 9999)}",
        ]
    )


def rendered(pieces: list[str], n: int, seed: int) -> list[tuple[str, Span, int]]:
    """About ``n`` made-up strings in their surroundings: (text, candidate, 1 if it is personal data)."""
    rng, out = random.Random(seed), []
    pieces = pieces or ["nothing is known of this corpus yet, "]
    for k in range(n):
        kind = k % 8
        own = MAKERS[kind](rng) if kind in MAKERS else _lookalike(rng)
        before, after = rng.choice(pieces), rng.choice(pieces)
        cue = rng.choice(CUES[kind] if kind in CUES else LOOKALIKE_CUES) if rng.random() < 0.4 else ""
        if kind not in MAKERS and rng.random() < 0.15:
            cue = rng.choice(CUES[rng.choice(list(CUES))])
        before = before + rng.choice([" ", " ", "\n", ", ", " (", ": "]) + cue
        if rng.random() < 0.3:
            after = rng.choice(list(MAKERS.values()))(rng) + " " + after
        text = before + own + rng.choice([" ", ". ", ", ", ")", "\n", ""]) + (" " + after if rng.random() < 0.9 else "")
        first, last = len(before), len(before) + len(own)
        for span in candidates(text):
            if span.end > first and span.start < last:
                out.append((text, span, int(kind == span.kind and (span.start, span.end) == (first, last))))
    return out


def ordinary(pieces: list[str]) -> list[tuple[str, Span, int]]:
    """Candidates of the corpus that touch a letter, a digit or an underscore: parts of longer names, so negative."""
    out = []
    for text in pieces:
        base = set(base_spans(text))
        for span in candidates(text):
            touch = text[max(0, span.start - 1) : span.start] + text[span.end : span.end + 1]
            if span not in base and any(c.isalnum() or c == "_" for c in touch):
                out.append((text, span, 0))
    return out
