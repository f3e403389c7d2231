"""Words as the operators count them, the plain way."""

import re

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def tokens(text):
    return _WORD.findall((text or "").translate(_LOWER))
