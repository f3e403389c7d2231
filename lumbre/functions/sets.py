"""List and set cells: arrays kept sorted and free of repeats stand for sets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_TEXTS = "array<string>"


def to_set(items: Column) -> Column:
    """Sorted, distinct, without NULL members; a missing list is an empty set."""
    # one set operation and a plain sort: both are compiled with the rest of the row's work, which lambdas are not
    cleaned = F.sort_array(F.array_except(items, F.array(F.lit(None))))
    return F.coalesce(cleaned, F.array().cast(_TEXTS))


# Tokens of a literal, as Java patterns. Quantifiers give nothing back, so long texts need no deep stack.
def _between(q: str) -> str:
    """A text between three or one of a quote."""
    long = rf"{q}{q}{q}[^{q}\\]*+(?:(?:\\[\s\S]|{q}(?!{q}{q}))[^{q}\\]*+)*+{q}{q}{q}"
    return rf"{long}|{q}(?!{q}{q})[^{q}\\\n]*+(?:\\[\s\S][^{q}\\\n]*+)*+{q}"


_QUOTED = rf"""(?:[uUrR]?(?:{_between("'")}|{_between('"')}))"""
_SPACE = r"[ \t\n\r\f]"
#: Neighbouring texts are one member, so a run of them is one token.
_MEMBER = rf"{_QUOTED}(?:{_SPACE}*+{_QUOTED})*+|(?:None|null)(?![0-9A-Za-z_])|True(?![0-9A-Za-z_])|False(?![0-9A-Za-z_])|-?(?:0|[1-9][0-9]*+)(?![0-9A-Za-z_.])"
_TOKEN = rf"{_MEMBER}|[\[\](){{}},]"
_ESCAPE = r"""\\(?:x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}|[0-7]{1,3}|[\s\S])|[^\\]++"""
#: Escapes of one character and what they stand for.
_NAMED = {"\n": "", "\\": "\\", "'": "'", '"': '"', "a": "\a", "b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v"}


_MISSING = ("None", "null")
#: Most lists hold plain texts only, whose members are what is between their quotes, found in a small part of the time. The
#: length keeps the pattern's stack small; longer lists of plain texts have the same members by tokens.
_ONE_PLAIN = r"""(?:'[^'"\\\x00-\x1F]*'|"[^'"\\\x00-\x1F]*")"""
_BETWEEN_QUOTES = r"""['"]([^'"]*+)['"]"""
_PLAIN, _PLAIN_LENGTH = rf"^\[(?:{_ONE_PLAIN}(?:, ?{_ONE_PLAIN})*)?\]$", 2000


def _code_point(hex_digits: Column) -> Column:
    return F.decode(F.unhex(F.lpad(hex_digits, 8, "0")), "UTF-32")


def _unescaped(piece: Column) -> Column:
    """A stretch between backslashes as it is, or what an escape stands for; unknown escapes stay."""
    kind = F.substring(piece, 2, 1)
    octal = F.conv(F.substring(piece, F.lit(2), F.length(piece)), 8, 16)
    out = F.when(~piece.startswith("\\"), piece)
    for name, value in _NAMED.items():
        out = out.when(kind == name, F.lit(value))
    hex_digits = F.when(kind.isin("x", "u", "U") & (F.length(piece) > 2), F.substring(piece, F.lit(3), F.length(piece)))
    return out.when(hex_digits.isNotNull(), _code_point(hex_digits)).when(kind.between("0", "7"), _code_point(octal)).otherwise(piece)


def _text_of(quoted: Column) -> Column:
    """The text that one quoted token stands for; NULL if an escape in it is broken."""
    prefix = F.when(F.left(quoted, F.lit(1)).isin("u", "U", "r", "R"), 1).otherwise(0)
    bare = F.substring(quoted, prefix + 1, F.length(quoted))
    mark = F.when(F.left(bare, F.lit(3)).isin("'" * 3, '"' * 3) & (F.length(bare) >= 6), 3).otherwise(1)
    body = F.substring(bare, mark + 1, F.length(bare) - 2 * mark)
    raw = F.left(quoted, F.lit(1)).isin("r", "R") | ~F.contains(body, F.lit("\\"))
    pieces = F.regexp_extract_all(body, F.lit(_ESCAPE), F.lit(0))
    broken = body.rlike(r"(?<!\\)(?:\\\\)*+\\(?:x(?![0-9a-fA-F]{2})|u(?![0-9a-fA-F]{4})|U(?!00(?:0[0-9a-fA-F]|10)[0-9a-fA-F]{4})|N)")
    return F.when(raw, body).when(~broken, F.array_join(F.transform(pieces, _unescaped), ""))


def _member(token: Column) -> Column:
    texts = F.transform(F.regexp_extract_all(token, F.lit(_QUOTED), F.lit(0)), _text_of)
    whole = F.when(F.forall(texts, lambda t: t.isNotNull()), F.array_join(texts, ""))
    return F.when(token.rlike("^(?:True|False|-?[0-9]+)$"), token).when(~token.isin(*_MISSING), whole)


def parse_list_literal(text: Column) -> Column:
    """Array from the literal of a list, a tuple or a set, as Python reads it; else NULL.

    Texts with any quotes, prefixes (u, r) and escapes, neighbouring texts as one, None and JSON's null (a NULL member), True, False and
    whole numbers (their text) are members; commas may trail. Whatever else there is (nested literals, other numbers,
    names, bytes, comments, escapes by character name, brackets around the literal) makes the whole NULL. The text is cut into tokens once; then
    neighbouring tokens must fit together, and each member is decoded by itself.
    """
    trimmed = F.regexp_replace(text, rf"^{_SPACE}++|{_SPACE}++$", "")
    parsed = _once(trimmed, lambda t: _once(F.regexp_extract_all(t, F.lit(_TOKEN), F.lit(0)), lambda tokens: _members(t, tokens)))
    plain = F.regexp_extract_all(text, F.lit(_BETWEEN_QUOTES), F.lit(1))
    others = F.when(trimmed == "set()", F.array().cast(_TEXTS)).when(F.left(trimmed, F.lit(1)).isin("[", "(", "{"), parsed)
    return F.when((F.length(text) <= _PLAIN_LENGTH) & text.rlike(_PLAIN), plain).otherwise(others)


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def _members(text: Column, tokens: Column) -> Column:
    """The members among the tokens of a text, if these are all there is in it and fit together."""
    punctuation = ("[", "(", "{", "]", ")", "}", ",")
    n = F.size(tokens)
    ends = F.concat(F.get(tokens, F.lit(0)), F.element_at(tokens, -1))
    whole = ends.isin("[]", "()") | (ends == "{}") & (n > 2)
    lone = (ends == "()") & (n == 3)  # a text in brackets is a text
    inner = F.slice(tokens, 2, n - 2)
    # between the brackets members and commas take turns, members first
    fit = F.forall(F.transform(inner, lambda t, k: (k % 2 == 0) != t.isin(*punctuation)), lambda ok: ok)
    commas = F.forall(inner, lambda t: (t == ",") | ~t.isin(*punctuation))
    length = F.length(F.regexp_replace(text, _SPACE, "")) == F.aggregate(
        tokens, F.lit(0), lambda sum_, t: sum_ + F.length(F.regexp_replace(t, _SPACE, ""))
    )
    members = F.transform(F.filter(inner, lambda t: t != ","), lambda t: F.struct(t.isin(*_MISSING).alias("none"), _member(t).alias("m")))
    good = (n >= 2) & whole & ~lone & length
    checked = F.when(good & fit & commas, _once(members, _known))
    return F.when(n >= 2, checked)


def _known(members: Column) -> Column:
    return F.when(F.forall(members, lambda m: m["none"] | m["m"].isNotNull()), F.transform(members, lambda m: m["m"]))


def normalize_to_set(text: Column) -> Column:
    """Set from text: a list literal's members, other text as its only member, NULL as empty.

    Text that is not a *list* literal (a set literal included) is one member as it stands.
    """
    as_list = F.when(F.trim(text).startswith("["), parse_list_literal(text))
    return F.when(text.isNull(), F.array().cast(_TEXTS)).otherwise(to_set(F.coalesce(as_list, F.array(text))))


def size_or_zero(items: Column) -> Column:
    return F.coalesce(F.size(items), F.lit(0))


def literal(items: Column) -> Column:
    """JSON text of an array, for text-only formats; ``parse_list_literal`` reads it back."""
    return F.to_json(items)
