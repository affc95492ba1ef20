"""Text cleaning, counting and comparison as native column expressions."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 whitespace code points of a Unicode-aware split, and a token, as Java patterns.
SPACE = r"(?U:[\s\x1C-\x1F])"
WORD = r"(?U:[^\s\x1C-\x1F])+"

# Windows-1252 shows these 27 characters where Latin-1 has the control codes 0x80-0x9F.
_CP1252 = [
    (chr(code), shown)
    for code in range(0x80, 0xA0)
    if (shown := bytes([code]).decode("cp1252", errors="ignore"))
]
_C1_CODES = "".join(code for code, _ in _CP1252)
_C1_SHOWN = "".join(shown for _, shown in _CP1252)

# Compatibility ligatures and their letters.
_LIGATURES = {
    "\uFB00": "ff", "\uFB01": "fi", "\uFB02": "fl", "\uFB03": "ffi", "\uFB04": "ffl", "\uFB05": "\u017Ft", "\uFB06": "st",
    "\u0132": "IJ", "\u0133": "ij",
}
_FULLWIDTH = "".join(chr(code) for code in range(0xFF01, 0xFF5F)) + "\u3000"
_HALFWIDTH = "".join(chr(code - 0xFEE0) for code in range(0xFF01, 0xFF5F)) + " "
_SINGLE_QUOTES = "\u02BC\u2018-\u201B"
_DOUBLE_QUOTES = "\u201C-\u201F"
_CONTROLS = "\\x00-\\x08\\x0B\\x0E-\\x1F\\x7F\u206A-\u206F\uFEFF\uFFF9-\uFFFC"
_ENTITY = "&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"
_ENTITY_NAMES = json.dumps({name[:-1]: chars for name, chars in html5.items() if name.endswith(";")})
# UTF-8 read as Windows-1252: a first byte and those that follow it, as characters. Letters before a quotation mark or a dash
# look like that too, so sequences which give letters of other scripts count only where at least two stand together.
_NEXT = f"[\u0080-\u00BF{_C1_SHOWN}]"
_LETTER_NEXT = "[\u0080-\u00BF\u0152\u0153\u0160\u0161\u0178\u017D\u017E\u0192]"
_SURE = f"[\u00C2\u00C3]{_NEXT}|[\u00C4\u00C5]{_LETTER_NEXT}|\u00E2{_NEXT}{{2}}|\u00EF\u00BB\u00BF|\u00F0\u0178{_NEXT}{{2}}"
_ANY = f"[\u00C2-\u00DF]{_NEXT}|[\u00E0-\u00EF]{_NEXT}{{2}}|[\u00F0-\u00F4]{_NEXT}{{3}}"
# Every one of them begins like this, which most places of a text fail at the first character.
_MOJIBAKE = f"(?=[\u00C2-\u00F4]{_NEXT})(?:(?:{_ANY}){{2,}}|{_SURE})"
# Marks that combine with the letter before them, and what they make of a Latin letter: the pairs of Unicode.
_MARKS = "\u0300-\u036F"
_COMPOSED = {
    pair: chr(code)
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00))
    if len(parts := unicodedata.decomposition(chr(code)).split()) == 2
    and unicodedata.combining((pair := "".join(chr(int(x, 16)) for x in parts if "<" not in x))[-1])
}
_COMPOSED_NAMES = json.dumps(_COMPOSED)
_LETTER = f"[A-Za-z\u00C0-\u024F\u1E00-\u1EFF{''.join(sorted({pair[0] for pair in _COMPOSED if pair[0] > chr(0x24F)}))}]"
_LETTER_AND_MARKS = f"{_LETTER}[{_MARKS}]+"
# Whether there is one is told faster from the mark than from the letter.
_MARKED = f"[{_MARKS}](?<={_LETTER}[{_MARKS}])"
# Two scans decide whether a text needs any repair: a cheap one for a single class of few ranges, which
# nearly all texts end at, and the exact one. The class holds a part of everything that can be repaired.
_MAY_NEED_REPAIR = "[&\\x00-\\x1F\\x7F-\\xBF\u0132-\uFFFF]"
_NEEDS_REPAIR = (
    f"(?=[&\\x00-\\x1F\\x7F-\uFFFF])(?:{_ENTITY}|{_MOJIBAKE}|{_MARKED}|[{_CONTROLS}\r\u0080-\u009F\u2028\u2029"
    f"{_SINGLE_QUOTES}{_DOUBLE_QUOTES}{''.join(_LIGATURES)}\uFF01-\uFF5E\u3000])"
)


def _code_point(number: Column) -> Column:
    """Code point number to its character; surrogates and numbers out of range give null."""
    valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    utf32 = F.unhex(F.lpad(F.hex(F.when(valid, number)), 8, "0"))
    return F.decode(utf32, "UTF-32")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unescape_entities(text: Column) -> Column:
    """Resolve HTML character references once, left to right; unknown ones stay as they are."""
    names = F.from_json(F.lit(_ENTITY_NAMES), "map<string, string>")

    def resolve(entity: Column) -> Column:
        body = F.substring(entity, 2, F.length(entity) - 2)
        # Leading zeros say nothing; more than seven digits without them are out of range.
        digits = F.regexp_replace(body, "^#[xX]?0*(?=.)", "")
        digits = F.when(F.length(digits) <= 7, digits)
        return F.coalesce(
            F.when(body.rlike("^#[xX]"), _code_point(F.conv(digits, 16, 10).cast("bigint")))
            .when(body.startswith("#"), _code_point(digits.cast("bigint")))
            .otherwise(F.try_element_at(names, body)),
            entity,
        )

    return _rewoven(text, _ENTITY, resolve)


def _rewoven(text: Column, pattern: str, resolve: Callable[[Column], Column]) -> Column:
    """The text with each match of the pattern as `resolve` has it."""
    plain = F.split(text, pattern)
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), 0), resolve)
    woven = F.zip_with(plain, found, lambda p, m: F.concat(p, F.coalesce(m, F.lit(""))))
    return F.array_join(woven, "")


def _undo_mojibake(text: Column) -> Column:
    """Re-reads as UTF-8 each run of characters that such bytes show as in Windows-1252, if they are valid there; what
    stands around a run stays as it is."""

    def reread(run: Column) -> Column:
        raw = F.encode(F.translate(run, _C1_SHOWN, _C1_CODES), "ISO-8859-1")
        return F.coalesce(F.try_validate_utf8(raw.cast("string")), run)

    return F.when(text.rlike(_MOJIBAKE), _rewoven(text, _MOJIBAKE, reread)).otherwise(text)


def compose_letters(text: Column) -> Column:
    """Latin letters with combining marks after them as one character where there is one; other marks stay in their order."""
    pairs = F.from_json(F.lit(_COMPOSED_NAMES), "map<string, string>")

    def composed(found: Column) -> Column:
        marks = F.transform(F.sequence(F.lit(2), F.length(found)), lambda i: F.substring(found, i, F.lit(1)))
        start = F.struct(F.substring(found, 1, 1).alias("letter"), F.lit("").alias("rest"))
        step = lambda a, m: let(
            F.try_element_at(pairs, F.concat(a["letter"], m)),
            lambda c: F.when(c.isNull(), F.struct(a["letter"].alias("letter"), F.concat(a["rest"], m).alias("rest"))).otherwise(
                F.struct(c.alias("letter"), a["rest"].alias("rest"))
            ),
        )
        return F.aggregate(marks, start, step, lambda a: F.concat(a["letter"], a["rest"]))

    return F.when(text.rlike(_MARKED), _rewoven(text, _LETTER_AND_MARKS, composed)).otherwise(text)


def _where(text: Column, pattern: str, body: Callable[[Column], Column]) -> Column:
    """`body` of a text in which the pattern is found, which is what the body is about; other texts as they are."""
    return let(text, lambda t: F.when(t.rlike(pattern), body(t)).otherwise(t))


def _without_ligatures(text: Column) -> Column:
    for ligature, letters in _LIGATURES.items():
        text = F.replace(text, F.lit(ligature), F.lit(letters))
    return text


def _repaired(text: Column) -> Column:
    # A text with markup keeps its entities: they are part of the markup.
    text = let(text, lambda t: F.when(t.contains("<") | ~t.contains("&"), t).otherwise(unescape_entities(t)))
    text = _where(let(text, _undo_mojibake), "[\u0080-\u009F]", lambda t: F.translate(t, _C1_CODES, _C1_SHOWN))
    text = let(text, compose_letters)
    text = _where(text, f"[{''.join(_LIGATURES)}]", _without_ligatures)
    text = _where(text, "[\uFF01-\uFF5E\u3000]", lambda t: F.translate(t, _FULLWIDTH, _HALFWIDTH))
    text = _where(text, f"[{_SINGLE_QUOTES}{_DOUBLE_QUOTES}]", lambda t: F.regexp_replace(F.regexp_replace(t, f"[{_SINGLE_QUOTES}]", "'"), f"[{_DOUBLE_QUOTES}]", '"'))
    text = _where(text, "[\r\u0085\u2028\u2029]", lambda t: F.regexp_replace(t, "\r\n|[\r\u0085\u2028\u2029]", "\n"))
    text = let(text, lambda t: F.when(t.contains("\x1B"), F.regexp_replace(t, r"\x1B\[[0-9;]*[a-zA-Z]", "")).otherwise(t))
    return _where(text, f"[{_CONTROLS}]", lambda t: F.regexp_replace(t, f"[{_CONTROLS}]", ""))


def repair_text(text: Column) -> Column:
    """Entities, mojibake, combining marks, ligatures, fullwidth forms, curly quotes, line breaks, control codes.

    Texts that need nothing pass after a scan, and every step is a native expression.
    """
    needed = text.rlike(_MAY_NEED_REPAIR) & text.rlike(_NEEDS_REPAIR)
    return F.when(needed, let(text, _repaired)).otherwise(text)


def clean_text(text: Column, repair: bool = True) -> Column:
    """Repair, collapse whitespace runs to one space, trim. Texts that are clean already pass after one scan."""
    repaired = repair_text(text) if repair else text
    cleaned = F.trim(F.regexp_replace(repaired, SPACE + "+", " "))
    # Besides the plain space, all whitespace is among the characters that may need repair.
    spaced = text.startswith(" ") | text.endswith(" ") | text.contains("  ")
    return F.when(spaced | text.rlike(_MAY_NEED_REPAIR), cleaned).otherwise(text)


def token_count(text: Column) -> Column:
    """Number of maximal runs of non-whitespace; null counts as 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0))


def clean_token_count(text: Column) -> Column:
    """`token_count` for cleaned text, whose only whitespace is one space between tokens."""
    spaces = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))
    return F.when(text == "", 0).otherwise(spaces + 1)


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), 0)


def length_ratio(numerator: Column, denominator: Column) -> Column:
    return numerator / F.greatest(denominator, F.lit(1))


def word_set(text: Column) -> Column:
    return F.array_distinct(words(F.lower(text)))


def word_overlap(left: Column, right: Column) -> Column:
    """Share of the left side's lower-cased word set that also occurs on the right."""
    own = word_set(left)
    return F.size(F.array_intersect(own, words(F.lower(right)))) / F.greatest(F.size(own), F.lit(1))


def length_bucket(tokens: Column, bounds: tuple[int, int] = (15, 30), names=("short_sents", "mid_sents", "long_sents")) -> Column:
    low, high = bounds
    return F.when(tokens <= low, names[0]).when(tokens > high, names[2]).otherwise(names[1])


def tokenize_13a(text: Column) -> Column:
    """Tokens as the standard corpus BLEU counts them."""
    text = F.replace(text, F.lit("<skipped>"), F.lit(""))
    text = F.replace(F.replace(text, F.lit("-\n"), F.lit("")), F.lit("\n"), F.lit(" "))
    # The four entities BLEU unescapes, in this order.
    for entity, char in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    text = F.concat(F.lit(" "), text, F.lit(" "))
    # The spacing patterns published with the 13a tokeniser, but for the blank in the first, which sets blanks
    # around each blank and so changes no token.
    for pattern, spaced in (
        (r"([\{-\~\[-\`\!-\&\(-\+\:-\@\/])", " $1 "),
        (r"([^0-9])([\.,])", "$1 $2 "),
        (r"([\.,])([^0-9])", " $1 $2"),
        (r"([0-9])(-)", "$1 $2 "),
    ):
        text = F.regexp_replace(text, pattern, spaced)
    return words(text)


def ngrams(tokens: Column, n: int) -> Column:
    """All n-grams of a token array, joined by a space, in order, with repeats."""
    if n == 1:
        return tokens
    grams = F.transform(
        F.sequence(F.lit(1), F.size(tokens) - (n - 1)),
        lambda start: F.array_join(F.slice(tokens, start, n), " "),
    )
    return F.when(F.size(tokens) >= n, grams).otherwise(F.array().cast("array<string>"))
