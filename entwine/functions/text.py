"""Text functions of the engine as Column expressions: normalisers, extractors, keys. Nulls count as empty strings.

Only transliteration and exact accent stripping run in Python (Arrow batches), and transliteration only where a text has
Indic characters; everything else stays in code generation.
"""

from __future__ import annotations

import functools
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words and rules that results depend on, in the order in which they apply.
PREFIX = r"(?i)^(?:(?:m/s|ms|smt|shri|mr|mrs|dr)\.?|<<|>>|--|\*\*\*|#+)\s*"
#: As PREFIX in RE2: \v is no blank, and U+017F is an s where case does not count.
PREFIX_ASCII = r"(?i)^(?:(?:m/[sſ]|m[sſ]|[sſ]mt|[sſ]hri|mr|mr[sſ]|dr)\.?|<<|>>|--|\*\*\*|#+)[\t\n\f\r ]*"
LEGAL = [
    "private limited", "pvt ltd", "pvt limited", "private ltd", "p limited", "limited liability company", "limited liability partnership",
    "societe anonyme", "societe a responsabilite limitee", "incorporated", "corporation", "proprietorship", "enterprise", "enterprises",
    "associates", "technologies", "solutions", "consultants", "private", "public", "limited", "company", "s.a.r.l.", "sarl", "s.a.s.u.",
    "sasu", "s.a.s.", "sas", "eurl", "sci", "s.a.", "sa", "l.l.c.", "llc", "l.l.p.", "llp", "ltd", "inc", "corp", "p.c.", "pc", "co", "plc",
    "gmbh", "प्राइवेट लिमिटेड", "प्रा. लि.", "लिमिटेड", "प्रा लि", "ప్రైవేట్ లిమిటెడ్", "లిమిటెడ్", "பிரைவேட் லிமிடெட்", "லிமிடெட்", "પ્રાઇવેટ લિમિટેડ", "લિમિટેડ",
    "প্রাইভেট লিমিটেড", "লিমিটেড", "ପ୍ରାଇଭେଟ୍ ଲିମିଟେଡ୍", "ଲିମିଟେଡ୍", "praivet limited", "praiveta limiteda", "praaiveta limiteda", "praaivet limited",
    "praaiveta", "praivet", "limiteda",
]
ABBREVIATIONS = [
    ("st", "street"), ("rd", "road"), ("ave|av", "avenue"), ("blvd|bd", "boulevard"), ("dr", "drive"), ("ct", "court"), ("ln", "lane"),
    ("pkwy", "parkway"), ("hwy", "highway"), ("fl|flr", "floor"), ("ste", "suite"), ("apt", "apartment"), ("r", "rue"), ("all", "allee"),
    ("no", "number"), ("nr", "near"), ("opp", "opposite"), ("sec", "sector"), ("ind", "industrial"), ("est", "estate"), ("dist", "district"),
]
ADDRESS_STOPWORDS = [
    "street", "st", "road", "rd", "avenue", "ave", "blvd", "boulevard", "lane", "ln", "drive", "dr", "court", "ct", "highway", "hwy",
    "parkway", "pkwy", "floor", "fl", "suite", "ste", "unit", "building", "bldg", "near", "opp", "opposite", "beside", "behind", "sector",
    "sec", "industrial", "area", "nagar", "city", "state", "district", "north", "south", "east", "west", "null", "undefined", "rue",
    "allee", "france", "usa", "india", "ground", "first", "second", "third", "fourth", "number", "main", "bis", "ter", "place", "square",
    "chemin", "route", "impasse",
]
HOUSE_PREFIXED = r"(?i)\b(?:plot\s*no\.?|h\.?\s*no\.?|house\s*no\.?|flat\s*no\.?|shop\s*no\.?|unit\s*no\.?|s\s*no\.?|no\.?|#)\s*([a-zA-Z0-9\-/]+)"
#: As HOUSE_PREFIXED in RE2: only ASCII letters, digits and _ are of a word, \v is no blank, and U+017F and U+212A are an s
#: and a k where case does not count.
HOUSE_PREFIXED_ASCII = r"(?i)(?:(?<![a-zA-Z0-9_])(?:plot_*no\.?|h\.?_*no\.?|hou[sſ]e_*no\.?|flat_*no\.?|shop_*no\.?|unit_*no\.?|s_*no\.?|no\.?)|(?<=[a-zA-Z0-9_])(?:ſhop_*no\.?|ſ_*no\.?|#))_*([a-zA-Zſ\u212A0-9\-/]+)".replace("_*", r"[\t\n\f\r ]*")
HOUSE_LEADING = r"^\s*([a-zA-Z]?[0-9]+[a-zA-Z0-9\-/]*)"
INDIC = {
    0x05: "a", 0x06: "aa", 0x07: "i", 0x08: "ee", 0x09: "u", 0x0A: "oo", 0x0B: "ri", 0x0E: "e", 0x0F: "e", 0x10: "ai", 0x11: "o",
    0x12: "o", 0x13: "o", 0x14: "au", 0x15: "k", 0x16: "kh", 0x17: "g", 0x18: "gh", 0x19: "ng", 0x1A: "ch", 0x1B: "chh", 0x1C: "j",
    0x1D: "jh", 0x1E: "ny", 0x1F: "t", 0x20: "th", 0x21: "d", 0x22: "dh", 0x23: "n", 0x24: "t", 0x25: "th", 0x26: "d", 0x27: "dh",
    0x28: "n", 0x29: "nn", 0x2A: "p", 0x2B: "ph", 0x2C: "b", 0x2D: "bh", 0x2E: "m", 0x2F: "y", 0x30: "r", 0x31: "rr", 0x32: "l",
    0x33: "ll", 0x34: "lll", 0x35: "v", 0x36: "sh", 0x37: "sh", 0x38: "s", 0x39: "h", 0x3C: "", 0x58: "q", 0x59: "kh", 0x5A: "g",
    0x5B: "z", 0x5C: "r", 0x5D: "rh", 0x5E: "f", 0x5F: "y", 0x7A: "nn", 0x7B: "n", 0x7C: "r", 0x7D: "l", 0x7E: "ll", 0x3E: "aa",
    0x3F: "i", 0x40: "ee", 0x41: "u", 0x42: "oo", 0x43: "ri", 0x46: "e", 0x47: "e", 0x48: "ai", 0x49: "o", 0x4A: "o", 0x4B: "o",
    0x4C: "au", 0x01: "n", 0x02: "n", 0x03: "h", 0x70: "n", 0x4D: "",
}

INDIC_RANGE = "[\\u0900-\\u0D7F]"


def text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def has_indic(c: Column) -> Column:
    return text(c).rlike(INDIC_RANGE)


@functools.cache
def accent_map() -> tuple[str, str, list[tuple[str, str]]]:
    """Characters U+00C0 to U+024F with what is left of them without marks: single ones as two strings, others as pairs."""
    one, plain, more = "", "", []
    for c in map(chr, range(0xC0, 0x250)):
        base = "".join(x for x in unicodedata.normalize("NFKD", c) if not "̀" <= x <= "ͯ")
        if base != c and len(base) == 1:
            one, plain = one + c, plain + base
        elif base != c:
            more.append((c, base))
    return one, plain, more


def strip_accents(c: Column) -> Column:
    """Accents of Latin letters up to U+024F. Other compatibility characters stay as they are (see strip_accents_exact)."""
    one, plain, more = accent_map()
    out = F.translate(text(c), one, plain)
    for a, b in more:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


@F.pandas_udf(T.StringType())
def strip_accents_exact(s: pd.Series) -> pd.Series:
    """Where a text has a letter of U+00C0 to U+024F: compatibility decomposition of the whole text, without marks."""
    accented = re.compile("[À-ɏ]")
    marks = re.compile("[̀-ͯ]")
    return s.map(lambda t: marks.sub("", unicodedata.normalize("NFKD", t)) if t and accented.search(t) else t)


def plain_lower(c: Column) -> Column:
    """Lower case a character at a time, as in DuckDB: a capital sigma at a word's end and a dotted capital I as elsewhere."""
    return F.lower(F.translate(c, "Σİ", "σi"))


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def clean(c: Column, keep: str = "") -> Column:
    """Letters, numbers and marks (and `keep`); all else is a blank."""
    return squeeze(F.regexp_replace(c, rf"[^\p{{L}}\p{{N}}\p{{M}}\s{keep}]", " "))


def normalize_name(c: Column, ascii_words: bool = False) -> Column:
    """ascii_words: blanks around the name, prefixes and lower case are those of RE2 and DuckDB."""
    blank, prefix, lower = (r"[\t\n\f\r ]", PREFIX_ASCII, plain_lower) if ascii_words else (r"\s", PREFIX, F.lower)
    out = F.regexp_replace(F.regexp_replace(text(c), rf"^{blank}+|{blank}+$", ""), prefix, "")
    out = F.replace(lower(strip_accents(out)), F.lit("&"), F.lit(" and "))
    return clean(F.regexp_replace(out, "['’`]", ""))


def legal_pattern() -> str:
    return "|".join(re.escape(s) for s in sorted(LEGAL, key=len, reverse=True))


def remove_legal(norm: Column) -> Column:
    """Without any listed designation, wherever it stands; a trailing `and` or `et` goes too; the input if nothing is left."""
    out = F.regexp_replace(norm, rf"(?i)(?:(?<=\s)|^)(?:{legal_pattern()})(?:(?=\s)|$)", " ")
    out = squeeze(F.regexp_replace(out, r"(?<![\p{L}\p{N}_])(?:and|et)\s*$", ""))
    return F.when(out == "", norm).otherwise(out)


def compact(c: Column) -> Column:
    return F.regexp_replace(F.lower(text(c)), r"[^\p{L}\p{N}\p{M}]", "")


def tokens(c: Column) -> Column:
    return F.filter(F.split(squeeze(text(c)), " "), lambda t: t != "")


@functools.cache
def indic_pattern() -> re.Pattern[str]:
    """A consonant with the sign after it, or any other Indic character."""
    at = lambda ranges: "".join(f"{chr(b + x)}-{chr(b + y)}" for b in range(0x900, 0xD80, 0x80) for x, y in ranges)
    signs = "".join(chr(b + o) for b in range(0x900, 0xD80, 0x80) for o in (*range(0x3E, 0x4D), 0x4D) if o in INDIC)
    return re.compile(f"([{at([(0x15, 0x39), (0x58, 0x5F)])}])([{signs}])?|[ऀ-ൿ]")


def latin(t: str) -> str:
    """Indic scripts in Latin letters: a consonant has the vowel of its sign, none before a virama, and `a` otherwise."""

    def sound(m: re.Match[str]) -> str:
        base = INDIC.get(ord(m[0][0]) & 0x7F, "")
        if not m[1]:
            return base
        return base + (INDIC[ord(m[2]) & 0x7F] if m[2] else "a")

    return indic_pattern().sub(sound, t)


@F.pandas_udf(T.StringType())
def _latin(s: pd.Series) -> pd.Series:
    return s.map(lambda t: latin(t) if t else t)


def transliterate(c: Column) -> Column:
    return F.when(has_indic(c), _latin(text(c))).otherwise(text(c))


def transliterate_name(c: Column, ascii_words: bool = False) -> Column:
    return normalize_name(transliterate(c), ascii_words)


def consonants(c: Column) -> Column:
    """Letters but for a, e, i, o, u."""
    return F.regexp_replace(F.lower(text(c)), r"[^\p{L}]|[aeiou]", "")


def char_ngrams(c: Column, n: int) -> Column:
    """Distinct n-grams; a shorter text is its own only one; an empty text has none."""
    grams = F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.substring(c, i, F.lit(n)))
    return F.when(F.length(c) >= n, F.array_distinct(grams)).when(c != "", F.array(c)).otherwise(F.array().cast("array<string>"))


EDGE_BEFORE, EDGE_AFTER = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"


def edges(ascii_words: bool, more: str = "") -> tuple[str, str]:
    """What stands before and after a word. ascii_words: a word is of ASCII letters, digits and _ only, as in RE2, and `more`."""
    return (f"(?<![a-zA-Z0-9_{more}])", f"(?![a-zA-Z0-9_{more}])") if ascii_words else (EDGE_BEFORE, EDGE_AFTER)


def normalize_address(c: Column, ascii_words: bool = False) -> Column:
    """ascii_words: see `edges`; the letter U+00DF is of a word all the same."""
    before, after = edges(ascii_words, "ß")
    out = (plain_lower if ascii_words else F.lower)(strip_accents(F.trim(text(c))))
    out = F.regexp_replace(out, rf"{before}(?:null|undefined|none){after}|[#*]+", " ")
    for short, full in ABBREVIATIONS:
        out = F.regexp_replace(out, rf"{before}(?:{short}){after}\.?", full)
    return clean(out, keep=r"\-/")


def last(matches: Column) -> Column:
    return F.when(F.size(matches) > 0, F.element_at(matches, -1))


def postal_code(address: Column, ascii_words: bool = False) -> Column:
    """Last six-digit code, else last five-digit code, else empty. ascii_words: see `edges`."""
    a, (before, after) = text(address), edges(ascii_words)
    six = F.regexp_extract_all(a, F.lit(rf"{before}([1-9][0-9]{{5}}){after}"), 1)
    five = F.regexp_extract_all(a, F.lit(rf"{before}([0-9]{{5}}){after}"), 1)
    return F.coalesce(last(six), last(five), F.lit(""))


def numbers(address: Column, ascii_words: bool = False) -> Column:
    """Number sequences in order, repeated ones too. ascii_words: see `edges`."""
    before, after = edges(ascii_words)
    return F.regexp_extract_all(text(address), F.lit(rf"{before}([0-9]+){after}"), 1)


def number_tokens(normalized: Column) -> Column:
    """Distinct numbers, with one letter at either side."""
    found = F.regexp_extract_all(F.lower(text(normalized)), F.lit(rf"{EDGE_BEFORE}\p{{Nd}}+[a-z]?{EDGE_AFTER}|{EDGE_BEFORE}[a-z]?\p{{Nd}}+{EDGE_AFTER}"), 0)
    return F.array_distinct(found)


def house_number(address: Column, ascii_words: bool = False, early_tokens: bool = True) -> Column:
    """A number after a house word; else one that the address begins with; else, with `early_tokens`, a token with a digit
    among the first four that is no postal code; else empty. ascii_words: a house word may follow a letter beyond ASCII, as in
    RE2."""
    a = F.trim(text(address))
    bare = lambda v: F.regexp_replace(F.regexp_replace(v, r"^[#\-/\s]+|[#\-/\s]+$", ""), "#+", "")
    digit = lambda v: F.when(v.rlike(r"\p{Nd}"), v)
    early = F.slice(tokens(F.replace(a, F.lit(","), F.lit(" "))), 1, 4)
    cleaned = F.transform(early, lambda t: F.regexp_replace(t, r"^[#()\[\].,/\-]+|[#()\[\].,/\-]+$", ""))
    fit = F.filter(cleaned, lambda t: t.rlike(r"\p{Nd}") & (F.length(t) <= 10) & ~t.rlike(r"^(?:\p{Nd}{5}|\p{Nd}{6})$"))
    return F.coalesce(digit(bare(F.regexp_extract(a, HOUSE_PREFIXED_ASCII if ascii_words else HOUSE_PREFIXED, 1))), digit(bare(F.regexp_extract(a, HOUSE_LEADING, 1))), *([F.get(fit, 0)] if early_tokens else []), F.lit(""))


def address_tokens(normalized: Column) -> Column:
    """Tokens that may serve as keys: four characters and more, no number, no stop word; in order, repeated ones too."""
    stop = F.array(*map(F.lit, ADDRESS_STOPWORDS))
    return F.filter(tokens(normalized), lambda t: (F.length(t) >= 4) & ~t.rlike(r"^\p{Nd}+$") & ~F.array_contains(stop, t))
