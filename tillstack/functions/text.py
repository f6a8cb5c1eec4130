"""Text rules as Column expressions (STR1-17, FLT10).

All of them are built-in JVM expressions: no Python runs per row.  Regexes
behave like the Python ``re`` rules they stand for: ``(?iu)`` is Unicode
case-insensitive matching, ``(?d)`` makes ``.`` stop only at ``\\n``, and white
space is the explicit class ``SPACE`` (spreadsheets deliver no-break spaces).
What the rules look for is an argument (``TextRules``).

A regex costs more than all else on a line, so most lines need few.  In ASCII text
letter case is all that ``(?iu)`` passes over, so words are looked for by plain search
in the lower-cased text (``ascii_lower``, once a line); the regex decides where several
words of a list stand and on other text.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, functions as F

from tillstack import fixed_values as FV


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def alternation(words: Iterable[str]) -> str:
    """``(w1|w2|...)`` with every word escaped, in the given order (leftmost
    match, first listed alternative wins — as in Python and RE2)."""
    return "(" + "|".join(re.escape(w) for w in words) + ")"


# Every character Python's ``str.isspace()`` accepts, derived by that rule.
PY_WHITESPACE = "".join(ch for ch in map(chr, range(sys.maxunicode + 1)) if ch.isspace())


def _ranges(chars: str) -> str:
    """The characters as ranges of a regex class (a class tests its members one by one)."""
    runs: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if runs and code == runs[-1][1] + 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "".join(f"\\x{{{a:x}}}" + (f"-\\x{{{b:x}}}" if b > a else "") for a, b in runs)


# The same as a regex class, in escapes that Java and RE2 both read.
SPACE = "[" + _ranges(PY_WHITESPACE) + "]"


@dataclass(frozen=True)
class TextRules:
    """What the text rules look for (UDF3); a shop passes its own."""

    sizes: list = field(default_factory=lambda: list(FV.SIZE_WORDS))
    variations: list = field(default_factory=lambda: list(FV.VARIATION_WORDS))
    flavor_lines: list = field(default_factory=lambda: list(FV.FLAVOR_LINE_WORDS))
    flavors: list = field(default_factory=lambda: list(FV.FLAVOR_WORDS))
    sugar_levels: list = field(default_factory=lambda: list(FV.SUGAR_WORDS))
    spice_levels: list = field(default_factory=lambda: list(FV.SPICE_WORDS))
    pastry_groups: list = field(default_factory=lambda: list(FV.PASTRY_GROUPS))
    pastry_flavors: list = field(default_factory=lambda: list(FV.PASTRY_FLAVORS))
    pastry_renames: dict = field(default_factory=lambda: dict(FV.PASTRY_GROUP_RENAMES))
    pastry_suffix: str = FV.PASTRY_FLAVOR_SUFFIX
    quantity_mark: str = FV.QUANTITY_MARK


DEFAULT_RULES = TextRules()


def strip_ws(c) -> Column:
    """Python ``str.strip()``: trim exactly the characters Python counts as
    whitespace from both ends (plain ``trim`` only removes spaces)."""
    return F.trim(_c(c), F.lit(PY_WHITESPACE))


def title_case(c) -> Column:
    """Python ``str.title()``: upper-case the first letter of every run of
    cased letters and lower-case the rest (a letter without case ends a run).

    ``initcap`` only starts a word after a space, so everything else without
    case is first followed by a NUL + space marker (making the next letter a word
    start), ``initcap`` runs, and the markers are removed.  All three are
    code-generated built-ins.
    """
    marked = F.regexp_replace(_c(c), r"([^\p{IsLowercase}\p{IsUppercase}\p{Lt} ])", "$1\u0000 ")
    return F.replace(F.initcap(marked), F.lit("\u0000 "), F.lit(""))


def titled_match(m: Column, words: Iterable[str], renames: dict | None = None) -> Column:
    """Title-case of a case-insensitive match of one of ``words``.

    A match is one of the words in some letter case, so its title form is
    looked up from the lower-cased match (computed once here with Python's
    own ``str.title``); anything unexpected falls back to ``title_case``.
    ``renames`` maps a title form to its replacement.
    """
    renames = renames or {}
    lowered = F.lower(m)
    out = F.when(m.isNull(), F.lit(None).cast("string"))
    for w in dict.fromkeys(words):
        t = w.title()
        out = out.when(lowered == w.lower(), F.lit(renames.get(t, t)))
    fallback = title_case(m)
    for old, new in renames.items():
        fallback = F.when(fallback == old, F.lit(new)).otherwise(fallback)
    return out.otherwise(fallback)


def extract_first(c, words: Iterable[str], ignore_case: bool = True) -> Column:
    """First (leftmost) occurrence of any of ``words`` as written in the
    text, or null."""
    flags = "(?iu)" if ignore_case else ""
    return F.nullif(F.regexp_extract(_c(c), flags + alternation(words), 1), F.lit(""))


def ascii_lower(c) -> Column:
    """ASCII text in lower case, other text null: what words can be searched in."""
    return F.when(F.octet_length(_c(c)) == F.char_length(_c(c)), F.lower(_c(c)))


def _searchable(words: list[str]) -> bool:
    return bool(words) and all(w and w.isascii() for w in words)


def _any_of(low: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(low, F.lit(w.lower())) for w in words])


def contains_any(c, words: Iterable[str], low: Column | None = None) -> Column:
    """Case-insensitive containment; null text is false (FLT10)."""
    words = list(words)
    matched = _c(c).rlike("(?iu)" + alternation(words))
    if _searchable(words):
        low = ascii_lower(c) if low is None else low
        matched = F.when(low.isNotNull(), _any_of(low, words)).otherwise(matched)
    return F.coalesce(matched, F.lit(False))


def _vocab(c, words: Iterable[str], low: Column | None = None) -> Column:
    """The title form of the first of ``words`` in the text, or null."""
    words = list(words)
    matched = titled_match(extract_first(c, words), words)
    if not _searchable(words):
        return matched
    low = ascii_lower(c) if low is None else low
    titles = {w.lower(): w.title() for w in reversed(words)}
    here = reduce(lambda a, b: a + b, [F.contains(low, F.lit(w)).cast("int") for w in titles])
    only = reduce(lambda rest, w: F.when(F.contains(low, F.lit(w)), F.lit(titles[w])).otherwise(rest), titles, F.lit(None).cast("string"))
    return F.when(here <= 1, only).otherwise(matched)  # null, so the regex, for other text


def extract_size(c, rules: TextRules = DEFAULT_RULES, low: Column | None = None) -> Column:  # STR1
    return _vocab(c, rules.sizes, low)


def extract_variation(c, rules: TextRules = DEFAULT_RULES, low: Column | None = None) -> Column:  # STR2
    return _vocab(c, rules.variations, low)


def extract_flavor(c, rules: TextRules = DEFAULT_RULES, low: Column | None = None) -> Column:  # STR3
    return F.when(contains_any(c, rules.flavor_lines, low), _vocab(c, rules.flavors, low))


def extract_sugar(c, rules: TextRules = DEFAULT_RULES, low: Column | None = None) -> Column:  # STR4
    return _vocab(c, rules.sugar_levels, low)


def extract_spice(c, rules: TextRules = DEFAULT_RULES, low: Column | None = None) -> Column:  # STR5
    return _vocab(c, rules.spice_levels, low)


def extract_quantity(c, rules: TextRules = DEFAULT_RULES) -> Column:
    """STR6: the digits after the first mark, case-sensitive; 1 without any."""
    digits = F.nullif(F.regexp_extract(_c(c), rf"{re.escape(rules.quantity_mark)}{SPACE}*(\d+)", 1), F.lit(""))
    return F.coalesce(digits.try_cast("double"), F.lit(1.0))


def is_pastry(c, rules: TextRules = DEFAULT_RULES, low: Column | None = None) -> Column:  # FLT10 for STR7-10
    return contains_any(c, rules.pastry_groups, low)


def pastry_flavor(c, rules: TextRules = DEFAULT_RULES) -> Column:  # STR7 + STR8
    raw = extract_first(c, rules.pastry_flavors)
    return strip_ws(F.regexp_replace(raw, rf"(?iu){SPACE}*{re.escape(rules.pastry_suffix)}", ""))


def pastry_group(c, rules: TextRules = DEFAULT_RULES) -> Column:  # STR9
    return titled_match(extract_first(c, rules.pastry_groups), rules.pastry_groups, rules.pastry_renames)


def composite_item(c, rules: TextRules = DEFAULT_RULES) -> Column:  # STR10: null flavor -> null item
    return F.concat(pastry_group(c, rules), F.lit(" - "), pastry_flavor(c, rules))


def plain_item(c, rules: TextRules = DEFAULT_RULES) -> Column:
    """STR12: without quantities and without what stands in parentheses."""
    text = _c(c)
    bare = F.regexp_replace(text, rf"{re.escape(rules.quantity_mark)}{SPACE}*\d+", "")
    # without a parenthesis in the text there is none in what is left of it
    return strip_ws(F.when(F.contains(text, F.lit("(")), F.regexp_replace(bare, rf"(?d){SPACE}*\(.*\)", "")).otherwise(bare))


def clean_item(c, rules: TextRules = DEFAULT_RULES, low: Column | None = None) -> Column:
    """Item name before corrections and title-casing (STR7-12)."""
    return F.when(is_pastry(c, rules, low), composite_item(c, rules)).otherwise(plain_item(c, rules))


def match_key(c) -> Column:  # STR15
    return F.upper(strip_ws(c))


def blank_key(c) -> Column:  # STR16: blank and null match each other
    return F.coalesce(F.nullif(strip_ws(c), F.lit("")), F.lit(FV.BLANK_MATCH))


def drop_thousands(c) -> Column:  # STR17
    return F.replace(_c(c), F.lit(","), F.lit(""))
