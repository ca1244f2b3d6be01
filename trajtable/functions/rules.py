"""Ordered rewrite rules for answer texts, as data, and their translation to a column expression.

A rule is ``("text", old, new)`` for plain replacement or ``("regex", pattern, new)``; ``new`` names
groups as ``$1``. Rules run in order.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str, str, str]


def apply(value: Column, rules: Sequence[Rule]) -> Column:
    def one(x: Column, rule: Rule) -> Column:
        kind, old, new = rule
        if kind == "text":
            return F.replace(x, F.lit(old), F.lit(new))
        return F.regexp_replace(x, old, new)

    return reduce(one, rules, value)


# fixed values: substitutions and removals for "Answer:" lines
LINE_SUBSTITUTIONS = (
    ("an ", ""),
    ("a ", ""),
    (".$", "$"),
    ("\\$", ""),
    ("\\ ", ""),
    (" ", ""),
    ("mbox", "text"),
    (",\\text{and}", ","),
    ("\\text{and}", ","),
    ("\\text{m}", "\\text{}"),
)
LINE_REMOVALS = (
    "square", "ways", "integers", "dollars", "mph", "inches", "hours", "km", "units", "\\ldots", "sue", "points", "feet",
    "minutes", "digits", "cents", "degrees", "cm", "gm", "pounds", "meters", "meals", "edges", "students",
    "childrentickets", "multiples", "\\text{s}", "\\text{.}", "\\text{\ns}", "\\text{}^2", "\\text{}^3", "\\text{\n}",
    "\\text{}", "\\mathrm{th}", "^\\circ", "^{\\circ}", "\\;", ",\\!", "{,}", '"', "\\dots",
)
# fixed values: patterns that unwrap and complete TeX in "Answer:" lines
LINE_PATTERNS = (
    (r"(.*?)(\$)(.*?)(\$)(.*)", r"\$$3\$"),
    (r"(\\text\{)(.*?)(\})", "$2"),
    (r"(\\textbf\{)(.*?)(\})", "$2"),
    (r"(\\overline\{)(.*?)(\})", "$2"),
    (r"(\\boxed\{)(.*)(\})", "$2"),
    (r"(frac)([^{])(.)", "frac{$2}{$3}"),
    (r"(sqrt)([^{])", "sqrt{$2}"),
)
LINE_RULES: tuple[Rule, ...] = (
    *[("text", a, b) for a, b in LINE_SUBSTITUTIONS],
    *[("text", a, "") for a in LINE_REMOVALS],
    *[("regex", a, b) for a, b in LINE_PATTERNS],
    ("text", "$", ""),
)

# fixed values: cleaning of boxed answers before they are compared
BOXED_REPLACEMENTS = (
    ("\n", ""),
    ("\\!", ""),
    ("\\\\", "\\"),
    ("tfrac", "frac"),
    ("dfrac", "frac"),
    ("\\left", ""),
    ("\\right", ""),
    ("^{\\circ}", ""),
    ("^\\circ", ""),
    ("\\$", ""),
)
BOXED_AFTER_UNITS = (
    ("\\\\%", ""),
    ("\\%", ""),
    (" .", " 0."),
    ("{.", "{0."),
)

# fixed values: units and weekdays for canonical answers
UNITS = (
    "degree", "cm", "centimeter", "meter", "mile", "second", "minute", "hour", "week", "month", "year", "foot", "feet",
    "inch", "yard", "p.m.", "PM",
)
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
CANONICAL_WORDS = (
    ("\\!", ""),
    ("\\%", "%"),
    ("\\$", "$"),
    ("$", ""),
    ("%", ""),
    ("^{\\circ}", ""),
    (" or ", " , "),
    (" and ", " , "),
    ("million", "*10^6"),
    ("billion", "*10^9"),
    ("trillion", "*10^12"),
)
CANONICAL_HEAD: tuple[Rule, ...] = (
    ("text", "\\left", ""),
    ("text", "\\right", ""),
    ("regex", r"\s*\\text\{\s*(or|and)\s*\}\s*", ","),
    ("regex", r",\s*,", ","),
)
CANONICAL_SURROUND = ("text", "mathrm", "mathcal", "textbf", "textit")
CANONICAL_TAIL: tuple[Rule, ...] = (
    ("regex", r"- *", "-"),
    ("regex", r"([0-9]) +([0-9])", "$1+$2"),
    ("regex", r"(\d+) *\\frac\{(\d+)\}\{(\d+)\}", "$1 + $2/$3"),
    ("text", " ", ""),
)
# fixed value: ASCII punctuation
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
