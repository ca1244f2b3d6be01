"""Answer extraction and comparison as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trajtable.functions import rules
from trajtable.functions.divergence import let, pipe

BOX = "\\boxed"


def last(items: Column) -> Column:
    """Last element, null for an empty array."""
    return F.try_element_at(items, F.lit(-1))


def last_group(text: Column, pattern: str, group: int = 1) -> Column:
    return last(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)))


def after_last(text: Column, mark: str) -> Column:
    return F.substring_index(text, mark, -1)


def tail(text: Column, n: int) -> Column:
    return F.right(text, F.lit(n))


def balanced(rest: Column) -> Column:
    """Content of the brace group that ``rest`` starts with; null when it never closes.

    ``rest`` is cut at closing braces; the group ends at the first one where as many braces were
    opened as closed.
    """
    pieces = F.split(rest, r"\}")
    start = F.struct(F.lit(0).alias("open"), F.lit(0).alias("seen"), F.lit(-1).alias("end"))

    def step(s: Column, p: Column) -> Column:
        opened = s.open + F.length(p) - F.length(F.replace(p, F.lit("{"), F.lit("")))
        done = (s.end < 0) & (opened == s.seen + 1)
        return F.struct(opened.alias("open"), (s.seen + 1).alias("seen"), F.when(done, s.seen).otherwise(s.end).alias("end"))

    def content(parts: Column) -> Column:
        walked = F.aggregate(F.slice(parts, F.lit(1), F.size(parts) - 1), start, step)
        return let(walked, lambda s: F.when(
            s.end >= 0, F.array_join(F.slice(parts, F.lit(1), s.end + 1), "}")
        ))

    inner = F.when(rest.startswith("{"), let(pieces, content))
    return let(inner, lambda x: F.substring(x, F.lit(2), F.length(x)))


def last_boxed(text: Column) -> Column:
    """Content of the last ``\\boxed{}``; a ``\\boxed x`` form wins and ends at the next dollar sign."""
    spaced = F.substring_index(after_last(text, BOX + " "), "$", 1)
    return F.when(text.contains(BOX + " "), spaced).when(text.contains(BOX), balanced(after_last(text, BOX)))


def boxed_or_framed(text: Column) -> Column:
    """Content of the last box, else of the last ``\\fbox``."""
    rest = lambda mark: balanced(after_last(text, mark))
    return F.trim(F.when(text.contains(BOX), rest(BOX)).when(text.contains("\\fbox"), rest("\\fbox")))


# --- comparable texts ----------------------------------------------------------------------------


def replace(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def drop_first(text: Column, n: int = 1) -> Column:
    return F.substring(text, F.lit(n + 1), F.length(text))


def wrap_fractions(text: Column) -> Column:
    """``\\frac12`` to ``\\frac{1}{2}`` and ``\\frac1{x}`` to ``\\frac{1}{x}``; a cut-off fraction leaves the text alone."""
    wrapped = F.regexp_replace(text, r"\\frac([^{])([^{])", r"\\frac{$1}{$2}")
    wrapped = F.regexp_replace(wrapped, r"\\frac([^{])\{", r"\\frac{$1}{")
    return F.when(text.rlike(r"\\frac([^{])?(\\frac|$)"), text).otherwise(wrapped)


def boxed_text(text: Column) -> Column:
    """Rewrite a boxed answer for comparison; null where the rules cannot be applied."""

    def without_units(s: Column) -> Column:
        return F.when(F.size(F.split(s, r"\\text\{ ", -1)) <= 2, F.substring_index(s, "\\text{ ", 1))

    def without_name(s: Column) -> Column:
        return let(F.split(s, "=", -1), lambda p: F.when((F.size(p) == 2) & (F.length(p[0]) <= 2), p[1]).otherwise(s))

    def roots(s: Column) -> Column:
        fixed = F.regexp_replace(s, r"\\sqrt([^{])", r"\\sqrt{$1}")
        return F.when(~s.rlike(r"\\sqrt(\\sqrt|$)"), replace(fixed, " ", ""))

    return pipe(
        rules.apply(text, [("text", a, b) for a, b in rules.BOXED_REPLACEMENTS]),
        without_units,
        lambda s: rules.apply(s, [("text", a, b) for a, b in rules.BOXED_AFTER_UNITS]),
        lambda s: F.when(s.startswith("."), F.concat(F.lit("0"), s)).otherwise(s),
        without_name,
        roots,
        lambda s: F.when(~s.rlike(r"\\frac(\\frac|$)"), wrap_fractions(s)),
        lambda s: F.when(s == "0.5", "\\frac{1}{2}").otherwise(s),
        lambda s: F.regexp_replace(s, r"^(0|-?[1-9][0-9]*)/(0|-?[1-9][0-9]*)$", r"\\frac{$1}{$2}"),
    )


def boxed_equal(a: Column, b: Column) -> Column:
    same = lambda x: lambda y: F.when(x.isNull() | y.isNull(), a == b).otherwise(x == y)
    return F.coalesce(let(boxed_text(a), lambda x: let(boxed_text(b), same(x))), F.lit(False))


def line_text(text: Column) -> Column:
    """Rewrite an answer line for comparison."""
    return pipe(
        rules.apply(after_last(text, "="), rules.LINE_RULES),
        lambda s: F.trim(F.when(replace(s, ",", "").rlike("^[0-9]+$"), replace(s, ",", "")).otherwise(s)),
    )


def without_group_commas(text: Column) -> Column:
    """1,234,567 to 1234567; commas between tuple entries stay. Each pass joins every other group."""
    for _ in range(4):
        text = F.regexp_replace(text, r"(\d)(,)(\d\d\d)($|\D)", "$1$3$4")
    return text


def canonical_answer(text: Column) -> Column:
    """Canonical form of a mathematical answer, for votes and equality."""

    def units(s: Column) -> Column:
        parts, boxes = F.split(s, r"\\text\s*\{\s*", -1), F.split(s, r"\\mbox\{", -1)
        one = (F.size(parts) == 2) & ~parts[0].isin("", "(")
        return (
            F.when(s.contains("\\text") & one, parts[0])
            .when(s.contains("\\text{"), F.regexp_replace(s, r"\\text\{([^}]+)\}", "$1"))
            .when(s.contains("\\mbox{") & (F.size(boxes) == 2), boxes[0])
            .otherwise(s)
        )

    def words(s: Column) -> Column:
        for word in rules.CANONICAL_SURROUND:
            s = F.regexp_replace(s, r"^\\" + word + r"\{(.+?)\}$", "$1")
        s = rules.apply(s, [("text", a, b) for a, b in rules.CANONICAL_WORDS])
        return rules.apply(s, [("regex", unit + r"(es)?(s)? *(\^[0-9]+)?", "") for unit in rules.UNITS])

    def days(s: Column) -> Column:
        drop = s.contains("day") & ~s.rlike("|".join(rules.WEEKDAYS))
        return F.when(drop, F.regexp_replace(s, "day(s)?", "")).otherwise(s)

    def braces(s: Column) -> Column:
        bare = F.when(s.startswith("{") & s.endswith("}"), F.substring(s, F.lit(2), F.length(s) - 2)).otherwise(s)
        return F.regexp_replace(F.regexp_replace(bare, r"\\sqrt(\s*\w+)", r"\\sqrt{$1}"), r"\\frac +", r"\\frac")

    def integer(s: Column) -> Column:
        plain = without_group_commas(s)
        number = F.when(plain.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"), plain.try_cast("double"))
        whole = lambda n: F.when((F.abs(n - F.round(n)) <= 1e-7) & (F.abs(n) < 9e15), n.cast("bigint").cast("string"))
        return F.coalesce(let(number, whole), s)

    return pipe(
        rules.apply(text, rules.CANONICAL_HEAD),
        units,
        lambda s: F.when(s.contains("\\in "), F.trim(F.split(s, r"\\in ", -1)[1])).otherwise(s),
        words,
        days,
        braces,
        wrap_fractions,
        lambda s: rules.apply(s, rules.CANONICAL_TAIL),
        integer,
    )


def number_of(text: Column) -> Column:
    """Numeric value of an answer: a leading dollar or trailing percent sign and commas are ignored."""
    return pipe(
        F.when(text.rlike(r"^\$\d+(\.\d+)?"), drop_first(text)).otherwise(text),
        lambda s: F.when(s.rlike(r"^\d+(\.\d+)?\\?%$"), F.regexp_replace(s, r"\\?%$", "")).otherwise(s),
        lambda s: F.trim(F.when(s.contains("{,}"), replace(s, "{,}", "")).otherwise(replace(s, ",", ""))).try_cast("double"),
    )


def close(a: Column, b: Column, rel: float) -> Column:
    return F.abs(a - b) <= rel * F.greatest(F.abs(a), F.abs(b))


def numeric_equal(pred: Column, truth: Column, rel: float = 1e-4, percent: bool = True) -> Column:
    """Equal texts, or numbers within the tolerance of truth / 100, truth or truth * 100; null = undecided."""

    def numbers(p: Column, t: Column) -> Column:
        near = close(t, p, rel)
        return near | close(t / 100, p, rel) | close(t * 100, p, rel) if percent else near

    def texts(a: Column, b: Column) -> Column:
        same = (F.lower(F.trim(a)) == F.lower(F.trim(b))) | (replace(a, " ", "") == replace(b, " ", ""))
        return F.when(same, True).otherwise(let(number_of(a), lambda p: let(number_of(b), lambda t: numbers(p, t))))

    return let(pred, lambda a: let(truth, lambda b: texts(a, b)))


def qa_text(text: Column) -> Column:
    """Lower case, no punctuation, no articles, single blanks."""
    s = F.translate(F.lower(text), rules.PUNCTUATION, "")
    s = F.regexp_replace(s, r"(?U)\b(a|an|the)\b", " ")
    return F.trim(F.regexp_replace(s, r"(?U)\s+", " "))


def count_of(text: Column, mark: str) -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))) / len(mark)).cast("int")
