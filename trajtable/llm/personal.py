"""Personal data by candidate gradient boosting, in DataFrame functions only.

Four plain rules give the base spans. High-recall generators propose further, overlapping spans;
each is described by its format and its context, boosted trees score it, and a threshold per kind,
calibrated for precision, selects. The trees are applied as a column expression inside the scan: no
shuffle, no Python.

The trees are fitted on the driver on spans that the base rules do not find: base spans of a bounded
sample with the part taken off that the rule goes by (the plus, the @, the digits of a long card), and
clean numbers and words in the same texts' contexts as the other class. Candidates that merely meet no base
span have no label and are not used. The rule for addresses is whole, so nothing is derived for ``ip``.
"""

from __future__ import annotations

import math
import random
import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trajtable.llm.common import smallest, table, written

KINDS = ("email", "ip", "card", "phone")

#: the base rules as patterns whose matches are the maximal ones: a match never starts inside a run
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: generators of candidates: wider than the rules
WIDE = {
    "email": r"""[^\s@,;:<>"'()\[\]]{1,64}+ ?(?:@|\(at\)|\[at\]) ?[^\s@,;:<>"'()\[\]]{0,254}[A-Za-z0-9]""",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:[.:][0-9]{1,5}+){2,5}",
    "card": r"(?<![0-9])[0-9](?:[ ./-]{0,2}[0-9]){11,22}(?![0-9])",
    "phone": r"\+?\(?(?<![0-9])[0-9](?:[ ()./-]{0,3}[0-9]){6,16}(?![0-9])",
}
CONTEXT = {
    "email": "(?i)mail|contact|write|adress|correo|courriel",
    "ip": r"(?i)\bip|host|server|addr|login",
    "card": "(?i)card|visa|credit|karte|carte|tarjeta|iban|konto",
    "phone": "(?i)phone|tel|call|fax|mobil|anruf",
}
SAMPLE_DOCS = 2_000  # documents with candidates that the trees are fitted on
SAMPLE_SPANS = 500  # base spans of a kind taken from them
KEYWORDS = {"card": ("card ", "visa: "), "phone": ("call ", "tel. ", "phone: ")}
#: dates, years, grouped thousands, decimals, book numbers: numbers of another sort
NUMBER = (
    r"^(?:(?:19|20)[0-9]{2}[ ./-]+[0-9]{1,2}[ ./-]+[0-9]{1,2}(?:[ ./-].*)?|[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2}(?:[ ./-].*)?"
    r"|(?:(?:19|20)[0-9]{2}[ ./-]*){2,}|[0-9]{1,3}(?:[ .][0-9]{3})+|[0-9]+\.[0-9]+|97[89][ -][0-9 -]+|(?:19|20)[0-9]{2}[/-][0-9]{4,})$"
)
TREES = 24
PRECISION = 0.99  # a threshold must reach this share of true spans on the part left out


def may_hold(kind: str, text: Column) -> Column:
    """A cheap necessary condition for any span of the kind."""
    if kind == "email":
        return text.contains("@") | text.contains("(at)") | text.contains("[at]")
    return text.rlike("[0-9]")


def none_of(text: Column) -> Column:
    """An empty array of spans, of the type that ``located`` gives."""
    spot = F.struct(F.lit(0).cast("bigint").alias("s"), F.lit(0).cast("bigint").alias("e"), F.lit("").alias("v"), F.lit("").alias("before"), F.lit("").alias("after"))
    return F.filter(F.array(spot), lambda _: F.lit(False))


GROUP = 128  # matches looked at together


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once: an expression inside a lambda would be computed for each element."""
    return F.transform(F.array(value), body)[0]


def in_groups(items: Column) -> Column:
    """An array cut into arrays of GROUP elements: what is done inside a group and on groups grows little faster than the array."""
    def cut(whole: Column) -> Column:
        n = F.ceil(F.size(whole) / GROUP).cast("int")
        starts = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.slice(whole, i * GROUP + 1, F.lit(GROUP)))

    return let(items, cut)


def located(text: Column, pattern: str) -> Column:
    """All matches with start, end (code points), text, and the text around them.

    The lengths of the pieces between the matches give the places: those of whole groups first, then
    those inside each group.
    """
    pieces, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def beside(p: Column, h: Column) -> Column:
        pairs = F.zip_with(F.slice(p, F.lit(1), F.size(h)), h, lambda p, h: F.struct(p.alias("p"), h.alias("h")))
        return F.zip_with(pairs, F.slice(p, F.lit(2), F.size(h)), lambda x, q: F.struct(x.p.alias("p"), x.h.alias("h"), q.alias("q")))

    around = let(pieces, lambda p: let(hits, lambda h: beside(p, h)))
    zero = F.lit(0).cast("bigint")
    sized = F.transform(
        in_groups(around), lambda g: F.struct(g.alias("g"), F.aggregate(g, zero, lambda s, x: s + F.length(x.p) + F.length(x.h)).alias("size"))
    )
    begun = lambda groups: F.aggregate(
        groups, F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("out")),
        lambda s, g: F.struct((s.at + g.size).alias("at"), F.array_append(s.out, s.at).alias("out")), lambda s: s.out,
    )

    def add(acc, x):
        a = acc.at + F.length(x.p)
        b = a + F.length(x.h)
        spot = F.struct(a.alias("s"), b.alias("e"), x.h.alias("v"), F.right(x.p, F.lit(24)).alias("before"), F.left(x.q, F.lit(1)).alias("after"))
        return F.struct(b.alias("at"), F.concat(acc.out, F.array(spot)).alias("out"))

    inside = lambda g, at: F.aggregate(g.g, F.struct(at.alias("at"), none_of(text).alias("out")), add, lambda acc: acc.out)
    return let(sized, lambda groups: F.flatten(F.zip_with(groups, begun(groups), inside)))


def bounded(spans: Column) -> Column:
    """Spans in groups by start, each with the range that it covers."""
    ordered = F.array_sort(spans, lambda x, y: F.when(x.s < y.s, -1).when(x.s > y.s, 1).otherwise(0))
    low = lambda g: F.array_min(F.transform(g, lambda x: x.s)).alias("low")
    high = lambda g: F.array_max(F.transform(g, lambda x: x.e)).alias("high")
    return F.transform(in_groups(ordered), lambda g: F.struct(g.alias("g"), low(g), high(g)))


def meets(groups: Column, x: Column, also=lambda o: F.lit(True)) -> Column:
    """Whether a span overlaps one of ``bounded`` spans for which ``also`` holds; only groups whose range it meets are searched."""
    inside = lambda g: F.exists(g.g, lambda o: (o.s < x.e) & (x.s < o.e) & also(o))
    return F.exists(groups, lambda g: (g.low < x.e) & (x.s < g.high) & inside(g))


def digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(v: Column) -> Column:
    """Whether the digits pass the Luhn check."""
    back = F.reverse(digits(v))

    def add(total, i):
        d = F.substring(back, i, F.lit(1)).try_cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(back), F.lit(1))), F.lit(0), add) % 10 == 0


def passes(kind: str, v: Column) -> Column:
    """The part of a base rule that its pattern does not say."""
    if kind == "ip":
        return F.forall(F.split(v, r"\."), lambda p: p.rlike("^0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])$"))
    if kind == "card":
        return luhn(v)
    if kind == "phone":
        return F.length(digits(v)).between(8, 15)
    return F.lit(True)


def base_spans(kind: str, text: Column) -> Column:
    needs = text.contains({"email": "@", "phone": "+"}[kind]) if kind in ("email", "phone") else text.rlike("[0-9]")
    found = F.filter(located(text, BASE[kind]), lambda x: passes(kind, x.v))
    return F.when(needs, found).otherwise(none_of(text))


FEATURES = ("length", "n_digits", "n_letters", "n_dots", "n_dashes", "n_spaces", "n_brackets", "groups", "longest", "plus", "luhn", "octets", "context", "joined_before", "joined_after", "domain_end", "number")
#: features that say which rule found a base span, or how the sample's own names look; the trees do not see them
HELD_OUT = {
    "email": ("length", "n_digits", "n_letters", "n_dots", "n_dashes", "groups", "longest", "plus", "luhn", "octets", "number"),
    "ip": (),
    "card": ("plus", "octets", "domain_end"),
    "phone": ("plus", "luhn", "octets", "domain_end"),
}


def features(kind: str, x: Column) -> list[Column]:
    """Format and context of a candidate as numbers, in the order of FEATURES."""
    v = x.v
    count = lambda chars: F.length(v) - F.length(F.regexp_replace(v, f"[{chars}]", ""))
    groups = F.filter(F.split(v, "[^0-9]+"), lambda g: g != "")
    flag = lambda c: F.when(c, 1).otherwise(0)
    out = [
        F.length(v), count("0-9"), count("A-Za-z"), count("."), count("-"), count(" "), count("()"),
        F.size(groups), F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)),
        flag(v.startswith("+")), flag(luhn(v)), flag(F.forall(groups, lambda g: g.rlike("^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})$"))),
        flag(x.before.rlike(CONTEXT[kind])), flag(x.before.rlike(r"[\w.+@-]$")), flag(x.after.rlike(r"[\w@-]")),
        flag(v.rlike(r"\.[A-Za-z]{2,24}$")), flag(v.rlike(NUMBER)),
    ]
    return [c.cast("double") for c in out]


def candidates(kind: str, text: Column) -> Column:
    """Proposed spans (s, e, v, f), ``f`` being the features."""
    found = F.when(may_hold(kind, text), located(text, WIDE[kind])).otherwise(none_of(text))
    return F.transform(found, lambda x: F.struct(x.s.alias("s"), x.e.alias("e"), x.v.alias("v"), F.array(*features(kind, x)).alias("f")))


def checked(digits: str) -> str:
    """The digits with a last one that passes the Luhn check."""
    total = sum(d * 2 - 9 if i % 2 == 0 and d > 4 else d * (2 - i % 2) for i, d in enumerate(map(int, reversed(digits))))
    return digits + str(-total % 10)


def derived(kind: str, v: str) -> tuple[list[str], list[str]]:
    """Forms of a base span that its rule does not find: (marked by their format, plain digits)."""
    if kind == "email":
        local, _, domain = v.rpartition("@")
        return [f"{local}{at}{domain}" for at in ("(at)", "[at]", " (at) ", " [at] ", " @ ")], []
    d = re.sub("[^0-9]", "", v)
    if kind == "phone":
        bare = v.lstrip("+")
        national = re.sub("^[0-9]+[ .-]+", "", bare)
        flat = re.sub("[()]", "", national)
        marked = [w for w in (bare, national, flat) if re.search("[^0-9]", w)]
        return marked, [re.sub("[^0-9]", "", national), d]
    if kind == "card":
        c15, c14, c13 = (checked(d[:n]) for n in (14, 13, 12))
        parts = lambda c, *at: [c[i:j] for i, j in zip((0, *at), (*at, len(c)))]
        marked = [sep.join(p) for sep in (" ", "-") for p in (parts(c15, 4, 10), parts(c14, 4, 10), parts(c13, 4, 8))]
        return [*marked, *(sep.join(parts(d, 4, 8, 12)) for sep in (".", "  ", "/"))], [c15, c14, c13]
    return [], []


def clean(kind: str, r: random.Random, words: list[str]) -> tuple[list[str], list[str]]:
    """Spans that a generator proposes and that are none of the kind: (in any context, without a keyword)."""
    if kind == "email":
        a, b = r.choice(words), r.choice(words)
        return [f"{a}{at}{b}" for at in ("(at)", " (at) ", "[at]", " [at] ", " @ ", " @", "@")] + [f"{a} (at) {r.randint(1, 12)}.{r.randint(10, 59)}"], []
    n = lambda k: "".join(str(r.randint(0, 9)) for _ in range(k))
    year, sep = r.randint(1900, 2099), r.choice(".-/")
    date = sep.join((str(year), f"{r.randint(1, 12):02}", f"{r.randint(1, 31):02}"))
    out = [
        date, sep.join(reversed(date.split(sep))), f"{date} {r.randint(10, 23)}", f"{year} {year + 1} {year + 2} {year + 3}", f"{year}-{year + 9}", f"{n(1)}.{n(r.randint(6, 14))}",
        "97" + r.choice("89") + f"-{n(1)}-{n(2)}-{n(6)}-{n(1)}", f"{year}-{n(r.randint(4, 8))}", " ".join(str(r.randint(1, 99)) for _ in range(r.randint(7, 9))),
        *(g.join([str(r.randint(1, 999)), *(n(3) for _ in range(r.randint(2, 4)))]) for g in " ."),
    ]
    if kind == "card":  # a card must pass the check: what fails it is none, and one of ten numbers passes by chance
        wrong = checked(n(14))
        wrong = wrong[:-1] + str((int(wrong[-1]) + 5) % 10)
        return [*out, wrong, f"{wrong[:4]} {wrong[4:10]} {wrong[10:]}", f"{wrong[:4]}-{wrong[4:10]}-{wrong[10:]}"], [checked(n(k)) for k in (11, 12, 13, 14, 17)]
    return [*out, " ".join(n(4) for _ in range(4))], [n(k) for k in (8, 9, 10, 11, 13)]


def examples(kind: str, spans: list[tuple[str, str, str]], around: list[str]) -> list[tuple[int, int, str, str, str]]:
    """(number of the base span, label, v, before, after) from base spans (v, before, after) and other contexts."""
    r = random.Random(kind)
    words = [w for c in around for w in re.findall("[A-Za-z]{2,}", c)]
    out = []
    if not words or kind == "ip":
        return out
    for i, (v, before, after) in enumerate(spans):
        keyword = lambda: r.choice(KEYWORDS[kind])
        marked, plain = derived(kind, v)
        rows = [(1, w, b) for w in marked for b in (before, r.choice(around))] + [(1, w, r.choice(around) + keyword()) for w in plain]
        anywhere, neutral = clean(kind, r, words)
        rows += [(0, w, b) for w in anywhere for b in (before, r.choice(around))] + [(0, w, r.choice(around)) for w in neutral if kind != "email"]
        if kind != "email":
            rows += [(0, w, r.choice(around) + keyword()) for w in anywhere]
        # only what the generator proposes as such
        out += [(i, y, w, b[-24:], after[:1]) for y, w, b in rows if re.fullmatch(WIDE[kind], w)]
    return out


class Trees:
    """Boosted trees of two levels for one kind, and the threshold on their sum."""

    def __init__(self):
        self.trees: list[tuple] = []
        self.threshold = math.inf

    def fit(self, x: np.ndarray, y: np.ndarray) -> None:
        """Gradient boosting of the logistic loss; each split is the best over all features and cuts."""
        total = np.zeros(len(y))
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-total))
            g, h = y - p, p * (1 - p)
            top = self._split(x, g, h)
            if top is None:
                break
            feature, cut = top
            sides, value = [], np.zeros(len(y))
            for mask in (x[:, feature] <= cut, x[:, feature] > cut):
                low = self._split(x[mask], g[mask], h[mask])
                f2, c2 = low if low else (0, math.inf)
                left = mask & (x[:, f2] <= c2)
                right = mask & ~left
                leaf = [0.3 * g[m].sum() / (h[m].sum() + 1.0) for m in (left, right)]
                value[left], value[right] = leaf
                sides.append((f2, c2, *leaf))
            self.trees.append((feature, cut, *sides))
            total = total + value

    @staticmethod
    def _split(x: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[int, float] | None:
        best, where = 1e-6, None
        if not len(g):
            return None
        whole = g.sum() ** 2 / (h.sum() + 1.0)
        for f in range(x.shape[1]):
            order = np.argsort(x[:, f], kind="stable")
            v, cg, ch = x[order, f], np.cumsum(g[order]), np.cumsum(h[order])
            spots = np.flatnonzero(v[1:] > v[:-1])
            if len(spots):
                gain = cg[spots] ** 2 / (ch[spots] + 1) + (cg[-1] - cg[spots]) ** 2 / (ch[-1] - ch[spots] + 1) - whole
                k = int(gain.argmax())
                if gain[k] > best:
                    best, where = float(gain[k]), (f, float((v[spots[k]] + v[spots[k] + 1]) / 2))
        return where

    def values(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        for feature, cut, *sides in self.trees:
            for (f2, c2, a, b), mask in zip(sides, (x[:, feature] <= cut, x[:, feature] > cut)):
                out[mask] += np.where(x[mask, f2] <= c2, a, b)
        return out

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """The lowest sum from which on the share of true spans reaches PRECISION, with 20 spans at least."""
        v = self.values(x)
        order = np.argsort(-v, kind="stable")
        share = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
        last = np.append(v[order][1:] < v[order][:-1], True)  # ties are taken together
        good = np.flatnonzero((share >= PRECISION) & last & (np.arange(1, len(y) + 1) >= 20))
        self.threshold = float(v[order][good[-1]]) - 1e-9 if len(good) else math.inf

    def expression(self, f: Column) -> Column:
        def at(feature: int, cut: float, low, high):
            if math.isinf(cut):
                return low
            return F.when(f[feature] <= cut, low).otherwise(high)

        total = F.lit(0.0)
        for feature, cut, left, right in self.trees:
            total = total + at(feature, cut, at(left[0], left[1], F.lit(left[2]), F.lit(left[3])), at(right[0], right[1], F.lit(right[2]), F.lit(right[3])))
        return total


def train(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> dict[str, Trees]:
    """Trees per kind from a bounded sample; a kind with too few base spans adds nothing.

    One half of the base spans fits the trees and the other, with all that is derived from it, gives the threshold.
    """
    t = F.col("t")
    some = docs.select(F.coalesce(F.col(text), F.lit("")).alias("t"), F.xxhash64(doc_id, text).alias("h"))
    some = some.where((F.octet_length("t") <= 100_000) & (may_hold("email", t) | may_hold("ip", t)))
    some = written(smallest(some, "h", SAMPLE_DOCS))
    base = some.withColumns({f"base_{k}": base_spans(k, t) for k in KINDS})
    places = some.orderBy("h").select(F.substring(t, (F.pmod("h", F.greatest(F.length(t) - 24, F.lit(1))) + 1).cast("int"), F.lit(24)).alias("c"))
    # the number or address that may stand there is taken out
    around = [c for r in places.collect() if (c := re.sub(r"\S*[0-9@+]\S*", "", r.c).strip() + " ") != " "]
    models = {}
    for kind in KINDS:
        models[kind] = Trees()
        spans = base.select("h", F.explode(f"base_{kind}").alias("c")).select("c.v", "c.before", "c.after", F.xxhash64("h", "c.s", "c.v").alias("o"))
        found = [(r.v, r.before, r.after) for r in spans.orderBy("o").limit(SAMPLE_SPANS).collect()]
        rows = examples(kind, found, around)
        if len(rows) < 80:
            continue
        made = docs.sparkSession.createDataFrame(rows, "i int, y int, v string, before string, after string")
        spot = F.struct("v", "before", "after")
        got = made.select("i", "y", F.array(*features(kind, spot)).alias("f")).collect()
        x, y, i = np.array([r.f for r in got]), np.array([r.y for r in got], np.float64), np.array([r.i for r in got])
        x[:, [FEATURES.index(f) for f in HELD_OUT[kind]]] = 0  # nothing splits on them
        aside = i % 2 == 0
        if 0 < y[~aside].sum() < (~aside).sum():
            models[kind].fit(x[~aside], y[~aside])
            models[kind].calibrate(x[aside], y[aside])
    return models


def proposed(order: int, kind: str, model: Trees, text: Column) -> Column:
    """Candidates that the trees select and that overlap no base span."""
    free = let(bounded(F.col("base")), lambda groups: F.filter(candidates(kind, text), lambda x: ~meets(groups, x)))
    scored = F.transform(
        free,
        lambda x: F.struct(
            F.lit(order).alias("order"), F.lit(kind).alias("kind"), x.s.alias("s"), x.e.alias("e"), x.v.alias("v"), model.expression(x.f).alias("score")
        ),
    )
    return F.filter(scored, lambda x: x.score >= model.threshold)


def scan(docs: DataFrame, models: dict[str, Trees], text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns of ``keep`` (default: all), ``base`` and ``added``: arrays of (kind, s, e, v).

    Both are ordered by kind as listed, then start. An added span overlaps no base span, and of
    added spans that overlap each other the one with the highest score stays, then the first. Whole
    texts are read; null counts as empty and has no spans. A result column replaces an input column
    of the same name.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("base", "added")]
    t = F.col("_text")
    row = F.struct(*keep).alias("_row") if keep else F.lit(None).alias("_row")
    out = docs.select(row, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    out = out.withColumns({f"_base_{k}": base_spans(k, t) for k in KINDS})
    named = lambda k, i: F.transform(f"_base_{k}", lambda x: F.struct(F.lit(i).alias("order"), F.lit(k).alias("kind"), x.s.alias("s"), x.e.alias("e"), x.v.alias("v")))
    out = out.withColumn("base", F.concat(*[named(k, i) for i, k in enumerate(KINDS)]))
    proposals = []
    for i, kind in enumerate(KINDS):
        if models[kind].trees and not math.isinf(models[kind].threshold):
            proposals.append(proposed(i, kind, models[kind], t))
    if not proposals:
        added = F.filter(F.transform("base", lambda x: x), lambda _: F.lit(False))
    else:
        out = out.withColumn("_new", F.concat(*proposals) if len(proposals) > 1 else proposals[0])
        beats = lambda o, x: (o.score > x.score) | ((o.score == x.score) & (F.struct(o.order, o.s) < F.struct(x.order, x.s)))
        chosen = lambda new: let(bounded(new), lambda groups: F.filter(new, lambda x: ~meets(groups, x, lambda o: beats(o, x))))
        best = let(F.col("_new"), chosen)
        added = F.transform(best, lambda x: F.struct(x.order.alias("order"), x.kind.alias("kind"), x.s.alias("s"), x.e.alias("e"), x.v.alias("v")))
    return out.withColumn("added", added).select(*(["_row.*"] if keep else []), "base", "added")


def joined(spans: Column) -> Column:
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x.order.alias("order"), x.s.alias("s"), x.e.alias("e"), x.kind.alias("kind"))))
    return F.array_join(F.transform(ordered, lambda x: F.concat_ws(":", x.kind, x.s.cast("string"), x.e.cast("string"))), ",")


def redact(docs: DataFrame, models: dict[str, Trees], text: str = "text", out: str = "redacted") -> DataFrame:
    """All columns, with the base and added spans of the text replaced by their kind in brackets.

    A null or empty text becomes an empty one; repeated rows stay as they are; an empty table gives an
    empty result. Columns may have any names; one named ``out`` is replaced.
    """
    keep = [c for c in docs.columns if c != out]
    rows = docs.select(F.struct(*keep).alias("_kept"), F.col(text).alias("_whole"))
    found = scan(rows, models, "_whole")
    spans = F.array_sort(F.transform(F.concat("base", "added"), lambda x: F.struct(x.s.alias("s"), x.e.alias("e"), x.kind.alias("kind"))))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    whole = F.coalesce(F.col("_whole"), F.lit(""))

    def add(acc, x):  # a span inside one already replaced adds nothing
        gap = F.substring(whole, (acc.at + 1).cast("int"), (x.s - acc.at).cast("int"))
        return F.when(x.s < acc.at, F.struct(F.greatest(acc.at, x.e).alias("at"), acc.out.alias("out"))).otherwise(
            F.struct(x.e.alias("at"), F.concat(acc.out, gap, F.lit("["), x.kind, F.lit("]")).alias("out"))
        )

    rest = lambda acc: F.concat(acc.out, F.substring(whole, (acc.at + 1).cast("int"), F.length(whole)))
    return found.select("_kept", F.aggregate(spans, start, add, rest).alias("_done")).select("_kept.*", F.col("_done").alias(out))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = scan(docs, train(docs), keep=["doc_id"])
    number = lambda kind: F.size(F.filter("base", lambda x: x.kind == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(number, KINDS), F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(F.concat("base", "added")).alias("spans")
    )
