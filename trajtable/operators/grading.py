"""Grading jobs: verdict columns over a generations table, and tables of tool calls and code blocks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajtable.functions import answers as an
from trajtable.functions.divergence import let
from trajtable.operators.validation import rows_n

# fixed values: patterns and windows of the graders
CLIP = 300
STRICT_CLIP = 100
HASH = r"#### (\-?[0-9\.\,]+)"
NUMBER = r"(\-?[0-9\.\,]+)"
ANSWER_LINE = r"(?i)Answer\s*:\s*([^\n]+)"
CHAIN = r"The answer is: (.+)$"
CHOICE_BOX = r"\\boxed\{\s*\(?\s*([A-Ja-j])\s*\)?\s*\}"
CHOICE_WORD = (
    r"(?i)(?:final\s+answer|correct\s+answer|correct\s+option|answer|option|choice)"
    r"\b[\s:*]*(?:is|=)?[\s:*]*\(?\s*([A-Ja-j])\b"
)
CHOICE_PAREN = r"\(\s*([A-Ja-j])\s*\)"
ANSWER_TAG = r"(?s)<answer>(.*?)</answer>"
TAG_LAYOUTS = {
    "response": r"(?s)^<think>.*?</think>\n<response>.*?</response>$",
    "tool": r"(?s)^<think>.*?</think>\n<tool_call>\n.*?\n</tool_call>$",
    "both": r"(?s)^<think>.*?</think>\n<tool_call>\n.*?\n</tool_call>\n<response>.*?</response>$",
    "think": r"(?s)^<think>.*?</think>$",
}
THINK_BOX = r"(?s)^<think>.*</think>.*\\boxed\{.*\}.*$"
PHRASES_AFTER = ("answer:", "answer is", "answers are")
PHRASES_BEFORE = ("is answer", "is the answer", "are answers", "are the answers")
TRAILING = ("be ", "is ", "are ", "=", ": ", "get ", "be\n", "is\n", "are\n", ":\n", "get\n")
CODE_BLOCK = r"(?s)```(?:python)?\n(.*?)```"
JSON_CALL = r"(?s)<tool_call>(.*?)</tool_call>"
CHANNEL_THOUGHT = r"(?s)(<\|start\|>assistant)?<\|channel\|>analysis<\|message\|>.*?<\|end\|>"
CHANNEL_CALL = (
    r"(?s)<\|start\|>assistant<\|channel\|>[^<]* to=functions\.([^<]+) <\|constrain\|>json<\|message\|>(.*?)<\|call\|>"
)
BRACE_CALL = r"(?s)<\|tool_call>call:(\w+)\{(.*?)\}<tool_call\|>"
BRACE_ARG = r'(\w+):(?:<\|"\|>(.*?)<\|"\|>|([^,}]*))'


def verdict(ok: Column) -> Column:
    return F.when(F.coalesce(ok, F.lit(False)), 1.0).otherwise(0.0)


def hash_score(text: Column, truth: Column, method: str = "strict", format_score: float = 0.0) -> Column:
    """Last ``#### n`` (strict) or last number (flexible) of the text's end; no answer gives 0."""
    end = an.tail(text, CLIP)
    if method == "strict":
        found = F.replace(F.replace(an.last_group(end, HASH), F.lit(","), F.lit("")), F.lit("$"), F.lit(""))
    elif method == "flexible":
        every = F.regexp_extract_all(end, F.lit(NUMBER), F.lit(1))
        usable = F.filter(every, lambda x: ~x.isin("", "."))
        found = F.coalesce(an.last(usable), F.get(every, F.lit(0)))
    else:
        raise ValueError(f"unknown method {method}")
    return F.when(found.isNull(), 0.0).when(found == truth, 1.0).otherwise(float(format_score))


def answer_line(text: Column, truth: Column) -> dict[str, Column]:
    """Last ``Answer:`` line against the truth, both rewritten."""
    found = F.coalesce(an.last_group(an.tail(text, CLIP), ANSWER_LINE), F.lit("[INVALID]"))
    pred = an.line_text(found)
    ok = pred == an.line_text(truth)
    return {"score": F.when(ok, 1.0).otherwise(-1.0), "acc": ok, "pred": pred}


def boxed_score(text: Column, truth: Column) -> Column:
    return verdict(an.boxed_equal(an.last_boxed(text), truth))


def strict_box(text: Column, truth: Column) -> Column:
    """Box in the last hundred characters, compared as it stands: 1 or -1."""
    return F.when(F.coalesce(an.last_boxed(an.tail(text, STRICT_CLIP)) == truth, F.lit(False)), 1).otherwise(-1)


def three_level(text: Column, truth: Column) -> Column:
    """-1 without a box, -0.5 for a wrong one, 1 for a right one (undecided counts as wrong)."""
    found = F.when(text.contains(an.BOX), an.balanced(an.after_last(text, an.BOX)))
    same = an.numeric_equal(an.canonical_answer(found), an.canonical_answer(truth))
    return F.when(found.isNull(), -1.0).when(F.coalesce(same, F.lit(False)), 1.0).otherwise(-0.5)


def choice(text: Column) -> Column:
    """Chosen letter: last boxed one, else after an answer word, else in parentheses."""
    return F.upper(F.coalesce(*[an.last_group(text, p) for p in (CHOICE_BOX, CHOICE_WORD, CHOICE_PAREN)]))


def choice_correct(text: Column, truth: Column) -> Column:
    want = F.substring(F.upper(F.trim(truth)), 1, 1)
    return F.coalesce((want != "") & (choice(text) == want), F.lit(False))


def tagged_answer(text: Column) -> Column:
    return F.trim(an.last_group(text, ANSWER_TAG), F.lit(" \n\t\r"))


def qa_exact(text: Column, gold: Column, format_score: float = 0.0) -> Column:
    """Any gold answer equals the last tagged answer; a quarter when tags are repeated more than ten times."""
    many = (an.count_of(text, "<answer>") > 10) | (an.count_of(text, "</answer>") > 10)
    hit = F.when(many, 0.25).otherwise(1.0)

    def score(pred: Column) -> Column:
        right = F.exists(gold, lambda g: an.qa_text(g) == pred)
        return F.when(pred.isNull(), 0.0).when(right, hit).otherwise(float(format_score))

    return let(an.qa_text(tagged_answer(text)), score)


def qa_contains(text: Column, gold: Column, format_score: float = 0.0) -> Column:
    def score(pred: Column) -> Column:
        inside = F.exists(gold, lambda g: pred.contains(an.qa_text(g)))
        return F.when(pred.isNull(), 0.0).when(inside, 1.0).otherwise(float(format_score))

    return let(an.qa_text(tagged_answer(text)), score)


def tag_format(text: Column, reference: Column, high: float = 1.0, low: float = 0.0) -> Column:
    """The layout the reference answer implies, with each tag exactly once."""
    once = lambda tag: (an.count_of(text, f"<{tag}>") == 1) & (an.count_of(text, f"</{tag}>") == 1)
    reply, tool = reference.contains("<response>"), reference.contains("<tool_call>")
    ok = (
        F.when(reply & ~tool, text.rlike(TAG_LAYOUTS["response"]) & once("response"))
        .when(~reply & tool, text.rlike(TAG_LAYOUTS["tool"]) & once("tool_call"))
        .when(reply & tool, text.rlike(TAG_LAYOUTS["both"]) & once("tool_call") & once("response"))
        .otherwise(text.rlike(TAG_LAYOUTS["think"]))
    )
    return F.when(ok, high).otherwise(low)


def think_box(text: Column, truth: Column, share: float = 0.1) -> Column:
    """Accuracy of the box plus a share for thinking before it."""
    ok = an.boxed_equal(an.last_boxed(text), truth)
    return (1.0 - share) * verdict(ok) + share * verdict(text.rlike(THINK_BOX))


def phrase_answers(df: DataFrame, text: str) -> DataFrame:
    """Cut the answer out of running text (``answer``); ``matched`` when a phrase hit and it holds a digit.

    Every cut is a projection of its own, so no text is searched twice.
    """
    blank = F.lit(" \n\t\r")
    s = F.col("answer")

    def hit(rows: DataFrame, cond: Column, new: Column, counts: bool = True) -> DataFrame:
        found = F.col("matched") | cond if counts else F.col("matched")
        return rows.withColumns({"matched": found, "answer": F.when(cond, F.trim(new, blank)).otherwise(s)})

    rest = lambda mark: F.length(an.after_last(F.lower(s), mark))
    rows = df.withColumns({"answer": F.col(text), "matched": F.lit(False)})
    for mark in PHRASES_AFTER:
        rows = hit(rows, F.lower(s).contains(mark), F.right(s, rest(mark)))
    for mark in PHRASES_BEFORE:
        rows = hit(rows, F.lower(s).contains(mark), F.left(s, F.length(s) - rest(mark) - len(mark)))
    rows = rows.withColumn("_box", an.boxed_or_framed(s))
    rows = hit(rows, F.coalesce("_box", F.lit("")) != "", F.col("_box")).drop("_box")
    rows = hit(rows, s.contains(". "), F.left(s, F.length(s) - rest(". ") - 2), counts=False)
    for mark in TRAILING:
        rows = hit(rows, F.lower(s).contains(mark), F.right(s, rest(mark)))
    return rows.withColumn("matched", F.col("matched") & s.rlike("[0-9]"))


def chain(text: Column, truth: Column) -> Column:
    """Boxed answer or closing sentence: right, wrong, or open where only algebra could decide (scores 0)."""
    box = F.when(text.contains(an.BOX), an.balanced(an.after_last(text, an.BOX)))
    said = F.nullif(F.regexp_extract(text, CHAIN, 1), F.lit(""))
    want = an.canonical_answer(truth)
    test = lambda v: F.when(v.isNull(), "none").otherwise(
        let(an.numeric_equal(an.canonical_answer(v), want), lambda ok: F.when(ok.isNull(), "open").when(ok, "right").otherwise("wrong"))
    )
    both = F.array(let(box, test), let(said, test))
    outcome = lambda b: F.when(F.array_contains(b, "right"), "right").when(F.array_contains(b, "open"), "open").otherwise("wrong")
    return let(both, outcome)


def elements(text: Column) -> Column:
    """Entries of a tuple, interval or list, without brackets."""
    inner = F.when(text.rlike(r"^[\(\[].*[\)\]]$"), F.substring(text, F.lit(2), F.length(text) - 2)).otherwise(text)
    return F.transform(F.split(inner, ","), lambda x: F.trim(x))


def element_equal(pred: Column, truth: Column, rel: float = 1e-4) -> Column:
    """Same brackets, same length, entries equal one by one."""
    shape = lambda s: F.when(s.rlike(r"^[\(\[].*[\)\]]$"), F.concat(F.left(s, F.lit(1)), F.right(s, F.lit(1)))).otherwise("")
    def pairs(a: Column, b: Column) -> Column:
        same = F.zip_with(a, b, lambda x, y: F.coalesce(an.numeric_equal(x, y, rel), F.lit(False)))
        return (F.size(a) == F.size(b)) & F.forall(same, lambda ok: ok)

    return (shape(pred) == shape(truth)) & let(elements(pred), lambda a: let(elements(truth), lambda b: pairs(a, b)))


def element_multiset(text: Column, digits: int = 8) -> Column:
    """Sorted entries with plus-minus expanded and numbers rounded: equal arrays are equal multisets."""
    spread = F.flatten(F.transform(elements(text), lambda x: F.when(
        x.contains("\\pm"), F.array(F.replace(x, F.lit("\\pm"), F.lit("+")), F.replace(x, F.lit("\\pm"), F.lit("-")))
    ).otherwise(F.array(x))))
    bare = F.transform(spread, lambda x: an.replace(x, " ", ""))
    canon = F.transform(bare, lambda x: F.coalesce(F.round(an.number_of(x), digits).cast("string"), x))
    return F.sort_array(canon)


def answer_votes(df: DataFrame, answer: Column, keys: Sequence[str], index: str) -> DataFrame:
    """Votes per canonical answer and the majority per prompt (ties: the one given first)."""
    votes = df.withColumn("_canon", answer).where(F.col("_canon").isNotNull()).groupBy(*keys, "_canon").agg(
        rows_n().alias("_n"), F.min(index).alias("_first")
    )
    best = F.struct(F.col("_n"), -F.col("_first"))
    return votes.groupBy(*keys).agg(
        F.max_by("_canon", best).alias("majority"), F.max("_n").alias("votes"), F.sum("_n").alias("answered"),
        (F.max("_n") / F.sum("_n")).alias("agreement"),
    )


def routed(df: DataFrame, source: Column, scorers: Mapping[str, Column], table: Mapping[str, str]) -> DataFrame:
    """One verdict per row by data source; unknown sources become error rows."""
    rule = F.try_element_at(F.create_map(*[F.lit(x) for p in table.items() for x in p]), source)
    score = None
    for name, column in scorers.items():
        score = score.when(rule == name, column) if score is not None else F.when(rule == name, column)
    return df.withColumns({"rule": rule, "score": score, "error": F.when(rule.isNull(), F.concat(F.lit("no scorer for "), source))})


def accuracy(df: DataFrame, keys: Sequence[str], score: str = "score") -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(F.col(score)).alias("accuracy"), rows_n().alias("n"))


# --- tool calls ----------------------------------------------------------------------------------


def json_calls(df: DataFrame, text: str, *keep: str) -> tuple[DataFrame, DataFrame]:
    """JSON-tag dialect: rows per decodable call, and per response the remaining text and counts."""
    found = F.regexp_extract_all(F.col(text), F.lit(JSON_CALL), F.lit(1))
    parsed = F.transform(found, lambda x: F.from_json(x, "struct<name:string,arguments:string>"))
    good = F.filter(parsed, lambda c: c["name"].isNotNull() & c["arguments"].isNotNull())
    rows = df.withColumns({"_found": F.size(found), "_calls": good})
    calls = rows.select(*keep, F.posexplode("_calls").alias("call_no", "_c")).select(
        *keep, "call_no", F.col("_c.name").alias("name"), F.col("_c.arguments").alias("args")
    )
    rest = rows.select(
        *keep, F.regexp_replace(F.col(text), JSON_CALL, "").alias("content"), F.size("_calls").alias("n_calls"),
        (F.col("_found") - F.size("_calls")).alias("n_bad"),
    )
    return calls, rest


def pattern_calls(df: DataFrame, text: Column, pattern: str, *keep: str) -> DataFrame:
    """Rows (call_no, name, args) for a pattern with a name and an argument group."""
    group = lambda g: F.regexp_extract_all(text, F.lit(pattern), F.lit(g))
    pairs = F.arrays_zip(group(1).alias("name"), group(2).alias("args"))
    return df.select(*keep, F.posexplode(pairs).alias("call_no", "_c")).select(*keep, "call_no", "_c.name", "_c.args")


def channel_calls(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """Channel-tag dialect; calls inside the thinking channel do not count."""
    return pattern_calls(df, F.regexp_replace(F.col(text), CHANNEL_THOUGHT, ""), CHANNEL_CALL, *keep)


def json_text(value: Column) -> Column:
    """A text as a JSON string."""
    whole = F.to_json(F.array(value))
    return F.substring(whole, F.lit(2), F.length(whole) - 2)


def brace_arguments(args: Column) -> Column:
    """``k:<|"|>text<|"|>,n:1`` as a JSON object."""
    group = lambda g: F.regexp_extract_all(args, F.lit(BRACE_ARG), F.lit(g))

    def cell(whole: Column, key: Column, quoted: Column, bare: Column) -> Column:
        b = F.trim(bare)
        low = F.lower(b)
        value = (
            F.when(whole.contains('<|"|>'), json_text(quoted)).when(low.isin("true", "false", "null"), low)
            .when(b.rlike(r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?$"), b).otherwise(json_text(b))
        )
        return F.concat(json_text(key), F.lit(":"), value)

    zipped = F.arrays_zip(group(0).alias("w"), group(1).alias("k"), group(2).alias("q"), group(3).alias("b"))
    return F.concat(F.lit("{"), F.array_join(F.transform(zipped, lambda z: cell(z.w, z.k, z.q, z.b)), ","), F.lit("}"))


def brace_calls(df: DataFrame, text: str, *keep: str) -> DataFrame:
    return pattern_calls(df, F.col(text), BRACE_CALL, *keep).withColumn("args", brace_arguments(F.col("args")))


def xml_params(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """XML dialect: one row per parameter of every call; one leading and trailing line break is cut."""
    calls = F.regexp_extract_all(F.col(text), F.lit(JSON_CALL), F.lit(1))
    body = F.flatten(F.transform(calls, lambda c: F.regexp_extract_all(c, F.lit(r"(?s)<function=(.*?)</function>"), F.lit(1))))
    rows = df.select(*keep, F.posexplode(body).alias("call_no", "_f"))
    rows = rows.withColumns({"name": F.substring_index("_f", ">", 1), "_p": F.regexp_extract_all("_f", F.lit(r"(?s)<parameter=(.*?)</parameter>"), F.lit(1))})
    params = rows.select(*keep, "call_no", "name", F.posexplode("_p").alias("param_no", "_p"))
    value = F.regexp_replace(F.regexp_replace(F.col("_p"), r"(?s)^[^>]*>", ""), r"(?s)^\n|\n$", "")
    return params.select(*keep, "call_no", "name", "param_no", F.substring_index("_p", ">", 1).alias("param"), value.alias("raw"))


def typed_params(params: DataFrame, schema: DataFrame) -> DataFrame:
    """Cast parameter texts by the tool schema (name, param, type); the result is JSON text.

    null stays null; integers, numbers and JSON fall back to the text; anything but true is false
    for booleans; parameters outside the schema are texts.
    """
    rows = params.join(schema, ["name", "param"], "left")
    raw, kind = F.col("raw"), F.lower(F.trim("type"))
    text = json_text(raw)
    whole = F.when(F.trim(raw).rlike(r"^[+-]?[0-9]+$"), F.trim(raw).cast("decimal(38,0)").cast("string"))
    number = F.when(F.trim(raw).rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), F.trim(raw).try_cast("double"))
    floating = F.when(number == F.floor(number), number.cast("decimal(38,0)").cast("string")).otherwise(number.cast("string"))
    structured = F.when(raw.rlike(r"(?s)^\s*[\[{].*[\]}]\s*$"), F.get_json_object(raw, "$"))
    value = (
        F.when(F.lower(raw) == "null", "null")
        .when(kind.isNull() | kind.isin("string", "str", "text", "varchar", "char", "enum"), text)
        .when(kind.rlike("^(int|uint|long|short|unsigned)"), F.coalesce(whole, text))
        .when(kind.rlike("^(num|float)"), F.coalesce(floating, text))
        .when(kind.isin("boolean", "bool", "binary"), F.when(F.lower(raw) == "true", "true").otherwise("false"))
        .otherwise(F.coalesce(structured, text))
    )
    return rows.withColumn("value", value).drop("raw", "type")


def overlap(a: Column, b: Column) -> Column:
    """Multiset Jaccard of two arrays of texts."""
    count = lambda xs, v: F.size(F.filter(xs, lambda x: x == v))
    shared = F.aggregate(F.array_distinct(a), F.lit(0), lambda s, v: s + F.least(count(a, v), count(b, v)))
    return F.when(a == b, 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(
        let(shared, lambda s: s / (F.size(a) + F.size(b) - s))
    )


def compare_calls(truth: Column, pred: Column, high: float = 1.0, low: float = 0.0) -> Column:
    """Score of predicted against reference calls, scaled to [low, high].

    Calls are arrays of (name, params map). Every reference call takes the best unused prediction of
    its name (parameter overlap plus equal values); each prediction is used once.
    """
    names = lambda calls: F.transform(calls, lambda c: c["name"])
    plain = lambda calls: F.transform(calls, lambda c: F.struct(c["name"], F.array_sort(F.map_entries(c["params"]))))

    def gain(ref: Column, cand: Column) -> Column:
        same = F.size(F.filter(F.map_entries(ref["params"]), lambda e: F.coalesce(F.try_element_at(cand["params"], e.key) == e.value, F.lit(False))))
        return overlap(F.map_keys(ref["params"]), F.map_keys(cand["params"])) + same

    start = F.struct(F.lit(0.0).alias("score"), F.array().cast("array<int>").alias("used"))

    def step(s: Column, ref: Column) -> Column:
        scores = F.transform(pred, lambda c, i: F.when(
            (c["name"] == ref["name"]) & ~F.array_contains(s["used"], i), gain(ref, c)
        ).otherwise(0.0))

        def pick(xs: Column) -> Column:
            best = F.coalesce(F.array_max(xs), F.lit(0.0))
            at = (F.array_position(xs, best) - 1).cast("int")
            return F.when(best > 0, F.struct((s["score"] + best).alias("score"), F.concat(s["used"], F.array(at)).alias("used"))).otherwise(s)

        return let(scores, pick)

    total = overlap(names(truth), names(pred)) + F.aggregate(truth, start, step)["score"]
    most = F.aggregate(truth, F.lit(1.0), lambda a, c: a + 1.0 + F.size(c["params"]))
    return F.when(plain(truth) == plain(pred), float(high)).otherwise((high - low) * total / most + low)


def code_block(text: Column) -> Column:
    """Last fenced block, else the whole text."""
    return F.coalesce(an.last_group(text, CODE_BLOCK), text)


def code_block_strict(text: Column) -> dict[str, Column]:
    """Block after the last python fence, else the first plain one without its language line; none is an error."""
    named = F.substring_index(an.after_last(text, "```python"), "```", 1)
    plain = F.split(text, "```", -1)[1]
    first = F.substring_index(plain, "\n", 1)
    stripped = F.when(plain.contains("\n") & F.trim(first).rlike(r"^\p{L}+$"), F.substring(plain, F.length(first) + 2, F.length(plain))).otherwise(plain)
    return {
        "solution": F.when(text.contains("```python"), named).when(text.contains("```"), stripped),
        "error": F.when(~text.contains("```"), F.lit("missing code block")),
    }
