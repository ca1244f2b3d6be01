"""Grading jobs and tool-call tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajtable.functions import answers as an
from trajtable.functions import rules
from trajtable.operators import grading as gr
from trajtable.plans.catalog.base import csv, query, r6
from trajtable.plans.catalog.corrections import rounded
from trajtable.sources import tables as src

GEN = ("generations",)


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_rules(expr: str, ruleset) -> str:
    for kind, old, new in ruleset:
        if kind == "text":
            expr = f"replace({expr}, {_q(old)}, {_q(new)})"
        else:
            new = new.replace(r"\$", "\0").replace("$", "\\").replace("\0", "$")
            expr = f"regexp_replace({expr}, {_q(old)}, {_q(new)}, 'g')"
    return expr


@query(
    "grade_hash",
    r"""WITH h AS (SELECT gen_id, truth, replace(replace(regexp_extract_all(right(hash_text, 300), '#### (\-?[0-9\.\,]+)', 1)[-1], ',', ''), '$', '') AS strict,
  list_filter(regexp_extract_all(right(line_text || ' .', 300), '(\-?[0-9\.\,]+)', 1), lambda x: x NOT IN ('', '.'))[-1] AS flex FROM generations)
SELECT gen_id, CASE WHEN strict = truth THEN 1.0 ELSE 0.0 END::DOUBLE AS strict, CASE WHEN flex IS NULL THEN 0.0 WHEN flex = truth THEN 1.0 ELSE 0.1 END::DOUBLE AS flexible FROM h""",
    GEN,
)
def grade_hash(spark, d):
    return src.generations(spark, d).select(
        "gen_id", gr.hash_score(F.col("hash_text"), F.col("truth")).alias("strict"),
        gr.hash_score(F.concat("line_text", F.lit(" .")), F.col("truth"), "flexible", 0.1).alias("flexible"),
    )


LINE_SQL = "split_part({}, '=', -1)"


def _line_sql(expr: str) -> str:
    s = _sql_rules(f"split_part({expr}, '=', -1)", rules.LINE_RULES)
    return f"trim(CASE WHEN regexp_full_match(replace({s}, ',', ''), '[0-9]+') THEN replace({s}, ',', '') ELSE {s} END)"


LINE_TRUTH = "CASE gen_id % 4 WHEN 0 THEN truth || ' km' WHEN 1 THEN '\\text{' || truth || '}' WHEN 2 THEN 'x=' || truth ELSE truth END"


@query(
    "grade_answer_line",
    f"""WITH h AS (SELECT gen_id, {LINE_TRUTH} AS truth, coalesce(regexp_extract_all(right(line_text, 300), '(?i)Answer\\s*:\\s*([^\\n]+)', 1)[-1], '[INVALID]') AS found FROM generations),
k AS (SELECT gen_id, {_line_sql("found")} AS pred, {_line_sql("truth")} AS want FROM h)
SELECT gen_id, pred, pred = want AS acc, CASE WHEN pred = want THEN 1.0 ELSE -1.0 END::DOUBLE AS score FROM k""",
    GEN,
)
def grade_answer_line(spark, d):
    g, t = F.col("gen_id") % 4, F.col("truth")
    truth = F.when(g == 0, F.concat(t, F.lit(" km"))).when(g == 1, F.concat(F.lit("\\text{"), t, F.lit("}"))).when(g == 2, F.concat(F.lit("x="), t)).otherwise(t)
    rows = src.generations(spark, d).withColumn("truth", truth)
    out = gr.answer_line(F.col("line_text"), F.col("truth"))
    return rows.select("gen_id", out["pred"].alias("pred"), out["acc"].alias("acc"), out["score"].alias("score"))


BOX_TRUTH = "CASE gen_id % 3 WHEN 0 THEN '\\dfrac{' || truth || '}{7}' WHEN 1 THEN '\\frac{ ' || truth || ' }{7}\\%' ELSE truth || '/7' END"


@query(
    "grade_boxed",
    f"""WITH h AS (SELECT gen_id, '\\frac{{' || (gen_id * 37 + gen_id % 3) % 1000 || '}}{{7}}' AS pred, {BOX_TRUTH} AS raw,
  CASE WHEN gen_id % 3 = 2 AND truth = '0' THEN '0/7' ELSE NULL END AS z, truth FROM generations)
SELECT gen_id, pred AS boxed, CASE WHEN pred = '\\frac{{' || truth || '}}{{7}}' THEN 1.0 ELSE 0.0 END::DOUBLE AS score,
  CASE WHEN pred = raw THEN 1 ELSE -1 END AS strict FROM h""",
    GEN,
)
def grade_boxed(spark, d):
    g, t = F.col("gen_id") % 3, F.col("truth")
    truth = F.when(g == 0, F.concat(F.lit("\\dfrac{"), t, F.lit("}{7}"))).when(g == 1, F.concat(F.lit("\\frac{ "), t, F.lit(" }{7}\\%"))).otherwise(F.concat(t, F.lit("/7")))
    rows = src.generations(spark, d).withColumn("want", truth)
    return rows.select(
        "gen_id", an.last_boxed(F.col("boxed_text")).alias("boxed"), gr.boxed_score(F.col("boxed_text"), F.col("want")).alias("score"),
        gr.strict_box(F.col("boxed_text"), F.col("want")).alias("strict"),
    )


VOTE_RAW = "CASE gen_id % 5 WHEN 0 THEN v || '.0' WHEN 1 THEN v || ' cm' WHEN 2 THEN '\\text{' || v || '}' WHEN 3 THEN '$' || v || '$' ELSE '{' || v || '}' END"


@query(
    "answer_votes",
    """WITH h AS (SELECT gen_id, item_id, ((gen_id // 40) % 4 + 1)::VARCHAR AS v FROM generations),
n AS (SELECT item_id, v, count(*) AS n, min(gen_id) AS f FROM h GROUP BY item_id, v),
r AS (SELECT *, sum(n) OVER (PARTITION BY item_id) AS total, row_number() OVER (PARTITION BY item_id ORDER BY n DESC, f) AS rk FROM n)
SELECT item_id, v AS majority, n AS votes, total::BIGINT AS answered, round(n / total, 6) + 0.0 AS agreement FROM r WHERE rk = 1""",
    GEN,
)
def answer_votes(spark, d):
    """Five spellings of the same small numbers, voted per item."""
    g = F.col("gen_id") % 5
    v = (F.floor(F.col("gen_id") / 40) % 4 + 1).cast("string")
    raw = (
        F.when(g == 0, F.concat(v, F.lit(".0"))).when(g == 1, F.concat(v, F.lit(" cm"))).when(g == 2, F.concat(F.lit("\\text{"), v, F.lit("}")))
        .when(g == 3, F.concat(F.lit("$"), v, F.lit("$"))).otherwise(F.concat(F.lit("{"), v, F.lit("}")))
    )
    rows = src.generations(spark, d).withColumn("raw", raw)
    return rounded(gr.answer_votes(rows, an.canonical_answer(F.col("raw")), ["item_id"], "gen_id"), "item_id", "majority", "votes", "answered")


@query(
    "grade_numeric",
    """WITH h AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS t, CASE l_linenumber % 4 WHEN 0 THEN l_extendedprice * (1 + l_discount / 1000) WHEN 1 THEN l_extendedprice / 100
  WHEN 2 THEN l_extendedprice * 100 ELSE l_extendedprice + 7 END AS p FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, abs(t - p) <= 1e-4 * greatest(abs(t), abs(p)) OR abs(t / 100 - p) <= 1e-4 * greatest(abs(t / 100), abs(p))
  OR abs(t * 100 - p) <= 1e-4 * greatest(abs(t * 100), abs(p)) AS equal FROM h""",
)
def grade_numeric(spark, d):
    k, t = F.col("l_linenumber") % 4, F.col("l_extendedprice")
    p = F.when(k == 0, t * (1 + F.col("l_discount") / 1000)).when(k == 1, t / 100).when(k == 2, t * 100).otherwise(t + 7)
    text = F.when(k == 3, F.concat(F.lit("$"), p.cast("decimal(30,12)").cast("string"))).otherwise(p.cast("decimal(30,12)").cast("string"))
    rows = src.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", text.alias("pred"), t.cast("decimal(30,12)").cast("string").alias("truth"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", an.numeric_equal(F.col("pred"), F.col("truth")).alias("equal"))


@query(
    "grade_elements",
    """SELECT gen_id, gen_id % 4 IN (0, 3) AS ordered, gen_id % 4 IN (0, 1, 3) AS unordered FROM generations""",
    GEN,
)
def grade_elements(spark, d):
    """Same tuple, swapped tuple, other bracket with another number, and the same list with blanks."""
    g, t = F.col("gen_id") % 4, F.col("truth")
    truth = F.concat(F.lit("("), t, F.lit(", 1500, x)"))
    pred = (
        F.when(g == 0, F.concat(F.lit("("), t, F.lit(".0,1500.0,x)"))).when(g == 1, F.concat(F.lit("(x, 1500, "), t, F.lit(")")))
        .when(g == 2, F.concat(F.lit("["), t, F.lit(", 1501.5, x]"))).otherwise(F.concat(F.lit("( "), t, F.lit(" , 1500 , x )")))
    )
    rows = src.generations(spark, d).select("gen_id", pred.alias("p"), truth.alias("t"))
    # a tuple whose first two entries are equal cannot be told from its swap
    return rows.select(
        "gen_id", gr.element_equal(F.col("p"), F.col("t")).alias("ordered"),
        (gr.element_multiset(F.col("p")) == gr.element_multiset(F.col("t"))).alias("unordered"),
    )


@query(
    "grade_phrase",
    """SELECT gen_id, CASE gen_id % 4 WHEN 0 THEN n WHEN 1 THEN n WHEN 2 THEN n ELSE 'none' END AS answer, gen_id % 4 <> 3 AS matched
FROM (SELECT gen_id, ((gen_id * 37 + gen_id % 3) % 1000)::VARCHAR AS n FROM generations)""",
    GEN,
)
def grade_phrase(spark, d):
    g, n = F.col("gen_id") % 4, ((F.col("gen_id") * 37 + F.col("gen_id") % 3) % 1000).cast("string")
    text = (
        F.when(g == 0, F.concat("text", F.lit("\nThe Answer is x = "), n, F.lit(". Done"))).when(g == 1, F.concat("text", F.lit("\nANSWER: we get \\boxed{"), n, F.lit("} ok")))
        .when(g == 2, F.concat(F.lit("the value is "), n, F.lit(" is the answer to all"))).otherwise(F.concat("text", F.lit("\nanswer: none")))
    )
    rows = src.generations(spark, d).select("gen_id", text.alias("x"))
    return gr.phrase_answers(rows, "x").select("gen_id", "answer", "matched")


CHAIN_SQL = """k AS (SELECT gen_id, data_source, (gen_id * 37 + gen_id % 3) % 1000 = gen_id * 37 % 1000 AS eq, gen_id % 4 AS g FROM generations)"""


def _chain_text():
    g, n = F.col("gen_id") % 4, ((F.col("gen_id") * 37 + F.col("gen_id") % 3) % 1000).cast("string")
    return (
        F.when(g == 0, F.concat("text", F.lit("\nso \\boxed{"), n, F.lit("}"))).when(g == 1, F.concat("text", F.lit("\nThe answer is: "), n))
        .when(g == 2, F.concat("text", F.lit("\nso \\boxed{x^{2}+"), n, F.lit("}"))).otherwise(F.col("text"))
    )


@query(
    "grade_chain",
    f"""WITH {CHAIN_SQL} SELECT gen_id, CASE WHEN g IN (0, 1) AND eq THEN 'right' WHEN g = 2 THEN 'open' ELSE 'wrong' END AS outcome FROM k""",
    GEN,
)
def grade_chain(spark, d):
    return src.generations(spark, d).select("gen_id", gr.chain(_chain_text(), F.col("truth")).alias("outcome"))


@query(
    "grade_three_level",
    f"WITH {CHAIN_SQL} SELECT gen_id, CASE WHEN g IN (1, 3) THEN -1.0 WHEN g = 0 AND eq THEN 1.0 ELSE -0.5 END::DOUBLE AS score FROM k",
    GEN,
)
def grade_three_level(spark, d):
    return src.generations(spark, d).select("gen_id", gr.three_level(_chain_text(), F.col("truth")).alias("score"))


@query(
    "grade_multichoice",
    r"""WITH h AS (SELECT gen_id, truth_letter, CASE gen_id % 3 WHEN 0 THEN text || ' \boxed{ (' || lower(truth_letter) || ') }' WHEN 1 THEN choice_text ELSE text || ' so ( c ) it is' END AS x FROM generations),
m AS (SELECT gen_id, truth_letter, upper(coalesce(regexp_extract_all(x, '\\boxed\{\s*\(?\s*([A-Ja-j])\s*\)?\s*\}', 1)[-1],
  regexp_extract_all(x, '(?i)(?:final\s+answer|correct\s+answer|correct\s+option|answer|option|choice)\b[\s:*]*(?:is|=)?[\s:*]*\(?\s*([A-Ja-j])\b', 1)[-1],
  regexp_extract_all(x, '\(\s*([A-Ja-j])\s*\)', 1)[-1])) AS letter FROM h)
SELECT gen_id, letter, coalesce(letter = truth_letter, false) AS correct FROM m""",
    GEN,
)
def grade_multichoice(spark, d):
    g = F.col("gen_id") % 3
    text = F.when(g == 0, F.concat("text", F.lit(" \\boxed{ ("), F.lower("truth_letter"), F.lit(") }"))).when(g == 1, F.col("choice_text")).otherwise(
        F.concat("text", F.lit(" so ( c ) it is"))
    )
    rows = src.generations(spark, d).select("gen_id", "truth_letter", text.alias("x"))
    return rows.select("gen_id", gr.choice(F.col("x")).alias("letter"), gr.choice_correct(F.col("x"), F.col("truth_letter")).alias("correct"))


QA = r"""k AS (SELECT gen_id, truth, tag_text || CASE WHEN gen_id % 5 = 0 THEN repeat('</answer>', 12) ELSE '' END AS x FROM generations),
p AS (SELECT *, regexp_extract_all(x, '(?s)<answer>(.*?)</answer>', 1)[-1] AS a FROM k),
n AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(lower(a), '[[:punct:]]', '', 'g'), '\b(a|an|the)\b', ' ', 'g'), '\s+', ' ', 'g')) AS pred FROM p)"""


@query("grade_qa_exact", f"WITH {QA} SELECT gen_id, (CASE WHEN pred = truth THEN CASE WHEN gen_id % 5 = 0 THEN 0.25 ELSE 1.0 END ELSE 0.0 END)::DOUBLE AS score FROM n", GEN)
def grade_qa_exact(spark, d):
    text = F.concat("tag_text", F.when(F.col("gen_id") % 5 == 0, F.repeat(F.lit("</answer>"), 12)).otherwise(""))
    gold = F.array(F.lit("nothing"), F.concat(F.lit("The "), "truth", F.lit("!")))
    return src.generations(spark, d).select("gen_id", gr.qa_exact(text, gold).alias("score"))


@query("grade_qa_contains", f"WITH {QA} SELECT gen_id, (CASE WHEN contains(pred, truth) THEN 1.0 ELSE 0.1 END)::DOUBLE AS score FROM n", GEN)
def grade_qa_contains(spark, d):
    return src.generations(spark, d).select("gen_id", gr.qa_contains(F.col("tag_text"), F.array("truth"), 0.1).alias("score"))


TAG_CASES = """CASE gen_id % 6 WHEN 0 THEN '<think>' || text || E'</think>\\n<response>ok</response>' WHEN 1 THEN '<think>' || text || E'</think>\\n<tool_call>\\n{}\\n</tool_call>'
  WHEN 2 THEN '<think>' || text || E'</think>\\n<tool_call>\\n{}\\n</tool_call>\\n<response>r</response>' WHEN 3 THEN '<think>' || text || '</think>'
  WHEN 4 THEN '<think>' || text || E'</think>\\n<response>a</response><response>b</response>' ELSE text || E'</think>\\n<response>ok</response>' END"""
REF_CASES = "CASE (gen_id // 6) % 4 WHEN 0 THEN '<response>' WHEN 1 THEN '<tool_call>' WHEN 2 THEN '<tool_call> <response>' ELSE 'plain' END"


@query(
    "grade_tag_format",
    """SELECT gen_id, (CASE WHEN gen_id % 6 = (gen_id // 6) % 4 THEN 1.0 WHEN (gen_id // 6) % 4 = 3 AND gen_id % 6 = 3 THEN 1.0 ELSE 0.0 END)::DOUBLE AS score FROM generations""",
    GEN,
)
def grade_tag_format(spark, d):
    """Six layouts of the response against four kinds of reference answers."""
    g, kind = F.col("gen_id") % 6, F.floor(F.col("gen_id") / 6) % 4
    open_think = F.concat(F.lit("<think>"), "text", F.lit("</think>"))
    text = (
        F.when(g == 0, F.concat(open_think, F.lit("\n<response>ok</response>"))).when(g == 1, F.concat(open_think, F.lit("\n<tool_call>\n{}\n</tool_call>")))
        .when(g == 2, F.concat(open_think, F.lit("\n<tool_call>\n{}\n</tool_call>\n<response>r</response>"))).when(g == 3, open_think)
        .when(g == 4, F.concat(open_think, F.lit("\n<response>a</response><response>b</response>")))
        .otherwise(F.concat("text", F.lit("</think>\n<response>ok</response>")))
    )
    ref = F.when(kind == 0, "<response>").when(kind == 1, "<tool_call>").when(kind == 2, "<tool_call> <response>").otherwise("plain")
    return src.generations(spark, d).select("gen_id", gr.tag_format(text, ref).alias("score"))


@query(
    "grade_think_box",
    f"""SELECT gen_id, round((CASE WHEN (gen_id * 37 + gen_id % 3) % 1000 = gen_id * 37 % 1000 THEN 0.9 ELSE 0.0 END) + (CASE WHEN gen_id % 2 = 0 THEN 0.1 ELSE 0.0 END), 6)::DOUBLE + 0.0 AS score FROM generations""",
    GEN,
)
def grade_think_box(spark, d):
    text = F.when(F.col("gen_id") % 2 == 0, F.concat(F.lit("<think>hm</think>"), "boxed_text")).otherwise(F.col("boxed_text"))
    truth = F.concat(F.lit("\\frac{"), "truth", F.lit("}{7}"))
    return src.generations(spark, d).select("gen_id", r6(gr.think_box(text, truth)).alias("score"))


# fixed values: which rule grades which source
ROUTES = {**{f"src{i}": "hash" for i in range(5)}, **{f"src{i}": "line" for i in range(5, 10)}, **{f"src{i}": "boxed" for i in range(10, 15)}}


@query(
    "grade_route",
    """WITH k AS (SELECT *, (gen_id * 37 + gen_id % 3) % 1000 = gen_id * 37 % 1000 AS eq, substr(data_source, 4)::INT // 5 AS r FROM generations)
SELECT gen_id, CASE r WHEN 0 THEN 'hash' WHEN 1 THEN 'line' WHEN 2 THEN 'boxed' END AS rule,
  (CASE WHEN r > 2 THEN NULL WHEN eq THEN 1.0 WHEN r = 1 THEN -1.0 ELSE 0.0 END)::DOUBLE AS score, CASE WHEN r > 2 THEN 'no scorer for ' || data_source END AS error FROM k""",
    GEN,
)
def grade_route(spark, d):
    rows = src.generations(spark, d)
    scorers = {
        "hash": gr.hash_score(F.col("hash_text"), F.col("truth")),
        "line": gr.answer_line(F.col("line_text"), F.col("truth"))["score"],
        "boxed": gr.boxed_score(F.col("boxed_text"), F.concat(F.lit("\\frac{"), "truth", F.lit("}{7}"))),
    }
    return gr.routed(rows, F.col("data_source"), scorers, ROUTES).select("gen_id", "rule", "score", "error")


# --- tool calls and code -------------------------------------------------------------------------


def _calls(spark, d):
    g = F.col("gen_id").cast("string")
    good = lambda name, body: F.concat(F.lit('<tool_call>{"name":"' + name + '","arguments":{'), body, F.lit("}}</tool_call>"))
    text = F.concat(
        "text", good("calc", F.concat(F.lit('"x":'), g, F.lit(',"op":"add"'))), F.lit(" mid <tool_call>{broken</tool_call>"),
        F.when(F.col("gen_id") % 2 == 0, good("look", F.concat(F.lit('"q":"'), "lang", F.lit('"')))).otherwise(""),
    )
    return src.generations(spark, d).select("gen_id", "lang", "text", "truth", text.alias("calls"))


@query(
    "tool_call_table",
    """SELECT gen_id, 0 AS call_no, 'calc' AS name, '{"x":' || gen_id || ',"op":"add"}' AS args FROM generations
UNION ALL SELECT gen_id, 1, 'look', '{"q":"' || lang || '"}' FROM generations WHERE gen_id % 2 = 0""",
    GEN,
)
def tool_call_table(spark, d):
    calls, _ = gr.json_calls(_calls(spark, d), "calls", "gen_id")
    return calls


@query(
    "tool_call_table_rest",
    "SELECT gen_id, text || ' mid ' AS content, CASE WHEN gen_id % 2 = 0 THEN 2 ELSE 1 END AS n_calls, 1 AS n_bad FROM generations",
    GEN,
)
def tool_call_table_rest(spark, d):
    _, rest = gr.json_calls(_calls(spark, d), "calls", "gen_id")
    return rest


@query(
    "tool_call_table_channel",
    """SELECT gen_id, 0 AS call_no, 'f' || gen_id % 3 AS name, '{"v":' || gen_id || '}' AS args FROM generations""",
    GEN,
)
def tool_call_table_channel(spark, d):
    """The call inside the thinking channel is not counted."""
    g = F.col("gen_id")
    call = lambda name, args: F.concat(
        F.lit("<|start|>assistant<|channel|>commentary to=functions."), name, F.lit(" <|constrain|>json<|message|>"), args, F.lit("<|call|>")
    )
    text = F.concat(
        F.lit("<|channel|>analysis<|message|>"), "text", call(F.lit("ghost"), F.lit("{}")), F.lit("<|end|>"),
        call(F.concat(F.lit("f"), (g % 3).cast("string")), F.concat(F.lit('{"v":'), g.cast("string"), F.lit("}"))),
    )
    return gr.channel_calls(src.generations(spark, d).select("gen_id", text.alias("x")), "x", "gen_id")


@query(
    "tool_call_table_braces",
    """SELECT gen_id, 0 AS call_no, 'find' AS name, '{"q":"' || lang || ', x","n":' || gen_id || ',"deep":true,"w":"ab"}' AS args FROM generations""",
    GEN,
)
def tool_call_table_braces(spark, d):
    text = F.concat(
        "text", F.lit('<|tool_call>call:find{q:<|"|>'), "lang", F.lit(', x<|"|>,n:'), F.col("gen_id").cast("string"), F.lit(",deep:True,w: ab}<tool_call|>")
    )
    return gr.brace_calls(src.generations(spark, d).select("gen_id", text.alias("x")), "x", "gen_id")


@query(
    "tool_call_typed",
    """WITH g AS (SELECT gen_id, lang FROM generations) SELECT gen_id, 0 AS call_no, 'set' AS name, p AS param,
  CASE p WHEN 'n' THEN gen_id::VARCHAR WHEN 'f' THEN gen_id || '.5' WHEN 'ok' THEN CASE WHEN gen_id % 2 = 0 THEN 'true' ELSE 'false' END
    WHEN 'o' THEN '{"a":' || gen_id || '}' WHEN 's' THEN '"' || lang || '"' WHEN 'nil' THEN 'null' WHEN 'bad' THEN '"x' || gen_id || '"' ELSE '"' || gen_id || '"' END AS value
FROM g, (SELECT unnest(['n', 'f', 'ok', 'o', 's', 'nil', 'bad', 'free']) AS p)""",
    GEN,
)
def tool_call_typed(spark, d):
    g = F.col("gen_id").cast("string")
    cell = lambda name, value: F.concat(F.lit(f"<parameter={name}>\n"), value, F.lit("\n</parameter>"))
    flag = F.when(F.col("gen_id") % 2 == 0, "True").otherwise("yes")
    body = F.concat(
        cell("n", g), cell("f", F.concat(g, F.lit(".5"))), cell("ok", flag), cell("o", F.concat(F.lit('{"a":'), g, F.lit("}"))),
        cell("s", F.col("lang")), cell("nil", F.lit("NULL")), cell("bad", F.concat(F.lit("x"), g)), cell("free", g),
    )
    text = F.concat("text", F.lit("<tool_call>\n<function=set>\n"), body, F.lit("\n</function>\n</tool_call>"))
    params = gr.xml_params(src.generations(spark, d).select("gen_id", text.alias("x")), "x", "gen_id")
    kinds = {"n": "integer", "f": "number", "ok": "boolean", "o": "object", "s": "string", "nil": "string", "bad": "int"}
    schema = spark.createDataFrame([("set", k, v) for k, v in kinds.items()], "name string, param string, type string")
    return gr.typed_params(params, schema).select("gen_id", "call_no", "name", "param", "value")


@query(
    "tool_call_compare",
    """SELECT gen_id, round(CASE gen_id % 4 WHEN 0 THEN 3.0 WHEN 1 THEN 6.0 * (1 + (1 + 1) + (1 + 1)) / 6 - 3 WHEN 2 THEN 6.0 * (1.0 / 3 + 1.0 / 2 + 1) / 6 - 3 ELSE -3.0 END, 6)::DOUBLE + 0.0 AS score FROM generations""",
    GEN,
)
def tool_call_compare(spark, d):
    """Equal calls; a swapped and changed value; one other call with fewer parameters; nothing."""
    g = F.col("gen_id")
    call = lambda name, **p: F.struct(F.lit(name).alias("name"), F.create_map(*[x for k, v in p.items() for x in (F.lit(k), v)]).alias("params"))
    x, y = F.col("truth"), F.col("lang")
    truth = F.array(call("a", p=x, q=y), call("b", r=x))
    pred = (
        F.when(g % 4 == 0, truth).when(g % 4 == 1, F.array(call("b", r=x), call("a", p=x, q=F.lit("other"))))
        .when(g % 4 == 2, F.array(call("a", p=x), call("c", z=y)))
        .otherwise(F.array().cast("array<struct<name:string,params:map<string,string>>>"))
    )
    rows = src.generations(spark, d).select("gen_id", truth.alias("t"), pred.alias("p"))
    return rows.select("gen_id", r6(gr.compare_calls(F.col("t"), F.col("p"), 3.0, -3.0)).alias("score"))


@query(
    "code_block_table",
    r"""WITH h AS (SELECT gen_id, text, CASE gen_id % 3 WHEN 0 THEN text || E'```python\nold\n``` and ```\nnew ' || gen_id || E'\n```' WHEN 1 THEN text || E'```sh\nrun ' || gen_id || E'\n```' ELSE text END AS x FROM generations)
SELECT gen_id, CASE gen_id % 3 WHEN 0 THEN 'new ' || gen_id || E'\n' ELSE x END AS solution,
  CASE gen_id % 3 WHEN 0 THEN E'\nold\n' WHEN 1 THEN 'run ' || gen_id || E'\n' END AS strict, CASE WHEN gen_id % 3 = 2 THEN 'missing code block' END AS error FROM h""",
    GEN,
)
def code_block_table(spark, d):
    g = F.col("gen_id").cast("string")
    text = F.when(F.col("gen_id") % 3 == 0, F.concat("text", F.lit("```python\nold\n``` and ```\nnew "), g, F.lit("\n```"))).when(
        F.col("gen_id") % 3 == 1, F.concat("text", F.lit("```sh\nrun "), g, F.lit("\n```"))
    ).otherwise(F.col("text"))
    rows = src.generations(spark, d).select("gen_id", text.alias("x"))
    strict = gr.code_block_strict(F.col("x"))
    return rows.select("gen_id", gr.code_block(F.col("x")).alias("solution"), strict["solution"].alias("strict"), strict["error"].alias("error"))
