"""Row construction, token arrays, filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajtable.operators import batch as bt
from trajtable.operators import prep
from trajtable.operators import sampling as sp
from trajtable.plans.catalog.base import csv, query, r6
from trajtable.sources import tables as src

W, GEN, M, T, G = ("words",), ("generations",), ("messages",), ("tokens",), ("rollouts",)


def _csv(col: str) -> str:
    return f"coalesce(array_to_string({col}, ','), '')"


def _prompt_flat(df):
    return df.select(
        "data_source", F.col("prompt")[0]["role"].alias("role"), F.col("prompt")[0]["content"].alias("content"), "ability",
        "reward_model.style", "reward_model.ground_truth", "extra_info.split", "extra_info.index",
    )


def _indexed(df):
    return bt.with_index(df, [F.col("gen_id")])


IDX = "(row_number() OVER (ORDER BY gen_id) - 1) AS index"


@query(
    "prep_rule_math",
    f"""SELECT 'docs/rule' AS data_source, 'user' AS role, text || ' ' || 'Let''s think step by step and output the final answer after "####".' AS content,
  'math' AS ability, 'rule' AS style, replace(regexp_extract(hash_text, '#### (-?[0-9.,]+)', 1), ',', '') AS ground_truth, 'train' AS split, {IDX} FROM generations""",
    GEN,
)
def prep_rule_math(spark, d):
    rows = _indexed(src.generations(spark, d))
    question = F.concat("text", F.lit(" "), F.lit(prep.HASH_INSTRUCTION))
    truth = prep.must(prep.hash_answer(F.col("hash_text")), "no final answer")
    return _prompt_flat(rows.select(*prep.prompt_row(question, truth, F.col("idx"), "docs/rule", "train", answer=F.col("hash_text"), question=F.col("text"))))


@query(
    "prep_boxed_math",
    f"""SELECT 'docs/boxed' AS data_source, 'user' AS role, text || ' ' || 'Let''s think step by step and output the final answer within \\boxed{{}}.' AS content,
  'math' AS ability, 'rule' AS style, '\\frac{{' || (gen_id * 37 + gen_id % 3) % 1000 || '}}{{7}}' AS ground_truth, 'train' AS split, {IDX} FROM generations""",
    GEN,
)
def prep_boxed_math(spark, d):
    from trajtable.functions.answers import last_boxed

    rows = _indexed(src.generations(spark, d))
    question = F.concat("text", F.lit(" "), F.lit(prep.BOXED_INSTRUCTION))
    truth = prep.must(last_boxed(F.col("boxed_text")), "no boxed answer")
    return _prompt_flat(rows.select(*prep.prompt_row(question, truth, F.col("idx"), "docs/boxed", "train")))


PAIRS = "p AS (SELECT gen_id, lang || ': ' || data_source AS prompt, hash_text AS chosen, line_text AS rejected FROM generations)"


def _pairs(spark, d):
    return src.generations(spark, d).select(
        "gen_id", F.concat("lang", F.lit(": "), "data_source").alias("prompt"), F.col("hash_text").alias("chosen"), F.col("line_text").alias("rejected")
    )


@query(
    "prep_pref_sft",
    f"WITH {PAIRS} SELECT gen_id, 0 AS slot, prompt, chosen AS response FROM p UNION ALL SELECT gen_id, 1, prompt, rejected FROM p",
    GEN,
)
def prep_pref_sft(spark, d):
    return _pairs(spark, d).select("gen_id", "prompt", F.posexplode(F.array("chosen", "rejected")).alias("slot", "response")).select("gen_id", "slot", "prompt", "response")


@query(
    "prep_pref_rm",
    f"""WITH {PAIRS}, i AS (SELECT *, row_number() OVER (ORDER BY gen_id) - 1 AS idx, count(*) OVER () AS n FROM p)
SELECT 'train' AS split, prompt, chosen, rejected FROM i WHERE idx < round(n * 0.75) UNION ALL
SELECT 'test', prompt, chosen, rejected FROM i WHERE idx >= n - round(n * 0.25)""",
    GEN,
)
def prep_pref_rm(spark, d):
    rows = bt.counted(_indexed(_pairs(spark, d)), "n")
    return prep.split_rows(rows, "idx", "n").select("split", "prompt", "chosen", "rejected")


@query(
    "prep_pref_rl",
    f"""WITH {PAIRS} SELECT 'docs/pref' AS data_source, 'user' AS role, prompt AS content, 'alignment' AS ability, 'model' AS style,
  chosen AS ground_truth, 'train' AS split, {IDX} FROM p""",
    GEN,
)
def prep_pref_rl(spark, d):
    rows = _indexed(_pairs(spark, d))
    return _prompt_flat(rows.select(*prep.prompt_row(F.col("prompt"), F.col("chosen"), F.col("idx"), "docs/pref", "train", "alignment", "model")))


CHOICE = """replace(regexp_replace(replace(regexp_replace({}, '^\\s+|\\s+$', '', 'g'), ' [title]', '. '), '\\[.*?\\]', '', 'g'), '  ', ' ')"""


@query(
    "prep_multichoice",
    f"""WITH h AS (SELECT doc_id, lang, source, text || ' [title] next  [step] part' AS ctx_a, 'wEB ' || source AS ctx_b,
  CASE WHEN doc_id % 5 = 0 THEN '' ELSE (doc_id % 4)::VARCHAR END AS label FROM documents)
SELECT doc_id, {CHOICE.format("lang || ': ' || ctx_a || ' ' || upper(substr(ctx_b, 1, 1)) || lower(substr(ctx_b, 2))")} AS content,
  {CHOICE.format("' end [x]  ' || source || ' '")} AS choice_0, label::INT AS ground_truth FROM h WHERE length(label) > 0""",
)
def prep_multichoice(spark, d):
    docs = src.table(spark, d, "documents").select("doc_id", "lang", "source", "text").withColumns({
        "ctx_a": F.concat("text", F.lit(" [title] next  [step] part")), "ctx_b": F.concat(F.lit("wEB "), "source"),
        "label": F.when(F.col("doc_id") % 5 == 0, "").otherwise((F.col("doc_id") % 4).cast("string")),
        "endings": F.array(F.concat(F.lit(" end [x]  "), "source", F.lit(" ")), "lang"),
    })
    rows = docs.where(F.length("label") > 0)
    context = F.concat("lang", F.lit(": "), "ctx_a", F.lit(" "), prep.capitalised(F.col("ctx_b")))
    return rows.select(
        "doc_id", prep.clean_choice(context).alias("content"), F.transform("endings", prep.clean_choice)[0].alias("choice_0"),
        F.col("label").cast("int").alias("ground_truth"),
    )


@query(
    "prep_search_qa",
    """SELECT 'searchR1_' || data_source AS data_source, 'Answer with a search tool.' AS system, 'Question: ' || text AS user_text,
  CASE WHEN gen_id % 2 = 0 THEN truth ELSE 'gold ' || gen_id END AS ground_truth, true AS need_tools_kwargs, length(CASE WHEN gen_id % 2 = 0 THEN truth ELSE 'gold ' || gen_id END) AS truth_len,
  'test' AS split, (row_number() OVER (ORDER BY gen_id) - 1) AS index FROM generations""",
    GEN,
)
def prep_search_qa(spark, d):
    rows = _indexed(src.generations(spark, d)).withColumns({
        "reward_truth": F.when(F.col("gen_id") % 2 == 0, F.col("truth")), "golden": F.concat(F.lit("gold "), F.col("gen_id").cast("string")),
    })
    truth = F.coalesce("reward_truth", "golden")
    source = F.concat(F.lit("searchR1_"), "data_source")
    kwargs = prep.tool_kwargs("search", ground_truth=truth, question=F.col("text"), data_source=source)
    out = rows.select(
        source.alias("data_source"),
        F.array(prep.message("system", F.lit("Answer with a search tool.")), prep.message("user", F.concat(F.lit("Question: "), "text"))).alias("prompt"),
        F.struct(F.lit("test").alias("split"), F.col("idx").alias("index"), F.lit(True).alias("need_tools_kwargs"), kwargs.alias("tools_kwargs")).alias("extra_info"),
        truth.alias("ground_truth"),
    )
    held = F.get_json_object("extra_info.tools_kwargs", "$.search.create_kwargs.ground_truth")
    return out.select(
        "data_source", F.col("prompt")[0]["content"].alias("system"), F.col("prompt")[1]["content"].alias("user_text"), "ground_truth",
        "extra_info.need_tools_kwargs", F.length(held).cast("bigint").alias("truth_len"), "extra_info.split", "extra_info.index",
    )


@query("prep_tool_kwargs", """SELECT gen_id, true AS need_tools_kwargs, '{"code_interpreter":{"create_kwargs":{"ground_truth":"' || truth || '"}}}' AS tools_kwargs FROM generations""", GEN)
def prep_tool_kwargs(spark, d):
    rows = src.generations(spark, d).withColumn("extra_info", F.struct(F.col("gen_id").alias("index")))
    info = F.col("extra_info").withField("need_tools_kwargs", F.lit(True)).withField("tools_kwargs", prep.tool_kwargs("code_interpreter", ground_truth=F.col("truth")))
    return rows.withColumn("extra_info", info).select("gen_id", "extra_info.need_tools_kwargs", "extra_info.tools_kwargs")


@query(
    "prep_multiturn_messages",
    """WITH n AS (SELECT count(DISTINCT conv_id) AS n FROM conversations), x AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id) - 1 AS idx FROM (SELECT DISTINCT conv_id FROM conversations))
SELECT conv_id, i, CASE WHEN idx < round(n * 0.8) THEN 'train' ELSE 'test' END AS split, role, content FROM messages JOIN x USING (conv_id), n""",
    M,
)
def prep_multiturn_messages(spark, d):
    """Messages as rows, so that a conversation may have any length; conversations are split 80 to 20."""
    rows = src.messages(spark, d)
    ids = bt.counted(bt.with_index(rows.select("conv_id").distinct(), [F.col("conv_id")]), "n")
    part = ids.select("conv_id", F.when(F.col("idx") < F.round(F.col("n") * 0.8), "train").otherwise("test").alias("split"))
    return rows.join(part, "conv_id").select("conv_id", "i", "split", "role", "content")


@query("prep_geo_rows", "SELECT page_id, '<image>' || url AS content, md5(html) AS image_md5, 'page ' || page_id AS ground_truth FROM pages")
def prep_geo_rows(spark, d):
    """Page bytes play the image that is carried beside the prompt."""
    rows = src.table(spark, d, "pages").withColumn("images", F.array(F.encode("html", "UTF-8")))
    row = prep.prompt_row(F.concat(F.lit("<image>"), "url"), F.concat(F.lit("page "), F.col("page_id").cast("string")), F.col("page_id"), "pages", "train")
    out = rows.select("page_id", *row, "images")
    return out.select("page_id", F.col("prompt")[0]["content"].alias("content"), F.md5(F.col("images")[0]).alias("image_md5"), "reward_model.ground_truth")


MARKED = "CASE turn % 3 WHEN 0 THEN '<image>' || text || '<video>' WHEN 1 THEN text || '<image><audio>tail' ELSE text END"


@query(
    "split_placeholders",
    f"""WITH s AS (SELECT conv_id, turn, list_filter(string_split(regexp_replace({MARKED}, '(<image>|<video>|<audio>)', chr(1) || '\\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS parts FROM conversations),
p AS (SELECT conv_id, turn, unnest(parts) AS part, generate_subscripts(parts, 1) - 1 AS part_no FROM s),
k AS (SELECT *, CASE WHEN part IN ('<image>', '<video>', '<audio>') THEN part[2:6] ELSE 'text' END AS kind FROM p)
SELECT conv_id, turn, part_no::INT AS part_no, part, kind, CASE WHEN kind <> 'text' THEN row_number() OVER (PARTITION BY conv_id, kind ORDER BY turn, part_no) - 1 END AS media_no FROM k""",
)
def split_placeholders(spark, d):
    mark = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("<image>"), "text", F.lit("<video>"))).when(
        F.col("turn") % 3 == 1, F.concat("text", F.lit("<image><audio>tail"))
    ).otherwise(F.col("text"))
    conv = src.table(spark, d, "conversations").select("conv_id", "turn", mark.alias("content"))
    return prep.placeholders(conv, ["conv_id"], ["turn"], "content")


@query(
    "raw_prompt_row",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0 ELSE (props->>'$.k')::BIGINT END AS index,
  CASE WHEN event_id % 2 = 0 THEN '{"calc":{"k":' || (props->>'$.k') || '}}' ELSE '{}' END AS tools_kwargs, '{}' AS interaction_kwargs FROM events""",
)
def raw_prompt_row(spark, d):
    e, k = F.col("event_id"), F.get_json_object("props", "$.k")
    info = F.concat(
        F.lit("{"), F.concat_ws(",", F.when(e % 3 != 0, F.concat(F.lit('"index":'), k)), F.when(e % 2 == 0, F.concat(F.lit('"tools_kwargs":{"calc":{"k":'), k, F.lit("}}")))), F.lit("}")
    )
    rows = src.table(spark, d, "events").withColumn("extra_info", info)
    get = lambda name, default: F.coalesce(F.get_json_object("extra_info", f"$.{name}"), F.lit(default))
    return rows.select(
        "event_id", get("index", "0").cast("bigint").alias("index"), get("tools_kwargs", "{}").alias("tools_kwargs"),
        get("interaction_kwargs", "{}").alias("interaction_kwargs"),
    )


@query(
    "ground_truth_normalise",
    """SELECT gen_id, CASE gen_id % 6 WHEN 0 THEN truth WHEN 1 THEN truth WHEN 2 THEN 'x' || truth WHEN 3 THEN '' WHEN 4 THEN truth ELSE '' END AS truth FROM generations""",
    GEN,
)
def ground_truth_normalise(spark, d):
    k, t = F.col("gen_id") % 6, F.col("truth")
    raw = (
        F.when(k == 0, F.concat(F.lit('{"solution":"no","answer":"'), t, F.lit('"}'))).when(k == 1, F.concat(F.lit('["'), t, F.lit('","z"]')))
        .when(k == 2, F.concat(F.lit('{"target":"x'), t, F.lit('","solution":"b"}'))).when(k == 3, F.lit('{"ground_truth":null,"target":"t"}'))
        .when(k == 4, t)
    )
    return src.generations(spark, d).select("gen_id", prep.normalise_truth(raw).alias("truth"))


@query(
    "traj_record",
    """SELECT doc_id, 2 AS n_messages, doc_id % 3 > 0 AS eos_reached, len(response_ids)::INT AS gen_len, 'assistant=' || text AS answer FROM words""",
    W,
)
def traj_record(spark, d):
    rows = src.words(spark, d).withColumn("finish_reason", F.when(F.col("doc_id") % 3 > 0, "stop").otherwise("length"))
    msgs = F.array(prep.message("user", F.col("lang")), prep.message("assistant", F.col("text")))
    rec = rows.select("doc_id", msgs.alias("messages"), "prompt_ids", "response_ids", "finish_reason", (F.col("finish_reason") == "stop").alias("eos_reached"), F.size("response_ids").alias("gen_len"))
    last = F.element_at("messages", -1)
    return rec.select("doc_id", F.size("messages").alias("n_messages"), "eos_reached", "gen_len", F.concat(last["role"], F.lit("="), last["content"]).alias("answer"))


def _sql_text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


@query(
    "rewrite_prompt",
    f"""SELECT conv_id, coalesce(arg_min(content, i) FILTER (WHERE role = 'system'), 'You are a helpful assistant.') AS system,
  {_sql_text(prep.REWRITE_HEAD)} || coalesce(arg_min(content, i) FILTER (WHERE role = 'user'), '') || {_sql_text(prep.REWRITE_MIDDLE)}
  || coalesce(arg_max(content, i) FILTER (WHERE role = 'assistant'), '') || {_sql_text(prep.REWRITE_TAIL)} AS content FROM messages GROUP BY conv_id""",
    M,
)
def rewrite_prompt(spark, d):
    ends = prep.conversation_ends(src.messages(spark, d), ["conv_id"], "i")
    return ends.select(
        "conv_id", F.coalesce("system", F.lit("You are a helpful assistant.")).alias("system"),
        prep.rewrite_prompt(F.coalesce("question", F.lit("")), F.coalesce("answer", F.lit(""))).alias("content"),
    )


@query(
    "rewrite_prompt_fit",
    f"""WITH k AS (SELECT *, len(ids) + 30 AS plen, 30 AS elen FROM words)
SELECT doc_id, {_csv("CASE WHEN plen <= 300 THEN ids ELSE ids[1:254] END")} AS kept, (CASE WHEN plen <= 300 THEN 0 ELSE greatest(len(ids) - 254, 0) END)::INT AS dropped, plen > 300 AS cut FROM k""",
    W,
)
def rewrite_prompt_fit(spark, d):
    rows = src.words(spark, d)
    fit = prep.fit_response(F.col("ids"), F.col("n") + 30, F.lit(30), 300)
    return rows.select("doc_id", csv(fit["kept_ids"]).alias("kept"), fit["dropped"].alias("dropped"), fit["cut"].alias("cut"))


@query("shard_assign", "SELECT doc_id, (doc_id % 7)::INT AS shard FROM documents")
def shard_assign(spark, d):
    return src.table(spark, d, "documents").select("doc_id", F.pmod("doc_id", F.lit(7)).cast("int").alias("shard"))


# --- token arrays --------------------------------------------------------------------------------

ROWS3 = "[0 for x in prompt_ids] || [1 for x in response_ids]"


@query(
    "sft_loss_mask",
    f"SELECT doc_id, {_csv('ids')} AS input_ids, {_csv(ROWS3)} AS loss_mask, {_csv('range(len(ids))')} AS position_ids FROM words",
    W,
)
def sft_loss_mask(spark, d):
    row = prep.sft_row(F.col("prompt_ids"), F.col("response_ids"))
    return src.words(spark, d).select("doc_id", *[csv(v).alias(k) for k, v in row.items()])


def _pad_sql(x: str, n: int, value: int) -> str:
    return _csv(f"({x}) || [{value} for i in range(greatest({n} - len({x}), 0))]")


LEFT = "ids[greatest(len(ids) - 200, 0) + 1:]"
LEFT_MASK = f"({ROWS3})[greatest(len(ids) - 200, 0) + 1:]"


@query(
    "sft_truncate_pad",
    f"""SELECT doc_id, {_pad_sql(LEFT, 200, 9)} AS input_ids, {_pad_sql(LEFT_MASK, 200, 0)} AS loss_mask,
  {_pad_sql("range(least(len(ids), 200))", 200, 0)} AS position_ids, {_csv("ids[1:200]")} AS flat_ids, {_csv("(" + ROWS3 + ")[1:200]")} AS flat_mask FROM words""",
    W,
)
def sft_truncate_pad(spark, d):
    row = prep.sft_row(F.col("prompt_ids"), F.col("response_ids"))
    padded = prep.sft_fit(row, 200, pad_id=9, how="left")
    flat = prep.sft_fit(row, 200, how="left", mode="none")
    return src.words(spark, d).select(
        "doc_id", *[csv(v).alias(k) for k, v in padded.items()], csv(flat["input_ids"]).alias("flat_ids"), csv(flat["loss_mask"]).alias("flat_mask")
    )


@query(
    "multiturn_loss_mask",
    """WITH q AS (SELECT conv_id, i, CASE WHEN i <> 0 AND role <> 'system' THEN 0 ELSE 3 END AS lead, CASE WHEN role = 'assistant' THEN 2 ELSE 0 END AS gen,
  role = 'assistant' AS bot, list_transform(string_split(content, ' '), lambda w: length(w)::INT) AS w FROM messages)
SELECT conv_id, i, array_to_string([-1 for x in range(lead)] || [-2 for x in range(gen)] || w, ',') AS input_ids,
  array_to_string([CASE WHEN bot AND x >= 2 THEN 1 ELSE 0 END for x in range(lead + gen + len(w))], ',') AS loss_mask FROM q""",
    M,
)
def multiturn_loss_mask(spark, d):
    """Per message; ids and masks of a conversation follow each other in the order of ``i``."""
    row = prep.message_masks(F.col("role"), F.col("content"), F.col("i"), prefix=2, system_len=3)
    return src.messages(spark, d).select("conv_id", "i", *[csv(v).alias(k) for k, v in row.items()])


@query(
    "pad_trunc_ids",
    f"""SELECT doc_id, {_csv("[7 for i in range(greatest(90 - len(ids[1:90]), 0))] || ids[1:90]")} AS right_cut_left_pad, {_pad_sql("ids[greatest(len(ids) - 90, 0) + 1:]", 90, 7)} AS left_cut,
  {_pad_sql("CASE WHEN len(ids) > 91 THEN ids[1:45] || ids[len(ids) - 45:] ELSE ids END", 91, 7)} AS middle_cut FROM words""",
    W,
)
def pad_trunc_ids(spark, d):
    ids = F.col("ids")
    return src.words(spark, d).select(
        "doc_id", csv(prep.pad_truncate(ids, 90, 7, "right", left_pad=True)).alias("right_cut_left_pad"),
        csv(prep.pad_truncate(ids, 90, 7, "left")).alias("left_cut"), csv(prep.pad_truncate(ids, 91, 7, "middle")).alias("middle_cut"),
    )


@query(
    "pair_rows",
    f"""WITH k AS (SELECT doc_id, (prompt_ids || response_ids || [2])[1:120] AS a, (prompt_ids || list_reverse(response_ids) || [2])[1:120] AS b FROM words)
SELECT doc_id, {_pad_sql("a", 120, 0)} AS chosen, {_pad_sql("[1 for x in a]", 120, 0)} AS chosen_mask, {_pad_sql("b", 120, 0)} AS rejected, {_pad_sql("[1 for x in b]", 120, 0)} AS rejected_mask FROM k""",
    W,
)
def pair_rows(spark, d):
    """The reversed response plays the rejected one."""
    rows = src.words(spark, d)
    eos = F.array(F.lit(2))
    chosen = prep.head(F.concat("prompt_ids", "response_ids", eos), 120)
    rejected = prep.head(F.concat("prompt_ids", F.reverse("response_ids"), eos), 120)
    ones = lambda x: F.transform(x, lambda _: F.lit(1))
    return rows.select(
        "doc_id", csv(prep.pad(chosen, 120, 0)).alias("chosen"), csv(prep.pad(ones(chosen), 120, 0)).alias("chosen_mask"),
        csv(prep.pad(rejected, 120, 0)).alias("rejected"), csv(prep.pad(ones(rejected), 120, 0)).alias("rejected_mask"),
    )


@query(
    "response_mask_eos",
    """WITH e AS (SELECT seq_id, min(t) AS e FROM tokens WHERE tok IN (5, 17) GROUP BY seq_id)
SELECT k.seq_id, t, CASE WHEN e IS NULL OR t <= e THEN 1 ELSE 0 END AS eos_mask FROM tokens k LEFT JOIN e ON k.seq_id = e.seq_id""",
    T,
)
def response_mask_eos(spark, d):
    return prep.eos_rows(src.tokens(spark, d), [5, 17], ["seq_id"]).select("seq_id", "t", "eos_mask")


@query("response_mask_tail", f"SELECT doc_id, {_csv(f'({ROWS3})[greatest(len(ids) - 64, 0) + 1:]')} AS response_mask FROM words", W)
def response_mask_tail(spark, d):
    row = prep.sft_row(F.col("prompt_ids"), F.col("response_ids"))
    return src.words(spark, d).select("doc_id", csv(prep.tail(row["loss_mask"], 64)).alias("response_mask"))


@query(
    "offline_align",
    f"""WITH k AS (SELECT *, CASE WHEN len(prompt_ids) = 0 THEN [1] ELSE prompt_ids END AS p FROM words),
v AS (SELECT doc_id, source, len(p) AS np, len(response_ids) AS nr, [x * 3 for x in p || response_ids] AS vals FROM k)
SELECT doc_id, {_csv("vals[np:np + nr - 1]")} AS aligned, max(nr) OVER (PARTITION BY source) AS max_response, round(avg(nr) OVER (PARTITION BY source), 6) + 0.0 AS mean_response FROM v""",
    W,
)
def offline_align(spark, d):
    """Teacher values are three times the token id; empty prompts get one start token."""
    from trajtable.plans.skew import with_stats

    rows = src.words(spark, d).withColumn("p", F.when(F.size("prompt_ids") == 0, F.array(F.lit(1))).otherwise(F.col("prompt_ids")))
    values = F.transform(F.concat("p", "response_ids"), lambda x: x * 3)
    rows = rows.select("doc_id", "source", F.size("response_ids").cast("bigint").alias("nr"), prep.aligned_teacher(values, F.col("p"), F.col("response_ids"), F.col("p")).alias("a"))
    rows = with_stats(rows, ["source"], F.max("nr").alias("max_response"), F.avg("nr").alias("m"))
    return rows.select("doc_id", csv("a").alias("aligned"), "max_response", r6("m").alias("mean_response"))


@query(
    "offline_row",
    """SELECT gen_id, CASE WHEN gen_id % 2 = 0 THEN truth ELSE truth_letter END AS ground_truth, CASE WHEN gen_id % 3 = 0 THEN gen_id::VARCHAR ELSE 'u' || gen_id END AS unique_id,
  gen_id AS index FROM generations""",
    GEN,
)
def offline_row(spark, d):
    g = F.col("gen_id")
    rows = src.generations(spark, d).select(
        "gen_id", F.when(g % 2 == 0, F.col("truth")).alias("gt"), F.col("truth_letter").alias("answer"),
        F.when(g % 3 != 0, F.concat(F.lit("u"), g.cast("string"))).alias("unique_id"),
    )
    rows = bt.with_index(rows, [g])
    return rows.select("gen_id", F.coalesce("gt", "answer").alias("ground_truth"), F.coalesce("unique_id", F.col("idx").cast("string")).alias("unique_id"), F.col("idx").alias("index"))


# --- filters -------------------------------------------------------------------------------------


@query("filter_overlong_prompt", "SELECT doc_id, len(ids)::INT AS n FROM words WHERE len(ids) <= 200 AND doc_id % 11 <> 0", W)
def filter_overlong_prompt(spark, d):
    """Every eleventh row has no readable length."""
    rows = src.words(spark, d)
    length = F.when(F.col("doc_id") % 11 != 0, F.col("n").cast("string")).otherwise("bad").try_cast("int")
    return prep.drop_overlong(rows, length, 200).select("doc_id", "n")


@query(
    "filter_offline",
    """WITH a AS (SELECT doc_id, text, len(prompt_ids) AS p, len(response_ids) AS r, CASE WHEN doc_id % 4 = 3 THEN -1 ELSE doc_id % 2 END AS s FROM words),
b AS (SELECT text, min(doc_id) AS doc_id FROM a WHERE s = 0 GROUP BY text),
c AS (SELECT a.doc_id, p::INT AS prompt_len, r::INT AS response_len FROM a JOIN b USING (doc_id) WHERE p <= 150 AND r <= 300)
SELECT * FROM c ORDER BY doc_id LIMIT 200""",
    W,
)
def filter_offline(spark, d):
    rows = src.words(spark, d).select(
        "doc_id", F.md5("text").alias("key"), F.size("prompt_ids").alias("prompt_len"), F.size("response_ids").alias("response_len"),
        F.when(F.col("doc_id") % 4 != 3, F.col("doc_id") % 2).alias("sample_idx"),
    )
    return prep.offline_filter(rows, "doc_id", 0, F.col("key"), 150, 300, 200).select("doc_id", "prompt_len", "response_len")


@query(
    "filter_groups",
    """WITH g AS (SELECT step, uid FROM rollouts GROUP BY step, uid HAVING min(acc) <> max(acc)),
r AS (SELECT *, row_number() OVER (ORDER BY step, uid) AS rk FROM g WHERE step IN (SELECT DISTINCT step FROM rollouts ORDER BY step LIMIT 12))
SELECT t.step, t.uid, t.line, t.problem_id, t.acc FROM rollouts t JOIN r ON t.step = r.step AND t.uid = r.uid WHERE rk <= 512""",
    G,
)
def filter_groups(spark, d):
    kept = prep.fill_batch(src.rollouts(spark, d), "acc", "uid", "step", 512, 12)
    return kept.select("step", "uid", "line", "problem_id", "acc")


# --- captions, order of an epoch -----------------------------------------------------------------


@query(
    "prep_caption_chat",
    """WITH s AS (SELECT doc_id, lang, text, row_number() OVER (ORDER BY md5('7:' || doc_id), doc_id) AS place, count(*) OVER () AS n FROM documents)
SELECT doc_id, 'user' AS first_role, 'caption in ' || lang AS question, 'assistant' AS second_role, text AS answer,
  CASE WHEN place <= ceil(n * 0.1::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM s""",
)
def prep_caption_chat(spark, d):
    """Turns of human and gpt as messages, a seeded tenth set aside."""
    turn = lambda who, what: F.struct(F.lit(who).alias("from"), what.alias("value"))
    rows = src.table(spark, d, "documents").select(
        "doc_id", F.array(turn("human", F.concat(F.lit("caption in "), "lang")), turn("gpt", F.col("text"))).alias("conversations")
    )
    rows = prep.seeded_split(rows.withColumn("messages", prep.speaker_messages(F.col("conversations"))), "doc_id", 0.1, 7)
    m = F.col("messages")
    return rows.select("doc_id", m[0]["role"].alias("first_role"), m[0]["content"].alias("question"), m[1]["role"].alias("second_role"), m[1]["content"].alias("answer"), "split")


@query(
    "epoch_resume",
    """WITH e AS (SELECT unnest(range(3))::INT AS epoch), o AS (
  SELECT epoch, row_number() OVER (PARTITION BY epoch ORDER BY md5('5:' || epoch || ':' || o_orderkey), o_orderkey) - 1 AS position, o_orderkey FROM orders, e)
SELECT * FROM o WHERE epoch > 1 OR (epoch = 1 AND position >= 100)""",
)
def epoch_resume(spark, d):
    """Three epochs in seeded orders, gone on from position 100 of the second."""
    return prep.epoch_order(src.table(spark, d, "orders"), "o_orderkey", 3, 5, (1, 100))
