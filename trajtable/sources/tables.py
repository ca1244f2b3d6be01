"""Input tables: driver tables and the rollout-shaped inputs derived from them.

Every derived input exists twice with the same definition: as a DataFrame here and as a SQL
common table expression in ``DUCK`` for the comparison queries. Doubles are derived with divisors
such as 97 so that rounding at six decimals never meets an exact half.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajtable.functions.divergence import arg_max
from trajtable.plans.skew import ranked



def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rollouts(spark: SparkSession, folder: str, source: bool = False, index: bool = False) -> DataFrame:
    """One row per sampled response; ``uid`` is the prompt, ``step`` is constant inside a uid.

    ``source=True`` joins the orders table for ``data_source``; ``index=True`` numbers the samples.
    """
    li = table(spark, folder, "lineitem")
    if index:
        li = ranked(
            li,
            ["l_orderkey"],
            [F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate")],
            out="_rank",
        )
    cols = [
        F.floor(F.col("l_orderkey") / 1000).cast("bigint").alias("step"),
        F.col("l_orderkey").alias("uid"),
        (F.round(F.col("l_discount") * 100) / 97).alias("score"),
        (F.round(F.col("l_tax") * 100) / 89).alias("score2"),
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("acc"),
        F.concat("l_returnflag", "l_linestatus").alias("pred"),
        F.col("l_quantity").cast("int").alias("resp_len"),
        (F.col("l_linenumber") * 10 + 5).cast("int").alias("prompt_len"),
        F.col("l_partkey").alias("problem_id"),
        F.col("l_linenumber").cast("int").alias("line"),
        F.col("l_suppkey").alias("worker"),
    ]
    if index:
        cols.append((F.col("_rank") - 1).alias("sample_idx"))
    if source:
        orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
        li = li.join(orders, li.l_orderkey == orders.o_orderkey)
        cols.append(F.col("o_orderpriority").alias("data_source"))
    return li.select(*cols)


def tokens(spark: SparkSession, folder: str) -> DataFrame:
    """One row per generated token; a trajectory is the events of a user in a calendar month."""
    ev = table(spark, folder, "events").select(
        "user_id",
        "event_id",
        "ts",
        "event_type",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.round(F.col("value") * 100).cast("bigint").alias("c"),
        F.date_format("ts", "yyyyMM").alias("month"),
    )
    numbered = ranked(ev, ["user_id", "month"], [F.col("ts"), F.col("event_id")], out="n")
    k, c = F.col("k"), F.col("c")
    base = numbered.select(
        F.floor(F.col("user_id") / 40).cast("bigint").alias("step"),
        F.floor(F.col("user_id") / 10).cast("bigint").alias("uid"),
        F.concat_ws("_", "user_id", "month").alias("seq_id"),
        (F.col("n") - 1).cast("int").alias("t"),
        F.when(F.col("event_type") == "error", 0).otherwise(1).alias("mask"),
        "event_type",
        "event_id",
        k.alias("tok"),
        "c",
        ((k % 7) / 97.0).alias("reward"),
        (-0.8 - (c % 389) / 97.0).alias("old_lp"),
        ((c % 211) / 97.0 - 1).alias("value"),
        (0.1 + (k % 37) / 97.0).alias("sum_pi2"),
        ((c % 61) / 29.0).alias("entropy"),
        ((c % 17 - 8) / 13.0).alias("adv"),
    )
    old = F.col("old_lp")
    return base.withColumns(
        {
            "rollout_lp": old + (F.col("tok") % 41 - 20) / 29.0,
            "cur_lp": old + (F.col("c") % 31 - 15) / 53.0,
            "ref_lp": old + (F.col("c") % 23 - 11) / 31.0,
            "teacher_lp": old + (F.col("tok") % 19 - 9) / 23.0,
            "vpred": F.col("value") + (F.col("tok") % 13 - 6) / 11.0,
        }
    ).drop("c")


def logits(spark: SparkSession, folder: str) -> DataFrame:
    """Student logits from the embeddings; the teacher distribution is the next vector's, or its own where none follows."""
    emb = table(spark, folder, "embeddings")
    scale = lambda c: F.transform(c, lambda x: x.cast("double") * 8.0)
    student = emb.select("vec_id", "label", scale("embedding").alias("student"))
    teacher = emb.select((F.col("vec_id") - 1).alias("vec_id"), scale("embedding").alias("teacher"))
    return student.join(teacher, "vec_id", "left").withColumn("teacher", F.coalesce("teacher", "student"))


def positions(spark: SparkSession, folder: str) -> DataFrame:
    """Logit rows as trajectories of 50 positions with both argmax tokens."""
    first = lambda c: arg_max(F.col(c))
    return logits(spark, folder).select(
        F.floor(F.col("vec_id") / 50).cast("bigint").alias("traj_id"), (F.col("vec_id") % 50).cast("int").alias("t"),
        "student", "teacher", first("student").alias("student_tok"), first("teacher").alias("teacher_tok"),
        F.when(F.col("label") % 7 == 6, 0).otherwise(1).alias("mask"),
    )


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    """Trace events of requests: single events, and chunk events that carry two positions."""
    ev = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value", F.get_json_object("props", "$.k").cast("int").alias("k"))
    chunk = F.col("event_type") == "view"
    none = F.lit(None).cast("int")
    spot = (F.floor("value") % 80).cast("int")
    return ev.select(
        F.when(F.col("event_type") == "signup", F.lit("")).otherwise(F.col("user_id").cast("string")).alias("request_id"),
        F.col("event_id").alias("event_no"),
        F.when(~chunk & (F.col("event_type") != "error"), spot).otherwise(none).alias("response_pos"),
        F.when(~chunk, F.col("k")).otherwise(none).alias("emit_token_id"),
        F.when(chunk, F.array(spot, spot + 1)).alias("positions"),
        F.when(chunk, F.array(F.col("k"), F.col("k") + 1)).alias("tokens"),
    )


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as rows (conv_id, i, role, content), ``i`` from 0 in the order of the turns."""
    conv = table(spark, folder, "conversations")
    rows = ranked(conv, ["conv_id"], [F.col("turn"), F.col("role"), F.col("text")], out="n")
    return rows.select("conv_id", (F.col("n") - 1).alias("i"), "role", F.col("text").alias("content"))


def words(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as token ids (word lengths); the first third is the prompt, the rest the response."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source", "text")
    ids = F.transform(F.split("text", " "), lambda w: F.length(w))
    docs = docs.withColumn("ids", ids).withColumn("n", F.size("ids"))
    cut = F.floor(F.col("n") / 3).cast("int")
    return docs.withColumns(
        {
            "prompt_ids": F.slice("ids", F.lit(1), cut),
            "response_ids": F.slice("ids", cut + 1, F.col("n") - cut),
        }
    )


def generations(spark: SparkSession, folder: str) -> DataFrame:
    """Answer texts in the shapes the graders know, appended to whole documents."""
    docs = table(spark, folder, "documents")
    d = F.col("doc_id")
    n = (d * 37 % 1000).cast("string")
    wrong = ((d * 37 + d % 3) % 1000).cast("string")
    letter = lambda x: F.substring(F.lit("ABCD"), (x % 4 + 1).cast("int"), F.lit(1))
    return docs.select(
        d.alias("gen_id"),
        (d % 40).alias("item_id"),
        F.col("source").alias("data_source"),
        F.col("lang"),
        n.alias("truth"),
        letter(d).alias("truth_letter"),
        F.concat(F.col("text"), F.lit("\nsteps 12 and 3,4\n#### "), wrong).alias("hash_text"),
        F.concat(F.col("text"), F.lit("\nso \\boxed{1} then \\boxed{\\frac{"), wrong, F.lit("}{7}} done")).alias("boxed_text"),
        F.concat(F.col("text"), F.lit("\nAnswer: $"), wrong, F.lit("$")).alias("line_text"),
        F.concat(F.lit("<think>"), F.col("text"), F.lit("</think><answer> The "), wrong, F.lit(". </answer>")).alias("tag_text"),
        F.concat(F.col("text"), F.lit("\nThe answer is ("), letter(d + d % 3), F.lit(")")).alias("choice_text"),
        "text",
    )


DUCK = {
    "rollouts": """
rollouts AS (
  SELECT l_orderkey // 1000 AS step, l_orderkey AS uid, o_orderpriority AS data_source,
         round(l_discount * 100) / 97 AS score, round(l_tax * 100) / 89 AS score2,
         CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS acc,
         l_returnflag || l_linestatus AS pred, l_quantity::INT AS resp_len,
         (l_linenumber * 10 + 5)::INT AS prompt_len, l_partkey AS problem_id,
         l_linenumber::INT AS line, l_suppkey AS worker,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                            l_extendedprice, l_quantity, l_shipdate) - 1 AS sample_idx
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "tokens": """
numbered AS (
  SELECT *, (props->>'$.k')::INT AS k, round(value * 100)::BIGINT AS c,
         strftime(ts, '%Y%m') AS month, row_number() OVER (PARTITION BY user_id, month ORDER BY ts, event_id) - 1 AS n FROM events),
tokens0 AS (
  SELECT user_id // 40 AS step, user_id // 10 AS uid, user_id || '_' || month AS seq_id,
         n::INT AS t, CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS mask, event_type,
         event_id, k AS tok, c, (k % 7) / 97.0::DOUBLE AS reward,
         -0.8::DOUBLE - (c % 389) / 97.0::DOUBLE AS old_lp, (c % 211) / 97.0::DOUBLE - 1 AS value,
         0.1::DOUBLE + (k % 37) / 97.0::DOUBLE AS sum_pi2, (c % 61) / 29.0::DOUBLE AS entropy,
         (c % 17 - 8) / 13.0::DOUBLE AS adv FROM numbered),
tokens AS (
  SELECT * EXCLUDE (c), old_lp + (tok % 41 - 20) / 29.0::DOUBLE AS rollout_lp,
         old_lp + (c % 31 - 15) / 53.0::DOUBLE AS cur_lp, old_lp + (c % 23 - 11) / 31.0::DOUBLE AS ref_lp,
         old_lp + (tok % 19 - 9) / 23.0::DOUBLE AS teacher_lp, value + (tok % 13 - 6) / 11.0::DOUBLE AS vpred
  FROM tokens0)""",
    "logits": """
logits AS (
  SELECT s.vec_id, s.label, list_transform(s.embedding, lambda x: x::DOUBLE * 8.0) AS student,
         list_transform(coalesce(t.embedding, s.embedding), lambda x: x::DOUBLE * 8.0) AS teacher
  FROM embeddings s LEFT JOIN embeddings t ON t.vec_id - 1 = s.vec_id)""",
    "positions": """
positions AS (
  SELECT vec_id // 50 AS traj_id, (vec_id % 50)::INT AS t, student, teacher,
         (list_position(student, list_max(student)) - 1)::INT AS student_tok,
         (list_position(teacher, list_max(teacher)) - 1)::INT AS teacher_tok,
         CASE WHEN label % 7 = 6 THEN 0 ELSE 1 END AS mask FROM logits)""",
    "trace": """
event_log AS (
  SELECT user_id::VARCHAR AS request_id, event_id AS event_no, event_type, (props->>'$.k')::INT AS k,
         (floor(value)::BIGINT % 80)::INT AS spot FROM events WHERE event_type <> 'signup'),
single AS (
  SELECT request_id, event_no, 0 AS in_event, spot AS pos, k AS tok FROM event_log WHERE event_type NOT IN ('view', 'error')
  UNION ALL SELECT request_id, event_no, 0, spot, k FROM event_log WHERE event_type = 'view'
  UNION ALL SELECT request_id, event_no, 1, spot + 1, k + 1 FROM event_log WHERE event_type = 'view'),
gens AS (
  SELECT user_id::VARCHAR AS request_id, (count(*) % 60 + 10)::INT AS gen_len FROM events GROUP BY user_id),
trace AS (
  SELECT s.request_id, pos AS response_pos, arg_max(tok, event_no * 10 + in_event) AS emit_token_id
  FROM single s JOIN gens g ON s.request_id = g.request_id WHERE pos >= 0 AND pos < gen_len GROUP BY s.request_id, pos)""",
    "messages": """
messages AS (
  SELECT conv_id, role, text AS content, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS i FROM conversations)""",
    "words": """
words0 AS (SELECT doc_id, lang, source, text, list_transform(string_split(text, ' '), lambda w: length(w)::INT) AS ids FROM documents),
words AS (SELECT *, len(ids)::INT AS n, ids[1:len(ids) // 3] AS prompt_ids, ids[len(ids) // 3 + 1:] AS response_ids FROM words0)""",
    "generations": """
generations AS (
  SELECT doc_id AS gen_id, doc_id % 40 AS item_id, source AS data_source, lang,
         (doc_id * 37 % 1000)::VARCHAR AS truth, substr('ABCD', (doc_id % 4 + 1)::INT, 1) AS truth_letter,
         text || E'\\nsteps 12 and 3,4\\n#### ' || ((doc_id * 37 + doc_id % 3) % 1000) AS hash_text,
         text || E'\\nso \\\\boxed{1} then \\\\boxed{\\\\frac{' || ((doc_id * 37 + doc_id % 3) % 1000) || '}{7}} done' AS boxed_text,
         text || E'\\nAnswer: $' || ((doc_id * 37 + doc_id % 3) % 1000) || '$' AS line_text,
         '<think>' || text || '</think><answer> The ' || ((doc_id * 37 + doc_id % 3) % 1000) || '. </answer>' AS tag_text,
         text || E'\\nThe answer is (' || substr('ABCD', ((doc_id + doc_id % 3) % 4 + 1)::INT, 1) || ')' AS choice_text,
         text FROM documents)""",
}


def duck(*names: str) -> str:
    """``WITH`` clause that defines the named derived inputs for the comparison SQL."""
    return "WITH " + ",".join(DUCK[n] for n in names)
