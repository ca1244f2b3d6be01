"""Batch shape, joins, deduplication, sampling and packing."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajtable.operators import batch as bt
from trajtable.operators import packing as pk
from trajtable.operators import prep
from trajtable.operators import sampling as sp
from trajtable.plans.catalog.base import csv, query, r6
from trajtable.plans.catalog.corrections import rounded
from trajtable.sources import tables as src

G, W, M, T, GEN = ("rollouts",), ("words",), ("messages",), ("tokens",), ("generations",)
N = "(SELECT count(*) FROM orders)"


def _orders(spark, d):
    """Orders as a batch: the key is the stored row index."""
    return src.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("idx"), F.col("o_custkey").alias("cust"), F.col("o_orderstatus").alias("status"),
        F.floor(F.col("o_totalprice")).cast("bigint").alias("price"),
    )


O = "b AS (SELECT o_orderkey AS idx, o_custkey AS cust, o_orderstatus AS status, floor(o_totalprice)::BIGINT AS price FROM orders)"


@query("batch_concat", f"WITH {O} SELECT idx, cust, 'v1' AS meta, 0 AS worker FROM b WHERE idx % 2 = 0 UNION ALL SELECT idx, cust, 'v1', 1 FROM b WHERE idx % 2 = 1")
def batch_concat(spark, d):
    """Two worker batches stacked; their meta value must agree."""
    rows = _orders(spark, d).select("idx", "cust", F.lit("v1").alias("meta"))
    parts = [rows.where(F.col("idx") % 2 == w).withColumn("worker", F.lit(w)) for w in (0, 1)]
    return bt.concat(parts, ["meta"])


@query("batch_project", f"WITH {O} SELECT idx, cust AS customer FROM b")
def batch_project(spark, d):
    return bt.project(_orders(spark, d), ["idx", "cust", "status"], drop=["status"], rename={"cust": "customer"})


@query("batch_take", f"WITH {O} SELECT idx, cust FROM b WHERE idx >= 7 AND idx < {N} - 5 AND (idx - 7) % 3 = 0")
def batch_take(spark, d):
    rows = bt.counted(_orders(spark, d), "n")
    return bt.take(rows.where(F.col("idx") < F.col("n") - 5), 7, None, 3).select("idx", "cust")


@query("batch_take_list", f"WITH {O}, l AS (SELECT c_custkey AS slot, (c_custkey * 7) % 1500 AS idx FROM customer) SELECT slot, idx, price FROM l JOIN b USING (idx)")
def batch_take_list(spark, d):
    wanted = src.table(spark, d, "customer").select(F.col("c_custkey").alias("slot"), (F.col("c_custkey") * 7 % 1500).alias("idx"))
    return bt.take_list(_orders(spark, d), wanted).select("slot", "idx", "price")


@query("batch_chunk", f"WITH {O} SELECT idx, idx * 5 // {N} AS chunk FROM b")
def batch_chunk(spark, d):
    return bt.chunks(_orders(spark, d), 5).select("idx", "chunk")


@query("batch_split", f"WITH {O} SELECT idx, idx // 64 AS split FROM b")
def batch_split(spark, d):
    return bt.splits(_orders(spark, d), 64).select("idx", "split")


@query("dataset_split", f"WITH {O}, s AS (SELECT {N} // 7 AS size) SELECT idx, idx // size AS part FROM b, s WHERE idx < size * 7")
def dataset_split(spark, d):
    return bt.dataset_split(_orders(spark, d), 7).select("idx", "part")


@query(
    "batch_repeat",
    f"WITH {O}, c AS (SELECT unnest([0, 1, 2]) AS copy) SELECT idx, copy, (idx * 3 + copy)::BIGINT AS interleaved, (copy * {N} + idx)::BIGINT AS tiled FROM b, c",
)
def batch_repeat(spark, d):
    rows = bt.repeat(_orders(spark, d), 3, interleave=True, out="interleaved")
    tiled = bt.repeat(_orders(spark, d), 3, interleave=False, out="tiled").select("idx", "copy", "tiled")
    return rows.join(tiled, ["idx", "copy"]).select("idx", "copy", "interleaved", "tiled")


@query("batch_repeat_var", f"WITH {O} SELECT idx, unnest(range(cust % 4))::INT AS copy FROM b")
def batch_repeat_var(spark, d):
    return bt.repeat_var(_orders(spark, d), F.col("cust") % 4).select("idx", "copy")


@query(
    "unfold_columns",
    """SELECT vec_id, p::INT AS piece, label, round(list_sum(embedding[p * 16 + 1:p * 16 + 16])::DOUBLE, 4) + 0.0 AS total
FROM (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS embedding FROM embeddings), (SELECT unnest([0, 1, 2, 3]) AS p)""",
)
def unfold_columns(spark, d):
    rows = bt.unfold(src.table(spark, d, "embeddings"), ["embedding"], 4)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return rows.select("vec_id", "piece", "label", (F.round(total, 4) + F.lit(0.0)).alias("total"))


@query(
    "assign_minibatches",
    f"""WITH {O}, e AS (SELECT unnest([0, 1]) AS epoch), r AS (SELECT idx, epoch, row_number() OVER (PARTITION BY epoch ORDER BY md5('7:' || epoch || ':' || idx)) AS rk FROM b, e)
SELECT idx, epoch, (rk - 1) // 50 AS minibatch FROM r""",
)
def assign_minibatches(spark, d):
    return bt.minibatches(_orders(spark, d), 50, 2, 7, F.col("idx")).select("idx", "epoch", "minibatch")


# --- joins ---------------------------------------------------------------------------------------


@query("union_cols", f"WITH {O} SELECT idx, cust, status, price, price * 2 AS doubled FROM b")
def union_cols(spark, d):
    right = _orders(spark, d).select("idx", "status", (F.col("price") * 2).alias("doubled"))
    return prep.union_columns(_orders(spark, d), right, "idx")


@query(
    "join_reward_baseline",
    """WITH b AS (SELECT uid, arg_max(score, sample_idx) AS baseline FROM rollouts WHERE line = 1 GROUP BY uid)
SELECT uid::VARCHAR AS uid, sample_idx AS output_idx, round(score, 6) + 0.0 AS score, round(baseline, 6) + 0.0 AS baseline FROM rollouts JOIN b USING (uid) WHERE line <> 1""",
    G,
)
def join_reward_baseline(spark, d):
    """Rows of line 1 play the greedy rollouts."""
    uid = F.col("uid").cast("string")
    rows = src.rollouts(spark, d, index=True).select(
        F.when(F.col("line") == 1, F.concat(F.lit(prep.BASELINE_PREFIX), uid)).otherwise(uid).alias("uid"), F.col("sample_idx").alias("output_idx"), "score"
    )
    return rounded(prep.reward_baseline(rows), "uid", "output_idx")


@query(
    "join_shard_meta",
    """WITH s AS (SELECT worker % 8 AS shard, count(*) AS shard_rows, round(avg(acc), 6) + 0.0 AS shard_acc FROM rollouts GROUP BY worker % 8)
SELECT uid, line, problem_id, worker % 8 AS shard, shard_rows, shard_acc FROM rollouts JOIN s ON worker % 8 = shard""",
    G,
)
def join_shard_meta(spark, d):
    rows = src.rollouts(spark, d).withColumn("shard", F.col("worker") % 8)
    meta = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("shard_rows"), r6(F.avg("acc")).alias("shard_acc"))
    return rows.join(meta, "shard").select("uid", "line", "problem_id", "shard", "shard_rows", "shard_acc")


TEACHERS = {"1-URGENT": "large", "2-HIGH": "large", "3-MEDIUM": "medium", "4-NOT SPECIFIED": "medium", "5-LOW": "small"}


@query(
    "route_by_key",
    "SELECT uid, sample_idx, CASE WHEN data_source IN ('1-URGENT', '2-HIGH') THEN 'large' WHEN data_source = '5-LOW' THEN 'small' ELSE 'medium' END AS teacher FROM rollouts",
    G,
)
def route_by_key(spark, d):
    return prep.route(src.rollouts(spark, d, source=True, index=True), "data_source", TEACHERS).select("uid", "sample_idx", "teacher")


@query(
    "jump_to_request",
    """SELECT uid, line, problem_id, step FROM rollouts WHERE uid::VARCHAR || line = '1001' ORDER BY step, uid, line, problem_id LIMIT 1""",
    G,
)
def jump_to_request(spark, d):
    rows = src.rollouts(spark, d).withColumns({
        "request_id": F.concat_ws("-", F.col("uid").cast("string"), F.col("line").cast("string")), "at": F.struct("step", "uid", "line", "problem_id"),
    })
    return prep.find_request(rows, F.col("request_id"), "10-01", "at").select("uid", "line", "problem_id", "step")


# --- dedup, order, sampling ----------------------------------------------------------------------


@query("dedup_first_by_key", "SELECT min(event_id) AS event_id FROM events GROUP BY user_id, event_type")
def dedup_first_by_key(spark, d):
    """The key is a map whose entries come in two orders."""
    ev = src.table(spark, d, "events").select("event_id", "user_id", "event_type")
    u = F.col("user_id").cast("string")
    a = F.create_map(F.lit("user"), u, F.lit("kind"), F.col("event_type"))
    b = F.create_map(F.lit("kind"), F.col("event_type"), F.lit("user"), u)
    rows = ev.withColumn("key", F.when(F.col("event_id") % 2 == 0, a).otherwise(b))
    return prep.first_by_key(rows, sp.canonical(F.col("key")), F.col("event_id")).select("event_id")


@query(
    "dedup_problems",
    """WITH p AS (SELECT conv_id, coalesce(arg_min(content, i) FILTER (WHERE role = 'user'), '') AS problem FROM messages GROUP BY conv_id)
SELECT min(conv_id) AS conv_id, md5(problem) AS problem FROM p GROUP BY problem""",
    M,
)
def dedup_problems(spark, d):
    ends = prep.conversation_ends(src.messages(spark, d), ["conv_id"], "i")
    rows = ends.select("conv_id", F.coalesce("question", F.lit("")).alias("problem"))
    out = prep.first_by_key(rows, F.col("problem"), F.col("conv_id"))
    return out.select("conv_id", F.md5("problem").alias("problem"))


@query("assert_unique_index", "SELECT count(*) AS n_rows, 0::BIGINT AS duplicates, true AS ok FROM orders")
def assert_unique_index(spark, d):
    rows = bt.counted(_orders(spark, d), "expected").withColumn("shard", F.col("idx") % 4)
    return sp.check_merge(rows, "idx", "shard", "expected")


@query("max_samples", "SELECT doc_id, true AS first FROM (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 100) UNION ALL SELECT doc_id, false FROM (SELECT doc_id FROM documents ORDER BY md5('11:' || doc_id) LIMIT 100)")
def max_samples(spark, d):
    """The first hundred rows, and a seeded hundred."""
    docs = src.table(spark, d, "documents").select("doc_id")
    first = sp.first_rows(docs, 100, "doc_id").withColumn("first", F.lit(True))
    return first.unionByName(sp.sample_rows(docs, 100, 11, F.col("doc_id")).withColumn("first", F.lit(False)))


@query("sample_for_review", "SELECT doc_id FROM documents ORDER BY md5('42:' || text || ':' || doc_id) LIMIT 20")
def sample_for_review(spark, d):
    docs = src.table(spark, d, "documents").select("doc_id", "text")
    return sp.review_sample(docs, 20, 42, F.col("text"), F.col("doc_id")).select("doc_id")


@query(
    "sort_by_score",
    """WITH s AS (SELECT doc_id, coalesce(quality::DOUBLE, toxic::DOUBLE, 0.0) AS score FROM documents LEFT JOIN labels USING (doc_id))
SELECT doc_id, score, row_number() OVER (ORDER BY score DESC, doc_id) AS position FROM s""",
)
def sort_by_score(spark, d):
    """The position is numbered in the sorted order so that it can be compared."""
    docs = src.table(spark, d, "documents").select("doc_id").join(src.table(spark, d, "labels"), "doc_id", "left")
    rows = docs.select("doc_id", F.col("quality").cast("double").alias("score"), F.col("toxic").cast("double").alias("score_1"))
    rows = rows.select("doc_id", sp.score_order(rows).alias("score"))
    out = bt.with_index(rows, [F.col("score").desc(), F.col("doc_id")], out="i")
    return out.select("doc_id", "score", (F.col("i") + 1).alias("position"))


@query(
    "search_text",
    """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents)
SELECT doc_id, line_no::INT AS line_no, line FROM l WHERE contains(line, 'ation')""",
)
def search_text(spark, d):
    return sp.matching_lines(src.table(spark, d, "documents"), "text", "ation", "doc_id").select("doc_id", "line_no", "line")


@query("unique_sampling_seed", "SELECT uid, sample_idx, 1000 + sample_idx AS seed FROM rollouts", G)
def unique_sampling_seed(spark, d):
    return src.rollouts(spark, d, index=True).select("uid", "sample_idx", sp.replica_seed(1000, F.col("sample_idx")).alias("seed"))


@query(
    "pf_resample",
    """WITH w AS (SELECT step, uid, sample_idx, (score * score + 1e-8)::DECIMAL(20,10) AS w, md5('5:' || uid || ':' || sample_idx) AS draw FROM rollouts),
c AS (SELECT *, sum(w) OVER (PARTITION BY step ORDER BY draw, uid, sample_idx) AS cum, sum(w) OVER (PARTITION BY step) AS total, count(*) OVER (PARTITION BY step) AS n FROM w),
e AS (SELECT *, least(cum::DOUBLE / (total::DOUBLE / n), n::DOUBLE) AS hi, least((cum - w)::DOUBLE / (total::DOUBLE / n), n::DOUBLE) AS lo FROM c),
d AS (SELECT *, floor(hi) + CASE WHEN ('0x' || substr(md5('5:' || step || ':' || floor(hi)::BIGINT), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE < hi - floor(hi) THEN 1 ELSE 0 END AS b,
  floor(lo) + CASE WHEN ('0x' || substr(md5('5:' || step || ':' || floor(lo)::BIGINT), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE < lo - floor(lo) THEN 1 ELSE 0 END AS a FROM e)
SELECT step, uid, sample_idx, (b - a)::INT AS copies FROM d WHERE b > a""",
    G,
)
def pf_resample(spark, d):
    rows = sp.resample(src.rollouts(spark, d, index=True), "score", ["uid", "sample_idx"], seed=5)
    return rows.where("copy = 1").select("step", "uid", "sample_idx", "copies")


# --- packing -------------------------------------------------------------------------------------

COST = "c AS (SELECT *, (24576 * (prompt_len + resp_len) + (prompt_len + resp_len) ** 2)::BIGINT AS cost FROM rollouts)"


def _costed(spark, d):
    rows = src.rollouts(spark, d, index=True)
    return rows.withColumn("cost", pk.workload(F.col("prompt_len") + F.col("resp_len")))


def _zigzag(rank: str, k: str) -> str:
    return f"(CASE WHEN ({rank}) // {k} % 2 = 0 THEN ({rank}) % {k} ELSE {k} - 1 - ({rank}) % {k} END)::BIGINT"


BINNED = f"""{COST}, r AS (SELECT *, row_number() OVER (PARTITION BY step ORDER BY cost DESC, uid, sample_idx) - 1 AS rk FROM c),
p AS (SELECT *, {_zigzag("rk", "8")} AS bin FROM r)"""


@query("pack_balanced", f"WITH {BINNED} SELECT step, uid, sample_idx, bin FROM p", G)
def pack_balanced(spark, d):
    return pk.pack_balanced(_costed(spark, d), 8, "cost", ["uid", "sample_idx"]).select("step", "uid", "sample_idx", "bin")


@query(
    "pack_by_group",
    f"""WITH {COST}, g AS (SELECT step, uid, sum(cost) AS cost FROM c GROUP BY step, uid),
r AS (SELECT step, uid, row_number() OVER (PARTITION BY step ORDER BY cost DESC, uid) - 1 AS rk FROM g)
SELECT c.step, c.uid, sample_idx, {_zigzag("rk", "8")} AS bin FROM c JOIN r ON c.step = r.step AND c.uid = r.uid""",
    G,
)
def pack_by_group(spark, d):
    return pk.pack_by_group(_costed(spark, d), 8, "cost").select("step", "uid", "sample_idx", "bin")


@query(
    "pack_by_tokens",
    f"""WITH c AS (SELECT *, prompt_len + resp_len AS len, (24576 * (prompt_len + resp_len) + (prompt_len + resp_len) ** 2)::BIGINT AS cost FROM rollouts),
k AS (SELECT step, (ceil(greatest(least(count(*), ceil(sum(len) / 4096)), 2) / 4) * 4)::BIGINT AS bins FROM c GROUP BY step),
r AS (SELECT c.*, bins, row_number() OVER (PARTITION BY c.step ORDER BY cost DESC, uid, sample_idx) - 1 AS rk FROM c JOIN k ON c.step = k.step)
SELECT step, uid, sample_idx, bins, {_zigzag("rk", "bins")} AS bin FROM r""",
    G,
)
def pack_by_tokens(spark, d):
    rows = src.rollouts(spark, d, index=True).withColumn("len", F.col("prompt_len") + F.col("resp_len"))
    return pk.pack_by_tokens(rows, 4096, "len", ["uid", "sample_idx"], at_least=2, multiple=4).select("step", "uid", "sample_idx", "bins", "bin")


@query(
    "pack_order",
    f"""WITH {BINNED}, o AS (SELECT *, row_number() OVER (PARTITION BY step, bin ORDER BY cost, uid, sample_idx) - 1 AS r, count(*) OVER (PARTITION BY step, bin) AS n FROM p),
t AS (SELECT step, bin, sum(cost) AS cost FROM p GROUP BY step, bin),
q AS (SELECT step, bin, row_number() OVER (PARTITION BY step ORDER BY cost DESC, bin DESC) - 1 AS r, count(*) OVER (PARTITION BY step) AS n FROM t)
SELECT o.step, o.uid, o.sample_idx, o.bin, (CASE WHEN o.r % 2 = 0 THEN o.r // 2 ELSE o.n - 1 - (o.r - 1) // 2 END)::BIGINT AS position,
  (CASE WHEN q.r % 2 = 0 THEN ceil(q.n / 2.0)::BIGINT - 1 - q.r // 2 ELSE ceil(q.n / 2.0)::BIGINT + (q.r - 1) // 2 END)::BIGINT AS bin_position
FROM o JOIN q ON o.step = q.step AND o.bin = q.bin""",
    G,
)
def pack_order(spark, d):
    rows = pk.pack_balanced(_costed(spark, d), 8, "cost", ["uid", "sample_idx"])
    placed = pk.pack_order(rows, "cost", ["uid", "sample_idx"])
    bins = pk.bin_order(rows.groupBy("step", "bin").agg(F.sum("cost").alias("cost")), "cost").drop("cost")
    return placed.join(bins, ["step", "bin"]).select("step", "uid", "sample_idx", "bin", "position", "bin_position")


@query(
    "pack_stats",
    f"""WITH {BINNED}, a AS (SELECT *, row_number() OVER (PARTITION BY step ORDER BY uid, sample_idx) - 1 AS pos, count(*) OVER (PARTITION BY step) AS n FROM p),
x AS (SELECT step, pos * 8 // n AS run, sum(cost) AS c FROM a GROUP BY step, pos * 8 // n), y AS (SELECT step, bin, sum(cost) AS c FROM p GROUP BY step, bin),
xs AS (SELECT step, min(c)::BIGINT AS min_before, max(c)::BIGINT AS max_before, round(avg(c), 6) + 0.0 AS mean FROM x GROUP BY step),
ys AS (SELECT step, min(c)::BIGINT AS min_after, max(c)::BIGINT AS max_after FROM y GROUP BY step)
SELECT *, max_before - min_before AS diff_before FROM xs JOIN ys USING (step)""",
    G,
)
def pack_stats(spark, d):
    from trajtable.plans.skew import ranked

    rows = pk.pack_balanced(_costed(spark, d), 8, "cost", ["uid", "sample_idx"])
    rows = ranked(rows, ["step"], [F.col("uid"), F.col("sample_idx")], out="arrival")
    out = pk.pack_stats(rows.withColumn("arrival", F.col("arrival") - 1), 8, "cost", "arrival")
    return out.withColumn("mean", r6("mean"))
