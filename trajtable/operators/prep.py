"""Row construction, filters, masks and joins for prompt and trajectory tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajtable.operators.sampling import seeded
from trajtable.plans.skew import join_on, positions, ranked, with_stats


def drop_padding(df: DataFrame, flag: str, batch: Sequence[str]) -> DataFrame:
    """Leave out synthetic rows, unless a whole batch is synthetic."""
    rows = with_stats(df, batch, F.bool_and(flag).alias("_all"))
    return rows.where(~F.col(flag) | F.col("_all")).drop("_all")


# --- prompt rows ---------------------------------------------------------------------------------

# fixed values: answer patterns and instructions
HASH_ANSWER = r"#### (-?[0-9.,]+)"
HASH_INSTRUCTION = 'Let\'s think step by step and output the final answer after "####".'
BOXED_INSTRUCTION = "Let's think step by step and output the final answer within \\boxed{}."
TRUNCATION_NOTE = "\n[... initial solution truncated ...]"
REWRITE_HEAD = "Your task is to rewrite your mathematical solution.\n\n**Problem:**\n"
REWRITE_MIDDLE = "\n\n**Your Initial Solution:**\n"
REWRITE_TAIL = """

**Instructions:**
1. Preserve the overall structure and reasoning path of your original solution
2. Identify and fix errors in computation or logic
3. Keep correct intermediate steps and meaningful work
4. Output ONLY the rewritten solution"""


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def must(value: Column, problem: str) -> Column:
    """The value, or an error where it is null."""
    return F.when(value.isNull(), F.raise_error(F.lit(problem)).cast("string")).otherwise(value)


def prompt_row(
    content: Column, truth: Column, index: Column, source: Column | str, split: str, ability: str = "math",
    style: str = "rule", **extra: Column,
) -> list[Column]:
    """The five columns of a prompt table."""
    source = F.lit(source) if isinstance(source, str) else source
    info = [F.lit(split).alias("split"), index.alias("index"), *[c.alias(k) for k, c in extra.items()]]
    return [
        source.alias("data_source"),
        F.array(message("user", content)).alias("prompt"),
        F.lit(ability).alias("ability"),
        F.struct(F.lit(style).alias("style"), truth.alias("ground_truth")).alias("reward_model"),
        F.struct(*info).alias("extra_info"),
    ]


def hash_answer(text: Column) -> Column:
    """First number after ``#### ``, without commas; null when there is none."""
    found = F.regexp_extract(text, HASH_ANSWER, 1)
    return F.when(found != "", F.replace(found, F.lit(","), F.lit("")))


def clean_choice(text: Column) -> Column:
    """Strip, turn `` [title]`` into a full stop, drop bracketed notes, collapse double blanks once."""
    text = F.regexp_replace(text, r"^\s+|\s+$", "")
    text = F.replace(text, F.lit(" [title]"), F.lit(". "))
    text = F.regexp_replace(text, r"\[.*?\]", "")
    return F.replace(text, F.lit("  "), F.lit(" "))


def capitalised(text: Column) -> Column:
    """First letter upper, the rest lower."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, F.lit(2), F.length(text))))


def tool_kwargs(tool: str, **values: Column) -> Column:
    """JSON of the arguments a tool is created with."""
    return F.to_json(F.struct(F.struct(F.struct(*[v.alias(k) for k, v in values.items()]).alias("create_kwargs")).alias(tool)))


def split_rows(df: DataFrame, index: str, total: str, head: float = 0.75) -> DataFrame:
    """First ``head`` share is train, last ``1 - head`` share is test."""
    n = F.col(total)
    train = F.when(F.col(index) < F.round(n * head), "train")
    test = F.when(F.col(index) >= n - F.round(n * (1 - head)), "test")
    return df.withColumn("split", F.explode(F.array_compact(F.array(train, test))))


def normalise_truth(raw: Column) -> Column:
    """Ground truth as text from JSON or plain text.

    An object gives the first present key of answer, ground_truth, target, solution; a non-empty
    list its first element; null gives the empty string.
    """
    keys = F.json_object_keys(raw)
    out = None
    for name in ("answer", "ground_truth", "target", "solution"):
        value = F.coalesce(F.get_json_object(raw, f"$.{name}"), F.lit(""))
        cond = F.array_contains(keys, name)
        out = out.when(cond, value) if out is not None else F.when(cond, value)
    is_list = raw.startswith("[") & (F.json_array_length(raw) > 0)
    return out.when(is_list, F.coalesce(F.get_json_object(raw, "$[0]"), F.lit(""))).otherwise(F.coalesce(raw, F.lit("")))


def placeholders(df: DataFrame, keys: Sequence[str], order: Sequence[str], content: str) -> DataFrame:
    """One row per non-empty content part; the k-th placeholder of a kind is numbered across messages."""
    marks = "<image>|<video>|<audio>"
    parts = F.filter(F.split(content, f"(?={marks})|(?<={marks})"), lambda p: p != "")
    rows = df.select(*keys, *order, F.posexplode(parts).alias("part_no", "part"))
    kind = F.when(F.col("part").isin("<image>", "<video>", "<audio>"), F.expr("substring(part, 2, 5)")).otherwise("text")
    rows = rows.withColumn("kind", kind)
    ids = ranked(rows, [*keys, "kind"], [*map(F.col, order), F.col("part_no")], out="_k")
    return ids.withColumn("media_no", F.when(F.col("kind") != "text", F.col("_k") - 1)).drop("_k")


def rewrite_prompt(problem: Column, response: Column) -> Column:
    return F.concat(F.lit(REWRITE_HEAD), problem, F.lit(REWRITE_MIDDLE), response, F.lit(REWRITE_TAIL))


def first_of_role(messages: Column, role: str) -> Column:
    found = F.filter(messages, lambda m: m.role == role)
    return F.get(found, F.lit(0))["content"]


def fit_response(ids: Column, prompt_len: Column, empty_len: Column, budget: int) -> dict[str, Column]:
    """Response tokens kept inside a prompt budget, and how many were dropped."""
    room = F.greatest(F.lit(budget) - empty_len - 16, F.lit(0))
    fits = prompt_len <= budget
    return {
        "kept_ids": F.when(fits, ids).otherwise(F.slice(ids, F.lit(1), room)),
        "dropped": F.when(fits, 0).otherwise(F.greatest(F.size(ids) - room, F.lit(0))),
        "cut": ~fits,
    }


# --- token arrays --------------------------------------------------------------------------------


def constant(value: int, n: Column) -> Column:
    return F.array_repeat(F.lit(value), F.greatest(n, F.lit(0)))


def iota(n: Column) -> Column:
    """0 .. n-1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def sft_row(prompt: Column, response: Column) -> dict[str, Column]:
    """Ids, loss mask and positions of a prompt followed by its response."""
    n = F.size(prompt) + F.size(response)
    return {
        "input_ids": F.concat(prompt, response),
        "loss_mask": F.concat(constant(0, F.size(prompt)), constant(1, F.size(response))),
        "position_ids": iota(n),
    }


def head(x: Column, n: int | Column) -> Column:
    return F.slice(x, F.lit(1), F.lit(n) if isinstance(n, int) else n)


def tail(x: Column, n: int) -> Column:
    size = F.size(x)
    return F.slice(x, F.greatest(size - n, F.lit(0)) + 1, F.lit(n))


def truncate(x: Column, limit: int, how: str) -> Column:
    """Cut an array to ``limit``: left keeps the end, right the start, middle half of each, error refuses."""
    n = F.size(x)
    if how == "left":
        cut = tail(x, limit)
    elif how == "right":
        cut = head(x, limit)
    elif how == "middle":
        cut = F.concat(head(x, limit // 2), tail(x, limit - limit // 2))
    elif how == "error":
        cut = F.when(n > limit, F.raise_error(F.concat(n.cast("string"), F.lit(f" tokens exceed {limit}"))).cast("array<int>")).otherwise(x)
    else:
        raise ValueError(f"unknown truncation {how}")
    return F.when(n > limit, cut).otherwise(x)


def pad(x: Column, limit: int, value: int, left: bool = False) -> Column:
    fill = constant(value, F.lit(limit) - F.size(x))
    return F.concat(fill, x) if left else F.concat(x, fill)


def pad_truncate(x: Column, limit: int, pad_id: int, how: str, left_pad: bool = False) -> Column:
    return pad(truncate(x, limit, how), limit, pad_id, left_pad)


def sft_fit(row: dict[str, Column], limit: int, pad_id: int = 0, how: str = "right", mode: str = "right") -> dict[str, Column]:
    """Truncate and pad the arrays of ``sft_row``.

    A left cut numbers positions anew. Without padding the cut is always on the right, unless the
    truncation is ``error``.
    """
    if mode not in ("right", "none"):
        raise ValueError(f"unknown pad mode {mode}")
    if how not in ("left", "right", "error"):
        raise ValueError(f"unknown truncation {how}")
    side = how if mode == "right" or how == "error" else "right"
    cut = {k: truncate(v, limit, side) for k, v in row.items() if k != "position_ids"}
    cut["position_ids"] = iota(F.size(cut["input_ids"]))
    if mode == "none":
        return cut
    return {k: pad(v, limit, pad_id if k == "input_ids" else 0) for k, v in cut.items()}


def message_masks(role: Column, content: Column, i: Column, prefix: int, system_len: int) -> dict[str, Column]:
    """Of the ``i``-th message: the words after the shared system prefix, and a mask that is 1 on assistant words.

    The template wraps every message in ``system_len`` system words and, for assistants, ``prefix``
    generation-prompt words; the former are dropped from all but the first or system message, the
    latter are masked out.
    """
    bot = role == "assistant"
    lengths = F.transform(F.split(content, " "), lambda w: F.length(w))
    lead = F.when((i != 0) & (role != "system"), 0).otherwise(system_len)
    gen = F.when(bot, prefix).otherwise(0)
    # a first assistant message has its mask cut at the prefix length, counted from its start
    total = lead + gen + F.size(lengths)
    on = F.when(bot, F.greatest(total - prefix, F.lit(0))).otherwise(0)
    return {
        "input_ids": F.concat(F.array_repeat(F.lit(-1), lead), F.array_repeat(F.lit(-2), gen), lengths),
        "loss_mask": F.concat(F.array_repeat(F.lit(0), total - on), F.array_repeat(F.lit(1), on)),
    }


def conversation_ends(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """First system and user message and last assistant message of each conversation, by aggregation."""
    of = lambda name, pick: pick(F.when(F.col("role") == name, F.col("content")), F.when(F.col("role") == name, F.col(order)))
    return rows.groupBy(*keys).agg(
        of("system", F.min_by).alias("system"), of("user", F.min_by).alias("question"), of("assistant", F.max_by).alias("answer")
    )


def eos_mask(ids: Column, eos: Sequence[int]) -> Column:
    """1 up to and including the first end token, 0 after it."""
    spots = [F.array_position(ids, e) for e in eos]
    first = F.array_min(F.array(*[F.when(s > 0, s) for s in spots]))
    return F.transform(ids, lambda _, i: F.when(first.isNull() | (i < first), 1).otherwise(0))


def eos_rows(df: DataFrame, eos: Sequence[int], traj: Sequence[str], t: str = "t", token: str = "tok") -> DataFrame:
    """``eos_mask`` on token rows: 1 up to and including the first end token of the trajectory."""
    rows = with_stats(df, traj, F.min(F.when(F.col(token).isin(*eos), F.col(t))).alias("_eos"))
    return rows.withColumn("eos_mask", F.when(F.col("_eos").isNull() | (F.col(t) <= F.col("_eos")), 1).otherwise(0)).drop("_eos")


def aligned_teacher(values: Column, teacher_prompt: Column, response: Column, prompt: Column) -> Column:
    """Teacher values that predict the response: positions [prompt - 1, prompt - 1 + response)."""
    p, r = F.size(teacher_prompt), F.size(response)
    wrong = F.raise_error(F.lit("teacher values do not match prompt plus response")).cast("array<int>")
    empty = F.raise_error(F.lit("empty prompt")).cast("array<int>")
    return (
        F.when((p <= 0) | (F.size(prompt) <= 0), empty).when(F.size(values) != p + r, wrong).otherwise(F.slice(values, p, r))
    )


# --- filters -------------------------------------------------------------------------------------


def drop_overlong(df: DataFrame, length: Column, limit: int = 1024) -> DataFrame:
    """Keep prompts of at most ``limit`` tokens; a row whose length is unknown counts as too long."""
    return df.where(F.coalesce(length, F.lit(limit + 1)) <= limit)


def first_by_key(df: DataFrame, key: Column, order: Column) -> DataFrame:
    """First row per key; the shuffle carries one candidate per key and task."""
    cols = df.columns
    row = F.struct(*cols)
    return df.groupBy(key.alias("_key")).agg(F.min_by(row, order).alias("_r")).select("_r.*")


def offline_filter(
    df: DataFrame, position: str, sample: int | None = None, unique: Column | None = None, max_prompt: int | None = None,
    max_response: int | None = None, max_rows: int | None = None, seed: int | None = None,
) -> DataFrame:
    """Sample index, then uniqueness, then lengths, then the row limit, in this order.

    With a ``seed`` the limit takes a seeded random choice, else the first rows.
    """
    from trajtable.operators.sampling import first_rows, sample_rows, seeded

    if sample is not None:
        df = df.where(F.coalesce("sample_idx", F.lit(-1)) == sample)
    if unique is not None:
        df = first_by_key(df, unique, F.col(position))
    if max_prompt is not None:
        df = df.where(F.col("prompt_len") <= max_prompt)
    if max_response is not None:
        df = df.where(F.col("response_len") <= max_response)
    if not max_rows:
        return df
    return first_rows(df, max_rows, position) if seed is None else sample_rows(df, max_rows, seed, F.col(position))


def informative_groups(df: DataFrame, metric: str, keys: Sequence[str]) -> DataFrame:
    """Drop prompt groups whose metric has a single value."""
    rows = with_stats(df, keys, F.min(metric).alias("_lo"), F.max(metric).alias("_hi"))
    return rows.where(F.col("_lo") != F.col("_hi")).drop("_lo", "_hi")


def fill_batch(df: DataFrame, metric: str, group: str, batch: str, size: int, max_batches: int = 0) -> DataFrame:
    """Accumulate informative groups over generation batches until ``size`` groups are there.

    Groups are taken in order of batch and group, the surplus is cut. At most ``max_batches``
    generation batches are used (0: no limit). Too few groups in them is an error.
    """
    if max_batches:
        first = df.select(batch).distinct().orderBy(batch).limit(max_batches)
        df = df.join(F.broadcast(first), batch, "left_semi")
    kept = informative_groups(df, metric, [batch, group])
    groups = kept.select(batch, group).distinct()
    chosen = groups.orderBy(batch, group).limit(size)
    short = F.raise_error(F.concat(F.lit(f"{size} groups are needed, qualified are "), F.col("_n").cast("string"))).cast("boolean")
    enough = F.when(F.col("_n") < size, short).otherwise(True)
    ready = chosen.agg(F.count(F.lit(1)).alias("_n")).select(enough.alias("_ok"))
    return join_on(kept, chosen, [batch, group], "left_semi").where(ready.scalar())


# --- joins ---------------------------------------------------------------------------------------


def union_columns(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Add the right side's columns; shared columns must hold equal values."""
    shared = [c for c in right.columns if c in left.columns and c != key]
    fresh = [c for c in right.columns if c not in left.columns]
    both = left.join(right.select(key, *fresh, *[F.col(c).alias(f"_r_{c}") for c in shared]), key)
    for c in shared:
        clash = F.raise_error(F.lit(f"column {c} differs between the two sides"))
        same = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        both = both.withColumn(c, F.when(same, F.col(c)).otherwise(clash.cast(dict(left.dtypes)[c])))
    return both.drop(*[f"_r_{c}" for c in shared])


BASELINE_PREFIX = "remax_baseline_"


def reward_baseline(df: DataFrame, uid: str = "uid", index: str = "output_idx", score: str = "score") -> DataFrame:
    """Give every sampled row the score of its prompt's greedy rollout (last output), drop the greedy rows."""
    greedy = F.col(uid).startswith(BASELINE_PREFIX)
    base = df.where(greedy).select(
        F.replace(F.col(uid), F.lit(BASELINE_PREFIX), F.lit("")).alias(uid), F.col(index).alias("_i"), F.col(score).alias("_s")
    )
    base = base.groupBy(uid).agg(F.max_by("_s", "_i").alias("baseline"))
    return df.where(~greedy).join(base, uid)


def route(df: DataFrame, key: str, teachers: dict[str, str]) -> DataFrame:
    """Map a key column to a teacher name; an unknown key is an error."""
    table = F.create_map(*[F.lit(x) for pair in teachers.items() for x in pair])
    found = F.try_element_at(table, F.col(key))
    unknown = F.raise_error(F.concat(F.lit("no teacher for "), F.col(key))).cast("string")
    return df.withColumn("teacher", F.when(found.isNull(), unknown).otherwise(found))


def find_request(df: DataFrame, request: Column, wanted: str, step: str) -> DataFrame:
    """Rows of one request id (hyphens ignored), earliest step only."""
    bare = lambda c: F.replace(c, F.lit("-"), F.lit(""))
    hits = df.where(bare(request) == wanted.replace("-", ""))
    return hits.agg(F.min_by(F.struct(*df.columns), step).alias("_r")).where("_r is not null").select("_r.*")


# fixed values: speakers of caption files and the roles they stand for
SPEAKERS = {"human": "user", "gpt": "assistant"}


def speaker_messages(conversation: Column) -> Column:
    """Turns (from, value) as messages (role, content); an unknown speaker is an error."""
    def message(turn: Column) -> Column:
        unknown = F.raise_error(F.concat(F.lit("unknown speaker: "), F.coalesce(turn["from"], F.lit("null")))).cast("string")
        role = unknown
        for speaker, name in SPEAKERS.items():
            role = F.when(turn["from"] == speaker, name).otherwise(role)
        return F.struct(role.alias("role"), turn["value"].alias("content"))

    return F.transform(conversation, message)


def seeded_split(df: DataFrame, key: str, share: float, seed: int, out: str = "split") -> DataFrame:
    """``test`` for a seeded choice of ceil(share * rows) rows, ``train`` for the others; ``key`` must be distinct."""
    rows = positions(df.withColumn("_draw", seeded(seed, F.col(key))), [F.col("_draw"), F.col(key)], "_place")
    test = math.ceil(df.count() * share)
    return rows.withColumn(out, F.when(F.col("_place") < test, "test").otherwise("train")).drop("_draw", "_place")


def epoch_order(df: DataFrame, key: str, epochs: int, seed: int, start: tuple[int, int] = (0, 0)) -> DataFrame:
    """(epoch, position, key) in a seeded order of its own for every epoch, from a place (epoch, position) on.

    The order depends on seed, epoch and key alone, so a run that stopped goes on at the place it kept, on any
    cluster. ``key`` must be distinct.
    """
    rows = df.select(key, F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))
    rows = rows.withColumn("_draw", seeded(seed, F.col("epoch"), F.col(key)))
    rows = ranked(rows, ["epoch"], [F.col("_draw"), F.col(key)], out="_rank")
    rows = rows.select("epoch", (F.col("_rank") - 1).alias("position"), key)
    return rows.where((F.col("epoch") > start[0]) | ((F.col("epoch") == start[0]) & (F.col("position") >= start[1])))
