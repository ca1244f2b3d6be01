"""Hand-off analysis on logged tokens: where would a teacher take over a rollout.

Everything here annotates a fixed log. Nothing is generated again after a hand-off.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajtable.plans.skew import by_position, materialise, ranked, running

# fixed values: token texts that mark a change of mind
REFLECTION_MARKERS = (
    "Wait", " Wait", "wait", " wait", "But", " But", "but", " but",
    "Hmm", " Hmm", " hmm", "Actually", " Actually", "actually", " actually",
    "Hold", " Hold", "hold", " hold", "However", " However", "however", " however",
    "Yet", " Yet", "yet", " yet", "Oh", " Oh", "oh", " oh",
    "Alternatively", " Alternatively", "No", " No", "no", " no",
    "Ah", " Ah", "ah", " ah", "Oops", " Oops", "Well", " Well",
)
TOKEN_CAP = 256  # further tokens a leg may take
DRAFT_TOPK = 25  # accepted drafts lie in the teacher's top 25


def reflection_ids(vocab: DataFrame, markers: Sequence[str] = REFLECTION_MARKERS) -> DataFrame:
    """Ids of single tokens that are a marker; at most one row per vocabulary entry of the markers."""
    return vocab.where(F.col("text").isin(*markers)).select("token_id")


def boundary_ids(vocab: DataFrame) -> DataFrame:
    """Ids of tokens whose text contains a blank line."""
    return vocab.where(F.col("text").contains("\n\n")).select("token_id")


def mark(df: DataFrame, ids: DataFrame, token: str, out: str) -> DataFrame:
    """Flag rows whose token is in a vocabulary subset (a vocabulary has a fixed size, so it is broadcast)."""
    listed = F.broadcast(ids.select(F.col("token_id").alias(token), F.lit(True).alias(out)).distinct())
    return df.join(listed, token, "left").withColumn(out, F.coalesce(out, F.lit(False)))


def candidate(teacher: Column, student: Column, reflection: Column, valid: Column) -> Column:
    """The teacher's argmax is a marker and differs from the student's token."""
    return reflection & (teacher != student) & valid


def trigger(is_candidate: Column, teacher: Column, student_top: Column, k: int = 5) -> Column:
    """A candidate whose token the student does not have among its k best."""
    if k <= 0:
        raise ValueError("the student top-k must be positive")
    return is_candidate & ~F.array_contains(F.slice(student_top, 1, k), teacher)


def first_triggers(df: DataFrame, traj: Sequence[str], t: str = "t", flag: str = "trigger") -> DataFrame:
    """First trigger per trajectory and the student tokens before it."""
    return df.groupBy(*traj).agg(
        F.min(F.when(F.col(flag), F.col(t))).alias("first_trigger"),
        F.count(F.lit(1)).alias("n_tokens"),
    ).withColumn("student_tokens", F.coalesce("first_trigger", "n_tokens").cast("bigint"))


def _chain(df: DataFrame, traj: Sequence[str], paragraphs: int, cap: int, t: str, flag: str, boundary: str) -> DataFrame:
    """Triggers that open a leg, numbered from 1 in a trajectory: ``start``, ``end`` and the number of the ``next``
    trigger after the end. Ends and followers are found by running counts and joins on positions."""
    rows = df.select(*traj, F.col(t).cast("bigint").alias("t"), F.col(flag).alias("_f"), F.col(boundary).alias("_b"))
    left = F.lit(paragraphs) - F.when(F.col("_b"), 1).otherwise(0)
    counts = {"_nb": F.col("_b").cast("bigint"), "_nt": (F.col("_f") & (left > 0)).cast("bigint")}
    rows = materialise(running(by_position(rows, "t"), traj, [F.col("t")], behind=counts))
    opened = rows.where(F.col("_f") & (left > 0)).select(*traj, F.col("_nt").alias("i"), F.col("t").alias("start"), (F.col("_nb") + left).alias("_want"))
    bounds = rows.where("_b").select(*traj, F.col("_nb").alias("_want"), F.col("t").alias("_at"))
    last = F.col("start") + cap
    opened = opened.join(bounds, [*traj, "_want"], "left").withColumn("end", F.least(F.coalesce("_at", last), last)).drop("_want", "_at")
    passed = rows.select(*traj, F.col("t").alias("end"), (F.col("_nt") + 1).alias("next"))
    return opened.join(passed, [*traj, "end"], "left")


def _entries(maps: DataFrame, traj: Sequence[str], fold: int = 512) -> DataFrame:
    """Where the walk enters each piece, as an offset or -1; the first piece is entered at 0.

    ``map`` tells for every offset at which a piece may be entered the offset in the next piece. Maps compose
    to maps: those of ``fold`` pieces become one, which are scanned in the same way.
    """
    step = lambda m, x: F.when(x < 0, -1).otherwise(F.coalesce(F.get(m, x), F.lit(-1)))
    groups = maps.groupBy(*traj, F.floor(F.col("piece") / fold).cast("bigint").alias("_g")).agg(F.array_sort(F.collect_list(F.struct("piece", "map"))).alias("_m"))
    groups = materialise(groups)
    if groups.agg(F.max("_g")).first()[0]:
        widest = F.aggregate("_m", F.lit(0), lambda n, m: F.greatest(n, F.size(m["map"])))
        whole = F.aggregate("_m", F.sequence(F.lit(0), widest - 1), lambda at, m: F.transform(at, lambda x: step(m["map"], x)))
        above = _entries(groups.select(*traj, F.col("_g").alias("piece"), whole.alias("map")), traj, fold)
        groups = groups.join(above.select(*traj, F.col("piece").alias("_g"), F.col("entry").alias("_from")), [*traj, "_g"])
    else:
        groups = groups.withColumn("_from", F.lit(0))
    start = F.struct(F.col("_from").alias("at"), F.array().cast("array<struct<piece:bigint,entry:int>>").alias("out"))
    walked = F.aggregate(
        "_m", start,
        lambda s, m: F.struct(step(m["map"], s["at"]).alias("at"), F.concat(s["out"], F.array(F.struct(m["piece"].alias("piece"), s["at"].alias("entry")))).alias("out")),
    )
    return groups.select(*traj, F.inline(walked["out"]))


def leg_rows(
    df: DataFrame, traj: Sequence[str], paragraphs: int, max_legs: int, cap: int = TOKEN_CAP, t: str = "t",
    flag: str = "trigger", boundary: str = "boundary", size: int = 512,
) -> DataFrame:
    """One row per teacher leg: ``leg`` from 1, ``start``, ``end`` and whether it is ``complete``.

    A trigger opens a leg: its token plus the following ones until ``paragraphs`` boundaries or
    ``cap`` further tokens. Triggers inside a leg do nothing. Finished legs are counted and the
    trajectory stops after the ``max_legs``-th (0: never). With 0 paragraphs every trigger is a one-token
    leg. A trigger token that itself uses up the budget opens no leg and is not counted. Positions
    count from 0 without gaps.

    A leg passes over at most ``cap`` triggers, so a piece of consecutive triggers is entered at one
    of its first ``cap`` + 1, whatever came before: a small table gives for each of these where the next
    piece is entered. The tables are composed, and then every piece is walked on its own.
    """
    traj = list(traj)
    ends = df.groupBy(*traj).agg(F.count(F.lit(1)).cast("bigint").alias("_n"))
    if paragraphs <= 0:
        taken = df.where(F.col(flag)).select(*traj, F.col(t).cast("bigint").alias("start"), F.col(t).cast("bigint").alias("end"))
    else:
        size = max(size, cap + 1)
        chain = _chain(df, traj, paragraphs, cap, t, flag, boundary)
        piece = F.floor((F.col("i") - 1) / size).cast("bigint").alias("piece")
        steps = F.array_sort(F.collect_list(F.struct("i", "start", "end", "next"))).alias("_s")
        pieces = materialise(chain.groupBy(*traj, piece).agg(steps))
        first = F.col("piece") * size  # triggers before the piece
        if pieces.agg(F.max("piece")).first()[0]:
            def leave(later: Column, s: Column) -> Column:
                """Put the way out of a trigger in front of those of the triggers after it."""
                to = (s["next"] - 1 - first).cast("int")
                inside = F.coalesce(F.get(later, to - (s["i"] - first).cast("int")), F.lit(-1))
                return F.concat(F.array(F.when(to.isNull(), -1).when(to >= size, to - size).otherwise(inside)), later)

            out = F.aggregate(F.reverse("_s"), F.array().cast("array<int>"), leave)
            entries = _entries(pieces.select(*traj, "piece", F.slice(out, 1, cap + 1).alias("map")), traj)
            pieces = pieces.join(entries, [*traj, "piece"])
        else:
            pieces = pieces.withColumn("entry", F.lit(0))
        state = "struct<at:bigint,legs:array<struct<start:bigint,end:bigint>>>"
        here = F.when(F.col("entry") >= 0, first + F.col("entry") + 1).otherwise(0)

        def walk(s: Column, x: Column) -> Column:
            leg = F.array(F.struct(x["start"].alias("start"), x["end"].alias("end")))
            moved = F.struct(F.coalesce(x["next"], F.lit(0)).alias("at"), F.concat(s["legs"], leg).alias("legs")).cast(state)
            return F.when(x["i"] == s["at"], moved).otherwise(s)

        walked = F.aggregate("_s", F.struct(here.alias("at"), F.array().alias("legs")).cast(state), walk)
        taken = pieces.select(*traj, F.inline(walked["legs"]))
    taken = running(by_position(taken, "start"), traj, [F.col("start")], behind={"leg": F.lit(1).cast("bigint")})
    if max_legs > 0:
        taken = taken.where(F.col("leg") <= max_legs)
    taken = taken.join(ends, traj)
    return taken.select(*traj, "leg", "start", F.least("end", F.col("_n") - 1).alias("end"), (F.col("end") < F.col("_n")).alias("complete"))


def legs(
    df: DataFrame, traj: Sequence[str], paragraphs: int, max_legs: int, cap: int = TOKEN_CAP, t: str = "t",
    flag: str = "trigger", boundary: str = "boundary", size: int = 512,
) -> DataFrame:
    """Legs (see ``leg_rows``) counted per trajectory: n_legs, completed, stop_pos and teacher_tokens."""
    traj = list(traj)
    found = leg_rows(df, traj, paragraphs, max_legs, cap, t, flag, boundary, size).groupBy(*traj).agg(
        F.count(F.lit(1)).cast("int").alias("n_legs"), F.count(F.when(F.col("complete"), 1)).cast("int").alias("completed"),
        F.max(F.when((F.col("leg") == max_legs) & F.col("complete"), F.col("end") + 1)).cast("int").alias("stop_pos"),
        F.sum(F.col("end") - F.col("start") + 1).cast("int").alias("teacher_tokens"),
    )
    counts = df.groupBy(*traj).agg(F.count(F.lit(1)).cast("int").alias("n_tokens"))
    return counts.join(found, traj, "left").fillna(0, ["n_legs", "completed", "teacher_tokens"])


def stops(df: DataFrame, traj: Sequence[str], k: int, stop_id: int, t: str = "t", flag: str = "trigger") -> DataFrame:
    """Trigger-stop mode: emit the trigger token, stop at the next position; one event per stopped trajectory."""
    first = first_triggers(df, traj, t, flag)
    return first.where(F.col("first_trigger").isNotNull()).select(
        *traj, (F.col("first_trigger") + 1).cast("int").alias("response_pos"), F.lit(stop_id).alias("internal_stop_token_id"),
        F.lit(k).alias("student_rank_teacher_argmax_gt"),
    )


def accept_drafts(df: DataFrame, traj: Sequence[str], block: int, t: str = "t", draft: str = "draft", teacher_top: str = "teacher_top") -> DataFrame:
    """Accept a draft token in the teacher's top-k; a block ends at its first rejection."""
    ok = F.array_contains(F.col(teacher_top), F.col(draft)) & (F.col(draft) >= 0)
    rows = df.select(*traj, F.floor(F.col(t) / block).cast("bigint").alias("block"), (F.col(t) % block).cast("int").alias("pos"), ok.alias("ok"))
    per = rows.groupBy(*traj, "block").agg(
        F.min(F.when(~F.col("ok"), F.col("pos"))).alias("first_rejection"), F.count(F.lit(1)).alias("drafted")
    )
    return per.withColumn("accepted", F.coalesce("first_rejection", "drafted").cast("bigint"))


# --- trace events --------------------------------------------------------------------------------


def expand_events(events: DataFrame) -> DataFrame:
    """Single events as they are, chunk events one row per position; rows without request id are dropped."""
    usable = events.where(F.coalesce(F.col("request_id"), F.lit("")) != "")
    chunk = F.transform(
        F.arrays_zip("positions", "tokens"),
        lambda x: F.struct(x.positions.alias("response_pos"), x.tokens.alias("emit_token_id")),
    )
    n = F.least(F.size("positions"), F.size("tokens"))
    single = F.array(F.struct("response_pos", "emit_token_id"))
    both = F.when(F.col("positions").isNotNull(), F.slice(chunk, F.lit(1), F.greatest(n, F.lit(0)))).otherwise(single)
    return usable.select("request_id", "event_no", F.posexplode(both).alias("in_event", "_e")).select(
        "request_id", "event_no", "in_event", "_e.response_pos", "_e.emit_token_id"
    )


def trace_tokens(events: DataFrame, generations: DataFrame) -> DataFrame:
    """Teacher tokens per request and position: in range, the last event of a position wins."""
    rows = events.where(F.col("response_pos").isNotNull()).join(generations.select("request_id", "gen_len"), "request_id")
    rows = rows.where((F.col("response_pos") >= 0) & (F.col("response_pos") < F.col("gen_len")))
    return rows.groupBy("request_id", "response_pos").agg(
        F.max_by("emit_token_id", F.struct("event_no", "in_event")).alias("emit_token_id")
    )


def events_per_generation(events: DataFrame, generations: DataFrame) -> DataFrame:
    """Events of each generation that has any: how many, the last, and how many lie inside the generation.

    One join and one aggregate by request; without a shuffle where both tables are stored in equal buckets.
    """
    rows = events.join(generations.select("request_id", "gen_len").hint("merge"), "request_id")
    return rows.groupBy("request_id", "gen_len").agg(
        F.count(F.lit(1)).alias("n_events"), F.max("event_no").alias("last_event"),
        F.count(F.when(F.col("response_pos") < F.col("gen_len"), 1)).alias("inside"),
    )


def teacher_masks(trace: DataFrame, generations: DataFrame) -> DataFrame:
    """One row per generation with its 0/1 teacher mask (all 0 without events).

    The zeros between neighbouring positions are filled in one walk over the sorted positions.
    """
    hit = trace.groupBy("request_id").agg(F.collect_set("response_pos").alias("_p"))
    rows = generations.join(hit, "request_id", "left")
    inside = F.filter(F.coalesce("_p", F.array().cast("array<int>")), lambda p: (p >= 0) & (p < F.col("gen_len")))
    rows = rows.withColumn("_p", F.array_sort(inside))
    zeros = lambda n: F.array_repeat(F.lit(0), n.cast("int"))
    before = F.concat(F.array(F.lit(-1)), F.slice("_p", F.lit(1), F.greatest(F.size("_p") - 1, F.lit(0))))
    runs = F.zip_with(F.slice(before, F.lit(1), F.size("_p")), "_p", lambda a, p: F.concat(zeros(p - a - 1), F.array(F.lit(1))))
    tail = zeros(F.greatest(F.col("gen_len") - 1 - F.coalesce(F.array_max("_p"), F.lit(-1)), F.lit(0)))
    return rows.withColumn("teacher_mask", F.concat(F.flatten(runs), tail)).drop("_p")


def running_positions(chunks: DataFrame, request: str, order: Sequence[str], token: str, vocab_size: int) -> DataFrame:
    """Number the valid tokens of a request across its chunks; placeholders and unknown ids are skipped.

    ``order`` must be total within a request.
    """
    valid = chunks.where((F.col(token) >= 0) & (F.col(token) < vocab_size))
    return ranked(valid, [request], [F.col(c) for c in order], out="_rank").withColumn("response_pos", F.col("_rank") - 1).drop("_rank")


def earliest_stop(events: DataFrame, request: str = "request_id") -> DataFrame:
    """The event with the smallest position per request; events without a position are ignored."""
    usable = events.where(F.col("response_pos").isNotNull())
    return usable.groupBy(request).agg(
        F.min("response_pos").alias("response_pos"),
        F.min_by("internal_stop_token_id", F.struct("response_pos", "event_no")).alias("internal_stop_token_id"),
    )


def strip_stop(df: DataFrame, ids: str = "tokens") -> DataFrame:
    """Cut ids at the stop position when the token there is the stop token.

    A position right behind the last token counts as removed too. Adds ``removed`` and rewrites
    ``finish_reason`` to ``trigger_stop`` where it was.
    """
    pos, n = F.col("response_pos"), F.size(ids)
    same = F.col("internal_stop_token_id").isNull() | (F.get(F.col(ids), pos) == F.col("internal_stop_token_id"))
    inside = (pos >= 0) & (pos < n) & same
    removed = F.coalesce(inside | (pos == n), F.lit(False))
    return df.withColumn("removed", removed).withColumns(
        {
            "raw_gen_len": n,
            ids: F.when(F.coalesce(inside, F.lit(False)), F.slice(ids, F.lit(1), pos)).otherwise(F.col(ids)),
            "finish_reason": F.when(F.col("removed"), "trigger_stop").otherwise(F.col("finish_reason")),
            "mismatch": pos.isNotNull() & ~F.col("removed"),
        }
    )


def stop_summary(tokens: DataFrame, stops: DataFrame, traj: Sequence[str], t: str = "t", token: str = "tok") -> DataFrame:
    """``strip_stop`` on rows: per row of ``stops``, whether its stop is removed and how many tokens stay.

    ``stops`` has one row per trajectory with ``response_pos``, ``internal_stop_token_id`` and
    ``finish_reason``; a trajectory without tokens has length 0. The tokens that stay are those with
    ``t < gen_len``.
    """
    traj = list(traj)
    seen = tokens.join(stops.select(*traj, "response_pos"), traj).groupBy(*traj).agg(
        F.count(F.lit(1)).cast("int").alias("raw_gen_len"), F.max(F.when(F.col(t) == F.col("response_pos"), F.col(token))).alias("_there")
    )
    rows = stops.join(seen, traj, "left").withColumn("raw_gen_len", F.coalesce("raw_gen_len", F.lit(0)))
    pos, n = F.col("response_pos"), F.col("raw_gen_len")
    same = F.col("internal_stop_token_id").isNull() | (F.col("_there") == F.col("internal_stop_token_id"))
    inside = F.coalesce((pos >= 0) & (pos < n) & same, F.lit(False))
    removed = F.coalesce(inside | (pos == n), F.lit(False))
    return rows.select(
        *traj, "raw_gen_len", F.when(inside, pos).otherwise(n).cast("int").alias("gen_len"), removed.alias("removed"),
        F.when(removed, "trigger_stop").otherwise(F.col("finish_reason")).alias("finish_reason"), (pos.isNotNull() & ~removed).alias("mismatch"),
    )


def trim_trace(df: DataFrame, keep: str = "keep_len") -> DataFrame:
    """Drop mask entries, positions, tokens and events at or beyond ``keep_len``."""
    inside = F.filter(F.arrays_zip("positions", "tokens"), lambda x: (x.positions >= 0) & (x.positions < F.col(keep)))
    return df.withColumns(
        {
            "teacher_mask": F.slice("teacher_mask", F.lit(1), F.least(F.size("teacher_mask"), F.col(keep))),
            "_in": inside,
            "events": F.filter("events", lambda e: e.response_pos.isNull() | (e.response_pos < F.col(keep))),
        }
    ).withColumns(
        {"positions": F.transform("_in", lambda x: x.positions), "tokens": F.transform("_in", lambda x: x.tokens)}
    ).drop("_in")
