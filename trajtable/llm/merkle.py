"""Merkle manifest of a table: concatenated-level strings.

The leaves of a group are cut into aligned blocks of 2^height. A block keeps a level of its subtree
as one string of hex digests, each 64 bytes wide: the parents are the hashes of its fixed-width
substrings of 128 bytes, and the siblings of a leaf are the substrings beside its own path, one of
each level. The roots of the blocks are the leaves of the next round, until one node remains.
Sibling segments of the rounds are joined from the top down, on one row for each block. Nothing here
holds more than a block: a group with a third of all rows is only more blocks and rounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trajtable.llm.common import table, written
from trajtable.plans.skew import join_on, ranked

HEX = 64  # bytes of a digest as hex text
HEIGHT = 10  # levels of a block, which holds 2^HEIGHT leaves


def field(value: Column) -> Column:
    """A value as ``<bytes>:<value>``, ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    """Hex sha256 of the fields one after another."""
    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


def _upto(n: Column) -> Column:
    """0 to n - 1, none for n = 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _joined(parts: Column) -> Column:
    return F.array_join(parts, "").cast("binary")


def parents(level: Column) -> Column:
    """The level above: a hash of every two digests, of the last one alone where the number is odd."""
    pairs = F.ceil(F.octet_length(level) / (2 * HEX)).cast("int")
    return _joined(F.transform(_upto(pairs), lambda i: F.sha2(F.substring(level, i * (2 * HEX) + 1, F.lit(2 * HEX)), 256)))


def _bit(place: Column, level: Column) -> Column:
    return F.call_function("shiftright", place, level)


def siblings(levels: Column, place: Column, height: Column) -> Column:
    """The digest beside the path of a place on each level, empty where the run has no other node."""
    beside = lambda k: _bit(place, k).bitwiseXOR(F.lit(1))
    return F.transform(
        _upto(height), lambda k: F.substring(F.element_at(levels, k + 1), beside(k) * HEX + 1, F.lit(HEX)).cast("string")
    )


def fold(leaf: Column, path: Column, place: Column) -> Column:
    """The root that a leaf gives with the siblings of its path; ``place`` tells the side on each level."""
    def up(node: Column, k: Column) -> Column:
        beside = F.element_at(path, k + 1)
        right = _bit(place, k).bitwiseAND(F.lit(1)) == 1
        return F.sha2(F.when(right, F.concat(beside, node)).otherwise(F.concat(node, beside)).cast("binary"), 256)

    return F.aggregate(_upto(F.size(path)), leaf, up)


def _blocks(nodes: DataFrame, keys: Sequence[str], height: int, *payload: str) -> DataFrame:
    """One row per aligned block: its rows, its levels as strings, and its root. Written once."""
    gathered = nodes.groupBy(*keys, F.call_function("shiftright", "place", F.lit(height)).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("place", "node", *payload))).alias("rows"), F.max("depth").alias("depth")
    )
    up = F.least(F.col("depth"), F.lit(height)).alias("up")
    first = _joined(F.transform("rows", lambda r: r["node"])).alias("first")
    levels = F.aggregate(_upto(F.col("up")), F.array("first"), lambda all_, _: F.array_append(all_, parents(F.element_at(all_, -1))))
    rows = gathered.select(*keys, "block", "rows", "depth", up, first).withColumn("levels", levels).drop("first")
    return written(rows.withColumn("root", F.element_at("levels", -1).cast("string")))


def tree(leaves: DataFrame, keys: Sequence[str], order: Sequence[Column], payload: Sequence[str] = (), height: int = HEIGHT) -> DataFrame:
    """One row per leaf: keys, payload, ``node``, ``place`` in its group, ``path`` (siblings, lowest first) and ``root``.

    ``leaves`` holds the keys (null is a key like any other), ``node`` (hex digest) and the payload;
    ``order`` must be total but for equal rows. A group of one leaf has that leaf as root and an
    empty path; an empty table gives an empty result.
    """
    keys, payload = list(keys), list(payload)
    rows = ranked(leaves, keys, order, out="_rank").withColumn("place", F.col("_rank") - 1)
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # levels above n leaves: the binary digits of n - 1
    depth = F.when(F.col("_n") > 1, F.length(F.bin(F.col("_n") - 1))).otherwise(0)
    depths = written(counts.select(*keys, depth.alias("depth")))
    nodes = join_on(rows.select(*keys, "place", "node", *payload), depths, keys)
    left = depths.agg(F.max("depth")).first()[0] or 0
    rounds = [_blocks(nodes, keys, height, *payload)]
    while (left := left - height) > 0:
        below = rounds[-1]
        rest = F.greatest(F.col("depth") - height, F.lit(0)).alias("depth")
        rounds.append(_blocks(below.select(*keys, F.col("block").alias("place"), F.col("root").alias("node"), rest), keys, height))
    # the top round has one block in each group; its root is the group's
    above = rounds[-1].select(*keys, "block", F.array().cast("array<string>").alias("path"), F.col("root").alias("top"))
    for below in reversed(rounds[1:]):
        here = join_on(below.drop("root"), above, [*keys, "block"])
        inside = F.transform(
            "rows", lambda r: F.struct(r["place"].alias("block"), F.concat(siblings(F.col("levels"), _local(r["place"], height), F.col("up")), F.col("path")).alias("path"))
        )
        above = here.select(*keys, "top", F.inline(inside)).select(*keys, "block", "path", "top")
    here = join_on(rounds[0].drop("root"), above, [*keys, "block"])
    inside = F.transform(
        "rows",
        lambda r: F.struct(
            r["place"].alias("place"), r["node"].alias("node"), *[r[c].alias(c) for c in payload],
            F.concat(siblings(F.col("levels"), _local(r["place"], height), F.col("up")), F.col("path")).alias("path"),
        ),
    )
    return here.select(*keys, F.col("top").alias("root"), F.inline(inside))


def _local(place: Column, height: int) -> Column:
    """Place inside the block."""
    return place.bitwiseAND(F.lit((1 << height) - 1))


def manifest(
    docs: DataFrame, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), group: str = "lang",
    order: str = "doc_id", tampered: dict[str, Column] | None = None, height: int = HEIGHT,
) -> DataFrame:
    """One row per row of ``docs``: its ``order`` value, leaf, subroot, root and proof, and the root recomputed.

    A leaf hashes the ``columns``. Leaves of a group ascend by ``order`` (null first, ties by leaf, so
    repeated rows are leaves of their own and any order of them gives the same tree); the subroots
    ascend by group, null first. ``path`` holds the siblings from the leaf to the root with empty
    strings where a run has no other node, ``proof_sha256`` hashes them. ``tampered`` gives changed
    values of columns; ``folded_root`` goes up from the leaf of the changed row with the siblings of
    the original, ``verified`` tells whether that is the root. An empty table gives no rows; other
    columns are not read, whatever their names.
    """
    changed = [F.col(c) if c not in (tampered or {}) else tampered[c] for c in columns]
    plain = leaf_hash(*map(F.col, columns))
    differs = F.lit(False)
    for c in tampered or {}:
        differs = differs | ~F.col(c).eqNullSafe(tampered[c])
    leaves = written(docs.select(F.col(group).alias("grp"), F.col(order).alias("id"), plain.alias("node"), F.when(differs, leaf_hash(*changed)).alias("other")))
    rows = tree(leaves, ["grp"], [F.col("id"), F.col("node")], ["id", "other"], height)
    rows = rows.withColumnsRenamed({"root": "subroot"})
    tops = written(leaves.select("grp").distinct())
    subroots = written(rows.where(F.col("place") == 0).select("grp", F.col("subroot").alias("node")))
    top = tree(join_on(tops, subroots, ["grp"]).select(F.lit(0).alias("all"), "grp", "node"), ["all"], [F.col("grp")], ["grp"], height)
    top = top.select("grp", "root", F.col("place").alias("top_place"), F.col("path").alias("top_path"))
    joined = join_on(rows, top, ["grp"])
    leaf = F.coalesce("other", "node")
    folded = fold(fold(leaf, F.col("path"), F.col("place")), F.col("top_path"), F.col("top_place"))
    whole = F.concat("path", "top_path")
    return joined.select(
        F.col("id").alias(order), F.col("node").alias("leaf"), "subroot", "root", whole.alias("path"),
        F.sha2(_joined(whole), 256).alias("proof_sha256"), folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of ``documents``; where 7 divides the crc32 of the id, one more character is claimed."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    tampered = {"n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    return manifest(table(spark, sf_dir, "documents"), tampered=tampered).drop("path")


def _duck_field(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


_FIELDS = " || ".join(map(_duck_field, ("doc_id", "source", "lang", "n_chars", "text")))
_TAMPERED = _FIELDS.replace("n_chars", "(n_chars + 1)")
_FOLD = "list_reduce([{start}] || {path}, lambda node, s: sha256(CASE s[1] WHEN 'L' THEN s[2:] || node ELSE node || s[2:] END))"
# crc32 bit by bit: the reflected polynomial 0xEDB88320
_CRC = """xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), lambda crc, b:
  list_reduce([xor(crc, b)] || range(8), lambda x, _: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""
_PARENTS = "list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')))"
_BESIDE = "CASE (place >> level) & 1 WHEN 1 THEN 'L' ELSE 'R' END || coalesce(nodes[xor(place >> level, 1) + 1], '')"
OP13_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, leaf, CASE WHEN {_CRC} % 7 = 0 AND n_chars IS NOT NULL THEN other ELSE leaf END AS claimed,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
  FROM (SELECT *, sha256({_FIELDS}) AS leaf, sha256({_TAMPERED}) AS other FROM documents)),
levels AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY place) AS nodes FROM leaves GROUP BY lang
  UNION ALL SELECT lang, level + 1, {_PARENTS} FROM levels WHERE len(nodes) > 1),
subroots AS (
  SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM levels WHERE len(nodes) = 1),
upper AS (
  SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM subroots HAVING count(*) > 0
  UNION ALL SELECT level + 1, {_PARENTS} FROM upper WHERE len(nodes) > 1),
top AS (
  SELECT lang, subroot, (SELECT nodes[1] FROM upper WHERE len(nodes) = 1) AS root,
         (SELECT coalesce(list({_BESIDE} ORDER BY level), []) FROM upper WHERE len(nodes) > 1) AS path FROM subroots),
proofs AS (
  SELECT v.doc_id, v.place, v.lang, v.leaf, v.claimed, coalesce(list({_BESIDE} ORDER BY level) FILTER (len(nodes) > 1), []) AS path
  FROM leaves v JOIN levels l ON v.lang IS NOT DISTINCT FROM l.lang GROUP BY ALL),
found AS (
  SELECT p.doc_id, p.leaf, t.subroot, t.root, p.claimed, p.path || t.path AS path
  FROM proofs p JOIN top t ON p.lang IS NOT DISTINCT FROM t.lang),
folded AS (
  SELECT *, sha256(array_to_string(list_transform(path, lambda s: s[2:]), '')) AS proof_sha256, {_FOLD.format(start="claimed", path="path")} AS folded_root FROM found)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""
