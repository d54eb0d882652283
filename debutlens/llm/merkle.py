"""Merkle manifest of a table by cogrouped subtree exchange.

Rows become leaves, numbered within their group; runs of 4096 leaves are superblocks. Going up, every superblock is
reduced to its root, and the roots are leaves of the next tree, until each group has one. Going down, the nodes that
a superblock needs from outside (the siblings of its root, up to the root of all) meet its leaves: both are cogrouped
by superblock, where one function finishes the local tree, joins the proofs and folds the leaves shown to the root.
"""

from __future__ import annotations

from functools import partial
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_side, stored

#: A superblock has 2**BLOCK_BITS nodes.
BLOCK_BITS = 12


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf_digest(fields: dict[str, Column]) -> Column:
    """Lowercase hex: each field `-` if null, else its UTF-8 byte count, `:` and its value."""

    def said(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[said(c) for c in fields.values()]).cast("binary"), 256)


def numbered(nodes: DataFrame, *order: str) -> DataFrame:
    """`nodes`, a stored table, with at (place within grp by `order`, from 0) and total (nodes of grp), stored.

    Places are cut by range, so that a group that holds most rows is dealt over many tasks; they are written down once
    and never computed anew.
    """
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = nodes.repartitionByRange(parts, "grp", *order).sortWithinPartitions("grp", *order)
    placed = stored(sorted_rows.withColumn("place", F.monotonically_increasing_id()), "ordered").withColumn("part", F.shiftright("place", 33))
    runs = placed.groupBy("grp", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    of_group = Window.partitionBy("grp")  # one row per group and range, not per node
    before = of_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select("grp", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(of_group).alias("total"))
    return placed.join(small_side(stored(starts, "starts")), ["grp", "part"]).withColumn("at", F.col("place") + F.col("shift")).drop("place", "part", "shift")


def reduced(nodes: list[str], total: int, bits: int) -> list[list[str]]:
    """The levels of a superblock's tree, nodes first; as many as its group's tree still has, at most `bits` more."""
    levels = [nodes]
    for _ in range(min(bits, (total - 1).bit_length())):
        below = levels[-1]
        levels.append([digest("".join(below[i : i + 2])) for i in range(0, len(below), 2)])
    return levels


def siblings(levels: list[list[str]], at: int) -> list[str]:
    """The node beside that of leaf `at` on each level: `L` or `R` and its digest, `-` where there is none."""
    out = []
    for level in levels[:-1]:
        beside = at ^ 1
        out.append("-" if beside >= len(level) else ("L" if beside < at else "R") + level[beside])
        at >>= 1
    return out


def folded(leaf: str, path: list[str]) -> str:
    for step in path:
        leaf = digest(step[1:] + leaf if step[0] == "L" else leaf + step[1:])
    return leaf


def root_of_block(bits: int, group: pd.DataFrame) -> pd.DataFrame:
    nodes, total = group.sort_values("at")["node"].tolist(), int(group["total"].iloc[0])
    return pd.DataFrame({"grp": group["grp"].iloc[:1], "at": group["block"].iloc[:1], "node": reduced(nodes, total, bits)[-1], "total": -(-total >> bits)})


def climb(nodes: DataFrame, bits: int) -> list[DataFrame]:
    """Tables of grp, at, node, total: the given nodes, then the roots of superblocks of the one before, until each
    group has one node. Their number grows with the logarithm of the rows (base 2**bits)."""
    levels = [nodes.select("grp", "at", "node", "total")]
    most = nodes.agg(F.max("total")).first()[0] or 0
    while most > 1:
        blocks = levels[-1].withColumn("block", F.shiftright("at", bits)).groupBy("grp", "block")
        levels.append(stored(blocks.applyInPandas(partial(root_of_block, bits), "grp string, at long, node string, total long"), "roots"))
        most = -(-most >> bits)
    return levels


def path_of_nodes(bits: int, nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    nodes = nodes.sort_values("at")
    levels, above = reduced(nodes["node"].tolist(), int(nodes["total"].iloc[0]), bits), list(outer["path"].iloc[0])
    paths = [siblings(levels, i) + above for i in range(len(nodes))]
    return pd.DataFrame({"grp": nodes["grp"], "at": nodes["at"], "path": paths, "subroot": outer["subroot"].iloc[0], "root": outer["root"].iloc[0]})


def prove(bits: int, proofs: bool, leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """One superblock: its local tree, every leaf's proof up to the root of all, and what the leaf shown folds to."""
    leaves = leaves.sort_values("at")
    levels, above = reduced(leaves["node"].tolist(), int(leaves["total"].iloc[0]), bits), list(outer["path"].iloc[0])
    paths = [siblings(levels, i) + above for i in range(len(leaves))]
    out = leaves[["row", "node", "at"]].rename(columns={"node": "leaf"})
    out["subroot"], out["root"] = outer["subroot"].iloc[0], outer["root"].iloc[0]
    if proofs:
        out["proof"] = paths
    out["proof_sha256"] = [digest("".join(step[1:] for step in path)) for path in paths]
    out["folded_root"] = [folded(shown, path) for shown, path in zip(leaves["shown"], paths)]
    return out


def descend(levels: list[DataFrame], outer: DataFrame, bits: int) -> DataFrame:
    """Hands paths down from the top nodes to the first level's superblocks: grp, at, path, subroot, root."""
    for nodes in levels[:0:-1]:
        blocks = nodes.withColumn("block", F.shiftright("at", bits)).groupBy("grp", "block")
        handed = blocks.cogroup(outer.withColumn("block", F.col("at")).groupBy("grp", "block"))
        outer = stored(handed.applyInPandas(partial(path_of_nodes, bits), "grp string, at long, path array<string>, subroot string, root string"), "paths")
    return outer


def build_manifest(docs: DataFrame, *, fields: tuple = ("doc_id", "source", "lang", "n_chars", "text"), id_col: str = "doc_id", group_col: str = "lang", shown: dict[str, Column] | None = None, proofs: bool = True, bits: int = BLOCK_BITS) -> DataFrame:
    """Per input row: id, grp (null: null), at (place in its group), leaf, subroot, root, proof (siblings from the leaf
    to the root, `L` or `R` and digest, `-` for none; left out without `proofs`), proof_sha256, folded_root, verified.

    Leaves are digests of `fields`; `shown` replaces some of them by other expressions in what is folded, to see
    whether the proof tells. Leaves ascend by id within their group, null first, equal ids by digest; repeated rows
    are leaves each and interchangeable, so that no task has to hold them together. Null groups are one group, the
    first; a lone row is its group's root, a lone group's root the root of all. Null and empty fields differ. Texts
    are hashed where they are read and never shuffled. Only the columns named are read, so that others may have any
    name. Ids keep their type. An empty table gives no rows.
    """
    own = {c: F.col(c) for c in fields}
    # A null group sorts before all others, as the empty string before those that start with `=`.
    grp = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    leaf = leaf_digest(own)
    changed = [~a.eqNullSafe(own[c]) for c, a in (shown or {}).items()]
    seen = leaf
    for differs in changed:
        seen = F.when(differs, leaf_digest(own | shown)).otherwise(seen)
    rows = docs.select(F.col(id_col).alias("id"), grp.alias("grp"), leaf.alias("node"), seen.alias("shown"), F.monotonically_increasing_id().alias("salt"))
    leaves = stored(numbered(stored(rows, "leaves"), "id", "node", "salt").drop("salt"), "numbered-leaves")
    levels = climb(leaves, bits)
    tops = levels[-1].select(F.lit("").alias("grp"), F.col("grp").alias("id"), "node")
    groups = stored(numbered(stored(tops, "subroots"), "id"), "numbered-subroots")
    over = climb(groups, bits)
    root = over[-1].select("grp", "at", F.array().cast("array<string>").alias("path"), F.lit("").alias("subroot"), F.col("node").alias("root"))
    # The groups' tree is one more tree: its leaves' paths are what the groups' own top nodes need from outside.
    blocks = groups.withColumn("block", F.shiftright("at", bits)).groupBy("grp", "block")
    met = blocks.cogroup(descend(over, root, bits).withColumn("block", F.col("at")).groupBy("grp", "block")) if len(over) > 1 else None
    by_place = (met.applyInPandas(partial(path_of_nodes, bits), "grp string, at long, path array<string>, subroot string, root string") if met else root).drop("subroot")
    named = by_place.join(groups.select("at", F.col("id").alias("name"), F.col("node").alias("subroot")), "at")
    outer = stored(named.select(F.col("name").alias("grp"), F.lit(0).cast("long").alias("at"), "path", "subroot", "root"), "outer")
    outer = descend(levels, outer, bits)
    id_type = leaves.schema["id"].dataType.simpleString()
    held = leaves.select(F.struct("id", "grp").alias("row"), "grp", "at", "node", "shown", "total", F.shiftright("at", bits).alias("block"))
    made = held.groupBy("grp", "block").cogroup(outer.withColumn("block", F.col("at")).groupBy("grp", "block"))
    kept = "proof array<string>, " if proofs else ""
    of_row = f"row struct<id: {id_type}, grp: string>, leaf string, at long, subroot string, root string, {kept}proof_sha256 string, folded_root string"
    proved = made.applyInPandas(partial(prove, bits, proofs), of_row)
    name = F.when(F.col("row.grp") != "", F.substring("row.grp", 2, 1 << 30))
    rest = ["at", "leaf", "subroot", "root", *(["proof"] if proofs else []), "proof_sha256", "folded_root"]
    return proved.select(F.col("row.id").alias("id"), name.alias("grp"), *rest, (F.col("folded_root") == F.col("root")).alias("verified"))


def manifest_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    shown = {"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    out = build_manifest(docs, shown=shown, proofs=False)
    return out.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


MANIFEST_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, n_chars,
    coalesce(strlen(doc_id::VARCHAR)::VARCHAR || ':' || doc_id, '-') || coalesce(strlen(source)::VARCHAR || ':' || source, '-')
      || coalesce(strlen(lang)::VARCHAR || ':' || lang, '-') AS before,
    coalesce(strlen(text)::VARCHAR || ':' || text, '-') AS after,
    -- crc32 of the decimal id: per character one step that mixes it in, then eight that shift
    xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295) % 7 = 0 AS tampered
  FROM documents),
leaf AS (
  SELECT doc_id, lang, sha256(before || coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars, '-') || after) AS leaf,
    sha256(before || coalesce(strlen((n_chars + tampered::INT)::VARCHAR)::VARCHAR || ':' || (n_chars + tampered::INT), '-') || after) AS shown
  FROM d),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaf),
tree AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM ranked GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')))
  FROM tree WHERE len(nodes) > 1),
subroot AS (SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM tree WHERE len(nodes) = 1),
top AS (
  SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM subroot
  UNION ALL
  SELECT level + 1, list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], ''))) FROM top WHERE len(nodes) > 1),
side AS (
  SELECT r.lang, r.pos, t.level, 0 AS tier, (r.pos >> t.level) AS j, t.nodes
  FROM ranked r JOIN tree t ON r.lang IS NOT DISTINCT FROM t.lang WHERE len(t.nodes) > 1
  UNION ALL
  SELECT r.lang, r.pos, t.level, 1, (s.place >> t.level), t.nodes
  FROM ranked r JOIN subroot s ON r.lang IS NOT DISTINCT FROM s.lang, top t WHERE len(t.nodes) > 1),
step AS (
  SELECT lang, pos, tier, level, CASE WHEN xor(j, 1) >= len(nodes) THEN '-' WHEN j % 2 = 1 THEN 'L' || nodes[j] ELSE 'R' || nodes[j + 2] END AS s FROM side),
path AS (SELECT lang, pos, list(s ORDER BY tier, level) AS path FROM step GROUP BY lang, pos),
proved AS (
  SELECT r.doc_id, r.leaf, s.subroot, (SELECT nodes[1] FROM top WHERE len(nodes) = 1) AS root,
    sha256(array_to_string(list_transform(coalesce(p.path, []), lambda x: x[2:]), '')) AS proof_sha256,
    list_reduce([r.shown] || coalesce(p.path, []), lambda a, x: sha256(CASE WHEN x[1] = 'L' THEN x[2:] || a ELSE a || x[2:] END)) AS folded_root
  FROM ranked r JOIN subroot s ON r.lang IS NOT DISTINCT FROM s.lang LEFT JOIN path p ON r.lang IS NOT DISTINCT FROM p.lang AND r.pos = p.pos)
SELECT *, folded_root = root AS verified FROM proved
"""
