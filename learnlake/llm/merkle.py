"""Merkle manifest of a table: one tree per source, one over the sources' roots, and a proof for every row.

Nodes are numbered within their tree, so the siblings of a node are known by number: for a fan-out of 2 the number with
its last bit flipped (XOR), otherwise the run's other slots, reached by adding 1, 2, ... to the own slot modulo the
fan-out. Every level joins nodes with the computed sibling numbers by equality; the rows in slot zero, which then hold
their whole run, emit the parents. A level is a table of the shared folder, a ``FANOUT``-th of the one below.

Keys are (tree, number), so a source with a third of all rows is spread like any other. Proofs are handed down from the
root: each level's table is joined with the paths of its parents, and only the leaves' own join has as many rows as the
input.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnlake.llm.common import fresh, written

FANOUT = 16
# The columns of a document in the order a leaf takes them.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before:string,after:string>>"


def leaf_digest(columns: list[Column]) -> Column:
    """SHA-256 (lowercase hex) of the values: ``-`` for null, else length in UTF-8 bytes, a colon, and the value."""
    texts = [c.cast("string") for c in columns]
    fields = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*fields), 256)


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def numbered(rows: DataFrame, group: str, order: list[str], number: str, tree: str) -> DataFrame:
    """``rows`` with their place from 0 in their group, and the group's place among all groups.

    Groups are ordered null first and by bytes, as Spark orders strings; rows within one by ``order`` (null first), equal
    ones anyhow. Rows are sorted by ranges of all these columns and a running number, so neither a large group nor
    many equal rows meet in one task; places follow from row counts per range.
    """
    tie, at, part, first, many, shift = fresh(rows, "tie", "at", "part", "first", "many", "shift")
    keys = [F.col(group), *map(F.col, order)]
    ranged = rows.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*keys, tie)
    ranged = ranged.sortWithinPartitions(*keys, tie).drop(tie).withColumn(at, F.monotonically_increasing_id())
    table = written(ranged, "merkle-order")
    # The upper bits of the running number are the partition.
    dealt = table.withColumn(part, F.shiftright(at, 33))
    bounds = dealt.groupBy(part, group).agg(F.min(at).alias(first), F.count("*").alias(many))
    earlier = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bounds = bounds.withColumn(shift, F.coalesce(F.sum(many).over(earlier), F.lit(0)) - F.col(first))
    names = bounds.groupBy(group).agg(F.min(part).alias(part), F.min(first).alias(first))
    # A group begins in one range only, so groups are counted like rows: inside a range, then over the ranges.
    inside = Window.partitionBy(part).orderBy(first)
    names = names.withColumn("inside_", F.row_number().over(inside) - 1)
    ranges = names.groupBy(part).agg(F.count("*").alias("n_"))
    # One row per range: their number is that of the tasks, not of the sources.
    ranges = ranges.withColumn("before_", F.coalesce(
        F.sum("n_").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    trees = names.join(ranges, part).select(F.col(group).alias("group_"), (F.col("before_") + F.col("inside_")).alias(tree))
    bounds = bounds.join(trees, F.col(group).eqNullSafe(F.col("group_"))).select(
        F.col(part).alias("part_"), "group_", tree, shift)
    placed = dealt.join(bounds, (F.col(part) == F.col("part_")) & F.col(group).eqNullSafe(F.col("group_")))
    return placed.withColumn(number, F.col(at) + F.col(shift)).drop(at, part, shift, "part_", "group_")


def with_siblings(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``nodes`` (tree, number, digest, ...) with ``siblings``: (slot, digest) of the other nodes of the run."""
    slot = F.pmod("number", F.lit(fanout))
    if fanout == 2:
        sibling = F.col("number").bitwiseXOR(F.lit(1))
        sent = nodes.select("tree", sibling.alias("number"), slot.cast("byte").alias("slot"), "digest")
    else:
        offset = F.explode(F.sequence(F.lit(1), F.lit(fanout - 1))).alias("offset")
        sibling = F.col("number") - F.col("slot") + F.pmod(F.col("slot") + F.col("offset"), F.lit(fanout))
        sent = nodes.select("tree", "number", slot.cast("byte").alias("slot"), "digest", offset).select(
            "tree", sibling.alias("number"), "slot", "digest")
    # At most fanout - 1 rows meet per number; numbers beyond the last node find no partner.
    others = sent.groupBy("tree", "number").agg(F.sort_array(F.collect_list(F.struct("slot", "digest"))).alias("siblings"))
    none = F.array().cast("array<struct<slot:tinyint,digest:binary>>")
    return nodes.join(others, ["tree", "number"], "left").withColumn("siblings", F.coalesce("siblings", none))


def _joined(fanout: int, keep) -> Column:
    slot = F.pmod("number", F.lit(fanout))
    return F.array_join(F.transform(F.filter("siblings", lambda s: keep(s["slot"], slot)), lambda s: _hex(s["digest"])), "")


def _step(fanout: int) -> Column:
    """What a proof holds for one level: the digests left and right of the node, as text."""
    before, after = _joined(fanout, lambda a, b: a < b), _joined(fanout, lambda a, b: a > b)
    return F.struct(before.alias("before"), after.alias("after"))


def levels(nodes: DataFrame, fanout: int = FANOUT) -> tuple[list[DataFrame], DataFrame]:
    """The levels of all trees, leaves first, each with siblings, and (tree, digest) of the roots.

    ``nodes`` has tree, number and digest (binary). A tree with one node is its own root.
    """
    lone = (F.col("number") == 0) & (F.size("siblings") == 0)
    found, roots = [], []
    while True:
        level = written(with_siblings(nodes, fanout), "merkle-level")
        found.append(level)
        roots.append(level.where(lone).select("tree", "digest"))
        zero = level.where(~lone & (F.pmod("number", F.lit(fanout)) == 0))
        whole = F.concat(_hex(F.col("digest")), _joined(fanout, lambda a, b: a > b))
        if zero.isEmpty():
            break
        # In two steps: in one, the new ``number`` would be taken for the old one inside the filter's function.
        parents = zero.select("tree", "number", F.unhex(F.sha2(whole, 256)).alias("digest"))
        nodes = parents.withColumn("number", F.expr(f"number div {fanout}"))
    out = roots[0]
    for r in roots[1:]:
        out = out.unionByName(r)
    return found, written(out, "merkle-roots")


def _paths(found: list[DataFrame], above: DataFrame, fanout: int) -> DataFrame:
    """The lowest level's rows with the columns of ``above`` (tree, path, ...) and ``path`` led down to them."""
    lone = (F.col("number") == 0) & (F.size("siblings") == 0)
    carried = [c for c in above.columns if c not in ("tree", "path")]
    below = None
    for level in reversed(found):
        own = [c for c in level.columns if c != "siblings"]
        top = level.where(lone).select(*own).join(above, "tree")
        if below is None:
            rows = top
        else:
            parents = below.select("tree", F.col("number").alias("parent"), "path", *carried)
            inner = level.where(~lone).select(*own, _step(fanout).alias("step"), F.expr(f"number div {fanout}").alias("parent"))
            inner = inner.join(parents, ["tree", "parent"])
            rows = top.unionByName(inner.withColumn("path", F.concat(F.array("step"), "path")).select(*top.columns))
        below = rows if level is found[0] else written(rows.select("tree", "number", "path", *carried), "merkle-paths")
    return below


def proofs(rows: DataFrame, group: str, order: list[str], digest: str, fanout: int = FANOUT) -> DataFrame:
    """``rows`` with ``subroot``, ``root`` (hex) and ``path``: the proof's digests level by level up to the root.

    ``digest`` names the column with a row's own digest in hex. Rows are ordered in their group by ``order`` and the
    digest, so rows that differ have one place. Null groups are a group; an empty table gives no rows.
    """
    renamed = {c: f"in_{i}" for i, c in enumerate(rows.columns)}
    source = rows.select(*[F.col(f"`{c}`").alias(n) for c, n in renamed.items() if c != digest],
                         F.unhex(F.col(f"`{digest}`")).alias("digest"))
    leaves = numbered(source, renamed[group], [*[renamed[c] for c in order], "digest"], "number", "tree")
    found, subroots = levels(leaves, fanout)
    over = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("number"), "digest")
    upper, root = levels(over, fanout)
    top = root.select("tree", F.array().cast(PATH).alias("path"), _hex(F.col("digest")).alias("root"))
    above = _paths(upper, top, fanout).select(
        F.col("number").alias("tree"), "path", "root", _hex(F.col("digest")).alias("subroot"))
    out = _paths(found, written(above, "merkle-paths"), fanout)
    named = [_hex(F.col("digest")).alias(c) if c == digest else F.col(n).alias(c) for c, n in renamed.items()]
    return out.select(*named, "subroot", "root", "path")


def fold(digest: Column, path: Column) -> Column:
    """The root that ``digest`` (hex) and the siblings of ``path`` lead to."""
    return F.aggregate(path, digest, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def tampered(docs: DataFrame) -> DataFrame:
    """Documents whose id's CRC-32 is divisible by 5 with ``text`` in lower case (A-Z), null ids and texts as they are."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    return docs.withColumn("text", F.when(hit, lower).otherwise(F.col("text")))


def manifest_of_documents(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    ``folded_root`` starts from the leaf of the tampered document and the untampered siblings. Null values, sources
    and ids have their own form (``-``); repeated rows are leaves each. An empty table gives no rows.
    """
    wanted = docs.select(*LEAF_COLUMNS)
    after = tampered(wanted.withColumn("leaf", leaf_digest([F.col(c) for c in LEAF_COLUMNS])))
    rows = after.select("doc_id", "source", "leaf", F.unhex(leaf_digest([F.col(c) for c in LEAF_COLUMNS])).alias("now"))
    proven = proofs(rows, "source", ["doc_id"], "leaf").withColumn("folded_root", fold(_hex(F.col("now")), F.col("path")))
    return proven.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


def _leaf_sql(text: str) -> str:
    fields = [c if c != "text" else text for c in LEAF_COLUMNS]
    parts = [f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields]
    return f"sha256({' || '.join(parts)})"


# CRC-32 byte by byte and bit by bit with the reflected polynomial; 16 digests are hashed per node as in ``proofs``.
SQL = f"""
WITH RECURSIVE crc AS (
  SELECT DISTINCT doc_id, xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], [ord(c)::BIGINT for c in regexp_extract_all(CAST(doc_id AS VARCHAR), '.')]),
    lambda crc, byte: list_reduce(
      list_concat([xor(crc, byte)], range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)
  )) AS crc FROM documents WHERE doc_id IS NOT NULL),
leaves AS (
  SELECT documents.doc_id, source, {_leaf_sql('text')} AS leaf, CASE WHEN crc % 5 = 0
    THEN {_leaf_sql("translate(text, '" + string.ascii_uppercase + "', '" + string.ascii_lowercase + "')")}
    ELSE {_leaf_sql('text')} END AS now
  FROM documents LEFT JOIN crc USING (doc_id)),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS number,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM leaves),
lower_nodes AS (
  SELECT 0 AS height, tree, number, leaf AS digest FROM numbered
  UNION ALL
  SELECT CAST(height + 1 AS INTEGER), tree, number // {FANOUT}, sha256(string_agg(digest, '' ORDER BY number))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM lower_nodes) WHERE n > 1
  GROUP BY height, tree, number // {FANOUT}),
subroots AS (
  SELECT tree, digest, height FROM lower_nodes
  QUALIFY height = max(height) OVER (PARTITION BY tree)),
upper_nodes AS (
  SELECT 0 AS height, tree AS number, digest FROM subroots
  UNION ALL
  SELECT CAST(height + 1 AS INTEGER), number // {FANOUT}, sha256(string_agg(digest, '' ORDER BY number))
  FROM (SELECT *, count(*) OVER () AS n FROM upper_nodes) WHERE n > 1
  GROUP BY height, number // {FANOUT}),
top AS (SELECT digest AS root, height FROM upper_nodes QUALIFY height = max(height) OVER ()),
steps AS (
  SELECT false AS upper, a.height, a.tree, a.number,
    coalesce(string_agg(b.digest, '' ORDER BY b.number) FILTER (b.number < a.number), '') AS before,
    coalesce(string_agg(b.digest, '' ORDER BY b.number) FILTER (b.number > a.number), '') AS after
  FROM lower_nodes a JOIN lower_nodes b ON a.height = b.height AND a.tree = b.tree AND a.number // {FANOUT} = b.number // {FANOUT}
  WHERE a.height < (SELECT s.height FROM subroots s WHERE s.tree = a.tree)
  GROUP BY a.height, a.tree, a.number
  UNION ALL
  SELECT true, a.height, 0, a.number,
    coalesce(string_agg(b.digest, '' ORDER BY b.number) FILTER (b.number < a.number), ''),
    coalesce(string_agg(b.digest, '' ORDER BY b.number) FILTER (b.number > a.number), '')
  FROM upper_nodes a JOIN upper_nodes b ON a.height = b.height AND a.number // {FANOUT} = b.number // {FANOUT}
  WHERE a.height < (SELECT height FROM top) GROUP BY a.height, a.number),
climb AS (
  SELECT row_number() OVER () AS id, n.doc_id, n.leaf, n.tree, n.number, s.digest AS subroot, 0 AS height, false AS upper,
    s.height AS lower_height, now AS folded, '' AS proof
  FROM numbered n JOIN subroots s USING (tree)
  UNION ALL
  SELECT id, doc_id, leaf, CASE WHEN in_upper THEN 0 ELSE c.tree END, place // {FANOUT}, subroot, CAST(h + 1 AS INTEGER), in_upper, lower_height,
    sha256(before || folded || after), proof || before || after
  FROM (SELECT *, upper OR height = lower_height AS in_upper,
          CASE WHEN NOT upper AND height = lower_height THEN 0 ELSE height END AS h,
          CASE WHEN NOT upper AND height = lower_height THEN tree ELSE number END AS place FROM climb) c
  JOIN steps ON steps.upper = in_upper AND steps.height = h AND steps.number = place
    AND steps.tree = CASE WHEN in_upper THEN 0 ELSE c.tree END)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM (SELECT * FROM climb QUALIFY row_number() OVER (PARTITION BY id ORDER BY upper DESC, height DESC) = 1), top
"""
