"""Merkle trees over the rows of a dataset, with a proof for every row.

A row's leaf is a digest of chosen columns. Leaves of a group stand in order of their id;
two neighbours at a time become a node of the next level, a last one without neighbour too,
until one node is left, the group's subroot. The subroots, in order of the group, are the
leaves of one more tree, whose last node is the root.

Places in the order come from one range sort: a partition knows its rows' places in itself,
and a small table of rows per partition and group gives the rest. Levels are built twelve
at a time from runs of 4096 neighbours, so a tree of any width is a few rounds of bounded
runs. Proofs come from pointer jumping: a node holds the siblings on the way to an
ancestor; joined with the same table at that ancestor, it holds the siblings on twice the
way. After round k only levels that are multiples of 2^k are looked up again, so the table
shrinks to the leaves and little else. An ancestor of very many leaves is never one join
key: its row is repeated per run of 4096 leaves, and key and run are joined together.

Digests travel as 32 bytes; a proof is their concatenation, from the leaf upwards, first to
the subroot, then to the root. Which levels have a sibling, and on which side it stands,
follows from a node's place and the width of its tree.

Defined cases: a NULL value is hashed as "-"; a NULL group is a group of its own and comes
first; NULL ids come first in their group; rows that repeat an id are in order of their
leaves, and rows equal in all are told apart by their place in the input; an empty table
has no rows. A lone leaf is its own subroot, a lone subroot the root, and a proof without
siblings is empty. Other columns are ignored.
"""

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import StructType

from ..functions import plain
from . import common

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
DIGEST = 32
RUN_LEVELS = 12  # levels of a round; a run has 2^12 neighbours
ROW_BITS = 33  # of Spark's row numbers: the place in the partition


def field(value: Column) -> Column:
    """A value as it enters a leaf: byte count, colon and the value; "-" for NULL."""
    shown = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def in_order(df: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows sorted by group and order, and a table to find their places with.

    The rows get ``_at``, a number that names their partition and their place in it. The
    table has ``_group``, ``_part``, ``_shift`` and ``width``, the rows of the group. Both
    read what one range sort has written, so places stay as they are whatever is computed
    again. The table is as small as the partitions and groups are few.
    """
    names = [f.name for f in df.schema.fields]
    # Rows that are equal in all differ by their place in the input, so a value that very
    # many rows share is spread over partitions as well.
    numbered = df.withColumn("_at", F.monotonically_increasing_id())
    keys = list(dict.fromkeys([group, *order, "_at"]))
    rows = numbered.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*names, F.monotonically_increasing_id().alias("_at"))
    rows = common.checkpointed(rows, "sorted")
    part = F.shiftright("_at", ROW_BITS).alias("_part")
    counts = rows.groupBy(F.col(group).alias("_group"), part).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    inside = W.partitionBy("_group")
    before = F.sum("_rows").over(inside.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    shift = (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift")
    return rows, common.checkpointed(counts.select("_group", "_part", shift, F.sum("_rows").over(inside).alias("width")), "places")


def placed(rows: DataFrame, places: DataFrame, group: str) -> DataFrame:
    """The rows with ``pos``, their place in the group from 0, and what ``places`` adds.

    Joined by group and partition: a group of any size is as many keys as it has partitions.
    """
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.shiftright("_at", ROW_BITS) == F.col("_part"))
    return rows.join(places, same).withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_shift", "_part", "_group")


def _joined(first: bytes, second: bytes = b"") -> bytes:
    """The digest over the hexadecimal forms of one or two digests."""
    return hashlib.sha256((first.hex() + second.hex()).encode("ascii")).digest()


def _levels(run: list[bytes], tree: int, width: int, level: int, start: int, levels: int) -> list[tuple]:
    """Nodes of up to ``levels`` levels over neighbours that begin at place ``start``.

    Rows of tree, width, level, place, sibling, digest. Only a root and a node that the
    next round goes on with have a digest; all others have a sibling or, at the end of a
    level, none.
    """
    out = []
    for _ in range(levels):
        if (width - 1) >> level == 0:
            break
        for i in range(len(run)):
            sibling = run[i ^ 1] if i ^ 1 < len(run) else None
            out.append((tree, width, level, start + i, sibling, None))
        run = [_joined(*run[i : i + 2]) for i in range(0, len(run), 2)]
        level, start = level + 1, start >> 1
    out.append((tree, width, level, start, None, run[0]))
    return out


NODE = "tree long, width long, level int, pos long, sibling binary, digest binary"


def forest(leaves: DataFrame, run_levels: int = RUN_LEVELS) -> tuple[DataFrame, DataFrame]:
    """All nodes of the trees, and one row per tree: tree, width, root.

    ``leaves``: tree, width, pos, digest. Nodes: tree, width, level, pos and the sibling's
    digest, NULL for the last of a level with an odd number of nodes.
    """
    fields = StructType.fromDDL(NODE).fieldNames()
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]

    def build(batches):
        def grown(tables):
            for table in tables:
                tree, width, level, pos = (table.column(c)[0].as_py() for c in ("tree", "width", "level", "pos"))
                yield _levels(table.column("digest").to_pylist(), tree, width, level, pos, run_levels)

        for rows in common.gathered(grown(common.runs(batches, ("tree", "chunk"))), 20_000):
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=fields)

    widest = leaves.agg(F.max("width")).first()[0] or 0
    now = leaves.select("tree", "width", F.lit(0).alias("level"), "pos", "digest")
    built, left = [], widest
    while True:
        chunk = F.shiftright("pos", run_levels)
        dealt = now.withColumn("chunk", chunk).repartition("tree", "chunk").sortWithinPartitions("tree", "chunk", "pos")
        nodes = common.checkpointed(dealt.mapInArrow(build, NODE), "tree-nodes")
        built.append(nodes)
        # Nodes with a digest are roots, or the lowest ones of the next round.
        tops = nodes.where("digest is not null")
        now = tops.where(_height(F.col("width")) > F.col("level")).select("tree", "width", "level", "pos", "digest")
        left = -(-left >> run_levels)
        if left <= 1:
            break
    all_nodes = reduce(DataFrame.unionByName, built)
    roots = all_nodes.where(F.col("digest").isNotNull() & (F.col("level") == _height(F.col("width"))))
    lower = all_nodes.where("digest is null").drop("digest")
    return lower, roots.select("tree", "width", F.col("digest").alias("root"))


def _height(width: Column) -> Column:
    """Levels above the leaves of a tree: the bits of width - 1."""
    return F.when(width > 1, F.length(F.bin(width - 1))).otherwise(F.lit(0)).cast("int")


def climbed(nodes: DataFrame, run_levels: int = RUN_LEVELS) -> DataFrame:
    """tree, pos, proof of each leaf of trees with more than one: pointer jumping.

    In round k every node of a level divisible by 2^k holds the siblings of the 2^k levels
    from its own. It looks up the node it points to, 2^k levels higher, and appends that
    node's siblings to its own. Nodes that reach a root are done and take no further part.
    """
    table = nodes.select(
        "tree", "width", "level", "pos", F.coalesce("sibling", F.lit(b"")).alias("proof"), _height(F.col("width")).alias("height")
    )
    tallest = table.agg(F.max("height")).first()[0] or 0
    done, reach = [], 1
    while reach < tallest:
        points_to = F.col("level") + reach
        finished = table.where(points_to >= F.col("height"))
        done.append(finished.where("level = 0").select("tree", "pos", "proof"))
        # Who goes on climbs; who is pointed to stands on a level divisible by the reach.
        going = table.where((points_to < F.col("height")) & (F.col("level") % (2 * reach) == 0))
        low = min(reach, run_levels)  # so many places of the climbing level share a key
        key = F.shiftright("pos", low)
        going = going.select("tree", "width", "level", "pos", "height", "proof", points_to.alias("_at"), key.alias("_key"))
        stands = table.where((F.col("level") % reach == 0) & (F.col("level") >= reach))
        if reach > low:
            # One row for each run of climbing nodes below, as far as the tree is wide.
            first = F.call_function("shiftleft", F.col("pos"), F.lit(reach - low))
            widest = F.call_function("shiftright", F.col("width") - 1, F.col("level") - reach + low)
            runs = F.sequence(first, F.least(first + F.lit((1 << (reach - low)) - 1), widest))
            key = F.explode(runs)
        else:
            key = F.col("pos")
        stands = stands.select("tree", F.col("level").alias("_at"), key.alias("_key"), F.col("proof").alias("_more"))
        met = going.join(stands, ["tree", "_at", "_key"])
        met = met.select("tree", "width", "level", "pos", F.concat("proof", "_more").alias("proof"), "height")
        # A finished node may still be pointed to.
        kept = finished.where((F.col("level") > 0) & (F.col("level") % (2 * reach) == 0))
        table = common.checkpointed(met.unionByName(kept.select(*met.columns)), "climbed")
        reach *= 2
    done.append(table.where("level = 0").select("tree", "pos", "proof"))
    return reduce(DataFrame.unionByName, done)


def proofs(
    docs: DataFrame,
    columns=COLUMNS,
    id_col: str = "doc_id",
    group_col: str = "lang",
    changed: Column | None = None,
    run_levels: int = RUN_LEVELS,
) -> DataFrame:
    """One row per document: doc_id, leaf, its place in both trees and its proof.

    Columns: doc_id, leaf, changed (the leaf to fold, ``leaf`` unless ``changed`` gives
    another one), pos, width, proof, subroot, group_pos, group_width, group_proof, root.
    Digests and proofs are binary.
    """
    leaf = leaf_digest([plain(c) for c in columns])
    ids = plain(id_col).cast("long").alias("doc_id")
    table = docs.select(ids, plain(group_col).cast("string").alias("grp"), leaf.alias("leaf"), (leaf if changed is None else changed).alias("changed"))
    # Written before the sort, which reads its input twice: the texts are hashed once.
    rows, places = in_order(common.checkpointed(table, "leaves"), "grp", ["doc_id", "leaf"])
    groups = places.select("_group", "width").distinct().select(F.col("_group").alias("grp"), F.col("width").alias("members"), F.lit(0).alias("all"))
    ranked = placed(*in_order(groups, "all", ["grp"]), "all")
    ranked = common.checkpointed(ranked.select("grp", "members", F.col("pos").alias("tree"), F.col("width").alias("group_width")), "groups")
    places = places.join(ranked.drop("members"), F.col("_group").eqNullSafe(F.col("grp"))).drop("grp")
    rows = placed(rows, common.checkpointed(places, "places"), "grp").drop("grp")
    rows = common.checkpointed(rows, "placed-leaves")

    nodes, roots = forest(rows.select("tree", "width", "pos", F.col("leaf").alias("digest")), run_levels)
    tops = roots.select("tree", F.col("root").alias("subroot")).join(ranked.drop("grp"), "tree")
    tops = common.checkpointed(tops, "subroots")
    upper = tops.select(F.lit(0).cast("long").alias("tree"), F.col("group_width").alias("width"), F.col("tree").alias("pos"), F.col("subroot").alias("digest"))
    top_nodes, top_root = forest(upper, run_levels)
    whole = top_root.first()  # one digest
    top_proofs = climbed(top_nodes, run_levels).select(F.col("pos").alias("tree"), F.col("proof").alias("group_proof"))

    # One row per group and run of leaves, so that no group is one key.
    chunks = F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("members") - 1, run_levels))
    tops = tops.join(top_proofs, "tree", "left").select(
        "tree", "subroot", F.coalesce("group_proof", F.lit(b"")).alias("group_proof"), F.explode(chunks).alias("chunk")
    )
    tops = common.checkpointed(tops, "ways-to-the-root")
    own = climbed(nodes, run_levels).withColumnRenamed("tree", "_tree").withColumnRenamed("pos", "_pos")
    out = rows.join(own, (F.col("tree") == F.col("_tree")) & (F.col("pos") == F.col("_pos")), "left").drop("_tree", "_pos")
    out = out.withColumn("chunk", F.shiftright("pos", run_levels)).join(tops, ["tree", "chunk"])
    return out.select(
        "doc_id", "leaf", "changed", "pos", "width", F.coalesce("proof", F.lit(b"")).alias("proof"), "subroot",
        F.col("tree").alias("group_pos"), "group_width", "group_proof",
        F.lit(bytes(whole["root"]) if whole else b"").alias("root"),
    )


def fold(node: bytes, pos: int, width: int, proof: bytes) -> bytes:
    """The root that a leaf and its siblings give."""
    at = 0
    while width > 1:
        if pos & 1:
            node, at = _joined(proof[at : at + DIGEST], node), at + DIGEST
        elif pos + 1 < width:
            node, at = _joined(node, proof[at : at + DIGEST]), at + DIGEST
        else:
            node = _joined(node)
        pos, width = pos >> 1, (width + 1) >> 1
    return node


def verified(proven: DataFrame) -> DataFrame:
    """One row per row of :func:`proofs`, digests in hexadecimal: doc_id, leaf, subroot,
    root, proof_sha256 (over the siblings), folded_root (of ``changed``), verified and
    n_siblings."""
    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, n_siblings int"
    names = StructType.fromDDL(schema).fieldNames()

    def run(batches):
        for batch in batches:
            read = {c: batch.column(c).to_pylist() for c in batch.schema.names if c != "doc_id"}
            folded, shown = [], []
            for i, node in enumerate(read["changed"]):
                node = fold(node, read["pos"][i], read["width"][i], read["proof"][i])
                folded.append(fold(node, read["group_pos"][i], read["group_width"][i], read["group_proof"][i]))
                siblings = read["proof"][i] + read["group_proof"][i]
                shown.append((hashlib.sha256(siblings.hex().encode("ascii")).hexdigest(), len(siblings) // DIGEST))
            hexes = [pa.array([d.hex() for d in read[c]], pa.string()) for c in ("leaf", "subroot", "root")]
            columns = [
                batch.column("doc_id"),
                *hexes,
                pa.array([s[0] for s in shown], pa.string()),
                pa.array([d.hex() for d in folded], pa.string()),
                pa.array([a == b for a, b in zip(folded, read["root"])], pa.bool_()),
                pa.array(np.array([s[1] for s in shown], dtype=np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return proven.mapInArrow(run, schema)


TAMPERED = 7


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    more = {c: plain(c) for c in COLUMNS}
    # Wider than the column, so that the greatest number can be raised as well.
    more["n_chars"] = plain("n_chars").cast("decimal(20,0)") + F.lit(1).cast("decimal(20,0)")
    hit = common.crc_remainder(TAMPERED) == 0
    changed = F.when(hit, leaf_digest(list(more.values()))).otherwise(leaf_digest([plain(c) for c in COLUMNS]))
    return verified(proofs(docs, changed=changed))


# CRC-32 as a table of 256 values and a fold over the bytes of the id; the trees level by
# level; proofs as the neighbours met on the way up.
OP11_SQL = """
WITH RECURSIVE bits(i, c, k) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
rows AS (
  SELECT doc_id, lang, n_chars,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
      lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)]))) % 7 = 0 AS hit
  FROM documents, crc),
leaves AS (
  SELECT *, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) AS raised
  FROM rows),
placed AS (
  SELECT doc_id, coalesce(lang, '') AS lang, lang IS NOT NULL AS named, leaf, CASE WHEN hit THEN raised ELSE leaf END AS changed,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM leaves),
nodes(named, lang, level, pos, n, h) AS (
  SELECT named, lang, 0, pos, n, leaf FROM placed
  UNION ALL
  SELECT named, lang, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY named, lang, level, pos // 2, n),
subroots AS (
  SELECT named, lang, h, level AS height, row_number() OVER (ORDER BY named, encode(lang)) - 1 AS rank, count(*) OVER () AS langs
  FROM nodes WHERE n = 1),
tops(level, pos, n, h) AS (
  SELECT 0, rank, langs, h FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY level, pos // 2, n),
climb(doc_id, named, lang, leaf, upper, level, pos, n, node, seen, subroot) AS (
  SELECT doc_id, p.named, p.lang, leaf, false, 0, p.pos, p.n, changed, '', s.h
  FROM placed p JOIN subroots s ON p.named = s.named AND p.lang = s.lang
  UNION ALL
  SELECT c.doc_id, c.named, c.lang, c.leaf, c.upper OR c.n = 1,
    CASE WHEN c.n = 1 THEN 0 ELSE c.level + 1 END,
    CASE WHEN c.n = 1 THEN s.rank ELSE c.pos // 2 END,
    CASE WHEN c.n = 1 THEN s.langs ELSE (c.n + 1) // 2 END,
    CASE WHEN c.n = 1 THEN c.node
      WHEN c.pos % 2 = 1 THEN sha256(coalesce(t.h, u.h) || c.node) ELSE sha256(c.node || coalesce(t.h, u.h, '')) END,
    c.seen || coalesce(t.h, u.h, ''), c.subroot
  FROM climb c JOIN subroots s ON c.named = s.named AND c.lang = s.lang
  LEFT JOIN nodes t ON NOT c.upper AND c.n > 1 AND t.named = c.named AND t.lang = c.lang AND t.level = c.level AND t.pos = xor(c.pos, 1)
  LEFT JOIN tops u ON c.upper AND c.n > 1 AND u.level = c.level AND u.pos = xor(c.pos, 1)
  WHERE NOT (c.upper AND c.n = 1))
SELECT doc_id, leaf, subroot, r.h AS root, sha256(seen) AS proof_sha256, node AS folded_root, node = r.h AS verified,
  CAST(length(seen) // 64 AS INTEGER) AS n_siblings
FROM climb, (SELECT h FROM tops WHERE n = 1) r WHERE upper AND climb.n = 1
"""
