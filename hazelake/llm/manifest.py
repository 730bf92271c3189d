"""A Merkle manifest of a dataset, written as postorder logs by aligned builders.

Rows are leaves. Per group (a language) they ascend by id, and every two consecutive nodes of a level become one node of
the next; a last node without a neighbour is hashed alone. The tops of the groups, in order, are the leaves of one more
such tree.

A tree is cut into blocks of 2**``BLOCK_LEVELS`` leaves, aligned so that the part of the tree above a block's leaves is a
tree of its own. A builder appends the nodes of its block to a log in the order in which they are complete: leaves as
they come, each inner node right behind its last child. The tops of all blocks are the leaves of the next layer, whose
builders do the same, until one node is left. No builder sees more than its block, and the number of layers is the
logarithm of the number of rows to the base of a block.

Where a node stands in a log follows from the sizes of the subtrees before it, without any index: the subtree that ends
with leaf e at level l is preceded by all nodes that end at earlier leaves, which are e + e/2 + e/4 + … (whole parts,
counting leaves from 0), and by its own l lower nodes on that leaf. The sum is 2e - (number of ones in e).
"""

import hashlib
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazelake.llm.common import fold_of, hinted, only, sliced, staged

#: Levels of a block: it has 2**BLOCK_LEVELS leaves.
BLOCK_LEVELS = 10
#: Bytes of a hash, and of a step of a path: which side the sibling is on, and the sibling.
HASH, STEP = 32, 33
ALONE, LEFT, RIGHT = 0, 1, 2
#: Columns that a document's leaf is the hash of, in this order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
# Rows a task writes in order are numbered in the low bits of Spark's increasing ids.
_LOW_BITS = 33


def node_hash(*children: bytes) -> bytes:
    """The hash of a node from the hashes of its children, which enter as hex text."""
    return hashlib.sha256("".join(child.hex() for child in children).encode()).digest()


def height_of(leaves: int) -> int:
    """Levels above the leaves until one node is left."""
    return max(leaves - 1, 0).bit_length()


def position(level: int, index: int, leaves: int) -> int:
    """Where the node ``index`` of a level stands in the postorder log of a tree with so many leaves."""
    last = min((index + 1) << level, leaves) - 1
    return 2 * last - last.bit_count() + level


def append_log(leaves: list[bytes], height: int) -> list[bytes]:
    """The postorder log of a tree, written leaf by leaf; ``height`` levels stand above the leaves."""
    log, waiting = [], [[] for _ in range(height + 1)]  # nodes of each level whose parent is not complete

    def complete(node: bytes, level: int, last: bool) -> None:
        while True:
            log.append(node)
            if level == height:
                return
            waiting[level].append(node)
            if len(waiting[level]) < 2 and not last:
                return
            node, waiting[level], level = node_hash(*waiting[level]), [], level + 1

    for number, leaf in enumerate(leaves, 1):
        complete(leaf, 0, number == len(leaves))
    return log


def path_in(log: bytes, index: int, leaves: int, height: int) -> bytes:
    """The steps from a leaf to the top of its log: side and sibling of every level, from closed-form positions."""
    steps = []
    for level in range(height):
        sibling = (index >> level) ^ 1
        if sibling << level >= leaves:
            steps.append(bytes(STEP))
            continue
        at = HASH * position(level, sibling, leaves)
        steps.append(bytes([LEFT if sibling < index >> level else RIGHT]) + log[at : at + HASH])
    return b"".join(steps)


def siblings(path: bytes) -> list[bytes]:
    """The siblings of a path, bottom up."""
    return [path[i + 1 : i + STEP] for i in range(0, len(path), STEP) if path[i] != ALONE]


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path lead to."""
    node = leaf
    for i in range(0, len(path), STEP):
        side, sibling = path[i], path[i + 1 : i + STEP]
        node = node_hash(*((node,) if side == ALONE else (sibling, node) if side == LEFT else (node, sibling)))
    return node


def numbered(df: DataFrame, name: str, *order: str) -> DataFrame:
    """``df`` with ``number``: the place of each row, from 0, in ascending order of the columns, nulls first.

    Rows are ordered by ranges, so no task holds more than a range; the driver gets one count for each.
    """
    spark = df.sparkSession
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranges = staged(ranges.withColumn("_place", F.monotonically_increasing_id()), name)
    task = F.shiftright("_place", _LOW_BITS)
    counts = ranges.groupBy(task.alias("_task")).count().orderBy("_task").collect()
    ends = np.cumsum([row["count"] for row in counts], dtype=np.int64).tolist()
    before = [(row["_task"], end - row["count"]) for row, end in zip(counts, ends, strict=True)]
    before = spark.createDataFrame(before, "_task long, _before long")
    inside = F.col("_place").bitwiseAND(F.lit((1 << _LOW_BITS) - 1))
    rows = ranges.withColumn("_task", task).join(F.broadcast(before), "_task")
    return rows.withColumn("number", F.col("_before") + inside).drop("_task", "_before", "_place")


class Manifest(NamedTuple):
    """Numbered leaves (``tree, number, size, hash, …``), the logs above them and those above the groups' tops.

    ``size`` is the number of leaves of a tree. ``tops`` are ``tree, subroot``; a tree is the rank of its group.
    """

    leaves: DataFrame
    layers: list[DataFrame]
    tops: DataFrame
    group_layers: list[DataFrame]
    levels: int

    def root(self) -> bytes | None:
        """The root of all; None without rows."""
        found = self.group_layers[-1].select("top").first()
        return found and bytes(found["top"])


_LOG = pa.schema(
    [("tree", pa.int64()), ("block", pa.int64()), ("size", pa.int64()), ("log", pa.binary()), ("top", pa.binary())]
)


def _builder(levels: int):
    def build(table: pa.Table) -> pa.Table:
        """The log of one block from its leaves ``tree, number, size, hash``."""
        table = table.sort_by("number")
        size = table["size"][0].as_py()
        log = append_log(table["hash"].to_pylist(), min(levels, height_of(size)))
        block = table["number"][0].as_py() >> levels
        row = {"tree": table["tree"][0].as_py(), "block": block, "size": size, "log": b"".join(log), "top": log[-1]}
        return pa.Table.from_pylist([row], _LOG)

    return build


def _layers(leaves: DataFrame, levels: int) -> list[DataFrame]:
    """Logs above ``leaves(tree, number, size, hash)``, lowest first; the last one of a tree is a single block."""
    layers = []
    while True:
        block = F.shiftright("number", levels).alias("block")
        blocks = leaves.select("tree", "number", "size", "hash").groupBy("tree", block)
        schema = "tree long, block long, size long, log binary, top binary"
        logs = staged(blocks.applyInArrow(_builder(levels), schema), "manifest-log")
        layers.append(logs)
        more = logs.where(F.col("size") > 1 << levels)
        if not more.limit(1).count():
            return layers
        size = F.shiftright(F.col("size") + ((1 << levels) - 1), levels)
        leaves = more.select("tree", F.col("block").alias("number"), size.alias("size"), F.col("top").alias("hash"))


def _paths_of(row: dict, levels: int) -> list[bytes]:
    """The paths of all leaves of a log to the root, in order."""
    leaves, height = min(1 << levels, row["size"] - (row["block"] << levels)), min(levels, height_of(row["size"]))
    return [path_in(row["log"], i, leaves, height) + row["above"] for i in range(leaves)]


def _leaf_paths(batches, levels: int):
    for batch in sliced(batches, 1):
        (row,) = batch.to_pylist()
        paths = _paths_of(row, levels)
        first = row["block"] << levels
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([row["tree"]] * len(paths), pa.int64()),
                pa.array(range(first, first + len(paths)), pa.int64()),
                pa.array(paths, pa.binary()),
            ],
            names=["tree", "number", "above"],
        )


def _downwards(layers: list[DataFrame], ends: DataFrame, levels: int) -> DataFrame:
    """The lowest logs with ``above``, the path from a log's top to the root; ``ends`` has it for whole trees."""
    whole, paths = F.col("size") <= 1 << levels, None
    for logs in reversed(layers):
        here = logs.where(whole).join(ends, "tree")
        if paths is not None:
            here = here.unionByName(logs.where(~whole).join(paths.withColumnRenamed("number", "block"), ["tree", "block"]))
        if logs is not layers[0]:
            paths = here.mapInArrow(partial(_leaf_paths, levels=levels), "tree long, number long, above binary")
    return here


def build_manifest(leaves: DataFrame, levels: int = BLOCK_LEVELS) -> Manifest:
    """The manifest of ``leaves(group, id, hash, …)``; the logs are stored in the shared folder.

    Groups are in ascending order, a null one first; within a group leaves are in ascending order of id (a null one
    first) and, where an id is repeated, of hash. ``hash`` is binary. Further columns are kept beside the leaves.
    """
    groups = numbered(leaves.select("group").distinct(), "manifest-groups", "group")
    groups = groups.select(F.col("group").alias("_group"), F.col("number").alias("tree"))
    ranked = leaves.join(hinted(groups), F.col("group").eqNullSafe(F.col("_group"))).drop("_group")
    ordered = numbered(ranked, "manifest-leaves", "tree", "id", "hash")
    sizes = ordered.groupBy("tree").agg(F.min("number").alias("_first"), F.count(F.lit(1)).alias("size"))
    ordered = ordered.join(hinted(staged(sizes, "manifest-sizes")), "tree")
    ordered = ordered.withColumn("number", F.col("number") - F.col("_first")).drop("_first")
    layers = _layers(ordered, levels)
    whole = [logs.where(F.col("size") <= 1 << levels).select("tree", F.col("top").alias("subroot")) for logs in layers]
    tops = whole[0]
    for more in whole[1:]:
        tops = tops.unionByName(more)
    tops = staged(tops, "manifest-tops")
    of_groups = tops.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("number"), F.lit(tops.count()).cast("long").alias("size"), F.col("subroot").alias("hash")
    )
    return Manifest(ordered, layers, tops, _layers(of_groups, levels), levels)


def with_paths(manifest: Manifest) -> DataFrame:
    """The leaves' ``group, id, hash, …`` with ``subroot`` and ``path``: the steps from the leaf through it to the root.

    A block's leaves meet the block's log alone; of the layers above each block gets one path.
    """
    spark, levels = manifest.leaves.sparkSession, manifest.levels
    start = spark.createDataFrame([(0, b"")], "tree long, above binary")
    groups = _downwards(manifest.group_layers, start, levels)
    groups = groups.mapInArrow(partial(_leaf_paths, levels=levels), "tree long, number long, above binary")
    ends = groups.select(F.col("number").alias("tree"), "above").join(manifest.tops, "tree")
    logs = _downwards(manifest.layers, ends.drop("subroot"), levels).join(manifest.tops, "tree")
    kept = manifest.leaves.drop("tree", "size")
    fields = [f for f in kept.schema if f.name != "number"]
    names = [f.name for f in fields]

    def of_block(leaves: pa.Table, logs: pa.Table) -> pa.Table:
        leaves, (row,) = leaves.sort_by("number"), logs.to_pylist()
        added = {"subroot": [row["subroot"]] * leaves.num_rows, "path": _paths_of(row, levels)}
        columns = [leaves[name] for name in names] + [pa.array(values, pa.binary()) for values in added.values()]
        return pa.table(columns, names=[*names, *added])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "subroot binary, path binary"])
    block = F.shiftright("number", levels).alias("block")
    return manifest.leaves.groupBy("tree", block).cogroup(logs.groupBy("tree", "block")).applyInArrow(of_block, schema)


def document_leaf(n_chars: Column | None = None) -> Column:
    """The leaf of a document in hex; ``n_chars`` replaces the column of that name."""
    values = {name: F.col(f"`{name}`").cast("string") for name in LEAF_COLUMNS}
    if n_chars is not None:
        values["n_chars"] = n_chars.cast("string")
    parts = (F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values.values())
    return F.sha2(F.concat(*parts), 256)


def _digests(batches, root: bytes):
    for batch in sliced(batches, 1024):
        rows = batch.to_pylist()
        folded = [fold(r["claim"] or r["hash"], r["path"]) for r in rows]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                pa.array([r["hash"].hex() for r in rows]),
                pa.array([r["subroot"].hex() for r in rows]),
                pa.array([root.hex()] * len(rows)),
                pa.array([node_hash(*siblings(r["path"])).hex() for r in rows]),
                pa.array([f.hex() for f in folded]),
                pa.array([f == root for f in folded]),
            ],
            names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
        )


def audit(docs: DataFrame, every: int = 7, levels: int = BLOCK_LEVELS) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row of ``docs``.

    The manifest is built over whole documents, a group per ``lang``. Of documents whose crc32 of the id ``every`` divides, the
    leaf to be verified has ``n_chars`` one higher; where it is null nothing is changed. Rows of one id are leaves
    each, in the order of their hashes; a null id stands first, and is the empty text to crc32. An empty table gives no
    rows. Whether further columns stand beside those of the leaf makes no difference.
    """
    tampered = fold_of(F.col("doc_id"), every) == 0
    leaves = only(docs, *LEAF_COLUMNS).select(
        F.col("lang").alias("group"),
        F.col("doc_id").alias("id"),
        F.unhex(document_leaf()).alias("hash"),
        F.unhex(F.when(tampered & F.col("n_chars").isNotNull(), document_leaf(F.col("n_chars") + 1))).alias("claim"),
    )
    manifest = build_manifest(staged(leaves, "leaves"), levels)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return with_paths(manifest).mapInArrow(
        partial(_digests, root=manifest.root() or b""),
        f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    )


def _leaf_sql(n_chars: str) -> str:
    def part(value: str) -> str:
        return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"

    return "sha256(" + " || ".join(part(n_chars if name == "n_chars" else name) for name in LEAF_COLUMNS) + ")"


_CRC_SQL = """list_reduce(list_prepend(4294967295::BIGINT, [ascii(c) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]::BIGINT[]),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
        lambda x, i: xor(x >> 1, (x & 1) * 3988292384)))"""

MANIFEST_SQL = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, {_leaf_sql("n_chars")} AS leaf,
        CASE WHEN xor({_CRC_SQL}, 4294967295) % 7 = 0 THEN {_leaf_sql("n_chars + 1")} ELSE {_leaf_sql("n_chars")} END AS claim
    FROM documents
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
        count(*) OVER (PARTITION BY tree) AS size FROM leaves
), nodes AS (
    SELECT 0 AS level, tree, place, size, leaf AS hash FROM placed
    UNION ALL
    SELECT level + 1, tree, place // 2, (size + 1) // 2, sha256(string_agg(hash, '' ORDER BY place))
    FROM nodes WHERE size > 1 GROUP BY level, tree, place // 2, size
), tops AS (
    SELECT tree AS place, hash, level AS height, count(*) OVER () AS size FROM nodes WHERE size = 1
), upper AS (
    SELECT 0 AS level, place, size, hash FROM tops
    UNION ALL
    SELECT level + 1, place // 2, (size + 1) // 2, sha256(string_agg(hash, '' ORDER BY place))
    FROM upper WHERE size > 1 GROUP BY level, place // 2, size
), steps AS (
    SELECT p.tree, p.place AS leaf_place, n.level AS step, n.hash AS sibling, n.place < (p.place >> n.level) AS is_left
    FROM placed p JOIN nodes n ON n.tree = p.tree AND n.place = xor(p.place >> n.level, 1::BIGINT)
    UNION ALL
    SELECT p.tree, p.place, t.height + u.level, u.hash, u.place < (t.place >> u.level)
    FROM placed p JOIN tops t ON t.place = p.tree JOIN upper u ON u.place = xor(t.place >> u.level, 1::BIGINT)
), folds AS (
    SELECT p.tree, p.place, 0 AS step, t.height + (SELECT max(level) FROM upper) AS height, claim AS hash
    FROM placed p JOIN tops t ON t.place = p.tree
    UNION ALL
    SELECT f.tree, f.place, f.step + 1, f.height, sha256(CASE WHEN sibling IS NULL THEN f.hash
        WHEN is_left THEN sibling || f.hash ELSE f.hash || sibling END)
    FROM folds f LEFT JOIN steps s ON s.tree = f.tree AND s.leaf_place = f.place AND s.step = f.step
    WHERE f.step < f.height
), proofs AS (
    SELECT tree, leaf_place, sha256(string_agg(sibling, '' ORDER BY step)) AS proof FROM steps GROUP BY tree, leaf_place
)
SELECT p.doc_id, p.leaf, t.hash AS subroot, root.hash AS root, coalesce(proof, sha256('')) AS proof_sha256,
    f.hash AS folded_root, f.hash = root.hash AS verified
FROM placed p JOIN tops t ON t.place = p.tree JOIN folds f ON f.tree = p.tree AND f.place = p.place AND f.step = f.height
LEFT JOIN proofs ON proofs.tree = p.tree AND proofs.leaf_place = p.place
CROSS JOIN (SELECT hash FROM upper WHERE size = 1) root
"""
