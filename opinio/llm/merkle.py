"""Merkle dataset manifest by a butterfly exchange of subtree roots.

A leaf is the digest of a row's fields. Per group (source), the leaves ascend
by id, and runs of ``fanout`` consecutive nodes become their parent until one
node, the subroot, is left; the subroots, in the order of their groups, form a
tree of the same shape whose last node is the root.

1. Leaves are hashed in the JVM and written once as digests; texts take part
   in no shuffle. A range sort by (group, id) numbers them without a window
   over a group: each task numbers its own run and the runs' sizes, one row
   per task and group, give the offsets.
2. A partition of the tree is a block of ``fanout ** depth`` consecutive
   leaves, one row, whose local levels are built in the task that holds it.
3. Butterfly rounds: in round r the blocks whose numbers differ in their r-th
   digit (base ``fanout``) alone swap the roots of the subtrees that they
   stand in, at most ``fanout`` of them, and each hashes the parent for
   itself. So every block redundantly computes all its ancestors and gathers
   the siblings of each level; when the rounds end it holds its upper proof
   and the root, and nothing has to be sent down the tree. In the last,
   smaller subtree of a row of siblings, blocks stand in for the missing
   ones, in turn. The rounds are logarithmic in the largest group's blocks,
   and one row per block is exchanged in each, written to the shared folder.
4. The subroots go through steps 2 and 3 as one group, and each block's upper
   proof is extended by its group's.

A hot group is many blocks like any other rows; no task holds more than a
block's leaves, and nothing is collected or hinted to be broadcast.

Defined results: a null field is ``-``, an empty text ``0:``; null ids come
first in a group, rows with one id are ordered by their leaf digests (equal
rows are separate leaves); the null group comes first; a lone leaf is its
subroot and a lone subroot the root; a proof without siblings is the digest
of nothing; extra columns are not carried, and an output that has the id
column's name gets a ``_``; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinio.llm.common import arrow_map, distinct_names, materialise

FANOUT = 16
#: Levels inside a block (4,096 leaves at a fanout of 16).
DEPTH = 3

#: Fields of ``documents`` in the order in which a leaf hashes them.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: One level of a proof: the node's place in its run and the run's other digests.
LEVEL = "struct<at:int,others:array<binary>>"


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 (binary) of a row's fields."""
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def _parent(run: Column) -> Column:
    """Digest of a run of binary digests, concatenated as lower-case hex."""
    return F.unhex(F.sha2(F.concat_ws("", F.transform(run, lambda d: F.lower(F.hex(d)))), 256))


def parent_digest(run: Sequence[bytes]) -> bytes:
    """The same for one run in Python."""
    return hashlib.sha256("".join([d.hex() for d in run]).encode()).digest()


def local_levels(leaves: list[bytes], levels: int, fanout: int) -> list[list[bytes]]:
    """Nodes of a block, leaves first, then ``levels`` levels above them."""
    out = [leaves]
    for _ in range(levels):
        below = out[-1]
        out.append([parent_digest(below[i:i + fanout]) for i in range(0, len(below), fanout)])
    return out


def n_levels(leaves: int, fanout: int) -> int:
    """Levels above the leaves until one node is left."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // fanout), levels + 1
    return levels


def fold(leaf: bytes, proof: Sequence[tuple[int, Sequence[bytes]]]) -> bytes:
    """The root that a leaf and its proof lead to."""
    for at, others in proof:
        leaf = parent_digest([*others[:at], leaf, *others[at:]])
    return leaf


def numbered(rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``pos``, from 0 in each group in the given order, and ``total``.

    ``order`` must end in a column that makes it total. One range shuffle; a
    group may span any number of tasks. ``run`` numbers the (task, group)
    pairs, and their sizes, one row each, give the offsets by a window.
    """
    ordered = rows.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    names, keys = rows.columns, [rows.columns.index(g) for g in group]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, run, at = TaskContext.get().partitionId(), None, -1, 0
        for batch in batches:
            runs, places = [], []
            values = [batch.column(k).to_pylist() for k in keys]
            for key in zip(*values) if keys else [()] * batch.num_rows:
                if key != last:
                    last, run, at = key, run + 1, 0
                runs.append(run)
                places.append(at)
                at += 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * batch.num_rows, pa.int32()), pa.array(runs, pa.int64()),
                 pa.array(places, pa.int64())], [*names, "_part", "_run", "_at"])

    placed = materialise(arrow_map(ordered, number, f"{schema}, _part int, _run bigint, _at bigint"), name)
    sizes = placed.groupBy("_part", "_run", *group).agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(F.col("_part").alias("_p"), F.col("_run").alias("_r"),
                         F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"),
                         F.sum("_n").over(whole).alias("total"))
    return (placed.join(bases, (F.col("_part") == F.col("_p")) & (F.col("_run") == F.col("_r")))
            .select(*names, (F.col("_base") + F.col("_at")).alias("pos"), "total"))


def blocks_of(rows: DataFrame, group: Sequence[str], payload: Sequence[str], fanout: int, depth: int) -> DataFrame:
    """One row per block: group, ``block``, ``total``, its ``rows`` in order
    (``hash`` and the payload columns), and its local root ``node``."""
    size = fanout ** depth
    held = F.struct("pos", "hash", *payload)
    blocks = (rows.groupBy(*group, F.floor(F.col("pos") / size).alias("block"))
              .agg(F.first("total").alias("total"), F.sort_array(F.collect_list(held)).alias("rows")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in blocks.schema.fields) + ", node binary"
    names = blocks.columns
    total_at, rows_at = names.index("total"), names.index("rows")

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = []
            for total, held in zip(batch.column(total_at).to_pylist(), batch.column(rows_at)):
                leaves = held.values.field("hash").to_pylist()
                nodes.append(local_levels(leaves, min(depth, n_levels(total, fanout)), fanout)[-1][0])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.binary())], [*names, "node"])

    return arrow_map(blocks, roots, schema)


def butterfly(blocks: DataFrame, group: Sequence[str], fanout: int, depth: int) -> DataFrame:
    """Upper proofs: group, ``block``, ``node`` (the group's last node) and
    ``path`` (levels above the block)."""
    state = materialise(
        blocks.select(*group, "block", F.ceil(F.col("total") / fanout ** depth).alias("n_blocks"), "node",
                      F.array().cast(f"array<{LEVEL}>").alias("path")), "butterfly")
    most = state.agg(F.max("n_blocks")).first()[0] or 0
    width = 1  # blocks under one node of this round
    while width < most:
        nodes = F.ceil(F.col("n_blocks") / width)
        low = F.col("block") % width
        tree = F.floor(F.col("block") / width)
        # Blocks in the sender's own subtree; fewer than ``width`` only in the last one.
        own = F.least(F.lit(width), F.col("n_blocks") - tree * width)
        # A smaller subtree's blocks stand in for its missing ones; a subtree without siblings has no one to tell.
        alone = (nodes - 1 == tree) & (tree % fanout == 0)
        lows = F.when(alone, F.array(low)).otherwise(F.sequence(low, F.lit(width - 1).cast("long"), own))
        sent = (state.where(nodes > 1).withColumn("_low", F.explode(lows))
                .select(*group, F.floor(tree / fanout).alias("_parent"), "_low", (tree % fanout).cast("int").alias("at"),
                        "node", F.when(F.col("_low") == low, F.struct("block", "n_blocks", "path")).alias("to")))
        met = (sent.groupBy(*group, "_parent", "_low")
               .agg(F.sort_array(F.collect_list(F.struct("at", "node", "to"))).alias("run")))
        nodes_of = F.transform("run", lambda x: x["node"])
        told = (met.withColumn("_node", _parent(nodes_of)).withColumn("_all", nodes_of)
                .withColumn("_to", F.explode(F.filter("run", lambda x: x["to"].isNotNull()))))
        others = F.filter("_all", lambda x, i: i != F.col("_to.at"))
        level = F.struct(F.col("_to.at").alias("at"), others.alias("others"))
        new = told.select(*group, F.col("_to.to.block").alias("block"), F.col("_to.to.n_blocks").alias("n_blocks"),
                          F.col("_node").alias("node"),
                          F.concat(F.col("_to.to.path"), F.array(level)).cast(f"array<{LEVEL}>").alias("path"))
        state = materialise(state.where(nodes <= 1).unionByName(new), "butterfly")
        width *= fanout
    return state.drop("n_blocks")


#: What a manifest can give for each row besides its id.
OUTPUTS = {
    "leaf": ("binary", pa.binary()),
    "claim": ("binary", pa.binary()),
    "subroot": ("binary", pa.binary()),
    "root": ("binary", pa.binary()),
    "proof": (f"array<{LEVEL}>", pa.list_(pa.struct([("at", pa.int32()), ("others", pa.list_(pa.binary()))]))),
    "proof_digest": ("binary", pa.binary()),    # of all siblings, level by level, left to right
    "folded_root": ("binary", pa.binary()),     # from the claimed leaf and the proof
}


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields: Sequence[str] = FIELDS,
             claims: dict[str, Column] | None = None, fanout: int = FANOUT, depth: int = DEPTH,
             outputs: Sequence[str] = ("leaf", "subroot", "root", "proof")) -> DataFrame:
    """One row per document: ``id_col`` and ``outputs``.

    ``claims`` maps fields to the values that are claimed for them; the leaf
    of the claimed row is ``claim`` (the row's own without claims), and
    ``folded_root`` is what it and the row's proof lead to, which equals
    ``root`` for an unchanged row.
    """
    own = [F.col(c) for c in fields]
    claimed = leaf_digest([(claims or {}).get(c, F.col(c)) for c in fields]) if claims else F.lit(None).cast("binary")
    leaves = materialise(docs.select(F.col(id_col).alias("id"), F.col(group_col).alias("grp"),
                                     leaf_digest(own).alias("hash"), claimed.alias("claim"),
                                     F.monotonically_increasing_id().alias("row")), "leaves")
    placed = numbered(leaves, ["grp"], ["id", "hash", "row"], "placed")
    blocks = materialise(blocks_of(placed, ["grp"], ["id", "claim"], fanout, depth), "blocks")
    lower = butterfly(blocks.select("grp", "block", "total", "node"), ["grp"], fanout, depth)

    # Every block of a group ends with its subroot; the first one stands for it.
    subroots = lower.where("block = 0").select("grp", F.col("node").alias("hash"))
    tops = materialise(blocks_of(numbered(subroots, [], ["grp"], "subroots"), [], ["grp"], fanout, depth), "top_blocks")
    upper = butterfly(tops.select("block", "total", "node"), [], fanout, depth)
    top = _expand(tops.join(upper.select(F.col("block").alias("_b"), F.col("node").alias("last"), "path"),
                            F.col("block") == F.col("_b")).drop("_b"),
                  "grp", docs.schema[group_col].dataType.simpleString(), ("proof", "root"), fanout, depth)
    ends = lower.join(top.select(F.col("grp").alias("_g"), F.col("proof").alias("top"), "root"),
                      F.col("grp").eqNullSafe(F.col("_g")))
    ends = ends.select(F.col("grp").alias("_g"), F.col("block").alias("_b"), F.col("node").alias("last"),
                       F.concat("path", "top").alias("path"), "root")
    whole = blocks.join(ends, F.col("grp").eqNullSafe(F.col("_g")) & (F.col("block") == F.col("_b")))
    rows = _expand(whole.drop("_g", "_b"), "id", docs.schema[id_col].dataType.simpleString(), tuple(outputs),
                   fanout, depth)
    return rows.toDF(*distinct_names(id_col, *outputs))


def _expand(blocks: DataFrame, id_col: str, kind: str, outputs: Sequence[str], fanout: int, depth: int) -> DataFrame:
    """The rows of each block with their own proofs: its local levels, then ``path``."""
    names = blocks.columns
    schema = ", ".join([f"`{id_col}` {kind}", *(f"{x} {OUTPUTS[x][0]}" for x in outputs)])
    has_root = "root" in names

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                one = {n: batch.column(k)[r] for k, n in enumerate(names)}
                rows, path = one["rows"].values, [(x["at"], x["others"]) for x in one["path"].as_py()]
                ids, leaves = rows.field(id_col), rows.field("hash").to_pylist()
                claims = rows.field("claim").to_pylist() if "claim" in outputs or "folded_root" in outputs else []
                subroot = one["last"].as_py()
                root = one["root"].as_py() if has_root else subroot
                levels = local_levels(leaves, min(depth, n_levels(one["total"].as_py(), fanout)), fanout)
                # Hex of whole runs once per block; a proof joins parts of them.
                above = "".join([d.hex() for _, others in path for d in others])
                made: dict[str, list] = {x: [] for x in outputs}
                for i, leaf in enumerate(leaves):
                    proof, at = [], i
                    for nodes in levels[:-1]:
                        start = at // fanout * fanout
                        proof.append((at - start, nodes[start:at] + nodes[at + 1:start + fanout]))
                        at //= fanout
                    claim = claims[i] if claims and claims[i] is not None else leaf
                    row = {"leaf": leaf, "claim": claim, "subroot": subroot, "root": root}
                    if "proof" in made:
                        row["proof"] = [{"at": a, "others": o} for a, o in proof + path]
                    if "proof_digest" in made:
                        siblings = "".join([d.hex() for _, others in proof for d in others]) + above
                        row["proof_digest"] = hashlib.sha256(siblings.encode()).digest()
                    if "folded_root" in made:
                        row["folded_root"] = fold(claim, proof + path)
                    for x in outputs:
                        made[x].append(row[x])
                for s in range(0, len(leaves), 512):
                    yield pa.RecordBatch.from_arrays(
                        [ids[s:s + 512], *(pa.array(made[x][s:s + 512], OUTPUTS[x][1]) for x in outputs)],
                        [id_col, *outputs])

    return arrow_map(blocks, expand, schema)
