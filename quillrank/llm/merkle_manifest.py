"""A Merkle manifest of a dataset: subroot and root of every row, its proof, and a check of claimed rows.

Rows of a group ascend by key. Runs of ``ARITY`` consecutive nodes become the hash of their digests, written
one after the other as hex text (the last run may be shorter; even a single node is hashed), until one node, the
group's subroot, is left; a lone leaf is its own subroot. Subroots in the order of their groups give the root in
the same way.

The tree is built by superblocks of ``ARITY ** LEVELS`` consecutive nodes. Going up, each superblock becomes one
node, until every group is one; each pass shrinks the table a thousandfold. Going down, the nodes of each pass and
the outer nodes on the way from their superblock to the root are cogrouped, so that a task sees one superblock and
a few dozen digests, never a whole group. The last cogroup reduces the leaves again, joins inner and outer
siblings to proofs and folds the claimed leaves.

Defined results: a null field counts as ``-``, any other as its number of UTF-8 bytes, ``:`` and the value; a null
group comes first and is a group of its own; null keys come first in their group; rows that share a key follow each
other by leaf digest, equal rows in any order; texts are hashed whole; further columns are ignored; an empty table
gives an empty result. A proof without siblings is empty.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillrank.llm.common import let_workers_import
from quillrank.operators.grouping import is_small
from quillrank.session import materialise

ARITY = 2
#: Levels of the tree inside a superblock.
LEVELS = 10
_NODES = "grp string, pos long, n long, digest string"
_PATHS = "grp string, pos long, lefts array<string>, rights array<string>, subroot string, root string"
_PROOFS = (
    "key string, leaf string, subroot string, root string, lefts array<string>, rights array<string>, "
    "proof_sha256 string, folded_root string"
)


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Hash of the fields, each with its length before it so that no two rows read alike."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _levels(n: int, arity: int) -> int:
    """Levels above the leaves until one node is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // arity), levels + 1
    return levels


def _climbed(nodes: list[str], levels: int, arity: int) -> list[list[str]]:
    """The nodes of each level, the given ones first."""
    out = [nodes]
    for _ in range(levels):
        nodes = [_hash("".join(nodes[at : at + arity])) for at in range(0, len(nodes), arity)]
        out.append(nodes)
    return out


def _siblings(tree: list[list[str]], at: int, arity: int) -> tuple[list[str], list[str]]:
    """What stands left and right of a leaf's way up in its runs, level by level."""
    lefts, rights = [], []
    for nodes in tree[:-1]:
        start = at - at % arity
        lefts.append("".join(nodes[start:at]))
        rights.append("".join(nodes[at + 1 : start + arity]))
        at //= arity
    return lefts, rights


def _numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``pos`` from 0 in each ``grp`` and the group's size ``n``: a range sort and one offset a task and group."""
    place = F.monotonically_increasing_id()  # deals equal rows out as well
    ranged = rows.withColumn("place", place).repartitionByRange("grp", *order, "place")
    ranged = ranged.sortWithinPartitions("grp", *order, "place").drop("place")
    stored = materialise(ranged.withColumn("row", F.monotonically_increasing_id()), "merkle-sorted")
    stored = stored.withColumn("share", F.shiftright("row", 33))
    shares = stored.groupBy("grp", "share").agg(F.min("row").alias("first"), F.count("*").alias("rows"))
    before = Window.partitionBy("grp").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shares.select(
        "grp",
        "share",
        "first",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"),
        F.sum("rows").over(Window.partitionBy("grp")).alias("n"),
    )
    offsets = F.broadcast(offsets) if is_small(offsets) else offsets
    placed = stored.join(offsets, ["grp", "share"])
    return placed.withColumn("pos", F.col("row") - F.col("first") + F.col("base")).drop("share", "row", "first", "base")


def _in_blocks(nodes: DataFrame, arity: int, levels: int):
    block = F.expr(f"pos div {arity**levels}").alias("block")
    return nodes.groupBy("grp", block)


def _climb(nodes: DataFrame, arity: int, levels: int) -> list[DataFrame]:
    """Tables of nodes: the given one, then the superblocks' roots and so on, until each group is one node."""
    size = arity**levels

    def reduce(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        n = int(block["n"].iloc[0])
        digests = block.sort_values("pos")["digest"].tolist()
        top = _climbed(digests, min(levels, _levels(n, arity)), arity)[-1]
        return pd.DataFrame({"grp": [key[0]], "pos": [key[1]], "n": [-(-n // size)], "digest": top})

    tables = [nodes]
    largest = size + 1
    while largest > 1:
        below = tables[-1].select("grp", "pos", "n", "digest")
        tables.append(materialise(_in_blocks(below, arity, levels).applyInPandas(reduce, _NODES), "merkle-nodes"))
        largest = tables[-1].agg(F.coalesce(F.max("n"), F.lit(1))).first()[0]
    return tables


def _descend(tables: list[DataFrame], paths: DataFrame, arity: int, levels: int) -> DataFrame:
    """The way to the root of the nodes of ``tables[0]``, from that of the groups' last nodes."""

    def lower(key: tuple, block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        block, above = block.sort_values("pos"), outer.iloc[0]
        tree = _climbed(block["digest"].tolist(), min(levels, _levels(int(block["n"].iloc[0]), arity)), arity)
        ways = [_siblings(tree, at, arity) for at in range(len(block))]
        return pd.DataFrame({
            "grp": block["grp"],
            "pos": block["pos"],
            "lefts": [lefts + list(above["lefts"]) for lefts, _ in ways],
            "rights": [rights + list(above["rights"]) for _, rights in ways],
            "subroot": above["subroot"],
            "root": above["root"],
        })

    for table in reversed(tables[:-1]):
        below = table.select("grp", "pos", "n", "digest")
        outer = paths.groupBy("grp", F.col("pos").alias("block"))
        joined = _in_blocks(below, arity, levels).cogroup(outer).applyInPandas(lower, _PATHS)
        paths = materialise(joined, "merkle-paths")
    return paths


def _above_groups(tops: DataFrame, arity: int, levels: int) -> DataFrame:
    """Subroot, root and the way between them for the one node of each group."""
    subroots = tops.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest")
    ordered = materialise(_numbered(subroots, ["name"]), "merkle-subroots")
    tables = _climb(ordered, arity, levels)
    none = F.array().cast("array<string>")
    top = tables[-1].select(
        "grp", "pos", none.alias("lefts"), none.alias("rights"), F.lit("").alias("subroot"), F.col("digest").alias("root")
    )
    ways = _descend(tables, top, arity, levels).drop("grp", "subroot")
    names = ordered.select("pos", F.col("name").alias("grp"), F.col("digest").alias("subroot"))
    return names.join(ways, "pos").select(
        "grp", F.lit(0).cast("long").alias("pos"), "lefts", "rights", "subroot", "root"
    )


def prove(
    rows: DataFrame,
    leaf: Column,
    claimed: Column | None = None,
    group: str = "lang",
    key: str = "doc_id",
    with_siblings: bool = False,
    arity: int = ARITY,
    levels: int = LEVELS,
) -> DataFrame:
    """The place of every row in the tree over the ``leaf`` digests, and whether its ``claimed`` digest belongs there.

    Gives ``key, leaf, subroot, root, proof_sha256, folded_root, verified``; ``proof_sha256`` is the hash of all
    siblings from the leaf to the root, ``folded_root`` what the claimed digest (if null, the leaf) and these
    siblings fold to. ``with_siblings`` adds them as ``lefts`` and ``rights``, one text of digests a level.
    """
    spark = rows.sparkSession
    let_workers_import(spark)
    kind = dict(rows.dtypes)[key]
    grouped = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaves = rows.select(
        grouped.alias("grp"),
        F.col(key).alias("key"),
        leaf.alias("digest"),
        (F.lit(None) if claimed is None else claimed).cast("string").alias("claimed"),
    )
    # Digests are stored before they are sorted, as sampling the ranges would read all texts again.
    placed = materialise(_numbered(materialise(leaves, "merkle-leaves"), ["key", "digest"]), "merkle-placed")
    tables = _climb(placed, arity, levels)
    paths = _descend(tables[1:], _above_groups(tables[-1], arity, levels), arity, levels)
    size = arity**levels

    def finish(_: tuple, block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        block, above = block.sort_values("pos"), outer.iloc[0]
        tree = _climbed(block["digest"].tolist(), min(levels, _levels(int(block["n"].iloc[0]), arity)), arity)
        outer_lefts, outer_rights = list(above["lefts"]), list(above["rights"])
        out = {"lefts": [], "rights": [], "proof_sha256": [], "folded_root": []}
        for at, (leaf, claim) in enumerate(zip(tree[0], block["claimed"])):
            lefts, rights = _siblings(tree, at, arity)
            lefts, rights = lefts + outer_lefts, rights + outer_rights
            folded = claim if isinstance(claim, str) else leaf
            proof = sha256()
            for left, right in zip(lefts, rights):
                proof.update((left + right).encode())
                folded = _hash(left + folded + right)
            out["proof_sha256"].append(proof.hexdigest())
            out["folded_root"].append(folded)
            out["lefts"].append(lefts if with_siblings else None)
            out["rights"].append(rights if with_siblings else None)
        return pd.DataFrame({
            "key": block["key"].tolist(), "leaf": tree[0], "subroot": above["subroot"], "root": above["root"], **out
        })

    below = placed.select("grp", "pos", "n", "digest", F.col("key").cast("string").alias("key"), "claimed")
    blocks = below.groupBy("grp", F.expr(f"pos div {size}").alias("block"))
    proven = blocks.cogroup(paths.groupBy("grp", F.col("pos").alias("block"))).applyInPandas(finish, _PROOFS)
    proven = proven.withColumn("verified", F.col("folded_root") == F.col("root")).withColumn("key", F.col("key").cast(kind))
    return proven if with_siblings else proven.drop("lefts", "rights")


DOCUMENT_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def document_proofs(documents: DataFrame, tampered: Column, with_siblings: bool = False) -> DataFrame:
    """:func:`prove` over ``documents``; rows where ``tampered`` holds claim one character more than they have."""
    fields = {name: F.col(name) for name in DOCUMENT_FIELDS}
    more = F.col("n_chars").cast("decimal(38,0)") + 1
    claim = leaf_digest([*(fields | {"n_chars": more}).values()])
    claimed = F.when(tampered & F.col("n_chars").isNotNull(), claim)
    return prove(documents, leaf_digest([*fields.values()]), claimed, with_siblings=with_siblings)
