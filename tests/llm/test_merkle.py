"""The Merkle manifest against a plain recursion, over several arities and superblock sizes."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from quillrank.llm import merkle_manifest, queries

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    values = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return digest("".join(values))


def grow(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest("".join(below[i : i + arity])) for i in range(0, len(below), arity)])
    return levels


def way(levels, at, arity):
    for nodes in levels[:-1]:
        start = at // arity * arity
        yield "".join(nodes[start:at]), "".join(nodes[at + 1 : start + arity])
        at //= arity


def brute(rows, arity=2):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row."""
    groups = {}
    for doc_id, text, lang, source, n_chars in rows:
        leaf = leaf_of(doc_id, source, lang, n_chars, text)
        claim = leaf
        if doc_id is not None and n_chars is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0:
            claim = leaf_of(doc_id, source, lang, n_chars + 1, text)
        groups.setdefault(lang, []).append((doc_id, leaf, claim))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[name] = grow([leaf for _, leaf, _ in groups[name]], arity)
    crown = grow([trees[name][-1][0] for name in names], arity)
    root, out = crown[-1][0] if names else None, []
    for place, name in enumerate(names):
        for at, (doc_id, leaf, folded) in enumerate(groups[name]):
            proof = ""
            for left, right in [*way(trees[name], at, arity), *way(crown, place, arity)]:
                proof += left + right
                folded = digest(left + folded + right)
            out.append((doc_id, leaf, trees[name][-1][0], root, digest(proof), folded, folded == root))
    return sorted(out, key=str)


def found(spark, rows, **options):
    table = spark.createDataFrame(rows, DOCUMENTS).withColumn("pos", F.lit(1)).withColumn("grp", F.lit("x"))
    mark = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    if not options:
        got = merkle_manifest.document_proofs(table, mark)
    else:
        fields = [F.col(name) for name in merkle_manifest.DOCUMENT_FIELDS]
        claim = merkle_manifest.leaf_digest(fields[:3] + [F.col("n_chars") + 1] + fields[4:])
        claimed = F.when(mark & F.col("n_chars").isNotNull(), claim)
        got = merkle_manifest.prove(table, merkle_manifest.leaf_digest(fields), claimed, **options)
    columns = ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted([tuple(row) for row in got.select(*columns).collect()], key=str)


def rows_of(n, seed):
    draw = random.Random(seed)
    langs = [None, "", "de", "en", "ünd", "zh"]
    return [
        (i, "x" * draw.choice([0, 3, 5000]) + str(i), draw.choice(langs[: draw.randint(1, 6)]), None, draw.choice([None, 7]))
        for i in draw.sample(range(10 * n + 1), n)
    ]


EDGES = [
    (None, None, None, None, None),
    (5, "tie", "en", "web", 3),
    (5, "tie", "en", "web", 3),
    (5, "tie é日", "en", "web", 3),
    (7, "", "en", None, None),
    (2**62, "x" * 200_000, "en", "a:b", 2**62),
    (-3, "below", "solo", "web", 5),
]


@pytest.mark.parametrize("rows", [EDGES, EDGES[:1], EDGES[-1:], rows_of(60, 1)], ids=["edges", "null", "one", "many"])
def test_equals_recursion(spark, rows):
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize(("arity", "levels"), [(2, 1), (2, 2), (3, 1)])
def test_small_superblocks_give_the_same_tree(spark, arity, levels):
    rows = rows_of(45, 2) + EDGES
    assert found(spark, rows, arity=arity, levels=levels) == brute(rows, arity)


def test_siblings_fold_to_the_root_and_tampering_shows(spark):
    rows = rows_of(40, 3)
    table = spark.createDataFrame(rows, DOCUMENTS)
    got = merkle_manifest.document_proofs(table, F.col("doc_id") % 2 == 0, with_siblings=True).collect()
    for row in got:
        folded = row["leaf"]
        for left, right in zip(row["lefts"], row["rights"]):
            folded = digest(left + folded + right)
        assert folded == row["root"]
    chars = {r[0]: r[4] for r in rows}
    for row in got:
        assert row["verified"] == (row["key"] % 2 == 1 or chars[row["key"]] is None)


def test_empty_table_and_registered_query(spark, tmp_path):
    assert found(spark, []) == []
    spark.createDataFrame(EDGES, DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_merkle_manifest(spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert dict(got.dtypes)["doc_id"] == "bigint"
    assert sorted([tuple(row) for row in got.collect()], key=str) == brute(EDGES)
