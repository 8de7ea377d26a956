"""The registered queries of this subpackage and, where SQL can state one, its SQL equivalent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillrank.llm import (
    byte_bpe,
    decontaminate,
    heap_clusters,
    html_tree,
    language_spans,
    line_chunks,
    merkle_manifest,
    ngram_join,
    nn_descent,
    quality_ledger,
    sharding,
    token_files,
    toxic_spans,
)
from quillrank.operators.grouping import is_small
from quillrank.session import materialise, new_work_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document."""
    return sharding.assign(_table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written as Simple-8b blocks and read back from the files."""
    path = new_work_path(spark, "token-files")
    token_files.write_tokens(_table(spark, sf_dir, "documents"), path)
    return token_files.read_documents(spark, path, digest_only=True).withColumnRenamed("key", "doc_id")


def op3_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text less the line chunks that an earlier document holds."""
    rows = line_chunks.remove_repeated_chunks(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "text", "n_lines", "n_removed")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group and number of links of every document."""
    found = ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(F.col("key").alias("doc_id"), "class_id", "n_links")


def op5_html_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_tree.extract_pages(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with each benchmark item that one of its passages holds."""
    return decontaminate.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def _fold(folds: int) -> Column:
    """Remainder of the key's CRC-32, by which rows are held out."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def op7_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by a model of those that are not held out."""
    documents = _table(spark, sf_dir, "documents")
    model = language_spans.fit(documents.where(F.coalesce(_fold(5), F.lit(1)) != 0).select("text", "lang"))
    kept = documents.select("doc_id", F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"), "text")
    return language_spans.identify(kept, model)


def op8_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements, failure bits and the current policy's verdict for every document."""
    return quality_ledger.verdicts(quality_ledger.ledger(_table(spark, sf_dir, "documents")))


def op9_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a field fitted on labels that are not held out."""
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    usable = labels.where((_fold(3) != 1) & F.col("toxic").isNotNull()).select("doc_id", "toxic")
    usable = F.broadcast(usable) if is_small(usable) else usable
    field = toxic_spans.fit(documents.select("doc_id", "text").join(usable, "doc_id"))
    kept = documents.select("doc_id", F.coalesce(_fold(3) == 1, F.lit(False)).alias("held_out"), "text")
    return toxic_spans.score_texts(kept, field).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "spans"
    )


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document and their decoding, as digests."""
    return byte_bpe.token_digests(_table(spark, sf_dir, "documents"), "doc_id", "text")


def op11_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth id, by greedy search in a neighbour graph of all vectors."""
    vectors = _table(spark, sf_dir, "embeddings")
    return nn_descent.search(nn_descent.build(vectors), vectors.where(F.col("vec_id") % 100 == 0), top_k=10)


def op12_heap_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after five rounds of exact k-means, with distances and centroid digests."""
    vectors = heap_clusters.whole_vectors(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    assigned, heaps = heap_clusters.cluster(materialise(vectors, "whole-vectors"))
    found = heap_clusters.with_inertia(assigned, heaps)
    return found.withColumn("vec_id", F.col("vec_id").cast("long"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and whether what it claims folds to the root."""
    found = merkle_manifest.document_proofs(_table(spark, sf_dir, "documents"), _fold(7) == 0)
    return found.withColumnRenamed("key", "doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_extendible_shards": op1_extendible_shards,
        "op2_token_files": op2_token_files,
        "op3_line_chunks": op3_line_chunks,
        "op4_ngram_join": op4_ngram_join,
        "op5_html_tree": op5_html_tree,
        "op6_decontaminate": op6_decontaminate,
        "op7_language_spans": op7_language_spans,
        "op8_quality_ledger": op8_quality_ledger,
        "op9_toxic_spans": op9_toxic_spans,
        "op10_byte_bpe": op10_byte_bpe,
        "op11_nn_descent": op11_nn_descent,
        "op12_heap_clusters": op12_heap_clusters,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


def _quality_sql() -> str:
    white = r"[ \t\n\x0b\f\r]"
    failed = " + ".join(
        f"CASE WHEN {condition} THEN {quality_ledger.bit(rule)} ELSE 0 END"
        for rule, condition in quality_ledger.RULES.items()
    )
    base = quality_ledger.mask(quality_ledger.BASE)
    counted = quality_ledger.mask(quality_ledger.POLICIES[quality_ledger.CURRENT]) | base
    return rf"""
    WITH base AS (
      SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
        list_filter(string_split_regex(coalesce(text, ''), '{white}+'), lambda x: x <> '') AS ws,
        list_filter(string_split(coalesce(text, ''), chr(10)),
          lambda x: NOT regexp_full_match(x, '{white}*')) AS ls
      FROM documents),
    places AS (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM base WHERE len(ws) >= 3),
    windows AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM places),
    again AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows),
    covered AS (
      SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again WHERE n > 1)
      GROUP BY r),
    measured AS (
      SELECT doc_id, len(ws)::BIGINT AS n_words,
        coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(t, '[^{quality_ledger.SYMBOLS}]+', '', 'g'))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        coalesce(n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines,
        len(regexp_extract_all(t, '\p{{Lu}}{{3,}}'))::BIGINT AS n_shouts,
        len(list_filter(range(1, len(ws)), lambda i: ws[i] = ws[i + 1]))::BIGINT AS n_runs
      FROM base LEFT JOIN covered USING (r)),
    judged AS (SELECT *, ({failed})::BIGINT AS failed FROM measured)
    SELECT *, failed & {base} <> 0 AS base_failed, failed & {counted} = 0 AS kept FROM judged
    """


def line_chunk_ctes(source: str) -> str:
    """``line_kept``: the rows of ``source`` with the new text. Chunks are compared as whole strings."""
    n, bits, roll = line_chunks.MIN_WORDS, line_chunks.BOUNDARY_BITS, line_chunks.ROLL
    return rf"""
    line_docs AS (SELECT DISTINCT doc_id AS d, text AS t FROM {source} WHERE text IS NOT NULL),
    line_split AS (SELECT d, t, string_split(t, chr(10)) AS ls FROM line_docs),
    line_rows AS (SELECT d, t, ls, unnest(range(len(ls))) AS p FROM line_split),
    line_words AS (
      SELECT d, t, p, ls[p + 1] AS line,
        len(list_filter(string_split_regex(ls[p + 1], '[ 	
]+'), lambda x: x <> '')) AS w
      FROM line_rows),
    line_sums AS (
      SELECT *, sum(w) OVER own AS upto, row_number() OVER own AS k, lead(p) OVER own IS NULL AS at_end,
        ('0x' || substr(md5(line), 1, 8))::BIGINT AS mark
      FROM line_words WHERE w > 0 WINDOW own AS (PARTITION BY d, t ORDER BY p)),
    line_marks AS (
      SELECT *, at_end OR ((({roll} * lag(mark, 1, 0) OVER own + mark) & 4294967295) >> 16) & {(1 << bits) - 1} = 0 AS edge
      FROM line_sums WINDOW own AS (PARTITION BY d, t ORDER BY p)),
    line_edges AS (
      SELECT *, lag(edge, 1, true) OVER (PARTITION BY d, t ORDER BY p) AS opens FROM line_marks),
    line_ends AS (
      SELECT 1 AS level, a.d, a.t, a.p AS first, min(b.k) AS last_k, a.k AS first_k
      FROM line_edges a JOIN line_edges b ON a.d = b.d AND a.t = b.t AND b.k > a.k AND b.upto - a.upto + a.w >= {n}
      WHERE a.opens AND b.edge GROUP BY ALL
      UNION ALL
      SELECT 2, a.d, a.t, a.p, min(b.k), a.k
      FROM line_sums a JOIN line_sums b ON a.d = b.d AND a.t = b.t AND b.k >= a.k AND b.upto - a.upto + a.w >= {n}
      GROUP BY ALL),
    line_chunks AS (
      SELECT e.level, e.d, e.t, e.first, max(s.p) AS last, string_agg(s.line, chr(10) ORDER BY s.p) AS chunk
      FROM line_ends e JOIN line_sums s ON s.d = e.d AND s.t = e.t AND s.k BETWEEN e.first_k AND e.last_k
      GROUP BY ALL),
    line_again AS (
      SELECT *, row_number() OVER (PARTITION BY level, chunk ORDER BY d, first) AS n FROM line_chunks),
    line_gone AS (SELECT DISTINCT d, t, unnest(range(first, last + 1)) AS p FROM line_again WHERE n > 1),
    line_left AS (
      SELECT r.d, r.t, count(*) AS n_lines, count(g.p) AS n_removed,
        string_agg(r.ls[r.p + 1], chr(10) ORDER BY r.p) FILTER (WHERE g.p IS NULL) AS kept
      FROM line_rows r LEFT JOIN line_gone g ON g.d = r.d AND g.t = r.t AND g.p = r.p GROUP BY ALL),
    line_kept AS (
      SELECT o.* REPLACE (CASE WHEN n_removed > 0 AND NOT regexp_matches(coalesce(kept, ''), '[^ 	-
]') THEN ''
          WHEN n_removed > 0 THEN kept ELSE o.text END AS text),
        coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed
      FROM {source} o LEFT JOIN line_left k ON o.doc_id = k.d AND o.text = k.t)"""


def _line_sql() -> str:
    return f"WITH {line_chunk_ctes('documents')} SELECT doc_id, text, n_lines, n_removed FROM line_kept"


def _shard_sql() -> str:
    """All depths are tried for every row; copies beyond the limit are numbered by key."""
    bits, limit = sharding.BITS, sharding.SHARD_BYTES
    return f"""
    WITH hashed AS (
      SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS n_bytes,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || '|' || md5(coalesce(text, ''))), 1, {bits // 4}))::BIGINT AS hash
      FROM documents),
    levels AS (SELECT *, unnest(range({bits + 1})) AS depth FROM hashed),
    tried AS (
      SELECT *, sum(n_bytes) OVER b AS bytes, min(hash) OVER b AS low, max(hash) OVER b AS high
      FROM levels WINDOW b AS (PARTITION BY depth, hash >> ({bits} - depth))),
    fit AS (
      SELECT * FROM tried WHERE bytes <= {limit} OR low = high
      QUALIFY row_number() OVER (PARTITION BY doc_id, hash ORDER BY depth) = 1)
    SELECT doc_id, hash, n_bytes, depth::INTEGER AS depth,
      CASE WHEN depth = 0 THEN '' ELSE lpad(bin(hash >> ({bits} - depth)), depth::INTEGER, '0') END AS bits, 0::BIGINT AS part
    FROM fit
    """


def _join_sql() -> str:
    """Exact: every pair that shares an n-gram is counted."""
    n, threshold = ngram_join.N, ngram_join.THRESHOLD
    return rf"""
    WITH RECURSIVE worded AS (
      SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}_]+') AS ws FROM documents),
    grams AS (
      SELECT DISTINCT doc_id, array_to_string(ws[i : i + {n} - 1], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws) - {n} + 2))) AS i FROM worded WHERE len(ws) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
    shared AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM grams a JOIN grams b USING (g)
      WHERE a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (
      SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
      WHERE s.n >= {threshold} * (x.n + y.n - s.n) - 1e-9),
    reach AS (SELECT doc_id AS d, doc_id AS r FROM documents UNION SELECT reach.d, links.b FROM reach JOIN links ON links.a = reach.r)
    SELECT d AS doc_id, min(r) AS class_id, (SELECT count(*) FROM links WHERE a = d) AS n_links FROM reach GROUP BY d
    """


def _cluster_sql() -> str:
    """Every round compares every vector with every centroid."""
    k, size, scale = heap_clusters.CLUSTERS, heap_clusters.DIMENSIONS, heap_clusters.SCALE
    ctes = [f"""
    whole AS (
      SELECT row_number() OVER () AS r, vec_id,
        list_transform(embedding, lambda c: floor(c::DOUBLE * {scale})::BIGINT) AS x
      FROM embeddings
      WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda c: isfinite(c))) = {size}),
    c0 AS (
      SELECT (row_number() OVER (ORDER BY h, x) - 1)::INTEGER AS j, x AS c
      FROM (SELECT x, sha256('{heap_clusters.SEED}:' || coalesce(vec_id::VARCHAR, 'null')) AS h FROM whole)
      ORDER BY h, x LIMIT {k})"""]
    for step in range(heap_clusters.ROUNDS + 1):
        ctes.append(f"""
    d{step} AS (
      SELECT r, j, list_sum(list_transform(range(1, {size + 1}), lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT AS d
      FROM whole, c{step}),
    a{step} AS (SELECT r, j, d FROM d{step} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, j) = 1)""")
        if step < heap_clusters.ROUNDS:
            ctes.append(f"""
    s{step} AS (
      SELECT j, i, sum(v) AS s, count(*) AS n
      FROM (SELECT j, unnest(x) AS v, unnest(range(1, {size + 1})) AS i FROM a{step} JOIN whole USING (r)) GROUP BY ALL),
    m{step} AS (SELECT j, list((s // n - CASE WHEN s % n < 0 THEN 1 ELSE 0 END)::BIGINT ORDER BY i) AS c FROM s{step} GROUP BY j),
    c{step + 1} AS (SELECT c{step}.j, coalesce(m{step}.c, c{step}.c) AS c FROM c{step} LEFT JOIN m{step} USING (j))""")
    last = heap_clusters.ROUNDS
    return f"""
    WITH {",".join(ctes)}
    SELECT vec_id, j AS cluster, d AS distance, (sum(d) OVER (PARTITION BY j))::BIGINT AS cluster_inertia,
      (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
    FROM a{last} JOIN whole USING (r) JOIN c{last} USING (j)
    """


def _merkle_sql() -> str:
    """Levels by recursion; the CRC-32 that marks claimed rows from its table of 256 remainders."""

    def leaf(n_chars: str) -> str:
        values = ["doc_id::VARCHAR", "source", "lang", n_chars, "text"]
        parts = [f"coalesce(strlen({v})::VARCHAR || ':' || {v}, '-')" for v in values]
        return f"sha256({' || '.join(parts)})"

    steps, crc = [], "n"
    for step in range(8):
        steps.append(f"b{step} AS (SELECT i, xor({crc} >> 1, 3988292384 * ({crc} & 1)) AS n FROM {f'b{step - 1}' if step else 'seed'})")
    return f"""
    WITH RECURSIVE seed AS (SELECT i, i AS n FROM (SELECT unnest(range(256)) AS i)),
    {", ".join(steps)},
    remainders AS (SELECT list(n ORDER BY i) AS t FROM b7),
    coded AS (
      SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '') AS g, {leaf("n_chars::VARCHAR")} AS leaf,
        {leaf("(n_chars::HUGEINT + 1)::VARCHAR")} AS claim, n_chars,
        xor(list_reduce(
          list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
          lambda crc, c: xor(crc >> 8, t[(xor(crc, c) & 255) + 1])), 4294967295) AS crc
      FROM documents, remainders),
    leaves AS (
      SELECT r, doc_id, g, leaf, CASE WHEN crc % 7 = 0 AND n_chars IS NOT NULL THEN claim ELSE leaf END AS claimed,
        row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n
      FROM coded),
    tree AS (
      SELECT g, 0 AS level, pos, n, leaf AS h FROM leaves
      UNION ALL
      SELECT g, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
      FROM tree WHERE n > 1 GROUP BY g, level, pos // 2, n),
    subroots AS (
      SELECT g, h AS subroot, level AS height, row_number() OVER (ORDER BY g) - 1 AS place, count(*) OVER () AS groups
      FROM tree WHERE n = 1),
    crown AS (
      SELECT 0 AS level, place AS pos, groups AS n, subroot AS h FROM subroots
      UNION ALL
      SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
      FROM crown WHERE n > 1 GROUP BY level, pos // 2, n),
    top AS (SELECT h AS root, level AS rise FROM crown WHERE n = 1),
    ways AS (
      SELECT r, g, claimed, pos, place, height, rise, 0 AS level, claimed AS folded, '' AS proof
      FROM leaves JOIN subroots USING (g), top
      UNION ALL
      SELECT r, w.g, claimed, w.pos, place, height, rise, w.level + 1,
        sha256(CASE WHEN spot % 2 = 1 THEN s || folded ELSE folded || s END), proof || s
      FROM (
        SELECT w.*, CASE WHEN w.level < height THEN w.pos >> w.level ELSE place >> (w.level - height) END AS spot,
          coalesce(t.h, c.h, '') AS s
        FROM ways w
        LEFT JOIN tree t ON w.level < height AND t.g = w.g AND t.level = w.level AND t.pos = xor(w.pos >> w.level, 1)
        LEFT JOIN crown c ON w.level >= height AND c.level = w.level - height AND c.pos = xor(place >> (w.level - height), 1)
        WHERE w.level < height + rise) w)
    SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
    FROM ways JOIN leaves USING (r) JOIN subroots ON subroots.g = leaves.g, top WHERE ways.level = ways.height + ways.rise
    """


def oracle_sql() -> dict[str, str]:
    return {
        "op1_extendible_shards": _shard_sql(),
        "op3_line_chunks": _line_sql(),
        "op4_ngram_join": _join_sql(),
        "op8_quality_ledger": _quality_sql(),
        "op12_heap_clusters": _cluster_sql(),
        "op13_merkle_manifest": _merkle_sql(),
    }
