"""The registered queries once more, as plain DuckDB SQL over whole tables.

Written for clarity, not speed: retrieval here scores every query against every document.
"""

from __future__ import annotations

# Fixed value: Unicode whitespace as the body of a regex character class.
WS = (
    r" \t-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

TOP_K = 10
DEEP_K = 20
CAPPED_ROWS = 150
# Weights of the fixed scorer that both sides of the re-ranking queries use.
LINEAR = {"overlap_ratio": 4.0, "exact_match": 2.0, "bm25_score": 0.05, "doc_len": -0.01}


def clean(column: str) -> str:
    kept = f"regexp_replace(lower(coalesce({column}, '')), '[^a-z0-9{WS}]', '', 'g')"
    return f"trim(regexp_replace({kept}, '[{WS}]+', ' ', 'g'))"


def words(column: str) -> str:
    return f"list_filter(string_split({column}, ' '), lambda w: w <> '')"


def hash_number(text: str) -> str:
    return f"(('0x' || substr(md5({text}), 1, 15))::BIGINT)"


def corpus_ctes(docs: str, queries: str) -> dict[str, str]:
    return {
        "corpus": f"SELECT doc_id, document, category, {clean('document')} AS doc_clean FROM ({docs})",
        "asked": f"SELECT query_id, query, {clean('query')} AS query_clean FROM ({queries})",
        "doc_words": f"SELECT doc_id, {words('doc_clean')} AS ws FROM corpus",
        "postings": """SELECT doc_id, doc_len, token, count(*) AS tf
            FROM (SELECT doc_id, len(ws) AS doc_len, unnest(ws) AS token FROM doc_words)
            GROUP BY doc_id, doc_len, token""",
        "stats": "SELECT count(*) AS n, avg(len(ws)) AS avg_len FROM doc_words",
        "raw_terms": """SELECT token, df, ln(n - df + 0.5) - ln(df + 0.5) AS raw
            FROM (SELECT token, count(*) AS df FROM postings GROUP BY token), stats""",
        "terms": """SELECT token, df, CASE WHEN raw < 0
              THEN (SELECT 0.25 * avg(raw) FROM raw_terms) ELSE raw END AS idf FROM raw_terms""",
        "asked_terms": f"""SELECT query_id, token, count(*) AS qf
            FROM (SELECT query_id, unnest({words('query_clean')}) AS token FROM asked)
            GROUP BY query_id, token""",
        "matched": """SELECT query_id, doc_id,
              sum(qf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * doc_len / avg_len))) AS score
            FROM asked_terms JOIN terms USING (token) JOIN postings USING (token), stats
            GROUP BY query_id, doc_id""",
        "all_ranks": """SELECT query_id, query, query_clean, doc_id, document, category, doc_clean,
              round(coalesce(score, 0.0), 6) AS bm25_score,
              row_number() OVER (PARTITION BY query_id
                ORDER BY round(coalesce(score, 0.0), 6) DESC, doc_id)::INTEGER AS rank
            FROM asked CROSS JOIN corpus LEFT JOIN matched USING (query_id, doc_id)""",
    }


DOCS = "SELECT doc_id, text AS document, source AS category FROM documents"
ASKED = "SELECT item_id AS query_id, text AS query FROM benchmark"
PARTS = "SELECT p_partkey AS doc_id, p_name AS document, p_type AS category FROM part"
PART_NAMES = "SELECT min(p_partkey) AS query_id, p_name AS query FROM part GROUP BY p_name"

TEXT = corpus_ctes(DOCS, ASKED)

JUDGED = TEXT | {
    "pairs": f"""SELECT * REPLACE (CASE WHEN rank <= {TOP_K} THEN rank ELSE {TOP_K} + row_number()
            OVER (PARTITION BY query_id, rank <= {TOP_K} ORDER BY doc_id) END AS rank),
          {words('query_clean')} AS qw, {words('doc_clean')} AS dw
        FROM all_ranks WHERE rank <= {TOP_K} OR contains(doc_clean, query_clean)""",
    "shared": """SELECT *, len(qw) AS query_len, len(dw) AS doc_len,
          len(list_distinct(list_intersect(qw, dw))) AS overlap_count,
          contains(doc_clean, query_clean)::INTEGER AS exact_match FROM pairs""",
    "j": """SELECT *, round(overlap_count / greatest(query_len, 1), 6) AS overlap_ratio,
          CASE WHEN exact_match = 1 THEN 3
               WHEN overlap_count / greatest(query_len, 1) >= 0.5 THEN 1 ELSE 0 END AS relevance
        FROM shared""",
}

GROUPED = JUDGED | {
    "g_sizes": "SELECT query_id, count(*) AS gn, avg(doc_len) AS g_avg FROM j GROUP BY query_id",
    "g_raw": """SELECT query_id, token, ln(gn - df + 0.5) - ln(df + 0.5) AS raw
        FROM (SELECT query_id, token, count(*) AS df
              FROM (SELECT query_id, unnest(list_distinct(dw)) AS token FROM j)
              GROUP BY query_id, token) JOIN g_sizes USING (query_id)""",
    "g_terms": """SELECT query_id, token, CASE WHEN raw < 0
          THEN 0.25 * avg(raw) OVER (PARTITION BY query_id) ELSE raw END AS idf FROM g_raw""",
    "g_tf": """SELECT query_id, doc_id, doc_len, token, count(*) AS tf
        FROM (SELECT query_id, doc_id, doc_len, unnest(dw) AS token FROM j)
        GROUP BY query_id, doc_id, doc_len, token""",
    "g_scores": """SELECT query_id, doc_id, sum(qf * idf * tf * 2.5
            / (tf + 1.5 * (0.25 + 0.75 * doc_len / g_avg))) AS score
        FROM asked_terms JOIN g_terms USING (query_id, token) JOIN g_tf USING (query_id, token)
          JOIN g_sizes USING (query_id) GROUP BY query_id, doc_id""",
    "scored": """SELECT j.* EXCLUDE (bm25_score), round(coalesce(score, 0.0), 6) AS bm25_score
        FROM j LEFT JOIN g_scores USING (query_id, doc_id)""",
}

VECTORS = {
    "v_terms": """SELECT token, count(*) AS df,
          ln((1 + 2 * (SELECT count(*) FROM j)) / (1 + count(*))) + 1 AS idf
        FROM (SELECT unnest(list_distinct(list_filter(qw, lambda w: len(w) >= 2))) AS token FROM j
              UNION ALL
              SELECT unnest(list_distinct(list_filter(dw, lambda w: len(w) >= 2))) FROM j)
        GROUP BY token""",
    "v_query": """SELECT query_id, token, count(*) * any_value(idf) AS weight
        FROM (SELECT query_id, unnest(any_value(qw)) AS token FROM j GROUP BY query_id)
          JOIN v_terms USING (token) GROUP BY query_id, token""",
    "v_doc": """SELECT doc_id, token, count(*) * any_value(idf) AS weight
        FROM (SELECT doc_id, unnest(any_value(dw)) AS token FROM j GROUP BY doc_id)
          JOIN v_terms USING (token) GROUP BY doc_id, token""",
    "v_dots": """SELECT query_id, doc_id, sum(q.weight * d.weight) AS product
        FROM j JOIN v_query q USING (query_id) JOIN v_doc d USING (doc_id, token)
        GROUP BY query_id, doc_id""",
    "v_cosines": """SELECT query_id, doc_id, round(coalesce(product / nullif(
            sqrt((SELECT sum(weight * weight) FROM v_query v WHERE v.query_id = j.query_id))
            * sqrt((SELECT sum(weight * weight) FROM v_doc v WHERE v.doc_id = j.doc_id)), 0), 0.0), 6)
          AS tfidf_cosine_sim
        FROM j LEFT JOIN v_dots USING (query_id, doc_id)""",
}



def embedded(texts: str) -> dict[str, str]:
    """``e_unit(t, b, x)``: the non-zero coordinates of each distinct cleaned text of ``texts(t)``."""
    bucket = hash_number("p") + " % 256"
    return {
        "e_words": f"SELECT DISTINCT t, {words('t')} AS ws FROM ({texts})",
        "e_pieces": """SELECT t, unnest(list_concat(ws, list_transform(ws, lambda w: '5:' || substr(w, 1, 5)),
            list_transform(ws, lambda w: '4:' || substr(w, 1, 4)))) AS p FROM e_words""",
        "e_counts": f"SELECT t, {bucket} AS b, count(*) AS n FROM e_pieces GROUP BY ALL",
        "e_unit": "SELECT t, b, n / sqrt(sum(n * n) OVER (PARTITION BY t)) AS x FROM e_counts",
    }


SIMILAR = embedded("SELECT query_clean AS t FROM j UNION ALL SELECT doc_clean FROM j") | {
    "likeness": """SELECT j.query_id, j.doc_id, round(coalesce(sum(a.x * b.x), 0.0), 6) AS semantic_cosine_sim
        FROM j LEFT JOIN e_unit a ON a.t = query_clean LEFT JOIN e_unit b ON b.t = doc_clean AND b.b = a.b
        GROUP BY ALL""",
}

RANKED = GROUPED | {
    "r": """SELECT *, row_number() OVER w AS score_rank,
          (sum((relevance >= 1)::INTEGER) OVER w)::BIGINT AS hits,
          row_number() OVER (PARTITION BY query_id ORDER BY relevance DESC, doc_id) AS ideal_rank
        FROM scored
        WINDOW w AS (PARTITION BY query_id ORDER BY bm25_score DESC, doc_id
                     ROWS UNBOUNDED PRECEDING)""",
    "per_query": """SELECT query_id,
          round(coalesce(sum(CASE WHEN score_rank <= 5 THEN (2 ** relevance - 1) / log2(score_rank + 1) END)
            / nullif(sum(CASE WHEN ideal_rank <= 5 THEN (2 ** relevance - 1) / log2(ideal_rank + 1) END), 0),
            0.0), 6) AS ndcg,
          round(coalesce(1.0::DOUBLE / min(CASE WHEN relevance >= 1 THEN score_rank END), 0.0), 6) AS rr,
          round(coalesce(sum(CASE WHEN relevance >= 1 THEN hits / score_rank END)
            / nullif(sum((relevance >= 1)::INTEGER), 0), 0.0), 6) AS ap
        FROM r GROUP BY query_id""",
}

PULLS = GROUPED | {
    "places": """SELECT query_id, doc_id, bm25_score AS s, 2 ** relevance - 1 AS gain,
          row_number() OVER (PARTITION BY query_id ORDER BY bm25_score DESC, doc_id) AS rk,
          row_number() OVER (PARTITION BY query_id ORDER BY relevance DESC) AS ideal_rk FROM scored""",
    "ideals": """SELECT query_id, sum(gain / log2(ideal_rk + 1)) AS ideal FROM places WHERE ideal_rk <= 30
        GROUP BY query_id""",
    "valued": """SELECT *, CASE WHEN rk <= 30 THEN 1 / log2(rk + 1) ELSE 0 END AS d FROM places""",
    "met": """SELECT a.query_id, a.doc_id, CASE WHEN a.gain > b.gain THEN 1 ELSE -1 END AS way,
          abs(a.gain - b.gain) * abs(a.d - b.d) / ideal AS change, a.s - b.s AS ahead
        FROM valued a JOIN valued b ON a.query_id = b.query_id AND a.gain <> b.gain AND (a.rk <= 30 OR b.rk <= 30)
          JOIN ideals ON ideals.query_id = a.query_id""",
    "pulled": "SELECT *, 1 / (1 + exp(way * ahead)) AS doubt FROM met",
    "pulls": """SELECT query_id, doc_id, round(sum(way * doubt * change), 6) AS gradient,
          round(sum(doubt * (1 - doubt) * change), 6) AS curvature FROM pulled GROUP BY query_id, doc_id""",
}

def linear() -> str:
    exact = {"overlap_ratio": "(overlap_count / greatest(query_len, 1))"}  # before it is rounded
    terms = [f"{weight}::DOUBLE * {exact.get(name, name)}" for name, weight in LINEAR.items()]
    return f"round({' + '.join(terms)}, 6)"


RERANKED = JUDGED | {
    "rescored": f"SELECT query_id, doc_id, bm25_score, {linear()} AS model_score FROM j WHERE rank <= {TOP_K}",
}

# A record lists its documents in the order of the candidates; BM25 is that of the record's own list.
LISTED = GROUPED | {
    "listed": f"""SELECT query_id, document, rank AS place, {linear()} AS model_score FROM scored""",
}

LABELLED = JUDGED | {
    "labels3": "SELECT query_id, query, doc_id, document, relevance FROM j WHERE relevance > 0",
    "hard": f"""SELECT query_id, doc_id FROM (
          SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS place
          FROM all_ranks WHERE rank <= {DEEP_K}
            AND (query_id, doc_id) NOT IN (SELECT (query_id, doc_id) FROM labels3))
        WHERE place <= 3""",
    "used": "SELECT query_id, doc_id FROM labels3 UNION SELECT query_id, doc_id FROM hard",
    "places": """SELECT doc_id, row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) - 1 AS place
        FROM corpus""",
    "walks": f"""SELECT query_id, step, ({hash_number("'42|' || query_id")} % n + step) % n AS place
        FROM (SELECT query_id, n, unnest(range(least(n_used + 2, n))) AS step
              FROM (SELECT asked.query_id, count(used.doc_id) AS n_used
                    FROM asked LEFT JOIN used USING (query_id) GROUP BY asked.query_id), stats)""",
    "random": """SELECT query_id, doc_id FROM (
          SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY step) AS nth
          FROM walks JOIN places USING (place)
          WHERE (query_id, doc_id) NOT IN (SELECT (query_id, doc_id) FROM used))
        WHERE nth <= 2""",
}

SPLIT = {
    "split_places": """SELECT query_id, row_number() OVER (ORDER BY md5('42|' || query_id)) AS place,
          count(*) OVER () AS n FROM (SELECT DISTINCT query_id FROM j)""",
}

NESTED_NEGATIVES = """SELECT query_id, query, document, relevance FROM (
      SELECT query_id, query, document, 3 AS relevance FROM j WHERE relevance = 3
      UNION ALL
      SELECT query_id, query, document, 0 FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS nth
        FROM j WHERE relevance <> 3) WHERE nth <= 4)
    WHERE query_id IN (SELECT query_id FROM j WHERE relevance = 3)"""


def sql(ctes: dict[str, str], select: str) -> str:
    body = ",\n".join(f"{name} AS ({text})" for name, text in ctes.items())
    return f"WITH {body}\n{select}"


def top_k(ctes: dict[str, str]) -> str:
    return sql(
        ctes,
        "SELECT query_id, query, rank, doc_id, document, category, bm25_score "
        f"FROM all_ranks WHERE rank <= {TOP_K}",
    )


def found(ctes: dict[str, str]) -> str:
    columns = "query_id, query, doc_id, document, category, bm25_score"
    return sql(ctes, f"SELECT {columns} FROM all_ranks WHERE rank <= {TOP_K}")


def named_features(separator: str) -> str:
    """The four nested feature sets of the ablation, as SQL values."""
    lexical = ["query_len", "doc_len", "overlap_count", "overlap_ratio", "exact_match"]
    scores = ["bm25_score", "tfidf_cosine_sim", "overlap_count", "overlap_ratio"]
    sets = {
        "bm25_only": scores[:1],
        "bm25_tfidf": scores[:2],
        "bm25_tfidf_overlap": scores,
        "hybrid_full": [*lexical, "tfidf_cosine_sim", "bm25_score", "semantic_cosine_sim"],
    }
    return ", ".join(f"('{name}', '{separator.join(features)}')" for name, features in sets.items())


def statements() -> dict[str, str]:
    judgements = sql(JUDGED, NESTED_NEGATIVES)
    return {
        "scan_csv": """SELECT p_type, count(*) AS n, sum(p_size)::BIGINT AS sizes,
            min(p_name) AS first_name, max(p_brand) AS last_brand FROM part GROUP BY p_type""",
        "scan_capped": sql(
            JUDGED,
            f"""SELECT query_id, query, document, relevance FROM j WHERE query_id IN (
                  SELECT query_id FROM (
                    SELECT query_id, sum(n) OVER (ORDER BY md5('42|' || query_id)) AS total
                    FROM (SELECT query_id, count(*) AS n FROM j GROUP BY query_id))
                  WHERE total <= {CAPPED_ROWS})""",
        ),
        "dataset_metadata": sql(
            JUDGED,
            f"""SELECT count(*) AS rows_written, count(DISTINCT query_id) AS queries_seen,
                4 AS max_negatives_per_query FROM ({NESTED_NEGATIVES})""",
        ),
        "search_json": sql(
            TEXT,
            f"""SELECT query_id, to_json({{'query': query, 'results':
                  list({{'rank': rank, 'doc_id': doc_id}} ORDER BY rank)}})::VARCHAR AS response
                FROM all_ranks WHERE rank <= {TOP_K} GROUP BY query_id, query""",
        ),
        "clean_text": f"SELECT doc_id, {clean('text')} AS text_clean FROM documents",
        "tokenize": f"""SELECT doc_id, (generate_subscripts(ws, 1) - 1)::INTEGER AS place, unnest(ws) AS token
            FROM (SELECT doc_id, {words(clean('text'))} AS ws FROM documents)""",
        "feature_lengths": sql(JUDGED, "SELECT query_id, doc_id, query_len, doc_len FROM j"),
        "feature_overlap": sql(JUDGED, "SELECT query_id, doc_id, overlap_count, overlap_ratio FROM j"),
        "feature_exact_match": sql(JUDGED, "SELECT query_id, doc_id, exact_match FROM j"),
        "bm25_index": sql(TEXT, "SELECT doc_id, doc_len, token, tf FROM postings"),
        "bm25_terms": sql(TEXT, "SELECT token, df, round(idf, 6) AS idf FROM terms"),
        "bm25_topk": top_k(TEXT),
        "bm25_topk_catalog": top_k(corpus_ctes(PARTS, PART_NAMES)),
        "bm25_group": sql(GROUPED, "SELECT query_id, doc_id, bm25_score FROM scored"),
        "tfidf_terms": sql(JUDGED | VECTORS, "SELECT token, df, round(idf, 6) AS idf FROM v_terms"),
        "tfidf_cosine": sql(JUDGED | VECTORS, "SELECT query_id, doc_id, tfidf_cosine_sim FROM v_cosines"),
        "semantic_cosine": sql(
            JUDGED,
            """SELECT query_id, doc_id, round(coalesce(
                  list_inner_product(q.embedding::DOUBLE[], d.embedding::DOUBLE[])
                  / (sqrt(list_inner_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[]))
                     * sqrt(list_inner_product(d.embedding::DOUBLE[], d.embedding::DOUBLE[]))), 0.0), 6)
                  AS semantic_cosine_sim
                FROM j LEFT JOIN embeddings q ON q.vec_id = query_id
                  LEFT JOIN embeddings d ON d.vec_id = doc_id""",
        ),
        "build_features": sql(
            GROUPED | VECTORS | SIMILAR,
            """SELECT query_id, doc_id, relevance, query_len, doc_len, overlap_count, overlap_ratio,
                  exact_match, tfidf_cosine_sim, bm25_score, semantic_cosine_sim
                FROM scored JOIN v_cosines USING (query_id, doc_id) JOIN likeness USING (query_id, doc_id)""",
        ),
        "text_similarity": sql(JUDGED | SIMILAR, "SELECT * FROM likeness"),
        "text_embed": sql(
            {"texts": f"SELECT doc_id, {clean('text')} AS t FROM documents"} | embedded("SELECT t FROM texts"),
            """SELECT doc_id, b::INTEGER AS dimension, round(x, 6) AS value FROM texts JOIN e_unit USING (t)""",
        ),
        "label_lookup": sql(LABELLED, "SELECT * FROM labels3"),
        "hard_negatives": sql(LABELLED, "SELECT * FROM hard"),
        "random_negatives": sql(LABELLED, "SELECT * FROM random"),
        "unused_docs": sql(
            LABELLED, "SELECT doc_id FROM corpus WHERE doc_id NOT IN (SELECT doc_id FROM used)"
        ),
        "training_set": sql(
            LABELLED,
            """SELECT query_id, query, doc_id, document, max(relevance) AS relevance FROM (
                  SELECT query_id, doc_id, relevance FROM labels3
                  UNION ALL SELECT query_id, doc_id, 0 FROM hard
                  UNION ALL SELECT query_id, doc_id, 0 FROM random)
                JOIN asked USING (query_id) JOIN corpus USING (doc_id)
                GROUP BY query_id, query, doc_id, document""",
        ),
        "dedup_max_relevance": sql(
            JUDGED,
            f"""SELECT query_id, doc_id, max(relevance) AS relevance FROM (
                  SELECT query_id, doc_id, relevance FROM j
                  UNION ALL SELECT query_id, doc_id, 0 FROM all_ranks WHERE rank <= {DEEP_K})
                GROUP BY query_id, doc_id""",
        ),
        "group_sizes": sql(JUDGED, "SELECT query_id, count(*) AS n FROM j GROUP BY query_id"),
        "label_distribution": sql(JUDGED, "SELECT relevance, count(*) AS n FROM j GROUP BY relevance"),
        "group_split": sql(
            JUDGED,
            """SELECT query_id, doc_id, relevance,
                  CASE WHEN place <= ceil(0.25 * n) THEN 'test' ELSE 'train' END AS side
                FROM j JOIN (SELECT query_id, row_number() OVER (ORDER BY md5('42|' || query_id)) AS place,
                               count(*) OVER () AS n FROM (SELECT DISTINCT query_id FROM j))
                  USING (query_id)""",
        ),
        "ranked_listing": sql(
            RANKED, "SELECT query_id, doc_id, relevance, bm25_score, score_rank AS rank, hits FROM r"
        ),
        "precision_curve": sql(
            RANKED,
            """SELECT query_id, doc_id, score_rank AS rank, hits,
                  round(hits / score_rank, 6) AS precision FROM r""",
        ),
        "eval_per_query": sql(RANKED, "SELECT * FROM per_query"),
        "eval_metrics": sql(
            RANKED,
            """SELECT round(avg(ndcg), 6) AS ndcg, round(avg(rr), 6) AS mrr, round(avg(ap), 6) AS map,
                  count(*) AS queries FROM per_query""",
        ),
        "ranker_gradients": sql(PULLS, "SELECT * FROM pulls WHERE curvature > 0"),
        "search_linear": sql(
            RERANKED,
            """SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY model_score DESC, doc_id) AS rank,
              doc_id, bm25_score, model_score FROM rescored""",
        ),
        "rank_documents_linear": sql(
            LISTED,
            """SELECT query_id, document, model_score,
              row_number() OVER (PARTITION BY query_id ORDER BY model_score DESC, place) AS rank FROM listed""",
        ),
        "failures": sql(
            RANKED,
            """SELECT p.query_id, p.query, p.document AS predicted_top_doc,
                  p.relevance AS predicted_top_rel, i.document AS ideal_top_doc, i.relevance AS ideal_top_rel
                FROM r p JOIN r i USING (query_id)
                WHERE p.score_rank = 1 AND i.ideal_rank = 1 AND p.document <> i.document""",
        ),
        "ndcg_at_ranks": sql(
            RANKED,
            """SELECT k, round(avg(ndcg), 6) AS ndcg FROM (
                  SELECT query_id, k, round(coalesce(
                    sum(CASE WHEN score_rank <= k THEN (2 ** relevance - 1) / log2(score_rank + 1) END)
                    / nullif(sum(CASE WHEN ideal_rank <= k THEN (2 ** relevance - 1) / log2(ideal_rank + 1) END), 0),
                    0.0), 6) AS ndcg
                  FROM r, (SELECT unnest([1, 3, 5, 10]) AS k) GROUP BY query_id, k) GROUP BY k""",
        ),
        "train_ranker": sql(
            GROUPED | SPLIT,
            """SELECT query_id, doc_id, relevance, bm25_score
                FROM scored JOIN split_places USING (query_id) WHERE place <= ceil(0.25 * n)""",
        ),
        "train_large": sql(
            JUDGED | SPLIT,
            """SELECT count(*) FILTER (WHERE place > ceil(0.2 * n)) AS rows_train,
                  count(*) FILTER (WHERE place <= ceil(0.2 * n)) AS rows_test
                FROM j JOIN split_places USING (query_id)""",
        ),
        "rerank": found(TEXT),
        "search": found(TEXT),
        "stream_search_two_stage": found(TEXT),
        "rank_record": sql(
            GROUPED,
            f"""SELECT query_id, query, document, bm25_score FROM (
                  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY bm25_score DESC, rank) AS place
                  FROM scored) WHERE place <= {TOP_K}""",
        ),
        "rank_documents": sql(JUDGED, "SELECT query_id, query, document FROM j"),
        "ablation": f"SELECT * FROM (VALUES {named_features(', ')}) AS v(experiment, features)",
        "experiment_log": f"""SELECT experiment_name, features,
            (length(features) - length(replace(features, ',', '')) + 1) || ' features' AS notes
            FROM (VALUES {named_features(',')}) AS v(experiment_name, features)""",
        "build_judgements": judgements,
        "stream_judgements": judgements,
        "stream_search": top_k(TEXT),
    }
