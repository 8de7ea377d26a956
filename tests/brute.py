"""Plain-Python answers for small inputs, to compare the Spark plans with."""

import math
import re


def words(text):
    kept = re.sub(r"[^a-z0-9\s]", "", (text or "").lower())
    return kept.split()


def bm25(query, documents):
    """Okapi scores of one query for a list of texts."""
    docs = [words(text) for text in documents]
    n = len(docs)
    average = sum(map(len, docs)) / n if n else 0
    frequency = {}
    for doc in docs:
        for token in set(doc):
            frequency[token] = frequency.get(token, 0) + 1
    idf = {t: math.log(n - df + 0.5) - math.log(df + 0.5) for t, df in frequency.items()}
    floor = 0.25 * sum(idf.values()) / len(idf) if idf else 0
    idf = {t: floor if value < 0 else value for t, value in idf.items()}
    scores = []
    for doc in docs:
        total = 0.0
        for token in words(query):
            tf = doc.count(token)
            if tf:
                total += idf[token] * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(doc) / average))
        scores.append(round(total, 6) + 0.0)
    return scores


def top(scores, ids, k):
    order = sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))
    return [(ids[i], scores[i]) for i in order[:k]]


def dcg(grades, k):
    return sum((2**grade - 1) / math.log2(place + 2) for place, grade in enumerate(grades[:k]))


def ranking_metrics(rows, k):
    """(ndcg, rr, ap) of (score, doc_id, relevance) rows of one query."""
    grades = [grade for _, _, grade in sorted(rows, key=lambda r: (-round(r[0], 6), r[1]))]
    ideal = dcg(sorted(grades, reverse=True), k)
    hits = [place + 1 for place, grade in enumerate(grades) if grade >= 1]
    ap = sum((i + 1) / place for i, place in enumerate(hits)) / len(hits) if hits else 0.0
    return (dcg(grades, k) / ideal if ideal else 0.0, 1 / hits[0] if hits else 0.0, ap)


def tfidf_cosines(pairs):
    """Cosine per (query, document) pair, fitted on the pairs themselves."""
    texts = [q for q, _ in pairs] + [d for _, d in pairs]
    bags = [[w for w in words(text) if len(w) >= 2] for text in texts]
    frequency = {}
    for bag in bags:
        for token in set(bag):
            frequency[token] = frequency.get(token, 0) + 1
    idf = {t: math.log((1 + len(bags)) / (1 + df)) + 1 for t, df in frequency.items()}

    def vector(bag):
        return {t: bag.count(t) * idf[t] for t in set(bag)}

    def cosine(a, b):
        norms = math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
        return sum(v * b.get(t, 0.0) for t, v in a.items()) / norms if norms else 0.0

    half = len(pairs)
    return [cosine(vector(bags[i]), vector(bags[half + i])) for i in range(half)]
