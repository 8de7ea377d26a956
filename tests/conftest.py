import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quillrank.session import build_session

# A small product catalog (doc_id, document, category).
CATALOG = [
    (1, "asus tuf gaming laptop with rtx graphics", "laptop"),
    (2, "acer nitro 5 gaming notebook", "laptop"),
    (3, "lenovo legion gaming laptop", "laptop"),
    (4, "hp office laptop for students", "laptop"),
    (5, "ergonomic office chair with lumbar support", "chair"),
    (6, "mesh back adjustable office chair", "chair"),
    (7, "executive leather office chair", "chair"),
    (8, "wooden dining chair set", "chair"),
    (9, "noise cancelling bluetooth earbuds", "audio"),
    (10, "true wireless sports earbuds", "audio"),
    (11, "wireless earbuds with long battery life", "audio"),
    (12, "wired over-ear headphones", "audio"),
    (13, "lightweight running shoes for men", "shoes"),
    (14, "trail running sneakers with extra grip", "shoes"),
    (15, "cushioned road running shoes", "shoes"),
    (16, "formal leather office shoes", "shoes"),
    (17, "wireless gaming mouse", "accessory"),
    (18, "mechanical gaming keyboard", "accessory"),
    (19, "usb c laptop charger", "accessory"),
    (20, "cotton socks pack", "accessory"),
]

# Graded documents of the three held-out queries, doc_id -> relevance.
HELD_OUT = {
    "ergonomic chair": {3: 0, 4: 0, 5: 3, 6: 3, 7: 1, 8: 0, 9: 0, 10: 0},
    "student laptop": {1: 1, 2: 1, 3: 0, 4: 3, 5: 0, 6: 0, 7: 0, 18: 0, 19: 1},
    "trail running shoes": {3: 0, 4: 0, 9: 0, 12: 0, 13: 1, 14: 3, 15: 1, 16: 0},
}


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "quillrank-tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def catalog(spark):
    return spark.createDataFrame(CATALOG, "doc_id LONG, document STRING, category STRING")


@pytest.fixture(scope="session")
def catalog_index(catalog):
    from quillrank.operators.bm25 import build_index

    return build_index(catalog)


@pytest.fixture(scope="session")
def held_out(spark):
    texts = {doc_id: text for doc_id, text, _ in CATALOG}
    rows = [
        (query, query, doc_id, texts[doc_id], relevance)
        for query, graded in HELD_OUT.items()
        for doc_id, relevance in graded.items()
    ]
    schema = "query_id STRING, query STRING, doc_id LONG, document STRING, relevance INT"
    return spark.createDataFrame(rows, schema)


def rows_of(df, *order):
    return [tuple(row) for row in df.orderBy(*order).collect()]
