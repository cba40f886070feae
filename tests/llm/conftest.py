import random

import pytest

CLASHING = ("t", "length", "prefix", "bloom_block", "bloom_hit", "size", "shard", "range", "key", "keep_id", "n", "spans", "queue",
            "part", "component", "id", "words", "label", "signature", "letter", "text_hash", "route")


def words(rng, count, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(count))


@pytest.fixture
def docs_of(spark):
    """A table of documents from (doc_id, text[, lang, source]) rows, with extra columns whose names operators use inside."""
    def make(rows, clash=True):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1]) if r[1] is not None else None)
                for r in rows]
        names = CLASHING if clash else ()
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint" + "".join(f", {c} string" for c in names)
        return spark.createDataFrame([(*r, *names) for r in full], schema)
    return make


@pytest.fixture
def odd_rows():
    """Nulls, empty and blank texts, a very long one, ties in case, repeated rows."""
    rng = random.Random(5)
    return [(1, "Hello World"), (2, "hello world"), (3, None), (4, ""), (5, " \n\t "), (6, words(rng, 40_000, 5_000)),
            (None, "hello world"), (2, "hello world"), (7, "éÀ ß 日本 ́x"), (8, None, None, None), (9, "x" * 50_000)]
