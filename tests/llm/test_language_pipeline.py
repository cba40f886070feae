import random
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tableshift.llm import langid, queries, stages
from tests.llm.conftest import words
from tests.llm.test_near import near_brute, repeats_brute

FOLDER = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    got = queries.op10_language_id(spark, FOLDER).join(queries.read(spark, FOLDER, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == 200
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    out = [r for r in got if r.held_out]
    assert len(out) > 20 and sum(r.lang_pred == r.lang for r in out) >= 0.97 * len(out)


def test_scores_against_counting_by_hand():
    texts, buckets = ["abc", "", "Ab", None, "zz" * 2000], 1 << 6
    matrix = np.random.default_rng(1).standard_normal((buckets + 1, 3))
    matrix[buckets] = 0
    best, sure = langid.score(texts, ["x", "y", "z"], matrix)
    for k, t in enumerate(texts):
        total = np.zeros(3)
        for index, _ in langid._features([(t or "").lower()], buckets) if t else ():
            total += matrix[index].sum(axis=0)
        p = np.exp(total - total.max())
        assert best[k] == total.argmax() and np.isclose(sure[k], (p / p.sum()).max())


def test_language_of_odd_rows(docs_of, odd_rows):
    docs = docs_of([*odd_rows, (20, "der die das und nicht", "de"), (21, "the and of with not", "en"), (22, "123 !!", None)])
    model = langid.train(docs.filter("doc_id >= 20"), "text", "lang")
    assert langid.train(docs, "text", "lang")[0] == ["de", "en"]
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert got[20].lang_pred == "de" and got[21].lang_pred == "en"
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (3, 4, 5, 8, 22))
    kept = langid.keep_identified(docs, model)
    assert kept.columns == docs.columns and {3, 4, 5, 8, 22}.isdisjoint({r.doc_id for r in kept.collect()})
    assert langid.train(docs.limit(0), "text", "lang") is None
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}
    assert langid.identify(docs.limit(0), model).collect() == []
    assert langid.keep_identified(docs, None).count() == kept.count()


def test_short_texts_are_not_rejected_for_their_probability(docs_of):
    docs = docs_of([(1, "ab"), (2, "x" * 19), (3, "x" * 20), (4, "12"), (5, None)])
    even = (["a", "b", "c"], np.zeros((65, 3)))  # a third each for every text
    assert sorted(r.doc_id for r in langid.keep_identified(docs, even).collect()) == [1, 2]
    assert sorted(r.doc_id for r in langid.keep_identified(docs, even, least=0.3).collect()) == [1, 2, 3]


def test_without(docs_of):
    docs = docs_of([(1, "a"), (2, "b"), (None, "c"), (2, "d")])
    key = F.col("doc_id")
    assert sorted(r.text for r in stages.without(docs, key, docs.filter("text = 'b'").select(key.alias("key"))).collect()) == ["a", "c"]
    assert stages.without(docs, key, docs.limit(0).select(key.alias("key"))).columns == docs.columns
    mark = stages.row_mark()
    assert sorted(r.text for r in stages.without(docs, mark, docs.filter("text = 'b'").select(mark.alias("key"))).collect()) == ["a", "c", "d"]


def test_exact_stage_judges_rows_not_ids(spark, docs_of):
    rows = [(1, "Same"), (2, "same"), (2, "other"), (3, "SAME"), (3, "own"), (3, "same"), (None, "same"), (None, "twice"), (None, "twice"),
            (5, "Again", "en", "b"), (5, "Again", "en", "a"), (5, "Again", "en", "a"), (6, None), (6, ""), (7, "ab"), (8, "ab")]
    docs = docs_of(rows)
    got = stages.exact(spark, docs, "")
    assert got.columns == docs.columns
    found = got.collect()
    assert len(found) == 7
    by_text = {(r.text or "").lower(): r for r in found}
    assert {t: r.doc_id for t, r in by_text.items()} == {"same": 3, "other": 2, "own": 3, "twice": None, "again": 5, "": 6, "ab": 8}
    assert by_text["again"].source == "a"
    assert stages.exact(spark, docs.limit(0), "").collect() == []


def test_near_stage_judges_rows_not_ids(spark, docs_of):
    rng = random.Random(11)
    x, y, z = (words(rng, 120, 3000) for _ in range(3))
    rows = [(1, x), (2, x + " end"), (2, y), (None, y + " end"), (None, z), (4, z + " end"), (5, words(rng, 120, 3000)), (6, None), (6, "")]
    docs = docs_of(rows)
    got = stages.near(spark, docs, "")
    assert got.columns == docs.columns
    found = {(r.doc_id, r.text) for r in got.collect()}
    assert {(1, x), (4, z + " end"), rows[6], (6, None), (6, "")} <= found and len(found) == 6
    assert len(found & {(2, y), (None, y + " end")}) == 1


def test_stages_against_brute_force(spark, docs_of, odd_rows):
    rng = random.Random(9)
    passage = words(rng, 70, 3000)
    rows = [*odd_rows] + [(100 + i, words(rng, 90, 3000)) for i in range(20)]
    rows += [(200, rows[-1][1]), (201, rows[-2][1].upper()), (202, rows[-3][1] + " one two"), (203, words(rng, 50, 3000) + "\n" + passage),
             (204, passage + " " + words(rng, 50, 3000)), (205, "?? 12 !")]
    docs = docs_of(rows, clash=False)
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "").persist()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen[name] = [(r.doc_id, r.text) for r in docs.collect()]
    assert {i for i, _ in seen["language_id"]} == {r[0] for r in rows} - {3, 4, 5, 8, 205}
    groups = {}
    for i, t in seen["language_id"]:
        key = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        groups[key] = max(groups.get(key, i), i, key=lambda v: (v is not None, v or 0))
    assert sorted(i for i, _ in seen["exact_dedup"]) == sorted(groups.values())
    near = {r[0] for r in near_brute(seen["exact_dedup"], 80) if r[3]}
    assert {i for i, _ in seen["minhash_near_dedup"]} == near and len(near) < len(groups)
    want = {w[0]: w for w in repeats_brute(seen["minhash_near_dedup"], 50)}
    for i, t in seen["substring_dedup"]:
        assert " ".join(t.encode().decode().split(" ")) == (want[i][3] if want[i][2] else dict(seen["minhash_near_dedup"])[i])
    assert any(w[2] for w in want.values())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert sum(p.length for p in pieces) == sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for _, t in seen["substring_dedup"])


def test_run_on_the_smallest_tables(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.count() > 50 and set(got.columns) >= {"doc_id", "sequence_id", "length"}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "minhash_near_dedup", "substring_dedup", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None
