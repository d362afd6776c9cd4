from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import common, exact_dedup, near_dedup
from tallyhouse.llm.common import WordHashes
from tallyhouse.llm.components import components

from tests.llm.cases import AWKWARD, LONG, awkward, near_groups, rows_of


def test_function_is_minimal_and_perfect():
    for n in (0, 1, 2, 1000, 20_000):
        words = exact_dedup.as_words([hashlib.sha256(b"%d" % i).digest() for i in range(n)])
        sizes, bits = exact_dedup.build_function(words)
        assert sorted(exact_dedup.slots_of(words, sizes, bits).tolist()) == list(range(n))


def test_nonmembers_are_told_by_their_digest(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('t', id) AS text")
    index, shards = exact_dedup.build_index(exact_dedup.digests(docs), keys_per_shard=5)
    batch = spark.range(2900, 3200).selectExpr("id AS doc_id", "concat('t', id) AS text")
    groups = exact_dedup.look_up(exact_dedup.digests(batch), index, shards)
    assert index.agg(F.sum(F.size("winners"))).first()[0] == 3000
    assert groups.where("in_history AND repeats > 0").count() == 100
    assert groups.where("NOT in_history").count() == 200
    assert groups.count() == 3200


def test_repeated_digest_is_refused():
    words = exact_dedup.as_words([b"x" * 32, b"x" * 32])
    with pytest.raises(ValueError):
        exact_dedup.build_function(words)


def test_exact_groups_of_awkward_rows(spark):
    got = exact_dedup.exact_groups(awkward(spark)).select("doc_id", "keep_id", "group_size", "kept")
    fox, empty = (2, 3), (4, 3)
    want = {1: (*fox, False), 2: (*fox, True), 3: (*empty, False), 4: (*empty, True), 8: (8, 1, True)}
    found = {}
    for doc_id, *rest in got.collect():
        found.setdefault(doc_id, set()).add(tuple(rest))
    assert {k: found[k] for k in want} == {k: {v} for k, v in want.items()}
    assert found[None] == {(None, 1, True), (4, 3, False)}
    assert got.count() == len(AWKWARD)


def test_history_and_batch(spark):
    history = spark.createDataFrame([(10, "a"), (3, "b"), (4, "b")], "doc_id BIGINT, text STRING")
    batch = spark.createDataFrame([(1, "a"), (20, "b"), (5, "c"), (6, "c")], "doc_id BIGINT, text STRING")
    got = exact_dedup.exact_groups(batch, history).select("doc_id", "keep_id", "group_size", "kept")
    assert rows_of(got) == sorted(
        [(1, 10, 2, False), (10, 10, 2, True), (20, 20, 3, True), (3, 20, 3, False), (4, 20, 3, False),
         (5, 6, 2, False), (6, 6, 2, True)], key=lambda r: str(r[0])
    )


def test_dropping_copies_keeps_columns(spark):
    docs = awkward(spark)
    for drop in (exact_dedup.drop_exact_copies, near_dedup.drop_near_copies):
        kept = drop(docs)
        assert kept.schema == docs.schema
        ids = [r[0] for r in kept.select("doc_id").collect()]
        # The null text without id equals the empty text of document 4; without words it is no near copy.
        assert {5, 8, 9} <= set(ids) and ids.count(None) == (1 if drop is exact_dedup.drop_exact_copies else 2)
        assert drop(docs.where("1 = 0")).count() == 0
    assert {1} == {1, 2} - {r[0] for r in exact_dedup.drop_exact_copies(docs).select("doc_id").collect()}
    assert {2} == {1, 2} - {r[0] for r in near_dedup.drop_near_copies(docs).select("doc_id").collect()}


BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
BY_TEXT = [
    (7, "alpha one"), (9, "alpha one"), (7, "beta two"),  # an id for two texts, one of them a copy
    (None, "gamma three"), (None, "gamma three"), (None, "delta four"), (3, "delta four"),
    (8, "epsilon five"), (8, "epsilon five"),  # a row twice
    (20, f"{BASE} end"), (21, f"{BASE} stop"), (20, "other words that nobody else has written"),
    (None, f"{BASE} end here"), (None, None), (5, ""), (None, " "),
]


@pytest.mark.parametrize("drop", [exact_dedup.drop_exact_copies, near_dedup.drop_near_copies])
def test_decisions_go_by_text_and_not_by_id(spark, drop):
    docs = spark.createDataFrame(BY_TEXT, "doc_id BIGINT, text STRING").withColumn("source", F.lit("s"))
    got = [(r.doc_id, r.text) for r in drop(docs).collect()]
    exact = drop is exact_dedup.drop_exact_copies
    want = [
        (9 if exact else 7, "alpha one"), (7, "beta two"), (None, "gamma three"), (3, "delta four"),
        (8, "epsilon five"), (20, f"{BASE} end"), (20, "other words that nobody else has written"), (None, " "), (5, ""),
    ]
    if exact:
        want += [(21, f"{BASE} stop"), (None, f"{BASE} end here")]
    else:
        want += [(None, None)]
    order = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")
    assert sorted(got, key=order) == sorted(want, key=order)


def test_large_decisions_are_joined_by_shuffling(spark, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    test_decisions_go_by_text_and_not_by_id(spark, exact_dedup.drop_exact_copies)


def test_signature_is_two_permutations_and_shifts():
    shingles = near_dedup.shingle_set("a b c d e f g", 2, WordHashes())
    rng = np.random.Generator(np.random.PCG64(20))
    first, second = rng.permutation(near_dedup.PLACES), rng.permutation(near_dedup.PLACES)
    places = first[(shingles >> np.uint64(44)).astype(int)]
    want = [second[(places + k) % near_dedup.PLACES].min() for k in range(near_dedup.COORDINATES)]
    assert near_dedup.signature(shingles).tolist() == want


def copies(seed: int) -> list[tuple[int, str]]:
    """Families of texts with growing changes, texts around one passage, short texts, copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    passage = " ".join(rng.choices(vocabulary, k=15))
    texts = []
    for _ in range(12):
        words = rng.choices(vocabulary, k=rng.randint(20, 200))
        for _ in range(rng.randint(1, 40)):
            texts.append(" ".join(words))
            if rng.random() < 0.8:
                words = list(words)
                for _ in range(rng.randint(1, 1 + len(words) // 25)):
                    words[rng.randrange(len(words))] = rng.choice(vocabulary)
    texts += [passage + " " + " ".join(rng.choices(vocabulary, k=rng.randint(0, 8))) for _ in range(60)]
    texts += [" ".join(rng.choices("ab", k=rng.randint(1, 3))).upper() for _ in range(20)]
    ids = rng.sample(range(10_000), len(texts))
    return list(zip(ids, texts))


@pytest.mark.parametrize("n", [2, 5])
def test_near_groups_equal_all_pairs(spark, n):
    rows = copies(n)
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = near_dedup.near_groups(docs, n=n).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == near_groups(rows, n, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_groups_of_awkward_rows(spark):
    got = near_dedup.near_groups(awkward(spark), n=2).collect()
    assert len(got) == len(AWKWARD)
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is not None}
    assert found[1] == (9, 1, True) and found[2] == (9, 1, False)
    assert found[3] == (0, 3, True) and found[4] == (0, 4, True) and found[5] == (0, 5, True)
    assert found[8] == (1, 8, True)
    assert found[7] == (len(set(zip(LONG.split(), LONG.split()[1:]))) + 1, 6, False)
    assert {(r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is None} == {(0, None, True), (4, None, True)}
    assert near_dedup.near_groups(awkward(spark, []), n=2).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(50)] + [(100, 99), (99, 98), (7, 7), (None, 3)]
    got = {r.node: r.label for r in components(spark.createDataFrame(chain, "a BIGINT, b BIGINT")).collect()}
    assert got == {i: 0 for i in range(51)} | {98: 98, 99: 98, 100: 98}
    assert components(spark.createDataFrame([], "a BIGINT, b BIGINT")).count() == 0
