from __future__ import annotations

import hashlib

import numpy as np
import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from tallyhouse.llm import decontamination, quality
from tallyhouse.llm.common import read
from tallyhouse.llm.queries import tokenizer_path

from tests.compare import duck
from tests.llm.cases import awkward, near_groups

SF_DIR = "/root/testdata/sf0.001"


def test_all_eleven_are_registered():
    names = set(entry_point.queries())
    assert "pipeline" in names and {f"op{n}_" for n in range(1, 14)} <= {x.split("_")[0] + "_" for x in names}
    assert set(entry_point.oracle_sql()) <= names


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "packing"]


def test_pipeline_equals_a_plain_computation(spark):
    docs = read(spark, SF_DIR, "documents")
    ranking = quality.learn(docs, read(spark, SF_DIR, "labels"), 5, 0)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows = [(d, t) for d, t in rows if ranking.scores(np.array([quality.measure(t)]))[0] >= quality.CUTOFF]
    newest: dict[bytes, int] = {}
    for d, t in rows:
        key = hashlib.sha256((t or "").encode()).digest()
        newest[key] = max(d, newest.get(key, d))
    rows = [(d, t) for d, t in rows if d in set(newest.values())]
    near = near_groups(rows, 5, 80)
    rows = [(d, t) for d, t in rows if near[d][1] == d]
    con = duck(SF_DIR)
    leaking = {d for d, n in con.sql(f"SELECT doc_id, n_leaked FROM ({decontamination.sql()})").fetchall() if n}
    rows = [(d, t) for d, t in rows if d not in leaking]

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    lengths = {d: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for d, t in rows}
    got = corpus_pipeline.run(spark, SF_DIR).toPandas()
    assert got.groupby("doc_id").length.sum().to_dict() == lengths
    assert got.groupby("sequence_id").length.sum().max() <= 4096
    assert got.sequence_id.nunique() <= -(-sum(lengths.values()) // 4096) + 1


@pytest.mark.parametrize("rows", [None, []])
def test_stages_take_awkward_tables(spark, rows):
    docs = awkward(spark, rows)
    for _, work in corpus_pipeline.STAGES[:-1]:
        kept = work(spark, docs, SF_DIR)
        assert kept.schema == docs.schema
        assert kept.count() <= docs.count()
    corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
