"""The pipeline's stages on small tables: each against brute force, decisions in effect, columns kept."""

import hashlib
import os
import re
import struct

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from changeflow.llm import bpe, decontamination, queries, secret_scan, toxicity

from .test_exact import brute_classes

SF = "/root/testdata/sf0.001"
needs = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are missing")


def stays_toxicity(spark, rows, docs):
    model = toxicity.train(spark, docs, spark.read.parquet(f"{SF}/labels.parquet"))
    bad = {r["doc_id"] for r in toxicity.score_documents(spark, docs, model).collect() if r["score"] >= 0.5}
    return [r for r in rows if r["doc_id"] not in bad]


def stays_near_copies(spark, rows, docs):
    classes = brute_classes([(r["doc_id"], r["text"]) for r in rows], 5, 80)
    return [r for r, (doc, n, root) in zip(rows, classes, strict=True) if n == 0 or doc == root]


def stays_decontamination(spark, rows, docs):
    number, keep = {}, []
    cut = lambda t: np.asarray([number.setdefault(w, len(number)) for w in re.findall(r"[^\x00-/:-@\[-`{-\x7f]+", t.lower())], int)
    items = [cut(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for r in rows:
        text, good = cut(r["text"] or ""), True
        for own in items:
            if len(set(own.tolist()) & set(text.tolist())) * 3 >= len(set(own.tolist())):  # fewer common words can't score enough
                score, a, b = decontamination.align(own, text)
                good &= score < decontamination.MATCH * min(decontamination.THRESHOLD * len(own), decontamination.EXCERPT_WORDS) or b - a < decontamination.LEAST_WORDS
        keep += [r] if good else []
    return keep


def stays_secrets(spark, rows, docs):
    forest, known = secret_scan.train(spark, docs)
    out = []
    for r in rows:
        text, last, parts = r["text"], 0, []
        for a, b in secret_scan.candidates(text or ""):
            if forest.score(np.asarray([secret_scan.describe(text, a, b, known)]))[0] >= secret_scan.THRESHOLD:
                parts += [text[last:a], secret_scan.PLACEHOLDER]
                last = b
        out.append({**r, "text": "".join(parts) + text[last:] if parts else text})
    return out


@needs
def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    columns = docs.columns
    brute = {"toxicity": stays_toxicity, "near_copies": stays_near_copies, "decontamination": stays_decontamination, "secrets": stays_secrets}
    assert [name for name, _ in corpus_pipeline.STAGES] == [*brute, "bpe"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = [r.asDict() for r in docs.collect()]
        after = stage(spark, docs, SF)
        assert after.columns == columns, name
        got = [r.asDict() for r in after.collect()]
        want = brute[name](spark, rows, docs)
        assert sorted(map(repr, got)) == sorted(map(repr, want)), name
        docs = spark.createDataFrame([tuple(r[c] for c in columns) for r in got], docs.schema).cache()
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    want = []
    for r in docs.collect():
        ids = known.encode_ordinary(r["text"] or "")
        want.append((r["doc_id"], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert sorted(map(repr, map(tuple, last.collect()))) == sorted(map(repr, want))


@needs
def test_stages_on_empty_and_odd_tables(spark, make):
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    odd = make([(None, None), (1, ""), (1, "two words"), (1, "two words"), (None, "x" * 3000)])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
        assert stage(spark, odd, SF).count() >= 4


@needs
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    rel = con.sql(queries.ORACLES[name])
    assert sorted(rel.columns) == columns
    place = [rel.columns.index(c) for c in columns]
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    assert sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=repr) == sorted((tuple(plain(r[i]) for i in place) for r in rel.fetchall()), key=repr)
