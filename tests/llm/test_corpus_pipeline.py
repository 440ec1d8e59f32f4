"""The pipeline, stage by stage, against brute force."""

import importlib
import zlib
from collections import Counter

import numpy as np
import pytest

from riskloom.llm import mixing, packing, secrets
from tests.llm.test_text_operators import failed, fingerprint, groups, measures

pipeline = importlib.import_module("corpus_pipeline")


@pytest.fixture(scope="module")
def folder(corpus, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows = corpus.union(corpus.sparkSession.createDataFrame([(900, "x " * 60 + 'token = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b" ' + " ".join(f"word{i} prose" for i in range(60)), "en", "s1", 3)], corpus.schema))
    rows.write.parquet(f"{path}/documents.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept, seen = docs.columns, {}, docs.collect()
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        kept[name] = docs.collect()

    rows = [r for r in seen if failed(measures(r.text)) == 0]
    assert Counter(kept["quality_rules"]) == Counter(rows)
    group = groups([fingerprint(r.text) for r in rows])
    by = {}
    for r in rows:
        by.setdefault(group[fingerprint(r.text)], []).append(r)
    ids = Counter(min((r.doc_id for r in g if r.doc_id is not None), default=None) for g in by.values())
    assert Counter(r.doc_id for r in kept["simhash_near_dedup"]) == ids
    assert set(kept["simhash_near_dedup"]) <= set(rows)

    scanner = secrets.fit(spark, secrets.labelled_findings())
    want = Counter()
    for r in kept["simhash_near_dedup"]:
        text = r.text
        for a, b, p in reversed(scanner.scan([text])[0]):
            text = text[:a] + "[secret]" + text[b:] if p >= 0.5 else text
        want[(r.doc_id, text)] += 1
    assert Counter((r.doc_id, r.text) for r in kept["secret_scan"]) == want
    assert any("[secret]" in r.text for r in kept["secret_scan"])

    scanned = spark.read.parquet(f"{folder}/secret_scan")
    copies = Counter()
    for r in mixing.mix(scanned)[1].collect():
        copies[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in kept["source_mixing"]) == Counter({k: n for k, n in copies.items() if n})
    assert {(r.doc_id, r.text) for r in kept["source_mixing"]} <= set(want)

    packed = pipeline.STAGES[-1][1](spark, docs, folder).collect()
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(packing.default_tokenizer())
    pieces = Counter()
    for r in kept["source_mixing"]:
        ids = np.array(made.encode(r.text, add_special_tokens=False).ids + [0], "<u4")
        for k, at in enumerate(range(0, len(ids), 2048)):
            pieces[(r.doc_id, k, at, zlib.crc32(ids[at : at + 2048].tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.ids_crc32) for r in packed) == pieces
    whole = pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.ids_crc32) for r in whole) == pieces


def test_no_documents(spark, nothing, tmp_path):
    nothing.write.parquet(f"{tmp_path}/documents.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0
