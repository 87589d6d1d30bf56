import inspect
from collections import Counter

import corpus_pipeline
import pytest
from awkward import DOCUMENTS, corpus, prose
from test_llm_decontaminate import tables
from test_llm_repeats import plain_bytes
from test_llm_simhash import plain_components, plain_print
from test_llm_toxicity import planted

COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The awkward corpus, toxic documents, copies and benchmark passages as tables of a folder."""
    place = str(tmp_path_factory.mktemp("sf"))
    rows, labels = planted(240)
    leaks, items = tables(spark)
    known = {i for i, _ in corpus()}
    leaks = [(i, t) for i, t in leaks if i not in known or i is None or not t or len(t) < 20]  # the model knows one vocabulary
    rows = [(i + 1000, t) for i, t in rows] + leaks + [(500 + k, prose(80 + k, 150) + " " + prose(99, 90)) for k in range(4)]
    docs = spark.createDataFrame([(i, t, "en", 1, "k", "s", 2, "x", len(t) if t is not None else None) for i, t in rows], DOCUMENTS)
    docs.repartition(3).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame([(i + 1000, q, x) for i, q, x in labels], "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    items.write.parquet(f"{place}/benchmark.parquet")
    return place, rows, {i + 1000: x for i, _, x in labels}


def test_stages_do_what_their_plain_versions_do(spark, folder, tmp_path):
    place, rows, toxic = folder
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    docs = spark.read.parquet(f"{place}/documents.parquet")
    before = [(r.doc_id, r.text) for r in docs.collect()]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]
        out = stage(spark, docs, place)
        if number < 4:
            assert out.schema == docs.schema, name
        out.write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        if number == 4:
            break
        after = [(r.doc_id, r.text) for r in docs.collect()]
        if number == 0:
            ids = {i for i, _ in after}
            assert sum((i in ids) == (x == 0) for i, x in toxic.items()) >= 0.95 * len(toxic)
            assert {None, 6, 7, 8} <= ids and set(after) <= set(before)
        elif number == 1:
            root = plain_components({plain_print(t) for _, t in before})
            assert sorted(root[plain_print(t)] for _, t in after) == sorted(set(root.values()))
            assert set(after) <= set(before)
        elif number == 2:
            assert sorted((k[0], k[4].decode("utf-8", "ignore")) for k in plain_bytes([(-1 if i is None else i, t) for i, t in before], 400).elements()) == sorted(
                (-1 if i is None else i, t or "") for i, t in after
            )
            assert all(r.n_chars == len(r.text) for r in docs.collect() if r.text is not None)
        else:
            assert {i for i, _ in before} - {i for i, _ in after} <= {300, 301, 302, None} and set(after) <= set(before)
            assert not {300, 301, 302} & {i for i, _ in after}
        before = after
    pieces = docs.collect()
    assert sorted(str(r.doc_id) for r in pieces if r.piece == 0) == sorted(str(i) for i, _ in before)
    filled = {}
    for r in pieces:
        filled[r.sequence_id] = filled.get(r.sequence_id, 0) + r.length
    assert max(filled.values()) <= 4096
    # run() gives the pieces that the stages give one after another
    whole = corpus_pipeline.run(spark, place)
    assert whole.columns == COLUMNS
    whole = whole.collect()
    pieces, whole = (Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) for rows in (pieces, whole))
    assert whole == pieces


def test_empty_tables_give_no_pieces(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder[0]}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == COLUMNS and out.collect() == []


def test_without_labels_and_benchmark_only_copies_and_repeats_go(spark, folder, tmp_path):
    texts = [(1, "one text"), (2, None), (3, "another text of its own"), (None, "no id here"), (4, "")]
    spark.createDataFrame([(i, t, "en", 1, "k", "s", 2, "x", len(t or "")) for i, t in texts], DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{folder[0]}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    # the null and the empty text have fingerprint zero: they are one group
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(str(r.doc_id) for r in got if r.piece == 0) == ["1", "2", "3", "None"]
