"""Token frequencies over all documents, and memory that operators keep in workers."""

from __future__ import annotations

import numpy as np

from faremill.llm import ngram_join, sentencepieces, store


def test_frequencies_count_every_document_in_groups_of_tasks(spark, monkeypatch):
    texts = [f"common passage of four words own{i % 7} text{i} ends here" for i in range(60)] + [None, "", "one"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(9)
    cells = np.zeros(ngram_join.CELLS, np.int64)
    for _, tokens in ngram_join._sets(docs.toArrow().select(["doc_id", "text"]).to_batches(), 4):
        np.add.at(cells, (tokens % np.uint64(ngram_join.CELLS)).astype(np.int64), 1)
    expected = np.minimum(254, np.round(8 * np.log2(1.0 + cells))).astype(np.uint8)
    for group in (2, 256):
        monkeypatch.setattr(ngram_join, "GROUP_TASKS", group)
        codes, _ = ngram_join.frequency_codes(docs, 4)
        assert (codes == expected).all()
    assert not hasattr(ngram_join, "SAMPLE_DOCS")


def test_join_tasks_let_go_of_the_codec_of_an_earlier_task(monkeypatch):
    monkeypatch.setattr(sentencepieces, "Codec", lambda data, threads: object())
    sentencepieces.worker_codec.cache_clear()
    first = sentencepieces.worker_codec(b"model", 1)
    assert sentencepieces.worker_codec(b"model", 1) is first
    assert list(ngram_join._sets(iter([]), 4)) == []
    assert not store.KEEPERS and sentencepieces.worker_codec.cache_info().currsize == 0
