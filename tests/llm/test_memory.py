"""What the operators hold inside a task."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from tidemark.llm import common as C
from tidemark.llm import language_id, repeats, sentence_pieces


def peak(batches) -> int:
    """Most bytes held, in MB, while the results are made one by one."""
    tracemalloc.start()
    n = sum(b.num_rows for b in batches)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n
    return most >> 20


def test_repeats_hold_little_in_a_task():
    pick = random.Random(11)
    rows = [(g, k, bytes([g % 256, k]) * 8, 100, 100, pick.randbytes(300)) for g in range(1500) for k in range(6)]
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary())
    names = ["gram", "around", "node", "pos", "left", "bytes"]

    def surroundings():
        for k in range(0, len(rows), 1000):
            some = [(*r[:5], rows[k // 6 * 6][5] if i % 6 < 2 else r[5]) for i, r in enumerate(rows[k : k + 1000])]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), kinds, strict=True)], names)

    assert peak(repeats._order(surroundings())) < 100
    words = ["".join(pick.choices("abcdefgh", k=6)) for _ in range(5000)]
    texts = [" ".join(pick.choices(words, k=300)) for _ in range(1500)]
    assert peak(repeats._grams([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])])) < 80
    assert np.unique([len(t) for t in texts]).min() > repeats.LENGTH


def handed(monkeypatch, make):
    """The function over batches that an operator hands to the workers."""
    got = []
    with monkeypatch.context() as m:
        m.setattr(C, "mapped", lambda df, fn, schema: got.append(fn))
        make()
    return got[0]


def test_languages_and_pieces_hold_little_and_give_it_back(spark, monkeypatch):
    pick = random.Random(12)
    texts = [" ".join("".join(pick.choices("abcdefghij", k=pick.randint(2, 9))) for _ in range(300)) for _ in range(1200)]
    docs = spark.createDataFrame([(i, x, f"l{i % 4}") for i, x in enumerate(texts[:40])], "doc_id long, text string, lang string")
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    label = handed(monkeypatch, lambda: language_id.label(docs.select("doc_id", "text"), language_id.fit(docs, 10), spans=False))
    assert peak(label([batch])) < 60
    encode = handed(monkeypatch, lambda: sentence_pieces.encode(docs.select("doc_id", "text"), sentence_pieces.model_path()))
    assert sum(b.num_rows for b in encode([batch])) == len(texts)
    assert not sentence_pieces.codec(sentence_pieces.model_path()).parts
