"""Toxicity by a linear-chain conditional random field that tags toxic words.

Labels are given for documents only. The field is fitted on a bounded sample of labelled documents (at most ``SAMPLE``
toxic and ``CLEAN`` times as many clean ones, near copies left out): words that are far more frequent in toxic documents start as toxic, all words of clean documents are
clean, and the tags of toxic documents are then revised from the field's own marginals. A logistic curve over the
marginals of a text gives its score. Every word of every whole text is tagged by forward-backward.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import common as C
from tidemark.llm import crf
from tidemark.llm.decontamination import Words

#: Bounds of the sample: toxic documents, clean ones for each of them, and words of a document besides marked ones.
SAMPLE = 600
CLEAN = 3
WORDS = 120
STRETCH = 20
ROUNDS, EPOCHS = 3, 12

RESULTS = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("toxic_spans", T.ArrayType(T.StructType([
    T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("p", T.DoubleType())])))])


def _summary(p: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Two figures of each text: the log-odds of its most toxic word, and how many toxic words it is expected to have."""
    top = np.zeros(rows)
    np.maximum.at(top, row, p)
    top = np.clip(top, 1e-6, 1 - 1e-6)
    return np.stack([np.log(top / (1 - top)), np.log1p(np.bincount(row, np.where(p > 0.1, p, 0.0), rows))], axis=1)


def _apart(texts: list[str]) -> list[int]:
    """Texts that share none of four minimal five-word hashes with an earlier one: near copies would pass for evidence."""
    flat, bounds = C.flat_bytes(C.strings(texts))
    words = Words(flat, bounds)
    at, h = words.windows(5)
    row, seen, kept = words.row[at], set(), []
    first = np.flatnonzero(np.diff(row, prepend=-1))
    least = {int(row[f]): [] for f in first}
    for k in range(4):
        low = np.minimum.reduceat(C.mixed(h + np.uint64(k)), first) if len(first) else []
        for r, x in zip(row[first].tolist(), low, strict=True):
            least[r].append((k, int(x)))
    for i in range(len(texts)):
        keys = least.get(i, [(9, texts[i])])
        if not any(k in seen for k in keys):
            kept.append(i)
        seen.update(keys)
    return kept


class Model:
    def __init__(self, texts: list[str], labels: list[int]):
        apart = _apart(texts)
        texts, labels = [texts[i] for i in apart], [labels[i] for i in apart]
        self.field = crf.Field(2)
        self.curve = np.array([-3.0, 0.0, 0.0])
        y = np.array(labels, float)
        if len(set(labels)) < 2:
            if labels:
                self.curve[0] = 3.0 if labels[0] else -3.0
            return
        flat, bounds = C.flat_bytes(C.strings(texts))
        tokens = crf.Tokens(flat, bounds)
        n, toxic_doc = len(tokens.kinds), y[tokens.row] > 0
        # Words and word beginnings that so many toxic documents have as chance would not give one of n.
        begin, size = tokens.begin[tokens.first], (tokens.end - tokens.begin)[tokens.first]
        keys = [(np.ones(n, bool), np.arange(n))]
        for k in (5, 6, 7, 8):
            cut = np.minimum(begin + k, begin + size)
            keys.append((size > k, np.unique(C.stretch_hash(tokens.prefix, begin, cut), return_inverse=True)[1]))
        least = np.log(len(keys) * n / 0.01) / np.log(len(y) / y.sum())
        seed = np.zeros(n, bool)
        for fits, key in keys:
            pair = np.unique(key[tokens.kind].astype(np.int64) * len(texts) + tokens.row)
            of, doc = pair // len(texts), pair % len(texts)
            bad, good = np.bincount(of, y[doc], n), np.bincount(of, 1 - y[doc], n)
            odds = (bad + 0.1) / (good + 0.1) * (1 - y).sum() / y.sum()
            seed |= fits & ((bad >= least) & (odds > 8))[key]
        # Stretches of words: all that hold a seed, and of each document at most WORDS words of others.
        begins = np.flatnonzero(np.diff(tokens.row, prepend=-1))
        place = np.arange(len(tokens.row)) - np.repeat(begins, np.diff([*begins, len(tokens.row)]))
        stretch = np.unique(tokens.row.astype(np.int64) << 32 | place // STRETCH, return_inverse=True)[1]
        marked = np.bincount(stretch, seed[tokens.kind]) > 0
        spread = C.mixed(np.arange(len(marked), dtype=np.uint64) + np.uint64(1))
        share = np.minimum(1.0, WORDS / np.bincount(tokens.row, minlength=len(texts)).clip(1))
        first = np.unique(stretch, return_index=True)[1]
        kept = marked | (spread.astype(np.float64) / 2.0**64 < share[tokens.row[first]])
        use = np.flatnonzero(kept[stretch])
        # Features are made of the stretches that are learned from alone, and of few texts at a time after that.
        cuts = np.flatnonzero(np.diff(stretch[use], prepend=-1))
        lines = [b" ".join(tokens.text(i) for i in part.tolist()).decode(errors="replace") for part in np.split(use, cuts[1:])]
        learned = crf.Tokens(*C.flat_bytes(C.strings(lines)))
        counts = np.bincount(learned.row, minlength=len(lines))
        tags = (seed[tokens.kind] & toxic_doc).astype(np.int64)
        features = learned.features()
        for _ in range(ROUNDS):
            self.field.fit(*features, len(learned.kinds), learned.kind, counts, tags[use], EPOCHS)
            p = np.concatenate([self._tagged(texts[i : i + 100]) for i in range(0, len(texts), 100)])
            top = np.zeros(len(texts))
            np.maximum.at(top, tokens.row, p)
            tags = (toxic_doc & ((p > 0.5) | (p >= np.maximum(top[tokens.row], 0.2)))).astype(np.int64)
        x = np.column_stack([np.ones(len(texts)), _summary(p, tokens.row, len(texts))])
        w = np.zeros(3)
        for _ in range(30):  # Newton's method on the logistic likelihood, lightly damped
            q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            h = (x * (q * (1 - q))[:, None]).T @ x + np.diag([1e-3, 1e-1, 1e-1])
            w += np.linalg.solve(h, x.T @ (y - q) - np.array([1e-3, 1e-1, 1e-1]) * w)
        self.curve = w

    def _tagged(self, texts: list[str]) -> np.ndarray:
        return self.field.marginals(crf.Tokens(*C.flat_bytes(C.strings(texts))), len(texts))[:, 1]

    def scores(self, p: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        x = np.column_stack([np.ones(rows), _summary(p, row, rows)])
        return 1 / (1 + np.exp(-np.clip(x @ self.curve, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of ``labels.toxic``; rows without a label or a text teach nothing, and a document's labels may repeat."""
    marks = labels.filter(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    order = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = marks.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= F.when(F.col("toxic") == 1, sample).otherwise(CLEAN * sample)).select("doc_id", "toxic")
    one = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter(F.col("text").isNotNull())
    got = one.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).orderBy("doc_id").limit((1 + CLEAN) * sample).collect()
    return Model([r.text for r in got], [r.toxic for r in got])


def _tag(model, others: list[str]):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        m: Model = model.value
        flat, bounds = C.flat_bytes(batch.column("text"))
        tokens = crf.Tokens(flat, bounds)
        p = m.field.marginals(tokens, batch.num_rows)[:, 1]
        score = m.scores(p, tokens.row, batch.num_rows)
        spans = [[] for _ in range(batch.num_rows)]
        at = np.flatnonzero(p >= 0.5)
        for i, a, b, q in zip(tokens.row[at].tolist(), tokens.begin[at].tolist(), tokens.end[at].tolist(), p[at].tolist(), strict=True):
            spans[i].append({"begin": a - int(bounds[i]), "end": b - int(bounds[i]), "p": q})
        out = {c: batch.column(c) for c in [*others, "text"]}
        out |= {
            "score": pa.array(score, pa.float64()), "predicted": pa.array((score >= 0.5).astype(np.int32), pa.int32()),
            "toxic_spans": pa.array(spans, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))),
        }
        return pa.RecordBatch.from_arrays(list(out.values()), list(out))

    return run


def tag(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with ``score`` (0 to 1), ``predicted`` (1 from 0.5 on) and ``toxic_spans`` (bytes of each toxic word).

    A null or empty text, and one without a word, has the score of a text without toxic words and no spans. Columns of
    the results' names are replaced, all others kept; repeated rows stay; texts of any length are tagged whole. With
    labels of one kind only, or none, every text without evidence gets that kind's score.
    """
    others = [c for c in C.without(docs, RESULTS.names) if c != "text"]
    narrow = docs.select(*map(C.quoted, others), F.col("text").cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return C.mapped(narrow, C.over_slices(_tag(sent, others), "text"), T.StructType([*narrow.schema.fields, *RESULTS.fields]))


def digests(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0) -> DataFrame:
    """Learn from the labelled rows that are not held out, score all."""
    from tidemark.llm.language_id import held_out

    held = held_out("doc_id", modulus, remainder)
    model = fit(docs.filter(~held), labels.filter(~held))
    return tag(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "score", "predicted")
