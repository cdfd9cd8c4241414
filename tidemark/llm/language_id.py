"""Language identification by a linear-chain conditional random field that labels words.

The field is fitted on a bounded sample of labelled documents: at most ``SAMPLE`` documents of each language, of which
stretches of ``STRETCH`` words are strung together across languages, so that the transitions know code-switched text.
Every word of every whole text is then labelled by forward-backward.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import common as C
from tidemark.llm import crf

#: Bounds of the sample that the field is fitted on: documents of a language, languages that may have so many (with more
#: languages each has fewer), words of a document.
SAMPLE = 150
LANGUAGES = 64
WORDS = 240
STRETCH = 12
#: Text bytes labelled at a time: some hundred bytes of numbers go with each.
LABELLED_BYTES = 1 << 18
EPOCHS = 30
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")

SHARES = T.MapType(T.StringType(), T.DoubleType())
RESULTS = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("lang_spans", T.ArrayType(T.StructType([
    T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("lang", T.StringType())])))])


def held_out(doc_id: str, modulus: int, remainder: int) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


class Model:
    def __init__(self, languages: list[str], texts: list[str], labels: list[int]):
        self.languages = languages
        self.field = crf.Field(max(1, len(languages)))
        if len(languages) < 2:
            return
        flat, bounds = C.flat_bytes(C.strings(texts))
        tokens = crf.Tokens(flat, bounds)
        pick = np.random.default_rng(7)
        runs = []
        for d in range(len(texts)):
            a, b = np.searchsorted(tokens.row, d), np.searchsorted(tokens.row, d, side="right")
            cut = [(int(i), int(min(i + STRETCH, b))) for i in range(a, b, STRETCH)]
            if len(cut) * STRETCH > WORDS:
                cut = [cut[i] for i in sorted(pick.choice(len(cut), WORDS // STRETCH, replace=False).tolist())]
            runs += [(x, y, labels[d]) for x, y in cut]
        pick.shuffle(runs)
        word = np.concatenate([np.arange(x, y) for x, y, _ in runs])
        want = np.concatenate([np.full(y - x, k) for x, y, k in runs])
        group = np.concatenate([np.full(y - x, i // 3) for i, (x, y, _) in enumerate(runs)])
        self.field.fit(*tokens.features(), len(tokens.kinds), tokens.kind[word], np.bincount(group), want, EPOCHS)


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of the languages that occur in ``lang``; rows without a language or a text teach nothing."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(F.col("lang").cast("string").alias("lang"), "text", "doc_id")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "h")
    # row_number below a limit keeps that many rows of each language in every task before the exchange
    chosen = known.select("lang", "doc_id", F.xxhash64("text").alias("h")).withColumn("n", F.row_number().over(order)).filter(F.col("n") <= sample)
    langs = [r.lang for r in chosen.select("lang").distinct().collect()]
    share = min(sample, max(1, sample * LANGUAGES // max(1, len(langs))))
    rows = known.withColumn("h", F.xxhash64("text")).join(F.broadcast(chosen.filter(F.col("n") <= share).select("lang", "doc_id", "h").distinct()), ["lang", "doc_id", "h"]).dropDuplicates(["lang", "doc_id", "h"]).orderBy("lang", "doc_id", "h").collect()
    number = {x: i for i, x in enumerate(sorted(langs))}
    return Model(sorted(langs), [r.text for r in rows], [number[r.lang] for r in rows])


def _label(model, others: list[str], spans: bool):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        m: Model = model.value
        text = batch.column("text")
        flat, bounds = C.flat_bytes(text)
        tokens = crf.Tokens(flat, bounds)
        p = m.field.marginals(tokens, batch.num_rows)
        width = p.shape[1]
        # Bytes rather than words weigh, so that short words common to languages don't outvote long ones.
        weight = (tokens.end - tokens.begin).astype(float)
        sums = np.stack([np.bincount(tokens.row, p[:, j] * weight, batch.num_rows) for j in range(width)], axis=1) if len(p) else np.zeros((batch.num_rows, width))
        total = sums.sum(axis=1)
        best = sums.argmax(axis=1)
        score = np.where(total > 0, sums[np.arange(len(best)), best] / np.maximum(total, 1e-300), 0.0)
        lettered = [bool(t and LETTER.search(t)) for t in text.to_pylist()]
        pred = [m.languages[b] if ok and m.languages and s > 0 else UNKNOWN for b, ok, s in zip(best.tolist(), lettered, score.tolist(), strict=True)]
        out = {c: batch.column(c) for c in others}
        out |= {"text": text, "lang_pred": C.strings(pred), "score": pa.array(np.where(np.array(pred) == UNKNOWN, 0.0, np.clip(score, 0, 1)), pa.float64())}
        kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
        found = [[] for _ in range(batch.num_rows)]
        if spans and len(p) and m.languages:
            lab = p.argmax(axis=1)
            new = np.ones(len(lab), bool)
            new[1:] = (lab[1:] != lab[:-1]) | (tokens.row[1:] != tokens.row[:-1])
            first = np.flatnonzero(new)
            last = np.concatenate([first[1:], [len(lab)]]) - 1
            for i, a, b, k in zip(tokens.row[first].tolist(), tokens.begin[first].tolist(), tokens.end[last].tolist(), lab[first].tolist(), strict=True):
                found[i].append({"begin": a - int(bounds[i]), "end": b - int(bounds[i]), "lang": m.languages[k]})
        out["lang_spans"] = pa.array(found, kind)
        return pa.RecordBatch.from_arrays(list(out.values()), list(out))

    return run


def label(docs: DataFrame, model: Model, spans: bool = True) -> DataFrame:
    """The documents with ``lang_pred``, ``score`` (the share of the text's letters in it) and ``lang_spans``.

    ``lang_spans`` are the byte offsets of the maximal runs of words in one language (empty if not ``spans``). A text
    that is null or has no letter is ``und`` with score 0; so is every text if no language was learned. Columns of the
    results' names are replaced, all others kept; repeated rows stay; texts of any length are labelled whole.
    """
    others = [c for c in C.without(docs, RESULTS.names) if c != "text"]
    narrow = docs.select(*map(C.quoted, others), F.col("text").cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return C.mapped(narrow, C.over_slices(_label(sent, others, spans), "text", LABELLED_BYTES), T.StructType([*narrow.schema.fields, *RESULTS.fields]))


def keep_known(docs: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """The documents whose language is known and holds at least the share ``least`` of the text.

    With few languages chance alone gives a text more than that, so the share is also at least a fifteenth of the way
    from chance to certainty; for four languages both are 0.3.
    """
    chance = 1 / max(1, len(model.languages))
    least = max(least, chance + (1 - chance) / 15)
    found = label(docs, model, spans=False)
    kept = found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return kept.select(*[C.quoted(c) for c in docs.columns if c not in RESULTS.names])


def digests(docs: DataFrame, modulus: int = 4, remainder: int = 2) -> DataFrame:
    """Learn from the rows that are not held out, predict all."""
    held = held_out("doc_id", modulus, remainder)
    model = fit(docs.filter(~held))
    return label(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score")
