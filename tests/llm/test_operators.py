"""The numbered operators against plain versions, on the small tables and on frames of odd rows."""

import hashlib
import math
import random
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

sys.path.insert(0, __file__.rsplit("/", 1)[0])

import brute  # noqa: E402

from tidemark.llm import blocks, context_tree, crf, decontamination, graph, language_id, order_minhash, product_quantisation, queries, repeats, sentence_pieces, sharding, token_files, toxicity  # noqa: E402
from tidemark.llm import common as C  # noqa: E402


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    C.ship(spark)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return C.documents(spark, sf_dir)


@pytest.fixture(scope="module")
def texts(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


WORDS = ["the", "and", "ing", "thread", "étude", "ñandu", "weiß", "漢字", "a1", "x", "stone", "river"]


def words(n, seed):
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + pick.choice(WORDS) for _ in range(n))


LONG = words(30_000, 1)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns with the results' names."""
    base = words(300, 2)
    near = base.replace(base.split()[150], "another", 1)
    rows = [(None, base), (1, None), (None, None), (2, ""), (3, " \n\t "), (4, LONG), (5, base), (6, base), (6, base), (7, near), (8, "!!! 123 ..."), (9, "one two"), (10, "one two"), (11, words(40, 3))]
    clash = "n_words long, n_hit long, hit_items string, hit_spans string, clean_text string, size string, shard long, slot long, ids string, begins int, ends int, decoded string, lang_pred int, score string, "
    clash += "predicted string, toxic_spans int, kept int, kept_text int, removed int, n_bytes int, node int, label string, bucket int, chunk string, train string, `a.b c` int"
    n = clash.count(",") + 1
    return spark.createDataFrame([(d, t, "en" if d and d % 2 else None) + (None,) * n for d, t in rows], f"doc_id long, text string, lang string, {clash}")


def empty(df):
    return df.limit(0)


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


# 1


def check_contamination(found, texts, items):
    want = brute.contamination(texts, items)
    for r in found.collect():
        n, hit, names = want[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, hit, len(names), brute.sha(",".join(names)), hit > 0)


def test_decontamination_equals_plain(spark, sf_dir, texts):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    check_contamination(queries.op1_decontamination(spark, sf_dir), texts, items)


def test_decontamination_in_several_blocks(spark, docs, texts, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    one = decontamination.decontaminate(docs, items)
    many = decontamination.decontaminate(docs, items, block_bytes=3000)
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_decontamination_odd_rows(spark, odd):
    first = words(300, 2).split()
    items = [(1, " ".join(first[20:32])), (1, " ".join(first[20:32])), (None, "ONE two"), (3, None), (4, ""), (5, " ".join(LONG.split()[100:125]))]
    found = decontamination.decontaminate(odd, benchmark(spark, items))
    assert set(odd.columns) <= set(found.columns) and found.count() == odd.count()
    rows = {r.doc_id: r for r in found.filter("doc_id is not null").collect()}
    assert rows[5].n_hit == 12 and rows[5].hit_items == ["1"] and rows[1].n_words == 0 and rows[1].clean_text is None
    assert rows[9].hit_items == ["null"] and rows[9].clean_text == "" and rows[4].n_hit >= 25
    span = rows[5].hit_spans[0]
    assert rows[5].text.encode()[span.begin : span.end].decode() == " ".join(first[20:32])
    assert decontamination.decontaminate(odd, benchmark(spark, [])).filter("n_hit > 0").count() == 0
    assert decontamination.decontaminate(empty(odd), benchmark(spark, items)).count() == 0
    left = {r.doc_id: r.text for r in decontamination.remove_hits(odd.select("doc_id", "text"), benchmark(spark, items)).collect()}
    assert 9 not in left and left[7].count(" ") < words(300, 2).count(" ") and left[11] == words(40, 3)


# 2


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 3000])
@pytest.mark.parametrize("high", [1, 2, 300, 49407, 2**32 - 1])
def test_blocks_round_trip(n, high):
    v = np.random.default_rng(n).integers(0, high, n, dtype=np.uint64).astype(np.uint32)
    v[::50] = high
    image = blocks.encode(v)
    assert (blocks.decode(image) == v).all() and (blocks.decode(image, 1, 2) == v[128:256]).all()


def test_blocks_pack_below_outliers():
    v = np.full(128 * 8, 1000, np.uint32) + np.arange(1024, dtype=np.uint32) % 16
    v[5::128] = 2**31
    assert len(blocks.encode(v)) < 8 * (14 + 16 * 4 + 5) + 32


def test_token_files_equal_library(spark, sf_dir, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_files.tokenizer_path())
    want = brute.token_stream(texts, lambda x: t.encode(x, add_special_tokens=False).ids)
    assert sorted(map(tuple, queries.op2_token_files(spark, sf_dir).collect())) == want


def test_encoder_on_odd_characters():
    from tokenizers import Tokenizer

    path = token_files.tokenizer_path()
    pick = random.Random(3)
    some = ["a", "B", " ", " ", "\n", "é", "É", "é", "İ", "ß", "漢", "😀", "'s", "'", "1", "23", ".", "...", "%", "\x1c", "\x85", " ", " ", "̇", "<|endoftext|>", "<|", "Σ", "ς", " the", "ŉ", "ǅ", "×", "_"]
    texts = ["".join(pick.choices(some, k=pick.randint(0, 25))) for _ in range(1500)]
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in token_files.Encoder(path).encode([t.encode() for t in texts])] == want


def test_token_files_odd_rows(spark, odd):
    path = token_files.tokenizer_path()
    rows = token_files.read(spark, token_files.write(odd, path, partitions=3)).orderBy("start").collect()
    assert len(rows) == odd.count() and [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda d: (d is not None, d or 0))
    at = 0
    for r in rows:
        assert r.start == at and r.ids.endswith(b"\2\0\0\0")
        at += len(r.ids) // 4
    assert token_files.read(spark, token_files.write(empty(odd), path)).count() == 0


# 3


def check_shards(dealt, texts, shards=8):
    rows = dealt.collect()
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    for shard in by.values():
        assert sorted(r.slot for r in shard) == list(range(len(shard)))
    assert Counter(r.doc_id for r in rows) == Counter(d for d, _ in texts)
    sizes = [sum(r["size"] for r in by[k]) for k in range(shards)]
    most = max((r["size"] for r in rows), default=0)
    assert max(sizes) - min(sizes) <= 2 * most + 0.002 * sum(sizes) / shards
    return by


def test_sharding(spark, sf_dir, texts):
    df = queries.op3_sharding(spark, sf_dir)
    check_shards(df, texts)
    want = {d: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts}
    assert all((r["size"], r.text_crc32, r.law, r.grown_shard) == (*want[r.doc_id], "bytes", None) for r in df.collect())
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_sharding_cuts_a_large_group_of_copies(spark):
    rows = [(i, "one and the same text") for i in range(700)] + [(1000 + i, words(5, i)) for i in range(300)]
    check_shards(sharding.deal(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_sharding_odd_rows(spark, odd):
    out = sharding.deal(odd, shards=3)
    assert out.count() == odd.count() and set(odd.columns) <= set(out.columns)
    assert out.filter("text is null").agg({"size": "max"}).first()[0] == 1
    assert sharding.deal(empty(odd)).count() == 0
    assert sharding.deal(odd.filter("doc_id = 2"), shards=8).count() == 1


# 4 and 8


def test_messages_equal_plain_forward_backward():
    pick = np.random.default_rng(4)
    counts = np.array([1, 3, 31, 32, 33, 100, 2])
    e, t = pick.random((counts.sum(), 3)) + 0.05, pick.random((3, 3)) + 0.05
    m = crf.Messages(e, t, counts)
    at, pairs = 0, np.zeros((3, 3))
    for n in counts:
        x = e[at : at + n]
        f, b = [x[0]], [np.ones(3)]
        for i in range(1, n):
            f.append((f[-1] @ t) * x[i])
            b.append(t @ (x[n - i] * b[-1]))
        b = b[::-1]
        z = f[-1].sum()
        np.testing.assert_allclose(m.marginals[at : at + n], [f[i] * b[i] / z for i in range(n)], rtol=1e-9)
        for i in range(1, n):
            pairs += f[i - 1][:, None] * t * (x[i] * b[i])[None] / z
        at += n
    np.testing.assert_allclose(m.pairs(), pairs, rtol=1e-9)


def test_language_held_out_accuracy(spark, sf_dir, docs):
    got = queries.op4_language_id(spark, sf_dir).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.97 * len(got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)


def test_language_of_odd_and_mixed_texts(spark, docs, odd):
    model = language_id.fit(docs)
    got = {r.doc_id: r for r in language_id.label(odd, model).filter("doc_id is not null").collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[3].lang_pred == got[8].lang_pred == "und" and got[1].score == 0
    assert language_id.label(empty(odd), model).count() == 0
    assert language_id.fit(docs.limit(0)).languages == [] and language_id.label(odd, language_id.fit(empty(odd))).filter("lang_pred <> 'und'").count() == 0
    one = {r.lang: " ".join(r.text.split()[:25]) for r in docs.filter("lang in ('en', 'es')").collect() if len(r.text.split()) > 40 and "@" not in r.text}
    mixed = language_id.label(spark.createDataFrame([(1, one["en"] + " " + one["es"])], "doc_id long, text string"), model).first()
    assert {s.lang for s in mixed.lang_spans} >= {"en", "es"} and mixed.lang_spans[0].lang == "en" and mixed.lang_spans[-1].lang == "es"


def test_toxicity_learns_words(spark, odd):
    pick = random.Random(8)
    rows, labels = [], []
    for d in range(400):
        bad = d % 3 == 0
        w = words(60, 100 + d).split()
        for i in pick.sample(range(60), 3 if bad else 0):
            w[i] = pick.choice(["vileworm", "vileling", "rotfiend"])
        rows.append((d, " ".join(w)))
        labels.append((d, int(bad)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (0, None), (None, 1), (5, 0)], "doc_id long, toxic int")
    got = toxicity.digests(frame, marks).collect()
    truth = dict(labels)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.predicted == truth[r.doc_id] for r in got if r.held_out) >= 0.97 * sum(r.held_out for r in got)
    model = toxicity.fit(frame, marks)
    out = {r.doc_id: r for r in toxicity.tag(odd, model).filter("doc_id is not null").collect()}
    assert out[1].predicted == out[2].predicted == out[4].predicted == 0 and out[1].toxic_spans == [] and 0 <= out[2].score < 0.5
    tagged = toxicity.tag(spark.createDataFrame([(1, "thread vileworm stone")], "doc_id long, text string"), model).first()
    assert [(s.begin, s.end) for s in tagged.toxic_spans] == [(7, 15)]
    assert toxicity.tag(empty(odd), model).count() == 0
    assert toxicity.digests(frame, marks.limit(0)).filter("score >= 0.5").count() == 0


# 5


def test_pieces_equal_library(spark, sf_dir, texts):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.model_path())
    for r in queries.op5_sentence_pieces(spark, sf_dir).collect():
        ids = sp.encode(dict(texts)[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), brute.sha(",".join(map(str, ids))), brute.sha(sp.decode(ids)))


def test_piece_spans_equal_library():
    codec = sentence_pieces.Codec(sentence_pieces.model_path())
    pick = random.Random(5)
    some = ["a", "b", " ", " ", "\n", "▁", "é", "漢", "😀", "ñ", ".", "1", "\t", "the"]
    texts = ["".join(pick.choices(some, k=pick.randint(0, 30))) for _ in range(800)] + ["", " ", "  ", "▁"]
    for t, fast in zip(texts, codec.encode(texts), strict=True):
        want = [(p.id, p.begin, p.end) for p in codec.library.encode(t, return_type="proto").pieces]
        assert list(zip(*(x.tolist() for x in fast), strict=True)) == want
        assert list(zip(*(x.tolist() for x in codec.general(t)), strict=True)) == want


def char_map(rules: dict[str, str]) -> bytes:
    """A compiled map of the rules: a double-array trie laid out by trying bases in turn."""
    texts, at = b"", {}
    for k, v in rules.items():
        at[k.encode()] = len(texts)
        texts += v.encode() + b"\0"
    units, used = defaultdict(int), {0}

    def place(prefix: bytes, node: int) -> None:
        keys = sorted({k[len(prefix)] for k in at if k.startswith(prefix) and len(k) > len(prefix)})
        leaf = prefix in at
        labels = ([0] if leaf else []) + keys
        base = next(b for b in range(1, 1 << 20) if all((node ^ b ^ c) not in used for c in labels))
        units[node] |= base << 10 | (256 if leaf else 0)
        for c in labels:
            used.add(node ^ base ^ c)
        if leaf:
            units[node ^ base] = 1 << 31 | at[prefix]
        for c in keys:
            units[node ^ base ^ c] |= c
            place(prefix + bytes([c]), node ^ base ^ c)

    place(b"", 0)
    trie = np.array([units[i] for i in range(max(used) + 1)], "<u4").tobytes()
    return len(trie).to_bytes(4, "little") + trie + texts


def test_longest_prefix_normalisation_keeps_source_bytes():
    codec = sentence_pieces.Codec(sentence_pieces.model_path())
    codec.map = sentence_pieces.CharMap(char_map({"a": "b", "ab": "XY", "abc": "", "ﬁ": "fi", "\t": " "}))
    norm, source = codec.normalise("aabzﬁ\tabcq")
    assert norm.decode() == "▁bXYzfi▁q"
    assert source.tolist() == [0, 0, 0, 0, 1, 1, 3, 4, 4, 7, 7, 7, 11, 12]


def test_pieces_odd_rows(odd):
    out = sentence_pieces.encode(odd, sentence_pieces.model_path())
    rows = {r.doc_id: r for r in out.filter("doc_id is not null").collect()}
    assert out.count() == odd.count() and set(odd.columns) <= set(out.columns)
    assert rows[1].ids == [] and rows[1].decoded == "" and rows[4].decoded == LONG and rows[4].ends[-1] == len(LONG.encode())
    assert sentence_pieces.encode(empty(odd), sentence_pieces.model_path()).count() == 0


# 6


def tree_probability(counts, context, byte):
    """The mixture of one byte after a context, by recursion over the paths."""

    def log_kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def totals(suffix, k, prefix):
        got = [0, 0]
        for s, n in counts.items():
            if s[:-1].endswith(suffix) and s[-1] >> (8 - k) == prefix:
                got[s[-1] >> (7 - k) & 1] += n
        return got

    def weighted(suffix, k, prefix):
        own = log_kt(*totals(suffix, k, prefix))
        if len(suffix) == context_tree.DEPTH:
            return own, own
        below = sum(weighted(c, k, prefix)[0] for c in {s[:-1][-len(suffix) - 1 :] for s in counts if s[:-1].endswith(suffix)})
        top = max(own, below)
        return math.log(0.5) + top + math.log(math.exp(own - top) + math.exp(below - top)), own

    total = 0.0
    for k in range(8):
        prefix, p, rest = byte >> (8 - k), 0.0, 1.0
        for d in range(context_tree.DEPTH + 1):
            suffix = context[len(context) - d :]
            w, own = weighted(suffix, k, prefix)
            stop = 1.0 if d == context_tree.DEPTH else math.exp(own + math.log(0.5) - w)
            a, b = totals(suffix, k, prefix)
            p += rest * stop * (b + 0.5) / (a + b + 1)
            rest *= 1 - stop
        total += math.log10(p if byte >> (7 - k) & 1 else 1 - p)
    return total


def test_code_lengths_equal_recursion(spark):
    text = b"\n" * context_tree.DEPTH + b"abracadabra abra \n"
    n = context_tree.DEPTH + 1
    counts = Counter(text[i : i + n] for i in range(len(text) - n + 1))
    counts[b"abraca"[:n]] += 0
    counts[b"zbracx"[:n]] += 0
    frame = spark.createDataFrame([(int.from_bytes(s, "big"), c) for s, c in counts.items()], "key long, n long")
    for r in context_tree.code_lengths(frame).collect():
        s = r.key.to_bytes(n, "big")
        assert abs(r.log_p - tree_probability(counts, s[:-1], s[-1])) < 1e-9


def base_scores(texts):
    import re

    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in texts}
    split = {d: [*re.findall("[^\x20\x09-\x0d]+", brute.lower(t or "")), None] for d, t in texts}
    c = Counter(w for d, ws in split.items() if not held[d] for w in ws)
    total = sum(c.values())
    return {d: (held[d], len(ws), sum(c[w] > 0 for w in ws), total, sum(math.log10((c[w] + 1) / (total + len(c) + 1)) for w in ws)) for d, ws in split.items()}


def test_context_tree_scores(spark, sf_dir, texts):
    want = base_scores(texts)
    rows = queries.op6_context_tree(spark, sf_dir).collect()
    for r in rows:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:4]
        assert abs(r.base_score - want[r.doc_id][4]) < 1e-6 * abs(want[r.doc_id][4]) + 1e-9 and r.score < 0


def test_context_tree_by_joins_equals_sent(docs):
    from pyspark.sql import functions as F

    some, train = docs.limit(60), F.col("doc_id") % 3 != 1
    a = {r.doc_id: r for r in context_tree.score(some, train).collect()}
    b = {r.doc_id: r for r in context_tree.score(some, train, sent=0).collect()}
    assert a.keys() == b.keys()
    for d, r in a.items():
        assert (r.n_tokens, r.n_known, r.train_tokens) == (b[d].n_tokens, b[d].n_known, b[d].train_tokens)
        assert abs(r.score - b[d].score) < 1e-5 * abs(r.score) and abs(r.base_score - b[d].base_score) < 1e-9 * abs(r.base_score)


def test_context_tree_odd_rows(odd):
    from pyspark.sql import functions as F

    rows = context_tree.score(odd, F.col("doc_id") > 3).collect()
    assert len(rows) == odd.count()
    assert next(r for r in rows if r.doc_id == 1).n_tokens == 1
    assert context_tree.score(empty(odd), F.lit(True)).count() == 0
    none = context_tree.score(odd.filter("doc_id = 9"), F.lit(False)).first()
    assert abs(none.score - 9 * 8 * math.log10(0.5)) < 1e-5 and none.n_known == 0 and none.train_tokens == 0


# 7


def plain_links(rows, similar=0.98):
    good = [(i, np.array(v, float) / np.linalg.norm(v), k) for i, (d, v, k) in enumerate(rows) if v and k is not None and all(c is not None and np.isfinite(c) for c in v) and np.linalg.norm(v)]
    n, root = Counter(), {i: i for i in range(len(rows))}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, v, k) in enumerate(good):
        for j, w, m in good[:a]:
            if k == m and len(v) == len(w) and v @ w >= similar:
                n[i] += 1
                n[j] += 1
                root[max(find(i), find(j), key=lambda x: rows[x][0])] = min(find(i), find(j), key=lambda x: rows[x][0])
    return sorted((rows[i][0], n[i], rows[find(i)][0], rows[i][0] == rows[find(i)][0]) for i in range(len(rows)))


def test_vector_links_recall(spark, sf_dir):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want = {r[0]: r for r in plain_links(rows)}
    got = {r.vec_id: tuple(r) for r in queries.op7_product_quantisation(spark, sf_dir).collect()}
    assert got.keys() == want.keys() and all(got[k][1] <= want[k][1] for k in want)
    assert sum(r[1] for r in got.values()) >= 0.9 * sum(r[1] for r in want.values())


def test_vector_odd_rows(spark):
    pick = np.random.default_rng(7)
    v = pick.normal(size=(40, 8)).tolist()
    rows = [(i, x, i % 2) for i, x in enumerate(v)] + [(100 + i, (np.array(v[4]) + pick.normal(size=8) * 0.02).tolist(), 0) for i in range(30)]
    rows += [(200, v[4], 0), (201, v[4], 0), (202, v[4], None), (203, None, 0), (204, [0.0] * 8, 0), (205, [float("nan")] * 8, 0), (206, [None] * 8, 0), (207, [1.0], 0), (208, [], 0), (209, [3 * c for c in v[4]], 0)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, n_links string")
    assert sorted(map(tuple, product_quantisation.near_copies(frame).collect())) == plain_links(rows)
    assert product_quantisation.near_copies(empty(frame)).count() == 0
    assert product_quantisation.near_copies(frame.filter("vec_id in (202, 203)")).count() == 2


def test_vectors_of_several_lengths(spark, monkeypatch):
    pick = np.random.default_rng(8)
    rows = []
    for length, groups in ((8, 12), (5, 9), (3, 4), (1, 2)):
        for g in range(groups):
            v = pick.normal(size=length)
            rows += [(len(rows) + i, (v + pick.normal(size=length) * 0.03).tolist(), g % 2) for i in range(6)]
    rows += [(1000 + i, v, k) for i, (_, v, k) in enumerate(rows[::7])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want = plain_links(rows)
    assert sum(r[1] for r in want) > 500
    assert sorted(map(tuple, product_quantisation.near_copies(frame).collect())) == want
    monkeypatch.setattr(product_quantisation, "LENGTHS", 1)  # the other lengths are compared without codes
    assert sorted(map(tuple, product_quantisation.near_copies(frame).collect())) == want


# 9


def plain_repeats(texts, size=repeats.LENGTH):
    raws = [(d, (t or "").encode()) for d, t in texts]
    seen = Counter(r[i : i + size] for _, r in raws for i in range(len(r) - size + 1))
    out = []
    for d, r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - size + 1):
            if seen[r[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        runs = sum(1 for i in range(len(r)) if gone[i] and (not i or not gone[i - 1]))
        out.append((d, len(r), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(r, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=repr)


def test_repeats_equal_plain(spark, sf_dir, texts):
    assert sorted(map(tuple, queries.op9_repeats(spark, sf_dir).collect()), key=repr) == plain_repeats(texts)


def odd_repeats():
    passage, pick = words(40, 20), random.Random(9)
    rows = [(i, words(20, 30 + i) + passage[: pick.randint(150, 400)] + words(20, 60 + i)) for i in range(30)]
    rows += [(50, passage + " then " + passage), (51, "ab" * 500), (52, "ab" * 120 + words(30, 99)), (53, "x" * 199), (54, "x" * 199), (55, "y" * 201), (56, None), (57, ""), (58, "é" * 150 + "q"), (59, "z" + "é" * 150), (60, passage), (61, passage)]
    return rows + [(61, passage), (62, LONG[:9000]), (63, LONG[3000:8000])]


def test_repeats_odd_rows(spark, odd, monkeypatch):
    rows = odd_repeats()
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_repeats(rows)
    assert sorted(map(tuple, repeats.digests(frame).collect()), key=repr) == want
    monkeypatch.setattr(repeats, "CROWD", 3)
    monkeypatch.setattr(repeats, "SENT", -1)
    assert sorted(map(tuple, repeats.digests(frame).collect()), key=repr) == want
    out = repeats.remove_repeats(odd)
    assert out.count() == odd.count() and set(odd.columns) <= set(out.columns)
    assert repeats.digests(empty(odd)).count() == 0


def test_longest_factors_equal_plain():
    pick = random.Random(12)
    for _ in range(60):
        gram, texts, left, group = bytes(pick.choices(b"ab\0", k=repeats.GRAM)), [], [], []
        for g in range(3):
            sides = [bytes(pick.choices(b"a\0", k=pick.choice((100, 100, 100, 40, 0)))) for _ in range(8)]
            for _ in range(pick.randint(1, 12)):
                a, b = (bytearray(pick.choice(sides[:3])) for _ in range(2))
                for x in (a, b):
                    if x and pick.random() < 0.7:
                        x[pick.randrange(len(x))] ^= 1
                texts.append(bytes(a) + gram + bytes(b))
                left.append(len(a))
                group.append(g)
        anywhere, earlier = repeats.longest_factors(texts, np.array(left), np.array(group))
        seen = defaultdict(list)
        for i, t in enumerate(texts):
            for k in range(left[i] + 1):
                if len(s := t[left[i] - k : left[i] - k + repeats.LENGTH]) == repeats.LENGTH:
                    seen[group[i], k, s].append(i)
        want, late = np.zeros((2, *anywhere.shape), bool)
        for (_, k, _), found in seen.items():
            want[found, k] = len(found) > 1
            late[found[1:], k] = True
        assert (anywhere == want).all() and (earlier == late).all()
        starts = [np.flatnonzero(x) for x in want]
        assert repeats._span(anywhere).to_pylist() == [[{"begin": -int(x[-1]), "end": repeats.LENGTH - int(x[0])}] if len(x) else [] for x in starts]


def test_repeats_keep_the_first(spark):
    rows = sorted(set(odd_repeats()), key=lambda r: r[0])
    seen, want = set(), {}
    for d, t in rows:
        r = (t or "").encode()
        gone = bytearray(len(r))
        for i in range(len(r) - repeats.LENGTH + 1):
            s = r[i : i + repeats.LENGTH]
            if s in seen:
                gone[i : i + len(s)] = b"\1" * len(s)
            seen.add(s)
        want[d] = bytes(c for c, g in zip(r, gone, strict=True) if not g)
    got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: bytes(r.kept) for r in got} == want
    for r in got:
        assert (r.kept_text or "") in ("", r.text) or r.kept_text.encode().startswith(want[r.doc_id][:1])


# 10


def plain_classes(texts):
    first = {}
    for d, t in sorted(texts):
        if t is not None and order_minhash.shingles_of(t):
            first.setdefault(t, d)
    shingles = {d: order_minhash.shingles_of(t) for t, d in first.items()}
    root = {d: d for d in shingles}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by = defaultdict(set)
    for d, s in shingles.items():  # two texts at 0.8 share one of the rarest fifth of their shingles
        for x in sorted(set(s))[: len(set(s)) // 5 + 1]:
            by[x].add(d)
    for group in by.values():
        group = sorted(group)
        for i, a in enumerate(group):
            for b in group[i + 1 :]:
                if find(a) != find(b) and order_minhash.aligned(shingles[a], shingles[b]) >= order_minhash.SIMILAR:
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {d: find(first[t]) if t in first else d for d, t in texts}


def test_near_copies_equal_plain(spark, sf_dir, texts):
    want = plain_classes(texts)
    assert {r.doc_id: (r.class_id, r.kept) for r in queries.op10_order_minhash(spark, sf_dir).collect()} == {d: (c, c == d) for d, c in want.items()}


def test_aligned_equals_table():
    pick = random.Random(10)
    for _ in range(300):
        a = [pick.randint(0, 30) for _ in range(pick.randint(1, 40))]
        b = [x for x in a if pick.random() > 0.08]
        for _ in range(pick.randint(0, 3)):
            b.insert(pick.randint(0, len(b)), pick.randint(0, 30))
        table = [0] * (len(b) + 1)
        for x in a:
            old = table[:]
            for j, y in enumerate(b):
                table[j + 1] = old[j] + 1 if x == y else max(old[j + 1], table[j])
        m = table[-1]
        want = m / (len(a) + len(b) - m)
        assert order_minhash.aligned(a, b) == (pytest.approx(want) if want >= 0.8 else 0.0)


def test_near_copies_of_a_large_group(spark):
    base = words(400, 50).split()
    rows = [(i, " ".join([*base[:i], "other" + str(i), *base[i + 1 :]])) for i in range(120)]
    rows += [(500 + i, " ".join(base[:200]) + " " + words(250, 900 + i)) for i in range(40)]
    got = {r.doc_id: r.class_id for r in order_minhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == 0 for i in range(120)) and all(got[500 + i] == 500 + i for i in range(40))


def in_one_bucket(spark, texts):
    """Classes of texts that share one sketch and no other."""
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    sketched = spark.createDataFrame([(order_minhash._node(t), [1]) for t in texts], "node binary, sketches array<long>")
    label = {bytes(r.node): bytes(r.label) for r in order_minhash.labels(docs, sketched).collect()}
    return [label.get(order_minhash._node(t), order_minhash._node(t)) for t in texts]


def versions(n, edits, seed, size=300):
    """Texts each of which has ``edits`` words of the one before replaced, end to end."""
    text = [f"w{seed}x{i}" for i in range(size)]
    out = []
    for k in range(n):
        for e in range(edits):
            text[(k * edits + e) % size] = f"v{seed}x{k}x{e}"
        out.append(" ".join(text))
    return out


def similar(a, b):
    return order_minhash.aligned(order_minhash.shingles_of(a), order_minhash.shingles_of(b)) >= order_minhash.SIMILAR


def test_near_copies_chain_through_a_linked_member(spark):
    for seed in range(100):
        c, y, z = versions(3, 25, seed)
        if order_minhash._node(c) == min(map(order_minhash._node, (c, y, z))):
            break
    assert similar(c, y) and similar(y, z) and not similar(c, z)
    assert len(set(in_one_bucket(spark, [c, y, z]))) == 1
    # a large chain of versions in a bucket, beside one of its own words, over several blocks
    chain, other = versions(60, 25, 101, 1500), versions(40, 12, 102)
    for block in (order_minhash.BLOCK, 16):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(order_minhash, "BLOCK", block)
            m.setattr(order_minhash, "FIRST", 2)
            got = in_one_bucket(spark, chain + other)
        assert got == [min(map(order_minhash._node, chain))] * 60 + [min(map(order_minhash._node, other))] * 40


def test_near_copies_behind_unlike_centres(spark):
    """A template of 60 % in all texts; the least digests of the bucket are unlike all others, and near pairs hide behind them."""
    shared = versions(1, 0, 200, 180)[0]
    alone = sorted((shared + " " + versions(1, 0, 300 + i, 120)[0] for i in range(120)), key=order_minhash._node)
    pairs = []
    for i in range(1000):
        a, b = (shared + " " + v for v in versions(2, 10, 2000 + i, 120))
        if min(order_minhash._node(a), order_minhash._node(b)) > order_minhash._node(alone[59]):
            pairs.append((a, b))
        if len(pairs) == 10:
            break
    assert not similar(alone[0], alone[1]) and not similar(alone[0], pairs[0][0]) and all(similar(a, b) for a, b in pairs)
    got = in_one_bucket(spark, alone + [a for a, _ in pairs] + [b for _, b in pairs])
    assert got[:120] == [order_minhash._node(t) for t in alone]
    assert got[120:] == 2 * [min(map(order_minhash._node, p)) for p in pairs]


def test_near_copies_of_a_template_list_few_pairs(spark, monkeypatch):
    """Texts of one template, unlike each other, that meet in three buckets: lengths and bitmaps tell them apart, once a pair."""
    shared = versions(1, 0, 400, 260)[0]
    texts = [shared + " " + versions(1, 0, 500 + i, 40)[0] for i in range(60)]
    texts += [t + " end" for t in texts[:5]]
    assert not similar(texts[0], texts[1]) and similar(texts[0], texts[60])
    tried, scored = [], order_minhash._scored
    monkeypatch.setattr(order_minhash, "_scored", lambda pairs, texts: (tried.append(pairs.count()), scored(pairs, texts))[1])
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    sketched = spark.createDataFrame([(order_minhash._node(t), [1, 2, 3]) for t in texts], "node binary, sketches array<long>")
    label = {bytes(r.node): bytes(r.label) for r in order_minhash.labels(docs, sketched).collect()}
    got = [label.get(order_minhash._node(t), order_minhash._node(t)) for t in texts]
    want = [min(map(order_minhash._node, (texts[i], texts[60 + i]))) for i in range(5)]
    assert got == want + [order_minhash._node(t) for t in texts[5:60]] + want
    assert sum(tried) <= 2 * len(texts)  # of 2,080


def test_joined_components_walk_new_edges_only(spark, monkeypatch):
    walked, components = [], graph.components
    monkeypatch.setattr(graph, "components", lambda edges: (walked.append(edges.filter("a <> b").distinct().count()), components(edges))[1])
    frame = lambda edges: spark.createDataFrame(edges, "a long, b long")
    near = graph.joined(spark.createDataFrame([], "node long, label long"), frame([(i, i + 1) for i in range(10, 40)] + [(i, i + 1) for i in range(50, 70)]))
    assert dict(near.collect()) == {i: 10 for i in range(10, 41)} | {i: 50 for i in range(50, 71)}
    near = graph.joined(near, frame([(10 + i, 70 - i) for i in range(20)] + [(60, 3), (80, 81), (12, 30)]))
    assert dict(near.collect()) == {i: 3 for i in [3, *range(10, 41), *range(50, 71)]} | {80: 80, 81: 80}
    assert walked == [50, 3]


def test_keep_first_joins_documents_of_listed_hashes_only(spark, monkeypatch):
    """Whole texts that stay are in no shuffle, however large the table of copies is to Spark; the plain join gives the same."""
    rows = [(i, words(30, i % 70 if i < 100 else i)) for i in range(200)] + [(None, words(30, 5)), (None, None), (300, None), (3, words(30, 5)), (3, words(30, 5))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = order_minhash.keep_first(frame)
        assert sorted(map(tuple, kept.collect()), key=repr) == sorted([r for r in rows if r[0] is None and r[1] is None or r[0] == 300 or r[0] is not None and r[0] < 200 and not 70 <= r[0] < 100 and not (r[0] == 5)], key=repr)
        assert "LeftAnti, BuildRight" in kept._jdf.queryExecution().toString()
        monkeypatch.setattr(order_minhash, "SENT", -1)
        assert sorted(map(tuple, order_minhash.keep_first(frame).collect()), key=repr) == sorted(map(tuple, kept.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_near_copies_odd_rows(odd):
    got = [(r.doc_id, r.class_id, r.kept) for r in order_minhash.classes(odd).collect()]
    assert len(got) == odd.count()
    by = {d: (c, k) for d, c, k in got if d is not None}
    assert by[5] == (5, True) and by[6] == by[7] == (5, False) and by[1] == (1, True) and by[2] == (2, True) and by[9] == (9, True) and by[10] == (9, False)
    assert sorted(map(repr, (r for r in got if r[0] is None))) == ["(None, 5, False)", "(None, None, True)"]
    assert {r.doc_id for r in order_minhash.keep_first(odd).collect()} == {None, 1, 2, 3, 4, 5, 8, 9, 11}
    assert order_minhash.classes(empty(odd)).count() == 0


def test_token_files_numbers_beside_letters():
    tokens = token_files.Encoder(token_files.tokenizer_path())
    texts = ["5 m² x", "a¹², b ¾cup", "½a µm ªº"]
    for text, ids in zip(texts, tokens.encode([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokens.tokenizer.encode(text, add_special_tokens=False).ids


def test_blocks_pack_as_their_layout_says():
    pick = np.random.default_rng(5)
    for width in (1, 7, 14, 16, 31, 32):
        values = pick.integers(0, 1 << width, 300, dtype=np.uint64).astype(np.uint32)
        image = blocks.encode(values)
        assert (blocks.decode(image) == values).all() and (blocks.decode(image, 1, 2) == values[128:256]).all()
        least, bits = int(values[:128].min()), image[24 + 12 * 3]
        packed = np.frombuffer(image, np.uint8, 16 * bits, 24 + 14 * 3)
        first = np.unpackbits(packed, bitorder="little").reshape(128, bits) @ (1 << np.arange(bits))
        assert (first == (values[:128] - least) & ((1 << bits) - 1)).all()
