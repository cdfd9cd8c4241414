"""Statistics of texts, base rules, and robust outliers among the documents of a language and source.

The statistics of a document, transformed, are a point. Each language and source gets a minimum-covariance-determinant
estimate: the mean and covariance of that half of its points which the ellipsoid of least volume holds. It is reached
from three fixed starts (medians with median deviations, all points, and correlations of squashed points) by
concentration steps: distances under the estimate, the half with the least distances, its mean and covariance, until
nothing changes. The start that ends with the least determinant wins, is scaled to the median distance of a normal
cloud and made anew from all points that lie within its 97.5 % ellipsoid. A document is rejected if its Mahalanobis distance
under this estimate is beyond ``CUTOFF``.

All of it is aggregates over (language, source, start) and projections; only counts of open groups reach the driver.
Coordinates and distances are whole numbers of small steps: sums are exact, so that results don't depend on the
partitions, and the exact order statistics of a group count at most as many values as there are steps.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm import common as C

BLANK = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RESULTS = [*STATISTICS, "base_failed", "distance", "kept"]

#: Words of a text at most, as a power of two (a row of Spark holds no more).
PLACES = 1 << 28

#: Languages and sources with fewer points are pooled: within the language, then over all.
LEAST_POINTS = 100
#: Coordinates are whole numbers, so many to 1; a group of 20 billion points has exact sums of their products.
UNIT = 1024
#: What the standard deviation of each coordinate is raised by (in quadrature), as most texts have no symbols and no equal lines.
FLOORS = [0.25, 0.05, 0.25, 0.5, 0.5]
P = len(FLOORS)
#: Distances are told apart in steps of an eighth of an octave of 1 + distance squared where halves are chosen.
BINS = 8
#: Concentration steps at most; groups seldom need more than eight.
STEPS = 12
#: Quantiles of the squared distance of a normal cloud in five dimensions: half, 97.5 %, and the cut-off.
HALF, INNER = 4.351, 12.833
CUTOFF = 64.0
#: Up to this many groups (200 bytes each) estimates are broadcast; more are joined, with salt against large groups.
SENT = 20_000
SALTS = 32


def statistics(docs: DataFrame) -> DataFrame:
    """All columns with the five statistics and ``base_failed`` (under 50 words, or over half of them in repeated windows).

    A null or empty text has no words and fails. Columns with the results' names are replaced, as are columns that begin
    with ``_q_``.
    """
    keep = [c for c in C.without(docs, RESULTS) if not c.lower().startswith("_q_")]
    held = list(map(C.quoted, keep))
    text = F.coalesce(F.col("text"), F.lit(""))
    x = docs.select(*held, F.btrim(text, F.lit(BLANKS)).alias("_q_trim"), text.alias("_q_text"))
    lines = F.filter(F.split("_q_text", "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    symbols = F.length(F.regexp_replace("_q_text", r"[^#*$%&|<>]+", ""))
    words = F.when(F.col("_q_trim") == "", F.array().cast("array<string>")).otherwise(F.split("_q_trim", BLANK))
    x = x.select(*held, words.alias("_q_words"), lines.alias("_q_lines"), symbols.alias("n_symbols"))
    x = x.select(
        *held, F.size("_q_words").alias("n_words"), F.length(F.array_join("_q_words", "")).alias("word_chars"), "n_symbols",
        (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).alias("n_dup_lines"), "_q_words",
        # of each window 36 bits of its hash before its place: sorted numbers bring equal windows together
        F.expr(f"sort_array(transform(_q_words, (w, i) -> xxhash64(w, get(_q_words, i + 1), get(_q_words, i + 2)) & {-PLACES} | i))").alias("_q_hashes"),
    )
    held += STATISTICS[:4]
    near = F.expr(f"array_compact(zip_with(_q_hashes, slice(_q_hashes, 2, size(_q_hashes)), (x, y) -> CASE WHEN x ^ y BETWEEN 0 AND {PLACES - 1} THEN struct(x, y) END))")
    x = x.select(*held, "_q_words", near.alias("_q_near"))
    x = x.select(*held, "_q_words", F.expr(f"filter(array_distinct(transform(concat(_q_near.x, _q_near.y), h -> cast(h & {PLACES - 1} AS int))), i -> i <= size(_q_words) - 3)").alias("_q_some"))
    # those few are compared word by word
    x = x.select(*held, F.expr("sort_array(transform(_q_some, i -> struct(_q_words[i] AS a, _q_words[i + 1] AS b, _q_words[i + 2] AS c, i AS i)))").alias("_q_sorted"))
    x = x.select(*held, "_q_sorted", F.expr("zip_with(_q_sorted, slice(_q_sorted, 2, size(_q_sorted)), (x, y) -> x.c = y.c AND x.b = y.b AND x.a = y.a)").alias("_q_same"))
    found = F.expr("array_compact(transform(_q_sorted, (x, k) -> CASE WHEN _q_same[k] OR (k > 0 AND _q_same[k - 1]) THEN x.i END))")
    x = x.select(*held, F.sort_array(found).alias("_q_at"))
    # a window covers three words, less those that the next one begins with
    covered = F.expr("aggregate(zip_with(_q_at, slice(_q_at, 2, size(_q_at)), (x, y) -> coalesce(least(y - x, 3), 3)), 0, (s, v) -> s + v)")
    x = x.select(*held, covered.alias("n_repeat_words"))
    # a generator, so that a filter on the statistics isn't moved below the expressions, where it would repeat them
    x = x.select(*held[:-4], F.inline(F.array(F.struct(*[F.col(c).cast("long").alias(c) for c in STATISTICS]))))
    return x.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def coordinates() -> list[Column]:
    """The point of a document with words: logarithms of its length and mean word length, and of its shares."""
    n, chars, symbols, lines, repeats = (F.col(c).cast("double") for c in STATISTICS)
    shares = [100 * symbols / chars, 100 * lines / n, 100 * repeats / n]
    return [F.round(UNIT * x).cast("long") for x in (F.log(n), F.log(chars / n), *[F.log1p(x) for x in shares])]


X = [f"x{k}" for k in range(P)]
MEAN = [f"m{k}" for k in range(P)]
PAIRS = [(a, b) for a in range(P) for b in range(a + 1)]
SUMS = ["n", *[f"s{k}" for k in range(P)], *[f"s{a}{b}" for a, b in PAIRS]]
ROOT = [f"l{a}{b}" for a, b in PAIRS]


def _keys() -> list[Column]:
    """Language and source as strings that are never null; a pool is called #."""
    return [F.coalesce(F.concat(F.lit("+"), F.col(c).cast("string")), F.lit("")).alias(f"_g_{c}") for c in ("lang", "source")]


KEYS = ["_g_lang", "_g_source"]


def _beside(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """The rows with what a written table has for their group. A group may hold a third of all rows."""
    if table.count() <= SENT:
        return rows.join(F.broadcast(table), keys, how)
    salted = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")).join(salted, [*keys, "_salt"], how).drop("_salt")


def _moments() -> list[Column]:
    return [F.count("*").alias("n"), *[F.sum(x).alias(f"s{k}") for k, x in enumerate(X)], *[F.sum(F.col(X[a]) * F.col(X[b])).alias(f"s{a}{b}") for a, b in PAIRS]]


def _covariance() -> list[Column]:
    mean = {k: F.col(f"s{k}") / F.col("n") for k in range(P)}
    return [*[mean[k].alias(MEAN[k]) for k in range(P)], *[(F.col(f"s{a}{b}") / F.col("n") - mean[a] * mean[b]).alias(f"c{a}{b}") for a, b in PAIRS]]


def _rooted(df: DataFrame) -> DataFrame:
    """The lower triangular root of the covariances (c), whose variances are raised by the floors."""
    for b in range(P):
        rest = F.col(f"c{b}{b}") + (FLOORS[b] * UNIT) ** 2
        for k in range(b):
            rest = rest - F.col(f"l{b}{k}") * F.col(f"l{b}{k}")
        df = df.withColumn(f"l{b}{b}", F.sqrt(F.greatest(rest, F.lit(1.0))))
        column = {}
        for a in range(b + 1, P):
            rest = F.col(f"c{a}{b}")
            for k in range(b):
                rest = rest - F.col(f"l{a}{k}") * F.col(f"l{b}{k}")
            column[f"l{a}{b}"] = rest / F.col(f"l{b}{b}")
        df = df.withColumns(column) if column else df
    return df.drop(*[f"c{a}{b}" for a, b in PAIRS])


def _distanced(df: DataFrame) -> DataFrame:
    """``d2``: the squared Mahalanobis distance of the point from the estimate in its row."""
    for a in range(P):
        rest = F.col(X[a]) - F.col(MEAN[a])
        for b in range(a):
            rest = rest - F.col(f"l{a}{b}") * F.col(f"z{b}")
        df = df.withColumn(f"z{a}", rest / F.col(f"l{a}{a}"))
    return df.withColumn("d2", sum((F.col(f"z{k}") * F.col(f"z{k}") for k in range(1, P)), F.col("z0") * F.col("z0"))).drop(*[f"z{k}" for k in range(P)])


def _middle(x: Column | str, name: str) -> Column:
    """The exact lower median of whole numbers."""
    return F.percentile(x, F.lit(0.5)).alias(name)


def _starts(points: DataFrame) -> DataFrame:
    """(grp, start, mean, root, sums): the three estimates to begin with; sums are null where they don't apply."""
    middle = C.stored(points.groupBy("grp").agg(*[_middle(x, m) for x, m in zip(X, MEAN, strict=True)]), "quality-medians")
    apart = [F.abs(F.col(x) - F.col(m)) for x, m in zip(X, MEAN, strict=True)]
    spread = _beside(points, middle, ["grp"]).groupBy("grp").agg(*[_middle(a, f"w{k}") for k, a in enumerate(apart)])
    scale = [F.sqrt(F.pow(1.4826 * F.col(f"w{k}"), 2) + (FLOORS[k] * UNIT) ** 2).alias(f"w{k}") for k in range(P)]
    middle = C.stored(middle.join(spread, "grp").select("grp", *MEAN, *scale), "quality-spreads")
    out = ["grp", "start", *MEAN, *ROOT]
    alone = middle.select("grp", F.lit(0).alias("start"), *MEAN, *[(F.col(f"w{a}") if a == b else F.lit(0.0)).alias(f"l{a}{b}") for a, b in PAIRS])
    whole = _rooted(points.groupBy("grp").agg(*_moments()).select("grp", F.lit(1).alias("start"), *_covariance())).select(out)
    squashed = [F.round(UNIT * F.tanh((F.col(X[k]) - F.col(MEAN[k])) / F.col(f"w{k}"))).cast("long").alias(X[k]) for k in range(P)]
    tied = _beside(points, middle, ["grp"]).select("grp", *squashed).groupBy("grp").agg(*_moments()).select("grp", *_covariance())
    tied = tied.drop(*MEAN).join(middle, "grp")
    shrink = [F.col(f"w{a}") * F.col(f"w{b}") * F.coalesce(F.try_divide(F.col(f"c{a}{b}"), F.sqrt(F.col(f"c{a}{a}") * F.col(f"c{b}{b}"))), F.lit(float(a == b))) for a, b in PAIRS]
    tied = _rooted(tied.select("grp", F.lit(2).alias("start"), *MEAN, *[c.alias(f"c{a}{b}") for c, (a, b) in zip(shrink, PAIRS, strict=True)])).select(out)
    return alone.unionByName(whole).unionByName(tied)


def _concentrated(points: DataFrame, estimates: DataFrame) -> DataFrame:
    """One step of every estimate: mean and root of the half of its group that is nearest to it.

    Points are gathered by distance bins, of which a group has a few hundred, and whole bins are taken up to the half.
    """
    near = _distanced(_beside(points, estimates, ["grp"])).withColumn("bin", F.floor(BINS * F.log2(1 + F.col("d2"))).cast("int"))
    bins = near.groupBy("grp", "start", "bin").agg(*_moments())
    upto = F.sum("n").over(W.partitionBy("grp", "start").orderBy("bin").rowsBetween(W.unboundedPreceding, -1))
    total = F.sum("n").over(W.partitionBy("grp", "start"))
    taken = bins.withColumn("_before", F.coalesce(upto, F.lit(0))).withColumn("_all", total).filter("2 * _before < _all + 6")
    sums = taken.groupBy("grp", "start").agg(*[F.sum(c).alias(c) for c in SUMS])
    return _rooted(sums.select("grp", "start", *SUMS, *_covariance()))


@dataclass(frozen=True)
class Model:
    """``estimates``: one row for each language and source (_g_lang, _g_source) with its mean and root, its own or its pool's."""

    estimates: DataFrame


def fit(stats: DataFrame) -> Model:
    """Estimates from all documents that pass the base rules; ``stats`` has the statistics, lang and source.

    A null language or source is a value of its own. Groups under ``LEAST_POINTS`` points are pooled within their
    language, and what is left of languages over all; a last pool that is still smaller has no estimate.
    """
    points = stats.filter("NOT base_failed").select(*_keys(), *[c.alias(x) for c, x in zip(coordinates(), X, strict=True)])
    points = C.stored(points, "quality-points")
    counts = C.stored(points.groupBy(*KEYS).agg(F.count("*").alias("n")), "quality-groups")
    pools = counts.filter(F.col("n") < LEAST_POINTS).groupBy("_g_lang").agg(F.sum("n").alias("pooled"))
    lang, source = F.col("_g_lang"), F.col("_g_source")
    named = lambda a, b: F.concat(F.length(a).cast("string"), F.lit(":"), a, b)
    grp = F.when(F.col("n") >= LEAST_POINTS, named(lang, source)).when(F.col("pooled") >= LEAST_POINTS, named(lang, F.lit("#"))).otherwise(F.lit("#"))
    groups = C.stored(counts.join(pools, "_g_lang", "left").select(*KEYS, grp.alias("grp"), "n"), "quality-pools")
    large = groups.groupBy("grp").agg(F.sum("n").alias("_n")).filter(F.col("_n") >= LEAST_POINTS)
    groups = C.stored(groups.join(large, "grp").select(*KEYS, "grp"), "quality-pools")
    points = C.stored(_beside(points, groups, KEYS).select("grp", *X), "quality-points")
    open_, done = C.stored(_starts(points), "quality-starts"), []
    for step in range(STEPS):
        new = _concentrated(points, open_.select("grp", "start", *MEAN, *ROOT))
        if step:
            same = F.lit(True)
            for c in SUMS:
                same = same & (F.col(c) == F.col(f"old_{c}"))
            new = new.join(open_.select("grp", "start", *[F.col(c).alias(f"old_{c}") for c in SUMS]), ["grp", "start"]).withColumn("still", same).drop(*[f"old_{c}" for c in SUMS])
        else:
            new = new.withColumn("still", F.lit(False))
        new = C.stored(new, "quality-step")
        done.append(new.filter("still OR " + str(step == STEPS - 1)).select("grp", "start", *MEAN, *ROOT))
        open_ = new.filter("NOT still")
        if open_.isEmpty():
            break
    ended = done[0]
    for x in done[1:]:
        ended = ended.unionByName(x)
    volume = sum((F.log(f"l{k}{k}") for k in range(1, P)), F.log("l00"))
    best = ended.groupBy("grp").agg(F.min_by(F.struct(*MEAN, *ROOT), F.struct(volume.alias("v"), "start")).alias("e")).select("grp", "e.*")
    best = C.stored(best, "quality-best")
    # scaled to a normal cloud's median, but never narrower than the half itself
    middle = _distanced(_beside(points, best, ["grp"])).groupBy("grp").agg(_middle(F.floor(64 * F.log2(1 + F.col("d2"))).cast("int"), "b"))
    wide = F.sqrt(F.greatest((F.pow(F.lit(2.0), (F.col("b") + 0.5) / 64) - 1) / HALF, F.lit(1.0)))
    best = C.stored(best.join(middle, "grp").select("grp", *MEAN, *[(F.col(c) * wide).alias(c) for c in ROOT]), "quality-scaled")
    inner = _distanced(_beside(points, best, ["grp"])).filter(F.col("d2") <= INNER)
    final = _rooted(inner.groupBy("grp").agg(*_moments()).select("grp", *_covariance()))
    return Model(C.stored(groups.join(final, "grp").select(*KEYS, *MEAN, *ROOT), "quality-estimates"))


def judge(stats: DataFrame, model: Model, cutoff: float = CUTOFF) -> DataFrame:
    """The documents with ``distance`` (null where the base rules failed or no estimate is there) and ``kept``."""
    keep = C.without(stats, ["distance", "kept"])
    # the documents' columns travel in one, away from the names used here
    placed = stats.select(F.struct(*map(C.quoted, keep)).alias("_q_held"), "base_failed", *_keys(), *[F.when(~F.col("base_failed"), c).alias(x) for c, x in zip(coordinates(), X, strict=True)])
    x = _distanced(_beside(placed, model.estimates, KEYS, "left"))
    kept = ~F.col("base_failed") & F.coalesce(F.col("d2") <= cutoff, F.lit(True))
    return x.select("_q_held.*", F.sqrt("d2").alias("distance"), kept.alias("kept"))


def digests(docs: DataFrame) -> DataFrame:
    stats = C.stored(statistics(docs).drop("text"), "quality-statistics")
    return judge(stats, fit(stats)).select("doc_id", *STATISTICS, "base_failed", "kept", "distance")
