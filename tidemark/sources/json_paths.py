"""JSON of unknown depth as rows: key paths, secrets found by path, and documents rebuilt without them.

Documents are parsed once into VARIANT and opened level by level: each round explodes the containers of the level before
and writes what it finds, so the rounds follow the depth of the deepest document and a round's rows the size of
the documents. Documents in whose text no pattern occurs are left alone. Rebuilding goes the same way back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.sources.artifacts import SECRET_KEY, SECRET_METADATA_KEY, SECRET_VALUE


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _document(text: Column) -> Column:
    """The parsed document, NULL where it is malformed.

    The parser lets anything follow a value. What may follow within a list can't follow within an object.
    """
    alone = F.try_parse_json(F.concat(F.lit('{"d":'), text, F.lit("}"))).isNotNull()
    return F.when(alone, F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$[0]", "variant"))


def _levels(docs: DataFrame, keys: list[str], text: str, dropped: str | None = None) -> list[DataFrame]:
    """By depth, (keys, parent, node, path, pos, key, value): the document itself first, then what its containers hold.

    ``node`` spells the places from the top, so it is unique in a document where a path need not be. Keys that match
    ``dropped`` are left out with all that is below them.
    """
    spark = docs.sparkSession
    null = F.lit(None).cast("string")
    top = docs.select(*keys, null.alias("parent"), F.lit("").alias("node"), F.lit("").alias("path"), F.lit(0).alias("pos"), null.alias("key"), _document(F.col(text)).alias("value"))
    out = [_written(top.where("value IS NOT NULL"), "json-documents")]
    path = F.when(F.col("key").isNull(), F.concat("path", F.lit("["), F.col("pos").cast("string"), F.lit("]"))).when(F.col("path") == "", F.col("key")).otherwise(F.concat_ws(".", "path", "key"))
    while True:
        above = out[-1].select(*keys, F.col("node").alias("parent"), "path", F.col("value").alias("_held"))
        x = above.lateralJoin(spark.tvf.variant_explode(F.col("_held").outer()))
        if dropped is not None:
            x = x.where(F.col("key").isNull() | ~F.col("key").rlike(dropped))
        x = x.select(*keys, "parent", F.concat_ws("/", "parent", F.col("pos").cast("string")).alias("node"), path.alias("path"), "pos", "key", "value")
        x = _written(x, "json-level")
        if x.isEmpty():
            return out
        out.append(x)


def _suspicious(text: Column, *patterns: str) -> Column:
    """Only text in which a pattern occurs anywhere can have a hit; escapes may hide one."""
    out = text.contains("\\")
    for p in patterns:
        out = out | text.rlike(p.replace("^token$", "token"))
    return F.coalesce(out, F.lit(False))


def key_paths(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, path, key): every object key at any depth, as names joined by dots with [n] for places in lists.

    A malformed document, or one with the same key twice in an object, has no paths.
    """
    found = [x.where("key IS NOT NULL").select(*keys, "path", "key") for x in _levels(docs, keys, text)]
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out


def secret_paths(docs: DataFrame, keys: list[str], text: str = "text", pattern: str = SECRET_KEY) -> DataFrame:
    """(keys, path) of keys that look like secrets, at any depth, below other hits too."""
    return key_paths(docs.where(_suspicious(F.col(text), pattern)), keys, text).where(F.col("key").rlike(pattern)).select(*keys, "path")


def _quoted(key: str) -> Column:
    """A key as JSON text: the head of a one-entry object."""
    return F.expr(f"substring(to_json(map({key}, 1)), 2, length(to_json(map({key}, 1))) - 4)")


def scrubbed(docs: DataFrame, text: str = "text", key: str = SECRET_METADATA_KEY, value: str = SECRET_VALUE) -> DataFrame:
    """The rows with ``scrubbed_text``, without secret-like keys at any depth, and ``leaks``: a kept string looks like a secret.

    A rebuilt document is compact and has its keys in order; one without anything to look for keeps its text.
    A malformed document, or one with the same key twice in an object, has NULL for both.
    """
    rows = _written(docs.withColumn("_row", F.monotonically_increasing_id()), "json-rows")
    looked = rows.where(_suspicious(F.col(text), key, value)).select("_row", text)
    levels = _levels(looked, ["_row"], text, dropped=key)
    whole, leaks = None, None
    for x in reversed(levels):
        bare = F.when(F.schema_of_variant("value").startswith("OBJECT"), "{}").otherwise(F.to_json("value"))
        if whole is None:
            made = x.withColumn("_text", bare)
        else:
            made = x.join(whole, (x["_row"] == whole["_of"]) & (x["node"] == whole["_node"]), "left").drop("_of", "_node").withColumn("_text", F.coalesce("_text", bare))
        string = F.try_variant_get("value", "$", "string")
        hit = made.groupBy("_row").agg(F.bool_or((F.schema_of_variant("value") == "STRING") & string.rlike(value)).alias("leaks"))
        leaks = hit if leaks is None else leaks.unionByName(hit)
        piece = F.when(F.col("key").isNull(), F.col("_text")).otherwise(F.concat(_quoted("key"), F.lit(":"), F.col("_text")))
        inside = made.groupBy("_row", "parent").agg(F.sort_array(F.collect_list(F.struct("pos", piece.alias("piece"))))["piece"].alias("_pieces"), F.bool_or(F.col("key").isNotNull()).alias("_object"))
        joined = F.array_join("_pieces", ",")
        around = F.when(F.col("_object"), F.concat(F.lit("{"), joined, F.lit("}"))).otherwise(F.concat(F.lit("["), joined, F.lit("]")))
        top = made.where("parent IS NULL").select(F.col("_row").alias("_of"), F.col("_text").alias("scrubbed_text"))
        whole = _written(inside.where("parent IS NOT NULL").select(F.col("_row").alias("_of"), F.col("parent").alias("_node"), around.alias("_text")), "json-rebuilt")
    leaks = leaks.groupBy(F.col("_row").alias("_of")).agg(F.bool_or("leaks").alias("_leaks"))
    found = _written(top.join(leaks, "_of"), "json-scrubbed")
    plain = ~_suspicious(F.col(text), key, value) & _document(F.col(text)).isNotNull()
    x = rows.join(found, rows["_row"] == found["_of"], "left")
    return x.select(*[F.col(c) for c in docs.columns], F.coalesce("scrubbed_text", F.when(plain, F.col(text))).alias("scrubbed_text"), F.coalesce("_leaks", F.when(plain, F.lit(False))).alias("leaks"))
