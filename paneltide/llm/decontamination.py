"""Benchmark decontamination: a prefix-filtered set join of documents with the
windows of benchmark items.

Everything is DataFrame functions. An item's windows are its runs of ``window``
consecutive words; an item of fewer words, but not none, is one window. A
window's set is its shingles of ``shingle`` words (all its words, if fewer)
with their places. A document holds a window only if it holds every shingle of
it, so the join needs one of them, the *prefix* under the global order by
rarity: shingles are counted over all documents, and a window enters the join
with its rarest one. A window whose rarest shingle no document holds is done.

Documents are split into words once. Each place of a document probes the
prefixes; a prefix found at a place fixes where the window would start, the
positional bound (the start is not before the text) and the length bound (the
end is not after it) go first, and then all words from there, as many as the
window has, must equal the window's. The probe, the bounds and the comparison
are one join's condition, so a text's words stay in their row: no shingle of a
document is shuffled. Prefixes go to the tasks as blocks of at most
``BLOCK`` of them, checked by their sizes; a larger benchmark takes
more such joins over the same documents, none is left out.

Defined results: a null or empty text has no words and is clean; rows with
equal ids are rows of their own (documents are told apart by id and a digest of
the text, and equal ones have equal results); windows of several items are
searched once and count for each; repeated items of one id count once; an
item with a null id marks words, but is neither counted nor listed; no items
leave all documents clean; no documents give no rows; columns other than those
named are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from paneltide.llm import store
from paneltide.operators.joins import broadcast_if_small, measure

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what lies between words, after lower-casing A-Z
BLOCK = 500_000  # prefixes a broadcast holds at most, besides BLOCK_BYTES
BLOCK_BYTES = 64 * 1024 * 1024


def words(text: Column) -> Column:
    """The text's words; an empty array for a null or empty text."""
    found = F.array_remove(F.split(F.translate(text, UPPER, LOWER), BETWEEN), "")
    return F.coalesce(found, F.array().cast("array<string>"))


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item, window): the distinct windows of each item, as arrays of words."""
    rows = items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    return rows.select("item", F.explode(F.transform(starts, lambda s: F.slice(F.col("w"), s, window))).alias("window")).distinct()


def _shingle(place: Column, width: int, of: str = "w") -> Column:
    return F.xxhash64(*(F.get(F.col(of), place + k) for k in range(width)))


def _places(rows: DataFrame, width: int, of: str = "w") -> DataFrame:
    """One row for each place at which ``width`` words of ``of`` begin.
    explode_outer, as Spark infers no filter from it that would look at the
    words a second time."""
    starts = F.when(F.size(of) >= width, F.sequence(F.lit(0), F.size(of) - width))
    return rows.select("*", F.explode_outer(starts).alias("place")).filter(F.col("place").isNotNull())


def _blocks(prefixes: DataFrame) -> list[DataFrame]:
    """``prefixes`` as parts that a broadcast may hold."""
    rows, size = measure(prefixes)
    parts = max(1, -(-rows // BLOCK), -(-size // BLOCK_BYTES))
    return [prefixes.filter(F.pmod(F.xxhash64("window"), F.lit(parts)) == p) for p in range(parts)]


def occurrences(documents: DataFrame, windows: DataFrame, shingle: int) -> DataFrame:
    """``documents`` has ``w`` (words) and key columns, ``windows`` distinct
    arrays ``window``: (keys..., window, start, end) of each occurrence."""
    keys = [c for c in documents.columns if c != "w"]
    found = []
    widths = sorted(r[0] for r in windows.select(F.least(F.size("window"), F.lit(shingle))).distinct().collect())
    for width in widths:  # one width, unless items of fewer words than a shingle exist
        mine = windows.filter(F.least(F.size("window"), F.lit(shingle)) == width)
        parts = _places(mine, width, "window").select("window", F.col("place").alias("offset"), _shingle(F.col("place"), width, "window").alias("token"))
        tokens = parts.select("token").distinct()
        counted = [_places(documents, width).select(_shingle(F.col("place"), width).alias("token")).join(F.broadcast(t), "token", "left_semi")
                   .groupBy("token").count() for t in _token_blocks(tokens)]
        rarity = store.materialise(reduce(DataFrame.unionByName, counted), "rarity")
        # shingles that no document holds come first in the order and end their windows
        ordered = parts.join(broadcast_if_small(rarity), "token", "left").withColumn("count", F.coalesce("count", F.lit(0)))
        prefixes = ordered.groupBy("window").agg(F.min(F.struct("count", "token", "offset")).alias("p")).select("window", "p.*").filter("count > 0")
        prefixes = store.materialise(prefixes.select("window", "token", "offset", F.size("window").alias("length")), "prefixes")
        for block in _blocks(prefixes):
            start = F.col("place") - F.col("offset")
            holds = (F.col("token") == _shingle(F.col("place"), width)) & (start >= 0) & (start + F.col("length") <= F.size("w")) & (
                F.slice(F.col("w"), F.greatest(start, F.lit(0)) + 1, F.col("length")) == F.col("window"))
            hits = _places(documents, width).join(F.broadcast(block), holds)
            found.append(hits.select(*keys, "window", start.alias("start"), (start + F.col("length")).alias("end")))
    if not found:
        return documents.select(*keys).limit(0).selectExpr("*", "cast(null as array<string>) window", "cast(null as int) start", "cast(null as int) end")
    return reduce(DataFrame.unionByName, found)


def _token_blocks(tokens: DataFrame) -> list[DataFrame]:
    rows, _ = measure(tokens)
    parts = max(1, -(-rows // BLOCK))
    return [tokens.filter(F.pmod("token", F.lit(parts)) == p) for p in range(parts)]


def covered(found: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., n_hit): places that one of the key's spans covers. A key's
    spans are at most as many as its text's words."""
    spans = found.groupBy(*keys, "start").agg(F.max("end").alias("end"))
    before = W.partitionBy(*keys).orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    new = F.col("end") - F.greatest(F.col("start"), F.coalesce(F.max("end").over(before), F.lit(0)))
    return spans.withColumn("new", F.greatest(new, F.lit(0))).groupBy(*keys).agg(F.sum("new").alias("n_hit"))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", window: int = 10, shingle: int = 3) -> DataFrame:
    """Per document: id, n_words, n_hit (words inside an occurrence of a
    window), n_items (items with such a window) and item_ids (sorted)."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.md5(text_col), F.lit("")).alias("digest"), words(F.col(text_col)).alias("w"))
    rows = store.materialise(rows, "words")
    keys = ["id", "digest"]
    windows = store.materialise(item_windows(items, item_col, item_text, window), "windows")
    found = store.materialise(occurrences(rows, windows.select("window").distinct(), shingle), "occurrences")
    held = found.select(*keys, "window").distinct().join(broadcast_if_small(windows), "window").select(*keys, "item").distinct()
    listed = held.groupBy(*keys).agg(F.array_sort(F.collect_list("item")).alias("item_ids"))
    marked = covered(found, keys).join(listed.withColumnRenamed("id", "id2").withColumnRenamed("digest", "digest2"),
                                       F.col("id").eqNullSafe(F.col("id2")) & (F.col("digest") == F.col("digest2")), "left")
    marked = marked.select(F.col("id").alias("id2"), F.col("digest").alias("digest2"), "n_hit", "item_ids")
    narrow = rows.select(*keys, F.size("w").cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    some = narrow.filter("n_words > 0").join(marked, F.col("id").eqNullSafe(F.col("id2")) & (F.col("digest") == F.col("digest2")), "left")
    some = some.select("id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("item_ids", none).alias("item_ids"))
    # wordless rows, which may be many of one key, need no join
    empty = narrow.filter("n_words = 0").select("id", "n_words", F.lit(0).cast("long").alias("n_hit"), none.alias("item_ids"))
    both = some.unionByName(empty)
    return both.select(F.col("id").alias(id_col), "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), "item_ids")


def q_op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(store.read(spark, sf_dir, "documents"), store.read(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.concat_ws(",", "item_ids"), 256)
    return out.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


SQL_OP12 = r"""
WITH letters AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
asked AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
cut AS (SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS s FROM asked WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, array_to_string(w[s + 1 : s + 10], ' ') AS win, least(len(w), 10) AS n FROM cut),
places AS (
  SELECT r, s, n, array_to_string(w[s + 1 : s + n], ' ') AS win
  FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS s FROM letters, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT p.r, p.s, p.n, v.item_id FROM places p JOIN windows v USING (n, win)),
marked AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(s, s + n)) AS at FROM hits) GROUP BY r),
listed AS (
  SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM letters LEFT JOIN marked USING (r) LEFT JOIN listed USING (r)
"""
