"""Spelling variants: words one edit apart, found by dense tiles of padded
code-point matrices.

Two words are near when one inserted, deleted or replaced code point makes one
the other: the common prefix plus the common suffix then reaches the longer
length less one. Words are rows of a matrix of code points, padded on the right
for prefixes and on the left for suffixes, and a tile compares all pairs of two
blocks of rows at once.

Tiles that can hold no near pair are never built. With a longer word of
``band`` code points, the prefix or the suffix alone covers ``band // 2``. So a
word enters, in its own band and in the next one, the tile of its first and the
tile of its last ``band // 2`` code points, and near words meet in at least one.
A tile of more than ``block`` words is hashed into blocks, and each pair of
blocks is a tile of its own, so no task holds a large tile, and every pair of a
tile is still compared. Rows are streamed tile by tile through Arrow batches;
only near pairs come out. A pair that meets in both of its tiles is taken from
the prefix tile.

Forms: a word's form is its near word of largest count, if that is ``ratio``
times the word's; counts grow along forms, so a chain is at most
log(largest count) / log(ratio) long and doubling pointers ends after a few
joins.

Defined results: null texts, and texts without words, give nothing; repeated
rows count each time; a null id reads as an empty string where ids matter; ties
between near words go to the smallest in code-point order; no words give no
rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltide.llm import store

BLOCK = 1024  # rows of a matrix
PAIRS = 1 << 19  # pairs compared at once
TILE = ["band", "side", "part", "first", "second"]


def matrices(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points padded on the right, padded on the left, and lengths."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    if not len(points) or points.max() < 256:
        points = points.astype(np.uint8)
    width = int(lengths.max(initial=0))
    row = np.repeat(np.arange(len(words)), lengths)
    col = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    left = np.zeros((len(words), width + 1), points.dtype)
    right = np.zeros((len(words), width + 1), points.dtype)
    left[row, col] = points
    right[row, np.repeat(lengths, lengths) - 1 - col] = points  # read from the end
    return left, right, lengths


def compare(left: np.ndarray, right: np.ndarray, lengths: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs (i, j) of different words: which are one edit apart, and
    their common prefixes."""
    prefix = (left[i] != left[j]).argmax(axis=1)
    suffix = (right[i] != right[j]).argmax(axis=1)
    a, b = lengths[i], lengths[j]
    return (np.abs(a - b) <= 1) & (prefix + suffix >= np.maximum(a, b) - 1), prefix


def _partners(tile: np.ndarray, cross: np.ndarray, second: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row, its run of partners (first, count). Rows are sorted by
    tile, block and falling length, so a run is contiguous. Two words that are
    both short meet in the band below."""
    n = len(tile)
    at = np.arange(n)
    starts = np.flatnonzero(np.r_[True, tile[1:] != tile[:-1]])
    ends = np.r_[starts[1:], n]
    group = np.cumsum(np.r_[True, tile[1:] != tile[:-1]]) - 1
    # where a tile's second block begins, and where its (or the only block's) short words begin
    firsts = np.add.reduceat((~second).astype(np.int64), starts)
    middle = np.where(cross[starts], starts + firsts, starts)
    longs = np.add.reduceat((long & (second | ~cross)).astype(np.int64), starts)
    from_ = np.where(cross, middle[group], at + 1)
    to = np.where(long, ends[group], (middle + longs)[group])
    count = np.where(cross & second, 0, np.maximum(to - from_, 0))
    return from_, count


def near_pairs(batches):
    """Rows sorted by TILE, block and falling length -> near pairs with both counts."""
    held: pa.Table | None = None

    def search(table: pa.Table):
        words = table["word"].to_pylist()
        left, right, lengths = matrices(words)
        counts = table["n"].to_numpy()
        band, side = table["band"].to_numpy(), table["side"].to_numpy()
        cross = table["first"].to_numpy() != table["second"].to_numpy()
        from_, count = _partners(_tile_numbers(table), cross, table["block"].to_numpy() == table["second"].to_numpy(), lengths == band)
        upto = np.cumsum(count)
        at = 0
        while at < len(words):
            to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, "right")))
            c = count[at:to]
            i = np.repeat(np.arange(at, to), c)
            j = from_[i] + np.arange(len(i)) - np.repeat(np.cumsum(c) - c, c)
            near, prefix = compare(left, right, lengths, i, j)
            near &= (side[i] == 0) | (prefix < band[i] // 2)
            i, j = i[near], j[near]
            if len(i):
                a, b = table["word"].take(pa.array(i)).combine_chunks(), table["word"].take(pa.array(j)).combine_chunks()
                yield pa.RecordBatch.from_arrays([a, b, pa.array(counts[i]), pa.array(counts[j])], ["word", "near", "n", "near_n"])
            at = to

    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        tiles = _tile_numbers(held)
        last = int(np.searchsorted(tiles, tiles[-1])) if len(tiles) else 0
        if last:  # the last tile may go on in the next batch; a tile has two blocks at most
            yield from search(held.slice(0, last).combine_chunks())
            held = held.slice(last).combine_chunks()
    if held is not None and held.num_rows:
        yield from search(held.combine_chunks())


def _tile_numbers(table: pa.Table) -> np.ndarray:
    change = np.zeros(table.num_rows, bool)
    for name in TILE:
        v = table[name].to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.cumsum(change)


def tiles(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``words`` (word, n) as rows of all tiles that can hold a near pair of theirs."""
    length = F.char_length("word")
    bands = words.select("word", "n", length.alias("length"), F.explode(F.array(length, length + 1)).alias("band"))
    half = F.floor(F.col("band") / 2).cast("int")
    ends = F.array(F.struct(F.lit(0).alias("side"), F.substring("word", F.lit(1), half).alias("half")),
                   F.struct(F.lit(1).alias("side"), F.substring("word", F.col("length") - half + 1, half).alias("half")))
    rows = bands.withColumn("end", F.explode(ends)).select("band", "end.side", F.xxhash64("end.half").alias("part"), "length", "word", "n")
    tile = ["band", "side", "part"]
    sizes = rows.groupBy(*tile).agg(F.count("*").alias("size"), F.max((F.col("length") == F.col("band")).cast("int")).alias("any"))
    # a tile of one word, or of short words only, holds no pair of its band
    rows = rows.join(sizes.filter("size > 1 AND any = 1"), tile)
    blocks = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64(F.reverse("word"), F.lit(block)), blocks).cast("int")
    rows = rows.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return rows.select("band", "side", "part", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "block", "length", "word", "n")


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, near, n, near_n), each near pair once."""
    rows = tiles(words, block).repartition(*TILE).sortWithinPartitions(*TILE, "block", F.desc("length"))
    return rows.drop("length").mapInArrow(near_pairs, "word string, near string, n long, near_n long")


def variants(words: DataFrame, ratio: int = 10, block: int = BLOCK) -> DataFrame:
    """``words`` (word, n), distinct: adds form, root, n_near, form_n."""
    pairs = near_words(words, block)
    both = pairs.select("word", "near", "near_n").unionByName(pairs.select(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("k"), "near")).alias("best"))
    rows = words.join(best, "word", "left")
    follows = -F.col("best.k") >= F.col("n") * ratio
    rows = store.materialise(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(follows, F.col("best.near")).alias("form"),
                                         F.when(follows, -F.col("best.k")).alias("form_n")), "spelling-forms")
    links = rows.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:  # pointers double; a word has few near words, so no root has many links
        step = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = links.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = store.materialise(moved, "spelling-roots")
        links = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            break
    return rows.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST, TWICE, ODD = 7, 2, 31


def counted(docs: DataFrame, least: int = LEAST, times: int = TWICE) -> DataFrame:
    """(word, n) of the runs of letters, some of which lose a code point by rule."""
    # shorter runs give no word of ``least`` code points
    runs = F.regexp_extract_all("text", F.lit(rf"[A-Za-zÀ-ÿ]{{{least},}}"), 0)
    one = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.transform(runs, lambda r: F.translate(r, UPPER, LOWER))).alias("run"))
    hashed = one.withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    word = F.when(F.col("h") % ODD == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))).otherwise(F.col("run"))
    return hashed.select(word.alias("word")).filter(F.char_length("word") >= least).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= times)


def q_op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = store.materialise(counted(store.read(spark, sf_dir, "documents")), "spelling-words")
    return variants(words).select("word", "form", "root", "n", "n_near", "form_n")


# crc32's table follows from its polynomial; near words share what is left after one place is cut out of both, or out of the longer.
SQL_OP13 = r"""
WITH RECURSIVE shifts AS (
  SELECT i AS b, 0 AS k, i::BIGINT AS c FROM range(256) t(i)
  UNION ALL
  SELECT b, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM shifts WHERE k < 8),
steps AS (SELECT list(c ORDER BY b) AS t FROM shifts WHERE k = 8),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]{7,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
distinct_runs AS (SELECT doc_id, run, count(*) AS n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS s FROM runs GROUP BY doc_id, run),
bytes AS (
  SELECT run, n, flatten(list_transform(string_split(s, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
         ELSE [(192 + unicode(c) // 64)::BIGINT, (128 + unicode(c) % 64)::BIGINT] END)) AS b
  FROM distinct_runs),
hashed AS (
  SELECT run, n, xor(list_reduce(list_concat([4294967295::BIGINT], b), lambda x, y: xor(x // 256, t[xor(x % 256, y) + 1])), 4294967295) AS h
  FROM bytes, steps),
cut AS (
  SELECT CASE WHEN h % 31 = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 : ] ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cuts AS (SELECT word, n, i, word[1 : i] || word[i + 2 : ] AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cuts c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word, c.n FROM cuts c JOIN words w ON c.rest = w.word),
best AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form, CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
chains AS (
  SELECT word, word AS at, form AS next FROM forms
  UNION ALL
  SELECT c.word, f.word, f.form FROM chains c JOIN forms f ON f.word = c.next)
SELECT f.word, form, c.at AS root, n, n_near, form_n FROM forms f JOIN chains c ON c.word = f.word AND c.next IS NULL
"""
