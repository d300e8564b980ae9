"""Secret scans: fixed patterns, and a randomness test battery for the rest.

Everything is DataFrame functions. Three kinds of pattern give the base spans.
Besides, long runs of key characters are candidates: a run is cut at ``=``, and
a piece is tested as it is, without the names before it, and in its parts
between ``-`` and ``_`` (see ``_readings``). A reading's alphabet is inferred, and three tests ask whether it could be a
uniform random string over it: chi-squared on cells of the alphabet, the runs
of its upper and lower half, and the lag-one serial correlation. Their p-values
are joined by Fisher's rule. Longer strings are rejected more easily, so the
Benjamini-Hochberg rule runs in each band of lengths by itself: at most a share
``q`` of the strings called text in a band are random ones. Candidates that are
not rejected are reported as kind ``random``, unless they touch a base span or
lie within another one.

The p-values of all documents enter the rule as counts on a fixed grid of
-log10 p (bounded, whatever the corpus); thresholds reach the driver, one per
band. No span list leaves its row, so nothing is gathered by document.

Defined results: a null or empty text has no spans; rows with equal ids are
rows of their own; offsets are code points, ends exclusive; no documents give
no rows; columns other than id and text are not read (the pipeline stage keeps
them).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from paneltide.llm import store

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "key")
ASSIGN_LEAST = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"  # a match takes all that follows, so short ones hide no longer one
HEX = r"[0-9a-f]{32,}"
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,}"

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# pattern and alphabet, the narrowest first
ENCODINGS = (
    (r"^[0-9]+$", DIGITS), (r"^[0-9a-f]+$", DIGITS + "abcdef"), (r"^[0-9A-F]+$", DIGITS + "ABCDEF"), (r"^[a-z]+$", LOWER), (r"^[A-Z]+$", UPPER), (r"^[A-Z2-7]+$", UPPER + "234567"),
    (r"^[a-z0-9]+$", LOWER + DIGITS), (r"^[A-Z0-9]+$", UPPER + DIGITS), (r"^[A-Za-z]+$", UPPER + LOWER), (r"^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS),
    (r"^[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/"), (r".", UPPER + LOWER + DIGITS + "-_+/"),
)
LEAST = 24
# a piece whose groups are one-case hex or all hold a digit is read without its dashes, too
DASHED = r"^(?:[0-9a-f_-]+|[0-9A-F_-]+|(?:[A-Za-z]*[0-9][A-Za-z0-9]*[_-]+)+[A-Za-z]*[0-9][A-Za-z0-9]*)$"
_WORD = "(?:(?:[A-Z]?[a-z]+|[A-Z]+)[0-9]{0,2}|[0-9]{1,4})"
WORDS = rf"^{_WORD}(?:[_-]+{_WORD})+$"  # a name of several words, tested as a whole only
GRID, GRID_TOP = 50, 15_000  # steps of -log10 p
Q = 0.01


def running(values: Column, block: int = 256) -> Column:
    """Sums of an array's values before each place, in blocks so that long
    arrays aren't copied once per value."""
    last = F.floor(F.greatest(F.size(values) - 1, F.lit(0)) / block).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(values, b * block + 1, block))
    zero = F.array(F.lit(0).cast("long"))
    grow = lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))
    inner = F.transform(blocks, lambda part: F.aggregate(part, zero, grow))
    base = F.aggregate(inner, zero, lambda acc, part: grow(acc, F.element_at(part, -1)))
    return F.flatten(F.transform(inner, lambda part, i: F.transform(
        F.slice(part, 1, F.size(part) - 1), lambda x: x + F.element_at(base, i + 1))))


def matches(text: Column, pattern: str, groups: tuple[int, ...] = ()) -> list[Column]:
    """Arrays: the text before each match (since the last), the match, and the
    groups asked for. \\G keeps a text without a further match from being
    searched again from each of its places."""
    own = rf"(?s)\G(.*?)({pattern})"
    return [F.regexp_extract_all(text, F.lit(own), k) for k in (1, 2, *(g + 2 for g in groups))]


def spans(before: Column, found: Column) -> Column:
    lengths = F.zip_with(before, found, lambda a, b: (F.char_length(a) + F.char_length(b)).cast("long"))
    return F.zip_with(F.zip_with(running(lengths), before, lambda at, a: at + F.char_length(a)), found,
                      lambda start, m: F.struct(start.alias("start"), (start + F.char_length(m)).alias("end"), m.alias("text")))


def _upper_tail(z: Column) -> Column:
    """P(N(0,1) > z) by the rational approximation 26.2.17 of Abramowitz and Stegun."""
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.2316419) * F.abs(z))
    poly = reduce(lambda acc, c: (acc + F.lit(c)) * t, (1.330274429, -1.821255978, 1.781477937, -0.356563782, 0.319381530), F.lit(0.0))
    tail = F.exp(-z * z / 2) * F.lit(0.3989422804014327) * poly
    return F.greatest(F.when(z >= 0, tail).otherwise(F.lit(1.0) - tail), F.lit(1e-300))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def p_random(run: Column) -> Column:
    """Fisher's joined p-value of the three tests for one run of characters."""

    def tests(c: Column) -> Column:
        codes, a, n = c.codes, c.a, c.n
        cells = F.greatest(F.lit(2), F.least(a, F.floor(n / 5).cast("int")))
        count = lambda k: F.size(F.filter(codes, lambda x: F.floor(x * cells / a) == k))
        # cell k holds the codes x with k * a <= x * cells < (k + 1) * a
        width = lambda k: F.ceil((k + 1) * a / cells) - F.ceil(k * a / cells)
        chi = F.aggregate(F.sequence(F.lit(0), cells - 1), F.lit(0.0), lambda acc, k: acc + F.pow(
            count(k) - n * width(k) / a, F.lit(2.0)) / (n * width(k) / a))
        df = (cells - 1).cast("double")
        z_chi = (F.pow(chi / df, F.lit(1 / 3)) - (1 - 2 / (df * 9))) / F.sqrt(2 / (df * 9))

        half = F.transform(codes, lambda x: (x * 2 >= a).cast("int"))
        ones = F.aggregate(half, F.lit(0), lambda acc, x: acc + x).cast("double")
        # against the alphabet's halves, not the run's own: one kind alone is evidence too
        changes = F.aggregate(F.zip_with(F.slice(half, 1, F.size(half) - 1), F.slice(half, 2, F.size(half)), lambda x, y: (x != y).cast("int")),
                              F.lit(0), lambda acc, x: acc + x).cast("double")
        odds = F.floor((a + 1) / 2) / a  # codes x with 2 x >= a are a - ceil(a / 2)
        mid = 2 * odds * (1 - odds) * (n - 1)
        z_runs = (changes - mid) / F.sqrt(F.greatest(mid / 2, F.lit(1e-9)))

        mean = F.aggregate(codes, F.lit(0.0), lambda acc, x: acc + x) / n
        off = F.transform(codes, lambda x: x - mean)
        square = F.aggregate(off, F.lit(0.0), lambda acc, x: acc + x * x)
        lag = F.aggregate(F.zip_with(F.slice(off, 1, F.size(off) - 1), F.slice(off, 2, F.size(off)), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)
        z_lag = F.when(square > 0, (lag / square + 1 / n) * F.sqrt(n)).otherwise(F.sqrt(n))
        two = lambda z: F.least(2 * _upper_tail(F.abs(z)), F.lit(1.0))
        return _let(F.struct(z_chi.alias("c"), z_runs.alias("r"), z_lag.alias("s")), lambda z: _let(
            -(F.ln(_upper_tail(z.c)) + F.ln(two(z.r)) + F.ln(two(z.s))),
            lambda half_x: F.least(F.exp(-half_x) * (1 + half_x + half_x * half_x / 2), F.lit(1.0))))

    body = F.regexp_replace(run, "=+$", "")
    alphabet = reduce(lambda rest, e: F.when(body.rlike(e[0]), F.lit(e[1])).otherwise(rest), reversed(ENCODINGS), F.lit(""))
    return _let(F.struct(body.alias("b"), alphabet.alias("k")), lambda x: _let(
        F.struct(F.transform(F.filter(F.split(x.b, ""), lambda ch: ch != ""), lambda ch: F.instr(x.k, ch) - 1).alias("codes"),
                 F.char_length(x.k).alias("a"), F.char_length(x.b).cast("double").alias("n")), tests))


def _readings(runs: Column) -> Column:
    """All readings of an array of runs (start, end, text): what lies between
    the ``=``, each such piece without its first name or all leading names, its
    parts between dashes, and dashed keys without their dashes. Names of several
    words are read as a whole only."""

    def cut(s: Column, pattern: str) -> Column:
        return F.transform(spans(*matches(s.text, pattern)), lambda x: F.struct(
            (s.start + x.start).alias("start"), (s.start + x.end).alias("end"), x.text.alias("text")))

    def tail(s: Column, name: str) -> Column:
        rest = F.regexp_replace(s.text, name, "")
        return F.struct((s.end - F.char_length(rest)).alias("start"), s.end.alias("end"), rest.alias("text"))

    long = lambda found: F.filter(found, lambda s: F.char_length(s.text) >= LEAST)
    pieces = long(F.flatten(F.transform(runs, lambda s: cut(s, r"[A-Za-z0-9+/_-]+(?:=+$)?"))))
    whole = pieces
    pieces = F.flatten(F.transform(pieces, lambda s: F.array(s, tail(s, "^[A-Za-z]+[_-]+"), tail(s, "^(?:[A-Za-z]+[_-]+)+"))))
    pieces = F.filter(F.array_distinct(long(pieces)), lambda s: ~s.text.rlike(WORDS))
    parts = F.flatten(F.transform(pieces, lambda s: cut(s, r"[A-Za-z0-9+/]+(?:=+$)?")))
    dashed = F.transform(F.filter(pieces, lambda s: s.text.rlike("[_-]") & s.text.rlike(DASHED)), lambda s: F.struct(
        s.start.alias("start"), s.end.alias("end"), F.regexp_replace(s.text, "[_-]", "").alias("text")))
    return F.filter(F.array_distinct(long(F.concat(whole, pieces, parts, dashed))), lambda s: s.text.rlike("[A-Za-z0-9].*[A-Za-z0-9]"))


def _band(n: Column) -> Column:
    return F.least(F.floor(F.log2(n)), F.lit(12)).cast("int")


def scanned(docs: DataFrame, text_col: str) -> DataFrame:
    """Adds ``base`` (spans with their kind's number) and ``runs`` (candidates
    with length band and p-value)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.array().cast("array<struct<start:bigint,end:bigint,text:string>>")
    low = F.lower(text)
    hinted = reduce(lambda a, b: a | b, (F.contains(low, F.lit(h)) for h in ASSIGN_HINTS))
    arrays = F.array().cast("array<string>")

    def add(df: DataFrame, name: str, when: Column, pattern: str, groups=()) -> DataFrame:
        cols = matches(text, pattern, groups)
        return df.withColumns({f"__{name}{k}": F.when(when, c).otherwise(arrays) for k, c in enumerate(cols)})

    df = add(docs, "a", hinted, ASSIGN, (1,))
    df = add(df, "k", F.contains(text, F.lit("AKIA")), ACCESS)
    df = add(df, "h", text.rlike(HEX), HEX)
    df = add(df, "r", text.rlike(RUN), RUN)
    got = lambda x: F.when(F.size(f"__{x}1") > 0, spans(F.col(f"__{x}0"), F.col(f"__{x}1"))).otherwise(none)
    df = df.withColumns({f"__{x}s": got(x) for x in "akhr"})
    kept = F.filter(F.zip_with("__as", "__a2", lambda s, v: F.struct(s.start, s.end, F.char_length(v).alias("n"))), lambda s: s.n >= ASSIGN_LEAST)
    mark = lambda col, k: F.transform(col, lambda s: F.struct(s.start.alias("start"), F.lit(k).alias("kind"), s.end.alias("end")))
    df = df.withColumn("base", F.array_sort(F.concat(mark(kept, 0), mark(F.col("__ks"), 1), mark(F.col("__hs"), 2))))
    free = lambda s: ~F.exists("base", lambda b: (b.start < s.end) & (s.start < b.end))
    runs = F.transform(F.filter(F.when(F.size("__rs") > 0, _readings(F.col("__rs"))).otherwise(none), free), lambda s: F.struct(
        s.start, s.end, _band(F.char_length(s.text)).alias("band"), p_random(s.text).alias("p")))
    df = df.withColumn("runs", F.when(F.size("__rs") > 0, runs).otherwise(F.array().cast("array<struct<start:bigint,end:bigint,band:int,p:double>>")))
    return df.drop(*(f"__{x}{k}" for x in "akhr" for k in (0, 1, 2, "s")))


def thresholds(table: DataFrame, q: float = Q) -> dict[int, float]:
    """For each band of lengths the largest p-value that the Benjamini-Hochberg
    rule rejects, on the grid (a step's larger end stands for the step)."""
    run = table.select(F.explode("runs").alias("r")).select("r.band", "r.p")
    step = F.least(F.floor(-F.log10("p") * GRID), F.lit(GRID_TOP)).cast("int")
    grid = run.groupBy("band", step.alias("step")).agg(F.count("*").alias("n"))
    below = W.partitionBy("band").orderBy(F.desc("step"))
    grid = grid.withColumn("k", F.sum("n").over(below)).withColumn("m", F.sum("n").over(W.partitionBy("band")))
    cut = grid.filter(F.pow(F.lit(10.0), -F.col("step") / GRID) <= q * F.col("k") / F.col("m")).groupBy("band").agg(F.min("step").alias("step"))
    return {r["band"]: 10.0 ** (-r["step"] / GRID) for r in cut.collect()}  # a row per band


def with_spans(table: DataFrame, cuts: dict[int, float]) -> DataFrame:
    """Adds ``all``: base spans and the candidates that stay random, in order."""
    limit = lambda band: reduce(lambda rest, x: F.when(band == x[0], F.lit(x[1])).otherwise(rest), cuts.items(), F.lit(-1.0))
    random = F.transform(F.filter("runs", lambda r: r.p > limit(r.band)), lambda r: F.struct(r.start.alias("start"), F.lit(3).alias("kind"), r.end.alias("end")))
    random = _let(F.array_distinct(random), lambda found: F.filter(found, lambda s: ~F.exists(
        found, lambda o: (o.start <= s.start) & (s.end <= o.end) & (o.end - o.start > s.end - s.start))))
    return table.withColumn("all", F.array_sort(F.concat("base", random)))


def written(found: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(":", F.element_at(names, s.kind + 1), s.start.cast("string"), s.end.cast("string"))))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", q: float = Q) -> DataFrame:
    """doc_id, base, all: the documents' spans (start, kind, end)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    table = store.materialise(scanned(rows, "text").select("doc_id", "base", "runs"), "secrets")
    return with_spans(table, thresholds(table, q)).select("doc_id", "base", "all")


def redact(text: Column, found: Column, mask: str = "[redacted]") -> Column:
    """The text with each maximal run of overlapping spans replaced."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(acc, s):
        fresh = F.concat(acc.out, F.substr(text, acc["at"].cast("int") + 1, F.greatest(s.start - acc["at"], F.lit(0)).cast("int")), F.lit(mask))
        return F.struct(F.when(s.start >= acc["at"], fresh).otherwise(acc.out).alias("out"), F.greatest(acc["at"], s.end).alias("at"))

    return F.aggregate(found, start, step, lambda acc: F.concat(acc.out, F.substr(text, acc["at"].cast("int") + 1, F.char_length(text))))


def redacted(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars", q: float = Q) -> DataFrame:
    """The documents, with all spans masked and the length column, if there is
    one, brought in line. The texts are scanned twice (for the thresholds and
    for the spans) rather than written in between; texts without spans and
    null texts stay as they are."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(text_col).alias("text"))
    table = scanned(rows, "text")
    out = with_spans(table, thresholds(table, q))
    out = out.withColumn("clean", F.when(F.size("all") > 0, redact(F.col("text"), F.col("all"))).otherwise(F.col("text")))
    kind = dict(docs.dtypes)

    def column(c: str) -> Column:
        own = F.col(f"row.`{c}`")
        if c == text_col:
            return F.col("clean").alias(c)
        if c == length_col:
            return F.when(F.size("all") > 0, F.char_length("clean").cast(kind[c])).otherwise(own).alias(c)
        return own.alias(c)

    return out.select(*map(column, docs.columns))


def q_op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(store.read(spark, sf_dir, "documents"))
    number = lambda k: F.size(F.filter("base", lambda s: s.kind == k)).cast("long").alias(f"n_{KINDS[k]}")
    return found.select("doc_id", *(number(k) for k in range(3)), F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("all")).alias("spans"))
