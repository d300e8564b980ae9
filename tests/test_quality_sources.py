"""Quality checks with planted failures (a check that cannot fail is not a
test), source/sink round trips, and the filter / join edge rules."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneltide.operators import filters as flt
from paneltide.operators import quality as q
from paneltide.operators.joins import align, validate_keys
from paneltide.sources import bronze as B
from paneltide.sources.contracts import SILVER_CONTRACT


@pytest.fixture()
def panel(spark):
    rows = [("USA", "United States", 2000, 10.0, True), ("USA", "United States", 2001, 12.0, False),
            ("CHN", None, 2000, None, True), ("CHN", "China", 1700, 3.0, False),
            ("CHN", "China", 1700, 4.0, None)]
    return spark.createDataFrame(rows, "iso_code string, country string, year int, co2 double, flag boolean")


def _res(df):
    return {(r.check_name, r.column_name): (r.passed, r.observed) for r in df.collect()}


def test_every_check_kind_can_fail(spark, panel):
    checks = [q.exists("co2"), q.exists("missing"), q.column_count(5), q.column_count(6),
              q.not_null("country"), q.not_null("iso_code"), q.between("year", 1750, 2030),
              q.row_count(10, None), q.row_count(1, 10), q.distinct_at_least("iso_code", 3),
              q.accepted("flag", [True]), q.unique(["iso_code", "year"]),
              q.not_null("co2", where="year > 1800", severity="warn"),
              q.share_at_least("treated", "flag = TRUE", 0.5), q.custom("neg", "co2 < 0"),
              q.has_type("year", "int"), q.has_type("year", "bigint")]
    r = _res(q.run_suite(panel, "t", checks))
    assert r[("exists", "co2")] == (True, 1) and r[("exists", "missing")] == (False, 0)
    one = lambda check: next(iter(_res(q.run_suite(panel, "t", [check])).values()))
    assert one(q.column_count(5)) == (True, 5) and one(q.column_count(6)) == (False, 5)
    assert one(q.row_count(10, None)) == (False, 5) and one(q.row_count(1, 10)) == (True, 5)
    assert r[("not_null", "country")] == (False, 1)
    assert r[("not_null", "iso_code")] == (True, 0)
    assert r[("between", "year")] == (False, 2)
    assert r[("distinct_at_least", "iso_code")] == (False, 2)
    assert r[("accepted", "flag")] == (False, 2)          # NULL passes, two FALSE fail
    assert r[("unique", "iso_code,year")] == (False, 1)
    assert r[("not_null", "co2")] == (False, 1)            # the warn-level conditional check
    assert r[("treated", None)] == (False, 4000)           # 2 of 5 rows in basis points
    assert r[("neg", None)] == (True, 0)
    assert one(q.has_type("year", "int")) == (True, 1) and one(q.has_type("year", "bigint")) == (False, 0)


def test_missing_column_fails_without_error(spark, panel):
    r = _res(q.run_suite(panel, "t", [q.not_null("nope"), q.unique(["nope"])]))
    assert r[("not_null", "nope")] == (False, None)
    assert r[("unique", "nope")] == (False, None)


def test_contract_checks_and_gate(spark, panel):
    res = q.run_suite(panel, "silver", q.contract_checks(SILVER_CONTRACT))
    with pytest.raises(q.QualityGateError):
        q.gate(res)
    ok = q.run_suite(panel, "t", [q.not_null("iso_code"), q.row_count(1, None)])
    q.gate(ok)


def test_drop_aggregates_three_layers(spark):
    df = spark.createDataFrame(
        [("France", "FRA"), ("World", "WLD"), ("High income", "XXX"), ("Asia (excl. China and India)", None),
         (None, "ABC"), ("Non-OECD (GCP)", "X1"), ("Atlantis", "OWID_WRL"), ("Chad", None)],
        "name string, code string")
    kept = sorted(r.name for r in flt.drop_aggregates(df, "name", "code").collect())
    assert kept == ["Chad", "France"]


def test_non_negative_keeps_unknown(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (None,), (3.0,)], "co2 double")
    assert sorted([r.co2 for r in flt.non_negative(df, "co2").collect()], key=lambda v: (v is None, v)) == [0.0, 3.0, None]


def test_min_history_reports_short_series(spark):
    df = spark.createDataFrame([("a", t, 1.0) for t in range(6)] + [("b", t, 1.0) for t in range(3)] + [("b", 9, None)],
                               "k string, t int, y double")
    rows, status = flt.min_history(df, "k", 5, "y")
    st = {r.k: (r.n_points, r.eligible) for r in status.collect()}
    assert st == {"a": (6, True), "b": (3, False)}
    assert {r.k for r in rows.collect()} == {"a"}


def test_validate_keys_and_align(spark):
    req = spark.createDataFrame([("USA",), ("XXX",)], "code string")
    known = spark.createDataFrame([("USA",), ("CHN",)], "code string")
    assert [r.code for r in validate_keys(req, known, "code").collect()] == ["XXX"]
    fc = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 1.0), ("b", 2, 1.0)], "k string, step int, f double")
    ac = spark.createDataFrame([("a", 1, 1.5), ("a", 2, 2.5), ("b", 1, 1.0)], "k string, step int, y double")
    assert sorted(r.k for r in align(fc, ac, "k").collect()) == ["a", "a"]


def test_append_bronze_same_day_replaces(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bronze")
    a = spark.createDataFrame([("USA", 2000, 1.0)], "iso_code string, year int, co2 double")
    b = spark.createDataFrame([("USA", 2000, 2.0), ("CHN", 2000, 3.0)], "iso_code string, year int, co2 double")
    B.append_bronze(B.stamp(a, "src", "2024-01-01T00:00:00.000000+00:00"), path, "2024-01-01")
    B.append_bronze(B.stamp(a, "src", "2024-01-02T00:00:00.000000+00:00"), path, "2024-01-02")
    B.append_bronze(B.stamp(b, "src", "2024-01-02T01:00:00.000000+00:00"), path, "2024-01-02")  # rerun
    df = B.read_bronze(spark, path)
    days = {str(r.ingestion_date): r.n for r in df.groupBy("ingestion_date").agg(F.count("*").alias("n")).collect()}
    assert days == {"2024-01-01": 1, "2024-01-02": 2}
    latest = B.latest_snapshot(df)
    assert sorted(r.co2 for r in latest.collect()) == [2.0, 3.0]


def test_read_any_and_csv(spark, tmp_dir):
    p = os.path.join(tmp_dir, "x.csv")
    with open(p, "w") as f:
        f.write("iso_code,year,co2\nUSA,2000,1.5\nCHN,n/a,2.0\n")
    df = B.read_any(spark, p)
    assert df.count() == 2
    out = os.path.join(tmp_dir, "layer")
    B.write_layer(df, out)
    assert B.read_any(spark, out).count() == 2
    with pytest.raises(ValueError):
        B.read_any(spark, os.path.join(tmp_dir, "x.txt"))


def test_stamp_iso_utc(spark):
    r = B.stamp(spark.range(1), "u").first()
    assert r._source_url == "u" and r._ingested_at.endswith("+00:00") and "T" in r._ingested_at


def test_materialise_modes(spark, tmp_dir):
    df = spark.range(3)
    assert B.materialise(df, "v_tmp", "view").count() == 3
    assert spark.table("v_tmp").count() == 3
    assert B.materialise(df, "e", "ephemeral") is df
    assert B.materialise(df, "t_tmp", "table", os.path.join(tmp_dir, "t")).count() == 3
    with pytest.raises(ValueError):
        B.materialise(df, "x", "table")


def test_normalise_indicators_drops_bad_year_and_unknown_name(spark):
    raw = spark.createDataFrame([("France", "2000", 1.0), ("France", "n/a", 2.0), ("Narnia", "2001", 3.0),
                                 ("World", "2000", 4.0)], "country string, date string, `NY.GDP.MKTP.KD.ZG` double")
    lookup = spark.createDataFrame([("France", "FRA")], "name string, id string")
    out = B.normalise_indicators(raw, lookup, renames=B.INDICATOR_CODES).collect()
    assert [(r.iso_code, r.year, r.gdp_growth_pct) for r in out] == [("FRA", 2000, 1.0)]


def test_ratifications_dimension(spark):
    df = B.ratifications(spark, "2024-01-01T00:00:00.000000+00:00")
    assert df.count() == 40
    years = list(df.agg(F.min("ratification_year"), F.max("ratification_year")).first())
    assert years == [2016, 2021]


def test_register_source_and_sql_model(spark, tmp_dir):
    p = os.path.join(tmp_dir, "silver")
    spark.createDataFrame([("USA", 2000, 1.0)], "iso_code string, year int, co2 double").write.parquet(p)
    B.register_source(spark, "silver_src", p)
    assert spark.sql("SELECT count(*) FROM silver_src WHERE year >= 1960").first()[0] == 1


def test_fill_zero_round_and_built_at(spark):
    from paneltide.functions.exprs import fill_zero
    from paneltide.operators.projection import round_cols
    from paneltide.plans.layers import gold_features
    from paneltide.sources.contracts import GOLD, SILVER

    df = spark.createDataFrame([(None,), (2,)], "x int")
    assert [r[0] for r in df.select(fill_zero("x")).collect()] == [0.0, 2.0]
    r = round_cols(spark.createDataFrame([(1.2345, 2.5)], "a double, b double"), ["a"], 2).first()
    assert r.a == 1.23 and r.b == 2.5
    silver = spark.createDataFrame([], SILVER)
    g = gold_features(silver)
    assert [f.name for f in g.schema.fields] == [f.name for f in GOLD.fields]


def test_utc_stamp_and_day_in_another_zone(spark):
    from paneltide.sources.bronze import iso_utc, utc_day

    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        r = spark.range(1).select(iso_utc(F.timestamp_seconds(F.lit(0))).alias("s"), utc_day(F.timestamp_seconds(F.lit(0))).cast("string").alias("d")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert r.s == "1970-01-01T00:00:00.000000+00:00" and r.d == "1970-01-01"


def test_year_text_and_repeated_lookup_names(spark):
    from paneltide.sources.bronze import normalise_indicators

    raw = spark.createDataFrame([("A", "2001.0", 1.0), ("A", "2002", 2.0), ("A", "n/a", 3.0), ("A", "2003.5", 4.0), ("B", "2001", 5.0)],
                                "country string, date string, v double")
    lookup = spark.createDataFrame([("A", "AAA"), ("A", "AAB")], "name string, id string")
    got = normalise_indicators(raw, lookup).collect()
    assert sorted((r.year, r.v, r.iso_code) for r in got) == [(2001, 1.0, "AAB"), (2002, 2.0, "AAB")]


def test_read_any_keeps_the_schema(spark, tmp_dir):
    from pyspark.sql import types as T
    from paneltide.sources.bronze import read_any

    spark.range(3).select(F.col("id").alias("a")).write.parquet(f"{tmp_dir}/x.parquet")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    for path in (f"{tmp_dir}/x.parquet", f"file://{tmp_dir}/x.parquet"):
        assert read_any(spark, path, schema).columns == ["a", "b"]
    spark.range(2).withColumn("ingestion_date", F.to_date(F.lit("2024-01-01"))).write.partitionBy("ingestion_date").parquet(f"{tmp_dir}/folder")
    assert set(read_any(spark, f"{tmp_dir}/folder").columns) == {"id", "ingestion_date"}
    with pytest.raises(ValueError):
        read_any(spark, f"{tmp_dir}/x.xlsx")


def test_newest_day_is_read_off_the_listing(spark, tmp_dir):
    from paneltide.sources.bronze import read_latest

    path = f"{tmp_dir}/days"
    for day in ("2024-01-01", "2024-01-03", "2024-01-02"):
        spark.createDataFrame([(day,)], "d string").withColumn("ingestion_date", F.to_date(F.lit(day))) \
            .write.mode("append").partitionBy("ingestion_date").parquet(path)
    got = read_latest(spark, path)
    assert [r.d for r in got.collect()] == ["2024-01-03"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "Subquery" not in plan and "2024-01-03" in plan.replace("19725", "2024-01-03")


def test_labels_and_missing_columns_in_suites(spark):
    from paneltide.operators import quality as q

    df = spark.createDataFrame([(1,)], "a int")
    got = {r.check_name: (r.passed, r.observed) for r in q.run_suite(df, "s", [
        q.custom("it's fine", "a < 0"), q.custom("gone", "b < 0"), q.share_at_least("share", "c = 1", 0.5)]).collect()}
    assert got == {"it's fine": (True, 0), "gone": (False, None), "share": (False, None)}


def test_measure_sees_a_file_that_has_grown(spark, tmp_dir):
    from paneltide.operators.joins import measure

    path = f"{tmp_dir}/dim"
    spark.range(10).write.parquet(path)
    assert measure(spark.read.parquet(path))[0] == 10
    spark.range(500).write.mode("overwrite").parquet(path)
    assert measure(spark.read.parquet(path))[0] == 500


def test_commit_log_of_a_snapshot_directory(spark, tmp_dir, monkeypatch):
    """An empty rerun empties its day; a half-written day isn't read; days from
    before the log stay; the newest day with rows is the one scanned."""
    from paneltide.plans.layers import build_silver
    from paneltide.sources import commits

    path = f"{tmp_dir}/bronze"
    frame = lambda *v: spark.createDataFrame([(x, f"s{x}") for x in v], "v int, s string")
    seen = lambda: sorted((str(r.ingestion_date), r.v) for r in B.read_bronze(spark, path).collect())
    frame(0).withColumn("ingestion_date", F.lit("2023-12-31").cast("date")).write.partitionBy("ingestion_date").parquet(path)
    B.append_bronze(frame(1, 2), path, "2024-01-01")
    B.append_bronze(frame(3), path, "2024-01-02")
    assert seen() == [("2023-12-31", 0), ("2024-01-01", 1), ("2024-01-01", 2), ("2024-01-02", 3)]
    assert B.read_bronze(spark, path).columns == ["v", "s", "ingestion_date"]

    before = seen()
    with monkeypatch.context() as m:  # the run dies after its files and before its commit
        m.setattr(commits, "_write", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            B.append_bronze(frame(8, 9), path, "2024-01-02")
        with pytest.raises(RuntimeError):
            B.append_bronze(frame(8, 9), path, "2024-01-03")
    assert seen() == before and [r.v for r in B.read_latest(spark, path).collect()] == [3]

    B.append_bronze(frame(), path, "2024-01-02")  # an empty rerun
    assert seen() == before[:-1] and sorted(r.v for r in B.read_latest(spark, path).collect()) == [1, 2]
    B.append_bronze(frame(5), path, "2023-12-31")  # an adopted day is replaced
    assert seen() == [("2023-12-31", 5), ("2024-01-01", 1), ("2024-01-01", 2)]
    B.append_bronze(frame(7), path, "2024-01-02")
    assert seen()[-1] == ("2024-01-02", 7)
    schema = T.StructType([T.StructField("v", T.IntegerType()), T.StructField("s", T.StringType())])
    assert B.read_bronze(spark, path, schema).columns == ["v", "s", "ingestion_date"]

    latest = B.read_latest(spark, path)
    assert latest.count() == 1 and all("ingestion_date=2024-01-02/load=" in f for f in latest.inputFiles())
    empty = f"{tmp_dir}/empty"
    B.append_bronze(frame(), empty, "2024-01-01")
    assert B.read_bronze(spark, empty).count() == 0 and B.read_latest(spark, empty).columns == ["v", "s", "ingestion_date"]

    silver = f"{tmp_dir}/emissions"
    rows = lambda co2: spark.createDataFrame([("USA", "United States", 2000, co2)], "iso_code string, country string, year int, co2 double")
    B.append_bronze(rows(1.0), silver, "2024-01-01")
    B.append_bronze(rows(2.0), silver, "2024-01-02")
    other = spark.createDataFrame([], "iso_code string, year int, gdp_growth_pct double, urban_population_pct double, manufacturing_pct_gdp double")
    events = spark.createDataFrame([("USA", 2016)], "iso_code string, ratification_year int")
    built = build_silver(silver, other, events)
    assert [r.co2 for r in built.collect()] == [2.0] and all("2024-01-02" in f for f in built.inputFiles())
