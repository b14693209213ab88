import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import aggregates as agg
from millrace.operators import documents as docs
from millrace.operators import missing, quality, series, split
from millrace.operators import relational as rel
from millrace.session import settle


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows in one group, some gaps, unique order."""
    rnd = random.Random(7)
    rows = [
        (i, "hot" if i % 3 == 0 else f"k{i % 17}", None if rnd.random() < 0.6 else float(rnd.randint(1, 99)))
        for i in range(3000)
    ]
    return spark.createDataFrame(rows, "id long, k string, v double").repartition(8)


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("piece_rows", [5, 150, 10_000])
def test_split_windows_equal_plain_ones(skewed, rows, keys, piece_rows):
    order = F.col("id")
    w = Window.partitionBy(*keys).orderBy("id")
    plain = skewed.select(
        "id", F.row_number().over(w).alias("n"), F.sum("v").over(w).alias("s"),
        F.last("v", ignorenulls=True).over(w).alias("p"),
        F.first("v", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("x"),
    )
    numbered = split.numbered(skewed, keys, [order], "n", order, piece_rows).select("id", "n")
    totals = split.running_total(skewed, keys, [order], "v", "s", order, piece_rows).select("id", "s")
    near = split.neighbours(skewed, keys, "id", "v", order, piece_rows=piece_rows).select(
        "id", F.col("__prev")["v"].alias("p"), F.col("__next")["v"].alias("x")
    )
    assert rows(numbered.join(totals, "id").join(near, "id").select("id", "n", "s", "p", "x")) == rows(plain)


def test_only_long_groups_are_cut(skewed):
    pieces, many = split.cut(skewed, ["k"], F.col("id"), 200)
    sizes = pieces.groupBy("k", split.PIECE).count().collect()
    assert many and max(r["count"] for r in sizes) < 400
    assert {r["k"] for r in sizes if r[split.PIECE] > 0} == {"hot"}
    assert split.cut(skewed, ["k"], F.col("id"))[1] is False


def test_null_keys_form_a_group(spark, rows):
    df = spark.createDataFrame([(i, None if i % 2 else "a") for i in range(40)], "id long, k string")
    for piece_rows in (4, 1000):
        out = split.numbered(df, ["k"], [F.col("id")], "n", F.col("id"), piece_rows)
        assert sorted(r["n"] for r in out.filter("k is null").collect()) == list(range(1, 21))


def test_two_step_search(spark):
    cuts = [float(i) for i in range(1, 1000)]
    df = spark.range(1200).select(F.col("id").cast("double").alias("x"))
    got = df.select("x", split.bucket_of(F.col("x"), cuts).alias("b")).collect()
    assert all(r["b"] == min(int(r["x"]), 999) for r in got)


def test_codes_of_many_values(spark):
    df = spark.range(500).select(F.concat(F.lit("same prefix "), F.col("id").cast("string")).alias("c"))
    cuts = split.sampled_cuts(df, "c", 8)
    sizes = [r["n"] for r in df.groupBy(split.bucket_of(F.col("c"), cuts).alias("b")).agg(F.count("*").alias("n")).collect()]
    assert len(cuts) >= 7 and max(sizes) < 120
    for piece_rows in (60, 10_000):
        codes = rel.category_codes(df, "c", "code", piece_rows).orderBy("c").collect()
        assert [r["code"] for r in codes] == list(range(500))


def test_hot_key_is_split_by_adaptive_execution(spark):
    """Joining group results back to a table with a hot key: the hot partition is read in parts."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 60_000, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"),
            F.xxhash64("id").alias("x"),
        )
        keys = rows.filter("v % 2 = 0").select(F.col("k").alias("kk"))
        for out in (rel.partition_mean(rows, ["k"], "v", "m"), rel.semi(rows, keys, "k", "kk")):
            out.write.format("noop").mode("overwrite").save()
            out.count()
            collected = out.collect()
            assert len(collected) > 20_000
            assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_category_codes_null(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("b",)], "c string")
    assert sorted(rel.category_codes(df, "c", "n").collect(), key=repr) == [("a", 0), ("b", 1), ("b", 1), (None, -1)]


def test_unique_names(spark, rows):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, "x")], "id int, name string")
    assert rows(rel.unique_names(df, "name", "id", "out").select("id", "out")) == [(1, "x"), (2, "x-2"), (3, "y"), (4, "x-3")]


def test_match_row_value_raises_on_two_probes(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, c string")
    assert rel.match_row_value(df, df.filter("id = 3"), ["c"]).count() == 1
    assert rel.match_row_value(df, df.filter("id = 9"), ["c"]).count() == 0
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        rel.match_row_value(df, df.filter("c = 'a'"), ["c"]).collect()


def test_rank_keeps_ties(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 3), ("b", 2)], "k string, v int")
    assert rel.top_n_per_group(df, ["k"], [F.desc("v")], 1, "r", ties=True).count() == 3
    assert rel.top_n_per_group(df, ["k"], [F.desc("v")], 1, "r").count() == 2


def test_lag_defaults(spark):
    df = spark.sql("select 1 as k, date'2024-01-01' as d, cast(5 as decimal(10,2)) as a union all select 1, date'2024-01-04', 7")
    out = agg.days_since_previous(agg.lag_diff(df, ["k"], ["d"], "a", "a"), ["k"], "d", "gap").orderBy("d").collect()
    assert [(float(r["previous_a"]), float(r["a_difference"]), r["gap"]) for r in out] == [(0.0, 5.0, 0), (5.0, 2.0, 3)]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,), (None,)], "x double")
    counts = {r["bin"]: r["n"] for r in agg.histogram(df, "x", 2).collect()}
    assert counts == {1: 2, 2: 1}
    same = spark.createDataFrame([(4.0,), (4.0,)], "x double")
    assert {r["bin"]: r["n"] for r in agg.histogram(same, "x", 20).collect() if r["n"]} == {10: 2}


def test_primes(spark):
    df = spark.range(1000)
    got = {r["range_start"]: r["n"] for r in agg.count_in_ranges(df, "id", 500, agg.is_prime).collect()}
    assert got == {0: 95, 500: 73}


@pytest.mark.parametrize("n", [1, 2, 101, 5000])
def test_exact_quantile(spark, n):
    rnd = random.Random(n)
    values = [rnd.choice([1.5, rnd.random() * 100]) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    ordered = sorted(values)
    want = (ordered[(n - 1) // 2] + ordered[n // 2]) / 2
    assert agg.exact_quantile(df, "x", 0.5, accuracy=50) == pytest.approx(want)
    assert agg.exact_quantile(df.filter("x is null"), "x") is None


def test_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([("B",), ("A",), (None,), ("B",), ("A",)], "c string")
    assert agg.mode_of(df, "c").first()[0] == "A"


def test_fill_cases(spark):
    numbers = spark.createDataFrame([(1.0,), (2.0,), (None,), (4.0,), (100.0,), (None,)], "x double")
    assert [r[0] for r in missing.impute(numbers, {"x": "median"}).collect()] == [1, 2, 3, 4, 100, 3]
    assert [r[0] for r in missing.replace_where(numbers, "x", F.col("x") >= 50, 999.0).collect()] == [1, 2, 999, 4, 999, 999]
    grid = spark.createDataFrame([(1.0, 2.0, None), (4.0, None, 6.0)], "a double, b double, c double")
    assert [tuple(r) for r in missing.impute(grid, {c: "mean" for c in "abc"}).collect()] == [(1, 2, 6), (4, 2, 6)]
    assert {r["column_name"]: r["n_missing"] for r in missing.null_profile(grid, list("abc")).collect()} == {"a": 0, "b": 1, "c": 1}
    assert [r["row_missing"] for r in missing.missing_mask(grid, list("abc")).collect()] == [1, 1]
    assert missing.drop_null_columns(grid).columns == ["a"]


def test_drop_half_missing(spark):
    rows = [(1.0, None, 3.0), (None, None, 6.0), (7.0, 8.0, None), (10.0, 11.0, 12.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    assert [tuple(r) for r in missing.drop_rows(df, list("abc"), 0.5).collect()] == [rows[0], rows[2], rows[3]]
    assert missing.drop_rows(df, list("abc")).count() == 1
    assert missing.nan_to_null(spark.createDataFrame([(float("nan"),)], "x double")).first()[0] is None


def test_resample_empty_periods(spark):
    df = spark.sql("select date'2024-01-05' as d, 1 as s, 1 as m union all select date'2024-03-07', 2, 2")
    out = series.resample(df, "d", "ME", {"s": "sum", "m": "max"}).orderBy("label").collect()
    assert [tuple(r) for r in out] == [
        (dt.date(2024, 1, 31), 1, 1), (dt.date(2024, 2, 29), 0, None), (dt.date(2024, 3, 31), 2, 2)
    ]
    half = series.spine(spark, "2024-01-01 00:10", "2024-01-01 01:40", "30min").collect()
    assert [r[0].minute for r in half] == [0, 30, 0, 30]
    weeks = [r[0] for r in series.spine(spark, "2024-01-01", "2024-01-15", "W").collect()]
    assert weeks == [dt.date(2024, 1, 7), dt.date(2024, 1, 14), dt.date(2024, 1, 21)]


def test_interpolation_edges(spark):
    days = [(dt.date(2024, 1, d), v) for d, v in [(30, None), (31, 1.0)]] + [
        (dt.date(2024, 2, d), v) for d, v in [(1, None), (2, None), (4, 5.0), (5, None)]
    ]
    df = spark.createDataFrame(days, "d date, v double")
    both = [r["o"] for r in series.interpolate(df, "d", "v", "o").orderBy("d").collect()]
    assert both == pytest.approx([1.0, 1.0, 2.0, 3.0, 5.0, 5.0])
    forward = [r["o"] for r in series.interpolate(df, "d", "v", "o", edges="forward").orderBy("d").collect()]
    assert forward[0] is None and forward[1:] == pytest.approx(both[1:])
    assert [r["o"] for r in series.ffill(df, "d", "v", "o").orderBy("d").collect()] == [None, 1.0, 1.0, 1.0, 5.0, 5.0]


def test_document_conditions(spark):
    df = spark.createDataFrame([(1, "0.5", 200), (2, "1.5", None), (3, "-", 404)], "id int, t string, s int")
    assert [r["id"] for r in docs.find(df, {"t": {"$gt": 0.1}}).collect()] == [1, 2]
    assert [r["id"] for r in docs.find(df, {"s": {"$gte": 200, "$lt": 404}}).collect()] == [1]
    assert docs.find(df, {}).count() == 3
    assert [r["id"] for r in docs.find(df, {"s": None}).collect()] == [2]
    assert docs.delete_where(df, F.col("s") > 100).count() == 1
    assert tuple(docs.delete_report(df, F.col("s") > 100).first()) == (2, 1)


def test_apply_changes_rules(spark, rows):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, None, 3)], "id int, c string, n int")
    new = spark.createDataFrame(
        [(1, "update", None, 9), (2, "delete", None, None), (4, "insert", "d", 4), (3, "insert", "x", 0), (8, "update", "y", 1),
         (9, "delete", None, None)],
        "id int, op string, c string, n int",
    )
    assert rows(docs.apply_changes(old, new, "id", "op")) == [(1, "a", 9), (3, None, 3), (4, "d", 4)]
    assert rows(docs.affected(old, new, "id", "op")) == [("delete", 2, 1), ("insert", 2, 1), ("update", 2, 1)]


def test_insert_numbered_and_keyed_append(spark, rows):
    old = spark.createDataFrame([(5, "a")], "id int, name string")
    new = spark.createDataFrame([("b",), ("c",)], "name string").withColumn("o", F.when(F.col("name") == "b", 1.0).otherwise(2.0))
    both = docs.insert_numbered(old.withColumn("o", F.lit(0.0)), new, "id", "o")
    assert rows(both.select("id", "name")) == [(5, "a"), (6, "b"), (7, "c")]
    batch = spark.createDataFrame([(5, "z"), (6, "y"), (6, "x")], "id int, name string")
    assert rows(docs.keyed_append(old, batch, "id", "name")) == [(5, "a"), (6, "x")]


def test_revision(spark):
    df = docs.with_ids(spark.createDataFrame([("i", None)], "log_type string, ip string"))
    revised = docs.derive_revision(df, "_id", {"ip": F.lit("1.1.1.1")}, "ref")
    assert revised.first()["ref"] == df.first()["_id"] != revised.first()["_id"]


def test_update_one(spark):
    df = spark.createDataFrame([(2, "x"), (1, "x"), (0, "y")], "id int, k string")
    out = docs.update_one(df, F.col("k") == "x", "id", {"flag": F.lit(True), "k": F.lit("z")})
    assert sorted(tuple(r) for r in out.collect()) == [(0, "y", None), (1, "z", True), (2, "x", None)]


def test_drop_database_guard(spark):
    with pytest.raises(ValueError, match="default"):
        docs.drop_database(spark, "default")
    spark.sql("create database extra_db")
    assert "extra_db" in quality.user_databases(spark)
    docs.drop_database(spark, "extra_db")
    assert "extra_db" not in quality.user_databases(spark)


def test_reconcile(spark, rows):
    a = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    b = spark.createDataFrame([(1,), (3,)], "k int")
    assert rows(quality.reconcile(a, b, "k")) == [(1, 2, 1), (2, 1, 0), (3, 0, 1)]


def test_append_all_and_sample(spark):
    a, b = spark.range(3), spark.range(2).withColumn("x", F.lit(1))
    assert rel.append_all(a, b).columns == ["id", "x"]
    big = spark.range(100)
    one = rel.sample_exact(big, "id", 5, 1).collect()
    assert one == rel.sample_exact(big.repartition(3), "id", 5, 1).collect() and len(one) == 5


def test_null_order_values_stay_beyond_64_cuts(spark, rows):
    from millrace.operators import series, split

    data = [(i, i % 3, None if i % 10 == 0 else f"2024-01-01 00:{i // 60:02d}:{i % 60:02d}", None if i % 4 else float(i)) for i in range(1000)]
    df = spark.createDataFrame(data, "id int, k int, at string, v double").withColumn("at", F.col("at").cast("timestamp_ntz"))
    whole, cut = (series.ffill(df, "at", "v", "out", ["k"], piece_rows=n) for n in (10**6, 3))
    known = lambda d: rows(d.filter("at IS NOT NULL").select("id", "out"))
    assert cut.count() == 1000 and len(known(whole)) == 900
    order = [F.col("at"), F.col("id")]
    micros = F.unix_micros(F.col("at").cast("timestamp"))
    for n in (10**6, 3):
        numbered = split.numbered(df, ["k"], order, "n", micros, piece_rows=n)
        assert rows(numbered.groupBy("k").agg(F.min("n"), F.max("n"), F.countDistinct("n"))) == [
            (k, 1, m, m) for k, m in ((0, 334), (1, 333), (2, 333))]
        total = split.running_total(df, ["k"], order, "id", "s", micros, piece_rows=n)
        assert rows(total.groupBy("k").agg(F.max("s"))) == [(k, sum(range(k, 1000, 3))) for k in range(3)]


def test_names_that_are_taken(spark, rows):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x-2"), (4, "x"), (5, "x-2"), (6, None), (7, "x-2-2"), (8, None)], "id int, name string")
    out = rows(rel.unique_names(df, "name", "id", "out").select("id", "out"))
    names = [n for _, n in out if n is not None]
    assert len(out) == 8 and len(set(names)) == 6 and {1, 3, 7} <= {i for i, n in out if n in ("x", "x-2", "x-2-2")}


def test_nan_is_a_gap(spark, rows):
    from millrace.operators import missing

    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b"), (3.0, "b")], "v double, s string")
    assert rows(missing.null_profile(df, ["v", "s"])) == [("s", 1, 4), ("v", 2, 4)]
    assert rows(missing.impute(df, {"v": "mean"}).select("v")) == [(1.0,), (2.0,), (2.0,), (3.0,)]
    assert missing.drop_rows(df, ["v", "s"], 0.5).count() == 2
    assert missing.drop_null_columns(df).columns == []


def test_small_values_keep_their_places(spark):
    df = spark.createDataFrame([(1, 0.001), (1, 0.002), (1, 0.004)], "k int, v double")
    assert rel.partition_mean(df, ["k"], "v", "m").first()["m"] == pytest.approx(0.007 / 3)


def test_changes_of_one_key(spark, rows):
    from millrace.operators import documents

    stored = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    batch = spark.createDataFrame([("a", 5, "update", 1), ("a", 6, "update", 2), ("b", None, "delete", None), ("c", 1, "insert", 1)],
                                  "k string, v int, op string, at int")
    assert rows(documents.apply_changes(stored, batch, "k", "op", sequence="at")) == [("a", 6), ("c", 1)]
    with pytest.raises(Exception, match="two changes of key a"):
        documents.apply_changes(stored, batch, "k", "op").collect()
    fresh = spark.createDataFrame([("d", None, 1), ("d", 4, 2), (None, 1, 3), ("e", None, 7)], "k string, at int, v int")
    none = spark.createDataFrame([], "k string, at int, v int")
    assert rows(documents.new_keys_only(none, fresh, "k", "at")) == [("d", 4, 2), ("e", None, 7)]


def test_large_primes(spark):
    from millrace.operators.aggregates import is_prime

    numbers = [0, 1, 2, 3, 997, 1009 * 1013, 999_999_999_989, 3_215_031_751, 10**12 + 39, 2**61 - 1, 2**61 + 1, 1_000_003]
    df = spark.createDataFrame([(n,) for n in numbers], "n long")
    got = {r["n"] for r in df.filter(is_prime("n")).collect()}
    assert got == {2, 3, 997, 999_999_999_989, 10**12 + 39, 2**61 - 1, 1_000_003}


@pytest.mark.parametrize("accuracy", [10_000, 100])
@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.9, 1.0])
def test_quantiles_of_many_columns(spark, accuracy, q):
    """Groups of all sizes, ties, nulls, NaN, infinities, a null group, a column that is all null."""
    from millrace.operators.aggregates import quantiles

    rng = np.random.default_rng(3)
    rows = []
    for g, n in ((None, 5), ("one", 1), ("small", 7), ("ties", 4000), ("wide", 6000)):
        x = rng.integers(0, 3, n) if g == "ties" else rng.normal(size=n) ** 3
        rows += [(g, float(v), float(v) if i % 3 else None, float("nan") if i % 4 == 0 else float(i), None) for i, v in enumerate(x)]
    rows += [("inf", float("inf"), 1.0, -float("inf"), None), ("inf", 2.0, None, 0.0, None), ("inf", 3.0, None, 1.0, None)]
    df = spark.createDataFrame(rows, "g string, a double, b double, c double, d double").repartition(7)
    got = {(r["g"], r["column_name"]): (r["n"], r["value"]) for r in quantiles(df, ["a", "b", "c", "d"], ["g"], q, accuracy).collect()}
    want = {}
    for at, name in enumerate("abcd", 1):
        for g in {r[0] for r in rows}:
            values = sorted(r[at] for r in rows if r[0] == g and r[at] is not None and not np.isnan(r[at]))
            if values:
                place = q * (len(values) - 1)
                lo, hi = values[int(np.floor(place))], values[int(np.ceil(place))]
                want[g, name] = len(values), lo + (hi - lo) * (place - np.floor(place))
    assert set(got) == set(want)
    for k, (n, value) in want.items():
        assert got[k][0] == n and (got[k][1] == pytest.approx(value, abs=1e-12) or np.isnan(value) and np.isnan(got[k][1])), k


def test_quantiles_in_few_jobs(spark):
    """One plan: no job runs while it is built, and the whole result takes at most three."""
    from millrace.operators.aggregates import quantiles

    df = spark.range(0, 200_000, 1, 4).select((F.col("id") % 5).alias("g"), *[F.rand(i).alias(f"c{i}") for i in range(5)])
    df = settle(df, "columns")
    group = "quantile-jobs"
    spark.sparkContext.setJobGroup(group, group)
    tracker = spark.sparkContext.statusTracker()
    plan = quantiles(df, [f"c{i}" for i in range(5)], ["g"])
    assert len(tracker.getJobIdsForGroup(group)) == 0
    before = plan._jdf.queryExecution().executedPlan().toString()
    assert before.count("Scan parquet") == 2 and plan.count() == 25
    between = [r for r in plan.collect() if not 0.45 < r["value"] < 0.55]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not between


def test_reconcile_by_digests(spark, rows):
    from millrace.operators import quality

    names = ["k", "v", "w"]
    a = spark.range(0, 20_000, 1, 5).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"), F.when(F.col("id") % 3 > 0, "t").alias("w"))
    b = a.filter("k <> 11").withColumn("v", F.when(F.col("k") == 77, F.lit(None)).otherwise(F.col("v"))).unionByName(
        a.filter("k = 500")).unionByName(spark.createDataFrame([(None, 1, "x")], "k long, v long, w string"))
    found, read = quality.reconcile_digests(a.repartition(3), b, "k", names)
    assert rows(found) == sorted([(11, 1, 0), (77, 1, 1), (500, 0, 1), (None, 0, 1)], key=repr)
    assert read.count() < 0.01 * (a.count() + b.count())
    same, none = quality.reconcile_digests(a, a.repartition(9), "k", names)
    assert same.count() == 0 and none.count() == 0
    everything, _ = quality.reconcile_digests(a.limit(0), a.limit(30), "k", names)
    assert everything.count() == 30


def test_equal_documents_have_ids_of_their_own(spark):
    from millrace.operators import documents as docs

    df = spark.createDataFrame([(1, "a")] * 5 + [(2, "b"), (None, None), (None, None)], "x int, y string").repartition(4)
    got = [r["_id"] for r in docs.with_ids(df).collect()]
    assert len(set(got)) == 8
    alone = {r["_id"] for r in docs.with_ids(df.distinct()).collect()}
    assert len(alone) == 3 and alone <= set(got)


def test_last_pair_wins_in_order(spark):
    from millrace.functions import payload

    rows = [(["b", "a", "b", "c", "a"], ["1", "2", "3", None, "5"]), ([], []), (["x"], ["y"]), ([f"k{i % 900}" for i in range(2000)], [str(i) for i in range(2000)])]
    made = spark.createDataFrame(rows, "k array<string>, v array<string>").select(payload.pairs_to_map("k", "v").alias("m"))
    got = made.select("m", F.map_keys("m")).collect()
    for (keys, values), (m, order) in zip(rows, got, strict=True):
        assert m == dict(zip(keys, values, strict=True))
        # A collected map has no order of its own: its keys as Spark holds them.
        assert order == sorted(m, key=lambda k: max(i for i, x in enumerate(keys) if x == k))
