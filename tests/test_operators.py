import datetime as dt
import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F
from pyspark.sql import types as T

from debutline.operators import match, merge, project, quality, reshape, select
from debutline.operators.boost import AdaBoostClassifier, AdaBoostModel
from debutline.operators.drift import drift_free, drift_report, ks_probability, ks_statistics
from debutline.operators.impute import NeighbourImputer, NeighbourImputerModel, impute
from debutline.operators.knn import KnnClassifier, KnnModel
from debutline.operators import nearest as nearest_module
from debutline.operators.nearest import BlockPlan, nearest
from debutline.operators.power import PowerTransform, PowerTransformModel, fit_powers
from debutline.operators.scores import best, leaderboard, macro_scores
from debutline.operators.ranks import first_by_rank, rank_index
from debutline.operators.split import fold_rows, split_rows

FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def rows(df, *order):
    return [tuple(row) for row in df.orderBy(*(order or df.columns)).collect()]


KEY = st.one_of(st.none(), st.integers(1, 4))
VALUE = st.one_of(st.none(), st.integers(0, 9))


@FEW
@given(
    st.dictionaries(KEY, st.tuples(VALUE, VALUE), max_size=4),
    st.lists(st.tuples(KEY, VALUE, VALUE), max_size=8),
)
def test_upsert_against_model(spark, held, batch):
    target = spark.createDataFrame([(k, a, b) for k, (a, b) in held.items()], "k int, a int, b int")
    source = spark.createDataFrame([(k, b, c, at) for at, (k, b, c) in enumerate(batch)], "k int, b int, c int, at int")
    expected = {k: (a, b, None) for k, (a, b) in held.items()}
    for k, b, c in batch:
        expected[k] = (expected.get(k, (None,))[0], b, c)
    got = merge.upsert(target, source, ["k"], ["at"], keep_order_columns=False).collect()
    assert len(got) == len(expected)
    assert {row["k"]: (row["a"], row["b"], row["c"]) for row in got} == expected


def test_upsert_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, None), (2, "b")], "k int, v string")
    once = merge.upsert(target, source, ["k"])
    assert rows(merge.upsert(once, source, ["k"])) == rows(once) == [(1, None), (2, "b")]


def test_delete_keeps_nulls(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    gone = spark.createDataFrame([(2,), (None,)], "x int")
    assert {row[0] for row in merge.delete_in(df, "k", gone, "x").collect()} == {1, None}


def test_refresh_filter(spark):
    scraped = spark.createDataFrame(
        [("new", "EQ"), ("done", "EQ"), ("open", "EQ"), ("small", "SME"), ("none", None), (None, "EQ")],
        "Company_name string, IPO_category string",
    )
    store = spark.createDataFrame(
        [("done", 1.0), ("open", 1.0), ("open", None), (None, None)], "IPO_company_name string, IPO_listing_price double"
    )
    got = match.refresh_filter(scraped, store).collect()
    assert {row["Company_name"] for row in got} == {"new", "open"}


def test_attempts(spark):
    tries = [("first", 1, "x"), ("last", 11, "y"), ("late", 12, "z"), ("twice", 3, "b"), ("twice", 2, "a"), ("twice", 1, None)]
    got = match.settle_attempts(spark.createDataFrame(tries, "key string, attempt_no int, value string"), ["key"])
    assert dict(got.collect()) == {"first": "x", "last": "y", "late": None, "twice": "a"}


def test_first_within_edges(spark):
    at = dt.datetime(2024, 1, 1, 9, 59, 59)
    hour = dt.timedelta(hours=1)
    starts = spark.createDataFrame([(1, at, 1), (1, at + hour, 2), (2, at, 3)], "k int, ts timestamp, id int")
    readings = spark.createDataFrame(
        [(1, at, 5.0, 2), (1, at, 4.0, 1), (1, at + 2 * hour, 7.0, 3), (2, at + hour + dt.timedelta(microseconds=1), 9.0, 4)],
        "k int, ts timestamp, v double, seq int",
    )
    got = match.first_within(starts, readings, ["k"], "ts", "ts", "v", hour, "seq")
    assert {row["id"]: row["first_value"] for row in got.collect()} == {1: 4.0, 2: 7.0, 3: None}


def test_order_by_list_and_membership(spark):
    df = spark.createDataFrame([("c",), ("a",), ("x",), ("b",)], "v string")
    order = spark.createDataFrame([("b", 0), ("a", 1), ("c", 2)], "v string, at int")
    assert [row["v"] for row in select.order_by_list(df, "v", order, "v", "at").collect()] == ["b", "a", "c", "x"]
    assert rows(df.filter(match.in_list("v", ["a", "x"]))) == [("a",), ("x",)]


def test_month_selections_in_january(spark):
    days = [dt.date(2025, 11, 30), dt.date(2025, 12, 1), dt.date(2025, 12, 2), dt.date(2026, 1, 1), dt.date(2026, 1, 31), None]
    df = spark.createDataFrame([(d, 1.0, 1.0, 1.0) for d in days], "IPO_open_date date, IPO_listing_price double, IPO_day3_qib double, IPO_day2_qib double")
    as_of = dt.date(2026, 1, 15)
    pick = lambda out: [row[0] for row in out.orderBy("IPO_open_date").collect()]
    assert pick(select.select_train(df, as_of)) == days[:2]
    assert pick(select.select_predict(df, as_of)) == days[3:5]
    assert pick(select.select_archive(df, as_of)) == days[:4]


def test_conform_and_matching_days(spark):
    df = spark.createDataFrame([(1, "x")], "b int, extra string")
    out = project.conform(df, {"a": T.StringType(), "b": T.IntegerType()})
    assert out.columns == ["a", "b"] and rows(out, "b") == [(None, 1)]
    long = spark.createDataFrame([("QIB",), ("QIB (Ex Anchor)",), ("NII*",), ("Total",), ("NII (x)",)], "metric string")
    kept = project.matching_days(long, "metric", ["QIB", "QIB (Ex Anchor)", "NII", "NII*"])
    assert [row[0] for row in kept.collect()] == ["QIB", "QIB (Ex Anchor)", "NII*"]


def test_subscriptions_of_many_days(spark):
    found = [("u", day, "QIB", float(day)) for day in (2, 11, 400, 3)] + [("u", 1, "NII", 5.0), ("u", 9, "NII", None)]
    df = spark.createDataFrame(found, "url string, day int, metric string, value double")
    row = reshape.subscription_columns(df, ["url"]).first()
    assert [row[f"IPO_day{d}_qib"] for d in (1, 2, 3)] == [None, 11.0, 400.0]
    assert [row[f"IPO_day{d}_nii"] for d in (1, 2, 3)] == [5.0, None, None]


def test_long_series_are_never_cut(spark):
    days = [(dt.date(2025, 1, 1) + dt.timedelta(days=k), float(k >= 10)) for k in range(44)]
    df = spark.createDataFrame([("long", days[5:]), ("short", days[:43]), ("zero", [(d, 0.0) for d, _ in days])], "k string, s array<struct<date:date,price:double>>")
    fit = {row["k"]: row["fits"] for row in df.select("k", reshape.fits_columns("s").alias("fits")).collect()}
    assert fit == {"long": False, "short": True, "zero": True}
    wide = reshape.columns_from_trimmed(df.filter(reshape.fits_columns("s")), "s").filter("k = 'short'").first()
    assert wide["day1_date"] == days[10][0] and wide["day33_date"] == days[42][0]
    with pytest.raises(Exception, match="44 days"):
        reshape.columns_from_pairs(df.filter("k = 'zero'"), "s").collect()


def test_a_key_given_twice_needs_an_order(spark):
    stored = spark.createDataFrame([("a", 1)], "k string, v int")
    twice = spark.createDataFrame([("a", 2), ("a", 3), ("b", 4)], "k string, v int")
    with pytest.raises(Exception, match="several rows"):
        merge.upsert(stored, twice, ["k"]).collect()
    assert rows(merge.upsert(stored, twice, ["k"], ["v"])) == [("a", 3), ("b", 4)]
    assert rows(merge.upsert(stored, twice.filter("v <> 2"), ["k"])) == [("a", 3), ("b", 4)]


def test_first_listed_metric_name_counts(spark):
    found = [("u", 1, "QIB (Ex Anchor)", 9.0), ("u", 1, "QIB", 3.0), ("u", 2, "QIB", None), ("u", 2, "QIB (Ex Anchor)", 4.0), ("u", 2, "Other", 1.0)]
    df = spark.createDataFrame(found, "url string, day int, metric string, value double")
    row = reshape.subscription_columns(df, ["url"]).first()
    assert (row["IPO_day1_qib"], row["IPO_day2_qib"], row["IPO_day2_nii"]) == (3.0, 4.0, None)


def test_schema_report(spark):
    df = spark.createDataFrame([("1", "x"), (None, "2")], "a string, b string")
    report = quality.schema_report(df, {"a": T.DoubleType(), "b": T.DoubleType(), "c": T.DoubleType()})
    assert rows(report, "column") == [("a", True, 2, 1, 0), ("b", True, 2, 0, 1), ("c", False, 2, 2, 0)]
    assert not quality.schema_conforms(report, 3, 3)
    assert quality.schema_conforms(report.filter("column = 'a'"), 1, 1)


def slow_ks(a, b):
    return max(abs(sum(v <= x for v in a) / len(a) - sum(v <= x for v in b) / len(b)) for x in a + b)


@pytest.mark.parametrize("slots", [2, 8, 256])
def test_ks_against_brute_force(spark, slots):
    rng = np.random.default_rng(1)
    a = [float(v) for v in np.round(rng.normal(0, 1, 400), 1)] + [0.0] * 300
    b = [float(v) for v in np.round(rng.normal(0.2, 1.3, 250), 2)]
    base, current = (spark.createDataFrame([(v, 1.0, None) for v in side], "x double, same double, gap double") for side in (a, b))
    found = {row["column"]: row["statistic"] for row in ks_statistics(base, current, ["x", "same", "gap"], slots)}
    assert found["x"] == pytest.approx(slow_ks(a, b), abs=1e-12)
    assert found["same"] == 0 and found["gap"] is None


def test_ks_probability():
    # all 20 interleavings of 3 and 3: the gap is 1 in 2 of them, at least 2/3 in 12
    assert ks_probability(1.0, 3, 3, exact=True) == pytest.approx(2 / 20)
    assert ks_probability(2 / 3, 3, 3, exact=True) == pytest.approx(12 / 20)
    assert ks_probability(0.0, 3, 5, exact=True) == ks_probability(0.0, 3, 5) == 1.0
    assert ks_probability(1.0, 1, 4, exact=True) == pytest.approx(2 / 5)
    near = ks_probability(0.05, 2_000, 1_800, exact=True)
    assert ks_probability(0.05, 2_000, 1_800) == pytest.approx(near, rel=0.03)
    assert ks_probability(0.0195, 10_000, 10_000) == pytest.approx(ks_probability(0.0195, 10_001, 10_001), rel=0.001)
    assert ks_probability(1.36 * math.sqrt(2 / 50_000), 50_000, 50_000) == pytest.approx(0.049, abs=0.002)


def test_drift_report(spark):
    base = spark.createDataFrame([(float(v), float(v), None) for v in range(60)], "same double, moved double, gap double")
    moved = base.withColumn("moved", F.col("moved") + 30)
    report = drift_report(base, moved, ["same", "moved", "gap"])
    verdicts = {row["column"]: (row["drift_status"], row["note"]) for row in report.collect()}
    assert verdicts["same"] == (False, None) and verdicts["moved"] == (True, None)
    assert verdicts["gap"][0] is None and verdicts["gap"][1]
    assert not drift_free(report) and drift_free(report.filter("column <> 'moved'"))


def test_split_is_exact_and_stable(spark):
    df = spark.createDataFrame([(at, f"c{at % 7 % 3}") for at in range(1003)], "id int, label string").repartition(5)
    first = split_rows(df, ["id"], "label")
    parts = {row["split"]: row["count"] for row in first.groupBy("split").count().collect()}
    assert parts == {"train": 702, "vald": 150, "test": 151}
    shares = first.groupBy("label").agg((F.count_if(F.col("split") == "train") / F.count("*")).alias("s")).collect()
    assert all(abs(row["s"] - 0.7) < 0.005 for row in shares)
    again = split_rows(df.repartition(3), ["id"], "label")
    assert first.filter("split = 'train'").count() == again.filter("split = 'train'").count()
    assert rows(split_rows(df.coalesce(1), ["id"], "label"), "id") == rows(first, "id")


def test_split_of_many_classes_and_a_hot_one(spark):
    # thousands of classes, null among them, and one with a third of all rows
    df = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 1000 == 1, None).otherwise(F.floor(F.col("id") / 2)).cast("int").alias("label"))
    parts = split_rows(df, ["id"], "label")
    sizes = {row["split"]: row["count"] for row in parts.groupBy("split").count().collect()}
    assert sizes == {"train": 4200, "vald": 900, "test": 900} and parts.columns == ["id", "label", "split"]
    by_class = parts.groupBy("label").agg(F.count("*").alias("n"), F.count_if(F.col("split") == "train").alias("k")).collect()
    assert all(0.7 * row["n"] - 1 < row["k"] < 0.7 * row["n"] + 1 for row in by_class)


def test_cuts_are_the_last_wanted_ranks(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("g"))
    rank = F.struct(F.xxhash64("id").alias("h"), F.col("id").alias("k0"))
    wanted = spark.createDataFrame([(0, 1), (1, 700), (2, 0)], "g long, wanted long")
    got = {row["g"]: tuple(row["cut"]) for row in first_by_rank(df, "g", rank, wanted).collect()}
    held = {g: sorted(tuple(row["r"]) for row in df.filter(F.col("g") == g).select(rank.alias("r")).collect()) for g in (0, 1)}
    assert got == {0: held[0][0], 1: held[1][699]}


def test_pages_read_the_ranges_that_hold_them(spark):
    df = spark.range(1000).select("id", (F.col("id") * 7 % 13).alias("v"), F.lit("x").alias("w")).repartition(5)
    order = [F.col("v").desc(), F.col("id")]
    index = rank_index(df, order, ranges=6)
    want = [tuple(row) for row in df.orderBy(*order).collect()]
    for number, size in ((1, 20), (3, 20), (50, 20), (51, 20), (2, 400)):
        found = index.page(number, size)
        assert [tuple(row) for row in found.collect()] == want[(number - 1) * size : number * size] and found.columns == df.columns
    plan = index.page(3, 20)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "TakeOrdered" not in plan and len(index.before) > 1
    assert rank_index(df.limit(0), order).page(1, 20).count() == 0


def test_folds_hold_each_class(spark):
    df = spark.createDataFrame([(at, float(at % 2)) for at in range(90)], "id int, label double")
    sizes = fold_rows(df, ["id"], "label").groupBy("fold", "label").count().collect()
    assert sorted(row["count"] for row in sizes) == [15] * 6


def test_macro_scores(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (2.0, 0.0), (1.0, 3.0)], "label double, prediction double")
    row = macro_scores(df).first()
    # per label 0..3: precision 1/2 1/2 0 0, recall 1/2 1/2 0 0, f1 1/2 1/2 0 0
    assert tuple(row) == (0.25, 0.25, 0.25)


def test_leaderboard_ties(spark):
    board = spark.createDataFrame([(0, "a", 0.5), (1, "b", 0.7), (2, "c", 0.7)], "idx int, model string, f1_score double")
    assert [row["model"] for row in leaderboard(board).collect()] == ["b", "c", "a"]
    assert best(board).first()["model"] == "b"


def brute(asked, held, k):
    out = {}
    for name, vector in asked:
        found = []
        for donor, other in held:
            both = [(x, y) for x, y in zip(vector, other) if x is not None and y is not None]
            if both:
                found.append((math.sqrt(len(vector) / len(both) * sum((x - y) ** 2 for x, y in both)), donor))
        out[name] = [donor for _, donor in sorted(found)[:k]]
    return out


@pytest.mark.parametrize("plan", [BlockPlan(), BlockPlan(donors_per_block=40, receivers_per_task=15), BlockPlan(donors_per_block=2)])
def test_nearest_against_brute_force(spark, monkeypatch, plan):
    monkeypatch.setattr(nearest_module, "FAN", 6)  # several levels of boxes
    rng = np.random.default_rng(5)
    some = lambda: [None if rng.random() < 0.2 else float(np.round(v, 1)) for v in rng.normal(0, 3, 3)]
    held = [(at, some()) for at in range(300)] + [(at, [1.0, 1.0, 1.0]) for at in range(300, 420)]
    asked = [(at, some()) for at in range(60)] + [(at, [1.0, 1.0, 1.1]) for at in range(60, 90)]
    frame = lambda part: spark.createDataFrame([(at, *v) for at, v in part], "id int, a double, b double, c double")
    got = {}
    for row in nearest(frame(asked), frame(held), "id", "id", ["a", "b", "c"], 4, plan=plan).orderBy("receiver", "place").collect():
        got.setdefault(row["receiver"], []).append(row["donor"])
    assert got == {name: donors for name, donors in brute(asked, held, 4).items() if donors}


def test_impute_edges(spark):
    schema = "id int, a double, b double, empty double"
    train = spark.createDataFrame([(1, 1.0, 10.0, None), (2, 2.0, 20.0, None), (3, 100.0, None, None)], schema)
    gaps = spark.createDataFrame([(7, 1.1, None, None), (8, None, None, None), (9, 5.0, 5.0, None)], schema)
    out = {row["id"]: (row["a"], row["b"], row["empty"]) for row in impute(gaps, train, "id", ["a", "b", "empty"], k=1).collect()}
    assert out[7] == (1.1, 10.0, None)
    assert out[8] == (pytest.approx(103 / 3), 15.0, None)
    assert out[9] == (5.0, 5.0, None)


def test_power_fit_matches_fine_search(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.lognormal(0, 1, 300), -rng.random(40)])
    df = spark.createDataFrame([(float(v), 4.0) for v in values], "x double, flat double")

    def fit(power):
        logs, own = np.log1p(np.abs(values)), np.where(values >= 0, power, 2 - power)
        size = np.where(np.abs(own) < 1e-12, logs, np.expm1(own * logs) / np.where(own == 0, 1, own))
        return -len(values) / 2 * np.log(np.var(np.where(values >= 0, size, -size))) + (power - 1) * np.sum(np.sign(values) * logs)

    grid = np.arange(-3, 3, 0.0005)
    expected = grid[int(np.argmax([fit(power) for power in grid]))]
    powers = fit_powers(df, ["x", "flat"])
    assert powers["x"] == pytest.approx(expected, abs=6e-4) and powers["flat"] == 1.0


def test_stages_save_and_load(spark, tmp_path):
    df = spark.createDataFrame([(at, float(at % 7), None if at % 5 == 0 else float(at)) for at in range(40)], "id int, a double, b double")
    imputer = NeighbourImputer(inputCols=["a", "b"], key="id").fit(df)
    imputer.write().save(f"{tmp_path}/imputer")
    again = NeighbourImputerModel.load(f"{tmp_path}/imputer")
    assert rows(again.transform(df), "id") == rows(imputer.transform(df), "id")
    power = PowerTransform(inputCols=["a", "b"]).fit(imputer.transform(df))
    power.write().save(f"{tmp_path}/power")
    assert PowerTransformModel.load(f"{tmp_path}/power").getOrDefault("powers") == power.getOrDefault("powers")


def points(spark):
    data = [(at, Vectors.dense([float(at % 10), float(at // 10)]), float((at % 10 >= 3) + (at % 10 >= 7))) for at in range(100)]
    return spark.createDataFrame(data, ["id", "features", "label"])


def test_knn_and_boost_learn(spark, tmp_path):
    df = points(spark)
    knn = KnnClassifier(key="id").fit(df)
    knn.write().save(f"{tmp_path}/knn")
    assert KnnModel.load(f"{tmp_path}/knn").transform(df).filter("prediction = label").count() > 90
    boost = AdaBoostClassifier(rounds=12, seed=1).fit(df)
    boost.write().save(f"{tmp_path}/boost")
    hits = AdaBoostModel.load(f"{tmp_path}/boost").transform(df).filter("prediction = label").count()
    assert hits > 80
