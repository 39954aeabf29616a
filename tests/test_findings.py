"""Queries on rows made for the faults that a review found."""

import datetime as dt
import random
import re
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from debutline.operators import drift, histograms, impute, knn, nearest, reshape
from debutline.operators.boosting import BoostedTrees
from debutline.operators.knn import KnnClassifier
from debutline.operators.impute import NeighbourImputer
from debutline.operators.models import candidates, grid_scores
from debutline.operators.nearest import BlockPlan
from debutline.operators.power import PowerTransform
from debutline.operators.select import order_by_list
from debutline import session
from debutline.plans import training
from debutline.plans.extract import offer_subscriptions
from debutline.session import CLEANUP_KEY, cut_lineage, shuffles_dropped
from debutline.sources import markup
from debutline.workload import all_cases


def test_link_zip_takes_date_and_status_from_one_line(spark, tmp_path):
    day = dt.datetime(2001, 1, 1)
    lines = [(1, 10.0, day, 1, 7, "O"), (1, 20.0, dt.datetime(2002, 2, 2), 1, 7, "F")]
    spark.createDataFrame(lines, "l_orderkey long, l_extendedprice double, l_shipdate timestamp, l_linenumber int, l_partkey long, l_linestatus string").write.parquet(
        f"{tmp_path}/lineitem.parquet"
    )
    spark.createDataFrame([(1, 5, "P", day)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(5, "five")], "c_custkey long, c_name string").write.parquet(f"{tmp_path}/customer.parquet")
    assert [tuple(row) for row in all_cases()["link_zip"][0](spark, str(tmp_path)).collect()] == [(1, "O", "five", "2001-01-01")]


def test_rows_of_one_small_file_are_parsed_by_many_tasks(spark, tmp_path, monkeypatch):
    orders = [(at, at, "F", 10.0, dt.datetime(2001, 1, 1), "1-URGENT") for at in range(100)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").coalesce(
        1
    ).write.parquet(f"{tmp_path}/orders.parquet")
    customers = [(at, f"C{at}", 1.0, "BUILDING") for at in range(100)]
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_acctbal double, c_mktsegment string").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    seen, parse = [], markup.parse_pages
    monkeypatch.setattr(markup, "parse_pages", lambda pages: seen.append(pages) or parse(pages))
    for name in ("price_pages", "subscription_pages", "detail_pages", "review_pages", "list_pages"):
        all_cases()[name][0](spark, str(tmp_path))
    assert [pages.rdd.getNumPartitions() > 4 for pages in seen] == [True] * 5


def test_parsed_pages_keep_other_columns_and_name_bad_pages(spark):
    pages = spark.createDataFrame([(1, "u", "<table><tr><td>1 &amp; 2</td></tr></table>"), (2, "v", None)], "id int, url string, html string")
    good, bad = sorted(markup.parse_pages(pages.coalesce(1)).collect())
    assert (good.id, good.url, good.tables[0].rows, good.error) == (1, "u", [["1 & 2"]], None)
    assert (bad.id, bad.tables, bad.error.split(":")[0]) == (2, None, "TypeError")


def test_receivers_with_the_same_values_are_searched_for_once(spark, monkeypatch):
    donors = spark.createDataFrame([(at, float(at % 7), float(at % 5)) for at in range(70)], "id int, a double, b double")
    asked = spark.createDataFrame([(at, float(at % 3), None) for at in range(300)] + [(300, None, None)], "id int, a double, b double")
    counts, descend = [], nearest._descend
    monkeypatch.setattr(nearest, "_descend", lambda rows, *rest: counts.append(rows.count()) or descend(rows, *rest))
    found = nearest.nearest(asked, donors, "id", "id", ["a", "b"], 5, missing_only=True).collect()
    assert counts == [3, 3]
    by_receiver = {}
    for row in sorted(found, key=lambda row: row.place):
        by_receiver.setdefault((row.receiver, row.target), []).append(row.donor)
    assert by_receiver == {(at, "b"): [at % 3 + 7 * step for step in range(5)] for at in range(300)}


def test_drift_passes_go_over_distinct_values(spark, monkeypatch):
    sizes, cut = [], drift._cut_again
    monkeypatch.setattr(drift, "_cut_again", lambda long, *rest: sizes.append(long.count()) or cut(long, *rest))
    rows = spark.range(4000).select((F.col("id") % 400).cast("double").alias("v"), "id")
    base, current = rows.filter("id % 7 < 3"), rows.filter("id % 7 >= 3").withColumn("v", F.col("v") + 0.0)
    found = drift.ks_statistics(base, current, ["v"], slots=4)[0]
    left, right = (sorted(row.v for row in side.collect()) for side in (base, current))
    gaps = [abs(sum(x <= v for x in left) / len(left) - sum(x <= v for x in right) / len(right)) for v in range(400)]
    assert abs(found["statistic"] - max(gaps)) < 1e-12
    assert sizes and max(sizes) <= 400


def test_neighbour_counts_of_a_grid_share_the_search_of_a_fold(spark, monkeypatch):
    rows = spark.createDataFrame(
        [(at, Vectors.dense(float(at % 11), float(at * 7 % 13)), float(at * 5 % 3), at % 3) for at in range(90)], T.StructType([T.StructField("id", T.IntegerType()), T.StructField("features", VectorUDT()), T.StructField("label", T.DoubleType()), T.StructField("fold", T.IntegerType())])
    )
    estimator, calls, search = KnnClassifier(key="id"), [], knn.nearest
    plain = [sum(right(spark, estimator, rows, k, fold) for fold in range(3)) / 3 for k in (1, 4, 7)]
    monkeypatch.setattr(knn, "nearest", lambda *args, **more: calls.append(args[5]) or search(*args, **more))
    scores = grid_scores(estimator, rows, [{estimator.k: k} for k in (1, 4, 7)])
    assert calls == [7, 7, 7]
    assert scores == plain


def right(spark, estimator, rows, k, fold):
    guessed = estimator.copy({estimator.k: k}).fit(rows.filter(F.col("fold") != fold)).transform(rows.filter(F.col("fold") == fold))
    found = [row.prediction == row.label for row in guessed.collect() if row.prediction is not None]
    return sum(found) / len(found)


def test_search_by_products_finds_what_differences_find():
    rng = np.random.default_rng(5)
    for width, gaps, shift in ((64, 0.0, 0.0), (10, 0.3, 1e6), (3, 0.2, -5.0)):
        held, asked = (rng.integers(-3, 4, (count, width)) + shift for count in (400, 90))
        for values in (held, asked):
            values[rng.random(values.shape) < gaps] = np.nan
        distance = nearest._distances(asked, held)
        row, place = nearest._top(distance, 5)
        found = nearest._Donors(held).search(asked, 5, np.full(len(asked), np.inf))
        assert [part.tolist() for part in found] == [row.tolist(), place.tolist(), distance[row, place].tolist()]
        reach = np.nan_to_num(distance[:, 7], posinf=1.0)
        row, place = nearest._top(np.where(distance <= reach[:, None], distance, np.inf), 5)
        found = nearest._Donors(held).search(asked, 5, reach)
        assert [part.tolist() for part in found] == [row.tolist(), place.tolist(), distance[row, place].tolist()]


def test_rows_of_one_listed_value_are_sorted_by_many_tasks(spark):
    listed = spark.createDataFrame([("a", 1)], "value string, place int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(4000).select("id", F.lit("a").alias("kind"))
        ordered = order_by_list(rows, "kind", listed, "value", "place").withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(ordered) == 4000 and ordered[0].asDict().keys() == {"id", "kind", "part"}
    assert max(Counter(row.part for row in ordered).values()) < 2000


def test_plain_rows_are_one_token_and_read_as_by_tags(monkeypatch):
    rng = random.Random(4)
    parts = """<table>|</table>|<tr>|<TR x='>'>|</tr>|</tr >|<td>a</td>|<TD a="<b>">b &amp; c</Td >|<td>x &am<br/>p; y</th>|<th> h </th>|<td>|</td>|<td/>1</td>|<tdx>|<thead>|</thead>|<tr><td>5</td> <td>6</td></tr>"""
    parts = [*parts.split("|"), "<span>", "</span>", "<li>", "<a href=q>", "</a>", "<b c='<td>'>", "<!--", "-->", "<", "'", "\n", "z"]
    pages = ["<table>" * (at % 2) + "".join(rng.choices(parts, k=rng.randint(1, 30))) for at in range(4000)]
    long = "<table><tr><th>a</th><th>b</th></tr>" + "<tr class=r><td>1</td>\n<td>2 <br>3</td></tr>" * 500 + "</table>"
    assert sum(1 for _ in markup.TOKENS.finditer(long)) < 510
    found = [markup._read_page(page) for page in [*pages, long]]
    monkeypatch.setattr(markup, "TOKENS", re.compile(f"(?P<cells>(?!))|{markup.TAGS}", re.DOTALL))
    assert found == [markup._read_page(page) for page in [*pages, long]]


def test_subscription_pages_are_read_in_the_row_with_one_shuffle(spark):
    rng, rows, long = random.Random(6), [], {}
    heads = ["QIB", "NII", "Date", "NII*", "QIB (Ex Anchor)", "other", "Retail"]
    for page in range(60):
        for copy in range(1 + (page % 3 == 0)):
            html = ""
            for table in range(2 * copy, 2 * copy + 2) if page % 2 else (copy,):
                html += "<table><tr>" + "".join(f"<th>{head}</th>" for head in heads) + "</tr>"
                for at in range(rng.randint(1, 6)):
                    day = rng.choice([0, 1, 2, 3, 4, 11, 99999999999])
                    cells = [f"Day {day} <br>x" if head == "Date" else rng.choice(["1", "2.5", "-", "1,007", ""]) for head in heads[: rng.randint(3, 7)]]
                    html += "<tr>" + "".join(f"<td>{cell}</td>" for cell in cells) + "</tr>"
                    if day < 100 and not copy:
                        for head, cell in zip(heads, [*cells, *[""] * 7]):
                            if head != "Date":
                                long[page, day, head] = (str(page), day, head, float(cell.replace(",", "")) if cell.strip("-") else None)
                html += "</table>"
            held = html if not copy else held  # a page landed twice
            rows.append((str(page), held))
    pages = spark.createDataFrame(rows, "url string, html string")
    out = offer_subscriptions(markup.parse_pages(pages))
    plain = reshape.subscription_columns(spark.createDataFrame(list(long.values()), "sbscrp_url string, day int, metric string, value double"), ["sbscrp_url"])
    assert sorted(out.collect(), key=str) == sorted(plain.select(out.columns).collect(), key=str)
    unrun = offer_subscriptions(markup.parse_pages(pages))
    assert unrun._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_listed_order_places_every_order(spark, tmp_path):
    rows = [(at, None if at % 7 == 0 else "FOPX"[at % 4], None) for at in range(300, 0, -1)] + [(None, "O", None), (5, "O", None)]
    spark.createDataFrame(rows, "o_orderkey long, o_orderstatus string, o_orderdate timestamp").repartition(5).write.parquet(f"{tmp_path}/orders.parquet")
    found = [(row.o_orderkey, row.o_orderstatus, row.turn) for row in all_cases()["listed_order"][0](spark, str(tmp_path)).orderBy("place").collect()]
    turn = {"P": 1, "O": 2, "F": 3, "X": 4, None: 5}
    by_place = sorted(rows, key=lambda row: (turn[row[1]], row[0] is None, row[0] or 0))
    assert found == [(key, status, turn[status]) for key, status, _ in by_place]


def test_search_leaves_no_scratch_that_nothing_reads(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(at, float(at % 7), float(at % 5) if at % 3 else None) for at in range(200)], "id int, a double, b double")
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    filled = NeighbourImputer(inputCols=["a", "b"], key="id").fit(rows).transform(rows)
    left = Counter(path.name.split("-")[0] for path in tmp_path.iterdir())
    assert not {"visits", "descent", "partial"} & left.keys() and left["donors"] == 1
    assert filled.filter("b IS NULL").count() == 0 and filled.count() == 200


def test_searches_in_parts_find_the_same(spark, monkeypatch):
    rows = spark.createDataFrame([(at, float(at * 7 % 31), float(at % 13) if at % 3 else None, float(at % 17) if at % 5 else None) for at in range(300)], "id int, a double, b double, c double")
    found, parts, ranked = [], [], nearest._ranked
    monkeypatch.setattr(nearest, "_ranked", lambda asked, *rest: parts.append(asked.count()) or ranked(asked, *rest))
    for plan in (BlockPlan(), BlockPlan(searches_at_once=60)):
        found.append(sorted(map(tuple, nearest.nearest(rows, rows, "id", "id", ["a", "b", "c"], 3, missing_only=True, plan=plan).collect())))
    assert found[0] == found[1] and len(parts) > 2 and sum(parts[1:]) == parts[0]


def test_shuffles_go_with_the_write_they_serve(spark):
    before = spark.conf.get(CLEANUP_KEY, None)
    with ThreadPoolExecutor(4) as threads:
        frames = [spark.range(100).repartition(3, "id") for _ in range(8)]
        written = list(threads.map(cut_lineage, frames))
    with shuffles_dropped(spark):
        assert spark.conf.get(CLEANUP_KEY) == "true"
    assert [df.count() for df in written] == [100] * 8
    assert spark.conf.get(CLEANUP_KEY, None) == before


def test_blocks_are_cut_where_donors_are_spread(spark, monkeypatch):
    rng = np.random.default_rng(3)
    values = np.hstack([rng.integers(0, 2, (1500, 8)), rng.random((1500, 2)) * 1000]).astype(float)
    values[rng.random(1500) < 0.2, 9] = np.nan
    names = [f"v{at}" for at in range(10)]
    rows = spark.createDataFrame([(at, *[None if np.isnan(v) else float(v) for v in row]) for at, row in enumerate(values)], f"id int, {', '.join(f'{n} double' for n in names)}")
    visited, search = [], nearest._search
    monkeypatch.setattr(nearest, "_search", lambda visits, *rest: visited.append(visits.count()) or search(visits, *rest))
    monkeypatch.setattr(nearest, "HOME_ROWS", 20)
    asked = rows.filter("id < 60")
    found = nearest.nearest(asked, rows, "id", "id", names, 5, plan=BlockPlan(donors_per_block=20)).collect()
    distance = nearest._distances(values[:60], values)
    assert sorted((row.receiver, row.place, row.donor) for row in found) == [
        (at, place + 1, donor) for at in range(60) for place, donor in enumerate(np.lexsort((np.arange(1500), distance[at]))[:5].tolist())
    ]
    # of 75 blocks or more
    assert visited[1] < 60 * 20


def test_a_tree_cuts_all_kinds_of_vectors_and_finds_their_leaves_again():
    rng = np.random.default_rng(4)
    vectors = rng.integers(0, 30, (3000, 3)).astype(float)
    vectors[rng.random(vectors.shape) < 0.1] = np.nan
    vectors[rng.random(vectors.shape) < 0.01] = np.inf
    vectors[rng.random(vectors.shape) < 0.01] = -np.inf
    nodes, leaf = nearest._tree(vectors, 50, 1000)
    assert np.bincount(leaf).min() > 0 and np.bincount(leaf).max() <= 50
    assert nearest._leaves(nodes, vectors).tolist() == leaf.tolist()
    assert nearest._tree(vectors, 50, 16)[1].max() == 15
    assert nearest._tree(np.zeros((100, 2)), 50, 16)[0] == []


def test_preparation_searches_for_each_row_once(spark, monkeypatch):
    rows = spark.createDataFrame(
        [(f"k{at}", "train" if at % 3 else "test", float(at % 17), None if at % 4 == 0 else float(at % 5)) for at in range(80)], "name string, split string, a double, b double"
    )
    stages = [NeighbourImputer(inputCols=["a", "b"], key="name"), PowerTransform(inputCols=["a", "b"])]
    plain = Pipeline(stages=stages).fit(rows.filter("split = 'train'")).transform(rows).collect()
    calls, search = [], impute.nearest
    monkeypatch.setattr(training, "preparation", lambda: Pipeline(stages=stages))
    monkeypatch.setattr(impute, "nearest", lambda *args, **more: calls.append(1) or search(*args, **more))
    model, features = training.prepare(rows, F.col("split") == "train")
    assert sorted(features.collect()) == sorted(plain) and len(calls) == 1
    assert len(model.stages) == 2


def test_passes_over_a_larger_matrix_are_many_tasks_and_grow_the_same_trees(spark, monkeypatch):
    rows = spark.createDataFrame(
        [(Vectors.dense([float(at * step % 101) for step in (3, 7, 11)]), float(at * 5 % 23 % 3)) for at in range(3000)], T.StructType([T.StructField("features", VectorUDT()), T.StructField("label", T.DoubleType())])
    )
    plain = BoostedTrees(kind="classic", rounds=2).fit(rows).parts()
    monkeypatch.setattr(histograms, "PASS_BYTES", 2000)
    matrix = histograms.pack(rows, "features", "label")
    assert matrix.parts == 5 and matrix.blocks.rdd.getNumPartitions() > 1
    assert matrix.blocks.agg(F.sum("n")).first()[0] == 3000
    cuts, _, trees = BoostedTrees(kind="classic", rounds=2).fit(rows).parts()
    assert [cut.tolist() for cut in cuts] == [cut.tolist() for cut in plain[0]] and trees == plain[2]


def test_forests_keep_node_ids_between_passes():
    for name in ("RandomForestClassifier", "XGBRFClassifier"):
        assert candidates(100, "id")[name][1].getCacheNodeIds()


def test_a_saved_imputer_searches_in_the_blocks_made_when_it_was_fitted(spark, monkeypatch, tmp_path):
    rows = spark.createDataFrame(
        [(f"k{at}", None if at % 7 == 0 else float(at % 17), None if at % 4 == 0 else float(at % 5)) for at in range(90)], "name string, a double, b double"
    )
    made, blocks = [], nearest._in_blocks
    monkeypatch.setattr(nearest, "_in_blocks", lambda *args: made.append(1) or blocks(*args))
    model = NeighbourImputer(inputCols=["a", "b"], key="name", k=3).fit(rows)
    plain = sorted(impute.impute(rows, rows, "name", ["a", "b"], k=3).collect())
    assert len(made) == 2
    model.write().save(f"{tmp_path}/model")
    held = impute.NeighbourImputerModel.load(f"{tmp_path}/model")
    for part in ("name < 'k5'", "name >= 'k5'"):
        assert {row for row in held.transform(rows.filter(part)).collect()} == {row for row in plain if (row["name"] < "k5") == (part == "name < 'k5'")}
    assert sorted(model.transform(rows).collect()) == plain
    assert len(made) == 2
    # more neighbours than the blocks were made for
    assert sorted(held.copy({held.k: 4}).transform(rows).collect()) == sorted(impute.impute(rows, rows, "name", ["a", "b"], k=4).collect())
    with pytest.raises(ValueError, match="serves 3"):
        nearest.nearest(rows, rows, "name", "name", ["a", "b"], 4, index=held.index)


def test_boxes_to_go_into_are_those_of_a_plain_choice():
    rng = np.random.default_rng(5)
    low = np.sort(rng.normal(size=(40, 3)), axis=0)
    table = pa.table(
        {"node": np.arange(40), "rows": [300] * 40, "low": low.tolist(), "high": (low + 0.4).tolist(), "known": [[300, 300 * (at % 3 > 0), 300 - at] for at in range(40)]}
    )
    boxes = nearest._Boxes(table, 3, ["a", "b", "c"])
    vectors = rng.normal(size=(60, 3))
    vectors[rng.random(vectors.shape) < 0.2] = np.nan
    vectors[0] = np.nan
    targets, reach = np.array(list("abc") * 20, dtype=object), np.where(np.arange(60) % 2, rng.random(60) * 3, np.nan)
    reach[1] = np.inf
    found, bounds, wanted = list(zip(*(part.tolist() for part in boxes.chosen(vectors, targets, reach, 5)))), boxes.bounds(vectors), set()
    for at in range(60):
        supply, gathered = boxes.supply[targets[at]], 0
        for place in sorted((p for p in range(40) if supply[p] > 0 and np.isfinite(bounds[at][p])), key=lambda p: bounds[at][p]):
            if np.isnan(reach[at]) and gathered < nearest.HOME_ROWS or bounds[at][place] <= reach[at]:
                wanted.add((at, place))
            gathered += supply[place]
    assert set(found) == wanted and len(found) == len(wanted) > 60
