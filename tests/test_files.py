from __future__ import annotations

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from perfwatch.operators import manifest as mf
from perfwatch.operators import validation as val
from perfwatch.operators.ordering import Layout
from perfwatch.plans import training
from perfwatch.plans.catalog.files import prediction_tree
from perfwatch.plans.preprocessing import Settings
from perfwatch.sources import files as src
from perfwatch.sources import writers as out
from perfwatch.sources.listing import every_file
from perfwatch.sources.tables import capped, sampled

CPU = "container_cpu_usage_seconds_total"


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def put(folder, name, text, bom=False):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8") as f:
        f.write(text)


def test_unequal_headers_keep_names_and_order(spark, folder):
    put(folder, "compose/a/one.csv", f"window_id,0_latency,0_{CPU}\n5,1.5,2\n3,junk,NA\n4,,3\n", bom=True)
    put(folder, "home/two.csv", f"0_{CPU},0_latency,window_id\n7,8,1\nbad,9,2\n")
    put(folder, "three.csv", "window_id,0_latency\n1,inf\n")
    wide, layout = src.read_telemetry_csv(spark, folder)
    rows = {(r["sample_key"], r["seq"]): r for r in wide.collect()}
    assert len(rows) == 6 and not layout.split
    one = [rows["compose/a/one", i] for i in range(3)]
    assert [r["window_id"] for r in one] == [5, 3, 4]
    assert [r["0_latency"] for r in one] == [1.5, None, None]
    assert [r[f"0_{CPU}"] for r in one] == [2, None, 3] and one[0]["n"] == 3
    two = rows["home/two", 0]
    # one junk cell drops a resource column of its file, but not a latency column
    assert two["0_latency"] == 8 and two[f"0_{CPU}"] is None and two["cpu_available"] == 0
    assert rows["three", 0]["cpu_available"] == 0 and rows["three", 0]["source_level_1"] == "three.csv"
    assert (one[0]["source_file"], one[0]["source_level_1"], one[0]["source_level_2"], one[0]["source_level_3"]) == (
        "one.csv", "compose", "a", "one.csv")


def test_large_file_order_across_blocks(spark, folder):
    body = "\n".join(f"{i},{i % 13}" for i in range(20_000))
    put(folder, "x/long.csv", "window_id,0_latency\n" + body + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        wide, _ = src.read_telemetry_csv(spark, folder)
        assert wide.where("seq <> window_id").isEmpty() and wide.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.set("spark.sql.files.openCostInBytes", "4194304")


def small_blocks(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")


@pytest.mark.parametrize("size", [134217728, 700])
def test_quoted_line_breaks_across_blocks(spark, folder, size):
    """Records over several lines and blocks, doubled quotes, blank lines in a cell, a header of two lines, a quote that never closes."""
    rng = random.Random(4)
    tables = {}
    for name, unclosed in (("x/one", False), ("x/two", True), ("plain", False)):
        rows = [["window_id", "0_latency", "no\nte"] if name == "x/one" else ["window_id", "0_latency", "note"]]
        for i in range(120):
            note = f"n{i}" if name == "plain" else rng.choice(["plain", 'say ""hi""', "a\nb", "a\n\n\nb,c", "long\n" * 60 + "end", '""\n""', ""])
            rows.append([str(i), str(i % 7), note])
        tables[name] = [[c.replace('""', '"') for c in r] for r in rows]
        body = "\n".join(",".join(f'"{c}"' if set(c) & set('\n,"') else c for c in r) for r in rows) + "\n"
        put(folder, f"{name}.csv", body + ('120,3,"never closed\n121,4,plain\n' if unclosed else ""))
    small_blocks(spark, size)
    try:
        wide, _ = src.read_telemetry_csv(spark, folder)
        got = {}
        for r in wide.orderBy("seq").collect():
            got.setdefault(r["sample_key"], []).append(r)
        for name, rows in tables.items():
            found = got[name]
            note = rows[0][2]
            assert [(r["window_id"], r["0_latency"]) for r in found[:120]] == [(int(a), float(b)) for a, b, _ in rows[1:]]
            assert [r[note] or "" for r in found[:120]] == [c for *_, c in rows[1:]]
            assert len(found) == (122 if name == "x/two" else 120)
    finally:
        small_blocks(spark, 134217728)
        spark.conf.set("spark.sql.files.openCostInBytes", "4194304")


def test_batch_slice(spark):
    paths = spark.createDataFrame([(f"/r/b/{i}.csv",) for i in range(3)] + [("/r/a.csv",), ("/r/b-1/x.csv",)], "path string")
    got = src.batch_slice(paths, 1, 2).orderBy("file_index").collect()
    assert [(r["path"], r["part_name"]) for r in got] == [
        ("/r/b/0.csv", "part_0001_0002"), ("/r/b/1.csv", "part_0001_0002")]
    assert src.batch_slice(paths, 3).count() == 2


def test_sample_has_exact_size_and_repeats(spark):
    df = spark.range(25).select(F.lit("s").alias("sample_key"), F.col("id").alias("seq"), F.lit(25).alias("n"))
    first = sampled(df, Layout(("sample_key",)), 0.1, 7).select("seq").collect()
    again = sampled(df.repartition(4), Layout(("sample_key",), True), 0.1, 7).select("seq").collect()
    assert sorted(first) == sorted(again) and len(first) == 2
    assert sorted(first) != sorted(sampled(df, Layout(("sample_key",)), 0.1, 8).select("seq").collect())
    assert sampled(df, Layout(("sample_key",)), 1.0).count() == 25 and capped(df, 4).count() == 4


def test_manifest_of_paths(spark):
    paths = [
        "/o/predictive_processed_dataset/p0/compose/a/train.parquet",
        "/o/predictive_processed_dataset/p0/compose/a/train.csv",
        "/o/predictive_processed_dataset/p0/compose/a/val.parquet",
        "/o/predictive_processed_dataset/p0/compose/a/test.PARQUET",
        "/o/predictive_processed_dataset/p0/compose/a/aggregation_metadata.json",
        "/o/predictive_processed_dataset/p0/home/b/train.parquet",
        "/o/predictive_processed_dataset/train.parquet",
        "/other/predictive_processed_dataset/p0/compose/a/train.txt",
    ]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    assert [r[0] for r in mf.dataset_roots(df).collect()] == [
        "/o/predictive_processed_dataset", "/other/predictive_processed_dataset"]
    index = mf.files_index(df)
    rows = {r["absolute_path"]: r for r in index.collect()}
    assert len(rows) == 6
    alone = rows["/o/predictive_processed_dataset/train.parquet"]
    assert (alone["logical_sample_key"], alone["part_name"], alone["scenario"]) == ("train", "train.parquet", "")
    samples = {r["logical_sample_key"]: r for r in mf.samples_index(index).collect()}
    assert samples["p0/compose/a"]["is_complete_for_training"] and samples["p0/compose/a"]["file_count"] == 4
    assert not samples["p0/home/b"]["is_complete_for_training"]
    # Parquet wins over CSV, so no row is read twice
    chosen = [r["absolute_path"] for r in src.select_role(index, "train", "compose").collect()]
    assert chosen == ["/o/predictive_processed_dataset/p0/compose/a/train.parquet"]
    assert src.select_role(index, "train", "all").count() == 3


def test_output_dir(spark):
    df = spark.createDataFrame([("compose/x/y/run.csv",), ("home/run.csv",), ("run.csv",)], "p string")
    got = [r[0] for r in df.select(out.output_dir(F.col("p"), F.lit("part_0000_0001"))).collect()]
    assert got == [
        "predictive_processed_dataset/part_0000_0001/compose/x/y/run",
        "predictive_processed_dataset/part_0000_0001/home/run",
        "predictive_processed_dataset/part_0000_0001/run.csv/run",
    ]


def test_checks(spark):
    df = spark.createDataFrame([(0.5, "train"), (1.5, "odd")], "p double, file_role string")
    with pytest.raises(KeyError, match="missing_one"):
        val.require_columns(df, ["p", "missing_one"])
    with pytest.raises(KeyError):
        val.require_target(df, "target_x")
    with pytest.raises(ValueError):
        val.require_rows(df.limit(0))
    with pytest.raises(ValueError, match="1 values"):
        val.require_probabilities(df, "p")
    with pytest.raises(ValueError, match="odd"):
        val.require_allowed(df, "file_role", val.FILE_ROLES)
    with pytest.raises(ValueError):
        out.save_table(df, "/tmp/x.orc")
    with pytest.raises(ValueError):
        out.save_json(df, "/tmp/x.txt")


def test_whole_run_from_csv_to_reports(spark, folder):
    def text(n, seed):
        lines = [f"window_id,label_trace,0_latency,1_latency,0_{CPU}"]
        lines += [f"{i},{i % 2},{(i * seed) % 37},{(i * 7) % 11},{i % 5}" for i in range(n)]
        return "\n".join(lines) + "\n"

    raw, made = f"{folder}/in", f"{folder}/out"
    put(raw, "compose/run_a.csv", text(60, 3))
    put(raw, "compose/run_b.csv", text(50, 5))
    put(raw, "home/run_c.csv", text(55, 7))
    put(raw, "home/tiny.csv", text(5, 7))
    put(raw, "home/empty.csv", "\n")
    found = {r["sample_key"].split("/")[-1]: r for r in training.run_preprocessing(spark, raw, made, Settings()).collect()}
    assert found["run_a"]["status"] == "ok" and found["tiny"]["status"] == "failed"
    assert found["empty.csv"]["reason"] == "unreadable file"
    index = training.run_manifest(spark, made, f"{folder}/manifest")
    samples = {r["logical_sample_key"]: r for r in mf.samples_index(index).collect()}
    complete = [k for k, r in samples.items() if r["is_complete_for_training"]]
    assert len(complete) == 3 and all("tiny" not in k for k in complete)
    stored = spark.read.parquet(f"{folder}/manifest/merged_files_index.parquet")
    home = training.load_role(spark, stored, "train", "home")
    assert {r[0] for r in home.select("sample_key").distinct().collect()} == {"home/run_c"}
    assert training.load_role(spark, stored, "train", "all", sample_frac=0.1).count() == 4 + 3 + 4
    sizes = {"random_forest": 3, "hist_gradient_boosting": 2}
    for task, names in (("regression", training.REGRESSION), ("classification", training.CLASSIFICATION)):
        metrics = training.run_training(spark, stored, made, task, sample_frac=None, **sizes)
        assert metrics.count() == 9 and set(names) <= set(metrics.columns)
        predictions = src.load_predictions(spark, f"{made}/predictions/{task}")
        assert {r[0] for r in predictions.select("model").distinct().collect()} == {
            "dummy", "random_forest", "hist_gradient_boosting"}
    document = spark.read.json(f"{made}/reports/regression/all/regression_metrics.json").first()
    assert document["target_col"] == "target_p95_latency_t_plus_1" and document["models"]["dummy"]["test"]["rmse"] > 0
    again = src.load_metrics(spark, f"{made}/reports/regression", "regression", "model string, split string, mae double, rmse double, r2 double")
    assert {r["scenario"] for r in again.collect()} == {"all"}


def test_a_second_run_replaces_the_first(spark, folder):
    raw, made = f"{folder}/in", f"{folder}/out"
    for k in (3, 5):
        rows = "\n".join(f"{i},{i % 2},{(i * k) % 37},{i % 5}" for i in range(40))
        put(raw, f"compose/run {k}.csv", f"window_id,label_trace,0_latency,0_{CPU}\n{rows}\n")

    def stored():
        index = mf.files_index(src.discover(spark, made, "").select("path"))
        sizes = {
            role: src.read_role(spark, index, role).count() for role in ("aggregated", "marked", "predictive", "train", "val", "test")
        }
        return sizes, [r.asDict() for r in mf.samples_index(index).select("has_predictive", "has_metadata", "has_train").collect()]

    first = training.run_preprocessing(spark, raw, made, Settings()).collect()
    before = stored()
    again = training.run_preprocessing(spark, raw, made, Settings()).collect()
    assert stored()[0] == before[0] and sorted(map(str, first)) == sorted(map(str, again))
    assert before[0]["aggregated"] == 80 and before[0]["predictive"] == sum(before[0][r] for r in ("train", "val", "test")) == 72
    assert before[1] == [{"has_predictive": True, "has_metadata": True, "has_train": True}] * 2
    documents = spark.read.json(f"{made}/{out.DATASET_DIR}/*/*/*/file_role=metadata/*.json").collect()
    assert {r["row_count_predictive"] for r in documents} == {36} and all(r["latency_threshold"] > 0 for r in documents)


def test_later_runs_leave_nothing_stale_and_nothing_twice(spark, folder):
    """An added file changes the part, a sample fails, one becomes unreadable, and a split becomes empty."""
    raw, made = f"{folder}/in", f"{folder}/out"

    def source(name, n):
        rows = "".join(f"{i},{i % 2},{(i * 3) % 37},{i % 5}\n" for i in range(n))
        put(raw, f"compose/{name}.csv", f"window_id,label_trace,0_latency,0_{CPU}\n{rows}")

    def loaded():
        index = training.run_manifest(spark, made, f"{folder}/manifest")
        rows = {}
        for role in ("aggregated", "marked", "predictive", "train", "val", "test"):
            for r in src.read_role(spark, index, role).groupBy("sample_key").count().collect():
                rows.setdefault(r["sample_key"].split("/")[-1], {})[role] = r["count"]
        complete = {r["logical_sample_key"].split("%2F")[-1]: r["is_complete_for_training"] for r in mf.samples_index(index).collect()}
        return rows, complete

    def sizes(n):
        kept = n - 4
        train, val = int(kept * 0.7), int(kept * 0.15)
        parts = {"train": train, "val": val, "test": kept - train - val}
        return {"aggregated": n, "marked": n, "predictive": kept} | {k: v for k, v in parts.items() if v}

    for name in ("a", "b c", "d"):
        source(name, 40)
    training.run_preprocessing(spark, raw, made, Settings(min_rows=5))
    assert loaded() == ({n: sizes(40) for n in ("a", "b c", "d")}, {n: True for n in ("a", "b c", "d")})

    source("e", 30)  # one more file: another part name
    source("b c", 3)  # fails its gate now
    source("d", 10)  # its validation split is empty now
    put(raw, "compose/a.csv", "\n")  # unreadable now
    report = {r["sample_key"]: r["status"] for r in training.run_preprocessing(spark, raw, made, Settings(min_rows=5)).collect()}
    assert sum(s == "failed" for s in report.values()) == 2
    rows, complete = loaded()
    assert rows == {"d": sizes(10), "e": sizes(30)} and "val" not in rows["d"]
    assert complete == {"d": False, "e": True}

    # a run that dies before its commit changes nothing
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(out, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        source("e", 20)
        with pytest.raises(RuntimeError, match="lost"):
            training.run_preprocessing(spark, raw, made, Settings(min_rows=5))
    assert loaded() == (rows, complete)


def test_text_labels_spaces_and_long_headers(spark, folder):
    wide = ",".join(f"{i}_latency" for i in range(60)) + "," + ",".join("x" * 100_000 + str(i) for i in range(12)) + ",last_latency"
    put(folder, "main/in/a b+c%d/one two.csv", f"window_id,label_trace,{wide}\n1,good,{','.join(str(i) for i in range(60))},{'z,' * 12}9\n2,bad,{','.join('1' * 60)},{'z,' * 12}8\n")
    rows, _ = src.read_telemetry_csv(spark, f"{folder}/main/in")
    got = rows.select("sample_key", "source_level_1", "label_trace", "59_latency", "last_latency").orderBy("seq").collect()
    assert [tuple(r) for r in got] == [("a b+c%d/one two", "a b+c%d", "good", 59.0, "9"), ("a b+c%d/one two", "a b+c%d", "bad", 1.0, "8")]
    table = spark.range(3)
    table.write.parquet(f"{folder}/x y+z.parquet")
    listing = src.discover(spark, folder, ".parquet")
    read, skipped = src.read_tolerant(spark, listing.where("path not like '%_SUCCESS%'"), folder, table.schema)
    assert read.count() == 3 and {r["dataset_source_path"].split("/")[-2] for r in read.collect()} == {"x y+z.parquet"}
    assert skipped.join(read.selectExpr("dataset_source_path AS p").distinct(), src.plain_path(F.col("path")) == src.plain_path(F.col("p")), "left_semi").isEmpty()


def test_roles_of_another_tool_are_placed_by_stored_order(spark, folder):
    """Files without sample_key and pos, CSV and Parquet, under two roots with the same inner paths."""
    for root in ("a", "b"):
        base = f"{folder}/{root}/predictive_processed_dataset/part_0/compose"
        put(base, "one/train.csv", "x,y\n" + "".join(f"{i},{root}\n" for i in range(30)))
        rows = spark.range(100, 120).selectExpr("cast(id AS int) AS x", f"'{root}' AS y").coalesce(1)
        rows.write.parquet(f"{base}/two/file_role=train")
    index = mf.files_index(src.discover(spark, folder, "").select("path"))

    def drawn(**settings):
        got = {}
        for r in training.load_role(spark, index, "train", "compose", **settings).collect():
            got.setdefault((r["y"], r["x"] >= 100), set()).add(r["x"])
        return got

    assert {k: len(v) for k, v in drawn().items()} == {(y, z): 20 if z else 30 for y in "ab" for z in (False, True)}
    assert drawn(max_rows=7) == {(y, z): {x + 100 * z for x in range(7)} for y in "ab" for z in (False, True)}
    some = drawn(sample_frac=0.1, seed=3)
    assert {k: len(v) for k, v in some.items()} == {(y, z): 2 if z else 3 for y in "ab" for z in (False, True)}
    assert drawn(sample_frac=0.1, seed=3) == some != drawn(sample_frac=0.1, seed=4)
    assert "_source" not in training.load_role(spark, index, "train").columns


def test_prediction_tree_of_any_depth_with_damaged_files(spark, folder):
    head = "y_pred,extra,y_true\n"
    put(folder, "regression/home/forest_test_predictions.csv", head + "1.5,x,2\n" + '2.5,"a\nb",3\n')
    put(folder, "deep/er/classification/all/forest_test_predictions.csv", "split,y_true,y_pred,anomaly_probability\ntest,1,0,0.25\n")
    put(folder, "top_test_predictions.csv", head + "7,x,8\n")
    put(folder, "home/lacking_test_predictions.csv", "y_true,z\n1,2\n")
    put(folder, "home/broken_test_predictions.parquet", "no table")
    put(folder, "home/metrics.csv", "y_true,y_pred\n1,2\n")
    spark.createDataFrame([(1, 0.5), (0, 0.1)], "y_true int, y_pred double").coalesce(1).write.parquet(
        f"{folder}/regression/home/tree_test_predictions.parquet")
    rows, skipped = src.load_prediction_tree(spark, folder)
    got = sorted(((r["prediction_file"], r["task"], r["scenario"], r["model"], r["step"], r["y_true"], r["y_pred"]) for r in rows.collect()))
    assert got == [
        ("deep/er/classification/all/forest_test_predictions.csv", "classification", "all", "forest", 0, 1.0, 0.0),
        ("regression/home/forest_test_predictions.csv", "regression", "home", "forest", 0, 2.0, 1.5),
        ("regression/home/forest_test_predictions.csv", "regression", "home", "forest", 1, 3.0, 2.5),
        ("regression/home/tree_test_predictions.parquet", "regression", "home", "tree", 0, 1.0, 0.5),
        ("regression/home/tree_test_predictions.parquet", "regression", "home", "tree", 1, 0.0, 0.1),
        ("top_test_predictions.csv", None, None, "top", 0, 8.0, 7.0),
    ]
    assert {r["path"].split("/")[-1] for r in skipped.collect()} == {"lacking_test_predictions.csv", "broken_test_predictions.parquet"}


def test_prediction_tree_is_written_in_stored_order(spark):
    """Rows that lie out of order over many files, as those of large tables do."""
    rows = spark.range(0, 4000, 1, 7).selectExpr(
        "if(id % 2 = 0, 'a', 'b') AS scenario", "if(id % 4 < 2, 'm', 'n') AS model", "3999 - id AS step", "double(3999 - id) AS y_true",
        "0.5D AS y_pred")
    found, skipped = src.load_prediction_tree(spark, prediction_tree(spark, rows, ["scenario"], "scenario = 'a'"))
    read = {}
    for r in found.collect():
        read.setdefault((r["scenario"], r["model"]), {})[r["step"]] = r["y_true"]
    assert len(read) == 4 and all(len(values) == 1000 for values in read.values())
    assert all([values[i] for i in range(1000)] == sorted(values.values()) for values in read.values())
    assert skipped.count() == 1


def test_tables_without_rows_are_readable(spark, folder):
    """A writer's first task leaves a table without rows; only damaged files are skipped."""
    some, none = spark.range(3).coalesce(1), spark.range(3).where("id > 5").coalesce(1)
    some.write.parquet(f"{folder}/good")
    none.write.parquet(f"{folder}/od[d] {{x}}+%41/none.parquet")
    whole = next(f"{folder}/good/{f}" for f in os.listdir(f"{folder}/good") if f.endswith(".parquet"))
    with open(whole, "rb") as f:
        content = f.read()
    put(folder, "bad/text.parquet", "no table")
    for name, damaged in (("cut", content[:-9]), ("foot", b"PAR1" + b"\0" * 40 + b"PAR1")):
        with open(f"{folder}/bad/{name}.parquet", "wb") as f:
            f.write(damaged)
    rows, skipped = src.read_tolerant(spark, src.discover(spark, folder, ".parquet"), folder, some.schema)
    assert rows.count() == 3
    assert sorted(r["path"].split("/")[-1] for r in skipped.collect()) == ["cut.parquet", "foot.parquet", "text.parquet"]
    assert src.read_tolerant(spark, src.discover(spark, f"{folder}/good", ".parquet"), f"{folder}/good", some.schema)[1].isEmpty()


def test_prediction_tables_without_rows_are_not_skipped(spark, folder):
    put(folder, "regression/all/one_test_predictions.csv", "y_true,y_pred\n1,2\n")
    put(folder, "regression/all/head_test_predictions.csv", "y_true,y_pred\n")
    put(folder, "regression/all/lacking_test_predictions.csv", "y_true,z\n")
    put(folder, "regression/all/broken_test_predictions.parquet", "no table")
    spark.createDataFrame([], "y_true double, y_pred double").coalesce(1).write.parquet(f"{folder}/regression/all/none_test_predictions.parquet")
    rows, skipped = src.load_prediction_tree(spark, folder)
    assert [(r["model"], r["step"], r["y_true"]) for r in rows.collect()] == [("one", 0, 1.0)]
    assert sorted(r["path"].split("/")[-1] for r in skipped.collect()) == ["broken_test_predictions.parquet", "lacking_test_predictions.csv"]


def test_every_file_is_accounted_for(spark, folder):
    """Empty files and hidden names, of files and directories, fail with a reason and drop what an earlier run made of them."""
    raw, made = f"{folder}/in put", f"{folder}/out"
    rows = "".join(f"{i},{i % 2},{(i * 3) % 37},{i % 5}\n" for i in range(40))
    table = f"window_id,label_trace,0_latency,0_{CPU}\n{rows}"
    for name in ("top.csv", "compose/a.csv", "compose/b.csv", "compose/deep/c+d %25.csv"):
        put(raw, name, table)
    put(raw, "compose/note.txt", "")
    training.run_preprocessing(spark, raw, made, Settings(min_rows=5))

    put(raw, "compose/b.csv", "")
    for name in ("_x.csv", "compose/.y.csv", "_tmp/z.csv"):
        put(raw, name, table)
    listed = {os.path.relpath(src_path(r["path"]), raw): (r["length"], r["left_out"]) for r in every_file(spark, raw).collect()}
    full = len(table)
    assert listed == {
        "top.csv": (full, None), "compose/a.csv": (full, None), "compose/deep/c+d %25.csv": (full, None),
        "compose/b.csv": (0, "empty file"), "_x.csv": (full, "hidden name"), "compose/.y.csv": (full, "hidden name"), "_tmp/z.csv": (full, "hidden name"),
    }
    report = {r["sample_key"].split("/")[-1]: (r["status"], r["reason"]) for r in training.run_preprocessing(spark, raw, made, Settings(min_rows=5)).collect()}
    assert {k: v for k, v in report.items() if v[0] == "failed"} == {
        "b.csv": ("failed", "empty file"), "_x.csv": ("failed", "hidden name"), ".y.csv": ("failed", "hidden name"), "z.csv": ("failed", "hidden name"),
    }
    assert sum(v[0] == "ok" for v in report.values()) == 3
    index = training.run_manifest(spark, made, f"{folder}/manifest")
    samples = {r["sample_key"] for r in src.read_role(spark, index, "aggregated").select("sample_key").distinct().collect()}
    assert samples == {"top", "compose/a", "compose/deep/c+d %25"}


def test_every_file_of_an_empty_tree(spark, folder):
    assert every_file(spark, folder).collect() == []


def src_path(path):
    return path.removeprefix("file:")
