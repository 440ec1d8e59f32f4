import pytest

from riskloom.operators import integrity
from riskloom.plans import pipeline
from riskloom.sources import star, testdata
from riskloom.sources.schemas import STAR
from riskloom.storage import materialize, shared_dir
from tests.conftest import DATA


def test_csv_by_header(spark, tmp_path):
    path = tmp_path / "devices.csv"
    path.write_text(
        "is_trusted,device_id,extra,first_seen_at,customer_id,device_type\n"
        "true,D1,x,2026-01-02 03:04:05,C1,mobile_ios\nfalse,X1,y,2026-02-03 00:00:00,C1,desktop_web\n"
    )
    got = star.read_csv(spark, str(path), STAR["dim_device"])
    assert got.schema == STAR["dim_device"].schema
    assert [(r.device_id, r.is_trusted, str(r.first_seen_at)) for r in got.orderBy("device_id").collect()] == [
        ("D1", True, "2026-01-02 03:04:05"), ("X1", False, "2026-02-03 00:00:00")
    ]


def test_csv_errors(spark, tmp_path):
    short = tmp_path / "short.csv"
    short.write_text("device_id\nD1\n")
    with pytest.raises(ValueError, match="customer_id"):
        star.read_csv(spark, str(short), STAR["dim_device"])
    bad = tmp_path / "bad.csv"
    bad.write_text("device_id,customer_id,device_type,first_seen_at,is_trusted\nD1,C1,web,yesterday,true\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        star.read_csv(spark, str(bad), STAR["dim_device"]).collect()


def test_reload_replaces_and_empties_derived(spark, tmp_path):
    tables, base = testdata.star(spark, DATA), str(tmp_path)
    first = star.load_star(tables, base)
    tables["fact_transaction"].select("transaction_id").write.mode("overwrite").parquet(f"{base}/txn_features")
    assert star.load_star(tables, base) == first == {"dim_customer": 150, "dim_device": first["dim_device"], "fact_transaction": 1000}
    assert star.read_table(spark, base, "txn_features").count() == 0
    read = star.read_star(spark, base)
    assert all(read[t].schema.names == spec.schema.names for t, spec in STAR.items())


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_materialize_keeps_schema(spark):
    df = spark.range(5).selectExpr("id", "cast(id as decimal(12,2)) AS d", "cast(id % 2 as string) AS p")
    back = materialize(df, "t", ("p",))
    assert sorted(back.schema.names) == ["d", "id", "p"]
    assert sorted(back.select("id", "d", "p").collect()) == sorted(df.collect())


def test_pipeline(spark, tmp_path):
    settings = pipeline.Settings(
        valid_start=testdata.VALID_START, test_start=testdata.TEST_START, forest_trees=20, forest_sample=128,
        boost_trees=4, boost_patience=2, learning_rate=0.3,
    )
    counts = pipeline.run(spark, testdata.star(spark, DATA), str(tmp_path), settings)
    assert counts["txn_features"] == counts["txn_risk_scores"] == counts["bi_fact_transactions"] == 1000
    assert counts["bi_model_performance"] == 4 and counts["bi_dim_date"] == 30
    scores = star.read_table(spark, str(tmp_path), "txn_risk_scores")
    assert scores.filter("anomaly_risk_score NOT BETWEEN 0 AND 100").count() == 0
    report = spark.read.parquet(f"{tmp_path}/validation_report")
    assert report.filter("violations > 0").count() == 0
    assert {r.table_name for r in report.select("table_name").distinct().collect()} == {
        "dim_customer", "dim_device", "fact_transaction", "txn_features", "txn_risk_scores", "bi_model_performance", "bi_scenario_recall"
    }
    model = spark.read.json(f"{tmp_path}/web/model").first()
    assert model.flag_threshold == 60 and model.split.test_start == testdata.TEST_START and len(model.test_results) == 4
    assert model.blend.asDict() == {"xgboost": 0.8, "isolation_forest": 0.2}
    import os

    assert not [d for d in os.listdir(f"{shared_dir(spark)}/riskloom") if d.startswith("run-")]
    header = spark.read.json(f"{tmp_path}/web/header").first()
    assert header.rows == scores.filter("dataset_split = 'test'").count()
    assert spark.table("bi_fact_transactions").count() == 1000
    # a reload leaves nothing that an earlier run derived
    star.load_star(testdata.star(spark, DATA), str(tmp_path))
    for name in ("bi_fact_transactions", "txn_risk_scores", "bi_model_performance"):
        assert star.read_table(spark, str(tmp_path), name).count() == 0
    assert spark.read.schema("row bigint").json(f"{tmp_path}/web/alerts").count() == 0


@pytest.mark.parametrize(
    ("column", "value", "rule"),
    [("transaction_id", "'TXN00000001'", "primary_key"), ("amount", "cast(0 as decimal(12,2))", "amount_positive"),
     ("device_id", "'nobody'", "foreign_key"), ("city", "null", "city"), ("state", "'long'", "state")],
)
def test_a_bad_load_stops_the_run(spark, tmp_path, column, value, rule):
    from pyspark.sql import functions as F

    tables = testdata.star(spark, DATA)
    bad = F.col("transaction_id").isin("TXN00000001", "TXN00000002")
    tables["fact_transaction"] = tables["fact_transaction"].withColumn(column, F.when(bad, F.expr(value)).otherwise(F.col(column)))
    with pytest.raises(integrity.BrokenRules, match=rule):
        pipeline.run(spark, tables, str(tmp_path), pipeline.Settings(testdata.VALID_START, testdata.TEST_START))
    assert spark.read.parquet(f"{tmp_path}/validation_report").filter("violations > 0").count() >= 1
    assert not (tmp_path / "txn_risk_scores" / "dataset_split=test").exists()


def test_csv_files_in_different_orders(spark, tmp_path):
    (tmp_path / "devices.csv").mkdir()
    for i, (header, row) in enumerate([
        ("device_id,customer_id,device_type,first_seen_at,is_trusted", "D1,C1,web,2026-01-02 03:04:05,true"),
        ("customer_id,device_id,is_trusted,first_seen_at,device_type", "C2,D2,false,2026-01-02 03:04:06,ios"),
    ]):
        (tmp_path / "devices.csv" / f"{i}.csv").write_text(f"{header}\n{row}\n")
    got = star.read_star_csv(spark, str(tmp_path), ("dim_device",))["dim_device"]
    assert sorted((r.device_id, r.customer_id, r.device_type) for r in got.collect()) == [("D1", "C1", "web"), ("D2", "C2", "ios")]


def test_headers_in_one_job(spark, tmp_path):
    folder = tmp_path / "many files+.csv"
    folder.mkdir()
    names = ["device_id", "customer_id", "device_type", "first_seen_at", "is_trusted"]
    want = []
    for i in range(60):
        order = names if i % 3 else names[::-1]
        row = {"device_id": f"D{i}", "customer_id": f"C{i}", "device_type": "web, \"x\"" if i == 7 else "ios", "first_seen_at": "2026-01-02 03:04:05", "is_trusted": "true"}
        lines = [",".join(order)] + [",".join('"' + row[c].replace('"', '\\"') + '"' for c in order)] * (1 + i % 2)
        (folder / f"part {i}.csv").write_text(("\n" if i % 5 == 0 else "") + "\n".join(lines) + "\n")
        want += [(f"D{i}", f"C{i}", row["device_type"])] * (1 + i % 2)
    (folder / "empty.csv").write_text("")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    held = star.file_headers(spark, str(folder))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup("headers")) == 1
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert held.count() == 60 and held.select("header").distinct().count() == 2
    got = star.read_csv(spark, str(folder), STAR["dim_device"])
    assert sorted((r.device_id, r.customer_id, r.device_type) for r in got.collect()) == sorted(want)
    nothing = tmp_path / "nothing.csv"
    nothing.write_text("")
    with pytest.raises(ValueError, match="no files"):
        star.read_csv(spark, str(nothing), STAR["dim_device"])


def test_a_load_that_fails_leaves_the_star_before_it(spark, tmp_path):
    import os

    from pyspark.sql import functions as F

    base, tables = str(tmp_path), testdata.star(spark, DATA)
    few = {**tables, "fact_transaction": tables["fact_transaction"].limit(10), "dim_customer": tables["dim_customer"].limit(5)}
    star.load_star(few, base)
    star.publish(few["fact_transaction"].select("transaction_id"), base, "txn_features")
    reader = star.read_star(spark, base)
    broken = tables["fact_transaction"].withColumn("city", F.raise_error(F.lit("lost")).cast("string"))
    for at in STAR:
        bad = {**tables, at: broken if at == "fact_transaction" else tables[at].withColumn("customer_id", F.raise_error(F.lit("lost")).cast("string"))}
        with pytest.raises(Exception, match="lost"):
            star.load_star(bad, base)
        now = star.read_star(spark, base)
        assert (now["dim_customer"].count(), now["fact_transaction"].count()) == (5, 10)
        assert star.read_table(spark, base, "txn_features").count() == 10
    assert star.load_star(tables, base)["fact_transaction"] == 1000
    assert star.read_table(spark, base, "txn_features").count() == 0
    assert reader["fact_transaction"].count() == 10  # what began before goes on
    star.load_star(star.read_star(spark, base), base)  # from itself
    assert star.read_star(spark, base)["fact_transaction"].count() == 1000
    assert len(os.listdir(f"{base}/versions")) == len([f for f in os.listdir(f"{base}/complete") if not f.startswith(".")]) == 2
