import pytest
from pyspark.sql import functions as F

from subscope import __main__ as cli
from subscope import session
from subscope.plans.etl import run_etl
from subscope.schemas import FEATURES, RAW_SCHEMA
from subscope.sources.fixtures import usage_raw
from subscope.sources.run_log import append_run, timed_job
from subscope.sources.tables import read_csv, read_parquet, write_csv, write_parquet

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def csv(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "csv")
    write_csv(usage_raw(spark, SF), path)
    return path


def test_csv_binds_by_position_and_keeps_bad_rows(spark, tmp_path):
    header = ",".join(f"other{i}" for i in range(20))
    good = "c1,5,408,no,yes,1,1.5,2,3,4,5,6,7,8,9,10,11,12,13,yes"
    bad = "c2,abc,408,no,yes,1,NaN,2,3,4,5,6,7,8,9,10,11,12,13,no"
    (tmp_path / "in.csv").write_text("\n".join([header, good, bad, "c3,7"]) + "\n")
    rows = {r["customer_id"]: r for r in read_csv(spark, str(tmp_path)).collect()}
    assert rows["c1"]["account_length"] == 5 and rows["c1"]["churn"] == "yes"
    assert rows["c2"]["account_length"] is None
    assert rows["c2"]["total_day_minutes"] != rows["c2"]["total_day_minutes"]
    assert (rows["c3"]["account_length"], rows["c3"]["churn"]) == (7, None)


def test_csv_reads_the_schema_without_a_pass(spark, csv):
    assert read_csv(spark, csv).schema == RAW_SCHEMA


def test_parquet_overwrite_partition_and_cache(spark, tmp_path):
    path = str(tmp_path / "t")
    write_parquet(spark.range(5), path)
    write_parquet(spark.range(3).withColumn("k", F.col("id") % 2), path, partition_by=["k"])
    df = read_parquet(spark, path, cache=True)
    assert df.count() == 3 and df.is_cached
    df.unpersist()


@pytest.mark.parametrize("stage", [False, True])
def test_etl_job(spark, csv, tmp_path, stage):
    out, bounds = str(tmp_path / "out"), str(tmp_path / "bounds")
    stage_path = str(tmp_path / "staged") if stage else None
    figures = run_etl(spark, csv, out, bounds, stage_path)
    df = spark.read.parquet(out)
    assert figures["rows"] == df.count() == 6000
    assert figures["rows_without_minutes"] == df.where("daytime_ratio is null").count()
    assert df.columns == RAW_SCHEMA.names + list(FEATURES[17:])
    kinds = dict(df.dtypes)
    assert kinds["churn"] == "int"
    assert all(kinds[f] == "double" for f in FEATURES)
    assert spark.read.parquet(bounds).count() == 17


def test_label_joins_the_capping_on_request(spark, csv, tmp_path):
    run_etl(spark, csv, str(tmp_path / "out"), include_label=True)
    assert dict(spark.read.parquet(str(tmp_path / "out")).dtypes)["churn"] == "double"


def test_run_records_accumulate(spark, tmp_path):
    path = str(tmp_path / "runs")
    append_run(spark, path, {"a": 1, "b": ["x"]}, {"m": 0.5}, run_id="r1")
    append_run(spark, path, {}, {"m": 0.6}, run_id="r2")
    rows = spark.read.parquet(path).collect()
    assert {(r["run_id"], r["name"], r["value"]) for r in rows if r["name"] == "m"} == {
        ("r1", "m", 0.5),
        ("r2", "m", 0.6),
    }
    assert next(r["text"] for r in rows if r["name"] == "b") == '["x"]'


def test_failed_job_is_recorded_and_raised(spark, tmp_path):
    def fail():
        raise KeyError("broken")

    with pytest.raises(KeyError):
        timed_job(spark, "etl", fail, str(tmp_path / "runs"))
    rows = {r["name"]: r for r in spark.read.parquet(str(tmp_path / "runs")).collect()}
    assert rows["status"]["text"] == "failed" and rows["seconds"]["value"] >= 0


def test_command_line(spark, csv, tmp_path, monkeypatch):
    monkeypatch.setattr(cli, "build_session", lambda config: spark)
    table, report, log = (str(tmp_path / n) for n in ("table", "report", "log"))
    cli.main(["--log", log, "etl", csv, table])
    cli.main(["--log", log, "profile", table, report, "--cache"])
    (tmp_path / "events").mkdir()
    (tmp_path / "events" / "a.txt").write_text('{"customer_id": "c"}\n')
    cli.main(
        [
            *["--log", log, "stream", str(tmp_path / "sink"), str(tmp_path / "cp")],
            *["--text", str(tmp_path / "events"), "--available-now"],
        ]
    )
    summary = spark.read.parquet(f"{report}/summary").first()
    assert summary["total_records"] == 6000
    assert spark.read.parquet(f"{report}/density_by_label").count() > 0
    assert spark.read.parquet(str(tmp_path / "sink")).count() == 1
    jobs = spark.read.parquet(log).where("name = 'job'")
    assert {r["text"] for r in jobs.collect()} == {"etl", "profile", "stream"}


def test_session_settings(spark):
    config = session.session_config("x", cluster=True, **{"spark.app.name": "y"})
    assert config["spark.app.name"] == "y"
    assert config["spark.sql.adaptive.enabled"] == "true"
    assert "spark.sql.autoBroadcastJoinThreshold" not in config
    assert "spark.sql.adaptive.advisoryPartitionSizeInBytes" in config


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == named
    assert session.scratch_path(spark, "x").startswith(named)
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_cluster_without_shared_folder_is_refused():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
