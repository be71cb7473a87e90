import os

from tidemark import cli
from tidemark.session import build_session, get_profile, scratch_dir
from tidemark.sources import tables
from tidemark.streaming import runner


def test_train_then_score(spark, sf_small):
    root = scratch_dir(spark, "t-cli")
    cli.main(["train", "--sf", sf_small, "--models", os.path.join(root, "models"), "--max-iter", "3"])
    cli.main(["score", "--sf", sf_small, "--models", os.path.join(root, "models"), "--out", os.path.join(root, "scores")])
    scores = spark.read.parquet(os.path.join(root, "scores"))
    assert scores.count() > 0 and "predicted_demand" in scores.columns


def test_stream_command_drains_backlog(spark, sf_small):
    root = scratch_dir(spark, "t-cli-stream")
    tables.prices(spark, sf_small).repartition(2).write.option("header", True).csv(
        runner.feed_paths(root, "prices").input)
    cli.main(["stream", "--env", "testing", "--root", root, "--feeds", "prices", "--available-now"])
    out = spark.read.parquet(runner.feed_paths(root, "prices").output)
    assert out.count() == tables.prices(spark, sf_small).count()


def test_profile_conf_applied(spark):
    s = build_session(profile="production")
    assert s.conf.get("spark.sql.streaming.fileSource.log.compactInterval") == "10"
    assert get_profile("testing").trigger_interval == "1 second"


def test_features_command_writes_partitioned(spark, sf_small):
    root = scratch_dir(spark, "t-cli-feat")
    out = os.path.join(root, "features")
    cli.main(["features", "--sf", sf_small, "--out", out])
    assert any(n.startswith("date=") for n in os.listdir(out))
    assert spark.read.parquet(out).count() > 0


def test_own_demand_table_and_stored_features(spark, sf_small):
    root = scratch_dir(spark, "t-cli-own")
    demand, feats, models = (os.path.join(root, n) for n in ("demand", "features", "models"))
    tables.demand_5min(spark, sf_small).where("item_id <> 'error'").write.parquet(demand)
    cli.main(["features", "--demand", demand, "--out", feats])
    cli.main(["train", "--features", feats, "--models", models, "--max-iter", "2"])
    cli.main(["score", "--demand", demand, "--models", models, "--out", os.path.join(root, "scores")])
    scores = spark.read.parquet(os.path.join(root, "scores"))
    assert scores.count() > 0 and scores.where("item_id = 'error'").count() == 0
