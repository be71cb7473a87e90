"""Batch tables: repeated and killed batches, records set aside, figures from commits."""

import pytest
from pyspark.sql import functions as F

from tidemark.session import fs_list
from tidemark.streaming import batches

HEAD = "store_id,item_id,wm_yr_wk,sell_price\n"


def _drop(path, name, lines):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(HEAD + "".join(f"{x}\n" for x in lines))


def _run(spark, tmp_path, feed="prices", fmt="csv"):
    q = batches.start_batches(spark, feed, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c"), "testing", fmt, available_now=True)
    q.awaitTermination()
    return str(tmp_path / "t")


def test_bad_records_are_set_aside(spark, tmp_path):
    _drop(tmp_path / "in", "a.csv", ["S1,I1,11101,2.5", "S1,I2,week,2.5", "S2,I1,11102,", "S3,I1,11102,cheap", "S4"])
    t = _run(spark, tmp_path)
    good = batches.read_rows(spark, t, "prices").orderBy("store_id").collect()
    assert [(r.store_id, r.wm_yr_wk, r.price_missing) for r in good] == [("S1", 11101, False), ("S2", 11102, True)]
    bad = batches.read_set_aside(spark, t, "prices").collect()
    assert sorted(r.record for r in bad) == ["S1,I2,week,2.5", "S3,I1,11102,cheap", "S4"]
    assert all(r.source_file.endswith("a.csv") and r.reason for r in bad)
    (m,) = batches.monitor(spark, {"prices": t}).collect()
    assert (m.data_source, m.record_count, m.set_aside) == ("prices", 2, 3) and m.first_processed <= m.last_processed


def test_killed_batch_leaves_no_duplicate(spark, tmp_path, monkeypatch):
    """Ended between its rows and its commit: the rows aren't there, and the repeated batch writes them once."""
    _drop(tmp_path / "in", "a.csv", [f"S{i},I,{11100 + i},1.0" for i in range(20)])
    real = batches.Observation

    class Ending(real):
        get = property(lambda self: (_ for _ in ()).throw(RuntimeError("killed before the commit")))

    monkeypatch.setattr(batches, "Observation", Ending)
    with pytest.raises(Exception, match="killed before the commit"):
        _run(spark, tmp_path)
    t = str(tmp_path / "t")
    assert fs_list(spark, f"{t}/rows") == ["batch_id=0"] and batches.read_rows(spark, t, "prices").count() == 0
    monkeypatch.setattr(batches, "Observation", real)
    _run(spark, tmp_path)
    assert batches.read_rows(spark, t, "prices").count() == 20 and batches.monitor(spark, {"p": t}).first().record_count == 20
    # a committed batch that is handed over again writes nothing
    raw = spark.read.schema(batches.SCHEMAS["prices"]).csv(str(tmp_path / "in"), header=True)
    raw = raw.withColumns({batches.RECORD: F.lit(None).cast("string"), "source_file": F.lit("x")})
    batches.batch_writer(t, "prices")(raw, 0)
    assert batches.read_rows(spark, t, "prices").count() == 20
    # a restart reads the new file only
    _drop(tmp_path / "in", "b.csv", ["S99,I,11101,1.0", "S99,I,x,1.0"])
    _run(spark, tmp_path)
    _run(spark, tmp_path)
    m = batches.monitor(spark, {"p": t}).first()
    stored = batches.read_rows(spark, t, "prices").agg(F.count("*").alias("n"), F.min("processed_timestamp").alias("a"), F.max("processed_timestamp").alias("b")).first()
    assert (m.record_count, m.set_aside) == (21, 1) and (stored.n, stored.a, stored.b) == (21, m.first_processed, m.last_processed)


@pytest.mark.parametrize("fmt", ["json", "parquet", "csv"])
def test_calendar_dates_and_formats(spark, tmp_path, fmt):
    days = ["2016-01-01", "2016-13-01", None, "2016-01-02"]
    fields = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in batches.SCHEMAS["calendar"].fields if f.name != "date")
    df = spark.createDataFrame([(d,) for d in days], "date string").selectExpr("date", fields.split(", CAST")[0], *["CAST" + x for x in fields.split(", CAST")[1:]])
    df = df.select(*[f.name for f in batches.SCHEMAS["calendar"].fields])
    w = df.write.option("header", True) if fmt == "csv" else df.write
    w.format(fmt).save(str(tmp_path / "in"))
    t = _run(spark, tmp_path, "calendar", fmt)
    assert sorted(str(r.date) for r in batches.read_rows(spark, t, "calendar").collect()) == ["2016-01-01", "2016-01-02", "None"]
    (bad,) = batches.read_set_aside(spark, t, "calendar").collect()
    assert bad.reason == "date can't be read" and "2016-13-01" in bad.record


def test_empty_tables(spark, tmp_path):
    t = str(tmp_path / "none")
    assert batches.read_rows(spark, t, "prices").count() == batches.read_set_aside(spark, t, "calendar").count() == batches.monitor(spark, {"p": t}).count() == 0
    _drop(tmp_path / "in", "a.csv", [])
    t = _run(spark, tmp_path)
    assert batches.read_rows(spark, t, "prices").count() == 0
    with pytest.raises(ValueError):
        batches.checked_stream(spark, "sales", t)
