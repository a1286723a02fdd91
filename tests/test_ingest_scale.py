"""Split CSV scan, dead letters, landing by record count, compaction, run ledger."""

import csv
import io
import json
import os

import pytest
from pyspark.sql import functions as F

from lakeforge import schemas as S
from lakeforge.operators import joins
from lakeforge.operators.quality import relationships_failures
from lakeforge.plans import fixtures as FX
from lakeforge.plans import ledger, marts
from lakeforge.plans import pipeline as P
from lakeforge.plans.layers import FixtureLayers
from lakeforge.sources import csv_split
from lakeforge.sources import tables as TB
from lakeforge.sources.topics import ERRORS, ingest_accounting, publish_records, read_topic_log
from lakeforge.streaming import compact as C
from lakeforge.streaming.flush import CountedLanding
from lakeforge.streaming.ingest import land_topic
from tests.conftest import SF_SMALL


def local(path):
    return path.replace("file:", "")


def put(path, text):
    os.makedirs(os.path.dirname(local(path)), exist_ok=True)
    with open(local(path), "wb") as f:
        f.write(text if isinstance(text, bytes) else text.encode())


@pytest.fixture
def small_ranges(spark):
    names = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def csv_text(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_split_records_equal_a_sequential_reader(spark, tmp_root, small_ranges, end):
    texts = ["", "plain", 'say "hi"', "a,b", "two\nlines", "\n", "\n\n\n", '"', '""\n","\n', "é世😀", "x" * 200, "line\n" * 40, "1,2,3\n4,5,6"]
    rows = [[str(i), texts[i % len(texts)], texts[(i * 7 + 3) % len(texts)]] for i in range(150)]
    put(f"{tmp_root}/in/a.csv", csv_text([["id", "p", "q"], *rows[:100]], end))
    put(f"{tmp_root}/in/b.csv", csv_text([["q", "id", "extra, quoted\nname", "p"], *[[q, i, "e", p] for i, p, q in rows[100:]]], end))
    put(f"{tmp_root}/in/c.csv", csv_text([["id"]], end))
    put(f"{tmp_root}/in/d.csv", "")
    got = csv_split.read_csv_split(spark, f"{tmp_root}/in", ["id", "p", "q"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows))
    ranges = csv_split.range_states(csv_split.line_states(csv_split.file_lines(spark, f"{tmp_root}/in")))
    assert ranges.where("inside = 1").count() > 3 and ranges.where("file like '%a.csv'").count() > 20
    every = csv_split.read_csv_split(spark, f"{tmp_root}/in")
    assert every.columns == ["id", "p", "q", "extra, quoted\nname"] and every.where("`extra, quoted\nname` = 'e'").count() == 50


def test_split_errors(spark, tmp_root, small_ranges):
    put(f"{tmp_root}/in/a.csv", "﻿id,p,q\n1,x,y\n2,x\n\n3,x,y,z\n4,\"a,b\nc\",y\n".encode() + b"5,\xff\xfe,y\n" + "6,é,\n7,x,\"open\nto,the,end\n".encode())
    put(f"{tmp_root}/in/b.csv", "p,id\nP,10\n")
    got = csv_split.read_csv_split(spark, f"{tmp_root}/in", ["id", "p", "q"], keep_errors=True).collect()
    by = {r["id"]: r for r in got}
    assert {i: r["_error"] for i, r in by.items()} == {"1": None, "2": "short", "3": "long", "4": None, "5": "utf8", "6": None, "7": "quotes", "10": None}
    assert by["4"]["p"] == "a,b\nc" and by["2"]["q"] == "" and by["2"]["_record"] == "2,x" and by["10"][:3] == ("10", "P", "") and by["6"][:3] == ("6", "é", "")
    assert all((r["_record"] is None) == (r["_error"] is None) for r in got)
    none = csv_split.read_csv_split(spark, [f"{tmp_root}/in/b.csv"], ["id"]).where("false")
    assert none.count() == 0


def test_dead_letters_are_published_in_one_pass(spark, tmp_root):
    put(f"{tmp_root}/in/a.csv", "listing_id,review_id,date,reviewer_id\n1,2,2020-01-01,3\n1,2\n,,,\n4,5,6,7,8\n")
    records = csv_split.read_csv_split(spark, f"{tmp_root}/in", keep_errors=True)
    sent = publish_records(records, S.REVIEWS_TOPIC, "review_id", f"{tmp_root}/topics")
    assert (sent.sent, sent.errors, sent.unknown_keys) == (2, 2, 0)
    log = read_topic_log(spark, f"{tmp_root}/topics")
    letters = {r["key"]: json.loads(r["value"]) for r in log.where(F.col("topic") == S.REVIEWS_TOPIC + ERRORS).collect()}
    assert letters == {"short": {"error": "short", "record": "1,2"}, "long": {"error": "long", "record": "4,5,6,7,8"}}
    r = ingest_accounting(log).collect()
    assert [(x["topic"], x["sent_records"], x["error_records"], x["short_records"], x["long_records"], x["records"]) for x in r] == [(S.REVIEWS_TOPIC, 2, 2, 1, 1, 4)]


def publish(spark, root, ids):
    df = spark.createDataFrame([(str(i), str(i), "2020-01-01", "1") for i in ids], S.text_schema(S.BRONZE_REVIEW_COLUMNS)).repartition(3)
    publish_records(df, S.REVIEWS_TOPIC, "review_id", f"{root}/topics")


def flushed(landing):
    return {r["flush"]: r["records"] for r in landing.flushes().collect()}


def test_landing_by_record_count(spark, tmp_root):
    publish(spark, tmp_root, range(23))
    make = lambda: CountedLanding(spark, S.REVIEWS_TOPIC, f"{tmp_root}/topics", f"{tmp_root}/bronze", f"{tmp_root}/ckpt", 10)
    landing = make()
    assert landing.drain(files_per_trigger=1) == 3 and flushed(landing) == {0: 10, 1: 10, 2: 3}
    assert make().drain() == 3 and flushed(landing) == {0: 10, 1: 10, 2: 3}
    publish(spark, tmp_root, range(100, 117))
    assert make().drain() == 5 and flushed(landing) == {0: 10, 1: 10, 2: 3, 3: 10, 4: 7}
    rows = spark.read.schema(S.text_schema(S.BRONZE_REVIEW_COLUMNS)).json(landing.bronze)
    assert sorted(int(r["review_id"]) for r in rows.collect()) == [*range(23), *range(100, 117)]
    assert landing.landed_rows() == 40


def test_a_repeated_micro_batch_writes_the_same_flushes(spark, tmp_root):
    landing = CountedLanding(spark, "t", f"{tmp_root}/topics", f"{tmp_root}/bronze", f"{tmp_root}/ckpt", 4)
    batch = lambda ids, file: spark.createDataFrame([(file, 0, k, f"v{i}") for k, i in enumerate(ids)], "file string, start bigint, at bigint, value string")
    landing.take(batch(range(6), "a"), 0)
    for _ in range(3):  # as after a failure before the stream's own commit
        landing.take(batch(range(6, 13), "b"), 1)
    assert landing._state() == (1, 3, 1)
    landing.finish()
    landing.finish()
    assert flushed(landing) == {0: 4, 1: 4, 2: 4, 3: 1}
    values = spark.read.text(landing.bronze).select("value").collect()
    assert sorted(r[0] for r in values) == sorted(f"v{i}" for i in range(13))


def test_compaction_keeps_rows_and_old_versions(spark, tmp_root):
    topic = S.REVIEWS_TOPIC
    publish(spark, tmp_root, range(50))
    path, manifest = f"{tmp_root}/bronze/{topic}", f"{tmp_root}/manifest"
    land_topic(spark, topic, f"{tmp_root}/bronze", f"{tmp_root}/ckpt", log_path=f"{tmp_root}/topics", records_per_file=5)
    ids = lambda version=None: sorted(int(r["review_id"]) for r in C.read_live(spark, path, manifest, S.BRONZE_REVIEW_COLUMNS, version).collect())
    small = C.live_files(spark, path, manifest).count()
    assert small >= 10 and ids() == list(range(50))
    assert C.compact(spark, path, manifest, closed_before="2001-01-01") == C.Compaction(0, 0, None)  # no day is closed
    done = C.compact(spark, path, manifest, closed_before="9999-01-01", target_bytes=1 << 20)
    assert done.replaced == small and done.made == 1 and done.version == 0 and ids() == list(range(50))
    # files landed afterwards are read at once, and the next run packs them with what is small
    publish(spark, tmp_root, range(50, 70))
    land_topic(spark, topic, f"{tmp_root}/bronze", f"{tmp_root}/ckpt", log_path=f"{tmp_root}/topics", records_per_file=5)
    assert ids() == list(range(70))
    again = C.compact(spark, path, manifest, closed_before="9999-01-01", target_bytes=1 << 20)
    assert again.version == 1 and ids() == list(range(70)) == ids(0) and C.live_files(spark, path, manifest).count() == 1
    days = C.read_live(spark, path, manifest, S.BRONZE_REVIEW_COLUMNS).select("year", "month", "day").distinct().collect()
    assert len(days) <= 2 and all(len(d["year"]) == 4 and len(d["month"]) == len(d["day"]) == 2 for d in days)


def test_bins_follow_sizes(spark):
    files = spark.createDataFrame([(f"f{i}", b, d) for i, (b, d) in enumerate([(60, "2020-01-01")] * 4 + [(500, "2020-01-01"), (60, "2020-01-02"), (60, "2020-01-03"), (60, "2020-01-03")])], "path string, bytes bigint, day string")
    got = {r["path"]: (r["day"], r["bin"]) for r in C.plan_bins(files, "2020-01-03", 100).collect()}
    # a bin ends past each multiple of 100; a lone file and a large one stay, an open day too
    assert got == {"f0": ("2020-01-01", 0), "f1": ("2020-01-01", 0), "f2": ("2020-01-01", 1), "f3": ("2020-01-01", 1)}


def test_hot_keys_from_a_sketch(spark, tmp_root):
    lay = FixtureLayers(spark, SF_SMALL, materialize=("stg_listings", "stg_reviews"), hot_key_rows=25)
    exact = joins.hot_keys(lay.stg_reviews, ["listing_id"], 25)
    assert {r["listing_id"] for r in lay.hot_listings.collect()} >= {r["listing_id"] for r in exact.collect()} and exact.count() > 5
    trends = marts.monthly_reviews(lay.stg_listings, lay.stg_reviews, 1990, 25, lay.hot_listings)
    orphans = relationships_failures(lay.stg_reviews, "listing_id", lay.stg_listings, "listing_id", hot=lay.hot_listings)
    for df in (trends, orphans):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("review_id#") and sum("review_id" in ln and "parquet" in ln for ln in plan.splitlines()) == 1
    assert sorted(map(str, trends.collect())) == sorted(map(str, marts.monthly_reviews(lay.stg_listings, lay.stg_reviews, 1990).collect()))
    assert sorted(map(str, orphans.collect())) == sorted(map(str, relationships_failures(lay.stg_reviews, "listing_id", lay.stg_listings, "listing_id").collect()))


def test_steps_alone_and_the_ledger(spark, tmp_root):
    lay = FixtureLayers(spark, SF_SMALL)
    cfg = P.PipelineConfig(root=tmp_root, run_ts="2024-01-01 00:00:00")
    lay.bronze_listings.write.json(cfg.path("bronze", cfg.listings_topic))
    lay.bronze_reviews.write.json(cfg.path("bronze", cfg.reviews_topic))
    for step in ("silver", "staging", "gold"):
        P.STEPS[step](spark, P.PipelineConfig(root=tmp_root, run_ts="2024-01-01 00:00:00", min_year=1997, median="exact"))
    counts = {(r["layer"], r["entity"]): r["row_count"] for r in ledger.latest(spark, tmp_root).collect()}
    assert counts["bronze", "listings"] == lay.bronze_listings.count() and counts["staging", "reviews"] == lay.stg_reviews.count()
    assert counts["gold", "mart_city_pricing"] == P.layer_table(spark, cfg, "gold", "mart_city_pricing").count()
    with pytest.raises(P.QualityError):
        P.check_quality(spark, cfg)
    assert ledger.latest(spark, tmp_root).where("layer = 'quality' and row_count > 0").count() == 1
    assert ledger.latest(spark, tmp_root + "/elsewhere").count() == 0


def test_file_order_finds_rows_out_of_place(spark, tmp_root):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 3).alias("g"), F.when(F.col("id") % 10 > 0, F.col("id") % 7).alias("v")).coalesce(1)
    by = [F.col("v").desc(), "id"]
    TB.write_table(df, path=f"{tmp_root}/good", sort_by=by, partition_by=["g"])
    TB.write_table(df, path=f"{tmp_root}/bad", partition_by=["g"], rebalance=False)
    good, bad = (TB.file_order(spark, f"{tmp_root}/{n}", by, schema=df.schema).agg(F.sum("rows").alias("n"), F.sum("violations").alias("v")).first() for n in ("good", "bad"))
    assert (good["n"], good["v"]) == (100, 0) and bad["n"] == 100 and bad["v"] > 10


def test_counts_of_layers_are_observed_in_their_writes(spark):
    """The ledger's counts come with the writes: reading them starts no job over a layer."""
    from lakeforge.plans.queries import q_layer_counts
    plan = q_layer_counts(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "json" in plan and "parquet" not in plan


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_counted_without_a_shuffle(spark, tmp_root, small_ranges):
    texts = ["plain", "two\nlines", '"', "a,b", "\n\n", "é" * 30]
    rows = [[str(i), texts[i % len(texts)]] for i in range(60)]
    put(f"{tmp_root}/in/a.csv", csv_text([["id", "p"], *rows]))
    lines = csv_split.file_lines(spark, f"{tmp_root}/in")
    states = csv_split.line_states(lines)
    assert "Exchange" not in plan_of(states) and "Window" not in plan_of(states)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"  # counts go on from one batch of a range to the next
    old = spark.conf.get(name)
    try:
        spark.conf.set(name, "2")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
        got = csv_split.read_csv_split(spark, f"{tmp_root}/in", ["id", "p"])
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows))
    finally:
        spark.conf.set(name, old)


def test_log_and_bronze_are_compressed_in_bounded_files(spark, tmp_root, monkeypatch):
    from lakeforge.sources import topics
    monkeypatch.setattr(topics, "LOG_FILE_RECORDS", 4, raising=False)
    publish(spark, tmp_root, range(30))
    land_topic(spark, S.REVIEWS_TOPIC, f"{tmp_root}/bronze", f"{tmp_root}/ckpt", log_path=f"{tmp_root}/topics", records_per_file=5)
    for folder, most in ((f"{tmp_root}/topics", 4), (f"{tmp_root}/bronze/{S.REVIEWS_TOPIC}", 5)):
        files = [r[0] for r in spark.read.option("recursiveFileLookup", "true").format("binaryFile").load(folder).select("path").collect()]
        assert files and all(f.endswith(".gz") for f in files if "_spark_metadata" not in f)
        per_file = spark.read.option("recursiveFileLookup", "true").text([f for f in files if f.endswith(".gz")]).groupBy(F.col("_metadata.file_path")).count()
        assert per_file.agg(F.max("count"), F.sum("count")).first()[:] == (most, 30)


def test_flushes_number_rows_within_ranges_of_a_file(spark):
    from lakeforge.streaming.flush import _numbered
    rows = spark.createDataFrame([(f, s, a, f"{f}{s}-{a:02d}") for f in "ab" for s in (0, 90, 700) for a in range(4)], "file string, start bigint, at bigint, value string")
    got = [r["value"] for r in _numbered(rows.repartition(5)).orderBy("seq").collect()]
    assert got == [f"{f}{s}-{a:02d}" for f in "ab" for s in (0, 90, 700) for a in range(4)]
    windows = [ln for ln in plan_of(_numbered(rows)).splitlines() if "row_number" in ln and "Window" in ln]
    assert windows and all("start#" in ln.rsplit("[file#", 1)[1] for ln in windows)
