"""End-to-end batch run: CSV -> topic log -> bronze (streamed) -> silver
tables -> staging tables -> gold marts -> quality gate.

Plain sequential calls; every layer is written to shared storage, which also
cuts lineage between layers (a lost executor recomputes from the last
written layer, not from the CSV). Each step (``STEPS``) also runs on its own, with
nothing but the root: it reads the layer that the step before wrote, and the
ledger tells it what there is.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import TypeVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeforge import schemas as S
from lakeforge.operators.clean import clean_listings, clean_reviews
from lakeforge.operators.joins import HOT_KEY_ROWS, heavy_hitters, hot_keys_from
from lakeforge.operators.quality import QualityError, assert_suite, default_suite, run_suite
from lakeforge.operators.staging import stg_listings, stg_reviews
from lakeforge.plans import ledger, marts
from lakeforge.session import shared_root
from lakeforge.sources.bronze import read_bronze
from lakeforge.sources.csv import read_csv_records
from lakeforge.sources.csv_split import read_csv_split
from lakeforge.sources.tables import create_namespace, list_catalog, read_table, write_table
from lakeforge.sources.topics import PublishResult, publish_records
from lakeforge.streaming.flush import CountedLanding
from lakeforge.streaming.ingest import StreamRun, land_topics

R = TypeVar("R")


def run_concurrently(*jobs: Callable[[], R]) -> list[R]:
    """Run independent Spark actions from separate threads so their jobs
    share the executors (Spark schedules concurrent jobs natively); results
    come back in order and the first failure is raised."""
    if len(jobs) <= 1:
        return [j() for j in jobs]
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [f.result() for f in [pool.submit(j) for j in jobs]]


def new_run_root(spark: SparkSession, kind: str = "runs") -> str:
    """A fresh folder under the shared root for one run."""
    return f"{shared_root(spark)}/{kind}/{uuid.uuid4().hex[:16]}"


@dataclass
class PipelineConfig:
    root: str
    listings_csv: str | None = None
    reviews_csv: str | None = None
    listings_topic: str = S.LISTINGS_TOPIC
    reviews_topic: str = S.REVIEWS_TOPIC
    kafka_servers: str | None = None
    run_ts: str | None = None
    min_year: int = marts.REVIEW_YEAR_FLOOR
    median: str = "approx"
    cities: Sequence[str] = tuple(S.ACCEPTED_CITIES)
    room_types: Sequence[str] = tuple(S.ACCEPTED_ROOM_TYPES)
    fail_on_quality: bool = True
    # Read CSV files as byte ranges, columns by each file's header, and send
    # records that can't be read to the topics' errors. Else: one task a file,
    # columns by position, no errors.
    dead_letters: bool = False
    # Land one bronze file for every so many records (log folder only); None: files
    # as the micro-batches fall, of at most ``S.BRONZE_FILE_RECORDS`` records.
    flush_records: int | None = None
    # When set, layers are also registered in the session catalog (created
    # with their folders under ``root``), so SQL can name them, e.g.
    # ``SELECT ... FROM gold.mart_city_pricing``.
    silver_namespace: str | None = None
    gold_namespace: str | None = None
    # Record columns read from bronze into silver (explicit schema, no
    # inference pass). Every CSV column travels in the messages; add extra
    # columns here to carry them into silver as well.
    listing_columns: Sequence[str] = tuple(S.BRONZE_LISTING_COLUMNS)
    review_columns: Sequence[str] = tuple(S.BRONZE_REVIEW_COLUMNS)

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])


def _write_counted(spark: SparkSession, cfg: PipelineConfig, df: DataFrame, layer: str, name: str,
                   partition_by=(), sort_by=(), **observed) -> tuple[DataFrame, dict]:
    """Write one layer table to its folder (and catalog name, if configured); the
    scan of what was written, with the types it had, and what was observed in the
    write: ``rows`` and the aggregates given."""
    ns = cfg.silver_namespace if layer in ("silver", "staging") else cfg.gold_namespace
    path = cfg.path(layer, name)
    obs = Observation(f"write_{layer}_{name}_{uuid.uuid4().hex[:8]}")
    df = df.observe(obs, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in observed.items()])
    if ns:
        create_namespace(spark, ns, location=cfg.path(f"{ns}.db"))
        write_table(df, name=f"{ns}.{name}", path=path, partition_by=partition_by, sort_by=sort_by)
        return _blank_city(read_table(spark, name=f"{ns}.{name}"), partition_by), obs.get
    write_table(df, path=path, partition_by=partition_by, sort_by=sort_by)
    return _blank_city(read_table(spark, path=path, schema=df.schema), partition_by), obs.get


def _write_layer(spark: SparkSession, cfg: PipelineConfig, df: DataFrame, layer: str, name: str,
                 partition_by=(), sort_by=()) -> DataFrame:
    """:func:`_write_counted`, without what was observed."""
    return _write_counted(spark, cfg, df, layer, name, partition_by, sort_by)[0]


def _blank_city(df: DataFrame, partition_by: Sequence[str] = ("city",)) -> DataFrame:
    """Folder names can't tell an empty city from NULL. Cleaned listings and the
    pricing mart have no NULL city, so one that is read back was empty. Filters on
    the result still prune partitions."""
    return df.withColumn("city", F.coalesce("city", F.lit(""))) if "city" in partition_by else df


@dataclass
class PipelineResult:
    published: list[PublishResult] = field(default_factory=list)
    landed: list[StreamRun] = field(default_factory=list)
    counts: dict[str, int] = field(default_factory=dict)
    quality: list[dict] = field(default_factory=list)
    quality_error: str | None = None


def ingest(spark: SparkSession, cfg: PipelineConfig) -> list[PublishResult]:
    """CSV files -> keyed messages on the two topics (published concurrently; with
    dead letters one after the other, as both write into the log's root)."""
    def publish(csv_path: str, topic: str) -> PublishResult:
        records = read_csv_split(spark, csv_path, keep_errors=True) if cfg.dead_letters else read_csv_records(spark, csv_path)
        return publish_records(records, topic, _key_for(topic, cfg), cfg.path("topics"), cfg.kafka_servers)

    sources = [(p, t) for p, t in ((cfg.listings_csv, cfg.listings_topic), (cfg.reviews_csv, cfg.reviews_topic)) if p]
    jobs = [(lambda p=p, t=t: publish(p, t)) for p, t in sources]
    published = [j() for j in jobs] if cfg.dead_letters else run_concurrently(*jobs)
    ledger.record(spark, cfg.root, "ingest", [x for r in published for x in (("topic", r.topic, r.sent), ("errors", r.topic, r.errors))])
    return published


def _key_for(topic: str, cfg: PipelineConfig) -> str:
    return "listing_id" if topic == cfg.listings_topic else "review_id"


def land(spark: SparkSession, cfg: PipelineConfig) -> list[StreamRun]:
    """Land the topics of this run, or those that the ledger says were published
    (Kafka: both topics)."""
    topics = [t for t, src in ((cfg.listings_topic, cfg.listings_csv), (cfg.reviews_topic, cfg.reviews_csv))
              if src or cfg.kafka_servers]
    if not topics:
        known = {r["entity"] for r in ledger.entries(spark, cfg.root).where("layer = 'topic'").select("entity").distinct().collect()}
        topics = [t for t in (cfg.listings_topic, cfg.reviews_topic) if t in known]
    checkpoints = cfg.path("_checkpoints", "bronze")
    if cfg.flush_records and not cfg.kafka_servers:
        landings = [CountedLanding(spark, t, cfg.path("topics"), cfg.path("bronze"), checkpoints, cfg.flush_records) for t in topics]
        flushes = run_concurrently(*[x.drain for x in landings])
        landed = [StreamRun(x.topic, n, x.landed_rows()) for x, n in zip(landings, flushes)]
    else:
        landed = land_topics(spark, topics, cfg.path("bronze"), checkpoints, log_path=cfg.path("topics"), kafka_servers=cfg.kafka_servers)
    ledger.record(spark, cfg.root, "land", [("landed", r.topic, r.input_rows) for r in landed])
    return landed


def bronze_to_silver(spark: SparkSession, cfg: PipelineConfig) -> dict[str, int]:
    """Clean both topics into partitioned silver tables; raw and cleaned
    counts are observed during the write (no extra scans)."""
    specs = (
        ("listings", cfg.listings_topic, list(cfg.listing_columns), clean_listings, ["city"]),
        ("reviews", cfg.reviews_topic, list(cfg.review_columns), clean_reviews, ["review_year", "review_month"]),
    )

    def clean_one(name, topic, cols, cleaner, parts) -> dict[str, int]:
        raw_obs = Observation(f"raw_{name}")
        raw = read_bronze(spark, cfg.path("bronze", topic), cols).observe(raw_obs, F.count(F.lit(1)).alias("n"))
        _, seen = _write_counted(spark, cfg, cleaner(raw, run_ts=cfg.run_ts), "silver", name, partition_by=parts)
        return {f"bronze_{name}": int(raw_obs.get["n"]), f"silver_{name}": int(seen["rows"])}

    counts: dict[str, int] = {}
    for c in run_concurrently(*[(lambda spec=spec: clean_one(*spec)) for spec in specs]):
        counts.update(c)
    ledger.record(spark, cfg.root, "silver", [(*k.split("_", 1), n) for k, n in counts.items()])
    return counts


def layer_table(spark: SparkSession, cfg: PipelineConfig, layer: str, name: str) -> DataFrame:
    """A table of a layer as written: partition columns keep their type and blanks."""
    ns = cfg.silver_namespace if layer in ("silver", "staging") else cfg.gold_namespace
    if ns:
        df = read_table(spark, name=f"{ns}.{name}")
    else:
        path = cfg.path(layer, name)
        found = read_table(spark, path=path).schema
        # folder names such as city=007 would be read as numbers
        typed = T.StructType([T.StructField(f.name, T.StringType()) if f.name == "city" else f for f in found])
        df = read_table(spark, path=path, schema=typed)
    return _blank_city(df) if name in ("listings", "mart_city_pricing") else df


def silver_table(spark: SparkSession, cfg: PipelineConfig, name: str) -> DataFrame:
    return layer_table(spark, cfg, "silver", name)


def silver_to_staging(spark: SparkSession, cfg: PipelineConfig) -> dict[str, DataFrame]:
    """Both staging tables, and the listings with very many reviews
    (``hot_listings``), observed as the reviews are written."""
    (l, l_seen), (r, r_seen) = run_concurrently(
        lambda: _write_counted(spark, cfg, stg_listings(silver_table(spark, cfg, "listings")), "staging", "stg_listings"),
        lambda: _write_counted(spark, cfg, stg_reviews(silver_table(spark, cfg, "reviews")), "staging", "stg_reviews",
                             heavy=heavy_hitters("listing_id")))
    heavy = [{"item": h["item"], "count": h["count"]} for h in r_seen["heavy"] or [] if h["count"] > HOT_KEY_ROWS]
    ledger.put_lines(spark, cfg.path("staging", "_heavy_listings", uuid.uuid4().hex[:16]), [{"heavy": heavy}])
    ledger.record(spark, cfg.root, "staging", [("staging", "listings", l_seen["rows"]), ("staging", "reviews", r_seen["rows"])])
    return {"stg_listings": l, "stg_reviews": r, "hot_listings": hot_keys_from(r, "listing_id", heavy)}


def _hot_listings(spark: SparkSession, cfg: PipelineConfig, reviews: DataFrame) -> DataFrame:
    """What earlier runs of the staging step observed; a few keys at most."""
    found: dict[int, int] = {}
    path = cfg.path("staging", "_heavy_listings")
    if ledger.exists(spark, path):
        rows = spark.read.schema("heavy array<struct<item: bigint, count: bigint>>").option("recursiveFileLookup", "true").json(path)
        for h in rows.select(F.inline("heavy")).collect():
            found[h["item"]] = max(h["count"], found.get(h["item"], 0))
    return hot_keys_from(reviews, "listing_id", [{"item": k, "count": n} for k, n in found.items()])


def mart_order(name: str) -> list:
    """Order of rows in a mart's files."""
    return {
        "mart_city_pricing": ["city", "room_type"],
        "mart_host_performance": [F.col("total_reviews_received").desc(), F.col("host_id")],
        "mart_review_trends": ["city", "review_year", "review_month"],
    }[name]


def staging_to_gold(spark: SparkSession, cfg: PipelineConfig, staged: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The three marts (city pricing partitioned by city) from the written staging
    tables, each written once and read back. ``staged``: what
    :func:`silver_to_staging` returned, in the same run."""
    if staged is None:
        staged = {n: layer_table(spark, cfg, "staging", n) for n in ("stg_listings", "stg_reviews")}
        staged["hot_listings"] = _hot_listings(spark, cfg, staged["stg_reviews"])
    l, r, hot = staged["stg_listings"], staged["stg_reviews"], staged["hot_listings"]
    built = {
        "mart_city_pricing": (marts.city_pricing(l, median=cfg.median, run_ts=cfg.run_ts), ["city"]),
        "mart_host_performance": (marts.host_performance(l, r, run_ts=cfg.run_ts), []),
        "mart_review_trends": (marts.review_trends(l, r, cfg.min_year, run_ts=cfg.run_ts, hot=hot), []),
    }
    written = run_concurrently(*[
        (lambda name=name, df=df, parts=parts: _write_counted(spark, cfg, df, "gold", name, partition_by=parts, sort_by=mart_order(name)))
        for name, (df, parts) in built.items()])
    ledger.record(spark, cfg.root, "gold", [("gold", name, seen["rows"]) for name, (_, seen) in zip(built, written)])
    return {name: df for name, (df, _) in zip(built, written)}


def silver_to_gold(spark: SparkSession, cfg: PipelineConfig) -> dict[str, DataFrame]:
    """Staging tables, then the three marts."""
    staged = silver_to_staging(spark, cfg)
    return {**staged, **staging_to_gold(spark, cfg, staged)}


def check_quality(spark: SparkSession, cfg: PipelineConfig, tables: dict[str, DataFrame] | None = None) -> list[dict]:
    """The quality suite over the written staging tables and marts (``tables``:
    what :func:`silver_to_gold` returned, in the same run); raises
    :class:`QualityError` if a check fails."""
    if tables is None:
        tables = {n: layer_table(spark, cfg, "staging", n) for n in ("stg_listings", "stg_reviews")}
        tables |= {n: layer_table(spark, cfg, "gold", n) for n in ("mart_city_pricing", "mart_host_performance", "mart_review_trends")}
    rows: list[dict] = []
    try:
        rows = assert_suite(run_suite(tables, default_suite(cfg.cities, cfg.room_types)))
        return rows
    except QualityError as e:
        rows = e.rows
        raise
    finally:
        ledger.record(spark, cfg.root, "test", [("quality", "failed_checks", sum(r["failures"] > 0 for r in rows))] if rows else [])


#: The steps, in order; each takes (spark, cfg) and needs only what those before wrote.
STEPS: dict[str, Callable[[SparkSession, PipelineConfig], object]] = {
    "ingest": ingest, "land": land, "silver": bronze_to_silver, "staging": silver_to_staging, "gold": staging_to_gold, "test": check_quality,
}


def catalog(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """(layer, table_name, listed, row_count): the silver and gold tables that the
    ledger knows, and whether ``SHOW NAMESPACES`` lists their namespace and ``SHOW
    TABLES`` lists them; tables listed that the ledger doesn't know have no count."""
    known = ledger.latest(spark, cfg.root).where("layer in ('silver', 'gold')").select("layer", F.col("entity").alias("table_name"), "row_count")
    spaces = list_catalog(spark).select("namespace")
    listed = None
    for layer, ns in (("silver", cfg.silver_namespace), ("gold", cfg.gold_namespace)):
        shown = list_catalog(spark, ns).where("not isTemporary and not startswith(tableName, 'stg_')")
        part = shown.join(spaces, "namespace", "left_semi").select(F.lit(layer).alias("layer"), F.col("tableName").alias("table_name"), F.lit(True).alias("listed"))
        listed = part if listed is None else listed.unionByName(part)
    return known.join(listed, ["layer", "table_name"], "full_outer").select(
        "layer", "table_name", F.coalesce("listed", F.lit(False)).alias("listed"), "row_count")


def run_pipeline(spark: SparkSession, cfg: PipelineConfig) -> PipelineResult:
    res = PipelineResult()
    res.published = ingest(spark, cfg)
    res.landed = land(spark, cfg)
    res.counts = bronze_to_silver(spark, cfg)
    tables = silver_to_gold(spark, cfg)
    try:
        res.quality = check_quality(spark, cfg, tables)
    except QualityError as e:
        res.quality_error, res.quality = str(e), e.rows
        if cfg.fail_on_quality:
            raise
    return res
