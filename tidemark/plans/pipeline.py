"""End-to-end run: bronze -> silver -> gold, with a load report.

Every layer is written and read back before the next one: silver starts from
the written bronze tables (with their lineage columns), gold from the written
silver tables.  That cuts the lineage (a lost executor re-reads a table instead
of recomputing the layers below), and all tables of a layer see one snapshot.
Failures are isolated per table and summarised with their message in the
report, and the run then *fails* (``PipelineError``) so that a scheduler sees
it.  Tables are published only when complete (``sources.sinks``), so the last
good version of a failed table stays readable.

Tables are folders below ``out``, or tables of the session's catalog (schemas
``catalog`` + layer).  Inputs are DataFrames or names of catalog tables.

A run notes each finished table in ``out/_manifest``: its version, and the
versions of its inputs (of a raw table: what its plan and files are).  With
``resume`` a run builds only the tables that are missing or whose inputs have
another version than noted; the others are reported as ``kept``.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import gold
from tidemark.operators.enrich import enrich_sales
from tidemark.operators.silver import CLEANERS, clean_feed_flat, clean_feed_nested
from tidemark.session import new_run_dir, shuffles_freed
from tidemark.sources import fixtures
from tidemark.sources.files import CORRUPT
from tidemark.sources.sinks import CatalogStore, FolderStore, file_bytes, file_states, read_texts, write_text

SILVER_PARTITIONS = {"sales": ["annee", "mois"]}
FEED_CLEANERS = {"feed_nested": clean_feed_nested, "feed_flat": clean_feed_flat}
LAYERS = ("bronze", "silver", "gold")
DONE = ("ok", "kept")
AUDIT = ("_updated_at", "_ingested_at", "_source_file")

# gold table -> (builder, silver inputs, partition columns)
GOLD_TABLES = {
    "sales_daily": (gold.sales_daily, ("sales", "channels"), ["annee", "mois"]),
    "sales_by_channel": (gold.sales_by_channel, ("sales", "channels"), []),
    "sales_by_region": (gold.sales_by_region, ("sales", "customers"), ["annee"]),
    "top_products": (gold.top_products, ("sales", "products"), ["annee", "mois"]),
    "customer_basket": (gold.customer_basket, ("sales", "customers"), ["annee"]),
    "return_rate": (gold.return_rate, ("sales", "returns", "products"), ["annee", "mois"]),
    "sales_by_category": (gold.sales_by_category, ("sales", "products"), ["annee"]),
    "customer_segments": (gold.customer_segments, ("sales", "customers", "channels"), ["annee"]),
}

# Tables that may have nearly as many rows as the sales: their sales are dealt to tasks once, so that neither the groups
# nor the files by month need another deal.  That holds while the channels are broadcast, which leaves the rows where
# they lie; more than BROADCAST_BYTES of channels (parquet) are joined by a shuffle, and the writer deals the result by month.
BROADCAST_BYTES = 8 << 20
DEALS = {
    # days in order: a task has few months, and its groups whole; a day of many sales is split by channel
    "sales_daily": lambda sales: gold.counted(sales).repartitionByRange(fixtures.tasks(sales), "date", "id_canal"),
    # by month before the channels' columns are added, not with them
    "sales_enriched": lambda sales: sales.hint("rebalance", "annee", "mois"),
}

# Tables whose operator deals the sales itself, to a number of tasks that follows the size of the sales' files.
DEAL_THEMSELVES = ("sales_by_channel", "customer_basket")

# Those that shuffle most are built first: their shuffle files are gone before the other tables take their space.
LARGEST_FIRST = ("top_products", "return_rate", "sales_enriched", "customer_basket", "sales_daily", "sales_by_category",
                 "sales_by_channel", "customer_segments", "sales_by_region")

# Cleaned tables dealt by their partition columns before columns are derived from the rows.
CLEAN_DEALS = {
    "sales": lambda sales: (sales.withColumns({"annee": F.year("date"), "mois": F.month("date")})
                            .hint("rebalance", "annee", "mois").drop("annee", "mois")),
}

REPORT_SCHEMA = T.StructType([
    T.StructField("layer", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("corrupt_rows", T.LongType()),
])


class PipelineError(RuntimeError):
    def __init__(self, failed: list[str], report: DataFrame):
        super().__init__(f"pipeline tables failed: {failed}")
        self.failed = failed
        self.report = report


class Manifest:
    """What is finished: (layer, table) -> version, inputs, rows, corrupt."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, f"{root}/_manifest"
        entries = [json.loads(t) for t in read_texts(spark, self.path)]
        self.entries = {(e["layer"], e["table"]): e for e in entries}

    def version(self, layer: str, table: str) -> str | None:
        entry = self.entries.get((layer, table))
        return entry["version"] if entry else None

    def note(self, layer: str, table: str, inputs: dict[str, str | None], rows: int, corrupt: int) -> None:
        entry = {"layer": layer, "table": table, "version": uuid.uuid4().hex, "inputs": inputs, "rows": rows, "corrupt": corrupt}
        write_text(self.spark, f"{self.path}/{layer}-{table}", json.dumps(entry))
        self.entries[layer, table] = entry


def source_version(df: DataFrame) -> str:
    """Of a raw table: a digest of its plan, and of the size and time of each file that it reads.

    Equal within a session for the same plan over the same files; a plan that
    can't be told to be the same counts as another one.
    """
    told = [str(df.semanticHash()), *file_states(df.sparkSession, df.inputFiles())]
    return hashlib.sha256("\n".join(told).encode()).hexdigest()


def run_pipeline(spark: SparkSession, sf_dir: str | None = None, out: str | None = None,
                 bronze: dict[str, DataFrame | str] | None = None, profile: str = "strict",
                 as_of=None, parallel_jobs: int = 4, catalog: str | None = None, resume: bool = False) -> DataFrame:
    """Build all tables under ``out``, or in the catalog with their files under ``out``; return the load report.

    ``bronze`` holds the six raw tables and, optionally, the two product feeds, as
    frames or names of catalog tables; by default they are derived from the test
    tables of ``sf_dir``.  Tables of one layer are independent, so their writes
    are submitted as concurrent Spark jobs (``parallel_jobs`` at a time): small
    tables no longer leave most executors idle while they run one after another.
    Each table's shuffle files are deleted once it is written.
    """
    with shuffles_freed(spark):
        return _run(spark, sf_dir, out, bronze, profile, as_of, parallel_jobs, catalog, resume)


def _run(spark: SparkSession, sf_dir, out, bronze, profile, as_of, parallel_jobs, catalog, resume) -> DataFrame:
    out = (out or new_run_dir(spark, "pipeline")).rstrip("/")
    if bronze is None:
        bronze = {**fixtures.bronze_tables(spark, sf_dir), "feed_nested": fixtures.feed_nested(spark, sf_dir),
                  "feed_flat": fixtures.feed_flat(spark, sf_dir)}
    bronze = {name: spark.table(df) if isinstance(df, str) else df for name, df in bronze.items()}
    store = CatalogStore(spark, out, catalog) if catalog else FolderStore(spark, out)
    manifest = Manifest(spark, out)
    there = {layer: set(store.tables(layer)) for layer in LAYERS} if resume else {}

    def attempt(layer: str, name: str, build, partition_by, inputs: dict[str, str | None], audit="_updated_at",
                dealt: bool = False) -> tuple:
        done = manifest.entries.get((layer, name))
        if resume and done and name in there[layer] and done["inputs"] == inputs and None not in inputs.values():
            return (layer, name, done["rows"], "kept", done["corrupt"])
        try:
            n, corrupt = store.write(build(), layer, name, partition_by, audit, dealt)
            manifest.note(layer, name, inputs, n, corrupt)
            return (layer, name, n, "ok", corrupt)
        except Exception as e:  # isolate, report, fail at the end
            return (layer, name, None, f"failed: {type(e).__name__}: {str(e).strip()[:500]}", None)

    def run_layer(tasks: list[tuple]) -> list[tuple]:
        with ThreadPoolExecutor(max_workers=max(1, parallel_jobs)) as pool:
            return list(pool.map(lambda t: attempt(*t), tasks))

    def written(rows: list[tuple]) -> dict[str, DataFrame]:
        return {name: store.read(layer, name) for layer, name, _, status, _ in rows if status in DONE}

    def with_skipped(layer: str, names, done: list[tuple]) -> list[tuple]:
        found = {r[1]: r for r in done}
        return [found.get(n, (layer, n, None, "skipped: input failed", None)) for n in names]

    def after(layer: str, *names: str, **settings) -> dict[str, str | None]:
        return {f"{layer}.{n}": manifest.version(layer, n) for n in names} | {k: str(v) for k, v in settings.items()}

    landed = run_layer([("bronze", name, (lambda f=df: f), [], {"source": source_version(df)},
                         None if "_ingested_at" in df.columns else "_ingested_at") for name, df in bronze.items()])
    raw = {name: df.drop(*AUDIT) for name, df in written(landed).items()}
    cleaners = {name: (lambda c=clean, n=name, k={"deal": CLEAN_DEALS[name]} if name in CLEAN_DEALS else {}: c(raw[n], profile, **k))
                for name, clean in CLEANERS.items()}
    cleaners |= {name: (lambda c=clean, n=name: c(raw[n])) for name, clean in FEED_CLEANERS.items() if name in bronze}
    cleaned = with_skipped("silver", cleaners, run_layer(
        [("silver", name, build, SILVER_PARTITIONS.get(name, []), after("bronze", name, profile=profile), "_updated_at",
          name in CLEAN_DEALS)
         for name, build in cleaners.items() if name in raw]))
    silver = {name: df.drop(*AUDIT, CORRUPT) for name, df in written(cleaned).items()}

    builders = {name: ("gold", *spec) for name, spec in GOLD_TABLES.items()}
    builders["sales_enriched"] = ("silver", enrich_sales, ("sales", "channels"), ["annee", "mois"])
    few_channels = "channels" in silver and file_bytes(spark, silver["channels"].inputFiles()) <= BROADCAST_BYTES

    def dealt_build(name: str, build):
        return lambda: build(DEALS[name](silver["sales"]), F.broadcast(silver["channels"]))

    tasks = []
    for name in sorted(builders, key=lambda n: LARGEST_FIRST.index(n) if n in LARGEST_FIRST else len(LARGEST_FIRST)):
        layer, build, inputs, parts = builders[name]
        if all(i in silver for i in inputs):
            kwargs = {"as_of": as_of} if name == "customer_basket" else {}
            dealt = few_channels and name in DEALS
            more = {"tasks": fixtures.tasks(silver["sales"])} if name in DEAL_THEMSELVES else {}
            make = (dealt_build(name, build) if dealt else
                    (lambda b=build, i=inputs, k=kwargs | more: b(*[silver[x] for x in i], **k)))
            tasks.append((layer, name, make, parts, after("silver", *inputs, **kwargs), "_updated_at", dealt))
    done = run_layer(tasks)
    rows = landed + cleaned + with_skipped("silver", ["sales_enriched"], done) + with_skipped("gold", GOLD_TABLES, done)

    failed = [f"{layer}.{name}" for layer, name, _, status, _ in rows if status not in DONE]
    report = spark.createDataFrame(rows, REPORT_SCHEMA)
    if catalog:
        listed = [(layer, name) for layer in LAYERS for name in store.tables(layer)]
        listed = spark.createDataFrame(listed, "layer string, table_name string").withColumn("listed", F.lit(True))
        report = report.join(listed, ["layer", "table_name"], "full").fillna(False, ["listed"])
    if failed:
        raise PipelineError(failed, report)
    return report
