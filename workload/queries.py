"""One registered query per operator: (spark, sf_dir) -> DataFrame over the whole tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jouleloom.functions import (
    dataset_prefix,
    file_stem,
    job_id,
    mask_secret,
    object_name_is_valid,
    sanitize_object_name,
    storage_key,
    table_name,
    with_appliance,
)
from jouleloom.keys import JOB, ROW, TIME
from jouleloom.operators.align import align, fill, timeline_union
from jouleloom.operators.clean import clean_cast
from jouleloom.operators.describe import describe_columns
from jouleloom.operators.energy import has_energy_data, job_metrics, job_summary
from jouleloom.operators.frames import (
    Frames,
    elapsed_validate,
    first_usable_group,
    frame_diagnostics,
    job_facts,
    quarantined_files,
    stack,
    surviving_frames,
    truncate_time,
    unusable_files,
)
from jouleloom.operators.prices import (
    EPOCH,
    PRICE,
    add_cost,
    epoch_bounds,
    job_cost,
    nearest_prices,
    price_block_cover,
)
from jouleloom.operators.samples import aligned_samples, usable_samples
from jouleloom.plans.fleet import fleet_profile, fleet_table
from jouleloom.plans.jobs import job_report, job_table
from jouleloom.plans.segments import dataset_positions, numbered, prepare
from jouleloom.session import new_folder, tune, written
from jouleloom.sinks.tables import read_jobs
from jouleloom.sources.datasets import SHAPED_SCHEMA, TYPED_SCHEMA, dataset_catalog, frames_from_raw, normalize_ndarray, samples_from_raw
from jouleloom.sources.files import (
    discover_union,
    drop_batch_files,
    latest_per_label,
    object_inventory,
)
from jouleloom.sources.notices import acceptance_audit, notice_records, parse_notices
from jouleloom.sources.objects import rescan_missing, user_objects
from jouleloom.sources.prices import block_points, price_blocks
from jouleloom.streaming.intake import stream_jobs
from jouleloom.streaming.intake import stream_objects as stream_objects_to
from workload.adapters import (
    DATASETS,
    epoch,
    event_frames,
    event_prices,
    event_profile,
    event_timeline,
    job_events,
    order_prices,
    quantized,
    rounded,
    rounded_statistics,
    table,
    timed_events,
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
AT = [*JOB, TIME]
SOURCE_COLUMNS = [
    "Energy__NodePower",
    "Energy__EpochTime",
    "Task_0__CPUUtilization",
    "Task_1__RSS",
    "Task_2__ReadMB",
    "Task_3__CurrPower",
    "Task_3__EpochTime",
]
ENERGY_COLUMNS = ["ElapsedTime_Diff", "NodePower", "Energy_Increment_J", "Energy_used_J"]


def query(fn: Query) -> Query:
    @functools.wraps(fn)
    def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark), sf_dir)

    REGISTRY[fn.__name__] = tuned
    return tuned


# --- frames ---------------------------------------------------------------------------------


def _no_energy_for_some():
    """Filter: the energy dataset is missing for every fourth user."""
    return ~((F.col("user_id") % 4 == 0) & (F.col("event_type") == "purchase"))


def _zero_for_some():
    """Energy dataset whose power is zero for every fifth user, in the first group."""
    zero = (F.col("user_id") % 5 == 0) & (F.col("group_name") == "g0")
    return F.struct(F.when(zero, 0.0).otherwise(F.col("value")).alias("NodePower"), F.col("ep").alias("EpochTime"))


@query
def job_id_of_file(spark, sf):
    files = job_events(spark, sf).select("file_label").distinct()
    return files.select("file_label", job_id(F.col("file_label")).alias("job_id"))


@query
def elapsed_validation(spark, sf):
    return elapsed_validate(job_events(spark, sf).withColumn(TIME, F.col("value") - 20))


@query
def quarantine(spark, sf):
    frames = event_frames(spark, sf)
    late = frames.df.withColumn(TIME, F.when(F.col(ROW) % 997 == 0, float("nan")).otherwise(F.col(TIME).cast("double")))
    return quarantined_files(job_facts(frames.with_df(late)))


@query
def fractional_time(spark, sf):
    frames = Frames(
        job_events(spark, sf).select(
            *JOB, (F.col("value") - 5).alias(TIME), F.col("event_id").alias(ROW), F.struct("value").alias("p")
        ),
        ("p",),
    )
    return truncate_time(frames).df.select(*JOB, F.col(ROW).alias("event_id"), TIME)


@query
def row_index_time(spark, sf):
    return dataset_positions(prepare(event_frames(spark, sf))).select(
        *JOB, "prefix", F.col(ROW).alias("event_id"), F.col("position").alias(TIME)
    )


@query
def row_number_as_time(spark, sf):
    """Datasets without a time of their own: the row number counts as time."""
    events = job_events(spark, sf).select(*JOB, "event_id", "event_type")
    rows = numbered(events, [*JOB, "event_type"], ["event_id"], ROW)
    frames = {p: rows.where(F.col("event_type") == t).drop("event_type") for t, p in DATASETS.items()}
    stacked = stack(frames)
    ids = F.coalesce(*[F.col(p)["event_id"] for p in stacked.prefixes])
    names = F.coalesce(*[F.when(F.col(p).isNotNull(), F.lit(p)) for p in stacked.prefixes])
    return stacked.df.select(*JOB, names.alias("prefix"), ids.alias("event_id"), TIME)


@query
def drop_zero_power(spark, sf):
    return surviving_frames(job_facts(event_frames(spark, sf, energy=_zero_for_some)))


@query
def frame_diagnostics_per_job(spark, sf):
    return frame_diagnostics(_catalog(spark, sf), job_facts(event_frames(spark, sf, energy=_zero_for_some)))


def _catalog(spark, sf):
    jobs = job_events(spark, sf).groupBy(*JOB).agg(F.max("user_id").alias("user"))
    prefixes = F.explode(F.array(*[F.lit(p) for p in DATASETS.values()])).alias("prefix")
    return jobs.select(*JOB, "user", prefixes).select(
        *JOB, "prefix", ((F.col("prefix") == "Task_2") & (F.col("user") % 3 == 0)).alias("error")
    )


def _one_dataset(spark, sf, zero) -> Frames:
    """All events as one dataset of node power, which is zero where `zero` holds."""
    events = job_events(spark, sf)
    power = F.when(zero(), 0.0).otherwise(F.col("value"))
    rows = events.select(*JOB, F.col("ep").alias(TIME), F.col("event_id").alias(ROW), F.struct(power.alias("NodePower")).alias("Energy"))
    return Frames(rows, ("Energy",))


@query
def files_without_usable_data(spark, sf):
    facts = job_facts(_one_dataset(spark, sf, lambda: F.col("user_id") % 5 == 0))
    return unusable_files(frame_diagnostics(_catalog(spark, sf).where("prefix = 'Energy'"), facts))


@query
def first_usable_group_of_file(spark, sf):
    zero = (F.col("user_id") % 5 == 0) & (F.col("group_name") == "g0")
    return first_usable_group(job_facts(_one_dataset(spark, sf, lambda: zero)))


# --- timeline -------------------------------------------------------------------------------


@query
def timeline(spark, sf):
    return timeline_union(event_frames(spark, sf))


@query
def align_frames(spark, sf):
    return rounded(align(prepare(event_frames(spark, sf))).df.select(*AT, *SOURCE_COLUMNS))


@query
def interpolate_rows(spark, sf):
    return rounded(event_timeline(spark, sf).df.select(*AT, *SOURCE_COLUMNS))


@query
def epoch_resolve(spark, sf):
    return event_profile(spark, sf, keep=_no_energy_for_some()).df.select(*AT, EPOCH)


@query
def task_derivatives(spark, sf):
    names = ["Task_1__RSS_MB", "Task_0__CPUUtilization_normalized"]
    return rounded(event_profile(spark, sf).df.select(*AT, *names))


@query
def power_resolve(spark, sf):
    return rounded(event_profile(spark, sf, keep=_no_energy_for_some()).df.select(*AT, "NodePower"))


@query
def elapsed_difference(spark, sf):
    return event_profile(spark, sf).df.select(*AT, F.col("ElapsedTime_Diff").cast("bigint").alias("ElapsedTime_Diff"))


@query
def energy_from_power(spark, sf):
    rows = rounded(event_profile(spark, sf).df.select(*AT, *ENERGY_COLUMNS), 4)
    return rows.withColumn("Energy_used_J", quantized(F.col("Energy_used_J"), 2))


def _meter():
    reading = F.col(TIME) * 2.0 + F.col("value")
    return F.struct(reading.alias("Energy"), F.col("ep").alias("EpochTime"))


@query
def power_from_energy(spark, sf):
    """Every second user has no dataset with power, only a meter; the others have both."""
    no_power = ~((F.col("user_id") % 2 == 0) & (F.col("event_type") == "error"))
    profile = event_profile(spark, sf, energy=_meter, keep=no_power)
    return rounded(profile.df.select(*AT, "NodePower", "Energy_Increment_J", "Energy_used_J"), 4)


# --- metrics --------------------------------------------------------------------------------


def _metrics(spark, sf):
    profile = event_profile(spark, sf)
    return job_metrics(profile.df.where(has_energy_data(profile)))


@query
def job_metrics_of_events(spark, sf):
    """The flagship: all events to one row of energy figures per job."""
    metrics = _metrics(spark, sf)
    whole = quantized(F.col("energy_delay_product"), -4).cast("decimal(38,0)")
    rows = rounded(metrics.withColumn("energy_delay_product", whole), 4)
    return rows.withColumn("energy_delay_product", F.col("energy_delay_product").cast("double"))


def _summary_rows(summary):
    """The energy-delay product has more digits than two engines agree in; it is cut as text, too."""
    product = (F.col("ord") == 5) & (F.col("Value") != "nan")
    cut = quantized(F.when(product, F.col("Value")).cast("double"), -4).cast("decimal(38,0)").cast("string")
    return summary.withColumn("Value", F.when(product, cut).otherwise(F.col("Value")))


@query
def job_summary_rows(spark, sf):
    return _summary_rows(job_summary(_metrics(spark, sf)))


@query
def appliance_comparison(spark, sf):
    joules = (F.col("l_extendedprice") * F.col("l_quantity")).alias("joules")
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", joules)
    return with_appliance(items, "joules").select(
        "l_orderkey",
        "l_linenumber",
        F.col("appliance_name").alias("name"),
        F.col("appliance_amount").alias("amount"),
        F.col("appliance_unit").alias("unit"),
        F.col("appliance_description").alias("sentence"),
    )


@query
def describe_table(spark, sf):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    return rounded_statistics(describe_columns(table(spark, sf, "lineitem"), columns=columns), 6)


@query
def describe_customers(spark, sf):
    """Text, flags and numbers of the same table."""
    customers = table(spark, sf, "customer")
    columns = ["c_name", "c_mktsegment", "c_acctbal"]
    rows = customers.select("c_nationkey", *columns, (F.col("c_acctbal") < 0).alias("in_debt"))
    return rounded_statistics(describe_columns(rows, ["c_nationkey"]), 4)


@query
def describe_jobs(spark, sf):
    # Described in two passes, so aligned only once.
    wide = written(align(prepare(event_frames(spark, sf))).df.select(*AT, *SOURCE_COLUMNS), "aligned")
    return rounded_statistics(describe_columns(wide, JOB, [TIME, *SOURCE_COLUMNS]), 4)


@query
def clean_and_narrow(spark, sf):
    return rounded(clean_cast(event_profile(spark, sf).visible()), 3)


# --- fleets whose jobs have datasets of their own ---------------------------------------------


def _own_paths(spark, sf):
    """Events as landed records: every user has datasets under a path that no other user has."""
    power = F.col("value")
    fields = {
        "Energy": {"NodePower": power, "EpochTime": F.col("ep")},
        "Task_0": {"CPUUtilization": power},
        "Task_1": {"RSS": power * 1024},
        "Task_2": {"ReadMB": power},
        "Task_3": {"CurrPower": power, "EpochTime": F.col("ep")},
    }
    events = timed_events(spark, sf).withColumn("dataset", F.create_map(*[F.lit(x) for pair in DATASETS.items() for x in pair])[F.col("event_type")])

    def of_dataset(make):
        found = F
        for d, named in fields.items():
            found = found.when(F.col("dataset") == d, make(named))
        return found

    def values(kind: str, types: tuple[str, ...], named) -> Column:
        of_type = [x for c, v in named.items() if (c in types) for x in (F.lit(c), F.array(v.cast(kind)))]
        return F.create_map(*of_type) if of_type else F.lit(None).cast(f"map<string,array<{kind}>>")

    whole, broken = (TIME, "EpochTime"), ("NodePower", "CPUUtilization", "RSS", "ReadMB", "CurrPower")
    raw = events.select(
        "file_label",
        F.array("group_name", F.concat(F.lit("n"), F.col("user_id").cast("string")), "dataset").alias("path_parts"),
        F.lit("compound").alias("kind"),
        of_dataset(lambda named: F.array(F.lit(TIME), *map(F.lit, named))).alias("field_names"),
        F.array(F.lit(1)).cast("array<bigint>").alias("shape"),
        F.col("event_id").cast("bigint").alias("chunk_offset"),
        of_dataset(lambda named: values("double", broken, named)).alias("fields"),
        of_dataset(lambda named: values("bigint", whole, {TIME: F.col(TIME), **named})).alias("int_fields"),
    )
    none = spark.createDataFrame([], TYPED_SCHEMA)
    return samples_from_raw(none.unionByName(raw, allowMissingColumns=True))


@query
def own_path_cells(spark, sf):
    """All values of all rows; no two users share a column."""
    rows = aligned_samples(usable_samples(_own_paths(spark, sf)), stored=True)
    cells = rows.select(*AT, F.explode("values").alias("column", "value"))
    digits = F.when(F.col("column").endswith("EpochTime"), quantized(F.col("value"), 3)).otherwise(quantized(F.col("value"), 6))
    return cells.withColumn("value", digits)


@query
def own_path_energy(spark, sf):
    rows = rounded(fleet_profile(_own_paths(spark, sf)).select(*AT, *ENERGY_COLUMNS), 4)
    return rows.withColumn("Energy_used_J", quantized(F.col("Energy_used_J"), 2))


@query
def own_path_tables(spark, sf):
    """What all tables have in common, cleaned and priced; the first usable group of each file."""
    rows = fleet_table(_own_paths(spark, sf), event_prices(spark, sf))
    return rounded(rows.drop("values", "texts"), 3)


# --- prices ---------------------------------------------------------------------------------


def _priced(spark, sf):
    profile = event_profile(spark, sf).df
    kept = profile.select(*AT, EPOCH, "Energy_Increment_J", "Energy_used_J")
    return add_cost(nearest_prices(kept, event_prices(spark, sf), EPOCH))


@query
def nearest_price_of_job_rows(spark, sf):
    return rounded(_priced(spark, sf).select(*AT, "PriceEpochTime", PRICE, "Cumulative_cost_EUR"), 4)


@query
def nearest_price_of_shipments(spark, sf):
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", epoch("l_shipdate").alias("x"))
    return nearest_prices(items, order_prices(spark, sf), "x", bucket_s=7 * 86_400)


@query
def nearest_price_by_priority(spark, sf):
    """Several series at once: one per order priority."""
    orders = table(spark, sf, "orders")
    series = orders.groupBy("o_orderpriority", epoch("o_orderdate").alias(EPOCH)).agg(
        quantized(F.avg("o_totalprice"), 4).alias(PRICE)
    )
    rows = orders.select("o_orderkey", "o_orderpriority", epoch("o_orderdate").alias("x"))
    return nearest_prices(rows, series, "x", by=["o_orderpriority"], bucket_s=7 * 86_400)


@query
def job_costs(spark, sf):
    return rounded(job_cost(_priced(spark, sf)), 4)


@query
def price_points_of_blocks(spark, sf):
    e, v = F.col("ep"), F.col("value")
    pair = F.when(F.col("event_id") % 13 == 0, F.array().cast("array<double>")).otherwise(
        F.array((F.floor(e / 900) * 900_000).cast("double"), F.when(v >= 5, v))
    )
    return block_points(job_events(spark, sf).select(F.array(pair).alias("series")))


@query
def price_block_starts(spark, sf):
    ms = F.unix_millis(F.col("ts").cast("timestamp")) - 1_705_000_000_000
    return price_blocks(table(spark, sf, "events").select(F.array(ms).alias("timestamps")))


@query
def price_block_cover_of_customers(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", epoch("o_orderdate").alias("x"), "o_orderdate")
    bounds = epoch_bounds(orders, "x", ["o_custkey"])
    blocks = orders.select((F.floor(F.col("x") / (7 * 86_400)) * (7 * 86_400)).alias("block"))
    return price_block_cover(bounds, blocks, ["o_custkey"])


@query
def epoch_bounds_of_jobs(spark, sf):
    return epoch_bounds(event_profile(spark, sf).df)


# --- names, files and objects ---------------------------------------------------------------


def _paths(spark, sf):
    parts = F.split("url", "/")
    return table(spark, sf, "pages").select(
        "page_id", "url", "html", parts.alias("parts"), parts[2].alias("host"), F.slice(parts, 4, 1000).alias("below")
    )


@query
def dataset_prefixes(spark, sf):
    return _paths(spark, sf).select(
        "page_id",
        dataset_prefix(F.col("parts")).alias("of_all"),
        dataset_prefix(F.col("below")).alias("of_path"),
        dataset_prefix(F.array(F.col("url"), F.lit(""))).alias("of_empty"),
    )


@query
def dataset_catalog_of_pages(spark, sf):
    raw = _paths(spark, sf).select(
        F.col("host").alias("file_label"),
        F.col("below").alias("path_parts"),
        F.lit("ndarray").alias("kind"),
        F.array().cast("array<string>").alias("field_names"),
        F.array(F.lit(1)).cast("array<bigint>").alias("shape"),
    )
    return dataset_catalog(raw).select(
        "file_label", "group_name", F.array_join("path_parts", "/").alias("path"), "prefix", "dataset_ord"
    )


@query
def array_rows(spark, sf):
    vectors = table(spark, sf, "embeddings")
    raw = vectors.select(
        F.col("vec_id").cast("string").alias("file_label"),
        F.array(F.lit("v"), F.lit("e")).alias("path_parts"),
        F.lit("ndarray").alias("kind"),
        F.when(F.col("label") % 2 == 0, F.array(F.lit(-1), F.lit(2), F.lit(4)))
        .otherwise(F.array(F.lit(-1)))
        .cast("array<bigint>")
        .alias("shape"),
        F.lit(0).cast("bigint").alias("chunk_offset"),
        F.transform("embedding", lambda x: x.cast("double")).alias("num_values"),
    )
    return rounded(normalize_ndarray(raw).drop("path_parts"), 6)


@query
def landed_frames(spark, sf):
    """Pages as records of text, whole numbers and flags, embeddings' labels as arrays: through one landing."""
    pages = _paths(spark, sf).select(
        F.col("host").alias("file_label"),
        F.array(F.lit("g"), F.lit("meta")).alias("path_parts"),
        F.lit("compound").alias("kind"),
        F.array(*map(F.lit, (TIME, "url", "chars", "secure"))).alias("field_names"),
        F.array(F.lit(1)).cast("array<bigint>").alias("shape"),
        F.col("page_id").cast("bigint").alias("chunk_offset"),
        F.create_map(F.lit(TIME), F.array(F.col("page_id").cast("bigint")), F.lit("chars"), F.array(F.length("html").cast("bigint"))).alias("int_fields"),
        F.create_map(F.lit("url"), F.array("url")).alias("text_fields"),
        F.create_map(F.lit("secure"), F.array(F.col("url").startswith("https"))).alias("flag_fields"),
    )
    label = F.col("label").cast("bigint")
    vectors = table(spark, sf, "embeddings").select(
        F.concat(F.lit("v"), F.col("vec_id")).alias("file_label"),
        F.array(F.lit("g"), F.lit("label")).alias("path_parts"),
        F.lit("ndarray").alias("kind"),
        F.array().cast("array<string>").alias("field_names"),
        F.array(F.lit(2), F.lit(2)).cast("array<bigint>").alias("shape"),
        F.lit(0).cast("bigint").alias("chunk_offset"),
        F.array(label, label + 2**53 + 1, label * 2, label - 1).alias("int_values"),
    )
    none = spark.createDataFrame([], TYPED_SCHEMA)
    raw = none.unionByName(pages, allowMissingColumns=True).unionByName(vectors, allowMissingColumns=True)
    return frames_from_raw(raw).df.select(
        *JOB, F.col(TIME).cast("bigint").alias(TIME), ROW, "meta.url", "meta.chars", "meta.secure", "label.col_0", "label.col_1"
    )


@query
def record_vectors(spark, sf):
    """Embeddings as records, ten to a chunk: the vector is one field with a shape, and each record gets a column of each part."""
    vectors = table(spark, sf, "embeddings").withColumn("chunk", F.floor(F.col("vec_id") / 10))
    chunks = vectors.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("v")))).alias("r"))
    raw = chunks.select(
        F.col("chunk").cast("string").alias("file_label"),
        F.array(F.lit("g"), F.lit("vectors")).alias("path_parts"),
        F.lit("compound").alias("kind"),
        F.array(F.lit(TIME), F.lit("v"), F.lit("label")).alias("field_names"),
        F.array(F.size("r").cast("bigint")).alias("shape"),
        F.lit(0).cast("bigint").alias("chunk_offset"),
        F.create_map(F.lit("v"), F.flatten(F.transform("r", lambda x: x["v"]))).alias("fields"),
        F.create_map(F.lit(TIME), F.transform("r", lambda x: x["vec_id"].cast("bigint")), F.lit("label"), F.transform("r", lambda x: x["label"].cast("bigint"))).alias("int_fields"),
        F.create_map(F.lit("v"), F.array(F.size(F.col("r")[0]["v"]).cast("bigint"))).alias("field_shapes"),
    )
    none = spark.createDataFrame([], SHAPED_SCHEMA)
    rows = samples_from_raw(none.unionByName(raw, allowMissingColumns=True))
    return rounded(rows.select("file_label", F.col(TIME).alias("vec_id"), F.inline("cells")), 6)


@query
def table_names(spark, sf):
    return _paths(spark, sf).select("page_id", table_name(F.array_join("below", "/")).alias("table_name"))


def _objects(spark, sf):
    name = F.when(F.col("page_id") % 3 == 0, ".csv").when(F.col("page_id") % 7 == 0, "_batch.h5").otherwise(".h5")
    return _paths(spark, sf).select(
        "page_id", F.concat(F.array_join("below", "/"), name).alias("key"), F.length("html").alias("chars")
    )


@query
def object_inventory_filter(spark, sf):
    return object_inventory(_objects(spark, sf), "/en").select("page_id", "key", "file_label")


@query
def file_labels(spark, sf):
    files = _objects(spark, sf).select("page_id", file_stem(F.col("key")).alias("file_label"))
    return drop_batch_files(files)


@query
def discovered_files(spark, sf):
    objects = _objects(spark, sf).withColumn("file_label", file_stem(F.col("key")))
    local = objects.where("page_id % 2 = 0").withColumn("path", F.concat(F.lit("/data/"), F.col("key")))
    return discover_union(local, object_inventory(objects.where("page_id % 2 = 1").drop("file_label")))


@query
def latest_file_per_label(spark, sf):
    files = _paths(spark, sf).select(
        F.col("below")[0].alias("file_label"),
        F.col("url").alias("path"),
        (F.col("page_id") % 2).cast("int").alias("src_ord"),
    )
    return latest_per_label(files)


def _notices(spark, sf):
    name = F.when(F.col("value") < 20, ".csv").otherwise(".h5")
    key = F.concat("event_type", F.lit("/"), F.col("event_id").cast("string"), name)
    record = F.struct(
        F.struct(
            F.struct(F.when(F.col("user_id") % 7 != 0, "b").alias("name")).alias("bucket"),
            F.struct(F.when(F.col("user_id") % 9 != 0, key).alias("key")).alias("object"),
        ).alias("s3")
    )
    records = F.when(F.col("event_id") % 11 == 0, F.filter(F.array(record), lambda r: F.lit(False))).otherwise(
        F.array(record)
    )
    document = F.to_json(F.struct(records.alias("Records"))).alias("value")
    return parse_notices(table(spark, sf, "events").select("event_id", document))


@query
def notification_filter(spark, sf):
    return notice_records(_notices(spark, sf)).select("event_id", "bucket", "key", "file_label", "reason")


@query
def notification_audit(spark, sf):
    return acceptance_audit(notice_records(_notices(spark, sf)))


@query
def object_names(spark, sf):
    names = _paths(spark, sf).select(
        "page_id", "host", F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("../"), F.col("url"))).otherwise(F.col("url")).alias("name")
    )
    safe = sanitize_object_name(F.col("name"))
    return names.select(
        "page_id", safe.alias("safe"), object_name_is_valid(safe).alias("valid"), storage_key(F.col("host"), safe).alias("key")
    )


@query
def objects_of_user(spark, sf):
    n = F.col("page_id")
    micros = (1_700_000_000 + n * 3_600) * 1_000_000 + F.when(n % 3 == 0, 123_456).otherwise(0)
    objects = _objects(spark, sf).select(
        "key",
        F.when(n % 5 != 0, F.col("chars")).alias("size"),
        F.when(n % 4 != 0, F.timestamp_micros(micros)).alias("last_modified"),
    )
    return user_objects(objects, "en")


@query
def labels_to_rescan(spark, sf):
    inventory = table(spark, sf, "documents").select(F.col("doc_id").alias("file_label"), "lang", "source")
    return rescan_missing(inventory, table(spark, sf, "labels").select(F.col("doc_id").alias("file_label")))


@query
def masked_secrets(spark, sf):
    customers = table(spark, sf, "customer")
    name = F.when(F.col("c_custkey") % 10 == 0, F.lit(None)).when(F.col("c_custkey") % 10 == 1, "abc")
    name = name.when(F.col("c_custkey") % 10 == 2, "").otherwise(F.col("c_name"))
    return customers.select("c_custkey", mask_secret(name).alias("masked"))


# --- whole plans ----------------------------------------------------------------------------


@query
def job_tables(spark, sf):
    return rounded(job_table(event_frames(spark, sf), event_prices(spark, sf)), 3)


@query
def first_group_tables(spark, sf):
    """Later groups have impossible times; they do not spoil a file whose first usable group is good."""
    frames = event_frames(spark, sf)
    spoiled = (F.col("group_name") == "g1") & (F.col(ROW) % 7 == 0)
    late = frames.df.withColumn(TIME, F.when(spoiled, F.lit(-1)).otherwise(F.col(TIME)))
    return rounded(job_table(frames.with_df(late)), 3)


@query
def split_jobs(spark, sf):
    """All jobs in many segments and chunks: the same rows as `interpolate_rows`."""
    split = prepare(event_frames(spark, sf), segment_rows=16, chunk_rows=8)
    return rounded(fill(align(split)).df.select(*AT, *SOURCE_COLUMNS))


def _report(spark, sf):
    return job_report(event_frames(spark, sf, energy=_zero_for_some), event_prices(spark, sf))


@query
def job_report_statistics(spark, sf):
    return rounded_statistics(_report(spark, sf).stats, 3)


@query
def job_report_combined(spark, sf):
    return rounded(_report(spark, sf).combined, 3)


@query
def job_report_counts(spark, sf):
    return _report(spark, sf).counts


@query
def job_report_summary(spark, sf):
    return _summary_rows(_report(spark, sf).summary)


@query
def job_report_costs(spark, sf):
    return rounded(_report(spark, sf).cost, 4)


@query
def job_report_prices(spark, sf):
    return rounded(_report(spark, sf).prices, 4)


@query
def stream_job_tables(spark, sf):
    """Notifications for all users in two batches, streamed; the result is the table the stream wrote."""
    run = new_folder(spark, "stream")
    files = job_events(spark, sf).select("file_label", "user_id").distinct()

    def record(folder: str):
        key = F.concat(F.lit(f"{folder}/"), F.col("file_label"), F.lit(".h5"))
        return F.struct(F.struct(F.struct(F.lit("runs").alias("name")).alias("bucket"), F.struct(key.alias("key")).alias("object")).alias("s3"))

    def load(batch: DataFrame) -> Frames:
        return event_frames(spark, sf, files=batch.select("file_label"))

    # Every label is notified twice, with two keys; the second batch names every third user again.
    for which in ("true", "user_id % 3 = 0"):
        files.where(which).select(F.array(record("z-old"), record("new")).alias("Records")).write.mode("append").json(f"{run}/notices")
        stream_jobs(spark, f"{run}/notices", f"{run}/out", f"{run}/checkpoint", load).awaitTermination()
    return rounded(read_jobs(spark, f"{run}/out/jobs"), 3)


@query
def stream_changing_tables(spark, sf):
    """Two batches of a stream whose jobs have other datasets, and a field that is text in the first and a number in the second."""
    run = new_folder(spark, "changing")
    files = job_events(spark, sf).select("file_label", "user_id").distinct()

    def record(folder: str):
        key = F.concat(F.lit(f"{folder}/"), F.col("file_label"), F.lit(".h5"))
        return F.struct(F.struct(F.struct(F.lit("runs").alias("name")).alias("bucket"), F.struct(key.alias("key")).alias("object")).alias("s3"))

    def load(batch: DataFrame) -> Frames:
        old = not batch.where("startswith(key, 'old/')").isEmpty()
        frames = event_frames(spark, sf, files=batch.select("file_label"), keep=F.col("event_type").isin("purchase", "click") if old else None)
        note = F.concat(F.lit("L"), F.regexp_extract("file_label", "[0-9]+", 0)) if old else F.col("Task_0.CPUUtilization") * 2
        noted = F.when(F.col("Task_0").isNotNull(), F.struct("Task_0.CPUUtilization", note.alias("Note")))
        return Frames(frames.df.withColumn("Task_0", noted), frames.prefixes[:2] if old else frames.prefixes)

    for which, folder in (("user_id % 2 = 0", "old"), ("user_id % 2 = 1 OR user_id % 3 = 0", "new")):
        files.where(which).select(F.array(record(folder)).alias("Records")).write.mode("append").json(f"{run}/notices")
        stream_jobs(spark, f"{run}/notices", f"{run}/out", f"{run}/checkpoint", load).awaitTermination()
    rows = read_jobs(spark, f"{run}/out/jobs")
    number = F.col("Task_0__Note").try_cast("double").alias("note")
    return rounded(rows.select("*", number, F.when(number.isNull(), F.col("Task_0__Note")).alias("text")).drop("Task_0__Note"), 3)


@query
def stream_objects(spark, sf):
    """The objects a stream of notifications accepts: the key notified last counts."""
    run = new_folder(spark, "objects")
    events = job_events(spark, sf).groupBy("file_label", "event_type").agg(F.min("event_id").alias("event_id"))
    key = F.concat("event_type", F.lit("/"), "file_label", F.lit(".h5"))
    record = F.struct(F.struct(F.struct(F.lit("runs").alias("name")).alias("bucket"), F.struct(key.alias("key")).alias("object")).alias("s3"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("event_id", record.alias("record")))), lambda x: x["record"])
    events.groupBy("file_label").agg(ordered.alias("Records")).select("Records").write.json(f"{run}/notices")
    stream_objects_to(spark, f"{run}/notices", f"{run}/out", f"{run}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{run}/out/accepted").select("file_label", "bucket", "key")
