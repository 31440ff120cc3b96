"""One query per operator, each over whole tables. Names start with the operator's id."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell import datasets as D
from tidewell.functions.casts import parse_timestamp, to_int
from tidewell.functions.text import batch_id_from_name, batch_order
from tidewell.operators import checks, clean, feed, ledger, merge, nested, quality
from tidewell.plans import cleaning, jobs, questions, seeds, star, suites, views
from tidewell.plans.schemas import processed_schema
from tidewell.session import pin, shared_dir
from tidewell.sources import export, feeds, layers, scans
from tidewell.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Types SQL engines print alike: whole numbers as long, money as double, times without zone.
_PLAIN = {
    T.ByteType: "long", T.ShortType: "long", T.IntegerType: "long",
    T.DecimalType: "double", T.FloatType: "double",
    T.DateType: "timestamp_ntz", T.TimestampType: "timestamp_ntz",
}


def plain(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f"`{f.name}`").cast(_PLAIN[type(f.dataType)]).alias(f.name)
            if type(f.dataType) in _PLAIN
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(fn(pin(spark), sf_dir))

    run.__name__ = fn.__name__
    QUERIES[fn.__name__] = run
    return fn


read = seeds.read


def customers(s, d):
    return seeds.seed_customers(read(s, d, "customer"), read(s, d, "nation"), read(s, d, "region"))


def products(s, d):
    return seeds.seed_products(read(s, d, "part"))


def orders(s, d):
    return seeds.seed_orders(read(s, d, "orders"))


def items(s, d):
    return seeds.seed_order_items(read(s, d, "lineitem"))


def payments(s, d):
    return seeds.seed_payments(read(s, d, "orders"))


def sessions(s, d):
    return seeds.seed_sessions(read(s, d, "events"))


def reviews(s, d):
    return seeds.seed_reviews(read(s, d, "documents"), read(s, d, "labels"))


def carriers(s, d):
    return seeds.seed_carriers(read(s, d, "supplier"))


def heads(s, d):
    return seeds.seed_shipment_heads(read(s, d, "lineitem"))


def shipments(s, d):
    return seeds.seed_shipments(read(s, d, "lineitem"))


def events(s, d):
    return seeds.seed_customer_events(read(s, d, "events"))


def f_orders(s, d):
    return star.fact_orders(orders(s, d))


def f_shipments(s, d):
    return star.fact_shipments(seeds.seed_shipment_heads(read(s, d, "lineitem"), typed=True))


# A. Scans, sources, sinks

ORDER_MARK = "1998-06-01 00:00:00"
ID_MARK = f"{64:024x}"


@query
def a01_incremental_scan(s, d):
    cols = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]
    return scans.incremental_scan(read(s, d, "orders"), cols, "o_orderdate", ORDER_MARK)


@query
def a02_full_scan(s, d):
    return scans.full_scan(items(s, d), D.BY_NAME["order_items"].columns)


@query
def a03_id_cursor_scan(s, d):
    return scans.id_cursor_scan(reviews(s, d), ID_MARK).select("_id", "review_id", "product_id")


def _landed_pages(s, d, keep=None):
    pages = seeds.seed_pages(heads(s, d), "order_id")
    path = shared_dir(s, "pages")
    (pages if keep is None else pages.filter(keep)).write.json(path)
    return path


@query
def a04_paged_source(s, d):
    rows = feeds.read_pages(s, _landed_pages(s, d), D.SHIPMENT_SCHEMA)
    return nested.flatten_struct(rows.drop("events"))


@query
def a04_page_gaps(s, d):
    # A walk that lost every seventh page.
    path = _landed_pages(s, d, F.col("page") % 7 != 0)
    return feeds.page_gaps(feeds.read_envelopes(s, path, D.SHIPMENT_SCHEMA))


@query
def a05_unpaged_source(s, d):
    path = shared_dir(s, "carriers")
    # One answer per hundred carriers, each a bare array in a file of its own.
    answers = carriers(s, d).withColumn(
        "answer", F.floor(F.regexp_extract("carrier_id", r"(\d+)", 1).cast("long") / 100)
    ).groupBy("answer").agg(
        F.to_json(F.sort_array(F.collect_list(F.struct(*D.CARRIER_SCHEMA.names)))).alias("value")
    )
    answers.write.partitionBy("answer").text(path)
    return feeds.read_unpaged(s, path, D.CARRIER_SCHEMA).select(*D.CARRIER_SCHEMA.names)


@query
def a06_land_raw(s, d):
    root = shared_dir(s, "lake")
    layers.land(seeds.with_batches(orders(s, d), "order_id"), root, "postgres", "orders")
    rows = layers.scan_layer(s, root, "raw", "postgres", "orders")
    return rows.select("batch_id", "order_id", "total_amount", "updated_at")


@query
def a07_scan_layer(s, d):
    root = shared_dir(s, "lake")
    layers.land(seeds.with_batches(customers(s, d), "customer_id"), root, "postgres", "customers")
    layers.land(seeds.with_batches(products(s, d), "product_id"), root, "postgres", "products")
    out = None
    for table in ("customers", "products"):
        one = layers.scan_layer(s, root, "raw", "postgres", table).groupBy("batch_id").agg(
            F.count(F.lit(1)).alias("rows")
        ).withColumn("table_name", F.lit(table))
        out = one if out is None else out.unionByName(one)
    return out


def _rename(s, folder, name_of):
    """Give every Parquet file of a folder the name that ``name_of`` makes of its number."""
    path = s._jvm.org.apache.hadoop.fs.Path(folder)
    held = path.getFileSystem(s._jsc.hadoopConfiguration())
    found = sorted(f.getPath().getName() for f in held.listStatus(path))
    for n, name in enumerate(n for n in found if n.endswith(".parquet")):
        held.rename(path.suffix(f"/{name}"), path.suffix(f"/{name_of(n)}"))


@query
def a07_flat_layout(s, d):
    """Plain files whose names give the batch; a file that lies too high is told, not read."""
    root = shared_dir(s, "lake")
    table = layers.table_path(root, "raw", "postgres", "products")
    rows = seeds.with_batches(products(s, d), "product_id")
    schema = products(s, d).schema
    for n in range(1, 5):
        batch = rows.filter(F.col("batch_id") == f"20260101_000000_{n}").drop("batch_id")
        batch.coalesce(1).write.mode("overwrite").parquet(f"{table}/{n}")
        _rename(s, f"{table}/{n}", lambda k: f"products_20260101_000000_{n}.parquet")
    rows.drop("batch_id").coalesce(1).write.parquet(f"{root}/raw/postgres/stray")
    stray = s._jvm.org.apache.hadoop.fs.Path(f"{root}/raw/postgres/stray")
    held = stray.getFileSystem(s._jsc.hadoopConfiguration())
    _rename(s, f"{root}/raw/postgres/stray", lambda k: "stray.parquet")
    held.rename(stray.suffix("/stray.parquet"), stray.getParent().suffix("/stray.parquet"))
    read_rows = layers.scan_flat(s, root, "raw", "postgres", "products", True, schema).groupBy(
        "batch_id", F.col("file_name").alias("file")
    ).agg(F.count(F.lit(1)).alias("rows"), F.lit(None).cast("string").alias("reason"))
    skipped = layers.skipped_paths(s, root).select(
        F.lit(None).cast("string").alias("batch_id"), F.element_at(F.split("path", "/"), -1).alias("file"),
        F.lit(None).cast("long").alias("rows"), "reason",
    )
    return read_rows.unionByName(skipped)


@query
def a08_unknown_table_guard(s, d):
    root = shared_dir(s, "lake")
    layers.land(orders(s, d), root, "postgres", "orders", "20260101_000000_1")
    layers.land(carriers(s, d), root, "mongodb", "suppliers", "20260101_000000_1")
    skipped = layers.skipped_paths(s, root)
    table = F.concat_ws("/", *[F.split("path", "/")[i] for i in (1, 2)])
    return skipped.select(table.alias("table_name"), "reason").distinct()


@query
def a09_write_processed(s, d):
    root = shared_dir(s, "lake")
    layers.land(seeds.with_batches(products(s, d), "product_id"), root, "postgres", "products")
    raw = layers.scan_layer(s, root, "raw", "postgres", "products")
    layers.write_processed(cleaning.process("products", raw), root, "postgres", "products")
    rows = layers.scan_layer(s, root, "processed", "postgres", "products")
    return rows.select("batch_id", "product_id", "brand", "unit_price")


@query
def a10_csv_export(s, d):
    rows = reviews(s, d).select("review_id", "rating", "title", "review_text", "verified_purchase")
    path = export.csv_export(rows, shared_dir(s, "export"))
    return export.csv_import(s, path, rows.schema)


@query
def a11_corrupt_input_raises(s, d):
    root = shared_dir(s, "lake")
    layers.land(products(s, d), root, "postgres", "products", "20260101_000000_1")
    # A second batch whose files are named like Parquet but hold JSON.
    broken = f"{layers.table_path(root, 'raw', 'postgres', 'products')}/batch_id=20260101_000000_2"
    products(s, d).select(F.to_json(F.struct("*")).alias("value")).write.text(broken)
    folder = s._jvm.org.apache.hadoop.fs.Path(broken)
    files = folder.getFileSystem(s._jsc.hadoopConfiguration())
    for status in files.listStatus(folder):
        path = status.getPath()
        if path.getName().endswith(".txt"):
            files.rename(path, path.suffix(".parquet"))
    schema = products(s, d).schema
    try:
        layers.scan_layer(s, root, "raw", "postgres", "products", schema).agg(F.max("brand")).first()
        raised = False
    except Exception:
        raised = True
    good = layers.scan_layer(s, root, "raw", "postgres", "products", schema, ["20260101_000000_1"])
    return good.agg(F.count(F.lit(1)).alias("rows"), F.lit(raised).alias("raised"))


@query
def a12_partitioned_parquet(s, d):
    path = layers.write_partitioned(orders(s, d), shared_dir(s, "orders"), "order_date", "month")
    return s.read.parquet(path).select(
        F.col("order_date_month").cast("string").alias("order_date_month"),
        "order_id", "order_date", "total_amount",
    )


# B. Projection, predicate, paging


@query
def b01_project(s, d):
    return payments(s, d).select(*D.BY_NAME["payments"].columns)


@query
def b02_feed_filter_status(s, d):
    return feed.feed_filter(heads(s, d), status="in_transit").select("shipment_id", "order_id")


@query
def b03_feed_filter_updated_since(s, d):
    kept = feed.feed_filter(heads(s, d), updated_since="2000-06-01T12:00:00+01:00")
    return kept.select("shipment_id", "updated_at")


@query
def b04_page(s, d):
    return feed.page(heads(s, d), ["shipment_id"], 3, 100)[0].select("shipment_id", "order_id")


@query
def b04_page_index(s, d):
    """A page by its number, found through the index of page starts."""
    index = feed.page_index(heads(s, d), ["shipment_id"], 100)
    return feed.page(heads(s, d), ["shipment_id"], 12, 100, index=index)[0].select("shipment_id", "order_id")


@query
def b04_page_totals(s, d):
    return feed.page(heads(s, d), ["shipment_id"], 3, 100)[1]


@query
def b05_lookup(s, d):
    return feed.lookup(heads(s, d), "shipment_id", "shp_000000000042").select(
        "shipment_id", "order_id", "shipment_status"
    )


@query
def b06_drop_if_exists(s, d):
    return clean.drop_if_exists(carriers(s, d), "support_phone", "no_such_column")


@query
def b07_drop_nested(s, d):
    return sessions(s, d).drop("events", "device", "location")


@query
def b08_fill_null(s, d):
    return clean.fill_null(products(s, d), cleaning.BRAND_FILL).select("product_id", "brand")


@query
def b09_pass_through(s, d):
    return cleaning.process("customers", customers(s, d))


# C. Nested data


@query
def c01_flatten_struct(s, d):
    return nested.flatten_struct(sessions(s, d)).drop("events")


@query
def c02_explode_events(s, d):
    exploded = nested.explode_events(sessions(s, d).select("session_id", "events"))
    return exploded.select("session_id", "event.event_time", "event.event_type")


@query
def c03_expand_event(s, d):
    docs = shipments(s, d).select("shipment_id", "events")
    return nested.expand_event(nested.explode_events(docs, position="event_no"))


@query
def c04_zip_columns(s, d):
    return cleaning.exploded_sessions(sessions(s, d)).select(
        "_id", "session_id", "customer_id", "event_no", "event_time", "event_type", "product_id",
        "quantity", "device_os", "location_city",
    )


@query
def c05_nest_events(s, d):
    lines = items(s, d).select("order_id", "order_item_id", "product_id", "line_total")
    docs = nested.nest_events(
        lines, ["order_id"], ["order_item_id", "product_id", "line_total"], "lines",
        part=F.col("product_id") % 2,
    )
    ids = F.transform("lines", lambda e: e["order_item_id"].cast("string"))
    return docs.select(
        "order_id", "part", F.size("lines").alias("n_lines"), F.concat_ws(",", ids).alias("ids"),
        F.element_at("lines", 1)["line_total"].alias("first_total"),
    )


# D. Casts and scalar cleaning


@query
def d01_to_timestamp_coerce(s, d):
    rows = nested.expand_event(nested.explode_events(sessions(s, d).select("_id", "started_at", "events")))
    return clean.to_timestamp_coerce(
        rows.select("_id", "started_at", "event_time", "event_type"), ["started_at", "event_time"]
    )


@query
def d02_parse_iso(s, d):
    at, k = F.col("ts"), F.col("event_id")
    text = (
        F.when(k % 4 == 0, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(k % 4 == 1, F.date_format(at, "yyyy-MM-dd HH:mm:ss'+01:00'"))
        .when(k % 4 == 2, F.date_format(at, "yyyy-MM-dd"))
        .otherwise(F.date_format(at, "HH:mm:ss"))
    )
    return read(s, d, "events").select("event_id", parse_timestamp(text).alias("parsed"))


@query
def d03_to_int_nullable(s, d):
    line = read(s, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.col("l_tax").alias("tax"), F.col("l_partkey").cast("string").alias("part"),
    )
    double, text = T.DoubleType(), T.StringType()
    return line.select(
        "l_orderkey",
        "l_linenumber",
        to_int(F.col("l_quantity"), double).alias("quantity"),
        to_int(F.col("tax"), double, "null").alias("whole_tax"),
        to_int(F.col("part"), text).alias("part"),
    )


@query
def d03_int_offenders(s, d):
    return clean.int_offenders(read(s, d, "lineitem"), ["l_quantity", "l_tax", "l_extendedprice"])


@query
def d04_to_bool_default_false(s, d):
    return clean.to_bool_default(reviews(s, d), ["verified_purchase"]).select(
        "review_id", "verified_purchase"
    )


@query
def d05_strip_all_strings(s, d):
    return clean.strip_strings(carriers(s, d))


@query
def d06_strip_after_fill(s, d):
    filled = clean.fill_null(reviews(s, d), cleaning.REVIEW_FILL)
    return clean.strip_strings(filled, ["review_text", "title"]).select(
        "review_id", "title", "review_text"
    )


@query
def d07_id_to_string(s, d):
    return clean.id_to_string(read(s, d, "documents").select("doc_id", "n_chars"), "doc_id")


@query
def d08_batch_id_from_name(s, d):
    named = seeds.with_batches(orders(s, d), "order_id", 12).select(
        F.concat(F.lit("orders_"), "batch_id", F.lit(".parquet")).alias("file_name")
    )
    batch = batch_id_from_name(F.col("file_name"), "orders")
    return named.groupBy(batch.alias("batch_id")).agg(F.count(F.lit(1)).alias("rows"))


# E. De-duplication


def _texts(s, d):
    return seeds.with_batches(read(s, d, "documents"), "doc_id", 2).select(
        "batch_id", "lang", "text"
    )


@query
def e01_dedup_full_row(s, d):
    return clean.dedup_full_row(_texts(s, d))


@query
def e01_dedup_session_events(s, d):
    return cleaning.clean_sessions(seeds.with_batches(sessions(s, d), "customer_id")).select(
        "batch_id", "_id", "session_id", "customer_id", "started_at", "event_no", "event_time",
        "event_type", "product_id", "search_term", "quantity", "page_url",
    )


@query
def e02_dedup_then_strip(s, d):
    # Every carrier arrives twice plainly and once with a longer pad.
    rows = carriers(s, d)
    padded = rows.withColumn("carrier_name", F.concat("carrier_name", F.lit(" ")))
    return cleaning.clean_carriers(rows.unionByName(rows).unionByName(padded))


@query
def e03_dedup_metrics(s, d):
    raw = _texts(s, d).select("batch_id", "lang", F.split("text", "\n").alias("lines"))
    return clean.dedup_metrics(raw, nested.explode_events(raw, "lines", "line"))


# F. Warehouse load and merge


def _split_items(s, d):
    """Items in two halves by product: one loaded, one arriving."""
    rows = items(s, d)
    return rows.filter("product_id % 2 = 0"), rows.filter("product_id % 2 = 1")


@query
def f01_merge_first_wins(s, d):
    loaded, arriving = _split_items(s, d)
    key = ["order_item_id"]
    target = merge.first_per_key(loaded, key, merge.row_order(loaded, key))
    new = merge.merge_first_wins(arriving, target, key, merge.row_order(arriving, key))
    return target.unionByName(new)


@query
def f02_merge_latest_wins(s, d):
    rows = orders(s, d).select("customer_id", "order_id", "order_status", "updated_at")
    return merge.merge_latest_wins(
        rows, ["customer_id"], [F.desc("updated_at"), F.desc("order_id")]
    )


@query
def f02_versioned_loads(s, d):
    """Every load brings newer and older versions of the same keys; the newest of all is read."""
    root, key = shared_dir(s, "warehouse"), ["customer_id"]
    newest = [F.desc("updated_at"), F.desc("order_id")]
    rows = orders(s, d).select("customer_id", "order_id", "order_status", "updated_at")
    rows = seeds.with_batches(rows, "order_id", 3)
    for n in (1, 2, 3):
        merge.load_batches(
            s, rows.filter(F.col("batch_id") == f"20260101_000000_{n}"), root, "orders", "postgres", key,
            jobs.runs_path(root), jobs.marks_path(root), "latest", newest,
        )
    return merge.read_latest(s, root, "orders", rows.schema, key, newest).drop("batch_id")


def _land_items(s, root, rows):
    layers.write_processed(rows, root, "postgres", "order_items")
    return layers.scan_layer(s, root, "processed", "postgres", "order_items", rows.schema)


def _load_items(s, d, rounds=1):
    """Load the items in batches by product; each round offers one more batch."""
    root = shared_dir(s, "warehouse")
    rows = _land_items(s, root, seeds.with_batches(items(s, d), "product_id"))
    for n in range(1, rounds + 1):
        offered = rows if n == rounds else rows.filter(F.col("batch_id") <= f"20260101_000000_{n}")
        merge.load_batches(
            s, offered, root, "order_items", "postgres", ["order_item_id"],
            jobs.runs_path(root), jobs.marks_path(root),
        )
    return root, rows.schema


def _run_rows(s, root):
    return ledger.read_runs(s, jobs.runs_path(root))


@query
def f03_stage_and_load(s, d):
    root, schema = _load_items(s, d)
    return merge.read_table(s, root, "order_items", schema).drop("load_id")


@query
def f04_skip_loaded_batches(s, d):
    root, schema = _load_items(s, d, rounds=3)
    runs = _run_rows(s, root)
    started = runs.filter("status = 'started'").groupBy(F.col("watermark_value").alias("batch_id"))
    table = merge.read_table(s, root, "order_items", schema).groupBy("batch_id")
    return table.agg(F.count(F.lit(1)).alias("rows")).join(
        started.agg(F.count(F.lit(1)).alias("runs")), "batch_id", "full"
    )


@query
def f05_load_order(s, d):
    rows = seeds.with_batches(items(s, d), "product_id", 12)
    key = ["order_item_id"]
    return merge.first_per_key(rows, key, merge.row_order(rows, key, *batch_order(F.col("batch_id"))))


@query
def f06_null_key_rows(s, d):
    root, dataset = shared_dir(s, "warehouse"), D.BY_NAME["shipments"]
    # The documents are landed first: nested they are a third of their events, and they are read twice.
    documents = seeds.with_batches(shipments(s, d), "order_id")
    layers.land(documents, root, dataset.source, "shipments")
    raw = layers.scan_layer(s, root, "raw", dataset.source, "shipments", documents.schema)
    dedup = partial(clean.dedup_by_hash, path=f"{root}/staging/copies")
    events = cleaning.clean_shipments(raw, dedup=dedup)
    layers.write_processed(events, root, dataset.source, "shipments", spread=False)
    rows = layers.scan_layer(s, root, "processed", dataset.source, "shipments", events.schema)
    merge.load_batches(
        s, rows, root, "shipments", dataset.source, dataset.primary_key, jobs.runs_path(root)
    )
    unkeyed = layers.scan_layer(s, root, merge.UNKEYED, dataset.source, "shipments", events.schema)
    return unkeyed.select("shipment_id", "event_no", "event_type", "location", "metadata")


def _failed_load(s, d):
    root = shared_dir(s, "warehouse")
    rows = _land_items(s, root, seeds.with_batches(items(s, d), "product_id"))
    poison = F.when(F.col("quantity") > 49, F.raise_error("bad quantity").cast("long"))
    try:
        merge.load_batches(
            s, rows.withColumn("quantity", F.coalesce(poison, "quantity")), root, "order_items",
            "postgres", ["order_item_id"], jobs.runs_path(root),
        )
    except Exception:
        return root, rows.schema
    raise AssertionError("the poisoned load went through")


@query
def f07_fail_batch(s, d):
    root, schema = _failed_load(s, d)
    table = merge.read_table(s, root, "order_items", schema)
    visible = table.groupBy(F.col("batch_id").alias("watermark_value")).agg(F.count(F.lit(1)).alias("n"))
    return ledger.run_state(_run_rows(s, root)).join(visible, "watermark_value", "left").select(
        F.col("watermark_value").alias("batch_id"), "status",
        F.contains("error_message", F.lit("bad quantity")).alias("has_error"),
        F.coalesce("n", F.lit(0)).alias("rows_visible"),
    )


# G. Control state


def _order_marks(s, d):
    """A mark ledger with one row per batch of orders."""
    path = shared_dir(s, "marks")
    rows = seeds.with_batches(orders(s, d), "order_id").groupBy("batch_id", "order_status").agg(
        F.max("updated_at").alias("top")
    )
    ledger.append_marks(
        rows.select(
            F.lit("extract:orders").alias("pipeline_name"),
            F.col("order_status").alias("source_name"),
            F.lit("updated_at").alias("watermark_column"),
            F.col("top").cast("string").alias("watermark_value"),
            batch_order(F.col("batch_id"))[1].alias("last_sequence"),
            F.col("top").cast("timestamp").alias("updated_at"),
        ),
        path,
    )
    return ledger.read_marks(s, path)


_MARK_COLS = ["pipeline_name", "source_name", "watermark_column", "watermark_value", "last_sequence"]


@query
def g01_read_hwm(s, d):
    value, sequence = ledger.read_mark(_order_marks(s, d), "extract:orders", "delivered")
    newer = orders(s, d).filter("order_status = 'delivered'")
    return newer.agg(
        F.lit(value).alias("mark"), F.lit(sequence).alias("last_sequence"),
        F.count_if(F.col("updated_at") > F.lit(value).cast("timestamp_ntz")).alias("beyond"),
    )


@query
def g02_write_hwm(s, d):
    return _order_marks(s, d).select(*_MARK_COLS)


@query
def g03_advance_hwm(s, d):
    return ledger.advance_mark(orders(s, d), "updated_at", "1999-01-01 00:00:00")


@query
def g04_advance_id_mark(s, d):
    return ledger.advance_mark(reviews(s, d), "_id", ID_MARK, "string")


@query
def g05_start_run(s, d):
    root, _ = _load_items(s, d)
    started = _run_rows(s, root).filter(F.col("event_seq") == ledger.STARTED)
    return started.select("pipeline_name", "source_name", "status", "watermark_value")


@query
def g06_mark_success(s, d):
    root, _ = _load_items(s, d)
    done = ledger.successes(_run_rows(s, root))
    return done.select("watermark_value", "records_extracted", "records_loaded", "records_ignored")


@query
def g07_mark_fail(s, d):
    root, _ = _failed_load(s, d)
    return _run_rows(s, root).groupBy("status").agg(F.count(F.lit(1)).alias("runs"))


@query
def g08_run_state(s, d):
    root, _ = _load_items(s, d, rounds=2)
    state = ledger.run_state(_run_rows(s, root))
    return state.select("watermark_value", "status", "records_extracted", "records_loaded")


@query
def g09_upsert_watermark(s, d):
    root, _ = _load_items(s, d, rounds=2)
    marks = ledger.latest_mark(ledger.read_marks(s, jobs.marks_path(root)))
    return marks.select(*_MARK_COLS[:4])


@query
def g09_latest_marks(s, d):
    return ledger.latest_mark(_order_marks(s, d)).select(*_MARK_COLS)


@query
def g10_recent_runs(s, d):
    root, _ = _load_items(s, d, rounds=3)
    return ledger.recent_runs(_run_rows(s, root), "order_items", "postgres", 2).select(
        "status", "records_extracted"
    )


@query
def g11_extract_metrics(s, d):
    out = None
    for table in ("customer", "part", "orders", "lineitem"):
        one = read(s, d, table).select(
            F.lit(table).alias("table_name"), F.col("_metadata.file_name").alias("file_name")
        )
        out = one if out is None else out.unionByName(one)
    return ledger.extract_metrics(out)


@query
def g12_null_metrics(s, d):
    return clean.null_metrics(reviews(s, d), ["review_text", "title", "verified_purchase"])


# H. Data quality


def _expect(df, *expectations):
    return quality.run_suite(df, expectations).drop("position")


def _typed_reviews(s, d):
    return cleaning.typed_reviews(reviews(s, d))


@query
def h01_expect_row_count_between(s, d):
    rows = read(s, d, "lineitem")
    return _expect(
        rows, quality.expect_row_count_between(1), quality.expect_row_count_between(0, 10)
    )


@query
def h02_expect_column_to_exist(s, d):
    rows = nested.flatten_struct(sessions(s, d))
    return _expect(
        rows, quality.expect_column_to_exist("device_os"), quality.expect_column_to_exist("device")
    )


@query
def h03_expect_not_null(s, d):
    return _expect(reviews(s, d), *[
        quality.expect_not_null(c) for c in ("_id", "title", "review_text", "verified_purchase")
    ])


@query
def h04_expect_between(s, d):
    return _expect(
        items(s, d), quality.expect_between("quantity", 5, 45), quality.expect_between("quantity", 1)
    )


@query
def h05_expect_in_set(s, d):
    return _expect(
        orders(s, d),
        quality.expect_in_set("order_status", D.ORDER_STATUSES),
        quality.expect_in_set("order_status", ("pending", "delivered")),
    )


@query
def h06_expect_unique(s, d):
    return _expect(payments(s, d), *[
        quality.expect_unique(c) for c in ("payment_id", "transaction_reference")
    ])


@query
def h06_expect_unique_text(s, d):
    return quality.run_suite(read(s, d, "documents"), [quality.expect_unique("text")]).select(
        "expectation", "success", "element_count", "missing_count", "unexpected_count",
    )


@query
def h07_expect_length_between(s, d):
    return _expect(
        clean.fill_null(reviews(s, d), cleaning.REVIEW_FILL),
        quality.expect_length_between("title", 1, 255), quality.expect_length_between("review_id", 13, 13),
    )


def _suite_rows(s, d):
    checked = {
        "customer_sessions": cleaning.clean_sessions(sessions(s, d)),
        "product_reviews": cleaning.clean_reviews(reviews(s, d)),
    }
    out = None
    for name, df in checked.items():
        path = shared_dir(s, "checked")
        df.write.parquet(path)
        one = quality.run_suite(s.read.schema(df.schema).parquet(path), suites.SUITES[name])
        one = one.withColumn("suite", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


@query
def h08_run_suite(s, d):
    return _suite_rows(s, d)


@query
def h09_suite_summary(s, d):
    return quality.suite_summary(_suite_rows(s, d))


@query
def h10_check_constraints(s, d):
    tables = {
        "products": products(s, d), "orders": orders(s, d),
        "order_items": items(s, d), "payments": payments(s, d),
    }
    out = None
    for name, df in tables.items():
        one = quality.run_suite(df, checks.CONSTRAINTS[name]).select(
            F.lit(name).alias("table_name"), "column", "success", "element_count", "unexpected_count"
        )
        out = one if out is None else out.unionByName(one)
    return out


@query
def h10_integrity_report(s, d):
    """All declared checks over a warehouse that a run has loaded, and over what it landed."""
    root = shared_dir(s, "integrity")
    jobs.run(s, root, seeds.source_tables(s, d), workers=4)
    return jobs.check(s, root)


@query
def h11_check_foreign_keys(s, d):
    session_rows = cleaning.exploded_sessions(sessions(s, d))
    tables = {
        "customers": customers(s, d), "products": products(s, d), "orders": orders(s, d),
        "order_items": items(s, d), "payments": payments(s, d),
        "customer_sessions": session_rows, "product_reviews": reviews(s, d),
    }
    return checks.orphan_report(tables).withColumn("key", F.col("key").cast("long"))


@query
def h11_orphan_rows(s, d):
    rows = checks.orphans(reviews(s, d), products(s, d), "product_id", "product_id")
    return rows.select("review_id", "product_id", "rating")


@query
def h12_check_unique_keys(s, d):
    tables = {
        "customers": customers(s, d), "products": products(s, d), "orders": orders(s, d),
        "order_items": items(s, d), "payments": payments(s, d),
    }
    return checks.duplicate_report(tables)


@query
def h13_payment_gaps(s, d):
    return checks.payment_gaps(payments(s, d), orders(s, d))


@query
def h13_order_total_gaps(s, d):
    return checks.order_total_gaps(orders(s, d)).select("order_id", "total_amount", "gap")


@query
def h13_line_total_gaps(s, d):
    return checks.line_total_gaps(items(s, d)).select("order_item_id", "line_total", "gap")


def _review_rules():
    return quality.row_rules(
        (*suites.PRODUCT_REVIEWS, quality.expect_between("rating", 1, 5))
    )


@query
def h14_quarantine_clean(s, d):
    kept, _ = quality.quarantine(_typed_reviews(s, d), _review_rules())
    return kept.select("review_id", "rating", "title")


@query
def h14_quarantine_rejected(s, d):
    _, rejected = quality.quarantine(_typed_reviews(s, d), _review_rules())
    return rejected.select(
        "review_id", F.array_join(F.array_sort("reject_reasons"), ",").alias("reasons")
    )


@query
def h14_cast_rejects(s, d):
    """Times and integers that can't be read, through landing, cleaning and quarantine."""
    root, dataset = shared_dir(s, "quarantine"), D.BY_NAME["product_reviews"]
    votes = F.when(F.col("helpful_votes") % 19 == 3, F.col("helpful_votes") + 0.5).otherwise(F.col("helpful_votes"))
    jobs.extract(s, root, dataset, reviews(s, d).withColumn("helpful_votes", votes), "20260101_000000_1")
    jobs.process_dataset(s, root, dataset, on_failure="quarantine")
    schema = T.StructType([*processed_schema("product_reviews"), T.StructField("reject_reasons", T.ArrayType(T.StringType()))])
    rejected = layers.scan_layer(s, root, "rejected", dataset.source, dataset.name, schema)
    told = F.filter("reject_reasons", lambda r: r.contains("="))
    return rejected.select("review_id", F.explode(told).alias("reason"))


@query
def h15_timestamp_rejects(s, d):
    rows = nested.expand_event(
        nested.explode_events(sessions(s, d).select("started_at", "ended_at", "events"))
    )
    found = checks.timestamp_rejects(rows, ["started_at", "ended_at", "event_time"])
    return found.unionByName(checks.timestamp_rejects(reviews(s, d), ["created_at"]))


@query
def h16_rating_range(s, d):
    return checks.out_of_range(reviews(s, d), "rating", 1, 5).select("review_id", "rating")


@query
def h17_normalize_city_case(s, d):
    return checks.case_variants(customers(s, d), "city")


@query
def h18_null_profile(s, d):
    return checks.null_profile(
        {
            "customers": customers(s, d), "products": products(s, d), "payments": payments(s, d),
            "customer_sessions": nested.flatten_struct(sessions(s, d)),
            "product_reviews": reviews(s, d),
        }
    )


@query
def h19_event_time_ties(s, d):
    # To the hour, as two events of a session rarely share a millisecond.
    rows = cleaning.exploded_sessions(sessions(s, d))
    return checks.event_time_ties(rows.withColumn("event_time", F.date_trunc("hour", "event_time")))


# I. Relational constructs of the seeds


@query
def i01_row_source(s, d):
    return seeds.row_source(s, read(s, d, "orders"))


@query
def i02_cte_orders(s, d):
    return orders(s, d)


@query
def i03_numbered_lines(s, d):
    return seeds.seed_order_lines(read(s, d, "orders"))


@query
def i04_payment_join(s, d):
    paid = payments(s, d).select("payment_id", "order_id", "amount")
    lines = items(s, d).select("order_id", "order_item_id", "product_id", "line_total")
    return paid.join(lines, "order_id").drop("order_id")


@query
def i05_picked_by_position(s, d):
    return payments(s, d).groupBy("payment_method").agg(F.count(F.lit(1)).alias("rows"))


@query
def i06_case_products(s, d):
    return products(s, d)


@query
def i07_money_items(s, d):
    return items(s, d)


@query
def i08_text_customers(s, d):
    return customers(s, d)


@query
def i09_interval_orders(s, d):
    return payments(s, d).select("payment_id", "paid_at", "updated_at")


@query
def i10_session_documents(s, d):
    first = F.element_at("events", 1)
    return nested.flatten_struct(
        sessions(s, d).select(
            "_id", "session_id", "customer_id", "started_at", "ended_at", "browser",
            "location", "device", F.size("events").alias("n_events"),
            first["event_time"].alias("first_time"), first["event_type"].alias("first_type"),
        )
    )


# J. Star schema


@query
def j01_dim_customer(s, d):
    return star.dim_customer(customers(s, d))


@query
def j02_dim_product(s, d):
    return star.dim_product(products(s, d))


@query
def j03_dim_date(s, d):
    return star.dim_date(
        [(orders(s, d), "order_date"), (payments(s, d), "paid_at"),
         (f_shipments(s, d), "shipped_at"), (f_shipments(s, d), "delivered_at"),
         (cleaning.clean_sessions(sessions(s, d)), "event_time"),
         (cleaning.clean_shipments(shipments(s, d)), "event_time"),
         (cleaning.clean_reviews(reviews(s, d)), "created_at")]
    )


@query
def j04_dim_carrier(s, d):
    return star.dim_carrier(carriers(s, d))


@query
def j05_fact_orders(s, d):
    return f_orders(s, d)


@query
def j06_fact_order_items(s, d):
    return star.fact_order_items(items(s, d), orders(s, d), products(s, d))


@query
def j07_fact_payments(s, d):
    return star.fact_payments(payments(s, d), orders(s, d))


@query
def j08_fact_customer_events(s, d):
    return star.fact_customer_events(cleaning.clean_sessions(sessions(s, d)))


@query
def j09_fact_shipments(s, d):
    return star.fact_shipments(heads(s, d))


@query
def j10_fact_shipment_events(s, d):
    return star.fact_shipment_events(cleaning.clean_shipments(shipments(s, d)))


def _star(s, d, name, rows):
    """The star over a warehouse into which one dataset has been loaded."""
    root = shared_dir(s, "star")
    jobs.run(s, root, {name: rows})
    return jobs.star(s, root)


@query
def j08_star_customer_events(s, d):
    return _star(s, d, "customer_sessions", sessions(s, d))["fact_customer_events"]


@query
def j09_star_shipments(s, d):
    return _star(s, d, "shipments", shipments(s, d))["fact_shipments"]


@query
def j10_star_shipment_events(s, d):
    return _star(s, d, "shipments", shipments(s, d))["fact_shipment_events"]


@query
def j11_fact_product_reviews(s, d):
    return star.fact_product_reviews(cleaning.clean_reviews(reviews(s, d)))


# K. Business questions


@query
def k01_daily_sales(s, d):
    return questions.daily_sales(f_orders(s, d))


@query
def k01_monthly_sales(s, d):
    return questions.monthly_sales(f_orders(s, d))


@query
def k02_revenue_by_category(s, d):
    return questions.revenue_by_category(items(s, d), star.dim_product(products(s, d)))


@query
def k02_revenue_by_product(s, d):
    return questions.revenue_by_product(items(s, d), star.dim_product(products(s, d)))


@query
def k02_top_products(s, d):
    return questions.revenue_by_product(items(s, d), star.dim_product(products(s, d)), top=10)


@query
def k03_average_order_value(s, d):
    return questions.average_order_value(f_orders(s, d))


@query
def k04_payment_success_rate(s, d):
    return questions.payment_success_rate(star.fact_payments(payments(s, d), orders(s, d)))


@query
def k05_purchase_frequency(s, d):
    return questions.purchase_frequency(star.dim_customer(customers(s, d)), f_orders(s, d))


@query
def k06_view_to_purchase(s, d):
    return questions.view_to_purchase(events(s, d))


@query
def k07_cart_abandonment(s, d):
    return questions.cart_abandonment(events(s, d))


@query
def k07_cart_abandonment_by_gap(s, d):
    return questions.cart_abandonment_by_gap(events(s, d), 30)


@query
def k07_sessionize(s, d):
    return questions.sessionize(events(s, d), 30)


@query
def k08_average_review_score(s, d):
    return questions.average_review_score(
        star.fact_product_reviews(reviews(s, d)), star.dim_product(products(s, d))
    )


@query
def k08_label_score_by_source(s, d):
    labels = read(s, d, "labels").select("doc_id", "quality")
    rows = read(s, d, "documents").select("doc_id", "source", "lang").join(labels, "doc_id")
    return rows.groupBy("source", "lang").agg(
        F.count(F.lit(1)).alias("reviews"), F.avg("quality").alias("average_score")
    )


@query
def k09_average_delivery_time(s, d):
    return questions.average_delivery_time(f_shipments(s, d), f_orders(s, d))


@query
def k10_late_delivery_rate(s, d):
    return questions.late_delivery_rate(f_shipments(s, d), star.dim_carrier(carriers(s, d)))


@query
def k11_orders_without_shipments(s, d):
    return questions.orders_without_shipments(f_orders(s, d), heads(s, d))


@query
def k12_delivered_but_cancelled(s, d):
    return questions.delivered_but_cancelled(f_orders(s, d), f_shipments(s, d))


@query
def k13_repeat_customers(s, d):
    return questions.repeat_customers(f_orders(s, d))


@query
def k14_sales_by_city_state(s, d):
    return questions.sales_by_city_state(f_orders(s, d), star.dim_customer(customers(s, d)))


_STAR = {
    "dim_customer": lambda s, d: star.dim_customer(customers(s, d)),
    "dim_product": lambda s, d: star.dim_product(products(s, d)),
    "dim_carrier": lambda s, d: star.dim_carrier(carriers(s, d)),
    "fact_orders": f_orders,
    "fact_order_items": items,
    "fact_payments": lambda s, d: star.fact_payments(payments(s, d), orders(s, d)),
    "fact_customer_events": events,
    "fact_shipments": f_shipments,
    "fact_product_reviews": lambda s, d: star.fact_product_reviews(reviews(s, d)),
}


def _view_query(view: str) -> Query:
    def run(s, d):
        used = {name: table(s, d) for name, table in _STAR.items() if name in views.VIEWS[view]}
        return views.analytics_views(s, used, [view])[view]

    run.__name__ = f"k15_{view}"
    return run


# The view each SQL form belongs to, and the query that must give the same rows.
VIEW_OF = {
    "v_daily_sales": "k01_daily_sales",
    "v_monthly_sales": "k01_monthly_sales",
    "v_revenue_by_category": "k02_revenue_by_category",
    "v_average_order_value": "k03_average_order_value",
    "v_payment_success_rate": "k04_payment_success_rate",
    "v_purchase_frequency": "k05_purchase_frequency",
    "v_view_to_purchase": "k06_view_to_purchase",
    "v_cart_abandonment": "k07_cart_abandonment",
    "v_average_review_score": "k08_average_review_score",
    "v_average_delivery_time": "k09_average_delivery_time",
    "v_late_delivery_rate": "k10_late_delivery_rate",
    "v_orders_without_shipments": "k11_orders_without_shipments",
    "v_delivered_but_cancelled": "k12_delivered_but_cancelled",
    "v_repeat_customers": "k13_repeat_customers",
    "v_sales_by_city_state": "k14_sales_by_city_state",
}

for _view in VIEW_OF:
    query(_view_query(_view))


# L. Incremental file processing


def _stream_reviews(s, d, root, runs):
    """Land reviews in batches, running the cleaning stream after each one."""
    rows = seeds.with_batches(reviews(s, d), "customer_id", runs)
    raw = layers.table_path(root, "raw", "mongodb", "product_reviews")
    out = layers.table_path(root, "processed", "mongodb", "product_reviews")
    for n in range(1, runs + 1):
        batch = rows.filter(F.col("batch_id") == f"20260101_000000_{n}")
        layers.land(batch, root, "mongodb", "product_reviews")
        incremental.stream_processed(
            s, raw, out, f"{root}/checkpoints/process", rows.schema, cleaning.clean_reviews
        ).awaitTermination()
    return out


@query
def l01_stream_processed(s, d):
    out = _stream_reviews(s, d, shared_dir(s, "stream"), 2)
    return s.read.parquet(out).select("batch_id", "review_id", "rating", "created_at", "review_text")


@query
def l02_stream_merge(s, d):
    root = shared_dir(s, "stream")
    schema = items(s, d).schema
    rows = seeds.with_batches(items(s, d), "product_id", 2)
    processed = layers.table_path(root, "processed", "postgres", "order_items")
    for n in (1, 2):
        layers.land(
            rows.filter(F.col("batch_id") == f"20260101_000000_{n}"), root, "postgres",
            "order_items", layer="processed",
        )
        incremental.stream_merge(
            s, processed, root, f"{root}/checkpoints/merge", schema, "order_items", "postgres",
            ["order_item_id"], jobs.runs_path(root),
        ).awaitTermination()
    tagged = T.StructType(schema.fields + [T.StructField("batch_id", T.StringType())])
    return merge.read_table(s, root, "order_items", tagged).drop(
        "load_id", "batch_id"
    )


@query
def l02_late_files(s, d):
    """A batch arrives in two files with a load in between; every file is loaded once."""
    root = shared_dir(s, "stream")
    schema = items(s, d).schema
    processed = layers.table_path(root, "processed", "postgres", "order_items")

    def stream():
        incremental.stream_merge(
            s, processed, root, f"{root}/checkpoints/merge", schema, "order_items", "postgres",
            ["order_item_id"], jobs.runs_path(root),
        ).awaitTermination()

    for rest in (0, 1):
        late = items(s, d).filter(F.col("product_id") % 2 == rest)
        late.write.mode("append").parquet(f"{processed}/batch_id=20260101_000000_1")
        stream()
    stream()
    table = merge.read_table(s, root, "order_items", layers.with_batch(schema))
    return table.drop("load_id", "batch_id")


@query
def l03_rerun_safety(s, d):
    """All nine datasets, run twice: no table has changed rows or rows of a second batch."""
    root = shared_dir(s, "rerun")
    inputs = seeds.source_tables(s, d)
    jobs.run(s, root, inputs, workers=4)
    jobs.run(s, root, inputs, workers=4)
    out = None
    for name in inputs:
        one = jobs.warehouse_table(s, root, name).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"),
            F.count_distinct("batch_id").alias("batches"),
        )
        out = one if out is None else out.unionByName(one)
    return out
