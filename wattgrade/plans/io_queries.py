"""Queries that write to the shared folder and read back: sources, sinks and streams."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattgrade.plans.mapping import CLASS_FIELDS, CLASSED, DIAG, ROLES, diagnostics, from_lines, table
from wattgrade.plans.medallion import class_silver, dataset_rows
from wattgrade.plans.clean_queries import class_rows
from wattgrade.plans.registry import query
from wattgrade.session import work_path
from wattgrade.sources import messages, readers, records, versions, writers
from wattgrade.streaming import accounts, ingest


def _customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


_CUSTOMERS_SQL = "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer"


@query("page_flatten", _CUSTOMERS_SQL)
def page_flatten(spark, sf_dir):
    """Rows gathered into pages of 1,000 and flattened again."""
    return readers.flatten_pages(writers.page_up(_customers(spark, sf_dir)))


@query("roundtrip_json_doc", _CUSTOMERS_SQL)
def roundtrip_json_doc(spark, sf_dir):
    """Each page is one document file whose root is an array."""
    customers = _customers(spark, sf_dir)
    path = work_path(spark, "json-documents")
    pages = writers.page_up(customers).select(F.to_json("results").alias("value"))
    pages.write.option("maxRecordsPerFile", 1).text(path)
    return readers.read_json_documents(spark, path, customers.schema)


@query("json_pages", _CUSTOMERS_SQL)
def json_pages(spark, sf_dir):
    """Stored pages with a ``results`` array, one per line, flattened on reading."""
    customers = _customers(spark, sf_dir)
    path = work_path(spark, "json-pages")
    writers.write_json_lines(writers.page_up(customers), path, per_file=10)
    schema = T.StructType([T.StructField("results", T.ArrayType(customers.schema))])
    return readers.flatten_pages(readers.read_json_lines(spark, path, schema))


@query("roundtrip_ndjson", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders")
def roundtrip_ndjson(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").drop("o_orderdate")
    path = work_path(spark, "json-lines")
    writers.write_json_lines(orders, path)
    return readers.read_json_lines(spark, path, orders.schema)


@query(
    "dated_ndjson",
    "select event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d') as date "
    "from events where strftime(ts, '%Y-%m-%d') = '2024-01-15'",
)
def dated_ndjson(spark, sf_dir):
    """Events in one directory per day; reading one day opens only its directory."""
    events = table(spark, sf_dir, "events")
    dated = events.select(
        "event_id", "user_id", "event_type", "value", F.col("ts").cast("date").cast("string").alias("date")
    )
    path = work_path(spark, "dated-lines")
    writers.write_json_lines(dated.hint("rebalance", "date"), path, by=["date"])
    return readers.read_dated_lines(spark, path, dated.drop("date").schema, "2024-01-15")


@query(
    "roundtrip_csv",
    "select cast(c_custkey as varchar) as c_custkey, c_name, cast(c_nationkey as varchar) as c_nationkey, "
    "c_mktsegment from customer",
)
def roundtrip_csv(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    path = work_path(spark, "delimited")
    writers.write_delimited(customers, path)
    return readers.read_delimited(spark, path, customers.columns)


@query("roundtrip_partitioned", f"with {CLASSED} select diag_id, intensity, surface, grade from classed")
def roundtrip_partitioned(spark, sf_dir):
    rows = class_rows(spark, sf_dir).select("diag_id", "intensity", "surface", "grade")
    path = work_path(spark, "by-grade")
    writers.overwrite_partitions(rows, path, ["grade"])
    return readers.read_dataset(spark, path, rows.schema)


@query(
    "partition_overwrite",
    f"""with {DIAG} select diag_id, intensity, grade from diag where grade <> 'A'
        union all select diag_id, -intensity, grade from diag where grade = 'A'""",
)
def partition_overwrite(spark, sf_dir):
    """A second write with grade A only leaves the other grades alone."""
    rows = diagnostics(spark, sf_dir, "diag_id", "intensity", "grade")
    path = work_path(spark, "by-grade")
    writers.overwrite_partitions(rows, path, ["grade"])
    again = rows.where(F.col("grade") == "A").withColumn("intensity", -F.col("intensity"))
    writers.overwrite_partitions(again, path, ["grade"])
    return readers.read_dataset(spark, path, rows.schema)


@query(
    "silver_rerun",
    f"with {DIAG} select diag_id, intensity, case when grade = 'G' then 'F' else grade end as grade from diag",
)
def silver_rerun(spark, sf_dir):
    """A full recompute in which no row keeps grade G leaves no partition of the first run behind."""
    rows = diagnostics(spark, sf_dir, "diag_id", "intensity", "grade")
    path = work_path(spark, "rerun")
    writers.replace_partitioned(rows, path, ["grade"])
    moved = F.when(F.col("grade") == "G", "F").otherwise(F.col("grade"))
    writers.replace_partitioned(rows.withColumn("grade", moved), path, ["grade"])
    return readers.read_dataset(spark, path, rows.schema)


@query(
    "silver_switch",
    f"""with {DIAG} select diag_id, intensity, grade, step from diag
        cross join (values ('first'), ('failed'), ('kept')) as steps(step)
        union all select diag_id, -intensity, grade, 'second' from diag where grade <> 'G'""",
)
def silver_switch(spark, sf_dir):
    """What readers see: after the first write, after one that fails on its way, after a second one, and what the
    reader of the first still holds then."""
    rows = diagnostics(spark, sf_dir, "diag_id", "intensity", "grade")
    path = work_path(spark, "switched")
    seen = lambda step: versions.read_current(spark, path, rows.schema).withColumn("step", F.lit(step))
    versions.publish(rows, path, ["grade"])
    first, kept = seen("first"), seen("kept")
    try:
        broken = F.when(F.col("grade") == "G", F.raise_error(F.lit("broken off")).cast("double")).otherwise(0.0)
        versions.publish(rows.withColumn("intensity", broken), path, ["grade"])
    except PySparkException as e:
        if "broken off" not in str(e):
            raise
    failed = seen("failed")
    versions.publish(rows.where("grade <> 'G'").withColumn("intensity", -F.col("intensity")), path, ["grade"])
    return first.unionByName(failed).unionByName(seen("second")).unionByName(kept)


@query("partition_pruning", f"with {DIAG} select diag_id, grade from diag where grade = 'C'")
def partition_pruning(spark, sf_dir):
    rows = diagnostics(spark, sf_dir, "diag_id", "grade")
    path = work_path(spark, "by-grade")
    writers.overwrite_partitions(rows, path, ["grade"])
    return readers.read_dataset(spark, path, rows.schema).where(F.col("grade") == "C")


@query("overwrite_rebalance", "select o_orderkey, o_custkey, o_totalprice from orders")
def overwrite_rebalance(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    path = work_path(spark, "balanced")
    writers.overwrite_balanced(orders, path, files=10)
    writers.overwrite_balanced(orders, path)
    return readers.read_dataset(spark, path, orders.schema)


@query(
    "csv_extract",
    "select cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as varchar) as o_custkey, o_orderstatus "
    "from orders order by orders.o_orderkey limit 10",
)
def csv_extract(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    path = work_path(spark, "extract")
    writers.write_extract(orders, path, ["o_orderkey"])
    return readers.read_delimited(spark, path, orders.columns, sep=",")


@query(
    "message_encode",
    """select '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' as value
       from events""",
)
def message_encode(spark, sf_dir):
    return messages.encode_rows(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type"))


@query("message_roundtrip", "select event_id, user_id, event_type, value, props from events")
def message_roundtrip(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props")
    sent = messages.encode_rows(events).select(F.encode("value", "UTF-8").alias("value"))
    return messages.decode_rows(sent, events.schema)


@query(
    "message_corrupt",
    """select case when event_type = 'error' then null else event_id end as event_id,
              case when event_type = 'error' then '{"event_id":' || event_id end as bad from events""",
)
def message_corrupt(spark, sf_dir):
    """Messages of error events are cut short; they stay as rows with their text."""
    events = table(spark, sf_dir, "events")
    cut = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"))
    body = F.when(F.col("event_type") == "error", cut).otherwise(F.concat(cut, F.lit("}")))
    schema = T.StructType([T.StructField("event_id", T.LongType())])
    return messages.decode_rows(events.select(body.alias("value")), schema, "bad")


@query(
    "merge_schema_read",
    """select c_custkey as code, c_name as name, cast(null as double) as balance from customer
       union all select s_suppkey, s_name, s_acctbal from supplier""",
)
def merge_schema_read(spark, sf_dir):
    """Two writes with different columns under one prefix; a prefix without files adds nothing."""
    path = work_path(spark, "merged")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("code"), F.col("c_name").alias("name"))
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("code"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )
    writers.overwrite(customers, f"{path}/first")
    writers.overwrite(suppliers, f"{path}/second")
    found = readers.read_merged(spark, path, suppliers.schema)
    return readers.concat_by_name([found, readers.read_merged(spark, f"{path}-absent", suppliers.schema)])


@query(
    "first_k_files",
    """select o_orderkey, o_custkey, o_orderpriority from orders where o_orderpriority in
       (select o_orderpriority from orders group by o_orderpriority order by o_orderpriority limit 3)""",
)
def first_k_files(spark, sf_dir):
    """Orders in one directory per priority; the first three files in path order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    path = work_path(spark, "files")
    writers.overwrite_partitions(orders, path, ["o_orderpriority"])
    return readers.read_first_files(spark, path, orders.schema, n=3)


@query("file_manifest", "select 'lineitem.parquet' as file_name, count(*) as n_rows from lineitem")
def file_manifest(spark, sf_dir):
    return readers.file_rows(table(spark, sf_dir, "lineitem"))


@query(
    "list_files",
    """select 'orders/' || o_orderpriority as directory, count(*) > 0 as has_rows, true as has_bytes
       from orders group by o_orderpriority""",
)
def list_files(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = work_path(spark, "listed")
    by_name = orders.withColumn("priority", F.col("o_orderpriority"))
    writers.overwrite_partitions(by_name, path, ["priority"])
    files = readers.list_files(spark, path)
    directory = F.concat(F.lit("orders/"), F.url_decode(F.regexp_extract("path", "priority=([^/]*)/", 1)))
    return files.groupBy(directory.alias("directory")).agg(
        (F.count("*") > 0).alias("has_rows"), (F.sum("length") > 0).alias("has_bytes")
    )


_EVENTS_SQL = "select event_id, user_id, event_type, value, props from events"
_EVENT_FIELDS = ("event_id", "user_id", "event_type", "value", "props")


def _table_stream(spark, sf_dir, name):
    """A table as a feed. The path is a pattern because the source takes a plain path for a directory only."""
    path = f"{sf_dir}/{name}.parque[t]"
    return ingest.file_feed(spark, path, table(spark, sf_dir, name).schema, files_per_trigger=1000)


@query("stream_bronze", _EVENTS_SQL)
def stream_bronze(spark, sf_dir):
    """Events as messages, decoded and landed as JSON lines until the feed is used up."""
    path, checkpoint = work_path(spark, "bronze"), work_path(spark, "bronze-checkpoint")
    events = _table_stream(spark, sf_dir, "events").select(*_EVENT_FIELDS)
    decoded = messages.decode_rows(messages.encode_rows(events), events.schema)
    ingest.run_to_end(ingest.land(decoded, path, checkpoint))
    return readers.read_json_lines(spark, path, events.schema)


@query(
    "stream_encode",
    """select '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' as value
       from events""",
)
def stream_encode(spark, sf_dir):
    """A feed turned into messages, landed as text instead of a topic."""
    path, checkpoint = work_path(spark, "messages"), work_path(spark, "messages-checkpoint")
    events = _table_stream(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    ingest.run_to_end(ingest.land(messages.encode_rows(events), path, checkpoint, fmt="text"))
    return spark.read.schema("value string").text(path)


@query("stream_numbered", _EVENTS_SQL)
def stream_numbered(spark, sf_dir):
    """Numbered micro-batch directories with at most 1,000 records per file."""
    base, checkpoint = work_path(spark, "numbered"), work_path(spark, "numbered-checkpoint")
    events = _table_stream(spark, sf_dir, "events").select(*_EVENT_FIELDS)
    ingest.run_to_end(ingest.land_numbered(events, base, checkpoint, per_file=1000))
    return readers.read_json_lines(spark, base, events.schema, nested=True)


@query(
    "stream_silver",
    f"""with {DIAG} select diag_id, intensity, surface, grade, cast(strpos('ABCDEFG', grade) as int) as grade_ord
        from diag where intensity between 0 and 2000 and surface between 9 and 1000""",
)
def stream_silver(spark, sf_dir):
    """The stateless clean on a stream of line items, landed by grade."""
    path, checkpoint = work_path(spark, "silver"), work_path(spark, "silver-checkpoint")
    lines = from_lines(_table_stream(spark, sf_dir, "lineitem"))
    silver = ingest.silver_stream(lines.select(*CLASS_FIELDS), ROLES)
    silver = silver.select("diag_id", "intensity", "surface", "grade_ord", "grade")
    ingest.run_to_end(ingest.land(silver, path, checkpoint, fmt="parquet", by=["grade"]))
    return readers.read_dataset(spark, path, silver.schema).select(
        "diag_id", "intensity", "surface", "grade", "grade_ord"
    )


@query("stream_dedupe", _EVENTS_SQL)
def stream_dedupe(spark, sf_dir):
    """Every event delivered twice; each key comes out once."""
    path, checkpoint = work_path(spark, "deduped"), work_path(spark, "deduped-checkpoint")
    twice = _table_stream(spark, sf_dir, "events").union(_table_stream(spark, sf_dir, "events"))
    once = ingest.first_seen(twice, ["event_id"], "ts", "60 days", salts=8).select(*_EVENT_FIELDS)
    ingest.run_to_end(ingest.land(once, path, checkpoint, fmt="parquet"))
    return readers.read_dataset(spark, path, once.schema)


@query("stream_restart", _EVENTS_SQL)
def stream_restart(spark, sf_dir):
    """Two deliveries, a restart for the second and one without news: every event lands once."""
    feed, path, checkpoint = (work_path(spark, f"restart-{part}") for part in ("feed", "bronze", "checkpoint"))
    events = table(spark, sf_dir, "events").select(*_EVENT_FIELDS)
    for part in (0, 1, None):
        if part is not None:
            events.where(F.col("event_id") % 2 == part).write.mode("append").parquet(feed)
        stream = ingest.file_feed(spark, feed, events.schema)
        ingest.run_to_end(ingest.land(stream, path, checkpoint, fmt="parquet"))
    return readers.read_dataset(spark, path, events.schema)


@query(
    "stream_late",
    """select event_id, false as late from events
       union all select cast(-1 as bigint), false
       union all select event_id + 1000000000, true from events where event_id % 10 = 0""",
)
def stream_late(spark, sf_dir):
    """Events delivered twice, then one from a later month, then new ones from before: first ones and late ones.

    The stream is stopped and started between the deliveries; state and watermark come from the checkpoint.
    """
    feed, path, checkpoint = (work_path(spark, f"late-{part}") for part in ("feed", "out", "checkpoint"))
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    later = events.agg(F.lit(-1).cast("long").alias("event_id"), (F.max("ts") + F.expr("interval 30 days")).alias("ts"))
    behind = events.where("event_id % 10 = 0").withColumn("event_id", F.col("event_id") + 1000000000)
    for delivery in (events.union(events), later, behind):
        delivery.write.mode("append").parquet(feed)
        stream = ingest.file_feed(spark, feed, events.schema)
        told = accounts.first_seen_and_late(stream, ["event_id"], "ts", delay_seconds=3600)
        ingest.run_to_end(ingest.land(told, path, checkpoint, fmt="parquet", by=["late"]))
    return readers.read_dataset(spark, path).select("event_id", F.col("late").cast("boolean").alias("late"))


# Raw records of all kinds ---------------------------------------------------------------------------------------------

_ACCENTED = {
    "diag_id": "N°DPE",
    "received_at": "Date_réception_DPE",
    "grade": "Etiquette_DPE",
    "total": "Conso_5_usages_é_finale",
    "intensity": "Conso_5_usages_par_m²_é_finale",
    "surface": "Surface_habitable_logement",
}
_SNAKE = {
    "diag_id": "numero_dpe",
    "received_at": "date_reception_dpe",
    "grade": "etiquette_dpe",
    "total": "conso_5_usages_ef",
    "intensity": "conso_5_usages_par_m2_ef",
    "surface": "surface_habitable_logement",
}


def _mixed_records(spark, sf_dir):
    """Line items as records of both layouts, bare, enveloped and in enveloped pairs, with broken lines between them."""
    rows = from_lines(table(spark, sf_dir, "lineitem"))

    def record(names, **more):
        fields = [F.col(c).alias(name) for c, name in names.items()]
        return F.struct(*fields, F.lit(None).cast("string").alias("vide"), *[v.alias(c) for c, v in more.items()])

    def text(*columns):
        return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})

    kind = F.col("l_orderkey") % 4
    line = (
        F.when(kind == 0, F.to_json(record(_ACCENTED), {"ignoreNullFields": "false"}))
        .when(kind == 1, F.to_json(record(_SNAKE, note=F.concat(F.lit("n"), "insulation")), {"ignoreNullFields": "false"}))
        .when(kind == 2, text(F.lit("batch").alias("source_file"), record(_SNAKE).alias("data")))
        .otherwise(text(F.array(record(_ACCENTED), record(_ACCENTED)).alias("data")))
    )
    broken = rows.where("l_orderkey % 50 = 0").select(F.explode(F.array(F.lit("{"), F.lit(""), F.lit("17"))))
    path = work_path(spark, "mixed-records")
    writers.write_lines(rows.select(line.alias("value")).union(broken), path)
    return records.read_records(spark, path)


_LINES_SQL = """
  select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as diag_id,
         strftime(l_shipdate, '%Y-%m-%d') as received_at, l_extendedprice / l_quantity / 10 as intensity,
         l_extendedprice / 10 as total, l_quantity as surface, l_returnflag, l_orderkey % 4 as kind
  from lineitem"""
_GRADE_SQL = """case when intensity < 65 then 'A' when intensity < 115 then 'B' when intensity < 190 then 'C'
              when intensity < 280 then 'D' when intensity < 390 then 'E' when intensity < 525 then 'F' else 'G' end"""


@query(
    "dataset_open",
    f"""with lines as ({_LINES_SQL})
        select distinct
               case when kind in (0, 3) then diag_id end as "N°DPE",
               case when kind in (1, 2) then diag_id end as numero_dpe,
               case when kind in (0, 3) then received_at end as "Date_réception_DPE",
               case when kind in (1, 2) then received_at end as date_reception_dpe,
               {_GRADE_SQL} as "Etiquette_DPE",
               case when kind in (0, 3) then total end as "Conso_5_usages_é_finale",
               case when kind in (1, 2) then total end as conso_5_usages_ef,
               case when kind in (0, 3) then intensity end as "Conso_5_usages_par_m²_é_finale",
               case when kind in (1, 2) then intensity end as conso_5_usages_par_m2_ef,
               surface as "Surface_habitable_logement",
               case when kind = 1 then 'n' || l_returnflag end as note
        from lines""",
)
def dataset_open(spark, sf_dir):
    """Every filled column of records of both layouts, bare and enveloped side by side; repeated rows once."""
    return dataset_rows(_mixed_records(spark, sf_dir))


@query(
    "class_open",
    f"""with {CLASSED} select diag_id as "N_DPE", received_at as "Date_reception_DPE", grade as "Etiquette_DPE",
        grade_ord as "Etiquette_DPE_num", intensity as "Conso_5_usages_par_m2_e_finale",
        total as "Conso_5_usages_e_finale", surface as "Surface_habitable_logement" from classed""",
)
def class_open(spark, sf_dir):
    """Class silver of the same records, each layout brought to the common names record by record."""
    return class_silver(records.to_columns(_mixed_records(spark, sf_dir))).drop("_silver_timestamp")


@query(
    "rejected_lines",
    """with counts as (
         select count(*) as n_lines, cast(sum(case o_orderkey % 7 when 3 then 2 when 4 then 1 when 5 then 1 when 6 then 1
                                               else 0 end) as bigint) as n_records,
                cast(sum(case when o_orderkey % 7 < 3 then 1 else 0 end) as bigint) as n_rejected
         from orders)
       select case when o_orderkey % 7 = 0 then 'malformed' else 'no record' end as reason,
              case o_orderkey % 7 when 0 then '{"o_orderkey": ' || o_orderkey when 1 then cast(o_orderkey as varchar)
                                  else '"' || o_orderkey || '"' end as text,
              n_lines, n_records, n_rejected
       from orders, counts where o_orderkey % 7 < 3""",
)
def rejected_lines(spark, sf_dir):
    """Orders as lines, three kinds of which hold no record; each with the counts of the one pass that read them."""
    key, kind = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 7
    record = F.to_json(F.struct("o_orderkey", "o_totalprice"))
    line = (
        F.when(kind == 0, F.concat(F.lit('{"o_orderkey": '), key))
        .when(kind == 1, key)
        .when(kind == 2, F.concat(F.lit('["'), key, F.lit('"]')))
        .when(kind == 3, F.concat(F.lit("["), record, F.lit(","), record, F.lit("]")))
        .otherwise(record)
    )
    path = work_path(spark, "orders-as-lines")
    table(spark, sf_dir, "orders").select(line.alias("value")).write.text(path)
    found = records.read_records(spark, path)
    counts = [F.lit(n).cast("long").alias(c) for c, n in found.counts.items()]
    return found.rejected.select("reason", "text", *counts)
