"""Registered queries: scans, sinks, projections, cleaning jobs.

Sink queries write into the shared folder (``spark.checkpoint.dir``) and
return what they read back, so the check covers the write->read round trip.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gearbox.operators.clean import (
    cast_target,
    drop_any_null,
    drop_target_null,
    missing_rows,
    select_ci,
)
from gearbox.operators.layout import (
    contiguous_split_by_file,
    contiguous_split_by_key,
    keyed_split,
    rebalance_by_size,
    steady_file_blocks,
    union_parts,
)
from gearbox.plans.jobs import (
    clean_part_job,
    clean_quarantine_job,
    csv_to_parquet_job,
    load_and_repartition,
    merge_parts_job,
    quarantine_job,
)
from gearbox.operators.ordering import partitions_for_rows
from gearbox.plans.registry import NOT_NULL_RAW, register, sql
from gearbox.schema import LISTINGS, LISTINGS_RAW
from gearbox.session import scratch_path, sf_path
from gearbox.sinks.writers import write_csv, write_parquet
from gearbox.sources.fixtures import listings, listings_raw, listings_table, table
from gearbox.streaming.parts import clean_parts_stream, read_stream_output
from gearbox.sources.infer import column_types, merged_types
from gearbox.sources.quoted_csv import read_quoted_csv
from gearbox.sources.readers import (
    footer_profile,
    read_csv,
    read_existing_parquet,
    read_first_available,
    read_parquet,
    read_part,
    schema_profile,
    sql_view_scan,
)

ORDERS_PARTS_SQL = "(select *, cast(ntile(3) over (order by o_orderkey) as integer) as part from orders)"
RAW_ROW_BYTES = 128  # a raw listing in a shuffle, or as CSV
MISSING_PRICE = "(price is null or trim(price) = '')"


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders")


def _orders_parts(spark, sf_dir):
    """Orders cut into 3 contiguous parts by order key (part 1..3)."""
    return contiguous_split_by_key(_orders(spark, sf_dir), "o_orderkey", 3)


def _orders_csv_schema(spark, sf_dir):
    return _orders(spark, sf_dir).schema


# --------------------------------------------------------------------------- scans
@register("parquet_scan", ("S1",), sql("select * from lineitem"))
def q_parquet_scan(spark, sf_dir):
    return read_parquet(spark, sf_path(sf_dir, "lineitem"))


@register("part_scan", ("S2", "W1", "K4"), sql(f"select * from {ORDERS_PARTS_SQL} where part = 2"))
def q_part_scan(spark, sf_dir):
    path = write_parquet(_orders_parts(spark, sf_dir), scratch_path(spark, "orders_parts"), partition_by=["part"])
    return read_part(spark, path, 2)


@register("file_order_split", ("W1", "S4"), sql("""
select o.*, p.part from orders o
join (select o_orderkey, cast(ntile(3) over (order by o_custkey, o_orderkey) as integer) as part from orders) p using (o_orderkey)"""))
def q_file_order_split(spark, sf_dir):
    """CSV files whose order is (o_custkey, o_orderkey), cut into 3 parts in file order: the parts
    of that order, found without moving a row of the files."""
    path = write_csv(_orders(spark, sf_dir).orderBy("o_custkey", "o_orderkey"), scratch_path(spark, "orders_in_order"))
    with steady_file_blocks(spark):
        parts = contiguous_split_by_file(read_csv(spark, path, schema=_orders_csv_schema(spark, sf_dir)), 3)
        cut = write_parquet(parts, scratch_path(spark, "orders_cut"), partition_by=["part"])
    return spark.read.parquet(cut)


@register("footer_profile", ("A1", "P8"), sql(" union all ".join(
    f"""select '{c}' as column_name, count({c}) as non_null, {f'cast(min({c}) as double)' if number else 'null'} as min_value,
  {f'cast(max({c}) as double)' if number else 'null'} as max_value from lineitem"""
    for c, number in (("l_orderkey", True), ("l_partkey", True), ("l_quantity", True), ("l_extendedprice", True),
                      ("l_returnflag", False), ("l_shipdate", False)))))
def q_footer_profile(spark, sf_dir):
    """Counts and ranges from the file footers alone."""
    wanted = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"]
    return footer_profile(spark, sf_path(sf_dir, "lineitem"), wanted)


@register("rebalance_by_size", ("L2", "K1"), sql("select * from orders"))
def q_rebalance_by_size(spark, sf_dir):
    """Rows of a status (three values, two of them with nearly all rows) written together, hot ones split."""
    path = write_parquet(rebalance_by_size(_orders(spark, sf_dir), "o_orderstatus"), scratch_path(spark, "orders_rebalanced"))
    return spark.read.parquet(path)


@register("multi_path_union", ("S3", "U2"), sql("select * from orders"))
def q_multi_path_union(spark, sf_dir):
    base = write_parquet(_orders_parts(spark, sf_dir), scratch_path(spark, "processed"), partition_by=["part"])
    return read_existing_parquet(spark, [f"{base}/part={p}" for p in (1, 2, 3, 4)])


@register("csv_typed_roundtrip", ("S4", "K6"), sql("select * from listings", "listings"))
def q_csv_typed_roundtrip(spark, sf_dir):
    # as plain text it takes six times the table's own space, beside it
    path = write_csv(listings_table(spark, sf_dir), scratch_path(spark, "listings_csv"), compression="snappy")
    return read_csv(spark, path, schema=LISTINGS)


@register("csv_string_roundtrip", ("S5",), sql("""
select listing_id, cast(slot as varchar) as slot, price, cast(mileage as varchar) as mileage,
       seller_type, make, transmission
from listings_raw""", "listings", "listings_raw"))
def q_csv_string_roundtrip(spark, sf_dir):
    path = write_csv(listings_raw(spark, sf_dir), scratch_path(spark, "raw_csv"))
    return read_csv(spark, path)


@register("csv_null_tokens", ("S10", "S4"), sql("""
select listing_id, slot, case when price in ('n/a', 'NA', 'None') then null else price end as price,
       mileage, seller_type, make, transmission
from listings_raw""", "listings", "listings_raw"))
def q_csv_null_tokens(spark, sf_dir):
    path = write_csv(listings_raw(spark, sf_dir), scratch_path(spark, "raw_tokens_csv"))
    return read_csv(spark, path, schema=LISTINGS_RAW, null_tokens=["n/a", "NA", "None"])


@register("csv_quoted_breaks", ("S10", "S4", "K6"), sql("select doc_id, text, lang, source, n_chars from documents"))
def q_csv_quoted_breaks(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    path = write_csv(docs, scratch_path(spark, "quoted_breaks_csv"))
    with steady_file_blocks(spark):
        return read_quoted_csv(spark, path, docs.schema)


@register("schema_inspection", ("P8", "A1"), sql("""
with d as (select cast(row_number() over () as integer) as position, column_name,
                  case column_type when 'BIGINT' then 'bigint' when 'INTEGER' then 'int'
                                   when 'DOUBLE' then 'double' when 'VARCHAR' then 'string'
                                   when 'TIMESTAMP' then 'timestamp_ntz' else lower(column_type) end as data_type,
                  "null" = 'YES' as nullable
           from (describe select * from lineitem)),
c as (unpivot (select count(columns(*)) from lineitem) on columns(*) into name column_name value non_null)
select d.position, d.column_name, d.data_type, d.nullable, c.non_null
from d join c on c.column_name = d.column_name"""))
def q_schema_inspection(spark, sf_dir):
    return schema_profile(read_parquet(spark, sf_path(sf_dir, "lineitem")))


@register("first_available_source", ("S6", "S7"), sql("select * from orders"))
def q_first_available_source(spark, sf_dir):
    base = scratch_path(spark, "first_available")
    csv_path = write_csv(_orders(spark, sf_dir), f"{base}/combined.csv")
    return read_first_available(spark, f"{base}/combined.parquet", csv_path,
                                csv_schema=_orders_csv_schema(spark, sf_dir))


@register("sql_view_scan", ("S8",), sql("select * from orders"))
def q_sql_view_scan(spark, sf_dir):
    return sql_view_scan(_orders(spark, sf_dir), "combined")


@register("prepared_table", ("S1", "P1", "P2", "P7", "X5"), sql("select * from listings", "listings"))
def q_prepared_table(spark, sf_dir):
    """The prepared listing table, derived from the raw tables by joins (not
    the materialised copy): what every other listing query reads."""
    return listings(spark, sf_dir)


# --------------------------------------------------------------------------- sinks
@register("parquet_sink", ("K1",), sql("select * from listings", "listings"))
def q_parquet_sink(spark, sf_dir):
    return spark.read.parquet(write_parquet(listings_table(spark, sf_dir), scratch_path(spark, "listings_parquet")))


@register("partitioned_sink", ("K4", "W1"), sql(f"select * from {ORDERS_PARTS_SQL}"))
def q_partitioned_sink(spark, sf_dir):
    path = write_csv(_orders_parts(spark, sf_dir), scratch_path(spark, "orders_part_csv"), partition_by=["part"])
    schema = T.StructType(_orders_csv_schema(spark, sf_dir).fields + [T.StructField("part", T.IntegerType())])
    return read_csv(spark, path, schema=schema)


@register("union_csv_sink", ("K6", "U1"), sql("select * from orders"))
def q_union_csv_sink(spark, sf_dir):
    schema = _orders_csv_schema(spark, sf_dir)
    base = scratch_path(spark, "parts_csv")
    written = write_csv(_orders_parts(spark, sf_dir), f"{base}/parts", partition_by=["part"])
    merged = union_parts([read_csv(spark, f"{written}/part={p}", schema=schema) for p in (1, 2, 3)])
    return read_csv(spark, write_csv(merged, f"{base}/combined.csv"), schema=schema)


@register("csv_to_parquet_job", ("K8", "S4", "K1"), sql("select * from listings", "listings"))
def q_csv_to_parquet_job(spark, sf_dir):
    base = scratch_path(spark, "csv_to_parquet")
    csv_path = write_csv(listings_table(spark, sf_dir), f"{base}/combined.csv")
    return csv_to_parquet_job(spark, csv_path, f"{base}/combined.parquet", schema=LISTINGS)


@register("repartition_job", ("S8", "L1", "K1"), sql("select * from orders"))
def q_repartition_job(spark, sf_dir):
    base = scratch_path(spark, "repartition_job")
    return load_and_repartition(spark, sf_path(sf_dir, "orders"), f"{base}/repartitioned.parquet", 4)


# --------------------------------------------------------------------------- projections
@register("project_alias", ("P1", "P7"), sql("""
select listing_id, price as target, year, mileage from listings""", "listings"))
def q_project_alias(spark, sf_dir):
    return listings_table(spark, sf_dir).select("listing_id", F.col("price").alias("target"), "year", "mileage")


@register("cast_target", ("P3", "X3"), sql("""
select listing_id, slot, try_cast(price as double) as price, mileage, seller_type, make, transmission
from listings_raw""", "listings", "listings_raw"))
def q_cast_target(spark, sf_dir):
    return cast_target(listings_raw(spark, sf_dir))


@register("rename_drop", ("P4", "P5", "P2"), sql("""
select * exclude (slot, price), price as label from listings""", "listings"))
def q_rename_drop(spark, sf_dir):
    return listings_table(spark, sf_dir).withColumnRenamed("price", "label").drop("slot")


@register("resolve_column", ("P6", "X6", "F1"), sql(f"""
select listing_id, price as "PRICE" from listings_raw where {MISSING_PRICE}""", "listings", "listings_raw"))
def q_resolve_column(spark, sf_dir):
    upper = listings_raw(spark, sf_dir).withColumnRenamed("price", "PRICE")
    return select_ci(missing_rows(upper, "price"), "listing_id", "price")


# --------------------------------------------------------------------------- cleaning
@register("missing_price", ("F1", "X1", "X2"), sql(f"""
select * from listings_raw where {MISSING_PRICE}""", "listings", "listings_raw"))
def q_missing_price(spark, sf_dir):
    return missing_rows(listings_raw(spark, sf_dir))


@register("drop_any_null", ("F2",), sql(f"""
select * from listings_raw where {NOT_NULL_RAW}""", "listings", "listings_raw"))
def q_drop_any_null(spark, sf_dir):
    return drop_any_null(listings_raw(spark, sf_dir))


@register("drop_target_null", ("P3", "F3"), sql("""
select listing_id, slot, try_cast(price as double) as price, mileage, seller_type, make, transmission
from listings_raw where try_cast(price as double) is not null""", "listings", "listings_raw"))
def q_drop_target_null(spark, sf_dir):
    return drop_target_null(cast_target(listings_raw(spark, sf_dir)))


@register("quarantine_job", ("F4", "S6", "K5", "K6"), sql(f"""
select * from listings_raw where {MISSING_PRICE}""", "listings", "listings_raw"))
def q_quarantine_job(spark, sf_dir):
    base = scratch_path(spark, "quarantine")
    src = write_parquet(listings_raw(spark, sf_dir), f"{base}/combined.parquet")
    res = quarantine_job(spark, src, f"{base}/combined.csv", f"{base}/null_price_rows.parquet",
                         f"{base}/null_price_rows.csv")
    return res.rows


@register("clean_part_job", ("F5", "S5", "P3", "F3"), sql("""
select listing_id, cast(slot as varchar) as slot, try_cast(price as double) as price,
       cast(mileage as varchar) as mileage, seller_type, make, transmission
from listings_raw where try_cast(price as double) is not null""", "listings", "listings_raw"))
def q_clean_part_job(spark, sf_dir):
    base = scratch_path(spark, "clean_part")
    part_csv = write_csv(listings_raw(spark, sf_dir), f"{base}/part_node1.csv")
    return clean_part_job(spark, part_csv, f"{base}/processed_node1.parquet")


@register("concat_parts", ("U1",), sql("""
select * from (select * exclude (seller_type) from listings_raw where slot >= 10)
union all by name
select * from listings_raw where slot < 10""", "listings", "listings_raw"))
def q_concat_parts(spark, sf_dir):
    raw = listings_raw(spark, sf_dir)
    return union_parts([raw.where(F.col("slot") >= 10).drop("seller_type"), raw.where(F.col("slot") < 10)])



@register("stream_clean_parts", ("F5", "F4", "S5"), sql("""
select listing_id, slot, try_cast(price as double) as price, mileage, seller_type, make, transmission
from listings_raw where try_cast(price as double) is not null""", "listings", "listings_raw"))
def q_stream_clean_parts(spark, sf_dir):
    """The clean job as a stream: CSV parts in a folder -> micro-batches ->
    clean Parquet (and quarantine Parquet); read back the clean table."""
    base = scratch_path(spark, "stream_parts")
    raw = listings_raw(spark, sf_dir)
    # three batches whatever the size, of as many files as keep a task's share near the advisory size
    files = max(1, partitions_for_rows(spark, -(-raw.count() // 3), RAW_ROW_BYTES))
    write_csv(raw.repartition(3 * files), f"{base}/incoming")
    q = clean_parts_stream(spark, f"{base}/incoming", f"{base}/clean", f"{base}/quarantine", LISTINGS_RAW,
                           f"{base}/_checkpoint", max_files_per_trigger=files)
    q.awaitTermination()
    return read_stream_output(spark, f"{base}/clean")


@register("clean_and_quarantine", ("F4", "F5", "F1", "P3"), sql("""
select listing_id, try_cast(price as double) as price, price as price_text,
  case when price is null then 'null' when trim(price) = '' then 'blank'
       when try_cast(price as double) is null then 'unparseable' end as reason
from listings_raw""", "listings", "listings_raw"))
def q_clean_and_quarantine(spark, sf_dir):
    """Both outputs of the combined job: together every input row, once."""
    base = scratch_path(spark, "clean_quarantine")
    part = write_csv(listings_raw(spark, sf_dir), f"{base}/part_node1.csv")
    res = clean_quarantine_job(spark, part, f"{base}/processed_node1.parquet", f"{base}/null_price_rows.parquet")
    kept = (res.clean.select("listing_id", "price", F.col("price").cast("bigint").cast("string").alias("price_text"),
                         F.lit(None).cast("string").alias("reason")))
    return kept.unionByName(res.quarantine.select("listing_id", F.lit(None).cast("double").alias("price"),
                                              F.col("price").alias("price_text"), "reason"))


@register("merge_parts_job", ("S3", "U2", "K1", "L5x"), sql("""
select case when ('0x' || substr(md5(cast(o_orderkey as varchar)), 1, 8))::bigint % 100 < 80 then 'train' else 'test' end as split,
  count(*) as n, sum(o_custkey)::bigint as custkeys
from orders group by 1"""))
def q_merge_parts_job(spark, sf_dir):
    """Existing processed parts -> combined table -> keyed split counts."""
    base = write_parquet(_orders_parts(spark, sf_dir), scratch_path(spark, "merge_parts"), partition_by=["part"])
    merged = merge_parts_job(spark, [f"{base}/part={p}" for p in (1, 2, 3, 4)], f"{base}-combined")
    return (keyed_split(merged.withColumn("key", F.col("o_orderkey").cast("string")), "key").groupBy("split")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("custkeys")))


@register("csv_inferred_types", ("S4",), sql("select * from orders"))
def q_csv_inferred_types(spark, sf_dir):
    path = write_csv(_orders(spark, sf_dir), scratch_path(spark, "orders_inferred_csv"))
    return read_csv(spark, path, infer_schema=True).select(
        *[F.col(f.name).cast(f.dataType) for f in _orders_csv_schema(spark, sf_dir).fields])


_ORDERS_NARROWEST = {"o_orderkey": None, "o_custkey": None, "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": "timestamp",
                     "o_orderpriority": "string"}


@register("csv_type_lattice", ("S4", "P8"), sql(" union all ".join(
    f"select '{c}' as column, " + (f"'{t}'" if t else f"case when max({c}) <= 2147483647 and min({c}) >= -2147483648 then 'int' else 'bigint' end")
    + f" as type, count({c}) as n from orders" for c, t in _ORDERS_NARROWEST.items())))
def q_csv_type_lattice(spark, sf_dir):
    """Types inferred part by part from text and joined; only the names come from the file."""
    path = write_csv(_orders(spark, sf_dir), scratch_path(spark, "orders_lattice_csv"))
    text = read_csv(spark, path).select(*_ORDERS_NARROWEST)
    parts = column_types(text.withColumn("part", F.input_file_name()), by=["part"])
    return merged_types(parts)
