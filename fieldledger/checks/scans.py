"""Scans and sinks, each over files that the query writes from the test tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldledger import fixed_values as fv
from fieldledger.checks import proxies, sql
from fieldledger.checks.aggregates import profile_counts
from fieldledger.checks.registry import query
from fieldledger.functions.text import nonblank
from fieldledger.operators import profile, records
from fieldledger.plans.chat_texts import sift_records as sift
from fieldledger.scratch import scratch_path
from fieldledger.sources import readers, writers
from fieldledger.sources.published import split_folder, split_lines


#: Lines are over ten times the tables that they come from, and that much less when packed.
#: A packed file is read by one task.
PACKED = {"compression": "gzip", "max_records_per_file": readers.ROWS_PER_TASK}


def write_csv(df: DataFrame, path: str) -> str:
    writer = df.write.option("header", True).option("quote", '"').option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def write_tsv(df: DataFrame, path: str, *partition_by: str) -> str:
    df.write.partitionBy(*partition_by).option("delimiter", "\t").csv(path)
    return path


def written_splits(spark: SparkSession, folder: str) -> str:
    path = scratch_path(spark, "records")
    writers.sink_jsonl_splits(proxies.record_lines(spark, folder), path, **PACKED)
    return path


@query("scan_headered_csv", f"with {sql.INCIDENTS_RAW} select * from incidents_raw")
def scan_headered_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = write_csv(proxies.incidents_raw(spark, folder), scratch_path(spark, "csv"))
    return readers.scan_headered_csv(spark, path, proxies.RAW_COLUMNS)


@query(
    "scan_headered_csv_multiline",
    "select cast(doc_id as varchar) as doc_id, text, 'a \"quoted\" ' || source as source from documents",
)
def scan_headered_csv_multiline(spark: SparkSession, folder: str) -> DataFrame:
    docs = proxies.table(spark, folder, "documents").select(
        "doc_id", "text", F.concat(F.lit('a "quoted" '), F.col("source")).alias("source")
    )
    path = write_csv(docs, scratch_path(spark, "csv-multiline"))
    return readers.scan_headered_csv(spark, path, multiline=True)


@query("scan_positional_tsv", f"with {sql.ACTIVITY_RAW} select c0, c1, c7 from activity_raw")
def scan_positional_tsv(spark: SparkSession, folder: str) -> DataFrame:
    log = proxies.activity_log(spark, folder).withColumn("half", F.substring("_c0", -1, 1) < "5")
    path = write_tsv(log, scratch_path(spark, "tsv"), "half")
    scan = readers.scan_positional_tsv(spark, [f"{path}/half=t*", f"{path}/half=f*"], proxies.LOG_WIDTH)
    return scan.select(F.col("_c0").alias("c0"), F.col("_c1").alias("c1"), F.col("_c7").alias("c7"))


@query(
    "scan_year_glob_pruning",
    f"with {sql.ACTIVITY_RAW} select cast(substr(c1, 1, 4) as int) as year, cast(count(*) as bigint) as n_rows, "
    "cast(count(c7) as bigint) as n_codes from activity_raw where substr(c1, 1, 4) in ('1996', '1997', '1998') group by 1",
)
def scan_year_glob_pruning(spark: SparkSession, folder: str) -> DataFrame:
    log = proxies.activity_log(spark, folder).withColumn("export", F.substring("_c1", 1, 4))
    path = write_tsv(log, scratch_path(spark, "tsv-years"), "export")
    globs = readers.year_globs(path, proxies.YEARS, "{base}/export={year}*")
    scan = readers.scan_positional_tsv(spark, globs, proxies.LOG_WIDTH)
    return scan.groupBy(F.substring("_c1", 1, 4).cast("int").alias("year")).agg(
        F.count("*").alias("n_rows"), F.count("_c7").alias("n_codes")
    )


@query(
    "scan_text_lines",
    f"with {sql.SPLIT_REPORTS}, counted as (select split, count(*) as n from split_reports group by 1) "
    "select s.split, s.split <> 'holdout' as readable, cast(coalesce(n, 0) as bigint) as n_lines "
    "from (values ('train'), ('val'), ('test'), ('holdout')) s(split) left join counted c on c.split = s.split",
)
def scan_text_lines(spark: SparkSession, folder: str) -> DataFrame:
    found, report = readers.scan_text_lines(
        spark, written_splits(spark, folder), ["train", "val", "test", "holdout"]
    )
    counts = profile.split_counts(records.union_splits(found), splits=()).withColumnRenamed("n_rows", "n_lines")
    return report.join(F.broadcast(counts), "split", "left").fillna(0, ["n_lines"])


@query(
    "scan_jsonl_records",
    f"with {sql.DAMAGED} select cast(null as varchar) as system, case when sound then instruction end as instruction, "
    "cast(null as varchar) as input, case when sound then output end as output, not sound as is_corrupt "
    "from (select *, kind not in (0, 1, 2, 4, 7) as sound from decoded)",
)
def scan_jsonl_records(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "damaged")
    # Only lines that are no JSON have line feeds of their own.
    proxies.damaged_lines(spark, folder).select(F.translate("value", "\n", " ")).write.text(path)
    read = readers.scan_jsonl_records(spark, path)
    return read.select(*fv.RECORD_KEYS, F.col(readers.CORRUPT).isNotNull().alias("is_corrupt"))


@query(
    "sift_records",
    f"with {sql.DAMAGED} select case when kind in (0, 1, 2, 4, 7) then 'rejected' else 'records' end as split, "
    "case when kind in (0, 7) then 'not_json' when kind = 1 then 'not_object' when kind in (2, 4) then 'not_text' end as kind, "
    "cast(count(*) as bigint) as n_lines, cast(count(*) as bigint) as n_places from decoded group by 1, 2",
)
def sift_records(spark: SparkSession, folder: str) -> DataFrame:
    path, out = scratch_path(spark, "damaged"), scratch_path(spark, "sifted")
    proxies.damaged_lines(spark, folder).select(F.translate("value", "\n", " ")).write.text(path)
    sift(spark, path, out)
    sound = readers.scan_split_records(spark, out, records.RECORDS)
    bad = records.rejected_lines(split_lines(spark, out, records.REJECTED))
    none = F.lit(None).cast("string").alias("kind")
    kept = sound.where(F.col(readers.CORRUPT).isNull()).groupBy(F.lit(records.RECORDS).alias("split"), none)
    thrown = bad.groupBy(F.lit(records.REJECTED).alias("split"), "kind")
    rows = F.count("*").alias("n_lines")
    return kept.agg(rows, F.count("*").alias("n_places")).unionByName(
        thrown.agg(rows, F.count_distinct("file_name", "block_start", "row").alias("n_places"))
    )


@query(
    "scan_part_files",
    f"with {sql.SPLIT_REPORTS} select split, cast(count(*) as bigint) as n_rows, true as has_files, true as only_part_files "
    "from split_reports group by 1",
)
def scan_part_files(spark: SparkSession, folder: str) -> DataFrame:
    path = written_splits(spark, folder)
    parts = {s: readers.scan_part_files(spark, split_folder(spark, path, s)) for s in fv.SPLIT_FRACTIONS}
    return records.union_splits(parts).groupBy("split").agg(
        F.count("*").alias("n_rows"),
        (F.count_distinct("file_name") >= 1).alias("has_files"),
        F.bool_and(F.col("file_name").startswith("part-")).alias("only_part_files"),
    )


@query(
    "lookup_table",
    f"with {sql.LOOKUP}, {sql.ACTIVITY_RAW}, counted as (select c7, count(*) as n from activity_raw group by 1) "
    "select code, name, cast(coalesce(n, 0) as bigint) as n_rows, true as in_mapping "
    "from country_lookup left join counted on code = c7",
)
def lookup_table(spark: SparkSession, folder: str) -> DataFrame:
    names = proxies.country_lookup(spark, folder)
    # A literal mapping is what a user passes; here it comes from the few rows of the reference table.
    mapping = readers.lookup_table(spark, {r.code: r.name for r in names.collect()})
    same = mapping.select("code", "name", F.lit(True).alias("in_mapping"))
    lookup = readers.lookup_from_table(names, "code", "name").join(F.broadcast(same), ["code", "name"], "full")
    lookup = lookup.fillna(False, ["in_mapping"])
    counts = proxies.activity_raw(spark, folder).groupBy(F.col("c7").alias("code")).agg(F.count("*").alias("n_rows"))
    return lookup.join(counts, "code", "left").fillna(0, ["n_rows"])


@query(
    "sink_jsonl_splits",
    f"with {sql.SPLIT_REPORTS} select split, system, instruction, '' as input, output from split_reports",
)
def sink_jsonl_splits(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "records")
    lines = proxies.record_lines(spark, folder)
    # A first version with other lines, which the second one takes the place of.
    writers.sink_jsonl_splits(lines.select(F.lit("{}").alias("value"), "split"), path, **PACKED)
    writers.sink_jsonl_splits(lines, path, **PACKED)
    read = {s: readers.scan_split_records(spark, path, s) for s in fv.SPLIT_FRACTIONS}
    return records.union_splits(read).select("split", *fv.RECORD_KEYS)


@query(
    "sink_jsonl_partitioned",
    f"with {sql.SPLIT_REPORTS} select split, cast(count(*) as bigint) as n_rows from split_reports group by 1",
)
def sink_jsonl_partitioned(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "records-partitioned")
    writers.sink_jsonl_partitioned(proxies.record_lines(spark, folder), path, **PACKED)
    return profile.split_counts(spark.read.text(path))


@query(
    "sink_verify_readback",
    f"with {sql.SPLIT_REPORTS}, ranked as (select *, row_number() over (partition by split order by instruction, output) as rn, "
    "count(*) over (partition by split) as n from split_reports) "
    "select split, cast(n as bigint) as n_records, cast(0 as bigint) as n_unparsed, instruction, "
    "substr(output, 1, 120) as output_preview from ranked where rn = 1",
)
def sink_verify_readback(spark: SparkSession, folder: str) -> DataFrame:
    return writers.sink_verify_readback(spark, written_splits(spark, folder))


@query(
    "sink_profile_tables",
    f"with {sql.TAGGED}, "
    "bins as (select cast(case when token_len > 800 then 32 else least(token_len // 25, 31) end as int) as bin, count(*) as n from tagged group by 1) "
    "select 'histogram' as \"table\", cast(b as varchar) as entry, cast(coalesce(n, 0) as bigint) as n_rows "
    "from range(33) r(b) left join bins on bin = b "
    "union all select 'kinds', 'ok', count(*) from tagged "
    "union all select 'labels', label, count(*) from tagged group by 2 "
    "union all select 'splits', split, count(*) from tagged group by 2",
)
def sink_profile_tables(spark: SparkSession, folder: str) -> DataFrame:
    counts = profile_counts(spark, folder, [key for key in profile.PROFILE_KEYS if key != "has_layout"])
    path = scratch_path(spark, "profile")
    names = {"histogram": "bin", "kinds": "kind", "labels": "label", "splits": "split"}
    tables = profile.profile_tables(counts)
    writers.sink_profile_tables({name: tables[name] for name in names}, path)
    read = [
        spark.read.parquet(f"{path}/{name}").select(
            F.lit(name).alias("table"), F.col(column).cast("string").alias("entry"), "n_rows"
        )
        for name, column in names.items()
    ]
    return reduce(DataFrame.unionByName, read)


@query(
    "count_nonblank_lines",
    "select cast(count(*) as bigint) as n_lines, cast(count(*) filter (regexp_matches(line, '\\S')) as bigint) as n_nonblank "
    "from (select unnest(string_split(text, chr(10))) as line from documents)",
)
def count_nonblank_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    proxies.table(spark, folder, "documents").select("text").write.text(path)
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.agg(F.count("*").alias("n_lines"), F.count_if(nonblank(F.col("value"))).alias("n_nonblank"))
