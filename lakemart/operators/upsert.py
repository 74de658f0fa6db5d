"""Upserts, incremental mart refresh and customer history."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from lakemart.functions import row_hash
from lakemart.operators.ranking import same_values, split_groups
from lakemart.session import materialize, work_path
from lakemart.sources.audit import RUN_SCHEMA, already_done, run_audit
from lakemart.sources.ledger import Ledger, table_location
from lakemart.sources.tables import arrange, create_table, overwrite_partitions, partition_columns

CREATED, UPDATED = "record_created_at", "record_updated_at"
#: Marks the rows of a batch while they are resolved against those of the table.
ARRIVED = "_arrived"
#: Additions to a key index after which it is written anew.
APPENDS = 50


def upsert(target: DataFrame, source: DataFrame, keys: list[str], hash_columns: list[str] | None = None) -> DataFrame:
    """``target`` after applying ``source`` by key, plus ``_change``: insert, update or unchanged.

    A matched row is replaced only if the content of ``hash_columns`` differs (default: all
    columns but keys and record times). The creation time of an updated row is kept. Both
    sides must be unique by key, where a null is a value like any other; the join is one shuffle of each.
    """
    columns = target.columns
    content = hash_columns or [c for c in columns if c not in keys and c not in (CREATED, UPDATED)]
    row = [F.struct(*columns), row_hash(*content)]
    old = target.select(*[F.col(k).alias(f"_old_{k}") for k in keys], row[0].alias("old"), row[1].alias("old_hash"))
    new = source.select(*[F.col(k).alias(f"_new_{k}") for k in keys], row[0].alias("new"), row[1].alias("new_hash"))
    change = (
        F.when(F.col("old").isNull(), "insert")
        .when(F.col("new").isNull() | (F.col("old_hash") == F.col("new_hash")), "unchanged").otherwise("update")
    )
    merged = old.join(new, _all_same([(f"_old_{k}", f"_new_{k}") for k in keys]), "full").withColumn("_change", change)

    def pick(name: str) -> Column:
        fresh = F.col(f"old.{name}").isNotNull() if name == CREATED else F.col("_change") == "unchanged"
        keep = fresh & F.col("old").isNotNull()
        return F.when(keep, F.col(f"old.{name}")).otherwise(F.col(f"new.{name}")).alias(name)

    return merged.select(*[pick(c) for c in columns], "_change")


def _all_same(pairs: list[tuple[str, str]]) -> Column:
    return reduce(Column.__and__, [F.col(a).eqNullSafe(F.col(b)) for a, b in pairs])


# --- where a key lives ------------------------------------------------------------------

def index_table(table: str) -> str:
    return f"{table}_keys"


def _key_hash(keys: list[str]) -> Column:
    """Keys as one number, null included. Equal numbers of different keys only touch a partition more."""
    return F.xxhash64(*keys).alias("key_hash")


def index_keys(spark: SparkSession, table: str, keys: list[str], buckets: int | None = None) -> None:
    """(Re)build the index of a partitioned table: key and partition, stored bucketed by key (by default in
    as many buckets as a shuffle has partitions). Needed again after rows were written to the table by
    other means than :func:`upsert_table`; a full replacement of the table does so by itself."""
    _write_index(spark, table, spark.table(table).select(_key_hash(keys), *partition_columns(spark, table)), buckets)
    batch_ledger(spark, table).claim("indexed")


def _write_index(spark: SparkSession, table: str, rows: DataFrame, buckets: int | None) -> None:
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    fresh = f"{index_table(table)}_{uuid.uuid4().hex}"
    rows.distinct().repartition(buckets, "key_hash").write.bucketBy(buckets, "key_hash").sortBy("key_hash") \
        .option("path", f"{table_location(spark, table)}_keys/{uuid.uuid4().hex}").saveAsTable(fresh)
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": index_table(table)})
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {index_table(table)}")
    batch_ledger(spark, table).put("index-appends", "0")


def _buckets(spark: SparkSession, table: str) -> int:
    described = spark.sql("DESCRIBE FORMATTED IDENTIFIER(:name)", args={"name": index_table(table)})
    return int(described.filter("col_name = 'Num Buckets'").first().data_type)


def _extend_index(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """Append to the buckets; from time to time their many small files become one each."""
    buckets = _buckets(spark, table)
    ledger = batch_ledger(spark, table)
    appends = int(ledger.read("index-appends") or 0)
    if appends >= APPENDS:
        _write_index(spark, table, spark.table(index_table(table)).unionByName(rows), buckets)
        return
    rows.repartition(buckets, "key_hash").write.mode("append").bucketBy(buckets, "key_hash").sortBy("key_hash") \
        .saveAsTable(index_table(table))
    ledger.put("index-appends", str(appends + 1))


def _new(name: str) -> str:
    return f"_new_{name}"


def locate_keys(spark: SparkSession, table: str, source: DataFrame, keys: list[str]) -> DataFrame:
    """Key, new partition and each partition the index knows for the key (one row of nulls if none). The
    index keeps its buckets in the join: only keys of the batch are shuffled, into the same buckets."""
    parts = partition_columns(spark, table)
    arrived = source.select(_key_hash(keys), *[F.col(p).alias(_new(p)) for p in parts]) \
        .repartition(_buckets(spark, table), "key_hash").distinct()
    index = spark.table(index_table(table)).withColumn("known", F.lit(True))
    return arrived.join(index, "key_hash", "left")


def fresh_keys(located: DataFrame, parts: list[str]) -> DataFrame:
    """Index rows that are not there yet."""
    at_home = F.coalesce(F.bool_or(F.col("known") & _all_same([(p, _new(p)) for p in parts])), F.lit(False))
    unknown = located.groupBy("key_hash", *[_new(p) for p in parts]).agg(at_home.alias("at_home")).filter("not at_home")
    return unknown.select("key_hash", *[F.col(_new(p)).alias(p) for p in parts])


def touched_partitions(located: DataFrame, parts: list[str]) -> DataFrame:
    """Partitions of the new rows and those that hold, or held, a row of their keys."""
    fresh = located.select(*[F.col(_new(p)).alias(p) for p in parts])
    return fresh.union(located.filter("known").select(*parts)).groupBy(*parts).agg(F.count(F.lit(1)).alias("touching"))


def rows_of(target: DataFrame, parts: list[str], touched: DataFrame, with_null: bool = True) -> DataFrame:
    """Rows of the touched partitions. ``touched`` has one row per folder, so it is broadcast and prunes
    the scan at run time; partitions with a null, which pruning by equality cannot find, are a scan of
    their own (``with_null=False``: none is touched)."""
    no_null = reduce(Column.__and__, [F.col(p).isNotNull() for p in parts])
    chosen = touched.filter(no_null & (F.col("touching") > 0)).select(*parts)
    found = target.join(F.broadcast(chosen), parts, "left_semi")
    if not with_null:
        return found
    others = touched.filter(~no_null).select(*[F.col(p).alias(_new(p)) for p in parts])
    same = _all_same([(p, _new(p)) for p in parts])
    return found.unionByName(target.filter(~no_null).join(F.broadcast(others), same, "left_semi"))


# --- upsert of a table ------------------------------------------------------------------

def batch_ledger(spark: SparkSession, table: str) -> Ledger:
    """Markers of applied batches. They lie in the folder of the table, where scans and partition writes
    leave hidden folders alone and a full replacement of the table removes them."""
    place = table_location(spark, table)
    return Ledger(spark, f"{place}/_batches" if partition_columns(spark, table) else f"{place}_batches")


def _stage(df: DataFrame, name: str) -> str:
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def upsert_table(spark: SparkSession, table: str, source: DataFrame, keys: list[str], sort_by=(),
                 batch_id: str | None = None, resolve: Callable[[DataFrame], DataFrame] | None = None,
                 keys_fix_partition: bool = False, picks_rows: bool = False) -> dict:
    """Apply ``source`` to a parquet table, rewriting only the partitions it touches.

    Touched are the partitions of the new rows and, by the key index, those that hold their old
    versions, so a row that moves leaves no copy behind and no other partition is read. A new row
    replaces the old one; with ``resolve``, that function takes the rows of both sides and returns one
    per key. ``keys_fix_partition`` says that a key never moves: no index is kept then. ``picks_rows`` says that
    ``resolve`` returns rows as they came, all columns kept and earlier columns deciding first: partitions of
    which the batch changes nothing are not written then.

    Applied exactly once: the result is staged, then noted as open, then swapped in, and every step of
    the swap can be repeated. A run that stopped before the note has changed nothing; one that stopped
    later is completed by the next call from its staged rows, whatever that call applies. A batch
    whose ``batch_id`` was applied before is left out (empty counts). New versions are written before
    emptied partitions go, so no reader misses a row. One writer per table at a time.
    """
    ledger = batch_ledger(spark, table)
    _refresh(spark, table)
    finish_open_batch(spark, table, sort_by)
    batch_id = batch_id or uuid.uuid4().hex
    if ledger.has(f"done/{batch_id}"):
        return {}
    target = spark.table(table)
    parts = partition_columns(spark, table)
    note = {"batch": batch_id, "parts": parts}
    seen = Observation()
    any_null = reduce(Column.__or__, [F.col(p).isNull() for p in parts], F.lit(False))
    note["source"] = _stage(source.observe(seen, F.count_if(any_null).alias("with_null")), "upsert-source")
    source = spark.read.schema(source.schema).parquet(note["source"])
    if parts:
        with_null = seen.get["with_null"]
        if not keys_fix_partition:
            if not (ledger.has("indexed") and spark.catalog.tableExists(index_table(table))):
                index_keys(spark, table, keys)
            seen = Observation()
            located = locate_keys(spark, table, source, keys).observe(
                seen, F.count_if(F.col("known") & any_null).alias("with_null"))
            note["located"] = _stage(located, "upsert-located")
            with_null += seen.get["with_null"]
        target = rows_of(target, parts, _touched(spark, note), with_null > 0)
    counts = Observation()
    if resolve is None:
        result = upsert(target, source, keys)
    else:
        sides = [target, source]
        if picks_rows:  # the mark is the last column, so of equal rows the one of the table stays
            sides = [side.withColumn(ARRIVED, F.lit(new)) for side, new in zip(sides, (False, True))]
        result = resolve(sides[0].unionByName(sides[1])).withColumn("_change", F.lit(None).cast("string"))
    result = result.observe(
        counts, F.count_if(F.col("_change") == "insert").alias("inserted_rows"),
        F.count_if(F.col("_change") == "update").alias("updated_rows"), F.count(F.lit(1)).alias("rewritten_rows"))
    note["staged"] = _stage(result.drop("_change"), "upsert-result")
    if picks_rows and parts:
        note["changed"] = _stage(_changed(spark.read.parquet(note["staged"]), target, parts), "upsert-changed")
    ledger.put("open", json.dumps(note))
    finish_open_batch(spark, table, sort_by)
    return counts.get


def _refresh(spark: SparkSession, table: str) -> None:
    """Another session, such as that of a stream, may have written: its files are listed anew."""
    for name in (table, index_table(table)):
        if spark.catalog.tableExists(name):
            spark.catalog.refreshTable(name)


def _touched(spark: SparkSession, note: dict) -> DataFrame:
    """Touched partitions of a staged batch; without an index those of its rows."""
    parts = note["parts"]
    if "located" in note:
        return touched_partitions(spark.read.parquet(note["located"]), parts)
    return spark.read.parquet(note["source"]).groupBy(*parts).agg(F.count(F.lit(1)).alias("touching"))


def _changed(staged: DataFrame, target: DataFrame, parts: list[str]) -> DataFrame:
    """Partitions with a row that arrived, or with fewer rows of the table than it holds there. Others stay as they are."""
    held = target.groupBy(*parts).agg(F.count(F.lit(1)).alias("n"), F.lit(False).alias("new"))
    kept = staged.groupBy(*parts).agg((-F.count_if(~F.col(ARRIVED))).alias("n"), F.bool_or(ARRIVED).alias("new"))
    both = held.unionByName(kept).groupBy(*parts).agg(F.sum("n").alias("gone"), F.bool_or("new").alias("new"))
    return both.filter("new OR gone <> 0").select(*parts)


def finish_open_batch(spark: SparkSession, table: str, sort_by=()) -> None:
    """Swap in the staged rows of the batch noted as open, if there is one."""
    ledger = batch_ledger(spark, table)
    text = ledger.read("open")
    if text is None:
        return
    note = json.loads(text)
    parts = note["parts"]
    staged = spark.read.schema(spark.table(table).schema).parquet(note["staged"])
    wanted = staged
    if "changed" in note:  # one row a folder
        changed = spark.read.schema(staged.select(*parts).schema).parquet(note["changed"])
        wanted = staged.join(F.broadcast(changed.select(*[F.col(p).alias(_new(p)) for p in parts])), _all_same([(p, _new(p)) for p in parts]), "left_semi")
    overwrite_partitions(arrange(wanted, parts, sort_by), table)
    if "located" in note:
        emptied = _touched(spark, note).select(*parts).subtract(staged.select(*parts))  # null equals null here
        for row in emptied.collect():  # folders without rows: only a command per folder removes them
            drop_partition(spark, table, dict(zip(parts, row)))
        if spark.catalog.tableExists(index_table(table)):
            _extend_index(spark, table, fresh_keys(spark.read.parquet(note["located"]), parts))
    ledger.claim(f"done/{note['batch']}")
    ledger.remove("open")


def drop_partition(spark: SparkSession, table: str, values: dict) -> None:
    """Remove a partition with its files, which the command alone leaves behind for a table at a given place."""
    spec = ", ".join(f"`{c}` = {_sql_value(v)}" for c, v in values.items())
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    folder = "/".join(names.getPartitionPathString(c, None if v is None else str(v)) for c, v in values.items())
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{table_location(spark, table)}/{folder}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _sql_value(value) -> str:
    if value is None:
        return "NULL"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def merge_table(table: str, source: DataFrame, keys: list[str], hash_column: str = "record_hash") -> None:
    """The same for formats with row-level merge; not available on parquet tables."""
    matched = F.lit(True)
    for k in keys:
        matched = matched & (F.col(f"{table}.{k}") == F.col(f"source.{k}"))
    changed = F.col(f"{table}.{hash_column}") != F.col(f"source.{hash_column}")
    source.alias("source").mergeInto(table, matched).whenMatched(changed).updateAll().whenNotMatched().insertAll().merge()


def run_batch_once(spark: SparkSession, runs_table: str, job_name: str, batch_id: str, job: Callable[[], dict],
                   lease_seconds: float = 6 * 3600) -> bool:
    """Run ``job`` unless this batch succeeded before or another run holds it; its counts go to the audit table.

    Each attempt is claimed by a marker that only one run can create. The next attempt is open once the
    one before has failed, or has neither ended nor failed within ``lease_seconds`` (its run was killed).
    """
    create_table(spark, runs_table, RUN_SCHEMA)
    ledger = Ledger(spark, f"{table_location(spark, runs_table)}/_claims")
    attempt = 1
    while not ledger.has(f"{job_name}/{batch_id}/done") and not already_done(spark, runs_table, job_name, batch_id):
        name = f"{job_name}/{batch_id}/attempt-{attempt}"
        if ledger.claim(name):
            try:
                with run_audit(spark, runs_table, job_name, batch_id) as counts:
                    counts.update(job())
            except BaseException:
                ledger.claim(f"{name}-failed")
                raise
            ledger.claim(f"{job_name}/{batch_id}/done")
            return True
        if not ledger.has(f"{name}-failed") and ledger.age_seconds(name) < lease_seconds:
            return False
        attempt += 1
    return False


def affected_months(*changes: DataFrame) -> DataFrame:
    """Distinct purchase months in changed orders (old and new versions)."""
    months = changes[0].select("purchase_year_month")
    for more in changes[1:]:
        months = months.union(more.select("purchase_year_month"))
    return months.distinct()


def in_months(df: DataFrame, months: DataFrame, column: str = "purchase_year_month") -> DataFrame:
    """Rows of some months. There are as many months as the calendar has, so they are broadcast; a frame
    stored by month is then read in those folders only."""
    wanted = months.select(column).distinct().filter(F.length(column) > 0)
    return df.join(F.broadcast(wanted), column, "left_semi")


def refresh_months(mart: Callable[..., DataFrame], orders: DataFrame, *others: DataFrame, months: DataFrame) -> DataFrame:
    """Recompute a mart for some months only. ``mart`` takes orders first; what else it takes reaches it
    through its join with the orders. Inputs stored with their order's month are pruned by it as well."""
    month = "purchase_year_month"
    pruned = [in_months(df, months).drop(month) if month in df.columns else df for df in others]
    return mart(in_months(orders, months), *pruned)


def replace_months(mart: DataFrame, refreshed: DataFrame, months: DataFrame) -> DataFrame:
    """The mart with the rows of ``months`` exchanged; a month without rows left disappears."""
    return mart.join(months, "purchase_year_month", "left_anti").unionByName(refreshed)


def customer_history(versions: DataFrame, key: str, valid_from: str, tracked: list[str], pieces: int | None = None) -> DataFrame:
    """Type 2 history: one row per period in which the tracked columns did not change.

    ``versions`` has one row per observation. Same-time observations count as one, the last by
    content. A person may hold a large part of the rows, so histories are dealt into ranges of
    (person, time): changes are found inside each range and across the borders between ranges.
    """
    observed = versions.groupBy(key, valid_from).agg(F.max(F.struct(*tracked)).alias("state"))
    starts = _changes(split_groups(observed, [key], valid_from, pieces), key, valid_from)
    ends = _next_start(split_groups(starts, [key], valid_from, pieces), key, valid_from)
    return ends.select(key, valid_from, F.col("next_start").alias("valid_to"),
                       F.col("next_start").isNull().alias("is_current"), "state.*")


def _changes(cut: DataFrame, key: str, valid_from: str) -> DataFrame:
    """Observations that differ from the one before."""
    person = Window.partitionBy(key)
    inside = Window.partitionBy(key, "_piece").orderBy(valid_from)
    last = cut.groupBy(key, "_piece").agg(F.max_by("state", valid_from).alias("_last"))
    border = last.withColumn("_border", F.lag("_last").over(person.orderBy("_piece"))).drop("_last")
    inner = cut.withColumns({"_inner": F.lag("state").over(inside), "_nth": F.row_number().over(inside)})
    before = inner.alias("v").join(border.alias("o"), same_values("v", "o", [key, "_piece"])).select("v.*", "o._border") \
        .withColumn("_before", F.when(F.col("_nth") == 1, F.col("_border")).otherwise(F.col("_inner")))
    return before.filter(~F.col("state").eqNullSafe(F.col("_before"))).select(key, valid_from, "state")


def _next_start(cut: DataFrame, key: str, valid_from: str) -> DataFrame:
    """Start of the following period, null for the last."""
    person = Window.partitionBy(key)
    inside = Window.partitionBy(key, "_piece").orderBy(valid_from)
    first = cut.groupBy(key, "_piece").agg(F.min(valid_from).alias("_first"))
    border = first.withColumn("_border", F.lead("_first").over(person.orderBy("_piece"))).drop("_first")
    inner = cut.withColumn("_inner", F.lead(valid_from).over(inside))
    return inner.alias("v").join(border.alias("o"), same_values("v", "o", [key, "_piece"])).select("v.*", "o._border") \
        .withColumn("next_start", F.coalesce("_inner", "_border"))
