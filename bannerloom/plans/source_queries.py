"""Dataset folders, history, table layouts, blobs and revisions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bannerloom import schemas
from bannerloom.operators import performance as P
from bannerloom.plans.registry import query
from bannerloom.plans.views import HISTORY_DAYS, Views, with_views
from bannerloom.session import scratch_dir
from bannerloom.sources import blobs, datasets, history, tables

PERIODS = [1, 2, 3]
COPY_OF_FIRST = 4  # a dataset folder with the contents of dataset 1
KINDS = ["impressions", "clicks", "conversions"]


def kind_tables(v: Views) -> dict[str, DataFrame]:
    # conversions are a window over the events and are used for every dataset
    conversions = tables.write_out(v.conversions, scratch_dir(v.spark, "conversions"))
    return {"impressions": v.impressions, "clicks": v.clicks, "conversions": conversions}


def staged_csv(v: Views) -> str:
    """Folder of CSV datasets made from the given tables."""
    root = scratch_dir(v.spark, "csv")
    for kind, df in kind_tables(v).items():
        for n in [*PERIODS, COPY_OF_FIRST]:
            period = 1 if n == COPY_OF_FIRST else n
            datasets.write_csv(df.where(F.col("period") == period), root, n, kind)
    # a folder that is not a dataset
    columns = schemas.CLICKS.fieldNames()
    v.clicks.where(F.col("period") == 1).select(*columns).write.csv(f"{root}/archive/clicks_1.csv", header=True)
    return root


@query("dataset_discovery", with_views("SELECT DISTINCT period AS dataset_id FROM ev UNION SELECT 4", "ev"))
def _(v: Views) -> DataFrame:
    return datasets.discover(v.spark, staged_csv(v))


VIEW_OF = {"impressions": "imp", "clicks": "clk", "conversions": "conv"}
EVERY_FIELD = sorted({f for kind in KINDS for f in schemas.INPUTS[kind].fieldNames()})


def _roundtrip_sql() -> str:
    """All fields of all kinds and folders; dataset 4 has the rows of dataset 1."""
    selects = []
    for kind in KINDS:
        own = schemas.INPUTS[kind].fieldNames()
        fields = ", ".join(f"{f'CAST({c} AS VARCHAR)' if c in own else 'CAST(NULL AS VARCHAR)'} AS {c}" for c in EVERY_FIELD)
        for dataset, where in (("period", "TRUE"), (COPY_OF_FIRST, "period = 1")):
            selects.append(f"SELECT '{kind}' AS kind, {fields}, {dataset} AS dataset_id FROM {VIEW_OF[kind]} WHERE {where}")
    return with_views("\nUNION ALL ".join(selects), *VIEW_OF.values())


@query("csv_roundtrip", _roundtrip_sql())
def _(v: Views) -> DataFrame:
    root = staged_csv(v)
    read = []
    for kind in KINDS:
        for n in [*PERIODS, COPY_OF_FIRST]:
            rows = datasets.read_csv(v.spark, root, n, kind)
            fields = [F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in EVERY_FIELD]
            read.append(rows.select(F.lit(kind).alias("kind"), *fields, datasets.dataset_of(F.input_file_name()).alias("dataset_id")))
    return reduce(DataFrame.unionByName, read)


def _contract_sql() -> str:
    tables_ = {"performance": ("perf", schemas.PERFORMANCE)}
    for k in KINDS:
        for n in [*PERIODS, COPY_OF_FIRST]:
            period = 1 if n == COPY_OF_FIRST else n
            tables_[f"{k}_{n}"] = (f"{VIEW_OF[k]} WHERE period = {period}", schemas.INPUTS[k])
    rows = [
        f"SELECT '{t}' AS table_name, '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS expected, "
        f"'{f.dataType.simpleString()}' AS found, TRUE AS ok, COUNT(*) AS rows, COUNT({f.name}) AS filled FROM {source}"
        for t, (source, schema) in tables_.items()
        for f in schema.fields
    ]
    return with_views("\nUNION ALL ".join(rows), "imp", "clk", "conv", "perf")


@query("schema_contract", _contract_sql())
def _(v: Views) -> DataFrame:
    root = staged_csv(v)
    reports = [
        schemas.schema_contract(f"{k}_{n}", datasets.read_csv(v.spark, root, n, k), schemas.INPUTS[k])
        for k in KINDS
        for n in [*PERIODS, COPY_OF_FIRST]
    ]
    return reduce(DataFrame.unionByName, [*reports, schemas.schema_contract("performance", v.perf, schemas.PERFORMANCE)])


def _digest_sql(table: str, kind: str, columns: list[str], group: str) -> str:
    fields = [f"COALESCE(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns]
    line = " || ".join([f"'{','.join(columns)};'", *fields])
    quarters = [f"('0x' || SUBSTR(h, {at}, 8))::BIGINT" for at in (1, 9, 17, 25)]
    sums = " || '|' || ".join(f"SUM({q}) || '|' || BIT_XOR({q})" for q in quarters)
    return f"""SELECT dataset_id, '{kind}' AS kind, md5(COUNT(*) || '|' || {sums}) AS fingerprint
FROM (SELECT {group} AS dataset_id, md5({line}) AS h FROM {table}) GROUP BY 1"""


def _digests_sql(group: str) -> str:
    parts = [
        _digest_sql(t, k, schemas.INPUTS[k].fieldNames(), group)
        for t, k in (("imp", "impressions"), ("clk", "clicks"), ("conv", "conversions"))
    ]
    return "\nUNION ALL ".join(parts)


@query(
    "file_fingerprints",
    with_views(
        f"""SELECT * FROM ({_digests_sql("period")})
UNION ALL SELECT 4, kind, fingerprint FROM ({_digests_sql("period")}) WHERE dataset_id = 1""",
        "imp",
        "clk",
        "conv",
    ),
)
def _(v: Views) -> DataFrame:
    root = staged_csv(v)
    each = [datasets.file_fingerprints(v.spark, root, n) for n in [*PERIODS, COPY_OF_FIRST]]
    return reduce(DataFrame.unionByName, each)


def _lines_sql() -> str:
    """The distinct (checksum, kind, dataset) of datasets written as one file each, headers included."""
    parts = []
    for kind in KINDS:
        columns = schemas.INPUTS[kind].fieldNames()
        line = " || ',' || ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in columns)
        lines = f"SELECT period AS dataset_id, {line} AS value FROM {VIEW_OF[kind]} UNION ALL SELECT n, '{','.join(columns)}' FROM (VALUES (1), (2), (3)) t(n)"
        parts.append(_digest_sql(f"({lines})", kind, ["value"], "dataset_id").replace("AS fingerprint", "AS checksum"))
    return with_views(" UNION ALL ".join(parts), *VIEW_OF.values())


@query("file_checksums", _lines_sql())
def _(v: Views) -> DataFrame:
    root = scratch_dir(v.spark, "csv")
    for kind, df in kind_tables(v).items():
        for n in PERIODS:
            # one file for each folder, so that its checksum can be stated in SQL
            datasets.write_csv(df.where(F.col("period") == n).coalesce(1), root, n, kind)
    return datasets.file_checksums(v.spark, root).drop("path")


# --- history: one dataset per calendar day, days up to HISTORY_DAYS are processed


def day_digests(v: Views) -> DataFrame:
    each = [
        df.groupBy(F.dayofmonth("ts").alias("dataset_id"))
        .agg(datasets.digest(schemas.INPUTS[kind].fieldNames()).alias("fingerprint"))
        .select("dataset_id", F.lit(kind).alias("kind"), "fingerprint")
        for kind, df in kind_tables(v).items()
    ]
    # three short rows per day
    return tables.write_out(reduce(DataFrame.unionByName, each), scratch_dir(v.spark, "digests"))


def day_history(digests: DataFrame) -> DataFrame:
    """History rows of the processed days; the last one was skipped as a duplicate."""
    kinds = F.map_from_entries(F.collect_list(F.struct("kind", "fingerprint")))
    return (
        digests.where(F.col("dataset_id") <= HISTORY_DAYS)
        .groupBy("dataset_id")
        .agg(kinds.alias("fingerprints"))
        .select(
            F.col("dataset_id").cast("long").alias("seq"),
            F.col("dataset_id").alias("order"),
            F.when(F.col("dataset_id") == HISTORY_DAYS, "duplicate").otherwise("processed").alias("state"),
            F.current_timestamp().alias("start_time"),
            F.current_timestamp().alias("end_time"),
            "fingerprints",
        )
    )


DAYS = f"day_digests AS ({_digests_sql('EXTRACT(day FROM ts)')})"


def _with_days(body: str) -> str:
    return with_views("@", "imp", "clk", "conv").replace("\n@", f",\n{DAYS}\n{body}")


@query("latest_dataset", _with_days(f"SELECT CAST(MAX(dataset_id) AS INTEGER) AS latest FROM day_digests WHERE dataset_id < {HISTORY_DAYS}"))
def _(v: Views) -> DataFrame:
    return history.latest_dataset(day_history(day_digests(v)))


@query(
    "latest_dataset_any_state",
    _with_days(f"SELECT CAST(MAX(dataset_id) AS INTEGER) AS latest FROM day_digests WHERE dataset_id <= {HISTORY_DAYS}"),
)
def _(v: Views) -> DataFrame:
    return history.latest_dataset(day_history(day_digests(v)), any_state=True)


@query("next_dataset", _with_days(f"SELECT CAST(MIN(dataset_id) AS INTEGER) AS next FROM day_digests WHERE dataset_id > {HISTORY_DAYS}"))
def _(v: Views) -> DataFrame:
    return history.next_dataset(v.events.select(F.dayofmonth("ts").alias("dataset_id")), day_history(day_digests(v)))


def _duplicate_sql(verdict: str) -> str:
    return _with_days(
        f"""SELECT CAST(d.dataset_id AS INTEGER) AS dataset_id, {verdict} AS is_duplicate
FROM day_digests d LEFT JOIN (SELECT DISTINCT kind, fingerprint, TRUE AS known FROM day_digests WHERE dataset_id <= {HISTORY_DAYS}) h
  USING (kind, fingerprint) GROUP BY d.dataset_id"""
    )


@query("duplicate_dataset", _duplicate_sql("BOOL_OR(COALESCE(known, FALSE))"))
def _(v: Views) -> DataFrame:
    digests = day_digests(v)
    return history.duplicate_datasets(digests, day_history(digests))


@query("duplicate_dataset_first", _duplicate_sql("MIN_BY(COALESCE(known, FALSE), kind)"))
def _(v: Views) -> DataFrame:
    digests = day_digests(v)
    return history.duplicate_datasets(digests, day_history(digests), mode="first")


@query(
    "history_append",
    _with_days(
        f"""SELECT CAST(dataset_id AS INTEGER) AS "order", CASE WHEN dataset_id = {HISTORY_DAYS} THEN 'duplicate' ELSE 'processed' END AS state,
  kind, fingerprint FROM day_digests WHERE dataset_id <= {HISTORY_DAYS} + 1"""
    ),
)
def _(v: Views) -> DataFrame:
    path = scratch_dir(v.spark, "history")
    digests = day_digests(v)
    history.append_history(day_history(digests), path)
    following = HISTORY_DAYS + 1
    prints = digests.where(F.col("dataset_id") == following)
    history.append_history(
        history.history_row(prints, following, following, "processed", "2024-01-21T00:00:00"), path
    )
    return history.read_history(v.spark, path).select("order", "state", F.explode("fingerprints").alias("kind", "fingerprint"))


# --- performance tables on disk


def write_periods(v: Views, path: str) -> None:
    inputs = kind_tables(v)
    for n in PERIODS:
        one = {kind: df.where(F.col("period") == n) for kind, df in inputs.items()}
        perf = P.banner_performance(one["clicks"], one["impressions"], one["conversions"])
        tables.overwrite_dataset(perf.withColumn("revenue_total", F.round("revenue_total", 2)), path, n)


@query("perf_overwrite_partition", with_views("SELECT * FROM period_perf", "period_perf"))
def _(v: Views) -> DataFrame:
    path = scratch_dir(v.spark, "perf")
    # dataset 2 holds other rows first and is then replaced with the others left in place
    tables.overwrite_dataset(v.perf, path, 2)
    write_periods(v, path)
    return tables.scan_performance(v.spark, path)


@query("perf_scan_dataset", with_views("SELECT * FROM period_perf WHERE dataset_id = 2", "period_perf"))
def _(v: Views) -> DataFrame:
    path = scratch_dir(v.spark, "perf")
    write_periods(v, path)
    return tables.scan_dataset(v.spark, path, 2)


@query("perf_clustered_layout", with_views("SELECT *, campaign_id BETWEEN 10 AND 40 AS in_range FROM perf", "perf"))
def _(v: Views) -> DataFrame:
    """All rows as written; those of a range read by the range."""
    written = tables.write_out(tables.clustered(v.perf), scratch_dir(v.spark, "perf"))
    inside = F.col("campaign_id").between(10, 40)
    ranged = written.where(inside).withColumn("in_range", F.lit(True))
    return ranged.unionByName(written.where(~inside).withColumn("in_range", F.lit(False)))


@query(
    "pipeline_out",
    """SELECT o_custkey, o_orderstatus, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total FROM orders
GROUP BY o_custkey, o_orderstatus""",
)
def _(v: Views) -> DataFrame:
    result = (
        v.table("orders")
        .groupBy("o_custkey", "o_orderstatus")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    )
    return tables.write_out(result, scratch_dir(v.spark, "out"))


INSERTED = """FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_orderkey ORDER BY seq) AS i FROM ops)
WHERE i = 1 AND o_orderkey NOT IN (SELECT o_orderkey FROM orders)"""


@query("insert_many_unique", with_views(f"SELECT seq, o_orderkey, op, amount {INSERTED}", "ops"))
def _(v: Views) -> DataFrame:
    return tables.insert_unique(v.table("orders"), v.ops, ["o_orderkey"], "seq")[0]


@query(
    "insert_many_rejects",
    with_views(f"SELECT seq, o_orderkey, op, amount FROM ops WHERE seq NOT IN (SELECT seq {INSERTED})", "ops"),
)
def _(v: Views) -> DataFrame:
    return tables.insert_unique(v.table("orders"), v.ops, ["o_orderkey"], "seq")[1]


@query(
    "unique_key_violations",
    "SELECT l_orderkey, l_linenumber, COUNT(*) AS occurrences FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1",
)
def _(v: Views) -> DataFrame:
    return tables.unique_key_violations(v.table("lineitem"), ["l_orderkey", "l_linenumber"])


# --- blobs


CHUNK = 1024
BYTES = "CAST(octet_length(encode(content)) AS BIGINT)"


@query(
    "blob_chunk",
    with_views(
        f"""SELECT file_id, n, LEAST({CHUNK}, len - n * {CHUNK}) AS n_bytes, md5(content) AS md5, len AS length FROM (
  SELECT file_id, content, {BYTES} AS len FROM blobs), LATERAL (SELECT unnest(range((len + {CHUNK} - 1) // {CHUNK})) AS n)""",
        "blobs",
    ),
)
def _(v: Views) -> DataFrame:
    chunks = blobs.split(v.blobs, CHUNK).select(
        "file_id", F.col("n").cast("long").alias("n"), F.octet_length("data").cast("long").alias("n_bytes")
    )
    return chunks.join(blobs.describe(v.blobs, CHUNK), "file_id").drop("chunk_size")


def damaged_chunks(v: Views) -> DataFrame:
    """Chunks with a missing, truncated, repeated, overlong, negative, full extra and empty extra chunk in some files."""
    f, n = F.col("file_id") % 10, F.col("n")
    sound = blobs.split(v.blobs, CHUNK).where(~((f == 3) & (n == 0)))
    cut = sound.withColumn(
        "data",
        F.when((f == 5) & (n == 0), F.substring("data", F.lit(1), F.octet_length("data") - 1))
        .when((f == 4) & (n == 0), F.concat("data", F.lit("x").cast("binary")))
        .when((f == 6) & (n == 0), F.concat(F.lit("\x01").cast("binary"), F.substring("data", F.lit(2), F.octet_length("data"))))
        .otherwise(F.col("data")),
    )
    again = sound.where((f == 2) & (n == 0))
    extra = v.blobs.where(f.isin(7, 8)).select(
        "file_id", F.lit(1_000_000).alias("n"), F.when(f == 7, F.lit("x")).otherwise("").cast("binary").alias("data")
    )
    negative = v.blobs.where(f == 9).select("file_id", F.lit(-1).alias("n"), F.lit("").cast("binary").alias("data"))
    return reduce(DataFrame.unionByName, [cut, again, extra, negative])


@query(
    "blob_assemble_verify",
    with_views(
        f"""SELECT file_id, length, status, CASE WHEN status = 'ok' THEN md5(content) END AS content_md5 FROM (
  SELECT file_id, content, {BYTES} AS length,
    CASE WHEN file_id % 10 IN (7, 9) THEN 'extra' WHEN {BYTES} = 0 THEN 'ok' WHEN file_id % 10 = 3 THEN 'missing'
         WHEN file_id % 10 = 5 THEN 'truncated' WHEN file_id % 10 = 2 THEN 'repeated'
         WHEN file_id % 10 = 4 THEN 'overlong' WHEN file_id % 10 = 6 THEN 'corrupt' ELSE 'ok' END AS status FROM blobs)""",
        "blobs",
    ),
)
def _(v: Views) -> DataFrame:
    whole = blobs.contents(blobs.describe(v.blobs, CHUNK), damaged_chunks(v))
    return whole.select("file_id", "length", "status", F.md5("content").alias("content_md5"))


def _revision_sql(direction: str, n: int) -> str:
    return with_views(
        f"""SELECT file_id, filename, upload_date FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY filename
  ORDER BY upload_date {direction}, file_id {direction}) AS i FROM files) WHERE i = {n}""",
        "files",
    )


@query("nth_revision", _revision_sql("DESC", 2))
def _(v: Views) -> DataFrame:
    return tables.nth_revision(v.files, -2)


@query("nth_revision_oldest", _revision_sql("ASC", 1))
def _(v: Views) -> DataFrame:
    return tables.nth_revision(v.files, 0)


@query("list_names", with_views("SELECT DISTINCT filename FROM files", "files"))
def _(v: Views) -> DataFrame:
    return tables.list_names(v.files)
