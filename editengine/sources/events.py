"""Adapter: the ``events`` table as raw page-edit events.

Thirty days are squeezed into three so that windows and sessions fill. The expressions decide which
rows the engine sees and are shared, word for word, with the checking SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# First second of the table, and one expression per raw column. ``k`` is the number
# inside ``props``; ``epoch_s`` is the event's epoch second as a double. The null rule of ``wiki`` stands
# outside its name rule, so that a filter on null wikis reduces to the former.
ORIGIN = 1704067200
RAW_COLUMNS = {
    "id": "event_id",
    "ts_s": f"cast({ORIGIN} + floor((epoch_s - {ORIGIN}) / 10) as bigint)",
    "wiki": "case when event_id%89=88 then null else case when k<50 then 'enwiki' when k<65 then 'dewiki'"
            " when k<75 then 'frwiki' when k<82 then 'commonswiki' when k<88 then 'wikidatawiki'"
            " when k<93 then 'zh_min_nanwiki' when k<97 then 'be_x_oldwiki' else 'eswiki' end end",
    "type": "case when event_id%97=96 then 'external' when event_type in ('click','view','purchase') then 'edit'"
            " when event_type='signup' and event_id%2=0 then 'new' when event_type='signup' then 'categorize'"
            " else 'log' end",
    "title": "concat('Page_', cast(cast(floor(k*k*k*k/1000000) as int) as STR))",
    "usr": "case when user_id%4=1 then concat('10.0.', cast(cast(floor(user_id/256) as int) as STR), '.',"
           " cast(user_id%256 as STR)) else concat('User_', cast(user_id as STR)) end",
    "bot": "case when event_id%101=100 then null else user_id%5=0 end",
    "minor": "event_id%3=0",
    "namespace": "cast(case when event_id%4=3 then k%16 else 0 end as int)",
    "byte_delta": "cast(case when event_type='signup' or event_id%53=52 then null"
                  " else round((value-35)*100) end as int)",
    "comment": "case when event_id%11=10 then null"
               " else repeat('x', cast(floor(value*(case when user_id%5=0 then 1 else 3 end)) as int)) end",
    "arrival_ms": "ts_s*1000 + (event_id%9000 - 500)",
}
TRUNCATED = "id%211=210"
BLANKED = "id%223=222"
PAGE_SIZE = 5000


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """The same table as a file stream; ``max_files`` limits one trigger."""
    reader = spark.readStream.schema(read_events(spark, sf_dir).schema).option("pathGlobFilter", "events.parquet")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(sf_dir)


def raw_events(events: DataFrame) -> DataFrame:
    """Un-enriched feed records, plus ``ingestion_ts`` as the arrival time. Batch or stream."""
    named = events.selectExpr(
        "*",
        "cast(regexp_extract(props, '([0-9]+)', 1) as int) as k",
        "unix_micros(cast(ts as timestamp)) / 1000000 as epoch_s",
    )
    early = {n: e.replace("STR", "string") for n, e in RAW_COLUMNS.items() if n != "arrival_ms"}
    shaped = named.select(*[F.expr(e).alias(n) for n, e in early.items()], F.col("event_id"))
    return shaped.select(
        "id",
        "type",
        "wiki",
        "title",
        F.concat(F.lit("/page/"), "title").alias("title_url"),
        "namespace",
        F.col("usr").alias("user"),
        "bot",
        "minor",
        F.col("ts_s").alias("timestamp"),
        "comment",
        F.concat("wiki", F.lit(".example.org")).alias("server_name"),
        F.struct(
            F.lit(PAGE_SIZE).alias("old"), (F.lit(PAGE_SIZE) + F.col("byte_delta")).alias("new")
        ).alias("length"),
        F.expr(RAW_COLUMNS["arrival_ms"]).alias("ingestion_ts"),
    )


def raw_json(raw: DataFrame, rejects: bool = True) -> DataFrame:
    """One JSON text ``value`` per event; with ``rejects`` some are cut in half or blank."""
    record = F.to_json(F.struct(*raw.columns))
    if rejects:
        half = F.substring(record, F.lit(1), F.floor(F.length(record) / 2).cast("int"))
        record = F.when(F.expr(BLANKED), F.lit("")).when(F.expr(TRUNCATED), half).otherwise(record)
    return raw.select(record.alias("value"))
