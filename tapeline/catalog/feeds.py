"""The three index feeds, loaded under batch control and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.catalog.registry import fragment, query
from tapeline.operators.control import BatchControl
from tapeline.plans.feeds import FEEDS, column_name, load_open_batches
from tapeline.sources import panels
from tapeline.staging import scratch, stage

#: What the landing columns of the key hold; every other column holds a number that depends on its place, or nothing.
MEANT = {
    "INDEX NAME": ("concat('Index ', cast(v % 3 AS string))", "'Index ' || (v % 3)"),
    "RIC": ("concat(code, '.AX')", "code || '.AX'"),
    "CURRENT RIC": ("CASE WHEN v % 5 <> 0 THEN concat(code, '.AX') END", "CASE WHEN v % 5 <> 0 THEN code || '.AX' END"),
    "COMMENTS": ("CASE WHEN v % 4 <> 0 THEN concat('note ', cast(v % 5 AS string)) END", "CASE WHEN v % 4 <> 0 THEN 'note ' || (v % 5) END"),
    "DATE OF INDEX": ("cast(load_date AS string)", "load_date::VARCHAR"),
}
KIND = {"sdc": "CASE WHEN v % 2 = 0 THEN 'SDC' ELSE 'SDX' END", "sde": "'SDE'", "sdl": "'SDL'"}


def _value(place: int, name: str, sql: int) -> str:
    if name in MEANT:
        return MEANT[name][sql]
    number = f"(v + {place}) % 50"
    return f"CASE WHEN (v + {place}) % 7 <> 0 THEN {f'CAST({number} AS VARCHAR)' if sql else f'cast({number} AS string)'} END"


def landing(totals: DataFrame, name: str) -> DataFrame:
    """The landing rows of a feed: one batch a month, some rows again in a later batch."""
    columns = [F.expr(_value(i, c, 0)).alias(c) for i, c in enumerate(FEEDS[name].columns)]
    file = F.concat(F.date_format("load_date", "yyyyMMdd"), F.lit("_"), F.expr(KIND[name]), F.lit(".csv")).alias("source_file")
    month = F.date_format("load_date", "yyyyMM")
    first = totals.select(*columns, file, month.alias("batch_id"))
    return first.unionByName(totals.where("v % 4 = 0").select(*columns, file, F.concat(month, F.lit("-again")).alias("batch_id")))


_loaded: dict[tuple[str, str], tuple[BatchControl, str]] = {}


def loaded(spark: SparkSession, sf: str) -> tuple[BatchControl, str]:
    """Control table and root of the feeds, loaded once for all queries of an application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _loaded:
        _loaded[key] = load(spark, sf)
    return _loaded[key]


def load(spark: SparkSession, sf: str) -> tuple[BatchControl, str]:
    """Half of the batches in a first load, others in a second, then one that finds none."""
    totals = panels.totals_table(spark, sf, "week")
    landings = {name: landing(totals, name) for name in FEEDS}
    ids = stage(landings["sdc"].select("batch_id").distinct())
    control, root = BatchControl(spark, scratch(spark, "control")), scratch(spark, "feeds")
    early = F.substring("batch_id", 5, 2).cast("int") % 2 == 0
    for batches in (ids.where(early), ids.where("substring(batch_id, 1, 4) < '1998'"), ids.where("false")):
        control.announce(batches)
        load_open_batches(spark, control, landings, root)
    return control, root


def _sql(name: str) -> str:
    feed = FEEDS[name]
    columns = [(column_name(c), _value(i, c, 1)) for i, c in enumerate(feed.columns)]
    columns = [(c, f"coalesce({v}, '')" if c in feed.blanks else v) for c, v in columns]
    if feed.typed:
        columns.append(("info_type", KIND[name]))
    rest = ", ".join(f"{c} NULLS FIRST" for c, _ in columns if c not in feed.keys)
    rows = f"SELECT {', '.join(f'{v} AS {c}' for c, v in columns)}, load_date AS record_date FROM w_base WHERE month(load_date) % 2 = 0 OR year(load_date) < 1998"
    early = f"row_number() OVER (PARTITION BY {', '.join(feed.keys)} ORDER BY {rest}) = 1"
    return f"SELECT * FROM ({rows}) QUALIFY {early}"


def _register(name: str, title: str) -> None:
    @query(title, _sql(name))
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return spark.read.parquet(f"{loaded(spark, sf)[1]}/{name}").drop("sys_load_time")


for _name, _title in (("sdc", "index_constituents_loaded"), ("sde", "index_actions_loaded"), ("sdl", "index_levels_loaded")):
    _register(_name, _title)

fragment("feed_batch", "SELECT DISTINCT strftime(load_date, '%Y%m') || again AS batch_id, month(load_date) % 2 = 0 OR year(load_date) < 1998 AS announced FROM w_base, (VALUES (''), ('-again')) t(again) WHERE again = '' OR v % 4 = 0")


@query("batch_control_state", "SELECT batch_id, TRUE AS is_executed, TRUE AS has_time FROM feed_batch WHERE announced")
def batch_control_state(spark: SparkSession, sf: str) -> DataFrame:
    control, _ = loaded(spark, sf)
    return control.read().select("batch_id", "is_executed", F.col("executed_at").isNotNull().alias("has_time"))
