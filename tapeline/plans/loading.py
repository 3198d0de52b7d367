"""Text landing rows to typed tables. Each loader returns the rows to insert; keys are noted.

`latest_only` keeps the newest load day, as a scheduled load does; without it the whole
landing history is cleaned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.functions.numeric import dec, ratio
from tapeline.functions.series import by
from tapeline.functions.text import between, blank, first_filled, magnitude
from tapeline.operators.joins import forward_return
from tapeline.operators.rows import latest_batch, project
from tapeline.operators.tables import open_batches
from tapeline.operators.windows import latest_per_key, rank_ties
from tapeline.sources.files import file_info_type, file_record_date
from tapeline.sources.panels import EXCHANGE_SUFFIX, MARKET_UTC_HOURS, with_typical

PRICE = "decimal(12,3)"


def market_time(utc_text: Column, hours: int = MARKET_UTC_HOURS) -> Column:
    """UTC text `yyyy-MM-ddTHH:mm:ssZ` on the market clock (a fixed offset, no daylight saving)."""
    ts = F.regexp_replace(utc_text, "Z$", "").try_cast("timestamp_ntz")
    return ts + F.expr(f"INTERVAL '{hours}' HOUR")


def typed_ticks(web_ticker: DataFrame) -> DataFrame:
    """code, tick_price, tick_ts (market clock) of text ticks."""
    return web_ticker.select(
        "code", F.col("tick_price").try_cast("decimal(14,4)").alias("tick_price"), market_time(F.col("tick_time")).alias("tick_ts")
    )


def fresh_quotes(web_ticker: DataFrame) -> DataFrame:
    """(code, load_date) whose newest tick is of the load day itself; stale quotes fall out."""
    ticks = web_ticker.select("code", market_time(F.col("tick_time")).cast("date").alias("tick_day"), F.col("sys_load_time").cast("date").alias("load_date"))
    newest = ticks.groupBy("code", "load_date").agg(F.max("tick_day").alias("tick_day"))
    return newest.where(F.col("tick_day") == F.col("load_date")).select("code", "load_date")


def quotes_update(web_quote: DataFrame, web_ticker: DataFrame) -> DataFrame:
    """Validated typed quotes; key (code, load_date)."""

    def price(name: str, type_: str = PRICE) -> Column:
        return blank(F.col(name)).try_cast(type_)

    typed = web_quote.select(
        "code",
        F.col("sys_load_time").cast("date").alias("load_date"),
        price("open_price").alias("open"),
        price("low_price").alias("low"),
        price("high_price").alias("high"),
        price("close_price").alias("close"),
        price("previous_close").alias("pclose"),
        price("volume", "long").alias("volume"),
        price("turnover", "decimal(20,3)").alias("turnover"),
        price("market_cap", "decimal(22,2)").alias("market_cap"),
        price("ask").alias("ask"),
        price("bid").alias("bid"),
    )
    return with_typical(typed.join(fresh_quotes(web_ticker), ["code", "load_date"], "left_semi"))


def newest_load(df: DataFrame, key: str, ts: str, ties: bool = False, date: str = "load_date") -> DataFrame:
    """The newest load of each key and day. The clock time orders loads; text order breaks ties, or with `ties` all rows of that time stay."""
    if ties:
        return rank_ties(df.withColumn(date, F.col(ts).cast("date")), [key, date], F.desc(ts), "_rank").where("_rank = 1").drop("_rank")
    others = [F.desc_nulls_last(c) for c in sorted(df.columns) if c not in (key, ts)]
    return latest_per_key(df.withColumn(date, F.col(ts).cast("date")), [key, date], [F.desc(ts), *others])


def finance_update(web_finance: DataFrame, latest_only: bool = False, fill: int = 4) -> DataFrame:
    """Typed statements, earnings ratio filled from up to four earlier loads; key (code, load_date).

    Rows that have no earnings ratio even then are left out.
    """
    rows = newest_load(web_finance, "code", "sys_load_time")
    low, high, mid = (blank(F.col(f"target_{x}_price")).try_cast(PRICE) for x in ("low", "high", "median"))
    typed = rows.select(
        "code",
        "load_date",
        first_filled(PRICE, F.col("market_open"), F.col("regular_market_open")).alias("open"),
        first_filled(PRICE, F.col("market_previous_close"), F.col("regular_market_previous_close")).alias("previous_close"),
        first_filled(PRICE, F.col("market_price"), F.col("current_price")).alias("close"),
        first_filled("long", F.col("market_volume"), F.col("regular_market_volume")).alias("volume"),
        blank(F.col("forward_pe"), "Infinity").try_cast("decimal(8,1)").alias("_pe"),
        F.when(high != low, dec(ratio(mid - low, high - low), 3, 9)).otherwise(F.lit(0).cast("decimal(9,3)")).alias("target_ratio"),
    )
    filled = typed.withColumn("forward_pe", F.last("_pe", ignorenulls=True).over(by().rowsBetween(-fill, 0)))
    out = filled.where(F.col("forward_pe").isNotNull()).drop("_pe")
    return latest_batch(out, "load_date") if latest_only else out


RATINGS = ("buy", "overweight", "hold", "underweight", "sell")


def _rating_score(counts: list[Column]) -> tuple[Column, Column]:
    total = sum(counts[1:], counts[0])
    weighted = sum((c * (i + 1) for i, c in enumerate(counts[1:], 1)), counts[0])
    return total, weighted


def consensus_update(web_consensus: DataFrame, latest_only: bool = False) -> DataFrame:
    """Analyst count (more than 3), mean rating 1..5 and target ratio; key (code, load_date)."""
    rows = latest_batch(web_consensus, "sys_load_time") if latest_only else web_consensus
    complete = F.lit(True)
    for c in RATINGS:
        complete = complete & (F.col(c) != "")
    for c in ("high", "median", "low", "average"):
        complete = complete & F.col(c).startswith("$") & (F.length(c) > 1)

    def dollars(name: str) -> Column:
        return F.expr(f"substring({name}, 2)").try_cast("decimal(12,2)")

    typed = rows.where(complete).select(
        F.trim("code").alias("code"),
        "sys_load_time",
        *[F.col(c).try_cast("decimal(12,1)").alias(c) for c in RATINGS],
        *[dollars(c).alias(c) for c in ("high", "median", "low")],
    )
    ordered = typed.where((F.col("high") > F.col("median")) & (F.col("median") > F.col("low")))
    newest = newest_load(ordered, "code", "sys_load_time")
    total, weighted = _rating_score([F.col(c) for c in RATINGS])
    return newest.where(total > 3).select(
        "code",
        "load_date",
        F.round(total).cast("long").alias("analysis"),
        dec(ratio(weighted, total), 3, 5).alias("weight"),
        dec(ratio(F.col("median") - F.col("low"), F.col("high") - F.col("low")), 3, 5).alias("target_ratio"),
    )


def consensus_or_default(web_consensus: DataFrame, default: int = 5) -> DataFrame:
    """Zero-safe rating of every load: blanks count 0, and a code without ratings scores `default`."""
    counts = [F.coalesce(blank(F.col(c)).try_cast("decimal(12,1)"), F.lit(0).cast("decimal(12,1)")) for c in RATINGS]
    total, weighted = _rating_score(counts)

    def dollars(name: str) -> Column:
        return F.expr(f"substring({name}, 2)").try_cast("decimal(12,2)")

    return web_consensus.select(
        F.concat(F.trim("code"), F.lit(EXCHANGE_SUFFIX)).alias("code"),
        F.col("sys_load_time").cast("date").alias("load_date"),
        F.when(total != 0, dec(ratio(weighted, total), 3, 5)).otherwise(F.lit(default).cast("decimal(5,3)")).alias("adv_ratio"),
        total.alias("num"),
        *[dollars(c).alias(c) for c in ("high", "median", "low", "average")],
    )


def shorts_update(web_short: DataFrame, latest_only: bool = False, ties: bool = False) -> DataFrame:
    """Latest short position per code and day; key (code, load_date). With `ties` all rows of the latest load time are kept."""
    rows = latest_batch(web_short, "sys_load") if latest_only else web_short
    newest = newest_load(rows, "product_code", "sys_load", ties)
    return newest.select(
        F.trim("product_code").alias("code"),
        "load_date",
        blank(F.col("short_position")).try_cast("long").alias("short_position"),
        blank(F.col("total_in_issue")).try_cast("long").alias("total_in_issue"),
        blank(F.col("reported_position")).try_cast("decimal(31,8)").alias("reported_position"),
    )


def analysis_update(web_analysis: DataFrame, latest_only: bool = False) -> DataFrame:
    """Money text with magnitude suffixes to numbers; key (code, load_date)."""
    rows = latest_batch(web_analysis, "sys_load_time") if latest_only else web_analysis

    def number(name: str) -> Column:
        return F.regexp_replace(blank(F.col(name), "-"), ",", "").try_cast("decimal(18,4)")

    return rows.select(
        "code",
        F.col("sys_load_time").cast("date").alias("load_date"),
        magnitude(F.col("revenue"), keep_zero=True).alias("revenue"),
        magnitude(F.col("net_income")).alias("net_income"),
        number("net_profit_margin").alias("net_profit_margin"),
        magnitude(F.col("ebitda")).alias("ebitda"),
        number("forward_pe").alias("fpe"),
        number("reco_price_target").alias("reco_price"),
        "average_recommendation",
    )


def announcements_update(web_announcement: DataFrame, latest_only: bool = False) -> DataFrame:
    """Distinct price-sensitive announcement times; key (code, pub_datetime)."""
    rows = latest_batch(web_announcement, "sys_load_time") if latest_only else web_announcement
    at = F.try_to_timestamp(F.col("pub_time"), F.lit("dd/MM/yyyy hh:mm a")).cast("timestamp_ntz")
    return rows.where(F.col("is_price_sens") == "true").select("code", at.alias("pub_datetime")).distinct()


def forex_rows(snapshot: DataFrame) -> DataFrame:
    """Four fields of a flat `key:value,` text, whole seconds."""
    info = F.col("info")
    return snapshot.select(
        "batch",
        between(info, "instrument").alias("instrument"),
        F.date_trunc("second", between(info, "time").try_cast("timestamp_ntz")).cast("timestamp_ntz").alias("snapshot_on_gtc"),
        between(info, "closeoutBid").try_cast("decimal(18,6)").alias("bid"),
        between(info, "closeoutAsk").try_cast("decimal(18,6)").alias("ask"),
        "sys_dt",
    )


def drained(queue: DataFrame, taken: DataFrame, ts: str = "sys_dt") -> DataFrame:
    """What stays in the queue after rows up to the newest taken one were routed."""
    return queue.where(F.col(ts) > taken.agg(F.max(ts)).scalar())


def code_list(full_list: DataFrame, key: str = "code", stamp: str = "record_dts") -> DataFrame:
    """Codes whose newest record is of the newest record day overall."""
    day = F.col(stamp).cast("date")
    newest = full_list.groupBy(key).agg(F.max(day).alias("_day"))
    return newest.where(F.col("_day") == full_list.agg(F.max(day)).scalar()).select(key)


def index_rows(landing: DataFrame, control: DataFrame, columns: dict[str, str], blanks: list[str] | None = None) -> DataFrame:
    """Rows of unexecuted batches with spaces-in-names mapped, file date and file type added.

    `blanks` lists key columns whose NULL must become ''.
    """
    pending = open_batches(landing, control)
    mapped = project(pending, columns | {"source_file": "source_file"})
    out = mapped.withColumns({"info_type": file_info_type(F.col("source_file")), "record_date": file_record_date(F.col("source_file"))})
    for c in blanks or []:
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit("")))
    return out.drop("source_file")


def sentiment_agg(sentiment: DataFrame) -> DataFrame:
    """Mean sentiment and number of titles per code and publish day."""
    return sentiment.groupBy("code", "load_date").agg(F.avg("sentiment").alias("sentiment"), F.count("*").alias("weight"))


def first_titles(sentiment: DataFrame) -> DataFrame:
    """First load of each title, kept only when it was loaded on its publish day (epoch text)."""
    typed = sentiment.withColumn("publish_date", F.timestamp_seconds(F.substring("publish_time", 1, 10).try_cast("long")).cast("date"))
    first = latest_per_key(typed, ["code", "publish_title"], [F.asc("sys_load_time"), F.asc("publish_time")])
    return first.where(F.col("sys_load_time").cast("date") == F.col("publish_date")).select("code", "publish_title", F.col("publish_date").alias("load_date"))


def build_transactions(finance: DataFrame, shorts: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Statements with short positions and sentiment; missing sentiment is 0."""
    keys = ["code", "load_date"]
    return finance.join(shorts, keys, "left").join(sentiment, keys, "left").fillna({"sentiment": 0.0, "weight": 0})


def merge_history(finance: DataFrame, short: DataFrame, consensus: DataFrame, old: DataFrame) -> DataFrame:
    """Three cleaned feeds joined on code and day, united (distinct) with an older export."""
    keys = ["code", "load_date"]
    new = finance.join(short, keys, "left").join(consensus, keys, "left").select(*old.columns)
    return old.unionByName(new).distinct()


def history_prices(hist: DataFrame) -> DataFrame:
    """Text history: exchange suffix added, `MM/dd/yy` dates, three decimals, whole volume."""
    price = [F.col(c).try_cast("decimal(12,3)").alias(f"hist_{c}") for c in ("open", "high", "low", "close")]
    volume = F.floor(F.col("volume").try_cast("decimal(18,3)")).cast("long").alias("hist_volume")
    day = F.try_to_date("date", "MM/dd/yy")
    # Two-digit years from 70 on belong to the last century.
    day = F.when(F.year(day) >= 2070, F.add_months(day, -1200)).otherwise(day)
    return hist.select(F.concat("code", F.lit(EXCHANGE_SUFFIX)).alias("code"), day.alias("record_date"), *price, volume)


def general(export: DataFrame, hist: DataFrame, drop_codes: list[str], drop_dates: list[str]) -> DataFrame:
    """Export rows with history prices preferred, unwanted codes and days removed, dates indexed."""
    from tapeline.plans.daily import calendar

    pairs = {
        "market_open": "hist_open",
        "market_price": "hist_close",
        "market_day_high": "hist_high",
        "market_day_low": "hist_low",
        "market_volume": "hist_volume",
    }
    rows = export.join(history_prices(hist), ["code", "record_date"]).where(~F.col("code").isin(*drop_codes))
    rows = rows.where(~F.col("record_date").isin(*[F.lit(d).cast("date") for d in drop_dates]))
    rows = rows.withColumns({a: F.coalesce(F.col(b), F.col(a)) for a, b in pairs.items()}).drop(*pairs.values())
    return rows.join(calendar(rows, "record_date").select("record_date", "date_index"), "record_date")


def general_performance(transactions: DataFrame, ahead: int = 25) -> DataFrame:
    """Price of each row and of the same code `ahead` indexed dates later."""
    return forward_return(transactions, "code", "date_index", ahead, "market_price", "market_price").select("code", "date_index", "start_price", "end_price")


def etl_log(batches: DataFrame, landings: dict[str, DataFrame], unkeyed: dict[str, DataFrame], day: Column) -> DataFrame:
    """Records per job on one day. Keyed landings count by batch, the others go to one job name."""
    today = batches.where(F.col("start_time").cast("date") == day)
    counts = None
    for df in landings.values():
        per = df.where(F.col("sys_load_time").cast("date") == day).groupBy("batch_id").agg(F.count("*").alias("cnt"))
        counts = per if counts is None else counts.unionByName(per)
    per_batch = counts.groupBy("batch_id").agg(F.max("cnt").alias("cnt"))
    out = today.join(per_batch, "batch_id", "left")
    records = F.col("cnt")
    for job, df in unkeyed.items():
        total = df.where(F.col("sys_load_time").cast("date") == day).agg(F.count("*")).scalar()
        records = F.coalesce(records, F.when(F.col("job_name") == job, total))
    return out.groupBy("job_name").agg(F.sum(F.coalesce(records, F.lit(0))).alias("records"), F.min("start_time").alias("started"))
