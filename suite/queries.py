
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barframe.fixed_values import CAP_COLUMN, CATEGORY_ORDER
from barframe.functions import text as tx
from barframe.operators import alerts as al
from barframe.operators import commands as cm
from barframe.operators import memberships as mb
from barframe.operators import rows, screens
from barframe.operators import sentiment as st
from barframe.operators import series as se
from barframe.operators import smoothing as sm
from barframe.operators import tables as tb
from barframe.operators.blocks import row_ordinal as number_rows
from barframe.operators.align import align_by_position, align_by_time, attach_scalar
from barframe.operators.report import binary_measures, classification_report
from barframe.plans.activity import activity_table
from barframe.plans.constituents import constituent_records, membership_table
from barframe.plans.features import add_returns, feature_table
from barframe.plans.trend import predict, results_row, score_latest, train_and_predict, train_trend_model, trend_job
from barframe.session import shared_path, stored
from barframe.sources import bars as br
from barframe.sources.records import all_records, extract_records, record_keys, split_document
from barframe.sources.record_files import join_parts, read_membership_records, read_snapshot_records
from barframe.sources.sinks import read_runs, write_activity, write_memberships, write_outbox
from barframe.streaming.bars import bars_to_end, stream_bars, stream_once
from barframe.streaming.pull import land_updates, pulled_updates, pulls_at_once
from barframe.streaming.updates import Registry, UpdateJob, read_outbox, read_processed, read_updates, updates_stream
from suite import tables as t

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Returns are single divisions, equal to the last bit; six places would leave ties to the rounding rule.
RETURN_PLACES = 9
POSITIVE, NEGATIVE = ["ing", "positive"], ["sell-off", "ent", "st"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, *cols: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in cols})


# ---- bars and series ------------------------------------------------------------------


@query
def bars_hourly(spark, sf):
    return t.plain_ts(t.bars(spark, sf, "1 hour"))


@query
def bars_minute(spark, sf):
    return t.plain_ts(t.bars(spark, sf))


@query
def named_bars(spark, sf):
    return t.plain_ts(t.named(spark, sf))


@query
def recent_bars(spark, sf):
    """The event table read as finished bars of two symbols, the last seven days."""
    events = t.table(spark, sf, "events").select(
        F.col("event_type").alias("symbol"), "ts", *[F.col("value").alias(c) for c in br.OHLCV]
    )
    path = shared_path(spark, "landed")
    events.write.parquet(path)
    return t.plain_ts(br.read_bars(spark, path, ["click", "view"], days=7))


def _bar_table(spark, sf):
    path = shared_path(spark, "bars")
    name = f"bars_{path.rsplit('-', 1)[1]}"
    br.write_bar_table(t.bars(spark, sf), name, path, buckets=8)
    return name


@query
def bar_table_recent(spark, sf):
    """Seven days back from the latest bar, out of a table by date, bucketed by symbol and day."""
    return t.plain_ts(br.read_bar_table(spark, _bar_table(spark, sf), ["click", "view"]).drop("day"))


@query
def bar_table_ordinals(spark, sf):
    """All bars of that table, numbered without an exchange of the rows."""
    bars = br.read_bar_table(spark, _bar_table(spark, sf), days=None)
    return t.plain_ts(number_rows(bars, cut="day", previous={"before": "close"}).select("symbol", "ts", "rn", "before"))


@query
def row_ordinal(spark, sf):
    return t.plain_ts(t.numbered_bars(spark, sf).select("symbol", "ts", "rn"))


SMALL_BLOCK = 128  # rows of a block in the queries that cross many blocks


@query
def row_ordinal_gaps(spark, sf):
    """Ticks of which some have no time: those have no place and change no mean."""
    ticks = t.table(spark, sf, "events").select(
        F.col("event_type").alias("symbol"), "event_id", F.when(F.col("event_id") % 7 != 0, F.col("ts")).alias("ts"), "value"
    )
    numbered = stored(number_rows(ticks, tie_breakers=["event_id"]))
    out = sm.ewma(numbered, {"mean": sm.Ewm("value", 0.5)}, size=SMALL_BLOCK)
    return rounded(out.select("symbol", "event_id", "rn", "mean"), "mean")


def _change(spark, sf, n, **options):
    out = se.pct_change(t.stored_bars(spark, sf), n=n, out="change", **options).select("symbol", "ts", "change")
    return t.plain_ts(rounded(out, "change", places=RETURN_PLACES))


@query
def pct_change_1(spark, sf):
    return _change(spark, sf, 1)


@query
def pct_change_60(spark, sf):
    return _change(spark, sf, 60)


@query
def pct_change_60_blocks(spark, sf):
    return _change(spark, sf, 60, size=SMALL_BLOCK)


def _target(spark, sf, **options):
    return t.plain_ts(se.forward_target(t.stored_bars(spark, sf), **options).select("symbol", "ts", "target"))


@query
def forward_target(spark, sf):
    return _target(spark, sf)


@query
def forward_target_blocks(spark, sf):
    return _target(spark, sf, size=SMALL_BLOCK)


def _deviation(spark, sf, **options):
    out = se.rolling_std(t.stored_bars(spark, sf), **options).select("symbol", "ts", "volatility")
    return t.plain_ts(rounded(out, "volatility"))


@query
def rolling_std_30(spark, sf):
    return _deviation(spark, sf)


@query
def rolling_std_30_blocks(spark, sf):
    return _deviation(spark, sf, size=SMALL_BLOCK)


def _mean(spark, sf, **options):
    out = sm.ewma(stored(t.numbered_bars(spark, sf)), {"mean": sm.Ewm.span("close", 12)}, **options)
    return t.plain_ts(rounded(out.select("symbol", "ts", "mean"), "mean"))


@query
def ewma_span12(spark, sf):
    return _mean(spark, sf)


@query
def ewma_span12_blocks(spark, sf):
    return _mean(spark, sf, size=SMALL_BLOCK)


def _rsi(spark, sf, **options):
    out = sm.rsi(stored(t.numbered_bars(spark, sf)), **options).select("symbol", "ts", "rsi")
    return t.plain_ts(rounded(out, "rsi"))


@query
def rsi_14(spark, sf):
    return _rsi(spark, sf)


@query
def rsi_14_blocks(spark, sf):
    return _rsi(spark, sf, size=SMALL_BLOCK)


def _macd(spark, sf, **options):
    out = sm.macd_diff(stored(t.numbered_bars(spark, sf)), **options).select("symbol", "ts", "macd_diff")
    return t.plain_ts(rounded(out, "macd_diff"))


@query
def macd_diff(spark, sf):
    return _macd(spark, sf)


@query
def macd_diff_blocks(spark, sf):
    return _macd(spark, sf, size=SMALL_BLOCK)


@query
def returns_and_indicators(spark, sf):
    return _returns(spark, sf)


@query
def returns_and_indicators_blocks(spark, sf):
    return _returns(spark, sf, size=SMALL_BLOCK)


def _returns(spark, sf, **options):
    out = add_returns(stored(t.numbered_bars(spark, sf)), **options)
    means = ("rsi", "macd", "volatility")
    out = rounded(out.select("symbol", "ts", "target", "return", "return_1h", *means), *means)
    return t.plain_ts(rounded(out, "return", "return_1h", places=RETURN_PLACES))


@query
def session_parts(spark, sf):
    return se.session_parts(t.table(spark, sf, "events").select("event_id", "ts"))


_ALIGNED = {"c_close": ("click", "close"), "v_close": ("view", "close"), "p_close": ("purchase", "close")}


@query
def align_position(spark, sf):
    return t.plain_ts(align_by_position(t.stored_bars(spark, sf), "click", _ALIGNED))


@query
def align_time(spark, sf):
    return t.plain_ts(align_by_time(t.bars(spark, sf, "1 hour"), "click", _ALIGNED))


@query
def align_asof(spark, sf):
    return t.plain_ts(align_by_time(t.bars(spark, sf), "click", _ALIGNED, tolerance="20 minutes"))


def _score(spark, sf):
    return st.sentiment_score(st.html_nodes(t.table(spark, sf, "pages").select("page_id", "html"), css_class=None))


def _features(spark, sf, **options):
    bars = stored(number_rows(stored(t.named(spark, sf)), previous={sm.BEFORE: "close"}))
    out = feature_table(bars, _score(spark, sf), present=list(t.INSTRUMENTS), **options)
    returns = [c for c in out.columns if "_Return" in c]
    means = [c for c, d in out.dtypes if d == "double" and c not in returns]
    return t.plain_ts(rounded(rounded(out, *means), *returns, places=RETURN_PLACES))


@query
def feature_table_raw(spark, sf):
    return _features(spark, sf, complete=False)


@query
def feature_table_complete(spark, sf):
    return _features(spark, sf)


@query
def feature_table_blocks(spark, sf):
    return _features(spark, sf, size=SMALL_BLOCK)


@query
def last_fold(spark, sf):
    split = rows.time_series_split(t.stored_bars(spark, sf).select("symbol", "ts", "close"), keys=["symbol"])
    return t.plain_ts(split.select("symbol", "ts", "rn", "fold", "part"))


@query
def all_folds(spark, sf):
    split = rows.time_series_split(t.stored_bars(spark, sf).select("symbol", "ts"), fold=None, gap=60, keys=["symbol"])
    return t.plain_ts(split.select("symbol", "ts", "rn", "fold", "part"))


@query
def latest_row(spark, sf):
    return t.plain_ts(rows.latest_row(t.bars(spark, sf), ["symbol"]))


@query
def latest_row_overall(spark, sf):
    return t.plain_ts(rows.latest_row(t.table(spark, sf, "events").select("event_id", "ts", "event_type"), tie_breakers=["event_id"]))


@query
def data_points(spark, sf):
    return rows.data_points(rows.drop_incomplete(t.table(spark, sf, "events")))


@query
def scalar_on_all_rows(spark, sf):
    events = t.table(spark, sf, "events").select("event_id")
    return attach_scalar(events, _score(spark, sf), "sentiment")


def _event_stream(spark, sf):
    schema = t.table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


@query
def streamed_bars(spark, sf):
    """All bars of an input that has ended."""
    return t.plain_ts(bars_to_end(spark, t.as_ticks(_event_stream(spark, sf)), "1 hour"))


@query
def streamed_bars_closing(spark, sf):
    """The same with a watermark: bars leave as it passes them, the windows open at the end come last."""
    return t.plain_ts(bars_to_end(spark, t.as_ticks(_event_stream(spark, sf)), "1 hour", "1 day"))


@query
def streamed_bars_so_far(spark, sf):
    """The bars that the watermark has passed."""
    return t.plain_ts(stream_once(spark, stream_bars(t.as_ticks(_event_stream(spark, sf)), "1 hour", "2 hours")))


# ---- headlines and quality ------------------------------------------------------------


@query
def headlines(spark, sf):
    return st.html_nodes(t.table(spark, sf, "pages").select("page_id", "html"), css_class=None)


@query
def headlines_by_pattern(spark, sf):
    return st.pattern_html_nodes(t.table(spark, sf, "pages").select("page_id", "html"), css_class=None)


@query
def headlines_of_class(spark, sf):
    """Only the anchors of the headline class, which those to a path with a small t are given."""
    marked = F.replace("html", F.lit('<a href="/t'), F.lit('<a class="x DY5T1d" href="/t'))
    return st.html_nodes(t.table(spark, sf, "pages").select("page_id", marked.alias("html")))


@query
def headline_sentiment(spark, sf):
    return _score(spark, sf)


@query
def sentiment_score(spark, sf):
    return st.sentiment_score(t.table(spark, sf, "documents"), keys=["source"])


@query
def sentiment_words(spark, sf):
    return st.sentiment_score(t.table(spark, sf, "documents"), keys=["source"], positive=POSITIVE, negative=NEGATIVE)


@query
def class_report(spark, sf):
    return rounded(classification_report(t.quality_labels(spark, sf)), "precision", "recall", "f1_score")


@query
def class_measures(spark, sf):
    out = binary_measures(t.quality_labels(spark, sf))
    return rounded(out, *[c for c, d in out.dtypes if d == "double"])


@query
def trend_bands(spark, sf):
    return t.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", tx.trend_band(F.col("l_discount") * 10).alias("trend")
    )


# ---- screens --------------------------------------------------------------------------


def _screens(spark, sf):
    """All five ranked lists from one aggregate of the trades per symbol and time."""
    daily = stored(
        t.trades(spark, sf).groupBy("symbol", "ts").agg(F.sum(F.col("price") * F.col("qty")).alias("value"), F.sum("qty").alias("volume"), F.max("price").alias("close")),
        "daily",
    )
    active = daily.groupBy("symbol").agg(F.sum("value").alias("value"), F.sum("volume").alias("volume"))
    periods = daily.groupBy("symbol", F.date_trunc("month", "ts").alias("period")).agg(F.sum("volume").alias("volume"))
    changes = screens.close_change(daily)
    by_value = screens.ranked_screen(active, "value").select("symbol", "value")
    by_volume = screens.ranked_screen(active, "volume").select("symbol", "volume")
    grown = screens.ranked_screen(screens.volume_gain(periods), "gain").select("symbol", "gain")
    names = CATEGORY_ORDER
    return screens.union_categories(
        screens.tag_reason(rounded(by_value, "value", places=2), names[0]),
        screens.tag_reason(rounded(grown, "gain"), names[1]),
        screens.tag_reason(rounded(by_volume, "volume", places=2), names[2]),
        screens.tag_reason(rounded(screens.ranked_screen(changes, "change"), "change"), names[3]),
        screens.tag_reason(rounded(screens.ranked_screen(changes, "change", ascending=True), "change"), names[4]),
    )


def _closes_change(spark, sf):
    closes = t.trades(spark, sf).groupBy("symbol", "ts").agg(F.max("price").alias("close"))
    return screens.close_change(closes)


@query
def union_screens(spark, sf):
    return _screens(spark, sf)


@query
def reasons_by_stock(spark, sf):
    out = screens.reasons_by_stock(_screens(spark, sf))
    return out.withColumn("reasons", F.array_join("reasons", ", "))


@query
def ranked_screen_value(spark, sf):
    top = screens.ranked_screen(screens.activity_by_symbol(t.trades(spark, sf)), "value", 20)
    return rounded(top, "value", "volume", places=2)


@query
def ranked_screen_by_flag(spark, sf):
    active = screens.activity_by_symbol(t.trades(spark, sf), ["l_returnflag", "symbol"])
    return rounded(screens.ranked_screen(active, "volume", 5, keys=["l_returnflag"]), "value", "volume", places=2)


@query
def volume_gainers(spark, sf):
    periods = (
        t.trades(spark, sf)
        .groupBy("symbol", F.date_trunc("month", "ts").alias("period"))
        .agg(F.sum("qty").alias("volume"))
    )
    return rounded(screens.ranked_screen(screens.volume_gain(periods), "gain"), "volume", "mean_volume", "gain")


@query
def top_gainers(spark, sf):
    return rounded(screens.ranked_screen(_closes_change(spark, sf), "change"), "change")


@query
def top_losers(spark, sf):
    return rounded(screens.ranked_screen(_closes_change(spark, sf), "change", ascending=True), "change")


@query
def record_key_list(spark, sf):
    return t.table(spark, sf, "events").select("event_id", record_keys("props").alias("relavant_columns"))


@query
def extracted_records(spark, sf):
    return extract_records(t.snapshot_docs(spark, sf))


@query
def split_documents(spark, sf):
    return split_document(t.snapshot_docs(spark, sf))


SLICE = 64 << 20  # bytes of lines that one task sorts, about
SLICES = 200  # so many at most: up to there a shuffle holds no rows back in its writing tasks
LINE = 128  # bytes of a line besides its text, about


def _land_documents(records, path, ends):
    """One document per key of ``ends (key, opening, closing)``, one file each: ``records (key, place, raw)`` a line each, in
    order of their place, between the opening and the closing text. Places should differ, also those of equal records.

    A document may be any part of all lines, so tasks sort slices of them, whatever their keys, and the slices of a document
    are then joined to its file piece by piece. A task never holds a document.
    """
    lines = records.select("key", F.lit(1).alias("end"), "place", F.concat(F.lit(","), "raw").alias("value"))
    first = ends.select("key", F.lit(0).alias("end"), F.concat("opening", F.lit("null")).alias("value"))
    last = ends.select("key", F.lit(2).alias("end"), F.col("closing").alias("value"))
    whole = lines.unionByName(first, allowMissingColumns=True).unionByName(last, allowMissingColumns=True)
    size = whole.agg(F.sum(F.coalesce(F.octet_length("value"), F.lit(0)) + F.lit(LINE).cast("bigint"))).first()[0] or 0
    order = ["key", "end", "place"]
    parts = shared_path(records.sparkSession, "parts")
    sliced = whole.repartitionByRange(min(size // SLICE + 1, SLICES), *order).sortWithinPartitions(*order)
    sliced.select("key", "value").write.partitionBy("key").option("compression", "gzip").text(parts)
    join_parts(records.sparkSession, parts, path)


def _place(*cols):
    """A place that no two rows share; only stored rows keep it."""
    return F.struct(*[F.col(c) if isinstance(c, str) else c for c in cols], F.monotonically_increasing_id().alias("row")).alias("place")


def _landed_snapshots(spark, sf):
    """The documents of each category as one file, as a fetch would leave them; one is cut off."""
    path = shared_path(spark, "landed")
    forms = [
        ("Volume Gainers", "VolumeGainers", '{"timestamp": "t", "data": [', "]}"),
        ("Top Losers", "TopLosers", '{"other": {"data": [1]}, "allSec": {"data": [', "]}}"),
        ("Bulk Deals Data", "BulkDealsData", '{"BLOCK_DEALS_DATA": [], "SHORT_DEALS_DATA": [7], "BULK_DEALS_DATA": [', "]}"),
        ("Volume Gainers", "Broken", '{"allSec": {"data": [', "]"),
    ]
    records = all_records(t.snapshot_docs(spark, sf)).where(F.col("category").isin(*{f[0] for f in forms}))
    records = stored(records.select("category", _place("o_orderkey", "pos"), "raw"), "records")
    keys = [F.when(F.col("category") == category, key) for category, key, _, _ in forms]
    keyed = records.select(F.explode(F.array_compact(F.array(*keys))).alias("key"), "place", "raw")
    _land_documents(keyed, path, spark.createDataFrame([f[1:] for f in forms], "key string, opening string, closing string"))
    return path


@query
def landed_snapshots(spark, sf):
    """Records of landed files, each one document; one file is cut off and gives none."""
    path = _landed_snapshots(spark, sf)
    folders = {"Volume Gainers": "VolumeGainers", "Top Losers": "TopLosers", "Large Deals": "BulkDealsData", "Top Gainers": "Broken"}
    return read_snapshot_records(spark, {c: f"{path}/key={f}" for c, f in folders.items()}, strict=False)


@query
def landed_constituents(spark, sf):
    """Membership records of landed files, one document per index, of the configured indices."""
    path = shared_path(spark, "landed")
    records = constituent_records(t.constituent_docs(spark, sf))
    records = stored(records.select(F.col("index_name").alias("key"), _place(F.xxhash64("raw").alias("hash"), "pos"), "raw"), "records")
    ends = records.select("key").distinct().select("key", F.lit('{"name": "x", "data": [').alias("opening"), F.lit("]}").alias("closing"))
    _land_documents(records, f"{path}/t", ends)
    folders = {f"{kind}{n}" for n in range(0, 25, 2) for kind in ("nifty ", "nifty midcap ")} | {"nifty none"}
    return read_membership_records(spark, f"{path}/t", sorted(folders), key="key").select("index_name", "raw")


@query
def activity(spark, sf):
    fields = [("symbol", "string"), ("price", "double"), ("qty", "bigint"), ("meta", "string")]
    return activity_table(all_records(t.snapshot_docs(spark, sf)), fields)


@query
def activity_discovered(spark, sf):
    """As ``activity``, with the fields and their types found in the records."""
    return activity_table(stored(all_records(t.snapshot_docs(spark, sf))))


@query
def activity_csv(spark, sf):
    """The activity table written as CSV and read back as text."""
    path = f"{shared_path(spark, 'activity')}/csv"
    write_activity(activity(spark, sf), path)
    return spark.read.option("header", True).csv(path)


# ---- memberships ----------------------------------------------------------------------


@query
def membership_rows(spark, sf):
    nation, region = t.table(spark, sf, "nation"), t.table(spark, sf, "region")
    joined = t.table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    joined = joined.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    wide = joined.select(
        F.col("r_name").alias("index_name"), F.col("c_custkey").alias("symbol"), "c_name",
        F.col("n_name").alias("Index"),
    )
    return mb.order_columns(mb.membership_rows(wide))


@query
def cap_class(spark, sf):
    return mb.add_cap_class(stored(mb.normalize_index(t.members(spark, sf))), mid=t.MID, small=t.SMALL, out="cap_class")


@query
def memberships_by_index(spark, sf):
    """Written in folders by index and read back for some of them."""
    path = shared_path(spark, "members")
    write_memberships(t.members(spark, sf), path, "parquet", ["Index"])
    back = spark.read.schema("Stock bigint, Index string").parquet(path)
    return back.where(tx.name_matches("Index", t.MID)).select("Stock", "Index")


@query
def cap_summary(spark, sf):
    classed = mb.add_cap_class(stored(t.members(spark, sf)), mid=t.MID, small=t.SMALL)
    return mb.cap_summary(classed)


@query
def membership_flags(spark, sf):
    return mb.membership_flags(t.members(spark, sf), mid=t.MID, small=t.SMALL)


@query
def unique_stocks(spark, sf):
    return mb.unique_stocks(t.members(spark, sf))


@query
def unique_stocks_by_sketch(spark, sf):
    """Sketches per index, stored by half the rows each and merged: whether every estimate is within its
    bound of the exact count."""
    members = t.members(spark, sf)
    path = shared_path(spark, "sketches")
    for half in (0, 1):
        mb.stock_sketches(members.where(F.pmod("Stock", F.lit(2)) == half)).write.mode("append").parquet(path)
    sketches = spark.read.parquet(path)
    each = members.groupBy("Index").agg(F.countDistinct("Stock").alias("exact")).join(mb.approx_unique_stocks(sketches, ["Index"]), "Index")
    whole = members.agg(F.countDistinct("Stock").alias("exact")).join(mb.approx_unique_stocks(sketches), F.lit(True))
    near = F.abs(F.col("unique_stocks") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * mb.sketch_error())
    return each.select("Index", "exact", near.alias("near")).unionByName(whole.select(F.lit("all").alias("Index"), "exact", near.alias("near")))


@query
def distinct_members(spark, sf):
    return mb.distinct_members(t.members(spark, sf), t.MID)


@query
def index_coverage(spark, sf):
    """Of a catalog that lists one index without rows."""
    catalog = t.table(spark, sf, "nation").select(F.col("n_name").alias("index_name"))
    catalog = catalog.unionByName(catalog.select(F.lit("NOWHERE").alias("index_name")).limit(1))
    suppliers = t.table(spark, sf, "supplier")
    nation = t.table(spark, sf, "nation")
    seen = suppliers.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("Index"))
    return mb.index_coverage(seen, catalog)


@query
def self_row(spark, sf):
    records = constituent_records(t.constituent_docs(spark, sf))
    named = records.withColumn("symbol", F.get_json_object("raw", "$.symbol"))
    return mb.drop_self_row(named).drop("raw")


@query
def constituents(spark, sf):
    fields = [("symbol", "string"), ("lastPrice", "double"), ("Index", "string"), ("open", "bigint")]
    return membership_table(t.constituent_docs(spark, sf), fields)


# ---- text, bands and tables -----------------------------------------------------------


@query
def option_symbol(spark, sf):
    return t.option_rows(spark, sf).select("ord", tx.option_symbol("Symbol").alias("short"))


@query
def strike_band(spark, sf):
    part = t.table(spark, sf, "part")
    return part.select("p_partkey", tx.strike_band("p_size", 25).alias("band"))


@query
def cell_band(spark, sf):
    change = se.pct_change(t.stored_bars(spark, sf), n=1, out="change").withColumn("change", F.round(F.col("change") * 100, 2))
    text = tx.render_cell("change", "change", "double", {"change": {"positive": "+"}})
    out = change.select("symbol", "ts", tx.change_band("change").alias("band"), text.alias("cell"))
    return t.plain_ts(out)


@query
def pattern_marker(spark, sf):
    marks = {"WIDGET": "W", "ring": "R", "small": "S"}
    text = tx.render_cell("p_name", "p_name", "string", {"p_name": {"values": marks}})
    return t.table(spark, sf, "part").select("p_partkey", tx.pattern_marker("p_name", marks).alias("marker"), text.alias("cell"))


@query
def number_text(spark, sf):
    return t.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        tx.float_text(F.col("l_extendedprice") * 1000).alias("price"),
        tx.float_text(F.col("l_discount") / 1024).alias("tiny"),
        tx.fixed_point("l_tax").alias("tax"), tx.percent_text("l_discount").alias("discount"),
        tx.timestamp_text("l_shipdate").alias("shipped"),
    )


@query
def table_report(spark, sf):
    return tb.render_table(t.option_rows(spark, sf), "Options", t.RULES, atm_strike=25)


@query
def first_rows(spark, sf):
    return rows.head_rows(t.table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"])


@query
def prediction_text(spark, sf):
    results = binary_measures(t.quality_labels(spark, sf)).select(
        tx.trend_band("accuracy").alias("trend"), F.col("accuracy").alias("probability"), "accuracy", "precision_0",
        "precision_1", "recall_0", "recall_1", F.lit("2024-01-31 15:30:00").cast("timestamp").alias("timestamp"),
        (F.col("support_0") + F.col("support_1")).alias("data_points"), F.lit(17).alias("features_used"),
    )
    return al.render_prediction(results).select("type", "text")


@query
def error_text(spark, sf):
    errors = t.table(spark, sf, "events").select("event_id", F.col("props").alias("error"), F.col("ts").alias("timestamp"))
    return al.render_error(errors).select("event_id", "text")


@query
def alert_style(spark, sf):
    kind = F.col("event_type")
    events = t.table(spark, sf, "events").select(
        "event_id", F.when(kind == "purchase", "profit").when(kind == "click", "trade").otherwise(kind).alias("type"),
        F.col("props").alias("message"),
    )
    return al.style_alert(events)


@query
def chunks(spark, sf):
    return al.message_parts(t.table(spark, sf, "documents").select("doc_id", "text"))


@query
def previews(spark, sf):
    return t.table(spark, sf, "documents").select(
        "doc_id", tx.preview("text").alias("preview"), tx.full_name("lang", F.nullif("source", F.lit("src1"))).alias("name")
    )


# ---- recipients and commands ----------------------------------------------------------


@query
def fan_out(spark, sf):
    recipients = t.table(spark, sf, "nation").select(F.col("n_nationkey").alias("chat_id"))
    return al.fan_out(t.alerts(spark, sf), recipients)


@query
def fan_out_listed(spark, sf):
    return al.outbox(t.alerts(spark, sf), t.CHAT_IDS)


def _addressed(spark, sf):
    """Alerts of which some have no text."""
    return t.alerts(spark, sf).withColumn("text", F.when(F.col("alert_id") % 11 != 0, F.col("text")))


@query
def rejected_alerts(spark, sf):
    return al.rejected_alerts(_addressed(spark, sf), t.CHAT_IDS)


@query
def alert_status(spark, sf):
    return al.delivery_status(_addressed(spark, sf), t.table(spark, sf, "nation").select(F.col("n_nationkey").alias("chat_id")))


@query
def stored_outbox(spark, sf):
    """Styled alerts for the listed chats, appended to an outbox table in two goes."""
    path = shared_path(spark, "outbox")
    for silent in (False, True):
        write_outbox(al.outbox(t.alerts(spark, sf).withColumn("silent", F.lit(silent)), t.CHAT_IDS), path, f"silent {silent}")
    return read_runs(spark, path).drop("run")


@query
def outbox_once(spark, sf):
    """A run written twice, and one whose rows came without a mark, as a failed attempt leaves them: the
    first counts once, the other not until it is repeated."""
    path = shared_path(spark, "outbox")
    sent = al.outbox(t.alerts(spark, sf), t.CHAT_IDS)
    for part, run in ((F.col("alert_id") % 2 == 0, "even"), (F.col("alert_id") % 2 == 0, "even"), (F.col("alert_id") % 6 == 1, "again")):
        write_outbox(sent.where(part), path, run)
    for run in ("failed", "repeated"):
        sent.where("alert_id % 2 = 1").write.parquet(f"{path}/run=_{run}")
    write_outbox(sent.where("alert_id % 6 = 3"), path, "repeated")
    return read_runs(spark, path).select("run", "alert_id", "chat_id", "part", "text")


@query
def split_authorized(spark, sf):
    ids = t.table(spark, sf, "nation").select(F.col("n_nationkey").cast("bigint").alias("chat_id"))
    events = t.table(spark, sf, "events").select("event_id", F.col("user_id").alias("chat_id"))
    return al.flag_authorized(events, ids)


@query
def is_authorized(spark, sf):
    return t.table(spark, sf, "events").select("event_id", al.is_authorized("user_id", t.CHAT_IDS).alias("authorized"))


def _commands(spark, sf):
    return cm.parse_commands(cm.route_updates(t.updates(spark, sf)), t.CHAT_IDS)


@query
def parse_commands(spark, sf):
    return _commands(spark, sf).withColumn("args", F.array_join("args", "|"))


@query
def unauthorized_messages(spark, sf):
    return cm.unauthorized_messages(cm.route_updates(t.updates(spark, sf)), t.CHAT_IDS)


@query
def dispatch(spark, sf):
    replies = cm.default_replies(t.CHAT_IDS, 0)
    return cm.dispatch(_commands(spark, sf), replies).select("update_id", "chat_id", "command", "reply")


@query
def command_list(spark, sf):
    return cm.command_list(_commands(spark, sf))


@query
def next_batch(spark, sf):
    return cm.next_batch(t.updates(spark, sf), 50).select("update_id", F.col("message.text").alias("text"))


@query
def log_status(spark, sf):
    return cm.log_status(t.updates(spark, sf), t.CHAT_IDS)


@query
def landed_updates(spark, sf):
    """The messages of updates landed as JSON lines, some of them without a chat id."""
    path = shared_path(spark, "landed")
    _without_some_chats(t.updates(spark, sf)).write.json(path)
    return cm.route_updates(read_updates(spark, path))


@query
def dead_letters(spark, sf):
    path = shared_path(spark, "landed")
    _without_some_chats(t.updates(spark, sf)).write.json(path)
    return cm.dead_letters(read_updates(spark, path)).select("update_id", "error")


def _without_some_chats(updates):
    lost = F.when(F.col("update_id") % 9 != 0, F.col("message.chat.id"))
    return updates.withColumn("message", F.col("message").withField("chat.id", lost))


@query
def command_replies(spark, sf):
    root = shared_path(spark, "updates")
    UpdateJob(t.as_updates(_event_stream(spark, sf)), root, t.CHAT_IDS).run()
    return read_outbox(spark, root)


@query
def command_replies_restart(spark, sf):
    """The log landed and handled in two steps, the second by a job that starts anew and finds an
    update of the first again."""
    root = shared_path(spark, "updates")
    updates = t.updates(spark, sf)
    half = updates.agg(F.expr("percentile_approx(update_id, 0.5)")).first()[0]
    for part in (F.col("update_id") <= half, F.col("update_id") >= half):
        updates.where(part).write.mode("append").json(f"{root}/in")
        UpdateJob(updates_stream(spark, f"{root}/in"), root, t.CHAT_IDS, now="2024-01-31").run()
    return read_outbox(spark, root)


@query
def command_replies_lost_state(spark, sf):
    """The log in two halves; between them the noted progress is damaged, so the second starts from 0
    and answers the update that both hold again."""
    root = shared_path(spark, "updates")
    updates = t.updates(spark, sf)
    half = updates.agg(F.expr("(min(update_id) + max(update_id)) div 2")).first()[0]
    for part in (F.col("update_id") <= half, F.col("update_id") >= half):
        updates.where(part).write.mode("append").json(f"{root}/in")
        UpdateJob(updates_stream(spark, f"{root}/in"), root, t.CHAT_IDS, now="2024-01-31").run()
        spark.createDataFrame([("damaged",)], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/state/run=0/slot=0")
    return read_outbox(spark, root)


def _supplier_log(spark, sf):
    """Updates with gaps between their ids, landed as a log; ten a pull make many pulls."""
    path = shared_path(spark, "log")
    supplier = t.table(spark, sf, "supplier")
    text = F.when(F.col("s_suppkey") % 3 == 0, "/status").when(F.col("s_suppkey") % 3 == 1, "/ping").otherwise("/foo x")
    land_updates(supplier.select(
        (F.col("s_suppkey") * 3 + 3).alias("update_id"),
        F.struct(F.struct(F.col("s_nationkey").cast("bigint").alias("id"), F.col("s_name").alias("first_name"), F.lit(None).cast("string").alias("last_name")).alias("chat"), text.alias("text")).alias("message"),
    ), path)
    return path


@query
def pulled_updates_by_ten(spark, sf):
    """Which pull gives which update: the ten lowest waiting ids, again and again."""
    path = shared_path(spark, "pulled")
    stream = pulled_updates(spark, _supplier_log(spark, sf), pulls=pulls_at_once())
    take = lambda batch, n: batch.select("update_id", "pull").write.mode("overwrite").parquet(f"{path}/t/n={n}")
    pull = stream.writeStream.foreachBatch(take).option("checkpointLocation", f"{path}/checkpoint").start()
    try:
        pull.processAllAvailable()
    finally:
        pull.stop()
    return spark.read.parquet(f"{path}/t").select("update_id", "pull")


PULL = 40  # ids of a pull where every pull is handled by the whole job


def _pulled(spark, sf):
    root = shared_path(spark, "updates")
    UpdateJob(None, root, t.CHAT_IDS, now="2024-01-31").pull(spark, _supplier_log(spark, sf), PULL)
    return root


@query
def pulled_replies(spark, sf):
    """The replies of a job that pulls its log a few updates at a time."""
    return read_outbox(spark, _pulled(spark, sf))


@query
def processed_updates(spark, sf):
    """What each pull of that job took, counted while it was written."""
    return read_processed(spark, _pulled(spark, sf)).select("batch_id", "processed", "last_update_id", "last_save")


@query
def function_replies(spark, sf):
    """A function of the user's answers one command; it fails on a third of the chats."""

    def spell(chat_id: int, args: list[str]) -> str | None:
        if chat_id % 3 == 0:
            raise ValueError(f"no answer for {chat_id}")
        return f"{chat_id}: {'-'.join(args)}" if args else None

    registry = Registry()
    registry.register_function("/Ping", spell)
    root = shared_path(spark, "updates")
    UpdateJob(t.as_updates(_event_stream(spark, sf)), root, t.CHAT_IDS, registry).run()
    return read_outbox(spark, root).where(F.col("text").rlike(r"^(\d+: |❌)"))


# ---- model ----------------------------------------------------------------------------


RUN_TS = "2024-01-31 00:00:00"


def _run(spark, sf, **options):
    return train_and_predict(stored(t.named(spark, sf)), _score(spark, sf), present=list(t.INSTRUMENTS), run_ts=RUN_TS, **options)


@query
def trend_model(spark, sf):
    return t.plain_ts(_run(spark, sf)[0], "timestamp")


@query
def trend_model_facts(spark, sf):
    """What of a run does not depend on how its trees grew."""
    results, _ = _run(spark, sf, trees=3, depth=3)
    return t.plain_ts(results.select("data_points", "features_used", "support_0", "support_1", "timestamp"), "timestamp")


@query
def trend_job_outbox(spark, sf):
    """The whole job with its own guard and forest, and the same run repeated: what was sent and noted.
    Figures of the forest are only asked to be there."""
    path = shared_path(spark, "job")
    made = []
    train = lambda: made[0] if made else made.append(_run(spark, sf)) or made[0]
    for _ in range(2):
        trend_job(train, t.CHAT_IDS, f"{path}/outbox", f"{path}/runs", RUN_TS)
    runs = read_runs(spark, f"{path}/runs").agg(F.count(F.lit(1)).alias("runs"), F.max("support_0").alias("support_0"), F.max("support_1").alias("support_1"))
    sent = read_runs(spark, f"{path}/outbox").select(
        "chat_id", "part",
        F.regexp_extract("text", r"Data Points: (\d+) ", 1).cast("bigint").alias("data_points"),
        F.regexp_extract("text", r"Features Used: (\d+)", 1).cast("int").alias("features_used"),
        F.col("text").rlike(r"Uptrend Probability:</b> \d+\.\d%\n<b>Model Accuracy:</b> \d+\.\d%").alias("measured"),
        F.regexp_extract("text", r"⏰ <i>([^<]*)</i>", 1).alias("at"),
    )
    return sent.join(runs, F.lit(True))


@query
def trend_learned(spark, sf):
    """A forest on orders whose class follows from two of their columns: it must find that out. Supports
    and the latest class are exact, the measures are held to a bound."""
    orders = t.table(spark, sf, "orders").select(
        F.timestamp_seconds(F.col("o_orderkey") * 60).alias("ts"), F.col("o_totalprice").alias("price"), (F.col("o_custkey") % 5).cast("double").alias("kind"),
        F.month("o_orderdate").cast("double").alias("month"),
    )
    table = stored(orders.withColumn("Target", ((F.col("price") > 200000) != (F.col("kind") == 3)).cast("int")))
    features = ["price", "kind", "month"]
    split = rows.time_series_split(table)
    model = train_trend_model(split.where("part = 'train'"), features, trees=40)
    row = results_row(score_latest(model, table, features), predict(model, split.where("part = 'test'")), table, len(features), RUN_TS)
    sure = F.when(F.col("probability") > 0.6, 1).when(F.col("probability") < 0.4, 0)
    return t.plain_ts(row.select(
        sure.alias("latest"), "trend", "support_0", "support_1", (F.col("accuracy") > 0.97).alias("accurate"),
        (F.least("precision_0", "precision_1", "recall_0", "recall_1", "f1_0", "f1_1") > 0.95).alias("sharp"), "timestamp", "data_points", "features_used",
    ), "timestamp")


@query
def trend_job_failure(spark, sf):
    """The outbox of a run with fewer rows than its guard asks for: the error for every recipient."""
    path = shared_path(spark, "job")
    too_few = lambda: _run(spark, sf, min_rows=1_000_000_000)
    trend_job(too_few, t.CHAT_IDS, f"{path}/outbox", f"{path}/runs", RUN_TS)
    return read_runs(spark, f"{path}/outbox").drop("run")
