"""Mixing sources to target weights by entropy balancing.

Of all rates from 0 to 3 that give every source its target of words and keep the lengths of the
corpus (mean and spread of the log length that a word's document has), the ones nearest to taking
each word once, by relative entropy over words, tilt every document exponentially:
``rate = exp(t of its source + u . f(length))``, cut at 3. The multipliers solve a convex dual. A
Newton step takes the gradient and the whole Hessian, added up over all documents; that of the
sources is diagonal and is eliminated per source, which leaves a system of two rows for ``u``.
Lengths give way where sources leave them no room (a small quadratic price on ``u``); sources do not.

Rates become whole copies: every document gets the whole part, and the broken parts decide, with a
hash, in which order documents get one copy more until the source's target is met.

Only DataFrame functions are used; documents with one source and length are one row of the sums.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barframe.session import stored

MOST = 3  # times a document or a source may be repeated
NEWTON_STEPS = 40  # at most; few are needed
PRICE = 0.1  # of the squared multipliers of the lengths, per word: it bounds them where lengths cannot be kept
FULL = 1e6  # exponent of a source that takes every document as often as it may
REACH = 3.0  # of a step, in exponents
CLOSE = 1e-10  # relative distance from the targets that ends the steps
PLACES = 9  # decimals of a rate
PIECE_ROWS = 4096  # documents of a source that are put in order together, about
WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def repeating_weights(sources: DataFrame, source: str = "source", period: int = 3) -> DataFrame:
    """Add ``weight``: 1, 2, ... ``period``, repeating, by the code points of the source, null last.

    One row per source is put in order as a whole; documents are not.
    """
    place = F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last()))
    return sources.withColumn("weight", ((place - 1) % period + 1).cast("long"))


def capped_targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """Add ``target`` to ``(source, source_size, weight)``: the total shared by weight, where no
    source gets more than ``most`` times its size and the excess is shared again by weight.

    With sources in the order of ``size / weight``, those that stop are the first ones, and the
    others get the same amount per weight; running sums find the border.
    """
    every = Window.partitionBy()
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(every) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    free = F.when(F.col("level") * F.col("weight") <= most * F.col("source_size"), F.col("level"))
    # the first source that does not stop sets the amount per weight; if all stop there is none
    return (
        sources.withColumn("level", level)
        .withColumn("level", F.first(free, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .withColumn("target", F.least(F.coalesce(F.col("level") * F.col("weight"), F.lit(float("inf"))), (most * F.col("source_size")).cast("double")))
        .drop("level")
    )


def same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def length_features(size: str, mean: float, spread: float) -> tuple[Column, Column]:
    """What of a document's length enters its tilt: the standard score of its log length, and its square less 1."""
    x = (F.log1p(F.col(size).cast("double")) - F.lit(mean)) / F.lit(spread) if spread > 0 else F.lit(0.0)
    return x, x * x - 1


def newton_step(sums: dict[str, float], u: tuple[float, float], price: float, largest: tuple[float, float]) -> tuple[float, float]:
    """The step of ``u`` from the sums over all sources, once the sources are eliminated. It moves no
    document's exponent by more than ``REACH`` in either feature, whose ``largest`` sizes are given."""
    a, b, c = sums["k11"] + price, sums["k12"], sums["k22"] + price
    g1, g2 = sums["r1"] + price * u[0], sums["r2"] + price * u[1]
    det = a * c - b * b
    d1, d2 = (-(c * g1 - b * g2) / det, -(a * g2 - b * g1) / det) if det > 0 else (0.0, 0.0)
    scale = max(1.0, abs(d1) * largest[0] / REACH, abs(d2) * largest[1] / REACH)
    return d1 / scale, d2 / scale


def tilt(profile: DataFrame, aimed: DataFrame, most: int = MOST) -> tuple[DataFrame, tuple[float, float], float, float]:
    """``(source, t)`` per source, ``u``, and the mean and spread of the log lengths.

    ``profile (source, size, n)`` counts documents, ``aimed (source, source_size, target)`` has what
    the sources shall give. A source without words or target has no tilt. Each step is one
    pass over the profile that leaves a row per source, and five sums come to the driver.
    """
    words = F.col("n") * F.col("size").cast("double")
    log_length = F.log1p(F.col("size").cast("double"))
    whole = profile.agg(F.sum(words).alias("w"), F.sum(words * log_length).alias("m1"), F.sum(words * log_length * log_length).alias("m2"), F.min(F.when(F.col("size") > 0, log_length)).alias("low"), F.max(log_length).alias("high")).first()
    total = whole["w"] or 0.0
    mean = whole["m1"] / total if total else 0.0
    spread = math.sqrt(max(whole["m2"] / total - mean * mean, 0.0)) if total else 0.0
    spread = spread if spread > 1e-9 else 0.0
    price, u = PRICE * total, (0.0, 0.0)
    far = max(mean - whole["low"], whole["high"] - mean) / spread if spread else 0.0
    largest = far, max(far * far - 1, 1.0)
    f1, f2 = length_features("size", mean, spread)
    # the lengths of the corpus, for as many words as the mix takes: standard scores add up to 0, their squares to 1
    ratio = F.col("target") / F.col("source_size")
    start = F.when(ratio > most * (1 - 1e-12), FULL).otherwise(F.log(ratio))
    state = aimed.where("source_size > 0 and target > 0").select(F.col("source").alias("s"), "target", start.alias("t"))
    cells = profile.where("size > 0")
    for _ in range(NEWTON_STEPS):
        exponent = F.col("t") + F.lit(u[0]) * f1 + F.lit(u[1]) * f2
        rate = F.least(F.exp(F.least(exponent, F.lit(50.0))), F.lit(float(most)))
        given = cells.join(state, same("source", "s")).withColumn("v", words * rate).withColumn("h", F.when(exponent < math.log(most), F.col("v")).otherwise(0.0))
        per = stored(
            given.groupBy("s").agg(
                F.first("target").alias("target"), F.first("t").alias("t"), F.sum("v").alias("a0"), F.sum(F.col("v") * f1).alias("a1"), F.sum(F.col("v") * f2).alias("a2"),
                F.sum("h").alias("h0"), F.sum(F.col("h") * f1).alias("h1"), F.sum(F.col("h") * f2).alias("h2"),
                F.sum(F.col("h") * f1 * f1).alias("h11"), F.sum(F.col("h") * f1 * f2).alias("h12"), F.sum(F.col("h") * f2 * f2).alias("h22"),
            ).withColumn("g", F.col("a0") - F.col("target")),
            "newton",
        )
        free = F.col("h0") > 1e-9 * F.col("target")
        less = lambda x, y: F.col(x) - F.when(free, y / F.col("h0")).otherwise(0.0)
        sums = per.agg(
            F.sum(less("h11", F.col("h1") * F.col("h1"))).alias("k11"), F.sum(less("h12", F.col("h1") * F.col("h2"))).alias("k12"), F.sum(less("h22", F.col("h2") * F.col("h2"))).alias("k22"),
            F.sum(less("a1", F.col("h1") * F.col("g"))).alias("r1"), F.sum(less("a2", F.col("h2") * F.col("g"))).alias("r2"),
            F.max(F.abs("g") / F.col("target")).alias("off"),
        ).first()
        if sums["off"] is None:
            break
        d1, d2 = newton_step(sums.asDict(), u, price, largest)
        # Near its target a source takes the Newton step, else it is scaled to it; and it follows the lengths.
        own = F.when(free & (F.abs("g") < 0.1 * F.col("target")), -F.col("g") / F.col("h0")).otherwise(F.log(F.col("target") / F.col("a0")))
        follow = F.when(free, -(d1 * F.col("h1") + d2 * F.col("h2")) / F.col("h0")).otherwise(0.0)
        state = per.select("s", "target", (F.col("t") + own + follow).alias("t"))
        u = (u[0] + d1, u[1] + d2)
        if sums["off"] < CLOSE and abs(d1) + abs(d2) < CLOSE:
            break
    return state.select(F.col("s").alias("source"), "t"), u, mean, spread


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", most: int = MOST, targets: DataFrame | None = None, tag: str | None = None) -> DataFrame:
    """``(doc_id, size, source_size, target, copies, taken)`` of every document row, and its ``tag``
    if a column of that name is given.

    ``taken = copies * size`` words, copies from 0 to ``most``. ``targets (source, target)`` may
    give the words wanted of each source (above ``most`` times its size it stops there; sources
    without a row get none); by default weights 1, 2, 3 repeat over the sources. A null text has
    size 0, a null source is a source of its own, and other columns are ignored. The order that
    hands out the odd copies is by md5 of the id (of the text, where that is null), so reruns agree;
    a source's taken words miss its target by half a document's size at most. Repeated rows count
    as documents each.
    """
    key = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("text "), F.col(text)), F.lit("")))
    tags = [F.col(f"`{tag}`").alias("tag")] if tag else []
    sized = stored(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size"), key.alias("key"), *tags), "sized")
    profile = stored(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "lengths")
    sizes = profile.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("rows"))
    if targets is None:
        aimed = capped_targets(repeating_weights(sizes), most)
    else:
        wanted = targets.select(F.col("source").alias("wanted_source"), F.col("target").cast("double").alias("wanted"))
        aimed = sizes.join(wanted, same("source", "wanted_source"), "left").withColumn(
            "target", F.least(F.greatest(F.coalesce("wanted", F.lit(0.0)), F.lit(0.0)), (most * F.col("source_size")).cast("double"))
        )
    aimed = stored(aimed.select("source", "source_size", "rows", "target"), "targets")
    tilts, u, mean, spread = tilt(profile, aimed, most)
    plan = stored(
        aimed.join(tilts.withColumnRenamed("source", "tilted"), same("source", "tilted"), "left")
        .select(F.col("source").alias("plan_source"), "source_size", "target", "t", F.greatest(F.lit(1), F.expr(f"rows div {PIECE_ROWS}")).alias("cuts")),
        "plan",
    )
    f1, f2 = length_features("size", mean, spread)
    rate = F.round(F.least(F.exp(F.least(F.col("t") + F.lit(u[0]) * f1 + F.lit(u[1]) * f2, F.lit(50.0))), F.lit(float(most))), PLACES)
    draw = F.conv(F.substring("key", 1, 13), 16, 10).cast("double") / float(1 << 52)
    placed = (
        sized.join(plan, same("source", "plan_source"))
        .withColumn("rate", F.when(F.col("t").isNotNull(), rate).otherwise(0.0))
        .withColumn("base", F.floor("rate").cast("long"))
        .withColumn("turn", F.when(F.col("rate") > F.col("base"), draw / (F.col("rate") - F.col("base"))))  # the smaller, the earlier
        .withColumn("piece", F.least(F.floor(F.col("turn") * F.col("cuts")), 2 * F.col("cuts")))
    )
    pieces = placed.groupBy(F.col("source").alias("piece_source"), "piece").agg(F.sum("size").alias("words"), F.sum(F.col("base") * F.col("size")).alias("whole"), F.first("target").alias("aim"))
    every, running = Window.partitionBy("piece_source"), Window.partitionBy("piece_source").orderBy(F.col("piece").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    border = stored(
        pieces.withColumn("rest", F.col("aim") - F.sum("whole").over(every))
        .withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
        .where((F.col("before") <= F.col("rest")) & F.col("piece").isNotNull())
        .groupBy("piece_source", "rest")
        .agg(F.max(F.struct("piece", "before")).alias("border"))
        .select("piece_source", "rest", F.col("border.piece").alias("border"), "border.before"),
        "border",
    )
    told = placed.join(border, same("source", "piece_source"), "left")
    inside = Window.partitionBy("source").orderBy("turn", "key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    odd = (F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)) + F.col("size") / 2 <= F.col("rest")).cast("long")
    at_border = F.coalesce(F.col("piece") == F.col("border"), F.lit(False))
    clear = told.where(~at_border).withColumn("odd", F.coalesce(F.col("piece") < F.col("border"), F.lit(False)).cast("long"))
    edge = told.where(at_border).withColumn("odd", odd)
    return (
        clear.unionByName(edge)
        .withColumn("copies", F.least(F.col("base") + F.col("odd"), F.lit(most)))
        .select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *(["tag"] if tag else []))
    )


SQL_STEPS = 25


def _step_sql(i: int) -> str:
    """One Newton step in SQL: per source, then the sums, then the next multipliers."""
    return f"""
per{i} AS MATERIALIZED (
    SELECT s, any_value(target) AS target, any_value(t) AS t, sum(v) AS a0, sum(v * f1) AS a1, sum(v * f2) AS a2, sum(h) AS h0, sum(h * f1) AS h1, sum(h * f2) AS h2,
           sum(h * f1 * f1) AS h11, sum(h * f1 * f2) AS h12, sum(h * f2 * f2) AS h22, sum(v) - any_value(target) AS g
    FROM (SELECT *, CASE WHEN e < ln(3.0::DOUBLE) THEN v ELSE 0 END AS h FROM (
        SELECT *, w * least(exp(least(e, 50.0::DOUBLE)), 3.0::DOUBLE) AS v FROM (
            SELECT c.*, x.s, x.target, x.t, x.t + m.u1 * c.f1 + m.u2 * c.f2 AS e FROM cells c JOIN state{i} x ON c.source IS NOT DISTINCT FROM x.s, mult{i} m))) GROUP BY s
), sums{i} AS (
    SELECT sum(h11 - CASE WHEN h0 > 1e-9 * target THEN h1 * h1 / h0 ELSE 0 END) + {PRICE} * any_value(total) AS a,
           sum(h12 - CASE WHEN h0 > 1e-9 * target THEN h1 * h2 / h0 ELSE 0 END) AS b,
           sum(h22 - CASE WHEN h0 > 1e-9 * target THEN h2 * h2 / h0 ELSE 0 END) + {PRICE} * any_value(total) AS c,
           sum(a1 - CASE WHEN h0 > 1e-9 * target THEN h1 * g / h0 ELSE 0 END) + {PRICE} * any_value(total * u1) AS g1,
           sum(a2 - CASE WHEN h0 > 1e-9 * target THEN h2 * g / h0 ELSE 0 END) + {PRICE} * any_value(total * u2) AS g2
    FROM per{i}, moments, mult{i}
), raw{i} AS (SELECT -(c * g1 - b * g2) / (a * c - b * b) AS d1, -(a * g2 - b * g1) / (a * c - b * b) AS d2 FROM sums{i}
), move{i} AS (
    SELECT coalesce(d1 / greatest(1, abs(d1) * far / {REACH}, abs(d2) * greatest(far * far - 1, 1) / {REACH}), 0) AS d1,
           coalesce(d2 / greatest(1, abs(d1) * far / {REACH}, abs(d2) * greatest(far * far - 1, 1) / {REACH}), 0) AS d2 FROM raw{i}, moments
), mult{i + 1} AS MATERIALIZED (SELECT u1 + d1 AS u1, u2 + d2 AS u2 FROM mult{i}, move{i}
), state{i + 1} AS MATERIALIZED (
    SELECT s, target, t + CASE WHEN h0 > 1e-9 * target AND abs(g) < 0.1 * target THEN -g / h0 ELSE ln(target / a0) END
           - CASE WHEN h0 > 1e-9 * target THEN (d1 * h1 + d2 * h2) / h0 ELSE 0 END AS t
    FROM per{i}, move{i}
)"""


MIX_SQL = rf"""
WITH sized AS MATERIALIZED (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
           md5(coalesce(CAST(doc_id AS VARCHAR), 'text ' || text, '')) AS key
    FROM documents
), sizes AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
    SELECT *, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight FROM sizes
), levels AS (
    SELECT *, CAST(sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
              / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS level,
              CAST(source_size AS DOUBLE) / weight AS place
    FROM weighed WINDOW o AS (ORDER BY CAST(source_size AS DOUBLE) / weight, source ASC NULLS LAST)
), bar AS (
    SELECT arg_min(level, place) AS level FROM levels WHERE level * weight <= 3 * source_size
), aimed AS MATERIALIZED (
    SELECT source, source_size, least(coalesce(bar.level * weight, 'inf'::DOUBLE), CAST(3 * source_size AS DOUBLE)) AS target
    FROM levels, bar
), moments AS MATERIALIZED (
    SELECT *, CASE WHEN spread > 1e-9 THEN greatest(mean - low, high - mean) / spread ELSE 0 END AS far FROM (
        SELECT *, sqrt(greatest(square / total - mean * mean, 0)) AS spread FROM (SELECT min(ln(1 + size::DOUBLE)) FILTER (size > 0) AS low, max(ln(1 + size::DOUBLE)) AS high, sum(CAST(size AS DOUBLE)) AS total, sum(size * ln(1 + size::DOUBLE)) / sum(size) AS mean, sum(size * ln(1 + size::DOUBLE) * ln(1 + size::DOUBLE)) AS square FROM sized))
), scored AS MATERIALIZED (
    SELECT s.*, CASE WHEN spread > 1e-9 THEN (ln(1 + size::DOUBLE) - mean) / spread ELSE 0 END AS f1,
           CASE WHEN spread > 1e-9 THEN (ln(1 + size::DOUBLE) - mean) / spread ELSE 0 END ** 2 - 1 AS f2
    FROM sized s, moments
), cells AS MATERIALIZED (
    SELECT source, f1, f2, sum(size::DOUBLE) AS w FROM scored WHERE size > 0 GROUP BY source, size, f1, f2
), mult0 AS (SELECT 0::DOUBLE AS u1, 0::DOUBLE AS u2
), state0 AS MATERIALIZED (SELECT source AS s, target, CASE WHEN target / source_size > 3 * (1 - 1e-12) THEN {FULL} ELSE ln(target / source_size) END AS t FROM aimed WHERE source_size > 0 AND target > 0
), {", ".join(_step_sql(i) for i in range(SQL_STEPS))}, rates AS MATERIALIZED (
    SELECT c.*, a.source_size, a.target, CASE WHEN x.t IS NULL THEN 0 ELSE round(least(exp(least(x.t + m.u1 * f1 + m.u2 * f2, 50)), 3), {PLACES}) END AS rate
    FROM scored c JOIN aimed a ON c.source IS NOT DISTINCT FROM a.source LEFT JOIN state{SQL_STEPS} x ON c.source IS NOT DISTINCT FROM x.s, mult{SQL_STEPS} m
), turns AS (
    SELECT *, CAST(floor(rate) AS BIGINT) AS base, target - sum(CAST(floor(rate) AS BIGINT) * size) OVER (PARTITION BY source) AS rest,
           CASE WHEN rate > floor(rate) THEN CAST('0x' || key[1:13] AS BIGINT) / 4503599627370496.0::DOUBLE / (rate - floor(rate)) END AS turn
    FROM rates
), placed AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY turn ASC NULLS LAST, key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM turns
)
SELECT doc_id, size, source_size, target,
       CAST(base + CASE WHEN turn IS NOT NULL AND before + size / 2.0 <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies,
       CAST((base + CASE WHEN turn IS NOT NULL AND before + size / 2.0 <= rest THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM placed
"""
