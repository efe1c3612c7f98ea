"""Registered model, density and nested-price queries."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from quarry.functions import scalar
from quarry.operators import density, prices, regress
from quarry.plans.registry import DIGITS, register, rounded
from quarry.sources.tables import load

# ---------------------------------------------------------------- gradient descent

RATE, EPOCHS = 0.02, 5


def _gd_sql() -> str:
    ctes = ["""s AS (SELECT avg(l_quantity) AS mx, stddev_samp(l_quantity) AS sx,
              avg(l_extendedprice) AS my, stddev_samp(l_extendedprice) AS sy FROM lineitem)""",
            "d AS (SELECT (l_quantity - mx) / sx AS x, (l_extendedprice - my) / sy AS y FROM lineitem, s)",
            "i1 AS (SELECT 1 AS epoch, 1.0::DOUBLE AS b, 1.0::DOUBLE AS w)",
            "n1 AS (SELECT 1 AS epoch, 1.0::DOUBLE AS w)"]
    for e in range(1, EPOCHS + 1):
        ctes.append(f"""gi{e} AS (SELECT avg((b + w * x - y) * (b + w * x - y)) AS loss,
      avg(b + w * x - y) AS gb, avg((b + w * x - y) * x) AS gw FROM d, i{e})""")
        ctes.append(f"""gn{e} AS (SELECT avg((w * x - y) * (w * x - y)) AS loss,
      avg((w * x - y) * x) AS gw FROM d, n{e})""")
        if e < EPOCHS:
            ctes.append(f"i{e + 1} AS (SELECT {e + 1} AS epoch, b - {RATE} * gb AS b, w - {RATE} * gw AS w FROM i{e}, gi{e})")
            ctes.append(f"n{e + 1} AS (SELECT {e + 1} AS epoch, w - {RATE} * gw AS w FROM n{e}, gn{e})")
    sel = []
    for e in range(1, EPOCHS + 1):
        sel.append(f"SELECT 'intercept' AS model, epoch, round(loss, {DIGITS}) AS loss, "
                   f"round(b, {DIGITS}) AS b, round(w, {DIGITS}) AS w FROM i{e}, gi{e}")
        sel.append(f"SELECT 'no_intercept' AS model, epoch, round(loss, {DIGITS}) AS loss, "
                   f"NULL::DOUBLE AS b, round(w, {DIGITS}) AS w FROM n{e}, gn{e}")
    return "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(sel)


@register("gradient_epochs", _gd_sql())
def gradient_epochs(spark, sf_dir):
    """R1 + R2 + A14 + A15: price from quantity, both standardised; weights start at 1,
    rate 0.02, five epochs; loss and weights recorded before each update."""
    li = load(spark, sf_dir, "lineitem")
    std = regress.standardize(li, ["l_quantity", "l_extendedprice"])
    rows = []
    for model, icpt in (("intercept", True), ("no_intercept", False)):
        hist = regress.gradient_descent(std, ["l_quantity"], "l_extendedprice", RATE, EPOCHS,
                                        intercept=icpt)
        for epoch, loss, w in hist:
            rows.append((model, epoch, loss, w[0] if icpt else None, w[-1]))
    out = spark.createDataFrame(rows, "model string, epoch int, loss double, b double, w double")
    return rounded(out, "loss", "b", "w")


@register("ols_exact", f"""
SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept,
       round(regr_r2(l_extendedprice, l_quantity), 6) AS r2,
       CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n
FROM lineitem""")
def ols_exact(spark, sf_dir):
    """Exact least squares of price on quantity."""
    fit = regress.least_squares(load(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice")
    # two different algorithms agree to about 12 significant digits on the intercept
    return rounded(fit.withColumn("n", F.col("n").cast("bigint")), "slope", "intercept", "r2", digits=6)


@register("linear_predictions", """
SELECT l_orderkey, l_linenumber, round(b + w * l_quantity, 3) AS predicted
FROM lineitem, (SELECT regr_intercept(l_extendedprice, l_quantity) AS b, regr_slope(l_extendedprice, l_quantity) AS w FROM lineitem)""")
def linear_predictions(spark, sf_dir):
    """The price of every line by the least-squares line of price on quantity."""
    li = load(spark, sf_dir, "lineitem")
    fit = regress.least_squares(li, "l_quantity", "l_extendedprice").first()
    predicted = scalar.linear_prediction([F.lit(1.0), F.col("l_quantity").cast("double")], [fit.intercept, fit.slope])
    return rounded(li.select("l_orderkey", "l_linenumber", predicted.alias("predicted")), "predicted", digits=3)


# ---------------------------------------------------------------- densities

# Grid of 1000 points from -10 to 30 and kernel bandwidth 0.1.
GRID_LO, GRID_HI, GRID_N, BANDWIDTH = -10.0, 30.0, 1000, 0.1
_STEP = (GRID_HI - GRID_LO) / (GRID_N - 1)
_NORM = BANDWIDTH * math.sqrt(2 * math.pi)
_TWO_H2 = 2 * BANDWIDTH * BANDWIDTH

def _d(v: float) -> str:
    """A DOUBLE literal in DuckDB (plain decimal literals would be DECIMAL)."""
    return f"CAST({v!r} AS DOUBLE)"


_GRID_SQL = f"g AS (SELECT CAST(i AS INTEGER) AS grid_idx, {_d(GRID_LO)} + i * {_d(_STEP)} AS x FROM range({GRID_N}) t(i))"
_KDE_SQL = f"""{_GRID_SQL},
k AS (SELECT g.grid_idx, g.x, sum(exp(-((g.x - e.value) * (g.x - e.value)) / {_d(_TWO_H2)}))
        / ((SELECT count(value) FROM events) * {_d(_NORM)}) AS density
      FROM g, events e GROUP BY g.grid_idx, g.x)"""


@register("kde_grid", f"WITH {_KDE_SQL}\nSELECT grid_idx, x, round(density, {DIGITS}) AS density FROM k")
def kde_grid(spark, sf_dir):
    """E1 + J5 + S10: Gaussian kernel density of event values on the grid."""
    ev = load(spark, sf_dir, "events")
    return rounded(density.gaussian_kde(ev, "value", GRID_LO, GRID_HI, GRID_N, BANDWIDTH), "density")


def _cauchy_sql(x: str) -> str:
    terms = [f"{_d(w)} * ({_d(1.0)} / ({_d(math.pi * g)} * ({_d(1.0)} + (({x} - {_d(m)}) / {_d(g)}) * (({x} - {_d(m)}) / {_d(g)}))))"
             for m, g, w in scalar.CAUCHY_MIXTURE]
    out = _d(0.0)
    for t in terms:
        out = f"({out} + {t})"
    return out


@register("cauchy_at_values", f"""
SELECT event_id, value, round({_cauchy_sql('value')}, {DIGITS}) AS cauchy_density FROM events""")
def cauchy_at_values(spark, sf_dir):
    """The five-part Cauchy mixture density at each event value."""
    ev = load(spark, sf_dir, "events")
    return rounded(ev.select("event_id", "value", scalar.cauchy_mixture_pdf("value").alias("cauchy_density")),
                   "cauchy_density")


@register("density_compare", f"""WITH {_KDE_SQL}
SELECT round(max(abs(density - {_cauchy_sql('x')})), {DIGITS}) AS max_abs_diff,
       round(sum(density) * {_d(_STEP)}, {DIGITS}) AS kde_mass,
       round(sum({_cauchy_sql('x')}) * {_d(_STEP)}, {DIGITS}) AS true_mass FROM k""")
def density_compare(spark, sf_dir):
    """Largest gap between the estimated (kernel) and the true (Cauchy mixture)
    density on the grid, and the mass of each on the grid (rectangle rule)."""
    ev = load(spark, sf_dir, "events")
    k = density.gaussian_kde(ev, "value", GRID_LO, GRID_HI, GRID_N, BANDWIDTH) \
        .withColumn("true", scalar.cauchy_mixture_pdf("x"))
    out = k.agg(F.max(F.abs(F.col("density") - F.col("true"))).alias("max_abs_diff"),
                (F.sum("density") * F.lit(_STEP)).alias("kde_mass"),
                (F.sum("true") * F.lit(_STEP)).alias("true_mass"))
    return rounded(out, "max_abs_diff", "kde_mass", "true_mass")


@register("kde_interp", f"""WITH {_KDE_SQL},
kk AS (SELECT grid_idx, x AS x0, density AS y0, lead(x) OVER (ORDER BY grid_idx) AS x1,
              lead(density) OVER (ORDER BY grid_idx) AS y1 FROM k),
p AS (SELECT event_id, value, CASE WHEN value >= {_d(GRID_LO)} AND value <= {_d(GRID_HI)}
        THEN least(CAST(floor((value - {_d(GRID_LO)}) / {_d(_STEP)}) AS INTEGER), {GRID_N - 2}) END AS grid_idx
      FROM events)
SELECT event_id, value, round(y0 + (value - x0) / (x1 - x0) * (y1 - y0), {DIGITS}) AS interpolated
FROM p LEFT JOIN kk USING (grid_idx)""")
def kde_interp(spark, sf_dir):
    """Kernel density at each event value by linear interpolation between nodes."""
    ev = load(spark, sf_dir, "events").select("event_id", "value")
    k = density.gaussian_kde(ev, "value", GRID_LO, GRID_HI, GRID_N, BANDWIDTH)
    return rounded(density.interpolate(ev, "value", k, GRID_LO, GRID_HI, GRID_N), "interpolated")


GMM_PARTS, GMM_DIGITS = 13, 6


def _gmm_sql() -> str:
    """The same fit as a recursive query, one row a step.  ``x`` holds the parameters (13
    weights, means, variances) that the step measures and ``y`` those after it; phase 0
    measures the start of two steps, 1 the first of them (and extrapolates), 2 the place
    extrapolated to."""
    k, floor = GMM_PARTS, _d(density.VARIANCE_FLOOR)
    js = range(1, k + 1)

    def each(term: str, sep: str = ", ") -> str:
        return sep.join(term.format(j=j, m=f"x[{k + j}]", s=f"x[{2 * k + j}]") for j in js)

    def free(col: str) -> str:
        return f"list_transform({col}, lambda z, i: CASE WHEN i > {k} AND i <= {2 * k} THEN z ELSE ln(greatest(z, 1e-300)) END)"

    probs = ", ".join(repr((j - 0.5) / k) for j in js)
    return f"""WITH RECURSIVE {_GRID_SQL},
f AS MATERIALIZED (SELECT CAST(value AS DOUBLE) AS v, CAST(count(*) AS DOUBLE) AS c FROM events
      WHERE value IS NOT NULL AND isfinite(value) GROUP BY value),
n AS (SELECT sum(c) AS n FROM f),
q AS (SELECT quantile_cont(CAST(value AS DOUBLE), [{probs}]) AS m FROM events WHERE isfinite(value)),
d AS (SELECT CASE WHEN len(list_distinct(q.m)) < {k} THEN (SELECT quantile_cont(v, [{probs}]) FROM f) ELSE q.m END AS m FROM q),
fit AS (
  SELECT 0 AS it, 0 AS phase, false AS done, x, x AS p, x AS p2, CAST(0 AS DOUBLE) AS l0, CAST(0 AS DOUBLE) AS l1,
         {_d(4.0)} AS longest, {_d(1.0)} AS length
  FROM (SELECT list_concat(list_transform(m, lambda z: {_d(1.0)} / {k}), list_concat(m,
               list_transform(m, lambda z: ((m[{k}] - m[1]) / {k}) * ((m[{k}] - m[1]) / {k}) + {floor}))) AS x FROM d)
  UNION ALL
  SELECT it + 1,
         CASE WHEN phase = 0 OR phase = 2 AND l >= l1 THEN 1 WHEN phase = 1 AND step > 1 THEN 2 ELSE 0 END,
         phase = 1 AND l - l0 <= {_d(density.TOLERANCE)},
         CASE WHEN phase = 1 AND l - l0 <= {_d(density.TOLERANCE)} THEN x WHEN phase = 0 OR phase = 2 AND l >= l1 THEN y
              WHEN phase = 2 THEN p2 WHEN step > 1 THEN far ELSE y END,
         CASE WHEN phase = 2 AND l >= l1 THEN x WHEN phase = 2 THEN p2 WHEN phase = 1 AND step = 1 THEN y ELSE p END,
         CASE WHEN phase = 1 THEN y ELSE p2 END,
         CASE WHEN phase = 0 OR phase = 2 AND l >= l1 THEN l ELSE l0 END,
         CASE WHEN phase = 1 THEN l ELSE l1 END,
         CASE WHEN phase = 2 AND l >= l1 THEN (CASE WHEN length = longest THEN 4 * longest ELSE longest END)
              WHEN phase = 2 THEN greatest(2, longest / 4) ELSE longest END,
         CASE WHEN phase = 1 THEN step ELSE length END
  FROM (
    SELECT *, list_concat(list_transform(z[1:{k}], lambda e: exp(e - list_max(z[1:{k}])) / list_sum(list_transform(z[1:{k}], lambda h: exp(h - list_max(z[1:{k}]))))),
              list_concat(z[{k + 1}:{2 * k}], list_transform(z[{2 * k + 1}:], lambda e: greatest(exp(least(e, 700)), {floor})))) AS far
    FROM (
      SELECT *, list_transform(zp, lambda e, i: e + 2 * step * r[i] + step * step * u[i]) AS z
      FROM (
        SELECT *, greatest(1, least(sqrt(list_sum(list_transform(r, lambda e: e * e)) / greatest(list_sum(list_transform(u, lambda e: e * e)), 1e-300)), longest)) AS step
        FROM (
          SELECT *, list_transform(zx, lambda e, i: e - zp[i]) AS r, list_transform(zy, lambda e, i: e - zx[i] - (zx[i] - zp[i])) AS u
          FROM (
            SELECT *, {free('p')} AS zp, {free('x')} AS zx, {free('y')} AS zy
            FROM (
              SELECT it, phase, x, p, p2, l0, l1, longest, length, l / n AS l, list_concat([{each("a{j} / n")}], list_concat(
                     [{each("CASE WHEN a{j} > 0 THEN {m} + b{j} / a{j} ELSE {m} END")}],
                     [{each(f"CASE WHEN a{{j}} > 0 THEN greatest(0, e{{j}} / a{{j}} - (b{{j}} / a{{j}}) * (b{{j}} / a{{j}})) + {floor} ELSE {{s}} END")}])) AS y
              FROM (
                SELECT it, phase, x, p, p2, l0, l1, longest, length, sum(c * (top + ln(t))) AS l,
                       {each("sum(c * d{j} / t) AS a{j}")}, {each("sum(c * d{j} / t * (v - {m})) AS b{j}")},
                       {each("sum(c * d{j} / t * (v - {m}) * (v - {m})) AS e{j}")}
                FROM (
                  SELECT *, {each("d{j}", " + ")} AS t
                  FROM (
                    SELECT *, {each("exp(g{j} - top) AS d{j}")}
                    FROM (
                      SELECT *, greatest({each("g{j}")}) AS top
                      FROM (
                        SELECT fit.*, v, c, {each("ln(x[{j}] / sqrt(2 * pi() * {s})) - (v - {m}) * (v - {m}) * (0.5 / {s}) AS g{j}")}
                        FROM fit, f WHERE NOT done))))
                GROUP BY ALL), n))))))
),
p AS (SELECT unnest(x[1:{k}]) AS w, unnest(x[{k + 1}:{2 * k}]) AS m, unnest(x[{2 * k + 1}:]) AS s FROM fit WHERE done)
SELECT grid_idx, g.x, round(sum(w / sqrt(2 * pi() * s) * exp(-((g.x - m) * (g.x - m)) / (2 * s))), {GMM_DIGITS}) AS density
FROM g, p GROUP BY grid_idx, g.x"""


@register("gmm_density", _gmm_sql())
def gmm_density(spark, sf_dir):
    """13-component Gaussian mixture of event values, fitted to its likelihood
    tolerance, density on the grid.  The SQL runs the same fit as a recursive query."""
    ev = load(spark, sf_dir, "events")
    return rounded(density.gaussian_mixture_density(ev, "value", GMM_PARTS, GRID_LO, GRID_HI, GRID_N),
                   "density", digits=GMM_DIGITS)


# ---------------------------------------------------------------- nested prices

PRICE_LIST_LINES = 64


def price_text_per_order(lineitem):
    """Build the reference's input shape from lineitem: rows keyed by order holding a
    price list as text (a list of dicts in single quotes).

    A list holds an order's lines among ``PRICE_LIST_LINES`` consecutive rows of a split,
    so no list is longer, whatever the order's size and however many of its lines are
    equal; unnesting is per element, so the result is the same as with one list per order.
    The lines are dealt out by list as they are read, not as finished elements, which take
    several times the bytes."""
    block = F.floor(F.monotonically_increasing_id() / PRICE_LIST_LINES).alias("__block")
    used = ("l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
    lines = lineitem.select(F.col("l_orderkey").alias("id"), block, *used).repartition("id", "__block")

    def element(line):
        day = F.to_date(line["l_shipdate"])
        url = F.concat(F.lit("https://shop.example/p/"), line["l_partkey"].cast("string"))
        url2 = F.concat(url, F.lit("?s="), line["l_suppkey"].cast("string"))
        urls = (F.when(line["l_linenumber"] == 7, F.array().cast("array<string>"))
                 .when(line["l_linenumber"] % 2 == 0, F.array(url, url2))
                 .otherwise(F.array(url)))
        return F.struct(
            line["l_extendedprice"].alias("amountMax"),
            (line["l_extendedprice"] * (F.lit(1) - line["l_discount"])).alias("amountMin"),
            F.when(line["l_linenumber"] == 1, F.lit("In Stock")).alias("availability"),
            F.when(line["l_returnflag"] == "N", F.lit("new")).alias("condition"),
            F.lit("USD").alias("currency"),
            F.date_format(line["l_shipdate"], "yyyy-MM-dd").alias("dateAdded"),
            F.array(day.cast("string"), F.date_add(day, line["l_linenumber"]).cast("string")).alias("dateSeen"),
            F.when(line["l_discount"] > 0.05, "true").otherwise("false").alias("isSale"),
            F.concat(F.lit("supplier#"), line["l_suppkey"].cast("string")).alias("merchant"),
            line["l_linestatus"].alias("shipping"),
            urls.alias("sourceURLs"))

    elements = F.transform(F.collect_list(F.struct(*used)), element)
    return (lines.groupBy("id", "__block").agg(F.translate(F.to_json(elements), '"', "'").alias("prices"))
                 .drop("__block"))


@register("price_unnest", """
WITH b AS (
  SELECT l_orderkey AS id, l_extendedprice AS amountMax, l_extendedprice * (1 - l_discount) AS amountMin,
         CASE WHEN l_linenumber = 1 THEN 'In Stock' END AS availability,
         CASE WHEN l_returnflag = 'N' THEN 'new' END AS condition,
         'USD' AS currency, strftime(l_shipdate, '%Y-%m-%d') AS dateAdded,
         [CAST(CAST(l_shipdate AS DATE) AS VARCHAR),
          CAST(CAST(l_shipdate AS DATE) + l_linenumber AS VARCHAR)] AS ds,
         CASE WHEN l_discount > 0.05 THEN 'true' ELSE 'false' END AS isSale,
         'supplier#' || CAST(l_suppkey AS VARCHAR) AS merchant, l_linestatus AS shipping,
         CASE WHEN l_linenumber = 7 THEN []::VARCHAR[]
              WHEN l_linenumber % 2 = 0 THEN ['https://shop.example/p/' || CAST(l_partkey AS VARCHAR),
                   'https://shop.example/p/' || CAST(l_partkey AS VARCHAR) || '?s=' || CAST(l_suppkey AS VARCHAR)]
              ELSE ['https://shop.example/p/' || CAST(l_partkey AS VARCHAR)] END AS urls
  FROM lineitem),
x AS (SELECT DISTINCT id, amountMax, amountMin, availability, condition, currency, dateAdded, dateSeen,
             isSale, merchant, shipping, sourceURLs
      FROM b, unnest(ds) AS t(dateSeen),
           unnest(CASE WHEN len(urls) = 0 THEN [NULL]::VARCHAR[] ELSE urls END) AS u(sourceURLs))
SELECT id, amountMax, amountMin, currency, dateAdded, dateSeen, isSale, merchant, shipping, sourceURLs FROM x""")
def price_unnest(spark, sf_dir):
    """X14-X16 + D3 + L9 + A7: parse each order's price text, one row per element,
    unnest dates and URLs, drop duplicates, drop the sparse columns."""
    texts = price_text_per_order(load(spark, sf_dir, "lineitem"))
    return prices.unnest_prices(texts, "id", "prices")


@register("price_parse_report", """
WITH t AS (SELECT l_orderkey % 10 = 0 AS broken FROM lineitem)
SELECT count(*) AS lists, count(*) FILTER (NOT broken) AS parsed, count(*) FILTER (broken) AS rejected FROM t""")
def price_parse_report(spark, sf_dir):
    """Lists present, parsed and rejected; every line is a list of one price here, and
    those of each tenth order lack their closing bracket."""
    li = load(spark, sf_dir, "lineitem")
    whole = F.format_string("[{'amountMax': %s, 'isSale':                     True}", F.col("l_extendedprice").cast("string"))
    texts = li.select(F.concat(whole, F.when(F.col("l_orderkey") % 10 != 0, F.lit("]")).otherwise(F.lit(", {"))).alias("prices"))
    return prices.price_parse_report(texts, "prices")
