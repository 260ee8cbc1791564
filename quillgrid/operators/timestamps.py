"""Problem 3: timestamps in mixed formats and zones, by expectation-maximisation over formats per source.

Each value contributes its likelihood under every valid reading. Per source, a mixture has for each
layout a weight for each order of day, month and year, and one distribution of years; a reading's
likelihood is its order's weight times its year's probability. The order a source is said to use
(``date_order``) enters as a prior for all-digit layouts. EM runs twice: the first run's weights,
pooled over all sources, are a weak prior of the second, which decides layouts that a source shows
only a few times. Values of one source with the same layout and the same years
under each order are alike to the model, so EM runs over their counts: Spark aggregates the values
to those few rows first, and only they are grouped by source. The posterior of the best reading is
reported; below ``SURE`` the value is marked ambiguous, never silently decided.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid.functions.timestamps import ORDERS, readings
from quillgrid.runtime import as_table

SURE, ROUNDS = 0.9, 60
#: Pseudo-counts: of the order that the source is said to use, of the orders of all sources, of every order, of every year.
PRIOR, POOL, FLAT, YEAR_FLAT = 4.0, 3.0, 0.25, 0.02
#: The layout of month names with years of two digits, of which a stated order says nothing.
NAMED = "m"


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for raw, zone in zip(batch["raw"], batch["zone"]):
            layout, found = readings(raw, zone)
            row = [layout if found else None]
            for order in ("x", *ORDERS):
                row += found.get(order, (None, None))
            rows.append(row)
        names = ["layout", *[c for o in ("x", *ORDERS) for c in (f"at_{o}", f"y_{o}")]]
        made = pd.DataFrame(rows, columns=names, dtype=object)
        yield pd.concat([batch[["record", "source", "stated"]].reset_index(drop=True), made], axis=1)


def fit(rows: list[tuple[str, dict[str, int], int]], stated: str | None, pooled: dict[tuple[str, str], float] | None = None) -> list[tuple[str, float]]:
    """EM for one source. rows: (layout, {order: year}, count); gives the best order and its posterior for each row.

    pooled: the share of each (layout, order) over all sources.
    """
    years: dict[int, float] = {}
    weights: dict[str, dict[str, float]] = {}
    for layout, seen, n in rows:
        if layout == "":
            years[seen["x"]] = years.get(seen["x"], 0.0) + n
        else:
            for o in seen:
                weights.setdefault(layout, {})[o] = FLAT + (PRIOR if o == stated and layout != NAMED else 0.0) + POOL * (pooled or {}).get((layout, o), 0.0) * (0.1 if stated in seen and layout != NAMED else 1.0)
    prior_years, prior = dict(years), {k: dict(v) for k, v in weights.items()}

    def posterior(layout: str, seen: dict[str, int]) -> dict[str, float]:
        total = sum(years.values()) + YEAR_FLAT * 100
        scale = sum(weights[layout].values())
        p = {o: weights[layout][o] / scale * (years.get(y, 0.0) + YEAR_FLAT) / total for o, y in seen.items()}
        s = sum(p.values())
        return {o: v / s for o, v in p.items()}

    for _ in range(ROUNDS):
        new_years, new = dict(prior_years), {k: dict(v) for k, v in prior.items()}
        for layout, seen, n in rows:
            if layout != "":
                for o, p in posterior(layout, seen).items():
                    new[layout][o] += n * p
                    new_years[seen[o]] = new_years.get(seen[o], 0.0) + n * p
        change = max((abs(new[k][o] - weights[k][o]) for k in new for o in new[k]), default=0.0)
        years, weights = new_years, new
        if change < 1e-6:
            break
    out = []
    for layout, seen, _ in rows:
        if layout == "":
            out.append(("x", 1.0))
        else:
            p = posterior(layout, seen)
            best = max(ORDERS, key=lambda o: (p.get(o, -1.0), o == stated))
            out.append((best, p[best]))
    return out


def _fit_source(pooled: dict[tuple[str, str], float] | None):
    orders = ["x", *ORDERS]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        rows = [(r["layout"], {o: int(r[f"y_{o}"]) for o in orders if r[f"y_{o}"] > -99999}, int(r["n"])) for _, r in group.iterrows()]
        stated = group["stated"].iloc[0]
        best = fit(rows, stated if stated in ORDERS else None, pooled)
        return group[["source", "layout", *[f"y_{o}" for o in orders], "n"]].assign(best=[b for b, _ in best], posterior=[p for _, p in best])

    return run


def normalized(values: DataFrame, locale: DataFrame) -> DataFrame:
    """(record, source, utc_micros, reading, posterior, status) for each row of ``values`` (record, source, raw).

    ``locale``: (source_id, time_zone, date_order). status is ``certain`` (one reading), ``resolved``
    or ``ambiguous`` (the best of several, by its posterior) or ``unusable`` (null instant: null,
    blank, or no existing date). A source without a locale, or null, is read as UTC without a prior.
    """
    zones = locale.select(F.col("source_id").alias("zone_of"), F.col("time_zone").alias("zone"), F.col("date_order").alias("stated"))
    zones = zones.groupBy("zone_of").agg(F.min(F.struct("zone", "stated")).alias("z")).select("zone_of", "z.*")  # one row for a source, whatever is repeated
    base = values.select("record", "source", "raw").join(zones, F.col("source") == F.col("zone_of"), "left")
    kinds = {c: base.schema[c].dataType.simpleString() for c in ("record", "source")}
    orders = ["x", *ORDERS]
    parsed_type = f"record {kinds['record']}, source {kinds['source']}, stated string, layout string, " + ", ".join(f"at_{o} long, y_{o} int" for o in orders)
    parsed = as_table(base.select("record", "source", "raw", "zone", "stated").mapInPandas(_parse, parsed_type), "timestamps")
    key = ["source", "layout", *[f"y_{o}" for o in orders]]
    filled = parsed.withColumns({"source_key": F.coalesce(F.col("source").cast("string"), F.lit(""))} | {f"y_{o}": F.coalesce(f"y_{o}", F.lit(-100000)) for o in orders})
    signed = filled.where("layout is not null").withColumn("source", F.col("source_key"))
    counts = signed.groupBy(*key).agg(F.max("stated").alias("stated"), F.count(F.lit(1)).alias("n"))
    counts = as_table(counts, "layouts")
    fitted = "source string, layout string, " + ", ".join(f"y_{o} int" for o in orders) + ", n long, best string, posterior double"
    first = counts.groupBy("source").applyInPandas(_fit_source(None), fitted).where("best <> 'x'")
    # at most one row for each layout and order, of which there are a few dozen
    shares = first.groupBy("layout", "best").agg(F.sum(F.col("n") * F.col("posterior")).alias("n")).collect()
    whole = {x: sum(r.n for r in shares if r.layout == x) for x in {r.layout for r in shares}}
    pooled = {(r.layout, r.best): r.n / whole[r.layout] for r in shares}
    chosen = as_table(counts.groupBy("source").applyInPandas(_fit_source(pooled), fitted), "readings")
    renamed = chosen.select(F.col("source").alias("source_key"), "layout", *[f"y_{o}" for o in orders], "best", "posterior")
    joined = filled.join(renamed, ["source_key", *key[1:]], "left")
    at = F.coalesce(*[F.when(F.col("best") == o, F.col(f"at_{o}")) for o in orders])
    status = F.when(F.col("best").isNull(), "unusable").when(F.col("best") == "x", "certain").when(F.col("posterior") >= SURE, "resolved").otherwise("ambiguous")
    return joined.select("record", "source", at.alias("utc_micros"), F.when(F.col("best") == "x", "fixed").otherwise(F.col("best")).alias("reading"), "posterior", status.alias("status"))


def table_readings(articles: DataFrame, targets: DataFrame, locale: DataFrame) -> DataFrame:
    """(table_name, record_id, utc_micros, reading, posterior, status) of every value of the two tables, which share one model per source."""

    def values(df: DataFrame, name: str, column: str) -> DataFrame:
        # Arrow passes flat columns faster than structs
        return df.where(F.col(column).isNotNull()).select(F.concat_ws("\u0001", F.lit(name), "id").alias("record"), F.col("source_id").alias("source"), F.col(column).alias("raw"))

    both = values(articles, "articles", "published_at").unionByName(values(targets, "source_category_targets", "last_seen_published_at"))
    parts = F.split("record", "\u0001", 2)
    return normalized(both, locale).select(parts[0].alias("table_name"), parts[1].alias("record_id"), "utc_micros", "reading", "posterior", "status")


def table_instants(articles: DataFrame, targets: DataFrame, locale: DataFrame) -> DataFrame:
    """(table_name, record_id, utc_micros) of every usable timestamp of the two tables."""
    return table_readings(articles, targets, locale).where("utc_micros is not null").select("table_name", "record_id", "utc_micros")
