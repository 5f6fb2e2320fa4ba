"""Scenario comparison: comparable units, percentages, profiles, shares, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluxweave.operators import guards

#: Order of the impact categories, and yearly impacts of one person.
NORMALIZATION = {
    "Global warming": 8040.0, "Acidification": 11.5, "Eutrophication (Freshwater)": 1.45, "Eutrophication (Marine)": 2.06, "Freshwater ecotoxicity": 3.93e6,
    "Human health - cancer": 1.56e-5, "Human health - non-cancer": 2.27e-4, "Human health - particulate matter": 1.51, "Ozone depletion": 7.47e-2, "Smog formation": 233.0,
}
CATEGORIES = tuple(NORMALIZATION)
#: Ratio to the baseline that is refused, scenarios shown, accepted deviation, and wider bands.
MAX_RATIO, MAX_SERIES, TOLERANCE, BANDS = 1000.0, 8, 0.001, (0.05, 0.20)


def first_units(rows: DataFrame) -> DataFrame:
    """The first functional unit of each scenario by pos, nulls skipped."""
    return rows.groupBy("scenario").agg(F.min("pos").alias("pos"), F.min_by("functional_unit", F.when(F.col("functional_unit").isNotNull(), F.col("pos"))).alias("functional_unit"))


def comparable(rows: DataFrame) -> DataFrame:
    """Each scenario with the baseline's unit: comparable if equal. Without any units all are, unverified."""
    units = first_units(rows)
    base = units.agg(F.min_by("scenario", "pos").alias("baseline"), F.min_by(F.struct("functional_unit"), "pos").alias("b"), F.count("functional_unit").alias("n_units"))
    out = units.join(F.broadcast(base), F.lit(True))
    same = (F.col("n_units") == 0) | F.col("functional_unit").eqNullSafe(F.col("b.functional_unit"))
    return out.select("scenario", "functional_unit", "baseline", F.col("b.functional_unit").alias("baseline_unit"), same.alias("comparable"), (F.col("n_units") > 0).alias("verified"))


def first_scenarios(rows: DataFrame, keep: str | None = None, most: int = MAX_SERIES) -> DataFrame:
    """The first scenarios in order of appearance; the baseline stays in any case."""
    firsts = rows.groupBy("scenario").agg(F.min("pos").alias("pos"))
    shown = firsts.orderBy("pos", "scenario").limit(most)
    return shown if keep is None else shown.unionByName(firsts.where(F.col("scenario") == keep)).distinct()


def against_baseline(scores: DataFrame, baseline: str) -> DataFrame:
    """scenario, method, score, base_score, percent (null where the baseline is 0)."""
    base = scores.where(F.col("scenario") == baseline).select("method", F.col("score").alias("base_score"))
    return scores.join(base, "method", "left").withColumn("percent", 100 * F.try_divide("score", F.abs("base_score")))


def baseline_guard(scores: DataFrame, baseline: str, most: float = MAX_RATIO) -> DataFrame:
    """One row: the largest magnitude relative to the baseline, and whether the comparison is refused."""
    rows = against_baseline(scores, baseline).where(F.col("scenario") != baseline)
    per = rows.groupBy("method").agg(F.max(F.try_divide(F.abs("score"), F.abs("base_score"))).alias("ratio"))
    return per.agg(F.max("ratio").alias("max_ratio")).withColumn("refused", F.coalesce(F.col("max_ratio") > most, F.lit(False)))


def profile(scores: DataFrame, order: DataFrame) -> DataFrame:
    """Magnitude and sign of each score, in category order (method, place); unknown categories come last."""
    rows = scores.join(order, "method", "left")
    return rows.select("scenario", "method", F.abs("score").alias("magnitude"), (F.col("score") < 0).alias("negative"), F.coalesce("place", F.lit(9999)).alias("place"))


def normalized(scores: DataFrame, reference: DataFrame) -> DataFrame:
    """Scores in persons' yearly impacts; the reference (method, per_person) gives the methods, missing scores are 0."""
    scenarios = scores.select("scenario").distinct()
    grid = scenarios.join(F.broadcast(reference), F.lit(True))
    rows = grid.join(scores, ["scenario", "method"], "left")
    return rows.select("scenario", "method", (F.coalesce("score", F.lit(0.0)) / F.nullif("per_person", F.lit(0.0))).alias("persons"))


def top_contributors(contributions: DataFrame, n: int = 7) -> DataFrame:
    """The n activities of each scenario with the largest sum of magnitudes over methods."""
    sums = contributions.groupBy("scenario", "code").agg(F.sum(F.abs("score")).alias("magnitude"))
    w = Window.partitionBy("scenario").orderBy(F.desc("magnitude"), "code")
    return sums.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def shares(contributions: DataFrame, top: DataFrame) -> DataFrame:
    """Percent of each category's total, by top contributor and 'Other' (0 where the total is 0)."""
    rows = contributions.join(top.select("scenario", "code", F.lit(True).alias("is_top")), ["scenario", "code"], "left")
    g = rows.groupBy("scenario", "method", F.when(F.col("is_top"), F.col("code").cast("string")).otherwise("Other").alias("part")).agg(F.sum("score").alias("score"))
    total = g.groupBy("scenario", "method").agg(F.sum("score").alias("total"))
    return g.join(total, ["scenario", "method"]).select("scenario", "method", "part", F.coalesce(100 * F.try_divide("score", "total"), F.lit(0.0)).alias("percent"))


def foreground_split(contributions: DataFrame, targets: DataFrame) -> DataFrame:
    """Percent of each score from the target's own activity (scenario, target) and from the rest."""
    rows = contributions.join(targets, "scenario")
    own = F.sum(F.when(F.col("code") == F.col("target"), F.col("score")).otherwise(0.0))
    g = rows.groupBy("scenario", "method").agg(own.alias("own"), F.sum("score").alias("total"))
    return g.select("scenario", "method", F.coalesce(100 * F.try_divide("own", "total"), F.lit(0.0)).alias("foreground"), F.coalesce(100 * F.try_divide(F.col("total") - F.col("own"), "total"), F.lit(0.0)).alias("background"))


def shared_scenarios(results: DataFrame, contributions: DataFrame) -> DataFrame:
    """Scenarios of both tables; having none in common is an error."""
    shared = results.select("scenario").intersect(contributions.select("scenario"))
    guards.require_some(shared, "results and contributions share no scenario")
    return shared


def kg_per_unit(unit: Column, density: Column) -> Column:
    """kg in one unit: kg (or no unit) is 1, cubic metres have the configured density, all else is an error."""
    name = F.lower(F.trim(F.coalesce(unit, F.lit("kg"))))
    kg = F.when(name.isin("kg", ""), 1.0).when(name.isin("m3", "cubic meter", "cubic metres"), density)
    return F.coalesce(kg, F.raise_error(F.concat(F.lit("no mass basis for "), name)).cast("double"))


def rescale_to_kg(scores: DataFrame, densities: DataFrame) -> DataFrame:
    """Scores (scenario, unit, score) per kg; densities: scenario, density."""
    rows = scores.join(densities, "scenario", "left")
    return rows.withColumn("kg_per_unit", kg_per_unit(F.col("unit"), F.col("density"))).withColumn("score_per_kg", F.col("score") / F.col("kg_per_unit"))


def kg_per_run(production: DataFrame, densities: DataFrame) -> DataFrame:
    """kg that one run of each activity makes: production (code, amount, unit) times kg per unit; densities: code, density."""
    rows = production.join(densities, "code", "left")
    return rows.select("code", (F.col("amount") * kg_per_unit(F.col("unit"), F.col("density"))).alias("kg_per_run"))


def ratios(cells: DataFrame) -> DataFrame:
    """cells: process, category, computed, reference. Adds ratio, percent clipped at 200, band and label."""
    ratio = F.try_divide("computed", "reference")
    rows = cells.withColumn("ratio", ratio)
    off = F.abs(F.col("ratio") - 1)
    band = F.when(F.col("ratio").isNull(), "none").when(off <= TOLERANCE, "within 0.1%").when(off <= BANDS[0], "within 5%").when(off <= BANDS[1], "within 20%").otherwise("outside")
    return rows.withColumn("percent", F.least(100 * F.col("ratio"), F.lit(200.0))).withColumn("band", band).withColumn("label", F.concat_ws(" | ", "process", "category"))


def match_references(scores: DataFrame, references: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cells: process, category, computed, reference; rows of either side without a partner, and which side).

    scores: process, category, score; references: process, category, ol_score. Names match exactly.
    """
    key = ["process", "category"]
    mine, theirs = scores.select(*key, F.col("score").alias("computed")), references.select(*key, F.col("ol_score").alias("reference"))
    alone = mine.join(theirs, key, "left_anti").select(*key, F.lit("no reference").alias("reason"))
    missing = theirs.join(mine, key, "left_anti").select(*key, F.lit("not computed").alias("reason"))
    return mine.join(theirs, key), alone.unionByName(missing)


def gate(cells: DataFrame) -> DataFrame:
    """One row: cells, failures, largest deviation, verdict. A zero against a non-zero score fails either way."""
    rows = ratios(cells)
    both_zero = (F.col("computed") == 0) & (F.col("reference") == 0)
    fails = ~both_zero & (F.col("ratio").isNull() | (F.abs(F.col("ratio") - 1) > TOLERANCE))
    g = rows.agg(F.count(F.lit(1)).alias("n_cells"), F.count_if(fails).alias("n_failed"), F.max(F.abs(F.col("ratio") - 1)).alias("max_deviation"))
    return g.withColumn("verdict", F.when(F.col("n_failed") == 0, "PASS").otherwise("FAIL"))


def same_vintage(cases: DataFrame, build: str | None) -> tuple[DataFrame, DataFrame]:
    """(cases to run, cases skipped because they expect another vintage)."""
    fits = F.col("expected").isNull() | F.lit(build is None) | (F.col("expected") == F.lit(build))
    return cases.where(fits), cases.where(~fits)


def pivot(scores: DataFrame, methods: list[str]) -> DataFrame:
    """One row per scenario, one column per method."""
    return scores.groupBy("scenario").pivot("method", methods).agg(F.first("score"))


def score_of(scores: DataFrame, method: str) -> DataFrame:
    """Scores of one method; an unknown method is an error that names the known ones."""
    rows = scores.where(F.col("method") == method)
    if rows.isEmpty():
        known = sorted(r["method"] for r in scores.select("method").distinct().limit(100).collect())
        raise KeyError(f"no method {method!r}; there are {', '.join(known)}")
    return rows
