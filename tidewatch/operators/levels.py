"""Severity levels: tenant tables, status text, and the level of a scored point."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.config import DEFAULTS, MAX_LEVELS, NO_LEVEL, LevelRule, Settings
from tidewatch.functions.steps import recurrence_text
from tidewatch.operators.joins import lookup
from tidewatch.schemas import LEVELS_JSON

_THRESHOLDS = ("min_weight", "min_pct", "min_value", "min_predict_pct")
_RULE_TYPE = "array<struct<level:int,min_weight:double,min_pct:double,min_value:double,min_predict_pct:double,rec_count:int>>"


def rules_literal(rules: tuple[LevelRule, ...]) -> Column:
    """The rules as one constant array, lowest level first."""
    structs = [
        f"named_struct('level', {r.level}, "
        + ", ".join(f"'{t}', {float(getattr(r, t))}D" for t in _THRESHOLDS)
        + f", 'rec_count', {r.rec_count})"
        for r in sorted(rules, key=lambda r: r.level)
    ]
    return F.expr(f"CAST(array({', '.join(structs)}) AS {_RULE_TYPE})")


def decode_levels(json: Column) -> Column:
    """Levels JSON as an array of rules, lowest first; NULL when it holds none or one that is no level.

    A level is a whole number from 0 on.  A rule keeps its place when a parameter is missing: a missing threshold
    is 0, a missing count 0.
    """
    entries = F.map_entries(F.from_json(json, LEVELS_JSON))
    rules = F.transform(
        entries,
        lambda e: F.struct(
            e["key"].try_cast("int").alias("level"),
            *[F.coalesce(e["value"][t], F.lit(0.0)).alias(t) for t in _THRESHOLDS],
            F.coalesce(e["value"]["rec_count"], F.lit(0)).alias("rec_count"),
        ),
    )
    sorted_rules = F.sort_array(rules).cast(_RULE_TYPE)
    # Picked from a list of one, so that the JSON is decoded once and not again for the tests.
    good = lambda found: (F.size(found) > 0) & F.forall(found, lambda r: F.coalesce(r["level"] >= 0, F.lit(False)))
    return F.try_element_at(F.filter(F.array(sorted_rules), good), F.lit(1))


def names_no_level(json: Column) -> Column:
    """True for levels JSON with a key that is no whole number from 0 on."""
    keys = F.map_keys(F.from_json(json, LEVELS_JSON))
    return F.coalesce(F.exists(keys, lambda k: ~F.coalesce(k.try_cast("int") >= 0, F.lit(False))), F.lit(False))


def tenant_dead_letters(users: DataFrame) -> DataFrame:
    """(uuid, reason) of stored levels that can't be read; their tenants are given the defaults."""
    filled = F.coalesce(F.trim("AL"), F.lit("")).isin("", "{}", "null")
    refused = users.where(~filled & decode_levels(F.col("AL")).isNull())
    return refused.select("uuid", F.when(names_no_level(F.col("AL")), "bad_level").otherwise("bad_levels").alias("reason"))


def levels_in_use(settings: Settings = DEFAULTS, *tables: DataFrame | None) -> tuple[int, ...]:
    """All levels that the default rules and the tables' ``rules`` name, lowest first."""
    found = {r.level for r in settings.default_levels}
    for table in tables:
        if table is not None:
            named = table.select(F.explode("rules.level").alias("level")).distinct()
            found.update(r.level for r in named.limit(MAX_LEVELS + 1).collect())
    if len(found) > MAX_LEVELS:
        raise ValueError(f"rules name more than {MAX_LEVELS} different levels")
    return tuple(sorted(found))


def tenant_rules(users: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """(uuid, rules) from the user table's levels JSON column ``AL``; empty JSON means the defaults."""
    decoded = users.select("uuid", decode_levels(F.col("AL")).alias("rules"))
    return decoded.withColumn("rules", F.coalesce("rules", rules_literal(settings.default_levels)))


def rules_to_rows(rules: DataFrame) -> DataFrame:
    """One row per tenant and level, all other columns kept."""
    keep = [c for c in rules.columns if c != "rules"]
    return rules.select(*keep, F.inline("rules"))


def rows_to_rules(levels: DataFrame) -> DataFrame:
    """(uuid, rules) from one row per tenant and level."""
    rule = F.struct("level", *_THRESHOLDS, "rec_count")
    return levels.groupBy("uuid").agg(F.array_sort(F.collect_list(rule)).cast(_RULE_TYPE).alias("rules"))


def recurrence_literal(rules: tuple[LevelRule, ...]) -> Column:
    """What ``recurrence_text`` makes of the same rules, as a constant."""
    return F.lit(",".join(f"{r.level}:{max(r.rec_count, 0)}" for r in sorted(rules, key=lambda r: r.level)))


def attach_rules(points: DataFrame, rules: DataFrame | None = None, settings: Settings = DEFAULTS) -> DataFrame:
    """Add each point's tenant ``rules`` and their ``recurrences``, the defaults for tenants without their own."""
    default = rules_literal(settings.default_levels), recurrence_literal(settings.default_levels)
    if rules is None:
        return points.withColumns({"rules": default[0], "recurrences": default[1]})
    table = rules.select("uuid", "rules", recurrence_text(F.col("rules")).alias("recurrences"))
    found = lookup(points, table, ["uuid"])
    return found.withColumns({c: F.coalesce(c, d) for c, d in zip(("rules", "recurrences"), default)})


def point_level(points: DataFrame) -> DataFrame:
    """Add ``level``: the highest one whose thresholds are all met, or -1.

    Sizes count, not signs.  An undefined percent passes.  Points without weight have no level.
    """

    met = (
        "abs(weight) >= r.min_weight AND coalesce(abs(weight_pct) >= r.min_pct, true)"
        " AND abs(value) >= r.min_value AND abs(predict_pct) >= r.min_predict_pct"
    )
    reached = f"array_max(transform(filter(rules, r -> {met}), r -> r.level))"
    level = F.expr(f"CASE WHEN weight = 0 THEN {NO_LEVEL} ELSE coalesce({reached}, {NO_LEVEL}) END")
    return points.withColumn("level", level)


def status_table(spark: SparkSession, settings: Settings = DEFAULTS) -> DataFrame:
    return spark.createDataFrame(sorted(settings.status_levels.items()), "status string, status_level int")


def with_status_level(points: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Add the level of a special point's status, NULL for a status nobody knows."""
    # A handful of configured names.
    return points.join(F.broadcast(status_table(points.sparkSession, settings)), "status", "left")
