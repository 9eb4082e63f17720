"""Quality rules (Q1-Q8) and the quality report.

All scores are native expressions built from the rule config and the
DataFrame's schema, so scoring is one narrow projection (no shuffle); the
report is a single partial+final aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import QualityRules
from ..functions.clean import round_half_up, strip_ws


def _field_type(df: DataFrame, name: str):
    for f in df.schema.fields:
        if f.name == name:
            return f.dataType
    return None


def _present(df: DataFrame, name: str) -> Column:
    """Python truthiness of a field: non-NULL and non-empty (string/array/map), non-zero number."""
    t = _field_type(df, name)
    if t is None:
        return F.lit(False)
    c = F.col(name)
    if isinstance(t, T.StringType):
        return F.coalesce(c != "", F.lit(False))
    if isinstance(t, (T.ArrayType, T.MapType)):
        return F.coalesce(F.size(c) > 0, F.lit(False))
    if isinstance(t, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    if isinstance(t, T.NumericType):
        return F.coalesce(c != 0, F.lit(False))
    return c.isNotNull()


def completeness(df: DataFrame, rules: QualityRules | None = None) -> Column:
    """Q1: weighted completeness by field type, divided by the total weight."""
    r = rules or QualityRules()
    total = 0.0
    achieved = None
    for name, w in r.weights.items():
        total += w
        t = _field_type(df, name)
        c = F.col(name) if t is not None else None
        if t is None:
            part = F.lit(0.0)
        elif isinstance(t, T.StringType):
            part = F.when(F.coalesce(strip_ws(c) != "", F.lit(False)), F.lit(w)).otherwise(F.lit(0.0))
        elif isinstance(t, T.ArrayType):
            part = F.when(F.coalesce(F.size(c) > 0, F.lit(False)),
                          F.lit(w) * F.least(F.size(c).cast("double") / F.lit(3.0), F.lit(1.0))
                          ).otherwise(F.lit(0.0))
        elif isinstance(t, (T.NumericType, T.BooleanType)):
            part = F.when(F.coalesce(c.cast("double") > 0, F.lit(False)), F.lit(w)).otherwise(F.lit(0.0))
        else:
            part = F.lit(0.0)
        achieved = part if achieved is None else achieved + part
    if achieved is None or total <= 0:
        return F.lit(0.0)
    return achieved / F.lit(total)


_NETLOC_URL = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+"


def url_validity(c) -> Column:
    """Q2b helper: missing -> 0.5; scheme and network location present -> 1; else 0.

    Mirrors the standard URL splitter: leading C0/space characters are ignored,
    tab/CR/LF are removed, and an unbalanced '[' / ']' in the host is invalid.
    """
    col = F.col(c) if isinstance(c, str) else c
    norm = F.regexp_replace(F.regexp_replace(col, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    netloc = F.regexp_extract(norm, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    unbalanced = netloc.contains("[") != netloc.contains("]")
    valid = norm.rlike(_NETLOC_URL) & ~unbalanced
    return (F.when(col.isNull() | (col == ""), F.lit(0.5))
            .when(valid, F.lit(1.0)).otherwise(F.lit(0.0)))


def _match_start(c: Column, pattern: str) -> Column:
    """Python ``re.match``: the pattern anchored at the start only."""
    return F.coalesce(c.rlike(f"^(?:{pattern})"), F.lit(False))


def quality(df: DataFrame, rules: QualityRules | None = None) -> Column:
    """Q2: mean of five checks (mandatory, URLs, country, tier, description length)."""
    r = rules or QualityRules()
    mand = F.lit(True)
    for name in r.mandatory:
        t = _field_type(df, name)
        if t is None:
            mand = F.lit(False)
            continue
        ok = F.col(name).isNotNull()
        if isinstance(t, T.StringType):
            ok = ok & (F.col(name) != "")
        mand = mand & F.coalesce(ok, F.lit(False))
    q_mand = F.when(mand, F.lit(1.0)).otherwise(F.lit(0.0))
    q_url = (url_validity("website") + url_validity("source_url")) / F.lit(2.0)
    q_country = F.when(_match_start(F.col("country"), r.country_pattern), F.lit(1.0)).otherwise(F.lit(0.5))
    if r.tier_pattern is None:
        q_tier = F.lit(1.0)
    else:
        q_tier = F.when(_match_start(F.coalesce(F.col("tier"), F.lit("Unknown")), r.tier_pattern),
                        F.lit(1.0)).otherwise(F.lit(0.3))
    desc = F.col("description")
    q_desc = F.when(desc.isNull() | (desc == ""), F.lit(0.0)).otherwise(
        F.least(F.length(desc).cast("double") / F.lit(r.description_full), F.lit(1.0)))
    return (q_mand + q_url + q_country + q_tier + q_desc) / F.lit(5.0)


def quality_flags(df: DataFrame, rules: QualityRules | None = None) -> Column:
    """Q3: MAP<STRING,BOOLEAN> holding only the raised flags, in rule order."""
    r = rules or QualityRules()
    kv = []
    for name in r.mandatory:
        kv += [F.lit(f"missing_{name}"), ~_present(df, name)]
    kv += [F.lit("no_website"), ~_present(df, "website")]
    desc = F.col("description")
    kv += [F.lit("short_description"),
           F.coalesce(desc.isNull() | (desc == "") | (F.length(desc) < r.short_description), F.lit(True))]
    return F.map_filter(F.create_map(*kv), lambda k, v: v)


def flags_text(c="quality_flags") -> Column:
    """Raised flag names as one sorted, comma-joined string (for exports and checks)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.array_join(F.sort_array(F.map_keys(col)), ",")


def score_providers(df: DataFrame, rules: QualityRules | None = None) -> DataFrame:
    """Q4: append data_completeness_score, data_quality_score (2 digits) and quality_flags."""
    return df.withColumns({
        "data_completeness_score": round_half_up(completeness(df, rules), 2),
        "data_quality_score": round_half_up(quality(df, rules), 2),
        "quality_flags": quality_flags(df, rules),
    })


def check_mandatory(df: DataFrame, fields: list[str]) -> Column:
    """Q6: 1 when every listed field is non-NULL and not '' (any entity), else 0."""
    ok = F.lit(True)
    for name in fields:
        t = _field_type(df, name)
        if t is None:
            return F.lit(0)
        cond = F.col(name).isNotNull()
        if isinstance(t, T.StringType):
            cond = cond & (F.col(name) != "")
        ok = ok & F.coalesce(cond, F.lit(False))
    return F.when(ok, F.lit(1)).otherwise(F.lit(0))


def check_entity(df: DataFrame, entity: str, rules: QualityRules | None = None) -> Column:
    """Q6: ``check_mandatory`` with the fields that the rules declare for ``entity``."""
    declared = (rules or QualityRules()).entities
    if entity not in declared:
        raise ValueError(f"no rules for {entity!r}; known: {', '.join(sorted(declared))}")
    return check_mandatory(df, declared[entity])


def mandatory_report(tables: Mapping[str, DataFrame], rules: QualityRules | None = None) -> DataFrame:
    """Q6 over several entities: a row for each declared field (entity, field, n_rows, n_missing), and one with a null
    field for the rows that lack any. A column that a table does not have is missing in every row. One partial and
    final aggregation a table; an entity without rows counts 0."""
    r, out = rules or QualityRules(), None
    for entity, df in tables.items():
        fields = r.entities[entity] if entity in r.entities else []
        lacks = [(None, check_entity(df, entity, r))] + [(f, check_mandatory(df, [f])) for f in fields]
        counts = df.agg(F.count(F.lit(1)).alias("n_rows"),
                        *[F.coalesce(F.sum(1 - ok), F.lit(0)).cast("long").alias(f"m{i}") for i, (_, ok) in enumerate(lacks)])
        cells = F.array(*[F.struct(F.lit(f).cast("string").alias("field"), F.col(f"m{i}").alias("n_missing"))
                          for i, (f, _) in enumerate(lacks)])
        rows = counts.select(F.lit(entity).alias("entity"), "n_rows", F.explode(cells).alias("x")).select(
            "entity", "x.field", "n_rows", "x.n_missing")
        out = rows if out is None else out.unionByName(rows)
    return out


def _avg_2dp(c: str) -> Column:
    # Scores are multiples of 0.01: average their integer hundredths exactly.
    return F.sum(F.round(F.col(c) * 100).cast("bigint")).cast("double") / (F.count(c).cast("double") * 100.0)


def quality_report(scored: DataFrame) -> DataFrame:
    """A13 + A14 (+Q5): one row; total 0 and NULL averages on empty input."""
    comp, qual = F.col("data_completeness_score"), F.col("data_quality_score")

    def bands(c: Column, prefix: str):
        return [F.count_if(c > 0.8).alias(f"{prefix}_high"),
                F.count_if((c >= 0.5) & (c <= 0.8)).alias(f"{prefix}_medium"),
                F.count_if(c < 0.5).alias(f"{prefix}_low")]

    return scored.agg(
        F.count(F.lit(1)).alias("total_providers"),
        round_half_up(_avg_2dp("data_completeness_score"), 3).alias("average_completeness"),
        round_half_up(_avg_2dp("data_quality_score"), 3).alias("average_quality"),
        *bands(comp, "completeness"), *bands(qual, "quality"))


def flag_frequency(scored: DataFrame, top: int = 10) -> DataFrame:
    """Most common flags, count desc, flag name as tie-break; top-N is the feature."""
    return (scored.select(F.explode(F.map_keys("quality_flags")).alias("flag"))
            .groupBy("flag").agg(F.count(F.lit(1)).alias("providers"))
            .orderBy(F.desc("providers"), F.asc("flag")).limit(top))


def flag_share(scored: DataFrame, top: int = 10) -> DataFrame:
    """Top flags with their share of all providers in percent (1 decimal)."""
    total = scored.agg(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("__total"))   # one row
    return flag_frequency(scored, top).join(F.broadcast(total), F.lit(True)).select(
        "flag", "providers",
        round_half_up(F.col("providers") * 100.0 / F.col("__total").cast("double"), 1).alias("pct"))


def check_constraints(df: DataFrame, not_null: list[str] = (), len2: list[str] = (),
                      unit_interval: list[str] = ()) -> DataFrame:
    """Q7: one row of violation counts for declared column constraints (one scan)."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in not_null:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"null_{c}"))
    for c in len2:
        aggs.append(F.count_if(F.length(F.col(c)) != 2).alias(f"len2_{c}"))
    for c in unit_interval:
        aggs.append(F.count_if((F.col(c) < 0) | (F.col(c) > 1)).alias(f"range_{c}"))
    return df.agg(*aggs)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q7 primary key: keys that occur more than once, with their multiplicity."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """J5 / Q7 foreign key: child rows whose key has no parent (left anti join)."""
    p = parent.select(F.col(parent_key).alias("__pk")).distinct()
    return child.join(p, child[child_key] == p["__pk"], "left_anti")


def split_quarantine(df: DataFrame, rule: Column, reason: str = "rule") -> tuple[DataFrame, DataFrame]:
    """rows passing ``rule`` and the rejected rest (with a reason), one scan each;
    NULL rule results count as failures. Persist ``df`` first if it is expensive."""
    ok = F.coalesce(rule, F.lit(False))
    return df.where(ok), df.where(~ok).withColumn("quarantine_reason", F.lit(reason))


def constraint_report(df: DataFrame, keys: list[str], parent: DataFrame, child_key: str, parent_key: str,
                      not_null: list[str] = (), len2: list[str] = (),
                      unit_interval: list[str] = ()) -> DataFrame:
    """Q7 as (check, violations) rows: column rules, duplicate primary keys and
    orphaned foreign keys; each check is its own aggregation, unioned."""
    rows = check_constraints(df, not_null, len2, unit_interval)
    cols = [c for c in rows.columns if c != "rows"]
    col_checks = rows.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("check"), F.col(c).cast("bigint").alias("violations")) for c in cols])))
    dup = duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit("dup_keys").alias("check"), "violations")
    orph = orphans(df, parent, child_key, parent_key).agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit("orphans").alias("check"), "violations")
    return col_checks.unionByName(dup).unionByName(orph)
