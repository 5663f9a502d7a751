"""Data quality rules compiled to column expressions (DQ-01..09).

A rule set becomes one array column of violated rule names per row; a row is
valid when the array is empty, and the first element is the rule that
rejects it (the reference stops at the first broken rule).  No Python runs
per row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, FloatType, IntegralType, StringType, VariantType

# Fixed domains (DQ-05) and limits (DQ-06/07).
TASK_STATUS = ["pending", "in_progress", "completed", "cancelled"]
TASK_PRIORITY = ["low", "medium", "high", "urgent"]
VERIFICATION_STATUS = ["pending", "verified", "rejected"]
EVENT_NAMES = ["INSERT", "MODIFY", "REMOVE"]
ENTITY_TYPES = ["USER", "TASK", "IDEMPOTENCY"]
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"


@dataclass
class Rules:
    """The rule-set model: required fields, expected types, constraints.

    ``constraints`` maps a field to any of ``min``, ``max`` (inclusive),
    ``pattern`` (regex matched at the start of the text form), ``in`` (a
    domain), ``min_len`` / ``max_len`` (character length).  ``checks`` are
    extra named SQL boolean expressions that must hold.
    """
    required_fields: list[str] = field(default_factory=list)
    data_types: dict[str, str] = field(default_factory=dict)
    constraints: dict[str, dict] = field(default_factory=dict)
    checks: dict[str, str] = field(default_factory=dict)


def _type_ok(df: DataFrame, name: str, expected: str) -> Column:
    """DQ-02 over typed columns: the column's own type decides.

    int passes float; a bool passes int and float (a bool is an int subtype
    in the source language); a present null fails.  Text is a string and
    nothing else, whatever it reads.
    """
    c = F.col(name)
    dt = df.schema[name].dataType
    if isinstance(dt, VariantType):
        # JSON-typed values: the value's own type decides (a JSON null fails)
        t = F.schema_of_variant(c)
        is_int = t.isin("BIGINT", "INT", "SMALLINT", "TINYINT") | t.startswith("DECIMAL(") & t.endswith(",0)")
        is_num = is_int | t.isin("DOUBLE", "FLOAT") | t.startswith("DECIMAL(")
        ok = {"string": t == "STRING", "int": is_int | (t == "BOOLEAN"),
              "float": is_num | (t == "BOOLEAN"), "bool": t == "BOOLEAN"}
        # absent field (SQL null): rule skipped; present JSON null: fails
        return F.when(c.isNull(), F.lit(True)).otherwise(
            F.coalesce(ok.get(expected, F.lit(False)), F.lit(False)) & (t != "VOID"))
    if isinstance(dt, StringType):
        return c.isNotNull() & F.lit(expected == "string")
    is_bool = isinstance(dt, BooleanType)
    is_int = isinstance(dt, IntegralType)
    is_float = isinstance(dt, (DoubleType, FloatType))
    ok = {"string": False, "int": is_int or is_bool, "float": is_int or is_float or is_bool, "bool": is_bool}
    return c.isNotNull() & F.lit(ok.get(expected, False))


def violations(df: DataFrame, rules: Rules) -> Column:
    """array<string> of violated rules, in evaluation order (DQ-01..07)."""
    arms: list[Column] = []
    for f in rules.required_fields:
        if f in df.columns:
            missing = F.col(f).isNull()
            if isinstance(df.schema[f].dataType, VariantType):
                missing = missing | F.is_variant_null(F.col(f))
            arms.append(F.when(missing, F.lit(f"required:{f}")))
        else:
            arms.append(F.lit(f"required:{f}"))
    for f, t in rules.data_types.items():
        if f in df.columns:
            arms.append(F.when(~_type_ok(df, f, t), F.lit(f"type:{f}")))
    for f, con in rules.constraints.items():
        if f not in df.columns:
            continue
        c = F.col(f)
        is_variant = isinstance(df.schema[f].dataType, VariantType)
        # a bound against text or null can't be compared, and what can't be
        # evaluated rejects; only a field absent from a record skips its rules
        if is_variant:
            is_text = F.schema_of_variant(c) == "STRING"
            num = F.when(~is_text, F.try_variant_get(c, "$", "double"))
            absent = c.isNull()
        else:
            num = F.lit(None).cast("double") if isinstance(df.schema[f].dataType, StringType) else c.try_cast("double")
            absent = F.lit(False)
        text = F.try_variant_get(c, "$", "string") if is_variant else c.cast("string")
        if con.get("min") is not None:
            arms.append(F.when(~absent & ~F.coalesce(num >= F.lit(float(con["min"])), F.lit(False)), F.lit(f"min:{f}")))
        if con.get("max") is not None:
            arms.append(F.when(~absent & ~F.coalesce(num <= F.lit(float(con["max"])), F.lit(False)), F.lit(f"max:{f}")))
        if con.get("pattern") is not None:
            # a null's text form is what is matched
            arms.append(F.when(~absent & ~F.coalesce(text, F.lit("None")).rlike("^(?:" + con["pattern"] + ")"),
                               F.lit(f"pattern:{f}")))
        if con.get("in") is not None:
            arms.append(F.when(c.isNotNull() & ~c.isin(*con["in"]), F.lit(f"domain:{f}")))
        if con.get("min_len") is not None:
            arms.append(F.when(c.isNotNull() & (F.char_length(c) < con["min_len"]), F.lit(f"min_len:{f}")))
        if con.get("max_len") is not None:
            arms.append(F.when(c.isNotNull() & (F.char_length(c) > con["max_len"]), F.lit(f"max_len:{f}")))
    for name, sql in rules.checks.items():
        arms.append(F.when(~F.coalesce(F.expr(sql), F.lit(False)), F.lit(f"check:{name}")))
    if not arms:
        return F.array().cast("array<string>")
    # concat_ws skips nulls and keeps codegen; split back into an array
    joined = F.concat_ws("\u0001", *arms)
    return F.when(joined == "", F.array().cast("array<string>")).otherwise(F.split(joined, "\u0001"))


def record_fields(records: DataFrame, record_col: str, rules: Rules) -> DataFrame:
    """Project the fields a rule set names out of a JSON record (variant)
    column, as variant columns; a field absent from a record is null, so
    "required" fails and the type/constraint rules skip it, as for dicts."""
    names = list(dict.fromkeys(rules.required_fields + list(rules.data_types) + list(rules.constraints)))
    cols = [F.try_variant_get(F.col(record_col), f"$['{n}']", "variant").alias(n) for n in names]
    return records.select("*", *cols)


def validate(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """DQ-08: (valid rows, rejected rows with ``violations`` and ``rule``)."""
    v = df.withColumn("violations", violations(df, rules))
    good = v.filter(F.size("violations") == 0).drop("violations")
    bad = v.filter(F.size("violations") > 0).withColumn("rule", F.col("violations").getItem(0))
    return good, bad


def rule_summary(df: DataFrame, rules: Rules) -> DataFrame:
    """DQ-09: (rule, failures) of every rule, those that never fail included, in one pass.

    Two more rows hold totals: ``rows`` and ``rejected_rows``.
    """
    names = rule_names(rules)
    v = df.select(violations(df, rules).alias("v"))
    counts = v.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.size("v") > 0).alias("rejected_rows"),
                   *[F.count_if(F.array_contains("v", n)).alias(n) for n in names])
    return counts.unpivot([], ["rows", "rejected_rows", *[f"`{n}`" for n in names]], "rule", "failures")


def rule_names(rules: Rules) -> list[str]:
    """The names that ``violations`` gives, in its order."""
    kinds = {"min": "min", "max": "max", "pattern": "pattern", "in": "domain", "min_len": "min_len", "max_len": "max_len"}
    return ([f"required:{f}" for f in rules.required_fields] + [f"type:{f}" for f in rules.data_types]
            + [f"{name}:{f}" for f, con in rules.constraints.items() for kind, name in kinds.items() if con.get(kind) is not None]
            + [f"check:{n}" for n in rules.checks])


def completeness(df: DataFrame, cols: list[str]) -> DataFrame:
    """DQ-09: share of non-null values per column, one aggregate."""
    aggs = [F.round(F.count(F.col(c)) / F.count(F.lit(1)), 6).alias(c) for c in cols]
    return df.agg(*aggs).unpivot([], cols, "column", "completeness")


def freshness(df: DataFrame, ts_col: str, now: Column) -> DataFrame:
    """DQ-09: newest record time and its age in seconds."""
    return df.agg(F.max(ts_col).alias("newest")).select(
        "newest", (F.unix_seconds(now.cast("timestamp")) - F.unix_seconds("newest")).alias("age_seconds"))


# Rule sets of the model (DQ-05..07).
TASK_RULES = Rules(
    required_fields=["task_id", "user_id", "title", "status"],
    data_types={"title": "string", "created_at": "int"},
    constraints={
        "title": {"min_len": 1, "max_len": 200},
        "description": {"max_len": 1000},
        "category": {"max_len": 50},
        "status": {"in": TASK_STATUS},
        "priority": {"in": TASK_PRIORITY},
    },
)
USER_RULES = Rules(
    required_fields=["user_id", "email", "name"],
    constraints={"name": {"min_len": 1, "max_len": 100}, "email": {"pattern": EMAIL_PATTERN}},
)
IDEMPOTENCY_RULES = Rules(
    required_fields=["request_id", "response_data", "http_status_code", "expiration_timestamp"],
    constraints={"request_id": {"min_len": 1, "max_len": 255},
                 "http_status_code": {"min": 100, "max": 599}},
)
ENVELOPE_RULES = Rules(
    required_fields=["event_name", "sequence_number"],
    constraints={"event_name": {"in": EVENT_NAMES}, "sequence_number": {"pattern": r"[0-9]+$"}},
)
