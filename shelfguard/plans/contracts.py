"""Contract checks on a table, as rows (table_name, check_name, failures, passed).

Every column of the contract is checked for presence and type from the schema
alone; required columns, quality checks and the primary key are counted in one
aggregation pass plus one group-by. A column that is absent fails its column
check, and every row fails what is required of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from shelfguard.contracts import Contract

# Contract types that other run-time types satisfy too (money is carried as double).
_WIDER = {
    "int": {"bigint"},
    "timestamp": {"timestamp_ntz"},
    "array<int>": {"array<bigint>"},
}


def _accepts(contract_type: str, actual: str) -> bool:
    if contract_type.startswith("decimal") and actual == "double":
        return True
    return actual == contract_type or actual in _WIDER.get(contract_type, ())


def _resolves(df: DataFrame, expression: str) -> bool:
    try:
        df.select(F.expr(expression)).schema  # analysis only, no job
        return True
    except AnalysisException:
        return False


def schema_report(df: DataFrame, contract: Contract) -> list[tuple[str, int]]:
    """(column check, 0 or 1 failures) of every column, from the schema only."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in contract.schema.fields}
    return [(f"column:{c}:{t}", int(not (c in actual and _accepts(t, actual[c])))) for c, t in wanted.items()]


def contract_report(df: DataFrame, contract: Contract) -> DataFrame:
    every, none = F.count("*"), F.lit(0)
    metrics = [(name, every * 0 + failures) for name, failures in schema_report(df, contract)]
    for name in contract.required:
        failing = F.count_if(F.col(name).isNull()) if name in df.columns else every
        metrics.append((f"required:{name}", failing))
    for i, check in enumerate(contract.checks, start=1):
        # A check that names an absent column fails on every row.
        failing = F.count_if(~F.coalesce(F.expr(check), F.lit(False))) if _resolves(df, check) else every
        metrics.append((f"check_{i}:{check}", failing))
    wide = df.agg(*[failing.cast("long").alias(f"m{i}") for i, (_, failing) in enumerate(metrics)])
    names = F.create_map(*[F.lit(x) for i, (label, _) in enumerate(metrics) for x in (f"m{i}", label)])
    data = wide.unpivot([], wide.columns, "_m", "failures").select(names[F.col("_m")].alias("check_name"), "failures")
    key = [c for c in contract.primary_key if c in df.columns]
    surplus = F.coalesce(F.sum(F.col("_n") - 1), none).cast("long")
    per_key = df.groupBy(*key).agg(F.count("*").alias("_n"))
    dupes = per_key.agg((surplus if len(key) == len(contract.primary_key) else F.coalesce(F.sum("_n"), none)).cast("long").alias("failures"))
    label = F.lit("primary_key:" + ",".join(contract.primary_key)).alias("check_name")
    out = data.unionByName(dupes.select(label, "failures"))
    return out.select(F.lit(contract.table).alias("table_name"), "check_name", "failures").withColumn("passed", F.col("failures") == 0)
