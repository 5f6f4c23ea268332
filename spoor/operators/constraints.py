"""Constraints as queries: each rule counts its violations, and a build stops on any."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ConstraintError(ValueError):
    """A rule has violations."""


def violations(rule: str, rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("violations")).select(F.lit(rule).alias("rule"), "violations")


def broken(rows: DataFrame, holds: Column) -> DataFrame:
    """Rows for which a condition isn't true, null included."""
    return rows.where(~F.coalesce(holds, F.lit(False)))


def orphans(rows: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose key isn't null and has no parent."""
    return rows.where(F.col(key).isNotNull()).join(parents.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")


def repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that more than one row has."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def target_iff_internal(edges: DataFrame, target: str = "target", scope: str = "scope") -> DataFrame:
    """Edges that have a target and don't lie within, or lie within and have none."""
    return edges.where(F.col(target).isNotNull() != F.coalesce(F.col(scope) == "internal", F.lit(False)))


def not_exactly_one(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows of which none or several of the columns are set."""
    return rows.where(reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in columns]) != 1)


def check_edges(edges: DataFrame, proofs: DataFrame, fks: list[tuple[str, DataFrame, str]], key: list[str], least: int = 60) -> DataFrame:
    """(rule, violations): a derived edge has a proof, a proof has ``least`` characters, keys exist, and edges are distinct."""
    rules = [
        violations("proof_required", broken(edges, (F.col("method") == "declared") | F.col("proof_id").isNotNull())),
        violations("proof_length", broken(proofs, F.length("window") >= least)),
        violations("proof_exists", orphans(edges, "proof_id", proofs, "proof_id")),
        violations("unique", repeated(edges, key)),
        *[violations(f"fk_{name}", orphans(edges, name, parents, parent_key)) for name, parents, parent_key in fks],
    ]
    return reduce(DataFrame.unionByName, rules)


def require_none(report: DataFrame) -> None:
    """Raise if any rule is broken."""
    bad = report.where("violations > 0").collect()  # one row a rule
    if bad:
        raise ConstraintError(", ".join(f"{r['rule']}: {r['violations']}" for r in bad))
