"""Query registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name, with its SQL twin if there is one."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Derivations both engines understand.
GENE_ID = "concat('ENSG', lpad(cast(p_partkey as string), 11, '0'), '.', cast(p_size as string))"
TERM_ID = (
    "concat(case p_size % 8 when 0 then 'CHEBI:' when 1 then 'EFO_' when 2 then 'NCBITaxon:' when 3 then 'CL_' "
    "when 4 then 'UBERON:' when 5 then 'PR_' when 6 then 'PATO:' else 'http://purl.obolibrary.org/obo/CL_' end, "
    "lpad(cast(p_partkey as string), 7, '0'))"
)
STUDY_ID = (
    "concat('  ', case c_nationkey % 3 when 0 then 'e-mtab-' when 1 then 'gse' else 'local-' end, "
    "cast(c_custkey as string), ' ')"
)
STIMULUS_ID = (
    "concat(case s_nationkey % 4 when 0 then 'CHEBI:' when 1 then 'CHEBI_' when 2 then 'EFO:' "
    "else 'http://purl.obolibrary.org/obo/CHEBI_' end, cast(s_suppkey as string))"
)
