"""Value-driven rules: regex + transform chain + target columns, compiled to columns.

A rule looks at every text cell of a row. The cells are taken in column order and the rules in
their listed order; a later match overwrites an earlier one, and matching always sees the
original cells. Since one rule always writes the same columns, only its last matching cell
counts. So each rule becomes one position column (which cell matched last) and one value
column (the chain run once on that cell), and each target column picks the writer with the
highest (cell, rule) position. Nothing is shuffled unless a chain contains a lookup.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from helixmart.functions.registry import CURRENT, NOOP, Lookup, Registry, Transform
from helixmart.operators.enrich import ENRICHMENTS

REJECTED = "_rejected"
# Lookups whose key is a number.
NUMERIC_KEYS = {"microbe", "taxon"}


@dataclass(frozen=True)
class Rule:
    name: str
    table: str
    targets: tuple[str, ...]
    chain: tuple
    regex: str | None = None

    @property
    def inert(self) -> bool:
        return any(step is NOOP for step in self.chain)


def load_rules(mapping: dict | str | Path, registry: Registry = CURRENT) -> dict[str, list[Rule]]:
    """``{table: [Rule, ...]}`` from a mapping (or the YAML file that holds it)."""
    if not isinstance(mapping, dict):
        import yaml

        mapping = yaml.safe_load(Path(mapping).read_text(encoding="utf8"))
    tables: dict[str, list[Rule]] = {}
    for name, spec in mapping["columns"].items():
        targets = spec.get("target_columns") or [spec["target_column"]]
        chain = registry.resolve(spec.get("transforms") or [])
        rule = Rule(name, spec["target_table"], tuple(targets), tuple(chain), spec.get("regex"))
        tables.setdefault(rule.table, []).append(rule)
    return tables


def full_match(c: Column, regex: str | None) -> Column:
    """True when the whole text matches; NULL cells never do."""
    if regex is None:
        return c.isNotNull()
    return c.rlike(rf"(?U)\A(?:{regex})\z")


def _first_true(branches: list[tuple[Column, Column]]) -> Column:
    (cond, value), *rest = branches
    return reduce(lambda acc, b: acc.when(*b), rest, F.when(cond, value))


def _matched(position: Column, cells: list[str]) -> Column:
    return _first_true([(position == i, F.col(c)) for i, c in enumerate(cells)])


def harmonize(
    df: DataFrame,
    table: str,
    rules: dict[str, list[Rule]],
    references: dict | None = None,
    on_error: str = "fail",
    as_of: str | None = None,
    salts: int = 0,
) -> DataFrame:
    """Apply the rules of ``table`` to ``df``; without rules the rows pass unchanged.

    ``on_error="fail"`` raises on the first value a transform cannot take;
    ``"quarantine"`` keeps the row and lists the rules that failed in ``_rejected``.
    """
    if on_error not in ("fail", "quarantine"):
        raise ValueError(f"on_error must be 'fail' or 'quarantine', not {on_error!r}")
    active = [r for r in rules.get(table, []) if not r.inert]
    if not active:
        return df.withColumn(REJECTED, F.array().cast("array<string>")) if on_error == "quarantine" else df
    columns = df.columns
    cells = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    if not cells:
        return df.withColumn(REJECTED, F.array().cast("array<string>")) if on_error == "quarantine" else df

    last_first = list(reversed(list(enumerate(cells))))
    out = df.select(
        "*",
        *[
            _first_true([(full_match(F.col(c), r.regex), F.lit(i)) for i, c in last_first]).alias(f"_p{k}")
            for k, r in enumerate(active)
        ],
    )
    out = out.select("*", *[_matched(F.col(f"_p{k}"), cells).alias(f"_v{k}") for k in range(len(active))])
    out = _run_chains(out, active, references or {}, on_error, as_of, salts)

    kinds = {f.name: f.dataType for f in out.schema}
    writers: dict[str, list[tuple[int, Column, object]]] = {}
    for k, rule in enumerate(active):
        kind = kinds[f"_v{k}"]
        if isinstance(kind, StructType):
            for field in kind:
                writers.setdefault(field.name, []).append((k, F.col(f"_v{k}").getField(field.name), field.dataType))
        elif len(rule.targets) == 1:
            writers.setdefault(rule.targets[0], []).append((k, F.col(f"_v{k}"), kind))
        else:
            raise ValueError(f"rule '{rule.name}' yields one value for {len(rule.targets)} target columns")

    final = []
    for name in [*columns, *[w for w in writers if w not in columns]]:
        if name not in writers:
            final.append(F.col(name))
            continue
        final.append(_winner(name, writers[name], kinds.get(name) if name in columns else None, len(active)))
    if on_error == "quarantine":
        failed = [F.when(F.col(f"_bad{k}"), F.lit(r.name)) for k, r in enumerate(active)]
        final.append(F.array_compact(F.array(*failed)).alias(REJECTED))
    return out.select(*final)


def _run_chains(df, active, references, on_error, as_of, salts) -> DataFrame:
    """Run all chains side by side, step by step; only lookups need joins of their own."""
    if on_error == "quarantine":
        df = df.select("*", *[F.lit(False).alias(f"_bad{k}") for k in range(len(active))])
    for i in range(max(len(r.chain) for r in active)):
        changed: dict[str, Column] = {}
        for k, rule in enumerate(active):
            if i < len(rule.chain) and isinstance(rule.chain[i], Transform):
                changed.update(_step(k, rule, rule.chain[i], on_error))
        if changed:
            df = df.withColumns(changed)
        for k, rule in enumerate(active):
            if i < len(rule.chain) and isinstance(rule.chain[i], Lookup):
                kind = rule.chain[i].kind
                if kind in NUMERIC_KEYS:
                    df = df.withColumns(_step(k, rule, Transform(lambda c: c, _whole_number), on_error))
                df = ENRICHMENTS[kind](
                    df.withColumnRenamed(f"_v{k}", "_key"), "_key", f"_v{k}", references.get(kind, {}),
                    as_of=as_of, salts=salts,
                ).drop("_key")
    return df


def _whole_number(c: Column) -> Column:
    """NULL is left to the lookup, which gives no row for it."""
    return c.isNull() | c.try_cast("int").isNotNull()


def _step(k: int, rule: Rule, step: Transform, on_error: str) -> dict[str, Column]:
    value = F.col(f"_v{k}")
    result = step.apply(value)
    if step.valid is None:
        return {f"_v{k}": result}
    fails = F.col(f"_p{k}").isNotNull() & ~F.coalesce(step.valid(value), F.lit(False))
    if on_error == "quarantine":
        return {f"_v{k}": result, f"_bad{k}": F.col(f"_bad{k}") | fails}
    text = F.coalesce(value.cast("string"), F.lit("NULL"))
    message = F.concat(F.lit(f"rule '{rule.name}': malformed value "), text)
    return {f"_v{k}": F.when(fails, F.raise_error(message)).otherwise(result)}


def _winner(name: str, candidates: list, original, n_rules: int) -> Column:
    kinds = {str(d) for _, _, d in candidates} | ({str(original)} if original is not None else set())
    as_text = len(kinds) > 1

    def typed(c: Column) -> Column:
        return c.cast("string") if as_text else c

    fallback = typed(F.col(name)) if original is not None else None
    ranks = [F.col(f"_p{k}") * n_rules + k for k, _, _ in candidates]
    if len(candidates) == 1:
        k, value, _ = candidates[0]
        chosen = F.when(F.col(f"_p{k}").isNotNull(), typed(value))
    else:
        top = F.greatest(*ranks)
        chosen = _first_true([(rank == top, typed(value)) for rank, (_, value, _) in zip(ranks, candidates)])
    return (chosen if fallback is None else chosen.otherwise(fallback)).alias(name)


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows, rejected rows) of a frame harmonised with ``on_error="quarantine"``."""
    bad = F.size(REJECTED) > 0
    return df.filter(~bad).drop(REJECTED), df.filter(bad)


def entity_kind(c: Column, kinds: dict[str, str], default: str | None = None) -> Column:
    """Name of the first kind whose regex matches the whole text."""
    chain = _first_true([(full_match(c, regex), F.lit(kind)) for kind, regex in kinds.items()])
    return chain.otherwise(F.lit(default))
