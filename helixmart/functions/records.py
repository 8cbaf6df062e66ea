"""Comma-joined link and statistics records -> structs with the target tables' column names.

Each parser has a ``*_valid`` twin. The parser never fails: it gives NULL for a record of
another shape and NULL for a number that does not parse; the twin says whether it would.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from helixmart.functions.ids import canonical_iri, strip_version, taxon_number


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once; nested splits would otherwise run for every field."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


class _Fields:
    """Typed access to the parts of a split record."""

    def __init__(self, parts: Column):
        self.parts = parts
        self.size = F.size(parts)

    def text(self, i: int) -> Column:
        return F.get(self.parts, F.lit(i))

    def number(self, i: int, kind: str = "double") -> Column:
        return self.text(i).try_cast(kind)

    def taxon(self, i: int) -> Column:
        return taxon_number(self.text(i))


def _parser(parts: Callable[[Column], Column], fits: Callable, columns: Callable, numbers: Callable):
    """(parse, valid) pair: ``columns`` of a record that ``fits``; valid if all ``numbers`` parse too."""

    def parse(c: Column) -> Column:
        def record(p: Column) -> Column:
            f = _Fields(p)
            return F.when(fits(f), F.struct(*[v.alias(k) for k, v in columns(f).items()]))

        return _let(parts(c), record)

    def valid(c: Column) -> Column:
        def check(p: Column) -> Column:
            f = _Fields(p)
            ok = fits(f)
            for n in numbers(f):
                ok = ok & n.isNotNull()
            return ok

        return F.coalesce(_let(parts(c), check), F.lit(False))

    return parse, valid


def _cells(c: Column) -> Column:
    return F.split(c, ",", -1)


# tag,sample,taxon,abundance,evidence
sample_microbe, sample_microbe_valid = _parser(
    _cells,
    lambda f: f.size == 5,
    lambda f: {
        "sample_id": f.text(1), "microbe_id": f.taxon(2), "evidence": f.text(4), "relative_abundance": f.number(3),
    },
    lambda f: [f.taxon(2), f.number(3)],
)

# tag,sample,stimulus,hours,marker
sample_stimulus, sample_stimulus_valid = _parser(
    _cells,
    lambda f: f.size == 5,
    lambda f: {
        "sample_id": f.text(1), "stimulus_id": canonical_iri(f.text(2)), "exposure_time_hr": f.number(3),
        "response_marker": f.text(4),
    },
    lambda f: [f.number(3)],
)

# taxon,stimulus,score,evidence (no tag)
microbe_stimulus, microbe_stimulus_valid = _parser(
    _cells,
    lambda f: f.size == 4,
    lambda f: {
        "microbe_id": f.taxon(0), "stimulus_id": canonical_iri(f.text(1)), "evidence": f.text(3),
        "interaction_score": f.number(2),
    },
    lambda f: [f.taxon(0), f.number(2)],
)

# tag:sample,gene,log2fc,p,mean,count,significance[,more...]
expression_stat, expression_stat_valid = _parser(
    lambda c: _cells(F.get(F.split(c, ":", -1), F.lit(1))),
    lambda f: f.size >= 7,
    lambda f: {
        "sample_id": f.text(0), "gene_accession": strip_version(f.text(1)), "log2_fc": f.number(2),
        "p_value": f.number(3), "base_mean": f.number(4), "raw_count": f.number(5, "bigint"), "significance": f.text(6),
    },
    lambda f: [f.number(2), f.number(3), f.number(4), f.number(5, "bigint")],
)
