"""Named transforms that rules refer to.

A registry maps a name to a :class:`Transform` (a column function), a :class:`Lookup` (an
enrichment join, see :mod:`helixmart.operators.enrich`) or :data:`NOOP`. Users add their own
entries with :meth:`Registry.extended`; a pandas UDF or SQL UDF is a fine ``apply``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column

from helixmart.functions import ids, records, text, values


@dataclass(frozen=True)
class Transform:
    """``apply`` gives NULL for bad input; ``valid`` tells bad input apart from a NULL result."""

    apply: Callable[[Column], Column]
    valid: Callable[[Column], Column] | None = None


@dataclass(frozen=True)
class Lookup:
    """Join with reference tables; ``kind`` names the enrichment."""

    kind: str


class _Noop:
    """A transform whose result has no fields: the rule then writes nothing."""


NOOP = _Noop()


class Registry:
    def __init__(self, entries: dict, strict: bool = True):
        self._entries = {
            name: Transform(e) if callable(e) and not isinstance(e, (Transform, Lookup)) else e
            for name, e in entries.items()
        }
        self.strict = strict

    def resolve(self, names: list[str]) -> list:
        """Entries for a chain. Unknown names fail here, at plan time, or are skipped if lenient."""
        found = []
        for name in names:
            if name in self._entries:
                found.append(self._entries[name])
            elif self.strict:
                raise KeyError(f"no transform is registered as {name!r}")
        return found

    def extended(self, **more) -> "Registry":
        return Registry({**self._entries, **more}, self.strict)

    def __contains__(self, name: str) -> bool:
        return name in self._entries


def _parses_as_int(c: Column) -> Column:
    return ids.taxon_number(c).isNotNull()


_TAXON = Transform(ids.taxon_number, _parses_as_int)

CURRENT = Registry(
    {
        "strip_version": ids.strip_version,
        "canonical_iri": ids.canonical_iri,
        "normalize_study_accession": ids.study_accession,
        "extract_sample_id": Transform(ids.sample_id, ids.is_sample_id),
        "fetch_from_ncbi_taxon": _TAXON,
        "fetch_taxon_numeric_id": _TAXON,
        "parse_sample_microbe_record": Transform(records.sample_microbe, records.sample_microbe_valid),
        "parse_sample_stimulus_record": Transform(records.sample_stimulus, records.sample_stimulus_valid),
        "parse_microbe_stimulus_record": Transform(records.microbe_stimulus, records.microbe_stimulus_valid),
        "parse_expression_stat_record": Transform(records.expression_stat, records.expression_stat_valid),
        "fetch_gene_metadata": Lookup("gene"),
        "fetch_stimulus_metadata": Lookup("stimulus"),
        "fetch_microbe_metadata": Lookup("microbe"),
        "fetch_taxon_metadata": Lookup("taxon"),
        "fetch_ontology_term_metadata": Lookup("ontology_term"),
        "fetch_study_metadata": Lookup("study"),
        "fetch_sample_metadata": Lookup("sample"),
        **{
            f"stub_fetch_{kind}_metadata": NOOP
            for kind in ("gene", "stimulus", "microbe", "taxon", "ontology_term", "study", "sample")
        },
    }
)

# First-generation names: some mean something else, and unknown names are skipped.
LEGACY = Registry(
    {
        "strip_version": ids.strip_version_suffix,
        "canonical_iri": ids.ensembl_link,
        "get_local_link": ids.local_link,
        "get_iri": ids.ontology_iri,
        "get_ontology": ids.ontology_prefix,
        "get_name": Lookup("term_name"),
        "get_chem_class": Lookup("chemical_class"),
        "get_ranking": Lookup("taxon_rank"),
        "lowercase_ascii": text.lowercase_ascii,
        "ascii_slug": text.ascii_slug,
        "tidy_punct": text.tidy_punct,
        "split_commas": values.split_commas,
        "strip_ensembl_version": ids.strip_ensembl_version,
    },
    strict=False,
)


