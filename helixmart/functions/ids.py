"""Identifier functions: accessions, CURIEs, IRIs, taxon and sample ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from helixmart.functions.text import blank_to_null, strip

# --- fixed values -----------------------------------------------------------------------
OBO = "http://purl.obolibrary.org/obo/"
EFO = "http://www.ebi.ac.uk/efo/"

# Prefixes that canonical_iri expands.
CURIE_BASES = {
    "CHEBI": OBO + "CHEBI_",
    "EFO": EFO + "EFO_",
    "NCBITaxon": OBO + "NCBITaxon_",
    "CL": OBO + "CL_",
    "UBERON": OBO + "UBERON_",
}

# Prefixes known to ontology_id.
ONTOLOGY_BASES = {
    "CL": OBO + "CL_",
    "EFO": EFO + "EFO_",
    "NCBITaxon": OBO + "NCBITaxon_",
    "UBERON": OBO + "UBERON_",
    "PATO": OBO + "PATO_",
    "CHEBI": OBO + "CHEBI_",
    "HANCESTRO": OBO + "HANCESTRO_",
    "MONDO": OBO + "MONDO_",
    "HsapDv": OBO + "HsapDv_",
}

ENSEMBL_LINK = "http://identifiers.org/ensembl/"
SAMPLE_ID = r"\ASAMP[A-Z0-9]{8}\z"
GEO_SERIES = r"(?U)\AGSE\d+\z"
ENSEMBL_VERSIONED = r"(?U)\A([A-Za-z]{2,4}\d{6,})(?:\.\d+)?\z"
SPECIES_BY_GENE_PREFIX = {r"\AENSG\d": 9606, r"\AENSMUSG\d": 10090}
STIMULUS_IRI = r"\A(?:CHEBI:.*|EFO:.*|NONE)\z"
# ----------------------------------------------------------------------------------------


def _cases(branches: list[tuple[Column, Column]], default: Column | None = None) -> Column:
    (cond, value), *rest = branches
    chain = reduce(lambda acc, b: acc.when(*b), rest, F.when(cond, value))
    return chain if default is None else chain.otherwise(default)


# -- versions --

def strip_version(c: Column) -> Column:
    """Everything before the first dot."""
    return F.substring_index(c, ".", 1)


def strip_version_suffix(c: Column) -> Column:
    """Drop a trailing ``.digits``; other dots stay."""
    return F.regexp_replace(c, r"(?U)\.\d+(?=\n?\z)", "")


def strip_ensembl_version(c: Column) -> Column:
    """Trimmed text without the version if it is an Ensembl-style id; blank gives NULL."""
    text = blank_to_null(strip(c))
    return F.when(
        text.rlike(ENSEMBL_VERSIONED), F.regexp_extract(text, ENSEMBL_VERSIONED, 1)
    ).otherwise(text)


def clean_gene_name(c: Column) -> Column:
    return strip(F.substring_index(c, ".", 1))


# -- IRIs and CURIEs --

def canonical_iri(c: Column) -> Column:
    """Expand ``PFX:local`` or ``PFX_local`` for known prefixes; any other text is unchanged."""
    branches = [
        (
            c.startswith(f"{prefix}:") | c.startswith(f"{prefix}_"),
            F.concat(F.lit(base), F.substr(c, F.lit(len(prefix) + 2))),
        )
        for prefix, base in CURIE_BASES.items()
    ]
    return _cases(branches, c)


def ensembl_link(c: Column) -> Column:
    return F.concat(F.lit(ENSEMBL_LINK), strip_version_suffix(c))


_PREFIXES = "|".join(ONTOLOGY_BASES)
_OBO_PREFIXES = "|".join(p for p, base in ONTOLOGY_BASES.items() if base.startswith(OBO))
_IRI_FORM = rf"\A(?:{OBO.replace('.', '[.]')}(?={_OBO_PREFIXES})|{EFO.replace('.', '[.]')}(?=EFO))({_PREFIXES})_"


def _as_curie(c: Column) -> Column:
    # IRIs of known ontologies become CURIEs; everything else stays as it is.
    return F.regexp_replace(c, _IRI_FORM, "$1:")


def _is_known(curie: Column) -> Column:
    return curie.rlike(rf"\A(?:{_PREFIXES}):")


def _curie_to_iri(curie: Column) -> Column:
    obo = F.regexp_replace(curie, rf"\A({_OBO_PREFIXES}):", f"{OBO}$1_")
    return F.regexp_replace(obo, r"\AEFO:", f"{EFO}EFO_")


def ontology_id(c: Column) -> Column:
    """``struct(iri, curie, prefix)`` for a known CURIE or IRI, else NULL."""
    curie = _as_curie(c)
    return F.when(
        _is_known(curie),
        F.struct(
            _curie_to_iri(curie).alias("iri"),
            curie.alias("curie"),
            F.substring_index(curie, ":", 1).alias("prefix"),
        ),
    )


def ontology_iri(c: Column) -> Column:
    curie = _as_curie(c)
    return F.when(_is_known(curie), _curie_to_iri(curie))


def ontology_prefix(c: Column) -> Column:
    curie = _as_curie(c)
    return F.when(_is_known(curie), F.substring_index(curie, ":", 1))


def ontology_curie(c: Column) -> Column:
    curie = _as_curie(c)
    return F.when(_is_known(curie), curie)


# The two directions of the CURIE <-> IRI round trip.
curie_to_iri = ontology_iri
iri_to_curie = ontology_curie


def local_link(c: Column) -> Column:
    return F.concat(F.lit("/samples/"), c)


def last_segment(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def chebi_number(c: Column) -> Column:
    """Digits of a ChEBI id in CURIE, underscore or full-IRI form, else NULL."""
    return blank_to_null(F.regexp_extract(c, r"CHEBI[:_](\d+)", 1))


def taxon_number(c: Column) -> Column:
    """Integer after the last colon; NULL when it is none."""
    return F.substring_index(c, ":", -1).try_cast("int")


# -- studies and samples --

def study_accession(c: Column) -> Column:
    return F.upper(strip(c))


def is_sample_id(c: Column) -> Column:
    return c.rlike(SAMPLE_ID)


def sample_id(c: Column) -> Column:
    return F.when(is_sample_id(c), c)


def is_geo_series(c: Column) -> Column:
    return c.rlike(GEO_SERIES)


def geo_archive_prefix(c: Column) -> Column:
    """``GSE123553`` -> ``GSE123nnn``; NULL for anything that is not a GEO series."""
    number = F.substr(c, F.lit(4)).try_cast("bigint")
    thousands = F.call_function("div", number, F.lit(1000).cast("bigint")).cast("string")
    return F.when(is_geo_series(c), F.concat(F.lit("GSE"), thousands, F.lit("nnn")))


# -- genes and stimuli --

def species_of_gene(c: Column) -> Column:
    return _cases([(c.rlike(p), F.lit(taxon)) for p, taxon in SPECIES_BY_GENE_PREFIX.items()])


def split_feature_name(c: Column) -> Column:
    """``SYMBOL_ENSG...`` -> ``struct(symbol, accession)``; NULL when it has another form."""
    pattern = r"\A(.+)_(ENS[A-Z]*G\d+(?:\.\d+)?)\z"
    return F.when(
        c.rlike(pattern),
        F.struct(
            F.regexp_extract(c, pattern, 1).alias("symbol"),
            F.regexp_extract(c, pattern, 2).alias("accession"),
        ),
    )


def is_stimulus_iri(c: Column) -> Column:
    """Stimuli must carry a CHEBI: or EFO: id, or the word NONE."""
    return c.rlike("(?s)" + STIMULUS_IRI)
