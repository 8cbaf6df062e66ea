"""Metadata enrichment as left joins with local reference tables.

Every function takes ``(df, key, out, refs)`` and adds column ``out`` for the id in column
``key``. ``refs`` holds up to two sources, ``"a"`` before ``"b"``; an id in neither gets the
default row. Values that would be random placeholders are NULL here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixmart.functions import ids
from helixmart.functions.values import first_filled, gene_length
from helixmart.operators.joins import attach, attach_guarded

# --- fixed values -----------------------------------------------------------------------
DEFAULT_DOSE, DEFAULT_DOSE_UNIT = 1.0, "mM"
DEFAULT_KINGDOM, DEFAULT_RANK, DEFAULT_HABITAT = "Bacteria", "species", "intestine"
DEFAULT_ONTOLOGY_VERSION = "2025-06"
STUDY_TYPE = "scRNA-seq"
SAMPLE_DEFAULTS = {
    "study_iri": "LOCAL-STUDY",
    "cell_type_iri": "CL_0000127",
    "cell_type_label": "astrocyte",
    "tissue_iri": "UBERON_0000955",
    "tissue_label": "brain",
    "organism_iri": "NCBITaxon_9606",
    "organism_label": "Homo sapiens",
    "growth_condition": "monoculture",
    "stimulus_iri": "CHEBI:30772",
    "microbe_taxon_id": 818,
    "replicate_number": 1,
}
HUMAN_TAXON = "NCBITaxon_9606"
# What stands where no source knows better; not found, made up from the id.
TITLE_STUB, MAIL_STUB, COUNTS_STUB, COUNTS_END = "Synthetic study ", "@example.org", "s3://bucket/", ".zarr"

GENE_A = "gene_accession string, symbol string, name string, start bigint, end bigint, go_bp array<string>"
GENE_B = "gene_accession string, display_name string, start bigint, end bigint"
STIMULUS_A = "chebi_id string, ascii_name string, formula string, smiles string, mass double"
STIMULUS_B = "iri string, label string"
MICROBE_A = "taxon_id int, scientific_name string, strain string"
TAXON_A = "taxon_id int, division string, rank string"
TERM_A = (
    "iri string, label string, ontology_prefix string, description array<string>, "
    "synonyms array<string>, ontology_version string"
)
STUDY_A = "accession string, title string, publication_date string, samples int"
STUDY_B = "accession string, title string"
SAMPLE_A = (
    "sample_id string, study_iri string, cell_type_iri string, cell_type_label string, tissue_iri string, "
    "tissue_label string, organism_iri string, organism_label string, growth_condition string, "
    "stimulus_iri string, microbe_taxon_id int, raw_counts_uri string, collection_date string, "
    "donor_age_years int, replicate_number int, viability_pct double, rin_score double"
)
# ----------------------------------------------------------------------------------------


def _pack(**fields: Column) -> Column:
    return F.struct(*[v.alias(k) for k, v in fields.items()])


def _text(value: str | None = None) -> Column:
    return F.lit(value).cast("string")


def _empty_json() -> Column:
    return F.lit("[]")


def gene(df: DataFrame, key: str, out: str, refs: dict, as_of: str | None = None, salts: int = 0) -> DataFrame:
    df = df.withColumn("_id", ids.strip_version(F.col(key)))
    accession, a, b = F.col("_id"), F.col("_a"), F.col("_b")
    df = attach(df, accession, [(refs.get("a"), GENE_A, "_a"), (refs.get("b"), GENE_B, "_b")], salts)
    name = (
        F.when(a.isNotNull(), first_filled(a["symbol"], a["name"], accession))
        .when(b.isNotNull(), first_filled(b["display_name"], accession))
        .otherwise(F.concat(F.lit("Gene"), F.right(accession, F.lit(4))))
    )
    length = F.when(a.isNotNull(), gene_length(a["start"], a["end"])).otherwise(gene_length(b["start"], b["end"]))
    row = _pack(
        gene_accession=accession,
        gene_name=name,
        species_taxon_iri=F.lit(HUMAN_TAXON),
        gene_length_bp=length,
        gc_content=F.lit(None).cast("double"),
        pathway_iri=_empty_json(),
        go_terms=F.coalesce(F.to_json(a["go_bp"]), _empty_json()),
    )
    return df.withColumn(out, F.when(F.col(key).isNotNull(), row)).drop("_id", "_a", "_b")


def stimulus(df: DataFrame, key: str, out: str, refs: dict, as_of: str | None = None, salts: int = 0) -> DataFrame:
    df = df.withColumn("_id", ids.canonical_iri(F.col(key)))
    iri, a, b = F.col("_id"), F.col("_a"), F.col("_b")
    label = ids.last_segment(iri)
    df = attach(df, ids.chebi_number(iri), [(refs.get("a"), STIMULUS_A, "_a")], salts)
    df = attach(df, iri, [(refs.get("b"), STIMULUS_B, "_b")], salts)
    known = a["ascii_name"].isNotNull()
    row = _pack(
        iri=iri,
        label=F.coalesce(a["ascii_name"], b["label"], label),
        class_hint=F.lit(""),
        chem_formula=F.when(known, F.coalesce(a["formula"], F.lit(""))).otherwise(F.lit("")),
        smiles=F.when(known, F.coalesce(a["smiles"], F.lit(""))).otherwise(F.lit("")),
        molecular_weight=F.when(known, F.nullif(a["mass"], F.lit(0.0))),
        default_dose=F.lit(DEFAULT_DOSE),
        dose_unit=F.lit(DEFAULT_DOSE_UNIT),
    )
    return df.withColumn(out, F.when(F.col(key).isNotNull(), row)).drop("_id", "_a", "_b")


def microbe(df: DataFrame, key: str, out: str, refs: dict, as_of: str | None = None, salts: int = 0) -> DataFrame:
    taxon = F.col(key).try_cast("int")
    a = F.col("_a")
    df = attach(df, taxon, [(refs.get("a"), MICROBE_A, "_a")], salts)
    text = taxon.cast("string")
    row = _pack(
        taxon_id=taxon,
        taxon_iri=F.concat(F.lit("NCBITaxon_"), text),
        species_name=F.when(a.isNotNull(), a["scientific_name"]).otherwise(F.concat(F.lit("Species_"), text)),
        strain_name=F.coalesce(a["strain"], F.concat(F.lit("Strain_"), text)),
        genome_size_bp=F.lit(None).cast("bigint"),
        oxygen_requirement=_text(),
        abundance_index=F.lit(None).cast("double"),
        prevalence=F.lit(None).cast("int"),
    )
    return df.withColumn(out, F.when(taxon.isNotNull(), row)).drop("_a")


def taxon(df: DataFrame, key: str, out: str, refs: dict, as_of: str | None = None, salts: int = 0) -> DataFrame:
    number = F.col(key).try_cast("int")
    a = F.col("_a")
    df = attach(df, number, [(refs.get("a"), TAXON_A, "_a")], salts)
    row = _pack(
        iri=F.concat(F.lit("NCBITaxon_"), number.cast("string")),
        kingdom=F.coalesce(a["division"], F.lit(DEFAULT_KINGDOM)),
        ranking=F.coalesce(a["rank"], F.lit(DEFAULT_RANK)),
        gc_content=F.lit(None).cast("double"),
        genome_length=F.lit(None).cast("bigint"),
        habitat=F.lit(DEFAULT_HABITAT),
        pathogenicity=_text(),
    )
    return df.withColumn(out, F.when(number.isNotNull(), row)).drop("_a")


def ontology_term(df: DataFrame, key: str, out: str, refs: dict, as_of: str | None = None, salts: int = 0) -> DataFrame:
    iri = F.col(key)
    a = F.col("_a")
    df = attach(df, iri, [(refs.get("a"), TERM_A, "_a")], salts)
    found = a.isNotNull()
    row = _pack(
        iri=iri,
        label=F.when(found, a["label"]).otherwise(ids.last_segment(iri)),
        ontology=F.when(found, a["ontology_prefix"])
        .when(iri.contains("CL_"), F.lit("CL"))
        .otherwise(F.lit("UBERON")),
        term_definition=F.coalesce(F.get(a["description"], F.lit(0)), F.lit("")),
        synonyms=F.coalesce(F.to_json(a["synonyms"]), _empty_json()),
        onto_version=F.when(found, F.coalesce(a["ontology_version"], F.lit(""))).otherwise(
            F.lit(DEFAULT_ONTOLOGY_VERSION)
        ),
    )
    return df.withColumn(out, F.when(iri.isNotNull(), row)).drop("_a")


def study(df: DataFrame, key: str, out: str, refs: dict, as_of: str | None = None, salts: int = 0) -> DataFrame:
    df = df.withColumn("_id", ids.study_accession(F.col(key)))
    acc, a, b = F.col("_id"), F.col("_a"), F.col("_b")
    lookups = [("E-MTAB", "a", STUDY_A, "_a"), ("GSE", "b", STUDY_B, "_b")]
    df = attach_guarded(df, [(F.when(acc.startswith(p), acc), refs.get(r), schema, to) for p, r, schema, to in lookups], salts)
    in_a = a.isNotNull()
    in_b = first_filled(b["title"]).isNotNull()
    today = F.lit(as_of) if as_of else F.date_format(F.current_date(), "yyyy-MM-dd")

    def pick(from_a, from_b, default):
        return F.when(in_a, from_a).when(in_b, from_b).otherwise(default)

    row = _pack(
        iri=acc,
        title=pick(a["title"], b["title"], F.concat(F.lit(TITLE_STUB), acc)),
        source_repo=pick(F.lit("ArrayExpress"), F.lit("GEO"), F.lit("LOCAL")),
        publication_date=pick(
            F.substring(F.coalesce(a["publication_date"], F.lit("")), 1, 10), F.lit(""), today
        ),
        study_type=F.lit(STUDY_TYPE),
        num_samples=pick(F.coalesce(a["samples"], F.lit(0)), F.lit(0), F.lit(None).cast("int")),
        contact_email=pick(F.lit(""), F.lit(""), F.concat(F.lower(acc), F.lit(MAIL_STUB))),
    )
    return df.withColumn(out, F.when(F.col(key).isNotNull(), row)).drop("_id", "_a", "_b")


def sample(df: DataFrame, key: str, out: str, refs: dict, as_of: str | None = None, salts: int = 0) -> DataFrame:
    sid = F.col(key)
    a = F.col("_a")
    df = attach(df, sid, [(refs.get("a"), SAMPLE_A, "_a")], salts)
    today = F.lit(as_of) if as_of else F.date_format(F.current_date(), "yyyy-MM-dd")
    filled = {name: F.coalesce(a[name], F.lit(value)) for name, value in SAMPLE_DEFAULTS.items()}
    row = _pack(
        iri=sid,
        **filled,
        raw_counts_uri=F.coalesce(a["raw_counts_uri"], F.concat(F.lit(COUNTS_STUB), sid, F.lit(COUNTS_END))),
        collection_date=F.coalesce(a["collection_date"], today),
        donor_age_years=a["donor_age_years"],
        viability_pct=a["viability_pct"],
        rin_score=a["rin_score"],
    )
    return df.withColumn(out, F.when(sid.isNotNull(), row)).drop("_a")


# -- first-generation lookups: one text value each --

def term_name(df: DataFrame, key: str, out: str, refs: dict, as_of: str | None = None, salts: int = 0) -> DataFrame:
    """Label by CURIE from ``a``, then by IRI from ``b``; NULL for ids of unknown ontologies."""
    df = df.withColumn("_id", ids.ontology_id(F.col(key)))
    term = F.col("_id")
    df = attach(df, term["curie"], [(refs.get("a"), "curie string, label string", "_a")], salts)
    df = attach(df, term["iri"], [(refs.get("b"), "iri string, label string", "_b")], salts)
    return df.withColumn(out, first_filled(F.col("_a")["label"], F.col("_b")["label"])).drop("_id", "_a", "_b")


def chemical_class(df: DataFrame, key: str, out: str, refs: dict, as_of: str | None = None, salts: int = 0) -> DataFrame:
    """First class by CURIE from ``a``, else the compound name by number from ``b``."""
    curie = ids.ontology_id(F.col(key))["curie"]
    number = F.when(F.col(key).contains(":"), F.substr(F.col(key), F.instr(F.col(key), ":") + 1))
    df = attach(df, curie, [(refs.get("a"), "curie string, chebi_class array<string>", "_a")], salts)
    df = attach(df, number, [(refs.get("b"), "chebi_id string, ascii_name string", "_b")], salts)
    first_class = F.get(F.col("_a")["chebi_class"], F.lit(0))
    return df.withColumn(out, F.coalesce(first_class, F.trim(F.col("_b")["ascii_name"]))).drop("_a", "_b")


def taxon_rank(df: DataFrame, key: str, out: str, refs: dict, as_of: str | None = None, salts: int = 0) -> DataFrame:
    """Rank by CURIE from ``a``; taxa only: else by taxon number from ``b``."""
    df = df.withColumn("_id", ids.ontology_id(F.col(key)))
    term = F.col("_id")
    number = F.when(term["prefix"] == "NCBITaxon", F.substring_index(term["curie"], ":", -1))
    df = attach(df, term["curie"], [(refs.get("a"), "curie string, rank string", "_a")], salts)
    df = attach(df, number, [(refs.get("b"), "taxon_id string, rank string", "_b")], salts)
    return df.withColumn(out, F.coalesce(first_filled(F.col("_a")["rank"]), F.col("_b")["rank"])).drop("_id", "_a", "_b")


ENRICHMENTS = {
    f.__name__: f
    for f in (
        gene, stimulus, microbe, taxon, ontology_term, study, sample, term_name, chemical_class, taxon_rank,
    )
}
