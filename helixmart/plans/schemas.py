"""Target tables: columns, types and the keys their sinks use by default."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)

# --- fixed values -----------------------------------------------------------------------
_COLUMNS = {
    "Genes": "gene_accession string, gene_name string, species_taxon_iri string, gene_length_bp int, "
    "gc_content double, pathway_iri string, go_terms string",
    "Taxa": "iri string, species_name string, kingdom string, ranking string, gc_content double, "
    "genome_length bigint, habitat string, pathogenicity string",
    "Microbes": "taxon_iri string, strain_name string, genome_size_bp bigint, oxygen_requirement string, "
    "abundance_index double, prevalence int, culture_collection string, genome_assembly_accession string, "
    "habitat string, optimal_growth_temp double, doubling_time double, metabolic_profile_iri string",
    "Stimuli": "iri string, label string, class_hint string, chem_formula string, smiles string, "
    "molecular_weight double, default_dose double, dose_unit string",
    "OntologyTerms": "iri string, label string, ontology string, term_definition string, synonyms string, "
    "onto_version string",
    "Studies": "iri string, title string, source_repo string, publication_date date, study_type string, "
    "num_samples int, contact_email string",
    "Samples": "iri string, study_iri string, cell_type_iri string, tissue_iri string, organism_iri string, "
    "growth_condition string, raw_counts_uri string, collection_date date, donor_age_years int, "
    "replicate_number int, viability_pct double, rin_score double",
    "SampleMicrobe": "sample_id string, microbe_id string, evidence string, relative_abundance double",
    "SampleStimulus": "sample_id string, stimulus_id string, exposure_time_hr double, response_marker string",
    "MicrobeStimulus": "microbe_id string, stimulus_id string, evidence string, interaction_score double",
    "RawCounts": "sample_id string, gene_iri string, count bigint",
    "ExpressionStats": "sample_id string, gene_accession string, log2_fc double, p_value double, "
    "base_mean double, raw_count bigint, significance string",
}

# Two rows of Taxa may share an IRI (species and strain), so the rank is part of the key.
KEYS = {
    "Genes": ["gene_accession"],
    "Taxa": ["iri", "ranking"],
    "Microbes": ["taxon_iri"],
    "Stimuli": ["iri"],
    "OntologyTerms": ["iri"],
    "Studies": ["iri"],
    "Samples": ["iri"],
    "SampleMicrobe": ["sample_id", "microbe_id"],
    "SampleStimulus": ["sample_id", "stimulus_id"],
    "MicrobeStimulus": ["microbe_id", "stimulus_id"],
    "ExpressionStats": ["sample_id", "gene_accession"],
}
# ----------------------------------------------------------------------------------------

_TYPES = {
    "string": StringType(), "int": IntegerType(), "bigint": LongType(), "double": DoubleType(), "date": DateType(),
}


def _table(columns: str) -> StructType:
    pairs = [c.split() for c in columns.split(",")]
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


TABLES = {name: _table(columns) for name, columns in _COLUMNS.items()}
