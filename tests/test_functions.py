import unicodedata

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helixmart.functions import ids, records, text, values

OBO = "http://purl.obolibrary.org/obo/"


def test_strip_version_cuts_at_first_dot(one):
    assert one(ids.strip_version, "ENSG00000139618.15", "a.b.c", "x", None) == ["ENSG00000139618", "a", "x", None]


def test_strip_version_suffix(one):
    got = one(ids.strip_version_suffix, "ENSG1.15", "a.b", "a.1.2", "a.1\n", ".5")
    assert got == ["ENSG1", "a.b", "a.1", "a\n", ""]


def test_strip_ensembl_version(one):
    got = one(
        ids.strip_ensembl_version, "ENSG00000000003.5", "ENSG00000000003", "BRCA1", None, "   ", " ENSG00000000003.5 ",
        "ENSMUSG00000017167.3", "BRCA1.2",
    )
    assert got == [
        "ENSG00000000003", "ENSG00000000003", "BRCA1", None, None, "ENSG00000000003", "ENSMUSG00000017167.3", "BRCA1.2",
    ]


def test_lowercase_ascii(one):
    got = one(
        text.lowercase_ascii, "  β‑Alanine  ", "", "   ", None, "Ångström ±5 µm 20°", "ﬁne ½", "日本", " A\t\nB\x1cC ", "ΟΣ",
        "plain TEXT",
    )
    assert got == [
        "beta-alanine", None, None, None, "angstrom +/-5 um 20deg", "fine 12", None, "a b c", "sigmasigma", "plain text",
    ]


def test_tidy_punct_every_mark(one):
    assert one(text.tidy_punct, "".join(text.PUNCTUATION)) == ["".join(text.PUNCTUATION.values())]
    assert one(text.tidy_punct, "as is", None) == ["as is", None]


def test_ascii_slug(one):
    assert one(text.ascii_slug, "Α-β  X\u00a0y", " \u2003 ", None, "A  B") == ["alpha-beta x y", None, None, "a b"]
    assert one(text.ascii_slug, "".join(text.GREEK)) == ["".join(text.GREEK.values())]


def plain_ascii(s):
    """The same rules in plain Python."""
    for mark, stand_in in [*text.PUNCTUATION.items(), *text.GREEK.items()]:
        s = s.replace(mark, stand_in)
    s = " ".join(s.split()).lower()
    letters = unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode()
    return letters.lower().strip() or None


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.sampled_from(" \t\n\x1c\u00a0\u2003aBé½±°Ωο–ß"), max_size=12), min_size=5, max_size=30))
def test_text_functions_do_not_depend_on_the_path(one, samples):
    # The JVM path and the Arrow helpers must agree on what they share.
    jvm = one(lambda c: text._squeeze(c), *samples)
    assert jvm == [" ".join(s.split()).lower() or None for s in samples]
    plain = one(text.lowercase_ascii, *samples)
    assert plain == [plain_ascii(s) for s in samples]


def test_split_commas(one):
    assert one(values.split_commas, "A, B ,C,, ", None, "") == [["A", "B", "C"], [], []]


def test_split_semicolons_and_go_terms(one):
    assert one(values.split_semicolons, "a ; b;;c ") == [["a", "b", "c"]]
    assert one(values.split_go_terms, "GO:1|GO:2") == [["GO:1", "GO:2"]]


def test_split_payload(one):
    assert one(values.split_payload, "tag:a,b", "tag,a,b:c", "solo") == [["a", "b"], ["a", "b:c"], ["solo"]]


def test_canonical_iri(one):
    got = one(
        ids.canonical_iri, "CHEBI:17968", "CHEBI_17968", "EFO:1", "NCBITaxon_9606", "CL_0000127", "UBERON:1:2",
        "PR_1", "http://x/CHEBI:1", "chebi:1", "CHEBI", None,
    )
    assert got == [
        OBO + "CHEBI_17968", OBO + "CHEBI_17968", "http://www.ebi.ac.uk/efo/EFO_1", OBO + "NCBITaxon_9606",
        OBO + "CL_0000127", OBO + "UBERON_1:2", "PR_1", "http://x/CHEBI:1", "chebi:1", "CHEBI", None,
    ]


@pytest.mark.parametrize(
    "curie,iri",
    [("CL:0000057", OBO + "CL_0000057"), ("NCBITaxon:9606", OBO + "NCBITaxon_9606"), ("EFO:1", "http://www.ebi.ac.uk/efo/EFO_1")],
)
def test_curie_iri_round_trip(one, curie, iri):
    assert one(ids.curie_to_iri, curie) == [iri]
    assert one(ids.iri_to_curie, iri) == [curie]


def test_ontology_id(one):
    got = one(
        ids.ontology_id, "CL:0000057", OBO + "CL_0000057", "PR:1", "http://other/CL_1", "http://www.ebi.ac.uk/efo/CL_1",
        OBO + "EFO_1", "CL_1", "CL:a\nb", None,
    )
    assert [g and (g["curie"], g["iri"], g["prefix"]) for g in got] == [
        ("CL:0000057", OBO + "CL_0000057", "CL"), ("CL:0000057", OBO + "CL_0000057", "CL"),
        None, None, None, None, None, ("CL:a\nb", OBO + "CL_a\nb", "CL"), None,
    ]


def test_every_ontology_round_trips(one):
    curies = [f"{p}:123" for p in ids.ONTOLOGY_BASES]
    iris = one(ids.curie_to_iri, *curies)
    assert iris == [base + "123" for base in ids.ONTOLOGY_BASES.values()]
    assert one(ids.iri_to_curie, *iris) == curies


def test_sample_and_geo_ids(one):
    assert one(ids.is_sample_id, "SAMPAB12CD34", "SAMPab12CD34", "SAMPAB12CD34\n", None) == [True, False, False, None]
    assert one(ids.geo_archive_prefix, "GSE123553", "GSE12", "BAD123", "GSE", None) == ["GSE123nnn", "GSE0nnn", None, None, None]
    assert one(ids.study_accession, " e-mtab-1234 ", "\u00a0gse1\u00a0") == ["E-MTAB-1234", "GSE1"]


def test_taxon_and_chebi(one):
    assert one(ids.taxon_number, "NCBITaxon:824", "824", "x:y", None) == [824, 824, None, None]
    assert one(ids.chebi_number, "CHEBI:12", OBO + "CHEBI_34", "EFO:1") == ["12", "34", None]


def test_species_feature_and_stimulus(one):
    assert one(ids.species_of_gene, "ENSG1", "ENSMUSG1", "ENSDARG1") == [9606, 10090, None]
    got = one(ids.split_feature_name, "A1BG_ENSG00000121410", "A_B_ENSG1.2", "ENSG1")
    assert [g and tuple(g) for g in got] == [("A1BG", "ENSG00000121410"), ("A_B", "ENSG1.2"), None]
    assert one(ids.is_stimulus_iri, "CHEBI:1", "EFO:2", "NONE", "PUBCHEM:3", "none") == [True, True, True, False, False]


def test_gene_length(spark):
    df = spark.createDataFrame([(10, 20), (5, 0), (5, None), (5, 4)], "s long, e long")
    assert [r[0] for r in df.select(values.gene_length(F.col("s"), F.col("e"))).collect()] == [11, None, None, None]


def test_json_and_fallbacks(one, spark):
    assert one(lambda c: values.json_field(c, "$.a.b", "d"), '{"a":{"b":"x"}}', '{"a":1}') == ["x", "d"]
    df = spark.createDataFrame([("", None, "c"), (None, None, "")], "a string, b string, c string")
    got = [r[0] for r in df.select(values.first_filled(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == ["c", None]
    assert one(values.date_prefix, "2024-05-06T01:02") == ["2024-05-06"]


def test_link_records(one):
    (good, short, bad) = one(records.sample_microbe, "sm,S1,NCBITaxon:816,0.25,ev", "sm,S1,816,0.25", "sm,S1,NCBITaxon:x,y,ev")
    assert tuple(good) == ("S1", 816, "ev", 0.25)
    assert short is None
    assert tuple(bad) == ("S1", None, "ev", None)
    assert one(records.sample_microbe_valid, "sm,S1,NCBITaxon:816,0.25,ev", "sm,S1,816,0.25", "sm,S1,NCBITaxon:x,1,ev", None) == [
        True, False, False, False,
    ]
    (stim,) = one(records.sample_stimulus, "ss,S1,CHEBI:1,2.5,marker")
    assert tuple(stim) == ("S1", OBO + "CHEBI_1", 2.5, "marker")
    (link,) = one(records.microbe_stimulus, "NCBITaxon:9,EFO:1,0.5,")
    assert tuple(link) == (9, "http://www.ebi.ac.uk/efo/EFO_1", "", 0.5)


def test_expression_record(one):
    good, extra, short = one(
        records.expression_stat, "exprstat:S1,ENSG1.2,1.5,0.01,10,7,High", "x:S1,E,1,1,1,1,Low,more:z", "exprstat:S1,E,1"
    )
    assert tuple(good) == ("S1", "ENSG1", 1.5, 0.01, 10.0, 7, "High")
    assert tuple(extra) == ("S1", "E", 1.0, 1.0, 1.0, 1, "Low")
    assert short is None
    assert one(records.expression_stat_valid, "exprstat:S1,E,1,1,1,1.5,L", "no tag") == [False, False]


def test_arrow_helpers_keep_length():
    assert text._base_letters.func(pa.array(["é", None, "日", "ﬁ½", "a\u2003 β"])).to_pylist() == ["e", None, None, "fi12", "a beta"]


def test_every_character_is_spelled_as_the_rules_say(spark):
    points = [p for p in range(1, 0x3000) if not 0xD800 <= p < 0xE000] + list(range(0xF900, 0x10000)) + [0x1F600, 0x1D400]
    df = spark.createDataFrame([(p, f" A{chr(p)}{chr(p)} B") for p in points], "p int, v string")
    got = {r["p"]: r["t"] for r in df.select("p", text.lowercase_ascii(F.col("v")).alias("t")).collect()}
    assert {p: t for p, t in got.items() if t != plain_ascii(f" A{chr(p)}{chr(p)} B")} == {}


def test_foreign_text_stands_in_the_plan_once(spark):
    plan = spark.range(1).select(text.lowercase_ascii(F.col("id").cast("string")).alias("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1
