import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conftest import bag
from helixmart.functions.registry import CURRENT, LEGACY
from helixmart.operators.align import align, merge_rows
from helixmart.operators.eav import column_rules, harmonize_items, staged_sizes, staged_values, to_items, zip_columns
from helixmart.operators.rules import harmonize, load_rules, split_quarantine


def mapping(**columns):
    return {"columns": columns}


def rule(table, target, transforms=(), regex=None):
    spec = {"target_table": table, "transforms": list(transforms)}
    spec["target_columns" if isinstance(target, list) else "target_column"] = target
    if regex is not None:
        spec["regex"] = regex
    return spec


def brute_force(rows, rules):
    """The rule semantics, row by row: rules are (regex, function, target)."""
    import re

    out = []
    for row in rows:
        new = dict(row)
        for value in row.values():
            if not isinstance(value, str):
                continue
            for regex, fn, target in rules:
                if regex is None or re.fullmatch(regex, value):
                    result = fn(value)
                    new.update(result if isinstance(result, dict) else {target: result})
        out.append(new)
    return out


def test_later_cell_and_later_rule_win(spark):
    rules = load_rules(
        mapping(
            up=rule("T", "x", ["up"], r"a.*"),
            rev=rule("T", "x", ["rev"], r".b.*"),
            own=rule("T", "p", [], r"z.*"),
        ),
        CURRENT.extended(up=F.upper, rev=F.reverse),
    )
    rows = [
        {"p": p, "q": q, "n": 1} for p in ("ab1", "zb", "a2", None, "q") for q in ("ab3", "cb4", "z5", "", None)
    ]
    df = spark.createDataFrame([(r["p"], r["q"], r["n"]) for r in rows], "p string, q string, n int")
    got = harmonize(df, "T", rules)
    expected = brute_force(
        rows, [(r"a.*", str.upper, "x"), (r".b.*", lambda v: v[::-1], "x"), (r"z.*", lambda v: v, "p")]
    )
    assert got.columns == ["p", "q", "n", "x"]
    assert bag(got) == sorted(((e["p"], e["q"], 1, e.get("x")) for e in expected), key=repr)


def test_struct_payload_overwrites_with_nulls_and_mixed_types(spark):
    rules = load_rules(
        mapping(
            stat=rule("T", "sample_id", ["parse_expression_stat_record"], r"exprstat:.*"),
            name=rule("T", "raw_count", [], r"keep.*"),
        )
    )
    df = spark.createDataFrame(
        [("exprstat:S,E.1,1,0.5,2,7,High", "keep"), ("other", "x"), ("keep", "exprstat:S,E.1,1,0.5,2,7,High")],
        "a string, raw_count string",
    )
    got = {r["a"]: r for r in harmonize(df, "T", rules).collect()}
    assert got["exprstat:S,E.1,1,0.5,2,7,High"]["raw_count"] == "keep"
    assert got["keep"]["raw_count"] == "7"
    assert got["other"]["raw_count"] == "x" and got["other"]["gene_accession"] is None
    assert got["keep"]["gene_accession"] == "E" and got["keep"]["log2_fc"] == 1.0


def test_whole_cell_must_match(spark):
    rules = load_rules(mapping(g=rule("T", "x", [], r"ENSG\d+")))
    df = spark.createDataFrame([("ENSG1",), ("ENSG1\n",), (" ENSG1",), ("ENSG1a",)], "a string")
    assert [r["x"] for r in harmonize(df, "T", rules).collect()] == ["ENSG1", None, None, None]


def test_no_regex_examines_every_text_cell_but_not_null(spark):
    rules = load_rules(mapping(g=rule("T", "x")))
    df = spark.createDataFrame([("p", None, 5), (None, None, 5)], "a string, b string, n int")
    assert [r["x"] for r in harmonize(df, "T", rules).collect()] == ["p", None]


def test_pass_through_and_stub(spark):
    df = spark.createDataFrame([("a",)], "c string")
    rules = load_rules(mapping(s=rule("T", "x", ["strip_version", "stub_fetch_gene_metadata"])))
    assert harmonize(df, "Other", rules).columns == ["c"]
    assert harmonize(df, "T", rules).columns == ["c"]


def test_unknown_transform_fails_at_plan_time_but_not_in_legacy():
    spec = mapping(s=rule("T", "x", ["nope"]))
    with pytest.raises(KeyError, match="nope"):
        load_rules(spec)
    assert load_rules(spec, LEGACY)["T"][0].chain == ()


def test_scalar_for_two_targets_is_an_error(spark):
    rules = load_rules(mapping(s=rule("T", ["x", "y"], ["strip_version"])))
    with pytest.raises(ValueError, match="2 target columns"):
        harmonize(spark.createDataFrame([("a",)], "c string"), "T", rules)


def test_bad_value_fails_or_is_quarantined(spark):
    rules = load_rules(mapping(s=rule("T", "iri", ["extract_sample_id"], r"SAMP.*"), n=rule("T", "t", ["fetch_from_ncbi_taxon"], "NCBI.*")))
    df = spark.createDataFrame(
        [("SAMPAAAA1111", "NCBITaxon:5"), ("SAMPbad", "NCBITaxon:5"), ("other", "NCBITaxon:q"), ("none", "none")], "c string, d string"
    )
    with pytest.raises(Exception, match="malformed value"):
        harmonize(df, "T", rules).collect()
    clean, rejected = split_quarantine(harmonize(df, "T", rules, on_error="quarantine"))
    assert bag(clean) == [("SAMPAAAA1111", "NCBITaxon:5", "SAMPAAAA1111", 5), ("none", "none", None, None)]
    assert bag(rejected.select("c", "_rejected")) == [("SAMPbad", ["s"]), ("other", ["n"])]


def test_lookup_chain_joins_references(spark):
    rules = load_rules(mapping(g=rule("Genes", "gene_accession", ["strip_version", "fetch_gene_metadata"], r"ENSG\d+(\.\d+)?")))
    df = spark.createDataFrame([("ENSG0001.2", "x"), ("ENSG0002", "ENSG0001.9"), ("q", "r")], "a string, b string")
    a = spark.createDataFrame([("ENSG0001", "SYM", None, 5, 9, ["t1", "t2"])], "gene_accession string, symbol string, name string, start long, end long, go_bp array<string>")
    got = {r["a"]: r for r in harmonize(df, "Genes", rules, {"gene": {"a": a}}).collect()}
    assert (got["ENSG0001.2"]["gene_name"], got["ENSG0001.2"]["gene_length_bp"], got["ENSG0001.2"]["go_terms"]) == ("SYM", 5, '["t1","t2"]')
    assert got["ENSG0002"]["gene_accession"] == "ENSG0001"
    assert got["q"]["gene_name"] is None
    offline = {r["a"]: r for r in harmonize(df, "Genes", rules).collect()}
    assert offline["ENSG0001.2"]["gene_name"] == "Gene0001"


def test_user_pandas_udf_as_transform(spark):
    @F.pandas_udf("string")
    def twice(s):
        return s + s

    rules = load_rules(mapping(s=rule("T", "x", ["twice"], "a.")), CURRENT.extended(twice=twice))
    assert [r["x"] for r in harmonize(spark.createDataFrame([("ab",)], "c string"), "T", rules).collect()] == ["abab"]


def test_yaml_mapping(tmp_path, spark):
    pytest.importorskip("yaml")
    path = tmp_path / "m.yml"
    path.write_text("columns:\n  g:\n    regex: 'E\\d+'\n    target_table: T\n    target_column: x\n    transforms: [strip_version]\n")
    assert load_rules(str(path))["T"][0].regex == r"E\d+"


def test_align(spark):
    df = spark.createDataFrame([("1", "x", "")], "a string, extra string, d string")
    target = StructType.fromDDL("a int, b string, d date")
    got = align(df, target)
    assert got.schema.names == ["a", "b", "d"] and got.collect()[0][:] == (1, None, None)
    with pytest.raises(ValueError):
        align(df, StructType.fromDDL("zz int"))
    assert align(spark.createDataFrame([("q",)], "a string"), target, lenient=True).collect()[0]["a"] is None


def test_merge_rows(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    update = spark.createDataFrame([(1, None, 9)], "k int, v string, w int")
    assert bag(merge_rows(base, update, ["k"])) == [(1, None, 9), (2, "b", None)]


GENE_MAPPING = mapping(
    **{
        "var.gene_id": rule("Genes", "gene_id", ["strip_ensembl_version"], r"^ENSG\d{11}(?:\.\d+)?$"),
        "obs.stimulus": rule("Stimuli", "label", ["lowercase_ascii"], ".*"),
        "sdrf.cell type": rule("Samples", "cell", []),
        "obs.a.b": rule("Samples", "dotted", []),
        "obs.dup": rule("Samples", "d", []),
        "var.dup": rule("Samples", "d", []),
    }
)


def test_staging_goldens(spark):
    items = spark.createDataFrame(
        [("gene_id", "ENSG00000123456.17"), ("gene_id", "ENSG00000123456"), ("stimulus", "  Butyrate "), (None, "x"), ("dup", "y"), ("stimulus", None)],
        "column string, value string",
    )
    staged = staged_values(harmonize_items(items, GENE_MAPPING))
    assert bag(staged) == [("Genes", "gene_id", "ENSG00000123456"), ("Stimuli", "label", "butyrate"), ("Stimuli", "label", None)]
    assert bag(staged_sizes(staged)) == [("Genes", "gene_id", 1, False), ("Stimuli", "label", 2, True)]
    filtered = harmonize_items(items, GENE_MAPPING, apply_regex=True)
    assert filtered.count() == 3


def test_unique_suffix_includes_dotted_names():
    found = column_rules(GENE_MAPPING)
    assert set(found) == {"gene_id", "stimulus", "cell type", "b", "a.b"}


def test_items_keep_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert bag(to_items(df)) == sorted([("a", "1"), ("b", None), ("a", "2"), ("b", "x")], key=repr)


def test_zip_pads_and_loses_nothing(spark):
    rows = [("T", "x", f"v{i}") for i in range(50)] + [("T", "y", f"w{i}") for i in range(7)] + [("T", "y", None), ("U", "x", "no")]
    zipped = zip_columns(spark.createDataFrame(rows, "target_table string, target_column string, value string"), "T", ["x", "y"])
    got = zipped.orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(1, 51))
    assert {r["x"] for r in got} == {f"v{i}" for i in range(50)}
    assert [r["y"] is not None for r in got] == [True] * 7 + [False] * 43


def test_legacy_lookup_items(spark):
    spec = mapping(**{"obs.cell": rule("OntologyTerms", "label", ["get_name"])})
    items = spark.createDataFrame([("cell", "CL:1"), ("cell", "CL:2"), ("cell", "XX:1")], "column string, value string")
    names = spark.createDataFrame([("CL:1", "astrocyte")], "curie string, label string")
    got = harmonize_items(items, spec, references={"term_name": {"a": names}})
    assert bag(got) == [("OntologyTerms", "label", "astrocyte"), ("OntologyTerms", "label", None), ("OntologyTerms", "label", None)]


OBO = "http://purl.obolibrary.org/obo/"


@pytest.mark.parametrize(
    "table,chain,cell,expected",
    [
        ("Stimuli", ["canonical_iri", "fetch_stimulus_metadata"], "CHEBI:17968",
         {"iri": OBO + "CHEBI_17968", "label": "CHEBI_17968", "class_hint": "", "default_dose": 1.0, "dose_unit": "mM", "molecular_weight": None}),
        ("Microbes", ["fetch_from_ncbi_taxon", "fetch_microbe_metadata"], "NCBITaxon:818",
         {"taxon_iri": "NCBITaxon_818", "strain_name": "Strain_818", "genome_size_bp": None}),
        ("Taxa", ["fetch_taxon_numeric_id", "fetch_taxon_metadata"], "NCBITaxon:9606",
         {"iri": "NCBITaxon_9606", "kingdom": "Bacteria", "ranking": "species", "habitat": "intestine"}),
        ("OntologyTerms", ["fetch_ontology_term_metadata"], OBO + "CL_0000127",
         {"iri": OBO + "CL_0000127", "label": "CL_0000127", "ontology": "CL", "synonyms": "[]", "onto_version": "2025-06"}),
        ("Studies", ["normalize_study_accession", "fetch_study_metadata"], " gse12 ",
         {"iri": "GSE12", "title": "Synthetic study GSE12", "source_repo": "LOCAL", "contact_email": "gse12@example.org"}),
        ("Samples", ["extract_sample_id", "fetch_sample_metadata"], "SAMPAAAA1111",
         {"iri": "SAMPAAAA1111", "study_iri": "LOCAL-STUDY", "tissue_iri": "UBERON_0000955", "raw_counts_uri": "s3://bucket/SAMPAAAA1111.zarr", "replicate_number": 1}),
    ],
)
def test_default_metadata_reaches_the_target_table(spark, table, chain, cell, expected):
    from helixmart.plans.schemas import TABLES

    rules = load_rules(mapping(r=rule(table, "iri", chain, r"(?!other).*")))
    df = spark.createDataFrame([(cell, 1), ("other", 2)], "cell string, n int")
    shaped = harmonize(df, table, rules, as_of="2025-06-30")
    got = align(shaped.filter("n = 1"), TABLES[table]).first().asDict()
    assert {k: got[k] for k in expected} == expected
    assert set(align(shaped.filter("n = 2"), TABLES[table]).first()) == {None}
