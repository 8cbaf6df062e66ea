import pytest
from pyspark.sql import functions as F

from conftest import bag
from helixmart.sources import annotated, catalog, envelope, matrix_market, sdrf, tsv


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf8")
    return str(path)


def test_discover_and_route(spark, tmp_path):
    for name in ("a/gene_catalog.tsv", "b/experiment_1.tsv", "b/c/S1_raw_counts.tsv", "x.txt", ".hidden.tsv", "my_gene_catalog.tsv"):
        write(tmp_path / name, "h\nv\n")
    files = catalog.discover_files(spark, str(tmp_path), (".tsv",))
    assert sorted(r["name"] for r in files.collect()) == ["S1_raw_counts.tsv", "experiment_1.tsv", "gene_catalog.tsv", "my_gene_catalog.tsv"]
    routed = catalog.in_load_order(catalog.route_files(files)).select("name", "table", "priority").collect()
    assert [tuple(r) for r in routed] == [
        ("gene_catalog.tsv", "Genes", 6), ("my_gene_catalog.tsv", "Genes", 6), ("experiment_1.tsv", "Samples", 7), ("S1_raw_counts.tsv", "RawCounts", 100),
    ]
    assert catalog.route_files(files, "raw_counts").count() == 1
    assert catalog.route_files(files, "metadata").count() == 3
    assert catalog.only_loadable(catalog.route_files(files)).count() == 3
    assert catalog.discover_any(spark, str(tmp_path)).count() == 5
    with pytest.raises(ValueError):
        catalog.route_files(files, "other")


def test_tsv_quirks(spark, tmp_path):
    write(
        tmp_path / "ontology_terms.tsv",
        'iri\tlabel\tsynonyms\nA\tNA\t"[""x"", ""y""]"\n\nB\n \tq\tr\textra\nC\t\t\n',
    )
    rows = tsv.read_tsv_files(catalog.discover_files(spark, str(tmp_path)))
    assert rows.columns == ["iri", "label", "synonyms"]
    assert bag(rows) == sorted(
        [("A", "NA", '["x", "y"]'), ("B", None, None), (" ", "q", "r"), ("C", None, None)], key=repr
    )


def test_files_are_read_by_their_own_header(spark, tmp_path):
    write(tmp_path / "experiment_1.tsv", "iri\ttissue\nS1\tbrain\n")
    write(tmp_path / "experiment_2.tsv", "tissue\tiri\tage\ngut\tS2\t7\n")
    rows = tsv.read_tsv_files(catalog.discover_files(spark, str(tmp_path)))
    assert bag(rows.select("iri", "tissue", "age")) == [("S1", "brain", None), ("S2", "gut", "7")]


def test_equal_header_names_keep_the_last(spark, tmp_path):
    write(tmp_path / "a.tsv", "x\ty\tx\n1\t2\t3\n")
    rows = tsv.read_tsv_files(catalog.discover_files(spark, str(tmp_path)))
    assert bag(rows.select("x", "y")) == [("3", "2")]


def test_line_breaks_inside_quotes(spark, tmp_path):
    write(tmp_path / "a.tsv", 'x\ty\n"1\n2"\t3\n')
    rows = tsv.read_tsv_files(catalog.discover_files(spark, str(tmp_path)), multi_line=True)
    assert bag(rows) == [("1\n2", "3")]


def test_raw_counts_take_the_sample_from_the_file_name(spark, tmp_path):
    write(tmp_path / "e/SAMP1_raw_counts.tsv", "gene_iri\tcount\nENSG1\t5\nENSG2\t0\n")
    write(tmp_path / "SAMP2_raw_counts.tsv", "gene_iri\tcount\nENSG1\t7\n")
    write(tmp_path / "other.tsv", "gene_iri\tcount\nENSG1\t9\n")
    assert bag(tsv.read_raw_counts(spark, str(tmp_path))) == [("SAMP1", "ENSG1", 5), ("SAMP1", "ENSG2", 0), ("SAMP2", "ENSG1", 7)]


def test_attribute_reader(spark, tmp_path):
    path = write(tmp_path / "a.tsv", 'x\ty\tz\n1\tNA\tnan\n2\n3\t4\t5\t6\n"7\t7"\t8\t9\n')
    got = tsv.read_attribute_tsv(spark, path, "x\ty\tz")
    assert bag(got) == sorted([("1", None, None), ("2", None, None), ("7\t7", "8", "9")], key=repr)


def test_line_index_over_many_blocks(spark, tmp_path):
    n = 3000
    path = write(tmp_path / "barcodes.tsv", "".join(f"BC{i}\n" for i in range(1, n + 1)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        got = matrix_market.read_barcodes(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r["index"], r["cell_barcode"]) for r in got) == [(i, f"BC{i}") for i in range(1, n + 1)]


@pytest.mark.parametrize("twin", [False, True])
def test_matrix_market(spark, tmp_path, twin):
    entries = [(1, 1, 4), (2, 1, 1), (1, 2, 7)] + ([(2, 3, 4)] if twin else [])
    size = "2 3 4" if twin else "2 3 3"
    path = write(
        tmp_path / "m.mtx",
        "%%MatrixMarket matrix coordinate integer general\n%comment\n" + size + "\n" + "".join(f"{a} {b} {c}\n" for a, b, c in entries),
    )
    got = matrix_market.read_matrix_market(spark, path)
    assert bag(got) == sorted(((a, b, float(c)) for a, b, c in entries), key=repr)


def test_matrix_market_kinds(spark, tmp_path):
    sym = write(tmp_path / "s.mtx", "%%MatrixMarket matrix coordinate pattern symmetric\n3 3 2\n2 1\n3 3\n")
    assert bag(matrix_market.read_matrix_market(spark, sym)) == [(1, 2, 1.0), (2, 1, 1.0), (3, 3, 1.0)]
    with pytest.raises(ValueError):
        matrix_market.read_matrix_market(spark, write(tmp_path / "x.mtx", "1 1 1\n"))


def test_labelled_matrix(spark, tmp_path):
    from helixmart.operators.matrix import densify, label_coordinates, matrix_shape

    mtx = write(tmp_path / "matrix.mtx", "%%MatrixMarket matrix coordinate integer general\n3 2 3\n1 1 4\n3 1 1\n2 2 7\n")
    features = matrix_market.read_features(spark, write(tmp_path / "features.tsv", "G1\tA\tGene Expression\nG2\tB\tGene Expression\nG3\tA\tGene Expression\n"))
    barcodes = matrix_market.read_barcodes(spark, write(tmp_path / "barcodes.tsv", "c1\nc2\n"))
    coords = matrix_market.read_matrix_market(spark, mtx)
    labelled = label_coordinates(coords, features, barcodes)
    expected = [("c1", "G1", "A", 4.0), ("c1", "G3", "A", 1.0), ("c2", "G2", "B", 7.0)]
    assert bag(labelled) == expected
    assert bag(label_coordinates(coords, features, barcodes, salts=3)) == expected
    dense = densify(labelled, "cell_barcode", "gene_id", "value", {"G1": "A_1", "G3": "A_3"}, barcodes)
    assert bag(dense) == [("c1", 4.0, 1.0), ("c2", 0.0, 0.0)]
    assert matrix_shape(coords, "cell_index", "gene_index").first()[:] == (2, 3)


SDRF = (
    "E-MTAB-11468\t\tERR1\tcharacteristic\tcell type\tendothelial cell\thttp://x/CL_1\n"
    "E-MTAB-11468\t\tERR1\tcharacteristic\tgrowth condition\tmonoculture\n"
    "E-MTAB-11468\t\tERR1\tfactor\tcell type\tother\n"
    "E-MTAB-11468\t\tERR2\tcharacteristic\tcell type\tendothelial cell\thttp://x/CL_1\n"
)


def test_condensed_sdrf(spark, tmp_path):
    rows = sdrf.read_condensed(spark, write(tmp_path / "x.sdrf.tsv", SDRF))
    assert rows.count() == 4
    wide = sdrf.characteristics_wide(rows, {"cell type": "cell_type", "growth condition": "growth"})
    assert bag(wide) == [
        ("E-MTAB-11468", "ERR1", "endothelial cell", "monoculture", "http://x/CL_1", None),
        ("E-MTAB-11468", "ERR2", "endothelial cell", None, "http://x/CL_1", None),
    ]


def test_wide_counts(spark, tmp_path):
    header = "Gene ID\tGene Name\tERR1\tERR2"
    path = write(tmp_path / "counts.tsv", header + "\nENSG1\tTSPAN6\t5\t0\nENSG2\t\t1\t2\n")
    assert bag(sdrf.read_wide_counts(spark, path, header)) == sorted(
        [("ENSG1", "TSPAN6", "ERR1", 5), ("ENSG1", "TSPAN6", "ERR2", 0), ("ENSG2", None, "ERR1", 1), ("ENSG2", None, "ERR2", 2)], key=repr
    )


def test_envelopes(spark, tmp_path):
    path = write(tmp_path / "r.jsonl", '{"table":"Genes","row":{"gene_accession":"E1","n":5}}\n\n{"table":"Taxa","row":{"iri":"T"}}\n')
    got = envelope.rows_of(envelope.read_envelopes(spark, path), "Genes", ["gene_accession", "n", "absent"])
    assert bag(got) == [("E1", "5", None)]


def test_annotated_store(spark, tmp_path):
    for name in ("b", "a"):
        store = f"{tmp_path}/{name}.zarr"
        spark.createDataFrame([("ENSG1.2", "x"), ("ENSG2", "y")], "gene_ids string, feature_name string").withColumn(
            "feature_name", F.concat("feature_name", F.lit(name))
        ).write.parquet(f"{store}/var")
        spark.createDataFrame([("S1", "CL:1", 3)], "sample_id string, cell string, X int").write.parquet(f"{store}/obs")
    genes = annotated.gene_list(spark, [f"{tmp_path}/b.zarr", f"{tmp_path}/a.zarr"])
    assert bag(genes) == [("ENSG1",), ("ENSG2",)]
    mapping = {"columns": {k: {} for k in ("var.feature_name", "obs.cell", "obs.X", "obs.absent")}}
    items = annotated.mapped_items(spark, f"{tmp_path}/a.zarr", mapping)
    assert bag(items) == [("cell", "CL:1"), ("feature_name", "xa"), ("feature_name", "ya")]
    obs = spark.read.parquet(f"{tmp_path}/a.zarr/obs")
    assert bag(annotated.raw_count_uris(obs, "a.zarr")) == [("zarr_uri", "a.zarr#obs/S1")]
    assert annotated.raw_count_uris(obs.drop("sample_id"), "a.zarr").count() == 0
    with pytest.raises(ValueError):
        tsv.first_existing(["q"], annotated.GENE_COLUMNS)
