import json

from conftest import bag
from helixmart import __main__ as cli
from helixmart.plans import attributes
from helixmart.plans.schemas import TABLES
from helixmart.sinks.merge import read_target
from test_loading import MAPPING, raw_folder

ATTRIBUTES = {
    "columns": {
        "sdrf.gene": {"target_table": "Genes", "target_column": "gene_id", "transforms": ["strip_ensembl_version"]},
        "sdrf.label": {"target_table": "Genes", "target_column": "label", "transforms": ["lowercase_ascii"]},
        "obs.cell": {"target_table": "Cells", "target_column": "cell", "transforms": []},
    }
}


def test_attribute_load(spark, tmp_path):
    folder = tmp_path / "in"
    (folder / "a").mkdir(parents=True)
    (folder / "b").mkdir()
    (folder / "a/sdrf.tsv").write_text("gene\tlabel\tother\nENSG000001.1\t Butyrate \tx\nENSG000001\tNA\tx\n")
    (folder / "b/sdrf.txt").write_text("label\tgene\nbutyrate\tENSG000002\n")
    (folder / "b/sdrf.raw.tsv").write_text("gene\nENSG000009\n")
    (folder / "b/other.tsv").write_text("gene\nENSG000008\n")
    items = attributes.file_items(spark, str(folder), ATTRIBUTES)
    assert bag(items.filter("column = 'gene'")) == [("gene", "ENSG000001"), ("gene", "ENSG000001.1"), ("gene", "ENSG000002")]
    assert attributes.file_items(spark, str(folder), ATTRIBUTES, mode="counts").count() == 0
    keys = {"Genes": ["gene_id"], "Cells": ["cell"]}
    root = str(tmp_path / "db")
    assert attributes.load_items(items, ATTRIBUTES, root, keys) == {"Genes": 2}
    assert attributes.load_items(items, ATTRIBUTES, root, keys) == {"Genes": 2}
    got = attributes.stored(spark, root, "Genes", ["gene_id", "label"])
    assert {r["gene_id"] for r in got.collect()} == {"ENSG000001", "ENSG000002"}
    assert sorted((r["label"] for r in got.collect()), key=repr) == ["butyrate", None]


def test_store_items(spark, tmp_path):
    store = f"{tmp_path}/s.zarr"
    spark.createDataFrame([("g",)], "gene_id string").write.parquet(f"{store}/var")
    spark.createDataFrame([("S1", "CL:1")], "sample_id string, cell string").write.parquet(f"{store}/obs")
    assert bag(attributes.store_items(spark, store, ATTRIBUTES)) == [("cell", "CL:1")]
    assert bag(attributes.store_items(spark, store, ATTRIBUTES, "both")) == [("cell", "CL:1"), ("zarr_uri", f"{store}#obs/S1")]


def test_command_line(spark, tmp_path, capsys):
    data, root = raw_folder(tmp_path), str(tmp_path / "db")
    mapping = tmp_path / "m.yml"
    mapping.write_text(json.dumps(MAPPING))
    cli.main(["discover", "--data-dir", data])
    assert capsys.readouterr().out.count(".tsv") == 5
    assert bag(cli.count_rows(spark, data, "metadata")) == [("Genes", 3), ("Samples", 1), ("Studies", 1)]
    cli.main(["load", "--data-dir", data, "--mapping", str(mapping), "--target", root])
    assert json.loads(capsys.readouterr().out) == {"Studies": 1, "Genes": 2, "Samples": 1}
    lines = tmp_path / "rows" / "r.json"
    lines.parent.mkdir()
    lines.write_text('{"table":"Genes","row":{"gene_accession":"ENSG9"}}\n')
    cli.main(["load-json", str(lines), "--target", root])
    assert json.loads(capsys.readouterr().out) == {"Genes": 1}
    cli.main(["follow", "--data-dir", str(lines.parent), "--target", root, "--checkpoint", str(tmp_path / "cp")])
    assert read_target(spark, f"{root}/Genes", TABLES["Genes"]).count() == 3
