import os

import pytest
from pyspark.sql import functions as F

from fathomkit.session import fresh_path
from fathomkit.sources import rdf

HEAD = '<?xml version="1.0"?>\n<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:fb="http://x#">\n'


def write(spark, text):
    folder = fresh_path(spark, "rdf")
    os.makedirs(folder)
    with open(f"{folder}/a.rdf", "w", encoding="utf-8") as f:
        f.write(text)
    return folder


def triples(df):
    return {(r["s"], r["p"], r["o"], r["o_kind"], r["o_lang"], r["o_dtype"]) for r in df.collect()}


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_one_file_is_read_by_many_tasks(spark, small_splits):
    want, parts = set(), [HEAD]
    for i in range(900):
        name = f"Näme &amp; <b> {i} > \"x\"" if i % 7 == 0 else f"Name {i}"
        shown = name.replace("&amp;", "&").replace("&", "&amp;").replace("<", "&lt;")
        parts.append(f'  <rdf:Description rdf:about="n/{i}">\n    <fb:name xml:lang="en">{shown}</fb:name>\n'
                     f'    <fb:in rdf:resource="c/{i % 9}"/><fb:in rdf:resource="c/{i % 5}"/>\n  </rdf:Description>\n')
        want.add((f"n/{i}", "fb:name", name.replace("&amp;", "&"), "literal", "en", None))
        want |= {(f"n/{i}", "fb:in", f"c/{i % m}", "iri", None, None) for m in (9, 5)}
        if i % 50 == 0:
            parts.append(f'<rdf:Description rdf:about="empty/{i}"/>\n')
    path = write(spark, "".join(parts) + "</rdf:RDF>\n")
    assert rdf._records(spark, path, "rdf:Description").rdd.getNumPartitions() > 10
    for predicates in (None, ["fb:name", "fb:in"]):
        assert triples(rdf.read_rdf_xml(spark, path, predicates)) == want
    only = rdf.read_rdf_xml(spark, path, ["fb:name"])
    assert triples(only) == {t for t in want if t[1] == "fb:name"}


def test_other_elements_inside_a_record(spark, small_splits):
    text = HEAD + ('<fb:Club rdf:about="a"><fb:name>x</fb:name><fb:site><fb:Place><fb:name>deep</fb:name></fb:Place></fb:site>'
                   '</fb:Club><fb:Clubhouse rdf:about="h"><fb:name>no</fb:name></fb:Clubhouse>'
                   "<fb:Club rdf:about='b'><fb:name>1 &gt; 0</fb:name></fb:Club></rdf:RDF>")
    got = triples(rdf.read_rdf_xml(spark, write(spark, text), ["fb:name"], "fb:Club", "fb:Club"))
    assert got == {("a", "fb:name", "x", "literal", None, None), ("b", "fb:name", "1 > 0", "literal", None, None),
                   ("a", "rdf:type", "fb:Club", "iri", None, None), ("b", "rdf:type", "fb:Club", "iri", None, None)}


def test_records_of_the_same_tag_inside_each_other(spark):
    text = HEAD + ('<rdf:Description rdf:about="a"><fb:name>out</fb:name><fb:has><rdf:Description rdf:about="b">'
                   '<fb:name>in</fb:name></rdf:Description></fb:has><fb:year>1</fb:year></rdf:Description></rdf:RDF>')
    path = write(spark, text)
    assert rdf._records(spark, path, "rdf:Description").where("opens > 1").count() == 1
    got = triples(rdf.read_rdf_xml(spark, path, ["fb:name", "fb:year"]))
    assert {("a", "fb:name", "out", "literal", None, None), ("a", "fb:year", "1", "literal", None, None)} <= got


def test_no_records(spark):
    assert rdf.read_rdf_xml(spark, write(spark, HEAD + "</rdf:RDF>"), ["fb:name"]).collect() == []
