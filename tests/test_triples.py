import os

import pytest

from fathomkit.operators import triples as t
from fathomkit.session import fresh_path
from fathomkit.sources import rdf

SCHEMA = "s string, p string, o string, o_kind string, o_lang string, o_dtype string"


def graph(spark, rows):
    return spark.createDataFrame([(*r, "iri", None, None) if len(r) == 3 else r for r in rows], SCHEMA)


def test_rdf_xml_round_trip(spark):
    rows = [
        ("http://x/a?b=1&c=2", "fb:name", 'Tom & "Ann" <x>', "literal", "en", None),
        ("http://x/a?b=1&c=2", "fb:name", "Nom", "literal", "fr", None),
        ("http://x/b", "fb:size", "42", "literal", None, "xsd:int"),
        ("http://x/b", "fb:near", "http://x/a?b=1&c=2", "iri", None, None),
    ]
    path = rdf.write_rdf_xml(graph(spark, rows), fresh_path(spark, "rt"), {"fb": "http://x#"})
    got = rdf.read_rdf_xml(spark, path, ["fb:name", "fb:size", "fb:near"])
    assert {tuple(r) for r in got.collect()} == set(rows)


def test_typed_node_elements(spark, tmp_path):
    with open(os.path.join(tmp_path, "g.owl"), "w") as f:
        f.write(
            '<?xml version="1.0"?>\n<rdf:RDF xmlns:rdf="r" xmlns:owl="o" xmlns:fb="f">\n'
            '<owl:NamedIndividual rdf:about="x1"><rdf:type rdf:resource="T"/>'
            '<fb:cap rdf:datatype="i">5</fb:cap><fb:cap rdf:datatype="i">6</fb:cap></owl:NamedIndividual>\n'
            '<owl:NamedIndividual rdf:about="x2"><fb:name xml:lang="en">N</fb:name></owl:NamedIndividual>\n</rdf:RDF>\n'
        )
    got = rdf.read_rdf_xml(
        spark, str(tmp_path), ["rdf:type", "fb:cap", "fb:name"], "owl:NamedIndividual", "owl:NamedIndividual"
    )
    assert {(r["s"], r["p"], r["o"]) for r in got.collect()} == {
        ("x1", "rdf:type", "T"), ("x1", "fb:cap", "5"), ("x1", "fb:cap", "6"), ("x2", "fb:name", "N"),
        ("x1", "rdf:type", "owl:NamedIndividual"), ("x2", "rdf:type", "owl:NamedIndividual"),
    }


def test_closure_of_chain_cycle_and_hub(spark):
    edges = [(f"n{i}", f"n{i + 1}") for i in range(9)] + [("a", "b"), ("b", "c"), ("c", "a")]
    edges += [(f"leaf{i}", "n0") for i in range(40)]
    g = graph(spark, [(s, "in", o) for s, o in edges])
    reach: dict = {}
    for s, o in edges:
        reach.setdefault(s, set()).add(o)
    grew = True
    while grew:
        grew = False
        for s in reach:
            more = set().union(*(reach.get(o, set()) for o in reach[s])) - reach[s]
            if more:
                reach[s] |= more
                grew = True
    got = {(r["s"], r["o"]) for r in t.closure(g, "in").collect()}
    assert got == {(s, o) for s, os in reach.items() for o in os}


def test_construct_skips_unbound(spark):
    sol = spark.createDataFrame([("t1", "s1", "9"), ("t2", None, None), ("t1", "s1", "9")], "team string, st string, cap string")
    got = {tuple(r) for r in t.construct(sol, [("team", "has", "st"), ("st", "cap", "cap")]).collect()}
    assert got == {("t1", "has", "s1"), ("s1", "cap", "9")}


def test_axioms_and_rules(spark):
    g = t.store(graph(spark, [
        ("p1", "rdf:type", "Player"), ("p1", "playsFor", "t1"), ("t1", "rdf:type", "Team"),
        ("t1", "competesin", "l1"), ("t1", "hasStadium", "s1"), ("t1", "hasStadium", "s2"),
        ("s1", "stadiumCapacity", "60001", "literal", None, None), ("s2", "stadiumCapacity", "60000", "literal", None, None),
        ("x", "playsFor", "x"), ("t1", "hasPlayer", "p9"),
    ]))
    assert [tuple(r) for r in t.participation_rule(g).collect()] == [("p1", "participatesIn", "l1")]
    assert [tuple(r) for r in t.large_stadium_rule(g).collect()] == [("t1", "largeStadium", "s1")]
    assert [tuple(r) for r in t.functional_violations(g, "hasStadium").collect()] == [("t1", 2)]
    assert [r["s"] for r in t.irreflexive_violations(g, "playsFor").collect()] == ["x"]
    assert {(r["s"], r["o"]) for r in t.inverse(g, "playsFor", "hasPlayer").collect()} == {("t1", "p1"), ("t1", "p9"), ("x", "x")}


def test_sources_are_linked_by_name(spark):
    g = graph(spark, [
        ("d/1", "rdf:type", "Team"), ("d/1", "hasName", "United", "literal", "en", None),
        ("w/1", "rdf:type", "Team"), ("w/1", "hasName", "United", "literal", "en", None),
        ("p", "playsFor", "w/1"),
    ])
    got = {(r["s"], r["p"], r["o"]) for r in t.link_by_name(g, "Team").collect()}
    assert got == {("d/1", "rdf:type", "Team"), ("d/1", "hasName", "United"), ("p", "playsFor", "d/1")}


def test_patterns_without_shared_variable_are_refused(spark):
    g = graph(spark, [("a", "p", "b")])
    with pytest.raises(ValueError):
        t.conjoin(t.facts(g, "p", "x", "y"), t.facts(g, "p", "u", "v"))


def test_names_that_link_through_others(spark):
    rows = [(x, t.TYPE, "Team") for x in "ABCD"] + [
        ("A", "hasName", "one", "literal", None, None), ("B", "hasName", "one", "literal", None, None),
        ("B", "hasName", "two", "literal", None, None), ("C", "hasName", "two", "literal", None, None),
        ("D", "hasName", "three", "literal", None, None), ("p", "playsFor", "C"), ("q", "playsFor", "D"),
    ]
    got = {(r["s"], r["p"], r["o"]) for r in t.link_by_name(graph(spark, rows), "Team").collect()}
    assert ("p", "playsFor", "A") in got and ("q", "playsFor", "D") in got
    assert {s for s, p, _ in got if p == t.TYPE} == {"A", "D"}
    assert {o for s, p, o in got if s == "A" and p == "hasName"} == {"one", "two"}


def test_a_triple_is_one_line(spark):
    rows = [("http://x/a b", "http://x/p", 'two\nlines\t"and"\r\\', "literal", "en", None)]
    path = rdf.write_ntriples(graph(spark, rows), fresh_path(spark, "nt"))
    lines = [r[0] for r in spark.read.text(path).collect()]
    assert lines == ['<http://x/a\\u0020b> <http://x/p> "two\\nlines\\t\\"and\\"\\r\\\\"@en .']


def test_predicates_need_not_be_listed(spark):
    rows = [
        ("http://x/a", "fb:name", "A", "literal", "en", None), ("http://x/a", "fb:name", "Ah", "literal", None, None),
        ("http://x/b", "fb:size", "42", "literal", None, "xsd:int"), ("http://x/b", "fb:near", "http://x/a", "iri", None, None),
    ]
    path = rdf.write_rdf_xml(graph(spark, rows), fresh_path(spark, "all"), {"fb": "http://x#"})
    assert {tuple(r) for r in rdf.read_rdf_xml(spark, path).collect()} == set(rows)


def test_triples_are_dealt_out_before_they_are_told_apart(spark, monkeypatch):
    """No hash table over a file split before the shuffle; the tasks follow the number of triples."""
    g = graph(spark, [(f"s{i % 90}", "p", "o") for i in range(100)])
    monkeypatch.setattr(t, "TASK_TRIPLES", 10)
    plan = t.merge(g, g)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):plan.index("== Initial Plan") if "== Initial Plan" in plan else len(plan)]
    assert "Exchange hashpartitioning" in plan and "HashAggregate" not in below and ", 20)" in below
    assert sorted(r.s for r in t.merge(g, g).collect()) == sorted(f"s{i}" for i in range(90))
