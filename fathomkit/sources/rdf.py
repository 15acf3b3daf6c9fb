"""RDF triples as a table: ``s, p, o, o_kind, o_lang, o_dtype``."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COLUMNS = ["s", "p", "o", "o_kind", "o_lang", "o_dtype"]

_ENTRY = T.StructType([
    T.StructField("_VALUE", T.StringType()),
    T.StructField("_rdf:resource", T.StringType()),
    T.StructField("_xml:lang", T.StringType()),
    T.StructField("_rdf:datatype", T.StringType()),
])


def _records(spark: SparkSession, path: str, row_tag: str) -> DataFrame:
    """Elements ``row_tag`` as texts in ``xml``, and how many begin in each piece in ``opens``.

    The end tag is the line separator of a text scan, so a file is read in as many splits as any text.
    """
    begin = rf"<{row_tag}(?=[\s>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?<!/)>"
    pieces = spark.read.option("lineSep", f"</{row_tag}>").text(path)
    body = F.regexp_extract("value", rf"(?s)({begin}.*)$", 1)
    return pieces.select(F.concat(body, F.lit(f"</{row_tag}>")).alias("xml"), F.regexp_count("value", F.lit(begin)).alias("opens"))


def read_rdf_xml(
    spark: SparkSession, path: str, predicates: Sequence[str] | None = None, row_tag: str = "rdf:Description",
    implied_type: str | None = None,
) -> DataFrame:
    """Triples of RDF/XML files, a record per ``row_tag`` element.

    Files are read in splits: the text up to an end tag is a record. That needs records which hold no record of the same
    tag; where a file does, each file is read by one task. Without ``predicates`` one more pass over the files finds the
    element names that occur; with them only these are read. ``implied_type`` adds the type triple that a typed node
    element stands for.
    """
    pieces = _records(spark, path, row_tag)
    if predicates is None:
        names = F.explode(F.regexp_extract_all("xml", F.lit(r"<([^\s<>/!?]+)"), F.lit(1)))
        found = pieces.where("opens > 0").select(names.alias("name")).distinct()
        predicates = sorted(r["name"] for r in found.collect() if r["name"] != row_tag)
    schema = T.StructType(
        [T.StructField("_rdf:about", T.StringType())]
        + [T.StructField(p, T.ArrayType(_ENTRY)) for p in predicates]
    )
    if pieces.where("opens > 1").isEmpty():
        nodes = pieces.where("opens = 1").select(F.from_xml("xml", schema).alias("n")).select("n.*")
    else:
        nodes = spark.read.schema(schema).format("xml").option("rowTag", row_tag).load(path)
    facts = F.array(*[F.struct(F.lit(p).alias("p"), F.col(f"`{p}`").alias("os")) for p in predicates])
    rows = nodes.select(F.col("`_rdf:about`").alias("s"), F.explode(facts).alias("f")).select(
        "s", F.col("f.p").alias("p"), F.explode("f.os").alias("e")
    )
    resource = F.col("e").getField("_rdf:resource")
    out = rows.select(
        "s", "p", F.coalesce(resource, F.col("e").getField("_VALUE")).alias("o"),
        F.when(resource.isNotNull(), "iri").otherwise("literal").alias("o_kind"),
        F.col("e").getField("_xml:lang").alias("o_lang"),
        F.col("e").getField("_rdf:datatype").alias("o_dtype"),
    ).filter("s IS NOT NULL AND o IS NOT NULL")
    if implied_type:
        none = F.lit(None).cast("string")
        typed = nodes.select(
            F.col("`_rdf:about`").alias("s"), F.lit("rdf:type").alias("p"), F.lit(implied_type).alias("o"),
            F.lit("iri").alias("o_kind"), none.alias("o_lang"), none.alias("o_dtype"),
        ).filter("s IS NOT NULL")
        out = out.union(typed)
    return out.distinct()


def _escaped(c: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def write_rdf_xml(triples: DataFrame, path: str, namespaces: Mapping[str, str]) -> str:
    """One Description element per triple, so that no subject has to be gathered.

    Every task writes a file of its own, which the wrapper makes a complete document.
    """
    spaces = {"rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#", **namespaces}
    head = "<rdf:RDF " + " ".join(f'xmlns:{k}="{v}"' for k, v in spaces.items()) + ">"

    def wrapped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": [head]})
        yield from batches
        yield pd.DataFrame({"value": ["</rdf:RDF>"]})

    about = F.concat(F.lit('<rdf:Description rdf:about="'), _escaped(F.col("s")), F.lit('">'))
    link = F.concat(F.lit("<"), F.col("p"), F.lit(' rdf:resource="'), _escaped(F.col("o")), F.lit('"/>'))
    attrs = F.concat(
        F.coalesce(F.concat(F.lit(' xml:lang="'), F.col("o_lang"), F.lit('"')), F.lit("")),
        F.coalesce(F.concat(F.lit(' rdf:datatype="'), F.col("o_dtype"), F.lit('"')), F.lit("")),
    )
    text = F.concat(
        F.lit("<"), F.col("p"), attrs, F.lit(">"), _escaped(F.col("o")), F.lit("</"), F.col("p"), F.lit(">")
    )
    body = F.when(F.col("o_kind") == "iri", link).otherwise(text)
    lines = triples.select(F.concat(about, body, F.lit("</rdf:Description>")).alias("value"))
    lines.mapInPandas(wrapped, "value string").write.mode("overwrite").text(path)
    return path


# What the line format does not allow as it is, in literals and in IRIs.
LITERAL_ESCAPES = {"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t"}
IRI_FORBIDDEN = '\\<>"{}|^` \n\r\t'


def _replaced(c: Column, escapes: dict[str, str]) -> Column:
    for raw, shown in escapes.items():
        c = F.replace(c, F.lit(raw), F.lit(shown))
    return c


def _iri(c: str) -> Column:
    escapes = {x: f"\\u{ord(x):04X}" for x in IRI_FORBIDDEN}
    return F.concat(F.lit("<"), _replaced(F.col(c), escapes), F.lit(">"))


def ntriple_line() -> Column:
    """One line per triple; line breaks, quotes and forbidden characters are escaped."""
    literal = F.concat(
        F.lit('"'), _replaced(F.col("o"), LITERAL_ESCAPES), F.lit('"'),
        F.when(F.col("o_lang").isNotNull(), F.concat(F.lit("@"), F.col("o_lang")))
        .when(F.col("o_dtype").isNotNull(), F.concat(F.lit("^^"), _iri("o_dtype"))).otherwise(""),
    )
    return F.concat_ws(" ", _iri("s"), _iri("p"), F.when(F.col("o_kind") == "iri", _iri("o")).otherwise(literal), F.lit("."))


def write_ntriples(triples: DataFrame, path: str) -> str:
    triples.select(ntriple_line().alias("value")).write.mode("overwrite").text(path)
    return path
