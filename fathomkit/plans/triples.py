"""Graph jobs over triples made from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomkit.operators import triples as t
from fathomkit.plans.inputs import table
from fathomkit.plans.registry import query
from fathomkit.session import fresh_path
from fathomkit.sources import rdf

XSD_INT = "xsd:nonNegativeInteger"

# Suppliers are teams, parts stadiums, nations countries, regions leagues, customers players.
CLUBS = """
clubs AS (
  SELECT 'team/' || s_suppkey AS s, 'rdf:type' AS p, 'Team' AS o, NULL AS o_lang FROM supplier
  UNION ALL SELECT 'team/' || s_suppkey, 'hasName', s_name, 'en' FROM supplier
  UNION ALL SELECT 'team/' || s_suppkey, 'hasName', 'Equipe ' || s_suppkey, 'fr' FROM supplier WHERE s_suppkey % 2 = 0
  UNION ALL SELECT 'team/' || s_suppkey, 'foundedYear', CAST(1850 + s_suppkey % 160 AS VARCHAR), NULL FROM supplier
  UNION ALL SELECT 'team/' || s_suppkey, 'competesin', 'league/' || n_regionkey, NULL
            FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT 'team/' || s_suppkey, 'basedIn', 'country/' || s_nationkey, NULL FROM supplier WHERE s_suppkey % 4 <> 0
  UNION ALL SELECT 'team/' || s_suppkey, 'hasStadium', 'stadium/' || s_suppkey, NULL FROM supplier WHERE s_suppkey % 7 <> 3
  UNION ALL SELECT 'team/' || s_suppkey, 'hasStadium', 'stadium/' || (s_suppkey + 1), NULL FROM supplier WHERE s_suppkey % 10 = 0
  UNION ALL SELECT 'stadium/' || p_partkey, 'rdf:type', 'Stadium', NULL FROM part
  UNION ALL SELECT 'stadium/' || p_partkey, 'hasName', p_name || ' ' || p_partkey, 'en' FROM part WHERE p_partkey % 11 <> 5
  UNION ALL SELECT 'stadium/' || p_partkey, 'stadiumCapacity', CAST(p_size * 2000 AS VARCHAR), NULL FROM part WHERE p_partkey % 6 <> 1
  UNION ALL SELECT 'country/' || n_nationkey, 'rdf:type', 'Country', NULL FROM nation
  UNION ALL SELECT 'country/' || n_nationkey, 'hasName', n_name, 'en' FROM nation
  UNION ALL SELECT 'country/' || n_nationkey, 'locatedIn', 'region/' || n_regionkey, NULL FROM nation
  UNION ALL SELECT 'region/' || r_regionkey, 'locatedIn', 'world', NULL FROM region
  UNION ALL SELECT 'league/' || r_regionkey, 'rdf:type', 'League', NULL FROM region
  UNION ALL SELECT 'league/' || r_regionkey, 'hasName', r_name, 'en' FROM region)"""

PEOPLE = """
people AS (
  SELECT 'player/' || c_custkey AS s, 'rdf:type' AS p, 'Player' AS o, NULL AS o_lang FROM customer
  UNION ALL SELECT 'player/' || c_custkey, 'hasName', c_name, 'en' FROM customer
  UNION ALL SELECT 'player/' || c_custkey, 'hasAge', CAST(16 + c_custkey % 25 AS VARCHAR), NULL FROM customer
  UNION ALL SELECT 'player/' || c_custkey, 'playsFor', 'team/' || (c_custkey % (SELECT count(*) FROM supplier)), NULL
            FROM customer WHERE c_custkey % 9 <> 0
  UNION ALL SELECT 'player/' || c_custkey, 'playsFor', 'player/' || c_custkey, NULL FROM customer WHERE c_custkey % 97 = 0
  UNION ALL SELECT 'player/' || c_custkey, 'hasNationality', 'country/' || c_nationkey, NULL FROM customer WHERE c_custkey % 5 <> 0
  UNION ALL SELECT 'player/' || c_custkey, 'locatedIn', 'country/' || c_nationkey, NULL FROM customer
  UNION ALL SELECT 'player/' || c_custkey, 'hasMarketValue', CAST(CAST(round(c_acctbal * 10000) AS BIGINT) AS VARCHAR), NULL
            FROM customer WHERE c_custkey % 8 <> 0
  UNION ALL SELECT 'country/' || n_nationkey, 'rdf:type', 'Country', NULL FROM nation
  UNION ALL SELECT 'country/' || n_nationkey, 'hasName', n_name, 'en' FROM nation)"""

GRAPH = CLUBS + "," + PEOPLE + ", g AS (SELECT * FROM clubs UNION SELECT * FROM people)"


def iri(kind, key):
    return F.concat(F.lit(f"{kind}/"), key.cast("string") if hasattr(key, "cast") else F.col(key).cast("string"))


def _stacked(df, entries):
    """(s, p, o, lang, dtype, condition) entries of every row as triples, one scan."""
    structs = [
        F.struct(
            s.alias("s"), F.lit(p).alias("p"), F.when(when, o.cast("string")).alias("o"),
            F.lit("iri" if dtype == "iri" else "literal").alias("o_kind"),
            F.lit(lang).cast("string").alias("o_lang"),
            F.lit(None if dtype == "iri" else dtype).cast("string").alias("o_dtype"),
        )
        for s, p, o, lang, dtype, when in entries
    ]
    return df.select(F.explode(F.array(*structs)).alias("t")).select("t.*").filter("o IS NOT NULL")


def clubs(spark, sf_dir):
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    sup = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    k, always = F.col("s_suppkey"), F.lit(True)
    team, pk = iri("team", k), F.col("p_partkey")
    ground, land = iri("stadium", pk), iri("country", F.col("n_nationkey"))
    r = F.col("r_regionkey")
    return (
        _stacked(sup, [
            (team, t.TYPE, F.lit("Team"), None, "iri", always),
            (team, "hasName", F.col("s_name"), "en", None, always),
            (team, "hasName", F.concat(F.lit("Equipe "), k.cast("string")), "fr", None, k % 2 == 0),
            (team, "foundedYear", k % 160 + 1850, None, XSD_INT, always),
            (team, "competesin", iri("league", F.col("n_regionkey")), None, "iri", always),
            (team, "basedIn", iri("country", F.col("s_nationkey")), None, "iri", k % 4 != 0),
            (team, "hasStadium", iri("stadium", k), None, "iri", k % 7 != 3),
            (team, "hasStadium", iri("stadium", k + 1), None, "iri", k % 10 == 0),
        ])
        .union(_stacked(table(spark, sf_dir, "part"), [
            (ground, t.TYPE, F.lit("Stadium"), None, "iri", always),
            (ground, "hasName", F.concat_ws(" ", "p_name", pk.cast("string")), "en", None, pk % 11 != 5),
            (ground, "stadiumCapacity", F.col("p_size") * 2000, None, XSD_INT, pk % 6 != 1),
        ]))
        .union(_stacked(nation, [
            (land, t.TYPE, F.lit("Country"), None, "iri", always),
            (land, "hasName", F.col("n_name"), "en", None, always),
            (land, "locatedIn", iri("region", F.col("n_regionkey")), None, "iri", always),
        ]))
        .union(_stacked(region, [
            (iri("region", r), "locatedIn", F.lit("world"), None, "iri", always),
            (iri("league", r), t.TYPE, F.lit("League"), None, "iri", always),
            (iri("league", r), "hasName", F.col("r_name"), "en", None, always),
        ]))
    )


def people(spark, sf_dir):
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    teams = table(spark, sf_dir, "supplier").agg(F.count("*")).scalar()
    c, always = F.col("c_custkey"), F.lit(True)
    who, land = iri("player", c), iri("country", F.col("c_nationkey"))
    home = iri("country", F.col("n_nationkey"))
    return _stacked(customer.withColumn("_team", c % teams), [
        (who, t.TYPE, F.lit("Player"), None, "iri", always),
        (who, "hasName", F.col("c_name"), "en", None, always),
        (who, "hasAge", c % 25 + 16, None, XSD_INT, always),
        (who, "playsFor", iri("team", F.col("_team")), None, "iri", c % 9 != 0),
        (who, "playsFor", who, None, "iri", c % 97 == 0),
        (who, "hasNationality", land, None, "iri", c % 5 != 0),
        (who, "locatedIn", land, None, "iri", always),
        (who, "hasMarketValue", F.round(F.col("c_acctbal") * 10000).cast("bigint"), None, XSD_INT, c % 8 != 0),
    ]).union(_stacked(nation, [
        (home, t.TYPE, F.lit("Country"), None, "iri", always),
        (home, "hasName", F.col("n_name"), "en", None, always),
    ]))


def graph(spark, sf_dir):
    return t.store(t.merge(clubs(spark, sf_dir), people(spark, sf_dir)))


# --- sources and sinks -------------------------------------------------------------------
@query("a07_rdf_xml_load", f"WITH {CLUBS} SELECT DISTINCT s, p, o, o_lang FROM clubs")
def a07(spark, sf_dir):
    made = clubs(spark, sf_dir).withColumn(
        "p", F.when(F.col("p").contains(":"), F.col("p")).otherwise(F.concat(F.lit("fb:"), "p"))
    )
    path = rdf.write_rdf_xml(made, fresh_path(spark, "clubs-rdf"), {"fb": "http://example.org/clubs#"})
    names = ["hasName", "foundedYear", "competesin", "basedIn", "hasStadium", "stadiumCapacity", "locatedIn"]
    loaded = rdf.read_rdf_xml(spark, path, ["rdf:type", *[f"fb:{n}" for n in names]])
    return loaded.select("s", F.regexp_replace("p", "^fb:", "").alias("p"), "o", "o_lang")


@query("a08_triples_write", f"""WITH {GRAPH} SELECT '<' || s || '> <' || p || '> ' ||
  CASE WHEN p IN ('rdf:type', 'competesin', 'basedIn', 'hasStadium', 'locatedIn', 'playsFor', 'hasNationality')
       THEN '<' || o || '>' WHEN o_lang IS NOT NULL THEN '"' || o || '"@' || o_lang
       ELSE '"' || o || '"^^<xsd:nonNegativeInteger>' END || ' .' AS line FROM g""")
def a08(spark, sf_dir):
    merged = t.merge(clubs(spark, sf_dir), people(spark, sf_dir))
    path = rdf.write_ntriples(merged, fresh_path(spark, "graph-nt"))
    return spark.read.text(path).select(F.col("value").alias("line"))


# --- pattern joins -----------------------------------------------------------------------
@query("c03_basic_pattern", f"""WITH {GRAPH}
SELECT DISTINCT a.s AS team, b.o AS team_name, d.o AS stadium_name FROM g a JOIN g b ON a.s = b.s AND b.p = 'hasName'
JOIN g c ON a.s = c.s AND c.p = 'hasStadium' JOIN g d ON c.o = d.s AND d.p = 'hasName'
WHERE a.p = 'rdf:type' AND a.o = 'Team'""")
def c03(spark, sf_dir):
    g = graph(spark, sf_dir)
    return t.conjoin(
        t.instances(g, "Team", "team"), t.facts(g, "hasName", "team", "team_name"),
        t.facts(g, "hasStadium", "team", "stadium"), t.facts(g, "hasName", "stadium", "stadium_name"),
    ).select("team", "team_name", "stadium_name").distinct()


@query("c04_optional_group", f"""WITH {GRAPH}, pt AS (
SELECT a.s AS player, b.o AS team_name FROM g a JOIN g b ON a.o = b.s AND b.p = 'hasName' WHERE a.p = 'playsFor')
SELECT a.s AS player, pt.team_name FROM g a LEFT JOIN pt ON a.s = pt.player WHERE a.p = 'rdf:type' AND a.o = 'Player'""")
def c04(spark, sf_dir):
    g = graph(spark, sf_dir)
    group = t.conjoin(t.facts(g, "playsFor", "player", "team"), t.facts(g, "hasName", "team", "team_name"))
    return t.optional(t.instances(g, "Player", "player"), group).select("player", "team_name")


@query("c05_nested_optional", f"""WITH {GRAPH}, st AS (
SELECT a.s AS team, b.o AS stadium_name, c.o AS capacity FROM g a JOIN g b ON a.o = b.s AND b.p = 'hasName'
LEFT JOIN g c ON a.o = c.s AND c.p = 'stadiumCapacity' WHERE a.p = 'hasStadium')
SELECT a.s AS team, st.stadium_name, st.capacity FROM g a LEFT JOIN st ON a.s = st.team
WHERE a.p = 'rdf:type' AND a.o = 'Team'""")
def c05(spark, sf_dir):
    return _team_grounds(graph(spark, sf_dir)).select("team", "stadium_name", "capacity")


def _team_grounds(g):
    grounds = t.optional(
        t.conjoin(t.facts(g, "hasStadium", "team", "stadium"), t.facts(g, "hasName", "stadium", "stadium_name")),
        t.facts(g, "stadiumCapacity", "stadium", "capacity"),
    )
    return t.optional(t.instances(g, "Team", "team"), grounds)


@query("c06_optional_open_variable", f"""WITH {GRAPH}, l AS (
SELECT a.s AS team, b.o AS country FROM g a LEFT JOIN g b ON a.s = b.s AND b.p = 'basedIn'
WHERE a.p = 'rdf:type' AND a.o = 'Team'),
r AS (SELECT a.o AS team, a.s AS player, b.o AS country FROM g a JOIN g b ON a.s = b.s AND b.p = 'hasNationality'
      WHERE a.p = 'playsFor')
SELECT l.team, r.player, coalesce(l.country, r.country) AS country FROM l LEFT JOIN r
ON l.team = r.team AND (l.country IS NULL OR l.country = r.country)""")
def c06(spark, sf_dir):
    g = graph(spark, sf_dir)
    teams = t.optional(t.instances(g, "Team", "team"), t.facts(g, "basedIn", "team", "country"))
    players = t.conjoin(
        t.facts(g, "playsFor", "player", "team"), t.facts(g, "hasNationality", "player", "country")
    )
    return t.optional_open(teams, players, "country").select("team", "player", "country")


@query("h15_language_filter", f"""WITH {GRAPH} SELECT s, o FROM g WHERE p = 'hasName' AND o_lang = 'fr'""")
def h15(spark, sf_dir):
    return t.facts(graph(spark, sf_dir), "hasName", "s", "o", lang="fr")


@query("h16_typed_literal_compare", f"""WITH {GRAPH}
SELECT s, TRY_CAST(o AS BIGINT) AS age FROM g WHERE p = 'hasAge' AND TRY_CAST(o AS BIGINT) > 30""")
def h16(spark, sf_dir):
    return t.facts(graph(spark, sf_dir), "hasAge", "s", "o").select("s", t.number("o").alias("age")).filter(
        "age > 30"
    )


# --- queries -----------------------------------------------------------------------------
@query("m01_teams_and_stadiums", f"""WITH {GRAPH}, st AS (
SELECT a.s AS team, b.o AS stadium_name, c.o AS capacity FROM g a JOIN g b ON a.o = b.s AND b.p = 'hasName'
LEFT JOIN g c ON a.o = c.s AND c.p = 'stadiumCapacity' WHERE a.p = 'hasStadium')
SELECT DISTINCT n.o AS team_name, st.stadium_name, st.capacity FROM g a JOIN g n ON a.s = n.s AND n.p = 'hasName'
LEFT JOIN st ON a.s = st.team WHERE a.p = 'rdf:type' AND a.o = 'Team'""")
def m01(spark, sf_dir):
    g = graph(spark, sf_dir)
    return t.conjoin(_team_grounds(g), t.facts(g, "hasName", "team", "team_name")).select(
        "team_name", "stadium_name", "capacity"
    ).distinct().orderBy("team_name")


@query("m02_players_and_teams", f"""WITH {GRAPH}, pt AS (
SELECT a.s AS player, b.o AS team_name FROM g a JOIN g b ON a.o = b.s AND b.p = 'hasName' WHERE a.p = 'playsFor'),
pc AS (SELECT a.s AS player, b.o AS country_name FROM g a JOIN g b ON a.o = b.s AND b.p = 'hasName' WHERE a.p = 'hasNationality'),
q AS (SELECT DISTINCT n.o AS player_name, pt.team_name, pc.country_name FROM g a JOIN g n ON a.s = n.s AND n.p = 'hasName'
LEFT JOIN pt ON a.s = pt.player LEFT JOIN pc ON a.s = pc.player WHERE a.p = 'rdf:type' AND a.o = 'Player')
SELECT * FROM q ORDER BY team_name NULLS FIRST, player_name, country_name NULLS FIRST LIMIT 30""")
def m02(spark, sf_dir):
    g = graph(spark, sf_dir)
    players = t.conjoin(t.instances(g, "Player", "player"), t.facts(g, "hasName", "player", "player_name"))
    team = t.conjoin(t.facts(g, "playsFor", "player", "team"), t.facts(g, "hasName", "team", "team_name"))
    land = t.conjoin(
        t.facts(g, "hasNationality", "player", "country"), t.facts(g, "hasName", "country", "country_name")
    )
    return t.optional(t.optional(players, team), land).select(
        "player_name", "team_name", "country_name"
    ).distinct().orderBy("team_name", "player_name", "country_name").limit(30)


@query("m03_founded_before", f"""WITH {GRAPH}
SELECT DISTINCT n.o AS team_name, TRY_CAST(f.o AS BIGINT) AS founded FROM g a JOIN g n ON a.s = n.s AND n.p = 'hasName'
JOIN g f ON a.s = f.s AND f.p = 'foundedYear' WHERE a.p = 'rdf:type' AND a.o = 'Team' AND TRY_CAST(f.o AS BIGINT) < 1900""")
def m03(spark, sf_dir):
    g = graph(spark, sf_dir)
    return t.conjoin(
        t.instances(g, "Team", "team"), t.facts(g, "hasName", "team", "team_name"),
        t.facts(g, "foundedYear", "team", "f"),
    ).select("team_name", t.number("f").alias("founded")).filter("founded < 1900").distinct().orderBy("founded")


def valued_players(g, needles, above):
    """Players of matching countries worth more than ``above``, with their team if known."""
    name = F.lower("country_name")
    match = F.lit(False)
    for n in needles:
        match = match | F.contains(name, F.lit(n))
    worth = t.facts(g, "hasMarketValue", "player", "v").withColumn("market_value", t.number("v")).filter(
        F.col("market_value") > above
    ).drop("v")
    lands = t.facts(g, "hasName", "country", "country_name").filter(match)
    body = t.conjoin(
        t.instances(g, "Player", "player"), worth, t.facts(g, "hasNationality", "player", "country"), lands,
        t.facts(g, "hasName", "player", "player_name"),
    )
    team = t.conjoin(t.facts(g, "playsFor", "player", "team"), t.facts(g, "hasName", "team", "team_name"))
    return t.optional(body, team).select(
        "player_name", "team_name", "market_value", "country_name"
    ).distinct().orderBy(F.col("market_value").desc())


@query("m04_valued_players", f"""WITH {GRAPH}, pt AS (
SELECT a.s AS player, b.o AS team_name FROM g a JOIN g b ON a.o = b.s AND b.p = 'hasName' WHERE a.p = 'playsFor')
SELECT DISTINCT n.o AS player_name, pt.team_name, TRY_CAST(v.o AS BIGINT) AS market_value, cn.o AS country_name
FROM g a JOIN g n ON a.s = n.s AND n.p = 'hasName' JOIN g v ON a.s = v.s AND v.p = 'hasMarketValue'
JOIN g c ON a.s = c.s AND c.p = 'hasNationality' JOIN g cn ON c.o = cn.s AND cn.p = 'hasName'
LEFT JOIN pt ON a.s = pt.player WHERE a.p = 'rdf:type' AND a.o = 'Player' AND TRY_CAST(v.o AS BIGINT) > 50000000
AND (contains(lower(cn.o), 'nation_1') OR contains(lower(cn.o), 'nation_24'))""")
def m04(spark, sf_dir):
    return valued_players(graph(spark, sf_dir), ["nation_1", "nation_24"], 50_000_000)


def big_grounds(g, above, n):
    """Grounds above a capacity with the valued players of their team, largest first."""
    grounds = t.conjoin(
        t.instances(g, "Team", "team"), t.facts(g, "hasName", "team", "team_name"),
        t.facts(g, "hasStadium", "team", "stadium"), t.facts(g, "hasName", "stadium", "stadium_name"),
        t.facts(g, "stadiumCapacity", "stadium", "c").withColumn("capacity", t.number("c")).filter(
            F.col("capacity") > above
        ).drop("c"),
    )
    players = t.conjoin(
        t.facts(g, "playsFor", "player", "team"), t.facts(g, "hasName", "player", "player_name"),
        t.facts(g, "hasMarketValue", "player", "v"),
    ).select("team", "player_name", t.number("v").alias("market_value"))
    return t.optional(grounds, players).select(
        "team_name", "stadium_name", "capacity", "player_name", "market_value"
    ).distinct().orderBy(
        F.col("capacity").desc(), F.col("market_value").desc(), "team_name", "stadium_name", "player_name"
    ).limit(n)


_BIG = """pv AS (SELECT a.o AS team, n.o AS player_name, TRY_CAST(v.o AS BIGINT) AS market_value FROM g a
JOIN g n ON a.s = n.s AND n.p = 'hasName' JOIN g v ON a.s = v.s AND v.p = 'hasMarketValue' WHERE a.p = 'playsFor'),
q AS (SELECT DISTINCT n.o AS team_name, sn.o AS stadium_name, TRY_CAST(k.o AS BIGINT) AS capacity, pv.player_name, pv.market_value
FROM g a JOIN g n ON a.s = n.s AND n.p = 'hasName' JOIN g h ON a.s = h.s AND h.p = 'hasStadium'
JOIN g sn ON h.o = sn.s AND sn.p = 'hasName' JOIN g k ON h.o = k.s AND k.p = 'stadiumCapacity'
LEFT JOIN pv ON a.s = pv.team WHERE a.p = 'rdf:type' AND a.o = 'Team' AND TRY_CAST(k.o AS BIGINT) > 50000)
SELECT * FROM q ORDER BY capacity DESC, market_value DESC NULLS LAST, team_name, stadium_name, player_name LIMIT 20"""


@query("m05_big_stadiums", f"WITH {GRAPH}, {_BIG}")
def m05(spark, sf_dir):
    return big_grounds(graph(spark, sf_dir), 50_000, 20)


_SOLUTIONS = """
sol AS (SELECT a.s AS team, n.o AS name, h.o AS stadium, k.o AS capacity FROM g a JOIN g n ON a.s = n.s AND n.p = 'hasName'
AND n.o_lang = 'en' LEFT JOIN g h ON a.s = h.s AND h.p = 'hasStadium'
LEFT JOIN g k ON h.o = k.s AND k.p = 'stadiumCapacity' WHERE a.p = 'rdf:type' AND a.o = 'Team'),
cut AS (SELECT * FROM sol ORDER BY team, name, stadium NULLS FIRST, capacity NULLS FIRST LIMIT 200)"""


@query("m06_construct", f"""WITH {GRAPH}, {_SOLUTIONS}
SELECT team AS s, 'rdf:type' AS p, 'Team' AS o FROM cut UNION SELECT team, 'label', name FROM cut
UNION SELECT team, 'ground', stadium FROM cut WHERE stadium IS NOT NULL
UNION SELECT stadium, 'seats', capacity FROM cut WHERE stadium IS NOT NULL AND capacity IS NOT NULL""")
def m06(spark, sf_dir):
    g = graph(spark, sf_dir)
    solutions = t.optional(
        t.optional(
            t.conjoin(t.instances(g, "Team", "team"), t.facts(g, "hasName", "team", "name", lang="en")),
            t.facts(g, "hasStadium", "team", "stadium"),
        ),
        t.facts(g, "stadiumCapacity", "stadium", "capacity"),
    ).orderBy("team", "name", "stadium", "capacity").limit(200)
    return t.construct(solutions, [
        ("team", t.TYPE, F.lit("Team")), ("team", "label", "name"),
        ("team", "ground", "stadium"), ("stadium", "seats", "capacity"),
    ])


@query("m07_bind_constant", f"""WITH {GRAPH}
SELECT s AS team, 'league/0' AS league, 'First League' AS league_name FROM g WHERE p = 'competesin' AND o = 'league/0'""")
def m07(spark, sf_dir):
    return t.facts(graph(spark, sf_dir), "competesin", "team", "o").filter("o = 'league/0'").select(
        "team", F.lit("league/0").alias("league"), F.lit("First League").alias("league_name")
    )


@query("m08_participation_rule", f"""WITH {GRAPH}
SELECT DISTINCT a.s, 'participatesIn' AS p, c.o FROM g a JOIN g b ON a.s = b.s AND b.p = 'playsFor'
JOIN g c ON b.o = c.s AND c.p = 'competesin' WHERE a.p = 'rdf:type' AND a.o = 'Player'""")
def m08(spark, sf_dir):
    return t.participation_rule(graph(spark, sf_dir))


@query("m09_large_stadium_rule", f"""WITH {GRAPH}
SELECT DISTINCT a.s, 'largeStadium' AS p, b.o FROM g a JOIN g b ON a.s = b.s AND b.p = 'hasStadium'
JOIN g c ON b.o = c.s AND c.p = 'stadiumCapacity' WHERE a.p = 'rdf:type' AND a.o = 'Team' AND TRY_CAST(c.o AS BIGINT) > 60000""")
def m09(spark, sf_dir):
    return t.large_stadium_rule(graph(spark, sf_dir))


@query("m10_inverse_property", f"""WITH {GRAPH} SELECT DISTINCT o AS s, 'hasPlayer' AS p, s AS o FROM g WHERE p = 'playsFor'""")
def m10(spark, sf_dir):
    return t.inverse(graph(spark, sf_dir), "playsFor", "hasPlayer")


@query("m11_transitive_closure", f"""WITH RECURSIVE {GRAPH}, c AS (
SELECT s, o FROM g WHERE p = 'locatedIn' UNION SELECT c.s, g.o FROM c JOIN g ON c.o = g.s AND g.p = 'locatedIn')
SELECT s, 'locatedIn' AS p, o FROM c""")
def m11(spark, sf_dir):
    return t.closure(graph(spark, sf_dir), "locatedIn")


@query("m12_functional_violations", f"""WITH {GRAPH}
SELECT s, count(DISTINCT o) AS n_values FROM g WHERE p = 'hasStadium' GROUP BY 1 HAVING count(DISTINCT o) > 1""")
def m12(spark, sf_dir):
    return t.functional_violations(graph(spark, sf_dir), "hasStadium")


@query("m13_irreflexive_violations", f"WITH {GRAPH} SELECT DISTINCT s FROM g WHERE p = 'playsFor' AND s = o")
def m13(spark, sf_dir):
    return t.irreflexive_violations(graph(spark, sf_dir), "playsFor")


@query("m14_graph_counts", f"""WITH {GRAPH}
SELECT 'all' AS kind, 'triples' AS name, count(*) AS n FROM g UNION ALL
SELECT 'predicate', p, count(*) FROM g GROUP BY p UNION ALL
SELECT 'type', o, count(*) FROM g WHERE p = 'rdf:type' GROUP BY o""")
def m14(spark, sf_dir):
    return t.graph_counts(graph(spark, sf_dir))


@query("m15_fused_graphs", f"WITH {GRAPH}, {_BIG}")
def m15(spark, sf_dir):
    """The people come with IRIs of their own for the teams; names link the two sources."""
    other = people(spark, sf_dir).withColumn(
        "o", F.when(F.col("p") == "playsFor", F.regexp_replace("o", "^team/", "wd-team/")).otherwise(F.col("o"))
    )
    k = F.col("s_suppkey")
    aliases = _stacked(table(spark, sf_dir, "supplier"), [
        (iri("wd-team", k), t.TYPE, F.lit("Team"), None, "iri", F.lit(True)),
        (iri("wd-team", k), "hasName", F.col("s_name"), "en", None, F.lit(True)),
    ])
    fused = t.link_by_name(t.merge(clubs(spark, sf_dir), other, aliases), "Team")
    return big_grounds(t.store(fused), 50_000, 20)
