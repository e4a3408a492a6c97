"""Stored web-search responses -> typed rows.

The reference calls a search API and passes its JSON through: ``raw`` gives
every response whole, unknown fields included.  The other functions read the
known fields of stored responses (``query_id, body``) with a fixed schema and
explode the nested arrays with their positions.  A body that does not
parse gives ``status = 'bad_response'`` instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegraph.operators.attributes import parsed

SEARCH_SCHEMA = (
    "searchParameters STRUCT<q: STRING, engine: STRING, type: STRING>, credits INT, "
    "knowledgeGraph STRUCT<title: STRING, type: STRING>, "
    "organic ARRAY<STRUCT<position: INT, title: STRING, link: STRING, snippet: STRING, date: STRING, "
    "rating: DOUBLE, ratingCount: INT, sitelinks: ARRAY<STRUCT<title: STRING, link: STRING>>>>, "
    "peopleAlsoAsk ARRAY<STRUCT<question: STRING, snippet: STRING, link: STRING, title: STRING>>, "
    "images ARRAY<STRUCT<imageUrl: STRING, link: STRING, title: STRING>>")


def parse_responses(responses: DataFrame, *keep: str) -> DataFrame:
    """``query_id, query, status, r`` (and ``keep``) where ``r`` is the parsed struct."""
    r = F.from_json(F.col("body"), SEARCH_SCHEMA, {"mode": "PERMISSIVE"})
    df = responses.select("query_id", *keep, r.alias("r"))
    ok = F.col("r").isNotNull() & F.col("r.searchParameters").isNotNull()
    return df.select("query_id", *keep, F.col("r.searchParameters.q").alias("query"),
                     F.when(ok, "ok").otherwise("bad_response").alias("status"), "r")


def raw(responses: DataFrame) -> DataFrame:
    """``query_id, query, status, body``: the body as it came where it is a response, else null."""
    p = parse_responses(responses.withColumn("_body", F.col("body")), "_body")
    return p.select("query_id", "query", "status", F.when(F.col("status") == "ok", F.col("_body")).alias("body"))


def organic(responses: DataFrame) -> DataFrame:
    p = parse_responses(responses)
    return p.select("query_id", "query", F.posexplode("r.organic").alias("idx", "o")).select(
        "query_id", "query", F.col("idx").cast("bigint").alias("idx"),
        F.col("o.position").alias("position"), F.col("o.title").alias("title"),
        F.col("o.link").alias("link"), F.col("o.snippet").alias("snippet"),
        F.col("o.rating").alias("rating"), F.col("o.ratingCount").alias("rating_count"))


def sitelinks(responses: DataFrame) -> DataFrame:
    p = parse_responses(responses)
    o = p.select("query_id", F.posexplode("r.organic").alias("idx", "o"))
    return o.select("query_id", F.col("idx").cast("bigint").alias("idx"),
                    F.posexplode("o.sitelinks").alias("sidx", "s")).select(
        "query_id", "idx", F.col("sidx").cast("bigint").alias("sidx"),
        F.col("s.title").alias("title"), F.col("s.link").alias("link"))


def people_also_ask(responses: DataFrame) -> DataFrame:
    p = parse_responses(responses)
    return p.select("query_id", F.posexplode("r.peopleAlsoAsk").alias("idx", "a")).select(
        "query_id", F.col("idx").cast("bigint").alias("idx"), F.col("a.question").alias("question"),
        F.col("a.snippet").alias("snippet"), F.col("a.link").alias("link"), F.col("a.title").alias("title"))


def images(responses: DataFrame) -> DataFrame:
    p = parse_responses(responses)
    return p.select("query_id", F.posexplode("r.images").alias("idx", "i")).select(
        "query_id", F.col("idx").cast("bigint").alias("idx"), F.col("i.imageUrl").alias("image_url"),
        F.col("i.link").alias("link"), F.col("i.title").alias("title"))


def search_summary(responses: DataFrame) -> DataFrame:
    """Response attributes: the query (filled, unlike the reference), credits,
    knowledge-graph title and result counts."""
    p = parse_responses(responses)
    return p.select("query_id", "query", "status", F.col("r.credits").alias("credits"),
                    F.col("r.knowledgeGraph.title").alias("kg_title"),
                    F.col("r.knowledgeGraph.type").alias("kg_type"),
                    F.size(F.coalesce("r.organic", F.array())).cast("bigint").alias("n_organic"),
                    F.size(F.coalesce("r.peopleAlsoAsk", F.array())).cast("bigint").alias("n_paa"))


def with_attributes(responses: DataFrame) -> DataFrame:
    """``query_id, status, attributes``: the open map of a result's attributes (VARIANT), every field of the response and
    ``query``, the text that was searched for; null where the body is no response."""
    p = parse_responses(responses.withColumn("_body", F.col("body")), "_body")
    whole = parsed(F.col("_body"))
    own = F.variant_get(whole, "$", "map<string, variant>")
    named = F.map_from_arrays(F.array(F.lit("query")), F.array(F.variant_get(whole, "$.searchParameters.q", "variant")))
    all_of = F.map_concat(F.map_filter(own, lambda k, _: k != "query"), named)
    return p.select("query_id", "status", F.when(F.col("status") == "ok", F.to_variant_object(all_of)).alias("attributes"))
