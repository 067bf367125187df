"""Explicit schemas of the tables and streams; nothing is inferred."""

from pyspark.sql import types as T

URLS = T.StructType([T.StructField("url", T.StringType())])

URL_FEED = T.StructType(
    [T.StructField("url", T.StringType()), T.StructField("date", T.TimestampType())]
)

SIZE_LOG = T.StructType(
    [T.StructField("url", T.StringType()), T.StructField("size", T.IntegerType())]
)

CRAWLED = T.StructType(URL_FEED.fields + [T.StructField("html", T.StringType())])

FETCH_LOG = T.StructType(
    URL_FEED.fields
    + [
        T.StructField("attempt", T.IntegerType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("moved_to", T.StringType()),
        T.StructField("fetched_url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

FRONTIER = T.StructType(
    URL_FEED.fields
    + [T.StructField("origin", T.StringType()), T.StructField("attempt", T.IntegerType())]
)

EXTRACTED = T.StructType(URL_FEED.fields + [T.StructField("text", T.StringType())])

ARTICLE_TOKENS = T.StructType(
    EXTRACTED.fields + [T.StructField("tokens", T.ArrayType(T.StringType()))]
)

RULES = T.StructType(
    [
        T.StructField("alpha", T.StringType()),
        T.StructField("beta", T.StringType()),
        T.StructField("support", T.LongType()),
    ]
)

ROBOTS_TXT = T.StructType(
    [T.StructField("host", T.StringType()), T.StructField("body", T.StringType())]
)

ROBOTS_RULES = T.StructType(
    [
        T.StructField("host", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("prefix", T.StringType()),
    ]
)

PAGES = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)
