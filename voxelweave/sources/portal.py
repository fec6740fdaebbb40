"""Listings of a data portal: web pages that stand for the members of series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import names, scalars

PAGES = "page_id bigint, url string, html string"
ENTRY = "page_id bigint, collection string, position string, seq int, dataset_name string, series string, file_name string, title string, length bigint, size string, url string"


def entries(pages: DataFrame) -> DataFrame:
    """The catalog entry of each page (page_id, url, html).

    The host is the collection, the first folder of the path the position, and the number that the last
    part of the path starts with is the sequence number; a page whose url has no such parts has nulls there. Length
    is that of the page in bytes, title what its first title element holds.
    """
    rest = F.regexp_extract(F.coalesce("url", F.lit("")), "(?s)://(.*)$", 1)
    host = F.lower(F.regexp_extract(rest, "^([^/?#]*)", 1))
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    file, folder = F.try_element_at("parts", F.lit(-1)), F.try_element_at("parts", F.lit(1))
    seq = F.regexp_extract(file, r"^([0-9]+)(\.[a-z]+)?$", 1).try_cast("int")
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", F.nullif(host, F.lit("")).alias("collection"), parts.alias("parts"), html.alias("html"))
    rows = rows.withColumns({"fits": F.col("collection").isNotNull() & (F.size("parts") == 2) & seq.isNotNull(), "seq": seq})
    rows = rows.withColumns({c: F.when(F.col("fits"), v) for c, v in (("position", folder), ("file_name", file), ("seq", F.col("seq")))})
    dataset = F.when(F.col("fits"), F.format_string("%s_%s_%04d", "collection", "position", "seq"))
    length = F.octet_length("html").cast("bigint")
    title = F.regexp_extract("html", "(?is)<title>(.*?)</title>", 1)
    return rows.select(
        "page_id", "collection", "position", "seq", dataset.alias("dataset_name"), names.series_name(dataset).alias("series"), "file_name",
        F.when(title != "", title).alias("title"), length.alias("length"), scalars.readable_bytes(length).alias("size"), "url",
    )
