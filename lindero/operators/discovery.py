"""Links of archived pages that may be listings."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pages, urls
from ..functions.dom import markdown
from ..functions.portals import GALLERY_KEYS, base_excluded, passes_rules
from ..functions.text import filled, let


def links_of(snapshots: DataFrame, html: str = "html", markdown: str | None = "markdown") -> DataFrame:
    """(…, place, link): links of the HTML in order, then those of the Markdown."""
    found = pages.html_links(F.col(html))
    if markdown:
        found = F.concat(found, pages.markdown_links(F.col(markdown)))
    return snapshots.select("*", F.posexplode(F.transform(found, F.trim)).alias("place", "link")).filter("link <> ''")


def discovered(snapshots: DataFrame, seq: str = "seq", distinct_in: str | None = None) -> DataFrame:
    """Candidate URLs of ``snapshots`` (seq, base_url, html, markdown, parser_key, allowed_domain): web links made
    absolute, without gallery keys, on the domain, outside of the excluded ones, inside the parser's rules.

    Each URL once per snapshot, or once per ``distinct_in`` (a run), where it came first. Pages known to be listings'
    own pages are skipped if there is a page_kind.
    """
    read = snapshots.filter("page_kind is null or page_kind <> 'detail'") if "page_kind" in snapshots.columns else snapshots

    def taken_up(url):
        return F.when(urls.on_domain(url, F.col("allowed_domain")) & ~base_excluded(url) & passes_rules(url, F.col("parser_key")), url)

    def of_web(full):
        return F.when(urls.is_web(full), let(urls.without_query_keys(full, GALLERY_KEYS), taken_up))

    # One expression that is null for what is passed over: tests of a column would each resolve the link again.
    each = links_of(read).withColumn("url", let(urls.absolute(F.col("base_url"), F.col("link")), of_web)).filter("url is not null")
    by = [distinct_in or seq, "url"]
    return each.groupBy(*by).agg(F.min(F.struct(seq, "place")).alias("_at"), F.min_by("parser_key", F.struct(seq, "place")).alias("parser_key")).select(*by[:1], "url", *([] if by[0] == seq else [F.col(f"_at.{seq}").alias(seq)]), F.col("_at.place").alias("place"), "parser_key")


def with_markdown(pages: DataFrame) -> DataFrame:
    """``pages`` with ``markdown`` made of ``html`` where it is null or empty and there is HTML; a page that can't be read
    stays without."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for html, own in zip(batch.column("html").to_pylist(), batch.column("markdown").to_pylist(), strict=True):
                try:
                    made.append(own or (markdown(html) if html else own))
                except Exception:  # one page's fault stays with it
                    made.append(own)
            at = batch.schema.get_field_index("markdown")
            yield batch.set_column(at, "markdown", pa.array(made, pa.string()))

    return pages.mapInArrow(run, pages.schema)


def snapshot_keys(df: DataFrame, url: str = "url", text: str = "markdown", html: str = "html") -> DataFrame:
    """``df`` with snapshot_id, domain and content hashes (the preferred one is that of the Markdown if there is one)."""
    md, ht = F.sha2(F.col(text), 256), F.sha2(F.col(html), 256)
    return df.select("*", F.substring(F.sha2(F.trim(url), 256), 1, 16).alias("snapshot_id"), urls.domain_name(F.col(url)).alias("domain"), md.alias("markdown_hash"), ht.alias("html_hash"), F.coalesce(F.when(filled(F.col(text)).isNotNull(), md), ht).alias("content_hash_preferred"))


def slug(url, hint=None):
    """The hint or the last segment of the path, in lower case with hyphens; else the snapshot's id."""
    last = F.element_at(F.split(F.regexp_replace(urls.path(url), "/+$", ""), "/"), -1)
    text = F.coalesce(filled(hint), last) if hint is not None else last
    made = F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.coalesce(filled(made), F.substring(F.sha2(F.trim(url), 256), 1, 16))


def indexed(archived):
    """What the index of snapshots takes up: pages that were read at least in part, without their texts."""
    return archived.filter(F.col("status").isin("ok", "partial")).drop("html", "markdown")


def archive_status(has_html, has_markdown):
    return F.when(has_html & has_markdown, F.lit("ok")).when(has_html | has_markdown, F.lit("partial")).otherwise(F.lit("error"))
