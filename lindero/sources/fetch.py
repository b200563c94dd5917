"""Reading pages over connections that the caller opens; nothing here opens one by itself.

:func:`polite` is the stage of a plan: pages of one site go through one task, whose requests to it keep their distance;
:func:`fetched` reads one page with its retries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Protocol
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls as u

#: A connection: (status, body) of a URL read as a browser with that name; it may raise.
Opener = Callable[[str, str], tuple[int, str]]
# Statuses and growth of waiting times (fixed values).
BODY_ANYWAY, BUSY, FIRST_WAIT, BUSY_GROWTH, GROWTH = (403, 406), (429, 503), 0.9, 1.8, 1.6
SWAPPED_HOST = "milanuncios.com"


def swapped(url: str) -> str:
    """The same page on the portal's other host."""
    return url.replace("://www.", "://es.") if "://www." in url else url.replace("://es.", "://www.")


def fetched(url: str, opener: Opener, agents: Sequence[str], sleep: Callable[[float], None], jitter: Callable[[], float], retries: int = 3, diagnosed: Callable[[str], None] | None = None) -> str | None:
    """The page's body, or none after ``retries`` further attempts.

    A body with a status from 200 to 399 is taken, also one with 403 or 406 (which ``diagnosed`` gets to see). Too many
    requests and a busy server make the wait grow faster than other failures; a first 404 of the portal that has two
    hosts is asked of the other one. Agents take turns.
    """
    at, wait = url, FIRST_WAIT
    for attempt in range(retries + 1):
        try:
            status, body = opener(at, agents[attempt % len(agents)])
        except Exception:  # a connection that fails is an attempt like any other
            status, body = 0, ""
        if body and (200 <= status < 400 or status in BODY_ANYWAY):
            if status in BODY_ANYWAY and diagnosed:
                diagnosed(body)
            return body
        if status == 404 and attempt == 0 and SWAPPED_HOST in at:
            at = swapped(at)
            continue
        if attempt < retries or status in BUSY:
            sleep(wait + jitter())
            wait *= BUSY_GROWTH if status in BUSY else GROWTH
    return None


class Connection(Protocol):
    """What a task reads pages with: one session, its clock, its pauses."""

    def get(self, url: str, headers: dict[str, str]) -> tuple[int, str]:
        """(status, body); it may raise."""

    def now(self) -> float: ...

    def sleep(self, seconds: float) -> None: ...


#: Hosts of one site by their first label (fixed values): they share their site's distance.
SITE_LABELS = ("www", "es", "m")
#: What a browser without a name of its own says.
AGENTS = ("Mozilla/5.0",)
_OUT = "url string, html string, markdown string, fetch_status string, http_status int, attempts int, fetch_error string"


def site_of(host: str) -> str:
    first, dot, rest = host.partition(".")
    return rest if dot and first in SITE_LABELS and "." in rest else host


class _Session:
    """A task's session: when each site may be asked again, and which page of it was looked at first."""

    def __init__(self, connection: Connection, agents: Sequence[str], retries: int, jitter: Callable[[], float]) -> None:
        self.connection, self.agents, self.retries, self.jitter = connection, agents, retries, jitter
        self.free: dict[str, float] = {}
        self.warm: dict[str, str] = {}

    def ask(self, url: str, agent: str, referer: str | None, gap: float) -> tuple[int, str]:
        site = site_of((urlsplit(url).hostname or "").lower())
        wait = self.free.get(site, 0.0) - self.connection.now()
        if wait > 0:
            self.connection.sleep(wait)
        self.free[site] = self.connection.now() + gap
        return self.connection.get(url, {"User-Agent": agent} | ({"Referer": referer} if referer else {}))

    def page(self, url: str, referer: str | None, gap: float) -> tuple[str | None, int, int, str | None]:
        """(body, last status, requests, fault)."""
        tried: list[tuple[int, str | None]] = []

        def opened(at: str, agent: str) -> tuple[int, str]:
            try:
                status, body = self.ask(at, agent, referer, gap)
            except Exception as e:
                tried.append((0, f"{type(e).__name__}: {str(e)[:200]}"))
                raise
            tried.append((status, None))
            return status, body

        site = site_of((urlsplit(url).hostname or "").lower())
        if referer and self.warm.get(site) != referer:
            self.warm[site] = referer
            try:
                self.ask(referer, self.agents[0], None, gap)
            except Exception:  # the page itself may be there all the same
                pass
        body = fetched(url, opened, self.agents, self.connection.sleep, self.jitter, self.retries)
        status, fault = tried[-1]
        return body, status, len(tried), None if body is not None else fault or f"status {status}"


def _no_jitter() -> float:
    return 0.0


def polite(connect: Callable[[], Connection], gap: float = 1.0, agents: Sequence[str] = AGENTS, retries: int = 3, jitter: Callable[[], float] = _no_jitter, tasks: int | None = None) -> Callable[[DataFrame], DataFrame]:
    """A fetcher for :mod:`lindero.plans.pipeline`: (url, …) to (url, html, markdown, fetch_status, http_status, attempts,
    fetch_error), a row for every row, ``fetch_status`` being ok or failed.

    ``connect`` opens a task's connection, on the executor. All pages of a site go through one task, which takes the sites in
    turns and asks each at most once in ``gap`` seconds, or in those of the rows' column ``gap``; retries and first looks
    count, too. With a column ``referer`` that page is looked at before the first of its pages and is told as where the request
    comes from. A url that is null or no web address fails without a request. Rows stream through; a task holds a number
    and a page's address a site. A task that is run again asks again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        session: _Session | None = None
        for batch in batches:
            for url, referer, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not url or urlsplit(url).scheme.lower() not in ("http", "https"):
                    found = (None, 0, 0, "no web address")
                else:
                    session = session or _Session(connect(), agents, retries, jitter)
                    found = session.page(url, referer, gap if own is None else own)
                body, status, attempts, fault = found
                row = [url, body, None, "failed" if body is None else "ok", status, attempts, fault]
                kinds = [pa.string()] * 4 + [pa.int32()] * 2 + [pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=[c.split()[0] for c in _OUT.split(", ")])

    def fetch(urls: DataFrame) -> DataFrame:
        site = F.regexp_replace(u.host(F.col("url")), rf"^(?:{'|'.join(SITE_LABELS)})\.(?=[^.]+\.)", "")
        order = [c for c in ("seq", "url") if c in urls.columns]
        more = [(F.col(c) if c in urls.columns else F.lit(None)).cast(k).alias(c) for c, k in (("referer", "string"), ("gap", "double"))]
        rows = urls.select("url", *more, F.coalesce(site, F.lit("")).alias("site"), *[F.col(c).alias(f"_{c}") for c in order])
        turns = rows.withColumn("turn", F.row_number().over(Window.partitionBy("site").orderBy(*[f"_{c}" for c in order])))
        dealt = turns.repartition(tasks or int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions")), "site").sortWithinPartitions("turn", "site")
        return dealt.select("url", "referer", "gap").mapInArrow(run, _OUT)

    return fetch
