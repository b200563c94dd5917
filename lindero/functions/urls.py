"""URL expressions on the parts of RFC 3986, which any text has; nothing throws on odd characters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean, filled, let

PARTS = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, PARTS, group)


def scheme(url: Column) -> Column:
    return F.lower(_part(url, 1))


def host(url: Column) -> Column:
    return F.lower(_part(url, 2))


def path(url: Column) -> Column:
    return _part(url, 3)


def query(url: Column) -> Column:
    return _part(url, 4)


def joined(scheme: Column, host: Column, path: Column) -> Column:
    """A URL of its parts; an empty path is a slash."""
    return F.concat(F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit("")), F.when(host != "", F.concat(F.lit("//"), host)).otherwise(F.lit("")), F.when(path == "", F.lit("/")).otherwise(path))


def canonical(url: Column) -> Column:
    """Scheme and host in lower case, no slashes at the path's end, no query or fragment; empty for an empty URL."""

    def made(raw: Column) -> Column:
        return let(F.struct(scheme(raw).alias("s"), host(raw).alias("h"), F.regexp_replace(path(raw), "/+$", "").alias("p")), lambda x: joined(x["s"], x["h"], x["p"]))

    return let(clean(url), lambda raw: F.when(raw == "", F.lit("")).otherwise(made(raw)))


def unquoted(c: Column) -> Column:
    """A name or value of a query decoded: plus is a space, percent and two hexadecimal digits a byte of UTF-8 (what is
    none is replaced); a percent sign without them stands for itself."""
    return F.url_decode(F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25"))


def quoted(c: Column) -> Column:
    """A name or value as a query has it: letters, digits, ``_.-~`` as they are, a space as plus."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def query_pairs(text: Column, keep_blank: bool = False) -> Column:
    """array<struct<name, value>> of a query, decoded; pairs without a value go or, with ``keep_blank``, have an empty one."""
    parts = F.split(text, "&")
    parts = F.filter(parts, lambda p: p != "") if keep_blank else F.filter(parts, lambda p: p.rlike("(?s)^[^=]*=."))
    return F.transform(parts, lambda p: let(F.substring_index(p, "=", 1), lambda name: F.struct(unquoted(name).alias("name"), unquoted(F.substring(p, F.length(name) + 2, F.length(p))).alias("value"))))


def query_text(pairs: Column) -> Column:
    """The query of such pairs, encoded."""
    return F.array_join(F.transform(pairs, lambda p: F.concat(quoted(p["name"]), F.lit("="), quoted(p["value"]))), "&")


def _kept_pairs(text: Column, drop: Sequence[str]) -> Column:
    """The query without pairs that have no value or one of these names, each pair decoded and encoded anew."""

    def wanted(pairs: Column, name) -> Column:
        return F.filter(pairs, lambda p: ~F.lower(name(p)).isin(*drop)) if drop else pairs

    # Where encoding changes nothing, pairs are looked at as they stand.
    plain = text.rlike(r"^[A-Za-z0-9_.~+&=-]*\z") & ~text.rlike("=[^&]*=") & ~text.rlike(r"(^|&)[^=&]*\+[^&]*=")
    standing = F.array_join(wanted(F.filter(F.split(text, "&"), lambda p: p.rlike("^[^=]*=.")), lambda p: F.substring_index(p, "=", 1)), "&")
    return F.when(plain, standing).otherwise(query_text(wanted(query_pairs(text), lambda p: p["name"])))


def without_query_keys(url: Column, drop: Sequence[str]) -> Column:
    """A URL with a query loses the pairs with these keys or without a value, and its fragment; the other pairs are encoded
    anew and the scheme is in lower case. One without a query stays as it is."""
    kept = _kept_pairs(query(url), drop)
    base = F.substring_index(F.substring_index(url, "#", 1), "?", 1)
    base = F.when(_part(url, 1) == "", base).otherwise(F.concat(scheme(url), F.substring(base, F.length(_part(url, 1)) + 1, F.length(base))))
    return F.when(query(url) == "", url).otherwise(F.when(kept == "", base).otherwise(F.concat(base, F.lit("?"), kept)))


def _dotless(p: Column) -> Column:
    """A path without dot segments."""
    parts = F.split(p, "/")
    last = F.element_at(parts, -1)
    done = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, x: F.when(x == ".", acc).when(x == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc)).otherwise(F.concat(acc, F.array(x))),
    )
    return F.concat(F.array_join(done, "/"), F.when(last.isin(".", "..") & (F.size(done) > 1), F.lit("/")).otherwise(F.lit("")))


def absolute(base: Column, link: Column) -> Column:
    """``link`` resolved against ``base``: absolute, network-path, absolute-path, query, fragment and relative links."""
    return let(F.struct(base.alias("b"), link.alias("l")), lambda x: _resolved(x["b"], x["l"]))


def _resolved(base: Column, link: Column) -> Column:
    origin = F.concat(_part(base, 1), F.lit("://"), _part(base, 2))
    rest = F.regexp_extract(link, r"^[^?#]*([?#].*)?$", 1)
    folder = F.regexp_extract(path(base), r"^(.*/)[^/]*$", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    bare = F.substring_index(base, "#", 1)
    return (
        F.when(link == "", base)
        .when(_part(link, 1) != "", link)
        .when(link.startswith("//"), F.concat(_part(base, 1), F.lit(":"), link))
        .when(link.startswith("/"), F.concat(origin, _dotless(path(link)), rest))
        .when(link.startswith("?"), F.concat(F.substring_index(bare, "?", 1), link))
        .when(link.startswith("#"), F.concat(bare, link))
        .otherwise(F.concat(origin, _dotless(F.concat(folder, path(link))), rest))
    )


def is_web(url: Column) -> Column:
    return scheme(url).isin("http", "https")


def candidate(url: Column, base: Column, drop: Sequence[str] = (), keep_query: bool = False) -> Column:
    """A portal's normal form of a link; empty if it is not a web link. With ``keep_query`` the rest of the query stays
    and the path ends in a slash, else the form is canonical."""
    return let(absolute(base, url), lambda full: _normal(full, drop, keep_query))


def _normal(full: Column, drop: Sequence[str], keep_query: bool) -> Column:
    if keep_query:
        folder = F.when(path(full).endswith("/"), path(full)).otherwise(F.concat(path(full), F.lit("/")))
        kept = _kept_pairs(query(full), drop)
        form = F.concat(scheme(full), F.lit("://"), host(full), folder, F.when(kept == "", F.lit("")).otherwise(F.concat(F.lit("?"), kept)))
    else:
        form = canonical(full)
    return F.when(is_web(full), form).otherwise(F.lit(""))


def on_domain(url: Column, domain: Column) -> Column:
    """The host is ``domain`` or below it; a null or empty domain allows all."""
    h = host(url)
    return F.coalesce(filled(domain).isNull() | (h == domain) | h.endswith(F.concat(F.lit("."), domain)), F.lit(True))


def domain_name(url: Column) -> Column:
    """A name for folders: the host without ``www.``, other characters than letters, digits, dot and hyphen as ``-``."""
    name = F.regexp_replace(F.regexp_replace(F.trim(host(url)), r"^www\.", ""), r"[^a-z0-9.-]+", "-")
    return F.when(scheme(url) == "file", F.lit("local-file")).otherwise(F.coalesce(filled(name), F.lit("unknown-domain")))


def page_url(start: Column, number: Column, first: Column, parameter: Column, template: Column, first_is_start: Column) -> Column:
    """struct(url, strategy) of a listing's page: the start URL itself, a template with {base} and {page}, or the page
    as a query parameter. Of parameters with one name the last value counts, at the place of the first; all are encoded
    anew."""
    name = F.coalesce(filled(F.trim(parameter)), F.lit("page"))
    text = number.cast("string")
    pairs = F.concat(query_pairs(query(start), keep_blank=True), F.array(F.struct(name.alias("name"), text.alias("value"))))

    def once(every: Column) -> Column:
        heads = F.filter(every, lambda p, i: F.array_position(F.transform(every, lambda q: q["name"]), p["name"]) == i + 1)
        return F.transform(heads, lambda p: F.element_at(F.filter(every, lambda q: q["name"] == p["name"]), -1))

    asked = let(pairs, lambda every: query_text(once(every)))
    base, fragment = F.substring_index(F.substring_index(start, "#", 1), "?", 1), _part(start, 5)
    with_query = F.concat(base, F.lit("?"), asked, F.when(fragment == "", F.lit("")).otherwise(F.concat(F.lit("#"), fragment)))
    from_template = F.replace(F.replace(template, F.lit("{base}"), start), F.lit("{page}"), text)
    is_start, has_template = F.coalesce(first_is_start, F.lit(True)) & (number == first), filled(template).isNotNull()
    return F.struct(
        F.when(is_start, start).when(has_template, from_template).otherwise(with_query).alias("url"),
        F.when(is_start, F.lit("start_url")).when(has_template, F.lit("template")).otherwise(F.lit("query_param")).alias("strategy"),
    )
