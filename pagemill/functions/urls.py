"""URL column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: schemes that take relative references
RELATIVE_SCHEMES = ("", "file", "ftp", "gopher", "http", "https", "imap", "mms", "nntp", "prospero", "rtsp", "rtsps",
                    "rtspu", "sftp", "shttp", "svn", "svn+ssh", "wais", "ws", "wss")
_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once (an expression that uses a large one in several
    places would otherwise hold, and compute, as many copies of it)."""
    return F.get(F.transform(F.array(value), body), 0)


def _parts(url: Column) -> Column:
    """struct(scheme, authority, path, params, query, fragment); '' where there is none. The params
    are what follows the first semicolon of the last path segment."""
    params = r";([^/]*)$"

    def tail_parts(rest: Column) -> Column:
        tail = F.regexp_replace(rest, r"^//[^/?#]*", "")
        return _let(tail, lambda t: F.struct(
            F.regexp_replace(F.regexp_extract(t, r"^([^?#]*)", 1), params, "").alias("path"),
            F.regexp_extract(F.regexp_extract(t, r"^([^?#]*)", 1), params, 1).alias("params"),
            F.regexp_extract(t, r"^[^?#]*\?([^#]*)", 1).alias("query"),
            F.regexp_extract(t, r"(?s)^[^#]*#(.*)$", 1).alias("fragment")))

    def of(rest: Column) -> Column:
        return _let(tail_parts(rest), lambda t: F.struct(
            F.regexp_extract(rest, r"^//([^/?#]*)", 1).alias("authority"), t["path"].alias("path"), t["params"].alias("params"),
            t["query"].alias("query"), t["fragment"].alias("fragment")))

    return _let(url, lambda u: _let(of(F.regexp_replace(u, _SCHEME, "")), lambda p: F.struct(
        F.lower(F.regexp_extract(u, _SCHEME, 1)).alias("scheme"), p["authority"].alias("authority"),
        p["path"].alias("path"), p["params"].alias("params"), p["query"].alias("query"),
        p["fragment"].alias("fragment"))))


def _recomposed(scheme: Column, authority: Column, path: Column, params: Column, query: Column,
                fragment: Column) -> Column:
    def with_mark(mark: str, c: Column) -> Column:
        return F.when(c != "", F.concat(F.lit(mark), c)).otherwise("")

    def put(p: Column) -> Column:
        rooted = F.when((authority != "") & (p != "") & ~p.startswith("/"), F.concat(F.lit("/"), p)).otherwise(p)
        slashes = F.when((authority != "") | scheme.isin("file") | p.startswith("//"),
                         F.concat(F.lit("//"), authority)).otherwise("")
        return F.concat(F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""), slashes, rooted)

    return F.concat(_let(path, put), _let(params, lambda m: with_mark(";", m)), _let(query, lambda q: with_mark("?", q)), _let(fragment, lambda f: with_mark("#", f)))


def _merged_path(base: Column, ref: Column) -> Column:
    """The reference's path on the base's, without dot segments (RFC 3986, 5.2.3 and 5.2.4)."""
    def folder(own: Column) -> Column:
        return F.when(F.element_at(own, -1) != "", F.slice(own, 1, F.size(own) - 1)).otherwise(own)

    def thinned(m: Column) -> Column:
        n = F.size(m)
        inner = F.filter(F.slice(m, 2, F.greatest(n - 2, F.lit(0))), lambda s: s != "")
        return F.when(n < 2, m).otherwise(F.concat(F.slice(m, 1, 1), inner, F.slice(m, n, 1)))

    def resolved(segments: Column) -> Column:
        done = F.aggregate(segments, F.array().cast("array<string>"), lambda acc, s: (
            F.when(s == ".", acc).when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
            .otherwise(F.concat(acc, F.array(s)))))
        ends = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(
            F.array().cast("array<string>"))
        return _let(F.array_join(F.concat(done, ends), "/"), lambda j: F.when(j == "", "/").otherwise(j))

    parts = F.split(ref, "/")
    segments = F.when(ref.startswith("/"), parts).otherwise(
        _let(F.concat(_let(F.split(base, "/"), folder), parts), thinned))
    return _let(segments, resolved)


# what needs no resolution: an absolute reference and a rooted one without dot segments, both without controls, spaces,
# brackets, params and empty parts (which would go)
_TAIL = r"(\?[^\x00-\x20#]+)?(#[^\x00-\x20]+)?\z"
_ORIGIN = r"^(https?://[^\x00-\x20/?#\[\]]+)"
_PLAIN_ABSOLUTE = r"^https?://[^\x00-\x20/?#\[\]]+(/[^\x00-\x20?#;]*)?" + _TAIL
_PLAIN_ROOTED = r"^(?!//)(?![^?#]*/\.)/[^\x00-\x20?#;]*" + _TAIL


def urljoin(base: Column, ref: Column) -> Column:
    """RFC 3986 reference resolution (``resolved``); absolute and rooted references that need none, most of
    those in pages, are recognised by a pattern."""
    simple = base.rlike(_ORIGIN)
    return (F.when(simple & ref.rlike(_PLAIN_ABSOLUTE), ref)
            .when(simple & ref.rlike(_PLAIN_ROOTED), F.concat(F.regexp_extract(base, _ORIGIN, 1), ref))
            .otherwise(resolved(base, ref)))


def resolved(base: Column, ref: Column) -> Column:
    """Reference resolution in Catalyst expressions alone.

    Absolute references and those of other schemes come back unchanged, ''
    returns the base, dot segments are removed, control characters at the
    start and line ends are dropped. A reference or base with a malformed
    authority (an unpaired bracket) gives null instead of an error.
    """
    def cleaned(c: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")

    def unpaired(host: Column) -> Column:
        return host.contains("[") != host.contains("]")

    def joined(p: Column) -> Column:
        b, r, scheme = p["b"], p["r"], p["scheme"]
        foreign = (scheme != b["scheme"]) | ~scheme.isin(*RELATIVE_SCHEMES)
        same_page = F.when(r["query"] != "", r["query"]).otherwise(b["query"])
        rootless = r["authority"] == ""
        same = rootless & (r["path"] == "") & (r["params"] == "")
        path = (F.when(~rootless, r["path"]).when(same, b["path"]).otherwise(_merged_path(b["path"], r["path"])))
        whole = _recomposed(scheme, F.when(rootless, b["authority"]).otherwise(r["authority"]), path,
                            F.when(same, b["params"]).otherwise(r["params"]),
                            F.when(same, same_page).otherwise(r["query"]), r["fragment"])
        return (F.when(p["base"].isNull() | unpaired(b["authority"]) | unpaired(r["authority"]), F.lit(None).cast("string"))
                .when(F.coalesce(p["ref"], F.lit("")) == "", p["base"]).when(p["base"] == "", p["ref"])
                .when(foreign, p["ref"]).otherwise(whole))

    both = F.struct(_parts(cleaned(base)).alias("b"), _parts(cleaned(ref)).alias("r"), base.alias("base"), ref.alias("ref"))
    return _let(both, lambda p: _let(F.struct(
        p["b"].alias("b"), p["r"].alias("r"), p["base"].alias("base"), p["ref"].alias("ref"),
        F.when(p["r"]["scheme"] == "", p["b"]["scheme"]).otherwise(p["r"]["scheme"]).alias("scheme")), joined))


def url_host(url: Column) -> Column:
    """Host part, for per-host partitioning (politeness) and grouping."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def mask_url(url: Column) -> Column:
    """Hide the password of ``scheme://user:password@host`` as ``****``."""
    return F.regexp_replace(url, r"(://[^:/@]*):[^@/]*@", "$1:****@")
