"""URL canonicalisation and predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab as V
from .rules import hits, text

_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#[\s\S]*)?$"


def scheme(url) -> Column:
    return F.lower(F.regexp_extract(text(url), _PARTS, 1))


def authority(url) -> Column:
    return F.regexp_extract(text(url), _PARTS, 2)


def path(url) -> Column:
    return F.regexp_extract(text(url), _PARTS, 3)


def query(url) -> Column:
    return F.regexp_extract(text(url), _PARTS, 4)


def has_path(url) -> Column:
    return path(url).rlike("[^/]")


def bare_path(url) -> Column:
    return F.regexp_replace(path(url), "/+$", "")


def _assemble(scheme_c, host_c, path_c, query_c=None) -> Column:
    head = F.when(scheme_c != "", F.concat(scheme_c, F.lit(":"))).otherwise(F.lit(""))
    net = F.when(host_c != "", F.concat(F.lit("//"), host_c)).otherwise(F.lit(""))
    parts = [head, net, path_c]
    if query_c is not None:
        parts.append(F.when(query_c != "", F.concat(F.lit("?"), query_c)).otherwise(F.lit("")))
    return F.concat(*parts)


def _recode(x: Column) -> Column:
    """Percent-decode, then form-encode again."""
    plain = F.coalesce(F.try_url_decode(x), x)
    return F.replace(F.replace(F.url_encode(plain), F.lit("*"), F.lit("%2A")),
                     F.lit("%7E"), F.lit("~"))


def _kept_query(url) -> Column:
    pairs = F.filter(F.split(query(url), "&"), lambda p: p.rlike("=[\\s\\S]"))
    tracking = "^(" + "|".join(V.TRACKING_PREFIXES) + ")"
    kept = F.filter(pairs, lambda p: ~F.lower(
        F.coalesce(F.try_url_decode(F.substring_index(p, "=", 1)),
                   F.substring_index(p, "=", 1))).rlike(tracking))
    return F.array_join(F.transform(kept, lambda p: F.concat(
        _recode(F.substring_index(p, "=", 1)), F.lit("="),
        _recode(F.regexp_replace(p, "^[^=]*=", "")))), "&")


def canonical_url(url) -> Column:
    """Ingest form: lower-case host, no tracking parameters, fragment or trailing slash."""
    p = bare_path(url)
    return _assemble(scheme(url), F.lower(authority(url)),
                     F.when(p == "", F.lit("/")).otherwise(p), _kept_query(url))


def pool_url(url) -> Column:
    """Pool form: https article URL without query, or '' when the URL is not one."""
    ok = (scheme(url) == "https") & (authority(url) != "") & has_path(url)
    return F.when(ok, _assemble(scheme(url), F.lower(authority(url)), bare_path(url))
                  ).otherwise(F.lit(""))


def selector_url(url) -> Column:
    """Selector form: like the pool form but for any scheme and host."""
    return _assemble(scheme(url), F.lower(authority(url)), bare_path(url))


def story_url_key(url) -> Column:
    """Host and path identity: no scheme, www., query or fragment; '' when there is none."""
    net = F.regexp_replace(authority(url), "^.*@", "")
    port = F.regexp_extract(net, ":([^:\\]]*)$", 1)
    host = F.regexp_replace(F.lower(F.regexp_replace(net, ":[^:\\]]*$", "")), "^www\\.", "")
    bad_port = (port != "") & ~(port.rlike("^[0-9]{1,5}$") & (F.length(port) > 0)
                                & (F.coalesce(port.try_cast("int"), F.lit(0)) <= 65535))
    shown = F.when((port != "") & (F.coalesce(port.try_cast("int"), F.lit(0)) > 0),
                   F.concat(F.lit(":"), port.try_cast("int").cast("string"))
                   ).otherwise(F.lit(""))
    return F.when((authority(url) == "") | ~has_path(url) | (host == "") | bad_port, F.lit("")
                  ).otherwise(F.concat(host, shown, bare_path(url)))


def stable_id(url) -> Column:
    """First six hex digits of the SHA-1 of the URL."""
    return F.substring(F.sha1(text(url)), 1, 6)


def is_homepage(url) -> Column:
    return ~has_path(url)


def is_https_article(url) -> Column:
    """https, a host and a path below the root."""
    return (scheme(url) == "https") & (authority(url) != "") & has_path(url)


def has_real_url(url) -> Column:
    """An https article that is not a video page."""
    return is_https_article(url) & ~hits(path(url), V.RANK_VIDEO_PATH)


def is_live_blog(title, url) -> Column:
    return hits(title, V.LIVE_TITLE) | hits(path(url), V.LIVE_PATH)
