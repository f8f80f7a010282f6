"""Addresses: parts, normal forms and hosts. A regular expression splits them, so malformed ones never raise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPLIT = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def part(url: Column, i: int) -> Column:
    """1 scheme, 2 authority, 3 path, 4 query, 5 fragment; '' where absent, null for null."""
    return F.regexp_extract(F.trim(url), SPLIT, i)


def host_of(url: Column) -> Column:
    """Lower-cased host without user, port, a leading www., m. or amp.; '' where there is none."""
    h = F.lower(part(url, 2))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(h, r"^.*@", ""), r":\d*$", ""), r"^(?:www\d?\.|m\.|mobile\.|amp\.)+", "")


# Query parameters that tell where a reader came from, not which page is meant.
TRACKING = r"^(?:utm_[^=]*|fbclid|gclid|gclsrc|dclid|gbraid|wbraid|msclkid|yclid|twclid|ttclid|igshid|mc_cid|mc_eid|_ga|_gl|_hsenc|_hsmi|spm|scm|ref|ref_src|ref_url|referrer|referer|source|src|from|share|shared|cmpid|campaign|ncid|trk|trkcampaign|sessionid|session_id|phpsessid|sid|jsessionid|amp|outputtype)(?:=|$)"


def page_key(url: Column) -> Column:
    """An address without the parts that do not tell pages of a site apart: scheme, www and mobile hosts, letter case
    of the host, standard port, trailing slashes, index file, session and tracking parameters, order of parameters,
    fragment. Letter case of the path counts, as does every other parameter. Null for null and for no address."""
    path = F.regexp_replace(F.regexp_replace(part(url, 3), r"(?i);jsessionid=[^/]*", ""), r"/{2,}", "/")
    path = F.regexp_replace(F.regexp_replace(path, r"(?i)/(?:index|default)\.html?$", "/"), r"/+$", "")
    kept = F.array_sort(F.filter(F.split(part(url, 4), "&"), lambda x: (x != "") & ~F.lower(x).rlike(TRACKING)))
    port = F.regexp_extract(part(url, 2), r":(\d+)$", 1)
    host = F.concat(host_of(url), F.when(~port.isin("", "80", "443"), F.concat(F.lit(":"), port)).otherwise(""))
    return F.when(host_of(url) != "", F.concat_ws("?", F.concat(host, path), F.when(F.size(kept) > 0, F.array_join(kept, "&"))))


def normalize(url: Column) -> Column:
    """Scheme and host lower-cased, standard port and fragment dropped, one trailing slash removed; a value that is no
    absolute address is only trimmed."""
    u = F.trim(url)
    host = F.regexp_replace(F.lower(part(url, 2)), r":(?:80|443)$", "")
    query = F.regexp_extract(u, r"^[^?#]*(\?[^#]*)?", 1)
    path = F.regexp_replace(part(url, 3), r"/$", "")
    return F.when(u.rlike(SPLIT), F.concat(F.lower(part(url, 1)), F.lit("://"), host, path, query)).otherwise(u)


def with_scheme(url: Column) -> Column:
    """`https://` put before an address that has no scheme; blank stays blank."""
    u = F.trim(url)
    return F.when(u.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://") | (u == ""), u).otherwise(F.concat(F.lit("https://"), u))


def well_formed(url: Column) -> Column:
    """Whether a value is an http(s) address with a host."""
    return F.coalesce(F.lower(part(url, 1)).isin("http", "https") & (part(url, 2) != ""), F.lit(False))


def urls_in(text: Column) -> Column:
    """The distinct addresses in a text, in order, without trailing punctuation; a bare www. host gets a scheme."""
    found = F.regexp_extract_all(text, F.lit(r"((?:https?://|www\.)[^\s<>\"]+)"), F.lit(1))
    return F.array_distinct(F.transform(found, lambda x: with_scheme(F.regexp_replace(x, r"[.,;:!?)\]}'。,;:!?)】》]+$", ""))))
