"""URL functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# What is rejected, and session parameters that are not part of a URL's identity.
REJECTED_EXTENSION = r"\.(ico|css|sit|eps|wmf|zip|ppt|mpg|xls|gz|rpm|tgz|mov|exe|bmp|js)$"
REJECTED_SCHEME = r"^(file|ftp|mailto):"
SESSION_PARAMETERS = ("jsessionid", "phpsessid", "aspsessionid")

# The two published forms of the domain pattern and the answer without a match.
DOMAIN_FORM_A = r"(https?:)(\/)(\/)(w{3})(\.)(.+?(?=\.))(\.)([a-z]{2}[a-z]{1})(.*)"
DOMAIN_FORM_B = r"https?://www\.(.+?)\.(co[a-z]|edu|gov|net|org)"
DOMAIN_NOT_FOUND = "Domain not found"

#: Two-label public suffixes under which a registered domain has three labels.
PUBLIC_SUFFIXES = (
    "ac.jp", "ac.nz", "ac.uk", "ac.za", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za",
    "com.ar", "com.au", "com.br", "com.cn", "com.hk", "com.mx", "com.sg", "com.tr", "com.tw",
    "edu.au", "edu.cn", "go.jp", "gov.au", "gov.br", "gov.cn", "gov.in", "gov.uk", "gov.za",
    "ltd.uk", "me.uk", "ne.jp", "net.au", "net.br", "net.cn", "net.nz", "or.jp", "or.kr",
    "org.au", "org.br", "org.cn", "org.nz", "org.uk", "org.za", "plc.uk", "sch.uk",
)

SCHEME = "^([A-Za-z][A-Za-z0-9+.-]*)://"
AUTHORITY = "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
PATH = "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"
PORT = "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*:([0-9]+)(?:[/?#]|$)"
QUERY = r"^[^?#]*\?([^#]*)"


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, SCHEME, 1))


def host(url: Column) -> Column:
    """Lower-case host, without user and port; empty when there is none."""
    authority = F.regexp_extract(url, AUTHORITY, 1)
    return F.lower(F.regexp_replace(authority, "^.*@|:[0-9]*$", ""))


def path(url: Column) -> Column:
    return F.regexp_extract(url, PATH, 1)


def _normal_path(raw: Column) -> Column:
    """``.``, ``..`` and empty segments resolved; never climbs above the root."""
    doubled = F.regexp_replace(raw, "/+", "/")
    climbed = F.aggregate(
        F.filter(F.split(raw, "/"), lambda s: ~s.isin("", ".")),
        F.expr("cast(array() as array<string>)"),
        lambda kept, s: F.when(
            s == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))
        ).otherwise(F.concat(kept, F.array(s))),
    )
    end = F.when(raw.rlike(r"/(\.{0,2})$") & (F.size(climbed) > 0), "/").otherwise("")
    resolved = F.concat(F.lit("/"), F.array_join(climbed, "/"), end)
    clean = F.when(raw.rlike(r"/\.{1,2}(/|$)"), resolved).otherwise(doubled)
    escaped = F.replace(F.replace(clean, F.lit("%7E"), F.lit("~")), F.lit(" "), F.lit("%20"))
    return F.when(raw == "", "/").otherwise(escaped)


def _normal_query(raw: Column) -> Column:
    """Parameters in their order, without session ids and without a ``=`` before nothing."""
    kept = F.filter(
        F.split(raw, "&"),
        lambda p: (p != "")
        & ~F.lower(F.regexp_extract(p, "^[^=]*", 0)).isin(*SESSION_PARAMETERS),
    )
    named = F.transform(kept, lambda p: F.regexp_replace(p, "=$", ""))
    joined = F.replace(F.array_join(named, "&"), F.lit(" "), F.lit("%20"))
    return F.when(joined == "", "").otherwise(F.concat(F.lit("?"), joined))


def _canonical_parts(url: Column) -> Column:
    text = F.trim(url)
    return F.struct(
        scheme(text).alias("scheme"),
        host(text).alias("host"),
        F.regexp_extract(text, PORT, 1).alias("port"),
        path(text).alias("path"),
        F.regexp_extract(text, QUERY, 1).alias("query"),
    )


def _canonical_text(parts: Column) -> Column:
    name, where, port = parts["scheme"], parts["host"], parts["port"]
    default = ((name == "http") & (port == "80")) | ((name == "https") & (port == "443"))
    whole = F.concat(
        name,
        F.lit("://"),
        where,
        F.when((port == "") | default, "").otherwise(F.concat(F.lit(":"), port)),
        _normal_path(parts["path"]),
        F.when(parts["query"] == "", "").otherwise(_normal_query(parts["query"])),
    )
    return F.when((name != "") & (where != ""), whole)


def canonical_urls(urls: Column) -> Column:
    """``canonical_url`` of each element; a URL is taken apart once."""
    return F.transform(F.transform(urls, _canonical_parts), _canonical_text)


def canonical_url(url: Column) -> Column:
    """One spelling per URL, or null when there is no scheme or host.

    Lower-case scheme and host; no user, default port, fragment or session parameter; path
    segments resolved, an empty path is ``/``.
    """
    return F.get(canonical_urls(F.array(url)), F.lit(0))


def is_rejected(url: Column) -> Column:
    """Whether the extension or the scheme is one we do not crawl; case matters."""
    return url.rlike(REJECTED_EXTENSION) | url.rlike(REJECTED_SCHEME)


def _found(match: Column) -> Column:
    return F.when(match == "", DOMAIN_NOT_FOUND).otherwise(match)


def domain_www(url: Column) -> Column:
    """Form A: the first label after ``www.`` that is followed by three letters."""
    return _found(F.regexp_extract(url, DOMAIN_FORM_A, 6))


def domain_tld(url: Column) -> Column:
    """Form B: the labels between ``www.`` and a known top-level domain."""
    return _found(F.regexp_extract(url, DOMAIN_FORM_B, 1))


def registered_domain(url: Column, suffixes: tuple[str, ...] = PUBLIC_SUFFIXES) -> Column:
    """The last two labels of the host, or three under a two-label public suffix."""
    where = host(url)
    last_two = F.substring_index(where, ".", -2)
    return F.when(last_two.isin(*suffixes), F.substring_index(where, ".", -3)).otherwise(last_two)


def resolve_link(link: Column, base: Column) -> Column:
    """A link as an absolute URL against ``base``: a struct of ``page``, ``origin``, ``folder``."""
    return (
        F.when(link.startswith("//"), F.concat(F.substring_index(base["origin"], "//", 1), link))
        .when(link.startswith("/"), F.concat(base["origin"], link))
        .when(link.startswith("?"), F.concat(base["page"], link))
        .when(link.startswith("#"), base["page"])
        .when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .otherwise(F.concat(base["folder"], link))
    )


def link_base(url: Column) -> Column:
    """What relative links on the page ``url`` are resolved against."""
    origin = F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
    page = F.regexp_extract(url, "^[^?#]*", 0)
    folder = F.when(page == origin, F.concat(page, F.lit("/"))).otherwise(
        F.regexp_extract(page, "^.*/", 0)
    )
    return F.struct(page.alias("page"), origin.alias("origin"), folder.alias("folder"))
