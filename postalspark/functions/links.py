"""Link expressions: the crawl-link predicate, URL resolution and host check.

The crawl start page is a parameter (a constant), so its parts are split once
on the driver; the per-row work is built-in string/array expressions.
"""

from __future__ import annotations

import re
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postalspark.schemas import SKIPPED_LINK_PARTS

# Fixed patterns.
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
NETLOC = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"
PATH_PART = r"^([^?#]*)"
# Lower-cased link text that disqualifies a link outright.
REJECTED = "|".join(re.escape(p) for p in ["/cep/", "/logradouro/"] + SKIPPED_LINK_PARTS) + "|/sao-paulo/*$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _parts(path: Column) -> Column:
    return F.array_remove(F.split(path, "/"), "")


def link_path(href) -> Column:
    """Path of a link as the predicate sees it (absolute URL: after the host)."""
    href = _c(href)
    rest = F.substr(href, F.instr(href, "://") + F.lit(3))
    abs_path = F.when(F.instr(rest, "/") > 0, F.substr(rest, F.instr(rest, "/"))).otherwise(F.lit("/"))
    return (F.when(F.instr(href, "://") > 0, abs_path)
            .when(href.startswith("/"), href)
            .otherwise(F.concat(F.lit("/"), href)))


def is_area_link(href) -> Column:
    """C11: True for a link to an area page below ``sao-paulo``; never NULL.

    Rejects empty links, code pages, street pages, blog/about/contact pages and the
    city page itself; needs a part after the first ``sao-paulo`` other than ``sp`` and a
    ``pt-br`` or ``brasil`` part (part matching is case-sensitive). The path is cut into
    parts once; no pattern recurses, however many parts a link has.
    """
    href = _c(href)
    low = F.lower(href)

    def below_city(parts: Column) -> Column:
        city = F.array_position(parts, "sao-paulo")  # 1-based, so it is the 0-based place of the next part
        follower = F.get(parts, city.cast("int"))
        return ((city > 0) & follower.isNotNull() & (follower != "sp")
                & (F.array_contains(parts, "pt-br") | F.array_contains(parts, "brasil")))

    ok = ((F.length(href) > 0) & ~low.rlike(REJECTED) & low.contains("/sao-paulo/")
          & F.get(F.transform(F.array(_parts(link_path(href))), below_city), F.lit(0)))
    return F.coalesce(ok, F.lit(False))


def _normalize(href: Column, base_scheme: str) -> Column:
    """Rewrite forms that resolve like a plainer link.

    ``///path`` (empty host) is the absolute path ``/path``; ``scheme:rest`` with the
    base's own scheme and no host is the relative reference ``rest``.
    """
    own = f"{base_scheme.lower()}:"
    same_scheme = F.lower(F.substr(href, F.lit(1), F.lit(len(own)))) == F.lit(own)
    rest = F.substr(href, F.lit(len(own) + 1))
    no_host = ~rest.startswith("//") | rest.startswith("///")
    href = F.when(same_scheme & no_host, rest).otherwise(href)
    return F.when(href.startswith("///"), F.substr(href, F.lit(3))).otherwise(href)


def _remove_dots(segments: Column) -> Column:
    """RFC 3986 dot-segment removal over an array of path segments.

    One fold over the segments; the state carries the kept segments and the last
    segment seen, so the fold is evaluated once per row.
    """
    start = F.struct(F.array().cast("array<string>").alias("kept"), F.lit("").alias("last"))

    def step(st, s):
        kept = st["kept"]
        nxt = (F.when(s == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))))
               .when(s == ".", kept)
               .otherwise(F.concat(kept, F.array(s))))
        return F.struct(nxt.alias("kept"), s.alias("last"))

    def finish(st):
        kept = F.when(st["last"].isin(".", ".."), F.concat(st["kept"], F.array(F.lit("")))).otherwise(st["kept"])
        return F.array_join(kept, "/")

    return F.aggregate(segments, start, step, finish)


def _url_parts(h: Column) -> dict[str, Column]:
    return {"path": F.regexp_extract(h, PATH_PART, 1),
            "query": F.regexp_extract(h, r"^[^?#]*\?([^#]*)", 1),
            "frag": F.regexp_extract(h, r"^[^#]*#(.*)$", 1),
            "scheme": F.lower(F.regexp_extract(h, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)),
            "after_scheme": F.regexp_extract(h, r"^[A-Za-z][A-Za-z0-9+.-]*:([^?#]*)", 1)}


def _resolve_from(original: Column, h: Column, parts: dict[str, Column], base: str) -> Column:
    b = urlsplit(base)
    origin = f"{b.scheme}://{b.netloc}"
    base_dir_parts = b.path.split("/")
    if base_dir_parts[-1] != "":
        base_dir_parts = base_dir_parts[:-1]
    path, query, frag = parts["path"], parts["query"], parts["frag"]

    def tail(q: Column) -> Column:
        return F.concat(F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit("")),
                        F.when(frag != "", F.concat(F.lit("#"), frag)).otherwise(F.lit("")))

    segs = F.split(path, "/")
    middle = F.array_remove(F.concat(F.array(*[F.lit(p) for p in base_dir_parts[1:]]).cast("array<string>"),
                                     F.slice(segs, 1, F.size(segs) - 1)), "")
    relative_segs = F.concat(F.array(F.lit(base_dir_parts[0])), middle, F.array(F.element_at(segs, -1)))
    # Only a path with '.' or '..' segments needs the fold; any other path joins as is
    # (relative ones under the base folder, with empty inner segments dropped).
    dotted = path.rlike(r"(^|/)\.\.?(/|$)")
    base_dir = "/" + "".join(p + "/" for p in base_dir_parts[1:] if p)
    absolute = F.when(dotted, _remove_dots(segs)).otherwise(path)
    relative = F.when(dotted, _remove_dots(relative_segs)).otherwise(
        F.concat(F.lit(base_dir), F.regexp_replace(path, "/+", "/")))

    def with_origin(p: Column) -> Column:
        # a path always starts with '/' after the host
        return F.concat(F.lit(origin + "/"), F.regexp_replace(p, "^/", ""), tail(query))

    no_path_query = F.when(query != "", query).otherwise(F.lit(b.query))
    has_scheme = parts["scheme"] != ""
    return (F.when(original.isNull(), F.lit(None).cast("string"))
            .when(original == "", F.lit(base))
            .when(has_scheme & (parts["scheme"] == b.scheme.lower()),
                  F.concat(F.lit(b.scheme + ":"), parts["after_scheme"], tail(query)))
            .when(has_scheme, h)
            .when(h.startswith("//"), F.concat(F.lit(b.scheme + ":"), path, tail(query)))
            .when(path == "", F.concat(F.lit(origin + b.path), tail(no_path_query)))
            .when(h.startswith("/"), with_origin(absolute))
            .otherwise(with_origin(relative)))


def resolve_url(href, base: str) -> Column:
    """Make ``href`` absolute against the constant ``base`` URL (``urljoin`` rules).

    Dot segments are removed from merged paths; an empty query or fragment marker
    is dropped; a reference with no path keeps the base path (and the base query
    when it has none of its own). ``resolve_links`` is the same rule on a frame,
    with each part projected once.
    """
    original = _c(href)
    h = _normalize(original, urlsplit(base).scheme)
    return _resolve_from(original, h, _url_parts(h), base)


def resolve_links(df: DataFrame, href: str, base: str, out: str) -> DataFrame:
    """C12 on a frame: the link is split into parts in one projection and resolved in
    the next, so every part is computed once per row."""
    keep = [c for c in df.columns]
    staged = df.select(*keep, _normalize(F.col(href), urlsplit(base).scheme).alias("_h"))
    parts = _url_parts(F.col("_h"))
    staged = staged.select(*keep, "_h", *[v.alias(f"_{k}") for k, v in parts.items()])
    refs = {k: F.col(f"_{k}") for k in parts}
    return staged.select(*keep, _resolve_from(F.col(href), F.col("_h"), refs, base).alias(out))


def netloc(url) -> Column:
    """Host part with user info and port, '' when the URL has none."""
    return F.regexp_extract(_c(url), NETLOC, 1)


def same_host(url, base: str) -> Column:
    """The URL's host (with port) equals the base URL's; never NULL."""
    return F.coalesce(netloc(url) == F.lit(urlsplit(base).netloc), F.lit(False))


def resolves_to_host(href, base: str) -> Column:
    """``same_host(resolve_url(href, base), base)`` computed from the link itself.

    Only a link with its own authority (``scheme://host`` or ``//host``) can leave
    the base host; a scheme without one resolves to itself and has no host; every
    other link resolves under the base host. Lets a crawl filter links before the
    (costlier) resolution.
    """
    href = _normalize(_c(href), urlsplit(base).scheme)
    own_authority = href.rlike(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//") & ~href.startswith("///")
    return (F.when(href.isNull(), F.lit(False))
            .when(own_authority, same_host(href, base))
            .when(href.rlike(SCHEME), F.lit(urlsplit(base).netloc == ""))
            .otherwise(F.lit(True)))
