"""Column expressions shared by the operators. All JVM-side, codegen friendly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import USER_FIELDS


def col_or_name(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def user_columns(user: Column | str) -> list[Column]:
    """The six user fields of a nested user struct, as top-level columns."""
    u = col_or_name(user)
    return [u.getField(f).alias(f) for f in USER_FIELDS]


def locked_weight(weight: Column | str, locked: Column | str) -> Column:
    """Edge weight, doubled when the destination vertex is locked."""
    w, lock = col_or_name(weight), col_or_name(locked)
    return F.when(lock, w * 2).otherwise(w)


def best_label(label: Column | str, score: Column | str) -> Column:
    """Aggregate: label with the highest score, ties to the smallest label."""
    lab, sc = col_or_name(label), col_or_name(score)
    return F.min_by(lab, F.struct((-sc).alias("neg_score"), lab.alias("label")))


def post_time(created_at: Column | str) -> Column:
    """Time of a post, from the social format (``Wed Aug 27 13:08:45 +0000 2008``) or an ISO one; null if it is neither."""
    text = col_or_name(created_at)
    social = F.try_to_timestamp(F.regexp_replace(text, r"^[A-Za-z]{3} ", ""), F.lit("MMM d HH:mm:ss Z yyyy"))
    return F.when(text.rlike(r"^[A-Za-z]{3} [A-Za-z]{3} "), social).otherwise(F.try_to_timestamp(text))


def key_of(prefix: str, value: Column | str) -> Column:
    """Key of a keyed-store row: ``prefix:value``."""
    return F.concat(F.lit(f"{prefix}:"), col_or_name(value).cast("string"))


def url_origin(url: Column | str) -> Column:
    """Scheme and host of a URL, e.g. ``https://a.example.com``."""
    return F.regexp_extract(col_or_name(url), r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)


def url_base(url: Column | str) -> Column:
    """The URL up to and including its last ``/`` in the path (query and fragment removed)."""
    u = F.regexp_replace(col_or_name(url), r"[?#].*$", "")
    return F.regexp_extract(u, r"^(.*/)", 1)


def without_dots(url: Column | str) -> Column:
    """A URL whose path has its ``.`` and ``..`` segments resolved."""
    u = col_or_name(url)
    origin = url_origin(u)
    rest = F.substring(u, F.length(origin) + 1, F.length(u))
    path = F.regexp_extract(rest, r"^[^?#]*", 0)
    parts = F.split(F.regexp_replace(path, r"/\.{1,2}$", "$0/"), "/", -1)
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done)
        # the empty part before the leading slash stays
        .when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1))))
        .otherwise(F.concat(done, F.array(part))),
    )
    plain = F.concat(origin, F.array_join(kept, "/"), F.substring(rest, F.length(path) + 1, F.length(rest)))
    return F.when(path.rlike(r"/\.{1,2}(/|$)"), plain).otherwise(u)


def resolve_href(url: Column | str, href: Column | str) -> Column:
    """Resolve a link against the page that holds it.

    A link with a scheme stays; ``//host`` takes the page's scheme, ``/path``
    its origin, ``?query`` its path, ``#fragment`` its path and query, any
    other one its folder (the root, if the URL has no path). An empty link is
    the page itself. ``.`` and ``..`` segments are resolved.
    """
    u, h = col_or_name(url), col_or_name(href)
    origin, base = url_origin(u), url_base(u)
    page = F.regexp_replace(u, r"#.*$", "")
    folder = F.when(F.length(base) > F.length(origin), base).otherwise(F.concat(origin, F.lit("/")))
    return (
        F.when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), h)
        .when(h.startswith("//"), F.concat(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*:", 0), h))
        .when(h.startswith("/"), without_dots(F.concat(origin, h)))
        .when((h == "") | h.startswith("#"), F.concat(page, h))
        .when(h.startswith("?"), F.concat(F.regexp_replace(u, r"[?#].*$", ""), h))
        .otherwise(without_dots(F.concat(folder, h)))
    )


#: Character references that are decoded, the ampersand last.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&#39;": "'", "&amp;": "&"}


def decode_entities(text: Column | str) -> Column:
    """``text`` with the basic character references decoded."""
    out = col_or_name(text)
    for name, char in ENTITIES.items():
        out = F.replace(out, F.lit(name), F.lit(char))
    return out


def replace_first_dot(text: Column | str, replacement: Column | str) -> Column:
    """``text`` with its first ``.`` replaced by ``replacement`` (unchanged if no dot)."""
    t, r = col_or_name(text), col_or_name(replacement)
    pos = F.instr(t, ".")
    return F.when(
        pos > 0,
        F.concat(F.substring(t, F.lit(1), pos - 1), r, F.substring(t, pos + 1, F.length(t))),
    ).otherwise(t)


def archive_file_name(url: Column | str) -> Column:
    """Last path part of a URL minus its last four characters (the archive suffix)."""
    last = F.element_at(F.split(col_or_name(url), "/"), -1)
    return F.substring(last, F.lit(1), F.greatest(F.length(last) - 4, F.lit(0)))
