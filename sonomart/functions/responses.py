"""Attributes of stored lookup responses (JSON text or HTML) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sonomart.functions.bands import UNKNOWN
from sonomart.functions.text import strip
from sonomart.plans.contract import FEATURES

ARTIST_SEARCH = "artists array<struct<type: string, country: string>>"
RELEASE_SEARCH = "releases array<struct<`label-info`: array<struct<label: struct<name: string>>>>>"
TRACK_SEARCH = "tracks struct<items: array<struct<id: string, album: struct<name: string>>>>"
NO_LABEL = "[no label]"
NOT_FOUND = "No Encontrado"


def first_where(items: Column, predicate) -> Column:
    """First array element that satisfies the predicate, else null."""
    return F.get(F.filter(items, predicate), F.lit(0))


def artist_attributes(response: Column) -> tuple[Column, Column]:
    """(type, country) of the first artist hit."""
    hit = F.get(F.from_json(response, ARTIST_SEARCH)["artists"], F.lit(0))
    return F.coalesce(hit["type"], F.lit(UNKNOWN)), F.coalesce(hit["country"], F.lit(UNKNOWN))


def _label_names(response: Column) -> tuple[Column, Column]:
    releases = F.from_json(response, RELEASE_SEARCH)["releases"]
    infos = F.flatten(
        F.transform(releases, lambda r: F.coalesce(r["label-info"], F.array().cast("array<struct<label:struct<name:string>>>")))
    )
    return releases, F.transform(infos, lambda i: i["label"]["name"])


def first_label(response: Column, wider_response: Column | None = None) -> Column:
    """First real label over all releases; the wider response counts only if the first has no release."""

    def real(name: Column) -> Column:
        return name.isNotNull() & (name != "") & (name != NO_LABEL)

    releases, names = _label_names(response)
    found = first_where(names, real)
    if wider_response is not None:
        empty = F.coalesce(F.size(releases), F.lit(0)) <= 0
        found = F.when(empty, first_where(_label_names(wider_response)[1], real)).otherwise(found)
    return F.coalesce(found, F.lit(UNKNOWN))


def track_hit(response: Column, features: Column) -> Column:
    """Struct (album, id, keep, all features): a search without items keeps a marker row, a hit without features is dropped."""
    item = F.get(F.from_json(response, TRACK_SEARCH)["tracks"]["items"], F.lit(0))
    parsed = F.from_json(features, ", ".join(f"`{f}` double" for f in FEATURES))
    return F.struct(
        F.when(item.isNull(), F.lit(NOT_FOUND)).otherwise(item["album"]["name"]).alias("album"),
        item["id"].alias("id"),
        (item.isNull() | features.isNotNull()).alias("keep"),
        *[F.when(item.isNotNull(), parsed[f]).alias(f) for f in FEATURES],
    )


def decode_entities(c: Column) -> Column:
    """The five XML entities plus the no-break space, ampersand last."""
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def first_anchor_text(html: Column) -> Column:
    """Text of the first hyperlink that has a target, without inner tags; unknown when there is none."""
    pattern = r"(?is)<a\s(?:[^>]*\s)?href\b[^>]*>(.*?)</a\s*>"
    inner = F.regexp_replace(F.regexp_extract(html, pattern, 1), r"(?s)<[^>]*>", "")
    return F.when(html.rlike(pattern), strip(decode_entities(inner))).otherwise(F.lit(UNKNOWN))
