"""Column functions over JSON payload text (response bodies, whole documents)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_path(dotted: str) -> str:
    """``a.b`` as a JSON path with quoted steps."""
    return "$" + "".join(f"['{part}']" for part in dotted.split("."))


def looks_like_array(body: Column) -> Column:
    return F.ltrim(body).startswith("[")


def elements(array_text: Column) -> Column:
    """JSON array text to an array holding each element's own JSON text."""
    return F.from_json(array_text, "array<string>")


def members(text: Column) -> Column:
    """A JSON object's members, name to value text; NULL for anything else. One parse serves many lookups."""
    return F.from_json(text, "map<string,string>")


def payload_items(body: Column, data_key: str = "data") -> Column:
    """Items of a response body, each as JSON text.

    The array under ``data_key`` if the key is there, else the body itself if it
    is an array, else no items.
    """
    listed = F.when(looks_like_array(body), body).otherwise(F.try_element_at(members(body), F.lit(data_key)))
    return F.coalesce(elements(listed), F.array().cast("array<string>"))


def is_truthy(value: Column) -> Column:
    """Is a JSON value text set: not NULL, empty, false, zero or an empty container?"""
    return F.coalesce(~F.trim(value).isin("", "null", "false", "0", "0.0", "[]", "{}"), F.lit(False))


def has_next(top: Column, meta: Column, n_items: Column) -> Column:
    """Does a page announce a next one? ``meta.next``, else ``has_more``, else ``next``;
    a page that mentions none of them has a next page as long as it has items.

    ``top`` and ``meta`` are the members of the body and of its ``meta``.
    """
    return (
        F.when(F.map_contains_key(meta, "next"), is_truthy(F.try_element_at(meta, F.lit("next"))))
        .when(F.map_contains_key(top, "has_more"), is_truthy(F.try_element_at(top, F.lit("has_more"))))
        .when(F.map_contains_key(top, "next"), is_truthy(F.try_element_at(top, F.lit("next"))))
        .otherwise(n_items > 0)
    )


def next_cursor(body: Column, path: str = "meta.next_cursor") -> Column:
    """The cursor of the following page, NULL when there is none."""
    value = F.get_json_object(body, json_path(path))
    return F.when(is_truthy(value), value)
