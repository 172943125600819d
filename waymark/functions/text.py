"""JSON columns, flat tag arrays, lane strings and export text as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


_JSON_TYPES = (T.StringType, T.NumericType, T.BooleanType, T.ArrayType)


def pack_json(df: DataFrame, id_columns: list[str], out: str = "tags") -> DataFrame:
    """Keep the id columns; all others become one JSON object with sorted keys, without NULL and NaN.

    Numbers, text and lists are kept; other types (dates, structs) are left out.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    packed = sorted(c for c, t in fields.items() if c not in id_columns and isinstance(t, _JSON_TYPES))
    values = []
    for c in packed:
        col = F.col(f"`{c}`")
        if isinstance(fields[c], (T.DoubleType, T.FloatType)):
            col = F.when(~F.isnan(col), col)
        values.append(col.alias(c))
    body = F.to_json(F.struct(*values)) if values else F.lit("{}")
    return df.select(*id_columns, body.alias(out))


# Columns that the packed feature table leaves out, and those it keeps as columns when present.
PACK_DROP = ["org", "trace_date", "original_length", "confidence", "map_match_id"]
PACK_IDS = ["map_info_id", "original_trace_id", "feature_id", "feature_id_uuid", "geom", "weight", "weight_direction"]


def pack_features(df: DataFrame) -> DataFrame:
    kept = df.drop(*[c for c in PACK_DROP if c in df.columns])
    return pack_json(kept, [c for c in PACK_IDS if c in kept.columns])


def unpack_json(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Fields of a JSON text column as columns; single-quoted text is read too, NULL and bad text give NULLs."""
    parsed = F.from_json(F.col(column), schema, {"allowSingleQuotes": "true", "mode": "PERMISSIVE"})
    return df.withColumn("_j", parsed).select(*[c for c in df.columns if c != column], "_j.*")


def update_tags(old: Column | str, new: Column | str) -> Column:
    """Key-wise overwrite of one JSON object by another; text that is not an object changes nothing."""
    kind = "map<string,variant>"
    o, n = F.from_json(_c(old), kind), F.from_json(_c(new), kind)
    kept = F.map_filter(o, lambda key, _: ~F.array_contains(F.map_keys(n), key))
    entries = F.concat(F.map_entries(kept), F.map_entries(n))
    is_object = F.try_parse_json(_c(new)).isNotNull() & F.ltrim(_c(new)).startswith("{")
    return F.when(is_object, F.to_json(F.map_from_entries(entries))).otherwise(_c(old))


def join_columns(columns: list[str], default=None, sep: str = "_") -> Column:
    """Text of the columns with a separator when all are present, else the default."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return F.when(present, F.concat_ws(sep, *[F.col(c).cast("string") for c in columns])).otherwise(F.lit(default))


def tag_map(flat: Column | str, key_pattern: str = ".*") -> Column:
    """Flat ``[k1, v1, k2, v2, ...]`` array to a map of the keys that match; an odd last entry is dropped.

    A repeated key keeps its last value.
    """
    flat = _c(flat)
    pairs = F.transform(
        F.filter(F.sequence(F.lit(0), F.greatest(F.size(flat) - 2, F.lit(0))), lambda i: (i % 2 == 0) & (i + 1 < F.size(flat))),
        lambda i: F.struct(F.get(flat, i).alias("key"), F.get(flat, i + 1).alias("value")),
    )
    wanted = F.filter(pairs, lambda p: p["key"].rlike(key_pattern))
    last_of_key = F.filter(
        wanted,
        lambda p, i: ~F.exists(
            F.slice(wanted, i + 2, F.size(wanted)), lambda later: later["key"] == p["key"]
        ),
    )
    return F.map_from_entries(last_of_key)


def designated_lanes(lanes: Column | str) -> Column:
    return F.coalesce(F.regexp_count(_c(lanes), F.lit("designated")), F.lit(0))


def bus_only_lanes(bus: Column | str, shared: Column | str) -> Column:
    """Lanes designated for buses and not shared at the same position."""
    bus, shared = _c(bus), _c(shared)
    b, s = F.split(bus, r"\|"), F.split(shared, r"\|")
    only = F.size(
        F.filter(F.arrays_zip(b.alias("b"), s.alias("s")), lambda z: (z["b"] != z["s"]) & (z["b"] == "designated"))
    )
    return (
        F.when(F.coalesce(bus == shared, F.lit(False)), F.lit(0))
        .when(designated_lanes(bus) == 0, F.lit(0))
        .when(designated_lanes(shared) == 0, designated_lanes(bus))
        .when(F.size(b) == F.size(s), only)
        .otherwise(F.lit(0))
    )


def restricted_lanes(access: Column | str) -> Column:
    return F.coalesce(F.regexp_count(_c(access), F.lit("(no|psv|bus|taxi)")), F.lit(0))


# One-way codes of roads used in both directions in turn.
REVERSIBLE = ["reversible", "alternating", "conditional"]


def is_reversible(oneway: Column | str) -> Column:
    return F.coalesce(_c(oneway).isin(*REVERSIBLE), F.lit(False))


def char_count(text: Column | str, char: str) -> Column:
    return F.length(_c(text)) - F.length(F.replace(_c(text), F.lit(char), F.lit("")))


def point_as_lat_lon(text: Column | str) -> Column:
    """``POINT(lon lat)`` as ``"lat, lon"``; text that does not parse (also with a space before the bracket) stays."""
    text = _c(text)
    inner = F.replace(F.replace(F.trim(text), F.lit("POINT("), F.lit("")), F.lit(")"), F.lit(""))
    parts = F.split(F.trim(inner), r"\s+")
    lon, lat = F.get(parts, 0).try_cast("double"), F.get(parts, 1).try_cast("double")
    ok = (F.size(parts) == 2) & lon.isNotNull() & lat.isNotNull()
    return F.when(ok, F.concat_ws(", ", lat, lon)).otherwise(text)


def next_monday(date: Column | str) -> Column:
    """The date itself on a Monday, else the next Monday."""
    return F.next_day(F.date_sub(_c(date), 1), "MO")


def normal_state(state: Column | str) -> Column:
    """``no error`` and ``no_error`` are one state, written with an underscore."""
    return F.regexp_replace(_c(state), "^no error$", "no_error")


def reproducible_uuid(*parts: Column) -> Column:
    """UUID text from the first 32 hex digits of the SHA-256 of the concatenated parts."""
    digest = F.sha2(F.concat(*[p.cast("string") for p in parts]).cast("binary"), 256)
    return F.regexp_replace(
        F.substring(digest, 1, 32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"
    )


def hashed_uuid(*parts: Column | str) -> Column:
    """Repeatable id from a run id and an old id: the same on every retry of a task."""
    return reproducible_uuid(F.concat_ws("|", *[_c(p).cast("string") for p in parts]))
