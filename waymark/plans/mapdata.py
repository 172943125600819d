"""Map attributes: tags, lanes, relations, post-processing of map matches, weights of map features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from waymark.functions import geo, kernels as k, text as tx
from waymark.operators.barrier import keep_where
from waymark.operators.matching import matched_pieces
from waymark.operators.order import first_per_key, island_runs


# ---- tags and lanes --------------------------------------------------------------------------


def lane_attributes(tags: DataFrame) -> DataFrame:
    """Everything the lane joins need per way, derived in one projection over the tags table."""
    bus = tx.bus_only_lanes("bus_lanes", "hov_lanes")
    return tags.select(
        F.col("way_id"), bus.alias("bus_only"), tx.designated_lanes("hov_lanes").alias("hov"),
        tx.restricted_lanes("access_lanes").alias("psv_only"), tx.is_reversible("oneway").alias("bidirectional"),
        F.coalesce(F.col("lanes_both_ways").try_cast("int"), F.lit(0)).alias("suicide_lane"),
        (F.col("lanes").isNull() & F.col("lanes_forward").isNull() & F.col("lanes_backward").isNull()).alias("no_lane_tags"),
    )


def add_lane_info(matched: DataFrame, tags: DataFrame, way_id: str, lanes: str) -> DataFrame:
    """Matched features with bus, shared, restricted, reversible and centre-turn lanes: one left join.

    Restricted lanes count only where there is no bus-only lane; the centre-turn lane is added to the lane
    count; at most one lane and no lane tag at all means the count is a default and becomes 0.
    """
    info = lane_attributes(tags).withColumnRenamed("way_id", way_id)
    out = matched.join(info, way_id, "left")
    count = F.when((F.col(lanes) <= 1) & F.coalesce("no_lane_tags", F.lit(True)), F.lit(0)).otherwise(F.col(lanes))
    return out.select(
        *[c for c in matched.columns if c != lanes], (count + F.coalesce("suicide_lane", F.lit(0))).alias(lanes),
        F.col("bus_only"), F.col("hov"), F.when(F.col("bus_only") == 0, F.col("psv_only")).otherwise(F.lit(0)).alias("psv_only"),
        F.coalesce("bidirectional", F.lit(False)).alias("bidirectional"), F.coalesce("suicide_lane", F.lit(0)).alias("suicide_lane"),
    )


def coverage_loss(requested: DataFrame, found: DataFrame, key: str, limit: float = 0.1) -> DataFrame:
    """Requested and found ids, the share lost, and whether it is above the limit."""
    want = requested.select(key).distinct()
    have = found.select(key).distinct()
    joined = want.join(have.withColumn("_f", F.lit(1)), key, "left")
    return joined.agg(F.count("*").alias("requested"), F.count("_f").alias("found")).withColumn(
        "loss", F.try_divide((F.col("requested") - F.col("found")).cast("double"), F.col("requested"))
    ).withColumn("warn", F.coalesce(F.col("loss") > limit, F.lit(False)))


def directed_lanes(direction: Column, travel_codes: Column, from_lanes: Column, to_lanes: Column, physical: Column) -> Column:
    """Lanes in driving direction of a link, from its counts or its per-lane direction codes (F, T, B).

    ``travel_codes`` is an array of codes, one per lane; -1 when nothing decides.
    """
    num = lambda c: F.coalesce(c.try_cast("int"), F.lit(0))
    f, t, p = num(from_lanes), num(to_lanes), num(physical)
    counted = F.when(direction == "FROM_REF", f).when(direction == "TO_REF", t)
    own = F.when(direction == "FROM_REF", F.lit("F")).when(direction == "TO_REF", F.lit("T"))
    coded = F.size(F.filter(travel_codes, lambda c: (c == own) | (c == "B")))
    return (
        F.when((p == 0) | (p == f + t), F.coalesce(counted, F.lit(0)))
        .when(travel_codes.isNull() | own.isNull(), F.lit(-1))
        .when(F.size(travel_codes) > 1, coded)
        .otherwise(counted)
    )


def drive_direction(link_id: Column) -> Column:
    return F.when(link_id.cast("double") > 0, F.lit("FROM_REF")).otherwise(F.lit("TO_REF"))


def lane_details(links: DataFrame, link_to_lane: DataFrame, lanes: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Links with their lane records: left joins, lane type 1 or none, and counts of open and closed lanes."""
    base = links if wanted is None else links.join(wanted, "link_id", "left_semi")
    joined = base.filter(F.col("num_lanes").isNotNull()).join(link_to_lane, "link_id", "left")
    joined = joined.filter(F.col("lane_info_type").isNull() | (F.col("lane_info_type") == 1)).join(lanes, "lane_info_id", "left")
    return joined.withColumn("open_lanes", tx.char_count("lane_validity", "1")).withColumn("closed_lanes", tx.char_count("lane_validity", "0"))


def lane_connections(connections: DataFrame, maneuvers: DataFrame, junctions: DataFrame) -> DataFrame:
    """Lane connections of the wanted junctions."""
    wanted = maneuvers.join(junctions.select("junction_id"), "junction_id", "left_semi")
    return connections.join(wanted, "maneuver_id")


# ---- relations -------------------------------------------------------------------------------


def relation_members(flat: Column | str) -> Column:
    """Flat ``[member, role, ...]`` array as ``array<struct<member, role>>``."""
    flat = F.col(flat) if isinstance(flat, str) else flat
    steps = F.filter(F.sequence(F.lit(0), F.greatest(F.size(flat) - 1, F.lit(0))), lambda i: (i % 2 == 0) & (i + 1 < F.size(flat)))
    return F.transform(steps, lambda i: F.struct(F.get(flat, i).alias("member"), F.get(flat, i + 1).alias("role")))


def relation_ends(relations: DataFrame) -> DataFrame:
    """From way (first member), last from, ways in between, first to, and the first node in between."""
    num = lambda m: F.substring(m, 2, 40).cast("bigint")
    rows = relations.withColumn("_m", relation_members("members"))
    froms = F.filter("_m", lambda m: m["role"].contains("from"))
    others = F.filter("_m", lambda m: ~m["role"].contains("from"))
    tos = F.filter(others, lambda m: m["role"].contains("to"))
    vias = F.filter(others, lambda m: m["role"].contains("via") & m["member"].startswith("w"))
    nodes = F.filter("_m", lambda m: m["role"].contains("via") & m["member"].startswith("n"))
    return rows.select(
        *relations.columns, num(F.get("_m", F.lit(0))["member"]).alias("from_way_id"),
        num(F.try_element_at(froms, F.lit(-1))["member"]).alias("last_from_way_id"),
        F.transform(vias, lambda m: num(m["member"])).alias("via_way_ids"),
        num(F.get(tos, F.lit(0))["member"]).alias("to_way_id"), num(F.get(nodes, F.lit(0))["member"]).alias("via_node_id"),
    )


def relations_by_way(
    relations: DataFrame, features: DataFrame, way_lines: DataFrame, nodes: DataFrame, relation_type: str = "destination_sign",
    required_tag: str | None = None,
) -> DataFrame:
    """Relations whose from and to ways are driven, in the direction they are driven, with a combined line."""
    rows = relations.filter(F.array_contains("tags", relation_type))
    if required_tag is not None:
        rows = rows.filter(F.array_contains("tags", required_tag))
    rows = relation_ends(rows).join(nodes.select(F.col("id").alias("via_node_id"), F.col("point").alias("via_point")), "via_node_id", "left")
    driven = features.select(F.col("feature_id").alias("from_way_id"), F.col("line").alias("from_original_line")).distinct()
    rows = rows.join(driven, "from_way_id").join(features.select(F.col("feature_id").alias("to_way_id")).distinct(), "to_way_id", "left_semi")
    rows = rows.join(way_lines.select(F.col("way_id").alias("from_way_id"), F.col("line").alias("from_line")), "from_way_id")
    rows = rows.join(way_lines.select(F.col("way_id").alias("to_way_id"), F.col("line").alias("to_line")), "to_way_id")
    rows = first_per_key(rows, ["from_way_id", "id"], [geo.wkt_of_points("from_original_line")])
    rows = rows.withColumn("from_way_same_directed", geo.same_direction("from_original_line", "from_line"))

    def gap(p, q):
        return k.geodesic_distance(p["x"], p["y"], q["x"], q["y"])

    f1, f2, t1, t2 = geo.first("from_line"), geo.last("from_line"), geo.first("to_line"), geo.last("to_line")
    rows = rows.withColumns({"_21": gap(f2, t1), "_12": gap(f1, t2), "_22": gap(f2, t2), "_11": gap(f1, t1)})
    forward = (F.col("_21") < F.col("_12")) | (F.col("_22") < F.col("_11"))
    backward = (F.col("_21") > F.col("_12")) | (F.col("_22") > F.col("_11"))
    rows = keep_where(rows, F.when(F.col("from_way_same_directed"), forward).otherwise(backward)).drop("_21", "_12", "_22", "_11")
    rows = rows.withColumn("combined_line", geo.join_nearest_ends("from_line", "to_line")).withColumnRenamed("id", "relation_id")
    return rows.select(*[F.col(c).alias(f"{relation_type}_{c}") for c in rows.columns])


# ---- map matches -----------------------------------------------------------------------------


def edge_runs(edges: DataFrame, shapes: DataFrame, attributes: list[str], trace: str = "trace_id", seq: str = "seq") -> DataFrame:
    """Consecutive matched edges with equal attributes as one row: length, ids in order, line out of the shape.

    Runs without a line, runs at least twice as long on the map as stated, and ferries are dropped.
    """
    runs = island_runs(edges, trace, seq, attributes).groupBy(trace, "run_no").agg(
        F.sum("length").alias("length"), F.min_by("begin_shape_index", seq).alias("begin"), F.max_by("end_shape_index", seq).alias("end"),
        F.transform(F.array_sort(F.collect_list(F.struct(seq, "edge_id"))), lambda x: x["edge_id"]).alias("edge_ids"),
        *[F.min_by(c, seq).alias(c) for c in attributes],
    )
    rows = runs.join(shapes.select(trace, F.col("line").alias("_shape")), trace)
    rows = rows.filter(F.col("begin") < F.col("end")).withColumn("line", geo.subroute("_shape", F.col("begin"), F.col("end"))).drop("_shape")
    rows = rows.filter(2 * F.col("length") * 1000 > k.geodesic_length("line"))
    if "use" in attributes:
        rows = rows.filter(F.col("use").isNull() | (F.col("use") != "ferry"))
    return rows.drop("begin", "end")


def drop_overlong_matches(matched: DataFrame, traces: DataFrame, trace: str = "trace_id", factor: float = 3.0) -> DataFrame:
    """Drop traces whose matched pieces are together more than ``factor`` times as long as the trace."""
    own = traces.select(trace, k.geodesic_length("line").alias("_own"))
    sums = matched.groupBy(trace).agg(F.sum(k.geodesic_length("line")).alias("_matched"))
    bad = sums.join(own, trace).filter(F.col("_matched") > F.col("_own") * factor).select(trace)
    return matched.join(bad, trace, "left_anti")


def join_trace_columns(matched: DataFrame, traces: DataFrame, trace: str = "trace_id", line: str = "line") -> DataFrame:
    """Trace columns on the matched rows; names that clash become ``original_<name>``."""
    renamed = [
        F.col(c).alias(f"original_{c}" if c in matched.columns and c != trace else c) for c in traces.columns if c != line
    ]
    return matched.join(traces.select(*renamed), trace, "left")


def split_traces(traces: DataFrame, line: str = "line", metres: float = 20000.0) -> DataFrame:
    """Pieces of equal vertex count, one per started 20 km; pieces of one vertex are dropped."""
    n = F.greatest(F.ceil(k.geodesic_length(line) / metres), F.lit(1))
    rows = traces.withColumn("_n", n).withColumn("_per", F.greatest(F.floor(F.size(line) / F.col("_n")), F.lit(1)).cast("int"))
    starts = F.sequence(F.lit(0), F.size(line) - 1, F.col("_per"))
    pieces = F.transform(starts, lambda i: F.slice(F.col(line), i + 1, F.col("_per")))
    rows = rows.filter(F.size(line) > 0).select(*[c for c in traces.columns if c != line], F.posexplode_outer(pieces).alias("piece", line))
    return rows.filter(F.size(line) > 1)


def match_store(
    features: DataFrame, stored: DataFrame, sample_id: str, product: str, map_version: str, columns: list[str]
) -> dict[str, DataFrame]:
    """Tables to append for a new match of (sample, product, map version); empty frames when it is stored.

    More than one stored match is an error. Ids are hashes, so a repeated run writes the same ids.
    """
    key = (F.col("sample_id") == sample_id) & (F.col("product") == product) & (F.col("map_version") == map_version)
    existing = stored.filter(key).limit(2).count()
    if existing > 1:
        raise ValueError(f"more than one stored match for sample {sample_id}, map version {map_version}")
    rows = features if existing == 0 else features.filter(F.lit(False))
    match_id = tx.hashed_uuid(F.lit(sample_id), F.lit(product), F.lit(map_version))
    info_id = tx.hashed_uuid(F.lit("info"), F.lit(sample_id), F.lit(product), F.lit(map_version))
    rows = rows.withColumn("map_match_id", match_id).withColumn("map_info_id", info_id)
    rows = rows.withColumn("match_info_id", tx.hashed_uuid("map_match_id", "trace_id", "seq"))
    rows = rows.withColumn("length", k.geodesic_length("line") / 1000)
    info = [F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns]
    totals = rows.groupBy("map_match_id").agg(F.round(F.sum("length"), 2).alias("map_matched_length_km"))
    meta = totals.select(
        F.lit(sample_id).alias("sample_id"), "map_match_id", F.lit(product).alias("product"), F.lit(map_version).alias("map_version"),
        "map_matched_length_km",
    )
    return {
        "map_matched": rows.select("map_match_id", "match_info_id", "edge_id", geo.wkt_of_points("line").alias("geom"), "trace_id"),
        "map_info": rows.select("map_info_id", "match_info_id", "edge_id", "length", *info),
        "map_matched_metadata": meta,
    }


def stored_match(tables: dict[str, DataFrame], sample_id: str, product: str, map_version: str) -> dict[str, DataFrame]:
    """The stored tables of one match."""
    meta = tables["map_matched_metadata"].filter(
        (F.col("sample_id") == sample_id) & (F.col("product") == product) & (F.col("map_version") == map_version)
    )
    matched = tables["map_matched"].join(meta, "map_match_id", "left_semi")
    return {
        "map_matched_metadata": meta, "map_matched": matched,
        "map_info": tables["map_info"].join(matched, "match_info_id", "left_semi"),
    }


# ---- weights and matching of two maps --------------------------------------------------------


def weight_directions(features: DataFrame, line: str = "line") -> DataFrame:
    """Whether each visit of a feature runs like the visit with the smallest first coordinate."""
    start = geo.first(line)
    reference = features.groupBy("feature_id").agg(
        F.min_by(F.col(line), F.struct(start["x"], start["y"], F.col("original_trace_id"))).alias("_ref")
    )
    return features.join(reference, "feature_id").withColumn("weight_direction", geo.same_direction("_ref", line)).drop("_ref")


def weight_features(directed: DataFrame, provider: str) -> DataFrame:
    """One row per (feature, direction): the first visit, the number of visits and a reproducible id."""
    keys = ["feature_id", "weight_direction"]
    rest = [c for c in directed.columns if c not in keys]
    picked = directed.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*[c for c in ["original_trace_id"]])).alias("_row"), F.count("*").alias("weight")
    )
    direction = F.when(F.col("weight_direction"), F.lit("True")).otherwise(F.lit("False"))
    return picked.select(
        *keys, "_row.*", "weight", tx.reproducible_uuid(F.lit(provider), F.col("feature_id"), direction).alias("feature_id_uuid")
    )


def visiting_traces(directed: DataFrame) -> DataFrame:
    """The traces of every (feature, direction) as rows: a list per feature could outgrow a task."""
    return directed.select("feature_id", "weight_direction", F.col("original_trace_id").cast("string").alias("original_trace_id"))


def match_features(
    provider: DataFrame, competitor: DataFrame, radius: float = 0.00003, min_metres: float = 1.0,
    remove_contained_pieces: bool = True, remove_other_angles: bool = True, on: list[str] | None = None,
) -> DataFrame:
    """Pieces of provider features that run along competitor features in the same direction.

    ``provider`` has feature_a, line_a; ``competitor`` has feature_b, line_b. The longest piece per pair
    stays, contained pieces and pieces that turn 45 degrees or more from the partner are dropped.
    """
    longest = matched_pieces(
        provider, competitor, "feature_a", "feature_b", "line_a", "line_b", radius, min_metres, 0.00001 if remove_contained_pieces else None, on
    )
    if remove_other_angles:
        p1 = geo.first("piece")
        q1 = k.interpolate("line_b", k.project("line_b", p1["x"], p1["y"]))
        rows = longest.withColumn("_p", p1).withColumn("_q", q1)
        p2, q2 = geo.following_point("piece", F.col("_p")), geo.following_point("line_b", F.col("_q"))
        rows = rows.withColumn("_p2", p2).withColumn("_q2", q2)

        def azimuth(a, b):
            return k.geodesic_azimuth(F.col(f"{a}.x"), F.col(f"{a}.y"), F.col(f"{b}.x"), F.col(f"{b}.y"))

        angle = geo.angle_difference(azimuth("_p", "_p2"), azimuth("_q", "_q2"))
        longest = keep_where(rows, F.abs("piece_angle") < 45, {"piece_angle": angle}).drop("_p", "_q", "_p2", "_q2")
    return longest


def matching_balance(provider: DataFrame, matched: DataFrame, group: str = "trace_id") -> DataFrame:
    """Own and matched metres per trace, with the two warnings: over 20 % lost, over 0.5 % gained."""
    own = provider.groupBy(group).agg(F.sum(k.geodesic_length("line_a")).alias("own_metres"))
    got = matched.groupBy(group).agg(F.sum("piece_metres").alias("matched_metres"))
    rows = own.join(got, group, "left").na.fill(0.0, ["matched_metres"])
    return rows.withColumn("lost", F.abs(F.col("own_metres") - F.col("matched_metres")) > F.col("own_metres") * 0.2).withColumn(
        "gained", F.col("matched_metres") > F.col("own_metres") * 1.005
    )


def combine_first_two(pieces: DataFrame, keys: list[str], seq: str, line: str) -> DataFrame:
    """The first two lines of each group as one; a single line stays as it is."""
    ranked = pieces.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(seq))).filter("_n <= 2")
    both = ranked.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", line))), lambda x: x[line]).alias("_l"))
    one, two = F.get("_l", F.lit(0)), F.get("_l", F.lit(1))
    return both.select(*keys, F.when(two.isNull(), one).otherwise(geo.combine_lines(one, two)).alias(line))
