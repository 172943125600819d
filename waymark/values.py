"""Fixed values that results depend on: codes, lists and thresholds, stated as they are."""

# Sample metrics.
METRIC_DEFAULT = "TbT"
METRIC_LONG = "HDR"
METRIC_LONG_FAMILY = ["HDR_v2", "HDR"]

# Section states.
POTENTIAL_ERROR = "potential_error"
NO_ERROR = "no_error"
OPTIMAL = "optimal"
ROUTING_ISSUE = "routing_issue"
DISCARD = "discard"
ERROR_LOG_SOURCE = "tbt"

# Error codes allowed in review results.
ERROR_TYPES = ["discard", "WDTRF", "SGEO", "MMAN", "IMPLICIT", "MBP", "WRC", "WGEO", "MGSC"]

# Error code -> families; a code also counts under its own name.
ERROR_FAMILIES = {
    "oneway": ["WDTRF"],
    "turnrest": ["MMAN", "MGSC", "MBP"],
    "nonnav": ["WRC", "SGEO", "WGEO"],
}
ROUTER_ERROR_TYPES = ["alignment", "MGEO", "SF", "SBP", "SMAN", "SGSC", "WDTRF", "IOW", "SOW"]
ROUTER_ERROR_FAMILIES = {
    "oneway": ["WDTRF", "IOW", "SOW"],
    "turnrest": ["SBP", "SMAN", "SGSC"],
    "nonnav": ["MGEO", "SF"],
}
ROUTER_SEVERITY_FAMILIES = {
    "mgeo_sv": ["MGEO_severe"],
    "mgeo_nonsv": ["MGEO_start_end"],
    "nonnav_sv": ["MGEO_severe", "SF_severe", "SF_start_end"],
}
ERROR_SUBTYPES = ["MBP_TEMP", "MBP_NO-TEMP", "MMAN_U-TURN", "IMPLICIT_U-TURN"]

# Road class -> importance.
ROAD_IMPORTANCE = {
    "High": [
        "primary", "motorway", "secondary", "tertiary", "trunk",
        "primary_link", "motorway_link", "secondary_link", "tertiary_link", "trunk_link",
    ],
    "Medium": ["residential", "unclassified", "road", "living_street", "track"],
    "Low": ["service"],
    "Other": ["other"],
}

# Countries that drive on the left (ISO3 codes as the data spells them).
LEFT_DRIVING = [
    "ATG", "AUS", "BHS", "BGD", "BRB", "BTN", "BWA", "BRU", "CHN", "CYP",
    "DMA", "TMP", "SWZ", "FJI", "GRD", "GUY", "IND", "IDN", "IRL", "JAM",
    "JPN", "KEN", "KIR", "LSO", "MWI", "MDV", "MLT", "MUS", "MOZ", "NAM",
    "NRU", "NZL", "PAK", "PNG", "KNA", "LCA", "VCT", "WSM", "SYC", "SGP",
    "SLB", "LKA", "SUR", "TZA", "THA", "TON", "TTO", "TUV", "UGA", "GBR",
    "VGB", "CYM", "FLK", "GGY", "IMN", "JEY", "ZMB", "ZWE",
]

# Road signs that become features.
SIGNS = [
    "CONSTRUCTION_AHEAD_TT",
    "MANDATORY_STRAIGHT_ONLY",
    "MANDATORY_STRAIGHT_OR_LEFT",
    "MANDATORY_TURN_RESTRICTION",
    "MANDATORY_TURN_LEFT_ONLY",
    "MANDATORY_TURN_LEFT_OR_RIGHT",
    "MANDATORY_LEFT_OR_STRAIGHT_OR_RIGHT",
    "MANDATORY_TURN_RIGHT_ONLY",
    "MANDATORY_STRAIGHT_OR_RIGHT",
    "NO_ENTRY",
    "NO_MOTOR_VEHICLE",
    "NO_CAR_OR_BIKE",
    "NO_LEFT_OR_RIGHT_TT",
    "NO_LEFT_TURN",
    "NO_RIGHT_TURN",
    "NO_VEHICLE",
    "NO_STRAIGHT_OR_LEFT_TT",
    "NO_STRAIGHT_OR_RIGHT_TT",
    "NO_STRAIGHT_TT",
    "NO_TURN_TT",
    "NO_U_OR_LEFT_TURN",
    "NO_U_TURN",
    "ONEWAY_TRAFFIC_TO_STRAIGHT",
]

# Geometry tolerances, in degrees unless named otherwise.
ROUTE_BUFFER = 0.0002
REUSE_BUFFER = 0.00005
SECTION_PAD = 0.0004
SIMPLIFY_TOLERANCE = 0.0001
SECTION_MIN_METRES = 100.0
SECTION_MIN_DEGREES = 0.001
MAX_SPLIT_DEPTH = 5
TRACE_BUFFER = 0.0001
EARTH_RADIUS_M = 6371000.0


def code_families(codes, families):
    """(code, family) rows: every code under its own name and under each family that lists it."""
    rows = [(code, code) for code in codes]
    rows += [(code, family) for family, members in families.items() for code in members]
    return rows
