"""Route-like tables derived from the given tables, as SQL text that reads the same in both engines.

Every fixture reads whole tables. Geometry is carried as WKT text with fixed decimals, so its text is
identical wherever it is produced.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def _dec(expr: str, digits: int = 6) -> str:
    return f"cast(cast({expr} as decimal(14,{digits})) as varchar(40))"


def _point(x: str, y: str) -> str:
    return f"{_dec(x)} || ' ' || {_dec(y)}"


def _line(points) -> str:
    return "'LINESTRING (' || " + " || ', ' || ".join(_point(x, y) for x, y in points) + " || ')'"


# Provider route: eight vertices; competitor leaves it between vertices 3 and 4 by a detour of 0, 0.001 or 0.002.
_RX = "((o_custkey % 200) / 10.0 + {k} * 0.002)"
_RY = "(40 + (o_orderkey % 100) / 10.0 + 0.001 * ((o_orderkey * {m}) % 3))"
_ROUTE = [(_RX.format(k=k), _RY.format(m=k + 1)) for k in range(8)]
_COMP = [
    (_RX.format(k=k), _RY.format(m=k + 1) + (" + 0.001 * (o_orderkey % 3)" if k in (3, 4) else "")) for k in range(8)
]

# Stretch of a section: five vertices on a coarse lattice, so that copies and near copies occur.
_SX = "((l_partkey % 40) / 4.0 + {k} * 0.02 + 0.0001 * (l_suppkey % 3))"
_SY = "((l_suppkey % 10) / 2.0 + 0.01 * ((l_partkey * {m}) % 3) + 0.0001 * (l_linenumber % 3))"
_STRETCH = [(_SX.format(k=k), _SY.format(m=k + 1)) for k in range(5)]

# Corridor of a supplier and the traces (events) that follow, cross or miss it.
_CX = "((s_suppkey % 1000) / 10.0 + {k} * 0.001)"
_CY = "(10 + (s_suppkey % 7) * 0.5 + 0.0005 * ((s_suppkey * {k}) % 2))"
_CORRIDOR = [(_CX.format(k=k), _CY.format(k=k)) for k in range(4)]
_TSHIFT = "(case when event_type = 'error' then 0.00003 when event_type = 'purchase' then 0.0004 else 0.00001 end)"
_TX = "((user_id % 1000) / 10.0 + {k} * 0.001)"
_TY = "(10 + (user_id % 7) * 0.5 + 0.0005 * ((user_id * {k}) % 2) + " + _TSHIFT + ")"
_TFWD = [(_TX.format(k=k), _TY.format(k=k)) for k in range(4)]
_TREV = _TFWD[::-1]

FIXTURES: dict[str, str] = {
    "fx_routes": """
        select cast(o_orderkey as varchar(20)) as route_id,
               cast(o_custkey % 20 as varchar(20)) as sample_id,
               cast(extract(year from o_orderdate) as varchar(20)) as run_id,
               n_name as country,
               'Q' || substr(o_orderpriority, 1, 1) as quality,
               case when c_mktsegment in ('BUILDING', 'MACHINERY') then 'OV' else 'OM' end as provider,
               case when o_orderkey % 2 = 0 then 'C1' else 'C2' end as competitor,
               o_totalprice / 50.0 as provider_route_length,
               o_totalprice / 500.0 as provider_route_time,
               o_totalprice / 50.0 * (0.8 + (o_orderkey % 5) / 10.0) as competitor_route_length,
               o_totalprice / 500.0 * (0.8 + (o_orderkey % 5) / 10.0) as competitor_route_time,
               case o_orderstatus when 'F' then 'optimal' when 'O' then 'potential_error'
                    when 'P' then 'routing_issue' end as rac_state,
               cast(o_orderdate as date) as route_date,
               'POINT(' || {o} || ')' as origin,
               'POINT(' || {d} || ')' as destination
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
    """.replace("{o}", _point(*_ROUTE[0])).replace("{d}", _point(*_ROUTE[-1])),
    "fx_sections": """
        select cast(l_orderkey as varchar(20)) || '-' || cast(l_linenumber as varchar(20)) || '-' ||
               cast(l_partkey as varchar(20)) || '-' || cast(l_suppkey as varchar(20)) as case_id,
               cast(l_orderkey as varchar(20)) as route_id,
               cast(extract(year from o_orderdate) as varchar(20)) as run_id,
               l_quantity * 10 as stretch_length,
               case when l_discount >= 0.03 then 'potential_error' else 'no error' end as fcd_state,
               case when l_returnflag = 'N' then null
                    when l_partkey % 9 = 0 then 'discard' when l_partkey % 9 = 1 then 'WDTRF'
                    when l_partkey % 9 = 2 then 'SGEO' when l_partkey % 9 = 3 then 'MMAN'
                    when l_partkey % 9 = 4 then 'IMPLICIT' when l_partkey % 9 = 5 then 'MBP'
                    when l_partkey % 9 = 6 then 'WRC' when l_partkey % 9 = 7 then 'WGEO' else 'MGSC' end as mcp_state,
               case when l_linestatus = 'O' then 'NO-TEMP' when l_partkey % 4 = 0 then 'TEMP' end as error_subtype,
               l_discount * 10 as probability,
               l_tax * 10 as probability_new,
               l_shipdate as review_ts,
               cast(l_shipdate as date) as inspection_date,
               case when l_suppkey % 3 = 0 then 'r' || cast(l_orderkey as varchar(20)) || '-' ||
                    cast(l_partkey as varchar(20)) end as reference_case_id
        from lineitem join orders on l_orderkey = o_orderkey
    """,
    "fx_metadata": """
        select run_id, sample_id, max(route_date) as inspection_date, min(provider) as provider,
               min(competitor) as competitor, case when run_id in ('1995', '1996') then 'O1' else 'G1' end as product,
               min(country) as country, cast(count(*) as bigint) as mcp_tasks
        from fx_routes group by run_id, sample_id
    """,
    "fx_weights": """
        select n_name as country, 1.0 / (1 + n_nationkey) as weight, n_nationkey as ranking from nation
    """,
    "fx_route_lines": f"""
        select cast(o_orderkey as varchar(20)) as route_id, n_name as country, {_line(_ROUTE)} as provider_route,
               {_line(_COMP)} as competitor_route
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
    """,
    "fx_stretches": f"""
        select cast(l_orderkey as varchar(20)) || '-' || cast(l_linenumber as varchar(20)) || '-' ||
               cast(l_partkey as varchar(20)) || '-' || cast(l_suppkey as varchar(20)) as case_id,
               l_orderkey * 10000000000 + l_partkey * 100000 + l_suppkey * 10 + l_linenumber as ordinal,
               cast(l_orderkey as varchar(20)) as route_id, l_shipdate as inspection_date,
               {_line(_STRETCH)} as stretch
        from lineitem
    """,
    "fx_corridors": f"""
        select cast(s_suppkey as varchar(20)) as case_id, n_name as country, {_line(_CORRIDOR)} as stretch,
               date '2024-01-14' as date_end
        from supplier join nation on s_nationkey = n_nationkey
    """,
    "fx_traces": f"""
        select cast(event_id as varchar(20)) as trace_id, cast(user_id as varchar(20)) as org,
               cast(ts as date) as trace_date,
               case when event_type = 'view' then {_line(_TREV)}
                    when event_type = 'signup' then {_line(_TFWD[:2])}
                    else {_line(_TFWD)} end as trace
        from events
    """,
    "fx_tags": """
        select p_partkey as way_id, p_size % 5 as lane_count,
               case when p_size % 3 = 0 then null when p_size % 3 = 1 then 'designated|yes|' || lower(p_type)
                    else 'designated||designated' end as bus_lanes,
               case when p_size % 4 = 0 then null when p_size % 4 = 1 then 'designated|yes|' || lower(p_type)
                    else 'yes|designated|designated' end as hov_lanes,
               case when p_size % 5 < 2 then null when p_size % 5 = 2 then 'yes|no|psv' else 'bus|taxi|yes' end
                    as access_lanes,
               case when p_size % 7 = 0 then 'reversible' when p_size % 7 = 1 then 'alternating'
                    when p_size % 7 = 2 then null else 'yes' end as oneway,
               case when p_size % 6 = 0 then cast(p_size % 2 + 1 as varchar(20)) end as lanes_both_ways,
               case when p_size % 4 <> 1 then cast(p_size % 5 as varchar(20)) end as lanes,
               case when p_size % 8 = 3 then '1' end as lanes_forward,
               case when p_size % 9 = 4 then '1' end as lanes_backward
        from part
    """,
}


def _names_in(sql: str, pool) -> list[str]:
    words = set(re.findall(r"[a-z_]+", sql))
    return [n for n in pool if n in words]


def oracle(sql: str) -> str:
    """The SQL with the fixtures it needs in front, as one statement for an ANSI engine."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _names_in(text, FIXTURES):
            if name not in needed:
                visit(FIXTURES[name])
                needed.append(name)

    visit(sql)
    body = sql.strip()
    if not needed:
        return body
    ctes = ",\n".join(f"{n} as ({FIXTURES[n]})" for n in needed)
    if body.lower().startswith("with recursive "):
        return f"with recursive {ctes},\n{body[len('with recursive '):]}"
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"


# Fixtures whose rows carry lines: the work per row is high, so it must not sit in one task.
LINE_FIXTURES = ["fx_route_lines", "fx_stretches", "fx_corridors", "fx_traces"]


# Bytes of files whose rows one task takes when they are dealt out.
SPREAD_BYTES = 4 << 20


def spread(df: DataFrame, most: int = SPREAD_BYTES) -> DataFrame:
    """Rows dealt out when there are fewer files than cores: to all cores, and to more tasks the larger the files; many files stay as read."""
    spark = df.sparkSession
    cores, files = spark.sparkContext.defaultParallelism, df.inputFiles()
    if len(files) >= cores:
        return df
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in files]
    size = sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths)
    return df.repartition(max(cores, -(-size // most)))


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(str(Path(sf_dir) / f"{name}.parquet"))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or a fixture over given tables."""
    if name in BASE_TABLES:
        return base(spark, sf_dir, name)
    sql = FIXTURES[name]
    frames = {n: base(spark, sf_dir, n) for n in _names_in(sql, BASE_TABLES)}
    if name in LINE_FIXTURES:
        frames = {n: spread(df) for n, df in frames.items()}
    frames |= {n: load(spark, sf_dir, n) for n in _names_in(sql, FIXTURES) if n != name}
    text = re.sub(r"\b(" + "|".join(frames) + r")\b(?!\.)", r"{\1}", sql)
    return spark.sql(text, **frames)
