"""Lake-water views over the test tables: one text per view, in SQL that both Spark and DuckDB read (// stands for integer division)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def _d(text: str) -> str:
    """D(x) is x as a double."""
    return re.sub(r"\bD\(([^()]+)\)", r"cast(\1 as double)", text)


#: A pixel's place in its scene, and its position, which follows from its place alone.
_PLACE = """l_orderkey // 625 as scene_no, ((l_orderkey * 31 + l_partkey * 17 + l_linenumber) % 4096) // 64 as source_row,
  (l_orderkey * 31 + l_partkey * 17 + l_linenumber) % 64 as source_col"""
_POSITION = """D(45.0) + (scene_no // 2 % 10) * D(0.25) + source_row * D(0.0026) + (scene_no % 2) * D(0.0007) as lat,
  D(-84.0) + (scene_no // 20) * D(0.4) + source_col * D(0.0037) + source_row * D(0.0004) + (scene_no % 2) * D(0.0005) as lon"""

VIEWS = {
    "raw_pixels": _d("""
select *, """ + _POSITION + """
from (select """ + _PLACE + """,
  cast(D(0.002) + (l_partkey % 83) / D(9000) as float) as r443, cast(D(0.003) + (l_suppkey % 71) / D(7000) as float) as r490,
  cast(D(0.006) + (l_partkey % 61) / D(5000) as float) as r560, cast(D(0.005) + (l_partkey % 97) / D(4000) as float) as r620,
  cast(D(0.004) + (l_suppkey % 89) / D(3500) as float) as r665, cast(D(0.004) + D(l_quantity) / D(2500) as float) as r681,
  cast(D(0.003) + D(l_extendedprice) / D(4000000) as float) as r709, cast(D(0.002) + D(l_tax) / D(4) as float) as r754,
  cast(D(0.001) + D(l_discount) / D(3) as float) as r865, cast(D(0.001) + D(l_discount) / D(3.2) as float) as r885,
  case when l_linenumber = 3 then null else cast(D(0.001) + D(l_discount) / D(3) as float) end as cloud_albedo,
  cast((case when l_returnflag = 'R' and l_linestatus = 'O' and l_quantity < 10 then 1 else 0 end) + (case when D(l_discount) >= D(0.085) then 2 else 0 end)
    + (case when l_linenumber = 7 then 4 else 0 end) + (case when l_suppkey % 50 = 49 then 8 else 0 end) as bigint) as l2_flags,
  row_number() over (partition by l_orderkey // 625, (l_orderkey * 31 + l_partkey * 17 + l_linenumber) % 4096
    order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate) as nth
  from {lineitem})"""),
    "pixels": "select * from {raw_pixels} where nth = 1",
    "lakes": _d("""
select s_suppkey as hylak_id, s_name as lake_name, D(s_acctbal) as lake_area, s_suppkey as lake_order,
  D(45.0) + (s_suppkey // 8 % 10) * D(0.25) + D(0.03) + (s_suppkey % 8 // 4) * D(0.07) as cy,
  D(-84.0) + (s_suppkey // 80) * D(0.4) + D(0.04) + (s_suppkey % 4) * D(0.05) as cx, D(0.010) + (s_suppkey % 5) * D(0.003) as rad
from {supplier}"""),
    "lake_edges": _d("""
select hylak_id, lake_order, cx + rad * u0 as x0, cy + rad * v0 as y0, cx + rad * u1 as x1, cy + rad * v1 as y1
from {lakes} cross join (values (D(1.2), D(0.1), D(0.5), D(1.0)), (D(0.5), D(1.0), D(-0.6), D(0.9)), (D(-0.6), D(0.9), D(-1.2), D(-0.1)),
  (D(-1.2), D(-0.1), D(-0.4), D(-1.0)), (D(-0.4), D(-1.0), D(0.7), D(-0.8)), (D(0.7), D(-0.8), D(1.2), D(0.1))) as v(u0, v0, u1, v1)"""),
    "scenes": _d("""
select scene_no, case when scene_no % 2 = 0 then 'S3A' else 'S3B' end as satellite, (scene_no // 2 % 5) * 1440 + (scene_no % 2) * 39 as minutes,
  min(lon) as xmin, min(lat) as ymin, max(lon) as xmax, max(lat) as ymax from {pixels} group by scene_no"""),
    "catalogue": """
select o_orderkey as scene_id, o_orderkey // 2 as acq, case when (o_orderkey // 2) % 2 = 0 then 'S3A' else 'S3B' end as satellite,
  case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'NT' when o_orderpriority = '3-MEDIUM' then 'ST' else 'NR' end as timeliness,
  case o_orderstatus when 'F' then 'done' when 'P' then 'failed' else 'queued' end as status, cast(o_orderdate as date) as created,
  o_orderkey % 24 as hour, cast(-180 + o_custkey % 360 as double) as lon, o_custkey as lake_id, cast(o_totalprice as double) as size_bytes
from {orders}""",
    "regions": _d("""
select n_regionkey as country, n_nationkey as state_id, n_name as state_name, D(-84.1) + (n_nationkey % 5) * D(0.12) as xmin,
  D(44.9) + (n_nationkey // 5) * D(0.5) as ymin, D(-84.1) + (n_nationkey % 5) * D(0.12) + D(0.15) as xmax, D(44.9) + (n_nationkey // 5) * D(0.5) + D(0.55) as ymax
from {nation}"""),
    # tilted, hollowed on one side; every third has a hole
    "region_edges": _d("""
select state_id, ring, xmin + D(0.15) * u0 as x0, ymin + D(0.55) * v0 as y0, xmin + D(0.15) * u1 as x1, ymin + D(0.55) * v1 as y1
from {regions} cross join (values (0, D(0.05), D(0.0), D(1.0), D(0.12)), (0, D(1.0), D(0.12), D(0.8), D(0.55)), (0, D(0.8), D(0.55), D(1.05), D(1.0)), (0, D(1.05), D(1.0), D(0.1), D(0.9)),
  (0, D(0.1), D(0.9), D(0.3), D(0.45)), (0, D(0.3), D(0.45), D(0.05), D(0.0)), (1, D(0.45), D(0.2), D(0.7), D(0.25)), (1, D(0.7), D(0.25), D(0.5), D(0.4)), (1, D(0.5), D(0.4), D(0.45), D(0.2))) as v(ring, u0, v0, u1, v1)
where ring = 0 or state_id % 3 = 0"""),
    "footprint_edges": _d("""
select scene_no, 0 as ring, xmin + (xmax - xmin) * u0 as x0, ymin + (ymax - ymin) * v0 as y0, xmin + (xmax - xmin) * u1 as x1, ymin + (ymax - ymin) * v1 as y1
from {scenes} cross join (values (D(0.12), D(0.0), D(1.0), D(0.2)), (D(1.0), D(0.2), D(0.88), D(1.0)), (D(0.88), D(1.0), D(0.0), D(0.8)), (D(0.0), D(0.8), D(0.12), D(0.0))) as v(u0, v0, u1, v1)"""),
    "nasa": _d("""
select p_partkey // 40 as grid_row, p_partkey % 40 as grid_col, (p_size * 37 + p_partkey) % 256 as dn,
  D(-84.0) + (p_partkey % 40) * D(0.0037) as lon, D(45.0) + (p_partkey // 40) * D(0.0027) as lat, p_partkey % 3 as tile
from {part}"""),
    "status_events": """
select event_id, user_id as scene_id, ts, case event_type when 'signup' then 'queued' when 'view' then 'running' when 'click' then 'retry'
  when 'error' then 'failed' else 'done' end as status, props from {events}""",
}
TABLES = ("lineitem", "supplier", "orders", "nation", "part", "events")


def view(spark: SparkSession, sf_dir: str, name: str, **given: DataFrame) -> DataFrame:
    """A view, from the tables and views that its text names; some may be given. Bounds of scenes come from all rows: rows of one place have one position, so none has to be the first of its place."""
    text = VIEWS[name]
    if name == "scenes" and "pixels" not in given:
        given = given | {"pixels": view(spark, sf_dir, "raw_pixels", **given)}
    used = {n: given[n] if n in given else view(spark, sf_dir, n, **given) if n in VIEWS else spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in set(re.findall(r"{(\w+)}", text))}
    return spark.sql(text.replace("//", "div"), **used)


def placed(lines: DataFrame) -> DataFrame:
    """Rows of lineitem with their pixel's place (scene_no, source_row, source_col)."""
    return lines.sparkSession.sql(f"select *, {_PLACE.replace('//', 'div')} from {{lines}}", lines=lines)


def at_places(places: DataFrame) -> DataFrame:
    """Places with their position (lat, lon)."""
    return places.sparkSession.sql(f"select *, {_d(_POSITION).replace('//', 'div')} from {{places}}", places=places)


def located(lines: DataFrame) -> DataFrame:
    """Rows of lineitem with their pixel's place and position."""
    return at_places(placed(lines))


def definition(name: str) -> str:
    """DuckDB's definition of one view, without those it uses."""
    return f"fx_{name} as ({re.sub(r'{(\w+)}', lambda m: f'fx_{m[1]}' if m[1] in VIEWS else m[1], VIEWS[name])})"


def with_views(*names: str) -> str:
    """DuckDB's WITH clause that defines the views and those they use."""
    out: dict[str, str] = {}

    def add(name: str) -> None:
        for n in re.findall(r"{(\w+)}", VIEWS[name]):
            if n in VIEWS:
                add(n)
        out.setdefault(name, re.sub(r"{(\w+)}", lambda m: f"fx_{m[1]}" if m[1] in VIEWS else m[1], VIEWS[name]))

    for n in names:
        add(n)
    return "with " + ",\n".join(f"fx_{n} as ({t})" for n, t in out.items())
