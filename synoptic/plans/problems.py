"""Queries of the general problems: hierarchies (5) and nearness (6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from synoptic.operators import hierarchy as H
from synoptic.operators import nearby as N
from synoptic.runtime import read


def node_links(spark: SparkSession, d: str) -> DataFrame:
    groups = read(spark, d, "observatory_group").select(F.col("group_id").alias("node_id"), "lid")
    return H.links(read(spark, d, "pds_context"), groups, "node_id", "lid", "is_part_of", "has_part")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """One row for each node of pds_context that has a parent."""
    return H.ways(node_links(spark, d), "p5")


def p5_descendant_counts(spark: SparkSession, d: str) -> DataFrame:
    return H.hierarchy(node_links(spark, d), "p5").where("depth > 0").select("node_id", "n_descendants")


def p5_loops(spark: SparkSession, d: str) -> DataFrame:
    return H.loops(node_links(spark, d), "p5")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of sites at most 10 km apart."""
    pairs = N.points_within(read(spark, d, "iaumpc_site"), "site_id", "latitude", "longitude", 10.0)
    return pairs.select(F.col("a").alias("site_id_a"), F.col("b").alias("site_id_b"))


def p6_sites_in_zones(spark: SparkSession, d: str) -> DataFrame:
    """Sites by the zone that holds them: a band of diamonds along the equator (regions stated by their corners)."""
    zones = spark.createDataFrame([(z, [[-180.0 + 60 * z, 0.0], [-150.0 + 60 * z, 55.0], [-120.0 + 60 * z, 0.0], [-150.0 + 60 * z, -55.0]]) for z in range(6)], "zone bigint, ring array<array<double>>")
    held = N.points_in_regions(read(spark, d, "iaumpc_site"), "site_id", "latitude", "longitude", zones, "zone", "ring")
    return held.select(F.col("id").alias("site_id"), F.col("region").alias("zone"))


QUERIES = {"p6_found": p6_found, "p6_sites_in_zones": p6_sites_in_zones, "p5_found": p5_found, "p5_descendant_counts": p5_descendant_counts, "p5_loops": p5_loops}

_P5_LINKS = r"""
    recursive names as (
        select min(id) as id, ref from (
            select node_id as id, regexp_replace(lower(trim(lid, e' \t\n\r')), '::[0-9]+(\.[0-9]+)*$', '') as ref from pds_context
            union all select group_id, regexp_replace(lower(trim(lid, e' \t\n\r')), '::[0-9]+(\.[0-9]+)*$', '') from observatory_group)
        group by ref),
    stated as (
        select node_id as own, is_part_of as r, true as up from pds_context
        union all select node_id, unnest(has_part), false from pds_context),
    cleaned as (select own, regexp_replace(lower(trim(r, e' \t\n\r')), '::[0-9]+(\.[0-9]+)*$', '') as ref, up from stated where r is not null),
    up as (
        select case when up then own else id end as child, min(case when up then id else own end) as parent
        from cleaned join names using (ref) where own <> id group by 1),
    walk as (
        select child, parent as top, 1 as depth, cast(child as varchar) as path from up
        union all select w.child, u.parent, w.depth + 1, w.top || '/' || w.path from walk w join up u on w.top = u.child where w.depth < 300),
    good as (select child as node_id, top as root_id, depth, top || '/' || path as path from walk where top not in (select child from up))"""

_P6_SITES = """
    sites as (select distinct site_id, latitude as la, longitude as lo from iaumpc_site where latitude between -90 and 90
        and longitude between -180 and 360 and not isnan(latitude) and not isnan(longitude) and not (latitude = 0 and longitude = 0))"""

ORACLE_SQL = {
    "p6_found": f"""with {_P6_SITES}
        select a.site_id as site_id_a, b.site_id as site_id_b from sites a join sites b on a.site_id < b.site_id and abs(a.la - b.la) < 0.1
        where 2 * 6371.0088 * asin(least(1, sqrt(power(sin(radians(b.la - a.la) / 2), 2) + cos(radians(a.la)) * cos(radians(b.la)) * power(sin(radians(b.lo - a.lo) / 2), 2)))) <= 10""",
    "p6_sites_in_zones": f"""with {_P6_SITES}, wrapped as (select site_id, la, ((lo + 180) % 360 + 360) % 360 as x from sites)
        select site_id, cast(floor(x / 60) as bigint) as zone from wrapped where abs(x % 60 - 30) / 30 + abs(la) / 55 < 1""",
    "p5_found": f"""with {_P5_LINKS}
        select node_id, root_id, cast(depth as bigint) as depth, path from good
        union all select child, -1, -1, '' from up where child not in (select node_id from good)""",
    "p5_descendant_counts": f"""with {_P5_LINKS}, pairs as (
            select g.node_id as d, cast(unnest(string_split(path, '/')) as bigint) as a from good g)
        select g.node_id, cast(count(p.d) as bigint) as n_descendants from good g left join pairs p on p.a = g.node_id and p.d <> g.node_id group by 1""",
    "p5_loops": f"""with {_P5_LINKS}, around as (select child as node_id, min(top) as loop_id from walk group by 1 having count(*) filter (where top = child) > 0)
        select node_id, loop_id from around""",
}
