"""Queries of the engine's own operators over the whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from synoptic import model
from synoptic.functions import acronyms, answers, geo
from synoptic.functions import text as X
from synoptic.operators import changes, compare, embed, enrich, joins, publish, select, synsets, vote
from synoptic.operators.hierarchy import clean_reference
from synoptic.operators.nearby import haversine_km, usable
from synoptic.plans import strategy
from synoptic.runtime import Scratch, read
from synoptic.sources import readers, writers
from synoptic.streaming import refresh

QUERIES, ORACLE_SQL = {}, {}
_LONG = "(select distinct uri, attr, value from (select uri, 'label' as attr, label as value from wikidata_facility union all select uri, 'entity_type', entity_type from wikidata_facility union all select uri, 'start_date', start_date from wikidata_facility union all select uri, 'alt_label', unnest(alt_label) from wikidata_facility) where value is not null)"


def query(sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# Joins ---------------------------------------------------------------------------------------------------------------

_SITE_LABELS = """select distinct site_id as a, lower(trim(label)) as v, 'label' as f from iaumpc_site where label is not null
    union select site_id, lower(trim(u)), 'alt_label' from (select site_id, unnest(alt_label) as u from iaumpc_site) where u is not null"""
_ITEM_LABELS = """select distinct item_id as b, lower(trim(label)) as v, 'label' as f from wikidata_facility where label is not null
    union select item_id, lower(trim(u)), 'alt_label' from (select item_id, unnest(alt_label) as u from wikidata_facility) where u is not null"""


@query(f"with s as ({_SITE_LABELS}), i as ({_ITEM_LABELS}) select a, b, min(s.f) as field_a, min(i.f) as field_b from s join i using (v) where length(v) >= 5 group by a, b")
def label_equi_join(spark: SparkSession, d: str) -> DataFrame:
    return joins.label_matches(read(spark, d, "iaumpc_site"), "site_id", read(spark, d, "wikidata_facility"), "item_id")


@query("""select distinct r.rec_id as a, g.group_id as b from spase_record r join observatory_group g on lower(trim(r.nssdca_id)) = lower(trim(g.nssdca_id)) where trim(r.nssdca_id) <> ''""")
def identifier_join(spark: SparkSession, d: str) -> DataFrame:
    return joins.merge_on(read(spark, d, "spase_record"), "rec_id", "nssdca_id", read(spark, d, "observatory_group"), "group_id", "nssdca_id")


@query("""with k as (select lower(trim(alt)) as v, min(facility_id) as b from (select facility_id, unnest(alt_label) as alt from aas_keyword) where trim(alt) <> '' group by 1 having count(distinct facility_id) = 1)
    select distinct mention_id as a, b from facility_mention join k on lower(trim(label)) = v""")
def unambiguous_key_join(spark: SparkSession, d: str) -> DataFrame:
    return joins.unambiguous_join(read(spark, d, "facility_mention"), "mention_id", "label", read(spark, d, "aas_keyword"), "facility_id", "alt_label")


@query(f"with s as ({_SITE_LABELS}), i as ({_ITEM_LABELS}) select distinct site_id, code from iaumpc_site where site_id not in (select a from s join i using (v) where length(v) >= 5)")
def not_equivalent_anti(spark: SparkSession, d: str) -> DataFrame:
    sites = read(spark, d, "iaumpc_site")
    return joins.not_equivalent(sites.select("site_id", "code").distinct(), "site_id", label_equi_join(spark, d), "a")


@query("""with t as (select distinct node_id, lower(trim(lid)) as lid, lower(trim(is_part_of)) as up from pds_context),
    e as (select distinct lid as src, up as dst from t where lid is not null and up is not null and lid <> up),
    b as (select src, dst, 'is_part_of' as relation from e union select dst, src, 'has_part' from e)
    select src, dst, relation from b where src in (select lid from t) and dst in (select lid from t)""")
def reciprocal_edges(spark: SparkSession, d: str) -> DataFrame:
    t = read(spark, d, "pds_context").select(F.lower(F.trim("lid")).alias("lid"), F.lower(F.trim("is_part_of")).alias("up"))
    return joins.reciprocal(t, "lid", "up", t, "lid")


@query(r"""with known as (select lower(trim(lid)) as lid from pds_context where lid is not null), refs as (select distinct regexp_replace(lower(trim(is_part_of, e' \t\n\r')), '::[0-9]+(\.[0-9]+)*$', '') as uri from pds_context where is_part_of is not null)
    select uri, replace(regexp_extract(uri, '([^:/]*)$', 1), '-', ' ') as label, nullif(regexp_extract(uri, '([^:/]*)[:/][^:/]*$', 1), '') as entity_type from refs where uri <> '' and uri not in (select lid from known)""")
def placeholder_rows(spark: SparkSession, d: str) -> DataFrame:
    nodes = read(spark, d, "pds_context").select(clean_reference(F.col("is_part_of")).alias("ref"), F.lower(F.trim("lid")).alias("lid"))
    return joins.placeholders(nodes, "ref", nodes, "lid")


@query("""with recursive up as (select n_nationkey as k, 'n' || n_nationkey as id, 'r' || n_regionkey as above from nation union all select s_suppkey, 's' || s_suppkey, 'n' || s_nationkey from supplier), w as (select id, above from up union select w.id, u.above from w join up u on w.above = u.id) select id, above from w""")
def class_closure(spark: SparkSession, d: str) -> DataFrame:
    """Everything above each node: the property path of one or more steps."""
    t = _tree(spark, d).where("up is not null").select("id", F.col("up").alias("above"))
    return joins.closed(t, "id", "above")


_MERGED = r"""r as (select distinct rec_id as id, coalesce(entity_type, '') as kind, label, alt_label, code, prior_id, nssdca_id, latitude as la, longitude as lo, start_date from spase_record),
    ident as (select distinct id, kind, v from (select id, kind, lower(trim(u)) as v from (select id, kind, unnest(list_concat([code, nssdca_id], coalesce(prior_id, []::varchar[]))) as u from r)) where regexp_matches(v, '[a-z0-9]') and v not in {none}),
    guard as (select id, v as g from (select distinct id, lower(trim(nssdca_id)) as v from r) where regexp_matches(v, '[a-z0-9]') and v not in {none}),
    names as (select distinct id, u as name from (select id, unnest(list_concat([label], coalesce(alt_label, []::varchar[]))) as u from r) where u is not null),
    w as (select distinct r.id, kind, coalesce(try_cast(regexp_extract(label, '(\d+)$', 1) as bigint), 0) as num, regexp_extract(name, '^[^-. ]*') as word, nullif(regexp_extract(lower(rtrim(trim(code), '.')), '([^/]*)$', 1), '') as leaf, start_date, la, lo, g,
        coalesce(not isnan(la) and not isnan(lo) and la between -90 and 90 and lo between -180 and 360 and not (la = 0 and lo = 0), false) as placed from r join names using (id) left join guard using (id) where regexp_extract(name, '^[^-. ]*') <> ''),
    pairs as (select a.id as x, b.id as y from ident a join ident b on a.kind = b.kind and a.v = b.v and a.id < b.id
        union select a.id, b.id from w a join w b on a.kind = b.kind and a.num = b.num and a.word = b.word and a.id < b.id and (a.g is null or b.g is null or a.g = b.g) where a.leaf = b.leaf
            or (a.placed and b.placed and 2 * 6371.0088 * asin(least(1, sqrt(power(sin(radians(b.la - a.la) / 2), 2) + cos(radians(a.la)) * cos(radians(b.la)) * power(sin(radians(b.lo - a.lo) / 2), 2)))) < 4)
            or (not (a.placed and b.placed) and a.start_date = b.start_date)
            or exists (select 1 from names m join names n on replace(lower(m.name), '-', ' ') = replace(lower(n.name), '-', ' ') where m.id = a.id and n.id = b.id)),
    both_ways as (select x, y from pairs union select y, x from pairs),
    reach as (select distinct x as id, x as low from both_ways union select e.y, r.low from reach r join both_ways e on e.x = r.id and r.low < e.y)""".replace("{none}", str(joins.NO_IDENTIFIER))


@query(f"with recursive {_MERGED} select id as rec_id, min(low) as merged_id from reach group by id")
def self_merge(spark: SparkSession, d: str) -> DataFrame:
    """Records of one class that are the same by an identifier, or by name and leaf, place, start or label."""
    none = F.array().cast("array<string>")
    ids = F.concat(F.array("code", "nssdca_id"), F.coalesce("prior_id", none))
    guard = F.lower(F.trim("nssdca_id"))
    guard = F.when(guard.rlike("[a-z0-9]") & ~guard.isin(*joins.NO_IDENTIFIER), guard)
    leaf = F.regexp_extract(F.lower(F.regexp_replace(F.trim("code"), r"\.+$", "")), "([^/]*)$", 1)
    labels = F.array_compact(F.concat(F.array("label"), F.coalesce("alt_label", none)))
    rows = read(spark, d, "spase_record").select(F.col("rec_id").alias("id"), F.col("entity_type").alias("kind"), ids.alias("ids"), guard.alias("guard"), F.coalesce(X.suffix_numbers("label"), F.lit(0)).alias("number"), labels.alias("labels"), leaf.alias("leaf"), "latitude", "longitude", F.col("start_date").alias("start")).distinct()
    return joins.self_merge(rows).select(F.col("id").alias("rec_id"), F.col("group").alias("merged_id"))


@query(r"""with recursive t as (select distinct node_id as id, regexp_replace(lower(trim(is_part_of, e' \t\n\r')), '::[0-9]+(\.[0-9]+)*$', '') as host, lower(trim(label)) as label, substr(lower(label), 1, 2) as word from pds_context where is_part_of is not null),
    pairs as (select a.id as x, b.id as y from t a join t b on a.host = b.host and a.id <> b.id and (a.label = b.label or a.word = b.word and a.word <> '')),
    reach as (select distinct x as id, x as low from pairs union select e.y, r.low from reach r join pairs e on e.x = r.id and r.low < e.y)
    select id as node_id, min(low) as merged_id from reach group by id""")
def instrument_merge(spark: SparkSession, d: str) -> DataFrame:
    """Nodes of one host with a label, or what stands for their file name (its first letters), in common."""
    rows = read(spark, d, "pds_context").select(F.col("node_id").alias("id"), clean_reference(F.col("is_part_of")).alias("host"), "label", F.substring(F.lower("label"), 1, 2).alias("word")).distinct()
    return joins.merge_within(rows, "host", ["label", "word"]).select(F.col("id").alias("node_id"), F.col("group").alias("merged_id"))


@query(f"""with i as (select distinct rec_id, entity_type, lower(trim(u)) as v from (select rec_id, entity_type, unnest(list_concat([code, nssdca_id], coalesce(prior_id, []::varchar[]))) as u from spase_record where coalesce(entity_type, '') <> 'instrument') where u is not null),
    k as (select * from i where regexp_matches(v, '[a-z0-9]') and v not in {joins.NO_IDENTIFIER}), m as (select entity_type, v, min(rec_id) as a from k group by 1, 2)
    select distinct a, rec_id as b from k join m on k.v = m.v and k.entity_type is not distinct from m.entity_type where a < rec_id""")
def self_merge_identifiers(spark: SparkSession, d: str) -> DataFrame:
    """Records of one class that share an identifier, old or new, linked to the first of them."""
    rows = read(spark, d, "spase_record").where("coalesce(entity_type, '') <> 'instrument'")
    return joins.identifier_links(rows, "rec_id", ["entity_type"], ["code", "nssdca_id", "prior_id"])


@query("""with s as (select distinct site_id, label, latitude as la, longitude as lo, alt_label[1] as address, code from iaumpc_site)
    select site_id, case when not isnan(la) and not isnan(lo) and la between -90 and 90 and lo between -180 and 360 and not (la = 0 and lo = 0) then 1.0::double when contains(address, ' ') then 0.75::double when contains(label, ', ') then 0.5::double when label is not null then 0.25::double else 1.0::double end as confidence,
    case when not isnan(la) and not isnan(lo) and la between -90 and 90 and lo between -180 and 360 and not (la = 0 and lo = 0) then 'position' when contains(address, ' ') then address when contains(label, ', ') then split_part(label, ', ', 2) when label is not null then label else code end as place from s""")
def location_ladder(spark: SparkSession, d: str) -> DataFrame:
    """Each site's place and how sure it is: by its position, its address (the first other name), the location in its label,
    the label, or its country (the code)."""
    sites = read(spark, d, "iaumpc_site").select("site_id", "label", "latitude", "longitude", F.get("alt_label", F.lit(0)).alias("address"), "code").distinct()
    has = lambda c, part: F.coalesce(F.contains(c, F.lit(part)), F.lit(False))
    location = F.get(F.split("label", ", "), F.lit(1))
    found = geo.resolved((usable(F.col("latitude"), F.col("longitude")), F.lit("position"), 1.0), (has("address", " "), F.col("address"), 0.75), (has("label", ", "), location, 0.5), (F.col("label").isNotNull(), F.col("label"), 0.25), (F.lit(True), F.col("code"), 1.0))
    return sites.select("site_id", found["confidence"].alias("confidence"), found["place"].alias("place"))


@query("""with m as (select l_partkey::varchar as a, l_suppkey::varchar as b, max(l_returnflag) as f, min(l_discount) as score from lineitem group by 1, 2)
    select 'set|' || a || '|' || b as mapping_id, 'set' as set_id, a as subject_id, case f when 'R' then 'differentFrom' when 'A' then 'broadMatch' else 'exactMatch' end as predicate_id, b as object_id, score as similarity_score, case f when 'N' then 'label' else 'hybrid' end as similarity_measure, case f when 'N' then 'lexical' else 'validated' end as justification_type, 'driver' as creator, false as deprecated from m""")
def mapping_facts(spark: SparkSession, d: str) -> DataFrame:
    """Rows of a mapping table, one for each decided pair, negative ones among them."""
    flag = F.max("l_returnflag")
    predicate = F.when(flag == "R", "differentFrom").when(flag == "A", "broadMatch").otherwise("exactMatch")
    pairs = read(spark, d, "lineitem").groupBy(F.col("l_partkey").cast("string").alias("a"), F.col("l_suppkey").cast("string").alias("b")).agg(predicate.alias("predicate"), F.when(flag == "N", "lexical").otherwise("validated").alias("justification"), F.min("l_discount").alias("score"))
    return strategy.mapping_rows(pairs.withColumn("scores", F.lit(None).cast("map<string,double>")), "set", "driver").drop("scores")


@query("""with e as (select distinct synset_id as s, rec_id as r from synset_record), f as (select min(r) as lo, max(r) as hi from e group by s having count(*) > 1)
    select lo as src, hi as dst, 'broadMatch' as relation from f union all select hi, lo, 'narrowMatch' from f""")
def broad_narrow(spark: SparkSession, d: str) -> DataFrame:
    """Relations between records, with their inverse."""
    pairs = read(spark, d, "synset_record").groupBy("synset_id").agg(F.min("rec_id").alias("src"), F.max("rec_id").alias("dst")).where("src <> dst")
    return joins.related(pairs, "src", "dst", "broadMatch", "narrowMatch")


@query("""with e as (select distinct synset_id, label from synset_record where label is not null), s as (select synset_id, length(label) / 10.0 as x from e), t as (select synset_id, x, 1 / (1 + exp(-x)) as g from s), l as (select avg(g) as m, stddev_pop(g) as d from t)
    select synset_id, round(max(x), 6) as x from t, l where g >= case when d < 0.01 then 0.6 else m + 0.3 * d end group by 1""")
def high_scores(spark: SparkSession, d: str) -> DataFrame:
    """Scores that stand out by their logistic value."""
    rows = read(spark, d, "synset_record").where("label is not null").select("synset_id", "label").distinct().select("synset_id", (F.length("label") / 10.0).alias("x"))
    return compare.high_scores(rows, "x").groupBy("synset_id").agg(F.round(F.max("x"), 6).alias("x"))


@query("""with renamed as (select distinct trim(u) as old, min(code) as new from (select code, unnest(prior_id) as u from spase_record where code is not null) where trim(u) like 'spase://%' group by 1),
    e as (select distinct code as src, is_part_of as dst from spase_record where code is not null and is_part_of is not null)
    select distinct coalesce(a.new, src) as src, coalesce(b.new, dst) as dst from e left join renamed a on a.old = src left join renamed b on b.old = dst where coalesce(a.new, src) <> coalesce(b.new, dst)""")
def rewritten_links(spark: SparkSession, d: str) -> DataFrame:
    records = read(spark, d, "spase_record")
    priors = records.where("code is not null").select("code", F.explode("prior_id").alias("u")).select(F.trim("u").alias("old"), "code").where("old like 'spase://%'")
    merged = priors.groupBy("old").agg(F.min("code").alias("new"))
    edges = records.select(F.col("code").alias("src"), F.col("is_part_of").alias("dst")).where("src is not null and dst is not null").distinct()
    return joins.rewritten(edges, merged)


@query("""with names as (select lower(label) as l, min(code) as new from aas_keyword group by 1)
    select m.mention_id, coalesce(n.new, m.label) as label from (select distinct mention_id, label from facility_mention where label is not null) m left join names n on lower(m.label) = n.l""")
def old_to_new_lookup(spark: SparkSession, d: str) -> DataFrame:
    mentions = read(spark, d, "facility_mention").where("label is not null").select("mention_id", "label").distinct()
    names = read(spark, d, "aas_keyword").groupBy(F.lower("label").alias("l")).agg(F.min("code").alias("new"))
    return mentions.join(names, F.lower("label") == F.col("l"), "left").select("mention_id", F.coalesce("new", "label").alias("label"))


@query("""select distinct rec_id, code from spase_record where rec_id not in (select rec_id from spase_record where entity_type in ('airborne', 'unknown')) and rec_id not in (select rec_id from spase_record where lower(label) like '%a')""")
def minus_exclusion(spark: SparkSession, d: str) -> DataFrame:
    records = read(spark, d, "spase_record")
    return joins.excluded(records.select("rec_id", "code").distinct(), "rec_id", [records.where(F.col("entity_type").isin("airborne", "unknown")), records.where(F.lower("label").like("%a"))])


@query(r"""with l as (select distinct site_id, case when regexp_matches(label, '[A-Z]') then label || ' (' || regexp_replace(label, '[^A-Z]', '', 'g') || ')' else label end as label from iaumpc_site where label is not null),
    c as (select *, trim(regexp_replace(regexp_replace(trim(label), '\s*\([^(]+?\)', ' ', 'g'), '\s+', ' ', 'g')) as name, regexp_extract_all(trim(label), '\(([^(]+?)\)', 1) as found from l),
    a as (select *, case when len(found) = 1 and ends_with(trim(label), ')') and trim(found[1]) = regexp_replace(name, '[^A-Z]', '', 'g') and length(trim(found[1])) <= length(name) / 3.0 then trim(found[1]) else '' end as acronym from c),
    f as (select site_id, label as form, 0 as o, 'label' as kind from a union all select site_id, name, 1, 'name' from a union all select site_id, acronym, 2, 'acronym' from a
        union all select site_id, trim(string_split(name, x)[1]), 3, 'short' from a, (values (' at '), (',')) d(x) where len(string_split(name, x)) = 2 and trim(string_split(name, x)[2]) <> '')
    select site_id, form, arg_min(kind, o) as kind from f where form <> '' group by 1, 2""")
def label_forms(spark: SparkSession, d: str) -> DataFrame:
    """Forms under which each site can be found: with and without its acronym (the capitals of its label), the acronym, and
    without a place."""
    capitals = F.regexp_replace("label", "[^A-Z]", "")
    rows = read(spark, d, "iaumpc_site").where("label is not null").select("site_id", F.when(capitals != "", F.concat("label", F.lit(" ("), capitals, F.lit(")"))).otherwise(F.col("label")).alias("label")).distinct()
    return enrich.label_forms(rows, "site_id", "label")


@query("""with r as (select distinct synset_id, r.entity_type as t from synset_record s join spase_record r on s.rec_id = r.rec_id where r.entity_type is not null), g as (select synset_id, list_sort(list(distinct t)) as ts from r group by 1)
    select synset_id, array_to_string(case when list_has_any(ts, ['spacecraft', 'airborne', 'investigation']) then list_filter(ts, lambda x: x <> 'ground observatory') else ts end, '|') as types from g""")
def united_types(spark: SparkSession, d: str) -> DataFrame:
    """Classes of records that share a synset."""
    kinds = read(spark, d, "spase_record").select("rec_id", "entity_type").where("entity_type is not null").distinct()
    rows = read(spark, d, "synset_record").select("synset_id", "rec_id").distinct().join(kinds, "rec_id")
    return enrich.united_types(rows, "synset_id", "entity_type", "ufo").select("synset_id", F.array_join("types", "|").alias("types"))


@query("""select uri, arg_min(label, (case when lang = 'en' then 0 else 1 end, coalesce(lang, ''), label)) as label from skos_label where label is not null group by 1""")
def reference_labels(spark: SparkSession, d: str) -> DataFrame:
    return enrich.reference_labels(read(spark, d, "skos_label"), "uri", "label", "lang")


@query("""with r as (select facility_id, 'recorded ' || code as text from aas_keyword where facility_id % 3 = 0) select k.facility_id, coalesce(r.text, k.label) as label from aas_keyword k left join r using (facility_id)""")
def recorded_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels, replaced by recorded ones where there are some."""
    rows = read(spark, d, "aas_keyword").select("facility_id", "label", "code")
    recorded = rows.where("facility_id % 3 = 0").select("facility_id", F.concat(F.lit("recorded "), "code").alias("text"))
    return enrich.with_recorded(rows, "facility_id", "label", recorded).select("facility_id", "label")


@query("""with a as (select distinct mention_id, label, case when alt_label is null then 'narrow' when label = alt_label then 'same' when length(label) > length(alt_label) then 'broad' when contains(label, ' ') then 'distinct' else 'unclear' end as word from facility_mention where label is not null)
    select mention_id, case word when 'narrow' then 'narrowMatch' when 'same' then 'exactMatch' when 'broad' then 'broadMatch' when 'distinct' then 'differentFrom' end as relation from a""")
def answer_decisions(spark: SparkSession, d: str) -> DataFrame:
    """Decisions read from answers about the two names of a mention, as relations."""
    word = F.when(F.col("alt_label").isNull(), "narrow").when(F.col("label") == F.col("alt_label"), "Same").when(F.length("label") > F.length("alt_label"), "BROAD").when(F.contains("label", F.lit(" ")), "distinct").otherwise("unclear")
    text = F.concat(F.lit("<think>same or distinct or broad? "), F.coalesce("alt_label", F.lit("")), F.lit("</think>"), "label", F.lit(" is "), word, F.lit(", as far as I can see."))
    return read(spark, d, "facility_mention").where("label is not null").select("mention_id", answers.relation(answers.decision(text)).alias("relation")).distinct()


@query("""select distinct rec_id, case entity_type when 'space mission' then 'investigation' when 'observatory network' then 'ground observatory' when 'unknown' then 'ufo' else entity_type end as category from spase_record where entity_type is not null""")
def answer_categories(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "spase_record").where("entity_type is not null").select("rec_id", answers.category(F.col("entity_type")).alias("category")).distinct()


@query("""with long as (select distinct uri, attr, value from (select uri, 'label' as attr, label as value from wikidata_facility union all select uri, 'entity_type', entity_type from wikidata_facility union all select uri, 'start_date', start_date from wikidata_facility union all select uri, 'alt_label', unnest(alt_label) from wikidata_facility) where value is not null),
    p as (select uri, attr, list(value order by value) as v from long group by 1, 2) select uri, cast(to_json(map(list(attr order by attr), list(v order by attr))) as varchar) as json from p group by 1""")
def entity_json(spark: SparkSession, d: str) -> DataFrame:
    return enrich.as_json(_attributes(spark, d))


@query("""with s as (select distinct synset_id, label from synset_record where label is not null) select r.rec_id, min(s.label) as label from (select distinct rec_id, synset_id from synset_record) r join s using (synset_id) group by 1""")
def values_with_synonyms(spark: SparkSession, d: str) -> DataFrame:
    """The smallest label of each record, over its synonyms."""
    rows = read(spark, d, "synset_record").select("rec_id", "synset_id", "label").distinct()
    return enrich.unique_value(rows, "rec_id", "label", "synset_id")


@query("""select distinct node_id, label from pds_context where entity_type in ('instrument', 'telescope') and label is not null and is_part_of is not null and not coalesce(deprecated, false) and lower(trim(lid)) not in (select lower(trim(lid)) from observatory_group)""")
def entity_list(spark: SparkSession, d: str) -> DataFrame:
    """Nodes of two classes that have a label and a parent, are not deprecated and have no synonym in the other list."""
    nodes = read(spark, d, "pds_context").withColumn("l", F.lower(F.trim("lid")))
    groups = read(spark, d, "observatory_group").select(F.lower(F.trim("lid")).alias("l"))
    return enrich.entity_list(nodes, "entity_type", ["instrument", "telescope"], ["label", "is_part_of"], "deprecated").join(groups, "l", "left_anti").select("node_id", "label").distinct()


@query("""with l as (select distinct rec_id, lower(label) as v from spase_record where label is not null) select a.rec_id as a, b.rec_id as b from (select v, min(rec_id) as rec_id from l group by 1 having count(*) > 1) a join l b using (v) where a.rec_id <> b.rec_id""")
def duplicate_labels(spark: SparkSession, d: str) -> DataFrame:
    """Records that share a label, each with the smallest of them."""
    rows = read(spark, d, "spase_record").where("label is not null").select("rec_id", F.lower("label").alias("v")).distinct()
    return publish.collapsed(rows, "rec_id", F.col("v")).select(F.col("new").alias("a"), F.col("old").alias("b"))


@query("""with m as (select distinct least(l_partkey, l_suppkey) as x, greatest(l_partkey, l_suppkey) as y from lineitem where l_partkey <> l_suppkey), g as (select distinct o_custkey as p, o_orderkey % 1000 as q from orders)
    select p, q, m.x is not null as mapped from g left join m on least(p, q) = x and greatest(p, q) = y""")
def mapped_either_way(spark: SparkSession, d: str) -> DataFrame:
    """Whether stated pairs are mapped, in either direction."""
    m = read(spark, d, "lineitem").where("l_partkey <> l_suppkey")
    return joins.mapped_either_way(read(spark, d, "orders").select(F.col("o_custkey").alias("p"), (F.col("o_orderkey") % 1000).alias("q")).distinct(), m, "p", "q", "l_partkey", "l_suppkey")


@query(f"select uri, attr, value from {_LONG} where not (attr = 'alt_label' and length(value) < 5)")
def removed_values(spark: SparkSession, d: str) -> DataFrame:
    """Attributes without short alternative labels."""
    rows = _attributes(spark, d)
    return enrich.without_values(rows, rows.where("attr = 'alt_label' and length(value) < 5")).select("uri", "attr", "value")


# Filters -------------------------------------------------------------------------------------------------------------


@query("""with recursive names(n, c) as (values ('space mission', 'investigation'), ('observatory network', 'ground observatory'), ('unknown', 'ufo'), ('instrument_host', 'spacecraft'), ('facility', 'ground observatory')),
    above(sub, sup) as (values ('observation facility', 'ufo'), ('ground facility', 'observation facility'), ('space facility', 'observation facility'), ('survey', 'observation facility'), ('platform', 'ufo'), ('instrument', 'ufo'), ('ground observatory', 'ground facility'), ('ground observatory', 'platform'), ('telescope', 'ground facility'), ('telescope', 'space facility'), ('telescope', 'instrument'), ('telescope', 'platform'), ('spacecraft', 'space facility'), ('spacecraft', 'platform'), ('airborne', 'space facility'), ('airborne', 'platform'), ('investigation', 'spacecraft')),
    up as (select sub, sup from above union select u.sub, a.sup from up u join above a on u.sup = a.sub),
    one as (select coalesce(c, lower(trim(entity_type))) as t, count(*) as n from (select distinct rec_id, entity_type from spase_record) left join names on n = lower(trim(entity_type)) where entity_type is not null group by 1),
    two as (select coalesce(c, lower(trim(entity_type))) as t, count(*) as n from (select distinct item_id, entity_type from wikidata_facility) left join names on n = lower(trim(entity_type)) where entity_type is not null group by 1)
    select one.t as type_a, two.t as type_b, one.n * two.n as pairs from one, two where one.t = two.t or exists (select 1 from up where (sub = one.t and sup = two.t) or (sub = two.t and sup = one.t))""")
def type_compat_filter(spark: SparkSession, d: str) -> DataFrame:
    """Compatible classes of two lists, with the number of pairs that they stand for."""
    def classes(table: str, key: str) -> DataFrame:
        return read(spark, d, table).select(key, model.class_of(F.col("entity_type")).alias("t")).where("t is not null").distinct().groupBy("t").count()

    one, two = classes("spase_record", "rec_id").toDF("type_a", "n1"), classes("wikidata_facility", "item_id").toDF("type_b", "n2")
    return one.crossJoin(F.broadcast(two)).where(model.types_compatible(F.array("type_a"), F.array("type_b"))).select("type_a", "type_b", (F.col("n1") * F.col("n2")).alias("pairs"))


_DATED = """with i as (select distinct item_id, lower(label) as l, nullif(regexp_extract(start_date, '^[+]?([0-9]{4})', 1), '') as y from wikidata_facility where label is not null)"""


@query(f"{_DATED} select a.item_id as a, b.item_id as b from i a join i b on a.l = b.l and a.item_id < b.item_id where a.y is null or b.y is null or a.y = b.y")
def year_overlap_filter(spark: SparkSession, d: str) -> DataFrame:
    """Items with the same label whose years do not contradict."""
    items = read(spark, d, "wikidata_facility").where("label is not null").select(F.col("item_id").alias("a"), F.lower("label").alias("l"), compare.years(F.array_compact(F.array("start_date"))).alias("y1")).distinct()
    others = items.select(F.col("a").alias("b"), "l", F.col("y1").alias("y2"))
    return items.join(others, "l").where((F.col("a") < F.col("b")) & compare.date_filter([(F.col("y1"), F.col("y2"))])).select("a", "b")


@query("""with s as (select distinct site_id, lower(label) as l, latitude as la, longitude as lo from iaumpc_site), i as (select distinct item_id, lower(label) as l, latitude as la, longitude as lo from wikidata_facility),
    p as (select site_id as a, item_id as b, s.la as la1, s.lo as lo1, i.la as la2, i.lo as lo2,
        coalesce(not isnan(s.la) and not isnan(s.lo) and s.la between -90 and 90 and s.lo between -180 and 360 and not (s.la = 0 and s.lo = 0), false) and coalesce(not isnan(i.la) and not isnan(i.lo) and i.la between -90 and 90 and i.lo between -180 and 360 and not (i.la = 0 and i.lo = 0), false) as both_usable from s join i using (l))
    select distinct a, b from p where not both_usable or 2 * 6371.0088 * asin(least(1, sqrt(power(sin(radians(la2 - la1) / 2), 2) + cos(radians(la1)) * cos(radians(la2)) * power(sin(radians(lo2 - lo1) / 2), 2)))) <= 10""")
def distance_filter(spark: SparkSession, d: str) -> DataFrame:
    """Sites and items of one label, unless their positions are over 10 km apart."""
    sites = read(spark, d, "iaumpc_site").select(F.col("site_id").alias("a"), F.lower("label").alias("l"), F.col("latitude").alias("la1"), F.col("longitude").alias("lo1")).distinct()
    items = read(spark, d, "wikidata_facility").select(F.col("item_id").alias("b"), F.lower("label").alias("l"), F.col("latitude").alias("la2"), F.col("longitude").alias("lo2")).distinct()
    return sites.join(items, "l").where(compare.distance_filter(F.col("la1"), F.col("lo1"), F.col("la2"), F.col("lo2"), [])).select("a", "b").distinct()


@query("""with r as (select distinct rec_id, lower(label) as l, list_filter(coalesce(prior_id, []::varchar[]), lambda x: x is not null) as ids from spase_record where label is not null)
    select a.rec_id as a, b.rec_id as b from r a join r b on a.l = b.l and a.rec_id < b.rec_id where len(a.ids) = 0 or len(b.ids) = 0 or list_has_any(a.ids, b.ids)""")
def identifier_overlap(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "spase_record").where("label is not null").select(F.col("rec_id").alias("a"), F.lower("label").alias("l"), F.array_compact(F.coalesce("prior_id", F.array().cast("array<string>"))).alias("i1")).distinct()
    others = rows.select(F.col("a").alias("b"), "l", F.col("i1").alias("i2"))
    return rows.join(others, "l").where((F.col("a") < F.col("b")) & compare.overlap_filter(F.col("i1"), F.col("i2"))).select("a", "b")


@query("""with f as (select facility_id as a, aperture as x, regexp_extract(label, '^(\\S+ \\S+)', 1) as n from aas_keyword)
    select f.a, g.a as b from f join f g on f.n = g.n and f.a < g.a where f.x is null or g.x is null or abs(f.x - g.x) <= 0.05 * greatest(f.x, g.x)""")
def aperture_filter(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "aas_keyword").select(F.col("facility_id").alias("a"), F.regexp_extract("label", r"^(\S+ \S+)", 1).alias("n"), F.array_compact(F.array("aperture")).alias("x1"))
    others = rows.select(F.col("a").alias("b"), "n", F.col("x1").alias("x2"))
    return rows.join(others, "n").where((F.col("a") < F.col("b")) & compare.aperture_filter(F.col("x1"), F.col("x2"))).select("a", "b")


@query(r"""with f as (select facility_id as a, regexp_extract(label, '^(\S+ \S+)', 1) as n, coalesce(try_cast(regexp_extract(label, ' ([0-9]+)(?:[.][0-9]+m)?$', 1) as bigint), 0) as k from aas_keyword)
    select f.a, g.a as b from f join f g on f.n = g.n and f.a < g.a where f.k = g.k""")
def number_filter(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "aas_keyword").select(F.col("facility_id").alias("a"), F.regexp_extract("label", r"^(\S+ \S+)", 1).alias("n"), F.array(X.suffix_numbers("label")).alias("k1"))
    others = rows.select(F.col("a").alias("b"), "n", F.col("k1").alias("k2"))
    return rows.join(others, "n").where((F.col("a") < F.col("b")) & compare.number_filter(F.col("k1"), F.col("k2"))).select("a", "b")


# Scores --------------------------------------------------------------------------------------------------------------


@query()
def token_sort_scores(spark: SparkSession, d: str) -> DataFrame:
    """How alike both labels of a mention are."""
    return read(spark, d, "facility_mention").where("alt_label is not null and label is not null").select("mention_id", "label", "alt_label").distinct().select("mention_id", F.round(X.token_sort_ratio("label", "alt_label"), 9).alias("score"))


@query("""select distinct mention_id, levenshtein(regexp_replace(lower(label), '[^a-z0-9 ]', '', 'g'), regexp_replace(lower(alt_label), '[^a-z0-9 ]', '', 'g')) as edits from facility_mention where label is not null and alt_label is not null""")
def levenshtein_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Edits between both labels, of their plain letters and digits (the SQL counts bytes)."""
    bare = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9 ]", "")
    return read(spark, d, "facility_mention").where("label is not null and alt_label is not null").select("mention_id", F.levenshtein(bare("label"), bare("alt_label")).cast("bigint").alias("edits")).distinct()


@query(r"""select distinct rec_id, array_to_string(list_sort(list_filter(regexp_split_to_array(lower(label), '\s+'), lambda x: x <> '')), ' ') as key from spase_record""")
def token_sort_key(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "spase_record").select("rec_id", X.token_sort_key(F.col("label")).alias("key")).distinct()


@query()
def acronym_scores(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "aas_keyword").select("facility_id", F.round(acronyms.acronym_score("code", "label"), 9).alias("score"))


@query()
def digit_inclusion(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "facility_mention").where("alt_label is not null and label is not null").select("mention_id", "label", "alt_label").distinct()
    return rows.select("mention_id", X.digit_score(X.numbers_in(F.col("label")), X.numbers_in(F.col("alt_label"))).alias("score"))


@query(r"""with w as (select facility_id, substr(u, 1, 5) as term from (select rec_id as facility_id, unnest(regexp_extract_all(lower(label), '(\p{L}+|\d+)')) as u from (select distinct rec_id, label from spase_record))),
    tf as (select facility_id, term, count(*) as tf from w group by 1, 2), df as (select term, count(*) as df from tf group by 1), n as (select count(*) as n from (select distinct rec_id, label from spase_record) where label is not null),
    r as (select facility_id, tf.term, tf, tf * (ln((1 + n) / (1 + df)) + 1) as raw from tf join df using (term), n)
    select facility_id as rec_id, term, tf, round(raw / sqrt(sum(raw * raw) over (partition by facility_id)), 6) as weight from r""")
def tfidf_weights(spark: SparkSession, d: str) -> DataFrame:
    return embed.tfidf(read(spark, d, "spase_record").select("rec_id", "label").distinct(), "rec_id", "label").select("rec_id", "term", "tf", F.round("weight", 6).alias("weight"))


@query("""with q as (select vec_id, embedding from embeddings where vec_id % 100 = 0), p as (select q.vec_id as query, e.vec_id, round(list_cosine_similarity(q.embedding::double[], e.embedding::double[]), 9) as score from q, embeddings e where q.vec_id <> e.vec_id),
    r as (select *, row_number() over (partition by query order by score desc, vec_id) as rank from p) select query, vec_id, round(score, 6) as score, cast(rank as integer) as rank from r where rank <= 10""")
def cosine_topk(spark: SparkSession, d: str) -> DataFrame:
    """The stated queries (ids divisible by 100) against all vectors."""
    base = read(spark, d, "embeddings")
    return embed.cosine_top_k(base.where("vec_id % 100 = 0"), base, "vec_id", "embedding", 10).withColumn("score", F.round("score", 6))


@query("""with s as (select l_orderkey, l_linenumber, l_discount * 10 as s1, case when l_tax > 0.04 then l_tax * 10 end as s2 from lineitem)
    select l_orderkey, l_linenumber, round(case when s2 is null then s1 else (s1 * 0.7 + s2 * 0.3) end, 9) as score from s""")
def hybrid_score(spark: SparkSession, d: str) -> DataFrame:
    parts = {"one": (F.col("l_discount") * 10, 0.7), "two": (F.when(F.col("l_tax") > 0.04, F.col("l_tax") * 10), 0.3)}
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(compare.hybrid_score(parts)[0], 9).alias("score"))


# Selection -----------------------------------------------------------------------------------------------------------


@query("""with l as (select avg(p) + 0.385 * stddev_pop(p) as t from (select distinct l_extendedprice as p from lineitem)) select l_orderkey, l_linenumber, l_extendedprice from lineitem, l where l_extendedprice >= t""")
def zscore_cut(spark: SparkSession, d: str) -> DataFrame:
    return select.zscore_cut(read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"), "l_extendedprice")


@query("""with r as (select l_partkey, l_orderkey, l_linenumber, l_extendedprice, row_number() over (partition by l_partkey order by l_extendedprice desc, l_orderkey, l_linenumber) as rank from lineitem) select l_partkey, l_orderkey, l_linenumber, l_extendedprice, cast(rank as integer) as rank from r where rank <= 10""")
def topk_per_entity(spark: SparkSession, d: str) -> DataFrame:
    return select.top_k(read(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice"), ["l_partkey"], "l_extendedprice", ["l_orderkey", "l_linenumber"])


@query("""with e as (select user_id, event_id, event_type <> 'error' as ok, count(*) filter (event_type <> 'error') over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding) as run, row_number() over (partition by user_id order by event_id) as pos from events),
    s as (select user_id, min(f) as stop from (select user_id, run, min(pos) + 1 as f from e where not ok group by 1, 2 having count(*) >= 2) group by 1)
    select user_id, event_id from e left join s using (user_id) where stop is null or pos <= stop""")
def reject_streak(spark: SparkSession, d: str) -> DataFrame:
    """Each user's events up to the second error in a row."""
    events = read(spark, d, "events").select("user_id", "event_id", (F.col("event_type") != "error").alias("ok"))
    return select.until_streak(events, ["user_id"], "event_id", F.floor(F.col("event_id") / 100_000), "ok", 2).select("user_id", "event_id")


@query("""with recursive p as (select c_custkey as a, s_suppkey as b, round(-abs(c_acctbal - s_acctbal), 4) as score from customer join supplier on c_nationkey = s_nationkey where abs(c_acctbal - s_acctbal) <= 200),
    r as (select *, row_number() over (order by score desc, a, b) as n from p),
    turn as (select 0::bigint as n, []::bigint[] as ta, []::bigint[] as tb, false as ok, null::bigint as a, null::bigint as b, null::double as score
        union all select r.n, case when t.ok then list_append(t.ta, r.a::bigint) else t.ta end, case when t.ok then list_append(t.tb, r.b::bigint) else t.tb end, t.ok, r.a, r.b, r.score
        from (select s.n, s.ta, s.tb, q.n as at, not list_contains(s.ta, q.a::bigint) and not list_contains(s.tb, q.b::bigint) as ok from turn s join r q on q.n = s.n + 1) t join r on r.n = t.at)
    select a, b, score from turn where ok""")
def one_to_one(spark: SparkSession, d: str) -> DataFrame:
    """Customers and suppliers of one nation whose balances are at most 200 apart, paired greedily by how near they are."""
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("a"), F.col("c_nationkey").alias("n"), F.floor(F.col("c_acctbal") / 200).alias("k"), F.col("c_acctbal").alias("x"))
    s = read(spark, d, "supplier").select(F.col("s_suppkey").alias("b"), F.col("s_nationkey").alias("n"), F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda i: F.floor(F.col("s_acctbal") / 200) + i)).alias("k"), F.col("s_acctbal").alias("y"))
    return select.one_to_one(c.join(s, ["n", "k"]).where("abs(x - y) <= 200").select("a", "b", F.round(-F.abs(F.col("x") - F.col("y")), 4).alias("score")), "one_to_one")


@query("""with recursive p as (select l_suppkey as a, c_nationkey as b, max(l_extendedprice) as score from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey group by 1, 2),
    r as (select *, row_number() over (order by score desc, a, b) as n from p),
    turn as (select 0::bigint as n, []::bigint[] as ta, []::bigint[] as tb, 0 as made, false as ok, null::bigint as a, null::bigint as b, null::double as score
        union all select r.n, case when t.ok then list_append(t.ta, r.a::bigint) else t.ta end, case when t.ok then list_append(t.tb, r.b::bigint) else t.tb end, t.made + t.ok::int, t.ok, r.a, r.b, r.score
        from (select s.n, s.ta, s.tb, s.made, q.n as at, len(list_filter(s.ta, lambda x: x = q.a)) < 3 and len(list_filter(s.tb, lambda x: x = q.b)) < 3 as ok from turn s join r q on q.n = s.n + 1 where s.made < 500) t join r on r.n = t.at)
    select a, b, score from turn where ok""")
def attempt_cap(spark: SparkSession, d: str) -> DataFrame:
    """Offers of suppliers to nations of customers by the best price: a session of at most 500, three for each."""
    orders = read(spark, d, "lineitem").join(read(spark, d, "orders"), F.col("o_orderkey") == F.col("l_orderkey")).join(read(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    return select.attempts_within(orders.groupBy(F.col("l_suppkey").alias("a"), F.col("c_nationkey").alias("b")).agg(F.max("l_extendedprice").alias("score")))


# Votes and golden records --------------------------------------------------------------------------------------------

_USABLE_LABELS = "(select distinct synset_id, rec_id, list_name, label, latitude, start_date from synset_record where regexp_matches(label, '[A-Za-z]') and lower(trim(label)) not in ('unknown', 'none', 'null', 'n/a', 'tbd', 'not available'))"


def _records(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "synset_record").select("synset_id", "rec_id", "list_name", "label", "latitude", "start_date").distinct()
    return rows.where(F.col("label").rlike("[A-Za-z]") & ~F.lower(F.trim("label")).isin("unknown", "none", "null", "n/a", "tbd", "not available"))


@query(f"with c as (select synset_id, label as value, count(*) as votes from {_USABLE_LABELS} group by 1, 2), r as (select *, row_number() over (partition by synset_id order by votes desc, length(value) desc, value desc) as k from c) select synset_id, value, votes from r where k = 1")
def majority_exact(spark: SparkSession, d: str) -> DataFrame:
    return vote.majority(_records(spark, d), ["synset_id"], "label")


@query("""with o as (select o_custkey, cast(o_orderdate as date) as d from orders), y as (select o_custkey, year(d) as y, count(*) as n, list_sort(list_distinct(list(d))) as ds from o group by 1, 2), m as (select o_custkey, max(n) as n from y group by 1),
    k as (select o_custkey, list_sort(flatten(list(ds))) as ds from y join m using (o_custkey, n) group by 1)
    select o_custkey, array_to_string(case when len(list_filter(ds, lambda x: month(x) <> 1 and day(x) <> 1)) > 0 then list_filter(ds, lambda x: month(x) <> 1 and day(x) <> 1) else ds end, ',') as dates from k""")
def majority_year(spark: SparkSession, d: str) -> DataFrame:
    dates = read(spark, d, "orders").select("o_custkey", F.to_date("o_orderdate").alias("d"))
    return vote.majority_dates(dates, ["o_custkey"], "d").select("o_custkey", F.array_join(F.transform("dates", lambda x: x.cast("string")), ",").alias("dates"))


@query()
def majority_rounded(spark: SparkSession, d: str) -> DataFrame:
    """The voted latitude of each synset."""
    rows = read(spark, d, "synset_record").select("synset_id", "rec_id", "latitude").where("abs(latitude) <= 90 and latitude <> 0").distinct()
    return vote.majority_numbers(rows, ["synset_id"], "latitude", "rec_id")


@query(f"""with g as (select synset_id, array_to_string(list_sort(list_distinct(list(label))), '|') as labels, array_to_string(list_sort(list_distinct(list(list_name))), '|') as sources, min(label) filter (list_name = 'wikidata') as own from {_USABLE_LABELS} group by 1),
    c as (select synset_id, label as value, count(*) as votes from {_USABLE_LABELS} group by 1, 2), r as (select *, row_number() over (partition by synset_id order by votes desc, length(value) desc, value desc) as k from c)
    select synset_id, coalesce(own, value) as label, votes, labels, sources from r join g using (synset_id) where k = 1""")
def golden_record(spark: SparkSession, d: str) -> DataFrame:
    """The label of the trusted list, else the voted one, with all labels and lists."""
    g = vote.golden(_records(spark, d), "synset_id", "list_name", "label", {}, [], [], "rec_id", trusted="wikidata")
    return g.select("synset_id", "label", "votes", F.array_join("labels", "|").alias("labels"), F.array_join("sources", "|").alias("sources"))


@query()
def golden_place(spark: SparkSession, d: str) -> DataFrame:
    """Place, start and label by the golden record's rules: lists are sure of places by their trust."""
    sure = read(spark, d, "list_authority").select("list_name", (1.0 / F.col("trust_rank")).alias("sure"))
    rows = read(spark, d, "synset_record").where("synset_id is not null").select("synset_id", "rec_id", "list_name", "label", "latitude", "longitude", F.try_to_date(F.substring(F.regexp_replace("start_date", r"^\+", ""), 1, 10), "yyyy-MM-dd").alias("start")).distinct().join(F.broadcast(sure), "list_name", "left")
    rows = rows.withColumn("sure", F.when(usable(F.col("latitude"), F.col("longitude")), F.col("sure"))).withColumns({c: F.when(F.col("sure").isNotNull(), F.col(c)) for c in ("latitude", "longitude")})
    return vote.golden(rows, "synset_id", "list_name", "label", {}, ["start"], [], "rec_id", place=("latitude", "longitude", "sure"), trusted="wikidata").select("synset_id", "label", "latitude", "longitude", F.array_join(F.transform("start", lambda x: x.cast("string")), ",").alias("start"))


@query("""select synset_id, label as value, array_to_string(list_sort(list_distinct(list(list_name))), '|') as prov, count(*) as mentions from (select distinct synset_id, rec_id, label, list_name from synset_record where label is not null) group by 1, 2""")
def provenance_union(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "synset_record").select("synset_id", "rec_id", "label", "list_name").distinct()
    return vote.values_with_sources(rows, ["synset_id"], "label", "list_name").withColumn("prov", F.array_join("prov", "|"))


@query("""select o_custkey, max(o_orderdate) as latest from orders group by 1""")
def most_recent_date(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").groupBy("o_custkey").agg(vote.most_recent(F.col("o_orderdate")).alias("latest"))


# Versions ------------------------------------------------------------------------------------------------------------

_OLD, _NEW = "date '1999-01-01'", "date '1997-01-01'"


@query(f"""with a as (select * from orders where o_orderdate < {_OLD}), b as (select o_orderkey, case when o_orderkey % 7 = 0 then 'X' else o_orderstatus end as s, o_totalprice from orders where o_orderdate >= {_NEW})
    select coalesce(a.o_orderkey, b.o_orderkey) as o_orderkey, case when a.o_orderkey is null then 'added' when b.o_orderkey is null then 'deleted' when a.o_orderstatus <> b.s or a.o_totalprice <> b.o_totalprice then 'updated' else 'unchanged' end as change from a full join b on a.o_orderkey = b.o_orderkey""")
def version_diff(spark: SparkSession, d: str) -> DataFrame:
    orders = read(spark, d, "orders")
    new = orders.where(F.expr(f"o_orderdate >= {_NEW}")).withColumn("o_orderstatus", F.expr("case when o_orderkey % 7 = 0 then 'X' else o_orderstatus end"))
    return changes.diff(orders.where(F.expr(f"o_orderdate < {_OLD}")), new, "o_orderkey", ["o_orderstatus", "o_totalprice"])


@query("""with old as (select user_id, max(ts) as was from events where event_type in ('click', 'view') group by 1) select e.event_id, e.user_id from events e left join old using (user_id) where was is null or ts > was""")
def newer_keys(spark: SparkSession, d: str) -> DataFrame:
    events = read(spark, d, "events")
    return changes.newer_keys(events.where(F.col("event_type").isin("click", "view")).select("user_id", "ts"), events.select("event_id", "user_id", "ts"), "user_id", "ts").select("event_id", "user_id")


@query("""select user_id, arg_max(event_id, (ts, event_id)) as event_id, arg_max(event_type, (ts, event_id)) as event_type from events group by 1""")
def last_version(spark: SparkSession, d: str) -> DataFrame:
    return changes.latest(read(spark, d, "events").select("user_id", "event_id", "ts", "event_type"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("""with r as (select rec_id, label, modified, loaded_at, row_number() over (partition by rec_id order by loaded_at desc) as k from spase_record) select rec_id, label, modified from r where k = 1""")
def upsert(spark: SparkSession, d: str) -> DataFrame:
    """Records by their last delivery: first deliveries are the old version, later ones the new."""
    rows = read(spark, d, "spase_record").select("rec_id", "label", "modified", "loaded_at")
    old = rows.groupBy("rec_id").agg(F.min_by(F.struct("label", "modified", "loaded_at"), "loaded_at").alias("r")).select("rec_id", "r.*")
    new = rows.join(old.select("rec_id", F.col("loaded_at").alias("first")), "rec_id").where("loaded_at > first").drop("first")
    return changes.upsert(old, new, ["rec_id"], ["loaded_at"]).select("rec_id", "label", "modified")


@query("""with p as (select p_partkey as k, p_name as n from part), r as (select case when k % 11 = 3 then k + 1000000000 else k end as k, n from p union all select -1, 'added'),
    u as (select k, case when k = 5 then 'renamed part' else n end as n from r) select k, n from u where k <> 7""")
def fix_patch(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "part").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("n"))
    fixes = spark.createDataFrame([("add", -1, None, "added"), ("update", 5, None, "renamed part"), ("delete", 7, None, None)], "action string, k bigint, new_key bigint, n string")
    fixes = fixes.union(rows.where("k % 11 = 3").select(F.lit("rename"), "k", F.col("k") + 1_000_000_000, F.lit(None).cast("string")))
    return changes.patched(rows, "k", fixes, ["n"])


@query("""select o_orderkey, lag(o_orderkey) over w as replaces, lead(o_orderkey) over w as replaced_by, lead(o_orderkey) over w is not null as deprecated from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)""")
def mapping_supersede(spark: SparkSession, d: str) -> DataFrame:
    month = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    return changes.superseded(read(spark, d, "orders"), ["o_custkey"], "o_orderkey", "o_orderdate", month).select("o_orderkey", "replaces", "replaced_by", "deprecated")


# Synonym sets --------------------------------------------------------------------------------------------------------

_EDGES = "(select distinct r.rec_id as src, q.rec_id as dst from (select rec_id, trim(u) as u from (select rec_id, unnest(prior_id) as u from spase_record) where trim(u) like 'spase://%') r join (select distinct rec_id, trim(code) as c from spase_record) q on r.u = q.c where r.rec_id <> q.rec_id)"


def _edges(spark: SparkSession, d: str) -> DataFrame:
    records = read(spark, d, "spase_record")
    old = records.select(F.col("rec_id").alias("src"), F.explode("prior_id").alias("u")).select("src", F.trim("u").alias("c")).where("c like 'spase://%'")
    return old.join(records.select(F.col("rec_id").alias("dst"), F.trim("code").alias("c")).distinct(), "c").where("src <> dst").select("src", "dst").distinct()


_CLOSED = f"""recursive e as {_EDGES}, b as (select src, dst from e union select dst, src from e), w as (select src as id, least(src, dst) as low from b union select b.dst, w.low from w join b on b.src = w.id and w.low < b.dst), c as (select id, min(low) as synset_id from w group by 1)"""


@query(f"with {_CLOSED} select id, synset_id from c")
def connected_components(spark: SparkSession, d: str) -> DataFrame:
    return synsets.synsets(_edges(spark, d), "components")


@query(f"with {_CLOSED}, m as (select id, synset_id from c where id <> synset_id) select id as src, synset_id as dst from m union all select synset_id, id from m")
def closure_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Members and representatives of synsets, in both directions."""
    return synsets.closure_pairs(connected_components(spark, d))


@query(f"with {_CLOSED.replace(f'e as {_EDGES}', f'e as (select * from {_EDGES} where (src + dst) % 5 <> 0)')} select id, synset_id from c")
def synset_split(spark: SparkSession, d: str) -> DataFrame:
    """Synsets after some matches were taken back."""
    edges = _edges(spark, d)
    return synsets.synsets(synsets.without(edges, edges.where("(src + dst) % 5 = 0")), "split")


@query("""with t as (select distinct rec_id as id, synset_id, list_name from synset_record where list_name is not null) select id, synset_id, list_name as source from t where synset_id in (select synset_id from t join list_authority using (list_name) where trust_rank <= 3)""")
def authority_synsets(spark: SparkSession, d: str) -> DataFrame:
    members = read(spark, d, "synset_record").select(F.col("rec_id").alias("id"), "synset_id", F.col("list_name").alias("source")).where("source is not null").distinct()
    return synsets.with_authority(members, read(spark, d, "list_authority").where("trust_rank <= 3").select(F.col("list_name").alias("source"))).select("id", "synset_id", "source")


# Views ---------------------------------------------------------------------------------------------------------------

_TREE = "(select 'n' || n_nationkey as id, n_name as label, 'r' || n_regionkey as up from nation union all select 's' || s_suppkey, s_name, 'n' || s_nationkey from supplier union all select 'r' || r_regionkey, r_name, null from region)"


def _tree(spark: SparkSession, d: str) -> DataFrame:
    key = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    out = read(spark, d, "nation").select(key("n", "n_nationkey").alias("id"), F.col("n_name").alias("label"), key("r", "n_regionkey").alias("up"))
    out = out.union(read(spark, d, "supplier").select(key("s", "s_suppkey"), "s_name", key("n", "s_nationkey")))
    return out.union(read(spark, d, "region").select(key("r", "r_regionkey"), "r_name", F.lit(None).cast("string")))


@query(f"with recursive t as {_TREE}, w as (select id, label, 0 as level, label as path from t where up is null union all select t.id, t.label, level + 1, w.path || ' > ' || t.label from w join t on t.up = w.id) select id, label, level, path from w")
def hierarchy_levels(spark: SparkSession, d: str) -> DataFrame:
    t = _tree(spark, d)
    return publish.levels(t.where("up is not null").select(F.col("id").alias("src"), F.col("up").alias("dst")), t.select("id", "label"))


_LINTED = """t as (select distinct r.uri, r.label, coalesce(case r.entity_type when 'space mission' then 'investigation' when 'observatory network' then 'ground observatory' when 'unknown' then 'ufo' else r.entity_type end, '') as kind, case when regexp_matches(r.label, '^[A-L]') then split_part(r.label, ' ', 2) end as country, g.label as parent from spase_record r left join observatory_group g on lower(rtrim(trim(r.is_part_of), '.')) = lower(g.code) where r.label is not null),
    dup as (select lower(label) as l from t group by 1 having count(*) > 1)"""


@query(f"""with {_LINTED} select uri, 'duplicate' as warning, label from t where lower(label) in (select l from dup)
    union select uri, 'agency', label from t where regexp_matches(label, '\\b(NASA|ESA|JAXA|CNES|ISRO|ESO|NOAA|CNSA)\\b')
    union select uri, 'acronym', label from t where len(list_filter(regexp_extract_all(label, '[A-Z]+'), lambda x: length(x) between 2 and 5 and x not in ('NASA', 'ESA', 'JAXA', 'CNES', 'ISRO', 'ESO', 'NOAA', 'CNSA'))) > 0
    union select uri, 'aperture format', label from t where kind = 'telescope' and not regexp_matches(label, '^[0-9]+([.][0-9]+)?m ') and regexp_matches(lower(label), '[0-9] ?(cm|inches|inch|mm|km|foot|feet)')
    union select uri, 'aperture missing', label from t where kind = 'telescope' and not regexp_matches(label, '^[0-9]+([.][0-9]+)?m ') and not regexp_matches(lower(label), '[0-9] ?(cm|inches|inch|mm|km|foot|feet)')
    union select uri, 'country mismatch', label from t where kind in ('ground facility', 'ground observatory', 'telescope') and country is not null and not ends_with(label, ', ' || country)
    union select uri, 'country missing', label from t where kind = 'ground observatory' and country is null
    union select uri, 'broader missing', label from t where parent is not null and not contains(label, ' at ' || parent) and not contains(label, ' on ' || parent)
    union select uri, 'orphan', label from t where parent is null and kind not in ('ground observatory', 'investigation', 'airborne', 'spacecraft', 'ground facility')""")
def label_lint(spark: SparkSession, d: str) -> DataFrame:
    """Warnings on the labels of records; their countries are taken from the labels of one half of them, and their groups
    are platforms."""
    groups = read(spark, d, "observatory_group").select(F.lower("code").alias("c"), F.col("label").alias("parent"))
    country = F.when(F.col("label").rlike("^[A-L]"), F.coalesce(F.get(F.split("label", " "), F.lit(1)), F.lit("")))
    rows = read(spark, d, "spase_record").select("uri", "label", "entity_type", country.alias("country"), F.lower(F.regexp_replace(F.trim("is_part_of"), r"\.+$", "")).alias("c")).distinct().join(F.broadcast(groups), "c", "left")
    return publish.lint(rows.withColumns({"apertures": F.lit(None).cast("array<double>"), "parent_type": F.lit("ground observatory")}))


@query("""with l as (select code as term, label, true as p from aas_keyword union all select code, unnest(alt_label), false from aas_keyword), o as (select term, label, max(p) as p from l where label is not null group by 1, 2)
    select term, array_to_string(list(label order by p desc, label), '|') as names from o group by 1""")
def name_lookup(spark: SparkSession, d: str) -> DataFrame:
    k = read(spark, d, "aas_keyword")
    labels = k.select(F.col("code").alias("term"), "label", F.lit(True).alias("preferred")).union(k.select("code", F.explode("alt_label"), F.lit(False)))
    return publish.name_lookup(labels).select("term", F.array_join("names", "|").alias("names"))


@query(r"""with f as (select distinct site_id as old, regexp_replace(lower(label), '[^a-z0-9]', '', 'g') as form from iaumpc_site where label is not null), k as (select form, min(old) as new from f group by 1) select old, min(new) as new from f join k using (form) where form <> '' and old <> new group by 1""")
def label_collapse(spark: SparkSession, d: str) -> DataFrame:
    return publish.collapsed(read(spark, d, "iaumpc_site"), "site_id", F.regexp_replace(F.lower("label"), "[^a-z0-9]", ""))


def _attributes(spark: SparkSession, d: str) -> DataFrame:
    """The long form of the items."""
    items = read(spark, d, "wikidata_facility")
    entry = lambda a, v: F.struct(F.lit(a).alias("attr"), v.cast("string").alias("value"))
    given = F.concat(F.array(entry("label", F.col("label")), entry("entity_type", F.col("entity_type")), entry("start_date", F.col("start_date"))), F.transform(F.coalesce("alt_label", F.array().cast("array<string>")), lambda x: entry("alt_label", x)))
    return items.select("uri", F.explode(given).alias("e")).select("uri", "e.attr", "e.value", F.lit(None).cast("string").alias("lang"), F.lit("wikidata").alias("source")).where("value is not null").distinct()


@query(f"select uri, array_to_string(list(distinct value order by value), ' ') as text from {_LONG} group by 1")
def corpus_projection(spark: SparkSession, d: str) -> DataFrame:
    return publish.corpus(_attributes(spark, d))


@query(f"""with p as (select uri, case attr when 'label' then 0 when 'alt_label' then 1 else 2 end as o, attr, substr(array_to_string(list(value order by value), ', '), 1, 512) as v from {_LONG} group by 1, 2, 3)
    select uri, array_to_string(list(attr || ': ' || v order by o, attr), '; ') as text from p group by 1""")
def entity_text(spark: SparkSession, d: str) -> DataFrame:
    return publish.entity_text(_attributes(spark, d))


@query(f"select 'https://example.org/' || uri as subj, 'https://example.org/attr#' || attr as pred, value as obj, 'literal' as obj_kind, case when attr like '%_date' then 'dateTime' else 'string' end as datatype from {_LONG}")
def triples(spark: SparkSession, d: str) -> DataFrame:
    return publish.to_triples(_attributes(spark, d)).drop("lang")


@query(f"select uri, min(value) filter (attr = 'label') as label, coalesce(array_to_string(list(distinct value order by value) filter (attr = 'alt_label'), '|'), '') as alt_label from {_LONG} group by 1")
def wide_view(spark: SparkSession, d: str) -> DataFrame:
    return readers.wide(_attributes(spark, d), ["label"], ["alt_label"]).select("uri", "label", F.array_join("alt_label", "|").alias("alt_label"))


@query("select distinct node_id, entity_type = 'instrument' as only from pds_context where entity_type is not null")
def class_split(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "pds_context").where("entity_type is not null").select("node_id", F.array("entity_type").alias("t")).distinct()
    one, rest = publish.instruments_apart(rows, "t")
    return one.select("node_id", F.lit(True).alias("only")).union(rest.select("node_id", F.lit(False)))


@query("""select distinct node_id, case when starts_with(lid, 'urn:obsf:context:') then 'https://example.org/' || substr(lid, 18) else lid end as uri from pds_context""")
def namespace_rewrite(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "pds_context").select("node_id", publish.in_namespace("lid", "urn:obsf:context:", "https://example.org/").alias("uri")).distinct()


@query("""select list_name, array_to_string(list(distinct lang order by lang), '|') as langs, count(*) as n from (select distinct provenance as list_name, name_id, lang from skos_label where lang is not null) group by 1""")
def group_concat(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "skos_label").where("lang is not null").select(F.col("provenance").alias("list_name"), "name_id", "lang").distinct().groupBy("list_name").agg(F.array_join(F.array_sort(F.collect_set("lang")), "|").alias("langs"), F.count("*").alias("n"))


@query("""select l_orderkey, l_linenumber, l_shipdate from lineitem where l_returnflag in ('A', 'R') and l_linestatus = 'F' and l_shipdate >= date '1997-01-01' and l_shipdate < date '1998-01-01' and not exists (select 1 from orders o where o.o_orderkey = l_orderkey and o.o_orderstatus = 'P')""")
def mapping_filter(spark: SparkSession, d: str) -> DataFrame:
    """Facts by type, state and date, without those of superseded sets."""
    facts = read(spark, d, "lineitem").where("l_returnflag in ('A', 'R') and l_linestatus = 'F' and l_shipdate >= date '1997-01-01' and l_shipdate < date '1998-01-01'")
    gone = read(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return facts.join(gone, "l_orderkey", "left_anti").select("l_orderkey", "l_linenumber", "l_shipdate")


# Evaluation ----------------------------------------------------------------------------------------------------------


@query(f"""with s as ({_SITE_LABELS}), i as ({_ITEM_LABELS}), m as (select distinct a, b from s join i using (v) where length(v) >= 5),
    g as (select s.site_id as a, i.item_id as b, count(*) filter (abs(s.latitude - i.latitude) < 0.1) as yes, count(*) filter (coalesce(abs(s.latitude - i.latitude) >= 0.1, false)) as no from (select distinct site_id, lower(label) as l, latitude from iaumpc_site) s join (select distinct item_id, lower(label) as l, latitude from wikidata_facility) i using (l) group by 1, 2)
    select count(*) filter (m.a is not null and yes > no) as tp, count(*) filter (m.a is not null and (no > yes or g.a is null)) as fp, count(*) filter (m.a is null and yes > no) as fn, count(*) filter (m.a is null and no > yes) as tn from m full join g on m.a = g.a and m.b = g.b""")
def confusion_counts(spark: SparkSession, d: str) -> DataFrame:
    """Label matches held against votes by latitude."""
    s = read(spark, d, "iaumpc_site").select(F.col("site_id").alias("a"), F.lower("label").alias("l"), F.col("latitude").alias("x")).distinct()
    i = read(spark, d, "wikidata_facility").select(F.col("item_id").alias("b"), F.lower("label").alias("l"), F.col("latitude").alias("y")).distinct()
    near = F.abs(F.col("x") - F.col("y"))
    gold = s.join(i, "l").select("a", "b", F.coalesce(near < 0.1, F.lit(False)).cast("int").alias("yes"), F.coalesce(near >= 0.1, F.lit(False)).cast("int").alias("no"))
    return joins.confusion(label_equi_join(spark, d), gold, ["a", "b"])


@query("""select e.entity_type as true_class, i.entity_type as predicted, count(*) as n from (select distinct label, entity_type from aas_keyword) e join (select distinct item_id, label, entity_type from wikidata_facility) i on lower(split_part(e.label, ' ', 3)) = lower(split_part(i.label, ' ', 3)) where e.entity_type is not null and i.entity_type is not null group by 1, 2""")
def confusion_matrix(spark: SparkSession, d: str) -> DataFrame:
    word = lambda c: F.lower(F.coalesce(F.get(F.split(c, " "), F.lit(2)), F.lit("")))
    one = read(spark, d, "aas_keyword").select("label", "entity_type").distinct().select(word("label").alias("w"), F.col("entity_type").alias("true_class")).where("true_class is not null").groupBy("w", "true_class").agg(F.count("*").alias("n1"))
    two = read(spark, d, "wikidata_facility").select("item_id", "label", "entity_type").distinct().where("label is not null").select(word("label").alias("w"), F.col("entity_type").alias("predicted")).where("predicted is not null").groupBy("w", "predicted").agg(F.count("*").alias("n2"))
    return one.join(two, "w").groupBy("true_class", "predicted").agg(F.sum(F.col("n1") * F.col("n2")).alias("n"))


# Sources and scalar functions ----------------------------------------------------------------------------------------


@query("""select event_id, 'k' as attr, cast(json_extract(props, '$.k') as varchar) as value from events where props is not null""")
def json_flatten(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").select("event_id", F.explode(readers.json_leaves("props")).alias("l")).select("event_id", "l.attr", "l.value")


@query("""select distinct rec_id, regexp_extract(uri, '([^/#]*)#', 1) as namespace, replace(regexp_extract(uri, '#(.*)$', 1), '-', ' ') as label from spase_record where uri is not null""")
def url_parts(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "spase_record").where("uri is not null").select("rec_id", X.namespace(F.col("uri")).alias("namespace"), X.label_of_address(F.col("uri")).alias("label")).distinct()


@query("""with v as (select distinct name_id, case when lang is null then label else label || '@' || lang end as v from skos_label where label is not null)
    select name_id, regexp_replace(v, '@[^ @]+$', '') as text, nullif(regexp_extract(v, '@([^ @]+)$', 1), '') as lang from v""")
def language_tag_cut(spark: SparkSession, d: str) -> DataFrame:
    """Names with their language behind them, and names without, taken apart."""
    tagged = F.when(F.col("lang").isNull(), F.col("label")).otherwise(F.concat_ws("@", "label", "lang"))
    return read(spark, d, "skos_label").where("label is not null").select("name_id", X.cut_language(tagged).alias("c")).select("name_id", "c.text", "c.lang").distinct()


@query(r"""select distinct rec_id, replace(trim(regexp_replace(lower(label), '[^a-z0-9_]+', ' ', 'g')), ' ', '-') as slug from spase_record""")
def slugify(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "spase_record").select("rec_id", X.slug(F.col("label")).alias("slug")).distinct()


@query(r"""select distinct rec_id, regexp_extract(nssdca_id, '\b(\d{4}-\d{3}[A-Z])\b', 1) as launch_id, cast(regexp_extract(nssdca_id, '\b(\d{4})-\d{3}[A-Z]\b', 1) as integer) as year from spase_record where regexp_matches(nssdca_id, '\b\d{4}-\d{3}[A-Z]\b')""")
def cospar_ids(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "spase_record").select("rec_id", F.explode(X.launch_ids(F.col("nssdca_id"))).alias("launch_id")).distinct()
    return rows.select("rec_id", "launch_id", F.substring("launch_id", 1, 4).cast("int").alias("year"))


@query(r"""with t as (select distinct item_id, replace(replace(regexp_replace(start_date, '^\+', ''), '-00T', '-01T'), '-00-', '-01-') as s from wikidata_facility where start_date is not null)
    select item_id, case when regexp_matches(s, '^\d{4}$') then s || '-01-01T00:00:00' when regexp_matches(s, '^\d{4}-\d{2}$') then s || '-01T00:00:00' when regexp_matches(s, '^\d{4}-\d{2}-\d{2}$') then s || 'T00:00:00' else s end as date from t""")
def iso_complete(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "wikidata_facility").where("start_date is not null").select("item_id", X.complete_date(F.col("start_date")).alias("date")).distinct()


@query("""select distinct site_id, round(case when longitude between -180 and 180 then longitude else (((longitude % 360) + 360) % 360 + 540) % 360 - 180 end, 6) as longitude from iaumpc_site where longitude is not null and not isnan(longitude)""")
def longitude_wrap(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "iaumpc_site").where(F.col("longitude").isNotNull() & ~F.isnan("longitude")).select("site_id", F.round(geo.wrapped_longitude(F.col("longitude")), 6).alias("longitude")).distinct()


@query("""select p_partkey, round(p_size * cast(case p_size % 4 when 0 then 0.0254 when 1 then 0.01 when 2 then 1 else 1000 end as double), 6) as metres from part""")
def unit_to_meters(spark: SparkSession, d: str) -> DataFrame:
    unit = F.element_at(F.array(*[F.lit(u) for u in ("inch", "cm", "m", "km")]), F.col("p_size") % 4 + 1)
    return read(spark, d, "part").select("p_partkey", F.round(X.to_metres(F.concat_ws(" ", F.col("p_size").cast("string"), unit)), 6).alias("metres"))


@query(r"""select facility_id, case when regexp_matches(label, ' \d+(\.\d+)?m$') then regexp_extract(label, ' (\d+(\.\d+)?)m$', 1)::double end as metres from aas_keyword""")
def aperture_extract(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "aas_keyword").select("facility_id", F.get(X.apertures("label")["metres"], F.lit(0)).alias("metres"))


@query(r"""select facility_id, coalesce(try_cast(regexp_extract(label, ' (\d+)(?:[.]\d+m)?$', 1) as bigint), 0) as number from aas_keyword""")
def suffix_number(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "aas_keyword").select("facility_id", X.suffix_numbers("label").alias("number"))


@query("""select doc_id, array_to_string(list_filter(string_split(title, ' '), lambda w: lower(w) not in ('record', 'notes', 'log', 'the', 'of')), ' ') as title from documents where title is not null""")
def stopword_removal(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").where("title is not null").select("doc_id", X.without_words(F.col("title"), ["record", "notes", "log", "the", "of"]).alias("title"))


@query("""select distinct mention_id, case when len(string_split(label, ', ')) = 2 then trim(string_split(label, ', ')[1]) else label end as name, case when len(string_split(label, ', ')) = 2 then trim(string_split(label, ', ')[2]) else '' end as location from facility_mention where label is not null""")
def location_cut(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "facility_mention").where("label is not null").select("mention_id", X.cut_location(F.col("label"), ", ").alias("c")).select("mention_id", "c.name", "c.location").distinct()


@query("""select distinct s.site_id, round(2 * 6371.0088 * asin(least(1, sqrt(power(sin(radians(-s.latitude) / 2), 2) + cos(radians(s.latitude)) * power(sin(radians(-s.longitude) / 2), 2)))), 3) as km from iaumpc_site s where abs(latitude) <= 90 and abs(longitude) <= 360 and not isnan(latitude)""")
def haversine(spark: SparkSession, d: str) -> DataFrame:
    """How far each site is from (0, 0)."""
    return read(spark, d, "iaumpc_site").where("abs(latitude) <= 90 and abs(longitude) <= 360").where(~F.isnan("latitude")).select("site_id", F.round(haversine_km(F.col("latitude"), F.col("longitude"), F.lit(0.0), F.lit(0.0)), 3).alias("km")).distinct()


@query("""select time_bucket(interval '1 hour', ts) as start, event_type, count(*) as n, round(sum(value), 6) as total from events group by 1, 2""")
def event_windows(spark: SparkSession, d: str) -> DataFrame:
    return refresh.tumbling(read(spark, d, "events"))


@query("""with g as (select *, case when ts > lag(ts) over (partition by user_id order by ts) + interval '30 minutes' or lag(ts) over (partition by user_id order by ts) is null then 1 else 0 end as new from events where user_id is not null), s as (select *, sum(new) over (partition by user_id order by ts rows unbounded preceding) as k from g)
    select min(ts) as start, max(ts) + interval '30 minutes' as "end", user_id, count(*) as n from s group by user_id, k""")
def event_sessions(spark: SparkSession, d: str) -> DataFrame:
    return refresh.sessions(read(spark, d, "events").where("user_id is not null"))


# Sources and sinks: written, read back and compared -------------------------------------------------------------------


def _folder(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared folder, which goes when the driver ends."""
    return Scratch(spark, name).root + "/files"


@query(f"select 'https://example.org/' || uri as subj, 'https://example.org/attr#' || attr as pred, value as obj, 'literal' as obj_kind, case when attr like '%_date' then 'http://www.w3.org/2001/XMLSchema#dateTime' end as datatype from {_LONG}")
def turtle_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Triples written as text and read by the Turtle reader."""
    path = _folder(spark, "turtle")
    writers.triples(publish.to_triples(_attributes(spark, d)), path)
    return readers.turtle(spark, [path]).drop("lang")


@query(f"with recursive t as {_TREE}, w as (select id, label, 0 as level from t where up is null union all select t.id, t.label, level + 1 from w join t on t.up = w.id) select id, level, label from w")
def listing_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The hierarchical listing written and read as a delimited file."""
    path = _folder(spark, "listing")
    writers.listing(hierarchy_levels(spark, d), path)
    return spark.read.csv(path, sep=";", schema="id string, level int, label string")


@query("""with l as (select code as term, label, true as p from aas_keyword union all select code, unnest(alt_label), false from aas_keyword), o as (select term, label, max(p) as p from l where label is not null group by 1, 2)
    select term, array_to_string(list(label order by p desc, label), '|') as names from o group by 1""")
def lookup_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The name lookup written and read as JSON."""
    path = _folder(spark, "lookup")
    k = read(spark, d, "aas_keyword")
    writers.lookup(publish.name_lookup(k.select(F.col("code").alias("term"), "label", F.lit(True).alias("preferred")).union(k.select("code", F.explode("alt_label"), F.lit(False)))), path)
    return spark.read.schema("term string, names array<string>").json(path).select("term", F.array_join("names", "|").alias("names"))


@query("select distinct node_id::varchar as node_id, label, entity_type from pds_context where label is not null and entity_type is not null")
def xml_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Nodes written and read as XML records."""
    path = _folder(spark, "xml")
    nodes = read(spark, d, "pds_context").where("label is not null and entity_type is not null").select(F.col("node_id").cast("string").alias("node_id"), "label", "entity_type").distinct()
    nodes.write.option("rootTag", "nodes").option("rowTag", "node").xml(path)
    return spark.read.schema(nodes.schema).option("rowTag", "node").xml(path)


@query("""select distinct site_id::varchar as site_id, rpad(trim(code), 8, ' ') || '|' as padded from iaumpc_site where code is not null""")
def fixed_width_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Codes of sites in a file of fixed columns, and cut from it."""
    path = _folder(spark, "fixed")
    rows = read(spark, d, "iaumpc_site").where("code is not null").select("site_id", "code").distinct()
    rows.select(F.concat(F.rpad(F.trim("code"), 8, " "), F.lpad(F.col("site_id").cast("string"), 20, " ")).alias("value")).write.text(path)
    cut = readers.fixed_width(spark.read.text(path), "value", {"code": (0, 8, "string"), "site_id": (8, 28, "string")})
    return cut.select("site_id", F.concat(F.rpad("code", 8, " "), F.lit("|")).alias("padded"))


@query("select facility_id::varchar as name, 'kind' as attr, entity_type as value from aas_keyword where entity_type is not null union all select facility_id::varchar, 'id', facility_id::varchar from aas_keyword where entity_type is not null")
def html_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Rows of an HTML table, one page a facility."""
    cell = lambda t, c: F.concat(F.lit(f"<{t}>"), c, F.lit(f"</{t}>"))
    k = read(spark, d, "aas_keyword").where("entity_type is not null")
    page = F.concat(F.lit("<table><tr>"), cell("th", F.lit("Id")), cell("th", F.lit("Kind")), F.lit("</tr><tr>"), cell("td", F.col("facility_id").cast("string")), cell("td", F.col("entity_type")), F.lit("</tr></table>"))
    return readers.html_table(k.select(page.alias("html")), "html").toDF("name", "attr", "value")


@query("""with i as (select distinct item_id, label, alt_label, start_date from wikidata_facility where label is not null)
    select distinct item_id, attr, value, lang from (select item_id, 'label' as attr, label as value, 'en' as lang from i union all select item_id, 'alt_label', unnest(alt_label), 'en' from i union all select item_id, 'start_date', start_date, null from i) where value is not null""")
def item_json_attributes(spark: SparkSession, d: str) -> DataFrame:
    """Items as JSON in the form of their source, and their attributes read from it."""
    text = lambda c: F.struct(F.lit("en").alias("language"), c.alias("value"))
    items = read(spark, d, "wikidata_facility").where("label is not null").select("item_id", "label", F.array_compact(F.coalesce("alt_label", F.array().cast("array<string>"))).alias("alt_label"), "start_date").distinct()
    claim = F.when(F.col("start_date").isNotNull(), F.array(F.struct(F.struct(F.struct(F.struct(F.col("start_date").alias("time")).alias("value")).alias("datavalue")).alias("mainsnak")))).otherwise(F.array().cast("array<struct<mainsnak:struct<datavalue:struct<value:struct<time:string>>>>>"))
    entity = F.struct(F.struct(text(F.col("label")).alias("en")).alias("labels"), F.struct(F.transform("alt_label", text).alias("en")).alias("aliases"), F.struct(claim.alias("P571")).alias("claims"))
    page = F.to_json(F.struct(F.struct(entity.alias("Q")).alias("entities")))
    return items.select("item_id", F.explode(readers.item_attributes(page)).alias("a")).select("item_id", "a.attr", "a.value", "a.lang").distinct()


@query("""select distinct mention_id::varchar as "Entity1", coalesce(waveband, 'none') as "Entity2", case when alt_label is null then 1 else 2 end as yes, case when alt_label is null then 1 else 0 end as no from facility_mention""")
def votes_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """An annotation table written, and its votes counted."""
    path = _folder(spark, "votes")
    second = F.when(F.col("alt_label").isNull(), "o").otherwise("x")
    rows = read(spark, d, "facility_mention").select(F.lit("x").alias("one"), second.alias("two"), F.lit("seen").alias("Comments"), F.col("mention_id").cast("string").alias("Entity1"), F.coalesce("waveband", F.lit("none")).alias("Entity2")).distinct()
    rows.write.csv(path, sep="\t", header=True)
    return readers.votes(spark, path)


@query(f"select uri, attr, value from (select uri, case attr when 'entity_type' then 'type' else attr end as attr, trim(value) as value from {_LONG}) where value not in ('None', '-', '', 'NULL', 'Unknown') and not (attr like '%date' and starts_with(value, '2000-01-01'))")
def cleaned_values(spark: SparkSession, d: str) -> DataFrame:
    """Attributes of items under their common names, without what stands for nothing."""
    return readers.cleaned_attributes(_attributes(spark, d), {"entity_type": "type"}).select("uri", "attr", "value")


@query("""select s_suppkey, case n_name when 'RUSSIA' then case when lo < 59 then 'Europe' else 'Asia' end else case r_name when 'AFRICA' then 'Africa' when 'AMERICA' then 'North America' when 'EUROPE' then 'Europe' else 'Asia' end end as continent, n_name as country
    from (select *, (s_suppkey * 37) % 181 as lo from supplier) join nation on n_nationkey = s_nationkey join region on r_regionkey = n_regionkey""")
def continents(spark: SparkSession, d: str) -> DataFrame:
    """Continents of suppliers by their nations; one nation lies in two, by longitude."""
    region = F.when(F.col("r_name") == "AFRICA", "AF").when(F.col("r_name") == "AMERICA", "NA").when(F.col("r_name") == "EUROPE", "EU").otherwise("AS")
    nations = read(spark, d, "nation").join(F.broadcast(read(spark, d, "region")), F.col("r_regionkey") == F.col("n_regionkey"))
    countries = nations.select(F.when(F.col("n_name") == "RUSSIA", "RU").otherwise(F.concat(F.lit("C"), F.col("n_nationkey").cast("string"))).alias("code"), F.col("n_name").alias("name"), region.alias("continent"))
    rows = read(spark, d, "supplier").join(F.broadcast(nations.select("n_nationkey", F.lower("n_name").alias("country"))), F.col("n_nationkey") == F.col("s_nationkey"))
    rows = rows.select("s_suppkey", "country", F.lit(None).cast("string").alias("cc"), ((F.col("s_suppkey") * 37) % 181).cast("double").alias("lo"))
    return geo.with_continent(rows, countries, "country", "cc", "lo").select("s_suppkey", "continent", "country")


@query("""select distinct facility_id::varchar as uri, 'aperture' as attr, aperture::varchar as value from aas_keyword where not isnan(aperture) and aperture is not null""")
def page_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Detail pages of name-value rows, written as text and read one page a file line."""
    k = read(spark, d, "aas_keyword").where(F.col("aperture").isNotNull() & ~F.isnan("aperture"))
    page = F.concat(F.lit("<p> </p><p>Facility</p><table><tr><td>Aperture:</td><td>"), F.col("aperture").cast("string"), F.lit("</td></tr><tr><td>only one cell</td></tr></table>"))
    return readers.two_column_page(k.select(F.col("facility_id").cast("string").alias("id"), page.alias("html")), "id", "html").distinct()


@query("""select distinct rec_id, label as intro from spase_record where label is not null""")
def first_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    page = F.concat(F.lit("<html><body><p> </p><p><b>"), "label", F.lit("</b></p><p>more</p></body></html>"))
    return read(spark, d, "spase_record").where("label is not null").select("rec_id", readers.first_paragraph(page).alias("intro")).distinct()


@query("""select distinct site_id as code, trim(replace(code, chr(39), '')) as name from iaumpc_site where code is not null""")
def preformatted_codes(spark: SparkSession, d: str) -> DataFrame:
    """Codes with quoted names in a preformatted block."""
    rows = read(spark, d, "iaumpc_site").where("code is not null").select("site_id", F.replace("code", F.lit("'"), F.lit("")).alias("code")).distinct()
    block = F.concat(F.lit("<html><pre>\n "), F.col("site_id").cast("string"), F.lit("   ' "), "code", F.lit(" '\n</pre></html>"))
    return rows.select(F.explode(readers.quoted_codes(F.get(readers.html_preformatted(block), F.lit(0)))).alias("c")).select(F.col("c.code").cast("bigint").alias("code"), "c.name")


@query("""select distinct event_type as name, user_id from events where user_id is not null""")
def paged_json_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Rows in pages of JSON, each once."""
    path = _folder(spark, "pages")
    rows = read(spark, d, "events").where("user_id is not null").select(F.pmod(F.xxhash64("event_id"), F.lit(64)).alias("page"), F.struct(F.col("event_type").alias("name"), "user_id").alias("r"))
    rows.groupBy("page").agg(F.collect_set("r").alias("data")).write.partitionBy("page").json(path)
    return readers.paged_json(spark, path).select("name", F.col("user_id").cast("bigint").alias("user_id"))


@query("""select distinct rec_id, lower(regexp_replace(uri, '[^A-Za-z0-9_]+', '_', 'g')) as file from spase_record where uri is not null""")
def cache_names(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "spase_record").where("uri is not null").select("rec_id", readers.cache_name(F.col("uri")).alias("file")).distinct()


@query("""select distinct mention_id, case waveband when 'radio' then 'Radio waves' when 'optical' then 'Visible light' else waveband end as band from facility_mention where waveband is not null""")
def translated_codes(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "facility_mention").where("waveband is not null").select("mention_id", enrich.translated(F.col("waveband"), {"radio": "Radio waves", "optical": "Visible light"}).alias("band")).distinct()


@query("""select list_name as subject_source, 'x' as object_source, rec_id, label from (select distinct list_name, rec_id, label from synset_record where list_name is not null)""")
def mapping_store_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Facts in the mapping store, by their two lists."""
    path = _folder(spark, "store")
    rows = read(spark, d, "synset_record").where("list_name is not null").select(F.col("list_name").alias("subject_source"), F.lit("x").alias("object_source"), "rec_id", "label").distinct()
    writers.mappings(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


@query(f"""with {_LINTED}, w as (select uri, 'duplicate' as warning from t where lower(label) in (select l from dup)) select warning, count(*) as n from w group by 1""")
def warnings_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The summary of warnings as it is written, for one kind."""
    path = _folder(spark, "warnings")
    writers.warnings(label_lint(spark, d).where("warning = 'duplicate'").select("uri", "warning", "label").distinct(), path)
    return spark.read.schema("warning string, n bigint").json(f"{path}/summary")


@query("""select distinct node_id, entity_type = 'instrument' as instrument from pds_context where entity_type is not null""")
def split_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Instruments and the rest, written apart."""
    path = _folder(spark, "split")
    rows = read(spark, d, "pds_context").where("entity_type is not null").select("node_id", F.array("entity_type").alias("t")).distinct()
    writers.split(*publish.instruments_apart(rows, "t"), path)
    return spark.read.parquet(f"{path}/instruments").select("node_id", F.lit(True).alias("instrument")).union(spark.read.parquet(f"{path}/facilities").select("node_id", F.lit(False)))


@query("""select distinct rec_id, label as name, code as aka from spase_record where label is not null and regexp_matches(code, '^[A-Za-z0-9:/-]+$')""")
def aka_cut(spark: SparkSession, d: str) -> DataFrame:
    """Names behind "also known as", cut from a label."""
    rows = read(spark, d, "spase_record").where("label is not null").where(F.col("code").rlike("^[A-Za-z0-9:/-]+$")).select("rec_id", X.cut_aka(F.concat("label", F.lit(" (also known as "), "code", F.lit(")"))).alias("c"))
    return rows.select("rec_id", "c.name", "c.aka").distinct()


@query(r"""select distinct mention_id, trim(regexp_replace(regexp_replace(label, '\([^()]*\)', ' ', 'g'), ' +', ' ', 'g')) as plain from facility_mention where label is not null""")
def parentheses_cut(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "facility_mention").where("label is not null").select("mention_id", X.without_parentheses(F.col("label")).alias("plain")).distinct()


@query(r"""with m as (select distinct mention_id, regexp_replace(trim(regexp_replace(regexp_replace(label || ' (', '[\r\t]', ' ', 'g'), ' +', ' ', 'g')), '\.$', '') as b from facility_mention where label is not null and not contains(label, '(') and not contains(label, ')'))
    select mention_id, trim(b || ')') as label from m""")
def labels_cleaned(spark: SparkSession, d: str) -> DataFrame:
    """Labels in which a parenthesis was left open."""
    rows = read(spark, d, "facility_mention").where("label is not null").where(~F.contains("label", F.lit("(")) & ~F.contains("label", F.lit(")")))
    return rows.select("mention_id", X.clean(F.concat("label", F.lit(" ("))).alias("label")).distinct()


@query("""select distinct site_id, round(latitude, 5) as latitude from iaumpc_site where not isnan(latitude) and abs(latitude) < 89""")
def parallax_latitude(spark: SparkSession, d: str) -> DataFrame:
    """Latitudes back from the parallax constants that they give."""
    e2 = geo.FLAT * (2 - geo.FLAT)
    phi = F.radians("latitude")
    n = 1 / F.sqrt(1 - F.lit(e2) * F.sin(phi) * F.sin(phi))
    rows = read(spark, d, "iaumpc_site").where(~F.isnan("latitude") & (F.abs("latitude") < 89)).select("site_id", "latitude").distinct()
    return rows.select("site_id", geo.geodetic_latitude(n * F.cos(phi), (1 - F.lit(e2)) * n * F.sin(phi)).alias("latitude"))


@query("""with e as (select vec_id, embedding from embeddings), p as (select a.vec_id, a.embedding as x, b.embedding as y from e a join e b on b.vec_id = a.vec_id + 1)
    select vec_id, round(list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i]::double * 2 + y[i]::double * 3) / 5)), 5) as total from p""")
def merged_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Each vector and the next one merged, as synsets of two and three members."""
    e = read(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    other = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("x").alias("y"))
    merged = embed.weighted_mean(F.col("x"), F.lit(2), F.col("y"), F.lit(3))
    return e.join(other, "vec_id").select("vec_id", F.round(F.aggregate(merged, F.lit(0.0), lambda s, v: s + v), 5).alias("total"))


@query("""with r as (select rec_id, label, alt_label, loaded_at, row_number() over (partition by rec_id order by loaded_at) as k from spase_record), o as (select * from r where k = 1), n as (select rec_id, 'new ' || label as label from o where label is not null)
    select o.rec_id, n.label, array_to_string(list_sort(list_distinct(list_filter(list_concat(coalesce(o.alt_label, []), [o.label]), lambda x: x is not null and x <> n.label))), '|') as alt_label from o join n using (rec_id)""")
def merged_versions(spark: SparkSession, d: str) -> DataFrame:
    """Records and a later version with another label, merged: the older label is kept among the others."""
    rows = read(spark, d, "spase_record").groupBy("rec_id").agg(F.min_by(F.struct("label", "alt_label"), "loaded_at").alias("r")).select("rec_id", "r.*").where("label is not null")
    m = vote.merged_entity({"label": F.col("label"), "alt_label": F.col("alt_label")}, {"label": F.concat(F.lit("new "), "label"), "alt_label": F.lit(None).cast("array<string>")})
    return rows.select("rec_id", m["label"].alias("label"), F.array_join(m["alt_label"], "|").alias("alt_label"))


@query("""with r as (select distinct rec_id, entity_type as t, lower(label) as l, case when nssdca_id is null then 0.5 else 1 end as c from spase_record where label is not null)
    select a.rec_id as a, b.rec_id as b from r a join r b on a.l = b.l and a.rec_id < b.rec_id where a.c < 1 or b.c < 1 or a.t is null or b.t is null or a.t = b.t""")
def type_confidence_filter(spark: SparkSession, d: str) -> DataFrame:
    """Records of one label, unless both are sure of their classes (they have an identifier) and these differ: classes are
    compared by name here."""
    rows = read(spark, d, "spase_record").where("label is not null").select(F.col("rec_id").alias("a"), F.lower("label").alias("l"), F.array_compact(F.array(F.concat(F.lit("="), "entity_type"))).alias("t1"), F.when(F.col("nssdca_id").isNull(), 0.5).otherwise(1.0).alias("c1")).distinct()
    others = rows.select(F.col("a").alias("b"), "l", F.col("t1").alias("t2"), F.col("c1").alias("c2"))
    return rows.join(others, "l").where("a < b").where(compare.type_filter(F.col("t1"), F.col("c1"), F.col("t2"), F.col("c2"))).select("a", "b")


@query("""with r as (select distinct rec_id, lower(label) as l, lower(rtrim(trim(is_part_of), '.')) as p from spase_record where label is not null)
    select a.rec_id as a, b.rec_id as b from r a join r b on a.l = b.l and a.rec_id < b.rec_id where a.p is null or b.p is null or a.p = b.p""")
def same_broader_filter(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "spase_record").where("label is not null").select(F.col("rec_id").alias("a"), F.lower("label").alias("l"), F.array_compact(F.array(F.lower(F.regexp_replace(F.trim("is_part_of"), r"\.+$", "")))).alias("p1")).distinct()
    others = rows.select(F.col("a").alias("b"), "l", F.col("p1").alias("p2"))
    return rows.join(others, "l").where((F.col("a") < F.col("b")) & compare.broader_filter(F.col("p1"), F.col("p2"))).select("a", "b")


@query("""with renamed as (select u as old, min(code) as new from (select code, unnest(prior_id) as u from spase_record where code is not null) where u is not null group by 1), known as (select distinct code from spase_record where code is not null),
    e as (select distinct r.code as src, coalesce(n.new, t.u) as dst from (select code, unnest(prior_id) as u from spase_record where code is not null) t join spase_record r on r.code = t.code left join renamed n on n.old = t.u),
    b as (select src, dst, 'is_part_of' as relation from e where src <> dst union select dst, src, 'has_part' from e where src <> dst) select * from b where src in (select code from known) and dst in (select code from known)""")
def restored_references(spark: SparkSession, d: str) -> DataFrame:
    """References by old codes led to the records that bear them now, from both sides."""
    records = read(spark, d, "spase_record").where("code is not null")
    refs = records.select("code", F.explode("prior_id").alias("ref")).where("ref is not null").distinct()
    names = refs.select(F.col("ref").alias("old"), F.col("code").alias("new"))
    return joins.restored_links(refs, "code", "ref", names, records, "code")


@query("""with r as (select rec_id, label, modified, row_number() over (partition by rec_id order by loaded_at) as k, row_number() over (partition by rec_id order by loaded_at desc) as z from spase_record),
    o as (select rec_id, label, modified from r where k = 1 and rec_id % 7 <> 0), n as (select rec_id, case when rec_id % 5 = 0 then upper(label) else label end as label from r where z = 1 and rec_id % 11 <> 0)
    select coalesce(o.rec_id, n.rec_id) as rec_id, case when n.rec_id is null then o.label else n.label end as label, case when o.rec_id is not null and n.rec_id is not null and o.label is not distinct from n.label then o.modified else timestamp '2030-01-01' end as modified, n.rec_id is null as deprecated from o full join n on o.rec_id = n.rec_id""")
def list_refresh(spark: SparkSession, d: str) -> DataFrame:
    """A list read again: some records are new, some gone, some changed."""
    rows = read(spark, d, "spase_record").groupBy("rec_id").agg(F.min_by(F.struct("label", "modified"), "loaded_at").alias("o"), F.max_by("label", "loaded_at").alias("n"))
    old = rows.where("rec_id % 7 <> 0").select("rec_id", "o.label", "o.modified")
    new = rows.where("rec_id % 11 <> 0").select("rec_id", F.when(F.col("rec_id") % 5 == 0, F.upper("n")).otherwise(F.col("n")).alias("label"))
    return changes.refreshed(old, new, "rec_id", ["label"], F.lit("2030-01-01").cast("timestamp"))


@query("""with t as (select distinct synset_id, rec_id, list_name from synset_record), p as (select synset_id, min(rec_id) as src, max(rec_id) as dst from t group by 1 having count(*) > 1), w as (select synset_id, min(rec_id) as own from t where list_name = 'wikidata' group by 1)
    select coalesce(own, src) as src, dst, 'broadMatch' as relation from p left join w using (synset_id) where coalesce(own, src) <> dst union select dst, coalesce(own, src), 'narrowMatch' from p left join w using (synset_id) where coalesce(own, src) <> dst""")
def relations_in_list(spark: SparkSession, d: str) -> DataFrame:
    """Broader and narrower relations whose subjects are given by their synonym in one list."""
    members = read(spark, d, "synset_record").select(F.col("rec_id").alias("id"), "synset_id", F.col("list_name").alias("source")).distinct()
    pairs = members.groupBy("synset_id").agg(F.min("id").alias("src"), F.max("id").alias("dst")).where("src <> dst").select("src", "dst")
    return joins.related(joins.in_list(pairs, "src", members, "wikidata").where("src <> dst"), "src", "dst", "broadMatch", "narrowMatch")


@query("""select distinct node_id, label from pds_context where label is not null and not coalesce(deprecated, false) and entity_type in ('airborne', 'instrument_host', 'investigation', 'telescope')""")
def entities_of_class(spark: SparkSession, d: str) -> DataFrame:
    """Nodes of a class or one below it."""
    return enrich.entity_list(read(spark, d, "pds_context"), "entity_type", ["space facility"], ["label"], "deprecated", lattice=True).select("node_id", "label").distinct()


# The strategy ---------------------------------------------------------------------------------------------------------


_THREE = """t as (select distinct rec_id, label, list_name from synset_record where label is not null and list_name in ('aas', 'pds', 'wikidata')), v as (select list_name, rec_id, lower(trim(label)) as v from t where length(lower(trim(label))) >= 5),
    r as (select list_name, v, rec_id, row_number() over (partition by list_name, v order by rec_id) as k from v)"""


@query(f"""with {_THREE} select a.list_name || ':' || a.rec_id as a, b.list_name || ':' || b.rec_id as b, 'exactMatch' as predicate from r a join r b on a.v = b.v and a.k = b.k
    where (a.list_name = 'aas' and b.list_name in ('pds', 'wikidata')) or (a.list_name = 'pds' and b.list_name = 'wikidata' and not exists (select 1 from r c where c.list_name = 'aas' and c.v = a.v and c.k = a.k))""")
def three_list_mappings(spark: SparkSession, d: str) -> DataFrame:
    """Three lists mapped pair by pair by equal labels. The second and third list link only what is not linked through the
    first. Of several records of a list with one label the n-th goes with the n-th (ids are compared by number)."""
    none = F.lit(None)
    rows = read(spark, d, "synset_record").where(F.col("label").isNotNull() & F.col("list_name").isin("aas", "pds", "wikidata")).select("rec_id", "label", "list_name").distinct()
    given = rows.select(F.concat_ws(":", "list_name", F.lpad(F.col("rec_id").cast("string"), 20, "0")).alias("uri"), F.col("list_name").alias("source"), "label", none.cast("array<string>").alias("alt_label"), none.cast("string").alias("entity_type"), none.cast("double").alias("latitude"), none.cast("double").alias("longitude"), none.cast("array<int>").alias("years"), none.cast("array<string>").alias("ids"), none.cast("array<double>").alias("apertures"), none.cast("array<string>").alias("parents"))
    steps = strategy.parse("aas, pds: label_match\naas, wikidata: label_match\npds, wikidata: label_match")
    plain = lambda c: F.regexp_replace(c, ":0+", ":").alias(c)
    return strategy.run(steps, given, name="three").select(plain("a"), plain("b"), "predicate")


@query()
def strategy_mappings(spark: SparkSession, d: str) -> DataFrame:
    """Sites and items mapped by a strategy of two steps: labels that are equal, then names alike and not far apart."""
    none = F.lit(None)
    common = lambda rows, key, source, kind, start, code: rows.select(F.concat_ws(":", F.lit(source), F.col(key).cast("string")).alias("uri"), F.lit(source).alias("source"), "label", "alt_label", kind.alias("entity_type"), "latitude", "longitude", start.alias("years"), none.cast("array<string>").alias("ids"), none.cast("array<double>").alias("apertures"), none.cast("array<string>").alias("parents"), code.alias("code")).dropDuplicates(["uri"])
    sites = common(read(spark, d, "iaumpc_site"), "site_id", "iaumpc", F.lit("ground observatory"), none.cast("array<int>"), F.array("code"))
    items = common(read(spark, d, "wikidata_facility"), "item_id", "wikidata", none.cast("string"), compare.years(F.array_compact(F.array("start_date"))), none.cast("array<string>"))
    steps = strategy.parse("iaumpc, wikidata: distance, label_match\niaumpc, wikidata: distance, number, levenshtein_similarity >= 0.85")
    found = strategy.run(steps, sites.union(items))
    return found.select("a", "b", "predicate", "justification", F.round("score", 6).alias("score"))
