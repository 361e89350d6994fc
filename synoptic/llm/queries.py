"""All queries of the subpackage, by name, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from synoptic.llm import groups, linkage, lookalikes, mixing, representative, splitting, tokens, variants
from synoptic.runtime import read


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Groups of records that name one another."""
    records = read(spark, d, "spase_record")
    given = F.concat(F.array("code", "nssdca_id"), F.coalesce("prior_id", F.array().cast("array<string>")))
    own = records.select(F.col("rec_id").alias("id"), F.explode(given).alias("ident"))
    more = read(spark, d, "observatory_group").select(F.col("group_id").alias("id"), F.explode(F.array("code", "nssdca_id")).alias("ident"))
    named = own.union(more).select("id", groups.clean_identifier(F.col("ident")).alias("ident"))
    return groups.groups(named, "p2").select(F.col("id").alias("rec_id"), "group_id")


def _forms(spark: SparkSession, d: str) -> DataFrame:
    return lookalikes.normalized(read(spark, d, "skos_label"), "name_id", ["label", "alt_label"], "p1")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose values look the same but are not the same characters."""
    return lookalikes.look_alikes(_forms(spark, d)).select("field", F.col("a").alias("name_id_a"), F.col("b").alias("name_id_b"))


def p1_forms(spark: SparkSession, d: str) -> DataFrame:
    """The one form of every name."""
    return _forms(spark, d).select(F.col("key").alias("name_id"), "field", "form")


def p1_members(spark: SparkSession, d: str) -> DataFrame:
    """The same by membership: the class of values that look the same, and the variant of those with the same characters."""
    return lookalikes.members(_forms(spark, d)).select("field", F.col("key").alias("name_id"), F.col("variant").alias("variant_id"), F.col("class").alias("class_id"))


def _linked(spark: SparkSession, d: str) -> DataFrame:
    return linkage.link(read(spark, d, "iaumpc_site"), "site_id", read(spark, d, "wikidata_facility"), "item_id", "p3")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Sites and items that are the same facility."""
    return _linked(spark, d).select(F.col("a").alias("site_id"), F.col("b").alias("item_id"))


def p3_confidence(spark: SparkSession, d: str) -> DataFrame:
    return _linked(spark, d).select(F.col("a").alias("site_id"), F.col("b").alias("item_id"), "confidence")


def _best(spark: SparkSession, d: str) -> DataFrame:
    lat, lon = F.col("latitude"), F.col("longitude")
    fields = {
        "label": (F.col("label"), representative.usable_text(F.col("label"))),
        "position": (F.concat_ws(" ", lat.cast("string"), lon.cast("string")), representative.usable_position(lat, lon)),
        "start": (F.col("start_date"), representative.usable_date(F.col("start_date"))),
    }
    trust = read(spark, d, "list_authority").select(F.col("list_name").alias("source"), F.col("trust_rank").alias("rank"))
    return representative.representatives(read(spark, d, "synset_record"), "synset_id", "rec_id", "list_name", "modified", fields, trust, "p4")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """The records that each field of a synset's survivor is taken from."""
    return _best(spark, d).select(F.col("g").alias("synset_id"), F.col("label_id").alias("label_rec_id"), F.col("position_id").alias("position_rec_id"), F.col("start_id").alias("start_rec_id"))


def p4_golden(spark: SparkSession, d: str) -> DataFrame:
    """The surviving record of each synset."""
    at = F.split("position", " ")
    return _best(spark, d).select(F.col("g").alias("synset_id"), "label", F.element_at(at, 1).cast("double").alias("latitude"), F.element_at(at, 2).cast("double").alias("longitude"), F.col("start").alias("start_date"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """The facility that each mention means."""
    linked = variants.link(read(spark, d, "facility_mention"), "mention_id", ["label", "alt_label"], read(spark, d, "aas_keyword"), "facility_id", "label", "alt_label", "p7")
    return linked.select(F.col("key").alias("mention_id"), F.col("entity").alias("facility_id"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode(read(spark, d, "documents"), "doc_id", "text")


def _mixed(spark: SparkSession, d: str) -> DataFrame:
    sized = read(spark, d, "documents").select("doc_id", "source", tokens.count_tokens(F.col("text")).alias("n_tokens"))
    return mixing.mix(sized, "doc_id", "source", "n_tokens", read(spark, d, "mix_target"), "p9")


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """The mix, one row for each use of a text."""
    return _mixed(spark, d)


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """The shares that the mix reaches."""
    return mixing.shares(_mixed(spark, d), read(spark, d, "mix_target"))


def p10_pieces(spark: SparkSession, d: str) -> DataFrame:
    """Pieces of all texts that exceed a profile's limit."""
    # A profile is a setting: the table has one row for each, read by the driver.
    profiles = [tuple(r) for r in read(spark, d, "split_profile").select("profile", "max_tokens", "overlap_tokens").distinct().collect()]
    return splitting.split(read(spark, d, "documents"), "doc_id", "text", profiles)


QUERIES = {"p1_found": p1_found, "p1_forms": p1_forms, "p1_members": p1_members, "p3_found": p3_found, "p3_confidence": p3_confidence, "p4_found": p4_found, "p4_golden": p4_golden, "p7_found": p7_found, "p2_found": p2_found, "p8_ids": p8_ids, "p9_mix": p9_mix, "p9_shares": p9_shares, "p10_pieces": p10_pieces}



#: What the SQL of problem 1 takes for the same shape, written apart from the operator's tables: half-width
#: kana and marks, letters of Greek and Cyrillic, and blanks.
_KANA = ("｡｢｣､･ｦｧｨｩｪｫｬｭｮｯｰｱｲｳｴｵｶｷｸｹｺｻｼｽｾｿﾀﾁﾂﾃﾄﾅﾆﾇﾈﾉﾊﾋﾌﾍﾎﾏﾐﾑﾒﾓﾔﾕﾖﾗﾘﾙﾚﾛﾜﾝﾞﾟ", "。「」、・ヲァィゥェォャュョッーアイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロワン\u3099\u309a")
_GREEK = ("ΑΒΕΗΙΚΜΝΟΡΤΧΥΖΓΠΦονόΌΊ", "ABEHIKMNOPTXYZГПФovóÓÍ")
_CYRILLIC = ("АВСЕНІЈКМОРЅТХҮԚԜасԁеһіјорԛѕѵԝху", "ABCEHIJKMOPSTXYQWacdehijopqsvwxy")
_MARKS = ("‐‑\u00a0\u2002\u2003\u2007\u2009\u202f\u3000", "--       ")


def _shape_sql(value: str) -> str:
    """SQL for the shape of a value: what is invisible goes, then full-width forms (as far from ASCII as the first of them),
    kana, blanks and letters are translated one by one, and accents composed."""
    wide = "".join(map(chr, range(0xFF01, 0xFF5F)))
    pairs = [(wide, "".join(chr(ord(c) - 0xFEE0) for c in wide)), _KANA, _MARKS, _GREEK, _CYRILLIC]
    out = rf"nfc_normalize(regexp_replace({value}, '[\p{{Cf}}\x{{034F}}]', '', 'g'))"
    for one, two in pairs:
        out = f"translate({out}, '{one.replace("'", "''")}', '{two.replace("'", "''")}')"
    # Letters may have been composed with an accent before they were translated.
    return f"trim(nfc_normalize({out}))"


_USABLE = r"""
    records as (select distinct synset_id, rec_id, list_name, label, latitude, longitude, start_date, modified from synset_record),
    placed as (select r.*, a.trust_rank,
        regexp_matches(label, '[A-Za-z0-9]') and lower(trim(label)) not in ('unknown', 'none', 'null', 'nil', 'nan', 'na', 'n/a', 'tbd', 'tba', 'not available', 'not applicable', 'undefined', 'unspecified', 'unnamed', 'missing') as ok_label,
        latitude between -90 and 90 and longitude between -180 and 360 and not isnan(latitude) and not isnan(longitude) and not (latitude = 0 and longitude = 0) as ok_position,
        regexp_matches(start_date, '^[+]?[0-9]{4}') and not regexp_matches(start_date, '^[+]?(0000|9999|2000-01-01)') as ok_start
        from records r left join list_authority a using (list_name)),
    sizes as (select synset_id from records group by 1 having count(*) > 1)"""

ORACLE_SQL = {
    "p1_found": f"""with v as (select distinct 'label' as field, name_id, label as v from skos_label where label is not null union select 'alt_label', name_id, alt_label from skos_label where alt_label is not null),
        s as (select field, name_id, v, {_shape_sql('v')} as shape from v)
        select a.field, a.name_id as name_id_a, b.name_id as name_id_b from s a join s b on a.field = b.field and a.shape = b.shape and a.name_id < b.name_id where a.v <> b.v and a.shape <> ''""",
    "p1_members": f"""with v as (select distinct 'label' as field, name_id, label as v from skos_label where label is not null union select 'alt_label', name_id, alt_label from skos_label where alt_label is not null),
        s as (select field, name_id, v, {_shape_sql('v')} as shape from v)
        select field, name_id, min(name_id) over (partition by field, shape, v) as variant_id, min(name_id) over (partition by field, shape) as class_id from s where shape <> ''""",
    "p4_found": f"""with {_USABLE}
        select synset_id,
            arg_min(rec_id, (trust_rank, -epoch_us(modified), rec_id)) filter (ok_label) as label_rec_id,
            arg_min(rec_id, (trust_rank, -epoch_us(modified), rec_id)) filter (ok_position) as position_rec_id,
            arg_min(rec_id, (trust_rank, -epoch_us(modified), rec_id)) filter (ok_start) as start_rec_id
        from placed semi join sizes using (synset_id) group by 1""",
    "p4_golden": f"""with {_USABLE}
        select synset_id,
            arg_min(label, (trust_rank, -epoch_us(modified), rec_id)) filter (ok_label) as label,
            arg_min(latitude, (trust_rank, -epoch_us(modified), rec_id)) filter (ok_position) as latitude,
            arg_min(longitude, (trust_rank, -epoch_us(modified), rec_id)) filter (ok_position) as longitude,
            arg_min(start_date, (trust_rank, -epoch_us(modified), rec_id)) filter (ok_start) as start_date
        from placed semi join sizes using (synset_id) group by 1""",
    "p2_found": r"""
        with recursive given as (
            select rec_id as id, unnest(list_concat([code, nssdca_id], coalesce(prior_id, []::varchar[]))) as i from spase_record
            union all select group_id, unnest([code, nssdca_id]) from observatory_group),
        named as (select distinct id, regexp_replace(regexp_replace(lower(i), '^\s+', ''), '\s*\.?\s*$', '') as i from given where i is not null),
        kept as (select * from named where regexp_matches(i, '[a-z0-9]') and i not in ('n/a', 'na', 'none', 'null', 'nil', 'nan', 'unknown', 'undefined', 'unspecified', 'not available', 'not applicable', 'no identifier', 'no id', 'missing', 'tbd', 'void')),
        hub as (select i, min(id) as lo from kept group by i having count(*) > 1),
        edge as (select distinct k.id as a, h.lo as b from kept k join hub h using (i) where k.id <> h.lo),
        both_ways as (select a, b from edge union select b, a from edge),
        vertex as (select distinct a as id from both_ways),
        reach as (select id, id as low from vertex union select e.b, r.low from reach r join both_ways e on e.a = r.id and r.low < e.b)
        select id as rec_id, min(low) as group_id from reach group by id""",
}
