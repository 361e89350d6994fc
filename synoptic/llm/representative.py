"""Problem 4: the best representative of each duplicate group, field by field.

Iterative truth discovery. Every usable value of a field is a claim of its record's source. In each round the support of
a value within its group is the weighted sum of its claims, the value of the highest support is taken for true, and a
source's reliability becomes the (smoothed) share of its claims that agree with the truth; rounds end when no reliability
moves by more than TOLERANCE.

The weight of a claim is a product of three parts:

- its source's log-odds of being right, from the reliability that was found (bounded to WEAKEST..STRONGEST);
- its source's stated trust: a base (BASE times the most sources of one rank) to the power of how many ranks it is below
  the best rank of its group, inverted. The base is so large that the claims of all lower ranks together weigh less than half of one claim of the source above them; sources without
  a rank share the last one, where reliabilities and numbers of claims alone decide;
- its recency within its source and group: the latest counts 1, all earlier ones together one half, so that a source's
  latest value leads its earlier ones. Several claims of a source to one value count by their share.

So the vote alone decides: between ranks by trust, within a rank by the estimated reliabilities, and within a source by
time, while agreement with lower ranks breaks what is left open.

Everything is an aggregate by (group, field, value), (group, field) or (source): partial aggregation takes up a group or
value with a third of all rows. Votes are weighed and written once; each round reads them twice.

Nulls: a record without group or id is left out; a null source has the lowest trust and a reliability of its own. Where no
value of a field is usable, its record id is null. Repeated rows of one record count once. Ties go to the later record,
then the smaller id. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from synoptic.runtime import Scratch

#: Words that stand for "unknown", lower case. Signs alone (no letter or digit) do as well.
UNKNOWN = ["unknown", "none", "null", "nil", "nan", "na", "n/a", "n.a.", "tbd", "tba", "not available", "not applicable", "undefined", "unspecified", "unnamed", "missing"]
#: Fixed value: the start date that is dropped as a default.
DEFAULT_DATE = "2000-01-01"
ROUNDS, TOLERANCE = 10, 1e-3
#: Weights: BASE - 1 > 3 * STRONGEST / WEAKEST, see above.
WEAKEST, STRONGEST, BASE = 0.01, 5.0, 4096.0


def usable_text(value: Column) -> Column:
    bare = F.lower(F.regexp_replace(value, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    return F.coalesce(bare.rlike(r"[\p{L}\p{N}]") & ~bare.isin(UNKNOWN), F.lit(False))


def usable_position(lat: Column, lon: Column) -> Column:
    return F.coalesce(~F.isnan(lat) & ~F.isnan(lon) & lat.between(-90, 90) & lon.between(-180, 360) & ~((lat == 0) & (lon == 0)), F.lit(False))


def usable_date(value: Column, latest_year: int = 2100) -> Column:
    """A year, a month or a day of the calendar (month and day 00 mean "not stated"), no default date."""
    bare = F.regexp_replace(F.trim(value), r"^\+", "")
    part = lambda i: F.regexp_extract(bare, r"^(\d{4})(?:-(\d{2}))?(?:-(\d{2}))?(?:T.*)?$", i)
    year, month, day = part(1), part(2), part(3)
    real = (year == "") | F.try_to_date(F.concat_ws("-", year, F.when(month.isin("", "00"), "01").otherwise(month), F.when(day.isin("", "00"), "01").otherwise(day)), "yyyy-MM-dd").isNotNull()
    fits = (year != "") & (year.cast("int") > 0) & (year.cast("int") < latest_year) & real
    return F.coalesce(fits & ~bare.startswith(DEFAULT_DATE), F.lit(False))


def claims(records: DataFrame, group: str, key: str, source: str, changed: str, fields: dict[str, tuple[Column, Column]], trust: DataFrame) -> DataFrame:
    """(g, field, value, id, source, rank, changed): the usable values. `fields` gives for each field its value as text
    and whether it is usable; `trust` has (source, rank), 1 the most trusted."""
    entries = F.filter(F.array(*[F.struct(F.lit(f).alias("field"), v.cast("string").alias("value"), ok.alias("ok")) for f, (v, ok) in fields.items()]), lambda e: e["ok"])
    ranks = trust.groupBy("source").agg(F.min("rank").alias("rank"))
    rows = records.where(F.col(group).isNotNull() & F.col(key).isNotNull()).select(F.col(group).alias("g"), F.col(key).alias("id"), F.col(source).alias("source"), F.col(changed).alias("changed"), F.explode(entries).alias("e"))
    return rows.select("g", "e.field", "e.value", "id", "source", "changed").distinct().join(ranks, "source", "left")


def votes_of(stated: DataFrame, scratch: Scratch) -> DataFrame:
    """(g, field, value, source, n, weight, changed, neg): each source's claims to a value, with the weight of its trust and
    recency, and the time and negative id of the latest."""
    last = F.struct(F.coalesce("changed", F.lit("0001-01-01").cast("timestamp")).alias("changed"), (-F.col("id")).alias("neg"))
    votes = scratch.write(stated.groupBy("g", "field", "value", "source").agg(F.max(last).alias("last"), F.count("*").alias("n"), F.min("rank").alias("rank")))
    same = F.col("source").eqNullSafe(F.col("s2")) & (F.col("g") == F.col("g2")) & (F.col("field") == F.col("f2"))
    own = votes.groupBy(F.col("g").alias("g2"), F.col("field").alias("f2"), F.col("source").alias("s2")).agg(F.max("last").alias("latest"), F.sum("n").alias("claims"))
    # Ranks are whole numbers from 1 on; sources without one stand behind all that have one.
    ranks = votes.select("rank", "source").distinct().groupBy("rank").count()
    worst, crowd = ranks.agg(F.coalesce(F.max("rank"), F.lit(0)) + 1, F.coalesce(F.max("count"), F.lit(1))).first()
    best = votes.groupBy(F.col("g").alias("g3"), F.col("field").alias("f3")).agg(F.min(F.coalesce("rank", F.lit(worst))).alias("best"))
    rows = votes.join(own, same).join(best, (F.col("g") == F.col("g3")) & (F.col("field") == F.col("f3")))
    trust = F.pow(F.lit(BASE * crowd), (F.col("best") - F.coalesce("rank", F.lit(worst))).cast("double"))
    recency = F.when(F.col("last") == F.col("latest"), F.lit(1.0)).otherwise(F.col("n") / F.col("claims") / 2)
    return rows.select("g", "field", "value", "source", "n", (trust * recency).alias("weight"), "last.changed", "last.neg")


def discover(stated: DataFrame, name: str = "truth", rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """((g, field, value, id), (source, reliability)): the value of the highest support in each group and field, with its
    best record, and the sources' reliabilities after at most `rounds` rounds (1: those that all start with)."""
    scratch = Scratch(stated.sparkSession, name)
    votes = scratch.write(votes_of(stated, scratch))
    reliability = scratch.write(votes.groupBy("source").agg(F.lit(0.8).alias("reliability")))
    truth = None
    for _ in range(rounds):
        # As many rows as there are sources, whose claims are spread over all groups.
        weighed = votes.join(reliability.withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
        odds = F.least(F.greatest(F.log(F.col("reliability") / (1 - F.col("reliability"))), F.lit(WEAKEST)), F.lit(STRONGEST))
        by_value = weighed.groupBy("g", "field", "value").agg(F.sum(F.col("weight") * odds).alias("support"), F.max(F.struct("changed", "neg")).alias("last"), F.max_by("neg", F.struct("weight", "changed", "neg")).alias("lead"))
        # Sums depend on their order in the last digits: supports that differ by less are ties.
        order = F.struct(F.round(F.log("support"), 9).alias("support"), "last.changed", "last.neg")
        if truth is not None:
            scratch.drop(truth)
        truth = scratch.write(by_value.groupBy("g", "field").agg(F.max_by(F.struct("value", (-F.col("lead")).alias("id")), order).alias("t")).select("g", "field", "t.value", "t.id"))
        agree = votes.join(truth.select("g", "field", F.col("value").alias("true_value")), ["g", "field"])
        found = scratch.write(agree.groupBy("source").agg(((F.sum(F.when(F.col("value") == F.col("true_value"), F.col("n")).otherwise(0)) + 1) / (F.sum("n") + 2)).alias("reliability")))
        moved = found.join(reliability.select(F.col("source").alias("s2"), F.col("reliability").alias("was")), F.col("source").eqNullSafe(F.col("s2"))).agg(F.max(F.abs(F.col("reliability") - F.col("was")))).first()[0]
        scratch.drop(reliability)
        reliability = found
        if moved is None or moved <= TOLERANCE:
            break
    return truth, reliability


def representatives(records: DataFrame, group: str, key: str, source: str, changed: str, fields: dict[str, tuple[Column, Column]], trust: DataFrame, name: str = "truth", least: int = 2) -> DataFrame:
    """One row for each group of `least` records or more: (g, and for each field f the value f and the record f_id that it
    is taken from)."""
    sizes = records.where(F.col(group).isNotNull() & F.col(key).isNotNull()).select(F.col(group).alias("g"), F.col(key).alias("id")).distinct().groupBy("g").count().where(F.col("count") >= least).select("g")
    truth, _ = discover(claims(records, group, key, source, changed, fields, trust), name)
    wide = truth.groupBy("g").agg(*[c for f in fields for c in (F.max(F.when(F.col("field") == f, F.col("value"))).alias(f), F.max(F.when(F.col("field") == f, F.col("id"))).alias(f"{f}_id"))])
    return sizes.join(wide, "g", "left")
