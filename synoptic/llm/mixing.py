"""Problem 9: mixing sources to target weights.

Each source's texts are put in a random but fixed order and cut into blocks of equal tokens (a text belongs to the block
in which its first token falls). The schedule has one slot a block: slot i goes to the source whose stretch of the
cumulative weights holds the golden-ratio point frac(i * phi), so any run of slots has nearly the target shares. A
source's k-th slot takes its k-th block; after its last block it starts again, at most max_repeat times in all.

The number of slots is the largest at which no source would exceed its repeats, so shares are reached and no text is
repeated too often; with a stated total size, at most as many as that takes. A target without texts cannot be served: the weights of the others are scaled to one. Sources without
a target contribute nothing.

The number of slots follows the data (as many as blocks), so slots are made by a distributed range; ranks of slots within
a source and tokens before a text are two-level running totals, so that no task holds a whole source.

Nulls: texts that are null or empty have no tokens and are no part of a mix; a null source or weight, a weight of 0 or
less and max_repeat under 1 count as no target. Repeated rows of one id count once. Empty tables give an empty mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from synoptic.runtime import Scratch, running_total

PHI = 0.6180339887498949
#: Tokens of a block at most, and blocks of the smallest source at least.
BLOCK_TOKENS, SMALLEST_BLOCKS = 4096, 256
#: Texts a bucket of the running totals.
BUCKET_ROWS = 20_000


def plan(totals: list[tuple[str, int]], targets: list[tuple[str, float, int]], size: int | None = None) -> tuple[list[tuple], int, int]:
    """Of each source that is served (list_name, low, high, blocks, max_repeat): its stretch of the unit interval; the
    number of slots; and the tokens of a block: the smallest source has at least SMALLEST_BLOCKS of them. Inputs have one
    row a target."""
    have = dict(totals)
    served = [(s, float(w), int(m), int(have[s])) for s, w, m in sorted(t for t in targets if None not in t) if w > 0 and m >= 1 and have.get(s)]
    if not served:
        return [], 0, 0
    whole = sum(w for _, w, _, _ in served)
    block = max(1, min(BLOCK_TOKENS, min(n for *_, n in served) // SMALLEST_BLOCKS))
    most = min(m * n / (w / whole) for _, w, m, n in served)
    slots = int(min(most, size or most) / block)
    out, low = [], 0.0
    for s, w, m, n in served:
        out.append((s, low, low + w / whole, -(-n // block), m))
        low += w / whole
    out[-1] = (*out[-1][:2], 1.0, *out[-1][3:])
    return out, max(1, slots), block


def mix(texts: DataFrame, key: str, source: str, tokens: str, targets: DataFrame, name: str = "mix", seed: int = 7, size: int | None = None) -> DataFrame:
    """(position, list_name, doc_id, repeat, n_tokens): the mix, ordered by position. `targets` has list_name, weight and
    max_repeat; repeat counts from 1. `size` is the number of tokens that is wanted, to a block; without it, or where the
    texts do not last so long, the mix is as long as they do."""
    spark = texts.sparkSession
    scratch = Scratch(spark, name)
    sized = scratch.write(texts.where(F.col(key).isNotNull() & F.col(source).isNotNull()).groupBy(F.col(key).alias("doc_id")).agg(F.min(source).alias("list_name"), F.max(tokens).alias("n_tokens")).where("n_tokens > 0"))
    wanted = targets.select("list_name", "weight", "max_repeat").where("list_name is not null")
    # One row a target: the schedule of sources is made on the driver.
    rows = [tuple(r) for r in wanted.groupBy("list_name").agg(F.max("weight"), F.max("max_repeat")).collect()]
    totals = [tuple(r) for r in sized.join(wanted.select("list_name").distinct(), "list_name").groupBy("list_name").agg(F.sum("n_tokens")).collect()]
    stretches, slots, block = plan(totals, rows, size)
    shape = "list_name string, low double, high double, blocks bigint, max_repeat int"
    if not stretches:
        return spark.createDataFrame([], "position bigint, list_name string, doc_id bigint, repeat bigint, n_tokens bigint")
    lanes = F.broadcast(spark.createDataFrame(stretches, shape))  # one row a target

    buckets = max(1, -(-sized.count() // BUCKET_ROWS))
    shuffled = sized.join(lanes, "list_name").select("list_name", "doc_id", "n_tokens", F.xxhash64("doc_id", F.lit(seed)).alias("h"))
    # The bucket is the high part of the hash, so that it grows along the order.
    bucket = F.floor((F.col("h").cast("double") / float(1 << 63) + 1.0) / 2.0 * buckets)
    placed = running_total(shuffled, ["list_name"], [F.col("h"), F.col("doc_id")], bucket, F.col("n_tokens"), "before")
    blocks = scratch.write(placed.select("list_name", F.floor(F.col("before") / block).alias("block"), "doc_id", "n_tokens", "before"))

    slot_buckets = max(1, slots // BUCKET_ROWS)
    points = spark.range(slots).withColumn("u", (F.col("id") + 1) * F.lit(PHI) % 1.0)
    met = points.join(lanes, (F.col("u") >= F.col("low")) & (F.col("u") < F.col("high")))
    ranked = running_total(met, ["list_name"], [F.col("id")], F.floor(F.col("id") * slot_buckets / slots), F.lit(1), "rank")
    pass_no = F.floor(F.col("rank") / F.col("blocks"))
    due = ranked.where(pass_no < F.col("max_repeat")).select(F.col("id").alias("slot"), "list_name", (F.col("rank") % F.col("blocks")).alias("block"), (pass_no + 1).cast("bigint").alias("repeat"))
    out = due.join(blocks, ["list_name", "block"])
    return out.select((F.col("slot") * block + F.pmod(F.col("before"), F.lit(block))).cast("bigint").alias("position"), "list_name", "doc_id", "repeat", "n_tokens")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(list_name, target_share, actual_share, n_tokens, n_records, max_repeat_used) of every target."""
    got = mixed.groupBy("list_name").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_records"), F.max("repeat").alias("max_repeat_used"))
    whole = got.agg(F.sum("n_tokens").alias("all_tokens"))
    goal = targets.where("list_name is not null").groupBy("list_name").agg(F.max("weight").alias("target_share"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return goal.join(got, "list_name", "left").crossJoin(F.broadcast(whole)).select("list_name", "target_share", F.coalesce(F.col("n_tokens") / F.col("all_tokens"), F.lit(0.0)).alias("actual_share"), zero("n_tokens"), zero("n_records"), zero("max_repeat_used"))
