"""Mixing sources to target weights by Pareto order sampling.

A source's target is its weight's share of all words, at most ``cap`` times its
own words, with what exceeds that shared again by weight among the others.  Each
document gets floor(target / size of its source) certain whole copies.  The rest
of the target is drawn by Pareto order sampling with unequal probabilities: with r
the share of the source's words still wanted, a document's chance of one more copy
falls in a line from at most 1 - (1 - r)**2 for its smallest size class to at least
r**2 for its largest (a class holds the sizes of equal bit length), so that few long
documents do not fill the rest of a target; within a source the chances times the
sizes add up to the rest.  A document with inclusion probability p and a random
number u is ranked by (u/(1-u)) / (p/(1-p)), and the lowest ranks are taken.

The sample's size is fixed in words: the longest prefix of the ranking that fits.
What the document after that prefix leaves open, less than its size, goes to the
next documents in the ranking that fit in it, in ``PASSES`` - 1 further passes.

u depends on doc_id, text and seed.  Equal rows have equal ranks; where the end of
a sample falls inside such a group, exactly as many of its rows are drawn as still fit,
the first by their place, so that the mix is the same however the rows are partitioned.

Only narrow rows are shuffled, never texts: words per (source, rank bin) tell the
bin in which a sample ends, and only rows of that bin are sorted.  One row per
source is sorted in one task to share the excess.

Defined cases: a null source is one more source, ranked last; null and blank
texts have size 0 and no copy beyond the certain ones of their source's ratio;
null doc_ids rank first among equal ranks; an empty table gives an empty result;
columns of the input pass through, and those named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prismarq.llm.common import WORD_PATTERN, fresh, small, write_table

WEIGHTS = (1.0, 2.0, 3.0)
CAP = 3.0
BINS = 4096
PASSES = 3
SEED = "mix-1"

_KEY = "struct<rank:double,has_id:boolean,doc_id:bigint,digest:string,size:bigint>"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """(source, source_size, target, whole, rate, rest) from (source, size) rows.

    ``whole`` certain copies, inclusion probability ``rate`` of one more, and
    ``rest``, the words still wanted.  Shares are settled in one sweep: in order of
    size over weight, sources stop at the cap as long as the equal share per weight
    of what is left would exceed theirs.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    per = per.withColumn("weight", F.element_at(F.lit([float(w) for w in weights]), (place + 1).cast("int")))
    per = per.withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    per = per.withColumn("per_weight", left / F.sum("weight").over(after))
    stops = F.col("most") / F.col("weight") < F.col("per_weight")
    # The share grows while sources stop and falls afterwards: the first that does not stop has the largest and final one.
    level = F.max(F.when(~stops, F.col("per_weight"))).over(everything)
    per = per.withColumn("target", F.when(stops, F.col("most")).otherwise(F.least(F.col("most"), F.col("weight") * level)))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    per = per.withColumn("whole", F.floor(ratio)).withColumn("rate", ratio - F.col("whole"))
    rest = F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size"))
    return per.select("source", "source_size", "target", F.col("whole").cast("long").alias("whole"), "rate", rest.alias("rest"))


def size_class(size: Column) -> Column:
    """Bit length of a size."""
    return F.length(F.bin(size))


def class_rates(lean: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, class, p): inclusion probabilities of one more copy, by source and size class.

    p = r + r * (1 - r) * z, with r the source's ``rest`` over its words and z in [-1, 1]: how far the
    class lies below the mean class of the source's words, over the longest such way.
    """
    words = lean.where("size > 0").groupBy("source", size_class(F.col("size")).alias("class")).agg(F.sum("size").alias("words")).withColumnRenamed("source", "s")
    rows = words.join(small(targets.select("source", "rest")), F.col("s").eqNullSafe(F.col("source")))
    by = Window.partitionBy("source")
    rows = rows.withColumn("all", F.sum("words").over(by))
    rows = rows.withColumn("below", F.sum(F.col("class") * F.col("words")).over(by) / F.col("all") - F.col("class"))
    rows = rows.withColumn("r", F.least(F.lit(1.0), F.col("rest") / F.col("all"))).withColumn("way", F.max(F.abs("below")).over(by))
    z = F.when(F.col("way") > 0, F.col("below") / F.col("way")).otherwise(F.lit(0.0))
    return rows.select("source", "class", (F.col("r") + F.col("r") * (1 - F.col("r")) * z).alias("p"))


def random_unit(doc_id: Column, digest: Column, seed: str) -> Column:
    """A number in (0, 1) that depends on the seed, the id and the text."""
    text = F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), digest)
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def pareto_rank(u: Column, p: Column) -> Column:
    """Random odds over inclusion odds; infinite where inclusion is impossible."""
    return F.when(p > 0, (u / (1 - u)) * ((1 - p) / p)).otherwise(F.lit(float("inf")))


def _key() -> Column:
    return F.struct("rank", "has_id", "doc_id", "digest", "size")


def _bin() -> Column:
    scaled = F.when(F.col("rank") == float("inf"), F.lit(BINS - 1)).otherwise(F.floor(F.col("rank") / (1 + F.col("rank")) * BINS))
    return F.least(scaled, F.lit(BINS - 1)).cast("int")


def _cut(rows: DataFrame) -> DataFrame:
    """(s, used, cut): per source, the words of the longest prefix that fits in ``gap``, and the group of equal rows where it ends.

    ``rows``: source, gap, spot and the ranking's columns.  ``cut``: that group's key, and the ``place`` of the first of its
    rows that is out; null if all rows fit.
    """
    rows = rows.withColumn("bin", _bin())
    bins = rows.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.first("gap").alias("gap"))
    order = Window.partitionBy("source").orderBy("bin")
    bins = write_table(bins.withColumn("upto", F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    whole = bins.groupBy("source").agg(F.coalesce(F.max(F.when(F.col("upto") <= F.col("gap"), F.col("upto"))), F.lit(0)).alias("base"), F.min(F.when(F.col("upto") > F.col("gap"), F.col("bin"))).alias("open"))
    whole = write_table(whole.withColumnRenamed("source", "s"))
    inside = rows.join(small(whole.where("open is not null")), F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("open"))).drop("s")
    groups = inside.groupBy("source", "gap", "base", "rank", "has_id", "doc_id", "digest", "size").count()
    before = Window.partitionBy("source").orderBy("rank", "has_id", "doc_id", "digest", "size").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("before", F.col("base") + F.coalesce(F.sum(F.col("size") * F.col("count")).over(before), F.lit(0)))
    ends = groups.where((F.col("before") <= F.col("gap")) & (F.col("before") + F.col("size") * F.col("count") > F.col("gap")))
    drawn = F.floor((F.col("gap") - F.col("before")) / F.col("size"))
    ends = write_table(ends.select(F.col("source").alias("e"), (F.col("before") + drawn * F.col("size")).alias("end"), _key().alias("key"), drawn.alias("drawn")))
    places = _places(inside, ends)
    ends = ends.join(small(places), F.col("e").eqNullSafe(F.col("o")), "left").select("e", "end", F.struct("key", F.coalesce("place", F.lit(-1).cast("long")).alias("place")).alias("cut"))
    found = whole.join(small(write_table(ends)), F.col("s").eqNullSafe(F.col("e")), "left")
    return found.select("s", F.coalesce("end", "base").cast("long").alias("used"), "cut")


def _places(inside: DataFrame, ends: DataFrame) -> DataFrame:
    """(o, place): for sources whose cut leaves a part of a group of equal rows in, the place of the first row that is out.

    Counts by the partition that a place names tell the one in which the group is cut; only that one's rows are sorted.
    """
    split = ends.where("drawn > 0")
    if split.isEmpty():
        return split.select(F.col("e").alias("o"), F.lit(None).cast("long").alias("place"))
    same = F.col("source").eqNullSafe(F.col("e")) & _key().eqNullSafe(F.col("key"))
    members = inside.join(small(split), same).select(F.col("source").alias("o"), "drawn", "spot", F.shiftright("spot", 33).alias("part"))
    parts = members.groupBy("o", "part", "drawn").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("o").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.withColumn("skip", F.col("drawn") - before).where((F.col("skip") >= 0) & (F.col("skip") < F.col("n")))
    parts = write_table(parts.select(F.col("o").alias("q"), F.col("part").alias("r"), "skip"))
    held = members.join(small(parts), F.col("o").eqNullSafe(F.col("q")) & (F.col("part") == F.col("r")))
    ranked = held.withColumn("nth", F.row_number().over(Window.partitionBy("o").orderBy("spot")))
    return write_table(ranked.where(F.col("nth") == F.col("skip") + 1).select("o", F.col("spot").alias("place")))


def mix_plan(lean: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP, seed: str = SEED, passes: int = PASSES) -> tuple[DataFrame, DataFrame]:
    """Per source: targets and ``cuts``, one struct (room, cut) per pass; and ``class_rates``. ``lean``: doc_id, source, size, digest, spot."""
    per = write_table(source_targets(lean, weights, cap))
    rates = write_table(class_rates(lean, per))
    cuts = per.select("source", F.col("rest").alias("gap"), F.expr(f"cast(array() as array<struct<room:double,cut:struct<key:{_KEY},place:bigint>>>)").alias("cuts"))
    for _ in range(passes):
        rows = _ranked(lean, small(cuts), rates, seed)
        rows = rows.where((F.col("extra") == 0) & (F.col("size") > 0) & (F.col("size") <= F.col("gap")))
        found = _cut(rows)
        cuts = cuts.join(found, F.col("source").eqNullSafe(F.col("s")), "left").select(
            "source", (F.col("gap") - F.coalesce(F.col("used"), F.lit(0))).alias("gap"),
            F.when(F.col("used").isNull(), F.col("cuts")).otherwise(F.concat("cuts", F.array(F.struct(F.col("gap").alias("room"), "cut")))).alias("cuts"))
        cuts = write_table(cuts)
    done = cuts.select(F.col("source").alias("s"), "cuts")
    return write_table(per.join(done, F.col("source").eqNullSafe(F.col("s"))).drop("s")), rates


def _ranked(rows: DataFrame, per: DataFrame, rates: DataFrame, seed: str) -> DataFrame:
    """``rows`` with their source's columns, ``rank`` and ``extra`` (1 if drawn by any pass so far)."""
    per = per.withColumnRenamed("source", "s")
    rows = rows.join(per, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rates = rates.withColumnsRenamed({"source": "s", "class": "c"})
    rows = rows.join(small(rates), F.col("source").eqNullSafe(F.col("s")) & (size_class(F.col("size")) == F.col("c")), "left").drop("s", "c")
    rank = pareto_rank(random_unit(F.col("doc_id"), F.col("digest"), seed), F.coalesce("p", F.lit(0.0)))
    rows = rows.withColumn("rank", rank).withColumn("has_id", F.col("doc_id").isNotNull()).drop("p")
    key = _key()
    below = lambda c: c["cut"].isNull() | (key < c["cut"]["key"]) | (key.eqNullSafe(c["cut"]["key"]) & (F.col("spot") < c["cut"]["place"]))
    # What an earlier pass could not take, a later one sees again with less room; rows of a group that a cut went through are settled.
    drawn = F.exists("cuts", lambda c: (F.col("size") <= c["room"]) & below(c))
    return rows.withColumn("extra", F.when(drawn & (F.col("size") > 0), 1).otherwise(0).cast("long"))


def lean_rows(docs: DataFrame, size: Column | None = None) -> DataFrame:
    """Written (doc_id, source, size, digest, spot) of ``docs``; ``spot``, the row's place, tells equal rows apart."""
    size = word_count(F.col("text")) if size is None else size
    return write_table(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", size.alias("size"), _digest(), _spot()))


def _digest() -> Column:
    return F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("digest")


def _spot() -> Column:
    return F.monotonically_increasing_id().alias("spot")


def mix_sources(docs: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP, seed: str = SEED, passes: int = PASSES, size: Column | None = None) -> DataFrame:
    """``docs`` (doc_id, source, text, ...) with ``size, source_size, target, copies, taken``.

    ``copies`` is how often the mix repeats the row, ``taken`` = copies * size.
    """
    size = word_count(F.col("text")) if size is None else size
    plan, rates = mix_plan(lean_rows(docs, size), weights, cap, seed, passes)
    docs = docs.drop("size", "source_size", "target", "copies", "taken").withColumn("size", size)
    kept = [c for c in docs.columns if c not in ("doc_id", "source", "size")]
    (held,) = fresh(docs, "row")
    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "size", _digest(), _spot(), F.struct(F.col("doc_id").alias("doc_id"), *kept).alias(held))
    rows = _copies(packed, plan, rates, seed)
    order = [F.col(held)[c].alias(c) if c != "source" else F.col("source") for c in docs.columns if c != "size"]
    return rows.select(*order, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _copies(rows: DataFrame, plan: DataFrame, rates: DataFrame, seed: str) -> DataFrame:
    return _ranked(rows, small(plan), rates, seed).withColumn("copies", F.col("whole") + F.col("extra"))


def repeat_rows(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The mix itself: each row as often as its ``copies`` say."""
    (n,) = fresh(mixed, "n")
    rows = mixed.where("copies > 0").withColumn(n, F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return rows.select(*columns)


def op2_pareto_mix(spark, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document."""
    lean = lean_rows(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text"))
    rows = _copies(lean, *mix_plan(lean), SEED)
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def oracle(seed: str = SEED, passes: int = PASSES) -> str:
    """The same sampling without bins or broadcast."""
    weights = "[" + ", ".join(f"CAST({w} AS DOUBLE)" for w in WEIGHTS) + "]"
    steps = "".join(f"""
f{i} AS (SELECT *, sum(CASE WHEN free THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY rnk, doc_id NULLS FIRST, digest, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM (SELECT *, extra = 0 AND size > 0 AND size <= gap AS free FROM p{i - 1})),
p{i} AS (SELECT doc_id, source, size, digest, source_size, target, whole, p, rnk, CASE WHEN hit THEN 1 ELSE extra END AS extra,
  gap - sum(CASE WHEN hit THEN size ELSE 0 END) OVER (PARTITION BY source) AS gap FROM (SELECT *, free AND upto <= gap AS hit FROM f{i})),""" for i in range(1, passes + 1))  # fmt: skip
    return rf"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD_PATTERN}')), 0) AS BIGINT) AS size, md5(coalesce(text, '')) AS digest FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, {weights}[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)}] AS weight FROM d GROUP BY source),
m AS (SELECT *, CAST({CAP} AS DOUBLE) * source_size AS most FROM s),
w AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS per_weight FROM m),
t AS (SELECT source, source_size, CASE WHEN most / weight < per_weight THEN most ELSE least(most, weight * max(CASE WHEN NOT (most / weight < per_weight) THEN per_weight END) OVER ()) END AS target FROM w),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio FROM t),
q AS (SELECT *, floor(ratio) AS whole, greatest(0, target - floor(ratio) * source_size) AS rest FROM r),
c AS (SELECT d.source, length(bin(size)) AS class, CAST(sum(size) AS DOUBLE) AS words, any_value(q.rest) AS rest FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source WHERE size > 0 GROUP BY d.source, length(bin(size))),
x AS (SELECT *, sum(words) OVER (PARTITION BY source) AS everything FROM c),
l AS (SELECT *, sum(class * words) OVER (PARTITION BY source) / everything - class AS below, least(1.0, rest / everything) AS r FROM x),
v AS (SELECT source, class, r + r * (1 - r) * CASE WHEN way > 0 THEN below / way ELSE 0 END AS p FROM (SELECT *, max(abs(below)) OVER (PARTITION BY source) AS way FROM l)),
u AS (SELECT d.*, q.source_size, q.target, CAST(q.whole AS BIGINT) AS whole, q.rest AS gap, coalesce(v.p, 0) AS p,
  (CAST(CAST('0x' || substr(md5('{seed}|' || coalesce(CAST(d.doc_id AS VARCHAR), '') || '|' || digest), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source LEFT JOIN v ON d.source IS NOT DISTINCT FROM v.source AND length(bin(d.size)) = v.class),
p0 AS (SELECT doc_id, source, size, digest, source_size, target, whole, p, CASE WHEN p > 0 THEN (u / (1 - u)) * ((1 - p) / p) ELSE 'inf'::DOUBLE END AS rnk, 0 AS extra, gap FROM u),{steps}
o AS (SELECT * FROM p{passes})
SELECT doc_id, size, source_size, target, CAST((whole + extra) * size AS BIGINT) AS taken FROM o"""


ORACLE_SQL = oracle()
