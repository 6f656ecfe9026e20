"""Order statistics of groups of any size: global ranks, normal quantiles, sums of normal scores.

Values are counted first, dealt to stretches between approximate quantiles and ranked
inside each, after what the stretches before it hold.  Where the quantiles fall decides
only how the work is dealt, never a rank.  No group, and no value that many rows share,
meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Stretches that a group's values are ranked in.
STRETCHES = 200
#: Ranks that one row stands for while normal scores are summed.
RUN = 4096

# Wichura's rational approximations of the normal quantile (AS 241, 1988), lowest power first.
CENTRE = (
    (3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427, 13731.693765509461125, 45921.953931549871457, 67265.770927008700853, 33430.575583588128105, 2509.0809287301226727),
    (1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077, 21213.794301586595867, 39307.895800092710610, 28729.085735721942674, 5226.4952788528545610),
)
SIDE = (
    (1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504, 1.27045825245236838258, 0.241780725177450611770, 0.0227238449892691845833, 0.000774545014278341407640),
    (1.0, 2.05319162663775882187, 1.67638483018380384940, 0.689767334985100004550, 0.148103976427480074590, 0.0151986665636164571966, 0.000547593808499534494600, 1.05075007164441684324e-9),
)
TAIL = (
    (6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 0.296560571828504891230, 0.0265321895265761230930, 0.00124266094738807843860, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 0.599832206555887937690, 0.136929880922735805310, 0.0148753612908506148525, 0.000786869131145613259100, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
)


def _ratio(pair: tuple[tuple[float, ...], tuple[float, ...]], x: Column) -> Column:
    def value(powers: tuple[float, ...]) -> Column:
        out = F.lit(powers[-1])
        for p in reversed(powers[:-1]):
            out = out * x + p
        return out

    return value(pair[0]) / value(pair[1])


def normal_quantile(p: Column) -> Column:
    """The value below which a share p of the normal distribution lies, to about sixteen digits."""
    q = p - 0.5
    far = F.sqrt(-F.log(F.least(p, 1 - p)))
    outer = F.when(far <= 5, _ratio(SIDE, far - 1.6)).otherwise(_ratio(TAIL, far - 5.0))
    return F.when(F.abs(q) <= 0.425, q * _ratio(CENTRE, 0.180625 - q * q)).otherwise(F.signum(q) * outer)


def ranked(rows: DataFrame, value: str, *kept: Column) -> DataFrame:
    """(g, value, t, start): distinct values of each group, how many rows hold each and how many hold smaller ones.

    ``kept`` are further aggregates of the rows of one value.
    """
    cuts = rows.groupBy("g").agg(F.percentile_approx(value, [i / STRETCHES for i in range(1, STRETCHES)], 10000).alias("cuts"))
    counted = rows.groupBy("g", value).agg(F.count("*").alias("t"), *kept)
    dealt = counted.join(cuts, "g").withColumn("stretch", F.size(F.filter("cuts", lambda c: c < F.col(value)))).drop("cuts")
    before = Window.partitionBy("g").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    held = dealt.groupBy("g", "stretch").agg(F.sum("t").alias("held")).select("g", "stretch", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("g", "stretch").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("inside", F.coalesce(F.sum("t").over(inside), F.lit(0)))
    return placed.join(held, ["g", "stretch"]).withColumn("start", F.col("base") + F.col("inside")).drop("stretch", "base", "inside")


def normal_scores(values: DataFrame, sizes: DataFrame, value: str) -> DataFrame:
    """(g, mx, mm, first, second, before_last, last) from ranked values and the groups' sizes (g, n).

    ``mx`` sums over all ranks i the normal score m_i times the i-th value, ``mm`` its
    square; m_i is the normal quantile of (i - 3/8) / (n + 1/4).
    """
    rows = values.join(sizes.select("g", "n"), "g")
    few = rows.where(F.col("t") <= RUN).withColumn("at", F.lit(0).cast("long"))
    many = rows.where(F.col("t") > RUN).withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("t") - 1, F.lit(RUN).cast("long"))))
    runs = few.unionByName(many.repartition(F.xxhash64(value, "at")))
    end = F.least(F.col("at") + RUN, F.col("t"))
    each = runs.select("g", "n", value, F.explode(F.sequence(F.col("start") + F.col("at") + 1, F.col("start") + end)).alias("i"))
    scored = each.withColumn("m", normal_quantile((F.col("i") - 0.375) / (F.col("n") + 0.25)))
    at = lambda i: F.max(F.when(F.col("i") == i, F.col(value)))
    return scored.groupBy("g").agg(
        F.sum(F.col("m") * F.col(value)).alias("mx"), F.sum(F.col("m") * F.col("m")).alias("mm"),
        at(1).alias("first"), at(2).alias("second"), at(F.col("n") - 1).alias("before_last"), at(F.col("n")).alias("last"),
    )
