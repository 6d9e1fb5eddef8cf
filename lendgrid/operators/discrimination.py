"""Score discrimination. Scores are in long form: keys, y (0 or 1), s (higher is riskier), id.

Records are first reduced to counts per key and distinct score; ordered windows run over those counts, so
no window ever holds the records of a key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.scalars import normal_two_sided_p
from .resampling import resampled_sums

KEY = ("score_name",)


def long_scores(df: DataFrame, scores: Mapping[str, bool], target: str, keys: Sequence[str] = (), ident: str = "authorization_id") -> DataFrame:
    """score_name, y, s, id. ``scores``: name -> whether low values are risky, which turns the sign."""
    pairs = F.array(*[F.struct(F.lit(n).alias("score_name"), (-F.col(n) if low else F.col(n)).cast("double").alias("s")) for n, low in scores.items()])
    d = df.where(F.col(target).isNotNull()).select(*keys, F.col(ident).alias("id"), F.col(target).cast("int").alias("y"), F.inline(pairs))
    return d.where("s IS NOT NULL")


def score_counts(long: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """keys, s, n, bad."""
    return long.groupBy(*keys, "s").agg(F.count("*").alias("n"), F.sum("y").cast("long").alias("bad"))


def roc_points(long: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Per distinct score, riskiest first: tpr and fpr of rejecting it and all above."""
    w, all_ = Window.partitionBy(*keys).orderBy(F.desc("s")), Window.partitionBy(*keys)
    c = score_counts(long, keys)
    bad, good = F.sum("bad").over(w), F.sum(F.col("n") - F.col("bad")).over(w)
    b, g = F.sum("bad").over(all_), F.sum(F.col("n") - F.col("bad")).over(all_)
    return c.select(*keys, "s", (bad / F.when(b > 0, b)).alias("tpr"), (good / F.when(g > 0, g)).alias("fpr"))


def auc_gini_ks(long: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """keys, n, n_bad, auc (ties count half), gini, ks. One class only: nulls."""
    return auc_of_counts(score_counts(long, keys), keys)


def auc_of_counts(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    below = Window.partitionBy(*keys).orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    up, all_ = Window.partitionBy(*keys).orderBy(F.desc("s")), Window.partitionBy(*keys)
    good = F.col("n") - F.col("bad")
    c = counts.select(
        *keys, "n", "bad", (F.col("bad") * (F.coalesce(F.sum(good).over(below), F.lit(0)) + good / 2)).alias("pairs"),
        F.sum("bad").over(up).alias("cb"), F.sum(good).over(up).alias("cg"), F.sum("bad").over(all_).alias("__b"), F.sum(good).over(all_).alias("__g"),
    )
    div = lambda a, b: a / F.when(b > 0, b)
    r = c.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("bad").alias("n_bad"), F.sum(F.col("pairs").cast("decimal(38,1)")).cast("double").alias("p"),
        F.max(F.col("__b") * F.col("__g")).cast("double").alias("bg"), F.max(div(F.col("cb"), F.col("__b")) - div(F.col("cg"), F.col("__g"))).alias("ks"),
    )
    auc = div(F.col("p"), F.col("bg"))
    return r.select(*keys, "n", "n_bad", auc.alias("auc"), (auc * 2 - 1).alias("gini"), F.greatest(F.col("ks"), F.lit(0.0)).alias("ks"))


#: Records of equal score are ordered in blocks of so many consecutive ids.
BLOCK = 1 << 16


def _ordered(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds r and bads, the number of records and of bad ones up to each record, by descending score then (integer) id, and n_all.

    What comes before is summed in three levels: scores of a key and id blocks of a score, both from counts, and the
    records of a block. So no window holds all records of a key, nor all of a score that many share.
    """
    d = long.withColumn("__block", F.floor(F.col("id") / BLOCK))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    upto = lambda c, w: F.coalesce(F.sum(c).over(earlier(w)), F.lit(0))
    blocks = d.groupBy(*keys, "s", "__block").agg(F.count("*").alias("n"), F.sum("y").alias("bad"))
    scores = blocks.groupBy(*keys, "s").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    w = Window.partitionBy(*keys).orderBy(F.desc("s"))
    scores = scores.select(*keys, "s", upto("n", w).alias("__n"), upto("bad", w).alias("__b"), F.sum("n").over(Window.partitionBy(*keys)).alias("n_all"))
    w = Window.partitionBy(*keys, "s").orderBy("__block")
    blocks = blocks.select(*keys, "s", "__block", upto("n", w).alias("__m"), upto("bad", w).alias("__c"))
    own = Window.partitionBy(*keys, "s", "__block").orderBy("id")
    d = d.withColumns({"__r": F.row_number().over(own), "__y": F.sum("y").over(own.rowsBetween(Window.unboundedPreceding, 0))})
    d = d.join(blocks, [*keys, "s", "__block"]).join(scores, [*keys, "s"])
    d = d.withColumns({"r": F.col("__n") + F.col("__m") + F.col("__r"), "bads": F.col("__b") + F.col("__c") + F.col("__y")})
    return d.drop("__block", "__n", "__b", "__m", "__c", "__r", "__y")


def ranked(long: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Adds r, the rank by descending score then id, and n_all, the number of records of the key."""
    return _ordered(long, keys).drop("bads")


def cumulative_gains(long: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """keys, id, r, bads: running number of bad records from the riskiest down, ties by id."""
    return _ordered(long, keys).select(*keys, "id", "r", "bads")


def rejection_capture(long: DataFrame, shares: Sequence[int] = (5, 10, 15, 20), keys: Sequence[str] = KEY) -> DataFrame:
    """keys, share, capture: percent of the bad among the riskiest ``int(n * share / 100)`` records."""
    r = ranked(long, keys)
    hits = [F.sum(F.when(F.col("r") <= F.floor(F.col("n_all") * t / 100), F.col("y")).otherwise(0)).alias(f"h{t}") for t in shares]
    a = r.groupBy(*keys).agg(F.sum("y").alias("b"), *hits)
    rows = F.array(*[F.struct(F.lit(t).alias("share"), F.coalesce(F.col(f"h{t}") / F.when(F.col("b") > 0, F.col("b")) * 100, F.lit(0.0)).alias("capture")) for t in shares])
    return a.select(*keys, F.inline(rows))


def precision_recall(long: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Per distinct score: precision, recall and the key's average precision."""
    w, all_ = Window.partitionBy(*keys).orderBy(F.desc("s")), Window.partitionBy(*keys)
    c = score_counts(long, keys).select(*keys, "s", (F.sum("bad").over(w) / F.sum("n").over(w)).alias("precision"), (F.sum("bad").over(w) / F.when(F.sum("bad").over(all_) > 0, F.sum("bad").over(all_))).alias("recall"))
    step = F.col("recall") - F.coalesce(F.lag("recall").over(w), F.lit(0.0))
    c = c.withColumn("__ap", step * F.col("precision"))
    return c.withColumn("average_precision", F.sum("__ap").over(all_)).drop("__ap")


def lift_table(long: DataFrame, bins: int = 10, keys: Sequence[str] = KEY) -> DataFrame:
    """Equal-count bins from the riskiest down, with shares, cumulative shares and lift, to four decimals."""
    r = ranked(long, keys).withColumn("bin", F.ceil(F.col("r") * bins / F.col("n_all")).cast("int"))
    b = r.groupBy(*keys, "bin").agg(F.count("*").alias("n_records"), F.sum("y").cast("long").alias("n_bads"))
    w, all_ = Window.partitionBy(*keys).orderBy("bin"), Window.partitionBy(*keys)
    n, bad = F.sum("n_records").over(all_), F.sum("n_bads").over(all_)
    cn, cb = F.sum("n_records").over(w), F.sum("n_bads").over(w)
    div = lambda a, b_: F.coalesce(a / F.when(b_ > 0, b_), F.lit(0.0))
    r4 = lambda c, name: F.round(c, 4).alias(name)
    rate = F.col("n_bads") / F.col("n_records")
    return b.select(
        *keys, "bin", "n_records", "n_bads", r4(rate, "bad_rate"), r4(F.col("n_records") / n, "pct_population"), r4(div(F.col("n_bads"), bad), "pct_bads"),
        r4(div(cb, bad), "cumulative_pct_bads"), r4(cn / n, "cumulative_pct_population"), r4(div(rate, bad / n), "lift"), r4(div(cb / cn, bad / n), "cumulative_lift"),
    )


def midranks(long: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Per distinct score: midrank among all, among the bad and among the good (ascending)."""
    w = Window.partitionBy(*keys).orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    mid = lambda c: F.coalesce(F.sum(c).over(w), F.lit(0)) + (c + 1) / 2
    c = score_counts(long, keys)
    return c.select(*keys, "s", mid(F.col("n")).alias("rank"), mid(F.col("bad")).alias("rank_bad"), mid(F.col("n") - F.col("bad")).alias("rank_good"))


def delong(long: DataFrame, first: str, second: str, keys: Sequence[str] = ()) -> DataFrame:
    """Paired comparison of two scores on the same records: AUCs, difference, standard error, z, p.

    Placement values come from midranks among all and within each class.
    """
    all_keys = [*keys, "score_name"]
    n = long.groupBy(*all_keys).agg(F.sum("y").alias("m"), F.sum(1 - F.col("y")).alias("k"))
    v = long.join(midranks(long, all_keys), [*all_keys, "s"]).join(F.broadcast(n), all_keys)
    place = F.when(F.col("y") == 1, (F.col("rank") - F.col("rank_bad")) / F.col("k")).otherwise(1 - (F.col("rank") - F.col("rank_good")) / F.col("m"))
    v = v.select(*keys, "id", "y", "score_name", "m", "k", place.alias("v"))
    pair = v.groupBy(*keys, "id", "y", "m", "k").agg(F.max(F.when(F.col("score_name") == first, F.col("v"))).alias("a"), F.max(F.when(F.col("score_name") == second, F.col("v"))).alias("b"))
    pos = lambda c: F.when(F.col("y") == 1, c)
    neg = lambda c: F.when(F.col("y") == 0, c)
    diff = F.col("a") - F.col("b")
    g = pair.groupBy(F.lit(1).alias("__all"), *keys).agg(
        F.avg(pos(F.col("a"))).alias("auc_first"), F.avg(pos(F.col("b"))).alias("auc_second"),
        (F.var_samp(pos(diff)) / F.max("m") + F.var_samp(neg(diff)) / F.max("k")).alias("var"),
    )
    d, se = F.col("auc_first") - F.col("auc_second"), F.sqrt("var")
    z = d / F.when(F.col("var") > 0, se)
    return g.select(*keys, "auc_first", "auc_second", d.alias("difference"), se.alias("standard_error"), z.alias("z"), F.coalesce(normal_two_sided_p(z), F.lit(1.0)).alias("p_value"))


def bootstrap_gini_ks(long: DataFrame, replicates: int = 100, seed: str = "boot", keys: Sequence[str] = KEY, alpha: float = 0.05) -> DataFrame:
    """Percentile intervals of Gini and KS over resamples; those with one class only are left out.

    Each record draws its own Poisson weight in every replicate, so resampling needs no row numbers and
    no join; a record is read once for all replicates and weights are summed per distinct score before anything is shuffled.
    """
    d = long.select(*keys, "s", "id", F.lit(1).alias("n"), F.col("y").alias("bad"))
    c = resampled_sums(d, "id", ["n", "bad"], replicates, seed, [*keys, "s"]).where("n > 0")
    c = c.select(*keys, "b", "s", F.col("n").cast("long").alias("n"), F.col("bad").cast("long").alias("bad"))
    m = auc_of_counts(c, [*keys, "b"]).where("gini IS NOT NULL")
    q = lambda c_, p: F.percentile(c_, F.lit(p))
    return m.groupBy(*keys).agg(
        F.count("*").alias("n_replicates"), q("gini", alpha / 2).alias("gini_low"), q("gini", 1 - alpha / 2).alias("gini_high"),
        q("ks", alpha / 2).alias("ks_low"), q("ks", 1 - alpha / 2).alias("ks_high"),
    )


def information_value(df: DataFrame, variable: str, target: str, least: float = 1e-4) -> DataFrame:
    """level, woe, iv, total_iv. Shares are clipped from below, then brought to sum 1 again."""
    c = df.groupBy(F.col(variable).cast("string").alias("level")).agg(F.sum(target).alias("bad"), F.count(target).alias("n")).where("level IS NOT NULL")
    all_ = Window.partitionBy()
    tb, tn = F.sum("bad").over(all_), F.sum("n").over(all_)
    c = c.withColumn("pb", F.greatest(F.col("bad") / F.when(tb > 0, tb), F.lit(least))).withColumn("pg", F.greatest((F.col("n") - F.col("bad")) / F.when(tn - tb > 0, tn - tb), F.lit(least)))
    c = c.withColumn("pb", F.col("pb") / F.sum("pb").over(all_)).withColumn("pg", F.col("pg") / F.sum("pg").over(all_))
    c = c.withColumn("woe", F.ln(F.col("pg") / F.col("pb"))).withColumn("iv", (F.col("pg") - F.col("pb")) * F.col("woe"))
    return c.select("level", "woe", "iv", F.sum("iv").over(all_).alias("total_iv"))


def discriminance_report(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """auc_gini_ks with the bad rate, for all levels, segments, periods and scores at once."""
    return auc_gini_ks(long, keys).withColumn("bad_rate", F.col("n_bad") / F.col("n"))


def model_summary(long: DataFrame, replicates: int = 100, keys: Sequence[str] = KEY) -> DataFrame:
    capture = rejection_capture(long, keys=keys).groupBy(*keys).pivot("share", [5, 10, 15, 20]).agg(F.first("capture"))
    capture = capture.select(*keys, *[F.col(f"`{t}`").alias(f"capture_{t}") for t in (5, 10, 15, 20)])
    return auc_gini_ks(long, keys).join(capture, list(keys)).join(bootstrap_gini_ks(long, replicates, keys=keys), list(keys), "left")


def score_histogram(long: DataFrame, bins: int = 50, keys: Sequence[str] = KEY) -> DataFrame:
    """keys, y, bin, n, density over equal-width bins of each class's own range; the top value is in the last."""
    on = [*keys, "y"]
    e = long.groupBy(*on).agg(F.min("s").alias("lo"), F.max("s").alias("hi"), F.count("*").alias("total"))
    width = (F.col("hi") - F.col("lo")) / bins
    h = long.join(F.broadcast(e), on).withColumn("bin", F.when(width > 0, F.least(F.floor((F.col("s") - F.col("lo")) / F.when(width > 0, width)) + 1, F.lit(bins))).otherwise(1).cast("int"))
    h = h.groupBy(*on, "bin").agg(F.count("*").alias("n"), F.first("total").alias("total"), F.first(width).alias("width"))
    return h.select(*on, "bin", "n", (F.col("n") / F.col("total") / F.when(F.col("width") > 0, F.col("width"))).alias("density"))


def delong_matrix(df: DataFrame, scores: Mapping[str, bool], target: str, keys: Sequence[str] = ()) -> DataFrame:
    """keys, first, second, auc_first, auc_second, covariance, difference, standard_error, z, p_value of every pair of ``scores``, each with itself too.

    ``scores``: name -> whether low values are risky. Records in which all scores are known are counted per distinct tuple of scores and class, once for all pairs; placement
    values come from midranks over these counts, and a class's covariances are sums of their products. ``covariance`` is that of the two AUCs. Keys with one class
    only get nulls. One record of a class leaves the covariance open: null.
    """
    names = list(scores)
    values = [(-F.col(n) if low else F.col(n)).cast("double") for n, low in scores.items()]
    d = df.where(F.col(target).isNotNull()).select(*keys, F.lit(1).alias("__one"), F.col(target).cast("int").alias("y"), F.array(*values).alias("s"))
    d = d.where(~F.exists("s", lambda x: x.isNull()))
    on = [*keys, "__one"]
    t = d.groupBy(*on, "y", "s").agg(F.count("*").alias("c"))
    each = t.select(*on, "y", F.col("s").alias("tuple"), "c", F.posexplode("s").alias("i", "s"))
    counts = each.groupBy(*on, "i", "s").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("y")).alias("bad"))
    below = Window.partitionBy(*on, "i").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    all_ = Window.partitionBy(*on, "i")
    good = F.col("n") - F.col("bad")
    before = lambda c: F.coalesce(F.sum(c).over(below), F.lit(0))
    # A bad record beats the good below it, a good one loses to the bad above it; ties count half.
    places = counts.select(
        *on, "i", "s", ((before(good) + good / 2) / F.nullif(F.sum(good).over(all_), F.lit(0))).alias("v1"),
        ((F.sum("bad").over(all_) - before(F.col("bad")) - F.col("bad") / 2) / F.nullif(F.sum("bad").over(all_), F.lit(0))).alias("v0"),
    )
    v = each.join(places, [*on, "i", "s"]).select(*on, "y", "tuple", "c", "i", F.when(F.col("y") == 1, F.col("v1")).otherwise(F.col("v0")).alias("v"))
    wide = v.groupBy(*on, "y", "tuple", "c").pivot("i", list(range(len(names)))).agg(F.first("v"))
    x = [F.col(str(i)) for i in range(len(names))]
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    moments = wide.groupBy(*on, "y").agg(
        F.sum("c").alias("n"), *[(F.sum(F.col("c") * x[i]) / F.sum("c")).alias(f"m{i}") for i in range(len(names))],
        *[(F.sum(F.col("c") * x[i] * x[j]) / F.sum("c")).alias(f"p{i}_{j}") for i, j in pairs],
    )
    # A class's share of the covariance: that of its sample, n / (n - 1) times the mean product about the means, over n.
    part = lambda i, j: F.when(F.col("n") > 1, (F.col(f"p{i}_{j}") - F.col(f"m{i}") * F.col(f"m{j}")) / (F.col("n") - 1))
    of = lambda y, c: F.max(F.when(F.col("y") == y, c))
    one = moments.groupBy(*on).agg(*[of(1, F.col(f"m{i}")).alias(f"auc{i}") for i in range(len(names))], *[(of(1, part(i, j)) + of(0, part(i, j))).alias(f"c{i}_{j}") for i, j in pairs])
    rows = []
    for i, j in pairs:
        diff = F.col(f"auc{i}") - F.col(f"auc{j}")
        var = F.col(f"c{i}_{i}") + F.col(f"c{j}_{j}") - 2 * F.col(f"c{i}_{j}")
        var = F.when(F.abs(var) > 1e-15, var).otherwise(var * 0)
        rows.append(F.struct(F.lit(names[i]).alias("first"), F.lit(names[j]).alias("second"), F.col(f"auc{i}").alias("auc_first"), F.col(f"auc{j}").alias("auc_second"), F.col(f"c{i}_{j}").alias("covariance"), diff.alias("difference"), F.sqrt(var).alias("standard_error")))
    out = one.select(*keys, F.inline(F.array(*rows)))
    z = F.col("difference") / F.when(F.col("standard_error") > 0, F.col("standard_error"))
    return out.withColumn("z", z).withColumn("p_value", F.coalesce(normal_two_sided_p(F.col("z")), F.when(F.col("standard_error").isNotNull(), F.lit(1.0))))
