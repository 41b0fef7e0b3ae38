"""Quality rules: text statistics and robust multivariate outliers, in SQL expressions only.

Every document gives counts and five transformed statistics. Per language and
source, location and scatter of the transformed vectors are estimated by the
minimum covariance determinant: from medians and absolute deviations on,
concentration steps keep the part of the rows with the smallest Mahalanobis
distances and estimate anew from them. A row far outside is rejected.

All estimates are sums, counts and percentiles of rounded values per group, so
they are pre-aggregated before they are shuffled, a group with a third of all
rows is no heavier than others, and no group is collected. Groups below
``min_rows`` pool with the other small groups of their language, and then with
all small groups; a pool that is still small has no verdict and rejects
nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenmart.llm.common import WORD_GAP, saved, total

X = ("x_length", "x_word", "x_symbols", "x_lines", "x_repeats")
P = range(len(X))
#: Spread that a statistic has at least; rows of the core; concentration steps; rows of a group of its own.
FLOORS = (0.5, 0.6, 0.5, 1.2, 1.2)
CORE, STEPS, MIN_ROWS = 0.75, 4, 200
#: Squared distance beyond which a row is rejected, in units where its median is that of chi-square with five degrees of freedom.
CUT, CHI_MEDIAN = 200.0, 4.351


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines``, ``n_dup_lines`` and ``n_repeat_words``.

    A null text has no words. Columns of these names are replaced.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(t, WORD_GAP), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumns({"_words": words, "_lines": lines, "n_symbols": F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("bigint")})
    df = df.withColumns(
        {
            "n_words": F.size("_words").cast("bigint"),
            "word_chars": F.length(F.array_join("_words", "")).cast("bigint"),
            "n_lines": F.size("_lines").cast("bigint"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
            "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
        }
    ).drop("_words", "_lines")
    # A window is the hash of five words' hashes. Windows are looked at closely only where one repeats.
    later = [lambda i, k=k: F.get("_hashes", i + k) for k in range(1, 5)]
    firsts = F.slice("_hashes", 1, F.greatest(F.size("_hashes") - 4, F.lit(0)))
    df = df.withColumn("_windows", F.transform(firsts, lambda h, i: F.xxhash64(h, *(get(i) for get in later)))).drop("_hashes")
    sorted_ = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_sorted", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), sorted_)).drop("_windows")
    same = lambda i, h: F.coalesce(F.get("_sorted", i)["h"] == h, F.lit(False))
    marked = F.transform("_sorted", lambda s, k: F.when(same(k - 1, s["h"]) | same(k + 1, s["h"]), s["i"]))
    df = df.withColumn("_at", F.sort_array(F.filter(marked, lambda i: i.isNotNull()))).drop("_sorted")
    # Windows that overlap cover their words once.
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-5).alias("last"))
    step = lambda a, i: F.struct((a["n"] + F.least(F.lit(5), i - a["last"])).alias("n"), i.alias("last"))
    covered = F.aggregate("_at", start, step, lambda a: a["n"])
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("bigint"))).drop("_at")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def transformed() -> dict[str, Column]:
    share = lambda part, of, times: F.log1p(times * F.col(part) / F.greatest(F.col(of), F.lit(1)))
    return {
        "x_length": F.log1p("n_words"),
        "x_word": F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)),
        "x_symbols": share("n_symbols", "word_chars", 1000.0),
        "x_lines": share("n_dup_lines", "n_lines", 100.0),
        "x_repeats": share("n_repeat_words", "n_words", 100.0),
    }


def _grouped(rows: DataFrame, min_rows: int) -> DataFrame:
    """Adds ``grp``: language and source, or the pool that the row's small group belongs to; null without one."""
    lang, source = F.coalesce(F.col("lang"), F.lit("")), F.coalesce(F.col("source"), F.lit(""))
    rows = rows.withColumns({"_l": lang, "_s": source})
    cells = rows.where("usable").groupBy("_l", "_s").agg(F.count("*").alias("n"))
    pools = cells.where(F.col("n") < min_rows).groupBy("_l").agg(F.sum("n").alias("pool"))
    rest = pools.where(F.col("pool") < min_rows).agg(F.sum("pool").alias("rest"))
    sizes = rows.select("_l", "_s").distinct().join(cells, ["_l", "_s"], "left").join(pools, "_l", "left")
    own = F.coalesce("n", F.lit(0)) >= min_rows
    named = sizes.select(
        "_l",
        "_s",
        F.when(own, F.to_json(F.array("_l", "_s")))
        .when(F.coalesce("pool", F.lit(0)) >= min_rows, F.to_json(F.array("_l")))
        .when(F.coalesce(rest.scalar(), F.lit(0)) >= min_rows, F.lit("[]"))
        .alias("grp"),
    )
    return rows.join(named, ["_l", "_s"]).drop("_l", "_s")


def _bin(x: Column) -> Column:
    """Rounded to 0.01, so that an exact percentile keeps a bounded number of values."""
    return F.round(x, 2)


def _distance() -> Column:
    """Squared Mahalanobis distance from ``m_i`` and the Cholesky factor ``l_i_j``, by forward substitution."""
    z: list[Column] = []
    for i in P:
        inner = [F.col(f"l_{i}_{j}") * z[j] for j in range(i)]
        difference = F.col(X[i]) - F.col(f"m_{i}")
        z.append((difference - total(inner) if inner else difference) / F.col(f"l_{i}_{i}"))
    return total([v * v for v in z])


def _start(rows: DataFrame) -> DataFrame:
    """Medians and scaled absolute deviations as a first, diagonal estimate."""
    medians = saved(rows.groupBy("grp").agg(*(F.percentile(_bin(F.col(X[i])), F.lit(0.5)).alias(f"m_{i}") for i in P)), "medians")
    apart = rows.join(medians, "grp").groupBy("grp")
    spread = apart.agg(*(F.percentile(_bin(F.abs(F.col(X[i]) - F.col(f"m_{i}"))), F.lit(0.5)).alias(f"d_{i}") for i in P))
    factor = {f"l_{i}_{j}": F.greatest(1.4826 * F.col(f"d_{i}"), F.lit(FLOORS[i])) if i == j else F.lit(0.0) for i in P for j in range(i + 1)}
    return saved(medians.join(spread, "grp").withColumns(factor).drop(*(f"d_{i}" for i in P)), "estimate")


def _concentrate(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """Mean and covariance of the rows nearest to the last estimate, as ``m_i`` and ``l_i_j``."""
    far = rows.join(estimate, "grp").withColumn("far", _bin(F.log(_distance() + 1e-4)))
    limit = saved(far.groupBy("grp").agg(F.percentile("far", F.lit(CORE)).alias("limit")), "limits")
    core = far.join(limit, "grp").where("far <= limit")
    shifted = [F.col(X[i]) - F.col(f"m_{i}") for i in P]
    sums = core.groupBy("grp").agg(
        F.count("*").alias("n"),
        *(F.first(f"m_{i}").alias(f"m_{i}") for i in P),
        *(F.avg(shifted[i]).alias(f"s_{i}") for i in P),
        *(F.avg(shifted[i] * shifted[j]).alias(f"c_{i}_{j}") for i in P for j in range(i + 1)),
    )
    for i in P:  # Cholesky, row by row
        for j in range(i + 1):
            cov = F.col(f"c_{i}_{j}") - F.col(f"s_{i}") * F.col(f"s_{j}")
            inner = [F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)]
            left = cov - total(inner) if inner else cov
            if i == j:
                value = F.sqrt(F.greatest(left, F.lit(0.0)) + FLOORS[i] ** 2)
            else:
                value = left / F.col(f"l_{j}_{j}")
            sums = sums.withColumn(f"l_{i}_{j}", value)
    means = {f"m_{i}": F.col(f"m_{i}") + F.col(f"s_{i}") for i in P}
    factors = [f"l_{i}_{j}" for i in P for j in range(i + 1)]
    return saved(sums.withColumns(means).select("grp", *means, *factors), "estimate")


def outliers(df: DataFrame, min_rows: int = MIN_ROWS, cut: float = CUT) -> DataFrame:
    """Adds the statistics, ``base_failed``, ``distance`` and ``kept`` to every row (columns of these names are replaced).

    ``kept`` is false for a row that fails the base rules, else if its distance
    is over ``cut``. Estimates use the rows that pass the base rules. Null
    languages and sources count as empty names. Repeated rows count as often as
    they occur and get the same verdict; rows at the limit are kept. An empty
    table stays empty.
    """
    own = [c for c in df.columns if c not in ("text",)]
    rows = statistics(df).withColumns({"base_failed": base_failed(), **transformed()}).withColumn("usable", ~F.col("base_failed"))
    counts = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed")
    rows = saved(rows.select(*[c for c in own if c not in (*counts, *X, "usable", "grp", "distance", "kept")], *counts, *X, "usable"), "statistics")
    rows = _grouped(rows, min_rows)
    core = saved(rows.where("usable and grp is not null").select("grp", *X), "vectors")
    estimate = _start(core)
    for _ in range(STEPS):
        estimate = _concentrate(core, estimate)
    scale = core.join(estimate, "grp").groupBy("grp").agg(F.percentile(_bin(_distance()), F.lit(0.5)).alias("median"))
    verdict = rows.join(estimate.join(saved(scale, "scales"), "grp"), "grp", "left")
    distance = _distance() * CHI_MEDIAN / F.greatest("median", F.lit(0.01))
    verdict = verdict.withColumn("distance", distance)
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cut)
    factors = [f"l_{i}_{j}" for i in P for j in range(i + 1)]
    return verdict.withColumn("kept", kept).drop("grp", "median", "usable", *X, *(f"m_{i}" for i in P), *factors)
