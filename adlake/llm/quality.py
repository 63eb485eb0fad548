"""Quality rules: counted text statistics, and robust outliers per language and source.

Each document becomes a vector of transformed statistics. Per group a minimum-covariance-
determinant estimate is fitted: from a robust start, concentration steps refit mean and
covariance to the ``SHARE`` of documents that lie nearest, until the determinant no longer falls.
A document whose Mahalanobis distance from its group is beyond the chi-square cut is rejected.
As start and steps rest on half of a group, up to about half of it may be outliers, copies of one
another or not; what more than half of a group have in common is its norm.

All of it is DataFrame built-ins. Groups are only ever aggregated (counts, sums, histograms), so
a group that holds a third of all rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adlake.llm.common import SPACE, Staging, shuffles_dropped, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Share of a group that the determinant is minimised over, and the fall of its logarithm below
#: which a group takes no further concentration step.
SHARE = 0.5
LEAST_FALL = 1e-3
#: A group takes at most so many concentration steps; most need three to ten.
MAX_STEPS = 50
#: Smaller groups are judged by all documents of their language, and those of a language that is
#: still smaller by all documents there are.
LEAST_GROUP = 50
EVERYTHING = "all"
#: Chi-square quantiles for five degrees of freedom at 0.5, 0.975 and 0.999999.
CHI2_SHARE, CHI2_REWEIGHT, CHI2_CUT = 4.3515, 12.8325, 35.888
#: Variance added to each axis, in units of its robust scale. Shares are counts of rare events:
#: most documents have none, so that their spread alone would reject the first that has some.
RIDGE = 1.0

#: Smallest scale of each axis of the vector, in its own unit.
FLOORS = {"x_length": 0.05, "x_symbols": 0.1, "x_lines": 0.1, "x_repeats": 0.1, "x_size": 0.25}
AXES = list(FLOORS)
D = len(AXES)
PAIRS = [(i, j) for i in range(D) for j in range(i + 1)]

#: Widths of histogram bins: of an axis in its unit, of a logarithm of a squared distance.
AXIS_BIN, DISTANCE_BIN = 0.005, 0.02


def _longs(value: Column) -> Column:
    return F.coalesce(value, F.lit(0)).cast("long")


def repeated_words(found: Column) -> Column:
    """Words that lie in a 3-word window which occurs at least twice, the first time included.

    Windows are sorted, so that equal ones meet; the starts of those that meet an equal one are
    sorted again, and each covers three words or as many as lie before the next.
    """
    n = F.size(found)
    windows = F.sort_array(
        F.filter(
            F.transform(
                found,
                lambda word, i: F.struct(
                    word.alias("a"), F.get(found, i + 1).alias("b"), F.get(found, i + 2).alias("c"), i.alias("i")
                ),
            ),
            lambda w: w["i"] < n - 2,
        )
    )
    return windows


def _same(left: Column, right: Column) -> Column:
    return (left["a"] == right["a"]) & (left["b"] == right["b"]) & (left["c"] == right["c"])


def _covered(windows: Column) -> Column:
    never = F.lit(False)
    return F.sort_array(
        F.transform(
            F.filter(
                windows,
                lambda w, p: F.when(p > 0, _same(F.get(windows, p - 1), w)).otherwise(never)
                | F.coalesce(_same(F.get(windows, p + 1), w), never),
            ),
            lambda w: w["i"],
        )
    )


def _length_covered(starts: Column) -> Column:
    return F.aggregate(
        F.transform(starts, lambda at, p: F.least(F.lit(3), F.coalesce(F.get(starts, p + 1) - at, F.lit(3)))),
        F.lit(0),
        lambda total, step: total + step,
    )


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` without the text, with n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words (long). A NULL or empty text counts nothing."""
    value = F.col(text)
    plain = F.translate(value, SPACE, "")
    lines = F.filter(F.split(value, "\n"), lambda line: F.length(F.translate(line, SPACE, "")) > 0)
    kept = [name for name in docs.columns if name != text]
    counted = docs.select(
        *kept,
        F.length(plain).alias("word_chars"),
        (F.length(value) - F.length(F.translate(value, SYMBOLS, ""))).alias("n_symbols"),
        lines.alias("_lines"),
        words(value).alias("_words"),
    )
    sorted_windows = counted.select(
        *kept,
        _longs(F.col("word_chars")).alias("word_chars"),
        _longs(F.col("n_symbols")).alias("n_symbols"),
        _longs(F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        _longs(F.size("_words")).alias("n_words"),
        repeated_words(F.col("_words")).alias("_windows"),
    )
    starts = sorted_windows.withColumn("_starts", _covered(F.col("_windows"))).drop("_windows")
    return starts.withColumn("n_repeat_words", _longs(_length_covered(F.col("_starts")))).drop("_starts")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def _vector() -> dict[str, Column]:
    """The transformed statistics: logarithms of sizes, and shares through the arc sine of their
    root, which evens out the variance of a share."""
    n = F.col("n_words").cast("double")

    def share(count: str) -> Column:
        return 2 * F.asin(F.sqrt(F.least(F.col(count) / n, F.lit(1.0))))

    return {
        "x_length": F.log(F.col("word_chars") / n),
        "x_symbols": share("n_symbols"),
        "x_lines": share("n_dup_lines"),
        "x_repeats": share("n_repeat_words"),
        "x_size": F.log(n),
    }


def _at_share(histogram: DataFrame, keys: list[str], shares: dict[str, float]) -> DataFrame:
    """From counts ``n`` per keys and ``bin``: the bin in which each share of the count is reached."""
    so_far = Window.partitionBy(*keys).orderBy("bin")
    total = Window.partitionBy(*keys)
    ranked = histogram.select(
        *keys, "bin", F.sum("n").over(so_far).alias("upto"), F.sum("n").over(total).alias("total")
    )
    return ranked.groupBy(*keys).agg(
        *(
            F.min(F.when(F.col("upto") >= share * F.col("total"), F.col("bin"))).alias(name)
            for name, share in shares.items()
        ),
        F.max("total").alias("total"),
    )


def _start(rows: DataFrame, staging: Staging) -> DataFrame:
    """Per group the median and a robust scale of each axis: the median distance from the median,
    which outliers of less than half of the group cannot carry along, unlike quartiles."""
    axes = F.explode(
        F.array(*(F.struct(F.lit(i).alias("axis"), F.floor(F.col(a) / AXIS_BIN).alias("bin")) for i, a in enumerate(AXES)))
    )
    bins = staging.keep(rows.select("grp", axes.alias("v")).groupBy("grp", "v.axis", "v.bin").agg(F.count("*").alias("n")))
    middle = _at_share(bins, ["grp", "axis"], {"mid": 0.5})
    away = F.abs(F.col("bin") - F.col("mid")).alias("bin")
    off = bins.join(middle, ["grp", "axis"]).groupBy("grp", "axis", "mid", away).agg(F.sum("n").alias("n"))
    found = _at_share(off, ["grp", "axis", "mid"], {"off": 0.5})
    per_axis = []
    for i, axis in enumerate(AXES):
        of = F.col("axis") == i
        spread = (F.max(F.when(of, F.col("off"))) + 0.5) * AXIS_BIN / 0.6745
        per_axis += [
            ((F.max(F.when(of, F.col("mid"))) + 0.5) * AXIS_BIN).alias(f"mid_{i}"),
            F.greatest(spread, F.lit(FLOORS[axis])).alias(f"scale_{i}"),
        ]
    return found.groupBy("grp").agg(F.max("total").alias("members"), *per_axis)


def _moments(rows: DataFrame, inside: Column) -> DataFrame:
    """Per group: mean and the Cholesky factor of the covariance of the rows inside."""
    chosen = rows.where(inside)
    sums = chosen.groupBy("grp").agg(
        F.count("*").alias("n"),
        *(F.avg(f"z_{i}").alias(f"m_{i}") for i in range(D)),
        *(F.avg(F.col(f"z_{i}") * F.col(f"z_{j}")).alias(f"c_{i}_{j}") for i, j in PAIRS),
    )
    factored = sums
    for i, j in PAIRS:
        covariance = F.col(f"c_{i}_{j}") - F.col(f"m_{i}") * F.col(f"m_{j}")
        rest = covariance
        for k in range(j):
            rest = rest - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
        if i == j:
            entry = F.sqrt(F.greatest(rest + RIDGE, F.lit(RIDGE / 2)))
        else:
            entry = rest / F.col(f"l_{j}_{j}")
        factored = factored.withColumn(f"l_{i}_{j}", entry)
    return factored.select(
        "grp", *(f"m_{i}" for i in range(D)), *(f"l_{i}_{j}" for i, j in PAIRS)
    )


def _with_distance(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """Adds the squared Mahalanobis distance: forward substitution with the Cholesky factor."""
    joined = rows.join(estimate, "grp", "left")
    for i in range(D):
        rest = F.col(f"z_{i}") - F.col(f"m_{i}")
        for k in range(i):
            rest = rest - F.col(f"l_{i}_{k}") * F.col(f"y_{k}")
        joined = joined.withColumn(f"y_{i}", rest / F.col(f"l_{i}_{i}"))
    squared = sum((F.col(f"y_{i}") * F.col(f"y_{i}") for i in range(1, D)), F.col("y_0") * F.col("y_0"))
    return joined.select(*rows.columns, squared.alias("d2"))


def _distance_at_share(rows: DataFrame) -> DataFrame:
    """Per group the squared distance within which ``SHARE`` of its rows lie."""
    histogram = rows.groupBy("grp", F.floor(F.log(F.col("d2") + 1e-9) / DISTANCE_BIN).alias("bin")).agg(
        F.count("*").alias("n")
    )
    reached = _at_share(histogram, ["grp"], {"bin_at": SHARE})
    return reached.select("grp", F.exp((F.col("bin_at") + 1) * DISTANCE_BIN).alias("reach"))


def _concentrated(fit: DataFrame, staging: Staging) -> DataFrame:
    """Per group the estimate of the smallest determinant that concentration steps reach.

    A group takes part until a step no longer lowers its determinant, and for ``MAX_STEPS`` steps
    at most. All groups take their steps together, so that is the number of rounds as well.
    """
    squared = sum((F.col(f"z_{i}") * F.col(f"z_{i}") for i in range(1, D)), F.col("z_0") * F.col("z_0"))
    log_det = sum((2 * F.log(f"l_{i}_{i}") for i in range(1, D)), 2 * F.log("l_0_0"))
    measured, best = fit.withColumn("d2", squared), None
    for _ in range(MAX_STEPS):
        nearest = measured.join(_distance_at_share(measured), "grp")
        found = staging.keep(_moments(nearest, F.col("d2") <= F.col("reach")))
        if best is not None:
            before = best.select("grp", log_det.alias("before"))
            lower = found.join(before, "grp").where(log_det < F.col("before") - LEAST_FALL)
            found = staging.keep(lower.drop("before"))
            if found.isEmpty():
                return best
            best = staging.keep(best.join(found, "grp", "left_anti").unionByName(found))
        else:
            best = found
        measured = _with_distance(fit.join(found.select("grp"), "grp", "left_semi"), found)
    return best


def quality_rules(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, outlier_distance (double).

    Estimates cover all documents that pass the base rules. ``kept`` is false for those that
    fail them and for outliers; ``outlier_distance`` is the squared robust distance, NULL for
    those that fail them.

    Defined cases: a NULL or empty text has no words and fails; a NULL language or source is a
    group value of its own; repeated rows each count and get the same verdict; texts are counted
    whole; an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(lang_col).cast("string").alias("lang"),
        F.col(source_col).cast("string").alias("source"),
        F.col(text_col).alias("text"),
    )
    named = [F.coalesce(F.concat(F.lit("="), name), F.lit("null")) for name in ("lang", "source")]
    with shuffles_dropped(spark):
        staging = Staging(spark, "quality")
        counted = staging.keep(
            text_statistics(narrow).select(
                "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                base_failed().alias("base_failed"),
                F.concat_ws("\n", *named).alias("fine"), named[0].alias("coarse"),
            )
        )
        passing = counted.where(~F.col("base_failed"))
        # groups too small for an estimate of their own are judged by that of their language, in
        # which all of its documents count, those of large groups as well; so are languages by all
        sizes = staging.keep(passing.groupBy("fine", "coarse").agg(F.count("*").alias("size")))
        few = F.col("size") < LEAST_GROUP
        langs = sizes.groupBy("coarse").agg(F.sum("size").alias("of_lang"), F.max(few).alias("asks"))
        langs = staging.keep(langs.select("coarse", (F.col("of_lang") < LEAST_GROUP).alias("rare"), "asks"))
        asks_all = langs.where("asks AND rare").limit(1).count() > 0
        pool = F.when(F.col("asks") & ~F.col("rare"), F.col("coarse"))
        judge = F.when(~few, F.col("fine")).when(F.col("rare"), F.lit(EVERYTHING)).otherwise(F.col("coarse"))
        groups = sizes.join(langs, "coarse").select("fine", judge.alias("grp"), pool.alias("pool"))
        placed = counted.join(groups, "fine", "left").select(
            *(name for name in counted.columns if name not in ("fine", "coarse")), "grp", "pool"
        )
        vectors = placed.select(
            "*", *(F.when(~F.col("base_failed"), x).alias(name) for name, x in _vector().items())
        )
        everything = F.lit(EVERYTHING if asks_all else None).cast("string")
        counts_in = F.array_distinct(F.array_compact(F.array("grp", "pool", everything)))
        members = vectors.where(~F.col("base_failed")).select(F.explode(counts_in).alias("grp"), *AXES)
        start = staging.keep(_start(members, staging))
        scaled = [((F.col(a) - F.col(f"mid_{i}")) / F.col(f"scale_{i}")).alias(f"z_{i}") for i, a in enumerate(AXES)]
        rows = staging.keep(
            vectors.join(start, "grp", "left").select(*(name for name in placed.columns if name != "pool"), *scaled)
        )
        fit = staging.keep(members.join(start, "grp").select("grp", *scaled))
        measured = _with_distance(fit, _concentrated(fit, staging))
        # distances of the nearest share are brought to those of a chi-square variate, where they
        # are larger; then everything within its 0.975 quantile refits the estimate once
        scale = F.greatest(F.col("reach") / CHI2_SHARE, F.lit(1.0))
        reach = staging.keep(_distance_at_share(measured))
        inner = measured.join(reach, "grp")
        estimate = staging.keep(_moments(inner, F.col("d2") <= CHI2_REWEIGHT * scale))
        reach = staging.keep(_distance_at_share(_with_distance(fit, estimate)))
    judged = _with_distance(rows, estimate).join(reach, "grp", "left")
    distance = F.when(~F.col("base_failed"), F.col("d2") / scale)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(distance <= CHI2_CUT, F.lit(True))).alias("kept"),
        distance.alias("outlier_distance"),
    )
