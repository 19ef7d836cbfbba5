"""Quality rules: base rules on text statistics, then robust multivariate outliers for each language and source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import SPACES, WORD, own_names, small, split_words, stored

SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
REPEAT_PERCENT = 50

# The transformed vector: log of the mean word length; square roots of symbols a word, of repeated lines a line, and of
# repeated words a word.  FLOORS is the spread (one standard deviation) below which a difference in a statistic means nothing:
# its square is added to the variance, so statistics that are constant in a group do not reject what differs a little.
FLOORS = (0.06, 0.08, 0.15, 0.15)
DIMENSIONS = len(FLOORS)
# Statistics are kept as integers of 1/1024, so sums are exact and results do not depend on the order of rows.
UNIT = 1024
# Share of a group that the determinant is minimised over, and the factor that makes its covariance consistent for normal
# data in 4 dimensions: 0.75 / P(chi2_6 < q) with P(chi2_4 < q) = 0.75.
SUPPORT = 0.75
CONSISTENCY = 1.4866
# Squared distance above which a vector is an outlier: one normal vector in a million lies beyond.
CUT = 33.38
# An estimate from n vectors weighs n / (n + SHRINK) against that of its language, and the language's so against all documents'.
SHRINK = 40
STEPS = 3
CENTRE = [f"_m{i}" for i in range(DIMENSIONS)]
COVARIANCE = [f"_c{i}{j}" for i in range(DIMENSIONS) for j in range(i + 1)]
FACTOR = [f"_f{i}{j}" for i in range(DIMENSIONS) for j in range(i + 1)]
# Distances are ranked in units of 1/64, up to a bound beyond which their order does not matter.
RANK_UNIT, RANK_MAX = 64, 1 << 17


def _repeat_words(triples: Column) -> Column:
    """Words inside 3-word windows that occur at least twice, from the sorted (word, word, word, place) array."""

    def same(x: Column, y: Column) -> Column:
        return F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False))

    twice = F.filter(triples, lambda x, i: same(x, F.get(triples, i + 1)) | same(x, F.get(triples, i - 1)))
    return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))


def text_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct ``_stats``: n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words, base_failed.

    All of it is computed inside the row; three-word windows are found again by sorting them, so long texts stay near linear.
    """
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    n = F.size("_w")
    triples = F.sort_array(F.transform(
        F.arrays_zip(F.slice("_w", 1, n - 2), F.slice("_w", 2, n - 2), F.slice("_w", 3, n - 2), F.sequence(F.lit(0), n - 3)),
        lambda x: F.struct(x["0"].alias("a"), x["1"].alias("b"), x["2"].alias("c"), x["3"].alias("i"))))
    staged = (docs.withColumns({"_w": split_words(F.col("text"), SPACES), "_l": lines})
              .withColumn("_z", F.when(n >= 3, triples)))
    stats = staged.withColumns({
        "_n": n.cast("long"), "_chars": F.length(F.regexp_replace(text, SPACES, "")).cast("long"),
        "_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"), "_lines": F.size("_l").cast("long"),
        "_dups": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "_repeats": F.when(F.col("_z").isNotNull(), _repeat_words(F.col("_z"))).otherwise(0).cast("long")}).drop("_w", "_l", "_z")
    failed = (F.col("_n") < MIN_WORDS) | (100 * F.col("_repeats") > REPEAT_PERCENT * F.col("_n"))
    return stats.withColumn("_stats", F.struct(
        F.col("_n").alias("n_words"), F.col("_chars").alias("word_chars"), F.col("_symbols").alias("n_symbols"),
        F.col("_dups").alias("n_dup_lines"), F.col("_lines").alias("n_lines"), F.col("_repeats").alias("n_repeat_words"),
        failed.alias("base_failed"))).drop("_n", "_chars", "_symbols", "_dups", "_lines", "_repeats")


def _vector(stats: str = "_stats") -> list[Column]:
    s = F.col(stats)
    values = [F.log(F.try_divide(s["word_chars"], s["n_words"])), F.sqrt(F.try_divide(s["n_symbols"], s["n_words"])),
              F.sqrt(F.try_divide(s["n_dup_lines"], s["n_lines"])), F.sqrt(F.try_divide(s["n_repeat_words"], s["n_words"]))]
    return [F.round(v * UNIT).cast("long") for v in values]


def _xs() -> list[Column]:
    return [F.col(f"_x{i}") for i in range(DIMENSIONS)]


def _square(v: Column) -> Column:
    return v * v


def distance(xs: list[Column], centre: str = "_m", factor: str = "_f") -> Column:
    """Squared Mahalanobis distance by forward substitution through the Cholesky factor in columns ``_f<i><j>``."""
    ys: list[Column] = []
    for i in range(DIMENSIONS):
        left = xs[i] / UNIT - F.col(f"{centre}{i}")
        for j in range(i):
            left = left - F.col(f"{factor}{i}{j}") * ys[j]
        ys.append(left / F.col(f"{factor}{i}{i}"))
    total = _square(ys[0])
    for y in ys[1:]:
        total = total + _square(y)
    return total


def moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Centre ``_m<i>``, covariance ``_c<i><j>`` with its factor and determinant of each group, from exact sums of integers."""
    d = range(DIMENSIONS)
    sums = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(f"_x{i}").alias(f"_s{i}") for i in d],
        *[F.sum(F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"_p{i}{j}") for i in d for j in d if j <= i])
    out = sums.withColumns({f"_m{i}": F.col(f"_s{i}") / F.col("_n") / UNIT for i in d})
    out = out.withColumns({f"_c{i}{j}": CONSISTENCY * (F.col(f"_p{i}{j}") / F.col("_n") / UNIT**2 - F.col(f"_m{i}") * F.col(f"_m{j}"))
                           + (FLOORS[i] ** 2 if i == j else 0.0) for i in d for j in d if j <= i})
    return factored(out).select(*keys, "_n", *CENTRE, *COVARIANCE, *FACTOR, "_det")


def factored(out: DataFrame) -> DataFrame:
    """Adds the Cholesky factor ``_f<i><j>`` of the covariance ``_c<i><j>`` and the logarithm of its determinant's root."""
    d = range(DIMENSIONS)
    for i in d:
        for j in range(i + 1):
            left = F.col(f"_c{i}{j}")
            for k in range(j):
                left = left - F.col(f"_f{i}{k}") * F.col(f"_f{j}{k}")
            # Rounding cannot take a pivot below a small part of its floor.
            out = out.withColumn(f"_f{i}{j}", F.sqrt(F.greatest(left, F.lit(FLOORS[i] ** 2 / 16))) if i == j else left / F.col(f"_f{j}{j}"))
    return out.withColumn("_det", sum((F.log(F.col(f"_f{i}{i}")) for i in d), F.lit(0.0)))


def covariance_estimates(vectors: DataFrame) -> DataFrame:
    """Minimum-covariance-determinant estimate for each ``_group`` of integer vectors ``_x<i>``.

    Two starts: the ``SUPPORT`` share nearest to the coordinate-wise median, measured in median absolute deviations, by the
    sum of squares and by the largest coordinate.  Concentration steps then refit centre and covariance to the share that is
    nearest to the last fit, which never raises the determinant; the start that ends lower is kept.  Medians and shares are
    exact percentiles of integers with a bounded number of values, summed up in the map tasks: a group may hold most rows.
    """
    d = range(DIMENSIONS)
    middle = stored(vectors.groupBy("_group").agg(*[F.percentile(f"_x{i}", 0.5).alias(f"_c{i}") for i in d]), "median")
    near = vectors.join(small(middle), "_group")
    spread = stored(near.groupBy("_group").agg(
        *[F.first(f"_c{i}").alias(f"_c{i}") for i in d],
        *[(1.4826 * F.percentile(F.abs(F.col(f"_x{i}") - F.col(f"_c{i}")), 0.5) + FLOORS[i] * UNIT).alias(f"_d{i}") for i in d]), "spread")
    zs = [_square((F.col(f"_x{i}") - F.col(f"_c{i}")) / F.col(f"_d{i}")) for i in d]
    total = zs[0]
    for z in zs[1:]:
        total = total + z
    ranked = (vectors.join(small(spread), "_group")
              .withColumn("_start", F.explode(F.array(F.struct(F.lit(0).alias("s"), total.alias("q")), F.struct(F.lit(1).alias("s"), F.greatest(*zs).alias("q")))))
              .select("_group", *_xs(), F.col("_start.s").alias("_s"), F.col("_start.q").alias("_q")))
    starts = F.explode(F.array(F.lit(0), F.lit(1))).alias("_s")
    fits = None
    for step in range(STEPS + 1):
        if fits is not None:
            ranked = (vectors.select("*", starts).join(small(fits), ["_group", "_s"])
                      .select("_group", "_s", *_xs(), distance(_xs()).alias("_q")))
        ranked = ranked.withColumn("_r", F.least(F.floor(F.col("_q") * RANK_UNIT), F.lit(RANK_MAX)))
        nearest = stored(ranked.groupBy("_group", "_s").agg(F.percentile("_r", SUPPORT).alias("_most")), f"share{step}")
        fits = stored(moments(ranked.join(small(nearest), ["_group", "_s"]).where("_r <= _most"), ["_group", "_s"]), f"fit{step}")
    # Equal determinants: the first start.
    d_all = [c for c in fits.columns if c not in ("_group", "_s", "_det")]
    best = F.min(F.struct("_det", "_s", *d_all)).alias("_best")
    return fits.groupBy("_group").agg(best).select("_group", *[F.col(f"_best.{c}").alias(c) for c in d_all])


def shrunk(own: DataFrame, wider: dict[str, Column]) -> DataFrame:
    """``own`` estimates (``_size`` vectors each) with centre and covariance drawn toward ``wider`` ones, less so the larger they are."""
    weight = F.col("_size") / (F.col("_size") + SHRINK)
    return own.withColumns({c: wider[c] + weight * (F.col(c) - wider[c]) for c in (*CENTRE, *COVARIANCE)})


def judge_statistics(stats: DataFrame) -> DataFrame:
    """``stats`` (with ``_stats``, lang, source; stored, as it is read several times) with a boolean ``_kept``.

    Groups are (lang, source), nulls forming groups of their own.  Every group, language and the whole have an estimate; a
    group's is drawn toward its language's, and that toward the whole's, by weights that vary smoothly with size (``SHRINK``).
    """
    vectors = (stats.where(~F.col("_stats.base_failed"))
               .select("lang", "source", *[x.alias(f"_x{i}") for i, x in enumerate(_vector())]))
    pair = F.coalesce(F.to_json(F.struct("lang", "source")), F.lit(""))
    pool = F.coalesce(F.to_json(F.struct("lang", F.lit(1).alias("pooled"))), F.lit(""))
    grouped = stored(vectors.withColumn("_group", F.explode(F.array(pair, pool, F.lit("all")))).select("_group", *_xs()), "vectors")
    estimates = covariance_estimates(grouped).join(grouped.groupBy("_group").agg(F.count(F.lit(1)).alias("_size")).withColumnRenamed("_group", "_g"), F.col("_group") == F.col("_g"))
    fits = stored(estimates.select("_group", "_size", *CENTRE, *COVARIANCE), "fits")
    members = vectors.select(pair.alias("_pair"), pool.alias("_pool")).distinct()
    names = [*CENTRE, *COVARIANCE]
    # One row, or none if no document has a vector.
    whole = fits.where("_group = 'all'").first()
    langs = shrunk(fits.join(small(members.select("_pool").distinct()), F.col("_group") == F.col("_pool")),
                   {c: F.lit(whole[c] if whole else 0.0) for c in names})
    langs = stored(langs.select(F.col("_pool").alias("_wider"), *[F.col(c).alias(f"{c}w") for c in names]), "languages")
    pairs = fits.join(members, F.col("_group") == F.col("_pair")).join(small(langs), F.col("_pool") == F.col("_wider"))
    pairs = shrunk(pairs, {c: F.col(f"{c}w") for c in names})
    judged_by = stored(factored(pairs).select("_pair", *CENTRE, *FACTOR), "estimates")
    placed = stats.withColumn("_me", F.coalesce(F.to_json(F.struct("lang", "source")), F.lit("")))
    placed = placed.withColumns({f"_x{i}": x for i, x in enumerate(_vector())}).join(small(judged_by), F.col("_me") == F.col("_pair"), "left")
    kept = F.when(F.col("_stats.base_failed"), F.lit(False)).otherwise(distance(_xs()) <= CUT)
    return placed.withColumn("_kept", kept).select(*stats.columns, "_kept")


def quality_table(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    Null and blank texts have no words and fail; null languages and sources form groups of their own; repeated rows count and
    appear as often as they occur; other columns are ignored.  An empty table gives an empty result.
    """
    stats = stored(text_statistics(docs.select("doc_id", "lang", "source", "text")).drop("text"), "statistics")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return judge_statistics(stats).select("doc_id", *[F.col(f"_stats.{n}").alias(n) for n in names], F.col("_kept").alias("kept"))


@own_names
def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that ``quality_table`` keeps, with all their columns."""
    stats = stored(text_statistics(docs), "statistics")
    return judge_statistics(stats).where("_kept").select(*docs.columns)
