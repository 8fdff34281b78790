"""Quality rules by robust multivariate outliers (operator 3), DataFrame only.

Word statistics of whole texts give each document a vector of transformed
rates.  Per (lang, source) a minimum covariance determinant estimate of
centre and scatter is found by concentration steps from several deterministic
starts: medians with the median deviations, with the correlation of tanh
scores, and with that of spatial signs.  Of the estimates that the steps end at, the one whose scatter has the smallest
determinant counts, and is reweighted.  A document whose squared Mahalanobis
distance exceeds ``CUTOFF`` is rejected, as are those that fail the base rules.

A concentration step of all starts is one aggregate: distances are binned on a
fixed logarithmic grid (``BINS`` to a factor e), every (group, start, bin) sums
counts, vectors and products, combined map-side, and the bins up to the h-th
smallest distance give the next estimate.  So no group is gathered, and a
source that holds a third of all rows costs what its rows cost.  Rates are
rounded to ``GRID``, which bounds the state of the exact medians.  Estimates
are a few rows a group; up to ``SMALL`` of them, which is counted, they are
broadcast, so the rows are not shuffled by group.

Scatter is shrunk towards ``SPREAD`` squared on the diagonal with the weight
of ``PRIOR`` documents, as small groups have too few rows, but never with less
than ``LEAST_SHARE``: rates that are zero in most clean documents have no
variance to divide by, however many rows there are.

Defined cases: null text has no words and fails the base rules; null lang or
source form a group of their own; repeated rows count once each; an empty
table gives no rows; other columns pass through ``filtered`` untouched.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.llm.common import read_table, text_of, written

SPACE = r"[\x20\x09-\x0D]+"
WINDOW_WORDS = 8
SHRINK = 20  # words added to every document's rates

RATES = ("word_length", "symbols", "capitals", "marks", "repeats")
SPREAD = (0.06, 0.04, 0.04, 0.08, 0.15)
PRIOR = 30
LEAST_SHARE = 0.1  # of the prior, from 270 rows on
GRID = 1000
BINS = 16
STEPS = 4
STARTS = 3
SMALL = 20_000  # estimates of some 250 bytes each
# Chi-square with 5 degrees of freedom: consistency of half the rows, the
# reweighting step's 97.5 % point and its consistency, and the cutoff, which
# a normal vector exceeds with a probability of 1.2e-11.
HALF_FACTOR = 1.91
REWEIGHT = 12.83
REWEIGHT_FACTOR = 1.06
CUTOFF = 60.0


def word_statistics(docs: DataFrame, carried: list[str]) -> DataFrame:
    """The ``carried`` columns as struct ``row``, with n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, n_capitals, n_marks, base_failed, grp."""
    text, null = F.col("t"), F.lit("\x00")
    words, k = F.col("words"), WINDOW_WORDS

    def count_of(pattern: str) -> Column:
        return F.length(F.regexp_replace(text, f"[^{pattern}]+", "")).cast("long")

    group = F.concat(F.coalesce(docs["lang"].cast("string"), null), F.lit("\x01"),
                     F.coalesce(docs["source"].cast("string"), null))
    rows = docs.select(F.struct(*(docs[c].alias(c) for c in carried)).alias("row"), text_of(docs).alias("t"),
                       group.alias("grp"))
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    rows = rows.withColumns({
        "words": F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE)),
        "lines": F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
    rows = rows.withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "n_symbols": count_of("#*$%&|<>"), "n_capitals": count_of("A-Z"), "n_marks": count_of(".,;:!?"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "windows": F.when(F.size("words") >= k, F.transform(
            F.sequence(F.lit(0), F.size("words") - k),
            lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(k))))).otherwise(
                F.array().cast("array<bigint>"))}).drop("lines", "words", "t")
    # Only texts with a repeated window need its places.
    rows = rows.withColumn("sorted", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.array_sort(F.transform("windows", lambda x, i: F.struct(x.alias("x"), i.alias("i")))))).drop("windows")
    s = F.col("sorted")
    rows = rows.withColumn("places", F.array_sort(F.array_compact(F.transform(s, lambda e, n: F.when(
        F.coalesce(F.get(s, n + 1)["x"] == e["x"], F.lit(False))
        | F.coalesce((n > 0) & (F.get(s, n - 1)["x"] == e["x"]), F.lit(False)), e["i"]))))).drop("sorted")
    places = F.col("places")
    gaps = F.transform(places, lambda p, n: F.least(F.lit(k), F.coalesce(F.get(places, n + 1) - p, F.lit(k))))
    rows = rows.withColumn("n_repeat_words", F.coalesce(
        F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))).drop("places")
    n = F.col("n_words")
    return rows.withColumn("base_failed", (n < 20) | (100 * F.col("n_repeat_words") > 30 * n))


def with_rates(rows: DataFrame) -> DataFrame:
    """Adds x0, x1, ...: rates shrunk by ``SHRINK`` words, log or root scaled."""
    n = F.col("n_words") + SHRINK
    chars = F.col("word_chars") + 5 * SHRINK
    values = (F.log(chars / n), F.sqrt(F.col("n_symbols") / chars), F.sqrt(F.col("n_capitals") / chars),
              F.sqrt(F.col("n_marks") / n), F.col("n_repeat_words") / n)
    return rows.withColumns({f"x{i}": F.round(v * GRID) / GRID for i, v in enumerate(values)})


P = len(RATES)
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


ESTIMATE = [f"m{i}" for i in range(P)] + [f"l{i}{j}" for i, j in PAIRS]


def _factor(moments: DataFrame, factor: float, keys: tuple[str, ...] = ("grp",),
            scale: list[Column] | None = None) -> DataFrame:
    """Centre m0.. and the lower Cholesky factor l00, l10, ... of the scatter,
    from count c, sums s0.. and products q00.. of offsets from the medians;
    ``scale``: of offsets that were divided by it, about the medians."""
    c = F.col("c")
    unit = scale or [F.lit(1.0)] * P
    out = moments.withColumns({f"m{i}": F.lit(0.0) if scale else F.col(f"s{i}") / c for i in range(P)})
    out = out.withColumn("share", F.greatest(PRIOR / (c + PRIOR), F.lit(LEAST_SHARE)))
    share = F.col("share")
    out = out.withColumns({
        f"v{i}{j}": (1 - share) * factor * unit[i] * unit[j] * (F.col(f"q{i}{j}") / c - F.col(f"m{i}") * F.col(f"m{j}"))
        + share * (SPREAD[i] ** 2 if i == j else 0.0) for i, j in PAIRS})
    for i in range(P):
        for j in range(i + 1):
            inner = reduce(add, (F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            left = F.col(f"v{i}{j}") - inner
            value = F.sqrt(F.greatest(left, F.lit(1e-12))) if i == j else left / F.col(f"l{j}{j}")
            out = out.withColumn(f"l{i}{j}", value)
    return out.select(*keys, *ESTIMATE)


def _beside(rows: DataFrame, estimates: DataFrame, how: str = "inner") -> DataFrame:
    """Rows with the estimates of their group; few estimates are broadcast."""
    few = estimates.limit(SMALL + 1).count() <= SMALL
    return rows.join(F.broadcast(estimates) if few else estimates, "grp", how)


def _distance(rows: DataFrame, estimate: DataFrame, how: str = "inner") -> DataFrame:
    """Adds the squared Mahalanobis distance ``d`` of y0.. (columns of rows)
    from each estimate, and its ``start`` where it has one."""
    out = _beside(rows, estimate, how)
    for i in range(P):
        inner = reduce(add, (F.col(f"l{i}{k}") * F.col(f"z{k}") for k in range(i)), F.lit(0.0))
        out = out.withColumn(f"z{i}", (F.col(f"y{i}") - F.col(f"m{i}") - inner) / F.col(f"l{i}{i}"))
    return out.withColumn("d", reduce(add, (F.col(f"z{i}") * F.col(f"z{i}") for i in range(P)))).select(
        *rows.columns, *(c for c in estimate.columns if c == "start"), "d")


def _moments(values: list[Column]) -> list[Column]:
    return [F.count("*").alias("c"), *(F.sum(v).alias(f"s{i}") for i, v in enumerate(values)),
            *(F.sum(values[i] * values[j]).alias(f"q{i}{j}") for i, j in PAIRS)]


OFFSETS = [f"y{i}" for i in range(P)]


def _starts(rows: DataFrame, scales: DataFrame) -> DataFrame:
    """The starts (grp, start, ...) from offsets y0.. and median deviations a0.."""
    scale = [F.greatest(1.4826 * F.col(f"a{i}"), F.lit(SPREAD[i])) for i in range(P)]
    scaled = [F.col(f"y{i}") / F.col(f"w{i}") for i in range(P)]
    wide = scales.select("grp", *(s.alias(f"w{i}") for i, s in enumerate(scale)))
    norm = F.sqrt(reduce(add, (v * v for v in scaled)))
    signs = [F.when(norm > 0, v / norm).otherwise(0.0) for v in scaled]
    diagonal = scales.select("grp", F.lit(0).alias("start"), *(F.lit(0.0).alias(f"m{i}") for i in range(P)),
                             *((scale[i] if i == j else F.lit(0.0)).alias(f"l{i}{j}") for i, j in PAIRS))
    out = diagonal
    for number, (values, factor) in enumerate((([F.tanh(v) for v in scaled], 2.5), (signs, float(P))), 1):
        sums = _beside(rows, wide).groupBy("grp").agg(*_moments(values)).join(wide, "grp")
        shape = _factor(sums, factor, scale=[F.col(f"w{i}") for i in range(P)])
        out = out.unionByName(shape.withColumn("start", F.lit(number)))
    return out


def _concentrated(rows: DataFrame) -> DataFrame:
    """The estimates from the half of each group nearest by ``d``, by start."""
    binned = rows.withColumn("bin", F.floor(F.log(F.col("d") + 1e-6) * BINS))
    sums = binned.groupBy("grp", "start", "bin").agg(*_moments([F.col(y) for y in OFFSETS]))
    group = Window.partitionBy("grp", "start")
    total, before = F.sum("c").over(group), F.sum("c").over(group.orderBy("bin")) - F.col("c")
    near = sums.withColumns({"half": F.ceil((total + P + 1) / 2), "before": before}).where("before < half")
    names = [c for c in sums.columns if c not in ("grp", "start", "bin")]
    return _factor(near.groupBy("grp", "start").agg(*(F.sum(c).alias(c) for c in names)), HALF_FACTOR, ("grp", "start"))


def least_determinant(estimates: DataFrame) -> DataFrame:
    """Of each group the estimate of the smallest scatter, then of the first start."""
    log_det = reduce(add, (F.log(F.col(f"l{i}{i}")) for i in range(P)))
    order = Window.partitionBy("grp").orderBy(F.round(log_det, 9), "start")  # a row for each start
    return estimates.withColumn("place", F.row_number().over(order)).where("place = 1").select("grp", *ESTIMATE)


def mcd(rows: DataFrame) -> DataFrame:
    """Per group the reweighted estimate, from rows (grp, x0..)."""
    def middle(values: dict[str, Column]) -> list[Column]:
        return [F.percentile(v, 0.5).alias(n) for n, v in values.items()]

    medians = written(rows.groupBy("grp").agg(*middle({f"b{i}": F.col(f"x{i}") for i in range(P)})), "medians")
    rows = written(_beside(rows, medians).select(
        "grp", *((F.col(f"x{i}") - F.col(f"b{i}")).alias(f"y{i}") for i in range(P))), "offsets")
    rounded = {f"a{i}": F.round(F.abs(F.col(f"y{i}")) * GRID) / GRID for i in range(P)}
    scales = written(rows.groupBy("grp").agg(*middle(rounded)), "scales")
    # The estimates, a row per group and start, are written: plans stay as small as one step.
    estimate = written(_starts(rows, scales), "estimate")
    for _ in range(STEPS):
        estimate = written(_concentrated(_distance(rows, estimate)), "estimate")
    estimate = written(least_determinant(estimate), "estimate")
    near = _distance(rows, estimate).where(F.col("d") <= REWEIGHT)
    # A group none of whose rows is that near keeps its last estimate.
    final = _factor(near.groupBy("grp").agg(*_moments([F.col(y) for y in OFFSETS])), REWEIGHT_FACTOR)
    final = estimate.join(final.select("grp", *(F.col(c).alias(f"n_{c}") for c in ESTIMATE)), "grp", "left").select(
        "grp", *(F.coalesce(f"n_{c}", c).alias(c) for c in ESTIMATE))
    centre = {f"m{i}": F.col(f"m{i}") + F.col(f"b{i}") for i in range(P)}
    return final.join(medians, "grp").withColumns(centre).select("grp", *ESTIMATE)


def judged(docs: DataFrame, carried: list[str]) -> DataFrame:
    """Rows (row: the ``carried`` columns, the statistics, base_failed,
    distance, kept)."""
    rows = written(with_rates(word_statistics(docs, carried)), "statistics")
    x = [f"x{i}" for i in range(P)]
    estimate = written(mcd(rows.where(~F.col("base_failed")).select("grp", *x)), "mcd")
    scored = _distance(rows.withColumnsRenamed({f"x{i}": f"y{i}" for i in range(P)}), estimate, "left")
    kept = ~F.col("base_failed") & (F.col("d") <= CUTOFF)
    return scored.select(*(c for c in rows.columns if c not in x), F.col("d").alias("distance"),
                         F.coalesce(kept, F.lit(False)).alias("kept"))


def filtered(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their columns as they were."""
    passed = judged(docs, docs.columns).where("kept")
    return passed.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(read_table(spark, sf_dir, "documents"), ["doc_id"]).select(
        F.col("row.doc_id").cast("long").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "distance", "kept")
