"""Quality rules by robust multivariate outliers. DataFrame functions only.

Each document becomes a vector of transformed statistics. For every (language, source) the location and scatter of
the three quarters of the documents that lie closest together are estimated (minimum covariance determinant). As in
Rousseeuw and Van Driessen (1999) several starts take a few concentration steps, each the moments of the documents
closest to the estimate before; the start with the lowest determinant goes on until its determinant stands still. A
document whose squared Mahalanobis distance is beyond the cutoff is rejected.

Documents meet the estimates of their group in joins whose keys carry a salt, so that a hot group is dealt to many
tasks, and leave them as counts per bin and as partial moments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import lookup_table
from .common import SPACE, WORD, store, text_of

WINDOW = 5
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


# Statistics ---------------------------------------------------------------------------------------------


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of whole texts (NULL: empty).

    A window of five words is compared by a 64-bit hash of its words.
    """
    text = F.col("_text")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.regexp_replace(x, SPACE, "")) > 0)
    # A generator keeps the optimizer from putting an array's expression wherever the array is used.
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        text_of().alias("_text"),
    )
    rows = rows.select("*", F.explode(F.array(F.struct(
        F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w)).alias("words"),
        lines.alias("lines"),
    ))).alias("_cut"))
    base = rows.select(
        "doc_id",
        "lang",
        "source",
        F.size("_cut.words").cast("long").alias("n_words"),
        F.length(F.regexp_replace(text, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_cut.lines") - F.size(F.array_distinct("_cut.lines"))).cast("long").alias("n_dup_lines"),
        F.col("_cut.words").alias("_words"),
    )
    words = F.col("_words")
    at = lambda i, k: F.get(words, i + k)
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(*[at(i, k) for k in range(WINDOW)])
    )
    windows = F.when(F.size(words) >= WINDOW, windows).otherwise(F.array().cast("array<bigint>"))
    cut = base.select("*", F.explode(F.array(windows)).alias("_windows")).drop("_words")
    return cut.select("*", _repeat_words("_windows").alias("n_repeat_words")).drop("_windows")


def _repeat_words(column: str) -> Column:
    """Words that lie in a window found at least twice."""
    windows = F.col(column)
    repeated = F.size(F.array_distinct(windows)) < F.size(windows)
    return F.when(repeated, F.expr(f"""
      aggregate(
        array_sort(flatten(transform(
          array(array_sort(transform({column}, (h, i) -> struct(h, i)))),
          s -> transform(filter(s, (x, k) -> get(s, k - 1).h = x.h OR get(s, k + 1).h = x.h), x -> x.i)))),
        struct(0L AS total, -{WINDOW} AS last),
        (a, i) -> struct(a.total + least({WINDOW}, i - a.last) AS total, i AS last),
        a -> a.total)""")).otherwise(F.lit(0)).cast("long")  # fmt: skip


# Robust estimates ---------------------------------------------------------------------------------------

VECTOR = ("x1", "x2", "x3", "x4", "x5")
#: A deviation in each statistic that is never taken for unusual by itself: added to the scatter. One repeated line or
#: a few repeated words are usual in any source; an eighth of all words, or a repeated line in fifteen words, is not.
FLOORS = (0.1, 0.06, 0.5, 0.45, 0.35)
#: Share of a group's documents that the estimate rests on.
CORE = 0.75
#: Starts, steps that each of them takes, and steps that the best one takes at most.
STARTS, FIRST_STEPS, MAX_STEPS = 4, 2, 15
#: Change of the determinant's logarithm that ends the steps; the core is counted in bins, which leaves as much open.
STANDS_STILL = 0.01
#: Documents a group needs for an estimate of its own.
MIN_GROUP = 40
#: Squared distance beyond which a document is rejected: chi-square with 5 degrees at 1 - 5e-6.
CUTOFF = 32.4
#: Fixed values for 5 dimensions: the median of chi-square, and what makes the scatter of the inner 75 % unbiased.
CHI_MEDIAN = 4.351
CORE_FACTOR = 1.412
#: Parts a group is dealt in.
SALTS = 32


def _transformed() -> list[Column]:
    """Length, word length, symbols, repeated words and repeated lines per word, on logarithmic scales."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return [
        F.log1p(F.col("n_words").cast("double")).alias("x1"),
        F.log(F.col("word_chars").cast("double") / n + 0.01).alias("x2"),
        F.log(F.col("n_symbols") / n + 0.01).alias("x3"),
        F.log(F.col("n_repeat_words") / n + 0.01).alias("x4"),
        F.log(F.col("n_dup_lines") / n + 0.01).alias("x5"),
    ]


def _quantile(binned: DataFrame, keys: list[str], share: float) -> DataFrame:
    """The smallest `bin` of each key that has so much of its rows at or below it; exact on the bins."""
    counts = binned.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("_n"))
    # Bins are on a fixed grid, so a key has at most some thousands of them.
    upto = Window.partitionBy(*keys).orderBy("bin")
    total = Window.partitionBy(*keys)
    summed = counts.select(*keys, "bin", F.sum("_n").over(upto).alias("_upto"), F.sum("_n").over(total).alias("_all"))
    return summed.where(F.col("_upto") >= F.col("_all") * share).groupBy(*keys).agg(F.min("bin").alias("bin"))


def _medians(values: DataFrame) -> DataFrame:
    """A row per group with the medians of the vector's entries, to 1/256."""
    bins = F.array(*[F.struct(F.lit(x).alias("entry"), F.floor(F.col(x) * 256).alias("bin")) for x in VECTOR])
    long = values.select("group", F.explode(bins).alias("_b")).select("group", "_b.*")
    middle = _quantile(long, ["group", "entry"], 0.5)
    return middle.groupBy("group").agg(
        *[F.max(F.when(F.col("entry") == x, (F.col("bin") + 0.5) / 256)).alias(x) for x in VECTOR]
    )


def _factor(covariance: dict[tuple[int, int], Column]) -> dict[str, Column]:
    """The Cholesky factor's entries, each from those before it."""
    d, low = len(VECTOR), {}
    for j in range(d):
        for i in range(j, d):
            rest = covariance[i, j]
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            low[f"l{i}{j}"] = F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}")
    return low


def _looked_up(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Rows, which have a `_salt`, with the one row of the table for their keys."""
    salted = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(salted, [*keys, "_salt"], how)


def _with_factor(moments: DataFrame, covariance: dict[tuple[int, int], Column]) -> DataFrame:
    for name, column in _factor(covariance).items():
        moments = moments.withColumn(name, column)
    d = len(VECTOR)
    size = sum(F.log(F.col(f"l{i}{i}")) for i in range(d))
    factor = [f"l{i}{j}" for j in range(d) for i in range(j, d)]
    return moments.select("group", *[f"m{i}" for i in range(d)], *factor, (2 * size).alias("log_det"))


def _distance(vectors: DataFrame, estimates: DataFrame) -> DataFrame:
    """The vectors with `distance`, the squared Mahalanobis distance to their group's estimate (NULL without one)."""
    joined = _looked_up(vectors, estimates, ["group"], "left")
    for i, x in enumerate(VECTOR):
        rest = F.col(x) - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"z{k}")
        joined = joined.withColumn(f"z{i}", rest / F.col(f"l{i}{i}"))
    return joined.withColumn("distance", sum(F.col(f"z{i}") * F.col(f"z{i}") for i in range(len(VECTOR))))


def _distance_bin() -> Column:
    return F.floor(F.log2(F.col("distance") + 0.001) * 256)


def _moments(rows: DataFrame) -> DataFrame:
    """Means m and covariances c of each group."""
    d = len(VECTOR)
    means = [F.avg(x).alias(f"m{i}") for i, x in enumerate(VECTOR)]
    products = [F.covar_pop(VECTOR[i], VECTOR[j]).alias(f"c{i}{j}") for j in range(d) for i in range(j, d)]
    return rows.groupBy("group").agg(*means, *products)


def _estimate_of(moments: DataFrame, factor: float) -> DataFrame:
    d = len(VECTOR)
    covariance = {
        (i, j): F.col(f"c{i}{j}") * factor + (FLOORS[i] ** 2 if i == j else 0.0) for j in range(d) for i in range(j, d)
    }
    return _with_factor(moments, covariance)


def _from_medians(vectors: DataFrame) -> DataFrame:
    """Medians, and median deviations without correlations."""
    d = len(VECTOR)
    middle = store(_medians(vectors), "medians")
    apart = _looked_up(vectors, middle.select("group", *[F.col(x).alias(f"_{x}") for x in VECTOR]), ["group"])
    spread = _medians(apart.select("group", *[F.abs(F.col(x) - F.col(f"_{x}")).alias(x) for x in VECTOR]))
    first = middle.select("group", *[F.col(x).alias(f"m{i}") for i, x in enumerate(VECTOR)]).join(spread, "group")
    covariance = {
        (i, j): F.pow(1.4826 * F.col(VECTOR[i]), 2) + FLOORS[i] ** 2 if i == j else F.lit(0.0) for j in range(d) for i in range(j, d)
    }
    return _with_factor(first, covariance)


def step(vectors: DataFrame, estimates: DataFrame) -> DataFrame:
    """A concentration step: the moments of each group's documents closest to its estimate."""
    placed = _distance(vectors, estimates).withColumn("bin", _distance_bin())
    limits = _quantile(placed.select("group", "bin"), ["group"], CORE).withColumnRenamed("bin", "_limit")
    core = _looked_up(placed.select("group", "_salt", *VECTOR, "bin"), store(limits, "limits"), ["group"])
    return store(_estimate_of(_moments(core.where(F.col("bin") <= F.col("_limit"))), CORE_FACTOR), "estimates")


def estimate(vectors: DataFrame) -> DataFrame:
    """Location m, the Cholesky factor l of the scatter and its `log_det` for each group, from stored (group, _salt,
    _part, x1, ...).

    The starts are the medians, the plain moments, and the moments of two eighths of a group's documents.
    """
    begin = [
        _from_medians(vectors),
        _estimate_of(_moments(vectors), 1.0),
        *[_estimate_of(_moments(vectors.where(F.col("_part") == k)), 1.0) for k in range(STARTS - 2)],
    ]
    start = lambda k: F.concat(F.col("group"), F.lit(f"\n{k}")).alias("group")
    rest = [c for c in vectors.columns if c != "group"]
    several = vectors.select(F.explode(F.array(*[start(k) for k in range(STARTS)])).alias("group"), *rest)
    estimates = begin[0].withColumn("group", start(0))
    for k, one in enumerate(begin[1:], 1):
        estimates = estimates.unionByName(one.withColumn("group", start(k)))
    estimates = store(estimates, "starts")
    for _ in range(FIRST_STEPS):
        estimates = step(several, estimates)
    columns = [c for c in estimates.columns if c != "group"]
    named = estimates.withColumn("group", F.regexp_replace("group", r"\n\d$", ""))
    chosen = named.groupBy("group").agg(F.min_by(F.struct(*columns), F.struct("log_det", "m0")).alias("_best"))
    estimates = store(chosen.select("group", "_best.*"), "chosen")
    for _ in range(MAX_STEPS):
        before = estimates.select("group", F.col("log_det").alias("_before"))
        after = step(vectors, estimates)
        moved = after.join(before, "group").agg(F.max(F.abs(F.col("log_det") - F.col("_before")))).first()[0]
        estimates = after
        if moved is None or moved < STANDS_STILL:
            break
    return estimates


# The operator -------------------------------------------------------------------------------------------


def judge(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, the statistics, base_failed, distance (NULL if not judged), kept.

    Documents that fail the base rules are neither judged nor part of an estimate. Groups are (language, source), NULL
    being a value of its own. Small groups of a language are judged together, and those languages that are still
    small in one group; if that is small too its documents are kept. Where half a group lies wider than the
    normal distribution would, the cutoff grows in proportion. Rows that repeat count as often as they occur; other columns play no part.
    """
    stats = with_statistics(docs)
    n, repeats = F.col("n_words"), F.col("n_repeat_words")
    failed = (n < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n)
    lang = F.coalesce(F.concat(F.lit("="), "lang"), F.lit(""))
    source = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    rows = store(
        stats.select("*", failed.alias("base_failed"), lang.alias("_lang"), source.alias("_source"), *_transformed()), "statistics"
    )
    judged = rows.where("NOT base_failed")
    counts = judged.groupBy("_lang", "_source").agg(F.count(F.lit(1)).alias("_n"))
    by_lang = Window.partitionBy("_lang")
    small = F.col("_n") < MIN_GROUP
    of_lang = F.sum(F.when(small, F.col("_n"))).over(by_lang)
    group = (
        F.when(~small, F.concat_ws("\n", F.lit("own"), "_lang", "_source"))
        .when(of_lang >= MIN_GROUP, F.concat_ws("\n", F.lit("language"), "_lang"))
        .otherwise(F.lit("rest"))
    )
    groups = store(counts.withColumn("group", group).select("_lang", "_source", "group", "_n"), "groups")
    table = lookup_table(groups, ["_lang", "_source"], F.max("group").alias("group"))
    # Which documents are together in a part, and in an eighth, follows from what they are.
    mixed = F.xxhash64("doc_id", *VECTOR)
    salted = rows.withColumns({"_salt": F.pmod(mixed, F.lit(SALTS)).cast("int"), "_part": F.pmod(F.shiftright(mixed, 20), F.lit(8))})
    vectors = store(_looked_up(salted, table, ["_lang", "_source"], "left"), "vectors")

    enough = groups.groupBy("group").agg(F.sum("_n").alias("_n")).where(F.col("_n") >= MIN_GROUP).select("group")
    judged = vectors.where("NOT base_failed")
    fitted = _looked_up(judged, enough, ["group"]).select("group", "_salt", "_part", *VECTOR)
    estimates = estimate(store(fitted, "fitted"))
    placed = _distance(vectors, estimates)
    inside = placed.where("NOT base_failed AND distance IS NOT NULL").select("group", _distance_bin().alias("bin"))
    middle = _quantile(inside, ["group"], 0.5)
    wider = F.greatest(F.lit(1.0), F.pow(F.lit(2.0), (F.col("bin") + 1) / 256) / CHI_MEDIAN)
    limits = store(middle.select("group", (F.lit(CUTOFF) * wider).alias("_limit")), "cutoffs")
    distance = F.when(~F.col("base_failed"), F.col("distance"))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= F.col("_limit"), F.lit(True))
    return _looked_up(placed, limits, ["group"], "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        distance.alias("distance"), kept.alias("kept"),
    )


def result(docs: DataFrame) -> DataFrame:
    return judge(docs).drop("distance")
