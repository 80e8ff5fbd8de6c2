"""Robust multivariate outliers among texts.

Each text has a vector of transformed statistics. Per language and source the minimum covariance determinant is
sought by concentration steps from three starts: medians with quartile ranges, mean and covariance of all, and those of
texts drawn in towards the medians. A step goes from an estimate to the three quarters of the texts that lie nearest and
to their mean and covariance, and is repeated until the determinant falls no more; the start that ends with the smallest
determinant gives the estimate. The same is done per language and over all texts, and the estimate of a source is
shrunk towards its language's, that of a language towards the whole's, so that sources of any size are judged. A
text far from its group in Mahalanobis distance is rejected. The estimates are plain sums and quantile sketches,
combined before the shuffle, so one group may hold any share of the rows; all of it is Spark expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import bind, text_of, words_of
from gridloom.session import settle

#: Share of a group the estimate rests on; fall of the logarithm of a determinant below which a step counts as none;
#: texts that the estimate of the group above is worth.
NEAREST, FALL, SHRINK = 0.75, 1e-3, 25
#: Places in which a group meets its estimates.
SALTS = 16
#: Least standard deviation of each coordinate: where most texts agree, small differences are no outliers.
FLOORS = {"size": 0.5, "word_length": 0.5, "symbols": 0.7, "dup_lines": 1.0, "repeats": 1.0}
#: Median, and 0.999999 quantile, of chi-square with five degrees of freedom.
MEDIAN, CUTOFF = 4.351, 35.888
COORDINATES = list(FLOORS)


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of three words found twice or more.

    Windows are compared by 64-bit hashes. Most texts repeat none, which a hash set tells; only the others are sorted.
    """

    def covered(positions: Column) -> Column:
        # Each window covers three words, or as many as there are before the next window begins.
        steps = F.transform(positions, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(positions, i + 1) - p, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def found_twice(s: Column) -> Column:
        def again(x: Column, i: Column) -> Column:
            return F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))

        return bind(F.sort_array(F.transform(F.filter(s, again), lambda x: x["i"])), covered)

    def of_windows(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(bind(placed, found_twice))

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 3, F.lit(0)).otherwise(bind(windows, of_windows))


def counts(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source`` and the counts of each whole text; null texts have no words."""
    text = text_of()

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).alias("n"), repeated_words(w).alias("repeated"))

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    of_lines = bind(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    # Characters of words: all but white space.
    chars = F.length(F.translate(text, " \t\n\x0b\x0c\r", ""))
    frame = docs.select("doc_id", "lang", "source", bind(words_of(text), of_words).alias("w"), of_lines.alias("x"), chars.alias("chars"), (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).alias("symbols"))
    named = {"n_words": "w.n", "word_chars": "chars", "n_symbols": "symbols", "n_dup_lines": "x.dup", "n_repeat_words": "w.repeated", "n_lines": "x.n"}
    return frame.select("doc_id", "lang", "source", *[F.col(c).cast("long").alias(n) for n, c in named.items()])


def vectors(counted: DataFrame) -> DataFrame:
    """Adds the coordinates; shares are taken per hundred and, like sizes, as logarithms."""
    words, lines = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("n_lines"), F.lit(1))
    return counted.withColumns({
        "size": F.log1p("n_words"),
        "word_length": F.col("word_chars") / words,
        "symbols": F.log1p(100 * F.col("n_symbols") / words),
        "dup_lines": F.log1p(100 * F.col("n_dup_lines") / lines),
        "repeats": F.log1p(100 * F.col("n_repeat_words") / words),
    })


PAIRS = [(a, b) for i, a in enumerate(COORDINATES) for b in COORDINATES[: i + 1]]
#: Names of the parts of an estimate: means, and covariances of the lower triangle.
PARTS = [*[f"m_{c}" for c in COORDINATES], *[f"c_{a}_{b}" for a, b in PAIRS]]
START = ["_group", "_start"]


def _factor(table: DataFrame) -> DataFrame:
    """Adds the lower Cholesky factor of the covariances and ``_logdet``, the logarithm of their determinant."""
    for j, b in enumerate(COORDINATES):
        done = COORDINATES[:j]
        square = reduce(lambda x, y: x - y, [F.col(f"l_{b}_{k}") ** 2 for k in done], F.col(f"c_{b}_{b}"))
        table = table.withColumn(f"l_{b}_{b}", F.sqrt(F.greatest(square, F.lit(FLOORS[b] ** 2))))
        below = {}
        for a in COORDINATES[j + 1 :]:
            rest = reduce(lambda x, y: x - y, [F.col(f"l_{a}_{k}") * F.col(f"l_{b}_{k}") for k in done], F.col(f"c_{a}_{b}"))
            below[f"l_{a}_{b}"] = rest / F.col(f"l_{b}_{b}")
        table = table.withColumns(below) if below else table
    return table.withColumn("_logdet", 2 * reduce(lambda x, y: x + y, [F.log(f"l_{c}_{c}") for c in COORDINATES]))


def _estimate(rows: DataFrame) -> DataFrame:
    """Per group and start: number of rows, mean, and covariance with variances raised by the floors."""
    raised = [(F.covar_pop(a, b) + (FLOORS[a] ** 2 if a == b else 0.0)).alias(f"c_{a}_{b}") for a, b in PAIRS]
    return _factor(rows.groupBy(*START).agg(F.count(F.lit(1)).alias("_n"), *[F.avg(c).alias(f"m_{c}") for c in COORDINATES], *raised))


def _starts(rows: DataFrame) -> DataFrame:
    """Three estimates per group to start from."""
    quartiles = rows.groupBy("_group").agg(F.count(F.lit(1)).alias("_n"), *[F.percentile_approx(c, [0.25, 0.5, 0.75], 1000).alias(c) for c in COORDINATES])
    means = [F.col(c)[1].alias(f"m_{c}") for c in COORDINATES]
    width = {c: F.greatest((F.col(c)[2] - F.col(c)[0]) / 1.349, F.lit(FLOORS[c])) for c in COORDINATES}
    covariances = [(width[a] ** 2 if a == b else F.lit(0.0)).alias(f"c_{a}_{b}") for a, b in PAIRS]
    medians = settle(_factor(quartiles.select("_group", F.lit(0).alias("_start"), "_n", *means, *covariances)))
    # Start 1 takes the rows as they are, start 2 draws them in: the hyperbolic tangent of their distance to the median.
    near = beside(rows, medians.drop("_start"))
    drawn = {c: F.col(f"m_{c}") + F.col(f"l_{c}_{c}") * F.tanh((F.col(c) - F.col(f"m_{c}")) / F.col(f"l_{c}_{c}")) for c in COORDINATES}
    moved = near.withColumn("_start", F.explode(F.array(F.lit(1), F.lit(2)))).select(*START, *[F.when(F.col("_start") == 1, F.col(c)).otherwise(drawn[c]).alias(c) for c in COORDINATES])
    return settle(medians.unionByName(_estimate(moved)))


def _distance() -> Column:
    """Squared Mahalanobis distance, by forward substitution."""
    solved: list[Column] = []
    for i, a in enumerate(COORDINATES):
        rest = reduce(lambda x, y: x - y, [F.col(f"l_{a}_{b}") * solved[k] for k, b in enumerate(COORDINATES[:i])], F.col(a) - F.col(f"m_{a}"))
        solved.append(rest / F.col(f"l_{a}_{a}"))
    return reduce(lambda x, y: x + y, [z * z for z in solved])


def beside(rows: DataFrame, table: DataFrame, how: str = "inner", keys: Sequence[str] = ("_group",)) -> DataFrame:
    """The facts of a group beside its rows; a group meets its facts in ``SALTS`` places, so that none holds all of it."""
    salted = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(salted, [*keys, "_salt"], how)


def concentrate(rows: DataFrame, table: DataFrame) -> DataFrame:
    """One step for each group and start of ``table``: mean and covariance of the rows nearest to its estimate."""
    near = beside(rows, table).select(*START, "_salt", *COORDINATES, _distance().alias("_d"))
    limits = settle(near.groupBy(*START).agg(F.percentile_approx("_d", NEAREST, 1000).alias("_limit")))
    return settle(_estimate(beside(near, limits, keys=START).where("_d <= _limit")))


def estimates(rows: DataFrame) -> DataFrame:
    """Per ``_group`` of rows ``_group, _salt`` and coordinates: the estimate of the smallest determinant found.

    Steps go on for those groups and starts whose determinant still falls; each fall is at least ``FALL`` of its
    logarithm, which the floors bound below, so they end. Only the number of such starts comes to the driver.
    """
    now = concentrate(rows, _starts(rows))
    ended = now.limit(0)
    while now.take(1):
        following = concentrate(rows, now)
        before = now.select(*START, F.col("_logdet").alias("_before"))
        falls = settle(following.join(before, START).where(F.col("_logdet") < F.col("_before") - FALL).drop("_before"))
        ended = settle(ended.unionByName(now.join(falls.select(*START), START, "left_anti")))
        now = falls
    best = ended.groupBy("_group").agg(F.min(F.struct("_logdet", "_start", *PARTS)).alias("_best"))
    return settle(best.select("_group", "_best.*"))


def shrunk(table: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of each group drawn towards those of the group above it, which counts as ``SHRINK`` texts; the whole first."""
    out = [table.where("_level = 0")]
    for level in (1, 2):
        above = out[-1].select(F.col("_group").alias("_above"), *[F.col(c).alias(f"_above_{c}") for c in columns])
        own = table.where(F.col("_level") == level).join(above, "_above")
        drawn = {c: (F.col("_texts") * F.col(c) + SHRINK * F.col(f"_above_{c}")) / (F.col("_texts") + SHRINK) for c in columns}
        out.append(own.withColumns(drawn).select(*table.columns))
    return reduce(DataFrame.unionByName, out)


def scales(rows: DataFrame) -> DataFrame:
    """Per language and source of rows ``lang, source, _salt`` and coordinates: ``_group``, its estimate and ``_scale``."""
    name = [F.lit("{}"), F.to_json(F.struct("lang")), F.to_json(F.struct("lang", "source"))]
    levels = [F.struct(F.lit(i).alias("_level"), n.alias("_group"), name[max(i - 1, 0)].alias("_above")) for i, n in enumerate(name)]
    spread = rows.select("_salt", *COORDINATES, F.explode(F.array(*levels)).alias("_l")).select("_salt", *COORDINATES, "_l.*")
    tree = spread.groupBy("_level", "_group", "_above").agg(F.count(F.lit(1)).alias("_texts"))
    spread = spread.drop("_level", "_above")
    table = settle(_factor(shrunk(settle(estimates(spread).drop("_logdet").join(settle(tree), "_group")), PARTS)))
    middle = beside(spread, table).groupBy("_group").agg(F.percentile_approx(_distance(), 0.5, 1000).alias("_median"))
    scale = F.greatest(F.col("_median") / MEDIAN, F.lit(1.0))
    return settle(shrunk(settle(table.join(settle(middle), "_group").withColumn("_scale", scale)), ["_scale"]).where("_level = 2"))


def judge(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance, kept`` per row.

    ``distance`` is squared and scaled so that half a group lies within the median of chi-square (never scaled up); it is
    null for texts that fail the base rules. Null languages and sources count as empty. Rows with equal or null ids are
    judged each for itself; an empty table gives none; other columns are not read.
    """
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    read = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), "text")
    rows = settle(vectors(counts(read)).withColumns({"base_failed": failed, "_salt": (F.monotonically_increasing_id() % SALTS).cast("int")}))
    table = scales(rows.where("not base_failed").select("lang", "source", "_salt", *COORDINATES))
    named = rows.withColumn("_group", F.to_json(F.struct("lang", "source")))
    distance = F.when(~F.col("base_failed"), _distance() / F.col("_scale"))
    judged = beside(named, table, "left").withColumn("distance", distance)
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= CUTOFF, F.lit(True))
    return judged.withColumn("kept", kept).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", "kept")
