"""Quality scores by a sparse ensemble of rules.

Statistics of a text are Spark columns. Trees grown on a bounded sample of labelled rows give paths; each path is a
conjunctive rule over the statistics. A lasso logistic regression over rules and scaled statistics keeps few of them,
and what it keeps is compiled back into one Spark column, so scoring reads each text once and needs no Python.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import bind, remainder, text_of, words_of
from gridloom.session import settle

#: Labelled rows a model is fitted on at most: those with the smallest hash of their id.
FIT_ROWS = 20_000
TREES, DEPTH, LASSO = 32, 3, 0.002

Condition = tuple[str, bool, float]  # statistic, at most (or else above), threshold
Rule = tuple[Condition, ...]


def _share(n: Column, of: Column) -> Column:
    return F.when(of > 0, n / of).otherwise(F.lit(0.0))


def with_statistics(docs: DataFrame, text: str = "text") -> tuple[DataFrame, list[str]]:
    """``docs`` with statistics of the whole text in the fields of ``_gl_stats``, and their names.

    An empty or null text has zeros.
    """
    whole = text_of(text)
    words = bind(
        words_of(whole),
        lambda w: F.struct(
            F.size(w).alias("n"),
            F.size(F.array_distinct(w)).alias("distinct"),
            F.size(F.filter(w, lambda x, i: (i > 0) & (x == F.get(w, i - 1)))).alias("echoed"),
        ),
    )
    lines = bind(
        F.filter(F.split(whole, "\n"), lambda x: x != ""),
        lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct")),
    )
    chars, n_words, n_lines = F.length(whole), F.col("_gl_words.n"), F.col("_gl_lines.n")

    def characters(chosen: str) -> Column:
        return _share(chars - F.length(F.translate(whole, chosen, "")), chars)

    values = {
        "log_chars": F.log1p(chars),
        "log_words": F.log1p(n_words),
        "chars_a_word": _share(chars, n_words),
        "log_words_a_line": F.log1p(_share(n_words, n_lines)),
        "distinct_words": _share(F.col("_gl_words.distinct"), n_words),
        "echoed_words": _share(F.col("_gl_words.echoed"), n_words),
        "repeated_lines": _share(n_lines - F.col("_gl_lines.distinct"), n_lines),
        "upper": characters("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        "digits": characters("0123456789"),
        "symbols": characters("#$%&*+/<=>@\\^_`|~[]{}"),
        "marks": characters("!?"),
        "stops": characters(".,;:"),
    }
    # The arrays are reduced in a projection of their own, so that several statistics share them.
    frame = docs.withColumns({"_gl_words": words, "_gl_lines": lines})
    frame = frame.withColumn("_gl_stats", F.struct(*[v.cast("double").alias(k) for k, v in values.items()]))
    return frame.drop("_gl_words", "_gl_lines"), list(values)


@dataclass(frozen=True)
class Model:
    """Weights of rules and of scaled statistics; ``shift`` and ``scale`` bring a statistic to mean 0 and deviation 1."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...] = ()
    linear: tuple[tuple[str, float, float, float], ...] = ()  # statistic, shift, scale, weight

    def score(self, stats: str = "_gl_stats") -> Column:
        """Probability of label 1, as one column."""
        terms = [F.when(holds(rule, stats), F.lit(w)).otherwise(F.lit(0.0)) for rule, w in self.rules]
        terms += [scaled(name, shift, scale, stats) * F.lit(w) for name, shift, scale, w in self.linear]
        total = reduce(lambda x, y: x + y, terms, F.lit(self.intercept))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def holds(rule: Rule, stats: str = "_gl_stats") -> Column:
    parts = [F.col(f"{stats}.{name}") <= F.lit(t) if below else F.col(f"{stats}.{name}") > F.lit(t) for name, below, t in rule]
    return reduce(lambda x, y: x & y, parts)


def scaled(name: str, shift: float, scale: float, stats: str = "_gl_stats") -> Column:
    """A statistic in deviations from its mean, cut at three so that no outlier outweighs the rules."""
    return F.greatest(F.lit(-3.0), F.least(F.lit(3.0), (F.col(f"{stats}.{name}") - shift) / scale))


def paths(forest, names: list[str]) -> list[Rule]:
    """The distinct paths from a root to any other node, each with one bound per statistic and side."""
    found: dict[Rule, None] = {}

    def walk(node, bounds: dict[tuple[str, bool], float]) -> None:
        if bounds:
            found[tuple(sorted((name, below, t) for (name, below), t in bounds.items()))] = None
        if node.subtreeDepth() == 0:
            return
        name, t = names[node.split().featureIndex()], float(node.split().threshold())
        for child, below in ((node.leftChild(), True), (node.rightChild(), False)):
            tightest = min if below else max
            walk(child, bounds | {(name, below): tightest(t, bounds.get((name, below), t))})

    for one in forest.trees:
        walk(one._java_obj.rootNode(), {})
    return list(found)


def labelled(stats: DataFrame, labels: DataFrame, learn: Column, rows: int = FIT_ROWS) -> DataFrame:
    """``label, _gl_stats`` of at most ``rows`` labelled rows that satisfy ``learn``; repeated labels count by their mean."""
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
    # Labels take a few bytes each in a file and many times that in memory: they are not broadcast.
    known = stats.where(learn).join(marks.hint("merge"), "doc_id")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    # Most rows beyond the smallest hashes go before the sort, in every task for itself.
    share = 1.25 * rows / max(known.count(), 1)
    if share < 1:
        known = known.where(place < int(share * (1 << 20)))
    return known.orderBy(place, "doc_id").limit(rows).select("label", "_gl_stats")


def fit(sample: DataFrame, names: list[str], trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO) -> Model:
    """Grow trees, take their paths as rules and weigh them; without two kinds of labels, their share is the score."""
    known = settle(sample.coalesce(1)).coalesce(1)
    moments = known.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("label").alias("share"),
        *[f(f"_gl_stats.{n}").alias(f"{k}_{n}") for n in names for k, f in (("mean", F.avg), ("dev", F.stddev_pop))],
    ).first()
    share = moments["share"]
    if not moments["n"] or share in (0.0, 1.0):
        odds = 0.5 if not moments["n"] else min(max(share, 0.01), 0.99)
        return Model(math.log(odds / (1 - odds)))
    vectors = known.select("label", "_gl_stats", array_to_vector(F.array(*[F.col(f"_gl_stats.{n}") for n in names])).alias("features")).cache()
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=42, subsamplingRate=0.5, featureSubsetStrategy="onethird").fit(vectors)
    rules = paths(forest, names)
    linear = [(n, moments[f"mean_{n}"], moments[f"dev_{n}"]) for n in names if moments[f"dev_{n}"]]
    columns = [holds(r).cast("double") for r in rules] + [scaled(*x) for x in linear]
    matrix = vectors.select("label", array_to_vector(F.array(*columns)).alias("features")).cache()
    fitted = LogisticRegression(elasticNetParam=1.0, regParam=lasso, standardization=False, maxIter=100).fit(matrix)
    matrix.unpersist()
    vectors.unpersist()
    weights = fitted.coefficients.toArray().tolist()
    kept = [(r, w) for r, w in zip(rules, weights, strict=False) if w]
    lines = [(*x, w) for x, w in zip(linear, weights[len(rules) :], strict=True) if w]
    return Model(float(fitted.intercept), tuple(kept), tuple(lines))


def train(docs: DataFrame, labels: DataFrame, learn: Column | None = None) -> tuple[Model, DataFrame]:
    """The model and the statistics ``doc_id, _gl_stats`` of all documents, written once."""
    frame, names = with_statistics(docs.select("doc_id", "text"))
    stats = settle(frame.drop("text"))
    return fit(labelled(stats, labels, F.lit(True) if learn is None else learn), names), stats


def held_out() -> Column:
    return remainder("doc_id", 5) == 0


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row; held-out rows teach nothing.

    Null and empty texts are scored like any other, from zero statistics. Labels of no document, null labels and null
    ids teach nothing; without labels the score is 0.5. Rows with equal ids each keep a row; an empty table gives none.
    """
    model, stats = train(docs, labels, ~held_out())
    scored = stats.select("doc_id", held_out().alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``, columns as they are."""
    model, _ = train(docs, labels, ~held_out())
    frame, _ = with_statistics(docs)
    return frame.where(model.score() >= threshold).select(*docs.columns)
