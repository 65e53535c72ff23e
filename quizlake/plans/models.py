"""Training and application of the three models with MLlib."""

from __future__ import annotations

import math
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from quizlake.functions import text as T, values as V
from quizlake.operators import corpus as K, features as X, metrics as M, reshape as R
from quizlake.operators.verdicts import soft_vote
from quizlake.plans.clusters import Clusters, assign_centers, cluster_features, fit_clusters
from quizlake.sources.storage import settle

SEED = 42


def assemble(df: DataFrame, columns: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol="features").transform(df)


def probability(model, df: DataFrame, name: str) -> DataFrame:
    """Add the positive class probability of a classifier as a column."""
    made = model.transform(df)
    p = F.get(vector_to_array(F.col(model.getProbabilityCol())), F.lit(1))
    return made.select(*df.columns, p.alias(name))


def together(*jobs: Callable[[], object]) -> list:
    """Runs independent trainings at the same time: each is a chain of small jobs
    that wait for the driver, so they fill each other's gaps."""
    # each job gets its own copy of the session's properties: a shared one would be changed by all at once
    session = SparkSession.active()
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [done.result() for done in [pool.submit(inheritable_thread_target(session)(job)) for job in jobs]]


def stratified_folds(df: DataFrame, k: int, *keys: str, label: str = "label") -> DataFrame:
    """``df`` with ``_fold``: in each class the sizes of the folds differ by at most
    one.  Rows are ranked within their class by a hash of their key, without a
    window over a class: ranges of (class, hash) count their own rows, and the
    counts of the ranges before come from a table with a row per range and class."""
    key = F.struct(F.col(label).alias("c"), R.sample_key(SEED, *keys).alias("h"))
    placed = settle(df.withColumn("_k", key).repartitionByRange("_k").withColumn("_part", F.spark_partition_id()))
    counts = placed.groupBy(F.col("_k.c").alias("_c"), "_part").agg(F.count("*").alias("n"))
    lower = Window.partitionBy("_c").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_c", "_part", F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_part", "_k.c").orderBy("_k.h", *keys)) - 1
    ranked = placed.withColumn("_own", own).withColumn("_c", F.col("_k.c")).join(before, ["_c", "_part"])
    return ranked.withColumn("_fold", ((F.col("_before") + F.col("_own")) % k).cast("int")).select(*df.columns, "_fold")


# -- single classifiers ------------------------------------------------------------


def train_lr(train: DataFrame, c: float = 1.0, max_iter: int = 2000, weight: str | None = None):
    lr = LogisticRegression(
        regParam=1.0 / (c * train.count()), maxIter=max_iter, standardization=False
    )
    if weight:
        lr = lr.setWeightCol(weight)
    return lr.fit(train)


def train_nb(train: DataFrame):
    return NaiveBayes(modelType="gaussian").fit(train)


def train_rf(
    train: DataFrame, trees: int = 300, depth: int = 15, leaf: int = 5, weight: str | None = None
):
    rf = RandomForestClassifier(
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=leaf,
        featureSubsetStrategy="sqrt",
        seed=SEED,
    )
    if weight:
        rf = rf.setWeightCol(weight)
    return rf.fit(train)


@dataclass
class CalibratedSvm:
    """Linear SVMs, each with an isotonic map fitted on the fold it left out;
    the probability is the mean of the maps."""

    parts: list

    def probability(self, df: DataFrame, name: str) -> DataFrame:
        out, made = df, []
        for i, (svm, curve) in enumerate(self.parts):
            raw = svm.transform(out)
            margin = F.get(vector_to_array(F.col("rawPrediction")), F.lit(1))
            out = raw.select(*out.columns, margin.alias("margin"))
            out = curve.transform(out).withColumnRenamed("prediction", f"_p{i}").drop("margin")
            made.append(f"_p{i}")
        mean = sum((F.col(c) for c in made[1:]), F.col(made[0])) / len(made)
        clipped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), mean))
        return out.withColumn(name, clipped).drop(*made)


def train_svm_calibrated(train: DataFrame, keys: tuple[str, ...], folds: int = 3, max_iter: int = 5000, curve_rows: int = 200_000):
    """The curve of a fold is fitted on the unrounded margins of all its labelled
    rows.  A task pools a range of at most about ``curve_rows`` margins; only the blocks
    that ranges leave meet on the driver."""
    marked = settle(stratified_folds(train, folds, *keys))

    def part(i: int):
        rest = marked.where(F.col("_fold") != i)
        svm = LinearSVC(regParam=1.0 / rest.count(), maxIter=max_iter, tol=1e-4).fit(rest)
        margin = F.get(vector_to_array(F.col("rawPrediction")), F.lit(1))
        held = marked.where(F.col("_fold") == i)
        known = (
            svm.transform(held)
            .select(margin.alias("margin"), F.col("label").cast("double").alias("y"))
            .groupBy("margin")
            .agg(F.avg("y").alias("label"), F.count("*").cast("double").alias("weight"))
        )
        ranges = math.ceil(held.count() / curve_rows)
        curve = IsotonicRegression(featuresCol="margin", labelCol="label", weightCol="weight")
        return svm, curve.fit(known.repartition(ranges) if ranges > 1 else known)

    parts = together(*[lambda i=i: part(i) for i in range(folds)])
    return CalibratedSvm(parts)


def option_terms(questions: DataFrame) -> DataFrame:
    rows = R.explode_options(questions, ["row_id"])
    return rows.select(
        "row_id", "label", T.term_tokens(T.clean_text(F.col("option_text"))).alias("terms")
    )


# -- the verifier ---------------------------------------------------------------------------


@dataclass
class Verifier:
    vocab: DataFrame
    clusters: Clusters
    lr: object
    svm: CalibratedSvm
    rf: object
    nb: object

    def features(self, items: DataFrame) -> DataFrame:
        base = X.verifier_features(items, self.vocab)
        terms = items.select("row_id", F.inline("options")).select(
            "row_id", "label", T.term_tokens(T.clean_text(F.col("text"))).alias("terms")
        )
        joined = base.join(cluster_features(self.clusters, terms), ["row_id", "label"])
        return assemble(joined.drop("article_overlap"), V.VERIFIER_FEATURES)

    def votes(self, features: DataFrame) -> DataFrame:
        out = probability(self.lr, features, "p_lr")
        out = self.svm.probability(out, "p_svm")
        out = probability(self.rf, out, "p_rf")
        return out.withColumn("p", soft_vote(F.col("p_lr"), F.col("p_svm"), F.col("p_rf")))


    def scores(self, groups: DataFrame) -> DataFrame:
        """``(group_id, item, scores)`` of ``asked_groups``: the probabilities of the
        options in their order.  Clusters depend on the text of an option alone, so
        they are found once a text and article."""
        groups = settle(groups)
        texts = F.array_distinct(F.flatten(F.transform("asked", lambda x: F.transform(x["options"], lambda o: o["text"]))))
        terms = groups.select(F.col("group_id").alias("row_id"), F.explode(texts).alias("label")).withColumn(
            "terms", T.term_tokens(T.clean_text(F.col("label"))))
        kinds = cluster_features(self.clusters, terms).withColumnsRenamed({"row_id": "group_id", "label": "text"})
        rows = X.asked_features(groups, self.vocab).join(kinds, ["group_id", "text"])
        votes = self.votes(assemble(rows, V.VERIFIER_FEATURES))
        listed = F.sort_array(F.collect_list(F.struct("label", F.round("p", 9).alias("p"))))
        return votes.groupBy("group_id", "item").agg(F.transform(listed, lambda e: e["p"]).alias("scores"))


@dataclass
class CrossFitted:
    """Verifiers that judge only articles they were not trained on: the one at
    place ``i`` those of fold ``i``."""

    parts: list[Verifier]

    def scores(self, groups: DataFrame) -> DataFrame:
        groups = settle(groups)
        fold = article_fold(len(self.parts))
        return reduce(DataFrame.unionByName, [v.scores(groups.where(fold == i)) for i, v in enumerate(self.parts)])


def article_fold(k: int) -> Column:
    return R.bucket(F.coalesce("article", F.lit(""))) % k


def cross_fitted(questions: DataFrame, k: int = 2, trees: int = 300, depth: int = 15) -> CrossFitted:
    """Everything of a verifier, its vocabulary and clusters too, is learned without
    the articles of its fold."""
    fold = article_fold(k)
    fitted = together(*[lambda i=i: train_verifier(questions.where(fold != i), trees, depth)[0] for i in range(k)])
    return CrossFitted(fitted)


def asked_groups(rows: DataFrame, articles: DataFrame) -> DataFrame:
    """Questions ``(doc_id, candidate_index, question, answer_text, others)`` beside
    their article, as ``asked_features`` wants them.  The options of a question are
    its answer, then ``others``, then the fixed fillers.  What is collected are
    the questions of one article: those of its first answers."""
    numbered_options = F.transform(
        R.options_for_candidate(F.col("answer_text"), F.col("others")),
        lambda t, i: F.struct(i.alias("label"), t.alias("text")),
    )
    one = F.struct(F.col("candidate_index").alias("item"), "question", numbered_options.alias("options"))
    asked = rows.groupBy("doc_id").agg(F.collect_list(one).alias("asked"))
    return articles.select("doc_id", "article").join(asked, "doc_id").withColumnRenamed("doc_id", "group_id")


def with_verifier_scores(rows: DataFrame, articles: DataFrame, scores: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``rows`` (see ``asked_groups``) with the five verifier values of the ranker, 0
    where ``scores`` gives none: cross-fitted ones in training, those of the kept
    verifier in use."""
    made = scores(asked_groups(rows, articles)).select(
        F.col("group_id").alias("doc_id"), F.col("item").alias("candidate_index"), *X.score_columns(F.col("scores")))
    return rows.join(made, ["doc_id", "candidate_index"], "left").na.fill(0.0, V.RANKER_FEATURES[-5:])


def verifier_rows(questions: DataFrame) -> tuple[DataFrame, DataFrame, Clusters]:
    """All option rows with 12 features, label and split; the vocabulary and
    the clusters come from the training part only."""
    marked = R.split_two(questions, F.col("article"), 85)
    train = marked.where("split = 'train'")
    vocab = settle(K.vocabulary(K.question_documents(train)))
    clusters = fit_clusters(settle(option_terms(train)), vocab)
    base = X.verifier_features(X.option_items(questions), vocab)
    keyed = R.explode_options(marked, ["row_id", "split"]).select(
        "row_id", F.col("label").alias("option"), "split", F.col("is_correct").alias("label")
    )
    terms = cluster_features(clusters, option_terms(questions))
    joined = (
        base.join(terms, ["row_id", "label"])
        .withColumnRenamed("label", "option")
        .join(keyed, ["row_id", "option"])
    )
    rows = settle(joined.select("row_id", "option", "split", "label", *V.VERIFIER_FEATURES))
    return rows, vocab, clusters


def balanced_train(rows: DataFrame) -> DataFrame:
    train = rows.where("split = 'train'")
    return settle(R.balance_classes(train, "label", SEED, "row_id", "option"))


def train_verifier(questions: DataFrame, trees: int = 300, depth: int = 15) -> tuple[Verifier, DataFrame]:
    rows, vocab, clusters = verifier_rows(questions)
    train = assemble(balanced_train(rows), V.VERIFIER_FEATURES)
    keyed = train.select("row_id", "option", "label", "features")
    fitted = together(
        lambda: train_lr(train),
        lambda: train_svm_calibrated(keyed, ("row_id", "option")),
        lambda: train_rf(train, trees, depth),
        lambda: train_nb(train),
    )
    model = Verifier(vocab, clusters, *fitted)
    test = assemble(rows.where("split = 'test'"), V.VERIFIER_FEATURES)
    return model, probability(model.nb, model.votes(test), "p_nb")


def model_report(scored: DataFrame) -> DataFrame:
    """One row of counts and rates per model and for the vote."""
    names = [c for c in ("p_lr", "p_svm", "p_rf", "p_nb", "p") if c in scored.columns]
    parts = F.array(*[F.struct(F.lit(n).alias("model"), F.col(n).alias("score")) for n in names])
    rows = scored.select("label", F.inline(parts))
    counts = M.confusion(rows, "label", F.col("score") >= 0.5, "model")
    return M.binary_metrics(counts)


def cross_validation(train: DataFrame, keys: tuple[str, ...], k: int = 5) -> DataFrame:
    """F1 of a class-weighted logistic regression over ``k`` folds."""
    marked = settle(stratified_folds(train, k, *keys))

    def part(i: int) -> float:
        rest = class_weights(marked.where(F.col("_fold") != i))
        model = train_lr(rest, 0.5, 1000, "weight")
        scored = probability(model, marked.where(F.col("_fold") == i), "score")
        return M.binary_metrics(M.confusion(scored, "label", F.col("score") >= 0.5)).first()["f1"]

    found = together(*[lambda i=i: part(i) for i in range(k)])
    out = train.sparkSession.createDataFrame([(i, f) for i, f in enumerate(found)], "fold int, f1 double")
    return out.agg(F.avg("f1").alias("f1_mean"), F.stddev_pop("f1").alias("f1_std"), F.count("*").alias("folds"))


def class_weights(df: DataFrame) -> DataFrame:
    """Add ``weight`` so that both classes weigh the same."""
    total = df.agg(F.count("*")).scalar()
    positive = df.agg(F.count_if(F.col("label") == 1)).scalar()
    size = F.when(F.col("label") == 1, positive).otherwise(total - positive)
    return df.withColumn("weight", total / (F.lit(2.0) * F.greatest(size, F.lit(1))))


# -- question ranker and distractor ranker ---------------------------------------------------


def train_ranker(rows: DataFrame, trees: int = 400, depth: int = 14, leaf: int = 3):
    """``rows``: ranker training rows with ``article_id`` as the group of
    the split.  Returns the model and the scored test rows."""
    marked = settle(R.split_two(rows, F.col("article_id"), 80))
    train = assemble(class_weights(marked.where("split = 'train'")), V.RANKER_FEATURES)
    model = train_rf(train, trees, depth, leaf, "weight")
    test = assemble(marked.where("split = 'test'"), V.RANKER_FEATURES)
    return model, probability(model, test, "predicted")


def feature_importance(spark, model, names: list[str], top: int = 20) -> DataFrame:
    """The importances of a fitted model by name, the largest first."""
    pairs = [(n, float(x)) for n, x in zip(names, model.featureImportances.toArray())]
    return spark.createDataFrame(pairs, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    ).limit(top)


def train_distractor_ranker(rows: DataFrame, trees: int = 150, depth: int = 12):
    """``rows``: distractor training rows.  Returns both models and the scored
    test rows."""
    marked = settle(R.split_two(rows, F.concat_ws("-", "row_id", "option_id"), 80))
    train = assemble(marked.where("split = 'train'"), V.DISTRACTOR_FEATURES)
    forest, line = train_rf(train, trees, depth, 1), train_lr(train, 1.0, 1000)
    test = assemble(marked.where("split = 'test'"), V.DISTRACTOR_FEATURES)
    return forest, line, probability(line, probability(forest, test, "p_rf"), "p_lr")
