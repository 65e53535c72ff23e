"""Model queries: trained models have no SQL, their parts do."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from quizlake.catalog.corpora import ranker_rows
from quizlake.catalog.registry import query
from quizlake.catalog.tables import usable
from quizlake.functions import values as V
from quizlake.operators import corpus as K, features as X, metrics as M, retrieval as RT
from quizlake.plans import model_quizzes as MQ, models as ML, store as ST
from quizlake.sources import storage, tables as S


def _train_rows(spark, folder):
    rows, _, _ = storage.once(
        spark, "verifier_rows", folder, lambda: ML.verifier_rows(usable(spark, folder))
    )
    balanced = storage.once(spark, "balanced", folder, lambda: ML.balanced_train(rows))
    train = ML.assemble(balanced, V.VERIFIER_FEATURES)
    return train, ML.assemble(rows.where("split = 'test'"), V.VERIFIER_FEATURES)


@query("train_lr")
def train_lr(spark, folder):
    train, test = _train_rows(spark, folder)
    return ML.model_report(ML.probability(ML.train_lr(train), test, "p_lr"))


@query("train_svm_calibrated")
def train_svm_calibrated(spark, folder):
    train, test = _train_rows(spark, folder)
    model = ML.train_svm_calibrated(train.select("row_id", "option", "label", "features"), ("row_id", "option"))
    return ML.model_report(model.probability(test, "p_svm"))


@query("train_rf")
def train_rf(spark, folder):
    train, test = _train_rows(spark, folder)
    return ML.model_report(ML.probability(ML.train_rf(train), test, "p_rf"))


@query(
    "train_nb",
    """select label, count(*) as n_rows, round(avg(edit_distance), 6) as mean_edit_distance,
       round(var_pop(edit_distance), 6) as var_edit_distance, round(avg(length_difference), 6) as mean_length_difference,
       round(var_pop(length_difference), 6) as var_length_difference from v_drows group by label""",
)
def train_nb(spark, folder):
    """The parameters of a Gaussian model of the distractor rows: the mean and
    variance of each feature per class, as MLlib fits them."""
    rows = storage.settle(X.distractor_training_rows(usable(spark, folder)))
    names = ["edit_distance", "length_difference"]
    model = ML.train_nb(ML.assemble(rows, names))
    counts = rows.groupBy("label").agg(F.count("*").alias("n_rows"))
    theta, sigma = model.theta.toArray(), model.sigma.toArray()
    by_class = lambda m, j: F.when(F.col("label") == 0, F.lit(float(m[0][j]))).otherwise(F.lit(float(m[1][j])))
    return counts.select(
        "label",
        "n_rows",
        *[F.round(by_class(theta, j), 6).alias(f"mean_{n}") for j, n in enumerate(names)],
        *[F.round(by_class(sigma, j), 6).alias(f"var_{n}") for j, n in enumerate(names)],
    )


def trained_verifier(spark, folder):
    return storage.once(
        spark, "verifier", folder, lambda: ML.train_verifier(usable(spark, folder))
    )


@query("train_verifier")
def train_verifier(spark, folder):
    _, scored = trained_verifier(spark, folder)
    scored = storage.settle(scored.drop("features"))
    mcq = M.mcq_accuracy(scored, "row_id", "option", "label", "p").select("accuracy").scalar()
    return ML.model_report(scored).withColumn("mcq_accuracy", mcq)


@query("cross_validation")
def cross_validation(spark, folder):
    train, _ = _train_rows(spark, folder)
    return ML.cross_validation(train.select("row_id", "option", "label", "features"), ("row_id", "option"))


@query("cluster_features")
def cluster_features(spark, folder):
    """Cluster and distance of every option; vocabulary, axes and centers are fitted on the same rows."""
    rows = usable(spark, folder)
    vocab = storage.settle(K.vocabulary(K.question_documents(rows)))
    terms = storage.settle(ML.option_terms(rows))
    return ML.cluster_features(ML.fit_clusters(terms, vocab), terms)


_CENTERS = [[0.05] * 64, [-0.05] * 64]


@query(
    "cluster_assignment",
    """
    select vec_id, case when d0 <= d1 then 0.0::double else 1.0::double end as kmeans_cluster_label,
      round(least(d0, d1), 6) as kmeans_centroid_dist
    from (select vec_id, sqrt(list_sum(list_transform(embedding, lambda x: (x::double - 0.05::double) * (x::double - 0.05::double)))) as d0,
            sqrt(list_sum(list_transform(embedding, lambda x: (x::double + 0.05::double) * (x::double + 0.05::double)))) as d1
          from embeddings)""",
)
def cluster_assignment(spark, folder):
    v = S.table(spark, folder, "embeddings").select("vec_id", "embedding")
    made = ML.assign_centers(v, F.col("embedding"), _CENTERS)
    return made.select(
        "vec_id", "kmeans_cluster_label", F.round("kmeans_centroid_dist", 6).alias("kmeans_centroid_dist")
    )


def _ranker(spark, folder):
    return storage.once(spark, "ranker", folder, lambda: _trained_ranker(spark, folder))


def _trained_ranker(spark, folder):
    article = usable(spark, folder).select(F.col("row_id").alias("group_id"), F.md5("article").alias("article_id"))
    rows = ranker_rows(spark, folder).join(article, "group_id")
    keep = ["group_id", "article_id", "candidate_index", "template", "target", "label"]
    rows = storage.settle(rows.select(*keep, *V.RANKER_FEATURES))
    return ML.train_ranker(rows)


@query("train_ranker")
def train_ranker(spark, folder):
    _, scored = _ranker(spark, folder)
    scored = storage.settle(scored.drop("features"))
    binary = M.binary_metrics(M.confusion(scored, "label", F.col("predicted") >= 0.5))
    auc = M.roc_auc(scored, "label", "predicted").scalar()
    ranking = M.ranking_metrics(scored)
    out = binary.withColumn("roc_auc", auc)
    for name in ("n_groups", "top1_match", "chosen_mean_target", "oracle_mean_target"):
        out = out.withColumn(name, ranking.select(name).scalar())
    return out


@query("feature_importance")
def feature_importance(spark, folder):
    model, _ = _ranker(spark, folder)
    return ML.feature_importance(spark, model, V.RANKER_FEATURES)


def _distractor_ranker(spark, folder):
    train = lambda: ML.train_distractor_ranker(storage.settle(X.distractor_training_rows(usable(spark, folder))))
    return storage.once(spark, "distractor_ranker", folder, train)


@query("train_distractor_ranker")
def train_distractor_ranker(spark, folder):
    return ML.model_report(_distractor_ranker(spark, folder)[2])


def _labelled_ranker_rows(spark, folder):
    return storage.once(spark, "labelled_ranker_rows", folder, lambda: ranker_rows(spark, folder).select(
        "group_id", "candidate_index", "template", "question", "target", "label"))


def model_store(spark, folder):
    """All models, trained at the same time, in one version of a store."""

    def build():
        path = storage.new_folder(spark, "models")
        (verifier, votes), (ranker, scored), (forest, _, pairs) = ML.together(
            lambda: trained_verifier(spark, folder),
            lambda: _ranker(spark, folder),
            lambda: _distractor_ranker(spark, folder),
        )
        rows = _labelled_ranker_rows(spark, folder)
        thresholds = (V.POSITIVE_THRESHOLD, V.NEGATIVE_THRESHOLD)
        about = ST.ranker_metadata(rows, ranker, storage.settle(scored.drop("features")), V.RANKER_FEATURES, *thresholds)
        reports = {
            "verifier": _report(votes),
            "distractor_ranker": _report(pairs),
        }
        ST.save(ST.ModelSet(verifier, ranker, forest), path, {"question_ranker": about} | reports)
        return path

    return storage.once(spark, "model_store", folder, build)


def _report(scored):
    rows = ML.model_report(storage.settle(scored.drop("features"))).collect()  # one row a model
    return {r["model"]: {k: round(x, 6) if isinstance(x, float) else x for k, x in r.asDict().items() if k != "model"} for r in rows}


@query("write_models")
def write_models(spark, folder):
    """The store written and read back: votes of the loaded models against those of
    the trained ones, on every test row."""
    verifier, votes = trained_verifier(spark, folder)
    ranker, scored = _ranker(spark, folder)
    forest, _, pairs = _distractor_ranker(spark, folder)
    again = ST.load(spark, model_store(spark, folder))

    def compared(name, rows, trained, loaded):
        return rows.agg(
            F.lit(name).alias("model"), F.count("*").alias("n_rows"), F.count_if(F.abs(F.col(trained) - F.col(loaded)) < 1e-12).alias("n_equal"))

    test = votes.withColumnsRenamed({c: f"own_{c}" for c in ("p_lr", "p_svm", "p_rf", "p")})
    voted = storage.settle(again.verifier.votes(test).drop("features"))
    out = [compared(c, voted, f"own_{c}", c) for c in ("p_lr", "p_svm", "p_rf", "p")]
    out.append(compared("question_ranker", ML.probability(again.ranker, scored, "loaded"), "predicted", "loaded"))
    out.append(compared("distractor_ranker", ML.probability(again.distractor_ranker, pairs, "loaded"), "p_rf", "loaded"))
    terms = verifier.vocab.withColumnRenamed("idf", "own").join(again.verifier.vocab.select("term", "idf"), "term", "left")
    out.append(compared("vocabulary", terms, "own", "idf"))
    return reduce(DataFrame.unionByName, out)


@query("write_metadata")
def write_metadata(spark, folder):
    """The metadata of the store as rows (model, name, value), and the length of
    the preview that is written beside it as CSV."""
    path = model_store(spark, folder)
    about = ST.metadata(spark, path)
    ranker = about["question_ranker"]
    plain = [("question_ranker", k, float(v)) for k, v in ranker.items() if isinstance(v, (int, float))]
    plain += [("question_ranker", f"{part}.{k}", float(v)) for part in ("binary_metrics", "ranking_metrics") for k, v in ranker[part].items()]
    plain += [("question_ranker", f"importance.{x['feature']}", x["importance"]) for x in ranker["top_importances"]]
    plain += [("question_ranker", "n_features", float(len(ranker["feature_names"])))]
    plain += [(name, f"{m}.{k}", float(v)) for name in ("verifier", "distractor_ranker") for m, r in about[name].items() for k, v in r.items()]
    preview = f"{path}/preview-{storage.version_name()}"
    storage.write_csv(_labelled_ranker_rows(spark, folder).orderBy("group_id", "candidate_index").limit(1000), preview)
    lines = spark.read.csv(preview, header=True, multiLine=True, escape='"').count()
    return spark.createDataFrame([*plain, ("question_ranker", "n_preview", float(lines))], "model string, name string, value double")


def quiz_index(spark, folder):
    """The retrieval index of the corpus, stored beside the models."""

    def build():
        path = storage.new_folder(spark, "index")
        vocab = trained_verifier(spark, folder)[0].vocab
        RT.store_index(K.corpus_records(usable(spark, folder)), vocab, path, fill=V.RETRIEVAL_LIMIT)
        return path

    return RT.load_index(spark, storage.once(spark, "quiz_index", folder, build))


@query("build_quizzes")
def build_quizzes(spark, folder):
    models = ST.load(spark, model_store(spark, folder))
    quizzes = MQ.build_quizzes(
        S.passages(spark, folder), quiz_index(spark, folder), models.verifier, models.ranker, models.distractor_ranker
    )
    return quizzes.select(
        "doc_id",
        "question",
        "correct_answer",
        "correct_label",
        F.array_join("options", " | ").alias("options"),
        F.array_join("hints", " | ").alias("hints"),
        "option_quality",
        "n_considered",
        "fallback_used",
        F.array_join(F.transform("selected", lambda e: F.concat_ws(": ", e["quality"], e["text"])), " | ").alias("selected"),
        "predicted_label",
        "predicted_answer",
        "verifier_matches",
    )
