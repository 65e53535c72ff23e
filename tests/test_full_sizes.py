"""Registered runs and operators work on the whole job, not on a part of it."""

from pyspark.ml.classification import RandomForestClassifier

from quizlake.catalog import QUERIES
from quizlake.operators import reshape as R, retrieval as RT


def test_registered_forests_have_the_full_sizes(spark, folder, monkeypatch):
    seen = []
    fit = RandomForestClassifier.fit

    def small(forest, rows, params=None):
        seen.append((forest.getNumTrees(), forest.getMaxDepth()))
        return fit(forest.copy().setNumTrees(2).setMaxDepth(2), rows)

    monkeypatch.setattr(RandomForestClassifier, "fit", small)
    for name in ("train_rf", "train_ranker", "train_distractor_ranker"):
        QUERIES[name](spark, folder)
    assert seen == [(300, 15), (400, 14), (150, 12)]


def test_all_training_pairs_by_default(spark):
    rows = [(str(i), "A text.", "Where is it?" if i % 2 else "It is?", "here") for i in range(41_000)]
    df = spark.createDataFrame(rows, "row_id string, article string, question string, correct_answer string")
    assert R.seq2seq_rows(df).count() == 20_500
    few = [r["row_id"] for r in R.seq2seq_rows(df, 100, 42).collect()]
    wanted = R.sample_rows(df.where("question like 'W%'"), 100, 42, "row_id").collect()
    assert sorted(few) == sorted(r["row_id"] for r in wanted)


def test_queries_with_few_hits_are_filled_up(spark):
    words = [f"w{i:02d}" for i in range(20)]
    rows = [(f"r{i:02d}", w, w, "term" if i < 10 else "date", w) for i, w in enumerate(words)]
    rows += [("s", "w00", "w00", "term", "w00"), ("u", "aa", "aa", "date", "unknown")]
    records = spark.createDataFrame(rows, "opt_id string, text string, option_key string, option_category string, document string")
    vocab = spark.createDataFrame([(w, 1, 1.0) for w in words], "term string, df long, idf double")
    asked = [("few", "w03 w15", ["date"]), ("none", "nothing known", ["date"]), ("wide", "w01", ["term", "date"])]
    queries = spark.createDataFrame(asked, "q_id string, query_text string, categories array<string>")
    for k in (4, 15, 50):
        got = {}
        for r in RT.retrieve(queries, records, vocab, k, fill=True).collect():
            got.setdefault(r.q_id, []).append((-r.score, r.option_category != "date", r.option_key))
        keys = {q: [x[2] for x in sorted(found)] for q, found in got.items()}
        inside, outside = ["aa", *words[10:]], words[:10]
        hits = ["w15", "w03"]
        few = [w for w in inside + outside if w not in hits]
        assert sorted(keys["few"]) == sorted((hits + few)[:k])
        assert keys["none"] == (inside + outside)[:k]
        assert sorted(keys["wide"]) == sorted(["w01", *[w for w in ["aa", *words] if w != "w01"]][:k])
