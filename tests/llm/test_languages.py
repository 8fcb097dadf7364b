"""Problem 8: held-out accuracy, label spellings, mixed and wordless texts."""

import pickle

import numpy as np

import pytest
from pyspark.sql import functions as F

from millrace.llm import languages as L

SCHEMA = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def model(spark, sf):
    return L.fit(spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet"))


@pytest.fixture(scope="module")
def examples(spark):
    """Plainly labelled texts of another table than the model was fitted on, a language's script and words checked."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("n_chars between 200 and 600").select("text", L.label_code(F.col("lang")).alias("code")).where("code is not null")
    return [(r.text, r.code) for r in docs.limit(1500).collect()]


def test_labels(spark):
    rows = [("en", "en"), ("EN", "en"), ("en-US", "en"), ("English", "en"), ("eng", "en"), ("fr_FR", "fr"), (" German ", "de"), ("zh-CN", "zh"), ("und", None), ("mul", None), ("", None), ("?", None), ("xx", None), (None, None), ("engine", None)]
    got = spark.createDataFrame(rows, "lang string, code string").select("lang", "code", L.label_code(F.col("lang")).alias("got")).collect()
    assert [(r.lang, r.got) for r in got] == [(r.lang, r.code) for r in got]


def test_held_out_accuracy(model, examples):
    found = L.judge(pickle.loads(pickle.dumps(model)), [t for t, _ in examples])
    agree = sum(f[0] == code for f, (_, code) in zip(found, examples)) / len(examples)
    assert agree > 0.88  # about a tenth of the labels is wrong
    assert all(0 <= f[1] <= 1 for f in found)


EN = "The planner guarded the shared cache in the second run. Every review gate measured the old policy file before the release. "
FR = "L'équipe vérifie les anciennes règles après la troisième étape. Le contrôle compare le deuxième essai pour les petits groupes. "
JA = "小さな組織のために各セッションが要点のまとめを繰り返す。夜間の実行は新しい依頼のたびに長い出力を確認する。"


def found(spark, model, rows, schema=SCHEMA):
    return sorted((r.doc_id, r.lang) for r in L.languages_found(spark.createDataFrame(rows, schema), model=model).collect())


def test_cases(spark, model):
    rows = [
        (1, EN, "en"), (2, EN, "English"), (3, EN, None), (4, EN, "fr"), (5, FR, "und"), (6, EN + JA + EN, "en"), (7, EN + "\n\n" + FR, "mul"), (8, JA, "ja-JP"),
        (9, EN + "They call it “le deuxième essai”. " + EN, "en"), (10, None, None), (11, "", "xx"), (12, " \n", None), (13, "🚀🚀", None), (14, "x = f(y)\nreturn x", None), (15, "123 456 789 1011 12", None),
        (16, EN * 3000, "de"), (17, FR, "nl"), (17, FR, "nl"),
    ]
    assert found(spark, model, rows) == [(3, "en"), (4, "en"), (5, "fr"), (6, "en"), (6, "ja"), (7, "en"), (7, "fr"), (16, "en"), (17, "fr"), (17, "fr")]
    clash = [(1, EN, "en", "k", 0.5, "p"), (3, EN, None, "k", 0.5, "p")]
    assert found(spark, model, clash, SCHEMA + ", key string, confidence double, language string") == [(3, "en")]


def test_too_little_to_learn_from(spark):
    assert found(spark, None, []) == []
    assert found(spark, None, [(1, EN, None), (2, EN, "en")]) == []


def test_long_words_are_read_whole():
    assert len(L.subwords("x" * 1000)) > 2900
    assert not np.array_equal(L.subwords("a" * 80 + "b" * 80), L.subwords("a" * 80 + "c" * 80))


def test_threshold_keeps_wrong_answers_near_the_noise_of_the_labels():
    class Fixed(L.Classifier):
        def __init__(self, logits):
            self.codes, self.values, self.temperature, self.threshold = ["a", "b"], logits, 1.0, 0.0

        def logits(self, texts):
            return self.values

    rng = np.random.default_rng(5)
    margin = rng.uniform(0, 8, 4000)
    right = rng.random(4000) < 0.97 / (1 + np.exp(-margin * 0.8))  # three of a hundred labels are wrong
    model = Fixed(np.stack([margin, np.zeros(4000)], axis=1))
    L.calibrate(model, [["x"]] * 4000, np.where(right, 0, 1))
    sure = model.confidence(model.values).max(axis=1)
    kept = sure >= model.threshold
    assert 0.5 < kept.mean() < 1 and (~right[kept]).mean() < (~right[sure >= np.median(sure)]).mean() + 2 * L.SLACK
