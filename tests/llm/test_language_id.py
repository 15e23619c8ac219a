from pyspark.sql import functions as F

from logcube.llm import language_id as li
from tests.llm.conftest import AWKWARD


def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def test_held_out_accuracy_and_few_rejections(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = li.train(docs, ~held_out())
    assert model.languages == ["de", "en", "es", "fr"]
    held = docs.where(held_out()).select("doc_id", "lang")
    rows = held.join(li.identify(docs, model), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    again = li.train(docs.repartition(5), ~held_out())
    assert (again.scores == model.scores).all() and again.threshold == model.threshold


def test_awkward_rows(spark, awkward, empty):
    model = li.train(awkward, F.lit(True))
    rows = li.identify(awkward, model).collect()
    assert len(rows) == len(AWKWARD)
    undetermined = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert undetermined == {2, 3, 4, 7}  # NULL, empty, blank, no letter
    assert all(r.rejected and r.score == 0 for r in rows if r.lang_pred == "und")
    kept = li.accepted(awkward, model)
    assert kept.columns == awkward.columns and kept.where("doc_id = 7").count() == 0
    assert li.identify(empty, model).count() == 0
    nothing = li.train(empty, F.lit(True))
    assert {r.lang_pred for r in li.identify(awkward, nothing).collect()} == {"und"}


def test_rejection_is_calibrated():
    import numpy as np

    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 4000)
    sure = rng.random(4000) < 0.7
    logits = np.where(sure, 6.0, 0.3)[:, None] * np.eye(2)[np.where(sure, y, rng.integers(0, 2, 4000))]
    temperature, threshold = li._calibrated(logits, y, 0.02)
    score = li._softmax(logits / temperature).max(1)
    assert score[~sure].max() < threshold <= score[sure].min()
    assert li._calibrated(logits[sure], y[sure], 0.02)[1] == 0.0


def test_unlearnt_languages_and_noise_are_rejected(spark):
    import random
    import string

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = random.Random(5)
    clean = [r.text for r in docs.where(held_out() & (F.col("lang") == "en") & (F.length("text") > 200)).limit(60).collect()]
    letters = string.ascii_lowercase + "   "
    odd = {
        "keys": ["".join(rng.choices("asdfghjkl;qwertyuiop ", k=300)) for _ in range(50)],
        "random": ["".join(rng.choices(letters, k=300)) for _ in range(50)],
        "base64": ["".join(rng.choices(string.ascii_letters + string.digits + "+/", k=300)) for _ in range(50)],
        "shuffled": ["".join(rng.sample(t, len(t))) for t in clean],
        "chinese": ["".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(100)) for _ in range(50)],
    }
    model = li.train(docs, ~held_out())
    for kind, texts in odd.items():
        assert sum(model.predict(t)[2] for t in texts) >= 0.95 * len(texts), kind
    assert sum(model.predict(t)[2] for t in clean) <= 0.02 * len(clean)
    for left_out in ("de", "fr"):
        model = li.train(docs, ~held_out() & (F.col("lang") != left_out))
        rows = docs.where(held_out() & (F.length("text") > 200)).select("doc_id", "lang").join(li.identify(docs, model), "doc_id").collect()
        unlearnt = [r.rejected for r in rows if r.lang == left_out]
        learnt = [r.rejected for r in rows if r.lang != left_out]
        assert sum(unlearnt) >= 0.9 * len(unlearnt) > 0, left_out
        assert sum(learnt) <= 0.02 * len(learnt), left_out


def test_limit_of_rare_subwords():
    import numpy as np

    own, others = np.array([-3.0, 0.0, 1.0]), np.array([-20.0, -11.0, -9.0])
    lowest = np.quantile(own, li.MAX_ODD)
    assert abs(li._limit(own, others) - (lowest - 11) / 2) < 1e-12
    assert li._limit(own, np.array([2.0])) == lowest  # no text is odd in another language
    assert li._limit(own, np.array([])) == li.ONE_LANGUAGE and li._limit(np.array([-11.0]), np.array([])) == -11.0
