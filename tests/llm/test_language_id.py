import zlib

import numpy as np

from llm_fixtures import no_docs, odd_docs, sf_docs  # noqa: F401
from tessera.llm import language_id as I


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = I.identify(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_labels_and_sources_are_no_inputs(spark, sf_docs):
    """Other labels and sources in the held-out quarter change no prediction."""
    from pyspark.sql import functions as F

    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    other = sf_docs.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang"))).withColumn("source", F.lit(None).cast("string"))
    pick = lambda d: sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in I.identify(d).collect())
    assert pick(sf_docs) == pick(other)


def test_features_of_slices_add_up(monkeypatch):
    text = ("Ein Satz über Bären, " * 50 + "fin.").encode()
    whole = I.features(text)
    monkeypatch.setattr(I, "_SLICE", 17)
    assert (I.features(text) == whole).all() and I.features(b"12 !!") is None and I.features("é".encode()) is not None


def test_rejection_is_calibrated():
    rng = np.random.default_rng(1)
    logits = rng.normal(0, 1, (4000, 3))
    y = np.array([rng.choice(3, p=p) for p in I.softmax(logits / 0.5)])
    t, reject = I.calibrate(logits, y)
    p = I.softmax(logits / t)
    sure = p.max(axis=1) >= reject
    assert 0.4 < t < 0.62 and (p.argmax(axis=1) == y)[sure].mean() >= I.PRECISION


def test_odd_rows(odd_docs, no_docs):
    from pyspark.sql import functions as F

    got = I.identify(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in got}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (1, 2, 3, 7))
    assert by_id[4]["lang_pred"] in ("en", "de", "fr")
    assert I.identify(no_docs).count() == 0
    unlabelled = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in I.identify(unlabelled).collect()} == {"und"}


def test_every_language_is_learned(spark):
    """300 languages of four texts each: none is dropped for being rare, and sparse rows hold all counts."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(3)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    rows = []
    for k in range(300):
        words = ["".join(rng.choice(letters, 5)) for _ in range(12)]
        rows += [(4 * k + j, " ".join(rng.choice(words, 30)), f"l{k:03d}") for j in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = I.fit(docs, F.lit(True))
    assert model.languages == [f"l{k:03d}" for k in range(300)]
    assert {model.predict(t.encode())[0] for _, t, _ in rows} <= set(model.languages)
    counts = I.features(rows[0][1].encode())
    assert np.allclose(I.dense([I.sparse(counts)])[0], counts / counts.sum())
