from llm_fixtures import no_docs, odd_docs  # noqa: F401
import corpus_pipeline as C
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SF2 = "/root/testdata/sf0.01"


def test_stages_in_order():
    assert [n for n, _ in C.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "decontamination", "mixing"]


def test_stage_by_stage(spark):
    """Each stage does its operator's work on what is left; clean documents stay."""
    docs = spark.read.parquet(f"{SF2}/documents.parquet")
    labels = spark.read.parquet(f"{SF2}/labels.parquet")
    left = [docs]
    for _, stage in C.STAGES:
        left.append(C.materialize(stage(spark, left[-1], SF2), "test"))
    counts = [d.count() for d in left]
    assert counts == sorted(counts, reverse=True) and counts[-1] == counts[-2] > 0.6 * counts[0]
    for d in left[1:-1]:
        assert d.columns == docs.columns
    from tessera.llm import decontaminate, quality_rules, simhash

    judged = quality_rules.judge_documents(docs).filter("kept").select("doc_id")
    assert sorted(r[0] for r in judged.collect()) == sorted(r[0] for r in left[1].select("doc_id").collect())
    good = labels.filter("quality = 1").join(docs.filter(F.size(F.split(F.trim("text"), r"\s+")) >= 20), "doc_id", "left_semi")
    assert good.join(left[1], "doc_id", "left_anti").count() <= 0.02 * good.count()
    groups = simhash.near_duplicates(left[2]).select("component_id").distinct().count()
    assert counts[3] == groups == simhash.near_duplicates(left[3]).select("component_id").distinct().count()
    assert decontaminate.contaminated_pairs(left[4], spark.read.parquet(f"{SF2}/benchmark.parquet")).count() == 0
    assert sorted(r[0] for r in left[5].select("mix_position").collect()) == list(range(counts[5]))


def test_run_and_odd_rows(spark, odd_docs, no_docs):
    assert C.run(spark, SF).count() > 0
    for docs in (odd_docs, no_docs):
        for _, stage in C.STAGES:
            docs = C.materialize(stage(spark, docs, SF), "test")
            assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]


def test_registered_only_while_present(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {"pipeline", *(f"op{n}_" for n in range(1, 11))} <= {x if x == "pipeline" else x.split("_")[0] + "_" for x in names}
    assert set(entry.oracle_sql()) <= names
