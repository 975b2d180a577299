"""The pipeline: each stage on its predecessor's output, whole and without harm to clean documents."""

import pytest

import corpus_pipeline
from test_near_duplicates import brute
from test_tokens import BYTE, check_packing

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_columns_and_rows(stages):
    docs = stages[0]
    rows = {tuple(r) for r in docs.collect()}
    for df in stages[1:4]:
        assert df.columns == docs.columns
        got = [tuple(r) for r in df.collect()]
        assert set(got) <= rows and len(set(got)) == len(got)
        rows = set(got)


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1].collect()}
    clean = [d for d, t in labels.items() if not t]
    assert sum(d in kept for d in clean) / len(clean) > 0.98
    insult = [r.doc_id for r in stages[0].where("lower(text) rlike '(idiot|scum|moron|pathetic).*(loser|trash|clown|stupid|worthless|disgusting)'").collect()]
    assert insult and sum(d in kept for d in insult) / len(insult) < 0.2


def test_languages_are_kept(stages):
    assert stages[2].count() >= 0.99 * stages[1].count()


def test_one_document_of_each_group(stages):
    rows = [(r.doc_id, r.text) for r in stages[2].select("doc_id", "text").collect()]
    want = {c for _, c in brute(rows, 5, 80).values()}
    assert {r.doc_id for r in stages[3].collect()} == want


def test_packed_tokens(stages):
    from tokenizers import Tokenizer

    docs = stages[3].collect()
    ids = Tokenizer.from_file(BYTE).encode_batch([r.text for r in docs], add_special_tokens=False)
    assert check_packing(stages[4].collect(), {r.doc_id: [*e.ids, 0] for r, e in zip(docs, ids)}) == 0


def test_run_equals_the_stages(spark, stages):
    pick = ("doc_id", "start", "length", "ids_crc32")
    whole = corpus_pipeline.run(spark, SF)
    assert sum(r.length for r in whole.collect()) == sum(r.length for r in stages[4].collect())
    assert {r.doc_id for r in whole.select(*pick).collect()} == {r.doc_id for r in stages[4].collect()}


def test_odd_rows_pass_every_stage(spark, tmp_path):
    rows = [(1, None, None, None, None), (None, "the word", "en", "s", 3), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, "12", "de", "s", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (df, df.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == df.columns
            out.collect()
        corpus_pipeline.pack(spark, docs, str(tmp_path)).collect()
