import corpus_pipeline
import pytest
from helpers import documents, words
from test_line_dedup import brute as brute_lines
from test_simhash import classes, plain

from compare import connect, difference
from tidewell.llm.oracle import ORACLE
from tidewell.llm.queries import QUERIES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returned, the input first."""
    folder, sf_dir = tmp_path_factory.mktemp("stages"), "/root/testdata/sf0.001"
    frames = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frames[-1], sf_dir).write.parquet(f"{folder}/{k}")
        frames.append(spark.read.parquet(f"{folder}/{k}"))
    return frames


def texts(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_columns_and_lengths(stages):
    for frame in stages[1:-1]:
        assert frame.columns == COLUMNS
        assert frame.filter("n_chars <> length(text)").count() == 0


def test_quality_stage_keeps_documents_whole(stages):
    before, after = texts(stages[0]), texts(stages[1])
    assert set(after) < set(before)
    assert all(before[i] == t for i, t in after.items())
    assert all(len(words(t)) >= 50 for t in after.values())


def test_line_stage_agrees_with_brute_force(stages):
    before, after = texts(stages[1]), texts(stages[2])
    assert set(before) == set(after)
    n_lines = {d: n - gone for d, n, gone, _ in brute_lines(list(before.items()))}
    assert all((len(t.split("\n")) if t else min(1, n_lines[d])) == n_lines[d] for d, t in after.items())


def test_near_dedup_stage_keeps_one_of_each_group(stages):
    rows = sorted(texts(stages[2]).items())
    of = classes([plain(t) for _, t in rows], 4)
    first = {}
    for (doc, _), c in zip(rows, of):
        first.setdefault(c, doc)
    assert set(texts(stages[3])) == set(first.values())


def test_mixing_stage_only_takes_words_of_its_documents(stages):
    before = texts(stages[3])
    rows = stages[4].collect()
    assert {r.doc_id for r in rows} <= set(before)
    for r in rows:
        assert set(words(r.text)) <= set(words(before[r.doc_id]))
    n_before, n_after = (sum(len(words(r.text)) for r in f.collect()) for f in (stages[3], stages[4]))
    assert 1.3 * n_before < n_after < 1.7 * n_before


def test_last_stage_gives_texts_back(stages):
    assert stages[5].count() == stages[4].count()
    assert stages[5].filter("NOT decoded_alike OR size(ids) = 0").count() == 0


def test_awkward_rows_pass_through_every_stage(spark, sf_dir):
    docs = documents(spark, clashing=False).selectExpr("*", "length(text) AS n_chars")
    for _, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, docs, sf_dir)
        assert out.count() > 0
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_agree_with_their_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE[name]) is None


def test_every_operator_is_registered():
    import __spark_entry__

    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
