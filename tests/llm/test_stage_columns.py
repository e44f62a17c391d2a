"""Every pipeline stage over tables whose extra columns have hostile names."""

import sys

import pytest

sys.path.insert(0, ".")
import corpus_pipeline  # noqa: E402

SMALL = "/root/testdata/sf0.001"
NAMES = ["__name", "__key", "__bad", "__id", "__n1", "__n2", "__stays", "__kept", "a.b", "row", "first", "n", "component", "x y", "`q", "part", "sid"]


@pytest.fixture(scope="module")
def hostile(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(*r, *(f"{r.doc_id}-{n}" for n in NAMES)) for r in docs.collect()]
    rows += [(*rows[0][:5], *("other" for _ in NAMES)), rows[0], (None, rows[1][1], *rows[1][2:]), (None, None, *rows[2][2:])]
    names = ", ".join("`" + n.replace("`", "``") + "` string" for n in NAMES)
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {names}")


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stage_keeps_all_columns_as_they_were(spark, hostile, name):
    kept = dict(corpus_pipeline.STAGES)[name](spark, hostile, SMALL)
    assert kept.columns == hostile.columns
    got, given = [tuple(r) for r in kept.collect()], [tuple(r) for r in hostile.collect()]
    assert 0 < len(got) <= len(given) and set(got) <= set(given)


def test_the_mix_reads_only_what_it_needs(spark, hostile):
    mixed = dict(corpus_pipeline.STAGES)["mix"](spark, hostile, SMALL)
    assert mixed.count() == hostile.count()


def test_equal_names_keep_one_row_by_rule(spark):
    from strata.llm.exact_dedup import deduplicated

    rows = [(1, "a b", "x"), (1, "ab ", "y"), (1, "a b", "z"), (2, "ab", "w"), (None, "c", "p"), (None, "c", "q"), (3, None, "r"), (4, "", "s")]
    kept = [sorted((tuple(r) for r in deduplicated(spark.createDataFrame(rows, "doc_id long, text string, other string").repartition(n)).collect() if r[1]), key=repr) for n in (1, 5)]
    assert kept[0] == kept[1] and len(kept[0]) == 2


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_of_an_empty_table(spark, name):
    empty = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    assert dict(corpus_pipeline.STAGES)[name](spark, empty, SMALL).count() == 0
