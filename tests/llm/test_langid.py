import pytest
from pyspark.sql import functions as F

from nearfold.llm.common import id_crc
from nearfold.llm.langid import (
    UNDETERMINED, Classifier, drop_unidentified, fit_dictionaries, identify, letters_only,
)
from tests.llm.helpers import AWKWARD, awkward, table


@pytest.fixture(scope="module")
def trained(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    return docs, fit_dictionaries(docs.where(id_crc() % 4 != 2))


def test_held_out_accuracy(trained):
    docs, dictionaries = trained
    assert set(dictionaries) == {"en", "de", "fr", "es"}
    found = identify(docs, dictionaries).toPandas().set_index("doc_id")
    truth = docs.where(id_crc() % 4 == 2).select("doc_id", "lang").toPandas()
    joined = truth.join(found, on="doc_id")
    assert (joined.lang == joined.lang_pred).mean() > 0.97
    kept = joined[~joined.rejected]
    assert (kept.lang == kept.lang_pred).mean() > 0.985 and len(kept) > 0.97 * len(joined)
    assert joined.score.between(0, 1).all()


def test_sample_is_bounded(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    few = fit_dictionaries(docs, sample_rows=5, excerpt_chars=40)
    assert all(len(d) <= 5 * 41 * 2 for d in few.values())


def test_sizes_cover_whole_texts(trained):
    classifier = Classifier(trained[1])
    once = classifier.sizes("a longer text " * 100).sum()
    assert classifier.sizes("a longer text " * 100_000).sum() > 500 * once


def test_letters_only():
    assert letters_only("Ab1c!! <b>É") == "ab c b é".encode()


def test_awkward_rows(spark, trained):
    rows = identify(awkward(spark), trained[1]).collect()
    assert len(rows) == len(AWKWARD)
    for (_, text, *_), row in zip(AWKWARD, rows, strict=True):
        assert (row.lang_pred == UNDETERMINED) == (not any(c.isalpha() for c in text or ""))
        assert row.lang_pred != UNDETERMINED or (row.score == 0 and row.rejected)
    assert identify(awkward(spark).limit(0), trained[1]).count() == 0
    assert {r.lang_pred for r in identify(awkward(spark), {}).collect()} == {UNDETERMINED}


def test_labels_missing(spark):
    unlabelled = awkward(spark).withColumn("lang", F.lit(None).cast("string"))
    assert fit_dictionaries(unlabelled) == {}


def test_filter_keeps_columns_and_clear_texts(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    kept = drop_unidentified(docs)
    assert kept.columns == docs.columns
    missing = docs.join(kept, "doc_id", "left_anti").collect()
    assert all(r.n_chars < 40 for r in missing) and len(missing) < 20
    kept = drop_unidentified(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert not {2, 3, 4, 8} & {r.doc_id for r in kept.collect()}


def test_many_copies_do_not_displace_a_language(spark):
    """20,000 copies of one page: the other texts of its language are learned all the same."""
    import random

    draw = random.Random(2)
    english = ["".join(draw.choices("abcdefghij ", k=300)) for _ in range(300)]
    german = ["".join(draw.choices("klmnopqrst ", k=300)) for _ in range(300)]
    rows = [(t, "en") for t in english] + [(t, "de") for t in german]
    few = spark.createDataFrame(rows, "text string, lang string")
    copies = spark.range(20_000).selectExpr("'one and the same page' AS text", "'en' AS lang")
    plain, crowded = fit_dictionaries(few), fit_dictionaries(few.unionByName(copies))
    assert set(crowded) == {"de", "en"} and crowded["de"] == plain["de"]
    assert len(crowded["en"]) > 0.8 * len(plain["en"])
