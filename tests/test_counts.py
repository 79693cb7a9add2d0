"""Counts taken by the job that runs a plan."""

import pytest

from retainframe.operators.counts import StageCounts
from retainframe.operators.intervals import visit_intervals
from retainframe.operators.visits import active_entities, clean_visits, entity_counts, history, split_date
from retainframe.plans.churn import churn_features
from retainframe.plans.corpus import clean_corpus, corpus_chunks, retrieve
from retainframe.queries import inputs
from retainframe.queries.churn import profile
from retainframe.queries.inputs import AS_OF, INTERNAL, PASSIVE, RULES


def test_churn_stages(spark, sf_dir):
    counts, visits = StageCounts(), inputs.visits(spark, sf_dir)
    sides = [f(spark, sf_dir) for f in (inputs.vehicles, inputs.members, inputs.purchases)]
    features = churn_features(visits, *sides, AS_OF, INTERNAL, PASSIVE, RULES, counts=counts)
    rows = features.collect()
    known = profile(spark, sf_dir)
    split = split_date(active_entities(visits, known, INTERNAL, PASSIVE))
    past = history(clean_visits(visits, known, INTERNAL, PASSIVE, RULES, ["purchase_date"]), split)
    got = counts.get()
    assert got["visits"] == entity_counts(past).first()["n_visits"] > 0
    assert got["intervals"] == visit_intervals(past).count() > 0
    assert got["features"] == len(rows) > 0


def test_corpus_stages(spark):
    pages = spark.createDataFrame([(1, "one", "<p>" + "a body line of more than ten words in all, to be kept " * 40 + "</p>")], "doc_key long, title string, html string")
    lines = spark.createDataFrame([("two", 0, n, f"line number {n} of the second document") for n in range(30)], "doc string, page_no int, line_no int, line string")
    corpus = clean_corpus(pages, lines)
    counts = StageCounts()
    retrieve(pages, lines, "second document", counts=counts)
    assert counts.get() == {"corpus": corpus.count(), "chunks": corpus_chunks(corpus).count()}


def test_a_stage_is_counted_once(spark):
    counts = StageCounts()
    out = counts.at(spark.range(0), "none")
    with pytest.raises(ValueError, match="none"):
        counts.at(out, "none")
    assert out.collect() == [] and counts.get() == {"none": 0}
