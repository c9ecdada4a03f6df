"""Each stage of the pipeline against brute force over the smallest tables."""

from collections import defaultdict

import numpy as np

import corpus_pipeline
from ferry.llm import pieces, toxicity
from ferry.llm.decontaminate import MISSES, WINDOW
from tests.llm.cases import clashing, empty
from tests.llm.test_exact import _normal
from tests.llm.test_models import _classes
from tests.llm.test_text import _words


def _overlap(words, item):
    """Whether a window of the item stands among the words with few changes."""
    if len(item) < 5 or not words:
        return False
    same = np.array(words)[:, None] == np.array(item)[None, :]
    at, of = np.nonzero(same)
    starts = at - of
    need = min(len(item) - 1, WINDOW - MISSES)
    for start, n in zip(*np.unique(starts, return_counts=True), strict=True):
        if n < need:
            continue
        hit = np.zeros(len(item), int)
        hit[of[starts == start]] = 1
        if len(item) < WINDOW:
            if hit.sum() >= len(item) - 1:
                return True
        elif np.convolve(hit, np.ones(WINDOW, int), "valid").max() >= WINDOW - MISSES:
            return True
    return False


def _texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_stages_equal_brute_force(spark, sf):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    items = [_words(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]

    clean = stages["toxicity"](spark, docs, sf).cache()
    scores = {r.doc_id: r.score for r in toxicity.score_documents(docs, labels).collect()}
    assert set(_texts(clean)) == {d for d, s in scores.items() if s < 0.5}

    once = stages["exact dedup"](spark, clean, sf).cache()
    groups = defaultdict(list)
    for d, t in _texts(clean).items():
        groups[_normal(t)].append((-len(t or ""), d))
    assert set(_texts(once)) == {min(g)[1] for g in groups.values()}

    apart = stages["n-gram jaccard join"](spark, once, sf).cache()
    assert set(_texts(apart)) == {c for c, _ in _classes(_texts(once)).values()}

    fair = stages["benchmark decontamination"](spark, apart, sf).cache()
    words = {d: _words(t) for d, t in _texts(apart).items()}
    assert set(_texts(fair)) == {d for d, w in words.items() if not any(_overlap(w, i) for i in items)}
    assert len(_texts(fair)) < len(words)

    with open(pieces.MODEL, "rb") as f:
        tool = pieces.Pieces(f.read())
    for r in stages["sentencepiece"](spark, fair, sf).collect():
        assert tool.decode(r.ids) == r.text and r.n_tokens == len(r.ids) and r.round_trip


def test_stages_take_awkward_and_empty_tables(spark, sf):
    for given in (clashing(spark), empty(spark)):
        docs = given
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf).cache()
            assert docs.columns == given.columns
        assert docs.count() == (4 if given.count() else 0)  # a sentence, the long texts as one, "" and "..."
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == docs.count()
