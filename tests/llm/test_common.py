import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle

from graphloom.llm import common, near_dedup, ngrams, packing, quality_classifier


@pytest.mark.parametrize("table", [4, 16])
def test_equal_spans_have_equal_hashes_wherever_they_stand(monkeypatch, table):
    monkeypatch.setattr(common, "TABLE", table)
    monkeypatch.setattr(common, "worker_store", lambda name, held={}: held)  # noqa: B006
    rng = np.random.default_rng(1)
    data = rng.integers(97, 101, 3000).astype(np.uint8)
    data[rng.random(3000) < 0.3] = 32
    starts, ends, _ = common.word_spans(data, np.array([0, len(data)]))
    seen = {}
    for a, b, h in zip(starts, ends, common.span_hashes(data, starts, ends), strict=True):
        assert seen.setdefault(data[a:b].tobytes(), h) == h
    assert len(set(seen.values())) == len(seen) > 100


def test_a_fit_makes_functions_no_larger():
    texts = ["some words of a text " * 2000, "others stand here " * 3000]
    quality_classifier.fit(texts, np.array([0, 1]), epochs=1)
    near_dedup.signatures(pa.array(texts, pa.large_string()), 2)
    for function in (ngrams.mean_scores, near_dedup.compare, near_dedup.signatures, packing.WordIds):
        assert len(cloudpickle.dumps(function)) < 100_000
