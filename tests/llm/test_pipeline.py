"""Every stage of the pipeline beside a brute-force version, on what the stage before it kept."""

from collections import Counter

import numpy as np
import public_tokenizers
from test_mixing import targets_by_hand
from test_operators import brute_components, brute_spans

import corpus_pipeline
from quillstream.llm import toxicity, unigram
from quillstream.llm.common import Written


def redacted(text):
    if text is None:
        return None
    out, at = [], 0
    for start, _, end in brute_spans(text):
        if start >= at:
            out += [text[at:start], "<secret>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_stages_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    stages = [stage for _, stage in corpus_pipeline.STAGES]
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)

    clean = Written(stages[0](spark, docs, sf_dir), "clean").df
    scores = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, labels).collect()}
    assert rows(clean) == [r for r in rows(docs) if scores[r[0]] < toxicity.THRESHOLD]

    single = Written(stages[1](spark, clean, sf_dir), "single").df
    before = rows(clean)
    group = {int(i): int(c) for i, _, c, _ in brute_components([(r[0], r[1], r[3]) for r in before])}
    assert rows(single) == [r for r in before if group[r[0]] == r[0]]

    safe = Written(stages[2](spark, single, sf_dir), "safe").df
    wanted = [(r[0], redacted(r[1]), *r[2:4], len(redacted(r[1])) if brute_spans(r[1]) else r[4]) for r in rows(single)]
    assert rows(safe) == sorted(wanted, key=str)

    mixed = Written(stages[3](spark, safe, sf_dir), "mixed").df
    had, taken = rows(safe), Counter(rows(mixed))
    assert set(taken) <= set(had) and max(taken.values()) <= 3
    size = lambda r: len((r[1] or "").split())
    sizes = Counter()
    for r in had:
        sizes[r[3]] += size(r)
    for source, target in targets_by_hand(sizes).items():
        words = sum(size(r) * n for r, n in taken.items() if r[3] == source)
        assert abs(words - target) <= max(size(r) for r in had if r[3] == source) / 2 + 1e-6

    model = unigram.Unigram(public_tokenizers.path("piece_bpe_32k.model"))
    encoded = stages[4](spark, mixed, sf_dir).collect()
    assert Counter(tuple(r)[:-1] for r in encoded) == taken
    for r in encoded[::7]:
        ids = [i for c in model.chunks.findall("▁" + r.text.replace(" ", "▁")) for i in model.segment(c)] if r.text else []
        assert r.ids == ids and model.decode(np.array(ids, int)) == (r.text or "").replace("▁", " ")
