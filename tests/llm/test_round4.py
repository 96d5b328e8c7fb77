"""Near-dedup: pairs that parities turn away."""

import random

import numpy as np

from layerwright.llm import near_dedup as nd


def test_parities_differ_no_more_than_the_sets():
    rng = np.random.default_rng(5)
    for size in (1, 10, 100, 3000):
        for own in (0, 1, size // 3, size):
            shared = rng.integers(0, 2**63, size, dtype=np.uint64)
            a, b = (np.unique(np.concatenate([shared, rng.integers(0, 2**63, own, dtype=np.uint64)])) for _ in "ab")
            places = sum(int(x).bit_count() for x in (nd.parities(a) ^ nd.parities(b)).view(np.uint64))
            assert places <= len(np.setxor1d(a, b))
            assert own == 0 or places > 0


def test_near_dedup_compares_few_pairs_of_a_group_that_is_not_similar_enough(spark, monkeypatch):
    compared = []
    confirmed = nd._confirmed

    def counted(pairs, sets, percent):
        compared.append(pairs.count())
        return confirmed(pairs, sets, percent)

    monkeypatch.setattr(nd, "_confirmed", counted)
    rng = random.Random(11)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for k in range(60):
        words = list(base)
        for place in rng.sample(range(200), 9):
            words[place] = f"own{k}x{place}"
        texts.append(words)
    # Each tenth has a near copy, which differs in its last word.
    texts += [[*words[:-1], f"last{k}"] for k, words in enumerate(texts) if k % 10 == 0]
    sets = [nd.shingle_set(" ".join(words), 2) for words in texts]
    label = list(range(len(texts)))
    links = 0
    for i in range(len(texts)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                links += 1
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    docs = spark.createDataFrame([(i, " ".join(words)) for i, words in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in nd.near_dedup(docs, 2, 80).collect()}
    assert found == dict(enumerate(label)) and 6 <= links
    assert sum(compared) <= links + 40
