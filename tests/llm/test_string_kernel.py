import zlib
from itertools import combinations

import numpy as np
import pytest

from shoplens.llm import string_kernel as sk

LABELS = "doc_id long, quality int, toxic int"


def plain_kernel(x, y):
    """All spread-out triples of characters, by their definition."""
    def features(word):
        word, out, norm = f"\x02{word}\x03", {}, 0.0
        for i, j, k in combinations(range(len(word)), 3):
            if k - i < sk.SPAN:
                w = sk.DECAY ** (k - i + 1)
                out[word[i] + word[j] + word[k]] = out.get(word[i] + word[j] + word[k], 0) + w
                norm += w * w
        return out, norm ** 0.5
    (a, na), (b, nb) = features(x), features(y)
    return sum(w * b.get(u, 0) for u, w in a.items()) / (na * nb)


def test_kernel_is_its_definition():
    words = ["idiot", "idxiot", "id", "a", "moron", "été", "aaaaaa", "worthless"]
    want = [[plain_kernel(x, y) for y in words] for x in words]
    assert np.allclose(sk.kernel(words, words), want)


def insults(make_docs, spark, count=600):
    rng = np.random.default_rng(1)
    syllables = "ta re mo lin shu pe ka von dri sel".split()
    word = lambda: "".join(rng.choice(syllables, rng.integers(1, 5)))
    bad = ["idiot", "worthless", "disgusting", "idioten", "disgustingly"]
    docs, labels = [], []
    for i in range(count):
        words, toxic = [word() for _ in range(40)], int(i % 5 == 0)
        if toxic:
            for b in rng.choice(bad, rng.integers(1, 4), replace=False):
                words.insert(int(rng.integers(0, 40)), b)
        docs.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return docs, labels


def test_held_out_accuracy_and_variants(make_docs, spark):
    docs, labels = insults(make_docs, spark)
    extra = {900: "ta remo you idxiot lin", 901: "ta remo i d i o t lin", 902: "disgus.ting shu", 903: "worthlessss von", 904: "moshu kavon",
             905: None, 906: ""}
    frame = make_docs(docs + list(extra.items()) + [(None, "idiot idiot")])
    found = {r.doc_id: r for r in sk.score(frame, spark.createDataFrame(labels, LABELS)).collect()}
    truth = {i: t for i, _, t in labels}
    out = [i for i in truth if found[i].held_out]
    assert out == [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(found[i].predicted == truth[i] for i in out) / len(out) > 0.97
    assert [found[i].predicted for i in extra] == [1, 1, 1, 1, 0, 0, 0]
    assert found[None].predicted == 1 and not found[None].held_out
    assert all(0 <= r.score <= 1 for r in found.values())


def test_labels_of_the_held_out_fold_teach_nothing(make_docs, spark):
    docs, labels = insults(make_docs, spark, 300)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    frame = make_docs(docs)
    one, two = (sorted(map(tuple, sk.score(frame, spark.createDataFrame(x, LABELS)).collect())) for x in (labels, turned))
    assert one == two


def test_table(spark, small, small_docs):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    found = sk.score(small_docs, labels).collect()
    assert len(found) == small_docs.count() and all(0 <= r.score <= 1 for r in found)


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, 1, 1)], [(None, 1, 1), (2, 0, None)]])
def test_few_labels(spark, make_docs, odd_docs, labels):
    frame = spark.createDataFrame(labels, LABELS)
    found = sk.score(odd_docs, frame).collect()
    assert len(found) == odd_docs.count() and all(0 <= r.score <= 1 for r in found)
    assert sk.score(make_docs([]), frame).count() == 0


def test_filter_keeps_columns_and_clean_rows(make_docs, spark):
    docs, labels = insults(make_docs, spark, 400)
    frame = make_docs(docs + [(900, None), (901, "")])
    kept = sk.keep_clean(frame, spark.createDataFrame(labels, LABELS))
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == frame.columns and {900, 901} <= ids
    truth = {i: t for i, _, t in labels}
    assert sum((i in ids) == (t == 0) for i, t in truth.items()) / len(truth) > 0.97
