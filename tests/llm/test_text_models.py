"""Classifiers on held-out rows, and their parts."""

from pathlib import Path
from zlib import crc32

import numpy as np
import pytest

from delayworks.llm import subword_classifier, weak_toxicity
from delayworks.llm.subword_classifier import held_out, labelled_sample, scored
from delayworks.llm.subwords import counts, features, pieces, sums
from delayworks.llm.weak_toxicity import Hits, Pattern, label_model, mine, without_toxic

DATA = "/root/testdata/sf0.1"


def tables(spark):
    if not Path(DATA).exists():
        pytest.skip("no test tables")
    return (spark.read.parquet(f"{DATA}/{name}.parquet") for name in ("documents", "labels"))


def test_features_of_a_text_by_hand():
    found = [bucket.tolist() for _, bucket in features(["ab  cde"], 18)]
    three, four, five, words, pairs = found
    # " ab", "ab ", " cd", "cde", "de "; " ab ", " cde", "cde "; " cde "
    assert [len(x) for x in (three, four, five, words, pairs)] == [5, 3, 1, 2, 1]
    again = [bucket.tolist() for _, bucket in features(["cde\tab"], 18)]
    assert sorted(again[0]) == sorted(three) and sorted(again[3]) == sorted(words)


def test_a_repeated_word_makes_one_pair_whatever_the_word():
    pairs = [[b.tolist() for _, b in features([t], 18)][-1] for t in ("x x", "yy yy", "x y")]
    assert pairs[0] == pairs[1] != pairs[2]


def test_long_texts_come_in_pieces_and_lose_nothing(monkeypatch):
    from delayworks.llm import subwords

    monkeypatch.setattr(subwords, "CHARACTERS_AT_ONCE", 50)
    texts = ["", "word " * 100, "x" * 300, "a b", ""]
    held = [(int(r), t) for rows, group in pieces(texts) for r, t in zip(rows, group)]
    for row, text in enumerate(texts):
        assert "".join(t for r, t in held if r == row) == text
    total, number = sums(texts, np.ones(1 << 10), 10)
    assert (total == number).all() and number[0] == 0 and number[1] > 1000


def test_scores_are_the_mean_of_bucket_weights():
    weights = np.random.default_rng(0).normal(size=1 << 12)
    bucket, n = counts("some words of a text", 12)
    total, number = sums(["other", "some words of a text"], weights, 12)
    assert total[1] == pytest.approx((weights[bucket] * n).sum()) and number[1] == n.sum()


@pytest.mark.parametrize("train", [subword_classifier.train, weak_toxicity.train])
@pytest.mark.parametrize("texts, labels", [([], []), (["a"], [1]), (["", ""], [0, 1]), (["same text"] * 5, [0, 1, 0, 1, 1])])
def test_poor_training_rows(train, texts, labels):
    scores = train(texts, labels).scores(["", "some text", "word " * 5000])
    assert ((0 <= scores) & (scores <= 1)).all()


def test_quality_on_held_out_rows(spark):
    documents, labels = tables(spark)
    rows = labelled_sample(documents, labels, "quality", 2000)
    assert all(crc32(str(i).encode()) % 4 != 2 for i in rows["id"])
    model = subword_classifier.train(list(rows["text"]), list(rows["label"]))
    judged = scored(documents, model).join(labels.withColumnRenamed("doc_id", "id"), "id").where(held_out("id")).toPandas()
    assert ((judged["score"] >= 0.7) == (judged["quality"] == 1)).mean() >= 0.97


def test_toxicity_on_held_out_rows(spark):
    documents, labels = tables(spark)
    model = weak_toxicity.fit(documents, labels)
    judged = scored(documents, model).join(labels.withColumnRenamed("doc_id", "id"), "id").where(held_out("id")).toPandas()
    toxic, said = judged["toxic"] == 1, judged["score"] >= 0.3
    assert said[toxic].mean() >= 0.85 and toxic[said].mean() >= 0.93


def test_labels_and_ids_are_no_inputs(spark, documents):
    model = weak_toxicity.train([], [])
    rows = [(1, "you idiot", "a"), (None, "you idiot", None), (2, None, "b"), (2, "", "b")]
    scores = [r["score"] for r in scored(documents(rows), model).collect()]
    assert scores[0] == scores[1] > 0.8 and scores[2] == scores[3] < 0.1


def test_toxic_documents_go_with_all_columns_kept(spark, documents):
    frame = documents([(1, "you idiot", "a", 1.0), (2, "fine words", "a", 2.0), (3, None, None, None)], ", score double")
    kept = without_toxic(frame, weak_toxicity.train([], []))
    assert kept.columns == frame.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3]


def test_mined_patterns_cover_every_group():
    texts = [f"{w}{e} plain words {i}" for i, (w, e) in enumerate([("lowei", x) for x in "abcdefgh"] + [("chlla", x) for x in "abcdefgh"])]
    clean = [f"plain words and others {i}" for i in range(60)]
    hits = Hits(mine(texts + clean, [1] * 16 + [0] * 60))
    assert all(hits.measures(t)[-4] > 0 for t in texts) and not any(hits.measures(t)[-4] for t in clean)
    assert mine(clean, [0] * 60) == [] and Hits([Pattern("lowei", False)]).measures("lowei")[0] == 1


def test_label_model_finds_accuracies_and_discounts_copies():
    rng = np.random.default_rng(1)
    toxic = rng.random(4000) < 0.2
    good = [(rng.random(4000) < np.where(toxic, 0.7, 0.02)) for _ in range(3)]
    noise = rng.random(4000) < 0.05
    v = np.column_stack([*good, *[noise] * 5]).astype(float)  # one noisy voter, five times
    posterior = label_model(v)
    assert ((posterior > 0.5) == toxic).mean() > 0.93
    assert posterior[noise & ~np.any(good, axis=0)].mean() < 0.5
