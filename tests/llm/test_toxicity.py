"""Noisy-or toxicity: held-out accuracy, located sentences, odd inputs."""

import random
import zlib

import numpy as np

from rivulet.llm import toxicity as T

SCHEMA = "doc_id bigint, text string, id string, y int"


def planted(n, seed=1):
    rng = random.Random(seed)
    plain = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in ("lo", "mi", "ne")]
    bad = ["vilest", "grubby", "scornomat", "scornotum", "scornofix"]
    docs, labels, where = [], [], {}
    for i in range(n):
        sents = [" ".join(rng.choice(plain) for _ in range(rng.randint(3, 9))) for _ in range(rng.randint(1, 12))]
        toxic = rng.random() < 0.3
        if toxic:
            k = rng.randrange(len(sents))
            sents[k] += " " + rng.choice(bad)
            where[i] = k
        docs.append((i, ". ".join(sents) + ".", "x", 0))
        labels.append((i, int(toxic)))
    return docs, labels, where


def test_held_out_accuracy_and_places(spark):
    docs, labels, where = planted(900)
    d = spark.createDataFrame(docs, SCHEMA)
    l = spark.createDataFrame(labels, "doc_id bigint, toxic bigint")
    model = T.train(d, l)
    got = {r.doc_id: r for r in T.score(d, model).collect()}
    y = dict(labels)
    out = [i for i in y if zlib.crc32(str(i).encode()) % 5 == 0]
    assert 100 < len(out) < 260
    assert np.mean([(got[i].score >= 0.5) == y[i] for i in out]) > 0.97
    right = [len(got[i].offending) == 1 and docs[i][1][:got[i].offending[0].start].count(".") == where[i]
             for i in out if y[i]]
    assert np.mean(right) > 0.9
    assert all(0 <= r.score <= 1 for r in got.values())


def test_held_out_labels_are_not_used(spark):
    docs, labels, _ = planted(300)
    d = spark.createDataFrame(docs, SCHEMA)
    flip = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    models = [T.train(d, spark.createDataFrame(x, "doc_id bigint, toxic bigint")) for x in (labels, flip)]
    assert models[0] == models[1]


def test_odd_inputs(spark):
    docs, labels, _ = planted(60)
    docs += [(1000, None, "x", 0), (1001, "", "x", 0), (None, "vilest", "x", 0), (3, docs[3][1], "x", 0),
             (1002, "İ İİ. vilest " * 9000, "x", 0), (1003, "...\n!?", "x", 0)]
    labels += [(None, 1), (5, None), (7, 1), (7, 0), (4000, 1)]
    d = spark.createDataFrame(docs, SCHEMA)
    l = spark.createDataFrame(labels, "doc_id bigint, toxic bigint")
    got = T.score(d, T.train(d, l)).collect()
    assert len(got) == len(docs)
    assert {r.score for r in got if r.doc_id in (1000, 1001, 1003)} == {0.0}
    assert T.score(d.limit(0), T.train(d.limit(0), l)).collect() == []
    none = T.train(d, l.limit(0))
    assert {round(r.score, 6) for r in T.score(d, none).collect() if r.doc_id == 3} == {0.5}


def test_whole_table(spark):
    from rivulet.llm.queries import QUERIES
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in QUERIES["op3_noisy_or_toxicity"](spark, sf).collect()}
    y = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    out = [i for i in y if got[i].held_out]
    hit = [got[i].predicted for i in out if y[i]]
    false = [got[i].predicted for i in out if not y[i]]
    print("held out", len(hit), np.mean(hit), len(false), np.mean(false))
    assert np.mean(hit) > 0.8 and np.mean(false) < 0.02


def test_words_end_at_any_non_letter(spark):
    docs, labels, _ = planted(300)
    model = T.train(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id bigint, toxic bigint"))
    around = [("", ""), ("¡", "!"), ("«", "»"), ("“", "”"), ("belo—", "—belo"), (" ", " "), ("¿", "?"), ("’", "…"),
              ("‹belo ", "²"), ("٣", "𝟗")]
    d = spark.createDataFrame([(i, f"bamine bemilo. {a}vilest{b} belo", "x", 0) for i, (a, b) in enumerate(around)], SCHEMA)
    got = sorted(T.score(d, model).collect())
    assert all(r.score >= 0.5 and len(r.offending) == 1 for r in got), got
    where = [docs_text[r.offending[0].start:r.offending[0].end] for r, docs_text in
             zip(got, [r.text for r in sorted(d.collect())])]
    assert all("vilest" in x and "bamine" not in x for x in where)


def test_letters_and_their_marks_stay_together():
    assert T.bags(T.plain("Déjà «été» été हिन्दी. --- 12! Œuvre")) == [
        {w.encode() for w in ("déjà", "été", "été", "हिन्दी")}, {"œuvre".encode()}]


def test_weak_features_are_kept_while_there_is_room(spark):
    # "graw" is in 4 of 80 toxic documents and in 1 of 80 others: far from three deviations
    docs = [(i, "belo " + ("graw" if i < 4 or i == 100 else "milo"), "x", 0) for i in range(160)]
    every = [i for i in range(160) if zlib.crc32(str(i).encode()) % 5]
    labels = [(i, int(i < 80)) for i in every]
    model, _ = T.train(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id bigint, toxic bigint"))
    assert model.get("graw", 0) > 0
