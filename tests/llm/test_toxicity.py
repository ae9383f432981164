import zlib

import numpy as np
import pytest

from faultloom.llm import toxicity as x

SCHEMA = "doc_id long, text string, score string, toxic string"


@pytest.fixture(scope="module")
def made():
    rng = np.random.default_rng(3)
    vocabulary = [f"word{i}" for i in range(3000)]
    texts, toxic = [], []
    for i in range(900):
        words = list(rng.choice(vocabulary, rng.integers(5, 80)))
        bad = i % 4 == 0
        if bad:
            words[rng.integers(len(words))] = rng.choice(["vile,", "Scum", "moron."])
        texts.append(" ".join(words).encode())
        toxic.append(int(bad))
    return texts, np.array(toxic)


def test_learns_and_is_repeatable(made):
    texts, toxic = made
    model = x.train(texts[:700], toxic[:700])
    got = x.scores(model, texts[700:]) >= 0.5
    assert (got == toxic[700:]).mean() > 0.97
    assert np.array_equal(x.scores(x.train(texts[:700], toxic[:700]), texts[:9]), x.scores(model, texts[:9]))


def test_parts_of_long_texts_equal_the_whole(made, monkeypatch):
    model = x.train(*made)
    texts = [b" ".join(made[0][:40]), b"", b"one", made[0][0]]
    whole = x.scores(model, texts)
    monkeypatch.setattr(x, "CHUNK", 7)
    assert np.allclose(x.scores(model, texts), whole)
    # Padding keeps neighbours apart: alone or in company, a text has one score.
    assert np.allclose([x.scores(model, [t])[0] for t in texts], whole)


def test_filters_by_hand(made):
    model = x.train(*made)
    codes = x.encode([made[0][0]])[0] & (x.BUCKETS - 1)
    emb, w = np.vstack([model.table[codes], np.zeros((2, x.DIM))]), 3
    want = max(sum(emb[i + j] @ model.filters[2][j] for j in range(w))[0] for i in range(len(codes)))
    got = x._features(model, x.encode([made[0][0]]))[0, 2 * x.FILTERS]
    assert np.isclose(got, max(0, want + model.biases[2 * x.FILTERS]), atol=1e-4)


def test_table(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    rows = x.score_documents(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_edges(spark, sf_dir):
    texts = [None, "", "  ", "a", "long " * 30_000]
    docs = spark.createDataFrame([(i, t, "s", "t") for i, t in enumerate(texts)] + [(None, "a", "s", "t"), (3, "a", "s", "t")], SCHEMA)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = x.score_documents(docs, labels).collect()
    assert len(rows) == 7 and all(0 <= r.score <= 1 for r in rows)
    assert x.filtered(docs, labels).columns == docs.columns
    assert x.score_documents(docs.limit(0), labels).count() == 0
    none = x.score_documents(docs, labels.limit(0)).collect()
    assert {r.predicted for r in none} == {0}


def test_every_gradient_against_differences(made):
    """The loss, written plainly, changes as the gradients say; in 64 bits, so that differences are exact enough."""
    rng = np.random.default_rng(8)
    model, bias = x.train(made[0][:300], made[1][:300]), 0.3
    model = x.Model(model.table.astype(float), [f.astype(float) for f in model.filters], model.biases.astype(float), model.weights.astype(float), bias, model.shifts)
    coded, y = x.encode(made[0][:12]), made[1][:12]
    weight = rng.uniform(0.5, 2, len(y))

    def loss():
        z = np.array([plain_logit(model, c & (x.BUCKETS - 1)) for c in coded]) + at[0]
        fit = (weight * (np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0) - y * z)).mean()
        return fit + 0.5e-4 * (model.weights**2).sum()

    at = np.array([bias])
    *grads, (rows, row_grads) = x._gradients(model, bias, coded, y, weight)
    table = np.zeros_like(model.table)
    np.add.at(table, rows, row_grads)
    used = np.unique(np.concatenate(coded) & (x.BUCKETS - 1))
    used = used[np.abs(table[used]).sum(axis=1) > 0]
    values = [*model.filters, model.biases, model.weights, at, model.table]
    for value, grad in zip(values, [*grads, table], strict=True):
        places = [tuple(p) for p in np.argwhere(np.ones(value.shape, bool))] if value is not model.table else [(r, d) for r in used for d in range(x.DIM)]
        for p in [places[i] for i in rng.permutation(len(places))[:25]]:
            step, before = 1e-6, value[p]
            value[p] = before + step
            up = loss()
            value[p] = before - step
            down = loss()
            value[p] = before
            assert np.isclose((up - down) / (2 * step), grad[p], rtol=1e-3, atol=1e-6)


def plain_logit(model, buckets):
    """The network in plain loops, without its last bias."""
    words = [*buckets, *[0] * (max(x.WIDTHS) - 1)]
    total = 0.0
    for k, width in enumerate(x.WIDTHS):
        for f in range(x.FILTERS):
            best = max(sum(float(model.table[words[i + j]] @ model.filters[k][j][:, f]) for j in range(width)) for i in range(len(buckets)))
            total += max(0.0, best + float(model.biases[k * x.FILTERS + f])) * float(model.weights[k * x.FILTERS + f])
    return total


def test_scores_against_plain_loops(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    model = x.learnt(docs, labels)
    got = {r.doc_id: r.score for r in x.score_documents(docs, labels).collect()}
    rows = sorted(docs.collect(), key=lambda r: len(r.text))
    for r in [*rows[:15], *rows[90:100], rows[-1]]:
        codes = x.encode([r.text.encode()])[0]
        language = x._languages([codes])[0]
        z = plain_logit(model, codes & (x.BUCKETS - 1)) + model.bias - model.shifts[language]
        assert np.isclose(got[r.doc_id], 1 / (1 + np.exp(-z)), atol=1e-4)


def test_held_out_rows(spark, sf_dir):
    """Of the rows not learnt from, nearly all toxic ones are found and few others flagged."""
    far = sf_dir.replace("sf0.001", "sf0.1")
    docs, labels = (spark.read.parquet(f"{far}/{n}.parquet") for n in ("documents", "labels"))
    known = x.score_documents(docs, labels).filter("held_out").join(labels, "doc_id").collect()
    toxic, other = ([r.predicted for r in known if r.toxic == y] for y in (1, 0))
    assert len(toxic) > 50 and np.mean(toxic) >= 0.8 and np.mean(other) <= 0.03


def test_columns_of_other_meaning_stay(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = spark.createDataFrame([(1, "a", 0.9, 0.1, 5, "m")], "doc_id long, text string, toxicity double, Toxicity_ double, order int, model string")
    assert x.filtered(docs, labels).collect() == docs.collect()


def frames(spark, rows):
    """Documents and labels of (text, toxic) rows."""
    ids = [(i, *row) for i, row in enumerate(rows)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in ids], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, y) for i, _, y in ids], "doc_id long, toxic int")


def test_long_texts_are_learnt_from(spark):
    """Toxic texts of over 200,000 bytes: the only ones of their class."""
    rows = [("vile " + f"w{i % 7} " * 70_000, 1) if i % 10 == 0 else (f"w{i % 7} w{i % 5}", 0) for i in range(120)]
    docs, labels = frames(spark, rows)
    got = {r.doc_id: r.predicted for r in x.score_documents(docs, labels).collect()}
    assert [got[i] for i in range(120)] == [y for _, y in rows]


def test_every_labelled_row_is_learnt_from(spark):
    rows = [(f"w{i % 50} w{i % 7}", int(i % 3 == 0)) for i in range(12_000)]
    docs, labels = frames(spark, rows)
    found = x.training(docs, labels, "doc_id", "text")
    want = docs.filter(x.fold(x.F.col("doc_id")) != 0).count()
    assert want > 9_000 and found.count() == want
    assert x.training(docs.union(docs), labels.union(labels), "doc_id", "text").count() == 2 * want


def test_averaged_shards_learn(spark, made, monkeypatch):
    texts = [t.decode() for t in made[0]]
    docs, labels = frames(spark, list(zip(texts, made[1].tolist(), strict=True)))
    whole = x.learnt(docs, labels)
    monkeypatch.setattr(x, "SHARD_ROWS", 100)
    model = x.learnt(docs, labels)
    assert not np.array_equal(model.table, whole.table)
    held = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 5 == 0]
    got = x.scores(model, [made[0][i] for i in held]) >= 0.5
    assert (got == made[1][held]).mean() > 0.95
    again = x.learnt(docs.repartition(7), labels.repartition(3))
    assert np.allclose(again.table, model.table, atol=1e-5) and np.allclose(again.shifts, model.shifts, atol=1e-3)


def test_one_shard_is_learnt_as_by_one_process(spark, made):
    texts = [t.decode() for t in made[0]]
    docs, labels = frames(spark, list(zip(texts, made[1].tolist(), strict=True)))
    rows = sorted(x.training(docs, labels, "doc_id", "text").collect(), key=lambda r: (r.order, r.text))
    want = x.train([r.text.encode() for r in rows], [r.toxic for r in rows])
    got = x.learnt(docs, labels)
    assert np.array_equal(got.table, want.table) and got.bias == want.bias
    assert np.allclose(got.shifts, want.shifts, atol=1e-3)
