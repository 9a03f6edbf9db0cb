from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as hs

from earshot.functions.text import plain_table
from earshot.llm import toxicity as tx, toxicity_fit as tf

T = plain_table()


def score(model, texts):
    tagger = tx.Tagger(model, T)
    ids, starts = tagger.batch(texts)
    return tx.document_scores(tagger.marginals(ids), starts)


@settings(max_examples=40, deadline=None)
@given(hs.lists(hs.floats(-4, 4), min_size=1, max_size=6), hs.tuples(*[hs.floats(-2, 2)] * 4))
def test_passes_against_all_labellings(u, move):
    n = len(u)
    weight = {}
    for y in itertools.product((0, 1), repeat=n):
        moves = [y[0], sum(a < b for a, b in zip(y, y[1:])), sum(a > b for a, b in zip(y, y[1:])), sum(a * b for a, b in zip(y, y[1:]))]
        weight[y] = np.exp(sum(a * b for a, b in zip(u, y)) + np.dot(moves, move)), moves
    z = sum(w for w, _ in weight.values())
    p, total, counts = tx.Chains(np.array([0] + [1] * n + [0, 1, 0])).run(np.array([0.0, *u, 0.0, u[0], 0.0]), move, moves=True)
    assert p[1 : n + 1] == pytest.approx([sum(w for y, (w, _) in weight.items() if y[t]) / z for t in range(n)], abs=1e-6) and p[0] == p[n + 1] == 0
    assert p[n + 2] == pytest.approx(1 / (1 + np.exp(-u[0] - move[0])), abs=1e-6)
    k = 0 if n > 1 else list(tx.Chains(np.array([0] + [1] * n + [0, 1, 0])).segment).index(0)
    assert total[k] == pytest.approx(np.log(z), abs=1e-6)
    assert counts[k] == pytest.approx(sum(w * np.array(m) for w, m in weight.values()) / z, abs=1e-6)


INSULTS = ["You are a {} and everybody knows it.", "What a {} you are!", "Shut up, you stupid {}."]
CALM = ["The gate closed at {} and nothing else happened.", "Kill the process before you swap the card.", "A dumb terminal is all you need here.", "We measured {} clips in the kitchen.", "The master clock feeds two slave boards.", "You are right, the gate was shut."]
NAMES = ["asshole", "bastard", "gloopfish", "moron"]


def corpus(n, seed, wrong=0.04, names=NAMES):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        toxic = r.random() < 0.3
        s = [r.choice(CALM).format(r.randint(1, 99)) for _ in range(r.randint(2, 6))]
        if toxic:
            s.insert(r.randrange(len(s)), r.choice(INSULTS).format(r.choice(names)))
        out.append((" ".join(s), int(toxic != (r.random() < wrong))))
    return out


def voted(data):
    return [(t, y, 1 - y) for t, y in data]


@pytest.fixture(scope="module", params=[frozenset(), frozenset(["asshole", "bastard*", "moron"])])
def model(request):
    """Without and with a list of words."""
    return tf.train(voted(corpus(400, 1)), T, listed=request.param)


def test_held_out_accuracy_with_wrong_labels(model):
    held = corpus(200, 2, wrong=0)
    s = score(model, [t for t, _ in held])
    assert np.mean((s >= model.threshold) == np.array([y for _, y in held])) > 0.97


def test_moves_are_learned(model):
    assert abs(np.array(model.move) - tf.START).max() > 0.3


def test_words_are_learned_not_listed():
    model = tf.train(voted(corpus(400, 3, names=["gloopfish", "wugbert"])), T)
    s = score(model, ["You are a gloopfish.", "What a wugbert you are!", "The gloop was cleaned.", "nice weather today", ""])
    assert (s[:2] > model.threshold).all() and (s[2:] < model.threshold).all()


@pytest.mark.parametrize("text", ["you are an ASSHOLE", "you are an a.s.s.h.o.l.e", "you are an a s s h o l e", "you are an a​s​s​h​o​l​e", "you are an @$$h0le", "you are an assh*le", "you are an asssshole", "you are an аsshоle", "<b>you are an ass&#104;ole</b>"])
def test_disguises(model, text):
    assert score(model, [text])[0] > model.threshold


def test_markup_of_any_length(model):
    for n in (250, 301, 10_000):
        tag = f'<a href="{"x" * n}">'
        assert score(model, [f"you are a {tag}bast{tag}ard</a>", f"you are an {tag}asshole</a>"])[1] > model.threshold
        assert score(model, [f'The gate closed at 7 <a title="you are a bastard, you asshole {"y" * n} > what a moron you are">and nothing else happened</a>.'])[0] < model.threshold


def test_nothing_learned_without_both_labels():
    for data in ([], [("you bastard", 1, 0)], [("calm", 0, 1)], [("a", 1, 1)]):
        m = tf.train(data, T)
        assert score(m, ["you fucking bastard", ""])[0] < m.threshold


def test_label_error(spark):
    rows = [(i, int(a), k) for i in range(60) for k, a in enumerate([1, 0] if i < 12 else [i % 2, i % 2])]
    counted = tf.votes(spark.createDataFrame(rows, "doc_id bigint, toxic int, k int"), doc_id="doc_id", label="toxic")
    e = tf.label_error(counted)
    assert 2 * e * (1 - e) == pytest.approx(0.2) and tf.label_error(counted.limit(3)) == 0.04


def test_sample_is_bounded_by_characters(spark):
    docs = spark.createDataFrame([(i, "x" * 100) for i in range(20)] + [(99, "y" * 5000)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in [*range(20), 99]], "doc_id bigint, toxic int")
    take = lambda chars, n=50: tf.labelled_sample(docs, labels, doc_id="doc_id", text="text", label="toxic", most_toxic=n, most_clean=n, most_chars=chars)[0]
    assert len(take(1050)) == 10 and len(take(10_000)) == 21 and len(take(10_000, 3)) == 6 and take(50) == []


@settings(max_examples=150, deadline=None)
@given(hs.text(alphabet="ab .-_*<>&;é​а1@", max_size=40))
def test_tidy_mapped_is_tidy(s):
    a, at = tx.tidy_mapped(s, T)
    if "&" not in s:
        assert a == tx.tidy(s, T)
    assert len(at) == len(a) + 1 and at == sorted(at)


def test_tables(spark):
    data = corpus(300, 5)
    docs = spark.createDataFrame([(i, t, "s") for i, (t, _) in enumerate(data)] + [(500, None, "s"), (501, "", None), (502, "calm words " * 20_000, "s"), (0, data[0][0], "s"), (None, "What a bastard you are!", "s")], "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([(i, y, "x") for i, (_, y) in enumerate(data)] + [(0, 1 - data[0][1], "x"), (None, 1, "x"), (3, None, "x"), (9999, 1, "x"), (4, 7, "x")], "doc_id bigint, toxic int, text string")
    model = tf.fit(docs, labels)
    out = {(r.doc_id, i): r for i, r in enumerate(tx.score_documents(docs.repartition(1).sortWithinPartitions("doc_id"), model, text="text", keep=["doc_id"]).collect())}
    assert len(out) == docs.count()
    for (i, _), r in out.items():
        text = dict((k, t) for k, (t, _) in enumerate(data)).get(i)
        for s in r.spans:
            assert text is None or 0 <= s.start < s.end <= len(text)
        if i in (500, 501):
            assert r.score == 0.0 and not r.toxic and r.spans == []
        if i == 502:
            assert not r.toxic
    span = next(r for (i, _), r in out.items() if i is None)
    assert span.toxic and any("bastard" in "What a bastard you are!"[x.start : x.end] for x in span.spans)
    assert tx.score_documents(docs.limit(0), model, text="text", keep=["doc_id"]).count() == 0
    assert tf.fit(docs, labels.limit(0)).own == {}
