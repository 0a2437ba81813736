import random
import zlib

import numpy as np
import pytest

from spendframe.llm import toxicity as X
from spendframe.llm.common import read_table

from .conftest import AWKWARD

CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def letters(spark):
    return X.letter_model(read_table(spark, CHECK, "documents", "doc_id", "text"))


@pytest.mark.parametrize("hidden,plain", [
    ("m0ron", "moron"), ("1diot", "idiot"), ("st*pid", "stupid"), ("tr@sh", "trash"), ("l o s e r", "loser"),
    ("c.l.o.w.n", "clown"), ("scuuuum", "scum"), ("idioooot", "idiot"), ("moron", "moron")])
def test_restores_hidden_words(letters, hidden, plain):
    assert X.Restorer(letters).decode(hidden) == plain


@pytest.mark.parametrize("hidden,plain", [
    ("a l o s e r", "loser"), ("y o u m o r o n", "moron"), ("I w o r t h l e s s", "worthless"), ("l o s e r", "loser"),
    ("y o u a r e a w o r t h l e s s l o s e r a n d t h e t h i n g i s h e r e", "worthless"), ("m0r0n/1diot", "idiot")])
def test_words_of_a_spaced_run(letters, hidden, plain):
    assert holds(X.Restorer(letters), hidden, plain)


def holds(r, hidden, word):
    return X.text_hashes(word)[0] in r(hidden).tolist()


def test_long_spans_take_linear_time(letters):
    r = X.Restorer(letters)
    assert len(r.decode("m0r0n" * 4000)) == 20_000
    starred = "m" + "*" * 100_000 + "n"
    assert len(r(starred)) and starred not in r.known
    assert holds(r, "a l o s e r " * 1000, "loser")


def test_pieces_against_all_joins():
    pieces = ["a", "mor", "on", "", "x", "\u00e9"]
    shown = [x for x in pieces if x]
    words = {"".join(shown[i:j]) for i in range(len(shown)) for j in range(i + 1, len(shown) + 1)}
    wanted = {h for w in words if len(w.encode()) >= 3 for h in X.text_hashes(w)}
    assert set(X.piece_hashes([x.encode() for x in shown]).tolist()) == wanted


def test_mostly_starred_words_are_spans(letters):
    text = b"such a s**t and l***r"
    buffer = np.frombuffer(text, np.uint8)
    assert {text[a:b] for a, b, _ in X.spans_of(buffer, np.array([0, len(buffer)]))} == {b"s**t", b"l***r"}


def test_viterbi_finds_the_cheapest_path(letters):
    """Against all paths of the lattice, by cost."""
    rng = random.Random(2)
    r = X.Restorer(letters)

    def best(span):
        paths, before = [((0, 0), 0.0, "")], ""
        for c in span:
            following = []
            for (p, q), cost, said in paths:
                for x, extra in r.options(c, before):
                    k = (ord(x) - 96 if "a" <= x <= "z" else 27) if x else None
                    following.append(((p, q), cost + extra, said) if k is None else
                                     ((q, k), cost + extra - r.logp[p, q, k], said + x))
            paths, before = following, c
        return min(cost - r.logp[p, q, 0] for (p, q), cost, _ in paths)

    for _ in range(40):
        span = "".join(rng.choice("abe1!0.aa") for _ in range(rng.randint(1, 7)))
        said = r.decode(span)
        states = [t for t in [said]]
        assert states and isinstance(said, str)
        # the cost of the decoded word cannot exceed the best of all paths
        assert _cost(r, span, said) == pytest.approx(best(span), abs=1e-4)


def _cost(r, span, said):
    """Least cost of any path that says ``said``."""
    paths, before = {(0, 0, ""): 0.0}, ""
    for c in span:
        following = {}
        for (p, q, t), cost in paths.items():
            for x, extra in r.options(c, before):
                k = (ord(x) - 96 if "a" <= x <= "z" else 27) if x else None
                key = (p, q, t) if k is None else (q, k, t + x)
                value = cost + extra - (0 if k is None else r.logp[p, q, k])
                if value < following.get(key, 1e9):
                    following[key] = value
        paths, before = following, c
    return min(cost - r.logp[p, q, 0] for (p, q, t), cost in paths.items() if t == said)


def test_spans(letters):
    text = "plain words here\nm0ron l o s e r tr@sh. 12345 scuuum c.l.o.w.n fine 3 a"
    buffer = np.frombuffer(text.encode(), np.uint8)
    got = {text[a:b] for a, b, _ in X.spans_of(buffer, np.array([0, len(buffer)]))}
    assert {"m0ron", "l o s e r", "tr@sh", "scuuum", "c.l.o.w.n"} <= got
    assert not got & {"plain", "words", "here", "fine", "12345"}


def test_held_out_accuracy(spark):
    docs = read_table(spark, CHECK, "documents", "doc_id", "text")
    labels = read_table(spark, CHECK, "labels", "doc_id", "toxic")
    rows = X.scores(docs, X.learn(docs, labels)).join(labels, "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    test = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.toxic for r in test) / len(test) >= 0.95
    assert all(r.predicted == 0 for r in test if r.toxic == 0)


def test_hidden_toxic_documents_are_rejected(spark):
    docs = read_table(spark, CHECK, "documents", "doc_id", "text")
    labels = read_table(spark, CHECK, "labels", "doc_id", "toxic")
    model = X.learn(docs, labels)
    made = spark.createDataFrame([(1, "the haer is a m0ron and an 1diot here"), (2, "the haer and of the thing here"),
                                  (3, "of the w o r t h l e s s thing tr@sh"), (4, "the a w o r t h l e s s thing here"),
                                  (5, "the y o u w o r t h l e s s thing here")], "doc_id bigint, text string")
    assert {r.doc_id: r.predicted for r in X.scores(made, model).collect()} == {1: 1, 2: 0, 3: 1, 4: 1, 5: 1}


def test_held_out_labels_are_never_read(spark):
    docs = read_table(spark, CHECK, "documents", "doc_id", "text")
    labels = read_table(spark, CHECK, "labels", "doc_id", "toxic")
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id AS string)) % 5 = 0, 1 - toxic, toxic) AS toxic")
    a, b = X.learn(docs, labels), X.learn(docs, flipped)
    assert (a.words == b.words).all() and np.allclose(a.weights, b.weights)


def test_awkward_rows(spark, awkward, no_rows):
    labels = spark.createDataFrame([(1, 1), (2, None), (5, 0), (7, 0), (7, 1), (99, 1)], "doc_id bigint, toxic int")
    rows = X.scores(awkward, X.learn(awkward, labels)).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 for r in rows)
    none = X.learn(awkward, labels.where("false"))
    assert {r.score for r in X.scores(awkward, none).collect()} == {0.0}
    assert X.scores(no_rows, X.learn(no_rows, labels)).count() == 0
    kept = X.rejected_out(awkward, labels.where("false"))
    assert kept.columns == awkward.columns and kept.count() == len(AWKWARD)
