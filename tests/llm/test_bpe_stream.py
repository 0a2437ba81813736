import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from spendframe.llm import bpe_stream as B
from spendframe.llm.common import read_table

from .conftest import AWKWARD, SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = "abcdefghijklmnopqrstuvwxyz" * 2 + "ABCÉÀüßñΣΟσ0123 456'’.,!?-<|>\n\t́\x1c日本語²½İ\U0001F600é"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return B.Vocabulary(B.read_vocabulary(PATH))


def texts():
    rng = random.Random(5)
    for k in range(400):
        x = "".join(rng.choice(ALPHABET) for _ in range(rng.choice([0, 1, 5, 50, 400])))
        yield x
        yield x[:20] + "<|endoftext|>" + x[20:30] + "<|startoftext|>"
    for k in range(20):
        yield "".join(rng.choice("abcthein") for _ in range(3000))
        yield rng.choice("ahbeo!.") * rng.choice([500, 1999, 5000])


def test_ids_and_text_as_the_library(vocabulary, library):
    for x in texts():
        want = library.encode(x, add_special_tokens=False).ids
        e = B.Encoder(vocabulary)
        assert e.feed(x) + e.finish() == want
        d = B.Decoder(vocabulary)
        assert d.feed(want) == library.decode(want, skip_special_tokens=False)


def test_any_chunking_gives_the_same(vocabulary, library):
    rng = random.Random(6)
    for x in list(texts())[:120]:
        want = library.encode(x, add_special_tokens=False).ids
        e, got, at = B.Encoder(vocabulary), [], 0
        while at < len(x):
            n = rng.randint(1, 30)
            got += e.feed(x[at:at + n])
            at += n
        assert got + e.finish() == want
        d = B.Decoder(vocabulary)
        pieces = [d.feed(want[i:i + 3]) for i in range(0, len(want), 3)]
        assert "".join(pieces) == library.decode(want, skip_special_tokens=False)


def test_stream_emits_early_with_a_bounded_window(vocabulary):
    rng = random.Random(7)
    word = [rng.choice(b"abcdefghinorst") for _ in range(20000)]
    read = 0

    def symbols():
        nonlocal read
        for i, b in enumerate(word):
            read += 1
            yield vocabulary.last[b] if i == len(word) - 1 else vocabulary.first[b]

    out, done = vocabulary.stream(symbols()), 0
    got = []
    for token in out:
        got.append(token)
        done += vocabulary.length(token)
        assert read - done <= 256 + 2 * vocabulary.lookahead + 1
    assert got == vocabulary.merge([vocabulary.first[b] for b in word[:-1]] + [vocabulary.last[word[-1]]])


def test_readable_text_round_trip(vocabulary):
    for x in ("plain words go round", "größe naïve日本 übung", "a 1 2 b"):
        ids = [i for w in vocabulary.words(x) for i in vocabulary.encode_word(w)]
        d = B.Decoder(vocabulary, as_tokens=False)
        assert (d.feed(ids[:3]) + d.feed(ids[3:]) + d.finish()).split() == vocabulary.words(x)


def test_digests_and_columns(spark, awkward, no_rows, library):
    want = {}
    docs = read_table(spark, SMALL, "documents", "doc_id", "text").collect()
    for i, t in [*AWKWARD, *((r.doc_id + 1000, r.text) for r in docs)]:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                   hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    more = read_table(spark, SMALL, "documents").selectExpr("doc_id + 1000 AS doc_id", "text")
    got = B.digests(awkward.select("doc_id", "text").union(more), PATH).collect()
    assert len(got) == len(AWKWARD) + len(docs)
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want[r.doc_id]
    encoded = B.encode(awkward, PATH)
    assert encoded.columns == awkward.columns + ["ids"]
    both = B.decode(encoded, PATH).collect()
    assert {(r.doc_id, len(r.ids), hashlib.sha256(r.decoded.encode()).hexdigest()) for r in both} == {
        (i, want[i][0], want[i][2]) for i, _ in AWKWARD}
    assert B.digests(no_rows, PATH).count() == 0 and B.encode(no_rows, PATH).count() == 0
