"""The pipeline's stages against brute-force versions of their operators."""
import re

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline as C
from spendframe.llm import toxicity
from spendframe.llm.common import materialize, read_table

from . import test_fuzzy_lines, test_ngram_join
from .conftest import SMALL


def test_stages(spark):
    docs = read_table(spark, SMALL, "documents")
    labels = read_table(spark, SMALL, "labels", "doc_id", "toxic")
    columns, kept = docs.columns, {}
    for name, stage in C.STAGES[:-1]:
        before = docs
        docs = materialize(stage(spark, docs, SMALL), f"test-{name}")
        assert docs.columns == columns
        kept[name] = (before.collect(), docs.collect())

    before, after = kept["toxicity"]
    model = toxicity.learn(read_table(spark, SMALL, "documents"), labels)
    said = {r.doc_id: r.predicted for r in toxicity.scores(read_table(spark, SMALL, "documents"), model).collect()}
    assert {r.doc_id for r in after} == {r.doc_id for r in before if not said[r.doc_id]}

    before, after = kept["line_dedup"]
    want = test_fuzzy_lines.brute([(r.doc_id, r.text) for r in before])
    texts = {r.doc_id: r.text for r in before}
    gone = {i for (i, t), x in want.items() if t.strip(" \t\n\x0b\x0c\r") and not x.strip(" \t\n\x0b\x0c\r")}
    assert len({r.doc_id for r in after} ^ ({r.doc_id for r in before} - gone)) <= 1
    assert sum(r.text != want[(r.doc_id, texts[r.doc_id])] for r in after) <= 0.01 * len(after)   # bands may miss a link

    before, after = kept["ngram_join"]
    classes = {r[3] for r in test_ngram_join.brute([(r.doc_id, r.text) for r in before])}
    assert {r.doc_id for r in after} == classes and len(after) == len(classes)

    before, after = kept["mixing"]
    assert {(r.doc_id, r.text) for r in after} <= {(r.doc_id, r.text) for r in before}
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert abs(sum(words(r.text) for r in after) / sum(words(r.text) for r in before) - 1) < 0.02

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    last = C.STAGES[-1][1](spark, docs, SMALL).collect()
    assert len(last) == docs.count()
    for r in last:
        assert r.ids == library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_registered():
    q = E.queries()
    assert "pipeline" in q and 4 <= len(C.STAGES) <= 5
    for n in range(1, 11):
        assert len([k for k in q if k.startswith(f"op{n}_")]) == 1
